"""Operators against brute force, round trips and held-out labels, and on odd rows."""

import base64
import collections
import functools
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bitsliced, bpe, katz, langid, line_dedup, packing, queries, simhash, toxicity, vec_dedup, warc

SF = "/root/testdata/sf0.001"
RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd(spark, extra=""):
    """Nulls, empty and blank texts, no words, a long text, repeated rows and ids, and columns with names that operators use."""
    long = "word " * 40_000 + "x" * 5_000
    rows = [(1, None, None), (2, "", "en"), (3, " \t\n ", "en"), (4, "1234 !?", None), (5, long, "en"), (6, "same line of five words\nsame line of five words", "en"), (6, "same line of five words\nsame line of five words", "en"), (6, "other text here", "fr"), (None, "same line of five words", "de"), (7, "ÀÉ 漢字 \U0001f600 a'b  c\r\nd", "fr")]
    return spark.createDataFrame([(d, t, x, "s", 1, 9.0, 8, 7) for d, t, x in rows], DOCS + ", score double, component_id long, n_lines long")


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, compare, name):
    compare(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF)


# 1


def test_lines_of_odd_rows(spark):
    got = line_dedup.dedup(odd(spark)).select("doc_id", "text", "n_lines", "n_removed", "score").collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert len(got) == 10 and by[1][0]["text"] is None and by[2][0]["text"] == "" and by[3][0]["text"] == " \t\n "
    assert [r["text"] for r in by[None]] == ["same line of five words"]  # a null id is first
    assert sorted(r["text"] for r in by[6]) == ["", "", "other text here"] and by[5][0]["n_removed"] == 0 and by[5][0]["score"] == 9.0
    assert line_dedup.dedup(empty(spark)).count() == 0


def test_similar_lines_go(spark):
    words = [f"w{k}" for k in range(60)]
    changed = [*words[:59], "new"]
    rows = [(1, " ".join(words)), (2, "first\n" + " ".join(changed)), (3, " ".join(words[:30]))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: " ".join(words), 2: "first", 3: " ".join(words[:30])}


def lines_by_hand(rows):
    """Texts by the definition: a line goes if an earlier one has the same words or a Jaccard similarity of 0.8 or more."""

    def tokens(line):
        w = re.split("[ \\t\\x0b-\\r]+", line.lower().strip(" \t\x0b\x0c\r"))
        return frozenset(w) if w != [""] else None

    seen, out = [], {}
    for d, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            own = tokens(line)
            if own is None or not any(own == o or len(own & o) * 9 >= (len(own) + len(o)) * 4 for o in seen):
                kept.append(line)
            if own is not None:
                seen.append(own)
        out[d] = "\n".join(kept)
    return out


def test_large_groups_of_similar_lines(spark):
    rng = random.Random(6)
    base = [[f"{g}w{k}" for k in range(n)] for g, n in enumerate((83, 59, 30, 12, 6))]
    rows = []
    for d in range(240):
        lines = []
        for _ in range(3):
            own = list(rng.choice(base))
            for _ in range(rng.choice((0, 1, 1, 1, 2))):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
            lines.append(" ".join(own))
        rows.append((d, "\n".join(lines)))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == lines_by_hand(rows)


def test_few_candidates_among_long_lines(spark, monkeypatch):
    """Unlike lines of many words that share some are told apart by their maps; like ones of all widths of map are found."""
    rng = random.Random(8)
    lines = [[f"{n}w{k}" for k in rng.sample(range(4 * n), n)] for n in (60, 94, 150, 190, 260, 330) for _ in range(25)]
    rows = [(d, " ".join(x)) for d, x in enumerate(lines)]
    for d, own in enumerate(lines[::5]):
        left, more = own[rng.randrange(len(own) // 8) :], rng.randrange(len(own) // 7)
        rows.append((1000 + d, " ".join([*left, *(f"new{d}x{k}" for k in range(more))])))
    pairs, similar = [], line_dedup.similar
    monkeypatch.setattr(line_dedup, "similar", lambda docs, sets, some: pairs.append(some.distinct().count()) or similar(docs, sets, some))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = lines_by_hand(rows)
    assert got == want and 5 < sum(x == "" for x in want.values()) < 30
    assert sum(pairs) < 150


def test_smaller_sets_meet_larger_ones_by_a_ninth_of_their_words(spark, monkeypatch):
    """Half of the places of words meet the others; settled sets and lists that are not broadcast change nothing."""
    rng = random.Random(4)
    rows, pool = [], [f"p{k}" for k in range(900)]
    for d in range(60):
        own = rng.sample(pool, rng.randrange(5, 60))
        more = [f"new{d}x{k}" for k in range(rng.randrange(1 + len(own) // 5))]
        pair = [own[rng.randrange(1 + len(own) // 9) :], own + more]
        rows += [(2 * d + k, " ".join(rng.sample(x, len(x)))) for k, x in enumerate(pair if d % 2 else pair[::-1])]
    rows += [(1000 + d, " ".join([*(f"same{k}" for k in range(30)), f"other{d}"])) for d in range(20)]
    want, joined, pairs = lines_by_hand(rows), [], line_dedup.open_pairs
    assert 30 < sum(x == "" for x in want.values()) < len(rows) - 40
    monkeypatch.setattr(line_dedup, "open_pairs", lambda sets, share: joined.append(share) or pairs(sets, share))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for few, large in ((300_000, 50), (0, 3)):
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", few)
        monkeypatch.setattr(line_dedup, "LARGE", large)
        assert {r["doc_id"]: r["text"] for r in line_dedup.dedup(table).collect()} == want
    assert joined == list(range(line_dedup.SHARES)) * 2
    ninth = [r["places"] for r in line_dedup.numbered(table).where("prefix IS NOT NULL").selectExpr("size(slice(prefix, 1, size div 9 + 1)) = size div 9 + 1 AS places").collect()]
    assert all(ninth)


def test_sets_are_numbered_by_texts_and_lines(spark, monkeypatch):
    """Texts are sorted, not sets: a set's number ends with the number of its line and grows with its place, however the text numbers are joined."""
    rows = [(d, "\n".join(f"line l{k} of text number {d} {x}" for k in range(5))) for d in [None, *range(-3, 40)] for x in ("a", "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for few in (300_000, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", few)
        got = sorted((r["set"], (r["doc_id"] is not None, r["doc_id"] or 0, r["th"], r["n"])) for r in line_dedup.numbered(table).collect())
        assert len({x for x, _ in got}) == len(got) == 5 * len(rows) and all(x % 2**31 == place[-1] for x, place in got)
        assert [place for _, place in got] == sorted(place for _, place in got)
        assert {x >> 31 for x, _ in got} == set(range(len(rows)))


def test_one_changed_word_of_a_short_line(spark):
    rows = [(1, "one two three four five six seven eight nine"), (2, "one two three four five six seven eight other"), (3, "one two other four five six different eight nine"), (4, "a b c"), (5, "a b d"), (6, "b a c b")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == lines_by_hand(rows) and got[2] == "" and got[3] == rows[2][1] and got[5] == "a b d" and got[6] == ""


def test_lines_by_the_definition_on_documents(spark, docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.where("text IS NOT NULL").collect()]
    want = lines_by_hand(rows)
    for listed in (line_dedup.LISTED, 50):
        monkeypatch.setattr(line_dedup, "LISTED", listed)
        assert {r["doc_id"]: r["text"] for r in line_dedup.dedup(docs).collect() if r["text"] is not None} == want


def test_texts_and_lines_are_split_once(spark, docs):
    """What made line dedup slow: instr for a look at bytes, and a filter on the words, which split each line twice."""
    plan = line_dedup.lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2 and "instr(" not in plan


def test_line_columns_pass_unchanged(spark):
    names = "n_lines int, n_removed string, stay int, place_id int, _gone int, `a b` int, n_chars int, Set int"
    rows = [(1, "a b c\nx", 77, "r", 5, 6, 7, 8, 9, 10), (2, "c b a\ny", 88, "s", 50, 60, 70, 80, 90, 100)]
    table = spark.createDataFrame(rows, "doc_id long, text string, " + names)
    got = line_dedup.without_repeats(table)
    assert got.columns == table.columns
    assert sorted(map(tuple, got.collect())) == [(1, "a b c\nx", 77, "r", 5, 6, 7, 8, 7, 10), (2, "y", 88, "s", 50, 60, 70, 80, 1, 100)]
    done = {r["doc_id"]: r for r in line_dedup.dedup(table).collect()}
    assert (done[2]["n_lines"], done[2]["n_removed"], done[1]["n_removed"], done[2]["stay"]) == (2, 1, 0, 50)


# 2


def test_pieces_and_sequences(spark, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(JSON)
    own.encode_special_tokens = True
    table = docs.select("doc_id", "text").unionByName(odd(spark).select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    got = packing.packed(table, JSON).collect()
    texts = collections.Counter((r["doc_id"], r["text"] or "") for r in table.collect())
    want = collections.Counter()
    for (doc, text), n in texts.items():
        ids = [*own.encode(text, add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        for k, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if k == 0 else start + 1024]
            want[doc, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += n
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own_places in places.values():
        at = 0
        for offset, length in sorted(own_places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= math.ceil(sum(r["length"] for r in got) / 1024) + 3
    assert packing.packed(empty(spark), JSON).count() == 0


def test_words_join_to_the_whole():
    own = packing.Words(JSON)
    rng = random.Random(5)
    texts = ["".join(rng.choice(" \n\t  ab1.,'é  s\r漢!\x1c ") for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["<|endoftext|> x", ""]
    want = [np.array(e.ids, "<u4").tobytes() for e in own.own.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want


def test_search_only_improves():
    rng = np.random.default_rng(3)
    for _ in range(5):
        lengths = rng.integers(1, 700, 400)
        start = packing.best_fit(lengths, 1024)
        bins = [[k] for k in range(len(lengths))]
        for before in (start, bins):
            after = packing.improve(before, lengths, 1024)
            assert sorted(r for b in after for r in b) == list(range(len(lengths))) and max(lengths[b].sum() for b in after) <= 1024
            assert len(after) <= len(before) and sum(int(lengths[b].sum()) ** 2 for b in after) >= sum(int(lengths[b].sum()) ** 2 for b in before)


def test_search_ends_without_an_exchange():
    rng = np.random.default_rng(4)
    for n in (60, 3000):
        lengths = rng.integers(200, 500, n)
        bins = packing.improve([[k] for k in range(n)], lengths, 1024)
        fill = [int(lengths[b].sum()) for b in bins]
        if len(bins) == -(-int(lengths.sum()) // 1024):
            continue
        richest = collections.defaultdict(list)  # of each length, bins that hold it
        for at, b in enumerate(bins):
            for length in {int(lengths[r]) for r in b}:
                richest[length].append(at)
        for at, b in enumerate(bins):
            own = [int(lengths[r]) for r in b]
            sums = {*own, *(x + y for k, x in enumerate(own) for y in own[:k])}
            assert not any(fill[to] >= fill[at] and fill[to] + x <= 1024 for x in own for to in range(len(bins)) if to != at and fill[to] < 1024)
            assert not any(0 < x - length <= 1024 - fill[to] and fill[to] >= fill[at] for x in sums for length, places in richest.items() for to in places if to != at)


# 3


def katz_by_hand(rows, order=3):
    """rows: (doc_id, text). Scores by the definition, with dictionaries."""
    token = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    texts = [["<s>"] * (order - 1) + token(t) for _, t in rows]
    counts, context = ([collections.Counter() for _ in range(order + 1)] for _ in range(2))
    for h, t in zip(held, texts, strict=True):
        for i in () if h else range(order - 1, len(t)):
            for n in range(1, order + 1):
                counts[n][tuple(t[i - n + 1 : i + 1])] += 1
                context[n][tuple(t[i - n + 1 : i])] += 1
    total, discounts, follow = context[1][()], [None], [None]
    for n in range(1, order + 1):
        types = collections.Counter(counts[n].values())
        discounts.append(katz.Discounts({r: types[r] for r in range(1, 7)}))
        follow.append(collections.defaultdict(list))
        for gram, r in counts[n].items():
            follow[n][gram[:-1]].append((gram, r))
    mass = lambda n, r: float(discounts[n].mass(np.array([r]))[0])
    size = functools.cache(lambda n, h: context[n][h] + all(r > 5 for _, r in follow[n][h]))
    left = functools.cache(lambda n, h: 1 - sum(mass(n, r) for _, r in follow[n][h]) / size(n, h))
    weight = functools.cache(lambda n, h: left(n, h) / (1 - sum(prob(n - 1, g[1:]) for g, _ in follow[n][h])))

    def prob(n, gram):
        if counts[n][gram]:
            return mass(n, counts[n][gram]) / size(n, gram[:-1])
        if n == 1:
            return left(1, ()) if total else 1.0
        return (weight(n, gram[:-1]) if context[n][gram[:-1]] else 1.0) * prob(n - 1, gram[1:])

    for h in list(follow[order])[:20]:  # each history's distribution sums to one
        assert abs(sum(prob(order, (*h, *w)) for w in counts[1]) + prob(order, (*h, None)) - 1) < 1e-9
    out = []
    for (d, _), h, t in zip(rows, held, texts, strict=True):
        own = range(order - 1, len(t))
        base = sum(math.log10((counts[1][(t[i],)] + 0.1) / (total + 0.1 * (len(counts[1]) + 1))) for i in own)
        out.append((d, h, len(own), sum(counts[1][(t[i],)] > 0 for i in own), total, base, sum(math.log10(prob(order, tuple(t[i - order + 1 : i + 1]))) for i in own)))
    return out


def same_scores(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-8)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_katz_by_definition(spark, docs, monkeypatch, order):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = katz_by_hand(rows, order)
    same_scores(katz.scored(docs, order).collect(), want)
    if order == 3:  # with many partitions, and frequent histories whose n-grams are dealt by themselves
        monkeypatch.setattr(katz, "HOT", 50)
        monkeypatch.setattr(katz, "ENTRIES", 10_000)
        same_scores(katz.scored(docs.repartition(3), order).collect(), want)


def test_katz_frequent_histories_leave_something(spark):
    rows = [(d, "a b c" if d % 2 else "a b d") for d in range(60)] + [(100, "a b"), (1000, "b e a a c")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = katz.scored(table).collect()
    same_scores(got, katz_by_hand(rows))
    assert all(math.isfinite(r["score"]) for r in got)


def test_katz_odd_rows(spark):
    table = odd(spark)
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    same_scores(katz.scored(table).collect(), katz_by_hand(rows))
    assert katz.scored(empty(spark)).count() == 0
    only = spark.createDataFrame([(d, "a b") for d in range(40) if zlib.crc32(str(d).encode()) % 10 == 0], "doc_id long, text string")
    assert {r["score"] for r in katz.scored(only).collect()} == {0.0}


def test_katz_words():
    texts = [b"A b\xc3\xa9 \x0b" + b"q" * 300, b"", b" \t ", b"a"]
    w, before, doc = katz.tokens(texts)
    assert doc.tolist() == [0, 0, 0, 0, 1, 2, 3, 3] and w[0] == w[6] and w[3] == w[4] == katz.END and before[4] == katz.START and before[1] == w[0]
    longer = katz.tokens([b"q" * 301])[0]
    assert longer[0] != w[2]


# 4


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identified(docs).join(docs.select("doc_id", F.col("lang").alias("l")), "doc_id").where("held_out AND l IS NOT NULL")
    right, every = got.where("l = lang_pred").count(), got.count()
    assert every > 200 and right / every > 0.97


def test_language_odd_rows(spark):
    table = odd(spark)
    got = langid.identified(table).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 10 and all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (1, 2, 3, 4)) and by[5]["lang_pred"] in ("en", "fr", "de") and all(0 <= r["score"] <= 1 for r in got)
    assert langid.identified(empty(spark)).count() == 0
    assert {r["lang_pred"] for r in langid.identified(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()} == {"und"}
    assert sorted(langid.accepted(table).columns) == sorted(table.columns)


def test_one_language_or_family(spark):
    rows = [(k, "the house is red", "en") for k in range(10)] + [(k + 10, "das haus ist rot", "de") for k in range(10)]
    got = langid.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r["lang_pred"] == ("en" if r["doc_id"] < 10 else "de") for r in got)


# 5


def test_vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 16))
    rows = [(k, (centres[k % 30] + 0.05 * rng.standard_normal(16)).tolist()) for k in range(1500)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None]), (2004, []), (2005, [3.0]), (2006, [1e200] * 16)]
    rows += [(3000 + k, rows[0][1]) for k in range(40)] + [(None, rows[0][1])]
    got = {r["vec_id"]: r for r in vec_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([v / np.abs(v).max() for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= 0.95
    found = sum(got[i]["n_links"] for i, _ in good)
    assert found <= links.sum() - len(good) and found >= 0.97 * (links.sum() - len(good))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] and got[i]["component_id"] == i for i in (2000, 2001, 2002, 2003, 2004, 2005, None))
    assert all(got[3000 + k]["component_id"] == 0 for k in range(40)) and got[3001]["n_links"] >= 40


def test_recall_just_above_the_least_cosine(spark):
    rng = np.random.default_rng(11)
    rows, pairs = [], 400
    for k in range(pairs):
        x = rng.standard_normal(64)
        y = rng.standard_normal(64)
        x, y = x / np.linalg.norm(x), y - (y @ x) * x / (x @ x)
        y /= np.linalg.norm(y)
        c = 0.95 + 0.01 * (k + 1) / pairs
        rows += [(2 * k, x.tolist()), (2 * k + 1, (c * x + np.sqrt(1 - c * c) * y).tolist())]
    got = {r["vec_id"]: r["n_links"] for r in vec_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert sum(got[2 * k] > 0 for k in range(pairs)) >= 0.94 * pairs


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(vec_dedup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(k, (np.ones(8) + 0.01 * rng.standard_normal(8)).tolist()) for k in range(200)]
    got = vec_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["n_links"] for r in got} == {199} and {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


# 6


def test_bpe_round_trip(spark, docs):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = docs.select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    texts = collections.Counter((r["doc_id"], r["text"] or "") for r in table.collect())
    want = collections.Counter()
    for (d, t), n in texts.items():
        ids = own.encode_ordinary(t)
        want[d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += n
    assert collections.Counter(map(tuple, bpe.digests(table, RANKS, public_tokenizers.PATTERN).collect())) == want
    assert bpe.digests(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_cut_texts_have_the_ids_of_whole_ones(monkeypatch):
    rng = random.Random(1)
    own, _ = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    for _ in range(300):
        text = "".join(rng.choice(" ab1.,'é  s\n \x1c漢ll") for _ in range(400))
        assert [i for p in bpe.cut(text, 20) for i in own.encode_ordinary(p)] == own.encode_ordinary(text)
        assert "".join(bpe.cut(text, 20)) == text


def test_long_texts_without_blanks(spark):
    own, _ = bpe.encoding(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(2)
    lines = "\n".join("".join(rng.choice("漢字仮名交文") for _ in range(40)) for _ in range(60_000))  # 7 MB, a line a row
    code = base64.b64encode(rng.randbytes(300_000)).decode()  # nowhere to cut
    assert len(bpe.cut(lines)) > 30 and bpe.cut(code) == [code]
    got = {r["doc_id"]: r for r in bpe.digests(spark.createDataFrame([(1, lines), (2, code)], "doc_id long, text string"), RANKS, public_tokenizers.PATTERN).collect()}
    for k, text in ((1, lines), (2, code)):
        ids = own.encode_ordinary(text)
        assert (got[k]["n_tokens"], got[k]["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


# 7


def simhash_by_hand(rows, size=4, most=4):
    import xxhash

    prints = {}
    for d, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        own = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in own]
        prints[d] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0
    ids = sorted(prints)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (f"{prints[d]:016x}", find(d)) for d in ids}


def test_simhash_by_definition(spark, docs):
    table = docs.select("doc_id", "text").unionByName(odd(spark).where("doc_id < 6 OR doc_id = 7").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    want = simhash_by_hand([(r["doc_id"], r["text"]) for r in table.collect()])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(table).collect()}
    assert got == want


def test_every_close_pair_of_fingerprints_is_found(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(200)]
    for p in prints[:200]:
        for n in (1, 2, 3, 4, 4, 5):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), n)))
    rows = [(k, p - 2**64 if p >= 2**63 else p) for k, p in enumerate(prints)]
    got = {r["rep"]: r["component"] for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, fp long"), 4).collect()}
    root = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a + 1, len(prints)):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = a, b
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)

    def top(k):
        return k if root[k] == k else top(root[k])

    first = {}
    for k, p in enumerate(prints):
        first.setdefault(p, k)
    assert got == {k: top(k) for k in first.values()}


def test_one_of_each_group_stays(spark):
    table = odd(spark)
    got = simhash.without_copies(table)
    assert got.columns == table.columns
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect())
    assert kept.count((True, 0)) == 1 and (False, 1) in kept and (False, 2) not in kept and (False, 3) not in kept and kept.count((False, 6)) == 1
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_keys_with_many_rows_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(8)
    low = rng.getrandbits(39)  # three segments that all share
    prints = sorted({low | rng.getrandbits(25) << 39 for _ in range(150)} | {low | (rng.getrandbits(4) << 39) for _ in range(12)})
    rows = [(k, p - 2**64 if p >= 2**63 else p) for k, p in enumerate(prints)]
    got = {r["rep"]: r["component"] for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, fp long"), 4).collect()}
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for a in range(len(prints)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 4 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    assert got == dict(enumerate(root))


def test_unlike_texts_of_one_id_stay(spark):
    rng = random.Random(9)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(80))
    a, b, c = text(), text(), text()
    rows = [(1, a, 5), (1, b, 6), (1, c, 7), (2, a, 8), (3, f"{b} more", 9), (1, a, 10), (None, a, 11)]
    table = spark.createDataFrame(rows, "doc_id long, text string, row_id int").repartition(3)
    got = simhash.one_of_each(table)
    assert got.columns == table.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (1, c), (None, a)], key=str)
    assert simhash.one_of_each(empty(spark)).count() == 0
    assert sorted(map(str, (r["doc_id"] for r in simhash.one_of_each(odd(spark)).collect()))) == ["1", "4", "5", "6", "6", "7", "None"]


# 8


def toxic_tables(spark, n=400):
    rng = random.Random(2)
    plain = ["".join(rng.choice(["an", "the", "re", "on", "ti", "or", "in", "es"]) for _ in range(rng.randint(1, 4))) for _ in range(600)]
    rows, labels = [], []
    for d in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        bad = d % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron", "worthless"]))
        rows.append((d, " ".join(words)))
        labels.append((d, 0, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), plain


def test_toxicity_held_out_and_spelled_differently(spark):
    docs, labels, plain = toxic_tables(spark)
    got = toxicity.scored(docs, labels).join(labels, "doc_id").where("held_out")
    wrong = got.where("predicted <> toxic").count()
    assert got.count() > 60 and wrong <= 2
    model = toxicity.fit(docs, labels, ~F.coalesce(toxicity.remainder(4) == 2, F.lit(False)))
    clean = " ".join(plain[:80])
    texts = [f"{clean} {w} {clean}" for w in ("idiot", "IDIOT!", "i d i o t", "i.d.i.o.t", "id-iot", "idxiot", "1diot", "sc*um", "worthxless")]
    assert (model.score(texts) >= 0.3).all() and (model.score([clean, clean + " 12.5 notion"]) < 0.3).all()


def test_toxicity_beyond_ascii(spark):
    rng = random.Random(3)
    plain = ["".join(rng.choice(["по", "то", "на", "ре", "ко", "ла", "ни", "ва"]) for _ in range(rng.randint(2, 4))) for _ in range(500)]
    rows, labels = [], []
    for d in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        if d % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["дурак", "мразь", "идиот", "笨蛋傻瓜"]))
        rows.append((d, " ".join(words)))
        labels.append((d, 0, int(d % 5 == 0)))
    docs, own = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, own).join(own, "doc_id").where("held_out")
    assert got.count() > 60 and got.where("predicted <> toxic").count() <= 2


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.queries()["op8_toxicity"](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("toxic IS NOT NULL")
    n = {(r["predicted"], r["toxic"]): r["n"] for r in got.groupBy("predicted", "toxic").agg(F.count("*").alias("n")).collect()}
    # some labels are wrong by design; of what is called toxic over half must be, and of what is toxic most must be called so
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.75 and n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.5 and n[0, 0] / (n[0, 0] + n.get((1, 0), 0)) > 0.85


def test_toxicity_odd_rows(spark):
    docs, labels, _ = toxic_tables(spark, 60)
    table = odd(spark)
    got = toxicity.scored(table.unionByName(docs, allowMissingColumns=True), labels.unionByName(spark.createDataFrame([(1, None, None), (None, 1, 1)], labels.schema))).collect()
    assert len(got) == 70 and all(r["score"] is not None and 0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(empty(spark), labels.limit(0)).count() == 0
    assert {r["predicted"] for r in toxicity.scored(docs, labels.limit(0)).collect()} <= {0, 1}
    assert toxicity.harmless(table, labels).columns == table.columns


def test_toxicity_is_not_learned_in_the_driver(spark, docs, monkeypatch):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    monkeypatch.setattr(toxicity, "train", lambda toxic, clean, counts: toxicity.Model(np.zeros(toxicity.SIZE), float(os.getpid()), np.array([len(toxic), len(clean), 0.0])))
    model = toxicity.fit(docs, labels, F.lit(True))
    assert model.bias != os.getpid() and model.logistic[0] > 0 and model.logistic[1] > 0


# 9


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.standard_normal((700, 12)), rng.integers(-2, 3, (500, 12)) / 4.0])
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(9000, None), (9100, [float("inf")] * 12), (9200, [1.0, None]), (9300, [1e30]), (9400, []), (9500, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {k: np.pad(np.floor(1024 * np.array(v)).astype(int), (0, 12 - len(v))) for k, v in rows if k not in (9000, 9100, 9200, 9300)}
    want = set()
    for q in good:
        if q % 100 == 0:
            ranked = sorted((-int(good[q] @ v), k) for k, v in good.items() if k != q)[:10]
            want |= {(q, n, k, -s) for n, (s, k) in enumerate(ranked, 1)}
    assert set(map(tuple, bitsliced.neighbours(table).collect())) == want
    assert bitsliced.neighbours(table.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in bitsliced.neighbours(few).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(9)
    big = {k: np.append([0, 0], rng.integers(-(2**18), 2**18, 6) * 2.0 ** rng.integers(-5, 2)) for k in range(300)}
    big |= {300: np.array([1e5]), 301: np.array([-(2.0**53)]), 302: np.array([0, 2.0**52]), 303: np.array([7e4, 1]), 400: np.array([0, 2.0**-10, 0.5])}
    big = {k: np.pad(v, (0, 8 - len(v))) for k, v in big.items()}
    table = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in big.items()], "vec_id long, embedding array<double>")
    exact = {k: [int(np.floor(1024 * c)) for c in v] for k, v in big.items()}
    want = set()
    for q in (0, 100, 200, 300, 400):
        ranked = sorted((-sum(a * b for a, b in zip(exact[q], v, strict=True)), k) for k, v in exact.items() if k != q)[:10]
        want |= {(q, n, k, -s) for n, (s, k) in enumerate(ranked, 1) if -s < 2**63}
    assert len(want) == 50 and max(w[3] for w in want) > 2**53
    assert set(map(tuple, bitsliced.neighbours(table).collect())) == want
    for other in (1e17, -1e17):
        two = spark.createDataFrame([(0, [1e10]), (1, [other / 1024])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="no long"):
            bitsliced.neighbours(two).collect()


def test_top_k_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "ROWS", 90)
    monkeypatch.setattr(bitsliced, "QUERIES", 2)
    rng = np.random.default_rng(8)
    x = rng.integers(-3, 4, (600, 5)) / 8.0
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    y = np.floor(1024 * x).astype(int)
    want = set()
    for q in range(0, 600, 100):
        ranked = sorted((-int(y[q] @ v), k) for k, v in enumerate(y) if k != q)[:10]
        want |= {(q, n, k, -s) for n, (s, k) in enumerate(ranked, 1)}
    assert set(map(tuple, bitsliced.neighbours(table).collect())) == want


def test_queries_that_repeat_an_id(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.integers(-9, 9, 4) / 8.0).tolist()) for k in range(60)]
    table = spark.createDataFrame(rows + rows[:1] * 3 + [(0, [9.0] * 4)], "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(bitsliced, "QUERIES", 1)
    monkeypatch.setattr(bitsliced, "SENT", 2)
    got = bitsliced.top_k(table, table.where("vec_id IN (0, 7, 9)")).collect()
    value = {k: np.floor(1024 * np.array(v)).astype(int) for k, v in rows}
    every = [*value.items(), *[(0, value[0])] * 3, (0, np.full(4, 9 * 1024))]
    want = []
    for q in (0, 7, 9):
        ranked = sorted((-int(value[q] @ v), k) for k, v in every if k != q)[:10]
        want += [(q, n, k, -s) for n, (s, k) in enumerate(ranked, 1)]
    assert sorted(map(tuple, got)) == sorted(want)


# 10


def test_magic_inside_payloads(spark, tmp_path):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    rows = [(5, "http://a", inner), (2, None, inner), (9, "http://b\r\nX: y", None), (8, "u", ""), (1, "u", "é" * 10), (None, "u", "é" * 10), (1, "u", "é" * 10), (3, "u", "x" * 100_000 + inner)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in warc.archived(pages).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    of = lambda t: (len(t.encode()), digest(t))
    want = {(5, "revisit", 2, *of(inner)), (2, "response", None, *of(inner)), (9, "revisit", 8, *of("")), (8, "response", None, *of("")), (1, "response", None, *of("é" * 10)), (None, "revisit", 1, *of("é" * 10)), (3, "response", None, *of(rows[7][2]))}
    assert got == want and warc.archived(pages).count() == 8 and warc.archived(pages.limit(0)).count() == 0
    warc.write(pages, f"file://{tmp_path}/w", records_per_file=2)
    assert warc.read(spark, f"file://{tmp_path}/w").count() == 8
    part = next(tmp_path.glob("w/part*"))
    part.write_bytes(part.read_bytes()[:-3])
    (part.parent / f".{part.name}.crc").unlink()
    with pytest.raises(Exception, match="chain|no record"):
        warc.read(spark, f"file://{tmp_path}/w").count()


def test_large_pages_have_files_of_their_own(spark, tmp_path):
    rows = [(k, "u", "x" * size) for k, size in enumerate([10] * 30 + [20_000] * 12 + [1_100_000] * 3)]
    pages = spark.createDataFrame([(k, u, f"{k}{h}") for k, u, h in rows], "page_id long, url string, html string").coalesce(1)
    warc.write(pages, f"file://{tmp_path}/w", records_per_file=20)
    sizes = sorted(p.stat().st_size for p in (tmp_path / "w").glob("part*"))
    assert sum(x > 1_100_000 for x in sizes) == 3 and sizes[-1] < 1_110_000 and len([x for x in sizes if x]) == 2 + 1 + 3
    assert warc.read(spark, f"file://{tmp_path}/w").count() == 45


def test_small_copies_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", "same" if k % 2 else "a much longer page") for k in range(8)], "page_id long, url string, html string").repartition(4)
    warc.write(pages, f"file://{tmp_path}/w", min_bytes=10, records_per_file=1)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read(spark, f"file://{tmp_path}/w").collect()}  # revisits refer across files
    assert got == {k: ("response", None) if k % 2 or not k else ("revisit", 0) for k in range(8)}


def test_only_what_the_start_reaches():
    position, successor = np.array([0, 10, 15, 30, 40]), np.array([30, 15, 30, 50, 60])
    kept, end = warc.reachable(position, successor)
    assert kept.tolist() == [True, False, False, True, False] and end == 50


# the pipeline


def test_pipeline(spark, docs):
    import corpus_pipeline

    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, rows, SF)
        assert after.columns == docs.columns, name
        rows = spark.createDataFrame(after.collect(), docs.schema)
    language = corpus_pipeline.language(spark, docs, SF)
    assert language.count() >= 0.99 * docs.where("text is not null").count()
    pieces = corpus_pipeline.packed(spark, rows, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in rows.collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.count() == len(pieces)


def test_stages_keep_a_users_columns(spark, docs):
    import corpus_pipeline

    more = docs.limit(150).select("*", *(F.col("doc_id").cast("string").alias(n) for n in ("n_lines", "n_removed", "_gone", "_d", "score", "lang_pred", "toxicity", "row_id", "component_id", "Stay")))
    rows = more
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, rows, SF)
        assert after.columns == more.columns, name
        kept = after.collect()
        assert kept and all(r[n] == str(r["doc_id"]) for r in kept for n in more.columns[5:]), name
        rows = spark.createDataFrame(kept, more.schema)


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

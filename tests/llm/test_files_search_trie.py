"""Ranked search, token files, the conversation trie and scans against brute force, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, lexical, scan, token_files, toxicity, trie
from tidemark.llm.common import scratch

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, score double, item string, id int, row string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd(spark):
    """Nulls, empty and blank texts, repeated rows and ids, long texts and terms, and columns with names that operators use."""
    texts = [(1, None), (2, ""), (3, " \t\n "), (4, "The cat, the CAT!"), (5, "word " * 30_000 + "x" * 5_000), (6, "same cat"), (6, "same cat"), (6, "another cat 7"), (None, "same cat"), (7, "ÀÉ 漢字 \U0001f600 a'b  c\r\nd\0e"), (-3, "x" * 5_000 + " end")]
    return spark.createDataFrame([(d, t, 1.0, "i", 2, "r", 3) for d, t in texts], DOCS)


# 11


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked_by_hand(docs, items, best=10):
    counts = [(d, collections.Counter(t)) for d, x in docs if (t := terms(x))]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    wanted = collections.defaultdict(set)
    for i, x in items:
        wanted[i] |= set(terms(x))
    out = {}
    for i, own in wanted.items():
        found = []
        for d, c in counts:
            m = 10 + (90 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0:
                found.append((-s, d is not None, d or 0))
        out[i] = [(r, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(found)[:best], 1)]
    return {i: x for i, x in out.items() if x}


def as_lists(rows):
    out = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        out[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return dict(out)


def test_ranking_of_odd_rows(spark):
    items = [(1, "cat same"), (1, "cat same"), (2, None), (3, "..."), (None, "The END"), (4, "x" * 5_000), (5, "7 漢字 unknown"), (6, "word word")]
    table = spark.createDataFrame([(i, t, 5, "z") for i, t in items], "item_id long, text string, id int, term string")
    rows = [(r["doc_id"], r["text"]) for r in odd(spark).collect()]
    assert as_lists(lexical.ranked(odd(spark), table).collect()) == ranked_by_hand(rows, items)
    assert lexical.ranked(odd(spark).limit(0), table).count() == 0 and lexical.ranked(odd(spark), table.limit(0)).count() == 0
    only = spark.createDataFrame([(1, "a b"), (2, "b a")], "doc_id long, text string")
    assert as_lists(lexical.ranked(only, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect()) == ranked_by_hand([(1, "a b"), (2, "b a")], [(1, "a")])


@pytest.mark.parametrize("listed", [lexical.LISTED, 3])
def test_ranking_with_ties_common_and_rare_words(spark, monkeypatch, listed):
    """Few different texts, so that thresholds are ties; a word in all documents; postings by a list and by a join."""
    monkeypatch.setattr(lexical, "LISTED", listed)
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", 100_000 if listed > 3 else 5)
    rng = random.Random(4)
    base = [" ".join(["all", *rng.choices([f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(30)], k=rng.randrange(2, 12))]) for _ in range(40)]
    rows = [(d, rng.choice(base)) for d in range(600)]
    items = [(i, " ".join(["all"] * (i % 2) + [f"W{rng.randrange(60)}" for _ in range(rng.randrange(1, 7))])) for i in range(25)]
    got = lexical.ranked(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert as_lists(got.collect()) == ranked_by_hand(rows, items)


def test_search_prunes_common_terms(spark, monkeypatch):
    """Documents that have only frequent words of an item are no candidates."""
    rows = [(d, f"the of and {'rare' if d < 12 else 'x' + str(d)} word{d}") for d in range(2000)]
    seen = {}
    real = lexical.written
    monkeypatch.setattr(lexical, "written", lambda df, name, *a: seen.setdefault(name, real(df, name, *a)))
    items = [(1, "the of and rare")]
    got = lexical.ranked(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert as_lists(got.collect()) == ranked_by_hand(rows, items)
    assert seen["candidates"].count() == 12


# 12


def documents_by_hand(rows):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(JSON)
    own.encode_special_tokens = True
    out = []
    for d, text in rows:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def check_documents(rows, got):
    got = sorted(got, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == collections.Counter(documents_by_hand(rows))
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got[:-1])]).tolist()


def test_token_files_of_odd_rows(spark, docs):
    table = docs.select("doc_id", "text").union(odd(spark).select("doc_id", "text")).repartition(3)
    check_documents([(r["doc_id"], r["text"]) for r in table.collect()], token_files.stored(table, JSON).collect())
    assert token_files.stored(odd(spark).limit(0), JSON).count() == 0
    assert token_files.stored(odd(spark), JSON).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_small_files_sequences_and_masks(spark, docs):
    """Files that end after few ids, documents over many sequences, and random access without a copy."""
    path, rows = scratch(spark, "t"), [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    files = token_files.write(docs, path, JSON, length=16, rows=8, file_ids=3_000)
    check_documents(rows, token_files.documents(files).collect())
    listed = files.orderBy("part", "number").collect()
    assert len(listed) > 20 and all(f["start"] == sum(g["ids"] for g in listed[:k]) for k, f in enumerate(listed))
    for f in listed[:5]:
        data = pa.memory_map(f["file"].removeprefix("file://")).read_buffer()
        own = token_files.Sequences(data)
        every = [own[k] for k in range(len(own))]
        assert len(own) == -(-f["ids"] // 16) and own.schema.field("ids").type == pa.list_(pa.uint16(), 16)
        ids, mask, first = (np.concatenate([y.to_numpy(zero_copy_only=False) for y in x]) for x in zip(*every, strict=True))
        assert np.count_nonzero(mask) == f["ids"] and np.count_nonzero(first) == f["docs"] and not mask[f["ids"] :].any() and not ids[f["ids"] :].any()
        assert all(data.address <= x.buffers()[1].address < data.address + data.size for own_arrays in every for x in own_arrays)
        assert own[0][0].to_numpy(zero_copy_only=True).dtype == np.uint16
        with pytest.raises(IndexError):
            own[len(own)]


def test_spoiled_token_files_raise(spark, docs):
    path = scratch(spark, "t")
    files = token_files.write(docs, path, JSON)
    one = files.first()
    with open(one["file"].removeprefix("file://"), "r+b") as f:
        size = f.seek(0, 2)
        f.truncate(size // 2)
    with pytest.raises(Exception):  # noqa: B017 (Spark wraps what the task raises)
        token_files.documents(files).collect()


# 13


def trie_by_hand(rows, h):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [x[2:] for x in sorted(t)] for c, t in by.items()}
    built = {c: (plain.get(c - int(math.fmod(c, 100)), [])[: h(c)] + plain[c][h(c) :]) for c in plain}
    members = collections.defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    leaf, saved = collections.Counter(), collections.Counter()
    kids = collections.Counter(p[:-1] for p in members if p)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaf[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    digest = {p: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest() for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaf[p], saved[p], digest[p]) for p, m in members.items())


def trie_rows(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in df.collect())


def crc_share(c):
    return zlib.crc32(str(c).encode()) % 6


TURNS = "conv_id long, turn long, role string, text string, at long, depth string, p1 int"


def test_trie_of_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (0, None, "user", "hi"), (0, 1, None, None), (0, 1, "", ""), (0, 2, "user", "é漢\U0001f600"), (1, 0, "a", "b"), (1, 0, "a", "b"), (2, 5, "user", "hi"), (105, 1, "u", "lost"), (-7, 1, "u", "n"), (-7, 2, "u", "n"), (300, 3, "u", "")]
    table = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], TURNS)
    assert trie_rows(trie.nodes(table)) == trie_by_hand(rows, crc_share)
    assert trie.nodes(table.limit(0)).count() == 0 and trie.nodes(table.where("conv_id IS NULL")).count() == 0


@pytest.mark.parametrize("block", [2, 64])
def test_trie_with_copies_and_long_conversations(spark, monkeypatch, block):
    """A third are copies of one conversation, one is very long, many are prefixes of others; blocks of two turns make many levels; lists of ends have many pieces."""
    monkeypatch.setattr(trie, "PIECE", 7)
    rng = random.Random(9)
    rows = []
    for c in range(0, 900, 3):
        n = 300 if c == 300 else 9 if c % 9 == 0 else rng.randrange(1, 12)
        rows += [(c, t, "user" if t % 2 else "bot", f"same {t}" if c % 9 == 0 and c != 300 else f"{rng.choice('ab')}{t % 7 if c == 300 else ''}") for t in range(n)]
    table = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], TURNS).repartition(4)
    got = trie.nodes(table, block)
    assert trie_rows(got) == trie_by_hand(rows, crc_share)
    by = sorted(got.select("preorder", "subtree_end", "depth", "n_leaves").collect())
    assert [r["preorder"] for r in by] == list(range(len(by))) and by[0]["subtree_end"] == len(by) - 1
    for r in by:
        inside = by[r["preorder"] + 1 : r["subtree_end"] + 1]
        assert all(x["depth"] > r["depth"] for x in inside) and (r["subtree_end"] + 1 == len(by) or by[r["subtree_end"] + 1]["depth"] <= r["depth"])


def test_trie_of_documents_sample(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(trie.nodes(table)) == trie_by_hand(rows, crc_share)


@pytest.mark.parametrize("parts", [1, 13])
def test_scan_of_segments_over_many_tasks(spark, monkeypatch, parts):
    """A segment longer than a task, several in a task, and some of one row."""
    rng = random.Random(parts)
    rows = [(s, k, rng.randrange(-50, 50), rng.getrandbits(62)) for s, n in enumerate((1, 400, 3, 1, 1, 250, 2, 90)) for k in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "s long, k long, v long, x long").repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = scan.scanned(df.orderBy("s", "k"), "s", sums=("v",), xors=("x",)).collect()
        whole = scan.scanned(df.orderBy("s", "k"), sums=("v",)).collect()
        assert scan.scanned(df.limit(0).orderBy("s"), "s", sums=("v",)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    total, before = {}, None
    for r in sorted(got, key=lambda r: (r["s"], r["k"])):
        n, v, x = total.get(r["s"], (0, 0, 0))
        total[r["s"]] = n + 1, v + r["v"], x ^ r["x"]
        assert (r["at"] + 1, r["run_v"], r["run_x"]) == total[r["s"]] and r["at"] == r["k"]
    assert len(got) == len(rows) == len(whole)
    for k, r in enumerate(sorted(whole, key=lambda r: (r["s"], r["k"]))):
        before = (before or 0) + r["v"]
        assert (r["at"], r["run_v"]) == (k, before)


# 4


def labelled(spark, n_langs, per):
    """Texts of invented languages, each with words of its own; two of a family, the rest alone."""
    rng = random.Random(3)
    names = ["no", "sv", *(f"x{k}" for k in range(n_langs - 2))]
    rows = []
    for lang in names:
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(8)]
        rows += [(len(rows) + k, " ".join(rng.choices(words, k=12)), lang) for k in range(per)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def chosen_by_hand(model, text):
    """The family by its largest margin, then votes of pairs, each margin a plain sum over the text's pairs and triples of bytes."""
    if not text or not model.families or not langid.LETTER.search(text):
        return "und", 0.0
    data = [langid.FOLD[c] for c in b" " + text.lower().encode() + b"  "]
    counts = collections.Counter()
    for k in range(len(data) - 2):
        a, b, c = (int(x) for x in data[k : k + 3])
        counts[a << 8 | b] += 1
        counts[((a << 16 | b << 8 | c) * 0x9E3779B1 >> 13 & (langid.TRIPLES - 1)) + langid.PAIRS] += 1
    letters = max(1, sum(x != 32 for x in data))
    blanks = (0x2020, (0x202020 * 0x9E3779B1 >> 13 & (langid.TRIPLES - 1)) + langid.PAIRS)
    margins = [langid.SCALE * sum(n * w[c] for c, n in counts.items() if c not in blanks) / letters + w[-1] for w in model.weights]
    sure = lambda m: 1 / (1 + math.exp(-3 * m))
    n = len(model.families) if len(model.families) > 1 else 0
    first = max(range(n), key=lambda k: margins[k]) if n else 0
    score, langs = sure(margins[first]) if n else 1.0, model.langs[model.families[first]]
    won, sums, least = collections.Counter(), collections.Counter(), dict.fromkeys(langs, 1.0)
    for (a, b), m in zip(model.pairs, margins[n:], strict=True):
        if a in langs:
            for lang, own in ((a, m), (b, -m)):
                won[lang] += own > 0
                sums[lang] += own
                least[lang] = min(least[lang], sure(own))
    best = max(sorted(langs), key=lambda x: (won[x], sums[x]))
    return best, score * least[best]


def test_languages_are_chosen_as_by_hand(spark, docs):
    model = langid.fit(docs, F.lit(True), 40)
    texts = [r["text"] for r in docs.select("text").limit(60).collect()] + ["", "12", "a", "Zażółć gęślą"]
    for text, (lang, score) in zip(texts, model.predict(texts), strict=True):
        want = chosen_by_hand(model, text)
        assert lang == want[0] and score == pytest.approx(want[1], abs=1e-6)


def test_every_language_is_learned(spark):
    """More languages than any earlier bound; the driver gets machines, not texts."""
    table = labelled(spark, 104, 3)
    model = langid.fit(table, F.lit(True), 3)
    assert sum(map(len, model.langs.values())) == 104 and model.pairs == [("no", "sv")]
    rows = table.collect()
    assert sum(lang == r["lang"] for r, (lang, _) in zip(rows, model.predict([r["text"] for r in rows]), strict=True)) >= 300


def test_toxic_rows_are_chosen_by_a_hash(spark, monkeypatch):
    """Ids that repeat in documents: the same rows are learned from however the table is dealt."""
    monkeypatch.setattr(toxicity, "TOXIC", 3)
    monkeypatch.setattr(toxicity, "CLEAN", 3)
    monkeypatch.setattr(toxicity, "train", lambda toxic, clean, counts: (sorted(toxic), sorted(clean)))
    labels = spark.createDataFrame([(d, d % 2) for d in range(6)], "doc_id long, toxic int")
    table = spark.createDataFrame([(d, f"text {d} {k}") for d in range(6) for k in range(8)], "doc_id long, text string")
    seen = [toxicity.fit(table.repartition(n), labels, F.lit(True)) for n in (1, 5, 9)]
    assert seen[0] == seen[1] == seen[2] and sum(map(len, seen[0])) == 12

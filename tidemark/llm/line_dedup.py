"""Line dedup by an exact set-similarity join, in DataFrame and SQL functions only.

A line's tokens are its distinct words, lower-cased. They are ordered by rarity:
all words are counted, those together whose hashes share one of the PLACES; ties by a hash.
Two sets with a Jaccard similarity of 0.8 or more share a word in the first fifth of their orders
(prefix filter); such pairs must agree in length (length filter) and in what can still follow the
shared word (positional filter) and in all but a few bits of a map of their words (bitmap filter, which
like the others loses no pair; longer lines have wider maps); then their words are compared. A line is removed if an earlier line,
in the order of doc_id and line number, has the same set or one of similarity 0.8 or more, whether or
not that line stays itself.

Blank lines have no words and stay. A null text stays null, an empty one empty; a document of which
all lines go keeps an empty text. Rows that repeat an id and a text are one document and lose the same
lines; texts that share an id are ordered by a hash. A null doc_id sorts first. An empty table gives an
empty result. Other columns pass through unchanged, whatever their names. A very long line is one long
set. Words are looked up and shared by 64-bit hashes, sets are told apart by 128 bits; the similarity
is computed from the words themselves.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, unused, written

#: The similarity is at least NEAR/OF; a smaller set than LEAST is similar to no other.
NEAR, OF, LEAST = 4, 5, 4
#: Places that words are counted by, how many of them (the most frequent ones) keep their counts, and steps of a count's logarithm.
PLACES, LISTED, STEPS = 1 << 20, 1 << 20, 4
#: Places that are put in order together.
CHUNK = 1 << 10
#: Sizes from which a set's map has 128 and 256 bits instead of 64, in so many columns; narrower sets have zeros there.
WIDER, WIDEST, MAPS = 96, 192, ("m0", "m1", "m2", "m3")
#: Shares of the words that are dealt one after the other, so that no more than a share of their places is on its way at a time.
SHARES = 2
#: Pairs of neighbouring words at the end of its prefix by which a set meets the earliest set that has them.
LEADS = 2
#: Sets that met the same earliest set, from which all sets that are left meet it by every word of their prefix.
LARGE = 50
#: Rows up to which a list of documents (about 60 bytes each) or of sets is broadcast; beyond, it is joined by shuffling.
BROADCAST_ROWS = 300_000


def spaced(text: Column) -> Column:
    """The text, in which other ASCII white space than blanks and line ends has become blanks. Few texts have any, and finding out is cheap."""
    other = F.lit(False)
    for c in "\t\x0b\x0c\r":
        other = other | F.contains(text, F.lit(c))  # looks at bytes; instr counts characters, which takes as long as splitting the text
    return F.when(other, F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)


def words(line: Column) -> Column:
    """The words of a line of a spaced text; one empty word if it is blank."""
    plain = F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " +", " ")).otherwise(line)
    return F.split(F.trim(plain), " ")


def blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\x0b\x0c", "    ")) == ""


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text), n and w, the words in lower case, of every line that is not blank."""
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split(F.lower(spaced(F.col("text"))), "\n")).alias("n", "line"))
    return rows.where(F.trim("line") != F.lit("")).select("doc_id", "th", "n", words(F.col("line")).alias("w"))  # a filter on w would split each line twice


def rarity(docs: DataFrame) -> DataFrame:
    """One row, one column: for each place the logarithm of the count of the words whose hash belongs there, or 0."""
    text = F.replace(F.lower(spaced(F.col("text"))), F.lit("\n"), F.lit(" "))
    each = docs.select(F.explode(F.split(text, " ")).alias("word")).where("word <> ''").select(F.xxhash64("word").bitwiseAND(F.lit(PLACES - 1)).alias("place"))
    most = each.groupBy("place").count()
    if LISTED < PLACES:
        most = most.orderBy(F.desc("count"), "place").limit(LISTED)
    rank = F.least(F.lit(127), F.ceil(STEPS * F.log2(F.col("count") + 1))).cast("byte")
    lists = most.select("place", rank.alias("rank"))
    every = docs.sparkSession.range(PLACES).withColumnRenamed("id", "place").join(lists, "place", "left")
    chunk = F.transform(F.sort_array(F.collect_list(F.struct("place", F.coalesce("rank", F.lit(0).cast("byte")).alias("rank")))), lambda x: x["rank"])
    chunks = every.groupBy(F.floor(F.col("place") / CHUNK).alias("chunk")).agg(chunk.alias("ranks"))
    row = chunks.agg(F.sort_array(F.collect_list(F.struct("chunk", "ranks"))).alias("all"))
    return row.select(F.expr("flatten(transform(all, x -> x.ranks))").alias("ranks"))


def maps() -> list[Column]:
    """The map of the words in t, as columns: a bit is set if an odd number of words belong to it. The bits of a wider map, folded, are those of a narrower one."""

    def part(of: int, k: int) -> str:
        bit = "a ^ shiftleft(1L, int(x & 63))"
        return f"aggregate(t, 0L, (a, x) -> {bit if of == 1 else f'if((x & {64 * (of - 1)}) = {64 * k}, {bit}, a)'})" if k < of else "0L"

    return [F.expr(f"CASE WHEN size(t) < {WIDER} THEN {part(1, k)} WHEN size(t) < {WIDEST} THEN {part(2, k)} ELSE {part(4, k)} END").alias(m) for k, m in enumerate(MAPS)]


def ordered(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """doc_id, th, n, size (of the line's set), prefix (the first fifth of its order), its map and the set's hashes h1 and h2."""
    rows = rows.select("doc_id", "th", "n", F.expr("array_distinct(transform(w, x -> xxhash64(x)))").alias("t")).withColumn("ranks", ranks.scalar())
    code = f"shiftleft(bigint(coalesce(get(p, int(x & {PLACES - 1})), 0Y)), 56) | shiftrightunsigned(x, 8)"  # p: the ranks, which must be named once only; what cannot be null is sorted as plain numbers
    rows = rows.withColumn("t", F.expr(f"sort_array(transform(array(ranks), p -> transform(t, x -> {code}))[0])")).drop("ranks")
    prefix = F.expr(f"slice(t, 1, size(t) - (size(t) * {NEAR} + {OF - 1}) div {OF} + 1)")
    return rows.select("doc_id", "th", "n", F.size("t").alias("size"), F.when(F.size("t") >= LEAST, prefix).alias("prefix"), *maps(), F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(1), "t").alias("h2"))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, th and id, a number that grows with both, of every text."""
    own = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("th")).distinct()
    return own.orderBy("doc_id", "th").withColumn("id", F.monotonically_increasing_id())


def numbered(docs: DataFrame) -> DataFrame:
    """The distinct sets: set (a number that grows with the place where the set stands first), doc_id, th and n of that place, size, prefix and its map.

    Texts are sorted and numbered, not sets, which are many and wide; the text's number and that of the line make the set's.
    """
    place = F.struct("doc_id", "th", "n")
    sets = ordered(lines(docs), rarity(docs)).groupBy("h1", "h2").agg(F.min(place).alias("first"), F.first("size").alias("size"), F.first("prefix").alias("prefix"), *(F.first(m).alias(m) for m in MAPS))
    order, part = written(in_order(docs), "order"), F.shiftright("id", 33)
    counts = order.groupBy(part.alias("part")).agg(F.count("*").alias("many"))
    before = counts.select("part", (F.sum("many").over(Window.orderBy("part")) - F.col("many")).alias("before"))  # a row for each task that wrote the order
    sets = sets.select("first.*", "size", "prefix", *MAPS).join(short(order).withColumnsRenamed({"doc_id": "d", "th": "h"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")))
    number = F.shiftleft(F.col("before") + F.col("id").bitwiseAND(F.lit(2**33 - 1)), 31).bitwiseOR(F.col("n").cast("long"))
    sets = written(sets.join(F.broadcast(before), part == F.col("part")).select("doc_id", "th", "n", "size", "prefix", *MAPS, number.alias("set")), "sets", "snappy")
    discard(order)
    return sets


def short(rows: DataFrame) -> DataFrame:
    """rows that were written, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def sizes(x: str, y: str) -> tuple[Column, Column]:
    return F.shiftright(x + "code", 31), F.shiftright(y + "code", 31)


def alike(x: str, y: str) -> Column:
    """The length and bitmap filters for two sets, whose columns begin with x and y.

    A word that only one of two sets has changes one bit, so the maps of similar sets, folded to the width of the narrower one, differ in a ninth of their words at most.
    """
    sx, sy = sizes(x, y)
    length = F.least(sx, sy) * OF >= F.greatest(sx, sy) * NEAR
    m0, m1, m2, m3 = (F.col(x + m).bitwiseXOR(F.col(y + m)) for m in MAPS)
    even, odd = m0.bitwiseXOR(m2), m1.bitwiseXOR(m3)
    wide = F.when(F.least(sx, sy) < WIDEST, F.bit_count(even) + F.bit_count(odd)).otherwise(F.bit_count(m0) + F.bit_count(m1) + F.bit_count(m2) + F.bit_count(m3))
    differ = F.when(F.least(sx, sy) < WIDER, F.bit_count(even.bitwiseXOR(odd))).otherwise(wide)
    return length & (differ * (NEAR + OF) <= (sx + sy) * (OF - NEAR))


def follows(x: str, y: str) -> Column:
    """The positional filter for two places of one word, whose columns begin with x and y: that word and what may come after it are enough."""
    (sx, sy), (ix, iy) = sizes(x, y), (F.col(c + "code").bitwiseAND(F.lit(2**31 - 1)) for c in (x, y))
    return F.least(sx - ix, sy - iy) * (NEAR + OF) >= (sx + sy) * NEAR


def passes(x: str, y: str) -> Column:
    """The positional filter, for words in prefixes; of two sets the smaller one shares a word in the first ninth of its order."""
    (sx, sy), (ix, iy) = sizes(x, y), (F.col(c + "code").bitwiseAND(F.lit(2**31 - 1)) for c in (x, y))
    return F.when(sy <= sx, iy * (NEAR + OF) <= sy * (OF - NEAR)).otherwise(ix * (NEAR + OF) <= sx * (OF - NEAR)) & follows(x, y)


def code(at: Column) -> Column:
    """The size of a set and the place of a word in its order."""
    return F.shiftleft(F.col("size").cast("long"), 31).bitwiseOR(at.cast("long")).alias("code")


def posts(sets: DataFrame, start: str, share: int | None = None, part: Column | None = None) -> DataFrame:
    """token, set, code and map of the prefix words, of a share or all, or of a part of each prefix; all columns but the token begin with start."""
    each = sets.where("prefix IS NOT NULL").select("set", "size", *MAPS, F.posexplode("prefix" if part is None else part).alias("at", "token"))
    if share is not None:
        each = each.where(F.pmod(F.shiftright("token", 7), F.lit(SHARES)) == share)
    return each.select("token", F.col("set").alias(start + "set"), code(F.col("at")).alias(start + "code"), *(F.col(m).alias(start + m) for m in MAPS))


def earliest(sets: DataFrame) -> DataFrame:
    """a, b: sets and the earliest sets (b) that share two neighbouring words at the end of the prefix with them, if they are candidates.

    The earliest is found by an aggregate that combines before the shuffle, and joined back by a broadcast or by a join that can split a frequent pair of words.
    """
    n = F.size("prefix")
    two = [F.xxhash64(F.get("prefix", n - k), F.get("prefix", n - k - 1)) for k in range(1, LEADS + 1)]  # the only word of a prefix stands alone
    leads = F.array(*(F.when((n > k) | F.lit(k == 1), key) for k, key in enumerate(two, 1)))
    each = sets.where("prefix IS NOT NULL").select("set", code(F.lit(0)), *MAPS, F.explode(leads).alias("lead")).where("lead IS NOT NULL")
    first = each.groupBy("lead").agg(F.min("set").alias("first_set"), *(F.min_by(c, "set").alias("first_" + c) for c in ("code", *MAPS)), F.count("*").alias("many")).where("many > 1")  # numbers, which need no sort, as a struct does
    first = written(first.drop("many"), "first", "snappy")
    both = each.join(short(first), "lead").where((F.col("first_set") < F.col("set")) & alike("", "first_"))
    done = written(both.select(F.col("set").alias("a"), F.col("first_set").alias("b")).distinct(), "met")
    discard(first)
    return done


def candidates(x: DataFrame, y: DataFrame) -> DataFrame:
    """a, b: sets of x and all earlier sets of y that are candidates by a shared word."""
    both = x.join(y, "token").where((F.col("y_set") < F.col("x_set")) & passes("x_", "y_") & alike("x_", "y_"))
    return both.select(F.col("x_set").alias("a"), F.col("y_set").alias("b")).distinct()


def open_pairs(sets: DataFrame, share: int) -> DataFrame:
    """a, b: sets that are open and all earlier sets that are candidates by a shared word of a share.

    A word of the first ninth of the smaller set's order meets the larger sets' prefixes; the number of a set that is not open is made negative.
    """
    ninth = F.slice("prefix", F.lit(1), F.expr(f"size * {OF - NEAR} div {NEAR + OF} + 1").cast("int"))
    x, y = posts(sets, "x_", share, ninth), posts(sets, "y_", share)
    (sx, sy), nx, ny = sizes("x_", "y_"), F.col("x_set"), F.col("y_set")
    place = [n.bitwiseXOR(F.shiftright(n, 63)) for n in (nx, ny)]  # -1 - n of a negative number
    apart = (sx < sy) | ((sx == sy) & (place[0] < place[1]))  # of two sets of one size either one's ninth will do
    open_later = F.when(place[0] < place[1], ny >= 0).otherwise(nx >= 0)
    both = x.join(y, "token").where(apart & follows("x_", "y_") & alike("x_", "y_") & open_later)
    return both.select(F.greatest(*place).alias("a"), F.least(*place).alias("b")).distinct()


def similar(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """set: the later sets (a) of pairs whose words have a Jaccard similarity of 0.8 or more. Only the lines of candidates are read again, by their places."""
    pairs = written(pairs, "pairs")
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "ids")
    need = sets.select("set", "doc_id", "th", "n").join(short(wanted), "set", "left_semi")
    need = written(need.groupBy("doc_id", "th").agg(F.collect_list(F.struct("n", "set")).alias("ns")), "wanted")
    own = docs.where(F.col("text").isNotNull()).select("doc_id", "text").withColumn("th", F.xxhash64("text"))
    right = need.select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "ns")
    some = own.join(short(right), own["doc_id"].eqNullSafe(right["d"]) & (own["th"] == right["h"]))
    some = some.withColumn("parts", F.array(F.split(F.lower(spaced(F.col("text"))), "\n")))  # in an array, so that a text is split once
    some = some.select(F.explode(F.expr("transform(parts, p -> transform(ns, x -> struct(x.set AS set, get(p, x.n) AS line)))[0]")).alias("x"))
    full = some.select("x.set", "x.line").dropDuplicates(["set"])  # rows may repeat an id and a text; lines travel as they are, which takes a quarter of the room of their words
    left, other = full.select(F.col("set").alias("a"), F.col("line").alias("la")), full.select(F.col("set").alias("b"), F.col("line").alias("lb"))
    both = pairs.join(left, "a").join(other, "b")
    sides = F.array(F.struct(*(F.array_distinct(words(F.col(c))).alias(c) for c in ("la", "lb"))))  # in an array, so that each line is split once
    near = F.transform(sides, lambda p: F.size(F.array_intersect(p["la"], p["lb"])) * (NEAR + OF) >= (F.size(p["la"]) + F.size(p["lb"])) * NEAR)
    both = both.where(F.get(near, F.lit(0)))
    done = written(both.select(F.col("a").alias("set")).distinct(), "settled")
    for old in (pairs, wanted, need):
        discard(old)
    return done


def kept(docs: DataFrame) -> DataFrame:
    """doc_id, th and ns, the numbers of the lines that stay, of every document that has such lines.

    One similar earlier line is enough for a line to go. So each set is first compared with the earliest
    sets that share a few pairs of rare words with it, and with the first sets of large groups by every word
    of its prefix, which settles most members of a large group of similar lines; only the sets that are left meet all earlier ones, by every word of their prefix. Thus
    a group of similar lines does not become all its pairs.
    """
    sets = numbered(docs)
    met = earliest(sets)
    done = [similar(docs, sets, met)]
    leaders = written(met.groupBy(F.col("b").alias("set")).count().where(F.col("count") >= LARGE).select("set"), "leaders")
    heads = written(posts(sets.join(short(leaders), "set", "left_semi"), "y_"), "heads")
    if not heads.isEmpty():
        later = sets.join(short(done[0]), "set", "left_anti")
        done.append(similar(docs, sets, candidates(posts(later, "x_"), short(heads))))
    gone = written(functools.reduce(DataFrame.union, done), "gone")
    closed = sets.join(short(gone.withColumn("gone", F.lit(True))), "set", "left")
    rest = closed.select(F.when(F.col("gone"), -1 - F.col("set")).otherwise(F.col("set")).alias("set"), "size", "prefix", *MAPS)
    if gone.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        rest = written(rest, "rest", "snappy")  # joined once, not for each share and side
    found = [written(open_pairs(rest, share), "found") for share in range(SHARES)]  # one table after the other
    done.append(similar(docs, sets, functools.reduce(DataFrame.unionByName, found).distinct()))
    every = written(functools.reduce(DataFrame.union, done), "every")
    stay = sets.select("set", "doc_id", "th", "n").join(short(every), "set", "left_anti")
    out = written(stay.groupBy("doc_id", "th").agg(F.collect_list("n").alias("ns")), "kept")
    for old in (sets, met, leaders, heads, gone, *found, every, *done):
        discard(old)
    return out


def _judged(docs: DataFrame, n_lines: str, n_removed: str) -> DataFrame:
    """docs with what is left of text, and two columns more."""
    d, h, own, ns, every, left = (unused(docs, x) for x in ("place_id", "place_hash", "own_hash", "stay", "every_line", "left_lines"))
    per_doc = short(kept(docs.select("doc_id", "text")).toDF(d, h, ns))
    joined = docs.withColumn(own, F.xxhash64("text")).join(per_doc, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(own) == F.col(h)), "left")
    parts, some = F.col(every), F.coalesce(F.col(ns), F.array().cast("array<int>"))
    joined = joined.withColumn(every, F.split("text", "\n")).withColumn(left, F.when(F.size(some) == F.size(parts), parts).otherwise(F.filter(parts, lambda x, n: F.array_contains(some, n) | blank(x))))
    return joined.select(
        *(F.array_join(left, "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias(n_lines),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts) - F.size(left)).cast("long").alias(n_removed),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """docs without the lines that match an earlier one; two columns more, n_lines and n_removed, which replace columns of those names."""
    return _judged(docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed"))), "n_lines", "n_removed")


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the columns they had; n_chars, if there is one, is that of the text that is left."""
    done = _judged(docs, unused(docs, "n_lines"), unused(docs, "n_removed"))
    return done.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))

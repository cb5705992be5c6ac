"""Language identification by hierarchical discrimination.

Linear support vector machines over counts of byte pairs and triples first choose the language family,
one machine a family; then machines for each pair of languages within it vote. All are trained here,
on a bounded sample of labelled texts; every prediction reads the whole text and nothing but the text.

A null text, or one without a letter, is ``und`` with score 0. Rows without a label are not learned
from; ties of votes go to the larger sum of margins, then to the name that sorts first. If nothing can
be learned, every text is ``und``. Copies of a row are learned from once. Every language that has a row to learn
from is a class. The machines are trained in a task; the driver gets the number of rows of each language and the
machines. An empty table gives an empty result; other columns change nothing.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices, trimmed, unused

#: Families of closely related languages. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "sr", "uk"),
}
FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}
#: The sample that machines are trained on: rows of a language, characters of a text that may be in it, and rows in all, which languages share evenly.
SAMPLE, LONGEST, ROWS = 300, 50_000, 30_000
#: Codes: pairs of bytes as they are, triples hashed to TRIPLES places after them.
PAIRS, TRIPLES = 1 << 16, 1 << 17
LETTER = re.compile(r"[^\W\d_]")
#: a-z and the bytes of other characters stay, all else counts as a blank.
FOLD = np.array([c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
SCALE = 20.0


def remainder(column: str, of: int) -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(of))


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the pairs and of the triples at each place of the joined texts, the start of each text, and its number of letters' bytes."""
    parts = [b" " + x.lower().encode() + b"  " for x in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    data = FOLD[np.frombuffer(b"".join(parts), np.uint8)].astype(np.int64)
    pair = np.zeros(len(data), np.int64)
    pair[:-1] = data[:-1] << 8 | data[1:]
    triple = np.zeros(len(data), np.int64)
    triple[:-2] = ((pair[:-2] << 8 | data[2:]) * 0x9E3779B1 >> 13 & (TRIPLES - 1)) + PAIRS
    blank = ((0x202020 * 0x9E3779B1) >> 13 & (TRIPLES - 1)) + PAIRS
    for back in (1, 2):  # what would reach into the next text
        pair[starts[1:] - back], triple[starts[1:] - back] = 0x2020, blank
    letters = np.add.reduceat((data != 32).astype(np.int64), starts[:-1])
    return pair, triple, starts[:-1], letters


def train(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, cost: float = 1.0, rounds: int = 15) -> np.ndarray:
    """Weights of a linear support vector machine by dual coordinate descent; the last is the bias."""
    weights = np.zeros(PAIRS + TRIPLES + 1)
    rng = np.random.default_rng(7)
    alpha = np.zeros(len(rows))
    share = np.where(sign > 0, (sign < 0).sum(), (sign > 0).sum()) / len(rows) * 2 * cost
    norm = np.array([(v * v).sum() + 1 for _, v in rows])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, values = rows[i]
            gradient = sign[i] * (weights[at] @ values + weights[-1]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), share[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weights[at] += step * values
                weights[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights


@dataclass
class Model:
    """families: their names; families' and pairs' machines are columns of weights in that order; pairs: of languages."""

    families: list[str]
    langs: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        known = [x if x and self.families and LETTER.search(x) else "" for x in texts]
        pair, triple, starts, letters = codes(known)
        margins = []
        for w in self.weights:
            sums = np.add.reduceat(w[pair] + w[triple], starts)
            margins.append(SCALE * sums / np.maximum(letters, 1) + w[-1])
        return [self.choose([m[i] for m in margins]) if x else ("und", 0.0) for i, x in enumerate(known)]

    def choose(self, margins: list[float]) -> tuple[str, float]:
        sure = lambda m: 1 / (1 + np.exp(-np.clip(3 * m, -50, 50)))
        if len(self.families) > 1:
            first = int(np.argmax(margins[: len(self.families)]))
            score = sure(margins[first])
        else:
            first, score = 0, 1.0
        votes = {lang: [0, 0.0, 1.0] for lang in self.langs[self.families[first]]}
        for (a, b), m in zip(self.pairs, margins[len(self.families) if len(self.families) > 1 else 0 :], strict=True):
            if a in votes:
                for lang, own in ((a, m), (b, -m)):
                    votes[lang][0] += own > 0
                    votes[lang][1] += own
                    votes[lang][2] = min(votes[lang][2], sure(own))
        lang = max(sorted(votes), key=lambda x: (votes[x][0], votes[x][1]))
        return lang, float(score * votes[lang][2])


def sampled(docs: DataFrame, learn: Column, per: int) -> tuple[DataFrame, int] | None:
    """lang, place and text of somewhat more than per different texts of each language among the rows to learn from, chosen by a hash of id and text, and per, which many languages lower; None if there are none."""
    able = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= LONGEST)).select("doc_id", "lang", "text")
    counts = able.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return None
    per = max(1, min(per, ROWS // len(counts)))
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, (1.1 * per + 10) / r["n"])) for r in counts], "lang string, share double")
    place = F.pmod(F.xxhash64(F.lit("lang"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    some = able.withColumn("place", place).join(F.broadcast(share), "lang").where(F.col("place") < F.col("share"))
    return some.select("lang", "place", "text").dropDuplicates(["lang", "place", "text"]), per


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a text and their scaled counts, without those of blanks alone."""
    pair, triple, _, letters = codes([text])
    at, n = np.unique(np.concatenate([pair, triple]), return_counts=True)
    blank = np.isin(at, [0x2020, ((0x202020 * 0x9E3779B1) >> 13 & (TRIPLES - 1)) + PAIRS])
    return at[~blank], SCALE * n[~blank] / max(1, letters[0])


def trained(rows: list[tuple[np.ndarray, np.ndarray]], langs: np.ndarray) -> Model:
    """The machines of families and of pairs of languages, for features() and their languages."""
    of: dict[str, list[str]] = {}
    for lang in sorted(set(langs.tolist())):
        of.setdefault(FAMILY.get(lang, lang), []).append(lang)
    families = sorted(of)
    weights = []
    if len(families) > 1:
        for family in families:
            weights.append(train(rows, np.where(np.isin(langs, of[family]), 1, -1)))
    pairs = [(a, b) for family in families for a, b in combinations(of[family], 2)]
    for a, b in pairs:
        own = np.flatnonzero((langs == a) | (langs == b))
        weights.append(train([rows[i] for i in own], np.where(langs[own] == a, 1, -1)))
    return Model(families, of, pairs, np.array(weights) if weights else np.zeros((0, PAIRS + TRIPLES + 1)))


def fit(docs: DataFrame, learn: Column, per: int = SAMPLE) -> Model:
    """The machines, trained in one task on at most per texts of each language among the rows where learn holds."""
    found = sampled(docs, learn, per)
    if found is None:
        return trained([], np.array([], str))
    some, per = found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, langs, kept = [], [], {}
        for batch in batches:  # by language and place; a text goes once its counts are taken
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                kept[lang] = kept.get(lang, 0) + 1
                if kept[lang] <= per and LETTER.search(text):
                    rows.append(features(text))
                    langs.append(lang)
        model = trained(rows, np.array(langs, str))
        for k in range(max(1, len(model.weights))):  # a row a machine, so no row is large
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([pickle.dumps((model.families, model.langs, model.pairs) if k == 0 else None)], pa.binary()), pa.array([model.weights[k : k + 1].tobytes()], pa.binary())], names=["k", "names", "weights"])
        del rows, model
        trimmed()

    parts = sorted(some.repartition(1).sortWithinPartitions("lang", "place", "text").mapInArrow(run, "k long, names binary, weights binary").collect())
    data = b"".join(bytes(r["weights"]) for r in parts)
    return Model(*pickle.loads(parts[0]["names"]), np.frombuffer(data).reshape(-1, PAIRS + TRIPLES + 1))


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with two columns more, lang and score; columns of those names are replaced."""
    keep = [c for c in docs.columns if c not in (lang, score)]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            found = shared.value.predict(batch.column("text").to_pylist())
            columns = [*(batch.column(c) for c in keep), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, lang, score])
        trimmed()

    return docs.select(*(F.col(f"`{c}`") for c in keep)).mapInArrow(run, schema)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learned from the rows whose crc32(doc_id) mod 3 is not 1."""
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = fit(docs, ~held)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.05) -> DataFrame:
    """The documents in a language that was learned, with a score of least or more; texts without letters go. All columns pass unchanged."""
    model = fit(docs, ~F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)))
    lang, score = unused(docs, "lang_pred"), unused(docs, "score")
    return predict(docs, model, lang, score).where((F.col(lang) != "und") & (F.col(score) >= least)).drop(lang, score)

"""Documents to packed training sequences: language ID, toxicity, line dedup, near-dedup, packing.

Each stage gets (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next stage's docs. The first two drop documents that they reject (texts without letters or in no learned
language; toxic ones), the third takes repeated lines out of the texts, the fourth keeps one document of
each group of near copies, the last returns the pieces of the packed sequences. Rows with nulls pass
through the stages as each operator defines; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid, line_dedup, packing, simhash, toxicity
from tidemark.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.harmless(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("toxicity", harmless), ("line_dedup", lines), ("near_dedup", near_copies), ("packing", packed)]

#: Trained models, hashes of shingles and the search for full sequences have no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

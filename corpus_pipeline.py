"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from tierloom.llm.common import table
from tierloom.sources.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_failing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Quality rules: rejected documents go, failing lines of the others go."""
    return quality_rules.clean(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Exact dedup: of equal texts the one with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """SimHash near-dedup, four-word shingles and four bits: of each group the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Mixing: every document as often as its source's target asks for."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Byte-level BPE: the ids of every text, their number, and the text that the ids decode to."""
    coded = bpe.encode(docs, decode=True)
    ids, decoded = coded.columns[-2:]
    return coded.select(
        "doc_id", "lang", "source", F.size(ids).cast("long").alias("n_tokens"), F.col(ids).alias("ids"),
        F.col(decoded).alias("decoded"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", drop_failing),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("byte-level bpe", encode),
]

#: SimHash components, the draws of mixing and BPE cannot be stated in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = table(spark, folder, "documents")
    for position, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if position < len(STAGES) - 1:
            docs = materialize(docs)
    return docs

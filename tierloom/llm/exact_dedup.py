"""Exact dedup with a heavy-hitter split.

Texts are equal when they are identical after each run of white space became
one space; their SHA-256 stands for them. A pass over the digests keeps
Misra-Gries counters per partition, whose merged summary names every digest
that at least one in ``counters`` rows has. Candidates are counted exactly;
the verified ones, at most ``counters`` rows, are broadcast, and rows of these
hot digests get their winner without a shuffle. All other digests are rare by
that proof and meet through one ordinary shuffle of (id, digest) rows.

Defined cases: a null text counts as empty; of equal texts the smallest
``doc_id`` stays (a null id comes last); of rows that repeat both id and text
exactly one stays; an empty table gives an empty result; further columns of
the input never meet the operator's own names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tierloom.llm.common import SPACE, fresh
from tierloom.sources.storage import materialize

#: Counters of a Misra-Gries summary, and so the most rows that are ever broadcast.
COUNTERS = 1024


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text with its white space normalised."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "), 256)


def summarise(counts: dict[str, int], counters: int) -> dict[str, int]:
    """Cut a summary back to its counters: all give up what the first one beyond them holds."""
    if len(counts) <= counters:
        return counts
    over = sorted(counts.values(), reverse=True)[counters]
    return {key: count - over for key, count in counts.items() if count > over}


def misra_gries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, counted) of each partition's summary; ``digests`` has the one column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary: dict[str, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts():
                key = pair["values"].as_py()
                summary[key] = summary.get(key, 0) + pair["counts"].as_py()
            summary = summarise(summary, counters)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(summary), pa.string()), "counted": pa.array(list(summary.values()), pa.int64())}
        )

    return digests.mapInArrow(count, "digest string, counted long")


def heavy_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact counts and winners of the digests that at least one in ``counters`` rows has.

    The partitions' summaries are added up and cut to ``counters`` rows again,
    which keeps the Misra-Gries bound; what is left over is counted exactly.
    """
    summed = misra_gries(rows.select("digest"), counters).groupBy("digest").agg(F.sum("counted").alias("counted"))
    candidates = summed.orderBy(F.desc("counted"), "digest").limit(counters).select("digest")
    least = max(2, rows.count() // counters)
    return (
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min(_order()).alias("first"))
        .where(F.col("group_size") >= least)
    )


def _order() -> Column:
    """Smallest id first, null last; the row number decides between repeated rows."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")


def find_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialize(
        docs.select("doc_id", digest(F.col("text")).alias("digest")).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    heavy = materialize(heavy_digests(rows, counters))
    removed_in_place = rows.join(F.broadcast(heavy), "digest")
    same = Window.partitionBy("digest")
    shuffled = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "*", F.count(F.lit(1)).over(same).alias("group_size"), F.min(_order()).over(same).alias("first")
    )
    return removed_in_place.select(shuffled.columns).union(shuffled).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows are found again by id and digest. Where an id repeats with the same
    text, one of its rows is kept by a second, usually empty, pass.
    """
    key, sha = fresh(docs.columns, "key"), fresh(docs.columns, "sha")
    report = materialize(find_copies(docs, counters))
    named = docs.withColumn(sha, digest(F.col("text"))).withColumn(key, F.coalesce("doc_id", F.lit(-1)))
    report = report.withColumn("id", F.coalesce("doc_id", F.lit(-1)))
    lost = report.where("not kept").select(F.col("id").alias(key), F.col("text_sha256").alias(sha)).distinct()
    stay = report.where("kept").select(F.col("id").alias(key), F.col("text_sha256").alias(sha))
    both = lost.join(stay, [key, sha], "left_semi")
    single = named.join(lost, [key, sha], "left_anti")
    repeated = named.join(both, [key, sha], "left_semi").dropDuplicates([key, sha])
    return single.unionByName(repeated).select(docs.columns)

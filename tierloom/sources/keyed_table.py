"""Parquet table with a key, changed by upserts.

Rows lie in buckets, by a hash of their key. An upsert lays the batch beside the
stored keys and digests of their values in one shuffle, writes down the rows
that are new or differ, and writes the buckets that have such rows anew, as
one more version folder, ``v<number>/_bucket=<number>``; the file that Spark writes last makes it
one. Readers take each bucket from its newest version. A bucket's version before the newest stays for readers that
began before; older ones go. A batch whose writer died left no complete folder: readers never
see it, and it is given again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators.rank import top_k
from tierloom.sources.storage import file_system, release, scratch_path

#: Buckets of a table. A bucket is rewritten as a whole, by as many tasks as its size asks for.
BUCKETS = 16
#: Keys that Spark may broadcast. It judges by compressed bytes, so many narrow rows would fill the driver.
BROADCAST_KEYS = 100_000
_VERSION = re.compile(r"v(\d+)(?:~(.+)~(\d+))?")


class Delivered(NamedTuple):
    """What an upsert took in: keys of the batch, rows of them that were new or changed, greatest value asked for."""

    rows: int
    written: int
    greatest: int | None = None


def latest_rows(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``; a key's other rows stay in the map tasks."""
    return top_k(df, [F.col(f"`{name}`") for name in key], order, 1, "_place").drop("_place")


def merge_latest(base: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``base`` with the rows of ``changes`` put over it; both hold one row per key.

    Only the keys of the changes take part in the join, so Spark can send them
    to the base's tasks when they are few and shuffles both sides when not.
    """
    return without_keys(base, changes, key).unionByName(changes)


def without_keys(base: DataFrame, other: DataFrame, key: Sequence[str], rows: int = 0) -> DataFrame:
    """Rows of ``base`` whose key is not in ``other``; if that is known to have many ``rows``, both sides are shuffled."""
    keys = other.select(*[F.col(f"`{name}`").alias(f"_key_{name}") for name in key])
    same = reduce(and_, [F.col(f"`{name}`").eqNullSafe(F.col(f"`_key_{name}`")) for name in key])
    return base.join(keys.hint("merge") if rows > BROADCAST_KEYS else keys, same, "left_anti")


@dataclass(frozen=True)
class _Version:
    """A complete version folder; the batch's source and number if it had a token."""

    number: int
    source: str | None
    last: int
    path: str


class KeyedTable:
    """One writer at a time, any number of readers."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], unwatched: Sequence[str] = (), buckets: int = BUCKETS
    ):
        """A change in ``unwatched`` columns alone doesn't make a row a changed one."""
        self._spark = spark
        self._path = path.rstrip("/")
        self._schema = schema
        self._key = list(key)
        self._buckets = buckets
        hashed = F.xxhash64(*[F.col(f"`{name}`") for name in key])
        self._bucket = F.pmod(hashed, F.lit(buckets)).cast("int").alias("_bucket")
        values = [F.col(f"`{name}`") for name in schema.fieldNames() if name not in {*key, *unwatched}]
        self._digest = F.unhex(F.sha2(F.to_json(F.struct(F.lit(0), *values), {"ignoreNullFields": "false"}), 256))

    def _entries(self, path: str) -> list[str]:
        files, place = file_system(self._spark, path)
        return [entry.getPath().getName() for entry in files.listStatus(place)] if files.exists(place) else []

    def _exists(self, path: str) -> bool:
        files, place = file_system(self._spark, path)
        return files.exists(place)

    def _versions(self) -> list[_Version]:
        """Complete versions, oldest first."""
        found = []
        for name in self._entries(self._path):
            match = _VERSION.fullmatch(name)
            path = f"{self._path}/{name}"
            if match and self._exists(f"{path}/_SUCCESS"):
                found.append(_Version(int(match[1]), match[2], int(match[3] or -1), path))
        return sorted(found, key=lambda version: version.number)

    def _places(self, versions: Sequence[_Version]) -> dict[int, list[str]]:
        """Folders of each bucket, oldest first."""
        places: dict[int, list[str]] = {}
        for version in versions:
            for name in self._entries(version.path):
                if name.startswith("_bucket="):
                    places.setdefault(int(name.removeprefix("_bucket=")), []).append(f"{version.path}/{name}")
        return places

    def version(self) -> int:
        """Number of the newest version, -1 for a table never written."""
        return max((version.number for version in self._versions()), default=-1)

    def read(self) -> DataFrame:
        """Current rows, one per key."""
        return self._read(self._places(self._versions()))

    def _read(self, places: dict[int, list[str]]) -> DataFrame:
        if not places:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*[paths[-1] for paths in places.values()])

    def upsert(self, batch: DataFrame, order: Sequence[Column], token: str | None = None, greatest: str | None = None) -> Delivered:
        """Replace or add the batch's rows by key, where they differ from what is stored.

        Of several rows with one key the first under ``order`` counts. A batch
        with a ``token`` (``source/number``) is applied once: giving it, or an
        earlier one of its source, again changes nothing. The counts, and the
        greatest value of the column ``greatest``, are observed as the rows are written.
        """
        source, _, number = (token or "").rpartition("/")
        versions = self._versions()
        if token and any(version.source == source and version.last >= int(number) for version in versions):
            return Delivered(0, 0)
        places = self._places(versions)
        name = f"v{max((version.number for version in versions), default=-1) + 1}"
        path = f"{self._path}/{name}~{source}~{number}" if token else f"{self._path}/{name}"
        seen = Observation()
        most = F.max(greatest if greatest else F.lit(None).cast("bigint"))
        counted = [F.count(F.lit(1)).alias("rows"), most.alias("most")]
        columns = [f"`{name}`" for name in self._schema.fieldNames()]
        if not places:  # all rows are new
            rows = latest_rows(batch, self._key, order).select(*columns)
            self._write(rows, path, lambda spread: spread.observe(seen, *counted))
            if not seen.get["rows"]:
                release(self._spark, path)
            return Delivered(seen.get["rows"], seen.get["rows"], seen.get["most"])
        if batch.isEmpty():
            return Delivered(0, 0)
        scratch = scratch_path(self._spark)
        try:
            rows = self._beside_stored(batch, order, self._read(places))
            is_new = ~F.col("_had") | (self._digest != F.col("_before"))
            rows = rows.select(*columns, self._bucket, "_had", is_new.alias("_new")).observe(seen, *counted)
            rows.where("_new").drop("_new").write.parquet(scratch)
            written = self._apply(self._spark.read.schema(rows.drop("_new").schema).parquet(scratch), places, path, bool(token))
        finally:
            release(self._spark, scratch)
        return Delivered(seen.get["rows"], written, seen.get["most"])

    def _beside_stored(self, batch: DataFrame, order: Sequence[Column], stored: DataFrame) -> DataFrame:
        """The batch's first row of each key under ``order``, with whether the key is stored and its digest there.

        Stored keys go in among the batch's rows, each before those of its key,
        so one shuffle serves both, and two rows of a key at most leave a map task.
        """
        key = [F.col(f"`{name}`") for name in self._key]
        known = stored.select(*key, F.lit(True).alias("_stored"), self._digest.alias("_was"))
        both = batch.withColumn("_stored", F.lit(False)).unionByName(known, allowMissingColumns=True)
        window = Window.partitionBy(*key).orderBy(F.col("_stored").desc(), *order)
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        places = {"_place": F.row_number().over(window), "_had": F.first("_stored").over(upto), "_before": F.first("_was").over(upto)}
        return both.withColumns(places).where("_place <= 2").where("_place = if(_had, 2, 1)")

    def _apply(self, changed: DataFrame, places: dict[int, list[str]], path: str, marked: bool) -> int:
        """Write the buckets with changed rows as the version ``path``; returns the number of changed rows."""
        found = changed.groupBy("_bucket").agg(F.count(F.lit(1)), F.count_if("_had")).collect()  # the buckets at most
        counts, replaced = {row[0]: row[1] for row in found}, sum(row[2] for row in found)
        if counts:
            new = changed.select(*[f"`{name}`" for name in self._schema.fieldNames()])
            if counts.keys() & places.keys():
                old = self._read({bucket: paths for bucket, paths in places.items() if bucket in counts})
                kept = without_keys(old, changed.where("_had"), self._key, replaced) if replaced else old
                new = kept.unionByName(new)
            self._write(new, path)
        elif marked:
            self._spark.createDataFrame([], self._schema).write.mode("overwrite").parquet(path)  # for its token
        if counts or marked:
            self._tidy()
        return sum(counts.values())

    def _write(self, rows: DataFrame, path: str, watch: Callable[[DataFrame], DataFrame] = lambda spread: spread) -> None:
        """A version folder. A bucket with many rows is cut into several tasks' files, small ones share a task."""
        spread = rows.select("*", self._bucket).hint("rebalance", "_bucket")
        watch(spread).write.mode("overwrite").partitionBy("_bucket").parquet(path)

    def _tidy(self) -> None:
        """Remove what two newer versions of a bucket stand for, and folders that hold no bucket and no source's last token."""
        versions = self._versions()
        places = self._places(versions)
        for paths in places.values():
            for path in paths[:-2]:
                release(self._spark, path)
        used = {path.rpartition("/")[0] for paths in places.values() for path in paths[-2:]}
        last = {version.source: version.path for version in versions}
        for version in versions[:-1]:
            if version.path not in used and last[version.source] != version.path:
                release(self._spark, version.path)

"""Named tables: reading, views for staging, stored tables for marts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.sources.storage import file_system, release

STAR_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@lru_cache(maxsize=None)
def _stored_schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def read_star(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One of the star tables, a parquet file or folder each.

    The schema is taken from the files once per session, so naming a table
    again costs no job.
    """
    if name not in STAR_TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{directory}/{name}.parquet"
    return spark.read.schema(_stored_schema(spark, path)).parquet(path)


class TableFolder:
    """Stored tables under one shared folder, as ``<folder>/<schema>/<table>/v<number>``.

    A rebuild writes a new version beside the old one; the file that Spark
    writes last makes it the table. A reader that began before keeps its
    version until the rebuild after next, and a rebuild that dies leaves the
    table as it was. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, default_schema: str = "main"):
        self._spark = spark
        self.default_schema = default_schema
        self._folder = folder.rstrip("/")

    def path(self, schema: str, table: str) -> str:
        return f"{self._folder}/{schema}/{table}"

    def _versions(self, schema: str, table: str) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        files, place = file_system(self._spark, self.path(schema, table))
        if not files.exists(place):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(place)]
        numbers = sorted(int(name[1:]) for name in names if name[:1] == "v" and name[1:].isdigit())
        return [n for n in numbers if files.exists(file_system(self._spark, f"{place}/v{n}/_SUCCESS")[1])]

    def read(self, schema: str, table: str) -> DataFrame:
        versions = self._versions(schema, table)
        if not versions:
            raise FileNotFoundError(f"no table {schema}.{table} in {self._folder}")
        return self._spark.read.parquet(f"{self.path(schema, table)}/v{versions[-1]}")

    def rebuild(self, schema: str, table: str, rows: DataFrame) -> DataFrame:
        """Replace the stored table and return it as stored."""
        versions = self._versions(schema, table)
        number = versions[-1] + 1 if versions else 0
        rows.write.mode("overwrite").parquet(f"{self.path(schema, table)}/v{number}")
        for old in versions[:-1]:
            release(self._spark, f"{self.path(schema, table)}/v{old}")
        return self.read(schema, table)


def file_ranges(stored: DataFrame, key: str) -> DataFrame:
    """(path, rows, low, high) of each file of a stored table: its rows and the range of ``key`` in it."""
    path = F.col("_metadata.file_path").alias("path")
    return stored.select(path, key).groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))


def order_of_files(stored: DataFrame, key: str) -> DataFrame:
    """One row: schema and table name as the files' places say, rows, least and greatest key, files whose range another's cuts into."""
    files = file_ranges(stored, key)
    last = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    place = F.regexp_extract("path", r"/([^/]+)/([^/]+)/v\d+/[^/]+$", 1), F.regexp_extract("path", r"/([^/]+)/([^/]+)/v\d+/[^/]+$", 2)
    cut = files.withColumns({"cut": F.coalesce(last > F.col("low"), F.lit(False)), "schema": place[0], "table": place[1]})
    return cut.groupBy("schema", "table").agg(
        F.sum("rows").alias("rows"), F.min("low").cast("string").alias("low"), F.max("high").cast("string").alias("high"), F.count_if("cut").alias("cut_files")
    )


def register_views(tables: Mapping[str, DataFrame], names: Iterable[str] | None = None) -> None:
    """Make tables available to SQL under their names; nothing is computed."""
    for name in names if names is not None else tables:
        tables[name].createOrReplaceTempView(name)

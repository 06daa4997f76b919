"""The raw tables and the cursors of one store folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.naming import Naming
from tierloom.schemas import SYNCED_AT, raw_tables
from tierloom.sources.keyed_table import Delivered, KeyedTable

_CURSOR = "source string, last_id bigint"
_REJECTS = "source string, path string, line string"
_COUNTS = "source string, pass bigint, table string, rows bigint, written bigint"


class RawStore:
    def __init__(self, spark: SparkSession, path: str, naming: Naming = Naming()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.naming = naming
        self._tables = {
            name: KeyedTable(spark, f"{self.path}/raw/{name}", table.schema, table.key, unwatched=[SYNCED_AT])
            for name, table in raw_tables(naming).items()
        }
        counts = T.StructType.fromDDL(_COUNTS)
        self._counts = KeyedTable(spark, f"{self.path}/counts", counts, ["source", "pass", "table"], buckets=1)
        self._rejects = KeyedTable(spark, f"{self.path}/rejects", T.StructType.fromDDL(_REJECTS), ["source", "path", "line"])
        self._cursors = KeyedTable(spark, f"{self.path}/cursors", T.StructType.fromDDL(_CURSOR), ["source"], buckets=1)

    def table(self, name: str) -> KeyedTable:
        return self._tables[name]

    def read(self) -> dict[str, DataFrame]:
        """Current rows of all raw tables by name."""
        return {name: table.read() for name, table in self._tables.items()}

    def cursor(self, source: str, default: int | None = 0) -> int | None:
        """Largest id taken in from a source so far, ``default`` for none."""
        row = self._cursors.read().where(F.col("source") == source).first()
        return row["last_id"] if row else default

    def advance(self, source: str, last_id: int) -> None:
        """Each source has a cursor of its own; moving one leaves the others."""
        row = self.spark.createDataFrame([(source, last_id)], _CURSOR)
        self._cursors.upsert(row, [F.col("last_id").desc()])

    def cursors(self) -> DataFrame:
        """(source, last_id) of every source that has a cursor."""
        return self._cursors.read()

    def counts(self) -> DataFrame:
        """(source, pass, table, rows, written): keys delivered and rows changed by each pass over a source, from 1 on.

        For a stream a pass is a batch of it.
        """
        return self._counts.read()

    def record(self, counts: dict[str, dict[str, Delivered]], number: int | None = None) -> None:
        """Keep the counts of a finished pass, by source and table."""
        known = self._counts.read().where(F.col("source").isin(list(counts)))
        if number is None:
            number = (known.agg(F.max("pass")).first()[0] or 0) + 1
        rows = [(source, number, name, count.rows, count.written) for source, own in counts.items() for name, count in own.items()]
        # A batch that is given again delivers nothing; what was counted the first time stays.
        both = self.spark.createDataFrame(rows, _COUNTS).unionByName(known.where(F.col("pass") == number))
        self._counts.upsert(both, [F.col("rows").desc(), F.col("written").desc()])

    def reject(self, source: str, lines: DataFrame) -> Delivered:
        """Keep lines (path, line) that are no documents; a line that is met again is there already."""
        rows = lines.select(F.lit(source).alias("source"), "path", "line")
        return self._rejects.upsert(rows, [F.lit(0).asc()])

    def rejects(self) -> DataFrame:
        """(source, path, line): what was landed and is no document."""
        return self._rejects.read()

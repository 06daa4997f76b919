"""Row numbers over whole tables and over groups, of chosen rows, and top rows per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.sources.storage import materialize

#: Parts that a table is ranked in, for each shuffle partition; rows that a part has at least; sampled rows per border.
PARTS, PART_ROWS, SAMPLES = 4, 1 << 20, 32


@dataclass(frozen=True)
class Key:
    """A column to sort by."""

    column: str
    falling: bool = False
    nulls_first: bool = False

    def sort(self) -> Column:
        column = F.col(self.column)
        if self.falling:
            return column.desc_nulls_first() if self.nulls_first else column.desc_nulls_last()
        return column.asc_nulls_first() if self.nulls_first else column.asc_nulls_last()

    def flag(self, kind: T.DataType) -> Column:
        """What sorts, rising, before the value itself: NULLs at their end, and NaN above all numbers."""
        column = F.col(self.column)
        missing = F.when(column.isNull(), F.lit(0 if self.nulls_first else 4))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            missing = missing.when(F.isnan(column), F.lit(1 if self.falling else 3))
        return missing.otherwise(F.lit(2))

    def value(self, kind: T.DataType) -> Column:
        column = F.col(self.column)
        return F.nanvl(column, F.lit(0.0).cast(kind)) + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else column


def rising(column: str) -> Key:
    return Key(column, nulls_first=True)


def falling(column: str, nulls_first: bool = False) -> Key:
    return Key(column, True, nulls_first)


def sorts(order: Sequence[Key]) -> list[Column]:
    return [key.sort() for key in order]


def top_k(
    df: DataFrame, partition: Sequence[Column | str], order: Sequence[Column], k: int, out: str
) -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1.

    Spark keeps only ``k`` rows per group in each map task before the shuffle,
    so a group of any size sends little.
    """
    window = Window.partitionBy(*partition).orderBy(*order)
    kept = df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)
    return kept.withColumn(out, F.col(out).cast("bigint"))


def top_ranked(df: DataFrame, order: Sequence[Key], k: int, out: str) -> DataFrame:
    """The first ``k`` rows of the whole table, numbered from 1."""
    window = Window.orderBy(*sorts(order))
    return df.orderBy(*sorts(order)).limit(k).withColumn(out, F.row_number().over(window).cast("bigint"))


def _narrow(order: Sequence[Key]) -> list[Column]:
    return [F.col(key.column).alias(f"k{i}") for i, key in enumerate(order)]


def _renamed(order: Sequence[Key]) -> list[Key]:
    return [Key(f"k{i}", key.falling, key.nulls_first) for i, key in enumerate(order)]


def _by_first_key(borders: pa.StructArray, rows: pa.StructArray, falls: bool) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest number of borders that may sort at or before each row, by the first key if that is a number."""
    low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(borders))
    value = rows.field("v0")
    if not (pa.types.is_integer(value.type) or pa.types.is_floating(value.type)):
        return low, high
    flags = borders.field("f0").to_numpy()
    kept = np.flatnonzero(flags == 2)
    own = borders.field("v0").take(pa.array(kept)).cast(value.type).to_numpy()
    plain = np.flatnonzero(rows.field("f0").to_numpy() == 2)
    mine = value.take(pa.array(plain)).to_numpy()
    before = int((flags < 2).sum())
    if falls:
        low[plain], high[plain] = (before + len(own) - np.searchsorted(own[::-1], mine, side) for side in ("right", "left"))
    else:
        low[plain], high[plain] = (before + np.searchsorted(own, mine, side) for side in ("left", "right"))
    return low, high


def _among(borders: pa.StructArray, rows: pa.StructArray, directions: list[tuple[str, str]]) -> np.ndarray:
    """Number of borders that sort at or before each row, by all keys."""
    columns = [pa.chunked_array([a.cast(b.type), b]) for a, b in zip(borders.flatten(), rows.flatten(), strict=True)]
    is_row = np.arange(len(borders) + len(rows)) >= len(borders)
    both = pa.table([*columns, pa.array(is_row)], [*(name for name, _ in directions), "row"])  # of equals the border comes first
    sorted_ = pc.sort_indices(both, [*directions, ("row", "ascending")]).to_numpy()
    places = np.empty(len(sorted_), np.int64)
    places[sorted_] = np.cumsum(~is_row[sorted_])
    return places[len(borders) :]


def with_place(df: DataFrame, order: Sequence[Key], borders: Sequence[Row], kinds: T.StructType, out: str) -> DataFrame:
    """``df`` with the number of ``borders`` that sort at or before each row.

    ``borders`` are rows of the order's columns (of types ``kinds``), in order. They are constants of the plan, and each
    batch of rows is sorted among them; so a row's place depends on its own key alone.
    """
    if not borders:
        return df.withColumn(out, F.lit(0))

    def fields(keys: Sequence[Key]) -> Column:
        pairs = zip(keys, kinds.fields, strict=True)
        return F.struct(*[c for i, (key, kind) in enumerate(pairs) for c in (key.flag(kind.dataType).alias(f"f{i}"), key.value(kind.dataType).alias(f"v{i}"))])

    local = df.sparkSession.createDataFrame([tuple(border) for border in borders], kinds)
    constant = local.select(fields(_renamed(order)).alias("key")).toArrow()["key"].combine_chunks()
    directions = [(f"{c}{i}", d) for i, key in enumerate(order) for c, d in (("f", "ascending"), ("v", "descending" if key.falling else "ascending"))]

    @F.arrow_udf("int")
    def place(rows: pa.Array) -> pa.Array:
        low, high = _by_first_key(constant, rows, order[0].falling)
        tied = np.flatnonzero(low < high)
        if tied.size:
            low[tied] = _among(constant, rows.take(pa.array(tied)), directions)
        return pa.array(low.astype(np.int32))

    return df.withColumn(out, place(fields(order)))


def ranks_of(df: DataFrame, chosen: DataFrame, order: Sequence[Key], ranks: Mapping[str, Column | None]) -> DataFrame:
    """A few ``chosen`` rows of ``df`` with their row numbers in it, without ranking the others.

    ``ranks`` has, per output column, which rows of ``df`` count (None: all).

    ``chosen`` must be bounded by its own definition: its rows come to the
    driver, and their keys, in order, are thresholds. One scan of the order's
    columns counts the rows between them, and running sums of those counts are
    the ranks. ``order`` must be a total order.
    """
    rows = chosen.orderBy(*sorts(order)).collect()
    spark = df.sparkSession
    numbered = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], T.StructType([T.StructField("_at", T.IntegerType()), *chosen.schema]))
    counts = {f"_c{i}": F.lit(True) if rows_ is None else rows_ for i, rows_ in enumerate(ranks.values())}
    keys = df.select(*_narrow(order), *[counts_.alias(name) for name, counts_ in counts.items()])
    kinds = T.StructType(keys.schema.fields[: len(order)])
    places = with_place(keys, _renamed(order), [[row[key.column] for key in order] for row in rows], kinds, "_at")
    counted = places.groupBy("_at").agg(*[F.count_if(name).alias(name) for name in counts])
    # Rows before a threshold have reached neither it nor a later one. There is one row per threshold here, and one more.
    none = [F.lit(0).cast("bigint").alias(name) for name in counts]
    every = counted.unionByName(numbered.select("_at", *none)).groupBy("_at").agg(*[F.sum(name).alias(name) for name in counts])
    upto = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    found = every.select("_at", *[(F.sum(name).over(upto) + 1).alias(out) for name, out in zip(counts, ranks, strict=True)])
    return numbered.join(found, "_at").select(*chosen.columns, *ranks)


def rank_rows(df: DataFrame, order: Sequence[Key], ranks: Mapping[str, Sequence[Column | str]]) -> DataFrame:
    """Add one row number per entry of ``ranks`` (output column -> grouping columns).

    ``order`` must be a total order, and all ranks share it. An empty grouping
    numbers the whole table.

    The columns of the order and the groups, and they alone, are written down once. Borders
    of ranges are sampled from them and kept as constants, so the range that a row belongs to is a function of its key,
    whenever and wherever it is computed. A number is the row's place among its
    group in its range, plus the group's rows in earlier ranges; one shuffle by
    range serves all ranks, and no task ever holds a whole group. Ties are
    settled by the total order, so even a value that a third of the rows share
    is cut into even ranges.
    """
    spark = df.sparkSession
    groups = {f"_group_{out}": F.struct(*[_as_column(item).alias(f"g{i}") for i, item in enumerate(items)]) for out, items in ranks.items() if items}
    narrow = df.select(*_narrow(order), *[group.alias(name) for name, group in groups.items()])
    seen = Observation()
    narrow = materialize(narrow.observe(seen, F.count(F.lit(1)).alias("rows")))
    total, own = seen.get["rows"], _renamed(order)
    kinds = T.StructType(narrow.schema.fields[: len(order)])

    parts = min(PARTS * int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART_ROWS + 1)
    every = max(1, total // (SAMPLES * parts))
    sampled = narrow.where(F.pmod(F.xxhash64(*kinds.names), F.lit(every)) == 0).select(*kinds.names)
    # About SAMPLES rows a part, so one task can number them.
    placed = sampled.withColumn("_n", F.row_number().over(Window.orderBy(*sorts(own))))
    borders = placed.where(F.col("_n") % SAMPLES == 0).orderBy("_n").drop("_n").collect() if parts > 1 else []

    sizes = with_place(narrow, own, borders, kinds, "_part").groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_size"))
    result = with_place(df.withColumns(groups), order, borders, kinds, "_part").repartition("_part")
    for out, items in ranks.items():
        group = [f"_group_{out}"] if items else []
        mine = sizes.groupBy("_part", *group).agg(F.sum("_size").alias("_size"))
        earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
        local = F.row_number().over(Window.partitionBy("_part", *group).orderBy(*sorts(order)))
        numbered = result.withColumn("_local", local).join(mine.select("_part", *group, before), ["_part", *group])
        result = numbered.withColumn(out, F.col("_local") + F.col("_before")).drop("_local", "_before")
    return result.select(*df.columns, *ranks)


def _as_column(item: Column | str) -> Column:
    return F.col(item) if isinstance(item, str) else item

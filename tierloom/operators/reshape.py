"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_max(
    df: DataFrame, keys: Sequence[str], name: str, value: str, mapping: Mapping[object, str]
) -> DataFrame:
    """One row per key with the largest value of each named entry; other names are ignored.

    A single grouped pass: each map task sends at most one row per key, so a
    key with very many rows costs no more than any other in the shuffle.
    """
    cells = [
        F.max(F.when(F.col(name) == F.lit(entry), F.col(value))).alias(column)
        for entry, column in mapping.items()
    ]
    return df.groupBy(*keys).agg(*cells)


def unpivot_cols(
    df: DataFrame,
    ids: Sequence[str],
    mapping: Mapping[str, str],
    name: str,
    value: str,
    keep_nulls: bool = False,
) -> DataFrame:
    """One row per (input row, column); ``mapping`` gives column -> published name."""
    picked = df.select(*ids, *[F.col(column).alias(label) for column, label in mapping.items()])
    long = picked.unpivot(list(ids), list(mapping.values()), name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def matrix_wide(
    df: DataFrame, row: str, column: str, value: str, values: Sequence[str], missing: object = None
) -> DataFrame:
    """Two-way table: a row per ``row`` value and a column per listed value, empty cells filled with ``missing``.

    The values are always named: finding them would take a pass of its own, and their number has no bound.
    """
    wide = df.groupBy(row).pivot(column, list(values)).agg(F.first(value))
    return wide if missing is None else wide.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(missing)).alias(v) for v in values])

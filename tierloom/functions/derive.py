"""Column rules: every function returns a built-in column expression, no UDF."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.constants import LEGENDARY, LOWEST_TIER, MYTHICAL


def url_last_id(url: Column, missing_ok: bool = False) -> Column:
    """Integer in the last path segment of a resource URL, trailing slashes ignored.

    Without ``missing_ok`` a non-null URL with no such number is an error.
    """
    digits = F.regexp_extract(url, r"/(\d+)/*$", 1)
    return digits.try_cast("bigint") if missing_ok else digits.cast("bigint")


def tier(value: Column, thresholds: Sequence[tuple[float, str]], lowest: str = LOWEST_TIER) -> Column:
    """Name of the highest threshold reached; a NULL value falls to ``lowest``."""
    label = F.lit(lowest)
    for floor, name in sorted(thresholds):
        label = F.when(value >= F.lit(floor), F.lit(name)).otherwise(label)
    return label


def bucket(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first exclusive upper bound above the value, the last label beyond all."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    label = F.lit(labels[-1])
    for bound, name in reversed(list(zip(bounds, labels))):
        label = F.when(value < F.lit(bound), F.lit(name)).otherwise(label)
    return label


def expected_value(amount: Column, percent: Column) -> Column:
    """Amount times percent / 100 as double: 0 without amount, the amount without percent."""
    whole = amount.cast("double")
    scaled = whole * percent.cast("double") / F.lit(100.0)
    return F.when(amount.isNull(), F.lit(0.0)).otherwise(F.coalesce(scaled, whole))


def row_total(columns: Iterable[str]) -> Column:
    """Sum across columns with NULL counted as zero."""
    total = F.lit(0)
    for name in columns:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total


def any_match(value: Column, *candidates: Column) -> Column:
    """True if the value equals any candidate, never NULL."""
    result = F.lit(False)
    for candidate in candidates:
        result = result | (value == candidate)
    return F.coalesce(result, F.lit(False))


def category(is_mythical: Column, is_legendary: Column, fallback: Column) -> Column:
    """Rarity name of a flagged row, ``fallback`` for the rest."""
    return (
        F.when(is_mythical, F.lit(MYTHICAL))
        .when(is_legendary, F.lit(LEGENDARY))
        .otherwise(fallback)
    )


def lower_columns(df: DataFrame) -> DataFrame:
    """The same rows under lower-case column names."""
    return df.toDF(*[name.lower() for name in df.columns])

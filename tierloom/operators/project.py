"""Typed projection: cast, rename, drop rows without a key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Projection:
    """``columns`` holds (input column, Spark type, published name)."""

    columns: Sequence[tuple[str, str, str]]
    required: Sequence[str]


def project(df: DataFrame, spec: Projection) -> DataFrame:
    """Rows with all required columns, cast and renamed.

    A value that does not fit its type is an error, as ANSI mode casts raise.
    Only filters and column expressions, so both reach the file scan.
    """
    present = F.lit(True)
    for name in spec.required:
        present = present & F.col(f"`{name}`").isNotNull()
    return df.where(present).select(
        *[F.col(f"`{name}`").cast(kind).alias(published) for name, kind, published in spec.columns]
    )

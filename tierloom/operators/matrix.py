"""Pairwise relations: known pairs from relation rows; neutral cells only for names a caller lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.constants import DOCUMENTED_RELATIONS, NEUTRAL_LABEL, NEUTRAL_MULTIPLIER

Relations = Sequence[tuple[str, float, str]]


def axis_values(relations: DataFrame, source: str) -> DataFrame:
    """Names that have at least one relation row as its source."""
    return relations.select(source).distinct()


def _flagged_pairs(
    relations: DataFrame, source: str, target: str, relation: str, mapping: Relations
) -> DataFrame:
    """Each pair once, with a flag per mapped relation; one grouped pass."""
    used = sorted({name for name, _, _ in mapping})
    flags = [F.max(F.col(relation) == F.lit(name)).alias(f"_{name}") for name in used]
    keys = (F.col(source).alias("attacking_type"), F.col(target).alias("defending_type"))
    return relations.groupBy(*keys).agg(*flags)


def _valued(pairs: DataFrame, mapping: Relations) -> DataFrame:
    """Pairs with at least one mapped relation: first multiplier that applies, last label that does."""
    multiplier = F.coalesce(*[F.when(F.col(f"_{name}"), F.lit(value)) for name, value, _ in mapping])
    label = F.coalesce(*[F.when(F.col(f"_{name}"), F.lit(text)) for name, _, text in reversed(mapping)])
    return pairs.select(
        "attacking_type",
        "defending_type",
        multiplier.alias("effectiveness_multiplier"),
        label.alias("effectiveness_label"),
    ).where(F.col("effectiveness_multiplier").isNotNull())


def relation_pairs(
    relations: DataFrame, source: str, target: str, relation: str, mapping: Relations = DOCUMENTED_RELATIONS
) -> DataFrame:
    """Multiplier and label of every pair that has a mapped relation, as
    (attacking_type, defending_type, effectiveness_multiplier, effectiveness_label).

    The multiplier comes from the first matching entry of ``mapping``, the
    label from the last one. There is no bound on the number of names.
    """
    known = relations.where(F.col(relation).isin([name for name, _, _ in mapping]))
    return _valued(_flagged_pairs(known, source, target, relation, mapping), mapping)


def relation_matrix(
    pairs: DataFrame, names: Sequence[str], neutral: tuple[float, str] = (NEUTRAL_MULTIPLIER, NEUTRAL_LABEL)
) -> DataFrame:
    """The cells of ``relation_pairs`` rows among the listed ``names``, unknown pairs filled in as neutral.

    Only the names that the caller lists are laid out; pairs of any other name stay out.
    """
    spark = pairs.sparkSession
    listed = F.explode(F.array(*[F.lit(name) for name in names]))
    rows = spark.range(1).select(listed.alias("attacking_type"))
    grid = rows.select("attacking_type", listed.alias("defending_type"))
    return _filled(grid, pairs, neutral)


def matrix_row(
    pairs: DataFrame, name: str, names: Sequence[str], neutral: tuple[float, str] = (NEUTRAL_MULTIPLIER, NEUTRAL_LABEL)
) -> DataFrame:
    """One attacking name against each listed name."""
    against = F.explode(F.array(*[F.lit(other) for other in names])).alias("defending_type")
    grid = pairs.sparkSession.range(1).select(F.lit(name).alias("attacking_type"), against)
    return _filled(grid, pairs.where(F.col("attacking_type") == F.lit(name)), neutral)


def _filled(grid: DataFrame, pairs: DataFrame, neutral: tuple[float, str]) -> DataFrame:
    value, label = neutral
    return grid.join(pairs, ["attacking_type", "defending_type"], "left").select(
        "attacking_type",
        "defending_type",
        F.coalesce("effectiveness_multiplier", F.lit(value)).alias("effectiveness_multiplier"),
        F.coalesce("effectiveness_label", F.lit(label)).alias("effectiveness_label"),
    )

"""Report queries over the marts. Parameters become column expressions, never SQL text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.constants import (
    APP_LEGENDARIES,
    APP_MOVES,
    APP_POWER_LABELS,
    APP_TOP,
    COMPARE_DEFAULT,
    DAMAGING_CLASSES,
    DEFAULT_STATS,
    NEUTRAL_MULTIPLIER,
    POWER_BOUNDS,
    STAT_COLUMNS,
    TILE_LEGENDARIES,
    TILE_MOVES,
    TILE_TOP,
)
from tierloom.functions.derive import bucket, category
from tierloom.naming import Naming
from tierloom.operators.matrix import axis_values, matrix_row
from tierloom.operators.rank import top_k
from tierloom.operators.reshape import matrix_wide, unpivot_cols

_TYPES = ("primary_type", "secondary_type")
_FLAGS = ("is_legendary", "is_mythical")


def _rare() -> Column:
    return F.col("is_legendary") | F.col("is_mythical")


def _common() -> Column:
    """Neither flag set; a NULL flag does not count as unset."""
    return ~F.col("is_legendary") & ~F.col("is_mythical")


def count_rows(df: DataFrame, out: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def total_entities(dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    return count_rows(dim, f"total_{naming.entity}")


def total_moves(moves: DataFrame) -> DataFrame:
    return count_rows(moves, "total_moves")


def total_rare(dim: DataFrame) -> DataFrame:
    return count_rows(dim.where(_rare()), "legendary_and_mythical")


def total_dual_type(dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    return count_rows(dim.where(F.col("secondary_type").isNotNull()), f"dual_type_{naming.entity}")


def scorecard(dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Three counts in one pass; a count of nothing is NULL, as a sum over no row is."""
    return dim.agg(
        F.count(F.lit(1)).alias(f"total_{naming.entity}"),
        F.sum(F.when(_rare(), F.lit(1))).alias("legendary_mythical"),
        F.sum(F.when(F.col("secondary_type").isNotNull(), F.lit(1))).alias("dual_type"),
    )


def _first_ranks(mart: DataFrame, top: int, columns: Sequence[str]) -> DataFrame:
    return mart.where(F.col("overall_rank") <= top).select("overall_rank", *columns).orderBy("overall_rank")


def tile_attackers(mart: DataFrame, naming: Naming = Naming(), top: int = TILE_TOP) -> DataFrame:
    columns = [naming.name, *_TYPES, "attack", "sp_attack", "total_base_stats", "tier", *_FLAGS]
    return _first_ranks(mart, top, columns)


_DEFENDER = ("hp", "defense", "sp_defense", "combined_defensive_stat", "total_base_stats", "tier")


def tile_defenders(mart: DataFrame, naming: Naming = Naming(), top: int = TILE_TOP) -> DataFrame:
    return _first_ranks(mart, top, [naming.name, *_TYPES, *_DEFENDER, *_FLAGS])


def tile_legendaries(mart: DataFrame, naming: Naming = Naming(), top: int = TILE_LEGENDARIES) -> DataFrame:
    columns = [naming.name, "primary_type", "rarity_tier", "total_base_stats", "attack", "defense", "hp"]
    return _first_ranks(mart, top, [*columns, "generation"])


def count_by(df: DataFrame, column: str, out: str = "count", order: Sequence[Column] | None = None) -> DataFrame:
    """Rows per value, NULL left out; ordered by value unless told otherwise."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return counted.orderBy(*(order or [F.col(column).asc()]))


def count_by_primary_type(dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    order = [F.col(naming.count).desc(), F.col("primary_type").asc()]
    return count_by(dim, "primary_type", naming.count, order)


def count_by_tier(mart: DataFrame, naming: Naming = Naming()) -> DataFrame:
    return count_by(mart, "tier", naming.count)


def count_by_generation(mart: DataFrame) -> DataFrame:
    return count_by(mart, "generation")


def count_by_rarity(mart: DataFrame) -> DataFrame:
    return count_by(mart, "rarity_tier")


_MOVE = ("move_name", "move_type", "damage_class", "power", "accuracy", "expected_damage", "is_stab")


def tile_moves(mart: DataFrame, naming: Naming = Naming(), top: int = TILE_MOVES) -> DataFrame:
    """Most damaging moves of all; Spark keeps ``top`` rows per task, without a full sort."""
    order = [
        F.col("expected_damage").desc_nulls_last(),
        F.col(naming.name).asc_nulls_first(),
        F.col("move_rank").asc(),
        F.col(naming.id).asc(),
    ]
    return mart.orderBy(*order).limit(top).select(naming.name, "primary_type", "move_rank", *_MOVE)


def app_moves(
    mart: DataFrame,
    naming: Naming = Naming(),
    stab_only: bool = False,
    damage_class: str | None = None,
    top: int = APP_MOVES,
) -> DataFrame:
    """The same ranking narrowed by optional filters."""
    wanted = [F.lit(True)]
    if stab_only:
        wanted.append(F.col("is_stab"))
    if damage_class is not None:
        wanted.append(F.col("damage_class") == F.lit(damage_class))
    order = [F.col("expected_damage").desc_nulls_last(), F.col(naming.id).asc(), F.col("move_rank").asc()]
    rows = mart.where(reduce(and_, wanted)).orderBy(*order).limit(top)
    return rows.select(naming.name, "primary_type", *_MOVE, "move_rank")


def _app_ranked(mart: DataFrame, columns: Sequence[str], top: int, with_rare: bool) -> DataFrame:
    rows = mart if with_rare else mart.where(_common())
    return rows.orderBy("overall_rank").limit(top).select(*columns, "overall_rank")


def app_attackers(
    mart: DataFrame, naming: Naming = Naming(), top: int = APP_TOP, with_rare: bool = True
) -> DataFrame:
    columns = [naming.name, *_TYPES, "attack", "sp_attack", "total_base_stats", "tier", *_FLAGS]
    return _app_ranked(mart, columns, top, with_rare)


def app_defenders(
    mart: DataFrame, naming: Naming = Naming(), top: int = APP_TOP, with_rare: bool = True
) -> DataFrame:
    return _app_ranked(mart, [naming.name, *_TYPES, *_DEFENDER, *_FLAGS], top, with_rare)


def app_legendaries(mart: DataFrame, naming: Naming = Naming()) -> DataFrame:
    columns = ["overall_rank", naming.name, *_TYPES, "rarity_tier", "generation", "total_base_stats"]
    return mart.select(*columns, *STAT_COLUMNS.values()).orderBy("overall_rank")


def head_legendaries(mart: DataFrame, naming: Naming = Naming(), top: int = APP_LEGENDARIES) -> DataFrame:
    return app_legendaries(mart, naming).limit(top)


def defender_breakdown(defenders: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Defensive columns one below the other, NULL values kept."""
    stats = {name: name for name in ("hp", "defense", "sp_defense")}
    return unpivot_cols(defenders, [naming.name], stats, "stat", "value", keep_nulls=True)


def compare(
    legendaries: DataFrame, names: Sequence[str] | None = None, naming: Naming = Naming()
) -> DataFrame:
    """Closed stat vector (first stat repeated) of named entities.

    Without names the first three by rank are taken. A name held by several
    entities stands for the best ranked one.
    """
    first, *rest = STAT_COLUMNS.values()
    if names is None:
        rows = legendaries.orderBy("overall_rank").limit(COMPARE_DEFAULT)
    else:
        rows = legendaries.where(F.col(naming.name).isin(list(names)))
    one_each = top_k(rows, [naming.name], [F.col("overall_rank").asc()], 1, "_match")
    return one_each.select(naming.name, F.array(first, *rest, first).alias("stats"))


def effectiveness_rows(pairs: DataFrame, with_label: bool = True) -> DataFrame:
    """The known pairs; every other pair is neutral."""
    columns = ["attacking_type", "defending_type", "effectiveness_multiplier"]
    if with_label:
        columns.append("effectiveness_label")
    return pairs.select(*columns).orderBy("attacking_type", "defending_type")


def effectiveness_wide(pairs: DataFrame, values: Sequence[str]) -> DataFrame:
    return matrix_wide(
        pairs, "attacking_type", "defending_type", "effectiveness_multiplier", values, NEUTRAL_MULTIPLIER
    )


def attacking_types(types: DataFrame) -> DataFrame:
    """Types that have a relation row, from the staged relations."""
    return axis_values(types, "type_name").select(F.col("type_name").alias("attacking_type")).orderBy("attacking_type")


def one_attacker(pairs: DataFrame, attacking_type: str, against: Sequence[str]) -> DataFrame:
    """One type against each listed type, strongest first."""
    return matrix_row(pairs, attacking_type, against).orderBy(
        F.col("effectiveness_multiplier").desc(), "defending_type"
    )


def long_stats(fact: DataFrame, ids: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """The wide fact as (stat_name, base_stat_value) under the delivered stat names."""
    mapping = {column: stat for stat, column in STAT_COLUMNS.items()}
    return unpivot_cols(fact, ids, mapping, "stat_name", "base_stat_value", keep_nulls)


def average_stats(fact: DataFrame, dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Average of each stat per primary type, to one decimal.

    The six averages are taken in one pass over the wide rows and only then
    laid out one per row, so rows are never multiplied. A stat that no row of
    a type has gives no row.
    """
    typed = fact.join(dim.where(F.col("primary_type").isNotNull()).select(naming.id, "primary_type"), naming.id)
    averages = [F.round(F.avg(column), 1).alias(column) for column in STAT_COLUMNS.values()]
    wide = typed.groupBy("primary_type").agg(*averages)
    mapping = {column: stat for stat, column in STAT_COLUMNS.items()}
    long = unpivot_cols(wide, ["primary_type"], mapping, "stat_name", "avg_base_stat")
    return long.orderBy("primary_type", "stat_name")


def choose_stats(averages: DataFrame, stats: Sequence[str] = DEFAULT_STATS) -> DataFrame:
    return averages.where(F.col("stat_name").isin(list(stats)))


def power_histogram(moves: DataFrame, labels: Sequence[str] = APP_POWER_LABELS) -> DataFrame:
    """Damaging moves per class and power bucket."""
    usable = moves.where(F.col("power").isNotNull() & F.col("damage_class").isin(list(DAMAGING_CLASSES)))
    counted = usable.groupBy(
        "damage_class", bucket(F.col("power"), POWER_BOUNDS, labels).alias("power_bucket")
    ).agg(F.count(F.lit(1)).alias("move_count"))
    return counted.orderBy("damage_class", "power_bucket")


def _scatter(fact: DataFrame, dim: DataFrame, dim_columns: Sequence[str], naming: Naming) -> DataFrame:
    placed = fact.where(F.col("attack").isNotNull() & F.col("defense").isNotNull())
    return placed.join(dim.select(naming.id, *dim_columns), naming.id)


def scatter_common(fact: DataFrame, dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Attack and defense of entities known to be neither legendary nor mythical."""
    columns = [naming.name, "primary_type", "attack", "defense", "hp", "total_base_stats"]
    return _scatter(fact, dim.where(_common()), ["primary_type"], naming).select(*columns)


def scatter_all(
    fact: DataFrame, dim: DataFrame, naming: Naming = Naming(), with_category: bool = False
) -> DataFrame:
    """Attack and defense of all entities, with flags and, if asked for, their colour category."""
    columns = [naming.name, "primary_type", "attack", "defense", "hp", "total_base_stats", *_FLAGS]
    rows = _scatter(fact, dim, ["primary_type", *_FLAGS], naming).select(*columns)
    if not with_category:
        return rows
    return rows.withColumn(
        "category", category(F.col("is_mythical"), F.col("is_legendary"), F.col("primary_type"))
    )

"""Mart layer: dimensions, the wide fact and the ranked tables.

Every function is lazy and names no join strategy: Spark measures both sides
and broadcasts, shuffles or splits hot keys by itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.constants import (
    ATTACK_TIERS,
    DAMAGING_CLASSES,
    DEFENSE_TIERS,
    DOCUMENTED_RELATIONS,
    LEGENDARY,
    MOVES_PER_ENTITY,
    MYTHICAL,
    STAT_COLUMNS,
    TYPE_SLOTS,
)
from tierloom.functions.derive import any_match, category, expected_value, row_total, tier
from tierloom.naming import Naming
from tierloom.operators.matrix import relation_pairs
from tierloom.operators.rank import Key, falling, rank_rows, ranks_of, rising, sorts, top_k, top_ranked
from tierloom.operators.reshape import pivot_max
from tierloom.sources.storage import materialize
from tierloom.sources.tables import TableFolder

Tables = Mapping[str, DataFrame]


def dim_entity(staged: Tables, naming: Naming = Naming()) -> DataFrame:
    """Entities with their first two types and species attributes; unmatched sides stay NULL."""
    n = naming
    types = pivot_max(staged[n.staging(n.raw("types"))], [n.id], "type_slot", "type_name", TYPE_SLOTS)
    entities = staged[n.staging(n.raw())].join(types, n.id, "left")
    return entities.join(staged[n.staging("species")].drop("synced_at"), "species_id", "left").select(
        n.id,
        n.name,
        "base_experience",
        "height_decimeters",
        "weight_hectograms",
        "is_default_form",
        n.order_column,
        *TYPE_SLOTS.values(),
        "species_name",
        "capture_rate",
        "base_happiness",
        "is_legendary",
        "is_mythical",
        "generation",
        "habitat",
        "body_shape",
    )


def dim_moves(staged: Tables, naming: Naming = Naming()) -> DataFrame:
    """Moves with the damage to expect of one use."""
    return staged[naming.staging("moves")].select(
        "move_id",
        "move_name",
        "move_type",
        "power",
        "accuracy",
        "pp",
        "damage_class",
        "effect_chance",
        expected_value(F.col("power"), F.col("accuracy")).alias("expected_damage"),
    )


def fct_stats(staged: Tables, naming: Naming = Naming()) -> DataFrame:
    """One row per known entity: six stats and their total."""
    n = naming
    stats = staged[n.staging(n.raw("stats"))]
    wide = pivot_max(stats, [n.id], "stat_name", "base_stat_value", STAT_COLUMNS)
    names = staged[n.staging(n.raw())].select(n.id, n.name)
    return wide.join(names, n.id).select(
        n.id, n.name, *STAT_COLUMNS.values(), row_total(STAT_COLUMNS.values()).alias("total_base_stats")
    )


def _fact_with(fact: DataFrame, dim: DataFrame, columns: Sequence[str], naming: Naming) -> DataFrame:
    return fact.join(dim.select(naming.id, *columns), naming.id)


def attacker_order(naming: Naming = Naming(), sp_attack_nulls_first: bool = True) -> list[Key]:
    """By attack, then special attack, then id."""
    return [falling("attack"), falling("sp_attack", sp_attack_nulls_first), rising(naming.id)]


def attacker_rows(fact: DataFrame, dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """The attackers' mart without its ranks; lazy, so a reader of few columns or rows computes no more."""
    n = naming
    fighters = fact.where(F.col("attack") > 0)
    return _fact_with(fighters, dim, [*TYPE_SLOTS.values(), "is_legendary", "is_mythical"], n).select(
        n.id,
        n.name,
        *TYPE_SLOTS.values(),
        "attack",
        "sp_attack",
        "total_base_stats",
        "is_legendary",
        "is_mythical",
        tier(F.col("attack"), ATTACK_TIERS).alias("tier"),
    )


_WITHIN_STATUS = {"overall_rank": [], "rank_within_legendary_status": ["is_legendary"]}


def top_attackers(
    fact: DataFrame, dim: DataFrame, naming: Naming = Naming(), sp_attack_nulls_first: bool = True
) -> DataFrame:
    """Attackers with their ranks."""
    return rank_rows(attacker_rows(fact, dim, naming), attacker_order(naming, sp_attack_nulls_first), _WITHIN_STATUS)


def first_common(rows: DataFrame, order: Sequence[Key], k: int) -> DataFrame:
    """The first ``k`` rows known to be neither legendary nor mythical, with their overall rank among all ``rows``."""
    common = rows.where(~F.col("is_legendary") & ~F.col("is_mythical"))
    return ranks_of(rows, common.orderBy(*sorts(order)).limit(k), order, {"overall_rank": None})


def named_rows(rows: DataFrame, names: Sequence[str], order: Sequence[Key], naming: Naming = Naming()) -> DataFrame:
    """The best row of each name, with its overall rank among all ``rows``."""
    best = top_k(rows.where(F.col(naming.name).isin(list(names))), [naming.name], sorts(order), 1, "_match")
    return ranks_of(rows, best.drop("_match"), order, {"overall_rank": None})


def first_attackers(fact: DataFrame, dim: DataFrame, k: int, naming: Naming = Naming()) -> DataFrame:
    """The first ``k`` attackers with their overall rank; the others are never ranked."""
    return top_ranked(attacker_rows(fact, dim, naming), attacker_order(naming), k, "overall_rank")


def defender_order(naming: Naming = Naming()) -> list[Key]:
    """By defense plus hp, then id."""
    return [falling("combined_defensive_stat"), rising(naming.id)]


def defender_rows(fact: DataFrame, dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """The defenders' mart without its ranks."""
    n = naming
    both = F.col("defense") + F.col("hp")
    standing = fact.where((F.col("defense") > 0) & (F.col("hp") > 0))
    return _fact_with(standing, dim, [*TYPE_SLOTS.values(), "is_legendary", "is_mythical"], n).select(
        n.id,
        n.name,
        *TYPE_SLOTS.values(),
        "hp",
        "defense",
        "sp_defense",
        both.alias("combined_defensive_stat"),
        "total_base_stats",
        "is_legendary",
        "is_mythical",
        tier(both, DEFENSE_TIERS).alias("tier"),
    )


def top_defenders(fact: DataFrame, dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Defenders with their ranks."""
    return rank_rows(defender_rows(fact, dim, naming), defender_order(naming), _WITHIN_STATUS)


def first_defenders(fact: DataFrame, dim: DataFrame, k: int, naming: Naming = Naming()) -> DataFrame:
    """The first ``k`` defenders with their overall rank."""
    return top_ranked(defender_rows(fact, dim, naming), defender_order(naming), k, "overall_rank")


def best_movesets(
    learned: DataFrame, moves: DataFrame, dim: DataFrame, naming: Naming = Naming()
) -> DataFrame:
    """The strongest damaging moves of each entity, with the same-type flag.

    Moves are sorted once, strongest first, and numbered in that order; the numbers have gaps and are written down, so
    they never change. What an entity learned carries the number alone through the shuffle by entity; the other columns
    of a move are fetched for the winners. An entity that has a move several times may have it several times among its
    strongest.
    """
    n = naming
    usable = moves.where(F.col("damage_class").isin(list(DAMAGING_CLASSES)) & F.col("power").isNotNull()).select(
        "move_id", "move_name", "move_type", "power", "accuracy", "damage_class", "expected_damage"
    )
    order = [falling("power"), falling("expected_damage"), rising("move_name"), rising("move_id")]
    strongest = materialize(usable.orderBy(*sorts(order)).withColumn("_strength", F.monotonically_increasing_id()))
    options = learned.select(n.id, "move_name").join(strongest.select("move_name", "_strength"), "move_name").drop("move_name")
    best = top_k(options, [n.id], [F.col("_strength")], MOVES_PER_ENTITY, "move_rank").join(strongest, "_strength")
    same_type = any_match(F.col("move_type"), *[F.col(column) for column in TYPE_SLOTS.values()])
    return best.join(dim.select(n.id, n.name, *TYPE_SLOTS.values()), n.id).select(
        n.id,
        n.name,
        *TYPE_SLOTS.values(),
        "move_name",
        "move_type",
        "power",
        "accuracy",
        "damage_class",
        "expected_damage",
        "move_rank",
        same_type.alias("is_stab"),
    )


def legendary_order(naming: Naming = Naming()) -> list[Key]:
    """By total stats, then id."""
    return [falling("total_base_stats"), rising(naming.id)]


def legendary_rows(fact: DataFrame, dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Legendary and mythical entities without their ranks."""
    n = naming
    rare = dim.where(F.col("is_legendary") | F.col("is_mythical"))
    flags = (F.col("is_mythical"), F.col("is_legendary"))
    return _fact_with(
        fact, rare, [*TYPE_SLOTS.values(), "is_legendary", "is_mythical", "generation"], n
    ).select(
        n.id,
        n.name,
        *TYPE_SLOTS.values(),
        "is_legendary",
        "is_mythical",
        "generation",
        *STAT_COLUMNS.values(),
        "total_base_stats",
        category(*flags, F.lit(None).cast("string")).alias("rarity_tier"),
    )


def legendary_rankings(fact: DataFrame, dim: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Legendary and mythical entities with their ranks."""
    group = F.when(F.col("is_mythical"), F.lit(MYTHICAL)).otherwise(F.lit(LEGENDARY))
    ranks = {"overall_rank": [], "rank_within_tier": [group]}
    return rank_rows(legendary_rows(fact, dim, naming), legendary_order(naming), ranks)


def first_legendaries(fact: DataFrame, dim: DataFrame, k: int, naming: Naming = Naming()) -> DataFrame:
    """The first ``k`` legendary and mythical entities with their overall rank."""
    return top_ranked(legendary_rows(fact, dim, naming), legendary_order(naming), k, "overall_rank")


def type_effectiveness(types: DataFrame, mapping=DOCUMENTED_RELATIONS) -> DataFrame:
    """Multiplier and label of every pair of types that has a relation; all other pairs are neutral."""
    return relation_pairs(types, "type_name", "target_type", "damage_relation", mapping)


def mart_order(naming: Naming = Naming()) -> dict[str, list[Column]]:
    """Row order of the stored ranked marts.

    Sorting on the column that reports cut by lets a reader skip the rest of
    the files.
    """
    by_rank = [F.col("overall_rank").asc()]
    return {
        "mart_top_attackers": by_rank,
        "mart_top_defenders": by_rank,
        "mart_best_movesets": [F.col(naming.id).asc(), F.col("move_rank").asc()],
        "mart_legendary_rankings": by_rank,
        "mart_type_effectiveness": [F.col("attacking_type").asc(), F.col("defending_type").asc()],
    }


def build_marts(
    staged: Tables,
    naming: Naming = Naming(),
    folder: TableFolder | None = None,
    mapping=DOCUMENTED_RELATIONS,
) -> dict[str, DataFrame]:
    """All eight marts by name.

    With a ``folder`` each one is stored, in its row order, before the next
    reads it; without one they stay lazy.
    """
    n = naming
    orders = mart_order(n)

    def keep(name: str, rows: DataFrame) -> DataFrame:
        if folder is None:
            return rows
        schema = n.layer_schema(n.layers[1], folder.default_schema)
        return folder.rebuild(schema, name, rows.orderBy(*orders[name]) if name in orders else rows)

    dim = keep(n.dim, dim_entity(staged, n))
    moves = keep("dim_moves", dim_moves(staged, n))
    fact = keep(n.fact, fct_stats(staged, n))
    return {
        n.dim: dim,
        "dim_moves": moves,
        n.fact: fact,
        "mart_top_attackers": keep("mart_top_attackers", top_attackers(fact, dim, n)),
        "mart_top_defenders": keep("mart_top_defenders", top_defenders(fact, dim, n)),
        "mart_best_movesets": keep(
            "mart_best_movesets", best_movesets(staged[n.staging(n.raw("moves"))], moves, dim, n)
        ),
        "mart_legendary_rankings": keep(
            "mart_legendary_rankings", legendary_rankings(fact, dim, n)
        ),
        "mart_type_effectiveness": keep(
            "mart_type_effectiveness", type_effectiveness(staged[n.staging("types")], mapping)
        ),
    }

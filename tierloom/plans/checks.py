"""Declared checks of every layer, and composite-key checks of the raw tables."""

from __future__ import annotations

from tierloom.constants import (
    DAMAGE_CLASSES,
    DAMAGING_CLASSES,
    EFFECT_LABELS,
    LEGENDARY,
    MULTIPLIERS,
    MYTHICAL,
    STAT_COLUMNS,
    TIERS,
    TYPE_SLOTS,
)
from tierloom.naming import Naming
from tierloom.operators.quality import Check, accepted, not_null, relationship, unique
from tierloom.schemas import raw_tables

# Learn methods the learnset check accepts, though the table has no such column.
LEARN_METHODS = ("level-up", "machine", "tutor")


def _named(table: str, key: str, name: str) -> list[Check]:
    return [unique(table, key), not_null(table, key), not_null(table, name)]


def source_checks(naming: Naming = Naming()) -> list[Check]:
    """19 checks on raw tables. ``types.id`` repeats by design, so its uniqueness check fails."""
    n = naming
    children = {"stats": "stat_name", "types": "type_name", "abilities": "ability_name", "moves": "move_name"}
    checks = [unique(n.raw(), "id"), not_null(n.raw(), "id")]
    for part, column in children.items():
        checks += [not_null(n.raw(part), n.id), not_null(n.raw(part), column)]
    for table in ("types", "moves", "species"):
        checks += _named(table, "id", "name")
    return checks


def staging_checks(naming: Naming = Naming()) -> list[Check]:
    """25 checks on staging. The learn method is checked though the column does not exist."""
    n = naming
    entity, stats, types, abilities, learned = (
        n.staging(table) for table in (n.raw(), *(n.raw(p) for p in ("stats", "types", "abilities", "moves")))
    )
    return [
        *_named(entity, n.id, n.name),
        not_null(entity, "species_id"),
        not_null(stats, n.id),
        not_null(stats, "stat_name"),
        accepted(stats, "stat_name", STAT_COLUMNS),
        not_null(types, n.id),
        not_null(types, "type_name"),
        accepted(types, "type_slot", TYPE_SLOTS),
        not_null(abilities, n.id),
        not_null(abilities, "ability_name"),
        not_null(learned, n.id),
        not_null(learned, "move_name"),
        accepted(learned, "learn_method", LEARN_METHODS),
        *_named(n.staging("types"), "type_id", "type_name"),
        *_named(n.staging("moves"), "move_id", "move_name"),
        accepted(n.staging("moves"), "damage_class", DAMAGE_CLASSES),
        *_named(n.staging("species"), "species_id", "species_name"),
    ]


def mart_checks(naming: Naming = Naming()) -> list[Check]:
    """23 checks on marts."""
    n = naming
    return [
        *_named(n.dim, n.id, n.name),
        not_null(n.dim, "primary_type"),
        *_named("dim_moves", "move_id", "move_name"),
        accepted("dim_moves", "damage_class", DAMAGE_CLASSES),
        not_null(n.fact, n.id),
        relationship(n.fact, n.id, n.dim, n.id),
        not_null("mart_top_attackers", n.id),
        accepted("mart_top_attackers", "tier", TIERS),
        not_null("mart_top_defenders", n.id),
        accepted("mart_top_defenders", "tier", TIERS),
        not_null("mart_type_effectiveness", "attacking_type"),
        not_null("mart_type_effectiveness", "defending_type"),
        accepted("mart_type_effectiveness", "effectiveness_multiplier", MULTIPLIERS),
        accepted("mart_type_effectiveness", "effectiveness_label", EFFECT_LABELS),
        not_null("mart_best_movesets", n.id),
        not_null("mart_best_movesets", "move_name"),
        accepted("mart_best_movesets", "damage_class", DAMAGING_CLASSES),
        not_null("mart_legendary_rankings", n.id),
        accepted("mart_legendary_rankings", "rarity_tier", (LEGENDARY, MYTHICAL)),
    ]


def key_checks(naming: Naming = Naming()) -> list[Check]:
    """Uniqueness of each raw table's whole key."""
    return [unique(table.name, *table.key) for table in raw_tables(naming).values()]


def all_checks(naming: Naming = Naming()) -> list[Check]:
    return [*source_checks(naming), *staging_checks(naming), *mart_checks(naming), *key_checks(naming)]


def expected_failures(naming: Naming = Naming()) -> set[tuple[str, str, str]]:
    """(table, column, check) of the declared checks that cannot pass by design.

    The id of the normalised relation table repeats, and the learnset has no learn method.
    """
    n = naming
    return {
        ("types", "id", "unique"),
        (n.staging("types"), "type_id", "unique"),
        (n.staging(n.raw("moves")), "learn_method", "accepted_values"),
    }

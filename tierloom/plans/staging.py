"""Staging layer: one typed projection per raw table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tierloom.naming import Naming
from tierloom.operators.project import Projection, project
from tierloom.schemas import SYNCED_AT
from tierloom.sources.tables import register_views

_SYNCED = (SYNCED_AT, "timestamp", "synced_at")


def projections(naming: Naming = Naming()) -> dict[str, Projection]:
    """Projection of every raw table, by raw table name."""
    n = naming
    entity_key = (n.id, "bigint", n.id)
    return {
        n.raw(): Projection(
            [
                ("id", "bigint", n.id),
                ("name", "string", n.name),
                ("base_experience", "bigint", "base_experience"),
                ("height", "bigint", "height_decimeters"),
                ("weight", "bigint", "weight_hectograms"),
                ("is_default", "boolean", "is_default_form"),
                ("order", "bigint", n.order_column),
                ("species_id", "bigint", "species_id"),
                _SYNCED,
            ],
            ["id"],
        ),
        n.raw("stats"): Projection(
            [
                entity_key,
                ("stat_name", "string", "stat_name"),
                ("base_stat", "bigint", "base_stat_value"),
                ("effort", "bigint", "effort_value"),
                _SYNCED,
            ],
            [n.id, "stat_name"],
        ),
        n.raw("types"): Projection(
            [entity_key, ("type_name", "string", "type_name"), ("slot", "bigint", "type_slot"), _SYNCED],
            [n.id, "type_name"],
        ),
        n.raw("abilities"): Projection(
            [
                entity_key,
                ("ability_name", "string", "ability_name"),
                ("is_hidden", "boolean", "is_hidden_ability"),
                ("slot", "bigint", "ability_slot"),
                _SYNCED,
            ],
            [n.id, "ability_name"],
        ),
        n.raw("moves"): Projection(
            [entity_key, ("move_name", "string", "move_name"), _SYNCED], [n.id, "move_name"]
        ),
        "moves": Projection(
            [
                ("id", "bigint", "move_id"),
                ("name", "string", "move_name"),
                ("accuracy", "bigint", "accuracy"),
                ("power", "bigint", "power"),
                ("pp", "bigint", "pp"),
                ("type", "string", "move_type"),
                ("damage_class", "string", "damage_class"),
                ("effect_chance", "bigint", "effect_chance"),
                _SYNCED,
            ],
            ["id"],
        ),
        "species": Projection(
            [
                ("id", "bigint", "species_id"),
                ("name", "string", "species_name"),
                ("capture_rate", "bigint", "capture_rate"),
                ("base_happiness", "bigint", "base_happiness"),
                ("is_legendary", "boolean", "is_legendary"),
                ("is_mythical", "boolean", "is_mythical"),
                ("generation", "string", "generation"),
                ("habitat", "string", "habitat"),
                ("shape", "string", "body_shape"),
                _SYNCED,
            ],
            ["id"],
        ),
        "types": Projection(
            [
                ("id", "bigint", "type_id"),
                ("name", "string", "type_name"),
                ("damage_relation", "string", "damage_relation"),
                ("target_type", "string", "target_type"),
                _SYNCED,
            ],
            ["id"],
        ),
    }


def build_staging(raw: Mapping[str, DataFrame], naming: Naming = Naming()) -> dict[str, DataFrame]:
    """Staging relation of every raw table given, by staging name; nothing is computed yet."""
    specs = projections(naming)
    return {naming.staging(name): project(df, specs[name]) for name, df in raw.items()}


def register_staging(raw: Mapping[str, DataFrame], naming: Naming = Naming()) -> dict[str, DataFrame]:
    """The same relations, also as views for SQL users."""
    staged = build_staging(raw, naming)
    register_views(staged)
    return staged

"""Schemas of landed documents and of the eight raw tables, with their keys.

Whole numbers are 64 bits wide: ids and sums outgrow 32 bits long before the
data is large for a cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tierloom.naming import Naming

SYNCED_AT = "_synced_at"


@dataclass(frozen=True)
class RawTable:
    name: str
    ddl: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        """The columns as a type; Spark parses them, so a session must be there."""
        return T.StructType.fromDDL(self.ddl)


def raw_tables(naming: Naming = Naming()) -> dict[str, RawTable]:
    """The eight raw tables by name."""
    n = naming
    declared = {
        n.raw(): (
            "id bigint, name string, base_experience bigint, height bigint, weight bigint, "
            "is_default boolean, `order` bigint, species_id bigint",
            ("id",),
        ),
        n.raw("stats"): (f"{n.id} bigint, stat_name string, base_stat bigint, effort bigint", (n.id, "stat_name")),
        n.raw("types"): (f"{n.id} bigint, type_name string, slot bigint", (n.id, "slot")),
        n.raw("abilities"): (
            f"{n.id} bigint, ability_name string, is_hidden boolean, slot bigint",
            (n.id, "slot"),
        ),
        n.raw("moves"): (f"{n.id} bigint, move_name string", (n.id, "move_name")),
        "moves": (
            "id bigint, name string, accuracy bigint, power bigint, pp bigint, type string, "
            "damage_class string, effect_chance bigint",
            ("id",),
        ),
        "species": (
            "id bigint, name string, capture_rate bigint, base_happiness bigint, is_legendary boolean, "
            "is_mythical boolean, generation string, habitat string, shape string",
            ("id",),
        ),
        "types": (
            "id bigint, name string, damage_relation string, target_type string",
            ("id", "damage_relation", "target_type"),
        ),
    }
    return {
        name: RawTable(name, f"{columns}, {SYNCED_AT} timestamp", key)
        for name, (columns, key) in declared.items()
    }


ENTITY_DOCUMENT = (
    "id bigint, name string, base_experience bigint, height bigint, weight bigint, is_default boolean, "
    "`order` bigint, species struct<name:string,url:string>, "
    "stats array<struct<base_stat:bigint,effort:bigint,stat:struct<name:string>>>, "
    "types array<struct<slot:bigint,type:struct<name:string>>>, "
    "abilities array<struct<is_hidden:boolean,slot:bigint,ability:struct<name:string>>>, "
    "moves array<struct<move:struct<name:string>>>"
)
MOVE_DOCUMENT = (
    "id bigint, name string, accuracy bigint, power bigint, pp bigint, effect_chance bigint, "
    "type struct<name:string>, damage_class struct<name:string>"
)
SPECIES_DOCUMENT = (
    "id bigint, name string, capture_rate bigint, base_happiness bigint, is_legendary boolean, "
    "is_mythical boolean, generation struct<name:string>, habitat struct<name:string>, "
    "shape struct<name:string>"
)
TYPE_DOCUMENT = (
    "id bigint, name string, damage_relations map<string,array<struct<name:string,url:string>>>"
)

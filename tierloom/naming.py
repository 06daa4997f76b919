"""Table, column and schema names derived from one noun.

The data model has one central thing (a customer, a device, a creature ...).
Its noun appears in table and column names, so it is an argument here: a
``Naming("device")`` gives ``dim_device``, ``device_id``, ``device_name`` and
so on through every layer.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Naming:
    entity: str = "entity"
    order_column: str = "catalog_order"

    @property
    def id(self) -> str:
        return f"{self.entity}_id"

    @property
    def name(self) -> str:
        return f"{self.entity}_name"

    @property
    def count(self) -> str:
        return f"{self.entity}_count"

    def raw(self, part: str = "") -> str:
        """Raw table of the entity itself, or of one of its child lists."""
        return f"{self.entity}_{part}" if part else self.entity

    def staging(self, table: str) -> str:
        return f"stg_{table}"

    @property
    def dim(self) -> str:
        return f"dim_{self.entity}"

    @property
    def fact(self) -> str:
        return f"fct_{self.entity}_stats"

    def layer_schema(self, layer: str | None, default: str) -> str:
        """Schema a layer is written to.

        Staging and marts have fixed names, no layer means the session's
        default, and any other name is used as given without outer blanks.
        """
        if layer is None:
            return default
        return layer if layer in self.layers else layer.strip()

    @property
    def layers(self) -> tuple[str, str]:
        return (f"{self.entity}_staging", f"{self.entity}_marts")

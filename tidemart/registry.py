"""Which tables are captured, by which key, and by which audit column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    audit: str

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"table {self.name} needs at least one key column")


def load_registry(entries: Mapping[str, Mapping]) -> dict[str, TableSpec]:
    """``{table: {"key": column or columns, "audit": column}}`` -> specs by table name."""
    registry = {}
    for name, entry in entries.items():
        key: str | Sequence[str] = entry["key"]
        keys = (key,) if isinstance(key, str) else tuple(key)
        registry[name] = TableSpec(name, keys, entry["audit"])
    return registry


# The captured shop tables. Users and events carry no update time, so later
# changes to their rows are never captured.
SHOP_TABLES = load_registry(
    {
        "users": {"key": "id", "audit": "created_at"},
        "products": {"key": "id", "audit": "updated_at"},
        "orders": {"key": "order_id", "audit": "updated_at"},
        "order_items": {"key": "id", "audit": "updated_at"},
        "events": {"key": "id", "audit": "created_at"},
    }
)

# One namespace per layer, the same for every deployment target.
LAYERS = ("bronze", "silver", "gold")
TARGETS = ("dev", "prod", "stag")


def layer_name(layer: str, target: str = "dev") -> str:
    """Namespace of a layer for a deployment target; anything unknown is an error."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    if target not in TARGETS:
        raise ValueError(f"unknown target {target!r}")
    return layer

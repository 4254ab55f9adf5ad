"""Settings of one lake: where layers live, what they are called, what may be rebuilt."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import datetime, timedelta, timezone

LAYERS = ("bronze", "silver", "gold", "quality", "monitoring")

# Bronze is raw history; only what can be recomputed from it may be replaced.
REBUILDABLE_LAYERS = ("silver", "gold", "quality", "monitoring")


def _same_name_per_layer() -> dict[str, str]:
    return {layer: layer for layer in LAYERS}


@dataclass(frozen=True)
class LakeConfig:
    """One environment of the lake.

    ``folders`` and ``databases`` map each layer to its folder and catalog database. ``utc_offset_hours``
    is the zone of every ingestion timestamp; timestamps are compared as text, so all writers share it.
    """

    root: str
    environment: str = "dev"
    folders: Mapping[str, str] = field(default_factory=_same_name_per_layer)
    databases: Mapping[str, str] = field(default_factory=_same_name_per_layer)
    utc_offset_hours: int = -3

    def __post_init__(self) -> None:
        if not self.root:
            raise ValueError("root is empty")
        for label, names in (("folders", self.folders), ("databases", self.databases)):
            missing = [layer for layer in LAYERS if not names.get(layer)]
            if missing:
                raise ValueError(f"{label} has no entry for {missing}")

    @classmethod
    def from_mapping(cls, settings: Mapping[str, object]) -> LakeConfig:
        """Build from plain settings; a name this class does not know is an error."""
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(settings) - known)
        if unknown:
            raise ValueError(f"unknown settings: {unknown}; known: {sorted(known)}")
        return cls(**settings)

    def _layer(self, layer: str) -> str:
        if layer not in self.folders:
            raise ValueError(f"unknown layer {layer!r}; known: {sorted(self.folders)}")
        return self.folders[layer]

    def layer_path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{self.environment}/{self._layer(layer)}/"

    def path(self, layer: str, table: str) -> str:
        if not table or "/" in table or table in (".", ".."):
            raise ValueError(f"not a table name: {table!r}")
        return f"{self.layer_path(layer)}{table}/"

    def require_rebuildable(self, path: str) -> None:
        """Raise unless ``path`` lies inside a layer that is derived from bronze."""
        allowed = [self.layer_path(layer) for layer in REBUILDABLE_LAYERS]
        inside = any(path.startswith(prefix) and path != prefix for prefix in allowed)
        if not inside or ".." in path.split("/"):
            raise ValueError(f"refusing to replace {path}; only paths inside {allowed} may be replaced")

    def now(self) -> datetime:
        return datetime.now(timezone(timedelta(hours=self.utc_offset_hours)))


@dataclass(frozen=True)
class SourceSpec:
    """One entry of the source registry."""

    name: str
    dataset_id: str
    table_id: str
    target_name: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    load_enabled: bool = True

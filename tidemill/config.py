"""Asset-type configuration files: the only thing a new asset type needs."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from typing import Any

import yaml

from tidemill.schema import CONFIG_TYPES

ASSETS_DIR = Path(__file__).parent / "assets"


class AssetConfigError(ValueError):
    """A configuration is missing or malformed."""


@dataclass(frozen=True)
class AssetField:
    source: str
    target: str
    spark_type: str


@dataclass(frozen=True)
class AssetConfig:
    asset_type: str
    silver_table: str
    fields: tuple[AssetField, ...] = ()
    primary_key: tuple[str, ...] = ("event_id",)
    deduplicate: bool = True


def _need(mapping: Any, keys: tuple[str, ...], where: str) -> dict:
    if not isinstance(mapping, dict):
        raise AssetConfigError(f"{where}: expected a mapping, found {type(mapping).__name__}")
    absent = [k for k in keys if k not in mapping]
    if absent:
        raise AssetConfigError(f"{where}: missing {', '.join(absent)}")
    return mapping


def _field(entry: Any, where: str) -> AssetField:
    entry = _need(entry, ("source", "target", "type"), where)
    spark_type = CONFIG_TYPES.get(str(entry["type"]).lower())
    if spark_type is None:
        known = ", ".join(sorted(CONFIG_TYPES))
        raise AssetConfigError(f"{where}: type {entry['type']!r} is not one of {known}")
    return AssetField(str(entry["source"]), str(entry["target"]), spark_type)


def parse_asset_config(document: Any, where: str = "<memory>") -> AssetConfig:
    document = _need(document, ("asset_type", "silver_table", "fields"), where)
    listed = document["fields"] if document["fields"] is not None else []
    if not isinstance(listed, list):
        raise AssetConfigError(f"{where}: fields must be a list")
    fields = tuple(_field(f, f"{where}: field {i}") for i, f in enumerate(listed))
    targets = [f.target for f in fields]
    repeated = sorted({t for t in targets if targets.count(t) > 1})
    if repeated:
        raise AssetConfigError(f"{where}: repeated target {', '.join(repeated)}")
    return AssetConfig(
        asset_type=document["asset_type"],
        silver_table=document["silver_table"],
        fields=fields,
        primary_key=tuple(document.get("primary_key") or ("event_id",)),
        deduplicate=bool(document.get("deduplicate", True)),
    )


def read_asset_config(path: Path) -> AssetConfig:
    try:
        document = yaml.safe_load(path.read_text(encoding="utf-8"))
    except yaml.YAMLError as error:
        raise AssetConfigError(f"{path}: not YAML: {error}") from error
    if document is None:
        raise AssetConfigError(f"{path}: empty file")
    return parse_asset_config(document, str(path))


def load_asset_config(asset_type: str, directory: str | Path = ASSETS_DIR) -> AssetConfig:
    path = Path(directory) / f"{asset_type}.yml"
    if not path.is_file():
        raise AssetConfigError(f"no configuration for {asset_type!r}: {path} does not exist")
    return read_asset_config(path)


def discover_asset_configs(directory: str | Path = ASSETS_DIR) -> list[AssetConfig]:
    """All configurations of a directory in file-name order."""
    directory = Path(directory)
    if not directory.is_dir():
        raise AssetConfigError(f"no such configuration directory: {directory}")
    files = sorted(p for p in directory.iterdir() if p.suffix in (".yml", ".yaml"))
    configs = [read_asset_config(p) for p in files]
    types = [c.asset_type for c in configs]
    repeated = sorted({t for t in types if types.count(t) > 1})
    if repeated:
        raise AssetConfigError(f"{directory}: asset type configured twice: {', '.join(repeated)}")
    return configs

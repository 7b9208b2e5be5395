"""Declarative descriptions of raw sources."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

POLICIES = ("strict", "drop", "clip")


class ConfigError(ValueError):
    """A source description that cannot be used."""


def _filled(value, what: str, lower: bool = False) -> str:
    text = str(value).strip() if value is not None else ""
    if not text:
        raise ConfigError(f"{what} must not be empty")
    return text.lower() if lower else text


def _known(data: dict, cls) -> dict:
    if unknown := sorted(set(data) - {f.name for f in fields(cls)}):
        raise ConfigError(f"unknown keys: {', '.join(unknown)}")
    return data


def or_unknown(value: str | None) -> str:
    return (value or "").strip().lower() or "unknown"


@dataclass(frozen=True)
class SplitConfig:
    """Where a split's files are, and what its pictures have in common."""

    root: str
    paths: dict[str, str] = field(default_factory=dict)
    condition: str | None = None
    domain: str | None = None
    is_synthetic: bool | None = None
    output_split: str | None = None
    meta: dict = field(default_factory=dict)

    def path(self, key: str) -> str:
        """The full path of a key; relative ones lie under the root."""
        if key not in self.paths:
            raise KeyError(f"no path {key!r}; available: {', '.join(sorted(self.paths)) or 'none'}")
        p = self.paths[key]
        return p if p.startswith("/") or "://" in p else f"{self.root.rstrip('/')}/{p}"


@dataclass(frozen=True)
class SourceConfig:
    """A raw source: its format, splits, label map and box policy."""

    key: str
    source_format: str
    splits: dict[str, SplitConfig]
    bbox_policy: str = "clip"
    class_map: dict[str, str | None] = field(default_factory=dict)
    ignore_labels: tuple[str, ...] = ()
    class_names: dict[int, str] | None = None
    default_condition: str = "unknown"
    default_domain: str = "unknown"
    default_is_synthetic: bool | None = None
    meta: dict = field(default_factory=dict)

    @classmethod
    def of(cls, data: dict) -> SourceConfig:
        """A checked description of a mapping, as a YAML file holds it."""
        d = dict(_known(dict(data), cls))
        d["key"], d["source_format"] = _filled(d.get("key"), "key", True), _filled(d.get("source_format"), "source_format", True)
        if not d.get("splits"):
            raise ConfigError("a source needs at least one split")
        splits = {}
        for name, s in d["splits"].items():
            s = dict(_known(dict(s), SplitConfig))
            if s.get("output_split") is not None:
                s["output_split"] = _filled(s["output_split"], "output_split")
            splits[_filled(name, "split")] = SplitConfig(**s)
        d["splits"] = splits
        if d.get("bbox_policy", "clip") not in POLICIES:
            raise ConfigError(f"unknown bbox_policy {d['bbox_policy']!r}; one of {', '.join(POLICIES)}")
        d["class_map"] = {_filled(k, "class_map key"): ((v or "").strip() or None) for k, v in (d.get("class_map") or {}).items()}
        d["ignore_labels"] = tuple(_filled(x, "ignore label") for x in d.get("ignore_labels") or ())
        if d.get("class_names") is not None:
            names = d["class_names"]
            names = dict(names) if isinstance(names, dict) else dict(enumerate(names))
            if not names or any(int(k) < 0 for k in names):
                raise ConfigError("class_names need ids of 0 or more")
            d["class_names"] = {int(k): _filled(v, "class name") for k, v in names.items()}
        d["default_condition"], d["default_domain"] = or_unknown(d.get("default_condition")), or_unknown(d.get("default_domain"))
        return cls(**d)

    def split(self, name: str) -> SplitConfig:
        if name not in self.splits:
            raise KeyError(f"no split {name!r}; available: {', '.join(self.splits)}")
        return self.splits[name]

    def output_splits(self, names: list[str] | None = None) -> dict[str, str]:
        """{output split: source split}; two source splits may not go to one."""
        out: dict[str, str] = {}
        for name in names if names is not None else list(self.splits):
            target = self.split(name).output_split or name
            if target in out:
                raise ConfigError(f"output split {target!r} of both {out[target]!r} and {name!r}")
            out[target] = name
        return out

    def merged_meta(self, split: str) -> dict:
        return {**self.meta, **self.split(split).meta}


def load(path: str) -> SourceConfig:
    """A description from a YAML (or JSON) file."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml

        data = yaml.safe_load(text)
    except ImportError:
        data = json.loads(text)
    if not isinstance(data, dict):
        raise ConfigError(f"{path} is no mapping")
    return SourceConfig.of(data)

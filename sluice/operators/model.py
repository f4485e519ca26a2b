"""Target tables and settings, as plain data read once when a plan is built."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, is_dataclass
from pathlib import Path
from types import UnionType
from typing import Any, Union, get_args, get_origin, get_type_hints

#: Kinds of capture: whether the payload lands in ``_json`` and in ``_raw``.
CAPTURE = {"full": (True, False), "json_only": (True, False), "raw_only": (False, True), "extracted_only": (False, False)}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "String"
    comment: str = ""
    default_kind: str = ""  # MATERIALIZED and ALIAS columns are never filled


@dataclass(frozen=True)
class TableSpec:
    db: str
    table: str
    columns: tuple[ColumnSpec, ...]
    comment: str = ""

    @property
    def name(self) -> str:
        return f"{self.db}.{self.table}"

    @property
    def tags(self) -> dict[str, str]:
        """``@key: value`` pairs of the table comment, separated by bars."""
        found = (re.fullmatch(r"\s*@([\w-]+)\s*:\s*(.*?)\s*", part) for part in self.comment.split("|"))
        return {m[1]: m[2] for m in found if m}


@dataclass(frozen=True)
class ExternalTopic:
    """A topic whose records may name only these tenants and sources."""

    topic: str
    org: str
    allowed_orgs: tuple[str, ...] = ()
    source: str | None = None
    allowed_sources: tuple[str, ...] = ()


@dataclass(frozen=True)
class Routing:
    table_fields: tuple[str, ...] = ("_source", "source")
    source_to_table: dict[str, str] = field(default_factory=dict)
    default_table: str = "events"
    default_db: str = "default"
    default_org_id: str = "default"
    org_field: str = "_org_id"
    org_routes: dict[str, str] = field(default_factory=dict)
    topic_suffixes: tuple[str, ...] = ("_land", "_load")
    pinned_topics: dict[str, str] = field(default_factory=dict)
    external: tuple[ExternalTopic, ...] = ()
    dead_letters: bool = True

    def __post_init__(self):
        if not self.table_fields:
            raise ValueError("table_fields is empty")
        for e in self.external:
            if e.allowed_orgs and e.org not in e.allowed_orgs:
                raise ValueError(f"{e.topic}: org is not among its allowed orgs")


@dataclass(frozen=True)
class Risk:
    """Scores, weights and bands of the risk assessment."""

    weights: tuple[int, int, int, int] = (15, 25, 25, 35)  # geo, reputation, privacy, threat
    high_countries: frozenset[str] = frozenset()
    medium_countries: frozenset[str] = frozenset()
    geo: dict[str, int] = field(default_factory=lambda: {"unknown": 35, "high": 90, "medium": 60, "other": 15})
    reputation: dict[str, int] = field(default_factory=lambda: {"vpn": 50, "proxy": 60, "tor": 80, "datacenter": 40, "relay": 45})
    privacy: tuple[int, int, int] = (40, 70, 95)
    threat: dict[str, int] = field(default_factory=lambda: {"botnet": 95, "malicious": 90, "spam": 70, "scanner": 60})
    bands: dict[str, int] = field(default_factory=lambda: {"critical": 80, "high": 60, "medium": 40, "low": 20})

    def __post_init__(self):
        if list(self.bands.values()) != sorted(self.bands.values(), reverse=True):
            raise ValueError("risk bands must fall")
        scores = [*self.geo.values(), *self.reputation.values(), *self.privacy, *self.threat.values()]
        if any(not 0 <= x <= 100 for x in scores) or any(w < 0 for w in self.weights):
            raise ValueError("risk scores lie between 0 and 100 and weights are not negative")


#: Our own example lists of countries to weigh higher: (high, medium).  Pass them to Risk.
COUNTRIES = {
    "none": (frozenset(), frozenset()),
    "sanctioned": (frozenset({"KP", "IR", "SY"}), frozenset({"CU", "BY", "RU", "MM"})),
    "strict": (frozenset({"KP", "IR", "SY", "CU", "BY", "RU", "MM"}), frozenset({"AF", "LY", "SD", "SO", "YE", "ZW"})),
    "conflict": (frozenset({"AF", "SD", "SO", "SY", "YE"}), frozenset({"LY", "ML", "MM", "UA"})),
    "offshore": (frozenset(), frozenset({"KY", "PA", "SC", "VG", "VU"})),
}


def risk_for(countries: str, **values: Any) -> Risk:
    """Settings with one of the lists of ``COUNTRIES``."""
    if countries not in COUNTRIES:
        raise ValueError(f"no list of countries {countries}")
    high, medium = COUNTRIES[countries]
    return Risk(high_countries=high, medium_countries=medium, **values)


@dataclass(frozen=True)
class Quality:
    """Bounds of believable timestamps, in seconds; 0 for the past means no bound."""

    max_future_seconds: int = 600
    max_past_seconds: int = 0


@dataclass(frozen=True)
class Settings:
    routing: Routing = field(default_factory=Routing)
    quality: Quality | None = None
    capture: str = "full"
    table_capture: dict[str, str] = field(default_factory=dict)
    directives: dict[str, dict[str, Any]] = field(default_factory=dict)  # column -> directive
    table_directives: dict[str, dict[str, dict[str, Any]]] = field(default_factory=dict)
    source_fields: tuple[str, ...] = ("_source", "source")
    tags_fields: tuple[str, ...] = ("tags", "_tags", "meta", "metadata.tags")
    raw_fields: tuple[str, ...] = ("raw", "_raw")
    mapping: tuple = ()
    max_depth: int = 64
    risk: Risk | None = None

    def __post_init__(self):
        for mode in (self.capture, *self.table_capture.values()):
            if mode not in CAPTURE:
                raise ValueError(f"unknown capture mode {mode}")
        for entry in (*self.directives.values(), *(d for t in self.table_directives.values() for d in t.values())):
            if unknown := set(entry) - {"skip", "default", "source", "renamed", "computed", "fallback"}:
                raise ValueError(f"directives that nothing reads: {sorted(unknown)}")

    def capture_of(self, table: TableSpec) -> str:
        """Table tag, then the table's setting, then the general one; an unknown tag is passed over."""
        tag = table.tags.get("capture_mode")
        return tag if tag in CAPTURE else self.table_capture.get(table.name, self.capture)


def settings_from(values: dict[str, Any], environment: dict[str, str] | None = None, prefix: str = "SLUICE_") -> Settings:
    """Defaults, then ``values``, then environment variables such as
    ``SLUICE_ROUTING__DEFAULT_TABLE`` (text, numbers, or JSON for lists and objects);
    unknown keys and values of another kind are refused with their place."""
    merged = _merged({}, values)
    for key, text in sorted((environment or {}).items()):
        if key.startswith(prefix):
            at, *path = reversed(key[len(prefix) :].lower().split("__"))
            value: Any = json.loads(text) if text[:1] in "[{" else text
            for step in (at, *path):
                value = {step: value}
            merged = _merged(merged, value)
    return _made(Settings, merged, "settings")


def load_settings(*paths: str, environment: dict[str, str] | None = None) -> Settings:
    """``settings_from`` of JSON or YAML files, each over those before it: objects are merged
    key by key, anything else is replaced.  A file that is missing is an error."""
    values: dict[str, Any] = {}
    for path in paths:
        text = Path(path).read_text()
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise ValueError("YAML settings need the yaml package") from e
            found = yaml.safe_load(text) or {}
        else:
            found = json.loads(text)
        if not isinstance(found, dict):
            raise ValueError(f"{path} holds no object")
        values = _merged(values, found)
    return settings_from(values, environment)


def _merged(low: dict[str, Any], high: dict[str, Any]) -> dict[str, Any]:
    both = {k: _merged(low[k], v) for k, v in high.items() if isinstance(v, dict) and isinstance(low.get(k), dict)}
    return {**low, **high, **both}


def _made(kind: Any, value: Any, at: str) -> Any:
    """``value`` as a value of a type of the settings."""
    origin, args = get_origin(kind), get_args(kind)
    if is_dataclass(kind):
        if isinstance(value, kind):
            return value
        if not isinstance(value, dict):
            raise ValueError(f"{at} is no object")
        hints = get_type_hints(kind)
        if unknown := set(value) - set(hints):
            raise ValueError(f"unknown settings in {at}: {sorted(unknown)}")
        try:
            return kind(**{k: _made(hints[k], v, f"{at}.{k}") for k, v in value.items()})
        except TypeError as e:
            raise ValueError(f"{at}: {e}") from None
    if origin in (Union, UnionType):
        return None if value is None else _made(next(a for a in args if a is not type(None)), value, at)
    if origin in (tuple, frozenset) or kind is tuple:
        if not isinstance(value, list | tuple | set | frozenset):
            raise ValueError(f"{at} is no list")
        inner = args[0] if args else Any
        return (frozenset if origin is frozenset else tuple)(_made(inner, v, f"{at}[{k}]") for k, v in enumerate(value))
    if origin is dict:
        if not isinstance(value, dict):
            raise ValueError(f"{at} is no object")
        return {k: _made(args[1], v, f"{at}.{k}") for k, v in value.items()}
    if kind is bool and isinstance(value, str) and value.lower() in ("true", "false"):
        return value.lower() == "true"
    if kind is int and isinstance(value, str):
        try:
            return int(value)
        except ValueError:
            raise ValueError(f"{at} is no whole number") from None
    if kind in (int, str, bool) and (not isinstance(value, kind) or kind is int and isinstance(value, bool)):
        raise ValueError(f"{at} is no {kind.__name__}")
    return value

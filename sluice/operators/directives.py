"""Column directives: where a column's value comes from, written in its comment or in
the settings."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, replace
from typing import Any

from sluice.operators.model import ColumnSpec, Settings, TableSpec

_KNOWN = ("skip", "default", "source", "renamed", "computed", "coerce")
_START = re.compile(rf"(?:^|\s)@({'|'.join(_KNOWN)})\b")
#: What a source may fall back to beside literals.
_FALLBACKS = ("now()", "uuid()", "topic_name", "null")


@dataclass(frozen=True)
class Literal:
    value: Any


@dataclass(frozen=True)
class Directive:
    skip: bool = False
    default: Literal | str | None = None  # a literal, or one of _FALLBACKS
    source: tuple[str, ...] = ()
    renamed: tuple[str, ...] = ()
    computed: str | None = None


def _scalar(text: str) -> Literal:
    """A JSON scalar, else the text itself."""
    try:
        value = json.loads(text)
    except ValueError:
        return Literal(text)
    return Literal(text if isinstance(value, (dict, list)) else value)


def _paths(text: str) -> tuple[str, ...]:
    inner = re.fullmatch(r"first\((.*)\)", text)
    parts = re.split(r"[/,]", inner[1]) if inner else [text]
    return tuple(p.strip() for p in parts if p.strip())


def _fallback(text: str) -> Literal | str | None:
    if text in _FALLBACKS:
        return text
    if re.fullmatch(r'"[^"]*"|-?\d+(\.\d+)?|true|false', text):
        return Literal(json.loads(text))
    return None


def parse_directives(comment: str) -> Directive:
    """The directives of a column comment; unknown names are left alone."""
    found, marks = Directive(), list(_START.finditer(comment))
    for mark, after in zip(marks, [*marks[1:], None], strict=False):
        name, value = mark[1], comment[mark.end() : after.start() if after else len(comment)]
        value = value.removeprefix(":").strip().rstrip(" |,;")
        if name in ("source", "renamed"):
            value = value.split(" - ")[0].strip()
        if name == "skip":
            found = replace(found, skip=True)
        elif name == "default" and value:
            found = replace(found, default=_scalar(value))
        elif name == "source" and value:
            path, bar, last = value.partition("|")
            fallback = _fallback(last.strip()) if bar else None
            found = replace(found, source=_paths(path.strip()), default=found.default if found.default is not None else fallback)
        elif name == "renamed" and value:
            found = replace(found, renamed=_paths(value))
        elif name == "computed" and value:
            found = replace(found, computed=value)
    return found


def _of_entry(entry: dict[str, Any]) -> Directive:
    listed = lambda x: () if not x else (x,) if isinstance(x, str) else tuple(x)
    default = entry.get("default")
    if default is not None:
        default = Literal(default)
    elif entry.get("fallback"):
        default = _fallback(entry["fallback"])
    return Directive(bool(entry.get("skip")), default, listed(entry.get("source")), listed(entry.get("renamed")), entry.get("computed"))


def directive_of(table: TableSpec, column: ColumnSpec, settings: Settings) -> Directive:
    """The whole directive: of the table's settings, else of the general ones, else of the comment."""
    for entry in (settings.table_directives.get(table.name, {}).get(column.name), settings.directives.get(column.name)):
        if entry is not None:
            return _of_entry(entry)
    return parse_directives(column.comment)


def merged(table: TableSpec, settings: Settings, what: str) -> dict[str, Any]:
    """``computed`` or ``renamed`` of every column that has one, each from the first of
    table settings, general settings and comment that sets it."""
    out = {}
    for c in table.columns:
        for d in (settings.table_directives.get(table.name, {}).get(c.name), settings.directives.get(c.name)):
            if d and d.get(what):
                out[c.name] = getattr(_of_entry(d), what)
                break
        else:
            if value := getattr(parse_directives(c.comment), what):
                out[c.name] = value
    return out

"""Fields of a JSON record as columns.

A record is a variant column, parsed once, beside the text it came from.  Dotted
paths may run through keys that hold dots themselves: every way to read the path is
tried, longest keys first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def readings(path: str) -> list[list[str]]:
    """The ways to split a dotted path into keys, the whole path as one key first."""
    parts = path.split(".")
    if len(parts) == 1:
        return [parts]
    out = [[path]]
    for k in range(1, len(parts)):
        head = ".".join(parts[:k])
        out += [[head, *tail] for tail in readings(".".join(parts[k:]))]
    return out


def quoted(keys: list[str]) -> str:
    return "$" + "".join(f"['{k}']" if "'" not in k else f'["{k}"]' for k in keys)


def present(value: Column) -> Column:
    """A variant that is neither missing nor a JSON null, else null."""
    return F.when(F.is_variant_null(value), F.lit(None)).otherwise(value)


def at(record: Column, keys: list[str]) -> Column:
    return F.try_variant_get(record, quoted(keys), "variant")


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once, whatever reads it: the optimiser moves
    filters and projections through a projection, and its expressions with them, but not
    through a generator."""
    return df.withColumn(name, F.explode(F.array(value)))


def columns_at(df: DataFrame, record: str, paths: dict[str, tuple[str, ...]]) -> DataFrame:
    """``df`` with the value at each path as a column.  Paths under one parent are read in one
    pass over its keys; only keys that differ in case alone, or cannot name a field, are
    looked up one by one."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for *parent, key in paths.values():
        groups.setdefault(tuple(parent), []).append(key)
    made: dict[tuple[str, ...], Column] = {}
    for g, (parent, keys) in enumerate(groups.items()):
        folded = Counter(k.lower() for k in keys)
        together = [k for k in keys if k and "`" not in k and folded[k.lower()] == 1]
        if len(together) > 1:
            fields = ", ".join(f"`{k}`: variant" for k in together)
            df = once(df, f"_keys_{g}", F.try_variant_get(F.col(record), quoted(list(parent)), f"struct<{fields}>"))
            made |= {(*parent, k): F.col(f"_keys_{g}").getField(k) for k in together}
    out = {name: made[keys] if keys in made else at(F.col(record), list(keys)) for name, keys in paths.items()}
    return df.withColumns(out).drop(*[f"_keys_{g}" for g in range(len(groups))])


def field(record: Column, path: str) -> Column:
    """The value at a dotted path; null if missing or JSON null."""
    found = [present(at(record, keys)) for keys in readings(path)]
    return found[0] if len(found) == 1 else F.coalesce(*found)


def first_field(record: Column, paths: list[str] | tuple[str, ...]) -> Column:
    """The first value that is there among several paths."""
    return F.coalesce(*[field(record, p) for p in paths])


def kind(value: Column) -> Column:
    """STRING, BIGINT, DOUBLE, BOOLEAN, OBJECT..., ARRAY..., by a variant's content."""
    return F.schema_of_variant(value)


def string_field(record: Column, path: str) -> Column:
    """A string at a strict path (each dot a step); null for every other kind."""
    return string_of(at(record, path.split(".")))


def string_of(value: Column) -> Column:
    """A variant that is a string as text; null for every other kind."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def first_string(record: Column, paths: tuple[str, ...]) -> Column:
    """The first non-empty string."""
    return F.coalesce(*[F.nullif(string_field(record, p), F.lit("")) for p in paths])


def as_text(value: Column) -> Column:
    """A variant as text: strings as they are, everything else as JSON, JSON null as null."""
    return F.try_variant_get(value, "$", "string")

"""Nested records to flat ones, and clean keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.jsonpath import bound
from sluice.operators.intake import nesting

PROTECTED = ("_uuid", "_timestamp_load", "_timestamp", "_timestamp_received", "_org_id", "_source", "_raw", "_json", "_tags")


def flat_columns(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, Column]]:
    """Leaf fields under dotted names; arrays as JSON text; empty structs vanish."""
    out = []
    for f in schema.fields:
        path = (*prefix, f.name)
        column = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(f.dataType, T.StructType):
            out += flat_columns(f.dataType, path)
        else:
            out.append((".".join(path), F.to_json(column) if isinstance(f.dataType, (T.ArrayType, T.MapType)) else column))
    return out


def flatten(df: DataFrame) -> DataFrame:
    """``df`` with every nested column as dotted ones."""
    return df.select(*[c.alias(n) for n, c in flat_columns(df.schema)])


def flatten_like(df: DataFrame, column: str, sample: str) -> DataFrame:
    """A JSON text column flattened to the keys of ``sample``; other keys are dropped."""
    schema = F.schema_of_json(F.lit(sample))
    parsed = df.select(F.from_json(column, schema).alias("r")).select("r.*")
    return flatten(parsed)


def _children(key: Column, text: Column) -> Column:
    """The entries of an object's text: their keys under ``key``, texts, and whether they are
    objects themselves."""
    texts, opens = F.map_entries(F.from_json(text, "map<string,string>")), lambda e: F.coalesce(e["value"].startswith("{"), F.lit(False))
    # kinds tell objects from strings that begin like one, so they are read where a text does
    kinds = lambda es: F.when(F.exists(es, opens), F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"))

    def made(x: Column) -> Column:
        def one(e: Column) -> Column:
            of = F.try_element_at(x["kinds"], e["key"])
            # the text of a string has lost its quotes; where keys repeat, kinds are not known
            nested = F.when(opens(e), F.when(of.isNotNull(), F.schema_of_variant(of).startswith("OBJECT")).otherwise(F.try_parse_json(e["value"]).isNotNull()))
            return F.struct(F.concat(key, e["key"]).alias("key"), e["value"].alias("text"), F.coalesce(nested, F.lit(False)).alias("nested"))

        return F.transform(x["texts"], one)

    return bound(bound(texts, lambda es: F.struct(es.alias("texts"), kinds(es).alias("kinds"))), made)


def flatten_map(text: Column | str) -> Column:
    """JSON objects of unknown keys as maps of dotted keys; null for anything else.  Arrays
    are JSON text, a number keeps its point (1.0), JSON null is null, an empty object
    vanishes, and of keys that repeat the last stands.

    Level by level: objects among the entries give way to their own entries, as often as
    the text is nested.  The text, and whether it is an object's, are computed once."""
    nested = lambda e: e["nested"]

    def first(t: Column) -> Column:
        return F.when(F.ltrim(t).startswith("{") & F.rtrim(t).endswith("}") & (F.try_parse_json(t).isNotNull() | F.json_object_keys(t).isNotNull()), t)

    def step(entries: Column, _: Column) -> Column:
        below = F.flatten(F.transform(entries, lambda e: F.when(e["nested"], _children(F.concat(e["key"], F.lit(".")), e["text"])).otherwise(F.array(e))))
        return F.when(F.exists(entries, nested), below).otherwise(entries)

    def flat(t: Column) -> Column:
        levels = F.sequence(F.lit(1), F.greatest(nesting(t) - 1, F.lit(1)))
        entries = F.aggregate(levels, _children(F.lit(""), t), step)
        return F.when(t.isNotNull(), bound(entries, lambda es: F.map_from_entries(F.transform(last_of(es, "key"), lambda e: F.struct(e["key"].alias("key"), e["text"].alias("value"))))))

    return bound(bound(F.col(text) if isinstance(text, str) else text, first), flat)


def last_of(entries: Column, name: str) -> Column:
    """Entries of which none that follows has the same ``name``."""
    names = F.transform(entries, lambda e: e[name])
    repeated = F.size(F.array_distinct(names)) < F.size(names)
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), e[name]))
    return F.when(repeated, last).otherwise(entries)


def clean_key(key: Column) -> Column:
    """Without one leading @, with single underscores and none at the ends; never empty.
    Protected names stay as they are."""
    plain = F.regexp_replace(key, "^@", "")
    plain = F.regexp_replace(F.regexp_replace(plain, "_+", "_"), "^_+|_+$", "")
    return F.when(key.isin(*PROTECTED), key).otherwise(F.when(plain == "", "unnamed").otherwise(plain))


def clean_keys(entries: Column) -> Column:
    """A map under clean keys; of keys that become the same the last stands."""
    listed = F.transform(F.map_entries(entries), lambda e: F.struct(clean_key(e["key"]).alias("key"), e["value"].alias("value")))
    return bound(listed, lambda es: F.map_from_entries(last_of(es, "key")))


def without_keys(entries: Column, keys: tuple[str, ...]) -> Column:
    """A map without the fields that chose the table."""
    return F.map_filter(entries, lambda k, _: ~k.isin(*keys))

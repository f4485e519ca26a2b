"""Promotion of record fields into the columns of a target table."""

from __future__ import annotations

from collections.abc import Hashable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import jsonpath, timestamps
from sluice.functions.coerce import finished, made_of, spark_type, wants_kind, wants_number
from sluice.operators.directives import Directive, Literal, directive_of
from sluice.operators.model import CAPTURE, ColumnSpec, Settings, TableSpec

#: Columns that the sink fills.
SINK = ("_uuid", "_timestamp_load")
TIMES = ("timestamp", "@timestamp", "_timestamp")


def sources_of(column: ColumnSpec, directive: Directive, settings: Settings) -> tuple[str, ...]:
    """The paths a column is read from, in order; a directive's replace the column's own."""
    name = column.name
    if name in SINK or column.default_kind in ("MATERIALIZED", "ALIAS") or directive.skip:
        return ()
    if name == "_org_id":
        return (settings.routing.org_field,)
    if name == "_timestamp":
        return TIMES
    if name == "_timestamp_received":
        return ("_timestamp_received", *directive.source)
    if directive.source:
        return directive.source
    if name == "_tags":
        return settings.tags_fields
    if name == "_raw":
        return settings.raw_fields
    if name == "_source":
        return settings.source_fields
    return (name[1:], name) if name.startswith("_") and len(name) > 1 else (name,)


def default_of(directive: Directive, type_: str, now: Column) -> Column:
    """A directive's default as a value of the column's type, else null."""
    spark, d = spark_type(type_), directive.default
    if isinstance(d, Literal):
        return F.lit(d.value).cast("string").try_cast(spark) if d.value is not None else F.lit(None).cast(spark)
    found = {"now()": now.cast("string"), "uuid()": F.uuid(), "topic_name": F.col("topic")}.get(d or "")
    return (found if found is not None else F.lit(None)).try_cast(spark)


Field = tuple[ColumnSpec, Directive, tuple[str, ...]]


def columns_of(df: DataFrame, table: TableSpec, settings: Settings) -> tuple[dict[str, Column], dict[str, Field]]:
    """The table's columns that are made of the message as it is, and those that are read
    from the record."""
    mode = settings.capture_of(table)
    to_json, to_raw = CAPTURE[mode]
    made: dict[str, Column] = {}
    fields: dict[str, Field] = {}
    for c in table.columns:
        d = directive_of(table, c, settings)
        paths = sources_of(c, d, settings)
        if not paths:
            continue
        if c.name == "_json" and not d.source:
            made["_json"] = F.col("value") if to_json else F.lit(None).cast("string")
        elif c.name == "_raw" and mode == "raw_only":
            made["_raw"] = F.col("value")
        elif c.name == "_raw" and not to_raw and mode != "full":
            made["_raw"] = F.lit(None).cast("string")
        elif c.name == "_org_id" and "_org" in df.columns:
            made["_org_id"] = F.col("_org")
        else:
            fields[c.name] = (c, d, paths)
    return made, fields


@dataclass
class Promoted:
    """Records with what was read from them: by key of the fields the value and the reason
    why it is refused, by key of fields and of further paths the text; ``inner`` columns
    are to be dropped."""

    df: DataFrame
    values: dict[Hashable, Column]
    wrong: dict[Hashable, Column]
    text: dict[Hashable, Column]
    inner: set[str]


def promote(df: DataFrame, fields: dict[Hashable, Field], extra: list[str], settings: Settings, now: Column) -> Promoted:
    """``fields`` of ``_record``, and ``extra`` paths as text, in steps that read every
    field, its text and its kind once each."""
    names = {n: f"_f{k}" for k, n in enumerate([*fields, *extra])}
    all_paths = {n: fields[n][2] if n in fields else (n,) for n in names}
    # the fields, each way of reading a path once
    readings = [tuple(keys) for n in names for p in all_paths[n] for keys in jsonpath.readings(p)]
    raw = {keys: f"_raw_{k}" for k, keys in enumerate(dict.fromkeys(readings))}
    df = jsonpath.columns_at(df, "_record", {c: keys for keys, c in raw.items()})

    def chosen(n: Hashable) -> Column:
        found = [F.col(raw[tuple(keys)]) for p in all_paths[n] for keys in jsonpath.readings(p)]
        return found[0] if len(found) == 1 else F.coalesce(*map(jsonpath.present, found))

    def is_(n: Hashable, *of: str) -> bool:
        return n in fields and fields[n][0].name in of

    df = df.withColumns({v: chosen(n) for n, v in names.items()}).drop(*raw.values())
    blank = lambda n, t: F.nullif(t, F.lit("")) if is_(n, "_org_id", "_source") else t
    with_number = lambda n: n in fields and not is_(n, "_timestamp", "_org_id") and wants_number(fields[n][0].type)
    with_kind = lambda n: n in fields and not with_number(n) and (is_(n, "_timestamp") or wants_kind(fields[n][0].type))
    kinds = [jsonpath.kind(F.col(v)).alias(f"{v}k") for n, v in names.items() if with_kind(n)] + [F.try_variant_get(F.col(v), "$", "bigint").alias(f"{v}n") for n, v in names.items() if with_number(n)]
    if names:
        df = jsonpath.once(df, "_read", F.struct(*[blank(n, jsonpath.as_text(F.col(v))).alias(f"{v}t") for n, v in names.items()], *kinds))
    text = {n: F.col(f"_read.{v}t") for n, v in names.items()}
    # values of the columns' types
    staged: dict[Hashable, Column] = {}
    for n, (c, _, _) in fields.items():
        v, t = F.col(names[n]), text[n]
        k = F.col(f"_read.{names[n]}k") if with_kind(n) else F.lit(None).cast("string")
        if is_(n, "_timestamp"):
            parse = timestamps.parse_iso if settings.quality is None else timestamps.lenient
            staged[n] = F.coalesce(parse(t), F.when(k != "STRING", timestamps.epoch_of(t)))
        elif not is_(n, "_org_id"):
            staged[n] = made_of(c.type, v, t, k, F.col(f"_read.{names[n]}n") if with_number(n) else None)
    if staged:
        df = jsonpath.once(df, "_made", F.struct(*[v.alias(names[n]) for n, v in staged.items()]))
    values: dict[Hashable, Column] = {}
    wrong_of: dict[Hashable, Column] = {}
    for n, (c, d, _) in fields.items():
        t, m = text[n], F.col(f"_made.{names[n]}")
        if is_(n, "_org_id"):
            values[n] = F.coalesce(t, F.lit(settings.routing.default_org_id))
        elif is_(n, "_timestamp"):
            q = settings.quality
            values[n] = F.coalesce(m, now) if q is None else timestamps.believed(m, t, now, q.max_future_seconds, q.max_past_seconds)["ts"]
        else:
            out, wrong = finished(c.type, m, t)
            if is_(n, "_timestamp_received"):
                out = F.coalesce(out, now.cast(spark_type(c.type)))
            elif is_(n, "_json"):
                out = F.coalesce(out, F.lit("{}"))
            elif d.default is not None:
                out = F.coalesce(F.when(t.isNotNull(), out), default_of(d, c.type, now))
            values[n] = out
            wrong_of[n] = F.when(wrong, F.concat(F.lit(f"{c.name} ({c.type}) cannot hold "), F.substring(t, 1, 60)))
    return Promoted(df, values, wrong_of, text, {"_read", "_made", *names.values()})


def ingest_time() -> Column:
    return F.date_trunc("millisecond", F.current_timestamp())


def read_keys(made: dict[str, Column], fields: dict[str, Field]) -> set[str]:
    """Top-level keys that a table's columns read."""
    return {x for _, _, paths in fields.values() for p in paths for x in (p, p.split(".")[0])} | ({"_org_id"} & set(made))


def extract(df: DataFrame, table: TableSpec, settings: Settings, now: Column | None = None, inputs: tuple[str, ...] = ()) -> DataFrame:
    """The table's columns from ``_record`` beside the columns of ``df``.

    Adds ``_reject`` where a value doesn't fit its column (with column and text) or
    where nothing was promoted and the capture mode doesn't keep the payload, and
    ``_unstored``, the top-level keys that no column reads.  ``inputs`` are paths that
    later stages read though the table has no such column; they come along as text.
    """
    now = ingest_time() if now is None else now
    made, fields = columns_of(df, table, settings)
    extra = [p for p in inputs if p not in fields and p not in made and p not in df.columns]
    found = promote(df, fields, extra, settings, now)
    df, text, made = found.df, found.text, made | found.values
    bad = list(found.wrong.values())
    read = read_keys(made, fields)
    keys = F.json_object_keys("value")
    unstored = F.filter(keys, lambda k: ~k.startswith("_") & ~k.isin(*read)) if read else keys
    promoted = F.coalesce(*[text[n] for n in fields if n != "_org_id"]).isNotNull() if set(fields) - {"_org_id"} else F.lit(False)
    reasons = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    before = F.col("_reject") if "_reject" in df.columns else F.lit(None).cast("string")
    nothing = F.lit(None).cast("string") if any(CAPTURE[settings.capture_of(table)]) else F.when(~promoted, "no column was promoted")
    refused = F.when(F.coalesce(*bad).isNotNull(), F.array_join(reasons, "; ")) if bad else F.lit(None).cast("string")
    kept = [F.col(f"`{x}`") for x in df.columns if x != "_reject" and x not in made and x not in found.inner]
    return df.select(*kept, *[v.alias(k) for k, v in made.items()], *[text[p].alias(p) for p in extra], F.coalesce(unstored, F.array().cast("array<string>")).alias("_unstored"), F.coalesce(before, refused, nothing).alias("_reject"))


def project(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str], list[str]]:
    """The known columns of ``df``, and the names dropped and missing."""
    return df.select(*[f"`{c}`" for c in df.columns if c in columns]), [c for c in df.columns if c not in columns], [c for c in columns if c not in df.columns]

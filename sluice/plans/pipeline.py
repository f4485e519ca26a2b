"""The event pipeline as one lazy plan: messages in; per table its rows, and the dead
letters, out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.coerce import spark_type
from sluice.operators import intake
from sluice.operators.directives import merged
from sluice.operators.enrich import Enrichment, enrich
from sluice.operators.extract import extract
from sluice.operators.mapping import Rule, apply_mapping, compute, merge_rules, names_in
from sluice.operators.model import Settings, TableSpec
from sluice.operators.routing import route, to_known_tables

#: Fixed names of the places a message can be refused.
STAGES = ("intake", "route", "extract", "sink")


@dataclass
class Routed:
    """Messages after intake and routing: ``good`` has ``_record``, ``_db`` and
    ``_table``; ``dead`` the dead letters so far."""

    good: DataFrame
    dead: DataFrame


def dead_letters(df: DataFrame, stage: str) -> DataFrame:
    table = F.concat_ws(".", "_db", "_table") if "_table" in df.columns else F.lit(None).cast("string")
    return df.where("_reject is not null").select(F.col("value").alias("payload"), F.col("_reject").alias("reason"), F.lit(stage).alias("stage"), "topic", "partition", "offset", table.alias("table"))


def admitted(messages: DataFrame, settings: Settings, filters: tuple[intake.Filter, ...] = ()) -> DataFrame:
    """Split, guarded and parsed messages, each with ``_reject``."""
    df = intake.split_lines(intake.split_arrays(messages))
    df = intake.gate(df)
    df = intake.guard_depth(df, settings.max_depth)
    df = intake.guard_header_keys(df)
    df = intake.prefilter(df, filters)
    return intake.parse(df)


def routed(messages: DataFrame, settings: Settings, known: list[str] | DataFrame | None = None, filters: tuple[intake.Filter, ...] = (), hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> Routed:
    """``hold`` may keep the admitted messages, which every table and the dead letters read."""
    df = hold(admitted(messages, settings, filters))
    dead = dead_letters(df, "intake")
    df = route(df.where("_reject is null"), settings.routing)
    dead = dead.unionByName(dead_letters(df, "route"))
    good = df.where("_reject is null")
    return Routed(to_known_tables(good, known, settings.routing) if known is not None else good, dead)


def inputs_of(rules: tuple[Rule, ...], computed: dict[str, str], by: Enrichment | None) -> tuple[str, ...]:
    """Record fields that mapping, computed columns and enrichment read."""
    wanted = [s for r in rules for s in r.sources] + [n for text in computed.values() for n in names_in(text)] + list(by.fields if by else ())
    return tuple(dict.fromkeys(wanted))


def table_rows(good: DataFrame, table: TableSpec, settings: Settings, now: Column | None = None, enrichment: Enrichment | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of one table and the dead letters of its records: extraction, then field
    mapping, enrichment and computed columns, each leaving alone what is there.  Fields that
    these stages read, and the table lacks, come along as text until they are done."""
    mine = good.where((F.col("_db") == table.db) & (F.col("_table") == table.table))
    names = [c.name for c in table.columns]
    renamed = tuple(Rule(c, paths, "rename") for c, paths in merged(table, settings, "renamed").items())
    rules, computed = merge_rules(settings.mapping, renamed, columns=names), merged(table, settings, "computed")
    inputs = inputs_of(rules, computed, enrichment)
    out = extract(mine, table, settings, now, inputs)
    rejected = dead_letters(out, "extract")
    rows = out.where("_reject is null")
    types = {c.name: spark_type(c.type) for c in table.columns if c.name in rows.columns or c.name in computed or any(c.name == r.destination for r in rules)}
    carried = tuple(i for i in inputs if i not in names)
    rows = apply_mapping(rows, rules, keep=carried, types=types)
    if enrichment is not None:
        rows = enrich(rows, enrichment)
    rows, _ = compute(rows, computed, texts=carried, types=types)
    return rows.select(*[f"`{c}`" for c in names if c in rows.columns]), rejected


def run(messages: DataFrame, tables: list[TableSpec], settings: Settings, now: Column | None = None, filters: tuple[intake.Filter, ...] = (), hold: Callable[[DataFrame], DataFrame] = lambda df: df, enrichment: Enrichment | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows by ``db.table``, and all dead letters.  Every message is in one of them or
    was dropped by a filter; records of unknown tables go to the default table."""
    parts = routed(messages, settings, [t.name for t in tables], filters, hold)
    out, dead = {}, parts.dead
    for t in tables:
        out[t.name], more = table_rows(parts.good, t, settings, now, enrichment)
        dead = dead.unionByName(more)
    return out, dead


# Bookkeeping over routed messages


def buffer_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes per table."""
    return df.groupBy(F.concat_ws(".", "_db", "_table").alias("table")).agg(F.count("*").alias("rows"), F.sum(F.octet_length("value")).cast("long").alias("bytes"))


def flush_plan(df: DataFrame, rows: int = 20_000, size: int = 64 << 20) -> DataFrame:
    """``df`` with ``_flush``, a growing number of the batch in its table that a row falls in:
    a batch has at most ``rows`` rows, and less than ``size`` bytes beside its first row.
    It ends wherever the rows so far pass a multiple of ``rows``, or their bytes one of
    ``size``.

    Rows of a table are counted within parts of ``rows`` consecutive offsets first, so
    no window holds a whole table.
    """
    part = F.floor(F.col("offset") / rows)
    key = ["_db", "_table", "topic", "partition"]
    cut = df.withColumn("_part", part)
    inside = Window.partitionBy(*key, "_part").orderBy("offset")
    cut = cut.withColumn("_n", F.row_number().over(inside)).withColumn("_b", F.sum(F.octet_length("value")).over(inside))
    sums = cut.groupBy(*key, "_part").agg(F.count("*").alias("pn"), F.sum(F.octet_length("value")).alias("pb"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*key, "_part", F.coalesce(F.sum("pn").over(before), F.lit(0)).alias("pn"), F.coalesce(F.sum("pb").over(before), F.lit(0)).alias("pb"))
    both = cut.join(sums, [*key, "_part"])
    full = F.floor((F.col("pn") + F.col("_n") - 1) / rows) + F.floor((F.col("pb") + F.col("_b") - 1) / size)
    return both.withColumn("_flush", full.cast("long")).drop("_n", "_b", "pn", "pb", "_part")


def commit_floor(df: DataFrame) -> DataFrame:
    """The lowest offset of each topic and partition."""
    return df.groupBy("topic", "partition").agg(F.min("offset").alias("floor"))


def committable(done: DataFrame, unplaced: DataFrame) -> DataFrame:
    """For each topic and partition the highest offset of ``done`` below every offset of
    ``unplaced``."""
    floor = commit_floor(unplaced)
    below = done.join(floor, ["topic", "partition"], "left").where("floor is null or offset < floor")
    return below.groupBy("topic", "partition").agg(F.max("offset").alias("commit"))


def deepest(df: DataFrame, k: int = 10) -> DataFrame:
    """The tables with the most rows, ties by name."""
    return df.groupBy(F.concat_ws(".", "_db", "_table").alias("table")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "table").limit(k)


def fallbacks(good: DataFrame) -> DataFrame:
    """Rows that went to another table than they named, by the table they named."""
    return good.where("_wanted <> concat_ws('.', _db, _table)").groupBy(F.col("_wanted").alias("table")).agg(F.count("*").alias("rows"))


def outcomes(placed: DataFrame, dead: DataFrame) -> DataFrame:
    """(topic, partition, outcome, first, last, rows): what became of the offsets."""
    both = placed.select("topic", "partition", "offset", F.lit("placed").alias("outcome")).unionByName(dead.select("topic", "partition", "offset", F.lit("dead").alias("outcome")))
    return both.groupBy("topic", "partition", "outcome").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("rows"))


def held_back(held: DataFrame, fresh: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Held messages and fresh ones together, at most ``most`` of a table: the newest, and
    apart the oldest, which are to be retired."""
    both = held.unionByName(fresh, allowMissingColumns=True)
    place = both.withColumn("_place", F.row_number().over(Window.partitionBy("_db", "_table").orderBy(F.desc("offset"), F.desc("partition"))))
    return place.where(F.col("_place") <= most).drop("_place"), place.where(F.col("_place") > most).drop("_place")


def pressure(lag: Column, depth: Column, latency: Column, memory: Column, errors: Column) -> Column:
    """One figure from 0 to 1 for scaling out, of five that go from 0 to 1."""
    return sum((F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) * w for x, w in ((lag, 0.35), (depth, 0.25), (latency, 0.15), (memory, 0.15), (errors, 0.10))), F.lit(0.0))


def metrics(good: DataFrame, dead: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """(name, value): accepted rows, rows of the default table, replaced tenants, fallbacks,
    records without a table field, dead letters by stage and, from the messages as they
    came, batches of either kind, in one frame."""
    counts = [F.count("*").alias("accepted"), F.count_if(F.col("_choice") == "default").alias("defaulted"), F.count_if("_tenant_replaced").alias("tenant_replaced"), F.count_if(F.col("_named").isNull()).alias("table_field_absent")]
    if "_wanted" in good.columns:
        counts.append(F.count_if(F.expr("_wanted <> concat_ws('.', _db, _table)")).alias("unknown_table"))
    found = good.agg(*counts)
    listed = lambda df: df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in df.columns])).alias("x")).select("x.*")
    out = listed(found).union(dead.groupBy(F.concat(F.lit("dead_"), "stage").alias("name")).agg(F.count("*").alias("value")))
    headers = dead.agg(F.count_if(F.col("reason").startswith("header key")).alias("duplicate_header"))
    out = out.union(listed(headers))
    if messages is not None:
        out = out.union(listed(messages.agg(F.count_if(F.ltrim("value").startswith("[")).alias("array_batches"), F.count_if(F.col("value").rlike(r"\}[ \t\r]*\n[ \t\r\n]*\{")).alias("line_batches"))))
    return out

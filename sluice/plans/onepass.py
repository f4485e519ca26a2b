"""Every table's rows and all dead letters in one frame, from one scan of the messages.

A field that several tables read in the same way is read once; which tables a value
counts for is decided by the row's own table.  Counters are observed in the same pass,
so they come with the write of the frame, in batch and on a stream alike.
"""

from __future__ import annotations

from collections.abc import Hashable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sluice.functions.coerce import spark_type
from sluice.operators import intake, mapping
from sluice.operators.enrich import Enrichment, enrich
from sluice.operators.directives import merged
from sluice.operators.extract import CAPTURE, columns_of, ingest_time, promote, read_keys
from sluice.operators.model import Settings, TableSpec
from sluice.operators.routing import route, to_known_tables
from sluice.plans.pipeline import admitted, inputs_of

#: The table that dead letters are tagged with.
DEAD = "_dead"
#: Columns of the tagged frame beside those of the tables.
TAGS = ("_table", "_target", "_stage", "_reject", "_payload", "_topic", "_partition", "_offset")
#: Fixed names of the counters.
COUNTERS = (
    "messages", "accepted", "dead_intake", "dead_route", "dead_extract", "defaulted", "tenant_replaced", "table_field_absent", "unknown_table", "duplicate_header",
    "fields_unstored", "computed_failed", "array_messages", "array_records", "line_messages", "line_records",
)


def _of_tables(names: list[str], count: int) -> Column:
    """Whether a row belongs to one of the tables; ``count`` is that of all tables."""
    return F.lit(True) if len(names) == count else F.col("_name").isin(*names)


def _types(tables: list[TableSpec]) -> dict[str, str]:
    """The type of every column; one name has one type in all tables."""
    types: dict[str, str] = {}
    for t in tables:
        for c in t.columns:
            if types.setdefault(c.name, spark_type(c.type)) != spark_type(c.type):
                raise ValueError(f"tables disagree about the type of {c.name}; run them apart")
    return types


def tagged(messages: DataFrame, tables: list[TableSpec], settings: Settings, now: Column | None = None, filters: tuple[intake.Filter, ...] = (), enrichment: Enrichment | None = None, counters: Observation | str | None = None) -> DataFrame:
    """One row for each record and each refused message: ``TAGS``, then the columns of all
    tables, of which a row has those of its own table and null in the others.

    Records are extracted, mapped, enriched and computed as in ``pipeline.run``; dead
    letters are tagged ``DEAD``, with the table they were meant for, stage, reason and payload.  ``counters`` observes
    ``COUNTERS`` under a name, or in an ``Observation``, when the frame is written.
    """
    now, known, types = ingest_time() if now is None else now, [t.name for t in tables], _types(tables)
    batches = _batch_kinds(messages)
    df = admitted(batches, settings, filters)
    df = df.withColumn("_first", F.col("_reject"))
    df = route(df, settings.routing)
    df = df.withColumn("_second", F.col("_reject"))
    df = to_known_tables(df, known, settings.routing)
    df = df.withColumns({"_name": F.concat_ws(".", "_db", "_table"), "_record": F.when(F.col("_reject").isNull(), F.col("_record"))})
    # what each table reads; the same field of several tables is one
    plans, fields, rules, computed = {}, {}, {}, {}
    inputs: list[str] = []
    for t in tables:
        made, own = columns_of(df, t, settings)
        renamed = tuple(mapping.Rule(c, paths, "rename") for c, paths in merged(t, settings, "renamed").items())
        rules[t.name], computed[t.name] = mapping.merge_rules(settings.mapping, renamed, columns=[c.name for c in t.columns]), merged(t, settings, "computed")
        keyed: dict[str, Hashable] = {n: (c.name, c.type, d, paths) for n, (c, d, paths) in own.items()}
        fields |= {keyed[n]: f for n, f in own.items()}
        plans[t.name] = made, own, keyed
        inputs += [i for i in inputs_of(rules[t.name], computed[t.name], enrichment) if i not in inputs and i not in types]
    found = promote(df, fields, inputs, settings, now)
    columns: dict[str, Column] = {}
    for name, kind in types.items():
        values: dict[Hashable, tuple[Column, list[str]]] = {}
        for t, (made, _, keyed) in plans.items():
            if name in keyed:
                values.setdefault(keyed[name], (found.values[keyed[name]], []))[1].append(t)
            elif name in made:
                values.setdefault((name, str(made[name])), (made[name], []))[1].append(t)
        columns[name] = F.coalesce(*[F.when(_of_tables(ts, len(tables)), v) for v, ts in values.values()], F.lit(None).cast(kind))
    wrong = [F.when(_of_tables([t for t, (_, _, keyed) in plans.items() if key in keyed.values()], len(tables)), w) for key, w in found.wrong.items()]
    bare = []  # tables that keep no payload, and what their records must have some of
    for t in tables:
        _, own, keyed = plans[t.name]
        if not any(CAPTURE[settings.capture_of(t)]):
            some = F.coalesce(*[found.text[keyed[n]] for n in own if n != "_org_id"]).isNotNull() if set(own) - {"_org_id"} else F.lit(False)
            bare.append((F.col("_name") == t.name) & ~some)
    refused = F.when(F.coalesce(*wrong).isNotNull(), F.array_join(F.array_compact(F.array(*wrong)), "; ")) if wrong else F.lit(None).cast("string")
    nothing = F.when(reduce(lambda a, b: a | b, bare), F.lit("no column was promoted")) if bare else F.lit(None).cast("string")
    keys = F.json_object_keys("value")
    read = F.create_map(*[x for t, (made, own, _) in plans.items() for x in (F.lit(t), F.array(*map(F.lit, sorted(read_keys(made, own)))).cast("array<string>"))])
    unstored = F.filter(keys, lambda k: ~k.startswith("_") & ~F.array_contains(F.element_at(read, F.col("_name")), k))
    reject = F.coalesce(F.col("_reject"), refused, nothing)
    stage = F.when(F.col("_first").isNotNull(), "intake").when(F.col("_second").isNotNull(), "route").when(reject.isNotNull(), "extract")
    kept = ["_choice", "_tenant_replaced", "_named", "_wanted", "_name", "_array_records", "_line_records"]
    state = {"_target": F.when(F.col("_first").isNull(), F.col("_name")), "_stage": stage, "_reject": reject, "_payload": F.when(reject.isNotNull(), F.col("value")), "_topic": F.col("topic"), "_partition": F.col("partition"), "_offset": F.col("offset"), "_unstored": F.coalesce(F.size(unstored), F.lit(0))}
    inner = {c: f"_carried_{k}" for k, c in enumerate(inputs)}
    rows = found.df.select(*[F.col(c).alias(f"_tag{c}") for c in kept], *[v.alias(f"_tag{c}") for c, v in state.items()], *[v.alias(c) for c, v in columns.items()], *[found.text[i].alias(inner[i]) for i in inputs])
    rows = _later_stages(rows, tables, types, rules, computed, inner, enrichment)
    if counters is not None:
        rows = rows.observe(counters, *_counters())
    name = F.when(F.col("_tag_reject").isNotNull(), F.lit(DEAD)).otherwise(F.col("_tag_name"))
    good = F.col("_tag_reject").isNull()
    return rows.select(name.alias("_table"), *[F.col(f"_tag{c}").alias(c) for c in TAGS if c != "_table"], *[F.when(good, F.col(f"`{c}`")).alias(c) for c in types])


def _later_stages(rows: DataFrame, tables: list[TableSpec], types: dict[str, str], rules: dict, computed: dict, inner: dict[str, str], enrichment: Enrichment | None) -> DataFrame:
    """Mapping, enrichment and computed columns, each on the rows of the tables that have
    it.  Fields that only these stages read have names of their own until they are done."""
    if any(rules.values()) or any(computed.values()) or enrichment is not None:
        rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in inner.values()], *[F.col(i).alias(c) for c, i in inner.items()])
    rows = _mapped(rows, tables, types, rules, tuple(inner))
    if enrichment is not None:
        looked = enrich(rows, enrichment)
        more = [F.col(f"`{c}`").try_cast(types[c]).alias(c) for c in looked.columns if c not in rows.columns and c in types]
        rows = looked.select(*[F.col(f"`{c}`") for c in rows.columns], *more)
    rows = _computed(rows, tables, types, computed, tuple(inner), "_tag_failed")
    missing = [F.lit(None).cast(k).alias(c) for c, k in types.items() if c not in rows.columns]
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.startswith("_tag") or c in types], *missing)


def _beside(rows: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` with a second copy of every column, and where the copies are."""
    old = {c: f"_old_{k}" for k, c in enumerate(rows.columns)}
    return rows.select("*", *[F.col(f"`{c}`").alias(o) for c, o in old.items()]), {c: F.col(o) for c, o in old.items()}


def _on_rows(own: Column, made: DataFrame, old: dict[str, Column]) -> list[Column]:
    """Columns of ``made`` on a table's ``own`` rows, and on others as they were."""
    kept = [(F.when(own, F.col(f"`{c}`")).otherwise(o) if c in made.columns else F.when(~own, o)).alias(c) for c, o in old.items()]
    return kept + [F.when(own, F.col(f"`{c}`")).alias(c) for c in made.columns if c not in old and not c.startswith("_old_")]


def _mapped(rows: DataFrame, tables: list[TableSpec], types: dict[str, str], rules: dict, keep: tuple[str, ...]) -> DataFrame:
    for t in tables:
        if rules[t.name]:
            copied, old = _beside(rows)
            rows = mapping.apply_mapping(copied, rules[t.name], keep=keep, types=types)
            rows = rows.select(*_on_rows(F.coalesce(old["_tag_name"] == t.name, F.lit(False)), rows, old))
    return rows


def _computed(rows: DataFrame, tables: list[TableSpec], types: dict[str, str], computed: dict[str, dict[str, str]], texts: tuple[str, ...], failed: str) -> DataFrame:
    rows = rows.withColumn(failed, F.lit(0))
    for t in tables:
        if not computed[t.name]:
            continue
        copied, old = _beside(rows)
        made, not_compiled = mapping.compute(copied, computed[t.name], texts=texts, types=types, failures="_failures")
        own = F.coalesce(old["_tag_name"] == t.name, F.lit(False)) & old["_tag_reject"].isNull()
        made = made.withColumn(failed, F.size("_failures") + len(not_compiled)).drop("_failures")
        rows = made.select(*_on_rows(own, made, old))
    return rows


def _batch_kinds(messages: DataFrame) -> DataFrame:
    """Messages with the kind of batch they look like, which their records keep."""
    value = F.col("value")
    return messages.withColumns({"_array_records": F.coalesce(F.ltrim(value).startswith("["), F.lit(False)), "_line_records": F.coalesce(value.rlike(r"\}[ \t\r]*\n[ \t\r\n]*\{") & ~F.ltrim(value).startswith("["), F.lit(False))})


def _counters() -> list[Column]:
    c = lambda name: F.col(f"_tag{name}")
    good = c("_reject").isNull()
    # records of one message share its offset; a batch counts once for each
    same = F.struct(c("_topic"), c("_partition"), c("_offset"))
    made = {
        "messages": F.count("*"),
        "accepted": F.count_if(good),
        **{f"dead_{s}": F.count_if(c("_stage") == s) for s in ("intake", "route", "extract")},
        "defaulted": F.count_if(good & (c("_choice") == "default")),
        "tenant_replaced": F.count_if(good & c("_tenant_replaced")),
        "table_field_absent": F.count_if(good & c("_named").isNull()),
        "unknown_table": F.count_if(good & (c("_wanted") != c("_name"))),
        "duplicate_header": F.count_if(c("_reject").startswith("header key")),
        "fields_unstored": F.sum(F.when(good, c("_unstored")).otherwise(0)),
        "computed_failed": F.sum(F.when(good, F.col("_tag_failed")).otherwise(0)),
        "array_messages": F.approx_count_distinct(F.when(c("_array_records"), same), 0.01),
        "array_records": F.count_if(c("_array_records")),
        "line_messages": F.approx_count_distinct(F.when(c("_line_records"), same), 0.01),
        "line_records": F.count_if(c("_line_records")),
    }
    return [F.coalesce(made[n], F.lit(0)).cast("long").alias(n) for n in COUNTERS]


def write_tagged(frame: DataFrame, path: str, form: str = "parquet") -> None:
    """All tables and the dead letters in one write, in a folder for each ``_table``."""
    frame.write.mode("overwrite").partitionBy("_table").format(form).save(path)


def letters(frame: DataFrame) -> DataFrame:
    """The dead letters of a tagged frame, in the columns of ``pipeline.dead_letters``."""
    named = {"_payload": "payload", "_reject": "reason", "_stage": "stage", "_topic": "topic", "_partition": "partition", "_offset": "offset", "_target": "table"}
    return frame.where(F.col("_table") == DEAD).select(*[F.col(c).alias(n) for c, n in named.items()])


def read_table(spark: SparkSession, path: str, table: TableSpec, form: str = "parquet") -> DataFrame:
    """The rows of one table of what ``write_tagged`` has written."""
    types = {c.name: spark_type(c.type) for c in table.columns}
    schema = ", ".join(f"`{c}` {t}" for c, t in types.items())
    return spark.read.schema(schema).format(form).load(f"{path}/_table={table.name}")


class Counters(StreamingQueryListener):
    """Sums of the observed counters of the streams of a session, by the name under which
    ``tagged`` observes them; add it with ``spark.streams.addListener``."""

    def __init__(self, name: str = "sluice"):
        self.name, self.totals, self.batches = name, dict.fromkeys(COUNTERS, 0), 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = (event.progress.observedMetrics or {}).get(self.name)
        if row is not None:
            self.batches += 1
            for n in COUNTERS:
                self.totals[n] += row[n]

    def onQueryTerminated(self, event) -> None:
        pass

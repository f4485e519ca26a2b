"""Routing of records to a database and table by their own fields."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import jsonpath
from sluice.operators.model import Routing


def lookup(key: Column, values: dict[str, str], otherwise: Column) -> Column:
    """A fixed mapping of the settings, as a literal map."""
    if not values:
        return otherwise
    return F.coalesce(F.element_at(F.create_map(*map(F.lit, chain.from_iterable(values.items()))), key), otherwise)


def source_of_topic(topic: Column, suffixes: tuple[str, ...]) -> Column:
    """The topic without the first suffix that it ends in; null if with none."""
    out = F.lit(None).cast("string")
    for s in reversed(suffixes):
        out = F.when(topic.endswith(s) & (F.length(topic) > len(s)), F.substring(topic, F.lit(1), F.length(topic) - len(s))).otherwise(out)
    return out


def enforce_external(df: DataFrame, routing: Routing) -> DataFrame:
    """Adds ``_org`` and ``_named``, the tenant and source a record may claim: on an
    external topic a value outside its allow-list is replaced by the topic's own."""
    paths = dict.fromkeys((routing.org_field, *routing.table_fields))
    inner = {p: f"_r{k}" for k, p in enumerate(paths)}
    df = df.withColumns({c: jsonpath.at(F.col("_record"), p.split(".")) for p, c in inner.items()})
    df = jsonpath.once(df, "_fields", F.struct(*[jsonpath.string_of(F.col(c)).alias(c) for c in inner.values()]))
    org = F.col(f"_fields.{inner[routing.org_field]}")
    named = F.coalesce(*[F.nullif(F.col(f"_fields.{inner[p]}"), F.lit("")) for p in routing.table_fields])
    df = df.withColumns({"_org": F.when(F.trim(org) != "", org).otherwise(F.lit(routing.default_org_id)), "_named": named}).drop("_fields", *inner.values())
    if not routing.external:
        return df.withColumn("_tenant_replaced", F.lit(False))
    org, named = F.col("_org"), F.col("_named")
    replaced = F.lit(False)
    for e in routing.external:
        here = F.col("topic") == e.topic
        bad_org = here & ~org.isin(*(e.allowed_orgs or (e.org,)))
        org, replaced = F.when(bad_org, e.org).otherwise(org), replaced | bad_org
        if e.source is not None:
            bad = here & ~F.coalesce(named.isin(*(e.allowed_sources or (e.source,))), F.lit(False))
            named, replaced = F.when(bad, e.source).otherwise(named), replaced | bad
    return df.withColumns({"_org": org, "_named": named, "_tenant_replaced": F.coalesce(replaced, F.lit(False))})


def route(df: DataFrame, routing: Routing) -> DataFrame:
    """Adds ``_db``, ``_table``, ``_org`` and ``_choice`` (pinned, named, topic or default).

    In order: a pinned topic; the first non-empty string of the table fields; what the
    topic says, unless that leads to the default table; the default table.  A record
    that names a pinned table is sent to the default.  An empty database or table
    rejects the record, or falls back to the defaults if there are no dead letters.
    """
    df = enforce_external(df, routing)
    table = lambda source: lookup(source, routing.source_to_table, source)
    pinned = lookup(F.col("topic"), routing.pinned_topics, F.lit(None).cast("string"))
    named = table(F.col("_named"))
    by_topic = table(source_of_topic(F.col("topic"), routing.topic_suffixes))
    by_topic = F.when(by_topic != routing.default_table, by_topic)
    closed = list(set(routing.pinned_topics.values()))
    chosen = F.coalesce(named, by_topic, F.lit(routing.default_table))
    choice = F.when(pinned.isNotNull(), "pinned").when(named.isNotNull(), "named").when(by_topic.isNotNull(), "topic").otherwise("default")
    if closed:
        choice = F.when(pinned.isNull() & chosen.isin(closed), "default").otherwise(choice)
        chosen = F.when(chosen.isin(closed), F.lit(routing.default_table)).otherwise(chosen)
    db = lookup(F.col("_org"), routing.org_routes, F.lit(routing.default_db))
    df = df.withColumns({"_db": db, "_table": F.coalesce(pinned, chosen), "_choice": choice})
    empty = (F.col("_db") == "") | (F.col("_table") == "")
    if routing.dead_letters:
        before = F.col("_reject") if "_reject" in df.columns else F.lit(None).cast("string")
        return df.withColumn("_reject", F.coalesce(before, F.when(empty, F.lit("empty_db_or_table"))))
    return df.withColumns({"_db": F.coalesce(F.nullif("_db", F.lit("")), F.lit(routing.default_db)), "_table": F.coalesce(F.nullif("_table", F.lit("")), F.lit(routing.default_table))})


def to_known_tables(df: DataFrame, known: list[str] | DataFrame, routing: Routing) -> DataFrame:
    """Records of tables that don't exist go to the default table, the wanted name in
    ``_wanted``.  ``known`` lists ``db.table``, or is a table of names for a left join."""
    name = F.concat_ws(".", "_db", "_table")
    df = df.withColumn("_wanted", name)
    if isinstance(known, DataFrame):
        there = known.select(F.col(known.columns[0]).alias("_known")).distinct()
        df = df.join(there, name == F.col("_known"), "left").withColumn("_there", F.col("_known").isNotNull()).drop("_known")
    else:
        df = df.withColumn("_there", name.isin(*known) if known else F.lit(False))
    return df.withColumns({"_db": F.when(F.col("_there"), F.col("_db")).otherwise(F.lit(routing.default_db)), "_table": F.when(F.col("_there"), F.col("_table")).otherwise(F.lit(routing.default_table))}).drop("_there")

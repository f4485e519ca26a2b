"""Registered queries of the event engine, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions import ip, jsonpath, timestamps
from sluice.functions import sql as sql_names
from sluice.functions.coerce import coerced, with_coerced
from sluice.operators import enrich, flatten, intake, mapping
from sluice.operators.extract import extract
from sluice.operators.model import ColumnSpec, ExternalTopic, Quality, Risk, Routing, Settings, TableSpec
from sluice.operators.routing import route
from sluice.plans import pipeline
from sluice.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def events(spark: SparkSession, d: str) -> DataFrame:
    return readers.spread(table(spark, d, "events"))


def event_messages(spark: SparkSession, d: str) -> DataFrame:
    """``events`` as JSON messages with ``event_id`` as offset."""
    e = events(spark, d)
    body = F.to_json(F.struct("event_id", timestamps.utc_text(F.col("ts")).alias("timestamp"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"), "event_type", "value", F.parse_json("props").alias("props")))
    return intake.messages(e, body, "events_land", F.col("event_id"))


ROUTING = Routing(table_fields=("event_type",), source_to_table={"click": "clicks", "view": "views", "error": "errors"}, default_table="events", default_db="main")
KNOWN = [f"main.{t}" for t in ("clicks", "views", "errors", "events")]
def address() -> Column:
    """A made-up address of an event, private for every third user."""
    return F.concat_ws(".", F.when(F.col("user_id") % 3 == 0, "10").otherwise("8"), (F.col("user_id") % 256).cast("string"), (F.col("event_id") % 256).cast("string"), F.lit("7"))

_ADDRESS_SQL = "CASE WHEN user_id % 3 = 0 THEN '10' ELSE '8' END || '.' || (user_id % 256) || '.' || (event_id % 256) || '.7'"


@query("""SELECT 'main.' || CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' WHEN 'error' THEN 'errors' ELSE 'events' END AS "table", count(*) AS rows FROM events GROUP BY 1""")
def route_events_by_type(spark, d):
    good = pipeline.routed(event_messages(spark, d), Settings(routing=ROUTING), KNOWN).good
    return good.groupBy(F.concat_ws(".", "_db", "_table").alias("table")).agg(F.count("*").alias("rows"))


@query("SELECT CASE WHEN event_type IN ('click','view','error','signup','purchase') THEN 'named' ELSE 'default' END AS choice, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def route_choice_counts(spark, d):
    good = pipeline.routed(event_messages(spark, d), Settings(routing=ROUTING)).good
    return good.groupBy(F.col("_choice").alias("choice"), jsonpath.string_field(F.col("_record"), "event_type").alias("event_type")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus IN ('O','F') THEN o_orderstatus ELSE 'F' END AS org, o_orderstatus NOT IN ('O','F') AS replaced FROM orders")
def tenant_enforce_external(spark, d):
    o = table(spark, d, "orders")
    m = intake.messages(o, F.to_json(F.struct(F.col("o_orderstatus").alias("_org_id"), "o_orderkey")), "partner_land", F.col("o_orderkey"))
    r = Routing(external=(ExternalTopic("partner_land", "F", ("O", "F")),))
    good = route(intake.parse(m), r)
    return good.select(F.col("offset").alias("o_orderkey"), F.col("_org").alias("org"), F.col("_tenant_replaced").alias("replaced"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k')) AS first_present FROM events")
def extract_props_first_present(spark, d):
    e = table(spark, d, "events").withColumn("r", F.parse_json("props"))
    return e.select("event_id", jsonpath.as_text(jsonpath.first_field(F.col("r"), ("missing", "k"))).alias("first_present"))


EVENT_TABLE = TableSpec("main", "events", (
    ColumnSpec("event_id", "Int64"), ColumnSpec("event_type"), ColumnSpec("k", "Int32", "the key @source: props.k"), ColumnSpec("topic", "String", '@source: nowhere | topic_name'),
    ColumnSpec("level", "String", "@default: info"), ColumnSpec("_timestamp", "DateTime64(6)"), ColumnSpec("_json"),
))


def _events_extracted(spark, d, settings=Settings(routing=Routing(default_db="main"))):
    m = event_messages(spark, d)
    return extract(intake.parse(m), EVENT_TABLE, settings, F.lit("2025-01-01 00:00:00").cast("timestamp"))


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k, date_trunc('milliseconds', ts) AS at_ms FROM events")
def extract_to_schema(spark, d):
    return _events_extracted(spark, d).select("event_id", "event_type", "k", F.date_trunc("millisecond", "_timestamp").cast("timestamp_ntz").alias("at_ms"))


@query("SELECT event_id, 'info' AS level, 'events_land' AS topic_name FROM events")
def directive_defaults(spark, d):
    m = event_messages(spark, d).withColumnRenamed("topic", "t").withColumn("topic", F.col("t"))
    out = extract(intake.parse(m), TableSpec("main", "events", (ColumnSpec("event_id", "Int64"), ColumnSpec("level", "String", "@default: info"), ColumnSpec("topic_name", "String", "@source: nowhere | topic_name"))), Settings())
    return out.select("event_id", "level", "topic_name")


@query("SELECT mode, count(*) AS n, CAST(sum(CASE WHEN mode IN ('full','json_only') THEN 1 ELSE 0 END) AS BIGINT) AS with_json, CAST(sum(CASE WHEN mode = 'raw_only' THEN 1 ELSE 0 END) AS BIGINT) AS with_raw FROM events, (VALUES ('full'),('json_only'),('raw_only'),('extracted_only')) AS m(mode) GROUP BY mode")
def capture_modes(spark, d):
    m, out = intake.parse(event_messages(spark, d)), None
    for mode in ("full", "json_only", "raw_only", "extracted_only"):
        t = TableSpec("main", "events", (ColumnSpec("event_id", "Int64"), ColumnSpec("_json"), ColumnSpec("_raw")), f"@capture_mode: {mode}")
        one = extract(m, t, Settings()).agg(F.lit(mode).alias("mode"), F.count("*").alias("n"), F.count_if(F.col("_json").isNotNull()).alias("with_json"), F.count_if(F.col("_raw").isNotNull()).alias("with_raw"))
        out = one if out is None else out.unionByName(one)
    return out


_BAD = ["plain text", '{"a":', '{"a":1}{"b":2}', "[1,2]", '{"_org_id":"a","_org_id":"b"}', "[" * 70 + "]" * 70, ""]
_REASONS = ("not JSON", "JSON parse error", "several records", "JSON array", "header key", "nested past", "not JSON")


@query("""SELECT CASE event_id % 8 WHEN 0 THEN 'good' WHEN 1 THEN 'not JSON' WHEN 2 THEN 'JSON parse error' WHEN 3 THEN 'several records' WHEN 4 THEN 'JSON array' WHEN 5 THEN 'header key' WHEN 6 THEN 'nested past' ELSE 'not JSON' END AS reason, count(*) AS n FROM events GROUP BY 1""")
def json_gate_reasons(spark, d):
    e = events(spark, d)
    value = F.when(F.col("event_id") % 8 == 0, F.col("props")).otherwise(F.get(F.array(*map(F.lit, _BAD)), (F.col("event_id") % 8 - 1).cast("int")))
    df = pipeline.admitted(intake.messages(e, value, "events_land", F.col("event_id")), Settings())
    short = F.lit("good")
    for r in sorted(set(_REASONS)):
        short = F.when(F.col("_reject").startswith(r), r).otherwise(short)
    return df.groupBy(short.alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT conv_id, turn, role, length(text) AS n FROM conversations")
def fanout_conversation_array(spark, d):
    c = table(spark, d, "conversations")
    body = F.to_json(F.sort_array(F.collect_list(F.struct("turn", "conv_id", "role", "text"))))
    m = intake.messages(c.groupBy("conv_id").agg(body.alias("value")), F.col("value"), "conv_land", F.col("conv_id"))
    r = F.from_json("value", "conv_id long, turn long, role string, text string")
    return intake.split_arrays(m).select(r.alias("r")).select("r.conv_id", "r.turn", "r.role", F.length("r.text").alias("n"))


@query("SELECT conv_id, count(*) AS turns, CAST(sum(turn) AS BIGINT) AS turn_sum FROM conversations GROUP BY conv_id")
def fanout_conversation_lines(spark, d):
    c = table(spark, d, "conversations")
    lines = F.array_join(F.sort_array(F.collect_list(F.to_json(F.struct("turn", "conv_id", "role", "text")))), "\n")
    m = intake.messages(c.groupBy("conv_id").agg(lines.alias("value")), F.col("value"), "conv_land", F.col("conv_id"))
    r = F.from_json("value", "conv_id long, turn long")
    return intake.split_lines(m).select(r.alias("r")).groupBy("r.conv_id").agg(F.count("*").alias("turns"), F.sum("r.turn").alias("turn_sum"))


@query("""SELECT o_orderkey AS "order.key", c_name AS "customer.name", n_name AS "customer.nation.name" FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def flatten_order_customer(spark, d):
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    return flatten.flatten(j.select(F.struct(F.col("o_orderkey").alias("key")).alias("order"), F.struct(F.col("c_name").alias("name"), F.struct(F.col("n_name").alias("name")).alias("nation")).alias("customer")))


@query("SELECT event_id, u.key, u.value FROM (SELECT event_id, unnest([{'key': 'k', 'value': json_extract_string(props, '$.k')}, {'key': 'in.event', 'value': event_type}, {'key': 'in.a', 'value': '[1,2]'}]) AS u FROM events) WHERE u.value IS NOT NULL")
def flatten_dynamic(spark, d):
    whole = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(',"@_in":{"event":"'), F.col("event_type"), F.lit('","__a":[1,2],"e":{}}}'))
    e = events(spark, d).select("event_id", flatten.flatten_map(whole).alias("m"))
    e = e.select("event_id", F.transform_keys("m", lambda k, _: F.regexp_replace(k, "[.]__a$", ".a")).alias("m"))
    return e.select("event_id", F.explode(flatten.clean_keys(F.col("m")))).select("event_id", "key", "value")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_name AS label, c_acctbal FROM customer")
def mapping_rename_copy(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    R = mapping.Rule
    return mapping.apply_mapping(c, (R("id", ("nothing", "c_custkey")), R("label", ("c_name",), "copy"), R("name", ("c_name",)), R("segment", ("c_mktsegment",)))).select("id", "name", "segment", "label", "c_acctbal")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 AND l_returnflag = 'R' THEN 'large return' WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS size, l_discount <> 0 AS cut FROM lineitem")
def computed_ternary(spark, d):
    rows, failed = mapping.compute(table(spark, d, "lineitem"), {"size": 'if(l_quantity > 25 && l_returnflag == "R", "large return", if(l_quantity > 25, "large", "small"))', "cut": "!(l_discount == 0)", "bad": "regexp_like(l_returnflag, 'R')"})
    assert failed == ["bad"]
    return rows.select("l_orderkey", "l_linenumber", "size", "cut")


@query("SELECT event_id, make_timestamp(CASE event_id % 4 WHEN 0 THEN (1700000000 + event_id) * 1000000 WHEN 1 THEN (1700000000 + event_id) * 1000000 + 250000 WHEN 2 THEN (1700000000 + event_id) * 1000000 + 250500 ELSE (1700000000 + event_id) * 1000000 + 250500 END) AS at FROM events")
def timestamp_epoch_magnitude(spark, d):
    s = F.col("event_id") + 1700000000
    n = F.when(F.col("event_id") % 4 == 0, s).when(F.col("event_id") % 4 == 1, s * 1000 + 250).when(F.col("event_id") % 4 == 2, s * 1000000 + 250500).otherwise(s * 1000000000 + 250500999)
    return table(spark, d, "events").select("event_id", timestamps.from_epoch(n).cast("timestamp_ntz").alias("at"))


_NOW = "2024-01-15 00:00:00"


@query(f"""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'corrected' WHEN event_id % 5 = 1 THEN 'replaced' WHEN epoch(ts) - epoch(TIMESTAMP '{_NOW}') > 600 OR epoch(TIMESTAMP '{_NOW}') - epoch(ts) > 864000 THEN 'replaced' ELSE 'valid' END AS quality FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def timestamp_dq_bounds(spark, d):
    text = F.when(F.col("event_id") % 5 == 0, "1700000000").when(F.col("event_id") % 5 == 1, "yesterday").otherwise(timestamps.utc_text(F.date_trunc("second", "ts")))
    got = timestamps.checked(text, F.lit(None).cast("long"), F.lit(_NOW).cast("timestamp"), 600, 864000)
    return events(spark, d).select("event_id", got["quality"].alias("quality"))


@query("SELECT event_id, strftime(date_trunc('milliseconds', ts) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS utc FROM events")
def timestamp_zoned_text(spark, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0200"))
    return table(spark, d, "events").select("event_id", timestamps.normalise_zoned(text).alias("utc"))


@query("""SELECT l_orderkey, l_linenumber, TRY_CAST(CAST(l_extendedprice AS BIGINT) % 70000 AS USMALLINT)::INTEGER AS u16, CAST(l_extendedprice AS BIGINT) % 70000 > 65535 AS refused FROM lineitem""")
def coerce_int_bounds(spark, d):
    n = F.expr("CAST(rint(l_extendedprice) AS BIGINT) % 70000")
    rows = with_coerced(readers.spread(table(spark, d, "lineitem")).select("l_orderkey", "l_linenumber", F.parse_json(n.cast("string")).alias("v")), {"u16": ("UInt16", F.col("v"))})
    return rows.select("l_orderkey", "l_linenumber", "u16", F.col("u16_refused").alias("refused"))


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '{\"list\":[' || turn || ']}' WHEN turn % 3 = 1 THEN '{\"value\":' || turn || '}' ELSE '{\"t\":' || turn || '}' END AS j FROM conversations")
def coerce_json_wrap(spark, d):
    t = F.col("turn").cast("string")
    v = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("["), t, F.lit("]"))).when(F.col("turn") % 3 == 1, t).otherwise(F.concat(F.lit('{"t":'), t, F.lit("}")))
    return table(spark, d, "conversations").select("conv_id", "turn", coerced("JSON", F.parse_json(v))[0].alias("j"))


@query("SELECT s_suppkey, [s_suppkey] AS one, round(s_acctbal, 2) AS balance, lpad(hex(s_suppkey), 32, '0') AS id FROM supplier")
def coerce_shapes(spark, d):
    s = table(spark, d, "supplier")
    as_json = lambda c: F.parse_json(F.to_json(F.struct(c.alias("x"))))
    get = lambda c: F.try_variant_get(as_json(c), "$.x", "variant")
    raw = F.lpad(F.hex("s_suppkey"), 32, "0")
    id_, _ = coerced("UUID", get(raw))
    return s.select("s_suppkey", coerced("Array(Int64)", get(F.col("s_suppkey")))[0].alias("one"), coerced("Decimal(12,2)", get(F.round("s_acctbal", 2).cast("string")))[0].cast("double").alias("balance"), F.upper(F.regexp_replace(id_, "-", "")).alias("id"))


@query(f"SELECT event_id, user_id % 3 = 0 AS private FROM (SELECT *, {_ADDRESS_SQL} AS ip FROM events)")
def ip_private_class(spark, d):
    return table(spark, d, "events").select("event_id", ip.is_private_v4(address()).alias("private"))


THREATS = [("8.0.0.0/12", "vpn", "a", 10, 1), ("8.3.0.0/16", "tor", "b", 60, 2), ("8.4.5.7", "botnet", "a", 0, 3), ("10.0.0.0/8", "scanner", "c", 5, 4), ("junk", "spam", "c", 0, 5)]
_THREATS_SQL = "(VALUES (8,0,15,0,255,'vpn',10,1),(8,3,3,0,255,'tor',60,2),(8,4,4,5,5,'botnet',0,3),(10,0,255,0,255,'scanner',5,4)) AS t(a, b1, b2, c1, c2, threat, score, o)"
_MATCHED_SQL = f"(SELECT event_id, min_by(threat, o) AS threat, max(score) AS score, bool_or(threat IN ('vpn','tor')) AS anon, bool_or(threat = 'vpn') AS vpn, bool_or(threat = 'tor') AS tor, bool_or(threat = 'botnet') AS botnet, bool_or(threat = 'scanner') AS scanner, count(DISTINCT threat) AS n FROM events JOIN {_THREATS_SQL} ON a = CASE WHEN user_id % 3 = 0 THEN 10 ELSE 8 END AND user_id % 256 BETWEEN b1 AND b2 AND event_id % 256 BETWEEN c1 AND c2 GROUP BY event_id)"


def _threats(spark):
    return spark.createDataFrame(THREATS, "network string, threat string, source string, score int, order int")


@query(f"SELECT e.event_id, coalesce(threat, 'none') AS threat, coalesce(anon, false) AS anonymizer, coalesce(n, 0) AS n FROM events e LEFT JOIN {_MATCHED_SQL} m ON e.event_id = m.event_id")
def ip_blocklist_cidr(spark, d):
    rows = events(spark, d).select("event_id", address().alias("ip"))
    out = enrich.reputation_lookup(rows, "ip", _threats(spark))
    n = F.coalesce(F.size("rep_threat_types"), (F.col("rep_threat_type") != "none").cast("int"))
    return out.select("event_id", F.col("rep_threat_type").alias("threat"), F.col("rep_is_anonymizer").alias("anonymizer"), n.cast("long").alias("n"))


RANGES = [("8.0.0.0/8", "US"), ("8.16.0.0/12", "FR"), ("8.17.0.0/16", "DE")]


@query("SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 256 = 17 THEN 'DE' WHEN user_id % 256 BETWEEN 16 AND 31 THEN 'FR' ELSE 'US' END AS country, user_id % 3 = 0 AS private FROM events")
def ip_geo_longest_prefix(spark, d):
    rows = table(spark, d, "events").select("event_id", address().alias("ip"))
    out = enrich.geo_lookup(rows, "ip", spark.createDataFrame(RANGES, "network string, country_code string"))
    return out.select("event_id", F.col("geo_country_code").alias("country"), F.col("geo_is_private").alias("private"))


@query(f"""WITH s AS (SELECT e.event_id, CASE WHEN user_id % 3 = 0 THEN 0 WHEN user_id % 256 = 17 THEN 60 WHEN user_id % 256 BETWEEN 16 AND 31 THEN 90 ELSE 15 END AS geo,
 least(100, CASE WHEN vpn THEN 50 ELSE 0 END + CASE WHEN tor THEN 80 ELSE 0 END) AS rep, CASE WHEN vpn AND tor THEN 70 WHEN vpn OR tor THEN 40 ELSE 0 END AS priv,
 least(100, CASE WHEN botnet THEN 95 + 90 ELSE 0 END + CASE WHEN scanner THEN 60 ELSE 0 END + coalesce(score, 0)) AS threat FROM events e LEFT JOIN {_MATCHED_SQL} m ON e.event_id = m.event_id),
 c AS (SELECT event_id, CAST((geo * 15 + rep * 25 + priv * 25 + threat * 35) // 100 AS INTEGER) AS risk_score FROM s)
 SELECT event_id, risk_score, CASE WHEN risk_score >= 80 THEN 'critical' WHEN risk_score >= 60 THEN 'high' WHEN risk_score >= 40 THEN 'medium' WHEN risk_score >= 20 THEN 'low' ELSE 'minimal' END AS risk_level FROM c""")
def risk_score_levels(spark, d):
    rows = events(spark, d).select("event_id", address().alias("ip"))
    found = enrich.reputation_lookup(enrich.geo_lookup(rows, "ip", spark.createDataFrame(RANGES, "network string, country_code string")), "ip", _threats(spark))
    return enrich.risk(found, Risk(high_countries=frozenset({"FR"}), medium_countries=frozenset({"DE"}))).select("event_id", "risk_score", "risk_level")


_TABLE_SQL = "'main.' || CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' WHEN 'error' THEN 'errors' ELSE 'events' END"


def _prop_messages(spark, d):
    """Messages that hold ``props`` alone, routed by a column: sizes that SQL can count."""
    e = table(spark, d, "events")
    return e.select(F.col("props").alias("value"), F.lit("t").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.lit("main").alias("_db"), F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ROUTING.source_to_table.items() for x in kv]), F.col("event_type")), F.lit("events")).alias("_table"))


@query(f"""SELECT {_TABLE_SQL} AS "table", count(*) AS rows, CAST(sum(strlen(props)) AS BIGINT) AS bytes FROM events GROUP BY 1""")
def buffer_stats_by_table(spark, d):
    return pipeline.buffer_stats(_prop_messages(spark, d))


@query("SELECT 't' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, max(event_id) AS commit FROM events WHERE event_id < (CASE event_id % 4 WHEN 0 THEN 400 WHEN 1 THEN 401 ELSE 1000000000 END) GROUP BY 1, 2")
def commit_floor(spark, d):
    m = _prop_messages(spark, d)
    return pipeline.committable(m, m.where("offset >= 400 and partition < 2"))


@query(f"""SELECT event_id, (row_number() OVER (PARTITION BY {_TABLE_SQL}, event_id % 4 ORDER BY event_id) - 1) // 100 AS flush FROM events""")
def flush_plan_rows(spark, d):
    return pipeline.flush_plan(_prop_messages(spark, d), rows=100).select(F.col("offset").alias("event_id"), F.col("_flush").alias("flush"))


@query(f"""SELECT {_TABLE_SQL} AS "table", count(*) AS rows FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def deepest_tables_topk(spark, d):
    return pipeline.deepest(_prop_messages(spark, d), 3)


@query("SELECT count(*) AS input, count(*) AS placed FROM events")
def conservation_check(spark, d):
    e = table(spark, d, "events")
    value = F.when(F.col("event_id") % 10 == 0, "junk").otherwise(F.to_json(F.struct(F.when(F.col("event_id") % 7 == 0, "x").otherwise(F.col("event_id").cast("string")).alias("event_id"), "event_type")))
    m = intake.messages(e, value, "events_land", F.col("event_id"))
    tables = [TableSpec("main", t, (ColumnSpec("event_id", "Int64"),)) for t in ("clicks", "events")]
    rows, dead = pipeline.run(m, tables, Settings(routing=ROUTING), hold=lambda df: df.persist())
    placed = dead.select("offset")
    for df in rows.values():
        placed = placed.union(df.select("event_id"))
    return m.agg(F.count("*").alias("input")).crossJoin(placed.agg(F.count("*").alias("placed")))  # two single rows


@query("""WITH m AS (SELECT event_id % 6 AS k FROM events) SELECT name, CAST(value AS BIGINT) AS value FROM (SELECT unnest([
 {'name': 'accepted', 'value': count(*) FILTER (k NOT IN (0, 1)) + count(*) FILTER (k = 2)}, {'name': 'defaulted', 'value': count(*) FILTER (k = 3)}, {'name': 'tenant_replaced', 'value': count(*) FILTER (k = 4)}, {'name': 'table_field_absent', 'value': count(*) FILTER (k = 3)},
 {'name': 'unknown_table', 'value': count(*) FILTER (k = 5)}, {'name': 'dead_intake', 'value': count(*) FILTER (k IN (0, 1))}, {'name': 'duplicate_header', 'value': count(*) FILTER (k = 1)}, {'name': 'array_batches', 'value': count(*) FILTER (k = 2)}, {'name': 'line_batches', 'value': 0}], recursive := true) FROM m)""")
def pipeline_metrics(spark, d):
    e = events(spark, d)
    values = ["junk", '{"_source":"a","_source":"b"}', '[{"event_type":"click"},{"event_type":"view"}]', '{"n":1}', '{"event_type":"click","_org_id":"theirs"}', '{"event_type":"unheard"}']
    m = intake.messages(e, F.get(F.array(*map(F.lit, values)), (F.col("event_id") % 6).cast("int")), "events_land", F.col("event_id"))
    routing = Routing(table_fields=("event_type",), source_to_table=ROUTING.source_to_table, default_db="main", external=(ExternalTopic("events_land", "default", ("default",)),), topic_suffixes=())
    parts = pipeline.routed(m, Settings(routing=routing), KNOWN)
    return pipeline.metrics(parts.good, parts.dead, m)


# Shapes of the published measurements: flat records of 30 and 15 columns, nested ones of 15


_SHAPE_TYPES = ("Int64", "String", "Float64")
#: Shapes by the name of their query: number of columns, and whether they are nested.
SHAPES = {"extract_flat30": (30, False), "extract_flat15": (15, False), "extract_nested15": (15, True)}


def shape_messages(spark, d, n: int, nested: bool) -> DataFrame:
    value = lambda k: (F.col("event_id") + k, F.concat(F.lit(f"v{k}-"), F.col("user_id").cast("string")), F.col("value") + k)[k % 3]
    fields = [value(k).alias(f"c{k}") for k in range(n)]
    if nested:
        fields = [F.struct(*fields[k : k + 5]).alias(f"g{k // 5}") for k in range(0, n, 5)]
    return intake.messages(events(spark, d), F.to_json(F.struct(*fields)), "events_land", F.col("event_id"))


def shape_rows(m: DataFrame, n: int, nested: bool) -> DataFrame:
    columns = tuple(ColumnSpec(f"c{k}", _SHAPE_TYPES[k % 3], f"@source: g{k // 5}.c{k}" if nested else "") for k in range(n))
    out = extract(intake.parse(m), TableSpec("main", "wide", columns, "@capture_mode: extracted_only"), Settings())
    return out.select(*[f"c{k}" for k in range(n)])


def _shape_sql(n: int) -> str:
    return "SELECT " + ", ".join((f"event_id + {k} AS c{k}", f"'v{k}-' || user_id AS c{k}", f"value + {k} AS c{k}")[k % 3] for k in range(n)) + " FROM events"


@query(_shape_sql(30))
def extract_flat30(spark, d):
    return shape_rows(shape_messages(spark, d, 30, False), 30, False)


@query(_shape_sql(15))
def extract_flat15(spark, d):
    return shape_rows(shape_messages(spark, d, 15, False), 15, False)


@query(_shape_sql(15))
def extract_nested15(spark, d):
    return shape_rows(shape_messages(spark, d, 15, True), 15, True)


@query("""SELECT event_id, 'h' || user_id AS host, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS size, CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 256 = 17 THEN 'DE' WHEN user_id % 256 BETWEEN 16 AND 31 THEN 'FR' ELSE 'US' END AS geo_country_code, user_id % 3 = 0 AS geo_is_private FROM events WHERE event_type = 'click'""")
def pipeline_enriched(spark, d):
    """Mapping, computed columns and enrichment over fields that the table lacks."""
    e = events(spark, d)
    body = F.to_json(F.struct("event_id", "event_type", F.concat(F.lit("h"), F.col("user_id").cast("string")).alias("hostname"), F.col("value").alias("reading"), address().alias("src_ip")))
    clicks = TableSpec("main", "clicks", (ColumnSpec("event_id", "Int64"), ColumnSpec("host", "String", "@renamed: hostname"), ColumnSpec("size", "String", '@computed: reading > 50 ? "high" : "low"'), ColumnSpec("geo_country_code"), ColumnSpec("geo_is_private", "Bool")))
    other = TableSpec("main", "events", (ColumnSpec("event_id", "Int64"),))
    by = enrich.Enrichment(spark.createDataFrame(RANGES, "network string, cc string"))
    rows, _ = pipeline.run(intake.messages(e, body, "events_land", F.col("event_id")), [clicks, other], Settings(routing=ROUTING), enrichment=by)
    return rows["main.clicks"]


@query("SELECT event_id, 64 + event_id % 3 - 1 > 64 AS refused FROM events")
def json_depth_escapes(spark, d):
    """Brackets in strings, behind escaped quotes, do not count."""
    opened = F.repeat(F.lit('{"a":'), (F.lit(63) + F.col("event_id") % 3 - 1).cast("int"))
    closed = F.repeat(F.lit("}"), (F.lit(63) + F.col("event_id") % 3 - 1).cast("int"))
    value = F.concat(opened, F.lit('{"s":"\\\\\\"[[[{{","t":"x\\\\"}'), closed)
    df = intake.guard_depth(intake.messages(events(spark, d), value, "events_land", F.col("event_id")))
    return df.select(F.col("offset").alias("event_id"), F.col("_reject").isNotNull().alias("refused"))


@query(f"""WITH c AS (SELECT event_id, {_TABLE_SQL} AS t, event_id % 4 AS p, strlen(props) AS n FROM events), w AS (SELECT event_id, row_number() OVER o AS r, sum(n) OVER o AS b FROM c WINDOW o AS (PARTITION BY t, p ORDER BY event_id))
 SELECT event_id, CAST((r - 1) // 7 + (b - 1) // 60 AS BIGINT) AS flush FROM w""")
def flush_plan_bytes(spark, d):
    """Batches that end at 7 rows or 60 bytes, whichever comes first."""
    return pipeline.flush_plan(_prop_messages(spark, d), rows=7, size=60).select(F.col("offset").alias("event_id"), F.col("_flush").alias("flush"))


@query("SELECT event_id, event_id % 4 IN (0, 1) AS private FROM events")
def ip_v6_private_class(spark, d):
    h = F.lower(F.hex(F.col("user_id") % 65536))
    text = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("FC00::"), h)).when(F.col("event_id") % 4 == 1, F.lit("::ffff:10.1.2.3")).when(F.col("event_id") % 4 == 2, F.concat(F.lit("2001:db8:0:0:0:0:0:"), h)).otherwise("::ffff:8.8.8.8")
    return events(spark, d).select("event_id", ip.is_private(text).alias("private"))


@query("SELECT event_id, CASE WHEN user_id % 16 = 1 THEN 'tor' WHEN user_id % 16 < 8 THEN 'vpn' ELSE 'none' END AS threat FROM events")
def ip_blocklist_v6(spark, d):
    rows = events(spark, d).select("event_id", F.concat(F.lit("2001:db8:"), F.lower(F.hex(F.col("user_id") % 16)), F.lit("000::"), F.lower(F.hex(F.col("event_id") % 65536))).alias("ip"))
    listed = spark.createDataFrame([("2001:db8::/33", "vpn", "a", 1, 2), ("2001:0DB8:1000::/36", "tor", "b", 2, 1)], "network string, threat string, source string, score int, order int")
    return enrich.reputation_lookup(rows, "ip", listed).select("event_id", F.col("rep_threat_type").alias("threat"))


@query("SELECT CASE WHEN event_id % 5 = 1 THEN 'too odd' ELSE 'kept' END AS reason, count(*) AS n FROM events WHERE event_id % 5 <> 0 GROUP BY 1")
def prefilter_counts(spark, d):
    m = intake.messages(table(spark, d, "events"), F.col("props"), "events_land", F.col("event_id"))
    out = intake.prefilter(m, (intake.Filter("offset % 5 = 0"), intake.Filter("offset % 5 = 1", "too odd")))
    return out.groupBy(F.coalesce("_reject", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT 'db' || event_id % 2 AS db, CASE event_id % 3 WHEN 0 THEN 'dead' WHEN 1 THEN 'audit' ELSE 'events' END AS "table", CASE event_id % 3 WHEN 0 THEN 'pinned' WHEN 1 THEN 'topic' ELSE 'default' END AS choice, count(*) AS n FROM events GROUP BY ALL""")
def route_topics_and_orgs(spark, d):
    """Pinned topics, tables by topic, and databases by tenant."""
    e = table(spark, d, "events")
    value = F.to_json(F.struct(F.concat(F.lit("org"), (F.col("event_id") % 2).cast("string")).alias("_org_id")))
    m = intake.messages(e, value, "t", F.col("event_id")).withColumn("topic", F.get(F.array(F.lit("replay"), F.lit("audit_land"), F.lit("other")), (F.col("offset") % 3).cast("int")))
    r = Routing(pinned_topics={"replay": "dead"}, org_routes={"org0": "db0", "org1": "db1"})
    return route(intake.parse(m), r).groupBy(F.col("_db").alias("db"), F.col("_table").alias("table"), F.col("_choice").alias("choice")).agg(F.count("*").alias("n"))


@query("""SELECT 'main.' || event_type AS "table", count(*) AS rows FROM events WHERE event_type NOT IN ('click', 'view', 'error') GROUP BY 1""")
def fallbacks_by_table(spark, d):
    return pipeline.fallbacks(pipeline.routed(event_messages(spark, d), Settings(routing=ROUTING), KNOWN).good)


@query("SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL ELSE event_id % 180 END AS x, CASE WHEN event_id % 6 = 5 THEN NULL ELSE event_id % 90 END AS y, event_id % 6 = 5 AS refused FROM events")
def coerce_points(spark, d):
    lon, lat = ((F.col("event_id") % n).cast("string") for n in (180, 90))
    quote = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    forms = [F.concat(F.lit("["), lon, F.lit(","), lat, F.lit("]")), quote(lat, F.lit(", "), lon), F.concat(F.lit('{"lon":'), lon, F.lit(',"lat":'), lat, F.lit("}")), quote(F.lit("POINT("), lon, F.lit(" "), lat, F.lit(")")), F.concat(F.lit('{"type":"Point","coordinates":['), lon, F.lit(","), lat, F.lit("]}")), quote(F.lit("u09tvw0"))]
    rows = with_coerced(events(spark, d).select("event_id", F.parse_json(F.get(F.array(*forms), (F.col("event_id") % 6).cast("int"))).alias("v")), {"p": ("Point", F.col("v"))})
    return rows.select("event_id", F.col("p.x").cast("long").alias("x"), F.col("p.y").cast("long").alias("y"), F.col("p_refused").alias("refused"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'done' END AS state, o_orderstatus NOT IN ('O', 'F') AS refused FROM orders")
def coerce_enum(spark, d):
    v = F.when(F.col("o_orderstatus") == "O", "1").when(F.col("o_orderstatus") == "F", '"done"').otherwise('"lost"')
    rows = with_coerced(table(spark, d, "orders").select("o_orderkey", F.parse_json(v).alias("v")), {"state": ("Enum8('open' = 1, 'done' = 2)", F.col("v"))})
    return rows.select("o_orderkey", "state", F.col("state_refused").alias("refused"))


@query("SELECT key, count(*) AS n FROM (SELECT unnest(CASE WHEN event_id % 2 = 0 THEN ['more', 'most'] ELSE ['more'] END) AS key FROM events) GROUP BY key")
def unstored_keys(spark, d):
    e = table(spark, d, "events")
    body = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"more":1,"_inner":2'), F.when(F.col("event_id") % 2 == 0, ',"most":{}').otherwise(""), F.lit("}"))
    out = extract(intake.parse(intake.messages(e, body, "t", F.col("event_id"))), TableSpec("main", "events", (ColumnSpec("event_id", "Int64"),)), Settings())
    return out.select(F.explode("_unstored").alias("key")).groupBy("key").agg(F.count("*").alias("n"))


@query("""SELECT user_id AS "user.id", event_type AS "kind" FROM events""")
def flatten_template(spark, d):
    e = table(spark, d, "events").select(F.to_json(F.struct(F.struct(F.col("user_id").alias("id"), F.lit(1).alias("other")).alias("user"), F.col("event_type").alias("kind"), F.lit(2).alias("more"))).alias("v"))
    return flatten.flatten_like(e, "v", '{"user":{"id":1},"kind":"x"}')


@query("""SELECT o_orderkey, o_clerk AS "user.name", o_orderpriority AS "log.level" FROM (SELECT o_orderkey, 'c' || o_custkey AS o_clerk, o_orderstatus AS o_orderpriority FROM orders)""")
def mapping_preset(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("username"), F.col("o_orderstatus").alias("severity"))
    return mapping.apply_mapping(o, mapping.preset("ecs")).select("o_orderkey", "`user.name`", "`log.level`")


@query("SELECT 't' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, CASE WHEN event_id % 3 = 0 THEN 'dead' ELSE 'placed' END AS outcome, min(event_id) AS first, max(event_id) AS last, count(*) AS rows FROM events GROUP BY ALL")
def offsets_by_outcome(spark, d):
    m = _prop_messages(spark, d)
    return pipeline.outcomes(m.where("offset % 3 <> 0"), m.where("offset % 3 = 0"))


@query(f"""SELECT {_TABLE_SQL} AS "table", count(*) AS rows, min(event_id) AS first FROM (SELECT *, row_number() OVER (PARTITION BY {_TABLE_SQL} ORDER BY event_id DESC) AS n FROM events) WHERE n > 20 GROUP BY 1""")
def oldest_retired(spark, d):
    m = _prop_messages(spark, d)
    _, gone = pipeline.held_back(m.where("offset % 2 = 0"), m.where("offset % 2 = 1"), 20)
    return gone.groupBy(F.concat_ws(".", "_db", "_table").alias("table")).agg(F.count("*").alias("rows"), F.min("offset").alias("first"))


@query("SELECT count(*) AS rows FROM events WHERE event_type = 'click' AND value > 50")
def count_where(spark, d):
    return readers.count_where(table(spark, d, "events"), "event_type = 'click' AND value > 50")


@query("SELECT event_id, user_id % 3 = 0 AS private, CASE WHEN event_id % 100 >= 80 THEN 'critical' WHEN event_id % 100 >= 60 THEN 'high' WHEN event_id % 100 >= 40 THEN 'medium' WHEN event_id % 100 >= 20 THEN 'low' ELSE 'minimal' END AS level, make_timestamp(1700000000250000) AS at FROM events")
def sql_functions(spark, d):
    sql_names.register(spark)
    e = table(spark, d, "events").select("event_id", address().alias("ip"))
    return e.select("event_id", F.expr("is_private_ip(ip)").alias("private"), F.expr("risk_level(CAST(event_id % 100 AS INT))").alias("level"), F.expr("CAST(epoch_time(1700000000250) AS TIMESTAMP_NTZ)").alias("at"))


# Relational extensions: what Spark gives beside the reference's own work


@query("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 0) AS revenue, count(*) AS n FROM lineitem GROUP BY ALL")
def pricing_summary(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("long").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 0).alias("revenue"), F.count("*").alias("n"))


@query("SELECT o_custkey, o_orderkey, rn FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def top_orders_per_customer(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("o_custkey", "o_orderkey", F.col("rn").cast("long").alias("rn"))


@query("SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def customers_rollup(spark, d):
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).rollup("r_name", "n_name").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping_id(l_returnflag, l_linestatus) AS g FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def lines_cube(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))


@query("SELECT o_custkey, o_orderkey, CAST(sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS last3 FROM orders")
def orders_moving_frame(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", F.sum("o_orderkey").over(w).alias("last3"))


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def nations_in_both(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@query("SELECT e.event_id, (SELECT max(p.event_id) FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND p.ts <= e.ts) AS purchase FROM events e WHERE e.event_type = 'error'")
def errors_as_of_purchase(spark, d):
    """Each error with the user's latest purchase before it, by one window instead of a range
    join; ids grow with time."""
    e = table(spark, d, "events").where("event_type in ('error', 'purchase')")
    last = F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).over(Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0))
    return e.select("event_id", "event_type", last.alias("purchase")).where("event_type = 'error'").drop("event_type")


@query("""SELECT user_id, count(*) AS sessions FROM (SELECT user_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens FROM events) WHERE opens = 1 GROUP BY user_id""")
def user_sessions(spark, d):
    e = table(spark, d, "events").groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "1 hour")).agg(F.count("*").alias("n"))
    return e.groupBy("user_id").agg(F.count("*").alias("sessions"))

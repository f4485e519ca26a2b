"""More registered queries: computed columns, the one-pass plan, ranges, event time and
sketches, with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from sluice.functions import sql as sql_names
from sluice.functions import timestamps
from sluice.operators import enrich, flatten, intake, mapping, sketches
from sluice.operators.model import COUNTRIES, ColumnSpec, ExternalTopic, Routing, Settings, TableSpec, risk_for
from sluice.plans import onepass
from sluice.plans.registry import _TABLE_SQL, RANGES, ROUTING, _threats, address, event_messages, events, query, table
from sluice.streaming import windows

_COMPUTED = {
    "half": "event_id / 7 - event_id % 7", "label": 'event_type + "-" + string(user_id)', "scaled": "event_id * 9223372036854775", "share": "event_id / (user_id % 3)",
    "known": 'event_type in ["click", "view"] && !(user_id == 1)', "band": 'value > 90 ? "high" : value > 10.5 ? "mid" : "low"', "k": "int(props_k) + 1", "deep": "has(props_k) && size(event_type) > 4",
}
_COMPUTED_SQL = """SELECT event_id, event_id // 7 - event_id % 7 AS half, event_type || '-' || user_id AS label,
 CASE WHEN CAST(event_id AS HUGEINT) * 9223372036854775 <= 9223372036854775807 THEN CAST(CAST(event_id AS HUGEINT) * 9223372036854775 AS BIGINT) END AS scaled,
 CASE WHEN user_id % 3 <> 0 THEN event_id // (user_id % 3) END AS share, event_type IN ('click', 'view') AND user_id <> 1 AS known,
 CASE WHEN value > 90 THEN 'high' WHEN value > 10.5 THEN 'mid' ELSE 'low' END AS band, CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) + 1 END AS k,
 event_id % 5 <> 0 AND length(event_type) > 4 AS deep FROM events"""


def _computed(spark, d, failures=None):
    k = F.when(F.col("event_id") % 5 != 0, F.get_json_object("props", "$.k"))
    rows = events(spark, d).withColumn("props_k", k)
    out, failed = mapping.compute(rows, _COMPUTED | {"odd": "value - event_type"}, texts=("props_k",), failures=failures)
    assert failed == ["odd"]
    return out


@query(_COMPUTED_SQL)
def computed_by_row(spark, d):
    """Whole division, joined texts, overflow and division by zero, each failing by row."""
    return _computed(spark, d).select("event_id", *_COMPUTED)


@query(f"WITH c AS ({_COMPUTED_SQL}) SELECT name, n FROM (SELECT unnest([{{'name': 'k', 'n': count(*) FILTER (k IS NULL)}}, {{'name': 'scaled', 'n': count(*) FILTER (scaled IS NULL)}}, {{'name': 'share', 'n': count(*) FILTER (share IS NULL)}}], recursive := true) FROM c) WHERE n > 0")
def computed_failures(spark, d):
    return _computed(spark, d, "_failed").select(F.explode("_failed").alias("name")).groupBy("name").agg(F.count("*").alias("n"))


_CLICKS = TableSpec("main", "clicks", (ColumnSpec("event_id", "Int64"), ColumnSpec("who", "String", "@renamed: user"), ColumnSpec("twice", "Float64", "@computed: value * 2"), ColumnSpec("k", "Int32", "@source: props.k")))
_VIEWS = TableSpec("main", "views", (ColumnSpec("event_id", "Int64"), ColumnSpec("who", "String", "@source: user"), ColumnSpec("k", "Int32", "@default: -1")))
_EVENTS = TableSpec("main", "events", (ColumnSpec("event_id", "Int64"), ColumnSpec("event_type"), ColumnSpec("_json")))
_TABLES = [_CLICKS, _VIEWS, _EVENTS]


def _mixed(spark, d):
    """Messages of which every tenth is no JSON and every eleventh has a bad id."""
    e = event_messages(spark, d)
    bad = F.regexp_replace("value", r'"event_id":\d+', '"event_id":"x"')
    return e.withColumn("value", F.when(F.col("offset") % 10 == 0, "junk").when(F.col("offset") % 11 == 0, bad).otherwise(F.col("value")))


_ONE_SQL = """SELECT event_id, CASE WHEN event_id % 10 = 0 OR event_id % 11 = 0 THEN '_dead' WHEN event_type = 'click' THEN 'main.clicks' WHEN event_type = 'view' THEN 'main.views' ELSE 'main.events' END AS t,
 user_id, value, event_type, CASE WHEN event_id % 10 = 0 THEN 'intake' WHEN event_id % 11 = 0 THEN 'extract' END AS stage, CAST(json_extract(props, '$.k') AS INTEGER) AS pk FROM events"""


@query(f"""WITH o AS ({_ONE_SQL}) SELECT event_id AS at, t AS "table", stage, CASE WHEN t IN ('main.clicks', 'main.views') THEN 'u' || user_id END AS who, CASE WHEN t = 'main.clicks' THEN value * 2 END AS twice,
 CASE t WHEN 'main.clicks' THEN pk WHEN 'main.views' THEN -1 END AS k, CASE WHEN t = 'main.events' THEN event_type END AS event_type FROM o""")
def one_pass_rows(spark, d):
    """Three tables and the dead letters from one scan, with renamed, computed and defaulted columns."""
    out = onepass.tagged(_mixed(spark, d), _TABLES, Settings(routing=ROUTING))
    return out.select(F.col("_offset").alias("at"), F.col("_table").alias("table"), F.col("_stage").alias("stage"), "who", "twice", "k", "event_type")


@query(f"""WITH o AS ({_ONE_SQL}), m AS (SELECT count(*) AS n FROM events), b AS (SELECT count(*) FILTER (event_id % 3 = 0) AS arrays, count(*) FILTER (event_id % 3 = 1) AS lines FROM events)
 SELECT name, CAST(value AS BIGINT) AS value FROM (SELECT unnest([{{'name': 'messages', 'value': n + arrays + lines}}, {{'name': 'accepted', 'value': n + arrays + lines}}, {{'name': 'unknown_table', 'value': arrays}}, {{'name': 'tenant_replaced', 'value': lines}},
 {{'name': 'table_field_absent', 'value': lines}}, {{'name': 'fields_unstored', 'value': n + 2 * lines}}, {{'name': 'array_records', 'value': 2 * arrays}}, {{'name': 'line_records', 'value': 2 * lines}}, {{'name': 'dead_intake', 'value': 0}}], recursive := true) FROM m, b)""")
def observed_counters(spark, d):
    """Counters that are observed while the frame is written, from the same scan."""
    e = events(spark, d)
    values = ['[{"event_type":"click","event_id":1},{"event_type":"other","event_id":2}]', '{"event_type":"view","user":"u","more":1}\n{"event_id":4,"_org_id":"theirs","most":[1]}', '{"event_type":"click","event_id":5}']
    m = intake.messages(e, F.get(F.array(*map(F.lit, values)), (F.col("event_id") % 3).cast("int")), "events_land", F.col("event_id"))
    routing = Routing(table_fields=("event_type",), source_to_table=ROUTING.source_to_table, default_table="events", default_db="main", external=(ExternalTopic("events_land", "default", ("default",)),), topic_suffixes=())
    seen = Observation("sluice")
    onepass.tagged(m, _TABLES, Settings(routing=routing), counters=seen).write.format("noop").mode("overwrite").save()
    asked = ("messages", "accepted", "unknown_table", "tenant_replaced", "table_field_absent", "fields_unstored", "array_records", "line_records", "dead_intake")
    return spark.createDataFrame([(n, seen.get[n]) for n in asked], "name string, value long")


_SPANS = [("8.0.0.5", "8.16.3.77", "A"), ("8.16.3.78", "8.200.255.255", "B"), ("10.0.0.0", "10.255.255.255", "private"), ("2001:db8::1:0", "2001:db8::1:9c3f", "C"), ("2001:db8::2:1", "2001:db8::3:7", "D")]


@query(f"""WITH e AS (SELECT event_id, event_id % 2 = 0 AS v6, user_id % 3 = 0 AS private, (user_id % 256) * 65536 + (event_id % 256) * 256 + 7 AS n, 65536 * (1 + event_id % 3) + event_id % 65536 AS m FROM events)
 SELECT event_id, CASE WHEN v6 THEN CASE WHEN m BETWEEN 65536 AND 105535 THEN 'C' WHEN m BETWEEN 131073 AND 196615 THEN 'D' END WHEN private THEN NULL WHEN n BETWEEN 5 AND 1049421 THEN 'A' WHEN n BETWEEN 1049422 AND 13172735 THEN 'B' END AS country FROM e""")
def ip_ranges_start_end(spark, d):
    """Locations given as first and last address, of either kind."""
    e = events(spark, d)
    hexed = lambda n: F.lower(F.hex(n))
    v6 = F.concat(F.lit("2001:db8::"), hexed(F.lit(1) + F.col("event_id") % 3), F.lit(":"), hexed(F.col("event_id") % 65536))
    rows = e.select("event_id", F.when(F.col("event_id") % 2 == 0, v6).otherwise(address()).alias("ip"))
    ranges = spark.createDataFrame(_SPANS, "start_ip string, end_ip string, country_code string")
    return enrich.geo_lookup(rows, "ip", ranges).select("event_id", F.col("geo_country_code").alias("country"))


@query("""SELECT event_id, u.key, u.value FROM (SELECT event_id, unnest([{'key': 'a.b.c.d', 'value': json_extract_string(props, '$.k')}, {'key': 'a.b.s', 'value': '{"x":1}'}, {'key': 'a.l', 'value': '[{"y":1}]'}, {'key': 'a.f', 'value': '1.0'}, {'key': 't', 'value': event_type}, {'key': 'n', 'value': NULL}]) AS u FROM events)""")
def flatten_levels(spark, d):
    """Objects of unknown keys, four levels deep, without Python."""
    text = F.concat(F.lit('{"a":{"b":{"c":{"d":'), F.get_json_object("props", "$.k"), F.lit('},"s":"{\\"x\\":1}","e":{}},"l":[{"y":1}],"f":1.0},"n":null,"t":"'), F.col("event_type"), F.lit('"}'))
    return events(spark, d).select("event_id", F.explode(flatten.flatten_map(text)))


def _stamped(spark, d):
    return table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY ALL")
def windows_tumbling(spark, d):
    out = windows.windowed(_stamped(spark, d), "at", "1 hour", F.count("*").alias("n"), F.sum("user_id").alias("users"), keys=("event_type",))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "users")


@query("SELECT s AS window_start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR, time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 2 HOUR]) AS s FROM events) GROUP BY s")
def windows_sliding(spark, d):
    out = windows.windowed(_stamped(spark, d), "at", "3 hours", F.count("*").alias("n"), slide="1 hour")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_users_and_types(spark, d):
    return windows.distinct_within(_stamped(spark, d), "at", "user_id", "event_type").select("user_id", "event_type")


_NEAR = "SELECT e.event_id AS error, p.event_id AS purchase FROM events e JOIN events p ON e.event_type = 'error' AND p.event_type = 'purchase' AND p.ts BETWEEN e.ts - INTERVAL 10 MINUTE AND e.ts"


def _near(spark, d, on):
    e = _stamped(spark, d)
    errors = e.where("event_type = 'error'").select(F.col("event_id").alias("error"), F.col("user_id").alias("u"), F.col("at").alias("error_at"))
    bought = e.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase"), F.col("user_id").alias("v"), F.col("at").alias("bought_at"))
    return windows.joined_within(errors, bought, "error_at", "bought_at", "10 minutes", on).select("error", "purchase")


@query(_NEAR)
def errors_near_purchases(spark, d):
    """Errors with the purchases of the ten minutes before, with no other key than time."""
    return _near(spark, d, ())


@query(_NEAR.replace("10 MINUTE", "1 DAY") + " AND p.user_id = e.user_id")
def errors_after_own_purchases(spark, d):
    e = _stamped(spark, d)
    errors = e.where("event_type = 'error'").select(F.col("event_id").alias("error"), F.col("user_id").alias("u"), F.col("at").alias("error_at"))
    bought = e.where("event_type = 'purchase'").select(F.col("event_id").alias("purchase"), F.col("user_id").alias("v"), F.col("at").alias("bought_at"))
    return windows.joined_within(errors, bought, "error_at", "bought_at", "1 day", (("u", "v"),)).select("error", "purchase")


@query("SELECT event_type, count(*) AS rows, true AS users_close, true AS median_close, true AS p99_close FROM events GROUP BY event_type")
def sketches_merged(spark, d):
    """Sketches by day merged to one for each type: within 5 % of the exact distinct count, and
    within two hundredths of the asked rank."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    daily = sketches.sketched(e, ["event_type", "day"], {"users": "user_id"}, {"values": "value"})
    whole = sketches.merged(daily, ["event_type"], ["users"], ["values"])
    got = whole.select("event_type", "rows", sketches.distinct_of("users").alias("users"), sketches.quantile_of("values", 0.5).alias("median"), sketches.quantile_of("values", 0.99).alias("p99"))
    met = e.join(F.broadcast(got.select(F.col("event_type").alias("t"), "median", "p99")), F.col("event_type") == F.col("t"))  # a row for each type
    exact = met.groupBy("event_type").agg(F.count_distinct("user_id").alias("n"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("half"), F.avg((F.col("value") <= F.col("p99")).cast("double")).alias("most"))
    close = lambda x, y, by: F.abs(x - y) <= by
    both = got.join(exact, "event_type")
    return both.select("event_type", "rows", close(F.col("users"), F.col("n"), 0.05 * F.col("n")).alias("users_close"), close(F.col("half"), F.lit(0.5), 0.02).alias("median_close"), close(F.col("most"), F.lit(0.99), 0.02).alias("p99_close"))


@query("""SELECT event_id, strftime(date_trunc('second', ts) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '.' || CASE WHEN event_id % 3 = 0 THEN lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '000' || '001' WHEN event_id % 3 = 1 THEN lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') ELSE '000120' END || 'Z' AS utc FROM events""")
def timestamp_nanoseconds(spark, d):
    """Nine digits of a second survive parsing and writing."""
    millis = F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")
    fraction = F.when(F.col("event_id") % 3 == 0, F.concat(millis, F.lit("000001"))).when(F.col("event_id") % 3 == 1, millis).otherwise("00012")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), fraction, F.lit("+02:00"))
    return events(spark, d).select("event_id", timestamps.nanos_text(timestamps.parse_nanos(text)).alias("utc"))


@query("""SELECT event_id, greatest(least(date_trunc('second', ts), TIMESTAMP '2024-01-20 00:00:00'), TIMESTAMP '2024-01-10 00:00:00') AS held, make_timestamp((1700000000 + event_id) * 1000000) AS unix FROM events""")
def timestamp_clamp_and_unix(spark, d):
    at = timestamps.clamped(F.date_trunc("second", F.col("ts").cast("timestamp")), "2024-01-10", "2024-01-20")
    n = F.when(F.col("event_id") % 2 == 0, (F.col("event_id") + 1700000000) * 1000).otherwise(F.col("event_id") + 1700000000)
    return events(spark, d).select("event_id", at.cast("timestamp_ntz").alias("held"), timestamps.from_unix(n).cast("timestamp_ntz").alias("unix"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) END AS at FROM events")
def timestamp_naive_formats(spark, d):
    text = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).otherwise("yesterday")
    return events(spark, d).select("event_id", timestamps.lenient(text).cast("timestamp_ntz").alias("at"))


@query("SELECT event_id, 'user' AS key, 'u' || user_id AS value FROM events")
def routing_fields_removed(spark, d):
    m = F.from_json("value", "map<string,string>")
    out = event_messages(spark, d).select(F.col("offset").alias("event_id"), F.explode(flatten.without_keys(m, ("event_type", "event_id", "timestamp", "value", "props"))))
    return out.select("event_id", "key", "value")


@query("""SELECT o_orderkey, o_orderstatus AS "log.level", 'c' || o_custkey AS "user.name", o_orderpriority AS label FROM orders""")
def mapping_layers(spark, d):
    """A preset, a file's rules over it, and a column's own over both."""
    R = mapping.Rule
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("username"), F.col("o_orderstatus").alias("mine"), "o_orderpriority")
    rules = mapping.merge_rules(mapping.preset("ecs"), (R("log.level", ("level",), "copy"), R("label", ("nothing", "o_orderpriority"))), (R("log.level", ("mine",)),), columns=["o_orderkey", "log.level", "user.name", "label"])
    return mapping.apply_mapping(o, rules).select("o_orderkey", "`log.level`", "`user.name`", "label")


@query("""SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 WHEN user_id % 256 = 17 THEN 15 WHEN user_id % 256 BETWEEN 16 AND 31 THEN 15 ELSE 15 END AS geo, user_id % 3 <> 0 AND user_id % 256 < 16 AS listed,
 CASE WHEN user_id % 3 = 0 OR user_id % 256 < 16 THEN true ELSE false END AS odd FROM events""")
def risk_presets_and_gate(spark, d):
    """A country preset, and factors and gate of the risk assessment."""
    rows = events(spark, d).select("event_id", "user_id", address().alias("ip"))
    found = enrich.reputation_lookup(enrich.geo_lookup(rows, "ip", spark.createDataFrame(RANGES, "network string, country_code string")), "ip", _threats(spark))
    out = enrich.risk(found, risk_for("sanctioned", weights=(1, 0, 0, 0)), gated=True)
    assert "sanctioned" in COUNTRIES
    vpn = F.col("rep_is_vpn")
    return out.select("event_id", F.col("risk_score").alias("geo"), vpn.alias("listed"), (F.array_contains("risk_factors", "reputation risk") | F.col("geo_is_private")).alias("odd"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def customers_with_large_orders(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").where("o_totalprice > 100000")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_semi").select("c_custkey")


@query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 40")
def parts_never_in_bulk(spark, d):
    return table(spark, d, "part").select("p_partkey").exceptAll(table(spark, d, "lineitem").where("l_quantity > 40").select("l_partkey").distinct())


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_totalprice > 200000)")
def customers_without_urgent_orders(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 200000")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey")


@query("SELECT event_id, place, CASE place WHEN 0 THEN event_type WHEN 1 THEN 'user' END AS kind FROM events, (VALUES (0), (1), (2)) AS p(place) WHERE place < 2 OR event_id % 2 = 0")
def records_of_udtf(spark, d):
    """A table function in SQL: two objects side by side, and for every second text a rest that is none."""
    sql_names.register_python(spark)
    text = F.concat(F.lit('{"t":"'), F.col("event_type"), F.lit('",\n "n":1} {"t":"user"}'), F.when(F.col("event_id") % 2 == 0, " and more").otherwise("\n"))
    events(spark, d).select("event_id", text.alias("text")).createOrReplaceTempView("sluice_texts")
    out = spark.sql("SELECT event_id, place, value FROM sluice_texts, LATERAL split_records(text)")
    return out.select("event_id", "place", F.get_json_object("value", "$.t").alias("kind"))

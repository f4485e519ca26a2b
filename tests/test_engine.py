import json

import pytest
from pyspark.sql import functions as F

from sluice.functions import ip, jsonpath, timestamps
from sluice.functions.coerce import coerced, spark_type, split_type
from sluice.operators import enrich, flatten, intake, mapping
from sluice.operators.directives import Directive, Literal, directive_of, parse_directives
from sluice.operators.extract import extract, project
from sluice.operators.model import ColumnSpec, ExternalTopic, Quality, Risk, Routing, Settings, TableSpec, settings_from
from sluice.operators.routing import route, to_known_tables
from sluice.plans import pipeline
from sluice.sources import readers
from sluice.streaming import runner


def messages(spark, values, topic="t"):
    return spark.createDataFrame([(v, topic, 0, i) for i, v in enumerate(values)], "value string, topic string, partition int, offset long")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_directives():
    d = parse_directives('the host @source: agent.host | "none" @default: 5')
    assert d == Directive(source=("agent.host",), default=Literal(5))
    assert parse_directives("@default: x @source: a | 3").default == Literal("x")
    assert parse_directives("@source: first(a/b.c/d) - what it is").source == ("a", "b.c", "d")
    assert parse_directives("@source: a | now()").default == "now()"
    assert parse_directives("@source: a | whatever").default is None
    assert parse_directives("@skip") == Directive(skip=True)
    assert parse_directives("@generated: x") == Directive()
    t = TableSpec("d", "t", (ColumnSpec("c", comment="@source: a"),))
    s = Settings(directives={"c": {"default": 1}})
    assert directive_of(t, t.columns[0], s) == Directive(default=Literal(1))
    with pytest.raises(ValueError):
        Settings(directives={"c": {"coerce": "x"}})


def test_settings():
    s = settings_from({"routing": {"default_table": "x"}, "capture": "raw_only"}, {"SLUICE_ROUTING__DEFAULT_DB": "y"})
    assert (s.routing.default_table, s.routing.default_db, s.capture) == ("x", "y", "raw_only")
    with pytest.raises(ValueError):
        settings_from({"nothing": 1})
    with pytest.raises(ValueError):
        Risk(bands={"low": 1, "high": 2})


def test_paths_read_dotted_keys(spark):
    assert jsonpath.readings("a.b.c") == [["a.b.c"], ["a", "b.c"], ["a", "b", "c"], ["a.b", "c"]]
    df = spark.createDataFrame([('{"a.b":1,"a":{"b":2}}',), ('{"a":{"b":2}}',), ('{"a.b":null,"a":{"b":3}}',), ('{}',)], "v string")
    assert [r.x for r in df.select(jsonpath.as_text(jsonpath.field(F.parse_json("v"), "a.b")).alias("x")).collect()] == ["1", "2", "3", None]


GUARDED = [
    ("plain", "not JSON"), ('  {"a":1}', None), ('{"a":', "JSON parse"), ('{"a":1}{"b":2}', "several records"), ("[1,2]", "JSON array"), ("[]", "JSON array"),
    ('{"_org_id":"a","_org_id":"b"}', "header key"), ('{"_source":"a","\\u005fsource":"b"}', "header key"),
    ("[" * 64 + "]" * 64, "JSON array"), ('{"a":' * 64 + "1" + "}" * 64, None), ('{"a":' * 65 + "1" + "}" * 65, "nested"), (json.dumps({"a": "[" * 200}), None), ("", "not JSON"), (None, "not JSON"),
    (json.dumps({"a": '"' + "[" * 70}), None), ("[" * 66 + '"\\""' + "]" * 66, "nested"), (json.dumps({"a": "_org_id", "_org_id": "x"}), None), ('{"a":1},{"b":2}', "several records"),
]


def test_guards(spark):
    df = pipeline.admitted(messages(spark, [v for v, _ in GUARDED]), Settings())
    got = {r.offset: r._reject for r in df.collect()}
    for i, (value, reason) in enumerate(GUARDED):
        assert (got[i] is None) if reason is None else got[i].startswith(reason), (value, got[i])


def test_fan_out(spark):
    rows = [('[{"a":1},{"a":2}]', 2), ('[{"a":1},2]', 1), ("[]", 1), ('{"a":1}\n{"a": 2.0}', 2), ('{"a":1} {"a":2}', 1), ('{"a":{\n"b":1}\n}\n\n{"a":2}\n', 2), ('{"a":1}\nx', 1), ('{"a":[{"x":1},\n{"y":2}]}', 1)]
    df = intake.split_lines(intake.split_arrays(messages(spark, [r[0] for r in rows])))
    assert [r.n for r in df.groupBy("offset").agg(F.count("*").alias("n")).orderBy("offset").collect()] == [n for _, n in rows]
    assert {r.value for r in df.where("offset = 3").collect()} == {'{"a":1}', '{"a": 2.0}'}


def test_prefilter(spark):
    df = intake.prefilter(messages(spark, ["drop", "bad", "ok"]), (intake.Filter("value = 'drop'"), intake.Filter("value like 'b%'", "barred")))
    assert {(r.value, r._reject) for r in df.collect()} == {("bad", "barred"), ("ok", None)}


def test_routing(spark):
    r = Routing(table_fields=("kind", "a.b"), source_to_table={"x": "tx"}, default_table="dt", pinned_topics={"dlq": "dead"}, org_routes={"o1": "db1"}, default_db="db0", external=(ExternalTopic("ext_land", "o9", ("o9",), "s9", ("s9",)),))
    values = ['{"kind":"x","_org_id":"o1"}', '{"kind":"","a":{"b":"y"}}', '{"kind":5}', '{"kind":"dead"}', '{"_org_id":"  "}']
    got = [(g._db, g._table, g._choice, g._org) for g in route(intake.parse(messages(spark, values)), r).orderBy("offset").collect()]
    assert got == [("db1", "tx", "named", "o1"), ("db0", "y", "named", "default"), ("db0", "dt", "default", "default"), ("db0", "dt", "default", "default"), ("db0", "dt", "default", "default")]
    topic = lambda t: route(intake.parse(messages(spark, ["{}"], t)), r).first()
    assert (topic("x_land")._table, topic("x_land")._choice) == ("tx", "topic")
    assert topic("dlq")._table == "dead" and topic("dlq")._choice == "pinned"
    ext = route(intake.parse(messages(spark, ['{"_org_id":"o1","kind":"x"}'], "ext_land")), r).first()
    assert (ext._org, ext._table, ext._tenant_replaced) == ("o9", "s9", True)
    empty = route(intake.parse(messages(spark, ["{}"])), Routing(default_table=""))
    assert empty.first()._reject == "empty_db_or_table"
    known = to_known_tables(route(intake.parse(messages(spark, values)), r), ["db1.tx"], r)
    assert {(k._wanted, k._db, k._table) for k in known.where("offset < 2").collect()} == {("db1.tx", "db1", "tx"), ("db0.y", "db0", "dt")}


def test_extraction(spark):
    t = TableSpec("d", "t", (
        ColumnSpec("id", "UInt8"), ColumnSpec("host", "String", "@source: first(agent.host/hostname) @default: none"), ColumnSpec("_x"), ColumnSpec("_org_id"), ColumnSpec("_source"), ColumnSpec("_json"),
        ColumnSpec("_timestamp", "DateTime64(3)"), ColumnSpec("skipped", comment="@skip"), ColumnSpec("made", default_kind="MATERIALIZED"),
    ))
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    values = ['{"id":7,"hostname":"h","x":"1","_source":"","more":1,"timestamp":"2024-05-01T10:00:00+02:00"}', '{"id":300}', '{"agent":{"host":"a"},"@timestamp":1700000000123}']
    got = extract(intake.parse(messages(spark, values)), t, Settings(routing=Routing(default_org_id="o")), now).orderBy("offset").collect()
    a, b, c = got
    assert (a.id, a.host, a._x, a._org_id, a._source, a._json, a._unstored, str(a._timestamp)) == (7, "h", "1", "o", None, values[0], ["more"], "2024-05-01 08:00:00")
    assert "id (UInt8) cannot hold 300" in b._reject and "skipped" not in a.asDict() and "made" not in a.asDict()
    assert (c.host, str(c._timestamp)) == ("a", "2023-11-14 22:13:20.123000")
    bare = TableSpec("d", "t", (ColumnSpec("id", "Int32"),), "@capture_mode: extracted_only")
    assert [r._reject for r in extract(intake.parse(messages(spark, ['{"id":1}', '{"z":1}'])), bare, Settings()).orderBy("offset").collect()] == [None, "no column was promoted"]
    df, dropped, missing = project(spark.range(1).withColumn("b", F.lit(1)), ["id", "c"])
    assert (df.columns, dropped, missing) == (["id"], ["b"], ["c"])


COERCED = [
    ("Int8", "127", 127, False), ("Int8", "128", None, True), ("UInt32", "-1", None, True), ("UInt64", "18446744073709551615", 18446744073709551615, False), ("Int32", '"12"', 12, False), ("Int32", "true", 1, False),
    ("Int32", "1.5", None, True), ("Int32", "null", None, False), ("Decimal(20,2)", '"12345678901234567.89"', "12345678901234567.89", False), ("Decimal(4,1)", '"12345.6"', None, True), ("Bool", '"TRUE"', True, False),
    ("Bool", "2", None, True), ("Date", '"2024-02-30"', None, True), ("Date", '"2024-02-29"', "2024-02-29", False), ("DateTime", '"2024-01-01T00:00:00.9+01:00"', "2023-12-31 23:00:00", False), ("UUID", '"0123456789ABCDEF0123456789abcdef"', "01234567-89ab-cdef-0123-456789abcdef", False),
    ("UUID", '"x"', None, True), ("IPv4", "16909060", "1.2.3.4", False), ("IPv4", '"1.2.3.256"', None, True), ("IPv6", '"1.2.3.4"', "::ffff:1.2.3.4", False), ("Enum8('a'=1,'b'=2)", "2", "b", False), ("Enum8('a'=1)", "9", None, True), ("Enum8('a'=1)", '"a"', "a", False),
    ("Array(Int32)", "5", [5], False), ("Array(Int32)", "null", [], False), ("Array(Int32)", "[1,2]", [1, 2], False), ("Array(Int32)", '{"a":1}', None, True), ("Array(Int8)", "[1,200]", None, True), ("Map(String,Int32)", '{"a":1}', {"a": 1}, False),
    ("Nullable(Int8)", "5", 5, False), ("LowCardinality(String)", '"x"', "x", False), ("JSON", "[1]", '{"list":[1]}', False), ("JSON", "5", '{"value":5}', False), ("JSON", '"plain"', '{"value":"plain"}', False), ("JSON", '"{\\"a\\":1}"', '{"a":1}', False),
    ("FixedString(2)", '"abc"', None, True), ("Point", '"48.5,2.5"', (2.5, 48.5), False), ("Point", "[2.5,48.5]", (2.5, 48.5), False), ("Point", '{"lat":48.5,"lon":2.5}', (2.5, 48.5), False), ("Point", '{"type":"Point","coordinates":[2.5,48.5]}', (2.5, 48.5), False), ("Point", '"POINT(2.5 48.5)"', (2.5, 48.5), False),
    ("Point", '"u09tvw0"', None, True), ("Point", "[2.5,95]", None, True), ("Array(Point)", "[2.5,48.5]", [(2.5, 48.5)], False), ("Ring", "[[1,2],[3,4]]", [(1.0, 2.0), (3.0, 4.0)], False),
]


@pytest.mark.parametrize("type_,value,want,bad", COERCED)
def test_coercion(spark, type_, value, want, bad):
    made, wrong = coerced(type_, F.col("v"))
    r = spark.range(1).select(F.parse_json(F.lit(value)).alias("v")).select(made.alias("x"), wrong.alias("bad")).first()
    got = tuple(r.x) if type_ == "Point" and r.x else [tuple(p) for p in r.x] if r.x and isinstance(r.x, list) and r.x and hasattr(r.x[0], "x") else r.x
    assert (got if not isinstance(want, str) else str(got), r.bad) == (want, bad)


def test_types():
    assert split_type("Map(String, Array(Int8))") == ("Map", ["String", "Array(Int8)"])
    assert spark_type("Nullable(Decimal(10,2))") == "decimal(10,2)"
    with pytest.raises(ValueError):
        spark_type("Tuple(Int8)")


def test_timestamps(spark):
    text = lambda s: one(spark, F.date_format(timestamps.parse_iso(F.lit(s)), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert text("2024-01-01t00:00:00.1234567Z") == "2024-01-01 00:00:00.123456"
    assert text("2024-01-01 00:00:00+0130") == "2023-12-31 22:30:00.000000"
    assert text("2024-01-01T00:00:00+01") == "2023-12-31 23:00:00.000000"
    assert text("2024-01-01") is None and text("2024-02-30T00:00:00Z") is None and text("2024-01-01T00:00:60Z") is None
    assert one(spark, timestamps.utc_text(F.lit("2024-01-01 00:00:00.5").cast("timestamp"))) == "2024-01-01T00:00:00.500Z"
    for n in (1700000000, 1700000000000, 1700000000000000, 1700000000000000000):
        assert one(spark, timestamps.from_epoch(F.lit(n)).cast("long")) == 1700000000
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    quality = lambda s, past=0: one(spark, timestamps.checked(F.lit(s), F.lit(None).cast("long"), now, 600, past)["quality"])
    assert [quality(s) for s in ("2024-01-01T00:10:00Z", "2024-01-01T00:10:01Z", "1700000000", "junk")] == ["valid", "replaced", "corrected", "replaced"]
    assert quality("2023-12-31T00:00:00Z", 3600) == "replaced"
    assert one(spark, timestamps.clamped(F.lit("1800-01-01").cast("timestamp")).cast("string")) == "1900-01-01 00:00:00"


def test_mapping_and_computed(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x"), (2, "there", "y")], "id int, d string, s string")
    assert [r.d for r in mapping.apply_mapping(df, (mapping.Rule("d", ("none", "s")),)).orderBy("id").collect()] == ["x", "there"]
    assert "s" not in mapping.apply_mapping(df, (mapping.Rule("d", ("s",)),)).columns
    assert "s" in mapping.apply_mapping(df, (mapping.Rule("d", ("s",), "copy"),)).columns
    assert mapping.merge_rules((mapping.Rule("d", ("a",)),), (mapping.Rule("d", ("b",)),), columns=["d"]) == (mapping.Rule("d", ("b",)),)
    assert mapping.preset("splunk") == mapping.preset("cim")
    out, failed = mapping.compute(df, {"n": 'id > 1 && s == "y"', "d": "'new'", "m": "n", "z": "try_divide(id, 0)", "bad": "1 +"})
    assert failed == ["m", "bad"] and [(r.n, r.d, r.z) for r in out.orderBy("id").collect()] == [(False, "new", None), (True, "there", None)]
    (tmp_path / "m.csv").write_text("source_field,destination_field,copy_action\na,x,copy\nb,x,copy\nc,y,\n")
    assert readers.mapping_rules(str(tmp_path / "m.csv")) == (mapping.Rule("x", ("a", "b"), "copy"), mapping.Rule("y", ("c",)))
    (tmp_path / "m.json").write_text('{"mappings":{"x":{"sources":["a"],"action":"copy"}}}')
    assert readers.mapping_rules(str(tmp_path / "m.json")) == (mapping.Rule("x", ("a",), "copy"),)


def test_flatten_and_keys(spark):
    df = spark.createDataFrame([('{"@a__b_":{"c":[1,2],"e":{}},"f":1.0,"__":null}',)], "v string").withColumn("m", flatten.flatten_map("v"))
    assert df.first().m == {"@a__b_.c": "[1,2]", "f": "1.0", "__": None}
    assert df.select(flatten.clean_keys(F.col("m")).alias("m")).first().m == {"a_b_.c": "[1,2]", "f": "1.0", "unnamed": None}
    assert df.select(flatten.without_keys(F.col("m"), ("f",)).alias("m")).first().m == {"@a__b_.c": "[1,2]", "__": None}
    assert flatten.flatten_like(df, "v", '{"f":1.5,"g":{"h":"x"}}').columns == ["f", "g.h"]
    same = spark.createDataFrame([({"a__b": "1", "a_b": "2"},)], "m map<string,string>").select(flatten.clean_keys(F.col("m")).alias("m")).first().m
    assert len(same) == 1


def test_addresses(spark, tmp_path):
    for text, want in [("10.1.2.3", True), ("8.8.8.8", False), ("172.32.0.1", False), ("100.127.0.1", True), ("::1", True), ("2001:db8::1", False), ("fe80::1", True), ("nope", None)]:
        assert one(spark, ip.is_private(F.lit(text))) is want, text
    rows = spark.createDataFrame([(1, "8.1.2.3"), (2, "10.0.0.1"), (3, None), (4, "9.9.9.9")], "id int, ip string")
    ranges = spark.createDataFrame([("8.0.0.0/8", "US"), ("8.1.0.0/16", "FR"), ("bad", "XX")], "network string, country_code string")
    got = enrich.geo_lookup(rows, "ip", ranges).orderBy("id").collect()
    assert [(r.geo_country_code, r.geo_is_private) for r in got] == [("FR", False), (None, True), (None, None), (None, False)]
    (tmp_path / "list.txt").write_text("# comment\n8.1.2.3\n; other\n9.0.0.0/8\njunk\n")
    rep = enrich.reputation_lookup(enrich.geo_lookup(rows, "ip", ranges), "ip", readers.blocklist(spark, str(tmp_path / "list.txt")))
    out = {r.id: r for r in enrich.risk(rep, Risk(high_countries=frozenset({"FR"}))).collect()}
    assert [out[i].rep_is_malicious for i in (1, 2, 3, 4)] == [True, False, False, True] and out[2].rep_threat_type == "none"
    assert (out[1].risk_score, out[1].risk_level, out[1].risk_factors) == ((90 * 15 + 90 * 35) // 100, "medium", ["geo risk", "threat risk"])


def test_sources(spark):
    o = readers.kafka_options("k:9092", suffix="_land", exclude=["test"], most=10)
    assert o["subscribePattern"] == "(?!(?:test)).*_land" and o["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        readers.kafka_options("k:9092")
    assert readers.count_where(spark.range(10), "id > 4").first().rows == 5
    with pytest.raises(ValueError):
        readers.count_where(spark.range(1), "id in (select 1)")


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    values = ['{"kind":"a","n":1}', '{"kind":"b","n":"x"}', "junk", '[{"kind":"a","n":2},{"kind":"a","n":3}]']
    (source / "f.txt").write_text("\n".join(values))
    tables = [TableSpec("default", "a", (ColumnSpec("n", "Int32"),)), TableSpec("default", "events", (ColumnSpec("n", "Int32"), ColumnSpec("kind")))]
    settings = Settings(routing=Routing(table_fields=("kind",)))
    q = runner.start(readers.read_messages(spark, str(source), "t"), tables, settings, str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out/default.a")).collect()) == [1, 2, 3]
    dead = {(r.stage, r.payload) for r in spark.read.parquet(str(tmp_path / "dead")).collect()}
    assert dead == {("intake", "junk"), ("extract", values[1])}
    rows, letters = pipeline.run(messages(spark, values), tables, settings)
    assert sorted(r.n for r in rows["default.a"].collect()) == [1, 2, 3] and letters.count() == 2


def test_bookkeeping(spark):
    df = spark.createDataFrame([("v" * (i % 3 + 1), "t", i % 2, i, "d", "x" if i < 6 else "y") for i in range(10)], "value string, topic string, partition int, offset long, _db string, _table string")
    assert [(r.table, r.rows) for r in pipeline.buffer_stats(df).orderBy("table").collect()] == [("d.x", 6), ("d.y", 4)]
    assert {(r.partition, r.commit) for r in pipeline.committable(df, df.where("offset = 5")).collect()} == {(0, 8), (1, 3)}
    assert [r.table for r in pipeline.deepest(df, 1).collect()] == ["d.x"]
    flush = pipeline.flush_plan(df, rows=2)
    assert flush.groupBy("_table", "partition", "_flush").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] <= 2


def test_timestamp_bounds_in_extraction(spark):
    t = TableSpec("d", "t", (ColumnSpec("_timestamp", "DateTime64(3)"),))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    got = extract(intake.parse(messages(spark, ['{"timestamp":"2030-01-01T00:00:00Z"}'])), t, Settings(quality=Quality()), now).first()
    assert str(got._timestamp) == "2024-01-01 00:00:00"


def test_computed_language(spark):
    df = spark.createDataFrame([("7", "abc", None), ("x", "b", "u")], "n string, s string, `user.name` string")
    out, failed = mapping.compute(df, {
        "big": "n > 5", "size": 's.startsWith("a") ? (n > 5 ? "both" : "start") : "none"', "named": "has(user.name) || size(s) > 2", "one": 's in ["b", "c"]', "sum": "int(n) + 1", "text": 'string(n) == "7"', "odd": "s ? 1",
    }, texts=("n", "s", "user.name"))
    got = [(r.big, r.size, r.named, r.one, r["sum"], r.text) for r in out.collect()]
    assert failed == ["odd"] and got == [(True, "both", True, False, 8, True), (None, "none", True, True, None, False)]
    assert mapping.names_in('a.b > 1 && f(c) ? "d" : msg.contains(e)') == ["a.b", "c", "msg", "e"]


def test_mapping_takes_sources_by_row(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "there", "y")], "id int, d string, s string")
    out = mapping.apply_mapping(df, (mapping.Rule("d", ("s",)),), keep=("s",)).orderBy("id").collect()
    assert [(r.d, r.s) for r in out] == [("x", None), ("there", "y")]


def test_stages_read_fields_that_the_table_lacks(spark):
    values = ['{"kind":"a","hostname":"h","n":7,"client_ip":"2001:db8::1"}', '{"kind":"a","host":"own","hostname":"h","n":"x","ip":"10.0.0.1"}']
    t = TableSpec("default", "a", (ColumnSpec("host", "String", "@renamed: hostname"), ColumnSpec("big", "Bool", "@computed: n > 5"), ColumnSpec("geo_country_code"), ColumnSpec("risk_level")))
    by = enrich.Enrichment(spark.createDataFrame([("2001:db8::/32", "FR")], "network string, country_iso string"), spark.createDataFrame([("2001:db8::1", "botnet", "s", 0, 1)], "network string, threat string, source string, score int, order int"), Risk())
    rows, dead = pipeline.run(messages(spark, values), [t], Settings(routing=Routing(table_fields=("kind",))), enrichment=by)
    got = rows["default.a"].orderBy("host").collect()
    assert [(r.host, r.big, r.geo_country_code) for r in got] == [("h", True, "FR"), ("own", None, None)] and [r.risk_level for r in got] == ["low", "minimal"] and dead.count() == 0


def test_addresses_of_version_six(spark):
    cases = {"::": True, "::ffff:10.0.0.1": True, "::ffff:8.8.8.8": False, "1:2:3:4:5:6:7:8": False, "1:2:3:4:5:6:7": None, "1::2::3": None, ":1::2": None, "12345::": None, "fdff::1": True, "FE80::A": True, "fec0::1": False, "01.2.3.4": None, "1:::2": None}
    for text, want in cases.items():
        assert one(spark, ip.is_private(F.lit(text))) is want, text
    table = enrich.prefixes(spark.createDataFrame([("2001:db8::/129",), ("::ffff:1.2.3.0/120",), ("1.2.3.4/33",), ("1.2.3.4",)], "network string"))
    assert sorted(r.length for r in table.collect()) == [120, 128]


def test_flush_bounds_hold(spark):
    df = spark.createDataFrame([("v" * (1 if i < 10 else 40), "t", 0, i, "d", "x") for i in range(40)], "value string, topic string, partition int, offset long, _db string, _table string")
    sizes = pipeline.flush_plan(df, rows=5, size=100).groupBy("_flush").agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("b")).collect()
    assert all(r.n <= 5 and r.b < 100 + 40 for r in sizes)


def test_dead_letters_are_placed(spark, tmp_path):
    dead = spark.createDataFrame([("x" * 5, "r", "intake", "t", 0, 1, None), ("y" * 50, "r", "intake", "t", 0, 2, None), ("z", "r", "intake", "own", 0, 3, None)], "payload string, reason string, stage string, topic string, partition int, offset long, `table` string")
    sent: list[int] = []

    def queue(df, batch):
        sent.extend(r.offset for r in df.collect())

    def broken(df, batch):
        raise OSError("no queue")

    place = lambda mode, q, path: runner.dead_letters_to(mode, str(tmp_path / path), q, most_bytes=10, own_topics=("own",))(dead, 0)
    there = lambda path: sorted(r.offset for r in spark.read.parquet(str(tmp_path / path)).collect())
    place("cascade", queue, "a")
    assert sent == [1] and there("a") == [2, 3]
    place("cascade", broken, "b")
    assert there("b") == [1, 2, 3]
    place("fan_out", queue, "c")
    assert there("c") == [1, 2, 3]
    place("disabled", None, "d")
    with pytest.raises(ValueError):
        runner.dead_letters_to("queue_only")
    with pytest.raises(ValueError):
        runner.dead_letters_to("elsewhere")
    assert [runner.error_class(e) for e in (OSError(), ValueError())] == ["fatal", "fatal"]
    runner.write_batch(dead, str(tmp_path / "j"), 1, form="json")
    assert spark.read.json(str(tmp_path / "j")).count() == 3


def test_spread_bounds_rows_of_a_task(spark, tmp_path):
    spark.range(950_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    out = readers.spread(spark.read.parquet(str(tmp_path / "t")))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= readers.TASK_ROWS and out.agg(F.sum("id")).first()[0] == 949_999 * 950_000 // 2
    assert readers.spread(spark.read.parquet(str(tmp_path / "t")).limit(5)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_nesting_goes_by_runs_of_brackets(spark):
    cases = {
        "": 0, "}}{{": 0, "[[}{": 2, '"{{': 2, "\\{{": 1, '"a\\': 0, '{"a":[{"b":{}},{"c":[[]]}]}': 5, '{"s":"\\\\","t":{"u":"]\\"{"}}': 2, "[" * 300 + "]" * 300: 300, "[{},{},[{}]]": 3,
        '{"s":"' + 'x\\"{' * 50_000 + '","t":[' + "1," * 50_000 + "[]]}": 3, None: None,
    }
    made = spark.createDataFrame([(t,) for t in cases], "t string").select("t", intake.nesting(F.col("t")).alias("n"))
    assert {r.t: r.n for r in made.collect()} == cases
    # one pass over the text, and no step for a single character
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and " IN (" not in plan


def test_columns_at_read_keys_together(spark):
    texts = ['{"a":1,"A":"x","b.c":null,"b":{"c":[1],"d":{"e":2.50}},"it\'s":true,"x y":"z"}', '{"b":{"c":"{","d":5},"a":{"a":1}}', '{"b":[1],"a":null}', "{}", "[1]", "7", "null", None]
    paths = {f"p{i}": k for i, k in enumerate([("a",), ("A",), ("b.c",), ("b",), ("b", "c"), ("b", "d"), ("b", "d", "e"), ("it's",), ("x y",), ("no`ne",), ("none",), ("a", "a")])}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("r", F.try_parse_json("t"))
    got = jsonpath.columns_at(df, "r", paths)
    read = lambda x: [F.is_variant_null(x), jsonpath.kind(x), jsonpath.as_text(x)]
    each = df.select("i", F.array(*[F.to_json(F.array(*[y.cast("string") for y in read(jsonpath.at(F.col("r"), list(k)))])) for k in paths.values()]).alias("x"))
    made = got.select("i", F.array(*[F.to_json(F.array(*[y.cast("string") for y in read(F.col(p))])) for p in paths]).alias("x"))
    assert sorted(made.collect()) == sorted(each.collect()) and got.columns == ["i", "t", "r", *paths]
    columns = tuple(ColumnSpec(f"c{k}", "Int64") for k in range(30))
    out = extract(intake.parse(messages(spark, ['{"c7":8}'])), TableSpec("m", "t", columns), Settings()).select(*[c.name for c in columns])
    # beside the looks at a message's array, none by a key
    assert out.first()["c7"] == 8 and out._jdf.queryExecution().optimizedPlan().toString().count(", $[") <= 3

"""Computed columns, the one-pass plan, prefix lookups, nanoseconds and flattening."""

import ipaddress
import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sluice.functions import ip, timestamps
from sluice.operators import enrich, flatten, mapping, sketches
from sluice.operators.model import ColumnSpec, Quality, Risk, Routing, Settings, TableSpec
from sluice.plans import onepass, pipeline
from sluice.streaming import runner


def messages(spark, values, topic="t"):
    return spark.createDataFrame([(v, topic, 0, i) for i, v in enumerate(values)], "value string, topic string, partition int, offset long")


EXPRESSIONS = {  # expression: values on the two rows below
    "i / j": (3, None), "i + j": (9, 2**63 - 1), "i * 2": (14, None), 's + "x"': ("abx", "x"), "i % j": (1, None), "d / 0": (None, None), "i / -2": (-3, -(2**62) + 1), "-i": (-7, -(2**63) + 1),
    "1 in l": (True, False), '"k" in m': (True, False), "size(l) + size(m) + size(s)": (5, 0), "t + 1": (6.0, None), 't > 4 ? "hi" : "lo"': ("hi", None), '"x" in tj': (True, True),
    'has(m.k) && m.k == "v"': (True, False), "has(nothing)": (False, False), "l[0] == 1": (True, None), "b && false": (False, False), "b || true": (True, True), "b": (True, None), 'int("12") + int(2.9)': (14, 14),
    "type(t)": ("int", "string"), 'i == "7"': (False, False), "size([1, 2] + [3])": (3, 3), "d > 1 ? null : 1": (None, 1), "t + t": ("10", "zz"), "string(i) + s": ("7ab", str(2**63 - 1)), "double(t) / 2": (2.5, None),
    "t / 2": (2.0, None), "s.size() == 2": (True, False), 'int("x")': (None, None), "i - j - 1": (4, 2**63 - 2), "i >= 7 && !(j == 0)": (True, False), 'bool("true")': (True, True), "uint(-1)": (None, None), "tj[0]": ("x", None),
    's in ["ab", "c"] ? 1 : 2.5': (1.0, 2.5), 'm["k"]': ("v", None), "2 + 3 * 4 - (1 + 1) * 2": (10, 10), "0x10": (16, 16), "'it''s'": None, 's.startsWith("a") || s.endsWith("z")': (True, False), "true ? 1 : false ? 2 : 3": (1, 1), "size(bytes(s))": (2, 0),
    "s - 1": None, "matches(s)": None, "nope + 1": None, "1 +": None, "s < 1": None, 's.matches("x")': None, "foo(1)": None, "1 2": None, "(" * 2000 + "1": None, "99999999999999999999": None, "size()": None,
}


def test_expressions(spark):
    df = spark.createDataFrame([(7, 2, 2.5, "ab", [1, 2], {"k": "v"}, "5", '["x","y"]', True), (2**63 - 1, 0, 0.0, "", [], {}, "z", '{"x":1}', None)], "i long, j int, d double, s string, l array<int>, m map<string,string>, t string, tj string, b boolean")
    columns = {f"e{k}": e for k, e in enumerate(EXPRESSIONS)}
    out, failed = mapping.compute(df, columns, texts=("t", "tj"), failures="_failed")
    assert [columns[f] for f in failed] == [e for e, want in EXPRESSIONS.items() if want is None]
    first, second = out.collect()
    for k, (e, want) in enumerate(EXPRESSIONS.items()):
        if want is not None:
            assert (first[f"e{k}"], second[f"e{k}"]) == want, e
    null = {f"e{k}" for k, (e, want) in enumerate(EXPRESSIONS.items()) if want is not None and want[0] is None and "null" not in e}
    assert set(first._failed) == null
    assert mapping.names_in('a.b > 1 && has(c) ? [d, "e"] : f(g.h)') == ["a.b", "c", "d", "g.h"] and mapping.names_in("1 +") == []


VALUES = [
    "junk", '{"kind":"a","id":1,"hostname":"h","n":7,"ip":"8.8.8.8"}', '{"kind":"b","id":"x"}', '{"kind":"b","id":"5","extra":1}', '[{"kind":"a","id":2},{"kind":"zzz","id":3}]', '{"_source":"a","_source":"b"}',
    '{"kind":"a","id":9,"n":"q","ip":"10.0.0.1"}', '{"kind":"a"}\n{"kind":"b","id":1}', '{"kind":"c"}', '{"kind":"c","only":4,"timestamp":"2024-01-01T00:00:00Z"}', '{"a":1}{"b":2}', '{"kind":"","id":7}', None,
]
A = TableSpec("default", "a", (ColumnSpec("id", "Int64"), ColumnSpec("host", "String", "@renamed: hostname"), ColumnSpec("big", "Bool", "@computed: n > 5"), ColumnSpec("_json"), ColumnSpec("geo_country_code"), ColumnSpec("risk_level")))
B = TableSpec("default", "b", (ColumnSpec("id", "Int64"), ColumnSpec("extra", "Int32", "@default: 4"), ColumnSpec("host", "String")))
C = TableSpec("default", "c", (ColumnSpec("only", "Int32"), ColumnSpec("_timestamp", "DateTime64(3)")), "@capture_mode: extracted_only")
E = TableSpec("default", "events", (ColumnSpec("id", "Int64"), ColumnSpec("_raw")), "@capture_mode: raw_only")


@pytest.mark.parametrize("enriched", [False, True])
def test_one_pass_gives_what_the_passes_give(spark, tmp_path, enriched):
    tables, now = [A, B, C, E], F.lit("2024-02-01").cast("timestamp")
    by = enrich.Enrichment(spark.createDataFrame([("8.0.0.0/8", "US")], "network string, cc string"), spark.createDataFrame([("8.8.8.8", "tor", "s", 9, 1)], "network string, threat string, source string, score int, order int"), Risk()) if enriched else None
    settings = Settings(routing=Routing(table_fields=("kind",)), quality=Quality(max_past_seconds=0))
    seen = Observation("counts")
    frame = onepass.tagged(messages(spark, VALUES), tables, settings, now, enrichment=by, counters=seen)
    onepass.write_tagged(frame, str(tmp_path / "o"))
    rows, dead = pipeline.run(messages(spark, VALUES), tables, settings, now, enrichment=by)
    for t in tables:
        want = rows[t.name]
        got = onepass.read_table(spark, str(tmp_path / "o"), t).select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), t.name
    same = onepass.letters(spark.read.parquet(str(tmp_path / "o")))
    assert sorted(map(str, same.collect())) == sorted(map(str, dead.collect()))
    total = sum(r.count() for r in rows.values())
    assert (seen.get["accepted"], seen.get["messages"]) == (total, total + dead.count()) and seen.get["dead_intake"] == 4 and seen.get["dead_extract"] == 2
    assert (seen.get["array_messages"], seen.get["array_records"], seen.get["line_messages"], seen.get["line_records"], seen.get["duplicate_header"], seen.get["computed_failed"]) == (1, 2, 1, 2, 1, 3)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.count("LogicalRDD") or line.count("LocalRelation") for line in plan.split("\n") if "offset" in line) == 1  # the messages are read once


def test_tables_of_one_pass_agree(spark):
    other = TableSpec("default", "x", (ColumnSpec("id", "String"),))
    with pytest.raises(ValueError):
        onepass.tagged(messages(spark, []), [A, other], Settings())
    assert onepass.tagged(messages(spark, []), [A, B], Settings()).count() == 0


def test_counters_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    listener = onepass.Counters("seen")
    spark.streams.addListener(listener)
    try:
        for k in range(2):
            (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({"value": v, "topic": "t", "partition": 0, "offset": k}) for v in VALUES if v))
            m = spark.readStream.schema("value string, topic string, partition int, offset long").json(str(tmp_path / "in"))
            frame = onepass.tagged(m, [A, B, C, E], Settings(routing=Routing(table_fields=("kind",))), counters="seen")
            q = frame.writeStream.format("parquet").partitionBy("_table").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
            q.awaitTermination(120)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        for _ in range(100):
            if listener.batches >= 2:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert listener.totals["messages"] == out.count() and listener.totals["accepted"] == out.where("_reject is null").count() > 0


def test_a_stream_with_one_write_a_batch(spark, tmp_path):
    sent = []
    body = runner.sink_once([A, B, C, E], Settings(routing=Routing(table_fields=("kind",))), str(tmp_path / "out"), lambda df, k: sent.append((k, sorted(r.offset for r in df.collect()))))
    body(messages(spark, VALUES[:4]), 0)
    body(messages(spark, VALUES[4:]), 1)
    body(messages(spark, VALUES[4:]), 1)  # again
    assert [k for k, _ in sent] == [0, 1, 1] and sent[1] == sent[2] and sent[0][1] == [0, 2]
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == body.totals["messages"] and rows.where("_reject is null").count() == body.totals["accepted"] and onepass.read_table(spark, str(tmp_path / "out/batch=0"), A).count() == 1


def test_letters_without_a_place_are_counted(spark, tmp_path):
    dead = spark.createDataFrame([("x" * 5, "t", 1), ("y" * 50, "t", 2), ("z", "own", 3), (None, "t", 4)], "payload string, topic string, offset int")
    sent = []
    queue = lambda df, batch: sent.extend(r.offset for r in df.collect())
    place = runner.dead_letters_to("queue_only", None, queue, most_bytes=10, own_topics=("own",))
    for _ in range(2):  # a batch that is tried again counts once
        place(dead, 0)
    assert sorted(sent) == [1, 1, 4, 4] and place.dropped == {"too_large": 1, "own_topic": 1}
    place(dead, 1)
    assert place.dropped == {"too_large": 2, "own_topic": 2}
    with_files = runner.dead_letters_to("queue_only", str(tmp_path / "d"), queue, most_bytes=10, own_topics=("own",))
    with_files(dead, 0)
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [2, 3] and not with_files.dropped
    off = runner.dead_letters_to("disabled")
    off(dead, 0)
    assert off.dropped == {"disabled": 4}


def test_least_prefixes(spark):
    rng, rows = random.Random(1), [("10.0.0.5", "10.0.0.1"), ("x", "1.1.1.1"), ("::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff"), ("7fff::", "8000::1"), ("1.2.3.4", "1.2.3.4"), (None, "1.1.1.1")]
    for _ in range(150):
        kind = rng.choice([ipaddress.IPv4Address, ipaddress.IPv6Address])
        n = 32 if kind is ipaddress.IPv4Address else 128
        width = rng.randrange(n)
        a = rng.randrange(2**n)
        b = min(2**n - 1, a + rng.randrange(2**width))
        if rng.random() < 0.3:
            a = a >> width << width
            b = a + 2**width - 1
        rows.append((str(kind(0 if rng.random() < 0.1 else a)), str(kind(2**n - 1 if rng.random() < 0.1 else b))))
    df = spark.createDataFrame(rows, "s string, e string")
    for r in df.select("s", "e", ip.least_prefixes(ip.address(F.col("s")), ip.address(F.col("e"))).alias("p")).collect():
        try:
            nets = ipaddress.summarize_address_range(ipaddress.ip_address(r.s), ipaddress.ip_address(r.e))
            want = sorted((int(n.network_address) + (0xFFFF << 32 if n.version == 4 else 0), n.prefixlen + (96 if n.version == 4 else 0)) for n in nets)
        except ValueError:
            want = None
        got = None if r.p is None else sorted((x.base.hi % 2**64 << 64 | x.base.lo % 2**64, x.length) for x in r.p)
        assert got == want, (r.s, r.e)


@pytest.mark.parametrize(("broadcast", "lengths"), [(100_000, 100), (100_000, 2), (0, 100)])
def test_matches_are_the_same_however_they_are_found(spark, monkeypatch, broadcast, lengths):
    monkeypatch.setattr(enrich, "BROADCAST_PREFIXES", broadcast)
    monkeypatch.setattr(enrich, "MOST_LENGTHS", lengths)
    rng = random.Random(3)
    networks = [f"8.{rng.randrange(8)}.{rng.randrange(4) * 64}.0/{rng.choice([9, 13, 18, 19, 23, 24])}" for _ in range(40)] + ["2001:db8::/33", "2001:db8:1::/48", "::/0"]
    kinds = list(enrich.THREATS)
    threats = [(str(ipaddress.ip_network(n, strict=False)), kinds[k % len(kinds)], f"s{k % 3}", k, k) for k, n in enumerate(networks)]
    places = {n: f"C{k}" for k, n in enumerate(dict.fromkeys(t[0] for t in threats))}
    asked = [f"8.{rng.randrange(8)}.{rng.randrange(256)}.{rng.randrange(256)}" for _ in range(60)] + ["2001:db8:1::5", "2001:db8:8000::1", "10.1.1.1", "junk", None, "", "::1"]
    rows = spark.createDataFrame([(k, a) for k, a in enumerate(asked)], "k int, `the.ip` string")
    geo = enrich.geo_lookup(rows, "the.ip", spark.createDataFrame(list(places.items()), "network string, country_code string"))
    got = {r.k: r for r in enrich.reputation_lookup(geo, "the.ip", spark.createDataFrame(threats, "network string, threat string, source string, score int, order int")).collect()}
    for k, a in enumerate(asked):
        try:
            address = ipaddress.ip_address(a or "")
        except ValueError:
            address = None
        held = [t for t in threats if address is not None and address in ipaddress.ip_network(t[0])]
        private = None if address is None else str(address) in ("10.1.1.1", "::1")
        best = max((n for n in places if address is not None and address in ipaddress.ip_network(n)), key=lambda n: ipaddress.ip_network(n).prefixlen, default=None)
        r = got[k]
        assert (r.geo_is_private, r.geo_country_code) == (private, places.get(best) if not private else None), a
        assert (r.rep_threat_type, r.rep_source) == ((held[0][1], held[0][2]) if held else ("none", None)) and r.rep_is_anonymizer == any("is_anonymizer" in enrich.THREATS[t[1]] for t in held)
        assert (r.rep_threat_types or []) == (sorted({t[1] for t in held}) if len({t[1] for t in held}) > 1 else [])


def test_nanoseconds(spark):
    cases = {
        "2024-01-02T03:04:05.123456789Z": "2024-01-02T03:04:05.123456789Z", "2024-01-02 03:04:05+01:00": "2024-01-02T02:04:05.000Z", "2024-01-02 03:04:05.5": "2024-01-02T03:04:05.500Z", "02/Jan/2024:03:04:05 +0100": "2024-01-02T02:04:05.000Z",
        "2024/01/02 03:04:05 +02:00": "2024-01-02T01:04:05.000Z", "junk": None, "2024-01-02T03:04:05.12000099+02:00": "2024-01-02T01:04:05.120000990Z", "20240102030405": "2024-01-02T03:04:05.000Z", "1969-12-31T23:59:59.999999999Z": "1969-12-31T23:59:59.999999999Z",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").select("t", timestamps.parse_nanos(F.col("t")).alias("at"))
    assert {r.t: r.x for r in df.select("t", timestamps.nanos_text(F.col("at")).alias("x")).collect()} == cases
    held = {r.t: r.x for r in df.select("t", timestamps.nanos_text(timestamps.nanos_clamped(F.col("at"), "2024-01-01", "2024-01-02 02:00:00")).alias("x")).collect()}
    assert held["20240102030405"] == "2024-01-02T02:00:00.999999999Z" and held["1969-12-31T23:59:59.999999999Z"] == "2024-01-01T00:00:00.000Z"
    epochs = {1700000000: "2023-11-14T22:13:20.000Z", 1700000000123456789: "2023-11-14T22:13:20.123456789Z", -5: "1969-12-31T23:59:55.000Z", -1500000000123: "1922-06-20T21:19:59.877Z"}
    assert {r.n: r.x for r in spark.createDataFrame([(n,) for n in epochs], "n long").select("n", timestamps.nanos_text(timestamps.nanos_of_epoch(F.col("n"))).alias("x")).collect()} == epochs


def test_flatten_by_levels(spark):
    deep = {"leaf": 1}
    for k in range(40):
        deep = {f"k{k}": deep, "s": "{}"} if k % 2 else {f"k{k}": deep}
    cases = {
        '{"a":{"b":{"c":{"d":"{\\"x\\":1}"}}},"z":"{"}': {"a.b.c.d": '{"x":1}', "z": "{"}, "[1]": None, "x": None, "": None, "{}": {}, '{"a":{}}': {}, '{"a":{"b":[{"c":1}],"n":null,"f":1.50,"t":true}}': {"a.b": '[{"c":1}]', "a.n": None, "a.f": "1.5", "a.t": "true"},
        '{"a.b":{"c":1},"a":{"b.c":2}}': {"a.b.c": "2"}, '{"a":1} x': None,
    }
    got = {r.t: r.m for r in spark.createDataFrame([(t,) for t in cases], "t string").select("t", flatten.flatten_map("t").alias("m")).collect()}
    assert got == cases
    m = spark.createDataFrame([(json.dumps(deep),)], "t string").select(flatten.flatten_map("t").alias("m")).first().m
    assert m[".".join(f"k{k}" for k in range(39, -1, -1)) + ".leaf"] == "1" and len(m) == 21
    plan = spark.createDataFrame([("{}",)], "t string").select(flatten.flatten_map("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_flatten_computes_its_text_once(spark):
    made = spark.createDataFrame([('{"k":{"a":{"b":"{"}}}',)], "t string").select(flatten.flatten_map(F.get_json_object("t", "$.k")).alias("m"))
    assert made.first().m == {"a.b": "{"}
    assert made._jdf.queryExecution().optimizedPlan().toString().count("get_json_object(") == 1


def test_sketches_merge(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 1000).alias("u"), F.col("id").cast("double").alias("v"), (F.col("id") % 7).alias("batch"))
    parts = sketches.sketched(rows, ["g", "batch"], {"us": "u"}, {"vs": "v"})
    assert parts.count() == 21
    for r in sketches.merged(parts, ["g"], ["us"], ["vs"]).select("rows", sketches.distinct_of("us").alias("n"), sketches.quantile_of("vs", 0.5).alias("m")).collect():
        assert r.rows in (6666, 6667) and abs(r.n - 1000) < 50 and abs(r.m - 10_000) < 400


def test_settings_of_files(tmp_path):
    from sluice.operators.model import load_settings, settings_from

    (tmp_path / "a.json").write_text(json.dumps({"routing": {"default_db": "x", "default_table": "t", "external": [{"topic": "p", "org": "o", "allowed_orgs": ["o", "q"]}]}, "capture": "full", "risk": {"weights": [1, 2, 3, 4], "high_countries": ["KP"]}}))
    (tmp_path / "b.json").write_text(json.dumps({"routing": {"default_db": "y"}, "quality": {"max_past_seconds": 60}, "max_depth": 10}))
    s = load_settings(str(tmp_path / "a.json"), str(tmp_path / "b.json"), environment={"SLUICE_ROUTING__DEFAULT_TABLE": "env", "SLUICE_MAX_DEPTH": "12", "SLUICE_ROUTING__DEAD_LETTERS": "false", "SLUICE_RISK__GEO": '{"high": 5, "unknown": 1, "medium": 2, "other": 3}', "OTHER": "z"})
    assert (s.routing.default_db, s.routing.default_table, s.max_depth, s.routing.dead_letters, s.quality.max_past_seconds) == ("y", "env", 12, False, 60)
    assert s.routing.external[0].allowed_orgs == ("o", "q") and s.risk.weights == (1, 2, 3, 4) and s.risk.high_countries == frozenset({"KP"}) and s.risk.geo["high"] == 5
    for bad in ({"nothing": 1}, {"routing": {"external": [{"topic": "p", "org": "o", "colour": 1}]}}, {"routing": 5}, {"max_depth": "deep"}, {"max_depth": True}, {"routing": {"table_fields": "a"}}, {"risk": {"weights": [-1]}}, {"routing": {"external": [{"topic": "p"}]}}, {"capture": "some"}):
        with pytest.raises(ValueError):
            settings_from(bad)
    (tmp_path / "c.json").write_text("[]")
    with pytest.raises(ValueError):
        load_settings(str(tmp_path / "c.json"))
    with pytest.raises(OSError):
        load_settings(str(tmp_path / "missing.json"))


def test_presets(spark):
    assert [len(mapping.preset(n)) for n in ("ecs", "ocsf", "cim", "beats")] == [45, 28, 28, 9] and mapping.preset("splunk") == mapping.preset("cim")
    for name in mapping.PRESETS:
        rules = mapping.preset(name)
        assert len({r.destination for r in rules}) == len(rules) and all(r.sources and r.destination not in r.sources[1:] for r in rules)
    df = spark.createDataFrame([("1.1.1.1", None, "alice", "GET")], "src_ip string, client_ip string, user string, method string")
    row = mapping.apply_mapping(df, mapping.preset("ecs")).first()
    assert (row["source.ip"], row["user.name"], row["http.request.method"], row["src_ip"]) == ("1.1.1.1", "alice", "GET", "1.1.1.1")

"""Landed files, event time, joins of streams and held state, over several micro-batches."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from sluice.sources import landed, readers
from sluice.streaming import state, windows


def run(query):
    query.awaitTermination(180)
    if query.exception():
        raise query.exception()


def test_landed_lines(spark, tmp_path):
    spark.dataSource.register(landed.LandedLines)
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f"line {i} é" for i in range(500)]
    (folder / "a.txt").write_text("\n".join(lines) + "\n")
    (folder / "b.txt").write_text("one\r\n\n  \ntwo\nno end yet")
    (folder / "_hidden").write_text("not yet\n")
    batch = spark.read.format("landed_lines").option("topic", "t").option("pieceBytes", 700).load(str(folder))
    rows = batch.collect()
    assert sorted(r.value for r in rows) == sorted([*lines, "one", "two", "no end yet"]) and len({(r.partition, r.offset) for r in rows}) == len(rows) and batch.rdd.getNumPartitions() > 5
    data = (folder / "a.txt").read_bytes()
    assert all(data[r.offset :].startswith(r.value.encode()) for r in rows if r.value.startswith("line"))

    def take(n):
        stream = spark.readStream.format("landed_lines").option("topic", "t").option("maxBytesPerTrigger", 3000).load(str(folder))
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start(str(tmp_path / "out"))
        for _ in range(300):
            if q.exception() or (tmp_path / "out" / "_spark_metadata").exists() and spark.read.schema(landed.SCHEMA).parquet(str(tmp_path / "out")).count() >= n:
                break
            time.sleep(0.2)
        q.stop()
        assert not q.exception()
        return spark.read.parquet(str(tmp_path / "out")).collect()

    first = take(502)
    assert sorted(r.value for r in first) == sorted([*lines, "one", "two"])  # a line without its end waits
    with open(folder / "b.txt", "a") as f:
        f.write(", now\nthree\n")
    (folder / "c.txt").write_text("four\n")
    again = take(505)  # a new query on the same checkpoint
    assert sorted(r.value for r in again) == sorted([*lines, "one", "two", "no end yet, now", "three", "four"]) and len({(r.partition, r.offset) for r in again}) == len(again)


def test_every_line_of_a_file_has_its_offset(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("".join(f"v{i}\n" for i in range(20)))
    (tmp_path / "in" / "b").write_text("w0\r\nw1")
    m = readers.read_messages(spark, str(tmp_path / "in"), "t")
    run(m.writeStream.format("memory").queryName("offsets").trigger(availableNow=True).start())
    rows = spark.table("offsets").collect()
    assert {(r.value, r.offset) for r in rows} == {(f"v{i}", i) for i in range(20)} | {("w0", 0), ("w1", 1)} and len({r.partition for r in rows}) == 2


def feed(spark, folder, schema):
    folder.mkdir()
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def put(folder, k, rows):
    path = folder / f"{k:03}.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    then = time.time() - 1000 + k
    __import__("os").utime(path, (then, then))  # files are taken in the order of their times


def at(minute, second=0):
    return f"2024-01-01T{minute // 60:02}:{minute % 60:02}:{second:02}Z"


def test_windows_and_duplicates_wait_for_late_rows(spark, tmp_path):
    batches = [
        [{"id": 1, "ts": at(1)}, {"id": 2, "ts": at(12)}],
        [{"id": 3, "ts": at(8)}, {"id": 4, "ts": at(33)}, {"id": 2, "ts": at(13)}],  # 8 is late, but the window still waits
        [{"id": 6, "ts": at(70)}],
        [{"id": 5, "ts": at(2)}, {"id": 7, "ts": at(90)}],  # 2 comes after its window is forgotten
    ]
    s = feed(spark, tmp_path / "in", "id int, ts timestamp")
    for k, rows in enumerate(batches):
        put(tmp_path / "in", k, rows)
    counted = windows.windowed(s, "ts", "10 minutes", F.count("*").alias("n"), F.sum("id").alias("ids"), late="15 minutes")
    run(counted.writeStream.format("memory").queryName("windowed").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    kept = spark.createDataFrame([(r["id"], r["ts"]) for b in batches for r in b if r["id"] != 5], "id int, t string").select("id", F.col("t").cast("timestamp").alias("ts"))
    want = windows.windowed(kept, "ts", "10 minutes", F.count("*").alias("n"), F.sum("id").alias("ids"))
    got = spark.table("windowed").collect()
    done = [r for r in want.collect() if r.window_end <= dt.datetime(2024, 1, 1, 1, 15)]  # what the watermark has passed
    assert sorted(got) == sorted(done) and len(done) == 3
    once = windows.distinct_within(s, "ts", "id", late="15 minutes")
    run(once.writeStream.format("memory").queryName("once").outputMode("append").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start())
    assert sorted(r.id for r in spark.table("once").collect()) == [1, 2, 3, 4, 6, 7]
    sliding = windows.windowed(kept, "ts", "10 minutes", F.count("*").alias("n"), slide="5 minutes")
    assert sliding.agg(F.sum("n")).first()[0] == 2 * kept.count()


def test_streams_join_within_an_interval(spark, tmp_path):
    e = feed(spark, tmp_path / "e", "e int, u int, et timestamp")
    p = feed(spark, tmp_path / "p", "p int, v int, pt timestamp")
    errors = [[{"e": 1, "u": 1, "et": at(20)}, {"e": 2, "u": 2, "et": at(21)}], [{"e": 3, "u": 1, "et": at(40)}], [{"e": 4, "u": 1, "et": at(300)}]]
    bought = [[{"p": 1, "v": 1, "pt": at(10)}, {"p": 2, "v": 2, "pt": at(10, 59)}], [{"p": 3, "v": 1, "pt": at(20)}, {"p": 4, "v": 1, "pt": at(35)}], [{"p": 5, "v": 1, "pt": at(290)}]]
    for k in range(3):
        put(tmp_path / "e", k, errors[k])
        put(tmp_path / "p", k, bought[k])
    joined = windows.joined_within(e, p, "et", "pt", "10 minutes", (("u", "v"),), late="30 minutes").select("e", "p")
    run(joined.writeStream.format("memory").queryName("joined").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    assert sorted(map(tuple, spark.table("joined").collect())) == [(1, 1), (1, 3), (3, 4), (4, 5)]
    left, right = spark.read.schema("e int, u int, et timestamp").json(str(tmp_path / "e")), spark.read.schema("p int, v int, pt timestamp").json(str(tmp_path / "p"))
    anyone = windows.joined_within(left, right, "et", "pt", "10 minutes")
    assert sorted((r.e, r.p) for r in anyone.collect()) == [(1, 1), (1, 2), (1, 3), (2, 3), (3, 4), (4, 5)]
    plan = anyone._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(KeyError):
        windows.seconds("10 parsecs")


def test_records_of_absent_tables_are_held(spark, tmp_path):
    """Held while the table is not there, out as found once it is, or as expired."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    there = tmp_path / "tables"
    there.mkdir()
    (there / "known").touch()
    folder = str(there)

    def exists(table):
        return __import__("os").path.exists(f"{folder}/{table}")

    m = feed(spark, tmp_path / "in", "value string, topic string, partition int, offset long, table string")
    put(tmp_path / "in", 0, [{"value": v, "topic": "t", "partition": 0, "offset": i, "table": table} for i, (v, table) in enumerate([("a", "known"), ("b", "soon"), ("c", "never"), ("d", "soon")])])
    q = state.until_known(m, exists, again_ms=300, ttl_ms=25_000, parts=2).writeStream.format("memory").queryName("held").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start()

    def out(n, wait=90):
        for _ in range(wait * 5):
            if q.exception():
                raise q.exception()
            rows = {r.value: r.outcome for r in spark.table("held").collect()}
            if len(rows) >= n:
                break
            time.sleep(0.2)
        return rows

    try:
        assert out(1)["a"] == "found"
        (there / "soon").touch()
        put(tmp_path / "in", 1, [{"value": "e", "topic": "t", "partition": 0, "offset": 9, "table": "known"}])
        rows = out(5)
        assert rows == {"a": "found", "b": "found", "c": "expired", "d": "found", "e": "found"}
    finally:
        q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")

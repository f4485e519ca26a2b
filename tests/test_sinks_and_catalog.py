"""Catalog reads, retries, settings read anew, and the figure for scaling out."""

import pytest
from pyspark.errors import ArithmeticException, PySparkException
from pyspark.sql import functions as F

from sluice.functions.sql import SplitRecords
from sluice.operators.model import ColumnSpec, Routing, Settings, TableSpec
from sluice.plans import pipeline
from sluice.sources import readers
from sluice.streaming import runner


def test_catalog(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS sluice_db LOCATION '" + str(tmp_path / "db") + "'")
    try:
        spark.sql(f"CREATE TABLE sluice_db.clicks (id BIGINT COMMENT 'the id @source: a.b', name STRING, price DECIMAL(9,2), tags ARRAY<STRING>, day DATE) USING parquet LOCATION '{tmp_path / 't'}' COMMENT '@capture_mode: json_only | @owner: me'")
        spark.sql(f"CREATE TABLE sluice_db.views (id INT) USING parquet LOCATION '{tmp_path / 'v'}'")
        assert readers.table_names(spark, "sluice_db") == ["sluice_db.clicks", "sluice_db.views"] and readers.table_exists(spark, "sluice_db.views") and not readers.table_exists(spark, "sluice_db.none")
        t = readers.catalog_table(spark, "sluice_db.clicks")
        assert t.name == "sluice_db.clicks" and t.tags == {"capture_mode": "json_only", "owner": "me"} and Settings().capture_of(t) == "json_only"
        assert [(c.name, c.type) for c in t.columns] == [("id", "Int64"), ("name", "String"), ("price", "Decimal(9,2)"), ("tags", "Array(String)"), ("day", "Date32")] and t.columns[0].comment == "the id @source: a.b"
        m = spark.createDataFrame([('{"a":{"b":5},"name":"n","price":1.5,"tags":["x"],"day":"2024-01-01"}', "t", 0, 1)], "value string, topic string, partition int, offset long")
        rows, dead = pipeline.run(m, [t], Settings(routing=Routing(default_db="sluice_db", default_table="clicks")))
        rows["sluice_db.clicks"].write.insertInto("sluice_db.clicks")
        assert [(r.id, r.name, str(r.price), r.tags) for r in spark.table("sluice_db.clicks").collect()] == [(5, "n", "1.50", ["x"])] and dead.count() == 0
    finally:
        spark.sql("DROP DATABASE sluice_db CASCADE")


def test_transient_errors_are_tried_again():
    tries = []

    def fails(n, error):
        def f():
            tries.append(1)
            if len(tries) <= n:
                raise error

        return f

    runner.again(fails(3, PySparkException("busy")), tries=5, wait=0.001)
    assert len(tries) == 4
    tries.clear()
    with pytest.raises(PySparkException):
        runner.again(fails(9, PySparkException("busy")), tries=3, wait=0.001)
    assert len(tries) == 3
    tries.clear()
    with pytest.raises(ValueError):
        runner.again(fails(9, ValueError()), tries=3, wait=0.001)
    assert len(tries) == 1


def test_settings_are_read_anew_for_each_batch(spark, tmp_path):
    now = {"table": "a"}
    tables = [TableSpec("default", t, (ColumnSpec("id", "Int64"),)) for t in ("a", "b")]
    body = runner.sink(tables, lambda: Settings(routing=Routing(default_table=now["table"])), str(tmp_path / "out"), str(tmp_path / "dead"))
    m = spark.createDataFrame([('{"id":1}', "t", 0, 1), ("junk", "t", 0, 2)], "value string, topic string, partition int, offset long")
    body(m, 0)
    now["table"] = "b"
    body(m, 1)
    body(m, 1)  # written again, it replaces itself
    count = lambda t, k: spark.read.parquet(str(tmp_path / "out" / f"default.{t}" / f"batch={k}")).count()
    assert [count("a", 0), count("b", 0), count("a", 1), count("b", 1)] == [1, 0, 0, 1]
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 2
    with pytest.raises(ValueError):
        runner.sink(tables, Settings(), str(tmp_path / "o2"))(m, 0)


def test_rows_that_the_sink_refuses_become_dead_letters(spark, tmp_path, monkeypatch):
    plain = runner.write_batch

    def refusing(df, path, batch, **options):
        if path.endswith("default.b"):
            raise ArithmeticException("a value does not fit\nand more")
        plain(df, path, batch, **options)

    monkeypatch.setattr(runner, "write_batch", refusing)
    tables = [TableSpec("default", t, (ColumnSpec("id", "Int64"),)) for t in ("a", "b")]
    m = spark.createDataFrame([('{"kind":"a","id":1}', "t", 0, 1), ('{"kind":"b","id":2}', "t", 0, 2), ("junk", "t", 0, 3)], "value string, topic string, partition int, offset long")
    body = runner.sink(tables, Settings(routing=Routing(table_fields=("kind",), default_table="a")), str(tmp_path / "out"), str(tmp_path / "dead"))
    body(m, 0)
    assert spark.read.parquet(str(tmp_path / "out" / "default.a" / "batch=0")).count() == 1
    got = {r.offset: (r.stage, r.table, r.reason) for r in spark.read.parquet(str(tmp_path / "dead")).collect()}
    assert got[2] == ("sink", "default.b", "sink refused default.b: a value does not fit") and got[3][0] == "intake" and len(got) == 2
    with pytest.raises(ArithmeticException):
        runner.sink(tables, Settings(routing=Routing(table_fields=("kind",), default_table="a")), str(tmp_path / "o3"))(m, 0)


def test_pressure(spark):
    figure = lambda *x: round(spark.range(1).select(pipeline.pressure(*map(F.lit, x)).alias("x")).first().x, 6)
    assert figure(1.0, 1.0, 1.0, 1.0, 1.0) == 1.0 and figure(0.0, 0.0, 0.0, 0.0, 0.0) == 0.0 and figure(5.0, 0.0, 0.0, -1.0, 0.5) == 0.4


def test_split_records():
    split = lambda t: [v for _, v in SplitRecords().eval(t)]
    assert split('{"a":1}{"b":2}\n {"c":\n3}') == ['{"a":1}', '{"b":2}', '{"c":\n3}'] and split('{"a":1} [2]') == ['{"a":1}', "[2]"] and split("") == split(None) == [] and split("x {}") == ["x {}"]

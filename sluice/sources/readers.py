"""Sources: Kafka and file streams, mapping files, blocklists, location ranges."""

from __future__ import annotations

import csv
import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.mapping import Rule


def kafka_options(servers: str, topics: list[str] | None = None, pattern: str | None = None, suffix: str | None = None, exclude: list[str] | None = None, most: int | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source: listed topics, a pattern, or every topic with a
    suffix but for those that begin with an excluded word."""
    if sum(x is not None for x in (topics, pattern, suffix)) != 1:
        raise ValueError("give topics, a pattern or a suffix")
    out = {"kafka.bootstrap.servers": servers}
    barred = f"(?!(?:{'|'.join(map(re.escape, exclude))}))" if exclude else ""
    if topics is not None:
        out["subscribe"] = ",".join(topics)
    else:
        out["subscribePattern"] = barred + (pattern if pattern is not None else f".*{re.escape(suffix)}")
    if most:
        out["maxOffsetsPerTrigger"] = str(most)
    return out


def read_kafka(spark: SparkSession, **options) -> DataFrame:
    """The message stream, with text values; needs Spark's Kafka package."""
    raw = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_messages(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """A stream of text files, a message a line, in the shape of a Kafka source.  A file is
    a partition, named by the hash of its path, and the number of a line in it the offset,
    so that no two messages of a file share one.  A file is read as one row; for files of
    hundreds of megabytes take ``landed.LandedLines``, which cuts them."""
    files = spark.readStream.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    partition = F.pmod(F.crc32(F.col("path").cast("binary")), F.lit(1 << 31)).cast("int")
    # a last line feed ends a line and begins none
    lines = files.select(partition.alias("partition"), F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n")).alias("offset", "value"))
    return lines.select("value", F.lit(topic).alias("topic"), "partition", F.col("offset").cast("long").alias("offset"))


#: Most rows that a task of heavy work gets from ``spread``.
TASK_ROWS = 100_000


def spread(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``df`` over at least as many partitions as the session has cores, and over more where
    those would hold more than ``rows`` rows each: a source is dealt out before heavy work,
    and a task's work does not grow with it.  Counting a source reads the files' footers."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def table_names(spark: SparkSession, db: str | None = None) -> list[str]:
    """Names of the catalog's tables as ``db.table``."""
    db = db or spark.catalog.currentDatabase()
    return sorted(f"{db}.{t.name}" for t in spark.catalog.listTables(db) if not t.isTemporary)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def mapping_rules(path: str) -> tuple[Rule, ...]:
    """Rules of a mapping file: CSV with source_field, destination_field, copy_action
    (rows of one destination are tried in their order), or JSON or YAML with
    ``mappings: {destination: {sources: [...], action: ...}}``."""
    text = Path(path).read_text()
    if path.endswith(".csv"):
        found: dict[str, tuple[list[str], str]] = {}
        for row in csv.DictReader(text.splitlines()):
            sources, _ = found.setdefault(row["destination_field"].strip(), ([], (row.get("copy_action") or "rename").strip() or "rename"))
            sources.append(row["source_field"].strip())
        return tuple(Rule(d, tuple(s), a) for d, (s, a) in found.items())
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError("YAML mapping files need the yaml package") from e
        values = yaml.safe_load(text)
    else:
        values = json.loads(text)
    return tuple(Rule(d, tuple(v["sources"]), v.get("action", "rename")) for d, v in values["mappings"].items())


def blocklist(spark: SparkSession, path: str, threat: str = "blocklist", source: str = "custom", score: int = 0) -> DataFrame:
    """(network, threat, source, score, order) from one address or network a line; lines
    that begin with # or ; are comments, lines that are neither are passed over later."""
    lines = spark.read.text(path).select(F.trim("value").alias("network")).where("network <> '' and not network like '#%' and not network like ';%'")
    return lines.select("network", F.lit(threat).alias("threat"), F.lit(source).alias("source"), F.lit(score).alias("score"), F.monotonically_increasing_id().alias("order"))


def geo_ranges(spark: SparkSession, path: str) -> DataFrame:
    """A location table (network and the columns of ``enrich.GEO``) from CSV or Parquet."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.option("header", True).csv(path).withColumns({"latitude": F.expr("try_cast(latitude as double)"), "longitude": F.expr("try_cast(longitude as double)"), "asn": F.expr("try_cast(asn as long)")})


def count_where(df: DataFrame, condition: str | None = None) -> DataFrame:
    """Filtered row count; a condition may hold names, literals and comparisons only."""
    if condition is not None and (len(condition) > 256 or not re.fullmatch(r"[\w\s.'\"=<>!%(),:-]*", condition) or re.search(r"(?i)\b(select|union|insert|drop|delete|update)\b|--", condition)):
        raise ValueError("condition is not allowed")
    return (df if condition is None else df.where(condition)).agg(F.count("*").alias("rows"))


def catalog_table(spark: SparkSession, name: str):
    """A ``TableSpec`` from the session's catalog, with column and table comments."""
    from sluice.operators.model import ColumnSpec, TableSpec

    db, _, table = name.rpartition(".")
    columns = tuple(ColumnSpec(c.name, _type(c.dataType), c.description or "") for c in spark.catalog.listColumns(name))
    return TableSpec(db or spark.catalog.currentDatabase(), table, columns, spark.catalog.getTable(name).description or "")


def _type(spark_type: str) -> str:
    plain = {"tinyint": "Int8", "smallint": "Int16", "int": "Int32", "bigint": "Int64", "float": "Float32", "double": "Float64", "boolean": "Bool", "date": "Date32", "timestamp": "DateTime64(6)", "string": "String"}
    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", spark_type):
        return f"Decimal({m[1]},{m[2]})"
    if m := re.fullmatch(r"array<(.*)>", spark_type):
        return f"Array({_type(m[1])})"
    return plain.get(spark_type, "String")

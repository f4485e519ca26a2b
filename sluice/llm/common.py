"""What the corpus operators share: reading, stored intermediate tables, words."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import weakref
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_own: dict[str, str] = {}
_paths: dict[int, str] = {}  # of stored tables


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share, in this session's own under
    ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    application = spark.sparkContext.applicationId
    top = spark.conf.get("spark.checkpoint.dir", None) or _own.get(application)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = _own[application] = "file://" + tempfile.mkdtemp(prefix="sluice-")
    return f"{top.rstrip('/')}/sluice-{application}/{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A query within runs with this setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _shuffles_go(spark: SparkSession):
    """The shuffles that a query within takes go when it is done."""
    return setting(spark, _CLEANUP, "true")


def write(writer: DataFrameWriter, path: str) -> None:
    """Save to ``path``; the shuffles that this took go when it is done."""
    with _shuffles_go(writer._spark):
        writer.save(path)


def bucketed(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` written once as a Parquet table in ``n`` buckets by ``key``, so that what
    groups or joins it by ``key`` again and again doesn't shuffle it.  What comes out of a
    grouping by ``key`` lies in its buckets already and is written as it lies."""
    spark = df.sparkSession
    path = shared_dir(spark)
    name = "sluice_" + path.rpartition("/")[2]
    with _shuffles_go(spark):
        df.write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    _paths[id(out)] = path
    weakref.finalize(out, _paths.pop, id(out), None)
    return out


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and that table: its rows
    stay the same whatever executor is lost, and plans on it start from files."""
    spark = df.sparkSession
    path = shared_dir(spark)
    write(df.write.format("parquet").options(**options), path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = path
    weakref.finalize(out, _paths.pop, id(out), None)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing reads any more, results that are still to be
    computed included."""
    for df in tables:
        path = _paths[id(df)]
        df.sparkSession.sql(f"DROP TABLE IF EXISTS sluice_{path.rpartition('/')[2]}")
        _delete(df.sparkSession, path)


def clean(spark: SparkSession) -> None:
    """Delete all that this session has stored in the shared folder, once results that
    read it have been written elsewhere."""
    _delete(spark, shared_dir(spark).rpartition("/")[0])


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores before them, as many as make them differ from every
    column of ``df``, whatever the case."""
    taken, mark = {c.lower() for c in df.columns}, "_"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def column(df: DataFrame, name: str) -> Column:
    """A column of ``df`` by its literal name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other letter left alone."""
    return F.translate(text, UPPER, LOWER)


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_enough(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no further than it must."""
    return df.limit(limit + 1).count() <= limit


def give_back() -> None:
    """Return what this Python worker has freed to the system; it lives on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass

"""The event pipeline over a stream: one ``foreachBatch`` that writes every table and the
dead letters of a micro-batch under the batch's own number, so that a repeated batch
replaces what it wrote before."""

from __future__ import annotations

import logging
import random
import time
from collections import Counter
from collections.abc import Callable

from pyspark.errors import AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException, NumberFormatException, ParseException, PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.enrich import Enrichment
from sluice.operators.model import Settings, TableSpec
from sluice.plans import onepass, pipeline

log = logging.getLogger("sluice")
#: Ways to place dead letters: the queue and files if it fails, both, one of them, none.
MODES = ("cascade", "fan_out", "file_only", "queue_only", "disabled")
Writer = Callable[[DataFrame, int], None]
_DATA = (ArithmeticException, NumberFormatException, DateTimeException, ArrayIndexOutOfBoundsException)
_FATAL = (AnalysisException, ParseException, IllegalArgumentException)


def error_class(error: BaseException) -> str:
    """``data`` for an error that the rows make, however often they are written; ``fatal``
    for one of plan or settings; ``transient`` for any other."""
    if isinstance(error, _DATA) or (getattr(error, "getCondition", lambda: None)() or "").startswith(("CAST_", "DIVIDE_", "INVALID_", "MALFORMED_", "NUMERIC_")):
        return "data"
    return "fatal" if isinstance(error, _FATAL) or not isinstance(error, PySparkException) else "transient"


def again(f: Callable[[], None], tries: int = 5, wait: float = 0.1) -> None:
    """``f``, tried again after transient errors with growing, jittered waits up to 30
    seconds."""
    for k in range(tries):
        try:
            return f()
        except Exception as e:
            if k == tries - 1 or error_class(e) != "transient":
                raise
            time.sleep(min(30.0, wait * 2**k) * random.uniform(0.5, 1.0))


def _count_once(totals: Counter, last: dict[int, dict[str, int]], batch: int, counts: dict[str, int]) -> None:
    """Add a batch's counts, in place of those of its last try."""
    totals.subtract(last.get(batch, {}))
    totals.update(counts)
    last.clear()
    last[batch] = counts


def write_batch(df: DataFrame, path: str, batch: int, tries: int = 5, wait: float = 0.1, form: str = "parquet") -> None:
    """Write ``df`` as the batch's folder of ``path``: typed rows as Parquet, or lines of
    JSON (``form``).  A batch that is written again replaces itself."""
    again(lambda: df.write.mode("overwrite").format(form).save(f"{path}/batch={batch}"), tries, wait)


def dead_letters_to(mode: str, path: str | None = None, queue: Writer | None = None, most_bytes: int = 1_000_000, own_topics: tuple[str, ...] = ()) -> Writer:
    """Places a batch's dead letters by one of ``MODES``: files under ``path``, and ``queue``
    (such as a batch writer to Kafka).

    Letters from ``own_topics``, which are read back from the queue, go to files alone, so
    that none goes round in circles, as do payloads of more than ``most_bytes``, if there
    is a ``path``.  What has no place, as all letters with ``disabled``, is counted by
    reason in the writer's ``dropped`` and logged; a batch that is written again counts
    in place of its first try.
    """
    if mode not in MODES:
        raise ValueError(f"dead letters are placed by one of {MODES}")
    if mode in ("cascade", "fan_out", "queue_only") and queue is None or mode in ("cascade", "fan_out", "file_only") and path is None:
        raise ValueError(f"{mode} needs its places")

    last: dict[int, dict[str, int]] = {}  # only the batch at hand can come again
    own = F.coalesce(F.col("topic").isin(*own_topics), F.lit(False)) if own_topics else F.lit(False)

    def drop(letters: DataFrame, batch: int) -> None:
        why = F.when(F.lit(mode == "disabled"), "disabled").when(own, "own_topic").otherwise("too_large")
        found = {r["why"]: r["n"] for r in letters.groupBy(why.alias("why")).agg(F.count("*").alias("n")).collect()}  # a row for each reason
        _count_once(run.dropped, last, batch, found)
        if found:
            log.warning("dead letters of batch %d without a place: %s", batch, found)

    def run(dead: DataFrame, batch: int) -> None:
        if mode == "disabled":
            return drop(dead, batch)
        fits = F.coalesce(F.octet_length("payload") <= most_bytes, F.lit(True)) & ~own
        files = lambda df: write_batch(df, path, batch)
        if mode == "file_only":
            return files(dead)
        if mode == "queue_only":
            again(lambda: queue(dead.where(fits), batch))
            return files(dead.where(~fits)) if path is not None else drop(dead.where(~fits), batch)
        if mode == "fan_out":
            again(lambda: queue(dead.where(fits), batch))
            return files(dead)
        try:
            again(lambda: queue(dead.where(fits), batch))
        except Exception as e:
            if error_class(e) == "fatal" and not isinstance(e, PySparkException | OSError):
                raise
            return files(dead)
        files(dead.where(~fits))

    run.dropped = Counter()
    return run


def sink(tables: list[TableSpec], settings: Settings | Callable[[], Settings], path: str, dead: str | Writer | None = None, form: str = "parquet", enrichment: Enrichment | None = None) -> Writer:
    """The body of ``foreachBatch``.  Settings given as a function are read anew for each
    batch; dead letters go to files under a path or to a writer of ``dead_letters_to``, and
    without either, a batch with dead letters fails.  Where the rows of a table can't be
    written for what they hold, its messages become dead letters of the stage ``sink``, with
    the table and the error as their reason, and the other tables are written."""
    place = dead_letters_to("file_only", dead) if isinstance(dead, str) else dead

    def run(batch: DataFrame, number: int) -> None:
        now = settings() if callable(settings) else settings
        held: list[DataFrame] = []

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        try:
            parts, letters = pipeline.run(batch, tables, now, hold=hold, enrichment=enrichment)
            for name, rows in parts.items():
                try:
                    write_batch(rows, f"{path}/{name}", number, form=form)
                except Exception as e:
                    if place is None or error_class(e) != "data":
                        raise
                    letters = letters.unionByName(_refused(batch, tables, now, hold, name, e))
            if place is not None:
                place(letters, number)
            elif letters.limit(1).count():
                raise ValueError("there are dead letters and nowhere to put them")
        finally:
            for df in held:
                df.unpersist()

    return run


def _refused(batch: DataFrame, tables: list[TableSpec], settings: Settings, hold: Callable[[DataFrame], DataFrame], name: str, error: Exception) -> DataFrame:
    """The messages of a table whose rows the sink refused, as dead letters."""
    good = pipeline.routed(batch, settings, [t.name for t in tables], hold=hold).good.where(F.concat_ws(".", "_db", "_table") == name)
    reason = f"sink refused {name}: {str(error).splitlines()[0][:200]}" if str(error) else f"sink refused {name}"
    return pipeline.dead_letters(good.withColumn("_reject", F.lit(reason)), "sink")


def sink_once(tables: list[TableSpec], settings: Settings | Callable[[], Settings], path: str, dead: Writer | None = None, enrichment: Enrichment | None = None) -> Writer:
    """``sink`` with one scan and one write a batch: all tables and the dead letters go to
    ``path``/batch=N, in a folder for each table, and the letters from there to ``dead``, if
    given.  The counters of ``onepass``, summed over batches, are the writer's ``totals``; a
    batch that is written again counts in place of its first try."""
    last: dict[int, dict[str, int]] = {}

    def run(batch: DataFrame, number: int) -> None:
        now = settings() if callable(settings) else settings
        at = f"{path}/batch={number}"

        def write() -> None:
            seen = Observation(f"batch-{number}")  # observes one write
            frame = onepass.tagged(batch, tables, now, enrichment=enrichment, counters=seen)
            onepass.write_tagged(frame, at)
            _count_once(run.totals, last, number, seen.get)
            if dead is not None:
                letters = batch.sparkSession.read.schema(frame.schema).parquet(at).where(F.col("_table") == onepass.DEAD)
                dead(onepass.letters(letters), number)

        again(write)

    run.totals = Counter()
    return run


def start(messages: DataFrame, tables: list[TableSpec], settings: Settings | Callable[[], Settings], path: str, dead: str | Writer, checkpoint: str, interval: str | None = None, **options) -> StreamingQuery:
    """Start the pipeline on a message stream; without an interval it takes what there
    is and stops.  How much a micro-batch takes is the source's own option."""
    writer = messages.writeStream.foreachBatch(sink(tables, settings, path, dead, **options)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()

"""Records of tables that are not there yet, held in keyed state until the table is found
or their time is over."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What comes out: the message, its table, and ``found`` or ``expired``.
OUT = "value string, topic string, partition int, offset long, table string, outcome string"


def _out(message: tuple, table: str, outcome: str) -> Row:
    value, topic, partition, offset = message
    return Row(value=value, topic=topic, partition=partition, offset=offset, table=table, outcome=outcome)


class Waiting(StatefulProcessor):
    """One key is one absent table, or one of the ``parts`` of it.

    ``exists`` is asked when the first message of a table comes, and again each
    ``again_ms`` by a timer: once it holds, all that was held comes out as ``found``.
    After ``ttl_ms`` without it what is held comes out as ``expired``, and the table is
    asked for anew with its next message.
    """

    def __init__(self, exists: Callable[[str], bool], again_ms: int, ttl_ms: int):
        self.exists, self.again_ms, self.ttl_ms = exists, again_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "value string, topic string, partition int, offset long")
        self.since = handle.getValueState("since", "ms long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        table, now = key[0], timerValues.getCurrentProcessingTimeInMs()
        if not self.since.exists() and self.exists(table):
            for r in rows:
                yield _out((r.value, r.topic, r.partition, r.offset), table, "found")
            return
        if not self.since.exists():
            self.since.update((now,))
            self.handle.registerTimer(now + self.again_ms)
        for r in rows:
            self.held.appendValue((r.value, r.topic, r.partition, r.offset))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        table, now = key[0], timerValues.getCurrentProcessingTimeInMs()
        there = self.exists(table)
        if there or now - self.since.get()[0] >= self.ttl_ms:
            for h in self.held.get():
                yield _out(h, table, "found" if there else "expired")
            self.held.clear()
            self.since.clear()
        else:
            self.handle.registerTimer(now + self.again_ms)

    def close(self) -> None:
        pass


def until_known(messages: DataFrame, exists: Callable[[str], bool], again_ms: int = 60_000, ttl_ms: int = 300_000, parts: int = 16) -> DataFrame:
    """A stream of messages (value, topic, partition, offset, table) held back while
    ``exists(table)`` does not hold, with their ``outcome``.  ``exists`` runs in tasks; one
    busy table is held in ``parts`` parts.  Needs the RocksDB state store."""
    part = F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(parts)).cast("int")
    keyed = messages.select("value", "topic", "partition", "offset", "table").withColumn("part", part)
    return keyed.groupBy("table", "part").transformWithState(Waiting(exists, again_ms, ttl_ms), OUT, "Append", "ProcessingTime")

"""Event time: windows, duplicates and joins of two streams, each held to a watermark.

The same calls give the whole result on a batch, where nothing is late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seconds(interval: str) -> int:
    """Seconds of an interval such as ``10 minutes``."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    number, unit = interval.split()
    return int(number) * units[unit.rstrip("s")]


def windowed(rows: DataFrame, time: str, size: str, *aggregates: Column, keys: tuple[str, ...] = (), slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(window_start, window_end, keys, aggregates) over tumbling windows, or sliding ones.

    A stream waits ``late`` for rows that come out of order and forgets a window after
    that; the aggregates are partial before the shuffle, on the window and the keys.
    """
    window = F.window(time, size, slide) if slide else F.window(time, size)
    out = rows.withWatermark(time, late).groupBy(window.alias("_window"), *keys).agg(*aggregates)
    return out.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *[c for c in out.columns if c != "_window"])


def distinct_within(rows: DataFrame, time: str, *keys: str, late: str = "10 minutes") -> DataFrame:
    """One row of each ``keys``: on a stream those that arrive within ``late`` of each other
    in event time are duplicates, whatever their own times; a batch keeps one of all."""
    if not rows.isStreaming:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def joined_within(left: DataFrame, right: DataFrame, left_time: str, right_time: str, within: str, on: tuple[tuple[str, str], ...] = (), late: str = "10 minutes", how: str = "inner") -> DataFrame:
    """Pairs with right_time - ``within`` <= ... that is, each left row with the right rows
    of up to ``within`` before it: left_time - within <= right_time <= left_time.

    Both sides are dealt out by bins of time as wide as ``within``: a right row is in the
    bin of its own time and the next, a left row in its own, and a pair of one bin is a
    candidate.  So the join is one of equal keys, whether there are keys beside the time
    or not, and one busy key is cut by time.  On streams both sides have a watermark, and
    the bound on the times tells Spark when a row can go.  Columns of both sides need
    names of their own.
    """
    width = seconds(within)
    bin_of = lambda t: F.floor(F.unix_seconds(F.col(t).cast("timestamp")) / width)
    a, b = left, right
    if left.isStreaming:
        a = left.withWatermark(left_time, late)
    if right.isStreaming:
        b = right.withWatermark(right_time, late)
    a = a.withColumn("_left_bin", bin_of(left_time))
    b = b.withColumn("_right_bin", F.explode(F.array(bin_of(right_time), bin_of(right_time) + 1)))
    gap = F.expr(f"interval {width} seconds")
    condition = (F.col("_left_bin") == F.col("_right_bin")) & (F.col(right_time) <= F.col(left_time)) & (F.col(right_time) >= F.col(left_time) - gap)
    for x, y in on:
        condition &= F.col(x) == F.col(y)
    return a.join(b, condition, how).drop("_left_bin", "_right_bin")

"""Best-fit packing of token sequences by large-item matching.

All pieces of one length are alike to a packer, so the packing is planned on the
histogram of lengths: at most one entry for each length up to the capacity, however
large the corpus.  Pieces above a third of the capacity pair at most twice in a
bin: from the longest down, each is matched with the longest that still fits beside
it.  Smaller pieces go, from the longest down, into the smallest remaining gap that
holds them.  Every step of the plan places a run of equal pieces in a run of equal
bins; a piece finds its bin by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import give_back, partitions, stored
from sluice.llm.tokens import let_go, slices, worker_encoder


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, first rank, past rank, first bin, pieces a bin, offset in the bin)
    that place all pieces of the histogram; bins are numbered from 0 without gaps."""
    left = {k: n for k, n in histogram.items() if n}
    rank: dict[int, int] = defaultdict(int)
    steps: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first bin, bins)
    open_gaps: list[int] = []
    bins = 0

    def place(length: int, n_bins: int, each: int, first_bin: int, offset: int, pieces: int | None = None) -> None:
        n = n_bins * each if pieces is None else pieces
        steps.append((length, rank[length], rank[length] + n, first_bin, each, offset))
        rank[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    def leave(gap: int, first_bin: int, n_bins: int) -> None:
        if gap and n_bins:
            if not gaps[gap]:
                insort(open_gaps, gap)
            gaps[gap].append((first_bin, n_bins))

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1
        b = large[at] if at >= 0 else None
        if b == a and left[a] < 2:
            b = large[at - 1] if at > 0 else None
        if b is None:
            n = left[a]
            place(a, n, 1, bins, 0)
            leave(capacity - a, bins, n)
        elif b == a:
            n = left[a] // 2
            place(a, n, 2, bins, 0)
            leave(capacity - 2 * a, bins, n)
        else:
            n = min(left[a], left[b])
            place(a, n, 1, bins, 0)
            place(b, n, 1, bins, a)
            leave(capacity - a - b, bins, n)
        bins += n
        large = [k for k in large if k in left] if a not in left or b not in left else large
    for s in sorted(left, reverse=True):
        while s in left:
            at = bisect_left(open_gaps, s)
            if at == len(open_gaps):
                each = capacity // s
                n = -(-left[s] // each)
                leave(capacity, bins, n)
                bins += n
                continue
            gap = open_gaps[at]
            first, n_bins = gaps[gap].pop()
            if not gaps[gap]:
                open_gaps.pop(at)
            each = min(gap // s, left[s])
            n = min(n_bins, left[s] // each)
            place(s, n, each, first, capacity - gap)
            leave(gap - each * s, first, n)
            leave(gap, first + n, n_bins - n)
    return steps


def _piece_partition(path: str, end_id: int, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for batch in batches:
            for rows in slices(batch):
                flat, n = encoder.encode_flat(rows.column("text"))
                ids = np.insert(flat.astype("<u4"), np.cumsum(n), end_id)  # an end behind each text
                n = n + 1
                counts = -(-n // capacity)
                number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                length = np.minimum(capacity, np.repeat(n, counts) - number * capacity)
                past = np.cumsum(length)
                made = [
                    rows.column("rid").take(pa.array(np.repeat(np.arange(len(n)), counts))), rows.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), counts))), pa.array(number, pa.int32()),
                    pa.array(number * capacity, pa.int64()), pa.array(length, pa.int64()), pa.array([zlib.crc32(ids[a:b]) for a, b in zip((past - length).tolist(), past.tolist(), strict=True)], pa.int64()),
                ]
                names = ["rid", "doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    made.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], past)), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(made, names)
        if keep_ids:  # other stages follow in this worker, which need its memory
            del encoder
            let_go(path)
        give_back()

    return run


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """A stored table of the pieces: rid, doc_id, piece, start, length, ids_crc32[, ids].
    A document's ids end with ``end_id``; only documents longer than ``capacity`` are cut."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "rid long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return stored(rows.mapInArrow(_piece_partition(tokenizer, end_id, capacity, keep_ids), schema))


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (rid, piece, length, ...) with sequence_id and offset.

    Ranks within a length come from salted parts, so that a length which very many
    pieces share is ranked by many tasks.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    if not histogram:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    most = max(64, sum(histogram.values()) // (4 * partitions(spark)))
    parts = spark.createDataFrame([(k, -(-n // most)) for k, n in histogram.items()], "length long, parts int")
    steps = spark.createDataFrame(plan(histogram, capacity), "of_length long, first long, past long, first_bin long, each long, at long")
    salted = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64("rid", "piece"), F.col("parts")).cast("int"))  # capacity rows
    sizes = salted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = sizes.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = salted.withColumn("place", F.row_number().over(Window.partitionBy("length", "part").orderBy("rid", "piece")))
    ranked = ranked.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place") - 1)
    # the plan has a few steps for each length, whatever the corpus
    found = ranked.join(F.broadcast(steps), (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")))
    k = F.col("rank") - F.col("first")
    return found.select(*pieces.columns, (F.col("first_bin") + F.expr("(rank - first) div each")).alias("sequence_id"), (F.col("at") + (k % F.col("each")) * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = True) -> DataFrame:
    """Every piece of ``docs`` (doc_id, text) with its place in a training sequence:
    doc_id, piece, start, length, ids_crc32[, ids], sequence_id and offset.

    A null text is empty: its document is the end id alone.  Rows count one by one,
    so repeated rows and repeated or null doc_ids are each packed.  No rows give no
    rows.  Further columns are left out.
    """
    return pack(pieces_of(docs, tokenizer, end_id, capacity, keep_ids), capacity).drop("rid")

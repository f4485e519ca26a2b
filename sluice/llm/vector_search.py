"""Exact top-k search with vector-approximation files.

Vectors are whole numbers.  Every dimension is cut into 256 cells of equal width
between its least and greatest value over the whole table, and a vector's
approximation is a byte for each dimension.  Queries and approximations meet in
blocks: a product with the cell middles gives each score up to a bound that depends
on the query alone, and a vector whose upper bound reaches the block's k-th lower
bound is handed on.

What also reaches the k-th lower bound over all blocks is read exactly in the order of
its bounds, the most promising first: a few vectors for each query, then twice as many,
and so on, until no unread vector's upper bound reaches the k-th exact score so far.

Equal vectors are searched once: the k+1 smallest ids of each distinct vector, with the
number of rows of each, are all that any answer can hold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, stored

CELLS = 256
CANDIDATE_BLOCK, QUERY_BLOCK = 4096, 1024


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null if the vector is null or has a
    component that is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _distinct(vectors: DataFrame, k: int) -> DataFrame:
    """(vid, v, ids): each distinct vector with its k+1 smallest ids and the rows of each,
    k at most.  The count is partial before its shuffle, so copies do not travel."""
    counted = vectors.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("rows"))
    ranked = counted.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    groups = ranked.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "rows"))).alias("ids"))
    return stored(groups.select(F.monotonically_increasing_id().alias("vid"), "v", "ids"))


def _cells(distinct: DataFrame) -> tuple[DataFrame, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """(vid, dims, cells binary) and, by number of dimensions, least values and widths."""
    flat = distinct.select(F.size("v").alias("dims"), F.posexplode("v").alias("d", "x"))
    # a row for each dimension
    found = flat.groupBy("dims", "d").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()
    grid: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in {r["dims"] for r in found}:
        low, width = np.zeros(n), np.ones(n)
        for r in found:
            if r["dims"] == n:
                low[r["d"]], width[r["d"]] = r["low"], max(1, -(-(r["high"] - r["low"] + 1) // CELLS))
        grid[n] = low, width

    def quantise(batches):
        for pdf in batches:
            cells = []
            for v in pdf["v"]:
                low, width = grid.get(len(v), (np.zeros(0), np.ones(0)))
                cells.append(((np.asarray(v, np.float64) - low) // width).astype(np.uint8).tobytes())
            yield pd.DataFrame({"vid": pdf["vid"], "dims": [len(v) for v in pdf["v"]], "cells": cells})

    return distinct.select("vid", "v").mapInPandas(quantise, "vid long, dims int, cells binary"), grid


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _scan(grid: dict[int, tuple[np.ndarray, np.ndarray]]):
    def run(key: tuple, cells: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(cells) or not len(queries):
            return pd.DataFrame({"qid": np.empty(0, np.int64), "vid": np.empty(0, np.int64), "low": np.empty(0), "high": np.empty(0)})
        n = key[0]
        low, width = grid.get(n, (np.zeros(0), np.ones(0)))
        middle = low + (np.frombuffer(b"".join(cells["cells"]), np.uint8).reshape(len(cells), n) + 0.5) * width - 0.5
        q = np.array(queries["v"].tolist(), np.float64).reshape(len(queries), n)
        near = np.abs(q) @ ((width - 1) / 2)  # how far a score may lie from the middle's
        near = near * (1 + 1e-9) + 1e-6
        vid, qid, need, out = cells["vid"].to_numpy(), queries["qid"].to_numpy(), queries["need"].to_numpy(), []
        for s in range(0, len(q), 128):
            score, e = q[s : s + 128] @ middle.T, near[s : s + 128, None]
            most = min(int(need[s : s + 128].max()), score.shape[1])
            kth = np.partition(score, -most, axis=1)[:, -most, None] - e
            i, j = np.nonzero(score + e >= kth)
            out.append(pd.DataFrame({"qid": qid[s + i], "vid": vid[j], "low": score[i, j] - e[i, 0], "high": score[i, j] + e[i, 0]}))
        return pd.concat(out)

    return run


def _kth(rows: DataFrame, by: str, asked: DataFrame) -> DataFrame:
    """(qid, kth): of each query's ``need``-th highest ``by``; minus infinity if there are
    fewer."""
    ranked = rows.join(asked.select("qid", "need"), "qid").withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc(by)))).where(F.col("n") <= F.col("need"))
    found = ranked.groupBy("qid").agg(F.count("*").alias("n"), F.min(by).alias("kth"), F.first("need").alias("need"))
    return found.select("qid", F.when(F.col("n") == F.col("need"), F.col("kth").cast("double")).otherwise(float("-inf")).alias("kth"))


def _exact(met: DataFrame, distinct: DataFrame, asked: DataFrame, first: int) -> DataFrame:
    """(qid, vid, score) of the vectors read exactly, in the order of their upper bounds,
    until none is left whose bound reaches the query's ``need``-th exact score."""
    order = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("high"), "vid"))
    left, read, size = stored(met.withColumn("n", order).select("qid", "vid", "high", "n")), None, first
    product = F.aggregate(F.zip_with("v", "q", lambda x, y: x * y), F.lit(0).cast("long"), lambda a, x: a + x)
    while True:
        now = left.where(F.col("n") <= size).join(distinct.select("vid", "v"), "vid").join(asked.select("qid", F.col("v").alias("q")), "qid")
        scored = now.select("qid", "vid", product.alias("score"))
        read = stored(scored if read is None else read.union(scored))
        rest = left.where(F.col("n") > size).join(_kth(read, "score", asked), "qid").where("high >= kth")
        more = stored(rest.select("qid", "vid", "high", "n"))
        discard(left)
        if not more.limit(1).count():
            return read
        left, size = more, 2 * size


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """For each row of ``queries`` (query_id, v) the ``k`` rows of ``vectors`` (vec_id, v)
    with the highest inner product, but for rows of its own id: query_id, rank (from 1),
    vec_id and score; ties go to the smaller id, fewer rows give them all.

    ``v`` holds whole numbers, as ``whole_numbers`` makes them; null vectors and ids take
    no part, and only vectors of one length are compared.  Rows count one by one: a
    repeated row of ``vectors`` can fill several ranks, and each row of ``queries`` gets
    its answer.  No rows give no rows; further columns are left out.
    Scores must fit in 64 bits, and their sums of products in 53 bits for the bounds.
    """
    vectors = vectors.where("v is not null and vec_id is not null").select("vec_id", "v")
    queries = queries.where("v is not null and query_id is not null").select("query_id", "v")
    distinct = _distinct(vectors, k)
    # a query's own id may take as many of the best distinct vectors as it has itself
    own = vectors.join(queries.select(F.col("query_id").alias("vec_id")).distinct(), "vec_id", "left_semi").distinct().groupBy(F.col("vec_id").alias("query_id")).agg(F.count("*").alias("own"))
    asked = queries.join(own, "query_id", "left").groupBy("v").agg((F.max(F.coalesce("own", F.lit(0))) + k).cast("int").alias("need"))
    asked = stored(asked.select(F.monotonically_increasing_id().alias("qid"), "v", "need"))
    cells, grid = _cells(distinct)
    blocks, query_blocks = -(-distinct.count() // CANDIDATE_BLOCK) or 1, -(-asked.count() // QUERY_BLOCK) or 1
    cells = cells.withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(blocks))).withColumn("query_block", F.explode(_upto(query_blocks)))
    dealt = asked.withColumn("dims", F.size("v")).withColumn("query_block", F.pmod(F.xxhash64("qid"), F.lit(query_blocks))).withColumn("block", F.explode(_upto(blocks)))
    key = ["dims", "block", "query_block"]
    met = stored(cells.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(_scan(grid), "qid long, vid long, low double, high double"))
    near = met.join(_kth(met, "low", asked), "qid").where("high >= kth").select("qid", "vid", "high")
    read = _exact(near, distinct, asked, 2 * (k + 1))
    discard(met)
    rows = read.join(distinct.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("x")).select("qid", "score", "x.vec_id", "x.rows")
    # of one query's entries, those of one id and score together
    rows = rows.groupBy("qid", "score", "vec_id").agg(F.least(F.sum("rows"), F.lit(k)).cast("int").alias("rows")).join(asked.select("qid", "need"), "qid")
    best = rows.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= F.col("need"))
    best = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "rows"))).alias("best"))
    mine = queries.join(best.join(asked, "qid").select("v", "best"), "v")
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    each = F.slice(F.flatten(F.transform(others, lambda x: F.array_repeat(x, x["rows"]))), 1, k)
    return mine.select("query_id", F.posexplode(each).alias("n", "x")).select("query_id", (F.col("n") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


def embedding_search(embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """``top_k`` of the rows whose vec_id is divisible by ``every`` against all rows, with
    the components of ``embedding`` as whole numbers: floor(``scale`` * x).  Rows with a
    null id, a null vector or one with a null or non-finite component take no part; ties,
    repeated rows, an empty table and further columns count as in ``top_k``."""
    vectors = stored(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding"), scale).alias("v")))
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id"), k)

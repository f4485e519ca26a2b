"""Compression of vectors to codes, with nearest entries found by segment-mean bounds.

A vector of whole numbers is cut into parts, and each part gets the number of its nearest
entry in the codebook of that part position.  Codebooks start from the first vectors and
move for some rounds to the means of what is assigned to them.

The nearest entry is searched coarse to fine.  At each level a part and the entries are
cut into blocks; of each block the mean, times the root of the block's length, and the
norm of what the mean leaves are kept.  The squared distance of two such summaries never
exceeds that of the vectors, so an entry whose summary is farther than an entry measured
before is out; what is left after the finest level is measured exactly, in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import column, free_names, small_enough, stored
from sluice.llm.vector_search import whole_numbers

#: Distinct labels up to which their sums are broadcast.
BROADCAST_LABELS = 100_000
#: Vectors assigned at once.
BLOCK = 1024


@dataclass(frozen=True)
class Coding:
    """``scale``: components become floor(scale * x).  ``levels``: numbers of blocks of a
    part, from coarse to fine."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    levels: tuple[int, ...] = (1, 2, 4)


Codebooks = list[np.ndarray]  # for each part: entries x components


def cut(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    """Consecutive parts; where the length is no multiple, the first are a component longer."""
    return np.array_split(vectors, parts, axis=1)


def summaries(part: np.ndarray, blocks: int) -> np.ndarray:
    """For each row of ``part`` and each block the scaled mean and the residual norm."""
    if not part.shape[1]:
        return np.zeros((len(part), 1))
    out = []
    for block in np.array_split(part.astype(np.float64), min(blocks, part.shape[1]), axis=1):
        mean = block.mean(axis=1)
        out += [mean * np.sqrt(block.shape[1]), np.sqrt(((block - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(out, axis=1)


class Entries:
    """The entries of one part position, with their summaries."""

    def __init__(self, entries: np.ndarray, levels: tuple[int, ...]):
        self.entries, self.levels = entries, levels
        self.of = [summaries(entries, n) for n in levels]
        self.norms = (entries.astype(np.float64) ** 2).sum(axis=1)

    def nearest(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry, the smaller one of equals, and the squared distance."""
        rows = np.arange(len(part))
        of = [summaries(part, n) for n in self.levels]
        # what the bounds may be off by in floating point
        slack = 1e-9 * ((part.astype(np.float64) ** 2).sum(axis=1) + self.norms.max()) + 1e-6
        far = ((of[0][:, None, :] - self.of[0][None]) ** 2).sum(axis=2)
        first = far.argmin(axis=1)
        most = ((part - self.entries[first]) ** 2).sum(axis=1)
        row, entry = np.nonzero(far <= (most + slack)[:, None])
        for mine, theirs in zip(of[1:], self.of[1:], strict=True):
            bound = ((mine[row] - theirs[entry]) ** 2).sum(axis=1)
            near = bound <= most[row] + slack[row]
            row, entry = row[near], entry[near]
        exact = ((part[row] - self.entries[entry]) ** 2).sum(axis=1)
        starts = np.searchsorted(row, rows)  # a row keeps the entry measured first, at least
        least = np.minimum.reduceat(exact, starts)
        tied = np.flatnonzero(exact == least[row])
        best = tied[np.searchsorted(row[tied], rows)]
        return entry[best], least


def _assigned(codebooks: Codebooks, levels: tuple[int, ...], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers (rows x parts) and squared distances, summed over parts."""
    books = [Entries(c, levels) for c in codebooks]
    codes, error = np.empty((len(vectors), len(books)), np.int64), np.zeros(len(vectors), np.int64)
    for s in range(0, len(vectors), BLOCK):
        for p, (part, book) in enumerate(zip(cut(vectors[s : s + BLOCK], len(books)), books, strict=True)):
            codes[s : s + BLOCK, p], far = book.nearest(part)
            error[s : s + BLOCK] += far
    return codes, error


def _matrix(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of ``size`` components as rows, and where they are."""
    fits = pc.equal(pc.list_value_length(batch.column("v")), size)
    vectors = batch.column("v").filter(fits).flatten().to_numpy(zero_copy_only=False)
    fits = fits.to_numpy(zero_copy_only=False)
    return vectors.reshape(int(fits.sum()), size), fits


def _sums(codebooks: Codebooks, coding: Coding, size: int):
    """What each task's vectors add to the entries: (part, entry, n, sums)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        counts = np.zeros((len(codebooks), coding.entries), np.int64)
        for batch in batches:
            vectors, _ = _matrix(batch, size)
            codes, _ = _assigned(codebooks, coding.levels, vectors)
            for p, part in enumerate(cut(vectors, len(codebooks))):
                np.add.at(sums[p], codes[:, p], part)
                counts[p] += np.bincount(codes[:, p], minlength=coding.entries)
        p, e = np.nonzero(counts)
        rows = [sums[i][j].tolist() for i, j in zip(p, e, strict=True)]
        yield pa.RecordBatch.from_pydict({"part": p.astype(np.int32), "entry": e.astype(np.int32), "n": counts[p, e], "sums": pa.array(rows, pa.list_(pa.int64()))})

    return run


def train(kept: DataFrame, coding: Coding = Coding()) -> Codebooks:
    """Codebooks from the vectors of ``kept`` (vec_id, v), a stored table.

    The driver holds the codebooks and gets one sum for each of their components a round,
    whatever the number of vectors.
    """
    firsts = kept.where("vec_id is not null").orderBy("vec_id", "v").limit(coding.entries).select("v").collect()
    firsts = [r["v"] for r in firsts if len(r["v"]) == len(firsts[0]["v"])]
    if not firsts:
        return []
    codebooks = cut(np.array(firsts, np.int64).reshape(len(firsts), -1), coding.parts)
    size = len(firsts[0])
    for _ in range(coding.rounds):
        made = kept.select("v").mapInArrow(_sums(codebooks, coding, size), "part int, entry int, n long, sums array<long>")
        flat = made.select("part", "entry", "n", F.posexplode("sums").alias("k", "x"))
        codebooks = [c.copy() for c in codebooks]
        for r in flat.groupBy("part", "entry", "k").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():  # a row for each component
            codebooks[r["part"]][r["entry"], r["k"]] = r["x"] // r["n"]
    return codebooks


def codebooks_digest(codebooks: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def _encoded(codebooks: Codebooks, coding: Coding, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, fits = _matrix(batch, size)
            codes, error = _assigned(codebooks, coding.levels, vectors)
            code, far = np.full(len(fits), None, object), np.zeros(len(fits), np.int64)
            code[fits] = [bytes(c) for c in codes.astype(np.uint8)]
            far[fits] = error
            batch = batch.drop_columns(["v"]).append_column("code", pa.array(code, pa.binary()))
            yield batch.append_column("error", pa.array(far, pa.int64(), mask=~fits))

    return run


def compressed(embeddings: DataFrame, coding: Coding = Coding()) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error, label_error) for each row of ``embeddings`` (vec_id,
    embedding, label), and the codebooks: code has a byte for each part, error is the
    squared distance to the coded vector, label_error its sum over the rows of a label.

    Rows whose vector is null or holds a null or a component that is not finite are
    dropped.  Rows without an id are coded and count in the means, but no codebook starts
    from them; rows of one id start one each, in the order of their vectors, and repeated
    rows count one by one.  Null labels are one label.  A vector of another length than
    that of the smallest id has a null code and error.  No rows give no rows, and fewer
    vectors than entries as many entries; further columns are left out.
    Squared distances must fit in 64 bits.
    """
    kept = stored(embeddings.select("vec_id", "label", whole_numbers(F.col("embedding"), coding.scale).alias("v")).where("v is not null"))
    codebooks = train(kept, coding)
    if not codebooks:  # no row with an id
        coded = kept.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    else:
        kinds = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
        coded = kept.mapInArrow(_encoded(codebooks, coding, sum(c.shape[1] for c in codebooks)), kinds + ", code binary, error long")
    coded = stored(coded)
    (of,) = free_names(coded, "of")
    sums = coded.groupBy(F.col("label").alias(of)).agg(F.sum("error").alias("label_error"))
    side = F.broadcast(sums) if small_enough(sums, BROADCAST_LABELS) else sums
    out = coded.join(side, column(coded, "label").eqNullSafe(F.col(of)))
    return out.select("vec_id", "label", "code", "error", "label_error"), codebooks


def coded_embeddings(embeddings: DataFrame) -> DataFrame:
    """``compressed`` with codes in hexadecimal and the codebooks' digest."""
    out, codebooks = compressed(embeddings)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))

"""Token ids in files of fixed-width packed bits.

A file is a run of segments, each followed by one line feed.  A segment holds, little
endian: ``SLTP``; bits per id and version (u16 each); documents and blocks (u32 each);
ids (u64); then the documents' ids (i64), their null flags (u8) and lengths in ids
(u32); the byte offset of every block in the data (u64); and the data, blocks of
``BLOCK_IDS`` ids of which each takes ``bits`` bits, lowest bit first.  Any id is
found from its block's offset, and a block unpacks with a few numpy calls.

Texts are encoded where they are read; what is dealt out by ranges of doc_id and sorted
are their ids.  Files are written and read through Spark's own
file formats, so they may lie in any store Spark reaches, and the commit of each task
is atomic.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import give_back, partitions, shared_dir, stored, write
from sluice.llm.tokens import slices, worker_encoder

MAGIC, HEAD, BLOCK_IDS = b"SLTP", struct.Struct("<4sHHIIQ"), 4096
SEGMENT_IDS = 2_000_000
#: Bytes of text behind one file.
FILE_TEXT_BYTES = 128_000_000
MOST_FILES_BROADCAST = 100_000


def _shares(bits: int) -> Iterator[tuple[int, int, int]]:
    """(id, byte, shift): eight ids take ``bits`` bytes; which ids lie in which of them, and
    by how many bits the byte begins later than the id."""
    for k in range(8):
        for j in range(k * bits // 8, (k * bits + bits - 1) // 8 + 1):
            yield k, j, 8 * j - k * bits


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Each id in ``bits`` bits, lowest first, filled up to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    eights = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    eights.ravel()[: len(ids)] = ids
    out = np.zeros((len(eights), bits), np.uint8)
    for k, j, shift in _shares(bits):
        out[:, j] |= (eights[:, k] >> np.uint64(shift) if shift >= 0 else eights[:, k] << np.uint64(-shift)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack_bits(data: bytes | memoryview, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    packed = np.zeros((-(-count // 8), bits), np.uint8)
    packed.ravel()[: len(data)] = np.frombuffer(data, np.uint8)
    eights = np.zeros((len(packed), 8), np.uint64)
    for k, j, shift in _shares(bits):
        byte = packed[:, j].astype(np.uint64)
        eights[:, k] |= byte << np.uint64(shift) if shift >= 0 else byte >> np.uint64(-shift)
    return (eights.ravel()[:count] & np.uint64((1 << bits) - 1)).astype(np.uint32)


def segment(doc_ids: list[int | None], ids: list[np.ndarray], bits: int) -> bytes:
    """One segment of the documents' ids."""
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    if len(flat) and int(flat.max()) >> bits:
        raise ValueError(f"an id does not fit into {bits} bits")
    packed = [pack_bits(flat[i : i + BLOCK_IDS], bits) for i in range(0, len(flat), BLOCK_IDS)]
    offsets = np.cumsum([0, *map(len, packed)])[:-1] if packed else np.empty(0)
    return b"".join((
        HEAD.pack(MAGIC, bits, 1, len(ids), len(packed), len(flat)),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array(list(map(len, ids)), "<u4").tobytes(),
        offsets.astype("<u8").tobytes(),
        *packed,
    ))


class Segment:
    """A segment that begins at ``at`` of ``content``."""

    def __init__(self, content: bytes | memoryview, at: int = 0):
        self._view = view = memoryview(content)
        magic, self.bits, version, docs, n_blocks, self.n_ids = HEAD.unpack_from(view, at)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token segment")
        at += HEAD.size
        self.doc_ids = np.frombuffer(view, "<i8", docs, at)
        self.null_ids = np.frombuffer(view, np.uint8, docs, at + 8 * docs).astype(bool)
        self.lengths = np.frombuffer(view, "<u4", docs, at + 9 * docs)
        self._offsets = np.frombuffer(view, "<u8", n_blocks, at + 13 * docs)
        self._data = at + 13 * docs + 8 * n_blocks
        last = self.n_ids - (n_blocks - 1) * BLOCK_IDS if n_blocks else 0
        self.end = self._data + (int(self._offsets[-1]) + -(-last * self.bits // 8) if n_blocks else 0)

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids ``first`` to before ``last``; only their blocks are unpacked."""
        last = self.n_ids if last is None else min(last, self.n_ids)
        if first >= last:
            return np.empty(0, np.uint32)
        out = []
        for b in range(first // BLOCK_IDS, (last - 1) // BLOCK_IDS + 1):
            begin = self._data + int(self._offsets[b])
            count = min(BLOCK_IDS, self.n_ids - b * BLOCK_IDS)
            out.append(unpack_bits(self._view[begin : begin + -(-count * self.bits // 8)], count, self.bits))
        shift = first // BLOCK_IDS * BLOCK_IDS
        return np.concatenate(out)[first - shift : last - shift]


def segments(content: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(content):
        s = Segment(content, at)
        yield s
        at = s.end + 1


def _kind(bits: int) -> str:
    """The whole bytes in which ids of so many bits travel."""
    return "<u2" if bits <= 16 else "<u4"


def _encode_partition(path: str, end_id: int, kind: str, bounds: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = worker_encoder(path), np.dtype(kind).itemsize
        for batch in batches:
            for rows in slices(batch):
                flat, n = encoder.encode_flat(rows.column("text"))
                data = np.insert(flat.astype(kind), np.cumsum(n), end_id)  # an end behind each text
                past = np.concatenate(([0], np.cumsum(n + 1) * size)).astype(np.int64)
                ids = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(past), pa.py_buffer(data)])
                keys = zip(rows.column("doc_id").to_pylist(), rows.column("rid").to_pylist(), strict=True)
                file = [bisect_right(bounds, _order(d, r)) for d, r in keys]
                yield pa.RecordBatch.from_arrays([pa.array(file, pa.int32()), rows.column("doc_id"), rows.column("rid"), pa.array(n + 1), ids.cast(pa.binary())], ["file", "doc_id", "rid", "n", "ids"])
        give_back()

    return run


def _order(doc_id: int | None, rid: int) -> tuple[int, int, int]:
    return (0, 0, rid) if doc_id is None else (1, doc_id, rid)


def _bounds(rows: DataFrame, n: int) -> list[tuple]:
    """Where the second and each later of ``n`` ranges of (doc_id, rid) begins."""
    ranges = rows.select("doc_id", "rid").repartitionByRange(n, "doc_id", "rid").select(F.spark_partition_id().alias("k"), F.struct(F.col("doc_id").isNotNull().alias("there"), "doc_id", "rid").alias("at"))
    found = ranges.groupBy("k").agg(F.min("at").alias("at")).collect()  # n rows
    return sorted(_order(r["at"]["doc_id"], r["at"]["rid"]) for r in found)[1:]


def _pack_partition(bits: int, kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        doc_ids, ids, size = [], [], 0
        for pdf in batches:
            for d, null, x in zip(pdf["doc_id"], pdf["doc_id"].isna(), pdf["ids"], strict=True):
                doc_ids.append(None if null else int(d))
                ids.append(np.frombuffer(x, kind))
                size += len(ids[-1])
                if size >= SEGMENT_IDS:
                    yield pd.DataFrame({"segment": [segment(doc_ids, ids, bits)]})
                    doc_ids, ids, size = [], [], 0
        if ids:
            yield pd.DataFrame({"segment": [segment(doc_ids, ids, bits)]})

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, bits: int | None = None) -> None:
    """Write the ids of ``docs`` (doc_id, text) to new files under ``path``, by ascending
    doc_id (nulls first), each document's followed by ``end_id``.

    ``bits`` is by default the least that holds every id of the vocabulary.  A null
    text is empty; repeated doc_ids lie next to each other.  The rows are dealt by
    ranges of doc_id and, within one doc_id, of their place in the input, so that a
    doc_id with very many rows is spread over several files.  A very long text is a
    row of its own in its block; its ids go into one segment.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("rid"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(partitions(spark), -(-total // FILE_TEXT_BYTES))
    largest = max(worker_encoder(tokenizer).vocabulary_size, end_id + 1) - 1
    width, kind = bits or largest.bit_length(), _kind(largest.bit_length())
    encode = _encode_partition(tokenizer, end_id, kind, _bounds(rows, n))
    encoded = rows.mapInArrow(encode, "file int, doc_id long, rid long, n long, ids binary")
    sorted_ = encoded.repartitionById(n, "file").sortWithinPartitions("doc_id", "rid")
    packed = sorted_.select("doc_id", "ids").mapInPandas(_pack_partition(width, kind), "segment binary")
    write(packed.select(F.col("segment").cast("string")).write.format("text"), path)


def _read_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            file, first = int(re.search(r"part-(\d+)[^/]*$", path)[1]), 0
            for s in segments(content):
                ids, ends = s.ids().astype("<u4"), np.cumsum(s.lengths, dtype=np.int64)
                starts = ends - s.lengths
                doc_id = pd.array(s.doc_ids, "Int64")
                doc_id[s.null_ids] = pd.NA
                yield pd.DataFrame({
                    "file": file, "doc_id": doc_id, "in_file": first + starts, "n_tokens": s.lengths.astype(np.int64),
                    "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)],
                })
                first += s.n_ids


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file) of every document in the files:
    ``start`` counts the ids of all documents before it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    rows = stored(files.mapInPandas(_read_partition, "file int, doc_id long, in_file long, n_tokens long, ids_crc32 long"))
    # one row a file, so the running sum has as many rows as there are files
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))
    if sums.count() <= MOST_FILES_BROADCAST:
        before = F.broadcast(before)
    return rows.join(before, "file").select("doc_id", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32", "file")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, bits: int | None = None) -> DataFrame:
    """Write token files (by default in the shared folder) and list what they hold.
    Further columns are left out; no rows give no rows."""
    path = path or shared_dir(docs.sparkSession)
    write_token_files(docs, path, tokenizer, end_id, bits)
    return read_token_files(docs.sparkSession, path)

"""A Merkle manifest of a table in an external-memory node store.

1. Every row becomes a leaf digest, where it is read.  Leaves are stored in sorted runs:
   dealt out by ranges of (tree, row id) and sorted within; a leaf's coordinate is its
   tree and its place there, from the runs' lengths.
2. Levels stream out of the sorted leaves six at a time: nodes lie in units of 3**6
   consecutive ones, a task reads its units in order and writes the six levels above
   into Parquet that is partitioned by level; the last of these is the next job's input.
3. The roots of the trees are the leaves of a tree of their own, built alike.
4. Proofs come out from the top down: a scan merges the levels of a unit, sorted by
   coordinate, with the proof of the unit's own root, and gives each of its lowest
   nodes the siblings on its way up.

No task holds more than a unit of a tree, so one tree may hold most rows.  The driver
gets the length of each run (there are ``spark.sql.shuffle.partitions`` of them) and the
root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.llm.common import column, discard, free_names, partitions, shared_dir, small_enough, stored, write

FANOUT, LEVELS = 3, 6
UNIT = FANOUT**LEVELS
#: Trees up to which their numbers are broadcast to the leaves.
BROADCAST_TREES = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "level int, tree long, pos long, digest binary"


def row_digest(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields, each as byte count, colon and value, or a
    hyphen for null, so that no two rows give the same input."""
    spelt = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in spelt]), 256)


def _parent(digests: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``rank``, their place from 0 in ``order`` (nulls first), stored in
    sorted runs.  Ties stand in any order."""
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    runs = stored(rows.repartitionByRange(partitions(rows.sparkSession), *order, "tie").sortWithinPartitions(*order, "tie").drop("tie").withColumn("at", F.monotonically_increasing_id()))
    run = F.shiftright("at", 33)
    lengths = {r["run"]: r["n"] for r in runs.groupBy(run.alias("run")).agg(F.count("*").alias("n")).collect()}  # a row for each run
    starts, past = [], 0
    for r in sorted(lengths):
        starts.append((r, past))
        past += lengths[r]
    firsts = rows.sparkSession.createDataFrame(starts, "run long, start long")
    placed = runs.join(F.broadcast(firsts), run == F.col("run"))  # as many rows as runs
    return placed.withColumn("rank", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("run", "start", "at")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that lie in order of (tree, unit), as tables of whole units with the first row
    of each and the end."""
    held: list[pa.Table] = []

    def edges(rows: pa.Table) -> np.ndarray:
        tree, unit = numbers(rows, "tree"), numbers(rows, "unit")
        return np.flatnonzero(np.concatenate(([True], (tree[1:] != tree[:-1]) | (unit[1:] != unit[:-1]))))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.concat_tables([*held, pa.Table.from_batches([batch])]).combine_chunks()
        at = edges(rows)
        if at[-1]:
            yield rows[: at[-1]], at
        held = [rows[at[-1] :]]
    if held:
        yield held[0], np.append(edges(held[0]), held[0].num_rows)


def numbers(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _sent(kinds: str, rows: list[tuple], **more: pa.Array) -> Iterator[pa.RecordBatch]:
    """``rows`` of the ``kinds`` (names with Arrow types), and columns beside them."""
    kind = dict(k.split() for k in kinds.split(", "))
    columns = list(zip(*rows, strict=True)) or [()] * len(kind)
    made = {n: pa.array(c, getattr(pa, t)()) for (n, t), c in zip(kind.items(), columns, strict=True)}
    yield from pa.table(made | more).combine_chunks().to_batches()


def _fold(base: int):
    """The levels above ``base`` of each unit, up to the root of its tree or the unit's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in _units(batches):
            rows: list[tuple[int, int, int, bytes]] = []
            tree, unit, digests = numbers(table, "tree"), numbers(table, "unit"), table.column("digest").to_pylist()
            for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                nodes, alone = digests[s:e], unit[s] == 0 and e - s < UNIT
                for level in range(1, LEVELS + 1):
                    if alone and len(nodes) == 1:
                        break
                    nodes = [_parent(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
                    first = int(unit[s]) * FANOUT ** (LEVELS - level)
                    rows += [(base + level, int(tree[s]), first + i, d) for i, d in enumerate(nodes)]
            yield from _sent("level int32, tree int64, pos int64, digest binary", rows)

    return run


def _in_units(nodes: DataFrame) -> DataFrame:
    """Each unit in one task, its nodes by level and place."""
    return nodes.repartition("tree", "unit").sortWithinPartitions("tree", "unit", "level", "pos")


def _unit(base: int) -> Column:
    """Of a node at a level from ``base`` on."""
    inside = F.element_at(F.array(*[F.lit(FANOUT ** (LEVELS - k)) for k in range(LEVELS)]), F.col("level") - base + 1)
    return F.floor(F.col("pos") / inside).alias("unit")


class NodeStore:
    """Trees over ``leaves`` (tree, pos, digest), a stored table: the nodes above them lie
    in ``path``, partitioned by level."""

    def __init__(self, leaves: DataFrame):
        self.spark, self.leaves = leaves.sparkSession, leaves
        self.path = shared_dir(self.spark)
        self.jobs = 0
        while True:
            base = self.jobs * LEVELS
            units = _in_units(self.level(base).select("level", "tree", "pos", "digest", _unit(base)))
            write(units.mapInArrow(_fold(base), _NODE).write.partitionBy("level").format("parquet").mode("append"), self.path)
            self.jobs += 1
            if not self.level(base + LEVELS).where("pos > 0").limit(1).count():
                break

    def nodes(self) -> DataFrame:
        """All nodes above the leaves."""
        return self.spark.read.schema(_NODE).parquet(self.path)

    def level(self, number: int) -> DataFrame:
        if number == 0:
            return self.leaves.select(F.lit(0).alias("level"), "tree", "pos", "digest")
        return self.nodes().where(F.col("level") == number)

    def roots(self) -> DataFrame:
        """(tree, height, digest) of each tree; a lone leaf is its tree's root."""
        firsts = self.level(0).where("pos = 0").union(self.nodes().where("pos = 0").select("level", "tree", "pos", "digest"))
        return firsts.groupBy("tree").agg(F.max("level").alias("height"), F.max_by("digest", "level").alias("digest"))

    def proofs(self, above: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """(tree, pos, digest, path, subroot) of each leaf, and its columns ``carry``: path
        has, per level, from the leaf up, a byte for the node's place in its run, one for
        the number of its siblings, and their digests; then what ``above`` (tree, height,
        path, subroot) holds for the root of the tree, as it does subroot."""
        paths = None
        for k in reversed(range(self.jobs + 1)):
            base = k * LEVELS
            ends = above.where(F.col("height").between(base, base + LEVELS - 1)).select("tree", F.lit(0).cast("long").alias("unit"), "path", "subroot")
            if paths is not None:
                ends = ends.union(paths.select("tree", F.col("pos").alias("unit"), "path", "subroot"))
            ends = ends.select("tree", "unit", F.lit(base + LEVELS).alias("level"), F.lit(0).cast("long").alias("pos"), F.col("subroot").alias("digest"), "path")
            own = [] if k else list(carry)
            low = self.level(base) if k else self.leaves.withColumn("level", F.lit(0))
            inner = self.nodes().where(F.col("level").between(base + 1, base + LEVELS - 1))
            rows = low.select("tree", _unit(base), "level", "pos", "digest", *own).unionByName(inner.select("tree", _unit(base), "level", "pos", "digest"), True)
            kinds = "".join(f", `{c}` {self.leaves.schema[c].dataType.simpleString()}" for c in own)
            paths = _in_units(rows.unionByName(ends, True)).mapInArrow(_descend(base, own), "tree long, pos long, digest binary, path binary, subroot binary" + kinds)
        return paths


def _descend(base: int, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in _units(batches):
            out: list[tuple[int, int, bytes, bytes, bytes]] = []
            kept: list[np.ndarray] = [np.empty(0, np.int64)]
            tree, unit, level, pos = (numbers(table, c) for c in ("tree", "unit", "level", "pos"))
            digests, ends = table.column("digest").to_pylist(), table.column("path").to_pylist()
            for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                cut = (s + np.searchsorted(level[s:e], np.arange(base, base + LEVELS + 1))).tolist()
                alone = unit[s] == 0 and cut[1] - cut[0] < UNIT
                height = next((k for k in range(LEVELS) if alone and cut[k + 1] - cut[k] == 1), LEVELS)
                ways: list[bytes] = [ends[e - 1]]  # of the nodes of the level above
                for k in reversed(range(height)):
                    nodes = digests[cut[k] : cut[k + 1]]
                    now = []
                    for i, up in enumerate(ways):
                        group = nodes[i * FANOUT : (i + 1) * FANOUT]
                        for j in range(len(group)):
                            others = group[:j] + group[j + 1 :]
                            now.append(bytes((j, len(others))) + b"".join(others) + up)
                    ways = now
                low, high = cut[0], cut[1]
                kept.append(np.arange(low, high))
                out += zip([int(tree[s])] * (high - low), pos[low:high].tolist(), digests[low:high], ways, [digests[e - 1]] * (high - low), strict=True)
            rows = np.concatenate(kept)
            yield from _sent("tree int64, pos int64, digest binary, path binary, subroot binary", out, **{c: table.column(c).take(pa.array(rows)) for c in carry})

    return run


def path_levels(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Place in the run and siblings, for each level of a proof from the leaf up."""
    i = 0
    while i < len(path):
        place, n = path[i], path[i + 1]
        yield place, [path[i + 2 + 32 * k : i + 34 + 32 * k] for k in range(n)]
        i += 2 + 32 * n


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    for place, others in path_levels(path):
        digest = _parent([*others[:place], digest, *others[place:]])
    return digest


def _check(offered: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, digests, paths = (batch.column(c).to_pylist() for c in (offered, "digest", "path"))
            siblings = [b"".join(d for _, others in path_levels(p) for d in others) for p in paths]
            hashed = [hashlib.sha256(s.hex().encode()).hexdigest() for s in siblings]
            roots = [folded(bytes.fromhex(t) if t else d, p).hex() for t, d, p in zip(given, digests, paths, strict=True)]
            yield batch.append_column("proof_sha256", pa.array(hashed, pa.string())).append_column("folded_root", pa.array(roots, pa.string()))

    return run


def manifest(rows: DataFrame, tree: str = "source", order: str = "doc_id", fields: Sequence[str] = FIELDS, offered: Column | None = None) -> DataFrame:
    """The Merkle manifest of ``rows``: one tree for each value of column ``tree``, its
    leaves by ``order``, and one over the trees' roots, by ``tree`` (nulls first).

    Returns a row for each of ``rows``: its ``order`` and ``tree`` columns, leaf, subroot,
    root (hex), proof (binary, as ``NodeStore.proofs`` has it), proof_sha256, folded_root
    and verified: whether the leaf digest that ``offered`` gives (hex; null: the row's
    own) leads to the root with the original siblings.

    Nulls stand for themselves in every field, null ids come first in their tree; rows of
    equal ids follow by leaf digest, and equal rows are leaves side by side.  A very long
    text is hashed whole; no rows give no rows.  Columns that are not named are left
    out, whatever their names.
    """
    part, at, leaf_, given = free_names(rows, "part", "at", "leaf", "given")
    leaves = rows.select(column(rows, tree).alias(part), column(rows, order).alias(at), row_digest([column(rows, f) for f in fields]).alias(leaf_), (F.lit(None).cast("string") if offered is None else offered).alias(given))
    first = stored(leaves)  # hashed once
    placed = ranked(first, part, at, leaf_)
    trees = placed.groupBy(part).agg(F.min("rank").alias("tree"))
    trees = stored(ranked(trees.withColumn("first", F.col("tree")), "first").select(F.col(part).alias("of"), "tree", "rank"))
    side = F.broadcast(trees) if small_enough(trees, BROADCAST_TREES) else trees
    placed = stored(placed.join(side.select("of", "tree"), F.col(part).eqNullSafe(F.col("of"))).select("tree", (F.col("rank") - F.col("tree")).alias("pos"), F.unhex(leaf_).alias("digest"), part, at, given))
    discard(first)
    store = NodeStore(placed)
    roots = stored(store.roots().join(trees.select("tree", "rank"), "tree"))
    top = NodeStore(stored(roots.select(F.lit(-1).cast("long").alias("tree"), F.col("rank").alias("pos"), "digest")))
    summit = top.roots().first()
    if summit is None:
        summit = {"height": 0, "digest": b""}
    start = rows.sparkSession.createDataFrame([(-1, summit["height"], bytearray(), bytearray())], "tree long, height int, path binary, subroot binary")
    joined = top.proofs(start).select("pos", "path").join(roots.select("tree", "height", F.col("rank").alias("pos"), F.col("digest").alias("subroot")), "pos")
    proofs = store.proofs(stored(joined), [part, at, given])
    checked = proofs.mapInArrow(_check(given), StructType([*proofs.schema, StructField("proof_sha256", StringType()), StructField("folded_root", StringType())]))
    root = F.lit(bytes(summit["digest"]).hex())
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return checked.withColumnRenamed("digest", "leaf").select(F.col(at).alias(order), F.col(part).alias(tree), hexed("leaf"), hexed("subroot"), root.alias("root"), F.col("path").alias("proof"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """``manifest`` of ``docs`` where every row whose crc32 of its decimal doc_id is even
    is offered with its text's line feeds deleted; null ids and texts are offered as
    they are."""
    changed = row_digest([F.replace(F.col(f), F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in FIELDS])
    even = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    return manifest(docs, offered=F.when(even, changed))

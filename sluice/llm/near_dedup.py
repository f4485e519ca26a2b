"""MinHash near-duplicates with odd sketches.

1. One pass over the texts makes, for every document, the set of its word shingles
   and from it the set's size, 180 MinHash values as 36 band keys of 5 values each,
   and two parity bitmaps: one into which the MinHash samples are folded, and one
   into which the whole set is folded.
2. Documents with the same words are one node.  Nodes that share a band key meet in
   a bucket; large buckets are dealt out as pairs of blocks of bounded size.
3. In a block two nodes are a candidate if the XOR of their bitmaps allows it: the
   population count over the MinHash samples estimates the similarity (a pair is
   put aside only if it is six standard deviations below the threshold), and that
   over the whole sets never exceeds the true difference of the sets, so what it
   rules out is certain.
4. The first round, in which large buckets contract towards their first block, sends on a
   spanning forest of each block's candidates; these are confirmed on the full sets.  The
   second round sends on every candidate whose two ends the first has not connected, so
   no link between components is lost.
5. To be confirmed, nodes are dealt into groups and candidates into pairs of groups: a
   node's full set goes once to each such pair, however many candidates it has there.

A pair at a threshold of 0.8 misses all 36 bands with probability 6e-7; at 0.85, 30
bands of 6 values do as well with fewer keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, free_names, give_back, stored, text_digest
from sluice.llm.graph import connected_components
from sluice.llm.tokens import blocks

BLOCK = 512
#: Candidates confirmed in one group, about.
CONFIRM = 1000
#: Buckets of up to so many nodes send on all their candidates, larger ones a forest.
SMALL = 8


@dataclass(frozen=True)
class NearDup:
    """``shingle`` words make a shingle; two texts are linked if
    100 * intersection >= percent * union."""

    shingle: int = 5
    percent: int = 80
    bands: int = 36
    rows: int = 5
    sample_bits: int = 512
    set_bits: int = 1024


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    Words are maximal runs without ASCII white space, A-Z in lower case.  A text of
    fewer words than a shingle has one, its whole sequence; one without words none.
    """

    def __init__(self, n: int):
        self._n = n
        rng = np.random.default_rng(11)
        self._odd = _odd(rng, n)
        values = rng.integers(0, 2**63, size=256, dtype=np.uint64)
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
        self._values = values
        self._inside = np.ones(258, bool)
        self._inside[[*range(9, 14), 32]] = False
        self._base = _odd(rng, 1)[0]
        self._inverse = np.uint64(pow(int(self._base), -1, 2**64))
        self._grow(1 << 14)

    def _grow(self, n: int) -> None:
        self._up, self._down = (np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, x)))) for x in (self._base, self._inverse))

    def words(self, text: str | None) -> np.ndarray:
        """A hash of each word: its letters' values as a polynomial modulo 2**64, taken
        from running sums over the text and then mixed."""
        data = np.frombuffer((text or "").encode(), np.uint8)
        if len(data) >= len(self._up):
            self._grow(2 * len(data))
        inside = self._inside[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        first, past = edge[::2], edge[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self._values[data] * self._up[: len(data)], dtype=np.uint64)))
        return mixed((sums[past] - sums[first]) * self._down[first] + (past - first).astype(np.uint64))

    def shingles(self, h: np.ndarray) -> np.ndarray:
        n = min(self._n, len(h))
        if not n:
            return h
        out = np.full(len(h) - n + 1, len(h) < self._n, np.uint64)
        for k in range(n):
            out = mixed((out ^ h[k : len(h) - n + 1 + k]) * self._odd[k])
        return np.unique(out)


def _odd(rng: np.random.Generator, n: int) -> np.ndarray:
    return rng.integers(0, 2**63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketcher:
    def __init__(self, p: NearDup):
        self.p = p
        rng = np.random.default_rng(7)
        self.k = p.bands * p.rows
        self.a = rng.integers(0, 2**32, size=self.k, dtype=np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 2**32, size=self.k, dtype=np.uint32) | np.uint32(1)
        self.salt = rng.integers(0, 2**63, size=self.k, dtype=np.uint64)
        self.band_odd, self.band_salt = _odd(rng, p.rows), _odd(rng, p.bands)

    def samples(self, s: np.ndarray) -> np.ndarray:
        """The least value of each of the hash functions over the set."""
        x, y = s.astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32)
        out = np.empty(self.k, np.uint32)
        step = max(1, 30_000 // len(s))
        for i in range(0, self.k, step):
            z = x[None, :] * self.a[i : i + step, None]
            z += y[None, :] * self.b[i : i + step, None]
            out[i : i + step] = z.min(axis=1)
        return out

    def bands(self, samples: np.ndarray) -> np.ndarray:
        v = samples.reshape(self.p.bands, self.p.rows).astype(np.uint64)
        return mixed((v * self.band_odd).sum(axis=1, dtype=np.uint64) ^ self.band_salt).view(np.int64)

    def parity(self, members: np.ndarray, bits: int) -> bytes:
        """Bitmap of the positions that an odd number of members fall on."""
        odd = np.bincount((members % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8)).tobytes()

    def sketch(self, s: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
        m = self.samples(s)
        return self.bands(m), self.parity(mixed(m.astype(np.uint64) ^ self.salt), self.p.sample_bits), self.parity(mixed(s), self.p.set_bits)


def _sketch_partition(p: NearDup):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, sketcher = Shingler(p.shingle), Sketcher(p)
        for pdf in batches:
            texts = list(pdf["text"])
            for part in blocks(texts):
                rows = []
                for t in texts[part]:
                    words = shingler.words(t)
                    s = shingler.shingles(words)
                    word_key = hashlib.md5(words.tobytes()).digest()
                    rows.append((word_key, len(s), *(sketcher.sketch(s) if len(s) else (None, None, None))))
                out = pd.DataFrame(rows, columns=["word_key", "n_shingles", "bands", "sample_sketch", "set_sketch"])
                for c in ("rid", "doc_id", "text_key"):
                    out[c] = list(pdf[c][part])
                yield out
        give_back()

    return run


def sketched(docs: DataFrame, p: NearDup) -> DataFrame:
    """One row per document: rid, doc_id, text_key, word_key, n_shingles and sketches."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("text_key"), "text")
    return stored(rows.mapInPandas(_sketch_partition(p), "word_key binary, n_shingles long, bands array<long>, sample_sketch binary, set_sketch binary, rid long, doc_id long, text_key binary"))


def _limits(p: NearDup) -> tuple[float, float]:
    """The share of two sets' sizes that may differ at the threshold, and the most XOR
    bits of the MinHash bitmaps: what six standard deviations below it would leave."""
    j, k, bits = p.percent / 100, p.bands * p.rows, p.sample_bits
    lowest = max(0.0, j - 6 * np.sqrt(j * (1 - j) / k))
    expected = bits / 2 * (1 - np.exp(-4 * k * (1 - lowest) / bits))  # of 2k(1-J) toggled samples
    return (1 - j) / (1 + j), expected + 6 * np.sqrt(expected) / 2


def _similar(limits: tuple[float, float], sizes: np.ndarray, sample: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Whether the XORed bitmaps of each pair allow it to reach the threshold."""
    share, most = limits
    ok = np.bitwise_count(whole).sum(axis=1, dtype=np.int32) <= share * sizes + 1e-6
    return ok & (np.bitwise_count(sample).sum(axis=1, dtype=np.int32) <= most)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the edges (a, b), in their order, first connect two trees."""
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            parent[x], keep[i] = y, True
    return keep


def _pairs_of(sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of rows within groups of consecutive rows, and each pair's group."""
    a, b, g = [], [], []
    for size in np.unique(sizes):
        if size > 1:
            groups = np.flatnonzero(sizes == size)
            x, y = np.triu_indices(size, 1)
            a.append((starts[groups][:, None] + x).ravel())
            b.append((starts[groups][:, None] + y).ravel())
            g.append(np.repeat(groups, len(x)))
    none = [np.empty(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none), np.concatenate(g or none)


class _Group:
    """Columns of rows that lie in order of their groups."""

    def __init__(self, pdf: pd.DataFrame):
        self.nid, self.label, self.n = pdf["nid"].to_numpy(), pdf["label"].to_numpy(), pdf["n_shingles"].to_numpy()
        self.own = pdf["own"].to_numpy()
        self.sample = np.frombuffer(b"".join(pdf["sample_sketch"]), np.uint64).reshape(len(pdf), -1)
        self.whole = np.frombuffer(b"".join(pdf["set_sketch"]), np.uint64).reshape(len(pdf), -1)


def _meet(p: NearDup, forest: bool):
    """All pairs of one block, or of two blocks, of a bucket; out go the candidates
    between labels, as a spanning forest of each larger block in the first round."""
    limits = _limits(p)

    def allowed(g: _Group, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = g.label[a] != g.label[b]
        a, b = a[ok], b[ok]
        good = _similar(limits, g.n[a] + g.n[b], g.sample[a] ^ g.sample[b], g.whole[a] ^ g.whole[b])
        ok[ok] = good
        return ok

    def small(g: _Group, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        a, b, _ = _pairs_of(sizes, starts)
        out = []
        for s in range(0, len(a), 200_000):
            x, y = a[s : s + 200_000], b[s : s + 200_000]
            ok = allowed(g, x, y)
            out.append(np.stack((x[ok], y[ok])))
        return out

    def large(g: _Group, start: int, size: int, i: int, j: int) -> list[np.ndarray]:
        rows = np.arange(start, start + size)
        left, right = rows[g.own[rows] == i], rows[g.own[rows] == j]
        out = []
        for s in range(0, len(left), 128):
            x, y = (z.ravel() for z in np.meshgrid(left[s : s + 128], right, indexing="ij"))
            if i == j:
                x, y = x[x < y], y[x < y]
            ok = allowed(g, x, y)
            out.append(np.stack((x[ok], y[ok])))
        found = np.concatenate(out, axis=1) if out else np.empty((2, 0), np.int64)
        return [found[:, _forest(size, found[0] - start, found[1] - start)]] if forest else [found]

    def whole_groups(pdf: pd.DataFrame) -> pd.DataFrame:
        g = _Group(pdf)
        band, i, j = pdf["band"].to_numpy(), pdf["i"].to_numpy(), pdf["j"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
        sizes = np.diff(starts, append=len(pdf))
        few = (sizes <= SMALL) & (i[starts] == j[starts])
        out = small(g, starts[few], sizes[few])
        for s, n in zip(starts[~few].tolist(), sizes[~few].tolist(), strict=True):
            out += large(g, s, n, i[s], j[s])
        a, b = np.concatenate(out, axis=1) if out else np.empty((2, 0), np.int64)
        a, b = g.nid[a], g.nid[b]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the rows of a group whose end has not come yet
        of: tuple | None = None
        for pdf in batches:
            if not len(pdf):
                continue
            first, last = (tuple(pdf[["band", "i", "j"]].iloc[k]) for k in (0, -1))
            own = np.ones(len(pdf), bool)
            for column, value in zip(("band", "i", "j"), last, strict=True):
                own &= (pdf[column] == value).to_numpy()
            if own.all() and first == of:
                held.append(pdf)
                continue
            done = pd.concat([*held, pdf[~own]], ignore_index=True)
            if len(done):
                yield whole_groups(done)
            held, of = [pdf[own]], last
        if held:
            yield whole_groups(pd.concat(held, ignore_index=True))
        give_back()

    return run


def _candidates(nodes: DataFrame, p: NearDup, labels: DataFrame | None) -> DataFrame:
    """Distinct (a, b) that share a bucket, differ in label and pass the sketches.  In the
    first round, without labels, the blocks of a large bucket meet themselves and the first
    block alone: most of what is alike is connected by that, and buckets that then have one
    label are done."""
    keys = nodes.select("nid", F.explode("bands").alias("band"))
    if labels is None:
        keys = keys.withColumn("label", F.col("nid"))
    else:
        keys = keys.join(labels, keys["nid"] == labels["node"], "left").select("nid", "band", F.coalesce("root", "nid").alias("label"))
    open_ = keys.groupBy("band").agg(F.count("*").alias("size"), F.min("label").alias("first"), F.max("label").alias("last")).where("first <> last")
    members = keys.join(open_.select("band", "size"), "band")
    blocks_ = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("nid"), blocks_).cast("int"))
    every, first = F.sequence(F.lit(0), blocks_ - 1), F.array_distinct(F.array(F.lit(0), F.col("own")))
    dealt = dealt.withColumn("other", F.explode(every if labels is not None else F.when(F.col("own") == 0, every).otherwise(first)))
    dealt = dealt.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "nid", "label", "own")
    dealt = dealt.join(nodes.select("nid", "n_shingles", "sample_sketch", "set_sketch"), "nid")
    grouped = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "nid")
    return stored(grouped.mapInPandas(_meet(p, labels is None), "a long, b long").distinct())


def _sets_partition(p: NearDup):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(p.shingle)
        for pdf in batches:
            texts = list(pdf["text"])
            for part in blocks(texts):
                yield pd.DataFrame({"nid": pdf["nid"][part].array, "members": [shingler.shingles(shingler.words(t)).tobytes() for t in texts[part]]})

    return run


def _confirm_group(p: NearDup):
    """Of a group's candidates those whose full sets reach the threshold; one whose ends
    the confirmed ones have connected already is passed over."""

    def run(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        of = {n: np.frombuffer(m, np.uint64) for n, m in zip(sets["nid"], sets["members"], strict=True)}
        parent: dict[int, int] = {}
        keep = []

        def top(x: int) -> int:
            while (y := parent.get(x, x)) != x:
                parent[x] = parent.get(y, y)
                x = y
            return x

        for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist(), strict=True):
            x, y, good = of[a], of[b], False
            if top(a) != top(b):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good = 100 * both >= p.percent * (len(x) + len(y) - both)
            if good:
                parent[top(a)] = top(b)
            keep.append(good)
        return pairs.loc[np.array(keep, bool), ["a", "b"]]

    return run


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, p: NearDup) -> DataFrame:
    """Of the ``pairs`` those whose full shingle sets reach the threshold, as far as they
    are needed to connect what they connect."""
    ends = pairs.select(F.col("a").alias("nid")).union(pairs.select(F.col("b").alias("nid"))).distinct()
    wanted = nodes.join(ends, "nid").select("nid", F.col("doc_id").alias("id"), F.col("text_key").alias("tk"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_key", text_digest(F.col("text")))
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["id"]) & (rows["text_key"] == wanted["tk"])).select("nid", "text").dropDuplicates(["nid"])
    sets = stored(texts.mapInPandas(_sets_partition(p), "nid long, members binary"))
    groups = max(1, int((2 * pairs.count() / CONFIRM) ** 0.5))
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups)).cast("int")
    dealt = pairs.select("a", "b", group("a").alias("i"), group("b").alias("j"))
    there = pairs.select(F.explode(F.array("a", "b")).alias("nid"), group("a").alias("of_i"), group("b").alias("of_j")).distinct().join(sets, "nid")
    found = stored(dealt.groupBy("i", "j").cogroup(there.groupBy("of_i", "of_j")).applyInPandas(_confirm_group(p), "a long, b long"))
    discard(sets)
    return found


def components(docs: DataFrame, p: NearDup) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) for every row of ``docs``."""
    rows = sketched(docs, p)
    groups = stored(rows.where("n_shingles > 0").groupBy("word_key").agg(F.min("rid").alias("nid"), F.min("doc_id").alias("least")))
    nodes = rows.select("rid", "doc_id", "text_key", "n_shingles", "bands", "sample_sketch", "set_sketch").join(groups.select(F.col("nid").alias("rid"), "least"), "rid").withColumnRenamed("rid", "nid")
    nodes = stored(nodes)
    pairs = _candidates(nodes, p, None)
    first = _confirmed(pairs, nodes, docs, p)
    discard(pairs)
    labels = connected_components(first)
    pairs = _candidates(nodes, p, labels)
    second = _confirmed(pairs, nodes, docs, p)
    discard(pairs)
    if second.limit(1).count():
        labels = connected_components(first.union(second))
    discard(first, second)
    ids = nodes.select("nid", "least").join(labels, F.col("nid") == F.col("node"), "left").select("nid", "least", F.coalesce("root", "nid").alias("root"))
    component = ids.groupBy("root").agg(F.min("least").alias("component"))
    by_node = ids.join(component, "root").select("nid", "component")
    by_words = groups.join(by_node, "nid").select("word_key", "component")
    out = rows.select("doc_id", "text_key", "n_shingles", "word_key").join(by_words, "word_key", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", component_id.alias("component_id"), F.col("doc_id").eqNullSafe(component_id).alias("kept"))


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Links join texts whose shingle sets reach ``p.percent``; the component's id is
    its smallest doc_id and the document of that id is kept.  Null or wordless
    texts have no shingles, are linked with nothing and stand alone.  Rows that
    repeat a doc_id count one by one; where rows of the smallest doc_id of a
    component repeat, all of them are marked as kept.  A null doc_id is never the
    smallest unless its component has no other, and is then kept.  No rows give no
    rows, further columns are left out, and a very long text is sketched and confirmed
    whole.
    """
    return components(docs, p).drop("text_key")


def near_dedup_stage(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """The rows of ``docs`` whose document ``near_duplicates`` keeps, with all their
    columns, whatever their names; a row is told by its doc_id and text, so repeats of a
    kept row stay, and nulls, empty and very long texts count as they do there."""
    id_, key = free_names(docs, "id", "key")
    drop = components(docs, p).where("not kept").select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct()
    return docs.join(drop, docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (text_digest(docs["text"]).eqNullSafe(F.col(key))), "left_anti")

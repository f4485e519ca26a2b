"""Exact joins of documents by the Jaccard similarity of their word n-grams, as searches
for what occurs at least T times in inverted lists (DivideSkip).

A set x of n shingles can only be linked with sets that hold T = ceil(t * n) of them.

1. Where texts are read, each gives the shingles that come first by their hash:
   n - T of them and some more.  Two sets that are linked have those more in common
   there, so a text of which too few are held by any other set is done.
2. The full sets of the others, one text of each set, are counted: a shingle that no
   other of them holds cannot be part of an overlap, and a set with too many of those is
   done, too.  The rest have their other shingles in order from the rarest on.
3. The n - T + 1 rarest shingles of a set are its short lists.  Linked sets share one of
   theirs, so sets that are connected through short lists meet in a task; where these are
   too many for one, they are dealt into blocks and blocks meet in pairs.
4. There each set is searched in an index of the others: the longest lists are put aside,
   the others are merged, what occurs in them often enough is probed in the long ones by
   binary search, and what reaches the threshold is a link.  A candidate that the links
   so far have connected with the set already is passed over.
5. Blocks meet first with themselves and with the first block.  Other pairs of blocks
   follow only where sets of a group are still in different components.

Counts travel packed: a block of texts sends each bucket of hashes its own, once, and
gets back those that other sets hold, so a very frequent shingle is one entry a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, give_back, small_enough, stored, text_digest
from sluice.llm.graph import connected_components
from sluice.llm.near_dedup import Shingler
from sluice.llm.tokens import blocks

#: Bytes of text for each bucket of hashes, about, and the fewest buckets.
BUCKET, LEAST_BUCKETS = 8_000_000, 256
#: Sets up to which their keys are broadcast to the texts (about 60 bytes each).
BROADCAST_SETS = 200_000
#: Sets, and shingles of them, in a block of a group, about.
MEMBERS, SHINGLES = 1000, 1_000_000


@dataclass(frozen=True)
class Join:
    """``shingle`` words make a shingle; two texts are linked if
    100 * intersection >= percent * union."""

    shingle: int = 4
    percent: int = 85

    def least(self, n):
        """T: how many of its n shingles a set must share with whatever it is linked with."""
        return -(-self.percent * n // 100)

    def more(self, n):
        """How many shingles linked sets share among the first by hash, the smaller of both
        having n."""
        return 1 + n // 20


def _blocks_of(texts: list[str | None], shingler: Shingler) -> Iterator[tuple[slice, list[np.ndarray], list[bytes]]]:
    """Sets of shingles and their digests, a block of texts at a time."""
    for part in blocks(texts):
        sets = [shingler.shingles(shingler.words(t)) for t in texts[part]]
        yield part, sets, [hashlib.md5(s.tobytes()).digest() for s in sets]


def _packed(sets: list[np.ndarray]) -> dict:
    return {"hashes": np.concatenate([*sets, np.empty(0, np.uint64)]).tobytes(), "lengths": np.array([len(s) for s in sets], np.int64).tobytes()}


def _sampled(p: Join):
    """Rows of two kinds: a text with its block and place, and a block with the first
    shingles of each of its distinct sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, block = Shingler(p.shingle), TaskContext.get().partitionId() << 32
        for pdf in batches:
            texts = list(pdf["text"])
            for part, sets, keys in _blocks_of(texts, shingler):
                place: dict[bytes, int] = {}
                at = [place.setdefault(k, len(place)) for k in keys]
                sizes = [len(s) for s in sets]
                firsts = {i: s[: min(len(s), len(s) - p.least(len(s)) + p.more(len(s)))] for s, i in zip(sets, at, strict=True)}
                none = [None] * len(sets)
                yield pd.DataFrame({"block": block, "doc_id": pdf["doc_id"][part].array, "text_key": pdf["text_key"][part].array, "set_key": keys, "place": at, "n": sizes, "hashes": none, "lengths": none})
                sample = _packed([firsts[i] for i in range(len(firsts))])
                yield pd.DataFrame([{"block": block, "doc_id": None, "text_key": None, "set_key": None, "place": None, "n": None} | sample])
                block += 1
        give_back()

    return run


def _sent(buckets: int):
    """A block's hashes and how many of its sets hold each, cut by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block, hashes in zip(pdf["block"], pdf["hashes"], strict=True):
                h, n = np.unique(np.frombuffer(hashes, np.uint64), return_counts=True)
                bucket = (h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                first = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), bucket[1:] != bucket[:-1])))
                past = np.append(first[1:], len(h))[: len(first)]  # none of a block without shingles
                n = n.astype(np.int32)
                yield pd.DataFrame({"block": block, "bucket": bucket[first].astype(np.int32), "hashes": [h[s:e].tobytes() for s, e in zip(first, past, strict=True)], "counts": [n[s:e].tobytes() for s, e in zip(first, past, strict=True)]})
        give_back()

    return run


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each block of a bucket those of its hashes that several sets hold, and how many."""
    sizes = np.array([len(h) // 8 for h in pdf["hashes"]])
    h, inverse = np.unique(np.frombuffer(b"".join(pdf["hashes"]), np.uint64), return_inverse=True)
    total = np.bincount(inverse, np.frombuffer(b"".join(pdf["counts"]), np.int32)).astype(np.int64)
    each, out = total[inverse], []
    for block, e, size in zip(pdf["block"], np.cumsum(sizes), sizes, strict=True):
        held = slice(e - size, e)
        shared = each[held] > 1
        if shared.any():
            out.append((block, h[inverse[held]][shared].tobytes(), each[held][shared].tobytes()))
    return pd.DataFrame(out, columns=["block", "shared", "counts"])


def _shared(rows: DataFrame, buckets: int) -> DataFrame:
    """(block, shared, counts) of the blocks in ``rows`` (block, hashes): their hashes that
    more than one set holds, with the number of those sets."""
    sent = rows.mapInPandas(_sent(buckets), "block long, bucket int, hashes binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(_counted, "block long, shared binary, counts binary")


class _Block:
    """A block's sets, and what ``_shared`` has sent back for it."""

    def __init__(self, hashes: bytes, lengths: bytes, shared: pd.DataFrame):
        h, n = np.frombuffer(hashes, np.uint64), np.frombuffer(lengths, np.int64)
        known = np.frombuffer(b"".join(shared["shared"]), np.uint64)
        counts = np.frombuffer(b"".join(shared["counts"]), np.int64)
        order = np.argsort(known)
        known, counts = np.append(known[order], np.uint64(2**64 - 1)), np.append(counts[order], 0)
        at = np.searchsorted(known[:-1], h)
        self.hashes, self.lengths, self.counts = h, n, np.where(known[at] == h, counts[at], 1)
        self.past = np.cumsum(n)


def _promising(p: Join):
    """Of a block's sets those of which enough shingles are held by other sets; a set counts
    as often as there are blocks with it."""

    def run(_: tuple, rows: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"set_key": []}, dtype=object)
        if not len(rows):
            return none
        block = _Block(rows["hashes"].iloc[0], rows["lengths"].iloc[0], more[more["shared"].notna()])
        sets = more[more["set_key"].notna()].sort_values("place")
        copies, n = sets["copies"].to_numpy(np.int64), sets["n"].to_numpy(np.int64)
        others = block.counts > np.repeat(copies, block.lengths)
        found = np.concatenate(([0], np.cumsum(others)))[np.concatenate(([0], block.past))]
        enough = np.diff(found) >= p.more(p.least(n))
        return pd.DataFrame({"set_key": list(sets["set_key"][enough & (n > 0)])})

    return run


def _full_sets(p: Join):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, block = Shingler(p.shingle), TaskContext.get().partitionId() << 32
        for pdf in batches:
            texts = list(pdf["text"])
            for part, sets, _ in _blocks_of(texts, shingler):
                yield pd.DataFrame([{"block": block, "nids": pdf["nid"][part].to_numpy(np.int64).tobytes()} | _packed(sets)])
                block += 1
        give_back()

    return run


def _rarest_first(p: Join):
    """The sets of a block that can be linked: their shared shingles, the rarest first, and
    how many of them are short lists."""

    def run(_: tuple, rows: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            block, nids = _Block(rows["hashes"].iloc[0], rows["lengths"].iloc[0], more), np.frombuffer(rows["nids"].iloc[0], np.int64)
            for nid, n, e in zip(nids.tolist(), block.lengths.tolist(), block.past.tolist(), strict=True):
                h, count = block.hashes[e - n : e], block.counts[e - n : e]
                h, count = h[count > 1], count[count > 1]
                if n and len(h) >= p.least(n):
                    h = h[np.lexsort((h, count))]
                    short = len(h) - p.least(n) + 1
                    out.append((nid, n, h.tobytes(), h[:short].view(np.int64).tolist()))
        return pd.DataFrame(out, columns=["nid", "n", "shared", "short"])

    return run


def _links(p: Join):
    """Links between the sets of a group, as many as connect what is linked: all sets with
    those before them, or where two blocks meet the second's with the first's."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["own", "n", "nid"])
        index = _Index(pdf, p)
        first = int((pdf["own"] == pdf["own"].iloc[0]).sum())
        crossed = first < len(pdf)
        found = []
        for x in range(first if crossed else 1, len(pdf)):
            found += index.search(x, first if crossed else x)
        nid = pdf["nid"].to_numpy()
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        give_back()
        return pd.DataFrame({"a": nid[a], "b": nid[b]})

    return run


class _Index:
    """Inverted lists over the sets of a group: list by list the numbers of its sets,
    ascending, so that one search in (list, set) probes any number of lists."""

    def __init__(self, pdf: pd.DataFrame, p: Join):
        self.p, self.size, self.n = p, len(pdf), pdf["n"].to_numpy(np.int64)
        lengths = np.array([len(s) // 8 for s in pdf["shared"]])
        _, lists = np.unique(np.frombuffer(b"".join(pdf["shared"]), np.uint64), return_inverse=True)
        self.past = np.cumsum(lengths)
        self.lists, self.lengths = lists.astype(np.int64), lengths
        sets = np.repeat(np.arange(self.size), lengths)
        self.entries = np.sort(self.lists * self.size + sets)
        self.first = np.searchsorted(self.entries, np.arange(lists.max(initial=-1) + 2) * self.size)
        _, one, label = np.unique(pdf["label"].to_numpy(), return_index=True, return_inverse=True)
        self.root = one[label]  # a set of the component of each set

    def search(self, x: int, before: int) -> list[tuple[int, int]]:
        """Links of set x with sets numbered less than ``before``, one for each component."""
        mine = self.lists[self.past[x] - self.lengths[x] : self.past[x]]
        long = self.first[mine + 1] - self.first[mine]
        mine = mine[np.argsort(long, kind="stable")]
        least = int(self.p.least(self.n[x]))
        # the published rule for how many lists to put aside
        aside = min(least - 1, int(least / (0.01 * np.log2(long.max() + 1) + 1)))
        short, rest = mine[: len(mine) - aside], mine[len(mine) - aside :]
        starts, sizes = self.first[short], self.first[short + 1] - self.first[short]
        at = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        merged = np.bincount(self.entries[at] % self.size, minlength=self.size)[:before]
        enough = np.flatnonzero(merged >= least - aside)
        sizes = self.n[enough]
        enough = enough[self.p.percent * np.maximum(sizes, self.n[x]) <= 100 * np.minimum(sizes, self.n[x])]
        enough = enough[np.argsort(-merged[enough], kind="stable")]
        out = []
        while len(enough := enough[self.root[enough] != self.root[x]]):
            y, enough = int(enough[0]), enough[1:]
            key = rest * self.size + y
            found = np.minimum(np.searchsorted(self.entries, key), len(self.entries) - 1)
            both = int(merged[y]) + int((self.entries[found] == key).sum())
            if 100 * both >= self.p.percent * (self.n[x] + self.n[y] - both):
                out.append((y, x))
                self.root[self.root == self.root[x]] = self.root[y]
        return out


def _groups(nodes: DataFrame) -> DataFrame:
    """(nid, root): which sets are connected through short lists, those alone left out."""
    lists = nodes.select("nid", F.explode("short").alias("list"))
    least = lists.groupBy("list").agg(F.min("nid").alias("least"), F.max("nid").alias("most")).where("least <> most").drop("most")
    edges = lists.join(least, "list").where("nid <> least").select(F.col("nid").alias("a"), F.col("least").alias("b"))
    return connected_components(edges.distinct()).select(F.col("node").alias("nid"), "root")


def _dealt(grouped: DataFrame, packs: int, pairs: Column) -> DataFrame:
    """``grouped`` (nid, n, shared, label, root, blocks, own) in tasks' groups: small groups
    together in packs, blocks of large ones in pairs of which ``pairs`` tells the others
    that a block meets."""
    small = grouped.where("blocks = 1").withColumns({"i": F.lit(-1), "j": F.pmod(F.xxhash64("root"), F.lit(packs)).cast("int"), "root": F.lit(-1).cast("long"), "own": F.lit(0)})
    large = grouped.where("blocks > 1").withColumn("other", F.explode(pairs))
    large = large.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")
    return small.unionByName(large) if packs else large


def _component_edges(nodes: DataFrame, p: Join) -> DataFrame:
    """Links (a, b) that connect what is linked, for ``nodes`` (nid, n, shared, short)."""
    groups = stored(_groups(nodes))
    size = groups.join(nodes.select("nid", F.octet_length("shared").alias("bytes")), "nid").groupBy("root").agg(F.count("*").alias("members"), F.sum("bytes").alias("bytes"))
    # stored, so that what is joined with it by root can be split where a group is large
    size = stored(size.select("root", F.ceil(F.greatest(F.col("members") / MEMBERS, F.col("bytes") / (8 * SHINGLES))).cast("int").alias("blocks")))
    grouped = nodes.drop("short").join(groups, "nid").join(size, "root").withColumn("own", F.pmod(F.xxhash64("nid"), "blocks").cast("int"))
    grouped = stored(grouped.withColumn("label", F.col("nid")))
    total = grouped.agg(F.sum(F.octet_length("shared"))).first()[0] or 0
    packs = -(-total // (4 * SHINGLES)) or 1
    met = _dealt(grouped, packs, _first_pairs())
    links = stored(met.groupBy("root", "i", "j").applyInPandas(_links(p), "a long, b long"))
    large = grouped.where("blocks > 1").drop("label")
    if not large.limit(1).count():
        return links
    labels = connected_components(links).withColumnRenamed("root", "label")
    open_ = large.join(labels, large["nid"] == labels["node"], "left").withColumn("label", F.coalesce("label", "nid")).drop("node")
    several = open_.groupBy("root").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("root")
    rest = _dealt(open_.join(several, "root"), 0, _other_pairs())
    more = stored(rest.groupBy("root", "i", "j").applyInPandas(_links(p), "a long, b long"))
    discard(groups)
    return links.union(more)


def _first_pairs() -> Column:
    """A block meets itself and the first; the first meets all."""
    return F.when(F.col("own") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0), F.col("own")))


def _other_pairs() -> Column:
    """Every block but the first meets every other but the first."""
    return F.when(F.col("own") > 0, F.filter(F.sequence(F.lit(1), F.col("blocks") - 1), lambda b: b != F.col("own"))).otherwise(F.array().cast("array<int>"))


def joined(docs: DataFrame, p: Join = Join()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Links join texts whose shingle sets reach ``p.percent``, without exception; a
    component's id is its smallest doc_id.  Null or wordless texts have no shingles, are
    linked with nothing and stand alone; texts with the same set are one set and linked.
    Rows that repeat a doc_id count one by one, and a null doc_id is a component's id only
    where no other is in it.  A very long text is taken whole, no rows give no rows, and
    further columns are left out, whatever their names.  Shingles are told apart by 64
    bits.
    """
    # ids as text: pandas would make fractions of long ones beside nulls
    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), text_digest(F.col("text")).alias("text_key"), "text")
    buckets = max(LEAST_BUCKETS, (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET)
    read = stored(rows.mapInPandas(_sampled(p), "block long, doc_id string, text_key binary, set_key binary, place long, n long, hashes binary, lengths binary"))
    texts, samples = read.where("set_key is not null").withColumn("doc_id", F.col("doc_id").cast("long")), read.where("hashes is not null").select("block", "hashes", "lengths")
    sets = texts.groupBy("block", "place", "set_key").agg(F.max("n").alias("n"))
    # summed apart, so that neither join nor count brings the copies of one set together
    copies = stored(sets.groupBy("set_key").agg(F.count("*").alias("copies")))
    sets = sets.join(copies, "set_key")
    back = _shared(samples, buckets).unionByName(sets, True)
    kept = stored(samples.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(_promising(p), "set_key binary"))
    firsts = texts.groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("x"))
    ids = stored(firsts.join(kept.distinct(), "set_key").select(F.monotonically_increasing_id().alias("nid"), "set_key", F.col("x.doc_id").alias("id"), F.col("x.text_key").alias("tk")))
    side = F.broadcast(ids) if small_enough(ids, BROADCAST_SETS) else ids
    wanted = rows.join(side, rows["doc_id"].cast("long").eqNullSafe(ids["id"]) & rows["text_key"].eqNullSafe(ids["tk"])).select("nid", "text").dropDuplicates(["nid"])
    full = stored(wanted.mapInPandas(_full_sets(p), "block long, nids binary, hashes binary, lengths binary"))
    held = _shared(full.select("block", "hashes"), buckets)
    nodes = stored(full.groupBy("block").cogroup(held.groupBy("block")).applyInPandas(_rarest_first(p), "nid long, n long, shared binary, short array<long>"))
    discard(full)
    labels = connected_components(_component_edges(nodes, p))
    discard(nodes)
    of = ids.join(labels, ids["nid"] == labels["node"], "left").select("set_key", F.coalesce("root", "nid").alias("root"))
    named = texts.where("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("least")).join(of, "set_key", "left")
    named = stored(named)
    ranked = stored(named.where("root is not null").groupBy("root").agg(F.min("least").alias("component")))
    component = named.join(ranked, "root", "left").select("set_key", F.coalesce("component", "least").alias("component"))
    out = texts.join(component, "set_key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))

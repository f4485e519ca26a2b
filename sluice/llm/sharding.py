"""Shards by fixed virtual slots.

Records hash into thousands of slots; the bytes of each slot are summed, and a
versioned map deals every slot, filled or not, to a shard, largest first to the lightest
one.  A rebalance edits the map: it moves slots from the heaviest shards, and every other
record stays where it is.  Records that come later find their shard by the same map.

A slot heavier than a small share of a shard (a doc_id with very many rows) is split in
the map into sub-slots.  A row's sub-slot comes from its doc_id, its text and its number
among equal rows, so that it is the same in every run, and the split is part of the map.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import shared_dir, stored, text_digest

SLOTS, SUB_SLOTS = 4096, 256
#: A slot of more than 1 / HEAVY of a shard's even share is dealt in sub-slots.
HEAVY = 8


@dataclass(frozen=True)
class SlotMap:
    """A version of the map: unit -> shard.  A slot is one unit, slot * SUB_SLOTS, or if
    split SUB_SLOTS of them; every slot is there."""

    version: int
    shards: int
    of: dict[int, int] = field(repr=False)

    @property
    def split(self) -> list[int]:
        return [u // SUB_SLOTS for u in self.of if u % SUB_SLOTS == 1]

    def loads(self, sizes: dict[int, int]) -> list[int]:
        out = [0] * self.shards
        for unit, shard in self.of.items():
            out[shard] += sizes.get(unit, 0)
        return out

    def moved(self, other: SlotMap) -> int:
        """Units that lie in another shard in ``other``."""
        return sum(other.of.get(u, s) != s for u, s in self.of.items())

    def write(self, spark: SparkSession, path: str) -> None:
        """Add this version to the table of maps at ``path``."""
        rows = [(self.version, self.shards, u, s) for u, s in sorted(self.of.items())]
        spark.createDataFrame(rows, "version int, shards int, unit long, shard int").write.mode("append").parquet(path)

    @staticmethod
    def read(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A version of the maps at ``path``, the latest by default."""
        rows = spark.read.parquet(path)
        version = rows.agg(F.max("version")).first()[0] if version is None else version
        found = rows.where(F.col("version") == version).collect()  # a row for each slot, SUB_SLOTS for each split one
        return SlotMap(version, found[0]["shards"], {r["unit"]: r["shard"] for r in found})

    def __str__(self) -> str:
        return json.dumps({"version": self.version, "shards": self.shards, "units": len(self.of)})


def units_of(split: list[int], slots: int = SLOTS) -> list[int]:
    """Every unit there is if the slots ``split`` are split."""
    return [k * SUB_SLOTS + s for k in range(slots) for s in range(SUB_SLOTS if k in set(split) else 1)] if split else [k * SUB_SLOTS for k in range(slots)]


def deal(sizes: dict[int, int], shards: int, version: int = 1) -> SlotMap:
    """The first map: units from the largest down, each to the lightest shard, of equal
    ones to that with the fewest units.  ``sizes`` has every unit, empty ones too."""
    heap, of = [(0, 0, s) for s in range(shards)], {}
    for unit in sorted(sizes, key=lambda u: (-sizes[u], u)):
        load, n, shard = heapq.heappop(heap)
        of[unit] = shard
        heapq.heappush(heap, (load + sizes[unit], n + 1, shard))
    return SlotMap(version, shards, of)


def rebalance(old: SlotMap, sizes: dict[int, int], shards: int | None = None, slack: float = 0.02) -> SlotMap:
    """The next version, over the units of ``sizes``: units of a slot split since the old
    version begin where the slot was, those of shards taken away go to the lightest, then
    units move from the heaviest shard to the lightest, the largest that narrows the gap
    first, until the heaviest is within ``slack`` of the mean.  Units without bytes keep
    their shard."""
    shards = shards or old.shards
    before = {u: old.of.get(u, old.of.get(u - u % SUB_SLOTS)) for u in sizes}
    of = {u: s for u, s in before.items() if s is not None and s < shards}
    load = [0] * shards
    units: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for u, s in of.items():
        load[s] += sizes[u]
        units[s].append((sizes[u], u))
    for u in sorted((u for u in sizes if u not in of), key=lambda u: (-sizes[u], u)):
        s = min(range(shards), key=lambda k: (load[k], len(units[k]), k))
        of[u] = s
        load[s] += sizes[u]
        units[s].append((sizes[u], u))
    mean = sum(load) / shards
    for _ in range(len(sizes)):
        heavy, light = max(range(shards), key=load.__getitem__), min(range(shards), key=load.__getitem__)
        gap = load[heavy] - load[light]
        fit = [x for x in units[heavy] if 0 < x[0] < gap]
        if load[heavy] <= mean * (1 + slack) or not fit:
            break
        best = min(fit, key=lambda x: (abs(gap / 2 - x[0]), x[1]))
        units[heavy].remove(best)
        units[light].append(best)
        load[heavy] -= best[0]
        load[light] += best[0]
        of[best[1]] = light
    return SlotMap(old.version + 1, shards, of)


def rows_of(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """A stored row per document: rid, doc_id, size, text_crc32, text_key and slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_digest(text).alias("text_key"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(slots)).alias("slot"),
    )
    return stored(rows)


def in_units(rows: DataFrame, split: list[int]) -> DataFrame:
    """``rows`` with their unit.  Equal rows of a split slot are numbered in parts, so that
    no task holds all of them, and dealt out one after the other."""
    if not split:
        return rows.withColumn("unit", F.col("slot") * SUB_SLOTS)
    same = ["doc_id", "text_key"]
    there = rows.where(F.col("slot").isin(split)).withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(SUB_SLOTS)))
    sizes = there.groupBy(*same, "part").agg(F.count("*").alias("n"))
    before = sizes.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("part").alias("_part"), (F.sum("n").over(Window.partitionBy(*same).orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy(*same, "part").orderBy("rid"))
    numbered = there.withColumn("place", place).join(before, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key")) & (F.col("part") == F.col("_part")))
    sub = F.pmod(F.xxhash64("doc_id", "text_key") + F.col("before") + F.col("place"), F.lit(SUB_SLOTS))
    dealt = numbered.select(*rows.columns, (F.col("slot") * SUB_SLOTS + sub).alias("unit"))
    return dealt.unionByName(rows.where(~F.col("slot").isin(split)).withColumn("unit", F.col("slot") * SUB_SLOTS))


def slotted(docs: DataFrame, shards: int, slots: int = SLOTS, split: list[int] | None = None) -> tuple[DataFrame, dict[int, int]]:
    """The rows of ``rows_of`` with their units, and the bytes of every unit, filled or not.
    Slots that are too heavy are split, and those of ``split`` stay so."""
    rows = rows_of(docs, slots)
    weights = {r["slot"]: r["n"] for r in rows.groupBy("slot").agg(F.sum("size").alias("n")).collect()}  # slots rows at most
    limit = sum(weights.values()) / shards / HEAVY
    heavy = sorted({k for k, n in weights.items() if n > limit} | set(split or []))
    rows = in_units(rows, heavy)
    sizes = dict.fromkeys(units_of(heavy, slots), 0) | {k * SUB_SLOTS: n for k, n in weights.items() if k not in set(heavy)}
    if heavy:
        parts = rows.where(F.col("slot").isin(heavy)).groupBy("unit").agg(F.sum("size").alias("n")).collect()  # SUB_SLOTS for each of shards * HEAVY slots
        sizes |= {r["unit"]: r["n"] for r in parts}
    return rows, sizes


def placed(rows: DataFrame, slot_map: SlotMap) -> DataFrame:
    """``rows`` with shard and a gapless place in it: the units of a shard lie one after
    the other, and rows are numbered within their unit, so that no task holds a shard.
    A row whose unit is not in the map is an error."""
    spark = rows.sparkSession
    of = spark.createDataFrame(sorted(slot_map.of.items()), "unit long, shard int")
    counts = rows.groupBy("unit").agg(F.count("*").alias("n")).join(F.broadcast(of), "unit", "left")  # a row for each unit of the map
    counts = counts.withColumn("shard", F.coalesce("shard", F.raise_error(F.concat(F.lit("not in the slot map: unit "), F.col("unit").cast("string"))).cast("int")))
    before = counts.select("unit", "shard", (F.sum("n").over(Window.partitionBy("shard").orderBy("unit")) - F.col("n")).alias("before"))
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("unit").orderBy("doc_id", "rid")))
    return numbered.join(F.broadcast(before), "unit", "left").withColumn("place", F.col("before") + F.col("n") - 1).drop("n", "before")


def shard_documents(docs: DataFrame, shards: int = 16, map_path: str | None = None, follow: int | None = None) -> tuple[DataFrame, SlotMap]:
    """Every row of ``docs`` (doc_id, text) with its size (UTF-8 bytes of the text plus 1),
    text_crc32, unit, shard and place in the shard; and the slot map.

    The map is written to the table of maps at ``map_path`` (by default in the shared
    folder) and the rows are placed by what is read from there.  ``follow`` names a
    version to start from: its next version is written, in which only what ``rebalance``
    moves has another shard.

    A null text has no bytes.  A null doc_id hashes to a slot like any other; repeated
    rows count one by one, and those of a hot doc_id are spread over sub-slots.  No rows
    give no rows and a map of empty slots.  Further columns are left out; a very long
    text is a large size and no more.
    """
    spark, path = docs.sparkSession, map_path or shared_dir(docs.sparkSession)
    old = None if follow is None else SlotMap.read(spark, path, follow)
    rows, sizes = slotted(docs, shards, split=old.split if old else None)
    made = deal(sizes, shards) if old is None else rebalance(old, sizes, shards)
    made.write(spark, path)
    slot_map = SlotMap.read(spark, path, made.version)
    return placed(rows, slot_map), slot_map


def place_documents(docs: DataFrame, slot_map: SlotMap) -> DataFrame:
    """``docs``, such as those that came later, placed by a map as it is."""
    return placed(in_units(rows_of(docs), slot_map.split), slot_map)

"""Benchmark decontamination: token windows of the corpus looked up in a hash set of
benchmark n-grams, with DataFrame functions only.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters.  Each
benchmark item gives every window of ``n`` consecutive words, an item of fewer words
its whole sequence.  The set of windows is hashed by the anchor of each, its longest
word; a document's words are probed against it where the document is read, and a
window around a hit is verified on all its words.  The set is broadcast while it
holds at most ``BROADCAST_WINDOWS`` windows.  Beyond, words are probed against the
anchors alone, which are broadcast while they are few enough; a word that may be one
goes through a shuffle to the windows with its neighbours, never with its document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import ascii_lower, column, free_names, small_enough, stored, text_digest

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before letters are put in lower case.
EITHER_CASE_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows of the broadcast set at most; about 300 bytes each.
BROADCAST_WINDOWS = 200_000
#: Anchors of the broadcast set at most; about 50 bytes each.
BROADCAST_ANCHORS = 1_000_000


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(item_id string, n, window): the distinct windows of each item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    return items.select("item_id", length.alias("n"), F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("window")).distinct()


def anchored(windows: DataFrame) -> DataFrame:
    """``windows`` (n, window) with the ``anchor`` of each, its longest word, and the
    number of words before it.  Long words are rare, so few places are probed twice."""
    ranked = F.transform("window", lambda w, i: F.struct(F.length(w).alias("size"), F.xxhash64(w).alias("hash"), i.alias("at")))
    at = F.array_max(ranked)["at"]
    return windows.select(F.col("n").alias("length"), "window", at.alias("before"), F.element_at("window", at + 1).alias("anchor"))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """Distinct (doc_id, text_key, at, n, window) of the verified occurrences, stored;
    ``at`` counts words from 1."""
    known = anchored(benchmark_windows(benchmark, n).select("n", "window").distinct())
    words = docs.select("doc_id", text_digest(F.col("text")).alias("text_key"), words_of(F.col("text")).alias("words"))
    every = words.select("doc_id", "text_key", "words", F.posexplode("words").alias("place", "word"))
    if small_enough(known, BROADCAST_WINDOWS):
        known, first = F.broadcast(known), F.lit(0)
    else:
        anchors = known.select(F.col("anchor").alias("word")).distinct()
        if small_enough(anchors, BROADCAST_ANCHORS):
            every = every.join(F.broadcast(anchors), "word", "left_semi")
        first = F.greatest(F.col("place") - (n - 1), F.lit(0))
        every = every.select("doc_id", "text_key", F.slice("words", first + 1, F.lit(2 * n - 1)).alias("words"), "place", "word", first.alias("first"))
        first = F.col("first")
    at = F.col("place") - F.col("before")  # of the window, from 0
    inside = (at >= first) & (at - first + F.col("length") <= F.size("words"))
    same = (F.col("word") == F.col("anchor")) & inside & (F.slice("words", F.greatest(at - first, F.lit(0)) + 1, F.col("length")) == F.col("window"))
    found = every.join(known, same).select("doc_id", "text_key", (at + 1).alias("at"), F.col("length").alias("n"), "window")
    return stored(found.distinct())


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, item_ids
    (sorted as strings), spans (array of first and past-the-last word, from 0, merged)
    and contaminated: n_hit > 0 and ``share`` * n_hit >= n_words.

    Null and empty texts have no words and are clean, as is everything if the
    benchmark is empty.  Rows are told by doc_id and text: repeated rows each come
    out with the same figures, and a null doc_id is an id like any other.  Benchmark
    items without words are passed over; a null item_id counts as the empty string.
    Very long texts are read whole; further columns are left out.
    """
    found = hits(docs, benchmark, n)
    key = ["doc_id", "text_key"]
    by_start = found.groupBy(*key, "at").agg(F.max("n").alias("n"))
    order = Window.partitionBy(*key).orderBy("at")
    past = F.max(F.col("at") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = by_start.withColumn("past", past).withColumn("opens", (F.col("past").isNull() | (F.col("at") > F.col("past"))).cast("int"))
    numbered = opened.withColumn("span", F.sum("opens").over(order))
    spans = numbered.groupBy(*key, "span").agg((F.min("at") - 1).cast("long").alias("first"), (F.max(F.col("at") + F.col("n")) - 1).cast("long").alias("last"))
    covered = spans.groupBy(*key).agg(F.sum(F.col("last") - F.col("first")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))
    owners = benchmark_windows(benchmark, n).select("item_id", "window")
    items = found.select(*key, "window").distinct().join(owners, "window").groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    per_text = covered.join(items, [covered[k].eqNullSafe(items[k]) for k in key]).select(covered["doc_id"].alias("_id"), covered["text_key"].alias("_key"), "n_hit", "spans", "item_ids")
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), EITHER_CASE_GAP), "")).cast("long")
    rows = docs.select("doc_id", text_digest(F.col("text")).alias("text_key"), n_words.alias("n_words"))
    out = rows.join(per_text, rows["doc_id"].eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "text_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,last:bigint>>")).alias("spans"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20, remove: str = "documents") -> DataFrame:
    """``docs`` with its columns, cleaned of benchmark passages.

    ``remove="documents"`` leaves out contaminated documents; ``remove="spans"``
    keeps every row and cuts the hit words, each with the gap behind it, out of
    contaminated texts.  Nulls, empty texts, repeated rows and empty tables count as in
    ``contamination``; further columns stay, whatever their names.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    id_, key, spans, text_, words_, gaps_ = free_names(docs, "id", "key", "spans", "text", "words", "gaps")
    bad = contamination(docs, benchmark, n, share).where("contaminated").select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.col("spans").alias(spans)).dropDuplicates([id_, key])
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (text_digest(docs["text"]) == F.col(key))
    if remove == "documents":
        return docs.join(bad, same, "left_anti")
    joined = docs.join(bad, same, "left").select(*[column(docs, c) for c in docs.columns], spans)
    joined = joined.withColumns({words_: F.regexp_extract_all("text", F.lit(f"({_either_case()})"), F.lit(1)), gaps_: F.split("text", _either_case(), -1)})
    kept = F.transform(words_, lambda w, i: F.when(F.exists(spans, lambda s: (i >= s["first"]) & (i < s["last"])), F.lit("")).otherwise(F.concat(w, F.get(gaps_, i + 1))))
    cut = F.concat(F.get(gaps_, F.lit(0)), F.array_join(kept, ""))
    out = joined.withColumn(text_, F.when(F.col(spans).isNull(), F.col("text")).otherwise(cut))
    return out.select(*[F.col(text_).alias("text") if c == "text" else column(out, c) for c in docs.columns])


def _either_case() -> str:
    """A word before its letters are put in lower case."""
    return r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

"""Scoring of texts with a hidden Markov language model.

Tokens are lower-cased (A-Z) words between ASCII white space, then one end token.
Token counts come from the whole training part, and every training word has emissions
of its own.  The more frequent words, the end and the classes (by hash) of words never
seen are symbols, whose emissions the tasks hold.  A class counts as one word, so that
the probabilities sum to one.

Baum-Welch: sequences lie in blocks, each with the list of its rarer words.  An
iteration runs the scaled forward and backward recursions over every training block.
The expected counts of each word and state are summed over the blocks in buckets of
words, stored, and sent back to the blocks that hold the word; those of a word that one
block alone holds, as of most rare words, stay with that block.  The emission of a word
is its expected counts plus its prior over the state's total, so a block needs no more
than that and the fixed-size part of the model.  A word's expected counts add up to its
count; between iterations the roots of those of the rarer words are kept in half
precision.  Scoring runs the forward recursion over each text.

The weight of the prior is learned in every iteration: of the weights of ``PRIORS`` that
one is taken under which the words are likeliest when each occurrence is scored by the
others (leaving one out).  So a small corpus, in which most words are rare, keeps its
states near the overall shares, and a large one lets them part.

Rarer words are told apart by 64 bits of a hash, and their counts come back to the
blocks that hold them in the same way, before the first iteration.  Being rare, none of
them is a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sluice.llm.common import bucketed, discard, give_back, partitions, setting, stored
from sluice.llm.langid import fold
from sluice.llm.tokens import bytes_of, slices


#: In place of a symbol: a word that is none.
RARE = 0xFFFFFF
#: Tokens of a block, and of a batch within, about.
BLOCK, BATCH = 600_000, 300_000
#: Weights, in tokens, that the words' overall shares may have in a state's emissions.
PRIORS = 30.0 * 4.0 ** np.arange(16)
#: Bytes of a bucket of words, about.
BUCKET_BYTES = 16 << 20


@dataclass(frozen=True)
class HiddenMarkov:
    states: int = 8
    iterations: int = 5
    #: Words whose first emissions differ by state, classes of words never seen, and words
    #: whose counts and emissions the tasks hold, at most.
    symbols: int = 30_000
    classes: int = 512
    held_words: int = 80_000
    seed: int = 3


def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, one text's after the other's, and the text of each."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    # lower case comes after the split: of an array with an offset Arrow makes other text
    words, text = pc.ascii_lower(split.flatten()), np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    there = pc.not_equal(words, "")  # a blank before the first word leaves an empty one
    return words.filter(there).dictionary_encode(), text[there.to_numpy(zero_copy_only=False)]


def _count_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, most=6_000_000):
            words, _ = _split(rows.column("text"))
            counts = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            yield pa.RecordBatch.from_arrays([words.dictionary.cast(pa.string()), pa.array(counts, pa.int64())], ["word", "c"])
    give_back()


def token_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over the words of ``texts`` (text)."""
    return texts.select("text").mapInArrow(_count_partition, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _least_count(histogram: list, most: int) -> int:
    """The least count such that at most ``most`` words have it or a higher one."""
    total, least = 0, 1 << 62
    for low, n in histogram:  # from the highest counts down
        total += n
        if total > most:
            break
        least = low
    return least


@dataclass
class Tables:
    """What the tasks hold of the training counts."""

    index: dict[bytes, int]  # held words
    counts: np.ndarray  # of held words
    n_apart: int  # of the first held words, whose first emissions differ by state
    classes: int
    n_symbols: int  # words, then classes, then the end
    end_count: int
    tokens: int
    types: int

    @property
    def end(self) -> int:
        return self.n_symbols - 1

    @property
    def weight(self) -> int:
        """Of all words, the classes and the end: count + 1 each."""
        return self.tokens + self.types + self.classes + (self.end_count == 0)


def packed(symbols: np.ndarray) -> bytes:
    """Two low bytes of each symbol, then the third, which is mostly 0."""
    return symbols.astype("<u2").tobytes() + (symbols >> 16).astype("u1").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = len(data) // 3
    return np.frombuffer(data, "<u2", n).astype(np.int64) | np.frombuffer(data, "u1", n, 2 * n).astype(np.int64) << 16


def word_key(word: bytes) -> int:
    """64 bits that stand for a word."""
    return xxh64_intdigest(word)


def tables_of(counts: DataFrame, n_docs: int, p: HiddenMarkov) -> Tables:
    """Bounded tables from the stored counts."""
    bucket = F.floor(F.log2("c") * 16)
    histogram = counts.groupBy(bucket.alias("b")).agg(F.min("c").alias("low"), F.count("*").alias("n"), F.sum("c").alias("c")).orderBy(F.desc("b")).collect()  # 16 rows for each doubling of the count at most
    steps = [(r["low"], r["n"]) for r in histogram]
    least_symbol, least_held = _least_count(steps, p.symbols), _least_count(steps, p.held_words)
    held = counts.where(F.col("c") >= least_held).toPandas().sort_values(["c", "word"], ascending=[False, True])  # p.held_words rows at most
    words = [w.encode() for w in held["word"]]
    c = held["c"].to_numpy(np.int64)
    n_apart = int((c >= least_symbol).sum())
    tokens = sum(r["c"] for r in histogram) + n_docs
    types = sum(r["n"] for r in histogram) + (n_docs > 0)
    return Tables(dict(zip(words, range(len(words)), strict=True)), c, n_apart, p.classes, len(words) + p.classes + 1, n_docs, tokens, types)


def _sequence_partition(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables
        find, denominator = t.index.get, np.log10(t.tokens + t.types + 1)
        base = np.log10(t.counts + 1.0) - denominator
        end_base = float(np.log10(t.end_count + 1.0) - denominator)
        for batch in batches:
            for rows in slices(batch):
                words, text = _split(rows.column("text"))
                every, code, n = bytes_of(words.dictionary), words.indices.to_numpy(), rows.num_rows
                place = np.fromiter(map(find, every, repeat(-1)), np.int64, len(every))
                keys = np.array([0 if p >= 0 else word_key(w) for w, p in zip(every, place.tolist(), strict=True)], "<u8")
                at = place[code]
                rare = at < 0
                length = np.bincount(text, minlength=n)
                symbols = np.insert(np.where(rare, RARE, at), np.cumsum(length), t.end)
                past, rare_past = np.cumsum(length + 1).tolist(), np.cumsum(np.bincount(text[rare], minlength=n)).tolist()
                rare_keys = keys[code[rare]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([packed(symbols[a:b]) for a, b in zip([0, *past], past)], pa.binary()), pa.array([rare_keys[a:b].tobytes() for a, b in zip([0, *rare_past], rare_past)], pa.binary()),
                    pa.array(length + 1, pa.int64()), pa.array(np.bincount(text[~rare], minlength=n) + (t.end_count > 0), pa.int64()), pa.array(np.bincount(text[~rare], base[at[~rare]], n) + end_base),
                    rows.column("rid"), rows.column("doc_id"), rows.column("held_out"),
                ], ["symbols", "rare", "n_tokens", "n_known", "base", "rid", "doc_id", "held_out"])
        give_back()

    return run


def sequences(docs: DataFrame, tables: Tables) -> DataFrame:
    """A stored row per document: its symbols (RARE for a word that is none), the keys of
    those words, and what its held words add to the base score."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    schema = "symbols binary, rare binary, n_tokens long, n_known long, base double, rid long, doc_id long, held_out boolean"
    return stored(rows.mapInArrow(_sequence_partition(tables), schema).sortWithinPartitions("n_tokens"))


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # symbols x states


class Batch:
    """Sequences of about one length, longest first, laid out by time step."""

    def __init__(self, every: list[np.ndarray]):
        length = np.array(list(map(len, every)))
        self.order = np.argsort(-length, kind="stable")
        every, self.length = [every[i] for i in self.order], length[self.order]
        top = int(self.length[0])
        self.alive = len(every) - np.searchsorted(self.length[::-1], np.arange(top), side="right")
        self.first = np.concatenate(([0], np.cumsum(self.alive)))
        self.row = np.repeat(np.arange(len(every), dtype=np.int32), self.length)
        time = np.arange(len(self.row), dtype=np.int32) - np.repeat((np.cumsum(self.length) - self.length).astype(np.int32), self.length)
        self.at = self.first.astype(np.int32)[time] + self.row
        self.symbols = np.empty(len(self.row), np.int32)
        self.symbols[self.at] = np.concatenate(every)

    def forward(self, m: Model, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
        """Emissions, scaled forward weights (with ``keep``) and scales of every token, by
        time step."""
        seen = np.take(m.emit, self.symbols, axis=0)
        weight, scale = np.empty_like(seen) if keep else None, np.empty(len(seen), seen.dtype)
        ones, first = np.ones(len(m.start), seen.dtype), self.first.tolist()
        now = np.repeat(m.start[None], self.alive[0], 0)
        for t, n in enumerate(self.alive.tolist()):
            a, b = first[t], first[t + 1]
            if t:
                now = now[:n] @ m.move
            now *= seen[a:b]
            now /= np.matmul(now, ones, out=scale[a:b])[:, None]  # sums of short rows are quicker this way
            if keep:
                weight[a:b] = now
        return seen, weight, scale

    def log10(self, m: Model) -> np.ndarray:
        """Log-probability of each sequence, in the order they were given."""
        scale = self.forward(m, keep=False)[2]
        total = np.bincount(self.row, np.log10(scale[self.at]), len(self.length))
        out = np.empty(len(total))
        out[self.order] = total
        return out

    def expect(self, m: Model, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """Add the expected counts to the three arrays."""
        seen, weight, scale = self.forward(m, keep=True)
        seen /= scale[:, None]
        moves, first, alive, backward = np.zeros_like(m.move), self.first.tolist(), self.alive.tolist(), np.ascontiguousarray(m.move.T)
        back = np.ones((alive[0], len(m.start)), seen.dtype)  # of the step at hand; one where a sequence ends
        for t in range(len(alive) - 2, -1, -1):
            n, a, c = alive[t + 1], first[t], first[t + 1]
            before, ahead, now = weight[a : a + n], seen[c : c + n], back[:n]
            ahead *= now
            moves += before.T @ ahead
            np.matmul(ahead, backward, out=now)
            before *= now
        weight /= (weight @ np.ones(len(m.start), weight.dtype))[:, None]
        move += moves * m.move
        start += weight[: alive[0]].sum(axis=0)
        for k in range(weight.shape[1]):
            emit[:, k] += np.bincount(self.symbols, weight[:, k], len(emit))


#: A block's arrays: symbols of its tokens and length of its texts; its rarer words, those
#: that other blocks hold too first, in the order of their buckets, with the count of each,
#: and the word of each token that is none of the symbols; its texts.
_BLOCKS = "block long, held_out boolean, symbols binary, lengths binary, words binary, counts binary, at binary, texts binary"
_TEXT = np.dtype([("doc_id", "<i8"), ("null", "?"), ("known", "<i4"), ("base", "<f8")])


def _block_partition(buckets: int):
    def block(held_out: bool, rows: list) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(r.rare for r in rows), "<u8")
        words, at = np.unique(keys, return_inverse=True)
        order = np.argsort(words % np.uint64(buckets), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        symbols = packed(np.concatenate([unpacked(r.symbols) for r in rows]))
        lengths = np.array([r.n_tokens for r in rows], "<i4")
        texts = np.array([(0 if r.doc_id is pd.NA else r.doc_id, r.doc_id is pd.NA, r.n_known, r.base) for r in rows], _TEXT)
        return pd.DataFrame({"block": [rows[0].rid], "held_out": held_out, "symbols": symbols, "lengths": lengths.tobytes(), "words": words[order].astype("<u8").tobytes(), "counts": b"", "at": place[at].astype("<u4").tobytes(), "texts": texts.tobytes()})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_, size = {False: [], True: []}, {False: 0, True: 0}
        for pdf in frames:
            for r in pdf.astype({"doc_id": "Int64"}).itertuples():
                held_out = bool(r.held_out)
                open_[held_out].append(r)
                size[held_out] += r.n_tokens
                if size[held_out] >= BLOCK:
                    yield block(held_out, open_[held_out])
                    open_[held_out], size[held_out] = [], 0
        for held_out, rows in open_.items():
            if rows:
                yield block(held_out, rows)
        give_back()

    return run


_SUMS = "bucket int, block long, words binary, sums binary"


def halved(sums: np.ndarray) -> bytes:
    """Counts below 2**32 in half precision, by their roots."""
    return np.sqrt(sums).astype("<f2").tobytes()


def whole(data: bytes, states: int) -> np.ndarray:
    return np.square(np.frombuffer(data, "<f2").astype(np.float32)).reshape(-1, states)


def left_out(sums: np.ndarray, weight: int) -> np.ndarray:
    """For each of ``PRIORS`` what words with these expected counts (words x states) add to
    the log-likelihood of emissions, each occurrence scored by the word's others, before
    the states' totals are taken off."""
    c = sums.sum(axis=1)
    sums, c = sums[c > 0], c[c > 0]
    rest, share = sums * np.maximum(0.0, 1 - 1 / c)[:, None], ((c + 1) / weight)[:, None]
    return np.array([(sums * np.log(rest + p * share)).sum() for p in PRIORS])


def _in_rows(values: np.ndarray, states: int) -> np.ndarray:
    """Values as rows of ``states`` columns, the last filled up with zeros."""
    return np.pad(values, (0, -len(values) % states)).reshape(-1, states)


def _in_buckets(block: int, words: np.ndarray, sums: np.ndarray | None, buckets: int, kind: str = "", first: int = 0) -> pd.DataFrame:
    """A row for each bucket that has some of ``words``, which lie in the buckets' order."""
    bucket = (words % np.uint64(buckets)).astype(np.int64)
    parts = np.split(np.arange(len(words)), np.flatnonzero(np.diff(bucket)) + 1) if len(words) else []
    return pd.DataFrame([(first + int(bucket[i[0]]), block, words[i].astype("<u8").tobytes(), b"" if sums is None else sums[i].astype(kind).tobytes() if kind else halved(sums[i])) for i in parts], columns=["bucket", "block", "words", "sums"])


def _ask_partition(buckets: int, count: bool):
    """What blocks ask of the buckets: their words' sums; with ``count`` the number of times
    that they hold each word in training texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for b in pdf.itertuples():
                words = np.frombuffer(b.words, "<u8")
                sums = np.bincount(np.frombuffer(b.at, "<u4"), minlength=len(words))[:, None] * (not b.held_out) if count else None
                yield _in_buckets(b.block, words, sums, buckets, "<i8")

    return run


def _count_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each block that has asked, the counts of its words over all blocks, and below
    zero, less one, where no other block has asked."""
    words = [np.frombuffer(w, "<u8") for w in pdf["words"]]
    every, at = np.unique(np.concatenate(words), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, at, np.frombuffer(b"".join(pdf["sums"]), "<i8"))
    alone = np.bincount(at, minlength=len(every)) == 1
    total[alone] = -1 - total[alone]
    return pd.DataFrame({"bucket": pdf["bucket"].array, "block": pdf["block"].array, "words": b"", "sums": [total[i].tobytes() for i in np.split(at, np.cumsum(list(map(len, words)))[:-1])]})


def _sum_bucket(buckets: int, states: int, symbols: int, weight: int):
    """Sums over the blocks of a bucket's words, for each block that has asked; those of
    the symbols, and what the words add to ``left_out``, as block -1.  What blocks keep for
    themselves passes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        if bucket < 0:
            return pdf
        pdf = pdf.sort_values("block")
        words = [np.frombuffer(w, "<u8") for w in pdf["words"]]
        every, at = np.unique(np.concatenate(words), return_inverse=True)
        at = np.split(at, np.cumsum(list(map(len, words)))[:-1])
        total = np.zeros((len(every), states))
        for i, s in zip(at, pdf["sums"], strict=True):
            if s:
                total[i] += whole(s, states) if bucket < buckets else np.frombuffer(s, "<f4").reshape(len(i), states)  # a block has a word once
        if bucket < buckets:
            back = pd.DataFrame({"bucket": bucket, "block": pdf["block"].array, "words": b"", "sums": [halved(total[i]) for i in at]})
            total = _in_rows(left_out(total, weight), states)
            every = symbols + states + 2 + np.arange(len(total))
        made = pd.DataFrame({"bucket": [bucket], "block": [-1], "words": [every.astype("<u8").tobytes()], "sums": [total.astype("<f8").tobytes()]})
        return pd.concat((back, made)) if bucket < buckets else made

    return run


def _settle_block(tables: Tables):
    """Blocks with the counts of their words: words never seen in training become classes,
    and each text's known words and base score are whole."""
    denominator, classes, first_class = float(np.log10(tables.tokens + tables.types + 1)), tables.classes, tables.n_symbols - 1 - tables.classes

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in left.itertuples():
            words, at, symbols = np.frombuffer(b.words, "<u8"), np.frombuffer(b.at, "<u4").astype(np.int64), unpacked(b.symbols)
            c = np.frombuffer(b"".join(right.sort_values("bucket")["sums"]), "<i8")
            alone = c < 0
            c = np.where(alone, -1 - c, c)
            rare = np.flatnonzero(symbols == RARE)
            texts, lengths = np.frombuffer(b.texts, _TEXT).copy(), np.frombuffer(b.lengths, "<i4")
            text = np.searchsorted(np.cumsum(lengths), rare, side="right")
            texts["known"] += np.bincount(text, c[at] > 0, len(texts)).astype(np.int32)
            texts["base"] += np.bincount(text, np.log10(c[at] + 1.0) - denominator, len(texts))
            unseen = c[at] == 0
            symbols[rare[unseen]] = first_class + (words[at[unseen]] % np.uint64(classes)).astype(np.int64)
            order = np.concatenate((np.flatnonzero((c > 0) & ~alone), np.flatnonzero((c > 0) & alone)))
            place = np.zeros(len(words), np.int64)
            place[order] = np.arange(len(order))
            shared = int(((c > 0) & ~alone).sum())
            out.append((b.block, b.held_out, packed(symbols), b.lengths, words[order[:shared]].tobytes(), c[order].astype("<u4").tobytes(), place[at[~unseen]].astype("<u4").tobytes(), texts.tobytes()))
        return pd.DataFrame(out, columns=[x.split()[0] for x in _BLOCKS.split(", ")])

    return run


def word_buckets(rows: DataFrame) -> int:
    """Buckets of the rarer words in the rows of ``sequences``, so many that what one holds
    doesn't grow with the rows."""
    size = rows.agg(F.sum(F.octet_length("rare"))).first()[0] or 0
    return max(partitions(rows.sparkSession), size // BUCKET_BYTES)


def blocks_of(rows: DataFrame, tables: Tables, buckets: int) -> DataFrame:
    """Blocks of the rows of ``sequences``, of like lengths, training rows and others apart,
    in buckets by their number, so that no iteration deals them out again.  The rows go."""
    n = partitions(rows.sparkSession)
    made = stored(rows.mapInPandas(_block_partition(buckets), _BLOCKS))
    discard(rows)
    asked = made.select("block", "held_out", "words", "at").mapInPandas(_ask_partition(buckets, True), _SUMS)
    counts = stored(asked.groupBy("bucket").applyInPandas(_count_bucket, _SUMS))
    settled = bucketed(made.groupBy("block").cogroup(counts.groupBy("block")).applyInPandas(_settle_block(tables), _BLOCKS), "block", n)
    discard(made, counts)
    return settled


@dataclass
class Known:
    """What a block needs beside its words' sums."""

    model: Model  # of the symbols
    norm: np.ndarray  # total weight of each state
    prior: float
    weight: int  # of all words
    buckets: int

    def local(self, block, sums: list[bytes]) -> tuple[Model, np.ndarray]:
        """The model of the symbols and then the block's words, and the block's tokens in it;
        ``sums`` are those of the words in their order."""
        m, n = self.model, len(self.model.emit)
        symbols, counts = unpacked(block.symbols), np.frombuffer(block.counts, "<u4")
        if len(counts) == 0:
            return m, symbols
        share = (counts + 1.0) / self.weight
        got = whole(b"".join(sums), len(m.start))
        emit = (got + self.prior * share[:, None]) / self.norm if len(got) else np.repeat(share[:, None], len(m.start), 1)
        symbols[symbols == RARE] = n + np.frombuffer(block.at, "<u4").astype(np.int64)
        return Model(m.start, m.move, np.vstack((m.emit, emit.astype(m.emit.dtype)))), symbols


def _batches(symbols: np.ndarray, lengths: np.ndarray, most: int) -> Iterator[tuple[int, int, Batch]]:
    every, first, size = np.split(symbols, np.cumsum(lengths)[:-1]), 0, 0
    for i in range(len(every)):
        size += len(every[i])
        if size >= most or i == len(every) - 1:
            yield first, i + 1, Batch(every[first : i + 1])
            first, size = i + 1, 0


def _with_sums(blocks: DataFrame, sums: DataFrame) -> DataFrame:
    """``blocks``, which are in buckets, with the sums of each one's words in the words'
    order: those of the buckets, then its own."""
    part = F.struct((F.col("bucket") < 0).alias("own"), "bucket", "sums")
    parts = sums.where("block >= 0").groupBy("block").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return blocks.join(parts.select("block", F.transform("parts", lambda p: p["sums"]).alias("sums")).hint("merge"), "block", "left")


def _expect_blocks(known: Known):
    """Expected counts of a task's blocks: of their words for each, of the symbols added up."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k, n = len(known.model.start), len(known.model.emit)
        # after the symbols: the start, the moves, the total of the other words, and what those
        # of one block add to ``left_out``
        total = np.zeros((n + k + 2 + len(_in_rows(PRIORS, k)), k))
        for pdf in frames:
            for b in pdf.itertuples():
                m, symbols = known.local(b, [] if b.sums is None else list(b.sums))
                emit = np.zeros(m.emit.shape)
                for _, _, batch in _batches(symbols, np.frombuffer(b.lengths, "<i4"), BATCH):
                    batch.expect(m, total[n], total[n + 1 : n + 1 + k], emit)
                own, words = emit[n:], np.frombuffer(b.words, "<u8")
                total[:n] += emit[:n]
                total[n + k + 1] += own.sum(axis=0)
                total[n + k + 2 :] += _in_rows(left_out(own[len(words) :], known.weight), k)
                give_back()
                yield _in_buckets(b.block, words, own[: len(words)], known.buckets)
                if len(own) > len(words):
                    yield pd.DataFrame({"bucket": [-1 - b.block % 1_000_003], "block": b.block, "words": b"", "sums": [halved(own[len(words) :])]})
        used = np.flatnonzero(total.sum(axis=1))
        yield _dense_rows(-1, used.astype(np.uint64), total[used], known.buckets)

    return run


def _dense_rows(block: int, rows: np.ndarray, sums: np.ndarray, buckets: int) -> pd.DataFrame:
    """Sums of the symbols, and what follows them, in buckets of their own."""
    order = np.argsort(rows % np.uint64(buckets), kind="stable")
    return _in_buckets(block, rows[order], sums[order], buckets, "<f4", buckets)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score_block(known: Known):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in left.itertuples():
            parts = right.sort_values("bucket")
            m, symbols = known.local(b, [*parts["sums"][parts["bucket"] >= 0], *parts["sums"][parts["bucket"] < 0]])
            lengths, texts = np.frombuffer(b.lengths, "<i4"), np.frombuffer(b.texts, _TEXT)
            score = np.concatenate([batch.log10(m) for _, _, batch in _batches(symbols, lengths, BATCH)]).astype(float)
            give_back()
            doc_id = pd.array(texts["doc_id"], "Int64")
            doc_id[texts["null"]] = pd.NA
            out.append(pd.DataFrame({"doc_id": doc_id, "held_out": bool(b.held_out), "n_tokens": lengths.astype(np.int64), "n_known": texts["known"].astype(np.int64), "base_score": texts["base"], "score": score}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in _SCORES.split(", ")})

    return run


def _normal(x: np.ndarray, axis: int) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def initial(tables: Tables, p: HiddenMarkov) -> tuple[Model, np.ndarray]:
    """The first model of the symbols, whose emissions and those of the other words (their
    shares, in each state) sum to one; and the symbols' overall shares."""
    k, n = p.states, tables.n_symbols
    overall = np.ones(n)
    overall[: len(tables.counts)] += tables.counts
    overall[n - 1] += tables.end_count
    overall /= tables.weight
    rng = np.random.default_rng(p.seed)
    noise = rng.normal(0, 0.7, size=(n, k))
    noise[tables.n_apart : len(tables.counts)] = 0
    emit = _normal(overall[:, None] * np.exp(noise), 0) * overall.sum()
    return Model(np.full(k, 1 / k), 0.1 / k + 0.9 * np.eye(k), emit), overall


def train(blocks: DataFrame, tables: Tables, buckets: int, p: HiddenMarkov) -> tuple[Known, DataFrame]:
    """Baum-Welch over all training ``blocks``: what every block needs to score its texts,
    and the sums of the words of each."""
    spark = blocks.sparkSession
    k, n = p.states, tables.n_symbols
    training = blocks.where("not held_out")
    asking = blocks.where("held_out").select("block", "held_out", "words", "at").mapInPandas(_ask_partition(buckets, False), _SUMS)
    m, overall = initial(tables, p)
    narrow = lambda m: Model(m.start.astype(np.float32), m.move.astype(np.float32), m.emit.astype(np.float32))
    known = Known(narrow(m), np.ones(k), float(PRIORS[0]), tables.weight, buckets)
    sums = stored(spark.createDataFrame([], _SUMS))
    for i in range(p.iterations if tables.end_count else 0):
        asked = _with_sums(training, sums).mapInPandas(_expect_blocks(known), _SUMS)
        if i == p.iterations - 1:
            asked = asked.union(asking)
        with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "8m"):  # a task holds few blocks
            before, sums = sums, stored(asked.groupBy("bucket").applyInPandas(_sum_bucket(buckets, k, n, tables.weight), _SUMS))
        discard(before)
        counts = np.zeros((n + k + 2 + len(_in_rows(PRIORS, k)), k))
        for r in sums.where("block = -1").select("words", "sums").collect():  # symbols and states rows of counts, and 3 or 4 of a bucket
            counts[np.frombuffer(r["words"], "<u8").astype(np.int64)] += np.frombuffer(r["sums"], "<f8").reshape(-1, k)
        total = counts[:n].sum(axis=0) + counts[n + k + 1]
        likely = counts[n + k + 2 :].ravel()[: len(PRIORS)] + left_out(counts[:n], tables.weight)
        prior = float(PRIORS[np.argmax(likely - np.log(total + PRIORS[:, None]) @ total)])
        norm = total + prior
        m = Model(_normal(counts[n] + 1e-3, 0), _normal(counts[n + 1 : n + 1 + k] + 1e-3, 1), (counts[:n] + prior * overall[:, None]) / norm)
        known = Known(narrow(m), norm, prior, tables.weight, buckets)
    known.model = m
    return known, sums


def score_texts(docs: DataFrame, p: HiddenMarkov = HiddenMarkov()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, held_out): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score, learned from the rows not held out.

    A null or empty text has its end token alone; a very long one is a sequence like any
    other.  Rows count one by one, whatever their ids.  If nothing is held back for
    training every word is unknown; no rows give no rows.  Further columns are left out.
    """
    training = docs.where("not held_out")
    counts = stored(token_counts(training))
    tables = tables_of(counts, training.count(), p)
    rows = sequences(docs, tables)
    buckets = word_buckets(rows)
    blocks = blocks_of(rows, tables, buckets)
    discard(counts)
    known, sums = train(blocks, tables, buckets, p)
    scores = stored(blocks.groupBy("block").cogroup(sums.where("block >= 0").groupBy("block")).applyInPandas(_score_block(known), _SCORES))
    discard(blocks, sums)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tables.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def scored(docs: DataFrame, p: HiddenMarkov = HiddenMarkov()) -> DataFrame:
    """``score_texts`` with remainder 2 of 7 held out; nulls, empty and very long texts,
    repeated rows, empty tables and further columns count as there."""
    return score_texts(docs.select("doc_id", "text", (fold(F.col("doc_id"), 7) == 2).alias("held_out")), p)

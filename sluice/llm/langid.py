"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  An n-gram is the product of its
letters' vectors, each shifted by its place (binding); a text is the sum of its
n-grams' vectors (bundling), and so is a language's prototype, over all its training
texts.  A text takes the language whose prototype has the highest cosine with it.

Letters are Unicode letters in lower case, other characters count as one blank
between words.  a-z have symbols of their own; other letters share the rest of a
fixed alphabet by their code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import give_back
from sluice.llm.tokens import blocks

ALPHABET = 128
#: Distinct languages of the training rows, beyond which training stops with an error: the
#: model holds a vector for each in every task.
MOST_LANGUAGES = 1000


@dataclass(frozen=True)
class Profiles:
    gram: int = 3
    dimensions: int = 1024
    seed: int = 5


class Bundler:
    """n-gram counts and bundled vectors of texts."""

    def __init__(self, p: Profiles):
        self.p = p
        rng = np.random.default_rng(p.seed)
        letters = (rng.integers(0, 2, size=(ALPHABET, p.dimensions), dtype=np.int8) * 2 - 1).astype(np.int8)
        self._shifted = [np.roll(letters, k, axis=1) for k in range(p.gram)]
        code = np.zeros(0x110000, np.int64)
        alphas = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        points = np.flatnonzero(alphas)
        code[points] = 27 + points % (ALPHABET - 27)
        code[ord("a") : ord("z") + 1] = np.arange(1, 27)
        self._code = code
        self._row: dict[int, int] = {}
        self._vectors = np.empty((1024, p.dimensions), np.int8)

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Distinct n-grams of a text and their counts; None if it has no letter."""
        codes = self._code[np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), np.uint32)]
        codes = codes[(codes[:] > 0) | np.concatenate(([True], codes[:-1] > 0))]  # runs of blanks are one
        if not codes.any():
            return None
        n = min(self.p.gram, len(codes))
        key = codes[: len(codes) - n + 1]
        for k in range(1, n):
            key = key * ALPHABET + codes[k : len(codes) - n + 1 + k]
        return np.unique(key, return_counts=True)

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """The bound vector of each n-gram."""
        row = self._row
        if len(row) > 40_000:
            row.clear()
        new = [g for g in grams.tolist() if g not in row]
        if new:
            first, end = len(row), len(row) + len(new)
            if end > len(self._vectors):
                self._vectors = np.resize(self._vectors, (end + end // 2, self.p.dimensions))
            g = np.array(new)
            bound = self._shifted[0][g % ALPHABET]
            for k in range(1, self.p.gram):
                g = g // ALPHABET
                bound = bound * self._shifted[k][g % ALPHABET]
            self._vectors[first:end] = bound
            row.update(zip(new, range(first, end), strict=True))
        return self._vectors[[row[g] for g in grams.tolist()]]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts.astype(np.float32) @ self.vectors(grams).astype(np.float32)


def _train_partition(p: Profiles):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundler, sums = Bundler(p), {}
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                texts = list(texts)
                for part in blocks(texts, 1_000_000):
                    found = [g for g in map(bundler.grams, texts[part]) if g]
                    if found:
                        grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                        counts = np.bincount(at, np.concatenate([c for _, c in found]))
                        sums[lang] = sums.get(lang, 0) + bundler.bundle(grams, counts).astype(np.float64)
        for lang, v in sums.items():
            yield pd.DataFrame({"lang": lang, "dimension": np.arange(p.dimensions), "value": v})
        del bundler
        give_back()

    return run


def train(labelled: DataFrame, p: Profiles = Profiles()) -> dict[str, np.ndarray]:
    """A unit prototype for each language of ``labelled`` (text, lang), from all its rows.
    Rows with a null text or lang teach nothing."""
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    sums = rows.mapInPandas(_train_partition(p), "lang string, dimension int, value double").groupBy("lang", "dimension").agg(F.sum("value").alias("value"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dimension", "value"))).alias("v")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    model = {r["lang"]: np.array([x["value"] for x in r["v"]]) for r in found}
    return {k: v / max(np.linalg.norm(v), 1e-300) for k, v in sorted(model.items())}


class _Scorer:
    """Language and score of one text."""

    def __init__(self, model: dict[str, np.ndarray], p: Profiles):
        self._bundler, self._names = Bundler(p), list(model)
        self._prototypes = np.array([model[k] for k in self._names]).T

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = self._bundler.grams(text)
        if found is None or not self._names:
            return "und", 0.0
        v = self._bundler.bundle(*found).astype(np.float64)
        cosine = v @ self._prototypes / max(np.linalg.norm(v), 1e-300)
        best = int(np.argmax(cosine))
        return self._names[best], float(min(1.0, max(0.0, cosine[best])))


def _predict_partition(model: dict[str, np.ndarray], p: Profiles):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(model, p)
        for pdf in batches:
            scored = [scorer(t) for t in pdf["text"]]
            yield pdf.drop(columns="text").assign(lang_pred=[x[0] for x in scored], score=[x[1] for x in scored])
        del scorer
        give_back()

    return run


def identify(docs: DataFrame, model: dict[str, np.ndarray], p: Profiles = Profiles()) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text).

    ``lang_pred`` is ``und`` with a score of 0 if the text is null or has no letter, or
    if nothing has been learned; a tie goes to the first language by name.  A very long
    text is read whole.  Rows count one by one, whatever their ids; no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = rows.mapInPandas(_predict_partition(model, p), "doc_id string, lang_pred string, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def identified(docs: DataFrame, p: Profiles = Profiles()) -> DataFrame:
    """``identify`` with a model learned from the labelled rows of ``docs`` outside the
    held-out fold (remainder 1 of 3); adds held_out.  Nulls, empty and very long texts,
    ties, repeated rows and empty tables count as there; further columns are left out."""
    model = train(docs.where(fold(F.col("doc_id"), 3) != 1), p)
    return identify(docs, model, p).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def language_stage(docs: DataFrame, p: Profiles = Profiles()) -> DataFrame:
    """The rows of ``docs`` that have a language, which are all with a letter if anything
    has been learned, with all their columns, whatever their names; a null ``lang`` is
    filled with the prediction.  Null and empty texts go; very long ones are read whole,
    repeated rows count one by one, and no rows give no rows."""
    model = train(docs.where(fold(F.col("doc_id"), 3) != 1), p)
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        scorer = _Scorer(model, p)
        for batch in batches:
            for at in range(0, len(batch), 500):  # few texts at a time as Python strings
                rows = batch.slice(at, 500)
                found = [scorer(t)[0] for t in rows.column(text).to_pylist()]
                filled = pc.coalesce(rows.column(lang), pa.array(found, rows.column(lang).type))
                rows = rows.set_column(lang, rows.schema.field(lang), filled)
                yield rows.filter(pa.array([x != "und" for x in found], pa.bool_()))
        del scorer
        give_back()

    # by place, as a name may hold dots
    placed = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return placed.mapInArrow(run, placed.schema).toDF(*docs.columns)

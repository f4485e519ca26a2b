"""Merkle manifest, vector codes and DivideSkip join against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import jaccard_join, merkle, vector_codes
from tests.llm import brute

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain_manifest(rows):
    """Sorted tuples of what ``tampered_manifest`` returns."""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    sources = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        trees[s].sort(key=lambda x: x[:3])
    built = {s: levels([x[2] for x in trees[s]]) for s in sources}
    top = levels([built[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for p, (_, _, digest, r) in enumerate(trees[s]):
            bad = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now, siblings = leaf((*r[:4], r[4].replace("\n", ""))) if bad else digest, []
            for tree, at in ((built[s], p), (top, k)):
                for nodes in tree[:-1]:
                    run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
                    siblings += run[: at % 3] + run[at % 3 + 1 :]
                    now = H(*run[: at % 3], now, *run[at % 3 + 1 :])
                    at //= 3
            out.append((r[0], digest, built[s][-1][0], top[-1][0], H(*siblings), now, now == top[-1][0]))
    return sorted(out, key=str)


def table(spark, rows, schema):
    """``rows`` with columns more whose names clash with inner ones."""
    return spark.createDataFrame(rows, schema).withColumn("leaf", F.lit("mine")).withColumn("tree", F.lit(1)).withColumn("_part", F.lit(2))


@pytest.mark.parametrize("unit", [1, 2, 6])
def test_manifest(spark, monkeypatch, unit):
    monkeypatch.setattr(merkle, "LEVELS", unit)  # levels a job: several jobs, one unit and several
    monkeypatch.setattr(merkle, "UNIT", 3**unit)
    rng = random.Random(unit)
    rows = [(i, rng.choice(["hot", "hot", "b", "ä", None]), rng.choice(["en", None]), rng.choice([3, None]), rng.choice(["a\nb", "x", "é\n", "", None])) for i in range(60)]
    rows += [(200, f"only {i}", "en", 1, "one\n") for i in range(4)] + [(None, "b", None, None, None)] * 2 + [(7, "b", "en", 1, "same id\n"), rows[5], rows[5]]
    rows.append((300, "long", "en", 9, "word \n" * 200_000))
    got = [tuple(r)[:7] for r in merkle.tampered_manifest(table(spark, rows, DOCS)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(got, key=str) == plain_manifest(rows)


def test_manifest_edges(spark):
    assert merkle.tampered_manifest(table(spark, [], DOCS)).count() == 0
    (one,) = merkle.manifest(table(spark, [(1, "a", "en", 1, "x")], DOCS)).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and bytes(one.proof) == b"" and one.proof_sha256 == H("")
    rows = [(i, "a", "en", i, f"text {i}") for i in range(10)]
    got = merkle.manifest(table(spark, rows, DOCS)).collect()
    assert all(merkle.folded(bytes.fromhex(r.leaf), bytes(r.proof)).hex() == r.root for r in got)
    forged = merkle.manifest(table(spark, rows, DOCS), offered=F.when(F.col("doc_id") == 4, F.lit("00" * 32))).collect()
    assert [r.doc_id for r in forged if not r.verified] == [4]
    other = merkle.manifest(table(spark, rows, DOCS), fields=("doc_id", "text")).first()
    assert other.root != got[0].root


def plain_codes(rows, entries=256, rounds=4):
    kept = [(i, np.array([int(np.floor(1024 * float(x))) for x in v]), label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    firsts = sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1].tolist()))[:entries]
    parts = [np.array([np.array_split(r[1], 4)[p] for r in kept]) for p in range(4)]
    books = [np.array([np.array_split(r[1], 4)[p] for r in firsts]) for p in range(4)]

    def assign():
        far = [((x[:, None, :] - c[None]) ** 2).sum(axis=2) for x, c in zip(parts, books, strict=True)]
        return [f.argmin(axis=1) for f in far], sum(f.min(axis=1) for f in far)

    for _ in range(rounds):
        codes, _ = assign()
        for x, c, k in zip(parts, books, codes, strict=True):
            for e in range(len(c)):
                if (k == e).any():
                    c[e] = x[k == e].sum(axis=0) // (k == e).sum()
    codes, error = assign()
    digest = hashlib.sha256(",".join(str(x) for c in books for x in c.ravel()).encode()).hexdigest()
    by_label = {}
    for r, e in zip(kept, error.tolist(), strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted(((r[0], "".join(f"{codes[p][j]:02x}" for p in range(4)), int(error[j]), by_label[r[2]], digest) for j, r in enumerate(kept)), key=str)


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("size", [4, 16, 18])
def test_vector_codes(spark, size):
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(9, size))
    rows = [(i, (centres[i % 9] + rng.normal(size=size) * (i % 3)).astype(np.float32).tolist(), int(i % 4) if i % 5 else None) for i in range(700)]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 1), (None, rows[7][1], None), (801, None, 1), (802, [None] * size, 1), (803, [float("inf")] * size, 1), (804, [float("nan")] * size, 1)]
    frame = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("mine")).withColumn("v", F.lit(1))
    got = [tuple(r) for r in vector_codes.coded_embeddings(frame).collect()]
    assert sorted(got, key=str) == plain_codes(rows)


def test_vector_code_edges(spark):
    few = [(i, [float(i), 0.5, -1.5, 2.0], 1) for i in range(3)]
    got = [tuple(r) for r in vector_codes.coded_embeddings(spark.createDataFrame(few, VECTORS)).collect()]
    assert sorted(got, key=str) == plain_codes(few)
    assert vector_codes.coded_embeddings(spark.createDataFrame([], VECTORS)).count() == 0
    nameless = vector_codes.coded_embeddings(spark.createDataFrame([(None, [1.0, 2.0, 3.0, 4.0], 1)], VECTORS)).collect()
    assert [(r.vec_id, r.code, r.error) for r in nameless] == [(None, None, None)]
    mixed = spark.createDataFrame([*few, (9, [1.0] * 8, 1), (10, [], 1)], VECTORS)
    assert {r.vec_id for r in vector_codes.coded_embeddings(mixed).collect() if r.code is None} == {9, 10}


def test_segment_bounds_never_exceed_distances():
    rng = np.random.default_rng(3)
    x, y = rng.integers(-3000, 3000, (40, 16)), rng.integers(-3000, 3000, (50, 16))
    exact = ((x[:, None] - y[None]) ** 2).sum(axis=2)
    before = np.zeros(exact.shape)
    for n in (1, 2, 4, 8, 16):
        bound = ((vector_codes.summaries(x, n)[:, None] - vector_codes.summaries(y, n)[None]) ** 2).sum(axis=2)
        assert (bound <= exact + 1e-3).all() and (bound >= before - 1e-3).all()
        before = bound
    assert np.allclose(before, exact)


WORDS = ["red", "Blue", "grün", "tree", "stone", "river", "cloud", "1", "x-y", "night"]


def near_copies(rng, base, n, most):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randrange(most + 1)):
            words[rng.randrange(len(words))] = "new" + str(rng.randrange(10**6))
        out.append(" ".join(words))
    return out


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))
    passage = prose(60)
    texts = [prose(rng.choice([1, 2, 3, 4, 6, 30, 120, 400])) for _ in range(60)]
    for base in (prose(30), prose(120), prose(500)):
        texts += near_copies(rng, base, 14, 8)
    texts += [f"{prose(20)} {passage} {prose(k)}" for k in (0, 1, 2, 5, 20, 60)] + [passage, passage.upper(), passage.replace(" ", "\n\t"), " ".join([passage] * 3)]
    texts += [texts[0], texts[70], "a b c d e", "a b c d e f", "a b", "A  B"]
    chain = [f"w{k}" for k in range(200)]
    texts += [" ".join(chain[k : k + 150]) for k in range(0, 40, 5)]  # each like the next alone
    return list(enumerate(texts))


@pytest.mark.parametrize(("members", "percent", "shingle"), [(1000, 85, 4), (6, 85, 4), (4, 60, 3), (5, 95, 2)])
def test_join(spark, monkeypatch, members, percent, shingle):
    monkeypatch.setattr(jaccard_join, "MEMBERS", members)  # few: groups are dealt in blocks
    monkeypatch.setattr(jaccard_join, "BROADCAST_SETS", members)
    rows = corpus(members)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("n", F.lit(1)).withColumn("block", F.lit("mine"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.joined(frame, jaccard_join.Join(shingle, percent)).collect()}
    want = brute.components(rows, shingle, percent)
    assert got == want and len({c for _, c in want.values()}) < len(rows) - 5


def test_join_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "one two three four five"), (5, "one two three four five"), (6, "dup dup"), (6, "dup dup"), (6, "other text here now"), (2**62 + 1, "other text here now"), (8, "long " * 300_000)]
    got = jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 2, 5), (5, 2, 5), (6, 1, 6), (6, 1, 6), (6, 1, 6), (2**62 + 1, 1, 6), (8, 1, 8)], key=str)
    assert jaccard_join.joined(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert jaccard_join.joined(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()[0].component_id == 1

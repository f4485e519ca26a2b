"""The corpus pipeline, its stages and edge cases of the operators, against plain versions."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import common, decontaminate, langid, near_dedup, packing, queries, secrets, sharding, token_files, tokens, vector_search, warc
from tests.llm import brute
from tests.llm.test_operators import EDGE, prose

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"
CLASH = ["_id", "_key", "_rules", "_spans", "spans", "rid", "_text", "_done", "_words", "a.b"]


def documents():
    rng = random.Random(12)
    base = [prose(rng, rng.choice([8, 30, 60, 150])) for _ in range(40)]
    bench = [(i, prose(rng, 40)) for i in range(4)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, base[i]) for i in range(5)]
    for i in range(8):
        w = base[7].split(" ")
        w[rng.randrange(len(w))] = f"changed{i}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300, base[1] + " " + bench[0][1]), (301, bench[1][1][:200] + " filler words here" * 400), (302, f"the password = hunter2222 is {'ab01' * 8} here"), (303, None), (304, ""), (305, "12 34 !?"), (306, " ".join(prose(rng, 4000).split()))]
    rows += [(None, "a text of no number at all, but words"), (307, "seven eight nine ten eleven"), (307, "seven eight nine ten eleven")]
    return [(i, t, rng.choice(["xx", "yy", None]), "s", None if t is None else len(t)) for i, t in rows], bench


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("tables"))
    docs, bench = documents()
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


def redacted(text):
    spans = sorted((m.start(), m.end()) for r in secrets.BASE + secrets.MORE for m in re.finditer(r.pattern, text or "", re.A) if len(m.group(r.group)) >= r.least)
    out, at = "", 0
    for a, b in spans:
        out += "" if a < at else text[at:a] + "[SECRET]"
        at = max(at, b)
    return text if not spans else out + text[at:]


def plain_stages(docs, bench):
    """(doc_id, text) after each of the first four stages."""
    kept = [(i, t) for i, t, *_ in docs if t and re.search(r"[^\W\d_]", t)]
    out = [kept]
    numbered = {(-1 if i is None else i): t for i, t in kept}
    least = brute.components(list(numbered.items()), 5, 80)
    kept = [(i, t) for i, t in kept if least[-1 if i is None else i][1] == (-1 if i is None else i)]
    out.append(kept)
    bad = {(i, t) for (i, t), r in zip(kept, brute.contamination(kept, bench), strict=True) if r[4]}
    kept = [x for x in kept if x not in bad]
    out.append(kept)
    out.append([(i, redacted(t)) for i, t in kept])
    return out


def packed_right(got, want, capacity=2048):
    from tokenizers import Tokenizer

    whole, pieces = Tokenizer.from_file(tokens.public_tokenizer_path()), []
    for i, t in want:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        pieces += [(i, k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(np.array(ids[k : k + capacity], "<u4").tobytes())) for k in range(0, len(ids), capacity)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(pieces, key=str)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity


def test_whole_run(spark, data):
    docs, bench = documents()
    packed_right(corpus_pipeline.run(spark, data).collect(), plain_stages(docs, bench)[-1])


def test_each_stage(spark, data):
    docs, bench = documents()
    frame = spark.read.parquet(f"{data}/documents.parquet")
    key = lambda rows: sorted(((r[0], r[1]) for r in rows), key=str)
    for (_, stage), want in zip(corpus_pipeline.STAGES[:4], plain_stages(docs, bench), strict=True):
        out = stage(spark, frame, data)
        assert out.columns == frame.columns and key(out.collect()) == key(want)
        assert stage(spark, frame.limit(0), data).count() == 0
        frame = common.stored(out)
    assert {r.n_chars == len(r.text) for r in frame.collect()} == {True} and frame.where("lang is null").count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, frame.limit(0), data).count() == 0


def test_clashing_names_stay(spark, data):
    plain = spark.read.parquet(f"{data}/documents.parquet")
    frame = plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in CLASH})
    bench = spark.read.parquet(f"{data}/benchmark.parquet").withColumn("_id", F.lit(1)).withColumn("words", F.lit(2))
    stages = [lambda d: decontaminate.decontaminate(d, bench), lambda d: decontaminate.decontaminate(d, bench, remove="spans"), near_dedup.near_dedup_stage, secrets.redact_stage, langid.language_stage]
    for stage in stages:
        out, want = stage(frame), stage(plain)
        assert out.columns == frame.columns
        rows = out.collect()
        assert sorted((str(r[0]), str(r[1])) for r in rows) == sorted((str(r[0]), str(r[1])) for r in want.collect())
        assert all(r[c] == c + ("" if r.doc_id is None else str(r.doc_id)) for r in rows for c in CLASH)
    assert "spans" in secrets.scan(frame).columns and secrets.scan(frame).columns.count("spans") == 1


def test_windows_past_the_broadcast(spark, data, monkeypatch):
    docs, bench = documents()
    want = sorted(brute.contamination([d[:2] for d in docs], bench), key=str)
    frame, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    for windows, anchors in ((0, 1000), (0, 0)):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", windows)
        monkeypatch.setattr(decontaminate, "BROADCAST_ANCHORS", anchors)
        got = decontaminate.contamination(frame, items).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in got), key=str) == want


def test_secrets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(secrets, "_BLOCK", 3)
    monkeypatch.setattr(secrets, "_LETTERS", 7)
    text = " é ".join(f"token=abcdef{i}00 {'ab01' * 6} x{i}" for i in range(20))
    frame = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "password: secret=token: abcdefgh")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in secrets.redact(frame).collect()} == {i: redacted(t) for i, t in [(1, text), (2, None), (3, ""), (4, "password: secret=token: abcdefgh")]}


def test_very_long_text(spark):
    """Over a million letters, through every operator on texts."""
    rng = random.Random(3)
    long = " ".join(prose(rng, 220_000).split())
    assert len(long) > 1_000_000
    item = " ".join(long.split()[150_000:150_020])
    near = long.replace(" the", " tha", 3)
    rows = [(1, long, "xx"), (2, near + " token=abcdef99", "xx"), (3, "short one here", "yy")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hit = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.contamination(frame, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert hit[1] == brute.contamination([(1, long)], [(1, item)])[0][1:3] and hit[3] == (3, 0)
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame).collect()} == {1: 1, 2: 1, 3: 3}
    assert {r.doc_id: r.text for r in secrets.redact(frame).collect()}[2] == redacted(rows[1][1])
    assert {r.doc_id: r.lang_pred for r in langid.identify(frame, langid.train(frame)).collect()}[1] == "xx"
    packed_right(packing.pack_documents(frame, tokens.public_tokenizer_path(), keep_ids=False).collect(), [r[:2] for r in rows])
    got = token_files.token_files(frame, tokens.public_tokenizer_path(), 1, bits=17).collect()
    encoder = tokens.ChunkEncoder(tokens.public_tokenizer_path())
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in ((i, np.append(encoder.encode(t), 1).astype("<u4")) for i, t, _ in rows)}
    assert {r.doc_id: r.size for r in sharding.shard_documents(frame, 2)[0].collect()} == {i: len(t.encode()) + 1 for i, t, _ in rows}
    from sluice.llm import hmm_lm

    p = hmm_lm.HiddenMarkov(states=2, iterations=1, symbols=20, classes=4, held_words=40)
    total, want = brute.unigram([r[:2] for r in rows], lambda i: brute.fold(i, 7) == 2)
    assert {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in hmm_lm.scored(frame, p).collect()} == {i: (*want[i][:2], total) for i in want}
    page = spark.createDataFrame([(1, "u", long), (2, "v", long)], "page_id long, url string, html string").withColumns({"digest": F.lit("x"), "_at": F.lit(1)})
    assert {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_pages(page).collect()} == {1: (len(long.encode()), "response", None), 2: (len(long.encode()), "revisit", 1)}


def test_shards_are_the_plain_deal(spark, monkeypatch):
    """Slots by hash and largest first to the lightest shard, by doc_id."""
    rng = random.Random(6)
    rows = [(i, "x" * rng.randrange(1, 400)) for i in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unit", F.lit(1))
    got, slot_map = sharding.shard_documents(frame, 4)
    slot = {i: xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) % 4096 if xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) < 2**63 else (xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42) - 2**64) % 4096 for i, _ in rows}
    sizes = dict.fromkeys(range(4096), 0)
    for i, t in rows:
        sizes[slot[i]] += len(t) + 1
    load, n, of = [0] * 4, [0] * 4, {}
    for k in sorted(sizes, key=lambda k: (-sizes[k], k)):
        s = min(range(4), key=lambda s: (load[s], n[s], s))
        of[k] = s
        load[s] += sizes[k]
        n[s] += 1
    assert {r.doc_id: (r.shard, r.size, r.text_crc32) for r in got.collect()} == {i: (of[slot[i]], len(t) + 1, zlib.crc32(t.encode())) for i, t in rows}
    assert len(slot_map.of) == 4096


def test_later_rows_follow_a_stored_map(spark):
    path = common.shared_dir(spark)
    few = spark.createDataFrame([(1, "a" * 50), (2, "b" * 70)] + [(5, "hot")] * 400, "doc_id long, text string")
    first, slot_map = sharding.shard_documents(few, 4, path)
    assert slot_map.split and first.count() == 402
    later = spark.createDataFrame([(i, "z" * (i % 90)) for i in range(500)] + [(5, "hot")] * 300, "doc_id long, text string")
    rows = sharding.place_documents(later, sharding.SlotMap.read(spark, path, 1)).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.place)
    assert len(rows) == 800 and all(sorted(p) == list(range(len(p))) for p in places.values())
    edited, second = sharding.shard_documents(later, 4, path, follow=1)
    assert second.version == 2 and edited.count() == 800 and slot_map.moved(second) < len(slot_map.of) / 2
    grown, third = sharding.shard_documents(later, 5, path, follow=2)
    assert third.version == 3 and grown.count() == 800 and set(third.of.values()) == set(range(5)) and second.moved(third) < len(second.of) / 2
    assert {v: sharding.SlotMap.read(spark, path, v).version for v in (1, 2, 3)} == {1: 1, 2: 2, 3: 3}
    missing = sharding.SlotMap(9, 4, {0: 0})
    with pytest.raises(Exception, match="not in the slot map"):
        sharding.place_documents(later, missing).collect()


def test_repeated_vectors_and_further_columns(spark):
    rows = [(0, [0.5, 0.5])] * 2 + [(1, [1.0, 1.0])] * 3 + [(2, [0.25, 1.0]), (3, [1.0, 0.25]), (50, [1.0, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit("x"), "vid": F.lit(1), "n": F.lit(2)})
    got = defaultdict(list)
    for r in vector_search.embedding_search(frame, k=4).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    x = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows]
    want = {}
    for q in (0, 50):
        best = sorted((-int(v @ next(w for i, w in x if i == q)), i) for i, v in x if i != q)[:4]
        want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(best)] * (2 if q == 0 else 1)
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}


def test_language_profiles_are_the_plain_ones(spark):
    """Binding, bundling and cosine rebuilt letter by letter."""
    rng, p = random.Random(2), langid.Profiles()
    rows = [(i, "".join(rng.choice("abcdeé  X,1") for _ in range(rng.choice([1, 5, 60]))), rng.choice(["p", "q", None])) for i in range(60)] + [(100, None, "p"), (101, "zzz", None)]
    letters = np.random.default_rng(p.seed).integers(0, 2, size=(128, p.dimensions), dtype=np.int8).astype(int) * 2 - 1

    def vector(text):
        codes = [0]
        for c in (text or "").lower() + " ":
            code = 0 if not c.isalpha() else ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 101
            if code or codes[-1]:
                codes.append(code)
        if not any(codes):
            return None
        return sum((np.roll(letters[codes[k + 2]], 0) * np.roll(letters[codes[k + 1]], 1) * np.roll(letters[codes[k]], 2) for k in range(len(codes) - 2)), np.zeros(p.dimensions))

    sums = defaultdict(lambda: np.zeros(p.dimensions))
    for i, t, lang in rows:
        if brute.fold(i, 3) != 1 and lang and vector(t) is not None:
            sums[lang] += vector(t)
    want = {}
    for i, t, _ in rows:
        v = vector(t)
        cosine = {k: v @ s / np.linalg.norm(s) / max(np.linalg.norm(v), 1e-300) for k, s in sorted(sums.items())} if v is not None else {"und": 0.0}
        best = max(cosine, key=cosine.get)
        want[i] = (best, max(0.0, cosine[best]))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identified(frame).collect()}
    assert {i: x[0] for i, x in got.items()} == {i: x[0] for i, x in want.items()} and all(abs(got[i][1] - want[i][1]) < 1e-6 for i in want)
    twins = spark.createDataFrame([(1, "abc abd", "n"), (2, "abc abd", "m"), (4, "abc", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in langid.identify(twins, langid.train(twins)).collect()} == {"m"}  # a tie goes to the first name


def test_registered_queries(spark, data):
    """The queries without SQL, with their own parameters, on a small table."""
    docs = [d[:2] for d in documents()[0]]
    packed_right(queries.op4_large_item_packing(spark, data).collect(), docs)
    encoder = tokens.ChunkEncoder(tokens.public_tokenizer_path())
    ids = {(i, t): np.append(encoder.encode(t), 1).astype("<u4") for i, t in docs}
    got = sorted(queries.op8_packed_token_files(spark, data).collect(), key=lambda r: r.start)
    start = 0
    for r, (i, t) in zip(got, sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids[i, t]), zlib.crc32(ids[i, t].tobytes()))
        start += r.n_tokens
    shards = queries.op3_virtual_slot_shards(spark, data).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32, r.law) for r in shards) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "bytes") for i, t in docs)
    total, want = brute.unigram(docs, lambda i: brute.fold(i, 7) == 2)
    for r in queries.op2_hidden_markov_scores(spark, data).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (*want[r.doc_id][:2], total, brute.fold(r.doc_id, 7) == 2) and abs(r.base_score - want[r.doc_id][2]) < 1e-6 * abs(want[r.doc_id][2]) and r.score < 0
    assert {(r.doc_id, r.lang_pred == "und") for r in queries.op6_hyperdimensional_language(spark, data).collect()} == {(i, not (t and re.search(r"[^\W\d_]", t))) for i, t in docs}

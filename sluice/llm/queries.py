"""The registered queries of the corpus operators, and SQL for those SQL can express.

Each ``opN_`` query runs its operator with production parameters over its whole
table and derives the returned columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import secrets, sql
from sluice.llm.common import read
from sluice.llm.decontaminate import contamination
from sluice.llm.hmm_lm import scored
from sluice.llm.langid import identified
from sluice.llm.jaccard_join import joined
from sluice.llm.merkle import tampered_manifest
from sluice.llm.near_dedup import NearDup, near_duplicates
from sluice.llm.packing import pack_documents
from sluice.llm.sharding import shard_documents
from sluice.llm.token_files import token_files
from sluice.llm.tokens import public_tokenizer_path
from sluice.llm.vector_codes import coded_embeddings
from sluice.llm.vector_search import embedding_search
from sluice.llm.warc import archive_pages


def op1_ngram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read(spark, sf_dir, "documents"))


def op3_virtual_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = shard_documents(read(spark, sf_dir, "documents"), 16)  # by the map as it is read again
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("unit").alias("virtual_slot"))


def op4_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizer_path(), keep_ids=False)


def op5_vector_approximation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_search(read(spark, sf_dir, "embeddings"))


def op6_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(read(spark, sf_dir, "documents"))


def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read(spark, sf_dir, "pages"))


def op8_packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(read(spark, sf_dir, "documents"), public_tokenizer_path(), end_id=1).drop("file")


def op9_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secrets.BASE + secrets.MORE
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"), rules)
    count = {r.kind: F.size(F.filter("spans", secrets.of_kind(k))).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(secrets.BASE)}
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    return found.select("doc_id", *count.values(), F.sha2(secrets.written(base, rules), 256).alias("base_sha256"), secrets.written(F.col("spans"), rules).alias("spans"))


def op10_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), NearDup(shingle=3, percent=85, bands=30, rows=6))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_manifest(read(spark, sf_dir, "documents")).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_segment_mean_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_embeddings(read(spark, sf_dir, "embeddings"))


def op13_divide_skip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_ngram_decontamination,
        op2_hidden_markov_scores,
        op3_virtual_slot_shards,
        op4_large_item_packing,
        op5_vector_approximation_search,
        op6_hyperdimensional_language,
        op7_arc_to_warc,
        op8_packed_token_files,
        op9_trigram_secret_scan,
        op10_odd_sketch_near_dedup,
        op11_merkle_manifest,
        op12_segment_mean_codes,
        op13_divide_skip_join,
    )
}
SQL: dict[str, str] = {
    "op1_ngram_decontamination": sql.OP1,
    "op5_vector_approximation_search": sql.OP5,
    "op7_arc_to_warc": sql.OP7,
    "op9_trigram_secret_scan": sql.OP9,
    "op10_odd_sketch_near_dedup": sql.OP10,
    "op11_merkle_manifest": sql.OP11,
    "op12_segment_mean_codes": sql.OP12,
    "op13_divide_skip_join": sql.OP13,


}

"""The numbered queries: each applies one operator to its whole table and derives
the digest columns of its contract."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm.bpe import decode_ids, encode_documents
from tontine.llm.conversation_repair import damaged, repair
from tontine.llm.filter_audit import audit, failures, quality_filters, with_labels
from tontine.llm.fingerprints import edited_neighbours
from tontine.llm.html_extraction import main_texts
from tontine.llm.license_scan import scan_licenses
from tontine.llm.minhash_dedup import near_groups
from tontine.llm.packing import pack
from tontine.llm.perspectives import rotate
from tontine.llm.secret_scan import KINDS, find_secrets
from tontine.llm.secret_scan import learn as learn_secrets
from tontine.llm.substring_dedup import remove_repeats
from tontine.llm.toxicity import THRESHOLD, held_out, learn, score
from tontine.llm.vector_dedup import near_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _sha(column) -> object:
    return F.sha2(F.encode(column, "UTF-8"), 256)


def op1_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95).withColumnRenamed("id", "vec_id")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, window=13).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", _sha(F.col("kept_text")).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = learn(docs, _table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(_table(spark, sf_dir, "conversations"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = find_secrets(docs, learn_secrets(docs))
    base = F.filter("secrets", lambda s: s["kind"].isin(*KINDS))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS], _sha(joined(base)).alias("base_sha256"),
                        joined("secrets").alias("spans"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = encode_documents(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode_ids(docs, path).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), _sha(ids).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(_table(spark, sf_dir, "documents"), percent=85)
    return groups.withColumnRenamed("id", "doc_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = edited_neighbours(_table(spark, sf_dir, "documents"))
    return pairs.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
                        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(_table(spark, sf_dir, "conversations")), absent_col="absent")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = failures(_table(spark, sf_dir, "documents"), quality_filters())
    return audit(with_labels(failed, _table(spark, sf_dir, "labels")), "ABCDE")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    found = found.withColumn("places", F.transform(base, lambda s: s["start"]))
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
                        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), "score")


QUERIES = {f.__name__: f for f in (op1_vector_dedup, op2_substring_dedup, op3_toxicity, op4_html_extraction, op5_perspectives, op6_secret_scan, op7_byte_bpe, op8_minhash_dedup, op9_packing, op10_fingerprints, op11_conversation_repair, op12_filter_audit, op13_license_scan)}

"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm import (align, bpe, classifier, decontaminate, fim, hilbert, langid, mih, packing,
                           prefix_counts, quality_rules, simhash, warc_zip)
from spendlake.llm.common import held_out, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


QUALITY_THRESHOLD = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> classifier.Model:
    """Learned from ``labels.quality`` of the documents that are not held out."""
    seen = labels.filter(~held_out("doc_id", 5, 0)).select("doc_id", F.col("quality").alias("label"))
    return classifier.fit(docs, seen)


@register("op1_quality_classifier")
def _quality(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    model = quality_model(docs, read_table(spark, d, "labels"))
    scored = classifier.with_score(docs, model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@register("op2_bpe_round_trip")
def _bpe(spark: SparkSession, d: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, d, "documents"))


@register("op3_quality_rules")
def _rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, d, "documents"))


@register("op4_hilbert_sharding")
def _shards(spark: SparkSession, d: str) -> DataFrame:
    return hilbert.assign(read_table(spark, d, "documents"), shards=8)


@register("op5_prefix_token_counts")
def _counts(spark: SparkSession, d: str) -> DataFrame:
    return prefix_counts.count_tokens(read_table(spark, d, "documents"), limit=512)


@register("op6_benchmark_decontamination")
def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))


@register("op7_packed_token_ids")
def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(read_table(spark, d, "documents"), length=2048)


@register("op8_language_id")
def _language(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id", "text", "lang")
    out = held_out("doc_id", 4, 2)
    model = langid.fit(docs.filter(~out))
    found = langid.predict(F.col("text"), model, spark)
    return docs.select("doc_id", out.alias("held_out"), found.alias("p")).select("doc_id", "held_out", "p.*")


@register("op9_warc_zip")
def _warc(spark: SparkSession, d: str) -> DataFrame:
    return warc_zip.round_trip(read_table(spark, d, "pages"), min_revisit_bytes=0)


@register("op10_simhash_near_dedup")
def _simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, d, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


@register("op11_fill_in_middle")
def _fim(spark: SparkSession, d: str) -> DataFrame:
    made = fim.transform(read_table(spark, d, "documents"))
    digests = [F.sha2(c.cast("binary"), 256).alias(name) for c, name in (
        (F.col("output"), "output_sha256"), (fim.restore(F.col("output"), F.col("form")), "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@register("op13_cross_tokenizer_alignment")
def _align(spark: SparkSession, d: str) -> DataFrame:
    groups = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    aligned = align.align(read_table(spark, d, "documents"))
    return align.score(aligned.select("doc_id", "n_a", "n_b", "n_groups", groups.alias("groups_sha256"), "links"))


@register("op12_multi_index_hashing")
def _nearest(spark: SparkSession, d: str) -> DataFrame:
    vectors = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    queries = vectors.filter(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "query_id")
    return mih.search(mih.build(vectors), queries, k=20)

"""The corpus pipeline: quality, cleaning, near-duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir), works on everything that the stage
before kept, and is written as Parquet and read again for the next one.  All
but the last return the columns of ``documents``.

* quality_classifier: learned from ``labels.quality`` of the documents that
  are not held out; documents scoring under 0.3 go.
* quality_rules: failing lines go (and ``n_chars`` is recounted), documents
  failing the base rules or losing too much text go.
* near_dedup: of each group linked by fingerprints at 2 or fewer differing
  bits, the document with the smallest id stays.
* decontaminate: documents holding a ``benchmark`` item go, also those without
  an id; other documents under the same id stay.
* tokenize: token ids and digests of each remaining document.

Defined cases: an empty table passes every stage with no rows; null and empty
texts have under 50 words and go in the second stage; a null doc_id is kept
where its document stands for its group; repeated rows leave one row after
the third stage; further columns are kept, whatever their names; texts are
worked on whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm import bpe, classifier, decontaminate, quality_rules, simhash
from spendlake.llm.common import cut, read_table, unused
from spendlake.llm.queries import QUALITY_THRESHOLD, quality_model

#: SQL can express neither the classifier nor XXH64, Smith-Waterman and BPE.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    scored = classifier.with_score(docs, model, score)
    return scored.filter(F.col(score) >= QUALITY_THRESHOLD).drop(score)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_group(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"), null_ids=True)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules_stage),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

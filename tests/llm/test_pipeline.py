import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from spendlake.llm import classifier, quality_rules, tokens
from spendlake.llm import decontaminate as dc
from spendlake.llm.queries import QUALITY_THRESHOLD, quality_model

from .fixtures import SF, odd_docs, table
from .test_decontaminate import word_ids
from .test_simhash import brute_components, brute_fingerprint

ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.load_ranks(),
                             special_tokens={})


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


def test_rows_equal_brute_force(spark):
    docs = table(spark, "documents")
    model = quality_model(docs, table(spark, "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = list(texts)
    z = classifier.dots(model.weights, [texts[k] for k in ids], model.bits) + model.bias
    texts = {k: texts[k] for k, v in zip(ids, z, strict=True) if 1 / (1 + 2.718281828459045 ** -v) >= QUALITY_THRESHOLD}
    judge = quality_rules.Judge(quality_rules.Rules())
    judged = {k: judge(t, True) for k, t in texts.items()}
    texts = {k: v[-1] for k, v in judged.items() if v[6]}
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    texts = {k: texts[k] for k, c in brute_components(prints).items() if k == c}
    known = {}
    items = [word_ids(r["text"], known) for r in table(spark, "benchmark").collect()]
    texts = {k: t for k, t in texts.items()
             if not any(dc.align(i, w)[0] >= 0.5 for w in [word_ids(t, known)] for i in items if len(w))}
    want = {k: ENCODING.encode_ordinary(t) for k, t in texts.items()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == want
    assert len(rows) == len(want) and all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_each_stage_keeps_columns_and_takes_odd_rows(spark):
    good = " ".join(f"w{k}" for k in range(80)) + "."
    texts = [(1, good, "en", "a"), (1, good, "en", "a"), (2, good + " more.", "en", "a"), (None, good[1:], None, None),
             (3, None, "en", "a"), (4, "", "en", "a"), (5, " ".join(f"v{k}" for k in range(20000)) + ".", "en", "a")]
    docs = odd_docs(spark, texts).withColumn("p", F.lit(None).cast("string"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= len(texts)
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).select("doc_id").collect()]
    assert kept.count(1) == 1 and 5 in kept and len([k for k in kept if k in (3, 4)]) == 1
    clean = [r["doc_id"] for r in corpus_pipeline.quality_rules_stage(spark, docs, SF).select("doc_id").collect()]
    assert sorted(map(str, clean)) == ["1", "1", "2", "5", "None"]
    assert corpus_pipeline.tokenize(spark, docs, SF).count() == len(texts)


def test_leaks_without_an_id_go(spark):
    item = table(spark, "benchmark").first()["text"]
    words = " ".join(f"w{k}" for k in range(80))
    docs = odd_docs(spark, [(1, words, "en", "a"), (2, f"{words} {item}", "en", "a"), (None, words, "en", "a"),
                            (None, f"{item} {words}", "en", "a"), (None, None, "en", "a")])
    kept = corpus_pipeline.decontamination(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(
        str(x) for x in [(1, words), (None, words), (None, None)])


def test_empty_table_passes_every_stage(spark):
    docs = table(spark, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_internal_names_as_extra_columns(spark):
    """Every name that a stage uses for itself, as a column of the documents: kept with its values."""
    names = ["__id", "__label", "__score", "__print", "__fp", "__row", "__leaked", "key", "id", "label", "fp", "row",
             "score", "digest", "words", "grams", "item"]
    good = " ".join(f"w{k}" for k in range(80)) + "."
    docs = spark.createDataFrame([(1, good, "en", "a", len(good)), (1, good + " more", "en", "a", 5)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for n in names:
        docs = docs.withColumn(n, F.lit(n))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert all(r[n] == n for r in out.collect() for n in names)
    assert corpus_pipeline.tokenize(spark, docs, SF).count() == 2

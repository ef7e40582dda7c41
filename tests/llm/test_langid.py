import math
import re
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from spendlake.llm import langid
from spendlake.llm.common import held_out
from spendlake.llm.queries import QUERIES

from .fixtures import SF001, odd_docs, table


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in table(spark, "documents", SF001).collect()}
    rows = QUERIES["op8_language_id"](spark, SF001).collect()
    assert len(rows) == len(docs)
    langs = {r["lang"] for r in docs.values()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in langs and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97
    sure = [r for r in held if not r["rejected"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in sure]) > 0.98


def test_sizes_decide():
    model = langid.Model((("a", b"alpha beta gamma delta " * 40), ("b", b"uno dos tres quatro " * 40)))
    assert langid.classify("Alpha, BETA and gamma: delta 12", model)[0] == "a"
    lang, score, margin, rejected = langid.classify("uno dos tres quatro uno tres", model)
    assert lang == "b" and score > 0.9 and margin > 0.1 and not rejected
    tie = langid.classify("zzz", langid.Model((("a", b"same words here"), ("b", b"same words here"))))
    assert tie == ("a", 0.5, 0.0, True)


def plain_sizes(text, dictionaries, level, block):
    """Compressed sizes by the library's plain calls, a new dictionary for every block."""
    kept = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower())
    body = " ".join(re.split(r"[ ]+", kept)).strip(" ").encode("utf-8")
    blocks = [body[k:k + block] for k in range(0, len(body), block)] or [b""]
    sizes = {}
    for lang, content in dictionaries:
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        sizes[lang] = sum(len(zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False,
                                                       write_dict_id=False).compress(b)) for b in blocks)
    return sizes


def test_query_equals_plain_zstandard(spark):
    docs = table(spark, "documents", SF001)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = langid.fit(docs.filter(~held_out("doc_id", 4, 2)))
    rows = QUERIES["op8_language_id"](spark, SF001).collect()
    chosen = [r for r in rows if r["doc_id"] % 3 == 0]
    assert len(chosen) > 20
    for r in chosen:
        text = texts[r["doc_id"]]
        if not any(map(str.isalpha, text or "")):
            assert r["lang_pred"] == "und"
            continue
        sizes = plain_sizes(text, model.dictionaries, model.level, model.block_bytes)
        two = sorted(sizes.values())[:2]
        assert sizes[r["lang_pred"]] == two[0]
        margin = (two[1] - two[0]) / two[1]
        assert abs(r["score"] - 1 / (1 + math.exp(-margin / 0.02))) < 1e-12
        assert r["rejected"] == (margin < model.min_margin)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    model = langid.fit(docs)
    rows = docs.select("doc_id", "text", langid.predict(F.col("text"), model, spark).alias("p")).select(
        "doc_id", "text", "p.*").collect()
    assert len(rows) == docs.count()
    for r in rows:
        lettered = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] != "und") == lettered
        assert r["lang_pred"] in ("en", "de", "fr", "a", "und")


def test_copies_do_not_push_distinct_texts_out(spark):
    def word(k):
        return "w" + "".join(chr(97 + int(c)) for c in f"{k:04d}")

    rows = [(f"{word(k)} text", "a") for k in range(1000)] + [(f"{word(k)} other", "b") for k in range(300)]
    copies = spark.range(200_000).select(F.lit("one text repeated").alias("text"),
                                         F.when(F.col("id") < 150_000, "a").otherwise("b").alias("lang"))
    docs = spark.createDataFrame(rows, "text string, lang string").union(copies).repartition(3)
    model = dict(langid.fit(docs, dictionary_bytes=1 << 20).dictionaries)
    assert list(model) == ["a", "b"]
    known = model["a"].count(b"repeated")
    assert known <= 1 and len({w for w in model["a"].split() if w.startswith(b"w")}) == 400 - known
    assert model["b"].count(b"repeated") == 1
    assert len({w for w in model["b"].split() if w.startswith(b"w")}) == 300


def test_every_language_is_learned(spark):
    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(600)]
    rows = [(" ".join(f"{n}{x}{n}" for x in "qzjkvwxy"), n) for n in names]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = langid.fit(docs)
    assert sorted(n for n, _ in model.dictionaries) == names
    got = docs.select("lang", langid.predict(F.col("text"), model, spark).alias("p")).collect()
    assert len(got) == 600 and all(r["p"]["lang_pred"] == r["lang"] for r in got)


def test_nothing_to_learn_from(spark):
    docs = odd_docs(spark)
    model = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    got = {r["p"]["lang_pred"] for r in docs.select(langid.predict(F.col("text"), model, spark).alias("p")).collect()}
    assert got == {"und"}
    empty = odd_docs(spark, [])
    assert empty.select(langid.predict(F.col("text"), langid.fit(empty), spark)).count() == 0

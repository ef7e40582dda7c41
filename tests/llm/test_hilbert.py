import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlake.llm import hilbert
from spendlake.llm.queries import QUERIES

from .fixtures import SF, TEXTS, odd_docs, table


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 1), (2, 5), (3, 1), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_law(rows, texts, shards):
    assert len(rows) == len(texts)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    assert set(counts) <= set(range(shards))
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["hilbert"], r["size"], r["text_crc32"], r["doc_id"] is not None, r["doc_id"] or 0) for r in ordered]
    assert keys == sorted(keys)


def test_query_keeps_the_law(spark):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    check_law(QUERIES["op4_hilbert_sharding"](spark, SF).collect(), texts, 8)


def test_odd_rows(spark):
    check_law(hilbert.assign(odd_docs(spark), 8).collect(), [(d, t) for d, t, *_ in TEXTS], 8)
    few = odd_docs(spark, TEXTS[:3])
    check_law(hilbert.assign(few, 8).collect(), [(d, t) for d, t, *_ in TEXTS[:3]], 8)
    assert hilbert.assign(odd_docs(spark, [])).count() == 0


def test_one_crowded_cell_is_cut_into_even_shards(spark):
    same = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"),
                                    F.lit("en").alias("lang"), F.lit("s").alias("source"))
    check_law(hilbert.assign(same, 7).collect(), [(k, "same text") for k in range(5000)], 7)


def test_rows_equal_in_all_are_cut_into_even_shards(spark):
    same = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    check_law(hilbert.assign(same, 7).collect(), [(7, "same text")] * 5000, 7)


def test_runs_cut_equal_rows_and_keep_clashing_columns(spark, tmp_path):
    same = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text"),
                                    F.lit("en").alias("lang"), F.lit("s").alias("source"),
                                    F.lit(1).alias("__hilbert"), F.lit(2).alias("__size"), F.lit(3).alias("__row"))
    hilbert.write_runs(same, str(tmp_path / "runs"), 8)
    written = spark.read.parquet(str(tmp_path / "runs"))
    assert written.columns == same.columns and written.exceptAll(same).count() == 0 == same.exceptAll(written).count()
    sizes = [r["rows"] for r in hilbert.run_bounds(spark, str(tmp_path / "runs")).collect()]
    assert sum(sizes) == 4000 and len(sizes) > 4 and max(sizes) < 1500


def test_files_are_pruned_and_nothing_is_lost(spark, tmp_path):
    docs = table(spark, "documents")
    hilbert.write_runs(docs, str(tmp_path / "runs"), 16)
    bounds = hilbert.run_bounds(spark, str(tmp_path / "runs")).cache()
    assert bounds.agg(F.sum("rows")).first()[0] == docs.count()
    written = spark.read.parquet(str(tmp_path / "runs"))
    assert written.columns == docs.columns and written.exceptAll(docs).count() == 0
    by_file = defaultdict(list)
    for r in written.withColumn("file", F.col("_metadata.file_path")).collect():
        by_file[r["file"]].append(r)
    for args, match in (({"lang": "de"}, lambda r: r["lang"] == "de"),
                        ({"size": (1, 300)}, lambda r: len(r["text"].encode()) + 1 <= 300),
                        ({"source": "src3", "lang": "en"}, lambda r: r["source"] == "src3" and r["lang"] == "en")):
        chosen = {r["file"] for r in hilbert.files_to_read(bounds, **args).collect()}
        assert {f for f, rows in by_file.items() if any(map(match, rows))} <= chosen
        assert len(chosen) < len(by_file)

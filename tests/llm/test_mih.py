import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlake.llm import mih
from spendlake.llm.queries import QUERIES

from .fixtures import CLASHING, SF, SF001, table

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, x, k, is_query):
    """{query: [(vec_id, score)]} by every inner product."""
    x = np.asarray(x, np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(is_query):
        scores = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items()) / max(
        1, sum(map(len, want.values())))


@pytest.mark.parametrize("sf", [SF001, "/root/testdata/sf0.1"])
def test_query_recall_and_exact_scores(spark, sf):
    rows = table(spark, "embeddings", sf).orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows])
    want = brute(ids, x, 20, ids % 20 == 0)
    got = by_query(QUERIES["op12_multi_index_hashing"](spark, sf))
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.93
    x = x.astype(np.float32).astype(np.float64)
    at = {int(v): k for k, v in enumerate(ids)}
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda r: (-r[1], r[0]))
        assert all(abs(s - float(x[at[q]] @ x[at[v]])) < 1e-12 and v != q for v, s in found)


def test_probing_retrieves_every_code_within_any_radius():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, (12, 2), dtype=np.uint64)
    codes = base[rng.integers(0, 12, 3000)]
    flips = rng.integers(0, 128, (3000, 12))
    for k in range(3000):
        for f in flips[k, :rng.integers(0, 12)]:
            codes[k, f // 64] ^= np.uint64(1) << np.uint64(f % 64)
    shard = mih.ShardIndex(np.arange(3000), np.zeros((3000, 1)), codes)
    far = np.bitwise_count(base[:, None, :] ^ codes[None, :, :]).sum(axis=2)
    for radius in (0, 1, 5, 7, 8, 15, 16, 23, 40, 64, 100, 128):
        q, row = shard.within(base, radius)
        assert set(zip(q.tolist(), row.tolist())) == set(zip(*(i.tolist() for i in np.nonzero(far <= radius))))
        assert not (shard.probe(base, radius) < (far <= radius)).any()
    assert shard.probe(base, 7).mean() < 0.3  # a small radius reads few rows


@pytest.mark.parametrize("radius", [0, 1, 7, 8, 31, 105])
@pytest.mark.parametrize("substrings", [4, 8, 16])
def test_pigeonhole_shares(radius, substrings):
    shares = mih.substring_radii(radius, substrings)
    assert sum(s + 1 for s in shares) == radius + 1  # one bit less in each share could hide radius bits, no more


def test_odd_rows(spark):
    rng = np.random.default_rng(9)
    good = [(k, rng.standard_normal(6).astype(np.float32).tolist()) for k in range(60)]
    good[41] = (41, good[20][1])  # ties
    good[43] = (43, [v * 50 for v in good[20][1]])  # by inner product, not by angle
    odd = [(100, None), (120, [0.0] * 6), (140, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (160, [float("nan")] * 6),
           (180, [float("inf")] + [0.0] * 5), (200, [1.0] * 5), (220, []), (None, [1.0] * 6), (None, None),
           (20, good[20][1]), (21, [-9.0] * 6), (-20, [3.0] * 6)]
    df = spark.createDataFrame(good + odd, SCHEMA)
    for k, c in enumerate([*CLASHING, "code", "part", "asks", "query_id", "dice", "dim", "n"]):
        df = df if c in df.columns else df.withColumn(c, F.lit(f"extra{k}"))
    kept = dict(good) | {-20: [3.0] * 6}
    kept[21] = max(kept[21], np.float32([-9.0] * 6).tolist())
    ids = np.array(sorted(kept))
    want = brute(ids, [kept[i] for i in ids], 20, ids % 20 == 0)
    queries = df.filter("vec_id % 20 = 0").drop("query_id").withColumnRenamed("vec_id", "query_id")
    for recall_wanted in (0.97, 0.2):  # a small radius finds too few, and is widened
        got = by_query(mih.search(mih.build(df, bits=128), queries, k=20, target_recall=recall_wanted, min_shards=3))
        assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}
        assert recall_wanted < 0.9 or recall(got, want) >= 0.9
    whole = mih.search(mih.build(df, bits=128), queries, k=70, min_shards=3)  # fewer candidates than k: all, exactly
    want = brute(ids, [kept[i] for i in ids], 70, ids % 20 == 0)
    got = by_query(whole)
    assert {q: [v for v, _ in r] for q, r in got.items()} == {q: [v for v, _ in r] for q, r in want.items()}


@pytest.mark.parametrize("rows", [[], [(20, None)], [(20, [1.0, 2.0])], [(7, [1.0, 2.0]), (8, [1.0, 1.0])]])
def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = mih.search(mih.build(df), df.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0


def test_a_crowd_of_equal_vectors(spark):
    """A third of the rows hold one vector: the smallest ids of the crowd are found, in every shard layout."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] = x[0]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], SCHEMA).repartition(5)
    queries = df.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    want = brute(np.arange(3000), x, 20, np.arange(3000) % 20 == 0)
    for shard_rows, per_task in ((1 << 16, 1 << 18), (500, 40)):
        got = by_query(mih.search(mih.build(df), queries, shard_rows=shard_rows, min_shards=2, queries_per_task=per_task))
        assert recall(got, want) >= 0.9
        for q in range(0, 3000, 60):
            assert [v for v, _ in got[q]] == [v for v, _ in want[q]]

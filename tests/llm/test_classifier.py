import math
import zlib

import numpy as np
import pytest

from spendlake.llm import classifier
from spendlake.llm.queries import QUERIES

from .fixtures import SF001, TEXTS, odd_docs, table


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op1_quality_classifier"](spark, SF001).collect()}
    assert len(rows) == table(spark, "documents", SF001).count()
    for k, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    labels = [(rows[r["doc_id"]], r["quality"]) for r in table(spark, "labels", SF001).collect()]
    held = [(r["predicted"], q) for r, q in labels if r["held_out"]]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.95


def test_dots_equal_one_text_at_a_time():
    weights = np.random.default_rng(0).normal(size=1 << 12).astype(np.float32)
    texts = [t for _, t, *_ in TEXTS] + ["a b a b", "b a"]
    together = classifier.dots(weights, texts, 12)
    alone = np.concatenate([classifier.dots(weights, [t], 12) for t in texts])
    assert np.allclose(together, alone)
    for t, got in zip(texts, together, strict=True):
        slots, counts, n = classifier.features([t], 12)
        assert math.isclose(got, classifier.SCALE * sum(map(float, weights[slots])) / max(n[0], 1), abs_tol=1e-6)


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    raw = np.frombuffer(b"alpha beta alpha gamma beta", np.uint8)
    starts, ends = np.array([0, 6, 11, 17, 23]), np.array([5, 10, 16, 22, 27])
    h = classifier.word_hashes(raw, starts, ends)
    assert h[0] == h[2] and h[1] == h[4] and len(set(h.tolist())) == 3
    for size in (1, 7, 12):
        monkeypatch.setattr(classifier, "SEGMENT_BYTES", size)
        assert classifier.word_hashes(raw, starts, ends).tolist() == h.tolist()


def test_ftrl_separates():
    learner = classifier.Ftrl(4)
    for _ in range(20):
        learner.update(np.array([1, 16]), np.array([4.0, 1.0]), 1)
        learner.update(np.array([2, 16]), np.array([4.0, 1.0]), 0)
    w = learner.weights()
    assert w[1] > 0 > w[2]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, None), (None, 1), (77, 0), (5, 1), (7, 0)],
                                   "doc_id long, label int")
    model = classifier.fit(docs, labels)
    rows = classifier.with_score(docs, model, "s").collect()
    assert len(rows) == docs.count()
    bias = 1 / (1 + math.exp(-model.bias))
    assert all(abs(r["s"] - bias) < 1e-9 for r in rows if not r["text"])
    again = classifier.fit(docs.repartition(2), labels)
    assert np.allclose(again.weights, model.weights) and math.isclose(again.bias, model.bias)


def test_no_labels_and_no_documents(spark):
    docs = odd_docs(spark)
    model = classifier.fit(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert {r["s"] for r in classifier.with_score(docs, model, "s").collect()} == {0.5}
    empty = odd_docs(spark, [])
    model = classifier.fit(empty, spark.createDataFrame([(1, 1)], "doc_id long, label int"))
    assert classifier.with_score(empty, model, "s").count() == 0


def plain_ftrl(rows, bits, epochs):
    """The updates written out, one slot at a time, on dictionaries."""
    z, n = {}, {}
    alpha, beta, l1, l2 = 0.5, 0.1, 0.001, 0.01

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for features, label in rows:
            p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in features.items())))
            before = {i: weight(i) for i in features}
            for i, v in features.items():
                g = (p - label) * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * before[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_ftrl_equals_the_plain_updates():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        slots = rng.choice(30, size=rng.integers(1, 8), replace=False)
        rows.append(({**{int(s): float(v) for s, v in zip(slots, rng.uniform(0, 3, len(slots)))}, 32: 1.0},
                     int(slots.min() % 2)))
    learner = classifier.Ftrl(5)
    for _ in range(3):
        for features, label in rows:
            learner.update(np.array(list(features)), np.array(list(features.values())), label)
    want = plain_ftrl(rows, 5, 3)
    got = learner.weights()
    assert all(math.isclose(got[i], w, abs_tol=1e-9) for i, w in want.items()) and max(map(abs, want.values())) > 0.1


def test_copies_of_a_labelled_row_change_nothing(spark):
    docs = [(k, f"text number {k} " + ("good words here" if k % 2 else "bad stuff there !!"), "x") for k in range(40)]
    labels = [(k, k % 2) for k in range(40)]
    names = "doc_id long, text string, __id string"
    once = classifier.fit(spark.createDataFrame(docs, names), spark.createDataFrame(labels, "doc_id long, label int"))
    many = classifier.fit(spark.createDataFrame(docs + [docs[3]] * 3000, names).repartition(7),
                          spark.createDataFrame([labels[3]] * 500 + labels[::-1], "doc_id long, label int"))
    assert np.array_equal(once.weights, many.weights) and once.bias == many.bias and np.abs(once.weights).max() > 0


def test_an_id_with_many_texts_is_sampled(spark):
    docs = spark.range(4000).selectExpr("7L as doc_id", "concat('text ', id) as text")
    labels = spark.createDataFrame([(7, 1)], "doc_id long, label int")
    model = classifier.fit(docs, labels, max_rows=100)
    assert model.bias > 0 and np.count_nonzero(model.weights) < 1200  # some 100 texts, not 4,000


@pytest.mark.parametrize("name", ["__id", "__label", "__score", "id", "label", "key", "text1", "shard"])
def test_clashing_names(spark, name):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c d", "y")], f"doc_id long, text string, {name} string")
    model = classifier.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int"))
    assert classifier.with_score(docs, model, "s").columns == ["doc_id", "text", name, "s"]

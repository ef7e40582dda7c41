"""Quality classifier: logistic regression on hashed word n-grams, FTRL-proximal training.

Features.  Words are runs of non-white-space (ASCII white space) of the UTF-8
text.  Hashed into 2 ** ``bits`` slots: each word, each pair of neighbours,
and one to three neighbouring word shapes (which classes of bytes a word
holds, and whether it repeats the word before).  A text's value at a slot is
its share of the text's words, times ``SCALE``; its score is the logistic
function of the sparse dot product with the weights, plus a bias.  Only the
text goes in.

Training.  A sample of about ``max_rows`` distinct labelled texts (id, text and
label; by a hash; the bound is this parameter) is featurised on the workers and
dealt to ``SHARDS`` learners.  Each runs ``epochs`` passes of
follow-the-regularised-leader updates in the order of a hash of id and text,
and the weights are averaged.  The driver holds SHARDS weight vectors of fixed
size and nothing else.

Defined cases: a null, empty or white-space text scores the bias alone; null
labels and labels without a document are ignored; repeated rows of documents or
labels train once, so copies of a row neither fill a learner nor change its
order; with no labels every score is 0.5; an empty table gives no rows; columns
other than doc_id and text, whatever their names, are ignored, and kept by
``with_score``.  A very long text is held whole, with one hash a word and kind.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import cut, release_memory, slices, with_results

SCALE = 16.0
SHARDS = 4
BLOCK_BYTES = 1 << 20
SEGMENT_BYTES = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd: it has an inverse modulo 2 ** 64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_REPEAT = 128  # shape bit: the same word as the one before


def _shape_classes() -> np.ndarray:
    out = np.full(256, 64, np.uint8)  # bytes of other scripts and accents
    out[:128] = 32  # other ASCII signs
    out[ord("a"):ord("z") + 1] = 1
    out[ord("A"):ord("Z") + 1] = 2
    out[ord("0"):ord("9") + 1] = 4
    out[[ord(c) for c in ".,;:'\"()-"]] = 8
    out[[ord(c) for c in "!?"]] = 16
    return out


_CLASSES = _shape_classes()
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


@functools.lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each raw[start:end], from running sums over the bytes.

    The bytes are taken in segments that end with a word, so the tables of
    powers stay small however long a text is."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        upto = max(int(np.searchsorted(ends, base + SEGMENT_BYTES, side="right")), at + 1)
        part = raw[base:int(ends[upto - 1])]
        bits = (len(part) + 1).bit_length()
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(_INVERSE, bits)[:len(part)], out=total[1:])
        first, last = starts[at:upto] - base, ends[at:upto] - base
        out[at:upto] = (total[last] - total[first]) * _powers(_MULTIPLIER, bits)[last]
        at = upto
    return _mix(out)


def features(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all texts one after the other, the number of slots of each, and its number of words."""
    coded = [(t or "").encode("utf-8") + b"\n" for t in texts]
    raw = np.frombuffer(b"".join(coded), np.uint8)
    space = _WHITE[raw]
    before = np.concatenate(([True], space[:-1]))
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    text_ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))
    words_upto = np.searchsorted(starts, text_ends)
    n_words = np.diff(words_upto, prepend=0)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64), n_words
    word = word_hashes(raw, starts, ends)
    text_of = np.repeat(np.arange(len(texts)), n_words)
    shape = np.bitwise_or.reduceat(_CLASSES[raw] * ~space, starts).astype(np.uint64)
    follows = np.zeros(len(word), bool)
    follows[1:] = text_of[1:] == text_of[:-1]
    shape[1:] |= np.where(follows[1:] & (word[1:] == word[:-1]), np.uint64(_REPEAT), np.uint64(0))
    third = follows.copy()
    third[1:] &= follows[:-1]
    one = shape + np.uint64(1 << 20)
    kinds = [(word, np.ones(len(word), bool)), (one, np.ones(len(word), bool))]
    pair, two = word.copy(), one.copy()
    pair[1:] += word[:-1] * np.uint64(3)
    two[1:] += one[:-1] << np.uint64(9)
    three = two.copy()
    three[2:] += one[:-2] << np.uint64(18)
    kinds += [(pair, follows), (two + np.uint64(1 << 40), follows), (three + np.uint64(1 << 50), third)]
    slots = np.stack([_mix(_mix(k + np.uint64(i)) * np.uint64(_MULTIPLIER)) >> np.uint64(64 - bits)
                      for i, (k, _) in enumerate(kinds)], axis=1).astype(np.int64)
    valid = np.stack([v for _, v in kinds], axis=1)
    counts = np.bincount(text_of, weights=valid.sum(axis=1), minlength=len(texts)).astype(np.int64)
    return slots[valid], counts, n_words


def dots(weights: np.ndarray, texts: list[str | None], bits: int) -> np.ndarray:
    """The sparse dot product of each text with the weights."""
    slots, counts, n_words = features(texts, bits)
    sums = np.concatenate(([0.0], np.cumsum(weights[slots], dtype=np.float64)))
    upto = np.concatenate(([0], np.cumsum(counts)))
    return SCALE * (sums[upto[1:]] - sums[upto[:-1]]) / np.maximum(n_words, 1)


@dataclass
class Ftrl:
    """FTRL-proximal for one learner; slot 2 ** bits is the bias."""

    bits: int
    alpha: float = 0.5
    beta: float = 0.1
    l1: float = 0.001
    l2: float = 0.01

    def __post_init__(self):
        self.z = np.zeros((1 << self.bits) + 1)
        self.n = np.zeros((1 << self.bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
        g = (p - label) * values
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[slots] = n + g * g


@dataclass
class Model:
    bits: int
    weights: np.ndarray  # float32, 2 ** bits
    bias: float


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8_000, bits: int = 18, epochs: int = 4) -> Model:
    """Learn from the rows of ``labels`` (doc_id, label 0/1) that have a document.

    ``max_rows``: the expected number of labelled texts in the sample; fewer
    are all used."""
    def share(rows: int) -> Column:
        return F.lit(int((1 << 30) * min(1.0, max_rows / max(rows, 1))))

    labels = labels.select(F.col("doc_id").alias("id"), F.col("label").cast("int").alias("label")).dropna().distinct()
    dice = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30))
    sample = labels.filter(dice < share(labels.count()))  # about max_rows ids: small enough to broadcast
    texts = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("doc_id", "text").alias("key"))
    chosen = cut(texts.join(F.broadcast(sample), "id").groupBy("id", "label", "key").agg(F.first("text").alias("text")),
                 "labelled")
    # an id with many texts may bring more rows than ids
    chosen = chosen.filter(F.pmod(F.xxhash64("key", F.lit(13)), F.lit(1 << 30)) < share(chosen.count()))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            slots, counts, n_words = features(part.column("text").to_pylist(), bits)
            rows = []
            for own, n in zip(np.split(slots, np.cumsum(counts)[:-1]), n_words, strict=True):
                at, times = np.unique(own, return_counts=True)
                rows.append((at.astype(np.int32), (times * (SCALE / max(n, 1))).astype(np.float32)))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("label"),
                 pa.array([a for a, _ in rows], pa.list_(pa.int32())),
                 pa.array([v for _, v in rows], pa.list_(pa.float32()))], ["key", "label", "slots", "vals"])
        release_memory()

    def learn(rows: pa.Table) -> pa.Table:
        order = np.lexsort((rows["label"].to_numpy(), rows["key"].to_numpy()))
        at = np.cumsum(rows["slots"].combine_chunks().value_lengths().to_numpy())[:-1]
        slots = [np.append(s, 1 << bits) for s in np.split(rows["slots"].combine_chunks().flatten().to_numpy(), at)]
        vals = [np.append(v, 1.0) for v in np.split(rows["vals"].combine_chunks().flatten().to_numpy(), at)]
        label = rows["label"].to_pylist()
        learner = Ftrl(bits)
        for _ in range(epochs):
            for k in order:
                learner.update(slots[k], vals[k], label[k])
        return pa.table({"weights": [learner.weights().astype("<f4").tobytes()]})

    data = (chosen.select("key", "label", "text")
            .mapInArrow(featurise, "key long, label int, slots array<int>, vals array<float>")
            .withColumn("shard", F.pmod(F.xxhash64("key", F.lit(11)), F.lit(SHARDS))))
    learned = data.groupBy("shard").applyInArrow(learn, "weights binary").collect()  # SHARDS rows of fixed size
    if not learned:
        return Model(bits, np.zeros(1 << bits, np.float32), 0.0)
    mean = np.mean([np.frombuffer(r["weights"], "<f4") for r in learned], axis=0)
    return Model(bits, mean[:-1].astype(np.float32), float(mean[-1]))


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits floats

    def scores(texts: pa.Array) -> list[pa.Array]:
        held = shared.value
        z = dots(held.weights, texts.to_pylist(), held.bits) + held.bias
        return [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))]

    return with_results(docs, f"{column} double", scores, BLOCK_BYTES)

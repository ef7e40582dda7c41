"""Nearest neighbours by inner product with multi-index hashing.

Largest inner product is made nearest Euclidean neighbour: a row x becomes
(x / M, sqrt(1 - |x|^2 / M^2)) for the largest norm M, a query q becomes
(q / |q|, 0).  Binary codes are signs of rotated vectors; each rotation is
learned (alternately: the nearest vertices of the cube, then the rotation that
best fits them) on a sample of ``sample_rows`` rows, several rotations from
different starts fill ``bits`` bits.

Codes are cut into substrings of 16 bits, and every shard of rows indexes each
substring: the rows of each value.  By the pigeonhole principle a code within
``radius`` bits of a query's agrees with it in some substring up to that
substring's share of the radius, so probing all values that near retrieves
every code within the radius.  Probed rows whose whole codes are within the
radius are reranked by inner product in double precision.  Values are probed
by enumeration where few are that near, else by comparing the values present.

The radius is measured: for ``probe_queries`` of the queries the true
neighbours among all rows are found, and the radius is the least that holds
``target_recall`` of them.  Queries that find fewer than k rows are searched
again with a larger radius, at last with all bits, so every query gets k rows
if there are as many.

Every row is indexed, in shards of about ``shard_rows`` rows dealt by a hash of
the id; every query visits every shard, and each shard returns its k best.  A
task holds one shard (some 100 MB at 64 dimensions) and one Arrow batch of
queries; beyond ``queries_per_task`` queries the shard is searched by several
tasks.  What reaches the driver is bounded by the sample, the probe queries and
k.  Equal vectors have equal codes and equal scores, so of a crowd of them the
smallest ids are found.

Defined cases: vectors that are null, zero, hold a null or a non-finite
component, or have another length than most take no part, nor do rows without
an id; of rows sharing an id the one with the greatest embedding counts; equal
scores rank by smaller id; without any usable vector, or any other than the
query's own, there are no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import cut, release_memory

SUBSTRING = 16
PAIRS_AT_ONCE = 1 << 23
_VALUES = np.arange(1 << SUBSTRING, dtype=np.uint16)
#: Every 16-bit mask by rising number of bits, and how many have at most t bits.
MASKS = _VALUES[np.argsort(np.bitwise_count(_VALUES), kind="stable")]
MASKS_UPTO = np.cumsum([math.comb(SUBSTRING, t) for t in range(SUBSTRING + 1)])

RESULT = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Model:
    dim: int
    scale: float  # the largest norm
    centre: np.ndarray  # of the augmented sample
    rotation: np.ndarray  # (dim + 1, bits)
    radius: int = 0

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Codes (n, bits / 64 unsigned words) of rows."""
        scaled = x.astype(np.float64) / self.scale
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.square(scaled).sum(axis=1)))
        return self._codes(np.column_stack([scaled, rest]))

    def queries(self, q: np.ndarray) -> np.ndarray:
        """Codes of query vectors."""
        q = q.astype(np.float64)
        q = q / np.abs(q).max(axis=1, keepdims=True)  # squares of very small or large components stay finite
        return self._codes(np.column_stack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(len(q))]))

    def _codes(self, augmented: np.ndarray) -> np.ndarray:
        signs = (augmented - self.centre) @ self.rotation > 0
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint64)


def learn_rotations(sample: np.ndarray, bits: int, steps: int = 20, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(centre, matrix of ``bits`` columns): learned rotations side by side."""
    rng = np.random.default_rng(seed)
    centre = sample.mean(axis=0)
    x = sample - centre
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]  # principal axes, widest first
    columns: list[np.ndarray] = []
    left = bits
    while left:
        width = min(left, x.shape[1])
        basis = axes[:, :width]
        v = x @ basis
        rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(steps):
            u, _, w = np.linalg.svd(np.where(v @ rotation > 0, 1.0, -1.0).T @ v)
            rotation = (u @ w).T
        columns.append(basis @ rotation)
        left -= width
    return centre, np.concatenate(columns, axis=1)


def substring_radii(radius: int, substrings: int) -> list[int]:
    """Shares of a radius: a code within it is within some substring's share (-1: that one need not be probed)."""
    total = radius + 1 - substrings
    return [total // substrings + (s < total % substrings) for s in range(substrings)]


class ShardIndex:
    """The rows of one shard, and for every substring the rows of each value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        parts = codes.view(np.uint16)
        self.parts = []
        for s in range(parts.shape[1]):
            values, place = np.unique(parts[:, s], return_inverse=True)
            order = np.argsort(place, kind="stable").astype(np.int32)
            starts = np.searchsorted(parts[order, s], np.arange((1 << SUBSTRING) + 1)).astype(np.int32)
            self.parts.append((values, place.astype(np.int32), order, starts))

    def probe(self, codes: np.ndarray, radius: int) -> np.ndarray:
        """(queries, rows): whether some substring agrees up to its share of the radius."""
        hit = np.zeros((len(codes), len(self.ids)), bool)
        own = codes.view(np.uint16)
        for s, share in enumerate(substring_radii(radius, len(self.parts))):
            if share < 0:
                continue
            values, place, order, starts = self.parts[s]
            share = min(share, SUBSTRING)
            n_masks = int(MASKS_UPTO[share])
            if 4 * n_masks <= len(values):
                for q, value in enumerate(own[:, s]):
                    probes = (MASKS[:n_masks] ^ value).astype(np.int64)
                    first, count = starts[probes], starts[probes + 1] - starts[probes]
                    kept = count > 0
                    first, count = first[kept], count[kept]
                    ends = np.cumsum(count)
                    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)
                    hit[q, order[at]] = True
            else:
                near = np.bitwise_count(own[:, s, None] ^ values[None, :]) <= share
                hit |= near[:, place]
        return hit

    def within(self, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) numbers of all codes within the radius, by query."""
        hit = self.probe(codes, radius)
        if 8 * np.count_nonzero(hit) < hit.size:
            q, row = np.nonzero(hit)
            distance = np.bitwise_count(codes[q] ^ self.codes[row]).sum(axis=1, dtype=np.int64)
            return q[distance <= radius], row[distance <= radius]
        distance = np.zeros(hit.shape, np.uint16)
        for w in range(codes.shape[1]):
            distance += np.bitwise_count(codes[:, w, None] ^ self.codes[None, :, w])
        return np.nonzero(hit & (distance <= radius))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, codes: np.ndarray, radius: int,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, row ids and scores of the k best of each query within the radius."""
        found = []
        block = max(1, PAIRS_AT_ONCE // max(1, len(self.ids)))
        for at in range(0, len(query_ids), block):
            q, row = self.within(codes[at:at + block], radius)
            q += at
            kept = self.ids[row] != query_ids[q]
            q, row = q[kept], row[kept]
            scores = inner_products(queries, q, self.vectors, row)
            best = k_best(q, scores, self.ids[row], k)
            found.append((query_ids[q[best]], self.ids[row[best]], scores[best]))
        return tuple(map(np.concatenate, zip(*found, strict=True)))


def inner_products(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, at_once: int = 1 << 15) -> np.ndarray:
    """Inner products of rows a[i] and b[j] in double precision, each summed in the same order."""
    out = np.empty(len(i), np.float64)
    for at in range(0, len(i), at_once):
        s = slice(at, at + at_once)
        out[s] = (a[i[s]].astype(np.float64) * b[j[s]].astype(np.float64)).sum(axis=1)
    return out


def k_best(query: np.ndarray, score: np.ndarray, row_id: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's k best (rising ``query``), higher score first, then smaller id."""
    ends = np.flatnonzero(np.concatenate([query[1:] != query[:-1], np.ones(min(1, len(query)), bool)])) + 1
    kept, first = [], 0
    for end in ends.tolist():
        own = np.arange(first, end)
        if len(own) > k:  # all that reach the k-th score, then in order
            own = own[score[own] >= np.partition(score[own], len(own) - k)[len(own) - k]]
        kept.append(own[np.lexsort((row_id[own], -score[own]))][:k])
        first = end
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _code_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def usable(vec_id: Column, vector: Column) -> Column:
    """Whether a row can take part, but for its length."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec_id.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass(frozen=True)
class Index:
    table: DataFrame  # vec_id, embedding, code; written
    model: Model
    n_rows: int


def _with_codes(vectors: DataFrame, model: Model, as_queries: bool) -> DataFrame:
    """``code`` beside the id and ``embedding`` of each row."""
    names = vectors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = (model.queries if as_queries else model.rows)(_matrix(batch.column("embedding")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes])],
                                                 [*names, "code"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{fields}, code binary")


def build(vectors: DataFrame, bits: int = 256, sample_rows: int = 20_000) -> Index | None:
    """Learn codes on a sample and index every usable row of (vec_id, embedding); None if there is none.

    ``bits`` is a multiple of 64."""
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .filter(usable(F.col("vec_id"), F.col("embedding"))))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    sizes = (kept.groupBy(F.size("embedding").alias("dim"))
             .agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm"))
             .orderBy(F.desc("n"), "dim").limit(1).collect())
    if not sizes:
        return None
    dim, n, scale = sizes[0]["dim"], sizes[0]["n"], float(sizes[0]["norm"])
    kept = kept.filter(F.size("embedding") == dim)
    share = min(1.0, (sample_rows + 6 * sample_rows ** 0.5) / n)
    dice = F.pmod(F.xxhash64("vec_id", F.lit(12)), F.lit(1 << 30))
    sample = (kept.filter(dice < int(share * (1 << 30))).select(dice.alias("dice"), "embedding")
              .orderBy("dice").limit(sample_rows).toArrow())
    x = np.unique(_matrix(sample.column("embedding").combine_chunks()).astype(np.float64), axis=0) / scale
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.square(x).sum(axis=1)))
    model = Model(dim, scale, *learn_rotations(np.column_stack([x, rest]), bits))
    return Index(cut(_with_codes(kept, model, as_queries=False), "vectors"), model, n)


def _true_neighbours(index: Index, ids: np.ndarray, vectors: np.ndarray, k: int) -> DataFrame:
    """query, score, bits apart: the k best rows of each of a bounded number of queries, by inner product alone."""
    model, codes = index.model, index.model.queries(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            x, own = _matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            rows = _code_matrix(batch.column("code"))
            for at in range(0, len(own), 4096):
                scores = vectors.astype(np.float64) @ x[at:at + 4096].astype(np.float64).T
                scores[ids[:, None] == own[None, at:at + 4096]] = -np.inf
                top = np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]
                q = np.repeat(np.arange(len(ids)), top.shape[1])
                row = top.ravel()
                apart = np.bitwise_count(codes[q] ^ rows[at + row]).sum(axis=1, dtype=np.int64)
                both = [np.concatenate(p) for p in zip(best, (q, scores[q, row], own[at + row], apart), strict=True)]
                order = np.argsort(both[0], kind="stable")
                both = [p[order] for p in both]
                best = tuple(p[k_best(both[0], both[1], both[2], k)] for p in both)
        yield pa.RecordBatch.from_arrays([pa.array(best[i]) for i in (0, 1, 3)], ["query", "score", "apart"])

    found = index.table.mapInArrow(run, "query long, score double, apart long")
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "apart"))
    return (found.filter(F.col("score") > float("-inf")).withColumn("rank", first)
            .filter(F.col("rank") <= k).select("query", "score", "apart"))


def calibrate(index: Index, queries: DataFrame, n_queries: int, k: int, target_recall: float = 0.97,
              probe_queries: int = 256) -> Index:
    """The index with the least radius that holds ``target_recall`` of the true neighbours of some queries."""
    share = min(1.0, (probe_queries + 6 * probe_queries ** 0.5) / max(1, n_queries))
    dice = F.pmod(F.xxhash64("query_id", F.lit(7)), F.lit(1 << 30))
    chosen = (queries.filter(dice < int(share * (1 << 30))).select(dice.alias("dice"), "query_id", "embedding")
              .orderBy("dice").limit(probe_queries).toArrow())
    if not chosen.num_rows:
        return index
    near = _true_neighbours(index, chosen.column("query_id").to_numpy(),
                            _matrix(chosen.column("embedding").combine_chunks()), k)
    apart = np.sort([r["apart"] for r in near.collect()])  # probe_queries times k at most
    radius = int(apart[math.ceil(target_recall * len(apart)) - 1]) if len(apart) else 0
    return replace(index, model=replace(index.model, radius=radius))


def _search_once(index: Index, queries: DataFrame, n_queries: int, k: int, radius: int, shard_rows: int,
                 min_shards: int, queries_per_task: int) -> DataFrame:
    """RESULT within ``radius``: at most k rows of each query from each shard."""
    shards = max(min_shards, -(-index.n_rows // shard_rows))
    blocks = max(1, -(-n_queries // queries_per_task))

    def dealt(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(41)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n - 1))

    rows = index.table.select(
        F.explode(F.transform(every(blocks), lambda b: dealt("vec_id", shards) * blocks + b)).alias("part"),
        F.lit(False).alias("asks"), "vec_id", "embedding", "code")
    asked = queries.select(
        F.explode(F.transform(every(shards), lambda s: s * blocks + dealt("query_id", blocks))).alias("part"),
        F.lit(True).alias("asks"), F.col("query_id").alias("vec_id"), "embedding", "code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, shard = None, [], None
        for batch in batches:
            parts = batch.column("part").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            borders = np.flatnonzero((parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *borders.tolist()], [*borders.tolist(), len(parts)]):
                if a == b:
                    continue
                ids = batch.column("vec_id").to_numpy()[a:b]
                x = _matrix(batch.column("embedding").slice(a, b - a))
                codes = _code_matrix(batch.column("code").slice(a, b - a))
                if parts[a] != part:
                    part, held, shard = parts[a], [], None
                if not asks[a]:
                    held.append((ids.copy(), x.copy(), codes))
                    continue
                if shard is None and held:
                    all_ids, all_x, all_codes = map(np.concatenate, zip(*held, strict=True))
                    first = np.concatenate(([True], all_ids[1:] != all_ids[:-1]))  # the greatest embedding of an id
                    shard, held = ShardIndex(all_ids[first], all_x[first], all_codes[first]), []
                if shard is not None:
                    found = shard.search(ids, x, codes, radius, k)
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), ["query_id", "vec_id", "score"])
        release_memory()

    together = rows.unionByName(asked).repartitionById(shards * blocks, F.col("part"))
    ordered = together.sortWithinPartitions("part", "asks", "vec_id", F.desc("embedding"))
    return ordered.mapInArrow(run, RESULT)


def search(index: Index | None, queries: DataFrame, k: int = 20, target_recall: float = 0.97,
           probe_queries: int = 256, shard_rows: int = 1 << 16, min_shards: int = 16,
           queries_per_task: int = 1 << 18) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found of each query of (query_id, embedding)."""
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = (queries.select(F.col("query_id").cast("long").alias("query_id"), "embedding")
              .filter(usable(F.col("query_id"), F.col("embedding")) & (F.size("embedding") == index.model.dim))
              .groupBy("query_id").agg(F.max("embedding").alias("embedding")))
    asked = cut(_with_codes(wanted, index.model, as_queries=True), "queries")
    n_queries = asked.count()
    index = calibrate(index, asked, n_queries, k, target_recall, probe_queries)
    bits, radius, results = index.model.bits, index.model.radius, None
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while True:
        found = cut(_search_once(index, asked, n_queries, k, radius, shard_rows, min_shards, queries_per_task)
                    .withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
                    .select("query_id", "rank", "vec_id", "score"), "neighbours")
        if radius >= bits:
            break
        full = found.filter(F.col("rank") == k).select("query_id")
        short = cut(asked.join(full, "query_id", "left_anti"), "queries")
        left = short.count()
        if not left:
            break
        done = found.join(full, "query_id", "left_semi")
        results = done if results is None else results.unionByName(done)
        asked, n_queries, radius = short, left, bits if radius >= (bits + index.model.radius) // 2 \
            else (bits + radius) // 2
    return found if results is None else results.unionByName(found)

"""SimHash near-duplicates: fingerprints, an exact range join, components.

Fingerprint.  A-Z is lower-cased, words are maximal runs of non-white-space
(ASCII white space), shingles are ``shingle`` consecutive words joined by a
space, repeats included (fewer words: the whole sequence).  Bit b is set when
over half of the shingles' XXH64 values (UTF-8, seed 42) have it.  No words,
or a null text: fingerprint zero, linked like any other.

Links.  Two fingerprints link at ``max_bits`` or fewer differing bits.  A
fingerprint is embedded as its popcounts in 16 segments of four bits.  One
flipped bit moves one count by one, so the Manhattan distance of two
embeddings never exceeds the Hamming distance.  The grid has unit cells;
each side of the join spreads over the cells within half of the range (a
ball of at most 33 cells for radius one), points within range meet in the
cell half way, and the Hamming distance decides.  Only distinct fingerprints
take part, so a group of exact copies is one point, and a point has at most
sum C(64, i), i <= max_bits, true partners whatever the number of documents.

Components.  Labels are passed along links and shortened by pointer jumping;
each round is written to the shared checkpoint folder.  Nothing that grows
with the documents reaches the driver.

Defined cases: an empty table gives no rows; repeated rows and repeated
doc_ids each keep their row; a null doc_id takes its fingerprint's component
and is the smallest id only where its component has no other; columns other
than doc_id and text, whatever their names, are ignored, and kept by
``keep_one_per_group``.  Texts are fingerprinted whole: a very long one is held
with its words and the hashes of its shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import cut, unused, with_results

SEED = 42
SEGMENT_BITS = 4
SEGMENTS = 64 // SEGMENT_BITS
_BLOCK = 1 << 15  # shingles whose bits are added up at once


def fingerprint_bytes(text: str | None, shingle: int = 3) -> bytes:
    """The 64-bit fingerprint of one text, most significant byte first."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return bytes(8)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(b" ".join(words), SEED)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1]
        hashes = b"".join([digest(joined[a:b], SEED)
                           for a, b in zip(starts.tolist(), (ends[shingle - 1:] - 1).tolist(), strict=True)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), _BLOCK):
        ones += np.unpackbits(rows[at:at + _BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(rows)).tobytes()


def with_fingerprint(docs: DataFrame, shingle: int = 3, column: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each text as a (signed) long."""
    def prints(texts: pa.Array) -> list[pa.Array]:
        values = b"".join(fingerprint_bytes(t, shingle) for t in texts.to_pylist())
        return [pa.array(np.frombuffer(values, ">i8").astype(np.int64))]

    return with_results(docs, f"{column} long", prints)


def segment_counts(fp: Column) -> Column:
    """Popcounts of the 16 four-bit segments, one per nibble of a long."""
    def lit(x: int) -> Column:
        return F.lit(x)

    half = F.shiftrightunsigned(fp, 1)
    low = fp.bitwiseXOR(half).bitwiseAND(lit(0x5555555555555555))
    high = fp.bitwiseAND(half).bitwiseAND(lit(0x5555555555555555))
    pairs = low.bitwiseOR(F.shiftleft(high, 1))
    threes = lit(0x3333333333333333)
    return pairs.bitwiseAND(threes) + F.shiftrightunsigned(pairs, 2).bitwiseAND(threes)


def _spread(points: DataFrame, radius: int) -> DataFrame:
    """(fp, cell) for every cell within Manhattan distance ``radius``."""
    out = points.select("fp", segment_counts(F.col("fp")).alias("cell"))
    for step in range(radius):
        cell = F.col("cell")
        around = [cell]
        for i in range(SEGMENTS):
            count = F.shiftrightunsigned(cell, SEGMENT_BITS * i).bitwiseAND(F.lit(15))
            unit = F.lit(1 << (SEGMENT_BITS * i))
            around += [F.when(count < SEGMENT_BITS, cell + unit), F.when(count > 0, cell - unit)]
        out = out.select("fp", F.explode(F.array_compact(F.array(*around))).alias("cell"))
        if step:
            out = out.distinct()
    return out


def links(points: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` at ``max_bits`` or fewer differing bits."""
    if max_bits <= 0:
        return points.limit(0).select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    near, far = max_bits // 2, max_bits - max_bits // 2
    left = _spread(points, near).select(F.col("fp").alias("a"), "cell")
    right = _spread(points, far).select(F.col("fp").alias("b"), "cell")
    order = F.col("a") < F.col("b") if near == far else F.col("a") != F.col("b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    met = left.join(right.hint("merge"), "cell").filter(order & close)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for nodes with an edge (a, b)."""
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        seen = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                    .select(F.col("a").alias("node"), "label").union(labels.select("node", "label")))
        nearest = cut(seen.groupBy("node").agg(F.min("label").alias("label")), "labels")
        up = nearest.select(F.col("node").alias("label"), F.col("label").alias("top"))
        jumped = cut(nearest.join(up, "label").select("node", F.col("top").alias("label")), "labels")
        changed = jumped.join(labels.withColumnRenamed("label", "old"), "node").filter("label <> old")
        done = changed.isEmpty()
        labels = jumped
        if done:
            return labels


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id, rep_fp, n_links.

    component_id is the smallest doc_id reachable over links; (component_id,
    rep_fp) names the one document of the component that stands for it.
    n_links counts the other fingerprints that the document's links to."""
    prints = cut(with_fingerprint(docs.select("doc_id", "text"), shingle).drop("text"), "prints")
    return _grouped(prints, max_bits).select("doc_id", "fp", "component_id", "rep_fp", "n_links")


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """``prints`` (doc_id, fp and others) with component_id, rep_fp and n_links."""
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("min_id")), "points")
    pairs = cut(links(points.select("fp"), max_bits), "links")
    degree = (pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp")))
              .groupBy("fp").agg(F.count(F.lit(1)).alias("n_links")))
    labels = component_labels(pairs).select(F.col("node").alias("fp"), "label")
    known = cut(points.join(degree, "fp", "left").join(labels, "fp", "left")
                .select("fp", "min_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                        F.coalesce("label", "fp").alias("label")), "points")
    best = (known.groupBy("label")
            .agg(F.min(F.struct(F.col("min_id").isNull().alias("no_id"), "min_id", "fp")).alias("rep")))
    named = cut(known.join(cut(best, "reps"), "label")
                .select("fp", "n_links", F.col("rep.min_id").alias("component_id"), F.col("rep.fp").alias("rep_fp")),
                "points")
    return prints.join(named, "fp")


def keep_one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents that stand for their component, all columns kept.

    Of rows with the standing document's id and fingerprint the one with the
    smallest digest of its text stays, of equal texts the first one written.
    Each text is fingerprinted once and written with its row's number; the row
    of each component is chosen on narrow rows, and one semi join keeps them."""
    row, fp = unused(docs, "row"), unused(docs, "fp")
    marked = cut(with_fingerprint(docs, shingle, fp).withColumn(row, F.monotonically_increasing_id()), "marked")
    narrow = marked.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("row"),
                           F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    standing = _grouped(narrow, max_bits).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))
                                                 & (F.col("fp") == F.col("rep_fp")))
    first = (standing.groupBy("component_id", "rep_fp").agg(F.min(F.struct("digest", "row")).alias("one"))
             .select(F.col("one.row").alias(row)))
    # the rows to keep grow with the documents, so they are never broadcast, at no size
    kept = marked.join(cut(first, "kept").hint("merge"), row, "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

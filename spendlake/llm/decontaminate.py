"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Text is lower-cased, signs become spaces, words are what is left between
spaces; of a script written without spaces each character is a word.  The
n-grams of a benchmark item are its pairs of words that are neighbours or have
one word between them.  (An item that must occur word for word has each
``seed_words`` neighbouring words instead, or all if it has fewer.)

1. Rarity.  The occurrences of each item n-gram are counted over all documents.
   The rare ones are the item's seeds: of the pairs of words, those in more
   than ``rare_factor`` times as many places as the item's median pair are left
   out, the commonest first, as long as an alignment must still hit others; of
   an item that must occur word for word, the rarest n-gram alone is the seed.
2. Join.  The n-grams of every whole document are looked up among the seeds.
   Of the words that an alignment of L words at score s matches, at least
   s * L - 1 pairs follow each other with at most one edit between, so each
   such alignment has that many hits within its length, less those left out,
   which are half of them at most: fewer hits are passed over and nothing is
   lost.  Hits on one item form a passage, with as many words on either side as
   the item may need.  Items are taken in blocks of about ``block_words`` words
   (the bound of what is sent to the workers and of the counts that the driver
   gets), each block against all documents; a usual benchmark is one block.
3. Alignment.  Every passage that holds enough of the item's words to reach
   the score (an upper bound of it, so nothing is lost) is aligned to the item
   word by word (match +2, other word -1, gap -1; local).  score is the best
   local score over that of the whole item, so 1.0 is the whole item word for
   word; a pair is reported at ``min_score`` or more if the alignment is worth
   ``min_words`` words, whatever the item's length (shorter items: all of them).

Items without a word match nothing.  A document is read whole, however long; a
task holds about ``BLOCK_BYTES`` of text, or one longer document.

Defined cases: null and empty texts match nothing; null doc_ids are reported
as such; repeated documents and repeated items give one row for each distinct
pair of ids (the best passage); an empty table gives no rows; other columns,
whatever their names, are ignored by ``find_leaks`` and kept by ``drop_leaks``,
which goes by text: of rows that share an id only those with a leak go.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.classifier import _mix, word_hashes
from spendlake.llm.common import cut, release_memory, slices, unused

BLOCK_BYTES = 1 << 20
_PAIR = np.uint64(0xD1B54A32D192ED03)
_SIGNS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_OTHER_SIGNS = re.compile(r"[\u00a0-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7"
                          r"\u2000-\u206f\u3000-\u303f\uff00-\uff0f]")
#: Scripts without spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer, Tai, Balinese, Javanese, Kana,
#: Bopomofo, Han.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f"
                       "\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u3035\u3038-\u303c\u3040-\u312f\u31a0-\u31bf"
                       "\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f"
                       "\U0001b000-\U0001b16f\U00020000-\U0003ffff]")


@dataclass(frozen=True)
class Settings:
    seed_words: int = 4
    rare_factor: int = 8
    min_score: float = 0.5
    min_words: int = 4
    block_words: int = 2_000_000


def normalise(text: str | None) -> bytes:
    """Lower-cased UTF-8 with one byte of space for each ASCII sign or white space,
    and spaces around each character of an unspaced script."""
    text = (text or "").lower()
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", _OTHER_SIGNS.sub(" ", text))
    return text.encode("utf-8").translate(_SIGNS)


def _words(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, word starts, word ends, and each word's text."""
    raw = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    gap = raw == 32
    before = np.concatenate(([True], gap[:-1]))
    starts, ends = np.flatnonzero(before & ~gap), np.flatnonzero(gap & ~before)
    text_ends = np.cumsum(np.fromiter((len(c) + 1 for c in coded), np.int64, len(coded)))
    return raw, starts, ends, np.searchsorted(text_ends, starts, side="right")


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n neighbouring word hashes."""
    out = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k:len(words) - n + 1 + k])
    return out


def pairs(words: np.ndarray, gap: int) -> np.ndarray:
    """A hash for each word and the one ``gap`` further, the same for every gap."""
    left, right = words[:max(len(words) - gap, 0)], words[gap:]
    return _mix(_mix(left + _PAIR) * np.uint64(0x9E3779B97F4A7C15) + right)


@dataclass
class Items:
    """One block of benchmark items on a worker."""

    ids: list
    words: list[np.ndarray]  # word hashes of each item
    grams: np.ndarray  # sorted distinct n-gram hashes
    first: np.ndarray  # rows of ``owner`` for gram k: first[k]:first[k + 1]
    owner: np.ndarray  # item
    widths: list[int]  # of the n-grams looked up besides the pairs
    needed: np.ndarray  # hits within ``reach`` words that an alignment of each item has at least
    reach: np.ndarray  # words of a document that such an alignment spans at most


def _rare_pairs(pairs: np.ndarray, counts: dict[int, int], slots: int, factor: int) -> tuple[np.ndarray, int]:
    """An item's pairs without the commonest, and how many hits are left of ``slots``."""
    distinct, times = np.unique(pairs, return_counts=True)
    found = np.array([counts.get(int(d), 0) for d in distinct])
    spare, out = slots // 2, []
    for k in np.lexsort((distinct, -found)).tolist():
        if found[k] <= factor * max(1, np.median(found)):
            break
        if times[k] <= spare:
            spare -= int(times[k])
            out.append(k)
    return np.delete(distinct, out), slots - (slots // 2 - spare)


def build_items(rows: list, settings: Settings, counts: dict[int, int] | None = None) -> Items:
    """Items with all their n-grams, or with the rare ones, by the ``counts`` of all n-grams."""
    ids, words, keys, owners = [], [], [], []
    widths, needed, reach, paired = set(), [], [], {}
    for item_id, text in rows:
        raw, starts, ends, _ = _words([normalise(text)])
        if not len(starts):
            continue
        own = word_hashes(raw, starts, ends)
        share = _needed(own, settings)
        slots = math.ceil(share * len(own) - 1 - 1e-9)
        if share < 1 and slots > 0:
            paired[len(ids)] = np.concatenate([pairs(own, 1), pairs(own, 2)]), slots
            found = np.unique(paired[len(ids)][0])
        else:  # word for word, or a single equal word may be enough
            n = min(settings.seed_words, len(own)) if share == 1 else 1
            widths.add(n)
            found = np.unique(grams(own, n))
            if share == 1 and counts is not None:
                found = found[[np.lexsort((found, [counts.get(int(g), 0) for g in found]))[0]]]
        needed.append(1)
        reach.append(math.ceil(max(2.0, 3 - 2 * share) * len(own)))
        keys.append(found)
        owners.append(np.full(len(found), len(ids)))
        ids.append(item_id)
        words.append(own)
    if not ids:
        none = np.zeros(0, np.int64)
        return Items([], [], np.zeros(0, np.uint64), np.zeros(1, np.int64), none, [], none, none)
    for o, (own_pairs, slots) in paired.items() if counts is not None else ():
        keys[o], needed[o] = _rare_pairs(own_pairs, counts, slots, settings.rare_factor)
        owners[o] = np.full(len(keys[o]), o)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key, kind="stable")
    distinct, first = np.unique(key[order], return_index=True)
    return Items(ids, words, distinct, np.append(first, len(key)), owner[order], sorted(widths),
                 np.array(needed), np.array(reach))


def _lookup(found: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``found`` that are in the sorted ``table``, and their rows there."""
    at = np.searchsorted(table, found)
    hit = np.flatnonzero(table[np.minimum(at, len(table) - 1)] == found)
    return hit, at[hit]


def _crowded(owner: np.ndarray, at: np.ndarray, doc: np.ndarray, items: Items) -> np.ndarray:
    """Which of the sorted hits are among as many within reach as an alignment has."""
    k = np.arange(len(owner))
    end = k + items.needed[owner]  # after the last of them
    last = np.minimum(end, len(owner)) - 1
    good = ((end <= len(owner)) & (owner[last] == owner) & (doc[last] == doc)
            & (at[last] - at <= items.reach[owner]))
    steps = np.zeros(len(owner) + 1, np.int64)
    np.add.at(steps, k[good], 1)
    np.add.at(steps, end[good], -1)
    return np.cumsum(steps[:-1]) > 0


def passages(coded: list[bytes], items: Items) -> Iterator[tuple[int, int, int, list[int], np.ndarray]]:
    """(text, item, first word, n-gram hashes, word hashes of the passage) for each run of hits."""
    raw, starts, ends, text_of = _words(coded)
    if not len(starts) or not len(items.grams):
        return
    word = word_hashes(raw, starts, ends)
    bounds = np.searchsorted(text_of, np.arange(len(coded) + 1))
    hits = []
    for span, found in _document_grams(word, items.widths):
        at, row = _lookup(found, items.grams)
        inside = text_of[at] == text_of[at + span] if len(at) else np.zeros(0, bool)
        at, row = at[inside], row[inside]
        many = items.first[row + 1] - items.first[row]
        pick = np.repeat(items.first[row], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        hits.append(np.stack([items.owner[pick], np.repeat(at, many), np.repeat(row, many)], axis=1))
    hit = np.concatenate(hits)
    hit = hit[np.lexsort((hit[:, 1], hit[:, 0], text_of[hit[:, 1]]))]
    hit = hit[_crowded(hit[:, 0], hit[:, 1], text_of[hit[:, 1]], items)]
    if not len(hit):
        return
    owner, at, doc = hit[:, 0], hit[:, 1], text_of[hit[:, 1]]
    reach = items.reach[owner]  # a longer gap ends a passage
    new = np.ones(len(hit), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > reach[1:])
    edges = np.append(np.flatnonzero(new), len(hit))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        o, d, side = int(owner[a]), int(doc[a]), int(reach[a])
        lo = max(int(at[a]) - side, int(bounds[d]))
        hi = min(int(at[b - 1]) + side + 1, int(bounds[d + 1]))
        yield d, o, lo - int(bounds[d]), items.grams[np.unique(hit[a:b, 2])].tolist(), word[lo:hi]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman over words: (score share, first, end) of the best local alignment.

    One row of the table for each word of the item; gaps within a row come
    from a running maximum, so each row is a few array operations."""
    m = len(passage)
    steps = np.arange(m + 1)
    above = np.zeros(m + 1, np.int64)
    start_above = steps.copy()
    best, best_at = 0, (0, 0)
    for w in item:
        diagonal = above[:-1] + np.where(passage == w, 2, -1)
        down = above[1:] - 1
        take = diagonal >= down
        row = np.zeros(m + 1, np.int64)
        start = steps.copy()
        value = np.where(take, diagonal, down)
        origin = np.where(take, start_above[:-1], start_above[1:])
        positive = value > 0
        row[1:][positive] = value[positive]
        start[1:][positive] = origin[positive]
        lifted = row + steps  # a gap costs one for each step to the right
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, steps, 0))
        across = top - steps
        better = across > row
        row = np.where(better, across, row)
        start = np.where(better, start[source], start)
        k = int(row.argmax())
        if row[k] > best:
            best, best_at = int(row[k]), (int(start[k]), k)
        above, start_above = row, start
    return best / (2 * len(item)), *best_at


def _needed(item: np.ndarray, settings: Settings) -> float:
    """The least score at which a pair with this item is reported."""
    return max(settings.min_score, min(1.0, settings.min_words / len(item)))


def _may_reach(item: np.ndarray, passage: np.ndarray, needed: float) -> bool:
    """False only if too few of the item's words are in the passage for that score."""
    return np.isin(item, passage).sum() / len(item) >= needed


def _counts(docs: DataFrame, items: Items) -> dict[int, int]:
    """How often each n-gram of a block of items occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast((items.grams, items.widths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, widths = shared.value
        times = np.zeros(len(table), np.int64)
        for part in slices(batches, "text", BLOCK_BYTES) if len(table) else ():
            raw, starts, ends, text_of = _words([normalise(t) for t in part.column("text").to_pylist()])
            word = word_hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)
            for span, found in _document_grams(word, widths):
                at, row = _lookup(found, table)
                inside = text_of[at] == text_of[at + span] if len(at) else np.zeros(0, bool)
                times += np.bincount(row[inside], minlength=len(table))
        held = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(table[held].view(np.int64)), pa.array(times[held])], ["gram", "n"])
        release_memory()

    each = docs.select("text").mapInArrow(run, "gram long, n long")
    total = each.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # the block's n-grams at most
    grams_of = total.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    return dict(zip(grams_of.tolist(), total.column("n").to_pylist(), strict=True))


def _document_grams(word: np.ndarray, widths: list[int]) -> list[tuple[int, np.ndarray]]:
    """(words between first and last, hashes) of every kind of n-gram."""
    return [(1, pairs(word, 1)), (2, pairs(word, 2)), *((n - 1, grams(word, n)) for n in widths)]


HIT_FIELDS = "item int, first_word long, grams array<long>, words array<long>"


def _block_hits(docs: DataFrame, items: Items, settings: Settings) -> DataFrame:
    """Every passage of documents (key, text); ``words`` is null where no alignment reaches the score."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # block_words words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        needed = [_needed(w, settings) for w in held.words]
        for part in slices(batches, "text", BLOCK_BYTES):
            rows = list(passages([normalise(t) for t in part.column("text").to_pylist()], held))
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array([d for d, *_ in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int64()),
                 pa.array([np.array(r[3], np.uint64).view(np.int64) for r in rows], pa.list_(pa.int64())),
                 pa.array([r[4].view(np.int64) if _may_reach(held.words[r[1]], r[4], needed[r[1]]) else None
                           for r in rows], pa.list_(pa.int64()))],
                ["key", "item", "first_word", "grams", "words"])
        release_memory()

    return docs.mapInArrow(run, f"key {docs.schema['key'].dataType.simpleString()}, {HIT_FIELDS}")


def _aligned(hits: DataFrame, items: Items, settings: Settings) -> DataFrame:
    """key, item_id, score, first_word, end_word, n_seeds of the passages that reach their score."""
    shared = hits.sparkSession.sparkContext.broadcast((items.ids, items.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words = shared.value
        for batch in batches:
            out, kept = [], []
            for k, row in enumerate(batch.drop_columns(["key"]).to_pylist()):
                o = row["item"]
                share, a, b = align(words[o].view(np.int64), np.array(row["words"], np.int64))
                if share >= _needed(words[o], settings):
                    kept.append(k)
                    out.append((ids[o], share, row["first_word"] + a, row["first_word"] + b, len(row["grams"])))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(kept, pa.int64())),
                 *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["key", "item_id", "score", "first_word", "end_word", "n_seeds"])

    kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    return hits.filter("words IS NOT NULL").mapInArrow(
        run, f"key {hits.schema['key'].dataType.simpleString()}, item_id long, score double, first_word long, "
             "end_word long, n_seeds long")


def _search(docs: DataFrame, benchmark: DataFrame, settings: Settings) -> DataFrame:
    """The best passage of each pair of a document's key and an item; of documents (key, text)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")).cast("long"))).first()[0] or 0
    blocks = -(-size // settings.block_words) or 1
    found = None
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        rows = [tuple(r) for r in rows]
        block = build_items(rows, settings, _counts(docs, build_items(rows, settings)))
        part = _aligned(cut(_block_hits(docs, block, settings), "passages"), block, settings)
        found = part if found is None else found.union(part)
    best = F.max(F.struct("score", (-F.col("first_word")).alias("at"), "end_word", "n_seeds"))
    return (found.groupBy("key", "item_id").agg(best.alias("b"))
            .select("key", "item_id", "b.score", (-F.col("b.at")).alias("first_word"), "b.end_word", "b.n_seeds"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per (doc_id, item_id) that leaked: score, the words first_word:end_word of the
    document that align best, and the number of distinct seeds in the passage."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("key"), "text")
    return _search(keyed, benchmark, settings or Settings()).withColumnRenamed("key", "doc_id")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None,
               null_ids: bool = False) -> DataFrame:
    """The documents without a leak, all columns kept.

    Whether a document leaks depends on its text alone, so texts are looked up
    by their digest, and rows of one id stay or go each by its own text.
    Documents without an id are kept; with ``null_ids`` they go like any other."""
    def digest() -> Column:
        return F.md5(F.col("text").cast("binary"))

    found = _search(docs.select(digest().alias("key"), "text"), benchmark, settings or Settings())
    name = unused(docs, "leaked")
    leaked = cut(found.select(F.col("key").alias(name)).distinct(), "leaks")
    goes = digest() == F.col(name)
    return docs.join(leaked, goes if null_ids else goes & F.col("doc_id").isNotNull(), "left_anti")

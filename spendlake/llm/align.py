"""Alignment of the tokens of two tokenizers over the same text.

Both sides encode space + text (sentencepiece adds the space itself) and give
tokens as byte ranges.  For each batch of documents two ``pandas.merge_asof``
joins, keyed by document, find the token of the other side that covers the
start of each token; the union of both directions holds every overlapping pair
of tokens.  Overlapping pairs that end at the same byte are the links, and
their ends cut the tokens into groups: the shortest runs of tokens of both
sides that spell the same bytes.

``align`` gives each document's groups as text (``a1,a2|b1;a3|b2,b3``: ids of
side A and B, group by group) and its links by id pair.  ``score`` counts each
id pair over the whole corpus, finds the highest count of every B id, and gives
each document the links whose pair has that count (ties included) and the sum
of counts.  Counts are aggregated before they are shuffled.  The table of
pairs grows with the square of the vocabulary at most, not with the corpus; it
is written, counted, and broadcast only up to ``broadcast_pairs`` rows, beyond
that joined by a shuffle on the pair, with the same results.

Encoding looks up distinct words only.  Text is cut at single spaces between
other characters, where neither pre-tokens of A nor pieces of B cross: no piece
holds a space behind another character (checked when the model is read).  Both
sides end a token there, so alignment may run over ``WORDS_AT_ONCE`` words at a
time: a very long text is aligned in several steps with the same result.  A
text and its own token arrays are held whole, a run without a space is aligned
at once.

Defined cases: null and empty texts, and texts whose A or B tokens do not spell
space + text (those holding U+2581, say), have no tokens: zeros and empty
groups; a null doc_id stays null; repeated rows count and are returned each; an
empty table gives no rows; columns other than doc_id and text are ignored,
whatever their names.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import cut, release_memory, slices, unused
from spendlake.llm.prefix_counts import byte_alphabet
from spendlake.llm.tokens import ChunkMemo, _IRREGULAR, vocabulary_path

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 1 << 20
WORDS_AT_ONCE = 1 << 18
WORDS_KEPT = 500_000
BROADCAST_PAIRS = 2_000_000
_SPACED = re.compile(r"(?<=\S) (?=\S)")
_WHOLE = regex.compile(r"(?s:.+)")
_BAD = np.uint32(1 << 31)

FIELDS = ("doc_id long, n_a long, n_b long, n_groups long, groups string, "
          "links array<struct<a: int, b: int, n: int>>")


class TokenPair:
    """The two vocabularies and a memo of words: (n_a, A ids, B ids) of each."""

    def __init__(self, tokenizer_a: str, tokenizer_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(vocabulary_path(tokenizer_a))
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(tokenizer_b))
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if set(token) <= alphabet.keys() else token.encode()
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"{tokenizer_b}: {piece!r} reaches over a space, words can't be encoded one by one")
            self.bytes_b.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode("utf-8"))
        self.size_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        # each id with the sign behind it: A's "," within a side, "|" at its end; B's "," and ";"
        self.written = pa.array([f"{i}{sign}" for i in range(len(self.bytes_a)) for sign in ",|"]
                                + [f"{i}{sign}" for i in range(len(self.bytes_b)) for sign in ",;"])
        self.memo = ChunkMemo(self._encode, _WHOLE, limit=WORDS_KEPT)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = []
        coded_a = self.a.encode_batch([" " + w for w in words], add_special_tokens=False)
        for word, a, b in zip(words, coded_a, self.b.encode(words, num_threads=1), strict=True):
            body = b" " + word.encode("utf-8")
            fits = self.spell(a.ids, self.bytes_a) == body == self.spell(b, self.bytes_b)
            rows.append([len(a.ids) | (0 if fits else int(_BAD)), *a.ids, *b])
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(itertools.chain.from_iterable(rows), np.uint32, int(lengths.sum())), lengths

    @staticmethod
    def spell(ids, table: list[bytes]) -> bytes:
        return b"".join(map(table.__getitem__, ids))

    def words(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct words, the number of each word of all texts in order, and the words of each text."""
        empty = pc.fill_null(pc.equal(texts, ""), True)
        odd = pc.and_not(pc.fill_null(pc.match_substring_regex(texts, _IRREGULAR), True), empty)
        plain = pc.invert(pc.or_(odd, empty))
        lists = pc.split_pattern(texts.filter(plain), " ")
        coded = lists.flatten().dictionary_encode()
        numbers, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        per_text = np.zeros(len(texts), np.int64)
        per_text[plain.to_numpy(zero_copy_only=False)] = lists.value_lengths().to_numpy()
        odd = odd.to_numpy(zero_copy_only=False)
        if odd.any():
            found = [_SPACED.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
            per_text[odd] = list(map(len, found))
            number = {w: k for k, w in enumerate(distinct)}
            more = np.fromiter((number.setdefault(w, len(number)) for w in itertools.chain.from_iterable(found)),
                               np.int64)
            from_odd = np.repeat(odd, per_text)
            both = np.zeros(len(from_odd), np.int64)
            both[from_odd], both[~from_odd] = more, numbers
            numbers, distinct = both, list(number)
        return distinct, numbers, per_text


@functools.lru_cache(maxsize=1)
def token_pair(tokenizer_a: str, tokenizer_b: str) -> TokenPair:
    return TokenPair(tokenizer_a, tokenizer_b)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the overlapping tokens of two frames (doc, start), in order of start.

    Each start is looked up on the other side; a pair that starts together is
    found from both sides and kept once."""
    a, b = a.assign(a_no=np.arange(len(a))), b.assign(b_no=np.arange(len(b)))
    from_a = pd.merge_asof(a, b, on="start", by="doc")
    from_b = pd.merge_asof(b, a, on="start", by="doc")
    later = b["start"].to_numpy() > a["start"].to_numpy()[from_b["a_no"].to_numpy()]
    return (np.concatenate([from_a["a_no"].to_numpy(), from_b["a_no"].to_numpy()[later]]),
            np.concatenate([from_a["b_no"].to_numpy(), from_b["b_no"].to_numpy()[later]]))


class Aligned:
    """Token counts, groups and links of the documents 0 .. n_docs - 1 of a batch."""

    def __init__(self, pair: TokenPair, doc_a: np.ndarray, ids_a: np.ndarray, doc_b: np.ndarray, ids_b: np.ndarray,
                 n_docs: int):
        size_a, size_b = pair.size_a[ids_a], pair.size_b[ids_b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)  # both sides spell the same bytes, so offsets agree
        a_no, b_no = overlaps(pd.DataFrame({"doc": doc_a, "start": end_a - size_a}),
                              pd.DataFrame({"doc": doc_b, "start": end_b - size_b}))
        together = end_a[a_no] == end_b[b_no]
        self.link_a, self.link_b = np.sort(a_no[together]), np.sort(b_no[together])  # one link ends each group
        self.n_a, self.n_b = np.bincount(doc_a, minlength=n_docs), np.bincount(doc_b, minlength=n_docs)
        self.n_groups = np.bincount(doc_a[self.link_a], minlength=n_docs)
        self.groups = self._written(pair, ids_a, ids_b)
        self._count_pairs(doc_a[self.link_a], ids_a[self.link_a], ids_b[self.link_b])

    def _written(self, pair: TokenPair, ids_a: np.ndarray, ids_b: np.ndarray) -> pa.Array:
        """A's ids, then B's ids of each group, group by group, as one text for each document."""
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[self.link_a] = last_b[self.link_b] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before = np.concatenate(([0], self.link_b + 1))
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + before[group_a]] = 2 * ids_a.astype(np.int64) + last_a
        codes[np.arange(len(ids_b)) + self.link_a[group_b] + 1] = (
            2 * (len(pair.bytes_a) + ids_b.astype(np.int64)) + last_b)
        ends = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pair.written.take(pa.array(codes)))
        return pc.utf8_slice_codeunits(pc.binary_join(lists, ""), 0, -1)  # without the last ";"

    def _count_pairs(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        key = (doc.astype(np.uint64) << np.uint64(40)) | (a.astype(np.uint64) << np.uint64(20)) | b.astype(np.uint64)
        keys, n = np.unique(key, return_counts=True)
        low = np.uint64((1 << 20) - 1)
        self.pair_doc = (keys >> np.uint64(40)).astype(np.int64)
        self.pair_a = ((keys >> np.uint64(20)) & low).astype(np.int32)
        self.pair_b = (keys & low).astype(np.int32)
        self.pair_n = n.astype(np.int32)


def _aligned_steps(pair: TokenPair, texts: pa.Array) -> Iterator[tuple[int, Aligned]]:
    """(number of the first document, alignment of it and the next ones), WORDS_AT_ONCE words at a time.

    The last document of a step may go on in the next one."""
    distinct, numbers, per_text = pair.words(texts)
    places = pair.memo.places(distinct)
    heads = pair.memo.values[pair.memo.ends[places]]
    doc = np.repeat(np.arange(len(texts)), per_text)
    wrong = (heads & _BAD) != 0
    if wrong.any():
        ends = np.concatenate(([0], np.cumsum(per_text)))
        unfit = np.zeros(len(texts), bool)
        for k in np.unique(doc[wrong[numbers]]).tolist():
            body = b" " + texts[k].as_py().encode("utf-8")
            ids_a, ids_b = [], []
            for w in numbers[ends[k]:ends[k + 1]].tolist():
                value = pair.memo.gather(places[w:w + 1])[0]
                n = int(value[0] & ~_BAD)
                ids_a += value[1:n + 1].tolist()
                ids_b += value[n + 1:].tolist()
            unfit[k] = pair.spell(ids_a, pair.bytes_a) != body or pair.spell(ids_b, pair.bytes_b) != body
        numbers, doc = numbers[~unfit[doc]], doc[~unfit[doc]]
    for at in range(0, len(numbers), WORDS_AT_ONCE):
        values, lengths = pair.memo.gather(places[numbers[at:at + WORDS_AT_ONCE]])
        first = int(doc[at])
        own = doc[at:at + WORDS_AT_ONCE] - first
        starts = np.cumsum(lengths) - lengths
        n_a = (values[starts] & ~_BAD).astype(np.int64)
        side = np.ones(len(values), np.int8)  # 0: the head, 1: A, 2: B
        side[starts] = 0
        inside = np.arange(len(values)) - np.repeat(starts, lengths)
        side[inside > np.repeat(n_a, lengths)] = 2
        yield first, Aligned(pair, np.repeat(own, n_a), values[side == 1], np.repeat(own, lengths - n_a - 1),
                             values[side == 2], int(own[-1]) + 1)


def _align_batch(pair: TokenPair, texts: pa.Array) -> list[pa.Array]:
    """n_a, n_b, n_groups, groups and links of each text."""
    size = len(texts)
    totals = np.zeros((3, size), np.int64)
    groups: list[list] = [[] for _ in range(size)]
    parts = []
    for first, step in _aligned_steps(pair, texts):
        span = slice(first, first + len(step.n_a))
        for row, counts in zip(totals, (step.n_a, step.n_b, step.n_groups), strict=True):
            row[span] += counts
        for k, body in enumerate(step.groups, first):
            if step.n_a[k - first]:
                groups[k].append(body.as_py())
        parts.append((step.pair_doc + first, step.pair_a, step.pair_b, step.pair_n))
    doc, a, b, n = (map(np.concatenate, zip(*parts, strict=True)) if parts
                    else (np.zeros(0, np.int64), *np.zeros((3, 0), np.int32)))
    if len(parts) > 1:  # a document of two steps may name a pair twice
        order = np.lexsort((b, a, doc))
        doc, a, b, n = doc[order], a[order], b[order], n[order]
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        n = np.add.reduceat(n, np.flatnonzero(new)).astype(np.int32)
        doc, a, b = doc[new], a[new], b[new]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=size)))).astype(np.int32)
    links = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"]))
    return [*map(pa.array, totals), pa.array([";".join(g) for g in groups], pa.string()), links]


def align(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """FIELDS of every document; links hold each linked id pair of the document once, with its number n."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = token_pair(tokenizer_a, tokenizer_b)
        for part in slices(batches, "text", BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_align_batch(pair, part.column("text"))], names)
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FIELDS)


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, count and best (no pair of the same b has a higher count), of a frame with a, b, n."""
    counts = links.groupBy("a", "b").agg(F.sum("n").alias("count"))
    top = F.max("count").over(Window.partitionBy("b"))  # as many rows as A has ids, at most
    return counts.select("a", "b", "count", (F.col("count") == top).alias("best"))


def score(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and every further column but ``links``."""
    row = unused(aligned, "row")
    rows = cut(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    links = rows.select(row, F.explode("links").alias("l")).select(row, "l.a", "l.b", "l.n")
    counts = cut(pair_counts(links), "pairs")
    known = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    n = F.col("n").cast("long")
    sums = (links.join(known, ["a", "b"]).groupBy(row)
            .agg(F.sum(n).alias("n_links"), F.sum(F.when(F.col("best"), n).otherwise(0)).alias("n_best"),
                 F.sum(n * F.col("count")).alias("count_sum")))
    kept = [c for c in rows.columns if c not in (row, "links")]
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return rows.drop("links").join(sums, row, "left").select(*kept, *zero)

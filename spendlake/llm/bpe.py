"""Byte-level BPE encoding and decoding by DuckDB recursive queries per partition.

Encoding.  Each worker holds a merge table (left id, right id) -> id of the
joined bytes.  The bytes of unseen pre-tokens become rows (word, position,
id); a recursive query joins each row and its right neighbour to the merge
table, contracts each word's leftmost pair of minimum rank, and ends a word
when no pair is left.  Ids of chunks already seen are kept in a bounded memo,
so the queries see each distinct word about once per worker.

Long words.  The query costs the square of a word's length, so a word of over
LONG_WORD bytes is cut into overlapping windows, which are words of the same
query.  A sequence of tokens is the encoding of its bytes exactly if each two
neighbours are the encoding of theirs: merges inside a token ignore what lies
beyond its neighbours, so the first merge across a boundary would also come
first in the encoding of the two tokens beside it.  Two windows are therefore
joined at a boundary that both have and beside which they agree on a token (the
pair then stands in one of the two encodings).  Without such a boundary a new
window starts at one of the last boundaries found, and its first token must form
such a pair with the token before it, by a query of the two; else from further
back, at last from the word's start.  The cost grows with the word's length.

Decoding.  Rows (document, position, id) join the vocabulary, and an
aggregate ordered by position puts the bytes of each document together.

No row leaves its partition, nothing is shuffled, and a block of about two
megabytes of text (or one longer text) is held at a time.  A query's rows, those of all
rounds, are bounded, and nothing is spilled to a local folder.

Defined cases: a null or empty text has no ids and decodes to no bytes; an
empty table gives no rows; repeated rows give repeated rows; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import accumulate

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from spendlake.llm.common import release_memory, slices
from spendlake.llm.tokens import RANKS, ChunkMemo, load_ranks, pretokenizer

BLOCK_BYTES = 2 << 20  # text held at once
WORDS_PER_QUERY = 20_000
ROWS_PER_QUERY = 2 << 20  # of all rounds, at most; one word's rows if they are more
LONG_WORD = 192  # bytes; longer words are cut into windows
WINDOW, STRIDE = 96, 64  # bytes of a window, and from one window's start to the next's
WINDOWS_AHEAD = 4096  # windows of one word encoded together
MEMO_CHUNKS = 500_000
MEMO_PIECES = 50_000
IDS_PER_QUERY = 1 << 18
DATABASE_MEMORY = "150MB"

ENCODE = """
WITH RECURSIVE step(word, pos, id, live) AS (
    SELECT word, pos, id, true FROM start_rows
  UNION ALL (
    WITH pairs AS (
        SELECT word, pos, id, lead(word) OVER in_order AS right_word,
               lead(pos) OVER in_order AS right_pos, lead(id) OVER in_order AS right_id
        FROM step WHERE live
        WINDOW in_order AS (ORDER BY word, pos)),
    ranked AS (
        SELECT word, pos, id, right_pos, rank
        FROM pairs LEFT JOIN merges ON pair = (id::BIGINT << 32) | right_id AND right_word = word),
    best AS (  -- the smallest rank, then the leftmost position; null: no pair is left
        SELECT word, min((rank::BIGINT << 32) | pos) AS choice,
               arg_min(right_pos, (rank::BIGINT << 32) | pos) AS joined
        FROM ranked GROUP BY word)
    SELECT r.word, r.pos,
           CASE WHEN r.pos = (choice & 4294967295) THEN (choice >> 32)::INTEGER ELSE r.id END,
           choice IS NOT NULL
    FROM ranked r JOIN best USING (word)
    WHERE choice IS NULL OR r.pos <> joined))
SELECT word, id FROM step WHERE NOT live ORDER BY word, pos
"""

DECODE = """
SELECT doc, string_agg(piece, '' ORDER BY pos) AS body
FROM id_rows JOIN vocabulary USING (id) GROUP BY doc
"""


def _merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every way to join two tokens to a third: (left << 32 | right) -> rank."""
    pairs, joined = [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                pairs.append((left << 32) | right)
                joined.append(rank)
    return pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(joined, pa.int32())})


@functools.cache
def _vocabulary_tables(ranks_name: str) -> tuple[pa.Table, pa.Table]:
    """The merge table, and the bytes of each id (as Latin-1 text)."""
    ranks = load_ranks(ranks_name)
    return _merge_table(ranks), pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                                          "piece": pa.array([t.decode("latin-1") for t in ranks], pa.string())})


def _windows(word: bytes, first: int, count: int) -> list[bytes]:
    """At most ``count`` windows of a long word, from number ``first`` on."""
    stop = min(len(word) - (WINDOW - STRIDE), (first + count) * STRIDE)
    return [word[s:s + WINDOW] for s in range(first * STRIDE, stop, STRIDE)]


class Codec:
    """One worker's DuckDB tables and memo for a vocabulary."""

    def __init__(self, ranks_name: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        self.ranks_name = ranks_name
        ranks = load_ranks(ranks_name)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces: dict[bytes, list[int]] = {}
        self.token_bytes = {i: t for t, i in ranks.items()}
        self.memo = ChunkMemo(self.encode_words, pretokenizer(pattern), limit=MEMO_CHUNKS)
        self._db = None

    @property
    def db(self) -> duckdb.DuckDBPyConnection:
        if self._db is None:
            self._db = duckdb.connect(config={"threads": 1, "memory_limit": DATABASE_MEMORY,
                                              "temp_directory": ""})
            merge_rows, pieces = _vocabulary_tables(self.ranks_name)  # noqa: F841  read by name
            self._db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
            self._db.execute("CREATE TABLE vocabulary AS SELECT * FROM pieces")
        return self._db

    def close(self) -> None:
        """At the end of a partition: only the memo stays."""
        if self._db is not None:
            self._db.close()
            self._db = None
        release_memory()

    def _contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words by the recursive query, and the number of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rows = np.cumsum(lengths * (lengths + 1) // 2)  # a round leaves one row less of each word
        ids, counts, at = [], [], 0
        while at < len(words):
            done = rows[at - 1] if at else 0
            end = min(max(int(np.searchsorted(rows, done + ROWS_PER_QUERY, "right")), at + 1), at + WORDS_PER_QUERY)
            part = lengths[at:end]
            raw = np.frombuffer(b"".join(words[at:end]), np.uint8)
            first = np.repeat(np.cumsum(part) - part, part)
            start_rows = pa.table({  # noqa: F841
                "word": pa.array(np.repeat(np.arange(len(part), dtype=np.int32), part)),
                "pos": pa.array((np.arange(len(raw)) - first).astype(np.int32)),
                "id": pa.array(self.byte_ids[raw])})
            got = self.db.execute(ENCODE).fetchnumpy()
            counts.append(np.bincount(np.asarray(got["word"]), minlength=len(part)))
            ids.append(np.asarray(got["id"]).astype(np.uint32))
            at += len(part)
        return np.concatenate(ids), np.concatenate(counts)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens, and the number of each."""
        coded = [w.encode("utf-8") for w in words]
        short = [w for w in coded if len(w) <= LONG_WORD]
        if len(short) == len(coded):
            return self._contract(coded)
        ids, counts = self._contract(short) if short else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        short_ids = iter(np.split(ids, np.cumsum(counts)[:-1]))
        self._tokens_of([v for w in coded if len(w) > LONG_WORD for v in _windows(w, 0, MEMO_PIECES // len(words))])
        out = [next(short_ids) if len(w) <= LONG_WORD else np.array(self._encode_long(w), np.uint32) for w in coded]
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _tokens_of(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece; pieces seen lately are not contracted again."""
        new = list({p for p in pieces if p not in self.pieces})
        if len(self.pieces) + len(new) > MEMO_PIECES:
            self.pieces.clear()
            new = list(set(pieces))
        if new:
            ids, counts = self._contract(new)
            ends = np.cumsum(counts).tolist()
            ids = ids.tolist()
            self.pieces.update((p, ids[end - n:end]) for p, n, end in zip(new, counts.tolist(), ends, strict=True))
        return [self.pieces[p] for p in pieces]

    def _ends(self, ids: list[int], start: int) -> list[int]:
        return list(accumulate((len(self.token_bytes[i]) for i in ids), initial=start))[1:]

    def _encode_long(self, word: bytes) -> list[int]:
        """The ids of one long word, window by window."""
        ids = list(self._tokens_of([word[:WINDOW]])[0])  # the encoding of the word's first ends[-1] bytes
        ends = self._ends(ids, 0)
        while ends[-1] < len(word):
            at = (ends[-1] - (WINDOW - STRIDE)) // STRIDE
            window = word[at * STRIDE:at * STRIDE + WINDOW]
            if window not in self.pieces:
                self._tokens_of(_windows(word, at, WINDOWS_AHEAD))
            more = self.pieces[window]
            more_ends = self._ends(more, at * STRIDE)
            kept, skipped = self._join(ids, ends, more, more_ends, at * STRIDE) or (0, 0)
            if not kept:
                kept, more, more_ends = self._restart(word, ids, ends)
                skipped = 0
            ids[kept:], ends[kept:] = more[skipped:], more_ends[skipped:]
        return ids

    @staticmethod
    def _join(ids: list[int], ends: list[int], more: list[int], more_ends: list[int],
              start: int) -> tuple[int, int] | None:
        """How many tokens stay and how many of the window go, at a boundary of both beside which they agree."""
        places = {end: k + 1 for k, end in enumerate(more_ends)} | {start: 0}
        for kept in range(len(ids), 0, -1):
            if ends[kept - 1] < start:
                return None
            skipped = places.get(ends[kept - 1])
            if skipped is not None and skipped < len(more):
                if (skipped and ids[kept - 1] == more[skipped - 1]) or (kept < len(ids) and ids[kept] == more[skipped]):
                    return kept, skipped
        return None

    def _restart(self, word: bytes, ids: list[int], ends: list[int]) -> tuple[int, list[int], list[int]]:
        """How many tokens stay, and the ids and ends of what follows them, beyond the last end."""
        size, last = WINDOW, ends[-1]
        while True:
            kept = len(ids)
            starts = []
            while kept >= 0 and (start := ends[kept - 1] if kept else 0) >= last - size:
                starts.append((kept, start))
                kept -= 1
            found = self._tokens_of([word[start:last + size] for _, start in starts])
            beside = [self.token_bytes[ids[k - 1]] + self.token_bytes[f[0]] if k else b""
                      for (k, _), f in zip(starts, found, strict=True)]
            alone = self._tokens_of([b for b in beside if b])
            checked = dict(zip([b for b in beside if b], alone, strict=True))
            for (k, start), f, b in zip(starts, found, beside, strict=True):
                if not k or checked[b] == [ids[k - 1], f[0]]:
                    return k, f, self._ends(f, start)
            size *= 2

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the number of each."""
        return self.memo.values_of(texts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each document, from the ids of all and the number of each."""
        docs = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        out: list[list[bytes]] = [[] for _ in counts]
        for at in range(0, len(ids), IDS_PER_QUERY):  # a long document is decoded in parts
            part = slice(at, at + IDS_PER_QUERY)
            id_rows = pa.table({  # noqa: F841
                "doc": pa.array(docs[part]), "id": pa.array(ids[part].astype(np.int32)),
                "pos": pa.array(np.arange(len(ids[part]), dtype=np.int32))})
            for doc, body in self.db.execute(DECODE).fetchall():
                out[doc].append(body.encode("latin-1"))
        return [b"".join(parts) for parts in out]


@functools.lru_cache(maxsize=1)
def codec(ranks_name: str, pattern: str) -> Codec:
    return Codec(ranks_name, pattern)


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids array<int> of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            ids, counts = codec(ranks, pattern).encode(part.column("text"))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])
        codec(ranks, pattern).close()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, body binary: the bytes that each document's ids stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("ids")
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                bodies = codec(ranks, pattern).decode(lists.flatten().to_numpy(), counts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(bodies, pa.binary())],
                                                 ["doc_id", "body"])
        codec(ranks, pattern).close()

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, body binary")


def round_trip(docs: DataFrame, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN,
               with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit), decoded_sha256[, ids].

    Each block is encoded, and decoded again from its ids alone; bytes that
    differ from the text's are an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            ids, counts = codec(ranks, pattern).encode(part.column("text"))
            bodies = codec(ranks, pattern).decode(ids, counts)
            source = pc.fill_null(part.column("text").cast(pa.binary()), b"")
            if not pc.all(pc.equal(source, pa.array(bodies, pa.binary())), min_count=0).as_py():
                raise RuntimeError("a text does not decode to itself")
            ends = np.cumsum(counts)
            raw = memoryview(ids.astype("<u4").tobytes())
            digests = [hashlib.sha256(raw[4 * (b - n):4 * b]).hexdigest()
                       for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            columns = [part.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(digests, pa.string()),
                       pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string())]
            if with_ids:
                offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)
        codec(ranks, pattern).close()

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)

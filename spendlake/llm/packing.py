"""Token ids packed into rows of fixed length by best-fit decreasing.

Each document is encoded whole and cut into pieces of at most ``length`` ids,
every piece with its place in the document, so nothing is lost.  A piece of
full length is a row of its own.  The others are gathered in blocks of about
``block_tokens`` ids, and each block is packed by best-fit decreasing: longest
piece first, into the row with the least room that still holds it, else into a
new row.  A segment tree over capacities finds that row in log2(length) steps.

Blocks are packed where their documents are read: nothing is shuffled, a task
holds one block, and a block of thousands of rows packs as densely as a larger
one would (each block leaves its last rows open, no more).

Output, one line per packed row: ``ids`` (little-endian unsigned 16- or 32-bit,
``length`` of them, padded with ``pad_id``), ``cu_seqlens`` (cumulative segment
lengths from 0 to n_tokens), ``position_resets`` (where positions start again
from 0), and for every segment its document and its first token there.
``write_matrices`` writes the rows as binary matrices with their segment and
position arrays; ``unpack`` puts the documents together again.

Defined cases: null and empty texts have no ids and no segment; null doc_ids
stay null; repeated rows are packed each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import io
import json
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import cut, slices
from spendlake.llm.tokens import RANKS, ChunkMemo, load_ranks, pretokenizer
from spendlake.sources.files import open_filesystem

BLOCK_BYTES = 4 << 20


class CapacityTree:
    """For each capacity 0 .. size whether a row has that much room; finds the least one that is enough."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.full = [0] * (2 * self.leaves)  # number of rows below each node

    def add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.full[node] += by
            node >>= 1

    def least(self, needed: int) -> int | None:
        """The least capacity >= needed that a row has."""
        full, node = self.full, needed + self.leaves
        if full[node]:
            return needed
        while node > 1:
            if not node & 1 and full[node + 1]:  # the sibling on the right
                node += 1
                while node < self.leaves:
                    node = 2 * node if full[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The items of each row; items of equal length keep their order."""
    tree = CapacityTree(capacity)
    rows: list[list[int]] = []
    with_room: dict[int, list[int]] = {}
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        n = lengths[item]
        room = tree.least(n)
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = with_room[room].pop()
            tree.add(room, -1)
        rows[row].append(item)
        if room > n:
            with_room.setdefault(room - n, []).append(row)
            tree.add(room - n, 1)
    return rows


@functools.lru_cache(maxsize=1)
def _memo(ranks: str, pattern: str) -> ChunkMemo:
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(ranks), special_tokens={})

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = list(map(encoding.encode_ordinary, words))
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.fromiter(chain.from_iterable(coded), np.uint32, int(lengths.sum())), lengths

    return ChunkMemo(encode, pretokenizer(pattern))


SCHEMA = ("pack_id long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, "
          "position_resets array<int>, doc_ids array<long>, doc_starts array<long>")


class _Packer:
    def __init__(self, length: int, dtype: str, pad_id: int, partition: int):
        self.length, self.dtype, self.pad_id = length, dtype, pad_id
        self.next_id = partition << 33
        self.pieces: list[tuple] = []  # (doc_id, first token in the document, ids)
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[list[tuple]]:
        """Take one document; returns the rows that its full pieces make."""
        rows = []
        for at in range(0, len(ids), self.length):
            piece = (doc_id, at, ids[at:at + self.length])
            if len(piece[2]) == self.length:
                rows.append([piece])
            else:
                self.pieces.append(piece)
                self.held += len(piece[2])
        return rows

    def flush(self) -> list[list[tuple]]:
        rows = best_fit_decreasing([len(p[2]) for p in self.pieces], self.length)
        out = [[self.pieces[k] for k in row] for row in rows]
        self.pieces, self.held = [], 0
        return out

    def batch(self, rows: list[list[tuple]]) -> pa.RecordBatch:
        out = []
        for row in rows:
            ids = np.full(self.length, self.pad_id, self.dtype)
            ends = np.cumsum([0] + [len(p[2]) for p in row]).tolist()
            for (_, _, part), a, b in zip(row, ends[:-1], ends[1:], strict=True):
                ids[a:b] = part
            out.append((self.next_id, ends[-1], len(row), ids.tobytes(), ends, ends[:-1],
                        [p[0] for p in row], [p[1] for p in row]))
            self.next_id += 1
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                 pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                          [f.split()[0] for f in SCHEMA.split(", ")])


def pack(docs: DataFrame, length: int = 2048, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN,
         block_tokens: int = 2 << 20, pad_id: int = 0, id_bits: int = 16) -> DataFrame:
    """The packed rows of all documents (SCHEMA); ``id_bits`` is 16 or 32."""
    dtype = {16: "<u2", 32: "<u4"}[id_bits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(length, dtype, pad_id, TaskContext.get().partitionId())
        for part in slices(batches, "text", BLOCK_BYTES):
            ids, counts = _memo(ranks, pattern).values_of(part.column("text"))
            if id_bits == 16 and len(ids) and int(ids.max()) >= 1 << 16:
                raise ValueError("ids do not fit 16 bits; use id_bits=32")
            ids = ids.astype(dtype)
            rows: list = []
            for doc_id, own in zip(part.column("doc_id").to_pylist(), np.split(ids, np.cumsum(counts)[:-1]),
                                   strict=True):
                rows += packer.add(doc_id, own.copy())
            if packer.held >= block_tokens:
                rows += packer.flush()
            for at in range(0, len(rows), 512):
                yield packer.batch(rows[at:at + 512])
        rows = packer.flush()
        for at in range(0, len(rows), 512):
            yield packer.batch(rows[at:at + 512])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def unpack(packed: DataFrame, id_bits: int = 16) -> DataFrame:
    """doc_id, ids array<int>: the ids of each document in order (documents with ids; doc_ids must be distinct)."""
    dtype = {16: "<u2", 32: "<u4"}[id_bits]
    schema = "doc_id long, start long, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype).astype(np.int32)
                ends = row["cu_seqlens"]
                out += [(d, s, ids[a:b]) for d, s, a, b in
                        zip(row["doc_ids"], row["doc_starts"], ends[:-1], ends[1:], strict=True)]
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.list_(pa.int32())], strict=True)],
                ["doc_id", "start", "ids"])

    pieces = packed.select("ids", "cu_seqlens", "doc_ids", "doc_starts").mapInArrow(run, schema)
    return (pieces.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "ids"))).alias("parts"))
            .select("doc_id", F.flatten(F.col("parts.ids")).alias("ids")))


def write_matrices(packed: DataFrame, path: str, rows_per_file: int = 4096, id_bits: int = 16) -> DataFrame:
    """Write the rows as files under ``path`` (shared): ids-*.bin, a rows x length matrix; segments-*.npz
    with cu_seqlens (all rows' one after the other), row_segments (entries of each row) and position_ids
    (a matrix, counting from 0 in each segment; 0 in the padding); meta-*.json.
    Returns (ids_file, segments_file, rows, length)."""
    dtype = np.dtype({16: "<u2", 32: "<u4"}[id_bits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, folder = open_filesystem(path)
        filesystem.create_dir(folder, recursive=True)
        held: list[dict] = []

        def store() -> pa.RecordBatch:
            name = uuid.uuid4().hex
            matrix = np.stack([np.frombuffer(r["ids"], dtype) for r in held])
            positions = np.zeros(matrix.shape, np.int32)
            for k, r in enumerate(held):
                for a, b in zip(r["cu_seqlens"][:-1], r["cu_seqlens"][1:], strict=True):
                    positions[k, a:b] = np.arange(b - a)
            packed_file = io.BytesIO()
            np.savez_compressed(packed_file, position_ids=positions,
                                cu_seqlens=np.concatenate([r["cu_seqlens"] for r in held]).astype(np.int32),
                                row_segments=np.array([len(r["cu_seqlens"]) for r in held], np.int32))
            meta = {"rows": len(held), "length": matrix.shape[1], "dtype": dtype.str,
                    "pack_ids": [r["pack_id"] for r in held]}
            for kind, body in ((f"ids-{name}.bin", matrix.tobytes()), (f"segments-{name}.npz", packed_file.getvalue()),
                               (f"meta-{name}.json", json.dumps(meta).encode())):
                with filesystem.open_output_stream(f"{folder}/{kind}") as f:
                    f.write(body)
            held.clear()
            return pa.RecordBatch.from_pydict({
                "ids_file": [f"{path}/ids-{name}.bin"], "segments_file": [f"{path}/segments-{name}.npz"],
                "rows": pa.array([matrix.shape[0]], pa.int64()), "length": pa.array([matrix.shape[1]], pa.int64())})

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                held += batch.slice(at, 256).to_pylist()
                if len(held) >= rows_per_file:
                    yield store()
        if held:
            yield store()

    return cut(packed.mapInArrow(run, "ids_file string, segments_file string, rows long, length long"), "matrices")

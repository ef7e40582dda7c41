import json
import random

import numpy as np
import pytest

from spendlake.llm import packing
from spendlake.llm.queries import QUERIES

from .fixtures import SF, TEXTS, odd_docs, table
from .test_bpe import ENCODING


def brute_best_fit(lengths, capacity):
    rows, room = [], []
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [(r, k) for k, r in enumerate(room) if r >= lengths[item]]
        if not fits:
            rows.append([])
            room.append(capacity)
            fits = [(capacity, len(rows) - 1)]
        least = min(r for r, _ in fits)
        k = next(k for r, k in fits if r == least)
        rows[k].append(item)
        room[k] -= lengths[item]
    return rows, sorted(room)


@pytest.mark.parametrize("capacity", [1, 7, 8, 9, 64, 100])
def test_packing_is_as_dense_as_a_plain_search(capacity):
    rng = random.Random(capacity)
    for n in (0, 1, 5, 60, 300):
        lengths = [rng.randint(1, capacity) for _ in range(n)]
        rows = packing.best_fit_decreasing(lengths, capacity)
        assert sorted(k for row in rows for k in row) == list(range(n))
        room = sorted(capacity - sum(lengths[k] for k in row) for row in rows)
        assert (len(rows), room) == (len(brute_best_fit(lengths, capacity)[0]), brute_best_fit(lengths, capacity)[1])


def check_rows(rows, length, id_bits=16):
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2" if id_bits == 16 else "<u4")
        ends = r["cu_seqlens"]
        assert len(ids) == length and ends[0] == 0 and ends[-1] == r["n_tokens"] <= length
        assert (ids[r["n_tokens"]:] == 0).all() and all(a < b for a, b in zip(ends, ends[1:], strict=False))
        assert r["position_resets"] == ends[:-1]
        assert len(r["doc_ids"]) == len(r["doc_starts"]) == r["n_segments"] == len(ends) - 1
    assert len({r["pack_id"] for r in rows}) == len(rows)


def test_query_loses_nothing(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    packed = QUERIES["op7_packed_token_ids"](spark, SF)
    check_rows(packed.collect(), 2048)
    got = {r["doc_id"]: list(r["ids"]) for r in packing.unpack(packed).collect()}
    assert got == {k: ENCODING.encode_ordinary(t) for k, t in texts.items() if t}
    total = sum(map(len, got.values()))
    n = packed.count()
    assert n <= total / 2048 * 1.1 + packed.rdd.getNumPartitions() + 1


def test_overlong_documents_and_blocks(spark):
    docs = table(spark, "documents")
    packed = packing.pack(docs, length=64, block_tokens=500, id_bits=32)
    check_rows(packed.collect(), 64, 32)
    got = {r["doc_id"]: list(r["ids"]) for r in packing.unpack(packed, 32).collect()}
    assert got == {r["doc_id"]: ENCODING.encode_ordinary(r["text"]) for r in docs.collect() if r["text"]}


def test_matrices(spark, tmp_path):
    packed = packing.pack(table(spark, "documents"), length=256)
    files = packing.write_matrices(packed, str(tmp_path), rows_per_file=300).collect()
    rows = {r["pack_id"]: r for r in packed.collect()}
    seen = 0
    for f in files:
        matrix = np.fromfile(f["ids_file"], "<u2").reshape(f["rows"], f["length"])
        held = np.load(f["segments_file"])
        meta = json.load(open(f["ids_file"].replace("ids-", "meta-").replace(".bin", ".json")))
        parts = np.split(held["cu_seqlens"], np.cumsum(held["row_segments"])[:-1])
        for line, ends, positions, pack_id in zip(matrix, parts, held["position_ids"], meta["pack_ids"], strict=True):
            assert line.tobytes() == bytes(rows[pack_id]["ids"]) and ends.tolist() == rows[pack_id]["cu_seqlens"]
            want = [k for a, b in zip(ends, ends[1:], strict=False) for k in range(b - a)]
            assert positions[:len(want)].tolist() == want
            seen += 1
    assert seen == len(rows)


def test_odd_rows_and_empty_table(spark):
    rows = packing.pack(odd_docs(spark), length=128).collect()
    check_rows(rows, 128)
    got = [(d, b - a) for r in rows for d, a, b in
           zip(r["doc_ids"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False)]
    per_doc = {}
    for d, n in got:
        per_doc[d] = per_doc.get(d, 0) + n
    want = {}
    for d, t, *_ in TEXTS:
        if t:
            want[d] = want.get(d, 0) + len(ENCODING.encode_ordinary(t))
    assert per_doc == want
    assert packing.pack(odd_docs(spark, [])).count() == 0

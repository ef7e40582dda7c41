import random

import xxhash

from pyspark.sql import functions as F

from spendlake.llm import simhash
from spendlake.llm.queries import QUERIES

from .fixtures import SF, odd_docs, table


def brute_fingerprint(text, k=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c == " " or "\t" <= c <= "\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=2):
    """Smallest key of each key's component; prints: key -> fingerprint."""
    top = {k: k for k in prints}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    component = brute_components(prints)
    got = QUERIES["op10_simhash_near_dedup"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        k: (f"{prints[k]:016x}", component[k]) for k in texts}
    assert len(got) == len(texts)
    assert any(k != c for k, c in component.items())


def test_links_equal_brute_force_for_clusters(spark):
    rng = random.Random(5)
    values = {0, 1, (1 << 64) - 1, 1 << 63, 0x5555555555555555}
    for _ in range(40):
        center = rng.getrandbits(64)
        values.add(center)
        for _ in range(12):
            v = center
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    points = spark.createDataFrame([(v,) for v in signed], "fp long")
    for bits in (0, 1, 2, 3):
        got = {(r["a"], r["b"]) for r in simhash.links(points, bits).collect()}
        want = {(a, b) for a in signed for b in signed
                if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits}
        assert got == (want if bits else set())


def test_components_of_long_chains(spark):
    chain = list(range(400))
    random.Random(3).shuffle(chain)
    edges = [(min(a, b), max(a, b)) for a, b in zip(chain, chain[1:], strict=False)] + [(1000, 1001), (1001, 1002)]
    got = {r["node"]: r["label"] for r in
           simhash.component_labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(400), 0), 1000: 1000, 1001: 1000, 1002: 1000}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(r["fp"] == 0 and r["component_id"] == 2 for k in (2, 3, 4) for r in by[k])  # no words
    assert {r["component_id"] for r in by[None]} == {1, 2}  # null ids take their text's component
    assert [r["component_id"] for r in by[5]] == [5, 5] and by[6][0]["component_id"] == 5


def test_one_of_each_group_stays(spark):
    docs = odd_docs(spark)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    found = simhash.near_duplicates(docs).select("component_id", "rep_fp").distinct().count()
    assert len(ids) == found
    assert ids.count(5) == 1 and 6 not in ids and None not in ids and 3 not in ids


def test_empty_table(spark):
    docs = odd_docs(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one_per_group(docs).count() == 0


def test_ties_of_id_and_fingerprint_have_one_result(spark):
    """Two texts under one id, alike but for case, with equal fingerprints: the same one stays in any order."""
    rows = [(1, "one two three four five", "a"), (1, "ONE two three four five", "b"), (2, "one two three four FIVE", "c")]
    kept = {tuple(simhash.keep_one_per_group(spark.createDataFrame(r, "doc_id long, text string, tag string")
                                             .repartition(3)).collect()[0])
            for r in (rows, rows[::-1], [rows[1], rows[2], rows[0]])}
    assert len(kept) == 1 and kept.pop()[0] == 1


def test_clashing_names_stay(spark):
    names = ["__id", "__fp", "__print", "__row", "__row1", "fp", "row", "digest", "component_id", "cell"]
    docs = odd_docs(spark)
    for n in names:
        docs = docs if n in docs.columns else docs.withColumn(n, F.lit(n))
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns and {r["__fp"] for r in kept.collect()} == {"__fp"}
    assert simhash.near_duplicates(docs).count() == docs.count()

import random

import numpy as np

from spendlake.llm import decontaminate as dc
from spendlake.llm.queries import QUERIES

from .fixtures import SF, odd_docs, table


def brute_align(item, passage):
    """Smith-Waterman share by the textbook table."""
    above, best = [0] * (len(passage) + 1), 0
    for w in item:
        row = [0]
        for j, v in enumerate(passage, 1):
            row.append(max(0, above[j - 1] + (2 if v == w else -1), above[j] - 1, row[j - 1] - 1))
        above, best = row, max(best, *row)
    return best / (2 * len(item))


def test_alignment_equals_the_textbook():
    rng = random.Random(0)
    for _ in range(300):
        item = np.array(rng.choices(range(5), k=rng.randint(1, 12)))
        passage = np.array(rng.choices(range(5), k=rng.randint(1, 30)))
        share, a, b = dc.align(item, passage)
        assert share == brute_align(item.tolist(), passage.tolist())
        assert brute_align(item.tolist(), passage[a:b].tolist()) == share


def word_ids(text, known):
    return np.array([known.setdefault(w, len(known)) for w in dc.normalise(text).split()], np.int64)


def test_query_equals_aligning_every_pair(spark):
    known = {}
    docs = {r["doc_id"]: word_ids(r["text"], known) for r in table(spark, "documents").collect()}
    items = {r["item_id"]: word_ids(r["text"], known) for r in table(spark, "benchmark").collect()}
    want = {}
    for d, words in docs.items():
        for i, item in items.items():
            if len(np.intersect1d(words, item)) * 4 >= len(set(item.tolist())):  # else no score of 0.5
                share = dc.align(item, words)[0] if len(words) else 0
                if share >= 0.5:
                    want[d, i] = share
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in QUERIES["op6_benchmark_decontamination"](spark, SF).collect()}
    assert got == want and want


WORDS = [f"word{k}" for k in range(4000)]


def test_edited_copies_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(1)
    items = [(k, " ".join(rng.choices(WORDS, k=30))) for k in range(20)] + [(20, "of the most"), (21, None), (22, "")]
    docs, want = [], set()
    for d in range(200):
        body = rng.choices(WORDS, k=120)
        if d % 2:
            item = rng.randrange(20)
            copy = items[item][1].split()
            for _ in range(5):  # replace, drop or add a word
                at = rng.randrange(len(copy))
                copy[at:at + rng.choice((0, 1))] = rng.choice(([], ["new"]))
            at = rng.randrange(len(body))
            body[at:at] = copy
            want.add((d, item))
        docs.append((d, "\n".join([" ".join(body[:60]), " ".join(body[60:])]).upper()))
    docs.append((500, "one of the most, indeed"))
    want.add((500, 20))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(frame, bench).collect()}
    assert got == want
    blocks = {(r["doc_id"], r["item_id"]) for r in
              dc.find_leaks(frame, bench, dc.Settings(block_words=100)).collect()}
    assert blocks == want
    kept = {r["doc_id"] for r in dc.drop_leaks(frame, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_an_item_that_leaked_everywhere_keeps_its_seeds(spark):
    rng = random.Random(2)
    item = " ".join(rng.choices(WORDS, k=20))
    docs = spark.createDataFrame([(d, " ".join(rng.choices(WORDS, k=10)) + " " + item) for d in range(300)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert dc.find_leaks(docs, bench).count() == 300


def test_an_edited_copy_is_found_however_often_it_is_repeated(spark):
    rng = random.Random(3)
    bench, docs, want = [], [], set()
    for item, (every, copies, whole) in enumerate([(5, 9, 0), (6, 9, 0), (5, 1000, 0), (5, 9, 1)]):
        words = rng.sample(WORDS, 30)
        edited = [f"new{k}" if k % every == every - 1 else w for k, w in enumerate(words)]
        bench.append((item, " ".join(words)))
        for k in range(copies + whole):
            body = edited if k < copies else words
            want.add((len(docs), item))
            docs.append((len(docs), " ".join([*rng.choices(WORDS, k=10), *body, *rng.choices(WORDS, k=10)])))
    found = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert all(r["score"] >= 0.7 and r["n_seeds"] >= 1 for r in found)


def test_copies_without_four_equal_neighbours_are_found(spark):
    rng = random.Random(4)
    bench, docs, want = [], [], {}

    def edits(words):
        yield [f"new{k}" if k % 4 == 3 else w for k, w in enumerate(words)]  # every fourth word replaced
        yield [x for w in words for x in (w, "added")][:-1]  # a word added after each
        yield [w for k, w in enumerate(words) if k % 3]  # every third word left out
        yield [f"new{k}" if k % 7 == 6 else w for k, w in enumerate(words) if k % 5 != 1]

    known = {}
    for item in range(60):  # half of them begin alike
        words = (WORDS[:6] if item % 2 else []) + rng.sample(WORDS, rng.randint(8, 34))
        bench.append((item, " ".join(words)))
        for copy in edits(words):
            docs.append((len(docs), " ".join([*rng.choices(WORDS, k=30), *copy, *rng.choices(WORDS, k=30)])))
    for d, text in docs:
        for item, body in bench:
            share = dc.align(word_ids(body, known), word_ids(text, known))[0]
            if share >= 0.5:
                want[d, item] = share
    found = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == want and len(want) > 150


def test_items_in_scripts_without_spaces_are_found_inside_longer_clauses(spark):
    items = ["\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u4e00\u8d77\u53bb\u516c\u56ed\u6563\u6b65",
             "\u79c1\u306f\u6bce\u671d\u30b3\u30fc\u30d2\u30fc\u3092\u98f2\u307f\u307e\u3059",
             "\u0e09\u0e31\u0e19\u0e0a\u0e2d\u0e1a\u0e01\u0e34\u0e19\u0e02\u0e49\u0e32\u0e27\u0e1c\u0e31\u0e14"]
    docs = [(k, x[-1] + x[::-1] + item + x[::-1], item) for k, (item, x) in
            enumerate(zip(items, items[1:] + items[:1], strict=True))]
    docs += [(k + 3, f"seen {x[:9]}, {x[9:]} here", x) for k, x in enumerate(items)]
    docs += [(6, "\u4eca\u5929\u4e0d\u53bb", None), (7, "one two three four five six seven eight", None)]
    found = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string, of string"),
                          spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["score"]) for r in found} == {
        (d, items.index(of), 1.0) for d, _, of in docs if of}


def test_odd_rows(spark):
    docs = odd_docs(spark)
    bench = spark.createDataFrame([
        (1, "the QUICK brown fox -- jumps over the lazy dog near", "x"),
        (1, "the QUICK brown fox -- jumps over the lazy dog near", "x"), (None, None, None), (2, None, "x"),
        (3, "dolor sit amet consectetur adipiscing elit lorem ipsum", "y")], "item_id long, text string, score string")
    got = sorted(str((r["doc_id"], r["item_id"])) for r in dc.find_leaks(docs, bench).collect())
    assert got == sorted(str(x) for x in [(1, 1), (None, 1), (5, 3), (6, 3)])
    kept = dc.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("2 3 4 None None 7 8 9 9".split())


def test_empty_tables(spark):
    docs, none = odd_docs(spark), odd_docs(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_leaks(docs, bench).count() == 0 and dc.drop_leaks(docs, bench).count() == docs.count()
    assert dc.find_leaks(none, table(spark, "benchmark")).count() == 0


def test_rows_of_one_id_stay_or_go_by_their_own_text(spark):
    item = table(spark, "benchmark").first()["text"]
    rows = [(1, item, "a"), (1, "clean words of one document", "b"), (2, "clean words of another", "c"),
            (None, item + " more", "d"), (None, "clean", "e"), (1, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __leaked string")
    for null_ids, gone in ((False, "a"), (True, "ad")):
        kept = dc.drop_leaks(docs, table(spark, "benchmark"), null_ids=null_ids)
        assert sorted(r["__leaked"] for r in kept.collect()) == [c for c in "abcdef" if c not in gone]


def test_items_of_any_length_by_one_rule(spark):
    """Edited copies of items of 3 to 30 words: found exactly where the alignment reaches the score."""
    rng = random.Random(6)
    bench, docs, known, want = [], [], {}, {}
    for size in range(3, 31):
        words = rng.sample(WORDS, size)
        bench.append((size, " ".join(words)))
        for edits in range(0, 1 + size // 3):
            copy = list(words)
            for at in rng.sample(range(size), edits):
                copy[at] = f"new{at}"
            docs.append((len(docs), " ".join([*rng.choices(WORDS, k=12), *copy, *rng.choices(WORDS, k=12)])))
    for d, text in docs:
        for item, body in bench:
            own = word_ids(body, known)
            share = dc.align(own, word_ids(text, known))[0]
            if share >= max(0.5, min(1, 4 / len(own))):
                want[d, item] = share
    found = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == want
    assert {len(b.split()) for _, b in bench} == set(range(3, 31)) and any(i < 8 and s < 1 for (_, i), s in want.items())


def test_seeds_are_the_rare_pairs_of_the_documents(spark):
    """Pairs of a phrase that many documents hold are no seeds, up to half of the hits an
    alignment has (five of eleven here), and every copy is still found."""
    rng = random.Random(7)
    phrase = ["as", "we", "all", "know", "very", "well"]
    items = [(k, " ".join([*rng.sample(WORDS, 9), *phrase, *rng.sample(WORDS, 9)])) for k in range(5)]
    docs = [(d, " ".join([*rng.choices(WORDS, k=9), *phrase, *rng.choices(WORDS, k=9)])) for d in range(300)]
    docs += [(1000 + k, "so " + text) for k, text in items]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    everything = dc.build_items(items, dc.Settings())
    counts = dc._counts(frame, everything)
    rare = dc.build_items(items, dc.Settings(), counts)
    common = {g for g, n in counts.items() if n > 300}
    assert len(common) == 9 and common <= set(everything.grams.tolist())
    assert len(common & set(rare.grams.tolist())) == 4 and rare.needed.tolist() == [6] * 5
    assert set(everything.grams.tolist()) - set(rare.grams.tolist()) <= common
    found = dc.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1000 + k, k) for k, _ in items}


def test_counts_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(0, "a b c d e f g h"), (1, "c d x"), (2, "y")]
    docs = [(k, " ".join(rng.choices("abcdefghxyz", k=rng.randint(0, 30)))) for k in range(80)]
    built = dc.build_items(items, dc.Settings())
    counts = dc._counts(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), built)

    def hashes(text, width, gap=None):
        raw, starts, ends, _ = dc._words([dc.normalise(text)])
        word = dc.word_hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        return (dc.grams(word, width) if gap is None else dc.pairs(word, gap)).tolist()

    want = {}
    for _, text in docs:
        for g in [*hashes(text, 0, 1), *hashes(text, 0, 2), *(h for n in built.widths for h in hashes(text, n))]:
            if g in set(built.grams.tolist()):
                want[g] = want.get(g, 0) + 1
    assert counts == want != {}

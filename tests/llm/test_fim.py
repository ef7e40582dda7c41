import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from spendlake.llm import fim
from spendlake.llm.queries import QUERIES

from .fixtures import SF, TEXTS, odd_docs, table


def brute(doc_id, text):
    """The contract, unit by unit."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), "<S>" + suffix + "<P>" + prefix + "<M>" + middle
    return len(units), "psm", len(prefix), len(middle), "<P>" + prefix + "<S>" + suffix + "<M>" + middle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    want = []
    for r in table(spark, "documents").collect():
        n, form, p, m, out = brute(r["doc_id"], r["text"])
        want.append((r["doc_id"], n, form, p, m, sha(out), sha(r["text"] or "")))
    got = [tuple(r) for r in QUERIES["op11_fill_in_middle"](spark, SF).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_odd_rows_marks_and_round_trip(spark):
    tricky = [(100 + k, t, "en", "a") for k, t in enumerate(
        ["<", "<S", "a<", "<<<<P", "S>M>", "<P", "x<P>y", "<S>", "ab<M>", "\x00\x1f", "é\U0001f600中a", "a" * 5000,
         " ", "\r\n\t", "P>S>M>" * 9] * 4)]
    rows = TEXTS + tricky
    made = fim.transform(odd_docs(spark, rows))
    back = made.select("*", fim.restore(F.col("output"), F.col("form")).alias("restored")).collect()
    want = [str((d, *brute(d, t), t or "")) for d, t, *_ in rows]
    assert sorted(str(tuple(r)) for r in back) == sorted(want)
    assert fim.transform(odd_docs(spark, [])).count() == 0


def test_segments_of_very_long_texts_give_the_same_cuts():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choices(["a", "bcd", " ", "é", "\n", "Zz" * 9, "1"], k=rng.randint(0, 60)))
        draws = tuple(rng.getrandbits(32) for _ in range(4))
        whole = fim.rewrite(text, draws)
        for segment in (1, 2, 7, 30):
            assert fim.rewrite(text, draws, segment=segment) == whole
            bounds = fim.segment_bounds(text, segment)
            assert "".join(text[a:b] for a, b in zip(bounds, bounds[1:])) == text


def test_ten_million_units():
    text = " a1" * 3_400_000
    n, form, p, m, out = fim.rewrite(text, (7, 10_000_000, 0, 99))
    assert (n, form, p, m) == (10_200_000, "psm", 7, 10_000_000 - 7)
    assert out == "<P>" + text[:7] + "<S>" + text[10_000_000:] + "<M>" + text[7:10_000_000]


@pytest.mark.parametrize("rate,spm,forms", [(0, 0, {"plain"}), (100, 100, {"spm"}), (100, 0, {"psm"})])
def test_shares(spark, rate, spm, forms):
    docs = table(spark, "documents").filter("text <> '' AND text NOT RLIKE '<[PSM]>'")
    assert {r["form"] for r in fim.transform(docs, rate, spm).select("form").distinct().collect()} == forms

import re
from collections import Counter

from spendlake.llm import quality_rules
from spendlake.llm.queries import QUERIES

from .fixtures import SF, odd_docs, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    n = len(words)
    return (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside),
            n < 50 or 100 * len(inside) > 50 * n)


def test_base_columns_equal_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    rows = QUERIES["op3_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == brute_base(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_lines():
    judge = quality_rules.Judge(quality_rules.Rules())

    def rule(line):
        return judge.line_fails(line, line.split())

    assert rule("The report was read by everyone in the room before lunch.") is None
    assert rule("a heading that is rather long without a full stop") is None
    assert rule("Home") == "punctuation" and rule("Yes.") is None
    assert rule("word### other&&& more$$$ text***") == "punctuation"
    assert rule("BUY!! NOW!! ALL!! MUST go") == "punctuation"
    assert rule("Home | News | Sport | About us") == "navigation"
    assert rule("Our site uses cookies to give you the best experience.") == "boilerplate"
    assert rule("Licensed under CC BY-NC 4.0.") == "boilerplate"
    assert rule("Alle Rechte vorbehalten. Lesen Sie unsere Datenschutzerklärung.") == "boilerplate"
    assert rule("Ce site utilise des cookies pour améliorer votre visite.") == "boilerplate"
    assert rule("TODOS LOS DERECHOS RESERVADOS, empresa de ejemplo.") == "boilerplate"
    assert rule("Er ging am Abend nach oben und las weiter in dem Buch.") is None
    assert rule("Elle a lu la suite du livre avant de dormir.") is None
    assert rule("Quiere leer otros libros y más cuentos este verano.") is None


def test_removed_lines_and_verdict(spark):
    good = "\n".join(" ".join(f"w{k}x{j}" for j in range(9)) + "." for k in range(12))
    docs = spark.createDataFrame([
        (1, good, 0), (2, good + "\nHome | About | Login", 0),
        (3, good + "\n" + "\n".join(" ".join(f"B{k}Y{j}!!" for j in range(9)) for k in range(14)), 0)],
        "doc_id long, text string, n_chars long")
    rows = {r["doc_id"]: r for r in quality_rules.clean(docs).collect()}
    assert set(rows) == {1, 2} and rows[1]["text"] == good == rows[2]["text"]
    assert rows[2]["n_chars"] == len(good)
    lost = {r["doc_id"]: (r["lost_chars"], r["kept"]) for r in quality_rules.judge(docs).collect()}
    assert lost[1] == (0, True) and lost[2][1] and not lost[3][1]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = quality_rules.judge(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] in (2, 3, 4):
            assert r["n_words"] == 0 and r["base_failed"] and not r["kept"]
        if r["doc_id"] in (5, 6):
            assert r["n_words"] == 16000 and r["n_repeat_words"] == 16000 and r["base_failed"]
    cleaned = quality_rules.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == 0


def test_empty_table(spark):
    docs = odd_docs(spark, [])
    assert quality_rules.judge(docs).count() == 0 and quality_rules.clean(docs).count() == 0

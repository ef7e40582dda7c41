import hashlib
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from conftest import HEADER, write_csv
from spendlake.operators import ingest
from spendlake.sources.exports import layouts, read_exports, scan

F1 = "Konto 0718 - 2024-02-01 08.00.00.csv"
F0 = "Konto 0718 - 2024-01-16 08.00.00.csv"


def by_desc(rows):
    return {r["description"]: r for r in rows}


def test_dialect_and_values(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [
        ["2024/01/05", "-1.234,56", "0718", "", "Dankort; føtex \"city\"", "multi\nline", "10.000,00", "DKK", ""],
        ["2024/01/06", "1234.56", "", "0718", "", "point", "", "DKK", "ja"],
        ["", "", "", "", "", "", "", "", ""],
        ["Reserveret", "5,00", "", "0718", "", "pending", "", "DKK", ""],
    ])
    rows = read_exports(spark, str(tmp_path)).collect()
    assert len(rows) == 3  # the empty record is not a row
    d = by_desc(rows)
    assert d["multi\nline"]["amount"] == Decimal("-1234.56")
    assert d["multi\nline"]["name"] == 'Dankort; føtex "city"'
    assert d["multi\nline"]["balance"] == Decimal("10000.00")
    assert d["multi\nline"]["source_file"] == F1
    assert d["point"]["amount"] == Decimal("123456.00")
    assert d["point"]["reconciled"] == "ja"
    assert d["pending"]["posting_date_text"] is None


def test_short_row_is_padded(spark, tmp_path):
    header = ["Bogføringsdato", "Beløb", "Valuta", "Beskrivelse", "Afsender", "Modtager", "Navn", "Saldo", "Afstemt"]
    write_csv(tmp_path / F1, header, [["2024/01/07", "-3,00", "DKK", "short"]], trailing=False)
    r = read_exports(spark, str(tmp_path)).first()
    assert r["description"] == "short" and r["currency"] == "DKK"
    assert r["sender"] is None and r["balance"] is None and r["reconciled"] is None


def test_short_row_currency_empty_fails(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [["2024/01/07", "-3,00", "0718", "", "", "short"]])
    with pytest.raises(PySparkException, match="Empty required value"):
        read_exports(spark, str(tmp_path)).collect()


def test_header_bound_by_name(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [["2024/01/05", "-10,00", "0718", "", "n", "usual", "1,00", "DKK", ""]])
    other = ["Beløb", "Beskrivelse", "Bogføringsdato", "Afsender", "Modtager", "Navn", "Saldo", "Valuta", "Afstemt"]
    write_csv(tmp_path / "Konto 0719 - 2024-02-01 08.00.00.csv", other,
              [["-10,00", "reordered", "2024/01/05", "0719", "", "n", "1,00", "DKK", ""]], trailing=False)
    d = by_desc(read_exports(spark, str(tmp_path)).collect())
    for k in ("usual", "reordered"):
        assert d[k]["amount"] == Decimal("-10.00") and d[k]["posting_date_text"] == "2024/01/05"
        assert d[k]["name"] == "n" and d[k]["balance"] == Decimal("1.00")


def test_missing_currency_header_defaults(spark, tmp_path):
    header = [h for h in HEADER if h != "Valuta"]
    write_csv(tmp_path / F1, header, [["2024/01/05", "-10,00", "0718", "", "n", "x", "", ""]])
    assert read_exports(spark, str(tmp_path)).first()["currency"] == "DKK"


def test_missing_required_header_fails(spark, tmp_path):
    header = [h for h in HEADER if h != "Saldo"]
    write_csv(tmp_path / F1, header, [["2024/01/05", "-10,00", "0718", "", "n", "x", "DKK", ""]])
    with pytest.raises(ValueError, match="Missing column for field 'balance'.*Konto 0718"):
        read_exports(spark, str(tmp_path))


def test_empty_values_fail_or_reject(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [
        ["2024/01/05", "", "0718", "", "n", "no amount", "", "DKK", ""],
        ["2024/01/05", "-1,00", "0718", "", "n", "no currency", "", "", ""],
        ["2024/01/05", "-2,00", "0718", "", "n", "good", "", "DKK", ""],
    ])
    with pytest.raises(PySparkException, match="Empty required value"):
        read_exports(spark, str(tmp_path)).collect()
    good, rejects = read_exports(spark, str(tmp_path), on_error="reject")
    assert [r["description"] for r in good.collect()] == ["good"]
    assert sorted((r["reason"], r["description"]) for r in rejects.collect()) == [
        ("empty amount", "no amount"), ("empty currency", "no currency")]


def test_bad_date_names_value_and_file(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [["2024-01-05", "-1,00", "0718", "", "", "x", "", "DKK", ""]])
    with pytest.raises(PySparkException, match="2024-01-05' in file 'Konto 0718 - 2024-02-01 08.00.00.csv"):
        ingest.load(read_exports(spark, str(tmp_path))).collect()


def test_account_without_prefix(spark, tmp_path):
    write_csv(tmp_path / "other.csv", HEADER, [["2024/01/05", "-1,00", "", "", "", "x", "", "DKK", ""]])
    typed = ingest.typed_rows(read_exports(spark, str(tmp_path))).first()
    assert typed["account"] == "other.csv"


def test_not_recursive_and_only_csv(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [["2024/01/05", "-1,00", "", "", "", "top", "", "DKK", ""]])
    (tmp_path / "sub").mkdir()
    write_csv(tmp_path / "sub" / F0, HEADER, [["2024/01/05", "-1,00", "", "", "", "nested", "", "DKK", ""]])
    write_csv(tmp_path / "notes.txt", HEADER, [["2024/01/05", "-1,00", "", "", "", "txt", "", "DKK", ""]])
    assert [r["description"] for r in read_exports(spark, str(tmp_path)).collect()] == ["top"]


def test_hash_and_large_amount(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [["2024/01/05", "12.345.678,90", "a", "b", "c", "d", "", "DKK", ""]])
    raw = ingest.load(read_exports(spark, str(tmp_path))).first()
    assert raw["transaction_hash"] == hashlib.md5("2024/01/05|12345678.9|d|c|a|b".encode()).hexdigest()


def test_split_large_file_keeps_header_and_order(spark, tmp_path):
    # One large export read in byte-range splits: the header binds every
    # split, and the first of two equal rows (by file position) wins.
    n = 60000
    rows = [["2024/01/%02d" % (i % 28 + 1), "-%d,00" % (i % 997), "0718", "", "n%d" % (i % 5000), "d%d" % i,
             "%d,00" % i, "DKK", ""] for i in range(n)]
    rows.append(["2024/01/01", "-0,00", "0718", "", "n0", "d0", "999999,00", "DKK", ""])  # same key as row 0
    header = ["Beskrivelse", "Bogføringsdato", "Beløb", "Afsender", "Modtager", "Navn", "Saldo", "Valuta", "Afstemt"]
    reordered = [[r[5], r[0], r[1], r[2], r[3], r[4], r[6], r[7], r[8]] for r in rows]
    write_csv(tmp_path / F1, header, reordered)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        (columns, paths), = layouts(spark, str(tmp_path)).items()
        cells = scan(spark, paths, len(columns), split_files=True)
        assert cells.rdd.getNumPartitions() > 4
        got = read_exports(spark, str(tmp_path), split_files=True)
        assert got.count() == n + 1
        raw = ingest.load(got)
        assert raw.count() == n
        first = raw.filter("description = 'd0'").first()
        assert first["balance"] == Decimal("0.00") and first["amount"] == Decimal("0.00")
        whole = ingest.load(read_exports(spark, str(tmp_path)))
        assert sorted(r.transaction_hash for r in whole.collect()) == sorted(r.transaction_hash for r in raw.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("extra", [56, 64, 190])
def test_any_number_of_columns(spark, tmp_path, extra):
    header = HEADER[:7] + [f"x{k}" for k in range(extra)] + HEADER[7:]
    row = ["2024/01/05", "-10,00", "0718", "", "n", "wide", "1,00"] + ["y"] * extra + ["EUR", "ja"]
    write_csv(tmp_path / F1, header, [row])
    r = read_exports(spark, str(tmp_path)).first()
    assert (r["currency"], r["reconciled"], r["description"]) == ("EUR", "ja", "wide")


def test_layouts(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [])
    write_csv(tmp_path / F0, HEADER, [], bom=False, trailing=False)
    write_csv(tmp_path / "Konto 0719 - x;y.csv", ['two "quoted"\nlines', "b"], [])
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n")
    found = {h: len(p) for h, p in layouts(spark, str(tmp_path)).items()}
    assert found == {tuple(HEADER) + ("",): 1, tuple(HEADER): 1, ('two "quoted"\nlines', "b", ""): 1}


def test_folder_without_exports(spark, tmp_path):
    assert read_exports(spark, str(tmp_path)).count() == 0
    (tmp_path / "empty.csv").write_text("")
    rows, rejects = read_exports(spark, str(tmp_path), on_error="reject")
    assert rows.count() == rejects.count() == 0


def test_records_are_scanned_once_without_a_shuffle(spark, tmp_path):
    write_csv(tmp_path / F1, HEADER, [["2024/01/05", "-10,00", "0718", "", "n", "x", "1,00", "DKK", ""]])
    plan = read_exports(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert not any(x in plan for x in ("Exchange", "Sort", "Aggregate", "Join"))

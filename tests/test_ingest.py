import datetime as dt
import hashlib
from decimal import Decimal

from conftest import HEADER, SF0001, write_csv
from spendlake.operators import ingest
from spendlake.sources.adapters import events_export_rows
from spendlake.sources.exports import read_exports

NEW = "Konto 0718 - 2024-02-01 08.00.00.csv"
OLD = "Konto 0718 - 2024-01-16 08.00.00.csv"
OTHER = "Konto 0720 - 2024-03-01 08.00.00.csv"


def row(date, amount, desc, sender="0718", balance=""):
    return [date, amount, sender, "", "", desc, balance, "DKK", ""]


def loaded(spark, path):
    return {r["description"]: r for r in ingest.load(read_exports(spark, str(path))).collect()}


def test_newest_file_wins_per_account_and_day(spark, tmp_path):
    write_csv(tmp_path / NEW, HEADER, [row("2024/01/10", "-1,00", "new-10a"), row("2024/01/10", "-2,00", "new-10b")])
    write_csv(tmp_path / OLD, HEADER, [row("2024/01/10", "-3,00", "old-10"), row("2024/01/09", "-4,00", "old-09")])
    write_csv(tmp_path / "Konto 0719 - 2024-01-16 08.00.00.csv", HEADER, [row("2024/01/10", "-5,00", "acct2-10", "0719")])
    assert sorted(loaded(spark, tmp_path)) == ["acct2-10", "new-10a", "new-10b", "old-09"]


def test_same_key_first_row_wins(spark, tmp_path):
    write_csv(tmp_path / NEW, HEADER, [row("2024/01/10", "-1,00", "dup", balance="1,00"),
                                       row("2024/01/10", "-1,00", "dup", balance="2,00")])
    got = ingest.load(read_exports(spark, str(tmp_path))).collect()
    assert len(got) == 1 and got[0]["balance"] == Decimal("1.00")


def test_duplicate_still_claims_its_date(spark, tmp_path):
    # The newest file of account 0718 has one row on 01/10, a duplicate of a
    # key already loaded from a higher-named file of another account.  It is
    # dropped as duplicate, yet 01/10 stays claimed: the older file's 01/10
    # rows are skipped.
    write_csv(tmp_path / OTHER, HEADER, [row("2024/01/10", "-1,00", "shared")])
    write_csv(tmp_path / NEW, HEADER, [row("2024/01/10", "-1,00", "shared")])
    write_csv(tmp_path / OLD, HEADER, [row("2024/01/10", "-9,00", "older")])
    got = ingest.load(read_exports(spark, str(tmp_path))).collect()
    assert [(r["description"], r["source_file"]) for r in got] == [("shared", OTHER)]
    audit = {r["source_file"]: r for r in ingest.load_audit(read_exports(spark, str(tmp_path))).collect()}
    assert audit[NEW]["duplicate"] == 1 and audit[OLD]["superseded"] == 1 and audit[None]["inserted"] == 1


def test_audit_counts(spark, tmp_path):
    write_csv(tmp_path / NEW, HEADER, [row("2024/01/10", "-1,00", "a"), row("Reserveret", "-1,00", "p"),
                                       row("2024/01/10", "-1,00", "a")])
    write_csv(tmp_path / OLD, HEADER, [row("2024/01/10", "-3,00", "x"), row("2024/01/09", "-4,00", "y")])
    audit = {r["source_file"]: r.asDict() for r in ingest.load_audit(read_exports(spark, str(tmp_path))).collect()}
    assert audit[NEW] == {"source_file": NEW, "parsed": 3, "pending": 1, "superseded": 0, "duplicate": 1,
                          "inserted": 1, "skipped": 2}
    assert audit[OLD]["superseded"] == 1 and audit[OLD]["inserted"] == 1
    assert audit[None]["parsed"] == 5 and audit[None]["skipped"] == 3


def test_append_keeps_existing_keys(spark, tmp_path):
    write_csv(tmp_path / NEW, HEADER, [row("2024/01/10", "-1,00", "a", balance="5,00"), row("2024/01/11", "-1,00", "b")])
    existing = spark.createDataFrame([("", None)], "transaction_hash string, x int")
    first = ingest.load(read_exports(spark, str(tmp_path))).filter("description = 'a'")
    new = ingest.append_new_only(ingest.load(read_exports(spark, str(tmp_path))), first)
    assert [r["description"] for r in new.collect()] == ["b"]
    assert existing.count() == 1


def sequential_load(rows):
    """Brute force: the file-by-file load with per-account date memory and
    first-insert-wins keys, written from the rules in SURVEY 7.4."""
    files = {}
    for r in rows:
        files.setdefault(r["source_file"], []).append(r)
    table, memory = {}, {}
    for name in sorted(files, reverse=True):
        acct = name.split(" - ", 1)[0] if name.startswith("Konto ") else name
        seen, claimed = memory.setdefault(acct, set()), set()
        for r in sorted(files[name], key=lambda r: r["row_in_file"]):
            if r["posting_date_text"] is None:
                continue
            day = dt.datetime.strptime(r["posting_date_text"], "%Y/%m/%d").date()
            if day in seen:
                continue
            claimed.add(day)
            text = "|".join([r["posting_date_text"], str(float(r["amount"])), r["description"] or "",
                             r["name"] or "", r["sender"] or "", r["recipient"] or ""])
            table.setdefault(hashlib.md5(text.encode()).hexdigest(), (r["source_file"], r["row_in_file"]))
        seen.update(claimed)
    return table


def test_set_based_load_equals_sequential_load(spark):
    rows = events_export_rows(spark, SF0001)
    expected = sequential_load([r.asDict() for r in rows.collect()])
    got = {r["transaction_hash"]: r["source_file"] for r in ingest.load(rows).collect()}
    assert len(got) == len(expected) == 555
    assert got == {k: v[0] for k, v in expected.items()}


def test_adapter_counts(spark):
    rows = events_export_rows(spark, SF0001)
    typed = ingest.typed_rows(rows)
    assert rows.count() == 1020
    assert ingest.posted(typed).count() == 813
    assert ingest.newest_file_wins(ingest.posted(typed)).count() == 569
    assert ingest.load(rows).count() == 555


def test_audit_lists_files_without_rows(spark, tmp_path):
    from spendlake.sources.exports import export_files
    write_csv(tmp_path / NEW, HEADER, [row("2024/01/10", "-1,00", "a")])
    write_csv(tmp_path / OLD, HEADER, [])
    (tmp_path / "nothing at all+.csv").write_text("")
    audit = {r["source_file"]: r for r in ingest.load_audit(read_exports(spark, str(tmp_path)),
                                                            export_files(spark, str(tmp_path))).collect()}
    assert audit[OLD]["parsed"] == 0 and audit[OLD]["inserted"] == 0 and audit[NEW]["inserted"] == 1
    assert audit["nothing at all+.csv"]["parsed"] == 0

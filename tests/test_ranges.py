"""Large CSV files read in byte ranges give the records that a whole read gives."""

import csv
import io
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import HEADER, write_csv
from spendlake.plans.catalogue import QUERIES
from spendlake.sources import files, ranges
from spendlake.sources.exports import read_exports, scan, scan_ranges

PIECES = ["a", "é", "中", ";", '"', "\n", " ", "x" * 30, "", "1,5", "\r\n", '""']


def a_file(path, rng, n, eol="\n", bom=True, end=True):
    """(header, rows) written with blank lines, short rows and quoted line breaks."""
    rows = [["".join(rng.choices(PIECES, k=rng.randint(0, 6))) for _ in range(rng.randint(1, 4))] for _ in range(n)]
    lines = ["", "a;b;c;d"] if rng.random() < 0.5 else ["a;b;c;d"]
    for row in rows:
        lines += [""] * (rng.random() < 0.2)
        lines.append(";".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ';"\r\n') else c for c in row))
    text = eol.join(lines) + (eol if end else "")
    path.write_bytes(("﻿" if bom else "").encode() + text.encode())
    return text


def expected(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r]
    return sorted(str([c or None for c in (r + [""] * 4)[:4]]) for r in rows[1:] if r != [""])


def cells(df):
    return sorted(str([c or None for c in r]) for r in df.select("_c0", "_c1", "_c2", "_c3").collect())


@pytest.mark.parametrize("eol,bom,end", [("\n", True, True), ("\r\n", False, True), ("\n", False, False)])
def test_any_range_size_gives_the_same_records(spark, tmp_path, eol, bom, end):
    rng = random.Random(eol + str(end))
    texts = [a_file(tmp_path / f"f{k}.csv", rng, 40, eol, bom, end) for k in range(4)]
    paths = [str(tmp_path / f"f{k}.csv") for k in range(4)]
    want = sorted(x for t in texts for x in expected(t))
    for size in (1, 3, 64, 1000, 1 << 20):
        found = scan_ranges(spark, paths, 4, size)
        assert cells(found.filter("coalesce(_c0, _c1, _c2, _c3) IS NOT NULL")) == [
            w for w in want if w != str([None] * 4)], size


def test_chunks_within_a_range(spark, tmp_path, monkeypatch):
    text = a_file(tmp_path / "f.csv", random.Random(9), 60)
    size = os.path.getsize(tmp_path / "f.csv")
    for chunk in (1, 2, 7, 100):
        monkeypatch.setattr(ranges, "_CHUNK", chunk)
        with open(tmp_path / "f.csv", "rb") as stream:
            found = [raw for _, raw in ranges._owned(stream, 0, size, size, False)]
        assert b"".join(r + b"\n" for r in found).rstrip(b"\n") == ("﻿" + text).encode().rstrip(b"\n")


def test_same_cells_order_and_names_as_the_whole_read(spark, tmp_path):
    for name in ("Konto 07 - 2024-02-01 08.00.00.csv", "Konto æ+ø %20.csv"):
        write_csv(tmp_path / name, HEADER, [["2024/01/05", f"-{k},00", "07", "", "n;x", f'line {k}\nnext "q"', "", "DKK", ""]
                                            for k in range(50)])
    paths = sorted(str(p) for p in tmp_path.iterdir())
    whole, parts = scan(spark, paths, 9), scan_ranges(spark, paths, 9, 100)
    assert parts.columns == whole.columns and dict(parts.dtypes) == dict(whole.dtypes)
    columns = [c for c in whole.columns if c != "row_in_file"]
    assert sorted(map(str, parts.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))
    for df in (whole, parts):
        in_order = [r["_c5"] for r in df.filter(F.col("source_file").startswith("Konto 07")).orderBy("row_in_file").collect()]
        assert in_order == [f'line {k}\nnext "q"' for k in range(50)]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    write_csv(tmp_path / "Konto 07 - 2024-02-01 08.00.00.csv", HEADER, [
        ["2024/01/05", f"-{k},00", "07", "", "name", f"break\nin {k}", "", "DKK", ""] for k in range(30_000)])
    size = os.path.getsize(tmp_path / "Konto 07 - 2024-02-01 08.00.00.csv")
    found = read_exports(spark, str(tmp_path), range_bytes=size // 40)
    by_task = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) >= 16 and max(r["count"] for r in by_task) < 6000
    assert found.select("description").distinct().count() == 30_000 == found.count()


class Counted(io.BytesIO):
    """A stream that counts the bytes read from it."""
    n = 0

    def read(self, size=-1):
        out = super().read(size)
        self.n += len(out)
        return out


def test_short_ranges_read_little_behind_their_end():
    """A long file's short ranges read it about twice in all, not once a range."""
    text = b"".join(b"%d;some text\n" % k for k in range(40_000))
    size, found = len(text), []
    stream = Counted(text)
    for start in range(0, size, 1000):
        found += [raw for _, raw in ranges._owned(stream, start, min(start + 1000, size), size, False)]
    assert found == text.splitlines() and stream.n < 3 * size


def test_ranges_within_one_long_record_stop_at_their_end():
    text = b'a;"' + b"x\n" * 300_000 + b'"\nb;c\n'
    size, found = len(text), []
    stream = Counted(text)
    for start in range(0, size, 1000):
        found += [raw for _, raw in ranges._owned(stream, start, min(start + 1000, size), size, 0 < start < size - 6)]
    assert found == [text[:-5], b"b;c"] and stream.n < 4 * size


def test_a_record_is_parsed_once(spark, tmp_path):
    write_csv(tmp_path / "Konto 07 - 2024-02-01 08.00.00.csv", HEADER, [["2024/01/05", "-1,00", "07", "", "n", "t", "", "DKK", ""]])
    for part in read_exports(spark, str(tmp_path), on_error="reject", range_bytes=1000):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


def test_listed_names_and_sizes(spark, tmp_path):
    names = ["a,b.csv", ",,.csv", "x\\y.csv", "Konto æ+ø %20.csv", "x${user.name}.csv"]
    for k, name in enumerate(names):
        (tmp_path / name).write_bytes(b"a" * k)
    (tmp_path / "other.txt").write_bytes(b"a")
    paths = files.matching(spark, f"{tmp_path}/*.csv")
    # Hadoop takes a backslash in a path for a slash, so that file is not asked for by name
    assert [p.rsplit("/", 1)[-1] for p in paths if "y.csv" not in p] == sorted(n for n in names if "y.csv" not in n)
    assert files.matching(spark, f"{tmp_path}/*.none") == []
    given = [str(tmp_path / n) for n in names]
    found = {(r["path"].rsplit("/", 1)[-1], r["start"], r["stop"], r["size"]) for r in
             ranges.byte_ranges(spark, given, 3).collect()}
    assert found == {(n, s, min(s + 3, k), k) for k, n in enumerate(names) for s in range(0, k, 3)}
    with pytest.raises(PySparkException, match="gone.csv"):
        ranges.byte_ranges(spark, [str(tmp_path / "gone.csv")]).collect()


def test_files_without_records(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_bytes(b"\xef\xbb\xbf\r\n\n \n")
    write_csv(tmp_path / "header.csv", HEADER, [])
    assert read_exports(spark, str(tmp_path), range_bytes=8).count() == 0
    assert ranges.records(spark, [str(tmp_path / "header.csv")], 8).count() == 0


def test_queries_agree(spark):
    files, parts = (QUERIES[q](spark, "/root/testdata/sf0.001") for q in ("ingest_csv_files", "ingest_csv_ranges"))
    assert sorted(map(str, files.collect())) == sorted(map(str, parts.collect())) != []

"""More export files than the driver holds at once: listed by a worker, scanned in groups."""

import random

import pytest

from conftest import HEADER, write_csv
from spendlake.plans.catalogue import QUERIES
from spendlake.session import settings
from spendlake.sources import exports, files
from spendlake.sources.exports import read_exports

NO_CURRENCY = [h for h in HEADER if h != "Valuta"]
OTHER = list(reversed(HEADER))


@pytest.fixture
def groups(monkeypatch):
    """Groups of two files; the number of paths of each scan."""
    sizes, scan = [], exports.scan

    def counted(spark, paths, *args):
        sizes.append(len(paths))
        return scan(spark, paths, *args)
    monkeypatch.setattr(exports, "GROUP_FILES", 2)
    monkeypatch.setattr(exports, "scan", counted)
    return sizes


def a_folder(folder):
    """Exports of three layouts, some of them odd: stray quotes, other line ends, no records."""
    rng = random.Random(4)
    for k in range(9):
        header = (HEADER, OTHER, NO_CURRENCY)[k % 3]
        rows = []
        for n in range(5):
            row = dict(zip(HEADER, ["2024/01/05", rng.choice(["-1,00", ""]), "07", "", f"n;{n}", f"a\n{k} \"b\" {n}",
                                    "1,00", rng.choice(["DKK", "DKK", ""]), ""], strict=True))
            rows.append([row[h] for h in header])
        write_csv(folder / f"Konto æ %20+{k} - 2024-02-01.csv", header, rows, bom=k % 2 == 0)
    first = ";".join(HEADER)
    (folder / "quotes.csv").write_bytes(f'{first}\n2024/01/05;-1,00;07;;5" pipe;text;;DKK;\n;-2,00;;;"a"b;t;;DKK;\n'.encode())
    (folder / "crlf.csv").write_bytes(f'{first}\r\n;-1,00;07;;n;"a\r\nb";;DKK;\r\n\r\n;;;;n;c;;DKK;\r\n'.encode())
    (folder / "cr.csv").write_bytes(f'\n{first}\n;-1,00;07;;n;"a\rb";;DKK;\n'.encode())
    (folder / "bytes.csv").write_bytes(f"{first}\n;-1,00;07;;n;t".encode() + b"\xff\xfe;;DKK;\n")
    (folder / "empty.csv").write_bytes(b"")
    (folder / "blank.csv").write_bytes(b"\n\n")
    write_csv(folder / "header.csv", HEADER, [])
    (folder / "notes.txt").write_text("no export")
    (folder / "sub").mkdir()
    write_csv(folder / "sub" / "below.csv", HEADER, [["2024/01/05", "-9,00", "07", "", "n", "t", "", "DKK", ""]])


def texts(df):
    return sorted(map(str, df.drop("row_in_file").collect()))


@pytest.mark.parametrize("how", [{}, {"range_bytes": 40}, {"split_files": True}])
def test_groups_give_the_same_rows(spark, tmp_path, groups, monkeypatch, how):
    a_folder(tmp_path)
    with monkeypatch.context() as m:
        m.setattr(exports, "GROUP_FILES", 1000)
        want = read_exports(spark, str(tmp_path), on_error="reject", **how)
        wanted = [texts(df) for df in want]
    groups.clear()
    # neither all paths nor the paths by header come to the driver
    monkeypatch.setattr(exports, "layouts", None)
    monkeypatch.setattr(exports, "export_paths", None)
    found = read_exports(spark, str(tmp_path), on_error="reject", **how)
    assert [texts(df) for df in found] == wanted and all(wanted)
    assert [dict(df.dtypes) for df in found] == [dict(df.dtypes) for df in want]
    assert groups == [] if "range_bytes" in how else len(groups) > 5 and max(groups) == 2
    plan = found[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan.replace("from_csv", "").replace(".csv", "")


def test_order_in_a_file_is_kept(spark, tmp_path, groups):
    for k in range(5):
        write_csv(tmp_path / f"f{k}.csv", HEADER, [["2024/01/05", "-1,00", "", "", "", f"{n}", "", "DKK", ""]
                                                   for n in range(40)])
    rows = read_exports(spark, str(tmp_path))
    for k in range(5):
        own = rows.filter(f"source_file = 'f{k}.csv'").orderBy("row_in_file").collect()
        assert [r["description"] for r in own] == [str(n) for n in range(40)]
    assert groups == [2, 2, 1]


def test_a_bad_header_fails_before_any_scan(spark, tmp_path, groups):
    for k in range(4):
        write_csv(tmp_path / f"f{k}.csv", HEADER, [["2024/01/05", "-1,00", "", "", "", "t", "", "DKK", ""]])
    write_csv(tmp_path / "Konto 9.csv", [h for h in HEADER if h != "Saldo"], [])
    with pytest.raises(ValueError, match="Missing column for field 'balance'.*of file 'Konto 9.csv'"):
        read_exports(spark, str(tmp_path))
    assert groups == []


def test_a_list_and_a_pattern_are_scanned_in_groups(spark, tmp_path, groups):
    for k in range(5):
        write_csv(tmp_path / f"f{k}.csv", HEADER, [["2024/01/05", "-1,00", "", "", "", f"{k}", "", "DKK", ""]])
    for path in ([str(tmp_path / f"f{k}.csv") for k in range(5)], f"{tmp_path}/f*.csv", f"{tmp_path}/"):
        groups.clear()
        assert sorted(r["description"] for r in read_exports(spark, path).collect()) == list("01234")
        assert groups == [2, 2, 1]


def test_names_in_a_folder(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        for name in ("x,y.csv", "Konto æ+ø %20.csv", "_z.csv", ".csv", "x.CSV", "csv", "x.csv.txt"):
            (tmp_path / folder / name).write_bytes(b"")
    (tmp_path / "c").write_bytes(b"")  # no folder
    for folder in (f"{tmp_path}/a", f"file:{tmp_path}/a", f"{tmp_path}/*", f"{tmp_path}/none", f"{tmp_path}/c"):
        found = sorted(r["path"] for r in files.in_folder(spark, folder, ".csv").collect())
        assert found == files.matching(spark, f"{folder}/*.csv"), folder


def test_settings_are_set_back(spark):
    name, unset = "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"
    old = spark.conf.get(name)
    with pytest.raises(KeyError), settings(spark, spark__sql__files__openCostInBytes=77, spark__sql__files__minPartitionNum=3):
        assert (spark.conf.get(name), spark.conf.get(unset)) == ("77", "3")
        raise KeyError
    assert spark.conf.get(name) == old and spark.conf.get(unset, None) is None


@pytest.mark.parametrize("query", ["ingest_csv_rejects", "ingest_csv_files"])
def test_queries_scan_many_files_in_groups(spark, groups, monkeypatch, query):
    with monkeypatch.context() as m:
        m.setattr(exports, "GROUP_FILES", 1000)
        wanted = sorted(map(str, QUERIES[query](spark, "/root/testdata/sf0.001").collect()))
    groups.clear()
    monkeypatch.setattr(exports, "GROUP_FILES", 4)
    assert sorted(map(str, QUERIES[query](spark, "/root/testdata/sf0.001").collect())) == wanted != []
    assert max(groups) == 4 and len(groups) > 5

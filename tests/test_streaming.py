from pyspark.sql import functions as F

from conftest import HEADER, write_csv
from spendlake.streaming import start_incremental_load


def test_incremental_append(spark, tmp_path):
    exports, raw, ckpt = tmp_path / "exports", str(tmp_path / "raw"), str(tmp_path / "ckpt")
    exports.mkdir()
    write_csv(exports / "Konto 0718 - 2024-02-01 08.00.00.csv", HEADER, [
        ["2024/01/10", "-1,00", "0718", "", "", "first", "", "DKK", ""]])
    start_incremental_load(spark, str(exports), raw, ckpt).awaitTermination()
    assert spark.read.parquet(raw).count() == 1
    write_csv(exports / "Konto 0718 - 2024-03-01 08.00.00.csv", HEADER, [
        ["2024/02/10", "-2,00", "0718", "", "", "second", "", "DKK", ""],
        ["2024/01/10", "-1,00", "0718", "", "", "first", "", "DKK", ""]])
    start_incremental_load(spark, str(exports), raw, ckpt).awaitTermination()
    rows = spark.read.parquet(raw)
    assert sorted(r.description for r in rows.collect()) == ["first", "second"]
    assert rows.filter(F.col("description") == "first").first().source_file.endswith("2024-02-01 08.00.00.csv")


def test_newest_file_wins_over_all_files_of_a_run(spark, tmp_path):
    exports, raw, ckpt = tmp_path / "exports", str(tmp_path / "raw"), str(tmp_path / "ckpt")
    exports.mkdir()
    for day in range(1, 13):
        write_csv(exports / f"Konto 0718 - 2024-03-{day:02d} 08.00.00.csv", HEADER, [
            ["2024/01/10", "-1,00", "0718", "", "", f"export {day}", "", "DKK", ""]])
    start_incremental_load(spark, str(exports), raw, ckpt).awaitTermination()
    assert [r.description for r in spark.read.parquet(raw).collect()] == ["export 12"]

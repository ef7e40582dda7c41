import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from spendlake.session import DEFAULTS, checkpoint_dir
    builder = (SparkSession.builder.master("local[*]").appName("spendlake-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # sets a scratch folder only because none is configured
    yield s
    s.stop()


def write_csv(path, header, rows, bom=True, trailing=True):
    """Write one export file: ';'-separated, optional BOM and trailing ';'."""
    def line(cells):
        out = []
        for c in cells:
            c = "" if c is None else str(c)
            if any(x in c for x in ';"\n'):
                c = '"' + c.replace('"', '""') + '"'
            out.append(c)
        return ";".join(out) + (";" if trailing else "")
    text = "\n".join([line(header)] + [line(r) for r in rows]) + "\n"
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(text)


HEADER = ["Bogføringsdato", "Beløb", "Afsender", "Modtager", "Navn", "Beskrivelse", "Saldo", "Valuta", "Afstemt"]

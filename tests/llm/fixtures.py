"""Small tables with every odd case, and the driver's smallest tables."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
#: Names that operators use for their own columns.
CLASHING = ["score", "fp", "cell", "label", "node", "rank", "place", "part", "shard", "digest", "item_id", "ids",
            "pos", "word", "words", "grams", "v", "kept", "cleaned", "component_id", "predicted", "p", "size"]

LONG = ("Lorem ipsum dolor sit amet, consectetur adipiscing elit. " * 2000).strip()
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", None),
    (4, "  \n\t \x0b\x0c\r ", None, "a"),
    (5, LONG, "en", "b"),
    (5, LONG, "en", "b"),
    (6, LONG, "de", "b"),
    (None, "The quick brown fox jumps over the lazy dog near the old river bank today.", "en", "a"),
    (None, None, None, None),
    (7, "x", "fr", "c"),
    (8, "12345 !!! ### 中文 \U0001f600 é", "fr", "c"),
    (9, "don't we'll they've\r\nI'm  he'd\n\n\n'round  the   'll <|endoftext|> end", "en", "c"),
    (9, "another text under the same id", "en", "c"),
]


def odd_docs(spark, texts=TEXTS, extra=True):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in texts],
                               "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        for k, c in enumerate(CLASHING):
            df = df.withColumn(c, F.lit(f"extra{k}"))
    return df.repartition(3)


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")

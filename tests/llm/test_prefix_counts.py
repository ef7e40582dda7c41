import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendlake.llm import prefix_counts
from spendlake.llm.queries import QUERIES

from .fixtures import SF, TEXTS, odd_docs, table

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = ["a", "the", " ", "  ", "\n", "\t", "'", "'re", "'s", "\u00e9", "\u00df", "\u4e2d", "1", "\u00b2", "!", "r", "<|endoftext|>", "<|end", "help", "ation", " and", "____", "'ll", "s", 
          "\u00a0", "\x1c", "\x85", "\u2009", "\u200b", "\r", "Ab", "don't", "\U0001f600", "\u0301", "\x00", "\u3000",
          "_"]


def counts(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_query_equals_the_library(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, "documents").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op5_prefix_token_counts"](spark, SF).collect()}
    for k, n in zip(texts, counts(list(texts.values())), strict=True):
        assert (rows[k]["n_tokens"], rows[k]["n_bytes"], rows[k]["over_limit"]) == (n, len(texts[k].encode()), n > 512)


def test_every_prefix_equals_the_library():
    rng = random.Random(4)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(500)] + ["", None, "a" * 120]
    table_, lengths = prefix_counts.PrefixCounter().prefix_tables(pa.array(texts, pa.string()))
    for text, own in zip(texts, np.split(table_, np.cumsum(lengths)[:-1]), strict=True):
        text = text or ""
        assert own.tolist() == counts([text[:p] for p in range(1, len(text) + 1)])


def test_budget_questions_without_encoding(spark):
    docs = odd_docs(spark, [r for r in TEXTS if r[0] not in (5, 6)])
    rows = (prefix_counts.prefix_table(docs)
            .select("doc_id", "prefix", prefix_counts.cut_for_budget(F.col("prefix"), 5).alias("cut"),
                    prefix_counts.tokens_upto(F.col("prefix"), 4).alias("upto")).collect())
    want = []
    for d, t, *_ in TEXTS:
        if d not in (5, 6):
            t = t or ""
            n = counts([t[:p] for p in range(len(t) + 1)])
            want.append(str((d, n, max(p for p in range(len(n)) if n[p] <= 5), n[min(4, len(t))])))
    assert sorted(str((r["doc_id"], list(r["prefix"]), r["cut"], r["upto"])) for r in rows) == sorted(want)


def test_odd_rows_and_empty_table(spark):
    docs = odd_docs(spark)
    got = sorted(str((r["doc_id"], r["n_tokens"])) for r in prefix_counts.count_tokens(docs).collect())
    assert got == sorted(str((d, n)) for (d, *_), n in
                         zip(TEXTS, counts([t or "" for _, t, *_ in TEXTS]), strict=True))
    assert prefix_counts.count_tokens(odd_docs(spark, [])).count() == 0
    assert prefix_counts.prefix_table(odd_docs(spark, [])).count() == 0

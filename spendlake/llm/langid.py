"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of its own texts.  A
text (lower-cased; signs, digits and white space become single spaces) is cut
into blocks of ``block_bytes``, every block is compressed with every
language's dictionary, and the language with the smallest total wins.  Of
equal totals the language with more training rows wins.  The margin is the
share by which the runner-up is larger; a text whose margin is under
``min_margin`` is marked as rejected.  score is 1 / (1 + exp(-margin / 0.02))
(one half: a tie).  A null text, and one without a letter, is ``und``.

Training takes ``texts_per_language`` distinct texts of each language, all if
it has fewer (a hash of the text picks them, copies count once; the bound is
this parameter) and keeps ``excerpt_bytes`` from the middle of each, at most ``dictionary_bytes`` in all: these are the
contents of the dictionaries.  Prediction covers whole texts.

Defined cases: rows with a null language or text teach nothing; without any
training row every text is ``und``; an empty table gives no rows; repeated
rows give repeated rows.  A very long text is held whole and compressed block
by block; columns other than the text, whatever their names, play no part in
``predict``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
LANGUAGES_AT_ONCE = 500  # whose compressors a worker holds
_KEEP = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass(frozen=True)
class Model:
    dictionaries: tuple[tuple[str, bytes], ...]  # by falling number of training rows
    level: int = 5
    block_bytes: int = 4096
    min_margin: float = 0.01


def normalise(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8").translate(_KEEP).split())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(docs: DataFrame, texts_per_language: int = 400, dictionary_bytes: int = 64 << 10,
        excerpt_bytes: int = 512) -> Model:
    """Learn every language of ``lang`` from its ``text``, LANGUAGES_AT_ONCE in a query."""
    rows = docs.select("text", "lang").dropna()
    dice = F.xxhash64("text", F.lit(5))
    distinct = rows.groupBy("lang", dice.alias("dice")).agg(F.count(F.lit(1)).alias("n"))
    counts = (distinct.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
              .orderBy(F.desc("n"), "lang").collect())  # one row for each language
    if not counts:
        return Model(())
    wanted = texts_per_language + 6 * texts_per_language ** 0.5 + 10  # never too few by chance; cut below
    middle = F.greatest(F.lit(1), (F.char_length("text") / 2).cast("int") - excerpt_bytes // 2)
    dictionaries = []
    for at in range(0, len(counts), LANGUAGES_AT_ONCE):
        block = counts[at:at + LANGUAGES_AT_ONCE]
        share = F.create_map(*[x for r in block for x in
                               (F.lit(r["lang"]), F.lit(int((1 << 30) * min(1.0, wanted / r["texts"]))))])
        sample = (rows.filter(F.pmod(dice, F.lit(1 << 30)) < F.element_at(share, F.col("lang")))
                  .select("lang", dice.alias("dice"),
                          F.substring(F.col("text"), middle, F.lit(excerpt_bytes)).alias("text"))
                  .distinct().collect())  # little over texts_per_language excerpts for each language
        bodies: dict[str, list[bytes]] = {r["lang"]: [] for r in block}
        taken = dict.fromkeys(bodies, 0)
        kept = []
        for r in sorted(sample, key=lambda r: (r["dice"] % (1 << 30), r["dice"], r["text"])):
            taken[r["lang"]] += 1
            if taken[r["lang"]] <= texts_per_language:
                kept.append(r)
        for r in sorted(kept, key=lambda r: (r["dice"], r["text"])):
            body = normalise(r["text"])
            if body and body not in bodies[r["lang"]][-1:]:
                bodies[r["lang"]].append(body)
        dictionaries += [(lang, b" ".join(parts)[-dictionary_bytes:]) for lang, parts in bodies.items() if parts]
    return Model(tuple(dictionaries))


@functools.lru_cache(maxsize=2)
def _compressors(model: Model, first: int) -> list[zstandard.ZstdCompressor]:
    out = []
    for _, content in model.dictionaries[first:first + LANGUAGES_AT_ONCE]:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=model.level)
        out.append(zstandard.ZstdCompressor(dict_data=held, level=model.level, write_checksum=False,
                                            write_content_size=False, write_dict_id=False))
    return out


def classify_all(texts: Iterable[str | None], model: Model) -> list[tuple[str, float, float, bool]]:
    """(language, score, margin, rejected) of each text, LANGUAGES_AT_ONCE languages at a time."""
    cuts: list[list[bytes] | None] = []
    for text in texts:
        if text is None or not model.dictionaries or not has_letter(text):
            cuts.append(None)
            continue
        body = normalise(text)
        cuts.append([body[k:k + model.block_bytes] for k in range(0, len(body), model.block_bytes)] or [b""])
    best: list[list[tuple[int, int]]] = [[] for _ in cuts]  # the two smallest (size, language) so far
    for first in range(0, len(model.dictionaries), LANGUAGES_AT_ONCE):
        compressors = _compressors(model, first)
        for k, blocks in enumerate(cuts):
            if blocks is not None:
                sizes = [(sum(len(c.compress(b)) for b in blocks), first + i) for i, c in enumerate(compressors)]
                best[k] = sorted([*best[k], *sizes])[:2]
    out = []
    for two in best:
        if not two:
            out.append((UNKNOWN, 0.0, 0.0, True))
            continue
        margin = (two[1][0] - two[0][0]) / two[1][0] if len(two) > 1 else 1.0
        score = float(1 / (1 + np.exp(-margin / 0.02)))
        out.append((model.dictionaries[two[0][1]][0], score, float(margin), bool(margin < model.min_margin)))
    return out


def classify(text: str | None, model: Model) -> tuple[str, float, float, bool]:
    """(language, score, margin, rejected) of one text."""
    return classify_all([text], model)[0]


def predict(text: Column, model: Model, spark) -> Column:
    """Column expression: struct of lang_pred, score, margin, rejected."""
    shared = spark.sparkContext.broadcast(model)  # dictionary_bytes for each language

    @F.pandas_udf("lang_pred string, score double, margin double, rejected boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(classify_all(texts, shared.value),
                            columns=["lang_pred", "score", "margin", "rejected"])

    return predicted(text)

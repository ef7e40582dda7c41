"""Line-first cleaning: rules per line, then a verdict per document.

Words are maximal runs of non-white-space (space and 0x09-0x0D); lines are cut
at line feeds.  A line with a word fails on

* punctuation: symbols are more than ``symbol_percent`` of its characters, or
  more than half of its words end in two or more of ``!?``, or it has fewer
  than ``fragment_words`` words and no closing punctuation;
* navigation: ``nav_separators`` or more separators with at most
  ``nav_words`` words to each gap;
* boilerplate: at most ``boilerplate_words`` words, and a stock phrase (English, German,
  French and Spanish ones by default; ``phrases`` takes others).

Failing lines are removed.  A document is rejected when the removed lines held
more than ``max_lost_percent`` of its word characters, or when a base rule
fails (fewer than ``min_words`` words, or repeated three-word windows cover
more than ``max_repeat_percent`` of the words).

Defined cases: a null or empty text has zero counts and fails the base rule;
an empty table gives no rows; repeated rows give repeated rows; other columns,
whatever their names, are kept by ``clean`` and ignored by ``judge``.  Texts
are read whole: a worker holds about a megabyte of text, or one longer text,
with its words and different lines.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from spendlake.llm.common import release_memory, slices, with_results

SYMBOLS = "#*$%&|<>"  # counted as n_symbols
WHITE = " \t\n\v\f\r"
LINE_SYMBOLS = r"[#*$%&|<>{}\[\]~^=\\]"
SEPARATORS = r"[|»›•·→]"
CLOSING = ".!?…:;,\"'”’»)]。！？"
# fixed values: stock phrases of web pages in English, German, French and Spanish
PHRASES = (
    "all rights reserved", "privacy policy", "cookie policy", "uses cookies", "accept cookies", "terms of use",
    "terms of service", "terms and conditions", "enable javascript", "lorem ipsum", "click here", "read more",
    "sign up for", "subscribe to our", "share this article", "follow us on", "skip to content", "back to top",
    "licensed under", "released under the", "copyright ©", "copyright (c)", "powered by",
    "alle rechte vorbehalten", "datenschutzerklärung", "verwendet cookies", "cookies akzeptieren",
    "nutzungsbedingungen", "allgemeine geschäftsbedingungen", "javascript aktivieren", "hier klicken",
    "klicken sie hier", "newsletter abonnieren", "diesen artikel teilen", "folgen sie uns auf",
    "zum inhalt springen", "zum seitenanfang", "lizenziert unter",
    "tous droits réservés", "politique de confidentialité", "utilise des cookies", "accepter les cookies",
    "conditions d'utilisation", "conditions générales", "activer javascript", "cliquez ici", "lire la suite",
    "abonnez-vous à", "partager cet article", "suivez-nous sur", "aller au contenu", "haut de page",
    "mentions légales",
    "todos los derechos reservados", "política de privacidad", "utiliza cookies", "aceptar cookies",
    "términos de uso", "términos y condiciones", "habilite javascript", "haga clic aquí", "haz clic aquí",
    "leer más", "suscríbete a", "compartir este artículo", "síguenos en", "saltar al contenido", "aviso legal",
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    symbol_percent: int = 10
    fragment_words: int = 4
    nav_separators: int = 2
    nav_words: int = 4
    boilerplate_words: int = 25
    max_lost_percent: int = 30
    phrases: tuple[str, ...] = field(default=PHRASES)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    size = len(number)
    if size > 2_000_000:  # keep the product below 2 ** 63: number the pairs first
        _, pair = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
        windows = pair[:-1] * size + ids[2:]
    else:
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] >= 2
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


class Judge:
    """The rules as one function of a text."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.symbol = re.compile(LINE_SYMBOLS)
        self.separator = re.compile(SEPARATORS)
        self.loud = re.compile(r"[!?][!?](?=[ \t-\r]|$)")
        self.phrase = re.compile("|".join(map(re.escape, rules.phrases)))
        self.closing = tuple(CLOSING)

    def line_fails(self, line: str, words: list[str]) -> str | None:
        """The rule that a line with words fails, or None."""
        r, n = self.rules, len(words)
        chars = sum(map(len, words))
        if 100 * len(self.symbol.findall(line)) > r.symbol_percent * chars:
            marked = "punctuation"
        elif 2 * len(self.loud.findall(line)) > n:
            marked = "punctuation"
        elif n < r.fragment_words and not words[-1].endswith(self.closing):
            marked = "punctuation"
        else:
            marked = None
        gaps = len(self.separator.findall(line))
        if gaps >= r.nav_separators and n <= r.nav_words * (gaps + 1):
            return "navigation"
        if marked is None and n <= r.boilerplate_words and self.phrase.search(line.lower()):
            return "boilerplate"
        return marked

    def __call__(self, text: str | None, with_text: bool) -> tuple:
        text = text or ""
        r = self.rules
        words = text.encode("utf-8").split()
        n = len(words)
        word_chars = len(text) - sum(map(text.count, WHITE))
        symbols = sum(map(text.count, SYMBOLS))
        repeat = repeated_words(words)
        lost = duplicate = 0
        failed: Counter[str] = Counter()
        seen: set[str] = set()
        kept_lines = []
        for line in text.split("\n"):
            parts = line.encode("utf-8").split()
            if parts:
                if line in seen:
                    duplicate += 1
                else:
                    seen.add(line)
                parts = [p.decode("utf-8") for p in parts] if not line.isascii() else line.split()
                rule = self.line_fails(line, parts)
                if rule:
                    failed[rule] += 1
                    lost += sum(map(len, parts))
                    continue
            kept_lines.append(line)
        base_failed = n < r.min_words or 100 * repeat > r.max_repeat_percent * n
        kept = not base_failed and 100 * lost <= r.max_lost_percent * word_chars
        out = (n, word_chars, symbols, duplicate, repeat, base_failed, kept, lost,
               failed["punctuation"], failed["navigation"], failed["boilerplate"])
        return (*out, "\n".join(kept_lines)) if with_text else out


FIELDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
          "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean", "lost_chars": "long",
          "punctuation_lines": "long", "navigation_lines": "long", "boilerplate_lines": "long"}


def _verdicts(texts: pa.Array, rules: Rules, with_text: bool) -> list[pa.Array]:
    judge = Judge(rules)
    rows = [judge(t, with_text) for t in texts.to_pylist()]
    kinds = [pa.bool_() if v == "boolean" else pa.int64() for v in FIELDS.values()] + [pa.string()] * with_text
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]


def judge(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """doc_id and the FIELDS of each document."""
    rules = rules or Rules()
    fields = ", ".join(f"{k} {v}" for k, v in FIELDS.items())
    return with_results(docs.select("doc_id", "text"), fields, lambda t: _verdicts(t, rules, False)).drop("text")


def clean(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """The documents that pass, without their failing lines; all columns kept, n_chars (if there) recounted."""
    rules = rules or Rules()
    place = docs.columns.index("text")
    kept_at = list(FIELDS).index("kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            found = _verdicts(part.column("text"), rules, True)
            columns = [*part.columns]
            columns[place] = found[-1]
            if "n_chars" in part.schema.names:
                at = part.schema.get_field_index("n_chars")
                columns[at] = pc.utf8_length(found[-1]).cast(part.schema.field(at).type)
            out = pa.RecordBatch.from_arrays(columns, part.schema.names).filter(found[kept_at])
            if out.num_rows:
                yield out
        release_memory()

    return docs.mapInArrow(run, docs.schema)

"""Fill-in-the-middle rewriting of documents, by repeated-capture matching.

A text is a run of units (a run of ASCII letters, or any other single code
point).  One ``regex`` full match of ``(unit)*`` retains every repetition of
the group: ``match.ends(1)`` holds the end of each unit, so its length is the
number of units n, and the ends of the units numbered by two draws are the cut
offsets; nothing iterates over units.  prefix, middle and suffix are then put
in one of two orders behind marks:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

Draws are the first four 8-digit groups of sha256(``seed:doc_id``), so they
depend on the id alone: the first two choose the cuts (modulo n + 1), the third
leaves a document plain, the fourth chooses the order.  Empty texts and texts
that hold a mark stay plain.  ``restore`` rebuilds the text from output and
form with column expressions only.

A full match keeps 4 to 16 bytes for each unit, so texts beyond ``SEGMENT``
code points are matched in segments that begin at a unit border; what a worker
holds is then bounded by the segment and the text, and the cuts are the same.

Defined cases: a null text is the empty one (n 0, plain); a null doc_id draws
from ``seed:``; repeated rows give repeated rows; an empty table gives no rows;
columns other than doc_id and text are ignored, whatever their names.  Nothing
is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import release_memory, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEGMENT = 1 << 20
BLOCK_BYTES = 1 << 20
_UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
_OTHER = regex.compile(r"[^A-Za-z]")
_MARK = regex.compile("|".join(map(regex.escape, (PREFIX, SUFFIX, MIDDLE))))

FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def segment_bounds(text: str, segment: int = SEGMENT) -> list[int]:
    """0, the unit border at or behind every further ``segment`` code points, and the length."""
    bounds = [0]
    while len(text) - bounds[-1] > segment:
        found = _OTHER.search(text, bounds[-1] + segment)
        if found is None:
            break
        bounds.append(found.start())
    return [*bounds, len(text)]


def unit_cuts(text: str, draw1: int, draw2: int, segment: int = SEGMENT) -> tuple[int, int, int]:
    """n, and the ends of the first and second cut in code points."""
    bounds = segment_bounds(text, segment)
    if len(bounds) == 2:
        ends = _UNITS.fullmatch(text).ends(1)
        n = len(ends)
        first, second = sorted((draw1 % (n + 1), draw2 % (n + 1)))
        return n, ends[first - 1] if first else 0, ends[second - 1] if second else 0
    counts = [len(_UNITS.fullmatch(text, a, b).ends(1)) for a, b in zip(bounds, bounds[1:])]
    n = sum(counts)

    def end_of(unit: int) -> int:
        if not unit:
            return 0
        k = 0
        while unit > counts[k]:
            unit -= counts[k]
            k += 1
        return _UNITS.fullmatch(text, bounds[k], bounds[k + 1]).ends(1)[unit - 1]

    first, second = sorted((draw1 % (n + 1), draw2 % (n + 1)))
    return n, end_of(first), end_of(second)


def rewrite(text: str | None, draws: tuple[int, int, int, int], rate: int = 90, spm: int = 20,
            segment: int = SEGMENT) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars and output of one text."""
    text = text or ""
    n, a, b = unit_cuts(text, draws[0], draws[1], segment)
    if not text or draws[2] % 100 >= rate or _MARK.search(text):
        return n, PLAIN, None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < spm:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers that depend on the id and the seed only."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, rate: int = 90, spm: int = 20, seed: int = 1) -> DataFrame:
    """FIELDS of every document: ``rate`` of 100 are rewritten, ``spm`` of 100 of those suffix first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            ids, texts, *numbers = part.columns
            rows = [rewrite(t, d, rate, spm) for t, d in
                    zip(texts.to_pylist(), zip(*(c.to_pylist() for c in numbers)), strict=True)]
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                                             [f.split()[0] for f in FIELDS.split(", ")])
        release_memory()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                      *(d.alias(f"draw{k}") for k, d in enumerate(draws(F.col("doc_id"), seed), 1)))
    return own.mapInArrow(run, FIELDS)


def restore(output: Column, form: Column) -> Column:
    """The text before ``transform``.  The first mark behind the opening one is
    the right one, since texts that hold a mark stay plain and no mark's end is
    another's beginning."""
    def parts(second: str) -> tuple[Column, Column, Column]:
        mark = F.lit(len(MIDDLE))
        at = F.position(F.lit(second), output)
        middle_at = F.position(F.lit(MIDDLE), output, at)
        return (F.substr(output, mark + 1, at - mark - 1), F.substr(output, at + mark, middle_at - at - mark),
                F.substr(output, middle_at + mark))

    prefix, suffix, middle = parts(SUFFIX)
    suffix2, prefix2, middle2 = parts(PREFIX)
    return (F.when(form == PSM, F.concat(prefix, middle, suffix))
            .when(form == SPM, F.concat(prefix2, middle2, suffix2)).otherwise(output))

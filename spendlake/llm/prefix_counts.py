"""Exact token counts of every prefix of a text, by dynamic programming.

``prefix[p]`` is the number of tokens that the tokenizer gives for the first p
characters.  Within a pre-token, the encoding of a prefix is the encoding of a
shorter prefix and one last token; that token is the only one which ends
there, and whose boundary to the shorter prefix's last token no merge
crosses.  So last[i] and count[i] follow from earlier entries:

    count[i] = count[i - len(t)] + 1,  t the token with survives(last[i - len(t)], t)

Counts of pre-tokens add up.  A prefix that ends within white space or within
one of the contractions 're, 've, 'll splits differently from the whole text;
those positions are counted as the prefix splits.  Special strings are cut out
first, as the library does by default, and count one token each.

With the table, truncation and budget questions are look-ups: ``tokens_upto``
and ``cut_for_budget`` never encode again.

Arrays of pre-tokens already seen are kept in a bounded memo on each worker;
nothing is shuffled.

Defined cases: a null or empty text has the table [0]; an empty table gives no
rows; repeated rows give repeated rows; columns other than doc_id and text,
whatever their names, are ignored.  A very long text is held whole, with one
number for each character; a very long pre-token costs its length times that of
the longest token.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import slices
from spendlake.llm.tokens import ChunkMemo, pretokenizer, vocabulary_path

TOKENIZER = "byte_bpe_50k.json"
BLOCK_BYTES = 4 << 20
PAIRS_KEPT = 1_000_000
_NEVER = 1 << 60
_CONTRACTIONS = {"'re", "'ve", "'ll"}


def byte_alphabet() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: printable
    Latin-1 signs for themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixCounter:
    """A byte-level BPE vocabulary and the prefix counts of texts under it."""

    def __init__(self, tokenizer: str = TOKENIZER):
        with open(vocabulary_path(tokenizer), encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"] \
                or spec["normalizer"] or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError(f"{tokenizer}: only plain byte-level BPE is supported")
        alphabet = byte_alphabet()
        as_bytes = {t: bytes(alphabet[c] for c in t) for t in model["vocab"]}
        self.ids = {as_bytes[t]: i for t, i in model["vocab"].items()}
        self.longest = max(map(len, self.ids))
        self.merge_rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = model["vocab"][left], model["vocab"][right]
            self.merge_rank[a, b] = rank
            self.parts.setdefault(model["vocab"][left + right], (a, b, rank))
        self.spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.pairs: dict[int, bool] = {}
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials)))
        self.pattern = pretokenizer(public_tokenizers.PATTERN)
        self.white = regex.compile(r"\s{2,}")
        self.memo = ChunkMemo(self._encode, self.pattern, self._join, np.int32)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """From the byte at the token's end (side 1) or start (side 0) up to the
        token: each with the rank of the merge that takes it in."""
        found = self.spines.get((token, side))
        if found is None:
            chain, taken = [(token, _NEVER)], token
            while taken in self.parts:
                whole = self.parts[taken]
                taken = whole[side]
                chain.append((taken, whole[2]))
            found = self.spines[token, side] = chain[::-1]
        return found

    def _survives(self, left: int, right: int) -> bool:
        """Whether no merge crosses the boundary when the bytes of both are encoded together."""
        a_side, b_side = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = a_side[i], b_side[j]
            rank = self.merge_rank.get((a, b))
            # of equal ranks the left pair merges first
            if rank is not None and rank < a_until and rank <= b_until:
                return False
            if a_until == b_until == _NEVER:
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def counts(self, word: bytes) -> np.ndarray:
        """Token counts of the first 1, 2, ... bytes of one pre-token."""
        n, longest, ids, pairs = len(word), self.longest, self.ids, self.pairs
        last, count = [0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(i - longest if i > longest else 0, i):
                token = ids.get(word[j:i])
                if token is None:
                    continue
                if j:
                    key = (last[j] << 24) | token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= PAIRS_KEPT:
                            pairs.clear()
                        fits = pairs[key] = self._survives(last[j], token)
                    if not fits:
                        continue
                last[i], count[i] = token, count[j] + 1
                break
        return np.array(count[1:], np.int32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts after each character of each pre-token, and the number of characters of each."""
        out = []
        for w in words:
            found = self.counts(w.encode("utf-8"))
            if not w.isascii():
                found = found[np.cumsum([len(c.encode("utf-8")) for c in w]) - 1]
            if w in _CONTRACTIONS:
                found[1] = 2
            out.append(found)
        return np.concatenate(out), np.fromiter(map(len, words), np.int64, len(words))

    @staticmethod
    def _join(values: np.ndarray, lengths: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """Add to each part's counts the tokens of the parts before it in its group."""
        if not len(lengths):
            return values
        totals = values[np.cumsum(lengths) - 1].astype(np.int64)
        upto = np.cumsum(totals) - totals
        base = upto - np.repeat(upto[np.cumsum(parts) - parts], parts)
        return (values + np.repeat(base, lengths)).astype(np.int32)

    def tables(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Counts after each character of texts without special strings, one after
        the other, and the number of characters of each."""
        keys, per_text, odd = self.memo.keys(texts)
        values, lengths = self.memo.gather(keys)
        table = self._join(values, lengths, per_text[per_text > 0])
        ends = np.concatenate(([0], np.cumsum(lengths)))
        starts = ends[np.concatenate(([0], np.cumsum(per_text)))]
        for k in np.flatnonzero(odd).tolist():  # white space at the end of a prefix is one pre-token
            at = starts[k]
            for run in self.white.finditer(texts[k].as_py() or ""):
                u, v = run.span()
                table[at + u:at + v] = (table[at + u - 1] if u else 0) + self._encode([run[0]])[0]
        return table, np.diff(starts)

    def _special_table(self, text: str) -> np.ndarray:
        """One text with special strings."""
        out, at, base = [], 0, 0
        for m in self.special.finditer(text):
            # up to the last character of the special string its start is ordinary text
            part = self.tables(pa.array([text[at:m.end() - 1]]))[0]
            own = part[m.start() - at - 1] if m.start() > at else 0
            base_next = base + int(own) + 1
            out += [part + base, [base_next]]
            at, base = m.end(), base_next
        if at < len(text):
            out.append(self.tables(pa.array([text[at:]]))[0] + base)
        return np.concatenate(out).astype(np.int32)

    def prefix_tables(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Counts after each character of any texts, and the number of characters of each."""
        held = np.zeros(len(texts), bool)
        for body in self.specials:
            held |= pc.fill_null(pc.match_substring(texts, body), False).to_numpy(zero_copy_only=False)
        if not held.any():
            return self.tables(texts)
        table, lengths = self.tables(pc.if_else(pa.array(held), "", texts))
        parts = np.split(table, np.cumsum(lengths)[:-1])
        for k in np.flatnonzero(held).tolist():
            parts[k] = self._special_table(texts[k].as_py())
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


@functools.lru_cache(maxsize=1)
def counter(tokenizer: str) -> PrefixCounter:
    return PrefixCounter(tokenizer)


def count_tokens(docs: DataFrame, limit: int = 512, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_bytes, n_tokens (the last entry of the prefix table), over_limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            texts = part.column("text")
            table, lengths = counter(tokenizer).prefix_tables(texts)
            ends = np.cumsum(lengths)
            totals = np.where(lengths > 0, table[np.maximum(ends, 1) - 1] if len(table) else 0, 0).astype(np.int64)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), sizes, pa.array(totals), pa.array(totals > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def prefix_table(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, prefix array<int>: prefix[p] is the token count of the first p characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            table, lengths = counter(tokenizer).prefix_tables(part.column("text"))
            rows = [np.concatenate(([0], t)).astype(np.int32) for t in np.split(table, np.cumsum(lengths)[:-1])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))],
                                             ["doc_id", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, prefix array<int>")


def tokens_upto(prefix: Column, characters: int) -> Column:
    """Tokens of the first ``characters`` characters (of the whole text if it is shorter)."""
    return F.element_at(prefix, F.least(F.lit(characters + 1), F.size(prefix)))


def cut_for_budget(prefix: Column, budget: int) -> Column:
    """The length of the longest prefix with at most ``budget`` tokens."""
    return F.array_max(F.transform(prefix, lambda n, p: F.when(n <= budget, p)))

"""Byte-level BPE vocabularies and a memo of encoded text chunks.

The vocabulary files are given by path and read on each worker; they are
never copied.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

RANKS = "byte_bpe_50k.tiktoken"


def vocabulary_path(name_or_path: str) -> str:
    """A path as it is; a bare file name is looked up among the public vocabularies."""
    return name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)


@functools.cache
def load_ranks(name_or_path: str = RANKS) -> dict[bytes, int]:
    with open(vocabulary_path(name_or_path), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.cache
def pretokenizer(pattern: str = public_tokenizers.PATTERN) -> regex.Pattern:
    return regex.compile(pattern)


# The characters that Unicode or Python count as white space.
_SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
_IRREGULAR = rf"{_SPACE}{_SPACE}|^{_SPACE}|{_SPACE}$|\x00|^$"


def text_chunks(texts: pa.Array, pattern: regex.Pattern) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts that can be encoded one by one: the distinct pieces, the
    number of each piece of all texts in order, the number of pieces of each
    text, and which texts were cut by the pattern.

    A pre-token never reaches over a single white-space character from the
    left: one space belongs to the word behind it, any other single one stands
    alone.  So a text without two white-space characters in a row is cut
    before each space and around each line feed; any other text, and one that
    begins or ends in white space, is cut into its pre-tokens."""
    odd = pc.fill_null(pc.match_substring_regex(texts, _IRREGULAR), True)
    marked = pc.replace_substring(texts.filter(pc.invert(odd)), "\n", "\x00\n\x00")
    lists = pc.split_pattern(pc.replace_substring(marked, " ", "\x00 "), "\x00")
    coded = lists.flatten().dictionary_encode()
    pieces = coded.dictionary.to_pylist()
    numbers = coded.indices.to_numpy().astype(np.int64)
    odd = odd.to_numpy(zero_copy_only=False)
    per_text = np.zeros(len(texts), np.int64)
    per_text[~odd] = lists.value_lengths().to_numpy()
    if odd.any():
        cut = [pattern.findall(t or "") for t in texts.filter(pa.array(odd)).to_pylist()]
        per_text[odd] = list(map(len, cut))
        number = {c: k for k, c in enumerate(pieces)}
        more = np.fromiter((number.setdefault(c, len(number)) for c in chain.from_iterable(cut)), np.int64)
        from_pattern = np.repeat(odd, per_text)
        both = np.zeros(len(from_pattern), np.int64)
        both[from_pattern], both[~from_pattern] = more, numbers
        pieces, numbers = list(number), both
    return pieces, numbers, per_text, odd


def is_one_word(chunk: str) -> bool:
    """Letters behind at most one space: a pre-token by itself."""
    return chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha())


Ragged = tuple[np.ndarray, np.ndarray]  # values one after the other, and the number of each


class ChunkMemo:
    """One array per chunk (its token ids, say), for at most ``limit`` chunks at a time.

    ``encode`` turns a list of unseen pre-tokens into their arrays.  ``join``
    turns the arrays of pre-tokens into those of chunks: it gets the values,
    the length of each pre-token's array, and the number of pre-tokens of each
    chunk, and returns the values.  When the memo is full, the chunks seen in
    fewest blocks go, down to half of the limit: memory stays bounded (by the
    limit and one block), and only work is repeated."""

    def __init__(self, encode: Callable[[list[str]], Ragged], pattern: regex.Pattern,
                 join: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] = lambda values, *_: values,
                 dtype=np.uint32, limit: int = 1_000_000):
        self.encode, self.pattern, self.join, self.limit = encode, pattern, join, limit
        self.at: dict[str, int] = {}
        self.values = np.zeros(1 << 16, dtype)
        self.ends = np.zeros(1 << 14, np.int64)  # chunk k: values[ends[k]:ends[k + 1]]
        self.uses = np.zeros(1 << 14, np.int32)  # blocks in which chunk k was seen

    def _store(self, chunks: list[str], values: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.at)
        used = int(self.ends[n])
        while used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while n + len(chunks) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.values[used:used + len(values)] = values
        self.ends[n + 1:n + 1 + len(chunks)] = used + np.cumsum(lengths)
        self.uses[n:n + len(chunks)] = 0
        self.at.update(zip(chunks, range(n, n + len(chunks)), strict=True))

    def _shrink(self) -> None:
        """Keep the chunks seen in most blocks, half of the limit at most."""
        n = len(self.at)
        if n <= self.limit // 2:
            return
        uses = self.uses[:n]
        least = int(np.sort(uses)[max(n - self.limit // 2, 0)]) + 1
        kept = np.flatnonzero(uses >= max(least, 2))
        values, lengths = self.gather(kept)
        chosen = set(kept.tolist())
        chunks = [c for c, k in self.at.items() if k in chosen]
        seen = uses[kept] // 2
        self.at, self.ends[:1] = {}, 0
        self._store(chunks, values, lengths)
        self.uses[:len(chunks)] = seen

    def _add(self, chunks: list[str]) -> None:
        """Encode the unseen pre-tokens of unseen chunks; a pre-token is a chunk as well."""
        words = list(filter(is_one_word, chunks))
        joined = [c for c in chunks if not is_one_word(c)]
        found = list(map(self.pattern.findall, joined))
        words += {w for w in chain.from_iterable(found) if w not in self.at}.difference(words)
        if words:
            self._store(words, *self.encode(words))
        more = [i for i, ws in enumerate(found) if len(ws) > 1]
        if more:
            parts = np.fromiter((len(found[i]) for i in more), np.int64, len(more))
            keys = np.fromiter(map(self.at.__getitem__, chain.from_iterable(found[i] for i in more)),
                               np.int64, int(parts.sum()))
            self.uses[keys] += 1
            values, lengths = self.gather(keys)
            whole = np.add.reduceat(lengths, np.cumsum(parts) - parts)
            self._store([joined[i] for i in more], self.join(values, lengths, parts), whole)

    def places(self, chunks: list[str]) -> np.ndarray:
        """The memo's number of every one of some distinct chunks."""
        found = np.fromiter(map(self.at.get, chunks, repeat(-1)), np.int64, len(chunks))
        gaps = np.flatnonzero(found < 0).tolist()
        if gaps:
            if len(self.at) + len(gaps) > self.limit:
                self._shrink()
                gaps = [i for i, c in enumerate(chunks) if c not in self.at]
            self._add([chunks[i] for i in gaps])
            found = np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))
        self.uses[found] += 1
        return found

    def keys(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The memo's number of every chunk, the number of chunks of each text, and which texts were irregular."""
        pieces, numbers, per_text, odd = text_chunks(texts, self.pattern)
        return self.places(pieces)[numbers], per_text, odd

    def gather(self, keys: np.ndarray) -> Ragged:
        """The values of all chunks one after the other, and the number of each."""
        starts = self.ends[keys]
        lengths = self.ends[keys + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)], lengths

    def values_of(self, texts: pa.Array) -> Ragged:
        """All values of the texts, one after the other, and the number of each text."""
        keys, per_text, _ = self.keys(texts)
        values, lengths = self.gather(keys)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return values, np.diff(ends[np.concatenate(([0], np.cumsum(per_text)))])

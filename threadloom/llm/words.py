"""Letter words of whole texts, dictionary-encoded, and vectorised hashes of their parts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class LetterWords:
    """Lower-case runs of letters of a batch of texts, each distinct word held once.

    ``at`` gives the distinct word of every word in text order, ``first`` each text's first
    place in it (with the end appended). A null text has no words.
    """

    def __init__(self, texts: pa.Array, between: str = r"[^\p{L}]+"):
        lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        split = pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(lower, between, " "), " "), " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(split.flatten())
        words = coded.dictionary.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded.dictionary
        at = coded.indices.to_numpy().astype(np.int64)
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
        kept = sizes[at] > 0 if len(at) else np.zeros(0, bool)
        self.at = at[kept]
        self.first = np.concatenate(([0], np.cumsum(kept)))[offsets - offsets[0]] if len(at) else np.zeros(len(texts) + 1, np.int64)
        self.words = words
        joined = pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in ("^", words, "$", "")))
        raw = np.frombuffer(joined.buffers()[2] or b"", np.uint8) if len(joined) else np.zeros(0, np.uint8)
        self.starts = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1)[joined.offset :] if len(joined) else np.zeros(1, np.int64)
        self.octets = raw[: self.starts[-1]].astype(np.uint64)  # every word as ^word$

    def __len__(self) -> int:
        return len(self.words)

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def prefixes(self, length: int) -> np.ndarray:
        """Hash of each distinct word's first ``length`` bytes with its start mark; 0 if it is shorter."""
        out, ok = np.zeros(len(self), np.uint64), self.sizes() > length + 1
        for i in range(length + 1):
            out[ok] = out[ok] * _FACTOR + self.octets[self.starts[:-1][ok] + i] + np.uint64(1)
        return np.where(ok, mix(out, length), np.uint64(0))

    def whole(self) -> np.ndarray:
        """Hash of each distinct word."""
        if not len(self):
            return np.zeros(0, np.uint64)
        place = np.arange(len(self.octets)) - np.repeat(self.starts[:-1], self.sizes())
        weights = mix(place.astype(np.uint64) + np.uint64(1), 99) | np.uint64(1)
        return mix(np.add.reduceat((self.octets + np.uint64(1)) * weights, self.starts[:-1]), 100)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, distinct word) of every n-gram of bytes, start and end marks included."""
        if len(self.octets) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        size = len(self.octets) - n + 1
        h = np.zeros(size, np.uint64)
        for i in range(n):
            h = h * _FACTOR + self.octets[i : i + size] + np.uint64(1)
        word = np.repeat(np.arange(len(self)), self.sizes())
        inside = word[:size] == word[n - 1 :]
        return mix(h[inside], n), word[:size][inside]


_FACTOR = np.uint64(1099511628211)


def mix(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PlainWords:
    """Words of texts unchanged, as 64-bit hashes in text order; white space is ASCII."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(split.flatten())
        words, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        kept = sizes[at] > 0 if len(at) else np.zeros(0, bool)
        self.first = np.concatenate(([0], np.cumsum(kept)))[offsets - offsets[0]] if len(at) else np.zeros(len(texts) + 1, np.int64)
        if not kept.any():
            self.hashes = np.zeros(0, np.uint64)
            return
        ends = np.cumsum(sizes)
        octets = np.frombuffer(words.buffers()[2], np.uint8, int(ends[-1])).astype(np.uint64) + np.uint64(1)
        place = np.arange(len(octets)) - np.repeat(ends - sizes, sizes)
        value = octets * (mix(place.astype(np.uint64), 7) | np.uint64(1))
        running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
        self.hashes = mix(running[ends] - running[ends - sizes], 8)[at[kept]]

"""Whole texts to token ids with the tokenizers library, each distinct word once.

A single space between two characters that are not white space always starts a new piece
of the byte-level pre-tokenizer, so a text's ids are those of its space-led chunks put
together. Chunks are dictionary-encoded batch by batch, only new ones reach the tokenizer,
and ids are gathered with numpy. Texts for which the cut is not certain (white space in a
row, unusual white space, special tokens) go to the tokenizer whole, and so does every text if
the file at ``path`` has another pre-tokenizer or a normalizer.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .words import mix

#: The pre-tokenizer pattern of byte-level BPE.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Texts that are encoded whole: a space before other white space, or white space beyond tab, newline and space.
UNSURE = r" \s|[\x00-\x08\x0b-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
#: Chunks are cut into pieces here only if all their characters lie below this.
PLAIN = "\u0250"
#: What each Python worker remembers: chunks (30 bytes each) and pieces of chunks (150).
STORE_ENTRIES, PIECE_ENTRIES = 1_500_000, 300_000

_loaded: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> "WordEncoder":
    """This process's encoder for the tokenizer file at ``path``."""
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def _byte_characters() -> dict[int, int]:
    """Byte-level BPE writes a byte that prints as itself, the others as 256 onwards."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in prints)}


class ChunkStore:
    """Ids of chunks met so far, by a 96-bit hash, in sorted arrays: some 30 bytes for each."""

    def __init__(self, dtype: np.dtype, limit: int):
        self.limit, self.pool, self.used = limit, np.zeros(1 << 16, dtype), 0
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.start, self.length, self.hits = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Each key's place, or -1."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (self.check[at] == check), at, -1)

    def add(self, key: np.ndarray, check: np.ndarray, ids: list[bytes]) -> None:
        new = np.frombuffer(b"".join(ids), self.pool.dtype)
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // self.pool.dtype.itemsize
        if self.used + len(new) > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.used], np.zeros(self.used + 2 * len(new), self.pool.dtype)))
        self.pool[self.used : self.used + len(new)] = new
        start = self.used + np.cumsum(length) - length
        self.used += len(new)
        key = np.concatenate((self.key, key))
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.check = np.concatenate((self.check, check))[order]
        self.start = np.concatenate((self.start, start))[order]
        self.length = np.concatenate((self.length, length.astype(np.int32)))[order]
        self.hits = np.concatenate((self.hits, np.zeros(len(ids), np.uint8)))[order]

    def forget(self) -> None:
        """Keep the chunks that came again, if they are not too many themselves."""
        keep = self.hits > 0
        if keep.sum() > self.limit // 2:
            keep[:] = False
        length = self.length[keep].astype(np.int64)
        self.pool = self.pool[_spans(self.start[keep], length)]
        self.used, self.start = len(self.pool), np.cumsum(length) - length
        self.key, self.check, self.length, self.hits = self.key[keep], self.check[keep], self.length[keep], np.zeros(int(keep.sum()), np.uint8)


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places of the spans, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)


def _hash(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of hash for each string, none of them empty."""
    ends = np.cumsum(pc.binary_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64))
    starts = np.concatenate(([0], ends[:-1]))
    offset = np.frombuffer(chunks.buffers()[1], np.int32, 1, 4 * chunks.offset)[0]
    octets = np.frombuffer(chunks.buffers()[2], np.uint8, int(ends[-1]), offset).astype(np.uint64) + np.uint64(1)
    place = (np.arange(len(octets)) - np.repeat(starts, ends - starts)).astype(np.uint64) + np.uint64(1)
    out = []
    for salt in (1, 2):
        out.append(mix(np.add.reduceat(octets * (mix(place, salt) | np.uint64(1)), starts), salt))
    return out[0], (out[1] >> np.uint64(32)).astype(np.uint32)


class WordEncoder:
    def __init__(self, path: str, store_entries: int = STORE_ENTRIES, piece_entries: int = PIECE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        form = json.loads(self.tokenizer.to_str())
        before = form.get("pre_tokenizer") or {}
        self.cuts = form.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.characters = _byte_characters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32)
        self.store = ChunkStore(self.dtype, store_entries)
        self.pieces: dict[str, bytes] = {}
        self.piece_entries = piece_entries

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _written(self, piece: str) -> str:
        if piece.isascii() and piece[1:].isalpha():  # these characters stand for themselves
            if piece[0] == " ":
                return "\u0120" + piece[1:]
            if piece.isalpha():
                return piece
        return piece.encode().decode("latin-1").translate(self.characters)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk: of one piece, of several, or of the tokenizer as a whole."""
        known, tokenize, kind, out = self.pieces, self.model.tokenize, self.dtype.char, []
        if len(known) + len(chunks) > self.piece_entries:
            known.clear()
        for chunk in chunks:
            if not chunk.isascii() and max(chunk) >= PLAIN:
                out.append(self._whole(chunk))
                continue
            one = chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha())
            ids = b""
            for piece in (chunk,) if one else PIECES.findall(chunk):
                new = known.get(piece)
                if new is None:
                    new = known[piece] = array(kind, [t.id for t in tokenize(self._written(piece))]).tobytes()
                ids += new
            out.append(ids)
        return out

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Where the store has each chunk; new ones are encoded and stored first."""
        if len(self.store.key) > self.store.limit:
            self.store.forget()
        key, check = _hash(chunks)
        order = np.argsort(key, kind="stable")  # sorted keys are found in passing
        key, check = key[order], check[order]
        at = self.store.find(key, check)
        new = np.flatnonzero(at < 0)
        if len(new):
            first = new[np.concatenate(([True], key[new[1:]] != key[new[:-1]]))]
            self.store.add(key[first], check[first], self._chunks(chunks.take(pa.array(order[first])).to_pylist()))
            at = self.store.find(key, check)
        self.store.hits[at] |= np.uint8(1)
        out = np.empty(len(at), np.int64)
        out[order] = at
        return out

    def entries(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, each entry's start and length there, the entry of each chunk in text order, each text's first chunk."""
        texts = pc.fill_null(texts, "")
        unsure = pc.match_substring_regex(texts, UNSURE) if self.cuts else pa.array(np.ones(len(texts), bool))
        for token in self.special:
            unsure = pc.or_(unsure, pc.match_substring(texts, token))
        whole = np.flatnonzero(unsure.to_numpy(zero_copy_only=False))
        split = pc.split_pattern(pc.if_else(unsure, "", texts), " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded, firsts = pc.dictionary_encode(split.flatten()), offsets[:-1] - offsets[0]
        first = pc.dictionary_encode(pc.list_element(split, 0)) if len(split) else coded.slice(0, 0)
        n = len(coded.dictionary)
        at = coded.indices.to_numpy().astype(np.int64)
        at[firsts] = n + first.indices.to_numpy()
        empty = np.flatnonzero(pc.equal(first.dictionary, "").to_numpy(zero_copy_only=False))
        chunks = pa.concat_arrays([pc.binary_join_element_wise("", coded.dictionary, " "), pc.if_else(pc.equal(first.dictionary, ""), " ", first.dictionary)])
        start, length = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        if len(chunks):
            place = self._places(chunks)
            start, length = self.store.start[place], self.store.length[place].astype(np.int64)
            length[n + empty] = 0
        extra = [self._whole(texts[row].as_py()) for row in whole.tolist()]
        at[firsts[whole]] = len(chunks) + np.arange(len(whole))
        if end_id is not None:
            at = np.insert(at, np.append(firsts[1:], len(at)) if len(firsts) else [], len(chunks) + len(extra))
            firsts = firsts + np.arange(len(firsts))
            extra.append(np.array([end_id], self.dtype).tobytes())
        more = np.fromiter(map(len, extra), np.int64, len(extra)) // self.dtype.itemsize
        pool = np.concatenate((self.store.pool[: self.store.used], np.frombuffer(b"".join(extra), self.dtype)))
        return pool, np.append(start, self.store.used + np.cumsum(more) - more), np.append(length, more), at, firsts

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in text order, and the number of each text's ids. Null counts as empty."""
        pool, start, length, at, firsts = self.entries(texts, end_id)
        sizes = length[at]
        counts = np.add.reduceat(sizes, firsts) if len(firsts) else np.zeros(0, np.int64)
        return pool[_spans(start[at], sizes)], counts

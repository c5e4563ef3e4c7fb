"""Benchmark decontamination by SimHash of item-sized windows.

Words are lower-case runs of letters and digits. Windows as long as a benchmark item (sizes
on a fine geometric grid) slide over every text in steps of a small part of their size, windows
of the items' exact sizes take every place at a text's end that the grid leaves out, and all
get a 64-bit SimHash over their five-word shingles from running bit sums. Four 16-bit blocks
index the items of each size: of two fingerprints within the radius, one block lies within a
quarter of it, and every such neighbour of an item's block is in the table, so no fingerprint
within the radius is missed. Candidates are verified by the exact weighted-shingle (multiset)
Jaccard similarity at every start around the hit.

Copies of similarity 0.8 may lie beyond the radius. The exact search finds these too: of an
item's rarest shingles, more than a copy may lack, one is in every copy.

The items are sent to the executors in rounds of bounded size; each round is one pass without
a shuffle.

Defined cases: null and empty texts match nothing; items without a word or without an id match
nothing; a text
or item of fewer than five words has one shingle; texts shorter than an item are compared
whole; of equal similarities the earliest start and least item id win; repeated rows get equal
rows; an empty benchmark matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, text_slices
from .words import LetterWords, mix

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 16
GRID = 1.1
#: Items (some 18 kB of index each), and characters of items, in one round.
MAX_ITEMS, MAX_CHARS = 4000, 8 << 20
#: Shingles whose running sums are held at once.
SEGMENT = 1 << 15
#: Places of rarest shingles that are looked into at once.
FOUND = 1 << 20
#: Text scanned at once, in bytes.
SLICE = 4 << 20
BETWEEN = r"[^\p{L}\p{N}]+"


def shingle_hashes(words: LetterWords) -> tuple[np.ndarray, np.ndarray]:
    """All shingles' hashes in text order, and each text's first one (with the end appended)."""
    n = np.diff(words.first)
    count = np.where(n > 0, np.maximum(1, n - SHINGLE + 1), 0)
    first = np.concatenate(([0], np.cumsum(count)))
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], count)
    end = np.repeat(words.first[1:], count)
    hashes = np.append(words.whole()[words.at], np.uint64(0))
    out = np.zeros(len(at), np.uint64)
    for j in range(SHINGLE):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[np.where(at + j < end, at + j, len(hashes) - 1)]
    return mix(out, 55), first


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _prints(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.packbits(2 * ones > total[:, None]).view(np.uint64)


def _neighbours(value: int, flips: int) -> np.ndarray:
    masks = [sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(range(16), k)]
    return value ^ np.array(masks, np.int64)


def block_radii(radius: int) -> list[int]:
    """What each of 4 blocks must cover so that every pair within ``radius`` meets in one of them."""
    low, rest = divmod(radius, 4)
    return [low if b <= rest else low - 1 for b in range(4)]


class RunningSums:
    """Bit sums over windows of any size at every place, from sums over powers of two."""

    def __init__(self, bits: np.ndarray):
        self.powers = [bits]

    def _power(self, k: int) -> np.ndarray:
        while len(self.powers) <= k:
            last, half = self.powers[-1], 1 << (len(self.powers) - 1)
            last = last.astype(np.uint16) if len(self.powers) == 8 else last.astype(np.uint32) if len(self.powers) == 16 else last
            self.powers.append(last[half:] + last[: max(0, len(last) - half)] if len(last) > half else last[:0])
        return self.powers[k]

    def prints(self, size: int, stride: int) -> np.ndarray:
        """The SimHash of the window of ``size`` rows at every ``stride``-th place that has one."""
        places = len(self.powers[0]) - size + 1
        if places <= 0:
            return np.zeros(0, np.uint64)
        total, own, at = None, False, 0
        for k in reversed(range(size.bit_length())):
            if size >> k & 1:
                part = self._power(k)[at : at + places : stride]
                if total is None:
                    total = part
                elif own and total.dtype == part.dtype and size < 256:
                    np.add(total, part, out=total)
                else:
                    total, own = (total + part if size < 256 else total.astype(np.uint32) + part), True
                at += 1 << k
        return np.packbits(total > size // 2).view(np.uint64)  # rows of 64 bits, so eight octets each


class SizeClass:
    """The items of one window size, and the Hamming blocks that index them.

    A block's table says of each of its 65536 values which items have a neighbour of it there,
    an item to a bit, for 64 items at a time.
    """

    def __init__(self, size: int, stride: int, items: list[int], prints: np.ndarray, radius: int):
        self.size, self.stride, self.radius = size, stride, radius
        self.items, self.prints = np.array(items), prints
        self.tables = []
        for first in range(0, len(items), 64):
            own, blocks = prints[first : first + 64], []
            kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(own) <= 8 * np.dtype(t).itemsize)
            for b, flips in enumerate(block_radii(radius)):
                if flips >= 0:
                    table = np.zeros(1 << 16, kind)
                    for j, value in enumerate(own.view(np.uint16)[b::4].tolist()):
                        table[_neighbours(value, flips)] |= kind(1 << j)
                    blocks.append((b, table))
            self.tables.append((first, own, blocks))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``prints``, item) of every pair within the radius."""
        at, item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        values = np.ascontiguousarray(prints).view(np.uint16).reshape(-1, 4)
        for first, own, blocks in self.tables if len(prints) else []:
            near = None
            for b, table in blocks:
                found = np.take(table, values[:, b])
                near = found if near is None else np.bitwise_or(near, found, out=near)
            for j, p in enumerate(own):
                some = np.flatnonzero((near & near.dtype.type(1 << j)).astype(bool))  # quicker over booleans
                some = some[np.bitwise_count(prints[some] ^ p) <= self.radius]
                if len(some):
                    at.append(some)
                    item.append(np.full(len(some), first + j))
        return np.concatenate(at), self.items[np.concatenate(item)]


class LeakIndex:
    def __init__(self, items: list[tuple[int, str | None]], similarity: float = SIMILARITY, radius: int = RADIUS):
        items = sorted((x for x in items if x[0] is not None), key=lambda x: x[0])
        words = LetterWords(pa.array([x[1] for x in items], pa.string()), BETWEEN)
        hashes, first = shingle_hashes(words)
        self.similarity, self.ids = similarity, [x[0] for x in items]
        self.shingles = [np.sort(hashes[a:b]) for a, b in zip(first, first[1:])]
        self.sizes = np.array([len(x) for x in self.shingles], np.int64)
        self.known = np.unique(hashes)
        self.rare_first, self.rare_item = self._rarest()
        by_size: dict[int, list[int]] = {}
        for i, own in enumerate(self.shingles):
            if len(own):
                by_size.setdefault(self._grid(len(own)), []).append(i)
        self.classes = []
        for size, members in sorted(by_size.items()):
            prints = np.concatenate([_prints(_bits(self.shingles[i]).sum(axis=0, dtype=np.int64)[None], np.array([len(self.shingles[i])])) for i in members])
            self.classes.append(SizeClass(size, self._stride(size), members, prints, radius))
        self.align = max((c.stride for c in self.classes), default=1)  # a multiple of every stride: texts start at such places in running sums
        self.reach = max((c.size + c.stride for c in self.classes), default=0)

    def _rarest(self) -> tuple[np.ndarray, np.ndarray]:
        """The items that have each known shingle among their rarest, and where each shingle's begin; a copy lacks fewer than an item's."""
        at = [np.searchsorted(self.known, x) for x in self.shingles]
        often, key, item = np.bincount(np.concatenate([np.unique(x) for x in at] or [[]]).astype(np.int64), minlength=len(self.known)), [], []
        for i, x in enumerate(at):
            own, times = np.unique(x, return_counts=True)
            order = np.argsort(often[own], kind="stable")
            lacked = len(x) - int(np.ceil(self.similarity * len(x) - 1e-9))
            some = own[order[: int(np.searchsorted(np.cumsum(times[order]), lacked, side="right")) + 1]]
            key.append(some)
            item.append(np.full(len(some), i))
        key, item = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (key, item))
        return np.searchsorted(key[order := np.argsort(key, kind="stable")], np.arange(len(self.known) + 1)), item[order]

    @staticmethod
    def _stride(size: int) -> int:
        return 1 << max(0, min(6, int(np.log2(max(1, size / 8)))))

    @classmethod
    def _grid(cls, n: int) -> int:
        """The size of the grid nearest to ``n``: exact up to 12, then in steps of 10 % that its stride divides."""
        if n <= 12:
            return n
        near = 12 * GRID ** round(np.log(n / 12) / np.log(GRID))
        stride = cls._stride(int(near))
        return max(12, int(round(near / stride)) * stride)

    def find(self, texts: pa.Array, exact: bool = False) -> list[list[dict]]:
        """The items that each text holds, each at its best start; if ``exact``, those beyond the radius too."""
        words = LetterWords(texts, BETWEEN)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        if not self.classes or not len(words.at):
            return out
        hashes, first = shingle_hashes(words)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        same = self.known[at] == hashes
        known = np.concatenate(([0], np.cumsum(same)))
        segments = []
        for doc, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
            for s in range(a, b, SEGMENT):
                segments.append((doc, s, min(b, s + SEGMENT + self.reach)))
        batch, size = [], 0
        for segment in segments:
            batch.append(segment)
            size += segment[2] - segment[1]
            if size >= SEGMENT:
                self._scan(batch, hashes, first, known, out)
                batch, size = [], 0
        self._scan(batch, hashes, first, known, out)
        if exact:
            place = np.flatnonzero(same)
            self._search(place, at[place], hashes, first, known, out)
        for found in out:
            found.sort(key=lambda m: (-m["similarity"], m["item_id"], m["start"]))
        return out

    def _scan(self, segments, hashes, first, known, out) -> None:
        if not segments:
            return
        doc, low, high = (np.array(x, np.int64) for x in zip(*segments))
        n, room = high - low, -(-(high - low) // self.align) * self.align
        at = np.cumsum(room) - room  # every segment starts at a multiple of all strides
        seg = np.repeat(np.arange(len(n)), room)
        bits = np.zeros((int(room.sum()), 64), np.uint8)
        filled = np.arange(n.sum()) + np.repeat(at - (np.cumsum(n) - n), n)
        bits[filled] = _bits(hashes[np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)])
        sums = RunningSums(bits)
        whole = np.flatnonzero((low == first[doc]) & (high == first[doc + 1]) & (n < self.reach))
        prints = _prints(np.add.reduceat(bits, at[whole], axis=0, dtype=np.int64) if len(whole) == len(at) else np.stack([bits[a : a + k].sum(axis=0, dtype=np.int64) for a, k in zip(at[whole], n[whole])]), n[whole]) if len(whole) else np.zeros(0, np.uint64)
        sizes = self.sizes
        last = np.flatnonzero(high == first[doc + 1])
        tail = np.minimum(n[last], self.reach)  # the end of each text, as far as an item and a stride reach
        tail_at = np.cumsum(tail) - tail
        upto = np.zeros((int(tail.sum()) + 1, 64), np.int32)
        np.cumsum(bits[np.arange(len(upto) - 1) + np.repeat(at[last] + n[last] - tail - tail_at, tail)], axis=0, dtype=np.int32, out=upto[1:])
        found: dict[tuple[int, int], set[int]] = {}
        for c in self.classes:
            where, item = c.within(sums.prints(c.size, c.stride))
            where = where * c.stride
            own = seg[where]
            ok = where + c.size <= at[own] + n[own]
            where, item, own = where[ok], item[ok], own[ok]
            of, start = doc[own], low[own] + where - at[own]
            # whole texts that are shorter, and the items' exact sizes at the last places of a text, where the grid has none
            short = np.flatnonzero((n[whole] < c.size) & (n[whole] >= int(0.9 * self.similarity * c.size)))
            more, of_more, start_more, size_more = [prints[short]], [doc[whole[short]]], [low[whole[short]]], [np.zeros(len(short), np.int64)]
            for size in np.unique(sizes[c.items]).tolist():
                back = np.arange(c.stride + max(0, c.size - size))[None]
                place = (n[last, None] - size - back).ravel()
                own, begin = np.repeat(last, back.size)[place >= 0], np.repeat(tail_at + tail - n[last], back.size)[place >= 0]
                place = place[place >= 0]
                more.append(np.packbits(2 * (upto[begin + place + size] - upto[begin + place]) > size).view(np.uint64))
                of_more.append(doc[own])
                start_more.append(low[own] + place)
                size_more.append(np.full(len(own), size))
            w, i = c.within(np.concatenate(more))
            size = np.concatenate(size_more)[w]
            w, i = w[(size == 0) | (sizes[i] == size)], i[(size == 0) | (sizes[i] == size)]
            of, start, item = np.append(of, np.concatenate(of_more)[w]), np.append(start, np.concatenate(start_more)[w]), np.append(item, i)
            need = sizes[item]
            likely = known[np.minimum(first[of + 1], start + need + c.stride)] - known[np.maximum(first[of], start - c.stride)] >= self.similarity * need
            for d, i, s in zip(of[likely].tolist(), item[likely].tolist(), start[likely].tolist()):
                reach = max(c.stride, len(self.shingles[i]) // 8)
                found.setdefault((d, i), set()).update(range(max(int(first[d]), s - reach), min(int(first[d + 1]), s + reach + 1)))
        for (d, i), starts in found.items():
            if best := self._verify(i, sorted(starts), hashes, int(first[d + 1])):
                s, similarity = best
                self._note(out[d], i, s - int(first[d]), similarity)

    def _note(self, found: list[dict], i: int, start: int, similarity: float) -> None:
        match = {"item_id": self.ids[i], "start": start, "n_words": len(self.shingles[i]) + SHINGLE - 1, "similarity": similarity}
        same = next((k for k, m in enumerate(found) if m["item_id"] == self.ids[i]), None)
        if same is None:
            found.append(match)
        elif (-similarity, start) < (-found[same]["similarity"], found[same]["start"]):
            found[same] = match

    def _search(self, place, shingle, hashes, first, known, out) -> None:
        """Notes every copy that has one of its item's rarest shingles; ``place`` has the known shingles' places."""
        begin, times = self.rare_first[shingle], self.rare_first[shingle + 1] - self.rare_first[shingle]
        upto, a = np.cumsum(times), 0
        while a < len(place):  # so many places that their items fit
            b = max(a + 1, int(np.searchsorted(upto, upto[a] - times[a] + FOUND, side="right")))
            n = times[a:b]
            item = self.rare_item[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[a:b], n)]
            at, size = np.repeat(place[a:b], n), self.sizes[item]
            doc = np.searchsorted(first, at, side="right") - 1
            low = np.maximum(first[doc], at - size + 1)
            likely = np.flatnonzero(known[np.minimum(first[doc + 1], at + size)] - known[low] >= self.similarity * size)
            likely = likely[np.lexsort((at[likely], item[likely], doc[likely]))]
            pair = doc[likely] * len(self.ids) + item[likely]
            fresh = np.concatenate(([True], (pair[1:] != pair[:-1]) | (low[likely][1:] > at[likely][:-1] + 1))) if len(pair) else np.zeros(0, bool)
            cuts = np.flatnonzero(fresh)
            for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(likely)]):
                d, i = int(doc[likely[x]]), int(item[likely[x]])
                if best := self._slide(i, int(low[likely[x]]), int(at[likely[y - 1]]), hashes, int(first[d + 1])):
                    self._note(out[d], i, best[0] - int(first[d]), best[1])
            a = b

    def _slide(self, i: int, low: int, high: int, hashes: np.ndarray, end: int) -> tuple[int, float] | None:
        """As ``_verify``, at all starts from ``low`` to ``high``, in time that grows with their number and the item's size alone."""
        own, times = np.unique(self.shingles[i], return_counts=True)
        size, best, common, stop = len(self.shingles[i]), None, 0, low
        window = hashes[low : min(end, high + size)]
        at = np.minimum(np.searchsorted(own, window), len(own) - 1)
        kinds, room = np.where(own[at] == window, at, -1).tolist(), times.tolist()
        for s in range(low, high + 1):
            while stop < min(end, s + size):
                if (kind := kinds[stop - low]) >= 0:
                    room[kind] -= 1
                    common += room[kind] >= 0
                stop += 1
            similarity = common / (size + stop - s - common)
            if similarity >= self.similarity and (best is None or similarity > best[1]):
                best = (s, similarity)
            if (kind := kinds[s - low]) >= 0:
                common -= room[kind] >= 0
                room[kind] += 1
        return best

    def _verify(self, i: int, starts: list[int], hashes: np.ndarray, end: int) -> tuple[int, float] | None:
        own, times = np.unique(self.shingles[i], return_counts=True)
        best = None
        for s in starts:
            window = hashes[s : min(end, s + len(self.shingles[i]))]
            at = np.minimum(np.searchsorted(own, window), len(own) - 1)
            common = int(np.minimum(np.bincount(at[own[at] == window], minlength=len(own)), times).sum())
            similarity = common / (len(self.shingles[i]) + len(window) - common)
            if similarity >= self.similarity and (best is None or similarity > best[1]):
                best = (s, similarity)
        return best


def rounds(items: DataFrame, item_id: str, item_text: str) -> Iterator[tuple[Broadcast, bool]]:
    """Indexes over all items, each within the bounds of one round and sent out once; and whether it is the last."""
    spark = items.sparkSession
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter("i is not null")
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    parts = int(max(1, -(-n // MAX_ITEMS), -(-chars // MAX_CHARS)))
    part = F.pmod(F.xxhash64("i"), F.lit(parts))
    for p in range(parts):
        yield spark.sparkContext.broadcast(LeakIndex([(r["i"], r["t"]) for r in rows.filter(part == p).collect()])), p == parts - 1


MATCHES = "array<struct<item_id:bigint,start:bigint,n_words:bigint,similarity:double>>"
_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())]))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, matches) per row of ``docs``: the items it holds, best first."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("matches", F.array().cast(MATCHES))

    for index, last in rounds(items, item_id, item_text):

        def run(batches, index=index, last=last):
            for batch in batches:
                for part in text_slices(batch, "text", SLICE):
                    found = [old + new for old, new in zip(part.column(2).to_pylist(), index.value.find(part.column(1)))]
                    found = [sorted(x, key=lambda m: (-m["similarity"], m["item_id"], m["start"])) for x in found]
                    text = [] if last else [part.column(1)]  # no round needs it after the last
                    yield pa.RecordBatch.from_arrays([part.column(0), *text, pa.array(found, _MATCH)], ["doc_id", *["text"][: len(text)], "matches"])

        rows = rows.mapInArrow(released(run), f"doc_id long, {'' if last else 'text string, '}matches {MATCHES}")
    return rows.select("doc_id", "matches")


def decontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, beyond the radius either, all columns unchanged."""
    rows = docs
    for index, _ in rounds(items, item_id, item_text):

        def run(batches, index=index):
            for batch in batches:
                for part in text_slices(batch, text_col, SLICE):
                    yield part.filter(pa.array([not found for found in index.value.find(part.column(text_col), exact=True)], pa.bool_()))

        rows = rows.mapInArrow(released(run), docs.schema)
    return rows

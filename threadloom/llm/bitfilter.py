"""Bit filters over many 64-bit hashes, built by ranges of bits.

A hash has a place in each of ``HASHES`` bit sets of ``bits`` bits. Places are dealt out by
ranges of 2^16 bits, each range is put together by one task, and the driver gathers the
finished ranges: no task holds a whole set while it is built, two bytes a place are shuffled,
and the caller's ``bits`` bound what is gathered and broadcast. A filter errs only towards
"may be", so its size changes cost, never results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import forget, materialise, partitions_for, released

HASHES = 4
_FACTORS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
SEGMENT_BITS = 16
#: Places that a task collects before it passes them on.
HELD = 1 << 21
#: Bytes of finished ranges that the driver fetches in one job.
FETCHED = 16 << 20


def position(h: np.ndarray, bits: int, k: int) -> np.ndarray:
    """Each hash's place in the ``k``-th bit set, counted over all sets."""
    h = h.view(np.uint64)
    if k:
        h = ((h ^ (h >> np.uint64(29))) * np.uint64(_FACTORS[k - 1])) >> np.uint64(33)
    return (h & np.uint64(bits - 1)).astype(np.int64) + k * bits


def known(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Hashes that have all their bits."""
    left = np.arange(len(h))
    for k in range(HASHES):
        at = position(h[left] if k else h, bits, k)
        left = left[(bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    out = np.zeros(len(h), bool)
    out[left] = True
    return out


def bits_for(entries: int, each: int, least: int = 1 << 16, most: int = 1 << 29) -> int:
    """Bits of each set: a power of two with ``each`` bits or more an entry, within bounds."""
    return 1 << int(np.clip(np.ceil(np.log2(max(1, entries * each))), np.log2(least), np.log2(most)))


def packed(bitmap: np.ndarray) -> tuple[int, bytes]:
    """A bit set as it is broadcast: each copy of it on a disk counts."""
    return len(bitmap), pa.compress(pa.py_buffer(bitmap), codec="zstd", asbytes=True)


def unpacked(bits: tuple[int, bytes]) -> np.ndarray:
    return np.frombuffer(pa.decompress(bits[1], decompressed_size=bits[0], codec="zstd"), np.uint8)


def ranges(hashes: DataFrame, bits: int, made=None) -> DataFrame:
    """(seg, seen, again): the finished ranges of "seen" and "seen again" bits over the first column of ``hashes``; nulls count as 0.

    ``made`` yields a batch's hashes where they are not a column: no row passes between workers for each of them.
    """

    def deal(batches):
        held, n = [], 0

        def flush():
            at = np.sort(np.concatenate(held))
            if len(at) > 2:  # twice says as much as more often
                at = at[np.concatenate(([True, True], (at[2:] != at[1:-1]) | (at[2:] != at[:-2])))]
            cuts = np.flatnonzero(np.concatenate(([True], (at[1:] >> SEGMENT_BITS) != (at[:-1] >> SEGMENT_BITS))))
            low = (at & ((1 << SEGMENT_BITS) - 1)).astype("<u2").tobytes()
            ends = np.append(cuts[1:], len(at))
            values = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer((2 * np.append(0, ends)).astype(np.int32)), pa.py_buffer(low)])
            return pa.RecordBatch.from_arrays([pa.array((at[cuts] >> SEGMENT_BITS).astype(np.int32)), values], ["seg", "places"])

        for batch in batches:
            for h in made(batch) if made else (batch.column(0).fill_null(0).to_numpy(zero_copy_only=False),):
                for s in range(0, len(h), HELD):
                    held += [position(h[s : s + HELD], bits, k) for k in range(HASHES)]
                    n += HASHES * len(h[s : s + HELD])
                    if n >= HELD:
                        yield flush()
                        held, n = [], 0
        if n:
            yield flush()

    def gather(batches):
        current, held = None, []

        def finish():
            times = np.bincount(np.frombuffer(b"".join(held), "<u2"), minlength=1 << SEGMENT_BITS)
            once, twice = (np.packbits(times > k, bitorder="little").tobytes() for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([once], pa.binary()), pa.array([twice], pa.binary())], ["seg", "seen", "again"])

        for batch in batches:
            for seg, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if seg != current:
                    if held:
                        yield finish()
                    current, held = seg, []
                held.append(places)
        if held:
            yield finish()

    n = min(partitions_for(hashes.sparkSession), max(1, HASHES * bits >> SEGMENT_BITS))
    dealt = (hashes if made else hashes.select(hashes.columns[0])).mapInArrow(released(deal), "seg int, places binary")
    return dealt.repartition(n, "seg").sortWithinPartitions("seg").mapInArrow(released(gather), "seg int, seen binary, again binary")


def fetched(stored: DataFrame, bits: int, column: str, held: int | None = None) -> np.ndarray:
    """One column of stored ranges as bit sets, folded to ``held`` bits each: the driver holds no more than that and a job's rows."""
    held, size = held or bits, (1 << SEGMENT_BITS) // 8
    out, each, place = np.zeros(HASHES * held // 8, np.uint8), bits >> SEGMENT_BITS, held >> SEGMENT_BITS
    for seg, part in stored.select("seg", column).coalesce(-(-HASHES * bits // (8 * FETCHED))).toLocalIterator():
        at = (seg // each * place + seg % each % place) * size
        out[at : at + size] |= np.frombuffer(part, np.uint8)
    return out


def build(hashes: DataFrame, bits: int, stored: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """"Seen" and "seen again" bits over the one column of ``hashes``; nulls count as 0.

    If ``stored``, the finished ranges go through the shared folder and the shuffles' files go at once.
    """
    gathered = ranges(hashes, bits)
    seen, again, size = np.zeros(HASHES * bits // 8, np.uint8), np.zeros(HASHES * bits // 8, np.uint8), (1 << SEGMENT_BITS) // 8
    parts = -(-2 * HASHES * bits // (8 * FETCHED))
    if stored:
        gathered = materialise(gathered, "bits", "zstd")
    dealt = gathered.coalesce(parts) if stored else gathered.repartition(parts)  # a job for each partition: not one for each task
    for seg, one, two in dealt.toLocalIterator():  # 2 * HASHES * bits in all, whatever the input
        seen[seg * size : (seg + 1) * size] = np.frombuffer(one, np.uint8)[: len(seen)]
        again[seg * size : (seg + 1) * size] = np.frombuffer(two, np.uint8)[: len(seen)]
    if stored:
        forget(gathered)
    return seen, again

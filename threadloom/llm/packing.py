"""Bounded-space online packing of token ids into sequences of a fixed length.

Every partition keeps a fixed number of open windows. A document's full-length pieces are
sequences of their own; what is left of it goes to the open window with the least room that
holds it. If none does and all windows are open, the fullest is emitted and a new one opened.
Windows still open at the end of a partition are merged: their pieces are packed again,
largest first into the tightest window, in groups of a bounded number of partitions.

Defined cases: a null text is empty and has the end id alone; repeated rows are packed as
often as they come; an empty table gives no pieces; very long texts give many full pieces.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, released, text_slices
from .tokenise import default_tokenizer, encoder

LENGTH = 1024
OPEN_WINDOWS = 64
#: Partitions whose leftover windows are merged together.
MERGE_GROUP = 16

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """At most ``limit`` windows that still have room; pieces are held until their window closes."""

    def __init__(self, length: int, limit: int, first_id: int):
        self.length, self.limit, self.next_id = length, limit, first_id
        self.room: list[tuple[int, int]] = []  # (room, window), least room first
        self.held: dict[int, list[tuple]] = {}

    def place(self, piece: tuple) -> list[tuple]:
        """Put (doc_id, start, length, crc, doc_tokens) into a window; returns what that closes."""
        closed, at = [], bisect.bisect_left(self.room, (piece[2], -1))
        if at < len(self.room):
            room, window = self.room.pop(at)
        else:
            if len(self.room) >= self.limit:
                closed = self.held.pop(self.room.pop(0)[1])
            room, window = self.length, self.next_id
            self.next_id += 1
            self.held[window] = []
        self.held[window].append((*piece, window, self.length - room))
        if room == piece[2]:
            return closed + self.held.pop(window)
        bisect.insort(self.room, (room - piece[2], window))
        return closed


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    end_id: int = 0, length: int = LENGTH, open_windows: int = OPEN_WINDOWS, merge_group: int = MERGE_GROUP,
) -> DataFrame:
    """One row per piece: where it starts in its document's ids, its length and checksum, its sequence and offset there."""
    path = tokenizer or default_tokenizer()
    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def batch_of(columns, group, final) -> pa.RecordBatch:
        arrays = [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(len(arrays[0]), group), pa.int32()), pa.array(np.full(len(arrays[0]), final))], [*fields, "merge", "final"])

    def run(batches):
        words, partition = encoder(path), TaskContext.get().partitionId()
        group, windows = partition // merge_group, OpenWindows(length, open_windows, partition << 40)
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                ids, counts = words.encode(part.column(1), end_id)
                ids, rows, full = ids.astype("<u4"), [], []
                raw, at = memoryview(ids).cast("B"), 0
                for doc_id, n in zip(part.column(0).to_pylist(), counts.tolist()):
                    for start in range(0, n, length):
                        size = min(length, n - start)
                        piece = (doc_id, start, size, zlib.crc32(raw[4 * (at + start) : 4 * (at + start + size)]), n)
                        if size == length:
                            full.append((*piece, windows.next_id, 0))
                            windows.next_id += 1
                        else:
                            rows += windows.place(piece)
                    at += n
                if rows or full:
                    yield batch_of(list(zip(*rows, *full)), group, True)
        if left := [x for held in windows.held.values() for x in held]:
            yield batch_of(list(zip(*left)), group, False)

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        windows, rows = OpenWindows(length, len(pdf) + 1, (1 << 62) | int(key[0]) << 32), []
        for piece in pdf[fields[:5]].astype(object).where(pdf[fields[:5]].notna(), None).itertuples(index=False, name=None):
            rows += windows.place(tuple(None if x is None else int(x) for x in piece))
        rows += [x for held in windows.held.values() for x in held]
        return pd.DataFrame({f: pd.array(c, "Int64") for f, c in zip(fields, zip(*rows))})

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    placed = materialise(narrow.mapInArrow(released(run), SCHEMA + ", merge int, final boolean"), "packing")
    merged = placed.filter("not final").groupBy("merge").applyInPandas(merge, SCHEMA)
    return placed.filter("final").select(fields).unionByName(merged)

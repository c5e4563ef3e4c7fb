"""Compressed NDJSON by zstd frames: found once, dealt as splits, read as streams.

A frame's blocks say how long they are, so frames are found without decompressing anything: a task
walks a file's block headers. Frames that begin in the same stretch of ``SPLIT_BYTES`` are a
split; a split reads its own lines and, as lines may cross frames, the end of its last one.
Windows may be as wide as 2 GB. What is cut off in the middle of a frame raises an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_WINDOW = 1 << 31
#: Compressed bytes of a split (one frame at least) and decompressed bytes handled at once.
SPLIT_BYTES, CHUNK = 64 << 20, 8 << 20
#: Fixed values of the format: a frame's first four bytes; those of a frame to be skipped but for their last four bits.
MAGIC, SKIPPABLE = 0xFD2FB528, 0x184D2A50
FRAME = "file string, start bigint, end bigint, window bigint"


def uri(path: str) -> str:
    """A path as Hadoop names it, in the form that Arrow takes."""
    return re.sub(r"^file:/(?=[^/])", "file:///", path)


def open_file(path: str) -> pa.NativeFile:
    """A file of any file system that Arrow knows, to be read from any place."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(uri(path))
    return system.open_input_file(name)


def walk(source, size: int, name: str = "") -> Iterator[tuple[int, int, int]]:
    """(start, end, window) of each frame of a file; skippable frames have none."""
    import zstandard

    def read(at: int, n: int) -> bytes:
        source.seek(at)
        return source.read(n)

    start = 0
    while start < size:
        head = read(start, 18)
        magic = int.from_bytes(head[:4], "little")
        if magic & ~0xF == SKIPPABLE and len(head) >= 8:
            start += 8 + int.from_bytes(head[4:8], "little")
            if start > size:
                raise ValueError(f"{name} ends inside a frame")
            continue
        if magic != MAGIC:
            raise ValueError(f"{name} holds no zstd frame at byte {start}")
        try:
            params = zstandard.get_frame_parameters(head)
            at = start + zstandard.frame_header_size(head)
        except zstandard.ZstdError as error:
            raise ValueError(f"{name} ends inside a frame") from error
        last = False
        while not last:
            block = int.from_bytes(b := read(at, 3), "little")
            last, kind = block & 1 == 1, block >> 1 & 3
            if len(b) < 3:
                raise ValueError(f"{name} ends inside a frame")
            if kind == 3:
                raise ValueError(f"{name} has a damaged frame at byte {start}")
            at += 3 + (1 if kind == 1 else block >> 3)
        at += 4 if params.has_checksum else 0
        if at > size:
            raise ValueError(f"{name} ends inside a frame")
        yield start, at, params.window_size
        start = at


def frames(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, start, end, window) of all frames of the files; a task for each file."""
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with open_file(name) as source:
                    found = [(name, *f) for f in walk(source, source.size(), name)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["file", "start", "end", "window"])

    return files.mapInArrow(run, FRAME)


def splits(found: DataFrame) -> DataFrame:
    """(file, start, end): frames that one task reads."""
    slot = F.floor(F.col("start") / SPLIT_BYTES)
    return found.groupBy("file", slot.alias("slot")).agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("slot")


def chunks(name: str, start: int, end: int | None) -> Iterator[bytes]:
    """Decompressed bytes of the frames from ``start`` to ``end``, or to the file's."""
    import zstandard

    class Stretch:
        """So much of a file as a stream."""

        def __init__(self, source, left: int):
            self.source, self.left = source, left

        def read(self, n: int = -1) -> bytes:
            got = self.source.read(self.left if n < 0 else min(n, self.left))
            self.left -= len(got)
            return got

    with open_file(name) as source:
        size = source.size()
        source.seek(start)
        stretch = Stretch(source, (size if end is None else end) - start)
        with zstandard.ZstdDecompressor(max_window_size=LONG_WINDOW).stream_reader(stretch, read_across_frames=True) as reader:
            while chunk := reader.read(CHUNK):
                yield chunk


def split_lines(name: str, start: int, end: int) -> Iterator[list[bytes]]:
    """Lines that begin in a split, a list for each chunk: the first one belongs to the split before unless the file begins here."""
    rest, begun = b"", start == 0
    for chunk in chunks(name, start, end):
        *whole, rest = (rest + chunk).split(b"\n")
        if not begun and whole:
            begun, whole = True, whole[1:]
        if whole:
            yield whole
    if not begun:  # inside one line all the way: a split before has it
        return
    for chunk in chunks(name, end, None):
        head, found, _ = chunk.partition(b"\n")
        rest += head
        if found:
            yield [rest]
            return
    if rest:
        yield [rest]


def frame_lines(spark: SparkSession, found: DataFrame, probes: tuple[str, ...] = ()) -> DataFrame:
    """(file, value) of all lines of the frames; with ``probes`` only lines that hold one of them, in any case of ASCII letters.

    Lines without a probe go before they are decoded. A last line without an end counts; memory is the window, a chunk and a line.
    """
    wanted = [p.encode().lower() for p in probes]

    def run(batches):
        for batch in batches:
            for name, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                for whole in split_lines(name, start, end):
                    kept = [x for x in whole if any(p in low for low in (x.lower(),) for p in wanted)] if wanted else whole
                    if kept:
                        values = pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in kept], pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(kept), pa.string()), values], ["file", "value"])

    dealt = splits(found)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "file", "start").mapInArrow(run, "file string, value string")

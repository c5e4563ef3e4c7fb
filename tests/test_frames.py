import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from threadloom.sources import files, frames

LINES = [f'{{"id": "{i}", "subreddit": "{random.Random(i).choice(["Books", "x"])}", "body": "é{"y" * (i % 90)}"}}' for i in range(3000)]


def packed(data: bytes, sizes, **params) -> bytes:
    """``data`` as frames of so many bytes each, cut wherever they end."""
    out, at = b"", 0
    for n in sizes:
        out += zstandard.ZstdCompressor(**params).compress(data[at : at + n])
        at += n
    return out + zstandard.ZstdCompressor(**params).compress(data[at:])


def wide_frame(data: bytes, exponent: int = 21) -> bytes:
    """A frame of stored blocks whose header asks for a window of 2^(10 + exponent) bytes."""
    out = frames.MAGIC.to_bytes(4, "little") + bytes([0, exponent << 3])
    pieces = [data[i : i + 100_000] for i in range(0, len(data), 100_000)]
    for i, piece in enumerate(pieces):
        out += ((len(piece) << 3) | (i == len(pieces) - 1)).to_bytes(3, "little") + piece
    return out


def put(folder, name, data):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data)
    return folder


def test_frames_are_found_without_decompressing(tmp_path):
    body = "\n".join(LINES).encode()
    data = packed(body, [1000, 0, 50_000], write_checksum=True)
    data = data + (frames.SKIPPABLE + 3).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"12345" + wide_frame(b"\nlast", 21)
    found = list(frames.walk(io.BytesIO(data), len(data)))
    assert len(found) == 5 and found[0][0] == 0 and found[-1][1:] == (len(data), 1 << 31)
    assert all(zstandard.ZstdDecompressor().decompressobj().decompress(data[a:b]) is not None for a, b, _ in found[:4])
    for cut in (len(data) - 1, found[2][1] - 1, found[1][0] + 5):
        with pytest.raises(ValueError, match="ends inside a frame"):
            list(frames.walk(io.BytesIO(data[:cut]), cut))
    with pytest.raises(ValueError, match="no zstd frame"):
        list(frames.walk(io.BytesIO(b"plain text"), 10))


@pytest.mark.parametrize("end", ["", "\n"])
def test_one_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch, end):
    monkeypatch.setattr(frames, "SPLIT_BYTES", 500)
    body = ("\n".join([*LINES, "", "z" * 5000]) + end).encode()
    rng = random.Random(3)
    sizes = [rng.choice([1, 40, 2000, 9000]) for _ in range(60)] + [body.index(b"\n", 150_000) + 1]  # cut inside lines, and right behind one
    folder = put(tmp_path / "in", "RC_2023-01.zst", packed(body, sizes))
    found = frames.frames(spark, files.dump_files(spark, str(folder)))
    assert found.count() == 62 and frames.splits(found).count() > 10
    rows = files.lines(spark, str(folder))
    assert rows.rdd.getNumPartitions() > 1
    assert sorted(r.value for r in rows.collect()) == sorted([*LINES, "", "z" * 5000])
    assert rows.select("ym").distinct().collect()[0].ym == "2023-01"
    some = files.lines(spark, str(folder), probes=("bOOks", "zz"))
    assert sorted(r.value for r in some.collect()) == sorted([x for x in LINES if "Books" in x] + ["z" * 5000])


def test_widest_windows_take_the_frame_reader(spark, tmp_path):
    folder = put(tmp_path / "in", "RS_2023-02.zst", wide_frame(b'{"id": "1"}\n{"id": "2"}'))
    put(folder, "RS_2023-03.zst", packed(b'{"id": "3"}\n', []))
    assert sorted(r.value for r in files.lines(spark, str(folder)).collect()) == ['{"id": "1"}', '{"id": "2"}', '{"id": "3"}']
    with pytest.raises(Exception, match="(?i)window|memory|zstd"):  # beyond Spark's own reader
        files.lines(spark, str(folder), by_frames=False).collect()


def test_a_truncated_file_fails_loudly(spark, tmp_path):
    data = packed("\n".join(LINES).encode(), [20_000])
    folder = put(tmp_path / "in", "RC_2023-01.zst", data[:-10])
    with pytest.raises(Exception, match="ends inside a frame"):
        files.lines(spark, str(folder)).agg(F.count("value")).collect()
    assert files.lines(spark, str(tmp_path / "in"), "2024-01").count() == 0

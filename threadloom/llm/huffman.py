"""Token ids in files of canonical length-limited Huffman codes.

Format. A header table holds one binary: the code length of every id (0: never occurs), from
which canonical codes follow. A block table holds independent blocks of whole documents in
ascending id order; a block's payload is

    "THB1" | documents, checkpoints, bit bytes: u32 | doc ids: i64 each | ids per document: u32 each
    | bit offset of every 128th id of each document: u32 each | bits, big-endian, documents byte-aligned

all little-endian. Decoding peeks a code's widest length at once in a table of (id, length);
every checkpoint is a lane of its own, so a block's lanes are decoded side by side.

Defined cases: a null text has the end id alone; repeated rows are written as often as they
come; rows of equal doc_id follow each other, ordered by their ids' hash; null ids come first; an
empty table has no blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, partitions_for, released, text_slices
from .tokenise import default_tokenizer, encoder

MAX_CODE_BITS = 16
CHECKPOINT = 128
IDS_PER_BLOCK = 1 << 16
IDS_PER_PART = 1 << 25
#: Text tokenised at once, in bytes.
TEXT_BYTES = 2 << 20
MAGIC = b"THB1"
BLOCKS = "part int, start_in_part long, n_docs long, n_ids long, payload binary"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_CODE_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (more if that many ids cannot have them), by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    max_bits = max(max_bits, int(np.ceil(np.log2(len(used)))))  # 16 are enough for 65536 ids
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    is_leaf, row = [], leaves
    levels = [np.ones(len(leaves), bool)]
    for _ in range(max_bits - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        order = np.argsort(both, kind="stable")
        row, is_leaf = both[order], order < len(leaves)
        levels.append(is_leaf)
    take, depth = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for level in reversed(levels):
        chosen = int(level[:take].sum())
        depth[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    codes, code, was = np.zeros(len(lengths), np.uint32), 0, 0
    used = np.flatnonzero(lengths)
    for symbol in used[np.argsort(lengths[used], kind="stable")].tolist():
        code <<= int(lengths[symbol]) - was
        codes[symbol], was = code, int(lengths[symbol])
        code += 1
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, code length) by the next ``width`` bits."""
    width = max(1, int(lengths.max(initial=1)))
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    spans = np.left_shift(1, width - lengths[used].astype(np.int64))
    ids, sizes = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.uint8)
    filled = int(spans.sum())
    ids[:filled], sizes[:filled] = np.repeat(used, spans), np.repeat(lengths[used], spans)
    return ids, sizes, width


def encode_documents(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> list[tuple[bytes, bytes]]:
    """(checkpoints, bits) of each document; the checkpoints count bits from the document's own start.

    Every document has an id at least; codes are of 16 bits at most.
    """
    if not len(ids):
        return []
    if lengths.max() > 16:
        raise ValueError("codes of more than 16 bits")
    each = -(-counts // 4)  # four codes of 16 bits at most make one word; documents are filled up with codes of no bits
    room = np.cumsum(each) - each
    place = np.arange(len(ids)) + np.repeat(4 * room - (np.cumsum(counts) - counts), counts)
    size, code = np.zeros(4 * int(each.sum()), np.uint8), np.zeros(4 * int(each.sum()), np.uint64)
    size[place], code[place] = lengths[ids], codes[ids]
    starts = np.cumsum(size, dtype=np.int64) - size
    four = size.reshape(-1, 4).astype(np.uint64)
    word, wide = code.reshape(-1, 4)[:, 0], four[:, 0]
    for k in range(1, 4):
        word, wide = (word << four[:, k]) | code.reshape(-1, 4)[:, k], wide + four[:, k]
    before = starts[4 * room]  # bits ahead of each document
    octets = (np.append(before[1:], int(size.sum(dtype=np.int64))) - before + 7) // 8
    base = np.cumsum(octets) - octets
    at = starts[::4] + np.repeat(8 * base - before, each)
    cell, used = at >> 6, (at & 63).astype(np.uint64)
    # a word lies in one cell or in two that follow each other; numpy shifts by less than 64 alone
    left = np.where(wide > 0, word << ((np.uint64(64) - wide) & np.uint64(63)), np.uint64(0))
    bits = np.zeros((8 * int(octets.sum()) >> 6) + 2, np.uint64)
    for where, part in ((cell, left >> used), (cell + 1, np.where(used > 0, left << ((np.uint64(64) - used) & np.uint64(63)), np.uint64(0)))):
        first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        bits[where[first]] |= np.bitwise_or.reduceat(part, first)
    bits = bits.astype(">u8").tobytes()
    inside = starts - np.repeat(before, 4 * each)
    return [
        (inside[4 * r : 4 * r + n : CHECKPOINT].astype("<u4").tobytes(), bits[b : b + o])
        for r, n, b, o in zip(room.tolist(), counts.tolist(), base.tolist(), octets.tolist())
    ]


def write_block(docs: list[tuple[int, int, bytes, bytes]]) -> bytes:
    """One payload from (doc_id, ids, checkpoints, bits) rows."""
    sizes = np.array([len(d[3]) for d in docs], np.int64)
    base = ((np.cumsum(sizes) - sizes) * 8).tolist()
    checkpoints = b"".join((np.frombuffer(d[2], "<u4") + np.uint32(b)).astype("<u4").tobytes() for d, b in zip(docs, base))
    bits = b"".join(d[3] for d in docs)
    head = struct.pack("<4sIII", MAGIC, len(docs), len(checkpoints) // 4, len(bits))
    return head + np.array([d[0] for d in docs], "<i8").tobytes() + np.array([d[1] for d in docs], "<u4").tobytes() + checkpoints + bits


def read_block(payload: bytes, table: tuple[np.ndarray, np.ndarray, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc ids, ids per document, and all ids of a block."""
    magic, n_docs, n_marks, n_bits = struct.unpack_from("<4sIII", payload)
    if magic != MAGIC:
        raise ValueError("not a block of Huffman-coded ids")
    at = 16
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at)
    counts = np.frombuffer(payload, "<u4", n_docs, at := at + 8 * n_docs).astype(np.int64)
    marks = np.frombuffer(payload, "<u4", n_marks, at := at + 4 * n_docs).astype(np.int64)
    bits = np.frombuffer(payload, np.uint8, n_bits, at + 4 * n_marks)
    bits = np.concatenate((bits, np.zeros(4, np.uint8))).astype(np.uint32)
    words = (bits[:-3] << np.uint32(24)) | (bits[1:-2] << np.uint32(16)) | (bits[2:-1] << np.uint32(8)) | bits[3:]
    ids, sizes, width = table
    lanes = -(-counts // CHECKPOINT)
    lane_size = np.full(n_marks, CHECKPOINT)
    lane_size[np.cumsum(lanes) - 1] = counts - (lanes - 1) * CHECKPOINT
    out_at = np.cumsum(lane_size) - lane_size
    out = np.empty(int(counts.sum()), np.uint32)
    order = np.argsort(-lane_size, kind="stable")
    pos, place, ordered = marks[order], out_at[order], -lane_size[order]
    mask = np.uint32((1 << width) - 1)
    for step in range(int(lane_size.max(initial=0))):
        n = int(np.searchsorted(ordered, -step))  # lanes with more than ``step`` ids
        pos, place = pos[:n], place[:n]
        peek = (words[pos >> 3] >> (32 - width - (pos & 7)).astype(np.uint32)) & mask
        out[place + step] = ids[peek]
        pos = pos + sizes[peek]
    return doc_ids, counts, out


def token_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, n, ids, used, times) per row: every text's ids and the end id, as little-endian integers of the vocabulary's width.

    The last row of each task has no ids, but which ids the task's texts have and how often.
    """

    def run(batches):
        words = encoder(path)
        counts = np.zeros(1 << (8 * words.dtype.itemsize) if words.dtype.itemsize < 4 else words.tokenizer.get_vocab_size() + end_id + 1, np.int64)
        none = lambda n, kind: pa.nulls(n, kind)
        for batch in batches:
            for part in text_slices(batch, "text", TEXT_BYTES):
                ids, n = words.encode(part.column("text"), end_id)
                counts += np.bincount(ids, minlength=len(counts))
                ends = np.cumsum(n) * words.dtype.itemsize
                offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32))
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, offsets, pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), packed, none(len(n), _LIST), none(len(n), _LIST)], _TOKENS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([none(1, pa.int64()), none(1, pa.int64()), none(1, pa.binary()), pa.array([used], _LIST), pa.array([counts[used]], _LIST)], _TOKENS)

    return docs.mapInArrow(released(run), "doc_id long, n long, ids binary, used array<long>, times array<long>")


_LIST, _TOKENS = pa.list_(pa.int64()), ["doc_id", "n", "ids", "used", "times"]


def _ids_of(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """All ids of a column of packed ids."""
    low, high = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)[[0, -1]]
    return np.frombuffer(column.buffers()[2] or b"", dtype, int(high - low) // dtype.itemsize, int(low))


def global_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; the vocabulary bounds what reaches the driver."""
    each = tokens.filter("used is not null").select(F.explode(F.arrays_zip("used", "times")).alias("x"))
    rows = each.groupBy(F.col("x.used").alias("id")).agg(F.sum("x.times").alias("n")).toPandas()
    counts = np.zeros(int(rows.id.max()) + 1 if len(rows) else 1, np.int64)
    counts[rows.id.to_numpy(np.int64)] = rows.n.to_numpy(np.int64)
    return counts


def write_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 2) -> tuple[DataFrame, DataFrame]:
    """Encode every text and write header and blocks; returns scans of both."""
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = encoder(path)
    if end_id >= 1 << (8 * words.dtype.itemsize):
        raise ValueError(f"the end id {end_id} is beyond the vocabulary's integers")
    dtype = words.dtype
    tokens = materialise(token_ids(narrow, path, end_id), "huffman-tokens", "zstd")
    counts = global_counts(tokens)
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    header = materialise(spark.createDataFrame([(bytearray(lengths.tobytes()),)], "code_lengths binary"), "huffman-header")

    n_parts = int(max(partitions_for(spark), -(-int(counts.sum()) // IDS_PER_PART)))
    bounds = np.unique(tokens.approxQuantile("doc_id", [i / n_parts for i in range(1, n_parts)], 0.1 / n_parts)) if n_parts > 1 else np.zeros(0)
    deal = _dealing_keys(spark, n_parts)

    def encode(batches):
        for batch in batches:
            for part in text_slices(batch, "ids", 1 << 20):
                n, ids = part.column("n").to_numpy(), _ids_of(part.column("ids"), dtype)
                rows = encode_documents(ids, n, lengths, codes)
                of = np.searchsorted(bounds, part.column("doc_id").fill_null(NULL_ID).to_numpy(), side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deal[of]), pa.array(of, pa.int32()), part.column("doc_id"), part.column("tie"), pa.array(n, pa.int64()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                    ["deal", "part", "doc_id", "tie", "n", "marks", "bits"],
                )

    def blocks(batches):
        held, size, start, part = [], 0, 0, None

        def flush():
            nonlocal held, size, start
            row = [pa.array([part], pa.int32()), *(pa.array([x], pa.int64()) for x in (start, len(held), size)), pa.array([write_block(held)], pa.binary())]
            held, size, start = [], 0, start + size
            return pa.RecordBatch.from_arrays(row, ["part", "start_in_part", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for _, of, doc_id, _, n, marks, bits in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (of != part or size >= IDS_PER_BLOCK):
                    yield flush()
                if of != part:
                    part, start = of, 0
                held.append((NULL_ID if doc_id is None else doc_id, n, marks, bits))
                size += n
        if held:
            yield flush()

    rows = tokens.filter("n is not null").select("doc_id", F.xxhash64("ids").alias("tie"), "n", "ids")
    encoded = rows.mapInArrow(released(encode), "deal int, part int, doc_id long, tie long, n long, marks binary, bits binary")
    ordered = encoded.repartition(n_parts, "deal").sortWithinPartitions("part", "doc_id", "tie", "n")
    return header, materialise(ordered.mapInArrow(released(blocks), BLOCKS), "huffman-blocks")


def _dealing_keys(spark, n: int) -> np.ndarray:
    """Of each of ``n`` parts, a key that the hash partitioning of ``n`` partitions sends to a partition of its own."""
    keys = spark.range(40 * n).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p")).agg(F.min("k").alias("k")).toPandas()  # n rows
    out = np.arange(n, dtype=np.int32)
    out[keys.p.to_numpy(np.int64)] = keys.k.to_numpy(np.int32)
    return out


#: Stands for a null doc_id in the files.
NULL_ID = -(1 << 63)


def read_ids(header: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) per document, from the files alone; ids are little-endian u32."""
    lengths = np.frombuffer(header.first()[0], np.uint8)
    totals = dict(blocks.groupBy("part").agg(F.sum("n_ids")).collect())  # a row for each part
    starts, total = {}, 0
    for part in sorted(totals):
        starts[part], total = total, total + totals[part]

    def run(batches):
        decoder = decoding_table(lengths)
        for batch in batches:
            for part, start, _, _, payload in zip(*(c.to_pylist() for c in batch.columns)):
                doc_ids, counts, ids = read_block(payload, decoder)
                raw, ends = memoryview(ids.astype("<u4")).cast("B"), np.cumsum(counts)
                spans = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == NULL_ID), pa.array(starts[part] + start + ends - counts, pa.int64()), pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(x) for x in spans], pa.int64()), pa.array([bytes(x) for x in spans], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return blocks.mapInArrow(released(run), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")

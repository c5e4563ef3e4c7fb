"""Substring dedup by repeated-phrase automata.

A window is 50 consecutive words of a document. Every window has an anchor: the 8-word phrase
in it with the least hash, the same wherever the window appears; and a key: the hash of the
anchor and 21 words beside it, on the side where the window has them. Keys found in more than
one document say where windows may recur; only those windows are hashed and counted, with the
least doc_id that holds each. In that first document, runs of recurring windows are the
confirmed passages. Passages are dealt to shards by their document; a shard's anchor phrases
are compiled into one Aho-Corasick automaton with pyahocorasick, and of every document that has
some of the shard's keys the stretches around them stream through it. Windows around a hit that
a passage of a smaller doc_id has are covered, after a comparison word by word: hash collisions
remove nothing, and a text of any length or period takes time in proportion to its words.

A shard that many documents need is dealt out again in bounded parts, each with the shard's
passages; a task holds one shard's passages and a slice of the stretches that stream past them.

Defined cases: a null or empty text has no words; texts under 50 words lose none; rows that
share a doc_id are judged each for itself, and none of them is first before another; rows with a
null doc_id neither lose words nor make others lose them; an empty table gives no spans.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitfilter import bits_for, build, known
from .common import materialise, partitions_for, released, text_slices
from .words import PlainWords, mix

WINDOW, PHRASE = 50, 8
_IN_WINDOW = WINDOW - PHRASE + 1
#: Words beside an anchor that join its key; a window has them on one side at least.
_BESIDE = (WINDOW - PHRASE) // 2
#: Characters of passages in one shard, and documents whose stretches meet one copy of it.
SHARD_CHARS, DOCS_PER_PART = 4 << 20, 4096
#: Bits of the id filter ahead of joins with texts, for each id, and at most.
BITS_PER_ID, MAX_BITS = 8, 1 << 27
_BASE = 0x9E3779B97F4A7C15


def _rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every ``n`` words in a row, by doubling."""
    out, at, power = None, 0, h
    size = 1
    places = len(h) - n + 1
    if places <= 0:
        return h[:0]
    while size <= n:
        if n & size:
            part = power[at : at + places] * np.uint64(pow(_BASE, at, 1 << 64))
            out = part if out is None else out + part
            at += size
        if len(power) > size:
            power = power[:-size] + power[size:] * np.uint64(pow(_BASE, size, 1 << 64))
        size *= 2
    return mix(out, n)


def _sliding(op, x: np.ndarray, n: int) -> np.ndarray:
    """``op`` over every ``n`` values in a row."""
    size = 1
    while size * 2 <= n:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


class Windows:
    """Windows and anchors of the texts of a batch, side by side."""

    def __init__(self, texts: pa.Array):
        words = PlainWords(texts)
        self.words, self.first = words.hashes, words.first
        n = len(self.words)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.phrase = _rolling(self.words, PHRASE) | np.uint64(1)  # crossing texts or not: only whole windows count
        if n < WINDOW:
            self.key, self.anchor, self.inside = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
            return
        self.inside = self.doc[: n - WINDOW + 1] == self.doc[WINDOW - 1 :]
        low = np.uint64((1 << (24 if n < 1 << 24 else 32)) - 1)  # places of words; of equal phrases the first one is the anchor
        placed = (self.phrase & ~low) | np.arange(len(self.phrase), dtype=np.uint64)
        self.anchor = (_sliding(np.minimum, placed, _IN_WINDOW) & low).astype(np.int64)
        start, long = np.arange(n - WINDOW + 1), _rolling(self.words, PHRASE + _BESIDE)
        right = self.anchor - start + PHRASE + _BESIDE <= WINDOW
        key = long[np.where(right, self.anchor, self.anchor - _BESIDE)] ^ np.where(right, np.uint64(0), np.uint64(_BASE))
        self.key = np.where(self.inside, key | np.uint64(1), np.uint64(0))

    def anchors(self) -> np.ndarray:
        """Words at which an anchor of some window starts."""
        return np.unique(self.anchor[self.inside])

    def hashes(self) -> np.ndarray:
        return _rolling(self.words, WINDOW)


def _known(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id may be in ``ids``; a filter of bounded size, ahead of an exact join."""
    bits = bits_for(ids.count(), BITS_PER_ID, most=MAX_BITS)
    wanted = docs.sparkSession.sparkContext.broadcast(build(ids.select(F.xxhash64("doc_id").alias("h")), bits)[0])

    @F.pandas_udf("boolean")
    def may_be(h: pd.Series) -> pd.Series:
        return pd.Series(known(wanted.value, h.to_numpy(), bits))

    return docs.filter(may_be(F.xxhash64("doc_id")))


def _anchors(rows: DataFrame) -> DataFrame:
    """(h, doc_id): the keys of each row's windows."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                windows = Windows(part.column("text"))
                at = np.flatnonzero(windows.inside)
                doc, h = windows.doc[at], windows.key[at].view(np.int64)
                if len(at):
                    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))
                    doc, h = doc[new], h[new]
                    order = np.lexsort((h, doc))
                    doc, h = doc[order], h[order]
                    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))
                    doc, h = doc[new], h[new]
                yield pa.RecordBatch.from_arrays([pa.array(h), part.column("doc_id").take(pa.array(doc))], ["h", "doc_id"])

    return rows.mapInArrow(released(run), "h long, doc_id long")


def _candidate_windows(rows: DataFrame) -> DataFrame:
    """(w, low, high) for the windows whose key is in the row's list ``hs``; the least doc_id of each batch alone."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                windows = Windows(part.column("text"))
                if not len(windows.key):
                    continue
                good = np.zeros(len(windows.key), bool)
                lists = part.column("hs")
                for i in range(part.num_rows):
                    span = slice(windows.first[i], min(windows.first[i + 1], len(good)))
                    good[span] = np.isin(windows.key[span].view(np.int64), lists[i].values.to_numpy())
                at = np.flatnonzero(good & windows.inside)
                w, doc = windows.hashes()[at].view(np.int64), part.column("doc_id").to_numpy()[windows.doc[at]]
                order = np.lexsort((doc, w))
                w, doc = w[order], doc[order]
                starts = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1]))) if len(w) else np.zeros(0, np.int64)
                ends = np.append(starts[1:], len(w)) - 1 if len(w) else starts
                yield pa.RecordBatch.from_arrays([pa.array(w[starts]), pa.array(doc[starts]), pa.array(doc[ends])], ["w", "low", "high"])

    return rows.mapInArrow(released(run), "w long, low long, high long")


def _passages(rows: DataFrame) -> DataFrame:
    """(doc_id, passage, hs): runs of the windows in the row's list ``ws``, with their keys."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                windows, out = Windows(part.column("text")), []
                hashes, ids = windows.hashes().view(np.int64), part.column("doc_id").to_pylist()
                for i, text in enumerate(part.column("text").to_pylist()):
                    a, b = int(windows.first[i]), int(windows.first[i + 1])
                    starts = np.flatnonzero(np.isin(hashes[a : max(a, b - WINDOW + 1)], part.column("ws")[i].values.to_numpy()))
                    words = text.encode("utf-8", "surrogatepass").split()
                    for run_ in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                        if len(run_):
                            low, high = int(run_[0]), int(run_[-1])
                            anchors = np.unique(windows.key[a + low : a + high + 1]).view(np.int64).tolist()
                            out.append((ids[i], b" ".join(words[low : high + WINDOW]).decode("utf-8", "surrogatepass"), anchors))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.list_(pa.int64())))], ["doc_id", "passage", "hs"])

    return rows.mapInArrow(released(run), "doc_id long, passage string, hs array<long>")


def _stretches(rows: DataFrame) -> DataFrame:
    """(shard, doc_id, row, start, text): the words around a document's windows whose key a shard has.

    A stretch holds every window whose key the shard has, so the rest of the text need not travel.
    """

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                windows, out = Windows(part.column("text")), []
                ids, own, routes = (part.column(c).to_pylist() for c in ("doc_id", "row", "routes"))
                for i, text in enumerate(part.column("text").to_pylist()):
                    a, n = int(windows.first[i]), int(windows.first[i + 1] - windows.first[i])
                    keys, words = windows.key[a : max(a, a + n - WINDOW + 1)].view(np.int64), text.encode("utf-8", "surrogatepass").split()
                    for route in routes[i]:
                        starts = np.flatnonzero(np.isin(keys, np.array(route["hs"], np.int64)))
                        for run_ in np.split(starts, np.flatnonzero(np.diff(starts) > WINDOW) + 1):
                            if len(run_):
                                low, high = int(run_[0]), int(run_[-1]) + WINDOW
                                out.append((route["shard"], ids[i], own[i], low, b" ".join(words[low:high]).decode("utf-8", "surrogatepass")))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["shard", "doc_id", "row", "start", "text"])

    return rows.mapInArrow(released(run), "shard int, doc_id long, row long, start long, text string")


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def _spaced(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


class Shard:
    """An automaton over the anchor phrases of passages, as octets."""

    def __init__(self, passages: list[tuple[int, str]]):
        import ahocorasick

        self.ids = np.array([p[0] for p in passages], np.int64)
        self.words = [_words(p[1]) for p in passages]
        self.automaton = ahocorasick.Automaton()
        windows = Windows(pa.array([p[1] for p in passages], pa.string()))
        at = windows.anchors()
        for i, start in zip(windows.doc[at].tolist(), (at - windows.first[windows.doc[at]]).tolist()):
            self.automaton.add_word(_spaced(self.words[i][start : start + PHRASE]).decode("latin-1"), True)
        if len(at):
            self.automaton.make_automaton()
        inside = np.flatnonzero(windows.inside)
        hashes = windows.hashes()[inside] if len(inside) else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.keys = hashes[order]
        self.owner = windows.doc[inside][order]
        self.offset = inside[order] - windows.first[self.owner]

    def _located(self, windows: Windows, words: list[list[bytes]]) -> np.ndarray:
        """The words at which an anchor phrase starts, counted over all texts."""
        out = np.zeros(len(windows.words) + 1, np.int64)
        for i, own in enumerate(words):
            octets, spaces = _spaced(own), None
            for end, _ in self.automaton.iter(octets.decode("latin-1")):
                if spaces is None:  # the place of the space before each word
                    spaces = np.flatnonzero(np.frombuffer(octets, np.uint8) == 32)
                out[int(windows.first[i]) + int(np.searchsorted(spaces, end)) - PHRASE] = 1
        return out

    def covered(self, doc_ids: list[int], texts: list[str]) -> list[list[tuple[int, int]]]:
        """Of each text, the spans of words covered by windows that a passage of a smaller doc_id has."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not len(self.keys):
            return out
        windows, words = Windows(pa.array(texts, pa.string())), [_words(x) for x in texts]
        if not len(windows.key):
            return out
        before = np.cumsum(self._located(windows, words))
        at = np.flatnonzero(windows.inside)
        at = at[before[at + _IN_WINDOW - 1] > np.where(at > 0, before[at - 1], 0)]  # windows with a located phrase
        h = windows.hashes()[at]
        place = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        doc = windows.doc[at]
        ok = (self.keys[place] == h) & (self.ids[self.owner[place]] < np.array(doc_ids, np.int64)[doc])
        at, place, doc = at[ok], place[ok], doc[ok]
        owner, offset = self.owner[place], self.offset[place]
        cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner) != 0) | (np.diff(offset) != 1) | (np.diff(doc) != 0)) + 1
        for run in np.split(np.arange(len(at)), cuts) if len(at) else []:
            i, o, n = int(doc[run[0]]), int(owner[run[0]]), len(run) + WINDOW - 1
            low, start = int(at[run[0]] - windows.first[i]), int(offset[run[0]])
            if words[i][low : low + n] == self.words[o][start : start + n]:
                out[i].append((low, low + n))
            else:
                out[i] += [x for k in run.tolist() if (x := self._exact(int(place[k]), words[i], int(at[k] - windows.first[i]), doc_ids[i]))]
        return [merged(x) for x in out]

    def _exact(self, place: int, words: list[bytes], low: int, doc_id: int) -> tuple[int, int] | None:
        """The window at ``low`` if any passage with its hash has its words."""
        key = self.keys[place]
        while place < len(self.keys) and self.keys[place] == key:
            o, start = int(self.owner[place]), int(self.offset[place])
            if self.ids[o] < doc_id and words[low : low + WINDOW] == self.words[o][start : start + WINDOW]:
                return low, low + WINDOW
            place += 1
        return None


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, text); ``row`` tells rows that share a doc_id apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    return rows.filter("doc_id is not null and text is not null")


def _cover(batches):
    """Streams rows of (shard, part, doc_id, row, start, text) in this order; a part's passages have a null row and come first."""
    current, passages, shard = None, [], None
    for batch in batches:
        for part in text_slices(batch, "text"):
            keys, rows = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist())), part.column(3).to_pylist()
            ids, starts, texts = (part.column(c).to_pylist() for c in (2, 4, 5))
            at = 0
            while at < len(keys):
                if keys[at] != current:
                    current, passages, shard = keys[at], [], None
                if rows[at] is None:
                    passages.append((ids[at], texts[at]))
                    at += 1
                    continue
                end = at
                while end < len(keys) and keys[end] == current and rows[end] is not None:
                    end += 1
                if shard is None:
                    shard, passages = Shard(passages), []
                found = [(ids[i], rows[i], [{"a": starts[i] + a, "b": starts[i] + b} for a, b in spans]) for i, spans in zip(range(at, end), shard.covered(ids[at:end], texts[at:end])) if spans]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), _SPANS))], ["doc_id", "row", "spans"])
                at = end


_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, spans): the words [a, b) of each document that loses any, counted from 0; row is the text's xxhash64."""
    rows = _rows(docs, id_col, text_col)
    anchors = materialise(_anchors(rows.select("doc_id", "text")), "phrases-anchors")
    recurring = anchors.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("h")
    hits = materialise(anchors.join(recurring, "h", "left_semi"), "phrases-hits")
    lists = hits.groupBy("doc_id").agg(F.collect_set("h").alias("hs"))  # as long as a document at most
    found = _candidate_windows(_known(rows, hits.select("doc_id").distinct()).join(lists, "doc_id"))
    firsts = found.groupBy("w").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high")
    owners = materialise(firsts.groupBy(F.col("low").alias("doc_id")).agg(F.collect_list("w").alias("ws")), "phrases-windows")
    passages = materialise(_passages(_known(rows, owners.select("doc_id")).join(owners, "doc_id")), "phrases-passages")
    chars = passages.agg(F.coalesce(F.sum(F.length("passage")), F.lit(0))).first()[0]
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-chars // SHARD_CHARS)))).cast("int")
    seeds = passages.select(shard.alias("shard"), F.explode("hs").alias("h")).distinct()
    routes = materialise(hits.join(seeds, "h").select("doc_id", "shard", "h").distinct(), "phrases-routes")
    parts = routes.select("doc_id", "shard").distinct().groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / DOCS_PER_PART).cast("int").alias("parts"))
    parts = materialise(parts, "phrases-parts")
    wanted = routes.groupBy("doc_id", "shard").agg(F.collect_list("h").alias("hs")).groupBy("doc_id").agg(F.collect_list(F.struct("shard", "hs")).alias("routes"))
    texts = _stretches(_known(rows, routes.select("doc_id").distinct()).join(wanted, "doc_id")).join(parts, "shard")
    texts = texts.withColumn("part", F.pmod(F.xxhash64("doc_id", "shard"), F.col("parts")).cast("int"))
    copies = passages.select("doc_id", F.col("passage").alias("text"), shard.alias("shard")).join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    copies = copies.withColumns({"row": F.lit(None).cast("long"), "start": F.lit(0).cast("long")})
    columns = ["shard", "part", "doc_id", "row", "start", "text"]
    both = copies.select(columns).unionByName(texts.select(columns))
    ordered = both.repartition(partitions_for(docs.sparkSession), "shard", "part").sortWithinPartitions("shard", "part", F.col("row").isNotNull(), "doc_id")
    spans = materialise(ordered.mapInArrow(released(_cover), "doc_id long, row long, spans array<struct<a:bigint,b:bigint>>"), "phrases-spans")
    return spans.groupBy("doc_id", "row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def kept_texts(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_removed, kept) for the documents in ``spans``: their words that stay, joined by one space."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                removed, kept = [], []
                for text, out in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    words, at, stay = _words(text), 0, []
                    for a, b in merged([(s["a"], s["b"]) for s in out]):
                        stay += words[at:a]
                        at = b
                    stay += words[at:]
                    removed.append(len(words) - len(stay))
                    kept.append(b" ".join(stay).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "row", "n_removed", "kept"])

    rows = _known(_rows(docs, id_col, text_col), spans.select("doc_id")).join(spans, ["doc_id", "row"])
    return rows.dropDuplicates(["doc_id", "row"]).mapInArrow(released(run), "doc_id long, row long, n_removed long, kept string")


def whole_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_words, sha256) of each row's words joined by one space."""
    import hashlib

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = [_words(x or "") for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(w) for w in words], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())],
                    ["doc_id", "row", "n_words", "sha256"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(released(run), "doc_id long, row long, n_words long, sha256 string")

"""Language identification by a linear-chain conditional random field over words.

Every word of a text is a node; its emission is a sum of hashed features: byte n-grams with
word boundaries (affixes among them) and the word itself (the lexicon). Transitions between
the languages of neighbouring words are learned with them, from chains spliced together from
spans of documents of different languages. Forward-backward over the whole text gives each
word's marginals, and the language with the largest share of them is the text's.

Inference treats all words of a batch as one chain that forgets the past where a text starts,
cut into blocks: products of transfer matrices over all blocks at once, a short pass from
block to block, then forward and backward vectors inside all blocks at once. The result is
exact whatever a text's length.

Defined cases: ``und`` and score 0 for null texts, texts without a letter, and everything if no
labelled row exists; ties go to the language that sorts first; repeated rows get equal rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, text_slices
from .words import LetterWords

UNKNOWN = "und"
NGRAMS = (1, 2, 3, 4)
FEATURE_BITS = 17
BLOCK = 64
#: The bounded sample of labelled rows that training sees.
DOCS_PER_LANGUAGE = 400
SPANS_PER_DOC = 6
WORDS_PER_SPAN = 20
#: Training chains: spans in each, and how often the next span changes the language.
SPANS_PER_CHAIN, SWITCH = 4, 0.3


@dataclass
class ChainModel:
    languages: list[str]
    weights: np.ndarray  # features x languages
    trans: np.ndarray  # from, to


def _features(words: LetterWords) -> tuple[np.ndarray, np.ndarray]:
    """(feature, distinct word) pairs, sorted by word."""
    parts = [words.ngrams(n) for n in NGRAMS] + [(words.whole(), np.arange(len(words)))]
    feature = np.concatenate([p[0] for p in parts]) & np.uint64((1 << FEATURE_BITS) - 1)
    word = np.concatenate([p[1] for p in parts])
    order = np.argsort(word, kind="stable")
    return feature[order].astype(np.int64), word[order]


def emissions(words: LetterWords, weights: np.ndarray) -> np.ndarray:
    """One row of scores for each distinct word."""
    if not len(words):
        return np.zeros((0, weights.shape[1]))
    feature, word = _features(words)
    starts = np.searchsorted(word, np.arange(len(words)))
    return np.add.reduceat(weights[feature], starts, axis=0)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(emit: np.ndarray, trans: np.ndarray, first: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Each word's distribution over languages; ``first`` marks the words that start a text."""
    n, k = emit.shape
    if n == 0:
        return np.zeros((0, k))
    nb = -(-n // block)
    psi = np.ones((nb * block, k))
    psi[:n] = np.exp(emit - emit.max(axis=1, keepdims=True))
    reset = np.ones(nb * block, bool)  # what fills the last block up says nothing about the words before it
    reset[:n] = first
    psi, reset, move = psi.reshape(nb, block, k), reset.reshape(nb, block), np.exp(trans - trans.max())
    forget = np.ones((k, k))
    product = np.broadcast_to(np.eye(k), (nb, k, k))
    for t in range(block):
        step = np.where(reset[:, t, None, None], forget, move) * psi[:, t, None, :]
        product = np.matmul(product, step)
        product = product / product.sum(axis=(1, 2), keepdims=True)
    ahead, behind = np.ones((nb + 1, k)) / k, np.ones((nb + 1, k)) / k
    for b in range(nb):
        v = ahead[b] @ product[b]
        ahead[b + 1] = v / v.sum()
    for b in range(nb - 1, -1, -1):
        v = product[b] @ behind[b + 1]
        behind[b] = v / v.sum()
    alpha, v = np.empty_like(psi), ahead[:-1]
    for t in range(block):
        v = _scaled(np.where(reset[:, t, None], 1.0, v @ move) * psi[:, t])
        alpha[:, t] = v
    v = behind[1:]
    for t in range(block - 1, -1, -1):
        alpha[:, t] = _scaled(alpha[:, t] * v)
        v = psi[:, t] * v
        v = _scaled(np.where(reset[:, t, None], v.sum(axis=1, keepdims=True), v @ move.T))
    return alpha.reshape(-1, k)[:n]


def _pairs(emit: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals and summed pair marginals of a padded batch of chains."""
    b, t_max, k = emit.shape
    psi, move = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(trans)
    alive = np.arange(t_max) < lengths[:, None]
    psi = np.where(alive[:, :, None], psi, 1.0)
    alpha, beta = np.empty_like(psi), np.ones_like(psi)
    alpha[:, 0] = _scaled(psi[:, 0])
    for t in range(1, t_max):
        alpha[:, t] = _scaled((alpha[:, t - 1] @ move) * psi[:, t])
    for t in range(t_max - 2, -1, -1):
        beta[:, t] = np.where(alive[:, t + 1, None], _scaled((psi[:, t + 1] * beta[:, t + 1]) @ move.T), 1.0)
    both = np.zeros((k, k))
    for t in range(t_max - 1):
        joint = alpha[:, t, :, None] * move * (psi[:, t + 1] * beta[:, t + 1])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        both += joint[alive[:, t + 1]].sum(axis=0)
    return _scaled(alpha * beta), both


def fit(spans: list[tuple[str, str]], seed: int = 7, epochs: int = 6, chains_per_step: int = 128, rate: float = 0.1) -> ChainModel | None:
    """Maximum likelihood by Adagrad over chains spliced from (language, words) spans."""
    languages = sorted({lang for lang, _ in spans})
    if not languages:
        return None
    spans = sorted(spans)
    rng, k = np.random.default_rng(seed), len(languages)
    words = LetterWords(pa.array([text for _, text in spans]))
    of = np.array([languages.index(lang) for lang, _ in spans])
    feature, owner = _features(words)
    starts = np.append(np.searchsorted(owner, np.arange(len(words))), len(owner))
    weights, trans = np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k))
    seen_w, seen_t = np.full(weights.shape, 1e-6), np.full((k, k), 1e-6)
    by_lang = [np.flatnonzero(of == i) for i in range(k)]
    total = max(1, len(spans) // SPANS_PER_CHAIN)
    for _ in range(epochs * -(-total // chains_per_step)):
        tokens, labels = [], []
        for _ in range(chains_per_step):
            lang, at, lab = int(rng.integers(k)), [], []
            for _ in range(SPANS_PER_CHAIN):
                if k > 1 and rng.random() < SWITCH:
                    lang = int((lang + rng.integers(1, k)) % k)
                span = int(rng.choice(by_lang[lang]))
                piece = words.at[words.first[span] : words.first[span + 1]]
                piece = piece[int(rng.integers(max(1, len(piece) // 2))) :]
                at.append(piece)
                lab.append(np.full(len(piece), lang))
            tokens.append(np.concatenate(at))
            labels.append(np.concatenate(lab))
        lengths = np.array([len(x) for x in tokens])
        keep = lengths > 0
        tokens, labels, lengths = [x for x in tokens if len(x)], [x for x in labels if len(x)], lengths[keep]
        if not len(lengths):
            continue
        used, local = np.unique(np.concatenate(tokens), return_inverse=True)
        picked = np.concatenate([np.arange(starts[u], starts[u + 1]) for u in used])
        sizes = starts[used + 1] - starts[used]
        f, w = feature[picked], np.repeat(np.arange(len(used)), sizes)
        score = np.add.reduceat(weights[f], np.cumsum(sizes) - sizes, axis=0)
        alive = np.arange(lengths.max()) < lengths[:, None]
        emit = np.zeros((len(lengths), int(lengths.max()), k))
        emit[alive] = score[local]
        marg, both = _pairs(emit, trans, lengths)
        truth = np.concatenate(labels)
        grad = -marg[alive]
        grad[np.arange(len(truth)), truth] += 1
        inside = np.concatenate([np.arange(n) > 0 for n in lengths])
        gold = np.zeros((k, k))
        np.add.at(gold, (truth[np.flatnonzero(inside) - 1], truth[inside]), 1)
        per_word = np.stack([np.bincount(local, grad[:, j], len(used)) for j in range(k)], axis=1)
        per_feature = np.stack([np.bincount(f, per_word[w, j], 1 << FEATURE_BITS) for j in range(k)], axis=1)
        per_feature /= len(lengths)
        seen_w += per_feature**2
        weights += rate * per_feature / np.sqrt(seen_w)
        g = (gold - both) / len(lengths)
        seen_t += g**2
        trans += rate * g / np.sqrt(seen_t)
    return ChainModel(languages, weights.astype(np.float32), trans)


def training_spans(docs: DataFrame, text_col: str, lang_col: str, id_col: str, docs_per_language: int = DOCS_PER_LANGUAGE) -> list[tuple[str, str]]:
    """Spans of words from a bounded, hash-chosen sample of the labelled rows, spread over their whole texts."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(F.col(lang_col).alias("lang")).count().orderBy("lang").collect()  # a row for each language
    if not counts:
        return []
    lots = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(11)), F.lit(1 << 30))
    share = F.coalesce(*(F.when(F.col(lang_col) == c["lang"], F.lit(int(min(1.0, docs_per_language / c["count"]) * (1 << 30)))) for c in counts))

    def run(batches):
        for batch in batches:
            langs, spans = [], []
            for lang, text, lot in zip(*(c.to_pylist() for c in batch.columns)):
                words, rng = text.split(), np.random.default_rng(lot)
                for _ in range(SPANS_PER_DOC if words else 0):
                    at = int(rng.integers(max(1, len(words) - WORDS_PER_SPAN + 1)))
                    langs.append(lang)
                    spans.append(" ".join(words[at : at + WORDS_PER_SPAN])[: 40 * WORDS_PER_SPAN])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(spans, pa.string())], ["lang", "span"])

    chosen = rows.filter(lots < share).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), lots.alias("lot"))
    return [(r[0], r[1]) for r in chosen.mapInArrow(released(run), "lang string, span string").collect()]


def identify(docs: DataFrame, model: ChainModel | None, id_col: str = "doc_id", text_col: str = "text", with_runs: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches) per row; ``with_runs`` adds the runs of words of one language."""
    schema = "doc_id long, lang_pred string, score double, n_words long, n_switches long"
    if with_runs:
        schema += ", runs array<struct<lang:string,words:bigint>>"

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = LetterWords(part.column(1))
                n = np.diff(words.first)
                rows = len(n)
                langs, score, switches, runs = [UNKNOWN] * rows, np.zeros(rows), np.zeros(rows, np.int64), [[] for _ in range(rows)]
                has = np.flatnonzero(n)
                if model is not None and len(has):
                    starts = words.first[has]
                    first = np.zeros(len(words.at), bool)
                    first[starts] = True
                    marg = marginals(emissions(words, model.weights)[words.at], model.trans, first)
                    share = np.add.reduceat(marg, starts, axis=0) / n[has, None]
                    best = share.argmax(axis=1)
                    score[has] = np.clip(share[np.arange(len(has)), best], 0, 1)
                    label = marg.argmax(axis=1)
                    turn = np.concatenate(([True], label[1:] != label[:-1]))
                    switches[has] = np.add.reduceat((turn & ~first).astype(np.int64), starts)
                    for row, b in zip(has.tolist(), best.tolist()):
                        langs[row] = model.languages[b]
                    if with_runs:
                        cuts = np.flatnonzero(turn | first)
                        owner = np.repeat(np.arange(rows), n)[cuts]
                        for row, lang, size in zip(owner.tolist(), label[cuts].tolist(), np.diff(np.append(cuts, len(label))).tolist()):
                            runs[row].append({"lang": model.languages[lang], "words": size})
                columns = [part.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(n, pa.int64()), pa.array(switches)]
                names = ["doc_id", "lang_pred", "score", "n_words", "n_switches"]
                if with_runs:
                    columns, names = [*columns, pa.array(runs, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())])))], [*names, "runs"]
                yield pa.RecordBatch.from_arrays(columns, names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(released(run), schema)


def identified(docs: DataFrame, model: ChainModel | None, min_share: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is told with at least ``min_share`` of the words, all columns unchanged."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                words = LetterWords(part.column(text_col))
                n, good = np.diff(words.first), np.zeros(part.num_rows, bool)
                has = np.flatnonzero(n)
                if model is not None and len(has):
                    first = np.zeros(len(words.at), bool)
                    first[words.first[has]] = True
                    marg = marginals(emissions(words, model.weights)[words.at], model.trans, first)
                    share = np.add.reduceat(marg, words.first[has], axis=0) / n[has, None]
                    good[has] = share.max(axis=1) >= min_share
                yield part.filter(pa.array(good))

    return docs.mapInArrow(released(run), docs.schema)

"""The two best candidates of each surface, scored only where a bound says it may matter.

Candidates of a surface come one after the other. A stretch of them gets upper bounds at once, from
lengths and bags of letters; in the order of these bounds each is scored until the bound falls below the
second best score so far. A score itself is given up as soon as what is left of it cannot reach
that: sorted tokens first, then the longest common subsequence, which bounds every window of a
partial match. Scores of what is kept are exact, so winners and gaps are those of scoring everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..config import SETTINGS
from ..functions.similarity import lcs_length, partial_ratio, ratio, token_set_ratio

#: Candidates of a surface that are bounded at once.
AT_ONCE = 4096
#: Letters are counted by their code's last bits: letters that share them can only raise a bound.
BAGS = 64
_SLACK = 1e-9


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letters by bag, length) of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4") % BAGS
    cells = np.repeat(np.arange(len(texts)), sizes) * BAGS + codes
    return np.bincount(cells, minlength=len(texts) * BAGS).reshape(-1, BAGS), sizes


def _indel_bound(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)


class FuzzyScorer:
    """The score of the fuzzy stage: sorted tokens and the best window, weighted."""

    runner_up = True
    sort, part = SETTINGS.fuzzy_sort_weight, SETTINGS.fuzzy_partial_weight

    def bounds(self, size: int, sizes: np.ndarray, common: np.ndarray) -> np.ndarray:
        short = np.minimum(size, sizes)
        window = np.where(short + common > 0, 200.0 * common / np.maximum(short + common, 1), 100.0)
        return self.sort * _indel_bound(common, size + sizes) + self.part * window

    def score(self, a: str, b: str, tokens: str, least: float) -> float | None:
        """The score, or nothing if it is below ``least``; ``tokens`` are those of ``a``, sorted."""
        sort = self.sort * ratio(tokens, " ".join(sorted(b.split())))
        if not a or not b:
            window = partial_ratio(a, b)
        elif a in b or b in a:
            window = 100.0
        else:
            short, most = min(len(a), len(b)), lcs_length(a, b)  # no window has a longer one
            if sort + self.part * 200.0 * most / (short + most) < least - _SLACK:
                return None
            window = partial_ratio(a, b)
        return sort + self.part * window


class CanonicalScorer:
    """The score of the canonical stage: the best of three ratios; titles that are equal come first whatever they score. Its runner-up's score is not asked for."""

    runner_up = False

    def bounds(self, size: int, sizes: np.ndarray, common: np.ndarray) -> np.ndarray:
        return np.where((sizes == size) & (common == size), np.inf, 100.0)  # equal ones come first; common tokens alone may give 100

    def score(self, a: str, b: str, tokens: str, least: float) -> float | None:
        if a == b:
            return np.inf  # ahead of any other score
        best = token_set_ratio(a, b)
        if best >= 100.0:
            return best
        return max(best, ratio(tokens, " ".join(sorted(b.split()))), ratio(a, b))


def _best_two(a: str, names: list[str], keys: list[str], found: list, scorer) -> list:
    """``found`` ((-score, key, place), the two best) after some more candidates."""
    held, sizes = _bags([a, *names])
    common = np.minimum(held[0], held[1:]).sum(axis=1)
    bounds = scorer.bounds(len(a), sizes[1:], common)
    tokens = " ".join(sorted(a.split()))
    for i in np.argsort(-bounds, kind="stable").tolist():
        least = -found[scorer.runner_up][0] if len(found) > scorer.runner_up else -np.inf
        if bounds[i] < least - _SLACK:
            break
        score = scorer.score(a, names[i], tokens, least)
        if score is not None:
            found = sorted([*found, (-score, keys[i], i)], key=lambda x: x[:2])[:2]
    return found


def best_two(candidates: DataFrame, scorer: FuzzyScorer | CanonicalScorer) -> DataFrame:
    """(surface, norm, ol_key, title, norm_title, score, second, n): each surface's best candidate, equal scores by key.

    ``candidates`` has surface, norm, ol_key, title and norm_title, each pair once; ``second`` is the score
    of the runner-up, 0 if there is none (for a scorer that does not ask for it, of any other candidate), ``n`` the number of candidates. A null norm or norm_title is no candidate. Of the canonical scorer's an infinite score says that
    the normalised titles are equal.
    """
    fields = ["surface", "norm", "ol_key", "title", "norm_title"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best, n, out = None, [], 0, []

        def close():
            if n:
                (score, *_), row = best[0][0], best[0][1]
                out.append((*row, -score, -best[1][0][0] if len(best) > 1 else 0.0, n))

        def flush():
            columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.string()] * 5 + [pa.float64()] * 2 + [pa.int64()])]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, [*fields, "score", "second", "n"])

        for batch in batches:
            rows = list(zip(*(batch.column(f).to_pylist() for f in fields)))
            start = 0
            while start < len(rows):
                stop = start
                while stop < len(rows) and rows[stop][0] == rows[start][0] and stop - start < AT_ONCE:
                    stop += 1
                if rows[start][0] != own:
                    close()
                    own, best, n = rows[start][0], [], 0
                part = rows[start:stop]
                carried = [((s, k, -1 - i), row) for i, ((s, k, _), row) in enumerate(best)]
                known = {x[0][2]: x[1] for x in carried}
                found = _best_two(part[0][1], [r[4] for r in part], [r[2] for r in part], [x[0] for x in carried], scorer)
                best = [(f, known[f[2]] if f[2] < 0 else part[f[2]]) for f in found]
                n, start = n + len(part), stop
            if len(out) > AT_ONCE:
                yield flush()
        close()
        if out:
            yield flush()

    held = candidates.select(fields).filter("norm IS NOT NULL AND norm_title IS NOT NULL").repartition("surface").sortWithinPartitions("surface")
    return held.mapInArrow(run, "surface string, norm string, ol_key string, title string, norm_title string, score double, second double, n bigint")

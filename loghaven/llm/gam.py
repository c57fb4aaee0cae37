"""Quality classifier: a generalised additive model with pairwise interactions.

Each statistic of a text is cut into bins and has a table of one number per bin; chosen pairs
have a table over both. Shallow trees over the bins, grown on the gradient in turns, are added
to the tables. A score is the sum of the numbers looked up, through a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.common import id_remainder
from loghaven.llm.text_stats import SHARES, with_text_stats

HELD_OUT_MODULUS = 5
THRESHOLD = 0.3
#: Labelled rows that the fit reads: all up to so many, else that many on average, those whose
#: hashed id is lowest.
MAX_ROWS = 40_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 6
RATE, SMOOTH = 0.15, 5.0
PREFIX = "__stat_"


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.zeros(0)


def _leaf(g: float, h: float) -> float:
    return g / (h + SMOOTH)


def _stump(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; 0 for none."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    gain = cg**2 / (ch + SMOOTH) + (cg[-1] - cg) ** 2 / (ch[-1] - ch + SMOOTH) - cg[-1] ** 2 / (ch[-1] + SMOOTH)
    at = int(np.argmax(gain[:-1])) if len(gain) > 1 else 0
    return (float(gain[at]), at + 1) if len(gain) > 1 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, cuts: int = 2) -> np.ndarray:
    """Steps of a shallow tree over the bins: the best cuts one after the other."""
    parts = [(0, len(g))]
    for _ in range(cuts):
        options = [(*_stump(g[a:b], h[a:b]), a, b) for a, b in parts if b - a > 1]
        if not options or (best := max(options))[0] <= 0:
            break
        _, at, a, b = best
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree of depth two over a grid: a cut of one side, then of the other
    on each half."""
    best, out = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(gg)):
            gain, step = -gg.sum() ** 2 / (hh.sum() + SMOOTH), np.zeros_like(gg)
            for a, b in ((0, cut), (cut, len(gg))):
                rg, rh = gg[a:b].sum(axis=0), hh[a:b].sum(axis=0)
                part, at = _stump(rg, rh)
                gain += part + rg.sum() ** 2 / (rh.sum() + SMOOTH)
                for c, d in ((0, at), (at, len(rg))):
                    step[a:b, c:d] = _leaf(rg[c:d].sum(), rh[c:d].sum())
            if gain > best:
                best, out = gain, step.T if turned else step
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """The model of rows of statistics and labels 0 or 1, as plain arrays.

    The intercept is the smoothed log odds, so labels of one kind, or none, give a constant.
    """
    p = (y.sum() + 1) / (len(y) + 2)
    n = x.shape[1]
    model = {"intercept": float(np.log(p / (1 - p))), "edges": [_edges(x[:, j], BINS) for j in range(n)], "pairs": []}
    model["pair_edges"] = [_edges(x[:, j], PAIR_BINS) for j in range(n)]
    model["tables"] = [np.zeros(len(e) + 1) for e in model["edges"]]
    if len(np.unique(y)) < 2:
        return model
    code = [np.searchsorted(model["edges"][j], x[:, j]) for j in range(n)]
    total = np.full(len(y), model["intercept"])

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-total))
        return y - q, q * (1 - q)

    for _ in range(ROUNDS):
        for j in range(n):
            g, h = gradient()
            size = len(model["tables"][j])
            step = RATE * _tree(np.bincount(code[j], g, size), np.bincount(code[j], h, size))
            model["tables"][j] += step
            total += step[code[j]]
    coarse = [np.searchsorted(model["pair_edges"][j], x[:, j]) for j in range(n)]
    size = [len(e) + 1 for e in model["pair_edges"]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        cell = coarse[i] * size[j] + coarse[j]
        return tuple(np.bincount(cell, v, size[i] * size[j]).reshape(size[i], size[j]) for v in gradient())

    ranked = sorted(((_pair_tree(*grid(i, j))[0], i, j) for i, j in combinations(range(n), 2)), reverse=True)
    chosen = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    tables = [np.zeros((size[i], size[j])) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for (i, j), own in zip(chosen, tables, strict=True):
            step = RATE * _pair_tree(*grid(i, j))[1]
            own += step
            total += step[coarse[i], coarse[j]]
    model["pairs"] = [(i, j, t) for (i, j), t in zip(chosen, tables, strict=True)]
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores by additions of looked-up numbers."""
    total = np.full(len(x), model["intercept"])
    for j, (edges, own) in enumerate(zip(model["edges"], model["tables"], strict=True)):
        total += own[np.searchsorted(edges, x[:, j])]
    for i, j, own in model["pairs"]:
        total += own[np.searchsorted(model["pair_edges"][i], x[:, i]), np.searchsorted(model["pair_edges"][j], x[:, j])]
    return 1 / (1 + np.exp(-total))


def scored(model: dict, stats: list[Column]) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(predict(model, np.column_stack([c.to_numpy(np.float64) for c in columns])))

    return score(*stats)


def learn(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    """A model from rows with doc_id and the statistics under ``PREFIX``, without those held out.

    Rows equal in id and statistics count once. About ``max_rows`` distinct labelled rows are read,
    those whose hash is below the share that yields so many, so the fit has the same bound at every
    size, also if one id is on most rows, and nothing is sorted for it.
    """
    rows = stats.where(F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) != 0)).select(
        F.col("doc_id").alias("key"), *[F.col(PREFIX + s).alias(s) for s in SHARES]
    )
    labelled = stored(rows.join(labels.select(F.col("doc_id").alias("key"), "label"), "key").distinct(), "model-labelled")
    share = min(1.0, max_rows / max(1, labelled.count()))
    place = F.pmod(F.xxhash64(F.lit(11), "key", *SHARES), F.lit(1 << 40))
    sample = labelled.where(place < int(share * (1 << 40))).toPandas().sort_values(["key", "label", *SHARES])
    return fit(sample[list(SHARES)].to_numpy(np.float64).reshape(-1, len(SHARES)), sample["label"].to_numpy(np.float64))


def classified(stats: DataFrame, model: dict) -> DataFrame:
    """Rows with held_out, score, predicted in place of their statistics."""
    kept = [c for c in stats.columns if not c.startswith(PREFIX) and c not in ("held_out", "score", "predicted")]
    rows = stats.select(*kept, *[PREFIX + s for s in SHARES])
    return rows.select(
        *kept,
        (id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == 0).alias("held_out"),
        scored(model, [F.col(PREFIX + s) for s in SHARES]).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def with_stats(docs: DataFrame) -> DataFrame:
    """Documents with the statistics that ``learn`` and ``classified`` read."""
    return with_text_stats(docs, prefix=PREFIX)


def quality_model(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Documents with held_out, score, predicted.

    Needs doc_id and text; all other columns stay, those of the new names are replaced.
    ``labels`` has doc_id and label, see ``one_label``. Null and empty texts count as texts
    without words and get a score as all others do; rows with a null id are scored, never learned
    from. Repeated rows are scored alike, an empty table gives no rows. Without labels every
    score is one half. The statistics are written for the fit, without the texts, and made
    again for the scores.
    """
    narrow = stored(with_stats(docs.select("doc_id", "text")).drop("text"), "model-stats")
    return classified(with_stats(docs), learn(narrow, labels, max_rows))

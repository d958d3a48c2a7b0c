"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees, each on a random part of the training rows and features and on the gradient that the
trees before it leave, are taken apart: every path from a root becomes a conjunction of thresholds.
An L1-penalised logistic regression weighs the rules and keeps few. The rest are compiled into one
Spark column expression over the statistics, so that scoring runs inside the executors' JVM.

Only the statistics of at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash of their
id, reach the driver; statistics are computed and scores given for all rows.

Defined results: NULL and empty texts have statistics of zero and a score like any text; NULL labels
are not learnt from; rows that repeat an id count as often as they occur; without labels of both
classes every score is the share of the class that there is, 0.5 without labels. An empty table
gives no rows. Languages, sources and ids are no statistics; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.perplexity import base_signals
from jobsluice.llm.shared import stored
from jobsluice.llm.words import (
    Texts,
    range_hashes,
    slices,
    sums,
    unique_per_doc,
    words_of,
)

#: Labelled rows whose statistics are fitted.
TRAIN_ROWS = 8_000
TREES = 40
DEPTH = 3
LEAF_ROWS = 20
CUTS = 24
PENALTY = 0.002
SEED = 20_260

STATISTICS = (
    "n_words",
    "n_bytes",
    "word_bytes",
    "distinct_words",
    "repeat_words",
    "dup_lines",
    "line_words",
    "symbols",
    "upper",
    "digits",
    "stops",
    "marks",
    "single_bytes",
    "beyond_ascii",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _DIGIT = _class(bytes(range(65, 91))), _class(b"0123456789")
_STOP, _MARK, _HIGH = _class(b".,;:"), _class(b"!?|~=_@"), _class(bytes(range(128, 256)))


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    """The statistics of every text of a slice; shares are of bytes, words or lines."""
    base, words = base_signals(texts), words_of(texts)
    n, size = base["n_words"], np.maximum(texts.sizes, 1)
    some = np.maximum(n, 1)
    lines = sums(texts.data == 10, texts.offsets) + 1
    lengths = words.ends - words.starts
    _, first = unique_per_doc(words.doc, range_hashes(texts.data, words.starts, words.ends), len(texts))
    share = lambda chars: sums(chars[texts.data], texts.offsets) / size
    found = (
        n,
        texts.sizes,
        sums(lengths, words.first) / some,
        np.diff(first) / some,
        base["n_repeat_words"] / some,
        base["n_dup_lines"] / lines,
        n / lines,
        base["n_symbols"] / some,
        share(_UPPER),
        share(_DIGIT),
        share(_STOP),
        share(_MARK),
        sums(lengths == 1, words.first) / some,
        share(_HIGH),
    )
    return {name: np.asarray(v, np.float64) for name, v in zip(STATISTICS, found, strict=True)}


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row of ``docs``."""

    def measure(batches):
        for rows, texts in slices(batches):
            found = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *[pa.array(v) for v in found.values()]], ["doc_id", *found]
            )

    kind = dict(docs.dtypes)["doc_id"]
    fields = ", ".join(f"{name} double" for name in STATISTICS)
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, {fields}")


#: A condition: the statistic's index, whether it must exceed the threshold, and the threshold.
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions and the intercept of a logistic model."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            hit = None
            for k, above, cut in conditions:
                value = F.col(STATISTICS[k])
                one = value > F.lit(cut) if above else value <= F.lit(cut)
                hit = one if hit is None else hit & one
            total = total + F.when(hit, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _hits(x: np.ndarray, conditions: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, cut in conditions:
        out &= (x[:, k] > cut) == above
    return out


def _grow(x, gradient, rows, features, cuts, path, out, depth) -> list[tuple[np.ndarray, float]]:
    """Split ``rows`` where the squared sum of the gradient gains most; returns leaves, adds paths to ``out``."""
    best = None
    g = gradient[rows]
    for k in features if depth else ():
        below = x[rows, k][:, None] <= cuts[k][None, :]
        n = below.sum(axis=0)
        ok = (n >= LEAF_ROWS) & (len(rows) - n >= LEAF_ROWS)
        if ok.any():
            left = g @ below
            gain = np.where(ok, left**2 / np.maximum(n, 1) + (g.sum() - left) ** 2 / np.maximum(len(rows) - n, 1), -1)
            at = int(gain.argmax())
            if best is None or gain[at] > best[0]:
                best = (gain[at], k, cuts[k][at])
    if best is None or best[0] <= g.sum() ** 2 / len(rows) + 1e-9:
        return [(rows, float(g.mean()))]
    _, k, cut = best
    low = x[rows, k] <= cut
    leaves = []
    for part, above in ((rows[low], False), (rows[~low], True)):
        deeper = (*path, (int(k), above, float(cut)))
        out.append(deeper)
        leaves += _grow(x, gradient, part, features, cuts, deeper, out, depth - 1)
    return leaves


def _paths(x: np.ndarray, y: np.ndarray) -> list[tuple[Condition, ...]]:
    """The conjunctions of all paths of an ensemble of small trees."""
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, CUTS))) for k in range(x.shape[1])]
    margin = np.zeros(len(y))
    out: list[tuple[Condition, ...]] = []
    part = max(1, min(len(y), max(len(y) // 2, 2 * LEAF_ROWS)))
    for _ in range(TREES):
        gradient = y - 1 / (1 + np.exp(-margin))
        rows = rng.choice(len(y), part, replace=False)
        features = rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False)
        found: list[tuple[Condition, ...]] = []
        _grow(x, gradient, rows, features, cuts, (), found, DEPTH)
        leaves = [p for p in found if not any(q[: len(p)] == p and len(q) > len(p) for q in found)]
        for p in leaves:
            hit = _hits(x, p)
            own = gradient[rows][hit[rows]]
            if len(own):
                margin[hit] += 0.5 * 4 * own.mean()
        out += found
    return list(dict.fromkeys(out))


def _lasso(hits: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all weights but the intercept, by accelerated proximal steps."""
    n, m = hits.shape
    x = hits.astype(np.float32)
    vector = np.ones(m, np.float32) / np.sqrt(max(m, 1))
    for _ in range(20):
        vector = x.T @ (x @ vector)
        vector /= max(np.linalg.norm(vector), 1e-12)
    rate = 4 * n / (float(np.linalg.norm(x @ vector)) ** 2 + n + 1e-9)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    b, w = float(np.log(share / (1 - share))), np.zeros(m, np.float32)
    b_at, w_at, t = b, w.copy(), 1.0
    for _ in range(steps):
        off = (1 / (1 + np.exp(-(x @ w_at + b_at))) - y).astype(np.float32) / n
        b_new = b_at - rate * float(off.sum())
        w_new = w_at - rate * (x.T @ off)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - rate * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_at, b_at = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        b, w, t = b_new, w_new, t_new
    return b, w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Rules:
    """Rules from statistics, a column each in the order of ``STATISTICS``, and labels 0 and 1."""
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return Rules(float(np.log(share / (1 - share))), ())
    paths = _paths(x, y)
    if not paths:
        return Rules(float(np.log(y.mean() / (1 - y.mean()))), ())
    hits = np.stack([_hits(x, p) for p in paths], axis=1)
    # Rules that hold for the same rows say the same; the first, shorter one stays.
    _, first = np.unique(np.packbits(hits, axis=0).T, axis=0, return_index=True)
    first = np.sort(first)
    intercept, weights = _lasso(hits[:, first], y, penalty)
    kept = [(paths[k], float(w)) for k, w in zip(first, weights, strict=True) if abs(w) > 1e-3]
    return Rules(intercept, tuple(kept))


def train(measured: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Rules:
    """Fit on at most ``rows`` rows of ``measured`` that ``labels`` (``doc_id`` and 0 or 1) marks."""
    marks = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_label"))
    marks = marks.where("_id is not null and _label in (0, 1)")
    known = measured.join(marks, measured["doc_id"] == marks["_id"])
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "_label").limit(rows).select(*STATISTICS, "_label").toArrow()
    x = np.stack([known[s].to_numpy() for s in STATISTICS], axis=1)
    return fit(x, known["_label"].to_numpy())


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row; learns where ``held_out`` is false."""
    measured = stored(with_statistics(docs), "statistics").withColumn("held_out", held_out)
    rules = train(measured.where("not held_out"), labels, label)
    scored = measured.select("doc_id", "held_out", rules.column().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))

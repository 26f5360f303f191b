"""Quality classifier: sparse rule ensemble compiled to column expressions.

A boosted ensemble of small trees is grown over the text statistics of ``stats``; every path
from a root to any of its nodes becomes a conjunctive rule. A lasso-penalised logistic
regression over the rules and the (clipped, scaled) statistics keeps a few of them, and the
fitted model is one Spark column expression, so scoring is a projection over the whole table.

Training takes a bounded sample of labelled rows (``SAMPLE_ROWS``, by a hash of the id): its
statistics are computed by Spark, its fit is numpy on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stats

SAMPLE_ROWS = 20_000  # labelled rows used for the fit, at most
TREES, DEPTH, SHRINK, CANDIDATES = 40, 3, 0.3, 24
PENALTY = 0.002
THRESHOLD = 0.3


@dataclass
class Model:
    """intercept + sum of weight * rule + sum of weight * clipped statistic, through a
    sigmoid. A rule is a tuple of (statistic, is_above, cut)."""

    intercept: float = 0.0
    rules: list[tuple[tuple, float]] = field(default_factory=list)
    linear: list[tuple[str, float, float, float]] = field(default_factory=list)  # name, low, high, weight

    def expression(self) -> Column:
        """The score, 0 to 1, over the statistics' columns."""
        total = F.lit(float(self.intercept))
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for name, above, cut in conditions:
                holds = holds & ((F.col(name) > cut) if above else (F.col(name) <= cut))
            total = total + F.when(holds, weight).otherwise(0.0)
        for name, low, high, weight in self.linear:
            total = total + F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high)) * weight
        return 1 / (1 + F.exp(-total))


def _split(x, grad, hess, rows, cuts):
    """The (gain, statistic, cut) that best splits ``rows`` of a boosting step."""
    best, g, h = (1e-6, None, None), grad[rows], hess[rows]
    base = g.sum() ** 2 / (h.sum() + 1.0)
    for j, points in enumerate(cuts):
        if not len(points):
            continue
        at = np.searchsorted(points, x[rows, j], side="left")  # value <= points[k] for all k >= at
        gl = np.cumsum(np.bincount(at, g, len(points) + 1))[:-1]
        hl = np.cumsum(np.bincount(at, h, len(points) + 1))[:-1]
        gain = gl**2 / (hl + 1.0) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1.0) - base
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), j, float(points[k]))
    return best


def grow(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[tuple]:
    """Rules of a boosted ensemble of trees: every path to a node below a root."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CANDIDATES + 2)[1:-1])) for j in range(x.shape[1])]
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    margin, rules = np.full(len(y), np.log(rate / (1 - rate))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess, step = y - p, p * (1 - p), np.zeros(len(y))
        leaves = [((), np.arange(len(y)))]
        for _ in range(DEPTH):
            deeper = []
            for path, rows in leaves:
                gain, j, cut = _split(x, grad, hess, rows, cuts)
                if j is None:
                    deeper.append((path, rows))
                    continue
                above = x[rows, j] > cut
                for side, own in ((False, rows[~above]), (True, rows[above])):
                    to = tuple(sorted({*path, (names[j], side, cut)}))
                    rules[to] = None
                    deeper.append((to, own))
            leaves = deeper
        for _, rows in leaves:
            step[rows] = grad[rows].sum() / (hess[rows].sum() + 1.0)
        margin += SHRINK * step
    return list(rules)


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all but the intercept (accelerated
    proximal gradient)."""
    n = len(y)
    design = np.hstack([np.ones((n, 1)), z])
    v = np.random.default_rng(0).normal(size=design.shape[1])
    for _ in range(15):
        v = design.T @ (design @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / (v @ (design.T @ (design @ v))) * 0.9
    w = look = np.zeros(design.shape[1])
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ look, -30, 30)))
        new = look - rate * (design.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / ahead * (new - w), new, ahead
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = PENALTY) -> Model:
    """The sparse rule ensemble for statistics ``x`` and labels ``y`` (0 or 1). With one
    class only, the score is that class's smoothed share for every text."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))))
    rules = grow(x, y, names)
    at = {n: j for j, n in enumerate(names)}
    held = np.array([np.all([(x[:, at[n]] > c) == above for n, above, c in rule], axis=0) for rule in rules]).T.astype(float)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    mean, scale = clipped.mean(axis=0), clipped.std(axis=0)
    usable = scale > 1e-9
    scale = np.where(usable, scale / 0.4, 1.0)  # as wide as a rule that holds for a fifth of the rows
    centre = held.mean(axis=0)
    z = np.hstack([held - centre, np.where(usable, (clipped - mean) / scale, 0.0)])
    intercept, w = _lasso(z, y, penalty)
    on_rules, on_linear = w[: len(rules)], w[len(rules):] / scale * usable
    intercept -= on_rules @ centre + on_linear @ mean
    return Model(float(intercept), [(r, float(a)) for r, a in zip(rules, on_rules) if a],
                 [(n, float(a), float(b), float(v)) for n, a, b, v in zip(names, low, high, on_linear) if v])


def held_out(id_col: str) -> Column:
    """Rows that training never sees: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def with_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    return stats.with_shape(stats.with_base(stats.with_words(docs, text_col)))


def train(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", text_col: str = "text",
          id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, penalty: float = PENALTY) -> Model:
    """Fit on at most ``sample_rows`` labelled rows that are not held out. Rows without a
    label, id or counterpart in the other table are passed over; for an id that is labelled
    twice the least label counts."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("double").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    lean = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = (with_statistics(lean.join(F.broadcast(chosen), "id"), "text")  # sample_rows pairs of numbers
            .select("id", "label", *[F.col(c).cast("double") for c in stats.SHAPE]).dropDuplicates(["id"]).collect())
    rows.sort(key=lambda r: r["id"])
    data = np.array([[*r][1:] for r in rows], dtype=float).reshape(len(rows), 1 + len(stats.SHAPE))
    return fit(data[:, 1:], (data[:, 0] > 0).astype(float), stats.SHAPE, penalty)


def quality_scores(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
                   label_col: str = "quality", threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with held_out, score (0 to 1, higher: label 1 is likelier) and predicted
    (1 from ``threshold``).

    Only the text is an input of the score; a null text is scored as an empty one. Rows with
    equal texts have equal scores. Columns of ``docs`` with the names above are replaced,
    other columns stay. An empty table gives an empty result, and without usable labels
    every text has the score 0.5.
    """
    model = train(docs, labels, label_col=label_col, text_col=text_col, id_col=id_col, sample_rows=sample_rows)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = with_statistics(row, "text").withColumn("score", model.expression())
    added = ["held_out", "score", "predicted"]
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in added],
                         held_out("id").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))

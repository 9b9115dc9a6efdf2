"""Quality classifier: a sparse ensemble of rules over a text's statistics.

Shallow trees, boosted on a bounded sample of labelled rows, give conjunctive rules (every path from a root to a
node). Lasso logistic regression weighs them; those with a weight become one Spark column expression, so every text is
scored by native functions. Labels, language, source and identifiers are never inputs of a score.

Edge cases: a null or empty text has statistics of 0 and is scored by them. Labels that are null are not learnt from; a
document labelled more than once counts with the mean label, 1 from a half on. Without labels of both kinds every score
is the share of label 1, or 0.5 without any. A null doc_id is never learnt from and is not held out. Repeated rows get
equal scores, an empty table an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galeframe.llm.staging import staged
from galeframe.llm.statistics import let, statistics

#: At most so many labelled documents, and different texts of them, are learnt from: those of the smallest hashes.
MAX_TRAINING_ROWS = 20_000
TREES, DEPTH, RATE, LASSO, THRESHOLD = 24, 3, 0.3, 2e-3, 0.3


def held_out(folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def features(s: Column) -> dict[str, Column]:
    words, chars = (F.greatest(s[c], F.lit(1)).cast("double") for c in ("n_words", "n_chars"))
    return {
        "word_length": s["word_chars"] / words,
        "symbols": s["n_symbols"] / words,
        "dup_lines": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "repeats": s["n_repeat_words"] / words,
        "upper": s["n_upper"] / chars,
        "digits": s["n_digits"] / chars,
        "bangs": s["n_bangs"] / words,
        "stops": s["n_stops"] / words,
        "short": s["n_short"] / words,
        "distinct": s["n_distinct"] / words,
        "words": F.log1p(s["n_words"].cast("double")),
    }


@dataclass(frozen=True)
class Rule:
    """Holds where every (feature, threshold, above) does: above means greater than, else at most."""

    conditions: tuple[tuple[str, float, bool], ...]

    def rows(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([(x[f] > t) == up for f, t, up in self.conditions])

    def column(self, f: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, t, up in self.conditions:
            out = out & ((f[name] > F.lit(t)) if up else (f[name] <= F.lit(t)))
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def column(self, f: dict[str, Column]) -> Column:
        total = F.lit(float(self.intercept))
        for rule, w in self.weights:
            total = total + F.when(rule.column(f), F.lit(float(w))).otherwise(F.lit(0e0))
        return 1e0 / (1e0 + F.exp(-total))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _split(x: dict[str, np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray) -> tuple[float, str, float]:
    """The gain, feature and threshold of the best split of some rows by their gradients."""
    best = (1e-6, "", 0.0)
    whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
    for name in x:
        v = x[name][rows]
        order = np.argsort(v, kind="stable")
        s, gs, hs = v[order], np.cumsum(g[rows][order]), np.cumsum(h[rows][order])
        cut = np.flatnonzero(s[1:] > s[:-1])
        cut = cut[(cut >= 4) & (cut < len(s) - 5)]
        if not len(cut):
            continue
        gain = gs[cut] ** 2 / (hs[cut] + 1) + (gs[-1] - gs[cut]) ** 2 / (hs[-1] - hs[cut] + 1) - whole
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), name, float((s[cut[k]] + s[cut[k] + 1]) / 2))
    return best


def _paths(x: dict[str, np.ndarray], y: np.ndarray) -> list[Rule]:
    """The rules of boosted trees, each once."""
    score, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}

    def grow(rows: np.ndarray, path: tuple, g: np.ndarray, h: np.ndarray) -> None:
        if path:
            rules[Rule(path)] = None
        gain, name, t = _split(x, g, h, rows) if len(path) < DEPTH and len(rows) > 12 else (0, "", 0.0)
        if not name:
            score[rows] += RATE * g[rows].sum() / (h[rows].sum() + 1)
            return
        above = x[name][rows] > t
        grow(rows[above], (*path, (name, t, True)), g, h)
        grow(rows[~above], (*path, (name, t, False)), g, h)

    for _ in range(TREES):
        p = _sigmoid(score)
        grow(np.arange(len(y)), (), y - p, p * (1 - p))
    return list(rules)


def _lasso(a: np.ndarray, y: np.ndarray, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic weights under an L1 penalty, by accelerated proximal gradients; the intercept is free."""
    n, k = a.shape
    size = 4 * n / (np.linalg.norm(a, 2) ** 2 + n)
    w, b, u, c, t = np.zeros(k), float(np.log(y.mean() / (1 - y.mean()))), np.zeros(k), 0.0, 1.0
    c = b
    for _ in range(steps):
        r = (_sigmoid(a @ u + c) - y) / n
        nw, nb = u - size * (a.T @ r), c - size * r.sum()
        nw = np.sign(nw) * np.maximum(np.abs(nw) - size * LASSO, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return b, w


def fit_rules(x: dict[str, np.ndarray], y: np.ndarray) -> RuleEnsemble:
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if not len(y) else float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    rules = _paths(x, y)
    if not rules:
        return RuleEnsemble(float(np.log(y.mean() / (1 - y.mean()))), ())
    b, w = _lasso(np.stack([r.rows(x) for r in rules], axis=1).astype(float), y)
    return RuleEnsemble(b, tuple((r, float(v)) for r, v in zip(rules, w, strict=True) if abs(v) > 1e-6))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Features and label of at most `most` labelled documents of `docs` that aren't held out.

    Texts stay in the tasks that read them: their digests tell them apart, and a collected limit would merge whole rows on the driver.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = known.filter(~held_out(5, 0)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most `most` rows of 16 bytes
    s = texts.select("doc_id", "y", F.sha2("text", 256).alias("digest"), F.xxhash64("doc_id", "text").alias("h"), statistics(F.col("text"), extra=True).alias("s"))
    rows = s.select("doc_id", "y", "digest", "h", *(v.alias(k) for k, v in features(F.col("s")).items()))
    first = rows.dropDuplicates(["doc_id", "digest"]).orderBy("h", "doc_id", "digest").limit(most)
    return staged(first.drop("digest", "h"), "quality-training")


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> RuleEnsemble:
    rows = training_rows(docs, labels, most).toPandas().sort_values(["doc_id", "words", "word_length"])
    return fit_rules({c: rows[c].to_numpy(float) for c in rows.columns if c not in ("doc_id", "y")}, rows["y"].to_numpy(float))


def score(text: Column, model: RuleEnsemble) -> Column:
    """The score of a text: its statistics and features are worked out once, and all rules read them."""

    def rules(f: Column) -> Column:
        return model.column({k: f[k] for k in names})

    names = list(features(F.lit(None)))
    return let(statistics(text, extra=True), lambda s: let(F.struct(*(v.alias(k) for k, v in features(s).items())), rules))


def quality_scores(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of `docs`."""
    out = docs.select("doc_id", held_out(5, 0).alias("held_out"), score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_filtered(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The rows of `docs` that are predicted 1, with all their columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return docs.select(row, score(F.col("text"), model).alias("p")).filter(F.col("p") >= THRESHOLD).select("row.*")

"""Quality classifier: a sparse rule ensemble. Paths of small trees over text statistics
become conjunctive rules, a lasso logistic regression weighs them, and the rules left are
compiled into Spark column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import WORD_REGEX, written

SAMPLE = 20_000      # labelled rows the model is fitted on, at most
N_TREES = 40
DEPTH = 3
MIN_LEAF_SHARE = 0.005
CUTS = 24            # candidate thresholds of a statistic
LASSO = 0.002
SEED = 7


def statistics(text: Column) -> dict[str, Column]:
    """Text statistics as doubles; all 0 for null and empty texts."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.char_length(t), F.lit(1))
    words = F.greatest(F.regexp_count(t, F.lit(WORD_REGEX)), F.lit(1))
    split, lines = F.split(t, r"[\x20\x09-\x0D]+"), F.split(t, "\n")

    def share(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)) / chars
    return {
        "log_words": F.log1p(F.regexp_count(t, F.lit(WORD_REGEX)).cast("double")),
        "word_length": F.char_length(t) / words,
        "distinct_words": F.when(F.char_length(t) > 0, F.size(F.array_distinct(split)) / F.size(split)).otherwise(0.0),
        "distinct_lines": F.when(F.char_length(t) > 0, F.size(F.array_distinct(lines)) / F.size(lines)).otherwise(0.0),
        "words_per_line": F.regexp_count(t, F.lit(WORD_REGEX)) / F.size(lines),
        "upper": share(r"\p{Lu}"),
        "digits": share("[0-9]"),
        "symbols": share(r"[#*$%&|<>]"),
        "marks": share("[!?]"),
        "stops": share("[.,;:]"),
        "other": share(r"[^\p{L}0-9\s.,;:!?#*$%&|<>]"),
    }


STATISTICS = (
    "log_words", "word_length", "distinct_words", "distinct_lines", "words_per_line", "upper", "digits", "symbols", "marks", "stops", "other")


@dataclass(frozen=True)
class Model:
    """score = sigmoid(intercept + sum of the weights of the rules that hold); a rule is a
    tuple of (statistic, above, threshold)."""
    intercept: float
    rules: tuple = field(default_factory=tuple)  # ((condition, ...), weight)

    def column(self) -> Column:
        total = F.lit(float(self.intercept))
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for name, above, cut in conditions:
                holds = holds & ((F.col(name) > cut) if above else (F.col(name) <= cut))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tree_paths(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rng: np.random.Generator) -> list[tuple]:
    """All paths from the root of one tree, grown on the rows given with a random subset of
    the statistics at each node."""
    paths, least = [], max(2, int(MIN_LEAF_SHARE * len(y)))

    def grow(rows: np.ndarray, path: tuple) -> None:
        if len(path) >= DEPTH or len(rows) < 2 * least or y[rows].min() == y[rows].max():
            return
        best = (0.0, None, None)
        p = y[rows].mean()
        base = p * (1 - p) * len(rows)
        for j in rng.choice(x.shape[1], size=max(1, (2 * x.shape[1]) // 3), replace=False):
            if not len(cuts[j]):
                continue
            place = np.searchsorted(cuts[j], x[rows, j], side="left")  # x <= cuts[i] just if place <= i
            n = np.cumsum(np.bincount(place, minlength=len(cuts[j]) + 1))[:-1].astype(float)
            s = np.cumsum(np.bincount(place, weights=y[rows], minlength=len(cuts[j]) + 1))[:-1]
            m, r = len(rows) - n, y[rows].sum() - s
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = base - (s * (1 - s / n) + r * (1 - r / m))
            gain[(n < least) | (m < least)] = 0
            i = int(np.nanargmax(gain))
            if gain[i] > best[0] + 1e-12:
                best = (float(gain[i]), int(j), float(cuts[j][i]))
        if best[1] is None:
            return
        _, j, cut = best
        below = x[rows, j] <= cut
        for above in (False, True):
            here = (*path, (j, above, cut))
            paths.append(here)
            grow(rows[~below] if above else rows[below], here)

    grow(np.arange(len(y)), ())
    return paths


def _lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept is not penalised."""
    n, m = r.shape
    a = np.hstack([np.ones((n, 1)), r])
    w, z, t = np.zeros(m + 1), np.zeros(m + 1), 1.0
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[0] = z[0] = np.log(p / (1 - p))
    v = np.ones(m + 1) / np.sqrt(m + 1)
    for _ in range(30):  # largest eigenvalue by power iteration
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / float(np.linalg.norm(a @ v) ** 2 * 1.02)
    for _ in range(steps):
        g = a.T @ (1 / (1 + np.exp(-np.clip(a @ z, -35, 35))) - y) / n
        new = z - rate * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Model:
    """The model of statistics ``x`` (columns in the order of STATISTICS) and 0/1 labels."""
    if not len(y):
        return Model(0.0)
    if y.min() == y.max():
        return Model(4.0 if y[0] else -4.0)
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1])) for c in x.T]
    cuts = [np.unique(np.concatenate([c, np.quantile(x[y == k, j], [0.01, 0.05, 0.95, 0.99]) if (y == k).any() else []])) for j, c in enumerate(cuts) for k in [int(y.mean() < 0.5)]]
    rules: dict[tuple, None] = {}
    for _ in range(N_TREES):
        rows = rng.choice(len(y), size=max(2, len(y) // 2), replace=False)
        for path in _tree_paths(x[rows], y[rows], cuts, rng):
            rules[tuple(sorted(path))] = None
    rules = list(rules)
    held = np.stack([np.logical_and.reduce([(x[:, j] > c) if above else (x[:, j] <= c) for j, above, c in r]) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    _, first = np.unique(held, axis=1, return_index=True)  # rules that hold on the same rows count once
    first = np.sort(first)
    rules, held = [rules[i] for i in first], held[:, first]
    b, w = _lasso_logistic(held, y.astype(float), LASSO)
    return Model(b, tuple((tuple((STATISTICS[j], above, float(c)) for j, above, c in r), float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    return docs.select(*keep, *[c.cast("double").alias(n) for n, c in statistics(F.col("text")).items()])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` labelled rows that are not held out (the first by a hash of
    the id; documents matched by ``doc_id``). Rows without label or id are left out."""
    asked = labels.where("quality is not null and doc_id is not null").where(~is_held_out(F.col("doc_id")))
    asked = written(asked.select("doc_id", F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample), "quality-sample")
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(asked), "doc_id"), "doc_id", "quality")  # at most ``sample`` short rows
    rows = sorted(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect())
    x = np.array([r[2:] for r in rows], dtype=float).reshape(len(rows), len(STATISTICS))
    return fit_rules(x, np.array([r[1] for r in rows], dtype=int))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Only the text enters a score. Null and empty texts have all statistics 0 and get the score
    of such a text; a null id is never held out; repeated rows get equal scores; other columns
    are ignored; an empty table gives no rows. Without any label the score is 0.5, which
    predicts 1.
    """
    out = with_statistics(docs, "doc_id").withColumn("score", model.column())
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model predicts good, with all their columns, whatever
    these are called (rows travel as one struct). Null and empty texts are judged as in
    ``score``; repeated rows stay or go together; an empty table gives no rows."""
    # the row number keeps the filter above the projection: pushed below it, every rule would
    # compute its statistics anew
    packed = docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_rid"),
                         *[c.cast("double").alias(n) for n, c in statistics(docs["text"]).items()])
    return packed.where((model.column() >= 0.5) & (F.col("_rid") >= 0)).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])

"""Quality of texts by a sparse ensemble of rules over statistics.

Each text is described by some twenty statistics, all of them column expressions. Boosted shallow
trees are grown on a bounded sample of labelled rows; every path from a root to a node is a rule,
a conjunction of thresholds. A logistic model with an absolute-value penalty (lasso) weighs the
rules, and most weights become zero; the penalty is the largest one whose loss on the rows held
back from the fit is within one standard error of the least. What is left is compiled into one
column expression, so that scoring is a projection over the documents without Python or shuffle.

Rules for odd input: null texts count as empty, and all shares of an empty text are 0; texts of any
length are read whole; repeated rows each give a row; a document with several labels counts as
bad if any of them says so; null labels and labels without a document teach nothing; without any
label, or with one class only, every text scores the share of good ones (0.5 without any); columns
other than doc_id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import id_text, table

#: Labelled rows that are learned from at most, and how many of 5 parts of them choose the penalty.
TRAIN_ROWS = 10_000
BACK_PARTS = 1
#: Trees, levels of each, share of the rows each sees, step of boosting, least rows of a node.
TREES = 50
DEPTH = 3
SEEN = 0.5
STEP = 0.2
LEAF = 20
#: Thresholds tried for each statistic, and penalties tried, each a fixed share of the one before.
BINS = 32
PENALTIES = 16
SHRINK = 0.65
ROUNDS = 80


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text, in the columns named by `names`."""
    text = F.coalesce("text", F.lit(""))
    cut = id_text(docs).select("doc_id", text.alias("text"))
    cut = cut.select(
        "doc_id",
        "text",
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.trim(line) != "").alias("lines"),
    )

    def left(removed: str) -> Column:
        return F.length(F.regexp_replace("text", removed, "")).cast("double")

    def share(part: Column, whole: str) -> Column:
        return F.when(F.col(whole) > 0, part / F.col(whole)).otherwise(0.0)

    sizes = F.transform("words", F.length)
    counted = cut.select(
        "doc_id",
        "text",
        "words",
        "lines",
        F.length("text").cast("double").alias("n_chars"),
        F.size("words").cast("double").alias("n_words"),
        F.size("lines").cast("double").alias("n_lines"),
        left(r"[^\p{L}]+").alias("letters"),
        sizes.alias("sizes"),
    )
    return counted.select(
        "doc_id",
        F.col("n_chars"),
        F.col("n_words"),
        F.col("n_lines"),
        share(F.col("letters"), "n_words").alias("letters_per_word"),
        share(F.col("letters"), "n_chars").alias("letter_share"),
        share(left(r"[^\p{Lu}]+"), "letters").alias("upper_share"),
        share(left(r"[^0-9]+"), "n_chars").alias("digit_share"),
        share(left(r"[\p{L}\p{N}\s.,;:!?'\"()-]+"), "n_chars").alias("symbol_share"),
        share(left(r"[^.,;:?]+"), "n_words").alias("stops_per_word"),
        share(left(r"[^!]+"), "n_words").alias("bangs_per_word"),
        share(left(r"[^\x80-\x{10FFFF}]+"), "n_chars").alias("beyond_ascii"),
        share(F.size(F.array_distinct("words")).cast("double"), "n_words").alias("distinct_words"),
        share(F.size(F.array_distinct("lines")).cast("double"), "n_lines").alias("distinct_lines"),
        share(F.col("n_words"), "n_lines").alias("words_per_line"),
        share(F.size(F.filter("sizes", lambda n: n <= 3)).cast("double"), "n_words").alias("short_words"),
        share(F.size(F.filter("sizes", lambda n: n >= 12)).cast("double"), "n_words").alias("long_words"),
        F.coalesce(F.array_max("sizes"), F.lit(0)).cast("double").alias("longest_word"),
    )


def names(stats: DataFrame) -> list[str]:
    return [c for c in stats.columns if c not in ("doc_id", "good")]


@dataclass(frozen=True)
class Rule:
    """A conjunction: for each statistic an open lower and a closed upper end."""

    ends: tuple[tuple[str, float, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([(x[name] > low) & (x[name] <= high) for name, low, high in self.ends])

    def column(self) -> Column:
        parts = [F.col(name) > low for name, low, _ in self.ends if low > -np.inf]
        parts += [F.col(name) <= high for name, _, high in self.ends if high < np.inf]
        whole = parts[0]
        for part in parts[1:]:
            whole &= part
        return whole


@dataclass
class Ensemble:
    base: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self) -> Column:
        """The probability that a text is good, from its statistics."""
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total += F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _cuts(x: np.ndarray) -> np.ndarray:
    """Thresholds between the values of a statistic, at most one in each of so many equal parts."""
    values = np.unique(np.quantile(x, np.linspace(0, 1, BINS + 1), method="lower"))
    return (values[1:] + values[:-1]) / 2


def _tree(bins: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> list[tuple]:
    """Nodes (path, rows, value) of a tree; a path is a tuple of (statistic, cut, above)."""
    nodes, todo = [], [((), rows)]
    while todo:
        path, own = todo.pop()
        if path:
            nodes.append((path, own, -grad[own].sum() / (hess[own].sum() + 1.0)))
        if len(path) == DEPTH or len(own) < 2 * LEAF:
            continue
        best = (1e-6, None)
        g, h = grad[own].sum(), hess[own].sum()
        for j in range(bins.shape[1]):
            at = bins[own, j]
            size = np.bincount(at, minlength=BINS + 1).cumsum()[:-1]
            gl = np.bincount(at, grad[own], BINS + 1).cumsum()[:-1]
            hl = np.bincount(at, hess[own], BINS + 1).cumsum()[:-1]
            gain = gl**2 / (hl + 1.0) + (g - gl) ** 2 / (h - hl + 1.0) - g**2 / (h + 1.0)
            gain[(size < LEAF) | (len(own) - size < LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (j, k))
        if best[1] is not None:
            j, k = best[1]
            above = bins[own, j] > k
            todo += [((*path, (j, k, True)), own[above]), ((*path, (j, k, False)), own[~above])]
    return nodes


def grow(x: dict[str, np.ndarray], y: np.ndarray, seed: int = 13) -> list[Rule]:
    """The rules of boosted trees, each once, in the order they came up."""
    rng = np.random.default_rng(seed)
    cuts = {name: _cuts(values) for name, values in x.items()}
    bins = np.stack([np.searchsorted(cuts[name], values, side="left") for name, values in x.items()], 1)
    known, margin = list(x), np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        seen = np.sort(rng.choice(len(y), max(1, int(SEEN * len(y))), replace=False))
        for path, _, value in _tree(bins, seen, grad, hess):
            ends: dict[str, tuple[float, float]] = {}
            for j, k, above in path:
                low, high = ends.get(known[j], (-np.inf, np.inf))
                cut = float(cuts[known[j]][k])
                ends[known[j]] = (max(low, cut), high) if above else (low, min(high, cut))
            rule = Rule(tuple((name, *ends[name]) for name in sorted(ends)))
            rules[rule] = None
            if len(path) == DEPTH:
                margin[rule.holds(x)] += STEP * value
    return list(rules)


def _loss(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, margin) - y * margin


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, w: np.ndarray) -> np.ndarray:
    """Weights (the last one free of penalty) of a logistic model, by accelerated gradient steps."""
    length = 4.0 / (np.linalg.norm(z, 2) ** 2 / len(y))
    ahead, before, t = w.copy(), w, 1.0
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-(z @ ahead)))
        step = ahead - length * (z.T @ (p - y) / len(y))
        new = np.sign(step) * np.maximum(np.abs(step) - length * penalty, 0)
        new[-1] = step[-1]
        if np.abs(new - before).max() < 1e-5:
            return new
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, before, t = new + (t - 1) / t_new * (new - before), new, t_new
    return before


def fit(x: dict[str, np.ndarray], y: np.ndarray, back: np.ndarray) -> Ensemble:
    """The ensemble from statistics, classes (1: good) and the mask of rows held back."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return Ensemble(float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    if back.all() or not back.any() or y[~back].min() == y[~back].max():
        back = np.zeros(len(y), bool)
    rules = grow({name: v[~back] for name, v in x.items()}, y[~back])
    held = np.stack([rule.holds(x) for rule in rules] or [np.zeros(len(y), bool)], 1)
    support = held[~back].mean(0)
    # Rules of equal spread, so that the penalty weighs all alike.
    spread = np.sqrt(support * (1 - support)).clip(1e-3)
    z = np.hstack([(held - support) / spread, np.ones((len(y), 1))])
    train, other = z[~back], z[back]
    w = np.zeros(z.shape[1])
    w[-1] = np.log(y[~back].mean() / (1 - y[~back].mean()))
    penalty = np.abs(train[:, :-1].T @ (y[~back].mean() - y[~back])).max() / len(train)
    tried = []
    for _ in range(PENALTIES):
        penalty *= SHRINK
        w = _lasso(train, y[~back], penalty, w)
        loss = _loss(other @ w, y[back]) if back.any() else np.zeros(1)
        tried.append((loss.mean(), loss.std() / np.sqrt(len(loss)), w))
    least, error, _ = min(tried, key=lambda found: found[0])
    w = next(found[2] for found in tried if found[0] <= least + error) if back.any() else w
    weights = w[:-1] / spread
    return Ensemble(
        float(w[-1] - support @ weights), [(r, float(a)) for r, a in zip(rules, weights) if abs(a) > 1e-4]
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Ensemble:
    """The ensemble from `rows` labelled documents at most, those of the smallest hashes of the id."""
    place = F.xxhash64("doc_id")
    chosen = (
        labels.filter("quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("good"))
        .filter(~held_out() & F.col("doc_id").isNotNull())
        .orderBy(place, "doc_id")
        .limit(rows)
    )
    # Bounded by `rows`; a repeated id takes part as often as it occurs, up to the bound.
    texts = id_text(docs).join(F.broadcast(chosen), "doc_id")
    texts = texts.orderBy(place, "doc_id", F.xxhash64("text")).limit(rows)
    stats = statistics(texts.select("doc_id", "text")).join(F.broadcast(chosen), "doc_id")
    found = stats.orderBy(place, "doc_id", *names(stats)).toPandas()
    x = {name: found[name].to_numpy(np.float64) for name in names(stats)}
    back = np.arange(len(found)) % 5 < BACK_PARTS
    return fit(x, (found["good"].to_numpy() > 0).astype(np.float64), back)


def score(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """doc_id and score of every whole text."""
    return statistics(docs).select("doc_id", ensemble.column().alias("score"))


def op13_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ensemble = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, ensemble).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )

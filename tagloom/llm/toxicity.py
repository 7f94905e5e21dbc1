"""Toxicity: a support vector machine on a gapped-subsequence string kernel with Nystroem landmarks.

The kernel compares two windows of text by the subsequences of three and of four characters
that they share; a subsequence that spreads over more characters counts less, by DECAY for
each character between, so insults with letters put in or left out stay similar. Strings are
lower-cased letters and white space (anything else is a gap; letters beyond a to z share 20
classes), and a window is the subsequences that begin in WINDOW neighbouring characters.

Labels are per document, so training picks windows: at first those with the subsequences that
are surely commoner in toxic documents, then the PEAKS windows of each document that look worst
to the last machine. Of a toxic document the worst one counts as toxic, and each other one that
the machine takes for toxic as well. Landmarks are chosen one by one, each the window that
explains most of what the landmarks before it leave of the kernel matrix, so insults of a rare
language get theirs. Since the machine is linear in kernel values, it folds into one weight per
subsequence; a text is judged by its PEAKS largest window sums that do not overlap, found in one
vectorised pass over the whole text. The machine is the mean of FOLDS ones, each of which leaves out a
part of the documents. Two logistics, of the largest sum and of the mean of all, are fitted on the parts
left out, and the surer one is the score: one plain insult is enough, and a stem that clean texts have
now and then counts where it is repeated. Both are shifted so that CUT is the threshold of the best F2 there.

It learns from at most `rows` labelled, not held-out rows of each class, of up to MAX_CHARS
characters, those with the least hash of their ids.

Rules for odd input: null and empty texts have the margin of no window (score near 0); texts of
any length are read whole, in overlapping parts; repeated rows each give a row; a row with several
labels counts as toxic if any is; windows of equal sums count from the left; without rows of both
classes every score is 0; columns other than doc_id, text and toxic are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import by_document, held_out, id_text, table

LETTERS = 48
SPAN = 5
DECAY = 0.6
WINDOW = 6
TRAIN_ROWS = 1500
MAX_CHARS = 20_000
LANDMARKS = 160
POOL = 600
PEAKS = 4
FOLDS = 3
CUT = 0.7
ROUNDS = 2
PART = 1_000_000

CODES = LETTERS**3 + LETTERS**4
REACH = WINDOW + SPAN


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """1 to 26 for a to z, up to 46 for other letters, 47 for white space, 0 for a gap."""
    out = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if chr(point).isalpha():
            low = ord(chr(point).lower()[0])
            out[point] = low - 96 if 97 <= low <= 122 else 27 + low % 20
        elif chr(point).isspace():
            out[point] = LETTERS - 1
    return out


def letters(text: str) -> np.ndarray:
    return letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def subsequences(s: np.ndarray) -> Iterator[tuple[tuple[int, ...], float, np.ndarray]]:
    """For each choice of offsets after the first character: these, the weight in the kernel, and
    the number of the subsequence at each place (CODES where it has a gap)."""
    n = len(s) - SPAN
    at = s.astype(np.intp)
    whole = s != 0
    for i, j in combinations(range(1, SPAN + 1), 2):
        three = (at[:n] * LETTERS + at[i : n + i]) * LETTERS + at[j : n + j]
        there = whole[:n] & whole[i : n + i] & whole[j : n + j]
        yield (i, j), DECAY ** (j - 2), np.where(there, three, CODES)
        for k in range(j + 1, SPAN + 1):
            four = three * LETTERS + at[k : n + k] + LETTERS**3
            yield (i, j, k), DECAY ** (k - 3), np.where(there & whole[k : n + k], four, CODES)


def _padded(s: np.ndarray) -> np.ndarray:
    return np.concatenate([s, np.zeros(SPAN + WINDOW, np.uint8)])


def sums(s: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The sum of weights over the window that begins at each place; the last weight is 0."""
    each = np.zeros(len(s) + WINDOW, np.float32)
    for _, share, codes in subsequences(_padded(s)):
        each += np.float32(share) * weights.take(codes)
    total = np.cumsum(np.concatenate([[0], each]), dtype=np.float64)
    return (total[WINDOW:] - total[:-WINDOW])[: len(s)]


def _parts(text: str | None) -> Iterator[str]:
    for at in range(0, len(text or ""), PART):
        yield text[at : at + PART + SPAN + WINDOW]


def worst(text: str | None, weights: np.ndarray, n: int = PEAKS) -> list[tuple[float, str]]:
    """The largest n different window sums of a text above 0 and their windows, none of which overlap."""
    found = []
    for first, part in enumerate(_parts(text)):
        total = sums(letters(part), weights)
        for _ in range(n):
            at = int(total.argmax())
            if total[at] <= 0:
                break
            found.append((float(total[at]), first * PART + at, part[at : at + REACH]))
            # A window that is repeated counts once, as do those around it.
            same = np.abs(total - total[at]) < 1e-5
            same[max(0, at - REACH + 1) : at + REACH] = True
            total[same] = 0
    found.sort(key=lambda f: (-f[0], f[1]))
    apart: list[tuple[float, int, str]] = []
    for peak in found:  # a window in the overlap of two parts is there twice
        if len(apart) < n and all(
            abs(peak[1] - other[1]) >= REACH and abs(peak[0] - other[0]) >= 1e-5 for other in apart
        ):
            apart.append(peak)
    return [(value, window) for value, _, window in apart]


def margins(text: str | None, weights: np.ndarray) -> tuple[float, float]:
    """The largest window sum, and the mean of the PEAKS largest; 0 for each that is not there."""
    values = [value for value, _ in worst(text, weights)]
    return max(values, default=0.0), sum(values) / PEAKS


def window_codes(windows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences of each window, one row a window (CODES: a gap), and their kernel weights."""
    strings = np.zeros((len(windows), REACH), np.uint8)
    for i, window in enumerate(windows):
        own = letters(window[:REACH])
        strings[i, : len(own)] = own
    places = (np.arange(len(windows))[:, None] * REACH + np.arange(WINDOW)).reshape(-1)
    codes, shares = [], []
    for _, share, found in subsequences(_padded(strings.reshape(-1))):
        codes.append(found[places].reshape(-1, WINDOW).astype(np.int32))
        shares += [share] * WINDOW
    return np.hstack(codes), np.array(shares, np.float32)


@dataclass
class Model:
    codes: np.ndarray  # subsequences that weigh anything
    values: np.ndarray
    slopes: np.ndarray  # slope and offset of each of the two margins

    def weights(self) -> np.ndarray:
        """One weight per subsequence; one more, 0, for gaps."""
        out = np.zeros(CODES + 1, np.float32)
        out[self.codes] = self.values
        return out

    def score(self, text: str | None, weights: np.ndarray) -> float:
        at = _log_odds(np.array([margins(text, weights)]), self.slopes)[0]
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


def _log_odds(x: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    """The surer one of what each margin says."""
    return (x * slopes[:, 0] + slopes[:, 1]).max(1)


def _machine(x: np.ndarray, y: np.ndarray, c: float = 1.0) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    # Both classes weigh the same.
    cost = np.where(y > 0, c / (y > 0).sum(), c / (y < 0).sum()) * len(y) / 2
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = ridge @ w - x[on].T @ (cost[on] * y[on] * slack[on]) * 2
        if np.abs(grad).max() < 1e-6:
            break
        hess = ridge + 2 * (x[on].T * cost[on]) @ x[on]
        w = w - np.linalg.solve(hess, grad)
    return w


def _first_weights(toxic: list[str], clean: list[str]) -> np.ndarray:
    """A sure lower bound of the log-odds of each contiguous four-letter subsequence, by documents."""
    counts = []
    for texts in (toxic, clean):
        seen = np.zeros(CODES + 1, np.float32)
        for text in texts:
            own = next(codes for rest, _, codes in subsequences(_padded(letters(text))) if rest == (1, 2, 3))
            seen[np.unique(own)] += 1
        counts.append(seen)
    yes, no = counts
    odds = np.log((yes + 0.5) / (len(toxic) + 1)) - np.log((no + 0.5) / (len(clean) + 1))
    odds -= 2 * np.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
    odds[odds < 0] = 0
    odds[-1] = 0
    return odds.astype(np.float32)


def _fold(landmarks: list[str], values: np.ndarray) -> np.ndarray:
    codes, shares = window_codes(landmarks)
    weights = np.zeros(CODES + 1, np.float32)
    np.add.at(weights, codes, (np.asarray(values)[:, None] * shares).astype(np.float32))
    weights[-1] = 0
    return weights


def _kernel(windows: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values, from the subsequences that the landmarks have."""
    own, shares = window_codes(landmarks)
    vocabulary = np.unique(own[own < CODES])
    out = np.zeros((len(windows), len(landmarks)))
    if not len(vocabulary):
        return out
    amount = np.zeros((len(vocabulary) + 1, len(landmarks)), np.float32)  # the last row: not there
    row, column = np.nonzero(own < CODES)
    np.add.at(amount, (np.searchsorted(vocabulary, own[row, column]), row), shares[column])
    codes, _ = window_codes(windows)
    place = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
    place = np.where(vocabulary[place] == codes, place, len(vocabulary))
    for i, share in enumerate(shares):
        out += share * amount[place[:, i]]
    return out


def _spread(windows: list[str], n: int) -> list[str]:
    """Up to n windows, evenly from their sorted order; what is frequent comes more than once."""
    ordered = sorted(w.lower() for w in windows)
    step = max(1, len(ordered) / n)
    return [ordered[int(i * step)] for i in range(min(n, len(ordered)))]


def _landmarks(windows: list[str], n: int) -> list[str]:
    """Greedy landmarks: each explains most of what those before it leave of the kernel matrix."""
    distinct = sorted(set(windows))
    often = np.sqrt([windows.count(w) for w in distinct])
    left = _kernel(distinct, distinct)
    size = np.sqrt(np.maximum(left.diagonal(), 1e-12))
    left = left / np.outer(size, size) * np.outer(often, often)
    chosen = []
    for _ in range(min(n, len(distinct))):
        own = left.diagonal()
        gain = np.where(own > 1e-3, (left**2).sum(0) / np.maximum(own, 1e-3), 0.0)
        at = int(gain.argmax())
        if gain[at] <= 0:
            break
        chosen.append(distinct[at])
        left = left - np.outer(left[at], left[at]) / left[at, at]
    return chosen


def _learn(toxic: list[str], clean: list[str], rounds: int) -> np.ndarray:
    """Weights of subsequences, from whole texts of both classes."""
    weights, bias = _first_weights(toxic, clean), 0.0
    held_back: list[str] = []
    for _ in range(rounds):
        yes = []
        for text in toxic:
            yes += [w for i, (value, w) in enumerate(worst(text, weights)) if i == 0 or value + bias > 0]
        no = [w for text in clean for _, w in worst(text, weights)]
        held_back = (held_back + no)[-2 * PEAKS * len(clean) :]
        plain = [t[at : at + REACH] for t in clean for at in range(0, len(t), max(40, len(t) // 3))]
        landmarks = _landmarks(_spread(yes, POOL * 2 // 3) + _spread(held_back, POOL // 3), LANDMARKS)
        if not landmarks:
            break
        values, vectors = np.linalg.eigh(_kernel(landmarks, landmarks))
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        windows = yes + held_back + plain
        y = np.array([1.0] * len(yes) + [-1.0] * (len(windows) - len(yes)))
        w = _machine(_kernel(windows, landmarks) @ root, y)
        weights, bias = _fold(landmarks, root @ w[:-1]), float(w[-1])
    return weights


def fit(toxic: list[str], clean: list[str], rounds: int = ROUNDS, prior: float | None = None) -> Model:
    """The machine from whole texts of both classes; `prior` is the share of toxic rows, if theirs is another.

    It is the mean of machines that each leave out a part of the documents; scores are fitted on
    the parts left out, and shifted so that CUT is where toxic and clean are told apart best.
    """
    found, y, machines = [], [], []
    for part in range(FOLDS):
        seen = [[t for i, t in enumerate(texts) if i % FOLDS != part] or texts for texts in (toxic, clean)]
        weights = _learn(*seen, rounds)
        machines.append(weights)
        for texts, label in ((toxic, 1.0), (clean, 0.0)):
            unseen = texts[part::FOLDS]
            found += [margins(t, weights) for t in unseen]
            y += [label] * len(unseen)
    x, truth = np.array(found), np.array(y)
    slopes = np.array([_platt(x[:, i], truth) for i in (0, 1)])
    share = len(toxic) / len(y)
    prior = share if prior is None else min(max(prior, 1e-6), 1 - 1e-6)
    cut = _best_cut(_log_odds(x, slopes), truth, (1 / prior - 1) / (1 / share - 1))
    slopes[:, 1] += np.log(CUT / (1 - CUT)) - cut
    weights = np.mean(machines, axis=0)
    codes = np.flatnonzero(weights)
    return Model(codes, weights[codes], slopes)


def _best_cut(values: np.ndarray, y: np.ndarray, clean_weight: float) -> float:
    """The cut below the value where F2, in which recall counts double, is greatest.

    It lies four fifths of the way down to the next value, as F2 weighs a missed toxic row four
    times a wrong one. A clean row stands for `clean_weight` rows.
    """
    order = np.argsort(-values, kind="stable")
    v, hit = values[order], np.cumsum(y[order])
    wrong = clean_weight * np.cumsum(1 - y[order])
    f2 = 5 * hit / (hit + wrong + 4 * y.sum())
    f2[:-1][v[:-1] == v[1:]] = 0  # equal values cannot be told apart
    at = int(f2.argmax())
    return float((v[at] + 4 * v[min(at + 1, len(v) - 1)]) / 5)


def _platt(margins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and offset of the logistic of margins, with Platt's softened labels.

    Steps use a bound of the curvature, so none of them can overshoot.
    """
    n1, n0 = y.sum(), (1 - y).sum()
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    middle, spread = margins.mean(), max(margins.std(), 1e-9)
    x = np.stack([(margins - middle) / spread, np.ones(len(y))], 1)
    ridge = np.diag([1.0, 1e-6])
    bound = np.linalg.inv(x.T @ x / 4 + ridge)
    w = np.zeros(2)
    for _ in range(2000):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = bound @ (x.T @ (p - goal) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    slope = max(w[0], 0.0) / spread
    return np.array([slope, w[1] - slope * middle])


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], list[str], float]:
    """Texts of toxic and of clean rows to learn from, at most `rows` each, and the share of toxic labels."""
    texts = id_text(docs).filter(~held_out() & (F.length("text") <= MAX_CHARS) & (F.length("text") > 0))
    marked = (
        labels.filter("toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out())
    )
    found = []
    for value in (1, 0):
        own = marked.filter(F.col("toxic") == value)
        ids = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows * 11 // 10).select("doc_id")
        got = texts.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").select("text")
        found.append([r["text"] for r in got.limit(rows).collect()])
    prior = marked.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    return found[0], found[1], prior


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def row():
        if sent.value is None:
            return lambda text: (0.0,)
        weights = sent.value.weights()
        return lambda text: (sent.value.score(text, weights),)

    return by_document(id_text(docs), row, "score double")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    toxic, clean, prior = sample(docs, labels, rows)
    return fit(toxic, clean, prior=prior) if toxic and clean else None


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"),
    )

"""Periodic runs of words: stretches that repeat a period three times or more, and texts without the repeats.

Seeds and extension on diagonals. Words that stand `q` apart and agree form a stretch on the
diagonal of lag q; a run of period q and length L is such a stretch of L - q words. The shortest
run of a period up to 16 still leaves 16 words on its diagonal, one of a longer period twice the
period. So k-grams of 16 words find the periods up to 16, k-grams of 32 words those up to 32, and
so on: k is the minimum guaranteed overlap, and at least the period. Every k-gram of the text is
indexed and paired with its last occurrence before. That one pair is enough: were it nearer than
the smallest period of a run, both would be periods of the same k + lag words, and so would their
greatest common divisor, which is smaller still. Pairs whose lag belongs to the k-gram are extended
to both sides by comparing words; a table of how far each lag is covered spares the pairs inside
a stretch that was extended before. Work is n log n for n words, also where one word fills a text.

Rules for odd input: words are runs of characters other than ASCII white space; null, empty and
short texts have no runs; texts of any length are read whole; repeated rows each give a row;
columns other than doc_id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import by_document, id_text, table

#: A run has this many words at least, and this many times its period.
LEAST = 24
TIMES = 3
#: Words that the shortest run of a period up to as many leaves on its diagonal.
SEED = 16

WORD = re.compile("[^\x20\x09-\x0d]+")

RUNS = "array<struct<start: long, length: long, period: long>>"


def _numbers(words: list[str]) -> np.ndarray:
    """The words as numbers, equal for equal words."""
    known: dict[str, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def _pairs(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose value occurred before, and how far back it last did."""
    order = np.argsort(rank, kind="stable")
    again = np.flatnonzero(rank[order[1:]] == rank[order[:-1]])
    place, lag = order[again + 1], order[again + 1] - order[again]
    by_place = np.argsort(place)
    return place[by_place], lag[by_place]


def _extend(ids: np.ndarray, lag: int, first: int, last: int) -> tuple[int, int]:
    """The longest stretch around [first, last) in which every word equals the one `lag` before."""
    step = 64
    while last < len(ids):
        size = min(step, len(ids) - last)
        differ = ids[last : last + size] != ids[last - lag : last - lag + size]
        if differ.any():
            last += int(differ.argmax())
            break
        last, step = last + size, step * 2
    step = 64
    while first > lag:
        size = min(step, first - lag)
        differ = ids[first - size : first] != ids[first - size - lag : first - lag]
        if differ.any():
            first -= int(differ[::-1].argmax())
            break
        first, step = first - size, step * 2
    return first, last


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    found: list[tuple[int, int, int]] = []
    covered: dict[int, int] = {}
    rank, size = ids, 1
    # Beyond the first seeds, only periods above size / 2 are left to find.
    while len(ids) >= (LEAST if size <= SEED else TIMES * (size // 2 + 1)):
        if size >= SEED:
            place, lag = _pairs(rank)
            if not len(place):
                break
            own = (lag <= size) & ((lag > size // 2) | (size == SEED))
            place, lag = place[own], lag[own]
            # One pair for each stretch of neighbours with the same lag.
            head = np.ones(len(place), bool)
            head[1:] = (np.diff(place) != 1) | (np.diff(lag) != 0)
            for at, q in zip(place[head].tolist(), lag[head].tolist()):
                if at + size <= covered.get(q, 0):
                    continue
                first, last = _extend(ids, q, at, at + size)
                covered[q] = last
                length = last - first + q
                if length >= max(LEAST, TIMES * q):
                    found.append((first - q, length, q))
        if len(rank) <= size:
            break
        # Ranks of twice as many words, from those of both halves.
        _, rank = np.unique(rank[:-size] * (int(rank.max()) + 1) + rank[size:], return_inverse=True)
        if rank.max() == len(rank) - 1:
            break  # nothing of this length occurs twice
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(text: str | None) -> tuple[int, list[tuple[int, int, int]], str]:
    """Words, runs, and the text with each run cut back to its first period, words joined by one space."""
    words = WORD.findall(text or "")
    runs = find_runs(_numbers(words))
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        keep = np.cumsum(change)[:-1] == 0
        words_left = [w for w, k in zip(words, keep.tolist()) if k]
    else:
        words_left = words
    return len(words), runs, " ".join(words_left)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed: the text without repeats."""

    def row():
        def one(text: str | None) -> tuple:
            n, runs, left = collapse(text)
            return n, [{"start": s, "length": l, "period": p} for s, l, p in runs], left

        return one

    return by_document(id_text(docs), row, f"n_words long, runs {RUNS}, collapsed string")


def longest_repeat(runs: str = "runs") -> Column:
    """The run with the greatest length per period; ties go to the smallest start, then period."""

    def better(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))
        return F.when(a.isNull() | (y > x) | ((y == x) & earlier), b).otherwise(a)

    return F.aggregate(runs, F.lit(None).cast(RUNS.removeprefix("array<")[:-1]), better)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the documents repeat a period from some word on.

    With h = crc32 of the decimal doc_id and g = h // 10, a document of n > 0 words with
    h % 10 = 0 has the word a + (i - a) % p at each place i >= a = g % n, with
    p = 1 + (n - a) // (3 + g % 8). A null doc_id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = id_text(docs).withColumn("h", h)
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))

    def planted(words: Column) -> Column:
        n = F.size(words)
        g = F.floor(F.col("h") / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"))
        spun = F.transform(
            place, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        )
        return F.when(n > 0, F.array_join(spun, " ")).otherwise(F.lit(""))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    made = F.get(F.transform(F.array(words), planted), F.lit(0))
    return rows.select("doc_id", F.when(chosen, made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(with_planted_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ended = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    best = found.withColumn("best", longest_repeat())
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(ended.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

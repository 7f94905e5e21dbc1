"""Language identification: one character model per language, the least cross-entropy wins.

Counts of 4-grams come from every labelled row that is not held out. Each language gets an
interpolated Kneser-Ney model over 64 symbols: the border of a word (0), the letters a to z
(1 to 26), and other letters by code point modulo 37 (27 to 63). A word is read from border
to border, so its cost depends on no other word. Probabilities lie in one array sorted by
4-gram key with a column per language; a 4-gram that no language has seen costs its history's
leftover weight times the probability of its last three symbols. There are at most 2^24 keys.

A text is rejected when its cross-entropy per symbol is further above the usual one of its
language than `margin` times what the worst of a thousand labelled rows is, measured on all of
them, and also past the `FLOOR` part of the way from the usual one to that of symbols drawn at random.

Rules for odd input: null texts and texts without a letter are `und` with score 0, rejected;
whole texts are read, in slices cut at white space (a word over 200,000 letters is cut);
repeated rows each give a row; equal costs go to the first language in order; columns other
than doc_id, text and lang are ignored; without labelled rows every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import few_rows, held_out, table
from tagloom.session import materialise

ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
HISTORIES = SYMBOLS ** (ORDER - 1)
SLICE = 200_000
#: Share of a language's labelled rows that lie within the limit which `margin` then widens.
WORST = 0.999
FLOOR = 0.4
UNKNOWN = "und"


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """The symbol of every code point."""
    out = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            out[point] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return out


def slices(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts, some 400,000 characters at a time; longer texts come in parts."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = at + SLICE
            if end < len(text):
                space = text.rfind(" ", at + 1, end)
                end = space if space > 0 else end
            rows.append(row)
            parts.append(text[at:end])
            size += len(parts[-1])
            at = end
            if size >= 2 * SLICE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if parts:
        yield rows, parts


def keys(rows: list[int], parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram key of every letter and word end, and the row it belongs to."""
    joined = "\n" + "\n".join(parts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = symbol_table()[points]
    of = np.repeat(np.array(rows, np.int64), [len(p) + 1 for p in parts])
    of = np.concatenate([of[:1], of])  # the first border goes with the first row
    stay = symbols != 0
    stay[1:] |= symbols[:-1] != 0
    stay[0] = True
    s = symbols[stay].astype(np.int32)
    of = of[stay]
    one = np.concatenate([[0], s[:-1]]).astype(np.int32)
    two = np.concatenate([[0], one[:-1]]).astype(np.int32) * (one != 0)
    three = np.concatenate([[0, 0], one[:-2]]).astype(np.int32)[: len(s)] * (two != 0)
    key = ((three << BITS | two) << BITS | one) << BITS | s
    asked = (s != 0) | (one != 0)
    return key[asked], of[asked]


def ngram_counts(labelled: DataFrame) -> DataFrame:
    """lang, key, n: how often each 4-gram occurs in the texts of each language."""

    def run(batches):
        for batch in few_rows(batches):
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for rows, parts in slices(texts):
                    key, n = np.unique(keys(rows, parts)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(n)],
                        ["lang", "key", "n"],
                    )

    each = labelled.select("lang", "text").mapInArrow(run, "lang string, key int, n long")
    return each.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def _lower(key: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Dense probabilities of one order from the distinct keys of the order above.

    `key` holds the distinct longer n-grams; what counts is how many symbols precede each.
    """
    size = len(below) * SYMBOLS
    seen = np.bincount(key % size, minlength=size).astype(np.float64)
    table_ = seen.reshape(-1, SYMBOLS)  # a row per history
    cut = _discount(seen)
    total = table_.sum(1, keepdims=True)
    kinds = (table_ > 0).sum(1, keepdims=True)
    rest = np.tile(below.reshape(-1, SYMBOLS), (len(table_) * SYMBOLS // len(below), 1))
    with np.errstate(invalid="ignore", divide="ignore"):
        p = (np.maximum(table_ - cut, 0) + cut * kinds * rest) / total
    return np.where(total > 0, p, rest).ravel()


@dataclass
class Model:
    langs: list[str]
    keys: np.ndarray  # sorted
    cost: np.ndarray  # per key and language; the last row is not used
    short_cost: np.ndarray  # of the last three symbols, per language
    left_cost: np.ndarray  # of a history's leftover weight, per language
    limits: np.ndarray | None = None  # per language: usual cost, spread by length, spread, factor

    def costs(self, key: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        out = self.cost[at]
        miss = np.flatnonzero(self.keys[at] != key)
        if len(miss):
            k = key[miss]
            out[miss] = self.left_cost[k >> BITS] + self.short_cost[k & (HISTORIES - 1)]
        return out

    def measure(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text, and its cost under each language."""
        n = np.zeros(len(texts))
        total = np.zeros((len(texts), len(self.langs)))
        for rows, parts in slices(texts):
            key, of = keys(rows, parts)
            n += np.bincount(of, minlength=len(texts))
            cost = self.costs(key)
            for lang in range(len(self.langs)):
                total[:, lang] += np.bincount(of, cost[:, lang], len(texts))
        return n, total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        if not self.langs or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        n, total = self.measure(texts)
        none = n == 0
        size = np.maximum(n, 1)
        each = total / size[:, None]
        best = each.argmin(1)
        least = each[np.arange(len(texts)), best]
        score = 1 / np.exp(-(each - least[:, None]) * np.sqrt(size)[:, None]).sum(1)
        reject = none.copy()
        if self.limits is not None:
            usual, by_length, spread, factor = self.limits[best].T
            excess = least - usual
            far = factor * np.sqrt(spread**2 + by_length**2 / size)
            reject |= (excess > far) & (excess > FLOOR * (np.log(SYMBOLS) - usual))
        langs = [UNKNOWN if none[i] else self.langs[b] for i, b in enumerate(best)]
        return langs, np.where(none, 0.0, score), reject


def build(counts: pa.Table) -> Model:
    """Kneser-Ney models from counted 4-grams (columns lang, key, n)."""
    names = counts.column("lang").to_numpy(zero_copy_only=False)
    key, n = counts.column("key").to_numpy(), counts.column("n").to_numpy()
    langs = sorted(set(names))
    union = np.unique(key).astype(np.int32)
    cost = np.zeros((len(union), len(langs)), np.float32)
    short_cost = np.zeros((HISTORIES, len(langs)), np.float32)
    left_cost = np.zeros((HISTORIES, len(langs)), np.float32)
    for i, lang in enumerate(langs):
        own = names == lang
        order = np.argsort(key[own], kind="stable")
        k, c = key[own][order].astype(np.int64), n[own][order].astype(np.float64)
        third = np.unique(k & (HISTORIES - 1))
        second = np.unique(third & (SYMBOLS**2 - 1))
        p = _lower(k, _lower(third, _unigram(second)))
        total = np.bincount(k >> BITS, c, HISTORIES)
        kinds = np.bincount(k >> BITS, minlength=HISTORIES)
        cut = _discount(c)
        with np.errstate(invalid="ignore", divide="ignore"):
            left = np.where(total > 0, cut * kinds / total, 1.0)
        full = left[union >> BITS] * p[union & (HISTORIES - 1)]
        at = np.searchsorted(union, k)
        full[at] += np.maximum(c - cut, 0) / total[k >> BITS]
        cost[:, i] = -np.log(full)
        short_cost[:, i] = -np.log(p)
        left_cost[:, i] = -np.log(left)
    return Model(langs, union, cost, short_cost, left_cost)


def _unigram(second: np.ndarray) -> np.ndarray:
    seen = np.bincount(second & (SYMBOLS - 1), minlength=SYMBOLS).astype(np.float64)
    kinds, total = (seen > 0).sum(), seen.sum()
    return (np.maximum(seen - 0.5, 0) + 0.5 * kinds / SYMBOLS) / total


def calibrate(model: Model, labelled: DataFrame, margin: float) -> None:
    """Set each language's limit of rejection from all of its rows, by two aggregations.

    The usual cost and its spread come first, then how far the worst of a thousand rows lies off:
    a single row, junk or not, does not move the limit.
    """

    def run(batches):
        for batch in few_rows(batches):
            n, total = model.measure(batch.column(1).to_pylist())
            of = [model.langs.index(x) for x in batch.column(0).to_pylist()]
            own = total[np.arange(len(n)), of] if len(n) else n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(own)], ["lang", "n", "cost"]
            )

    measured = labelled.select("lang", "text").mapInArrow(run, "lang string, n double, cost double")
    measured = materialise(measured.filter("n > 0"), "costs")
    usual = measured.groupBy("lang").agg(
        (F.sum("cost") / F.sum("n")).alias("usual"), F.percentile_approx("n", 0.5).alias("half")
    )
    off = measured.join(F.broadcast(usual), "lang").withColumn("off", F.col("cost") / F.col("n") - F.col("usual"))
    spreads = off.groupBy("lang").agg(
        # The median of a chi-square variable of one degree is 0.455.
        (F.sqrt(F.percentile_approx(F.col("off") * F.col("off") * F.col("n"), 0.5) / 0.455) + 1e-6).alias("by_length"),
        (F.coalesce(F.stddev_pop(F.when(F.col("n") >= F.col("half"), F.col("off"))), F.lit(0.0)) + 1e-6).alias("spread"),
    )
    far = F.col("off") / F.sqrt(F.col("spread") ** 2 + F.col("by_length") ** 2 / F.col("n"))
    found = (
        off.join(F.broadcast(spreads), "lang")
        .groupBy("lang")
        .agg(
            *[F.first(c).alias(c) for c in ("usual", "by_length", "spread")],
            F.percentile_approx(far, WORST, 100_000).alias("most"),
        )
        .collect()
    )
    limits = np.tile([0.0, 0.0, 0.0, np.inf], (len(model.langs), 1))
    for r in found:  # a row for each language
        limits[model.langs.index(r["lang"])] = (
            r["usual"], r["by_length"], r["spread"], max(6.0, margin * r["most"])
        )
    model.limits = limits


def train(docs: DataFrame, margin: float = 2.0) -> Model:
    """Models from every row that has a language and is not held out."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    )
    model = build(ngram_counts(labelled).toArrow())
    if model.langs:
        calibrate(model, labelled, margin)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` with lang_pred, score and rejected; columns of these names are replaced."""
    from pyspark.sql.types import (
        BooleanType, DoubleType, StringType, StructField, StructType,
    )

    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", "rejected")]
    where = [f.name for f in kept].index("text")
    names = [f.name for f in kept] + ["lang_pred", "score", "rejected"]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in few_rows(batches):
            langs, score, reject = sent.value.predict(batch.column(where).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(langs, pa.string()),
                    pa.array(score),
                    pa.array(reject),
                ],
                names,
            )

    schema = StructType(
        [
            *kept,
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
            StructField("rejected", BooleanType()),
        ]
    )
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose text is in one of the languages learned from `docs`."""
    return identify(docs, train(docs)).filter("not rejected").select(*docs.columns)

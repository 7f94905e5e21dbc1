"""Quality rules as a ledger of bits: every rule runs once, policies are masks over the bits.

`ledger` measures each text and stores one bit per failed rule. A policy (version and rule
names) only compares bits, so a new policy or an ablation never reads a text again.

Rules for odd input: null and empty texts have no words (and so fail `few_words`); texts of
any length are measured whole; repeated rows each give a row; columns other than doc_id and
text are ignored; an empty table gives an empty ledger and ablations of no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import id_text, table

#: Fixed values of the contract.
WHITE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: A sorted long holds the high bits of a window's hash and, below, the window's position.
POSITION_BITS = 24
POSITION = (1 << POSITION_BITS) - 1


def _bind(value: Column, body) -> Column:
    """`body(value)` with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    flat = F.trim(F.translate(text, WHITE[:-1], " " * (len(WHITE) - 1)))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " +"))


def _covered(positions: Column) -> Column:
    """Distinct word positions in the three-word windows that begin at `positions`."""
    three = F.transform(positions, lambda p: F.array(p, p + 1, p + 2))
    return F.size(F.array_distinct(F.flatten(three))).cast("long")


def _same(words: Column, a: Column, b: Column) -> Column:
    equal = F.lit(True)
    for k in range(3):
        equal &= F.get(words, (a + k).cast("int")) == F.get(words, (b + k).cast("int"))
    return equal


def _by_value(words: Column) -> Column:
    """Repeated words by sorting the windows themselves; right for any text, but slower."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            *[F.get(words, i + k).alias(f"w{k}") for k in range(3)], i.cast("long").alias("at")
        ),
    )

    def repeated(rows: Column) -> Column:
        def like(row: Column, other: Column) -> Column:
            equal = [row[f"w{k}"].eqNullSafe(other[f"w{k}"]) for k in range(3)]
            return equal[0] & equal[1] & equal[2]

        marked = F.transform(
            rows,
            lambda row, k: F.when(
                like(row, F.get(rows, k - 1)) | like(row, F.get(rows, k + 1)), row["at"]
            ),
        )
        return _covered(F.filter(marked, lambda p: p.isNotNull()))

    return _bind(F.array_sort(windows), repeated)


def _repeats(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, first occurrences included."""
    none = F.lit(0).cast("long")
    hashes = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1),
        F.greatest(F.size(words) - 2, F.lit(0)),
    )

    def high(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS)

    def low(x: Column) -> Column:
        return x.bitwiseAND(F.lit(POSITION))

    def from_sorted(packed: Column) -> Column:
        clash = F.exists(
            F.transform(
                packed,
                lambda x, k: (high(x) == high(F.get(packed, k - 1)))
                & ~_same(words, low(x), low(F.get(packed, k - 1))),
            ),
            lambda bad: F.coalesce(bad, F.lit(False)),
        )
        marked = F.transform(
            packed,
            lambda x, k: F.when(
                (high(x) == high(F.get(packed, k - 1))) | (high(x) == high(F.get(packed, k + 1))),
                low(x),
            ),
        )
        fast = _covered(F.filter(marked, lambda p: p.isNotNull()))
        return F.when(clash, _by_value(words)).otherwise(fast)

    def from_hashes(found: Column) -> Column:
        packed = F.array_sort(
            F.transform(
                found,
                lambda x, i: F.shiftleft(high(x), POSITION_BITS).bitwiseOR(i.cast("long")),
            )
        )
        return (
            F.when(F.size(F.array_distinct(found)) == F.size(found), none)
            .when(F.size(found) > POSITION, _by_value(words))
            .otherwise(_bind(packed, from_sorted))
        )

    return F.when(F.size(words) < 4, none).otherwise(_bind(hashes, from_hashes))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, WHITE[:-1], " " * 5)) != "")
    counted = _bind(
        _words(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            _repeats(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.translate(F.lower(w), LOWER, "") != w))
            .cast("long")
            .alias("n_letter_words"),
        ),
    )
    line_counts = _bind(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )

    def without(letters: str) -> Column:
        return F.length(F.translate(text, letters, "")).cast("long")

    return (
        id_text(docs)
        .select(
            "doc_id",
            counted.alias("w"),
            line_counts.alias("l"),
            without(WHITE).alias("word_chars"),
            (F.length(text) - without(SYMBOLS)).alias("n_symbols"),
            (F.length(text) - without(UPPER)).alias("n_upper"),
            (F.length(text) - without(LOWER)).alias("n_lower"),
        )
        .select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_lower")
    )


#: Every rule: its name and when a text fails it. The place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("repeated_lines", "n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines"),
    ("upper_case", "10 * n_upper > 3 * (n_upper + n_lower)"),
    ("without_letters", "10 * n_letter_words < 6 * n_words"),
    ("somewhat_repeated", "100 * n_repeat_words > 30 * n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Which rules drop a text."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[name] for name in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy(
    "2",
    (*BASE.rules, "short_words", "long_words", "symbols", "repeated_lines", "upper_case", "without_letters"),
)


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and `fail_bits`: a bit for every rule that the text fails."""
    bits = " | ".join(f"IF({test}, {BIT[name]}L, 0L)" for name, test in RULES)
    return measures(docs).withColumn("fail_bits", F.expr(bits))


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """For every rule of a policy: rows that fail it, that fail only it, and kept without it.

    Rows shrink to one per pattern of bits before anything else, at most 2^rules of them.
    """
    mask = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    patterns = ledger.groupBy(mask.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules]
    )
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    only = F.col("bits") == F.col("bit")
    rest = F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0
    return each.groupBy(F.lit(policy.version).alias("policy"), "rule").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(only, F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(rest, F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.sum("n").alias("n_rows"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passes(BASE) & passes(STRICT)
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"), kept.alias("kept"), "fail_bits",
    )


ORACLE_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT row_no, unnest(range(1, len(words) - 1)) AS place, words FROM cut WHERE len(words) > 2
), shown AS (
  SELECT row_no, place,
         count(*) OVER (PARTITION BY row_no, words[place], words[place + 1], words[place + 2]) AS n
  FROM windows
), repeated AS (
  SELECT row_no, count(DISTINCT place + k) AS n
  FROM (SELECT row_no, place, unnest([0, 1, 2]) AS k FROM shown WHERE n > 1) GROUP BY row_no
), measured AS (
  SELECT doc_id, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(repeated.n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
         len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]') OR lower(w) <> w)) AS n_letter_words
  FROM cut LEFT JOIN repeated USING (row_no)
), counted AS (
  SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM measured
), bits AS (
  SELECT *, {bits} AS fail_bits FROM counted
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       (fail_bits & {mask}) = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM bits
""".replace(
    "{bits}", " | ".join(f"(CASE WHEN {test} THEN {BIT[name]} ELSE 0 END)" for name, test in RULES)
).replace("{mask}", str(BASE.mask | STRICT.mask))

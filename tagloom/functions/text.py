"""Text functions as native column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tagloom import fixed
from tagloom.params import Tokenizer


def strip(col: Column | str) -> Column:
    """Remove white space, Unicode included, from both ends."""
    return F.btrim(col, F.lit(fixed.WHITE_SPACE))


def token_count(col: Column | str) -> Column:
    """Number of tokens: each run of ASCII letters or digits, each other visible character.

    One replacement pass keeps one character per token, so the length of what
    is left is the count; no array of tokens is built.
    """
    one_per_token = F.regexp_replace(
        col, r"([A-Za-z0-9])[A-Za-z0-9]*|[\x09-\x0d\x20]+", "$1"
    )
    return F.length(one_per_token)


def with_token_count(
    df: DataFrame, text: str, out: str = "tokens", tokenizer: Tokenizer | None = None
) -> DataFrame:
    """Add a token count; `tokenizer` replaces the estimate by an exact batch counter.

    The counter runs under mapInPandas, so a later filter on the count cannot
    make it run twice.
    """
    if tokenizer is None:
        return df.withColumn(out, token_count(text))
    names = [*df.columns, out] if out not in df.columns else df.columns
    schema = df.withColumn(out, F.lit(0)).select(names).schema

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            filled = pdf[text].notna()
            pdf[out] = 0
            pdf.loc[filled, out] = tokenizer(pdf.loc[filled, text].tolist())
            yield pdf[names]

    return df.mapInPandas(count, schema)


def token_filter(
    df: DataFrame, text: str, max_tokens: int, tokenizer: Tokenizer | None = None
) -> DataFrame:
    """Keep rows of at most `max_tokens` tokens, with the count in `tokens`.

    The count is made inside a one-element array that is filtered and unfolded:
    a plain filter on it would be pushed below the projection and count twice.
    """
    if tokenizer is not None:
        return with_token_count(df, text, tokenizer=tokenizer).filter(F.col("tokens") <= max_tokens)
    counted = F.array(F.struct(token_count(text).alias("tokens")))
    kept = F.filter(counted, lambda c: c["tokens"] <= max_tokens)
    return df.select(*[c for c in df.columns if c != "tokens"], F.inline(kept))


def truncate_text(col: Column | str, max_tokens: int | None) -> Column:
    """Cut to six characters per token, at a space when one is close to the end."""
    text = F.col(col) if isinstance(col, str) else col
    if max_tokens is None:
        return text
    limit = max_tokens * fixed.CHARS_PER_TOKEN
    cut = F.substring(text, 1, limit)
    last_space = F.lit(limit) - F.locate(" ", F.reverse(cut))
    has_space = F.locate(" ", cut) > 0
    at_word = F.when(
        has_space & (last_space > limit * fixed.KEEP_FRACTION),
        F.substring(cut, F.lit(1), last_space),
    ).otherwise(cut)
    return F.when(F.length(text) <= limit, text).otherwise(at_word)


def split_lines(df: DataFrame, text: str, line: str = "line", line_no: str = "line_no") -> DataFrame:
    """One row per non-blank line, stripped, numbered by its place in the text."""
    lines = F.transform(F.split(text, "\n"), strip)
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(lines).alias(line_no, line)).filter(F.length(line) > 0)


def clean_objective(col: Column | str) -> Column:
    """Drop a leading list number, outer white space, and leading dashes and spaces."""
    return F.ltrim(strip(F.regexp_replace(col, fixed.LIST_NUMBER_PATTERN, "")), F.lit("- "))


def heading_words(col: Column | str) -> Column:
    """How many different heading words occur in a line."""
    text = F.col(col) if isinstance(col, str) else col
    hits = [F.contains(text, F.lit(word)).cast("int") for word in fixed.HEADING_WORDS]
    return sum(hits[1:], hits[0])


def is_objective(col: Column | str) -> Column:
    """True for lines that are not headings."""
    return heading_words(col) < fixed.HEADING_WORD_LIMIT


def path_stem(col: Column | str) -> Column:
    """Last component of a path without its suffix."""
    return F.regexp_extract(col, fixed.STEM_PATTERN, 1)

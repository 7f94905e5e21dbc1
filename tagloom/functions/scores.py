"""Scores: from replies to numbers, from numbers to tags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tagloom import fixed
from tagloom.functions.text import strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_reply(col: Column | str) -> Column:
    """Strip, then one line."""
    return F.replace(strip(col), F.lit("\n"), F.lit(" "))


def parse_score(col: Column | str) -> Column:
    """Number after `Score: `, else the smallest whole number from 0 to 100, else NULL."""
    reply = _col(col)
    labelled = F.nullif(F.regexp_extract(reply, fixed.SCORE_PATTERN, 1), F.lit("")).cast("int")
    numbers = F.regexp_extract_all(reply, F.lit(fixed.NUMBER_PATTERN), F.lit(1))
    return F.coalesce(labelled, F.array_min(F.transform(numbers, lambda n: n.cast("int"))))


def fill_score(col: Column | str) -> Column:
    """Missing scores count as 0."""
    return F.coalesce(_col(col), F.lit(0))


def relevance_suffix(
    score: Column | str,
    high: int = fixed.HIGH_CUTOFF,
    medium: int = fixed.MEDIUM_CUTOFF,
    minimal: int = fixed.MINIMAL_CUTOFF,
) -> Column:
    """Tag suffix of a score, NULL below the lowest cutoff."""
    whole = _col(score).cast("int")
    return (
        F.when(whole >= high, fixed.HIGH_SUFFIX)
        .when(whole >= medium, fixed.MEDIUM_SUFFIX)
        .when(whole >= minimal, fixed.MINIMAL_SUFFIX)
    )


def append_tag(tags: Column | str, new_tag: Column | str) -> Column:
    """Tags with one more at the end, set off by a space on either side."""
    return F.concat(_col(tags), F.lit(" "), _col(new_tag), F.lit(" "))

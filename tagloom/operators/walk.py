"""Cut-offs along a ranking: a token budget and a run of poor matches.

The walk goes down the ranked notes of one objective and stops before a note
when the notes before it spent more than the budget or ended in (or contained)
a run of more than `max_poor` poor scores in a row. A NULL score is poor.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tagloom import fixed


def max_rated(token_budget: int, fixed_tokens: int) -> int:
    """Most notes a budget can reach when every prompt costs at least `fixed_tokens`."""
    return token_budget // fixed_tokens + 1


def _windows(by: Sequence[str], order: str):
    ranked = Window.partitionBy(*by).orderBy(order)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    upto = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked, before, upto


def bound_ranking(
    df: DataFrame, by: Sequence[str], order: str, token_budget: int, fixed_tokens: int
) -> DataFrame:
    """Keep the rows a budget can reach at all; exact, and cut before any shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    limit = max_rated(token_budget, fixed_tokens)
    return df.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")


def token_budget_cut(
    df: DataFrame, by: Sequence[str], order: str, token_budget: int, tokens: str = "prompt_tokens"
) -> DataFrame:
    """Keep rows whose predecessors spent at most the budget; adds `used_before`."""
    _, before, _ = _windows(by, order)
    used = F.coalesce(F.sum(tokens).over(before), F.lit(0)).cast("long")
    return df.withColumn("used_before", used).filter(F.col("used_before") <= token_budget)


def poor_run_cut(
    df: DataFrame, by: Sequence[str], order: str, max_poor: int, score: str = "score"
) -> DataFrame:
    """Keep rows before which no poor run exceeded the limit; adds `poor_run`, `worst_before`."""
    ranked, before, upto = _windows(by, order)
    place = F.row_number().over(ranked)
    good = F.max(F.when(F.col(score) > fixed.GOOD_SCORE, F.col("_place"))).over(upto)
    return (
        df.withColumn("_place", place)
        .withColumn("poor_run", F.col("_place") - F.coalesce(good, F.lit(0)))
        .withColumn("worst_before", F.coalesce(F.max("poor_run").over(before), F.lit(0)))
        .filter(F.col("worst_before") <= max_poor)
        .drop("_place")
    )


def walk_cut(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    token_budget: int,
    max_poor: int,
    tokens: str = "prompt_tokens",
    score: str = "score",
) -> DataFrame:
    """Both cut-offs over one sort: the rows a single walk would visit."""
    within = token_budget_cut(df, by, order, token_budget, tokens)
    return poor_run_cut(within, by, order, max_poor, score)


def walk_fold(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    token_budget: int,
    max_poor: int,
    fixed_tokens: int,
    tokens: str = "prompt_tokens",
    score: str = "score",
) -> DataFrame:
    """The same rows from one fold over each group's sorted array.

    The group is bounded first, so an array holds at most `max_rated` entries.
    """
    bounded = bound_ranking(df, by, order, token_budget, fixed_tokens)
    others = [c for c in df.columns if c not in (*by, order)]
    groups = bounded.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(order, *others))).alias("_rows")
    )
    start = F.struct(
        F.lit(0).cast("long").alias("used"), F.lit(0).alias("run"), F.lit(0).alias("kept")
    )

    def step(state, row):
        going = (state["used"] <= token_budget) & (state["run"] <= max_poor)
        good = F.coalesce(row[score] > fixed.GOOD_SCORE, F.lit(False))
        after = F.struct(
            (state["used"] + row[tokens]).cast("long").alias("used"),
            F.when(good, 0).otherwise(state["run"] + 1).alias("run"),
            (state["kept"] + 1).alias("kept"),
        )
        return F.when(going, after).otherwise(state)

    kept = F.aggregate("_rows", start, step, lambda s: s["kept"])
    return (
        groups.select(*by, F.inline(F.slice("_rows", F.lit(1), kept)))
        .select(*df.columns)
    )


def walk_lazy(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    token_budget: int,
    max_poor: int,
    rate,
    out_schema,
    tokens: str = "prompt_tokens",
    parallelism: int | None = None,
) -> DataFrame:
    """Rate along the walk and stop where it stops, so no rating goes to waste.

    With a poor run of length p behind it, a walk is certain to visit the next
    `max_poor + 1 - p` notes within the budget, so these are rated in one call.
    `rate` takes a frame of rows and returns it with `score` and further
    columns; `out_schema` is the schema of its result. The budget applies first
    and bounds the rows a task holds per group.
    """
    if parallelism:
        df = df.repartition(parallelism, *by)
    within = token_budget_cut(df, by, order, token_budget, tokens).drop("used_before")

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        done, run, at = [], 0, 0
        while at < len(group) and run <= max_poor:
            rated = rate(group.iloc[at : at + max_poor + 1 - run])
            for score in rated["score"]:
                run = 0 if pd.notna(score) and score > fixed.GOOD_SCORE else run + 1
            done.append(rated)
            at += len(rated)
        return pd.concat(done)[out_schema.names]

    return within.groupBy(*by).applyInPandas(walk, out_schema)

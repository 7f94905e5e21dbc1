"""Walks: window, fold and lazy forms against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from tagloom import fixed
from tagloom.operators import walk

SCHEMA = "obj int, rank int, prompt_tokens int, score int"


def plain_walk(rows, budget, max_poor):
    """How many (tokens, score) rows a walk visits."""
    used = run = kept = 0
    for tokens, score in rows:
        if run > max_poor or used > budget:
            break
        used += tokens
        run = 0 if score is not None and score > fixed.GOOD_SCORE else run + 1
        kept += 1
    return kept


def groups_of(spark, lists):
    rows = [(o, i, t, s) for o, pairs in enumerate(lists) for i, (t, s) in enumerate(pairs, 1)]
    return spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA)


def counts(df):
    return {r["obj"]: (r["n"], r["last"]) for r in
            df.groupBy("obj").agg(F.count("*").alias("n"), F.max("rank").alias("last")).collect()}


@pytest.mark.parametrize("max_poor, scores, kept", [
    (3, [10, 20, 30, 40, 90], 4),
    (3, [10, 20, 51, 10, 20, 30, 40, 90], 7),
    (0, [50, 90], 1),
    (0, [51, 50, 90], 2),
    (1, [None, None, 90], 2),
])
def test_poor_run(spark, max_poor, scores, kept):
    df = groups_of(spark, [[(1, s) for s in scores]])
    assert walk.poor_run_cut(df, ["obj"], "rank", max_poor).count() == kept


def test_budget_keeps_the_crossing_row(spark):
    df = groups_of(spark, [[(30, 90), (31, 90), (5, 90)]])
    assert walk.token_budget_cut(df, ["obj"], "rank", 60).count() == 2
    assert walk.token_budget_cut(df, ["obj"], "rank", 61).count() == 3


def random_groups(seed, n=150):
    rng = random.Random(seed)
    score = lambda: rng.choice([None, 0, 30, 50, 51, 80, 100] + [10] * rng.randint(0, 8))
    return [[(rng.randint(10, 60), score()) for _ in range(rng.randint(1, 40))] for _ in range(n)]


@pytest.mark.parametrize("budget, max_poor", [(400, 3), (150, 10), (10_000, 2), (0, 0)])
def test_all_forms_agree(spark, budget, max_poor):
    lists = random_groups(budget + max_poor)
    df = groups_of(spark, lists).cache()
    want = {o: (n, n) for o, rows in enumerate(lists) if (n := plain_walk(rows, budget, max_poor))}
    assert counts(walk.walk_cut(df, ["obj"], "rank", budget, max_poor)) == want
    assert counts(walk.walk_fold(df, ["obj"], "rank", budget, max_poor, fixed_tokens=10)) == want

    asked = spark.sparkContext.accumulator(0)

    def rate(group):
        asked.add(len(group))
        return group.assign(score=group["score"])

    schema = T.StructType.fromDDL(SCHEMA)
    lazy = walk.walk_lazy(df, ["obj"], "rank", budget, max_poor, rate, schema, parallelism=4)
    assert counts(lazy) == want
    # No row beyond the walk was ever rated.
    assert asked.value == sum(n for n, _ in want.values())


def test_bound_is_exact(spark):
    lists = random_groups(5)
    df = groups_of(spark, lists)
    bounded = walk.bound_ranking(df, ["obj"], "rank", 200, fixed_tokens=10)
    assert counts(walk.token_budget_cut(bounded, ["obj"], "rank", 200)) == counts(
        walk.token_budget_cut(df, ["obj"], "rank", 200)
    )

"""Column functions on edge rows, and against plain Python on random text."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tagloom import fixed
from tagloom.backends import TOKEN
from tagloom.functions import prompts, scores, text, vectors
from tagloom.operators.inference import _score, _truncate


def apply(spark, values, expression, type="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type}")
    return [r[0] for r in rows.repartition(2).select("i", expression.alias("y")).orderBy("i").select("y").collect()]


def check(spark, cases, expression, type="string"):
    assert apply(spark, list(cases), expression, type) == list(cases.values())


def test_clean_objective(spark):
    check(spark, {
        "1. - What is x": "What is x", "- 2. What": "2. What", "12.What": "What",
        "1)": "1)", "1.": "", "--  -a": "a",
    }, text.clean_objective("x"))


def test_headings(spark):
    check(spark, {
        "Learning Objective": False, "Learning to walk": True, "learning objective": True,
        "Summary Summary": True, "Questions, Additional": False,
    }, text.is_objective("x"))


def test_truncate(spark):
    near, far = "a" * 481 + " " + "b" * 300, "a" * 480 + " " + "b" * 300
    check(spark, {
        near: near[:481], far: far[:600], "c" * 700: "c" * 600, "d e" * 200: "d e" * 200,
        "é" * 590 + " " + "è" * 100: "é" * 590,
    }, text.truncate_text("x", 100))
    assert apply(spark, [near], text.truncate_text("x", None)) == [near]


def test_parse_score(spark):
    check(spark, {
        "Score: 85": 85, "Score: 1234": 123, "85/100": 85, "100": 100, "7.5": 5,
        "score 90 of 0 to 100": 0, "150": None, "n/a": None, "**Score:** 90": 90,
        "Score:90 Score: 40": 40, "x85y": None, "é85": None, "": None,
    }, scores.parse_score("x"))
    check(spark, {"  Score:\n85 \n": 85}, scores.parse_score(scores.normalise_reply("x")))


def test_buckets_and_tags(spark):
    high, mid, low = fixed.HIGH_SUFFIX, fixed.MEDIUM_SUFFIX, fixed.MINIMAL_SUFFIX
    check(spark, {100.0: high, 70.0: high, 69.9: mid, 40.0: mid, 39.0: low, 10.0: low, 9.9: None},
          scores.relevance_suffix("x"), "double")
    new = F.concat(F.lit("lec1"), scores.relevance_suffix(F.lit(80)))
    check(spark, {"": " lec1::1_highly_relevant ", None: None}, scores.append_tag("x", new))


def test_budgets(spark):
    edge = 1000 - 100 - 100  # prompt tokens that leave exactly the buffer
    check(spark, {edge: True, edge + 1: False}, prompts.fits_strict("x", 1000, 100), "int")
    check(spark, {edge: 100, edge + 1: 100, edge - 1: 101}, prompts.remaining_clamped("x", 1000, 100), "int")


def test_prompts_are_additive(spark):
    card = "Q: what? A: 42 — α"
    tokens = prompts.prompt_tokens(prompts.rating_prompt(F.lit("Why so?"), "x"))
    got = apply(spark, [card], tokens)[0]
    parts = len(TOKEN.findall("Why so?")) + len(TOKEN.findall(card))
    assert got == prompts.rating_fixed_tokens() + parts
    made = apply(spark, [card], prompts.prompt_tokens(prompts.generation_prompt("x")))[0]
    assert made == prompts.generation_fixed_tokens() + len(TOKEN.findall(card))


def test_path_stem(spark):
    check(spark, {
        "/a/b/lec 1.pdf": "lec 1", "lec": "lec", "/a/.hidden": ".hidden", "a.tar.gz": "a.tar",
        "/a/b/": "b", "/a/x.": "x.",
    }, text.path_stem("x"))


def test_vectors(spark):
    check(spark, {"[0.1, 0.2]": [0.1, 0.2], "emb": None, "[]": []}, vectors.parse_vector("x"))
    three_four = F.array(F.lit(3.0), F.lit(4.0))
    assert apply(spark, [[4.0, 3.0]], vectors.dot("x", three_four), "array<double>") == [24.0]
    assert apply(spark, [[4.0, 3.0], [0.0, 0.0]], vectors.cosine_similarity("x", three_four),
                 "array<double>") == [pytest.approx(0.96), None]


TEXTS = st.lists(
    st.text(alphabet=st.sampled_from(list("ab1 9.-\t\n\x0b\x1c  é漢😀_/:")) , max_size=60),
    min_size=30, max_size=30,
)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(TEXTS)
def test_text_functions_equal_python(spark, texts):
    assert apply(spark, texts, text.token_count("x")) == [len(TOKEN.findall(t)) for t in texts]
    assert apply(spark, texts, text.strip("x")) == [t.strip() for t in texts]
    assert apply(spark, texts, text.truncate_text("x", 4)) == [_truncate(t, 4) for t in texts]
    cleaned = [re.sub(r"^[0-9]+\.", "", t).strip().lstrip("- ") for t in texts]
    assert apply(spark, texts, text.clean_objective("x")) == cleaned


@SLOW
@given(st.lists(st.text(alphabet=st.sampled_from(list("Score: 0159/.x\n")), max_size=25), min_size=40, max_size=40))
def test_scores_equal_python(spark, replies):
    found = apply(spark, replies, scores.parse_score(scores.normalise_reply("x")))
    assert found == [_score(r) for r in replies]


def test_token_filter_and_tokenizer(spark):
    rows = spark.createDataFrame([("a", "one two"), ("b", "one two three"), ("c", "")], "guid string, card string")
    kept = text.token_filter(rows, "card", 2)
    assert sorted((r["guid"], r["tokens"]) for r in kept.collect()) == [("a", 2), ("c", 0)]
    by_length = text.token_filter(rows, "card", 7, tokenizer=lambda texts: [len(t) for t in texts])
    assert sorted((r["guid"], r["tokens"]) for r in by_length.collect()) == [("a", 7), ("c", 0)]

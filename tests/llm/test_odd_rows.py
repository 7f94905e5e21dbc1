"""Null, empty, long, repeated rows, clashing columns and empty tables, in every operator."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tagloom.llm import (
    bpe, chat, decontaminate, jaccard_join, language_id, periodic_runs, pii, quality, rule_ensemble, sharding,
    token_output, toxicity,
)

BENCH = "item_id long, text string, n_words int"


def bench(spark, empty=False):
    texts = [(1, "the same text of more than five words"), (1, None), (2, ""), (3, "漢字")]
    rows = [] if empty else [(*r, 5) for r in texts]
    return spark.createDataFrame(rows, BENCH)


def labels(spark):
    return spark.createDataFrame([(6, 1, 1), (6, 1, 0), (4, 1, 0), (99, None, None)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "jaccard": lambda s, d: jaccard_join.join(d),
    "quality": lambda s, d: quality.ledger(d),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.train(d, labels(s))),
    "language": lambda s, d: language_id.identify(d, language_id.train(d)),
    "sharding": lambda s, d: sharding.assign(d),
    "decontaminate": lambda s, d: decontaminate.contamination(d, bench(s)),
    "pii": lambda s, d: pii.annotate(d),
    "bpe": lambda s, d: bpe.round_trip(d),
    "periodic": lambda s, d: periodic_runs.detect(d),
    "rules": lambda s, d: rule_ensemble.score(d, rule_ensemble.train(d, labels(s))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_row(spark, odd_docs, name):
    found = OPERATORS[name](spark, odd_docs).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in odd_docs.collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_rows(spark, no_docs, name):
    assert OPERATORS[name](spark, no_docs).collect() == []


def test_odd_results(spark, odd_docs):
    by_id = lambda df: {r["doc_id"]: r for r in df.collect()}
    words = by_id(quality.ledger(odd_docs))
    assert [words[i]["n_words"] for i in (1, 2, 3, 4)] == [0, 0, 0, 30_000]
    assert words[12]["n_repeat_words"] == 30_000
    links = by_id(jaccard_join.join(odd_docs))
    assert (links[7]["class_id"], links[7]["n_links"]) == (6, 2)
    assert (links[9]["class_id"], links[9]["n_links"]) == (8, 1)
    assert all(links[i]["class_id"] == i and links[i]["n_links"] == 0 for i in (1, 2, 3, 4))
    langs = by_id(language_id.identify(odd_docs, language_id.train(odd_docs)))
    assert all(langs[i]["lang_pred"] == "und" and langs[i]["score"] == 0 for i in (1, 2, 3, 12))
    found = by_id(pii.annotate(odd_docs))
    assert {s["kind"] for s in found[10]["base"]} == {"email", "ip", "card", "phone"}
    hits = by_id(decontaminate.contamination(odd_docs, bench(spark)))
    assert hits[6]["n_hit"] == 8 and hits[11]["items"] == ["3"] and hits[1]["n_words"] == 0
    none = decontaminate.contamination(odd_docs, bench(spark, empty=True))
    assert none.filter("n_hit > 0").count() == 0
    tokens = by_id(bpe.round_trip(odd_docs))
    assert tokens[1]["n_tokens"] == tokens[2]["n_tokens"] == 0


def test_token_output(spark, odd_docs, no_docs):
    rows = token_output.in_training_order(odd_docs).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in odd_docs.collect() if r["text"]}
    assert token_output.in_training_order(no_docs).collect() == []


def test_stages(spark, odd_docs, no_docs, tmp_path):
    bench(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, str(tmp_path))
            assert kept.columns == docs.columns
            kept.collect()


def test_messages(spark):
    schema = "conv_id long, turn long, role string, text string, name string"
    rows = [(None, 0, "user", None, "x"), (1, 0, "user", "", "x"), (1, 1, "assistant", "yes", "x"),
            (1, 1, "assistant", "yes", "x"), (2, None, None, "w " * 9000, "x")]
    for some in (rows, []):
        df = spark.createDataFrame(some, schema)
        plain, said = chat.from_turns(df), chat.from_json(df)
        got = chat.link(plain[0].unionByName(said[0]), plain[1].unionByName(said[1])).collect()
        assert len(got) == len(some) and len(got) == 0 or {r["linked"] for r in got} == {True, False}


def test_near_copies_with_repeated_and_null_ids(spark):
    a = " ".join(f"a{i}" for i in range(60))
    near, other, third = a + " tail", " ".join(f"o{i}" for i in range(30)), " ".join(f"t{i}" for i in range(30))
    rows = [(1, a), (1, a), (2, near), (2, other), (None, a), (None, near + " "), (None, third), (None, third), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"]) for r in jaccard_join.join(df).collect())
    assert got == [(0, 0, 1), (0, 0, 1), (0, 1, 4), (0, 1, 4), (1, 1, 4), (1, 1, 4), (2, 1, 4), (2, 2, 0), (3, 3, 0)]
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.one_per_class(df).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (2, other), (None, third), (3, None)], key=str)


def test_no_message_vanishes(spark):
    rows = [
        ("1", 0, "user", "{x} what is this"), ("1", 1, "assistant", "{an answer"),
        ("2", 1, "assistant", "to nobody"), ("2", 4, "tool", '{"tool_call_id": "z", "content": "lost"}'),
        ("3", 0, "user", "one of two calls"), ("3", 0, "user", "two of two calls"), ("3", 1, "assistant", "both"),
        (None, 0, "user", "first of no conversation"), (None, 0, "user", "second of no conversation"),
        (None, 1, "assistant", "whose answer"), ("4", 0, "user", '{"plain": "json of no tool"}'),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    plain, said = chat.from_turns(df), chat.from_json(df)
    got = chat.link(plain[0].unionByName(said[0]), plain[1].unionByName(said[1])).collect()
    made = [(r["conv"], r["call_id"], r["name"], r["linked"], r["errors"]) for r in got]
    repeated, nowhere = "identifier: repeated by calls", "conversation: missing"
    assert sorted(made, key=str) == sorted([
        ("1", "1-0", "ask", True, ""),
        ("2", "2-0", None, False, "call: missing"), ("2", "z", None, False, "call: missing"),
        ("3", "3-0", "ask", True, repeated), ("3", "3-0", "ask", True, repeated),
        ("", "-0", "ask", False, f"result: missing; {nowhere}"), ("", "-0", "ask", False, f"result: missing; {nowhere}"),
        ("", "-0", None, False, f"call: missing; {nowhere}"), ("4", "4-0", "ask", False, "result: missing"),
    ], key=str)
    shown = " ".join(r["json"] for r in got)
    for text in ("{x} what", "{an answer", "to nobody", "lost", "one of", "two of", "first of", "second of", "whose"):
        assert text in shown

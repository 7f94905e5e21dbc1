"""Model calls: batching, retries, errors, the temperature ladder."""

import pytest
from pyspark.sql import functions as F

from tagloom import fixed
from tagloom.functions import prompts
from tagloom.operators import inference


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string").coalesce(1)


def test_embed_in_batches(spark):
    calls = spark.sparkContext.accumulator(0)

    def backend(batch):
        calls.add(1)
        return [[float(len(t))] for t in batch]

    rows = inference.embed(texts(spark, "a", "bb", None, "cccc", "x" * 9), "t", backend, batch_size=2).collect()
    assert [r["emb"] for r in rows] == [[1.0], [2.0], None, [4.0], [9.0]]
    assert all(r["emb_error"] is None for r in rows) and calls.value == 2


def test_one_bad_text_spoils_no_batch(spark):
    def backend(batch):
        if any("bad" in t for t in batch):
            raise RuntimeError("quota")
        return [[1.0] for _ in batch]

    rows = inference.embed(texts(spark, "a", "bad", "c"), "t", backend, attempts=2, wait=0.0).collect()
    assert [(r["emb"], r["emb_error"]) for r in rows] == [
        ([1.0], None), (None, "RuntimeError: quota"), ([1.0], None),
    ]


def test_every_text_is_tried_alone_before_it_fails(spark):
    calls = spark.sparkContext.accumulator(0)

    def backend(batch):
        calls.add(1)
        if any("bad" in t for t in batch):
            raise RuntimeError(f"refused {next(t for t in batch if 'bad' in t)}")
        return [[1.0] for _ in batch]

    found = inference.embed(
        texts(spark, "bad1", "bad2", "bad3", "ok1", "ok2", *"abcdefghijk"), "t", backend, attempts=1, wait=0.0
    ).collect()
    assert [r["emb_error"] for r in found[:3]] == [f"RuntimeError: refused bad{i}" for i in (1, 2, 3)]
    assert all(r["emb"] == [1.0] and r["emb_error"] is None for r in found[3:])
    assert calls.value < 16


def test_a_service_that_is_down_gets_waits(monkeypatch):
    waits = []
    monkeypatch.setattr(inference.time, "sleep", waits.append)

    def down(items):
        raise ConnectionError("down")

    results, errors = inference._batched([1, 2, 3, 4], down, 4, 2, 5.0, 0.0, lambda item: down([item]))
    assert results == [None] * 4 and errors == ["ConnectionError: down"] * 4
    assert len(waits) >= 3 and set(waits) == {5.0}


def test_overflow_is_tried_once_at_half(spark):
    seen = spark.sparkContext.accumulator(0)

    def backend(batch):
        seen.add(1)
        if any(len(t) > 3200 for t in batch):
            raise ValueError("input exceeds the context length")
        return [[float(len(t))] for t in batch]

    long = texts(spark, "x" * 9000)
    row = inference.embed(long, "t", backend, max_tokens=768, attempts=1, wait=0.0).first()
    assert row["emb"] == [512 * 6.0] and row["emb_error"] is None
    row = inference.embed(long, "t", backend, max_tokens=1200, attempts=1, wait=0.0).first()
    assert row["emb"] is None and "exceeds" in row["emb_error"]  # half of 1200 is still too long
    at_floor = inference.embed(long, "t", backend, max_tokens=512, attempts=1, wait=0.0).first()
    assert at_floor["emb"] == [512 * 6.0]


def test_wrong_number_of_results(spark):
    row = inference.embed(texts(spark, "a"), "t", lambda batch: [], attempts=1, wait=0.0).first()
    assert row["emb"] is None and "0 results for 1" in row["emb_error"]


def asked(spark, *values):
    msgs = prompts.messages("system", F.col("t"))
    return texts(spark, *values).withColumn("prompt", msgs).withColumn("limit", F.lit(10))


def test_generate_passes_limits_and_temperature(spark):
    def chat(messages, temperature, limits):
        return [f"{m[0]['content']}/{m[1]['content']}/{temperature}/{n}" for m, n in zip(messages, limits)]

    row = inference.generate(asked(spark, "hi"), "prompt", chat, max_tokens="limit").first()
    assert row["reply"] == "system/hi/1.0/10" and row["reply_error"] is None


def test_ladder_asks_only_open_rows(spark):
    calls = spark.sparkContext.accumulator(0)

    def chat(messages, temperature, limits):
        calls.add(len(messages))
        return [
            "Score: 80" if float(m[1]["content"]) <= temperature else "no idea" for m in messages
        ]

    judge = inference.Judge(chat, wait=0.0)
    rows = inference.judge(asked(spark, "0", "0.5", "2"), "prompt", judge, max_tokens="limit").collect()
    assert [(r["gpt_reply"], r["attempts"]) for r in rows] == [
        ("Score: 80", 1), ("Score: 80", 3), ("no idea", 5),
    ]
    assert calls.value == 1 + 3 + 5


def test_judge_errors_stop_the_ladder(spark):
    def chat(messages, temperature, limits):
        raise ConnectionError("down")

    judge = inference.Judge(chat, attempts=2, wait=0.0, growth=0.0)
    row = inference.judge(asked(spark, "x"), "prompt", judge, max_tokens="limit").first()
    assert row["gpt_reply"] is None and row["rate_error"] == "ConnectionError: down" and row["attempts"] == 1


def test_waits_grow(monkeypatch):
    waits = []
    monkeypatch.setattr(inference.time, "sleep", waits.append)
    inference._with_retry(lambda: 1 / 0, 4, fixed.RATE_WAIT_SECONDS, fixed.RATE_WAIT_SECONDS)
    inference._with_retry(lambda: 1 / 0, 3, fixed.GENERATE_WAIT_SECONDS, 0.0)
    assert waits == [5.0, 10.0, 15.0, 10.0, 10.0]


def test_result_is_computed_once_per_row(spark):
    calls = spark.sparkContext.accumulator(0)

    def backend(batch):
        calls.add(len(batch))
        return [[1.0, 2.0] for _ in batch]

    found = inference.embed(texts(spark, "a", "b", "c"), "t", backend)
    found = found.withColumn("n", F.size("emb")).filter("n > 1").withColumn("m", F.col("n") + 1)
    assert found.count() == 3 and found.columns[-1] == "m"
    calls.value = 0
    found.collect()
    assert calls.value == 3

"""What a task holds at once, and what is written."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from tagloom.operators import inference, similarity


def test_a_scan_holds_few_scores():
    rng = np.random.default_rng(1)
    n, dim = 16_384, 8
    scan = similarity._Nearest(20, "obj_id", "emb", ["guid"], [], "dot", None, None, None)
    block = (pa.array(range(n)), rng.normal(size=(n, dim)), np.zeros(n, np.int32), np.full(n, -np.inf))
    notes = pa.RecordBatch.from_arrays(
        [pa.array(range(512)), pa.FixedSizeListArray.from_arrays(rng.normal(size=512 * dim), dim).cast(pa.list_(pa.float64()))],
        ["guid", "emb"],
    )
    tracemalloc.start()
    found = list(scan(block, iter([notes])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in found) == 20 * n
    assert peak < 120 << 20


def test_blocks_bound_what_a_task_keeps(spark, monkeypatch):
    passed = []
    monkeypatch.setattr(similarity, "_in_grid", lambda notes, objectives, blocks, *rest: passed.append(blocks))
    schema = "id long, emb array<double>"
    notes = spark.createDataFrame([(1, [1.0])], schema).withColumnRenamed("id", "guid")
    asked = spark.range(20_000).selectExpr("id AS obj_id", "array(double(id)) AS emb")
    similarity.topk_similar(notes, asked, 20)
    assert passed and 20_000 * 20 / passed[0] <= 1 << 18


class _Frame:
    """Takes the place of a frame, to call its function here."""

    schema = T.StructType([T.StructField("text", T.StringType())])

    def mapInArrow(self, run, schema):
        return run


def test_model_calls_hold_few_rows():
    called = []

    def backend(texts):
        called.append(len(texts))
        return [[float(len(t))] for t in texts]

    run = inference.embed(_Frame(), "text", backend, batch_size=200)
    batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(2_100)])], ["text"])
    found = list(run(iter([batch])))
    assert max(b.num_rows for b in found) <= inference.HELD_ROWS
    assert pa.Table.from_batches(found).column("emb").to_pylist() == [[float(len(str(i)))] for i in range(2_100)]
    assert called == [200] * 10 + [100]


def _near_one(spark):
    """A note near all of 300 objectives, and one near none."""
    notes = spark.createDataFrame(
        [("a", "near " * 9, 9, [1.0, 0.0]), ("b", "far", 1, [0.0, 1.0])], "guid string, card string, tokens int, emb array<double>"
    )
    asked = spark.range(300).selectExpr(
        "'t' AS name", "concat('objective ', id) AS learning_objective", "array(1.0D + id, 0.0D) AS emb"
    )
    return notes, asked


def test_replies_hold_no_texts(spark, monkeypatch):
    from tagloom.backends import HashJudge
    from tagloom.plans import jobs

    written = {}
    plain = jobs.materialise

    def materialise(df, label):
        written[label] = df.columns
        return plain(df, label)

    monkeypatch.setattr(jobs, "materialise", materialise)
    notes, asked = _near_one(spark)
    for mode in ("eager", "lazy"):
        written.clear()
        rated = jobs.select_pairs(notes, asked, inference.Judge(HashJudge()), jobs.SelectParams(mode=mode))
        cards = {(r["guid"], r["card"]) for r in rated.collect()}
        assert cards == {("a", "near " * 9), ("b", "far")}
        assert "card" not in written["replies"] and "card" not in written["candidates"]


def test_a_note_near_all_is_rated_in_several_tasks(spark):
    from pyspark.sql import functions as F

    from tagloom.plans import jobs

    notes, asked = _near_one(spark)
    found = jobs.find_candidates(notes, asked)
    dealt = jobs._with_texts(found.near, found, tasks=4)
    tasks = dealt.filter("guid = 'a'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 300 and len(tasks) > 1
    plain = jobs.candidate_pairs(notes, asked).select("obj_id", "guid", "card", "rank")
    assert sorted(dealt.select(plain.columns).collect()) == sorted(plain.collect())

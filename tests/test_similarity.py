"""Top-k against brute force: ties, copies, blocks, budgets, merge steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import similarity
from tagloom.operators.similarity import check_dims, topk_similar, with_objective_id

RNG = np.random.default_rng(7)


def frames(spark, notes, objectives, dim=8, copies=0.0, partitions=5):
    vectors = RNG.integers(-3, 4, (notes, dim)).astype(float)
    vectors[: int(notes * copies)] = 1.0  # one text copied many times
    tokens = RNG.integers(1, 60, notes)
    note_rows = [(f"g{i}", int(tokens[i]), vectors[i].tolist()) for i in range(notes)]
    asked = RNG.integers(-3, 4, (objectives, dim)).astype(float)
    objective_rows = [(i, int(RNG.integers(5, 30)), asked[i].tolist()) for i in range(objectives)]
    return (
        note_rows,
        objective_rows,
        spark.createDataFrame(note_rows, "guid string, tokens int, emb array<double>").repartition(partitions),
        spark.createDataFrame(objective_rows, "obj_id long, pair_tokens int, emb array<double>"),
    )


def brute(note_rows, objective_rows, k, budget=None, metric="dot"):
    want = set()
    for obj, price, o in objective_rows:
        def sim(n):
            s = float(np.dot(n, o))
            return s / (np.linalg.norm(n) * np.linalg.norm(o)) if metric == "cosine" else s
        ranked = sorted(note_rows, key=lambda r: (-sim(r[2]), r[0]))
        used = 0
        for rank, (guid, tokens, n) in enumerate(ranked[:k], 1):
            if budget is not None and used > budget:
                break
            want.add((obj, guid, round(sim(n), 6), rank))
            used += price + tokens
    return want


def got(df):
    return {(r["obj_id"], r["guid"], round(r["cosine_sim"], 6), r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("copies", [0.0, 0.4])
@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_equals_brute_force(spark, copies, block_bytes):
    note_rows, objective_rows, notes, objectives = frames(spark, 400, 12, copies=copies)
    found = topk_similar(notes, objectives, 9, block_bytes=block_bytes)
    assert got(found) == brute(note_rows, objective_rows, 9)


def test_small_batches_and_score_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "SCORE_CELLS", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        note_rows, objective_rows, notes, objectives = frames(spark, 300, 10, copies=0.3)
        assert got(topk_similar(notes, objectives, 7)) == brute(note_rows, objective_rows, 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_merge_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(similarity, "splits", lambda df: 10_000)
    note_rows, objective_rows, notes, objectives = frames(spark, 300, 5)
    found = topk_similar(notes, objectives, 6)
    assert got(found) == brute(note_rows, objective_rows, 6)


@pytest.mark.parametrize("copies", [0.0, 0.5])
def test_budget_leaves_nothing_out(spark, copies):
    from tagloom.operators.walk import token_budget_cut

    note_rows, objective_rows, notes, objectives = frames(spark, 500, 12, copies=copies)
    found = topk_similar(notes, objectives, 50, carry=["tokens"], budget=300)
    priced = found.join(objectives.select("obj_id", "pair_tokens"), "obj_id").withColumn(
        "prompt_tokens", F.col("tokens") + F.col("pair_tokens")
    )
    cut = token_budget_cut(priced, ["obj_id"], "rank", 300)
    assert got(cut) == brute(note_rows, objective_rows, 50, budget=300)
    assert found.count() < 12 * 50


def test_cosine(spark):
    note_rows, objective_rows, notes, objectives = frames(spark, 200, 6)
    note_rows = [r for r in note_rows if any(r[2])]
    objective_rows = [r for r in objective_rows if any(r[2])]
    ids = [r[0] for r in objective_rows]
    found = topk_similar(
        notes.filter("exists(emb, x -> x <> 0)"), objectives.filter(F.col("obj_id").isin(ids)),
        5, metric="cosine", decimals=9,
    )
    assert {x[:2] for x in got(found)} == {
        x[:2] for x in brute_rounded(note_rows, objective_rows, 5)
    }


def brute_rounded(note_rows, objective_rows, k):
    for obj, _, o in objective_rows:
        def sim(n):
            return round(float(np.dot(n, o)) / (np.linalg.norm(n) * np.linalg.norm(o)), 9)
        for guid, _, n in sorted(note_rows, key=lambda r: (-sim(r[2]), r[0]))[:k]:
            yield obj, guid


def test_rows_without_vectors_and_empty_sides(spark):
    notes = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", None), ("c", [])], "guid string, emb array<double>"
    )
    objectives = spark.createDataFrame([(1, [1.0, 1.0]), (2, None)], "obj_id long, emb array<double>")
    assert got(topk_similar(notes, objectives, 5)) == {(1, "a", 1.0, 1)}
    assert topk_similar(notes, objectives.filter("obj_id = 2"), 5).count() == 0
    assert topk_similar(notes.filter("guid = 'b'"), objectives, 5).count() == 0


def test_dimension_guard(spark):
    schema = "emb array<double>"
    two = spark.createDataFrame([([],), ([1.0, 2.0],)], schema)
    three = spark.createDataFrame([([1.0, 2.0, 3.0],)], schema)
    none = spark.createDataFrame([(None,), ([],)], schema)
    with pytest.raises(ValueError):
        check_dims(two, three)
    check_dims(two, none)
    check_dims(none, three, every_row=True)
    check_dims(two, two, every_row=True)
    with pytest.raises(ValueError):
        check_dims(two.unionByName(three), two, every_row=True)


def test_repeated_objectives_become_one(spark):
    rows = [("l", "why", [1.0]), ("l", "why", [1.0]), ("l", "why", [2.0])]
    objectives = spark.createDataFrame(rows, "name string, learning_objective string, emb array<double>")
    assert {r["copies"] for r in with_objective_id(objectives).collect()} == {1, 2}
    swapped = [("l", None, [1.0]), (None, "l", [1.0])]
    assert with_objective_id(spark.createDataFrame(swapped, objectives.schema)).count() == 2


def test_blocks_bounded_by_rows_to_keep(spark, monkeypatch):
    monkeypatch.setattr(similarity, "POOL_ROWS", 20)
    note_rows, objective_rows, notes, objectives = frames(spark, 200, 12, copies=0.5)
    found = topk_similar(notes, objectives, 7)
    assert got(found) == brute(note_rows, objective_rows, 7)


def test_grid_shuffles_notes_once(spark, tmp_path):
    note_rows, objective_rows, notes, objectives = frames(spark, 300, 40, partitions=3)
    notes.write.parquet(str(tmp_path / "notes"))
    stored = spark.read.parquet(str(tmp_path / "notes"))
    found = topk_similar(stored, objectives, 6, block_bytes=200)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1  # the notes, read once
    assert plan.count("Exchange") == 2  # notes with objectives, and the few rows that are ranked
    assert plan.count("MapInArrow") == 1
    assert got(found) == brute(note_rows, objective_rows, 6)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
@pytest.mark.parametrize("budget", [None, 300])
def test_starting_bar_changes_no_result(spark, monkeypatch, block_bytes, budget):
    monkeypatch.setattr(similarity, "tasks_for", lambda df: 8)
    monkeypatch.setattr(similarity, "SAMPLE_TASKS", 2)
    note_rows, objective_rows, notes, objectives = frames(spark, 600, 12, copies=0.3, partitions=8)
    options = {"budget": budget, "carry": ["tokens"]} if budget else {}
    found = topk_similar(notes, objectives, 15, block_bytes=block_bytes, start_tasks=1, **options)
    if budget is None:
        assert got(found) == brute(note_rows, objective_rows, 15)
    else:
        assert brute(note_rows, objective_rows, 15, budget=budget) <= got(found)


def test_starting_bar_spares_rows(spark, monkeypatch):
    """Of many tasks, a tenth of the rows leave the scan."""
    leaving = []
    keep_best = similarity._keep_best

    def counted(df, *options):
        leaving.append(df.count())
        return keep_best(df, *options)

    monkeypatch.setattr(similarity, "_keep_best", counted)
    monkeypatch.setattr(similarity, "tasks_for", lambda df: 64)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    notes = vectors.select(F.col("vec_id").alias("guid"), F.col("embedding").alias("emb")).repartition(64)
    notes = similarity.materialise(notes, "notes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task for each file
    try:
        asked = notes.filter("guid % 10 = 0").select(F.col("guid").alias("obj_id"), "emb")
        plain = got(topk_similar(notes, asked, 20, start_tasks=None))
        barred = got(topk_similar(notes, asked, 20, start_tasks=64))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert plain == barred
    assert leaving[-1] * 10 < leaving[0]


def test_different_objectives_of_one_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(similarity, "objective_id", lambda key=(), emb="": F.lit(5).cast("long"))
    rows = [("a", "x", [1.0], 1, 9), ("a", "x", [1.0], 1, 9), ("b", "x", [1.0], 2, 9), ("a", "y", [1.0], 3, 9)]
    df = spark.createDataFrame(rows, "name string, learning_objective string, emb array<double>, copies int, obj_id int")
    got = similarity.with_objective_id(df)
    assert got.columns == ["name", "learning_objective", "emb", "obj_id", "copies"]
    found = got.collect()
    assert sorted((r["name"], r["learning_objective"], r["copies"]) for r in found) == [
        ("a", "x", 2), ("a", "y", 1), ("b", "x", 1),
    ]
    assert len({r["obj_id"] for r in found}) == 3

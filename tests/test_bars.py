"""Rough products and bars for blocks: the same rows, with fewer that are scored or passed on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import similarity
from tagloom.operators.similarity import topk_similar
from tagloom.session import materialise

RNG = np.random.default_rng(11)


def vectors(spark, rows, names):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], f"{names} long, emb array<double>")


def ranked(notes, objectives, k):
    """Keys by exact products, ties to the smaller key; what is no number ranks last."""
    with np.errstate(all="ignore"):
        scores = np.stack([np.einsum("ij,ij->i", notes, np.broadcast_to(o, notes.shape)) for o in objectives])
    scores = np.where(np.isnan(scores), -np.inf, scores)
    return {(i, int(n)) for i, row in enumerate(scores) for n in np.lexsort((np.arange(len(row)), -row))[:k]}


def got(df):
    return {(r["obj_id"], r["guid"]) for r in df.collect()}


def close(n, dim):
    """Vectors that differ by less than single precision tells apart, and copies of them."""
    made = 1.0 + RNG.integers(0, 50, (n, dim)) * 2.0**-30
    made[n // 2 :] = made[: n - n // 2]
    return made


@pytest.mark.parametrize("block_bytes", [1 << 20, 6 << 10])
@pytest.mark.parametrize(
    "make",
    [
        lambda n, dim: RNG.normal(size=(n, dim)),
        close,
        lambda n, dim: RNG.normal(size=(n, dim)) * 1e-25,
        lambda n, dim: RNG.normal(size=(n, dim)) * 1e25,
        lambda n, dim: np.where(RNG.random((n, dim)) < 0.01, np.nan, RNG.integers(-3, 4, (n, dim))),
    ],
    ids=["plain", "close", "tiny", "huge", "nan"],
)
def test_rough_products_lose_no_row(spark, monkeypatch, make, block_bytes):
    monkeypatch.setattr(similarity, "FIRST_ROWS", 20)
    notes, objectives = make(900, 8), make(150, 8)
    found = topk_similar(
        vectors(spark, notes, "guid").repartition(3), vectors(spark, objectives, "obj_id"), 6, block_bytes=block_bytes
    )
    assert got(found) == ranked(notes, objectives, 6)


def test_rough_products_spare_double_ones(monkeypatch):
    """Of notes that follow a bar, only those near it are scored in double precision."""
    scored = []
    pair_scores, best = similarity._pair_scores, similarity._best_in_batch
    monkeypatch.setattr(similarity, "_pair_scores", lambda *a: scored.append(len(a[2])) or pair_scores(*a))
    monkeypatch.setattr(similarity, "_best_in_batch", lambda *a: scored.append(a[0].size) or best(*a))
    import pyarrow as pa

    def table(rows, key, **more):
        emb = pa.FixedSizeListArray.from_arrays(rows.ravel(), rows.shape[1]).cast(pa.list_(pa.float64()))
        return pa.table({key: np.arange(len(rows)), "emb": emb, **more})

    notes, asked = RNG.normal(size=(20_000, 16)), RNG.normal(size=(64, 16))
    scan = similarity._Nearest(5, "obj_id", "emb", ["guid"], [], "dot", None, None, None)
    block = scan.block(table(asked, "obj_id", _price=np.zeros(64), _bar=np.full(64, -np.inf)))
    out = [r for b in scan(block, iter(table(notes, "guid").to_batches())) for r in b.to_pylist()]
    assert {(r["obj_id"], r["guid"]) for r in out} == ranked(notes, asked, 5)
    assert sum(scored) * 10 < 20_000 * 64


def test_many_groups_are_merged_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(similarity, "MERGE_SPLITS", 4)
    notes = np.repeat(RNG.integers(-3, 4, (150, 4)), 4, axis=0).astype(float)
    found = topk_similar(
        vectors(spark, notes, "guid").repartition(5), vectors(spark, notes[::9], "obj_id"), 7, block_bytes=300
    )
    assert got(found) == ranked(notes, notes[::9], 7)
    ranks = found.filter("obj_id = 3").orderBy(F.desc("cosine_sim"), "guid").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 8))


@pytest.mark.parametrize("budget", [None, 200])
def test_blocks_start_from_a_bar(spark, monkeypatch, budget):
    """Groups pass on few rows more than the result has."""
    leaving = []
    merge = similarity._merge_lists

    def counted(df, *options):
        leaving.append(df.agg(F.sum(F.size("found"))).first()[0])
        return merge(df, *options)

    monkeypatch.setattr(similarity, "_merge_lists", counted)
    monkeypatch.setattr(similarity, "POOL_ROWS", 1000)
    raw = RNG.integers(-9, 10, (8000, 8)).astype(float)
    notes = vectors(spark, raw, "guid").withColumn("tokens", F.lit(20))
    notes = materialise(notes.repartition(8), "notes")
    asked = vectors(spark, raw[::40], "obj_id").withColumn("pair_tokens", F.lit(20))
    options = {"budget": budget, "carry": ["tokens"]} if budget else {}
    found = got(topk_similar(notes, asked, 20, **options))
    want = ranked(raw, raw[::40], 20 if budget is None else 6)
    assert want <= found if budget else want == found
    assert leaving[0] < 5 * len(want)  # with 8 groups and no bar, 8 times as many

"""Physical plans: what must be in them, and what must not."""

import pytest
from conftest import SF_DIR

from tagloom.operators import assign
from tagloom.plans.registry import QUERIES, note_table_view


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


CHEAP = [
    "assemble_text", "resume_anti", "largest_source", "token_filter", "objective_filter",
    "objective_counts", "parse_score", "dot_product", "sim_topk", "sim_rank",
]


@pytest.mark.parametrize("name", CHEAP)
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_topk_cuts_before_the_shuffle(spark):
    text = plan(QUERIES["sim_topk"](spark, SF_DIR))
    assert "row_number(), 20, Partial" in text
    assert text.index("row_number(), 20, Partial") > text.index("Exchange hashpartitioning(obj_id")


def test_best_row_cuts_before_the_shuffle_and_prunes_texts(spark, tmp_path):
    from tagloom import schemas

    spark.createDataFrame([], schemas.RATINGS).write.parquet(str(tmp_path / "ratings"))
    ratings = spark.read.parquet(str(tmp_path / "ratings"))
    text = plan(assign.tag_notes(note_table_view(spark, SF_DIR), ratings))
    assert "row_number(), 1, Partial" in text
    read = [line for line in text.splitlines() if "FileScan" in line and "objective" in line]
    assert len(read) == 1 and "card" not in read[0] and "gpt_reply" not in read[0]


def test_tokens_are_counted_once(spark):
    text = plan(QUERIES["token_filter"](spark, SF_DIR))
    assert text.count("regexp_replace(") == 1


def test_scans_read_only_needed_columns(spark):
    from tagloom.sources.readers import largest_candidate

    text = plan(largest_candidate(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "source"))
    assert "ReadSchema: struct<source:string>" in text
    assert "partial_count" in text


def test_ranking_reads_no_texts(spark):
    from tagloom.operators.similarity import topk_similar, with_objective_id
    from tagloom.plans.registry import embedded_notes, embedded_objectives
    from tagloom.session import materialise

    notes = materialise(embedded_notes(spark, SF_DIR), "notes")
    objectives = with_objective_id(embedded_objectives(spark, SF_DIR))
    ranked = topk_similar(notes, objectives, 5, note_key=["guid", "card_id"], carry=["tokens"])
    assert "ReadSchema: struct<guid:string,tokens:int,card_id:bigint,emb:array<double>>" in plan(ranked)

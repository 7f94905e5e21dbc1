"""Readers and sinks on edge rows."""

import pytest
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.session import new_folder
from tagloom.sources import readers, writers

EXPORT = "#separator:tab\ng1\tcard one\ng3\thas # inside\ng#2\tcard two\ng6\t\n\ng7\t\"two\nlines, \"\"x\"\"\"\tmore\ng8\tNA\n"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def export(tmp_path):
    path = tmp_path / "export.tsv"
    path.write_text(EXPORT)
    return str(path)


def test_notes_keep_hash_signs(spark, export):
    assert rows(readers.scan_notes(spark, export)) == [
        ("g#2", "card two"), ("g1", "card one"), ("g3", "has # inside"),
        ("g7", 'two\nlines, "x"'), ("g8", "NA"),
    ]


def test_null_tokens(spark, export):
    kept = readers.scan_notes(spark, export, null_tokens=["NA"])
    assert "g8" not in [g for g, _ in rows(kept)]


def test_inline_comments(spark, tmp_path):
    path = tmp_path / "export.tsv"
    path.write_text('#c\ng1\tcard one\ng3\thas # inside\ng#2\tcard two\ng4\t"a # b" # c\n')
    assert rows(readers.scan_notes(spark, str(path), inline_comments=True)) == [
        ("g1", "card one"), ("g3", "has "), ("g4", "a # b"),
    ]


def test_repeated_header_rows(spark, tmp_path):
    path = tmp_path / "vectors.csv"
    path.write_text(
        'name,learning_objective,tokens,emb\nl,"why, so",3,"[1.0, 2.5]"\n'
        "name,learning_objective,tokens,emb\nl,x,4.0,[]\nl,y,,\"[1]\"\n"
    )
    found = readers.scan_vectors(spark, str(path), schemas.OBJECTIVES)
    assert found.schema == schemas.OBJECTIVES
    assert rows(found) == [("l", "why, so", 3, [1.0, 2.5]), ("l", "x", 4, [])]


def test_ratings_csv(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text(
        "guid,card,tag,cosine_sim,gpt_reply,score,objective\n"
        "a,c,t,0.5,Score: 80,80,o\na,c,t,0.4,dunno,NA,o\n"
    )
    found = readers.scan_ratings(spark, str(path), format="csv")
    assert rows(found.select("score", "rank")) == [(0, -0.4), (80, -0.5)]


def test_documents_from_files(spark, tmp_path):
    (tmp_path / "lec 1.txt").write_text("a\nb")
    (tmp_path / "lec+2.txt").write_text("c")
    (tmp_path / "other.md").write_text("d")
    assert rows(readers.scan_documents(spark, str(tmp_path))) == [
        ("lec 1", "a"), ("lec 1", "b"), ("lec+2", "c"),
    ]
    assert rows(readers.scan_documents(spark, str(tmp_path / "lec 1.txt"), whole=True)) == [("lec 1", "a\nb")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.scan_documents(spark, str(tmp_path / "none"))


def note_table(spark, n):
    return spark.range(n).select("id", F.col("id").cast("string").alias("guid"), F.lit("").alias("tags"))


def test_largest_candidate_table(spark):
    paths = [new_folder(spark, "candidate") for _ in range(5)]
    for path, n in zip(paths[:3], (0, 5, 5)):
        note_table(spark, n).write.parquet(path)
    spark.range(9).write.parquet(paths[3])  # not a note table; paths[4] does not exist
    best, table = readers.read_largest(spark, paths)
    assert best == paths[1] and table.count() == 5
    with pytest.raises(FileNotFoundError):
        readers.read_largest(spark, [paths[0], paths[4]])


def test_append_new_and_write_once(spark):
    path = new_folder(spark, "sink")
    first = spark.createDataFrame([("a", 1), ("a", 2)], "name string, x int")
    second = spark.createDataFrame([("a", 9), ("b", 3), (None, 4)], "name string, x int")
    assert rows(writers.append_new(first, path)) == [("a", 1), ("a", 2)]
    assert writers.append_new(second, path).count() == 4
    assert writers.write_once(second, path).count() == 4


def test_scratch_folder_without_a_setting(spark, monkeypatch):
    from tagloom import session

    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    own = session.scratch_root(spark)
    assert own == session.scratch_root(spark) and session.new_folder(spark, "x").startswith(own)


def test_write_once_repairs_an_empty_folder(spark, tmp_path):
    (tmp_path / "left").mkdir()
    assert writers.write_once(spark.range(3), str(tmp_path / "left")).count() == 3


def test_csv_round_trip(spark):
    path = new_folder(spark, "csv")
    table = spark.createDataFrame(
        [("a", ' quoted "x",\nnext line ', 3, [0.1, -2.0, 1e-9]), ("b", "#y", 0, [])],
        schemas.EMBEDDED_NOTES,
    )
    writers.export_csv(table, path)
    assert rows(readers.scan_vectors(spark, path)) == rows(table)


def test_pages_of_large_files_keep_their_order(spark, tmp_path):
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "c.txt").write_text("not read")
    want = []
    for name in ("year=2020", "b"):
        pages = [f"{name} page {i}\nwith lines" for i in range(60)]
        (tmp_path / f"{name}.txt").write_text("\f".join(pages))
        want += [(name, i, page) for i, page in enumerate(pages)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "101")
    try:
        assert rows(readers.scan_pages(spark, str(tmp_path))) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["name"] for r in readers.scan_pages(spark, str(tmp_path), recursive=True).collect()} == {"year=2020", "b", "c"}
    named = spark.range(1).select(readers.document_name(F.lit("/x/year=2020/b.txt")), readers.document_name(F.lit("/x/name=n 1/part-00000-1a.c000.txt")))
    assert tuple(named.first()) == ("b", "n 1")


def test_ordinals_stay_dense_over_appends(spark):
    path = new_folder(spark, "ordered")
    first = spark.range(100).select((99 - F.col("id")).alias("k"), F.lit("a").alias("x")).repartition(7)
    second = spark.range(200, 230).select(F.col("id").alias("k"), F.lit("b").alias("x")).repartition(3)
    writers.append_ordered(first, path, ["k"])
    writers.append_ordered(first.limit(0), path, ["k"])
    found = writers.append_ordered(second, path, ["k"])
    assert rows(found.select("ordinal", "k")) == [*zip(range(100), range(100)), *zip(range(100, 130), range(200, 230))]

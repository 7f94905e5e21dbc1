"""Jobs end to end on small tables: restart, copies, tags, guards."""

import pytest
from pyspark.sql import functions as F

from tagloom import fixed
from tagloom.backends import EchoGenerator, HashingEmbedder, HashJudge
from tagloom.operators import assign, objectives as obj
from tagloom.operators.inference import Judge
from tagloom.params import ChatParams, EmbedParams, Params, SelectParams, TagParams
from tagloom.plans import jobs
from tagloom.session import materialise, new_folder
from tagloom.streaming import incremental

RATING = "guid string, tag string, objective string, score int, rank int"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    words = "heart lung vein bone nerve liver cell gene drug dose".split()
    notes = [
        (f"g{i:03d}", " ".join(words[(i * k + k) % 10] for k in range(1, 5 + i % 7))) for i in range(120)
    ]
    notes += [("g000", notes[0][1])] * 3 + [("g001", "another card with the same guid")]
    asked = [("lec", f"What does the {a} do to the {b}?") for a in words[:4] for b in words[4:]]
    note_df = spark.createDataFrame(notes, "guid string, card string")
    pages = spark.createDataFrame(
        [(n, i, q) for i, (n, q) in enumerate(asked)], "name string, page_no long, text string"
    )
    embedded = materialise(jobs.embed_notes(note_df, HashingEmbedder()), "notes")
    questions = spark.createDataFrame(asked, "name string, learning_objective string")
    embedded_questions = jobs.inference.embed(
        questions, "learning_objective", HashingEmbedder()
    ).withColumn("tokens", F.lit(1))
    return note_df, pages, embedded, materialise(embedded_questions, "objectives")


def test_copies_of_a_note_are_rated_as_often_as_they_occur(spark, tables):
    _, _, notes, objectives = tables
    pairs = jobs.candidate_pairs(notes, objectives, SelectParams(token_budget=10**6))
    assert pairs.count() == notes.count() * objectives.count()
    per_guid = pairs.groupBy("obj_id", "guid").count()
    assert {r[0] for r in per_guid.filter("guid = 'g000'").select("count").collect()} == {4}
    assert {r[0] for r in per_guid.filter("guid = 'g001'").select("count").collect()} == {2}
    assert pairs.groupBy("obj_id").agg(F.count_distinct("rank").alias("n")).filter("n <> 124").count() == 0


def test_many_keys_are_fetched_by_shuffle(spark, tables, monkeypatch):
    _, _, notes, objectives = tables
    want = rows(jobs.candidate_pairs(notes, objectives).select("obj_id", "guid", "card", "rank"))
    monkeypatch.setattr(jobs, "BROADCAST_KEYS", 0)
    assert rows(jobs.candidate_pairs(notes, objectives).select("obj_id", "guid", "card", "rank")) == want


def test_eager_lazy_and_exact_tokenizer_agree(spark, tables):
    _, _, notes, objectives = tables
    columns = ["obj_id", "guid", "card", "rank", "gpt_reply", "score"]
    options = {"max_poor_run": 2, "token_budget": 900}
    eager = jobs.select_pairs(notes, objectives, Judge(HashJudge()), SelectParams(**options))
    lazy = jobs.select_pairs(notes, objectives, Judge(HashJudge()), SelectParams(mode="lazy", **options))

    def tokenizer(texts):
        from tagloom.backends import TOKEN

        return [len(TOKEN.findall(t)) for t in texts]

    exact = jobs.select_pairs(
        notes, objectives, Judge(HashJudge()), SelectParams(**options),
        tokenizer=tokenizer, min_prompt_tokens=30,
    )
    want = rows(eager.select(columns))
    assert len(want) > 50
    assert rows(lazy.select(columns)) == want
    assert rows(exact.select(columns)) == want


def test_resume_equals_one_run(spark, tables):
    _, _, notes, objectives = tables
    once, twice = new_folder(spark, "once"), new_folder(spark, "twice")
    whole = jobs.select_new(notes, objectives, Judge(HashJudge()), once)
    early = objectives.filter("learning_objective < 'What does the l'")
    jobs.select_new(notes, early, Judge(HashJudge()), twice)
    calls = spark.sparkContext.accumulator(0)

    class Counting(HashJudge):
        def __call__(self, prompts, temperature, limits):
            calls.add(len(prompts))
            return super().__call__(prompts, temperature, limits)

    resumed = jobs.select_new(notes, objectives, Judge(Counting()), twice)
    assert calls.value > 0 and rows(resumed) == rows(whole)
    calls.value = 0
    again = jobs.select_new(notes, objectives, Judge(Counting()), twice)
    assert calls.value == 0 and rows(again) == rows(whole)


def test_stream_sees_only_new_objectives(spark, tables):
    _, _, notes, objectives = tables
    source, out, checkpoint = (new_folder(spark, x) for x in ("src", "out", "chk"))
    seen = []

    def step(batch):
        seen.append(batch.count())
        return jobs.select_pairs(notes, batch, Judge(HashJudge()))

    early = F.col("learning_objective") < "What does the l"
    for part in (objectives.filter(early), objectives.filter(~early)):
        part.coalesce(1).write.mode("append").parquet(source)
        incremental.run_available(spark, source, objectives.schema, step, out, checkpoint)
    incremental.run_available(spark, source, objectives.schema, step, out, checkpoint)
    assert len(seen) == 2 and sum(seen) == objectives.count()
    want = jobs.select_pairs(notes, objectives, Judge(HashJudge()))
    assert rows(incremental.read_results(spark, out).select(want.columns)) == rows(want)


def test_dimension_mismatch_stops_the_job(spark, tables):
    _, _, notes, objectives = tables
    short = objectives.withColumn("emb", F.slice("emb", 1, 32))
    with pytest.raises(ValueError, match="64.*32"):
        jobs.candidate_pairs(notes, short)


def test_failed_vectors_and_ratings_do_not_stop_the_job(spark, tables):
    note_df, _, _, objectives = tables

    def embedder(texts):
        if any("same guid" in t for t in texts):
            raise RuntimeError("no")
        return HashingEmbedder()(texts)

    notes = jobs.embed_notes(note_df, embedder, EmbedParams(attempts=1, wait=0.0, parallelism=4))
    notes = materialise(notes, "notes")
    assert notes.filter("emb_error IS NOT NULL").count() == 1

    def chat(messages, temperature, limits):
        raise TimeoutError("slow")

    rated = jobs.select_pairs(notes, objectives, Judge(chat, attempts=1, wait=0.0))
    found = rated.groupBy("obj_id").count().select("count").distinct().collect()
    assert [r[0] for r in found] == [fixed.MAX_POOR_MATCH_RUN + 1]  # NULL scores are poor
    assert rated.filter("score IS NOT NULL OR rate_error IS NULL").count() == 0


def test_too_long_documents_go_aside(spark):
    pages = spark.createDataFrame(
        [("short", 2, "two"), ("short", 1, "one\n2. - Learning Objective\nthree"), ("long", 1, "w " * 700)],
        "name string, page_no long, text string",
    )
    params = Params(chat=ChatParams(max_tokens=1000, buffer=200))
    for tokenizer in (None, lambda texts: [len(t.split()) for t in texts]):
        made, too_long, _, _ = jobs.make_objectives(
            pages, EchoGenerator(), HashingEmbedder(), params, tokenizer=tokenizer
        )
        assert [r["name"] for r in too_long.collect()] == ["long"]
        assert rows(made.select("name", "learning_objective")) == [("short", "one"), ("short", "three two")]
    limit = obj.prompt_token_limit(1000, 200)
    edge = spark.createDataFrame(
        [("fits", 1, "w " * limit), ("over", 1, "w " * limit), ("over", 2, "w")],
        "name string, page_no long, text string",
    )
    fitting, too_long = obj.split_by_length(edge, 1000, 200)
    assert [r["name"] for r in fitting.collect()] == ["fits"]
    assert [r["name"] for r in too_long.collect()] == ["over"]


def test_few_tokens_in_many_characters_are_kept(spark):
    """Only tokens count: blank pages and endless words do not make a document too long."""
    limit = obj.prompt_token_limit(1000, 200)
    pages = spark.createDataFrame(
        [("blank", 1, " " * (limit * 200)), ("blank", 2, "a"), ("none", 1, None)],
        "name string, page_no long, text string",
    )
    fitting, too_long = obj.split_by_length(pages, 1000, 200)
    assert {r["name"] for r in fitting.collect()} == {"blank", "none"} and too_long.count() == 0
    whole = {r["name"]: r["text"] for r in obj.assemble_text(fitting).collect()}
    assert len(whole["blank"]) == limit * 200 + 2


def test_failed_calls_stay_open(spark, tmp_path):
    """After an outage a second run ends with what a run without failures gives."""
    notes = spark.createDataFrame([(f"g{i}", f"card {i} of words") for i in range(12)], "guid string, card string")
    pages = spark.createDataFrame(
        [(f"d{i}", 1, f"text {i}\n2. - objective {i}\nmore {i}") for i in range(4)],
        "name string, page_no long, text string",
    )
    table = notes.select(F.monotonically_increasing_id().alias("id"), "guid", F.lit(" t ").alias("tags"))
    fast = Params(embed=EmbedParams(attempts=1, wait=0.0), chat=ChatParams(attempts=1, wait=0.0))

    def flaky(model, mark, bad):
        """The model, failing on some inputs until the file `mark` is there."""

        def call(items, *rest):
            import os

            if not os.path.exists(mark) and any(bad in str(i) for i in items):
                raise ConnectionError("down")
            return model(items, *rest)

        return call

    def run(folder, up):
        (tmp_path / up).mkdir(exist_ok=True)
        wrap = lambda model, bad: flaky(model, str(tmp_path / up / "up"), bad)
        jobs.run_all(
            spark, str(tmp_path / folder), notes=notes, pages=pages, note_table=table, params=fast,
            embedder=wrap(HashingEmbedder(), "card 3"), chat=wrap(EchoGenerator(), "text 2"),
            judge=Judge(wrap(HashJudge(), "card 5"), attempts=1, wait=0.0),
        )
        read = lambda name: spark.read.parquet(str(tmp_path / folder / name))
        ratings = read("ratings").select("tag", "guid", "objective", "score", "rank")
        return {
            "notes": rows(read("notes").select("guid", "tokens")),
            "objectives": rows(read("objectives").select("name", "learning_objective")),
            "ratings": rows(ratings),
        }

    (tmp_path / "fine").mkdir()
    (tmp_path / "fine" / "up").touch()
    want = run("whole", "fine")
    first = run("broken", "shaky")
    assert len(first["notes"]) == 11 and {r[0] for r in first["objectives"]} == {"d0", "d1", "d3"}
    failed = spark.read.parquet(str(tmp_path / "broken" / "objectives-failed"))
    assert [r["name"] for r in failed.collect()] == ["d2"]
    (tmp_path / "shaky" / "up").touch()
    second = run("broken", "shaky")
    assert second["notes"] == want["notes"] and second["objectives"] == want["objectives"]
    rated = {r[:3] for r in second["ratings"]}
    assert {r[2] for r in rated} == {r[2] for r in want["ratings"]}


def test_best_row_per_note(spark):
    ratings = spark.createDataFrame(
        [
            ("a", "t1", "o", None, 1), ("a", "t2", "o", 5, 2),
            ("b", "t1", "o1", 7, 3), ("b", "t1", "o1", 7, 2), ("b", "t1", "o2", 7, 1),
            (" c", "t1", "o", 1, 1), ("c ", "t1", "o", 2, 9),
        ],
        RATING,
    )
    assert [r["guid"] for r in assign.best_per_note(ratings, sort=True).collect()] == ["a", "b", "c"]
    best = assign.best_per_note(ratings)
    assert rows(best.select("guid", "tag", "objective", "score", "rank")) == [
        ("a", "t2", "o", 5, 2), ("b", "t1", "o1", 7, 2), ("c", "t1", "o", 2, 9),
    ]


def test_tags(spark):
    notes = spark.createDataFrame(
        [(3, "a", "x"), (2, "a", "y"), (4, "b", ""), (5, "c", None), (6, "d", "z")],
        "id long, guid string, tags string",
    )
    ratings = spark.createDataFrame(
        [("a", "t", "o", 80, 1), ("b", "t", "o", 9, 1), ("c", "t", "o", 90, 1), ("gone", "t", "o", 90, 1),
         ("d", "t", "o", 40, 1), ("d", "s", "o", 10, 1)],
        RATING,
    )
    tagged = assign.tag_notes(notes, ratings)
    assert {r["id"]: (r["tags"], r["tagged"]) for r in tagged.collect()} == {
        2: ("y t::1_highly_relevant ", True), 3: ("x", False), 4: ("", False), 5: (None, False),
        6: ("z t::2_somewhat_relevant ", True),
    }
    assert rows(assign.tag_report(tagged)) == [(5, 2)]
    both = assign.tag_notes(notes, ratings, TagParams(per=("guid", "tag")))
    assert both.filter("id = 6").first()["tags"] == "z s::3_minimally_relevant  t::2_somewhat_relevant "
    again = assign.tag_notes(tagged.drop("tagged"), ratings, TagParams(dedupe=True))
    assert again.filter("id = 2").first()["tags"] == "y t::1_highly_relevant "


@pytest.mark.parametrize("notes, few", [(9, True), (10, False)])
def test_mismatch_flags(spark, notes, few):
    rated = spark.range(100).select(F.concat(F.lit(" r"), "id").alias("guid"))
    table = spark.range(notes).select("id", F.concat(F.lit("n"), "id").alias("guid"))
    report = assign.overlap_report(rated, table).first()
    assert report["rated_guids"] == 100 and report["note_rows"] == notes
    assert report["few_notes"] is few and report["no_match"] is True
    same = assign.overlap_report(rated, rated.select(F.trim("guid").alias("guid"))).first()
    assert same["matching_guids"] == 100 and same["no_match"] is False


def test_run_all_in_two_goes(spark, tables):
    note_df, pages, _, _ = tables
    note_table = note_df.select("guid").distinct().select(
        F.xxhash64("guid").alias("id"), "guid", F.lit(" old ").alias("tags")
    )
    given = dict(
        judge=Judge(HashJudge()), chat=EchoGenerator(), embedder=HashingEmbedder(),
        notes=note_df, pages=pages, note_table=note_table,
    )
    at_once = jobs.run_all(spark, new_folder(spark, "run"), **given)
    folder = new_folder(spark, "run")
    jobs.run_all(spark, folder, skip={"select", "tag"}, **given)
    jobs.run_all(spark, folder, skip={"select", "tag"}, **given)  # adds nothing
    later = jobs.run_all(spark, folder, skip={"embed", "objectives"}, judge=given["judge"], note_table=note_table)
    assert rows(later) == rows(at_once)
    assert later.filter("tagged").count() > 0
    with pytest.raises(FileNotFoundError, match="note_table"):
        jobs.run_all(spark, folder, judge=given["judge"], skip={"embed", "objectives", "select"})
    with pytest.raises(FileNotFoundError, match="notes"):
        jobs.run_all(spark, new_folder(spark, "run"), judge=given["judge"], skip={"embed", "objectives", "tag"})
    with pytest.raises(ValueError):
        jobs.run_all(spark, folder, judge=given["judge"], skip={"other"})


def test_repeated_objectives_have_their_rows_each(spark, tables):
    _, _, notes, objectives = tables
    once = jobs.select_pairs(notes, objectives, Judge(HashJudge()))
    twice = jobs.select_pairs(notes, objectives.unionByName(objectives), Judge(HashJudge()))
    assert twice.exceptAll(once.unionByName(once)).isEmpty() and twice.count() == 2 * once.count()


def test_run_all_with_a_tokenizer(spark, tables):
    """A tokenizer that counts as the estimate does gives the same tags."""
    notes, pages, _, _ = tables
    note_table = notes.groupBy("guid").agg(F.lit(" t ").alias("tags")).withColumn(
        "id", F.xxhash64("guid")
    )
    given = dict(
        judge=Judge(HashJudge()), chat=EchoGenerator(), embedder=HashingEmbedder(),
        notes=notes, pages=pages, note_table=note_table,
    )

    def tokenizer(texts):
        import re

        return [len(re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0d\x20]", t)) for t in texts]

    plain = jobs.run_all(spark, new_folder(spark, "run"), **given)
    counted = jobs.run_all(
        spark, new_folder(spark, "run"), tokenizer=tokenizer, min_prompt_tokens=30, **given
    )
    assert rows(counted) == rows(plain)
    with pytest.raises(ValueError):
        jobs.run_all(spark, new_folder(spark, "run"), tokenizer=tokenizer, **given)


def test_names_of_own_columns_may_clash(spark, tables):
    """Inputs may carry columns that are called as the library's own."""
    _, _, notes, objectives = tables
    clash = {c: F.lit(None).cast("string") for c in (
        "obj_id", "copies", "rank", "prompt_tokens", "pair_tokens", "cosine_sim", "_hash", "_price", "_rest", "_place",
    )}
    want = rows(jobs.select_pairs(notes, objectives, Judge(HashJudge())).select("guid", "tag", "objective", "rank"))
    odd_notes = notes.withColumns({k: v for k, v in clash.items()})
    odd_objectives = objectives.withColumns(clash).withColumn("guid", F.lit("x"))
    got = jobs.select_pairs(odd_notes, odd_objectives, Judge(HashJudge()))
    assert rows(got.select("guid", "tag", "objective", "rank")) == want
    marked = notes.select("guid", "card").withColumns(clash).withColumn("emb_error", F.lit("x"))
    assert jobs.embed_notes(marked, HashingEmbedder()).filter("emb IS NULL").count() == 0


def test_a_python_model_before_the_notes_runs_once(spark, tables):
    from pyspark.sql.pandas.functions import pandas_udf

    note_df, _, _, objectives = tables
    calls = spark.sparkContext.accumulator(0)

    @pandas_udf("array<double>")
    def embed(cards):
        calls.add(len(cards))
        import pandas as pd

        return pd.Series(HashingEmbedder()(list(cards)))

    notes = note_df.select("guid", "card", F.lit(3).alias("tokens"), embed("card").alias("emb"))
    jobs.candidate_pairs(notes, objectives).count()
    assert calls.value == note_df.count()


def test_no_task_assembles_a_document_above_the_limit(spark):
    """With a tokenizer and without: the long document, a third of all pages, is told from its counts."""
    long = [("long", i, "word " * 50) for i in range(40)] + [(None, i, "word " * 50) for i in range(40)]
    pages = spark.createDataFrame(long + [(f"d{i}", 0, f"Why is {i}") for i in range(40)], "name string, page_no long, text string")
    params = Params(chat=ChatParams(max_tokens=1000, buffer=100))
    longest = spark.sparkContext.accumulator(0)

    def tokenizer(texts):
        from tagloom.backends import TOKEN

        longest.add(sum(len(t) > 5000 for t in texts))
        return [len(TOKEN.findall(t)) for t in texts]

    plain = jobs.make_objectives(pages, EchoGenerator(), HashingEmbedder(), params)
    exact = jobs.make_objectives(
        pages, EchoGenerator(), HashingEmbedder(), params, tokenizer=tokenizer, max_token_chars=5
    )
    assert rows(plain.made.select("name", "learning_objective")) == rows(exact.made.select("name", "learning_objective"))
    assert {r["name"] for r in plain.too_long.collect()} == {r["name"] for r in exact.too_long.collect()} == {"long", None}
    assert longest.value == 0
    kept, _ = obj.split_by_length(pages, 1000, 100)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_report_is_counted_while_tags_are_written(spark):
    tagged = spark.createDataFrame([(1, "a", " x", True), (2, "b", " y", False)], "id long, guid string, tags string, tagged boolean")
    path = new_folder(spark, "tagged")
    assert [tuple(r) for r in assign.write_and_count(tagged, path).collect()] == [(2, 1)]
    assert rows(assign.tag_report(spark.read.parquet(path))) == [(2, 1)]


def test_a_stream_forgets_what_comes_again(spark):
    source, out, checkpoint = (new_folder(spark, n) for n in ("source", "out", "checkpoint"))
    schema = "name string, x int"
    for rows_ in ([("a", 1), ("a", 1), (None, 2)], [("a", 3), ("b", 4)], [(None, 5), ("b", 6), ("c", 7)]):
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(source)
        incremental.run_available(
            spark, source, spark.createDataFrame([], schema).schema, lambda df: df, out, checkpoint, once=["name"]
        )
    assert sorted(map(str, [tuple(r) for r in incremental.read_results(spark, out).collect()])) == [
        "('a', 1)", "('b', 4)", "('c', 7)", "(None, 2)",
    ]

"""Every operator as a query over the given tables.

Notes are the documents, whole; objectives are the benchmark texts, whole;
pages are the conversation turns. Local model callables stand in for models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom import schemas
from tagloom.backends import EchoGenerator, FailsByHash, HashingEmbedder, HashJudge
from tagloom.functions import prompts, scores, text, vectors
from tagloom.operators import assign, inference, objectives as obj, similarity, walk
from tagloom.params import ChatParams, EmbedParams, Params, SelectParams
from tagloom.plans import jobs
from tagloom.session import materialise, new_folder, spread
from tagloom.sources import readers, writers
from tagloom.streaming import incremental

SMALL_LIMIT = 1000  # chat window used by the budget queries
SMALL_BUFFER = 100
TRUNCATE_TOKENS = 100
OVERFLOW_CHARS = 4000  # texts above this overflow the model of `embed_retry`
TOP_K = 20
POOR_RUN = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over the cores where the table has few splits."""
    return spread(table(spark, sf_dir, "documents"))


# --- views -----------------------------------------------------------------


def notes_view(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("guid"), F.col("text").alias("card")
    )


def note_table_view(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").cast("string").alias("guid"),
        F.concat(F.lit(" "), "source", F.lit(" ")).alias("tags"),
    )


def objective_texts(spark, sf_dir, *more):
    return table(spark, sf_dir, "benchmark").select(
        *more,
        F.concat(F.lit("lecture_"), F.substring(F.md5("text"), 1, 1)).alias("name"),
        F.col("text").alias("learning_objective"),
    )


def pages_view(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("lecture_"), F.col("conv_id")).alias("name"),
        F.col("turn").alias("page_no"),
        "text",
    )


def embedded_notes(spark, sf_dir):
    return jobs.embed_notes(notes_view(spark, sf_dir), HashingEmbedder())


def embedded_objectives(spark, sf_dir):
    counted = text.with_token_count(objective_texts(spark, sf_dir), "learning_objective")
    return inference.embed(counted, "learning_objective", HashingEmbedder()).drop("emb_error")


def candidates(spark, sf_dir):
    """Ranked pairs within the token budget, written once and used from there."""
    notes = writers.write_once(embedded_notes(spark, sf_dir), new_folder(spark, "notes"))
    return jobs.candidate_pairs(notes, embedded_objectives(spark, sf_dir), unique_guid=True)


def scored_candidates(spark, sf_dir):
    """All candidate pairs with reply and score, before the poor-run cut."""
    rated = jobs.rate_and_cut(
        candidates(spark, sf_dir), inference.Judge(HashJudge()), SelectParams(max_poor_run=1 << 30)
    )
    return rated.dropDuplicates(["obj_id", "rank"])  # one walk for equal objectives


def ratings(spark, sf_dir, **options):
    return jobs.rate_and_cut(
        candidates(spark, sf_dir), inference.Judge(HashJudge()), SelectParams(**options)
    )


def fingerprint(emb="emb"):
    """A vector of the hashing embedder as text, in units of 1/4096."""
    units = F.transform(emb, lambda x: F.round(x * 4096).cast("bigint").cast("string"))
    return F.array_join(units, ",")


# --- sources and sinks -----------------------------------------------------


def quoted(c):
    return F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))


def scan_notes(spark, sf_dir):
    path = new_folder(spark, "export")
    notes = notes_view(spark, sf_dir)
    lines = F.array(
        F.concat(F.lit("#guid:"), "guid"),
        F.concat_ws("\t", quoted("guid"), quoted("card"), F.lit("further column")),
        F.concat_ws("\t", quoted("guid"), F.lit("")),
    )
    notes.select(F.explode(lines).alias("value")).write.text(path)
    return readers.scan_notes(spark, path)


def scan_notes_inline(spark, sf_dir):
    """Notes whose lines end in comments, with quotes of their own; the texts keep their '#'."""
    path = new_folder(spark, "export")
    line = F.concat(quoted("guid"), F.lit("\t"), quoted("card"), F.lit('#a "comment" of '), "guid")
    commented = F.concat(F.lit("lost"), "guid", F.lit("#\tno card"))
    notes = notes_view(spark, sf_dir).withColumns({"line": line, "commented": commented})
    notes.select(F.explode(F.array("line", "commented")).alias("value")).write.text(path)
    return readers.scan_notes(spark, path, inline_comments=True)


def scan_objectives(spark, sf_dir):
    """Embedded objectives through CSV."""
    path = new_folder(spark, "objectives")
    writers.export_csv(embedded_objectives(spark, sf_dir).select(*schemas.OBJECTIVES.names), path)
    found = readers.scan_vectors(spark, path, schemas.OBJECTIVES)
    return found.select("name", "learning_objective", "tokens", fingerprint().alias("emb"))


def scan_ratings_csv(spark, sf_dir):
    """Rated pairs through CSV, texts with line breaks and all."""
    path = new_folder(spark, "ratings")
    columns = [c for c in schemas.RATINGS.names if c not in ("rank", "rate_error")]
    writers.export_csv(ratings(spark, sf_dir).select(*columns), path)
    found = readers.scan_ratings(spark, path, format="csv")
    return found.select("tag", "objective", "guid", "card", "gpt_reply", "score")


def scan_vectors(spark, sf_dir):
    """Vectors through CSV, a header row repeated before every one of them."""
    path = new_folder(spark, "vectors")
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("guid"),
        F.concat(F.lit("label "), F.col("label")).alias("card"),
        F.col("label").cast("string").alias("tokens"),
        F.concat(F.lit("["), F.array_join("embedding", ", "), F.lit("]")).alias("emb"),
    )
    header = F.struct(*[F.lit(c).alias(c) for c in rows.columns])
    writers.export_csv(rows.select(F.inline(F.array(header, F.struct(*rows.columns)))), path)
    found = readers.scan_vectors(spark, path)
    values = F.posexplode(F.transform("emb", lambda x: x.cast("float").cast("double")))
    return found.select("guid", "card", "tokens", values.alias("pos", "value"))


def fill_scores(spark, sf_dir):
    path = new_folder(spark, "ratings")
    ratings(spark, sf_dir).write.partitionBy("tag").parquet(path)
    return readers.scan_ratings(spark, path).select("tag", "objective", "guid", "score")


def scan_documents(spark, sf_dir):
    path = new_folder(spark, "documents")
    docs = table(spark, sf_dir, "documents").select("source", F.col("text").alias("value"))
    docs.write.partitionBy("source").text(path)
    return readers.scan_documents(spark, path, recursive=True)


def _page_files(spark, sf_dir) -> str:
    """A folder with a file of pages for every conversation."""
    path = new_folder(spark, "page-files")
    writers.write_page_files(pages_view(spark, sf_dir), path)
    return path


def scan_pages(spark, sf_dir):
    return readers.scan_pages(spark, _page_files(spark, sf_dir), recursive=True)


def path_stem(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.path_stem("url").alias("stem"))


def assemble_text(spark, sf_dir):
    fitting, _ = obj.split_by_length(pages_view(spark, sf_dir))
    return obj.assemble_text(fitting)


def write_once(spark, sf_dir):
    path = new_folder(spark, "once")
    notes = notes_view(spark, sf_dir)
    writers.write_once(notes, path)
    return writers.write_once(notes.withColumn("card", F.lit("a second write")), path)


def append_new(spark, sf_dir):
    path = new_folder(spark, "appended")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    writers.append_new(docs.filter("lang = 'en'"), path, ["doc_id"])
    return writers.append_new(docs, path, ["doc_id"]).select("doc_id", "source", "lang", "text")


def resume_anti(spark, sf_dir):
    done = table(spark, sf_dir, "labels")
    return writers.not_done(table(spark, sf_dir, "documents"), done, ["doc_id"]).select(
        "doc_id", "source"
    )


def incremental_stream(spark, sf_dir):
    """Rate objectives as they arrive, in two runs of one stream."""
    source, out, checkpoint = (new_folder(spark, n) for n in ("arrivals", "rated", "stream"))
    notes = writers.write_once(embedded_notes(spark, sf_dir), new_folder(spark, "notes"))
    arrivals = materialise(embedded_objectives(spark, sf_dir), "arrivals")

    def rate(batch):
        pairs = jobs.candidate_pairs(notes, batch, unique_guid=True)
        return jobs.rate_and_cut(pairs, inference.Judge(HashJudge()))

    early = F.col("name") < "lecture_8"
    for part in (arrivals.filter(early), arrivals.filter(~early)):
        part.write.mode("append").parquet(source)
        incremental.run_available(spark, source, arrivals.schema, rate, out, checkpoint)
    return incremental.read_results(spark, out).select(
        "tag", "objective", "guid", "rank", "gpt_reply", "score"
    )


def _candidates(spark, sf_dir) -> list[str]:
    """Paths of a note table for every source, and of one that is none."""
    path = new_folder(spark, "candidates")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    note_table_view(spark, sf_dir).join(
        docs.withColumnRenamed("doc_id", "id"), "id"
    ).write.partitionBy("source").parquet(path)
    found = sorted(r["source"] for r in docs.select("source").distinct().collect())
    return [f"{path}/missing", *(f"{path}/source={name}" for name in found)]


def largest_source(spark, sf_dir):
    """The candidate with most notes, by its source."""
    path, notes = readers.read_largest(spark, _candidates(spark, sf_dir))
    return notes.agg(F.count("*").alias("notes")).select(F.lit(path.rpartition("=")[2]).alias("source"), "notes")


# --- texts -----------------------------------------------------------------


def token_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.token_count("text").alias("tokens"))


def token_filter(spark, sf_dir):
    kept = text.token_filter(spread(notes_view(spark, sf_dir)), "card", EmbedParams().token_limit)
    return kept.select("guid", "tokens", "card")


def truncate_text(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", text.truncate_text("text", TRUNCATE_TOKENS).alias("text")
    )


def decorated(spark, sf_dir):
    """Document lines dressed up as a model writes lists: numbers, dashes, headings."""
    docs = documents(spark, sf_dir).select("doc_id", "text")

    def dress(line, i):
        return (
            F.when(i % 6 == 0, F.concat(F.lit("1. - "), line))
            .when(i % 6 == 1, F.concat(F.lit("- 2. "), line))
            .when(i % 6 == 2, F.concat(F.lit("12."), line))
            .when(i % 6 == 3, F.concat(F.lit("Learning Objective: "), line))
            .when(i % 6 == 4, F.concat(F.lit(" \t-- "), line, F.lit(" \n \n")))
            .otherwise(line)
        )

    lines = F.transform(F.split("text", "\n"), dress)
    return docs.select("doc_id", F.array_join(lines, "\n").alias("reply"))


def split_lines(spark, sf_dir):
    return text.split_lines(decorated(spark, sf_dir), "reply")


def clean_objective(spark, sf_dir):
    lines = text.split_lines(decorated(spark, sf_dir), "reply")
    return lines.select("doc_id", "line_no", text.clean_objective("line").alias("learning_objective"))


def objective_filter(spark, sf_dir):
    kept = obj.objective_lines(decorated(spark, sf_dir))
    return kept.select("doc_id", "line_no", "learning_objective")


def objective_counts(spark, sf_dir):
    kept = obj.objective_lines(decorated(spark, sf_dir).withColumnRenamed("doc_id", "name"))
    return obj.objective_counts(kept)


# --- prompts and budgets ---------------------------------------------------


def rating_prompt(spark, sf_dir):
    return jobs.with_prompts(candidates(spark, sf_dir)).select(
        "tag", "objective", "guid",
        prompts.prompt_text("prompt").alias("prompt"),
        prompts.prompt_tokens("prompt").alias("prompt_tokens"),
    )


def _generation(spark, sf_dir):
    prompt = prompts.generation_prompt("text")
    return documents(spark, sf_dir).select(
        "doc_id",
        prompts.prompt_text(prompt).alias("prompt"),
        prompts.prompt_tokens(prompt).alias("prompt_tokens"),
    )


def generation_prompt(spark, sf_dir):
    return _generation(spark, sf_dir)


def budget_strict(spark, sf_dir):
    return _generation(spark, sf_dir).select(
        "doc_id",
        prompts.remaining_tokens("prompt_tokens", SMALL_LIMIT, SMALL_BUFFER).alias("remaining"),
        prompts.fits_strict("prompt_tokens", SMALL_LIMIT, SMALL_BUFFER).cast("int").alias("fits"),
    )


def budget_clamped(spark, sf_dir):
    left = prompts.remaining_clamped("prompt_tokens", SMALL_LIMIT, SMALL_BUFFER)
    return _generation(spark, sf_dir).select("doc_id", left.alias("remaining"))


def parse_score(spark, sf_dir):
    number = F.col("l_partkey").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    shapes = [
        F.concat(F.lit("Score: "), quantity),
        F.concat(F.lit("Score: "), number, F.lit("1234")),
        F.concat(quantity, F.lit("/100")),
        F.concat(F.lit("  about\n"), quantity, F.lit(".5 or "), number, F.lit(" \n")),
        F.concat(F.lit("**Score:** "), quantity),
        F.concat(F.lit("x"), quantity, F.lit("y n/a")),
        F.concat(F.lit("Score:"), quantity, F.lit("\nScore: "), number),
    ]
    reply = F.element_at(F.array(*shapes), F.col("l_linenumber").cast("int"))
    score = scores.parse_score(scores.normalise_reply(reply))
    return spread(table(spark, sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", score.alias("score")
    )


# --- vectors and rankings --------------------------------------------------


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("emb"))


def _leaders(spark, sf_dir):
    """The first vector of every label."""
    return (
        _vectors(spark, sf_dir).groupBy("label")
        .agg(F.min_by("emb", "vec_id").alias("emb"))
        .withColumnRenamed("label", "obj_id")
    )


def _asked(spark, sf_dir):
    """All vectors as objectives."""
    return _vectors(spark, sf_dir).select(F.col("vec_id").alias("obj_id"), "emb")


def dim_check(spark, sf_dir):
    notes, asked = _vectors(spark, sf_dir), _asked(spark, sf_dir)
    similarity.check_dims(notes, asked, every_row=True)
    sides = [
        similarity.vector_dims(df).withColumn("side", F.lit(side))
        for side, df in (("notes", notes), ("objectives", asked))
    ]
    return sides[0].unionByName(sides[1])


def _with_leader(spark, sf_dir):
    leaders = _leaders(spark, sf_dir).select(F.col("obj_id").alias("label"), F.col("emb").alias("leader"))
    return _vectors(spark, sf_dir).join(leaders, "label")


def dot_product(spark, sf_dir):
    sim = F.round(vectors.dot("emb", "leader"), 6)
    return _with_leader(spark, sf_dir).select("vec_id", "label", sim.alias("sim"))


def cosine(spark, sf_dir):
    sim = F.round(vectors.cosine_similarity("emb", "leader"), 6)
    return _with_leader(spark, sf_dir).select("vec_id", "label", sim.alias("sim"))


def _topk(spark, sf_dir, **options):
    return similarity.topk_similar(
        _vectors(spark, sf_dir), _asked(spark, sf_dir), TOP_K,
        note_key=["vec_id"], carry=["label"], decimals=6, **options,
    )


def sim_topk(spark, sf_dir):
    return _topk(spark, sf_dir)


def sim_topk_blocked(spark, sf_dir):
    """The same with the objectives in several blocks."""
    return _topk(spark, sf_dir, block_bytes=1 << 15)


def sim_topk_cosine(spark, sf_dir):
    return _topk(spark, sf_dir, metric="cosine")


def sim_rank(spark, sf_dir):
    """Every note an objective's budget could reach, in order."""
    k = walk.max_rated(SelectParams().token_budget, prompts.rating_fixed_tokens())
    objectives = materialise(
        similarity.with_objective_id(embedded_objectives(spark, sf_dir)), "objectives"
    )
    ranked = similarity.topk_similar(embedded_notes(spark, sf_dir), objectives, k, carry=["tokens"])
    named = ranked.join(objectives.select("obj_id", "name", "learning_objective"), "obj_id")
    return named.select("name", "learning_objective", "guid", "tokens", "cosine_sim", "rank")


# --- walks -----------------------------------------------------------------


def token_budget(spark, sf_dir):
    pairs = candidates(spark, sf_dir).drop("card")
    cut = walk.token_budget_cut(pairs, ["obj_id"], "rank", SelectParams().token_budget // 2)
    return cut.select("tag", "objective", "guid", "rank", "prompt_tokens", "used_before")


def poor_run_stop(spark, sf_dir):
    cut = walk.poor_run_cut(scored_candidates(spark, sf_dir), ["obj_id"], "rank", POOR_RUN)
    return cut.select("tag", "objective", "guid", "rank", "score", "poor_run", "worst_before")


RATED = ("tag", "objective", "guid", "card", "cosine_sim", "gpt_reply", "score", "rank")


def select_pairs(spark, sf_dir):
    return ratings(spark, sf_dir, max_poor_run=POOR_RUN).select(*RATED)


def select_pairs_fold(spark, sf_dir):
    """The same rows from a fold over replies to all candidates."""
    params = SelectParams()
    replies = _judged(spark, sf_dir).withColumn("gpt_reply", scores.normalise_reply("gpt_reply"))
    rows = replies.withColumn("score", scores.parse_score("gpt_reply"))
    kept = walk.walk_fold(
        rows.select("obj_id", "copies", "prompt_tokens", *RATED), ["obj_id"], "rank",
        params.token_budget, POOR_RUN, prompts.rating_fixed_tokens(),
    )
    return jobs.per_copy(kept).select(*RATED)


def select_pairs_lazy(spark, sf_dir):
    """The same rows from a walk that rates no pair it does not visit."""
    return ratings(spark, sf_dir, max_poor_run=POOR_RUN, mode="lazy").select(*RATED)


# --- model calls -----------------------------------------------------------


def embed_texts(spark, sf_dir):
    found = inference.get_embedding(spread(notes_view(spark, sf_dir)), "card", HashingEmbedder())
    return found.select(F.col("card"), fingerprint().alias("emb"))


class OverflowingEmbedder(HashingEmbedder):
    """Refuses a batch that holds a text above a length."""

    def __call__(self, texts):
        if any(len(t) > OVERFLOW_CHARS for t in texts):
            raise ValueError("input exceeds the context length")
        return super().__call__(texts)


def embed_retry(spark, sf_dir):
    found = inference.embed(
        spread(notes_view(spark, sf_dir)), "card", OverflowingEmbedder(), batch_size=16, wait=0.0,
        max_tokens=EmbedParams().truncate_tokens,
    )
    return found.select("guid", fingerprint().alias("emb"), "emb_error")


def embed_failures(spark, sf_dir):
    """Vectors from a model that fails on batches with certain texts in them."""
    found = inference.embed(
        spread(notes_view(spark, sf_dir)), "card", FailsByHash(HashingEmbedder()),
        batch_size=64, attempts=1, wait=0.0,
    )
    return found.select("guid", fingerprint().alias("emb"), "emb_error")


def generate_failures(spark, sf_dir):
    """Objectives by way of a chat model that fails on batches with certain documents in them."""
    params = Params(chat=ChatParams(attempts=1, wait=0.0))
    found = jobs.make_objectives(
        pages_view(spark, sf_dir), FailsByHash(EchoGenerator()), HashingEmbedder(), params
    )
    return found.made.select("name", "learning_objective", "tokens", fingerprint().alias("emb"))


def rate_failures(spark, sf_dir):
    """Ratings by a model that fails on batches with certain prompts in them."""
    pairs = jobs.with_prompts(candidates(spark, sf_dir))
    judge = inference.Judge(FailsByHash(HashJudge()), attempts=1, wait=0.0, growth=0.0)
    replies = inference.judge(pairs, "prompt", judge, max_tokens="completion_tokens")
    replies = replies.withColumn("gpt_reply", scores.normalise_reply("gpt_reply"))
    return replies.select(
        "tag", "objective", "guid", "gpt_reply", "attempts", "rate_error",
        scores.parse_score("gpt_reply").alias("score"),
    )


def embed_notes_job(spark, sf_dir):
    path = new_folder(spark, "notes")
    notes = writers.write_once(embedded_notes(spark, sf_dir), path)
    return notes.select("guid", "card", "tokens", fingerprint().alias("emb"))


def make_objectives(spark, sf_dir):
    found = jobs.make_objectives(pages_view(spark, sf_dir), EchoGenerator(), HashingEmbedder())
    return found.made.select("name", "learning_objective", "tokens", fingerprint().alias("emb"))


def make_objectives_rejected(spark, sf_dir):
    """Documents too long for one prompt, at a small chat window."""
    params = Params(chat=ChatParams(max_tokens=SMALL_LIMIT, buffer=SMALL_BUFFER))
    found = jobs.make_objectives(pages_view(spark, sf_dir), EchoGenerator(), HashingEmbedder(), params)
    return found.too_long.select("name", "text_tokens")


def _judged(spark, sf_dir, **options):
    pairs = jobs.with_prompts(candidates(spark, sf_dir))
    judge = inference.Judge(HashJudge(), **options)
    return inference.judge(pairs, "prompt", judge, max_tokens="completion_tokens")


def judge_pairs(spark, sf_dir):
    """One reply per pair, as the model gave it."""
    return _judged(spark, sf_dir, temperatures=(0.0,)).select(
        "tag", "objective", "guid", F.col("gpt_reply").alias("reply"),
    )


def judge_ladder(spark, sf_dir):
    replies = _judged(spark, sf_dir).withColumn("gpt_reply", scores.normalise_reply("gpt_reply"))
    return replies.select(
        "tag", "objective", "guid", "gpt_reply", "attempts",
        scores.parse_score("gpt_reply").alias("score"),
    )


# --- tags ------------------------------------------------------------------


def _ordered_objectives(spark, sf_dir):
    """The objectives, appended to a table in two runs, those of even ids first."""
    path = new_folder(spark, "ordered")
    asked = objective_texts(spark, sf_dir, "item_id")
    for rest in (0, 1):
        writers.append_ordered(asked.filter(F.col("item_id") % 2 == rest), path, ["item_id"])
    return spark.read.parquet(path)


def best_per_note(spark, sf_dir):
    """The best row of every note; of equal ones that of the first objective in its table."""
    ordered = assign.with_objective_order(ratings(spark, sf_dir), _ordered_objectives(spark, sf_dir))
    best = assign.best_per_note(ordered, order=assign.TABLE_ORDER, sort=True)
    return best.select("guid", "tag", "objective", "score", "rank", "ordinal")


def best_per_note_and_tag(spark, sf_dir):
    best = assign.best_per_note(ratings(spark, sf_dir), per=["guid", "tag"])
    return best.select("guid", "tag", "objective", "score", "rank")


def relevance_bucket(spark, sf_dir):
    return ratings(spark, sf_dir).select(
        "tag", "objective", "guid", "score",
        scores.relevance_suffix(scores.fill_score("score")).alias("suffix"),
    )


def guid_overlap(spark, sf_dir):
    return assign.guid_overlap(ratings(spark, sf_dir), note_table_view(spark, sf_dir))


def overlap_report(spark, sf_dir):
    report = assign.overlap_report(ratings(spark, sf_dir), note_table_view(spark, sf_dir))
    return report.withColumns({c: F.col(c).cast("int") for c in ("few_notes", "no_match")})


def tag_notes(spark, sf_dir):
    tagged = assign.tag_notes(note_table_view(spark, sf_dir), ratings(spark, sf_dir))
    return tagged.withColumn("tagged", F.col("tagged").cast("int"))


def tag_report(spark, sf_dir):
    return assign.tag_report(assign.tag_notes(note_table_view(spark, sf_dir), ratings(spark, sf_dir)))


def flagship(spark, sf_dir):
    """All four stages: notes, documents and note table in, tagged notes out."""
    tagged = jobs.run_all(
        spark, new_folder(spark, "run"),
        judge=inference.Judge(HashJudge()), chat=EchoGenerator(), embedder=HashingEmbedder(),
        notes=notes_view(spark, sf_dir), pages=pages_view(spark, sf_dir),
        note_table=note_table_view(spark, sf_dir), params=Params(chat=ChatParams()),
    )
    return tagged.withColumn("tagged", F.col("tagged").cast("int"))


def flagship_files(spark, sf_dir):
    """The same from files: an export, a folder of page files, and the larger of two note tables."""
    export, tables = new_folder(spark, "export"), [new_folder(spark, "note-table") for _ in range(2)]
    notes = notes_view(spark, sf_dir)
    notes.select(F.concat_ws("\t", quoted("guid"), quoted("card")).alias("value")).write.text(export)
    known = note_table_view(spark, sf_dir)
    known.filter("id % 2 = 0").write.parquet(tables[0])
    known.write.parquet(tables[1])
    tagged = jobs.run_all(
        spark, new_folder(spark, "run"),
        judge=inference.Judge(HashJudge()), chat=EchoGenerator(), embedder=HashingEmbedder(),
        notes=readers.scan_notes(spark, export),
        pages=readers.scan_pages(spark, _page_files(spark, sf_dir), recursive=True),
        note_tables=tables,
    )
    return tagged.withColumn("tagged", F.col("tagged").cast("int"))


def once_only_stream(spark, sf_dir):
    """Rate objectives of which all arrive twice, in two runs of one stream."""
    source, out, checkpoint = (new_folder(spark, n) for n in ("arrivals", "rated", "stream"))
    notes = writers.write_once(embedded_notes(spark, sf_dir), new_folder(spark, "notes"))
    arrivals = materialise(embedded_objectives(spark, sf_dir), "arrivals")

    def rate(batch):
        pairs = jobs.candidate_pairs(notes, batch, unique_guid=True)
        return jobs.rate_and_cut(pairs, inference.Judge(HashJudge()))

    for _ in range(2):
        arrivals.write.mode("append").parquet(source)
        incremental.run_available(
            spark, source, arrivals.schema, rate, out, checkpoint, once=["name", "learning_objective"]
        )
    return incremental.read_results(spark, out).select(
        "tag", "objective", "guid", "rank", "gpt_reply", "score"
    )


QUERIES = {
    f.__name__: f
    for f in (
        scan_notes, scan_notes_inline, scan_vectors, scan_objectives, fill_scores, scan_ratings_csv, scan_documents, scan_pages, path_stem, assemble_text,
        write_once, append_new, resume_anti, incremental_stream, once_only_stream, largest_source,
        token_count, token_filter, truncate_text,
        split_lines, clean_objective, objective_filter, objective_counts,
        rating_prompt, generation_prompt, budget_strict, budget_clamped, parse_score,
        dim_check, dot_product, cosine, sim_rank, sim_topk, sim_topk_blocked, sim_topk_cosine,
        token_budget, poor_run_stop, select_pairs, select_pairs_fold, select_pairs_lazy,
        embed_texts, embed_retry, embed_failures, embed_notes_job, generate_failures, rate_failures,
        make_objectives, make_objectives_rejected, judge_pairs, judge_ladder,
        best_per_note, best_per_note_and_tag, relevance_bucket,
        guid_overlap, overlap_report, tag_notes, tag_report, flagship, flagship_files,
    )
}

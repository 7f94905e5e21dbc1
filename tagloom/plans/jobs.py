"""The four jobs and the run that chains them."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tagloom import schemas
from tagloom.functions import prompts
from tagloom.functions.scores import normalise_reply, parse_score
from tagloom.functions.text import token_count, with_token_count
from tagloom.functions.text import token_filter as filter_by_tokens
from tagloom.operators import inference, objectives as obj, walk
from tagloom.operators.assign import overlap_report, tag_notes, with_objective_order, write_and_count
from tagloom.operators.similarity import check_dims, objective_id, topk_similar, with_objective_id
from tagloom.params import Chat, ChatParams, Embedder, EmbedParams, Params, SelectParams, Tokenizer
from tagloom.session import is_scan, materialise, spread, tasks_for
from tagloom.sources import writers
from tagloom.sources.readers import read_largest

# Most key hashes that are broadcast; each takes some 16 bytes on an executor.
BROADCAST_KEYS = 8 << 20

# Fewest pairs of a note that are worth a copy of its text.
PART_PAIRS = 64

# Most characters that a token of a user's tokenizer is taken to stand for.
MAX_TOKEN_CHARS = 256

STAGES = ("embed", "objectives", "select", "tag")


def embed_notes(
    notes: DataFrame,
    backend: Embedder,
    params: EmbedParams = EmbedParams(),
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """Notes within the token limit, with token count and vector.

    `card_id`, a hash of the card, tells notes apart later without their texts.
    """
    short = filter_by_tokens(notes, "card", params.token_limit, tokenizer)
    short = spread(short.withColumn("card_id", F.xxhash64("card")), params.parallelism)
    return inference.embed(
        short, "card", backend,
        batch_size=params.batch_size, max_tokens=params.truncate_tokens,
        attempts=params.attempts, wait=params.wait,
    )


class Objectives(NamedTuple):
    """What `make_objectives` gives: rows, and the names of documents by what became of them."""

    made: DataFrame  # name, learning_objective, tokens, emb, line_no
    too_long: DataFrame  # name, text_tokens
    failed: DataFrame  # name, error
    asked: DataFrame  # name


def make_objectives(
    pages: DataFrame,
    chat: Chat,
    backend: Embedder,
    params: Params = Params(),
    embed_on: str = "raw",
    drop_empty: bool = False,
    tokenizer: Tokenizer | None = None,
    max_token_chars: int = MAX_TOKEN_CHARS,
) -> Objectives:
    """Embedded objectives of every document, and the documents without: too long or failed.

    A document fails when its reply or the vector of one of its objectives could
    not be had; none of its objectives is given out, so that a rerun makes all.
    Token counts and vectors come from the line as generated unless `embed_on`
    is "clean". Replies are materialised, so the chat model runs once. Documents
    too long for a prompt are found from their pages and never assembled. With a
    `tokenizer`, of whose tokens none stands for more than `max_token_chars`
    characters, those that may fit are assembled and measured whole.
    """
    if embed_on not in ("raw", "clean"):
        raise ValueError(f"unknown embed_on {embed_on!r}")
    limits = params.chat.max_tokens, params.chat.buffer
    pages, too_long = obj.split_by_length(pages, *limits, None if tokenizer is None else max_token_chars)
    documents = obj.assemble_text(pages).withColumn("prompt", prompts.generation_prompt("text"))
    if tokenizer is None:
        documents = documents.withColumn("prompt_tokens", prompts.prompt_tokens("prompt"))
    else:
        whole = documents.withColumn("prompt_text", prompts.prompt_text("prompt"))
        counted = with_token_count(whole, "prompt_text", "prompt_tokens", tokenizer)
        counted = materialise(counted.drop("prompt_text", "text"), "documents")
        fits = prompts.fits_strict("prompt_tokens", *limits)
        documents = counted.filter(fits)
        measured = counted.filter(~fits).select("name", F.col("prompt_tokens").cast("long").alias("text_tokens"))
        too_long = too_long.unionByName(measured)
    too_long = too_long.select("name", "text_tokens")
    left = prompts.remaining_tokens("prompt_tokens", *limits)
    documents = documents.select("name", "prompt", left.alias("completion_tokens"))
    replies = inference.generate(
        documents.repartition(params.chat.parallelism or tasks_for(pages)), "prompt", chat, max_tokens="completion_tokens",
        batch_size=params.chat.batch_size, attempts=params.chat.attempts, wait=params.chat.wait,
    ).select("name", "reply", "reply_error")
    asked = materialise(replies, "replies")
    replies = spread(asked.filter("reply_error IS NULL").select("name", "reply"), params.embed.parallelism)
    text = "line" if embed_on == "raw" else "learning_objective"
    lines = obj.objective_lines(replies, drop_empty=drop_empty)
    embedded = inference.embed(
        with_token_count(lines, text, tokenizer=tokenizer), text, backend,
        batch_size=params.embed.batch_size, max_tokens=params.embed.truncate_tokens,
        attempts=params.embed.attempts, wait=params.embed.wait,
    )
    embedded = materialise(embedded.select(*schemas.OBJECTIVES.names, "line_no", "emb_error"), "embedded")
    no_vector = embedded.groupBy("name").agg(F.min("emb_error").alias("error")).filter("error IS NOT NULL")
    no_reply = asked.filter("reply_error IS NOT NULL").select("name", F.col("reply_error").alias("error"))
    failed = no_reply.unionByName(no_vector)
    made = embedded.drop("emb_error").join(no_vector.select("name"), "name", "left_anti")
    return Objectives(made.select(*schemas.OBJECTIVES.names, "line_no"), too_long, failed, asked.select("name"))


class Candidates(NamedTuple):
    """Ranked pairs within the token budget, and the notes that hold their texts."""

    near: DataFrame  # obj_id, copies, key, tag, cosine_sim, objective, rank, prompt_tokens; written
    texts: DataFrame  # key, card; a key may repeat
    key: list[str]
    unique: bool  # whether no key repeats


def candidate_pairs(
    notes: DataFrame, objectives: DataFrame, params: SelectParams = SelectParams(), **options
) -> DataFrame:
    """The pairs of `find_candidates`, which takes the same options, with their texts."""
    found = find_candidates(notes, objectives, params, **options)
    return _with_texts(found.near, found).drop("card_id")


def find_candidates(
    notes: DataFrame,
    objectives: DataFrame,
    params: SelectParams = SelectParams(),
    *,
    unique_guid: bool = False,
    every_row_dims: bool = False,
    tokenizer: Tokenizer | None = None,
    min_prompt_tokens: int | None = None,
) -> Candidates:
    """Ranked pairs within the token budget, with prompt tokens.

    Equal objectives have their pairs once; `copies` is their number.
    Ranking and budget work on keys, vectors and token counts alone; only the
    pairs that are left fetch their texts. Notes are told apart by guid and
    card, or by guid alone where `unique_guid` says that is enough.

    A `tokenizer` counts whole prompts, so texts are fetched before the budget
    applies; `min_prompt_tokens`, a proven lower bound of its counts, then says
    how far down a ranking the budget can reach.
    """
    if (tokenizer is None) != (min_prompt_tokens is None):
        raise ValueError("tokenizer and min_prompt_tokens go together")
    base = prompts.rating_fixed_tokens(params.card_kind)
    question_tokens = F.lit(base) + token_count("learning_objective")
    # Sized, sent out and joined below; made once.
    objectives = materialise(
        with_objective_id(objectives.select("name", "learning_objective", "emb"))
        .withColumn("pair_tokens", question_tokens)
        .select("obj_id", "copies", "name", "learning_objective", "pair_tokens", "emb"),
        "objectives",
    )
    # Without a guid a note can get no tag; it should not spend budget either.
    own = [c for c in ("guid", "card", "tokens", "emb", "card_id") if c in notes.columns]
    notes = notes.filter("guid IS NOT NULL").select(*own)
    if not is_scan(notes):
        notes = materialise(notes, "notes")  # read twice below; a model runs once
    check_dims(notes, objectives, every_row=every_row_dims)
    key = ["guid"] if unique_guid else ["guid", "card_id"]
    if not unique_guid and "card_id" not in notes.columns:
        notes = notes.withColumn("card_id", F.xxhash64("card"))
    ranked = topk_similar(
        notes, objectives, walk.max_rated(params.token_budget, min_prompt_tokens or base),
        note_key=key, carry=["tokens"], metric=params.metric,
        budget=params.token_budget if tokenizer is None else None,
    )
    question = objectives.select("obj_id", "copies", "name", "learning_objective", "pair_tokens")
    near = ranked.join(question, "obj_id").withColumn(
        "prompt_tokens", (F.col("pair_tokens") + F.col("tokens")).cast("int")
    )
    if tokenizer is None:
        near = walk.token_budget_cut(near, ["obj_id"], "rank", params.token_budget)
    # Read more than once below; the ranking should not run again.
    near = materialise(
        near.select(
            "obj_id", "copies", *key, F.col("name").alias("tag"), "cosine_sim",
            F.col("learning_objective").alias("objective"), "rank", "prompt_tokens",
        ),
        "candidates",
    )
    found = Candidates(near, _texts_of(notes.select(*key, "card"), near, key), key, unique_guid)
    if tokenizer is not None:
        pairs = _with_texts(near, found)
        prompt = prompts.prompt_text(prompts.rating_prompt("objective", "card", params.card_kind))
        counted = with_token_count(
            pairs.withColumn("prompt_text", prompt), "prompt_text", "prompt_tokens", tokenizer
        ).drop("prompt_text", "card")
        within = walk.token_budget_cut(counted, ["obj_id"], "rank", params.token_budget)
        found = found._replace(near=materialise(within.select(*near.columns), "counted"))
    return found


def _texts_of(notes: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """The notes that `wanted` names.

    While their number allows it, hashes of the keys go to every executor, so
    that the other notes drop out where they are read and are never shuffled.
    """
    hashes = wanted.select(F.xxhash64(*key).alias("_hash")).distinct()
    if wanted.count() <= BROADCAST_KEYS or hashes.count() <= BROADCAST_KEYS:
        near = notes.withColumn("_hash", F.xxhash64(*key))
        return near.join(F.broadcast(hashes), "_hash", "left_semi").drop("_hash")
    return notes.join(wanted.select(*key).distinct(), key, "left_semi")


def _with_texts(rows: DataFrame, found: Candidates, tasks: int | None = None) -> DataFrame:
    """Rows with the `card` of their note. Texts are shuffled once a note, not once a pair.

    With `tasks`, the rows end up spread over that many: a note with more pairs than a
    quarter of a task's share meets them in several parts, each with a copy of its text.
    """
    key, texts = found.key, found.texts
    if tasks is None:
        if not found.unique:
            texts = texts.groupBy(*key).agg(F.min("card").alias("card"))
        return rows.join(texts, key)
    share = max(PART_PAIRS, rows.count() // (4 * tasks))
    parts = rows.groupBy(*key).agg(F.ceil(F.count("*") / share).cast("int").alias("_parts"))
    parts = F.broadcast(parts.filter("_parts > 1"))  # at most four a task
    part = F.coalesce(F.pmod(F.xxhash64("obj_id", "rank"), F.col("_parts")).cast("int"), F.lit(0))
    dealt = rows.join(parts, key, "left").withColumn("_part", part).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    texts = texts.join(parts, key, "left").withColumn("_part", every).drop("_parts")
    dealt, texts = (df.repartition(tasks, *key, "_part") for df in (dealt, texts))
    if not found.unique:
        texts = texts.groupBy(*key, "_part").agg(F.min("card").alias("card"))
    return dealt.join(texts, [*key, "_part"]).drop("_part")


def with_prompts(
    pairs: DataFrame, params: SelectParams = SelectParams(), chat: ChatParams = ChatParams()
) -> DataFrame:
    """Add the rating prompt and the tokens its reply may take."""
    left = prompts.remaining_clamped("prompt_tokens", chat.max_tokens, chat.buffer)
    return pairs.withColumns(
        {
            "prompt": prompts.rating_prompt("objective", "card", params.card_kind),
            "completion_tokens": left,
        }
    )


def rate_and_cut(
    pairs: DataFrame,
    judge: inference.Judge,
    params: SelectParams = SelectParams(),
    chat: ChatParams = ChatParams(),
) -> DataFrame:
    """Rate candidate pairs and keep those a walk down each ranking would visit.

    Pairs are spread over all cores first: what a call takes counts for more
    here than what a row weighs.

    "eager" rates every pair within the budget at once and cuts afterwards;
    "lazy" walks objective by objective and rates nothing in vain.
    """
    if params.mode == "eager":
        # Prompts repeat the card, so they are made where the pairs ended up.
        pairs = pairs.repartition(chat.parallelism or tasks_for(pairs))
    rated = _rate(pairs, judge, params, chat)
    return per_copy(rated).select("obj_id", *schemas.RATINGS.names)


def _rate(
    pairs: DataFrame, judge: inference.Judge, params: SelectParams, chat: ChatParams, drop: Sequence[str] = ()
) -> DataFrame:
    """Rated pairs that the walks visit, without the columns in `drop`; each tells its `copies`."""
    unused = ["prompt", "completion_tokens", *drop]
    if params.mode == "lazy":
        kept = [f for f in pairs.schema.fields if f.name not in drop]
        schema = T.StructType(
            [*kept, *inference.JUDGEMENT, T.StructField("score", T.IntegerType())]
        )
        rate = partial(
            inference.rate_frame, prompt="prompt", judge=judge, max_tokens="completion_tokens"
        )
        tasks = chat.parallelism or tasks_for(pairs)
        # Prompts repeat the card, so they are made where the pairs ended up.
        asked = with_prompts(pairs.repartition(tasks, "obj_id"), params, chat)
        walked = walk.walk_lazy(
            asked, ["obj_id"], "rank", params.token_budget, params.max_poor_run, rate, schema
        )
        walked = materialise(walked.drop(*unused), "replies")
        return walked.withColumn("gpt_reply", normalise_reply("gpt_reply"))
    if params.mode != "eager":
        raise ValueError(f"unknown mode {params.mode!r}")
    asked = with_prompts(pairs, params, chat)
    replies = inference.judge(asked, "prompt", judge, max_tokens="completion_tokens")
    # Replies are what costs; nothing after this point asks for them again.
    replies = materialise(replies.drop(*unused), "replies")
    scored = replies.withColumn("gpt_reply", normalise_reply("gpt_reply")).withColumn(
        "score", parse_score("gpt_reply")
    )
    return walk.walk_cut(scored, ["obj_id"], "rank", params.token_budget, params.max_poor_run)


def _rate_candidates(
    found: Candidates, judge: inference.Judge, params: SelectParams, chat: ChatParams
) -> DataFrame:
    """Rated pairs that the walks visit, with the keys of their notes instead of the texts.

    Texts are with the pairs only where the model is asked; neither replies nor walks move them.
    """
    tasks = chat.parallelism or max(tasks_for(found.near), tasks_for(found.texts))
    pairs = _with_texts(found.near, found, tasks if params.mode == "eager" else None)
    return _rate(pairs, judge, params, chat, drop=["card"])


def per_copy(rated: DataFrame) -> DataFrame:
    """Each row as often as its objective occurs; equal objectives are asked about once."""
    return rated.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")


def select_pairs(
    notes: DataFrame,
    objectives: DataFrame,
    judge: inference.Judge,
    params: SelectParams = SelectParams(),
    chat: ChatParams = ChatParams(),
    **options,
) -> DataFrame:
    """Rated pairs of every objective; one that occurs twice is rated once and has its rows twice."""
    found = find_candidates(notes, objectives, params, **options)
    return _told(_rate_candidates(found, judge, params, chat), found)


def _told(rated: DataFrame, found: Candidates) -> DataFrame:
    """Ratings with the texts of their notes, as often as their objective occurs."""
    return per_copy(_with_texts(rated, found)).select("obj_id", *schemas.RATINGS.names)


def select_new(
    notes: DataFrame, objectives: DataFrame, judge: inference.Judge, path: str,
    params: SelectParams = SelectParams(), chat: ChatParams = ChatParams(), **options,
) -> DataFrame:
    """Rate the objectives the table at `path` does not hold yet and append them.

    An objective's rows and its key are one append, so it is either done or not.
    One of whose ratings failed stays open: a run after an outage rates it anew.
    Its failed rows go to `path`-failed.
    """
    keyed = objectives.withColumn("obj_id", objective_id())
    done = writers.read_if_exists(notes.sparkSession, path)
    todo = writers.not_done(keyed, done, ["obj_id"])
    found = find_candidates(notes, todo.drop("obj_id"), params, **options)
    rated = materialise(_rate_candidates(found, judge, params, chat), "rated")
    failures = rated.filter("rate_error IS NOT NULL")
    open_ = failures.select("obj_id").distinct()
    _told(rated.join(open_, "obj_id", "left_anti"), found).write.mode("append").parquet(path)
    if not failures.isEmpty():
        _append_failures(_told(failures, found), f"{path.rstrip('/')}-failed")
    return notes.sparkSession.read.parquet(path)


def _append_failures(failures: DataFrame, path: str) -> None:
    if not failures.isEmpty():
        failures.write.mode("append").parquet(path)


def embed_new(
    notes: DataFrame, backend: Embedder, path: str, params: EmbedParams = EmbedParams(),
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """Embed the notes the table at `path` does not hold yet and append them.

    Notes whose vector could not be had go to `path`-failed and stay open.
    """
    done = writers.read_if_exists(notes.sparkSession, path)
    key = ["guid", "card_id"]
    todo = writers.not_done(notes.withColumn("card_id", F.xxhash64("card")), done, key)
    made = materialise(embed_notes(todo.drop("card_id"), backend, params, tokenizer), "notes")
    made.filter("emb_error IS NULL").write.mode("append").parquet(path)
    _append_failures(made.filter("emb_error IS NOT NULL"), f"{path.rstrip('/')}-failed")
    return notes.sparkSession.read.parquet(path)


def objectives_new(
    pages: DataFrame, chat: Chat, embedder: Embedder, path: str, params: Params = Params(), **options
) -> DataFrame:
    """Make the objectives of documents that are not done yet and append them.

    `path`-documents names every document that needs no further call: done
    (also without a single objective) or too long. Objectives get ordinals, by
    document and line within a run and on from the runs before. Failed ones go to
    `path`-failed and stay open. A document's rows come before its name, and
    rows without a name are found again by it, so nothing is made twice.
    """
    spark, base = pages.sparkSession, path.rstrip("/")
    named = writers.read_if_exists(spark, f"{base}-documents")
    fresh = writers.not_done(pages, named, ["name"])
    fresh = writers.not_done(fresh, writers.read_if_exists(spark, path), ["name"])
    found = make_objectives(fresh, chat, embedder, params, **options)
    writers.append_ordered(found.made, path, ["name", "line_no"])
    done = found.asked.join(found.failed.select("name"), "name", "left_anti")
    names = done.withColumn("status", F.lit("done")).unionByName(
        found.too_long.select("name", F.lit("too long").alias("status"))
    )
    names.write.mode("append").parquet(f"{base}-documents")
    _append_failures(found.failed, f"{base}-failed")
    return spark.read.parquet(path)


def run_all(
    spark: SparkSession,
    folder: str,
    *,
    judge: inference.Judge,
    chat: Chat | None = None,
    embedder: Embedder | None = None,
    notes: DataFrame | None = None,
    pages: DataFrame | None = None,
    note_table: DataFrame | None = None,
    note_tables: Sequence[str] = (),
    params: Params = Params(),
    skip: Collection[str] = (),
    tokenizer: Tokenizer | None = None,
    min_prompt_tokens: int | None = None,
    embed_on: str = "raw",
    drop_empty: bool = False,
    unique_guid: bool = False,
    every_row_dims: bool = False,
) -> DataFrame | None:
    """Embed, make objectives, select, tag; stages meet in Parquet tables below `folder`.

    Every run writes a new version of the tagged note table, and beside it the
    reports `overlap` and `tagged`. What a model failed on stays open for the
    next run and is told in the tables ending in -failed; documents too long for
    a prompt are named in `objectives-documents`.

    A stage named in `skip` is left out and its output has to be there already.
    Inputs are checked before any stage starts. Returns the tagged note table,
    or None where the last stage is skipped.

    Instead of a `note_table`, `note_tables` may name candidates: the readable one
    with most notes is tagged, the first listed among equals.

    A `tokenizer`, with `min_prompt_tokens`, counts for all limits of all stages; a
    folder should see one counter only. The other options are those of
    `make_objectives` and `candidate_pairs`.
    """
    if (tokenizer is None) != (min_prompt_tokens is None):
        raise ValueError("tokenizer and min_prompt_tokens go together")
    unknown = set(skip) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    if note_table is None and note_tables and "tag" not in skip:
        _, note_table = read_largest(spark, note_tables)
    tables = {name: f"{folder.rstrip('/')}/{name}" for name in ("notes", "objectives", "ratings", "tagged")}
    _require(spark, skip, tables, notes=notes, pages=pages, note_table=note_table)

    if "embed" not in skip:
        embed_new(notes, embedder, tables["notes"], params.embed, tokenizer)
    if "objectives" not in skip:
        objectives_new(
            pages, chat, embedder, tables["objectives"], params,
            embed_on=embed_on, drop_empty=drop_empty, tokenizer=tokenizer,
        )
    if "select" not in skip:
        select_new(
            spark.read.parquet(tables["notes"]), spark.read.parquet(tables["objectives"]),
            judge, tables["ratings"], params=params.select, chat=params.chat,
            unique_guid=unique_guid, every_row_dims=every_row_dims,
            tokenizer=tokenizer, min_prompt_tokens=min_prompt_tokens,
        )
    if "tag" in skip:
        return None
    ratings = spark.read.parquet(tables["ratings"])
    asked = writers.read_if_exists(spark, tables["objectives"])
    ordered = asked is not None and "ordinal" in asked.columns
    tagged = tag_notes(note_table, with_objective_order(ratings, asked) if ordered else ratings, params.tag)
    version = f"{tables['tagged']}/{uuid.uuid4().hex}"
    report = write_and_count(tagged, version)
    for name, found in (("overlap", overlap_report(ratings, note_table)), ("tagged", report)):
        found.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/reports/{name}")
    return spark.read.parquet(version)


def _require(spark, skip, tables, **inputs) -> None:
    wants = {"embed": "notes", "objectives": "pages", "tag": "note_table"}
    missing = [i for stage, i in wants.items() if stage not in skip and inputs[i] is None]
    if "select" not in skip:
        missing += [
            tables[t] for stage, t in (("embed", "notes"), ("objectives", "objectives"))
            if stage in skip and writers.read_if_exists(spark, tables[t]) is None
        ]
    elif "tag" not in skip and writers.read_if_exists(spark, tables["ratings"]) is None:
        missing.append(tables["ratings"])
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))

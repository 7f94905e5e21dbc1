"""Batched model calls on executors, with bounded retries and an error column.

The model is a callable the user supplies (see `tagloom.params`). Every
operator runs it under mapInArrow: a row's call happens once however often its
result is used later in the plan, and the other columns pass through untouched.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from tagloom import fixed, schemas
from tagloom.params import Chat, Embedder

# Rows that a task holds as Python values at once, or one model batch if that is larger.
HELD_ROWS = 512

def _truncate(text: str, max_tokens: int | None) -> str:
    """Row form of functions.text.truncate_text, for the retry inside a task."""
    limit = None if max_tokens is None else max_tokens * fixed.CHARS_PER_TOKEN
    if limit is None or len(text) <= limit:
        return text
    space = text.rfind(" ", 0, limit)
    return text[: space if space > limit * fixed.KEEP_FRACTION else limit]


def _score(reply: str | None) -> int | None:
    """Row form of functions.scores, to decide on a further attempt inside a task."""
    line = (reply or "").strip().replace("\n", " ")
    labelled = re.search(fixed.SCORE_PATTERN, line, re.ASCII)
    if labelled:
        return int(labelled.group(1))
    return min(map(int, re.findall(fixed.NUMBER_PATTERN, line)), default=None)


def _with_retry(call, attempts: int, wait: float, growth: float):
    """Result of a call and None, or None and the last error text."""
    error = None
    for attempt in range(attempts):
        try:
            return call(), None
        except Exception as e:  # any failure of a user's model is data here
            error = f"{type(e).__name__}: {e}"
            if attempt + 1 < attempts:
                time.sleep(wait + attempt * growth)
    return None, error


def _batched(items: list, call, batch_size: int, attempts: int, wait: float, growth: float, single):
    """Call per chunk, again after a wait while it fails; then halve it until what fails stands alone.

    So one item that a model refuses costs the others a few calls more, and every item is asked
    about by itself before it counts as failed. A service that is down or limits its rate is given
    `wait` seconds after each failure; no item is left out for its sake.
    """
    results, errors = [], []
    for start in range(0, len(items), batch_size):
        chunk = items[start : start + batch_size]
        got, error = _with_retry(lambda: _checked(call(chunk), chunk), attempts, wait, growth)
        if error is None:
            results += got
            errors += [None] * len(chunk)
        else:
            halves = _in_halves(chunk, call, wait, single)
            results += [got for got, _ in halves]
            errors += [error for _, error in halves]
    return results, errors


def _in_halves(failed: list, call, wait: float, single) -> list[tuple]:
    """Result and error of each item of a chunk whose call failed."""
    if len(failed) == 1:
        return [_with_retry(lambda: single(failed[0]), 1, wait, 0.0)]
    time.sleep(wait)
    found = []
    for half in (failed[: len(failed) // 2], failed[len(failed) // 2 :]):
        got, error = _with_retry(lambda: _checked(call(half), half), 1, wait, 0.0)
        found += [(one, None) for one in got] if error is None else _in_halves(half, call, wait, single)
    return found


def _checked(results: list, chunk: list) -> list:
    if len(results) != len(chunk):
        raise ValueError(f"model returned {len(results)} results for {len(chunk)} inputs")
    return list(results)


def _append(df: DataFrame, columns: Sequence[T.StructField], work, batch_size: int) -> DataFrame:
    """Add columns that `work` computes from an Arrow batch, as Arrow arrays.

    `work` gets some whole model batches at a time, so that a task holds few rows as Python values.
    """
    rows = batch_size * max(1, HELD_ROWS // batch_size)
    names = {c.name for c in columns}
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                arrays = [batch.column(f.name) for f in kept] + work(batch)
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
        # Workers live on; what a task has freed is given back.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def _prompts(column: pa.Array) -> list:
    """Prompts as Python values: of lists of messages, field by field, which takes a quarter of the time."""
    if not (pa.types.is_list(column.type) and pa.types.is_struct(column.type.value_type)):
        return column.to_pylist()
    flat = column.flatten()
    if flat.null_count:
        return column.to_pylist()
    names = [f.name for f in flat.type]
    values = zip(*[flat.field(i).to_pylist() for i in range(len(names))], strict=True)
    messages = (dict(zip(names, v)) for v in values)
    lengths = pc.list_value_length(column).to_pylist()
    return [None if n is None else [next(messages) for _ in range(n)] for n in lengths]


def embed(
    df: DataFrame,
    text: str,
    backend: Embedder,
    *,
    out: str = "emb",
    error: str = "emb_error",
    batch_size: int = 256,
    max_tokens: int | None = None,
    attempts: int = 3,
    wait: float = fixed.GENERATE_WAIT_SECONDS,
    growth: float = 0.0,
) -> DataFrame:
    """Add one vector per text; `error` says why a vector is missing.

    Texts are truncated to `max_tokens`. A text the model still finds too long
    is tried once more at half the limit, but at no less than 512 tokens.
    """

    def single(text: str) -> list[float]:
        try:
            return _checked(backend([_truncate(text, max_tokens)]), [text])[0]
        except Exception as e:
            too_long = any(mark in str(e).lower() for mark in fixed.OVERFLOW_MARKS)
            if not too_long or not max_tokens or max_tokens <= fixed.EMBED_FLOOR_TOKENS:
                raise
            shorter = max(fixed.EMBED_FLOOR_TOKENS, max_tokens // 2)
            return _checked(backend([_truncate(text, shorter)]), [text])[0]

    def call(texts: list[str]) -> list[list[float]]:
        return backend([_truncate(t, max_tokens) for t in texts])

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(text).to_pylist()
        at = [i for i, t in enumerate(texts) if t is not None]
        vectors, errors = [None] * len(texts), [None] * len(texts)
        got, failed = _batched(
            [texts[i] for i in at], call, batch_size, attempts, wait, growth, single
        )
        for i, vector, reason in zip(at, got, failed, strict=True):
            vectors[i], errors[i] = vector, reason
        return [pa.array(vectors, pa.list_(pa.float64())), pa.array(errors, pa.string())]

    return _append(
        df, [T.StructField(out, schemas.VECTOR), T.StructField(error, T.StringType())], work, batch_size
    )


def get_embedding(df: DataFrame, text: str, backend: Embedder, **options) -> DataFrame:
    """Only the text column and its vector."""
    return embed(df.select(text), text, backend, **options).drop(options.get("error", "emb_error"))


def generate(
    df: DataFrame,
    prompt: str,
    backend: Chat,
    *,
    max_tokens: str,
    out: str = "reply",
    error: str = "reply_error",
    temperature: float = 1.0,
    batch_size: int = 32,
    attempts: int = 3,
    wait: float = fixed.GENERATE_WAIT_SECONDS,
    growth: float = 0.0,
) -> DataFrame:
    """Add a chat reply per prompt; `max_tokens` names the column of completion limits."""

    def call(items: list[tuple]) -> list[str]:
        return backend([m for m, _ in items], temperature, [n for _, n in items])

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        items = list(
            zip(_prompts(batch.column(prompt)), batch.column(max_tokens).to_pylist(), strict=True)
        )
        replies, errors = _batched(
            items, call, batch_size, attempts, wait, growth, lambda item: _checked(call([item]), [item])[0]
        )
        return [pa.array(replies, pa.string()), pa.array(errors, pa.string())]

    return _append(
        df, [T.StructField(out, T.StringType()), T.StructField(error, T.StringType())], work, batch_size
    )


JUDGEMENT = [
    T.StructField("gpt_reply", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("rate_error", T.StringType()),
]


class Judge:
    """Rates prompts: replies without a score are asked for again, ever more freely."""

    def __init__(
        self,
        backend: Chat,
        temperatures: Sequence[float] = fixed.TEMPERATURES,
        batch_size: int = 32,
        attempts: int = 3,
        wait: float = fixed.RATE_WAIT_SECONDS,
        growth: float = fixed.RATE_WAIT_SECONDS,
    ):
        self.backend, self.temperatures, self.batch_size = backend, temperatures, batch_size
        self.attempts, self.wait, self.growth = attempts, wait, growth

    def __call__(self, prompts: list, limits: list[int]) -> dict[str, list]:
        n = len(prompts)
        replies, tries, errors, scores = [None] * n, [0] * n, [None] * n, [None] * n
        open_rows = list(range(n))
        for temperature in self.temperatures:
            if not open_rows:
                break

            def call(items, temperature=temperature):
                return self.backend([m for m, _ in items], temperature, [k for _, k in items])

            got, failed = _batched(
                [(prompts[i], limits[i]) for i in open_rows],
                call, self.batch_size, self.attempts, self.wait, self.growth,
                lambda item, call=call: _checked(call([item]), [item])[0],
            )
            for i, reply, error in zip(open_rows, got, failed, strict=True):
                replies[i], errors[i], tries[i] = reply, error, tries[i] + 1
                scores[i] = _score(reply)
            open_rows = [i for i in open_rows if scores[i] is None and errors[i] is None]
        return {"gpt_reply": replies, "attempts": tries, "rate_error": errors, "score": scores}


def judge(df: DataFrame, prompt: str, judge: Judge, *, max_tokens: str) -> DataFrame:
    """Add the reply, the number of attempts and an error to every prompt row."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        found = judge(_prompts(batch.column(prompt)), batch.column(max_tokens).to_pylist())
        return [
            pa.array(found["gpt_reply"], pa.string()),
            pa.array(found["attempts"], pa.int32()),
            pa.array(found["rate_error"], pa.string()),
        ]

    return _append(df, JUDGEMENT, work, judge.batch_size)


def rate_frame(group: pd.DataFrame, prompt: str, judge: Judge, max_tokens: str) -> pd.DataFrame:
    """The same on a pandas frame, with the score, for walks that rate as they go."""
    prompts = [
        [{"role": m["role"], "content": m["content"]} for m in messages] for messages in group[prompt]
    ]
    found = judge(prompts, group[max_tokens].tolist())
    found["score"] = pd.array(found["score"], dtype="Int32")
    return group.assign(**{k: found[k] for k in ("gpt_reply", "attempts", "rate_error", "score")})

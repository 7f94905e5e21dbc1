"""Exact nearest notes for every objective.

Scoring every objective against every note is a matrix product. Objectives of
one block, whose size is checked, are broadcast and meet the notes where they
lie. More of them are cut into blocks, notes into groups: each group of notes is
held by one task, which the blocks pass through one after another, so that notes
are shuffled once and nothing passes through the driver. A task keeps only the
best k notes per objective while it reads, fewer where a budget says so, and a
window over those few rows gives the final ranking. Once an objective has a bar,
a product in single precision, with a bound of its error, tells which notes
cannot reach it; only the others are scored. Where there are many tasks,
a first pass over some of the notes tells for every objective how similar a note
has to be at least; what is less never leaves its task. So does a block of notes where
objectives come in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tagloom.session import is_scan, materialise, splits, spread, tasks_for

# Largest objective block, in bytes of float64 components.
BLOCK_BYTES = 32 << 20
# Most rows of an objective block that a task may have to keep.
POOL_ROWS = 1 << 18
# Tasks over the notes from which a first pass sets the bar, and the tasks and rows it reads.
START_TASKS = 64
SAMPLE_TASKS = 16
SAMPLE_ROWS = 10_000
# Largest score matrix a task holds at once, in cells.
SCORE_CELLS = 1 << 20
# Objectives and notes of a rough score matrix, which stays in a core's cache.
ROUGH_ROWS, ROUGH_COLUMNS = 256, 2048
# Share of the rough scores that may be left before all are made in double precision, and the
# pairs of vectors that are laid side by side at once.
ROUGH_SHARE = 1 / 16
PAIRS_HELD = 1 << 14
# Longest vectors, as the product of two lengths, for which single precision cannot overflow.
ROUGH_LENGTH = 1e18
# Notes a task scores before it first cuts back to the best.
FIRST_ROWS = 512
# One in so many notes at most sets the bars of objectives that come in blocks.
SAMPLE_STRIDE = 4
# Lists of rows, one for each objective, that leave a task at once.
LISTS = 1024
# Notes from more input splits than this are merged in two steps.
MERGE_SPLITS = 256


def vector_dims(df: DataFrame, emb: str = "emb") -> DataFrame:
    """One row: length of the first non-empty vector, least and largest length, rows."""
    filled = F.when(F.size(emb) > 0, F.size(emb))
    return df.agg(
        F.first(filled, ignorenulls=True).alias("first_dim"),
        F.min(filled).alias("min_dim"),
        F.max(filled).alias("max_dim"),
        F.count(filled).alias("vectors"),
    )


def check_dims(
    notes: DataFrame, objectives: DataFrame, emb: str = "emb", every_row: bool = False
) -> None:
    """Raise when the two sides hold vectors of different lengths.

    Compares the first non-empty vector of each side, which takes no full scan;
    with `every_row` all of them. A side without vectors is not compared.
    """
    if every_row:
        found = [vector_dims(df, emb).first() for df in (notes, objectives)]
        lengths = {d for row in found if row["vectors"] for d in (row["min_dim"], row["max_dim"])}
        if len(lengths) > 1:
            raise ValueError(f"vector lengths differ: {sorted(lengths)}")
        return
    sizes = [df.select(F.size(emb).alias("n")).filter("n > 0").first() for df in (notes, objectives)]
    if all(sizes) and sizes[0]["n"] != sizes[1]["n"]:
        raise ValueError(
            f"vector lengths differ: notes {sizes[0]['n']}, objectives {sizes[1]['n']}"
        )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as one float64 matrix."""
    lengths = pc.unique(pc.list_value_length(column))
    values = pc.list_flatten(column)
    if len(lengths) != 1 or values.null_count:
        raise ValueError("vectors differ in length or hold nulls")
    return values.to_numpy().astype(np.float64, copy=False).reshape(len(column), -1)


def _lengths(matrix: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", matrix, matrix))


def _pair_scores(block: np.ndarray, vectors: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The products of some cells, the same for a pair wherever it is met."""
    scores = np.empty(len(rows))
    for a in range(0, len(rows), PAIRS_HELD):
        part = slice(a, a + PAIRS_HELD)
        scores[part] = np.einsum("ij,ij->i", block[rows[part]], vectors[columns[part]])
    return scores


def _unit(matrix: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _best_in_batch(scores: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the k best columns per row that reach `least`; earlier columns win ties."""
    keep = scores >= least[:, None]
    rows, columns = np.divmod(np.flatnonzero(keep), scores.shape[1])
    crowded = np.flatnonzero(np.bincount(rows, minlength=len(scores)) > k)
    if not crowded.size:
        return rows, columns
    part = scores[crowded]
    kth = -np.partition(-part, k - 1, axis=1)[:, k - 1, None]
    above = part > kth
    level = part == kth
    room = k - above.sum(axis=1, keepdims=True)
    keep[crowded] = above | (level & (np.cumsum(level, axis=1) <= room))
    return np.divmod(np.flatnonzero(keep), scores.shape[1])


def _leading(obj: np.ndarray, cost: np.ndarray | None, k: int, budget: int | None) -> np.ndarray:
    """Mask over rows sorted by objective and rank: the first k, as far as a budget reaches.

    A row is kept while the rows before it cost no more than the budget. Rows of
    other tasks can only come in between, so what is cut here is out for good.
    """
    starts = np.flatnonzero(np.r_[True, obj[1:] != obj[:-1]])
    sizes = np.diff(np.r_[starts, len(obj)])
    keep = np.arange(len(obj)) - np.repeat(starts, sizes) < k
    if budget is not None:
        before = np.cumsum(cost) - cost
        keep &= before - np.repeat(before[starts], sizes) <= budget
    return keep


def _growing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that start small and double.

    A few rows set a first bar for every objective, which spares most of the
    rows that follow the selection.
    """
    size = FIRST_ROWS
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            yield batch.slice(start, size)
            start += size
            size *= 2


class _Rough:
    """Products in single precision, to tell which cells cannot reach their objective's bar.

    Rounding the components, multiplying and adding them up changes a product by at most
    (dim + 2) units of rounding of the two lengths' product; twice that is allowed for.
    """

    def __init__(self, objectives: np.ndarray, vectors: np.ndarray, reach: np.ndarray, decimals: int | None):
        dim = objectives.shape[1]
        self.objectives, self.vectors = objectives.astype(np.float32), vectors
        rounding = 0.0 if decimals is None else 0.5 * 10.0**-decimals
        # What is too small for single precision, and for the last places of double precision.
        tiny = dim * 1e-30
        self.noise = (dim + 4) * 2.0**-51 * (reach + rounding) + tiny
        self.slack = (dim + 4) * 2.0**-23 * reach + 1.001 * rounding + self.noise

    def cells(self, part: slice, least: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Row and column of the cells that may reach `least`, or None if they are many."""
        bar = least[part] - self.slack[part]
        room = ROUGH_SHARE * len(bar) * len(self.vectors)
        if np.count_nonzero(np.isneginf(bar)) > ROUGH_SHARE * len(bar):
            return None
        low = np.nextafter(bar.astype(np.float32), np.float32(-np.inf))[:, None]
        found = []
        for start in range(0, len(self.vectors), ROUGH_COLUMNS):
            scores = self.objectives[part] @ self.vectors[start : start + ROUGH_COLUMNS].T
            row, column = np.divmod(np.flatnonzero(scores >= low), scores.shape[1])
            room -= len(row)
            if room < 0:
                return None
            found.append((row, column + start))
        rows, columns = zip(*found, strict=True)
        return np.concatenate(rows), np.concatenate(columns)


@dataclass
class _Notes:
    """A batch of notes in key order, ready to be scored."""

    rows: pa.Table
    vectors: np.ndarray
    rough: np.ndarray | None  # the vectors in single precision, where that can bound a product
    longest: float
    cost: np.ndarray | None


@dataclass
class _Nearest:
    """Task-side scan: batches of notes in, the nearest notes per objective out."""

    k: int
    obj_key: str
    emb: str
    key: list[str]
    carry: list[str]
    metric: str
    decimals: int | None
    cost: str | None
    budget: int | None

    def block(self, table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, vectors, costs and starting bars of a block of objectives."""
        matrix = _matrix(table.column(self.emb)) if table.num_rows else np.zeros((0, 1))
        if self.metric == "cosine":
            matrix = _unit(matrix)
        ids = pa.concat_arrays(table.column(self.obj_key).chunks or [pa.array([], pa.int64())])
        return ids, matrix, table.column("_price").to_numpy(), table.column("_bar").to_numpy()

    def ready(self, batches: Iterator[pa.RecordBatch]) -> Iterator[_Notes]:
        """Notes as they are scored, in batches that grow; many blocks may pass through them."""
        for batch in _growing(batches):
            # In key order, so that among equals the first column is the one to keep.
            rows = pa.Table.from_batches([batch])
            rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in self.key]))
            vectors = _matrix(rows.column(self.emb))
            if self.metric == "cosine":
                vectors = _unit(vectors)
            cost = rows.column(self.cost).to_numpy() if self.cost else None
            longest = _lengths(vectors).max(initial=0.0)
            # What is no number, or too large, has no bound in single precision.
            rough = vectors.astype(np.float32) if longest < ROUGH_LENGTH else None
            yield _Notes(rows.select([*self.key, *self.carry]), vectors, rough, longest, cost)

    def bars(self, block, notes: Iterator[_Notes]) -> np.ndarray:
        """For every objective of a block, the similarity at which these notes spend k or the budget."""
        least = block[3].copy()
        self._pass(block, notes, least)
        return least

    def _pass(self, block, notes: Iterator[_Notes], least: np.ndarray) -> pa.Table | None:
        """The nearest of the notes; raises the bars in `least`."""
        ids, objectives, obj_cost, _ = block
        if not len(ids):
            return None
        pool: list[pa.Table] = []
        settled = 0  # rows of the pool at its last cut
        for part in notes:
            found = self._scan(part, objectives, obj_cost, least)
            if found is None:
                continue
            pool.append(found)
            if sum(map(len, pool)) > 1.5 * settled:
                pool = [self._cut(pool, least)]
                settled = len(pool[0])
        return self._cut(pool, least) if pool else None

    def __call__(self, block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = self._pass(block, self.ready(batches), block[3].copy())
        if best is not None:
            ids = block[0]
            keys = ids.take(best.column("_obj"))
            out = best.select([*self.key, *self.carry, "cosine_sim"]).add_column(0, self.obj_key, keys)
            del best, keys
            yield from out.combine_chunks().to_batches(max_chunksize=65536)
        # Workers live on; what a task has freed is given back.
        pa.default_memory_pool().release_unused()

    def packed(self, block, notes: Iterator[_Notes]) -> Iterator[pa.RecordBatch]:
        """The same as a list for each objective, nearest first: `far`, the key, and what is carried."""
        best = self._pass(block, notes, block[3].copy())
        if best is not None and len(best):
            obj = best.column("_obj").to_numpy()
            starts = np.flatnonzero(np.r_[True, obj[1:] != obj[:-1]])
            names = [*self.key, *self.carry]
            far = pa.array(-best.column("cosine_sim").to_numpy())
            columns = [far, *[pa.concat_arrays(best.column(c).chunks) for c in names]]
            rows = pa.StructArray.from_arrays(columns, ["far", *names])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(obj)], pa.int32()), rows)
            ids = block[0].take(pa.array(obj[starts]))
            del best, columns
            yield from pa.table({self.obj_key: ids, "found": lists}).to_batches(max_chunksize=LISTS)
        # Workers live on; what a task has freed is given back.
        pa.default_memory_pool().release_unused()

    def _scan(self, notes: _Notes, objectives, obj_cost, least) -> pa.Table | None:
        vectors, note_cost = notes.vectors, notes.cost
        if vectors.shape[1] != objectives.shape[1]:
            raise ValueError(
                f"vector lengths differ: notes {vectors.shape[1]}, objectives {objectives.shape[1]}"
            )
        reach = _lengths(objectives) * notes.longest
        plain = notes.rough is not None and bool(reach.max(initial=0.0) < ROUGH_LENGTH)
        plain = plain and bool(_lengths(objectives).max(initial=0.0) < ROUGH_LENGTH)
        rough = _Rough(objectives, notes.rough, reach, self.decimals) if plain else None
        step = min(len(objectives), max(1, SCORE_CELLS // len(vectors)))
        cells = np.empty(0)
        found = []
        start = 0
        while start < len(objectives):
            part = slice(start, start + (ROUGH_ROWS if rough else step))
            near = rough.cells(part, least) if rough else None
            if near is None:
                part = slice(start, start + step)
                block = objectives[part]
                if not cells.size:
                    cells = np.empty(step * len(vectors))
                scores = cells[: len(block) * len(vectors)].reshape(len(block), -1)
                np.matmul(block, vectors.T, out=scores)
                if self.decimals is not None:
                    np.round(scores, self.decimals, out=scores)
                if not plain:  # what is no number ranks last
                    np.copyto(scores, -np.inf, where=np.isnan(scores))
                lowest = least[part] - rough.noise[part] if rough else least[part]
                near = _best_in_batch(scores, lowest, self.k)
            obj, note = near
            sim = _pair_scores(objectives[part], vectors, obj, note) if plain else scores[obj, note]
            if plain and self.decimals is not None:
                np.round(sim, self.decimals, out=sim)
            keep = sim >= least[part][obj]
            obj, note, sim = obj[keep] + start, note[keep], sim[keep]
            start = part.stop
            if not obj.size:
                continue
            if self.budget is not None or np.bincount(obj - part.start).max() > self.k:
                order = np.lexsort((note, -sim, obj))
                obj, note, sim = obj[order], note[order], sim[order]
                price = obj_cost[obj] + note_cost[note] if self.budget is not None else None
                keep = _leading(obj, price, self.k, self.budget)
                obj, note, sim = obj[keep], note[keep], sim[keep]
            found.append((obj, note, sim))
        if not found:
            return None
        obj, note, sim = (np.concatenate(part) for part in zip(*found, strict=True))
        out = notes.rows.take(pa.array(note))
        if self.budget is not None:
            out = out.append_column("_cost", pa.array(obj_cost[obj] + note_cost[note]))
        return out.append_column("_obj", pa.array(obj)).append_column("cosine_sim", pa.array(sim))

    def _cut(self, pool: list[pa.Table], least: np.ndarray) -> pa.Table:
        """The pool's leading rows per objective; raises the bar for full objectives."""
        rows = pa.concat_tables(pool)
        by_key = [(c, "ascending") for c in self.key]
        rows = rows.take(
            pc.sort_indices(rows, [("_obj", "ascending"), ("cosine_sim", "descending"), *by_key])
        )
        obj = rows.column("_obj").to_numpy()
        cost = rows.column("_cost").to_numpy() if self.budget is not None else None
        keep = _leading(obj, cost, self.k, self.budget)
        rows, obj = rows.filter(pa.array(keep)), obj[keep]
        last = np.flatnonzero(np.r_[obj[1:] != obj[:-1], True])
        full = np.diff(np.r_[-1, last]) >= self.k
        if self.budget is not None:
            spent = np.cumsum(cost[keep])[last]
            full |= np.diff(np.r_[0, spent]) > self.budget
        least[obj[last[full]]] = rows.column("cosine_sim").to_numpy()[last[full]]
        return rows


def _keep_best(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= k)


def objective_id(key: Sequence[str] = ("name", "learning_objective"), emb: str = "emb") -> Column:
    """A hash of the key and the vector; a missing name is not a missing text."""
    return F.xxhash64(*key, emb, *[F.col(c).isNull() for c in key])


def with_objective_id(
    objectives: DataFrame, key: Sequence[str] = ("name", "learning_objective"), emb: str = "emb"
) -> DataFrame:
    """Add `obj_id`; rows equal in key and vector become one, and `copies` tells how many there were.

    Columns of these two names are replaced. Different objectives whose hashes agree stay apart:
    all but the first take another id.
    """
    rest = [c for c in objectives.columns if c not in (*key, emb, "obj_id", "copies")]
    keyed = objectives.select(*key, emb, *rest).withColumn("obj_id", objective_id(key, emb))
    whole = F.first(F.struct(*rest)).alias("_rest") if rest else F.lit(None).alias("_rest")
    once = keyed.groupBy("obj_id", *key, emb).agg(F.count("*").alias("copies"), whole)
    place = F.row_number().over(Window.partitionBy("obj_id").orderBy(*key, emb))
    apart = once.withColumn("_place", place).select(
        *[c for c in objectives.columns if c in (*key, emb)],
        *[F.col("_rest")[c].alias(c) for c in rest],
        F.when(F.col("_place") == 1, F.col("obj_id")).otherwise(F.xxhash64("obj_id", "_place")).alias("obj_id"),
        "copies",
    )
    own = [c for c in objectives.columns if c not in ("obj_id", "copies")]
    return apart.select(*own, "obj_id", "copies")


def topk_similar(
    notes: DataFrame,
    objectives: DataFrame,
    k: int,
    *,
    note_key: Sequence[str] = ("guid",),
    obj_key: str = "obj_id",
    carry: Sequence[str] = (),
    emb: str = "emb",
    metric: str = "dot",
    decimals: int | None = None,
    budget: int | None = None,
    cost: str = "tokens",
    obj_cost: str = "pair_tokens",
    block_bytes: int = BLOCK_BYTES,
    start_tasks: int | None = START_TASKS,
) -> DataFrame:
    """The k most similar notes of every objective: keys, `carry`, similarity, rank.

    Ties go to the smaller note key. `obj_key` is unique per objective, `carry`
    names further note columns to keep, `decimals` rounds similarities before
    ranking. Rows without a vector take no part.

    With a `budget`, rows whose predecessors cost more than it may be left out:
    a pair costs the note's `cost` plus the objective's `obj_cost`. Tasks then
    pass on far fewer than k rows; `walk.token_budget_cut` makes the final cut.

    From `start_tasks` tasks over the notes on (None: never), some of them are
    scored first, to set the bar that the others start from. Results are equal.
    """
    if metric not in ("dot", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    has_vector = F.size(F.coalesce(emb, F.array())) > 0
    note_columns = list(dict.fromkeys([*note_key, *carry, *([cost] if budget is not None else [])]))
    notes = notes.filter(has_vector).select(*note_columns, emb)
    price = F.col(obj_cost) if budget is not None else F.lit(0)
    objectives = objectives.filter(has_vector).select(obj_key, emb, price.alias("_price"))
    if start_tasks is not None and tasks_for(notes) >= start_tasks:
        objectives = _with_bars(
            notes, objectives, k, note_key=note_key, obj_key=obj_key, emb=emb, metric=metric,
            decimals=decimals, budget=budget, cost=cost, block_bytes=block_bytes,
        )
    else:
        objectives = objectives.withColumn("_bar", F.lit(-math.inf))

    size = objectives.agg(F.count("*").alias("n"), F.max(F.size(emb)).alias("dim")).first()
    by_bytes = math.ceil(size["n"] * (size["dim"] or 0) * 8 / block_bytes)
    blocks = max(1, by_bytes, math.ceil(size["n"] * k / POOL_ROWS))

    schema = T.StructType(
        [
            objectives.schema[obj_key],
            *[notes.schema[c] for c in (*note_key, *carry)],
            T.StructField("cosine_sim", T.DoubleType()),
        ]
    )
    scan = _Nearest(
        k, obj_key, emb, list(note_key), list(carry), metric, decimals,
        cost if budget is not None else None, budget,
    )
    order = [F.desc("cosine_sim"), *[F.asc(c) for c in note_key]]
    parts = min(splits(notes), MERGE_SPLITS**2)

    def merged(found: DataFrame) -> DataFrame:
        if parts > MERGE_SPLITS:
            salt = F.pmod(F.xxhash64(*note_key), F.lit(math.isqrt(parts)))
            found = _keep_best(found.withColumn("salt", salt), [obj_key, "salt"], order, k)
            found = found.drop("salt", "rank")
        return _keep_best(found, [obj_key], order, k)

    if blocks > 1:
        return _in_grid(notes, objectives, blocks, scan, schema, block_bytes // (8 * size["dim"]))
    # Bounded: one block holds about `block_bytes`.
    block = notes.sparkSession.sparkContext.broadcast(scan.block(objectives.toArrow()))
    return merged(notes.mapInArrow(lambda batches: scan(block.value, batches), schema))


def _some_rows(notes: DataFrame) -> DataFrame:
    """The first rows of some of the tasks that read the notes; the others read nothing."""
    stride = max(1, tasks_for(notes) // SAMPLE_TASKS)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if TaskContext.get().partitionId() % stride:
            return
        left = SAMPLE_ROWS
        for batch in batches:
            yield batch.slice(0, left)
            left -= batch.num_rows
            if left <= 0:
                return

    return notes.mapInArrow(first, notes.schema)


def _with_bars(notes, objectives, k, *, obj_key, budget, cost, **options) -> DataFrame:
    """Add `_bar`: the similarity at which some of the notes spend k or the budget already.

    These notes are among all notes, so what is less similar cannot be in the result.
    """
    objectives = materialise(objectives, "objectives")
    found = topk_similar(
        materialise(_some_rows(notes), "some-notes"), objectives, k, obj_key=obj_key, budget=budget,
        cost=cost, obj_cost="_price", carry=[cost] if budget is not None else [], start_tasks=None, **options,
    )
    spent = F.col("rank") == k
    if budget is not None:
        found = found.join(objectives.select(obj_key, "_price"), obj_key)
        used = F.sum(F.col(cost) + F.col("_price")).over(Window.partitionBy(obj_key).orderBy("rank"))
        found = found.withColumn("_used", used)
        spent |= F.col("_used") > budget
    bars = found.groupBy(obj_key).agg(F.max(F.when(spent, F.col("cosine_sim"))).alias("_bar"))
    # Read for its size and for its rows.
    return materialise(
        objectives.join(bars, obj_key, "left").withColumn("_bar", F.coalesce("_bar", F.lit(-math.inf))), "bars"
    )


def _barred(notes: DataFrame, objectives: DataFrame, scan: _Nearest, tasks: int, rows: int) -> DataFrame:
    """Objectives with `_bar` raised to what a block of the notes sets, at most `rows` of them.

    These notes go to the objectives, so a bar is found once and not in every group; then few rows of
    a group reach it, and few rows of all groups have to be merged.
    """
    each = math.ceil(rows / tasks)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, skip = each, 0
        for batch in batches:
            at = np.arange(skip, batch.num_rows, SAMPLE_STRIDE)[:left]
            skip = (skip - batch.num_rows) % SAMPLE_STRIDE
            left -= len(at)
            yield batch.take(pa.array(at))
            if left <= 0:
                return

    # Bounded: one block, as of objectives.
    sample = notes.mapInArrow(some, notes.schema).toArrow().combine_chunks().slice(0, rows)
    if len(sample) < FIRST_ROWS:  # a group finds as good a bar by itself
        return objectives
    held = notes.sparkSession.sparkContext.broadcast(sample)
    step = max(1, POOL_ROWS // scan.k)

    def raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = list(scan.ready(iter(held.value.to_batches(max_chunksize=SAMPLE_ROWS))))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                bars = scan.bars(scan.block(pa.Table.from_batches([part])), iter(ready))
                at = part.schema.get_field_index("_bar")
                yield part.set_column(at, part.schema.field(at), pa.array(bars, part.schema.field(at).type))

    return spread(objectives).mapInArrow(raised, objectives.schema)


def _packed_schema(schema: T.StructType, scan: _Nearest) -> T.StructType:
    """Of `scan.packed`, where `schema` is that of its single rows."""
    row = T.StructType([T.StructField("far", T.DoubleType()), *[schema[c] for c in (*scan.key, *scan.carry)]])
    return T.StructType([schema[scan.obj_key], T.StructField("found", T.ArrayType(row))])


def _merge_lists(found: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The k best of the lists of every objective; there is one list from a group of notes, of k rows at most."""
    rows = F.sort_array(F.flatten(F.collect_list("found")))
    return found.repartition(*by).groupBy(*by).agg(F.slice(rows, 1, k).alias("found"))


def _in_grid(notes, objectives, blocks, scan, schema, sample) -> DataFrame:
    """Every block of objectives passes through every group of notes.

    A task holds one group, about one input split of notes, and one block at a time, however many
    there are. Notes are shuffled once, objectives once for each group. At most `sample` notes set
    the bars first.
    """
    # Read twice; and a row keeps its group when a lost executor has it read again.
    if not is_scan(notes):
        notes = materialise(notes, "note-groups")
    groups = tasks_for(notes)
    objectives = _barred(notes, objectives, scan, groups, sample)
    # Dealt by position, so that copies of one note do not crowd a group.
    group = F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int")
    notes = notes.select(F.lit(-1).alias("obj_block"), group.alias("note_group"), F.struct(*notes.columns).alias("note"))
    asked = objectives.select(
        F.pmod(F.xxhash64(scan.obj_key), F.lit(blocks)).cast("int").alias("obj_block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("note_group"),
        F.struct(*objectives.columns).alias("asked"),
    )
    both = notes.unionByName(asked, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        ready: list[_Notes] = []
        block: list[pa.RecordBatch] = []
        at = -1
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(edges, edges[1:]):
                if numbers[a] != at:
                    yield from passed(block, held, ready)
                    at, block = numbers[a], []
                part = batch.slice(a, b - a)
                if at == -1:
                    held.append(pa.RecordBatch.from_struct_array(part.column(2)))
                else:
                    block.append(pa.RecordBatch.from_struct_array(part.column(3)))
        yield from passed(block, held, ready)

    def passed(block, held, ready):
        if held and block:  # the notes come first, and are made ready once
            ready += scan.ready(iter(held))
            held.clear()
        if block and ready:
            yield from scan.packed(scan.block(pa.Table.from_batches(block)), iter(ready))

    cells = both.repartitionById(groups, "note_group").sortWithinPartitions("obj_block")
    found = cells.select("obj_block", "note_group", "note", "asked").mapInArrow(run, _packed_schema(schema, scan))
    if groups > MERGE_SPLITS:
        salt = F.pmod(F.spark_partition_id(), F.lit(math.isqrt(groups)))
        found = _merge_lists(found.withColumn("salt", salt), [scan.obj_key, "salt"], scan.k)
    found = _merge_lists(found, [scan.obj_key], scan.k)
    place = F.posexplode("found").alias("place", "row")
    return found.select(scan.obj_key, place).select(
        scan.obj_key, *[F.col("row")[c].alias(c) for c in (*scan.key, *scan.carry)],
        (-F.col("row")["far"]).alias("cosine_sim"), (F.col("place") + 1).alias("rank"),
    )

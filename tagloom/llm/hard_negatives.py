"""Hard negatives of anchor vectors, from exact integer scores by the method of the four Russians.

Components become the integers floor(256 x). For every eight dimensions of an anchor a table holds
the sums of all 256 subsets of its components. A candidate is stored as bit planes, two's
complement, eight dimensions to a byte; each byte is the index of a subset. A plane's share of an
inner product is so a sum of one lookup per eight dimensions, and planes are joined by shifting
and adding. Scores are exact: no floating point takes part.

All rows are dealt by position to groups of bounded size and shuffled once per pass. A copy of the
anchors follows the rows of each group; a task holds the planes of its rows, streams the anchors
in blocks, and gives out the best of its rows for each. Nothing is broadcast or collected, and
labels, however uneven, do not decide where a row goes.
The first pass finds the positives of each anchor, the second its negatives: for each positive
those whose score lies between two shares of the positive's.

Rules for odd input: rows with a null vec_id, label or vector, or with a null, infinite or NaN
component take no part, nor do those with a component beyond +-65,536 or with over 16,384 of them,
whose products could exceed 64 bits; a shorter vector counts as filled up with zeros, an empty one
scores 0; repeated rows and ids are rows of their own, an anchor leaves out only itself; ties go
to the smaller vec_id; anchors without positives, and positives without negatives, give no rows;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.common import table
from tagloom.session import cores, materialise

#: A component x counts as floor(UNIT * x).
UNIT = 256
LARGEST = 65_536
DIMENSIONS = 16_384
#: Bytes of integers in a group of rows, and anchors whose tables a task holds at once.
GROUP_BYTES = 128 << 20
BLOCK = 128
#: Rows scored in one go, and rows whose scores are held before the best are taken.
STEP = 512
HELD = 1 << 15


def participants(vectors: DataFrame, label: Column | str = "label") -> DataFrame:
    """row (a number of its own), vec_id, label, v (integers) of the rows that take part."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(whole, lambda x: F.coalesce(F.abs(x) <= LARGEST, F.lit(False)))
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.when(fine, F.transform(whole, lambda x: F.floor(x * UNIT).cast("int"))).alias("v"),
    )
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    # Numbers have to stay the same in both passes.
    return materialise(rows.filter(F.size("v") <= DIMENSIONS), "vectors")


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of integers as rows of `dims` columns, filled up with zeros."""
    lengths = pc.list_value_length(column).to_numpy()
    values = pc.list_flatten(column).to_numpy()
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def bit_planes(v: np.ndarray) -> np.ndarray:
    """planes x rows x bytes: bit p of eight neighbouring components in a byte, the last plane the sign."""
    largest = max(int(v.max(initial=0)), -int(v.min(initial=0)) - 1)
    padded = np.zeros((len(v), -(-v.shape[1] // 8) * 8), v.dtype)
    padded[:, : v.shape[1]] = v
    return np.stack(
        [
            np.packbits((padded >> p) & 1 != 0, axis=1, bitorder="little")
            for p in range(largest.bit_length() + 1)
        ]
    )


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """bytes x 256 x anchors: for each eight dimensions the sums of all subsets, by doubling."""
    padded = np.zeros((len(anchors), -(-anchors.shape[1] // 8) * 8), kind)
    padded[:, : anchors.shape[1]] = anchors
    eights = padded.reshape(len(anchors), -1, 8)
    sums = np.zeros((eights.shape[1], 256, len(anchors)), kind)
    for bit in range(8):
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + eights[:, :, bit].T[:, None, :]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """rows x anchors: inner products by lookups, shifts and additions."""
    n, wide = planes.shape[1], sums.shape[2]
    out = np.zeros((n, wide), sums.dtype)
    found = np.empty((min(n, STEP), wide), sums.dtype)
    for first in range(0, n, STEP):
        total = out[first : first + STEP]
        at = found[: len(total)]
        for p in range(len(planes) - 1, -1, -1):
            total *= 2
            for byte, rows in enumerate(planes[p, first : first + STEP].T):
                np.take(sums[byte], rows, axis=0, out=at, mode="clip")
                total += at
            if p == len(planes) - 1:  # the sign counts negative
                np.negative(total, out=total)
    return out


def _first(place: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Which of the places come first: higher scores, then smaller places."""
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        above = np.flatnonzero(score > kth)
        chosen = np.concatenate([above, np.flatnonzero(score == kth)[: k - len(above)]])
    else:
        chosen = np.arange(len(score))
    return chosen[np.lexsort((place[chosen], -score[chosen]))]


class _Group:
    """The rows of one group: planes in blocks of rows, sorted by id, and where each label is."""

    def __init__(self, rows: pa.Table, dims: int):
        self.row, self.vec_id, label = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.parts = []
        for at in range(0, len(rows), HELD):
            v = matrix(rows.column("v").slice(at, HELD), dims)
            own = label[at : at + HELD]
            same = {x: np.flatnonzero(own == x) for x in np.unique(own).tolist()}
            self.parts.append((at, bit_planes(v), own, same))

    def scored(self, anchors: np.ndarray, labels: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Anchor, places and scores of all rows that have its label, or of all that have not."""
        none = np.zeros(0, np.int64)
        for at, planes, own, places in self.parts:
            most = int(np.abs(anchors).sum(1).max(initial=0)) << len(planes)
            found = scores(planes, subset_sums(anchors, np.int32 if most < 1 << 31 else np.int64))
            found = np.ascontiguousarray(found.T)
            for i, label in enumerate(labels.tolist()):
                place = places.get(label, none) if same else np.flatnonzero(own != label)
                yield i, at + place, found[i, place].astype(np.int64)


def _best(spread: DataFrame, dims: int, positives: int | None, negatives: int, low: int, high: int) -> DataFrame:
    """anchor, floor, row, vec_id, score: the first rows of each group for each anchor.

    `spread` has the rows of each group before its anchors (is_anchor, group). With `positives`
    those of the anchor's label; else, for each of its `floors` (scores of positives), those of
    other labels between two shares of it.
    """

    def wanted(group: _Group, block: pa.Table) -> Iterator[tuple]:
        labels, own = (block.column(c).to_numpy() for c in ("label", "row"))
        floors = block.column("floors").to_pylist()
        for i, place, score in group.scored(matrix(block.column("v"), dims), labels, positives is not None):
            if positives is not None:
                other = group.row[place] != own[i]
                place, score = place[other], score[other]
                at = _first(place, score, positives)
                yield own[i], None, place[at], score[at]
                continue
            for floor in floors[i] or ():
                fits = (100 * score >= low * floor) & (100 * score <= high * floor)
                near, their = place[fits], score[fits]
                at = _first(near, their, negatives)
                yield own[i], floor, near[at], their[at]

    def out(group: _Group, block: pa.Table) -> pa.RecordBatch:
        found = [f for f in wanted(group, block) if len(f[2])]
        sizes = [len(f[2]) for f in found]
        place = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
        score = np.concatenate([f[3] for f in found]) if found else np.zeros(0, np.int64)
        anchor = np.repeat(np.array([f[0] for f in found], np.int64), sizes)
        floor = np.repeat(np.array([f[1] or 0 for f in found], np.int64), sizes)
        columns = [anchor, floor, group.row[place], group.vec_id[place], score]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["anchor", "floor", "row", "vec_id", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at, group = None, None
        for batch in batches:
            keys = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                part = batch.slice(a, b - a)
                if part.num_rows and keys[a] % 2 == 0:
                    if at != keys[a]:
                        held, at, group = [], keys[a], None
                    held.append(part)
                elif part.num_rows and at == keys[a] - 1:
                    if group is None:
                        group = _Group(pa.Table.from_batches(held), dims)
                        held = []
                    for first in range(0, part.num_rows, BLOCK):
                        yield out(group, pa.Table.from_batches([part.slice(first, BLOCK)]))

    return (
        spread.repartition("group")
        .sortWithinPartitions("group", "is_anchor", "vec_id", "row")
        .mapInArrow(run, "anchor long, floor long, row long, vec_id long, score long")
    )


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, of `participants`.

    For every anchor its first `positives` other rows of the same label, and for each of them the
    first `negatives` rows of other labels with low % to high % of the positive's score. Higher
    scores come first, then smaller ids.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims")).first()
    dims = max(size["dims"] or 0, 1)
    # 8 bytes a component while planes are made; a group is bounded however many rows there are.
    groups = max(2 * cores(rows.sparkSession), -(-size["n"] * dims * 8 // GROUP_BYTES))
    columns = ["group", "is_anchor", "row", "vec_id", "label", "v", "floors"]
    floors = F.lit(None).cast("array<long>").alias("floors")
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
    dealt = dealt.withColumn("is_anchor", F.lit(0)).select(*columns[:-1], floors)
    anchors = rows.filter(is_anchor)

    def best(asked: DataFrame, positives_: int | None) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
        copies = asked.select("*", every).withColumn("is_anchor", F.lit(1)).select(*columns)
        found = _best(dealt.unionByName(copies), dims, positives_, negatives, low, high)
        order = Window.partitionBy("anchor", "floor").orderBy(F.desc("score"), "vec_id", "row")
        ranked = found.withColumn("rank", F.row_number().over(order))
        return ranked.filter(F.col("rank") <= (positives_ or negatives))

    near = best(anchors.select("*", floors), positives)
    near = materialise(near.select("anchor", "vec_id", "score", F.col("rank").alias("place")), "positives")
    floor = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("floors"))
    far = best(anchors.join(floor, "row"), None)
    far = far.select("anchor", F.col("floor").alias("score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return near.join(far, ["anchor", "score"]).join(named, "anchor").select(
        "anchor_id",
        F.col("vec_id").alias("positive_id"),
        "rank",
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = participants(table(spark, sf_dir, "embeddings"), moved)
    return mine(rows, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH part AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM part AS a JOIN part AS b ON a.vec_id % 100 = 0 AND a.r <> b.r
), positive AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, other, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.vec_id, n.other)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive AS p JOIN scored AS n USING (anchor)
WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.vec_id, n.other) <= 10
"""

"""N-gram Jaccard join by chosen paths: all links between texts of similar five-word shingles.

A text is the set of its shingles, each a 64-bit hash; equal sets collapse to one node first.
Every run lets each set choose a few of its tokens, by a hash that all sets share, so that
similar sets choose some of the same; a chosen token is a path. Paths of one set are dropped,
buckets of up to `limit` sets are compared by brute force, larger ones are split again by
tokens chosen under their path. Runs repeat until a pair at the threshold is missed with
probability below 1 - `recall`. Brute force compares 256-bit sketches and leaves a spanning
forest of what looks similar; the clusters of that forest are then compared exactly, in blocks
of bounded size, which counts each link once and never writes pairs.

Splitting never thins out a bucket of near copies, which share all their tokens. So the sets of a
large bucket are first compared with a few leaders out of it, and those that look like one join its
family. If all but `limit` sets are of one family, the others meet every part of it by brute force
and the bucket is done. So is one of few parts, which meet pair by pair. Else it is split, and deeper buckets that hold one family alone are
dropped: their sets are in one cluster already, whose links are all counted.

Rules for odd input: words are runs of characters other than ASCII white space, in lower case;
a text of one to four words is one shingle; null texts and texts without words link to nothing
and are classes of their own; repeated rows are linked copies; a class is named by its smallest
doc_id; columns other than doc_id and text are ignored; texts of any length are read whole. Rows
are told apart by numbers of their own, so ids may be null or repeated; a class without any id
has none for a name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.common import few_rows, id_text, numbered, release, table
from tagloom.session import materialise

WORDS = 5
SIMILARITY = 0.8
RECALL = 1 - 1e-6
#: Expected tokens that a pair at the threshold chooses in common, and levels of paths.
SHARED = 2.0
LEVELS = 6
#: Sets in a bucket that is compared by brute force, and in a block of exact comparison.
LIMIT = 2048
BLOCK = 2048
#: Parts of `limit` sets of a bucket that meet pair by pair. So a set has as many copies; split, it has
#: SHARED / SIMILARITY on every further level, and a bucket of sets that share a passage gets no smaller.
PAIRED = 4
#: Tokens of all the sets in such a block, on average.
BLOCK_TOKENS = 1 << 19
#: Sets of a large bucket that the others are first compared with.
LEADERS = 16
#: Bits of a sketch, and how many must agree; a pair at 0.8 agrees in 230 on average.
SKETCH = 256
AGREE = 196
#: Bytes of numbers that may be broadcast.
BROADCAST_BYTES = 8 << 20
#: Rows of a block whose products are made at a time.
STRIPE = 256
#: Bytes of text that are hashed at a time.
PART = 1 << 17

ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(name: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * ODD + np.uint64(name))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD6E8FEB86659FD93
    inverse = pow(base, -1, 1 << 64)
    return tuple(
        np.multiply.accumulate(np.array([1] + [b] * size, np.uint64)) for b in (base, inverse)
    )


def _word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word, from its bytes."""
    letters = np.frombuffer(data, np.uint8)
    white = np.ones(len(letters) + 2, bool)
    white[1:-1] = (letters == 32) | ((letters >= 9) & (letters <= 13))
    edge = np.flatnonzero(white[1:] != white[:-1])
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(1 << max(len(letters) + 1, PART).bit_length())
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters * power[: len(letters)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * ODD)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    data = (text or "").lower().encode("utf-8", "surrogatepass")
    parts, at = [], 0
    while at < len(data):
        end = at + PART
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        parts.append(_word_hashes(data[at:end]))
        at = end
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(words):
        return words
    size = min(WORDS, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k, factor in enumerate(seeds(7, size)):
        total += words[k : len(words) - size + 1 + k] * factor
    return np.unique(mix(total))


def _cut(n: np.ndarray | int, similarity: float) -> np.uint64:
    """Hashes below this are chosen by a set of n tokens."""
    share = min(1.0, SHARED / (similarity * max(n, 1)))
    return np.uint64(min(int(share * 2.0**64), 2**64 - 1))


def runs_for(recall: float) -> int:
    """Runs after which a pair at the threshold is found with this probability."""
    lost = 0.0
    for _ in range(LEVELS):
        lost = math.exp(-SHARED * (1 - lost))
    return math.ceil(math.log(1 - recall) / math.log(lost))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """One bit of each of 256 minimum hashes, packed into four numbers."""
    factors = (seeds(11, SKETCH) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
    short = (tokens >> np.uint64(32)).astype(np.uint32)
    least = np.full(SKETCH, 2**32 - 1, np.uint32)
    for at in range(0, len(short), 1 << 14):
        np.minimum(least, (short[None, at : at + (1 << 14)] * factors).min(1), out=least)
    return np.packbits((mix(least.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).view(np.uint64)


def _node(tokens: np.ndarray) -> int:
    """A hash of a whole set."""
    total = mix(tokens ^ seeds(3, 1)[0]).sum(keepdims=True) + np.uint64(len(tokens))
    return int(mix(total).view(np.int64)[0])


def choose(docs: DataFrame, similarity: float, runs: int) -> DataFrame:
    """row, doc_id, n, node (hash of the set), paths (of the first level), sketch."""

    def run(batches):
        own = seeds(3, runs)
        for batch in few_rows(batches):
            n, node, paths, bits = [], [], [], []
            for text in batch.column(2):
                tokens = shingles(text.as_py())
                cut = _cut(len(tokens), similarity)
                n.append(len(tokens))
                node.append(_node(tokens))
                bits.append(sketch(tokens).view(np.int64))
                hashed = mix(tokens[None, :] ^ own[:, None])
                paths.append(mix(hashed[hashed < cut] + ODD).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(node, pa.int64()),
                    pa.array(paths, pa.list_(pa.int64())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                ["row", "doc_id", "n", "node", "paths", "sketch"],
            )

    return docs.select("row", "doc_id", "text").mapInArrow(
        run, "row long, doc_id long, n long, node long, paths array<long>, sketch array<long>"
    )


def _small(df: DataFrame) -> DataFrame:
    """The frame, marked for broadcast if its numbers, those in arrays included, are few."""
    arrays = [F.sum(F.size(f.name)) for f in df.schema.fields if f.dataType.typeName() == "array"]
    rows, *items = df.agg(F.count("*"), *arrays).first()
    size = 8 * len(df.columns) * rows + 16 * sum(n or 0 for n in items)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def with_tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of `wanted` (row, node and others) with `tokens`, the set of that row of docs."""
    names = [c for c in wanted.columns if c != "row"]
    at = names.index("node")

    def run(batches):
        for batch in few_rows(batches):
            sets = [shingles(text.as_py()) for text in batch.column(len(names))]
            own = pa.array([_node(t) == node for t, node in zip(sets, batch.column(at).to_pylist())], pa.bool_())
            columns = [*batch.columns[:-1], pa.array([t.tobytes() for t in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "tokens"]).filter(own)

    from pyspark.sql.types import BinaryType, StructField, StructType

    joined = docs.join(_small(wanted), "row").select(*names, "text")
    fields = [*wanted.select(*names).schema.fields, StructField("tokens", BinaryType())]
    return joined.mapInArrow(run, StructType(fields))


def split(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """path, node, family one level deeper, for the members (path, node, family) of large buckets."""

    def run(batches):
        for batch in few_rows(batches):
            out: list[list[np.ndarray]] = [[], [], []]
            for node, paths, families, raw in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = np.frombuffer(raw, np.uint64)
                cut = _cut(len(tokens), similarity)
                for path, family in zip(np.array(paths, np.int64).view(np.uint64), families):
                    hashed = mix(mix(tokens + path) ^ path)
                    chosen = mix(hashed[hashed < cut] + path)
                    out[0].append(chosen.view(np.int64))
                    out[1].append(np.full(len(chosen), node, np.int64))
                    out[2].append(np.full(len(chosen), family, np.int64))
            if out[0]:
                columns = [pa.array(np.concatenate(c)) for c in out]
                yield pa.RecordBatch.from_arrays(columns, ["path", "node", "family"])

    own = F.sort_array(F.collect_set(F.struct("path", "family")))
    per_node = members.groupBy("node").agg(own.alias("own"))
    joined = per_node.join(sets, "node").select("node", "own.path", "own.family", "tokens")
    return joined.mapInArrow(run, "path long, node long, family long")


def groups(batches, n_keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first columns, from batches sorted by them."""
    release()
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy() for i in range(n_keys)]
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            key = tuple(k[a] for k in keys)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
    release()


def _forest(size: int, like, one: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest; `like(i, others)` tells which others are similar to i.

    Those marked in `one` are in one tree from the start.
    """
    queue, rest = [], np.arange(size)
    if one is not None:
        queue, rest = np.flatnonzero(one).tolist(), np.flatnonzero(~one)
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = like(i, rest)
            for j in rest[near]:
                yield i, j
            queue.extend(rest[near])
            rest = rest[~near]


def _like_in(n: np.ndarray, bits: np.ndarray, similarity: float):
    """A function that tells which of the sets `others` look similar to set i."""

    def like(i, others):
        low, high = np.minimum(n[i], n[others]), np.maximum(n[i], n[others])
        differ = np.bitwise_count(bits[others] ^ bits[i]).sum(1)
        return (low >= similarity * high) & (differ <= SKETCH - AGREE)

    return like


def _sketched(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The members with n and the four numbers of their sketch."""
    narrow = nodes.select("node", "n", *[F.col("sketch")[i].alias(f"s{i}") for i in range(4)])
    return members.join(narrow, "node")


def _bits(group: pa.Table) -> np.ndarray:
    return np.stack([group.column(f"s{i}").to_numpy() for i in range(4)], 1).view(np.uint64)


def lead(large: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The members (path, node, family, size, part) of large buckets, with their families found.

    A few members of each bucket, by a hash that is the same in all buckets, lead it. One that is of no family yet (its own node)
    and looks similar to a leader joins the leader's; `leader` then names the leader, for an edge.
    Every part of a bucket meets copies of its leaders, so that no task holds a whole bucket.
    """
    parts = F.ceil(F.col("size") / F.lit(LIMIT)).cast("int")
    rows = large.withColumn("part", F.pmod(F.xxhash64("node", F.lit(5)), parts).cast("long"))
    place = F.row_number().over(Window.partitionBy("path").orderBy(F.xxhash64("node"), "node"))
    first = large.withColumn("place", place).filter(F.col("place") <= LEADERS)
    first = first.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))))
    columns = ["path", "part", "place", "node", "family", "size"]
    both = first.select(*columns).unionByName(rows.withColumn("place", F.lit(LEADERS + 1)).select(*columns))

    def run(batches):
        for group in groups(batches, 2):
            place, node, family = (group.column(c).to_numpy() for c in ("place", "node", "family"))
            led = int((place <= LEADERS).sum())
            like = _like_in(group.column("n").to_numpy(), _bits(group), similarity)
            family, leader = family.copy(), np.full(len(node), -1)
            for i in range(led):
                free = i + 1 + np.flatnonzero(family[i + 1 :] == node[i + 1 :])
                free = free[node[free] != node[i]]
                joining = free[like(i, free)] if len(free) else free
                family[joining] = family[i]
                leader[joining] = i
            own = np.arange(led, len(node))
            # A leader among the members takes what was found for its copy.
            copy = {int(node[i]): i for i in range(led)}
            for j in own[np.isin(node[own], node[:led])].tolist():
                family[j], leader[j] = family[copy[int(node[j])]], leader[copy[int(node[j])]]
            out = group.slice(led).select(["path", "node", "size", "part"])
            out = out.append_column("family", pa.array(family[own]))
            named = pa.array(node[leader[own]], pa.int64(), mask=leader[own] < 0)
            yield from out.append_column("leader", named).combine_chunks().to_batches()

    return (
        _sketched(both, nodes)
        .select(*columns, "n", "s0", "s1", "s2", "s3")
        .repartition("path", "part")
        .sortWithinPartitions("path", "part", "place", "node")
        .mapInArrow(run, "path long, node long, size long, part long, family long, leader long")
    )


def brute_force(members: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """a, b: a spanning forest of the sets that look similar, for each bucket (path, part).

    Members marked `known` are of one family, whose own edges are known.
    """

    def run(batches):
        a, b = [], []
        for group in groups(batches, 2):
            node = group.column(2).to_numpy()
            like = _like_in(group.column("n").to_numpy(), _bits(group), similarity)
            known = group.column("known").to_numpy() > 0
            for i, j in _forest(len(node), like, known):
                a.append(node[i])
                b.append(node[j])
            if len(a) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = _sketched(members, nodes).select("path", "part", "node", "n", "s0", "s1", "s2", "s3", "known")
    return (
        rows.repartition("path", "part")
        .sortWithinPartitions("path", "part", "node")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def _pair_parts(members: DataFrame, parts: Column) -> DataFrame:
    """Deal large groups into `parts`, and send each row to every pair of parts that has its own.

    Adds `part`, the number of the pair, and `own`, whether a pair is of one part with itself
    (0) or which of its two parts the row is in (1, 2).
    """
    n = parts.cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(5)), n).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.struct(
            (F.least(F.col("mine"), j) * F.col("parts") + F.greatest(F.col("mine"), j)).cast("long").alias("part"),
            F.when(F.col("mine") == j, 0).when(F.col("mine") < j, 1).otherwise(2).alias("own"),
        ),
    )
    return (
        members.withColumn("parts", n)
        .withColumn("mine", mine)
        .withColumn("p", F.explode(pairs))
        .select("*", "p.part", "p.own")
        .drop("p", "mine", "parts")
    )


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of each component of `edges` (a, b)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.distinct(), "edges")
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = materialise(labels.withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        stepped = lower.join(up, "label", "left").select(
            "node", "was", F.least("label", "up").alias("label")
        )
        stepped = materialise(stepped, "labels")
        labels = stepped.select("node", "label")
        if stepped.filter("label <> was").isEmpty():
            return labels


def exact_links(docs: DataFrame, clusters: DataFrame, similarity: float) -> DataFrame:
    """node, links, other: weights of linked nodes, and edges of a spanning forest of links.

    `clusters` has row (one document of the node), node, n, label, size and tokens (sets in the
    cluster, and their tokens) and w (documents of the node).
    """
    ratio = Fraction(str(similarity))
    up, down = ratio.numerator, ratio.numerator + ratio.denominator

    def common(raw: list[bytes], n: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """left x right: tokens that two sets share."""
        tokens = np.frombuffer(b"".join(raw), np.uint64)
        row = np.repeat(np.arange(len(raw)), n)
        order = np.argsort(tokens, kind="stable")
        tokens, row = tokens[order], row[order]
        new = np.concatenate([[True], tokens[1:] != tokens[:-1]])
        col = np.cumsum(new) - 1
        more = np.bincount(col)[col] > 1  # tokens of one set alone share nothing
        row, col = row[more], col[more]
        col = np.cumsum(np.concatenate([[False], col[1:] != col[:-1]])) if len(col) else col
        out = np.zeros((len(left), len(right)), np.float32)
        width = 1024
        for first in range(0, int(col[-1]) + 1 if len(col) else 0, width):
            a, b = np.searchsorted(col, [first, first + width])
            seen = np.zeros((len(raw), width), np.float32)
            seen[row[a:b], col[a:b] - first] = 1
            others = seen[right].T
            for at in range(0, len(left), STRIPE):
                out[at : at + STRIPE] += seen[left[at : at + STRIPE]] @ others
        return out

    def linked_in(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two sides of a pair of parts (equal for one part with itself), and which sets are linked."""
        own, n = group.column(2).to_numpy(), group.column(4).to_numpy()
        left, right = np.flatnonzero(own < 2), np.flatnonzero(own != 1)
        shared = common(group.column(6).to_pylist(), n, left, right)
        linked = np.zeros(shared.shape, bool)
        for at in range(0, len(left), STRIPE):
            sizes = n[left[at : at + STRIPE], None] + n[None, right]
            linked[at : at + STRIPE] = shared[at : at + STRIPE].astype(np.int64) * down >= up * sizes
        if len(own) and own[0] == 0:
            np.fill_diagonal(linked, False)
        return left, right, linked

    def run(batches):
        out = []
        for group in groups(batches, 2):
            node, w = group.column(3).to_numpy(), group.column(5).to_numpy()
            left, right, linked = linked_in(group)
            links = np.zeros(len(node), np.int64)
            links[left] = linked @ w[right]
            if len(left) < len(node) or len(right) < len(node):
                links[right] = w[left] @ linked
            for i in np.flatnonzero(links):
                out.append((int(node[i]), int(links[i]), None))
            row_of, column_of = np.full(len(node), -1), np.full(len(node), -1)
            row_of[left], column_of[right] = np.arange(len(left)), np.arange(len(right))

            def like(i, others):
                if row_of[i] >= 0:
                    at = column_of[others]
                    return (at >= 0) & linked[row_of[i], at]
                at = row_of[others]
                return (at >= 0) & linked[at, column_of[i]]

            for i, j in _forest(len(node), like):
                out.append((int(node[i]), 0, int(node[j])))
            if len(out) > 50_000:
                yield _rows(out)
                out = []
        yield _rows(out)

    def _rows(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["node", "links", "other"]
        )

    parts = F.greatest(F.ceil(F.col("size") / F.lit(BLOCK)), F.ceil(F.col("tokens") / F.lit(BLOCK_TOKENS)))
    dealt = _pair_parts(clusters, F.least(parts, "size"))
    part = F.collect_list(F.struct("part", "own")).alias("parts")
    wanted = dealt.groupBy("row", "node", "n", "label", "w").agg(part)
    rows = with_tokens(docs, materialise(wanted, "wanted"))
    return (
        rows.withColumn("p", F.explode("parts"))
        .select("*", "p.*")
        .select("label", "part", "own", "node", "n", "w", "tokens")
        .repartition("label", "part")
        .sortWithinPartitions("label", "part", "node")
        .mapInArrow(run, "node long, links long, other long")
    )


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest doc_id of all that are linked), n_links (documents linked to it)."""
    return _classes(numbered(id_text(docs)), similarity, recall).select("doc_id", "class_id", "n_links")


def _classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """row, doc_id, class_id, first (the row that stands for the class), n_links, of row, doc_id, text.

    The first row is the one with the smallest doc_id, a null last, and of those the smallest row.
    """
    each = materialise(choose(docs, similarity, runs_for(recall)), "chosen")
    nodes = materialise(
        each.filter("n > 0")
        .groupBy("node")
        .agg(
            F.count("*").alias("w"),
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("low"),
            *[F.first(c).alias(c) for c in ("n", "paths", "sketch")],
        ),
        "nodes",
    )
    members = nodes.select(F.explode("paths").alias("path"), "node", F.col("node").alias("family"))
    buckets, edges, sets = [], [], None
    for level in range(LEVELS):
        # Dealt once: the counts read all columns, so that both sides of the join are the same shuffle.
        members = members.repartition("path")
        counts = members.groupBy("path").agg(
            F.count("node").alias("size"), F.min("family").alias("low"), F.max("family").alias("high")
        )
        # Alone, or among one family, a set has nothing to find.
        members = members.join(counts.filter("low < high").select("path", "size"), "path")
        members = materialise(members, "members")
        small = members.filter(F.col("size") <= LIMIT)
        buckets.append(small.select("path", F.lit(0).cast("long").alias("part"), "node", F.lit(0).alias("known")))
        large = members.filter(F.col("size") > LIMIT)
        if large.isEmpty():
            break
        led = materialise(lead(large, nodes, similarity), "led")
        edges.append(led.filter("leader IS NOT NULL").select(F.col("node").alias("a"), F.col("leader").alias("b")))
        families = led.groupBy("path", "family").agg(F.count("*").alias("n"), F.first("size").alias("size"))
        main = families.groupBy("path").agg(
            F.max_by("family", F.struct("n", "family")).alias("main"),
            (F.first("size") - F.max("n")).alias("others"),
        )
        led = materialise(led.drop("leader").join(main, "path"), "families")
        parts = F.ceil(F.col("size") / F.lit(LIMIT)).cast("int")
        everywhere = F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))
        meeting = F.when(F.col("family") == F.col("main"), F.array("part")).otherwise(everywhere)
        known = (F.col("family") == F.col("main")).cast("int").alias("known")
        settled = led.filter(F.col("others").between(1, LIMIT))
        buckets.append(settled.select("path", F.explode(meeting).alias("part"), "node", known))
        large = led.filter(F.col("others") > LIMIT)
        paired = large if level == LEVELS - 1 else large.filter(F.col("size") <= PAIRED * LIMIT)
        pairs = _pair_parts(paired.drop("part"), parts)
        buckets.append(pairs.select("path", "part", "node", F.lit(0).alias("known")))
        large = large.filter(F.col("size") > PAIRED * LIMIT)
        if level == LEVELS - 1 or large.isEmpty():
            break
        if sets is None:
            wanted = large.select("node").distinct().join(nodes, "node")
            wanted = materialise(wanted.select("low.row", "node"), "wanted")
            sets = materialise(with_tokens(docs, wanted), "sets")
        members = materialise(split(large, sets, similarity), "split")
    near = brute_force(reduce(DataFrame.unionByName, buckets), nodes, similarity)
    near = materialise(reduce(DataFrame.unionByName, [near, *edges]), "near")
    label = components(near)
    own = nodes.select("node", "w", "n", "low.row")
    clusters = label.join(own, "node")
    sizes = clusters.groupBy("label").agg(F.count("*").alias("size"), F.sum("n").alias("tokens"))
    clusters = clusters.join(sizes, "label")
    links = materialise(exact_links(docs, clusters, similarity), "links")
    classes = components(links.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    n_links = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "w", "low").join(classes, "node", "left").join(n_links, "node", "left")
    lows = known.filter("label IS NOT NULL").groupBy("label").agg(F.min("low").alias("class_low"))
    known = known.join(lows, "label", "left").withColumn("class_low", F.coalesce("class_low", "low")).select(
        "node",
        F.col("class_low.doc_id").alias("class_id"),
        F.col("class_low.row").alias("first"),
        (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    own = F.col("n") > 0
    return each.select("row", "doc_id", "node", "n").join(known, "node", "left").select(
        "row",
        "doc_id",
        F.when(own, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(own, F.col("first")).otherwise(F.col("row")).alias("first"),
        F.when(own, F.col("n_links")).otherwise(0).alias("n_links"),
    )


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


def one_per_class(docs: DataFrame) -> DataFrame:
    """The rows that stand for their class: exactly one of each, with all their columns."""
    rows = numbered(docs, "_row")
    classes = _classes(
        rows.select(
            F.col("_row").alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        )
    )
    lost = materialise(classes.filter("first <> row").select(F.col("row").alias("_row")), "lost")
    kept = rows.join(_small(lost), "_row", "left_anti")
    return kept.select(*docs.columns)


ORACLE_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS words
  FROM documents WHERE text IS NOT NULL
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[place:place + least(5, len(words)) - 1], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS place
        FROM cut WHERE len(words) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle AS a JOIN shingle AS b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM both_have JOIN size AS x ON x.doc_id = a JOIN size AS y ON y.doc_id = b
  WHERE 9 * both_have.n >= 4 * (x.n + y.n)
), reach AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT doc_id, coalesce(least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)), doc_id) AS class_id,
       (SELECT count(*) FROM link WHERE a = doc_id) AS n_links
FROM documents
"""

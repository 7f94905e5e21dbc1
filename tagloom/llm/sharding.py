"""Shards of equal row counts that keep linked documents together: balanced label propagation.

Documents with equal texts are linked. Every document begins in the shard its id hashes to.
In each round a join of groups and shard loads tells each group the shard most of its members
are in that still has room for it, and as many groups move there as its quota allows. Groups
larger than half a shard are dealt into parts first, and the large ones move first. What has no links, or found no room, fills the places left, so counts differ by one at most.

Rules for odd input: a null text has size 1 and CRC 0 and is linked to other nulls only;
repeated rows are rows of their own and linked; fewer rows than shards leave shards empty; an
empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.common import id_text, table
from tagloom.session import materialise

SHARDS = 16
ROUNDS = 8
#: Rows that are numbered in one sorted run.
RUN_ROWS = 20_000


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("binary")
    return id_text(docs).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(text)), F.lit(b"")).alias("group"),
        F.xxhash64("doc_id").alias("h"),
    )


def _part(hash_: Column, n: Column | int) -> Column:
    return F.pmod(F.shiftright(hash_, 8), n if isinstance(n, Column) else F.lit(n))


def number(df: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Add `slot`: gapless from 0 within `key`, from counts of bounded runs of rows."""
    runs = n_rows // RUN_ROWS + 1
    df = df.withColumn("run", _part(F.xxhash64("h"), runs))
    counts = df.groupBy(key, "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(key, "run").orderBy("h", "doc_id", "text_crc32", "size")
    numbered = df.withColumn("place", F.row_number().over(inside) - 1)
    return (
        numbered.join(offsets, [key, "run"])
        .withColumn("slot", (F.col("offset") + F.col("place")).cast("long"))
        .drop("run", "offset", "place")
    )


def _by_shard(df: DataFrame, key: str, value: Column, shards: int) -> list[int]:
    """A sum per shard; `shards` numbers for the driver."""
    found = dict(df.groupBy(key).agg(value.alias("v")).collect())
    return [int(found.get(s) or 0) for s in range(shards)]


def _pick(values: list, shard: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col(shard))


def propagate(rows: DataFrame, shards: int, n_rows: int, rounds: int = ROUNDS) -> DataFrame:
    """group, part, shard: where the linked documents of each part of a group have gathered.

    `rows` has the columns group and h. Parts that found no room are left out.
    """
    capacity = n_rows // shards
    sizes = rows.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    parts = sizes.select(
        "group", F.ceil(F.col("n") * 2 / F.lit(max(capacity, 4))).cast("int").alias("parts")
    )
    linked = rows.join(parts, "group")
    labels = linked.select(
        "group",
        _part(F.col("h"), F.col("parts")).cast("int").alias("part"),
        _part(F.xxhash64("h"), shards).cast("int").alias("shard"),
    )
    tally = labels.groupBy("group", "part", "shard").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("group", "part"))
    waiting = materialise(tally.withColumn("total", total), "waiting")
    settled: list[DataFrame] = []
    loads = [0] * shards
    for round_ in range(rounds):
        room = [max(0, capacity - load) for load in loads]
        most = F.max_by(
            "shard", F.struct("n", F.xxhash64("group", "part", "shard", F.lit(round_)))
        )
        wishes = materialise(
            waiting.filter(_pick(room, "shard") >= F.col("total"))
            .filter(F.col("total") * (32 if round_ == 0 else capacity + 1) > capacity)
            .groupBy("group", "part")
            .agg(most.alias("shard"), F.first("total").alias("total")),
            "wishes",
        )
        demand = _by_shard(wishes, "shard", F.sum("total"), shards)
        if not any(demand):
            if round_:
                break
            continue
        share = [min(1.0, r / d) if d else 0.0 for r, d in zip(room, demand)]
        draw = F.pmod(F.xxhash64("group", "part", F.lit(-round_ - 1)), F.lit(1 << 20)) / float(1 << 20)
        moved = materialise(wishes.filter(draw < _pick(share, "shard")), "moved")
        gained = _by_shard(moved, "shard", F.sum("total"), shards)
        loads = [a + b for a, b in zip(loads, gained)]
        settled.append(moved.select("group", "part", "shard"))
        waiting = materialise(waiting.join(moved, ["group", "part"], "left_anti"), "waiting")
    if not settled:
        return tally.select("group", "part", "shard").limit(0).join(parts, "group")
    return reduce(DataFrame.unionByName, settled).join(parts, "group")


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot; counts of shards differ by one at most."""
    rows = materialise(_rows(docs), "rows")
    n_rows = rows.count()
    quota = [n_rows // shards + (s < n_rows % shards) for s in range(shards)]
    settled = propagate(rows.select("group", "h"), shards, n_rows, rounds)
    parts = settled.select("group", "parts").distinct()
    part = _part(F.col("h"), F.col("parts")).cast("int")
    placed = (
        rows.join(parts, "group", "left")
        .withColumn("part", F.coalesce(part, F.lit(-1)))
        .join(settled.drop("parts"), ["group", "part"], "left")
        .select("doc_id", "size", "text_crc32", "h", "shard")
    )
    placed = materialise(placed, "placed")
    gathered = number(placed.filter("shard IS NOT NULL"), "shard", n_rows)
    gathered = materialise(gathered, "gathered")
    fits = F.col("slot") < _pick(quota, "shard")
    stay = gathered.filter(fits)
    rest = placed.filter("shard IS NULL").drop("shard").unionByName(
        gathered.filter(~fits).drop("shard", "slot")
    )
    held = _by_shard(stay, "shard", F.count("*"), shards)
    bounds, upto = [], 0
    for s in range(shards):
        bounds.append((s, upto, held[s]))
        upto += quota[s] - held[s]
    places = F.array(
        *[F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip(("shard", "first", "held"), b)]) for b in bounds]
    )
    filled = (
        number(rest.withColumn("all", F.lit(0)), "all", n_rows)
        .withColumn("to", F.element_at(F.filter(places, lambda p: p["first"] <= F.col("slot")), -1))
        .select(
            "doc_id", "size", "text_crc32",
            F.col("to.shard").cast("int").alias("shard"),
            (F.col("slot") - F.col("to.first") + F.col("to.held")).alias("slot"),
        )
    )
    return stay.select(*filled.columns).unionByName(filled)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

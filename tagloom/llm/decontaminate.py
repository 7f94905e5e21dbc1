"""Benchmark decontamination with suffix arrays of the training texts.

Texts are dealt to shards of some megabytes. A shard numbers its words by the benchmark's
vocabulary (0: not in it) and sorts the suffixes that begin like a benchmark window does; no
other suffix can match one. Every test suffix is then searched by bisection: those that begin
a window mark the words they cover, and `longest_matches` tells how far each one goes and where.

The benchmark is a query set: it is read in blocks of bounded size, each of which passes over
all documents. Documents are never shuffled while there is one block.

Rules for odd input: null and empty texts have no words and no hits; items without words have
no windows; an item of fewer than `window` words is one window; repeated items and documents
each count; columns other than doc_id, text, item_id are ignored; texts of any length are read
whole; an empty benchmark hits nothing.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import few_rows, id_text, numbered, table
from tagloom.session import materialise

WINDOW = 10
#: UTF-8 bytes of benchmark text in a block, and words in a shard of a task.
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 600_000
#: Bytes of one text that are cut into words at a time.
SLICE = 4 << 20
#: Words that suffixes are sorted by.
SORTED_WORDS = 64
#: First words by which suffixes that cannot match are left out.
FIRST_WORDS = 3

#: Fixed by the contract: a word byte is a digit, a letter, or part of a code point past ASCII.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
SPAN = "array<struct<start: long, end: long>>"


def word_slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, in slices."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LETTERS)
    at = 0
    while at < len(data):
        end = at + SLICE
        if end < len(data):
            space = data.find(b" ", end)
            end = len(data) if space < 0 else space
        yield data[at:end].split()
        at = end


def _prefix_hash(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words that begin at each position."""
    padded = np.concatenate([ids, np.zeros(k, ids.dtype)]).astype(np.uint64)
    out = np.zeros(len(ids), np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + padded[j : j + len(ids)]
    return (out * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)


@dataclass
class Block:
    """Some benchmark items, ready to be searched for."""

    vocab: dict[bytes, int]
    items: list[tuple[str, bytes]]  # id, words as big-endian numbers
    windows: list[bytes]  # distinct ones
    owners: list[set[str]]  # of each window
    firsts: dict[int, np.ndarray]  # by prefix length: which hashes begin a window

    def ids(self, text: str | None) -> np.ndarray:
        found = array("I")
        for words in word_slices(text):
            found.extend(map(self.vocab.get, words, repeat(0)))
        return np.frombuffer(found, np.uint32) if found else np.zeros(0, np.uint32)


def read_block(rows: list[tuple[str, str | None]], window: int) -> Block:
    vocab: dict[bytes, int] = {}
    items, windows = [], {}
    for item, text in rows:
        ids = [vocab.setdefault(w, len(vocab) + 1) for s in word_slices(text) for w in s]
        if not ids:
            continue
        words = np.array(ids, ">u4").tobytes()
        items.append((item, words))
        size = min(window, len(ids))
        for at in range(len(ids) - size + 1):
            windows.setdefault(words[4 * at : 4 * (at + size)], set()).add(item)
    firsts = {}
    for k in range(1, FIRST_WORDS + 1):
        own = [w[: 4 * k] for w in windows if min(FIRST_WORDS, len(w) // 4) == k]
        if own:
            bits = max(16, (16 * len(own)).bit_length())
            heads = np.frombuffer(b"".join(own), ">u4").astype(np.uint32)
            hit = np.zeros(1 << bits, bool)
            hit[_prefix_hash(heads, k)[::k] & np.uint64(len(hit) - 1)] = True
            firsts[k] = hit
    return Block(vocab, items, list(windows), list(windows.values()), firsts)


class Shard:
    """The sorted suffixes of some texts that begin like a window."""

    def __init__(self, block: Block, texts: list[np.ndarray]):
        gap = np.zeros(1, np.uint32)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]]) if texts else self.sizes
        ids = np.concatenate([x for t in texts for x in (t, gap)]) if texts else gap
        begins = np.zeros(len(ids), bool)
        for k, hit in block.firsts.items():
            begins |= hit[_prefix_hash(ids, k) & np.uint64(len(hit) - 1)]
        begins &= ids != 0
        self.words = words = ids.astype(">u4").tobytes()
        self.length = len(ids)
        places = np.flatnonzero(begins).tolist()
        rows = sorted((words[4 * i : 4 * (i + SORTED_WORDS)], i) for i in places)
        self.keys = [key for key, _ in rows]
        self.places = np.array([i for _, i in rows], np.int64)

    def find(self, start: bytes) -> tuple[int, int]:
        """The range of suffixes that begin with these words, at most SORTED_WORDS of them."""
        low = bisect_left(self.keys, start)
        if low == len(self.keys) or not self.keys[low].startswith(start):
            return low, low
        return low, bisect_right(self.keys, start + b"\xff" * 4, low)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def hits(self, block: Block) -> tuple[list[set[str]], list[list[dict]]]:
        """For each text: the items with windows in it, and the spans of words that they cover."""
        items: list[set[str]] = [set() for _ in self.sizes]
        cover = np.zeros(self.length + 1, np.int64)
        if len(self.keys):
            for window, owners in zip(block.windows, block.owners):
                low, high = self.find(window)
                if high > low:
                    at = self.places[low:high]
                    cover[at] += 1
                    cover[at + len(window) // 4] -= 1
                    for doc in np.unique(self.doc_of(at)).tolist():
                        items[doc] |= owners
        spans: list[list[dict]] = [[] for _ in self.sizes]
        covered = np.concatenate([[False], np.cumsum(cover) > 0, [False]])
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        begin, end = edges[::2], edges[1::2]
        for doc, a, b in zip(self.doc_of(begin).tolist(), begin.tolist(), end.tolist()):
            first = int(self.starts[doc])
            spans[doc].append({"start": a - first, "end": b - first})
        return items, spans

    def longest(self, block: Block, least: int) -> Iterator[tuple[str, int, int, int, int]]:
        """item, position in it, words matched, text and position there, of every test suffix."""
        if not self.keys:
            return
        for item, words in block.items:
            for at in range(0, len(words), 4):
                suffix = words[at:]
                key = suffix[: 4 * SORTED_WORDS]
                spot = bisect_left(self.keys, key)
                best = (0, 0)
                low, high = self.find(key)
                if high > low and len(suffix) > len(key):
                    best = max((self._shared(p, suffix), -p) for p in self.places[low:high].tolist())
                else:
                    for near in (spot - 1, spot):
                        if 0 <= near < len(self.keys):
                            n = self._shared(int(self.places[near]), suffix)
                            first, _ = self.find(suffix[: 4 * n]) if n else (near, 0)
                            best = max(best, (n, -int(self.places[first])))
                n, place = best[0], -best[1]
                if n >= least:
                    doc = int(self.doc_of(np.array([place]))[0])
                    yield item, at // 4, n, doc, place - int(self.starts[doc])

    def _shared(self, place: int, suffix: bytes) -> int:
        there = self.words[4 * place : 4 * place + len(suffix)]
        size = min(len(there), len(suffix)) // 4
        a = np.frombuffer(there, ">u4", size)
        differ = np.flatnonzero(a != np.frombuffer(suffix, ">u4", size))
        return int(differ[0]) if len(differ) else size


def _shards(batches, block: Block) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Keys and word numbers of the texts of each shard; a batch ends a shard."""
    for batch in batches:
        keys, texts, size = [], [], 0
        for key, text in zip(batch.column(0), batch.column(1)):
            keys.append(key.as_py())
            texts.append(block.ids(text.as_py()))
            size += len(texts[-1])
            if size >= SHARD_WORDS:
                yield keys, texts
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts


def blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about `block_bytes`; items are dealt to them by hash."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.col("text").cast("string").alias("text"),
    ).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for i in range(n):
        own = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        rows = own.toArrow()
        yield read_block(
            sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())), window
        )


def _scan(docs: DataFrame, block: Block) -> DataFrame:
    """doc_id (any number that names the row), n_words, items and spans of one block."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for keys, texts in _shards(batches, sent.value):
            items, spans = Shard(sent.value, texts).hits(sent.value)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array(
                        spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                    ),
                ],
                ["doc_id", "n_words", "items", "spans"],
            )

    schema = f"doc_id long, n_words long, items array<string>, spans {SPAN}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_words, items (ids), spans (word ranges, disjoint and sorted), n_hit of each document."""
    texts = id_text(docs)
    parts = list(blocks(benchmark, window, block_bytes))
    if len(parts) == 1:
        merged = _scan(texts, parts[0])
    else:
        # Ids may be null or repeated, so blocks are brought together by numbers of the rows.
        rows = numbered(texts)
        named = rows.select(F.col("row").alias("doc_id"), "text")
        found = [_scan(named, block) for block in parts]
        words = found[0].select(F.col("doc_id").alias("row"), "n_words")
        hits = reduce(DataFrame.unionByName, [f.filter("size(spans) > 0") for f in found])
        hits = materialise(hits, "hits").groupBy(F.col("doc_id").alias("row")).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        )
        merged = rows.select("row", "doc_id").join(words, "row").join(hits, "row", "left").select(
            "doc_id", "n_words",
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("spans", F.array().cast(SPAN)).alias("spans"),
        )
    return merged.withColumn(
        "n_hit",
        F.expr(
            """aggregate(spans, struct(0L AS n, 0L AS upto),
                 (a, s) -> struct(a.n + greatest(0L, s.end - greatest(a.upto, s.start)) AS n,
                                  greatest(a.upto, s.end) AS upto)).n"""
        ),
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW) -> DataFrame:
    """The longest verbatim match of every test suffix, if of `least` words (a window or more).

    item_id, position (word in the item), n_words, doc_id, doc_position. Of equally long ones,
    the smallest doc_id and then position counts.
    """
    texts = id_text(docs)

    def scan(block: Block) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches):
            for keys, texts_ in _shards(batches, sent.value):
                rows = [
                    (item, at, n, keys[doc], place)
                    for item, at, n, doc, place in Shard(sent.value, texts_).longest(sent.value, least)
                ]
                names = ["item_id", "position", "n_words", "doc_id", "doc_position"]
                kinds = [pa.string(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names
                )

        schema = "item_id string, position long, n_words long, doc_id long, doc_position long"
        return texts.mapInArrow(run, schema)

    found = reduce(DataFrame.unionByName, [scan(block) for block in blocks(benchmark, WINDOW)])
    best = F.min(F.struct((-F.col("n_words")).alias("n"), "doc_id", "doc_position"))
    return (
        found.groupBy("item_id", "position")
        .agg(best.alias("b"))
        .select("item_id", "position", (-F.col("b.n")).alias("n_words"), "b.doc_id", "b.doc_position")
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows without a benchmark window, with all their columns; block after block, no shuffle."""
    where = docs.columns.index("text")
    for block in blocks(benchmark, window):
        docs = _drop(docs, where, block)
    return docs


def _drop(docs: DataFrame, where: int, block: Block) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for batch in few_rows(batches, 1024):
            keep = []
            numbered = pa.RecordBatch.from_arrays(
                [pa.array(range(batch.num_rows)), batch.column(where)], ["row", "text"]
            )
            for _, texts in _shards([numbered], sent.value):
                keep += [not x for x in Shard(sent.value, texts).hits(sent.value)[0]]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


ORACLE_SQL = r"""
WITH item AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL
), part AS (
  SELECT item_id, words, least(10, len(words)) AS size,
         unnest(range(1, len(words) - least(10, len(words)) + 2)) AS place
  FROM item WHERE len(words) > 0
), part_text AS (
  SELECT DISTINCT item_id, size, array_to_string(words[place:place + size - 1], ' ') AS gram FROM part
), doc AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), place AS (
  SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS place
  FROM doc, (SELECT DISTINCT size FROM part_text)
), hit AS (
  SELECT row_no, place, p.size, item_id
  FROM (SELECT row_no, place, size, array_to_string(words[place:place + size - 1], ' ') AS gram
        FROM place) AS p JOIN part_text USING (size, gram)
), covered AS (
  SELECT row_no, count(DISTINCT at_word) AS n_hit
  FROM (SELECT row_no, unnest(range(place, place + size)) AS at_word FROM hit) GROUP BY row_no
), named AS (
  SELECT row_no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT row_no, item_id FROM hit) GROUP BY row_no
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (row_no) LEFT JOIN named USING (row_no)
"""

"""Delimited files with quoted line breaks, read in splits.

A reader that meets a byte range in the middle of a file can't tell whether it begins inside a
quoted field, so Spark reads such a file in one task. Here every byte range is read as plain lines.
A first pass finds for each range where it would end, inside quotes or not, had it begun inside or
outside; composing these along each file tells where every range really begins. A second pass cuts
records at their true ends and gives out what lies within one range; the few records that cross a
range are put together from their pieces, which are all that is shuffled.

A quote opens a field only at its start, as in the common readers; doubled quotes stand for one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tagloom.session import materialise

WHOLE, HEAD, TAIL, MIDDLE = range(4)


@dataclass(frozen=True)
class Dialect:
    """How fields are separated, and where comments start: "line", "any" unquoted '#', or None."""

    sep: str
    comments: str | None = None

    @cached_property
    def _patterns(self) -> tuple[re.Pattern, re.Pattern, re.Pattern, re.Pattern]:
        stop = re.escape(self.sep) + ("#" if self.comments == "any" else "")
        inner = r'(?:[^"]++|"")*+'
        field = rf'(?:"{inner}"[^{stop}]*+|[^"{stop}][^{stop}]*+|)'
        return (
            re.compile(rf'{inner}"[^{stop}]*+'),
            re.compile(rf"(?:{field}{re.escape(self.sep)})*+"),
            re.compile(rf'"{inner}\Z'),
            re.compile(field),
        )

    def scan(self, line: str, inside: bool) -> tuple[bool, str]:
        """Whether the end of a line is inside quotes, and the line without its comment."""
        if self.comments == "line" and not inside and line.startswith("#"):
            return False, ""
        if '"' not in line and (inside or self.comments != "any" or "#" not in line):
            return inside, line
        closing, fields, unclosed, last = self._patterns
        at = 0
        if inside:
            closed = closing.match(line)
            if not closed:
                return True, line
            at = closed.end()
            if not line.startswith(self.sep, at):
                return False, line[:at]
            at += len(self.sep)
        at = fields.match(line, at).end()
        if unclosed.match(line, at):
            return True, line
        return False, line[: last.match(line, at).end()] if self.comments == "any" else line


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, start: the lines of all files, those of one byte range in order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Consecutive lines of one byte range (file, start)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [c.to_numpy() for c in batch.columns[1:3]]
        changes = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
        edges = [0, *(changes.nonzero()[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield (int(keys[0][a]), int(keys[1][a])), batch.slice(a, b - a)


def _ends(dialect: Dialect):
    """file, start, from_outside, from_inside: how each byte range would end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ends = None, [False, True]
        for key, part in _ranges(batches):
            if at != key:
                if at:
                    yield row(at, ends)
                at, ends = key, [False, True]
            # Lines without quotes leave everything as it is.
            quoted = part.column(0).filter(pc.match_substring(part.column(0), '"'))
            for line in quoted.to_pylist():
                ends = [dialect.scan(line, end)[0] for end in ends]
        if at:
            yield row(at, ends)

    def row(key, ends):
        return pa.RecordBatch.from_pylist(
            [{"file": key[0], "start": key[1], "from_outside": ends[0], "from_inside": ends[1]}],
            pa.schema([("file", pa.int64()), ("start", pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_())]),
        )

    return run


def beginnings(ends: DataFrame) -> DataFrame:
    """file, start, inside: whether each byte range begins inside quotes.

    A range either forces its end, or keeps, or flips what it began with; so what counts is the
    last range that forced it, and how often it was flipped since.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    forced = F.col("from_outside") == F.col("from_inside")
    flips = (~forced & F.col("from_outside")).cast("long")
    upto = Window.partitionBy("file").orderBy("start")
    counted = ends.withColumn("flipped", F.sum(flips).over(upto))
    counted = counted.withColumn(
        "set", F.when(forced, F.struct(F.col("from_outside").cast("long").alias("state"), "flipped"))
    )
    last = F.last("set", ignorenulls=True).over(before)
    flipped = F.coalesce(F.last("flipped").over(before), F.lit(0))
    return counted.select(
        "file", "start",
        ((F.coalesce(last["state"], F.lit(0)) + flipped - F.coalesce(last["flipped"], F.lit(0))) % 2 == 1).alias("inside"),
    )


PIECES = "kind int, file long, start long, first boolean, value string"


def _records(dialect: Dialect, wanted):
    """Records (WHOLE) and pieces of records that cross a byte range, of the kinds in `wanted`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, carried, held, number = None, False, False, [], 0
        out: list[tuple] = []

        def give(kind: int, key, text: str) -> None:
            if kind in wanted and (text or kind != WHOLE):
                out.append((kind, *key, key[1] == 0 and number == 1 and kind in (WHOLE, TAIL), text))

        def leave() -> None:
            if at and inside and held:
                give(MIDDLE if carried else TAIL, at, "\n".join(held))

        def batch() -> pa.RecordBatch:
            names = ["kind", "file", "start", "first", "value"]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for key, part in _ranges(batches):
            if key != at:
                leave()
                began = part.column(3)[0].as_py()
                if began is None:
                    raise ValueError("the files were split in another way than before; scan them again")
                at, inside, carried, held, number = key, began, began, [], 0
            for line in part.column(0).to_pylist():
                if not inside and dialect.comments == "line" and line.startswith("#"):
                    continue
                if not inside:
                    number += 1
                was = inside
                inside, kept = dialect.scan(line, inside)
                if not was and not inside:
                    give(WHOLE, at, kept.removesuffix("\r"))
                    continue
                held.append(kept)
                if not inside:
                    give(HEAD if carried else WHOLE, at, "\n".join(held).removesuffix("\r"))
                    carried, held = False, []
            if out:
                yield batch()
        leave()
        if out:
            yield batch()

    return run


def read_records(spark: SparkSession, path: str, sep: str, comments: str | None = None) -> DataFrame:
    """value: every record as written, without comments; first: whether it is the first of its file.

    Files are split as plain text is. They must not change, nor the session's split settings,
    before the result has been read.
    """
    dialect = Dialect(sep, comments)
    lines = _lines(spark, path)
    ends = lines.mapInArrow(_ends(dialect), "file long, start long, from_outside boolean, from_inside boolean")
    begins = materialise(beginnings(ends), "beginnings")
    # A row per input split, fewer than the file listing that the driver holds for the scan.
    marked = lines.join(F.broadcast(begins), ["file", "start"], "left").select("value", "file", "start", "inside")
    whole = marked.mapInArrow(_records(dialect, (WHOLE,)), PIECES).select("value", "first")
    if begins.filter("inside").isEmpty():
        return whole
    pieces = marked.mapInArrow(_records(dialect, (HEAD, TAIL, MIDDLE)), PIECES)
    order = Window.partitionBy("file").orderBy("start", "kind")
    numbered = materialise(pieces, "pieces")
    # Numbers are made without the texts, which may be long.
    record = F.sum((F.col("kind") == TAIL).cast("long")).over(order).alias("record")
    keys = numbered.select("file", "start", "kind", record)
    joined = numbered.join(keys, ["file", "start", "kind"]).groupBy("file", "record").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("start", "kind", "value"))), lambda p: p["value"]), "\n"
        ).alias("value"),
        F.max("first").alias("first"),
    )
    return whole.unionByName(joined.select("value", "first"))

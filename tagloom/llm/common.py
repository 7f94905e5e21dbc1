"""Input tables and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns that operators on texts read; others, whatever their names, are left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def numbered(docs: DataFrame, name: str = "row") -> DataFrame:
    """The rows with a number of their own, written once so that each keeps it."""
    return materialise(docs.withColumn(name, F.monotonically_increasing_id()), "rows", "zstd")


_kept: dict[str, Any] = {}


def kept(name: str, make: Callable[[], Any]) -> Any:
    """A table that a worker keeps for the later tasks of one operator."""
    if name not in _kept:
        release()
        _kept[name] = make()
    return _kept[name]


def release(but: str | None = None) -> None:
    """Free the tables of operators that ran in this worker before, and give unused memory back.

    Workers live on from stage to stage; what one stage leaves in them is missing in the next.
    """
    for name in [n for n in _kept if n != but]:
        del _kept[name]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def few_rows(
    batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 4 << 20, keep: str | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, and of about `size` bytes of text.

    So a task holds few whole texts as Python values. `keep` names the table that the operator
    uses; when its task begins and ends, what others have kept is freed.
    """
    release(keep)
    for batch in batches:
        weight = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                weight += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(weight)])
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(before, before[at] + size, "right"))
            end = min(max(end - 1, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    release(keep)


def by_document(
    docs: DataFrame, row: Callable[[], Callable[[str | None], tuple]], schema: str, keep: str = "doc_id",
    holds: str | None = None,
) -> DataFrame:
    """Call a function on the text of every row, batch by batch; `row()` builds it in the task.

    The result has the column `keep` and those of `schema`, in the order of the tuples. `holds`
    names the table that `row()` has `kept`.
    """
    out = docs.sparkSession.createDataFrame([], schema).schema
    key = docs.schema[keep]
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in out.fields]
        one = row()
        for batch in few_rows(batches, keep=holds):
            texts = batch.column(batch.schema.get_field_index("text"))
            found = [one(text.as_py()) for text in texts]
            columns = [
                pa.array([r[i] for r in found], kind) for i, kind in enumerate(types)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(keep)), *columns], [keep, *names]
            )

    from pyspark.sql.types import StructType

    return docs.select(keep, "text").mapInArrow(run, StructType([key, *out.fields]))

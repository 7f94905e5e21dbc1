"""Sinks: write once, append what is new, and leave out what is done."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tagloom.session import materialise

# What Spark replaces in the value of a partition folder's name, and what it calls a missing one.
UNSAFE = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at a path, or None when nothing was written there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder was committed as a whole."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(mark)


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write a table unless its output exists as a whole, then read it.

    A folder without the mark of a committed write, as a failed run leaves
    behind with some or none of its files, is written anew.
    """
    if not is_complete(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def not_done(df: DataFrame, done: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the done keys."""
    if done is None:
        return df
    return df.join(done.select(*key).distinct(), list(key), "left_anti")


def append_new(
    df: DataFrame, path: str, key: Sequence[str] = ("name",), partition_by: Sequence[str] = ()
) -> DataFrame:
    """Append the rows whose key the table does not hold yet, then read it."""
    existing = read_if_exists(df.sparkSession, path)
    fresh = not_done(df, existing, key).select(*df.columns)
    fresh.write.mode("append").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_ordered(df: DataFrame, path: str, order: Sequence[str]) -> DataFrame:
    """Append rows with an `ordinal` of their own, then read the table.

    Ordinals are dense: 0, 1, ... in the given order within an append, and each append goes on
    where the one before ended. Tasks count their rows and the counts before are added up, so no
    task sees all rows.
    """
    spark = df.sparkSession
    existing = read_if_exists(spark, path)
    offset = 0
    if existing is not None:
        last = F.max("ordinal") if "ordinal" in existing.columns else F.count("*") - 1
        found = existing.agg(last).first()[0]
        offset = 0 if found is None else found + 1
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    held = materialise(ranged.withColumns({"_part": F.spark_partition_id(), "_place": place}), "ordered")
    counts = held.groupBy("_part").agg(F.count("*").alias("n"))
    # A row per task.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ordinal = (F.lit(offset).cast("long") + F.col("_base") + F.col("_place")).alias("ordinal")
    rows = held.join(F.broadcast(base), "_part").select(*df.columns, ordinal)
    rows.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a table as CSV with a header, vectors in their text form `[a, b]`."""
    columns = [
        F.concat(F.lit("["), F.array_join(f.name, ", "), F.lit("]")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(columns).write.csv(
        path, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def page_file(name: str | None) -> str:
    """Where the pages of a document lie in their folder: `name`.txt, with unsafe characters replaced.

    What readers would take for hidden gets a folder of its own, as Spark names one for a value.
    """
    safe = UNSAFE.sub(lambda c: f"%{ord(c[0]):02X}", name or NO_NAME)
    return f"name={safe}/part-00000-pages.txt" if safe[0] in "_." else f"{safe}.txt"


def write_page_files(pages: DataFrame, folder: str, page_sep: str = "\f") -> None:
    """A text file for every document under a shared folder: its pages in order, each ended by `page_sep`.

    Spark's own partitioned writer makes a folder, commits and lists it for every document, which
    takes longer than the pages. Here a file is written under a hidden name and then renamed, so one
    that is there is whole, and a task that runs again replaces it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        hidden = f"{root}/.{TaskContext.get().taskAttemptId()}"
        at, out = None, None

        def close() -> None:
            if out:
                out.close()
                store.create_dir(at.rpartition("/")[0], recursive=True)
                store.move(hidden, at)

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{root}/{page_file(name)}"
                if path != at:
                    close()
                    at, out = path, store.open_output_stream(hidden)
                out.write(((text or "") + page_sep).encode())
        close()
        yield from ()

    dealt = pages.select(F.coalesce(F.nullif("name", F.lit("")), F.lit(NO_NAME)).alias("name"), "page_no", "text")
    ordered = dealt.repartition("name").sortWithinPartitions("name", "page_no")
    written = ordered.select("name", "text").mapInArrow(run, "name string")
    written.write.format("noop").mode("overwrite").save()

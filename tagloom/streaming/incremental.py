"""Incremental processing with restart, as a Structured Streaming file source."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tagloom.session import materialise
from tagloom.sources import writers


def run_available(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    step: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    max_files: int = 1000,
    once: Sequence[str] = (),
) -> None:
    """Process the files that arrived since the last run, then stop.

    Each micro-batch writes its own folder, replacing what a failed attempt
    left there, so a restart neither loses nor repeats rows.

    Rows that agree in the columns `once` are processed once, whenever they
    arrive: what a batch takes on is noted beside `out`, and earlier batches' notes
    leave a row out.
    """
    noted = f"{out.rstrip('/')}-taken"

    def write(batch: DataFrame, batch_id: int) -> None:
        if once:
            taken = writers.read_if_exists(spark, noted)
            fresh = batch.dropDuplicates(list(once))
            if taken is not None:
                earlier = taken.filter(F.col("batch") < batch_id).select(*once).distinct()
                same = reduce(Column.__and__, [fresh[c].eqNullSafe(earlier[c]) for c in once])
                fresh = fresh.join(earlier, same, "left_anti")
            # Written, so that what is noted is what is processed.
            batch = materialise(fresh, "arrived")
            batch.select(*once).write.mode("overwrite").parquet(f"{noted}/batch={batch_id}")
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
        .awaitTermination()
    )


def read_results(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")

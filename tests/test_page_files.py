"""Page files are made without a folder each, and read once."""

import os

from pyspark.sql import functions as F

from tagloom.plans import registry
from tagloom.session import new_folder
from tagloom.sources import readers, writers


def test_page_files_lie_in_one_folder_and_are_read_once(spark):
    path = new_folder(spark, "pages")
    rows = [("b", 1, "two"), ("b", 0, "one\nline"), ("a.1", 3, None), (None, 0, "no name"), ("x/y=z", 0, "é"), ("_h", 0, "hidden")]
    pages = spark.createDataFrame(rows, "name string, page_no long, text string")
    writers.write_page_files(pages, path)
    assert sorted(os.listdir(path.removeprefix("file:"))) == [
        "a.1.txt", "b.txt", "name=__HIVE_DEFAULT_PARTITION__", "name=_h", "x%2Fy%3Dz.txt",
    ]
    found = readers.scan_pages(spark, path, recursive=True)
    assert "FileScan text" not in found._jdf.queryExecution().executedPlan().toString()
    # As Spark's own partitioned writer would have them read.
    old = new_folder(spark, "pages")
    plain = pages.repartition("name").sortWithinPartitions("name", "page_no").select("name", F.col("text").alias("value"))
    plain.write.option("lineSep", "\f").partitionBy("name").text(old)
    key = lambda r: tuple(map(str, r))
    same = sorted((tuple(r) for r in readers.scan_pages(spark, old, recursive=True).collect()), key=key)
    assert sorted((tuple(r) for r in found.collect()), key=key) == same
    assert ("b", 0, "one\nline") in same and len(same) == len(rows)


def test_a_conversation_makes_a_file_and_no_folder(spark):
    path = registry._page_files(spark, "/root/testdata/sf0.001").removeprefix("file:")
    assert not any(os.path.isdir(f"{path}/{f}") for f in os.listdir(path))

"""Run queries and their SQL side by side and compare them row by row."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


def rows_of_spark(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(_plain(v) for v in row) for row in df.select(columns).collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    found = con.execute(f"select * from ({sql}) as oracle_result")
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in found.fetchall())
    return [names[i] for i in order], rows


def difference(df, con, sql: str) -> str | None:
    """None when both hold the same rows, else a short account."""
    spark_names, spark_rows = rows_of_spark(df)
    sql_names, sql_rows = rows_of_sql(con, sql)
    if spark_names != sql_names:
        return f"columns {spark_names} against {sql_names}"
    if spark_rows == sql_rows:
        return None
    only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
    return (
        f"{spark_rows.total()} rows against {sql_rows.total()}; only in Spark "
        f"{only_spark.total()}: {str(list(only_spark)[:2])[:600]}; only in SQL "
        f"{only_sql.total()}: {str(list(only_sql)[:2])[:600]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from tagloom.session import build_session

    spark = build_session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                                        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(query(spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

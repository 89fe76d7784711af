"""Run registered queries next to their SQL and compare all rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, date) and not isinstance(value, datetime):
        return value.isoformat()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(v) for v in r) for r in df.select(*names).collect())


def sql_rows(con, text):
    cursor = con.execute(text)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = cursor.fetchall()
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, text):
    """None if equal, else a short description."""
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, text)
    if names != wanted_names:
        return f"columns {sorted(set(names) ^ set(wanted_names))}"
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        return (
            f"rows {sum(got.values())} vs {sum(wanted.values())}; {sum(extra.values())} extra, "
            f"{sum(missing.values())} missing; columns {names}; extra {next(iter(sorted(map(repr, extra))), None)}; "
            f"missing {next(iter(sorted(map(repr, missing))), None)}"
        )
    if not got:
        return "no rows"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(folder), entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(sql)), "unknown:", sorted(set(sql) - set(queries)))
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            found = difference(df, con, sql[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{name:28s} {time.time() - start:6.1f}s  {'ok' if found is None else found[:1500]}", flush=True)

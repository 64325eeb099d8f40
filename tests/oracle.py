"""Run registered queries against their oracle SQL: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{directory}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6f}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, directory):
    """Returns (problem or None, row count)."""
    df = fn(spark, directory)
    got_cols, got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names, types = [d[0] for d in cur.description], [str(d[1]) for d in cur.description]
    want_cols, want = table(names, cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}", len(got)
    kinds = {n: k for n, k in zip(names, types)}
    spark_kinds = dict(df.dtypes)
    same = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int"}
    odd = {n: (spark_kinds[n], k) for n, k in kinds.items() if same.get(k, spark_kinds[n]) != spark_kinds[n]}
    odd |= {n: (spark_kinds[n], k) for n, k in kinds.items() if k in ("HUGEINT", "FLOAT") or "DECIMAL" in k}
    if odd:
        return f"types {odd}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {list(set(got) ^ set(want))[:4]}", len(got)
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(bad)} rows differ in {got_cols}, first {bad[:2]}", len(got)
    return None, len(got)


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    directory = f"/root/testdata/sf{sf}"
    con = connect(directory)
    bad = 0
    for n in names:
        start = time.time()
        try:
            if n in contract.oracle_sql():
                problem, rows = compare(spark, con, contract.queries()[n], contract.oracle_sql()[n], directory)
            else:
                problem, rows = None, len(contract.queries()[n](spark, directory).collect())
        except Exception as e:  # noqa: BLE001
            problem, rows = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {n} rows={rows} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()

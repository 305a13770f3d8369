"""Run registered queries beside their SQL and report differences.

usage: python tests/check_queries.py <sf_dir> [query ...]
"""

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def compare(spark_df, con, sql):
    """None when equal, else a short description of the difference."""
    names = sorted(spark_df.columns)
    got = [tuple(_plain(r[c]) for c in names) for r in spark_df.collect()]
    table = con.execute(sql)
    columns = [d[0] for d in table.description]
    if sorted(columns) != names:
        return f"columns {names} vs {sorted(columns)}"
    order = [columns.index(c) for c in names]
    want = [tuple(_plain(r[i]) for i in order) for r in table.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    got, want = _sorted(got), _sorted(want)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ ({names}), first: {bad[0]}"
    return None


def make_session(cpus=os.environ.get("CHECK_CPUS", "8")):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "/tmp/docsignal-check")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(query(spark, sf_dir), con, oracles[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                state = f"rows {len(query(spark, sf_dir).collect())}"
        except Exception as error:  # report and go on
            state = f"FAIL {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.1f}s  {state}", flush=True)

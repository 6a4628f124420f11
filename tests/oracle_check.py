"""Compare registered queries with their SQL: `python tests/oracle_check.py [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got, got_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows {len(got)}" if got else "EMPTY"
    rel = con.sql(sql)
    want, want_cols = rows_of(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"COLUMNS {got_cols} != {want_cols}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        return f"DIFFERENT {len(got)} vs {len(want)} rows\n  spark {only_got}\n  sql   {only_want}"
    if not got:
        return "EMPTY"
    return f"same {len(got)}"


def make_session():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as driver
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    queries, oracles = driver.queries(), driver.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, query, oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            result = "ERROR " + "".join(traceback.format_exception_only(error))[:900]
        if not result.startswith(("same", "rows")):
            bad += 1
        print(f"{time.time() - start:6.1f}s {name}: {result}", flush=True)
    print("not equal:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

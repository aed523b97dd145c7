"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def kinds(rows):
    """Python type per column; ints and floats count as different."""
    out = []
    for col in zip(*rows):
        seen = {type(v).__name__ for v in col if v is not None}
        out.append(",".join(sorted(seen)))
    return out


def compare(spark, con, queries, oracles, name, folder):
    """Empty text when equal, else what differs."""
    df = queries[name](spark, folder)
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles:
        return "" if got else "no rows"
    rel = con.sql(oracles[name])
    want_names, want = rows_of(rel.columns, rel.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    if kinds(got) != kinds(want):
        return f"types {list(zip(got_names, kinds(got), kinds(want)))}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return "" if got else "(equal, but empty)"


def main(argv):
    from pyspark.sql import SparkSession

    from millgauge.session import build_session
    import __spark_entry__ as entry

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    plain = os.environ.get("PLAIN_SESSION")  # a session with none of our settings
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate() if plain else
             build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}))
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv or any(n == a or n.startswith(a.rstrip("*")) and a.endswith("*") for a in argv)]
    failed = 0
    for name in names:
        t = time.time()
        try:
            diff = compare(spark, con, queries, oracles, name, folder)
        except Exception as exc:  # report and go on
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        took = time.time() - t
        mark = "ok" if not diff else "FAIL"
        failed += bool(diff)
        if diff or took > 4 or os.environ.get("VERBOSE"):
            print(f"{mark:4} {name:14} {took:5.1f}s {diff}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal; {len(set(queries) - set(oracles))} without SQL")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

"""Run registered queries and their SQL side by side.

    python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return repr(x)


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, con, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    got_cols, got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = _canonical([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} / {want_cols}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        return False, f"rows {len(got)} / {len(want)}\n  spark {only_got}\n  sql   {only_want}"
    return True, f"{len(got)} rows"


def main(argv: list[str] | None = None) -> int:
    from checks.cases import QUERIES
    from checks.oracles import ORACLES
    from meterqa.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args(argv)
    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(opts.sf)
    bad = 0
    for name in opts.names or QUERIES:
        begun = time.time()
        try:
            ok, note = compare(spark, con, QUERIES[name], ORACLES[name], opts.sf)
        except Exception as ex:  # report every query, then fail
            ok, note = False, f"{type(ex).__name__}: {str(ex)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - begun:.1f}s {note}", flush=True)
    print("unmatched keys:", sorted(set(QUERIES) ^ set(ORACLES)))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

"""Run queries next to their SQL and report differences: ``python -m bindings.check [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from agorastat.sources import storage

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark
labels conversations""".split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def compare(spark: SparkSession, name: str, folder: str) -> str:
    from bindings import ORACLES, QUERIES

    started = time.time()
    with storage.scratch(spark):
        df = QUERIES[name](spark, folder)
        rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    took = time.time() - started
    if name not in ORACLES:
        return f"ROWS {name}: {len(rows)} rows, {took:.1f}s {df.columns}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    started = time.time()
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    place = [names.index(c) for c in sorted(names)]
    expected = [tuple(r[i] for i in place) for r in result.fetchall()]
    sql_took = time.time() - started
    if sorted(names) != sorted(df.columns):
        return f"FAIL {name}: columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = dict(zip(names, [str(c[1]) for c in result.description]))
    odd = [f"{c}:{k}" for c, k in kinds.items() if k in ("HUGEINT",) or k.startswith("DECIMAL")]
    got, want = sorted(map(lambda r: tuple(map(_cell, r)), rows)), sorted(map(lambda r: tuple(map(_cell, r)), expected))
    status = "OK  " if got == want and not odd else "FAIL"
    note = ""
    if got != want:
        only_got, only_want = [g for g in got if g not in set(want)][:3], [w for w in want if w not in set(got)][:3]
        note = f"\n   {sorted(names)}\n   spark {only_got}\n   sql   {only_want}"
    if not rows:
        note += " EMPTY"
    return f"{status} {name}: {len(rows)} vs {len(expected)} rows, {took:.1f}s, sql {sql_took:.1f}s {odd or ''}{note}"


def main() -> None:
    from bindings import QUERIES

    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and arguments[0].startswith("/") else "/root/testdata/sf0.01"
    spark = session()
    chosen = [n for n in QUERIES if not arguments or any(n.startswith(a) for a in arguments)]
    for name in chosen:
        try:
            print(compare(spark, name, folder), flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

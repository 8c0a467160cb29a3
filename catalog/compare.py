"""Run queries against their oracle statements and report differences."""

from __future__ import annotations

import math
import time
from collections import Counter
from collections.abc import Iterable

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.10g}")
    try:
        return float(value)
    except (TypeError, ValueError):
        return str(value)


def _rows(columns: list[str], rows: Iterable) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    start = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    report = {"query": name, "rows": len(got), "seconds": round(seconds, 2), "ok": True}
    if sql is None:
        return {**report, "oracle": "none"}
    start = time.time()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    report["oracle_seconds"] = round(time.time() - start, 2)
    if sorted(columns) != sorted(df.columns):
        return {**report, "ok": False, "why": f"columns {sorted(df.columns)} / {sorted(columns)}"}
    mine, theirs = _rows(df.columns, got), _rows(columns, want)
    if mine != theirs:
        extra, lacking = list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
        why = f"{len(got)} / {len(want)} rows; only spark {extra}; only oracle {lacking}"
        return {**report, "ok": False, "why": why}
    return report

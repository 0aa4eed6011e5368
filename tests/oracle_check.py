"""Runs registered queries against their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if hasattr(value, "item"):
        return _plain(value.item())
    return value


def canonical(rows, columns) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[bool, str]:
    mine = canonical([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return False, f"rows {len(mine)} != {len(theirs)}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        return False, f"{len(different)} of {len(mine)} rows differ, e.g. {different[0]}"
    return True, f"{len(mine)} rows"


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from plumbline.session import build_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv and not any(a in name for a in argv):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                ok, note = compare(df, con, oracle[name])
            else:
                rows = df.collect()
                ok, note = len(rows) > 0, f"{len(rows)} rows (no SQL), e.g. {rows[0] if rows else None}"
        except Exception as e:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note[:1500]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

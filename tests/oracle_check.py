"""Compare every registered query with its oracle SQL: python tests/oracle_check.py [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, float):
        return (2, "nan") if math.isnan(v) else (2, f"{v:.9g}")
    if isinstance(v, int):
        return (1, str(v))
    return (3, str(v))


def table_rows(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(norm(r[i]) for i in idx) for r in rows)


def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    odd = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields if f.dataType.simpleString() not in ("bigint", "double", "string")]
    if odd:
        return False, f"types {odd}"
    cols, got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got) > 0, f"rows-only {len(got)}"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    wcols, want = table_rows(names, cur.fetchall())
    if cols != wcols:
        return False, f"columns {set(cols) ^ set(wcols)}"
    if len(got) != len(want):
        known, mine = set(want), set(got)
        extra, lost = [g for g in got if g not in known][:1], [w for w in want if w not in mine][:1]
        return False, f"rows spark={len(got)} sql={len(want)} extra {extra} lost {lost}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        diff = [(c, a[1], b[1], a[0], b[0]) for c, a, b in zip(cols, g, w) if a != b]
        return False, f"{len(bad)}/{len(got)} rows differ, e.g. {diff[:6]}"
    return True, f"{len(got)} rows" + ("" if got else "  EMPTY")


def main():
    import __spark_entry__ as entry
    from tillbook.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in queries.items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        t = time.time()
        try:
            ok, note = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - t:6.2f}s  {note}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()

"""Run a named Spark query and its DuckDB oracle; compare as multisets.

Values are normalised per type (dates/timestamps to ISO text, floats kept
exact, ints as Python ints) and rows sorted, so the check is independent of
row order and of pandas dtype quirks.  Also usable as a script:

    python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        res.update(rows=len(s_rows), oracle=None)
        return res
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    res.update(rows=len(a), oracle_rows=len(b), cols_match=sorted(s_cols) == sorted(o_cols),
               match=(sorted(s_cols) == sorted(o_cols) and a == b))
    if not res["match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, o_cols
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb, key=str)[:3]
        res["only_oracle"] = sorted(sb - sa, key=str)[:3]
    return res


def main(argv: list[str]) -> int:
    import tempfile
    from strata.session import get_session, use_scratch
    from __spark_entry__ import queries
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra_conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    use_scratch(spark, tempfile.mkdtemp(prefix="strata-oracle-"))
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{type(e).__name__}: {str(e)[:300]}"}
        ok = r.get("match", r.get("oracle") is None and "error" not in r)
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

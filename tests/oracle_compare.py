"""Run a registered Spark query and its DuckDB oracle on the same parquet
tables and compare column names, row counts and order-insensitive values.

CLI: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(tbl: pa.Table) -> list[tuple]:
    cols = sorted(tbl.column_names)
    rows = []
    py = {c: tbl.column(c).to_pylist() for c in cols}
    for i in range(tbl.num_rows):
        row = []
        for c in cols:
            v = py[c][i]
            if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
                v = v.replace(tzinfo=None)
            if isinstance(v, float) and v == 0.0:
                v = 0.0
            row.append((v is None, repr(v)))
        rows.append(tuple(row))
    rows.sort()
    return rows


def compare(spark, name: str, sf_dir: str, con=None, show: int = 5) -> dict:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_tbl = sdf.toArrow()
    t1 = time.time()
    d_tbl = con.sql(E.oracle_sql()[name]).to_arrow_table()
    t2 = time.time()
    res = {"name": name, "spark_rows": s_tbl.num_rows, "oracle_rows": d_tbl.num_rows,
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    sc, dc = sorted(s_tbl.column_names), sorted(d_tbl.column_names)
    res["columns_match"] = sc == dc
    if sc != dc:
        res["only_spark"] = sorted(set(sc) - set(dc))
        res["only_oracle"] = sorted(set(dc) - set(sc))
        res["match"] = False
        return res
    a, b = _norm(s_tbl), _norm(d_tbl)
    res["match"] = a == b
    if a != b:
        from collections import Counter
        ca, cb = Counter(a), Counter(b)
        diff_a, diff_b = list((ca - cb).elements()), list((cb - ca).elements())
        res["spark_only_rows"], res["oracle_only_rows"] = len(diff_a), len(diff_b)
        res["sample_spark"] = [dict(zip(sc, [x[1] for x in r])) for r in diff_a[:show]]
        res["sample_oracle"] = [dict(zip(sc, [x[1] for x in r])) for r in diff_b[:show]]
        if diff_a and diff_b:
            ra, rb = diff_a[0], diff_b[0]
            res["first_diff_cols"] = [c for c, x, y in zip(sc, ra, rb) if x != y]
    res["types"] = {c: (str(s_tbl.schema.field(c).type), str(d_tbl.schema.field(c).type)) for c in sc
                    if str(s_tbl.schema.field(c).type) != str(d_tbl.schema.field(c).type)}
    return res


if __name__ == "__main__":
    import json
    from loanlake.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(E.oracle_sql())
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "match": False, "error": repr(e)[:2000]}
        bad += not r.get("match")
        print(json.dumps(r, default=str))
    print(f"{len(names) - bad}/{len(names)} match")

"""Run every registered query in Spark and its oracle SQL in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: name, rows spark/duckdb, columns, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NA or v is pd.NaT:
            return None
    except ImportError:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if hasattr(v, "item"):
        v = v.item()
        return _norm(v)
    return v


def rows_of_pandas(df):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    result = {}
    for name in names or list(qs):
        t0 = time.time()
        rec = {}
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            import pandas as pd
            spd = pd.DataFrame(srows, columns=sdf.columns)
            rec["spark_rows"] = len(srows)
            if name in sqls:
                rel = con.sql(sqls[name])
                dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
                dpd = rel.df()
                rec["duck_rows"] = len(dpd)
                bad_types = [(c, t, dtypes.get(c)) for c, t in sdf.dtypes
                             if SPARK_TO_DUCK.get(t, t) != dtypes.get(c)]
                rec["types_match"] = not bad_types
                if bad_types:
                    rec["type_diff"] = bad_types
                sc, sr = rows_of_pandas(spd)
                dc, dr = rows_of_pandas(dpd)
                rec["cols_match"] = sc == dc
                rec["values_match"] = sc == dc and sr == dr
                if not rec["values_match"]:
                    rec["spark_cols"], rec["duck_cols"] = sc, dc
                    sset, dset = set(sr), set(dr)
                    diff_s = [r for r in sr if r not in dset][:3]
                    diff_d = [r for r in dr if r not in sset][:3]
                    rec["spark_only"], rec["duck_only"] = diff_s, diff_d
        except Exception as e:  # report and continue
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        rec["sec"] = round(time.time() - t0, 2)
        result[name] = rec
        print(name, rec, flush=True)
    return result


if __name__ == "__main__":
    from vireo.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "16g",
                                                "spark.driver.maxResultSize": "8g"})
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items()
           if "error" in r or r.get("values_match") is False or r.get("types_match") is False]
    print("MISMATCH/ERROR:", bad)

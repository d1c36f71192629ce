"""Run registered Spark queries and their DuckDB SQL side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v) if v != 0 else 0.0   # exact: a strict value hash sees every bit
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def kind(series) -> str:
    """Coarse type of a column: int, float, bool, str, time or empty."""
    vals = [v for v in series.tolist() if v is not None and not (isinstance(v, float) and math.isnan(v))]
    if not vals:
        return "empty"
    v = vals[0]
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int) or (hasattr(v, "dtype") and "int" in str(v.dtype)):
        return "int"
    if isinstance(v, float):
        return "float"
    if hasattr(v, "isoformat"):
        return "time"
    return type(v).__name__


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or sorted(qs):
        t0 = time.time()
        res = {"name": name}
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
            res["spark_rows"] = len(spdf)
            res["spark_sec"] = round(time.time() - t0, 2)
            if name in sqls:
                ddf = con.execute(sqls[name]).df()
                res["oracle_rows"] = len(ddf)
                res["cols_match"] = sorted(spdf.columns) == sorted(ddf.columns)
                if res["cols_match"]:
                    kinds = {c: (kind(spdf[c]), kind(ddf[c])) for c in spdf.columns}
                    bad = {c: k for c, k in kinds.items() if k[0] != k[1] and "empty" not in k}
                    if bad:
                        res["dtype_mismatch"] = bad
                    a, b = rows_of(spdf), rows_of(ddf)
                    res["values_match"] = a == b
                    if a != b:
                        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                        res["first_diffs"] = diff
                else:
                    res["spark_cols"] = sorted(spdf.columns)
                    res["oracle_cols"] = sorted(ddf.columns)
        except Exception as exc:  # report and go on
            res["error"] = f"{type(exc).__name__}: {str(exc)[:400]}"
        report[name] = res
        if verbose:
            print(res, flush=True)
    return report


if __name__ == "__main__":
    from contrail.session import create_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = create_session("oracle-compare", master="local[8]", shuffle_partitions=8)
    rep = compare(spark, sf, names)
    bad = [n for n, r in rep.items() if r.get("error") or r.get("values_match") is False or r.get("dtype_mismatch")
           or r.get("cols_match") is False or ("oracle_rows" in r and r["oracle_rows"] != r["spark_rows"])]
    print("FAILED:", bad)
    print("ok:", len(rep) - len(bad), "of", len(rep))

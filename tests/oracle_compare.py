"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
row count, column names and order-insensitive values (floats to 6 places)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)  # keeps the sign of zero: -0.0 and 0.0 print differently
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(ts, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return res
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if list(map(repr, a)) == list(map(repr, b)):   # text, as a value hash sees it
        res["status"] = "match"
    else:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["status"] = "MISMATCH"
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_oracle"] = sorted(sb - sa)[:3]
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from evenline.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], sq.get(n), sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

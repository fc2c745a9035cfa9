"""Runs registered queries against their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v) if v is not None else None


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    cols, got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    types = dict(zip(ocols, [str(d[1]) for d in cur.description]))
    ocols, exp = rows_of(ocols, cur.fetchall())
    if cols != ocols:
        return f"columns {cols} != {ocols}"
    for c, t in df.dtypes:
        if KIND.get(t, t) != types[c]:
            return f"type of {c}: {t} != {types[c]}"
    if len(got) != len(exp):
        return f"rows {len(got)} != {len(exp)}"
    bad = [(g, e) for g, e in zip(got, exp) if g != e]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, cols {cols}, first {bad[0]}"
    return None if got else "no rows on both sides"


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from marketmill.session import build_session

    sf_dir = argv[0]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        t = time.time()
        try:
            msg = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            msg = f"{type(e).__name__}: {str(e)[:900]}"
        if msg:
            failed.append(name)
        print(f"{'FAIL' if msg else 'ok  '} {time.time() - t:6.2f}s {name} {'' if name in sqls else '(rows only) '}{msg or ''}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1:])

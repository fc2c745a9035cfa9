"""Registry of named queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Named sub-queries the check SQL may refer to, in dependency order.
CTES: dict[str, str] = {}


def with_ctes(sql: str) -> str:
    """Prepend the named sub-queries a statement refers to, directly or not."""
    wanted: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name, body in CTES.items():
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                todo.append(body)
    parts = [f"{n} AS ({b})" for n, b in CTES.items() if n in wanted]
    body = sql.strip()
    recursive = False
    if body.upper().startswith("WITH RECURSIVE "):
        recursive, body = True, body[len("WITH RECURSIVE ") :]
    elif body.upper().startswith("WITH "):
        body = body[len("WITH ") :]
    else:
        return (f"WITH {', '.join(parts)} " if parts else "") + body
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join([*parts, body])


def _nudge(digits: int) -> float:
    """Moves values off exact rounding ties, which the two engines break differently."""
    return 3 * 10.0 ** -(digits + 3)


def query(name: str, sql: str | None = None, r6: str = "", r4: str = "", r2: str = ""):
    """Register a query; the named double columns are rounded on both sides."""
    digits = {c: d for cols, d in ((r6, 6), (r4, 4), (r2, 2)) for c in cols.split()}

    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            cols = {c: F.round(F.col(f"`{c}`") + F.lit(_nudge(d)), d) for c, d in digits.items()}
            return df.withColumns(cols) if cols else df

        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            full = with_ctes(sql)
            if digits:
                # + 0.0 turns a negative zero into zero
                repl = ", ".join(f'round("{c}" + {_nudge(d):.12f}, {d}) + 0.0 AS "{c}"' for c, d in digits.items())
                full = f"SELECT * REPLACE ({repl}) FROM ({full})"
            ORACLES[name] = full
        return fn

    return deco

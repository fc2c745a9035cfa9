"""E: technical indicators over daily and intraday bars."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from marketmill.operators import indicators as I
from marketmill.operators import prices as P
from marketmill.operators.longseries import recursive_indicators

from .prices import bars
from .registry import CTES, query
from .tables import ticks

N = 5

_daily = len(CTES)
CTES["numbered"] = "SELECT symbol, date, close AS x, row_number() OVER (PARTITION BY symbol ORDER BY date) AS r FROM bars"
CTES["ohlc"] = "SELECT symbol, date, open, high, low, close, volume FROM bars"


def smooth(src: str, n: int, alpha: str) -> str:
    """Closed form of the seeded recurrence; the result series is numbered from 1 again."""
    return f"""SELECT b.symbol, b.date, b.r - {n - 1} AS r,
       sum(CASE WHEN y.r <= {n} THEN y.x / {n} * pow(1 - {alpha}, b.r - {n})
                ELSE {alpha} * pow(1 - {alpha}, b.r - y.r) * y.x END) AS x
FROM {src} b JOIN {src} y ON b.symbol = y.symbol AND y.r <= b.r WHERE b.r >= {n} GROUP BY b.symbol, b.date, b.r"""


ALPHA = f"(2.0 / ({N} + 1))"
CTES["ema1"] = smooth("numbered", N, ALPHA)
CTES["ema2"] = smooth("ema1", N, ALPHA)
CTES["ema3"] = smooth("ema2", N, ALPHA)
CTES["delta"] = """
SELECT symbol, date, d, row_number() OVER (PARTITION BY symbol ORDER BY date) AS r
FROM (SELECT *, x - lag(x) OVER (PARTITION BY symbol ORDER BY date) AS d FROM numbered) WHERE d IS NOT NULL"""
CTES["gains"] = "SELECT symbol, date, r, greatest(d, 0) AS x FROM delta"
CTES["losses"] = "SELECT symbol, date, r, greatest(-d, 0) AS x FROM delta"
WILDER = f"(1.0 / {N})"
CTES["avg_gain"] = smooth("gains", N, WILDER)
CTES["avg_loss"] = smooth("losses", N, WILDER)
CTES["rsi_series"] = """
SELECT g.symbol, g.date, CASE WHEN l.x = 0 THEN 100 ELSE 100 - 100 / (1 + g.x / l.x) END AS x
FROM avg_gain g JOIN avg_loss l ON g.symbol = l.symbol AND g.date = l.date"""
CTES["moves"] = """
SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS r,
       greatest(high, pc) - least(low, pc) AS tr, CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS plus,
       CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS minus
FROM (SELECT *, lag(close) OVER w AS pc, high - lag(high) OVER w AS up, lag(low) OVER w - low AS dn
      FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)) WHERE pc IS NOT NULL"""
for _c in ("tr", "plus", "minus"):
    CTES[f"mv_{_c}"] = f"SELECT symbol, date, r, {_c} AS x FROM moves"
    CTES[f"sm_{_c}"] = smooth(f"mv_{_c}", N, WILDER)
CTES["dx_series"] = """
SELECT p.symbol, p.date, p.r, CASE WHEN p.x + m.x = 0 THEN 0 ELSE 100 * abs(p.x - m.x) / (p.x + m.x) END AS x
FROM sm_plus p JOIN sm_minus m ON p.symbol = m.symbol AND p.date = m.date"""
CTES["adx_series"] = smooth("dx_series", N, WILDER)

FULL = f"CASE WHEN count(*) OVER w = {N} THEN {{}} END"
VALUE_SQL = {
    "sma": f"SELECT b.*, {FULL.format('avg(close) OVER w')} AS sma FROM ohlc b WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS {N - 1} PRECEDING)",
    "wma": f"""SELECT b.*, (SELECT CASE WHEN count(*) = {N} THEN sum((y.r - n.r + {N}) * y.x) / {N * (N + 1) / 2} END
        FROM numbered y WHERE y.symbol = n.symbol AND y.r BETWEEN n.r - {N - 1} AND n.r) AS wma
        FROM ohlc b JOIN numbered n ON b.symbol = n.symbol AND b.date = n.date""",
    "standardDeviation": f"SELECT b.*, {FULL.format('stddev_pop(close) OVER w')} AS \"standardDeviation\" FROM ohlc b WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS {N - 1} PRECEDING)",
    "williams": f"""SELECT b.*, {FULL.format('(max(high) OVER w - close) / nullif(max(high) OVER w - min(low) OVER w, 0) * -100')} AS williams
        FROM ohlc b WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS {N - 1} PRECEDING)""",
    "ema": "SELECT b.*, e1.x AS ema FROM ohlc b LEFT JOIN ema1 e1 USING (symbol, date)",
    "dema": "SELECT b.*, 2 * e1.x - e2.x AS dema FROM ohlc b LEFT JOIN ema1 e1 USING (symbol, date) LEFT JOIN ema2 e2 USING (symbol, date)",
    "tema": """SELECT b.*, 3 * e1.x - 3 * e2.x + e3.x AS tema FROM ohlc b LEFT JOIN ema1 e1 USING (symbol, date)
        LEFT JOIN ema2 e2 USING (symbol, date) LEFT JOIN ema3 e3 USING (symbol, date)""",
    "rsi": "SELECT b.*, s.x AS rsi FROM ohlc b LEFT JOIN rsi_series s USING (symbol, date)",
    "adx": "SELECT b.*, s.x AS adx FROM ohlc b LEFT JOIN adx_series s USING (symbol, date)",
}
IDS = {"sma": "E1", "ema": "E2", "wma": "E3", "dema": "E4", "tema": "E5", "rsi": "E6", "standardDeviation": "E7",
       "williams": "E8", "adx": "E9"}


def ohlc(spark, sf):
    return bars(spark, sf).select("symbol", "date", "open", "high", "low", "close", "volume")


def _register(name: str) -> None:
    @query(f"{IDS[name]}_{name}", VALUE_SQL[name], r6=name)
    def run(spark, sf):
        return I.indicators(ohlc(spark, sf), [(name, name, N)])


for _name in IDS:
    _register(_name)


@query(
    "E1_sma_intraday",
    """WITH ib AS (SELECT symbol, time_bucket(INTERVAL '1 hour', ts) AS date, arg_min(price, (ts, id)) AS open,
  min(price) AS low, max(price) AS high, arg_max(price, (ts, id)) AS close, CAST(sum(size) AS BIGINT) AS volume
FROM ticks GROUP BY 1, 2)
SELECT *, CASE WHEN count(*) OVER w = 10 THEN avg(close) OVER w END AS sma FROM ib
WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS 9 PRECEDING)""",
    r6="sma",
)
def e1_intraday(spark, sf):
    return I.sma(P.bars_intraday(ticks(spark, sf), "1hour"), 10)


#: The same sub-queries over hourly bars, under names of their own.
_OWN = [*list(CTES)[_daily:], "bars"]


def _hourly(sql: str) -> str:
    return re.sub(rf"\b({'|'.join(_OWN)})\b", r"hourly_\1", sql)


CTES["hourly_bars"] = """SELECT symbol, time_bucket(INTERVAL '1 hour', ts) AS date, arg_min(price, (ts, id)) AS open,
  min(price) AS low, max(price) AS high, arg_max(price, (ts, id)) AS close, CAST(sum(size) AS BIGINT) AS volume FROM ticks GROUP BY 1, 2"""
for _c in _OWN[:-1]:
    CTES[f"hourly_{_c}"] = _hourly(CTES[_c])


def _register_hourly(name: str) -> None:
    @query(f"{IDS[name]}_{name}_intraday", _hourly(VALUE_SQL[name]), r6=name)
    def run(spark, sf):
        return I.intraday(ticks(spark, sf), "1hour", [(name, name, N)])


for _name in list(IDS)[1:]:
    _register_hourly(_name)


GRID = [("sma", 5), ("ema", 5), ("rsi", 5), ("williams", 5), ("adx", 5), ("standardDeviation", 5)]


@query(
    "E10_indicator_grid",
    " UNION ALL ".join(
        f"""SELECT symbol, date, '{n}' AS indicator, {p} AS "periodLength", "{n}" AS value FROM ({VALUE_SQL[n]}) WHERE "{n}" IS NOT NULL"""
        for n, p in GRID
    ),
    r6="value",
)
def e10(spark, sf):
    return I.indicator_grid(bars(spark, sf), GRID)


RECURSIVE = [(name, name, N) for name in ("ema", "dema", "tema", "rsi", "adx")]


@query(
    "E9_continued_states",
    """SELECT b.symbol, b.date, b.close, e.ema, d.dema, t.tema, r.rsi, a.adx FROM ohlc b """
    + " ".join(f"LEFT JOIN ({VALUE_SQL[name]}) {name[0]} ON b.symbol = {name[0]}.symbol AND b.date = {name[0]}.date" for name, _, _ in RECURSIVE)
    + " WHERE b.date >= DATE '2024-01-12'",
    r6="ema dema tema rsi adx",
)
def e9_continued(spark, sf):
    """Bars from a day on, continued from the states that the bars before left."""
    daily, day = bars(spark, sf).select("symbol", "date", "high", "low", "close"), F.lit("2024-01-12").cast("date")
    _, states = recursive_indicators(daily.filter(F.col("date") < day), RECURSIVE)
    later, _ = recursive_indicators(daily.filter(F.col("date") >= day), RECURSIVE, states)
    return later.select("symbol", "date", "close", *[c for c, _, _ in RECURSIVE])

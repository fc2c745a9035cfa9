"""M: sector and industry performance, P/E, movers."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import performance as M
from marketmill.operators import prices as P

from .prices import bars
from .registry import CTES, query
from .tables import securities, table

CTES["listed"] = """
SELECT s.*, 'EX' || CAST(p_size % 3 AS VARCHAR) AS exchange FROM securities s JOIN part ON s.symbol = p_partkey"""


def listed(spark, sf):
    ex = table(spark, sf, "part").select(
        F.col("p_partkey").alias("symbol"), F.concat(F.lit("EX"), (F.col("p_size") % 3).cast("string")).alias("exchange")
    )
    return securities(spark, sf).join(ex, "symbol")


CTES["year_earnings"] = """
SELECT l_suppkey AS symbol, CAST(make_date(year(l_shipdate), 12, 31) AS DATE) AS date,
       sum(l_extendedprice * (1 - l_discount)) - 900000 AS earnings
FROM lineitem GROUP BY 1, 2"""


def year_earnings(spark, sf):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("symbol"), F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31)).alias("date"))
        .agg((F.sum(revenue) - 900000).alias("earnings"))
    )


def _perf_sql(by: str, cond: str) -> str:
    return f"""SELECT date, {by}, exchange, avg("changePercent") AS "averageChange"
FROM bars_full JOIN listed USING (symbol) WHERE {cond} GROUP BY ALL"""


def _pe_sql(by: str, cond: str) -> str:
    return f"""SELECT date, {by}, exchange, sum(close * shares) / sum(earnings) AS pe FROM (
  SELECT b.symbol, b.date, b.close, (SELECT arg_max(earnings, e.date) FROM year_earnings e
         WHERE e.symbol = b.symbol AND e.date <= b.date) AS earnings FROM bars b)
JOIN listed USING (symbol) WHERE earnings > 0 AND {cond} GROUP BY ALL"""


DAY = "date = DATE '2024-01-15'"
RANGE = "date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"


def _register(by: str) -> None:
    @query(f"M1_{by}_performance_snapshot", _perf_sql(by, DAY), r6="averageChange")
    def snapshot(spark, sf):
        return M.group_performance(bars(spark, sf), listed(spark, sf), by, date="2024-01-15")

    @query(f"M2_{by}_performance_history", _perf_sql(by, RANGE), r6="averageChange")
    def history(spark, sf):
        return M.group_performance(bars(spark, sf), listed(spark, sf), by, lo="2024-01-05", hi="2024-01-25")

    @query(f"M3_{by}_pe_snapshot", _pe_sql(by, DAY), r6="pe")
    def pe(spark, sf):
        return M.group_pe(bars(spark, sf), listed(spark, sf), year_earnings(spark, sf), by, date="2024-01-15")

    @query(f"M3_{by}_pe_history", _pe_sql(by, RANGE), r6="pe")
    def pe_hist(spark, sf):
        return M.group_pe(
            bars(spark, sf), listed(spark, sf), year_earnings(spark, sf), by, lo="2024-01-05", hi="2024-01-25"
        )


for _by in ("sector", "industry"):
    _register(_by)

MOVER = 'SELECT symbol, price, change, "changePercentage" AS "changesPercentage", volume FROM quotes '
_KINDS = {
    "gainers": 'WHERE "changePercentage" > 0 ORDER BY "changePercentage" DESC, symbol LIMIT 50',
    "losers": 'WHERE "changePercentage" < 0 ORDER BY "changePercentage", symbol LIMIT 50',
    "actives": "ORDER BY volume DESC, symbol LIMIT 50",
}


def _movers(kind: str) -> None:
    suffix = "" if kind == "gainers" else f"_{kind}"

    @query(f"M4_movers{suffix}", MOVER + _KINDS[kind], r6="change changesPercentage")
    def run(spark, sf):
        return M.movers(P.quotes(bars(spark, sf)), kind)


for _kind in _KINDS:
    _movers(_kind)

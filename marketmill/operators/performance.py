"""Sector and industry performance, price-earnings ratios, market movers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.functions.scalars import ratio
from marketmill.functions.windows import asof_last


def _bounded(df: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    if lo is not None:
        df = df.filter(F.col("date") >= F.lit(lo).cast("date"))
    if hi is not None:
        df = df.filter(F.col("date") <= F.lit(hi).cast("date"))
    return df


def _classified(df: DataFrame, securities: DataFrame, by: str, exchange: str | None, group: str | None) -> DataFrame:
    s = securities
    if exchange is not None:
        s = s.filter(F.col("exchange") == exchange)
    if group is not None:
        s = s.filter(F.col(by) == group)
    return df.join(s.select("symbol", by, "exchange"), "symbol")


def group_performance(
    bars: DataFrame,
    securities: DataFrame,
    by: str = "sector",
    date: str | None = None,
    lo: str | None = None,
    hi: str | None = None,
    exchange: str | None = None,
    group: str | None = None,
) -> DataFrame:
    """Average change in percent per day, group and exchange.

    ``date`` gives the snapshot of one day, ``lo``/``hi`` the history.
    """
    if by not in ("sector", "industry"):
        raise ValueError("by must be sector or industry")
    b = _bounded(bars, date or lo, date or hi).select("symbol", "date", "changePercent")
    j = _classified(b, securities, by, exchange, group)
    return j.groupBy("date", by, "exchange").agg(F.avg("changePercent").alias("averageChange"))


def group_pe(
    bars: DataFrame,
    securities: DataFrame,
    earnings: DataFrame,
    by: str = "sector",
    date: str | None = None,
    lo: str | None = None,
    hi: str | None = None,
    exchange: str | None = None,
    group: str | None = None,
) -> DataFrame:
    """Total market value over total trailing earnings per day, group and exchange.

    ``earnings`` holds (symbol, date, earnings); the figure known on the day
    counts, and companies without positive earnings are left out.
    """
    b = _bounded(bars, date or lo, date or hi).select("symbol", "date", "close")
    e = earnings.select("symbol", F.col("date").alias("report_date"), "earnings")
    known = asof_last(b, e, ["symbol"], "date", "report_date", ["earnings"]).filter("earnings > 0")
    j = _classified(known, securities, by, exchange, group).join(securities.select("symbol", "shares"), "symbol")
    return j.groupBy("date", by, "exchange").agg(
        ratio(F.sum(F.col("close") * F.col("shares")), F.sum("earnings")).alias("pe")
    )


def movers(quotes: DataFrame, kind: str, k: int = 50) -> DataFrame:
    """Top ``k`` gainers, losers or most active symbols; ties go to the smaller symbol."""
    q = quotes.select("symbol", "price", "change", F.col("changePercentage").alias("changesPercentage"), "volume")
    if kind == "gainers":
        return q.filter("changesPercentage > 0").orderBy(F.desc("changesPercentage"), "symbol").limit(k)
    if kind == "losers":
        return q.filter("changesPercentage < 0").orderBy("changesPercentage", "symbol").limit(k)
    if kind == "actives":
        return q.orderBy(F.desc_nulls_last("volume"), "symbol").limit(k)
    raise ValueError(f"unknown kind {kind!r}")

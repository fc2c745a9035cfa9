"""Calendars: dividends, earnings, IPOs, splits, and their summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions.scalars import ratio
from marketmill.functions.windows import top_n_per_key
from marketmill.sources.datasets import read_range


def _select(
    df: DataFrame, symbol: str | None, lo: str | None, hi: str | None, limit: int | None, order: Sequence[Column]
) -> DataFrame:
    """Rows of a company or of a date range; the newest ``limit`` per company."""
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    df = read_range(df, "date", lo, hi, keep_undated=False)
    return df if limit is None else top_n_per_key(df, ["symbol"], order, limit)


def dividends(
    df: DataFrame,
    symbol: str | None = None,
    lo: str | None = None,
    hi: str | None = None,
    limit: int | None = None,
    order: Sequence[Column] = (),
    min_yield: float | None = None,
) -> DataFrame:
    """Dividends of a company or a range, optionally above a yield."""
    out = _select(df, symbol, lo, hi, limit, order)
    return out if min_yield is None else out.filter(F.col("yield") > min_yield)


def earnings(
    df: DataFrame,
    symbol: str | None = None,
    lo: str | None = None,
    hi: str | None = None,
    limit: int | None = None,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Earnings dates with the surprise; a null actual figure is one still to come."""
    out = _select(df, symbol, lo, hi, limit, order)
    surprise = F.col("epsActual") - F.col("epsEstimated")
    return out.withColumns({"surprise": surprise, "upcoming": F.col("epsActual").isNull()})


IPO_KINDS = ("calendar", "disclosure", "prospectus")


def ipos(df: DataFrame, kind: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """One kind of IPO record in a range; for prospectuses whether price times shares is the total."""
    if kind not in IPO_KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    out = read_range(df.filter(F.col("kind") == kind), "date", lo, hi, keep_undated=False)
    if kind != "prospectus":
        return out
    off = F.abs(F.col("pricePublicPerShare") * F.col("shares") - F.col("pricePublicTotal"))
    return out.withColumn("totalAgrees", off <= 0.01 * F.col("shares"))


def splits(
    df: DataFrame,
    symbol: str | None = None,
    lo: str | None = None,
    hi: str | None = None,
    limit: int | None = None,
    order: Sequence[Column] = (),
) -> DataFrame:
    out = _select(df, symbol, lo, hi, limit, order)
    return out.withColumn("ratio", ratio(F.col("numerator"), F.col("denominator")))


def combined(events: dict[str, DataFrame]) -> DataFrame:
    """Union of event tables as (kind, symbol, date)."""
    out = None
    for kind, df in events.items():
        part = df.select(F.lit(kind).alias("kind"), F.col("symbol").cast("string").alias("symbol"), "date")
        out = part if out is None else out.unionByName(part)
    return out


def calendar_summary(events: DataFrame, as_of: str) -> DataFrame:
    """Counts per kind and horizon (next 30 and 31 to 90 days), per kind and in total.

    Null in ``kind`` or ``horizon`` marks a total.
    """
    days = F.datediff(F.col("date"), F.lit(as_of).cast("date"))
    near = events.filter(days.between(0, 90)).withColumn("horizon", F.when(days <= 30, "30d").otherwise("90d"))
    sets = [[F.col("kind"), F.col("horizon")], [F.col("kind")], []]
    # counted at the finest level first, so that only those few rows are multiplied
    fine = near.groupBy("kind", "horizon").agg(F.count("*").alias("__n"))
    return fine.groupingSets(sets, "kind", "horizon").agg(F.sum("__n").alias("events"))

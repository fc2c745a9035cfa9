"""Company profiles, notes, employees, executives and compensation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.windows import top_n_per_key


def betas(bars: DataFrame) -> DataFrame:
    """Beta of daily returns against the equal-weighted market return of the day."""
    w = Window.partitionBy("symbol").orderBy("date")
    r = F.try_divide(F.col("close"), F.lag("close").over(w)) - 1
    returns = bars.select("symbol", "date", r.alias("r")).filter(F.col("r").isNotNull())
    market = returns.groupBy("date").agg(F.avg("r").alias("m"))
    j = returns.join(market, "date").groupBy("symbol").agg(
        F.covar_pop("r", "m").alias("c"), F.var_pop("m").alias("v")
    )
    return j.select("symbol", F.when(F.col("v") > 0, F.col("c") / F.col("v")).alias("beta"))


def profile(
    directory: DataFrame, quotes: DataFrame, betas: DataFrame, dividends: DataFrame, symbols: DataFrame | None = None
) -> DataFrame:
    """One wide row per company: directory fields, quote, beta, last dividend and 52-week range text."""
    d = directory if symbols is None else directory.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    daily = dividends.groupBy("symbol", "date").agg(F.max("dividend").alias("dividend"))
    last = daily.groupBy("symbol").agg(F.max_by("dividend", "date").alias("lastDividend"))
    j = d.join(quotes, "symbol", "left").join(betas, "symbol", "left").join(last, "symbol", "left")
    low, high = (F.format_string("%.2f", F.round(c, 2)) for c in ("yearLow", "yearHigh"))
    has_range = F.col("yearLow").isNotNull()
    return j.select(
        *directory.columns, "price", "marketCap", "beta", "lastDividend",
        F.when(has_range, F.concat_ws("-", low, high)).alias("range"), "change", "changePercentage", "volume",
        "priceAvg50", "priceAvg200",
    )


def notes(df: DataFrame, symbol: str | None = None) -> DataFrame:
    return df if symbol is None else df.filter(F.col("symbol") == symbol)


def employee_count(
    filings: DataFrame, order: Sequence[Column], symbol: str | None = None, limit: int | None = None
) -> DataFrame:
    """Employee counts by filing, the newest ``limit`` per symbol (1 for the current one)."""
    f = filings if symbol is None else filings.filter(F.col("symbol") == symbol)
    return f if limit is None else top_n_per_key(f, ["symbol"], order, limit)


def executives(df: DataFrame, symbol: str | None = None, active: bool | None = None) -> DataFrame:
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    return df if active is None else df.filter(F.col("active") == active)


def ceo(df: DataFrame) -> DataFrame:
    """First executive, in listing order, whose title contains CEO."""
    titled = df.filter(F.upper("title").contains("CEO"))
    return titled.groupBy("symbol").agg(F.min(F.struct("position", "name", "title")).alias("e")).select(
        "symbol", F.col("e.name").alias("name"), F.col("e.title").alias("title")
    )


#: The parts that add up to the total compensation.
COMPENSATION_PARTS = (
    "salary", "bonus", "stockAward", "optionAward", "incentivePlanCompensation", "allOtherCompensation",
)


def exec_compensation(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """Compensation with its total over the six parts; a missing part counts as zero."""
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    total = sum((F.coalesce(c, F.lit(0)) for c in COMPENSATION_PARTS), F.lit(0))
    return df.withColumn("total", total.cast("bigint"))


def comp_benchmark(df: DataFrame, year: int | None = None) -> DataFrame:
    """Average total compensation per industry and year."""
    if year is not None:
        df = df.filter(F.col("year") == year)
    return df.groupBy("industry", "year").agg(F.avg("total").alias("averageCompensation"))

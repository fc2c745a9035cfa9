"""Treasury curve, economic series, risk premium and trader positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.scalars import pct_change, ratio
from marketmill.sources.datasets import read_range

#: Tenors of the treasury curve.
TENORS = (
    "month1", "month2", "month3", "month6", "year1", "year2", "year3", "year5", "year7", "year10", "year20", "year30",
)


def treasury(
    rates: DataFrame, lo: str | None = None, hi: str | None = None, tenors: Sequence[str] = TENORS
) -> DataFrame:
    """Curve per date, one column per tenor, from (date, tenor, rate)."""
    r = read_range(rates, "date", lo, hi, keep_undated=False)
    return r.groupBy("date").pivot("tenor", list(tenors)).agg(F.first("rate"))


def curve_spreads(curve: DataFrame) -> DataFrame:
    """2-10 and 10-30 year spreads and the shape of the curve."""
    short, long = F.col("year10") - F.col("year2"), F.col("year30") - F.col("year10")
    shape = F.when(short > 0, "Normal").when(short < 0, "Inverted").when(short == 0, "Flat")
    return curve.withColumns({"spread2to10": short, "spread10to30": long, "shape": shape})


def curve_long(curve: DataFrame, tenors: Sequence[str] = TENORS) -> DataFrame:
    """Curve back in long form."""
    return curve.unpivot("date", list(tenors), "tenor", "rate").filter(F.col("rate").isNotNull())


def indicator(
    series: DataFrame, name: str | None = None, lo: str | None = None, hi: str | None = None
) -> DataFrame:
    s = series if name is None else series.filter(F.col("name") == name)
    return read_range(s, "date", lo, hi, keep_undated=False)


def indicator_trend(series: DataFrame) -> DataFrame:
    """First and last value of every series and the change in percent."""
    g = series.groupBy("name").agg(
        F.count("*").alias("records"), F.min_by("value", "date").alias("first"), F.max_by("value", "date").alias("last")
    )
    return g.withColumn("changePercent", ratio(F.col("last") - F.col("first"), F.col("first")) * 100)


def economic_calendar(releases: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Releases with the change against the previous figure, absolute and in percent."""
    r = read_range(releases, "date", lo, hi, keep_undated=False)
    return r.withColumns(
        {
            "change": F.col("actual") - F.col("previous"),
            "changePercentage": pct_change(F.col("actual"), F.col("previous")),
        }
    )


def risk_premium(df: DataFrame) -> DataFrame:
    return df.select("country", "continent", "countryRiskPremium", "totalEquityRiskPremium")


def risk_premium_by_continent(df: DataFrame) -> DataFrame:
    return df.groupBy("continent").agg(
        F.count("*").alias("countries"),
        F.avg("countryRiskPremium").alias("countryRiskPremium"),
        F.avg("totalEquityRiskPremium").alias("totalEquityRiskPremium"),
    )


#: Report columns per trader class and side.
POSITIONS = {
    "noncommPositionsLongAll": ("noncomm", "long"),
    "noncommPositionsShortAll": ("noncomm", "short"),
    "noncommPositionsSpreadAll": ("noncomm", "spread"),
    "commPositionsLongAll": ("comm", "long"),
    "commPositionsShortAll": ("comm", "short"),
    "nonreptPositionsLongAll": ("nonrept", "long"),
    "nonreptPositionsShortAll": ("nonrept", "short"),
}


def cot_report(
    positions: DataFrame, symbol: str | None = None, lo: str | None = None, hi: str | None = None
) -> DataFrame:
    """Weekly long, short and spread positions per trader class, from (symbol, date, class, side, contracts).

    Open interest counts longs and spreads. Totals, changes against the week
    before and percent of open interest follow from the sums; the week before is
    looked up before the date bounds are applied.
    """
    p = positions if symbol is None else positions.filter(F.col("symbol") == symbol)

    def part(cls: str, side: str) -> Column:
        hit = (F.col("class") == cls) & (F.col("side") == side)
        return F.coalesce(F.sum(F.when(hit, F.col("contracts"))), F.lit(0))

    r = p.groupBy("symbol", "date").agg(*[part(*k).alias(c) for c, k in POSITIONS.items()])
    c = F.col
    r = r.withColumns(
        {
            "totReptPositionsLongAll": c("noncommPositionsLongAll") + c("noncommPositionsSpreadAll") + c("commPositionsLongAll"),
            "totReptPositionsShortAll": c("noncommPositionsShortAll") + c("noncommPositionsSpreadAll") + c("commPositionsShortAll"),
        }
    )
    r = r.withColumn("openInterestAll", c("totReptPositionsLongAll") + c("nonreptPositionsLongAll"))
    w = Window.partitionBy("symbol").orderBy("date")
    measures = [x for x in r.columns if x not in ("symbol", "date")]
    r = r.withColumns({f"changeIn{x[0].upper()}{x[1:]}": c(x) - F.lag(x).over(w) for x in measures})
    r = r.withColumns({f"pctOfOi{x[0].upper()}{x[1:]}": ratio(c(x), c("openInterestAll")) * 100 for x in POSITIONS})
    return read_range(r, "date", lo, hi, keep_undated=False)


def cot_analysis(report: DataFrame) -> DataFrame:
    """Long and short share of the non-commercial traders, net position and sentiment, against the week before."""
    c = F.col
    long, short = c("noncommPositionsLongAll"), c("noncommPositionsShortAll")
    a = report.select(
        "symbol", "date", (ratio(long, long + short) * 100).alias("currentLongMarketSituation"),
        (ratio(short, long + short) * 100).alias("currentShortMarketSituation"), (long - short).alias("netPosition"),
    )
    situation = F.when(c("currentLongMarketSituation") > c("currentShortMarketSituation"), "Bullish").otherwise("Bearish")
    a = a.withColumn("marketSituation", F.when(c("currentLongMarketSituation").isNotNull(), situation))
    w = Window.partitionBy("symbol").orderBy("date")
    a = a.withColumns(
        {
            "previousLongMarketSituation": F.lag("currentLongMarketSituation").over(w),
            "previousShortMarketSituation": F.lag("currentShortMarketSituation").over(w),
            "previousMarketSituation": F.lag("marketSituation").over(w),
            "previousNetPosition": F.lag("netPosition").over(w),
        }
    )
    grows = c("netPosition") > c("previousNetPosition")
    falls = c("netPosition") < c("previousNetPosition")
    bull = c("marketSituation") == "Bullish"
    sentiment = (
        F.when(bull & grows, "Increasing Bullish").when(bull & falls, "Decreasing Bullish")
        .when(~bull & falls, "Increasing Bearish").when(~bull & grows, "Decreasing Bearish")
    )
    return a.withColumns(
        {
            "changeInNetPosition": pct_change(c("netPosition"), c("previousNetPosition")),
            "marketSentiment": sentiment,
            "reversalTrend": c("marketSituation") != c("previousMarketSituation"),
        }
    )

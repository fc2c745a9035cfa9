"""Institutional holdings: filings, holder analytics, positions, industries.

Raw holding lines are summed to one position per (cik, symbol, date) first.
The previous quarter is brought next to the current one by counting every
position twice, at its own date and at the filer's next filing date, and one
aggregation: no self join, and sold-out positions appear by themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.scalars import pct_change, ratio
from marketmill.functions.windows import join_on, page as take_page, share_of_total, top_n_per_key
from marketmill.session import materialize


def _in_quarter(df: DataFrame, year: int | None, quarter: int | None) -> DataFrame:
    """Rows of a year, of a quarter of it, or of a quarter of any year; a year becomes a range, which reaches the scan."""
    if year is not None:
        first, last = (dt.date(year, 1, 1), dt.date(year, 12, 31))
        if quarter is not None:
            first = dt.date(year, 3 * quarter - 2, 1)
            last = dt.date(year + quarter // 4, 3 * quarter % 12 + 1, 1) - dt.timedelta(1)
        return df.filter(F.col("date").between(first, last))
    return df if quarter is None else df.filter(F.quarter("date") == quarter)


def _paged(df: DataFrame, order: Sequence[Column], page: int | None, limit: int | None) -> DataFrame:
    return df if page is None and limit is None else take_page(df, order, page, limit)


def filings_latest(filings: DataFrame, page: int | None = 0, limit: int | None = 100) -> DataFrame:
    order = [F.desc_nulls_last("filingDate"), F.asc("cik"), F.asc("date")]
    return take_page(filings, order, page, limit, band="filingDate")


def filing_extract(
    holdings: DataFrame, cik: str | None = None, year: int | None = None, quarter: int | None = None
) -> DataFrame:
    """Holdings of a filing with their share of the filing's value."""
    h = _in_quarter(holdings, year, quarter)
    if cik is not None:
        h = h.filter(F.col("cik") == cik)
    lines = h.groupBy("cik", "date", "symbol", "industry", "putCallShare").agg(
        F.sum("shares").alias("shares"), F.sum("value").alias("value")
    )
    return share_of_total(materialize(lines, "lines"), ["cik", "date"], "value", "weight")


def filing_dates(holdings: DataFrame, cik: str | None = None) -> DataFrame:
    h = holdings if cik is None else holdings.filter(F.col("cik") == cik)
    return h.select("cik", "date").distinct().withColumns({"year": F.year("date"), "quarter": F.quarter("date")})


def positions(holdings: DataFrame) -> DataFrame:
    """One row per filer, symbol and quarter end. A symbol belongs to one industry.

    The analytics read it several times; :func:`marketmill.session.materialize` it before.
    """
    kind = F.col("putCallShare")
    return holdings.groupBy("cik", "symbol", "industry", "date").agg(
        F.sum("shares").alias("shares"),
        F.sum("value").alias("value"),
        F.coalesce(F.sum(F.when(kind == "Call", F.col("shares"))), F.lit(0)).alias("calls"),
        F.coalesce(F.sum(F.when(kind == "Put", F.col("shares"))), F.lit(0)).alias("puts"),
    )


def _filings(pos: DataFrame) -> DataFrame:
    """Filings with their number per filer, the next filing date and the total value; undated rows belong to none."""
    w = Window.partitionBy("cik").orderBy("date")
    return (
        pos.filter(F.col("date").isNotNull())
        .groupBy("cik", "date")
        .agg(F.sum("value").alias("totalValue"))
        .withColumns({"filingNo": F.row_number().over(w), "nextDate": F.lead("date").over(w)})
    )


def holder_analytics(
    pos: DataFrame,
    outstanding: DataFrame,
    symbol: str | None = None,
    year: int | None = None,
    quarter: int | None = None,
    page: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Position, weight, ownership and performance per filer and symbol, now against last filing.

    ``pos`` comes from :func:`positions`. Performance is last shares times the change from the filer's last value per
    share to the market-wide value per share at the quarter end. A position is
    new or sold out only between two quarters in which the filer filed. Null filers and null symbols are
    groups of their own; undated positions belong to no filing and are left out.
    """
    filings = _filings(pos)
    dated = join_on(pos, filings, ["cik", "date"])

    def cell(date: str, is_now: bool) -> Column:
        return F.struct(F.col(date).alias("cellDate"), F.lit(is_now).alias("isNow"))

    twice = dated.select(
        "cik", "symbol", "industry", "shares", "value", "totalValue", "filingNo",
        F.inline(F.array(cell("date", True), cell("nextDate", False))),
    ).filter(F.col("cellDate").isNotNull())
    now, measures = F.col("isNow"), ("shares", "value", "totalValue", "filingNo")
    both = twice.groupBy("cik", "symbol", "industry", F.col("cellDate").alias("date")).agg(
        *[F.max(F.when(now, F.col(m))).alias(f"now_{m}") for m in measures],
        *[F.max(F.when(~now, F.col(m))).alias(f"last_{m}") for m in measures],
    )
    px = pos.groupBy("symbol", "date").agg(F.try_divide(F.sum("value"), F.sum("shares")).alias("quarterEndPrice"))
    j = join_on(join_on(both, px, ["symbol", "date"], "left"), outstanding, ["symbol"], "left")

    zero, none = F.lit(0), F.lit(0.0)
    shares, last_shares = F.coalesce("now_shares", zero), F.coalesce("last_shares", zero)
    value, last_value = F.coalesce("now_value", none), F.coalesce("last_value", none)
    out = j.select(
        "date", "cik", "symbol", "industry", F.coalesce("now_filingNo", F.col("last_filingNo") + 1).alias("no"),
        shares.alias("sharesNumber"), last_shares.alias("lastSharesNumber"),
        value.alias("marketValue"), last_value.alias("lastMarketValue"),
        F.coalesce(ratio(value, F.col("now_totalValue")) * 100, none).alias("weight"),
        F.coalesce(ratio(last_value, F.col("last_totalValue")) * 100, none).alias("lastWeight"),
        (ratio(shares, F.col("outstanding")) * 100).alias("ownership"),
        (ratio(last_shares, F.col("outstanding")) * 100).alias("lastOwnership"),
        "quarterEndPrice",
        (F.col("last_shares").isNull() & (F.coalesce("now_filingNo", F.lit(0)) > 1)).alias("isNew"),
        F.col("now_shares").isNull().alias("isSoldOut"),
        (last_shares * F.col("quarterEndPrice") - last_value).alias("performance"),
    )

    def with_change(df: DataFrame, now: str, last: str, change: str) -> DataFrame:
        return df.withColumns(
            {change: F.col(now) - F.col(last), f"{change}Percentage": pct_change(F.col(now), F.col(last))}
        )

    for now in ("weight", "marketValue", "sharesNumber", "ownership"):
        cap = now[0].upper() + now[1:]
        out = with_change(out, now, f"last{cap}", f"changeIn{cap}")
    out = out.withColumn("performancePercentage", ratio(F.col("performance"), F.col("lastMarketValue")) * 100)

    # one position series per (cik, symbol), at most one row a quarter
    w = Window.partitionBy("cik", "symbol").orderBy("date")
    held = F.when(~F.col("isSoldOut"), F.lit(1)).otherwise(0)
    out = out.withColumns(
        {
            "firstAdded": F.min(F.when(~F.col("isSoldOut"), F.col("date"))).over(w),
            "__starts": F.sum((F.col("lastSharesNumber") == 0).cast("int")).over(w),
            "lastPerformance": F.when(F.lag("no").over(w) == F.col("no") - 1, F.lag("performance").over(w)),
        }
    )
    run = Window.partitionBy("cik", "symbol", "__starts").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns(
        {
            "holdingPeriod": F.sum(held).over(run),
            "changeInPerformance": F.col("performance") - F.col("lastPerformance"),
        }
    ).drop("__starts", "no")
    out = _in_quarter(out, year, quarter)
    if symbol is not None:
        out = out.filter(F.col("symbol") == symbol)
    return _paged(out, [F.desc("date"), F.desc("marketValue"), F.asc("cik"), F.asc("symbol")], page, limit)


def holder_performance(
    analytics: DataFrame, benchmark: DataFrame | None = None, cik: str | None = None,
    page: int | None = None, limit: int | None = None,
) -> DataFrame:
    """Portfolio size, turnover, value and performance of every filer and quarter.

    Multi-year percentages compound the quarterly ones. ``benchmark`` has (date,
    benchmarkPercentage); relative figures are plain differences to it.
    """
    a = analytics if cik is None else analytics.filter(F.col("cik") == cik)
    held = ~F.col("isSoldOut")
    per = a.groupBy("cik", "date").agg(
        F.count_if(held).alias("portfolioSize"),
        F.count_if("isNew").alias("securitiesAdded"),
        F.count_if("isSoldOut").alias("securitiesRemoved"),
        F.sum("marketValue").alias("marketValue"),
        F.sum("lastMarketValue").alias("previousMarketValue"),
        F.avg(F.when(held, F.col("holdingPeriod"))).alias("averageHoldingPeriod"),
        F.coalesce(F.sum("performance"), F.lit(0.0)).alias("performance"),
    )
    top = top_n_per_key(a.filter(held), ["cik", "date"], [F.desc("marketValue"), F.asc("symbol")], 20, "__rn")
    tops = top.groupBy("cik", "date").agg(
        F.avg(F.when(F.col("__rn") <= 10, F.col("holdingPeriod"))).alias("averageHoldingPeriodTop10"),
        F.avg("holdingPeriod").alias("averageHoldingPeriodTop20"),
    )
    per = join_on(per, tops, ["cik", "date"], "left")
    w = Window.partitionBy("cik").orderBy("date")
    pct = ratio(F.col("performance"), F.col("previousMarketValue")) * 100
    per = per.withColumns(
        {
            "turnover": ratio(F.col("securitiesAdded") + F.col("securitiesRemoved"), F.col("portfolioSize")),
            "changeInMarketValue": F.col("marketValue") - F.col("previousMarketValue"),
            "changeInMarketValuePercentage": pct_change(F.col("marketValue"), F.col("previousMarketValue")),
            "performancePercentage": pct,
            "lastPerformance": F.lag("performance").over(w),
        }
    )
    per = per.withColumn("changeInPerformance", F.col("performance") - F.col("lastPerformance"))
    quarterly = F.coalesce(F.col("performancePercentage"), F.lit(0.0))
    # a total loss has no logarithm; it makes the product zero
    lost = quarterly <= -100
    growth = F.when(lost, F.lit(0.0)).otherwise(F.log1p(quarterly / 100))
    spans = {"1year": 4, "3year": 12, "5year": 20, "SinceInception": None}
    for label, quarters in spans.items():
        frame = w.rowsBetween(Window.unboundedPreceding if quarters is None else 1 - quarters, 0)
        pct_name = f"performance{label}Percentage" if quarters is None else f"performancePercentage{label}"
        per = per.withColumns(
            {
                f"performance{label}": F.sum("performance").over(frame),
                pct_name: F.when(F.max(lost).over(frame), F.lit(-100.0)).otherwise(F.expm1(F.sum(growth).over(frame)) * 100),
            }
        )
    if benchmark is not None:
        per = per.join(benchmark, "date", "left").withColumn(
            "performanceRelativePercentage", F.col("performancePercentage") - F.col("benchmarkPercentage")
        ).drop("benchmarkPercentage")
    return _paged(per, [F.desc("date"), F.asc("cik")], page, limit)


def holder_industry(
    analytics: DataFrame, cik: str | None = None, year: int | None = None, quarter: int | None = None
) -> DataFrame:
    """Weight and performance of every industry in a filer's portfolio."""
    a = analytics if cik is None else analytics.filter(F.col("cik") == cik)
    g = a.groupBy("cik", "date", "industry").agg(
        F.sum("weight").alias("weight"),
        F.sum("lastWeight").alias("lastWeight"),
        F.sum("performance").alias("performance"),
        F.sum("lastMarketValue").alias("__last"),
        F.sum("lastPerformance").alias("lastPerformance"),
    )
    out = g.withColumns(
        {
            "changeInWeight": F.col("weight") - F.col("lastWeight"),
            "changeInWeightPercentage": pct_change(F.col("weight"), F.col("lastWeight")),
            "performancePercentage": ratio(F.col("performance"), F.col("__last")) * 100,
            "changeInPerformance": F.col("performance") - F.col("lastPerformance"),
        }
    ).drop("__last")
    return _in_quarter(out, year, quarter)


def positions_summary(
    analytics: DataFrame,
    pos: DataFrame,
    symbol: str | None = None,
    year: int | None = None,
    quarter: int | None = None,
) -> DataFrame:
    """Holders, shares, money and position changes per symbol and quarter, with last values and changes."""
    a, h = analytics, pos
    if symbol is not None:
        a, h = a.filter(F.col("symbol") == symbol), h.filter(F.col("symbol") == symbol)
    held, delta = ~F.col("isSoldOut"), F.col("changeInSharesNumber")
    kept = held & ~F.col("isNew") & (F.col("lastSharesNumber") > 0)
    per = a.groupBy("symbol", "date").agg(
        F.count_if(held).alias("investorsHolding"),
        F.sum("sharesNumber").alias("numberOf13Fshares"),
        F.sum("marketValue").alias("totalInvested"),
        F.sum("ownership").alias("ownershipPercent"),
        F.count_if("isNew").alias("newPositions"),
        F.count_if(kept & (delta > 0)).alias("increasedPositions"),
        F.count_if("isSoldOut").alias("closedPositions"),
        F.count_if(kept & (delta < 0)).alias("reducedPositions"),
    )
    options = h.groupBy("symbol", "date").agg(F.sum("calls").alias("totalCalls"), F.sum("puts").alias("totalPuts"))
    per = join_on(per, options, ["symbol", "date"], "left").fillna(0, ["totalCalls", "totalPuts"])
    per = per.withColumn("putCallRatio", ratio(F.col("totalPuts"), F.col("totalCalls")))
    w = Window.partitionBy("symbol").orderBy("date")
    measures = [c for c in per.columns if c not in ("symbol", "date")]
    last = {c: f"last{c[0].upper()}{c[1:]}" for c in measures}
    per = per.withColumns({last[c]: F.lag(c).over(w) for c in measures})
    # the change of the put/call ratio is in percentage points
    scale = {c: 100 if c == "putCallRatio" else 1 for c in measures}
    per = per.withColumns({f"{c}Change": (F.col(c) - F.col(last[c])) * scale[c] for c in measures})
    return _in_quarter(per, year, quarter)


def industry_summary(holdings: DataFrame, year: int | None = None, quarter: int | None = None) -> DataFrame:
    """Value per industry and quarter with its share of the quarter."""
    g = _in_quarter(holdings, year, quarter).groupBy("date", F.col("industry").alias("industryTitle")).agg(
        F.sum("value").alias("industryValue")
    )
    return share_of_total(g, ["date"], "industryValue", "share", few=True)


def industry_rollup(holdings: DataFrame) -> DataFrame:
    """Values per (quarter, industry), per quarter, and in total; null marks a total."""
    # summed to the finest level first, so that only those few rows are multiplied
    fine = holdings.groupBy("date", F.col("industry").alias("industryTitle")).agg(F.sum("value").alias("__v"))
    return fine.rollup("date", "industryTitle").agg(F.sum("__v").alias("industryValue"))


def compare_filers(performance: DataFrame, industries: DataFrame, ciks: Sequence[str] | None = None) -> DataFrame:
    """Latest performance of filers next to their heaviest industry."""
    p, i = performance, industries
    if ciks is not None:
        p, i = p.filter(F.col("cik").isin(list(ciks))), i.filter(F.col("cik").isin(list(ciks)))
    latest = p.groupBy("cik").agg(F.max("date").alias("date"))
    top = i.groupBy("cik", "date").agg(F.max(F.struct("weight", "industry")).alias("t"))
    return (
        join_on(join_on(p, latest, ["cik", "date"]), top, ["cik", "date"], "left")
        .select(
            "cik", "date", "portfolioSize", "marketValue", "performance", "performancePercentage",
            F.col("t.industry").alias("topIndustry"), F.col("t.weight").alias("topIndustryWeight"),
        )
    )

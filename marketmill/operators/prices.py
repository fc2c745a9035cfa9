"""Bars, quotes, adjustments and simple price analyses.

Ticks are reduced to bars by one partial (map side) aggregation, so a hot
symbol costs no more shuffle than any other. Everything after that works on
bars, whose number per symbol is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.scalars import ratio, time_order
from marketmill.functions.windows import asof_last, page as take_page, share_of_total

#: Names of the bar lengths.
TIMEFRAMES = {
    "1min": "1 minute",
    "5min": "5 minutes",
    "15min": "15 minutes",
    "30min": "30 minutes",
    "1hour": "1 hour",
    "4hour": "4 hours",
}


def _ohlcv(order: Column) -> list[Column]:
    # ticks without a price are neither the first nor the last
    order = F.when(F.col("price").isNotNull(), order)
    return [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("size").alias("volume"),
    ]


def bars_eod(ticks: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Full daily bars with change, change percent and typical-price vwap.

    Open and close are the first and last priced tick by (ts, id).
    """
    bars = ticks.groupBy(*keys, F.to_date("ts").alias("date")).agg(*_ohlcv(time_order("ts", "id")))
    change = F.col("close") - F.col("open")
    return bars.withColumns(
        {
            "change": change,
            "changePercent": ratio(change, F.col("open")) * 100,
            "vwap": (F.col("high") + F.col("low") + F.col("close")) / 3,
        }
    )


def bars_light(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", "date", F.col("close").alias("price"), "volume")


def bars_intraday(ticks: DataFrame, timeframe: str, splits: DataFrame | None = None) -> DataFrame:
    """Tumbling bars labelled by their start. With ``splits`` prices are unadjusted."""
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    bars = (
        ticks.groupBy("symbol", F.window("ts", TIMEFRAMES[timeframe]).alias("w"))
        .agg(*_ohlcv(time_order("ts", "id")))
        .withColumn("date", F.col("w.start"))
        .select("symbol", "date", "open", "low", "high", "close", "volume")
    )
    return bars if splits is None else unadjust(bars, splits, prefix="")


def _later_factor(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Product of the positive factors dated after each bar's day, as ``__f``.

    One descending running sum of logarithms over bars and factors together;
    bars come before the factors of their own day and so do not see them.
    """
    daily = factors.groupBy("symbol", "date").agg(F.sum(F.ln("factor")).alias("__ln"))
    both = bars.withColumns({"__d": F.to_date("date"), "__side": F.lit(0)}).unionByName(
        daily.select("symbol", F.col("date").alias("__d"), "__ln", F.lit(1).alias("__side")),
        allowMissingColumns=True,
    )
    w = (
        Window.partitionBy("symbol")
        .orderBy(F.desc("__d"), "__side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = both.withColumn("__f", F.exp(F.coalesce(F.sum("__ln").over(w), F.lit(0.0))))
    return out.filter(F.col("__side") == 0).drop("__d", "__side", "__ln")


def unadjust(bars: DataFrame, splits: DataFrame, prefix: str = "adj") -> DataFrame:
    """Prices as traded: the later splits are taken out of split-adjusted bars."""
    f = ratio(F.col("numerator"), F.col("denominator"))
    factors = splits.select("symbol", "date", f.alias("factor")).filter("factor > 0")
    out = _later_factor(bars, factors)
    name = (lambda c: f"{prefix}{c.capitalize()}") if prefix else (lambda c: c)
    return out.select(
        "symbol",
        "date",
        *[(F.col(c) * F.col("__f")).alias(name(c)) for c in ("open", "high", "low", "close")],
        (F.col("volume") / F.col("__f")).alias("volume"),
    )


def adjust_dividends(bars: DataFrame, dividends: DataFrame) -> DataFrame:
    """Prices adjusted for later dividends by the factor 1 - dividend / previous close.

    A dividend without an earlier close, or not below it, is left out.
    """
    divs = dividends.groupBy("symbol", "date").agg(F.sum("dividend").alias("__div"))
    both = bars.withColumn("__side", F.lit(1)).unionByName(
        divs.withColumn("__side", F.lit(0)), allowMissingColumns=True
    )
    # forward: a dividend comes before the bar of its day and so sees earlier closes only
    forward = Window.partitionBy("symbol").orderBy("date", "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__prev", F.last("close", ignorenulls=True).over(forward))
    factor = F.lit(1.0) - ratio(F.col("__div"), F.col("__prev"))
    both = both.withColumn("__ln", F.when(factor > 0, F.ln(factor)))
    # backward: a bar comes before the dividend of its day and so sees later ones only
    backward = (
        Window.partitionBy("symbol").orderBy(F.desc("date"), F.desc("__side")).rowsBetween(Window.unboundedPreceding, 0)
    )
    both = both.withColumn("__f", F.exp(F.coalesce(F.sum("__ln").over(backward), F.lit(0.0))))
    return both.filter(F.col("__side") == 1).select(
        "symbol",
        "date",
        *[(F.col(c) * F.col("__f")).alias(f"adj{c.capitalize()}") for c in ("open", "high", "low", "close")],
        "volume",
    )


def quotes(
    bars: DataFrame, shares: DataFrame | None = None, as_of: str | None = None, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Full quote per symbol from its last bar (at ``as_of`` or before).

    Bars are numbered from the newest back; the averages, the 52-week range and
    the last bar then come from one aggregation over that numbering, without
    another shuffle.
    """
    if as_of is not None:
        bars = bars.filter(F.col("date") <= F.lit(as_of).cast("date"))
    w = Window.partitionBy(*keys).orderBy(F.desc("date"))
    b = bars.withColumns({"__rn": F.row_number().over(w), "__last": F.max("date").over(Window.partitionBy(*keys))})
    rn = F.col("__rn")
    in_year = F.col("date") > F.add_months("__last", -12)

    def at(n: int, c: str) -> Column:
        return F.max(F.when(rn == n, F.col(c)))

    q = b.groupBy(*keys).agg(
        F.max("date").alias("date"),
        at(1, "close").alias("price"),
        at(1, "open").alias("open"),
        at(1, "volume").alias("volume"),
        at(1, "low").alias("dayLow"),
        at(1, "high").alias("dayHigh"),
        at(2, "close").alias("previousClose"),
        F.max(F.when(in_year, F.col("high"))).alias("yearHigh"),
        F.min(F.when(in_year, F.col("low"))).alias("yearLow"),
        F.avg(F.when(rn <= 50, F.col("close"))).alias("priceAvg50"),
        F.avg(F.when(rn <= 200, F.col("close"))).alias("priceAvg200"),
    )
    change = F.col("price") - F.col("previousClose")
    q = q.withColumns(
        {
            "change": change,
            "changePercentage": ratio(change, F.col("previousClose")) * 100,
            "timestamp": F.unix_seconds(F.col("date").cast("timestamp")),
        }
    )
    if shares is not None:
        q = q.join(shares.select("symbol", "shares"), "symbol", "left")
        q = q.withColumn("marketCap", F.col("price") * F.col("shares")).drop("shares")
    return q


def quotes_short(quotes: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    return quotes.select(*keys, "price", "change", "volume")


def quotes_batch(bars: DataFrame, asset_class: str | None = None, short: bool = False) -> DataFrame:
    """Quotes of every symbol of one asset class, or of all classes."""
    keys = ("assetClass", "symbol")
    if asset_class is not None:
        bars = bars.filter(F.col("assetClass") == asset_class)
    q = quotes(bars, keys=keys)
    return quotes_short(q, keys) if short else q


def price_changes(bars: DataFrame, as_of: str | None = None) -> DataFrame:
    """Percent change of the last close against the last close at or before each anchor.

    ``ytd`` is anchored on the last day of the previous year and ``max`` on the
    first bar. An anchor before the first bar gives null.
    """
    if as_of is not None:
        bars = bars.filter(F.col("date") <= F.lit(as_of).cast("date"))
    last = F.max("date").over(Window.partitionBy("symbol"))
    b = bars.select("symbol", "date", "close", last.alias("__last"))
    at = F.col("__last")
    anchors = {
        "1D": F.date_sub(at, 1),
        "5D": F.date_sub(at, 5),
        "1M": F.add_months(at, -1),
        "3M": F.add_months(at, -3),
        "6M": F.add_months(at, -6),
        "ytd": F.date_sub(F.trunc(at, "year"), 1),
        "1Y": F.add_months(at, -12),
        "3Y": F.add_months(at, -36),
        "5Y": F.add_months(at, -60),
        "10Y": F.add_months(at, -120),
    }
    d, c = F.col("date"), F.col("close")
    agg = b.groupBy("symbol").agg(
        F.max_by("close", "date").alias("__now"),
        F.min_by("close", "date").alias("__max"),
        *[F.max_by(c, F.when(d <= a, d)).alias(f"__{k}") for k, a in anchors.items()],
        *[F.max(d <= a).alias(f"__has_{k}") for k, a in anchors.items()],
    )
    now = F.col("__now")
    pct = {
        k: F.when(F.col(f"__has_{k}"), ratio(now - F.col(f"__{k}"), F.col(f"__{k}")) * 100) for k in anchors
    }
    pct["max"] = ratio(now - F.col("__max"), F.col("__max")) * 100
    return agg.select("symbol", *[v.alias(k) for k, v in pct.items()])


def aftermarket_trade(ticks: DataFrame, close_hour: int = 16) -> DataFrame:
    """Last print of every symbol at or after the closing hour."""
    late = ticks.filter(F.hour("ts") >= close_hour)
    order = time_order("ts", "id")
    return late.groupBy("symbol").agg(
        F.max_by("price", order).alias("price"),
        F.max_by("size", order).alias("tradeSize"),
        F.unix_millis(F.max("ts").cast("timestamp")).alias("timestamp"),
    )


def aftermarket_quote(ticks: DataFrame, bid_venue: str, ask_venue: str, close_hour: int = 16) -> DataFrame:
    """Last bid and last ask of every symbol after the closing hour, in one aggregation."""
    late = ticks.filter((F.hour("ts") >= close_hour) & F.col("venue").isin(bid_venue, ask_venue))
    order = time_order("ts", "id")
    bid, ask = (F.when(F.col("venue") == v, order) for v in (bid_venue, ask_venue))
    return late.groupBy("symbol").agg(
        F.max_by("size", bid).alias("bidSize"),
        F.max_by("price", bid).alias("bidPrice"),
        F.max_by("size", ask).alias("askSize"),
        F.max_by("price", ask).alias("askPrice"),
        F.sum("size").alias("volume"),
        F.unix_millis(F.max("ts").cast("timestamp")).alias("timestamp"),
    )


def market_cap(
    bars: DataFrame,
    shares: DataFrame,
    symbols: DataFrame | None = None,
    lo: str | None = None,
    hi: str | None = None,
    latest: bool = False,
) -> DataFrame:
    """Close times the share count known on the bar's day.

    ``symbols`` restricts to a batch; ``latest`` keeps the last day per symbol.
    """
    if symbols is not None:
        bars = bars.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
        shares = shares.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    hist = shares.select("symbol", F.col("date").alias("share_date"), "shares")
    out = asof_last(bars.select("symbol", "date", "close"), hist, ["symbol"], "date", "share_date", ["shares"])
    if lo is not None:
        out = out.filter(F.col("date") >= F.lit(lo).cast("date"))
    if hi is not None:
        out = out.filter(F.col("date") <= F.lit(hi).cast("date"))
    out = out.select("symbol", "date", (F.col("close") * F.col("shares")).alias("marketCap"))
    if latest:
        out = out.groupBy("symbol").agg(
            F.max("date").alias("date"), F.max_by("marketCap", "date").alias("marketCap")
        )
    return out


def shares_float(
    df: DataFrame, symbol: str | None = None, page: int | None = None, limit: int | None = None
) -> DataFrame:
    """Free float in percent of outstanding shares; paged only when asked."""
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    pct = ratio(F.col("floatShares"), F.col("outstandingShares")) * 100
    out = df.select("symbol", "date", pct.alias("freeFloat"), "floatShares", "outstandingShares")
    if page is None and limit is None:
        return out
    return take_page(out, [F.asc("symbol")], page, limit)


def period_stats(bars: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Price range, average, first-to-last change and volume over a period."""
    if lo is not None:
        bars = bars.filter(F.col("date") >= F.lit(lo).cast("date"))
    if hi is not None:
        bars = bars.filter(F.col("date") <= F.lit(hi).cast("date"))
    out = bars.groupBy("symbol").agg(
        F.min("close").alias("minPrice"),
        F.max("close").alias("maxPrice"),
        F.avg("close").alias("avgPrice"),
        F.min_by("close", "date").alias("firstPrice"),
        F.max_by("close", "date").alias("lastPrice"),
        F.avg("volume").alias("avgVolume"),
        F.sum("volume").alias("totalVolume"),
    )
    change = F.col("lastPrice") - F.col("firstPrice")
    return out.withColumns({"change": change, "changePercent": ratio(change, F.col("firstPrice")) * 100})


def avg_range(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        *[F.avg(c).alias(f"avg{c.capitalize()}") for c in ("open", "high", "low", "close")],
        F.avg(F.col("high") - F.col("low")).alias("avgDailyRange"),
    )


def trend_flags(quotes: DataFrame) -> DataFrame:
    """Moving-average trend, cross signals and position against the day's midpoint."""
    a50, a200, px = F.col("priceAvg50"), F.col("priceAvg200"), F.col("price")
    return quotes.select(
        "symbol",
        "price",
        F.when(a50 > a200, "bullish").otherwise("bearish").alias("trend"),
        ((a50 > a200) & (px > a50)).alias("goldenCross"),
        ((a50 < a200) & (px < a50)).alias("deathCross"),
        (px > (F.col("dayHigh") + F.col("dayLow")) / 2).alias("aboveMidpoint"),
    )


def breadth(quotes: DataFrame) -> DataFrame:
    """Advancing, declining and unchanged counts with sentiment and volatility class."""
    ch = F.col("change")
    b = quotes.agg(
        F.count("*").alias("total"),
        F.count_if(ch > 0).alias("advancing"),
        F.count_if(ch < 0).alias("declining"),
        F.count_if(ch == 0).alias("unchanged"),
        F.avg(F.abs(ch)).alias("averageChange"),
    )
    up, down, avg = F.col("advancing"), F.col("declining"), F.col("averageChange")
    return b.withColumns(
        {
            **{f"{c}Percent": ratio(F.col(c), F.col("total")) * 100 for c in ("advancing", "declining", "unchanged")},
            "sentiment": F.when(up > down, "Bullish").when(down > up, "Bearish").otherwise("Neutral"),
            "volatility": F.when(avg > 10, "High").when(avg > 5, "Moderate").otherwise("Low"),
        }
    )


def comovement(bars: DataFrame, pairs: DataFrame) -> DataFrame:
    """Days on which two series move the same or the opposite way, and their correlation.

    ``pairs`` names the series (a, b) to compare; there is no all-pairs mode.
    """
    x = bars.select(F.col("symbol").alias("a"), "date", F.col("changePercent").alias("xa"))
    y = bars.select(F.col("symbol").alias("b"), "date", F.col("changePercent").alias("xb"))
    j = pairs.select("a", "b").join(x, "a").join(y, ["b", "date"])
    sign = F.signum("xa") * F.signum("xb")
    out = j.groupBy("a", "b").agg(
        F.count("*").alias("days"),
        F.count_if(sign > 0).alias("sameDirection"),
        F.count_if(sign < 0).alias("oppositeDirection"),
        F.corr("xa", "xb").alias("__corr"),
        F.stddev_pop("xa").alias("__sa"),
        F.stddev_pop("xb").alias("__sb"),
    )
    defined = (F.col("__sa") > 0) & (F.col("__sb") > 0)
    return out.withColumn("correlation", F.when(defined, F.col("__corr"))).drop("__corr", "__sa", "__sb")


def dominance(quotes: DataFrame) -> DataFrame:
    """Share of every symbol in the total market capitalisation."""
    return share_of_total(quotes.select("symbol", "marketCap"), [], "marketCap", "dominance")


def portfolio_summary(
    quotes: DataFrame, weights: DataFrame, vol_threshold: float = 2.0, strong: float = 1.0
) -> DataFrame:
    """Weighted change and volume per portfolio with a performance class.

    A change beyond ``strong`` percent either way counts as strong.
    """
    j = weights.join(quotes.select("symbol", "changePercentage", "volume"), "symbol")
    out = j.groupBy("portfolio").agg(
        F.sum(F.col("weight") * F.col("changePercentage")).alias("weightedChange"),
        F.sum(F.col("weight") * F.col("volume")).alias("weightedVolume"),
        F.count_if(F.abs("changePercentage") > vol_threshold).alias("highVolatilityMembers"),
        F.count("*").alias("members"),
    )
    ch = F.col("weightedChange")
    label = (
        F.when(ch > strong, "strong positive")
        .when(ch > 0, "moderate positive")
        .when(ch > -strong, "moderate negative")
        .otherwise("strong negative")
    )
    return out.withColumn("performance", label)


def high_volatility_members(quotes: DataFrame, weights: DataFrame, vol_threshold: float = 2.0) -> DataFrame:
    """The members behind the count in :func:`portfolio_summary`, one row each."""
    j = weights.join(quotes.select("symbol", "changePercentage"), "symbol")
    return j.filter(F.abs("changePercentage") > vol_threshold).select("portfolio", "symbol", "changePercentage")


def cap_exposure(quotes: DataFrame, weights: DataFrame, large_cap: float = 1e11) -> DataFrame:
    """Weighted market cap per portfolio, and the weight in large caps with its class."""
    j = weights.join(quotes.select("symbol", "marketCap"), "symbol")
    out = j.groupBy("portfolio").agg(
        F.sum(F.col("weight") * F.col("marketCap")).alias("weightedMarketCap"),
        F.coalesce(F.sum(F.when(F.col("marketCap") > large_cap, F.col("weight"))), F.lit(0.0)).alias("largeCapExposure"),
    )
    share = F.col("largeCapExposure")
    return out.withColumn(
        "largeCapClass", F.when(share > 0.7, "high").when(share > 0.4, "moderate").otherwise("low")
    )


def currency_exposure(weights: DataFrame, currency: str, majors: Sequence[str]) -> DataFrame:
    """Weight in pairs that start or end with a currency, and in pairs naming a major one.

    Four pairs or more count as diversified.
    """
    pair, w = F.col("pair"), F.col("weight")
    touches = pair.endswith(currency) | pair.startswith(currency)
    major = F.lit(False)
    for m in majors:
        major = major | pair.contains(m)
    return weights.groupBy("portfolio").agg(
        F.count("*").alias("pairs"),
        F.coalesce(F.sum(F.when(touches, w)), F.lit(0.0)).alias("exposure"),
        F.coalesce(F.sum(F.when(major, w)), F.lit(0.0)).alias("majorExposure"),
        (F.count("*") >= 4).alias("diversified"),
    )

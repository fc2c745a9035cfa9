"""Insider trades, beneficial ownership and congressional disclosures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions.scalars import amount_bounds, ratio
from marketmill.functions.windows import page as take_page, top_n_per_key


def insider_latest(
    feed: DataFrame, order: Sequence[Column], trade_date: str | None = None, page: int | None = 0, limit: int | None = 100
) -> DataFrame:
    """One page of the feed, newest filing first as ``order`` says, optionally of one filing date."""
    if trade_date is not None:
        feed = feed.filter(F.col("filingDate") == F.lit(trade_date).cast("date"))
    return take_page(feed, order, page, limit, band="filingDate")


def insider_search(
    feed: DataFrame,
    order: Sequence[Column] = (),
    symbol: str | None = None,
    reporting_cik: str | None = None,
    company_cik: str | None = None,
    transaction_type: str | None = None,
    page: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Trades matching every given field; paged only when asked."""
    wanted = {
        "symbol": symbol, "reportingCik": reporting_cik, "companyCik": company_cik, "transactionType": transaction_type,
    }
    for column, value in wanted.items():
        if value is not None:
            feed = feed.filter(F.col(column) == value)
    return feed if page is None and limit is None else take_page(feed, order, page, limit)


def insider_stats(feed: DataFrame) -> DataFrame:
    """Acquired and disposed counts, totals and averages per symbol and quarter."""
    acquired, disposed = (F.col("acquisitionOrDisposition") == x for x in ("A", "D"))
    n, kind = F.col("securitiesTransacted"), F.col("transactionType")
    g = feed.groupBy("symbol", F.year("filingDate").alias("year"), F.quarter("filingDate").alias("quarter")).agg(
        F.count_if(acquired).alias("acquiredTransactions"),
        F.count_if(disposed).alias("disposedTransactions"),
        F.coalesce(F.sum(F.when(acquired, n)), F.lit(0)).alias("totalAcquired"),
        F.coalesce(F.sum(F.when(disposed, n)), F.lit(0)).alias("totalDisposed"),
        F.count_if(kind.startswith("P-")).alias("totalPurchases"),
        F.count_if(kind.startswith("S-")).alias("totalSales"),
    )
    a, d = F.col("acquiredTransactions"), F.col("disposedTransactions")
    return g.withColumns(
        {
            "acquiredDisposedRatio": ratio(a, d),
            "averageAcquired": ratio(F.col("totalAcquired"), a),
            "averageDisposed": ratio(F.col("totalDisposed"), d),
        }
    )


_NUMERIC = (
    "soleVotingPower", "sharedVotingPower", "soleDispositivePower", "sharedDispositivePower", "amountBeneficiallyOwned",
    "percentOfClass",
)


def beneficial_ownership(
    filings: DataFrame, order: Sequence[Column], symbol: str | None = None, limit: int | None = None
) -> DataFrame:
    """Ownership filings with numbers read from text; the newest ``limit`` per symbol."""
    f = filings if symbol is None else filings.filter(F.col("symbol") == symbol)
    numbers = {c: F.regexp_replace(c, ",", "").try_cast("double") for c in _NUMERIC if c in f.columns}
    f = f.withColumns(numbers)
    return f if limit is None else top_n_per_key(f, ["symbol"], order, limit)


def insider_sentiment(feed: DataFrame) -> DataFrame:
    """Market-wide acquisition and disposition counts with a label, in one row."""
    s = feed.agg(
        F.count("*").alias("totalTrades"),
        F.count_if(F.col("acquisitionOrDisposition") == "A").alias("acquisitions"),
        F.count_if(F.col("acquisitionOrDisposition") == "D").alias("dispositions"),
    )
    a, d = F.col("acquisitions"), F.col("dispositions")
    return s.withColumns(
        {
            "acquisitionPercent": ratio(a, F.col("totalTrades")) * 100,
            "dispositionPercent": ratio(d, F.col("totalTrades")) * 100,
            "sentiment": F.when(a > d, "Bullish").when(d > a, "Bearish").otherwise("Neutral"),
        }
    )


def most_active(feed: DataFrame, k: int = 10) -> DataFrame:
    """Symbols with the most insider trades."""
    return feed.groupBy("symbol").agg(F.count("*").alias("trades")).orderBy(F.desc("trades"), "symbol").limit(k)


def congress_latest(
    disclosures: DataFrame, order: Sequence[Column], chamber: str | None = None, page: int | None = 0,
    limit: int | None = 100,
) -> DataFrame:
    """One page of the latest disclosures of a chamber, newest disclosure first as ``order`` says."""
    if chamber is not None:
        disclosures = disclosures.filter(F.col("chamber") == chamber)
    return take_page(disclosures, order, page, limit, band="disclosureDate")


def congress_trades(disclosures: DataFrame, chamber: str | None = None, symbol: str | None = None) -> DataFrame:
    """Disclosed trades with their amount range in numbers and the days until disclosure."""
    d = disclosures
    if chamber is not None:
        d = d.filter(F.col("chamber") == chamber)
    if symbol is not None:
        d = d.filter(F.col("symbol") == symbol)
    low, high = amount_bounds("amount")
    return d.withColumns({"amountLow": low, "amountHigh": high}).withColumns(
        {
            "amountMid": (F.col("amountLow") + F.col("amountHigh")) / 2,
            "disclosureLag": F.datediff("disclosureDate", "transactionDate"),
        }
    )

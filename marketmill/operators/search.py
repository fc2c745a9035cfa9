"""Searches, screening, universes, request validation, simple counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions.scalars import ratio
from marketmill.functions.windows import first_per_key, page as take_page


def search_symbols(
    directory: DataFrame, query: str, limit: int | None = None, exchange: str | None = None
) -> DataFrame:
    """Symbols starting with, or names containing, a text; exact symbol first."""
    d = directory if exchange is None else directory.filter(F.col("exchange") == exchange)
    symbol, name = F.upper(F.col("symbol").cast("string")), F.lower("name")
    d = d.filter(symbol.startswith(query.upper()) | name.contains(query.lower()))
    if limit is None:
        return d
    rank = F.when(symbol == query.upper(), 0).when(symbol.startswith(query.upper()), 1).otherwise(2)
    return d.orderBy(rank, "symbol").limit(limit)


def search_companies(
    directory: DataFrame, query: str, limit: int | None = None, exchange: str | None = None
) -> DataFrame:
    """Companies whose name contains a text."""
    d = directory if exchange is None else directory.filter(F.col("exchange") == exchange)
    d = d.filter(F.lower("name").contains(query.lower()))
    return d if limit is None else d.orderBy("name", "symbol").limit(limit)


#: Numeric bounds of the screener and the column each applies to.
_RANGES = {
    "market_cap": "marketCap", "beta": "beta", "price": "price", "dividend": "lastDividend", "volume": "volume",
}
#: Equality filters of the screener.
_EQUALS = {
    "sector": "sector", "industry": "industry", "exchange": "exchange", "country": "country", "is_etf": "isEtf",
    "is_fund": "isFund", "is_actively_trading": "isActivelyTrading",
}


def screen(
    df: DataFrame, limit: int | None = None, include_all_share_classes: bool | None = None, **bounds: object
) -> DataFrame:
    """Stocks that satisfy every given bound, by market cap.

    Bounds are ``<name>_more_than`` and ``<name>_lower_than`` (both strict) for
    market_cap, beta, price, dividend and volume, and exact values for sector,
    industry, exchange, country and the three flags. What is not given does not
    filter; without ``limit`` all rows come, in no order. Share classes are reduced to the largest per company only when
    ``include_all_share_classes`` is False.
    """
    for name, value in bounds.items():
        if name not in _EQUALS and name.removesuffix("_more_than").removesuffix("_lower_than") not in _RANGES:
            raise TypeError(f"unknown screener bound {name!r}")
        if value is None:
            continue
        if name in _EQUALS:
            df = df.filter(F.col(_EQUALS[name]) == F.lit(value))
        elif name.endswith("_more_than"):
            df = df.filter(F.col(_RANGES[name.removesuffix("_more_than")]) > F.lit(value))
        else:
            df = df.filter(F.col(_RANGES[name.removesuffix("_lower_than")]) < F.lit(value))
    order = [F.desc_nulls_last("marketCap"), F.asc("symbol")]
    if include_all_share_classes is False:
        # a row without a company name is a company of its own
        named = first_per_key(df.filter(F.col("companyName").isNotNull()), ["companyName"], order)
        df = named.unionByName(df.filter(F.col("companyName").isNull()))
    return df if limit is None else df.orderBy(*order).limit(limit)


def us_only(df: DataFrame, currency: str | None = "currency") -> DataFrame:
    """Drop symbols that do not look US-listed.

    A non-blank currency other than USD drops a row, as do a dot in the symbol
    and the prefix 0P. The currency is trimmed for the blank test only.
    """
    symbol = F.coalesce(F.col("symbol"), F.lit(""))
    keep = (symbol != "") & ~symbol.contains(".") & ~symbol.startswith("0P")
    if currency is not None:
        c = F.col(currency)
        keep = keep & F.coalesce((F.trim(c) == "") | (F.upper(c) == "USD"), F.lit(True))
    return df.filter(keep)


def quarantine(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split requests (symbol, date, limit, page) into valid and rejected with reasons.

    Valid symbols come out trimmed and upper-cased. A date is ten characters in
    three whole numbers; only ``strict`` also wants it to exist. An empty date
    counts as none.
    """
    symbol = F.upper(F.trim("symbol"))
    date = F.when(F.col("date") != "", F.col("date"))
    part = r"\s*[+-]?\d+\s*"
    shaped = (F.length(date) == 10) & (F.regexp_count(date, F.lit("-")) == 2) & date.rlike(f"^{part}-{part}-{part}$")
    bad_date = date.isNotNull() & ~F.coalesce(shaped, F.lit(False))
    if strict:
        bad_date = bad_date | (date.isNotNull() & F.try_to_date(date, "yyyy-MM-dd").isNull())
    reasons = F.array_compact(
        F.array(
            F.when(F.coalesce(symbol, F.lit("")) == "", F.lit("symbol")),
            F.when(bad_date, F.lit("date")),
            F.when(F.coalesce(~F.col("limit").between(1, 10000), F.lit(False)), F.lit("limit")),
            F.when(F.coalesce(F.col("page") < 0, F.lit(False)), F.lit("page")),
        )
    )
    checked = df.withColumn("reasons", reasons)
    valid = checked.filter(F.size("reasons") == 0).drop("reasons").withColumn("symbol", symbol).withColumn("date", date)
    return valid, checked.filter(F.size("reasons") > 0)


def search_by_name(df: DataFrame, name: str, columns: Sequence[str], distinct: bool = False) -> DataFrame:
    """Rows whose name, put together from the given columns, contains a text."""
    full = F.lower(F.concat_ws(" ", *columns))
    out = df.filter(full.contains(name.lower()))
    return out.distinct() if distinct else out


def mergers(
    deals: DataFrame, name: str | None = None, page: int | None = 0, limit: int | None = 100
) -> DataFrame:
    """Latest deals, newest first, or all deals with a company name on either side."""
    if name is not None:
        n = name.lower()
        return deals.filter(F.lower("companyName").contains(n) | F.lower("targetedCompanyName").contains(n))
    order = [F.desc("transactionDate"), F.asc("symbol"), F.asc("targetedSymbol"), F.asc("link")]
    return take_page(deals, order, page, limit, band="transactionDate")


def transcript_symbols(transcripts: DataFrame) -> DataFrame:
    """Symbols with the number of their transcripts."""
    return transcripts.groupBy("symbol").agg(F.count_distinct("conv_id").alias("transcripts"))


def forex_pairs(pairs: DataFrame, width: int = 3) -> DataFrame:
    """Pairs split into base and quote currency of equal width."""
    return pairs.select(
        F.col("pair").alias("symbol"),
        F.substring("pair", 1, width).alias("fromCurrency"),
        F.substring("pair", width + 1, width).alias("toCurrency"),
    ).distinct()


def universe(directory: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Symbol list of a directory table with the wanted columns."""
    d = directory if where is None else directory.filter(where)
    return d.select(*columns).distinct()


def domain(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def active_share(everything: DataFrame, active: DataFrame) -> DataFrame:
    """How many symbols of a universe are active, in total and percent."""
    a = active.select("symbol").distinct().withColumn("__on", F.lit(1))
    return everything.select("symbol").distinct().join(a, "symbol", "left").agg(
        F.count("*").alias("total"),
        F.count("__on").alias("active"),
        (ratio(F.count("__on"), F.count("*")) * 100).alias("activePercent"),
    )


def top_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(k)


def list_by(df: DataFrame, key: str, item: str) -> DataFrame:
    """Sorted distinct items per key as one text; meant for small code lists such as exchanges.

    Pairs are made distinct first, so only the code list itself is gathered.
    """
    pairs = df.select(key, item).distinct()
    return pairs.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(item)), ", ").alias("items"))


def summary_stats(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, min, max and average of a column.

    The count is that of the non-null values, or of the rows if all are null.
    """
    n = F.count(key)
    return df.groupBy(*by).agg(
        F.when(n == 0, F.count("*")).otherwise(n).alias("count"),
        F.min(key).alias("min"),
        F.max(key).alias("max"),
        F.avg(key).alias("avg"),
    )

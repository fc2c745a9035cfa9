"""News feeds and news search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.functions.windows import page as take_page
from marketmill.sources.datasets import read_range

ORDER = ("publishedDate", "id")


def news(
    df: DataFrame,
    variant: str | None = None,
    page: int | None = 0,
    limit: int | None = 100,
    lo: str | None = None,
    hi: str | None = None,
) -> DataFrame:
    """One page of a news variant in a date range, newest first.

    The table should be partitioned by variant, so that the filter prunes.
    """
    if variant is not None:
        df = df.filter(F.col("variant") == variant)
    df = read_range(df, "publishedDate", lo, hi, keep_undated=False)
    return take_page(df, [F.desc_nulls_last("publishedDate"), F.asc("id")], page, limit, band="publishedDate")


def news_search(
    df: DataFrame, symbols: str, variant: str | None = None, lo: str | None = None, hi: str | None = None
) -> DataFrame:
    """News naming at least one of a comma list of symbols; each article once."""
    wanted = F.array(*[F.lit(s.strip()) for s in symbols.split(",") if s.strip()])
    if variant is not None:
        df = df.filter(F.col("variant") == variant)
    df = read_range(df, "publishedDate", lo, hi, keep_undated=False)
    return df.filter(F.arrays_overlap(F.split("symbols", r"\s*,\s*"), wanted))


def news_for(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """News per symbol of a symbol table, for watch lists too long for a comma list."""
    named = df.withColumn("symbol", F.explode(F.array_distinct(F.split("symbols", r"\s*,\s*"))))
    return named.join(symbols.select("symbol").distinct(), "symbol", "left_semi")

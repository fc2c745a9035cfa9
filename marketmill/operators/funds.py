"""Fund holdings, weightings, exposure and concentration.

Fund lines are summed to one row per (fund, asset) before anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.functions.scalars import percent_to_number
from marketmill.functions.windows import first_per_key, share_of_total, top_n_per_key
from marketmill.session import materialize


def etf_holdings(lines: DataFrame, symbol: str | None = None) -> DataFrame:
    """Shares, value and weight in percent of every asset of a fund. An asset has one name."""
    df = lines if symbol is None else lines.filter(F.col("symbol") == symbol)
    assets = df.groupBy("symbol", "asset", "name").agg(
        F.sum("shares").alias("sharesNumber"), F.sum("value").alias("marketValue")
    )
    return share_of_total(materialize(assets, "assets"), ["symbol"], "marketValue", "weightPercentage")


def weightings(lines: DataFrame, by: str) -> DataFrame:
    """Weight of every sector or country in a fund."""
    g = lines.groupBy("symbol", by).agg(F.sum("value").alias("value"))
    return share_of_total(g, ["symbol"], "value", "weightPercentage", few=True)


def etf_sectors(lines: DataFrame) -> DataFrame:
    return weightings(lines, "sector").select("symbol", "sector", "weightPercentage")


def etf_countries(lines: DataFrame) -> DataFrame:
    """Country weights as percent text with two decimals."""
    w = weightings(lines, "country")
    text = F.concat(F.format_string("%.2f", F.round("weightPercentage", 2)), F.lit("%"))
    return w.select("symbol", "country", text.alias("weightPercentage"))


def country_numbers(countries: DataFrame) -> DataFrame:
    """Percent texts of :func:`etf_countries` back as numbers."""
    return countries.withColumn("weightPercentage", percent_to_number("weightPercentage"))


def etf_info(lines: DataFrame) -> DataFrame:
    """Holdings count, assets and the list of sector exposures, heaviest first.

    Every asset belongs to one sector.
    """
    per_asset = lines.groupBy("symbol", "sector", "asset").agg(F.sum("value").alias("value"))
    per_sector = per_asset.groupBy("symbol", "sector").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    per_sector = share_of_total(per_sector, ["symbol"], "value", "exposure", few=True)
    item = F.struct(F.col("exposure"), F.col("sector"))
    listed = F.sort_array(F.collect_list(item), asc=False)
    return per_sector.groupBy("symbol").agg(
        F.sum("n").alias("holdingsCount"),
        F.sum("value").alias("assetsUnderManagement"),
        F.transform(
            listed, lambda x: F.struct(x["sector"].alias("industry"), x["exposure"].alias("exposure"))
        ).alias("sectorsList"),
    )


def asset_exposure(holdings: DataFrame, asset: str | None = None) -> DataFrame:
    """Funds that hold an asset, from :func:`etf_holdings`."""
    h = holdings if asset is None else holdings.filter(F.col("asset") == asset)
    return h.select("asset", "symbol", "sharesNumber", "weightPercentage", "marketValue")


def disclosure_holders(lines: DataFrame) -> DataFrame:
    """Latest disclosed position of every holder of a fund, with its weight among them."""
    order = [F.desc("date"), F.asc("orderKey"), F.asc("asset"), F.asc("shares"), F.asc("value")]
    latest = first_per_key(lines, ["symbol", "holder"], order)
    latest = latest.select("symbol", "holder", "date", "shares", "value")
    return share_of_total(materialize(latest, "holders"), ["symbol"], "value", "weightPercent")


def concentration(sectors: DataFrame, k: int = 3, threshold: float = 50.0) -> DataFrame:
    """Summed weight of the ``k`` heaviest sectors of every fund."""
    order = [F.desc("weightPercentage"), F.asc("sector")]
    top = top_n_per_key(sectors, ["symbol"], order, k)
    out = top.groupBy("symbol").agg(F.sum("weightPercentage").alias("topWeight"))
    return out.withColumn("highConcentration", F.col("topWeight") > threshold)


def look_through(
    allocations: DataFrame, weights: DataFrame, by: str, top_n: int | None = None, k: int = 5
) -> DataFrame:
    """Exposure of a portfolio of funds per sector or country, the ``k`` largest.

    ``allocations`` has (portfolio, symbol, allocation). All rows of a
    fund are added up, or with ``top_n`` its heaviest ones.
    """
    if top_n is not None:
        weights = top_n_per_key(weights, ["symbol"], [F.desc("weightPercentage"), F.asc(by)], top_n)
    j = allocations.join(weights, "symbol")
    g = j.groupBy("portfolio", by).agg(F.sum(F.col("allocation") * F.col("weightPercentage")).alias("exposure"))
    return top_n_per_key(g, ["portfolio"], [F.desc("exposure"), F.asc(by)], k)


def weighted_expense(allocations: DataFrame, info: DataFrame) -> DataFrame:
    """Allocation-weighted expense ratio and holdings count of a portfolio."""
    j = allocations.join(info.select("symbol", "expenseRatio", "holdingsCount"), "symbol")
    return j.groupBy("portfolio").agg(
        F.sum(F.col("allocation") * F.col("expenseRatio")).alias("expenseRatio"),
        F.sum(F.col("allocation") * F.col("holdingsCount")).alias("holdingsCount"),
    )

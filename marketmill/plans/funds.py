"""L: fund holdings over the ``fund`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import funds as L

from .registry import CTES, query
from .tables import fund, table

CTES["fund_assets"] = """
SELECT *, "marketValue" / sum("marketValue") OVER (PARTITION BY symbol) * 100 AS "weightPercentage" FROM (
  SELECT symbol, asset, min(name) AS name, CAST(sum(shares) AS BIGINT) AS "sharesNumber", sum(value) AS "marketValue" FROM fund GROUP BY 1, 2)"""
for _by in ("sector", "country"):
    CTES[f"fund_{_by}"] = f"""
SELECT symbol, {_by}, value / sum(value) OVER (PARTITION BY symbol) * 100 AS "weightPercentage" FROM (
  SELECT symbol, {_by}, sum(value) AS value FROM fund GROUP BY 1, 2)"""


@query("L1_etf_holdings", "SELECT * FROM fund_assets", r6="weightPercentage", r4="marketValue")
def l1(spark, sf):
    return L.etf_holdings(fund(spark, sf))


@query(
    "L2_etf_info",
    """SELECT a.symbol, "holdingsCount", aum AS "assetsUnderManagement", sectors AS "sectorsList"
FROM (SELECT symbol, count(*) AS "holdingsCount", sum("marketValue") AS aum FROM fund_assets GROUP BY 1) a
JOIN (SELECT symbol, string_agg(sector || '=' || CAST(CAST(round("weightPercentage", 3) AS DECIMAL(9, 3)) AS VARCHAR), ';' ORDER BY "weightPercentage" DESC, sector DESC) AS sectors
      FROM fund_sector GROUP BY 1) s ON a.symbol = s.symbol""",
    r4="assetsUnderManagement",
)
def l2(spark, sf):
    info = L.etf_info(fund(spark, sf))
    text = F.transform(
        "sectorsList",
        lambda x: F.concat(x["industry"], F.lit("="), F.round(x["exposure"], 3).cast("decimal(9,3)").cast("string")),
    )
    return info.withColumn("sectorsList", F.array_join(text, ";"))


@query(
    "L3_etf_countries",
    """SELECT symbol, country, CAST(CAST(round("weightPercentage", 2) AS DECIMAL(9, 2)) AS VARCHAR) || '%' AS "weightPercentage" FROM fund_country""",
)
def l3(spark, sf):
    return L.etf_countries(fund(spark, sf))


@query(
    "L3_country_numbers",
    'SELECT symbol, country, CAST(CAST(round("weightPercentage", 2) AS DECIMAL(9, 2)) AS DOUBLE) AS "weightPercentage" FROM fund_country',
)
def l3n(spark, sf):
    return L.country_numbers(L.etf_countries(fund(spark, sf)))


@query("L4_etf_sectors", "SELECT * FROM fund_sector", r6="weightPercentage")
def l4(spark, sf):
    return L.etf_sectors(fund(spark, sf))


@query(
    "L5_asset_exposure",
    'SELECT asset, symbol, "sharesNumber", "weightPercentage", "marketValue" FROM fund_assets',
    r6="weightPercentage",
    r4="marketValue",
)
def l5(spark, sf):
    return L.asset_exposure(L.etf_holdings(fund(spark, sf)))


@query(
    "L6_disclosure_holders",
    """SELECT *, value / sum(value) OVER (PARTITION BY symbol) * 100 AS "weightPercent" FROM (
  SELECT symbol, holder, date, shares, value FROM fund
  QUALIFY row_number() OVER (PARTITION BY symbol, holder ORDER BY date DESC, "orderKey", asset, shares, value) = 1)""",
    r6="weightPercent",
)
def l6(spark, sf):
    return L.disclosure_holders(fund(spark, sf))


@query(
    "L7_concentration",
    """SELECT symbol, sum("weightPercentage") AS "topWeight", sum("weightPercentage") > 50 AS "highConcentration" FROM (
  SELECT * FROM fund_sector QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "weightPercentage" DESC, sector) <= 3) GROUP BY 1""",
    r6="topWeight",
)
def l7(spark, sf):
    return L.concentration(L.etf_sectors(fund(spark, sf)))


CTES["allocations"] = """
SELECT 'P' || CAST(s_nationkey AS VARCHAR) AS portfolio, CAST(s_suppkey AS VARCHAR) AS symbol, s_acctbal / 10000 AS allocation FROM supplier"""


def allocations(spark, sf):
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("portfolio"),
        F.col("s_suppkey").cast("string").alias("symbol"), (F.col("s_acctbal") / 10000).alias("allocation"),
    )


def _look(by: str) -> None:
    @query(
        f"L8_look_through_{by}",
        f"""SELECT portfolio, {by}, exposure FROM (
  SELECT portfolio, {by}, sum(allocation * "weightPercentage") AS exposure FROM allocations JOIN fund_{by} USING (symbol) GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY portfolio ORDER BY exposure DESC, {by}) <= 5""",
        r6="exposure",
    )
    def run(spark, sf):
        weights = L.weightings(fund(spark, sf), by).select("symbol", by, "weightPercentage")
        return L.look_through(allocations(spark, sf), weights, by)


for _by in ("sector", "country"):
    _look(_by)


@query(
    "L8_weighted_expense",
    """SELECT portfolio, sum(allocation * e) AS "expenseRatio", sum(allocation * n) AS "holdingsCount" FROM allocations
JOIN (SELECT symbol, count(*) AS n, sum(CAST(asset AS BIGINT) % 10) / count(*) / 100 AS e FROM fund_assets GROUP BY 1) USING (symbol) GROUP BY 1""",
    r6="expenseRatio holdingsCount",
)
def l8e(spark, sf):
    assets = fund(spark, sf).select("symbol", "asset").distinct()
    info = assets.groupBy("symbol").agg(
        F.count("*").alias("holdingsCount"), (F.sum(F.col("asset").cast("bigint") % 10) / F.count("*") / 100).alias("expenseRatio")
    )
    return L.weighted_expense(allocations(spark, sf), info)

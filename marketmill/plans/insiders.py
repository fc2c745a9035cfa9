"""K: insider and congressional trades over the ``insider`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import insiders as K

from .registry import CTES, query
from .tables import INSIDER_ORDER_SQL, insider, insider_order, table


@query("K1_insider_latest", f"SELECT * FROM insider ORDER BY {INSIDER_ORDER_SQL} LIMIT 100 OFFSET 200")
def k1(spark, sf):
    return K.insider_latest(insider(spark, sf), insider_order(), page=2)


@query("K1_insider_deep", f"SELECT * FROM insider ORDER BY {INSIDER_ORDER_SQL} LIMIT 100 OFFSET 12000")
def k1_deep(spark, sf):
    return K.insider_latest(insider(spark, sf), insider_order(), page=120)


@query(
    "K2_insider_stats",
    """SELECT *, "acquiredTransactions" / nullif("disposedTransactions", 0) AS "acquiredDisposedRatio",
       "totalAcquired" / nullif("acquiredTransactions", 0) AS "averageAcquired", "totalDisposed" / nullif("disposedTransactions", 0) AS "averageDisposed"
FROM (SELECT symbol, CAST(year("filingDate") AS INTEGER) AS year, CAST(quarter("filingDate") AS INTEGER) AS quarter,
  count(*) FILTER ("acquisitionOrDisposition" = 'A') AS "acquiredTransactions",
  count(*) FILTER ("acquisitionOrDisposition" = 'D') AS "disposedTransactions",
  CAST(coalesce(sum("securitiesTransacted") FILTER ("acquisitionOrDisposition" = 'A'), 0) AS BIGINT) AS "totalAcquired",
  CAST(coalesce(sum("securitiesTransacted") FILTER ("acquisitionOrDisposition" = 'D'), 0) AS BIGINT) AS "totalDisposed",
  count(*) FILTER (starts_with("transactionType", 'P-')) AS "totalPurchases",
  count(*) FILTER (starts_with("transactionType", 'S-')) AS "totalSales" FROM insider GROUP BY 1, 2, 3)""",
    r6="acquiredDisposedRatio averageAcquired averageDisposed",
)
def k2(spark, sf):
    return K.insider_stats(insider(spark, sf))


CTES["ownership_raw"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS "filingDate", l_orderkey AS id, l_linenumber AS line, l_partkey AS part,
       CASE WHEN l_returnflag = 'N' THEN 'n/a' ELSE format('{:,}', CAST(l_quantity * 1000 AS BIGINT)) END AS "amountBeneficiallyOwned",
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.5' AS "percentOfClass" FROM lineitem"""


def ownership(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"), F.to_date("l_shipdate").alias("filingDate"),
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.format_number((q * 1000).cast("bigint"), 0)).alias("amountBeneficiallyOwned"),
        F.concat(q.cast("int").cast("string"), F.lit(".5")).alias("percentOfClass"),
    )


OWN_SQL = """SELECT * REPLACE (try_cast(replace("amountBeneficiallyOwned", ',', '') AS DOUBLE) AS "amountBeneficiallyOwned",
       try_cast("percentOfClass" AS DOUBLE) AS "percentOfClass") FROM ownership_raw"""


@query("K3_beneficial_ownership", OWN_SQL)
def k3(spark, sf):
    return K.beneficial_ownership(ownership(spark, sf), [])


@query(
    "K3_beneficial_ownership_newest",
    OWN_SQL + ' QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "filingDate" DESC, id, line, part, "percentOfClass") <= 5',
)
def k3n(spark, sf):
    order = [F.desc("filingDate"), F.asc("id"), F.asc("line"), F.asc("part"), F.asc("percentOfClass")]
    return K.beneficial_ownership(ownership(spark, sf), order, limit=5)


@query(
    "K4_insider_sentiment",
    """SELECT *, acquisitions / "totalTrades" * 100 AS "acquisitionPercent", dispositions / "totalTrades" * 100 AS "dispositionPercent",
       CASE WHEN acquisitions > dispositions THEN 'Bullish' WHEN dispositions > acquisitions THEN 'Bearish' ELSE 'Neutral' END AS sentiment
FROM (SELECT count(*) AS "totalTrades", count(*) FILTER ("acquisitionOrDisposition" = 'A') AS acquisitions,
             count(*) FILTER ("acquisitionOrDisposition" = 'D') AS dispositions FROM insider)""",
    r6="acquisitionPercent dispositionPercent",
)
def k4(spark, sf):
    return K.insider_sentiment(insider(spark, sf))


@query("K4_most_active", "SELECT symbol, count(*) AS trades FROM insider GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def k4m(spark, sf):
    return K.most_active(insider(spark, sf))


CTES["congress"] = """
SELECT symbol, CASE WHEN "lineNumber" % 2 = 0 THEN 'senate' ELSE 'house' END AS chamber, "filingDate" AS "disclosureDate", "transactionDate",
       "transactionType" AS type, '$' || format('{:,}', "securitiesTransacted" * 1000 + 1) || ' - $' ||
       format('{:,}', "securitiesTransacted" * 2000) AS amount, "orderKey", "lineNumber", "partKey"
FROM insider"""


def congress(spark, sf):
    n = F.col("securitiesTransacted")
    return insider(spark, sf).select(
        "symbol", F.when(F.col("lineNumber") % 2 == 0, "senate").otherwise("house").alias("chamber"),
        F.col("filingDate").alias("disclosureDate"), "transactionDate", F.col("transactionType").alias("type"),
        F.concat(F.lit("$"), F.format_number(n * 1000 + 1, 0), F.lit(" - $"), F.format_number(n * 2000, 0)).alias("amount"),
        "orderKey", "lineNumber", "partKey",
    )


CONGRESS_ORDER = '"disclosureDate" DESC, symbol, "orderKey", "lineNumber", "partKey", amount, type'


def congress_order():
    return [F.desc("disclosureDate"), *[F.asc(c) for c in ("symbol", "orderKey", "lineNumber", "partKey", "amount", "type")]]


def _latest(chamber: str) -> None:
    @query(
        f"K5_{chamber}_latest",
        f"SELECT * FROM congress WHERE chamber = '{chamber}' ORDER BY {CONGRESS_ORDER} LIMIT 100 OFFSET 100",
    )
    def run(spark, sf):
        return K.congress_latest(congress(spark, sf), congress_order(), chamber, 1)


for _c in ("senate", "house"):
    _latest(_c)


@query("K5_senate_deep", f"SELECT * FROM congress WHERE chamber = 'senate' ORDER BY {CONGRESS_ORDER} LIMIT 100 OFFSET 12000")
def k5_deep(spark, sf):
    return K.congress_latest(congress(spark, sf), congress_order(), "senate", 120)


@query(
    "K6_congress_trades",
    """SELECT *, ("amountLow" + "amountHigh") / 2 AS "amountMid", CAST("disclosureDate" - "transactionDate" AS INTEGER) AS "disclosureLag" FROM (
  SELECT *, CAST(replace(regexp_extract_all(amount, '\\$([0-9,]+)', 1)[1], ',', '') AS BIGINT) AS "amountLow",
         CAST(replace(regexp_extract_all(amount, '\\$([0-9,]+)', 1)[2], ',', '') AS BIGINT) AS "amountHigh" FROM congress)""",
)
def k6(spark, sf):
    return K.congress_trades(congress(spark, sf))

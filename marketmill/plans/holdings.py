"""J: institutional holdings over the ``holdings`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import holdings as J
from marketmill.session import materialize

from .registry import CTES, query
from .tables import holdings, outstanding

CTES["pos"] = """
SELECT cik, symbol, date, min(industry) AS industry, CAST(sum(shares) AS BIGINT) AS shares, sum(value) AS value
FROM holdings GROUP BY cik, symbol, date"""
CTES["filed"] = """
SELECT cik, date, sum(value) AS total, row_number() OVER (PARTITION BY cik ORDER BY date) AS no FROM pos GROUP BY cik, date"""
CTES["pos_no"] = "SELECT pos.*, no, total FROM pos JOIN filed USING (cik, date)"
CTES["qpx"] = 'SELECT symbol, date, sum(value) / sum(shares) AS px FROM pos GROUP BY 1, 2'
# the full outer self join over consecutive filings of a filer
CTES["paired"] = """
SELECT coalesce(n.cik, l.cik) AS cik, coalesce(n.symbol, l.symbol) AS symbol, coalesce(n.industry, l.industry) AS industry,
       coalesce(n.no, l.no + 1) AS no, n.shares AS ns, n.value AS nv, l.shares AS ls, l.value AS lv, l.total AS lt
FROM pos_no n FULL JOIN pos_no l ON n.cik = l.cik AND n.symbol = l.symbol AND n.no = l.no + 1"""
CTES["analytics_core"] = """
SELECT f.date, p.cik, p.symbol, industry, p.no, coalesce(ns, 0) AS "sharesNumber", coalesce(ls, 0) AS "lastSharesNumber",
       coalesce(nv, 0.0) AS "marketValue", coalesce(lv, 0.0) AS "lastMarketValue",
       coalesce(nv, 0.0) / f.total * 100 AS weight, coalesce(lv / lt * 100, 0.0) AS "lastWeight",
       coalesce(ns, 0) / outstanding * 100 AS ownership, coalesce(ls, 0) / outstanding * 100 AS "lastOwnership",
       px AS "quarterEndPrice", ls IS NULL AND p.no > 1 AS "isNew", ns IS NULL AS "isSoldOut",
       coalesce(ls, 0) * px - coalesce(lv, 0.0) AS performance
FROM paired p JOIN filed f ON p.cik = f.cik AND p.no = f.no
     LEFT JOIN qpx q ON p.symbol = q.symbol AND f.date = q.date LEFT JOIN outstanding o ON p.symbol = o.symbol"""


def _changes(c: str) -> str:
    cap = c[0].upper() + c[1:]
    return (
        f'"{c}" - "last{cap}" AS "changeIn{cap}", '
        f'("{c}" - "last{cap}") / nullif(abs("last{cap}"), 0) * 100 AS "changeIn{cap}Percentage"'
    )


CHANGED = ("weight", "marketValue", "sharesNumber", "ownership")
CTES["analytics"] = f"""
SELECT a.* EXCLUDE (no, starts), CAST(sum(CASE WHEN "isSoldOut" THEN 0 ELSE 1 END) OVER (PARTITION BY cik, symbol, starts ORDER BY date) AS BIGINT) AS "holdingPeriod",
       performance - "lastPerformance" AS "changeInPerformance"
FROM (SELECT *, {", ".join(_changes(c) for c in CHANGED)},
        performance / nullif("lastMarketValue", 0) * 100 AS "performancePercentage",
        min(CASE WHEN NOT "isSoldOut" THEN date END) OVER w AS "firstAdded",
        sum(CASE WHEN "lastSharesNumber" = 0 THEN 1 ELSE 0 END) OVER w AS starts,
        CASE WHEN lag(no) OVER w = no - 1 THEN lag(performance) OVER w END AS "lastPerformance"
      FROM analytics_core WINDOW w AS (PARTITION BY cik, symbol ORDER BY date)) a"""
A_R6 = (
    "weight lastWeight ownership lastOwnership quarterEndPrice changeInWeight changeInWeightPercentage "
    "changeInMarketValuePercentage changeInSharesNumberPercentage changeInOwnership changeInOwnershipPercentage performancePercentage"
)
A_R4 = "marketValue lastMarketValue changeInMarketValue"
A_PERF = "performance lastPerformance changeInPerformance"


def stored_positions(spark, sf):
    return materialize(J.positions(holdings(spark, sf)), "positions")


def analytics(spark, sf):
    return J.holder_analytics(stored_positions(spark, sf), outstanding(spark, sf))


def stored_analytics(spark, sf):
    """Analytics written once, for queries that read them several times."""
    return materialize(analytics(spark, sf), "analytics")


@query(
    "J1_filings_latest",
    """SELECT cik, date, max("filingDate") AS "filingDate", count(*) AS lines FROM holdings GROUP BY cik, date
ORDER BY "filingDate" DESC, cik, date LIMIT 100 OFFSET 100""",
)
def j1(spark, sf):
    filings = holdings(spark, sf).groupBy("cik", "date").agg(
        F.max("filingDate").alias("filingDate"), F.count("*").alias("lines")
    )
    return J.filings_latest(filings, 1, 100)


@query(
    "J2_filing_extract",
    """SELECT *, value / sum(value) OVER (PARTITION BY cik, date) * 100 AS weight FROM (
  SELECT cik, date, symbol, industry, "putCallShare", CAST(sum(shares) AS BIGINT) AS shares, sum(value) AS value
  FROM holdings GROUP BY ALL)""",
    r6="weight",
    r4="value",
)
def j2(spark, sf):
    return J.filing_extract(holdings(spark, sf))


@query(
    "J3_filing_dates",
    "SELECT DISTINCT cik, date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter FROM holdings",
)
def j3(spark, sf):
    return J.filing_dates(holdings(spark, sf))


@query("J4_holder_analytics", "SELECT * FROM analytics", r6=A_R6, r4=f"{A_R4} {A_PERF}")
def j4(spark, sf):
    return analytics(spark, sf)


CTES["held_ranked"] = """
SELECT *, row_number() OVER (PARTITION BY cik, date ORDER BY "marketValue" DESC, symbol) AS rn FROM analytics WHERE NOT "isSoldOut" """
CTES["perf_core"] = """
SELECT a.*, t10 AS "averageHoldingPeriodTop10", t20 AS "averageHoldingPeriodTop20",
       ("securitiesAdded" + "securitiesRemoved") / "portfolioSize" AS turnover,
       "marketValue" - "previousMarketValue" AS "changeInMarketValue",
       ("marketValue" - "previousMarketValue") / nullif(abs("previousMarketValue"), 0) * 100 AS "changeInMarketValuePercentage",
       performance / nullif("previousMarketValue", 0) * 100 AS "performancePercentage"
FROM (SELECT cik, date, count(*) FILTER (NOT "isSoldOut") AS "portfolioSize", count(*) FILTER ("isNew") AS "securitiesAdded",
             count(*) FILTER ("isSoldOut") AS "securitiesRemoved", sum("marketValue") AS "marketValue",
             sum("lastMarketValue") AS "previousMarketValue",
             avg("holdingPeriod") FILTER (NOT "isSoldOut") AS "averageHoldingPeriod", coalesce(sum(performance), 0.0) AS performance
      FROM analytics GROUP BY cik, date) a
LEFT JOIN (SELECT cik, date, avg("holdingPeriod") FILTER (rn <= 10) AS t10, avg("holdingPeriod") AS t20 FROM held_ranked WHERE rn <= 20 GROUP BY 1, 2) t
  ON a.cik = t.cik AND a.date = t.date"""
_SPANS = {"1year": "3 PRECEDING", "3year": "11 PRECEDING", "5year": "19 PRECEDING", "SinceInception": "UNBOUNDED PRECEDING"}


def _span(label: str, frame: str) -> str:
    over = f"OVER (PARTITION BY cik ORDER BY date ROWS {frame})"
    pct = "performanceSinceInceptionPercentage" if label == "SinceInception" else f"performancePercentage{label}"
    return (
        f'sum(performance) {over} AS "performance{label}", '
        f'(exp(sum(ln(1 + coalesce("performancePercentage", 0) / 100)) {over}) - 1) * 100 AS "{pct}"'
    )


CTES["perf"] = f"""
SELECT *, lag(performance) OVER (PARTITION BY cik ORDER BY date) AS "lastPerformance",
       performance - lag(performance) OVER (PARTITION BY cik ORDER BY date) AS "changeInPerformance",
       {", ".join(_span(k, v) for k, v in _SPANS.items())} FROM perf_core"""
CTES["market_quarters"] = """
SELECT date, sum(performance) / sum("lastMarketValue") * 100 AS bp FROM analytics GROUP BY date"""
P_R6 = (
    "turnover changeInMarketValuePercentage performancePercentage averageHoldingPeriod averageHoldingPeriodTop10 "
    "averageHoldingPeriodTop20 performancePercentage1year performancePercentage3year performancePercentage5year "
    "performanceSinceInceptionPercentage performanceRelativePercentage"
)
P_R4 = (
    "marketValue previousMarketValue changeInMarketValue performance lastPerformance changeInPerformance "
    "performance1year performance3year performance5year performanceSinceInception"
)


@query(
    "J5_holder_performance",
    """SELECT p.*, "performancePercentage" - bp AS "performanceRelativePercentage" FROM perf p LEFT JOIN market_quarters USING (date)""",
    r6=P_R6,
    r4=P_R4,
)
def j5(spark, sf):
    a = stored_analytics(spark, sf)
    market = a.groupBy("date").agg(
        (F.try_divide(F.sum("performance"), F.sum("lastMarketValue")) * 100).alias("benchmarkPercentage")
    )
    return J.holder_performance(a, market)


CTES["by_industry"] = """
SELECT *, weight - "lastWeight" AS "changeInWeight", (weight - "lastWeight") / nullif(abs("lastWeight"), 0) * 100 AS "changeInWeightPercentage",
       performance / nullif(lmv, 0) * 100 AS "performancePercentage", performance - "lastPerformance" AS "changeInPerformance"
FROM (SELECT cik, date, industry, sum(weight) AS weight, sum("lastWeight") AS "lastWeight", sum(performance) AS performance,
             sum("lastMarketValue") AS lmv, sum("lastPerformance") AS "lastPerformance" FROM analytics GROUP BY ALL)"""


@query(
    "J6_holder_industry",
    "SELECT * EXCLUDE (lmv) FROM by_industry",
    r6="weight lastWeight changeInWeight changeInWeightPercentage performancePercentage",
    r4="performance lastPerformance changeInPerformance",
)
def j6(spark, sf):
    return J.holder_industry(analytics(spark, sf))


MEASURES = [
    "investorsHolding", "numberOf13Fshares", "totalInvested", "ownershipPercent", "newPositions", "increasedPositions",
    "closedPositions", "reducedPositions", "totalCalls", "totalPuts", "putCallRatio",
]
CTES["symbol_positions"] = """
SELECT a.*, coalesce("totalCalls", 0) AS "totalCalls", coalesce("totalPuts", 0) AS "totalPuts", "totalPuts" / nullif("totalCalls", 0) AS "putCallRatio"
FROM (SELECT symbol, date, count(*) FILTER (NOT "isSoldOut") AS "investorsHolding", CAST(sum("sharesNumber") AS BIGINT) AS "numberOf13Fshares",
        sum("marketValue") AS "totalInvested", sum(ownership) AS "ownershipPercent", count(*) FILTER ("isNew") AS "newPositions",
        count(*) FILTER (NOT "isSoldOut" AND NOT "isNew" AND "lastSharesNumber" > 0 AND "changeInSharesNumber" > 0) AS "increasedPositions",
        count(*) FILTER ("isSoldOut") AS "closedPositions",
        count(*) FILTER (NOT "isSoldOut" AND NOT "isNew" AND "lastSharesNumber" > 0 AND "changeInSharesNumber" < 0) AS "reducedPositions"
      FROM analytics GROUP BY 1, 2) a
LEFT JOIN (SELECT symbol AS s, date AS d, CAST(coalesce(sum(shares) FILTER ("putCallShare" = 'Call'), 0) AS BIGINT) AS "totalCalls",
        CAST(coalesce(sum(shares) FILTER ("putCallShare" = 'Put'), 0) AS BIGINT) AS "totalPuts" FROM holdings GROUP BY 1, 2) ON symbol = s AND date = d"""


def _last(c: str) -> str:
    cap = c[0].upper() + c[1:]
    scale = " * 100" if c == "putCallRatio" else ""
    return f'lag("{c}") OVER w AS "last{cap}", ("{c}" - lag("{c}") OVER w){scale} AS "{c}Change"'


@query(
    "J7_positions_summary",
    f"""SELECT *, {", ".join(_last(c) for c in MEASURES)} FROM symbol_positions
WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
    r6="ownershipPercent lastOwnershipPercent ownershipPercentChange putCallRatio lastPutCallRatio putCallRatioChange",
    r4="totalInvested lastTotalInvested totalInvestedChange",
)
def j7(spark, sf):
    pos = stored_positions(spark, sf)
    return J.positions_summary(J.holder_analytics(pos, outstanding(spark, sf)), pos)


@query(
    "J8_industry_summary",
    """SELECT *, "industryValue" / sum("industryValue") OVER (PARTITION BY date) * 100 AS share FROM (
  SELECT date, industry AS "industryTitle", sum(value) AS "industryValue" FROM holdings GROUP BY ALL)""",
    r6="share",
    r4="industryValue",
)
def j8(spark, sf):
    return J.industry_summary(holdings(spark, sf))


@query(
    "J8_industry_rollup",
    'SELECT date, industry AS "industryTitle", sum(value) AS "industryValue" FROM holdings GROUP BY ROLLUP (date, industry)',
    r4="industryValue",
)
def j8r(spark, sf):
    return J.industry_rollup(holdings(spark, sf))


@query(
    "J9_compare_filers",
    """SELECT p.cik, p.date, "portfolioSize", "marketValue", p.performance, p."performancePercentage",
       arg_max(industry, (weight, industry)) AS "topIndustry", max(weight) AS "topIndustryWeight"
FROM perf p JOIN by_industry i ON p.cik = i.cik AND p.date = i.date
WHERE p.date = (SELECT max(date) FROM perf x WHERE x.cik = p.cik) GROUP BY 1, 2, 3, 4, 5, 6""",
    r6="performancePercentage topIndustryWeight",
    r4="marketValue performance",
)
def j9(spark, sf):
    a = stored_analytics(spark, sf)
    return J.compare_filers(J.holder_performance(a), J.holder_industry(a))


# The filters of every 13F query, one query each; a filter has to act on the finished rows and not on their past.

CTES["one_holder"] = "SELECT min(cik) AS cik FROM holdings"
CTES["one_symbol"] = "SELECT min(symbol) AS symbol FROM holdings"
YEAR, QUARTER = 1998, 2


def _first(spark, sf, column):
    return holdings(spark, sf).agg(F.min(column)).first()[0]


@query(
    "J2_filing_extract_filtered",
    f"""SELECT *, value / sum(value) OVER (PARTITION BY cik, date) * 100 AS weight FROM (
  SELECT cik, date, symbol, industry, "putCallShare", CAST(sum(shares) AS BIGINT) AS shares, sum(value) AS value
  FROM holdings WHERE cik = (SELECT cik FROM one_holder) AND year(date) = {YEAR} AND quarter(date) = {QUARTER} GROUP BY ALL)""",
    r6="weight",
    r4="value",
)
def j2f(spark, sf):
    return J.filing_extract(holdings(spark, sf), _first(spark, sf, "cik"), YEAR, QUARTER)


@query(
    "J3_filing_dates_of_one",
    """SELECT DISTINCT cik, date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter
FROM holdings WHERE cik = (SELECT cik FROM one_holder)""",
)
def j3f(spark, sf):
    return J.filing_dates(holdings(spark, sf), _first(spark, sf, "cik"))


@query(
    "J4_holder_analytics_filtered",
    f"SELECT * FROM analytics WHERE year(date) = {YEAR} AND quarter(date) = {QUARTER} AND symbol = (SELECT symbol FROM one_symbol)",
    r6=A_R6,
    r4=f"{A_R4} {A_PERF}",
)
def j4f(spark, sf):
    return J.holder_analytics(stored_positions(spark, sf), outstanding(spark, sf), _first(spark, sf, "symbol"), YEAR, QUARTER)


@query(
    "J4_holder_analytics_page",
    f'SELECT * FROM analytics WHERE year(date) = {YEAR} ORDER BY date DESC, "marketValue" DESC, cik, symbol LIMIT 50 OFFSET 50',
    r6=A_R6,
    r4=f"{A_R4} {A_PERF}",
)
def j4p(spark, sf):
    return J.holder_analytics(stored_positions(spark, sf), outstanding(spark, sf), year=YEAR, page=1, limit=50)


@query(
    "J5_holder_performance_of_one",
    "SELECT * FROM perf WHERE cik = (SELECT cik FROM one_holder)",
    r6=P_R6.replace(" performanceRelativePercentage", ""),
    r4=P_R4,
)
def j5f(spark, sf):
    return J.holder_performance(stored_analytics(spark, sf), cik=_first(spark, sf, "cik"))


@query(
    "J6_holder_industry_filtered",
    f"SELECT * EXCLUDE (lmv) FROM by_industry WHERE cik = (SELECT cik FROM one_holder) AND year(date) = {YEAR} AND quarter(date) = {QUARTER}",
    r6="weight lastWeight changeInWeight changeInWeightPercentage performancePercentage",
    r4="performance lastPerformance changeInPerformance",
)
def j6f(spark, sf):
    return J.holder_industry(analytics(spark, sf), _first(spark, sf, "cik"), YEAR, QUARTER)


@query(
    "J7_positions_summary_filtered",
    f"""SELECT * FROM (SELECT *, {", ".join(_last(c) for c in MEASURES)} FROM symbol_positions WINDOW w AS (PARTITION BY symbol ORDER BY date))
WHERE symbol = (SELECT symbol FROM one_symbol) AND year(date) = {YEAR} AND quarter(date) = {QUARTER}""",
    r6="ownershipPercent lastOwnershipPercent ownershipPercentChange putCallRatio lastPutCallRatio putCallRatioChange",
    r4="totalInvested lastTotalInvested totalInvestedChange",
)
def j7f(spark, sf):
    pos = stored_positions(spark, sf)
    return J.positions_summary(J.holder_analytics(pos, outstanding(spark, sf)), pos, _first(spark, sf, "symbol"), YEAR, QUARTER)


@query(
    "J8_industry_summary_filtered",
    f"""SELECT *, "industryValue" / sum("industryValue") OVER (PARTITION BY date) * 100 AS share FROM (
  SELECT date, industry AS "industryTitle", sum(value) AS "industryValue" FROM holdings WHERE year(date) = {YEAR} AND quarter(date) = {QUARTER} GROUP BY ALL)""",
    r6="share",
    r4="industryValue",
)
def j8f(spark, sf):
    return J.industry_summary(holdings(spark, sf), YEAR, QUARTER)

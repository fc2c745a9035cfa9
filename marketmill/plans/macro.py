"""N: macro series, trader positions, news."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import macro as N
from marketmill.operators import search as C
from marketmill.operators import news as W

from .registry import CTES, query
from .tables import cot, macro, news, table

#: The five event types stand for five tenors.
TENOR_OF = {"click": "year2", "error": "year5", "purchase": "year10", "signup": "year20", "view": "year30"}
_TENOR_SQL = "CASE name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TENOR_OF.items()) + " END"
CTES["rates"] = f"SELECT date, {_TENOR_SQL} AS tenor, value AS rate FROM macro"
CTES["curve"] = (
    "SELECT date, " + ", ".join(f"max(rate) FILTER (tenor = '{t}') AS {t}" for t in N.TENORS) + " FROM rates GROUP BY date"
)


def rates(spark, sf):
    tenor = F.lit(None).cast("string")
    for k, v in TENOR_OF.items():
        tenor = F.when(F.col("name") == k, v).otherwise(tenor)
    return macro(spark, sf).select("date", tenor.alias("tenor"), F.col("value").alias("rate"))


@query("N1_treasury", "SELECT * FROM curve WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'", r6=" ".join(N.TENORS))
def n1(spark, sf):
    return N.treasury(rates(spark, sf), "2024-01-03", "2024-01-28")


@query(
    "N1_curve_spreads",
    """SELECT *, year10 - year2 AS spread2to10, year30 - year10 AS spread10to30,
       CASE WHEN year10 > year2 THEN 'Normal' WHEN year10 < year2 THEN 'Inverted' WHEN year10 = year2 THEN 'Flat' END AS shape FROM curve""",
    r6=" ".join(N.TENORS) + " spread2to10 spread10to30",
)
def n1s(spark, sf):
    return N.curve_spreads(N.treasury(rates(spark, sf)))


@query("N1_curve_long", "SELECT date, tenor, rate FROM rates", r6="rate")
def n1l(spark, sf):
    return N.curve_long(N.treasury(rates(spark, sf)))


@query("N2_indicator", "SELECT * FROM macro WHERE name = 'purchase' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'", r6="value")
def n2(spark, sf):
    return N.indicator(macro(spark, sf), "purchase", "2024-01-05", "2024-01-25")


@query(
    "N2_indicator_trend",
    """SELECT name, count(*) AS records, arg_min(value, date) AS first, arg_max(value, date) AS last,
       (arg_max(value, date) - arg_min(value, date)) / arg_min(value, date) * 100 AS "changePercent" FROM macro GROUP BY 1""",
    r6="first last changePercent",
)
def n2t(spark, sf):
    return N.indicator_trend(macro(spark, sf))


CTES["releases"] = """
SELECT name AS event, date, value AS actual, lag(value) OVER (PARTITION BY name ORDER BY date) AS previous FROM macro"""


def releases(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("name").orderBy("date")
    return macro(spark, sf).select(
        F.col("name").alias("event"), "date", F.col("value").alias("actual"), F.lag("value").over(w).alias("previous")
    )


@query(
    "N3_economic_calendar",
    """SELECT *, actual - previous AS change, (actual - previous) / nullif(abs(previous), 0) * 100 AS "changePercentage" FROM releases
WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-20'""",
    r6="actual previous change changePercentage",
)
def n3(spark, sf):
    return N.economic_calendar(releases(spark, sf), "2024-01-01", "2024-01-20")


CTES["premiums"] = """
SELECT n_name AS country, r_name AS continent, p AS "countryRiskPremium", p + 4.6 AS "totalEquityRiskPremium" FROM (
  SELECT n_name, r_name, avg(c_acctbal) / 1000 AS p FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)"""


def premiums(spark, sf):
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    p = (F.avg("c_acctbal") / 1000).alias("countryRiskPremium")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy(F.col("n_name").alias("country"), F.col("r_name").alias("continent")).agg(p).withColumn(
        "totalEquityRiskPremium", F.col("countryRiskPremium") + 4.6
    )


PREMIUM = "countryRiskPremium totalEquityRiskPremium"


@query("N4_risk_premium", "SELECT * FROM premiums", r6=PREMIUM)
def n4(spark, sf):
    return N.risk_premium(premiums(spark, sf))


@query(
    "N4_risk_premium_continent",
    """SELECT continent, count(*) AS countries, avg("countryRiskPremium") AS "countryRiskPremium", avg("totalEquityRiskPremium") AS "totalEquityRiskPremium"
FROM premiums GROUP BY 1""",
    r6=PREMIUM,
)
def n4c(spark, sf):
    return N.risk_premium_by_continent(premiums(spark, sf))


_SUMS = ", ".join(
    f"CAST(coalesce(sum(contracts) FILTER (class = '{c}' AND side = '{s}'), 0) AS BIGINT) AS \"{k}\"" for k, (c, s) in N.POSITIONS.items()
)
CTES["cot_core"] = f"""
SELECT *, "totReptPositionsLongAll" + "nonreptPositionsLongAll" AS "openInterestAll" FROM (
  SELECT *, "noncommPositionsLongAll" + "noncommPositionsSpreadAll" + "commPositionsLongAll" AS "totReptPositionsLongAll",
         "noncommPositionsShortAll" + "noncommPositionsSpreadAll" + "commPositionsShortAll" AS "totReptPositionsShortAll"
  FROM (SELECT symbol, date, {_SUMS} FROM cot GROUP BY 1, 2))"""
_MEASURES = [*N.POSITIONS, "totReptPositionsLongAll", "totReptPositionsShortAll", "openInterestAll"]
_CHANGES = ", ".join(f'"{m}" - lag("{m}") OVER w AS "changeIn{m[0].upper()}{m[1:]}"' for m in _MEASURES)
_PCT = ", ".join(f'"{m}" / nullif("openInterestAll", 0) * 100 AS "pctOfOi{m[0].upper()}{m[1:]}"' for m in N.POSITIONS)


@query(
    "N5_cot_report",
    f"""SELECT * FROM (SELECT *, {_CHANGES}, {_PCT} FROM cot_core WINDOW w AS (PARTITION BY symbol ORDER BY date))
WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
    r6=" ".join(f"pctOfOi{m[0].upper()}{m[1:]}" for m in N.POSITIONS),
)
def n5(spark, sf):
    return N.cot_report(cot(spark, sf), lo="1996-01-01", hi="1999-12-31")


@query("C9_universe_cot", "SELECT DISTINCT symbol FROM cot_core")
def c9_cot(spark, sf):
    return C.universe(cot(spark, sf), ["symbol"])


@query(
    "N6_cot_analysis",
    """SELECT *, ("netPosition" - "previousNetPosition") / nullif(abs("previousNetPosition"), 0) * 100 AS "changeInNetPosition",
       CASE WHEN "marketSituation" = 'Bullish' AND "netPosition" > "previousNetPosition" THEN 'Increasing Bullish'
            WHEN "marketSituation" = 'Bullish' AND "netPosition" < "previousNetPosition" THEN 'Decreasing Bullish'
            WHEN "marketSituation" = 'Bearish' AND "netPosition" < "previousNetPosition" THEN 'Increasing Bearish'
            WHEN "marketSituation" = 'Bearish' AND "netPosition" > "previousNetPosition" THEN 'Decreasing Bearish' END AS "marketSentiment",
       "marketSituation" <> "previousMarketSituation" AS "reversalTrend"
FROM (SELECT *, lag("currentLongMarketSituation") OVER w AS "previousLongMarketSituation", lag("currentShortMarketSituation") OVER w AS "previousShortMarketSituation",
        lag("marketSituation") OVER w AS "previousMarketSituation", lag("netPosition") OVER w AS "previousNetPosition"
      FROM (SELECT *, CASE WHEN "currentLongMarketSituation" > "currentShortMarketSituation" THEN 'Bullish'
                           WHEN "currentLongMarketSituation" IS NOT NULL THEN 'Bearish' END AS "marketSituation"
            FROM (SELECT symbol, date, l / nullif(l + s, 0) * 100 AS "currentLongMarketSituation", s / nullif(l + s, 0) * 100 AS "currentShortMarketSituation",
                         l - s AS "netPosition" FROM (SELECT symbol, date, "noncommPositionsLongAll" AS l, "noncommPositionsShortAll" AS s FROM cot_core)))
      WINDOW w AS (PARTITION BY symbol ORDER BY date))""",
    r6="currentLongMarketSituation currentShortMarketSituation previousLongMarketSituation previousShortMarketSituation changeInNetPosition",
)
def n6(spark, sf):
    return N.cot_analysis(N.cot_report(cot(spark, sf)))


def _feed(variant: str) -> None:
    @query(
        f"N7_news_{variant}",
        f"""SELECT * FROM news WHERE variant = '{variant}' AND "publishedDate" BETWEEN DATE '2024-02-01' AND DATE '2024-11-30'
ORDER BY "publishedDate" DESC, id LIMIT 20 OFFSET 20""",
    )
    def run(spark, sf):
        return W.news(news(spark, sf), variant, 1, 20, "2024-02-01", "2024-11-30")


for _v in ("en", "de", "fr", "es"):
    _feed(_v)


@query(
    "N8_news_search",
    """SELECT * FROM news WHERE list_has_any(string_split(symbols, ','), ['S7', 'S14', 'S140'])""",
)
def n8(spark, sf):
    return W.news_search(news(spark, sf), "S7, S14,S140")


@query(
    "N8_news_for_watchlist",
    """SELECT DISTINCT id, "publishedDate", site, variant, symbols, title, symbol FROM (SELECT *, unnest(string_split(symbols, ',')) AS symbol FROM news)
WHERE symbol IN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier)""",
)
def n8w(spark, sf):
    watch = table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"))
    return W.news_for(news(spark, sf), watch).drop("text")

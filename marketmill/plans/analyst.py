"""I: analyst data over the ``grades`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import analyst as A
from marketmill.operators import statements as S

from . import statements as _statements  # noqa: F401  (its sub-queries are used below)
from .registry import CTES, query
from .tables import grades, stmt


def _estimates(period: str, end: str) -> None:
    @query(
        f"I1_estimates_{period}",
        f"""SELECT symbol, {end} AS date, avg("priceTarget") AS "revenueAvg", min("priceTarget") AS "revenueLow", max("priceTarget") AS "revenueHigh",
       count(DISTINCT "gradingCompany") AS "numAnalystsRevenue" FROM grades GROUP BY 1, 2""",
        r4="revenueAvg",
    )
    def run(spark, sf):
        return A.estimates(grades(spark, sf), period)


_estimates("annual", "CAST(make_date(year(date), 12, 31) AS DATE)")
_estimates("quarter", "CAST(last_day(date_trunc('quarter', date) + INTERVAL 2 MONTH) AS DATE)")

#: Lower bounds of scores 2 to 5 for every component.
CUTS = {
    "grossProfitMargin": (0.45, 0.55, 0.60, 0.65),
    "ebitMargin": (0.40, 0.50, 0.55, 0.60),
    "netProfitMargin": (0.35, 0.45, 0.50, 0.55),
}
COMPONENTS = tuple(CUTS)
CTES["margins"] = """
SELECT symbol, date, "grossProfit" / revenue AS "grossProfitMargin", ebit / revenue AS "ebitMargin", "netIncome" / revenue AS "netProfitMargin" FROM st_annual"""


def _score(c: str) -> str:
    above = " + ".join(f'(CASE WHEN "{c}" > {x} THEN 1 ELSE 0 END)' for x in CUTS[c])
    return f'CAST(1 + {above} AS INTEGER) AS "{c}Score"'


CTES["rating_rows"] = f"""
SELECT *, ({" + ".join(f'"{c}Score"' for c in COMPONENTS)}) / {len(COMPONENTS)} AS "overallScore" FROM (
  SELECT symbol, date, {", ".join(_score(c) for c in COMPONENTS)} FROM margins)"""


def history(spark, sf):
    return A.ratings(S.ratios(S.statements(stmt(spark, sf))), CUTS)


@query("I2_ratings_history", "SELECT * FROM rating_rows", r6="overallScore")
def i2(spark, sf):
    return history(spark, sf)


@query("I2_ratings_snapshot", "SELECT * FROM rating_rows QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1", r6="overallScore")
def i2s(spark, sf):
    return A.ratings_snapshot(history(spark, sf))


_SPANS = {"lastMonth": 1, "lastQuarter": 3, "lastYear": 12}
_AS_OF = "DATE '2001-08-01'"


@query(
    "I3_target_summary",
    "SELECT symbol, "
    + ", ".join(
        f"""count(*) FILTER (date > {_AS_OF} - INTERVAL {m} MONTH) AS "{n}Count",
        avg("priceTarget") FILTER (date > {_AS_OF} - INTERVAL {m} MONTH) AS "{n}AvgPriceTarget" """
        for n, m in _SPANS.items()
    )
    + f""", count(*) AS "allTimeCount", avg("priceTarget") AS "allTimeAvgPriceTarget" FROM grades WHERE date <= {_AS_OF} GROUP BY 1""",
    r4="lastMonthAvgPriceTarget lastQuarterAvgPriceTarget lastYearAvgPriceTarget allTimeAvgPriceTarget",
)
def i3(spark, sf):
    return A.target_summary(grades(spark, sf), "2001-08-01")


@query(
    "I4_target_consensus",
    """SELECT symbol, max("priceTarget") AS "targetHigh", min("priceTarget") AS "targetLow", avg("priceTarget") AS "targetConsensus",
       median("priceTarget") AS "targetMedian" FROM grades GROUP BY 1""",
    r4="targetConsensus targetMedian",
)
def i4(spark, sf):
    return A.target_consensus(grades(spark, sf))


def latest():
    return [F.desc("date"), F.asc("id")]


@query("I5_target_news_latest", "SELECT * FROM grades ORDER BY date DESC, id LIMIT 100 OFFSET 200")
def i5(spark, sf):
    return A.symbol_news(grades(spark, sf), latest(), page=2)


@query("I5_target_news_deep", "SELECT * FROM grades ORDER BY date DESC, id LIMIT 100 OFFSET 12000")
def i5d(spark, sf):
    return A.symbol_news(grades(spark, sf), latest(), page=120)


@query("I5_target_news_symbol", "SELECT * FROM grades WHERE symbol = '77' ORDER BY date DESC, id LIMIT 100")
def i5s(spark, sf):
    return A.symbol_news(grades(spark, sf), latest(), "77")


RANK = "CASE {} WHEN 'strongBuy' THEN 0 WHEN 'buy' THEN 1 WHEN 'hold' THEN 2 WHEN 'sell' THEN 3 WHEN 'strongSell' THEN 4 END"
CTES["graded"] = f"""
SELECT symbol, date, "gradingCompany", "previousGrade", "newGrade", CASE WHEN "previousGrade" IS NULL THEN 'initialise'
       WHEN {RANK.format('"newGrade"')} < {RANK.format('"previousGrade"')} THEN 'upgrade'
       WHEN {RANK.format('"newGrade"')} > {RANK.format('"previousGrade"')} THEN 'downgrade' ELSE 'maintain' END AS action, id
FROM (SELECT *, lag("newGrade") OVER (PARTITION BY symbol, "gradingCompany" ORDER BY date, id) AS "previousGrade" FROM grades)"""


@query("I6_grades", "SELECT * FROM graded")
def i6(spark, sf):
    return A.grades(grades(spark, sf))


CTES["months"] = "SELECT DISTINCT symbol, last_day(date) AS m FROM grades"
CTES["standing"] = """
SELECT m.symbol, m.m AS date, g."gradingCompany", arg_max(g."newGrade", (g.date, g.id)) AS grade
FROM months m JOIN grades g ON g.symbol = m.symbol AND g.date <= m.m GROUP BY 1, 2, 3"""


def _count(col: str) -> str:
    return ", ".join(f"count(*) FILTER ({col} = '{g}') AS \"{g}\"" for g in A.GRADES)


@query("I7_grades_history", f"SELECT symbol, date, {_count('grade')} FROM standing GROUP BY 1, 2")
def i7(spark, sf):
    return A.grades_history(grades(spark, sf))


CTES["grade_counts"] = f"""
SELECT symbol, {_count('"newGrade"')} FROM (
  SELECT * FROM grades QUALIFY row_number() OVER (PARTITION BY symbol, "gradingCompany" ORDER BY date DESC, id DESC) = 1) GROUP BY 1"""
_TOP = "greatest(" + ", ".join(f'"{g}"' for g in A.GRADES) + ")"


@query(
    "I8_grades_consensus",
    "SELECT *, CASE "
    + " ".join(f"WHEN \"{g}\" = {_TOP} THEN '{A.LABELS[g]}'" for g in A.GRADES)
    + """ END AS consensus, ("strongBuy" + buy) / ("strongBuy" + buy + hold + sell + "strongSell") * 100 AS "buyPercent" FROM grade_counts""",
    r6="buyPercent",
)
def i8(spark, sf):
    return A.grades_consensus(grades(spark, sf))


@query("I9_grade_news_latest", "SELECT * FROM graded ORDER BY date DESC, id LIMIT 100")
def i9(spark, sf):
    return A.grade_news(grades(spark, sf), latest())


@query("I9_grade_news_deep", "SELECT * FROM graded ORDER BY date DESC, id LIMIT 100 OFFSET 12000")
def i9d(spark, sf):
    return A.grade_news(grades(spark, sf), latest(), page=120)


@query("I9_grade_news_symbol", "SELECT * FROM graded WHERE symbol = '77' ORDER BY date DESC, id LIMIT 100")
def i9s(spark, sf):
    return A.grade_news(grades(spark, sf), latest(), "77")

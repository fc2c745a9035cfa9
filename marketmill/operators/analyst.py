"""Estimates, ratings, price targets and grades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.scalars import ratio
from marketmill.functions.windows import (
    exact_median, first_per_key, join_on, page as take_page, previous_value, top_n_per_key,
)

#: Grades from the strongest to the weakest.
GRADES = ("strongBuy", "buy", "hold", "sell", "strongSell")
#: Labels of the consensus, in the order of the grades.
LABELS = {"strongBuy": "Strong Buy", "buy": "Buy", "hold": "Hold", "sell": "Sell", "strongSell": "Strong Sell"}


def estimates(
    df: DataFrame, period: str = "annual", page: int | None = None, limit: int | None = None
) -> DataFrame:
    """Average, low, high and number of analysts per symbol and fiscal date."""
    end = F.make_date(F.year("date"), F.lit(12), F.lit(31))
    if period == "quarter":
        end = F.last_day(F.add_months(F.trunc("date", "quarter"), 2))
    # one row per analyst first, so that counting analysts is a plain count
    per = df.groupBy("symbol", end.alias("fiscalDate"), "gradingCompany").agg(
        F.sum("priceTarget").alias("s"), F.count("priceTarget").alias("n"),
        F.min("priceTarget").alias("lo"), F.max("priceTarget").alias("hi"),
    )
    out = per.groupBy("symbol", F.col("fiscalDate").alias("date")).agg(
        ratio(F.sum("s"), F.sum("n")).alias("revenueAvg"),
        F.min("lo").alias("revenueLow"),
        F.max("hi").alias("revenueHigh"),
        F.count("*").alias("numAnalystsRevenue"),
    )
    if page is None and limit is None:
        return out
    return take_page(out, [F.desc("date")], page, limit, partition=["symbol"])


def ratings(scores: DataFrame, cuts: dict[str, Sequence[float]]) -> DataFrame:
    """Rating history: every component scored 1 to 5 by its cut points, and their average.

    ``cuts`` gives the lower bounds of scores 2 to 5 per component. A missing
    component scores 1.
    """

    def score(c: str) -> Column:
        above = sum((F.coalesce(F.col(c) > x, F.lit(False)).cast("int") for x in cuts[c]), F.lit(0))
        return (above + 1).cast("int")

    out = scores.select("symbol", "date", *[score(c).alias(f"{c}Score") for c in cuts])
    overall = sum((F.col(f"{c}Score") for c in cuts), F.lit(0)) / len(cuts)
    return out.withColumn("overallScore", overall)


def ratings_snapshot(history: DataFrame, limit: int = 1) -> DataFrame:
    """The newest ratings of every symbol."""
    return top_n_per_key(history, ["symbol"], [F.desc("date")], limit)


def target_summary(targets: DataFrame, as_of: str) -> DataFrame:
    """Counts and averages of price targets over the last month, quarter, year and all time."""
    end = F.lit(as_of).cast("date")
    spans = {"lastMonth": -1, "lastQuarter": -3, "lastYear": -12}
    upto = targets.filter(F.col("date") <= end)
    aggs = []
    for name, months in spans.items():
        inside = F.col("date") > F.add_months(end, months)
        aggs += [
            F.count_if(inside).alias(f"{name}Count"),
            F.avg(F.when(inside, F.col("priceTarget"))).alias(f"{name}AvgPriceTarget"),
        ]
    return upto.groupBy("symbol").agg(
        *aggs, F.count("*").alias("allTimeCount"), F.avg("priceTarget").alias("allTimeAvgPriceTarget")
    )


def target_consensus(targets: DataFrame) -> DataFrame:
    """High, low, mean and exact median price target."""
    ends = targets.groupBy("symbol").agg(
        F.max("priceTarget").alias("targetHigh"),
        F.min("priceTarget").alias("targetLow"),
        F.avg("priceTarget").alias("targetConsensus"),
    )
    return join_on(ends, exact_median(targets, ["symbol"], "priceTarget", "targetMedian"), ["symbol"], "left")


def symbol_news(
    df: DataFrame, order: Sequence[Column], symbol: str | None = None, page: int | None = 0, limit: int | None = 100
) -> DataFrame:
    """Target or grade news, of one symbol or of all, by descending date and what else ``order`` says."""
    d = df if symbol is None else df.filter(F.col("symbol") == symbol)
    return take_page(d, order, page, limit, band="date")


def _rank(c: Column) -> Column:
    out = F.lit(None).cast("int")
    for i, g in enumerate(GRADES):
        out = F.when(c == g, F.lit(i)).otherwise(out)
    return out


def grades(df: DataFrame) -> DataFrame:
    """Grade events with the firm's previous grade and the action."""
    out = previous_value(df, ["symbol", "gradingCompany"], "date", "id", "newGrade", "previousGrade")
    new, old = _rank(F.col("newGrade")), _rank(F.col("previousGrade"))
    action = (
        F.when(old.isNull(), "initialise").when(new < old, "upgrade").when(new > old, "downgrade").otherwise("maintain")
    )
    return out.select("symbol", "date", "gradingCompany", "previousGrade", "newGrade", action.alias("action"), "id")


def grade_news(
    df: DataFrame, order: Sequence[Column], symbol: str | None = None, page: int | None = 0, limit: int | None = 100
) -> DataFrame:
    """One page of grade events with previous grades, which are looked up for the firms and symbols of the page only."""
    firm = ["symbol", "gradingCompany"]
    rows = symbol_news(df, order, symbol, page, limit)
    history = join_on(df, rows.select(*firm).distinct(), firm, "left_semi")
    return join_on(grades(history), rows.select(*firm, "date", "id").distinct(), [*firm, "date", "id"], "left_semi").orderBy(*order)


def _counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = [F.count_if(F.col("newGrade") == g).alias(g) for g in GRADES]
    return df.groupBy(*keys).agg(*counts)


def grades_history(df: DataFrame, limit: int | None = None) -> DataFrame:
    """How many firms stood at each grade at the end of every month with a change.

    A firm's last grade of a month holds until its next one. Each grade is
    counted as +1 in its month and -1 in the month it is replaced, and the running
    sum over the months of a symbol gives the standing.
    """
    month = F.last_day("date")
    firm = ["symbol", "gradingCompany"]
    last = first_per_key(df.withColumn("month", month), [*firm, "month"], [F.desc("date"), F.desc("id")])
    w = Window.partitionBy(*firm).orderBy("month")
    held = last.select(*firm, "month", "newGrade", F.lead("month").over(w).alias("until"))
    plus = held.select("symbol", "month", "newGrade", F.lit(1).alias("d"))
    minus = held.filter("until is not null").select("symbol", F.col("until").alias("month"), "newGrade", F.lit(-1).alias("d"))
    moves = plus.unionByName(minus).groupBy("symbol", "month").agg(
        *[F.sum(F.when(F.col("newGrade") == g, F.col("d")).otherwise(0)).alias(g) for g in GRADES]
    )
    run = Window.partitionBy("symbol").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    out = moves.select("symbol", F.col("month").alias("date"), *[F.sum(g).over(run).alias(g) for g in GRADES])
    return out if limit is None else top_n_per_key(out, ["symbol"], [F.desc("date")], limit)


def grades_consensus(df: DataFrame) -> DataFrame:
    """Latest grade of every firm counted per symbol, with label and buy percent.

    The label is the most frequent grade; a tie goes to the stronger one.
    """
    last = first_per_key(df, ["symbol", "gradingCompany"], [F.desc("date"), F.desc("id")])
    out = _counts(last, ["symbol"])
    most = F.greatest(*GRADES)
    label = F.lit(None).cast("string")
    for g in reversed(GRADES):
        label = F.when(F.col(g) == most, LABELS[g]).otherwise(label)
    total = sum((F.col(g) for g in GRADES), F.lit(0))
    return out.withColumns(
        {"consensus": label, "buyPercent": ratio(F.col("strongBuy") + F.col("buy"), total) * 100}
    )

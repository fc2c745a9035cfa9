"""Financial statements, ratios, scores and growth.

The input is one row of line items per symbol and quarter, already summed from
the raw postings, so a symbol has at most four rows a year. All three
statements come out of one frame (:func:`statements`): one shuffle by symbol
instead of joins between statements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.scalars import pct_change, ratio
from marketmill.functions.windows import asof_last, top_n_per_key

#: Item names. Items that flow during a period. Capital expenditure is negative.
FLOWS = (
    "revenue", "costOfRevenue", "operatingExpenses", "incomeTaxExpense", "depreciation", "capitalExpenditure",
    "changeInReceivables", "changeInInventories", "changeInPayables", "changeInDebt",
)
INCOME = (
    "revenue", "costOfRevenue", "grossProfit", "operatingExpenses", "ebit", "depreciation", "ebitda", "incomeTaxExpense",
    "netIncome",
)
BALANCE = (
    "cashAndCashEquivalents", "netReceivables", "inventory", "totalCurrentAssets", "propertyPlantEquipment", "totalAssets",
    "accountPayables", "totalDebt", "totalLiabilities", "retainedEarnings", "totalStockholdersEquity",
)
CASH_FLOW = (
    "netIncome", "depreciation", "changeInWorkingCapital", "operatingCashFlow", "capitalExpenditure", "investingCashFlow",
    "financingCashFlow", "freeCashFlow",
)
_ID = ("symbol", "date", "fiscalYear", "period")


def statements(items: DataFrame, period: str = "annual") -> DataFrame:
    """Income statement, balance sheet and cash flow of every fiscal period in one row.

    Balance positions are running sums of the flows to the period end.
    """
    year = F.year("date")
    if period == "annual":
        flows = items.groupBy("symbol", year.alias("y")).agg(*[F.sum(c).alias(c) for c in FLOWS])
        flows = flows.withColumns({"date": F.make_date("y", F.lit(12), F.lit(31)), "period": F.lit("FY")})
    elif period == "quarter":
        flows = items.groupBy("symbol", "date").agg(*[F.sum(c).alias(c) for c in FLOWS])
        flows = flows.withColumns({"y": year, "period": F.concat(F.lit("Q"), F.quarter("date").cast("string"))})
    else:
        raise ValueError("period must be annual or quarter")
    c = F.col
    f = flows.withColumn("fiscalYear", c("y").cast("string")).withColumns(
        {
            "grossProfit": c("revenue") - c("costOfRevenue"),
            "ebit": c("revenue") - c("costOfRevenue") - c("operatingExpenses"),
        }
    )
    working = c("changeInReceivables") + c("changeInInventories") - c("changeInPayables")
    f = f.withColumns(
        {
            "ebitda": c("ebit") + c("depreciation"),
            "netIncome": c("ebit") - c("incomeTaxExpense"),
            "changeInWorkingCapital": -working,
            "investingCashFlow": c("capitalExpenditure"),
            "financingCashFlow": c("changeInDebt"),
        }
    )
    f = f.withColumn("operatingCashFlow", c("netIncome") + c("depreciation") + c("changeInWorkingCapital"))
    f = f.withColumn("freeCashFlow", c("operatingCashFlow") + c("capitalExpenditure"))
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)

    def running(x: Column) -> Column:
        return F.sum(x).over(w)

    f = f.withColumns(
        {
            "cashAndCashEquivalents": running(c("freeCashFlow") + c("financingCashFlow")),
            "netReceivables": running(c("changeInReceivables")),
            "inventory": running(c("changeInInventories")),
            "propertyPlantEquipment": running(-c("capitalExpenditure") - c("depreciation")),
            "accountPayables": running(c("changeInPayables")),
            "totalDebt": running(c("changeInDebt")),
            "retainedEarnings": running(c("netIncome")),
        }
    )
    f = f.withColumns(
        {
            "totalCurrentAssets": c("cashAndCashEquivalents") + c("netReceivables") + c("inventory"),
            "totalLiabilities": c("accountPayables") + c("totalDebt"),
        }
    )
    f = f.withColumn("totalAssets", c("totalCurrentAssets") + c("propertyPlantEquipment"))
    f = f.withColumn("totalStockholdersEquity", c("totalAssets") - c("totalLiabilities"))
    return f.select(*_ID, *dict.fromkeys((*INCOME, *BALANCE, *CASH_FLOW)))


def newest(st: DataFrame, limit: int | None) -> DataFrame:
    """The newest ``limit`` periods of every symbol."""
    return st if limit is None else top_n_per_key(st, ["symbol"], [F.desc("date")], limit)


def income_statement(items: DataFrame, period: str = "annual", limit: int | None = None) -> DataFrame:
    return newest(statements(items, period).select(*_ID, *INCOME), limit)


def balance_sheet(items: DataFrame, period: str = "annual", limit: int | None = None) -> DataFrame:
    return newest(statements(items, period).select(*_ID, *BALANCE), limit)


def cash_flow(items: DataFrame, period: str = "annual", limit: int | None = None) -> DataFrame:
    return newest(statements(items, period).select(*_ID, *CASH_FLOW), limit)


def priced(st: DataFrame, px: DataFrame) -> DataFrame:
    """Statements with the price and share count known at the period end.

    ``px`` is a history (symbol, date, price, shares).
    """
    hist = px.select("symbol", F.col("date").alias("px_date"), "price", "shares")
    return asof_last(st, hist, ["symbol"], "date", "px_date", ["price", "shares"]).withColumn(
        "marketCap", F.col("price") * F.col("shares")
    )


def enterprise_values(st: DataFrame, px: DataFrame) -> DataFrame:
    """Market cap plus debt minus cash."""
    p = priced(st, px)
    return p.select(
        "symbol", "date", F.col("price").alias("stockPrice"), F.col("shares").alias("numberOfShares"),
        F.col("marketCap").alias("marketCapitalization"),
        (F.col("marketCap") + F.col("totalDebt") - F.col("cashAndCashEquivalents")).alias("enterpriseValue"),
    )


def key_metrics(st: DataFrame, px: DataFrame) -> DataFrame:
    p = priced(st, px)
    ev = F.col("marketCap") + F.col("totalDebt") - F.col("cashAndCashEquivalents")
    return p.select(
        *_ID, "marketCap", ev.alias("enterpriseValue"), ratio(ev, F.col("revenue")).alias("evToSales"),
        ratio(F.col("totalCurrentAssets"), F.col("accountPayables")).alias("currentRatio"),
        ratio(F.col("netIncome"), F.col("totalStockholdersEquity")).alias("returnOnEquity"),
    )


def ratios(st: DataFrame) -> DataFrame:
    c = F.col
    return st.select(
        *_ID, ratio(c("grossProfit"), c("revenue")).alias("grossProfitMargin"),
        ratio(c("ebit"), c("revenue")).alias("ebitMargin"), ratio(c("netIncome"), c("revenue")).alias("netProfitMargin"),
        ratio(c("totalCurrentAssets"), c("accountPayables")).alias("currentRatio"),
        ratio(c("totalDebt"), c("totalStockholdersEquity")).alias("debtToEquityRatio"),
    )


def scores(st: DataFrame, px: DataFrame) -> DataFrame:
    """Altman Z (the public 1968 weights) and Piotroski score (nine public tests).

    The first period of a symbol has no predecessor, so its five comparisons fail.
    """
    p, c = priced(st, px), F.col
    working = c("totalCurrentAssets") - c("accountPayables")
    assets = c("totalAssets")
    z = (
        ratio(working, assets) * 1.2
        + ratio(c("retainedEarnings"), assets) * 1.4
        + ratio(c("ebit"), assets) * 3.3
        + ratio(c("marketCap"), c("totalLiabilities")) * 0.6
        + ratio(c("revenue"), assets)
    )
    w = Window.partitionBy("symbol").orderBy("date")
    measures = {
        "__roa": ratio(c("netIncome"), assets),
        "__leverage": ratio(c("totalDebt"), assets),
        "__current": ratio(c("totalCurrentAssets"), c("accountPayables")),
        "__margin": ratio(c("grossProfit"), c("revenue")),
        "__turnover": ratio(c("revenue"), assets),
    }
    p = p.withColumns(measures)
    was = {k: F.lag(k).over(w) for k in (*measures, "shares")}
    tests = [
        c("netIncome") > 0,
        c("operatingCashFlow") > 0,
        c("operatingCashFlow") > c("netIncome"),
        c("__roa") > was["__roa"],
        c("__leverage") < was["__leverage"],
        c("__current") > was["__current"],
        c("shares") <= was["shares"],
        c("__margin") > was["__margin"],
        c("__turnover") > was["__turnover"],
    ]
    points = sum((F.coalesce(t, F.lit(False)).cast("bigint") for t in tests), F.lit(0).cast("bigint"))
    return p.select(
        *_ID, z.alias("altmanZScore"), points.alias("piotroskiScore"), working.alias("workingCapital"),
        "totalAssets", "ebit",
    )


def owner_earnings(st: DataFrame, px: DataFrame, limit: int | None = None) -> DataFrame:
    """Owner earnings with capital expenditure split into growth and maintenance.

    Growth capex is the average PPE-to-revenue ratio of the last five periods
    times the revenue growth, at most all capex; the rest is maintenance.
    """
    c = F.col
    w = Window.partitionBy("symbol").orderBy("date")
    p = priced(st, px).withColumn("__ppe", ratio(c("propertyPlantEquipment"), c("revenue")))
    p = p.withColumns(
        {
            "averagePPE": F.avg("__ppe").over(w.rowsBetween(-4, 0)),
            "__more": F.greatest(F.coalesce(c("revenue") - F.lag("revenue").over(w), F.lit(0.0)), F.lit(0.0)),
        }
    )
    spent = -c("capitalExpenditure")
    growth = F.least(F.greatest(c("averagePPE"), F.lit(0.0)) * c("__more"), spent)
    p = p.withColumns({"growthCapex": -growth, "maintenanceCapex": -(spent - growth)})
    owners = c("operatingCashFlow") + c("maintenanceCapex")
    total = c("growthCapex") + c("maintenanceCapex")
    out = p.select(
        *_ID, "averagePPE", "maintenanceCapex", "growthCapex", owners.alias("ownersEarnings"),
        ratio(owners, c("shares")).alias("ownersEarningsPerShare"),
        (ratio(F.abs("maintenanceCapex"), F.abs(total)) * 100).alias("maintenancePercent"),
        (ratio(F.abs("growthCapex"), F.abs(total)) * 100).alias("growthPercent"),
    )
    return newest(out, limit)


def growth(st: DataFrame, items: Sequence[str]) -> DataFrame:
    """Growth of the items against the previous period of the same kind, as a fraction."""
    w = Window.partitionBy("symbol").orderBy("date")

    def change(x: str) -> Column:
        was = F.lag(x).over(w)
        return ratio(F.col(x) - was, F.abs(was)).alias(f"growth{x[0].upper()}{x[1:]}")

    return st.select(*_ID, *[change(x) for x in items])


def income_growth(st: DataFrame) -> DataFrame:
    return growth(st, ("revenue", "grossProfit", "ebit", "netIncome"))


def balance_growth(st: DataFrame) -> DataFrame:
    return growth(st, ("totalAssets", "totalLiabilities", "totalStockholdersEquity", "totalDebt"))


def cash_flow_growth(st: DataFrame) -> DataFrame:
    return growth(st, ("operatingCashFlow", "capitalExpenditure", "freeCashFlow"))


def financial_growth(st: DataFrame) -> DataFrame:
    """Growth across the three statements."""
    return growth(
        st, ("revenue", "grossProfit", "ebit", "netIncome", "totalAssets", "totalDebt", "operatingCashFlow", "freeCashFlow")
    )


def segmentation(df: DataFrame, period: str = "annual", structure: str = "nested") -> DataFrame:
    """Revenue per segment, from (symbol, date, segment, value).

    ``nested`` gives a map from segment to whole revenue per fiscal period;
    ``flat`` one row per segment with its share of the period, largest first by ``rank``.
    """
    keys = ["symbol", "fiscalYear", "period"]
    quarter = F.concat(F.lit("Q"), F.quarter("date").cast("string"))
    d = df.withColumns(
        {"fiscalYear": F.year("date"), "period": F.lit("FY") if period == "annual" else quarter}
    )
    g = d.groupBy(*keys, "segment").agg(F.round(F.sum("value")).cast("bigint").alias("revenue"))
    if structure == "nested":
        entries = F.sort_array(F.collect_list(F.struct("segment", "revenue")))
        return g.groupBy(*keys).agg(F.map_from_entries(entries).alias("data"))
    w = Window.partitionBy(*keys)
    return g.withColumns(
        {
            "percentage": ratio(F.col("revenue"), F.sum("revenue").over(w)) * 100,
            "rank": F.row_number().over(w.orderBy(F.desc("revenue"), "segment")),
        }
    )


def assess(st: DataFrame, px: DataFrame) -> DataFrame:
    """Profitability, leverage and cash-flow classes with P/E and P/S."""
    c = F.col
    p = priced(st, px)
    margin = ratio(c("netIncome"), c("revenue")) * 100
    debt = ratio(c("totalLiabilities"), c("totalAssets"))
    profitable = (c("netIncome") > 0) & (c("revenue") > 0)
    sized = (c("totalAssets") > 0) & (c("totalLiabilities") > 0)
    return p.select(
        *_ID,
        F.when(profitable, F.when(margin > 15, "strong").when(margin > 10, "good").otherwise("moderate")).alias("profitability"),
        F.when(sized, F.when(debt < 0.3, "strong").when(debt < 0.5, "moderate").otherwise("high leverage")).alias("position"),
        F.when((c("operatingCashFlow") > 0) & (c("freeCashFlow") > 0), "strong")
        .when(c("operatingCashFlow") > 0, "positive").otherwise("negative").alias("cashGeneration"),
        F.when(c("netIncome") > 0, ratio(c("marketCap"), c("netIncome"))).alias("priceToEarnings"),
        F.when(c("revenue") > 0, ratio(c("marketCap"), c("revenue"))).alias("priceToSales"),
    )

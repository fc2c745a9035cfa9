"""Discounted cash flow, unlevered and levered, with optional assumptions.

Each company is projected over five years by closed-form column expressions;
there is no shuffle in here. Percent-of-revenue assumptions are fractions,
rates (growth in perpetuity, cost of capital, premium, risk-free) are percent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.scalars import ratio
from marketmill.functions.windows import first_per_key

from .statements import priced

YEARS = 5

#: Percent-of-revenue assumptions and the base item each replaces.
SHARES_OF_REVENUE = {
    "ebitda_pct": "ebitda",
    "depreciation_and_amortization_pct": "depreciation",
    "cash_and_short_term_investments_pct": "totalCash",
    "receivables_pct": "receivables",
    "inventories_pct": "inventories",
    "payable_pct": "payable",
    "ebit_pct": "ebit",
    "capital_expenditure_pct": "capitalExpenditure",
    "operating_cash_flow_pct": "operatingCashFlow",
    "selling_general_and_administrative_expenses_pct": "sellingGeneralAndAdministrativeExpenses",
}
#: Rates used when neither the call nor the base gives one.
DEFAULT_RATES = {
    "long_term_growth_rate": 4.0,
    "cost_of_debt": 3.64,
    "market_risk_premium": 4.72,
    "risk_free_rate": 3.64,
    "beta": 1.0,
}
ASSUMPTIONS = (
    "revenue_growth_pct", *SHARES_OF_REVENUE, "tax_rate", "cost_of_equity", *DEFAULT_RATES,
)


def dcf_base(st: DataFrame, px: DataFrame, betas: DataFrame | None = None) -> DataFrame:
    """Latest annual statement per symbol, with its growth, price, shares and beta."""
    w = Window.partitionBy("symbol").orderBy("date")
    was = F.lag("revenue").over(w)
    p = priced(st, px).withColumn("revenueGrowth", F.coalesce(ratio(F.col("revenue") - was, F.abs(was)), F.lit(0.0)))
    p = first_per_key(p, ["symbol"], [F.desc("date")])
    p = p.withColumn("beta", F.lit(None).cast("double")) if betas is None else p.join(betas, "symbol", "left")
    c = F.col
    return p.select(
        "symbol", "date", "revenue", "revenueGrowth", "ebitda", "ebit", "depreciation",
        c("cashAndCashEquivalents").alias("totalCash"), c("netReceivables").alias("receivables"),
        c("inventory").alias("inventories"), c("accountPayables").alias("payable"), "capitalExpenditure",
        "operatingCashFlow", c("operatingExpenses").alias("sellingGeneralAndAdministrativeExpenses"), "price",
        c("shares").alias("dilutedSharesOutstanding"), "totalDebt", "beta",
        ratio(c("incomeTaxExpense"), c("ebit")).alias("taxRateCash"),
    )


def _assumption(base: DataFrame, given: dict[str, float], name: str, default: Column) -> Column:
    """The call's value, else a grid column of the same name, else the default."""
    if given.get(name) is not None:
        return F.lit(float(given[name]))
    return F.col(name) if name in base.columns else default


def _check(given: dict[str, float]) -> None:
    unknown = set(given) - set(ASSUMPTIONS)
    if unknown:
        raise TypeError(f"unknown assumptions {sorted(unknown)}")


def _capital(base: DataFrame, given: dict[str, float]) -> DataFrame:
    """Cost of capital. The weighted cost takes debt after the cash tax rate."""
    c = F.col
    own = {"beta": F.coalesce(c("beta"), F.lit(DEFAULT_RATES["beta"]))}
    rate = {k: _assumption(base.drop("beta"), given, k, own.get(k, F.lit(v))) for k, v in DEFAULT_RATES.items()}
    base = base.withColumns(
        {
            "beta": rate["beta"],
            "riskFreeRate": rate["risk_free_rate"],
            "marketRiskPremium": rate["market_risk_premium"],
            "costofDebt": rate["cost_of_debt"],
            "longTermGrowthRate": rate["long_term_growth_rate"],
            "taxRateCash": _assumption(base, given, "tax_rate", c("taxRateCash")),
            "totalEquity": c("price") * c("dilutedSharesOutstanding"),
        }
    )
    capm = c("riskFreeRate") + c("beta") * c("marketRiskPremium")
    base = base.withColumns(
        {
            "costOfEquity": _assumption(base, given, "cost_of_equity", capm),
            "totalCapital": c("totalDebt") + c("totalEquity"),
            "afterTaxCostOfDebt": c("costofDebt") * (1 - c("taxRateCash")),
        }
    )
    base = base.withColumns(
        {
            "debtWeighting": ratio(c("totalDebt"), c("totalCapital")) * 100,
            "equityWeighting": ratio(c("totalEquity"), c("totalCapital")) * 100,
        }
    )
    wacc = (c("equityWeighting") * c("costOfEquity") + c("debtWeighting") * c("afterTaxCostOfDebt")) / 100
    return base.withColumns({"wacc": wacc, "netDebt": c("totalDebt") - c("totalCash")})


def _value(df: DataFrame, flows: list[Column], flow: str, total: str, rows: list[Column], keep: list[str]) -> DataFrame:
    """Present values, terminal value and equity value; one output row per projected year."""
    c = F.col
    w, g = c("wacc") / 100, c("longTermGrowthRate") / 100
    pv = sum((f / F.pow(1 + w, F.lit(t)) for t, f in enumerate(flows, 1)), F.lit(0.0))
    df = df.withColumns({total: pv, "freeCashFlowT1": flows[-1] * (1 + g)})
    terminal = F.when(w > g, ratio(c("freeCashFlowT1"), w - g))
    df = df.withColumn("terminalValue", terminal)
    df = df.withColumn("presentTerminalValue", c("terminalValue") / F.pow(1 + w, F.lit(YEARS)))
    df = df.withColumn("enterpriseValue", c(total) + c("presentTerminalValue"))
    df = df.withColumn("equityValue", c("enterpriseValue") - c("netDebt"))
    df = df.withColumn("equityValuePerShare", ratio(c("equityValue"), c("dilutedSharesOutstanding")))
    shown = [
        *keep, "price", "beta", "dilutedSharesOutstanding", "costofDebt", "afterTaxCostOfDebt", "riskFreeRate",
        "marketRiskPremium", "costOfEquity", "totalDebt", "totalEquity", "totalCapital", "debtWeighting",
        "equityWeighting", "wacc", "taxRateCash", "longTermGrowthRate", total, "freeCashFlowT1", "terminalValue",
        "presentTerminalValue", "enterpriseValue", "netDebt", "equityValue", "equityValuePerShare",
    ]
    return df.select(*shown, F.inline(F.array(*rows)))


def _scenario(base: DataFrame) -> list[str]:
    return ["symbol", *[n for n in ("baseDate", *ASSUMPTIONS) if n in base.columns and n != "beta"]]


def _project(base: DataFrame, given: dict[str, float]) -> tuple[DataFrame, list[Column], dict[str, Column]]:
    """Revenue of the base and the five years, and every item's share of revenue."""
    _check(given)
    g = _assumption(base, given, "revenue_growth_pct", F.col("revenueGrowth"))
    rates = {
        item: _assumption(base, given, name, ratio(F.col(item), F.col("revenue")))
        for name, item in SHARES_OF_REVENUE.items()
    }
    named = base.withColumns({"__g": g, **{f"__{i}": r for i, r in rates.items()}})
    named = _capital(named, given)
    revenue = [F.col("revenue") * F.pow(1 + F.col("__g"), F.lit(t)) for t in range(YEARS + 1)]
    return named, revenue, {i: F.col(f"__{i}") for i in rates}


def _year(base_date: str, t: int) -> Column:
    return (F.year(base_date) + t).cast("string").alias("year")


def dcf_custom(base: DataFrame, **given: float) -> DataFrame:
    """Unlevered DCF: one row per symbol and projected year.

    Free cash flow is EBIT after cash tax plus depreciation plus (signed) capital
    expenditure minus the growth of working capital. What is not given comes
    from the base. Discounted at a cost of capital not above the perpetual
    growth rate there is no terminal value.
    """
    keep = _scenario(base)
    df, revenue, rate = _project(base, given)
    working = [F.col("receivables") + F.col("inventories") - F.col("payable")]
    working += [r * (rate["receivables"] + rate["inventories"] - rate["payable"]) for r in revenue[1:]]
    ebiat = [r * rate["ebit"] * (1 - F.col("taxRateCash")) for r in revenue]
    flows = [
        ebiat[t] + revenue[t] * (rate["depreciation"] + rate["capitalExpenditure"]) - (working[t] - working[t - 1])
        for t in range(1, YEARS + 1)
    ]
    rows = [
        F.struct(
            _year("date", t), revenue[t].alias("revenue"),
            *[(revenue[t] * r).alias(i) for i, r in rate.items()],
            ebiat[t].alias("ebiat"), flows[t - 1].alias("ufcf"),
        )
        for t in range(1, YEARS + 1)
    ]
    return _value(df, flows, "ufcf", "sumPvUfcf", rows, keep)


def dcf_levered(base: DataFrame, **given: float) -> DataFrame:
    """Levered DCF: free cash flow is operating cash flow plus signed capital expenditure."""
    keep = _scenario(base)
    df, revenue, rate = _project(base, given)
    flows = [revenue[t] * (rate["operatingCashFlow"] + rate["capitalExpenditure"]) for t in range(1, YEARS + 1)]
    w = F.col("wacc") / 100
    rows = [
        F.struct(
            _year("date", t), revenue[t].alias("revenue"),
            (revenue[t] * rate["capitalExpenditure"]).alias("capitalExpenditure"),
            (revenue[t] * rate["operatingCashFlow"]).alias("operatingCashFlow"),
            flows[t - 1].alias("freeCashFlow"), (flows[t - 1] / F.pow(1 + w, F.lit(t))).alias("pvLfcf"),
        )
        for t in range(1, YEARS + 1)
    ]
    return _value(df, flows, "freeCashFlow", "sumPvLfcf", rows, keep)


def dcf(base: DataFrame, levered: bool = False) -> DataFrame:
    """Value per share with default assumptions against the price, and the upside in percent."""
    run = dcf_levered if levered else dcf_custom
    # the values repeat on every projected year; the first one stands for the symbol
    v = run(base.withColumn("baseDate", F.col("date"))).filter(F.col("year") == (F.year("baseDate") + 1).cast("string"))
    per_share = F.col("equityValuePerShare")
    return v.select(
        "symbol", F.col("baseDate").alias("date"), per_share.alias("dcf"), F.col("price").alias("Stock Price"),
        (ratio(per_share - F.col("price"), F.col("price")) * 100).alias("upside"),
    )


def dcf_sweep(base: DataFrame, grid: DataFrame, **given: float) -> DataFrame:
    """Value per share for every row of a small grid of assumptions.

    The grid's columns are named like the assumptions they vary. It is a handful
    of scenarios by nature, and its rows are what multiplies the companies.
    """
    _check({c: 0.0 for c in grid.columns})
    if "beta" in grid.columns:
        base = base.drop("beta")
    runs = dcf_custom(base.withColumn("baseDate", F.col("date")).crossJoin(grid), **given)
    first = runs.filter(F.col("year") == (F.year("baseDate") + 1).cast("string"))
    return first.select("symbol", *grid.columns, "wacc", "enterpriseValue", "equityValue", "equityValuePerShare")

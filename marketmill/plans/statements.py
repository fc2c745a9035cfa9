"""F: statements, ratios, growth and valuation over the ``stmt`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import statements as S
from marketmill.operators import valuation as V

from .registry import CTES, query
from .tables import px_hist, stmt, table

_SUMS = ", ".join(f'sum("{c}") AS "{c}"' for c in S.FLOWS)
_FLOW_SQL = {
    "annual": f"""SELECT symbol, CAST(make_date(year(date), 12, 31) AS DATE) AS date, CAST(year(date) AS VARCHAR) AS "fiscalYear",
       'FY' AS period, {_SUMS} FROM stmt GROUP BY 1, 2, 3""",
    "quarter": f"""SELECT symbol, date, CAST(year(date) AS VARCHAR) AS "fiscalYear", 'Q' || CAST(quarter(date) AS VARCHAR) AS period, {_SUMS}
       FROM stmt GROUP BY 1, 2, 3, 4""",
}
for _p, _sql in _FLOW_SQL.items():
    CTES[f"flow_{_p}"] = _sql
    CTES[f"core_{_p}"] = f"""
SELECT *, revenue - "costOfRevenue" AS "grossProfit", revenue - "costOfRevenue" - "operatingExpenses" AS ebit,
       revenue - "costOfRevenue" - "operatingExpenses" + depreciation AS ebitda,
       revenue - "costOfRevenue" - "operatingExpenses" - "incomeTaxExpense" AS "netIncome",
       "changeInPayables" - "changeInReceivables" - "changeInInventories" AS "changeInWorkingCapital",
       "capitalExpenditure" AS "investingCashFlow", "changeInDebt" AS "financingCashFlow" FROM flow_{_p}"""
    CTES[f"cash_{_p}"] = f"""
SELECT *, "netIncome" + depreciation + "changeInWorkingCapital" AS "operatingCashFlow",
       "netIncome" + depreciation + "changeInWorkingCapital" + "capitalExpenditure" AS "freeCashFlow" FROM core_{_p}"""
    CTES[f"run_{_p}"] = f"""
SELECT *, sum("freeCashFlow" + "financingCashFlow") OVER w AS "cashAndCashEquivalents", sum("changeInReceivables") OVER w AS "netReceivables",
       sum("changeInInventories") OVER w AS inventory, sum(-"capitalExpenditure" - depreciation) OVER w AS "propertyPlantEquipment",
       sum("changeInPayables") OVER w AS "accountPayables", sum("changeInDebt") OVER w AS "totalDebt",
       sum("netIncome") OVER w AS "retainedEarnings" FROM cash_{_p} WINDOW w AS (PARTITION BY symbol ORDER BY date)"""
    CTES[f"st_{_p}"] = f"""
SELECT *, "totalCurrentAssets" + "propertyPlantEquipment" AS "totalAssets",
       "totalCurrentAssets" + "propertyPlantEquipment" - "totalLiabilities" AS "totalStockholdersEquity"
FROM (SELECT *, "cashAndCashEquivalents" + "netReceivables" + inventory AS "totalCurrentAssets",
             "accountPayables" + "totalDebt" AS "totalLiabilities" FROM run_{_p})"""
CTES["st_priced"] = """
SELECT *, price * shares AS "marketCap" FROM (
  SELECT s.*, (SELECT arg_max(price, p.date) FROM px_hist p WHERE p.symbol = s.symbol AND p.date <= s.date) AS price,
         (SELECT arg_max(shares, p.date) FROM px_hist p WHERE p.symbol = s.symbol AND p.date <= s.date) AS shares FROM st_annual s)"""
ID = 'symbol, date, "fiscalYear", period'


def _cols(names) -> str:
    return ID + ", " + ", ".join(f'"{c}"' for c in names)


def _statement(key: str, names, fn) -> None:
    for period in ("annual", "quarter"):

        @query(f"{key}_{period}", f"SELECT {_cols(names)} FROM st_{period}", r4=" ".join(names))
        def run(spark, sf, period=period):
            return fn(stmt(spark, sf), period)

    @query(
        f"{key}_newest",
        f"SELECT {_cols(names)} FROM st_quarter QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 4",
        r4=" ".join(names),
    )
    def newest(spark, sf):
        return fn(stmt(spark, sf), "quarter", 4)


_statement("F1_income_statement", S.INCOME, S.income_statement)
_statement("F2_balance_sheet", S.BALANCE, S.balance_sheet)
_statement("F3_cash_flow", S.CASH_FLOW, S.cash_flow)


def annual(spark, sf):
    return S.statements(stmt(spark, sf), "annual")


EV = '"marketCap" + "totalDebt" - "cashAndCashEquivalents"'


@query(
    "F4_key_metrics",
    f"""SELECT {ID}, "marketCap", {EV} AS "enterpriseValue", ({EV}) / revenue AS "evToSales",
       "totalCurrentAssets" / nullif("accountPayables", 0) AS "currentRatio", "netIncome" / nullif("totalStockholdersEquity", 0) AS "returnOnEquity"
FROM st_priced""",
    r6="evToSales currentRatio returnOnEquity",
    r4="marketCap enterpriseValue",
)
def f4(spark, sf):
    return S.key_metrics(annual(spark, sf), px_hist(spark, sf))


@query(
    "F5_ratios",
    f"""SELECT {ID}, "grossProfit" / revenue AS "grossProfitMargin", ebit / revenue AS "ebitMargin", "netIncome" / revenue AS "netProfitMargin",
       "totalCurrentAssets" / nullif("accountPayables", 0) AS "currentRatio", "totalDebt" / nullif("totalStockholdersEquity", 0) AS "debtToEquityRatio"
FROM st_annual""",
    r6="grossProfitMargin ebitMargin netProfitMargin currentRatio debtToEquityRatio",
)
def f5(spark, sf):
    return S.ratios(annual(spark, sf))


@query(
    "F6_scores",
    f"""SELECT {ID}, ("totalCurrentAssets" - "accountPayables") / "totalAssets" * 1.2 + "retainedEarnings" / "totalAssets" * 1.4
       + ebit / "totalAssets" * 3.3 + "marketCap" / nullif("totalLiabilities", 0) * 0.6 + revenue / "totalAssets" AS "altmanZScore",
       CAST((CASE WHEN "netIncome" > 0 THEN 1 ELSE 0 END) + (CASE WHEN "operatingCashFlow" > 0 THEN 1 ELSE 0 END)
       + (CASE WHEN "operatingCashFlow" > "netIncome" THEN 1 ELSE 0 END)
       + (CASE WHEN roa > lag(roa) OVER w THEN 1 ELSE 0 END) + (CASE WHEN lev < lag(lev) OVER w THEN 1 ELSE 0 END)
       + (CASE WHEN cur > lag(cur) OVER w THEN 1 ELSE 0 END) + (CASE WHEN shares <= lag(shares) OVER w THEN 1 ELSE 0 END)
       + (CASE WHEN mar > lag(mar) OVER w THEN 1 ELSE 0 END) + (CASE WHEN trn > lag(trn) OVER w THEN 1 ELSE 0 END) AS BIGINT) AS "piotroskiScore",
       "totalCurrentAssets" - "accountPayables" AS "workingCapital", "totalAssets", ebit
FROM (SELECT *, "netIncome" / "totalAssets" AS roa, "totalDebt" / "totalAssets" AS lev, "totalCurrentAssets" / nullif("accountPayables", 0) AS cur,
             "grossProfit" / revenue AS mar, revenue / "totalAssets" AS trn FROM st_priced) WINDOW w AS (PARTITION BY symbol ORDER BY date)""",
    r6="altmanZScore",
    r4="workingCapital totalAssets ebit",
)
def f6(spark, sf):
    return S.scores(annual(spark, sf), px_hist(spark, sf))


@query(
    "F7_owner_earnings",
    f"""WITH a AS (SELECT *, avg("propertyPlantEquipment" / revenue) OVER (PARTITION BY symbol ORDER BY date ROWS 4 PRECEDING) AS "averagePPE",
       greatest(coalesce(revenue - lag(revenue) OVER (PARTITION BY symbol ORDER BY date), 0), 0) AS more FROM st_priced),
b AS (SELECT *, least(greatest("averagePPE", 0) * more, -"capitalExpenditure") AS g FROM a)
SELECT {ID}, "averagePPE", -(-"capitalExpenditure" - g) AS "maintenanceCapex", -g AS "growthCapex",
       "operatingCashFlow" + "capitalExpenditure" + g AS "ownersEarnings", ("operatingCashFlow" + "capitalExpenditure" + g) / shares AS "ownersEarningsPerShare",
       (-"capitalExpenditure" - g) / nullif(-"capitalExpenditure", 0) * 100 AS "maintenancePercent", g / nullif(-"capitalExpenditure", 0) * 100 AS "growthPercent" FROM b""",
    r6="averagePPE ownersEarningsPerShare maintenancePercent growthPercent",
    r4="maintenanceCapex growthCapex ownersEarnings",
)
def f7(spark, sf):
    return S.owner_earnings(annual(spark, sf), px_hist(spark, sf))


@query(
    "F8_enterprise_values",
    f"""SELECT symbol, date, price AS "stockPrice", shares AS "numberOfShares", "marketCap" AS "marketCapitalization", {EV} AS "enterpriseValue" FROM st_priced""",
    r4="stockPrice marketCapitalization enterpriseValue",
)
def f8(spark, sf):
    return S.enterprise_values(annual(spark, sf), px_hist(spark, sf))


def _growth_sql(names) -> str:
    parts = [
        f'("{c}" - lag("{c}") OVER w) / nullif(abs(lag("{c}") OVER w), 0) AS "growth{c[0].upper()}{c[1:]}"' for c in names
    ]
    return f"SELECT {ID}, {', '.join(parts)} FROM st_annual WINDOW w AS (PARTITION BY symbol ORDER BY date)"


_GROWTH = {
    "F9_income_growth": (S.income_growth, ("revenue", "grossProfit", "ebit", "netIncome")),
    "F9_balance_growth": (S.balance_growth, ("totalAssets", "totalLiabilities", "totalStockholdersEquity", "totalDebt")),
    "F9_cash_flow_growth": (S.cash_flow_growth, ("operatingCashFlow", "capitalExpenditure", "freeCashFlow")),
    "F10_financial_growth": (
        S.financial_growth,
        ("revenue", "grossProfit", "ebit", "netIncome", "totalAssets", "totalDebt", "operatingCashFlow", "freeCashFlow"),
    ),
}


def _growth(key: str) -> None:
    fn, names = _GROWTH[key]

    @query(key, _growth_sql(names), r6=" ".join(f"growth{c[0].upper()}{c[1:]}" for c in names))
    def run(spark, sf):
        return fn(annual(spark, sf))


for _key in _GROWTH:
    _growth(_key)

CTES["seg_product"] = """
SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, p_type AS segment, l_extendedprice * (1 - l_discount) AS value
FROM lineitem JOIN part ON l_partkey = p_partkey"""
CTES["seg_region"] = """
SELECT l_suppkey AS symbol, shipdate AS date, n_name AS segment, l_extendedprice * (1 - l_discount) AS value
FROM line_orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def segments(spark, sf, by: str):
    from .tables import line_orders

    value = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("value")
    if by == "product":
        li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
        return li.join(p, li.l_partkey == p.p_partkey).select(
            F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.col("p_type").alias("segment"), value
        )
    lo, c, n = line_orders(spark, sf), table(spark, sf, "customer"), table(spark, sf, "nation")
    return lo.join(c, lo.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("l_suppkey").alias("symbol"), F.col("shipdate").alias("date"), F.col("n_name").alias("segment"), value
    )


def _seg(by: str) -> None:
    base = f"""SELECT symbol, CAST(year(date) AS INTEGER) AS "fiscalYear", 'FY' AS period, segment, CAST(round(sum(value)) AS BIGINT) AS revenue
FROM seg_{by} GROUP BY 1, 2, 3, 4"""

    @query(
        f"F11_segmentation_{by}",
        f"""SELECT symbol, "fiscalYear", period, string_agg(segment || ':' || CAST(revenue AS VARCHAR), ',' ORDER BY segment) AS data FROM ({base}) GROUP BY 1, 2, 3""",
    )
    def nested(spark, sf):
        pairs = F.transform(F.map_entries("data"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
        return S.segmentation(segments(spark, sf, by)).withColumn("data", F.array_join(pairs, ","))

    @query(
        f"F11_segmentation_{by}_flat",
        f"""SELECT *, revenue / sum(revenue) OVER (PARTITION BY symbol, "fiscalYear", period) * 100 AS percentage,
       CAST(row_number() OVER (PARTITION BY symbol, "fiscalYear", period ORDER BY revenue DESC, segment) AS INTEGER) AS rank FROM ({base})""",
        r6="percentage",
    )
    def flat(spark, sf):
        return S.segmentation(segments(spark, sf, by), structure="flat")


for _by in ("product", "region"):
    _seg(_by)

# Valuation ----------------------------------------------------------------------

CTES["dcf_base"] = """
SELECT b.*, 0.5 + p_size / 50 AS beta FROM (
  SELECT symbol, date, revenue, coalesce((revenue - lag(revenue) OVER w) / abs(lag(revenue) OVER w), 0) AS "revenueGrowth", ebitda, ebit, depreciation,
         "cashAndCashEquivalents" AS "totalCash", "netReceivables" AS receivables, inventory AS inventories, "accountPayables" AS payable,
         "capitalExpenditure", "operatingCashFlow", "operatingExpenses" AS "sellingGeneralAndAdministrativeExpenses", price,
         shares AS "dilutedSharesOutstanding", "totalDebt", "incomeTaxExpense" / ebit AS "taxRateCash"
  FROM st_priced WINDOW w AS (PARTITION BY symbol ORDER BY date)
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1) b LEFT JOIN part ON symbol = p_partkey"""


def base(spark, sf):
    betas = table(spark, sf, "part").select(F.col("p_partkey").alias("symbol"), (0.5 + F.col("p_size") / 50).alias("beta"))
    return V.dcf_base(annual(spark, sf), px_hist(spark, sf), betas)


def _dcf_sql(src: str, flow: str, total: str, g: str, ltg: str, tax: str, extra: str = "") -> str:
    """``flow`` is the free cash flow of year t written with rev(t), rev(t-1) placeholders."""
    return f"""
SELECT * REPLACE ("freeCashFlowT1" / (wacc - "longTermGrowthRate") * 100 AS "terminalValue") FROM (
SELECT *, "presentTerminalValue" + "{total}" AS "enterpriseValue", "presentTerminalValue" + "{total}" - "netDebt" AS "equityValue",
       ("presentTerminalValue" + "{total}" - "netDebt") / "dilutedSharesOutstanding" AS "equityValuePerShare" FROM (
SELECT *, "freeCashFlowT1" / (wacc - "longTermGrowthRate") * 100 / pow(1 + wacc / 100, 5) AS "presentTerminalValue", 0.0 AS "terminalValue" FROM (
SELECT *, sum(flow / pow(1 + wacc / 100, t)) OVER p AS "{total}",
       max(CASE WHEN t = 5 THEN flow END) OVER p * (1 + "longTermGrowthRate" / 100) AS "freeCashFlowT1"
FROM (SELECT *, {flow} AS flow FROM (
  SELECT *, revenue * pow(1 + g, t) AS rt, revenue * pow(1 + g, t - 1) AS rp FROM (
    SELECT *, "totalDebt" / "totalCapital" * 100 AS "debtWeighting", "totalEquity" / "totalCapital" * 100 AS "equityWeighting",
           ("totalEquity" * "costOfEquity" + "totalDebt" * "afterTaxCostOfDebt") / "totalCapital" AS wacc FROM (
      SELECT * REPLACE (tax AS "taxRateCash"), price * "dilutedSharesOutstanding" AS "totalEquity", CAST(3.64 AS DOUBLE) AS "costofDebt", CAST(3.64 AS DOUBLE) AS "riskFreeRate",
             CAST(4.72 AS DOUBLE) AS "marketRiskPremium", 3.64 + beta * 4.72 AS "costOfEquity", 3.64 * (1 - tax) AS "afterTaxCostOfDebt",
             "totalDebt" + price * "dilutedSharesOutstanding" AS "totalCapital", "totalDebt" - "totalCash" AS "netDebt"
      FROM (SELECT *, {g} AS g, CAST({ltg} AS DOUBLE) AS "longTermGrowthRate", CAST({tax} AS DOUBLE) AS tax FROM {src})))
    , generate_series(1, 5) y(t)))
WINDOW p AS (PARTITION BY symbol{extra}))))"""


UFCF = """rt * ebit / revenue * (1 - "taxRateCash") + rt * depreciation / revenue + rt * {capex} - (rt * (receivables + inventories - payable) / revenue
   - CASE WHEN t = 1 THEN receivables + inventories - payable ELSE rp * (receivables + inventories - payable) / revenue END)"""
BASE_CAPEX = '"capitalExpenditure" / revenue'
SHOWN = (
    'symbol, price, beta, "dilutedSharesOutstanding", "costofDebt", "afterTaxCostOfDebt", "riskFreeRate", "marketRiskPremium", '
    '"costOfEquity", "totalDebt", "totalEquity", "totalCapital", "debtWeighting", "equityWeighting", wacc, "taxRateCash", '
    '"longTermGrowthRate", "{total}", "freeCashFlowT1", "terminalValue", "presentTerminalValue", "enterpriseValue", "netDebt", '
    '"equityValue", "equityValuePerShare", CAST(year(date) + t AS VARCHAR) AS year, rt AS revenue'
)
D_R6 = "beta afterTaxCostOfDebt costOfEquity debtWeighting equityWeighting wacc taxRateCash"
D_R2 = "equityValuePerShare price totalDebt totalEquity totalCapital freeCashFlowT1 terminalValue presentTerminalValue enterpriseValue netDebt equityValue revenue capitalExpenditure operatingCashFlow"
_ITEMS = {
    "ebitda": "ebitda", "depreciation": "depreciation", "totalCash": '"totalCash"', "receivables": "receivables",
    "inventories": "inventories", "payable": "payable", "ebit": "ebit", "operatingCashFlow": '"operatingCashFlow"',
    "sellingGeneralAndAdministrativeExpenses": '"sellingGeneralAndAdministrativeExpenses"',
}


def _custom_sql(g: str, ltg: str, tax: str, capex: str) -> str:
    items = ", ".join(f'rt * {c} / revenue AS "{n}"' for n, c in _ITEMS.items())
    return f"""SELECT {SHOWN.format(total="sumPvUfcf")}, {items}, rt * {capex} AS "capitalExpenditure",
       rt * ebit / revenue * (1 - "taxRateCash") AS ebiat, flow AS ufcf
FROM ({_dcf_sql("dcf_base", UFCF.format(capex=capex), "sumPvUfcf", g, ltg, tax)})"""


C_R2 = D_R2 + " sumPvUfcf ebitda depreciation totalCash receivables inventories payable ebit sellingGeneralAndAdministrativeExpenses ebiat ufcf"


@query("F13_dcf_custom", _custom_sql("0.05", "3.0", "0.15", "-0.03"), r6=D_R6, r2=C_R2)
def f13(spark, sf):
    return V.dcf_custom(
        base(spark, sf), revenue_growth_pct=0.05, long_term_growth_rate=3.0, tax_rate=0.15, capital_expenditure_pct=-0.03
    )


_LEVERED = _dcf_sql(
    "dcf_base", 'rt * "operatingCashFlow" / revenue + rt * "capitalExpenditure" / revenue', "sumPvLfcf", "0.05", "3.0", '"taxRateCash"'
)


@query(
    "F14_dcf_levered",
    f"""SELECT {SHOWN.format(total="sumPvLfcf")}, rt * "capitalExpenditure" / revenue AS "capitalExpenditure",
       rt * "operatingCashFlow" / revenue AS "operatingCashFlow", flow AS "freeCashFlow", flow / pow(1 + wacc / 100, t) AS "pvLfcf" FROM ({_LEVERED})""",
    r6=D_R6,
    r2=D_R2 + " sumPvLfcf freeCashFlow pvLfcf",
)
def f14(spark, sf):
    return V.dcf_levered(base(spark, sf), revenue_growth_pct=0.05, long_term_growth_rate=3.0)


_SAFE = """SELECT symbol, date, CASE WHEN wacc > "longTermGrowthRate" THEN "equityValuePerShare" END AS dcf, price AS "Stock Price",
       CASE WHEN wacc > "longTermGrowthRate" THEN ("equityValuePerShare" - price) / price * 100 END AS upside FROM ({}) WHERE t = 1"""


@query(
    "F12_dcf",
    _SAFE.format(_dcf_sql("dcf_base", UFCF.format(capex=BASE_CAPEX), "sumPvUfcf", '"revenueGrowth"', "4.0", '"taxRateCash"')),
    r4="dcf upside",
)
def f12(spark, sf):
    return V.dcf(base(spark, sf))


@query(
    "F12_dcf_levered",
    _SAFE.format(
        _dcf_sql("dcf_base", 'rt * "operatingCashFlow" / revenue + rt * "capitalExpenditure" / revenue', "sumPvLfcf", '"revenueGrowth"', "4.0", '"taxRateCash"')
    ),
    r4="dcf upside",
)
def f12l(spark, sf):
    return V.dcf(base(spark, sf), levered=True)


CTES["dcf_grid_base"] = """
SELECT * FROM dcf_base, (VALUES (0.05, 0.10), (0.10, 0.15), (0.15, 0.20), (0.20, 0.25)) g(revenue_growth_pct, tax_rate)"""


@query(
    "F15_dcf_sweep",
    f"""SELECT symbol, CAST(revenue_growth_pct AS DOUBLE) AS revenue_growth_pct, CAST(tax_rate AS DOUBLE) AS tax_rate, wacc, "enterpriseValue", "equityValue", "equityValuePerShare"
FROM ({_dcf_sql("dcf_grid_base", UFCF.format(capex=BASE_CAPEX), "sumPvUfcf", "revenue_growth_pct", "2.0", "tax_rate", ", revenue_growth_pct, tax_rate")}) WHERE t = 1""",
    r6="wacc equityValuePerShare",
    r4="enterpriseValue equityValue",
)
def f15(spark, sf):
    rows = [(0.05, 0.10), (0.10, 0.15), (0.15, 0.20), (0.20, 0.25)]
    grid = spark.createDataFrame(rows, "revenue_growth_pct double, tax_rate double")
    return V.dcf_sweep(base(spark, sf), grid, long_term_growth_rate=2.0)


@query(
    "F16_assess",
    f"""SELECT {ID}, CASE WHEN "netIncome" > 0 AND revenue > 0 THEN CASE WHEN "netIncome" / revenue * 100 > 15 THEN 'strong'
         WHEN "netIncome" / revenue * 100 > 10 THEN 'good' ELSE 'moderate' END END AS profitability,
       CASE WHEN "totalAssets" > 0 AND "totalLiabilities" > 0 THEN CASE WHEN "totalLiabilities" / "totalAssets" < 0.3 THEN 'strong'
         WHEN "totalLiabilities" / "totalAssets" < 0.5 THEN 'moderate' ELSE 'high leverage' END END AS position,
       CASE WHEN "operatingCashFlow" > 0 AND "freeCashFlow" > 0 THEN 'strong' WHEN "operatingCashFlow" > 0 THEN 'positive' ELSE 'negative' END AS "cashGeneration",
       CASE WHEN "netIncome" > 0 THEN "marketCap" / "netIncome" END AS "priceToEarnings", "marketCap" / revenue AS "priceToSales" FROM st_priced""",
    r6="priceToEarnings priceToSales",
)
def f16(spark, sf):
    return S.assess(annual(spark, sf), px_hist(spark, sf))

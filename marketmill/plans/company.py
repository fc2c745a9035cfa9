"""G and H: company data and calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.operators import calendars as H
from marketmill.operators import company as G
from marketmill.operators import prices as P
from marketmill.session import materialize

from .performance import listed
from .prices import bars, dividends
from .registry import CTES, query
from .tables import securities, table

CTES["rets"] = """
SELECT * FROM (SELECT symbol, date, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS r FROM bars) WHERE r IS NOT NULL"""
CTES["beta_series"] = """
SELECT symbol, CASE WHEN var_pop(m) > 0 THEN covar_pop(r, m) / var_pop(m) END AS beta
FROM rets JOIN (SELECT date, avg(r) AS m FROM rets GROUP BY 1) USING (date) GROUP BY 1"""


@query(
    "G1_profile",
    """SELECT d.symbol, d.name, d.sector, d.industry, d.exchange, q.price, q."marketCap", beta, last.dividend AS "lastDividend",
       CAST(CAST(round("yearLow", 2) AS DECIMAL(18, 2)) AS VARCHAR) || '-' || CAST(CAST(round("yearHigh", 2) AS DECIMAL(18, 2)) AS VARCHAR) AS range,
       change, "changePercentage", volume, "priceAvg50", "priceAvg200"
FROM listed d LEFT JOIN quotes q ON d.symbol = q.symbol LEFT JOIN beta_series b ON d.symbol = b.symbol
LEFT JOIN (SELECT symbol, arg_max(dividend, (date, dividend)) AS dividend FROM dividends GROUP BY 1) last ON d.symbol = last.symbol""",
    r6="beta lastDividend change changePercentage priceAvg50 priceAvg200",
    r4="marketCap",
)
def g1(spark, sf):
    directory = listed(spark, sf).select("symbol", "name", "sector", "industry", "exchange")
    b = materialize(bars(spark, sf), "bars")  # quotes and betas both read it
    return G.profile(directory, P.quotes(b, securities(spark, sf)), G.betas(b), dividends(spark, sf))


CTES["note_rows"] = """
SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderpriority || ' note ' || CAST(o_orderkey AS VARCHAR) AS title, CAST(o_orderdate AS DATE) AS date FROM orders"""


def note_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"),
        F.concat(F.col("o_orderpriority"), F.lit(" note "), F.col("o_orderkey").cast("string")).alias("title"),
        F.to_date("o_orderdate").alias("date"),
    )


@query("G2_notes", "SELECT * FROM note_rows WHERE symbol = '7'")
def g2(spark, sf):
    return G.notes(note_rows(spark, sf), "7")


CTES["employee_rows"] = """
SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS "filingDate", o_orderkey AS id, CAST(floor(o_totalprice / 10) AS BIGINT) AS "employeeCount" FROM orders"""


def employee_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("filingDate"), F.col("o_orderkey").alias("id"),
        F.floor(F.col("o_totalprice") / 10).alias("employeeCount"),
    )


def _employees(n: int, suffix: str) -> None:
    @query(
        f"G3_employee_count_{suffix}",
        f'SELECT * FROM employee_rows QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "filingDate" DESC, id) <= {n}',
    )
    def run(spark, sf):
        return G.employee_count(employee_rows(spark, sf), [F.desc("filingDate"), F.asc("id")], limit=n)


_employees(1, "current")
_employees(5, "history")

CTES["exec_rows"] = """
SELECT s_nationkey AS symbol, s_suppkey AS position, s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 'CFO' WHEN 1 THEN 'Chair and CEO' ELSE 'Counsel' END AS title,
       s_acctbal > 0 AS active FROM supplier"""


def exec_rows(spark, sf):
    k = F.col("s_suppkey")
    title = F.when(k % 3 == 0, "CFO").when(k % 3 == 1, "Chair and CEO").otherwise("Counsel")
    return table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("symbol"), k.alias("position"), F.col("s_name").alias("name"), title.alias("title"),
        (F.col("s_acctbal") > 0).alias("active"),
    )


@query("G4_executives", "SELECT * FROM exec_rows WHERE active")
def g4(spark, sf):
    return G.executives(exec_rows(spark, sf), active=True)


@query("G4_ceo", "SELECT symbol, arg_min(name, position) AS name, arg_min(title, position) AS title FROM exec_rows WHERE title LIKE '%CEO%' GROUP BY 1")
def g4c(spark, sf):
    return G.ceo(exec_rows(spark, sf))


_PARTS_SQL = ", ".join(
    f"CAST(sum(CASE WHEN l_linenumber = {i} THEN l_quantity * 1000 END) AS BIGINT) AS \"{c}\"" for i, c in enumerate(G.COMPENSATION_PARTS, 1)
)
CTES["comp_rows"] = f"""
SELECT l_suppkey AS symbol, p_brand AS industry, CAST(year(l_shipdate) AS INTEGER) AS year, {_PARTS_SQL}
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3"""
CTES["comp_total"] = "SELECT *, CAST(" + " + ".join(f'coalesce("{c}", 0)' for c in G.COMPENSATION_PARTS) + " AS BIGINT) AS total FROM comp_rows"


def comp_rows(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    parts = [
        F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity") * 1000)).cast("bigint").alias(c)
        for i, c in enumerate(G.COMPENSATION_PARTS, 1)
    ]
    return li.join(p, li.l_partkey == p.p_partkey).groupBy(
        F.col("l_suppkey").alias("symbol"), F.col("p_brand").alias("industry"), F.year("l_shipdate").alias("year")
    ).agg(*parts)


@query("G5_exec_compensation", "SELECT * FROM comp_total")
def g5(spark, sf):
    return G.exec_compensation(comp_rows(spark, sf))


@query(
    "G6_comp_benchmark",
    'SELECT industry, year, avg(total) AS "averageCompensation" FROM comp_total GROUP BY 1, 2',
    r6="averageCompensation",
)
def g6(spark, sf):
    return G.comp_benchmark(G.exec_compensation(comp_rows(spark, sf)))


# Calendars ----------------------------------------------------------------------

CTES["dividend_rows"] = """
SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, o_totalprice / 100000 AS dividend, o_totalprice / 50000 AS yield FROM orders"""


def dividend_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("id"),
        (F.col("o_totalprice") / 100000).alias("dividend"), (F.col("o_totalprice") / 50000).alias("yield"),
    )


def newest():
    return [F.desc("date"), F.asc("id")]


@query("H1_dividends_calendar", "SELECT * FROM dividend_rows WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' AND yield > 5")
def h1(spark, sf):
    return H.dividends(dividend_rows(spark, sf), lo="1997-01-01", hi="1998-12-31", min_yield=5)


@query("H1_dividends_company", "SELECT * FROM dividend_rows QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC, id) <= 5")
def h1c(spark, sf):
    return H.dividends(dividend_rows(spark, sf), limit=5, order=newest())


CTES["earning_rows"] = """
SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice / 1000 END AS "epsActual",
       (o_orderkey % 500)::DOUBLE AS "epsEstimated" FROM orders"""
CTES["earnings_full"] = 'SELECT *, "epsActual" - "epsEstimated" AS surprise, "epsActual" IS NULL AS upcoming FROM earning_rows'


def earning_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice") / 1000).alias("epsActual"),
        (F.col("o_orderkey") % 500).cast("double").alias("epsEstimated"),
    )


@query("H2_earnings_calendar", "SELECT * FROM earnings_full WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'", r6="surprise")
def h2(spark, sf):
    return H.earnings(earning_rows(spark, sf), lo="1997-01-01", hi="1998-12-31")


@query("H2_earnings_company", "SELECT * FROM earnings_full QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC, id) <= 5", r6="surprise")
def h2c(spark, sf):
    return H.earnings(earning_rows(spark, sf), limit=5, order=newest())


CTES["ipo_rows"] = """
SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS date, CASE o_orderstatus WHEN 'O' THEN 'calendar' WHEN 'P' THEN 'disclosure' ELSE 'prospectus' END AS kind,
       o_totalprice / 1000 AS "pricePublicPerShare", 1000 + o_orderkey % 7 AS shares, o_totalprice AS "pricePublicTotal" FROM orders"""


def ipo_rows(spark, sf):
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"),
        F.when(s == "O", "calendar").when(s == "P", "disclosure").otherwise("prospectus").alias("kind"),
        (F.col("o_totalprice") / 1000).alias("pricePublicPerShare"), (1000 + F.col("o_orderkey") % 7).alias("shares"),
        F.col("o_totalprice").alias("pricePublicTotal"),
    )


def _ipos(kind: str) -> None:
    extra = ', abs("pricePublicPerShare" * shares - "pricePublicTotal") <= 0.01 * shares AS "totalAgrees"' if kind == "prospectus" else ""

    @query(f"H3_ipos_{kind}", f"SELECT *{extra} FROM ipo_rows WHERE kind = '{kind}' AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'")
    def run(spark, sf):
        return H.ipos(ipo_rows(spark, sf), kind, "1996-01-01", "2000-12-31")


for _k in H.IPO_KINDS:
    _ipos(_k)


CTES["split_rows"] = """
SELECT l_partkey AS symbol, CAST(l_shipdate AS DATE) AS date, l_orderkey AS id, l_suppkey AS s, l_quantity AS q, CAST(l_linenumber AS BIGINT) AS numerator,
       CAST(l_tax * 100 AS BIGINT) AS denominator FROM lineitem"""


def split_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").alias("s"), F.col("l_quantity").alias("q"), F.col("l_linenumber").cast("bigint").alias("numerator"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("denominator"),
    )


SPLIT = "SELECT *, numerator / nullif(denominator, 0) AS ratio FROM split_rows "


@query("H4_splits_calendar", SPLIT + "WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'", r6="ratio")
def h4(spark, sf):
    return H.splits(split_rows(spark, sf), lo="1997-01-01", hi="1998-12-31")


@query(
    "H4_splits_company",
    SPLIT + "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC, id, s, q, numerator, denominator) <= 5",
    r6="ratio",
)
def h4c(spark, sf):
    order = [F.desc("date"), *[F.asc(c) for c in ("id", "s", "q", "numerator", "denominator")]]
    return H.splits(split_rows(spark, sf), limit=5, order=order)


CTES["calendar_events"] = """
SELECT 'dividends' AS kind, date FROM dividend_rows UNION ALL SELECT 'earnings', date FROM earning_rows
UNION ALL SELECT 'ipos', date FROM ipo_rows WHERE kind = 'calendar' UNION ALL SELECT 'splits', date FROM split_rows"""


@query(
    "H5_calendar_summary",
    """SELECT kind, horizon, count(*) AS events FROM (
  SELECT kind, CASE WHEN date - DATE '1998-04-01' <= 30 THEN '30d' ELSE '90d' END AS horizon FROM calendar_events
  WHERE date - DATE '1998-04-01' BETWEEN 0 AND 90) GROUP BY GROUPING SETS ((kind, horizon), (kind), ())""",
)
def h5(spark, sf):
    events = H.combined({
        "dividends": dividend_rows(spark, sf), "earnings": earning_rows(spark, sf),
        "ipos": ipo_rows(spark, sf).filter("kind = 'calendar'"), "splits": split_rows(spark, sf),
    })
    return H.calendar_summary(events, "1998-04-01")

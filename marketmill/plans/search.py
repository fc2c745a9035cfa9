"""C and N9: searches, screens, universes, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.functions.scalars import transaction_bucket
from marketmill.operators import insiders as K
from marketmill.operators import news as W
from marketmill.operators import search as C
from marketmill.session import fresh_path
from marketmill.sources import textindex as X

from .registry import CTES, query
from .tables import companies, insider, news, securities, table, transcripts


@query(
    "C1_search_symbols",
    """SELECT * FROM companies WHERE starts_with(CAST(symbol AS VARCHAR), '7') OR contains(lower(name), '7')
ORDER BY CASE WHEN CAST(symbol AS VARCHAR) = '7' THEN 0 WHEN starts_with(CAST(symbol AS VARCHAR), '7') THEN 1 ELSE 2 END, symbol LIMIT 15""",
)
def c1(spark, sf):
    return C.search_symbols(companies(spark, sf), "7", 15)


@query("C2_search_companies", "SELECT * FROM securities WHERE contains(lower(name), 'ring')")
def c2(spark, sf):
    return C.search_companies(securities(spark, sf), "RING")


CTES["screenable"] = """
SELECT symbol, name AS "companyName", price * shares AS "marketCap", sector, industry, price, shares AS volume,
       shares % 7 = 0 AS "isEtf", true AS "isActivelyTrading" FROM securities"""


def screenable(spark, sf):
    return securities(spark, sf).select(
        "symbol", F.col("name").alias("companyName"), (F.col("price") * F.col("shares")).alias("marketCap"), "sector",
        "industry", "price", F.col("shares").alias("volume"), (F.col("shares") % 7 == 0).alias("isEtf"),
        F.lit(True).alias("isActivelyTrading"),
    )


@query(
    "C3_screen",
    """SELECT * FROM screenable WHERE "marketCap" > 5e9 AND "marketCap" < 4e10 AND price > 950 AND volume < 45000000
  AND sector = 'ECONOMY' AND NOT "isEtf" AND "isActivelyTrading" """,
)
def c3(spark, sf):
    return C.screen(
        screenable(spark, sf), market_cap_more_than=5e9, market_cap_lower_than=4e10, price_more_than=950,
        volume_lower_than=45000000, sector="ECONOMY", is_etf=False, is_actively_trading=True,
    )


@query(
    "C3_screen_one_class",
    """SELECT * FROM (SELECT * FROM screenable WHERE price > 950
  QUALIFY row_number() OVER (PARTITION BY "companyName" ORDER BY "marketCap" DESC, symbol) = 1)""",
)
def c3o(spark, sf):
    return C.screen(screenable(spark, sf), include_all_share_classes=False, price_more_than=950)


@query(
    "C3_screen_unnamed",
    """WITH s AS (SELECT * REPLACE (CASE WHEN price <= 1100 THEN "companyName" END AS "companyName") FROM screenable WHERE price > 950)
SELECT * FROM s WHERE "companyName" IS NULL UNION ALL SELECT * FROM (SELECT * FROM s WHERE "companyName" IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY "companyName" ORDER BY "marketCap" DESC, symbol) = 1)""",
)
def c3u(spark, sf):
    """Rows without a company name are companies of their own."""
    df = screenable(spark, sf).withColumn("companyName", F.when(F.col("price") <= 1100, F.col("companyName")))
    return C.screen(df, include_all_share_classes=False, price_more_than=950)


CTES["listings"] = """
SELECT p_partkey AS id, CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 'A' || p_partkey WHEN 2 THEN 'B' || p_partkey || '.HK'
       WHEN 3 THEN '0P' || p_partkey ELSE NULL END AS symbol,
       CASE p_partkey % 4 WHEN 0 THEN 'usd' WHEN 1 THEN '  ' WHEN 2 THEN 'EUR' ELSE NULL END AS currency FROM part"""


def listings(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size") % 5
    ks = k.cast("string")
    symbol = (
        F.when(s == 0, "").when(s == 1, F.concat(F.lit("A"), ks)).when(s == 2, F.concat(F.lit("B"), ks, F.lit(".HK")))
        .when(s == 3, F.concat(F.lit("0P"), ks))
    )
    currency = F.when(k % 4 == 0, "usd").when(k % 4 == 1, "  ").when(k % 4 == 2, "EUR")
    return table(spark, sf, "part").select(k.alias("id"), symbol.alias("symbol"), currency.alias("currency"))


@query(
    "C4_us_only",
    """SELECT * FROM listings WHERE symbol <> '' AND NOT contains(symbol, '.') AND NOT starts_with(symbol, '0P')
  AND (currency IS NULL OR trim(currency) = '' OR upper(currency) = 'USD')""",
)
def c4(spark, sf):
    return C.us_only(listings(spark, sf))


CTES["asked"] = """
SELECT event_id AS id, CASE WHEN event_type = 'error' THEN '  ' ELSE ' s' || CAST(user_id AS VARCHAR) || ' ' END AS symbol,
       CASE event_type WHEN 'view' THEN '2024-99-99' WHEN 'click' THEN '2024/01/01' WHEN 'signup' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS date,
       user_id * 100 AS "limit", CAST(user_id % 7 - 1 AS INTEGER) AS page FROM events"""


def asked(spark, sf):
    t, u = F.col("event_type"), F.col("user_id")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.when(t == "error", "  ").otherwise(F.concat(F.lit(" s"), u.cast("string"), F.lit(" "))).alias("symbol"),
        F.when(t == "view", "2024-99-99").when(t == "click", "2024/01/01").when(t == "signup", "")
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"),
        (u * 100).alias("limit"), (u % 7 - 1).cast("int").alias("page"),
    )


REASONS = """CASE WHEN trim(symbol) = '' THEN 'symbol,' ELSE '' END || CASE WHEN date LIKE '%/%' THEN 'date,' ELSE '' END ||
  CASE WHEN "limit" NOT BETWEEN 1 AND 10000 THEN 'limit,' ELSE '' END || CASE WHEN page < 0 THEN 'page,' ELSE '' END"""


@query(
    "C5_quarantine_valid",
    f"SELECT id, upper(trim(symbol)) AS symbol, nullif(date, '') AS date, \"limit\", page FROM asked WHERE {REASONS} = ''",
)
def c5(spark, sf):
    return C.quarantine(asked(spark, sf))[0]


@query("C5_quarantine_rejected", f"SELECT *, {REASONS} AS reasons FROM asked WHERE {REASONS} <> ''")
def c5r(spark, sf):
    rejected = C.quarantine(asked(spark, sf))[1]
    return rejected.withColumn("reasons", F.concat(F.array_join("reasons", ","), F.lit(",")))


@query(
    "C6_insider_search",
    """SELECT * FROM insider WHERE "transactionType" = 'S-Sale' AND symbol = '7'""",
)
def c6(spark, sf):
    return K.insider_search(insider(spark, sf), symbol="7", transaction_type="S-Sale")


@query("C7_search_by_name", "SELECT * FROM customer WHERE contains(lower(c_name || ' ' || c_mktsegment), '7 build')")
def c7(spark, sf):
    return C.search_by_name(table(spark, sf, "customer"), "7 BUILD", ["c_name", "c_mktsegment"])


CTES["deals"] = """
SELECT CAST(o_custkey AS VARCHAR) AS symbol, c_name AS "companyName", n_name AS "targetedCompanyName", CAST(c_nationkey AS VARCHAR) AS "targetedSymbol",
       CAST(o_orderdate AS DATE) AS "transactionDate", 'deal/' || CAST(o_orderkey AS VARCHAR) AS link
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def deals(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("o_custkey").cast("string").alias("symbol"), F.col("c_name").alias("companyName"),
        F.col("n_name").alias("targetedCompanyName"), F.col("c_nationkey").cast("string").alias("targetedSymbol"),
        F.to_date("o_orderdate").alias("transactionDate"),
        F.concat(F.lit("deal/"), F.col("o_orderkey").cast("string")).alias("link"),
    )


@query("C8_mergers_search", "SELECT * FROM deals WHERE contains(lower(\"companyName\"), 'nation_7') OR contains(lower(\"targetedCompanyName\"), 'nation_7')")
def c8(spark, sf):
    return C.mergers(deals(spark, sf), "Nation_7")


@query(
    "C8_mergers_latest",
    'SELECT * FROM deals ORDER BY "transactionDate" DESC, symbol, "targetedSymbol", link LIMIT 100 OFFSET 100',
)
def c8l(spark, sf):
    return C.mergers(deals(spark, sf), page=1)


@query("C9_universe_companies", "SELECT DISTINCT symbol, name FROM companies")
def c9(spark, sf):
    return C.universe(companies(spark, sf), ["symbol", "name"])


@query("C9_universe_etfs", "SELECT DISTINCT symbol, name FROM securities WHERE sector = 'PROMO'")
def c9e(spark, sf):
    return C.universe(securities(spark, sf), ["symbol", "name"], F.col("sector") == "PROMO")


@query("C9_universe_transcripts", "SELECT symbol, count(DISTINCT conv_id) AS transcripts FROM transcripts GROUP BY 1")
def c9t(spark, sf):
    return C.transcript_symbols(transcripts(spark, sf))


@query(
    "C9_universe_forex",
    """SELECT DISTINCT pair AS symbol, substr(pair, 1, 3) AS "fromCurrency", substr(pair, 4, 3) AS "toCurrency" FROM (
  SELECT 'C' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || 'C' || lpad(CAST(c_custkey % 25 AS VARCHAR), 2, '0') AS pair FROM customer)""",
)
def c9f(spark, sf):
    def code(c):
        return F.concat(F.lit("C"), F.lpad(c.cast("string"), 2, "0"))

    pairs = table(spark, sf, "customer").select(F.concat(code(F.col("c_nationkey")), code(F.col("c_custkey") % 25)).alias("pair"))
    return C.forex_pairs(pairs)


@query("C9_universe_statements", "SELECT DISTINCT l_suppkey AS symbol FROM lineitem")
def c9s(spark, sf):
    return C.universe(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("symbol")), ["symbol"])


@query("C9_universe_active", 'SELECT DISTINCT symbol, "companyName" FROM screenable WHERE "isActivelyTrading"')
def c9a(spark, sf):
    return C.universe(screenable(spark, sf), ["symbol", "companyName"], F.col("isActivelyTrading"))


def _universe(name: str, sector: str) -> None:
    @query(f"C9_universe_{name}", f"SELECT DISTINCT symbol, name FROM securities WHERE sector = '{sector}'")
    def run(spark, sf):
        return C.universe(securities(spark, sf), ["symbol", "name"], F.col("sector") == sector)


for _name, _sector in (("commodities", "STANDARD"), ("crypto", "SMALL"), ("indexes", "LARGE")):
    _universe(_name, _sector)


def _domain(table_name: str, col: str) -> None:
    @query(f"C10_domain_{col}", f"SELECT DISTINCT {col} FROM {table_name} WHERE {col} IS NOT NULL")
    def run(spark, sf):
        return C.domain(table(spark, sf, table_name), col)


for _t, _col in (("region", "r_name"), ("nation", "n_name"), ("part", "p_type"), ("part", "p_brand"), ("lineitem", "l_returnflag")):
    _domain(_t, _col)


@query(
    "C11_active_share",
    """SELECT count(*) AS total, count(*) FILTER (s IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) AS active,
       count(*) FILTER (s IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) / count(*) * 100 AS "activePercent"
FROM (SELECT c_custkey AS s FROM customer)""",
    r6="activePercent",
)
def c11(spark, sf):
    everything = table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol"))
    active = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("symbol"))
    return C.active_share(everything, active)


@query("C12_top_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def c12(spark, sf):
    return C.top_counts(table(spark, sf, "part"), "p_brand", 10)


@query(
    "C13_list_by",
    """SELECT exchange, string_agg(country, ', ' ORDER BY country) AS items FROM (SELECT DISTINCT exchange, country FROM companies) GROUP BY 1""",
)
def c13(spark, sf):
    return C.list_by(companies(spark, sf), "exchange", "country")


@query(
    "C14_transaction_bucket",
    """SELECT CASE "transactionType" WHEN 'P-Purchase' THEN 'Acquisitions' WHEN 'S-Sale' THEN 'Dispositions' ELSE 'Awards' END AS bucket,
       count(*) AS n FROM insider GROUP BY 1""",
)
def c14(spark, sf):
    return insider(spark, sf).groupBy(transaction_bucket("transactionType").alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "N9_summary_stats",
    """SELECT event_type, CASE WHEN count(v) = 0 THEN count(*) ELSE count(v) END AS count, min(v) AS min, max(v) AS max, avg(v) AS avg
FROM (SELECT event_type, CASE WHEN event_type <> 'view' AND value > 5 THEN value END AS v FROM events) GROUP BY 1""",
    r6="avg",
)
def n9(spark, sf):
    keep = (F.col("event_type") != "view") & (F.col("value") > 5)
    e = table(spark, sf, "events").select("event_type", F.when(keep, F.col("value")).alias("v"))
    return C.summary_stats(e, "v", ["event_type"])


# Searches that read the blocks of an index only; the same answers as without it.


def _indexed(spark, df, fields, order, wanted):
    path = fresh_path(spark, "text-index")
    X.write_index(df, path, fields, order, block_rows=256)
    return X.narrowed(spark, path, wanted)


@query(
    "C1_search_symbols_indexed",
    "SELECT * FROM companies WHERE starts_with(CAST(symbol AS VARCHAR), '0011') OR contains(lower(name), '0011')",
)
def c1x(spark, sf):
    text = "0011"
    symbol = F.col("symbol").cast("string")
    fields = {"symbol": X.starts(symbol), "name": X.contains(F.col("name"))}
    some = _indexed(spark, companies(spark, sf), fields, [F.lower("name")], [("symbol", X.START + text), ("name", text)])
    return C.search_symbols(some, text)


@query("C2_search_companies_indexed", "SELECT * FROM securities WHERE contains(lower(name), 'ring')")
def c2x(spark, sf):
    some = _indexed(spark, securities(spark, sf), {"name": X.contains(F.col("name"))}, [F.lower("name")], [("name", "RING")])
    return C.search_companies(some, "RING")


@query("C7_search_by_name_indexed", "SELECT * FROM customer WHERE contains(lower(c_name || ' ' || c_mktsegment), '7 build')")
def c7x(spark, sf):
    full = X.contains(F.concat_ws(" ", "c_name", "c_mktsegment"))
    some = _indexed(spark, table(spark, sf, "customer"), {"full": full}, [F.col("c_mktsegment"), F.col("c_name")], [("full", "7 BUILD")])
    return C.search_by_name(some, "7 BUILD", ["c_name", "c_mktsegment"])


@query(
    "C8_mergers_search_indexed",
    "SELECT * FROM deals WHERE contains(lower(\"companyName\"), 'nation_7') OR contains(lower(\"targetedCompanyName\"), 'nation_7')",
)
def c8x(spark, sf):
    fields = {c: X.contains(F.col(c)) for c in ("companyName", "targetedCompanyName")}
    wanted = [(c, "Nation_7") for c in fields]
    return C.mergers(_indexed(spark, deals(spark, sf), fields, [F.col("targetedCompanyName"), F.col("companyName")], wanted), "Nation_7")


@query(
    "N8_news_search_indexed",
    """SELECT * FROM news WHERE list_has_any(string_split(symbols, ','), ['S7', 'S14', 'S140'])""",
)
def n8x(spark, sf):
    asked = ["S7", "S14", "S140"]
    fields, wanted = {"symbols": X.words(F.col("symbols"))}, [("symbols", f"{X.START}{s}{X.START}") for s in asked]
    return W.news_search(_indexed(spark, news(spark, sf), fields, [F.col("symbols")], wanted), ",".join(asked))

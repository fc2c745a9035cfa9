"""Test views: the driver tables seen as ticks, statements, filings and so on.

Every view exists twice with the same definition, as a DataFrame function here
and as a named sub-query for the check SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.functions.scalars import quarter_end

from .registry import CTES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CTES["ticks"] = """
SELECT user_id AS symbol, ts, value AS price, CAST(json_extract(props, '$.k') AS BIGINT) AS size,
       event_type AS venue, event_id AS id
FROM events"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("symbol"),
        "ts",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
        F.col("event_type").alias("venue"),
        F.col("event_id").alias("id"),
    )


CTES["bars"] = """
SELECT symbol, CAST(ts AS DATE) AS date, arg_min(price, (ts, id)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, (ts, id)) AS close, CAST(sum(size) AS BIGINT) AS volume
FROM ticks GROUP BY ALL"""

CTES["securities"] = """
SELECT p_partkey AS symbol, p_name AS name, p_type AS sector, p_brand AS industry, p_retailprice AS price,
       CAST(p_size AS BIGINT) * 1000000 AS shares
FROM part"""


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("sector"),
        F.col("p_brand").alias("industry"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size").cast("bigint") * 1000000).alias("shares"),
    )


CTES["companies"] = """
SELECT s_suppkey AS symbol, s_name AS name, n_name AS country, r_name AS exchange, s_acctbal AS cash
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("s_suppkey").alias("symbol"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("exchange"),
            F.col("s_acctbal").alias("cash"),
        )
    )


CTES["line_orders"] = """
SELECT l.*, o.*, CAST(l_shipdate AS DATE) AS shipdate, CAST(o_orderdate AS DATE) AS orderdate
FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey"""


def line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return l.join(o, l.l_orderkey == o.o_orderkey).withColumns(
        {"shipdate": F.to_date("l_shipdate"), "orderdate": F.to_date("o_orderdate")}
    )


CTES["insider"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(o_custkey AS VARCHAR) AS "reportingCik",
       CAST(l_suppkey AS VARCHAR) AS "companyCik", shipdate AS "filingDate", orderdate AS "transactionDate",
       CASE l_returnflag WHEN 'R' THEN 'P-Purchase' WHEN 'A' THEN 'S-Sale' ELSE 'A-Award' END AS "transactionType",
       CASE WHEN l_returnflag = 'A' THEN 'D' ELSE 'A' END AS "acquisitionOrDisposition",
       CAST(l_quantity AS BIGINT) AS "securitiesTransacted", l_extendedprice / l_quantity AS price,
       l_orderkey AS "orderKey", l_linenumber AS "lineNumber", l_partkey AS "partKey"
FROM line_orders"""


def insider(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return line_orders(spark, sf_dir).select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("o_custkey").cast("string").alias("reportingCik"),
        F.col("l_suppkey").cast("string").alias("companyCik"),
        F.col("shipdate").alias("filingDate"),
        F.col("orderdate").alias("transactionDate"),
        F.when(flag == "R", "P-Purchase").when(flag == "A", "S-Sale").otherwise("A-Award").alias("transactionType"),
        F.when(flag == "A", "D").otherwise("A").alias("acquisitionOrDisposition"),
        F.col("l_quantity").cast("bigint").alias("securitiesTransacted"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_orderkey").alias("orderKey"),
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_partkey").alias("partKey"),
    )


#: Total order of the insider feed: newest filing first, then every other column.
INSIDER_ORDER_SQL = (
    '"filingDate" DESC, symbol, "transactionType", "orderKey", "lineNumber", "partKey", '
    '"securitiesTransacted", price'
)


def insider_order() -> list:
    rest = ["symbol", "transactionType", "orderKey", "lineNumber", "partKey", "securitiesTransacted", "price"]
    return [F.desc_nulls_last("filingDate"), *[F.asc(c) for c in rest]]


CTES["facts"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS subject, l_returnflag AS predicate, l_extendedprice AS value,
       CAST(last_day(date_trunc('quarter', orderdate) + INTERVAL 2 MONTH) AS DATE) AS valid_from,
       l_shipdate AS published_at, CAST(l_linenumber AS BIGINT) AS source_id
FROM line_orders"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_orders(spark, sf_dir).select(
        F.col("l_suppkey").cast("string").alias("subject"),
        F.col("l_returnflag").alias("predicate"),
        F.col("l_extendedprice").alias("value"),
        quarter_end(F.col("orderdate")).alias("valid_from"),
        F.col("l_shipdate").alias("published_at"),
        F.col("l_linenumber").cast("bigint").alias("source_id"),
    )


CTES["grades"] = """
SELECT CAST(o_custkey AS VARCHAR) AS symbol, 'F' || CAST(o_orderkey % 20 AS VARCHAR) AS "gradingCompany",
       CAST(o_orderdate AS DATE) AS date, o_orderkey AS id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'strongBuy' WHEN '2' THEN 'buy' WHEN '3' THEN 'hold'
            WHEN '4' THEN 'sell' ELSE 'strongSell' END AS "newGrade",
       o_totalprice AS "priceTarget", 'analyst ' || CAST(o_orderkey % 97 AS VARCHAR) AS "analystName"
FROM orders"""


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"),
        F.concat(F.lit("F"), (F.col("o_orderkey") % 20).cast("string")).alias("gradingCompany"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderkey").alias("id"),
        F.when(p == "1", "strongBuy").when(p == "2", "buy").when(p == "3", "hold").when(p == "4", "sell")
        .otherwise("strongSell").alias("newGrade"),
        F.col("o_totalprice").alias("priceTarget"),
        F.concat(F.lit("analyst "), (F.col("o_orderkey") % 97).cast("string")).alias("analystName"),
    )


CTES["holdings"] = """
SELECT CAST(c_nationkey AS VARCHAR) AS cik, p_type || '-' || CAST(CAST(substr(p_brand, 7) AS INTEGER) % 5 AS VARCHAR) AS symbol,
       p_type AS industry, CAST(last_day(date_trunc('quarter', orderdate) + INTERVAL 2 MONTH) AS DATE) AS date,
       CAST(l_quantity AS BIGINT) AS shares, l_extendedprice AS value,
       CASE l_returnflag WHEN 'R' THEN 'Put' WHEN 'A' THEN 'Call' ELSE 'Share' END AS "putCallShare",
       CAST(l_suppkey AS VARCHAR) AS "securityCusip", shipdate AS "filingDate"
FROM line_orders JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey"""

CTES["outstanding"] = """
SELECT p_type || '-' || CAST(CAST(substr(p_brand, 7) AS INTEGER) % 5 AS VARCHAR) AS symbol,
       CAST(sum(p_size) AS BIGINT) * 100 AS outstanding
FROM part GROUP BY 1"""


def _issue() -> F.Column:
    return F.concat_ws("-", "p_type", (F.substring("p_brand", 7, 10).cast("int") % 5).cast("string"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = line_orders(spark, sf_dir)
    c, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    flag = F.col("l_returnflag")
    return (
        lo.join(c, lo.o_custkey == c.c_custkey)
        .join(p, lo.l_partkey == p.p_partkey)
        .select(
            F.col("c_nationkey").cast("string").alias("cik"),
            _issue().alias("symbol"),
            F.col("p_type").alias("industry"),
            quarter_end(F.col("orderdate")).alias("date"),
            F.col("l_quantity").cast("bigint").alias("shares"),
            F.col("l_extendedprice").alias("value"),
            F.when(flag == "R", "Put").when(flag == "A", "Call").otherwise("Share").alias("putCallShare"),
            F.col("l_suppkey").cast("string").alias("securityCusip"),
            F.col("shipdate").alias("filingDate"),
        )
    )


def outstanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .groupBy(_issue().alias("symbol"))
        .agg((F.sum("p_size").cast("bigint") * 100).alias("outstanding"))
    )


CTES["fund"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_partkey AS VARCHAR) AS asset, p_name AS name,
       CAST(l_quantity AS BIGINT) AS shares, l_extendedprice AS value, p_type AS sector, n_name AS country,
       CAST(o_custkey AS VARCHAR) AS holder, shipdate AS date, l_orderkey AS "orderKey"
FROM line_orders JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey"""


def fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = line_orders(spark, sf_dir)
    p, c, n = (table(spark, sf_dir, t) for t in ("part", "customer", "nation"))
    return (
        lo.join(p, lo.l_partkey == p.p_partkey)
        .join(c, lo.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .select(
            F.col("l_suppkey").cast("string").alias("symbol"),
            F.col("l_partkey").cast("string").alias("asset"),
            F.col("p_name").alias("name"),
            F.col("l_quantity").cast("bigint").alias("shares"),
            F.col("l_extendedprice").alias("value"),
            F.col("p_type").alias("sector"),
            F.col("n_name").alias("country"),
            F.col("o_custkey").cast("string").alias("holder"),
            F.col("shipdate").alias("date"),
            F.col("l_orderkey").alias("orderKey"),
        )
    )


CTES["cot"] = """
SELECT p_type AS symbol, CAST(date_trunc('week', orderdate) AS DATE) AS date,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'noncomm'
            WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 'comm' ELSE 'nonrept' END AS class,
       CASE l_returnflag WHEN 'R' THEN 'long' WHEN 'A' THEN 'short' ELSE 'spread' END AS side,
       CAST(l_quantity AS BIGINT) AS contracts
FROM line_orders JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey"""


def cot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = line_orders(spark, sf_dir)
    c, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    seg, flag = F.col("c_mktsegment"), F.col("l_returnflag")
    return (
        lo.join(c, lo.o_custkey == c.c_custkey)
        .join(p, lo.l_partkey == p.p_partkey)
        .select(
            F.col("p_type").alias("symbol"),
            F.to_date(F.date_trunc("week", "orderdate")).alias("date"),
            F.when(seg.isin("AUTOMOBILE", "BUILDING"), "noncomm")
            .when(seg.isin("FURNITURE", "MACHINERY"), "comm")
            .otherwise("nonrept").alias("class"),
            F.when(flag == "R", "long").when(flag == "A", "short").otherwise("spread").alias("side"),
            F.col("l_quantity").cast("bigint").alias("contracts"),
        )
    )


CTES["macro"] = """
SELECT event_type AS name, CAST(ts AS DATE) AS date, avg(value) AS value FROM events GROUP BY ALL"""


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("name"), F.to_date("ts").alias("date"))
        .agg(F.avg("value").alias("value"))
    )


CTES["news"] = """
SELECT doc_id AS id, CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS DATE) AS "publishedDate", source AS site,
       lang AS variant, 'S' || CAST(doc_id % 150 AS VARCHAR) || ',S' || CAST((doc_id * 7) % 150 AS VARCHAR) AS symbols,
       substr(text, 1, 60) AS title, text
FROM documents"""


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        i.alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 365).cast("int")).alias("publishedDate"),
        F.col("source").alias("site"),
        F.col("lang").alias("variant"),
        F.concat(F.lit("S"), (i % 150).cast("string"), F.lit(",S"), (i * 7 % 150).cast("string")).alias("symbols"),
        F.substring("text", 1, 60).alias("title"),
        "text",
    )


CTES["transcripts"] = "SELECT 'S' || CAST(conv_id % 150 AS VARCHAR) AS symbol, conv_id, turn, role FROM conversations"


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("S"), (F.col("conv_id") % 150).cast("string")).alias("symbol"), "conv_id", "turn", "role"
    )


CTES["stmt"] = """
SELECT l_suppkey AS symbol, CAST(last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS DATE) AS date,
       sum(l_extendedprice * (1 - l_discount)) AS revenue, sum(l_quantity * p_retailprice * 0.6) AS "costOfRevenue",
       sum(l_extendedprice * l_discount) AS "operatingExpenses", sum(l_extendedprice * (1 - l_discount) * l_tax) AS "incomeTaxExpense",
       sum(l_quantity * 10) AS depreciation, -sum(CASE WHEN l_returnflag = 'A' THEN l_quantity * 100 ELSE 0 END) AS "capitalExpenditure",
       sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice * 0.1 ELSE 0 END) AS "changeInReceivables",
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity * 100 ELSE 0 END) AS "changeInInventories",
       sum(CASE WHEN l_returnflag = 'N' THEN l_quantity * 150 ELSE 0 END) AS "changeInPayables",
       sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice * 0.05 ELSE 0 END) AS "changeInDebt"
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


def stmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    ext, disc, qty, flag = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_quantity", "l_returnflag"))
    net = ext * (1 - disc)

    def when(cond, x):
        return F.sum(F.when(cond, x).otherwise(0.0))

    return (
        li.join(p, li.l_partkey == p.p_partkey)
        .groupBy(F.col("l_suppkey").alias("symbol"), quarter_end(F.to_date("l_shipdate")).alias("date"))
        .agg(
            F.sum(net).alias("revenue"),
            F.sum(qty * F.col("p_retailprice") * 0.6).alias("costOfRevenue"),
            F.sum(ext * disc).alias("operatingExpenses"),
            F.sum(net * F.col("l_tax")).alias("incomeTaxExpense"),
            F.sum(qty * 10).alias("depreciation"),
            (-when(flag == "A", qty * 100)).alias("capitalExpenditure"),
            when(F.col("l_linestatus") == "O", ext * 0.1).alias("changeInReceivables"),
            when(flag == "R", qty * 100).alias("changeInInventories"),
            when(flag == "N", qty * 150).alias("changeInPayables"),
            when(flag == "A", ext * 0.05).alias("changeInDebt"),
        )
    )


CTES["px_hist"] = """
SELECT p_partkey AS symbol, DATE '1994-12-31' AS date, p_retailprice AS price, CAST(p_size AS BIGINT) * 100 AS shares FROM part
UNION ALL SELECT p_partkey, DATE '1998-01-01', p_retailprice * 1.1, CAST(p_size AS BIGINT) * 100 + 50 FROM part"""


def px_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k, price, n = F.col("p_partkey").alias("symbol"), F.col("p_retailprice"), F.col("p_size").cast("bigint") * 100
    day = lambda d: F.lit(d).cast("date").alias("date")
    first = p.select(k, day("1994-12-31"), price.alias("price"), n.alias("shares"))
    return first.unionByName(p.select(k, day("1998-01-01"), (price * 1.1).alias("price"), (n + 50).alias("shares")))

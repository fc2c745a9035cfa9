"""D: bars, quotes and price analyses over the ``ticks`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.operators import prices as P

from .registry import CTES, query
from .tables import securities, table, ticks


def bars(spark, sf) -> DataFrame:
    return P.bars_eod(ticks(spark, sf))


CTES["bars_full"] = """
SELECT *, close - open AS change, (close - open) / nullif(open, 0) * 100 AS "changePercent",
       (high + low + close) / 3 AS vwap FROM bars"""

CTES["splits"] = """
SELECT p_partkey AS symbol, CAST(DATE '2024-01-01' + p_size % 30 AS DATE) AS date,
       CAST(1 + p_size % 4 AS BIGINT) AS numerator, CAST(1 + p_partkey % 2 AS BIGINT) AS denominator FROM part
UNION ALL
SELECT c_custkey, CAST(DATE '2024-01-01' + c_nationkey AS DATE), CAST(3 AS BIGINT), CAST(2 AS BIGINT) FROM customer"""


def _day(offset) -> F.Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), offset.cast("int"))


def splits(spark, sf) -> DataFrame:
    a = table(spark, sf, "part").select(
        F.col("p_partkey").alias("symbol"),
        _day(F.col("p_size") % 30).alias("date"),
        (1 + F.col("p_size") % 4).cast("bigint").alias("numerator"),
        (1 + F.col("p_partkey") % 2).cast("bigint").alias("denominator"),
    )
    b = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("symbol"),
        _day(F.col("c_nationkey")).alias("date"),
        F.lit(3).cast("bigint").alias("numerator"),
        F.lit(2).cast("bigint").alias("denominator"),
    )
    return a.unionByName(b)


CTES["dividends"] = """
SELECT o_custkey AS symbol, CAST(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS DATE) AS date,
       o_totalprice / 1e7 AS dividend FROM orders"""


def dividends(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("symbol"),
        _day(F.col("o_orderkey") % 30).alias("date"),
        (F.col("o_totalprice") / 1e7).alias("dividend"),
    )


CTES["share_counts"] = """
SELECT symbol, DATE '2023-12-31' AS date, shares FROM securities
UNION ALL SELECT symbol, DATE '2024-01-15', shares + 1000000 FROM securities"""


def share_counts(spark, sf) -> DataFrame:
    s = securities(spark, sf)
    first = s.select("symbol", F.lit("2023-12-31").cast("date").alias("date"), "shares")
    return first.unionByName(
        s.select("symbol", F.lit("2024-01-15").cast("date").alias("date"), (F.col("shares") + 1000000).alias("shares"))
    )


CTES["class_bars"] = """
SELECT venue AS "assetClass", symbol, CAST(ts AS DATE) AS date, arg_min(price, (ts, id)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, (ts, id)) AS close, CAST(sum(size) AS BIGINT) AS volume
FROM ticks GROUP BY ALL"""


def class_bars(spark, sf) -> DataFrame:
    """One physical bar table for all asset classes; the venue stands for the class."""
    return P.bars_eod(ticks(spark, sf).withColumnRenamed("venue", "assetClass"), keys=("assetClass", "symbol"))


QUOTE_COLS = """max(date) AS date, max(CASE WHEN rn = 1 THEN close END) AS price,
       max(CASE WHEN rn = 1 THEN open END) AS open, max(CASE WHEN rn = 1 THEN volume END) AS volume,
       max(CASE WHEN rn = 1 THEN low END) AS "dayLow", max(CASE WHEN rn = 1 THEN high END) AS "dayHigh",
       max(CASE WHEN rn = 2 THEN close END) AS "previousClose",
       max(CASE WHEN date > last - INTERVAL 12 MONTH THEN high END) AS "yearHigh",
       min(CASE WHEN date > last - INTERVAL 12 MONTH THEN low END) AS "yearLow",
       avg(CASE WHEN rn <= 50 THEN close END) AS "priceAvg50",
       avg(CASE WHEN rn <= 200 THEN close END) AS "priceAvg200" """

CTES["quotes_base"] = f"""
SELECT symbol, {QUOTE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn,
         max(date) OVER (PARTITION BY symbol) AS last FROM bars) GROUP BY symbol"""

CTES["quotes"] = """
SELECT q.*, q.price - "previousClose" AS change, (q.price - "previousClose") / nullif("previousClose", 0) * 100 AS "changePercentage",
       CAST(epoch(q.date) AS BIGINT) AS timestamp, q.price * shares AS "marketCap"
FROM quotes_base q LEFT JOIN securities s ON q.symbol = s.symbol"""


def quotes(spark, sf) -> DataFrame:
    return P.quotes(bars(spark, sf), securities(spark, sf))


@query("D1_bars_eod", "SELECT * FROM bars_full", r6="change changePercent vwap")
def d1(spark, sf):
    return bars(spark, sf)


@query("D2_bars_light", "SELECT symbol, date, close AS price, volume FROM bars")
def d2(spark, sf):
    return P.bars_light(bars(spark, sf))


FACTOR_SQL = """SELECT b.symbol, b.date, {cols}, {vol} AS volume
FROM bars b, LATERAL (SELECT exp(coalesce(sum(ln(factor)), 0.0)) AS f FROM {fac} x
                      WHERE x.symbol = b.symbol AND x.date > b.date)"""
ADJ_COLS = ", ".join(f'{c} * f AS "adj{c.capitalize()}"' for c in ("open", "high", "low", "close"))
ADJ = "adjOpen adjHigh adjLow adjClose"


@query(
    "D3_unadjusted",
    "WITH fac AS (SELECT symbol, date, numerator / denominator AS factor FROM splits) "
    + FACTOR_SQL.format(cols=ADJ_COLS, fac="fac", vol="volume / f"),
    r6=ADJ + " volume",
)
def d3(spark, sf):
    return P.unadjust(bars(spark, sf), splits(spark, sf))


@query(
    "D4_dividend_adjusted",
    """WITH divs AS (SELECT symbol, date, sum(dividend) AS dividend FROM dividends GROUP BY ALL),
     ex AS (SELECT d.symbol, d.date, dividend, (SELECT arg_max(close, b.date) FROM bars b
                 WHERE b.symbol = d.symbol AND b.date < d.date) AS prev FROM divs d),
     fac AS (SELECT symbol, date, 1 - dividend / prev AS factor FROM ex WHERE 1 - dividend / prev > 0) """
    + FACTOR_SQL.format(cols=ADJ_COLS, fac="fac", vol="volume"),
    r6=ADJ,
)
def d4(spark, sf):
    return P.adjust_dividends(bars(spark, sf), dividends(spark, sf))


INTRADAY_SQL = """SELECT symbol, time_bucket(INTERVAL '{tf}', ts) AS date, arg_min(price, (ts, id)) AS open,
  min(price) AS low, max(price) AS high, arg_max(price, (ts, id)) AS close, CAST(sum(size) AS BIGINT) AS volume
FROM ticks GROUP BY 1, 2"""


def _intraday(tf: str):
    @query(f"D5_bars_intraday_{tf}", INTRADAY_SQL.format(tf=P.TIMEFRAMES[tf]))
    def d5(spark, sf):
        return P.bars_intraday(ticks(spark, sf), tf)


for _tf in P.TIMEFRAMES:
    _intraday(_tf)


@query(
    "D5_bars_intraday_nonadjusted",
    "WITH ib AS (" + INTRADAY_SQL.format(tf="1 hour") + """), fac AS (SELECT symbol, date, numerator / denominator AS factor FROM splits)
SELECT b.symbol, b.date, open * f AS open, high * f AS high, low * f AS low, close * f AS close, volume / f AS volume
FROM ib b, LATERAL (SELECT exp(coalesce(sum(ln(factor)), 0.0)) AS f FROM fac x
                    WHERE x.symbol = b.symbol AND x.date > CAST(b.date AS DATE))""",
    r6="open high low close volume",
)
def d5n(spark, sf):
    return P.bars_intraday(ticks(spark, sf), "1hour", splits(spark, sf))


QUOTE_R6 = "priceAvg50 priceAvg200 change changePercentage"


@query("D6_quotes", "SELECT * FROM quotes", r6=QUOTE_R6, r4="marketCap")
def d6(spark, sf):
    return quotes(spark, sf)


@query("D7_quotes_short", "SELECT symbol, price, change, volume FROM quotes", r6="change")
def d7(spark, sf):
    return P.quotes_short(P.quotes(bars(spark, sf)))


CLASS_QUOTES = f"""
SELECT *, price - "previousClose" AS change, (price - "previousClose") / nullif("previousClose", 0) * 100 AS "changePercentage",
       CAST(epoch(date) AS BIGINT) AS timestamp
FROM (SELECT "assetClass", symbol, {QUOTE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY "assetClass", symbol ORDER BY date DESC) AS rn,
         max(date) OVER (PARTITION BY "assetClass", symbol) AS last FROM class_bars) GROUP BY ALL)"""


@query("D8_quotes_batch", CLASS_QUOTES, r6=QUOTE_R6)
def d8(spark, sf):
    return P.quotes_batch(class_bars(spark, sf))


@query(
    "D8_quotes_batch_short", f'SELECT "assetClass", symbol, price, change, volume FROM ({CLASS_QUOTES})', r6="change"
)
def d8s(spark, sf):
    return P.quotes_batch(class_bars(spark, sf), short=True)


_ANCHORS = {
    "1D": "last - INTERVAL 1 DAY", "5D": "last - INTERVAL 5 DAY", "1M": "last - INTERVAL 1 MONTH",
    "3M": "last - INTERVAL 3 MONTH", "6M": "last - INTERVAL 6 MONTH",
    "ytd": "date_trunc('year', last) - INTERVAL 1 DAY", "1Y": "last - INTERVAL 12 MONTH",
    "3Y": "last - INTERVAL 36 MONTH", "5Y": "last - INTERVAL 60 MONTH", "10Y": "last - INTERVAL 120 MONTH",
}


@query(
    "D9_price_changes",
    "SELECT symbol, "
    + ", ".join(
        f"""(arg_max(close, date) - arg_max(close, date) FILTER (date <= {a}))
            / arg_max(close, date) FILTER (date <= {a}) * 100 AS "{k}" """
        for k, a in _ANCHORS.items()
    )
    + """, (arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) * 100 AS max
FROM (SELECT *, max(date) OVER (PARTITION BY symbol) AS last FROM bars) GROUP BY symbol""",
    r6=" ".join([*_ANCHORS, "max"]),
)
def d9(spark, sf):
    return P.price_changes(bars(spark, sf))


@query(
    "D10_aftermarket_trade",
    """SELECT symbol, arg_max(price, (ts, id)) AS price, arg_max(size, (ts, id)) AS "tradeSize",
       epoch_us(max(ts)) // 1000 AS timestamp FROM ticks WHERE hour(ts) >= 16 GROUP BY symbol""",
)
def d10(spark, sf):
    return P.aftermarket_trade(ticks(spark, sf))


@query(
    "D11_aftermarket_quote",
    """SELECT symbol, arg_max(size, (ts, id)) FILTER (venue = 'view') AS "bidSize",
       arg_max(price, (ts, id)) FILTER (venue = 'view') AS "bidPrice",
       arg_max(size, (ts, id)) FILTER (venue = 'click') AS "askSize",
       arg_max(price, (ts, id)) FILTER (venue = 'click') AS "askPrice",
       CAST(sum(size) AS BIGINT) AS volume, epoch_us(max(ts)) // 1000 AS timestamp
FROM ticks WHERE hour(ts) >= 16 AND venue IN ('view', 'click') GROUP BY symbol""",
)
def d11(spark, sf):
    return P.aftermarket_quote(ticks(spark, sf), "view", "click")


CAP_SQL = """SELECT symbol, date, close * (SELECT arg_max(shares, s.date) FROM share_counts s
  WHERE s.symbol = b.symbol AND s.date <= b.date) AS "marketCap" FROM bars b"""


@query("D12_market_cap_history", CAP_SQL, r4="marketCap")
def d12(spark, sf):
    return P.market_cap(bars(spark, sf), share_counts(spark, sf))


@query(
    "D12_market_cap_batch",
    f"""SELECT symbol, max(date) AS date, arg_max("marketCap", date) AS "marketCap" FROM ({CAP_SQL})
WHERE symbol IN (SELECT s_suppkey FROM supplier) GROUP BY symbol""",
    r4="marketCap",
)
def d12b(spark, sf):
    batch = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"))
    return P.market_cap(bars(spark, sf), share_counts(spark, sf), batch, latest=True)


@query(
    "D13_shares_float",
    """SELECT symbol, date, f / o * 100 AS "freeFloat", f AS "floatShares", o AS "outstandingShares" FROM (
  SELECT l_partkey AS symbol, max(CAST(l_shipdate AS DATE)) AS date,
         CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0) AS BIGINT) AS f, CAST(sum(l_quantity) AS BIGINT) AS o
  FROM lineitem GROUP BY 1)""",
    r6="freeFloat",
)
def d13(spark, sf):
    q = F.col("l_quantity")
    df = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("symbol")).agg(
        F.max(F.to_date("l_shipdate")).alias("date"),
        F.coalesce(F.sum(F.when(F.col("l_returnflag") == "N", q)), F.lit(0)).cast("bigint").alias("floatShares"),
        F.sum(q).cast("bigint").alias("outstandingShares"),
    )
    return P.shares_float(df)


@query(
    "D14_period_stats",
    """SELECT symbol, min(close) AS "minPrice", max(close) AS "maxPrice", avg(close) AS "avgPrice",
       arg_min(close, date) AS "firstPrice", arg_max(close, date) AS "lastPrice", avg(volume) AS "avgVolume",
       CAST(sum(volume) AS BIGINT) AS "totalVolume", arg_max(close, date) - arg_min(close, date) AS change,
       (arg_max(close, date) - arg_min(close, date)) / arg_min(close, date) * 100 AS "changePercent"
FROM bars WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY symbol""",
    r6="avgPrice avgVolume change changePercent",
)
def d14(spark, sf):
    return P.period_stats(bars(spark, sf), "2024-01-05", "2024-01-25")


@query(
    "D15_avg_range",
    """SELECT symbol, avg(open) AS "avgOpen", avg(high) AS "avgHigh", avg(low) AS "avgLow", avg(close) AS "avgClose",
       avg(high - low) AS "avgDailyRange" FROM bars GROUP BY symbol""",
    r6="avgOpen avgHigh avgLow avgClose avgDailyRange",
)
def d15(spark, sf):
    return P.avg_range(bars(spark, sf))


@query(
    "D16_trend_flags",
    """SELECT symbol, price, CASE WHEN "priceAvg50" > "priceAvg200" THEN 'bullish' ELSE 'bearish' END AS trend,
       "priceAvg50" > "priceAvg200" AND price > "priceAvg50" AS "goldenCross",
       "priceAvg50" < "priceAvg200" AND price < "priceAvg50" AS "deathCross",
       price > ("dayHigh" + "dayLow") / 2 AS "aboveMidpoint" FROM quotes""",
)
def d16(spark, sf):
    return P.trend_flags(quotes(spark, sf))


@query(
    "D17_breadth",
    """SELECT *, advancing / total * 100 AS "advancingPercent", declining / total * 100 AS "decliningPercent",
       unchanged / total * 100 AS "unchangedPercent",
       CASE WHEN advancing > declining THEN 'Bullish' WHEN declining > advancing THEN 'Bearish' ELSE 'Neutral' END AS sentiment,
       CASE WHEN "averageChange" > 10 THEN 'High' WHEN "averageChange" > 5 THEN 'Moderate' ELSE 'Low' END AS volatility
FROM (SELECT count(*) AS total, count(*) FILTER (change > 0) AS advancing, count(*) FILTER (change < 0) AS declining,
             count(*) FILTER (change = 0) AS unchanged, avg(abs(change)) AS "averageChange" FROM quotes)""",
    r6="averageChange advancingPercent decliningPercent unchangedPercent",
)
def d17(spark, sf):
    return P.breadth(P.quotes(bars(spark, sf)))


@query(
    "D18_comovement",
    """WITH j AS (SELECT x.symbol AS a, y.symbol AS b, x."changePercent" AS xa, y."changePercent" AS xb
  FROM supplier p JOIN bars_full x ON x.symbol = s_suppkey JOIN bars_full y ON y.symbol = s_suppkey + 1 AND x.date = y.date)
SELECT a, b, count(*) AS days, count(*) FILTER (sign(xa) * sign(xb) > 0) AS "sameDirection",
       count(*) FILTER (sign(xa) * sign(xb) < 0) AS "oppositeDirection",
       CASE WHEN stddev_pop(xa) > 0 AND stddev_pop(xb) > 0 THEN corr(xa, xb) END AS correlation FROM j GROUP BY a, b""",
    r6="correlation",
)
def d18(spark, sf):
    k = F.col("s_suppkey")
    pairs = table(spark, sf, "supplier").select(k.alias("a"), (k + 1).alias("b"))
    return P.comovement(bars(spark, sf), pairs)


@query(
    "D19_dominance",
    'SELECT symbol, "marketCap", "marketCap" / sum("marketCap") OVER () * 100 AS dominance FROM quotes',
    r6="dominance",
    r4="marketCap",
)
def d19(spark, sf):
    return P.dominance(quotes(spark, sf))


CTES["weights"] = """
SELECT p_type AS portfolio, p_partkey AS symbol, p_size / sum(p_size) OVER (PARTITION BY p_type) AS weight FROM part"""


def weights(spark, sf) -> DataFrame:
    from marketmill.functions.windows import share_of_total

    w = table(spark, sf, "part").select(
        F.col("p_type").alias("portfolio"), F.col("p_partkey").alias("symbol"), F.col("p_size").alias("size")
    )
    return share_of_total(w, ["portfolio"], "size", "weight", 1.0).drop("size")


@query(
    "D20_portfolio_summary",
    """SELECT *, CASE WHEN "weightedChange" > 1 THEN 'strong positive' WHEN "weightedChange" > 0 THEN 'moderate positive'
            WHEN "weightedChange" > -1 THEN 'moderate negative' ELSE 'strong negative' END AS performance
FROM (SELECT portfolio, sum(weight * "changePercentage") AS "weightedChange", sum(weight * volume) AS "weightedVolume",
             count(*) FILTER (abs("changePercentage") > 2) AS "highVolatilityMembers", count(*) AS members
      FROM weights JOIN quotes USING (symbol) GROUP BY portfolio)""",
    r6="weightedChange weightedVolume",
)
def d20(spark, sf):
    return P.portfolio_summary(P.quotes(bars(spark, sf)), weights(spark, sf))


@query(
    "D20_high_volatility_members",
    """SELECT portfolio, symbol, "changePercentage" FROM weights JOIN quotes USING (symbol)
WHERE abs("changePercentage") > 5""",
    r6="changePercentage",
)
def d20m(spark, sf):
    return P.high_volatility_members(P.quotes(bars(spark, sf)), weights(spark, sf), 5)


@query(
    "D20_cap_exposure",
    """SELECT *, CASE WHEN "largeCapExposure" > 0.7 THEN 'high' WHEN "largeCapExposure" > 0.4 THEN 'moderate' ELSE 'low' END AS "largeCapClass"
FROM (SELECT portfolio, sum(weight * "marketCap") AS "weightedMarketCap",
             coalesce(sum(weight) FILTER ("marketCap" > 1e9), 0) AS "largeCapExposure"
      FROM weights JOIN quotes USING (symbol) GROUP BY portfolio)""",
    r6="largeCapExposure",
    r2="weightedMarketCap",
)
def d20c(spark, sf):
    return P.cap_exposure(quotes(spark, sf), weights(spark, sf), 1e9)


@query(
    "D21_currency_exposure",
    """WITH w AS (SELECT c_mktsegment AS portfolio, 'C' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || 'C' ||
        lpad(CAST(c_custkey % 25 AS VARCHAR), 2, '0') AS pair, c_acctbal / 1e6 AS weight FROM customer)
SELECT portfolio, count(*) AS pairs, coalesce(sum(weight) FILTER (starts_with(pair, 'C01') OR ends_with(pair, 'C01')), 0) AS exposure,
       coalesce(sum(weight) FILTER (contains(pair, 'C01') OR contains(pair, 'C02') OR contains(pair, 'C03')), 0) AS "majorExposure",
       count(*) >= 4 AS diversified
FROM w GROUP BY portfolio""",
    r6="exposure majorExposure",
)
def d21(spark, sf):
    def code(c):
        return F.concat(F.lit("C"), F.lpad(c.cast("string"), 2, "0"))

    w = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("portfolio"),
        F.concat(code(F.col("c_nationkey")), code(F.col("c_custkey") % 25)).alias("pair"),
        (F.col("c_acctbal") / 1e6).alias("weight"),
    )
    return P.currency_exposure(w, "C01", ["C01", "C02", "C03"])

"""B: incremental maintenance over orders, the insider feed, facts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.functions.windows import page
from marketmill.operators import intervals as V
from marketmill.operators import maintain as B
from marketmill.session import materialize
from marketmill.sources.datasets import coverage

from .registry import CTES, query
from .tables import INSIDER_ORDER_SQL, facts, grades, holdings, insider, insider_order, table

RUN_DATE = "2001-08-01"

CTES["order_days"] = """
SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, o_totalprice AS value FROM orders"""
CTES["order_cov"] = "SELECT k, min(date) AS min_date, max(date) AS max_date FROM order_days GROUP BY k"
CTES["gap_requests"] = """
SELECT c_custkey AS k, CAST(DATE '1996-01-01' + c_nationkey * 10 AS DATE) AS lo,
       CAST(DATE '1996-01-01' + c_nationkey * 10 + 1500 AS DATE) AS hi FROM customer"""


def order_days(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("value"),
    )


def gap_requests(spark, sf):
    lo = F.date_add(F.lit("1996-01-01").cast("date"), F.col("c_nationkey") * 10)
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), lo.alias("lo"), F.date_add(lo, 1500).alias("hi")
    )


@query(
    "B1_date_gaps",
    """SELECT r.k, lo, hi, lo AS gap_lo, hi AS gap_hi FROM gap_requests r LEFT JOIN order_cov c ON r.k = c.k WHERE min_date IS NULL
UNION ALL SELECT r.k, lo, hi, lo, CAST(least(min_date - 1, hi) AS DATE) FROM gap_requests r JOIN order_cov c ON r.k = c.k WHERE lo < min_date
UNION ALL SELECT r.k, lo, hi, CAST(greatest(max_date + 1, lo) AS DATE), hi FROM gap_requests r JOIN order_cov c ON r.k = c.k WHERE hi > max_date""",
)
def b1(spark, sf):
    return B.date_gaps(gap_requests(spark, sf), coverage(order_days(spark, sf), ["k"], "date"), ["k"])


@query(
    "B1_interior_gaps",
    """SELECT k, CAST(d + 1 AS DATE) AS gap_lo, CAST(nx - 1 AS DATE) AS gap_hi FROM (
  SELECT k, date AS d, lead(date) OVER (PARTITION BY k ORDER BY date) AS nx FROM (SELECT DISTINCT k, date FROM order_days))
WHERE nx - d > 1""",
)
def b1i(spark, sf):
    return B.interior_gaps(order_days(spark, sf), ["k"], "date")


CTES["range_requests"] = """
SELECT c_custkey AS k, CASE WHEN c_nationkey % 4 IN (0, 1) THEN DATE '1996-01-01' END AS lo,
       CASE WHEN c_nationkey % 4 IN (0, 2) THEN DATE '1999-12-31' END AS hi FROM customer"""
CTES["stored_days"] = """
SELECT * FROM order_days WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"""
CTES["refresh_cov"] = "SELECT k, min(date) AS min_date, max(date) AS max_date FROM stored_days GROUP BY k"
CTES["refresh_stored"] = f"""
SELECT s.* FROM stored_days s WHERE k NOT IN (SELECT k FROM range_requests WHERE lo IS NULL AND hi IS NULL)
UNION ALL
SELECT o.* FROM order_days o JOIN range_requests r ON o.k = r.k LEFT JOIN refresh_cov c ON o.k = c.k
WHERE lo IS NOT NULL AND o.date BETWEEN lo AND coalesce(hi, DATE '{RUN_DATE}')
  AND (min_date IS NULL OR o.date < min_date OR o.date > max_date)
UNION ALL
SELECT o.* FROM order_days o JOIN range_requests r ON o.k = r.k WHERE lo IS NULL AND hi IS NULL"""


def _refresh(spark, sf):
    n = F.col("c_nationkey") % 4
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"),
        F.when(n.isin(0, 1), F.lit("1996-01-01").cast("date")).alias("lo"),
        F.when(n.isin(0, 2), F.lit("1999-12-31").cast("date")).alias("hi"),
    )
    source = order_days(spark, sf)
    existing = source.filter(F.col("date").between("1997-01-01", "1997-12-31"))
    return B.refresh_range(requests, existing, source, ["k"], "date", RUN_DATE)


@query("B2_refresh_stored", "SELECT * FROM refresh_stored")
def b2s(spark, sf):
    return _refresh(spark, sf)[0]


@query(
    "B2_refresh_answer",
    f"""SELECT s.* FROM refresh_stored s JOIN range_requests r ON s.k = r.k
WHERE lo IS NOT NULL AND s.date BETWEEN lo AND coalesce(hi, DATE '{RUN_DATE}')
UNION ALL SELECT o.* FROM order_days o JOIN range_requests r ON o.k = r.k
WHERE lo IS NULL AND (hi IS NULL OR o.date <= hi)""",
)
def b2a(spark, sf):
    return _refresh(spark, sf)[1]


def _vintages(spark, sf):
    """Quarter totals of two vintages: stored without, fresh with, open line items from 1998 on."""
    li = table(spark, sf, "lineitem")
    q = F.last_day(F.add_months(F.trunc(F.to_date("l_shipdate"), "quarter"), 2)).alias("date")
    def total(df):
        return df.groupBy(F.col("l_suppkey").alias("symbol"), q).agg(
            F.sum("l_quantity").cast("bigint").alias("volume"), F.count("*").alias("items"))
    return total(li.filter("l_linestatus = 'F'")), total(li.filter("l_shipdate >= timestamp_ntz'1998-01-01 00:00:00'"))


CTES["vintage_old"] = """
SELECT l_suppkey AS symbol, CAST(last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS DATE) AS date,
       CAST(sum(l_quantity) AS BIGINT) AS volume, count(*) AS items FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2"""
CTES["vintage_new"] = """
SELECT l_suppkey AS symbol, CAST(last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS DATE) AS date,
       CAST(sum(l_quantity) AS BIGINT) AS volume, count(*) AS items FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2"""
CTES["periods"] = """
SELECT * FROM vintage_new UNION ALL SELECT * FROM vintage_old o
WHERE NOT EXISTS (SELECT 1 FROM vintage_new n WHERE n.symbol = o.symbol AND n.date = o.date)"""


@query("B3_upsert_periods", "SELECT * FROM periods")
def b3(spark, sf):
    old, new = _vintages(spark, sf)
    return B.upsert_periods(old, new, ["symbol"], "date")


@query(
    "B3_upsert_periods_limit",
    "SELECT * FROM periods QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 4",
)
def b3l(spark, sf):
    old, new = _vintages(spark, sf)
    return B.upsert_periods(old, new, ["symbol"], "date", limit=4)


@query(
    "B4_stale_keys",
    """SELECT c_custkey AS k, max_date AS last_updated FROM customer LEFT JOIN order_cov ON c_custkey = k
WHERE max_date IS NULL OR DATE '2001-08-01' - max_date > 120""",
)
def b4(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    cov = coverage(order_days(spark, sf), ["k"], "date").withColumnRenamed("max_date", "last_updated")
    return B.stale_keys(keys, cov, ["k"], RUN_DATE, 120)


@query("B5_page", "SELECT * FROM order_days ORDER BY date DESC, id LIMIT 100 OFFSET 300")
def b5(spark, sf):
    return page(order_days(spark, sf), [F.desc_nulls_last("date"), F.asc("id")], 3, None)


@query("B5_page_deep", "SELECT * FROM order_days ORDER BY date DESC, id LIMIT 100 OFFSET 10000")
def b5d(spark, sf):
    return page(order_days(spark, sf), [F.desc_nulls_last("date"), F.asc("id")], 100, 100, band="date")


CTES["one_day"] = "SELECT DATE '1998-01-01' AS date, l_orderkey AS id, l_linenumber AS line, l_quantity AS value FROM lineitem"


def one_day(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.lit("1998-01-01").cast("date").alias("date"), F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("value"),
    )


@query("B5_page_one_day", "SELECT * FROM one_day ORDER BY date DESC, id, line, value LIMIT 100 OFFSET 5000")
def b5o(spark, sf):
    """A page deep in a feed whose rows are all of one day."""
    order = [F.desc_nulls_last("date"), F.asc("id"), F.asc("line"), F.asc("value")]
    return page(one_day(spark, sf), order, 50, 100, band="date", deep=1000)


@query(
    "B5_page_one_entity",
    "SELECT * FROM one_day QUALIFY row_number() OVER (PARTITION BY date ORDER BY id, line, value) BETWEEN 4001 AND 4100",
)
def b5oe(spark, sf):
    """A page deep in the rows of one entity."""
    return page(one_day(spark, sf), [F.asc("id"), F.asc("line"), F.asc("value")], 40, 100, partition=["date"], deep=1000)


@query(
    "B6_new_since_one_day",
    """SELECT *, CAST((row_number() OVER (ORDER BY id, line, value) - 1) // 100 AS INTEGER) AS page FROM one_day""",
)
def b6o(spark, sf):
    order = [F.desc_nulls_last("date"), F.asc("id"), F.asc("line"), F.asc("value")]
    return B.new_since(one_day(spark, sf), order, "1997-12-31", "date")


@query(
    "B5_page_per_entity",
    """SELECT * FROM order_days QUALIFY row_number() OVER (PARTITION BY k ORDER BY date DESC, id) BETWEEN 4 AND 6""",
)
def b5e(spark, sf):
    return page(order_days(spark, sf), [F.desc_nulls_last("date"), F.asc("id")], 1, 3, partition=["k"])


@query(
    "B6_new_since",
    f"""WITH head AS (SELECT *, CAST((row_number() OVER (ORDER BY {INSIDER_ORDER_SQL}) - 1) // 100 AS INTEGER) AS page
  FROM insider),
reached AS (SELECT min(page) AS p FROM (SELECT page FROM head GROUP BY page HAVING min("filingDate") <= DATE '2001-06-01'))
SELECT head.* FROM head, reached WHERE p IS NULL OR page <= p""",
)
def b6(spark, sf):
    return B.new_since(insider(spark, sf), insider_order(), "2001-06-01", "filingDate")


CTES["analyst_cp"] = """
SELECT c_custkey AS k, CASE WHEN c_nationkey % 3 > 0 THEN CAST(DATE '1997-01-01' + c_nationkey * 40 AS DATE) END AS checkpoint
FROM customer WHERE c_nationkey % 5 > 0"""


@query(
    "B7_new_since_per_key",
    f"""WITH f AS (SELECT o.*, greatest(coalesce(checkpoint, DATE '1900-01-01'), DATE '{RUN_DATE}' - 1095) AS stop,
       row_number() OVER (PARTITION BY o.k ORDER BY date DESC, id) - 1 AS pos
  FROM order_days o LEFT JOIN analyst_cp c ON o.k = c.k),
pg AS (SELECT k, pos // 3 AS page, min(date) <= min(stop) AS hit FROM f GROUP BY 1, 2),
last AS (SELECT k, min(page) FILTER (hit) AS p FROM pg GROUP BY k)
SELECT f.k, date, id, value FROM f JOIN last USING (k) WHERE p IS NULL OR pos // 3 <= p""",
)
def b7(spark, sf):
    c, n = table(spark, sf, "customer"), F.col("c_nationkey")
    cp = F.when(n % 3 > 0, F.date_add(F.lit("1997-01-01").cast("date"), n * 40))
    checkpoints = c.filter(n % 5 > 0).select(F.col("c_custkey").alias("k"), cp.alias("checkpoint"))
    order = [F.desc_nulls_last("date"), F.asc("id")]
    return B.new_since_per_key(order_days(spark, sf), ["k"], order, checkpoints, "date", RUN_DATE, page_size=3)


def _merge_sql(view: str, keys: str, cond: str, order: str) -> str:
    on = " AND ".join(f'e."{k}" = n."{k}"' for k in keys.split(", "))
    part = ", ".join(f'"{k}"' for k in keys.split(", "))
    return f"""WITH e AS (SELECT * FROM {view} WHERE {cond} QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY {order}) = 1),
n AS (SELECT * FROM {view} QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY {order}) = 1)
SELECT * FROM e UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE {on})"""


def _merged(df, keys, cond, order):
    """Merge the whole feed into what an earlier walk, up to ``cond``, has stored."""
    empty = df.filter(F.lit(False))
    # the earlier walk's table is there when the later one comes
    stored = materialize(B.merge_feed(empty, df.filter(cond), keys, order), "stored-feed")
    return B.merge_feed(stored, df, keys, order)


@query(
    "B8_merge_insider",
    _merge_sql("insider", "symbol, filingDate, transactionType", "\"filingDate\" < DATE '1999-01-01'", INSIDER_ORDER_SQL),
)
def b8(spark, sf):
    keys = ["symbol", "filingDate", "transactionType"]
    return _merged(insider(spark, sf), keys, F.col("filingDate") < F.lit("1999-01-01").cast("date"), insider_order())


@query(
    "B9_merge_filings",
    _merge_sql("holdings", "cik, filingDate", "\"filingDate\" < DATE '1999-01-01'", 'value, shares, symbol, "securityCusip", date, "putCallShare"'),
)
def b9(spark, sf):
    order = [F.asc(c) for c in ("value", "shares", "symbol", "securityCusip", "date", "putCallShare")]
    cond = F.col("filingDate") < F.lit("1999-01-01").cast("date")
    return _merged(holdings(spark, sf), ["cik", "filingDate"], cond, order)


@query("B10_merge_estimates", _merge_sql("grades", "symbol, date", "date < DATE '1999-01-01'", "id"))
def b10(spark, sf):
    cond = F.col("date") < F.lit("1999-01-01").cast("date")
    return _merged(grades(spark, sf), ["symbol", "date"], cond, [F.asc("id")])


@query(
    "B11_advance_checkpoints",
    """SELECT coalesce(n.k, c.k) AS k, greatest(checkpoint, m) AS checkpoint
FROM analyst_cp c FULL JOIN (SELECT k, max(date) AS m FROM order_days GROUP BY k) n ON n.k = c.k
WHERE greatest(checkpoint, m) IS NOT NULL""",
)
def b11(spark, sf):
    c, n = table(spark, sf, "customer"), F.col("c_nationkey")
    cp = F.when(n % 3 > 0, F.date_add(F.lit("1997-01-01").cast("date"), n * 40))
    checkpoints = c.filter(n % 5 > 0).select(F.col("c_custkey").alias("k"), cp.alias("checkpoint"))
    return B.advance_checkpoints(order_days(spark, sf), checkpoints, ["k"], "date")


SNAP = "SELECT event_id, ts, user_id, event_type, value FROM events"


@query(
    "B12_upsert_snapshot",
    f"""WITH old AS (SELECT * FROM ({SNAP}) WHERE ts < TIMESTAMP '2024-01-10' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1),
new AS (SELECT * FROM ({SNAP}) WHERE ts >= TIMESTAMP '2024-01-10' AND value > 20 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.user_id = old.user_id AND new.event_type = old.event_type)""",
)
def b12(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cut = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    order, entity = [F.desc("ts"), F.asc("event_id")], ["user_id", "event_type"]
    old = B.upsert_snapshot(e.filter(F.lit(False)), e.filter(F.col("ts") < cut), entity, "value", order)
    fresh = e.filter(F.col("ts") >= cut).withColumn("value", F.when(F.col("value") > 20, F.col("value")))
    return B.upsert_snapshot(old, fresh, entity, "value", order)


CALENDAR = "SELECT l_suppkey AS symbol, l_shipdate AS date FROM lineitem"


@query(
    "B13_refresh_worklist",
    "SELECT s_suppkey AS symbol FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem "
    "WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2001-09-20' AND DATE '2001-10-05')",
)
def b13(spark, sf):
    universe = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"))
    calendar = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("date"))
    return B.refresh_worklist(universe, calendar, "date", "2001-09-20", "2001-09-10", "2001-10-05")


@query("B13_refresh_worklist_full", "SELECT s_suppkey AS symbol FROM supplier")
def b13f(spark, sf):
    universe = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"))
    calendar = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("date"))
    return B.refresh_worklist(universe, calendar, "date", "2001-09-20", "2001-09-05", "2001-10-05")


@query(
    "B14_refresh_universe",
    """SELECT p_name AS symbol, p_partkey AS id, 'parts' AS universe FROM part
QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1
UNION ALL SELECT s_name, s_suppkey, 'suppliers' FROM supplier""",
)
def b14(spark, sf):
    listing = table(spark, sf, "part").select(F.col("p_name").alias("symbol"), F.col("p_partkey").alias("id"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("symbol"), F.col("s_suppkey").alias("id"))
    existing = s.withColumn("universe", F.lit("suppliers")).unionByName(s.withColumn("universe", F.lit("parts")))
    return B.refresh_universe(existing, listing, "parts", [F.desc("id")])


@query(
    "B14_refresh_universe_unnamed",
    """SELECT p_name AS symbol, p_partkey AS id, 'parts' AS universe FROM part
QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1
UNION ALL SELECT s_name, s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'suppliers' END FROM supplier WHERE s_suppkey % 3 > 0""",
)
def b14n(spark, sf):
    """Rows without a universe stay."""
    listing = table(spark, sf, "part").select(F.col("p_name").alias("symbol"), F.col("p_partkey").alias("id"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("symbol"), F.col("s_suppkey").alias("id"))
    name = F.when(F.col("id") % 3 == 0, "parts").when(F.col("id") % 2 == 0, "suppliers")
    return B.refresh_universe(s.withColumn("universe", name), listing, "parts", [F.desc("id")])


LATEST = """SELECT * FROM facts WHERE value IS NOT NULL {cond}
QUALIFY row_number() OVER (PARTITION BY subject, predicate, valid_from ORDER BY published_at DESC, source_id, value) = 1"""
CTES["facts_now"] = LATEST.format(cond="")


@query("B15_facts_latest", "SELECT * FROM facts_now")
def b15(spark, sf):
    return B.facts_latest(facts(spark, sf))


@query("B15_facts_as_of", LATEST.format(cond="AND published_at <= TIMESTAMP '1998-06-30'"))
def b15a(spark, sf):
    return B.facts_latest(facts(spark, sf), "1998-06-30 00:00:00")


PANEL = """SELECT subject AS entity, valid_from AS time, max(value) FILTER (predicate = 'A') AS "A",
       max(value) FILTER (predicate = 'N') AS "N", max(value) FILTER (predicate = 'R') AS "R" FROM {src} GROUP BY 1, 2"""
PREDICATES = ["A", "N", "R"]


@query("B16_facts_panel", PANEL.format(src="facts_now"))
def b16(spark, sf):
    return B.facts_panel(B.facts_latest(facts(spark, sf)), PREDICATES)


@query("B17_freshness_token", "SELECT max(published_at) AS token FROM facts")
def b17(spark, sf):
    return B.freshness_token(facts(spark, sf))


@query("B18_changed_since", "SELECT DISTINCT subject, valid_from FROM facts WHERE published_at > TIMESTAMP '2001-07-01'")
def b18(spark, sf):
    return B.changed_since(facts(spark, sf), "2001-07-01 00:00:00")


@query("B19_recompute_dirty", PANEL.format(src="facts_now"))
def b19(spark, sf):
    """The panel of an earlier day, brought up to date through the changefeed only."""
    cursor = "2000-01-01 00:00:00"
    all_facts = facts(spark, sf)
    old = B.facts_panel(B.facts_latest(all_facts, cursor), PREDICATES)
    dirty = B.changed_since(all_facts, cursor)
    return B.recompute_dirty(
        old, dirty, all_facts, lambda f: B.facts_panel(B.facts_latest(f), PREDICATES),
        ["entity", "time"], ["subject", "valid_from"],
    )


CTES["usage"] = """
SELECT ts, event_id AS id, CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN '' ELSE event_type END AS category,
       CAST(value * 1000000 AS BIGINT) AS bytes FROM events"""


def usage(spark, sf):
    t = F.col("event_type")
    return table(spark, sf, "events").select(
        "ts", F.col("event_id").alias("id"), F.when(t == "view", None).when(t == "click", "").otherwise(t).alias("category"),
        F.round(F.col("value") * 1000000).cast("bigint").alias("bytes"),
    )


@query(
    "B20_usage_rollup",
    """SELECT month, category, bytes, t AS "monthBytes", t >= 18 * 1073741824.0 AS "overSoftCap",
       t >= 20 * 1073741824.0 AND category <> 'user' AS "overHardCap" FROM (
  SELECT *, CAST(sum(bytes) OVER (PARTITION BY month) AS BIGINT) AS t FROM (
    SELECT strftime(ts, '%Y-%m') AS month, CASE WHEN coalesce(category, '') = '' THEN 'user' ELSE category END AS category,
           CAST(sum(bytes) AS BIGINT) AS bytes FROM usage GROUP BY 1, 2))""",
)
def b20(spark, sf):
    return B.usage_rollup(usage(spark, sf), 18, 20)


@query(
    "B20_first_breach",
    """SELECT month, ts, id, CAST(r AS BIGINT) AS "runningBytes" FROM (
  SELECT strftime(ts, '%Y-%m') AS month, ts, id, bytes, sum(bytes) OVER (PARTITION BY strftime(ts, '%Y-%m') ORDER BY ts, id) AS r FROM usage)
WHERE r >= 20 * 1073741824.0 AND r - bytes < 20 * 1073741824.0""",
)
def b20f(spark, sf):
    return B.first_breach(usage(spark, sf), 20 * B.GIB)


@query(
    "B21_latest_runs",
    """SELECT event_type AS category, ts AS started_at, user_id AS items_attempted, event_id AS id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def b21(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("event_type").alias("category"), F.col("ts").alias("started_at"), F.col("user_id").alias("items_attempted"),
        F.col("event_id").alias("id"),
    )
    return B.latest_runs(runs, [F.desc("started_at"), F.desc("id")])


@query(
    "B22_failure_streaks",
    """WITH a AS (SELECT CAST(ts AS DATE) AS cycle, event_id AS n, event_type FROM events),
i AS (SELECT *, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY cycle ORDER BY n) AS island FROM a),
s AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY cycle, island ORDER BY n) AS streak FROM i)
SELECT cycle, min(n) AS attempt_no FROM s WHERE event_type = 'error' AND streak = 4 GROUP BY cycle""",
)
def b22(spark, sf):
    t = F.col("event_type")
    status = F.when(t == "click", "success").when(t == "error", "paywall").otherwise("other")
    attempts = table(spark, sf, "events").select(
        F.to_date("ts").alias("cycle"), F.col("event_id").alias("attempt_no"), status.alias("status")
    )
    return B.failure_streaks(attempts, 4)


@query(
    "B22_failure_streaks_no_cycle",
    """WITH a AS (SELECT CASE WHEN day(ts) % 3 > 0 THEN CAST(ts AS DATE) END AS cycle, event_id AS n, event_type FROM events),
i AS (SELECT *, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY cycle ORDER BY n) AS island FROM a),
s AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY cycle, island ORDER BY n) AS streak FROM i)
SELECT cycle, min(n) AS attempt_no FROM s WHERE event_type = 'error' AND streak = 4 GROUP BY cycle""",
)
def b22n(spark, sf):
    """Attempts without a cycle are one cycle."""
    t = F.col("event_type")
    status = F.when(t == "click", "success").when(t == "error", "paywall").otherwise("other")
    cycle = F.when(F.dayofmonth("ts") % 3 > 0, F.to_date("ts"))
    attempts = table(spark, sf, "events").select(cycle.alias("cycle"), F.col("event_id").alias("attempt_no"), status.alias("status"))
    return B.failure_streaks(attempts, 4, chunk=1000)


@query(
    "B20_first_breach_undated",
    """SELECT month, ts, id, CAST(r AS BIGINT) AS "runningBytes" FROM (
  SELECT strftime(ts, '%Y-%m') AS month, ts, id, bytes, sum(bytes) OVER (PARTITION BY strftime(ts, '%Y-%m') ORDER BY ts, id) AS r
  FROM (SELECT CASE WHEN id % 3 > 0 THEN ts END AS ts, id, bytes FROM usage))
WHERE r >= 1e9 AND r - bytes < 1e9""",
)
def b20u(spark, sf):
    """Requests without a time have a running total of their own."""
    timed = usage(spark, sf).withColumn("ts", F.when(F.col("id") % 3 > 0, F.col("ts")))
    return B.first_breach(timed, 1e9)


#: Fifty days, every fifty days.
AS_OF = [f"{1995 + i // 7}-{1 + 50 * (i % 7) // 30:02d}-{1 + 50 * (i % 7) % 30:02d}" for i in range(50)]
CTES["as_of_days"] = "SELECT unnest([" + ", ".join(f"TIMESTAMP '{d}'" for d in AS_OF) + "]) AS as_of"
CTES["facts_then"] = """
SELECT f.*, as_of FROM facts f JOIN as_of_days ON published_at <= as_of WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY as_of, subject, predicate, valid_from ORDER BY published_at DESC, source_id, value) = 1"""


def stored_intervals(spark, sf):
    return materialize(V.fact_intervals(facts(spark, sf)), "intervals")


@query("B15_facts_as_of_many", "SELECT subject, predicate, valid_from, value, source_id, published_at AS since, as_of FROM facts_then")
def b15m(spark, sf):
    return V.facts_as_of(stored_intervals(spark, sf), AS_OF).drop("until")


@query(
    "B15_intervals_incremental",
    """SELECT subject, predicate, valid_from, value, source_id, published_at AS since,
       lead(published_at) OVER (PARTITION BY subject, predicate, valid_from ORDER BY published_at) AS until FROM (
  SELECT * FROM facts WHERE value IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY subject, predicate, valid_from, published_at ORDER BY source_id, value) = 1)""",
)
def b15n(spark, sf):
    """The intervals of two thirds of the facts, old and new ones, brought up to date by the rest."""
    f, third = facts(spark, sf), F.pmod(F.xxhash64("subject", "published_at"), F.lit(3)) == 0
    return V.merge_intervals(materialize(V.fact_intervals(f.filter(~third)), "intervals"), f.filter(third))


@query(
    "B16_facts_panel_many",
    """SELECT as_of, subject AS entity, valid_from AS time, max(value) FILTER (predicate = 'A') AS "A",
       max(value) FILTER (predicate = 'N') AS "N", max(value) FILTER (predicate = 'R') AS "R" FROM facts_then GROUP BY 1, 2, 3""",
)
def b16m(spark, sf):
    return V.panels_as_of(stored_intervals(spark, sf), AS_OF, PREDICATES)


@query(
    "B18_changed_since_many",
    "SELECT DISTINCT as_of AS cursor, subject, valid_from FROM facts JOIN as_of_days ON published_at > as_of WHERE value IS NOT NULL",
)
def b18m(spark, sf):
    return V.changed_since(stored_intervals(spark, sf), AS_OF)

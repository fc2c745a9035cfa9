"""A and T: dataset tables, landing, views, scalar helpers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.functions import scalars as S
from marketmill.session import fresh_path
from marketmill.sources import datasets as D
from marketmill.sources import landing as L
from marketmill.sources.views import Manifest, Views

from .prices import class_bars
from .registry import CTES, query
from .tables import line_orders, securities, table

BUCKETS = 8


def _stored(spark, sf):
    """Line items written as a dataset table keyed by supplier."""
    li = table(spark, sf, "lineitem")
    path = fresh_path(spark, "lineitem")
    D.write_dataset(li, path, ["l_suppkey"], BUCKETS)
    return li, path


@query("A1_read_dataset", "SELECT * FROM lineitem")
def a1(spark, sf):
    li, path = _stored(spark, sf)
    return D.read_dataset(spark, path, li.schema)


@query(
    "A2_read_range",
    """SELECT * FROM orders WHERE o_orderdate IS NULL
   OR CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'""",
)
def a2(spark, sf):
    return D.read_range(table(spark, sf, "orders"), "o_orderdate", "1996-03-01", "1998-06-30")


REPLACED = "SELECT s_suppkey FROM supplier WHERE s_acctbal < 0"


@query(
    "A3_overwrite_keys",
    f"""SELECT * FROM lineitem WHERE l_suppkey NOT IN ({REPLACED})
UNION ALL
SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM lineitem WHERE l_suppkey IN ({REPLACED}) AND l_returnflag = 'R'""",
)
def a3(spark, sf):
    li, path = _stored(spark, sf)
    chosen = table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    fresh = li.filter("l_returnflag = 'R'").join(chosen, "l_suppkey", "left_semi")
    fresh = fresh.withColumn("l_quantity", F.col("l_quantity") + 1).select(*li.columns)
    D.overwrite_keys(spark, fresh, path, li.schema, ["l_suppkey"], BUCKETS)
    return D.read_dataset(spark, path, li.schema)


@query(
    "A4_append_new",
    """WITH existing AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus <> 'P')
SELECT * FROM existing UNION ALL
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM existing e
  WHERE e.o_custkey = o.o_custkey AND e.o_orderdate = o.o_orderdate)""",
)
def a4(spark, sf):
    o = table(spark, sf, "orders")
    existing = o.filter((F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("o_orderstatus") != "P"))
    return D.append_new(existing, o, "o_orderdate", ["o_custkey"])


@query(
    "A5_coverage",
    """SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date,
       count(*) AS record_count, DATE '2024-01-31' AS last_updated FROM orders GROUP BY 1 HAVING min(o_orderdate) IS NOT NULL""",
)
def a5(spark, sf):
    return D.coverage(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "2024-01-31")


@query("A6_list_keys", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def a6(spark, sf):
    return D.list_keys(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


@query("A7_delete_keys", f"SELECT * FROM lineitem WHERE l_suppkey NOT IN ({REPLACED})")
def a7(spark, sf):
    li, path = _stored(spark, sf)
    doomed = table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    D.delete_keys(spark, doomed, path, li.schema, ["l_suppkey"])
    return D.read_dataset(spark, path, li.schema)


@query(
    "A8_reconcile_types",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(event_id * 1000003 + 9007199254740990 AS VARCHAR) AS big,
       CASE WHEN event_type = 'view' THEN 'n' || CAST(event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS mixed,
       value, event_type = 'click' AS flag, CASE WHEN event_type = 'error' THEN NULL ELSE '{"a":1}' END AS nested
FROM events""",
)
def a8(spark, sf):
    e = table(spark, sf, "events")
    num = F.col("event_id").cast("string")
    body = F.concat(
        F.lit('{"k":'), F.get_json_object("props", "$.k"),
        F.lit(',"big":'), (F.col("event_id") * 1000003 + 9007199254740990).cast("string"),
        F.lit(',"mixed":'), F.when(F.col("event_type") == "view", F.concat(F.lit('"n'), num, F.lit('"'))).otherwise(num),
        F.lit(',"value":'), F.col("value").cast("string"),
        F.lit(',"flag":'), (F.col("event_type") == "click").cast("string"),
        F.lit(',"nested":'), F.when(F.col("event_type") == "error", "{}").otherwise('{"a":1}'), F.lit("}"),
    )
    raw = e.select("event_id", body.alias("json"))
    return L.reconcile_types(raw, "json", ["k", "big", "mixed", "value", "flag", "nested"])


def _bodies(spark, sf):
    """Response bodies made of the event payloads: arrays, objects, errors and blanks."""
    t = F.col("event_type")
    body = (
        F.when(t == "error", F.lit('{"Error Message": "Limit reached"}'))
        .when(t == "signup", F.lit("  "))
        .when(t == "view", F.concat(F.lit("["), F.col("props"), F.lit(', {"k": 1, "z": "x"}]')))
        .otherwise(F.col("props"))
    )
    return table(spark, sf, "events").select("event_id", body.alias("body"))


@query(
    "A9_ingest_json_rows",
    """SELECT event_id, 0 AS pos, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS z
FROM events WHERE event_type NOT IN ('error', 'signup')
UNION ALL SELECT event_id, 1, 1, 'x' FROM events WHERE event_type = 'view'""",
)
def a9(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    data, _ = L.ingest_json(_bodies(spark, sf), "body", schema, ["event_id"])
    return data.select("event_id", "pos", "k", F.try_element_at("extra", F.lit("z")).alias("z"))


@query("A9_ingest_json_errors", "SELECT event_id, 'Limit reached' AS error FROM events WHERE event_type = 'error'")
def a9e(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return L.ingest_json(_bodies(spark, sf), "body", schema, ["event_id"])[1]


@query(
    "A10_ignore_corrupt",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1",
)
def a10(spark, sf):
    li, path = _stored(spark, sf)
    # a file that breaks off after a few bytes counts as nothing stored
    broken = spark.createDataFrame([("PAR1",)], "value string")
    broken.coalesce(1).write.text(f"{path}/{D.bucket_column(["l_suppkey"], BUCKETS)}=0/broken.parquet")
    df = D.read_dataset(spark, path, li.schema, ignore_corrupt=True)
    return df.groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("A11_shared_prices", 'SELECT "assetClass", symbol, date, close, volume FROM class_bars')
def a11(spark, sf):
    return D.prices(class_bars(spark, sf)).select("assetClass", "symbol", "date", "close", "volume")


@query(
    "A11_shared_prices_class",
    """SELECT symbol, date, close, volume FROM class_bars WHERE "assetClass" = 'purchase'""",
)
def a11c(spark, sf):
    return D.prices(class_bars(spark, sf), "purchase").select("symbol", "date", "close", "volume")


@query("A12_publish_view", "SELECT symbol, name, sector, industry, price, shares FROM securities")
def a12(spark, sf):
    views = Views(spark, fresh_path(spark, "views"))
    frame = securities(spark, sf)
    views.publish(frame.limit(1), Manifest("universe", "table", "h0"))
    views.publish(frame, Manifest("universe", "table", "h1", exports=["universe"], sources=["part"]))
    return views.read("universe")


# Scalar helpers -----------------------------------------------------------------


@query(
    "T1_lead_date",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS d FROM events""",
)
def t1(spark, sf):
    text = F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(F.col("ts").cast("string"))
    return table(spark, sf, "events").select("event_id", S.lead_date(text).alias("d"))


@query("T2_as_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) AS b FROM orders")
def t2(spark, sf):
    o = table(spark, sf, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select("o_orderkey", S.as_date("o_orderdate").alias("a"), S.as_date(text, "string").alias("b"))


@query(
    "T3_series_key",
    """SELECT o_orderkey, 'income-statement/' || CAST(o_custkey AS VARCHAR) || '/' ||
       CASE WHEN o_orderstatus = 'P' THEN '_default' ELSE o_orderstatus END AS key FROM orders""",
)
def t3(spark, sf):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    key = S.series_key("income-statement", "o_custkey", status)
    return table(spark, sf, "orders").select("o_orderkey", key.alias("key"))


@query(
    "T4_json_object",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events""",
)
def t4(spark, sf):
    t = F.col("event_type")
    text = F.when(t == "error", F.lit("{broken")).when(t == "view", F.lit("[1, 2]")).otherwise(F.col("props"))
    return table(spark, sf, "events").select(
        "event_id", F.try_variant_get(S.json_object(text), "$.k", "bigint").alias("k")
    )


@query("T5_month_key", "SELECT event_id, strftime(ts, '%Y-%m') AS month FROM events")
def t5(spark, sf):
    return table(spark, sf, "events").select("event_id", S.month_key("ts").alias("month"))

"""P: the streaming jobs, replaying the driver tables as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketmill.functions.scalars import quarter_end
from marketmill.operators import maintain as B
from marketmill.session import fresh_path
from marketmill.sources.datasets import read_dataset, read_keys, write_dataset
from marketmill.streaming import jobs as J
from marketmill.streaming import keyed as K

from . import maintain as _maintain  # noqa: F401  (its sub-queries are used below)
from .registry import query
from .tables import facts, table


def replay(spark, sf, name):
    """A driver table as a file stream. The glob matches a single file as well as a folder of parts."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


@query(
    "P1_stream_bars",
    """SELECT * FROM (SELECT symbol, time_bucket(INTERVAL '1 hour', ts) AS date, arg_min(price, (ts, id)) AS open, min(price) AS low,
  max(price) AS high, arg_max(price, (ts, id)) AS close, CAST(sum(size) AS BIGINT) AS volume FROM ticks GROUP BY 1, 2)
WHERE date + INTERVAL 1 HOUR <= (SELECT max(ts) FROM ticks) - INTERVAL 10 MINUTE""",
)
def p1(spark, sf):
    ticks = replay(spark, sf, "events").select(
        F.col("user_id").alias("symbol"), "ts", F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"), F.col("event_id").alias("id"),
    )
    bars = J.stream_bars(ticks, "1hour", "10 minutes")
    out = fresh_path(spark, "bars")
    J.start_append(bars, out, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(bars.schema).parquet(out).withColumn("date", F.col("date").cast("timestamp_ntz"))


@query(
    "P2_stream_dedup",
    """SELECT DISTINCT l_suppkey AS symbol, l_shipdate AS "filingDate", l_returnflag AS "transactionType" FROM lineitem""",
)
def p2(spark, sf):
    feed = replay(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("filingDate"), F.col("l_returnflag").alias("transactionType"),
        "l_orderkey", "l_linenumber",
    )
    keys = ["symbol", "filingDate", "transactionType"]
    out, order = fresh_path(spark, "dedup"), [("l_orderkey", True), ("l_linenumber", True)]
    K.start_keyed_feed(feed, out, keys, order, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(feed.schema).parquet(out).select(*keys)


@query(
    "P3_stream_snapshot",
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def p3(spark, sf):
    feed = replay(spark, sf, "events")
    out, entity, order = fresh_path(spark, "snapshot"), ["user_id", "event_type"], [("ts", False), ("event_id", True)]
    K.start_keyed_snapshot(feed, out, entity, "value", order, fresh_path(spark, "checkpoint")).awaitTermination()
    return K.read_snapshot(spark, out, feed.schema, entity, order)


@query(
    "P3_stream_snapshot_table",
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def p3t(spark, sf):
    """The snapshot as a dataset table whose touched buckets each batch rewrites."""
    feed = replay(spark, sf, "events")
    out = fresh_path(spark, "snapshot")
    order = [F.desc("ts"), F.asc("event_id")]
    J.start_snapshot(
        feed, out, feed.schema, ["user_id", "event_type"], "value", order, fresh_path(spark, "checkpoint"), 8
    ).awaitTermination()
    return read_dataset(spark, out, feed.schema)


@query(
    "P4_stream_changes",
    """SELECT subject AS entity, valid_from AS time, max(value) FILTER (predicate = 'A') AS "A",
       max(value) FILTER (predicate = 'N') AS "N", max(value) FILTER (predicate = 'R') AS "R" FROM facts_now GROUP BY 1, 2""",
)
def p4(spark, sf):
    orders = table(spark, sf, "orders")
    lines = replay(spark, sf, "lineitem")
    feed = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_suppkey").cast("string").alias("subject"), quarter_end(F.to_date("o_orderdate")).alias("valid_from")
    )

    def build(f):
        return B.facts_panel(B.facts_latest(f), ["A", "N", "R"])

    landed, cells = facts(spark, sf), ["subject", "valid_from"]
    schema, kept = build(landed).schema, fresh_path(spark, "facts")
    write_dataset(landed, kept, cells, 8)
    out = fresh_path(spark, "panel")
    # a batch reads the buckets of its dirty cells, not all facts
    J.start_changes(
        feed, lambda s, dirty: read_keys(s, kept, landed.schema, dirty, cells), build, out, schema, ["entity", "time"], fresh_path(spark, "checkpoint"), 8
    ).awaitTermination()
    return read_dataset(spark, out, schema)

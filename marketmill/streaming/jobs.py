"""The feeds as Structured Streaming jobs.

Event times are cast to TIMESTAMP, since a watermark cannot be set on
TIMESTAMP_NTZ. Progress lives in the checkpoint folder of each query.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketmill.functions.scalars import time_order
from marketmill.functions.windows import first_per_key, hashable
from marketmill.operators.prices import TIMEFRAMES
from marketmill.sources.datasets import overwrite_keys, read_keys, without_keys

#: Take what is there now and stop. Pass e.g. ``{"processingTime": "1 minute"}`` for a stream that keeps running.
ONCE = {"availableNow": True}


def stream_bars(ticks: DataFrame, timeframe: str, lateness: str) -> DataFrame:
    """Tumbling bars from a tick stream; ticks later than ``lateness`` are dropped.

    Use append mode: a bar comes out once, when the watermark has passed its end.
    """
    order = F.when(F.col("price").isNotNull(), time_order("ts", "id"))
    return (
        ticks.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .groupBy("symbol", F.window("ts", TIMEFRAMES[timeframe]).alias("w"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.min("price").alias("low"),
            F.max("price").alias("high"),
            F.max_by("price", order).alias("close"),
            F.sum("size").alias("volume"),
        )
        .select("symbol", F.col("w.start").alias("date"), "open", "low", "high", "close", "volume")
    )


def stream_dedup(
    feed: DataFrame, keys: Sequence[str], time_col: str, lateness: str, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Feed without repeated business keys within the watermark delay.

    Copies are first dropped within 16 hash slices of their key, so that a key
    with very many copies reaches its one task with 16 rows a batch at most. The
    slice comes from ``spread_by``, columns that differ between copies such as a
    source offset (all columns but maps by default); it is never random, so a lost task
    can be run again. A row behind the watermark is dropped even if its key is new;
    :func:`start_feed` loses none.
    """
    timed = feed.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, lateness)
    sliced = timed.withColumn("__slice", F.pmod(F.xxhash64(*(spread_by or hashable(feed))), F.lit(16)))
    first = sliced.dropDuplicatesWithinWatermark([*keys, "__slice"]).drop("__slice")
    return first.dropDuplicatesWithinWatermark(list(keys))


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Run a stream into a Parquet table."""
    return (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def _each_batch(stream: DataFrame, work: Callable[[DataFrame], None], checkpoint: str, trigger: dict) -> StreamingQuery:
    """Run ``work`` on every batch, which is kept while it is read several times."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            work(batch)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_feed(
    feed: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    order: Sequence[Column],
    checkpoint: str,
    buckets: int = 256,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Keep the first row seen of every business key in a dataset table, however late it comes.

    Within a batch ``order`` decides. A batch looks up its own keys only, and one that is run
    again finds them stored, so a restart adds nothing twice.
    """

    def add(batch: DataFrame) -> None:
        spark = batch.sparkSession
        fresh = first_per_key(batch, keys, order).select(*schema.fieldNames())
        new = without_keys(fresh, read_keys(spark, path, schema, fresh, keys), keys)
        overwrite_keys(spark, new, path, schema, keys, buckets)

    return _each_batch(feed, add, checkpoint, trigger)


def start_snapshot(
    feed: DataFrame,
    path: str,
    schema: T.StructType,
    entity: Sequence[str],
    payload: str,
    order: Sequence[Column],
    checkpoint: str,
    buckets: int = 256,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Keep one row per entity in a dataset table, the first under ``order`` of all seen.

    A batch that is run again picks the same winners, so a restart does no harm.
    """

    def merge(batch: DataFrame) -> None:
        spark = batch.sparkSession
        live = batch.filter(F.col(payload).isNotNull())
        fresh = first_per_key(live, entity, order)
        known = read_keys(spark, path, schema, fresh, entity)
        winners = first_per_key(fresh.unionByName(known.select(*fresh.columns)), entity, order)
        overwrite_keys(spark, winners, path, schema, entity, buckets)

    return _each_batch(feed, merge, checkpoint, trigger)


def start_changes(
    facts: DataFrame,
    base: Callable[[SparkSession, DataFrame], DataFrame],
    build: Callable[[DataFrame], DataFrame],
    path: str,
    schema: T.StructType,
    view_keys: Sequence[str],
    checkpoint: str,
    buckets: int = 256,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Changefeed: rebuild the cells of a view that a batch of facts touches.

    ``base`` gives the facts landed so far for the dirty cells (subject,
    valid_from), with a pruned read where the facts table allows it; ``build``
    makes view rows from facts. ``view_keys`` name the same two in the view; a cell
    that has no value any more goes.
    """

    def rebuild(batch: DataFrame) -> None:
        spark = batch.sparkSession
        dirty = batch.select("subject", "valid_from").distinct()
        cells = dirty.withColumnsRenamed(dict(zip(("subject", "valid_from"), view_keys)))
        overwrite_keys(spark, build(base(spark, dirty)), path, schema, view_keys, buckets, cells)

    return _each_batch(facts, rebuild, checkpoint, trigger)

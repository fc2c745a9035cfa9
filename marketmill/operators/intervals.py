"""Facts as closed intervals of publication: many as-of dates from one pass.

A value of a cell (subject, predicate, valid_from) holds from its publication until the next one. Intervals are kept
as a table; new facts change those of their own cells only. A question for many dates then
compares each interval with the sorted dates, and needs no further shuffle of the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.windows import join_on
from marketmill.sources.datasets import without_keys

CELL = ["subject", "predicate", "valid_from"]


def fact_intervals(facts: DataFrame) -> DataFrame:
    """(subject, predicate, valid_from, value, source_id, since, until): the value of a cell from its publication to the next one.

    ``until`` is null for the value that still holds. Of facts published at one time the smaller source
    wins, then the smaller value. Facts without a value or a time of publication hold never. One shuffle and one sort.
    """
    f = facts.filter(F.col("value").isNotNull() & F.col("published_at").isNotNull())
    along = Window.partitionBy(*CELL).orderBy("published_at", F.asc("source_id"), F.asc("value"))
    f = f.withColumns({"__first": F.lag("published_at").over(along), "since": F.col("published_at")})
    f = f.filter(~F.col("__first").eqNullSafe(F.col("since")))
    return f.withColumn("until", F.lead("since").over(along)).select(*CELL, "value", "source_id", "since", "until")


def extend_intervals(intervals: DataFrame, fresh: DataFrame) -> DataFrame:
    """The intervals of all cells that new facts touch, to replace the stored ones of these cells.

    The new facts may have been published before stored ones.
    """
    cells = fresh.filter("value is not null and published_at is not null").select(*CELL).distinct()
    old = join_on(intervals, cells, CELL, "left_semi").withColumnRenamed("since", "published_at").drop("until")
    new = fresh.select(*CELL, "value", "source_id", "published_at")
    return fact_intervals(old.unionByName(new))


def merge_intervals(intervals: DataFrame, fresh: DataFrame) -> DataFrame:
    """All intervals after new facts; see :func:`extend_intervals` for what changes."""
    changed = extend_intervals(intervals, fresh)
    return without_keys(intervals, changed, CELL).unionByName(changed)


def _moments(dates: Sequence[str]) -> Column:
    """The dates as literals; they are a stated list and not data. Nothing is computed from them for each row."""
    return F.array(*[F.lit(d).cast("timestamp_ntz") for d in sorted(set(dates))])


def _holds(d: Column) -> Column:
    return (F.col("since") <= d) & (F.col("until").isNull() | (d < F.col("until")))


def facts_as_of(intervals: DataFrame, dates: Sequence[str]) -> DataFrame:
    """The facts that held at each of the dates: the interval columns and ``as_of``; a date counts as its first moment unless it has a time.

    No date gives no rows.
    """
    if not dates:
        return intervals.withColumn("as_of", F.lit(None).cast("timestamp_ntz")).limit(0)
    return intervals.withColumn("as_of", F.explode(F.filter(_moments(dates), _holds)))


def panels_as_of(intervals: DataFrame, dates: Sequence[str], predicates: Sequence[str]) -> DataFrame:
    """One row per (as_of, entity, time) with a column per predicate.

    Intervals that hold at none of the dates go first. The others are dealt by (entity, time), of which each has as many as dates and
    predicates at most, and the dates are spread out where they lie: no row per date is shuffled or sorted.
    """
    held = F.filter(_moments(dates), _holds) if dates else F.array().cast("array<timestamp_ntz>")
    cells = intervals.select(F.col("subject").alias("entity"), F.col("valid_from").alias("time"), "predicate", "value", held.alias("as_of"))
    cells = cells.filter(F.size("as_of") > 0).repartition("entity", "time")
    rows = cells.withColumn("as_of", F.explode("as_of"))
    # a cell has one value at a date
    of = [F.first(F.when(F.col("predicate") == p, F.col("value")), ignorenulls=True).alias(p) for p in predicates]
    return rows.groupBy("as_of", "entity", "time").agg(*of)


def changed_since(intervals: DataFrame, cursors: Sequence[str]) -> DataFrame:
    """(cursor, subject, valid_from) of the cells in which a value began to hold after each cursor.

    A publication that an equally old one of a smaller source hides began nothing by itself, but that one did.
    """
    if not cursors:
        return intervals.select(F.lit(None).cast("timestamp_ntz").alias("cursor"), "subject", "valid_from").limit(0)
    last = intervals.groupBy("subject", "valid_from").agg(F.max("since").alias("last"))
    later = F.filter(_moments(cursors), lambda d: d < F.col("last"))
    return last.select(F.explode(later).alias("cursor"), "subject", "valid_from")

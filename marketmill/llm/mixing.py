"""Mixing sources to target weights by weighted fair queueing.

Every source's shuffled documents form a stream (up to ``max_epochs`` passes).
A copy's virtual finish time is the words of its source up to and with it,
divided by the source's target; the mix is the earliest copies by that time, up
to the total budget. Running sums are taken in two levels (buckets of the
shuffle key, then rows of a bucket), so that a source with a third of all rows
is spread over many tasks; the cut is found in one narrow range of times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.llm.common import words_of
from marketmill.session import materialize

#: Ranges of the virtual time in which sizes are summed before one range is sorted.
TIME_RANGES = 1 << 16


def shuffle_key(doc_id: str, text: str, seed: int) -> Column:
    """Hex digest that orders the documents; rows without an id take their text."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.coalesce(F.col(text), F.lit(""))))
    return F.md5(F.concat(own, F.lit(f":{seed}")))


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """Words to take of every source: (source, source_size, target).

    Sources by code point, null last, take the weights in turn and share all
    words; none goes above ``max_epochs`` times its own, and what is over is
    shared again by weight. Sorted by cap per weight, the capped sources come
    first, so that one running sum gives the level of the others. There is one
    row per source here; it is the only thing that meets in one task.
    """
    by = sizes.groupBy("__source").agg(F.sum("__size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("__source"))) - 1) % len(weights)
    by = by.withColumn("__w", F.get(F.array(*map(F.lit, weights)), place).cast("long"))
    by = by.withColumn("__cap", F.lit(max_epochs) * F.col("source_size"))
    by = by.withColumn("__ratio", F.col("__cap").cast("double") / F.col("__w"))
    upto = Window.orderBy("__ratio", F.asc_nulls_last("__source")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    before = lambda c: F.coalesce(F.sum(c).over(upto), F.lit(0))
    left = F.sum("source_size").over(every) - before("__cap")
    level = left.cast("double") / (F.sum("__w").over(every) - before("__w"))
    by = by.withColumn("__level", level)
    # from the first source whose cap lies above the level, the level holds for all
    free = F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", F.col("__source").isNull(), "__source", "__level"))
    by = by.withColumn("__first", F.min(free).over(every))
    share = F.col("__first.__level") * F.col("__w")
    target = F.when(F.col("__first").isNull(), F.col("__cap").cast("double")).otherwise(
        F.least(F.col("__cap").cast("double"), share)
    )
    return by.select("__source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 7,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken, copies, source and mix_key.

    ``copies`` is how often the mix holds the document (0 to ``max_epochs``; at most
    1 if it has no words) and ``taken`` its words times that. Null texts have
    size 0, null sources are a source of their own, rows that are equal are taken
    alike, and an empty table gives no rows; other input columns are not used. ``mix_key`` is the shuffle key. Writes small intermediates
    without texts to the shared folder when called.
    """
    size = F.size(words_of(text)).cast("long")
    sizes = docs.select(
        F.col(doc_id).alias("__id"),
        F.col(source).alias("__source"),
        size.alias("__size"),
        shuffle_key(doc_id, text, seed).alias("__key"),
    )
    lean = sizes = materialize(sizes.withColumn("__bucket", F.substring("__key", 1, 3)), "mix-sizes")
    targets = materialize(source_targets(lean, weights, max_epochs), "mix-targets")
    # sums of each source's buckets give what lies before a bucket: 4,096 rows per source at most
    sums = lean.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__sum"))
    earlier = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
    sums = sums.alias("s").join(targets.alias("t"), F.col("s.__source").eqNullSafe(F.col("t.__source")))
    sums = materialize(
        sums.select(F.col("s.__source").alias("__s"), F.col("__bucket").alias("__b"), "__before", "source_size", "target"),
        "mix-sums",
    )
    # rows that tie in key and size are peers of the running sum and stay together
    within = Window.partitionBy("__source", "__bucket").orderBy("__key", "__size")
    rows = sizes.withColumn("__in", F.sum("__size").over(within.rangeBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(sums, rows["__source"].eqNullSafe(sums["__s"]) & (rows["__bucket"] == sums["__b"]))
    rows = rows.withColumn("__upto", F.col("__before") + F.col("__in"))
    rows = materialize(rows.drop("__s", "__b", "__bucket", "__in", "__before"), "mix-rows")

    def finish(epoch: Column | int) -> Column:
        words = (F.lit(epoch) if isinstance(epoch, int) else epoch) * F.col("source_size") + F.col("__upto")
        return F.coalesce(F.try_divide(words.cast("double"), F.col("target")), F.lit(0.0))

    copies = rows.select(
        "__key", "__size", "source_size", "target", "__upto",
        F.explode(F.array(*map(F.lit, range(max_epochs)))).alias("__epoch"),
    )
    copies = copies.select("__key", "__size", "__epoch", finish(F.col("__epoch")).alias("__time"))
    span = F.floor(F.col("__time") / (F.col("__time") + 1) * TIME_RANGES)
    copies = copies.withColumn("__range", span)
    ranges = copies.groupBy("__range").agg(F.sum("__size").alias("__sum"))
    upto = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__before", F.coalesce(F.sum("__sum").over(upto), F.lit(0)))
    budget = targets.agg(F.sum("source_size").alias("__budget"))
    # the range that crosses the budget, or else the last one: one row
    crossing = ranges.crossJoin(budget).filter(F.col("__before") <= F.col("__budget"))
    crossing = crossing.agg(
        F.max(F.struct("__range", "__before", "__budget")).alias("__x")
    ).select(F.col("__x.__range").alias("__cross"), F.col("__x.__before").alias("__base"), "__x.__budget")
    inside = copies.join(crossing, F.col("__range") == F.col("__cross"))
    order = Window.orderBy("__time", "__key", "__epoch", "__size").rangeBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("__sum", F.col("__base") + F.sum("__size").over(order))
    last = inside.agg(
        F.max(
            F.when(F.col("__sum") <= F.col("__budget"), F.struct("__time", "__key", "__epoch", "__size"))
        ).alias("__last")
    )
    cut = crossing.crossJoin(last)

    def taken(epoch: int) -> Column:
        t = finish(epoch)
        this = F.struct(
            t.alias("__time"), F.col("__key"), F.lit(epoch).alias("__epoch"), F.col("__size")
        )
        where = F.floor(t / (t + 1) * TIME_RANGES)
        return ((where < F.col("__cross")) | ((where == F.col("__cross")) & F.coalesce(this <= F.col("__last"), F.lit(False)))).cast("int")

    # one row, so a broadcast of it is bounded
    rows = rows.crossJoin(F.broadcast(cut))
    count = sum((taken(e) for e in range(max_epochs)), F.lit(0))
    count = F.when(F.col("__size") == 0, F.least(count, F.lit(1))).otherwise(count)
    return rows.select(
        F.col("__id").alias(doc_id), F.col("__size").alias("size"), "source_size", "target",
        (F.col("__size") * count).alias("taken"), count.alias("copies"),
        F.col("__source").alias("source"), F.col("__key").alias("mix_key"),
    )


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7, **options
) -> DataFrame:
    """The mix itself: every input row as often as ``mix`` takes it, with its columns. Rows equal in
    source, shuffle key and size are taken alike, so these three lead back to the texts."""
    lean = mix(docs, doc_id, text, source, seed=seed, **options)
    lean = lean.groupBy(F.col("source").alias("__s"), F.col("mix_key").alias("__k"), F.col("size").alias("__n")).agg(
        F.max("copies").alias("__copies")
    )
    lean = lean.filter(F.col("__copies") > 0)
    rows = docs.withColumn("__key", shuffle_key(doc_id, text, seed)).withColumn("__words", F.size(words_of(text)).cast("long"))
    same = (F.col("__key") == F.col("__k")) & (F.col("__words") == F.col("__n")) & rows[source].eqNullSafe(F.col("__s"))
    rows = rows.join(lean, same)
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*[rows[c] for c in docs.columns])

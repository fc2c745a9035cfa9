"""Ranking, paging and as-of patterns.

Raw rows may be skewed: one key can hold a third of them. The helpers here
therefore either rank with a limit, which Spark cuts down on the map side
before the shuffle (WindowGroupLimit), or work on pre-aggregated series whose
length per key is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.session import materialize

#: Rows before a page from which on whole days are skipped by their counts.
DEEP = 10_000
#: Largest rank Spark prunes on the map side by default.
MAP_SIDE_RANK_LIMIT = 1000


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank_col: str | None = None
) -> DataFrame:
    """First ``n`` rows of every key under ``order``, which has to be total.

    Up to 1,000 rows per key the rank filter is applied before the shuffle. For
    larger ``n`` each key is first ranked in 64 hash slices, so a hot key
    reaches the last step with at most 64 * n rows.
    """
    rn = rank_col or "__rn"
    if n > MAP_SIDE_RANK_LIMIT:
        salted = df.withColumn("__slice", F.pmod(F.xxhash64(*hashable(df)), F.lit(64)))
        # spread the slices even where the input is already clustered by key
        salted = salted.repartition(*keys, "__slice")
        inner = Window.partitionBy(*keys, "__slice").orderBy(*order)
        df = salted.withColumn("__pre", F.row_number().over(inner)).filter(F.col("__pre") <= n)
        df = df.drop("__pre", "__slice")
    out = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def hashable(df: DataFrame) -> list[str]:
    """Columns that Spark can hash; maps and variants are left out."""
    return [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on equal names under which null keys meet null keys; the left keys are kept."""
    other = {k: f"__right_{k}" for k in keys}
    out = left.join(
        right.withColumnsRenamed(other), reduce(and_, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()]), how
    )
    return out.drop(*other.values())


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under a total order."""
    return top_n_per_key(df, keys, order, 1)


def rank_rows(df: DataFrame, order: Sequence[Column], out: str, keys: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Number the rows from 0 under a total order, overall or within every key, without ordering a key in one task.

    Rows are dealt by ranges of (keys, order) and numbered in their range; the counts of the ranges
    before, one small row each, are added. A key's numbers start at its first row's. The numbered ranges are written
    once, since a second deal could cut them elsewhere; this runs a job when called.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = [*[F.asc_nulls_first(k) for k in keys], *order]
    ranged = df.repartitionByRange(parts, *whole).sortWithinPartitions(*whole)
    # the place in the range and the range's number, from the order in which its task hands rows on
    ranged = ranged.withColumn("__rank_id", F.monotonically_increasing_id())
    ranged = materialize(ranged, "ranked").withColumns(
        {"__rank_range": F.shiftright("__rank_id", 33).cast("int"), "__rank_at": F.col("__rank_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    counts = ranged.groupBy("__rank_range").agg(F.count("*").alias("__rank_n"))
    before = F.coalesce(F.sum("__rank_n").over(Window.orderBy("__rank_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row for each range
    offsets = counts.select("__rank_range", before.alias("__rank_before"))
    ranked = ranged.join(F.broadcast(offsets), "__rank_range").withColumn(out, F.col("__rank_before") + F.col("__rank_at"))
    if not keys:
        return ranked.select(*df.columns, out)
    # a key's start is told to each range that holds rows of it, so that a key is met range by range and never in one task
    least = ranked.groupBy("__rank_range", *keys).agg(F.min(out).alias("__rank_start"))
    start = least.withColumn("__rank_start", F.min("__rank_start").over(Window.partitionBy(*keys)))
    placed = join_on(ranked, start, ["__rank_range", *keys])
    return placed.withColumn(out, F.col(out) - F.col("__rank_start")).select(*df.columns, out)


def page(
    df: DataFrame,
    order: Sequence[Column],
    page: int | None = 0,
    limit: int | None = 100,
    partition: Sequence[str] | None = None,
    band: str | None = None,
    deep: int = DEEP,
) -> DataFrame:
    """Rows ``[page * limit, (page + 1) * limit)`` under ``order``.

    A null page counts as 0 and a null limit as 100. With ``partition`` every
    entity is paged on its own. ``band`` names the leading order column, which is descending with nulls
    last. Where ``deep`` or more rows lie before the page, its days (its values, if it
    is text) that end before the page are skipped by their counts, and the rows of the days it lies in are numbered
    by ranges (:func:`rank_rows`), so that no task orders a day or an entity; that
    runs jobs when called. There are as many counts as days.
    """
    page = page or 0
    limit = 100 if limit is None else limit
    start = page * limit
    if partition and start >= deep:
        out = rank_rows(df, order, "__rank", partition)
        return out.filter((F.col("__rank") >= start) & (F.col("__rank") < start + limit)).drop("__rank")
    if partition:
        out = top_n_per_key(df, partition, order, start + limit, rank_col="__rank")
        return out.filter(F.col("__rank") > start).drop("__rank")
    if band is None or start < deep:
        return df.orderBy(*order).offset(start).limit(limit)
    day = F.to_date(band) if dict(df.dtypes)[band].startswith("timestamp") else F.col(band)
    counts = df.groupBy(day.alias("__band")).agg(F.count("*").alias("__n"))
    upto = Window.orderBy(F.desc_nulls_last("__band")).rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumn("__end", F.sum("__n").over(upto))
    hit = ends.filter((F.col("__end") > start) & (F.col("__end") - F.col("__n") < start + limit))
    # one number comes to the driver: how many rows lie before the first value hit
    before = hit.agg(F.min(F.col("__end") - F.col("__n"))).first()[0]
    if before is None:
        return df.limit(0)
    rows = df.join(hit.select("__band"), day.eqNullSafe(F.col("__band")), "left_semi")
    skip = int(start - before)
    if skip < deep:
        return rows.orderBy(*order).offset(skip).limit(limit)
    ranked = rank_rows(rows, order, "__rank")
    return ranked.filter((F.col("__rank") >= skip) & (F.col("__rank") < skip + limit)).drop("__rank")


def previous_value(
    df: DataFrame, keys: Sequence[str], day: str, tie: str, value: str, out: str
) -> DataFrame:
    """Value of the preceding row of a key by (day, tie).

    Looked up within each day of a key, and carried over from the day before
    through one summary row per day, so that a hot key is not ordered in one task.
    """
    inner = Window.partitionBy(*keys, day).orderBy(tie)
    rows = df.withColumns({"__in": F.lag(value).over(inner), "__first": F.row_number().over(inner) == 1})
    last = df.groupBy(*keys, day).agg(F.max_by(value, tie).alias("__last"))
    carry = last.select(*keys, day, F.lag("__last").over(Window.partitionBy(*keys).orderBy(day)).alias("__carry"))
    joined = join_on(rows, carry, [*keys, day])
    return joined.withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__in"))).select(
        *df.columns, out
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, accuracy: int = 1024) -> DataFrame:
    """Exact median per key without gathering a key's values, from two reads of the rows.

    A mergeable quantile summary brackets the middle of every key between two of its values, with ranks that are off by at most one
    ``accuracy``-th of its rows. The second read counts the rows below the bracket and the distinct values
    inside, which alone are put in order. NaN is greater than any number, as in sorting; a key without values gives no row.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__v"))
    floating = dict(rows.dtypes)["__v"] in ("double", "float")
    v = F.col("__v")
    # the summary knows no NaN; as infinity it has its place, and the bracket stays open above
    plain = F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v) if floating else v
    if accuracy > 4:
        edges = F.percentile_approx(plain, F.array(F.lit(0.5 - 2 / accuracy), F.lit(0.5 + 2 / accuracy)), F.lit(accuracy))
    else:
        edges = F.array(F.min(plain), F.max(plain))
    span = rows.groupBy(*keys).agg(F.count("*").alias("__total"), edges.alias("__edges"))
    span = span.select(*keys, "__total", F.col("__edges")[0].alias("__lo"), F.col("__edges")[1].alias("__hi"))
    placed = join_on(rows, span, keys)
    above = v > F.col("__hi")
    if floating:
        above = above & (F.col("__hi") < float("inf"))
    # what lies below counts as one value, and what lies above is not needed
    inside = placed.filter(~above).withColumn("__in", F.when(v >= F.col("__lo"), v))
    inside = inside.groupBy(*keys, "__total", "__in").agg(F.count("*").alias("__n"))
    within = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("__in")).rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("__upto", F.sum("__n").over(within))
    low, high = F.floor((F.col("__total") - 1) / 2), F.floor(F.col("__total") / 2)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("__upto") - F.col("__n") <= rank) & (F.col("__upto") > rank), F.col("__in")))

    picked = inside.groupBy(*keys).agg(at(low).alias("__a"), at(high).alias("__z"))
    return picked.select(*keys, ((F.col("__a") + F.col("__z")) / 2).alias(out))


def asof_last(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
) -> DataFrame:
    """Every left row with the last right row at or before its time.

    Union and one running window: a single shuffle and sort, instead of a
    nested-loop join. Both sides have to be series with one row per key and
    calendar step, which bounds the rows per key. Right times are unique per key.
    """
    packed = F.struct(*[F.col(v) for v in values])
    left_cols = [c for c in left.columns]
    both = left.select(
        *left_cols,
        F.col(left_time).alias("__t"),
        F.lit(1).alias("__side"),
        F.lit(None).cast(right.select(packed.alias("p")).schema["p"].dataType).alias("__v"),
    ).unionByName(
        right.select(
            *[F.col(k) for k in keys],
            F.col(right_time).alias("__t"),
            F.lit(0).alias("__side"),
            packed.alias("__v"),
        ),
        allowMissingColumns=True,
    )
    w = (
        Window.partitionBy(*keys)
        .orderBy("__t", "__side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = both.withColumn("__last", F.last("__v", ignorenulls=True).over(w))
    return out.filter(F.col("__side") == 1).select(
        *left_cols, *[F.col(f"__last.{v}").alias(v) for v in values]
    )


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: str, out: str, scale: float = 100.0, few: bool = False
) -> DataFrame:
    """Value as a share of the total of its keys.

    The totals are aggregated (map side first) and joined back, so that a key
    with very many rows is never gathered in one window partition; ``df`` is
    read twice and should be cheap. With ``few`` members per key by nature, such
    as sectors of a fund, one window does it in a single pass.
    """
    if few and keys:
        total = F.sum(value).over(Window.partitionBy(*keys))
        share = F.try_divide(F.col(value).cast("double"), total.cast("double")) * scale
        return df.withColumn(out, share)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total")) if keys else df.agg(F.sum(value).alias("__total"))
    # a global total is a single row
    joined = join_on(df, totals, keys) if keys else df.crossJoin(F.broadcast(totals))
    share = F.try_divide(F.col(value).cast("double"), F.col("__total").cast("double")) * scale
    return joined.withColumn(out, share).drop("__total")

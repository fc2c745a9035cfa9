"""Keeping datasets current: gap plans, upserts, feed walks, facts, ledgers.

All operators work on the keys of a whole run at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.scalars import lead_date, month_key
from marketmill.functions.windows import first_per_key, join_on, rank_rows, top_n_per_key
from marketmill.session import materialize
from marketmill.sources.datasets import append_new, coverage, read_range, without_keys


def _date(df: DataFrame, c: str) -> Column:
    return lead_date(c) if dict(df.dtypes)[c] == "string" else F.col(c).cast("date")


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


# Ranges -----------------------------------------------------------------------


def date_gaps(requests: DataFrame, coverage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of the requested ranges that lie outside the stored ranges.

    ``requests`` has (keys, lo, hi) and ``coverage`` (keys, min_date, max_date).
    Gives up to two inclusive ranges (gap_lo, gap_hi) per request; a request
    with lo after hi is an error.
    """
    lo, hi, first, last = (F.col(c) for c in ("lo", "hi", "min_date", "max_date"))
    bad = F.raise_error(F.lit("range start after range end")).cast("date")
    req = requests.withColumn("lo", F.when(lo > hi, bad).otherwise(lo))
    j = join_on(req, coverage.select(*keys, "min_date", "max_date"), keys, "left")

    def span(a: Column, b: Column) -> Column:
        return F.struct(a.alias("gap_lo"), b.alias("gap_hi"))

    gaps = F.when(first.isNull(), F.array(span(lo, hi))).otherwise(
        F.array_compact(
            F.array(
                F.when(lo < first, span(lo, F.least(F.date_sub(first, 1), hi))),
                F.when(hi > last, span(F.greatest(F.date_add(last, 1), lo), hi)),
            )
        )
    )
    return j.select(*requests.columns, F.inline(gaps))


def interior_gaps(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Holes between stored dates, which the plain range of a key does not show."""
    days = df.select(*keys, _date(df, date_col).alias("d")).filter("d is not null").distinct()
    after = F.lead("d").over(Window.partitionBy(*keys).orderBy("d"))
    holes = days.withColumn("__next", after).filter(F.datediff("__next", "d") > 1)
    return holes.select(*keys, F.date_add("d", 1).alias("gap_lo"), F.date_sub("__next", 1).alias("gap_hi"))


def refresh_range(
    requests: DataFrame,
    existing: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    date_col: str,
    run_date: str,
) -> tuple[DataFrame, DataFrame]:
    """Fill the gaps of ranged requests from ``source``; returns (stored, answer).

    ``requests`` has one row (keys, lo, hi) per key. Without bounds the stored
    series is replaced by the source. With only ``hi`` the answer comes straight
    from the source and nothing is stored. With only ``lo`` the range ends at
    ``run_date``. The answer keeps undated rows. The gaps are written when called, and their overall range bounds the scan
    of the source.
    """
    keys = list(keys)
    lo, hi = F.col("lo"), F.col("hi")
    ranged = requests.filter(lo.isNotNull()).withColumn("hi", F.coalesce(hi, _day(run_date)))
    unbounded = requests.filter(lo.isNull() & hi.isNull()).select(*keys)
    upto = requests.filter(lo.isNull() & hi.isNotNull()).select(*keys, "hi")

    src_day = _date(source, date_col)
    gaps = date_gaps(ranged, coverage(existing, keys, date_col), keys)
    spans = materialize(gaps.select(*keys, "gap_lo", "gap_hi"), "gaps")
    # two dates come to the driver, and from there reach the scan of the source
    first, last = spans.agg(F.min("gap_lo"), F.max("gap_hi")).first()
    near = source.limit(0) if first is None else read_range(source, date_col, str(first), str(last), keep_undated=False)
    fetched = join_on(near.withColumn("__d", _date(near, date_col)), spans, keys)
    fetched = fetched.filter(F.col("__d").between(F.col("gap_lo"), F.col("gap_hi"))).select(*source.columns)
    replaced = join_on(source, unbounded, keys, "left_semi")
    kept = append_new(existing, fetched, date_col, keys)
    stored = without_keys(kept, replaced.select(*keys).distinct(), keys).unionByName(replaced, allowMissingColumns=True)

    day = _date(stored, date_col)
    answer = join_on(stored.withColumn("__d", day), ranged.select(*keys, "lo", "hi"), keys)
    answer = answer.filter(F.col("__d").isNull() | F.col("__d").between(lo, hi)).select(*stored.columns)
    direct = join_on(source.withColumn("__d", src_day), upto, keys).filter(F.col("__d").isNull() | (F.col("__d") <= hi))
    answer = answer.unionByName(replaced, allowMissingColumns=True)
    return stored, answer.unionByName(direct.select(*source.columns), allowMissingColumns=True)


def upsert_periods(
    existing: DataFrame,
    fresh: DataFrame,
    keys: Sequence[str],
    date_col: str,
    order: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """One row per key and date, fresh before stored; rows without a date are dropped.

    ``order`` ranks several rows of one side, the winner first. ``limit`` keeps
    the newest rows per key of the returned rows.
    """
    both = existing.withColumn("__src", F.lit(0)).unionByName(
        fresh.withColumn("__src", F.lit(1)), allowMissingColumns=True
    )
    dated = both.filter(F.col(date_col).isNotNull())
    out = first_per_key(dated, [*keys, date_col], [F.desc("__src"), *order]).drop("__src")
    return out if limit is None else top_n_per_key(out, keys, [F.desc(date_col)], limit)


def stale_keys(keys_df: DataFrame, coverage: DataFrame, keys: Sequence[str], as_of: str, staleness_days: int) -> DataFrame:
    """Keys to fetch again: never stored, or last updated more than the given days ago."""
    j = join_on(keys_df.select(*keys).distinct(), coverage.select(*keys, "last_updated"), keys, "left")
    age = F.datediff(_day(as_of), F.col("last_updated"))
    stale = F.col("last_updated").isNull() | (age > staleness_days) | F.lit(staleness_days < 0)
    return j.filter(stale).select(*keys, "last_updated")


# Feeds ------------------------------------------------------------------------


def new_since(
    feed: DataFrame,
    order: Sequence[Column],
    checkpoint: str | None,
    date_col: str,
    page_size: int = 100,
    max_pages: int | None = None,
) -> DataFrame:
    """Feed rows with their ``page``, down to and including the page that reaches the checkpoint.

    ``order`` is total and puts newer days first and undated rows last. Of days at or before the checkpoint at most
    one page is kept; the rows that remain are numbered by ranges (:func:`rank_rows`), so that no task
    orders a day. Only ``max_pages`` ends the walk earlier. Runs a job when called.
    """
    dated = feed.withColumn("__d", _date(feed, date_col))
    days = dated.groupBy(F.col("__d").alias("__day")).agg(F.count("*").alias("__n"))
    newer = Window.orderBy(F.desc_nulls_last("__day")).rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("__before", F.coalesce(F.sum("__n").over(newer), F.lit(0)))
    old = F.lit(False) if checkpoint is None else F.coalesce(F.col("__day") <= _day(checkpoint), F.lit(False))
    days = days.withColumn("__hit", F.min(F.when(old, F.col("__before"))).over(Window.partitionBy()))
    # the first row at or before the checkpoint stands right behind the newer ones; null: none, so all pages
    end = (F.floor(F.col("__hit") / page_size) + 1) * page_size
    if max_pages is not None:
        end = F.least(end, F.lit(page_size * max_pages))
    days = days.select(
        "__day", "__before", end.alias("__end"), (old | (F.col("__day").isNull() & F.col("__hit").isNotNull())).alias("__cut")
    )
    days = days.filter(F.col("__end").isNull() | (F.col("__before") < F.col("__end")))
    rows = dated.join(days, F.col("__d").eqNullSafe(F.col("__day")))
    # what is cut off a day stands behind the last page, so the numbers of the others do not change
    cut = top_n_per_key(rows.filter("__cut"), ["__d"], order, page_size)
    ranked = rank_rows(rows.filter(~F.col("__cut")).unionByName(cut), order, "__pos")
    out = ranked.filter(F.col("__end").isNull() | (F.col("__pos") < F.col("__end")))
    return out.select(*feed.columns, F.floor(F.col("__pos") / page_size).cast("int").alias("page"))


def new_since_per_key(
    feed: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    checkpoints: DataFrame,
    date_col: str,
    run_date: str,
    floor_days: int = 3 * 365,
    page_size: int = 100,
    max_pages: int | None = None,
) -> DataFrame:
    """The walk of :func:`new_since` for every key, with a backfill floor.

    A key's walk stops at the later of its checkpoint and the floor. ``order``
    has to put undated rows last; a page without any date is kept and ends the
    walk. ``checkpoints`` has (keys, checkpoint). Only ``max_pages`` ends a walk earlier.
    """
    keys = list(keys)
    stop = F.greatest(F.col("checkpoint"), F.date_sub(_day(run_date), floor_days))
    dated = feed.withColumn("__d", _date(feed, date_col))
    dated = join_on(dated, checkpoints.select(*keys, "checkpoint"), keys, "left").withColumn("__stop", stop)
    is_newer = F.coalesce(F.col("__d") > F.col("__stop"), F.lit(False))
    dated = dated.withColumn("__newer", is_newer).drop("checkpoint")
    per = dated.groupBy(*keys).agg(
        F.count_if("__newer").alias("__n"), F.count_if(F.col("__d") <= F.col("__stop")).alias("__older")
    )
    n = F.col("__n")
    pages = F.when(F.col("__older") > 0, F.floor(n / page_size) + 1).otherwise(F.floor((n - 1) / page_size) + 2)
    keep = pages * page_size if max_pages is None else F.least(pages, F.lit(max_pages)) * page_size
    per = per.select(*keys, "__n", keep.alias("__keep"))
    # all newer rows belong to the walk; of the rest at most two pages per key do
    newer = dated.filter("__newer").select(*feed.columns)
    if max_pages is not None:
        newer = top_n_per_key(newer, keys, order, page_size * max_pages)
    rest = top_n_per_key(dated.filter(~F.col("__newer")).select(*feed.columns), keys, order, 2 * page_size, "__rn")
    rest = join_on(rest, per, keys).filter(F.col("__rn") <= F.col("__keep") - n).select(*feed.columns)
    return newer.unionByName(rest)


def merge_feed(existing: DataFrame, fresh: DataFrame, key_cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Stored rows plus the first fresh row of every business key not stored yet."""
    return existing.unionByName(new_keys(existing, fresh, key_cols, order), allowMissingColumns=True)


def new_keys(existing: DataFrame, fresh: DataFrame, key_cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows :func:`merge_feed` adds, to be appended to a feed table as they are.

    ``order`` is the total order in which the feed was served. Of the stored feed
    only the key columns are read. Stored keys go through the ranking of the fresh rows and come before them, so
    that both are dealt by key once, and no more than a row of a key leaves a task.
    """
    key_cols = list(key_cols)
    seen = existing.select(*key_cols, F.lit(False).alias("__fresh"))
    both = fresh.withColumn("__fresh", F.lit(True)).unionByName(seen, allowMissingColumns=True)
    first = first_per_key(both, key_cols, [F.asc("__fresh"), *order])
    # where the stored keys have a wider type, the rows come back in their own
    return first.filter("__fresh").select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fresh.schema.fields])


def advance_checkpoints(seen: DataFrame, checkpoints: DataFrame, scope: Sequence[str], date_col: str) -> DataFrame:
    """Newest date per scope, null scopes too. A checkpoint never moves back."""
    scope = list(scope)
    kind = checkpoints.schema["checkpoint"].dataType
    new = seen.select(*scope, _date(seen, date_col).cast(kind).alias("checkpoint"))
    both = checkpoints.select(*scope, "checkpoint").unionByName(new)
    return both.groupBy(*scope).agg(F.max("checkpoint").alias("checkpoint")).filter("checkpoint is not null")


def upsert_snapshot(
    existing: DataFrame, fresh: DataFrame, entity: Sequence[str], payload: str, order: Sequence[Column]
) -> DataFrame:
    """One row per entity, the latest fresh row winning; empty payloads are ignored."""
    live = first_per_key(fresh.filter(F.col(payload).isNotNull()), entity, order)
    return without_keys(existing, live, entity).unionByName(live, allowMissingColumns=True)


# Universes --------------------------------------------------------------------


def refresh_worklist(
    universe: DataFrame,
    calendar: DataFrame,
    date_col: str,
    last_run: str | None,
    last_full: str | None,
    as_of: str,
    full_every_days: int = 30,
    within_universe: bool = True,
) -> DataFrame:
    """Symbols to refresh: those in the calendar since the last run.

    The first run, and one at least ``full_every_days`` after the last full one,
    take the whole universe. Without ``within_universe`` calendar symbols outside
    the universe stay in.
    """
    from datetime import date

    whole = last_run is None
    if last_full is not None:
        age = date.fromisoformat(as_of) - date.fromisoformat(last_full)
        whole = whole or age.days >= full_every_days
    if whole:
        return universe.select("symbol").distinct()
    due = calendar.filter(F.col(date_col).cast("date").between(_day(last_run), _day(as_of)))
    due = due.filter(F.col("symbol").isNotNull()).select("symbol")
    return universe.select("symbol").distinct().join(due, "symbol", "left_semi") if within_universe else due.distinct()


def refresh_universe(
    existing: DataFrame, listing: DataFrame, universe: str, order: Sequence[Column]
) -> DataFrame:
    """Replace one universe by a listing; blank symbols are dropped, one row per symbol is kept.

    Rows of other universes stay, those without a universe too.
    """
    named = listing.filter(F.trim(F.coalesce("symbol", F.lit(""))) != "")
    rows = first_per_key(named, ["symbol"], order).withColumn("universe", F.lit(universe))
    return existing.filter(~F.col("universe").eqNullSafe(universe)).unionByName(rows, allowMissingColumns=True)


# Facts ------------------------------------------------------------------------


def facts_latest(facts: DataFrame, as_of: str | None = None) -> DataFrame:
    """Latest published value of every (subject, predicate, valid_from).

    Null values are skipped, equal publication times go to the smaller source.
    ``as_of`` leaves out what was published later.
    """
    f = facts.filter(F.col("value").isNotNull())
    if as_of is not None:
        f = f.filter(F.col("published_at") <= F.lit(as_of).cast("timestamp"))
    order = [F.desc("published_at"), F.asc("source_id"), F.asc("value")]
    return first_per_key(f, ["subject", "predicate", "valid_from"], order)


def facts_panel(latest: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """One row per (entity, time) with a column per predicate, from the latest facts."""
    return (
        latest.withColumnsRenamed({"subject": "entity", "valid_from": "time"})
        .groupBy("entity", "time")
        .pivot("predicate", list(predicates))
        .agg(F.first("value"))
    )


def freshness_token(facts: DataFrame) -> DataFrame:
    return facts.agg(F.max("published_at").alias("token"))


def changed_since(facts: DataFrame, cursor: str | None) -> DataFrame:
    """Cells (subject, valid_from) published after the cursor; all without one."""
    if cursor is not None:
        facts = facts.filter(F.col("published_at") > F.lit(cursor).cast("timestamp"))
    return facts.select("subject", "valid_from").distinct()


def recompute_dirty(
    view: DataFrame,
    dirty: DataFrame,
    base: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    view_keys: Sequence[str],
    base_keys: Sequence[str],
) -> DataFrame:
    """Rebuild only the dirty cells of a derived view and keep the others.

    ``dirty`` is keyed like the base; view keys correspond to base keys by position.
    """
    cells = dirty.select(*base_keys).distinct()
    as_view = cells.withColumnsRenamed(dict(zip(base_keys, view_keys)))
    kept = without_keys(view, as_view, list(view_keys))
    return kept.unionByName(build(join_on(base, cells, list(base_keys), "left_semi")))


# Ledgers ----------------------------------------------------------------------

GIB = 1024**3


def usage_rollup(requests: DataFrame, soft_gb: float, hard_gb: float) -> DataFrame:
    """Bytes per month and category with the month total and cap flags.

    Requests without a category belong to ``user``, whom the hard cap spares.
    """
    by = requests.groupBy(
        month_key("ts").alias("month"),
        F.coalesce(F.when(F.col("category") != "", F.col("category")), F.lit("user")).alias("category"),
    ).agg(F.sum("bytes").alias("bytes"))
    total = F.sum("bytes").over(Window.partitionBy("month"))
    out = by.withColumn("monthBytes", total)
    return out.withColumns(
        {
            "overSoftCap": F.col("monthBytes") >= soft_gb * GIB,
            "overHardCap": (F.col("monthBytes") >= hard_gb * GIB) & (F.col("category") != "user"),
        }
    )


def first_breach(requests: DataFrame, cap_bytes: float) -> DataFrame:
    """The request of every month with which the running total reaches a cap.

    Running sums are taken over days of the month, then over seconds of the one
    day concerned, then over the rows of that second, so that no task orders a
    whole month. Requests without a time belong to a month of their own, whose null month they get.
    """
    r = requests.select(
        month_key("ts").alias("month"), F.to_date("ts").alias("__day"), F.date_trunc("second", "ts").alias("__sec"),
        "ts", "id", "bytes",
    )
    path: list[str] = ["month"]
    carried = r.withColumn("__before", F.lit(0).cast("bigint"))
    for level in ("__day", "__sec"):
        sums = carried.groupBy(*path, "__before", level).agg(F.sum("bytes").alias("__sum"))
        upto = Window.partitionBy(*path).orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
        run = sums.withColumn("__run", F.sum("__sum").over(upto) + F.col("__before"))
        hit = run.filter((F.col("__run") >= cap_bytes) & (F.col("__run") - F.col("__sum") < cap_bytes))
        hit = hit.select(*path, level, (F.col("__run") - F.col("__sum")).alias("__before"))
        path = [*path, level]
        carried = join_on(carried.drop("__before"), hit, path)
    upto = Window.partitionBy(*path).orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = carried.withColumn("runningBytes", F.sum("bytes").over(upto) + F.col("__before"))
    rows = rows.filter((F.col("runningBytes") >= cap_bytes) & (F.col("runningBytes") - F.col("bytes") < cap_bytes))
    return rows.select("month", "ts", "id", "runningBytes")


def latest_runs(runs: DataFrame, order: Sequence[Column]) -> DataFrame:
    return first_per_key(runs, ["category"], order)


def failure_streaks(attempts: DataFrame, n: int = 10, chunk: int = 65536) -> DataFrame:
    """First attempt of every cycle at which ``n`` paywall failures came in a row.

    ``attempts`` has (cycle, attempt_no, status) with status success, paywall or
    other; other errors neither count nor reset. Attempts are numbered, so the
    count is taken within chunks of numbers and carried from chunk to chunk
    through small summaries; a cycle of any length is never ordered in one task. Attempts without a cycle are one
    cycle, whose row has a null cycle; those without a number come first in theirs and are ordered anyhow.
    """
    ok, fail = F.col("status") == "success", F.col("status") == "paywall"
    a = attempts.withColumn("__chunk", F.floor(F.col("attempt_no") / chunk))
    inner = Window.partitionBy("cycle", "__chunk").orderBy("attempt_no").rowsBetween(Window.unboundedPreceding, 0)
    a = a.withColumn("__island", F.sum(ok.cast("int")).over(inner))
    within = Window.partitionBy("cycle", "__chunk", "__island").orderBy("attempt_no")
    a = a.withColumn("__fails", F.sum(fail.cast("int")).over(within.rowsBetween(Window.unboundedPreceding, 0)))

    per_island = a.groupBy("cycle", "__chunk", "__island").agg(F.sum(fail.cast("int")).alias("__tail"))
    chunks = per_island.groupBy("cycle", "__chunk").agg(
        F.max_by("__tail", "__island").alias("__tail"), (F.max("__island") > 0).cast("int").alias("__reset")
    )
    along = Window.partitionBy("cycle").orderBy("__chunk")
    chunks = chunks.withColumn("__group", F.sum("__reset").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    in_group = Window.partitionBy("cycle", "__group").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, 0)
    chunks = chunks.withColumn("__out", F.sum("__tail").over(in_group))
    chunks = chunks.withColumn("__in", F.coalesce(F.lag("__out").over(along), F.lit(0)))

    j = join_on(a.filter(fail), chunks.select("cycle", "__chunk", "__in"), ["cycle", "__chunk"])
    streak = F.col("__fails") + F.when(F.col("__island") == 0, F.col("__in")).otherwise(0)
    return j.filter(streak == n).groupBy("cycle").agg(F.min("attempt_no").alias("attempt_no"))

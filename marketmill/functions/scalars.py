"""Scalar column expressions. All run inside Spark; there is no UDF here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lead_date(c: Column | str) -> Column:
    """Date in the first ten characters of a text, null if it is not one."""
    return F.try_to_date(F.substring(_col(c).cast("string"), 1, 10), "yyyy-MM-dd")


def strict_lead_date(c: Column | str) -> Column:
    """Like :func:`lead_date`, but a non-null text that is no date is an error."""
    c = _col(c)
    return F.when(c.isNotNull(), F.to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd"))


def as_date(c: Column | str, dtype: str = "timestamp") -> Column:
    """Date bound from a text, date or timestamp column of the given type."""
    if dtype == "string":
        return strict_lead_date(c)
    return _col(c).cast("date")


def key_part(c: Column | str) -> Column:
    """One part of a series key; a missing optional part becomes ``_default``."""
    return F.coalesce(_col(c).cast("string"), F.lit("_default"))


def series_key(endpoint: str, *parts: Column | str) -> Column:
    """Readable series key, for display only. Tables carry the parts as columns."""
    return F.concat_ws("/", F.lit(endpoint), *[key_part(p) for p in parts])


def json_object(c: Column | str) -> Column:
    """Text as a JSON object variant; bad or non-object text becomes an empty object."""
    v = F.try_parse_json(_col(c))
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    return F.when(is_object, v).otherwise(F.parse_json(F.lit("{}")))


def month_key(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def time_order(ts: Column | str, tie: Column | str) -> Column:
    """One number that orders by (timestamp, whole-number tie-breaker).

    A number, unlike a struct, fits the fixed-width buffers of hash aggregation;
    ``min_by`` over a struct would sort all rows first.
    """
    micros = F.unix_micros(_col(ts).cast("timestamp")).cast("decimal(19,0)")
    spacing = F.lit("20000000000000000000").cast("decimal(20,0)")  # wider than the 64-bit range
    return (micros * spacing + _col(tie).cast("decimal(19,0)")).cast("decimal(38,0)")


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def quarter_index(d: Column) -> Column:
    """Running number of a quarter, so that consecutive quarters differ by one."""
    return (F.year(d) * 4 + F.quarter(d) - 1).cast("int")


def transaction_bucket(c: Column | str) -> Column:
    """Coarse class of a transaction type by its code prefix."""
    c = _col(c)
    return (
        F.when(c.startswith("P-"), "Acquisitions")
        .when(c.startswith("S-"), "Dispositions")
        .when(c.startswith("A-"), "Awards")
        .otherwise("Other")
    )


def percent_to_number(c: Column | str) -> Column:
    """``"97.29%"`` to 97.29; anything unreadable to null."""
    return F.regexp_replace(_col(c), "%", "").try_cast("double")


def amount_bounds(c: Column | str) -> tuple[Column, Column]:
    """Low and high bound of a text such as ``$15,001 - $50,000``."""
    amounts = F.transform(
        F.regexp_extract_all(_col(c), F.lit(r"\$([0-9,]+)"), F.lit(1)),
        lambda x: F.regexp_replace(x, ",", "").try_cast("bigint"),
    )
    return F.try_element_at(amounts, F.lit(1)), F.try_element_at(amounts, F.lit(-1))


def ratio(a: Column, b: Column) -> Column:
    """Division that gives null on a zero divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct_change(new: Column, old: Column) -> Column:
    """Change in percent of the absolute old value."""
    return ratio(new - old, F.abs(old)) * 100

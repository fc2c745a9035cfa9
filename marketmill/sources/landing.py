"""Landing raw JSON bodies and settling column types before a write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: largest whole number a double holds exactly.
SAFE_INTEGER = 2**53


def ingest_json(
    raw: DataFrame, body: str, schema: T.StructType, carry: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Split JSON bodies into data rows and error rows.

    A blank body gives nothing. An object with ``Error Message`` is an error, also where that is null.
    Arrays give one row per element; one that does not parse is a single row. Fields outside ``schema`` are kept as text
    in ``extra``; a row that does not parse keeps nulls and its text in ``record``.
    """
    text = F.trim(F.col(body))
    live = raw.filter(text != "")
    message = F.get_json_object(text, "$['Error Message']")
    failed = message.isNotNull() | F.coalesce(F.array_contains(F.json_object_keys(text), "Error Message"), F.lit(False))
    errors = live.filter(failed).select(*carry, message.alias("error"))
    items = F.when(text.startswith("["), F.coalesce(F.from_json(text, "array<string>"), F.array(text))).otherwise(F.array(text))
    rows = live.filter(~failed).select(*carry, F.posexplode(items).alias("pos", "record"))
    parsed = rows.withColumns(
        {
            "__r": F.from_json("record", schema, {"mode": "PERMISSIVE"}),
            "__all": F.from_json("record", "map<string,string>"),
        }
    )
    known = F.array(*[F.lit(f) for f in schema.fieldNames()])
    extra = F.map_filter("__all", lambda k, v: ~F.array_contains(known, k))
    data = parsed.select(
        *carry, "pos", *[F.col(f"__r.`{f}`").alias(f) for f in schema.fieldNames()], extra.alias("extra"), "record"
    )
    return data, errors


def _path(name: str) -> str:
    return f"$['{name}']"


def _typed(v: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, _path(name), "variant"))


def profile_types(df: DataFrame, json_col: str, columns: Sequence[str]) -> DataFrame:
    """One row of flags per column: which JSON kinds occur, and unsafe integers."""
    df = df.select(F.try_parse_json(F.col(json_col)).alias("__v"))
    v = F.col("__v")
    aggs = []
    for c in columns:
        kind = _typed(v, c)
        number = F.try_variant_get(v, _path(c), "decimal(38,0)")
        whole = kind.startswith("BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)")
        real = kind.startswith("DOUBLE") | (kind.startswith("DECIMAL") & ~whole)
        flags = F.struct(
            F.lit(c).alias("column"),
            F.max(F.coalesce(kind.startswith("STRING"), F.lit(False))).alias("has_string"),
            F.max(F.coalesce(whole, F.lit(False))).alias("has_int"),
            F.max(F.coalesce(real, F.lit(False))).alias("has_float"),
            F.max(F.coalesce(kind.startswith("BOOLEAN"), F.lit(False))).alias("has_bool"),
            F.max(F.coalesce(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(False))).alias("has_nested"),
            F.max(F.coalesce(whole & (F.abs(number) > SAFE_INTEGER), F.lit(False))).alias("unsafe_int"),
        )
        aggs.append(flags.alias(c))
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def reconcile_types(df: DataFrame, json_col: str, columns: Sequence[str]) -> DataFrame:
    """JSON fields as columns of one settled type each.

    A column becomes text if any whole number lies beyond 2^53 or if texts and
    numbers are mixed. Otherwise it is BOOLEAN, BIGINT, DOUBLE, text, or JSON
    text for nested values, in which an empty object is null.

    The profile is one pass that brings one row per column to the driver.
    """
    flags = {r["column"]: r for r in profile_types(df, json_col, columns).collect()}
    columns_kept = [f"`{x}`" for x in df.columns if x != json_col]
    df = df.select(*columns_kept, F.try_parse_json(F.col(json_col)).alias("__v"))
    v = F.col("__v")
    out = {}
    for c in columns:
        f = flags[c]
        kinds = sum(bool(f[k]) for k in ("has_string", "has_bool", "has_nested")) + bool(f["has_int"] or f["has_float"])
        if f["unsafe_int"] or f["has_string"] or kinds > 1:
            dtype = "string"
        elif f["has_bool"]:
            dtype = "boolean"
        elif f["has_float"]:
            dtype = "double"
        elif f["has_int"]:
            dtype = "bigint"
        else:
            dtype = "string"
        value = F.try_variant_get(v, _path(c), dtype)
        if f["has_nested"]:
            value = F.when(_typed(v, c) != "OBJECT<>", value)
        out[c] = value
    return df.select(*columns_kept, *[e.alias(c) for c, e in out.items()])

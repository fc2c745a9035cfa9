"""Dataset tables: one Parquet table per endpoint with key columns.

Tables are partitioned by a hash bucket of the keys, never by the keys
themselves, so the number of folders does not grow with the symbols. Rows are
sorted by key inside the files, which lets row-group statistics prune.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from marketmill.functions.scalars import lead_date
from marketmill.session import fresh_path

# The code of file_states runs in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Start of the partition column's name; the number of buckets and the keys follow, so a table knows its own.
PREFIX = "key_bucket_of_"


#: Folder of a table for the record of a replacement under way; readers of the files pass over it.
PENDING = "_pending"


def bucket_column(keys: Sequence[str], buckets: int) -> str:
    return f"{PREFIX}{buckets}_by_{'+'.join(keys)}"


def _key_order(column: str, keys: Sequence[str]) -> list[str]:
    """The keys that a table is bucketed by, in their order; a table that does not name them takes the caller's."""
    named = column.partition("_by_")[2]
    return named.split("+") if named else list(keys)


def _bucket(keys: Sequence[Column], column: str) -> Column:
    buckets = int(column.removeprefix(PREFIX).partition("_by_")[0])
    return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _named(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys]


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on keys under which null equals null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _write(df: DataFrame, path: str, column: str, keys: Sequence[str]) -> None:
    # rebalance lets AQE split a bucket that one hot key has filled
    out = df.hint("rebalance", f"`{column}`").sortWithinPartitions(column, *keys)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(
        column
    ).parquet(path)


def write_dataset(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """Create a dataset table."""
    column = bucket_column(keys, buckets)
    _write(df.withColumn(column, _bucket(_named(keys), column)), path, column, keys)


def _parquet(spark: SparkSession, path: str, schema: T.StructType, ignore_corrupt: bool = False) -> DataFrame | None:
    """A stored table with its partition column; None if there is none."""
    reader = spark.read.schema(schema)
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _open(spark: SparkSession, path: str, schema: T.StructType, ignore_corrupt: bool = False):
    """The stored table with its bucket column, and that column's name; None if there is no table.

    Files without a bucket column are a table of another kind, and an error. While a replacement is under way, or where one
    broke off behind its record, its staged rows stand for the buckets that it replaces.
    """
    pending = _pending(spark, path)
    df = _parquet(spark, path, schema, ignore_corrupt)
    if df is None and pending is None:
        return None, None
    column = next((c for c in df.columns if c.startswith(PREFIX)), None) if df is not None else None
    if column is None and df is not None and df.inputFiles():
        raise ValueError(f"{path} has no bucket column: not a dataset table")
    if pending is None:
        return (df, column) if column else (None, None)
    staged = spark.read.schema(T.StructType([*schema.fields, T.StructField(pending["column"], T.IntegerType())])).parquet(pending["stage"])
    if column is None:
        return staged, pending["column"]
    return df.filter(~F.col(column).isin(list(pending["buckets"]))).unionByName(staged), column


_RECORD = "stage string, column string, buckets array<int>"


def _pending(spark: SparkSession, path: str):
    """The record of a replacement that has not been finished, if there is one."""
    df = None
    try:
        df = spark.read.schema(_RECORD).json(f"{path}/{PENDING}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return None if df is None else df.first()


def _remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this module has written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_dataset(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    keys: dict[str, object] | None = None,
    ignore_corrupt: bool = False,
) -> DataFrame:
    """Rows of a dataset, optionally of one key. A missing table is empty.

    A full key, in any order, reads its bucket's folder only; one of some of the columns is a filter. With ``ignore_corrupt`` unreadable
    files count as nothing stored; see :func:`skipped_files` for which ones.
    """
    df, column = _open(spark, path, schema, ignore_corrupt)
    if df is None:
        return spark.createDataFrame([], schema)
    if keys:
        order = _key_order(column, list(keys))
        if set(order) == set(keys):
            # folds to a number while planning, and so prunes partitions
            df = df.filter(F.col(column) == _bucket([F.lit(keys[k]) for k in order], column))
        for k, v in keys.items():
            df = df.filter(F.col(k).eqNullSafe(F.lit(v)))
    return df.select(*schema.fieldNames())


def read_keys(
    spark: SparkSession, path: str, schema: T.StructType, wanted: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows of all keys in ``wanted``, reading the buckets of these keys only where the keys are full."""
    df, column = _open(spark, path, schema)
    if df is None:
        return spark.createDataFrame([], schema)
    wanted = wanted.select(*keys).distinct()
    order = _key_order(column, keys)
    if set(order) == set(keys):
        touched = [r[0] for r in wanted.select(_bucket(_named(order), column)).distinct().collect()]
        df = df.filter(F.col(column).isin(touched))
    return df.join(wanted, null_safe(df, wanted, keys), "left_semi").select(*schema.fieldNames())


#: What a file can be, by its first and last bytes. The format's mark.
MARK, TAIL = b"PAR1", 8


def file_states(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, state) of the files of a table: sound, empty (no bytes) or broken.

    Only the first bytes and the last ones of each file are read, by tasks: a sound file begins and ends with the format's mark, and its footer
    fits into it. A sound file without rows is sound. A table that is not there has no files.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        files = listed.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, length long, state string")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote, urlsplit

        from pyarrow import fs

        for batch in batches:
            states = []
            for uri, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if length < 2 * len(MARK) + 4:
                    states.append("broken" if length else "empty")
                    continue
                local = uri.startswith("file:")
                store, inner = (fs.LocalFileSystem(), unquote(urlsplit(uri).path)) if local else fs.FileSystem.from_uri(uri)
                with store.open_input_file(inner) as f:
                    head = f.read(len(MARK))
                    f.seek(length - TAIL)
                    tail = f.read(TAIL)
                footer = int.from_bytes(tail[:4], "little")
                sound = head == MARK == tail[4:] and footer <= length - len(MARK) - TAIL
                states.append("sound" if sound else "broken")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(states, pa.string())], ["path", "length", "state"])

    some = files.select("path", "length").mapInArrow(look, "path string, length long, state string")
    # a scan passes over files without bytes, which the listing names; the planner holds that listing anyway
    named = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string")
    plain = lambda c: F.url_decode(F.regexp_replace(c, "^file:/+", "file:/"))
    empty = named.join(files.select(plain("path").alias("__p")), plain("path") == F.col("__p"), "left_anti")
    return some.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"), F.lit("empty").alias("state")))


def skipped_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a table that give nothing when corrupt files are ignored: see :func:`file_states`."""
    return file_states(spark, path).filter("state <> 'sound'")


def read_range(
    df: DataFrame, date_col: str, lo: str | None = None, hi: str | None = None, keep_undated: bool = True
) -> DataFrame:
    """Rows within inclusive date bounds; rows without a readable date stay by default.

    On DATE and TIMESTAMP columns the bounds are compared with the raw column
    and so reach the Parquet scan. Only text columns have to be parsed.
    """
    dtype = dict(df.dtypes)[date_col]
    raw = lead_date(date_col) if dtype == "string" else F.col(date_col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (raw >= F.lit(lo).cast("date"))
    if hi is not None:
        end = F.lit(hi).cast("date")
        cond = cond & ((raw <= end) if dtype in ("date", "string") else (raw < F.date_add(end, 1)))
    if lo is None and hi is None:
        return df
    return df.filter(cond | raw.isNull() if keep_undated else cond)


def overwrite_keys(
    spark: SparkSession, df: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 256,
    replaced: DataFrame | None = None,
) -> None:
    """Replace all rows of the keys found in ``df`` and leave other keys alone.

    ``replaced`` names the keys instead where some of them have no rows any more.

    Only the buckets these keys fall into are read and rewritten. The new
    content is staged in the shared folder first, because a path cannot be
    overwritten while it is being read; a table whose replacement broke off is read as the old one or the new one. ``buckets`` counts for a new table only.
    """
    _replace(spark, df.select(*schema.fieldNames()), df if replaced is None else replaced, path, schema, keys, buckets)


def delete_keys(
    spark: SparkSession, doomed: DataFrame, path: str, schema: T.StructType, keys: Sequence[str]
) -> None:
    """Delete all rows of the given keys."""
    _replace(spark, None, doomed, path, schema, keys, 1)


def _replace(spark, fresh, replaced, path, schema, keys, buckets) -> None:
    """Stage the new content of the touched buckets, record it, and put it in place.

    Before the record is written the table is the old one, and from then on the new one, whichever step an error
    hits: readers take the staged rows until they are in place, and the next replacement finishes the broken one first.
    """
    if (pending := _pending(spark, path)) is not None:
        _finish(spark, path, schema, pending)
    stored, column = _open(spark, path, schema)
    if stored is None and fresh is None:
        return
    column = column or bucket_column(keys, buckets)
    order = _key_order(column, keys)
    if set(order) != set(keys):
        raise ValueError(f"{path} is bucketed by {order}, not by {list(keys)}")
    replaced = replaced.select(*keys).distinct()
    # at most as many small numbers as there are buckets come to the driver
    touched = [r[0] for r in replaced.select(_bucket(_named(order), column)).distinct().collect()]
    if not touched:
        return
    out = None if fresh is None else fresh.withColumn(column, _bucket(_named(order), column))
    if stored is not None:
        stored = stored.filter(F.col(column).isin(touched))
        keep = stored.join(replaced, null_safe(stored, replaced, keys), "left_anti")
        out = keep if out is None else keep.unionByName(out)
    stage = fresh_path(spark, "stage")
    recorded = False
    try:
        out.write.parquet(stage)
        record = spark.createDataFrame([(stage, column, touched)], _RECORD).coalesce(1)
        record.write.mode("overwrite").json(f"{path}/{PENDING}")
        recorded = True
    finally:
        if not recorded:
            _remove(spark, stage)
    _finish(spark, path, schema, record.first())


def _finish(spark, path, schema, record) -> None:
    """Put staged buckets in place, empty those without rows, and take the record and the stage away."""
    column, stage = record["column"], record["stage"]
    staged = spark.read.schema(T.StructType([*schema.fields, T.StructField(column, T.IntegerType())])).parquet(stage)
    _write(staged, path, column, _key_order(column, []))
    # a bucket left without rows is not among the written ones and has to be emptied
    left = {r[0] for r in staged.select(column).distinct().collect()}
    for bucket in sorted(set(record["buckets"]) - left):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{column}={bucket}")
    _remove(spark, f"{path}/{PENDING}")
    _remove(spark, stage)


def append_new(existing: DataFrame, fresh: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Stored rows plus the fresh rows whose date is not stored yet for their key."""
    return existing.unionByName(new_dates(existing, fresh, date_col, keys), allowMissingColumns=True)


def new_dates(existing: DataFrame, fresh: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """The fresh rows :func:`append_new` adds, to be appended to a table as they are.

    Duplicates inside the fresh batch are all kept, and a null date counts as a
    date of its own. Of the stored rows only key and date are read.
    """
    on = [*keys, date_col]
    seen = existing.select(*on).distinct()
    return fresh.join(seen, null_safe(fresh, seen, on), "left_anti")


def coverage(df: DataFrame, keys: Sequence[str], date_col: str, as_of: str | None = None) -> DataFrame:
    """Stored range per key; keys without any readable date have none."""
    d = lead_date(date_col) if dict(df.dtypes)[date_col] == "string" else F.col(date_col).cast("date")
    out = df.groupBy(*keys).agg(
        F.min(d).alias("min_date"), F.max(d).alias("max_date"), F.count("*").alias("record_count")
    )
    out = out.filter(F.col("min_date").isNotNull())
    return out if as_of is None else out.withColumn("last_updated", F.lit(as_of).cast("date"))


def list_keys(df: DataFrame, keys: Sequence[str], prefix: dict[str, object] | None = None) -> DataFrame:
    for k, v in (prefix or {}).items():
        df = df.filter(F.col(k) == F.lit(v))
    return df.select(*keys).distinct()


def without_keys(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``doomed``."""
    d = doomed.select(*keys).distinct()
    return df.join(d, null_safe(df, d, keys), "left_anti")


def prices(table: DataFrame, asset_class: str | None = None) -> DataFrame:
    """The price table shared by all asset classes, or one class of it."""
    return table if asset_class is None else table.filter(F.col("assetClass") == asset_class)

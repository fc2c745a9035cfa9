"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column | str) -> Column:
    """Array of the white-space separated words; null text has none."""
    col = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), f"{SPACE}+"), "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes not to be a column (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def add_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add columns; an input column of the same name (in any case) is replaced in its place."""
    return df.withColumns(new)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that what is unpacked into Python objects at once stays small.

    A piece has at most ``rows`` rows and about ``size`` bytes, but one row at least.
    """
    for batch in batches:
        at = 0
        each = max(1, batch.nbytes // max(1, batch.num_rows))
        step = max(1, min(rows, size // each))
        while at < batch.num_rows:
            yield batch.slice(at, step)
            at += step


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as one compressed value; bytes of equal weight lie together, which packs better."""
    head = b"".join(np.array([len(c), c.itemsize], np.uint32).tobytes() for c in columns)
    body = b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(np.uint32(len(columns)).tobytes() + head + body)


def unpacked(blob: bytes) -> list[np.ndarray]:
    """The columns of :func:`packed`, as unsigned numbers of their width."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = np.frombuffer(data, np.uint32, 1).tolist()
    out, at = [], 4 + 8 * n
    for size, width in np.frombuffer(data, np.uint32, 2 * n, 4).reshape(n, 2).tolist():
        planes = np.frombuffer(data, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).view(f"u{width}").reshape(size))
        at += size * width
    return out

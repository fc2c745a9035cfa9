"""Feeds and snapshots with their state kept by key.

A batch looks up and changes the state of its own keys only, and appends what is new to a plain Parquet table, so that its
cost does not grow with what is stored. State lives in the checkpoint of the query; a batch that is run
again finds the state as it was, and the sink commits its files once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from marketmill.functions.windows import first_per_key
from marketmill.streaming.jobs import ONCE

# The code below runs in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: State store that keyed state needs. The setting and the class.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Parts of a shuffle partition whose rows are put in order together.
SLICES = 16


class _Rank:
    """Place of a row under (column, ascending) pairs, as Spark sorts: nulls first if ascending, last if not, NaN above all numbers."""

    def __init__(self, row: Sequence, order: Sequence[tuple[int, bool]]) -> None:
        self.values = [(row[i], up) for i, up in order]

    def __lt__(self, other: _Rank) -> bool:
        for (a, up), (b, _) in zip(self.values, other.values):
            if a is None or b is None:
                if (a is None) != (b is None):
                    return (a is None) == up
                continue
            a, b = ((x != x, x) if isinstance(x, float) else x for x in (a, b))
            if isinstance(a, tuple) and a[0] and b[0]:
                continue
            if a != b:
                return (a < b) == up
        return False


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers that compare like the values of a column in Spark's ascending order; equal values have equal ones."""
    try:
        codes = pc.rank(column, "ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
    except pa.ArrowNotImplementedError:
        values = [tuple(v.values()) if isinstance(v, dict) else v for v in column.to_pylist()]
        order = sorted(range(len(values)), key=lambda i: _Rank((values[i],), [(0, True)]))
        codes, code = np.zeros(len(values), np.int64), 0
        for a, b in zip(order, order[1:]):
            code += _Rank((values[a],), [(0, True)]) < _Rank((values[b],), [(0, True)])
            codes[b] = code
        return codes
    # nulls come first, and NaN stays above all numbers
    return np.where(column.is_null().to_numpy(), 0, codes)


def _best_rows(keys: Sequence[str], order: Sequence[tuple[str, bool]]):
    """Of the rows of an Arrow table the first one of every key under ``order``, pairs of a column and whether it ascends."""

    def best(rows: pa.Table) -> pa.Table:
        if rows.num_rows < 2:
            return rows
        of_key = [_codes(rows[k]) for k in keys]
        ranks = [codes if up else -codes for codes, up in ((_codes(rows[c]), up) for c, up in order)]
        place = np.lexsort([*ranks[::-1], *of_key[::-1]])
        new = np.zeros(len(place), bool)
        new[0] = True
        for codes in of_key:
            new[1:] |= np.diff(codes[place]) != 0
        return rows if new.all() else rows.take(pa.array(place[new]))

    return best


def _first_of_batch(feed: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """The first row of every key of each micro-batch, without state.

    Copies go within Arrow batches before the shuffle, so that a key with very many brings few rows. What is left is dealt
    into SLICES parts of the keys for every shuffle partition, each of which is sorted in Arrow by itself.
    """
    schema, best = T.StructType([T.StructField(f.name, f.dataType) for f in feed.schema.fields]), _best_rows(keys, order)

    def fewer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from best(pa.Table.from_batches([batch])).to_batches()

    parts = SLICES * int(feed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    return feed.mapInArrow(fewer, schema).groupBy(part).applyInArrow(lambda rows: best(rows), schema)


class _Best(StatefulProcessor):
    """Hands on the best row of a key when it is the first one (``once``) or better than the one before."""

    def __init__(self, schema: T.StructType, order: Sequence[tuple[int, bool]], once: bool, expire_ms: int | None) -> None:
        self.schema, self.order, self.once, self.expire_ms = schema, list(order), once, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # for the first row alone it is enough to know that there was one
        kind = T.StructType([T.StructField("seen", T.BooleanType())]) if self.once else self.schema
        self.state = handle.getValueState("best", kind, self.expire_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = tuple(self.state.get()) if self.state.exists() else None
        if self.once and before is not None:
            return
        best, rank = before, None if before is None else _Rank(before, self.order)
        for row in rows:
            mine = _Rank(row, self.order)
            if rank is None or mine < rank:
                best, rank = tuple(row), mine
        if best is not before:
            self.state.update((True,) if self.once else best)
            yield Row(**dict(zip(self.schema.fieldNames(), best)))

    def close(self) -> None:
        pass


def _start(
    feed: DataFrame, path: str, keys: Sequence[str], order: Sequence[tuple[str, bool]], checkpoint: str, trigger: dict,
    once: bool, expire_ms: int | None,
) -> StreamingQuery:
    if once and expire_ms is None:
        # keys for ever are Spark's own state, without a call into Python for every key
        out = _first_of_batch(feed, keys, order).dropDuplicates(list(keys))
    else:
        names = feed.columns
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in feed.schema.fields])
        best = _Best(schema, [(names.index(c), up) for c, up in order], once, expire_ms)
        out = feed.groupBy(*keys).transformWithState(best, schema, "Append", "None" if expire_ms is None else "ProcessingTime")
    conf = feed.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKS)
    try:
        # the query takes the setting over when it starts
        return (
            out.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )
    finally:
        conf.unset(STORE) if before is None else conf.set(STORE, before)


def start_keyed_feed(
    feed: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]],
    checkpoint: str,
    trigger: dict = ONCE,
    expire_ms: int | None = None,
) -> StreamingQuery:
    """Append the first row seen of every business key to a Parquet table, however late it comes.

    Of the rows of one batch ``order``, pairs of a column and whether it ascends, picks the first. Null keys are keys. Keys are
    remembered for ``expire_ms`` after they were seen, for ever by default; a key that comes again later counts as new. Bytes
    written by a batch are those of its new rows and of their keys' state. For ever means Spark's own deduplication; with
    ``expire_ms`` every key of a batch costs calls between Python and its state, about a millisecond.
    """
    return _start(feed, path, keys, order, checkpoint, trigger, True, expire_ms)


def start_keyed_snapshot(
    feed: DataFrame,
    path: str,
    entity: Sequence[str],
    payload: str,
    order: Sequence[tuple[str, bool]],
    checkpoint: str,
    trigger: dict = ONCE,
    expire_ms: int | None = None,
) -> StreamingQuery:
    """Append each entity's row to a Parquet table whenever it comes before all rows seen of the entity under ``order``.

    Rows without a payload are passed over. :func:`read_snapshot` gives the one that holds. With ``expire_ms`` an
    entity without a better row for so long is forgotten by the stream, and stays in the table.
    """
    live = feed.filter(F.col(payload).isNotNull())
    return _start(live, path, entity, order, checkpoint, trigger, False, expire_ms)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, entity: Sequence[str], order: Sequence[tuple[str, bool]]) -> DataFrame:
    """One row per entity of a table written by :func:`start_keyed_snapshot`: the best one, which came last."""
    rows = spark.read.schema(schema).parquet(path)
    return first_per_key(rows, entity, [F.asc(c) if up else F.desc(c) for c, up in order])

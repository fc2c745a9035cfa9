"""Recursive indicators over series of any length: an associative scan over chunks.

Bars are dealt by ranges of (symbol, date), so that a long series lies in many tasks. A smoothing step is affine in
the value before it, and so is a whole chunk: what the chunk does to any state follows from running it on a few basis states.

1. Every task computes the symbols that begin in it. For its first symbol, which may have begun
   earlier, it leaves a summary: the first bars of the chunk (which may still belong to the warm-up), and the affine map of the others.
2. The summaries of a symbol are composed in order, which gives the state before each chunk.
3. Only bars of such first symbols are read once more, now from their states.

There are at most two summaries per task, and one state per task comes to the driver. ADX smooths a quotient of smoothed
values, so it takes two scans. The state behind the last bar of every symbol can be stored, and new bars continue from it.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.functions.windows import join_on
from marketmill.operators.indicators import RECURSIVE_INDICATORS, _Adx, _engine, _Rsi, _Smoother
from marketmill.session import materialize

# The code below runs in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What a row of the first pass is.
_STATE, _BAR, _SUMMARY, _END = range(4)


class _Passed:
    """Stands for the last smoother of ADX in the first scan: hands its input on."""

    def feed(self, x: np.ndarray) -> np.ndarray:
        return x


class _Plain:
    """The last smoother of ADX in the second scan; its input stands in the place of the close."""

    def __init__(self, n: int, kernels: dict) -> None:
        self.smoother = _Smoother(1.0 / n, n, kernels)

    def feed(self, high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
        return self.smoother.feed(close)


class _Track:
    """One indicator along one series, with its state as a list of numbers."""

    def __init__(self, name: str, n: int, kernels: dict) -> None:
        self.name, self.n = name, n
        if name == "smooth":
            self.engine = _Plain(n, kernels)
            self.bar, self.smoothers, self.head = [], [self.engine.smoother], n
        elif name == "dx":
            self.engine = _Adx(n, kernels)
            self.engine.dx = _Passed()
            self.bar, self.head = ["high", "low", "close"], n + 1
            self.smoothers = [self.engine.tr, self.engine.up, self.engine.down]
        elif name == "rsi":
            self.engine = _Rsi(n, kernels)
            self.bar, self.smoothers, self.head = ["prev"], [self.engine.gain, self.engine.loss], n + 1
        else:
            self.engine = _engine(name, n, kernels)
            self.bar, self.smoothers = [], self.engine.stages
            self.head = len(self.smoothers) * (n - 1) + 1

    def known(self, bars: np.ndarray) -> np.ndarray:
        return np.flatnonzero(~np.isnan(bars).any(axis=0) if self.name == "dx" else ~np.isnan(bars[2]))

    def feed(self, bars: np.ndarray) -> np.ndarray:
        """Values for bars (high, low, close); a bar without the prices that are needed has none and leaves the state as it is."""
        out = np.full(bars.shape[1], np.nan)
        at = self.known(bars)
        if len(at):
            out[at] = self.engine.feed(*bars[:, at])
        return out

    def seen_bar(self, bar: np.ndarray) -> None:
        for name, value in zip(self.bar, bar[-len(self.bar) :] if self.bar else ()):
            setattr(self.engine, name, float(value))

    def export(self) -> list[float]:
        return [float(getattr(self.engine, b)) for b in self.bar] + [float(v) for s in self.smoothers for v in (s.seen, s.acc, s.last)]

    def load(self, state: Sequence[float]) -> None:
        k = len(self.bar)
        for name, value in zip(self.bar, state):
            setattr(self.engine, name, float(value))
        for i, s in enumerate(self.smoothers):
            seen, s.acc, s.last = state[k + 3 * i : k + 3 * i + 3]
            s.seen = int(seen)

    def size(self) -> int:
        return len(self.bar) + 3 * len(self.smoothers)


class _Span:
    """What a chunk does to any state: its first known bars as they are, and the affine map of the others."""

    def __init__(self, name: str, n: int, kernels: dict) -> None:
        self.name, self.n, self.kernels = name, n, kernels
        self.track = _Track(name, n, kernels)
        self.heads: list[np.ndarray] = []
        self.left, self.basis, self.last = self.track.head, None, None

    def feed(self, bars: np.ndarray) -> None:
        bars = bars[:, self.track.known(bars)]
        if self.left and bars.shape[1]:
            head, bars = bars[:, : self.left], bars[:, self.left :]
            self.heads.append(head.copy())
            self.left -= head.shape[1]
            self.last = head[:, -1].copy()
        if not bars.shape[1]:
            return
        if self.basis is None:
            k = len(self.track.smoothers)
            self.basis = [_Track(self.name, self.n, self.kernels) for _ in range(k + 1)]
            for i, t in enumerate(self.basis):
                t.seen_bar(self.last)
                for j, s in enumerate(t.smoothers, 1):
                    s.seen, s.last = self.n, float(i == j)
        for t in self.basis:
            t.feed(bars)
        self.last = bars[:, -1].copy()

    def summary(self) -> tuple:
        ends = None if self.basis is None else np.array([[s.last for s in t.smoothers] for t in self.basis])
        return np.concatenate(self.heads, axis=1) if self.heads else np.zeros((3, 0)), ends, self.last


def _advance(track: _Track, summary: tuple) -> None:
    """Move a state over a chunk."""
    head, ends, last = summary
    track.feed(head)
    if ends is not None:
        before = np.array([s.last for s in track.smoothers])
        after = ends[0] + before @ (ends[1:] - ends[0])
        for s, v in zip(track.smoothers, after):
            s.last = float(v)
        track.seen_bar(last)


def _tracks(specs) -> list[_Track]:
    kernels: dict = {}
    return [_Track(name, n, kernels) for _, name, n in specs]


def _export(tracks: list[_Track]) -> list[float]:
    return [v for t in tracks for v in t.export()]


def _load(tracks: list[_Track], state: Sequence[float]) -> None:
    at = 0
    for t in tracks:
        t.load(state[at : at + t.size()])
        at += t.size()


def _bars(batch: pa.RecordBatch, inputs: Sequence[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in inputs])


def _runs(column: pa.Array) -> Iterator[tuple[int, int, object]]:
    """(start, end, value) of the stretches of equal values; nulls are equal."""
    coded = column.dictionary_encode(null_encoding="encode")
    code = coded.indices.to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]
    return ((a, b, coded.dictionary[int(code[a])].as_py()) for a, b in zip(cuts[:-1], cuts[1:]))


def _first_pass(specs, inputs_of, columns: list[str], schema: T.StructType):
    """Values of the symbols that begin in this task; summaries of its first and last symbol; states of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target, part = to_arrow_schema(schema), TaskContext.get().partitionId()
        nothing = object()
        current, first, tracks, spans = nothing, True, [], None

        def note(kind: int, symbol, state=None, blob=None) -> pa.RecordBatch:
            values = {"symbol": symbol, "__row": kind, "__part": part, "__state": state, "__blob": blob}
            return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], type=f.type) for f in target], schema=target)

        def left(last: bool) -> pa.RecordBatch:
            if spans is not None:
                return note(_SUMMARY, current, blob=pickle.dumps([s.summary() for s in spans]))
            return note(_SUMMARY if last else _END, current, state=_export(tracks))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            n = batch.num_rows
            kinds = batch.column("__row").to_numpy(zero_copy_only=False)
            bars = {c: _bars(batch, inputs) for c, inputs in inputs_of.items()}
            values = [np.full(n, np.nan) for _ in specs]
            pending = np.zeros(n, bool)
            for a, b, symbol in _runs(batch.column("symbol")):
                if current is nothing or symbol != current:
                    if current is not nothing:
                        yield left(False)
                    first, current = current is nothing, symbol
                    tracks = _tracks(specs)
                    kernels: dict = {}
                    spans = [_Span(name, n, kernels) for _, name, n in specs] if first else None
                if kinds[a] == _STATE:
                    # with a stored state the symbol begins here
                    spans = None
                    _load(tracks, batch.column("__state")[a].as_py())
                    a += 1
                if a == b:
                    continue
                pending[a:b] = spans is not None
                for i, (c, _, _) in enumerate(specs):
                    part_of = bars[c][:, a:b]
                    if spans is None:
                        values[i][a:b] = tracks[i].feed(part_of)
                    else:
                        spans[i].feed(part_of)
            keep = pa.array(kinds == _BAR)
            made = {c: batch.column(c) for c in columns} | {c: pa.array(v, from_pandas=True) for (c, _, _), v in zip(specs, values)}
            made |= {"__row": batch.column("__row"), "__part": pa.array(np.full(n, part, np.int32)), "__pending": pa.array(pending)}
            out = [made[f.name].cast(f.type) if f.name in made else pa.nulls(n, f.type) for f in target]
            yield pa.RecordBatch.from_arrays(out, schema=target).filter(keep)
        if current is not nothing:
            yield left(True)

    return run


def _compose(specs):
    """From summaries by (symbol, part): the state before every chunk that needs one, and the last state of a symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        current, tracks, out = nothing, [], []
        for batch in batches:
            for symbol, part, state, blob in zip(*(batch.column(c).to_pylist() for c in ("symbol", "__part", "__state", "__blob"))):
                if current is nothing or symbol != current:
                    if current is not nothing:
                        out.append((current, None, _export(tracks)))
                    current, tracks = symbol, _tracks(specs)
                if blob is None:
                    _load(tracks, state)
                else:
                    out.append((symbol, part, _export(tracks)))
                    for track, summary in zip(tracks, pickle.loads(blob)):
                        _advance(track, summary)
        if current is not nothing:
            out.append((current, None, _export(tracks)))
        if out:
            kinds = [batch.schema.field("symbol").type, pa.int32(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["symbol", "__part", "__state"])

    return run


def _second_pass(specs, inputs_of, columns: list[str], states: dict, schema: T.StructType):
    """Values of bars by (part, date), from the state before each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target, current, tracks = to_arrow_schema(schema), None, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            bars = {c: _bars(batch, inputs) for c, inputs in inputs_of.items()}
            values = [np.full(batch.num_rows, np.nan) for _ in specs]
            for a, b, part in _runs(batch.column("__part")):
                if part != current:
                    current, tracks = part, _tracks(specs)
                    _load(tracks, states[current])
                for i, (c, _, _) in enumerate(specs):
                    values[i][a:b] = tracks[i].feed(bars[c][:, a:b])
            made = {c: batch.column(c) for c in columns} | {c: pa.array(v, from_pandas=True) for (c, _, _), v in zip(specs, values)}
            yield pa.RecordBatch.from_arrays([made[f.name].cast(f.type) for f in target], schema=target)

    return run


def _scan(bars: DataFrame, specs: list[tuple[str, str, int]], inputs_of: dict, parts: int, state: DataFrame | None):
    """Bars with one column per spec, and (symbol, __state) behind their last bars."""
    columns = bars.columns
    doubles = [T.StructField(c, T.DoubleType()) for c, _, _ in specs]
    plain = T.StructType([*bars.schema.fields, *doubles])
    rows = bars.withColumns({"__row": F.lit(_BAR), "__state": F.lit(None).cast("array<double>")})
    if state is not None:
        rows = rows.unionByName(state.select("symbol", "__state").withColumn("__row", F.lit(_STATE)), allowMissingColumns=True)
    order = [F.asc_nulls_first("symbol"), F.asc("__row"), F.asc_nulls_first("date")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    notes = T._parse_datatype_string("__row int, __part int, __pending boolean, __state array<double>, __blob binary")
    nullable = [T.StructField(f.name, f.dataType) for f in bars.schema.fields]
    wide = T.StructType([*nullable, *doubles, *notes.fields])
    done = materialize(rows.mapInArrow(_first_pass(specs, inputs_of, columns, wide), wide), "series")
    kind = bars.schema["symbol"].dataType
    composed = T.StructType([T.StructField("symbol", kind), T.StructField("__part", T.IntegerType()), T.StructField("__state", T.ArrayType(T.DoubleType()))])
    summaries = done.filter(F.col("__row") == _SUMMARY).select("symbol", "__part", "__state", "__blob")
    summaries = summaries.repartition("symbol").sortWithinPartitions(F.asc_nulls_first("symbol"), "__part")
    summaries = materialize(summaries.mapInArrow(_compose(specs), composed), "series-states")
    # one state for each task at most
    states = {r["__part"]: list(r["__state"]) for r in summaries.filter("__part is not null").select("__part", "__state").collect()}
    whole = done.filter((F.col("__row") == _BAR) & ~F.col("__pending")).select(*columns, *[c for c, _, _ in specs])
    late = done.filter((F.col("__row") == _BAR) & F.col("__pending")).select(*columns, "__part")
    late = late.repartitionById(parts, F.col("__part")).sortWithinPartitions("__part", F.asc_nulls_first("date"))
    late = late.mapInArrow(_second_pass(specs, inputs_of, columns, states, plain), plain)
    ends = done.filter(F.col("__row") == _END).select("symbol", "__state")
    return whole.unionByName(late), ends.unionByName(summaries.filter("__part is null").select("symbol", "__state"))


def _label(specs: Sequence[tuple[str, str, int]]) -> str:
    return ",".join(f"{name}:{n}" for _, name, n in specs)


def recursive_indicators(
    bars: DataFrame, specs: Sequence[tuple[str, str, int]], state: DataFrame | None = None, parts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bars with one column per (column name, indicator, period length), and the states behind their last bars.

    ``bars`` has symbol, date, high, low, close and any other columns; the indicators are ema, dema, tema, rsi and adx. No task holds
    more than its range of the bars, however long a series is. Values are those of
    :func:`marketmill.operators.indicators.indicators` up to rounding.

    The second result is (symbol, specs, state). It can be stored and given as ``state`` with later bars and the same
    specs; symbols without new bars keep theirs. Bars of a symbol without a state begin a series. Bars without a
    symbol are one series, bars without a date come first in theirs, and the order of bars of one date is not defined. An empty table gives no rows and leaves the given states. Runs jobs when
    called and writes intermediates to the shared folder.
    """
    specs = list(specs)
    for _, name, n in specs:
        if name not in RECURSIVE_INDICATORS:
            raise ValueError(f"unknown indicator {name!r}")
        if n < 1:
            raise ValueError("period length must be positive")
    parts = parts or int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    label = _label(specs)
    prices = ("high", "low", "close")
    one = [(f"__{c}" if name == "adx" else c, "dx" if name == "adx" else name, n) for c, name, n in specs]
    two = [(c, "smooth", n) for c, name, n in specs if name == "adx"]
    size_one = sum(t.size() for t in _tracks(one))
    first = second = None
    if state is not None:
        same = F.when(F.col("specs") == label, F.col("state")).otherwise(
            F.raise_error(F.lit(f"the state is not of {label}")).cast("array<double>")
        )
        state = state.select("symbol", same.alias("__all"))
        first = state.select("symbol", F.slice("__all", 1, size_one).alias("__state"))
        second = state.select("symbol", F.expr(f"slice(__all, {size_one + 1}, size(__all))").alias("__state"))
    out, ends = _scan(bars, one, {c: prices for c, _, _ in one}, parts, first)
    if two:
        out, more = _scan(out, two, {c: (f"__{c}",) * 3 for c, _, _ in two}, parts, second)
        ends = join_on(ends, more.withColumnRenamed("__state", "__more"), ["symbol"])
        ends = ends.select("symbol", F.concat("__state", "__more").alias("__state"))
    states = ends.select("symbol", F.lit(label).alias("specs"), F.col("__state").alias("state"))
    return out.select(*bars.columns, *[c for c, _, _ in specs]), states

"""Technical indicators over bars.

All indicators of a run share one shuffle by symbol and one sort by date.
Frame-shaped ones are window functions. Recursive ones (EMA family, RSI, ADX)
stream over the sorted partition in Arrow batches and carry only the smoothing
state from batch to batch, so memory does not grow with the series.

Values are null until an indicator has seen a full window; recursive ones pass over bars without prices. Date bounds are
applied after computing, so that the warm-up may use earlier bars.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.functions.scalars import ratio
from marketmill.operators.prices import bars_intraday

# The code below runs in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Names of the indicators.
FRAME_INDICATORS = ("sma", "wma", "standardDeviation", "williams")
RECURSIVE_INDICATORS = ("ema", "dema", "tema", "rsi", "adx")


#: Bars smoothed by one matrix product.
BLOCK = 128


def _kernel(alpha: float, kernels: dict) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the block's own values, and of the value before the block."""
    if alpha in kernels:
        return kernels[alpha]
    powers = (1.0 - alpha) ** np.arange(BLOCK + 1)
    lag = np.subtract.outer(np.arange(BLOCK), np.arange(BLOCK))
    kernels[alpha] = np.where(lag >= 0, alpha * powers[np.abs(lag)], 0.0), powers[1:]
    return kernels[alpha]


class _Smoother:
    """y = y' + alpha (x - y'), seeded with the mean of the first n values."""

    def __init__(self, alpha: float, n: int, kernels: dict) -> None:
        self.n, self.kernel = n, _kernel(alpha, kernels)
        self.seen, self.acc, self.last = 0, 0.0, np.nan

    def feed(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), np.nan)
        start = int(np.argmax(~np.isnan(x))) if len(x) and np.isnan(x[0]) else 0
        if len(x) == 0 or np.isnan(x[start]):
            return out
        k = min(self.n - self.seen, len(x) - start)
        if k > 0:
            self.acc += float(x[start : start + k].sum())
            self.seen += k
            start += k
            if self.seen == self.n:
                self.last = self.acc / self.n
                out[start - 1] = self.last
        if self.seen == self.n:
            weights, decay = self.kernel
            for a in range(start, len(x), BLOCK):
                part = x[a : a + BLOCK]
                m = len(part)
                out[a : a + m] = weights[:m, :m] @ part + decay[:m] * self.last
                self.last = float(out[a + m - 1])
        return out


class _Ema:
    """EMA, DEMA or TEMA: the same smoother chained one, two or three times."""

    def __init__(self, n: int, depth: int, kernels: dict) -> None:
        self.stages = [_Smoother(2.0 / (n + 1), n, kernels) for _ in range(depth)]

    def feed(self, high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
        levels, x = [], close
        for stage in self.stages:
            x = stage.feed(x)
            levels.append(x)
        if len(levels) == 1:
            return levels[0]
        if len(levels) == 2:
            return 2 * levels[0] - levels[1]
        return 3 * levels[0] - 3 * levels[1] + levels[2]


class _Rsi:
    def __init__(self, n: int, kernels: dict) -> None:
        self.prev = np.nan
        self.gain, self.loss = (_Smoother(1.0 / n, n, kernels) for _ in range(2))

    def feed(self, high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
        delta = np.diff(close, prepend=self.prev)
        self.prev = close[-1]
        up = self.gain.feed(np.where(np.isnan(delta), np.nan, np.maximum(delta, 0.0)))
        down = self.loss.feed(np.where(np.isnan(delta), np.nan, np.maximum(-delta, 0.0)))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(down == 0, np.where(np.isnan(up), np.nan, 100.0), 100.0 - 100.0 / (1.0 + up / down))


class _Adx:
    def __init__(self, n: int, kernels: dict) -> None:
        self.high = self.low = self.close = np.nan
        self.tr, self.up, self.down, self.dx = (_Smoother(1.0 / n, n, kernels) for _ in range(4))

    def feed(self, high: np.ndarray, low: np.ndarray, close: np.ndarray) -> np.ndarray:
        up_move = np.diff(high, prepend=self.high)
        down_move = -np.diff(low, prepend=self.low)
        before = np.concatenate(([self.close], close[:-1]))
        self.high, self.low, self.close = high[-1], low[-1], close[-1]
        known = ~np.isnan(before)
        tr = np.where(known, np.maximum(high, before) - np.minimum(low, before), np.nan)
        plus = np.where(known, np.where((up_move > down_move) & (up_move > 0), up_move, 0.0), np.nan)
        minus = np.where(known, np.where((down_move > up_move) & (down_move > 0), down_move, 0.0), np.nan)
        tr, plus, minus = self.tr.feed(tr), self.up.feed(plus), self.down.feed(minus)
        total = plus + minus
        with np.errstate(divide="ignore", invalid="ignore"):
            dx = np.where(total == 0, 0.0, 100.0 * np.abs(plus - minus) / total)
        return self.dx.feed(np.where(np.isnan(tr), np.nan, dx))


def _engine(name: str, n: int, kernels: dict):
    if name in ("ema", "dema", "tema"):
        return _Ema(n, ("ema", "dema", "tema").index(name) + 1, kernels)
    return _Rsi(n, kernels) if name == "rsi" else _Adx(n, kernels)


def _stream(specs: Sequence[tuple[str, str, int]]):
    """Arrow batch function for partitions sorted by (symbol, date)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, engines, kernels = object(), [], {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            symbol = batch.column("symbol").to_numpy(zero_copy_only=False)
            high, low, close = (
                batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("high", "low", "close")
            )
            cuts = [0, *(np.flatnonzero(symbol[1:] != symbol[:-1]) + 1), len(symbol)]
            results = [np.empty(len(symbol)) for _ in specs]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if symbol[a] != current:
                    current, engines = symbol[a], [_engine(name, n, kernels) for _, name, n in specs]
                bar = np.stack((high[a:b], low[a:b], close[a:b]))
                priced, full = ~np.isnan(bar[2]), ~np.isnan(bar).any(axis=0)
                for out, engine, (_, name, _) in zip(results, engines, specs):
                    # a bar without the prices that are needed gives null and leaves the state as it is
                    known = np.flatnonzero(full if name == "adx" else priced)
                    out[a:b] = np.nan
                    if len(known):
                        out[a + known] = engine.feed(*bar[:, known])
            columns = [*batch.columns, *(pa.array(r, from_pandas=True) for r in results)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *(c for c, _, _ in specs)])

    return run


def _frame(name: str, n: int) -> Column:
    w = Window.partitionBy("symbol").orderBy("date").rowsBetween(1 - n, 0)
    close = F.col("close")
    if name == "sma":
        value = F.avg(close).over(w)
    elif name == "wma":
        # the frame holds n values, the oldest first
        weighted = F.zip_with(F.collect_list(close).over(w), F.sequence(F.lit(1), F.lit(n)), lambda x, k: x * k)
        value = F.aggregate(weighted, F.lit(0.0), lambda total, x: total + x) / (n * (n + 1) / 2)
    elif name == "standardDeviation":
        value = F.stddev_pop(close).over(w)
    else:
        top, bottom = F.max("high").over(w), F.min("low").over(w)
        value = ratio(top - close, top - bottom) * -100
    return F.when(F.count(close).over(w) == n, value)


def indicators(
    bars: DataFrame,
    specs: Sequence[tuple[str, str, int]],
    lo: str | None = None,
    hi: str | None = None,
    long_series: bool = False,
) -> DataFrame:
    """Bars with one column per (column name, indicator, period length).

    Each series streams through one task, which suits daily bars. With ``long_series`` recursive indicators scan
    ranges of bars in many tasks (:mod:`marketmill.operators.longseries`, which runs jobs and can continue stored states).
    """
    known = (*FRAME_INDICATORS, *RECURSIVE_INDICATORS)
    for _, name, n in specs:
        if name not in known:
            raise ValueError(f"unknown indicator {name!r}")
        if n < 1:
            raise ValueError("period length must be positive")
    frames = [s for s in specs if s[1] in FRAME_INDICATORS]
    recursive = [s for s in specs if s[1] in RECURSIVE_INDICATORS]
    if recursive and long_series:
        from marketmill.operators.longseries import recursive_indicators

        bars_and, recursive = recursive_indicators(bars, recursive)[0], []
    else:
        bars_and = bars
    out = bars_and
    if frames or recursive:
        out = bars_and.repartition("symbol").sortWithinPartitions("symbol", "date")
    if frames:
        out = out.withColumns({c: _frame(name, n) for c, name, n in frames})
    if recursive:
        schema = T.StructType([*out.schema.fields, *(T.StructField(c, T.DoubleType()) for c, _, _ in recursive)])
        out = out.mapInArrow(_stream(recursive), schema)
    if lo is not None:
        out = out.filter(F.to_date("date") >= F.lit(lo).cast("date"))
    if hi is not None:
        out = out.filter(F.to_date("date") <= F.lit(hi).cast("date"))
    return out.select(*bars.columns, *[c for c, _, _ in specs])


def _single(name: str):
    def indicator(bars: DataFrame, period_length: int, lo: str | None = None, hi: str | None = None) -> DataFrame:
        return indicators(bars, [(name, name, period_length)], lo, hi)

    indicator.__name__ = name
    return indicator


sma = _single("sma")
ema = _single("ema")
wma = _single("wma")
dema = _single("dema")
tema = _single("tema")
rsi = _single("rsi")
standard_deviation = _single("standardDeviation")
williams = _single("williams")
adx = _single("adx")


def intraday(
    ticks: DataFrame, timeframe: str, specs: Sequence[tuple[str, str, int]], lo: str | None = None, hi: str | None = None
) -> DataFrame:
    """Indicators over the bars of a timeframe, straight from ticks, whose series may be long; see :func:`indicators`."""
    return indicators(bars_intraday(ticks, timeframe), specs, lo, hi, long_series=True)


def indicator_grid(bars: DataFrame, specs: Sequence[tuple[str, int]]) -> DataFrame:
    """Many indicators of all symbols in long form, from one pass over the bars."""
    named = [(f"{name}_{n}", name, n) for name, n in specs]
    wide = indicators(bars.select("symbol", "date", "high", "low", "close"), named)
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("indicator"), F.lit(n).alias("periodLength"), F.col(c).alias("value"))
            for c, name, n in named
        ]
    )
    return wide.select("symbol", "date", F.inline(cells)).filter(F.col("value").isNotNull())

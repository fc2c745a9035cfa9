"""Whitening of vectors on exact integers: covariance, characteristic polynomial, roots, components.

1. Entries become whole numbers. Tasks sum their products exactly; the sums give the scatter matrix
   n * sum(x x') - S S', whose entries are whole numbers too.
2. Its characteristic polynomial is found modulo many primes, one Hessenberg reduction each, in Spark tasks;
   Chinese remainders give the true coefficients.
3. All roots are real. A shifted polynomial has as many changes of sign as roots beyond the shift, so that bisection
   isolates the largest roots; each is then refined by sign alone to 2^-64.
4. Components span the null space of the matrix less the root: inverse iteration with 60 digits, in Spark tasks.

On the driver are matrices and polynomials of the dimension only, never rows of the table.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.llm.common import pieces
from marketmill.session import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Roots are known to this many binary places; digits of the inverse iteration.
ROOT_BITS, DIGITS = 64, 60
#: Roots that agree to so many bits, relative to the largest, share one null space.
SAME_BITS = 56
#: Primes lie below this, so that products of two remainders fit 64 bits.
PRIME_TOP = 1 << 31
#: Bits of a limb where products of entries would not be exact in doubles.
LIMB = 18


# ---- vectors and exact sums


def whole(batch: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the vectors that take part, by length: (places, entries as doubles); nulls and non-finite ones do not."""
    lists = batch.cast(pa.list_(pa.float64()))
    size = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    flat = lists.values
    values = flat.to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(values)
    if flat.null_count:
        bad |= flat.is_null().to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(bad)))
    offsets = lists.offsets.to_numpy(zero_copy_only=False)
    good = (before[offsets[1:]] == before[offsets[:-1]]) & (size > 0)
    if lists.null_count:
        good &= ~lists.is_null().to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(size[good]):
        at = np.flatnonzero(good & (size == d))
        out.append((at, values[offsets[at][:, None] + np.arange(d)]))
    return out


def entries(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) as whole numbers, without the common shift; Python numbers where 64 bits do not hold them."""
    scaled = np.floor(SCALE * values)
    if len(scaled) and np.abs(scaled).max() >= 2.0**62:
        return np.array([[int(v) for v in row] for row in scaled], object)
    return scaled.astype(np.int64)


def gram(x: np.ndarray) -> np.ndarray:
    """x' x exactly, as Python numbers. Matrix products of doubles serve as long as every sum stays below 2^53."""
    most = int(abs(x).max()) if x.size else 0
    if x.dtype != object and most * most * len(x) < 1 << 53:
        y = x.astype(np.float64)
        return np.array([[int(v) for v in row] for row in y.T @ y], object)
    out, limbs, rest = np.zeros((x.shape[1],) * 2, object), [], np.array(x, object)
    for start in range(0, len(x), 1 << 12):
        limbs, rest = [], np.array(x[start : start + (1 << 12)], object)
        while rest.any() and not all(v in (0, -1) for v in rest.ravel()):
            limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
            rest = rest >> LIMB
        limbs.append(rest.astype(np.float64))  # 0 or -1: the sign
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                out += np.array([[int(v) for v in row] for row in a.T @ b], object) << LIMB * (i + j)
    return out


_SUMS = "d int, i int, j int, limb int, value decimal(38,0)"


def _limbs(value: int) -> Iterator[tuple[int, Decimal]]:
    """A whole number as signed parts to base 10^27, so that sums of 10^11 of them fit 38 digits."""
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        value, part = divmod(value, 10**27)
        if part:
            yield k, Decimal(sign * part)
        k += 1


def scatter(vectors: DataFrame) -> tuple[int, int, list[int], np.ndarray] | None:
    """(dimension, n, sums, scatter matrix n * sum(x x') - S S') of a table with one column of vectors, exactly.

    The dimension is that of most vectors (of the longer ones where two are as frequent). One job; what comes back
    are some dimension^2 sums. The common shift of the entries does not change the scatter and is left out of the sums.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, values in whole(batch.column(0)):
                x = entries(values)
                x = np.concatenate((np.ones((len(x), 1), x.dtype), x), axis=1)
                d = x.shape[1] - 1
                sums[d] = sums[d] + gram(x) if d in sums else gram(x)
        for d, m in sums.items():
            rows = [(d, i, j, k, v) for i in range(d + 1) for j in range(i, d + 1) for k, v in _limbs(int(m[i, j]))]
            types = [pa.int32()] * 4 + [pa.decimal128(38, 0)]
            for at in range(0, len(rows), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 65536]), types)], ["d", "i", "j", "limb", "value"])

    rows = vectors.mapInArrow(work, _SUMS).groupBy("d", "i", "j", "limb").agg(F.sum("value").alias("value"))
    rows = materialize(rows, "whitening-sums")
    # the number of vectors of each length comes first, so that only one length's sums are fetched
    n_of = rows.filter("i = 0 and j = 0").groupBy("d").agg(F.max(F.struct("limb", "value")).alias("n"))
    first = n_of.orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return None
    d = first["d"]
    m = np.zeros((d + 1, d + 1), object)
    for r in rows.filter(F.col("d") == d).collect():
        m[r.i, r.j] += int(r.value) * 10 ** (27 * r.limb)
    m += np.triu(m, 1).T
    n, s = m[0, 0], m[0, 1:]
    return d, int(n), [int(v) for v in s], n * m[1:, 1:] - np.outer(s, s)


# ---- characteristic polynomial


def primes_below(top: int, bound: int) -> list[int]:
    """Primes from ``top`` down whose product is beyond ``bound``."""

    def prime(v: int) -> bool:
        odd, twos = v - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough below 3.2e9
            x = pow(base, odd, v)
            if x in (1, v - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % v
                if x == v - 1:
                    break
            else:
                return False
        return True

    out, product, v = [], 1, top - 1
    while product <= bound:
        if prime(v):
            out.append(v)
            product *= v
        v -= 2
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo a prime, highest power first, by way of a Hessenberg form."""
    d = len(matrix)
    h = np.array(matrix % p, np.int64)
    for k in range(d - 2):
        rows = np.flatnonzero(h[k + 1 :, k])
        if not len(rows):
            continue
        i = k + 1 + int(rows[0])
        if i != k + 1:
            h[[i, k + 1]] = h[[k + 1, i]]
            h[:, [i, k + 1]] = h[:, [k + 1, i]]
        f = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - f[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * f % p).sum(axis=1)) % p
    # leading minors: polynomials by rising power
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = np.roll(polys[k], 1) - h[k, k] * polys[k] % p
        factor, weights = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            factor = factor * int(h[i + 1, i]) % p
            weights[i] = int(h[i, k]) * factor % p
        polys[k + 1] = (new - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients of det(t - matrix) of a symmetric matrix without negative roots, highest power first.

    The k-th is at most (1 + trace / d)^d, which says how many primes are needed.
    """
    d = len(matrix)
    primes = primes_below(PRIME_TOP, 2 * (2 + int(matrix.trace()) // d) ** d)
    shared = spark.sparkContext.broadcast([[int(v) for v in row] for row in matrix])  # d^2 numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.array(shared.value, object)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([primes[i]], pa.int64()), pa.array([polynomial_modulo(m, primes[i])], pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    total, product = [0] * (d + 1), 1
    for p, c in spark.range(0, len(primes), 1, tasks).mapInArrow(work, "p long, c array<bigint>").collect():
        inverse = pow(product, -1, p)
        total = [x + product * ((r - x) * inverse % p) for x, r in zip(total, c)]
        product *= p
    return [x - product if 2 * x > product else x for x in total]


# ---- real roots


def roots_beyond(poly: list[int], a: int) -> int:
    """How many roots, all being real, are greater than a: changes of sign after a shift by a."""
    c = list(poly)
    for i in range(1, len(c)):
        # one division by (t - a) after the other leaves the shifted coefficients
        for j in range(1, len(c) - i + 1):
            c[j] += a * c[j - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(poly: list[int], k: int, near: list[float]) -> list[int]:
    """The k largest roots, with multiplicity, as whole numbers of 2^-ROOT_BITS rounded up; all roots are >= 0.

    ``near`` says where to cut first; only exact counts decide.
    """
    scaled = [c << (ROOT_BITS * i) for i, c in enumerate(poly)]
    top = (max(1, -poly[1]) << ROOT_BITS) + 1
    guess = [int(Decimal(v) * (1 << ROOT_BITS)) for v in sorted(near, reverse=True)[: k + 1]]
    cuts = sorted({0, top} | {c for x, y in zip(guess, guess[1:]) if 0 < (c := (x + y) // 2) < top})
    beyond = [len(poly) - 1 if c < 0 else roots_beyond(scaled, c) for c in cuts]
    todo = [(lo, hi, a, b) for lo, hi, a, b in zip(cuts, cuts[1:], beyond, beyond[1:]) if a > b and b < k]
    out = []
    while todo:
        lo, hi, a, b = todo.pop()
        if hi - lo == 1:
            out += [hi] * (a - b)
        elif a - b == 1:
            while hi - lo > 1:
                mid, value = (lo + hi) // 2, 0
                for c in scaled:
                    value = value * mid + c
                # positive where the number of roots beyond is even
                lo, hi = (mid, hi) if value and (value > 0) != (b % 2 == 0) else (lo, mid)
            out.append(hi)
        else:
            mid = (lo + hi) // 2
            m = roots_beyond(scaled, mid)
            todo += [t for t in ((lo, mid, a, m), (mid, hi, m, b)) if t[2] > t[3] and t[3] < k]
    return sorted(out, reverse=True)[:k]


# ---- components


def null_space(matrix: np.ndarray, root: int, size: int) -> np.ndarray:
    """``size`` orthonormal vectors of the space that belongs to a root: inverse iteration with DIGITS digits."""
    d = len(matrix)
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emin=-(10**6), Emax=10**6)):
        unit = Decimal(int(matrix.trace()))
        shift = Decimal(root) / Decimal(1 << ROOT_BITS) / unit
        a = np.array([[Decimal(int(v)) / unit for v in row] for row in matrix], object)
        for i in range(d):
            a[i, i] -= shift
        # fixed start vectors, all of whose entries differ
        b = np.array([[Decimal(int(v)) for v in row] for row in np.random.default_rng(d).integers(1, 1 << 30, (d, size))], object)
        order, tiny = list(range(d)), Decimal(10) ** -DIGITS
        for k in range(d):
            i = k + max(range(d - k), key=lambda j: abs(a[k + j, k]))
            if i != k:
                a[[i, k]] = a[[k, i]]
                order[i], order[k] = order[k], order[i]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - a[k + 1 :, k, None] * a[k, k + 1 :]
        for _ in range(3):
            b = b[order]
            for k in range(d):
                b[k + 1 :] = b[k + 1 :] - a[k + 1 :, k, None] * b[k]
            for k in range(d - 1, -1, -1):
                b[k] = b[k] / a[k, k]
                b[:k] = b[:k] - a[:k, k, None] * b[k]
            for _ in range(2):
                for i in range(size):
                    for j in range(i):
                        b[:, i] = b[:, i] - (b[:, i] * b[:, j]).sum() * b[:, j]
                    b[:, i] = b[:, i] / (b[:, i] * b[:, i]).sum().sqrt()
        return np.array(b.T, np.float64)


@dataclass(frozen=True)
class Whitening:
    """A fit: dimension, vectors and sums of their entries, components by falling eigenvalue, exact shares of the trace."""

    dimension: int
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: list[float]
    explained: list[float]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all vectors of a table with one column. None where there are none or where they are all the same."""
    spark = vectors.sparkSession
    found = scatter(vectors)
    if found is None or found[3].trace() == 0:
        return None
    d, n, sums, matrix = found
    poly = characteristic_polynomial(spark, matrix)
    rank = max(i for i, c in enumerate(poly) if c)
    trace = int(matrix.trace())
    near = np.linalg.eigvalsh(np.array([[float(Fraction(int(v), trace)) for v in row] for row in matrix]))
    roots = largest_roots(poly, min(components, rank), [float(v) * float(trace) for v in near])
    # roots that cannot be told apart share a null space
    groups: list[list[int]] = []
    for r in roots:
        if groups and groups[-1][0] - r <= roots[0] >> SAME_BITS:
            groups[-1].append(r)
        else:
            groups.append([r])
    shared = spark.sparkContext.broadcast([[int(v) for v in row] for row in matrix])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.array(shared.value, object)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                space = null_space(m, groups[i][0], len(groups[i]))
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([space.ravel().tolist()], pa.list_(pa.float64()))], ["i", "v"])

    spaces = dict(spark.range(0, len(groups), 1, len(groups)).mapInArrow(work, "i long, v array<double>").collect())
    axes = np.concatenate([np.array(spaces[i]).reshape(-1, d) for i in range(len(groups))])
    unit = 1 << ROOT_BITS
    return Whitening(
        d, n, sums, axes,
        [float(Fraction(r, unit * n * n)) for r in roots], [float(Fraction(r, unit * trace)) for r in roots],
    )


def _projected(model: Whitening, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S exactly, and the whitened vectors."""
    x, sums = entries(values), np.array(model.sums, object)
    most = max(abs(int(x.max())), abs(int(x.min()))) * model.n + max(map(abs, model.sums))
    if x.dtype != object and most < 1 << 62:
        centred = x * model.n - sums.astype(np.int64)
    else:
        centred = np.array(x, object) * model.n - sums
    scale = np.sqrt(np.array(model.eigenvalues))
    return centred, (centred.astype(np.float64) / model.n) @ (model.components.T / scale)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity; sums of the tasks are added in Spark."""
    k = len(model.eigenvalues)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in pieces(batches, rows=4096):
            for _, values in whole(batch.column(0)):
                if values.shape[1] == model.dimension:
                    w = _projected(model, values)[1]
                    w = np.concatenate((np.ones((len(w), 1)), w), axis=1)
                    total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(c.ravel()) for c in (i.astype(np.int32), j.astype(np.int32), total)], ["i", "j", "value"])

    rows = vectors.mapInArrow(work, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    m = np.zeros((k + 1, k + 1))
    for i, j, value in rows.collect():
        m[i, j] = value
    mean = m[0, 1:] / model.n
    return float(np.abs(m[1:, 1:] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def transform(docs: DataFrame, model: Whitening, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(id, deviation, whitened) for every vector that takes part; ``deviation`` is the sum of (n * x - S)^2 (null beyond 38 digits), ``whitened`` an array."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(vec).alias("v"))
    out = T.StructType(
        [T.StructField(id_col, rows.schema["id"].dataType)] + list(T._parse_datatype_string("deviation decimal(38,0), whitened array<double>"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for batch in pieces(batches, rows=4096):
            for at, values in whole(batch.column(1)):
                if values.shape[1] != model.dimension:
                    continue
                centred, white = _projected(model, values)
                small = centred.dtype != object and int(abs(centred).max()) ** 2 * model.dimension < 1 << 63
                square = (centred * centred).sum(axis=1) if small else (np.array(centred, object) ** 2).sum(axis=1)
                n, k = white.shape
                lists = pa.ListArray.from_arrays(np.arange(0, n * k + 1, k, dtype=np.int32), white.ravel())
                ids = batch.column(0).take(pa.array(at))
                cols = [ids, pa.array([Decimal(int(v)) if v < 10**38 else None for v in square], pa.decimal128(38, 0)), lists]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target)], schema=target)

    return rows.mapInArrow(work, out)


def whiten(docs: DataFrame, id_col: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, that hold null or non-finite entries, or whose length is not that of most
    vectors take no part and give no rows. Rows with a null or repeated id are vectors of their own. Components are
    numbered from 1 by falling eigenvalue, ties in any orthonormal choice, the same for all rows; those with eigenvalue 0
    cannot be whitened and are left out, so that a table whose vectors are all the same, and an empty one, give no rows. Other input columns
    are not used, whatever their names. Runs jobs when called; rereads the table rather than keeping it.
    """
    spark = docs.sparkSession
    vectors = docs.select(vec)
    model = fit(vectors, components)
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        kind = docs.select(id_col).schema[0].dataType
        return spark.createDataFrame([], T.StructType([T.StructField(id_col, kind)] + list(T._parse_datatype_string(schema))))
    error = identity_error(vectors, model)
    shares = F.array(*[F.lit(v) for v in model.explained])
    rows = transform(docs, model, id_col, vec).select(id_col, "deviation", F.posexplode("whitened").alias("__i", "whitened"))
    return rows.select(
        id_col, (F.col("__i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("__i")).alias("explained"), F.lit(error).alias("identity_error"),
    )

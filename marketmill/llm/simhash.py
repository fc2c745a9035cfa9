"""SimHash near-duplicates: vantage-point trees over fingerprints, exact at a maximum bit distance.

Fingerprints are split into blocks of bits so that two that differ in at most r bits
differ in at most one bit of some block. Every block has a vantage-point
tree: a node sends what lies within its radius of the vantage point to the inner
branch and the rest to the outer one. By the triangle inequality a partner
within one bit can only lie in the other branch near the radius; such
fingerprints visit both. Leaves are the shards: they compare their own
fingerprints with each other and with the visitors, so no pair is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.functions.windows import first_per_key
from marketmill.llm.common import pieces
from marketmill.llm.components import connected_components
from marketmill.session import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints per leaf aimed at, deepest tree, sampled fingerprints per leaf for choosing its nodes. The
#: trees are at most 3 * 2 ** MAX_DEPTH nodes of 16 bytes (under 1 MB), the sample 2 MB.
LEAF, MAX_DEPTH, SAMPLE_PER_LEAF = 256, 14, 16
#: Rows of a leaf that one task compares with the leaf; larger leaves are shared out.
SLICE = 16384


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included; 0 without words."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(ws)
    if not n:
        return 0
    h = xxhash.xxh64_intdigest
    if n <= width:
        return h(b" ".join(ws), SEED)
    joined = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: n - width + 1].tolist()
    hashes = [h(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    ones, m = np.zeros(64, np.int64), len(hashes)
    for i in range(0, m, 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > m, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint_bits", width: int = SHINGLE) -> DataFrame:
    """Input rows and columns with the fingerprint as a (signed) long; null and empty texts have 0."""

    @F.arrow_udf("long")
    def bits(texts: pa.Array) -> pa.Array:
        out = np.empty(len(texts), np.uint64)
        # a few texts at a time are turned into Python strings
        for i in range(0, len(texts), 256):
            for k, t in enumerate(texts.slice(i, 256).to_pylist()):
                out[i + k] = fingerprint(t, width)
        return pa.array(out.view(np.int64))

    return docs.withColumn(out, bits(F.col(text)))


def blocks(max_bits: int) -> tuple[list[tuple[int, int]], int]:
    """(first bit, bits) of the blocks, and the bits that may differ in the best block."""
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])], max_bits // n


class Tree:
    """Vantage points and radii of one block, as a heap: the children of i are 2i (inner) and 2i + 1."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        self.depth, self.radius = depth, radius
        self.point = np.zeros(1 << depth, np.uint64)
        self.within = np.zeros(1 << depth, np.uint8)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            own = parts.pop(node)
            best = None
            for _ in range(6):
                if len(own) >= 2:
                    point = own[rng.integers(len(own))]
                else:
                    point = np.uint64(rng.integers(1 << bits))
                d = np.bitwise_count(own ^ point)
                r = int(np.sort(d)[(len(d) - 1) // 2]) if len(own) >= 2 else bits // 2
                # an outlier's own ball splits off nothing: balance counts with the overlap
                inner = np.count_nonzero(d <= r)
                cost = abs(2 * inner - len(d)) + 2 * np.count_nonzero((d > r - radius) & (d <= r + radius))
                if best is None or cost < best[0]:
                    best = (cost, point, r, d)
            _, self.point[node], self.within[node], d = best
            parts[2 * node], parts[2 * node + 1] = own[d <= best[2]], own[d > best[2]]

    def route(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, whether at home) of all leaves that each pattern belongs to or visits.

        Of two partners that a node separates only the outer one visits, so that
        one meeting is enough.
        """
        row = np.arange(len(block))
        node, home = np.ones(len(block), np.int64), np.ones(len(block), bool)
        for _ in range(self.depth):
            d = np.bitwise_count(block[row] ^ self.point[node]).astype(np.int16)
            r = self.within[node].astype(np.int16)
            inner = np.where(home, d <= r, d - self.radius <= r)
            outer = np.where(home, d > r, d + self.radius > r)
            visit = home & (d > r) & (d - self.radius <= r)
            row = np.concatenate((row[inner], row[outer], row[visit]))
            home = np.concatenate((home[inner], home[outer], np.zeros(np.count_nonzero(visit), bool)))
            node = np.concatenate((2 * node[inner], 2 * node[outer] + 1, 2 * node[visit]))
        return row, node, home


def _pattern(fps: np.ndarray, first: int, bits: int) -> np.ndarray:
    return (fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)


def _stars(probe: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked between two arrays, as stars: fewer than there are fingerprints."""
    points = np.unique(np.concatenate((probe, home)))
    at = np.searchsorted(points, home)
    label = np.arange(len(points))
    step = max(1, (1 << 22) // max(1, len(home)))
    for i in range(0, len(probe), step):
        near = np.bitwise_count(probe[i : i + step, None] ^ home[None, :]) <= max_bits
        a, b = np.nonzero(near)
        if not len(a):
            continue
        a, b = np.searchsorted(points, probe[i + a]), at[b]
        keep = a != b
        a, b = a[keep], b[keep]
        while len(a):
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while not np.array_equal(label, label[label]):
                label = label[label]
            keep = label[a] != label[b]
            a, b = a[keep], b[keep]
    linked = np.flatnonzero(label != np.arange(len(points)))
    return points[linked], points[label[linked]]


def link(fps: DataFrame, col: str = "fp", max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (longs) that connect all pairs at ``max_bits`` or fewer.

    A shard gives a spanning forest of its links instead of every pair, which leaves
    the components as they are. Runs jobs when called: the number of fingerprints and a
    bounded sample, taken by hash, come to the driver to plan the trees.
    """
    spark = fps.sparkSession
    n = fps.count()
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, n) / LEAF))))
    parts, radius = blocks(max_bits)
    sample = fps.select(col).orderBy(F.xxhash64(col)).limit(SAMPLE_PER_LEAF << depth)
    sample = np.array([r[0] for r in sample.collect()], dtype=np.int64).view(np.uint64)
    trees = [Tree(_pattern(sample, a, w), depth, radius, w, k) for k, (a, w) in enumerate(parts)]
    shared = spark.sparkContext.broadcast(trees)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, rows=4096):
            own = np.asarray(batch.column(0)).view(np.uint64)
            for k, (tree, (first, width)) in enumerate(zip(shared.value, parts)):
                row, leaf, home = tree.route(_pattern(own, first, width))
                shard = pa.array(leaf * len(parts) + k)
                yield pa.RecordBatch.from_arrays(
                    [shard, pa.array(home), pa.array(own[row].view(np.int64))], ["shard", "home", "fp"]
                )

    routed = materialize(fps.select(col).mapInArrow(route, "shard long, home boolean, fp long"), "vp-routed")
    sizes = routed.groupBy("shard").agg(F.count("*").alias("n"))
    large = materialize(
        sizes.filter(F.col("n") > SLICE).select("shard", F.ceil(F.col("n") / SLICE).cast("int").alias("slices")),
        "vp-large",
    )
    rows = routed.join(large, "shard", "left")
    rows = rows.withColumn("n", F.coalesce("slices", F.lit(1)))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    # a large shard is a grid of slices: a row probes along its line, and the shard's own rows are met along their column; own
    # rows meet each other on one side of the diagonal only, so that no task holds more than two slices
    n, mine = F.col("n"), F.col("mine")
    cell = lambda i, j, probe, home: F.struct(
        (i.cast("long") * n + j).alias("slice"), probe.alias("probe"), home.alias("home")
    )
    along = F.transform(F.sequence(mine, n - 1), lambda j: cell(mine, j, F.lit(True), j == mine))
    down = F.when(mine > 0, F.transform(F.sequence(F.lit(0), mine - 1), lambda i: cell(i, mine, F.lit(False), F.lit(True))))
    # a visitor does the same, but for its own slice, where it need not be met: in the slices before its own it is met by their rows
    visit = F.transform(F.sequence(mine, n - 1), lambda j: cell(mine, j, F.lit(True), F.lit(False)))
    none = F.array().cast("array<struct<slice:bigint,probe:boolean,home:boolean>>")
    cells = F.concat(F.when(F.col("home"), along).otherwise(visit), F.coalesce(down, none))
    rows = rows.select("shard", "fp", F.inline(cells)).select("shard", "slice", "fp", "home", "probe")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(count, "shard", "slice").sortWithinPartitions("shard", "slice")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None

        def edges() -> Iterator[pa.RecordBatch]:
            fp, home, probe = (np.concatenate(x) for x in zip(*held))
            a, b = _stars(fp[probe], fp[home], max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            shard, piece = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            fp = np.asarray(batch.column(2)).view(np.uint64)
            home, probe = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(piece) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
                if a == b:
                    continue
                if key is not None and key != (shard[a], piece[a]):
                    yield from edges()
                    held = []
                key = (shard[a], piece[a])
                held.append((fp[a:b], home[a:b], probe[a:b]))
        if held:
            yield from edges()

    return rows.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE,
    max_bits: int = MAX_BITS,
    with_text: bool = True,
) -> DataFrame:
    """Input rows with fingerprint_bits (long), component (smallest fingerprint of its component) and component_id.

    ``component_id`` is the smallest id among all rows of the component (null if none has one). Rows
    with equal fingerprints belong together, texts without words too (fingerprint 0). Repeated
    rows are kept; input columns of those names are replaced. The rows with their fingerprints
    are written to the shared folder when called (without the text, unless it is wanted),
    so that texts are hashed once; then the links are.
    """
    rows = fingerprints(docs.drop("component", "component_id"), text, width=width)
    rows = materialize(rows if with_text else rows.drop(text), "fingerprints")
    reps = rows.groupBy(F.col("fingerprint_bits").alias("fp")).agg(F.min(id_col).alias("id"))
    reps = materialize(reps, "fingerprint-ids")
    roots = connected_components(link(reps, "fp", max_bits))
    joined = reps.join(roots, reps["fp"] == roots["node"], "left")
    joined = materialize(joined.select("fp", "id", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    least = joined.groupBy(F.col("root").alias("r")).agg(F.min("id").alias("least"))
    classes = joined.join(least, F.col("root") == F.col("r")).select(
        F.col("fp").alias("__fp"), F.col("root").alias("component"), F.col("least").alias("component_id")
    )
    return rows.join(classes, rows["fingerprint_bits"] == F.col("__fp")).drop("__fp")


def first_of_each(marked: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component: the smallest id (null last), then the smallest text digest."""
    return first_per_key(marked, ["component"], [F.asc_nulls_last(id_col), F.md5(F.coalesce(F.col(text), F.lit("")))])

"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search in it.

Equal vectors are one node. Inner products are made distances by a further component that
gives all nodes one length. A first graph comes from random half-space buckets; then every node
introduces its neighbours, in both directions, to each other: neighbours of neighbours
meet, and each keeps its nearest. Queries start at their own node or nearest sampled nodes and expand the best
candidates along the graph, in rounds of joins.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.session import materialize

#: Neighbours of a node in the graph; rounds of introductions at most, which end before when the sum of
#: similarities grows by less than this share.
DEGREE, ROUNDS, GAIN = 32, 10, 0.004
#: Bucketings of the first graph, nodes per bucket aimed at, nodes compared at once.
TABLES, BUCKET, AT_ONCE = 8, 256, 1024
#: Nodes sampled (by hash) for the cuts of the buckets; the only vectors that come to the driver.
SAMPLE = 2048
#: Candidates a query keeps, those it expands in a round, and rounds.
POOL, EXPAND, STEPS = 200, 40, 6


def usable(vec: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    wide = F.transform(vec, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & fine & F.exists(wide, lambda x: x != 0), F.lit(False))


def inner(a: Column, b: Column) -> Column:
    """Inner product in double precision; the shorter vector counts as padded with zeros."""
    products = F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0)))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy().reshape(len(col), -1)


def _grouped(batches: Iterator[pa.RecordBatch], work: Callable, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """Apply ``work`` to the rows of each value of the first column of sorted batches, ``limit`` rows at most at once."""
    held: list[pa.RecordBatch] = []

    def emit() -> Iterator[pa.RecordBatch]:
        part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        step = limit or part.num_rows
        for i in range(0, part.num_rows, step):
            yield from work(part.slice(i, step))

    for batch in batches:
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != keys[a]:
                yield from emit()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield from emit()


def _edges(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s.astype(np.float32))], ["u", "v", "s"])


EDGES = "u long, v long, s float"


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """(u, near): the k best (s, v) of every node, best first; ties to the smaller node."""
    best = edges.groupBy("u", "v").agg(F.max("s").alias("s"))
    order = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    best = best.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k)
    return best.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("__r", "v", "s"))).alias("near"))


def _first_graph(nodes: DataFrame, n: int, dim: int) -> DataFrame:
    bits = max(0, math.ceil(math.log2(max(1, n) / BUCKET)))
    rng = np.random.default_rng(11)
    planes = rng.standard_normal((TABLES, dim, bits)).astype(np.float32)
    sample = np.array([r[0] for r in nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").collect()], np.float32)
    cuts = np.median(sample @ planes, axis=1) if len(sample) else np.zeros((TABLES, bits), np.float32)
    shared = nodes.sparkSession.sparkContext.broadcast((planes, cuts))
    weights = 1 << np.arange(bits, dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, cuts = shared.value
        for batch in batches:
            x = _matrix(batch.column(1))
            for t in range(TABLES):
                bucket = ((x @ planes[t] > cuts[t]) @ weights).astype(np.int64) * TABLES + t
                yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column(0), batch.column(1)], ["bucket", "node", "vec"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, x = part.column(1).to_numpy(), _matrix(part.column(2))
            if len(ids) < 2:
                return
            s = x @ x.T
            np.fill_diagonal(s, -np.inf)
            k = min(DEGREE // 2, len(ids) - 1)
            best = np.argpartition(-s, k - 1, axis=1)[:, :k]
            yield _edges(np.repeat(ids, k), ids[best].ravel(), np.take_along_axis(s, best, 1).ravel())

        yield from _grouped(batches, work, AT_ONCE)

    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.mapInArrow(place, "bucket long, node long, vec array<float>").repartition(count, "bucket")
    return placed.sortWithinPartitions("bucket", "node").mapInArrow(compare, EDGES)


def _introduce(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges among the neighbours, in either direction, of every node, where they beat what a node has."""
    ahead = graph.select("u", F.inline("near")).select("u", "v", "s")
    # nodes that very many point to are met by the nearest of those
    order = Window.partitionBy("v").orderBy(F.desc("s"), "u")
    back = ahead.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= DEGREE)
    around = ahead.select(F.col("u").alias("w"), F.col("v").alias("node")).union(back.select(F.col("v").alias("w"), F.col("u").alias("node")))
    worst = graph.select(F.col("u").alias("__u"), F.when(F.size("near") >= DEGREE, F.element_at("near", -1)["s"]).otherwise(F.lit(-1e30)).cast("float").alias("least"))
    known = nodes.join(worst, nodes["node"] == worst["__u"]).drop("__u")
    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = around.distinct().join(known, "node").select("w", "node", "least", "vec")
    rows = rows.repartition(count, "w").sortWithinPartitions("w", "node")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, least, x = part.column(1).to_numpy(), part.column(2).to_numpy(), _matrix(part.column(3))
            s = x @ x.T
            np.fill_diagonal(s, -np.inf)
            a, b = np.nonzero(s > least[:, None])
            if len(a):
                yield _edges(ids[a], ids[b], s[a, b])

        yield from _grouped(batches, work)

    return rows.mapInArrow(meet, EDGES)


def build_graph(nodes: DataFrame, n: int, dim: int) -> DataFrame:
    """(u, near) for all nodes (node, vec): DEGREE neighbours each, introduced to each other until little changes."""
    graph = materialize(_nearest(_first_graph(nodes, n, dim), DEGREE), "knn-graph")
    before = None
    for _ in range(ROUNDS):
        total = graph.select(F.inline("near")).agg(F.sum(F.col("s").cast("double"))).first()[0] or 0.0
        if before is not None and total - before <= GAIN * abs(total):
            break
        before = total
        old = graph.select("u", F.inline("near")).select("u", "v", "s")
        graph = materialize(_nearest(old.union(_introduce(graph, nodes)), DEGREE), "knn-graph")
    return graph


def _search(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """(q, c, s) candidates of the queries (q, node, qvec): greedy search from the query's own node."""
    pool = queries.join(graph, F.col("node") == F.col("u")).select("q", F.inline("near")).select("q", F.col("v").alias("c"), "s")
    own = queries.select("q", F.col("node").alias("c"), F.lit(3e38).cast("float").alias("s"))
    pool = materialize(pool.union(own).withColumn("done", F.col("s") > 1e38), "ann-pool")
    links = graph.select("u", F.inline("near")).select("u", "v")
    both = links.union(links.select("v", "u")).distinct()
    for _ in range(STEPS):
        order = Window.partitionBy("q").orderBy(F.desc("s"), "c")
        todo = pool.filter("not done").withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= EXPAND)
        todo = todo.select("q", "c")
        reached = todo.join(both, F.col("c") == F.col("u")).select("q", F.col("v").alias("c")).distinct()
        reached = reached.join(pool.select("q", "c"), ["q", "c"], "left_anti")
        scored = reached.join(nodes.select(F.col("node").alias("c"), "vec"), "c").join(queries.select("q", "qvec"), "q")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                s = np.einsum("ij,ij->i", _matrix(batch.column(2)), _matrix(batch.column(3)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s.astype(np.float32))], ["q", "c", "s"])

        new = scored.select("q", "c", "vec", "qvec").mapInArrow(score, "q long, c long, s float")
        old = pool.join(todo.withColumn("__t", F.lit(True)), ["q", "c"], "left")
        old = old.select("q", "c", "s", (F.col("done") | F.coalesce("__t", F.lit(False))).alias("done"))
        pool = old.union(new.withColumn("done", F.lit(False)))
        pool = pool.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= POOL).drop("__r")
        pool = materialize(pool, "ann-pool")
    return pool.select("q", "c")


def search(vectors: DataFrame, is_query: Callable[[Column], Column], id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20) -> DataFrame:
    """The k nearest other rows found for each row that ``is_query`` (of the id) selects.

    Columns query_id, rank (from 1), vec_id, score: the inner product of the vectors as they are, in
    double precision; ties to the smaller id. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without an id; of rows with one id the first by vector counts. Shorter vectors count as
    padded with zeros. Queries get all other rows if there are at most k. Writes nodes, graphs and pools to the shared folder when called.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    rows = materialize(rows, "ann-rows")
    classes = rows.groupBy("v").agg(F.min("id").alias("node"))
    norm = F.sqrt(inner(F.col("v"), F.col("v")))
    classes = materialize(classes.withColumn("norm", norm), "ann-classes")
    n, dim, top = classes.agg(F.count("*"), F.max(F.size("v")), F.max("norm")).first()
    dim, top = dim or 1, top or 1.0
    # all on one sphere: what is missing to the longest goes to one more component
    more = F.sqrt(F.greatest(F.lit(0.0), 1.0 - F.pow(F.col("norm") / top, 2)))
    scaled = F.transform("v", lambda x: (x.cast("double") / top).cast("float"))
    pad = F.array_repeat(F.lit(0.0).cast("float"), F.lit(dim) - F.size("v"))
    nodes = classes.select("node", F.concat(scaled, pad, F.array(more.cast("float"))).alias("vec"))
    nodes = materialize(nodes, "ann-nodes")
    graph = build_graph(nodes, n, dim + 1)
    member = rows.join(classes.select(F.col("v").alias("__v"), "node"), F.col("v") == F.col("__v")).select("id", "node", "v")
    member = materialize(member, "ann-members")
    queries = member.filter(is_query(F.col("id")))
    # equal queries search once; the last component is no part of a query
    asked = queries.select("node").distinct().join(nodes, "node")
    plain = F.concat(F.slice("vec", 1, dim), F.array(F.lit(0.0).cast("float")))
    asked = materialize(asked.select(F.col("node").alias("q"), "node", plain.alias("qvec")), "ann-queries")
    found = _search(asked, graph, nodes)
    # of equal vectors only the k + 1 smallest ids can be among a query's k nearest
    least = Window.partitionBy("node").orderBy("id")
    few = member.withColumn("__r", F.row_number().over(least)).filter(F.col("__r") <= k + 1).drop("__r")
    pairs = found.join(classes.select(F.col("node").alias("c"), F.col("v").alias("cv")), "c")
    pairs = pairs.join(classes.select(F.col("node").alias("q"), F.col("v").alias("qv")), "q")
    pairs = pairs.select("q", "c", inner(F.col("qv"), F.col("cv")).alias("score"))
    # nodes in order, with as many members as can matter
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    ranked = pairs.join(few.select(F.col("node").alias("c"), "id"), "c")
    ranked = ranked.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= k + 1).select("q", "id", "score")
    out = queries.select(F.col("id").alias("query_id"), F.col("node").alias("q")).join(ranked, "q").filter("query_id <> id")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    out = out.withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")

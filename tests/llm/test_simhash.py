"""Fingerprints, links and components against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marketmill.llm import queries, simhash
from marketmill.llm.components import connected_components


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(points, bits=4):
    points = sorted(set(points))
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def groups(roots):
    out = {}
    for p, r in roots.items():
        out.setdefault(r, set()).add(p)
    return {frozenset(g) for g in out.values()}


def components(spark, points, bits=4):
    df = spark.createDataFrame([(signed(p),) for p in sorted(set(points))], "fp long").repartition(5)
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in connected_components(simhash.link(df, "fp", bits)).collect()}
    return groups({p: got.get(p, p) for p in set(points)})


@pytest.fixture
def small_trees(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 8)
    monkeypatch.setattr(simhash, "SLICE", 50)


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 5])
def test_components_are_exact(spark, small_trees, bits):
    rng = random.Random(bits)
    points = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(500):  # chains, near and just too far
        p = rng.choice(points)
        for b in rng.sample(range(64), rng.randrange(7)):
            p ^= 1 << b
        points.append(p)
    points += [0, (1 << 64) - 1, 1, 31]
    assert components(spark, points, bits) == groups(brute(points, bits))


def test_dense_group_in_one_shard(spark, small_trees):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    points = [base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)] + [rng.getrandbits(64) for _ in range(100)]
    assert components(spark, points) == groups(brute(points))


def test_routing_meets_every_pair():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 1 << 21, 3000, dtype=np.uint64)
    tree = simhash.Tree(points[:500], 6, 1, 21, 0)
    row, leaf, home = tree.route(points)
    assert Counter(row[home].tolist()) == Counter(range(3000))
    at = {}
    for r, f, h in zip(row.tolist(), leaf.tolist(), home.tolist()):
        at.setdefault(r, {})[f] = h
    for b in range(21):
        for i in range(200):
            other = np.uint64(points[i] ^ np.uint64(1 << b))
            r2, f2, h2 = tree.route(np.array([other], np.uint64))
            mine, its = at[i], dict(zip(f2.tolist(), h2.tolist()))
            assert any((mine[f] or its[f]) for f in mine.keys() & its.keys())
    assert len(row) < 3000 * 12


def test_fingerprints(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extra = [(-1, None), (-2, ""), (-3, " \n"), (-4, "One"), (-5, "a b C d"), (-6, "a b c d e"), (-7, "x y " * 70000), (-8, "É É\x1cq")]
    df = docs.union(spark.createDataFrame(extra, docs.schema))
    for r in simhash.fingerprints(df).collect():
        assert r.fingerprint_bits == signed(plain_fingerprint(r.text)), r.doc_id


def test_op10_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fp = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    root = brute(fp.values())
    least = {}
    for d, p in sorted(fp.items()):
        least.setdefault(root[p], d)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op10_simhash_groups"](spark, sf_dir).collect()}
    assert got == {d: (f"{p:016x}", least[root[p]]) for d, p in fp.items()}


def test_odd_tables(rows):
    schema = "doc_id long, text string, component int, FP string, root int"
    same = "one two three four five six"
    df = rows([(5, same, 1, "x", 1), (None, same, 1, "x", 1), (3, same, 1, "x", 1), (3, same, 1, "x", 1), (None, None, 1, "x", 1), (None, "", 1, "x", 1), (9, "other words", None, None, None)], schema)
    out = simhash.near_duplicates(df)
    got = sorted(((r.doc_id, r.text, r.component_id) for r in out.collect()), key=str)
    assert got == sorted([(5, same, 3), (None, same, 3), (3, same, 3), (3, same, 3), (None, None, None), (None, "", None), (9, "other words", 9)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in simhash.first_of_each(out).collect()), key=str)
    assert len(kept) == 3 and (3, same) in kept and (9, "other words") in kept
    assert simhash.near_duplicates(rows([], schema)).collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + star + [(7, 7), (5000, 4999)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}, 5000: 4999, 4999: 4999}
    assert connected_components(edges.filter("a < 0")).agg(F.count("*")).first()[0] == 0


def test_links_do_not_depend_on_the_size_of_a_shard(spark, monkeypatch):
    """A fingerprint that only visits a shard meets the rows of all its slices, also of those before its own."""
    rng = random.Random(21)
    points = []
    for _ in range(400):  # pairs that differ in four bits, alone
        p = rng.getrandbits(64)
        q = p
        for b in rng.sample(range(64), 4):
            q ^= 1 << b
        points += [p, q]
    monkeypatch.setattr(simhash, "LEAF", 64)
    want = groups(brute(points))
    for size in (1 << 14, 30, 5):
        monkeypatch.setattr(simhash, "SLICE", size)
        assert components(spark, points) == want, size

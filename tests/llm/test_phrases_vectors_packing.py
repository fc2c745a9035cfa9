"""Phrase mining, whitening and packing against plain versions, and odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketmill.llm import collocations, packing, queries, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- phrases


def plain_phrases(rows, min_count, depth, top, subsumed=100):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, depth + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    f = {k: v for k, v in counts.items() if v >= min_count}
    out = defaultdict(list)
    for (lang, words), a in f.items():
        def around(other):
            k = len(words)
            return len(other) > k and any(other[i : i + k] == words for i in range(len(other) - k + 1))

        if len(words) < 2 or any(o == lang and around(w) and 100 * b >= subsumed * a for (o, w), b in f.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], n[lang]))
    return {
        (lang, i, p.decode(), -a, l, r, total, -score)
        for lang, found in out.items()
        for i, (score, a, p, l, r, total) in enumerate(sorted(found)[:top], 1)
    }


def phrase_docs(spark, seed=3, n=120):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [f"w{v}" for v in rng.zipf(1.4, rng.integers(0, 60)) % 25]
        for _ in range(rng.integers(0, 3)):
            words[len(words) // 2 : len(words) // 2] = ["New", "york", "City  hall"]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".\n", " é "], p=[0.7, 0.1, 0.05, 0.07, 0.05, 0.03]) for w in words)
        rows.append((i, text, ["en", "de", None][i % 3]))
    rows += [(None, "new york city hall " * 40, "en")] * 3 + [(1, None, "en"), (2, "", None), (3, " .,; \n", "fr"), (4, "w1 " * 3000, "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), [(r[2], r[1]) for r in rows]


@pytest.mark.parametrize(("min_count", "depth", "parts", "subsumed"), [(4, 5, 1, 100), (4, 5, 7, 100), (2, 3, 4, 60), (9, 7, 3, 100), (3, 2, 2, 100)])
def test_phrases_equal_a_plain_count(spark, min_count, depth, parts, subsumed):
    docs, rows = phrase_docs(spark)
    got = collocations.collocations(docs.repartition(parts), min_count=min_count, depth=depth, top=30, subsumed=subsumed)
    assert {tuple(r) for r in got.collect()} == plain_phrases(rows, min_count, depth, 30, subsumed)


def test_phrases_of_odd_tables(spark):
    docs, rows = phrase_docs(spark, n=30)
    from pyspark.sql import functions as F

    clash = docs.select("doc_id", "text", "lang", *[F.lit(1).alias(c) for c in ("id", "words", "n", "shard", "rank", "f")])
    got = collocations.collocations(clash, min_count=3, top=None)
    assert {tuple(r) for r in got.collect()} == plain_phrases(rows, 3, 5, 10**9)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs.filter("doc_id in (1, 2, 3)"), min_count=10**6).collect() == []


def test_scores_beyond_64_bits(spark):
    """The exact quotient of products that 64 bits do not hold."""
    row = spark.sql(
        "SELECT cast(1000 as decimal(4,0)) * cast(99999999999999999 as decimal(18,0)) * cast(999999999999999 as decimal(15,0))"
        " div (cast(99999999999999999 as decimal(18,0)) * cast(3000000000 as decimal(18,0))) AS s"
    ).first()
    assert row.s == 1000 * 99999999999999999 * 999999999999999 // (99999999999999999 * 3000000000)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(2, 6))
def test_index_counts_every_phrase(symbols, depth):
    seq = np.array([0, *symbols, 0], np.int32)
    forward, backward, first, second, n, low, r_low = collocations.pairs(seq, 4, depth)
    want = [Counter() for _ in range(depth + 1)]
    for k in range(2, depth + 1):
        for i in range(len(seq) - k + 1):
            part = tuple(seq[i : i + k].tolist())
            if all(part):
                want[k][part] += 1
    words = np.stack((first, second), axis=1)
    assert dict(zip(map(tuple, words.tolist()), n.tolist())) == want[2]
    found = list(collocations.longer(forward, backward, words, low, r_low, n, depth))
    for k, (phrases, counts) in enumerate(found, 3):
        assert dict(zip(map(tuple, phrases.tolist()), counts.tolist())) == want[k]


# ---- whitening


def plain_whitening(values, k=32):
    x = np.floor(64 * np.asarray(values, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    w, u = np.linalg.eigh(centred.T @ centred / n)
    w, u = w[::-1][:k], u[:, ::-1][:, :k]
    return (centred @ u) / np.sqrt(w), w / np.trace(centred.T @ centred / n), ((n * x - s) ** 2).sum(axis=1)


def test_whitening_equals_floating_point(spark):
    rng = np.random.default_rng(5)
    values = (rng.normal(size=(300, 12)) * np.linspace(0.2, 3, 12)) @ rng.normal(size=(12, 12))
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    got = whitening.whiten(docs.repartition(5), components=8).orderBy("vec_id", "component").toPandas()
    white, share, deviation = plain_whitening(values, 8)
    mine = got.whitened.to_numpy().reshape(300, 8)
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * sign).max() < 1e-8 and set(got.n) == {300} and got.identity_error.max() < 1e-12
    assert np.allclose(got.explained.to_numpy()[:8], share, rtol=1e-12)
    assert [int(v) for v in got.deviation[::8]] == deviation.tolist()


def test_repeated_and_zero_roots(spark):
    # two pairs of equal roots, and a constant dimension
    values = [[a, b, c, d, 1.0] for a in (-1, 1) for b in (-1, 1) for c in (-2, 2) for d in (-2, 2)]
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    got = whitening.whiten(docs).toPandas()
    assert sorted(set(got.component)) == [1, 2, 3, 4] and got.identity_error.max() < 1e-12
    assert np.allclose(sorted(set(got.explained)), [0.1, 0.4])


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(-9, 9, (7, 7))
    m = np.array((a @ a.T).tolist(), object)
    poly = whitening.characteristic_polynomial(spark, m)
    assert np.allclose([float(c) for c in poly], np.poly(np.array(m, float)), rtol=1e-9)
    roots = whitening.largest_roots(poly, 7, [])
    assert np.allclose([r / 2**64 for r in roots], np.linalg.eigvalsh(np.array(m, float))[::-1])
    assert roots == whitening.largest_roots(poly, 7, np.linalg.eigvalsh(np.array(m, float)).tolist())
    # (t - 3)^2 (t - 1) t
    poly = [1, -7, 15, -9, 0]
    assert whitening.largest_roots(poly, 3, [3.0, 1.0, 0.0]) == [3 << 64, 3 << 64, 1 << 64]
    assert whitening.polynomial_modulo(np.array([[2, 1, 0, 0], [1, 2, 0, 0], [0, 0, 3, 0], [0, 0, 0, 0]], object), 101) == [c % 101 for c in poly]


def test_exact_products():
    rng = np.random.default_rng(2)
    for top in (100, 2**40, 2**61):
        x = rng.integers(-top, top, (50, 4))
        big = np.array(x.tolist(), object)
        assert (whitening.gram(x) == big.T @ big).all()
    huge = np.array([[10**30, -(10**25)], [3, -4]], object)
    assert (whitening.gram(huge) == huge.T @ huge).all()


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(7)
    good = [(i, v.tolist(), 1, "a") for i, v in enumerate(rng.normal(size=(40, 3)))]
    odd = [(50, None, 1, "a"), (51, [], 1, "a"), (52, [1.0, None, 2.0], 1, "a"), (53, [1.0, float("nan"), 2.0], 1, "a"),
           (54, [1.0, float("inf"), 2.0], 1, "a"), (55, [1.0, 2.0], None, None), (None, [0.5, 0.25, 0.125], 1, "a"), (0, [9.0, 9.0, 9.0], 1, "a")]
    schema = "vec_id long, embedding array<double>, n int, component string"
    got = whitening.whiten(spark.createDataFrame(good + odd, schema)).toPandas()
    assert len(got) == 42 * 3 and set(got.n) == {42} and got.vec_id.isna().sum() == 3 and (got.vec_id == 0).sum() == 6
    empty = whitening.whiten(spark.createDataFrame([], schema))
    assert empty.collect() == [] and empty.columns == list(got.columns)
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1, "a") for i in range(3)], schema)).collect() == []
    huge = spark.createDataFrame([(0, [1e30, 1.0], 1, "a"), (1, [-1e30, 2.0], 1, "a"), (2, [0.0, -7.0], 1, "a")], schema)
    assert whitening.whiten(huge).toPandas().identity_error.max() < 1e-9


# ---- packing


def check_packing(rows, texts, length, end=1):
    tok = Tokenizer.from_file(queries.WORD_TOKENIZER)
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for found in by_seq.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == length or (at < length and at.bit_count() == 1)
    for doc, text in texts.items():
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            part = ids[at : at + r.length].tobytes()
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part) and bytes(r.ids) == part
            at += r.length
        assert at == len(ids)


def test_packing_keeps_every_id(spark):
    rng = np.random.default_rng(9)
    texts = {i: " ".join(rng.choice(["the", "Hello,", "don't", "née x", "a.b", "42%", "Ǆ"], rng.integers(0, 400))) for i in range(200)}
    texts |= {1000: None, 1001: "", 1002: " \n\t ", 1003: "long text. " * 3000, 1004: "x\x1cy \x1d z\x85w v é ́", 1005: "<|endoftext|> a<|startoftext|>b"}
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in texts.items()], "doc_id long, text string, id int, start int, ids int")
    for parts, length in ((1, 64), (5, 256), (3, 2048)):
        rows = packing.pack(docs.repartition(parts), queries.WORD_TOKENIZER, length=length).collect()
        check_packing(rows, texts, length)
    assert packing.pack(docs.limit(0), queries.WORD_TOKENIZER).collect() == []
    again = spark.createDataFrame([(None, "same"), (7, "same"), (7, "same")], "doc_id long, text string")
    assert packing.pack(again.coalesce(1), queries.WORD_TOKENIZER).count() == 3


def test_pieces_encode_like_whole_texts():
    enc = packing.WordEncoder(queries.WORD_TOKENIZER, "<u2")
    tok = Tokenizer.from_file(queries.WORD_TOKENIZER)
    texts = [
        "Hello, world. It's 3.5 (a).\" b_. c", "İstanbul ΣΟΦΟΣ ﬁne e\u0301, x\u0301. ǆ", "a., b.. c,,d . , e", "日本語、 テキスト。 ok.", "don't, we'LL. 'tis",
        "x" * 5000 + ", y", "tab\tand\x85next\u2003wide\xa0no", "1st 2nd, ½ ² Ⅷ.", "<|endoftext|>, <|startoftext|>.x", "", " ", "\x1c, \x1f.",
    ]
    for got, text in zip(enc.encode(texts), texts):
        assert np.frombuffer(got, "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" .,'’_-sStTİΣßǅﬁ\u0301\u0307\t\n\x1c\x85\xa0\u200b1½²"), st.characters(codec="utf-8")), max_size=40))
def test_any_text_encodes_like_the_library(text):
    enc = packing.word_encoder(queries.WORD_TOKENIZER, "<u2")
    assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_open_windows_are_bounded(spark, monkeypatch):
    texts = {i: "the " * 39 for i in range(500)}  # 40 ids each: no two fit into 64
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").coalesce(1)
    check_packing(packing.pack(docs, queries.WORD_TOKENIZER, length=64).collect(), texts, 64)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_levels_take_the_least_sum_of_squares(sizes):
    levels, fills, closed = packing.Levels(32), [], 0

    def total(f):
        return sum(n * n for n in Counter(f).values())

    for i, size in enumerate(sizes):
        options = [f for f in {0, *fills} if f + size <= 32]

        def after(f):
            rest = list(fills)
            if f:
                rest.remove(f)
            return rest + ([f + size] if f + size < 32 else [])

        best = min(total(after(f)) for f in options)
        full = levels.place((i, 0, b"xx" * size), size)
        closed += full is not None
        fills = [level for level, ws in enumerate(levels.open) for _ in ws]
        assert total(fills) == best and levels.n_open == len(fills)
    rest = packing.poured(levels.drain(), 32)
    assert sum(len(p[2]) // 2 for w in rest for p in w) + 32 * closed == sum(sizes)
    assert all((n := sum(len(p[2]) // 2 for p in w)) == 32 or n.bit_count() == 1 for w in rest)

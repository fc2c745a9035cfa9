"""Every stage of the pipeline against a plain version of it, each on what the stage before kept."""

import hashlib

import duckdb
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from marketmill.llm import bpe, quality, queries, simhash


def plain_clean(text):
    def bad(line):
        words = regex.findall(r"[^\x20\x09-\x0D]+", line)
        marks = len(regex.findall(r"[#*$%&|<>]", line))
        nav, end = (regex.compile(regex.sub(r"\\x\{(\w+)\}", lambda m: "\\u%04x" % int(m[1], 16), p)) for p in (quality.NAVIGATION, quality.TERMINAL))
        if not words:
            return False
        if nav.search(line) or (marks >= 2 and 2 * marks >= len(words)):
            return True
        if len(words) >= 4 and not regex.search(r"\p{Ll}", line) and regex.search(r"\p{Lu}", line):
            return True
        if len(line) <= 200 and any(p in line.lower() for p in quality.BOILERPLATE):
            return True
        return len(line) <= 60 and len(words) < quality.FRAGMENT_WORDS and not end.search(line)

    return "\n".join(line for line in text.split("\n") if not bad(line))


def sql(statement, rows, schema):
    con = duckdb.connect()
    con.register("documents", pa.table({f.name: [r[f.name] for r in rows] for f in schema}))
    cur = con.execute(statement)
    names = [d[0] for d in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]


def after_quality(rows, schema):
    kept = {r["doc_id"] for r in sql(queries.QUALITY_SQL, rows, schema) if r["kept"]}
    out = []
    for r in rows:
        if r["doc_id"] in kept:
            clean = plain_clean(r["text"])
            out.append(r | {"text": clean, "n_chars": len(clean)})
    return out


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = regex.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + simhash.SHINGLE]) for i in range(max(1, len(words) - simhash.SHINGLE + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def after_copies(rows, schema):
    fps = [plain_fingerprint(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.MAX_BITS:
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]


def after_secrets(rows, schema):
    spans = {r["doc_id"]: r["spans"] for r in sql(queries.SECRET_SQL, rows, schema)}
    out = []
    for r in rows:
        text, merged = r["text"], []
        for s in filter(None, spans[r["doc_id"]].split(",")):
            _, a, z = s.split(":")
            if merged and int(a) <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], int(z))
            else:
                merged.append([int(a), int(z)])
        for a, z in reversed(merged):
            text = text[:a] + "[SECRET]" + text[z:]
        out.append(r | {"text": text, "n_chars": len(text)})
    return out


def after_mix(rows, schema):
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in sql(queries.MIX_SQL, rows, schema)}
    return [r for r in rows for _ in range(taken[r["doc_id"]][0] // taken[r["doc_id"]][1] if taken[r["doc_id"]][1] else 0)]


def test_stages_equal_their_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # texts of one word have no size, of which the mix takes any number
    schema = docs.schema
    rows = [r.asDict() for r in docs.collect()]
    plain = [after_quality, after_copies, after_secrets, after_mix]
    for (name, stage), by_hand in zip(corpus_pipeline.STAGES, plain):
        got = [r.asDict() for r in stage(spark, spark.createDataFrame([tuple(r.values()) for r in rows], schema), sf_dir).collect()]
        want = by_hand(rows, schema)
        order = lambda rs: sorted(tuple(map(str, r.values())) for r in rs)
        assert order(got) == order(want), name
        assert got, name
        rows = got
    enc = bpe.encoding(queries.RANKS, corpus_pipeline.public_tokenizers.PATTERN)
    done = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame([tuple(r.values()) for r in rows], schema), sf_dir)
    got = sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in done.collect())
    want = []
    for r in rows:
        ids = enc.encode_ordinary(r["text"])
        want.append((r["doc_id"], len(ids), np.asarray(ids, "<u4").tobytes(), hashlib.sha256(r["text"].encode()).hexdigest()))
    assert got == sorted(want)
    whole = corpus_pipeline.run(spark, sf_dir).select("doc_id", F.sha2("ids", 256).alias("h"))
    assert sorted((r.doc_id, r.h) for r in whole.collect()) == sorted((w[0], hashlib.sha256(w[2]).hexdigest()) for w in want)

"""Registered queries of the operators, thin digests over them, and their check SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm import ann, bpe, chat, collocations, licenses, mixing, packing, passages, quality, records, secrets, simhash, whitening
from marketmill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return deco


#: Vocabularies of the contracts.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op1_license_templates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("license_spans")


CHAT_SQL = r"""
WITH raw AS (
  SELECT conv_id, turn, role, text, regexp_replace(coalesce(text, ''), '<(\\*)\|im_', '<\1\\\\|im_', 'g') AS clean,
         translate(regexp_replace(coalesce(role, 'unknown'), '<(\\*)\|im_', '<\1\\\\|im_', 'g'), chr(10), ' ') AS name
  FROM conversations),
t AS (
  SELECT *, CAST(floor(turn / 256) AS BIGINT) AS block,
         row_number() OVER (PARTITION BY conv_id, floor(turn / 256)
                            ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM raw),
p AS (SELECT *, CAST(floor((n - 1) / 256) AS BIGINT) AS part FROM t),
o AS (SELECT conv_id, turn, text, clean FROM raw WHERE role = 'system'
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, text NULLS FIRST) = 1),
h AS (
  SELECT DISTINCT p.conv_id, p.block, p.part FROM p JOIN o ON p.conv_id IS NOT DISTINCT FROM o.conv_id
  WHERE p.role = 'system' AND p.turn IS NOT DISTINCT FROM o.turn AND p.text IS NOT DISTINCT FROM o.text),
s AS (SELECT DISTINCT conv_id AS c, coalesce(role, 'unknown') AS speaker FROM t WHERE coalesce(role, '') <> 'system'),
r AS (
  SELECT conv_id, block, part, n, role, clean, name, 1 AS counts FROM p
  UNION ALL
  SELECT DISTINCT p.conv_id, p.block, p.part, 0, 'system', o.clean, 'system', 0
  FROM p JOIN o ON p.conv_id IS NOT DISTINCT FROM o.conv_id
  WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.conv_id IS NOT DISTINCT FROM p.conv_id
                    AND h.block IS NOT DISTINCT FROM p.block AND h.part = p.part)),
b AS (
  SELECT conv_id, speaker, block, part, n, counts, counts = 1 AND coalesce(role, 'unknown') = speaker AS own,
         CASE WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN coalesce(role, 'unknown') = speaker THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || name || chr(10) END AS head,
         clean || '<|im_end|>' || chr(10) AS body
  FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.c),
e AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, block, part ORDER BY n) AS z FROM b)
SELECT conv_id, speaker, block, part, sum(counts)::BIGINT AS n_turns, string_agg(head || body, '' ORDER BY n) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN concat(CAST(z - length(body) AS BIGINT), ':', CAST(z AS BIGINT)) END, ',' ORDER BY n), '') AS masks
FROM e GROUP BY conv_id, speaker, block, part
"""


@query("op2_chat_perspectives", CHAT_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dialogues from every participant's side; masks as start:end, comma-joined."""
    out = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return out.withColumn("masks", F.array_join(spans, ","))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, '')) || ':7') AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM s),
r AS (SELECT *, cap::DOUBLE / w AS ratio FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level AS lv FROM l WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT lv FROM f) * w, cap::DOUBLE)) AS target FROM l),
c AS (
  SELECT d.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, size RANGE UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (
  SELECT c.*, e.e, CASE WHEN target = 0 THEN 0 ELSE (e.e * source_size + upto)::DOUBLE / target END AS v
  FROM c, (VALUES (0), (1), (2)) e(e)),
g AS (SELECT *, sum(size) OVER (ORDER BY v, k, e, size RANGE UNBOUNDED PRECEDING) AS total FROM x)
SELECT doc_id, size, source_size, target,
       size * (sum(CASE WHEN total <= (SELECT sum(size) FROM d) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM g GROUP BY doc_id, size, source_size, target, k
"""


@query("op3_fair_queue_mix", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_binary_records")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token ids of all documents as record files, and reads them back."""
    manifest = records.write_records(table(spark, sf_dir, "documents"), TOKENIZER)
    out = records.read_records(manifest, with_ids=False)
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def _round_trip(enc, ids):
    raw = ids.astype("<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(bpe.decode(enc, ids)).hexdigest()


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(
        table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN,
        digest=_round_trip, schema="n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
g AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
q AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
l AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS marks
  FROM (SELECT doc_id, unnest(lines) AS line FROM d)),
v AS (
  SELECT doc_id, line, n,
    CASE WHEN n = 0 THEN false
         WHEN regexp_matches(line, '{nav}') THEN true
         WHEN marks >= 2 AND 2 * marks >= n THEN true
         WHEN n >= 4 AND NOT regexp_matches(line, '\p{Ll}') AND regexp_matches(line, '\p{Lu}') THEN true
         WHEN length(line) <= 200 AND ({boiler}) THEN true
         WHEN length(line) <= 60 AND n < {fragment} AND NOT regexp_matches(line, '{terminal}') THEN true
         ELSE false END AS bad
  FROM l),
s AS (
  SELECT doc_id, coalesce(sum(n) FILTER (WHERE bad), 0)::BIGINT AS lost_words,
         (count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0))::BIGINT AS n_dup_lines
  FROM v GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, s.n_dup_lines,
         coalesce(q.n_repeat_words, 0)::BIGINT AS n_repeat_words, s.lost_words
  FROM d JOIN s USING (doc_id) LEFT JOIN q USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND lost_words <= {lost} * n_words AS kept FROM b
"""


def _sql_text(pattern: str) -> str:
    return pattern.replace("'", "''")


QUALITY_SQL = (
    QUALITY_SQL.replace("{nav}", _sql_text(quality.NAVIGATION))
    .replace("{boiler}", " OR ".join(f"contains(lower(line), '{_sql_text(p)}')" for p in quality.BOILERPLATE))
    .replace("{terminal}", _sql_text(quality.TERMINAL))
    .replace("{fragment}", str(quality.FRAGMENT_WORDS))
    .replace("{lost}", str(quality.MAX_LOST))
)


@query("op6_line_first_quality", QUALITY_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"
    )


def _secret_pieces(kind: str, pattern: str, group: int) -> str:
    p = _sql_text(pattern)
    return (
        f"SELECT k, '{kind}' AS kind, regexp_extract_all(text, '{p}') AS w, regexp_extract_all(text, '{p}', {group}) AS g, "
        f"string_split_regex(text, '{p}') AS gaps FROM t WHERE regexp_matches(text, '{p}')"
    )


_NO = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(secrets.KINDS)) + " END"
_PART = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{p}'" for k, p in secrets.PART.items()) + " END"
_LEAST = "CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for k, (_, _, n) in secrets.STRONG.items()) + " ELSE 0 END"
_STRONG = ", ".join(f"'{k}'" for k in secrets.STRONG)
_NEEDS = " OR ".join(
    f"(a.part = '{a}' AND b.part = '{b}')" for a, others in secrets.NEEDS.items() for b in others
)
_MIXED = " AND ".join(f"regexp_matches(word, '{p}')" for p in secrets.MIXED)
SECRET_SQL = f"""
WITH t AS (SELECT md5(text) AS k, any_value(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY 1),
m AS ({" UNION ALL ".join([_secret_pieces(k, p, g) for k, (p, g, _) in secrets.STRONG.items()] + [_secret_pieces(k, p, 1) for k, (p, _) in secrets.WEAK.items()])}),
u AS (SELECT k, kind, unnest(range(1, len(w) + 1)) AS i, w, g, gaps FROM m),
r AS (
  SELECT k, kind, w[i] AS word, length(w[i]) AS len, length(g[i]) AS inner_len,
         sum(length(gaps[i]) + length(w[i])) OVER (PARTITION BY k, kind ORDER BY i) AS z
  FROM u),
c AS (
  SELECT k, kind, {_PART} AS part, {_NO} AS no, kind IN ({_STRONG}) AS strong, (z - len)::BIGINT AS a, z::BIGINT AS z
  FROM r WHERE inner_len >= {_LEAST} AND (kind <> 'opaque' OR ({_MIXED}))),
l AS (
  SELECT * FROM c a WHERE a.strong OR EXISTS (
    SELECT 1 FROM c b WHERE a.k = b.k AND ({_NEEDS})
      AND (b.a - a.z BETWEEN 0 AND {secrets.SCOPE} OR a.a - b.z BETWEEN 0 AND {secrets.SCOPE}))),
f AS (
  SELECT * FROM l a WHERE a.strong OR NOT EXISTS (
    SELECT 1 FROM l b WHERE b.strong AND a.k = b.k AND b.a <= a.a AND a.z <= b.z)),
s AS (
  SELECT k, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(concat(kind, ':', a, ':', z), ',' ORDER BY a, no) FILTER (WHERE strong) AS base,
         string_agg(concat(kind, ':', a, ':', z), ',' ORDER BY a, no) AS spans
  FROM f GROUP BY k)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN s ON md5(d.text) = s.k
"""


@query("op9_linked_secrets", SECRET_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secret_spans", lambda s: s["strong"])
    return out.select(
        "doc_id", *map(count, secrets.STRONG), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secret_spans")).alias("spans")
    )


@query("op7_nn_descent")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@query("op8_chained_passages")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share a passage with others; passages as start:end:group in words, comma-joined."""
    out = passages.repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.transform("passages", lambda s: F.concat_ws(":", *[s[c].cast("string") for c in ("start", "end", "group_id")]))
    return out.withColumn("passages", F.array_join(spans, ","))


@query("op10_simhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    digits = F.lpad(F.lower(F.hex("fingerprint_bits")), 16, "0")
    return out.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op11_exact_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


PHRASE_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
      FROM p, range(1, {collocations.DEPTH + 1}) r(k) WHERE len(w) >= k),
f AS (SELECT lang, g.k, g, count(*)::BIGINT AS f FROM g GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
x AS (
  SELECT lang, o.g[i:i + m - 1] AS g, max(f) AS f
  FROM f o, range(1, {collocations.DEPTH + 1}) l(m), range(1, {collocations.DEPTH + 1}) s(i)
  WHERE m BETWEEN 2 AND o.k - 1 AND i + m - 1 <= o.k GROUP BY ALL),
c AS (SELECT f.lang, f.g, f.f AS a, f.k FROM f LEFT JOIN x ON f.lang = x.lang AND f.g = x.g
      WHERE f.k >= 2 AND (x.f IS NULL OR 100 * x.f < {collocations.SUBSUMED} * f.f)),
s AS (
  SELECT c.lang, c.g, c.a, cut, l.f AS l, r.f AS r, n.n,
         ((1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM c, range(1, {collocations.DEPTH}) t(cut), f l, f r, n
  WHERE cut < c.k AND l.lang = c.lang AND l.g = c.g[1:cut] AND r.lang = c.lang AND r.g = c.g[cut + 1:] AND n.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(g, ' ') AS phrase FROM b)
QUALIFY rank <= {collocations.TOP}
"""


@query("op12_phrase_index", PHRASE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_sum_of_squares_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER, with_ids=False).drop("ids")

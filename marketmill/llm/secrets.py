"""Secret scan with linking of credential parts.

Strong kinds (assignments, access ids, hex keys) count by themselves. Weak
candidates (labelled identifiers, long mixed tokens, endpoints) count only
where a complementary part lies within the same scope and does not overlap them: an interval semi-join of
candidate spans. What belongs together gets one credential number. Spark functions only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.windows import hashable
from marketmill.llm.common import unused

#: Contract patterns, in the order in which kinds at one start are listed. A kind: pattern,
#: group whose length counts, least length. Fixed values.
STRONG = {
    "assign": (
        r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
        r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
    ),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 20),
    # runs of under 24 would be dropped, and no longer run can begin inside one
    "hex": (r"([0-9a-f]{24,})", 1, 24),
}
#: Weak kinds: (pattern, part of a credential), letters of names in either case.
WEAK = {
    "ident": (
        r"""((?i:access_?key_?id|key_?id|client_?id|account_?id|tenant_?id|user_?name|user_?id|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,})""",
        "id",
    ),
    "opaque": (r"([A-Za-z0-9+/_-]{32,}={0,2})", "key"),
    "endpoint": (r"""([a-z][a-z0-9+.-]*://[^\x00-\x20"'<>]{4,})""", "place"),
}
#: What an opaque token has to hold, so that paths and long words are none: digits, both cases, and an unbroken run.
MIXED = (r"[0-9]", r"[a-z]", r"[A-Z]", r"[A-Za-z0-9]{16,}")
#: Parts of a credential that strong kinds supply.
PART = {"assign": "key", "access": "id", "hex": "key"} | {k: part for k, (_, part) in WEAK.items()}
#: What has to lie in scope for a weak part to be reported.
NEEDS = {"id": ("key",), "key": ("id", "place"), "place": ("key",)}
#: Characters between two parts of one credential.
SCOPE = 300
#: Shares into which copies of one text are dealt by their other columns where the spans come back.
SHARES = 32
KINDS = [*STRONG, *WEAK]


def _found(text: Column, pattern: str, group: int, holds: tuple[str, ...] = ()) -> Column:
    """Matches in order: characters before each since the last one, its length, its group's length, and whether it holds what it has to."""
    p = F.lit(pattern)
    whole, inner = F.regexp_extract_all(text, p, F.lit(0)), F.regexp_extract_all(text, p, F.lit(group))
    gaps = F.split(text, pattern, -1)
    return F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("g"), whole.alias("w"), inner.alias("i")),
        lambda m: F.struct(
            F.length(m["g"]).alias("gap"), F.length(m["w"]).alias("len"), F.length(m["i"]).alias("inner"),
            reduce(and_, (m["w"].rlike(p) for p in holds), F.lit(True)).alias("ok"),
        ),
    )


def _candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Spans (key, kind, part, start, end, strong) of all kinds, once for each different text."""
    patterns = {k: (p, g) for k, (p, g, _) in STRONG.items()} | {k: (p, 1) for k, (p, _) in WEAK.items()}
    least = {k: n for k, (_, _, n) in STRONG.items()}
    one = "|".join(f"(?:{p})" for p, _ in patterns.values())
    # texts without any match end here; the others shrink to the lengths of their matches
    hits = docs.filter(F.col(text).rlike(one)).select(
        F.col(key),
        F.array(
            *[
                F.struct(F.lit(k).alias("kind"), _found(F.col(text), p, g, MIXED if k == "opaque" else ()).alias("found"))
                for k, (p, g) in patterns.items()
            ]
        ).alias("kinds"),
    )
    hits = hits.dropDuplicates([key])
    rows = hits.select(key, F.inline("kinds")).select(key, "kind", F.posexplode("found").alias("n", "m"))
    along = Window.partitionBy(key, "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(along))
    wanted = F.create_map(*[x for k, n in least.items() for x in (F.lit(k), F.lit(n))])
    rows = rows.filter(F.col("m.ok") & (F.col("m.inner") >= F.coalesce(F.try_element_at(wanted, F.col("kind")), F.lit(0))))
    part = F.create_map(*[x for k, p in PART.items() for x in (F.lit(k), F.lit(p))])
    return rows.select(
        key,
        "kind",
        F.element_at(part, F.col("kind")).alias("part"),
        (F.col("end") - F.col("m.len")).alias("start"),
        "end",
        F.col("kind").isin(*STRONG).alias("strong"),
    )


def _linked(spans: DataFrame, key: str) -> DataFrame:
    """Strong spans, and weak ones with a complementary part in scope that they do not overlap, with their ``credential``.

    Only whether there is a part within reach counts, so the nearest end before and
    the nearest start after a span decide; running values over the starts and ends of a text give
    them, linear in its spans however densely they lie. A span belongs with the nearer of the two; spans that
    belong together, directly or through others, are one credential, numbered from 1 along the text. Strong spans alone have none.
    """
    point = F.explode(
        F.array(F.struct(F.col("end").alias("at"), F.lit(0).alias("begins")), F.struct(F.col("start").alias("at"), F.lit(1).alias("begins")))
    )
    points = spans.withColumn("p", point).select(*spans.columns, "p.at", "p.begins")
    # an end comes before a start at the same place, which it does not overlap
    order = Window.partitionBy(key).orderBy("at", "begins")
    back = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before, after = [], []
    for part in NEEDS:
        own = F.col("part") == part
        needed = F.col("part").isin(*[p for p, others in NEEDS.items() if part in others])
        last_end = F.max(F.when(own & (F.col("begins") == 0), F.col("at"))).over(back)
        next_start = F.min(F.when(own & (F.col("begins") == 1), F.col("at"))).over(ahead)
        before.append(F.when(needed & (F.col("begins") == 1), last_end))
        after.append(F.when(needed & (F.col("begins") == 0), next_start))
    points = points.withColumns({"before": F.greatest(*before), "after": F.least(*after)})
    near = points.groupBy(*spans.columns).agg(F.max("before").alias("before"), F.max("after").alias("after"))
    far = F.lit(2 * SCOPE + 1)
    left = F.coalesce(F.col("start") - F.col("before"), far)
    right = F.coalesce(F.col("after") - F.col("end"), far)
    near = near.withColumns({"near": F.least(left, right) <= SCOPE, "lo": F.when(left <= right, F.col("before") - 1).otherwise(F.col("start"))})
    near = near.withColumn("hi", F.when(left <= right, F.col("end")).otherwise(F.col("after") + 1))
    # the stretch from a span to its partner touches the partner's own
    along = Window.partitionBy(key).orderBy("lo", "hi", "kind")
    reached = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    linked = near.filter("near").withColumn("new", F.coalesce((F.col("lo") >= reached).cast("int"), F.lit(1)))
    number = F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    linked = linked.withColumn("credential", number.cast("int"))
    alone = near.filter("not near and strong").withColumn("credential", F.lit(None).cast("int"))
    return linked.select(*spans.columns, "credential").unionByName(alone.select(*spans.columns, "credential"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Input rows and columns with ``secret_spans``: array of (start, kind_no, kind, end, strong, credential), sorted.

    Offsets are code points, end exclusive; ``kind_no`` is the place of the kind in
    ``KINDS``; spans of one ``credential`` (a number within the text) belong together, and it is null for a strong span alone. Texts without
    spans have an empty array, null and empty texts too, and an empty table gives no rows.
    A weak span that a strong one covers wholly is left out. Equal texts, however long, are
    scanned once and share the result; a text with very many copies gets it in ``SHARES``
    tasks. An input column named secret_spans is replaced; all others stay, whatever their names.
    """
    key, share, other, turn, found, strong = unused(docs, "__key", "__share", "__k", "__s", "__spans", "__strong")
    df = docs.withColumn(key, F.md5(F.coalesce(F.col(text), F.lit(""))))
    lean = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    spans = _linked(_candidates(lean, "key", "text"), "key")
    number = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    item = F.struct("start", F.element_at(number, F.col("kind")).alias("kind_no"), "kind", "end", "strong", "credential")
    spans = spans.groupBy(F.col("key").alias(other)).agg(F.sort_array(F.collect_list(item)).alias(found))
    spans = spans.withColumn(strong, F.filter(found, lambda x: x["strong"]))
    bare = F.filter(
        found,
        lambda x: x["strong"]
        | ~F.exists(strong, lambda s: (s["start"] <= x["start"]) & (x["end"] <= s["end"])),
    )
    spans = spans.select(other, bare.alias(found))
    # only texts with spans are repeated, once for each share
    spans = spans.withColumn(turn, F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    others = [f"`{c}`" for c in hashable(docs) if c not in (text, "secret_spans")]
    df = df.drop("secret_spans").withColumn(share, F.pmod(F.xxhash64(F.lit(0), *others), F.lit(SHARES)))
    same = (F.col(key) == F.col(other)) & (F.col(share) == F.col(turn))
    out = df.join(spans, same, "left").drop(share, turn)
    none = F.array().cast(spans.schema[found].dataType)
    return out.withColumn("secret_spans", F.coalesce(found, none)).drop(key, other, found)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace the spans of ``scan`` in the text by ``mark``; overlapping spans become one. Nulls stay null."""

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        span = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return (
            F.when(F.size(acc) == 0, F.array(span))
            .when(s["start"] <= last["end"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined)))
            .otherwise(F.concat(acc, F.array(span)))
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    (merged,) = unused(docs, "__merged")
    df = docs.withColumn(merged, F.aggregate("secret_spans", none, merge))
    n = F.size(merged)

    def piece(i: Column) -> Column:
        start = F.coalesce(F.get(merged, i - 1)["end"], F.lit(0))
        end = F.coalesce(F.get(merged, i)["start"], F.length(text).cast("long"))
        return F.substring(F.col(text), (start + 1).cast("int"), (end - start).cast("int"))

    clean = F.array_join(F.transform(F.sequence(F.lit(0), n), piece), mark)
    return df.withColumn(text, F.when(n == 0, F.col(text)).otherwise(clean)).drop(merged)

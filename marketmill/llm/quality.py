"""Quality rules, line first: lines are judged and removed, then documents that lost too much go.

Everything is built from Spark's own functions; nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import WORD, add_columns, unused, words_of
from marketmill.session import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Share of a document's words that its removed lines may hold.
MAX_LOST = 0.3
#: A short line under this many words is a fragment if it lacks a terminal mark.
FRAGMENT_WORDS = 6

TERMINAL = r"""[.!?:;,)\]}"'\x{2026}\x{201D}\x{2019}\x{BB}\x{3002}][\x20\x09-\x0D]*$"""
NAVIGATION = r"(\|[^|]*){2}|([>\x{BB}\x{203A}\x{2022}][^>\x{BB}\x{203A}\x{2022}]*){3}"
#: Characters without which a line is neither navigation nor full of symbols.
MARKED = r"[#*$%&|<>\x{BB}\x{203A}\x{2022}]"
#: Phrases, in small letters, of lines that are no text of the document: English, German, French, Spanish. Fixed values.
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "subscribe now", "subscribe to our",
    "sign in to", "sign up for", "log in to", "click here", "read more", "enable javascript", "lorem ipsum",
    "skip to content", "back to top",
    "datenschutzerklärung", "nutzungsbedingungen", "cookie-richtlinie", "jetzt abonnieren", "hier klicken", "mehr lesen",
    "javascript aktivieren", "nach oben", "zum inhalt springen",
    "politique de confidentialité", "politique de cookies", "conditions d'utilisation", "abonnez-vous", "cliquez ici",
    "lire la suite", "activer javascript", "haut de page", "aller au contenu",
    "política de privacidad", "política de cookies", "términos de uso", "suscríbete", "haz clic aquí", "leer más",
    "habilitar javascript", "volver arriba", "saltar al contenido",
)


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is evaluated once and then at hand for every element of a lambda."""
    return F.get(F.transform(F.array(value), fn), 0)


def window_mask(words: Column) -> Column:
    """All ones below a power of two above the number of words."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(words)))) - 1


def window_keys(words: Column, mask: Column) -> Column:
    """Sorted keys of the 3-word windows: hash in the upper bits, position below.

    Equal windows become neighbours by sorting plain numbers.
    """
    n = F.size(words)
    zipped = F.arrays_zip(words, F.slice(words, F.lit(2), n), F.slice(words, F.lit(3), n))
    # one bit less, so that differences of keys stay in range
    hashes = F.transform(F.slice(zipped, F.lit(1), n - 2), lambda g: F.shiftright(F.xxhash64(g), 1))
    # coalesce only tells Spark that there is no null, so that it sorts numbers and not objects
    packed = lambda h, i: F.coalesce(h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")), F.lit(0))
    return F.sort_array(F.transform(hashes, packed))


def repeated_words(words: Column, keys: Column, mask: Column) -> Column:
    """Number of words covered by windows that equal another one.

    Keys close to a neighbour are candidates; those are compared by hash and word by word.
    """

    def close(ks: Column):
        def test(k: Column, i: Column) -> Column:
            after, before = F.get(ks, i + 1) - k <= mask, k - F.get(ks, i - 1) <= mask
            return F.coalesce(after, F.lit(False)) | F.coalesce(before, F.lit(False))

        return test

    place = lambda k: k.bitwiseAND(mask).cast("int")

    def same(a: Column, b: Column) -> Column:
        p, q = place(a), place(b)
        out = a.bitwiseAND(F.bitwise_not(mask)) == b.bitwiseAND(F.bitwise_not(mask))
        for i in range(3):
            out = out & (F.get(words, p + i) == F.get(words, q + i))
        return F.coalesce(out, F.lit(False))

    near = _let(keys, lambda ks: F.filter(ks, close(ks)))
    found = _let(near, lambda ks: F.filter(ks, lambda k, i: same(k, F.get(ks, i + 1)) | same(F.get(ks, i - 1), k)))
    covered = F.flatten(F.transform(found, lambda k: F.array(place(k), place(k) + 1, place(k) + 2)))
    return F.size(F.array_distinct(covered)).cast("long")


def line_verdicts(lines: Column) -> Column:
    """For every line: (line, used, rule, n, marks).

    ``used`` is whether it has a word, ``rule`` the rule it fails (null: none), ``n`` its
    words if it fails (else 0) and ``marks`` its symbols. Rules, the first match
    counts: navigation (two or more bars or three arrows or bullets), symbols (half as many as
    words, two at least), shouting (four or more words without a small letter),
    boilerplate (a known phrase in a line of up to 200 characters) and punctuation
    (up to 60 characters in under 6 words without a terminal mark). Empty lines pass.
    Cheap conditions stand first, so that few lines meet the dear ones.
    """

    def measured(line: Column) -> Column:
        marked = line.rlike(MARKED)
        marks = F.length(line) - F.length(F.regexp_replace(line, "[#*$%&|<>]", ""))
        return F.struct(
            line.alias("line"), line.rlike(WORD).alias("used"), marked.alias("marked"),
            F.when(marked, marks).otherwise(0).alias("marks"),
            F.when(F.length(line) <= 200, F.lower(line)).alias("small"),
        )

    def phrase(small: Column) -> Column:
        return reduce(or_, (F.contains(small, F.lit(p)) for p in BOILERPLATE))

    def judged(x: Column) -> Column:
        line, marks = x["line"], x["marks"]
        n = F.size(words_of(line))
        rule = (
            F.when(~x["used"], F.lit(None).cast("string"))
            .when(x["marked"] & line.rlike(NAVIGATION), F.lit("navigation"))
            .when((marks >= 2) & (2 * marks >= n), F.lit("symbols"))
            .when(~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}") & (n >= 4), F.lit("shouting"))
            .when(x["small"].isNotNull() & phrase(x["small"]), F.lit("boilerplate"))
            .when((F.length(line) <= 60) & ~line.rlike(TERMINAL) & (n < FRAGMENT_WORDS), F.lit("punctuation"))
        )
        return F.struct(line.alias("line"), x["used"].alias("used"), marks.alias("marks"), rule.alias("rule"))

    def counted(x: Column) -> Column:
        n = F.size(words_of(x["line"]))
        return F.struct(
            x["line"].alias("line"), x["used"].alias("used"), x["rule"].alias("rule"),
            F.when(x["rule"].isNull(), F.lit(0)).otherwise(n).alias("n"), x["marks"].alias("marks"),
        )

    return F.transform(F.transform(F.transform(lines, measured), judged), counted)


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measures and verdict per document, one row for each input row, input columns kept.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    lost_words (words in removed lines), failed_lines (a count per rule), clean_text
    and kept. A null or empty text has zeros, fails the base rules and has an
    empty clean_text. Input columns of those names are replaced, all others stay, whatever their names. Repeated rows are
    judged alike; text length is not limited; an empty table gives no rows.
    """
    words, lines, mask, keys = unused(docs, "__words", "__lines", "__mask", "__keys")
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumns({words: words_of(text), lines: line_verdicts(F.split(body, "\n", -1))})
    n = F.size(words)
    df = df.withColumn(mask, window_mask(F.col(words)))
    df = df.withColumn(keys, F.when(n >= 4, window_keys(F.col(words), F.col(mask))))
    with_word = F.filter(lines, lambda x: x["used"])
    kept_lines = F.filter(lines, lambda x: x["rule"].isNull())
    lost = F.aggregate(
        F.filter(lines, lambda x: x["rule"].isNotNull()), F.lit(0).cast("long"), lambda a, x: a + x["n"]
    )
    repeats = F.when(n >= 4, repeated_words(F.col(words), F.col(keys), F.col(mask))).otherwise(0)
    df = add_columns(
        df,
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + x["marks"]),
            "n_dup_lines": (
                F.size(with_word) - F.size(F.array_distinct(F.transform(with_word, lambda x: x["line"])))
            ).cast("long"),
            "n_repeat_words": repeats.cast("long"),
            "lost_words": lost,
            "failed_lines": F.transform(
                F.array(*map(F.lit, ("navigation", "symbols", "shouting", "boilerplate", "punctuation"))),
                lambda r: F.struct(
                    r.alias("rule"), F.size(F.filter(lines, lambda x: x["rule"] == r)).alias("lines")
                ),
            ),
            "clean_text": F.array_join(F.transform(kept_lines, lambda x: x["line"]), "\n"),
        },
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    df = add_columns(df, {"base_failed": failed})
    kept = ~F.col("base_failed") & (F.col("lost_words") <= MAX_LOST * F.col("n_words"))
    return add_columns(df, {"kept": kept}).drop(words, lines, mask, keys)


def cleaned(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents that are kept, with their clean text in place of the text and the input columns alone.

    The verdicts are written to the shared folder before the filter. Pushed below the projections it
    would repeat their nested expressions, and every line would be judged twice.
    """
    marked = quality(docs, text).select(
        F.col("kept").alias("__kept"), *[F.col("clean_text").alias(c) if c == text else docs[c] for c in docs.columns]
    )
    return materialize(marked, "quality").filter("__kept").drop("__kept")

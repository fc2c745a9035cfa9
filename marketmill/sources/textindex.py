"""An index of trigrams over text columns, so that a search does not read every text.

The indexed rows are stored in blocks, sorted so that similar texts share a block. Postings name the blocks in which a trigram of a
field occurs. A search looks up the trigrams of its text, keeps the blocks that hold all of them, and
reads those blocks only; the search itself then runs on their rows as on any table, so that
answers are the same. Texts without a trigram, and those found in very many blocks, read everything.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
#: Rows of a block; partitions of the postings by hash.
BLOCK_ROWS, BUCKETS = 4096, 64
#: Blocks that a search reads by name; beyond it everything is read.
MAX_BLOCKS = 500
#: Stands before the first character of a field that is searched by its beginning.
START = "\x02"

_BLOCK, _BUCKET = "__block", "__bucket"


def contains(text: Column) -> Column:
    """A field that is searched for a text anywhere in it, in any case."""
    return F.lower(text)


def starts(text: Column) -> Column:
    """A field that is searched by its beginning, in any case."""
    return F.concat(F.lit(START), F.lower(text))


def words(items: Column) -> Column:
    """A field that holds several whole values, such as a comma list, each searched as a whole."""
    parts = F.transform(F.split(items, r"\s*,\s*"), lambda s: F.concat(F.lit(START), F.lower(s), F.lit(START)))
    return F.array_join(parts, "")


def _grams(text: str) -> list[str]:
    return sorted({text[i : i + GRAM] for i in range(len(text) - GRAM + 1)})


def _bucket(field: Column, gram: Column) -> Column:
    return F.pmod(F.xxhash64(field, gram), F.lit(BUCKETS)).cast("int")


def write_index(df: DataFrame, path: str, fields: dict[str, Column], order: Sequence[Column], block_rows: int = BLOCK_ROWS) -> None:
    """Store the rows of a table and the postings of its fields under a path.

    ``fields`` maps names to expressions of :func:`contains`, :func:`starts` or :func:`words`; ``order`` sorts the rows, which
    need not be total. Rows with a null field are stored and have no postings of it. Sorting by ranges deals out
    any number of rows; a block lies in one file, and its rows are together in it.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    # the upper bits name the task, the lower ones count its rows
    block = F.shiftleft(F.shiftright(place, 33), 33).bitwiseOR(F.floor(place.bitwiseAND(F.lit((1 << 33) - 1)) / block_rows))
    rows = rows.withColumn(_BLOCK, block)
    # small row groups, so that the block numbers in their statistics tell them apart
    rows.write.mode("overwrite").option("parquet.block.size", 1 << 20).option("parquet.page.size", 1 << 16).parquet(f"{path}/rows")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    entries = F.array(*[F.struct(F.lit(name).alias("field"), text.alias("text")) for name, text in fields.items()])
    texts = stored.select(_BLOCK, F.inline(entries)).filter("text is not null")
    at = F.when(F.length("text") >= GRAM, F.sequence(F.lit(1), F.length("text") - GRAM + 1))
    grams = F.array_distinct(F.transform(at, lambda i: F.substring(F.col("text"), i, F.lit(GRAM))))
    postings = texts.select("field", F.explode(grams).alias("gram"), _BLOCK).distinct()
    postings = postings.withColumn(_BUCKET, _bucket(F.col("field"), F.col("gram")))
    postings = postings.hint("rebalance", _BUCKET).sortWithinPartitions(_BUCKET, "field", "gram", _BLOCK)
    postings.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/postings")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows")


def blocks_of(spark: SparkSession, path: str, wanted: Sequence[tuple[str, str]]) -> list[int] | None:
    """Blocks that can hold one of the texts (field, text); None where everything has to be read.

    A text is searched anywhere in the field; START before it ties it to the beginning of a ``starts`` field, and START
    on both sides to a whole value of a ``words`` field. Runs a job on the postings of these trigrams.
    """
    keys = [(i, field, gram) for i, (field, text) in enumerate(wanted) for gram in _grams(text.lower())]
    if not wanted or {i for i, _, _ in keys} != set(range(len(wanted))):
        return None
    asked = spark.createDataFrame(keys, "term int, field string, gram string").withColumn(_BUCKET, _bucket(F.col("field"), F.col("gram")))
    sizes = asked.groupBy("term").agg(F.count("*").alias("all"))
    # literals, so that the folders and row groups of other trigrams are not read
    literal = [F.struct(F.lit(f).alias("field"), F.lit(g).alias("gram")) for f, g in sorted({(f, g) for _, f, g in keys})]
    buckets = [r[0] for r in asked.select(_BUCKET).distinct().collect()]
    kinds = f"field string, gram string, {_BLOCK} long, {_BUCKET} int"
    postings = spark.read.schema(kinds).parquet(f"{path}/postings").filter(F.col(_BUCKET).isin(buckets))
    postings = postings.filter(F.col("gram").isin(sorted({g for _, _, g in keys}))).filter(F.struct("field", "gram").isin(literal))
    hits = postings.join(F.broadcast(asked.drop(_BUCKET)), ["field", "gram"]).groupBy("term", _BLOCK).agg(F.count("*").alias("n"))
    whole = hits.join(F.broadcast(sizes), "term").filter(F.col("n") == F.col("all")).select(_BLOCK).distinct()
    found = [r[0] for r in whole.limit(MAX_BLOCKS + 1).collect()]
    return None if len(found) > MAX_BLOCKS else sorted(found)


def _in_blocks(blocks: list[int]) -> Column:
    """Whether a row lies in one of the blocks, as ranges that reach the statistics of the files."""
    runs: list[list[int]] = []
    for b in blocks:
        if runs and runs[-1][1] == b - 1:
            runs[-1][1] = b
        else:
            runs.append([b, b])
    tests = [F.col(_BLOCK).between(a, z) for a, z in runs]
    while len(tests) > 1:  # a balanced tree, which the planner walks in few steps
        tests = [reduce(or_, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def narrowed(spark: SparkSession, path: str, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """The indexed rows without the blocks that hold none of the texts; what remains has to be searched.

    See :func:`blocks_of`. An empty table stays empty, and no text at all reads everything.
    """
    rows, blocks = _rows(spark, path), blocks_of(spark, path, wanted)
    if blocks is not None:
        rows = rows.filter(_in_blocks(blocks)) if blocks else rows.limit(0)
    return rows.drop(_BLOCK)

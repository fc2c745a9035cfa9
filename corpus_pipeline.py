"""From documents to token ids: clean, drop near copies, take out secrets, mix the sources, encode.

Each stage is an operator of ``marketmill.llm``; it takes the documents that the stage before
kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.llm import bpe, mixing, quality, secrets, simhash
from marketmill.llm.common import table
from marketmill.session import materialize

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Columns that the stages use; all others travel apart, so that their names cannot clash.
USED = ("doc_id", "text", "source", "n_chars")


def _apart(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stage on the used columns; the others come back as they were, in the old order."""
    used = [c for c in docs.columns if c in USED]
    rest = [c for c in docs.columns if c not in USED]
    out = stage(docs.select(*used, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__rest")) if rest else docs)
    return out.select(*[F.col(c) if c in used else F.col(f"__rest.`{c}`") for c in docs.columns])


def _recounted(docs: DataFrame) -> DataFrame:
    """Set n_chars to the length of the new text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do documents that fail the base rules or lose too much text.

    Null and empty texts fail the base rules. Repeated rows are judged alike; an empty table stays empty.
    """
    return _apart(docs, lambda d: _recounted(quality.cleaned(d)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that with the smallest id.

    A null id comes last; ties go to the smaller digest of the text, and of equal rows one stays. Texts without words, null ones
    too, are one component. An empty table stays empty.
    """
    return _apart(docs, lambda d: simhash.first_of_each(simhash.near_duplicates(d)))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the spans found are replaced in their texts.

    Null texts stay null; repeated rows and rows without an id stay as they are. An empty table stays empty.
    """
    return _apart(docs, lambda d: _recounted(secrets.redact(secrets.scan(d))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once, or up to three times.

    Sources are taken by their weights, a null source last; rows without an id are told apart by their text, and repeated rows each
    count. Texts without words have no size. An empty table stays empty.
    """
    return _apart(docs, mixing.mixed_documents)


def _encoded(enc, ids):
    raw = ids.astype("<u4").tobytes()
    return len(ids), raw, hashlib.sha256(bpe.decode(enc, ids)).hexdigest()


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids (little-endian uint32) of every document, and the digest of the bytes that they decode to.

    A null text has no ids. Repeated rows and rows without an id are encoded as they are, texts whole, however long. An empty
    table gives no rows.
    """
    return bpe.encode_documents(
        docs, RANKS, public_tokenizers.PATTERN, digest=_encoded, schema="n_tokens long, ids binary, decoded_sha256 string"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]
#: Fingerprints and token ids are beyond SQL; tests/llm compares every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

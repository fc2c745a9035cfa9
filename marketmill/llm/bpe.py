"""Byte-level BPE: encoding by a local rank file with the tiktoken library, and decoding to bytes."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketmill.llm.common import pieces

#: A text is cut near every so many characters, where a boundary allows it.
PIECE = 1 << 18
#: White space longer than this is taken out of the pattern's hands, whose matcher recurses.
LONG_SPACE = 1000

# white space as in the tokenizer's engine; Python's holds U+001C to U+001F too
_SPACE, _VISIBLE = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
_LONG = re.compile(_SPACE + "{%d,}" % LONG_SPACE)
#: Between visible and white space the split pattern always ends a match, whatever stands around.
_SAFE = re.compile(f"(?<={_VISIBLE})(?={_SPACE})")


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; one per worker process and file."""
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cut(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces that end at safe boundaries; a run without any stays whole."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def _visible(enc: tiktoken.Encoding, text: str) -> list[np.ndarray]:
    # only the tokenizer's pattern is applied here; no special tokens exist
    return [np.asarray(enc.encode_ordinary(p), dtype=np.uint32) for p in cut(text)]


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a whole text. Long white space is one match but for its last character, which may
    belong to the word behind it; it is merged as one piece."""
    out, at = [], 0
    for m in _LONG.finditer(text):
        last = m.end() if m.end() == len(text) else m.end() - 1
        start = m.start()
        if start > at:
            out += _visible(enc, text[at:start])
        out.append(np.asarray(enc._encode_single_piece(text[start:last]), dtype=np.uint32))
        at = last
    out += _visible(enc, text[at:])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text: str = "text", digest=None, schema=None
) -> DataFrame:
    """One row per input row: id and ``ids`` (little-endian uint32 bytes), or what ``digest`` makes of them.

    ``digest(enc, ids)`` returns the values of the columns of ``schema`` (a DDL string) in
    the worker, so that no ids travel. A null text is empty and has no ids; null ids
    and repeated rows are kept as they are; texts are encoded whole, however long; an empty table gives no rows. Other input
    columns are not returned, whatever their names. Rows are independent; nothing is shuffled.
    """
    digest = digest or (lambda enc, ids: (ids.astype("<u4").tobytes(),))
    fields = T._parse_datatype_string(schema or "ids binary")
    out = T.StructType([T.StructField("__id", docs.schema[id_col].dataType), *fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        enc, target = encoding(rank_file, pattern), to_arrow_schema(out)
        for batch in pieces(batches):
            rows = [digest(enc, encode(enc, t or "")) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [[] for _ in fields]
            arrays = [batch.column(0).cast(target.field(0).type)]
            arrays += [pa.array(c, type=f.type) for c, f in zip(cols, list(target)[1:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return docs.select(id_col, text).mapInArrow(work, out).withColumnRenamed("__id", id_col)


def decode(enc: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    """The bytes of the ids, which need not be whole characters."""
    return enc.decode_bytes(ids.tolist())

"""Token ids in files of length-delimited binary records, with an offset index beside each.

A record is: length (uint64, little endian), masked CRC-32 of the length bytes,
payload, masked CRC-32 of the payload (uint32 each). The payload is a sequence of ids,
``width`` bytes each. A record file begins with the magic and the width. Its index has one fixed entry per record:
offset (uint64), ids before it in the file (uint64), ids in it (uint64).

Files are written through the file system of the shared folder. A task writes
under a name of its own, and only the files of tasks that Spark committed are listed in
the manifest, so that a task run twice does no harm.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from marketmill.llm.common import pieces
from marketmill.llm.piecewise import BATCH, ByteEncoder
from marketmill.session import fresh_path, materialize

MAGIC = b"MMREC1\0"
INDEX = struct.Struct("<QQQ")
#: Bytes of ids after which a task begins its next file.
FILE_BYTES = 64 << 20


def mask(data: bytes) -> int:
    """CRC-32 rotated by 15 bits plus a constant, so that checksums of data with checksums inside stay sound."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = struct.pack("<Q", len(payload))
    return b"".join((n, struct.pack("<I", mask(n)), payload, struct.pack("<I", mask(payload))))


#: File systems of the record files, as the writer's library names them. Fixed values.
STORES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def store_uri(spark: SparkSession, path: str) -> str:
    """A folder with the scheme of its file system, as tasks on other machines have to see it.

    A path without a scheme belongs to Spark's default file system, and never silently to a task's own disk. Raises for
    file systems that tasks cannot write to.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    whole = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    scheme, _, rest = whole.partition(":")
    if scheme not in STORES:
        raise ValueError(f"no record files on {scheme}: file systems are {', '.join(STORES)}")
    return f"{STORES[scheme]}:" + (rest if rest.startswith("//") else f"//{rest}")


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a folder, given as a URI."""
    return fs.FileSystem.from_uri(path)


@functools.lru_cache(maxsize=2)
def encoder(path: str, dtype: str) -> ByteEncoder:
    return ByteEncoder(path, dtype)


MANIFEST = "shard int, file int, path string, n_records long, n_ids long, width int"


def write_records(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int | None = 0,
    partitions: int | None = None,
    label: str = "records",
) -> DataFrame:
    """Encode every document, and write the records in ascending id order. Returns the manifest.

    The manifest (one row per file: shard, file, path, n_records, n_ids, width, and
    ``start``, the ids in all files before it) is a table in the shared folder, and beside every record file
    lies its index ``.idx``, and ``.ids`` with the documents' ids in order. A null text is empty; ``end_id``
    ends every document. Null ids come last; rows that tie in the id are ordered by
    a digest of the text and lie in several files where they are many; repeated rows are all written. Special tokens of the
    tokenizer are recognised in texts, as its library does. Texts are written whole, however long; other columns are not used. An empty table gives an
    empty manifest. This runs jobs when called.
    """
    spark = docs.sparkSession
    folder = store_uri(spark, fresh_path(spark, label))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = rows.schema["id"].dataType
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.asc_nulls_last("id"), F.asc("tie")]
    # rows that tie in the id are dealt by a digest of the text, whose order is part of the files' order
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, F.asc_nulls_first("text")).drop("tie")
    vocab = Tokenizer.from_file(tokenizer_file).get_vocab_size()
    width = 2 if max(vocab, (end_id or 0) + 1) <= 1 << 16 else 4
    dtype = f"<u{width}"
    end = b"" if end_id is None else np.asarray([end_id], dtype=dtype).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, enc, made = TaskContext.get().partitionId(), encoder(tokenizer_file, dtype), []
        out = None
        for batch in pieces(batches, *BATCH):
            for ids, doc in zip(enc.encode(batch.column(1)), batch.column(0).to_pylist()):
                if out is None or out.size > FILE_BYTES:
                    made += [out.close()] if out else []
                    out = _Writer(folder, shard, len(made), width)
                out.add(doc, ids + end)
        made += [out.close()] if out else []
        if made:
            names = ["shard", "file", "path", "n_records", "n_ids", "width"]
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*made), types)], names)

    manifest = materialize(rows.mapInArrow(work, MANIFEST), f"{label}-manifest")
    # one row per file of 64 MB
    before = Window.orderBy("shard", "file").rowsBetween(Window.unboundedPreceding, -1)
    manifest = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    manifest = manifest.withColumn("id_type", F.lit(id_type.simpleString()))
    return materialize(manifest, f"{label}-files")


class _Writer:
    """One record file with its index and its list of document ids."""

    def __init__(self, folder: str, shard: int, file: int, width: int):
        store, inner = open_store(folder)
        store.create_dir(inner, recursive=True)
        name = f"part-{shard:05d}-{file:04d}-{uuid.uuid4().hex}.rec"
        self.path, self.shard, self.file, self.width = f"{folder}/{name}", shard, file, width
        self.data = store.open_output_stream(f"{inner}/{name}")
        self.index = store.open_output_stream(f"{inner}/{name}.idx")
        self.ids = store.open_output_stream(f"{inner}/{name}.ids")
        self.data.write(MAGIC + bytes([width]))
        self.size, self.n_records, self.n_ids = len(MAGIC) + 1, 0, 0
        self.keys: list = []

    def add(self, doc, payload: bytes) -> None:
        n = len(payload) // self.width
        record = frame(payload)
        self.index.write(INDEX.pack(self.size, self.n_ids, n))
        self.data.write(record)
        self.keys.append(doc)
        self.size += len(record)
        self.n_ids += n
        self.n_records += 1
        if len(self.keys) >= 65536:
            self._flush()

    def _flush(self) -> None:
        body = pa.record_batch([pa.array(self.keys)], names=["id"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, body.schema) as w:
            w.write_batch(body)
        blob = sink.getvalue().to_pybytes()
        self.ids.write(struct.pack("<Q", len(blob)) + blob)
        self.keys = []

    def close(self) -> tuple:
        self._flush()
        for f in (self.data, self.index, self.ids):
            f.close()
        return self.shard, self.file, self.path, self.n_records, self.n_ids, self.width


def _read_ids(store: fs.FileSystem, path: str) -> list:
    with store.open_input_stream(path) as f:
        out = []
        while head := f.read(8):
            out += pa.ipc.open_stream(f.read(struct.unpack("<Q", head)[0])).read_all().column(0).to_pylist()
        return out


def _checked(data: bytes, offset: int) -> bytes:
    """The payload of the record at an offset; raises where a checksum fails."""
    head = data[offset : offset + 8]
    (n,) = struct.unpack("<Q", head)
    (head_sum,) = struct.unpack_from("<I", data, offset + 8)
    payload = data[offset + 12 : offset + 12 + n]
    (body_sum,) = struct.unpack_from("<I", data, offset + 12 + n)
    if mask(head) != head_sum or mask(payload) != body_sum:
        raise ValueError(f"damaged record at {offset}")
    return payload


def read_records(manifest: DataFrame, seed: int | None = None, with_ids: bool = True) -> DataFrame:
    """Rows (id, start, n_tokens, ids_crc32, ids) from the files; ``ids`` are little-endian uint32 bytes.

    Without ``with_ids`` that column is null, and the ids stay in the worker that checks them.

    One task reads a file at a time (64 MB and a record at most). With a ``seed`` the files come in a random
    order and the records of each are read through its index in a random order, both fixed by the
    seed; without, in the order written. Damaged records raise.
    """
    spark: SparkSession = manifest.sparkSession
    first = manifest.select("id_type").first()
    id_type = first[0] if first else "bigint"
    files = manifest.select("path", "start", "n_records")
    # as many tasks as files, up to the number of partitions; a file goes where its name falls
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = files.repartition(n, F.xxhash64("path", F.lit(seed or 0)))
    if seed is not None:
        files = files.sortWithinPartitions(F.xxhash64("path", F.lit(seed)))
    out = T.StructType(
        [T.StructField("id", T._parse_datatype_string(id_type) if isinstance(id_type, str) else id_type)]
        + list(T._parse_datatype_string("start long, n_tokens long, ids_crc32 long, ids binary"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for batch in batches:
            for path, base, n in zip(*(c.to_pylist() for c in batch.columns)):
                store, inner = open_store(path)
                with store.open_input_stream(inner) as f:
                    data = f.read()
                if data[: len(MAGIC)] != MAGIC:
                    raise ValueError(f"no record file: {path}")
                dtype = f"<u{data[len(MAGIC)]}"
                with store.open_input_stream(f"{inner}.idx") as f:
                    index = np.frombuffer(f.read(), dtype="<u8").reshape(-1, 3)
                docs = _read_ids(store, f"{inner}.ids")
                if not len(index) == len(docs) == n:
                    raise ValueError(f"index and records differ: {path}")
                turn = np.arange(n)
                if seed is not None:
                    turn = np.random.default_rng([seed, zlib.crc32(path.rsplit("-", 1)[0].encode())]).permutation(n)
                for k in range(0, n, 256):
                    cols: list[list] = [[], [], [], [], []]
                    for i in turn[k : k + 256].tolist():
                        offset, before, tokens = index[i].tolist()
                        ids = np.frombuffer(_checked(data, offset), dtype=dtype).astype("<u4").tobytes()
                        for c, v in zip(cols, (docs[i], base + before, tokens, zlib.crc32(ids), ids if with_ids else None)):
                            c.append(v)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(cols, target)], schema=target
                    )

    return files.mapInArrow(work, out)

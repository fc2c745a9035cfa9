"""Documents packed into sequences of one length by the sum-of-squares rule.

Documents come one by one. Whole windows are cut off a long one; the rest goes into an open window, or a new one,
such that the sum over all fill levels of the squared number of windows at that level becomes
least. The level array holds these numbers, so that placing a document looks at levels and not at windows.
The rule keeps some window of nearly every fill open, and so nearly every rest finds one that it fills up.

Every task packs the documents that it reads, so nothing is shuffled. The few windows that are open at its
end are filled up from each other, and the last of them is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from marketmill.llm.common import pieces
from marketmill.llm.piecewise import BATCH, WordEncoder

LENGTH = 2048
#: Windows open at once; beyond it those open are filled up from each other. Bounds the memory of a task.
MAX_OPEN = 1 << 14
#: Bits of a sequence's number for its place in its task; the rest is the task.
_NTH_BITS = 40


@functools.lru_cache(maxsize=2)
def word_encoder(path: str, dtype: str) -> WordEncoder:
    return WordEncoder(path, dtype)


class Levels:
    """Open windows by fill level, placed by the sum-of-squares rule. A piece is (document, start, ids)."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.open: list[list[list]] = [[] for _ in range(length)]
        self.n_open = 0
        # change of the sum of squares when a window comes to a level, and when one leaves it; full windows leave the sum
        self.come = np.ones(length + 1, np.int64)
        self.come[length] = 0
        self.leave = np.full(length, np.iinfo(np.int64).max // 4)
        self.leave[0] = 0

    def _change(self, level: int, window: list, by: int) -> None:
        if 0 < level < self.length:
            if by > 0:
                self.open[level].append(window)
            n = len(self.open[level])
            self.come[level] = 2 * n + 1
            self.leave[level] = 1 - 2 * n if n else np.iinfo(np.int64).max // 4
            self.n_open += by

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece of 1 to ``length`` ids away; returns the window if that fills it. Ties go to the fullest window."""
        cost = self.come[size:] + self.leave[: self.length + 1 - size]
        level = len(cost) - 1 - int(cost[::-1].argmin())
        window = self.open[level].pop() if level else []
        self._change(level, window, -1)
        window.append(piece)
        if level + size == self.length:
            return window
        self._change(level + size, window, 1)
        return None

    def drain(self) -> list[list]:
        """All open windows, fullest first, and none is open any more."""
        out = [w for level in reversed(self.open) for w in level]
        self.__init__(self.length)
        return out


def poured(windows: list[list], length: int = LENGTH, width: int = 2) -> list[list]:
    """Open windows filled up from each other: the same pieces, cut where a window is full; the last is cut at powers of two.

    Windows at a power of two stay as they are.
    """
    fill = lambda w: sum(len(p[2]) for p in w) // width
    out, rest = [], []
    for w in windows:
        (out if fill(w).bit_count() == 1 else rest).append(w)
    todo = deque(p for w in rest for p in w)
    left = sum(map(fill, rest))
    while left:
        room = length if left >= length else 1 << (left.bit_length() - 1)
        window, left = [], left - room
        while room:
            doc, start, ids = todo.popleft()
            take = min(room, len(ids) // width)
            window.append((doc, start, ids[: take * width]))
            if len(ids) > take * width:
                todo.appendleft((doc, start + take, ids[take * width :]))
            room -= take
        out.append(window)
    return out


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int | None = 1,
    length: int = LENGTH,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (little-endian uint32).

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all of its ids with the end id, ``offset`` the ids
    before it in its sequence, whose pieces follow each other without a gap. A sequence has ``length`` ids or a power of two of them; none needs padding.
    Without ``with_ids`` that column is null. A null text is empty and has the end id alone (with
    ``end_id`` None nothing, and no row). Null and repeated document ids are documents of their own. Very long texts are packed
    whole. An empty table gives no rows. Other input columns are not used, whatever their names.
    ``sequence_id`` is unique and the same in a rerun over the same partitions; its numbers leave gaps.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    width = 2 if max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else 4
    dtype = f"<u{width}"
    end = b"" if end_id is None else np.asarray([end_id], dtype=dtype).tobytes()
    out = T.StructType(
        [T.StructField(id_col, rows.schema["id"].dataType)]
        + list(T._parse_datatype_string("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target, enc, levels = to_arrow_schema(out), word_encoder(tokenizer_file, dtype), Levels(length)
        number = TaskContext.get().partitionId() << _NTH_BITS
        done: list[list] = [[] for _ in target]
        most = length * width

        def close(window: list) -> None:
            nonlocal number
            offset = 0
            for (doc, total), start, ids in window:
                raw = np.frombuffer(ids, dtype).astype("<u4").tobytes()
                n = len(ids) // width
                row = (doc, start, n, zlib.crc32(raw), total, number, offset, raw if with_ids else None)
                for c, v in zip(done, row):
                    c.append(v)
                offset += n
            number += 1

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(done, target)], schema=target)
            for c in done:
                c.clear()
            return batch

        for batch in pieces(batches, *BATCH):
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                ids += end
                whole = len(ids) - len(ids) % most
                about = (doc, len(ids) // width)
                for at in range(0, whole, most):
                    close([(about, at // width, ids[at : at + most])])
                if len(ids) > whole:
                    full = levels.place((about, whole // width, ids[whole:]), (len(ids) - whole) // width)
                    if full:
                        close(full)
                    elif levels.n_open > MAX_OPEN:
                        for window in poured(levels.drain(), length, width):
                            close(window)
                if len(done[0]) >= 8192:
                    yield flushed()
        for window in poured(levels.drain(), length, width):
            close(window)
        if done[0]:
            yield flushed()

    return rows.mapInArrow(work, out)

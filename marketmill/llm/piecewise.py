"""Tokenizers over pieces of text between safe boundaries; the ids of short pieces are remembered."""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Different pieces whose ids a worker remembers, and the longest of them in bytes.
CACHE_PIECES, CACHE_BYTES = 600_000, 48
#: Pieces that are looked up at once, and new ones that the tokenizer gets as one text.
STEP, JOINED = 1 << 20, 512
#: Rows and bytes of text worth encoding at once: the more, the more pieces are equal.
BATCH = 4096, 8 << 20

_BYTES = np.arange(256)
#: ASCII letters and digits, and visible ASCII.
_PLAIN = np.array([chr(i).isalnum() and i < 128 for i in _BYTES])
_VISIBLE = (_BYTES > 0x20) & (_BYTES < 0x7F)
_MARK = np.isin(_BYTES, [0x2C, 0x2E])


def _stops(data: np.ndarray) -> np.ndarray:
    """Places of stops and commas that follow a letter or digit of ASCII or Latin-1."""
    at = np.flatnonzero(_MARK[data])
    at = at[at > 1]
    one, two = data[at - 1], data[at - 2]
    # C3 leads U+00C0 to U+00FF, all of them letters but two
    return at[_PLAIN[one] | ((two == 0xC3) & (one != 0x97) & (one != 0xB7) & (one >= 0x80))]


def _visible_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place (3 or more) is no white space of any script; C1 and Latin-1 signs count as white."""
    a, b, c = (data[at - i] for i in (3, 2, 1))
    white = (b == 0xC2) | ((a == 0xE1) & (b == 0x9A)) | ((a == 0xE2) & ((b == 0x80) | (b == 0x81))) | ((a == 0xE3) & (b == 0x80))
    return _VISIBLE[c] | ((c >= 0x80) & ~white)


def _take(flat: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Stretches of ``n`` items from ``begin`` on, one after the other."""
    end = np.cumsum(n)
    return flat[np.arange(end[-1] if len(end) else 0) + np.repeat(begin - (end - n), n)]


def _ends(pieces: pa.Array) -> np.ndarray:
    """Where each piece of an array with 64-bit offsets begins in its bytes, and the end of the last."""
    return np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]


class PieceEncoder:
    """Ids of texts from the ids of their pieces.

    Texts are cut where :meth:`cuts` says that the tokenizer ends a token whatever stands around, and only there. Equal pieces
    are looked up once for many texts. A bounded number of pieces is kept from call to call, those used last.
    """

    def __init__(self, path: str, dtype: str):
        # Spark runs a task per core already; more threads would only spin
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok, self.dtype = self.library(path), np.dtype(dtype)
        # pieces kept, the number of their ids, all these ids, and the step that used a piece last
        self.kept, self.n, self.flat = pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, self.dtype)
        self.used, self.step = np.zeros(0, np.int64), 0

    @staticmethod
    def library(path: str) -> Tokenizer:
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Which bytes begin a piece."""
        raise NotImplementedError

    def joins(self, new: pa.Array) -> np.ndarray:
        """Which pieces may be told apart when they are encoded together."""
        raise NotImplementedError

    def group(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """The number of ids of each piece, and all these ids, of pieces encoded together; None if they cannot be told apart."""
        raise NotImplementedError

    def single(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces encoded one by one."""
        raise NotImplementedError

    def ids(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each piece, and all these ids."""
        joins = self.joins(new)
        order = np.argsort(~joins, kind="stable")
        new, most = new.take(pa.array(order)), int(joins.sum())
        cuts = [*range(0, most, JOINED), *range(most, len(new), JOINED), len(new)]
        done = []
        for i, j in zip(cuts, cuts[1:]):
            part = new.slice(i, j - i)
            done.append((self.group(part) if j <= most else None) or self.single(part))
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, self.dtype)
        n, flat = map(np.concatenate, zip(*done))
        back = np.argsort(order)
        return n[back], _take(flat, (np.cumsum(n) - n)[back], n[back])

    def _each(self, texts: list[str], tok: Tokenizer | None = None) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in (tok or self.tok).encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), self.dtype)

    def _known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of different pieces begin, how many they are, and the ids."""
        place = pc.index_in(pieces, value_set=self.kept).fill_null(-1).to_numpy()
        new = place < 0
        self.step += 1
        self.used[place[~new]] = self.step
        first = np.cumsum(self.n) - self.n
        fresh = pieces.filter(pa.array(new))
        n, ids = self.ids(fresh)
        flat = np.concatenate((self.flat, ids))
        begin, size = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        begin[~new], size[~new] = first[place[~new]], self.n[place[~new]]
        begin[new], size[new] = len(self.flat) + np.cumsum(n) - n, n
        short = np.diff(_ends(fresh)) <= CACHE_BYTES
        self.kept = pa.concat_arrays([self.kept, fresh.filter(pa.array(short))])
        self.flat = np.concatenate((self.flat, ids[np.repeat(short, n)]))
        self.n = np.concatenate((self.n, n[short]))
        self.used = np.concatenate((self.used, np.full(len(self.n) - len(self.used), self.step)))
        if len(self.n) > CACHE_PIECES:
            stay = np.sort(np.argpartition(self.used, -(CACHE_PIECES // 2))[-(CACHE_PIECES // 2) :])
            self.flat = _take(self.flat, (np.cumsum(self.n) - self.n)[stay], self.n[stay])
            self.kept, self.n, self.used = self.kept.take(pa.array(stay)), self.n[stay], self.used[stay]
        return begin, size, flat

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as bytes; null is empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        bounds = _ends(texts) if len(texts) else np.zeros(1, np.int64)
        if bounds[-1] == bounds[0]:
            return [b""] * len(texts)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        first = self.cuts(data)
        first[bounds[:-1][bounds[:-1] < len(data)]] = True
        edges = np.append(np.flatnonzero(first), len(data))
        parts, sizes = [], []
        for at in range(0, len(edges) - 1, STEP):
            lie = edges[at : at + STEP + 1]
            pieces = pa.Array.from_buffers(pa.large_binary(), len(lie) - 1, [None, pa.py_buffer(lie), pa.py_buffer(data)]).dictionary_encode()
            which = pieces.indices.to_numpy()
            begin, n, flat = self._known(pieces.dictionary)
            sizes.append(n[which])
            parts.append(_take(flat, begin[which], sizes[-1]))
        out = np.concatenate(parts)
        before = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))[np.searchsorted(edges, bounds)].tolist()
        return [out[a:b].tobytes() for a, b in zip(before, before[1:])]


class ByteEncoder(PieceEncoder):
    """A byte-level tokenizer that splits its texts like GPT-2's.

    A text is cut before every blank or line end that follows visible text, and before a stop or comma that follows
    a letter or digit. New pieces that begin with such a blank are encoded together, and their ids told apart by the
    bytes they stand for. No special token of the tokenizer may hold a blank, stop or comma; those in texts are recognised, as the library does.
    """

    def __init__(self, path: str, dtype: str):
        super().__init__(path, dtype)
        self.whole = self.library(path)
        # pieces without a special token need not be searched for one
        self.tok.encode_special_tokens = True
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values() if t.special]
        vocab = self.whole.get_vocab()
        # a byte-level token has a character for each byte
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        self.width[list(vocab.values())] = [len(token) for token in vocab]

    def cuts(self, data: np.ndarray) -> np.ndarray:
        first = np.zeros(len(data), bool)
        at = np.flatnonzero((data == 0x20) | (data == 0x0A))
        at = at[at > 2]
        first[at[_visible_before(data, at)]] = True
        first[_stops(data)] = True
        return first

    def joins(self, new: pa.Array) -> np.ndarray:
        edges, raw = _ends(new), np.frombuffer(new.buffers()[2] or b"", np.uint8)
        head = raw[edges[:-1]]
        return ((head == 0x20) | (head == 0x0A)) & _VISIBLE[raw[edges[1:] - 1]]

    def group(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        edges = _ends(part)
        text = part.buffers()[2][edges[0] : edges[-1]].to_pybytes().decode()
        if any(s in text for s in self.special):
            return None
        _, ids = self._each([text])
        read = np.cumsum(self.width[ids])
        cuts = np.searchsorted(read, edges[1:] - edges[0])
        if cuts[-1] >= len(read) or not np.array_equal(read[cuts], edges[1:] - edges[0]):
            return None
        return np.diff(cuts, prepend=-1), ids

    def single(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode() for p in part.to_pylist()]
        found = any(s in t for t in texts for s in self.special)
        return self._each(texts, self.whole if found else None)


class WordEncoder(PieceEncoder):
    """A tokenizer that drops white space and never joins what it parts.

    A text is cut at blanks, and before a stop or comma that follows a letter or digit, where the tokenizer parts it too.
    New pieces of letters alone are encoded together, and their ids told apart by the ends of words among them. No special
    token may hold a blank, stop or comma.
    """

    def __init__(self, path: str, dtype: str):
        super().__init__(path, dtype)
        with open(path, encoding="utf-8") as f:
            suffix = json.load(f)["model"].get("end_of_word_suffix")
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True

    def cuts(self, data: np.ndarray) -> np.ndarray:
        blank = (data == 0x20) | (data == 0x0A) | (data == 0x09) | (data == 0x0D)
        first = blank.copy()
        first[1:] &= ~blank[:-1]
        first[_stops(data)] = True
        return first

    def _texts(self, part: pa.Array) -> pa.Array:
        return pc.ascii_trim_whitespace(part.cast(pa.large_string()))

    def joins(self, new: pa.Array) -> np.ndarray:
        return pc.utf8_is_alpha(self._texts(new)).to_numpy(zero_copy_only=False)

    def group(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        _, ids = self._each([" ".join(self._texts(part).to_pylist())])
        cuts = np.flatnonzero(self.ends[ids])
        if len(cuts) != len(part):  # a letter that becomes more than letters in small print
            return None
        return np.diff(cuts, prepend=-1), ids

    def single(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._each(self._texts(part).to_pylist())

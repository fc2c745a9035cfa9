"""Phrases whose words stand together more often than chance, from one FM-index per shard of the corpus.

A shard is a bounded stretch of the corpus as a sequence of word numbers, with a separator
between pieces. Its FM-index holds the Burrows-Wheeler transforms of the sequence and of its
reverse, so that the interval of a phrase can be extended by a word on either side
(bidirectional extension), which gives the counts of all longer phrases at once. Counts
are summed across shards:

1. every shard lists its words, dealt over buckets; a bucket sums the lists of all shards, numbers the words that are frequent
   in the whole corpus, and tells each shard which of its words these are; all others become separators,
2. every shard is indexed and lists its phrases of two words in the same way, as sorted numbers,
3. every shard extends the frequent ones up to the depth, and lists what it finds as numbers of pairs, which are summed alike.

A phrase can only be as frequent as its parts, so nothing is lost. What a shard
lists is bounded by its length; no task sees more than one shard, one bucket or the counts of one phrase.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions.windows import top_n_per_key
from marketmill.llm.common import packed, pieces, unpacked
from marketmill.session import materialize

#: Words in a phrase, least count of a phrase, phrases listed for each language.
MIN_LENGTH, DEPTH = 2, 5
MIN_COUNT = 100
TOP = 2000
#: A phrase goes if a longer one around it has so many percent of its count.
SUBSUMED = 100
#: Words (and separators) in a shard, which bounds the memory of a task; buckets for each shuffle partition.
SHARD_WORDS, BUCKETS = 3 << 20, 2
NO_LANGUAGE = "und"

#: Separator of pieces within a text while it is split; no UTF-8 text holds this byte.
_CUT = b"\xff"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)


def tokens(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased, with a cut wherever a piece ends."""
    return text.translate(_TABLE).replace(b"\n", b" " + _CUT + b" ").split()


def _symbols(values: np.ndarray, top: int) -> bytes:
    return packed(values.astype(np.uint16 if top < 1 << 16 else np.uint32))


class _Shard:
    """Numbers words by (language, word) in the order in which they appear; 0 is the separator."""

    def __init__(self):
        self.numbers = defaultdict(lambda: defaultdict(self._next))
        self.last, self.parts, self.size = 0, [np.zeros(1, np.int32)], 1

    def _next(self) -> int:
        self.last += 1
        return self.last

    def add(self, lang: str, text: bytes) -> None:
        own = self.numbers[lang]
        own[_CUT] = 0
        found = tokens(text)
        for at in range(0, len(found), SHARD_WORDS):
            part = found[at : at + SHARD_WORDS]
            self.parts.append(np.fromiter(map(own.__getitem__, part), np.int32, len(part)))
            self.size += len(part)
        self.parts.append(np.zeros(1, np.int32))
        self.size += 1


#: Bits of a shard's number for its place in its task; the rest is the task.
_NTH_BITS = 12

_SHARDS = "shard long, top int, seq binary, bucket int, lang string, words binary, counts binary"
_SHARD_NAMES = [c.split()[0] for c in _SHARDS.split(", ")]
_SHARD_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.string(), pa.binary(), pa.binary()]


def _table(names: list[str], types: list[pa.DataType], **columns) -> pa.Table:
    n = len(next(iter(columns.values()))) if columns else 0
    return pa.Table.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types)], names)


def _joined(parts: list[np.ndarray], blanks: bool) -> np.ndarray:
    seq = np.concatenate(parts)
    # a run of separators counts as one
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0)
    return seq[keep] if blanks else seq


def _shard_rows(buckets: int):
    """Rows of two kinds: a shard's sequence (seq), and its words of one language in one bucket, with their numbers and counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), itertools.count()
        shard = _Shard()

        def closed() -> Iterator[pa.RecordBatch]:
            seq = _joined(shard.parts, True)
            counts = np.bincount(seq, minlength=shard.last + 1)
            top, nth = shard.last, next(made)
            if nth >> _NTH_BITS:
                raise OverflowError("too many shards in a task; read smaller partitions")
            code = task << _NTH_BITS | nth
            yield from _table(_SHARD_NAMES, _SHARD_TYPES, shard=[code], top=[top], seq=[_symbols(seq, top)]).to_batches()
            for lang, own in shard.numbers.items():
                # in the order of their numbers
                words = np.array([w for w in own if w != _CUT], object)
                number = np.array([n for w, n in own.items() if w != _CUT], np.uint32)
                at = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words)) % buckets
                order = np.argsort(at, kind="stable")
                cuts = np.searchsorted(at[order], np.arange(buckets + 1))
                lists, packs, places = [], [], np.flatnonzero(np.diff(cuts)).astype(np.int32)
                for b in places.tolist():
                    some = order[cuts[b] : cuts[b + 1]]
                    lists.append(zstandard.ZstdCompressor(level=1).compress(b"\n".join(words[some])))
                    packs.append(packed(np.diff(number[some], prepend=np.uint32(0)), counts[number[some]].astype(np.uint32)))
                rows = _table(_SHARD_NAMES, _SHARD_TYPES, shard=np.full(len(places), code), bucket=places, lang=[lang] * len(places), words=lists, counts=packs)
                yield from rows.to_batches()

        for batch in pieces(batches):
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    shard.add(lang, text)
                if shard.size >= SHARD_WORDS:
                    yield from closed()
                    shard = _Shard()
        if shard.last:
            yield from closed()

    return work


_KNOWN = "shard long, bucket int, known binary, id long, lang string, word string, f long, total long"
_KNOWN_NAMES = [c.split()[0] for c in _KNOWN.split(", ")]
_KNOWN_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The other columns of rows by their first, the bucket; one bucket is held at a time."""
    held, current = [], None
    for batch in batches:
        for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != current and held:
                yield current, held
                held = []
            current = bucket
            held.append(row)
    if held:
        yield current, held


def _word_sums(buckets: int, min_count: int):
    """Word lists (bucket, shard, lang, words, counts) to answers (shard, bucket, known), words (id, lang, word, f) and totals (lang, total)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, lists in _by_bucket(batches):
            sums: dict[str, Counter] = defaultdict(Counter)
            read = []
            for shard, lang, words, counts in lists:
                words = zstandard.ZstdDecompressor().decompress(words).split(b"\n")
                steps, n = unpacked(counts)
                read.append((shard, lang, words, steps))
                own = sums[lang]
                for w, c in zip(words, n.tolist()):
                    own[w] += c
            much = sorted((lang, w) for lang, own in sums.items() for w, c in own.items() if c >= min_count)
            # numbers of different buckets differ, and have as few gaps as the buckets are even
            ids = {k: bucket + buckets * i for i, k in enumerate(much)}
            for at in range(0, len(much), 65536):
                some = much[at : at + 65536]
                rows = _table(
                    _KNOWN_NAMES, _KNOWN_TYPES, id=[ids[k] for k in some], lang=[k[0] for k in some], word=[k[1].decode() for k in some], f=[sums[a][b] for a, b in some]
                )
                yield from rows.to_batches()
            yield from _table(_KNOWN_NAMES, _KNOWN_TYPES, lang=list(sums), total=[own.total() for own in sums.values()]).to_batches()
            shards, blobs = [], []
            for shard, lang, words, steps in read:
                id_of = [ids.get((lang, w), -1) for w in words]
                id_of = np.array(id_of, np.int64)
                keep = id_of >= 0
                if keep.any():
                    local = np.cumsum(steps, dtype=np.uint32)[keep]
                    shards.append(shard)
                    blobs.append(packed(np.diff(local, prepend=np.uint32(0)), id_of[keep]))
            if shards:
                yield from _table(_KNOWN_NAMES, _KNOWN_TYPES, shard=shards, bucket=[bucket] * len(shards), known=blobs).to_batches()

    return work


# ---- FM-index of one shard


def suffix_order(seq: np.ndarray, top: int, depth: int) -> np.ndarray:
    """Positions ordered by the next ``depth`` symbols at least; what ties beyond stays in text order.

    That is enough for the intervals of phrases of up to ``depth`` symbols and for their extension, since
    neither looks further.
    """
    n, bits = len(seq), max(1, int(top).bit_length())
    have = max(1, min(depth, 62 // bits))
    key = np.zeros(n, np.int64)
    for i in range(have):
        key <<= bits
        key[: max(0, n - i)] |= seq[i:].astype(np.int64)
    order = np.argsort(key, kind="stable")
    while have < depth:
        rank = np.zeros(n + have, np.int64)
        ordered = key[order]
        rank[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        key = rank[:n] * (n + 1) + rank[have : n + have]
        order = np.argsort(key, kind="stable")
        have *= 2
    return order


def transform(seq: np.ndarray, top: int, depth: int) -> np.ndarray:
    """The symbol before each position, in suffix order."""
    return seq[suffix_order(seq, top, depth) - 1]


def last_first(bwt: np.ndarray) -> np.ndarray:
    """The LF mapping: where the suffix begins that starts with the symbol before this one."""
    out = np.empty(len(bwt), np.int64)
    out[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    return out


def extend(bwt: np.ndarray, lf: np.ndarray, low: np.ndarray, n: np.ndarray):
    """All extensions of phrases by one symbol, from their intervals [low, low + n) in the transform.

    Returns for each pair of phrase and symbol: the phrase's place, the symbol, its count, the start of the extended
    phrase's interval here, and by how much its interval on the other side starts later than the phrase's.
    """
    of = np.repeat(np.arange(len(low)), n)
    at = np.arange(len(of)) + np.repeat(low - (np.cumsum(n) - n), n)
    symbol = bwt[at].astype(np.int64)
    width = int(symbol.max(initial=0)) + 1
    key, first, count = np.unique(of * width + symbol, return_index=True, return_counts=True)
    of, symbol = key // width, key % width
    before = np.cumsum(count) - count
    group = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    shift = before - np.repeat(before[group], np.diff(np.concatenate((group, [len(of)]))))
    keep = symbol > 0
    return of[keep], symbol[keep], count[keep], lf[at[first[keep]]], shift[keep]


def two_words(backward: np.ndarray, top: int):
    """Phrases of two words from the reverse's transform: (first word, second word, count, interval start, interval start of the reverse)."""
    count = np.bincount(backward, minlength=top + 1)
    start = np.cumsum(count) - count
    words = np.flatnonzero(count)
    words = words[words > 0]
    of, second, n, r_low, shift = extend(backward, last_first(backward), start[words], count[words])
    first = words[of]
    return first, second, n, start[first] + shift, r_low


def pairs(seq: np.ndarray, top: int, depth: int):
    """Transforms of a sequence and of its reverse, and its :func:`two_words`."""
    forward, backward = transform(seq, top, depth), transform(seq[::-1], top, depth)
    return forward, backward, *two_words(backward, top)


def longer(forward: np.ndarray, backward: np.ndarray, words: np.ndarray, low: np.ndarray, r_low: np.ndarray, n: np.ndarray, depth: int):
    """Phrases of three words and more, of which every two neighbours are among the given pairs: (words, counts) by length."""
    lf, r_lf = last_first(forward), last_first(backward)
    for _ in range(words.shape[1], depth):
        if not len(words):
            return
        of, word, count, new_r, shift = extend(backward, r_lf, r_low, n)
        new_low = low[of] + shift
        # the same phrase comes from its own tail, extended to the left; else the tail is not frequent
        _, _, _, from_tail, _ = extend(forward, lf, low, n)
        keep = np.isin(new_low, from_tail)
        words = np.concatenate((words[of[keep]], word[keep, None]), axis=1)
        low, r_low, n = new_low[keep], new_r[keep], count[keep]
        yield words, n


class Mixer:
    """Numbers pairs of words, in an order in which neighbours have nothing in common, and back; the numbers fall evenly over buckets."""

    def __init__(self, words: int, buckets: int):
        self.width, self.buckets = max(1, int(words).bit_length()), np.uint64(buckets)
        bits = 2 * self.width
        self.mask, self.half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
        self.odd = 0x9E3779B97F4A7C15 | 1
        self.back = np.uint64(pow(self.odd, -1, 1 << 64))
        self.odd = np.uint64(self.odd)

    def numbers(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        x = first.astype(np.uint64) << np.uint64(self.width) | second.astype(np.uint64)
        x = x * self.odd & self.mask
        x ^= x >> self.half
        return x * self.odd & self.mask

    def pairs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x * self.back & self.mask
        x = x ^ x >> self.half
        x = x * self.back & self.mask
        return (x >> np.uint64(self.width)).astype(np.int64), (x & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def order(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order by bucket and number, the numbers within buckets in it, and where each bucket begins."""
        bucket, rest = x % self.buckets, x // self.buckets
        order = np.lexsort((rest, bucket))
        return order, rest[order], np.searchsorted(bucket[order], np.arange(int(self.buckets) + 1, dtype=np.uint64))


_INDEX = "shard long, top int, seq binary, ids array<bigint>, bucket int, pairs binary"
_INDEX_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_INDEX_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.binary()]


def _index_rows(depth: int, mixer: Mixer):
    """The sequence of a shard's frequent words alone, which later is indexed again, and its phrases of two words by bucket."""

    def work(shard: pa.Table, answers: pa.Table) -> pa.Table:
        if not shard.num_rows or not answers.num_rows:
            return _table(_INDEX_NAMES, _INDEX_TYPES)
        code, top = shard["shard"][0].as_py(), shard["top"][0].as_py()
        read = [unpacked(blob) for blob in answers["known"].to_pylist()]
        local = np.concatenate([np.cumsum(steps, dtype=np.uint32) for steps, _ in read])
        order = np.argsort(local)
        ids = np.concatenate([r[1] for r in read]).astype(np.int64)[order]
        number = np.zeros(top + 1, np.int32)
        number[local[order]] = np.arange(1, len(local) + 1)
        (seq,) = unpacked(shard["seq"][0].as_py())
        # a separator at both ends, so that nothing runs round the end
        seq, top = np.concatenate((_joined([number[seq]], True), [0])).astype(np.int32), len(ids)
        _, _, first, second, n, _, _ = pairs(seq, top, depth)
        order, rest, cuts = mixer.order(mixer.numbers(ids[first - 1], ids[second - 1]))
        n = n[order]
        blobs, buckets = [], np.flatnonzero(np.diff(cuts)).astype(np.int32)
        for b in buckets.tolist():
            i, j = cuts[b], cuts[b + 1]
            blobs.append(packed(np.diff(rest[i:j], prepend=np.uint64(0)), n[i:j].astype(np.uint32)))
        head = _table(_INDEX_NAMES, _INDEX_TYPES, shard=[code], top=[top], seq=[_symbols(seq, top)], ids=[ids])
        rows = _table(_INDEX_NAMES, _INDEX_TYPES, shard=np.full(len(blobs), code), bucket=buckets, pairs=blobs)
        return pa.concat_tables([head, rows])

    return work


_SUMS = "shard long, bucket int, frequent binary, id long, first long, second long, f long"
_SUM_NAMES = [c.split()[0] for c in _SUMS.split(", ")]
_SUM_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def _bucket_sums(mixer: Mixer, min_count: int):
    """Lists (bucket, shard, pairs) to answers (shard, bucket, frequent places) and frequent pairs (first, second, f)."""

    def summed(bucket: int, lists: list[tuple[int, bytes]]) -> Iterator[pa.Table]:
        read = [unpacked(blob) for _, blob in lists]
        number = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in read])
        count = np.concatenate([n for _, n in read]).astype(np.int64)
        order = np.argsort(number, kind="stable")
        ordered = number[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        total = np.add.reduceat(count[order], first)
        much = total >= min_count
        if not much.any():
            return
        a, b = mixer.pairs(ordered[first[much]] * mixer.buckets + np.uint64(bucket))
        # numbers of different buckets differ
        ids = np.where(much, bucket + int(mixer.buckets) * (np.cumsum(much) - 1), -1)
        yield _table(_SUM_NAMES, _SUM_TYPES, id=ids[much], first=a, second=b, f=total[much])
        mine = np.empty(len(number), np.int64)
        mine[order] = np.repeat(ids, np.diff(np.concatenate((first, [len(number)]))))
        at, shards, blobs = 0, [], []
        for (shard, _), (steps, _) in zip(lists, read):
            own = mine[at : at + len(steps)]
            places = np.flatnonzero(own >= 0).astype(np.uint32)
            at += len(steps)
            if len(places):
                shards.append(shard)
                blobs.append(packed(np.diff(places, prepend=np.uint32(0)), own[places]))
        yield _table(_SUM_NAMES, _SUM_TYPES, shard=np.array(shards), bucket=np.full(len(shards), bucket, np.int32), frequent=blobs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, lists in _by_bucket(batches):
            for t in summed(bucket, lists):
                yield from t.to_batches()

    return work


def _widths(length: int, pair_bits: int, word_bits: int) -> list[list[int]]:
    """Widths of the parts of a phrase (its pairs, and its last word if their number is odd), by the 64-bit column they share."""
    out: list[list[int]] = []
    for width in [pair_bits] * (length // 2) + [word_bits] * (length % 2):
        if out and sum(out[-1]) + width <= 64:
            out[-1].append(width)
        else:
            out.append([width])
    return out


def _together(parts: list[np.ndarray], widths: list[list[int]]) -> list[np.ndarray]:
    out, at = [], iter(parts)
    for column in widths:
        x = np.zeros(len(parts[0]), np.uint64)
        for width in column:
            x = x << np.uint64(width) | next(at).astype(np.uint64)
        out.append(x)
    return out


def _apart(columns: list[np.ndarray], widths: list[list[int]]) -> list[np.ndarray]:
    out = []
    for x, column in zip(columns, widths):
        part = []
        for width in reversed(column):
            part.append((x & np.uint64((1 << width) - 1)).astype(np.int64))
            x = x >> np.uint64(width)
        out += part[::-1]
    return out


_LONGER = "bucket int, length int, shard long, phrases binary"
_LONGER_NAMES = [c.split()[0] for c in _LONGER.split(", ")]
_LONGER_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]


def _longer_rows(depth: int, mixer: Mixer, pair_bits: int):
    """Phrases of three words and more of a shard, by bucket and length, as sorted columns with their counts."""

    def work(index: pa.Table, answers: pa.Table) -> pa.Table:
        out = [_table(_LONGER_NAMES, _LONGER_TYPES)]
        if not index.num_rows or not answers.num_rows:
            return out[0]
        code, top = index["shard"][0].as_py(), index["top"][0].as_py()
        (seq,) = unpacked(index["seq"][0].as_py())
        ids = np.array(index["ids"][0].as_py(), np.int64)
        forward, backward, first, second, n, low, r_low = pairs(seq, top, depth)
        order, _, cuts = mixer.order(mixer.numbers(ids[first - 1], ids[second - 1]))
        read = [(cuts[b], unpacked(blob)) for b, blob in zip(answers["bucket"].to_pylist(), answers["frequent"].to_pylist())]
        keep = order[np.concatenate([at + np.cumsum(steps) for at, (steps, _) in read]).astype(np.int64)]
        number = np.concatenate([own for _, (_, own) in read]).astype(np.int64)
        pair = first[keep].astype(np.int64) * (top + 1) + second[keep]
        known = np.argsort(pair)
        words = np.stack((first[keep], second[keep]), axis=1)
        for words, count in longer(forward, backward, words, low[keep], r_low[keep], n[keep], depth):
            length = words.shape[1]
            parts = []
            for i in range(0, length - 1, 2):
                two = words[:, i].astype(np.int64) * (top + 1) + words[:, i + 1]
                parts.append(number[known[np.searchsorted(pair, two, sorter=known)]])
            if length % 2:
                parts.append(ids[words[:, -1] - 1])
            columns = _together(parts, _widths(length, pair_bits, mixer.width))
            mixed = np.zeros(len(count), np.uint64)
            for c in columns:
                mixed = (mixed ^ c) * mixer.odd
                mixed ^= mixed >> np.uint64(32)
            bucket = mixed % mixer.buckets
            line = np.lexsort((*columns[::-1], bucket))
            columns, count = [c[line] for c in columns], count[line].astype(np.uint32)
            cuts_ = np.searchsorted(bucket[line], np.arange(int(mixer.buckets) + 1, dtype=np.uint64))
            places, blobs = np.flatnonzero(np.diff(cuts_)).astype(np.int32), []
            for b in places.tolist():
                i, j = cuts_[b], cuts_[b + 1]
                blobs.append(packed(np.diff(columns[0][i:j], prepend=np.uint64(0)), *[c[i:j] for c in columns[1:]], count[i:j]))
            m = len(places)
            out.append(_table(_LONGER_NAMES, _LONGER_TYPES, bucket=places, length=np.full(m, length, np.int32), shard=np.full(m, code), phrases=blobs))
        return pa.concat_tables(out)

    return work


_FOUND = "pairs array<bigint>, last long, f long"


def _longer_sums(mixer: Mixer, pair_bits: int, min_count: int):
    """Lists (bucket, length, phrases) to frequent phrases (pairs, last, f)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_bucket(batches):
            by_length: dict[int, list[list[np.ndarray]]] = defaultdict(list)
            for length, blob in rows:
                first, *more = unpacked(blob)
                by_length[length].append([np.cumsum(first, dtype=np.uint64), *more])
            for length, lists in by_length.items():
                *columns, count = (np.concatenate(c) for c in zip(*lists))
                order = np.lexsort(columns[::-1])
                columns = [c[order] for c in columns]
                new = np.ones(len(order), bool)
                new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
                first = np.flatnonzero(new)
                total = np.add.reduceat(count[order].astype(np.int64), first)
                much = total >= min_count
                if not much.any():
                    continue
                parts = _apart([c[first[much]] for c in columns], _widths(length, pair_bits, mixer.width))
                last = parts.pop() if length % 2 else None
                size, k = int(much.sum()), len(parts)
                both = pa.ListArray.from_arrays(np.arange(0, size * k + 1, k, dtype=np.int32), np.stack(parts, axis=1).ravel())
                ends = pa.nulls(size, pa.int64()) if last is None else pa.array(last)
                yield pa.RecordBatch.from_arrays([both, ends, pa.array(total[much])], ["pairs", "last", "f"])

    return work


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, depth: int = DEPTH):
    """Words (id, lang, word, f), phrases (words, f) of 1 to ``depth`` words with f >= min_count, and word totals (lang, n).

    A phrase is an array of word ids; a word of each language has an id of its own. Phrases never
    reach across punctuation, line ends or texts. Texts that are null or empty have no words, a null language is
    NO_LANGUAGE. Writes intermediates (sequences, indexes, lists of pairs) to the shared folder.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS * parts
    lean = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    shards = materialize(lean.mapInArrow(_shard_rows(buckets), _SHARDS), "phrase-shards")
    lists = shards.filter("words is not null").select("bucket", "shard", "lang", "words", "counts")
    lists = lists.repartition(parts, "bucket").sortWithinPartitions("bucket", "shard")
    known = materialize(lists.mapInArrow(_word_sums(buckets, min_count), _KNOWN), "phrase-words")
    words = known.filter("word is not null").select("id", "lang", "word", "f")
    totals = known.filter("total is not null").groupBy("lang").agg(F.sum("total").alias("n"))
    mixer = Mixer((words.agg(F.max("id")).first()[0] or 0) + 1, buckets)
    answers = known.filter("known is not null").select("shard", "known")
    sequences = shards.filter("seq is not null").select("shard", "top", "seq")
    built = sequences.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_index_rows(depth, mixer), _INDEX)
    built = materialize(built, "phrase-index")
    lists = built.filter("pairs is not null").select("bucket", "shard", "pairs")
    lists = lists.repartition(parts, "bucket").sortWithinPartitions("bucket", "shard")
    sums = materialize(lists.mapInArrow(_bucket_sums(mixer, min_count), _SUMS), "phrase-pairs")
    phrases = words.select(F.array("id").alias("words"), "f")
    if depth >= 2:
        phrases = phrases.unionByName(sums.filter("f is not null").select(F.array("first", "second").alias("words"), "f"))
    if depth >= 3:
        index = built.filter("seq is not null").select("shard", "top", "seq", "ids")
        answers = sums.filter("frequent is not null").select("shard", "bucket", "frequent")
        two = sums.filter("id is not null").select("id", F.array("first", "second").alias("two"))
        pair_bits = max(1, int(two.agg(F.max("id")).first()[0] or 0).bit_length())
        lists = index.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_longer_rows(depth, mixer, pair_bits), _LONGER)
        lists = lists.repartition(parts, "bucket").sortWithinPartitions("bucket").select("bucket", "length", "phrases")
        found = materialize(lists.mapInArrow(_longer_sums(mixer, pair_bits, min_count), _FOUND), "phrase-longer")
        each = found.select("pairs", "last", "f", F.posexplode("pairs").alias("i", "id")).join(two, "id")
        each = each.groupBy("pairs", "last", "f").agg(F.sort_array(F.collect_list(F.struct("i", "two"))).alias("w"))
        end = F.when(F.col("last").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("last"))
        more = each.select(F.concat(F.flatten(F.col("w.two")), end).alias("words"), "f")
        phrases = phrases.unionByName(more)
    return words, materialize(phrases, "phrase-counts"), totals


def _tail(words: Column | str, n) -> Column:
    return F.slice(words, F.lit(1) + n, F.size(words) - n)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    depth: int = DEPTH,
    top: int | None = TOP,
    subsumed: int = SUBSUMED,
) -> DataFrame:
    """Phrases of every language with their scores: lang, rank, phrase, a, l, r, n, score.

    ``a`` is the phrase's count, ``l`` and ``r`` are those of the two parts at the cut with the lowest score
    floor(1000 * a * n / (l * r)), ``n`` the words of the language; ties go to the first cut. A phrase within a
    longer one of at most ``depth`` words that has ``subsumed`` percent of its count is left out. Ranks go by score, count (both falling)
    and phrase in byte order, so they never tie; ``top`` of None lists all. Texts that are null or empty count nothing, and
    repeated rows count each time; a null language is NO_LANGUAGE. Very long texts are read whole and may make a
    shard longer. An empty table gives no rows. Other input columns are not used, whatever their names. Runs jobs when called.
    """
    words, phrases, totals = phrase_counts(docs, text, lang, min_count, depth)
    found = phrases.filter(F.size("words") >= MIN_LENGTH)
    # around a phrase, one word more is enough: longer ones are no more frequent
    around = found.filter(F.size("words") > MIN_LENGTH).select(
        F.explode(F.array(F.slice("words", F.lit(1), F.size("words") - 1), _tail("words", F.lit(1)))).alias("words"), F.col("f").alias("g")
    )
    around = around.groupBy("words").agg(F.max("g").alias("g"))
    kept = found.join(around, "words", "left").filter(F.col("g").isNull() | (F.col("g") * 100 < F.col("f") * subsumed))
    cuts = kept.select("words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("words", F.lit(1), F.col("k")), "right": _tail("words", F.col("k"))})
    counts = phrases.withColumnRenamed("words", "part")
    cuts = cuts.join(counts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.join(words.select("id", "lang"), F.col("words")[0] == F.col("id")).join(totals, "lang")
    # 128 bits hold both products; the quotient is at most 1000 * n
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    cuts = cuts.withColumns({"up": F.lit(1000).cast("decimal(4,0)") * wide("a") * F.col("n").cast("decimal(15,0)"), "down": wide("l") * wide("r")})
    score = F.expr("up div down")
    best = cuts.groupBy("words").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r", "lang", "n", "a")).alias("best")
    )
    names = best.select("words", F.posexplode("words").alias("i", "id")).join(words.select("id", "word"), "id")
    names = names.groupBy("words").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
    out = best.join(names.select("words", F.array_join(F.col("w.word"), " ").alias("phrase")), "words")
    out = out.select("best.lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is None:
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    else:
        out = top_n_per_key(out, ["lang"], order, top, "rank")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

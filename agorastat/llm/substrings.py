"""Removal of repeated byte strings by two-stage suffix sorting (operator 7).

A repeated string of ``LENGTH`` bytes holds the same smallest k-grams wherever it stands. Each
document therefore gives the k-grams that are smallest in one of its strings (anchors) with the bytes around them (contexts);
strings that repeat meet through equal anchors:

1. Contexts that are equal as a whole are settled by their hashes: all but the first are covered.
2. Of the anchors that still have different contexts, one copy of each context is
   suffix-sorted together with the others, and strings equal in ``LENGTH`` bytes are neighbours.
3. An anchor with very many different contexts sends the hashes of its strings instead, which are
   combined before the shuffle, so that no task holds them all.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.llm.common import materialize, utf8
from agorastat.operators.order_stats import running_counts

LENGTH = 100
KGRAM = 32
SEGMENT = 1 << 19  # bytes a task holds as numbers at a time
SORTED_BYTES = 1 << 19  # contexts a task sorts at a time
MANY_CONTEXTS = 20_000  # different contexts of an anchor that one task still sorts
HOT_ROWS = 1_000_000  # rows of an anchor, beyond the usual, that are no longer sent to one task
BUCKETS = 1 << 14
FILTER_BITS = 1 << 28  # the largest filter that is broadcast (32 MB)

_BASE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_OTHER = pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        powers = np.full(n, np.uint64(factor))
        powers[0] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


class _Rolling:
    """Hashes of any stretch of a buffer: a polynomial modulo 2^64 from running sums."""

    def __init__(self, buffer: np.ndarray, base: int):
        n = len(buffer)
        down, self.up = _powers(base, 1 << (n + 1).bit_length())
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * down[:n], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.up[begin]

    def every(self, size: int) -> np.ndarray:
        return (self.sums[size:] - self.sums[:-size]) * self.up[: len(self.sums) - size]


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` neighbours."""
    span = 1
    while span < width:
        step = min(span, width - span)
        values = pick(values[:-step], values[step:])
        span += step
    return values


class _Segments:
    """Stretches of several documents in one buffer, each with a margin that holds the contexts of its strings."""

    def __init__(self, parts: list[tuple[int, bytes, int, int, int]], length: int, kgram: int):
        """parts: document, text, begin and end of the stretch, number of strings that start in it."""
        self.length, self.kgram = length, kgram
        margin = length - kgram
        cuts = [(max(0, begin - margin), min(len(text), end + margin)) for _, text, begin, end, _ in parts]
        self.buffer = np.frombuffer(b"".join(text[a:b] for (_, text, *_), (a, b) in zip(parts, cuts)), np.uint8)
        sizes = np.array([b - a for a, b in cuts])
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.array([a for a, _ in cuts])  # offset in the document of the part's first byte
        self.doc = np.array([d for d, *_ in parts], np.int64)
        inner = np.array([begin - a for (_, _, begin, _, _), (a, _) in zip(parts, cuts)])
        count = np.array([n for *_, n in parts])
        self.part = np.repeat(np.arange(len(parts)), count)
        offsets = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.starts = (self.at[:-1] + inner)[self.part] + offsets
        self.rolling = _Rolling(self.buffer, _BASE)

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Anchor, context hash, document, begin and length of the context, place in the buffer."""
        width = self.length - self.kgram + 1
        grams = _mixed(self.rolling.every(self.kgram))
        least = _extreme(grams, width, np.minimum)  # of each string
        own = np.zeros(len(least) + 2 * (width - 1), np.uint64)  # 0 where no string of one document starts
        own[self.starts + width - 1] = least[self.starts]
        p = np.flatnonzero((_extreme(own, width, np.maximum) == grams) & (grams > 0))
        part = np.searchsorted(self.at, p, side="right") - 1
        low = np.maximum(p - (self.length - self.kgram), self.at[part])
        high = np.minimum(p + self.length, self.at[part + 1])
        shape = (p - low).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + (high - p).astype(np.uint64)
        context = _mixed(self.rolling.of(low, high) ^ _mixed(shape))
        return grams[p], context, self.doc[part], low - self.at[part] + self.first[part], high - low, low

    def strings(self, low: np.ndarray, size: np.ndarray, doc: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
        """Two hashes, document and begin of every string inside the contexts."""
        count = size - self.length + 1
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(low, count) + offset
        other = _Rolling(self.buffer, _OTHER)
        return _mixed(self.rolling.of(at, at + self.length)), _mixed(other.of(at, at + self.length)), np.repeat(doc, count), np.repeat(begin, count) + offset


def _segments(batch: pa.RecordBatch, length: int, kgram: int) -> Iterator[_Segments]:
    """The batch's texts of ``length`` bytes or more in buffers of about ``SEGMENT`` bytes; a longer text takes several."""
    held, size = [], 0
    for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
        strings = len(text) - length + 1
        for begin in range(0, max(0, strings), SEGMENT):
            n = min(SEGMENT, strings - begin)
            held.append((doc, text, begin, begin + n + length - 1, n))
            size += n + length
            if size >= SEGMENT:
                yield _Segments(held, length, kgram)
                held, size = [], 0
    if held:
        yield _Segments(held, length, kgram)
    pa.default_memory_pool().release_unused()


def _firsts(a: np.ndarray, c: np.ndarray, doc: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (a, c, doc, begin), where equal (a, c) begin in it, and which rows come after the first place."""
    order = np.lexsort([begin, doc, c, a])
    a, c, doc, begin = a[order], c[order], doc[order], begin[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])
    head = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    later = (doc != doc[head]) | (begin != begin[head])
    return order, new, later


_ROWS = "key long, a long, c long, doc long, place long"
COVER, CONTEXT, MANY = 0, 1, 2  # kinds of rows; MANY: a context, or string, of a frequent anchor


def _place(begin: np.ndarray, size: np.ndarray, kind: int | np.ndarray) -> np.ndarray:
    """Begin, length (below 2^12) and kind of a row in one number."""
    return (begin << 14) | (size << 2) | kind


def _arrow(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64) if c.dtype != np.uint64 else c.view(np.int64)) for c in columns], names=names.split())


def _hot_buckets(keyed: DataFrame, length: int, kgram: int, hot_rows: int) -> np.ndarray:
    """Which of 16384 hash buckets of anchors hold far more contexts than the others; one flag each."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for segments in _segments(batch, length, kgram):
                # one of each context in a buffer, as in the rows that follow
                a, c, *_ = segments.anchors()
                total += np.bincount((a[np.unique(a ^ c, return_index=True)[1]] >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield _arrow("bucket n", some, total[some])

    rows = keyed.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(BUCKETS, np.int64)
    n[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return n > hot_rows + 4 * int(n.sum()) // BUCKETS


def _once(a, c, doc, begin, size, kind, key) -> Iterator[pa.RecordBatch]:
    """The first of equal (a, c), and as covers those that come later in the same buffer."""
    order, new, later = _firsts(a, c, doc, begin)
    place = _place(begin, size, kind)
    first = order[new]
    yield _arrow("key a c doc place", key[first], a[first], c[first], doc[first], place[first])
    rest = order[later]
    spread = _mixed(doc[rest].view(np.uint64))
    yield _arrow("key a c doc place", spread, spread, np.zeros(len(rest), np.int64), doc[rest], _place(begin[rest], size[rest], COVER))


def _anchor_rows(keyed: DataFrame, hot: np.ndarray, length: int, kgram: int) -> DataFrame:
    """One row per context, once per buffer; what comes later in the same buffer is covered already.

    Equal anchors go to one task. Those of frequent anchors are spread by their context, which keeps equal
    contexts together, and count as having many.
    """

    def run(batches):
        for batch in batches:
            for segments in _segments(batch, length, kgram):
                a, c, doc, begin, size, _ = segments.anchors()
                often = hot[(a >> np.uint64(50)).astype(np.int64)]
                yield from _once(a, c, doc, begin, size, np.where(often, MANY, CONTEXT), np.where(often, _mixed(a ^ _mixed(c)), a))

    return keyed.mapInArrow(run, _ROWS)


def _whole_groups(batches, key: str, enough: int, weight) -> Iterator[pa.Table]:
    """Rows sorted by ``key`` as tables that end with a key; up to ``enough`` by ``weight``, if one key allows."""
    held: list[pa.RecordBatch] = []
    heavy = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        heavy += weight(batch)
        if heavy < enough:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        differ = np.flatnonzero(keys != keys[-1])
        if len(differ):
            cut = int(differ[-1]) + 1
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            heavy = sum(weight(b) for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _settle(rows: DataFrame, many: int) -> DataFrame:
    """Covers from equal contexts (kind 0), and the first of each context of anchors that have several
    (kind 1) or many (kind 2)."""

    def run(batches):
        for table in _whole_groups(batches, "key", 200_000, lambda b: b.num_rows):
            a, c, doc, place = (table.column(x).to_numpy() for x in ("a", "c", "doc", "place"))
            local = (place & 3) == COVER
            yield _arrow("kind a doc place", np.zeros(local.sum(), np.int64), a[local], doc[local], place[local])
            a, c, doc, place = (x[~local] for x in (a, c, doc, place))
            if not len(a):
                continue
            order, new, later = _firsts(a, c, doc, place >> 14)
            a, doc, place = a[order], doc[order], place[order]
            yield _arrow("kind a doc place", np.zeros(later.sum(), np.int64), a[later], doc[later], place[later])
            a, doc, place = a[new], doc[new], place[new]
            heads = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            sizes = np.diff(np.append(heads, len(a)))
            n = np.repeat(sizes, sizes)
            kind = np.where(((place & 3) == MANY) | (n > many), MANY, CONTEXT)
            several = (n > 1) | (kind == MANY)
            yield _arrow("kind a doc place", kind[several], a[several], doc[several], place[several])

    ordered = rows.repartition("key").sortWithinPartitions("key")
    return ordered.select("key", "a", "c", "doc", "place").mapInArrow(run, "kind long, a long, doc long, place long")


def _marks(kind: int, a: np.ndarray, doc: np.ndarray, begin: np.ndarray, bits: int) -> np.ndarray:
    key = doc.view(np.uint64) * np.uint64(3) + begin.view(np.uint64) * np.uint64(5) + np.uint64(kind)
    h = _mixed(a.view(np.uint64) ^ _mixed(key))
    return np.stack([(h ^ (h >> np.uint64(s)) * np.uint64(0x9FB21C651E98DF25)) & np.uint64(bits - 1) for s in (0, 17, 31)])


def _filter(open_contexts: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the contexts, built in the tasks and joined by words: ``bits`` / 8 bytes in all."""

    def mark(batches):
        table = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            kind, a, doc, place = (batch.column(x).to_numpy() for x in ("kind", "a", "doc", "place"))
            for k, own in ((CONTEXT, kind == CONTEXT), (MANY, kind == MANY), (MANY + 1, kind == MANY)):
                for m in _marks(k, a[own], doc[own], place[own] >> 14, bits):
                    np.bitwise_or.at(table, m >> np.uint64(6), np.uint64(1) << (m & np.uint64(63)))
        some = np.flatnonzero(table)
        yield _arrow("word value", some, table[some])

    parts = open_contexts.select("kind", "a", "doc", "place").mapInArrow(mark, "word long, value long")
    rows = parts.groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[rows.column("word").to_numpy()] = rows.column("value").to_numpy().view(np.uint64)
    return table


_CONTEXTS = "key long, a long, c long, doc long, place long, bytes binary"


def _context_rows(keyed: DataFrame, open_contexts: DataFrame, length: int, kgram: int, filter_bits: int) -> DataFrame:
    """The bytes of the contexts of anchors that have several, and the strings (as hashes) of those that have many.

    While a filter of the open contexts stays small it is broadcast and the texts stay where
    they are; beyond that the texts meet their contexts by document. The filter may let further
    contexts of the same documents pass, which changes no result.
    """
    n = open_contexts.count()
    bits = 1 << max(16, (16 * n).bit_length())
    if bits <= filter_bits:
        table = keyed.sparkSession.sparkContext.broadcast(_filter(open_contexts, bits))
        source = keyed.withColumn("_open", F.lit(None).cast("array<struct<kind:long,a:long,place:long>>"))
    else:
        table = None
        by_doc = open_contexts.groupBy("doc").agg(F.collect_list(F.struct("kind", "a", "place")).alias("_open"))
        source = keyed.join(by_doc, F.col("_doc") == F.col("doc")).select("_doc", "_text", "_open")

    def chosen(wanted: set | None, kind: int, a, doc, begin) -> np.ndarray:
        if wanted is not None:
            return np.array([(kind, x, d, s) in wanted for x, d, s in zip(a.view(np.int64).tolist(), doc.tolist(), begin.tolist())], bool)
        known = np.ones(len(a), bool)
        for k in (kind, MANY + 1) if kind == MANY else (kind,):  # a wrong MANY would cost a row per string: two tests
            for m in _marks(k, a, doc, begin, bits):
                known &= (table.value[m >> np.uint64(6)] >> (m & np.uint64(63))) & np.uint64(1) == 1
        return known

    def search(batches):
        for batch in batches:
            wanted = None
            if table is None:
                pairs = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
                wanted = {(o["kind"], o["a"], doc, o["place"] >> 14) for doc, listed in pairs for o in listed}
            for segments in _segments(batch, length, kgram):
                a, _, doc, begin, size, low = segments.anchors()
                at = np.flatnonzero(chosen(wanted, CONTEXT, a, doc, begin))
                raw = segments.buffer.tobytes()
                found = pa.array([raw[x : x + y] for x, y in zip(low[at].tolist(), size[at].tolist())], pa.binary())
                rows = _arrow("key a c doc place", a[at], a[at], a[at], doc[at], _place(begin[at], size[at], CONTEXT))
                yield pa.RecordBatch.from_arrays([*rows.columns, found], names=[*rows.schema.names, "bytes"])
                at = np.flatnonzero(chosen(wanted, MANY, a, doc, begin))
                if len(at):
                    wa, wc, wdoc, wbegin = segments.strings(low[at], size[at], doc[at], begin[at])
                    for rows in _once(wa, wc, wdoc, wbegin, np.full(len(wa), length), MANY, wa):
                        yield pa.RecordBatch.from_arrays([*rows.columns, pa.nulls(rows.num_rows, pa.binary())], names=[*rows.schema.names, "bytes"])

    return source.mapInArrow(search, _CONTEXTS)


def suffix_order(text: np.ndarray, real: np.ndarray, depth: int) -> np.ndarray:
    """The ``real`` positions of ``text`` by their suffixes, right to ``depth`` bytes.

    Stretches of real positions are each followed by ``depth`` zeros. Stage one sorts only
    the suffixes that are smaller than their successors. Stage two scans the buckets of
    first bytes in order: a suffix that is larger than its successor follows, within its bucket, the order
    of the successors, which stand in buckets scanned before or earlier in its own.
    """
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    next_change = np.searchsorted(change, np.arange(n - 1))
    rising = np.zeros(n, bool)
    inside = next_change < len(change)
    at = change[next_change[inside]]
    rising[np.flatnonzero(inside)] = text[at] < text[at + 1]
    rising[:-1][~inside] = True
    ends = np.concatenate([real[:-1] & ~real[1:], [False]])
    sentinels = np.flatnonzero(ends) + 1
    larger = real & ~rising
    rows = np.lib.stride_tricks.sliding_window_view(text, depth)
    direct = np.concatenate([sentinels, np.flatnonzero(real & rising)])
    keys = np.ascontiguousarray(rows[direct]).view(f"S{depth}").reshape(-1)
    direct = direct[np.argsort(keys, kind="stable")]
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order: list[np.ndarray] = []

    def induce(scanned: np.ndarray) -> None:
        before = scanned[scanned > 0] - 1
        before = before[larger[before]]
        if not len(before):
            return
        first = text[before]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        edges = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(first)]):
            waiting[first[i]].append(before[i:j])

    for byte in range(256):
        while waiting[byte]:  # a run of one byte grows backwards by a suffix each time
            scanned = np.concatenate(waiting[byte])
            waiting[byte] = []
            order.append(scanned)
            induce(scanned)
        scanned = direct[cuts[byte] : cuts[byte + 1]]
        order.append(scanned)
        induce(scanned)
    order = np.concatenate(order)
    return order[real[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to ``depth``, that each suffix of the order shares with the one before it."""
    rows = np.lib.stride_tricks.sliding_window_view(text, depth)
    out = np.zeros(len(order), np.int64)
    step = max(1, (8 << 20) // depth)
    for i in range(1, len(order), step):
        here, there = rows[order[i : i + step]], rows[order[i - 1 : i - 1 + len(order[i : i + step])]]
        differ = here != there
        out[i : i + step] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return out


def _repeated_ranges(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, begin and end of what repeats among the contexts, by suffix order."""
    parts = table.column("bytes").to_pylist()
    size = np.array([len(p) for p in parts])
    at = np.cumsum(size + length) - size - length
    text = np.frombuffer(b"".join(p + bytes(length) for p in parts) + bytes(length), np.uint8)
    real = np.zeros(len(text), bool)
    context = np.full(len(text), -1)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(at, size)
    real[inner] = True
    context[inner] = np.repeat(np.arange(len(parts)), size)
    order = suffix_order(text, real, length)
    of = context[order]
    offset = order - at[of]
    whole = offset + length <= size[of]
    order, of, offset = order[whole], of[whole], offset[whole]
    group = np.cumsum(common_prefixes(text, order, length) < length)
    doc, begin = table.column("doc").to_numpy()[of], (table.column("place").to_numpy() >> 14)[of] + offset
    by = np.lexsort([begin, doc, group])
    group, doc, begin, of = group[by], doc[by], begin[by], of[by]
    head = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), np.arange(len(group)), 0))
    later = (doc != doc[head]) | (begin != begin[head])
    doc, begin, of = doc[later], begin[later], of[later]
    by = np.lexsort([begin, of])
    doc, begin, of = doc[by], begin[by], of[by]
    if not len(doc):
        return doc, begin, begin
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (begin[1:] > begin[:-1] + length)])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)
    return doc[new], begin[new], begin[last] + length


def _last_covers(rows: DataFrame, length: int) -> DataFrame:
    """Ranges from sorting the contexts of each anchor, and from equal strings of anchors with many."""

    def run(batches):
        for table in _whole_groups(batches, "key", SORTED_BYTES, lambda b: 20 * b.num_rows + b.column("bytes").nbytes):
            kind = table.column("place").to_numpy() & 3
            strings = table.filter(pa.array(kind != CONTEXT))
            if strings.num_rows:
                a, c, doc, place = (strings.column(x).to_numpy() for x in ("a", "c", "doc", "place"))
                local = (place & 3) == COVER
                order, _, later = _firsts(a[~local], c[~local], doc[~local], place[~local] >> 14)
                doc = np.concatenate([doc[local], doc[~local][order][later]])
                place = np.concatenate([place[local], place[~local][order][later]])
                yield _arrow("doc s e", doc, place >> 14, (place >> 14) + ((place >> 2) & 0xFFF))
            table = table.filter(pa.array(kind == CONTEXT))
            a = table.column("a").to_numpy()
            same = a[1:] == a[:-1]
            several = np.zeros(len(a), bool)
            several[1:] |= same
            several[:-1] |= same
            table = table.filter(pa.array(several))
            if table.num_rows:
                yield _arrow("doc s e", *_repeated_ranges(table, length))

    ordered = rows.repartition("key").sortWithinPartitions("key")
    return ordered.select("key", "a", "c", "doc", "place", "bytes").mapInArrow(run, "doc long, s long, e long")


def repeated_ranges(
    keyed: DataFrame,
    length: int = LENGTH,
    kgram: int = KGRAM,
    many: int = MANY_CONTEXTS,
    hot_rows: int = HOT_ROWS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``(doc, s, e)``: byte ranges of ``keyed(_doc, _text)`` that ``length``-byte strings cover which also start
    earlier (smaller _doc, or the same and an earlier byte). Ranges may overlap."""
    hot = _hot_buckets(keyed, length, kgram, hot_rows)
    settled = materialize(_settle(_anchor_rows(keyed, hot, length, kgram), many), "settled")
    place = F.col("place")
    covers = settled.filter("kind = 0").select(
        "doc", F.shiftright(place, 14).alias("s"), (F.shiftright(place, 14) + F.shiftright(place, 2).bitwiseAND(F.lit(0xFFF))).alias("e")
    )
    rows = _context_rows(keyed, settled.filter("kind > 0"), length, kgram, filter_bits)
    return covers.unionByName(_last_covers(rows, length))


def _union(ranges: Iterable[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        e = min(e, size)
        if s >= e:
            continue
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, _doc, _text``: each distinct pair of id and text is a document of its own, and ``_doc`` orders them by id.

    Where no id occurs twice it is the id itself, and no text moves. Otherwise the pairs are numbered in ranges
    by id and hash of the text.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select("doc_id", key.alias("_doc"), F.coalesce("text", F.lit("")).alias("_text"))
    if rows.groupBy("_doc").count().filter("count > 1").isEmpty():
        return rows
    paired = rows.withColumn("_pair", F.struct("_doc", F.sha2("_text", 256).alias("sha"))).drop("_doc")
    places = running_counts(paired.select("_pair"), "_pair").select("_pair", F.col("ValuesBefore").alias("_doc"))
    return materialize(paired.join(places, "_pair").select("doc_id", "_doc", "_text"), "numbered")


def remove_repeats(docs: DataFrame, length: int = LENGTH, kgram: int = KGRAM, keep_bytes: bool = False, **limits) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and with ``keep_bytes`` the bytes that stay.

    Texts count as UTF-8 bytes, null as empty; a null doc_id comes before all others. Repeated rows are one
    document and keep equal results; different texts under one doc_id are documents of their own, in the order of
    their hashes. Texts are shuffled once, by document, and once more where an id repeats.
    """
    numbered = _numbered(docs)
    keyed = numbered.select("_doc", "_text")
    ranges = repeated_ranges(keyed, length, kgram, **limits).groupBy("doc").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    joined = numbered.join(ranges, F.col("_doc") == F.col("doc"), "left")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes

    def run(batches):
        for batch in batches:
            out = []
            ranges = batch.column(2)
            places = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ranges), 0).to_numpy(zero_copy_only=False))])
            low, high = (x.to_numpy(zero_copy_only=False) for x in ranges.flatten().flatten())
            for n, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), utf8(batch.column(1)))):
                own = slice(places[n], places[n + 1])
                gone = _union(zip(low[own].tolist(), high[own].tolist()), len(text))
                kept, at = [], 0
                for s, e in gone:
                    kept.append(text[at:s])
                    at = e
                rest = b"".join(kept) + text[at:]
                out.append((doc, len(text), len(text) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), rest)[: len(names)])
            columns = [list(c) for c in zip(*out)] if out else [[]] * len(names)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return joined.select("doc_id", "_text", "ranges").mapInArrow(run, schema)

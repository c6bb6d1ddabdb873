"""Duplicate and similar texts by exact Jaccard similarity, and vector similarity.

Two token sets with similarity ``t`` or more must share one of their first few
tokens in any common order (prefix filter). Ordering from rare to frequent makes these
shared tokens selective: a qualifying pair shares ``n`` tokens within a prefix that is
``n - 1`` longer. Sets meet in blocks of similar size, and a task compares one pair of blocks: it
counts the shared tokens of prefixes in memory, so that pairs which fail are never
written. The result is exact: every step only leaves out pairs that cannot reach the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, MinHashLSH, SQLTransformer, Word2VecModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorastat.functions.text import char_ngrams
from agorastat.functions.vectors import cosine
from agorastat.operators.features import word_vectors
from agorastat.operators.joins import lookup_join
from agorastat.operators.order_stats import running_counts
from agorastat.sources.storage import materialize

CHUNK_TOKENS = 2_000_000  # tokens with a dictionary of their own
UNPACKED = 1_000_000  # bytes of tokens that are unpacked at a time
KEY_ROWS = 200_000  # sets of a block at most
KEY_TOKENS = 3  # prefix tokens that similar sets share at least
BLOCK_TOKENS, LEAST_TOKENS, BLOCKS = 48_000_000, 200_000, 8  # of a block at most, at least, and blocks to aim at
CHUNK_ROWS, BATCH_CELLS, PAIR_TOKENS = 8_192, 4_000_000, 4_000_000  # compared at a time in a task
BIT_ROWS, BITS_A_TOKEN, SCAN_BITS_A_TOKEN = 512, 6, 2  # of the bit maps
DENSE_TOKENS = 16_384  # distinct tokens of two chunks up to which a bit stands for one token
SCAN_PAIRS = 0.1  # shared prefix tokens a pair beyond which bit maps of all pairs cost less than counting
ROUNDING = 1e-9


def token_sets(df: DataFrame, tokens: str, key: str = "Id") -> DataFrame:
    """``(Id, Tokens)``: sorted distinct 64-bit token numbers.

    Empty sets stay: a filter here would be pushed below the projection and run the
    whole tokenisation a second time. They have no key and so no candidate.
    """
    numbers = F.sort_array(F.array_distinct(F.transform(tokens, lambda t: F.xxhash64(t))))
    return df.select(F.col(key).alias("Id"), numbers.alias("Tokens"))


def _with_digest(sets: DataFrame) -> DataFrame:
    return sets.withColumns(
        {"_h1": F.xxhash64("Tokens"), "_h2": F.xxhash64(F.lit("second"), F.col("Tokens"))}
    )


def _coded(rows: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Some sets in one row: their distinct tokens with counts, and the place of each token among these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("Tokens")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < len(ends):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_TOKENS, "right")))
                some = batch.slice(start, stop - start)
                coded = pc.dictionary_encode(some.column("Tokens").flatten())
                codes = coded.indices.to_numpy(zero_copy_only=False)
                held = pa.StructArray.from_arrays([some.column(c) for c in rows], fields=[some.schema.field(c) for c in rows])
                counts = pa.array(np.bincount(codes, minlength=len(coded.dictionary)), pa.int64())
                columns = {"Words": coded.dictionary, "Counts": counts, "Codes": _packed(codes.astype(np.int64), np.diff(ends[start:stop], prepend=before)), "Rows": held}
                lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns.values()]
                yield pa.RecordBatch.from_arrays([pa.array([made]), *lists], names=["Chunk", *columns])
                made, start = made + 1, stop

    return run


def _packed(tokens: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Sets of numbers as bytes, in order: each number less the one before it, seven bits a byte, the last byte below 128."""
    tokens = tokens[np.lexsort((tokens, np.repeat(np.arange(len(lengths)), lengths)))]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    steps = np.diff(tokens, prepend=0)
    first = starts[:-1][lengths > 0]
    steps[first] = tokens[first]
    sizes = np.ones(len(steps), np.int64)
    for bits in range(7, 63, 7):
        sizes += steps >= 1 << bits
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(ends[-1], np.uint8)
    for k in range(int(sizes.max(initial=0))):
        longer = np.flatnonzero(sizes > k)
        out[ends[longer] + k] = (steps[longer] >> 7 * k) & 127 | np.where(sizes[longer] > k + 1, 128, 0)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends[starts].astype(np.int32)), pa.py_buffer(out)])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all sets, in 32 bits where they fit, and where those of each set begin and the last ones end."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if ends[-1] else np.zeros(0, np.uint8)
    parts, places, row, done = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0, 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + UNPACKED, "right")) - 1)
        some = data[ends[row] : ends[stop]]
        last = np.flatnonzero(some < 128)
        first = np.concatenate([[0], last[:-1] + 1])[: len(last)]
        steps = (some[first] & 127).astype(np.int64)
        for k in range(1, int((last - first).max(initial=0)) + 1):
            longer = np.flatnonzero(last - first >= k)
            steps[longer] |= (some[first[longer] + k] & 127).astype(np.int64) << 7 * k
        at = np.searchsorted(last, ends[row : stop + 1] - ends[row])
        total = np.concatenate([[0], np.cumsum(steps)])
        tokens = total[1:] - np.repeat(total[at[:-1]], np.diff(at))
        parts.append(tokens.astype(np.int32) if tokens.max(initial=0) < 1 << 31 else tokens)
        places.append(done + at[1:])
        done, row = done + len(tokens), stop
    return np.concatenate(parts), np.concatenate(places)


def _placed(rows: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sets of each chunk with the numbers of their tokens, in order and packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                codes, ends = _unpacked(batch.column("Codes").slice(row, 1).flatten())
                lengths = np.diff(ends)
                place, given = (c.to_numpy(zero_copy_only=False) for c in batch.column("Known").slice(row, 1).flatten().flatten())
                number = np.zeros(len(place), np.int64)
                number[place] = given
                held = batch.column("Rows").slice(row, 1).flatten().flatten()
                yield pa.RecordBatch.from_arrays([*held, pa.array(lengths, pa.int32()), _packed(number[codes], lengths)], names=[*rows, "Size", "Tokens"])

    return run


def _numbered(sets: DataFrame) -> DataFrame:
    """The sets with ``Size``, and with each token as its place among all tokens from rare to frequent, in order and packed.

    Tokens are made once, and only the distinct ones of a chunk of sets are joined with their numbers, which take a
    fraction of the room of hashes and name tokens as exactly. No tokens are an empty set.
    """
    rows = [c for c in sets.columns if c != "Tokens"]
    kinds = dict(sets.dtypes)
    held = ", ".join(f"{c}: {kinds[c]}" for c in rows)
    lists = f"Words array<bigint>, Counts array<bigint>, Codes array<binary>, Rows array<struct<{held}>>"
    chunks = materialize(sets.mapInArrow(_coded(rows), f"Chunk bigint, {lists}"), "token-chunks")
    each = chunks.select(F.explode(F.arrays_zip("Words", "Counts")).alias("c"))
    counts = each.groupBy(F.col("c.Words").alias("Word")).agg(F.sum("c.Counts").alias("n")).select(F.struct("n", "Word").alias("w"))
    numbers = materialize(running_counts(counts, "w").select("w.Word", F.col("ValuesBefore").cast("bigint").alias("Number")), "token-numbers")
    met = chunks.select("Chunk", F.posexplode("Words").alias("i", "Word")).join(numbers, "Word")
    known = met.groupBy("Chunk").agg(F.collect_list(F.struct("i", "Number")).alias("Known"))
    joined = chunks.select("Chunk", "Codes", "Rows").join(known, "Chunk", "left")
    none = F.array().cast("array<struct<i: int, Number: bigint>>")
    kept = "".join(f"{c} {kinds[c]}, " for c in rows)
    return joined.select("Codes", "Rows", F.coalesce("Known", none).alias("Known")).mapInArrow(_placed(rows), f"{kept}Size int, Tokens binary")


@dataclass(frozen=True)
class _Chunk:
    """Some sets of a block, about equal in size: their places in the block, sizes and where each one's tokens lie."""

    places: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray
    tokens: np.ndarray

    def read(self) -> _Chunk:
        return self

    def listed(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The first ``lengths`` tokens of the rows, one after the other."""
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - ends + lengths, lengths)
        return self.tokens[places]

    def bits(self, width: int, known: np.ndarray | None = None) -> np.ndarray:
        """Per set a map of ``width`` bits, as 64-bit words: those that the tokens' last bits name are 1, or their places in ``known``."""
        out = []
        for row in range(0, len(self.places), BIT_ROWS):
            rows = np.arange(row, min(row + BIT_ROWS, len(self.places)))
            tokens = self.listed(rows, self.sizes[rows])
            cells = np.zeros((len(rows), width), np.uint8)
            cells[np.repeat(rows - row, self.sizes[rows]), tokens & (width - 1) if known is None else np.searchsorted(known, tokens)] = 1
            out.append(np.packbits(cells, axis=1).view(np.uint64))
        return np.concatenate(out)

    def distinct(self) -> np.ndarray:
        """The distinct tokens, in order."""
        return np.sort(pc.unique(pa.array(self.listed(np.arange(len(self.places)), self.sizes))).to_numpy())


@dataclass(frozen=True)
class _Packed:
    """The sets of a chunk as they were sent; they are unpacked when the chunk is compared."""

    places: np.ndarray
    sizes: np.ndarray
    column: pa.Array

    def read(self) -> _Chunk:
        tokens, offsets = _unpacked(self.column.take(pa.array(self.places)))
        return _Chunk(self.places, self.sizes, offsets[:-1], tokens)


def _chunks(block: pa.Table) -> list[_Chunk | _Packed]:
    """The block by rising size, ``CHUNK_ROWS`` at a time."""
    lists = block.column("Tokens").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    packed = pa.types.is_binary(lists.type)
    offsets = None if packed else lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    sizes = block.column("Size").to_numpy().astype(np.int64) if packed else np.diff(offsets)
    tokens = None if packed else lists.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(sizes, kind="stable")
    cut = (order[i : i + CHUNK_ROWS] for i in range(0, len(order), CHUNK_ROWS))
    return [_Packed(o, sizes[o], lists) if packed else _Chunk(o, sizes[o], offsets[:-1][o], tokens) for o in cut]


def _short(a: _Chunk, b: _Chunk) -> tuple[_Chunk, _Chunk]:
    """Both with tokens of 32 bits: where these number less than all tokens, those of the two chunks get numbers of their own."""
    if max(c.tokens.dtype.itemsize for c in (a, b)) <= 4:
        return a, b
    codes = np.unique(np.concatenate([a.tokens, b.tokens]), return_inverse=True)[1].astype(np.int32)
    one = replace(a, tokens=codes[: len(a.tokens)])
    return one, one if a is b else replace(b, tokens=codes[len(a.tokens) :])


def _prefix(sizes: np.ndarray, least: int, threshold: float, extra: int) -> np.ndarray:
    """Length of each set's prefix that holds ``extra`` tokens shared with any similar set of ``least`` tokens or more."""
    partner = np.maximum(sizes * threshold, least)
    overlap = np.maximum(np.ceil((sizes + partner) * (threshold / (1 + threshold)) - ROUNDING), 1)
    return np.clip(sizes - overlap.astype(np.int64) + extra, 0, sizes)


def _scanned(a: _Chunk, b: _Chunk, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs that small bit maps allow, trying every pair of similar size: each bit that differs is a token
    that only one of the two has."""
    share = threshold / (1 + threshold)
    width = _width(a, b, SCAN_BITS_A_TOKEN)
    ours, theirs = np.ascontiguousarray(a.bits(width).T), b.bits(width)
    low = np.searchsorted(a.sizes, np.ceil(b.sizes * threshold - ROUNDING))
    high = np.searchsorted(a.sizes, np.floor(b.sizes / threshold + ROUNDING), side="right")
    most = a.sizes * (1 - 2 * share)  # differing tokens that a similar pair may have, less the other set's part
    total, words, counts = (np.empty(len(a.places), kind) for kind in (np.uint16, np.uint64, np.uint8))
    xs, ys, held = [], [], 0
    for row, (i, j) in enumerate(zip(low.tolist(), high.tolist())):
        if i == j:
            continue
        apart, differ, count = total[i:j], words[i:j], counts[i:j]
        apart[:] = 0
        for word, other in zip(ours, theirs[row]):
            np.bitwise_count(np.bitwise_xor(word[i:j], other, out=differ), out=count)
            apart += count
        found = i + np.flatnonzero(apart <= most[i:j] + (b.sizes[row] * (1 - 2 * share) + 2 * ROUNDING))
        xs.append(found)
        ys.append(np.full(len(found), row))
        held += len(found)
        if held > BATCH_CELLS:
            yield np.concatenate(xs), np.concatenate(ys)
            xs, ys, held = [], [], 0
    if xs:
        yield np.concatenate(xs), np.concatenate(ys)


def _width(a: _Chunk, b: _Chunk, bits: int) -> int:
    """A power of two of at least ``bits`` a token for most sets, within bounds."""
    return 1 << int(np.clip(np.ceil(np.log2(bits * min(a.sizes[-1], b.sizes[-1]))), 7, 15))


def _met(a: _Chunk, b: _Chunk, threshold: float, extra: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs whose overlap can suffice, by the shared tokens of their prefixes, or by bit maps where most pairs share some."""
    share = threshold / (1 + threshold)
    ends = [_prefix(x.sizes, y.sizes[0], threshold, extra) for x, y in ((a, b), (b, a))]
    prefix = a.listed(np.arange(len(a.places)), ends[0])
    known, place = np.unique(prefix, return_inverse=True)
    holders = np.repeat(np.arange(len(a.places)), ends[0])[np.argsort(place, kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(known)))]).astype(np.int64)
    behind = [x.sizes - e for x, e in zip((a, b), ends)]
    width = len(a.places)
    if not len(known):
        return
    asked = b.listed(np.arange(len(b.places)), ends[1])
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hits = np.where(known[at] == asked, first[at + 1] - first[at], 0)
    if hits.sum() > SCAN_PAIRS * len(a.places) * len(b.places):
        yield from _scanned(a, b, threshold)
        return
    row_ends = np.cumsum(ends[1])
    # a batch ends where its cells or its list of holders gets long
    total = np.concatenate([[0], np.cumsum(hits)])
    done = np.concatenate([[0], row_ends])
    row = 0
    while row < len(b.places):
        last = int(np.searchsorted(total[done[1:]], total[done[row]] + BATCH_CELLS, side="right"))
        last = min(max(last, row + 1), row + max(1, BATCH_CELLS // width), len(b.places))
        part = slice(done[row], done[last])
        n = hits[part]
        stop = np.cumsum(n)
        if len(n) and stop[-1]:
            which = holders[np.arange(stop[-1]) + np.repeat(first[at[part]] - stop + n, n)]
            rows = np.repeat(np.repeat(np.arange(last - row), ends[1][row:last]), n)
            counts = np.bincount(rows * width + which, minlength=(last - row) * width)
            overlap = max(1, int(np.ceil((a.sizes[0] + b.sizes[row]) * share - ROUNDING)))
            low = max(min(extra, overlap), overlap - max(behind[0].max(), behind[1][row:last].max()))
            cells = np.flatnonzero(counts >= low)
            x, y = cells % width, cells // width + row
            sx, sy = a.sizes[x], b.sizes[y]
            need = np.ceil((sx + sy) * share - ROUNDING) - np.maximum(behind[0][x], behind[1][y])
            close = (counts[cells] >= need) & (np.minimum(sx, sy) >= np.maximum(sx, sy) * threshold - ROUNDING)
            yield x[close], y[close]
        row = last


def _alike(a: _Chunk, b: _Chunk, ours: np.ndarray, theirs: np.ndarray, x: np.ndarray, y: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that their bit maps allow: each bit that differs is a token that only one of the two has."""
    kept = []
    step = max(1, BATCH_CELLS // ours.shape[1])
    for i in range(0, len(x), step):
        xs, ys = x[i : i + step], y[i : i + step]
        apart = np.bitwise_count(ours[xs] ^ theirs[ys]).sum(axis=1, dtype=np.int64)
        size = a.sizes[xs] + b.sizes[ys]
        kept.append(i + np.flatnonzero((size - apart) / 2 >= size * share - ROUNDING))
    at = np.concatenate(kept) if kept else np.zeros(0, np.int64)
    return x[at], y[at]


def _shared(a: _Chunk, b: _Chunk, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the tokens of ``a``'s rows are among those of ``b``'s."""
    pair = np.arange(len(x), dtype=np.int64) << 32
    keys = np.sort(np.repeat(pair, b.sizes[y]) + b.listed(y, b.sizes[y]))
    own = np.repeat(pair, a.sizes[x]) + a.listed(x, a.sizes[x])
    found = keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] == own
    return np.add.reduceat(found.astype(np.int64), np.concatenate([[0], np.cumsum(a.sizes[x])[:-1]]))


def _dense(a: _Chunk, b: _Chunk) -> tuple[np.ndarray, np.ndarray] | None:
    """Bit maps of both with a bit for each distinct token, where these are few."""
    known = [c.distinct() for c in ((a,) if a is b else (a, b))]
    if max(map(len, known)) > DENSE_TOKENS:
        return None
    known = np.union1d(*known) if len(known) > 1 else known[0]
    if len(known) > DENSE_TOKENS:
        return None
    width = -(-len(known) // 64) * 64
    ours = a.bits(width, known)
    return ours, ours if a is b else b.bits(width, known)


def _shared_bits(ours: np.ndarray, theirs: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the tokens of ``ours``'s rows are among those of ``theirs``."""
    step = max(1, BATCH_CELLS // 8 // ours.shape[1])
    parts = [np.bitwise_count(ours[x[i : i + step]] & theirs[y[i : i + step]]).sum(axis=1, dtype=np.int64) for i in range(0, len(x), step)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _near(threshold: float, extra: int, same_side: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For two blocks: the similar pairs, with their similarity."""
    share = threshold / (1 + threshold)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        alone = same_side and not len(right)  # a block with itself, or one whose partner is empty
        if alone and len(left) and "Itself" in left.column_names:
            alone = left.column("Itself")[0].as_py()
        ours = _chunks(left)
        theirs = ours if alone else _chunks(right)

        def found(a: _Chunk, b: _Chunk, x: np.ndarray, y: np.ndarray, shared: np.ndarray) -> None:
            similarity = shared / (a.sizes[x] + b.sizes[y] - shared)
            enough = similarity >= threshold - ROUNDING
            for column, values in zip(out, (a.places[x], b.places[y], similarity)):
                column.append(values[enough])

        for i, one in enumerate(ours):
            own = None
            for j, other in enumerate(theirs):
                if alone and j < i or one.sizes[-1] < other.sizes[0] * threshold - ROUNDING or other.sizes[-1] < one.sizes[0] * threshold - ROUNDING:
                    continue
                own = own or one.read()
                a, b = _short(own, own if alone and i == j else other.read())
                width, maps, dense, tried = _width(a, b, BITS_A_TOKEN), None, None, 0
                for x, y in _met(a, b, threshold, extra):
                    if a is b:
                        x, y = x[x < y], y[x < y]
                    tried += len(x)
                    if dense is None and tried > len(a.places) + len(b.places):  # so many pairs are worth exact bit maps
                        dense = _dense(a, b) or ()
                    if dense:
                        found(a, b, x, y, _shared_bits(*dense, x, y))
                        continue
                    maps = maps or (a.bits(width), b.bits(width))
                    x, y = _alike(a, b, *maps, x, y, share)
                    steps = np.searchsorted(np.cumsum(a.sizes[x] + b.sizes[y]), np.arange(PAIR_TOKENS, (a.sizes[x] + b.sizes[y]).sum(), PAIR_TOKENS))
                    for xs, ys in zip(np.split(x, steps), np.split(y, steps)):
                        if len(xs):
                            found(a, b, xs, ys, _shared(a, b, xs, ys))
        one, two = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out[:2])
        ids = left.column("Id").take(pa.array(one)), (left if alone else right).column("Id").take(pa.array(two))
        return pa.table([*ids, pa.array(np.concatenate([np.zeros(0), *out[2]]))], names=["IdA", "IdB", "Similarity"])

    return compare


def _blocks(sets: DataFrame, threshold: float, key_rows: int) -> DataFrame:
    """``(Side, Class, Blocks)``: sets whose sizes are a factor of ``1 / threshold`` apart at most, and into how many blocks they go.

    Similar sets are of one class or of neighbouring ones. One row per class, so at most a few hundred.
    """
    sizes = sets.groupBy("Side", "Class").agg(F.count(F.lit(1)).alias("n"), F.sum("Size").alias("tokens"))
    aim = F.least(F.lit(BLOCK_TOKENS), F.greatest(F.sum("tokens").over(W.partitionBy()) / BLOCKS, F.lit(LEAST_TOKENS)))
    return sizes.select("Side", "Class", F.ceil(F.greatest(F.col("n") / key_rows, F.col("tokens") / aim)).cast("int").alias("Blocks"))


def _candidates(ordered: DataFrame, threshold: float, two_sided: bool, key_rows: int, key_tokens: int) -> DataFrame:
    """``(IdA, IdB, Similarity)`` of all similar pairs: blocks of neighbouring sizes meet pair by pair, each in one task.

    A set is sent once to each block it meets; pairs are found, tried and scored there, so what is written grows with
    the sets and the pairs found and not with the pairs tried, and no token is joined to a pair. Ids can repeat.
    """
    base = max(1 / threshold, 1.05)
    # the rounding keeps sizes that are exactly a factor apart in neighbouring classes
    ranked = ordered.filter("Size > 0").withColumn("Class", F.floor(F.ln("Size") / math.log(base) + 1e-6).cast("int"))
    blocks = materialize(_blocks(ranked, threshold, key_rows), "blocks")
    numbered = blocks.select("Side", "Class", F.explode(F.sequence(F.lit(0), F.col("Blocks") - 1)).alias("Block"))
    a = numbered.select(*[F.col(c).alias(f"{c}A") for c in numbered.columns])
    b = numbered.select(*[F.col(c).alias(f"{c}B") for c in numbered.columns])
    if two_sided:
        meet = (F.col("SideA") == 0) & (F.col("SideB") == 1) & (F.abs(F.col("ClassA") - F.col("ClassB")) <= 1)
    else:
        step = F.col("ClassB") - F.col("ClassA")
        meet = (step == 1) | ((step == 0) & (F.col("BlockA") <= F.col("BlockB")))
    cells = a.join(b, meet)
    cells = materialize(cells.withColumn("Cell", F.xxhash64(*cells.columns)), "cells")
    placed = ranked.join(F.broadcast(blocks), ["Side", "Class"]).select(
        "Side", "Class", F.pmod(F.xxhash64("Id"), "Blocks").cast("int").alias("Block"), "Id", "Size", "Tokens"
    )

    itself = F.lit(False) if two_sided else (F.col("ClassA") == F.col("ClassB")) & (F.col("BlockA") == F.col("BlockB"))

    def side(suffix: str, where: Column) -> DataFrame:
        own = cells.filter(where).select("Cell", *[F.col(f"{c}{suffix}").alias(c) for c in numbered.columns], itself.alias("Itself"))
        return placed.join(F.broadcast(own), numbered.columns).select("Cell", "Itself", "Id", "Size", "Tokens").toDF("Cell", "Itself", "Id", "Size", "Tokens")

    left, right = side("A", F.lit(True)).groupBy("Cell"), side("B", ~itself).groupBy("Cell")
    near = _near(threshold, key_tokens, not two_sided)
    kind = dict(ordered.dtypes)["Id"]
    found = left.cogroup(right).applyInArrow(near, f"IdA {kind}, IdB {kind}, Similarity double")
    if not two_sided:
        found = found.filter("IdA <> IdB").select(F.least("IdA", "IdB").alias("IdA"), F.greatest("IdA", "IdB").alias("IdB"), "Similarity")
    return found


def _similar(
    sets: DataFrame, threshold: float, two_sided: bool, key_rows: int, key_tokens: int
) -> DataFrame:
    """``(IdA, IdB, Similarity)`` of all sets with at least the threshold.

    ``sets`` has ``(Side, Id, Size, Tokens)``, with tokens as ``_numbered`` gives them. Two-sided: side 0 with side 1; else each pair once, IdA < IdB.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    ordered = materialize(sets, "sets")
    return materialize(_candidates(ordered, threshold, two_sided, key_rows, key_tokens), "candidates")


def similar_pairs(
    df: DataFrame,
    tokens: str = "ProcessedText",
    threshold: float = 0.85,
    key: str = "Id",
    key_rows: int = KEY_ROWS,
    key_tokens: int = KEY_TOKENS,
) -> DataFrame:
    """A-43, J-06: duplicate pairs ``(IdA, IdB, Similarity)`` with IdA < IdB.

    Rows with the same token set form one group: each further row is paired with the
    least id of its group (similarity 1), and only that row is compared to others. All
    pairs follow from these rows, while a group of ``n`` copies costs ``n - 1`` rows.
    """
    sets = _with_digest(_numbered(token_sets(df, tokens, key)))
    digest = ["_h1", "_h2"]
    # One reader for the groups and one for the members.
    sets = materialize(sets, "token-sets").filter(F.col("Size") > 0)
    groups = sets.groupBy("Tokens", "Size", *digest).agg(F.min("Id").alias("Id"))
    distinct_sets = groups.select(F.lit(0).alias("Side"), "Id", "Size", "Tokens")
    members = lookup_join(
        sets.select("Id", *digest), groups.select(*digest, F.col("Id").alias("_least")), digest, salt_by=["Id"]
    )
    copies = members.filter(F.col("Id") != F.col("_least")).select(
        F.col("_least").alias("IdA"), F.col("Id").alias("IdB"), F.lit(1.0).alias("Similarity")
    )
    return copies.unionByName(_similar(distinct_sets, threshold, False, key_rows, key_tokens))


def near_duplicates(
    df: DataFrame, text: str = "Title", threshold: float = 0.9, key: str = "Id", n: int = 3, **options
) -> DataFrame:
    """A-45: near-duplicate texts by their character n-grams, with both texts."""
    grams = df.select(key, char_ngrams(text, n).alias("_grams"))
    pairs = similar_pairs(grams, "_grams", threshold, key, **options)
    texts = df.select(key, text)
    first = texts.toDF("IdA", "Text1")
    second = texts.toDF("IdB", "Text2")
    pairs = materialize(pairs, "pairs")
    named = lookup_join(pairs, first, ["IdA"], salt_by=["IdB"])
    named = lookup_join(named, second, ["IdB"], salt_by=["IdA"], count_in=pairs)
    return named.select(
        F.col("IdA").alias("QuestionId1"),
        F.col("Text1").alias(f"{text}1"),
        F.col("IdB").alias("QuestionId2"),
        F.col("Text2").alias(f"{text}2"),
        "Similarity",
    )


def similar_questions(
    corpus: DataFrame,
    queries: DataFrame,
    tokens: str = "ProcessedText",
    threshold: float = 0.5,
    k: int = 10,
    key: str = "Id",
    key_rows: int = KEY_ROWS,
    key_tokens: int = KEY_TOKENS,
) -> DataFrame:
    """A-46: for every query row the ``k`` most similar corpus rows, ties by id.

    Of equal token sets only the first ``k`` ids can be in a result, so only
    these are compared; this loses nothing.
    """
    sides = token_sets(queries, tokens, key).withColumn("Side", F.lit(0)).unionByName(
        token_sets(corpus, tokens, key).withColumn("Side", F.lit(1))
    )
    sides = materialize(_with_digest(_numbered(sides)), "token-sets")
    same = W.partitionBy("_h1", "_h2").orderBy("Id")
    answers, digest = sides.filter(F.col("Side") == 1), ["_h1", "_h2"]
    crowded = materialize(answers.groupBy(*digest).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > k).select(*digest), "crowded")
    copies = answers.join(crowded, digest, "left_semi").withColumn("_copy", F.row_number().over(same))
    columns = ["Side", "Id", "Size", "Tokens"]
    parts = [sides.filter(F.col("Side") == 0), answers.join(crowded, digest, "left_anti"), copies.filter(F.col("_copy") <= k)]
    sides = reduce(DataFrame.unionByName, [part.select(*columns) for part in parts])
    scored = _similar(sides, threshold, True, key_rows, key_tokens)
    best = W.partitionBy("IdA").orderBy(F.desc("Similarity"), "IdB")
    ranked = scored.withColumn("Rank", F.row_number().over(best)).filter(F.col("Rank") <= k)
    return ranked.select(F.col("IdA").alias("QueryId"), F.col("IdB").alias("Id"), "Similarity", "Rank")


def similar_by_id(
    corpus: DataFrame, value, tokens: str = "ProcessedText", threshold: float = 0.5, k: int = 10, key: str = "Id"
) -> DataFrame:
    """A-46: the rows most similar to one row; an unknown id gives no row.

    The tokens of that row are a scalar, so the corpus is read in one pass without any key or shuffle
    but the choice of the ``k`` best.
    """
    sets = token_sets(corpus, tokens, key)
    asked = sets.filter(F.col("Id") == value).agg(F.first("Tokens")).scalar()
    compared = sets.withColumn("_asked", asked).filter(F.size("_asked") > 0)
    shared = F.size(F.array_intersect("Tokens", "_asked"))
    scored = compared.withColumn("Similarity", shared / (F.size("Tokens") + F.size("_asked") - shared))
    best = scored.filter((F.size("Tokens") > 0) & (F.col("Similarity") >= threshold - ROUNDING))
    best = best.orderBy(F.desc("Similarity"), "Id").limit(k).select("Id", "Similarity")
    ranked = best.withColumn("Rank", F.row_number().over(W.orderBy(F.desc("Similarity"), "Id")))  # k rows
    return ranked.select(F.lit(value).alias("QueryId"), "Id", "Similarity", "Rank")


def duplicate_groups(df: DataFrame, tokens: str = "ProcessedText", key: str = "Id") -> DataFrame:
    """A-43: ``(Id, GroupId)`` of every row; rows with the same token set are one group, named by its least id.

    A row without tokens is a group of its own.
    """
    sets = _with_digest(token_sets(df, tokens, key)).select("Id", "_h1", "_h2", F.size("Tokens").alias("Size"))
    sets = materialize(sets, "token-sets")
    digest = ["_h1", "_h2"]
    least = sets.filter(F.col("Size") > 0).groupBy(*digest).agg(F.min("Id").alias("GroupId"))
    named = lookup_join(sets.select("Id", *digest), least, digest, "left", salt_by=["Id"])
    return named.select("Id", F.coalesce("GroupId", "Id").alias("GroupId"))


def _unordered(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    a, b = F.col(ids[0]), F.col(ids[1])
    return df.filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def confirmed_pairs(predicted: DataFrame, truth: DataFrame, predicted_ids: Sequence[str], truth_ids: Sequence[str]) -> DataFrame:
    """J-04: predicted unordered pairs ``(a, b)`` that are true links."""
    return _unordered(predicted, predicted_ids).join(_unordered(truth, truth_ids), ["a", "b"], "left_semi")


def missed_pairs(predicted: DataFrame, truth: DataFrame, predicted_ids: Sequence[str], truth_ids: Sequence[str]) -> DataFrame:
    """J-05: true unordered links ``(a, b)`` that were not predicted."""
    return _unordered(truth, truth_ids).join(_unordered(predicted, predicted_ids), ["a", "b"], "left_anti")


def pair_metrics(
    predicted: DataFrame,
    truth: DataFrame,
    predicted_ids: Sequence[str] = ("QuestionId1", "QuestionId2"),
    truth_ids: Sequence[str] = ("PostId", "RelatedPostId"),
    groups: DataFrame | None = None,
) -> DataFrame:
    """A-25, A-47: one row of counts, precision, recall and F1 over unordered links.

    With ``groups(Id, GroupId)`` both sides count in whole groups: a predicted pair stands for
    every link between the two groups, and a group for every link inside it. The links are counted
    from the groups' sizes and never listed.
    """
    p, t = _unordered(predicted, predicted_ids), _unordered(truth, truth_ids)
    if groups is None:
        claims = p.withColumn("links", F.lit(1).cast("bigint"))
        true = t.withColumn("hits", F.lit(1).cast("bigint"))
    else:
        groups = materialize(groups.select("Id", "GroupId"), "groups")
        sizes = groups.groupBy("GroupId").agg(F.count(F.lit(1)).alias("n"))

        def by_group(pairs: DataFrame) -> DataFrame:
            for side in ("a", "b"):
                named = groups.select(F.col("Id").alias(side), F.col("GroupId").alias("_g"))
                joined = pairs.join(named, side, "left")
                pairs = joined.withColumn(side, F.coalesce("_g", side)).drop("_g")
            return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

        def sized(pairs: DataFrame) -> DataFrame:
            for side in ("a", "b"):
                pairs = pairs.join(sizes.select(F.col("GroupId").alias(side), F.col("n").alias(f"n{side}")), side, "left")
            return pairs

        across = sized(by_group(p).filter("a <> b").distinct()).select(
            "a", "b", (F.coalesce("na", F.lit(1)) * F.coalesce("nb", F.lit(1))).alias("links")
        )
        inside = sizes.filter("n > 1").select(
            F.col("GroupId").alias("a"), F.col("GroupId").alias("b"), F.expr("n * (n - 1) div 2").alias("links")
        )
        claims = across.unionByName(inside)
        true = by_group(t).groupBy("a", "b").agg(F.count(F.lit(1)).alias("hits"))
    both = claims.join(true, ["a", "b"], "full").fillna(0, ["hits"])
    claim = F.col("links").isNotNull()
    counts = both.agg(
        *[
            F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).alias(name)
            for name, condition, value in (
                ("true_positives", claim, F.col("hits")),
                ("false_positives", claim, F.col("links") - F.col("hits")),
                ("false_negatives", ~claim, F.col("hits")),
            )
        ]
    )
    tp, fp, fn = (F.col(c) for c in counts.columns)
    zero = F.lit(0.0)
    return counts.withColumns(
        {
            "precision": F.coalesce(F.try_divide(tp, tp + fp), zero),
            "recall": F.coalesce(F.try_divide(tp, tp + fn), zero),
            "f1_score": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero),
        }
    )


def minhash_model(
    df: DataFrame, tokens: str = "ProcessedText", num_features: int = 10_000, tables: int = 5, seed: int = 42
) -> PipelineModel:
    """A-44: binary token features and their MinHash signatures.

    Rows without a token have no signature and are left out (null tokens as well).
    """
    stages = [
        SQLTransformer(statement=f"SELECT * FROM __THIS__ WHERE size({tokens}) > 0"),
        HashingTF(inputCol=tokens, outputCol="features", numFeatures=num_features, binary=True),
        MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=tables, seed=seed),
    ]
    return Pipeline(stages=stages).fit(df)


def document_vectors(
    df: DataFrame,
    tokens: str = "ProcessedText",
    vector_size: int = 100,
    min_count: int = 5,
    max_iter: int = 10,
    seed: int = 42,
    model: Word2VecModel | None = None,
) -> tuple[DataFrame, Word2VecModel]:
    """A-48: mean word vector per row in ``word2vec_features``; fits a model when none is given."""
    if model is not None:
        return model.transform(df), model
    return word_vectors(
        df, tokens, "word2vec_features", vector_size, min_count=min_count, max_iter=max_iter, seed=seed
    )


def score_pairs(
    pairs: DataFrame, vectors: DataFrame, ids: Sequence[str] = ("IdA", "IdB"), key: str = "Id", vector: str = "Vector"
) -> DataFrame:
    """A-49: cosine of each listed pair of rows of a vector table."""
    result = pairs
    for name, column in zip(ids, ("_a", "_b"), strict=True):
        result = lookup_join(result, vectors.select(F.col(key).alias(name), F.col(vector).alias(column)), [name])
    return result.withColumn("Cosine", cosine("_a", "_b")).drop("_a", "_b")


def group_means(vectors: DataFrame, group: str, vector: str = "Vector") -> DataFrame:
    """Mean vector per group, averaged per dimension so that tasks combine partial sums."""
    cells = vectors.select(group, F.posexplode(vector).alias("_pos", "_x"))
    means = cells.groupBy(group, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_mean"))
    listed = means.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("_pos", "_mean"))).alias("_cells"))
    return listed.select(group, F.transform("_cells", lambda c: c["_mean"]).alias("Mean"))


def nearest_to_group_mean(
    vectors: DataFrame, group: str, k: int = 10, key: str = "Id", vector: str = "Vector"
) -> DataFrame:
    """A-49: the ``k`` rows of each group closest to its mean vector by cosine, ties by id."""
    joined = lookup_join(vectors.select(key, group, vector), group_means(vectors, group, vector), [group], salt_by=[key])
    scored = joined.select(group, key, cosine(vector, "Mean").alias("Cosine"))
    best = W.partitionBy(group).orderBy(F.desc("Cosine"), key)
    return scored.withColumn("Rank", F.row_number().over(best)).filter(F.col("Rank") <= k)

"""Benchmark decontamination by a prefix-filtered join of word shingles (operator 9)."""

from __future__ import annotations


import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.llm.common import byte_table, mapped, materialize, text_blocks, word_codes

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 100_000  # benchmark windows held by a task at a time

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATORS = "".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(item_id, words)``: every ``window`` consecutive words of an item.

    An item of fewer words is one window of all its words; one without words, or with a
    null text, has none. The id is text; a null id is the text ``null``.
    """
    words = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item_id"), words.alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    return (
        items.filter(F.size("w") > 0)
        .select("item_id", "w", F.explode(starts).alias("i"))
        .select("item_id", F.slice("w", F.col("i"), window).alias("words"))
        .distinct()
    )


@dataclass
class Block:
    """Up to ``BLOCK_WINDOWS`` windows as numbers; its size is bounded by that and the window's length."""

    vocabulary: dict[str, int]
    windows: np.ndarray  # word numbers, -1 beyond the end
    lengths: np.ndarray
    items: list[str]
    shingles: dict[int, np.ndarray]  # by length: the sorted keys of all windows' shingles
    prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] | None = None

    @classmethod
    def of(cls, rows: list[tuple[str, list[str]]]) -> Block:
        vocabulary: dict[str, int] = {}
        width = max(len(words) for _, words in rows)
        windows = np.full((len(rows), width), -1, np.int64)
        for r, (_, words) in enumerate(rows):
            for c, word in enumerate(words):
                windows[r, c] = vocabulary.setdefault(word, len(vocabulary))
        lengths = np.array([len(words) for _, words in rows])
        block = cls(vocabulary, windows, lengths, [item for item, _ in rows], {})
        for size in range(1, SHINGLE + 1):
            _, _, keys = block.window_shingles(size)
            if len(keys):
                block.shingles[size] = np.unique(keys)
        return block

    def key(self, parts: list[np.ndarray]) -> np.ndarray:
        """One number for a shingle; -1 if a word of it is not a benchmark word."""
        key = parts[0].copy()
        for part in parts[1:]:
            key = key * (len(self.vocabulary) + 1) + part
        return np.where(np.minimum.reduce(parts) < 0, -1, key)

    def window_shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, position and key of the shingles of the windows that use this shingle length."""
        own = np.flatnonzero(np.minimum(self.lengths, SHINGLE) == size)
        row, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p in range(self.windows.shape[1] - size + 1):
            inside = own[self.lengths[own] >= p + size]
            row.append(inside)
            at.append(np.full(len(inside), p))
        row, at = np.concatenate(row), np.concatenate(at)
        return row, at, self.key([self.windows[row, at + k] for k in range(size)]) if len(row) else at

    def choose_prefixes(self, counts: dict[tuple[int, int], int]) -> None:
        """Of each window the rarest shingle. Exact containment needs every shingle, so one is enough;
        a window with a shingle that no document has cannot occur and goes."""
        self.prefix = {}
        for size, known in self.shingles.items():
            row, at, keys = self.window_shingles(size)
            count = np.array([counts.get((size, int(k)), 0) for k in known])[np.searchsorted(known, keys)]
            order = np.lexsort([at, keys, count, row])
            row, at, keys, count = row[order], at[order], keys[order], count[order]
            first = np.concatenate([[True], row[1:] != row[:-1]]) & (count > 0)
            row, at, keys = row[first], at[first], keys[first]
            order = np.argsort(keys, kind="stable")
            found, begins = np.unique(keys[order], return_index=True)
            self.prefix[size] = (found, np.append(begins, len(order)), row[order], at[order])


def _numbered(texts: pa.Array, block: Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's words begin, and the benchmark number of each word (-1: not a benchmark word)."""
    starts, codes, words = word_codes(mapped(texts, table))
    numbers = np.fromiter((block.vocabulary.get(w, -1) for w in words.to_pylist()), np.int64, len(words))
    return starts, numbers[codes] if len(codes) else np.zeros(0, np.int64)


def _at_keys(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose key is known, and its place there."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    candidates = np.flatnonzero(keys >= 0)
    place = np.minimum(np.searchsorted(known, keys[candidates]), len(known) - 1)
    hit = known[place] == keys[candidates]
    return candidates[hit], place[hit]


def _shingle_keys(block: Block, numbers: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    keys = block.key([numbers[k : n + k] for k in range(size)])
    return np.where(doc[:n] == doc[size - 1 :], keys, -1)


def _shingle_counts(docs: DataFrame, block, table: np.ndarray) -> dict[tuple[int, int], int]:
    """How often each benchmark shingle occurs in all documents; at most as many as the block has."""

    def count(batches):
        own: Block = block.value
        totals = {size: np.zeros(len(known), np.int64) for size, known in own.shingles.items()}
        for batch in batches:
            for _, texts in text_blocks(batch.column(0)):
                starts, numbers = _numbered(texts, own, table)
                doc = np.repeat(np.arange(len(texts)), np.diff(starts))
                for size, known in own.shingles.items():
                    _, place = _at_keys(_shingle_keys(own, numbers, doc, size), known)
                    totals[size] += np.bincount(place, minlength=len(known))
        for size, total in totals.items():
            some = np.flatnonzero(total)
            columns = [np.full(len(some), size), own.shingles[size][some], total[some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["size", "key", "n"])

    counted = docs.select("_text").mapInArrow(count, "size long, key long, n long")
    rows = counted.groupBy("size", "key").agg(F.sum("n").alias("n")).toArrow()
    columns = (rows.column(c).to_pylist() for c in ("size", "key", "n"))
    return {(size, key): n for size, key, n in zip(*columns)}


def _occurrences(block: Block, numbers: np.ndarray, doc: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and window of every occurrence."""
    begins, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size, (known, groups, rows, offsets) in block.prefix.items():
        position, place = _at_keys(_shingle_keys(block, numbers, doc, size), known)
        n = groups[place + 1] - groups[place]
        entry = np.repeat(groups[place] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        window, begin = rows[entry], np.repeat(position, n) - offsets[entry]
        of = doc[np.repeat(position, n)]
        fits = (begin >= starts[of]) & (begin + block.lengths[window] <= starts[of + 1])  # position and length
        window, begin = window[fits], begin[fits]
        for k in range(block.windows.shape[1]):  # the words themselves
            word = block.windows[window, k]
            same = (word < 0) | (numbers[np.minimum(begin + k, len(numbers) - 1)] == word)
            window, begin = window[same], begin[same]
        begins.append(begin)
        found.append(window)
    return np.concatenate(begins), np.concatenate(found)


def _mark(docs: DataFrame, block, table: np.ndarray, schema: str) -> DataFrame:
    hit_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def mark(batches):
        own: Block = block.value
        for batch in batches:
            n_words, hits, items = [], batch.column("_hits").to_pylist(), batch.column("_items").to_pylist()
            for first, texts in text_blocks(batch.column("_text")):
                starts, numbers = _numbered(texts, own, table)
                doc = np.repeat(np.arange(len(texts)), np.diff(starts))
                n_words.extend(np.diff(starts).tolist())
                begin, window = _occurrences(own, numbers, doc, starts)
                for d in np.unique(doc[begin]).tolist() if len(begin) else []:
                    mine = doc[begin] == d
                    b, w = begin[mine] - starts[d], window[mine]
                    old = [(x["s"], x["e"]) for x in hits[first + d]]
                    hits[first + d] = [{"s": s, "e": e} for s, e in _merged(old + list(zip(b.tolist(), (b + own.lengths[w]).tolist())))]
                    items[first + d] = sorted({*items[first + d], *(own.items[x] for x in w.tolist())})
            others = [batch.column(c) for c in batch.schema.names if c.startswith("_k")]
            yield pa.RecordBatch.from_arrays(
                [*others, batch.column("_text"), pa.array(n_words, pa.int64()), pa.array(hits, hit_type), pa.array(items, pa.list_(pa.string()))],
                names=[*[c for c in batch.schema.names if c.startswith("_k")], "_text", "_n", "_hits", "_items"],
            )

    return docs.mapInArrow(mark, schema)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def mark_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    text_col: str = "text",
    drop_text: bool = False,
) -> DataFrame:
    """The documents with ``n_words``, ``hits`` (word ranges, merged) and ``items`` (ids as sorted texts).

    The benchmark's windows are the query set and pass in blocks of bounded size over all documents.
    For each block the documents are read twice: to count the benchmark's shingles, and to find
    the windows by their rarest shingle. Documents are never shuffled, so copies and frequent
    words put no load on one task. An empty benchmark hits nothing.
    """
    spark, names = docs.sparkSession, docs.columns
    kept = [c for c in names if not (drop_text and c == text_col)]
    state = docs.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)],
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"),
        F.lit(0).cast("long").alias("_n"),
        F.array().cast("array<struct<s:long,e:long>>").alias("_hits"),
        F.array().cast("array<string>").alias("_items"),
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema.fields)
    table = byte_table(_SEPARATORS)
    windows = materialize(benchmark_windows(benchmark, window), "windows")
    blocks = max(1, math.ceil(windows.count() / block_windows))
    dealt = windows.withColumn("_block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    for number in range(blocks):
        rows = dealt.filter(F.col("_block") == number).toArrow()
        pairs = sorted(zip(rows.column("item_id").to_pylist(), rows.column("words").to_pylist()))
        block = Block.of(pairs) if pairs else Block({}, np.zeros((0, 1), np.int64), np.zeros(0, np.int64), [], {})
        block.choose_prefixes(_shingle_counts(state, spark.sparkContext.broadcast(block), table) if pairs else {})
        if number:
            state = materialize(state, "marked")
        state = _mark(state, spark.sparkContext.broadcast(block), table, schema)
    return state.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)],
        F.col("_n").alias("n_words"),
        F.col("_hits").alias("hits"),
        F.col("_items").alias("items"),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its words, the words inside occurring windows, and the items found."""
    marked = mark_contamination(docs.select("doc_id", "text"), benchmark, drop_text=True)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return marked.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any word of a benchmark window, with all their columns."""
    marked = mark_contamination(docs.toDF(*[f"_d{i}" for i in range(len(docs.columns))]), benchmark, text_col=f"_d{docs.columns.index('text')}")
    return marked.filter(F.size("hits") == 0).select(*[F.col(f"_d{i}").alias(c) for i, c in enumerate(docs.columns)])

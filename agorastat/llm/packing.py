"""Best-fit packing of token pieces into sequences, certified by lower bounds (operator 6)."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.llm.common import materialize, row_mapper, text_blocks
from agorastat.llm.tokens import public_path, word_ids

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
GROUP_PIECES = 50_000  # pieces one task packs at a time
ROUNDS = 4  # packings at most; a group whose bound is met leaves earlier

PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def token_pieces(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Whole documents as token ids plus ``end_id``, longer ones cut into pieces of ``capacity``.

    One row per piece: doc_id, piece, start, length, ids_crc32, and with ``keep_ids`` the ids
    themselves. A null or empty text is one piece with the end id. Map only: no text is shuffled.
    """
    schema = PIECES.append(pa.field("ids", pa.binary())) if keep_ids else PIECES

    def cut(batch: pa.RecordBatch) -> list[list]:
        memory = word_ids(public_path(vocabulary))
        end = int(end_id).to_bytes(4, "little")
        docs_of, rows = batch.column(0).to_pylist(), []
        for first, texts in text_blocks(batch.column(1)):
            for doc, ids in zip(docs_of[first:], memory.texts_ids(texts)):
                whole = ids + end
                for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part if keep_ids else None))
        return [list(c) for c in zip(*rows)][: len(schema)] if rows else [[] for _ in schema]

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(row_mapper(schema, cut), kinds)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, by two families of dual feasible functions.

    A dual feasible function u keeps sum(u(x)) <= 1 for sizes that fit into one
    sequence, so the sum over all pieces bounds their number from below.
    f_t counts sizes above capacity - t whole, drops those below t and keeps the rest;
    u_k rounds x * (k + 1) / capacity down to k-ths unless it is whole.
    """
    if not len(sizes):
        return 0
    values, counts = np.unique(sizes.astype(np.int64), return_counts=True)
    total = int((values * counts).sum())
    best = -(-total // capacity)
    before = np.concatenate([[0], np.cumsum(values * counts)])
    pieces = np.concatenate([[0], np.cumsum(counts)])
    for t in values[values <= capacity // 2]:
        low = int(np.searchsorted(values, t))
        high = int(np.searchsorted(values, capacity - t, side="right"))
        middle = int(before[high] - before[low])
        best = max(best, int(pieces[-1] - pieces[high]) + -(-middle // capacity))
    for k in range(1, 41):
        scaled = values * (k + 1)
        whole = scaled % capacity == 0
        # k times the function, so that everything stays whole: whole multiples keep their value
        parts = np.where(whole, scaled * k // (k + 1), scaled // capacity * capacity)
        best = max(best, -(-int((parts * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each size, and the number of bins.

    Open bins are kept by free space; the set bits of ``free`` name the spaces that
    occur, so the tightest fitting bin is the lowest set bit from the size upward.
    """
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, opened = 0, 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = by_space[space].pop()
            if not by_space[space]:
                free ^= 1 << space
        else:
            chosen, space = opened, capacity
            opened += 1
        bins[i], offsets[i] = chosen, capacity - space
        left = space - size
        if left:
            if not by_space[left]:
                free |= 1 << left
            by_space[left].append(chosen)
    return bins, offsets, opened


PLACED = "_item long, length long, sequence_id long, offset long, settled boolean"


def _pack_groups(items: DataFrame, n_items: int, capacity: int, round_no: int, per_group: int) -> DataFrame:
    groups = max(1, math.ceil(n_items / per_group))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_item"], ascending=[False, True], ignore_index=True)
        sizes = rows["length"].to_numpy()
        bins, offsets, opened = best_fit_decreasing(sizes, capacity)
        certified = opened == lower_bound(sizes, capacity)
        fill = np.bincount(bins, weights=sizes, minlength=opened)
        return pd.DataFrame(
            {
                "_item": rows["_item"],
                "length": sizes,
                "sequence_id": (round_no << 56) + (int(key[0]) << 32) + bins,
                "offset": offsets,
                "settled": certified | (fill[bins] == capacity),
            }
        )

    dealt = F.pmod(F.xxhash64(F.col("_item"), F.lit(round_no)), F.lit(groups))
    return items.select("_item", "length", dealt.alias("_group")).groupBy("_group").applyInPandas(pack, PLACED)


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, per_group: int = GROUP_PIECES) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; needs a column ``length`` from 1 to ``capacity``.

    Groups of about ``per_group`` pieces are packed best-fit decreasing. A group that
    uses as many sequences as its lower bound is certified and stays. The others keep
    only their full sequences: their remaining pieces exchange groups and are packed
    again, and a round counts only if it saves sequences. Every round writes its
    placements to the shared folder, so a lost executor repeats one round at most.
    Group numbers and their sizes follow the number of pieces; a repeated row is a
    piece of its own. No pieces give no rows.
    """
    numbered = materialize(pieces, "pieces").withColumn("_item", F.monotonically_increasing_id())
    items = materialize(numbered.select("_item", "length"), "items")
    placed, n_items = None, items.count()
    for round_no in range(rounds if n_items else 1):
        trial = materialize(_pack_groups(items, n_items, capacity, round_no, per_group), "placed")
        if placed is None:
            placed = trial
        else:
            open_before = placed.filter(~F.col("settled")).select("sequence_id").distinct().count()
            if trial.select("sequence_id").distinct().count() >= open_before:
                break
            placed = placed.filter("settled").unionByName(trial)
        items = placed.filter(~F.col("settled")).select("_item", "length")
        left = items.count()
        if left == 0 or (round_no and left == n_items) or (round_no == 0 and n_items <= per_group):
            break
        n_items = left
    return numbered.join(placed.select("_item", "sequence_id", "offset"), "_item").drop("_item")

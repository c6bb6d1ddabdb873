"""Hard negatives by inner product, searched best-first in an R-tree packed sort-tile-recursively.

A row is an id, a label and a vector of integers. For an anchor, its positives are the other rows
of its label with the highest scores; for each of them, its hard negatives are the rows of other
labels with the highest scores inside a window below the positive's score.

The index is a table with one row per leaf: its points, and the box that bounds them. Equal vectors
of one label are one point that keeps as many of its least ids as a result can ask for, so a vector
that a third of all rows share is one point. Spark cuts the points into tiles by quantiles of one
coordinate after another, the most varied first; a task packs a tile into leaves the same way.

A search passes the index once for each block of anchors and holds the boxes of its own share of
the index in levels. A box gives each coordinate's least and greatest product with an anchor, so
their sums bound the scores inside. The queue takes the box with the highest bound first, leaves
out boxes that no window meets, and ends where all that is left lies strictly below the k-th score.

Defined results: rows with a null label or vector, or a null, infinite or NaN component, take no part.
A row repeated in full counts once. Rows that share an anchor's id are not its positives. Ties go to
the smaller id, a null id last. Vectors of different lengths have no score, so they never meet; empty
vectors score 0. Scaled components are cut off at 2^24, and vectors have up to 2^13 components, so
sums are exact. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorastat.llm.common import materialize, scratch_path

LEAF_POINTS = 128
FANOUT = 16  # boxes below one box of the next level
TILE_POINTS = 4096  # a tile with more is cut by the next coordinate
SLABS = 8  # pieces of one such cut
ANCHOR_ROWS = 65_536  # anchors of one pass over the index; every task holds them
STEP_ANCHORS = 256  # anchors whose bounds a task computes together
LARGEST = 1 << 24
FAR = 1 << 62

_LEAVES = pa.schema(
    [
        ("dims", pa.int32()),
        ("label", pa.int64()),
        ("low", pa.binary()),
        ("high", pa.binary()),
        ("vectors", pa.binary()),
        ("ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int32())),
    ]
)
_LEAVES_SPARK = "dims int, label long, low binary, high binary, vectors binary, ids array<long>, counts array<int>"
_FOUND = pa.schema([(c, pa.int64()) for c in ("anchor", "window", "anchor_id", "positive_id", "positive_score", "id", "score")])
_FOUND_SPARK = ", ".join(f"{name} long" for name in _FOUND.names)


def integer_rows(rows: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256) -> DataFrame:
    """``(id, label, v)`` of the rows that take part, each component ``floor(scale * x)``, every row once."""
    scaled = F.transform(
        F.col(vector), lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    )
    usable = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = rows.filter(F.col(label).isNotNull() & F.col(vector).isNotNull()).filter(usable)
    return kept.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), scaled.alias("v")).distinct()


def _points(rows: DataFrame, keep: int) -> DataFrame:
    """One row per label and vector, with its least ``keep`` ids; each map task passes on no more than these."""
    places = F.row_number().over(W.partitionBy("label", "v").orderBy(F.col("id").asc_nulls_last()))
    first = rows.withColumn("place", places).filter(F.col("place") <= keep)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "id"))), lambda x: x["id"])
    return first.groupBy("label", "v").agg(listed.alias("ids"))


def _tiles(points: DataFrame, tile_points: int) -> DataFrame:
    """The points with their tile: label, length, and the slab of each cut.

    A cut takes the quantiles of a tile that is still too large; points are distinct, so the last
    coordinate ends it at the latest.
    """
    placed = materialize(points.withColumn("tile", F.array("label", F.size("v").cast("long"))), "tiles")
    crowded = placed.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile_points).select("tile")
    if crowded.isEmpty():
        return placed
    dims = placed.agg(F.max(F.size("v"))).first()[0]
    spread = placed.agg(*[F.var_pop(F.get("v", F.lit(i))) for i in range(dims)]).first() if dims else []
    for c in sorted(range(dims), key=lambda i: (-(spread[i] or 0), i)):
        at = F.get("v", F.lit(c))
        borders = placed.join(crowded, "tile").groupBy("tile").agg(
            F.percentile_approx(at, [i / SLABS for i in range(1, SLABS)], 10_000).alias("borders")
        )
        slab = F.size(F.filter("borders", lambda b: b < at)).cast("long")
        cut = F.when(F.col("borders").isNull(), F.col("tile")).otherwise(F.concat("tile", F.array(slab)))
        placed = materialize(placed.join(borders, "tile", "left").withColumn("tile", cut).drop("borders"), "tiles")
        crowded = placed.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile_points).select("tile")
        if crowded.isEmpty():
            break
    return placed


def str_leaves(vectors: np.ndarray, leaf: int = LEAF_POINTS) -> list[np.ndarray]:
    """Row numbers of each leaf: sort by one coordinate, cut into slabs, go on in each by the next."""
    boxes = -(-len(vectors) // leaf)
    axes = np.argsort(-vectors.var(axis=0), kind="stable")[: max(1, int(boxes - 1).bit_length())] if vectors.shape[1] else []

    def cut(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        boxes = -(-len(rows) // leaf)
        if boxes <= 1 or depth == len(axes):
            return [rows[i : i + leaf] for i in range(0, len(rows), leaf)]
        rows = rows[np.argsort(vectors[rows, axes[depth]], kind="stable")]
        slabs = int(np.ceil(boxes ** (1 / (len(axes) - depth)) - 1e-9))
        step = leaf * -(-boxes // slabs)
        return [part for i in range(0, len(rows), step) for part in cut(rows[i : i + step], depth + 1)]

    return cut(np.arange(len(vectors)), 0)


def _pack(table: pa.Table) -> pa.Table:
    label = table["label"][0].as_py()
    lists = table["v"].combine_chunks()
    vectors = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(len(lists), -1)
    ids = table["ids"].to_pylist()
    rows = []
    for part in str_leaves(vectors):
        own = vectors[part]
        rows.append(
            {
                "dims": own.shape[1],
                "label": label,
                "low": own.min(axis=0).tobytes(),
                "high": own.max(axis=0).tobytes(),
                "vectors": own.tobytes(),
                "ids": [i for p in part for i in ids[p]],
                "counts": [len(ids[p]) for p in part],
            }
        )
    return pa.Table.from_pylist(rows, _LEAVES)


def build_index(rows: DataFrame, keep: int = 6, tile_points: int = TILE_POINTS) -> DataFrame:
    """The leaves over ``rows(id, label, v)``, written; each point keeps its ``keep`` least ids."""
    tiles = _tiles(_points(rows, keep), tile_points)
    return materialize(tiles.groupBy("tile").applyInArrow(_pack, _LEAVES_SPARK), "leaves")


class _Tree:
    """The boxes above the leaves of one vector length; a node covers leaves of one label."""

    def __init__(self, leaves: list[tuple]) -> None:
        leaves.sort(key=lambda leaf: leaf[0])  # stable: neighbours stay together
        self.labels = [leaf[0] for leaf in leaves]
        low, high = [leaf[1] for leaf in leaves], [leaf[2] for leaf in leaves]
        self.vectors, self.ids, self.nulls, self.starts = zip(*[leaf[3:] for leaf in leaves])
        self.below: list[range | None] = [None] * len(leaves)
        self.roots: dict[int, list[int]] = {}
        level = range(len(leaves))
        while level:
            first = len(low)
            by_label: dict[int, list[int]] = {}
            for node in level:
                by_label.setdefault(self.labels[node], []).append(node)
            for label, nodes in by_label.items():
                if len(nodes) <= FANOUT:
                    self.roots[label] = nodes
                    continue
                for i in range(0, len(nodes), FANOUT):
                    group = nodes[i : i + FANOUT]
                    self.below.append(range(group[0], group[-1] + 1))
                    self.labels.append(label)
                    low.append(np.min([low[n] for n in group], axis=0))
                    high.append(np.max([high[n] for n in group], axis=0))
            level = range(first, len(low))
        self.low, self.high = np.array(low, np.int64), np.array(high, np.int64)
        self.most = max(int(np.abs(self.low).max(initial=0)), int(np.abs(self.high).max(initial=0)))

    def bounds(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each vector inside each box: sums of per-coordinate intervals."""
        kind = np.float64 if self.exact(vectors, 53) else np.int64
        up, down = np.maximum(vectors, 0).astype(kind), np.minimum(vectors, 0).astype(kind)
        low, high = self.low.T.astype(kind), self.high.T.astype(kind)
        return (up @ low + down @ high).astype(np.int64), (up @ high + down @ low).astype(np.int64)

    def exact(self, vectors: np.ndarray, bits: int) -> bool:
        return vectors.shape[1] * max(1, self.most) * int(np.abs(vectors).max(initial=1)) < 1 << bits


def _merged(best: tuple, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    scores, nulls, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], nulls]), np.concatenate([best[2], ids])
    order = np.lexsort((ids, nulls, -scores))[:k]
    return scores[order], nulls[order], ids[order]


def _best_first(tree: _Tree, roots: list[int], vector: np.ndarray, low: np.ndarray, high: np.ndarray, floors: list[int], ceilings: list[int], k: int, own: tuple | None) -> list[tuple]:
    """The best ``k`` of each window: (scores, whether the id is null, ids), highest score first, then least id."""
    empty = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
    best = [empty] * len(floors)
    kth = list(floors)  # nothing strictly below is wanted
    top = max(ceilings)
    queue = [(-min(int(high[n]), top), n) for n in roots]
    heapq.heapify(queue)
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < min(kth):
            break
        least, most = int(low[node]), int(high[node])
        windows = [j for j in range(len(kth)) if most >= kth[j] and least <= ceilings[j]]
        if not windows:
            continue
        if tree.below[node] is not None:
            for n in tree.below[node]:
                heapq.heappush(queue, (-min(int(high[n]), top), n))
            continue
        scores = (tree.vectors[node] @ vector).astype(np.int64)
        for j in windows:
            hits = np.flatnonzero((scores >= kth[j]) & (scores <= ceilings[j]))
            if not len(hits):
                continue
            starts = tree.starts[node]
            counts = starts[hits + 1] - starts[hits]
            at = np.repeat(starts[hits] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            ids, nulls, got = tree.ids[node][at], tree.nulls[node][at], np.repeat(scores[hits], counts)
            if own is not None:
                other = (ids != own[0]) | (nulls != own[1])
                ids, nulls, got = ids[other], nulls[other], got[other]
            best[j] = _merged(best[j], got, nulls, ids, k)
            if len(best[j][0]) == k:
                kth[j] = max(kth[j], int(best[j][0][-1]))
    return best


def _searcher(anchors: dict[str, np.ndarray], windows: dict[str, np.ndarray] | None, k: int):
    """For mapInArrow over leaves: the best rows of this task's leaves for each anchor, and window if any.

    Without ``windows``, rows of the anchor's label other than itself; with them, rows of other labels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                shape = (len(row["counts"]), row["dims"])
                ids = np.array([i or 0 for i in row["ids"]], np.int64)
                nulls = np.array([i is None for i in row["ids"]], bool)
                starts = np.concatenate([[0], np.cumsum(row["counts"])]).astype(np.int64)
                low, high = np.frombuffer(row["low"], "<i4"), np.frombuffer(row["high"], "<i4")
                leaves.setdefault(row["dims"], []).append((row["label"], low, high, np.frombuffer(row["vectors"], "<i4").reshape(shape), ids, nulls, starts))
        for dims, own in leaves.items():
            chosen = np.flatnonzero(anchors["dims"] == dims)
            if not len(chosen):
                continue
            tree = _Tree(own)
            vectors = np.stack([np.frombuffer(anchors["v"][a], "<i4") for a in chosen]).astype(np.int64).reshape(len(chosen), dims)
            kind = np.float32 if tree.exact(vectors, 24) else np.float64 if tree.exact(vectors, 53) else np.int64
            tree.vectors = [v.astype(kind) for v in tree.vectors]
            for first in range(0, len(chosen), STEP_ANCHORS):
                step = vectors[first : first + STEP_ANCHORS]
                low, high = tree.bounds(step)
                rows: list[tuple] = []
                for i, a in enumerate(chosen[first : first + STEP_ANCHORS]):
                    label, own_id = int(anchors["label"][a]), int(anchors["id"][a])
                    if windows is None:
                        places, floors, ceilings = [(0, None, None)], [-FAR], [FAR]
                        roots = tree.roots.get(label, [])
                    else:
                        one, end = windows["starts"][a], windows["starts"][a + 1]
                        places = [(j - one, windows["id"][j], int(windows["score"][j])) for j in range(one, end)]
                        places = [p for p in places if p[2] >= 0]  # 80 p <= 100 p fails below 0
                        floors, ceilings = [-(-4 * p[2] // 5) for p in places], [p[2] for p in places]
                        roots = [n for other, nodes in tree.roots.items() if other != label for n in nodes]
                    if not places or not roots:
                        continue
                    found = _best_first(tree, roots, step[i].astype(kind), low[i], high[i], floors, ceilings, k, (own_id, False) if windows is None else None)
                    for (j, positive, score), (scores, nulls, ids) in zip(places, found, strict=True):
                        rows += [(int(a), int(j), own_id, positive, score, None if no else int(n), int(s)) for s, no, n in zip(scores, nulls, ids)]
                columns = [list(c) for c in zip(*rows)] if rows else [[]] * len(_FOUND)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of what the tasks found, numbered from 1; map tasks pass on no more than these."""
    order = W.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, anchor_rows: int = ANCHOR_ROWS, tile_points: int = TILE_POINTS) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for each anchor and positive.

    ``rows`` and ``anchors`` are ``(id, label, v)`` as ``integer_rows`` gives them; the anchors are the
    stated queries and pass the whole index in blocks of about ``anchor_rows``. A negative's score
    lies between 80 and 100 percent of the positive's, so a positive below 0 has none.
    """
    spark = rows.sparkSession
    rows = materialize(rows, "rows")
    index = build_index(rows, max(positives + 1, negatives), tile_points)
    asked = anchors.filter(F.col("id").isNotNull())
    blocks = max(1, -(-asked.count() // anchor_rows))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id", "label"), F.lit(blocks)))
    asked = materialize(dealt.repartitionByRange("block").sortWithinPartitions("block"), "anchors")  # a pass reads its own row groups
    path = scratch_path(spark, "negatives")
    for block in range(blocks):
        table = asked.filter(F.col("block") == block).toArrow()  # at most about anchor_rows
        lists = table["v"].combine_chunks()
        held = {
            "id": table["id"].to_numpy(),
            "label": table["label"].to_numpy(),
            "dims": np.array([len(v) for v in lists.to_pylist()], np.int64),
            "v": [np.array(v, "<i4").tobytes() for v in lists.to_pylist()],
        }
        near = _top(index.mapInArrow(_searcher(held, None, positives), _FOUND_SPARK), positives)
        found = near.select("anchor", "rank", "id", "score").toArrow().sort_by([("anchor", "ascending"), ("rank", "ascending")])
        windows = {
            "starts": np.searchsorted(found["anchor"].to_numpy(), np.arange(len(held["id"]) + 1)),
            "id": found["id"].to_pylist(),
            "score": found["score"].to_numpy(),
        }
        hard = _top(index.mapInArrow(_searcher(held, windows, negatives), _FOUND_SPARK), negatives)
        hard.select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(path)
    return spark.read.schema("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long").parquet(path)


def report(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100; where it is divisible by 7, the label moves on by one."""
    label = F.col("label").cast("long")
    moved = embeddings.select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label")
    )
    rows = integer_rows(moved)
    return hard_negatives(rows, rows.filter(F.col("id") % 100 == 0))

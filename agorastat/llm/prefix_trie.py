"""The trie of shared conversation prefixes, with subtree sums by the Euler-tour technique.

Every distinct sequence of first turns is a node. Its key is its length with two sums over its turns
of 64-bit hashes that take in the place of the turn, so all prefixes of a conversation get keys from
running sums, and no text is moved: rows carry a SHA-256 digest and a length. Nodes are told apart by
these 128 bits. Long conversations are cut into ranges of turns, whose totals give the offsets.

Subtree sums: each node has an enter and an exit arc. Enter leads to the first child's enter, or to the
own exit; exit leads to the next sibling's enter, or to the parent's exit. The list is ranked: ranges
of arcs contract what runs inside them to one arc per entry, in numpy; the entries form a shorter list,
and so on until one range is left, whose places are passed down again. Where most links leave their range,
a round of coin flips splices out about a quarter of the arcs, so the rounds stay logarithmic. Prefix sums
at a node's exit less those at its enter are the sums of its subtree.

Defined results: rows without a ``conv_id`` take no part; a null role or text is empty; turns of a
conversation are ordered by turn (null first), ties by the SHA-256 of role length, role and text;
a repeated row is a further turn. Without rows there is no node, otherwise the root always is one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorastat.llm.common import materialize

PART_ROWS = 65_536  # arcs that one task ranks at once, twice that at most
LONGEST_HEAD = 5  # turns a conversation can take over from another

_WEIGHTS = ["place", "leaves", "saved"]
_SUM = "decimal(38,0)"


def _ranges(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows in ranges of ``order`` with the number of their range; written, as range borders come from a sample."""
    return materialize(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), name)


def _running(ranged: DataFrame, group: Sequence[str], order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Running sums, the own row included, per group; a group may lie in many ranges."""
    inside = W.partitionBy(*group, "range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    lower = W.partitionBy(*group).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy(*group, "range").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    below = totals.select(*group, "range", *[F.coalesce(F.sum(f"_{n}").over(lower), F.lit(0)).alias(f"_{n}") for n in sums])
    if not group:
        below = F.broadcast(below)  # one row per range
    local = ranged.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    return local.join(below, [*group, "range"]).withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("range", *[f"_{n}" for n in sums])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, d, digest, chars)`` of each turn, ``d`` its place in the conversation from 1."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "digest", "row"]
    counted = _running(_ranges(turns, order, "turns"), ["conv_id"], order[1:], {"d": F.lit(1).cast("long")})
    return materialize(counted.select("conv_id", "d", "digest", "chars"), "numbered")


def share_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the heads of others, as ``(conv_id, n)`` and ``(conv_id, d, digest, chars, n)``.

    Conversation c starts with the first h turns of conversation c - c % 100 (fewer, if it has fewer), h being
    the CRC-32 of c modulo 6, and goes on with its own turns after its first h. Those 100 share one base.
    """
    own = turns.groupBy("conv_id").agg(F.max("d").alias("n_own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_HEAD + 1)
    base = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % 100}).join(base, "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.select("conv_id", "base", "h", (taken - F.col("h")).alias("shift"), (taken + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n"))
    convs = materialize(convs, "convs")
    heads = turns.filter(F.col("d") <= LONGEST_HEAD).withColumnRenamed("conv_id", "base")
    first = convs.join(heads, "base").filter(F.col("d") <= F.col("h")).select("conv_id", "d", "digest", "chars", "n")
    rest = turns.filter(F.col("d") > h).join(convs, "conv_id").select("conv_id", (F.col("d") + F.col("shift")).alias("d"), "digest", "chars", "n")
    return convs.select("conv_id", "n"), first.unionByName(rest)


def _contract(table: pa.Table) -> pa.Table:
    """One range of the list: for each arc the entry it is reached from and the sums up to it; entries also lead on."""
    order = np.argsort(table["id"].to_numpy())
    ids, succ = table["id"].to_numpy()[order], table["succ"].to_numpy()[order]
    weights = np.stack([table[w].to_numpy()[order] for w in _WEIGHTS])
    n = len(ids)
    at = np.minimum(np.searchsorted(ids, succ), n - 1)
    inside = ids[at] == succ
    head, before = np.arange(n), np.zeros_like(weights)
    head[at[inside]] = np.flatnonzero(inside)
    before[:, at[inside]] = weights[:, inside]
    for _ in range(n.bit_length() + 1):  # pointer jumping towards the entries
        if (head[head] == head).all():
            break
        before, head = before + before[:, head], head[head]
    entry, tails = head == np.arange(n), np.flatnonzero(~inside)
    leads, sums = np.zeros(n, np.int64), np.zeros_like(weights)
    leads[head[tails]] = succ[tails]
    sums[:, head[tails]] = before[:, tails] + weights[:, tails]
    columns = [pa.array(ids), pa.array(ids[head]), *[pa.array(b) for b in before]]
    columns += [pa.array(leads, mask=~entry), *[pa.array(s, mask=~entry) for s in sums]]
    return pa.Table.from_arrays(columns, names=["id", "head", *[f"{w}_before" for w in _WEIGHTS], "succ", *_WEIGHTS])


_LEVEL = "id long, head long, " + ", ".join(f"{w}_before long" for w in _WEIGHTS) + ", succ long, " + ", ".join(f"{w} long" for w in _WEIGHTS)


def _by_range(arcs: DataFrame, part_rows: int) -> tuple[DataFrame, int]:
    """One level of contraction inside ranges of ids, and the number of ranges: each holds ``part_rows`` to twice as many arcs, the last may hold fewer."""
    bucket = F.floor(F.col("id") / part_rows)
    counts = arcs.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    up_to = F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))  # one row per bucket
    ranges = materialize(counts.select("bucket", F.floor(F.coalesce(up_to, F.lit(0)) / part_rows).alias("range")), "buckets")
    placed = arcs.withColumn("bucket", bucket).join(ranges, "bucket").drop("bucket")
    return placed.groupBy("range").applyInArrow(_contract, _LEVEL), ranges.select("range").distinct().count()


def _by_coins(arcs: DataFrame, number: int) -> DataFrame:
    """One level that splices out every arc with coin 1 whose predecessor has coin 0."""
    coin = lambda c: F.pmod(F.xxhash64(c, F.lit(number)), F.lit(2))
    after = arcs.filter(coin("id") == 1).select(F.col("id").alias("a_id"), F.col("succ").alias("a_succ"), *[F.col(w).alias(f"a_{w}") for w in _WEIGHTS])
    paired = materialize(arcs.join(after, (F.col("succ") == F.col("a_id")) & (coin("id") == 0), "left"), "coins")
    zero = F.lit(0).cast("long")
    kept = paired.select("id", F.col("id").alias("head"), *[zero.alias(f"{w}_before") for w in _WEIGHTS], F.coalesce("a_succ", "succ").alias("succ"),
                         *[(F.col(w) + F.coalesce(f"a_{w}", zero)).alias(w) for w in _WEIGHTS])
    gone = paired.filter("a_id IS NOT NULL").select(F.col("a_id").alias("id"), F.col("id").alias("head"), *[F.col(w).alias(f"{w}_before") for w in _WEIGHTS],
                                                    *[F.lit(None).cast("long").alias(c) for c in ["succ", *_WEIGHTS]])
    return kept.join(gone.select("id"), "id", "left_anti").unionByName(gone)


def list_ranks(arcs: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Prefix sums before each arc of the list ``arcs(id, succ, place, leaves, saved)``; the last ``succ`` is -1."""
    levels: list[DataFrame] = []
    current, n, parts = arcs, arcs.count(), 0
    local = True
    while parts != 1 and n:
        if local:
            level, parts = _by_range(current, part_rows)
        else:
            level = _by_coins(current, len(levels))
        levels.append(materialize(level, "level"))
        current = levels[-1].filter("id = head").select("id", "succ", *_WEIGHTS)
        left = current.count()
        local = not local or 2 * left < n  # links that leave their range: flip coins next
        n = left
    if not levels:
        return arcs.select("id", *_WEIGHTS)
    befores = [f"{w}_before" for w in _WEIGHTS]
    ranks = levels[-1].select("id", *[F.col(b).alias(w) for b, w in zip(befores, _WEIGHTS)])
    for level in reversed(levels[:-1]):
        above = ranks.select(F.col("id").alias("head"), *_WEIGHTS)
        ranks = level.select("id", "head", *befores).join(above, "head").select("id", *[(F.col(b) + F.col(w)).alias(w) for b, w in zip(befores, _WEIGHTS)])
        ranks = materialize(ranks, "ranks")
    return ranks


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the lists of a node, comma-joined, streamed in order."""
    current, state, done = None, None, []

    def flush() -> pa.RecordBatch:
        rows = [list(c) for c in zip(*done)] if done else [[]] * 4
        done.clear()
        kinds = [pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=["d", "s", "t", "ends_sha256"])

    for batch in batches:
        for d, s, t, ids in zip(*(batch.column(c).to_pylist() for c in ("d", "s", "t", "ids"))):
            if (d, s, t) != current:
                if state is not None:
                    done.append((*current, state.hexdigest()))
                current, state = (d, s, t), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield flush()
    if state is not None:
        done.append((*current, state.hexdigest()))
    yield flush()


def ends_digests(ends: DataFrame) -> DataFrame:
    """``(d, s, t, ends_sha256)`` from ``ends(d, s, t, conv_id)``: the ids in ascending order, comma-joined.

    Ranges of ids are joined to strings in parallel; only the digest's chain itself runs in one task per node.
    """
    key = ["d", "s", "t"]
    lists = _ranges(ends, [*key, "conv_id"], "ends").groupBy(*key, "range").agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids")
    )
    ordered = lists.repartition(*key).sortWithinPartitions(*key, "range").select(*key, "ids")
    return ordered.mapInArrow(_digests, f"d long, s {_SUM}, t {_SUM}, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per node of the conversations ``convs(conv_id, n)`` with ``turns(conv_id, d, digest, chars, n)``, n turns each.

    ``conv_id`` is the smallest member; ``enter_at`` and ``exit_at`` are the node's places in the tour.
    """
    key, parent = ["d", "s", "t"], ["p_d", "p_s", "p_t"]
    one, zero = F.xxhash64("digest", "d").cast(_SUM), F.lit(0).cast(_SUM)
    two = F.xxhash64("d", "digest", F.lit("second")).cast(_SUM)
    ranged = _ranges(turns.withColumn("d", F.col("d").cast("long")), ["conv_id", "d"], "rebuilt")
    paths = _running(ranged, ["conv_id"], ["d"], {"s": one, "t": two}).select(
        "conv_id", "d", F.col("s").cast(_SUM).alias("s"), F.col("t").cast(_SUM).alias("t"), "chars", (F.col("d") == F.col("n")).alias("last"),
        (F.col("d") - 1).alias("p_d"), (F.col("s") - one).cast(_SUM).alias("p_s"), (F.col("t") - two).cast(_SUM).alias("p_t"),
    )
    paths = materialize(paths, "paths")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("d"), zero.alias("s"), zero.alias("t"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"),
        *[F.lit(None).cast(k).alias(p) for p, k in zip(parent, ["long", _SUM, _SUM])],
    )
    nodes = paths.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in ["chars", *parent]]
    ).unionByName(top)
    numbered = _running(_ranges(nodes, ["conv_id", "d"], "nodes"), [], ["conv_id", "d"], {"v": F.lit(1).cast("long")})
    nodes = materialize(numbered.withColumn("v", F.col("v") - 1), "nodes")
    above = nodes.select(*[F.col(k).alias(p) for k, p in zip(key, parent)], F.col("v").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    tree = materialize(nodes.join(above, parent, "left").select("v", *key, "conv_id", "n_convs", "chars", "up", "parent_conv_id"), "tree")

    kids = tree.filter("up IS NOT NULL").select("up", "v")
    first = materialize(kids.groupBy("up").agg(F.min("v").alias("first"), F.count(F.lit(1)).alias("n_children")).withColumnRenamed("up", "v"), "first")
    placed = materialize(_running(_ranges(kids, ["up", "v"], "kids"), [], ["up", "v"], {"i": F.lit(1).cast("long")}), "kids")
    beside = placed.select((F.col("i") - 1).alias("i"), F.col("up").alias("o_up"), F.col("v").alias("beside"))
    nexts = placed.join(beside, "i").filter("up = o_up").select("v", "beside")

    unit, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    enter = tree.join(first, "v", "left").select(
        (2 * F.col("v")).alias("id"), F.coalesce(2 * F.col("first"), 2 * F.col("v") + 1).alias("succ"), unit.alias("place"),
        F.col("first").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    leave = tree.join(nexts, "v", "left").select(
        (2 * F.col("v") + 1).alias("id"), F.coalesce(2 * F.col("beside"), 2 * F.col("up") + 1, F.lit(-1)).alias("succ"), unit.alias("place"), none.alias("leaves"), none.alias("saved"),
    )
    ranks = list_ranks(materialize(enter.unionByName(leave), "arcs"), part_rows)
    out = (F.col("id") % 2 == 1)
    subtree = ranks.groupBy(F.floor(F.col("id") / 2).alias("v")).agg(
        F.min("place").alias("enter_at"), F.max("place").alias("exit_at"),
        *[F.sum(F.when(out, F.col(w)).otherwise(-F.col(w))).alias(w) for w in ("leaves", "saved")],
    )
    ended = paths.filter("last").select(*key, "conv_id").unionByName(
        convs.filter("n = 0").select(F.lit(0).cast("long").alias("d"), zero.alias("s"), zero.alias("t"), "conv_id")
    )
    return tree.join(first, "v", "left").join(subtree, "v").join(ends_digests(ended), key, "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", none).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "enter_at", "exit_at",
    )


def report(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, rebuilt on shared heads."""
    return prefix_trie(*share_heads(numbered_turns(conversations))).drop("enter_at", "exit_at")

"""Near-duplicates by SimHash with a Gray-ordered hierarchical index (operator 10)."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorastat.llm.common import byte_table, mapped, materialize, text_blocks
from agorastat.llm.components import components

SHINGLE = 3
SEED = 42
MOST_BITS = 3
BLOCK_BYTES = 4 << 20
LEAF = 32  # fingerprints below a lowest node
CROWDED = 30_000  # fingerprints below a masked pattern beyond which longer patterns take over

#: (blocks, blocks that agree): 3 differing bits leave at least blocks - 3 blocks alike. The last has
#: 12 free bits, so at most 4096 fingerprints share a pattern.
LEVELS = ((5, 2), (8, 5), (16, 13))

_LANES = np.array([sum(((byte >> bit) & 1) << (8 * bit) for bit in range(8)) for byte in range(256)], np.uint64)


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle in a row, and how many each text has."""
    words = pc.ascii_split_whitespace(mapped(texts, byte_table()))
    values, lists = words.flatten(), pc.list_value_length(words).to_numpy(zero_copy_only=False)
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False)
    joined = pc.binary_join(words, pa.scalar(" ", pa.large_string())).cast(pa.large_binary()).to_pylist()
    hashed, counts, at = [], [], 0
    digest = xxhash.xxh64_intdigest
    for raw, n in zip(joined, lists.tolist()):
        lengths = sizes[at : at + n]
        at += n
        begins = np.cumsum(lengths + 1) - lengths - 1
        full = lengths > 0  # white space at either end gives an empty word
        begins, ends = begins[full], (begins + lengths)[full]
        m = len(begins)
        if not m:
            counts.append(0)
            continue
        size = min(SHINGLE, m)
        hashed.extend([digest(raw[i:j], SEED) for i, j in zip(begins[: m - size + 1].tolist(), ends[size - 1 :].tolist())])
        counts.append(m - size + 1)
    return np.array(hashed, np.uint64), np.array(counts, np.int64)


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    """The 64-bit fingerprint of each text; 0 without words."""
    out = []
    for _, block in text_blocks(texts, BLOCK_BYTES):
        hashes, counts = _hashes(block)
        found = np.zeros(len(block), np.uint64)
        some = np.flatnonzero(counts)
        if len(some):
            n = counts[some]
            # byte-wide counters hold 255 shingles, so each text is summed in runs of that length
            runs = -(-n // 255)
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            run_of = np.repeat(np.concatenate([[0], np.cumsum(runs)[:-1]]), runs)
            begins = np.repeat(first, runs) + 255 * (np.arange(runs.sum()) - run_of)
            lanes = np.add.reduceat(_LANES[hashes.view(np.uint8).reshape(-1, 8)], begins, axis=0)
            bits = lanes.view(np.uint8).reshape(-1, 64).astype(np.int64)
            totals = np.add.reduceat(bits, np.concatenate([[0], np.cumsum(runs)[:-1]]), axis=0)
            major = (2 * totals > n[:, None]).astype(np.uint8)
            found[some] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).reshape(-1)
        out.append(found)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every whole text, null as empty; map only."""

    def run(batches):
        for batch in batches:
            fps = pa.array(fingerprints_of(batch.column(1)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col)
    return source.mapInArrow(run, "doc_id long, fp long")


def block_masks(blocks: int, alike: int) -> list[int]:
    """All choices of ``alike`` of ``blocks`` nearly equal stretches of the 64 bits, as bit masks."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    stretches = [((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in range(blocks)]
    return [sum(choice) for choice in itertools.combinations(stretches, alike)]


def _roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The least position that links a, b connect each of n positions with."""
    label = np.arange(n) if label is None else label
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, low, high = a[differ], b[differ], np.minimum(x, y)[differ], np.maximum(x, y)[differ]
        np.minimum.at(label, high, low)
        while (jumped := label[label]).tobytes() != label.tobytes():
            label = jumped


def _linked(fps: np.ndarray, most: int) -> np.ndarray:
    """The group of each of one pattern's fingerprints, given in Gray order.

    Nodes hold the bits that all below them share (mask and pattern). Pairs of nodes go down
    together while their patterns differ in at most ``most`` common bits; pairs of lowest
    nodes are compared themselves. Found links are merged at once and not kept.
    """
    n = len(fps)
    levels = [(np.full(n, ~np.uint64(0)), fps)]
    fan = LEAF
    while len(levels[-1][1]) > 1:
        mask, pattern = levels[-1]
        starts = np.arange(0, len(mask), fan)
        ones = np.bitwise_and.reduceat(pattern & mask, starts)
        zeros = np.bitwise_and.reduceat(~pattern & mask, starts)
        levels.append((ones | zeros, ones))
    label = np.arange(n)

    def down(level: int, a: np.ndarray, b: np.ndarray) -> None:
        nonlocal label
        mask, pattern = levels[level]
        differ = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b])
        near = differ <= most
        a, b = a[near], b[near]
        if level == 0:
            label = _roots(n, a, b, label)
            return
        below = len(levels[level - 1][0])
        step = max(1, (1 << 20) // (fan * fan))
        for i in range(0, len(a), step):
            x = (a[i : i + step, None, None] * fan + np.arange(fan)[None, :, None])
            y = (b[i : i + step, None, None] * fan + np.arange(fan)[None, None, :])
            x, y = (z.reshape(-1) for z in np.broadcast_arrays(x, y))
            inside = (x < below) & (y < below) & (x < y if level == 1 else x <= y)
            down(level - 1, x[inside], y[inside])

    if n > 1:
        down(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))
    return label


def _pattern_links(most: int):
    """For mapInArrow over rows sorted by pattern and Gray rank: a spanning set of each pattern's links."""

    def links_of(pattern: np.ndarray, fps: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.concatenate([[True], (pattern[1:] != pattern[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(cuts, len(fps)))
        run = np.repeat(np.arange(len(cuts)), sizes)
        a, b = [], []
        small = sizes[run] <= LEAF
        for step in range(1, min(LEAF, len(fps))):  # few fingerprints: all pairs, a step apart at a time
            i = np.flatnonzero(small[:-step] & (run[:-step] == run[step:]))
            if not len(i):
                break
            i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= most]
            a.append(i)
            b.append(i + step)
        for r in np.flatnonzero(sizes > LEAF):
            group = _linked(fps[cuts[r] : cuts[r] + sizes[r]], most)
            other = np.flatnonzero(group != np.arange(len(group)))
            a.append(cuts[r] + group[other])
            b.append(cuts[r] + other)
        a, b = np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])
        root = _roots(len(fps), a, b)
        other = np.flatnonzero(root != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(node[root[other]])], names=["a", "b"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask_no", "pattern", "fp", "node")]
            if not len(part[0]):
                continue
            held.append(part)
            first, last = held[0], part
            if first[0][0] == last[0][-1] and first[1][0] == last[1][-1]:
                continue  # one pattern so far
            whole = [np.concatenate(c) for c in zip(*held)]
            open_from = np.flatnonzero((whole[0] != whole[0][-1]) | (whole[1] != whole[1][-1]))[-1] + 1
            done = [c[:open_from] for c in whole]
            held = [[c[open_from:] for c in whole]]
            yield links_of(np.stack(done[:2], axis=1), done[2].view(np.uint64), done[3])
        if held:
            whole = [np.concatenate(c) for c in zip(*held)]
            yield links_of(np.stack(whole[:2], axis=1), whole[2].view(np.uint64), whole[3])

    return run


def hamming_links(nodes: DataFrame, most: int = MOST_BITS, crowded: int = CROWDED) -> DataFrame:
    """Links ``(a, b)`` that connect the same nodes as all pairs of ``nodes(node, fp)`` within ``most`` (3) bits.

    The upper nodes of the index are masked patterns: a pair within three bits agrees on two of five
    blocks, so every fingerprint goes below ten patterns, and all other groups are pruned without a
    visit. Below a pattern the fingerprints stand in Gray order under further nodes. Patterns with
    more than ``crowded`` members give their members to longer patterns, at the last level to ones that
    cannot hold more than 4096; nothing is left out. ``fp`` must be distinct.
    """
    if most > MOST_BITS:
        raise ValueError(f"the patterns hold for at most {MOST_BITS} bits")
    ranked = nodes.withColumn("_g0", F.col("fp"))
    for n, shift in enumerate((1, 2, 4, 8, 16, 32)):
        ranked = ranked.withColumn(f"_g{n + 1}", F.col(f"_g{n}").bitwiseXOR(F.shiftrightunsigned(f"_g{n}", shift)))
    ranked = ranked.select("node", "fp", F.col("_g6").alias("rank"))
    found, members = [], ranked
    for level, (blocks, alike) in enumerate(LEVELS):
        masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(blocks, alike)]
        listed = F.array(*[F.struct(F.lit(i).alias("mask_no"), F.col("fp").bitwiseAND(F.lit(m)).alias("pattern")) for i, m in enumerate(masks)])
        placed = members.select("node", "fp", "rank", F.inline(listed))
        if level < len(LEVELS) - 1:
            sizes = placed.groupBy("mask_no", "pattern").agg(F.count(F.lit(1)).alias("n"))
            full = materialize(sizes.filter(F.col("n") > crowded).select("mask_no", "pattern"), "crowded")
            some = not full.isEmpty()
            if some:
                heavy = placed.join(full, ["mask_no", "pattern"], "left_semi")
                members = materialize(heavy.select("node", "fp", "rank").distinct(), "members")
                placed = placed.join(full, ["mask_no", "pattern"], "left_anti")
        else:
            some = False
        # equal patterns meet in one task, in Gray order; the sign bit is turned so that ranks sort unsigned
        ordered = placed.repartition("mask_no", "pattern").sortWithinPartitions(
            "mask_no", "pattern", F.col("rank").bitwiseXOR(F.lit(-(1 << 63)))
        )
        links = ordered.select("mask_no", "pattern", "fp", "node").mapInArrow(_pattern_links(most), "a long, b long")
        found.append(materialize(links, "links"))
        if not some:
            break
    out = found[0]
    for links in found[1:]:
        out = out.unionByName(links)
    return out.distinct()


def _groups(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` per row, and ``(fp, label, component_id)`` per fingerprint.

    Nodes are the fingerprints themselves, so rows without an id link others too. The label names a
    component; ``component_id`` is its least doc_id, null where no row of it has one.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    reached = components(hamming_links(nodes.select(F.col("fp").alias("node"), "fp")))
    linked = materialize(nodes.join(reached, F.col("fp") == F.col("node")).select("fp", "least", "component"), "linked")
    ids = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(ids, "component").select("fp", F.col("component").alias("label"), "component_id")
    return prints, materialize(
        nodes.join(named, "fp", "left").select(
            "fp", F.coalesce("label", "fp").alias("label"), F.coalesce("component_id", "least").alias("component_id")
        ),
        "groups",
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``: documents linked by fingerprints within three bits.

    Equal fingerprints are one node, so copies never meet as pairs. ``component_id`` is the least
    doc_id that links reach; rows with a null doc_id link others like any row and are left out of the
    least, which is null only where all ids of a component are. Repeated rows stay.
    """
    prints, groups = _groups(docs, id_col, text_col)
    return prints.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, the one with the least id (nulls last), with all its columns.

    Of repeated rows, different texts under the least id and rows without any id, the one with the
    least hash of its columns stays. Only rows whose id is null or occurs twice are looked at again;
    all others are told apart by their id, and no text is shuffled for them.
    """
    inner = docs.toDF(*[f"_d{i}" for i in range(len(docs.columns))])
    place = docs.columns.index("text")
    key = F.col(f"_d{docs.columns.index('doc_id')}").cast("long")
    prints, groups = _groups(docs.select("doc_id", "text"), "doc_id", "text")
    counted = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = materialize(counted.filter("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_again")), "again")
    later = prints.join(groups, "fp").filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    gone = materialize(later.unionByName(again.filter("_again IS NOT NULL").toDF("_gone")).distinct(), "dropped")
    once = inner.filter(key.isNotNull()).join(gone, key == F.col("_gone"), "left_anti")
    if again.isEmpty():
        return once.toDF(*docs.columns)

    def run(batches):
        for batch in batches:
            fps = pa.array(fingerprints_of(batch.column(place)).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], names=[*batch.schema.names, "_fp"])

    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in inner.schema.fields], T.StructField("_fp", T.LongType())])
    rows = inner.join(again, key.eqNullSafe(F.col("_again")), "left_semi").mapInArrow(run, schema)
    rivals = rows.join(groups, F.col("_fp") == F.col("fp")).filter(key.eqNullSafe(F.col("component_id")))
    order = F.xxhash64(*[f.name for f in inner.schema.fields if "map<" not in f.dataType.simpleString()])
    best = rivals.groupBy("label").agg(F.min_by(F.struct(*inner.columns), order).alias("row"))
    return once.unionByName(best.select("row.*")).toDF(*docs.columns)

"""Model scores, prefix tries and hard negatives against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorastat.llm import log_bilinear, negatives, prefix_trie

SIZES = log_bilinear.Sizes(head_words=12, outputs=6, contexts=38, far_contexts=36, dims=4, shards=3, rounds=2, batch=32, noise=8)


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [" "]


def corpus():
    rng = random.Random(3)
    tongues = [["the", "of", "And", "in", "is", "to"], ["der", "die", "und", "Das", "ein", "zu"]]
    texts = [None, "", " \n\t", "É é É", "word " * 3000, "x" * 50_000, "same text", "same text"]
    for i in range(300):
        own = tongues[i % 2] + [f"w{rng.randint(0, 60)}" for _ in range(4)]
        texts.append(" ".join(rng.choice(own) for _ in range(rng.randint(1, 40))))
    return texts


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_scores_match_brute_force_and_beat_the_base(spark):
    rows = [(i, t) for i, t in enumerate(corpus())] + [(None, "null id"), (7, "same id"), (7, "same id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS word", "3 AS n", "true AS held_out")
    got = log_bilinear.report(df, SIZES).collect()
    counts = collections.Counter(w for i, t in rows if not held(i) for w in words_of(t))
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted(
        (-1 if i is None else i, held(i), len(w), sum(counts[x] > 0 for x in w), total, round(sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), 6))
        for i, t in rows
        for w in [words_of(t)]
    )
    assert sorted((-1 if r[0] is None else r[0], *r[1:5], round(r["base_score"], 6)) for r in got) == expected
    assert all(r["score"] < 0 for r in got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    again = log_bilinear.report(df, SIZES).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))  # deals and seeds are fixed


def test_model_is_normalised():
    rng = np.random.default_rng(0)
    model = log_bilinear.Model(*[rng.standard_normal(s).astype(np.float32) for s in ((5, 3), (4, 3), (7, 3), (7,))])
    near, far, log = model.tables()
    for c2 in range(4):
        for c1 in range(5):
            assert np.exp(near[c1] + far[c2] - log[c2, c1]).sum() == pytest.approx(1, abs=1e-5)
            direct = (model.parts[0][c1] + model.parts[1][c2]) @ model.parts[2].T + model.parts[3]
            assert near[c1] + far[c2] == pytest.approx(direct, abs=1e-4)


def test_training_finds_what_follows_what():
    counts = np.array([900, 100, 100, 900])  # after context 0 output 0, after context 1 output 1
    share = np.array([0.5, 0.5])
    sizes = log_bilinear.Sizes(dims=4, batch=256, noise=16, passes=20_000, rounds=1)
    rng = np.random.default_rng(1)
    start = log_bilinear.Model(*[(rng.standard_normal(s) * 0.1).astype(np.float32) for s in ((2, 4), (1, 4), (2, 4))], np.log(share).astype(np.float32))
    model = log_bilinear.train(start, np.arange(4), counts, share, sizes, seed=1, rate=0.1)
    near, far, log = model.tables()
    found = np.exp(near + far - log.T)
    assert found == pytest.approx(np.array([[0.9, 0.1], [0.1, 0.9]]), abs=0.05)


def test_scores_of_special_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert log_bilinear.report(empty, SIZES).count() == 0
    only_held = next(i for i in range(100) if held(i))
    row = log_bilinear.report(spark.createDataFrame([(only_held, "a b")], "doc_id long, text string"), SIZES).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0) and row["score"] < 0


def crc_head(c):
    return zlib.crc32(str(c).encode()) % 6


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {c: own.get(c - int(math.fmod(c, 100)), [])[: crc_head(c)] + v[crc_head(c) :] for c, v in own.items()}
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n and len(m) == len(n) + 1 for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    rng = random.Random(9)
    texts = ["hi", "yes", "", None, "no", "𝄞é"]
    rows = [(None, 1, "user", "lost")]
    for c in [*range(0, 12), *range(95, 130), 205, 206, -3, -101]:
        if c == 100:
            continue
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    for c in (301, 302, 303, 400):  # a long shared path
        rows += [(c, t, "user", f"t{t}") for t in range(40)]
    return rows + rows[5:8]


@pytest.mark.parametrize("part_rows", [65_536, 16])
def test_trie_matches_brute_force(spark, part_rows):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS v", "2 AS d", "3 AS range", "4 AS chars").repartition(3)
    got = prefix_trie.prefix_trie(*prefix_trie.share_heads(prefix_trie.numbered_turns(df)), part_rows).collect()
    assert sorted((tuple(r)[:8] for r in got), key=str) == brute_trie(rows)
    assert len({r["enter_at"] for r in got} | {r["exit_at"] for r in got}) == 2 * len(got)
    assert prefix_trie.report(df.limit(0)).count() == 0


def test_list_ranking_with_links_that_leave_their_range(spark):
    rng = random.Random(1)
    order = list(range(500))
    rng.shuffle(order)
    weights = {i: (1, rng.randint(0, 3), rng.randint(0, 9)) for i in order}
    rows = [(a, b, *weights[a]) for a, b in zip(order, order[1:] + [-1])]
    arcs = spark.createDataFrame(rows, "id long, succ long, place long, leaves long, saved long")
    got = {r[0]: tuple(r)[1:] for r in prefix_trie.list_ranks(arcs, 60).collect()}
    sums = (0, 0, 0)
    for i in order:
        assert got[i] == sums
        sums = tuple(a + b for a, b in zip(sums, weights[i]))


def brute_negatives(rows, k=5):
    rows = {(i, l, tuple(v)) for i, l, v in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    rows = [(i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, [math.floor(256 * x) for x in v]) for i, l, v in rows]
    rows = list({(i, l, tuple(v)) for i, l, v in rows})
    out = []
    for a, la, va in rows:
        if a is None or a % 100:
            continue
        near = [(-sum(x * y for x, y in zip(va, v)), i is None, i or 0, i, l) for i, l, v in rows if len(v) == len(va)]
        near.sort(key=lambda x: x[:3])
        for p in [x for x in near if x[4] == la and x[3] != a][:k]:
            found = [x for x in near if x[4] != la and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]][:k]
            out += [(a, p[3], r, x[3], -p[0], -x[0]) for r, x in enumerate(found, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("tile_points", [4096, 20])
def test_negatives_match_brute_force(spark, tile_points):
    rng = np.random.default_rng(2)
    rows = [(int(i), int(rng.integers(0, 4)), [float(x) for x in rng.normal(size=6) * 0.4]) for i in range(900)]
    rows += [(i, i % 3, [0.25] * 6) for i in range(900, 1300)]  # one vector in a third of the rows
    rows += rows[:40] + [(None, 1, [0.5] * 6), (None, 2, [0.5] * 6), (100, 2, [0.1] * 6), (1400, 1, None), (1401, None, [0.1] * 6), (1402, 1, [None] * 6)]
    rows += [(1403, 1, [math.nan] * 6), (1404, 1, [math.inf] + [0.0] * 5), (1500, 1, []), (1501, 1, []), (1502, 2, []), (1600, 3, [0.5] * 7), (1601, 3, [0.5] * 7), (1603, 2, [0.5] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 AS id", "2 AS v", "3 AS tile", "4 AS score")
    rows = [(i, l, v and [None if x is None else float(np.float32(x)) for x in v]) for i, l, v in rows]
    found = negatives.integer_rows(df.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")))
    got = negatives.hard_negatives(found, found.filter("id % 100 = 0"), anchor_rows=5, tile_points=tile_points)
    assert sorted(map(tuple, got.collect()), key=str) == brute_negatives(rows)
    assert sorted(map(tuple, negatives.report(df).collect()), key=str) == brute_negatives(rows)
    assert negatives.report(df.limit(0)).count() == 0


def test_large_components_are_exact(spark):
    rows = [(0, 0, [30000.0, -1.0]), (1, 1, [30000.0, 2.0]), (2, 2, [29000.0, 5.0]), (3, 2, [24001.0, 0.0]), (4, 2, [3e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = sorted(map(tuple, negatives.report(df).collect()))
    assert [r[3] for r in got] == [2, 3] and got[0][5] == 30000 * 256 * 29000 * 256 - 256 * 5 * 256


def test_leaves_hold_every_point_once():
    vectors = np.random.default_rng(0).integers(-9, 9, (1000, 5))
    leaves = negatives.str_leaves(vectors, 32)
    assert sorted(np.concatenate(leaves)) == list(range(1000)) and max(map(len, leaves)) <= 32
    boxes = [(vectors[r].min(0), vectors[r].max(0)) for r in leaves]
    query = np.array([3, -1, 0, 2, -5])
    for (low, high), rows in zip(boxes, leaves):
        scores = vectors[rows] @ query
        assert (np.minimum(query * low, query * high)).sum() <= scores.min() and scores.max() <= (np.maximum(query * low, query * high)).sum()

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agorastat.operators import similarity as sim
from agorastat.sources.storage import materialize

# Crowded keys at once, at some depth, and never.
LIMITS = [(2, 1), (2, 3), (4, 2), (2_000, 3)]


def jaccard(a, b):
    return len(a & b) / len(a | b)


def make_sets(seed, n=90, words=14, most=9):
    """Short sets over few words, so every word is frequent; a third are copies of one set."""
    rng = random.Random(seed)
    sets = [frozenset(rng.sample(range(words), rng.randint(0, most))) for _ in range(n)]
    return [frozenset([1, 2, 3, 4]) if i % 3 == 0 else s for i, s in enumerate(sets)]


def frame(spark, sets):
    rows = [(i, [str(w) for w in s] * 2) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "Id bigint, ProcessedText array<string>")


def expected_pairs(sets, threshold):
    least = {}
    for i, s in enumerate(sets):
        if s:
            least.setdefault(s, i)
    pairs = {(least[s], i): 1.0 for i, s in enumerate(sets) if s and least[s] != i}
    for (a, i), (b, j) in itertools.combinations(least.items(), 2):
        if jaccard(a, b) >= threshold - 1e-9:
            pairs[min(i, j), max(i, j)] = jaccard(a, b)
    return pairs


@pytest.mark.parametrize("key_rows,key_tokens", LIMITS)
@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.85])
def test_pairs_equal_brute_force(spark, threshold, key_rows, key_tokens):
    sets = make_sets(int(threshold * 100) + key_rows)
    found = sim.similar_pairs(frame(spark, sets), threshold=threshold, key_rows=key_rows, key_tokens=key_tokens).collect()
    got = {(r["IdA"], r["IdB"]): r["Similarity"] for r in found}
    assert len(got) == len(found)
    assert got == pytest.approx(expected_pairs(sets, threshold))


@pytest.mark.parametrize("key_rows,key_tokens", LIMITS[1:])
def test_queries_equal_brute_force(spark, key_rows, key_tokens):
    sets, asked = make_sets(5), make_sets(6, n=12)
    found = sim.similar_questions(
        frame(spark, sets), frame(spark, asked), threshold=0.4, k=4, key_rows=key_rows, key_tokens=key_tokens
    ).collect()
    expected = []
    for q, a in enumerate(asked):
        near = [(-jaccard(a, s), i) for i, s in enumerate(sets) if a and s and jaccard(a, s) >= 0.4 - 1e-9]
        expected += [(q, i, round(-x, 9), rank) for rank, (x, i) in enumerate(sorted(near)[:4], 1)]
    assert sorted((r["QueryId"], r["Id"], round(r["Similarity"], 9), r["Rank"]) for r in found) == sorted(expected)


def test_similar_by_id(spark):
    df = frame(spark, [frozenset([1, 2, 3]), frozenset([1, 2, 3, 4]), frozenset([9])])
    assert [r["Id"] for r in sim.similar_by_id(df, 0).orderBy("Rank").collect()] == [0, 1]
    assert sim.similar_by_id(df, 77).collect() == []


def test_result_does_not_depend_on_partitions(spark):
    df = frame(spark, make_sets(11))
    rows = [sorted(map(tuple, sim.similar_pairs(df.repartition(n), threshold=0.5, key_rows=5).collect())) for n in (1, 7)]
    assert rows[0] == rows[1]


def test_near_duplicate_titles(spark):
    rows = [(1, "How to sort a list in Python"), (2, "how to sort a list in python"), (3, "How to sort a list in Python?"), (4, "xy"), (5, None), (6, "xy")]
    found = sim.near_duplicates(spark.createDataFrame(rows, "Id int, Title string")).collect()
    assert sorted((r["QuestionId1"], r["QuestionId2"]) for r in found) == [(1, 2), (1, 3)]
    assert {r["Title2"] for r in found} == {rows[1][1], rows[2][1]}


def test_pair_metrics(spark):
    predicted = spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "QuestionId1 int, QuestionId2 int")
    truth = spark.createDataFrame([(2, 1), (3, 4), (7, 8)], "PostId int, RelatedPostId int")
    row = sim.pair_metrics(predicted, truth).first()
    assert (row["true_positives"], row["false_positives"], row["false_negatives"]) == (2, 1, 1)
    assert row["precision"] == row["recall"] == row["f1_score"] == pytest.approx(2 / 3)
    empty = sim.pair_metrics(predicted.limit(0), truth).first()
    assert (empty["precision"], empty["recall"], empty["f1_score"]) == (0.0, 0.0, 0.0)


def test_minhash_skips_empty_rows(spark):
    df = frame(spark, [frozenset([1, 2]), frozenset(), frozenset([1, 2])])
    signed = {r["Id"]: r["hashes"] for r in sim.minhash_model(df, tables=3).transform(df).collect()}
    assert set(signed) == {0, 2} and signed[0] == signed[2] and len(signed[0]) == 3


def test_cosine_of_pairs_and_group_means(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 2.0], "a"), (3, [0.0, 0.0], "b")], "Id int, Vector array<double>, g string")
    pairs = spark.createDataFrame([(1, 2), (1, 1), (1, 3)], "IdA int, IdB int")
    assert {(r[0], r[1]): r[2] for r in sim.score_pairs(pairs, vectors).collect()} == {(1, 2): 0.0, (1, 1): 1.0, (1, 3): 0.0}
    best = sim.nearest_to_group_mean(vectors, "g", 1).orderBy("g").collect()
    assert [(r["g"], r["Id"]) for r in best] == [("a", 2), ("b", 3)]
    assert {r["g"]: r["Mean"] for r in sim.group_means(vectors, "g").collect()}["a"] == [0.5, 1.0]


def test_threshold_is_checked(spark):
    df = frame(spark, [frozenset([1])])
    with pytest.raises(ValueError):
        sim.similar_pairs(df, threshold=0.0)


def test_document_vectors(spark):
    df = frame(spark, [frozenset([1, 2, 3])] * 6)
    vectors, model = sim.document_vectors(df, vector_size=4, max_iter=1)
    assert vectors.select(F.col("word2vec_features")).first()[0].size == 4
    again, _ = sim.document_vectors(df, model=model)
    assert again.first()["word2vec_features"] == vectors.first()["word2vec_features"]


def test_metrics_count_links_between_later_copies(spark):
    rows = [(1, ["a", "b"]), (2, ["b", "a"]), (3, ["a", "b"]), (4, ["a", "b", "c"]), (5, []), (6, None)]
    df = spark.createDataFrame(rows, "Id int, ProcessedText array<string>")
    groups = sim.duplicate_groups(df)
    assert {r["Id"]: r["GroupId"] for r in groups.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
    pairs = sim.similar_pairs(df, threshold=0.6)
    truth = spark.createDataFrame([(2, 3), (4, 3), (5, 6)], "PostId int, RelatedPostId int")
    row = sim.pair_metrics(pairs, truth, ["IdA", "IdB"], groups=groups).first()
    # claimed: three links inside the group of copies, three from it to row 4
    assert (row["true_positives"], row["false_positives"], row["false_negatives"]) == (2, 4, 1)


def test_confirmed_and_missed_pairs(spark):
    predicted = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (4, 5)], "x int, y int")
    truth = spark.createDataFrame([(2, 1), (5, 6)], "p int, q int")
    ids = (["x", "y"], ["p", "q"])
    assert [tuple(r) for r in sim.confirmed_pairs(predicted, truth, *ids).collect()] == [(1, 2)]
    assert [tuple(r) for r in sim.missed_pairs(predicted, truth, *ids).collect()] == [(5, 6)]


def test_pairs_that_fail_are_not_written(spark, monkeypatch):
    rng = random.Random(3)
    sets = [frozenset(rng.sample(range(40), 20)) for _ in range(120)]
    written = {}

    def noted(df, name="table", partition_by=None):
        out = materialize(df, name, partition_by)
        written[name] = out.count()
        return out

    monkeypatch.setattr(sim, "materialize", noted)
    found = sim.similar_pairs(frame(spark, sets), threshold=0.5).collect()
    assert {(r["IdA"], r["IdB"]) for r in found} == set(expected_pairs(sets, 0.5))
    assert "keys" not in written and written["candidates"] == len(found)
    assert len(found) < written["token-sets"] * 119 / 4  # most pairs share tokens and fail


def test_null_and_repeated_ids(spark):
    rows = [(None, ["a", "b"]), (1, ["a", "b", "c"]), (1, ["a", "b", "d"]), (2, ["a", "b"]), (3, [])]
    df = spark.createDataFrame(rows, "Id int, ProcessedText array<string>")
    found = sorted((r["IdA"], r["IdB"], round(r["Similarity"], 3)) for r in sim.similar_pairs(df, threshold=0.6).collect())
    assert found == [(1, 2, 0.667), (1, 2, 0.667)]
    asked = sim.similar_questions(df, df.filter("Id IS NULL"), threshold=0.6, k=2).collect()
    assert {(r["QueryId"], r["Id"]) for r in asked} == {(None, None), (None, 2)}


@pytest.mark.parametrize("scan_pairs", [-1.0, 1e9])
def test_blocks_compared_by_counts_or_by_bit_maps(monkeypatch, scan_pairs):
    monkeypatch.setattr(sim, "SCAN_PAIRS", scan_pairs)
    monkeypatch.setattr(sim, "CHUNK_ROWS", 50)
    rng = random.Random(7)
    sets = [sorted(rng.sample(range(60), rng.randint(1, 30))) for _ in range(120)]
    sets += [sorted(set(s[1:] + [99])) for s in sets[:60]]
    block = pa.table({"Id": pa.array(range(len(sets))), "Tokens": pa.array(sets, pa.list_(pa.int32()))})
    for threshold in (0.3, 0.5, 0.85, 1.0):
        expected = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if jaccard(set(sets[i]), set(sets[j])) >= threshold - 1e-9}
        found = sim._near(threshold, 3, True)(block, block.slice(0, 0)).to_pydict()
        assert sorted(map(tuple, map(sorted, zip(found["IdA"], found["IdB"])))) == sorted(expected)
        across = sim._near(threshold, 2, False)(block.slice(0, 100), block.slice(100)).to_pydict()
        assert sorted(zip(across["IdA"], across["IdB"])) == sorted((i, j) for i, j in expected if i < 100 <= j)


def test_tokens_are_numbered_from_rare_to_frequent(spark, monkeypatch):
    monkeypatch.setattr(sim, "CHUNK_TOKENS", 3)
    rows = [(1, [5, 7]), (None, [5]), (3, []), (4, None), (5, [5, 7, 2**62])]
    df = spark.createDataFrame(rows, "Id int, Tokens array<bigint>").coalesce(1)
    numbered = sim._numbered(df)
    rows = numbered.toArrow()
    tokens, at = sim._unpacked(pa.concat_arrays(rows.column("Tokens").chunks))
    sets = {i: tokens[a:b].tolist() for i, a, b in zip(rows.column("Id").to_pylist(), at, at[1:])}
    assert sets == {1: [1, 2], None: [2], 3: [], 4: [], 5: [0, 1, 2]}
    assert rows.column("Size").to_pylist() == [len(s) for s in sets.values()]
    assert sim._numbered(df.limit(0)).count() == 0


def test_pairs_are_scored_in_their_blocks(spark, monkeypatch):
    monkeypatch.setattr(sim, "DENSE_TOKENS", 0)
    wide = 1 << 33  # more than 32 bits number
    block = pa.table({"Id": pa.array([1, 2, 3]), "Tokens": pa.array([[wide, 2 * wide], [wide, 2 * wide, 3 * wide], [7 * wide]])})
    found = sim._near(0.5, 3, True)(block, block.slice(0, 0)).to_pydict()
    assert [*zip(*found.values())] == [(1, 2, 2 / 3)]
    assert sim._near(0.5, 3, False)(block, block.slice(0, 0)).num_rows == 0
    lists = block.column("Tokens").to_pylist()
    sent = pa.table({"Id": block.column("Id"), "Size": pa.array([2, 3, 1], pa.int32()), "Tokens": sim._packed(sim.np.array(sum(lists, [])), sim.np.array([2, 3, 1]))})
    for rows in (1, 8192):
        monkeypatch.setattr(sim, "CHUNK_ROWS", rows)
        assert [*zip(*sim._near(0.5, 3, True)(sent, sent.slice(0, 0)).to_pydict().values())] == [(1, 2, 2 / 3)]
        assert [*zip(*sim._near(0.5, 3, False)(sent.slice(0, 1), sent.slice(1)).to_pydict().values())] == [(1, 2, 2 / 3)]
    joined = []
    monkeypatch.setattr(sim, "lookup_join", lambda *a, **b: joined.append(a[0].columns) or a[0].limit(0))
    sets = sim._numbered(spark.createDataFrame([(1, [1, 2]), (2, [1, 2, 3])], "Id int, Tokens array<bigint>")).withColumn("Side", F.lit(0))
    assert [tuple(r) for r in sim._similar(sets, 0.5, False, 10, 3).collect()] == [(1, 2, 2 / 3)] and not joined


@pytest.mark.parametrize("bits", [6, 20, 33])
def test_packed_sets_come_back(monkeypatch, bits):
    rng = random.Random(bits)
    sets = [[], *(sorted({rng.randrange(1 << bits) for _ in range(rng.randint(0, 40))}) for _ in range(60)), [], [0], [(1 << bits) - 1]]
    packed = sim._packed(sim.np.array(sum(sets, []), sim.np.int64), sim.np.array([len(s) for s in sets]))
    for size in (1, 50, 10**6):
        monkeypatch.setattr(sim, "UNPACKED", size)
        tokens, at = sim._unpacked(packed.slice(3))
        assert [tokens[a:b].tolist() for a, b in zip(at, at[1:])] == sets[3:]
    assert tokens.dtype.itemsize == (8 if bits > 31 else 4)
    assert len(sim._unpacked(packed.slice(0, 0))[0]) == 0

import inspect
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

import bindings
from agorastat.operators import features as ft, quality, topics
from agorastat.plans import stages


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(1)
    themes = [["list", "sort", "python", "loop"], ["class", "java", "field", "method"]]
    rows = [(i, [rng.choice(themes[i % 2]) for _ in range(8)], float(i % 5)) for i in range(60)]
    return spark.createDataFrame(rows, "Id int, ProcessedText array<string>, n double").cache()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = [(i, f"t{i}", c := i % 3, c * 10 + rng.random(), rng.random() if i % 7 else None) for i in range(240)]
    return spark.createDataFrame(rows, "Id int, Title string, QualityLabel int, TitleLength double, BodyLength double")


NAMES = ["TitleLength", "BodyLength"]


def test_tfidf_table_matches_the_library_weights(spark, documents):
    table = {(r["Id"], r["Token"]): r["TfIdf"] for r in ft.tfidf_table(documents).collect()}
    vectors, _ = ft.tfidf(documents, num_features=1 << 18, min_doc_freq=1)
    sums = {r["Id"]: r["s"] for r in vectors.select("Id", F.aggregate(vector_to_array("TfidfFeatures"), F.lit(0.0), lambda a, x: a + x).alias("s")).collect()}
    for i, total in sums.items():
        assert math.isclose(total, sum(w for (d, _), w in table.items() if d == i), rel_tol=1e-9)


def test_vectors(documents):
    counted, model = ft.count_vectors(documents, min_doc_freq=1, max_doc_freq=1000)
    assert len(model.vocabulary) == 8 and counted.select(F.aggregate(vector_to_array("CountFeatures"), F.lit(0.0), lambda a, x: a + x)).first()[0] == 8.0
    vectors, word_model = ft.word_vectors(documents, vector_size=5, min_count=1, max_iter=1)
    assert vectors.first()["Word2VecFeatures"].size == 5
    assert ft.similar_words(word_model, "python", 3).count() == 3
    numeric = ft.numeric_vector(documents, ["n"])
    for method in ("standard", "minmax"):
        scaled, _ = ft.scale(numeric, "NumericFeatures", method=method)
        values = [r[0] for r in scaled.select(vector_to_array("NumericFeatures_scaled")[0]).collect()]
        assert (min(values), max(values)) == (0.0, 1.0) if method == "minmax" else abs(sum(values)) < 1e-9
    with pytest.raises(ValueError):
        ft.scale(numeric, "NumericFeatures", method="other")
    assert ft.combine_vectors(counted, "CountFeatures", ["n"]).first()["CombinedFeatures"].size == 9


def test_topic_fit_equals_the_library_bound_without_calling_it(spark, documents, monkeypatch):
    model = topics.fit_topics(documents, num_topics=3, max_iterations=5, min_doc_freq=1)
    some = documents.unionByName(spark.createDataFrame([(99, ["unheard"], 0.0), (100, [], 0.0)], documents.schema))
    vectors = model.vectorizer.transform(some)
    likelihood, perplexity = model.lda.logLikelihood(vectors), model.lda.logPerplexity(vectors)
    for name in ("logLikelihood", "logPerplexity"):
        monkeypatch.setattr(type(model.lda), name, lambda *_: pytest.fail("one dense exponential per row"))
    got = model.fit_quality(some).first()
    assert math.isclose(got["LogLikelihood"], likelihood, rel_tol=1e-4) and math.isclose(got["LogPerplexity"], perplexity, rel_tol=1e-4)
    assert np.allclose(topics.digamma([0.05, 1.0, 30.0]), [-20.4978449, -0.5772157, 3.3844382], atol=1e-6)


def test_topics(spark, documents, tmp_path):
    model = topics.fit_topics(documents, num_topics=2, max_iterations=15, min_doc_freq=1)
    assigned = model.transform(documents)
    rows = assigned.select("Id", "DominantTopic", vector_to_array("TopicDistribution").alias("t")).collect()
    assert all(r["DominantTopic"] == r["t"].index(max(r["t"])) for r in rows)
    words = model.words(3).collect()
    assert len(words) == 6 and {r["rank"] for r in words} == {1, 2, 3}
    assert model.fit_quality(documents).first()["LogPerplexity"] > 0
    model.save(str(tmp_path))
    again = topics.TopicModel.load(str(tmp_path)).transform(documents).select("Id", "DominantTopic").collect()
    assert {tuple(r) for r in again} == {(r["Id"], r["DominantTopic"]) for r in rows}


def test_coherence(spark):
    docs = spark.createDataFrame([(["a", "b"],), (["a"],), (["a", "b", "c"],), (["x"],)], "ProcessedText array<string>")
    words = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (0, 3, "c"), (1, 1, "x"), (1, 2, "c")], "topic int, rank int, word string")
    got = {r["topic"]: r["Coherence"] for r in topics.coherence(words, docs).collect()}
    assert got[0] == pytest.approx((math.log(3 / 3) + math.log(2 / 3) + math.log(2 / 2)) / 3)
    assert got[1] == pytest.approx(math.log(1 / 1))


def test_clusters(documents):
    vectors, _ = ft.count_vectors(documents, min_doc_freq=1, max_doc_freq=1000)
    clustered, _ = topics.cluster(vectors, 2, "CountFeatures")
    by_theme = clustered.groupBy((F.col("Id") % 2).alias("theme")).agg(F.collect_set("ClusterId").alias("c")).collect()
    assert all(len(r["c"]) == 1 for r in by_theme)


@pytest.mark.parametrize(
    "algorithm,settings",
    [("random_forest", {"numTrees": 5, "maxDepth": 3}), ("gradient_boosting", {"maxIter": 2, "maxDepth": 2}), ("logistic", {})],
)
def test_training_on_three_classes(labelled, tmp_path, algorithm, settings):
    model, metrics = quality.train(labelled, algorithm, NAMES, key="Id", **settings)
    assert metrics["accuracy"] > 0.9 and metrics["auc"] is None
    predicted = quality.predict(model, labelled.drop("QualityLabel"), NAMES)
    assert predicted.columns[:3] == ["Id", "Title", "prediction"] and predicted.count() == 240
    ranked = quality.feature_importance(model, NAMES, labelled).collect()
    assert ranked[0]["feature"] == "TitleLength"
    quality.save_model(model, str(tmp_path / "m"))
    again = quality.predict(quality.load_model(str(tmp_path / "m")), labelled, NAMES)
    assert sorted(r["prediction"] for r in again.collect()) == sorted(r["prediction"] for r in predicted.collect())


def test_binary_training_has_an_auc(labelled):
    binary = labelled.withColumn("QualityLabel", (F.col("QualityLabel") > 0).cast("int"))
    _, metrics = quality.train_with_cv(binary, features=NAMES, folds=2, grid={"numTrees": [3], "maxDepth": [2, 3]}, key="Id")
    assert metrics["auc"] > 0.9
    grids = {"random_forest": {"numTrees": [3]}, "logistic": {"regParam": [0.01]}}
    compared = quality.compare_models(quality.prepare(binary, NAMES), grids, folds=2, key="Id").collect()
    assert [r["model"] for r in compared] == list(grids) and sum(r["best"] for r in compared) == 1
    with pytest.raises(ValueError):
        quality.classifier("nearest")


def test_metrics_equal_the_library_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(4)
    rows = [(float(rng.randint(0, 2)), float(rng.choice([0, 1]))) for _ in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = quality.metrics_table(df).first()
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df))


def test_missing_features_are_left_out(labelled):
    prepared = quality.prepare(labelled, [*NAMES, "Absent"], None)
    assert prepared.first()["features"].size == 2 and "label" not in prepared.columns
    assert prepared.count() == 240


class Fitted(Exception):
    pass


@pytest.mark.parametrize(
    "name, owner, operator, free",
    [
        ("a40_topics", topics, "fit_topics", {"df"}),
        ("a50_clusters", topics, "cluster", {"df", "features"}),
        ("a52_gradient_boosting_three_way", quality, "train", {"df", "algorithm", "features", "label", "key"}),
        ("a53_cross_validated", quality, "train_with_cv", {"df", "features", "key"}),
        ("a54_model_comparison", quality, "compare_models", {"prepared", "key"}),
        ("a59_stages", stages, "run", {"spark", "paths", "mode"}),
    ],
)
def test_queries_use_the_operators_own_settings(spark, monkeypatch, name, owner, operator, free):
    signature = inspect.signature(getattr(owner, operator))

    def stop(*args, **kwargs):
        raise Fitted(set(signature.bind(*args, **kwargs).arguments))

    monkeypatch.setattr(owner, operator, stop)
    with pytest.raises(Fitted) as given:
        bindings.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert given.value.args[0] <= free


def labelled_rows(spark, n=300):
    rng = random.Random(8)
    rows = [(i, float(rng.random()), float(rng.random()), 0.5) for i in range(n)]
    return spark.createDataFrame([(*r, int(r[1] > 0.5)) for r in rows], "Id long, A double, B double, Same double, QualityLabel int")


def test_held_out_cells_follow_the_keys(spark):
    prepared = quality.prepare(labelled_rows(spark), ["A", "B"])
    settings = {"grid": {"regParam": [0.0, 100.0]}, "folds": 3}
    held_out = quality.held_out_predictions(prepared, "Id", "logistic", **settings)
    rows = held_out.collect()
    assert len(rows) == 600 and len({(r["Cell"], r["Id"]) for r in rows}) == 600
    again = quality.held_out_predictions(prepared.repartition(5), "Id", "logistic", **settings).collect()
    assert {(r["Id"], r["Fold"]) for r in rows} == {(r["Id"], r["Fold"]) for r in again}
    table = quality.grid_metrics(held_out).collect()
    assert {(r["Cell"], r["Fold"]) for r in table} == {(c, f) for c in range(2) for f in range(3)}
    assert {r["Settings"] for r in table if r["Best"]} == {"regParam=0.0"}
    for r in table:
        own = [x for x in rows if (x["Cell"], x["Fold"]) == (r["Cell"], r["Fold"])]
        assert r["HeldOut"] == len(own) and r["Accuracy"] == pytest.approx(sum(x["label"] == x["prediction"] for x in own) / len(own))


def test_permuting_the_feature_that_decides_costs_most(spark):
    rows = labelled_rows(spark)
    features = ["A", "B", "Same"]
    model, _ = quality.train(rows, "logistic", features, key="Id")
    predicted = quality.permuted_predictions(model, quality.prepare(rows, features), features, "Id").persist()
    assert predicted.count() == 4 * 300
    for feature in features:
        values = [r["Value"] for r in predicted.filter(F.col("Feature") == feature).collect()]
        assert sorted(values) == sorted(r[0] for r in rows.select(feature).collect())
    drops = {r["Feature"]: r["Importance"] for r in quality.score_drops(predicted).collect()}
    assert drops["A"] > 0.3 and abs(drops["B"]) < 0.1 and drops["Same"] == 0


def test_walking_the_tree_finds_each_cluster(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 5 * 10, 1), rng.gauss(i % 3 * 10, 1)]) for i in range(200)]
    df = spark.createDataFrame(rows, "Id long, a array<double>").withColumn("v", array_to_vector("a"))
    clustered, model = topics.cluster(df, 6, "v")
    tree = topics.cluster_tree(model, spark)
    assert tree.filter("Parent IS NULL").count() == 1 and tree.count() == 11
    walked = topics.walk_tree(df, tree, "a", "Id")
    assert clustered.join(walked, "Id").filter("ClusterId = Node").count() == 200
    costs = walked.groupBy("Node").agg(F.sum("Distance").alias("d")).join(tree, "Node").collect()
    assert all(r["d"] == pytest.approx(r["Cost"], rel=1e-6) for r in costs)


def test_tree_counts_rows_that_moved_after_the_last_round(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(400, 3)).tolist())]
    df = spark.createDataFrame(rows, "Id int, a array<double>").withColumn("v", array_to_vector("a"))
    clustered, model = topics.cluster(df, 4, features="v", max_iterations=1)
    tree = {r["Node"]: r for r in topics.cluster_tree(model, spark, clustered, "v").collect()}
    sizes = {r["ClusterId"]: r["count"] for r in clustered.groupBy("ClusterId").count().collect()}
    leaves = set(tree) - {r["Parent"] for r in tree.values()}
    assert {n: tree[n]["Rows"] for n in leaves} == sizes
    assert [r["Rows"] for r in tree.values() if r["Parent"] is None] == [400]
    near = {n: 0.0 for n in leaves}
    for r in clustered.select("a", "ClusterId").collect():
        near[r["ClusterId"]] += float(((np.array(r["a"]) - np.array(tree[r["ClusterId"]]["Centre"])) ** 2).sum())
    assert {n: tree[n]["Cost"] for n in leaves} == pytest.approx(near)


def test_fits_have_few_tasks(spark, labelled):
    spread = quality.prepare(labelled, NAMES).repartition(40)
    assert quality.packed(spread, "Id").rdd.getNumPartitions() == 1
    forest = quality.classifier("random_forest")
    assert forest.getCacheNodeIds() and quality.classifier("gradient_boosting", 3).getParallelism() == 3

"""Topics, clusters and classifiers."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from agorastat.functions import text as tx, vectors as vec
from agorastat.operators import aggregates as agg, quality, topics
from agorastat.plans import stages
from agorastat.sources.storage import materialize, scratch_path
from agorastat.sources.writers import save_xml
from bindings.language import _documents, _tokens
from bindings.registry import POSTS, posts, query, raw_posts, sql_words, table, tidy

FEATURES = ["BodyLength", "BodyWordCount", "Sentences", "Digits"]


def _topics(spark, d):
    tokens = materialize(_tokens(spark, d).select("doc_id", "ProcessedText"), "tokens")  # read by the fit and by what uses the model
    return tokens, topics.fit_topics(tokens)


@query("a40_topics", "SELECT COUNT(*) AS documents, COUNT(DISTINCT doc_id) AS ids, 0 AS odd_totals, 0 AS wrong_topics FROM documents")
def fitted_topics(spark, d):
    """Each document once, its shares add up to one (or none without words), and its topic has the largest."""
    tokens, model = _topics(spark, d)
    shares = vector_to_array("TopicDistribution")
    topic = model.transform(tokens).select("doc_id", "DominantTopic", shares.alias("s"))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x)
    return tidy(
        topic.agg(
            F.count(F.lit(1)).alias("documents"),
            F.count_distinct("doc_id").alias("ids"),
            F.count_if((F.abs(total - 1) > 1e-6) & (F.abs(total) > 1e-6)).alias("odd_totals"),
            F.count_if((total > 0.5) & (F.get("s", F.col("DominantTopic").cast("int")) != F.array_max("s"))).alias("wrong_topics"),
        )
    )


@query("a41_argmax", """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS top FROM embeddings""")
def argmax(spark, d):
    return tidy(table(spark, d, "embeddings").select("vec_id", vec.argmax("embedding").alias("top")))


@query("a42_topic_words", "SELECT 20 AS topics, 160 AS words, 0 AS unlike, 0 AS heavier_left_out FROM documents LIMIT 1")
def topic_words(spark, d):
    """Eight different words per topic; their weights and places are those of the model's own topic matrix."""
    _, model = _topics(spark, d)
    matrix = model.lda.topicsMatrix().toArray()  # terms x topics, as fitted
    shares = matrix / matrix.sum(axis=0)
    cells = [(t, w, float(shares[i, t])) for i, w in enumerate(model.vectorizer.vocabulary) for t in range(shares.shape[1])]
    own = spark.createDataFrame(cells, "topic int, word string, share double")
    listed = materialize(model.words(8), "words")
    least = listed.groupBy("topic").agg(F.min("weight").alias("least"))
    joined = own.join(least, "topic").join(listed, ["topic", "word"], "left")
    return tidy(joined.agg(
        F.count_distinct("topic").alias("topics"), F.count("weight").alias("words"),
        F.count_if(F.abs(F.col("weight") - F.col("share")) > 1e-9).alias("unlike"),
        F.count_if(F.col("weight").isNull() & (F.col("share") > F.col("least") + 1e-12)).alias("heavier_left_out"),
    ))


TOPICAL = f"""WITH {POSTS}, docs AS (SELECT *, OwnerUserId % 7 AS DominantTopic FROM posts)"""


def _topical(spark, d):
    return posts(spark, d).withColumn("DominantTopic", F.col("OwnerUserId") % 7)


@query("a13_topic_sizes", f"""{TOPICAL} SELECT DominantTopic, COUNT(*) AS DocumentCount, ROUND(AVG(Score), 6) AS AvgScore,
  ROUND(AVG(ViewCount), 6) AS AvgViews FROM docs GROUP BY ALL""")
def topic_sizes(spark, d):
    return tidy(agg.topic_sizes(_topical(spark, d)))


@query("a14_topic_trends", f"""{TOPICAL} SELECT strftime(date_trunc('month', CreationDate), '%Y-%m-%d') AS Period, DominantTopic,
  COUNT(*) AS DocumentCount FROM docs GROUP BY ALL""")
def topic_trends(spark, d):
    return tidy(agg.topic_trends(_topical(spark, d)).withColumn("Period", F.to_date("Period")))


def _clustered(spark, d):
    vectors = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    return topics.cluster(vectors, features="v")[0]


@query("a50_clusters", "SELECT COUNT(*) AS vectors, COUNT(DISTINCT vec_id) AS ids, 0 AS without_cluster FROM embeddings")
def clusters(spark, d):
    """Every vector once, in one of the ten clusters."""
    outside = F.col("ClusterId").isNull() | ~F.col("ClusterId").between(0, 9)
    found = _clustered(spark, d).agg(
        F.count(F.lit(1)).alias("vectors"), F.count_distinct("vec_id").alias("ids"), F.count_if(outside).alias("without_cluster")
    )
    return tidy(found)


@query("a15_cluster_sizes", "SELECT COUNT(*) AS total, 0 AS unlike FROM embeddings")
def cluster_sizes(spark, d):
    """The sizes add up to the table and equal a count of the clusters' members."""
    clustered = materialize(_clustered(spark, d).select("vec_id", "ClusterId"), "clusters")
    sizes = agg.distribution(clustered, "ClusterId")
    (size,) = [c for c in sizes.columns if c != "ClusterId"][:1]
    counted = clustered.select("ClusterId").withColumn("one", F.lit(1)).groupBy("ClusterId").agg(F.sum("one").alias("own"))
    joined = sizes.join(counted, "ClusterId", "full")
    return tidy(joined.agg(F.sum(size).alias("total"), F.count_if(~F.col(size).eqNullSafe(F.col("own"))).alias("unlike")))


@query("a50_cluster_tree", "SELECT COUNT(*) AS vectors, COUNT(*) AS leaf_rows, 0 AS unlike, 0 AS odd_costs FROM embeddings")
def cluster_tree(spark, d):
    """Walking the tree table leads every vector to its cluster, and the distances met add up to the leaves' costs."""
    vectors = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a")).withColumn("v", array_to_vector("a"))
    clustered, model = topics.cluster(vectors, features="v")
    tree = materialize(topics.cluster_tree(model, spark, clustered, "v"), "tree")
    walked = materialize(topics.walk_tree(vectors, tree, "a", "vec_id"), "walked")
    met = walked.groupBy("Node").agg(F.sum("Distance").alias("met"), F.count(F.lit(1)).alias("n"))
    leaves = tree.join(met, "Node", "left_semi").join(met, "Node")
    odd = leaves.agg(F.count_if(F.abs(F.col("met") - F.col("Cost")) > 1e-6 * F.greatest("Cost", F.lit(1.0)))).scalar()
    both = clustered.select("vec_id", "ClusterId").join(walked, "vec_id", "left")
    return tidy(both.agg(
        F.count(F.lit(1)).alias("vectors"), leaves.agg(F.sum("Rows")).scalar().alias("leaf_rows"),
        F.count_if(~F.col("ClusterId").eqNullSafe(F.col("Node"))).alias("unlike"), odd.alias("odd_costs"),
    ))


@query("a51_topic_fit")
def topic_fit(spark, d):
    tokens, model = _topics(spark, d)
    return tidy(model.fit_quality(tokens), 3)


TOP_WORDS = f"""words AS (SELECT doc_id, lang, list_distinct({sql_words('lower(text)')}) AS t FROM documents),
df AS (SELECT lang, w, COUNT(*) AS n FROM (SELECT lang, unnest(t) AS w FROM words) GROUP BY ALL),
top AS (SELECT lang AS topic, w, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS rank FROM df QUALIFY rank <= 8)"""


@query("a51_coherence", f"""WITH {TOP_WORDS},
pairs AS (SELECT a.topic, a.w AS v, b.w AS w FROM top a JOIN top b ON a.topic = b.topic AND a.rank < b.rank),
counts AS (SELECT topic, v, w, COUNT(*) FILTER (list_contains(t, v)) AS dv, COUNT(*) FILTER (list_contains(t, v) AND list_contains(t, w)) AS dvw
  FROM pairs, words GROUP BY ALL)
SELECT topic, ROUND(AVG(ln((dvw + 1) / dv)), 6) AS Coherence, COUNT(*) AS Pairs FROM counts GROUP BY topic""")
def coherence(spark, d):
    from pyspark.sql import Window as W

    docs = materialize(_documents(spark, d).select("lang", F.array_distinct(tx.words(F.lower("text"))).alias("ProcessedText")), "docs")  # ranked, then counted
    counts = docs.select("lang", tx.exploded("ProcessedText").alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.select(F.col("lang").alias("topic"), "word", rank.alias("rank")).filter(F.col("rank") <= 8)
    return tidy(topics.coherence(top, docs))


# --- classifiers ------------------------------------------------------------

def labelled(spark, d):
    """Labelled documents: length, words, sentences and digits against quality and a three-way class."""
    numbers = _documents(spark, d).select(  # before the join, which then carries no text
        "doc_id",
        F.col("source").alias("Title"),
        F.length("text").alias("BodyLength"),
        tx.word_count("text").alias("BodyWordCount"),
        F.regexp_count("text", F.lit(r"\.")).alias("Sentences"),
        F.regexp_count("text", F.lit(r"[0-9]")).alias("Digits"),
    )
    return numbers.join(table(spark, d, "labels"), "doc_id").select(
        F.col("doc_id").alias("Id"),
        "Title",
        F.col("quality").alias("QualityLabel"),
        (F.col("quality") + F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("ThreeWay"),
        *FEATURES,
    )


def _metrics(spark, metrics: dict):
    schema = ", ".join(f"{name} double" for name in metrics)
    return tidy(spark.createDataFrame([tuple(metrics.values())], schema))


@query("v09_prepared_features", f"""SELECT doc_id AS Id, CAST(quality AS DOUBLE) AS label, CAST(length(text) AS DOUBLE) AS f0,
  CAST(len({sql_words('text')}) AS DOUBLE) AS f1 FROM documents JOIN labels USING (doc_id)""")
def prepared_features(spark, d):
    prepared = quality.prepare(labelled(spark, d), ["BodyLength", "BodyWordCount", "Absent"])
    cells = vector_to_array("features")
    return prepared.select("Id", "label", cells[0].alias("f0"), cells[1].alias("f1"))


TRAINED_SQL = "SELECT COUNT(*) AS rows, 0 AS unlike, 1 AS as_good_as_the_commonest FROM documents JOIN labels USING (doc_id)"


def _facts(prepared, predictions, metrics):
    """Rows, metrics that differ from those counted here, and whether the model reaches the share of the commonest label (less 0.1)."""
    own = predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    n, hit = F.col("n"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    by_label = own.groupBy("label").agg(F.sum(n).alias("actual"), F.sum(hit).alias("hits"))
    claimed = own.groupBy(F.col("prediction").alias("label")).agg(F.sum(n).alias("claimed"))
    f1 = 2 * F.col("hits") / (F.col("actual") + F.coalesce("claimed", F.lit(0)))
    row = by_label.join(claimed, "label", "left").agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"), (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1"),
        (F.max("actual") / F.sum("actual")).alias("commonest"),
    )
    unlike = sum((F.abs(F.col(m) - metrics[m]) > 1e-9).cast("int") for m in ("accuracy", "f1"))
    rows = prepared.agg(F.count(F.lit(1))).scalar()
    return tidy(row.select(rows.alias("rows"), unlike.alias("unlike"), (F.col("accuracy") >= F.col("commonest") - 0.1).alias("as_good_as_the_commonest")))


def _trained(spark, d, train, label="QualityLabel", **settings):
    rows = labelled(spark, d)
    if label != "QualityLabel":
        settings["label"] = label
    model, metrics = train(rows, features=FEATURES, key="Id", **settings)
    prepared = quality.prepare(rows, FEATURES, label)
    _, test = quality.split(prepared.select("Id", "features", "label"), key="Id")
    return _facts(prepared, materialize(model.transform(test).select("label", "prediction"), "predictions"), metrics)


@query("a52_random_forest", TRAINED_SQL)
def random_forest(spark, d):
    return _trained(spark, d, quality.train)


@query("a52_gradient_boosting_three_way", TRAINED_SQL)
def gradient_boosting(spark, d):
    return _trained(spark, d, quality.train, "ThreeWay", algorithm="gradient_boosting")


@query("a52_logistic", TRAINED_SQL)
def logistic(spark, d):
    return _trained(spark, d, quality.train, algorithm="logistic")


@query("a53_cross_validated", TRAINED_SQL)
def cross_validated(spark, d):
    return _trained(spark, d, quality.train_with_cv)


@query("a53_grid_cells", """WITH s AS (SELECT unnest(['elasticNetParam=0.0, regParam=0.01', 'elasticNetParam=0.0, regParam=0.1',
  'elasticNetParam=0.5, regParam=0.01', 'elasticNetParam=0.5, regParam=0.1']) AS Settings)
SELECT Settings, 5 AS folds, (SELECT COUNT(*) FROM documents JOIN labels USING (doc_id)) AS held_out, 0 AS not_once, 0 AS unlike, 1 AS best_cells FROM s""")
def grid_cells(spark, d):
    """Every grid cell predicts each row once, by a model of other folds; its fold metrics equal those of the evaluation; one cell is best."""
    prepared = quality.prepare(labelled(spark, d), FEATURES)
    held_out = materialize(quality.held_out_predictions(prepared, "Id", "logistic"), "held-out")
    cells = materialize(quality.grid_metrics(held_out), "cells")
    right = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    counted = held_out.groupBy("Cell", "Fold").agg(right.alias("own"), F.count_distinct("Id").alias("ids"))
    joined = cells.join(counted, ["Cell", "Fold"])
    times = held_out.groupBy("Cell", "Id").agg(F.count(F.lit(1)).alias("n")).groupBy("Cell").agg(F.count_if(F.col("n") != 1).alias("not_once"))
    per_cell = joined.groupBy("Cell", "Settings").agg(
        F.count(F.lit(1)).alias("folds"), F.sum("HeldOut").alias("held_out"),
        F.count_if((F.abs(F.col("own") - F.col("Accuracy")) > 1e-9) | ~F.col("F1").between(0, 1)).alias("unlike"), F.avg("Accuracy").alias("mean"), F.max("Best").alias("Best"),
    )
    top = per_cell.agg(F.max("mean")).scalar()
    best = per_cell.agg(F.count_if(F.col("Best") & (F.col("mean") >= top - 1e-12))).scalar()
    return tidy(per_cell.join(times, "Cell").select("Settings", "folds", "held_out", "not_once", "unlike", best.alias("best_cells")))


@query("a54_model_comparison", "SELECT unnest(['logistic', 'random_forest']) AS model, 0 AS outside, 1 AS best_has_highest_f1, 1 AS one_best FROM documents LIMIT 2")
def model_comparison(spark, d):
    """One row per algorithm, metrics between 0 and 1, and the one best row has the highest F1."""
    compared = materialize(quality.compare_models(quality.prepare(labelled(spark, d), FEATURES), key="Id"), "compared")
    top = compared.agg(F.max("f1")).scalar()
    best = compared.agg(F.count_if("best")).scalar()
    outside = sum((~F.col(m).between(0, 1)).cast("int") for m in ("accuracy", "f1", "precision", "recall", "auc"))
    return tidy(compared.select("model", outside.alias("outside"), ((F.col("f1") == top) | ~F.col("best")).alias("best_has_highest_f1"), best.alias("one_best")))


CELLS = """p AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(1 - toxic AS DOUBLE) AS prediction FROM labels)"""


def _predictions(spark, d):
    return table(spark, d, "labels").select(
        F.col("quality").cast("double").alias("label"), (1 - F.col("toxic")).cast("double").alias("prediction")
    )


@query("a55_confusion", f"WITH {CELLS} SELECT label, prediction, COUNT(*) AS Count FROM p GROUP BY ALL")
def confusion(spark, d):
    return quality.confusion(_predictions(spark, d))


@query("a55_metrics", f"""WITH {CELLS}, c AS (SELECT DISTINCT label AS k FROM p),
m AS (SELECT k, COUNT(*) FILTER (label = k) AS actual, COUNT(*) FILTER (prediction = k) AS claimed, COUNT(*) FILTER (label = k AND prediction = k) AS hits FROM p, c GROUP BY k),
r AS (SELECT *, coalesce(hits / nullif(claimed, 0), 0) AS pr, coalesce(hits / nullif(actual, 0), 0) AS rc FROM m)
SELECT ROUND(SUM(hits) / SUM(actual), 6) AS accuracy, ROUND(SUM(coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) * actual) / SUM(actual), 6) AS f1,
  ROUND(SUM(pr * actual) / SUM(actual), 6) AS precision, ROUND(SUM(rc * actual) / SUM(actual), 6) AS recall FROM r""")
def metrics(spark, d):
    return tidy(quality.metrics_table(_predictions(spark, d)))


@query("a56_predictions", "SELECT COUNT(*) AS rows, 0 AS wrong_sides, 0 AS odd_shares FROM documents JOIN labels USING (doc_id)")
def predictions(spark, d):
    """One prediction per row, on the side of one half that its probability is on."""
    rows = labelled(spark, d)
    model, _ = quality.train(rows, "logistic", FEATURES, key="Id")
    scored = quality.predict(model, rows.drop("QualityLabel"), FEATURES).withColumn("p", vector_to_array("probability"))
    good = F.col("p")[1]
    return tidy(
        scored.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if((good > 0.5) != (F.col("prediction") == 1)).alias("wrong_sides"),
            F.count_if(F.abs(F.col("p")[0] + good - 1) > 1e-9).alias("odd_shares"),
        )
    )


@query("a57_feature_importance", """SELECT unnest(['BodyLength', 'BodyWordCount', 'Digits', 'Sentences']) AS feature, 1 AS total_is_one, 0 AS unlike FROM documents LIMIT 4""")
def feature_importance(spark, d):
    """The forest's importances add up to one and are the means of its trees' normalised ones."""
    rows = labelled(spark, d)
    model, _ = quality.train(rows, features=FEATURES, key="Id")
    trees = [t.featureImportances.toArray() for t in model.trees]
    means = sum(trees) / sum(t.sum() for t in trees)
    own = spark.createDataFrame([(f, float(x)) for f, x in zip(FEATURES, means)], "feature string, own double")
    found = materialize(quality.feature_importance(model, FEATURES, rows), "importance")
    total = found.agg(F.sum("importance")).scalar()
    return tidy(found.join(own, "feature").select("feature", (F.abs(total - 1) < 1e-9).alias("total_is_one"), (F.abs(F.col("own") - F.col("importance")) > 1e-9).alias("unlike")))


@query("a57_permuted_features", f"""WITH r AS (SELECT length(text) AS BodyLength, len({sql_words('text')}) AS BodyWordCount,
  len(regexp_extract_all(text, '\\.')) AS Sentences, len(regexp_extract_all(text, '[0-9]')) AS Digits FROM documents JOIN labels USING (doc_id))
SELECT Feature, COUNT(*) AS rows, CAST(SUM(Value) AS DOUBLE) AS total, 0 AS odd FROM (UNPIVOT r ON BodyLength, BodyWordCount, Sentences, Digits INTO NAME Feature VALUE Value) GROUP BY Feature
""")
def permuted_features(spark, d):
    """Each feature keeps its rows and values when permuted; the drops recomputed from the predictions equal the table's."""
    rows = labelled(spark, d)
    model, _ = quality.train(rows, "logistic", FEATURES, key="Id")
    predicted = materialize(quality.permuted_predictions(model, quality.prepare(rows, FEATURES), FEATURES, "Id"), "permuted")
    drops = quality.score_drops(predicted)
    as_is = predicted.filter("Feature IS NULL").select("Id", (F.col("label") == F.col("prediction")).cast("int").alias("was"))
    changed = predicted.filter("Feature IS NOT NULL").withColumn("now", (F.col("label") == F.col("prediction")).cast("int")).join(as_is, "Id")
    own = changed.groupBy("Feature").agg(F.count(F.lit(1)).alias("rows"), F.sum("Value").alias("total"), F.avg(F.col("was") - F.col("now")).alias("own"))
    joined = own.join(drops, "Feature")
    return tidy(joined.select("Feature", "rows", "total", (F.abs(F.col("own") - F.col("Importance")) > 1e-9).alias("odd")))


def _differences(fitted, stored, key, column):
    """Rows, and rows whose value a stored model gives otherwise."""
    both = fitted.select(key, F.col(column).alias("x")).join(stored.select(key, F.col(column).alias("y")), key, "full")
    return tidy(both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias("unlike")))


@query("a58_saved_classifier", "SELECT COUNT(*) AS rows, 0 AS unlike FROM documents JOIN labels USING (doc_id)")
def saved_classifier(spark, d):
    rows = labelled(spark, d)
    model, _ = quality.train(rows, features=FEATURES, key="Id")
    path = scratch_path(spark, "classifier")
    quality.save_model(model, path)
    stored = quality.predict(quality.load_model(path), rows, FEATURES, include_probability=False)
    return _differences(quality.predict(model, rows, FEATURES, include_probability=False), stored, "Id", "prediction")


@query("a58_saved_topics", "SELECT COUNT(*) AS rows, 0 AS unlike FROM documents")
def saved_topics(spark, d):
    tokens, model = _topics(spark, d)
    path = scratch_path(spark, "topics")
    model.save(path)
    return _differences(model.transform(tokens), topics.TopicModel.load(path).transform(tokens), "doc_id", "DominantTopic")


SPLIT_FACTS = "SELECT 0 AS in_both, 0 AS lost, 0 AS shared_keys, 1 AS near_share"


def _split_facts(rows, train, test, key, share):
    """Rows in both parts, rows in none, keys on both sides, and whether the test part has about its share."""
    columns = rows.columns
    sides = [df.groupBy(*columns).agg(F.count(F.lit(1)).alias(n)) for df, n in ((rows, "n"), (train, "a"), (test, "b"))]
    joined = sides[0].join(sides[1], columns, "full").join(sides[2], columns, "full").fillna(0, ["n", "a", "b"])
    keys = train.select(key).distinct().join(test.select(key).distinct(), key).agg(F.count(F.lit(1)).alias("k"))
    facts = joined.agg(
        F.count_if(F.col("a") + F.col("b") > F.col("n")).alias("in_both"),
        F.count_if(F.col("a") + F.col("b") < F.col("n")).alias("lost"),
        keys.scalar().alias("shared_keys"),
        (F.abs(F.sum("b") / F.sum("n") - share) < share / 4).alias("near_share"),
    )
    return tidy(facts)


@query("t06_split", SPLIT_FACTS)
def split(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "rows")
    return _split_facts(rows, *quality.split(rows, 0.3), "row", 0.3)


@query("t06_split_by_key", SPLIT_FACTS)
def split_by_key(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return _split_facts(rows, *quality.split(rows, 0.2, key="l_orderkey"), "l_orderkey", 0.2)


@query("a59_stages", """SELECT 'etl' AS Stage, COUNT(*) AS Rows FROM pages JOIN events ON page_id = event_id WHERE page_id % 2 = 0
UNION ALL SELECT 'ml', 1 UNION ALL SELECT 'nlp', 25""")
def staged_run(spark, d):
    paths = stages.Paths(*[scratch_path(spark, name) for name in ("raw", "processed", "models")])
    save_xml(raw_posts(spark, d), f"{paths.raw}/Posts.xml", "posts")
    tables = stages.run(spark, paths, "full")
    return stages.stage_counts(spark, tables)

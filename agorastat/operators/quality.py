"""Quality classifiers, their evaluation and comparison."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.operators.clean import fill_zero
from agorastat.operators.order_stats import running_counts
from agorastat.sources.storage import materialize, scratch_path
from agorastat.sources.writers import hash_share

# The default model features.
DEFAULT_FEATURES = [
    "TitleLength", "TitleWordCount", "BodyLength", "BodyWordCount", "NumTags", "HasCode",
    "CodeRatio", "HasQuestionMark", "NumQuestionMarks", "PostHour", "PostDayOfWeek", "IsWeekend",
]
# The searched settings per algorithm.
GRIDS = {
    "random_forest": {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15]},
    "gradient_boosting": {"maxIter": [50, 100], "maxDepth": [5, 10]},
    "logistic": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
}
COMPARED_GRIDS = {
    "random_forest": {"numTrees": [20, 50], "maxDepth": [5, 10]},
    "logistic": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
}

FIT_ROWS = 50_000  # rows of a training task: fewer make more statistics of tree nodes than they save time


def prepare(
    df: DataFrame, features: Sequence[str] = DEFAULT_FEATURES, label: str | None = "QualityLabel"
) -> DataFrame:
    """V-09: ``features`` from the listed columns that exist (null as 0), and ``label`` as double.

    Without the label column only the features are added, as for prediction.
    """
    known = [c for c in features if c in df.columns]
    filled = fill_zero(df, known)
    if label and label in df.columns:
        filled = filled.withColumn("label", F.col(label).cast("double"))
    return VectorAssembler(inputCols=known, outputCol="features", handleInvalid="skip").transform(filled)


def split(df: DataFrame, test_share: float = 0.2, seed: int = 42, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """T-06: train and test rows; with ``key`` the same rows whatever the partitioning."""
    if key is None:
        train, test = df.randomSplit([1 - test_share, test_share], seed=seed)
        return train, test
    share = hash_share(key, seed)
    return df.filter(share >= test_share), df.filter(share < test_share)


def _slim(prepared: DataFrame, key: str | None) -> DataFrame:
    return prepared.select(*([key] if key else []), "features", "label")


def packed(rows: DataFrame, key: str | None = None) -> DataFrame:
    """The rows in tasks of about ``FIT_ROWS``: every task of a tree fit makes statistics of all nodes, and models are fitted side by side."""
    tasks = max(1, math.ceil(rows.count() / FIT_ROWS))
    return rows.repartition(tasks, *([key] if key else []))


def _side_by_side(rows: DataFrame) -> int:
    """Models to fit at a time, so that the tasks of one need not fill the cluster."""
    return max(4, rows.sparkSession.sparkContext.defaultParallelism // rows.rdd.getNumPartitions())


def classifier(algorithm: str, classes: int = 2, seed: int = 42, **settings) -> Estimator:
    """An untrained classifier; boosting of more than two classes trains one model per class, side by side."""
    if algorithm == "random_forest":
        # rows keep their place in each tree, so they do not walk it again for every level; a fit is too short to be written in between
        kept = {"cacheNodeIds": True, "checkpointInterval": -1}
        return RandomForestClassifier(**{"numTrees": 100, "maxDepth": 10, "seed": seed, **kept, **settings})
    if algorithm == "gradient_boosting":
        boosting = GBTClassifier(**{"maxIter": 100, "maxDepth": 10, "seed": seed, **settings})
        return boosting if classes <= 2 else OneVsRest(classifier=boosting, parallelism=classes)
    if algorithm == "logistic":
        return LogisticRegression(**{"maxIter": 100, **settings})
    raise ValueError(f"Unknown algorithm: {algorithm}")


def class_count(df: DataFrame, label: str = "label") -> int:
    """Number of classes: the largest label plus one, at least two."""
    largest = df.agg(F.max(label)).first()[0]
    return max(int(largest or 0) + 1, 2)


def evaluate(predictions: DataFrame) -> dict[str, float | None]:
    """A-55: accuracy, F1, weighted precision and recall, and AUC for two classes."""
    rows = predictions.select(*[c for c in ("label", "prediction", "rawPrediction") if c in predictions.columns])
    rows = rows.persist()
    try:
        result: dict[str, float | None] = metrics_table(rows).first().asDict()
        binary = "rawPrediction" in rows.columns and class_count(rows) == 2
        result["auc"] = BinaryClassificationEvaluator().evaluate(rows) if binary else None
    finally:
        rows.unpersist()
    return result


def confusion(predictions: DataFrame) -> DataFrame:
    """A-55: rows per label and prediction."""
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("Count"))


def metrics_table(predictions: DataFrame) -> DataFrame:
    """A-55 as one row, from a single count per label and prediction.

    Precision, recall and F1 are weighted by the share of each label.
    """
    cells = confusion(predictions)
    n = F.col("Count")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    as_label = cells.groupBy(F.col("label").alias("c")).agg(F.sum(n).alias("actual"), F.sum(hit).alias("hits"))
    as_prediction = cells.groupBy(F.col("prediction").alias("c")).agg(F.sum(n).alias("claimed"))
    zero = F.lit(0.0)
    per_class = as_label.join(as_prediction, "c", "left").select(
        "actual",
        "hits",
        F.coalesce(F.try_divide("hits", "claimed"), zero).alias("p"),
        F.coalesce(F.try_divide("hits", "actual"), zero).alias("r"),
    ).withColumn("f", F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), zero))

    def weighted(column: str):
        return F.sum(F.col(column) * F.col("actual")) / F.sum("actual")

    return per_class.agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"),
        weighted("f").alias("f1"),
        weighted("p").alias("precision"),
        weighted("r").alias("recall"),
    )


def train(
    df: DataFrame,
    algorithm: str = "random_forest",
    features: Sequence[str] = DEFAULT_FEATURES,
    label: str = "QualityLabel",
    test_share: float = 0.2,
    seed: int = 42,
    key: str | None = None,
    **settings,
) -> tuple[Model, dict[str, float | None]]:
    """A-52: a model fitted on the training rows and its metrics on the test rows."""
    prepared = _slim(prepare(df, features, label), key).persist()
    try:
        fitted, test = split(prepared, test_share, seed, key)
        rows = packed(fitted, key).persist()
        try:
            model = classifier(algorithm, class_count(prepared), seed, **settings).fit(rows)
        finally:
            rows.unpersist()
        return model, evaluate(model.transform(test))
    finally:
        prepared.unpersist()


def with_folds(df: DataFrame, key: str, folds: int = 5, seed: int = 42, output: str = "Fold") -> DataFrame:
    """``output``: the fold of each key, from its hash, so the folds are the same on any cluster and in any run."""
    return df.withColumn(output, F.floor(hash_share(key, seed + 1) * folds).cast("int"))


def _grid(algorithm: str, classes: int, grid: Mapping[str, Sequence] | None, seed: int, settings: Mapping) -> tuple[Estimator, list[dict]]:
    estimator = classifier(algorithm, classes, seed, **settings)
    tuned = estimator.getClassifier() if isinstance(estimator, OneVsRest) else estimator
    builder = ParamGridBuilder()
    for name, values in (GRIDS[algorithm] if grid is None else grid).items():
        builder.addGrid(tuned.getParam(name), list(values))
    return estimator, builder.build()


def search(
    prepared: DataFrame,
    algorithm: str,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    metric: str = "accuracy",
    seed: int = 42,
    parallelism: int | None = None,
    key: str | None = None,
    **settings,
) -> Model:
    """The best model of a cross-validated grid, the first of equals, fitted on all rows; with ``key`` the folds follow its hash.

    The models of all cells and folds are fitted side by side, by default as many as keep the cluster busy.
    """
    classes = class_count(prepared)
    folded = with_folds(prepared, key, folds, seed) if key else prepared.withColumn("Fold", F.floor(F.rand(seed) * folds).cast("int"))
    held = folded.persist()
    sizes = held.groupBy("Fold").agg(F.count(F.lit(1)).alias("n")).count()
    if sizes < folds:
        raise ValueError(f"rows in {sizes} of {folds} folds only")
    rows = packed(held, key).persist()
    try:
        estimator, cells = _grid(algorithm, classes, grid, seed, settings)
        evaluator = MulticlassClassificationEvaluator(metricName=metric)

        def score(task: tuple[int, int]) -> float:
            number, fold = task
            model = estimator.fit(rows.filter(F.col("Fold") != fold), cells[number])
            return evaluator.evaluate(model.transform(held.filter(F.col("Fold") == fold)))

        tasks = [(c, f) for c in reversed(range(len(cells))) for f in range(folds)]  # grids rise: the longest fits first
        with ThreadPoolExecutor(parallelism or _side_by_side(rows)) as pool:
            scores = dict(zip(tasks, pool.map(score, tasks)))
        means = [sum(scores[c, f] for f in range(folds)) / folds for c in range(len(cells))]
        best = max(range(len(cells)), key=lambda c: (means[c], -c))
        return estimator.fit(rows, cells[best])
    finally:
        rows.unpersist()
        held.unpersist()


def held_out_predictions(
    prepared: DataFrame,
    key: str,
    algorithm: str = "random_forest",
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 5,
    seed: int = 42,
    parallelism: int | None = None,
    **settings,
) -> DataFrame:
    """A-53: ``(Cell, Settings, Fold, key, label, prediction)``: every row predicted once per grid cell by a model that did not see its fold.

    Written cell by cell, so no table is held by the driver; models of different cells and folds are fitted side by side.
    """
    rows = packed(with_folds(_slim(prepared, key), key, folds, seed), key).persist()
    path = scratch_path(prepared.sparkSession, "held-out")
    try:
        estimator, cells = _grid(algorithm, class_count(rows), grid, seed, settings)

        def run(task: tuple[int, int]) -> None:
            number, fold = task
            model = estimator.fit(rows.filter(F.col("Fold") != fold), cells[number])
            described = ", ".join(f"{p.name}={v}" for p, v in sorted(cells[number].items(), key=lambda c: c[0].name))
            model.transform(rows.filter(F.col("Fold") == fold)).select(
                F.lit(number).alias("Cell"), F.lit(described).alias("Settings"), "Fold", key, "label", "prediction"
            ).write.parquet(f"{path}/cell={number}/fold={fold}")

        with ThreadPoolExecutor(parallelism or _side_by_side(rows)) as pool:
            list(pool.map(run, [(c, f) for c in range(len(cells)) for f in range(folds)]))
    finally:
        rows.unpersist()
    parts = [f"{path}/cell={c}/fold={f}" for c in range(len(cells)) for f in range(folds)]
    return prepared.sparkSession.read.parquet(*parts)


def grid_metrics(held_out: DataFrame, metric: str = "Accuracy") -> DataFrame:
    """``(Cell, Settings, Fold, HeldOut, Accuracy, F1, Best)`` of held-out predictions.

    F1 is weighted by the share of each label. ``Best`` marks the rows of the cell with the highest mean of ``metric`` over
    its folds, the first of equals.
    """
    place = ["Cell", "Settings", "Fold"]
    counts = held_out.groupBy(*place, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    actual = counts.groupBy(*place, F.col("label").alias("c")).agg(F.sum("n").alias("actual"), F.sum(hit).alias("hits"))
    claimed = counts.groupBy(*place, F.col("prediction").alias("c")).agg(F.sum("n").alias("claimed"))
    f1 = 2 * F.col("hits") / (F.col("actual") + F.coalesce("claimed", F.lit(0)))
    folds = actual.join(claimed, [*place, "c"], "left").groupBy(*place).agg(
        F.sum("actual").alias("HeldOut"),
        (F.sum("hits") / F.sum("actual")).alias("Accuracy"),
        (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("F1"),
    )
    means = folds.groupBy("Cell").agg(F.avg(metric).alias("mean"))
    best = means.agg(F.min(F.struct((-F.col("mean")).alias("m"), "Cell"))["Cell"]).scalar()
    return folds.withColumn("Best", F.col("Cell") == best)


def train_with_cv(
    df: DataFrame,
    algorithm: str = "random_forest",
    features: Sequence[str] = DEFAULT_FEATURES,
    label: str = "QualityLabel",
    folds: int = 5,
    grid: Mapping[str, Sequence] | None = None,
    test_share: float = 0.2,
    seed: int = 42,
    key: str | None = None,
    **settings,
) -> tuple[Model, dict[str, float | None]]:
    """A-53: grid search on the training rows, metrics on rows held out from it."""
    prepared = _slim(prepare(df, features, label), key).persist()
    try:
        fitted, test = split(prepared, test_share, seed, key)
        model = search(fitted, algorithm, grid, folds, seed=seed, key=key, **settings)
        return model, evaluate(model.transform(test))
    finally:
        prepared.unpersist()


def compare_models(
    prepared: DataFrame,
    grids: Mapping[str, Mapping[str, Sequence]] = COMPARED_GRIDS,
    folds: int = 3,
    test_share: float = 0.3,
    seed: int = 42,
    key: str | None = None,
) -> DataFrame:
    """A-54: one row of test metrics per algorithm; ``best`` marks the highest F1."""
    slim = _slim(prepared, key).persist()
    try:
        fitted, test = split(slim, test_share, seed, key)

        def compared(algorithm: str) -> tuple:
            model = search(fitted, algorithm, grids[algorithm], folds, "f1", seed, key=key)
            return (algorithm, *evaluate(model.transform(test)).values())

        with ThreadPoolExecutor(max(1, len(grids))) as pool:
            rows = list(pool.map(compared, grids))
    finally:
        slim.unpersist()
    best = max(rows, key=lambda r: r[2])[0]
    schema = "model string, accuracy double, f1 double, precision double, recall double, auc double, best boolean"
    return prepared.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows], schema)


def predict(
    model: Model,
    df: DataFrame,
    features: Sequence[str] = DEFAULT_FEATURES,
    keep: Sequence[str] = ("Id", "Title"),
    include_probability: bool = True,
) -> DataFrame:
    """A-56: the kept columns, ``prediction`` and, where the model has it, ``probability``."""
    scored = model.transform(prepare(df, features, None))
    columns = [*keep, "prediction"]
    if include_probability and "probability" in scored.columns:
        columns.append("probability")
    return scored.select(*columns)


def feature_importance(model: Model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """A-57: ``(feature, importance)``, largest first; absolute coefficients for a logistic model.

    ``df`` only supplies the session. A model without importances gives no row.
    """
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    elif isinstance(model, OneVsRestModel) and all(hasattr(m, "featureImportances") for m in model.models):
        values = sum(m.featureImportances.toArray() for m in model.models) / len(model.models)
    else:
        values = []
    rows = [(name, float(value)) for name, value in zip(features, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def permuted_predictions(model: Model, prepared: DataFrame, features: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """A-57: ``(key, Feature, Value, label, prediction)``: each row as it is (``Feature`` null) and once per feature with a donor's value.

    Rows are numbered by the hash of their key, in ranges, and the next row (the first after the last) is
    the donor, so every feature keeps its values and loses its tie to the label. All variants are predicted in one pass.
    """
    cells = vector_to_array("features")
    rows = materialize(prepared.select(key, "label", cells.alias("x"), F.struct(F.xxhash64(key, F.lit(seed)).alias("h"), F.col(key).alias("k")).alias("at")), "rows")
    places = running_counts(rows.select("at"), "at").select("at", F.col("ValuesBefore").alias("place"), "TotalValues")
    placed = materialize(rows.dropDuplicates([key]).join(places, "at"), "placed")
    donors = placed.select(F.pmod(F.col("place") - 1, F.col("TotalValues")).alias("place"), F.col("x").alias("y"))
    variants = F.explode(F.array(F.lit(None).cast("int"), *[F.lit(i) for i in range(len(features))]))
    both = placed.join(donors, "place").select(key, "label", "x", "y", variants.alias("i"))
    changed = F.transform("x", lambda v, j: F.when(j == F.col("i"), F.get("y", j)).otherwise(v))
    names = F.array(*[F.lit(f) for f in features])
    given = both.select(key, "label", F.get(names, F.col("i")).alias("Feature"), F.get("y", F.col("i")).alias("Value"), array_to_vector(changed).alias("features"))
    return model.transform(given).select(key, "Feature", "Value", "label", "prediction")


def score_drops(predictions: DataFrame) -> DataFrame:
    """A-57 for any model: ``(Feature, Accuracy, Importance)``, the accuracy lost when a feature is permuted, largest first."""
    right = (F.col("label") == F.col("prediction")).cast("double")
    accuracy = predictions.groupBy("Feature").agg(F.avg(right).alias("Accuracy"))
    whole = predictions.filter("Feature IS NULL").agg(F.avg(right)).scalar()
    table = accuracy.filter("Feature IS NOT NULL").withColumn("Importance", whole - F.col("Accuracy"))
    return table.orderBy(F.desc("Importance"), "Feature")


def save_model(model: Model, path: str) -> None:
    """A-58: any fitted model, of any algorithm."""
    PipelineModel(stages=[model]).write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path).stages[0]

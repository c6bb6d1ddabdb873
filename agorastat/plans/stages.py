"""A-59: the batch run as stages that read and write tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from agorastat.operators import clean, quality, text, topics
from agorastat.sources.readers import read_parquet, read_table
from agorastat.sources.writers import repartition_and_save, save_parquet

MODES = {"full": ("etl", "nlp", "ml"), "etl": ("etl",), "nlp": ("nlp",), "ml": ("ml",)}


@dataclass(frozen=True)
class Paths:
    """Where a run reads the dump and keeps its tables and models."""

    raw: str
    processed: str
    models: str

    @property
    def questions(self) -> str:
        return f"{self.processed}/questions"


class Tables(dict[str, DataFrame]):
    """The table each stage left, and in ``rows`` how many rows its write counted."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: dict[str, int] = {}


def run_etl(spark: SparkSession, paths: Paths, seen: Observation | None = None) -> DataFrame:
    """Dump to cleaned questions in one folder per year and month.

    Questions are chosen before the cleaning, so answers are not cleaned in vain.
    """
    posts = read_table(spark, "posts", f"{paths.raw}/Posts.xml")
    questions = clean.clean_posts(clean.questions(posts))
    repartition_and_save(questions, paths.questions, partition_by=["Year", "Month"], seen=seen)
    return read_parquet(spark, paths.questions)


def run_nlp(
    spark: SparkSession,
    paths: Paths,
    num_topics: int = 5,
    max_iterations: int = 10,
    min_doc_freq: float = 5,
    seen: Observation | None = None,
) -> DataFrame:
    """Topics of the question bodies; writes and returns the heaviest words per topic."""
    tokens = text.preprocess(read_parquet(spark, paths.questions, ["Id", "Body"]))
    save_parquet(tokens.select("Id", "ProcessedText"), f"{paths.processed}/tokens")
    stored = read_parquet(spark, f"{paths.processed}/tokens")
    model = topics.fit_topics(
        stored, num_topics=num_topics, max_iterations=max_iterations, min_doc_freq=min_doc_freq
    )
    model.save(f"{paths.models}/topics")
    save_parquet(model.words(5), f"{paths.processed}/topic_words", seen=seen)
    return read_parquet(spark, f"{paths.processed}/topic_words")


def run_ml(
    spark: SparkSession, paths: Paths, algorithm: str = "random_forest", seen: Observation | None = None, **settings
) -> DataFrame:
    """A quality classifier on title and body length; writes and returns one row of metrics."""
    questions = read_parquet(spark, paths.questions, ["Id", "Score", "TitleLength", "BodyLength"])
    labelled = clean.label_quality(clean.fill_zero(questions), rule="score")
    model, metrics = quality.train(
        labelled, algorithm, ["TitleLength", "BodyLength"], key="Id", **settings
    )
    quality.save_model(model, f"{paths.models}/quality")
    schema = ", ".join(f"{name} double" for name in metrics)
    save_parquet(spark.createDataFrame([tuple(metrics.values())], schema), f"{paths.processed}/metrics", seen=seen)
    return read_parquet(spark, f"{paths.processed}/metrics")


STAGES = {"etl": run_etl, "nlp": run_nlp, "ml": run_ml}


def run(spark: SparkSession, paths: Paths, mode: str = "full", **options) -> Tables:
    """Run the stages of a mode; ``options`` maps a stage name to its arguments."""
    if mode not in MODES:
        raise ValueError(f"Unknown mode: {mode}")
    chosen: Sequence[str] = MODES[mode]
    tables = Tables()
    for stage in chosen:
        seen = Observation(stage)
        tables[stage] = STAGES[stage](spark, paths, seen=seen, **options.get(stage, {}))
        tables.rows[stage] = seen.get["Rows"]
    return tables


def stage_counts(spark: SparkSession, tables: Tables) -> DataFrame:
    """Rows per stage of a run, as its writes counted them: no table is read again and no job runs."""
    listed = ", ".join(f"('{stage}', {rows}L)" for stage, rows in tables.rows.items())
    return spark.sql(f"SELECT * FROM VALUES {listed} AS counted(Stage, Rows)")

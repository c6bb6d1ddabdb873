"""Tag time series: growth, smoothing, ranking, seasonality and forecasts.

A series has one row per tag and calendar period, so a window per tag is bounded
by the length of the calendar, however popular the tag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorastat.functions.scalar import growth, period
from agorastat.operators.aggregates import per_tag
from agorastat.sources.storage import materialize

STEPS = {
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 1 MONTH",
    "year": "INTERVAL 1 YEAR",
}


def tag_trends(posts: DataFrame, time: str = "CreationDate", granularity: str = "month") -> DataFrame:
    """A-16: questions, mean score and total views per tag and period."""
    rows = posts.select("TagsList", period(time, granularity).alias("Period"), "Score", "ViewCount")
    return per_tag(rows, "Period", "Score", "ViewCount").groupBy("Tag", "Period").agg(
        F.count(F.lit(1)).alias("QuestionCount"),
        F.avg("Score").alias("AvgScore"),
        F.sum("ViewCount").alias("TotalViews"),
    )


def fill_calendar(trends: DataFrame, granularity: str = "month", until_last: bool = False) -> DataFrame:
    """Add the missing periods of each tag with zero questions (D-14).

    ``until_last`` extends each series to the last period of all tags (D-15).
    """
    ends = trends.groupBy("Tag").agg(F.min("Period").alias("_from"), F.max("Period").alias("_to"))
    if until_last:
        ends = ends.withColumn("_to", trends.agg(F.max("Period")).scalar())
    step = F.expr(STEPS[granularity])
    calendar = ends.select("Tag", F.explode(F.sequence("_from", "_to", step)).alias("Period"))
    filled = calendar.join(trends, ["Tag", "Period"], "left")
    return filled.fillna({"QuestionCount": 0, "TotalViews": 0})


def with_growth(trends: DataFrame, lookback: int = 6) -> DataFrame:
    """W-01: the count ``lookback`` rows earlier and the change in percent."""
    series = W.partitionBy("Tag").orderBy("Period")
    lagged = trends.withColumn("PrevCount", F.lag("QuestionCount", lookback).over(series))
    return lagged.withColumn("Growth", growth("QuestionCount", "PrevCount"))


def trending_tags(
    trends: DataFrame, min_questions: int = 100, lookback: int = 6, latest: Column | None = None
) -> DataFrame:
    """W-02, J-02, A-24: growth at the last period of tags with enough questions.

    The total comes from a window with the same partitioning as the lag, so
    there is one shuffle and no join. Without ``latest`` the series is written once to find its last period.
    """
    if latest is None:
        trends = materialize(trends, "trends")  # the facts are read once, the series twice
        latest = trends.agg(F.max("Period")).scalar()
    totals = F.sum("QuestionCount").over(W.partitionBy("Tag"))
    current = with_growth(trends, lookback).withColumn("TotalQuestions", totals)
    return current.filter(
        (F.col("Period") == latest) & (F.col("TotalQuestions") >= min_questions)
    ).select("Tag", "QuestionCount", "Growth", "TotalQuestions")


def declining_tags(trends: DataFrame, min_questions: int = 100, lookback: int = 6) -> DataFrame:
    """W-03: trending tags with negative growth."""
    return trending_tags(trends, min_questions, lookback).filter(F.col("Growth") < 0)


def moving_average(trends: DataFrame, size: int = 3) -> DataFrame:
    """W-04: mean of the current and the preceding periods."""
    frame = W.partitionBy("Tag").orderBy("Period").rowsBetween(1 - size, 0)
    return trends.withColumn("QuestionCountMA", F.avg("QuestionCount").over(frame))


def seasonality(trends: DataFrame) -> DataFrame:
    """A-17, J-03: mean and spread per tag and month, relative to the tag's mean.

    The tag's mean is rebuilt from monthly sums and counts: no second pass and no join.
    """
    monthly = trends.groupBy("Tag", F.month("Period").alias("Month")).agg(
        F.avg("QuestionCount").alias("AvgQuestions"),
        F.stddev("QuestionCount").alias("StdQuestions"),
        F.sum("QuestionCount").alias("_sum"),
        F.count("QuestionCount").alias("_n"),
    )
    tag = W.partitionBy("Tag")
    overall = F.sum("_sum").over(tag) / F.sum("_n").over(tag)
    return monthly.withColumn("OverallAvg", overall).withColumn(
        "SeasonalIndex", F.try_divide(F.col("AvgQuestions"), F.col("OverallAvg"))
    ).drop("_sum", "_n")


def forecast(
    trends: DataFrame,
    periods: int = 6,
    alpha: float = 0.3,
    granularity: str = "month",
    tags: Sequence[str] | None = None,
    min_history: int = 3,
) -> DataFrame:
    """W-09: exponential smoothing, flat forecast for the next periods of every tag.

    Tags with fewer than ``min_history`` periods give no row.
    """
    chosen = trends if tags is None else trends.filter(F.col("Tag").isin(list(tags)))
    history = chosen.groupBy("Tag").agg(
        F.sort_array(F.collect_list(F.struct("Period", "QuestionCount"))).alias("_points")
    ).filter(F.size("_points") >= min_history)
    values = F.transform("_points", lambda p: p["QuestionCount"].cast("double"))
    smoothed = F.aggregate(
        F.slice("_values", 2, F.size("_values")),
        F.element_at("_values", 1),
        lambda level, x: F.lit(alpha) * x + F.lit(1 - alpha) * level,
    )
    last = F.element_at("_points", -1)["Period"]
    level = history.withColumn("_values", values).select(
        "Tag", last.alias("_last"), smoothed.alias("Forecast")
    )
    steps = level.withColumn("Step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    ahead = F.expr(f"_last + Step * {STEPS[granularity]}")
    return steps.select("Tag", "Step", ahead.alias("Period"), "Forecast")


def compare_tags(trends: DataFrame, tags: Sequence[str]) -> DataFrame:
    """A-18, F-08: one row per period and one count column per tag."""
    chosen = trends.filter(F.col("Tag").isin(list(tags)))
    return chosen.groupBy("Period").pivot("Tag", list(tags)).agg(F.first("QuestionCount"))


def top_tags_by_period(trends: DataFrame, n: int = 10) -> DataFrame:
    """W-05: the ``n`` largest tags of each period, ties by tag name."""
    order = W.partitionBy("Period").orderBy(F.desc("QuestionCount"), "Tag")
    return trends.withColumn("Rank", F.row_number().over(order)).filter(F.col("Rank") <= n)


def yearly_counts(trends: DataFrame) -> DataFrame:
    """A-19: questions per tag and year."""
    return trends.groupBy("Tag", F.year("Period").alias("Year")).agg(F.sum("QuestionCount").alias("YearlyCount"))


def yearly_growth(trends: DataFrame) -> DataFrame:
    """W-06: change in percent to the previous year of the tag."""
    series = W.partitionBy("Tag").orderBy("Year")
    lagged = yearly_counts(trends).withColumn("PrevYearCount", F.lag("YearlyCount").over(series))
    return lagged.withColumn("YoYGrowth", growth("YearlyCount", "PrevYearCount"))


def emerging_tags(trends: DataFrame, min_growth: float = 50.0, min_questions: int = 50) -> DataFrame:
    """W-07: tags with strong growth in the last year."""
    trends = materialize(trends, "trends")
    latest = trends.agg(F.max(F.year("Period"))).scalar()
    return yearly_growth(trends).filter(
        (F.col("Year") == latest)
        & (F.col("YoYGrowth") >= min_growth)
        & (F.col("YearlyCount") >= min_questions)
    )

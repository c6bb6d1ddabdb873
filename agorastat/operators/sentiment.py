"""Sentiment of texts and its aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.functions.scalar import period
from agorastat.functions.sentiment import Lexicon, lexicon_score, score_label
from agorastat.operators.joins import lookup_join


def analyze(
    df: DataFrame,
    text: str = "Text",
    output: str = "SentimentScore",
    lexicon: Lexicon | None = None,
    strip_punct: bool = False,
    cut: float = 0.1,
    inclusive: bool = False,
) -> DataFrame:
    """N-04: score column and ``{output}Label``. N-07: title cuts by ``cut=0.05, inclusive=True``."""
    scored = df.withColumn(output, lexicon_score(text, lexicon or Lexicon(), strip_punct))
    return scored.withColumn(f"{output}Label", score_label(output, cut, inclusive))


def analyze_comments(comments: DataFrame, **options) -> DataFrame:
    """N-05: like ``analyze``, on the cleaned text where there is one."""
    return analyze(comments, "TextClean" if "TextClean" in comments.columns else "Text", **options)


def summarize(df: DataFrame, group_by: str | None = None) -> DataFrame:
    """A-09: count, mean, spread, range and label shares, in total or per group."""
    label = F.col("SentimentScoreLabel")
    stats = [
        F.count(F.lit(1)).alias("TotalCount"),
        F.avg("SentimentScore").alias("AvgSentiment"),
        F.stddev("SentimentScore").alias("StdSentiment"),
        F.min("SentimentScore").alias("MinSentiment"),
        F.max("SentimentScore").alias("MaxSentiment"),
    ]
    names = ("Positive", "Negative", "Neutral")
    stats += [F.count_if(label == n.lower()).alias(f"{n}Count") for n in names]
    grouped = (df.groupBy(group_by) if group_by else df).agg(*stats)
    return grouped.withColumns(
        {f"{n}Percent": F.try_divide(f"{n}Count", "TotalCount") * 100 for n in names}
    )


def by_tag(
    posts: DataFrame, comments: DataFrame, post_id: str = "PostId", salt_by: Sequence[str] | None = None
) -> DataFrame:
    """A-10, J-01: comments, mean and spread per tag of the commented post.

    Comments of a much discussed post are spread before the join.
    """
    tags = posts.select(F.col("Id").alias(post_id), "TagsList")
    slim = comments.select(*dict.fromkeys([post_id, "SentimentScore", *(salt_by or [])]))
    joined = lookup_join(slim, tags, [post_id], salt_by=salt_by)
    return joined.select(F.explode("TagsList").alias("Tag"), "SentimentScore").groupBy("Tag").agg(
        F.count(F.lit(1)).alias("CommentCount"),
        F.avg("SentimentScore").alias("AvgSentiment"),
        F.stddev("SentimentScore").alias("StdSentiment"),
    )


def over_time(df: DataFrame, time: str = "CreationDate", granularity: str = "month") -> DataFrame:
    """A-11: count and mean per calendar period."""
    return df.groupBy(period(time, granularity).alias("Period")).agg(
        F.count(F.lit(1)).alias("Count"), F.avg("SentimentScore").alias("AvgSentiment")
    )


def toxic(df: DataFrame, threshold: float = -0.5) -> DataFrame:
    """F-05: rows with a score below the threshold."""
    return df.filter(F.col("SentimentScore") < threshold)

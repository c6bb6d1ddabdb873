"""Cleaning and enriching posts, users and comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorastat.functions import text as tx
from agorastat.functions.scalar import calendar_parts, flag, quality_label
from agorastat.functions.text import as_column

POST_COUNTS = ["Score", "ViewCount", "AnswerCount", "CommentCount", "FavoriteCount"]
USER_COUNTS = ["Reputation", "Views", "UpVotes", "DownVotes"]


def _parse_times(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Parse text timestamps; an unreadable one becomes null."""
    textual = {n for n, kind in df.dtypes if kind == "string"}
    return df.withColumns({n: F.try_to_timestamp(n) for n in names if n in df.columns and n in textual})


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """P-11, P-12: null to 0 in the named columns, or in every numeric column."""
    return df.fillna(0) if columns is None else df.fillna(dict.fromkeys(columns, 0))


def clean_posts(posts: DataFrame) -> DataFrame:
    """P-01: timestamps, calendar, tags, text and code columns, flags, null fill."""
    timed = _parse_times(posts, ["CreationDate", "LastActivityDate", "LastEditDate", "ClosedDate"])
    parsed = timed.withColumns(
        {
            **calendar_parts("CreationDate"),
            "TagsList": tx.parse_tags("Tags"),
            "BodyClean": tx.strip_html("Body"),
            "TitleLength": F.length("Title"),
            "TitleWordCount": tx.word_count("Title"),
            "CodeBlocks": tx.code_text("Body"),
            "HasAcceptedAnswer": flag(F.col("AcceptedAnswerId").isNotNull()),
            "IsQuestion": flag(F.col("PostTypeId") == 1),
            "IsAnswer": flag(F.col("PostTypeId") == 2),
        }
    )
    measured = parsed.withColumns(
        {
            "NumTags": F.size("TagsList"),
            "BodyLength": F.length("BodyClean"),
            "BodyWordCount": tx.word_count("BodyClean"),
            "HasCode": flag(F.length("CodeBlocks") > 0),
        }
    )
    return fill_zero(measured, POST_COUNTS)


def clean_users(users: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """P-02: account age in days at ``as_of`` (default today), texts, flags, null fill."""
    timed = _parse_times(users, ["CreationDate", "LastAccessDate"])
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, str):
        as_of = F.to_date(F.lit(as_of))
    cleaned = timed.withColumns(
        {
            "AccountAge": F.datediff(as_of, "CreationDate"),
            "AboutMeClean": tx.strip_html("AboutMe"),
            "HasWebsite": flag(F.col("WebsiteUrl").isNotNull()),
            "HasLocation": flag(F.col("Location").isNotNull()),
        }
    )
    return fill_zero(cleaned.withColumn("AboutMeLength", F.length("AboutMeClean")), USER_COUNTS)


def clean_comments(comments: DataFrame) -> DataFrame:
    """P-03: timestamp, clean text with its length and word count, null fill."""
    timed = _parse_times(comments, ["CreationDate"]).withColumn("TextClean", tx.strip_html("Text"))
    sized = timed.withColumns({"TextLength": F.length("TextClean"), "TextWordCount": tx.word_count("TextClean")})
    return fill_zero(sized, ["Score"])


def question_features(posts: DataFrame) -> DataFrame:
    """P-16: lengths, question marks, code share, tag count, hour and weekday."""
    body = F.coalesce(as_column("BodyClean"), F.lit(""))
    title = as_column("Title")
    basic = posts.withColumns(
        {
            "TitleLength": F.length(title),
            "BodyLength": F.length(body),
            "TitleWordCount": tx.word_count(title),
            "BodyWordCount": tx.word_count(body),
            "HasQuestionMark": flag(title.contains("?")),
            "NumQuestionMarks": F.regexp_count(title, F.lit(r"\?")),
            "NumTags": F.coalesce(F.size("TagsList"), F.lit(0)),
            "PostHour": F.hour("CreationDate"),
            "PostDayOfWeek": F.dayofweek("CreationDate"),
        }
    )
    code = F.length(F.coalesce(as_column("CodeBlocks"), F.lit("")))
    return basic.withColumns(
        {
            "CodeRatio": code / F.greatest("BodyLength", F.lit(1)),
            "IsWeekend": flag(F.col("PostDayOfWeek").isin(1, 7)),
        }
    )


def label_quality(posts: DataFrame, rule: str = "engagement", output: str = "QualityLabel", **limits) -> DataFrame:
    """P-13, P-14, P-15: quality class by one of the rules."""
    return posts.withColumn(output, quality_label(rule, **limits))


def deduplicate(df: DataFrame, columns: Sequence[str] = ("Title", "BodyClean"), key: str = "Id") -> DataFrame:
    """T-04: of the rows that agree on ``columns`` keep the one with the least key.

    An aggregate and not a ranking window: each task first reduces its own copies,
    so a text that fills much of the table does not end up in one task.
    """
    others = [c for c in df.columns if c not in columns]
    kept = df.groupBy(*columns).agg(F.min_by(F.struct(*others), F.col(key)).alias("_kept"))
    return kept.select(*[F.col(c) if c in columns else F.col(f"_kept.{c}").alias(c) for c in df.columns])


# --- filters (F-01 ... F-06) -----------------------------------------------

def questions(posts: DataFrame) -> DataFrame:
    """F-01."""
    return posts.filter(F.col("PostTypeId") == 1)


def answers(posts: DataFrame) -> DataFrame:
    """F-02."""
    return posts.filter(F.col("PostTypeId") == 2)


def in_date_range(df: DataFrame, start: str, end: str, column: str = "CreationDate") -> DataFrame:
    """F-03: both days included in full."""
    first, after = F.to_date(F.lit(start)), F.date_add(F.to_date(F.lit(end)), 1)
    return df.filter((F.col(column) >= first) & (F.col(column) < after))


def with_tags(posts: DataFrame, tags: Sequence[str], match_all: bool = False, column: str = "TagsList") -> DataFrame:
    """F-04: rows with any or with all of the tags.

    Without tags: no row for any, every row for all.
    """
    if not tags:
        return posts if match_all else posts.filter(F.lit(False))
    wanted = F.array(*[F.lit(t) for t in tags])
    if match_all:
        return posts.filter(F.size(F.array_except(wanted, F.col(column))) == 0)
    return posts.filter(F.arrays_overlap(F.col(column), wanted))


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F-06: rows without a null in the columns."""
    return df.dropna(subset=list(columns))


def above_average(df: DataFrame, column: str = "Score") -> DataFrame:
    """F-07: rows above the global mean, by a scalar subquery."""
    return df.filter(F.col(column) > df.agg(F.avg(column)).scalar())

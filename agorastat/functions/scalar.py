"""Calendar, ratio, flag and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agorastat.functions.text import as_column

GRANULARITIES = ("day", "week", "month", "year")


def period(time: Column | str, granularity: str = "month") -> Column:
    """Start of the calendar period: a date for days, else a timestamp."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"Unknown granularity: {granularity}")
    c = as_column(time)
    return F.to_date(c) if granularity == "day" else F.date_trunc(granularity, c)


def calendar_parts(time: Column | str) -> dict[str, Column]:
    """Year, month, weekday (Sunday = 1) and hour."""
    c = as_column(time)
    return {"Year": F.year(c), "Month": F.month(c), "DayOfWeek": F.dayofweek(c), "Hour": F.hour(c)}


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def safe_divide(numerator: Column | str, denominator: Column | str, default: float = 0.0) -> Column:
    """Quotient, or ``default`` for a zero divisor."""
    n, d = as_column(numerator), as_column(denominator)
    return F.when(d == 0, F.lit(default).cast("double")).otherwise(F.try_divide(n, d))


def percentage(part: Column | str, whole: Column | str, decimals: int = 2) -> Column:
    """Share in percent, rounded; 0 for an empty whole."""
    p, w = as_column(part), as_column(whole)
    return F.when(w == 0, F.lit(0.0)).otherwise(F.round(F.try_divide(p, w) * 100, decimals))


def growth(current: Column | str, previous: Column | str) -> Column:
    """Change in percent; a previous value below 1 counts as 1, null stays null."""
    now, before = as_column(current), as_column(previous)
    base = F.when(before.isNotNull(), F.greatest(before, F.lit(1)))
    return (now - before) / base * 100


def quality_label(
    rule: str = "engagement", score_threshold: int | None = None, view_threshold: int = 1000
) -> Column:
    """Quality class of a post.

    ``engagement``: 2 for score, views and an accepted answer, 1 for an
    answered post with a non-negative score, else 0.
    ``score``: 2 from 10 points, 1 from 0 points, else 0.
    ``binary``: 1.0 from 10 points, else 0.0.
    """
    score = F.col("Score")
    if rule == "engagement":
        high = (
            (score >= (5 if score_threshold is None else score_threshold))
            & (F.col("ViewCount") >= view_threshold)
            & (F.col("HasAcceptedAnswer") == 1)
        )
        medium = (score >= 0) & (F.col("AnswerCount") > 0)
        return F.when(high, 2).when(medium, 1).otherwise(0)
    limit = 10 if score_threshold is None else score_threshold
    if rule == "score":
        return F.when(score >= limit, 2).when(score >= 0, 1).otherwise(0)
    if rule == "binary":
        return F.when(score >= limit, 1.0).otherwise(0.0)
    raise ValueError(f"Unknown rule: {rule}")

"""The SQL reports (Q-01 ... Q-06), over frames passed in by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorastat.operators.joins import lookup_join


def above_average_by_month(questions: DataFrame, min_score: int = 5, k: int = 10) -> DataFrame:
    """Q-01, J-07: each high-scored question above the mean with each month's mean score; top rows.

    The product of questions and months is cut before it is built: every question
    meets every month, so the first ``k`` rows come from the first ``k`` questions. The
    months travel as one array, bounded by the calendar.
    """
    return questions.sparkSession.sql(
        """
        WITH monthly_stats AS (
            SELECT year, month, AVG(score) AS avg_score
            FROM {questions} GROUP BY year, month
        ),
        high_score AS (
            SELECT question_id, title, score, view_count FROM {questions}
            WHERE score >= :min_score AND score > (SELECT AVG(score) FROM {questions})
            ORDER BY score DESC, question_id LIMIT :k
        ),
        paired AS (
            SELECT h.*, explode((
                SELECT collect_list(named_struct('year', year, 'month', month, 'avg_score', avg_score))
                FROM monthly_stats
            )) AS m
            FROM high_score h
        )
        SELECT question_id, title, score, view_count, m.year AS year, m.month AS month,
               ROUND(m.avg_score, 2) AS monthly_avg_score
        FROM paired
        ORDER BY score DESC, question_id, year, month
        LIMIT :k
        """,
        args={"min_score": min_score, "k": k},
        questions=questions,
    )


def monthly_report(questions: DataFrame) -> DataFrame:
    """Q-02, A-21: counts, rounded means and answers per month, in two partitions."""
    return questions.sparkSession.sql(
        """
        SELECT /*+ COALESCE(2) */
            year, month,
            COUNT(*) AS total_questions,
            ROUND(AVG(score), 2) AS avg_score,
            ROUND(AVG(view_count), 0) AS avg_views,
            SUM(answer_count) AS total_answers,
            SUM(CASE WHEN is_answered = 1 THEN 1 ELSE 0 END) AS answered_count
        FROM {questions}
        GROUP BY year, month
        """,
        questions=questions,
    )


def rank_report(ranked: DataFrame, k: int = 10, partitions: int = 4) -> DataFrame:
    """Q-03: the first rows by score of a frame that ``global_ranks`` made."""
    return ranked.sparkSession.sql(
        f"""
        SELECT /*+ REPARTITION({int(partitions)}) */
            question_id, title, score, view_count, score_rank, views_rank,
            ROUND(score_percentile, 4) AS score_percentile
        FROM {{ranked}}
        ORDER BY score DESC, question_id
        LIMIT :k
        """,
        args={"k": k},
        ranked=ranked,
    )


def tags_of_high_scores(posts: DataFrame, above: int = 10) -> DataFrame:
    """Q-04, A-22: posts above a score per packed tag string."""
    return posts.sparkSession.sql(
        """
        WITH high_score_posts AS (SELECT Tags FROM {posts} WHERE Score > :above)
        SELECT Tags, COUNT(*) AS Count FROM high_score_posts GROUP BY Tags
        """,
        args={"above": above},
        posts=posts,
    )


def above_average_posts(posts: DataFrame) -> DataFrame:
    """Q-05, F-07: posts above the mean score."""
    return posts.sparkSession.sql(
        "SELECT * FROM {posts} WHERE Score > (SELECT AVG(Score) FROM {posts})", posts=posts
    )


def posts_with_tag_names(posts: DataFrame, tags: DataFrame, key: str = "Id") -> DataFrame:
    """Q-06, J-08: posts paired with each tag name that their packed tags contain as a substring.

    A ``LIKE '%name%'`` join would compare each post with each name. A name cannot
    span two tags, so names are matched once per distinct tag, as an equi-join with the
    substrings of that tag, and posts reach the names through their tags.
    """
    vocabulary = posts.select(F.explode("TagsList").alias("Tag")).distinct()
    starts = F.sequence(F.lit(1), F.length("Tag"))
    suffixes = vocabulary.filter(F.length("Tag") > 0).select("Tag", F.explode(starts).alias("s"))
    names = tags.select("TagName").distinct()
    # Only lengths that a name has; the list is no longer than the longest name.
    lengths = names.agg(F.collect_set(F.length("TagName"))).scalar()
    sized = suffixes.withColumn("_lengths", lengths).select("Tag", "s", F.explode("_lengths").alias("n"))
    pieces = sized.filter("n <= length(Tag) - s + 1").select("Tag", F.expr("substring(Tag, s, n)").alias("TagName")).distinct()
    per_tag = pieces.join(names, "TagName").groupBy("Tag").agg(F.collect_set("TagName").alias("_names"))
    found = lookup_join(
        posts.select(key, F.explode(F.array_distinct("TagsList")).alias("Tag")), per_tag, ["Tag"], salt_by=[key]
    )
    return found.select(key, F.explode("_names").alias("TagName")).distinct()

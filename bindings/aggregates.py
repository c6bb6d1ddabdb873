"""Aggregates, joins, distribution reports, SQL reports."""

from __future__ import annotations

from pyspark.sql import functions as F


from agorastat.functions.text import words
from agorastat.operators import aggregates as agg, order_stats
from agorastat.plans import sql as reports
from agorastat.sources.readers import shape_questions
from bindings.registry import POSTS, QUESTIONS, posts, query, raw_questions, sql_words, table, tidy


def _questions(spark, d):
    return shape_questions(raw_questions(spark, d))


@query("a01_tag_statistics", f"""
WITH {POSTS} SELECT Tag, COUNT(Id) AS QuestionCount, ROUND(AVG(Score), 6) AS AvgScore, CAST(SUM(Score) AS BIGINT) AS TotalScore,
  ROUND(AVG(ViewCount), 6) AS AvgViews, CAST(SUM(ViewCount) AS BIGINT) AS TotalViews, ROUND(AVG(AnswerCount), 6) AS AvgAnswers,
  ROUND(AVG(HasAcceptedAnswer), 6) AS AcceptedAnswerRate, MIN(Year) AS FirstYear, MAX(Year) AS LastYear
FROM tagged GROUP BY Tag
""")
def tag_statistics(spark, d):
    return tidy(agg.tag_statistics(posts(spark, d)))


def _period_sql(granularity: str) -> str:
    return f"""
    WITH {POSTS} SELECT strftime(date_trunc('{granularity}', CreationDate), '%Y-%m-%d') AS Period, COUNT(*) AS Count,
      ROUND(AVG(Score), 6) AS AvgScore, CAST(SUM(Score) AS BIGINT) AS TotalScore FROM posts GROUP BY 1
    """


def _by_period(spark, d, granularity):
    return tidy(agg.by_period(posts(spark, d), granularity=granularity).withColumn("Period", F.to_date("Period")))


@query("a02_by_day", _period_sql("day"))
def by_day(spark, d):
    return _by_period(spark, d, "day")


@query("a02_by_week", _period_sql("week"))
def by_week(spark, d):
    return _by_period(spark, d, "week")


@query("a02_by_month", _period_sql("month"))
def by_month(spark, d):
    return _by_period(spark, d, "month")


@query("a02_by_year", _period_sql("year"))
def by_year(spark, d):
    return _by_period(spark, d, "year")


@query("a03_tag_counts", f"WITH {POSTS} SELECT Tag, COUNT(*) AS Count FROM tagged GROUP BY Tag")
def tag_counts(spark, d):
    return agg.tag_counts(posts(spark, d))


@query("a04_monthly_counts", f"WITH {POSTS} SELECT Year, Month, COUNT(*) AS QuestionCount FROM posts GROUP BY ALL")
def monthly_counts(spark, d):
    return tidy(agg.monthly_counts(posts(spark, d)))


@query("a05_tag_scores", f"""
WITH {POSTS} SELECT Tag, CAST(SUM(Score) AS BIGINT) AS TotalScore, COUNT(*) AS Count, ROUND(AVG(Score), 6) AS AvgScore
FROM tagged GROUP BY Tag
""")
def tag_scores(spark, d):
    return tidy(agg.tag_scores(posts(spark, d)))


@query("a06_tag_post_counts", f"WITH {POSTS} SELECT Tag, COUNT(*) AS PostIdsCount FROM tagged GROUP BY Tag")
def tag_post_counts(spark, d):
    return agg.tag_post_counts(posts(spark, d))


@query("a06_tag_post_lists", f"""
WITH {POSTS} SELECT Tag, CAST(COUNT(*) AS BIGINT) AS PostIds, CAST(SUM(Id) AS BIGINT) AS IdSum, MIN(Id) AS FirstId, MAX(Id) AS LastId
FROM tagged GROUP BY Tag
""")
def tag_post_lists(spark, d):
    parts = agg.tag_post_lists(posts(spark, d), list_size=1000)
    ids = parts.select("Tag", F.explode("PostIds").alias("Id"))
    return ids.groupBy("Tag").agg(
        F.count("Id").alias("PostIds"), F.sum("Id").alias("IdSum"), F.min("Id").alias("FirstId"), F.max("Id").alias("LastId")
    )


@query("a07_tag_score_range", f"""
WITH {POSTS} SELECT Tag, MIN(Score) AS MinScore, MAX(Score) AS MaxScore, CAST(SUM(Score) AS BIGINT) AS SumScore,
  COUNT(*) AS Count, ROUND(AVG(Score), 6) AS AvgScore FROM tagged GROUP BY Tag
""")
def tag_score_range(spark, d):
    return tidy(agg.tag_score_range(posts(spark, d)))


@query("a08_tag_score_totals", f"WITH {POSTS} SELECT Tag, CAST(SUM(Score) AS BIGINT) AS TotalScore FROM tagged GROUP BY Tag")
def tag_score_totals(spark, d):
    return agg.tag_score_totals(posts(spark, d))


@query("a20_summary", f"""
WITH {QUESTIONS} SELECT COUNT(*) AS TotalQuestions, ROUND(AVG(score), 6) AS AvgScore, ROUND(AVG(view_count), 6) AS AvgViews,
  ROUND(AVG(answer_count), 6) AS AvgAnswers, CAST(SUM(is_answered) AS BIGINT) AS AnsweredQuestions, ROUND(AVG(tag_count), 6) AS AvgTags,
  ROUND(AVG(title_length), 6) AS AvgTitleLength, ROUND(AVG(body_length), 6) AS AvgBodyLength FROM questions
""")
def summary(spark, d):
    return tidy(agg.summary(_questions(spark, d)))


@query("a23_label_distribution", "SELECT CAST(quality AS BIGINT) AS quality, COUNT(*) AS Count FROM labels GROUP BY ALL")
def label_distribution(spark, d):
    return tidy(agg.distribution(table(spark, d, "labels"), "quality"))


@query("a26_histogram", """
WITH e AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 30)) AS BIGINT), 29) AS Bin, COUNT(*) AS n FROM lineitem, e GROUP BY 1)
SELECT i AS Bin, ROUND(lo + (hi - lo) / 30 * i, 4) AS "From", ROUND(lo + (hi - lo) / 30 * (i + 1), 4) AS "To", coalesce(n, 0) AS Count
FROM range(30) r(i) CROSS JOIN e LEFT JOIN b ON b.Bin = i
""")
def histogram(spark, d):
    return tidy(order_stats.histogram(table(spark, d, "lineitem"), "l_extendedprice"), 4)


@query("a27_box_statistics", """
WITH q AS (SELECT l_returnflag, l_linestatus, COUNT(*) AS n, MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi,
  quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3
  FROM lineitem GROUP BY ALL)
SELECT l_returnflag || l_linestatus AS Kind, n AS Count, ROUND(lo, 4) AS Min, ROUND(q1, 4) AS Q1, ROUND(q2, 4) AS Median, ROUND(q3, 4) AS Q3, ROUND(hi, 4) AS Max,
  ROUND(MIN(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS LowWhisker,
  ROUND(MAX(l_extendedprice) FILTER (l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS HighWhisker,
  COUNT(*) FILTER (l_extendedprice NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS Outliers
FROM lineitem JOIN q USING (l_returnflag, l_linestatus) GROUP BY ALL
""")
def box_statistics(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("Kind"), "l_extendedprice"
    )
    return tidy(order_stats.box_statistics(lines, "Kind", "l_extendedprice"), 4)


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a28_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS ColumnA, '{b}' AS ColumnB, ROUND(corr({a}, {b}), 6) AS Correlation FROM lineitem"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[:i]))
def correlations(spark, d):
    return tidy(order_stats.correlations(table(spark, d, "lineitem"), CORRELATED))


@query("a29_share_of_total", """
SELECT event_type, COUNT(*) AS Total, ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS Percent FROM events GROUP BY event_type
""")
def share_of_total(spark, d):
    return tidy(agg.share_of_total(table(spark, d, "events"), "event_type"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("a30_two_way_table", "SELECT strftime(ts, '%Y-%m-%d') AS Day, " + ", ".join(
    f"NULLIF(COUNT(*) FILTER (event_type = '{t}'), 0) AS \"{t}\"" for t in EVENT_TYPES) + " FROM events GROUP BY 1")
def two_way_table(spark, d):
    events = table(spark, d, "events").withColumn("Day", F.to_date("ts"))
    return tidy(agg.two_way_table(events, "Day", "event_type", EVENT_TYPES))


@query("a31_weekday_hours", """
SELECT dayofweek(ts) + 1 AS DayOfWeek, hour(ts) AS Hour, COUNT(*) AS Count FROM events GROUP BY ALL
""")
def weekday_hours(spark, d):
    return tidy(agg.weekday_hours(table(spark, d, "events"), "ts"))


@query("a32_word_frequency", f"""
SELECT Word, COUNT(*) AS Count FROM (SELECT unnest({sql_words("lower(text)")}) AS Word FROM documents) GROUP BY Word
ORDER BY Count DESC, Word LIMIT 100
""")
def word_frequency(spark, d):
    docs = table(spark, d, "documents").select(words(F.lower("text")).alias("Tokens"))
    return agg.word_frequency(docs, "Tokens")


@query("a34_headline", f"""
WITH {POSTS} SELECT COUNT(*) AS TotalQuestions, COUNT(DISTINCT OwnerUserId) AS ActiveUsers,
  ROUND(AVG(CASE WHEN AnswerCount > 3 THEN 1 ELSE 0 END), 6) AS AnswerRate, ROUND(AVG(HasAcceptedAnswer), 6) AS AcceptedRate
FROM posts WHERE PostTypeId = 1
""")
def headline(spark, d):
    fewer = posts(spark, d).withColumn("AnswerCount", F.greatest(F.col("AnswerCount") - 3, F.lit(0)))
    return tidy(agg.headline(fewer))


@query("t01_ordered_tags", f"WITH {POSTS} SELECT Tag, COUNT(*) AS Count FROM tagged GROUP BY Tag ORDER BY Count DESC, Tag")
def ordered_tags(spark, d):
    return agg.top(agg.tag_counts(posts(spark, d)), "Count", "Tag")


@query("t02_ordered_scores", f"""
WITH {POSTS} SELECT Tag, CAST(SUM(Score) AS BIGINT) AS TotalScore FROM tagged GROUP BY Tag ORDER BY TotalScore DESC, Tag
""")
def ordered_scores(spark, d):
    return agg.top(agg.tag_score_totals(posts(spark, d)), "TotalScore", "Tag")


@query("t03_top_questions", f"""
WITH {QUESTIONS} SELECT question_id, title, score FROM questions ORDER BY score DESC, question_id LIMIT 15
""")
def top_questions(spark, d):
    found = agg.top(raw_questions(spark, d).select("question_id", "title", "score"), "score", "question_id", 15)
    return tidy(found)


# --- SQL reports ------------------------------------------------------------

@query("q01_above_average_by_month", f"""
WITH {QUESTIONS}, m AS (SELECT year, month, AVG(score) AS avg_score FROM questions GROUP BY ALL)
SELECT question_id, title, score, view_count, m.year, m.month, ROUND(avg_score, 2) AS monthly_avg_score
FROM questions q CROSS JOIN m WHERE score >= 5 AND score > (SELECT AVG(score) FROM questions)
ORDER BY score DESC, question_id, m.year, m.month LIMIT 10
""")
def above_average_by_month(spark, d):
    return tidy(reports.above_average_by_month(_questions(spark, d)))


@query("q02_monthly_report", f"""
WITH {QUESTIONS} SELECT year, month, COUNT(*) AS total_questions, ROUND(AVG(score), 2) AS avg_score, ROUND(AVG(view_count), 0) AS avg_views,
  CAST(SUM(answer_count) AS BIGINT) AS total_answers, CAST(SUM(is_answered) AS BIGINT) AS answered_count FROM questions GROUP BY ALL
""")
def monthly_report(spark, d):
    return tidy(reports.monthly_report(_questions(spark, d)))


RANKS = {
    "score_rank": ("rank", "score"),
    "views_rank": ("dense_rank", "view_count"),
    "score_percentile": ("percent_rank", "score"),
}
RANK_SQL = """
SELECT question_id, title, score, view_count, RANK() OVER (ORDER BY score DESC) AS score_rank,
  DENSE_RANK() OVER (ORDER BY view_count DESC) AS views_rank, ROUND(PERCENT_RANK() OVER (ORDER BY score), {digits}) AS score_percentile
FROM questions
"""


def _ranked(spark, d):
    slim = raw_questions(spark, d).select("question_id", "title", "score", "view_count")
    return order_stats.global_ranks(slim, RANKS, salt_by=["question_id"])


@query("w08_global_ranks", f"WITH {QUESTIONS} {RANK_SQL.format(digits=6)}")
def global_ranks(spark, d):
    return tidy(_ranked(spark, d))


@query("q03_rank_report", f"WITH {QUESTIONS} {RANK_SQL.format(digits=4)} ORDER BY score DESC, question_id LIMIT 10")
def rank_report(spark, d):
    return tidy(reports.rank_report(_ranked(spark, d)))


@query("q04_tags_of_high_scores", f"WITH {POSTS} SELECT Tags, COUNT(*) AS Count FROM posts WHERE Score > 10 GROUP BY Tags")
def tags_of_high_scores(spark, d):
    return reports.tags_of_high_scores(posts(spark, d))


@query("q05_above_average_posts", f"""
WITH {POSTS} SELECT Id, Score, ViewCount, Tags FROM posts WHERE Score > (SELECT AVG(Score) FROM posts)
""")
def above_average_posts(spark, d):
    return tidy(reports.above_average_posts(posts(spark, d)).select("Id", "Score", "ViewCount", "Tags"))


NAMES = "SELECT DISTINCT substr(w, 1, 2) AS TagName FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)"


@query("q06_posts_with_tag_names", f"""
WITH names AS ({NAMES}) SELECT p_partkey AS Id, TagName FROM part JOIN names ON p_name LIKE '%' || TagName || '%'
""")
def posts_with_tag_names(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("Id"), F.split("p_name", " ").alias("TagsList"))
    names = parts.select(F.explode("TagsList").alias("w")).select(F.substring("w", 1, 2).alias("TagName")).distinct()
    return reports.posts_with_tag_names(parts, names)

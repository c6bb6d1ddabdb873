"""Tag series: growth, ranking, seasonality, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorastat.operators import aggregates as agg, trends as tr
from bindings.registry import TRENDS, posts, query, tidy

DAY = "strftime(Period, '%Y-%m-%d') AS Period"
TAGS = ["red", "ring", "widget"]


def monthly(spark, d):
    return tr.tag_trends(posts(spark, d))


def _dated(df):
    return tidy(df.withColumn("Period", F.to_date("Period")))


LAGGED = f"""WITH {TRENDS}, lagged AS (
  SELECT *, LAG(QuestionCount, 6) OVER (PARTITION BY Tag ORDER BY Period) AS PrevCount,
    SUM(QuestionCount) OVER (PARTITION BY Tag) AS TotalQuestions FROM trends),
grown AS (SELECT *, CASE WHEN PrevCount IS NOT NULL THEN ROUND((QuestionCount - PrevCount) / greatest(PrevCount, 1) * 100, 6) END AS Growth FROM lagged)
"""


@query("a16_tag_trends", f"WITH {TRENDS} SELECT Tag, {DAY}, QuestionCount, ROUND(AvgScore, 6) AS AvgScore, TotalViews FROM trends")
def tag_trends(spark, d):
    return _dated(monthly(spark, d))


@query("w01_growth", f"{LAGGED} SELECT Tag, {DAY}, QuestionCount, PrevCount, Growth FROM grown")
def growth(spark, d):
    return _dated(tr.with_growth(monthly(spark, d)).select("Tag", "Period", "QuestionCount", "PrevCount", "Growth"))


@query("w02_trending_tags", f"""{LAGGED} SELECT Tag, QuestionCount, Growth, CAST(TotalQuestions AS BIGINT) AS TotalQuestions FROM grown
WHERE Period = (SELECT MAX(Period) FROM trends) AND TotalQuestions >= 100""")
def trending_tags(spark, d):
    return tidy(tr.trending_tags(monthly(spark, d)))


@query("w03_declining_tags", f"""{LAGGED} SELECT Tag, QuestionCount, Growth, CAST(TotalQuestions AS BIGINT) AS TotalQuestions FROM grown
WHERE Period = (SELECT MAX(Period) FROM trends) AND TotalQuestions >= 100 AND Growth < 0""")
def declining_tags(spark, d):
    return tidy(tr.declining_tags(monthly(spark, d)))


@query("w04_moving_average", f"""WITH {TRENDS} SELECT Tag, {DAY}, QuestionCount,
ROUND(AVG(QuestionCount) OVER (PARTITION BY Tag ORDER BY trends.Period ROWS 2 PRECEDING), 6) AS QuestionCountMA FROM trends""")
def moving_average(spark, d):
    return _dated(tr.moving_average(monthly(spark, d)).select("Tag", "Period", "QuestionCount", "QuestionCountMA"))


@query("w05_top_tags_by_period", f"""WITH {TRENDS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY Period ORDER BY QuestionCount DESC, Tag) AS Rank FROM trends)
SELECT Tag, {DAY}, QuestionCount, ROUND(AvgScore, 6) AS AvgScore, TotalViews, Rank FROM r WHERE Rank <= 10""")
def top_tags_by_period(spark, d):
    return _dated(tr.top_tags_by_period(monthly(spark, d)))


YEARLY = f"""WITH {TRENDS}, yearly AS (
  SELECT Tag, CAST(year(Period) AS BIGINT) AS Year, CAST(SUM(QuestionCount) AS BIGINT) AS YearlyCount FROM trends GROUP BY ALL),
lagged AS (SELECT *, LAG(YearlyCount) OVER (PARTITION BY Tag ORDER BY Year) AS PrevYearCount FROM yearly),
grown AS (SELECT *, CASE WHEN PrevYearCount IS NOT NULL THEN ROUND((YearlyCount - PrevYearCount) / greatest(PrevYearCount, 1) * 100, 6) END AS YoYGrowth FROM lagged)
"""


@query("a19_yearly_counts", f"{YEARLY} SELECT * FROM yearly")
def yearly_counts(spark, d):
    return tidy(tr.yearly_counts(monthly(spark, d)))


@query("w06_yearly_growth", f"{YEARLY} SELECT * FROM grown")
def yearly_growth(spark, d):
    return tidy(tr.yearly_growth(monthly(spark, d)))


@query("w07_emerging_tags", f"""{YEARLY} SELECT * FROM grown
WHERE Year = (SELECT MAX(Year) FROM yearly) AND YoYGrowth >= -50 AND YearlyCount >= 50""")
def emerging_tags(spark, d):
    return tidy(tr.emerging_tags(monthly(spark, d), min_growth=-50.0))


@query("a17_seasonality", f"""WITH {TRENDS}, o AS (SELECT Tag, AVG(QuestionCount) AS OverallAvg FROM trends GROUP BY Tag)
SELECT Tag, month(Period) AS Month, ROUND(AVG(QuestionCount), 6) AS AvgQuestions, ROUND(STDDEV(QuestionCount), 6) AS StdQuestions,
  ROUND(OverallAvg, 6) AS OverallAvg, ROUND(AVG(QuestionCount) / OverallAvg, 6) AS SeasonalIndex
FROM trends JOIN o USING (Tag) GROUP BY Tag, month(Period), OverallAvg""")
def seasonality(spark, d):
    return tidy(tr.seasonality(monthly(spark, d)))


@query("a18_compare_tags", f"WITH {TRENDS} SELECT {DAY}, " + ", ".join(
    f"CAST(SUM(QuestionCount) FILTER (Tag = '{t}') AS BIGINT) AS {t}" for t in TAGS) + f""" FROM trends
WHERE Tag IN ('red', 'ring', 'widget') GROUP BY ALL""")
def compare_tags(spark, d):
    return _dated(tr.compare_tags(monthly(spark, d), TAGS))


@query("f08_chosen_series", f"""WITH {TRENDS} SELECT Tag, {DAY}, QuestionCount FROM trends WHERE Tag IN ('red', 'ring', 'widget')""")
def chosen_series(spark, d):
    chosen = monthly(spark, d).filter(F.col("Tag").isin(TAGS))
    return _dated(chosen.select("Tag", "Period", "QuestionCount"))


@query("a33_first_to_last_growth", f"""WITH {TRENDS}, e AS (
  SELECT Tag, arg_min(QuestionCount, Period) AS FirstCount, arg_max(QuestionCount, Period) AS LastCount FROM trends GROUP BY Tag)
SELECT Tag, FirstCount, LastCount, ROUND((LastCount - FirstCount) / FirstCount * 100, 6) AS Growth FROM e""")
def first_to_last_growth(spark, d):
    return tidy(agg.first_to_last_growth(monthly(spark, d)))


@query("w09_forecast", f"""WITH RECURSIVE {TRENDS}, n AS (
  SELECT Tag, Period, QuestionCount, row_number() OVER (PARTITION BY Tag ORDER BY Period) AS i, COUNT(*) OVER (PARTITION BY Tag) AS len FROM trends),
s AS (SELECT Tag, Period, i, len, CAST(QuestionCount AS DOUBLE) AS level FROM n WHERE i = 1
  UNION ALL SELECT n.Tag, n.Period, n.i, n.len, CAST(0.3::DOUBLE * n.QuestionCount + 0.7::DOUBLE * s.level AS DOUBLE) FROM s JOIN n ON n.Tag = s.Tag AND n.i = s.i + 1)
SELECT Tag, CAST(k AS BIGINT) AS Step, strftime(Period + to_months(CAST(k AS INTEGER)), '%Y-%m-%d') AS Period, ROUND(level, 6) AS Forecast
FROM s, range(1, 7) r(k) WHERE i = len AND len >= 3""")
def forecast(spark, d):
    return _dated(tr.forecast(monthly(spark, d)))


@query("d15_filled_to_the_last_period", f"""WITH {TRENDS}, days AS (
  SELECT Tag, CAST(CreationDate AS DATE) AS Period, COUNT(*) AS QuestionCount FROM tagged GROUP BY ALL),
e AS (SELECT Tag, MIN(Period) AS lo, (SELECT MAX(Period) FROM days) AS hi FROM days GROUP BY Tag),
c AS (SELECT Tag, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Period FROM e)
SELECT Tag, strftime(c.Period, '%Y-%m-%d') AS Period, coalesce(QuestionCount, 0) AS QuestionCount FROM c LEFT JOIN days USING (Tag, Period)""")
def filled_to_the_last_period(spark, d):
    daily = tr.tag_trends(posts(spark, d), granularity="day")
    return _dated(tr.fill_calendar(daily, "day", until_last=True).select("Tag", "Period", "QuestionCount"))


@query("d14_filled_calendar", f"""WITH {TRENDS}, days AS (
  SELECT Tag, CAST(CreationDate AS DATE) AS Period, COUNT(*) AS QuestionCount FROM tagged GROUP BY ALL),
e AS (SELECT Tag, MIN(Period) AS lo, MAX(Period) AS hi FROM days GROUP BY Tag),
c AS (SELECT Tag, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS Period FROM e)
SELECT Tag, strftime(c.Period, '%Y-%m-%d') AS Period, coalesce(QuestionCount, 0) AS QuestionCount FROM c LEFT JOIN days USING (Tag, Period)""")
def filled_calendar(spark, d):
    daily = tr.tag_trends(posts(spark, d), granularity="day")
    return _dated(tr.fill_calendar(daily, "day").select("Tag", "Period", "QuestionCount"))

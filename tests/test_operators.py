import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from agorastat.operators import aggregates as agg, clean, order_stats, sentiment, trends as tr
from agorastat.operators.joins import hot_keys, lookup_join
from agorastat.plans import sql as reports

POST_FIELDS = """Id bigint, PostTypeId int, AcceptedAnswerId bigint, CreationDate string, Score int, ViewCount int,
Body string, Title string, Tags string, AnswerCount int, CommentCount int, FavoriteCount int"""


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (1, 1, 9, "2024-01-06T10:20:30", 15, 2000, "<p>é <code>a\nb</code> <code>c</code></p>", "How to read CSV file in Python?", "<python><csv>", 2, 0, None),
        (2, 1, None, "2024-01-08T00:00:00", 3, 500, "", "Why? How?", "<python>", 1, None, None),
        (3, 2, None, "bad date", None, None, None, None, None, None, None, None),
        (4, 1, None, "2024-02-01T23:59:59", -2, 10, "plain", "No tags", None, 0, 0, 0),
    ]
    return spark.createDataFrame(rows, POST_FIELDS)


def by_id(df):
    return {r["Id"]: r for r in df.collect()}


def test_clean_posts(raw):
    posts = by_id(clean.clean_posts(raw))
    first = posts[1]
    assert (first["Year"], first["Month"], first["DayOfWeek"], first["Hour"]) == (2024, 1, 7, 10)
    assert first["TagsList"] == ["python", "csv"] and first["NumTags"] == 2
    assert first["BodyClean"] == "é a b c" and first["BodyLength"] == 7 and first["BodyWordCount"] == 4
    assert first["CodeBlocks"] == "a\nb\nc" and first["HasCode"] == 1
    assert first["TitleLength"] == 31 and first["TitleWordCount"] == 7
    assert (first["HasAcceptedAnswer"], first["IsQuestion"], first["IsAnswer"]) == (1, 1, 0)
    third = posts[3]
    assert third["CreationDate"] is None and third["Score"] == 0 and third["FavoriteCount"] == 0
    assert third["TagsList"] == [] and third["BodyClean"] == "" and third["TitleLength"] is None
    assert third["TitleWordCount"] == 0 and third["IsAnswer"] == 1


def test_question_features(raw):
    rows = by_id(clean.question_features(clean.clean_posts(raw)))
    assert (rows[1]["HasQuestionMark"], rows[1]["NumQuestionMarks"], rows[1]["IsWeekend"]) == (1, 1, 1)
    assert rows[2]["NumQuestionMarks"] == 2 and rows[2]["IsWeekend"] == 0 and rows[2]["BodyWordCount"] == 0
    assert rows[1]["CodeRatio"] == pytest.approx(5 / 7) and rows[2]["CodeRatio"] == 0.0


def test_quality_rules(raw):
    posts = clean.clean_posts(raw)
    label = lambda rule: {i: r["QualityLabel"] for i, r in by_id(clean.label_quality(posts, rule)).items()}
    assert label("engagement") == {1: 2, 2: 1, 3: 0, 4: 0}
    assert label("score") == {1: 2, 2: 1, 3: 1, 4: 0}
    assert label("binary") == {1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0}


def test_users(spark):
    users = spark.createDataFrame(
        [(1, "2020-01-01T00:00:00", "2021-01-01T00:00:00", "<b>hi</b>", None, "Oslo", None, 1, 1, 1)],
        "Id int, CreationDate string, LastAccessDate string, AboutMe string, WebsiteUrl string, Location string, Reputation int, Views int, UpVotes int, DownVotes int",
    )
    row = clean.clean_users(users, "2020-01-31").first()
    assert (row["AccountAge"], row["AboutMeClean"], row["HasWebsite"], row["HasLocation"], row["Reputation"]) == (30, "hi", 0, 1, 0)
    assert clean.clean_users(users).first()["AccountAge"] > 30


def test_filters(raw):
    posts = clean.clean_posts(raw)
    ids = lambda df: sorted(r["Id"] for r in df.collect())
    assert ids(clean.questions(posts)) == [1, 2, 4] and ids(clean.answers(posts)) == [3]
    assert ids(clean.in_date_range(posts, "2024-01-07", "2024-02-01")) == [2, 4]
    assert ids(clean.with_tags(posts, ["csv", "python"])) == [1, 2]
    assert ids(clean.with_tags(posts, ["csv", "python"], match_all=True)) == [1]
    assert ids(clean.with_tags(posts, [])) == [] and ids(clean.with_tags(posts, [], True)) == [1, 2, 3, 4]
    assert ids(clean.complete(raw, ["Tags", "Score"])) == [1, 2]
    assert ids(clean.above_average(posts)) == [1]


def test_deduplicate_keeps_least_id_and_nulls(spark):
    rows = [(3, "a", None, "x"), (1, "a", None, "y"), (2, "a", "b", "z"), (5, None, None, "u"), (4, None, None, "v")]
    kept = clean.deduplicate(spark.createDataFrame(rows, "Id int, Title string, BodyClean string, Other string"))
    assert sorted((r["Id"], r["Other"]) for r in kept.collect()) == [(1, "y"), (2, "z"), (4, "v")]
    assert kept.columns == ["Id", "Title", "BodyClean", "Other"]


def test_tag_operators_ignore_missing_tags(raw):
    posts = clean.clean_posts(raw)
    assert {r["Tag"]: r["Count"] for r in agg.tag_counts(posts).collect()} == {"python": 2, "csv": 1}
    assert {r["Tag"]: r["AvgScore"] for r in agg.tag_scores(posts).collect()} == {"python": 9.0, "csv": 15.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; some keys are null or unmatched."""
    rng = random.Random(7)
    rows = [(i, 0 if i % 3 == 0 else rng.choice([None, *range(1, 60)])) for i in range(3000)]
    lookup = [(k, f"v{k}") for k in range(0, 50)] + [(None, "none")]
    return rows, lookup, spark.createDataFrame(rows, "i int, k int"), spark.createDataFrame(lookup, "k int, v string")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("min_rows", [1, 50, 200_000])
def test_lookup_join_is_a_plain_join(skewed, how, min_rows):
    rows, lookup, left, right = skewed
    names = dict(lookup)
    expected = [(i, k, names.get(k)) for i, k in rows if how == "left" or k in names]
    got = lookup_join(left, right, ["k"], how, salt_by=["i"], slice_rows=min_rows).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_hot_keys_are_split_by_their_size(skewed):
    _, _, left, _ = skewed
    hot = {r["k"]: r["_slices"] for r in hot_keys(left, ["k"], 100).collect()}
    assert hot == {0: 10}


def test_tag_post_lists_keep_every_id(spark):
    rows = [(i, "<hot>" if i % 3 else "<hot><rare>") for i in range(500)]
    posts = spark.createDataFrame(rows, "Id int, Tags string")
    parts = agg.tag_post_lists(posts, list_size=50).collect()
    ids = {}
    for p in parts:
        ids.setdefault(p["Tag"], []).extend(p["PostIds"])
    assert sorted(ids["hot"]) == list(range(500)) and len([p for p in parts if p["Tag"] == "hot"]) == 10


@pytest.mark.parametrize("ranges", [1, 7, None])
def test_global_ranks_equal_sql(spark, ranges, monkeypatch):
    rng = random.Random(3)
    rows = [(i, 5 if i % 3 == 0 else rng.choice([None, *range(40)]), rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, score int, views double")
    spec = {"r": ("rank", "score"), "d": ("dense_rank", "views"), "p": ("percent_rank", "score"), "ds": ("dense_rank", "score")}
    if ranges:
        plain = order_stats.running_counts
        monkeypatch.setattr(order_stats, "running_counts", lambda *a, **k: plain(*a, **k, ranges=ranges))
    got = order_stats.global_ranks(df, spec, salt_by=["id"], slice_rows=50)
    df.createOrReplaceTempView("ranked_rows")
    expected = spark.sql(
        """SELECT id, score, views, RANK() OVER (ORDER BY score DESC) r, DENSE_RANK() OVER (ORDER BY views DESC) d,
        PERCENT_RANK() OVER (ORDER BY score) p, DENSE_RANK() OVER (ORDER BY score DESC) ds FROM ranked_rows"""
    )
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))


def test_box_statistics_equal_numpy(spark):
    import numpy as np

    rng = random.Random(5)
    data = {"a": [rng.gauss(0, 1) for _ in range(301)] + [50.0], "b": [1.0] * 20 + [2.0], "c": [4.0]}
    rows = [(k, v) for k, values in data.items() for v in values] + [("a", None)]
    got = {r["k"]: r for r in order_stats.box_statistics(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()}
    for k, values in data.items():
        q1, q2, q3 = np.percentile(values, [25, 50, 75])
        inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        r = got[k]
        assert (r["Q1"], r["Median"], r["Q3"]) == pytest.approx((q1, q2, q3))
        assert (r["Count"], r["LowWhisker"], r["HighWhisker"], r["Outliers"]) == (
            len(values), min(inside), max(inside), len(values) - len(inside),
        )


def test_histogram_keeps_empty_bins_and_constant_columns(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 0, 1, 10)] + [(None,)], "v double")
    assert [r["Count"] for r in order_stats.histogram(df, "v", 5).orderBy("Bin").collect()] == [3, 0, 0, 0, 1]
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r["Count"] for r in order_stats.histogram(same, "v", 3).orderBy("Bin").collect()] == [2, 0, 0]


@pytest.fixture(scope="module")
def series(spark):
    months = lambda n, start=1: [dt.datetime(2024, start + i, 1) for i in range(n)]
    rows = [("long", m, c) for m, c in zip(months(8), [0, 10, 20, 30, 40, 50, 60, 90])]
    rows += [("gap", dt.datetime(2024, 1, 1), 5), ("gap", dt.datetime(2024, 4, 1), 7), ("gap", dt.datetime(2024, 8, 1), 3)]
    rows += [("single", dt.datetime(2024, 2, 1), 4), ("pair", dt.datetime(2024, 1, 1), 8), ("pair", dt.datetime(2024, 8, 1), 2)]
    return spark.createDataFrame(rows, "Tag string, Period timestamp, QuestionCount bigint").withColumns(
        {"AvgScore": F.lit(1.0), "TotalViews": F.col("QuestionCount") * 10}
    )


def test_growth_uses_one_for_a_zero_base(series):
    rows = {(r["Tag"], r["Period"].month): r["Growth"] for r in tr.with_growth(series, 1).collect()}
    assert rows["long", 1] is None and rows["long", 2] == 1000.0 and rows["long", 8] == 50.0
    assert rows["pair", 8] == -75.0


def test_trending_needs_rows_in_the_last_period(series):
    got = {r["Tag"]: r["Growth"] for r in tr.trending_tags(series, min_questions=5, lookback=1).collect()}
    assert set(got) == {"long", "gap", "pair"}
    assert {r["Tag"] for r in tr.declining_tags(series, 5, 1).collect()} == {"gap", "pair"}
    filled = tr.fill_calendar(series, until_last=True)
    assert {r["Tag"] for r in tr.trending_tags(filled, 1, 1).collect()} == {"long", "gap", "pair", "single"}


def test_calendar_fill(series):
    rows = [(r["Period"].month, r["QuestionCount"]) for r in tr.fill_calendar(series).filter("Tag = 'gap'").orderBy("Period").collect()]
    assert rows == [(1, 5), (2, 0), (3, 0), (4, 7), (5, 0), (6, 0), (7, 0), (8, 3)]


def test_forecast(series):
    rows = tr.forecast(series, periods=2).orderBy("Tag", "Step").collect()
    level = 0.0
    for value in [10, 20, 30, 40, 50, 60, 90]:
        level = 0.3 * value + 0.7 * level
    assert [(r["Tag"], r["Period"].month) for r in rows] == [("gap", 9), ("gap", 10), ("long", 9), ("long", 10)]
    assert rows[2]["Forecast"] == pytest.approx(level) == rows[3]["Forecast"]
    assert tr.forecast(series, tags=["pair"]).collect() == []


def test_moving_average_seasonality_and_ranking(series):
    ma = {(r["Tag"], r["Period"].month): r["QuestionCountMA"] for r in tr.moving_average(series, 3).collect()}
    assert ma["long", 3] == 10.0 and ma["long", 8] == pytest.approx(200 / 3)
    index = {(r["Tag"], r["Month"]): r["SeasonalIndex"] for r in tr.seasonality(series).collect()}
    assert index["pair", 1] == pytest.approx(8 / 5)
    top = [(r["Period"].month, r["Tag"]) for r in tr.top_tags_by_period(series, 1).collect()]
    assert sorted(top)[0] == (1, "pair") and len(top) == 8


def test_yearly(spark):
    rows = [("t", dt.datetime(2022, 1, 1), 10), ("t", dt.datetime(2023, 1, 1), 30), ("u", dt.datetime(2023, 1, 1), 99)]
    df = spark.createDataFrame(rows, "Tag string, Period timestamp, QuestionCount bigint")
    assert [r["YoYGrowth"] for r in tr.yearly_growth(df).filter("Tag = 't'").orderBy("Year").collect()] == [None, 200.0]
    assert [r["Tag"] for r in tr.emerging_tags(df, 50, 20).collect()] == ["t"]


def test_sentiment_summary_and_tags(spark):
    comments = spark.createDataFrame(
        [(1, 10, "great"), (2, 10, "bad bug"), (3, 11, None), (4, 99, "good")], "Id int, PostId int, Text string"
    )
    scored = sentiment.analyze_comments(comments)
    row = sentiment.summarize(scored).first()
    assert (row["TotalCount"], row["PositiveCount"], row["NegativeCount"], row["NeutralPercent"]) == (4, 2, 1, 25.0)
    posts = spark.createDataFrame([(10, ["a", "b"]), (11, ["a"])], "Id int, TagsList array<string>")
    tags = {r["Tag"]: (r["CommentCount"], r["AvgSentiment"]) for r in sentiment.by_tag(posts, scored, salt_by=["Text"]).collect()}
    assert tags == {"a": (3, 0.0), "b": (2, 0.0)}
    assert [r["Id"] for r in sentiment.toxic(scored).collect()] == [2]


def test_substring_tag_names(spark):
    posts = spark.createDataFrame([(1, ["javascript", "c"]), (2, ["java"]), (3, [])], "Id int, TagsList array<string>")
    names = spark.createDataFrame([("java",), ("script",), ("c",), ("absent",)], "TagName string")
    got = sorted(map(tuple, reports.posts_with_tag_names(posts, names).collect()))
    assert got == [(1, "c"), (1, "java"), (1, "script"), (2, "java")]


def test_headline_and_growth(raw, series):
    posts = clean.clean_posts(raw).withColumn("OwnerUserId", F.col("Id") % 2)
    row = agg.headline(posts).first()
    assert (row["TotalQuestions"], row["ActiveUsers"], row["AnswerRate"]) == (3, 2, pytest.approx(2 / 3))
    assert {r["Tag"]: r["Growth"] for r in agg.first_to_last_growth(series).collect()}["long"] is None


def test_share_of_total_and_two_way(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 5)], "k string, c string, n int")
    shares = {r["k"]: r["Percent"] for r in agg.share_of_total(df, "k", F.col("n")).collect()}
    assert shares == {"a": 37.5, "b": 62.5}
    wide = {r["k"]: (r["x"], r["y"]) for r in agg.two_way_table(df, "k", "c", ["x", "y"], F.sum("n")).collect()}
    assert wide == {"a": (1, 2), "b": (5, None)}


def test_correlations(spark):
    rows = [(float(i), float(-i), float(i % 3)) for i in range(20)]
    got = {(r[0], r[1]): r[2] for r in order_stats.correlations(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got["b", "a"] == pytest.approx(-1) and got["c", "a"] == pytest.approx(
        statistics.correlation([r[0] for r in rows], [r[2] for r in rows])
    )

"""Cleaning, scalar functions, filters and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorastat.functions import scalar, text as tx
from agorastat.operators import clean, text
from bindings.registry import (
    POSTS, QUESTIONS, RAW_POSTS, SPACE, posts, query, raw_posts, raw_questions, sql_strip, sql_words, table, tidy,
)

CODE = "regexp_extract_all(Body, '(?s)<code>(.*?)</code>', 1)"


@query("p01_clean_posts", f"""
WITH {RAW_POSTS}, c AS (SELECT *, {sql_strip('Body')} AS BodyClean, regexp_extract_all(Tags, '<([^>]+)>', 1) AS TagsList,
    array_to_string({CODE}, chr(10)) AS CodeBlocks FROM raw_posts)
SELECT Id, PostTypeId, AcceptedAnswerId, strftime(CreationDate, '%Y-%m-%d %H:%M:%S') AS CreationDate,
  coalesce(Score, 0) AS Score, CAST(0 AS BIGINT) AS ViewCount, CAST(0 AS BIGINT) AS CommentCount,
  year(CreationDate) AS Year, month(CreationDate) AS Month, dayofweek(CreationDate) + 1 AS DayOfWeek,
  hour(CreationDate) AS Hour, array_to_string(TagsList, ',') AS TagsList, len(TagsList) AS NumTags,
  md5(BodyClean) AS BodyClean, length(BodyClean) AS BodyLength, len({sql_words('BodyClean')}) AS BodyWordCount,
  length(Title) AS TitleLength, len({sql_words('Title')}) AS TitleWordCount,
  CASE WHEN length(CodeBlocks) > 0 THEN CAST(1 AS BIGINT) ELSE 0 END AS HasCode,
  CASE WHEN AcceptedAnswerId IS NOT NULL THEN CAST(1 AS BIGINT) ELSE 0 END AS HasAcceptedAnswer,
  CASE WHEN PostTypeId = 1 THEN CAST(1 AS BIGINT) ELSE 0 END AS IsQuestion,
  CASE WHEN PostTypeId = 2 THEN CAST(1 AS BIGINT) ELSE 0 END AS IsAnswer
FROM c
""")
def clean_posts(spark, d):
    cleaned = clean.clean_posts(raw_posts(spark, d))
    return tidy(
        cleaned.select(
            "Id", "PostTypeId", "AcceptedAnswerId", "CreationDate", "Score", "ViewCount", "CommentCount", "Year",
            "Month", "DayOfWeek", "Hour", F.array_join("TagsList", ",").alias("TagsList"), "NumTags",
            F.md5("BodyClean").alias("BodyClean"), "BodyLength", "BodyWordCount", "TitleLength", "TitleWordCount",
            "HasCode", "HasAcceptedAnswer", "IsQuestion", "IsAnswer",
        )
    )


@query("p02_clean_users", """
SELECT c_custkey AS Id, c_custkey AS Reputation, CAST(0 AS BIGINT) AS Views,
  CAST(date_diff('day', DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER), DATE '2020-01-01') AS BIGINT) AS AccountAge,
  c_mktsegment || ' ' || c_name AS AboutMeClean, length(c_mktsegment || ' ' || c_name) AS AboutMeLength,
  CASE WHEN c_acctbal > 0 THEN CAST(1 AS BIGINT) ELSE 0 END AS HasWebsite,
  CASE WHEN c_nationkey > 5 THEN CAST(1 AS BIGINT) ELSE 0 END AS HasLocation
FROM customer
""")
def clean_users(spark, d):
    days = (F.col("c_custkey") % 3000).cast("int")
    users = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Id"),
        F.col("c_custkey").alias("Reputation"),
        F.date_add(F.lit("1990-01-01").cast("date"), days).cast("string").alias("CreationDate"),
        F.lit(None).cast("string").alias("LastAccessDate"),
        F.concat(F.lit("<p>"), "c_mktsegment", F.lit("</p>\n<b>"), "c_name", F.lit("</b>")).alias("AboutMe"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("WebsiteUrl"),
        F.when(F.col("c_nationkey") > 5, F.col("c_nationkey").cast("string")).alias("Location"),
        *[F.lit(None).cast("int").alias(c) for c in ("Views", "UpVotes", "DownVotes")],
    )
    cleaned = clean.clean_users(users, as_of="2020-01-01")
    return tidy(
        cleaned.select(
            "Id", "Reputation", "Views", "AccountAge", "AboutMeClean", "AboutMeLength", "HasWebsite", "HasLocation"
        )
    )


@query("p03_clean_comments", f"""
SELECT conv_id AS Id, turn AS Turn, CAST(0 AS BIGINT) AS Score, md5({sql_strip('text')}) AS TextClean,
  length({sql_strip('text')}) AS TextLength, len({sql_words(sql_strip('text'))}) AS TextWordCount
FROM conversations
""")
def clean_comments(spark, d):
    comments = table(spark, d, "conversations").select(
        F.col("conv_id").alias("Id"), F.col("turn").alias("Turn"), F.col("text").alias("Text"),
        F.lit(None).cast("int").alias("Score"), F.lit("2024-01-01T00:00:00").alias("CreationDate"),
    )
    cleaned = clean.clean_comments(comments)
    return tidy(
        cleaned.select("Id", "Turn", "Score", F.md5("TextClean").alias("TextClean"), "TextLength", "TextWordCount")
    )


@query("p04_parse_tags", f"""
WITH {POSTS}, v AS (SELECT Tags, regexp_extract_all(Tags, '<([^>]+)>', 1) AS t FROM posts)
SELECT t[1] AS First, t[2] AS Second, len(t) AS NumTags, COUNT(*) AS Rows FROM v GROUP BY ALL
""")
def parse_tags(spark, d):
    t = tx.parse_tags("Tags")
    rows = posts(spark, d).select(t[0].alias("First"), t[1].alias("Second"), F.size(t).alias("NumTags"))
    return tidy(rows.groupBy("First", "Second", "NumTags").agg(F.count(F.lit(1)).alias("Rows")))


@query("p05_word_count", f"SELECT doc_id, len({sql_words('text')}) AS words FROM documents")
def word_count(spark, d):
    return tidy(table(spark, d, "documents").select("doc_id", tx.word_count("text").alias("words")))


@query("p06_strip_html", f"""
SELECT page_id, md5({sql_strip('html')}) AS text_hash, length({sql_strip('html')}) AS text_length FROM pages
""")
def strip_html(spark, d):
    clean_html = tx.strip_html("html")
    pages = table(spark, d, "pages").select("page_id", clean_html.alias("t"))
    return tidy(pages.select("page_id", F.md5("t").alias("text_hash"), F.length("t").alias("text_length")))


MARKED = """
SELECT doc_id, replace(replace(text, '. ', '</code> '), ', ', ' <code>') AS Body,
       replace(text, '. ', ' ``` ') AS Fenced FROM documents
"""


def _marked(spark, d):
    """Document texts whose commas open and whose full stops close a code element."""
    docs = table(spark, d, "documents")
    opened = F.replace(F.replace("text", F.lit(". "), F.lit("</code> ")), F.lit(", "), F.lit(" <code>"))
    return docs.select("doc_id", opened.alias("Body"), F.replace("text", F.lit(". "), F.lit(" ``` ")).alias("Fenced"))


@query("p07_code_text", f"""
SELECT doc_id, md5(array_to_string({CODE}, chr(10))) AS code_hash, len({CODE}) AS blocks FROM ({MARKED})
""")
def code_text(spark, d):
    return tidy(
        _marked(spark, d).select(
            "doc_id", F.md5(tx.code_text("Body")).alias("code_hash"), F.size(tx.code_blocks("Body")).alias("blocks")
        )
    )


@query("p08_code_snippets", f"""
WITH s AS (SELECT doc_id, list_concat(regexp_extract_all(Fenced, '(?s)<code>(.*?)</code>', 1),
  regexp_extract_all(Fenced, '(?s)```[{tx.WORD}]*\n?(.*?)```', 1)) AS c FROM ({MARKED}))
SELECT doc_id, len(c) AS snippets, md5(array_to_string(c, chr(10))) AS code_hash FROM s
""")
def code_snippets(spark, d):
    found = text.add_code_snippets(_marked(spark, d), "Fenced")
    return tidy(
        found.select(
            "doc_id", F.size("CodeSnippets").alias("snippets"),
            F.md5(F.array_join("CodeSnippets", "\n")).alias("code_hash"),
        )
    )


@query("p09_calendar_parts", """
SELECT year(ts) AS Year, month(ts) AS Month, dayofweek(ts) + 1 AS DayOfWeek, hour(ts) AS Hour, COUNT(*) AS Rows
FROM events GROUP BY ALL
""")
def calendar_parts(spark, d):
    parts = scalar.calendar_parts("ts")
    events = table(spark, d, "events").withColumns(parts)
    return tidy(events.groupBy(*parts).agg(F.count(F.lit(1)).alias("Rows")))


@query("p10_flags", """
SELECT CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS BIGINT) ELSE 0 END AS IsQuestion,
  CASE WHEN o_totalprice > 100000 THEN CAST(1 AS BIGINT) ELSE 0 END AS IsLarge, COUNT(*) AS Rows
FROM orders GROUP BY ALL
""")
def flags(spark, d):
    flagged = table(spark, d, "orders").select(
        scalar.flag(F.col("o_orderstatus") == "F").alias("IsQuestion"),
        scalar.flag(F.col("o_totalprice") > 100000).alias("IsLarge"),
    )
    return tidy(flagged.groupBy("IsQuestion", "IsLarge").agg(F.count(F.lit(1)).alias("Rows")))


FILLED = """
SELECT l_returnflag AS flag, COUNT(*) AS n, SUM(CASE WHEN l_quantity > 25 THEN l_quantity ELSE 0 END) AS quantity,
  CAST(COUNT(*) FILTER (l_linestatus <> 'O') AS BIGINT) AS with_text
FROM lineitem GROUP BY ALL
"""


def _gaps(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("status"),
    )


def _filled(df):
    return tidy(
        df.groupBy("flag").agg(
            F.count("quantity").alias("n"), F.sum("quantity").alias("quantity"), F.count("status").alias("with_text")
        )
    )


@query("p11_fill_columns", FILLED)
def fill_columns(spark, d):
    return _filled(clean.fill_zero(_gaps(spark, d), ["quantity"]))


@query("p12_fill_numeric", FILLED)
def fill_numeric(spark, d):
    return _filled(clean.fill_zero(_gaps(spark, d)))


def _label_sql(case: str) -> str:
    return f"WITH {POSTS} SELECT {case} AS QualityLabel, COUNT(*) AS Count FROM posts GROUP BY ALL"


def _labels(spark, d, rule, **limits):
    labelled = clean.label_quality(posts(spark, d), rule, **limits)
    return tidy(labelled.groupBy("QualityLabel").agg(F.count(F.lit(1)).alias("Count")))


@query("p13_quality_engagement", _label_sql(
    "CAST(CASE WHEN Score >= 5 AND ViewCount >= 1000 AND HasAcceptedAnswer = 1 THEN 2 "
    "WHEN Score >= 0 AND AnswerCount > 0 THEN 1 ELSE 0 END AS BIGINT)"))
def quality_engagement(spark, d):
    return _labels(spark, d, "engagement")


@query("p14_quality_score", _label_sql(
    "CAST(CASE WHEN Score >= 10 THEN 2 WHEN Score >= 0 THEN 1 ELSE 0 END AS BIGINT)"))
def quality_score(spark, d):
    return _labels(spark, d, "score")


@query("p15_quality_binary", _label_sql("CASE WHEN Score >= 10 THEN CAST(1 AS DOUBLE) ELSE 0 END"))
def quality_binary(spark, d):
    return _labels(spark, d, "binary")


@query("p16_question_features", f"""
WITH {RAW_POSTS}, c AS (SELECT *, {sql_strip('Body')} AS BodyClean, array_to_string({CODE}, chr(10)) AS CodeBlocks FROM raw_posts)
SELECT Id, length(Title) AS TitleLength, length(BodyClean) AS BodyLength, len({sql_words('Title')}) AS TitleWordCount,
  len({sql_words('BodyClean')}) AS BodyWordCount,
  CASE WHEN contains(Title, '?') THEN CAST(1 AS BIGINT) ELSE 0 END AS HasQuestionMark,
  length(regexp_replace(Title, '[^?]', '', 'g')) AS NumQuestionMarks,
  ROUND(length(CodeBlocks) / greatest(length(BodyClean), 1), 6) AS CodeRatio, CAST(2 AS BIGINT) AS NumTags,
  hour(CreationDate) AS PostHour, dayofweek(CreationDate) + 1 AS PostDayOfWeek,
  CASE WHEN dayofweek(CreationDate) IN (0, 6) THEN CAST(1 AS BIGINT) ELSE 0 END AS IsWeekend
FROM c
""")
def question_features(spark, d):
    features = clean.question_features(clean.clean_posts(raw_posts(spark, d)))
    return tidy(
        features.select(
            "Id", "TitleLength", "BodyLength", "TitleWordCount", "BodyWordCount", "HasQuestionMark",
            "NumQuestionMarks", "CodeRatio", "NumTags", "PostHour", "PostDayOfWeek", "IsWeekend",
        )
    )


@query("p18_combine_text", """
SELECT doc_id, md5(concat_ws(' | ', CASE WHEN lang <> 'en' THEN lang END, source, text)) AS combined FROM documents
""")
def combine_text(spark, d):
    docs = table(spark, d, "documents").withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))
    combined = text.combine_text(docs, ["lang", "source", "text"], separator=" | ")
    return combined.select("doc_id", F.md5("CombinedText").alias("combined"))


@query("p19_title_body_text", f"""
WITH {QUESTIONS} SELECT question_id, title || ' ' || body AS text FROM questions
""")
def title_body_text(spark, d):
    return text.combine_text(raw_questions(spark, d), ["title", "body"], "text").select("question_id", "text")


@query("p20_pack_tags", f"""
WITH {POSTS} SELECT Tags, COUNT(*) AS Rows FROM posts GROUP BY ALL
""")
def pack_tags(spark, d):
    packed = posts(spark, d).select(tx.pack_tags("TagsList").alias("Tags"))
    return packed.groupBy("Tags").agg(F.count(F.lit(1)).alias("Rows"))


@query("p21_ratios", """
SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p,
  CASE WHEN l_tax = 0 THEN 0 ELSE ROUND(l_discount / l_tax * 100, 2) END AS pct,
  CASE WHEN l_tax = 0 THEN -1 ELSE ROUND(l_quantity / l_tax, 6) END AS ratio
FROM lineitem
""".replace("l_linenumber AS n", "CAST(l_linenumber AS BIGINT) AS n"))
def ratios(spark, d):
    return tidy(
        table(spark, d, "lineitem").select(
            F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"),
            scalar.percentage("l_discount", "l_tax").alias("pct"),
            scalar.safe_divide("l_quantity", "l_tax", -1.0).alias("ratio"),
        )
    )


@query("p22_preview", """
SELECT doc_id, CASE WHEN length(text) > 40 THEN left(text, 37) || '...' ELSE text END AS shown FROM documents
""")
def preview(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.preview("text", 40).alias("shown"))


@query("p23_drop_html", f"""
SELECT page_id, md5(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^[{SPACE}]+|[{SPACE}]+$', '', 'g')) AS text_hash
FROM pages
""")
def drop_html(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(tx.drop_html("html")).alias("text_hash"))


# --- filters ----------------------------------------------------------------

def _type_sql(kind: int) -> str:
    return f"""WITH {POSTS} SELECT Tags, COUNT(*) AS Rows, CAST(SUM(Score) AS BIGINT) AS Score
    FROM posts WHERE PostTypeId = {kind} GROUP BY ALL"""


def _by_tags(df):
    return tidy(df.groupBy("Tags").agg(F.count(F.lit(1)).alias("Rows"), F.sum("Score").alias("Score")))


@query("f01_questions", _type_sql(1))
def questions(spark, d):
    return _by_tags(clean.questions(posts(spark, d)))


@query("f02_answers", _type_sql(2))
def answers(spark, d):
    return _by_tags(clean.answers(posts(spark, d)))


@query("f03_date_range", """
SELECT event_id, event_type, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'
""")
def date_range(spark, d):
    kept = clean.in_date_range(table(spark, d, "events"), "2024-01-05", "2024-01-12", "ts")
    return kept.select("event_id", "event_type", "value")


@query("f04_any_tag", f"""
WITH {POSTS} SELECT Tags, COUNT(*) AS Rows, CAST(SUM(Score) AS BIGINT) AS Score FROM posts
WHERE list_has_any(TagsList, ['red', 'ring', 'absent']) GROUP BY ALL
""")
def any_tag(spark, d):
    return _by_tags(clean.with_tags(posts(spark, d), ["red", "ring", "absent"]))


@query("f04_all_tags", f"""
WITH {POSTS} SELECT Tags, COUNT(*) AS Rows, CAST(SUM(Score) AS BIGINT) AS Score FROM posts
WHERE list_has_all(TagsList, ['red', 'ring']) GROUP BY ALL
""")
def all_tags(spark, d):
    return _by_tags(clean.with_tags(posts(spark, d), ["red", "ring"], match_all=True))


@query("f06_complete_rows", f"""
WITH {RAW_POSTS} SELECT Id, Score FROM raw_posts WHERE Score IS NOT NULL AND Tags IS NOT NULL
""")
def complete_rows(spark, d):
    return tidy(clean.complete(raw_posts(spark, d), ["Tags", "Score"]).select("Id", "Score"))


@query("f07_above_average", f"""
WITH {QUESTIONS} SELECT question_id, score FROM questions WHERE score > (SELECT AVG(score) FROM questions)
""")
def above_average(spark, d):
    return tidy(clean.above_average(raw_questions(spark, d), "score").select("question_id", "score"))


@query("t04_deduplicate", """
SELECT doc_id, lang, md5(text) AS text_hash, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1
""")
def deduplicate(spark, d):
    kept = clean.deduplicate(table(spark, d, "documents"), ["text", "lang"], "doc_id")
    return kept.select("doc_id", "lang", F.md5("text").alias("text_hash"), "n_chars")

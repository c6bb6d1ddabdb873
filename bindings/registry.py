"""Registered queries, their SQL, and the roles the test tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorastat.functions import text as tx
from agorastat.sources.readers import read_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Types both engines share: bigint, rounded double, text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("tinyint", "smallint", "int"):
            c = c.cast("bigint")
        elif kind in ("float", "double"):
            c = F.round(c.cast("double"), digits)
        elif kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "boolean":
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


# --- lines as tagged posts; the id repeats ---------------------------------

POSTS = """
posts AS (
    SELECT l_orderkey AS Id, CAST(l_quantity AS BIGINT) AS Score,
           CAST(floor(l_extendedprice) AS BIGINT) AS ViewCount,
           CAST(l_linenumber AS BIGINT) AS AnswerCount,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS HasAcceptedAnswer,
           l_shipdate AS CreationDate, CAST(year(l_shipdate) AS BIGINT) AS Year,
           CAST(month(l_shipdate) AS BIGINT) AS Month,
           string_split(p_name, ' ') AS TagsList,
           '<' || replace(p_name, ' ', '><') || '>' AS Tags,
           1 + l_linenumber % 2 AS PostTypeId, l_suppkey AS OwnerUserId
    FROM lineitem JOIN part ON l_partkey = p_partkey
),
tagged AS (SELECT *, unnest(TagsList) AS Tag FROM posts)
"""

TRENDS = POSTS + """,
trends AS (
    SELECT Tag, CAST(date_trunc('month', CreationDate) AS DATE) AS Period,
           COUNT(*) AS QuestionCount, AVG(Score) AS AvgScore, CAST(SUM(ViewCount) AS BIGINT) AS TotalViews
    FROM tagged GROUP BY ALL
)
"""


def posts(spark: SparkSession, folder: str) -> DataFrame:
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    tags = F.split("p_name", " ")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_orderkey").alias("Id"),
        F.col("l_quantity").cast("int").alias("Score"),
        F.floor("l_extendedprice").alias("ViewCount"),
        F.col("l_linenumber").alias("AnswerCount"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("HasAcceptedAnswer"),
        F.col("l_shipdate").alias("CreationDate"),
        F.year("l_shipdate").alias("Year"),
        F.month("l_shipdate").alias("Month"),
        tags.alias("TagsList"),
        tx.pack_tags(tags).alias("Tags"),
        (1 + F.col("l_linenumber") % 2).alias("PostTypeId"),
        F.col("l_suppkey").alias("OwnerUserId"),
    )


# --- orders as questions with a unique key ---------------------------------

QUESTIONS = """
questions AS (
    SELECT o_orderkey AS question_id, o_orderpriority || ' order' AS title,
           o_orderstatus || ' ' || o_orderpriority AS body,
           [o_orderstatus, o_orderpriority] AS tags,
           CAST(floor(o_totalprice / 10000) AS BIGINT) AS score,
           CAST(floor(o_totalprice) AS BIGINT) AS view_count,
           o_custkey % 7 AS answer_count,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_answered,
           CAST(o_orderdate AS DATE) AS creation_date,
           CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
           length(o_orderpriority || ' order') AS title_length,
           length(o_orderstatus || ' ' || o_orderpriority) AS body_length,
           2 AS tag_count
    FROM orders
)
"""


def raw_questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("question_id"),
        F.concat("o_orderpriority", F.lit(" order")).alias("title"),
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("body"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.floor(F.col("o_totalprice") / 10000).alias("score"),
        F.floor("o_totalprice").alias("view_count"),
        (F.col("o_custkey") % 7).alias("answer_count"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_answered"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("o_custkey").cast("int").alias("owner_reputation"),
    )


# --- pages, dated by the event of the same number, as raw dump posts --------

RAW_POSTS = """
raw_posts AS (
    SELECT page_id AS Id, 1 + page_id % 2 AS PostTypeId,
           CASE WHEN event_type = 'error' THEN event_id END AS AcceptedAnswerId,
           date_trunc('second', ts) AS CreationDate,
           CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS BIGINT) END AS Score,
           html AS Body, regexp_extract(html, '<title>([^<]*)</title>', 1) AS Title,
           '<' || event_type || '><' || split_part(url, '/', 3) || '>' AS Tags
    FROM pages JOIN events ON page_id = event_id
)
"""


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Text timestamps and missing counts, as the XML source gives them."""
    pages, events = table(spark, folder, "pages"), table(spark, folder, "events")
    nothing = F.lit(None)
    return pages.join(events, pages["page_id"] == events["event_id"]).select(
        F.col("page_id").alias("Id"),
        (1 + F.col("page_id") % 2).cast("int").alias("PostTypeId"),
        F.when(F.col("event_type") == "error", F.col("event_id")).alias("AcceptedAnswerId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("CreationDate"),
        F.when(F.col("event_type") != "view", F.floor("value").cast("int")).alias("Score"),
        F.col("html").alias("Body"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("Title"),
        F.concat(F.lit("<"), "event_type", F.lit("><"), F.split_part("url", F.lit("/"), F.lit(3)), F.lit(">")).alias("Tags"),
        *[nothing.cast("int").alias(c) for c in ("ViewCount", "AnswerCount", "CommentCount", "FavoriteCount")],
        *[nothing.cast("string").alias(c) for c in ("LastActivityDate", "LastEditDate", "ClosedDate")],
    )


# --- regular expressions shared with the SQL -------------------------------

SPACE, WORD = tx.SPACE, tx.WORD


def sql_strip(column: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(coalesce({column}, ''), '<[^>]+>', ' ', 'g'), "
        f"'[{SPACE}]+', ' ', 'g'))"
    )


def sql_words(column: str) -> str:
    return f"regexp_extract_all({column}, '[^{SPACE}]+')"


def sql_clean(column: str) -> str:
    text = f"coalesce({column}, '')"
    for pattern in (
        "<[^>]+>", "(?s)```.*?```", "`[^`]+`", f"https?://[^{SPACE}]+", f"[^{WORD}{SPACE}]", r"\p{Nd}+",
    ):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return f"lower(trim(regexp_replace({text}, '[{SPACE}]+', ' ', 'g')))"


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words))) + "]"

"""Sources and sinks: each query writes a table in one format and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorastat.sources import readers, schemas, writers
from agorastat.sources.storage import scratch_path
from bindings.registry import QUESTIONS, RAW_POSTS, query, raw_posts, raw_questions, table, tidy

CUSTOMER = "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, ROUND(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer"


@query("s01_xml", "SELECT page_id, url, md5(html) AS html FROM pages")
def xml(spark, d):
    path = scratch_path(spark, "s01")
    writers.save_xml(table(spark, d, "pages"), path, "pages", "page")
    read = readers.read_xml(spark, path, "page", "_page_id BIGINT, _url STRING, _html STRING")
    return read.select("page_id", "url", F.md5("html").alias("html"))


TYPED = f"""WITH {RAW_POSTS} SELECT Id, PostTypeId, AcceptedAnswerId, strftime(CreationDate, '%Y-%m-%d %H:%M:%S') AS CreationDate,
  Score, md5(Body) AS Body, Title, Tags FROM raw_posts"""
POST_COLUMNS = ["Id", "PostTypeId", "AcceptedAnswerId", "CreationDate", "Score"]


@query("s02_read_table", TYPED)
def read_table(spark, d):
    path = scratch_path(spark, "s02")
    writers.save_xml(raw_posts(spark, d), path, "posts")
    read = readers.read_table(spark, "posts", path, [*POST_COLUMNS, "Body", "Title", "Tags"])
    return tidy(read.select(*POST_COLUMNS, F.md5("Body").alias("Body"), "Title", "Tags"))


@query("s03_read_dump", """SELECT 'posts' AS name, COUNT(*) AS Rows FROM pages JOIN events ON page_id = event_id
UNION ALL SELECT 'comments', COUNT(*) FROM conversations UNION ALL SELECT 'users', COUNT(*) FROM customer
UNION ALL SELECT 'badges', COUNT(*) FROM events UNION ALL SELECT 'tags', COUNT(*) FROM part
UNION ALL SELECT 'votes', COUNT(*) FROM orders UNION ALL SELECT 'post_links', COUNT(*) FROM lineitem""")
def read_dump(spark, d):
    folder = scratch_path(spark, "s03")
    comments = table(spark, d, "conversations").select(
        F.col("conv_id").alias("PostId"), F.col("turn").alias("Id"), F.col("text").alias("Text")
    )
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("Id"), F.col("c_name").alias("DisplayName"))
    badges = table(spark, d, "events").select(F.col("event_id").alias("Id"), F.col("event_type").alias("Name"))
    tags = table(spark, d, "part").select(F.col("p_partkey").alias("Id"), F.col("p_name").alias("TagName"))
    votes = table(spark, d, "orders").select(F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("PostId"))
    links = table(spark, d, "lineitem").select(F.col("l_linenumber").alias("Id"), F.col("l_orderkey").alias("PostId"))
    written = {"posts": raw_posts(spark, d), "comments": comments, "users": users, "badges": badges}
    for name, df in (written | {"tags": tags, "votes": votes, "post_links": links}).items():
        writers.save_xml(df, f"{folder}/{schemas.FILES[name]}", name)
    counts = [
        df.agg(F.count("Id").alias("Rows")).select(F.lit(name).alias("name"), "Rows")
        for name, df in readers.read_dump(spark, folder).items()
    ]
    total = counts[0]
    for part in counts[1:]:
        total = total.unionByName(part)
    return total


@query("s04_parquet_partitions", """SELECT l_returnflag, l_linestatus, COUNT(*) AS Rows, ROUND(SUM(l_quantity), 2) AS quantity FROM lineitem
WHERE l_returnflag = 'R' GROUP BY ALL""")
def parquet_partitions(spark, d):
    path = scratch_path(spark, "s04")
    writers.save_parquet(table(spark, d, "lineitem"), path, ["l_returnflag", "l_linestatus"], compression="zstd")
    read = readers.read_parquet(spark, path).filter(F.col("l_returnflag") == "R")
    return tidy(read.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("Rows"), F.sum("l_quantity").alias("quantity")), 2)


@query("s05_parquet_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def parquet_columns(spark, d):
    return readers.read_parquet(spark, f"{d}/orders.parquet", ["o_orderkey", "o_orderstatus"])


@query("s06_csv_arrays", "SELECT doc_id, lang || '|' || source AS tags, md5(text) AS text FROM documents")
def csv_arrays(spark, d):
    path = scratch_path(spark, "s06")
    docs = table(spark, d, "documents").select("doc_id", F.array("lang", "source").alias("tags"), "text")
    writers.save_csv(docs, path)
    read = readers.read_csv(spark, path, schema="doc_id BIGINT, tags STRING, text STRING", multi_line=True)
    return read.select("doc_id", "tags", F.md5("text").alias("text"))


@query("s06_csv_breaks", r"""SELECT doc_id, length(lang || chr(10) || text || '\r' || chr(13)) AS n,
md5(lang || chr(10) || text || '\r' || chr(13)) AS text FROM documents""")
def csv_breaks(spark, d):
    """Texts with line breaks and backslashes, one row a line, so that a file is split."""
    path = scratch_path(spark, "s06-breaks")
    docs = table(spark, d, "documents").select("doc_id", F.concat("lang", F.lit("\n"), "text", F.lit("\\r\r")).alias("text"))
    writers.save_csv(docs, path, escape_breaks=True)
    read = readers.read_csv(spark, path, schema="doc_id BIGINT, text STRING", escaped_breaks=True)
    return tidy(read.select("doc_id", F.char_length("text").alias("n"), F.md5("text").alias("text")))


@query("s07_csv_inferred", CUSTOMER)
def csv_inferred(spark, d):
    path = scratch_path(spark, "s07")
    writers.save_csv(table(spark, d, "customer"), path)
    return tidy(readers.read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint")))


@query("s08_json", CUSTOMER)
def json(spark, d):
    path = scratch_path(spark, "s08")
    source = table(spark, d, "customer")
    writers.save_json(source, path)
    return tidy(readers.read_json(spark, path, source.schema))


@query("s09_json_inferred", """SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, ROUND(value, 6) AS value, props FROM events""")
def json_inferred(spark, d):
    path = scratch_path(spark, "s09")
    writers.save_json(table(spark, d, "events"), path)
    read = readers.read_json(spark, path)  # a time in JSON is text, so its type is not inferred
    return tidy(read.withColumn("ts", F.to_timestamp("ts")))


@query("s10_cached_view", "SELECT o_orderstatus, COUNT(*) AS Rows FROM orders GROUP BY ALL")
def cached_view(spark, d):
    writers.cache_view(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "cached_orders")
    return spark.sql("SELECT o_orderstatus, COUNT(*) AS Rows FROM cached_orders GROUP BY o_orderstatus")


@query("s11_profile", """SELECT COUNT(*) AS num_rows, CAST(5 AS BIGINT) AS num_columns, 'doc_id, text, lang, source, n_chars' AS columns,
  COUNT(*) FILTER (text IS NULL) + COUNT(*) FILTER (lang IS NULL) AS nulls FROM documents""")
def profile(spark, d):
    found = writers.profile(table(spark, d, "documents"))
    nulls = F.aggregate("null_counts", F.lit(0).cast("bigint"), lambda a, c: a + c["nulls"])
    return found.select("num_rows", "num_columns", "columns", nulls.alias("nulls"))


@query("s12_repartition_and_save", "SELECT event_type, COUNT(*) AS Rows FROM events GROUP BY ALL")
def repartition_and_save(spark, d):
    path = scratch_path(spark, "s12")
    writers.repartition_and_save(table(spark, d, "events"), path, partition_by=["event_type"])
    return readers.read_parquet(spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("Rows"))


SAMPLE_FACTS = "SELECT 0 AS strange, 0 AS repeated, 0 AS unlike, 1 AS near_share"


def _sample_facts(rows, kept, again, key, share):
    """Sampled rows that are not in the table, repeated ones, ones that a second draw lacks or adds, and whether the share is near."""
    counted = kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("n"))
    whole = rows.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("m"))
    second = again.select(*[F.col(c).alias(c) for c in kept.columns]).groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("k"))
    joined = whole.join(counted, kept.columns, "full").join(second, kept.columns, "full").fillna(0, ["n", "m", "k"])
    return tidy(
        joined.agg(
            F.count_if((F.col("n") > 0) & (F.col("m") == 0)).alias("strange"),
            F.count_if(F.col("n") > F.col("m")).alias("repeated"),
            F.count_if(F.col("n") != F.col("k")).alias("unlike"),
            (F.abs(F.sum("n") / F.sum("m") - share) < share / 2).alias("near_share"),
        )
    )


@query("s13_sample", SAMPLE_FACTS)
def sample(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    kept = writers.sample(rows, 0.1, key="o_orderkey")
    return _sample_facts(rows, kept, writers.sample(rows.repartition(7), 0.1, key="o_orderkey"), "o_orderkey", 0.1)


@query("s14_sample_copy", SAMPLE_FACTS)
def sample_copy(spark, d):
    path = scratch_path(spark, "s14")
    writers.create_sample(spark, f"{d}/lineitem.parquet", path, 0.05, key="l_orderkey")
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    rows = table(spark, d, "lineitem").select(*columns)
    kept = readers.read_parquet(spark, path).select(*columns)
    return _sample_facts(rows, kept, writers.sample(rows, 0.05, key="l_orderkey"), "l_orderkey", 0.05)


def _pages(spark, d):
    """Orders as API pages: a hundred questions of neighbouring numbers as the items of a page."""
    item = F.struct(
        F.col("o_orderkey").alias("question_id"),
        F.concat("o_orderpriority", F.lit(" order")).alias("title"),
        F.concat(F.lit("<p> "), "o_orderstatus", F.lit("</p><b> x</b>")).alias("body"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 10000).cast("int")).alias("score"),
        (F.col("o_orderstatus") == "F").alias("is_answered"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("creation_date"),
        F.struct(F.col("o_custkey").cast("int").alias("reputation")).alias("owner"),
    )
    return table(spark, d, "orders").groupBy(F.floor(F.col("o_orderkey") / 100)).agg(F.collect_list(item).alias("items")).select("items")


@query("s16_api_pages", """SELECT o_orderkey AS question_id, o_orderpriority || ' order' AS title, o_orderstatus || ' x' AS body,
  '<' || o_orderstatus || '><' || o_orderpriority || '>' AS tags_str, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(floor(o_totalprice / 10000) AS BIGINT) END AS score,
  CAST(0 AS BIGINT) AS view_count, CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS BIGINT) ELSE 0 END AS is_answered,
  strftime(o_orderdate, '%Y-%m-%d') AS creation_date, o_custkey AS owner_reputation, CAST(0 AS BIGINT) AS owner_user_id,
  o_orderstatus || '|' || o_orderpriority AS tags, CAST(0 AS BIGINT) AS answer_count FROM orders""")
def api_pages(spark, d):
    path = scratch_path(spark, "s16")
    writers.save_json(_pages(spark, d), path)
    return tidy(readers.read_api_pages(spark, path).withColumn("tags", F.array_join("tags", "|")))


@query("s17_shaped_questions", f"""WITH {QUESTIONS} SELECT question_id, score, view_count, answer_count, strftime(creation_date, '%Y-%m-%d') AS creation_date, year, month,
  title_length, body_length, CAST(tag_count AS BIGINT) AS tag_count, title, body, array_to_string(tags, '|') AS tags FROM questions""")
def shaped_questions(spark, d):
    shaped = readers.shape_questions(raw_questions(spark, d))
    return tidy(
        shaped.select(
            "question_id", "score", "view_count", "answer_count", "creation_date", "year", "month", "title_length",
            "body_length", "tag_count", "title", "body", F.array_join("tags", "|").alias("tags"),
        )
    )


@query("s18_question_store", f"""WITH {QUESTIONS} SELECT year, month, COUNT(*) AS Rows, CAST(SUM(score) AS BIGINT) AS score FROM questions GROUP BY ALL""")
def question_store(spark, d):
    path = scratch_path(spark, "s18")
    shaped = readers.shape_questions(raw_questions(spark, d))
    for _ in range(2):  # a second run replaces the partitions of the first
        writers.repartition_and_save(shaped, path, partition_by=["year", "month"], replace_partitions=True)
    stored = readers.read_parquet(spark, path)
    return tidy(stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("Rows"), F.sum("score").alias("score")))


@query("s19_typed_rows", """SELECT TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(l_orderkey AS VARCHAR) END AS BIGINT) AS Id,
  CAST(l_linenumber AS BIGINT) AS Score, CASE WHEN l_linenumber = 3 THEN 'Id' ELSE '' END AS Malformed, COUNT(*) AS Rows FROM lineitem GROUP BY ALL""")
def typed_rows(spark, d):
    names = [name for name, _ in schemas.columns("comments")]
    given = {
        "Id": F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.col("l_orderkey").cast("string")),
        "Score": F.col("l_linenumber").cast("string"),
    }
    raw = table(spark, d, "lineitem").select(*[given.get(n, F.lit(None).cast("string")).alias(n) for n in names])
    typed = readers.typed_rows(raw, "comments", keep_malformed=True)
    rows = typed.select("Id", "Score", F.array_join("Malformed", ",").alias("Malformed"))
    return tidy(rows.groupBy("Id", "Score", "Malformed").agg(F.count(F.lit(1)).alias("Rows")))

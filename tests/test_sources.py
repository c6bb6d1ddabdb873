import datetime as dt

import pytest
from pyspark.sql import functions as F

from agorastat.plans import stages
from agorastat.sources import readers, schemas, storage, writers

POSTS = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row Id="1" PostTypeId="1" Score="5" CreationDate="2024-01-02T03:04:05.678" Body="&lt;p&gt;a&#xA;b&lt;/p&gt; " Tags="&lt;x&gt;&lt;y&gt;" Title="T &amp; é" />
  <row Id="2" PostTypeId="2" Score="many" CreationDate="soon" ParentId="1" />
  <row Id="2x" Score="7" />
</posts>
"""


@pytest.fixture
def dump(tmp_path):
    (tmp_path / "Posts.xml").write_text(POSTS, encoding="utf-8")
    (tmp_path / "Badges.xml").write_text('<badges>\n<row Id="1" Name="Guru" Class="2" TagBased="True" />\n</badges>\n')
    return str(tmp_path)


def test_dump_table(spark, dump):
    rows = readers.read_table(spark, "posts", f"{dump}/Posts.xml", keep_malformed=True).collect()
    assert [r["Id"] for r in rows] == [1, 2, None]
    first = rows[0]
    assert first["Body"] == "<p>a\nb</p> " and first["Tags"] == "<x><y>" and first["Title"] == "T & é"
    assert first["CreationDate"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert [r["Malformed"] for r in rows] == [[], ["CreationDate", "Score"], ["Id"]]
    assert rows[2]["Score"] == 7 and rows[1]["ParentId"] == 1
    few = readers.read_table(spark, "posts", f"{dump}/Posts.xml", ["Score", "Id"])
    assert few.columns == ["Id", "Score"] and [r["Score"] for r in few.collect()] == [5, None, 7]


def test_dump_files_are_split(spark, tmp_path):
    lines = "\n".join(f'  <row Id="{i}" Score="{i % 7}" />' for i in range(20_000))
    (tmp_path / "Comments.xml").write_text(f"<comments>\n{lines}\n</comments>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = readers.read_table(spark, "comments", str(tmp_path / "Comments.xml"))
        assert df.rdd.getNumPartitions() > 1
        assert df.agg(F.count_distinct("Id"), F.sum("Score")).first() == (20_000, sum(i % 7 for i in range(20_000)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_are_parsed_once(spark, dump):
    shape = readers.read_table(spark, "posts", f"{dump}/Posts.xml")._jdf.queryExecution().executedPlan().toString()
    assert shape.count("from_xml(") == 1


def test_dump_directory(spark, dump):
    found = readers.read_dump(spark, dump)
    assert set(found) == {"posts", "badges"}
    assert found["badges"].first()["TagBased"] is True


def test_generic_xml(spark, dump):
    df = readers.read_xml(spark, f"{dump}/Posts.xml", schema="_Id STRING, _Score STRING")
    assert sorted(map(tuple, df.collect())) == [("1", "5"), ("2", "many"), ("2x", "7")]
    assert "Id" in readers.read_xml(spark, f"{dump}/Posts.xml").columns


def test_schema_registry():
    assert [len(schemas.columns(t)) for t in ("posts", "users", "comments", "tags", "votes", "badges")] == [23, 13, 8, 5, 6, 6]
    with pytest.raises(ValueError):
        schemas.columns("unknown")


def test_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b', ["x", "y"], 2023), (2, "line", None, 2024)], "Id int, t string, tags array<string>, Year int")
    path = lambda name: str(tmp_path / name)
    for codec in ("snappy", "gzip", "zstd", "none"):
        writers.save_parquet(df, path("p"), ["Year"], compression=codec)
    assert readers.read_parquet(spark, path("p"), ["Id", "Year"]).orderBy("Id").collect() == [(1, 2023), (2, 2024)]
    writers.save_csv(df, path("c"))
    assert readers.read_csv(spark, path("c"), schema="Id INT, t STRING, tags STRING, Year INT").orderBy("Id").first()["tags"] == "x|y"
    assert readers.read_csv(spark, path("c")).orderBy("Id").first()["t"] == 'a "q", b'
    writers.save_json(df, path("j"))
    assert readers.read_json(spark, path("j"), df.schema).orderBy("Id").collect() == df.collect()
    writers.save_xml(df.drop("tags"), path("x"))
    assert readers.read_xml(spark, path("x")).count() == 2


def test_partition_replacement_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "store")
    old = spark.createDataFrame([(1, 2023), (2, 2024)], "Id int, Year int")
    writers.save_parquet(old, path, ["Year"])
    writers.save_parquet(spark.createDataFrame([(9, 2024)], "Id int, Year int"), path, ["Year"], replace_partitions=True)
    assert sorted(r["Id"] for r in readers.read_parquet(spark, path).collect()) == [1, 9]


def test_keyed_sample_and_split_do_not_depend_on_partitions(spark):
    df = spark.range(5000)
    picks = [{r["id"] for r in writers.sample(df.repartition(n), 0.1, key="id").collect()} for n in (1, 9)]
    assert picks[0] == picks[1] and 400 < len(picks[0]) < 600
    assert 300 < writers.sample(df, 0.1).count() < 700


def test_profile_and_cache(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "Id int, t string")
    row = writers.profile(df).first()
    assert (row["num_rows"], row["num_columns"], row["columns"]) == (2, 2, "Id, t")
    assert {c["column"]: c["nulls"] for c in row["null_counts"]} == {"Id": 0, "t": 1}
    writers.cache_view(df, "cached_rows").unpersist()
    assert spark.table("cached_rows").count() == 2


def test_repartition_and_save_writes_few_files_per_folder(spark, tmp_path):
    import glob

    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    writers.repartition_and_save(df, str(tmp_path / "one"), 8, ["k"])
    assert len(glob.glob(str(tmp_path / "one" / "k=*" / "*.parquet"))) == 3
    writers.repartition_and_save(df, str(tmp_path / "more"), 8, ["k"], spread=4)
    assert len(glob.glob(str(tmp_path / "more" / "k=0" / "*.parquet"))) > 1
    writers.repartition_and_save(df, str(tmp_path / "auto"), partition_by=["k"])
    assert len(glob.glob(str(tmp_path / "auto" / "k=*" / "*.parquet"))) == 3
    writers.repartition_and_save(df, str(tmp_path / "plain"), 5)
    assert len(glob.glob(str(tmp_path / "plain" / "*.parquet"))) == 5


def test_api_pages(spark, tmp_path):
    (tmp_path / "page.json").write_text(
        '{"items": [{"question_id": 1, "title": "t", "body": "<p>a</p><p>b</p>", "tags": ["x", "y"], "is_answered": true,'
        ' "creation_date": 86400, "owner": {"reputation": 5}}, {"question_id": 2}]}\n'
    )
    first, second = readers.shape_questions(readers.read_api_pages(spark, str(tmp_path))).orderBy("question_id").collect()
    assert (first["body"], first["tags_str"], first["is_answered"], first["owner_reputation"]) == ("ab", "<x><y>", 1, 5)
    assert first["creation_date"] == dt.date(1970, 1, 2) and first["year"] == 1970 and first["tag_count"] == 2
    assert (second["title"], second["tags_str"], second["score"], second["tag_count"]) == ("", "", 0, 0)


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert storage.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = storage.materialize(spark.range(10), "numbers")
    assert storage.scratch_dir(spark) in df.inputFiles()[0] and df.count() == 10


def test_stages(spark, tmp_path):
    bodies = ["python list sort", "python pandas frame", "java class field", "java static method"]
    rows = "\n".join(
        f'<row Id="{i}" PostTypeId="{1 + i % 2}" Score="{i % 25 - 5}" CreationDate="2024-0{1 + i % 3}-01T00:00:00" Title="t{i}" Body="&lt;p&gt;{bodies[i % 4]} {"x" * (i % 9)}&lt;/p&gt;" />'
        for i in range(200)
    )
    (tmp_path / "Posts.xml").write_text(f"<posts>\n{rows}\n</posts>\n")
    paths = stages.Paths(str(tmp_path), str(tmp_path / "tables"), str(tmp_path / "models"))
    tables = stages.run(spark, paths, "full", nlp={"num_topics": 2, "max_iterations": 2, "min_doc_freq": 1}, ml={"numTrees": 3, "maxDepth": 2})
    spark.sparkContext.setJobGroup("counts", "rows of the stages")
    counts = {r["Stage"]: r["Rows"] for r in stages.stage_counts(spark, tables).collect()}
    assert counts == {"etl": 100, "nlp": 10, "ml": 1} == {n: t.count() for n, t in tables.items()} | counts
    spark.sparkContext.setJobGroup("counted", "")
    assert stages.stage_counts(spark, tables).collect() and not spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 <= tables["ml"].first()["accuracy"] <= 1
    assert set(stages.run(spark, paths, "ml", ml={"algorithm": "logistic"})) == {"ml"}
    with pytest.raises(ValueError):
        stages.run(spark, paths, "other")


ODD_ROWS = """
<?xml version="1.0"?>
<posts>
  <row Id="1" Score="5" Title="a &gt; b > c"/><row Id="2" Score="x" Title='q"t'/>
  <row\tId="3" Score="7"
      Title="several lines"
  />
  <row Id="4" Title="broken
  <row Id="5" Score="1"></row>
  <rowset Id="9"/>
  <row Id="6" Id="7"/>
</posts>
"""


def test_rows_of_any_layout_are_read(spark, tmp_path):
    (tmp_path / "Posts.xml").write_text(ODD_ROWS)
    path = str(tmp_path / "Posts.xml")
    rows = readers.read_table(spark, "posts", path, ["Id", "Score", "Title"], keep_malformed=True).collect()
    good = {r["Id"]: (r["Score"], r["Title"], r["Malformed"]) for r in rows if r["Id"] is not None}
    assert good == {1: (5, "a > b > c", []), 2: (None, 'q"t', ["Score"]), 3: (7, "several lines", []), 5: (1, None, [])}
    broken = [r["Malformed"][0].split() for r in rows if r["Id"] is None]
    assert sorted(broken) == [["<row", 'Id="4"', 'Title="broken'], ["<row", 'Id="6"', 'Id="7"/>']]
    assert {r["Id"] for r in readers.read_table(spark, "posts", path, ["Id"]).collect()} == {1, 2, 3, 5}
    element = readers.read_xml(spark, path, "row", "_Id BIGINT, _Title STRING").filter("Id IS NOT NULL").collect()
    assert {r["Id"]: r["Title"] for r in element} == {1: "a > b > c", 2: 'q"t', 3: "several lines", 5: None}


def test_one_line_of_many_rows_is_split(spark, tmp_path):
    rows = "".join(f'<row Id="{i}" Title="{"x" * 400}"/>' for i in range(5000))
    (tmp_path / "Posts.xml").write_text(f"<posts>{rows}</posts>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        read = readers.read_table(spark, "posts", str(tmp_path / "Posts.xml"), ["Id", "Title"])
        assert read.rdd.getNumPartitions() > 4
        assert read.select("Id").distinct().count() == read.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scratch_tables_go_with_their_owner(spark):
    with storage.scratch(spark) as folder:
        df = storage.materialize(spark.range(5), "numbers")
        assert folder in df.inputFiles()[0] and storage.path_exists(spark, folder)
    assert not storage.path_exists(spark, folder)


def test_one_csv_file_with_breaks_is_read_by_many_tasks(spark, tmp_path):
    odd = ["a\nb", "\\n", "\\\\\n\r\n", " end \n", 'q "x", \r', None, "\\s", "", "é\u2028", "\\"]
    rows = [(i, odd[i % len(odd)], [f"t{i}", "x\ny"]) for i in range(2000)]
    df = spark.createDataFrame(rows, "Id INT, `a.b` STRING, tags ARRAY<STRING>").toDF("Id", "a_b", "tags")
    path = str(tmp_path / "breaks")
    writers.save_csv(df.coalesce(1), path, escape_breaks=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = readers.read_csv(spark, path, schema="Id INT, a_b STRING, tags STRING", escaped_breaks=True)
        assert read.rdd.getNumPartitions() > 4
        assert {r["Id"]: (r["a_b"], r["tags"]) for r in read.collect()} == {i: (t, "|".join(g)) for i, t, g in rows}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")

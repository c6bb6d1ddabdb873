"""Sources: XML dumps, landed API pages, Parquet, CSV and JSON."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agorastat.functions.text import as_column, drop_html, pack_tags, unescaped_breaks
from agorastat.sources import schemas
from agorastat.sources.storage import path_exists

log = logging.getLogger(__name__)

ATTRIBUTE = "_"  # prefix that marks an XML attribute in the read schema


def _without_prefix(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.removeprefix(ATTRIBUTE) for c in df.columns])


# The rest of an opening tag up to the first > outside quotes.
_TAG_REST = """^((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+)>"""


def _pieces(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """What follows each ``<row_tag`` up to the next one, as ``piece``, and the rest of its opening tag, ``head`` (empty if broken).

    A raw < cannot stand in an attribute, so the tag itself is a safe separator: a file is
    split over tasks whatever its line breaks. What stands before the first row, and tags that only begin like the row's, go.
    """
    pieces = spark.read.option("lineSep", f"<{row_tag}").text(path).withColumnRenamed("value", "piece")
    own = pieces.filter(F.col("piece").rlike(r"^(?:/?>|\s+[^\s<])"))
    return own.withColumn("head", F.regexp_extract("piece", _TAG_REST, 0))


def read_xml(
    spark: SparkSession, path: str, row_tag: str = "row", schema: StructType | str | None = None
) -> DataFrame:
    """S-01: any XML file of row elements that do not nest; attributes become columns.

    Without a schema it is inferred by a pass of the built-in reader. The rows are then parsed
    element by element, split over tasks; broken elements are left out.
    """
    options = {"rowTag": row_tag, "attributePrefix": ATTRIBUTE, "ignoreSurroundingSpaces": "false"}
    reader = spark.read.format("xml").options(**options)
    fields = (reader.schema(schema) if schema else reader).load(path).schema
    closing = f"</{row_tag}>"
    inner = F.when(F.col("head").endswith("/>"), F.col("head")).when(
        F.col("piece").contains(closing), F.concat(F.substring_index("piece", closing, 1), F.lit(closing))
    )
    elements = _pieces(spark, path, row_tag).filter("head <> ''").select(F.concat(F.lit(f"<{row_tag}"), inner).alias("x"))
    parsed = elements.filter(F.col("x").isNotNull()).select(F.from_xml("x", fields, options | {"mode": "PERMISSIVE"}).alias("r"))
    return _without_prefix(parsed.select("r.*"))


def _typed(raw: Column, kind: str) -> Column:
    return F.try_to_timestamp(raw) if kind == "TIMESTAMP" else raw.try_cast(kind.lower())


def typed_rows(
    raw: DataFrame, table: str, keep_malformed: bool = False, names: Sequence[str] | None = None
) -> DataFrame:
    """Cast text columns to the table's types; unreadable values become null.

    ``keep_malformed`` adds ``Malformed``: the names of the columns that had
    a value which could not be read.
    """
    columns = [(name, kind) for name, kind in schemas.columns(table) if names is None or name in names]
    typed = [_typed(F.col(name), kind).alias(name) for name, kind in columns]
    if not keep_malformed:
        return raw.select(*typed)
    bad = [
        F.when(F.col(name).isNotNull() & _typed(F.col(name), kind).isNull(), name)
        for name, kind in columns
        if kind != "STRING"
    ]
    return raw.select(*typed, F.array_compact(F.array(*bad)).alias("Malformed"))


def read_table(
    spark: SparkSession,
    table: str,
    path: str,
    columns: Sequence[str] | None = None,
    row_tag: str = "row",
    keep_malformed: bool = False,
) -> DataFrame:
    """S-02: one dump table; only the named columns are parsed.

    Rows may stand on one line or span several. They are parsed by the built-in XML parser with every
    attribute as text, so a malformed number costs its value and not the row. A row that is not
    XML is left out; with ``keep_malformed`` it is a row of nulls whose ``Malformed`` holds its text.
    """
    wanted = [name for name, _ in schemas.columns(table) if columns is None or name in columns]
    fields = ", ".join(f"{ATTRIBUTE}{name} STRING" for name in wanted) + ", _broken_ STRING"
    options = {
        "rowTag": row_tag,
        "attributePrefix": ATTRIBUTE,
        "ignoreSurroundingSpaces": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_broken_",
    }
    attributes = F.regexp_replace("head", "/?>$", "")
    element = F.when(F.col("head") != "", F.concat(F.lit(f"<{row_tag}"), attributes, F.lit("/>")))
    # a plain column would be parsed again by the filter below, once per condition
    parsed = F.explode(F.array(F.from_xml(element, fields, options))).alias("r")
    read = _pieces(spark, path, row_tag).select("piece", "head", parsed)
    broken = F.col("r").isNull() | F.col("r._broken_").isNotNull()
    good = typed_rows(_without_prefix(read.filter(~broken).select("r.*")), table, keep_malformed, wanted)
    if not keep_malformed:
        return good
    text = F.array(F.concat(F.lit(f"<{row_tag}"), F.when(F.col("head") == "", F.rtrim("piece")).otherwise(F.col("head"))))
    lost = [F.lit(None).cast(kind.lower()).alias(name) for name, kind in schemas.columns(table) if name in wanted]
    return good.unionByName(read.filter(broken).select(*lost, text.alias("Malformed")))


def read_dump(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """S-03: every dump table present in the directory."""
    found = {}
    for table, file in schemas.FILES.items():
        path = f"{directory.rstrip('/')}/{file}"
        if path_exists(spark, path):
            found[table] = read_table(spark, table, path)
        else:
            log.warning("no file %s", path)
    return found


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """S-05: Parquet, optionally only some columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    schema: StructType | str | None = None,
    multi_line: bool = False,
    escaped_breaks: bool = False,
) -> DataFrame:
    """S-07: CSV; without a schema the types are inferred by a pass over the file.

    ``multi_line`` allows line breaks inside quotes, and then one task reads a file. ``escaped_breaks`` undoes
    what ``save_csv(escape_breaks=True)`` wrote; such files are split.
    """
    reader = spark.read.option("header", header).option("escape", '"').option("multiLine", multi_line)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if not escaped_breaks:
        return df
    return df.select(*[unescaped_breaks(f"`{c}`").alias(c) if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes])


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """S-09: JSON lines; without a schema the types are inferred by a pass over the file."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """S-16: one row per question from API pages with an ``items`` array."""
    item = pages.select(F.explode("items").alias("q")).select("q.*")

    def known(name: str, default: Column) -> Column:
        return F.coalesce(as_column(name), default)

    tags = known("tags", F.array().cast("array<string>"))
    zero = F.lit(0)
    return item.select(
        "question_id",
        known("title", F.lit("")).alias("title"),
        drop_html("body").alias("body"),
        tags.alias("tags"),
        pack_tags(tags).alias("tags_str"),
        known("score", zero).alias("score"),
        known("view_count", zero).alias("view_count"),
        known("answer_count", zero).alias("answer_count"),
        known("is_answered", F.lit(False)).cast("int").alias("is_answered"),
        F.to_date(F.timestamp_seconds(known("creation_date", zero))).alias("creation_date"),
        known("owner.reputation", zero).alias("owner_reputation"),
        known("owner.user_id", F.lit(0).cast("bigint")).alias("owner_user_id"),
    )


def read_api_pages(spark: SparkSession, path: str) -> DataFrame:
    """S-16: landed JSON pages, one page per line."""
    return flatten_pages(read_json(spark, path, schemas.API_PAGE))


def shape_questions(questions: DataFrame) -> DataFrame:
    """S-17: calendar parts, lengths, tag count and null fill."""
    shaped = questions.withColumn("creation_date", F.to_date("creation_date"))
    return shaped.withColumns(
        {
            "year": F.year("creation_date"),
            "month": F.month("creation_date"),
            "title_length": F.length("title"),
            "body_length": F.length("body"),
            "tag_count": F.size("tags"),
        }
    ).fillna(
        {"score": 0, "view_count": 0, "answer_count": 0, "owner_reputation": 0, "title": "", "body": ""}
    )

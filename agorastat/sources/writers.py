"""Sinks, samples and table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType

from agorastat.functions.text import as_column, escaped_breaks
from agorastat.sources.readers import read_parquet

SAMPLE_STEPS = 1_000_000


def save_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    compression: str = "snappy",
    replace_partitions: bool = False,
    seen: Observation | None = None,
) -> None:
    """S-04: Parquet, optionally in one folder per value.

    ``replace_partitions`` overwrites only the partitions that the frame holds. ``seen`` gets the
    number of rows as ``Rows``, counted by the tasks that write them.
    """
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("Rows"))
    writer = df.write.mode(mode).option("compression", compression)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", glue: str = "|", escape_breaks: bool = False
) -> None:
    """S-06: CSV; arrays are joined by ``glue``.

    ``escape_breaks`` writes line breaks and backslashes in texts as ``\\n``, ``\\r`` and ``\\s`` empty texts
    as ``\\e``, and keeps white space at their ends. Each row is then one line, so ``read_csv(escaped_breaks=True)`` reads one file by many tasks.
    """
    flat = []
    for f in df.schema.fields:
        column = F.concat_ws(glue, F.col(f.name).cast("array<string>")) if isinstance(f.dataType, ArrayType) else F.col(f.name)
        text = isinstance(f.dataType, (ArrayType, StringType))
        flat.append((escaped_breaks(column) if escape_breaks and text else column).alias(f.name))
    writer = df.select(*flat).write.mode(mode).option("header", header).option("escape", '"')
    if escape_breaks:
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def save_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S-08: JSON lines."""
    df.write.mode(mode).json(path)


def save_xml(df: DataFrame, path: str, root_tag: str = "rows", row_tag: str = "row", mode: str = "overwrite") -> None:
    """Rows as XML attributes, one element per line, the layout ``read_table`` reads."""
    attributes = df.select(*[F.col(c).cast("string").alias(f"_{c}") for c in df.columns])
    writer = attributes.write.format("xml").mode(mode)
    writer.option("rootTag", root_tag).option("rowTag", row_tag).save(path)


def cache_view(df: DataFrame, name: str) -> DataFrame:
    """S-10: cache the frame and register it as a view."""
    cached = df.cache()
    cached.createOrReplaceTempView(name)
    return cached


def repartition_and_save(
    df: DataFrame,
    path: str,
    num_partitions: int | None = None,
    partition_by: Sequence[str] | None = None,
    spread: int = 1,
    **options,
) -> None:
    """S-12: redistribute the rows, then save as Parquet.

    With ``partition_by`` the rows of one folder come together, so a folder gets few
    files. Without a number Spark sizes the tasks itself: small folders share one and a
    dominant folder is split. With a number, ``spread`` tasks write each folder.
    """
    keys = [as_column(c) for c in partition_by or ()]
    if num_partitions is None:
        save_parquet(df.hint("rebalance", *keys), path, partition_by, **options)
        return
    if keys and spread > 1:
        keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    save_parquet(df.repartition(num_partitions, *keys), path, partition_by, **options)


def sample(df: DataFrame, fraction: float = 0.1, seed: int = 42, key: str | None = None) -> DataFrame:
    """S-13: sample without replacement.

    With ``key`` a row is chosen by a hash of that column: the same rows
    come back whatever the partitioning, and split points can be shared (T-06).
    """
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    return df.filter(hash_share(key, seed) < fraction)


def hash_share(key: str, seed: int = 42):
    """A repeatable number in [0, 1) per key."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(SAMPLE_STEPS)) / SAMPLE_STEPS


def create_sample(
    spark: SparkSession, source: str, target: str, fraction: float = 0.01, seed: int = 42, key: str | None = None
) -> None:
    """S-14: a sampled copy of a Parquet dataset."""
    save_parquet(sample(read_parquet(spark, source), fraction, seed, key), target)


def profile(df: DataFrame) -> DataFrame:
    """S-11: one row with the size, the schema and the null count of each column."""
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("num_rows"), *nulls).select(
        "num_rows",
        F.lit(len(df.columns)).cast("bigint").alias("num_columns"),
        F.lit(", ".join(df.columns)).alias("columns"),
        F.lit(df.schema.simpleString()).alias("schema"),
        F.lit(df.rdd.getNumPartitions()).cast("bigint").alias("partitions"),
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
        ).alias("null_counts"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]

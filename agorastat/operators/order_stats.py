"""Ranks, quantiles, histograms and correlations without a single-task sort.

Ranks and quantiles need running counts in value order. They are built on one row
per distinct value, which removes copies of a value first, and the values are cut
into ranges that different tasks count, joined by the totals of the lower ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorastat.operators.joins import SLICE_ROWS, lookup_join, same
from agorastat.sources.storage import materialize


def running_counts(df: DataFrame, value: str, by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """One row per distinct value (of a group) with its place in ascending order.

    ``Rows``: rows with this value; ``Before``: rows with a smaller one;
    ``ValuesBefore``: distinct smaller values; ``TotalRows`` and ``TotalValues`` of the
    group. Null counts as the smallest value. ``ranges`` defaults to the number of
    shuffle partitions.
    """
    by = list(by)
    values = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("Rows"))
    order = [*by, value]
    ranged = values.repartitionByRange(ranges, *order) if ranges else values.repartitionByRange(*order)
    # Range borders come from a sample: keep the ranges of one evaluation.
    placed = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")

    inside = W.partitionBy(*by, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    local = placed.withColumns(
        {"_rows": F.sum("Rows").over(inside), "_values": F.count(F.lit(1)).over(inside)}
    )
    lower = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    group = W.partitionBy(*by)
    offsets = placed.groupBy(*by, "_range").agg(
        F.sum("Rows").alias("_n"), F.count(F.lit(1)).alias("_d")
    ).select(
        *[F.col(k).alias(f"_place{i}") for i, k in enumerate([*by, "_range"])],
        F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_rows_below"),
        F.coalesce(F.sum("_d").over(lower), F.lit(0)).alias("_values_below"),
        F.sum("_n").over(group).alias("TotalRows"),
        F.sum("_d").over(group).alias("TotalValues"),
    )
    if not by:
        offsets = F.broadcast(offsets)  # one row per range
    keys = [*by, "_range"]
    names = [f"_place{i}" for i in range(len(keys))]
    return local.join(offsets, same(keys, names)).select(
        *by,
        value,
        "Rows",
        (F.col("_rows_below") + F.col("_rows") - F.col("Rows")).alias("Before"),
        (F.col("_values_below") + F.col("_values") - 1).alias("ValuesBefore"),
        "TotalRows",
        "TotalValues",
    )


def global_ranks(
    df: DataFrame,
    ranks: Mapping[str, tuple[str, str]],
    salt_by: Sequence[str] | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """W-08: rank rows of the whole table; ``ranks`` maps a new column to (kind, column).

    Kinds: ``rank`` and ``dense_rank`` count from the largest value down,
    ``percent_rank`` from the smallest up.
    """
    base = materialize(df, "ranked")  # read by the counts of each column; columns do not nest
    df = base
    for column in dict.fromkeys(c for _, c in ranks.values()):
        places = running_counts(base.select(column), column)
        forms = {
            "rank": F.col("TotalRows") - F.col("Before") - F.col("Rows") + 1,
            "dense_rank": F.col("TotalValues") - F.col("ValuesBefore"),
            "percent_rank": F.coalesce(F.try_divide("Before", F.col("TotalRows") - 1), F.lit(0.0)),
        }
        wanted = [forms[kind].alias(name) for name, (kind, c) in ranks.items() if c == column]
        df = lookup_join(df, places.select(column, *wanted), [column], salt_by=salt_by, slice_rows=slice_rows, count_in=base.select(column))
    return df


def box_statistics(df: DataFrame, category: str, value: str) -> DataFrame:
    """A-27: exact quartiles, whiskers and outlier count per category.

    Quartiles interpolate between neighbours; whiskers end at the last value
    within 1.5 quartile distances.
    """
    places = materialize(running_counts(df.select(category, value).dropna(), value, [category]), "places")

    def at(position):
        here = (F.col("Before") <= position) & (position < F.col("Before") + F.col("Rows"))
        return F.max(F.when(here, F.col(value)))

    def quantile(q: float):
        spot = (F.col("TotalRows") - 1) * F.lit(q)
        low, high = at(F.floor(spot)), at(F.ceil(spot))
        return low + (high - low) * F.max(spot - F.floor(spot))

    quartiles = places.groupBy(category).agg(
        F.max("TotalRows").alias("Count"),
        F.min(value).alias("Min"),
        quantile(0.25).alias("Q1"),
        quantile(0.5).alias("Median"),
        quantile(0.75).alias("Q3"),
        F.max(value).alias("Max"),
    )
    reach = (F.col("Q3") - F.col("Q1")) * 1.5
    fenced = lookup_join(places, quartiles, [category])
    inside = F.col(value).between(F.col("Q1") - reach, F.col("Q3") + reach)
    return fenced.groupBy(category).agg(
        *[F.any_value(c).alias(c) for c in ("Count", "Min", "Q1", "Median", "Q3", "Max")],
        F.min(F.when(inside, F.col(value))).alias("LowWhisker"),
        F.max(F.when(inside, F.col(value))).alias("HighWhisker"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("Rows"))).alias("Outliers"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """A-26: equal-width bins between the least and the greatest value, empty ones included."""
    values = df.select(F.col(column).cast("double").alias("v")).dropna()
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    ended = values.withColumn("ends", ends)
    low, high = F.col("ends.low"), F.col("ends.high")
    width = (high - low) / bins
    bin_no = F.least(F.coalesce(F.floor(F.try_divide(F.col("v") - low, width)), F.lit(0)), F.lit(bins - 1))
    counted = ended.groupBy(bin_no.alias("Bin")).agg(F.count(F.lit(1)).alias("Count"))
    frame = df.sparkSession.range(bins).withColumnRenamed("id", "Bin").withColumn("ends", ends)
    return frame.join(F.broadcast(counted), "Bin", "left").select(
        "Bin",
        (low + width * F.col("Bin")).alias("From"),
        (low + width * (F.col("Bin") + 1)).alias("To"),
        F.coalesce("Count", F.lit(0)).alias("Count"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A-28: Pearson correlation of each pair of columns (lower triangle), in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    cells = [F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    entries = [
        F.struct(F.lit(a).alias("ColumnA"), F.lit(b).alias("ColumnB"), F.col(f"c{i}").alias("Correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return df.agg(*cells).select(F.explode(F.array(*entries)).alias("r")).select("r.*")

"""Equi-joins that stay balanced when one key holds much of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorastat.sources.storage import materialize

SLICE_ROWS = 200_000  # rows of one key that one task takes


def hot_keys(df: DataFrame, on: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Every key with more than ``slice_rows`` rows, and into how many slices of about that size it goes."""
    sizes = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.filter(F.col("_n") > slice_rows).select(*on, F.ceil(F.col("_n") / slice_rows).alias("_slices"))


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of two lists of columns, where null equals null."""
    return reduce(Column.__and__, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_by: Sequence[str] | None = None,
    slice_rows: int = SLICE_ROWS,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a table with one row per key.

    Rows of a key with more than ``slice_rows`` rows are spread over slices by a hash of ``salt_by`` (default:
    all columns), and only the look-up rows of these keys are repeated. The salt is
    a hash, so a recomputed task yields the same rows. ``count_in`` is a cheaper frame
    with the same keys to count. The list of such keys is written first, so Spark broadcasts
    it only where its size allows.
    """
    on = list(on)
    hot_names = [f"_hot{i}" for i in range(len(on))]
    lookup_names = [f"_key{i}" for i in range(len(on))]
    counted = rows if count_in is None else count_in
    hot = materialize(hot_keys(counted, on, slice_rows).toDF(*hot_names, "_slices"), "hot-keys")
    if hot.isEmpty():
        named = lookup.withColumnsRenamed(dict(zip(on, lookup_names)))
        joined = rows.join(named, same(on, lookup_names), how)
        return joined.select(*rows.columns, *[c for c in lookup.columns if c not in on])

    salt = F.pmod(F.xxhash64(*(salt_by or rows.columns)), F.col("_slices"))
    marked = rows.join(hot, same(on, hot_names), "left").select(
        *rows.columns, F.coalesce(salt, F.lit(0)).alias("_slice")
    )
    named = lookup.withColumnsRenamed(dict(zip(on, lookup_names)))
    last = (F.coalesce("_slices", F.lit(1)) - 1).cast("bigint")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    spread = named.join(hot, same(lookup_names, hot_names), "left").select(
        *named.columns, copies.alias("_of_slice")
    )
    joined = marked.join(spread, same([*on, "_slice"], [*lookup_names, "_of_slice"]), how)
    return joined.select(*rows.columns, *[c for c in lookup.columns if c not in on])

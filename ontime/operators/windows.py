"""Previous leg of the same vehicle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_leg_flag(
    df: DataFrame,
    key: str = "tail_num",
    order: str = "crs_dep_timestamp",
    tie: Sequence[str] = ("flight_id",),
    flag: str = "arr_del15",
    output: str = "pr_arr_del15",
    null_keys: str = "group",
    slice_by: str | None = "day",
) -> DataFrame:
    """Flag of the row before this one with the same key, ordered by ``order`` and the tie columns.

    ``tie`` makes the order total, which makes the result repeatable. Rows with a NULL key form one group
    (``null_keys='group'``) or get NULL (``'null'``).

    One key may hold a large share of all rows, so the window does not run over whole keys but over (key, time slice):
    the flag that closes each slice is aggregated first (at most one row per key and slice) and put in front of the
    key's next slice. The result is the same as that of one window per key, which ``slice_by=None`` uses.
    """
    if null_keys not in ("group", "null"):
        raise ValueError(f"null_keys {null_keys!r} is neither 'group' nor 'null'")
    total_order = [order, *tie]
    unknown, keys, rows = F.col(key).isNull(), [key], df
    if null_keys == "null":  # their result is blanked below, so they are spread over many small groups
        keys, rows = [key, "_lone"], df.withColumn("_lone", F.when(unknown, F.xxhash64(*tie)))

    def blanked(value: Column) -> Column:
        return F.when(~unknown, value) if null_keys == "null" else value

    if slice_by is None:
        plain = F.lag(flag).over(Window.partitionBy(*keys).orderBy(*total_order))
        return rows.withColumn(output, blanked(plain)).select(*[c for c in df.columns if c != output], output)

    # rows without a key are the largest group by far: their slices are minutes
    sliced = rows.withColumn("_slice", F.when(unknown, F.date_trunc("minute", order)).otherwise(F.date_trunc(slice_by, order)))
    closed = sliced.where(~unknown) if null_keys == "null" else sliced
    closing = closed.groupBy(key, "_slice").agg(F.max_by(flag, F.struct(*total_order)).alias("_closing"))
    opening = closing.select(
        key,
        "_slice",
        F.lag("_closing").over(Window.partitionBy(key).orderBy("_slice")).alias(flag),
        F.lit(0).alias("_rank"),
    )
    rows = sliced.withColumn("_rank", F.lit(1)).unionByName(opening, allowMissingColumns=True)
    within = Window.partitionBy(*keys, "_slice").orderBy("_rank", *total_order)
    return (
        rows.withColumn(output, blanked(F.lag(flag).over(within)))
        .where(F.col("_rank") == 1)
        .select(*[c for c in df.columns if c != output], output)
    )

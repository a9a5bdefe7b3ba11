"""Drift without bins: shares of single values, and the exact Kolmogorov-Smirnov distance of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.functions.columns import null_nan
from ontime.operators.quality import kind_of
from ontime.sources.sinks import stage_table


def _counted(serve: DataFrame, train: DataFrame, columns: Sequence[str], as_cell) -> DataFrame:
    """(c, v, n_serve, n_train): how often every known value of every column occurs on both sides, combined per task."""
    def cells(side: DataFrame, serving: int) -> DataFrame:
        wide = side.select(*[as_cell(F.col(c)).alias(str(i)) for i, c in enumerate(columns)])
        long = wide.unpivot([], [str(i) for i in range(len(columns))], "c", "v")
        return long.select(F.col("c").cast("int").alias("c"), "v", F.lit(serving).alias("_serving"))

    both = cells(serve, 1).unionByName(cells(train, 0)).where(F.col("v").isNotNull())
    sums = (F.sum("_serving").alias("n_serve"), F.sum(1 - F.col("_serving")).alias("n_train"))
    return both.groupBy("c", "v").agg(*sums)


def _with_shares(counts: DataFrame) -> DataFrame:
    """p and q: the shares of each value among its column's values. Totals are one row per column, held in a map."""
    totals = counts.groupBy("c").agg(F.struct(F.sum("n_serve").alias("s"), F.sum("n_train").alias("t")).alias("n"))
    every = totals.agg(F.map_from_entries(F.collect_list(F.struct("c", "n"))).alias("every")).scalar()
    own = F.col("_every")[F.col("c")]
    shared = counts.withColumn("_every", every).withColumns(
        {"p": F.try_divide("n_serve", own.s), "q": F.try_divide("n_train", own.t)}
    )
    return shared.drop("_every")


def _column_name(columns: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in columns])[F.col("c")].alias("column_name")


def value_drift(serve: DataFrame, train: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distance of two samples over their single values, for strings and for codes that only look like numbers.

    One row per column: ``n_values`` (distinct values on both sides), ``n_new`` (values that only the served side has),
    ``l_infinity`` (largest gap between the shares of one value), ``worst_value`` (the value with that gap, the smaller on
    a tie) and ``js`` (Jensen-Shannon divergence in bits). By default all common string columns. Missing values do not
    count; the distances are null if one side has no known value. Nothing is gathered per column but its sums.
    """
    both = [c for c in train.columns if c in serve.columns]
    names = list(columns or [c for c in both if kind_of(train.schema[c].dataType) == "string"])
    if not names:
        raise ValueError("no common columns of values")
    counts = stage_table(_counted(serve, train, names, lambda c: c.cast("string")))
    gap = F.abs(F.col("p") - F.col("q"))

    def half_kl(share: str) -> Column:
        middle = (F.col("p") + F.col("q")) / 2
        return F.when(F.col(share) > 0, F.col(share) * F.log2(F.col(share) / middle) / 2).otherwise(F.lit(0.0))

    known = F.max(gap).isNotNull()
    by_column = _with_shares(counts).withColumn("_gap", F.round(gap, 12)).groupBy("c").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count(F.when(F.col("n_train") == 0, 1)).alias("n_new"),
        F.max(gap).alias("l_infinity"),
        F.min_by("v", F.struct((-F.col("_gap")).alias("g"), "v")).alias("_worst"),
        F.when(known, F.sum(half_kl("p") + half_kl("q"))).alias("js"),
    )
    worst = F.when(F.col("l_infinity").isNotNull(), F.col("_worst")).alias("worst_value")
    return by_column.select(_column_name(names), "n_values", "n_new", "l_infinity", worst, "js")


def exact_ks(serve: DataFrame, train: DataFrame, columns: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """The largest gap between the cumulative shares of two samples, per numeric column, over their values as they are.

    Value counts are dealt by ranges of (column, value); each range adds up its own counts and starts from the sums of the
    ranges before it, so that no column is gathered in one task. Null and NaN do not count; null if a side has no number.
    """
    both = [c for c in train.columns if c in serve.columns]
    names = list(columns or [c for c in both if kind_of(train.schema[c].dataType) in ("int", "float")])
    if not names:
        raise ValueError("no common numeric columns")
    counts = _counted(serve, train, names, lambda c: null_nan(c.cast("double")))
    n = partitions or int(serve.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage_table(counts.repartitionByRange(n, "c", "v").withColumn("_range", F.spark_partition_id()))
    # one row per range and column in it: at most the ranges plus the columns
    before = Window.partitionBy("c").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range", "c").agg(F.sum("n_serve").alias("_s"), F.sum("n_train").alias("_t"))
    starts = sums.select(
        "_range", "c", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in ("_s", "_t")],
        *[F.sum(x).over(Window.partitionBy("c")).alias(f"{x}n") for x in ("_s", "_t")],
    )
    inside = Window.partitionBy("_range", "c").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.select(
        "_range", "c", F.sum("n_serve").over(inside).alias("_rs"), F.sum("n_train").over(inside).alias("_rt")
    )
    placed = running.join(stage_table(starts), ["_range", "c"])
    gap = F.abs(F.try_divide(F.col("_rs") + F.col("_s0"), "_sn") - F.try_divide(F.col("_rt") + F.col("_t0"), "_tn"))
    return placed.groupBy("c").agg(F.max(gap).alias("ks")).select(_column_name(names), "ks")

"""Column profiles, rules inferred from them, validation, comparison and drift.

Everything runs over whole tables as aggregations; the results have one row per column, rule, bin or anomaly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import cycle

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, FractionalType, IntegralType, StringType, TimestampNTZType, TimestampType,
)

from ontime.functions.columns import null_nan
from ontime.sources.sinks import stage_table

# Bins per round of the exact median; relative rank error of the sketched one is 1 / SKETCH_ACCURACY.
MEDIAN_BINS = 1024
SKETCH_ACCURACY = 10_000
CALENDAR_COLUMNS = ("year", "quarter", "month", "day_of_month", "day_of_week", "fl_date")
LABEL_COLUMNS = ("arr_delay", "dep_delay")


def kind_of(dtype: DataType) -> str:
    if isinstance(dtype, IntegralType):
        return "int"
    if isinstance(dtype, FractionalType):
        return "float"
    if isinstance(dtype, StringType):
        return "string"
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return "time"
    if isinstance(dtype, BooleanType):
        return "bool"
    return dtype.typeName()


def _numbers(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if kind_of(df.schema[c].dataType) in ("int", "float")]


PROFILE_FIELDS = (
    "n_rows", "n_missing", "mean", "stddev", "n_zeros", "min_value", "median", "max_value", "n_distinct", "avg_length",
)


def _cells(columns: dict[str, Column], df: DataFrame) -> DataFrame:
    """One row per table cell: position of the column and its value as a double.

    Grouping cells by their column keeps the generated code small however many columns there are; hundreds of
    aggregates side by side would exceed what the JVM compiles.
    """
    places = [F.col(c) if isinstance(c, str) else c for c in columns.values()]
    wide = df.select(*[place.alias(str(i)) for i, place in enumerate(places)])
    names = [str(i) for i in range(len(places))]
    return wide.unpivot([], names, "c", "v").select(F.col("c").cast("int").alias("c"), "v")


def _known_numbers(columns: Sequence[str]) -> dict[str, Column]:
    return {c: null_nan(F.col(c).cast("double")) for c in columns}


def _name(columns: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in columns])[F.col("c")]


def exact_medians(df: DataFrame, columns: Sequence[str], bins: int = MEDIAN_BINS) -> dict[str, float]:
    """Lower middle value of every numeric column that has one.

    Each round counts the values per bin of the range that still holds a column's median and narrows the range to the
    smallest and largest value of the right bin. Both ends have bins of their own, so that every round gets nearer
    whatever the values are; even rounds have equally wide bins, odd ones bins by magnitude, which settles values that
    differ by many powers of ten. Tasks keep at most ``bins`` counters per column, no values are gathered, and one row per
    column comes back; a quantile sketch would instead send the sketches of all tasks to a single one.
    """
    if not columns:
        return {}
    cells = _cells(_known_numbers(columns), df).where(F.col("v").isNotNull())
    extent = cells.groupBy("c").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranges = {r["c"]: (r["lo"], r["hi"], (r["n"] + 1) // 2) for r in extent.collect()}  # one row per column
    medians: dict[str, float] = {}
    for scale in cycle((_as_is, _magnitude)):
        medians |= {columns[c]: lo for c, (lo, hi, _rank) in ranges.items() if lo == hi}
        ranges = {c: r for c, r in ranges.items() if columns[c] not in medians}
        if not ranges:
            return medians
        ranges = _narrowed(cells, ranges, len(columns), bins, scale)


def _as_is(value: Column) -> Column:
    return value


def _magnitude(value: Column) -> Column:
    """Signed logarithm that never decreases with the value: above zero for all positive doubles, zero at zero."""
    above_smallest = F.log2(F.abs(value)) + 1080
    return F.when(value == 0, 0.0).otherwise(F.signum(value) * above_smallest)


def _narrowed(
    cells: DataFrame, ranges: dict[int, tuple[float, float, int]], n_columns: int, bins: int,
    scale: Callable[[Column], Column],
) -> dict[int, tuple[float, float, int]]:
    def of_column(part: int, absent: float | int) -> Column:
        return F.array(*[F.lit(ranges[c][part] if c in ranges else absent) for c in range(n_columns)])[F.col("c")]

    nothing = (float("inf"), float("-inf"))
    inside = cells.select("c", "v", of_column(0, nothing[0]).alias("lo"), of_column(1, nothing[1]).alias("hi")).where(
        F.col("v").between(F.col("lo"), F.col("hi"))
    )
    value, lo, hi = (scale(F.col(x)) for x in ("v", "lo", "hi"))
    share = F.coalesce(F.try_divide(value - lo, hi - lo), F.lit(0.0))
    inner = F.when(F.isnan(share), 0).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)))
    place = F.when(F.col("v") == F.col("lo"), -1).when(F.col("v") == F.col("hi"), bins).otherwise(inner).cast("int")
    counts = (
        inside.groupBy("c", place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    upto = Window.partitionBy("c").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .withColumn("rank", of_column(2, 0))
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        .select("c", "lo", "hi", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))
    )
    return {r["c"]: (r["lo"], r["hi"], r["rank"]) for r in found.collect()}  # one row per column


def column_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    median: str | None = "exact",
    exact_distinct: bool = True,
) -> DataFrame:
    """Statistics per column, one row each.

    Numbers: mean, population standard deviation, zeros, minimum, median (lower middle value), maximum. Strings:
    distinct values, average length. NaN counts as missing. ``median`` is ``exact`` (some extra scans of the numeric
    columns, see ``exact_medians``), ``sketch`` or ``None`` (left out). Distinct values are counted exactly from
    (column, value) pairs or estimated.
    """
    if median not in ("exact", "sketch", None):
        raise ValueError(f"median {median!r} is neither 'exact', 'sketch' nor None")
    names = list(columns or df.columns)
    kinds = [kind_of(df.schema[n].dataType) for n in names]
    values = {}
    for name, kind in zip(names, kinds, strict=True):
        if kind in ("int", "float"):
            values[name] = null_nan(F.col(name).cast("double"))
        elif kind == "string":
            values[name] = F.length(name).cast("double")
        else:
            values[name] = F.when(F.col(name).isNotNull(), 0.0)

    aggregates = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("v").alias("n_known"),
        F.avg("v").alias("avg"),
        F.stddev_pop("v").alias("std"),
        F.count(F.when(F.col("v") == 0, 1)).alias("zeros"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    ]
    if median == "sketch":
        aggregates.append(F.percentile_approx("v", 0.5, SKETCH_ACCURACY).alias("mid"))
    counted = _cells(values, df).groupBy("c").agg(*aggregates)
    # an empty table has no cells: every column still gets its row
    listed = df.sparkSession.createDataFrame(
        [(i, n, k) for i, (n, k) in enumerate(zip(names, kinds, strict=True))], "c int, column_name string, kind string"
    )
    joined = listed.join(counted, "c", "left")
    if exact_distinct:
        pairs = _string_values(df, names).groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct"))
    else:
        strings = [n for n, k in zip(names, kinds, strict=True) if k == "string"]
        pairs = _string_cells(df, strings).groupBy("column_name").agg(F.approx_count_distinct("value").alias("distinct"))
    joined = joined.join(pairs, "column_name", "left")

    number, text = F.col("kind").isin("int", "float"), F.col("kind") == "string"
    if median == "sketch":
        middle = F.when(number, F.col("mid"))
    else:
        medians = exact_medians(df, _numbers(df, names)) if median == "exact" else {}
        middle = F.array(*[F.lit(medians.get(n)).cast("double") for n in names])[F.col("c")]
    rows, known = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_known", F.lit(0))
    return joined.select(
        "column_name",
        "kind",
        rows.alias("n_rows"),
        (rows - known).alias("n_missing"),
        F.when(number, F.col("avg")).alias("mean"),
        F.when(number, F.col("std")).alias("stddev"),
        F.when(number, F.coalesce("zeros", F.lit(0))).alias("n_zeros"),
        F.when(number, F.col("lo")).alias("min_value"),
        middle.alias("median"),
        F.when(number, F.col("hi")).alias("max_value"),
        F.when(text, F.coalesce("distinct", F.lit(0))).alias("n_distinct"),
        F.when(text, F.col("avg")).alias("avg_length"),
    )


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 0 .. bins-1; the maximum belongs to the last bin, a constant column to the first."""
    place = F.floor(F.try_divide((value - lo) * bins, hi - lo)).cast("int")
    return F.when(value.isNotNull(), F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)))


def value_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram between minimum and maximum; empty bins are not listed."""
    known = df.select(null_nan(F.col(column).cast("double")).alias("v")).where(F.col("v").isNotNull())
    bounds = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("bounds"))
    lo, hi = F.col("b.lo"), F.col("b.hi")
    binned = known.withColumn("b", bounds.scalar()).select(
        _bin(F.col("v"), lo, hi, bins).alias("bin"), lo.alias("_lo"), ((hi - lo) / bins).alias("_width")
    )
    return (
        binned.groupBy("bin", "_lo", "_width")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            "bin",
            (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
            "n_rows",
        )
    )


def top_values(df: DataFrame, column: str, k: int, buckets: int | None = None) -> DataFrame:
    """The ``k`` most frequent known values, the smaller value first on a tie.

    With ``buckets`` (a column of very many values) only candidates are counted one by one. No value is more frequent
    than its hash bucket, so the rows per bucket are counted first; the fullest buckets' values give a frequency that the
    result reaches at least; only buckets as full as that are counted by value. The result is the same for any data: where
    no bucket can be left out, all values are counted.
    """
    known = df.select(F.col(column)).where(F.col(column).isNotNull())
    if buckets is not None:
        known = _frequent_buckets(known, column, k, buckets)
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.col("n_rows").desc(), column).limit(k)


def _frequent_buckets(known: DataFrame, column: str, k: int, buckets: int) -> DataFrame:
    """Rows whose hash bucket may hold one of the ``k`` most frequent values."""
    bucket = F.pmod(F.xxhash64(column), F.lit(buckets))
    full = stage_table(known.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows")))  # at most ``buckets`` rows
    first = full.orderBy(F.col("_rows").desc(), "_bucket").limit(4 * k)
    counts = known.join(first, bucket == first["_bucket"], "left_semi").groupBy(column).count()
    best = counts.orderBy(F.col("count").desc()).limit(k)
    least = best.agg(F.when(F.count(F.lit(1)) == k, F.min("count")).otherwise(1).alias("least")).scalar()
    possible = full.where(F.col("_rows") >= least)
    return known.join(possible, bucket == possible["_bucket"], "left_semi")


def infer_expectations(profile: DataFrame, open_columns: Sequence[str] = ()) -> DataFrame:
    """Rules a table like the profiled one has to meet: kind, whether values are required, closed value domain.

    Every string column has a domain, however many values it has, except the free text named in ``open_columns``.
    """
    free = F.lower("column_name").isin(*[c.lower() for c in open_columns])
    complete = F.col("n_missing") == 0
    return profile.select(
        "column_name",
        "kind",
        complete.alias("required"),
        F.when(complete, 1.0).otherwise(0.0).alias("min_presence"),
        ((F.col("kind") == "string") & ~free).alias("has_domain"),
    )


def _string_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values of the given string columns in long form."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, value string")
    return df.select(*columns).unpivot([], list(columns), "column_name", "value").where(F.col("value").isNotNull())


def _string_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Known values of the string columns with their frequency."""
    names = [c for c in columns or df.columns if kind_of(df.schema[c].dataType) == "string"]
    return _string_cells(df, names).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def infer_domains(df: DataFrame, rules: DataFrame) -> DataFrame:
    """The values of every column whose rule closes its domain."""
    closed = rules.where("has_domain").select("column_name")
    return _string_values(df).join(closed, "column_name", "left_semi").select("column_name", "value")


def unseen_values(df: DataFrame, domains: DataFrame) -> DataFrame:
    """Values outside their column's domain, with their frequency."""
    covered = domains.select("column_name").distinct()
    values = _string_values(df).join(covered, "column_name", "left_semi")
    return values.join(domains, ["column_name", "value"], "left_anti")


def environment_rules(rules: DataFrame, exclude: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Rules for an environment in which some columns, such as labels when serving, need not be there."""
    absent = F.lower("column_name").isin(*[c.lower() for c in exclude])
    return rules.select(
        "column_name",
        "kind",
        (F.col("required") & ~absent).alias("required"),
        F.when(absent, 0.0).otherwise(F.col("min_presence")).alias("min_presence"),
        "has_domain",
    )


def validate_profile(profile: DataFrame, rules: DataFrame, unseen: DataFrame | None = None) -> DataFrame:
    """Anomalies of a profiled table: ``new_column``, ``missing_column``, ``type_change``, ``low_presence`` and, when
    the unseen values are given, ``unseen_category``. One row per column and anomaly, with what was seen and expected.
    """
    seen = profile.select(
        "column_name",
        F.col("kind").alias("seen_kind"),
        F.try_divide(F.col("n_rows") - F.col("n_missing"), F.col("n_rows")).alias("presence"),
    )
    expected = rules.select("column_name", F.col("kind").alias("rule_kind"), "required", "min_presence")
    pairs = seen.join(expected, "column_name", "full_outer")
    if unseen is None:
        pairs = pairs.withColumn("n_unseen", F.lit(None).cast("long"))
    else:
        counts = unseen.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unseen"))
        pairs = pairs.join(counts, "column_name", "left")

    is_new, is_gone = F.col("rule_kind").isNull(), F.col("seen_kind").isNull()
    checks = [
        ("new_column", is_new, F.col("seen_kind"), None),
        ("missing_column", is_gone & F.col("required"), None, F.col("rule_kind")),
        ("type_change", F.col("seen_kind") != F.col("rule_kind"), F.col("seen_kind"), F.col("rule_kind")),
        ("low_presence", ~is_new & (F.col("presence") < F.col("min_presence")), F.round("presence", 6),
         F.round("min_presence", 6)),
        ("unseen_category", F.col("n_unseen") > 0, F.col("n_unseen"), F.lit(0)),
    ]

    def text(value: Column | None) -> Column:
        return F.lit(None).cast("string") if value is None else value.cast("string")

    found = [
        F.when(
            condition,
            F.struct(F.lit(name).alias("anomaly"), text(got).alias("observed"), text(rule).alias("expected")),
        )
        for name, condition, got, rule in checks
    ]
    return pairs.select("column_name", F.explode(F.array_compact(F.array(*found))).alias("a")).select(
        "column_name", "a.anomaly", "a.observed", "a.expected"
    )


def compare_profiles(serve: DataFrame, train: DataFrame) -> DataFrame:
    """Serving and training statistics side by side, with the differences of mean, median and missing share."""
    fields = ("kind", *PROFILE_FIELDS)

    def side(profile: DataFrame, prefix: str) -> DataFrame:
        return profile.select("column_name", *[F.col(f).alias(prefix + f) for f in fields])

    def missing(prefix: str) -> Column:
        return F.try_divide(F.col(f"{prefix}n_missing"), F.col(f"{prefix}n_rows"))

    return (
        side(serve, "serve_")
        .join(side(train, "train_"), "column_name", "full_outer")
        .withColumn("mean_change", F.col("serve_mean") - F.col("train_mean"))
        .withColumn("median_change", F.col("serve_median") - F.col("train_median"))
        .withColumn("missing_change", missing("serve_") - missing("train_"))
    )


def drift_distance(serve: DataFrame, train: DataFrame, columns: Sequence[str] | None = None, bins: int = 20) -> DataFrame:
    """Distance of two samples per numeric column over common equal-width bins.

    ``ks`` is the largest gap of the cumulative shares, ``l_infinity`` that of the shares, ``js`` the Jensen-Shannon
    divergence in bits (0 to 1). The table is binned in one pass; only (column, bin) counts are shuffled.
    """
    names = list(columns or [c for c in _numbers(train, train.columns) if c in serve.columns])
    if not names:
        raise ValueError("no common numeric columns")

    numbers = _known_numbers(names)
    cells = (
        _cells(numbers, serve).withColumn("serving", F.lit(1))
        .unionByName(_cells(numbers, train).withColumn("serving", F.lit(0)))
        .where(F.col("v").isNotNull())
    )
    extent = cells.groupBy("c").agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("range"))
    ranges = extent.agg(F.map_from_entries(F.collect_list(F.struct("c", "range"))).alias("ranges"))  # a row per column
    own = F.col("ranges")[F.col("c")]
    counts = (
        cells.withColumn("ranges", ranges.scalar())
        .groupBy("c", _bin(F.col("v"), own.lo, own.hi, bins).alias("bin"))
        .agg(F.sum("serving").alias("n_serve"), F.sum(1 - F.col("serving")).alias("n_train"))
        .select(_name(names).alias("column_name"), "bin", "n_serve", "n_train")
    )
    # from here on: at most `bins` rows per column
    whole = Window.partitionBy("column_name")
    running = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = counts.select(
        "column_name",
        "bin",
        F.try_divide(F.col("n_serve"), F.sum("n_serve").over(whole)).alias("p"),
        F.try_divide(F.col("n_train"), F.sum("n_train").over(whole)).alias("q"),
    ).withColumn("gap", F.abs(F.sum("p").over(running) - F.sum("q").over(running)))

    def half_kl(share: str) -> Column:
        middle = (F.col("p") + F.col("q")) / 2
        return F.when(F.col(share) > 0, F.col(share) * F.log2(F.col(share) / middle) / 2).otherwise(F.lit(0.0))

    return shares.groupBy("column_name").agg(
        F.max("gap").alias("ks"),
        F.max(F.abs(F.col("p") - F.col("q"))).alias("l_infinity"),
        F.sum(half_kl("p") + half_kl("q")).alias("js"),
    )


def retrain_signal(
    drift: DataFrame,
    threshold: float,
    exclude: Sequence[str] = (*CALENDAR_COLUMNS, *LABEL_COLUMNS),
    metric: str = "ks",
) -> DataFrame:
    """One row: whether any column that may not drift does, how many do, and the one that drifts most."""
    watched = drift.where(~F.lower("column_name").isin(*[c.lower() for c in exclude]))
    over = F.col(metric) > threshold
    return watched.agg(
        F.coalesce(F.bool_or(over), F.lit(False)).alias("retrain"),
        F.count(F.when(over, 1)).alias("n_drifted"),
        F.max_by("column_name", F.struct(metric, "column_name")).alias("worst_column"),
    )


def reconcile_counts(expected: DataFrame, actual: DataFrame, date_column: str = "fl_date") -> DataFrame:
    """Row counts and latest dates of two tables, and whether they agree."""
    def summary(df: DataFrame) -> DataFrame:
        return df.agg(
            F.struct(F.count(F.lit(1)).alias("n_rows"), F.max(date_column).alias("max_date")).alias("summary")
        )

    pair = summary(expected).withColumn("other", summary(actual).scalar())
    left, right = F.col("summary"), F.col("other")
    return pair.select(
        left.n_rows.alias("expected_rows"),
        right.n_rows.alias("actual_rows"),
        left.max_date.alias("expected_max_date"),
        right.max_date.alias("actual_max_date"),
        ((left.n_rows == right.n_rows) & left.max_date.eqNullSafe(right.max_date)).alias("agree"),
    )

"""Grouped aggregates. All of them combine partially before the shuffle, so a hot group costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement
from math import sqrt

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ontime.functions.columns import delay_level, hour_of, null_nan, route, station_code
from ontime.functions.packed import decode_packed
from ontime.operators.filters import filter_edges, filter_report
from ontime.sources.sinks import stage_table

FIRST_PAGES = 10_000

ENDS = {"origin": "src", "dest": "dst"}


def hourly_weather(
    df: DataFrame, per_station: bool = True, missing_codes=None, only_airports: bool = True
) -> DataFrame:
    """Hourly measures from raw weather rows: one row per hour and station code, or per hour over all stations."""
    source = filter_report(df) if only_airports else df
    decoded = decode_packed(source, missing_codes=missing_codes).withColumn("time", hour_of("date"))
    keys = ["time"]
    if per_station:
        decoded = decoded.withColumn("code", station_code("call_sign"))
        keys.append("code")
    return decoded.groupBy(*keys).agg(
        F.avg("temp_f").alias("avg_temp_f"),
        F.sum("precip_mm").alias("tot_precip_mm"),
        F.avg("wnd_mps").alias("avg_wnd_mps"),
        F.avg("vis_m").alias("avg_vis_m"),
        F.avg("slp_hpa").alias("avg_slp_hpa"),
        F.avg("dew_pt_f").alias("avg_dewpt_f"),
    )


def _edges(df: DataFrame, delay: str, **extra: str) -> DataFrame:
    columns = {"src": "origin", "dst": "dest", "delay": delay, **extra}
    return df.select(*[F.col(c).alias(name) for name, c in columns.items()])


def avg_delay_by_state(df: DataFrame, code: str, delay: str = "dep_delay") -> DataFrame:
    """Mean positive delay per destination state of the trips that start at ``code``, largest first."""
    edges = filter_edges(_edges(df, delay, state="dest_state_abr"), "src", code)
    return order_desc(edges.groupBy("state").agg(F.avg("delay").alias("avg_delay")), "avg_delay", ("state",))


def delays_by_operator(df: DataFrame, code: str, end: str = "origin", delay: str = "dep_delay") -> DataFrame:
    """Number of delayed trips per carrier that start (or end) at ``code``, largest first."""
    edges = filter_edges(_edges(df, delay, operator="op_carrier"), ENDS[end], code)
    return order_desc(edges.groupBy("operator").agg(F.count("delay").alias("n_delayed")), "n_delayed", ("operator",))


def delays_by_weekday_route(
    df: DataFrame, code: str, end: str = "origin", delay: str = "dep_delay", flag: str | None = None
) -> DataFrame:
    """Number of known delay flags per weekday and route among the delayed trips that start (or end) at ``code``."""
    flag = flag or {"origin": "dep_del15", "dest": "arr_del15"}[end]
    with_path = df.withColumn("_path", route("origin", "dest"))
    edges = filter_edges(_edges(with_path, delay, weekday="day_of_week", path="_path", flag=flag), ENDS[end], code)
    counts = edges.groupBy("weekday", "path").agg(F.count("flag").alias("n_flagged"))
    return order_desc(counts, "n_flagged", ("weekday", "path"))


def delays_by_weekday_origin(df: DataFrame, code: str, delay: str = "dep_delay") -> DataFrame:
    """Number of delayed trips per weekday and origin that end at ``code``."""
    edges = filter_edges(_edges(df, delay, weekday="day_of_week"), "dst", code)
    counts = edges.groupBy("weekday", "src").agg(F.count("delay").alias("n_delayed"))
    return order_desc(counts, "n_delayed", ("weekday", "src"))


def group_stats(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """Minimum, maximum, count and mean of the known values per group."""
    names = [keys] if isinstance(keys, str) else list(keys)
    x = null_nan(F.col(value).cast("double"))
    return df.groupBy(*names).agg(
        F.min(x).alias("min_value"),
        F.max(x).alias("max_value"),
        F.count(x).alias("n_values"),
        F.avg(x).alias("mean_value"),
    )


def mean_delay_pivot(
    df: DataFrame,
    carriers: Sequence[str],
    delay: str = "dep_delay_new",
    origin: str = "origin",
    carrier: str = "op_carrier",
    other: str | None = "other",
) -> DataFrame:
    """Origin by carrier matrix of the mean delay; the carrier list fixes the schema and saves a distinct job.

    Trips of carriers outside the list, or of none, are in one column named ``other``; only ``other=None`` leaves them
    out. ``mean_delay_by_carrier`` needs no list.
    """
    x = null_nan(F.col(delay).cast("double"))
    if other is None:
        return df.groupBy(origin).pivot(carrier, list(carriers)).agg(F.avg(x))
    if other in carriers:
        raise ValueError(f"{other!r} is a carrier of the list")
    named = F.when(F.col(carrier).isin(list(carriers)), F.col(carrier)).otherwise(other)
    rows = df.select(F.col(origin), named.alias("_carrier"), x.alias("_delay"))
    return rows.groupBy(origin).pivot("_carrier", [*carriers, other]).agg(F.avg("_delay"))


def mean_delay_by_carrier(
    df: DataFrame, delay: str = "dep_delay_new", origin: str = "origin", carrier: str = "op_carrier"
) -> DataFrame:
    """The matrix in long form, over all carriers: one row per origin and carrier, also where the carrier is missing."""
    return df.groupBy(origin, carrier).agg(F.avg(null_nan(F.col(delay).cast("double"))).alias("mean_delay"))


def delay_level_counts(df: DataFrame, delay: str = "dep_delay_new", carrier: str = "op_carrier") -> DataFrame:
    """Trips per carrier and delay level."""
    return df.groupBy(carrier, delay_level(delay).alias("level")).agg(F.count(F.lit(1)).alias("n_trips"))


GRAM_FROM = 8
DOUBTFUL_BELOW = 1e-6
LEAST_VARIANCE = 1e-9


def correlation_matrix(df: DataFrame, columns: Sequence[str], by_gram: bool | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair of columns in long form, over the rows where both are known.

    Up to ``GRAM_FROM`` columns the values are grouped by pair. More columns would make a row into very many cells: then
    all pairs come from one Gram matrix, which Spark sums up per partition and merges, and only pairs that lose digits in
    it are grouped (``by_gram`` decides explicitly). Pairs without two different values on both sides are NULL.
    """
    pairs = list(enumerate(combinations_with_replacement(dict.fromkeys(columns), 2)))
    cleaned = df.select(*[null_nan(F.col(c).cast("double")).alias(c) for c in dict.fromkeys(columns)])
    by_gram = len(cleaned.columns) > GRAM_FROM if by_gram is None else by_gram
    measured = _pairs_by_gram(cleaned, pairs) if by_gram else _pairs_by_group(cleaned, pairs)
    listed = df.sparkSession.createDataFrame(
        [(i, a, b) for i, (a, b) in pairs], "pair int, column_a string, column_b string"
    )
    a, b = F.col("column_a"), F.col("column_b")
    exact = F.when((a == b) & F.col("r").isNotNull(), 1.0).otherwise(F.col("r")).alias("correlation")
    ordered = F.when(a == b, F.array(F.struct(a, b))).otherwise(
        F.array(F.struct(a, b), F.struct(b.alias("column_a"), a.alias("column_b")))
    )
    return listed.join(measured, "pair", "left").select(F.inline(ordered), exact)


def _pairs_by_group(cleaned: DataFrame, pairs: Sequence[tuple[int, tuple[str, str]]]) -> DataFrame:
    """Grouped by pair the generated code stays small, and only one row per pair and task is shuffled."""
    cells = [cell for i, (a, b) in pairs for cell in (F.lit(i), F.col(a), F.col(b))]
    both = cleaned.select(F.stack(F.lit(len(pairs)), *cells).alias("pair", "a", "b")).select(
        "pair",
        F.when(F.col("b").isNotNull(), F.col("a")).alias("a"),
        F.when(F.col("a").isNotNull(), F.col("b")).alias("b"),
    )
    # F.corr divides by zero, an error under ANSI rules, when one side is constant; the deviation of a constant such as
    # 0.1 is not exactly 0 after partial results are merged
    varied = (F.min("a") < F.max("a")) & (F.min("b") < F.max("b"))
    r = F.try_divide(F.covar_pop("a", "b"), F.stddev_pop("a") * F.stddev_pop("b"))
    return both.groupBy("pair").agg(F.when(varied, r).alias("r"))


def _pairs_by_gram(cleaned: DataFrame, pairs: Sequence[tuple[int, tuple[str, str]]]) -> DataFrame:
    """Per column three features: known or not, the standardised value, its square, the last two 0 where unknown.

    The mean products of these features hold count, sums and products of every pair over the rows where both are known.
    """
    cleaned, names = stage_table(cleaned), cleaned.columns
    cells = [cell for i, c in enumerate(names) for cell in (F.lit(i), F.col(c))]
    spread = cleaned.select(F.stack(F.lit(len(names)), *cells).alias("c", "v")).groupBy("c")
    moments = spread.agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")).where("sd > 0 and sd < 'infinity'")
    varied = {names[r["c"]]: r for r in moments.collect()}  # one row per column
    products = _mean_products(cleaned, varied) if varied else {}
    rows, doubtful = [], []
    for i, (a, b) in pairs:
        r = _correlation(products, a, b) if a in varied and b in varied else None
        if r is None:
            doubtful.append((i, (a, b)))
        else:
            rows.append((i, r))
    measured = cleaned.sparkSession.createDataFrame(rows, "pair int, r double")  # one row per pair
    return measured.unionByName(_pairs_by_group(cleaned, doubtful)) if doubtful else measured


def _mean_products(cleaned: DataFrame, varied: Mapping[str, Row]) -> dict[tuple[str, str, str, str], float]:
    """Mean product of every two features, by kind and column; left out where a variance is too small for Spark's matrix."""
    features = {}
    for c, column in varied.items():
        z = F.coalesce((F.col(c) - column["mean"]) / column["sd"], F.lit(0.0))
        features |= {("known", c): F.col(c).isNotNull().cast("double"), ("z", c): z, ("square", c): z * z}
    named = cleaned.select(*[f.alias(f"f{i}") for i, f in enumerate(features.values())])
    vectors = VectorAssembler(inputCols=named.columns, outputCol="features").transform(named).select("features")
    metrics = Summarizer.metrics("mean", "variance", "count").summary(F.col("features"))
    moments = vectors.select(metrics.alias("m")).select("m.mean", "m.variance", "m.count").first()
    mean, variance, n = moments["mean"].toArray().tolist(), moments["variance"].toArray().tolist(), moments["count"]
    matrix = Correlation.corr(vectors, "features").first()[0].toArray().tolist()
    products = {}
    for i, one in enumerate(features):
        for j, other in enumerate(features):
            always = [k for k in (i, j) if variance[k] == 0]  # such as "known" of a column without gaps
            if not always and min(variance[i], variance[j]) < LEAST_VARIANCE:
                continue
            covariance = 0.0 if always else matrix[i][j] * sqrt(variance[i] * variance[j]) * (n - 1) / n
            products[(*one, *other)] = covariance + mean[i] * mean[j]
    return products


def _correlation(products: Mapping[tuple[str, str, str, str], float], a: str, b: str) -> float | None:
    """None where the sums lose too many digits, or where there is no correlation."""
    wanted = [("known", a, "known", b), ("z", a, "known", b), ("z", b, "known", a), ("square", a, "known", b),
              ("square", b, "known", a), ("z", a, "z", b)]
    if any(key not in products for key in wanted):
        return None
    share, za, zb, aa, bb, ab = (products[key] for key in wanted)
    if not share > LEAST_VARIANCE:
        return None
    va, vb = aa - za * za / share, bb - zb * zb / share
    if not (va > max(DOUBTFUL_BELOW * aa, LEAST_VARIANCE) and vb > max(DOUBTFUL_BELOW * bb, LEAST_VARIANCE)):
        return None
    return (ab - za * zb / share) / sqrt(va * vb)


def date_bounds(df: DataFrame, column: str = "fl_date") -> DataFrame:
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Known values per column, one output column each."""
    return df.agg(*[F.count(c).alias(c) for c in columns or df.columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()
) -> DataFrame:
    """``mse``, ``rmse``, ``mae`` and ``r2`` over the rows where both values are known, in one aggregation."""
    y, p = null_nan(F.col(actual).cast("double")), null_nan(F.col(predicted).cast("double"))
    known = df.select(*keys, y.alias("_y"), p.alias("_p")).where(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    error = F.col("_y") - F.col("_p")
    # sum of squares about the mean = n * population variance, which Spark accumulates in a stable way
    total = F.var_pop("_y") * F.count("_y")
    mse = F.avg(error * error)
    return known.groupBy(*keys).agg(
        F.count("_y").alias("n_rows"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), total)).alias("r2"),
    )


def order_desc(df: DataFrame, value: str, tie: Sequence[str] = ()) -> DataFrame:
    """Largest first; the tie columns make the order repeatable."""
    return df.orderBy(F.col(value).desc(), *tie)


def top_k(df: DataFrame, value: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest value; every task keeps only its own best ``k``."""
    return order_desc(df, value, tie).limit(k)


def page_rows(df: DataFrame, lo: int, hi: int, order: Sequence[str]) -> DataFrame:
    """Rows ``lo`` up to but without ``hi`` in the given order.

    Within the first ``FIRST_PAGES`` rows every task keeps its best ``hi``. Further on the rows are dealt by ranges, and
    the sums of earlier ranges' counts tell which ranges hold the page, so that no task has more than its range. Ties in
    ``order`` come in the order of a hash of the whole row, which also splits a value that very many rows have.
    """
    if hi <= FIRST_PAGES:
        return df.orderBy(*order).offset(lo).limit(hi - lo)
    ranges = _ranged(df, order)
    counts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    sums = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    wanted = sums.where((F.col("before") < hi) & (F.col("before") + F.col("n") > lo))
    first, last = wanted.agg(F.min("part"), F.max("part")).first()
    if first is None:
        return df.limit(0)
    number = F.col("before") + F.col("place") - F.col("least")
    page = ranges.where(F.col("part").between(first, last)).join(wanted, "part").withColumn("number", number)
    return page.where(F.col("number").between(lo, hi - 1)).orderBy("number").select("row.*")


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Every row as a struct with its range and its place, which grows within the range; written once."""
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    keys = [*(F.col(f"row.`{c}`") for c in order), F.xxhash64(*[F.col(f"row.`{c}`") for c in hashable])]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage_table(
        dealt.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    )

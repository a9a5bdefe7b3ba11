"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import WORD, packed, stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2
ROUNDS = 60
TOLERANCE = 1e-9
SLICE_ROWS = 512
BLOCK_ROWS = 1024
OFFSETS = 32


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Targets of sources (_source, source_size): ``share`` of all sizes, dealt by weight, none above ``cap`` times its source.

    Sources in order of code points, null last, take the weights in turn. What a full source cannot take is dealt again to
    the others by weight: with sources ordered by limit over weight, the level at which the rest is dealt follows from two
    running sums. One row per source.
    """
    order = Window.orderBy(F.col("_source").isNull(), "_source")
    every = Window.partitionBy()
    place = F.row_number().over(order) - 1
    weight = F.array(*[F.lit(float(w)) for w in weights])[(place % len(weights)).cast("int")]
    listed = sizes.select("_source", "source_size", weight.alias("_weight"), (cap * F.col("source_size")).alias("_limit"))
    by_limit = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("_source").isNull(), "_source")
    full = F.sum("_limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1))
    open_weight = F.sum("_weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    goal = F.sum("source_size").over(every) * F.lit(float(share))
    level = (goal - F.coalesce(full, F.lit(0))) / open_weight
    leveled = listed.withColumn("_level", level)
    settles = F.when(F.col("_level") * F.col("_weight") <= F.col("_limit"), F.col("_level"))
    chosen = leveled.withColumn("_chosen", F.max(settles).over(every))
    return chosen.select(
        "_source",
        "source_size",
        F.least(F.col("_limit").cast("double"), F.coalesce(F.col("_chosen") * F.col("_weight"), F.col("_limit"))).alias("target"),
    )


def _rate(tilt: Column, size: Column, mean: Column, cap: int) -> Column:
    return F.lit(float(cap)) / (1 + (cap - 1) * F.exp(-F.least(F.greatest(tilt * size / mean, F.lit(-700.0)), F.lit(700.0))))


def balanced_rates(cells: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Rate per cell (_source, _size, _n) that meets every source's target and is nearest to one copy of everything.

    Nearest in relative entropy with at most ``cap`` copies: the odds rate / (cap - rate) are tilted by exp(tilt * size).
    The convex dual has one tilt per source. Each Newton round is one aggregation over the cells, the compressed
    documents; it works on the log-odds of the words taken, in which the problem is nearly linear, and stays within a
    bracket. Tilts live in a table and are rounded in the end, so that the order of summation cannot show.
    """
    spread = cells.groupBy(F.col("_source").alias("_s")).agg(
        (F.sum(F.col("_n") * F.col("_size")) / F.sum("_n")).alias("_mean")
    )
    start = targets.join(spread, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    full, goal = cap * F.col("source_size"), F.col("target")
    usable = (goal > 0) & (goal < full * (1 - 1e-12))
    state = stage(
        start.select(
            "*", usable.alias("_open"), F.lit(0.0).alias("_tilt"), F.lit(-1e6).alias("_lo"), F.lit(1e6).alias("_hi")
        ),
        "tilts",
    )
    for _ in range(ROUNDS):
        state = stage(_newton(cells, state, cap), "tilts")
        gap = state.where("_open").agg(F.max(F.abs(F.col("_taken") / F.col("target") - 1))).first()[0]
        if gap is None or gap < TOLERANCE:
            break
        state = state.drop("_taken")
    tilt = F.round("_tilt", 6)
    closed = F.when(F.col("target") > 0, float(cap)).otherwise(0.0)
    rate = F.when(F.col("_open"), _rate(tilt, F.col("_size"), F.col("_mean"), cap)).otherwise(closed)
    own = state.select(F.col("_source").alias("_s"), "source_size", "target", "_open", "_tilt", "_mean")
    joined = cells.join(own, F.col("_source").eqNullSafe(F.col("_s")))
    return joined.select("_source", "_size", "_n", "source_size", "target", F.when(F.col("_size") > 0, rate).otherwise(0.0).alias("_rate"))


def _newton(cells: DataFrame, state: DataFrame, cap: int) -> DataFrame:
    live = state.where("_open").select(F.col("_source").alias("_s"), "_tilt", "_mean")
    rate = _rate(F.col("_tilt"), F.col("_size"), F.col("_mean"), cap)
    words = F.col("_n") * F.col("_size")
    sums = (
        cells.join(live, F.col("_source").eqNullSafe(F.col("_s")))
        .groupBy("_s")
        .agg(
            F.sum(words * rate).alias("_g"),
            F.sum(words * rate * (1 - rate / cap) * F.col("_size") / F.col("_mean")).alias("_h"),
        )
    )
    joined = state.join(sums, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    full, goal, tilt = cap * F.col("source_size"), F.col("target"), F.col("_tilt")
    log_odds = F.log(F.col("_g") / (full - F.col("_g"))) - F.log(goal / (full - goal))
    slope = F.col("_h") * (1 / F.col("_g") + 1 / (full - F.col("_g")))
    lo = F.when(F.col("_g") < goal, tilt).otherwise(F.col("_lo"))
    hi = F.when(F.col("_g") > goal, tilt).otherwise(F.col("_hi"))
    step = joined.withColumns({"_lo": lo, "_hi": hi, "_step": tilt - F.try_divide(log_odds, slope)})
    inside = (F.col("_step") > F.col("_lo")) & (F.col("_step") < F.col("_hi"))
    done = F.abs(F.col("_g") / goal - 1) < TOLERANCE
    moved = F.when(~F.col("_open") | done, tilt).when(inside, F.col("_step")).otherwise((F.col("_lo") + F.col("_hi")) / 2)
    return step.withColumn("_tilt", F.coalesce(moved, tilt)).withColumn("_taken", F.col("_g")).drop("_g", "_h", "_step")


def entropy_mix(
    documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 17
) -> DataFrame:
    """Copies of every document so that the words of each source come to its target.

    Size is the number of words (null text: 0). Returns doc_id, size, source_size, target, taken (words taken, repeats
    counted), copies and text_key (a hash of the text), one row per row of ``documents``.

    Rounding: along each source's cells in order of size, the running sum of rates is rounded, so that the words taken
    differ from the target by at most about one document of the largest size, and by much less after the best of
    ``OFFSETS`` fixed offsets is taken; a cell's copies are dealt evenly, the odd ones to the smallest hashes. Cells with many documents are dealt in slices of about ``SLICE_ROWS`` rows by hash: no
    group is ever larger, whatever the sources are. Only values decide, so the mix does not depend on the order or the
    partitions of ``documents``: rows that agree in doc_id, source and text are counted first and dealt as one entry.

    Null sources form one source, last in order. Documents without words take nothing. Rows that repeat a doc_id are
    separate documents. An empty table gives an empty result; other columns are ignored.
    """
    rows = stage(
        documents.select(
            "doc_id",
            F.col("source").alias("_source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
            F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"),
        )
        .groupBy("doc_id", "_source", "_size", "text_key")
        .agg(F.count(F.lit(1)).alias("_rows")),
        "sizes",
    )
    cells = stage(rows.groupBy("_source", "_size").agg(F.sum("_rows").alias("_n")), "cells")
    sizes = cells.groupBy("_source").agg(F.sum(F.col("_n") * F.col("_size")).alias("source_size"))
    targets = stage(source_targets(sizes, weights, share, cap), "targets")
    rates = balanced_rates(cells, targets, cap)

    along = Window.partitionBy("_source").orderBy("_size")
    running = F.sum(F.col("_n") * F.col("_rate")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    summed = stage(rates.withColumn("_upto", running).withColumn("_before", F.coalesce(F.lag("_upto").over(along), F.lit(0.0))), "summed")

    def rounded(offset: Column) -> Column:
        return F.floor(F.col("_upto") + offset) - F.floor(F.col("_before") + offset)

    # Of a fixed set of offsets each source takes the one whose rounding comes nearest to its target.
    tried = summed.select("_source", "_size", "target", "_upto", "_before", F.explode(F.array(*[F.lit((2 * i + 1) / (2 * OFFSETS)) for i in range(OFFSETS)])).alias("_offset"))
    errors = tried.groupBy("_source", "_offset").agg(F.abs(F.sum(rounded(F.col("_offset")) * F.col("_size")) - F.first("target")).alias("_error"))
    best = errors.groupBy(F.col("_source").alias("_s")).agg(F.min(F.struct("_error", "_offset"))["_offset"].alias("_offset"))
    chosen = summed.join(best, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    dealt = chosen.withColumn("_all", rounded(F.col("_offset")))
    plan = stage(
        dealt.select(
            F.col("_source").alias("_s"),
            F.col("_size").alias("_z"),
            "_n",
            "source_size",
            "target",
            F.floor(F.col("_all") / F.col("_n")).alias("_each"),
            (F.col("_all") % F.col("_n")).alias("_odd"),
            F.ceil(F.col("_n") / SLICE_ROWS).alias("_slices"),
        ),
        "plan",
    )
    placed = rows.join(plan, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")))
    order = F.xxhash64(F.lit(seed), "doc_id", "text_key")
    sliced = placed.withColumn("_slice", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text_key"), F.col("_slices")))
    group = ["_s", "_size", "_slice"]
    spread = sliced.repartition(*group)  # a cell's slices part here, whatever the join was dealt by
    within = Window.partitionBy(*group)
    here = F.col("_odd") * F.sum("_rows").over(within)
    chance = F.pmod(F.xxhash64(F.lit(seed + 2), *group), F.lit(1 << 30)) / float(1 << 30)
    quota = F.floor(here / F.col("_n")) + (chance < (here % F.col("_n")) / F.col("_n")).cast("long")
    upto = F.sum("_rows").over(within.orderBy(order, "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, 0))
    first = F.col("_rows") - F.greatest(F.least(upto - quota, F.col("_rows")), F.lit(0))  # so many rows take one more
    # equal rows come apart again in blocks, so that no long array is ever held
    blocks = spread.select("*", first.alias("_first")).select("*", F.explode(F.sequence(F.lit(1), "_rows", F.lit(BLOCK_ROWS))).alias("_block"))
    last = F.least(F.col("_rows"), F.col("_block") + F.lit(BLOCK_ROWS - 1))
    single = blocks.select("*", F.explode(F.sequence("_block", last)).alias("_number"))
    copies = F.col("_each") + (F.col("_number") <= F.col("_first")).cast("long")
    return single.select("*", copies.alias("copies")).select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("copies") * F.col("_size")).alias("taken"),
        "copies",
        "text_key",
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` as often as ``entropy_mix`` takes them, all columns.

    Rows that repeat a doc_id and a text take the sum of their copies. Columns may have any names.
    """
    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    copies = entropy_mix(documents.select("doc_id", "source", "text"), **options).where("copies > 0")
    taken = copies.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.sum("copies").alias("_copies"))
    single = packed(documents, doc_id=F.col("doc_id"), own=text_key).dropDuplicates(["doc_id", "own"])
    joined = single.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_key")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("row.*")

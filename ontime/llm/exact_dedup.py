"""Exact duplicates by a tree merge of sorted digest runs, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import SPACE, packed, stage

FAN_IN = 8
_TEXT = ("_digest", "_length", "_check")


def exact_groups(documents: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Every row of ``documents`` (doc_id, text) with its group of equal texts.

    Texts are equal when they are identical after each run of white space became one space; a null text counts as empty.
    Returns doc_id, keep_id, group_size, kept, text_sha256, and the number ``row_id`` that names the row.

    Each scan partition yields one sorted run of digests. In every round ``fan_in`` runs meet: the rows of one text in
    them become one, with the smallest identifier, where digest, length and a second hash agree. The answer then goes back
    down the same tree. A text that fills a third of the table is thus spread over as many keys as there are runs, and no
    merge group has more than ``fan_in`` rows above the runs themselves.

    A null doc_id stays only if its whole group has none (keep_id is then null and kept true for one row). Rows that repeat
    a doc_id and text: one of them is kept. An empty table gives an empty result; other columns are ignored.
    """
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")
    rows = stage(
        documents.select("doc_id", text.alias("_text"))
        .select(
            "doc_id",
            F.monotonically_increasing_id().alias("row_id"),
            F.spark_partition_id().alias("_run"),
            F.unhex(F.sha2("_text", 256)).alias("_digest"),
            F.length("_text").alias("_length"),
            F.xxhash64("_text").alias("_check"),
        )
        .sortWithinPartitions("_digest"),
        "digests",
    )
    own = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("row_id").alias("row"))
    levels = [
        stage(rows.groupBy(*_TEXT, "_run").agg(F.min(own).alias("_least"), F.count(F.lit(1)).alias("_size")), "runs")
    ]
    last = rows.agg(F.max("_run")).first()[0] or 0
    while last > 0:
        last //= fan_in
        merged = (
            levels[-1]
            .groupBy(*_TEXT, (F.col("_run") / fan_in).cast("int").alias("_run"))
            .agg(F.min("_least").alias("_least"), F.sum("_size").alias("_size"))
        )
        levels.append(stage(merged, "runs"))

    answer = levels.pop()
    while levels:
        parent = answer.withColumnsRenamed({"_run": "_parent", "_least": "_l", "_size": "_s"})
        child = levels.pop().select(*_TEXT, "_run", (F.col("_run") / fan_in).cast("int").alias("_parent"))
        answer = child.join(parent, [*_TEXT, "_parent"]).select(
            *_TEXT, "_run", F.col("_l").alias("_least"), F.col("_s").alias("_size")
        )
    return rows.join(answer, [*_TEXT, "_run"]).select(
        "doc_id",
        F.col("_least.id").alias("keep_id"),
        F.col("_size").cast("long").alias("group_size"),
        (F.col("_least.row") == F.col("row_id")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
        "row_id",
    )


def drop_copies(documents: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The rows of ``documents`` that stay, all columns, whatever their names; of rows that repeat a doc_id within a
    group, one stays."""
    groups = exact_groups(documents, fan_in).where("kept")
    chosen = groups.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")
    # Identifiers are unique in a clean table; the digest tells rows apart that share one by mistake.
    marked = packed(documents, doc_id=F.col("doc_id"), own=F.sha2(text, 256))
    joined = marked.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_sha")), "left_semi")
    return joined.dropDuplicates(["doc_id", "own"]).select("row.*")

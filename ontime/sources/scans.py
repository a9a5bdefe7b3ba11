"""Reading: catalog tables, parquet directories, parameterised SQL, samples."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions.columns import ColumnLike, as_column

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def partition_values(spark: SparkSession, name: str, column: str) -> DataFrame:
    """Values of a partition column of a catalog table, from the catalog: no data file is opened.

    One row per partition; a partition that holds no rows any more is listed until it is dropped.
    """
    # names are escaped as in file paths, where a plus sign stands for itself
    escaped = F.regexp_extract("partition", f"(?:^|/)(?i:{re.escape(column)})=([^/]*)", 1)
    text = F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    known = F.when(escaped != NO_VALUE, text).cast(spark.table(name).schema[column].dataType)
    return spark.sql(f"show partitions {name}").select(known.alias(column))


def param_query(spark: SparkSession, sql: str, args: Mapping[str, Any], **frames: DataFrame) -> DataFrame:
    """SQL with named parameters (``:start``) and, optionally, frames referred to as ``{name}``."""
    return spark.sql(sql, args=dict(args), **frames)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make the plan available to SQL under ``name`` and return it as read through that name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


HASH_DIGITS = 8


def hash_below(keys: Sequence[ColumnLike], fraction: float, salt: str = ""):
    """True for about ``fraction`` of the keys, always the same ones."""
    parts = [F.coalesce(as_column(k).cast("string"), F.lit("")) for k in keys]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(salt), *parts)), 1, HASH_DIGITS)
    if fraction >= 1:
        return F.lit(True)
    return digits < F.lit(f"{int(fraction * 16**HASH_DIGITS):0{HASH_DIGITS}x}")


def sample_by_hash(df: DataFrame, key: ColumnLike | Sequence[ColumnLike], fraction: float, salt: str = "") -> DataFrame:
    """Sample that keeps the same keys on every run and every cluster; needs no shuffle."""
    keys = [key] if isinstance(key, (str, type(F.lit(0)))) else list(key)
    return df.where(hash_below(keys, fraction, salt))

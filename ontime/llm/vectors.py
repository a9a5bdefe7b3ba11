"""What the vector operators share: usable rows on an integer grid, and sums over all rows that have a fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import prepare_workers, stage

ROWS_PER_BATCH = 8192


def usable(vector: Column) -> Column:
    """Neither the vector nor any entry is null, and every entry is finite."""
    infinite = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < infinite))


def on_grid(table: DataFrame, vector: str, scale: int, shift: int, *keep: str) -> DataFrame:
    """A stage table of the usable rows: ``keep`` and x, the list of floor(scale * entry) + shift."""
    entries = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * scale) + F.lit(shift))
    rows = table.where(F.coalesce(usable(F.col(vector)), F.lit(False)))
    return stage(rows.select(*keep, entries.cast("array<bigint>").alias("x")), "vectors")


def shape(rows: DataFrame) -> tuple[int, int, int]:
    """Rows, entries per row and largest absolute entry. Rows of different lengths are an error."""
    n, least, most, largest = rows.agg(
        F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))
    ).first()
    if least != most:
        raise ValueError(f"vectors of {least} and of {most} entries in one table")
    return n, most or 0, largest or 0


def matrix(batch: pa.RecordBatch, n_entries: int) -> np.ndarray:
    """The lists of column x as the rows of a matrix."""
    lists = batch.column(batch.schema.get_field_index("x"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_entries)


def sums_over(
    rows: DataFrame, n_entries: int, of_batch: Callable[[np.ndarray], np.ndarray], kind: type = np.float64
) -> np.ndarray:
    """``of_batch`` of every batch of rows, added up entry by entry.

    Each task adds its batches and hands on one number per entry, which Spark adds up by position: what is shuffled and
    what the driver receives depends on the size of the result only, not on the rows.
    """
    prepare_workers(rows.sparkSession, ROWS_PER_BATCH)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = np.asarray(of_batch(matrix(batch, n_entries)), dtype=kind).ravel()
                total = found if total is None else total + found
        if total is not None:
            places = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total)], ["place", "value"])

    number = "double" if kind is np.float64 else "bigint"
    parts = rows.select("x").mapInArrow(partial, f"place int, value {number}")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(found), dtype=kind)
    for row in found:
        out[row["place"]] = row["value"]
    return out

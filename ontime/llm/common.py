"""What the text operators share: tables, stage tables in the shared folder, label folds, word patterns."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.textarrays import utf8
from ontime.sources.sinks import shared_dir

# White space and words of every operator: fixed by the result contracts.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

BATCH_ROWS = 512
PIECES = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/llm-{label}-{uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to a new folder in the shared directory and go on from there: cuts lineage and survives lost executors."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare_workers(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send this package to the executors, and bound what one Arrow batch holds, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if any(name.startswith("ontime-package") for name in map(_file_name, context._python_includes)):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ontime-")) / f"ontime-package-{uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))  # Spark hands the file to every executor


def _file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """Every row of ``df`` as one struct ``row`` beside the ``extra`` columns, whose names then clash with none."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in extra.items()])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % modulus


def training_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int, max_chars: int,
) -> DataFrame:
    """Labelled texts (text, y) to fit a model on: at most ``per_class`` rows of each class, chosen by the hash of their
    doc_id. Of texts of more than ``max_chars`` characters, ``PIECES`` pieces of as many in all are learned from, spread
    evenly from the start to the end, so that what reaches the driver is bounded and no label is lost.
    Rows that ``usable`` excludes, null texts and null labels are left out. Conflicting labels of one doc_id: the larger.
    """
    size = max(max_chars // PIECES, 1)
    gap = (F.length("text") - size) / (PIECES - 1)
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)),
        lambda i: F.substr(F.col("text"), F.floor(i * gap).cast("int") + 1, F.lit(size)),
    )
    short = F.when(F.length("text") <= max_chars, F.col("text")).otherwise(F.array_join(pieces, " "))
    marks = labels.where(usable & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    texts = documents.select("doc_id", "text").where(usable & F.col("text").isNotNull())
    order = (F.xxhash64(F.lit("sample"), "doc_id"), "doc_id")
    chosen = [marks.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    wanted = stage(chosen[0].unionByName(chosen[1]), "sample-ids")
    found = texts.join(wanted, "doc_id").select("doc_id", short.alias("text"), F.col("y").cast("int").alias("y"))
    # the text takes part in the order so that repeated doc_ids cannot change the sample from run to run
    return found.orderBy(F.xxhash64(F.lit("order"), "doc_id"), "doc_id", F.xxhash64("text")).limit(2 * per_class)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``most`` bytes of text, a single longer text alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not batch.num_rows:
            continue
        sizes = utf8(column)[1]
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(sizes, sizes[start] + most, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop

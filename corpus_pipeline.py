"""From raw documents to sampled token sequences: five stages, each of which writes what it keeps for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import free_name, fresh_folder, table
from ontime.llm.exact_dedup import drop_copies
from ontime.llm.minhash import near_duplicates
from ontime.llm.mixing import mixed_documents
from ontime.llm.segmentation import sample_segmentations
from ontime.llm.toxicity import CUT, fit_from, held_out, score_texts


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cut. Labels of the held-out fold are not learned from."""
    model = fit_from(docs, table(spark, sf_dir, "labels"), ~held_out())
    score = free_name(docs, "_toxicity")
    return score_texts(docs, model, *docs.columns, score_name=score).where(F.col(score) < CUT).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, 80 percent; rows without doc_id stay."""
    dropped = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every row."""
    return sample_segmentations(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("segmentation", segment),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. All stages but the last are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)

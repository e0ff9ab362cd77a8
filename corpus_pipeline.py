"""From raw documents to packed training sequences, one stored stage after another.

Defined cases of every stage: a NULL text counts as empty; an empty text is rejected by quality_rules only if its votes say so, is
never toxic, has no near-duplicates and no benchmark passage, and is packed as its end token; a row without doc_id is judged like any other; repeated
rows are judged each for itself, and near_duplicates keeps one of them; an empty table stays empty; further columns pass through whatever
their names are.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from reelspark.llm import decontamination, near_duplicates, packing, quality_rules, toxicity
from reelspark.session import ensure_checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules accept: a posterior of one half or more."""
    return quality_rules.keep_good(docs)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't found toxic."""
    return toxicity.keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8 or more): the smallest doc_id."""
    return near_duplicates.keep_one(docs, 5, (80, 100))


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the place of every piece of every document."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("toxicity", keep_civil),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_unseen),
    ("packing", pack),
]
# Labels learnt from votes, trained dictionaries and packing are not SQL; tests/llm/ compares the stages with brute force.
ORACLE_SQL = None


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stage that an earlier run has finished; the mark beside it is written last."""
    try:
        spark.read.parquet(f"{path}.done")
    except AnalysisException:
        return None
    return spark.read.parquet(path)


def run(spark: SparkSession, sf_dir: str, run_id: str | None = None) -> DataFrame:
    """The stages over documents. Each is written as Parquet to the shared checkpoint folder and read again by the next.

    A run with a run_id takes up the stages that an earlier run of this id has finished, for example after a lost driver. The folder
    `pipeline-<run_id>` is the caller's to delete."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir() if run_id is None else _shared(spark)}/pipeline-{run_id or uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stored = _stored(spark, path) if run_id else None
        if stored is None:
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
            if run_id:
                spark.range(1).write.mode("overwrite").parquet(f"{path}.done")
            stored = spark.read.parquet(path)
        docs = stored
    return docs


def _shared(spark: SparkSession) -> str:
    """The folder that outlives a session; the checkpoint folder itself has a name of its own in each session."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()

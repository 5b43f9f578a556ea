"""A training-corpus pipeline over ``documents``.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which :func:`run` writes as Parquet to the shared folder
and rereads as the next stage's input.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm import chosen_path, decontaminate, mixing, quality, token_files
from dimforge.llm.queries import END_ID, tokenizer_path
from dimforge.llm.storage import materialize
from dimforge.sources.tables import read_table


def _small_batches(spark: SparkSession) -> None:
    """Texts are long: fewer rows in each batch that Python tasks get."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    _small_batches(spark)
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return quality.classify(docs, labels, only_kept=True)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at Jaccard 0.8 on five-word shingles."""
    _small_batches(spark)
    return chosen_path.one_per_group(docs, width=5, threshold=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents left without words go."""
    _small_batches(spark)
    found = decontaminate.find_spans(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"), width=10)
    cut = decontaminate.remove_spans(found)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their target weights."""
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, max_rate=2.0)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed corpus; returns what is read back from them."""
    _small_batches(spark)
    manifest = token_files.write_files(docs, tokenizer_path(), END_ID)
    return token_files.read_files(manifest, with_ids=False)


STAGES = [
    ("quality_classifier", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

# The classifier, the near-duplicate join and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

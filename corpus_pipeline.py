"""From raw documents to placed training rows: five stages, each on all rows that the one before kept.

    run(spark, "/data/tables")      reads documents, labels and benchmark there

Each stage's rows are written to the shared folder and read again, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import jaccard, mixing, phrases, sharding, toxicity
from tidewatch.session import cut_lineage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity classifier, trained on `labels`, predicts to be toxic go."""
    return toxicity.clean_rows(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by five-word shingles one stays; texts without words all stay."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a window of a `benchmark` item go."""
    return phrases.uncontaminated_rows(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix of sources takes it: repeated rows are copies, rows not taken are absent."""
    return mixing.mix_rows(docs)


def place(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the slot and the shard of each."""
    return sharding.placed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing_sources", mix_sources),
    ("sharding", place),
]

#: The first stage is a trained model, which SQL cannot express; tests hold the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs

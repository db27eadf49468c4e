"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Toxic documents go, one document of each near-duplicate group stays, documents contaminated by the
benchmark go, the rest is drawn to target token shares of the labelled domains (without repetition), and
every document left gets its shard and its place in it. Each stage takes ``(spark, docs, sf_dir)``; its
fit and statistics come from ``docs`` and the other tables in ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import decontam, mixing, near_dedup, sharding, toxicity
from lakeworks.llm.frames import aside, back
from lakeworks.session import scratch_path
from lakeworks.suite import table

#: documents of this score or more are rejected
TOXIC_SCORE = 0.3
#: near duplicates: intersection of the shingle sets in percent of their union
SIMILARITY = 85
#: target shares of the domains, in tokens
TARGETS = {"good": 0.9, "poor": 0.1}
SHARDS = (1.0,) * 8


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects; null and empty texts are scored too."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    return back(model.score(aside(docs)).where(F.col("score") < TOXIC_SCORE), docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, exact copies included."""
    return near_dedup.one_of_each_group(docs, SIMILARITY)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the benchmark contaminates."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drawn to the target shares: a document stays with probability min(1, rate), by a fixed hash of its id."""
    labels = mixing.label_domains(table(spark, sf_dir, "labels"), toxic=False)
    mixed, _ = mixing.mix(aside(docs), labels, TARGETS, upsample=False)
    return back(mixed.where(F.col("copies") > 0), docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``shard`` and ``slot``, their place in the shard (replacing columns of these names)."""
    rows = docs.drop("shard", "slot").withColumn("shard", sharding.rendezvous(F.col("doc_id"), SHARDS).cast("int"))
    return sharding.with_slots(rows, "shard", [F.col("doc_id"), F.col("text")], ["doc_id"])


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: the first stage fits a model, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result keeps its columns and adds those of the last stage."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

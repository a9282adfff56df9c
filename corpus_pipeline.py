"""From raw documents to a training mix: each stage is one operator, stored and read again.

Every stage takes (spark, docs, sf_dir) with the columns of documents and works on all rows
its predecessor kept. All but the last return these columns; the last adds what it decided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontam, mixing, neardup, pii, toxicity
from eventloom.llm.tables import stored
from eventloom.llm.text import tuned


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-duplicates."""
    return neardup.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced by their kind."""
    return pii.redacted(docs, pii.train()).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that languages, topics and flattened sources meet their shares."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", redact),
    ("mixing", mix),
]

#: Models, random walks and iterative fitting have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

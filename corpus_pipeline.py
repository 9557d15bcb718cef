"""documents -> packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the
columns of documents. SQL can't express the stages (a learned classifier, sketches, a tokenizers file), so there is no
SQL for the result; tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskflow.llm import decontaminate, near_dup, packing, secret_scan, toxicity
from riskflow.llm.queries import table, vocabulary
from riskflow.llm.shared import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the classifier learns from the labelled rows that aren't held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score(docs, model, "_rf_score").filter("_rf_score < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that with the smallest doc_id."""
    return near_dup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens at most."""
    return packing.pack(docs, vocabulary("words"), end=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

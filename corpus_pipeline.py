"""A training-data pipeline over ``documents``: filter, deduplicate, decontaminate, pack.

Every stage takes the documents its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.llm import decontaminate, line_dedup, packing, simhash, toxicity
from tallyglass.llm.rows import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones scores below the threshold."""
    return toxicity.keep_civil(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines under later occurrences of three-line windows."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    # Columns are told apart by place: documents may have columns of the operator's names.
    places = [f"c{i}" for i in range(len(carry))]
    rows = line_dedup.remove_lines(docs, carry=carry).toDF("doc_id", "lines", "removed", "text", *places)
    out = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    out |= {name: F.col(place) for name, place in zip(carry, places)}
    return rows.select(*(out[c].alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, and one row of each document."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all tokenized documents in sequences of fixed length."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: The first stage is a trained model, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

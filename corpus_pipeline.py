"""A training corpus from ``documents`` in five stages; each is written as Parquet and read as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamis.llm import decontaminate, packing, pii, simhash, toxicity
from tamis.llm.common import table
from tamis.storage import discard, materialise, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: that of the smallest id."""
    return simhash.keep_first(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text gives way to the name of its kind; ``n_chars`` follows."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents, packed."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("simhash near-duplicates", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("pii", redact_personal_data),
    ("best-fit packing", pack_sequences),
]

#: SQL expresses neither the trained stages nor the packing; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark, name.replace(" ", "-"))
            docs = materialise(docs, name, path=path)
            if held:
                discard(spark, held)
            held = path
    return docs

"""The corpus pipeline: five stages, each over all that the one before kept.

``STAGES`` lists them as (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm import benchmark_leaks, near_dups, packing, personal_data, toxicity
from greenledger.llm.queries import SURROGATE_KEY
from greenledger.llm.tables import read, written

#: No SQL can say the learned stages; tests hold the near-duplicate and the leak stage against brute force.
ORACLE_SQL = None

#: Likeness, in hundredths, from which the near-duplicate stage links documents (op1: 85).
STAGE_PERCENT = 80
#: With 80 bands of 8 coordinates a pair of likeness 0.80 is missed with chance 4e-7.
STAGE_BANDS, STAGE_ROWS = 80, 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of least id."""
    return near_dups.deduplicated(docs, percent=STAGE_PERCENT, bands=STAGE_BANDS,
                                  rows=STAGE_ROWS).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return benchmark_leaks.decontaminated(docs, items).select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data."""
    out = personal_data.replaced(docs, SURROGATE_KEY)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining texts, packed into training sequences."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs

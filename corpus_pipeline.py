"""Corpus pipeline: five stages, each calling one training-data operator on all that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm.packing import pack_documents
from marketlake.llm.pii import replace_private
from marketlake.llm.quality import keep_good
from marketlake.llm.simhash import keep_one
from marketlake.llm.suffix_dedup import cut_repeats
from marketlake.session import new_location

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one),
    ("repeated_passages", cut_repeats),
    ("private_data", replace_private),
    ("packing", pack_documents),
]

#: A trained classifier and a genetic algorithm have no SQL form; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage is written and read again, so a later stage
    never repeats an earlier one and a lost executor costs one stage at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = new_location(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

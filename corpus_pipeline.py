"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

1. quality: documents whose byte-network score is below 0.3 go.
2. near_duplicates: of each group of near-duplicates one document stays.
3. decontaminate: documents that hold a benchmark item go.
4. mixing: documents are sampled by their raked chance.
5. token_files: what is left becomes Arrow stream files of token sequences; the result is their index.

Stages 1 to 4 return the columns of their input, whatever their names.  Null and empty texts, null ids and repeated rows
are treated as each operator states: an empty text is scored like any other, is no near-duplicate and no leak; of rows
that repeat id and text one stays; null ids pass the second and third stage; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import decontam, mixing, neardup, quality, token_files
from zonecast.llm.common import settled, table
from zonecast.session import drop_tables, made_tables


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, words=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs, fraction=0.5)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_report(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

#: No SQL can learn the classifier or run the tokenizer; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is a table in the shared folder.

    A stage's own intermediate tables, and its input, are deleted when its result is written.
    """
    docs, before = table(spark, sf_dir, "documents"), len(made_tables(spark))
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_tables(spark, since=before, keep=1)
    return docs

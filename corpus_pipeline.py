"""From raw documents to a token table, one operator a stage.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, and each stage works on
all that its predecessor kept. All stages but the last return the columns of ``documents``; the mix repeats a row for each
copy it takes. Decisions rest on texts, and on doc_ids where rows are alike; a row without an id comes after those with one.
Empty tables give empty results; extra columns travel along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockmart.llm import decontam, mixing, quality, simhash_dedup, token_table
from dockmart.llm.common import prepare, id_remainder, new_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.5 or more."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels, id_remainder(F.col("doc_id"), 3) != 1))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id."""
    prepare(spark)
    return simhash_dedup.keep_one_per_group(docs, shingle=3, max_bits=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (not at all, once, or twice)."""
    prepare(spark)
    return mixing.repeat_by_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token table of the mix, as read back from its files: doc_id, n_tokens, ids, start.

    Workers that have run the earlier stages hold memory already, so this stage's caches are smaller than the operator's.
    """
    prepare(spark)
    return token_table.token_table(docs, cache_parts=300_000, together=4 << 20)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: SQL can express neither the classifier nor the fingerprints; tests/llm compares with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

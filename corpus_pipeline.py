"""The corpus pipeline: stages over ``documents``, each written and read again.

Null and empty texts are clean documents with nothing in them and stay until they
are packed. Rows without a doc_id, or that repeat one, are documents of their own;
of equal texts one row stays. Further columns travel along until the last stage.
Texts of any length go through every stage whole; of near duplicates the smallest
doc_id stays, of rows tied in it the first as read. An empty table gives no piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagseek.llm import decontaminate, near_dedup, packing, pii, toxicity
from tagseek.session import settle


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents, and the column that tells their rows apart."""
    repeated = docs.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    if repeated.isEmpty():
        return docs, "doc_id"
    name = "row_key"
    while name in docs.columns:
        name += "_"
    return settle(docs.withColumn(name, F.monotonically_increasing_id()), "keyed"), name


def _texts(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), "text")


def _without(docs: DataFrame, key: str, gone: DataFrame, columns: list[str]) -> DataFrame:
    return docs.join(gone.select(F.col("doc_id").alias(key)), key, "left_anti").select(columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half stay."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates stays."""
    keyed, key = _keyed(docs)
    gone = near_dedup.groups(_texts(keyed, key)).where(~F.col("kept"))
    return _without(keyed, key, gone, docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    keyed, key = _keyed(docs)
    found = decontaminate.decontaminate(_texts(keyed, key), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(keyed, key, found.where("contaminated"), docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets."""
    return pii.mask(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenized pieces, with the sequence and offset of each."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("packing", pack),
]

#: Learned scores and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs

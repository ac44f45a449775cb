"""Rows that label models learn from: a bounded, repeatable sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept away from learning: crc32 of the id's text is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, target: str, max_rows: int) -> DataFrame:
    """(doc_id, text, y) of labelled documents outside the held-out fold.

    At most ``max_rows`` labels are taken, in the order of a hash of the id, so
    the sample is the same in every run and its broadcast is bounded. Labels
    repeated for one id vote; an even vote counts as 0, null labels do not count. Of
    rows that share an id one is learned from, the first by its text.
    """
    votes = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    votes = votes.groupBy("doc_id").agg((F.avg(F.col(target)) > 0.5).cast("int").alias("y"))
    chosen = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))

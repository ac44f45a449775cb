"""Saved keys of an index's words: what similar words share, and n-grams for patterns.

A field's table is made when first asked for, in folders by key bucket, sorted by key, so a
lookup opens few files. An appended index gets the keys of its new words only, as a
part beside the earlier ones. Parts are made known by one small write, as batches are;
a part may hold words that an earlier state of the index lacks, so whoever reads one
joins with its own vocabulary.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import deletion_keys
from ..sources.store import VOCABULARY, Index, dealt, probe, write_keys
from .postings import EXACT, SOUND, term_bucket

#: Edits that saved deletion keys allow for.
EDITS = 2
#: Longest n-gram of the pattern table; longer runs are looked up by all of theirs.
GRAM = 3

KEYS = "part string, field string, key_bucket int, key string, term string"
PARTS = "kind string, field string, version int, words string, part string"


def pattern_grams(term: Column) -> Column:
    """The distinct n-grams of a word, of one to ``GRAM`` letters."""

    def of_size(n: int) -> Column:
        places = F.when(F.length(term) >= n, F.sequence(F.lit(1), F.length(term) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(term, i, F.lit(n)))

    return F.array_distinct(F.concat(*[of_size(n) for n in range(1, GRAM + 1)]))


def run_grams(run: Column) -> Column:
    """Grams that every word holding ``run`` has: its longest ones the table knows."""
    size = F.least(F.length(run), F.lit(GRAM))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(run) - size + 1), lambda i: F.substring(run, i, size)))


KINDS = {"deletions": lambda term: deletion_keys(term, EDITS), "grams": pattern_grams}


def lexicon(index: Index, kind: str, fields: tuple[str, ...] = (EXACT, SOUND)) -> DataFrame:
    """(field, key_bucket, key, term): the saved keys of one kind, made as far as these fields lack them."""
    chain = [part for field in fields for part in _parts(index, kind, field)]
    saved = index.spark.read.schema(KEYS).parquet(f"{index.path}/{index.build_id}/lexicon/{kind}")
    return saved.where(F.col("part").isin(chain)).drop("part")


def _parts(index: Index, kind: str, field: str) -> list[str]:
    """The parts that hold the keys of one field; one more is made if words are missing."""
    spark, base = index.spark, f"{index.path}/{index.build_id}/lexicon"
    mine = (F.col("kind") == kind) & (F.col("field") == field)
    try:
        parts = spark.read.schema(PARTS).parquet(f"{base}/parts").where(mine).orderBy("version", "part").collect()
    except AnalysisException:
        parts = []
    known = {r["version"]: r for r in reversed(parts)}  # of several writers of one version the first by name
    newest = known[max(known)] if known else None
    if newest is not None and newest["version"] >= index.version:
        return [r["part"] for r in known.values()]
    words = index.vocabulary.where(F.col("field") == field).select("term")
    if newest is not None:
        earlier = spark.read.schema(VOCABULARY).parquet(f"{index.path}/{index.build_id}/{newest['words']}")
        words = words.join(earlier.where(F.col("field") == field).select("term"), "term", "left_anti")
    part = uuid.uuid4().hex[:12]
    keyed = dealt(words).select("term", F.explode(KINDS[kind](F.col("term"))).alias("key"))
    keyed = keyed.withColumn("key_bucket", term_bucket(F.col("key"), index.term_buckets))
    write_keys(keyed, f"{base}/{kind}/part={part}/field={field}", "key_bucket", "key", index.term_buckets)
    row = spark.createDataFrame([(kind, field, index.version, index.words, part)], PARTS)
    row.coalesce(1).write.mode("append").parquet(f"{base}/parts")
    return _parts(index, kind, field)


def words_of(index: Index, field: str, kind: str, asked: DataFrame) -> DataFrame:
    """asked(key, …) met with the saved keys: its columns and ``term``; repeated where keys are."""
    table = lexicon(index, kind, (field,)).where(F.col("field") == field).drop("field")
    keyed = asked.withColumn("key_bucket", term_bucket(F.col("key"), index.term_buckets))
    return probe(table, keyed, ["key_bucket", "key"]).drop("key_bucket")

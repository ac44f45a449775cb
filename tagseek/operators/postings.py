"""Text to postings, vocabularies and corpus statistics.

Postings hold one row per (field, term, record): how long the record is and
where the term stands in it. ``field`` is ``exact`` (lower-cased words) or
``sound`` (sound codes).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.inverted import bare, listed, postings
from ..functions.sound import codes_of, sound_codes
from ..functions.tokens import cased_words, cased_words_and_hyphens, lowered_as_a_whole, raw_words, words, words_and_hyphens

EXACT, SOUND = "exact", "sound"


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_postings(documents: DataFrame, fields: tuple[str, ...] = (EXACT,), lowercase_sounds: bool = False) -> DataFrame:
    """documents(doc_id, text) → (field, term, doc_id, dl, freq, positions, hyphens).

    Narrow from end to end: each record becomes its postings within one task. Every
    text is split into words once for all fields asked for; lower case and sound codes
    are worked out for a batch's distinct words.
    """
    docs = documents.select("doc_id", "text").where(F.col("text").isNotNull())
    text, none = F.col("text"), F.lit(None).cast("array<string>")
    if SOUND not in fields or lowercase_sounds:
        tokens, lowered = words_and_hyphens(text), none
    elif EXACT not in fields:
        tokens, lowered = cased_words(text), none
    else:
        tokens, lowered = cased_words_and_hyphens(text), F.when(lowered_as_a_whole(text), words_and_hyphens(text))
    cased = tuple(fields) != (EXACT,) and not lowercase_sounds

    def lower(spelled: pa.Array) -> pa.Array:
        return pa.array([w.lower() for w in listed(bare(spelled))], pa.string()) if cased else bare(spelled)

    def sounds(spelled: pa.Array) -> pa.Array:
        return codes_of(bare(spelled))

    how = {EXACT: (EXACT, lower, True), SOUND: (SOUND, sounds, False)}

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = batch["lowered"].is_valid()
            if not pc.any(apart).as_py():
                yield from postings(batch["doc_id"], batch["tokens"], [how[f] for f in fields])
                continue
            usual, rare = batch.filter(pc.invert(apart)), batch.filter(apart)
            yield from postings(usual["doc_id"], usual["tokens"], [how[f] for f in fields])
            yield from postings(rare["doc_id"], rare["lowered"], [(EXACT, bare, True)])
            yield from postings(rare["doc_id"], rare["tokens"], [how[SOUND]])

    entries.__name__ = "_and_".join({EXACT: "word", SOUND: "sound"}[f] for f in fields) + "_entries"  # shown in plans
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"field string, term string, doc_id {kind}, dl int, freq int, positions array<int>, hyphens array<int>"
    return docs.select("doc_id", tokens.alias("tokens"), lowered.alias("lowered")).mapInArrow(entries, schema)


def build_phonetic_postings(documents: DataFrame, lowercase: bool = False) -> DataFrame:
    """Postings of sound codes only. Words keep their case unless asked, which
    matters solely for words without a code, since those stand for themselves."""
    return build_postings(documents, (SOUND,), lowercase_sounds=lowercase)


def flat_postings(postings: DataFrame) -> DataFrame:
    """(term, doc_id, pos): one row per word in the text."""
    return postings.select("term", "doc_id", F.explode("positions").alias("pos"))


def vocabulary(postings: DataFrame) -> DataFrame:
    """(field, term, df, cf): records holding the term, and its occurrences.

    Postings are already one row per record, so plain sums do; partial sums
    shrink a frequent term to one row per task before the shuffle.
    """
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("freq").cast("bigint").alias("cf")
    )


def doc_lengths(documents: DataFrame) -> DataFrame:
    """(doc_id, dl) of records that have words."""
    return documents.select("doc_id", F.size(words(F.col("text"))).alias("dl")).where(F.col("dl") > 0)


def corpus_stats(lengths: DataFrame) -> DataFrame:
    """One row (n_docs, n_tokens, avgdl) over the records that have words."""
    return lengths.where(F.col("dl") > 0).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("dl"), F.lit(0)).cast("bigint").alias("n_tokens"),
        F.coalesce(F.avg("dl"), F.lit(0.0)).alias("avgdl"),
    )


def tokenize_queries(queries: DataFrame) -> DataFrame:
    """(query_id, slot, term) for each word of each phrase."""
    return queries.select("query_id", F.posexplode(words(F.col("phrase"))).alias("slot", "term"))


def phonetic_query_tokens(queries: DataFrame) -> DataFrame:
    """(query_id, slot, term) with sound codes as terms."""
    codes = queries.withColumn("codes", sound_codes(cased_words(F.col("phrase"))))
    return codes.select("query_id", F.posexplode("codes").alias("slot", "term"))


def analyzed_queries(queries: DataFrame) -> DataFrame:
    """Queries with their analysed words, sound codes and raw words as arrays."""
    return queries.select(
        "query_id",
        "phrase",
        words(F.col("phrase")).alias("tokens"),
        sound_codes(cased_words(F.col("phrase"))).alias("codes"),
        raw_words(F.col("phrase")).alias("raw"),
    )

"""Whole searches over a query table: exact, phonetic, and the full report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clauses import expand_queries
from ..operators.match import match_clauses
from ..operators.postings import EXACT, SOUND
from ..operators.rank import best_hits, combine, hit_details, merge_scores, rank_tags, significant, tag_scores, totals_of
from ..operators.spelling import suggest_phrases
from ..params import SearchParams
from ..session import settle
from ..sources.store import Index


@dataclass
class Outcome:
    """One search's results, a table each, over all its queries."""

    hits: DataFrame  # query_id, doc_id, score, rank, total_hits
    tags: DataFrame  # query_id, bookmark_tag, score, first_rank
    totals: DataFrame  # query_id, total_hits (queries without hits included)
    index: Index

    def details(self, *more: str) -> DataFrame:
        return hit_details(self.hits, self.index.documents, *more, buckets=self.index.doc_buckets)


def _search(queries: DataFrame, index: Index, fields: tuple[str, ...], params: SearchParams) -> list[Outcome]:
    """An outcome per field, from one pass over the postings of all of them.

    Until its hits are known, a query goes by its field and its id.
    """
    parts = [expand_queries(queries, field, params).withColumn("field", F.lit(field)) for field in fields]
    clauses = reduce(DataFrame.unionByName, parts).withColumn("query_id", F.struct("field", "query_id"))
    found = combine(match_clauses(clauses, index, params=params), params.min_should_match)
    # At most max_search rows per query: small enough to keep and reuse.
    hits = settle(best_hits(found, params.max_search), "hits")
    tags = tag_scores(hits, index.documents, index.doc_buckets)
    if len(fields) > 1:  # records are looked up once for all fields
        tags = settle(tags, "tags")
    outcomes = []
    for field in fields:
        own_hits, own_tags = (
            t.where(F.col("query_id.field") == field).withColumn("query_id", F.col("query_id.query_id")) for t in (hits, tags)
        )
        outcomes.append(Outcome(own_hits, own_tags, totals_of(own_hits, queries), index))
    return outcomes


def exact_search(queries: DataFrame, index: Index, params: SearchParams = SearchParams()) -> Outcome:
    """queries(query_id, phrase) against the words as written."""
    return _search(queries, index, (EXACT,), params)[0]


def phonetic_search(queries: DataFrame, index: Index, params: SearchParams = SearchParams()) -> Outcome:
    """queries(query_id, phrase) against the words' sounds."""
    return _search(queries, index, (SOUND,), params)[0]


@dataclass
class Fallback:
    tags: DataFrame  # query_id, bookmark_tag, score, source_order, first_rank
    totals: DataFrame  # query_id, total_hits
    suggestions: DataFrame  # query_id, place, suggestion
    each: Outcome | None = None  # what each suggestion found, under it as query_id; None if there was nothing to suggest


def fallback_search(
    queries: DataFrame,
    totals: DataFrame,
    index: Index,
    params: SearchParams = SearchParams(),
    suggestions: DataFrame | None = None,
) -> Fallback:
    """Search re-spelled phrases for the queries with fewer than
    ``fallback_below`` hits. A phrase suggested for several queries is searched
    once, and its result joined back to each of them.
    """
    few = totals.where(F.col("total_hits") < params.fallback_below).select("query_id")
    scarce = queries.join(few, "query_id", "left_semi")
    if few.isEmpty():  # every query has hits enough: nothing to suggest or search
        return Fallback(
            totals.sparkSession.createDataFrame([], "query_id bigint, bookmark_tag string, score double, source_order int, first_rank int"),
            totals.where(F.lit(False)),
            totals.sparkSession.createDataFrame([], "query_id bigint, place int, suggestion string"),
        )
    if suggestions is None:
        suggestions = settle(suggest_phrases(scarce, index, params), "suggestions")
    else:
        suggestions = suggestions.join(few, "query_id", "left_semi")
    phrases = suggestions.select(F.col("suggestion").alias("query_id"), F.col("suggestion").alias("phrase")).distinct()
    found = exact_search(phrases, index, params)
    tags = found.tags.withColumnRenamed("query_id", "suggestion").join(suggestions, "suggestion")
    counts = found.totals.withColumnRenamed("query_id", "suggestion").join(suggestions, "suggestion")
    return Fallback(
        tags.select("query_id", "bookmark_tag", "score", (F.col("place") + 1).alias("source_order"), "first_rank"),
        counts.groupBy("query_id").agg(F.sum("total_hits").cast("bigint").alias("total_hits")),
        suggestions,
        found,
    )


@dataclass
class Report:
    """The full search: what is reported, and what led to it."""

    tags: DataFrame  # query_id, place, bookmark_tag, score, total_hits
    totals: DataFrame
    exact: Outcome
    phonetic: Outcome
    fallback: Fallback


def search(queries: DataFrame, index: Index, params: SearchParams = SearchParams()) -> Report:
    """Exact and phonetic results added up, suggestions where hits are scarce,
    tags ranked by total score for queries with enough hits."""
    queries = settle(queries.select("query_id", "phrase"), "queries")
    exact, phonetic = _search(queries, index, (EXACT, SOUND), params)
    first = _added(exact.totals, phonetic.totals)
    fallback = fallback_search(queries, first, index, params)
    totals = _added(first, fallback.totals)
    merged = merge_scores(exact.tags, phonetic.tags, fallback.tags)
    reported = significant(rank_tags(merged), totals, params.min_occur)
    return Report(
        reported.select("query_id", "place", "bookmark_tag", "score", "total_hits"), totals, exact, phonetic, fallback
    )


def _added(*totals: DataFrame) -> DataFrame:
    united = totals[0]
    for more in totals[1:]:
        united = united.unionByName(more)
    return united.groupBy("query_id").agg(F.sum("total_hits").cast("bigint").alias("total_hits"))

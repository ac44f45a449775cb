"""Combining clause hits, limits per query, scores per tag, final ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from ..functions.scoring import saturation
from ..sources.store import Index, lookup


def bm25(freqs: DataFrame, stats: DataFrame, doc_lengths: DataFrame | None = None) -> DataFrame:
    """freqs(query_id, doc_id, freq, idf[, boost, dl]) → the same with ``score``.

    ``stats`` is the one-row table of ``corpus_stats``. Lengths are taken from
    ``doc_lengths`` unless the rows carry them, as index postings do.
    """
    avgdl = stats.first()["avgdl"]
    if doc_lengths is not None:
        freqs = freqs.join(doc_lengths, "doc_id")
    boost = F.col("boost") if "boost" in freqs.columns else F.lit(1.0)
    return freqs.withColumn("score", boost * F.col("idf") * saturation(F.col("freq"), F.col("dl"), avgdl))


def boosted(clause_hits: DataFrame, weights: dict[str, float], kind: str = "kind") -> DataFrame:
    """Multiply each hit's score by the weight of its clause kind."""
    weight = F.coalesce(*[F.when(F.col(kind) == name, F.lit(float(w))) for name, w in weights.items()], F.lit(1.0))
    return clause_hits.withColumn("score", F.col("score") * weight)


def combine(clause_hits: DataFrame, min_should_match: int = 1) -> DataFrame:
    """Clause hits(query_id, clause, doc_id, score) → (query_id, doc_id, score).

    A record scores the sum of its matching clauses and must match at least
    ``min_should_match`` of them; 0 acts as 1. Each clause names a record once.
    """
    summed = clause_hits.groupBy("query_id", "doc_id").agg(
        F.round(F.sum("score"), 6).alias("score"), F.count(F.lit(1)).alias("matched")
    )
    return summed.where(F.col("matched") >= max(1, min_should_match)).drop("matched")


def top_per_key(rows: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key; the planner cuts per task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= n).drop("place")


def top_n(hits: DataFrame, n: int) -> DataFrame:
    """Best ``n`` hits per query, ties in record order, with ``rank`` and
    ``total_hits``, the number of hits before the cut; for hits that are written
    already, since it reads them twice.

    The planner cuts each task's rows before it shuffles them, and totals are sums
    of each task's counts, so no task holds all hits of one frequent query.
    """
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())))
    return ranked.where(F.col("rank") <= n).join(total_hits(hits), "query_id").select("query_id", "doc_id", "score", "rank", "total_hits")


def best_hits(hits: DataFrame, n: int) -> DataFrame:
    """What ``top_n`` gives, from one pass over hits(query_id, doc_id bigint, score).

    Each task keeps a query's best ``n`` hits and its count together, so the shuffle
    carries at most that much per task and query.
    """
    # the largest come first: of equal scores the smallest doc_id, whose complement is largest
    order = F.struct("score", F.bitwise_not("doc_id").alias("behind"))
    kept = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("total_hits"), InternalFunction.collect_top_k(order, n, False).alias("best"))
    rows = kept.select("query_id", "total_hits", F.posexplode("best").alias("at", "hit"))
    return rows.select("query_id", F.bitwise_not("hit.behind").alias("doc_id"), "hit.score", (F.col("at") + 1).alias("rank"), "total_hits")


def total_hits(hits: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """(query_id, total_hits); with ``queries``, those without hits count 0."""
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("total_hits"))
    return counts if queries is None else _all_queries(queries, counts)


def totals_of(top: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """``total_hits`` read off the rows of ``top_n``, which carry it."""
    counts = top.groupBy("query_id").agg(F.max("total_hits").alias("total_hits"))
    return counts if queries is None else _all_queries(queries, counts)


def _all_queries(queries: DataFrame, counts: DataFrame) -> DataFrame:
    full = queries.select("query_id").join(counts, "query_id", "left")
    return full.select("query_id", F.coalesce("total_hits", F.lit(0)).cast("bigint").alias("total_hits"))


def with_documents(top: DataFrame, documents: DataFrame, *columns: str, buckets: int | None = None) -> DataFrame:
    """Add columns of the records hit; few hits open few buckets only, and no record
    moves if ``buckets`` tells how many the documents lie in."""
    return lookup(documents.select("doc_id", *columns), top, buckets)


def tag_scores(top: DataFrame, documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """Top hits → (query_id, bookmark_tag, score, first_rank): the sum of scores
    per tag, and the rank of its first hit. Records without a tag are left out."""
    tagged = with_documents(top, documents, "bookmark_tag", buckets=buckets).where(F.col("bookmark_tag").isNotNull())
    return tagged.groupBy("query_id", "bookmark_tag").agg(
        F.round(F.sum("score"), 6).alias("score"), F.min("rank").alias("first_rank")
    )


def hit_details(top: DataFrame, documents: DataFrame, *more: str, buckets: int | None = None) -> DataFrame:
    """Top hits with the text and its times; a missing time shows as ``?``.

    ``more``: further columns of the records, e.g. ``filename`` or ``fields``.
    """
    found = with_documents(top, documents, "start", "end", "text", *more, buckets=buckets)
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in ("start", "end")}
    return found.withColumns(shown).select("query_id", "rank", "doc_id", "score", "start", "end", "text", *more)


def merge_scores(*sets: DataFrame) -> DataFrame:
    """Add up equal tags across result sets, in the order the sets are given.

    ``source_order`` and ``first_rank`` keep where each tag was first seen.
    """
    united = None
    for order, scores in enumerate(sets):
        if "source_order" not in scores.columns:
            scores = scores.withColumn("source_order", F.lit(order))
        scores = scores.select("query_id", "bookmark_tag", "score", "source_order", "first_rank")
        united = scores if united is None else united.unionByName(scores)
    seen = F.min(F.struct("source_order", "first_rank"))
    return (
        united.groupBy("query_id", "bookmark_tag")
        .agg(F.round(F.sum("score"), 6).alias("score"), seen.alias("seen"))
        .select("query_id", "bookmark_tag", "score", "seen.source_order", "seen.first_rank")
    )


def rank_tags(merged: DataFrame) -> DataFrame:
    """Tags by total score, ties in the order first seen, with ``place``.

    A query has at most ``max_search`` tags per result set, so the window is
    small however many records matched.
    """
    order = [F.col("score").desc(), F.col("source_order").asc(), F.col("first_rank").asc()]
    return merged.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))


def significant(ranked: DataFrame, totals: DataFrame, min_occur: int = 2) -> DataFrame:
    """Keep queries with more than ``min_occur`` hits in total."""
    enough = totals.where(F.col("total_hits") > min_occur).select("query_id", "total_hits")
    return ranked.join(enough, "query_id")


def index_scored(freqs: DataFrame, index: Index) -> DataFrame:
    """BM25 with an opened index's corpus numbers; nothing is read for it."""
    boost = F.col("boost") if "boost" in freqs.columns else F.lit(1.0)
    return freqs.withColumn(
        "score", boost * F.col("idf") * saturation(F.col("freq"), F.col("dl"), index.avg_length)
    )

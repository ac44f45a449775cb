"""

``queries()`` runs the library; ``oracle_sql()`` says the same in plain SQL.
Searches read an index that Spark builds from the given tables once per
session, as a user would.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.inputs import (  # noqa: E402
    benchmark_patterns,
    benchmark_runs,
    benchmark_words,
    corpus,
    corpus_index,
    query_table,
    table,
    transcript_files,
    transcript_index,
    transcript_json,
)
from checks.oracles import ORACLES  # noqa: E402
from tagseek.functions.scoring import idf  # noqa: E402
from tagseek.operators import clauses, match, postings, rank, spelling  # noqa: E402
from tagseek.params import SearchParams  # noqa: E402
from tagseek.plans import search as plans  # noqa: E402
from tagseek.session import settle  # noqa: E402
from tagseek.sources import json_tree, store  # noqa: E402

# Slop 0 gives whole searches a closed form that SQL can state.
STRICT = SearchParams(slop=0)


def entry(spark: SparkSession) -> DataFrame:
    """Top tags of a few phrases over the smallest corpus."""
    sf_dir = "/root/testdata/sf0.001"
    found = plans.exact_search(query_table(spark, "exact"), corpus_index(spark, sf_dir), STRICT)
    return found.tags


# --- sources and sinks ---------------------------------------------------------


def json_file_scan(spark, sf_dir):
    nodes = json_tree.flatten_json(json_tree.read_json_files(spark, transcript_files(spark, sf_dir)))
    typed = json_tree.typed_fields(
        nodes, {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    )
    # where a record came from: the file's own name, and how many turns that file holds
    said = typed.where(F.col("text").isNotNull())
    named = F.col("filename").endswith(".json") & F.col("filepath").endswith(F.concat(F.lit("/"), "filename"))
    held = said.groupBy("filepath").agg(F.count(F.lit(1)).alias("file_turns"))
    return said.join(held, "filepath").select("conv_id", "turn", "role", "text", named.alias("named"), "file_turns")


def json_flatten(spark, sf_dir):
    nodes = json_tree.flatten_json(transcript_json(spark, sf_dir))
    return nodes.select(
        "filename",
        "depth",
        F.array_join(F.transform("path", lambda p: p.cast("string")), ".").alias("path"),
        F.try_variant_get("fields", "$.text", "string").alias("text"),
        F.try_variant_get("fields", "$.role", "string").alias("role"),
    )


def json_file_tag(spark, sf_dir):
    tagged = json_tree.tag_files(json_tree.flatten_json(transcript_json(spark, sf_dir)))
    return tagged.groupBy("filepath", "bookmark_tag").agg(F.count(F.lit(1)).alias("records"))


def json_typed_fields(spark, sf_dir):
    props = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("filename"), F.col("event_type").alias("filepath"), F.col("props").alias("value")
    )
    found = json_tree.typed_fields(json_tree.flatten_json(props))
    turns = json_tree.typed_fields(json_tree.flatten_json(transcript_json(spark, sf_dir)))
    return found.unionByName(turns).select("filename", "depth", "field", "type", "value")


def index_roundtrip(spark, sf_dir):
    index = transcript_index(spark, sf_dir)
    return index.vocabulary.where(F.col("field") == "exact").select("term", "df", "cf")


def index_postings(spark, sf_dir):
    """Every posting of the index that was saved in two batches."""
    words = transcript_index(spark, sf_dir).postings.where(F.col("field") == "exact")
    return words.select("term", "doc_id", F.col("dl").cast("bigint").alias("dl"), F.array_join("positions", " ").alias("places"))


def index_stats(spark, sf_dir):
    return store.index_stats(corpus_index(spark, sf_dir))


# --- text analysis ---------------------------------------------------------------


def exact_postings(spark, sf_dir):
    flat = postings.flat_postings(postings.build_postings(corpus(spark, sf_dir)))
    return flat.select("term", "doc_id", F.col("pos").cast("bigint").alias("pos"))


def phonetic_postings(spark, sf_dir):
    flat = postings.flat_postings(postings.build_phonetic_postings(corpus(spark, sf_dir)))
    return flat.select("term", "doc_id", F.col("pos").cast("bigint").alias("pos"))


def vocabulary(spark, sf_dir):
    return postings.vocabulary(postings.build_postings(corpus(spark, sf_dir))).select("term", "df", "cf")


def corpus_stats(spark, sf_dir):
    stats = postings.corpus_stats(postings.doc_lengths(corpus(spark, sf_dir)))
    return stats.select("n_docs", "n_tokens", F.round("avgdl", 6).alias("avgdl"))


def query_tokens(spark, sf_dir):
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("phrase"))
    found = postings.tokenize_queries(asked)
    return found.select("query_id", F.col("slot").cast("bigint").alias("slot"), "term")


# --- match clauses -----------------------------------------------------------------


def _freqs(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "doc_id", F.col("freq").cast("bigint").alias("freq"))


def _scores(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "doc_id", F.round("score", 6).alias("score"))


def _matcher(name: str, matcher: Callable, shape: Callable) -> Callable:
    def run(spark, sf_dir):
        return shape(matcher(query_table(spark, name), corpus_index(spark, sf_dir)))

    return run


def many_terms(spark, sf_dir):
    """A query for every word of the benchmark."""
    return _freqs(match.match_term(benchmark_words(spark, sf_dir), _spelled(spark, sf_dir)))


def many_phrases(spark, sf_dir):
    """A query for every three neighbours of the benchmark."""
    return _freqs(match.match_phrase(benchmark_runs(spark, sf_dir, 3), corpus_index(spark, sf_dir)))


def every_phrase(spark, sf_dir):
    """A query for every pair of neighbours of the benchmark."""
    return _freqs(match.match_phrase(benchmark_runs(spark, sf_dir), corpus_index(spark, sf_dir)))


def many_prefixes(spark, sf_dir):
    """A search for the beginning of every longer word of the benchmark."""
    return _scores(match.match_prefix(benchmark_patterns(spark, sf_dir), corpus_index(spark, sf_dir)))


def many_glued(spark, sf_dir):
    """Every pair of neighbours of the benchmark, written as one word."""
    return _freqs(match.match_glued(benchmark_runs(spark, sf_dir), corpus_index(spark, sf_dir)))


def _benchmark_best(spark, sf_dir) -> DataFrame:
    """The ten best records of every pair of neighbours of the benchmark."""
    hits = match.match_phrase(benchmark_runs(spark, sf_dir), corpus_index(spark, sf_dir))
    return settle(rank.best_hits(rank.combine(hits), 10), "best")


def many_top_hits(spark, sf_dir):
    best = _benchmark_best(spark, sf_dir)
    return best.select("query_id", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"), "total_hits")


def many_tag_scores(spark, sf_dir):
    index = corpus_index(spark, sf_dir)
    found = rank.tag_scores(_benchmark_best(spark, sf_dir), index.documents, index.doc_buckets)
    return found.select("query_id", "bookmark_tag", "score", F.col("first_rank").cast("bigint").alias("first_rank"))


def many_hit_details(spark, sf_dir):
    index = corpus_index(spark, sf_dir)
    found = rank.hit_details(_benchmark_best(spark, sf_dir), index.documents, buckets=index.doc_buckets)
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score", "start", "end", "text")


def phrase_sloppy(spark, sf_dir):
    found = match.match_phrase(query_table(spark, "phrase_sloppy"), corpus_index(spark, sf_dir), slop=2, width=True)
    return found.select("query_id", "doc_id", F.col("width").cast("bigint").alias("width"))


def sloppy_scores(spark, sf_dir):
    found = match.match_phrase(query_table(spark, "phrase_sloppy"), corpus_index(spark, sf_dir), slop=2, width=True)
    return found.select("query_id", "doc_id", F.col("width").cast("bigint").alias("width"), F.round("freq", 6).alias("freq"), F.round("score", 6).alias("score"))


def boosted_scores(spark, sf_dir):
    index = corpus_index(spark, sf_dir)
    exact = match.match_phrase(query_table(spark, "phrase_exact"), index).withColumn("kind", F.lit("exact"))
    start = match.match_prefix(query_table(spark, "prefix_match"), index).withColumn("kind", F.lit("prefix"))
    weighted = rank.boosted(exact.unionByName(start), clauses.clause_weights(SearchParams()))
    return weighted.select("kind", "query_id", "doc_id", F.round("score", 6).alias("score"))


def clause_plan(spark, sf_dir):
    # every benchmark text is a query too, so the work follows the tables
    asked = query_table(spark, "clauses").unionByName(
        table(spark, sf_dir, "benchmark").select((F.col("item_id") + 1000).alias("query_id"), F.col("text").alias("phrase"))
    )
    found = clauses.expand_queries(asked)
    return found.select("query_id", "clause", F.array_join("words", " ").alias("words"), "boost")


def _clause_hits(spark, sf_dir) -> DataFrame:
    asked = clauses.expand_queries(query_table(spark, "exact"), params=STRICT)
    return match.match_clauses(asked, corpus_index(spark, sf_dir), params=STRICT)


def boolean_or(spark, sf_dir):
    return rank.combine(_clause_hits(spark, sf_dir), min_should_match=2)


# --- ranking -------------------------------------------------------------------------


def _found(spark, sf_dir) -> DataFrame:
    return rank.combine(_clause_hits(spark, sf_dir))


def bm25_rank(spark, sf_dir):
    """From raw tables, without an index: every word of every text scored."""
    docs = corpus(spark, sf_dir)
    # split and inverted once; of a record's postings, one holds place 0
    entries = postings.build_postings(docs).select("field", "term", "doc_id", "dl", "freq", (F.get("positions", F.lit(0)) == 0).alias("first"))
    inverted = settle(entries, "inverted")
    stats = settle(postings.corpus_stats(inverted.where("first")), "stats")
    asked = postings.tokenize_queries(query_table(spark, "term_match"))
    df = postings.vocabulary(inverted).join(asked, "term").select("term", "df", "query_id")
    wanted = settle(df.withColumn("idf", idf(stats.first()["n_docs"], F.col("df"))), "wanted")
    freqs = inverted.join(wanted, "term")
    return _scores(rank.bm25(freqs, stats))


def top_n_hits(spark, sf_dir):
    top = rank.best_hits(_found(spark, sf_dir), 10)
    return top.select("query_id", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


def total_hits(spark, sf_dir):
    return rank.total_hits(_found(spark, sf_dir), query_table(spark, "exact"))


def tag_scores(spark, sf_dir):
    index = corpus_index(spark, sf_dir)
    top = settle(rank.best_hits(_found(spark, sf_dir), 10), "top")
    found = rank.tag_scores(top, index.documents, index.doc_buckets)
    return found.select("query_id", "bookmark_tag", "score", F.col("first_rank").cast("bigint").alias("first_rank"))


def hit_details(spark, sf_dir):
    found = plans.exact_search(query_table(spark, "details"), transcript_index(spark, sf_dir), STRICT)
    return found.details().withColumn("rank", F.col("rank").cast("bigint"))


def _tag_sets(spark, sf_dir) -> list[DataFrame]:
    """Tags of two different clauses of the same queries."""
    hits = settle(_clause_hits(spark, sf_dir), "clause_hits")
    index = corpus_index(spark, sf_dir)
    sets = []
    for name in ("phrase", "wildcard"):
        top = settle(rank.best_hits(rank.combine(hits.where(F.col("clause") == name)), 10), "top")
        sets.append(rank.tag_scores(top, index.documents, index.doc_buckets))
    return sets


def merge_scores(spark, sf_dir):
    merged = rank.merge_scores(*_tag_sets(spark, sf_dir))
    return merged.select("query_id", "bookmark_tag", "score")


def final_ranking(spark, sf_dir):
    ranked = rank.rank_tags(rank.merge_scores(*_tag_sets(spark, sf_dir)))
    return ranked.select("query_id", "bookmark_tag", "score", F.col("place").cast("bigint").alias("place"))


def significant_tags(spark, sf_dir):
    found = plans.exact_search(query_table(spark, "exact"), corpus_index(spark, sf_dir), STRICT)
    ranked = rank.rank_tags(rank.merge_scores(found.tags))
    kept = rank.significant(ranked, found.totals, min_occur=100)
    return kept.select("query_id", "bookmark_tag", "score", F.col("place").cast("bigint").alias("place"), "total_hits")


# --- spelling ----------------------------------------------------------------------------


def _spelled(spark, sf_dir) -> store.Index:
    """Spelling, and searches of words alone, read no sounds: none are worked out for them."""
    return corpus_index(spark, sf_dir, (postings.EXACT,))


def _words(spark) -> DataFrame:
    return postings.tokenize_queries(query_table(spark, "spelling")).select(F.col("term").alias("word")).distinct()


def _options(spark, sf_dir) -> DataFrame:
    index = _spelled(spark, sf_dir)
    asked = query_table(spark, "spelling")
    everything = _words(spark).unionByName(spelling.compound_forms(asked).select("word")).distinct()
    return spelling.word_options(everything, index, spelling.build_dictionary(index))


def spell_dictionary(spark, sf_dir):
    made = spelling.build_dictionary(_spelled(spark, sf_dir))
    return made.select(F.length("gram").cast("bigint").alias("n"), "gram", "term")


def spell_known(spark, sf_dir):
    return spelling.known_words(_words(spark), _spelled(spark, sf_dir))


def spell_suggest(spark, sf_dir):
    index = _spelled(spark, sf_dir)
    found = spelling.suggest_similar(_words(spark), spelling.build_dictionary(index), 2, index.term_buckets, index)
    return found.withColumn("place", F.col("place").cast("bigint"))


def spell_options(spark, sf_dir):
    found = spelling.term_options(query_table(spark, "spelling"), _options(spark, sf_dir))
    return found.select("query_id", F.col("slot").cast("bigint").alias("slot"), F.array_join("choices", " ").alias("choices"))


def spell_phrases(spark, sf_dir):
    choices = spelling.term_options(query_table(spark, "spelling"), _options(spark, sf_dir))
    found = spelling.combine_options(choices, 5)
    return found.withColumn("place", F.col("place").cast("bigint"))


def spell_compounds(spark, sf_dir):
    found = spelling.compound_suggestions(query_table(spark, "spelling"), _options(spark, sf_dir))
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("form", "place")})


def spell_final(spark, sf_dir):
    found = spelling.suggest_phrases(query_table(spark, "spelling"), _spelled(spark, sf_dir))
    return found.withColumn("place", F.col("place").cast("bigint"))


def fallback_search(spark, sf_dir):
    index, asked = _spelled(spark, sf_dir), query_table(spark, "spelling")
    found = plans.exact_search(asked, index, STRICT)
    again = plans.fallback_search(asked, found.totals, index, STRICT)
    merged = rank.merge_scores(again.tags)
    return merged.select("query_id", "bookmark_tag", "score")


# --- whole searches -------------------------------------------------------------------------


def exact_search(spark, sf_dir):
    found = plans.exact_search(query_table(spark, "exact"), corpus_index(spark, sf_dir), STRICT)
    return _with_totals(found)


def exact_search_slop2(spark, sf_dir):
    """At the default settings: words may stand two moves apart."""
    return _with_totals(plans.exact_search(query_table(spark, "exact"), corpus_index(spark, sf_dir)))


def phonetic_search(spark, sf_dir):
    found = plans.phonetic_search(query_table(spark, "phonetic"), corpus_index(spark, sf_dir), STRICT)
    return _with_totals(found)


def phonetic_search_slop2(spark, sf_dir):
    return _with_totals(plans.phonetic_search(query_table(spark, "phonetic"), corpus_index(spark, sf_dir)))


def _with_totals(found: plans.Outcome) -> DataFrame:
    tags = found.tags.select("query_id", "bookmark_tag", "score", F.col("first_rank").cast("bigint").alias("first_rank"))
    return tags.join(found.totals, "query_id")


def full_search(spark, sf_dir):
    report = plans.search(query_table(spark, "full"), corpus_index(spark, sf_dir), STRICT)
    return report.tags.withColumn("place", F.col("place").cast("bigint"))


def full_search_slop2(spark, sf_dir):
    report = plans.search(query_table(spark, "full"), corpus_index(spark, sf_dir))
    return report.tags.withColumn("place", F.col("place").cast("bigint"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, sf_dir)."""
    named = {
        f.__name__: f
        for f in (
            json_file_scan, json_flatten, json_file_tag, json_typed_fields, index_roundtrip, index_postings, index_stats,
            exact_postings, phonetic_postings, vocabulary, corpus_stats, query_tokens,
            many_terms, many_phrases, every_phrase, many_prefixes, many_glued, many_top_hits, many_tag_scores, many_hit_details, phrase_sloppy, sloppy_scores, boosted_scores, clause_plan, boolean_or,
            bm25_rank, top_n_hits, total_hits, tag_scores, hit_details, merge_scores, final_ranking, significant_tags,
            spell_dictionary, spell_known, spell_suggest, spell_options, spell_phrases, spell_compounds, spell_final,
            fallback_search, exact_search, exact_search_slop2, phonetic_search, phonetic_search_slop2, full_search, full_search_slop2,
        )
    }
    matchers = {
        "term_match": (match.match_term, _freqs),
        "phrase_exact": (match.match_phrase, _freqs),
        "phonetic_phrase": (match.match_phonetic, _freqs),
        "prefix_match": (match.match_prefix, _scores),
        "wildcard_match": (match.match_wildcard, _scores),
        "wildcard_phrase": (match.match_wildcard_phrase, _scores),
        "fuzzy_match": (match.match_fuzzy, _scores),
        "glued_match": (match.match_glued, _freqs),
        "hyphen_match": (match.match_hyphenated, _freqs),
    }
    return named | {name: _matcher(name, *parts) for name, parts in matchers.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, worked out from the raw tables."""
    return ORACLES | _training_data()[1]


def _training_data() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the training-data operators, where that subpackage is installed."""
    try:
        import corpus_pipeline
        from tagseek.llm import queries as training
    except ImportError:
        return {}, {}
    sql = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return training.QUERIES | {"pipeline": corpus_pipeline.run}, training.ORACLES | sql

"""Re-spelled phrases from the corpus vocabulary."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distance import deletion_keys
from ..params import GRAM_SIZES, MIN_SIMILARITY, MIN_WORD, SearchParams
from ..session import settle
from ..sources.store import Index, dealt, probe, write_keys
from .lexicon import EDITS, words_of
from .postings import EXACT, analyzed_queries, term_bucket

DICTIONARY = "gram_bucket int, gram string, term string, df bigint"


def _sizes(word: Column) -> tuple[Column, Column]:
    """Smallest and largest n-gram used for a word of this length."""
    low = high = None
    for longest, small, large in GRAM_SIZES:
        if longest is None:
            low, high = low.otherwise(small), high.otherwise(large)
        elif low is None:
            low, high = F.when(F.length(word) <= longest, small), F.when(F.length(word) <= longest, large)
        else:
            low, high = low.when(F.length(word) <= longest, small), high.when(F.length(word) <= longest, large)
    return low, high


def grams(word: Column) -> Column:
    """The word's distinct n-grams, of the two sizes its length calls for."""
    low, high = _sizes(word)

    def of_size(n: Column) -> Column:
        # a one-letter word has no grams of size two
        places = F.when(F.length(word) >= n, F.sequence(F.lit(1), F.length(word) - n + 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(places, lambda i: F.substring(word, i, n))

    return F.array_distinct(F.concat(of_size(low), of_size(high)))


def dictionary_of(vocabulary: DataFrame, min_word: int = MIN_WORD) -> DataFrame:
    """vocabulary(term, df) → (n, gram, term, df) for words long enough."""
    words = vocabulary.where(F.length("term") >= min_word)
    return words.select("term", "df", F.explode_outer(grams(F.col("term"))).alias("gram")).select(
        F.length("gram").alias("n"), "gram", "term", "df"
    )


def build_dictionary(index: Index, rebuild: bool = False) -> DataFrame:
    """The index's saved n-grams; made if asked, missing or empty.

    One folder per gram bucket, sorted by gram, so a lookup opens few files. It is
    kept by the number of records and words, which every append raises: an
    appended index gets a dictionary of its own when next asked.
    """
    spark, path = index.spark, f"{index.path}/{index.build_id}/dictionary-{index.n_docs}-{index.n_tokens}"
    saved = spark.read.schema(DICTIONARY)
    if not rebuild:
        try:
            kept = saved.parquet(path)
            if not kept.isEmpty():
                return kept
        except AnalysisException:
            pass
    made = dictionary_of(dealt(index.vocabulary.where(F.col("field") == EXACT)))
    made = made.select(term_bucket(F.col("gram"), index.term_buckets).alias("gram_bucket"), "gram", "term", "df")
    write_keys(made, path, "gram_bucket", "gram", index.term_buckets)
    return saved.parquet(path)


def known_words(words: DataFrame, index: Index, min_word: int = MIN_WORD) -> DataFrame:
    """words(word) → (word, known): is it in the dictionary?"""
    wanted = words.select("word").distinct()
    keyed = wanted.select(term_bucket(F.col("word"), index.term_buckets).alias("term_bucket"), F.col("word").alias("term"))
    vocabulary = index.vocabulary.where((F.col("field") == EXACT) & (F.length("term") >= min_word))
    held = probe(vocabulary, keyed, ["term_bucket", "term"]).select(F.col("term").alias("word"), F.lit(True).alias("known"))
    return wanted.join(held, "word", "left").select("word", F.coalesce("known", F.lit(False)).alias("known"))


def _gram_pairs(words: DataFrame, dictionary: DataFrame, term_buckets: int | None = None) -> DataFrame:
    """words(word) → (word, term): every two that share an n-gram of equal size, each once.

    Two words meet in the first n-gram of the one that the other holds, and nowhere
    else, so pairs need not be made distinct.
    """
    listed = words.select("word").distinct().withColumn("own", grams(F.col("word")))
    keyed = listed.select("word", "own", F.explode("own").alias("gram"))
    keys = ["gram"]
    if term_buckets is not None:
        keyed = keyed.withColumn("gram_bucket", term_bucket(F.col("gram"), term_buckets))
        keys = ["gram_bucket", "gram"]
    low, high = _sizes(F.col("term"))
    shared = F.filter("own", lambda g: F.contains(F.col("term"), g) & F.length(g).between(low, high))
    longer = F.greatest(F.length("word"), F.length("term"))
    pairs = probe(dictionary, keyed, keys)
    pairs = pairs.where((F.col("term") != F.col("word")) & (F.abs(F.length("word") - F.length("term")) * 2 <= longer))
    return pairs.where(F.get(shared, F.lit(0)) == F.col("gram")).select("word", "term")


def _close_pairs(words: DataFrame, index: Index, min_word: int = MIN_WORD) -> DataFrame:
    """words(word) → (word, term): those of ``_gram_pairs`` within ``EDITS`` edits, from the saved deletion keys."""
    asked = settle(words.select("word", F.explode(deletion_keys(F.col("word"), EDITS)).alias("key")), "deletions")
    met = words_of(index, EXACT, "deletions", asked)
    met = met.where((F.length("term") >= min_word) & (F.col("term") != F.col("word")) & (F.levenshtein("word", "term", EDITS) >= 0))
    met = met.where(F.arrays_overlap(grams(F.col("word")), grams(F.col("term")))).select("word", "term").distinct()
    found = settle(met.withColumn("term_bucket", term_bucket(F.col("term"), index.term_buckets)), "close")
    # keys may be of words that this state of the index lacks
    return probe(index.vocabulary.where(F.col("field") == EXACT), found, ["term_bucket", "term"]).select("word", "term")


def _similar(pairs: DataFrame) -> DataFrame:
    """Pairs that are similar enough, with ``similarity`` and ``place`` among their word's, best first."""
    longer = F.greatest(F.length("word"), F.length("term"))
    scored = pairs.withColumn("similarity", 1 - F.levenshtein("word", "term") / longer).where(F.col("similarity") >= MIN_SIMILARITY)
    best = [F.col("similarity").desc(), F.col("term").asc()]
    return scored.withColumn("place", F.row_number().over(Window.partitionBy("word").orderBy(*best)))


def suggest_similar(
    words: DataFrame, dictionary: DataFrame, per_term: int = 2, term_buckets: int | None = None, index: Index | None = None
) -> DataFrame:
    """words(word) → (word, suggestion, similarity, place), best first.

    Candidates share an n-gram of equal size with the word. Similarity is one
    minus the edit distance over the longer length; at least one half counts.

    With ``index``, words first meet those within ``EDITS`` edits. Whatever is further
    away is at most ``n / (n + EDITS + 1)`` similar to a word of n letters, so words with
    enough suggestions above that are done; only the others meet all their n-grams.
    """
    wanted = words.select("word").distinct()
    if index is None:
        found = _similar(_gram_pairs(wanted, dictionary, term_buckets)).where(F.col("place") <= per_term)
    else:
        wanted = settle(wanted, "wanted")
        close = settle(_similar(_close_pairs(wanted, index)).where(F.col("place") <= per_term), "near")
        # the most similar that a word of one edit more can be
        beyond = F.length("word") / (F.length("word") + EDITS + 1)
        done = close.where((F.col("place") == per_term) & (F.col("similarity") > beyond)).select("word")
        rest = settle(wanted.join(done, "word", "left_anti"), "rest")
        others = _similar(_gram_pairs(rest, dictionary, term_buckets)).where(F.col("place") <= per_term)
        found = close.join(done, "word", "left_semi").unionByName(others)
    return found.select("word", F.col("term").alias("suggestion"), F.round("similarity", 6).alias("similarity"), "place")


def word_options(words: DataFrame, index: Index, dictionary: DataFrame, per_term: int = 2) -> DataFrame:
    """words(word) → (word, known, similar): similar is the ordered suggestions
    of an unknown word, empty for a known one. At most ``per_term`` each."""
    known = settle(known_words(words, index), "known")
    found = suggest_similar(known.where(~F.col("known")), dictionary, per_term, index.term_buckets, index)
    listed = found.groupBy("word").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "suggestion"))), lambda s: s["suggestion"]).alias("similar")
    )
    return known.join(listed, "word", "left").select(
        "word", "known", F.coalesce("similar", F.array().cast("array<string>")).alias("similar")
    )


def term_options(queries: DataFrame, options: DataFrame) -> DataFrame:
    """(query_id, slot, word, choices): the word if known, else what resembles
    it, else the word after all."""
    slots = analyzed_queries(queries).select("query_id", F.posexplode("tokens").alias("slot", "word"))
    choices = F.when(~F.col("known") & (F.size("similar") > 0), F.col("similar")).otherwise(F.array("word"))
    return slots.join(options, "word").select("query_id", "slot", "word", choices.alias("choices"))


def combine_options(choices: DataFrame, max_combos: int = 5) -> DataFrame:
    """(query_id, slot, choices) → (query_id, place, suggestion): the first
    ``max_combos`` phrases, the last word varying fastest.

    Phrase number i is read off as digits whose bases are the slots' numbers of
    choices, so the full product is never laid out.
    """
    # one array element per word of a phrase
    rows = choices.groupBy("query_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "choices"))), lambda s: s["choices"]).alias("slots")
    )
    sizes = F.transform("slots", lambda c: F.size(c))
    bounded = lambda a, n: F.least(a * n, F.lit(max_combos))
    rows = rows.withColumn("sizes", sizes).withColumn("total", F.aggregate("sizes", F.lit(1), bounded))
    # how many phrases go by before slot k moves on
    after = lambda k: F.aggregate(F.slice("sizes", k + 2, F.size("sizes")), F.lit(1), bounded)
    rows = rows.withColumn("steps", F.transform(F.sequence(F.lit(0), F.size("sizes") - 1), after))
    phrase = F.array_join(
        F.transform(
            "slots",
            lambda c, k: F.get(c, ((F.col("place") / F.get("steps", k)).cast("int") % F.size(c)).cast("int")),
        ),
        " ",
    )
    return rows.select("*", F.explode(F.sequence(F.lit(0), F.col("total") - 1)).alias("place")).select(
        "query_id", "place", phrase.alias("suggestion")
    )


def compound_forms(queries: DataFrame) -> DataFrame:
    """(query_id, form, word): the phrase's words glued and hyphenated, unless
    that is the phrase itself, whatever the case."""
    q = analyzed_queries(queries).where(F.size("tokens") > 0)
    forms = q.select(
        "query_id",
        "phrase",
        F.posexplode(F.array(F.array_join("tokens", ""), F.array_join("tokens", "-"))).alias("form", "word"),
    )
    return forms.where(F.lower("word") != F.lower("phrase")).drop("phrase")


def compound_suggestions(queries: DataFrame, options: DataFrame) -> DataFrame:
    """(query_id, form, place, suggestion): each form if known, else its like."""
    found = compound_forms(queries).join(options, "word")
    choices = F.when(F.col("known"), F.array("word")).otherwise(F.col("similar"))
    return found.select("query_id", "form", F.posexplode(choices).alias("place", "suggestion"))


def finalize_suggestions(queries: DataFrame, phrases: DataFrame, compounds: DataFrame, max_combos: int = 5) -> DataFrame:
    """Phrases, then glued, then hyphenated forms: each once, never the original
    phrase, at most ``max_combos``. → (query_id, place, suggestion)"""
    order = F.struct("form", "place")
    united = phrases.withColumn("form", F.lit(-1)).unionByName(compounds)
    once = united.groupBy("query_id", "suggestion").agg(F.min(order).alias("seen"))
    fresh = once.join(queries.select("query_id", "phrase"), "query_id").where(F.col("suggestion") != F.col("phrase"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("seen"))
    return fresh.withColumn("place", place).where(F.col("place") <= max_combos).select("query_id", "place", "suggestion")


def suggest_phrases(queries: DataFrame, index: Index, params: SearchParams = SearchParams(), rebuild: bool = False) -> DataFrame:
    """queries(query_id, phrase) → (query_id, place, suggestion)."""
    dictionary = build_dictionary(index, rebuild)
    tokens = analyzed_queries(queries).select(F.explode("tokens").alias("word"))
    words = tokens.unionByName(compound_forms(queries).select("word")).distinct()
    options = settle(word_options(words, index, dictionary, params.per_term), "options")
    phrases = combine_options(term_options(queries, options), params.max_combos)
    return finalize_suggestions(queries, phrases, compound_suggestions(queries, options), params.max_combos)

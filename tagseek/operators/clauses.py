"""Phrases to weighted clauses, and clauses to the index terms they accept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import deletion_keys, swap_distances
from ..functions.scoring import idf
from ..params import SearchParams
from ..session import settle
from ..sources.store import Index, probe
from .lexicon import run_grams, words_of
from .postings import EXACT, analyzed_queries, term_bucket
from .rank import top_per_key

# How a clause scores a record: by phrase frequency, by a fixed value, or by
# the sum over the similar words found.
PHRASE, HYPHEN, CONSTANT, FUZZY = "phrase", "hyphen", "constant", "fuzzy"

# Beginnings that one scan filter lists at most; more are shortened until they fit.
STARTS = 50
# Shares of the vocabulary that patterns without a letter meet one by one.
ANY_KEYS = 32


def _is_pattern(word: Column) -> Column:
    return word.contains("*") | word.contains("?")


def _is_prefix(word: Column) -> Column:
    """The only wildcard is one ``*`` at the end, after at least one letter."""
    return word.endswith("*") & ~word.contains("?") & (F.locate("*", word) == F.length(word)) & (F.length(word) > 1)


def expand_queries(queries: DataFrame, mode: str = EXACT, params: SearchParams = SearchParams()) -> DataFrame:
    """Queries(query_id, phrase) → one row per clause.

    Columns: query_id, clause (its name within the query), kind, words (array),
    boost. The whole routing is one projection over the query table.
    """
    q = analyzed_queries(queries)
    phrase, tokens = F.col("phrase"), F.col("tokens")
    lower = (lambda w: F.lower(w)) if params.normalize and mode == EXACT else (lambda w: w)

    def clause(name, kind, words, boost, when) -> Column:
        row = F.struct(
            F.lit(name).alias("clause"),
            F.lit(kind).alias("kind"),
            words.alias("words"),
            F.lit(float(boost)).alias("boost"),
        )
        return F.when(when & (F.size(words) > 0), F.array(row)).otherwise(F.array().cast("array<" + _ROW + ">"))

    symbols = mode == EXACT or params.literal_phonetic
    rows = []
    if mode == EXACT:
        rows.append(clause("phrase", PHRASE, tokens, params.boost_exact, F.lit(True)))
    else:
        rows.append(clause("phrase", PHRASE, F.col("codes"), params.boost_phonetic, F.lit(True)))
    if symbols:
        alone = F.filter(F.array(lower(F.regexp_replace(phrase, "~$", ""))), lambda w: w != "")
        rows.append(
            clause("fuzzy:0", FUZZY, alone, params.boost_fuzzy, phrase.contains("~") & ~phrase.contains(" "))
        )
        marked = F.filter(F.col("raw"), lambda w: w.endswith("~") & (w != "~"))
        stripped = F.transform(marked, lambda w: lower(F.regexp_replace(w, "~$", "")))
        rows.append(
            F.when(
                phrase.contains("~") & phrase.contains(" "),
                F.transform(
                    stripped,
                    lambda w, i: F.struct(
                        F.concat(F.lit("fuzzy:"), i.cast("string")).alias("clause"),
                        F.lit(FUZZY).alias("kind"),
                        F.array(w).alias("words"),
                        F.lit(float(params.boost_fuzzy)).alias("boost"),
                    ),
                ),
            ).otherwise(F.array().cast("array<" + _ROW + ">"))
        )
        patterns = F.transform(F.col("raw"), lower)
        wild = _is_pattern(phrase)
        # One word alone needs no positions, so it scores a fixed value.
        rows.append(clause("wildcard", CONSTANT, patterns, params.boost_wildcard, wild & (F.size("raw") == 1)))
        rows.append(clause("wildcard", PHRASE, patterns, params.boost_wildcard, wild & (F.size("raw") > 1)))
        prefix = F.transform(F.array(F.trim(phrase)), lower)
        rows.append(
            clause("prefix", CONSTANT, prefix, params.boost_prefix, (F.size(tokens) == 1) & _is_prefix(F.trim(phrase)))
        )
    if mode == EXACT:
        several = F.size(tokens) >= 2
        rows.append(clause("glued", PHRASE, F.array(F.array_join(tokens, "")), params.boost_prefix, several))
        rows.append(clause("hyphen", HYPHEN, tokens, params.boost_prefix, several))
    return q.select("query_id", F.inline(F.concat(*rows)))


_ROW = "struct<clause:string,kind:string,words:array<string>,boost:double>"


def clause_weights(params: SearchParams) -> dict[str, float]:
    """Weight per kind of clause (the glued and hyphenated forms share one)."""
    return {
        "exact": params.boost_exact,
        "phonetic": params.boost_phonetic,
        "wildcard": params.boost_wildcard,
        "fuzzy": params.boost_fuzzy,
        "prefix": params.boost_prefix,
    }


# --- words of a clause → terms of the vocabulary --------------------------------


def _slots(clauses: DataFrame) -> DataFrame:
    """One row per word of each clause, with how the word is to be read."""
    rows = clauses.select("query_id", "field", "clause", "kind", "boost", F.size("words").alias("n_slots"), F.posexplode("words").alias("slot", "word"))
    reading = (
        F.when(F.col("kind") == FUZZY, "fuzzy")
        .when(F.col("clause").isin("wildcard", "prefix") & _is_pattern(F.col("word")), "pattern")
        .otherwise("term")
    )
    return rows.withColumn("reading", reading)


def pattern_regex(pattern: Column) -> Column:
    """``*`` and ``?`` wildcards as an anchored regular expression."""
    quoted = F.regexp_replace(pattern, r"([\\^$.|+()\[\]{}])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.regexp_replace(F.regexp_replace(quoted, r"\*", ".*"), r"\?", "."), F.lit("$"))


def _anchors(pattern: Column) -> Column:
    """Where a pattern is fixed: (side, text) of its longest literal run; of equal
    ones the head, then the tail. Side ``any`` if it has none."""
    head = F.regexp_extract(pattern, r"^([^*?]*)", 1)
    tail = F.regexp_extract(pattern, r"([^*?]*)$", 1)
    runs = F.filter(F.split(pattern, r"[*?]+"), lambda r: r != "")
    inner = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))["r"]
    size = F.greatest(F.length(head), F.length(tail), F.coalesce(F.length(inner), F.lit(0)))
    return (
        F.when(inner.isNull(), F.struct(F.lit("any").alias("side"), F.lit("").alias("key")))
        .when(F.length(head) == size, F.struct(F.lit("head").alias("side"), head.alias("key")))
        .when(F.length(tail) == size, F.struct(F.lit("tail").alias("side"), tail.alias("key")))
        .otherwise(F.struct(F.lit("inner").alias("side"), inner.alias("key")))
    )


def _term_anchors(term: Column, kinds: list[tuple[str, int]]) -> Column:
    """The keys of a vocabulary word for each (side, length) in use."""
    made = []
    for side, n in kinds:
        if side == "head":
            keys = F.array(F.left(term, F.lit(n)))
        elif side == "tail":
            keys = F.array(F.right(term, F.lit(n)))
        elif side == "inner":
            keys = F.array_distinct(
                F.transform(F.sequence(F.lit(1), F.greatest(F.length(term) - n + 1, F.lit(1))), lambda i: F.substring(term, i, F.lit(n)))
            )
        else:
            keys = F.array(F.pmod(F.xxhash64(term), F.lit(ANY_KEYS)).cast("string"))
        made.append(_tag(keys, side))
    return F.array_distinct(F.concat(*made))  # short words give one key for several lengths


def _tag(keys: Column, side: str) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(side).alias("side"), k.alias("key")))


def _starts(keyed: DataFrame) -> Column:
    """A filter for the scan, which is sorted by term: the heads' beginnings, as
    long as few enough of them are distinct. The join on whole heads follows."""
    heads = keyed.where(F.col("side") == "head")
    length = heads.agg(F.max(F.length("key"))).first()[0]
    while True:
        rows = heads.select(F.left("key", F.lit(length)).alias("head")).distinct().limit(STARTS + 1).collect()
        if len(rows) <= STARTS:
            return reduce(Column.__or__, [F.col("term").startswith(r["head"]) for r in rows])
        if length == 1:
            return F.lit(True)
        length //= 2


def expand_patterns(
    patterns: DataFrame, vocabulary: DataFrame, max_expansions: int | None = None, index: Index | None = None, field: str = EXACT
) -> DataFrame:
    """patterns(pattern) × vocabulary(term, …) → the words each pattern accepts.

    An equi-join on the patterns' literal parts, then the full test on what is
    left; the distinct (side, length) pairs are at most a few per word length.
    Patterns without a letter are met in shares of the vocabulary. With ``index``,
    words that end in or hold a run of letters come from its saved n-grams: they are
    those that have all grams of the run.
    """
    distinct = patterns.select("pattern").distinct()
    keyed = distinct.select("pattern", _anchors(F.col("pattern")).alias("a")).select(
        "pattern", pattern_regex(F.col("pattern")).alias("regex"), "a.side", "a.key"
    )
    keys = F.when(F.col("side") == "any", F.array(*[F.lit(str(i)) for i in range(ANY_KEYS)])).otherwise(F.array("key"))
    spread = keyed.select("pattern", "regex", "side", F.explode(keys).alias("key"))
    if index is not None:
        runs = keyed.where(F.col("side").isin("tail", "inner"))
        keyed = keyed.where(~F.col("side").isin("tail", "inner"))
    kinds = [tuple(r) for r in keyed.select("side", F.length("key")).distinct().orderBy("side", F.length("key")).collect()]
    found = None
    for of_head in (True, False):
        own = [k for k in kinds if (k[0] == "head") == of_head]
        if own or (index is None and found is None and not of_head):
            narrowed = vocabulary.where(_starts(keyed)) if of_head else vocabulary
            candidates = narrowed.withColumn("a", F.explode(_term_anchors(F.col("term"), own or [("any", 0)])))
            part = candidates.select(*vocabulary.columns, "a.side", "a.key").join(spread, ["side", "key"])
            part = part.where(F.expr("term rlike regex")).drop("side", "key", "regex")
            found = part if found is None else found.unionByName(part)
    if index is not None:
        part = _by_grams(runs, vocabulary, index, field)
        found = part if found is None else found.unionByName(part)
    if max_expansions is not None:
        found = top_per_key(found, "pattern", [F.col("term").asc()], max_expansions)
    return found


def _by_grams(runs: DataFrame, vocabulary: DataFrame, index: Index, field: str) -> DataFrame:
    """Words of the vocabulary that hold the runs of runs(pattern, regex, key), by saved n-grams."""
    grams = runs.select("pattern", "regex", run_grams(F.col("key")).alias("grams"))
    asked = settle(grams.select("pattern", "regex", F.size("grams").alias("needed"), F.explode("grams").alias("key")), "grams")
    met = words_of(index, field, "grams", asked).groupBy("pattern", "regex", "needed", "term").agg(F.count(F.lit(1)).alias("held"))
    held = met.where((F.col("held") == F.col("needed")) & F.expr("term rlike regex")).select("pattern", "term")
    return _with_words(held, vocabulary, index).select(*vocabulary.columns, "pattern")


def _with_words(found: DataFrame, vocabulary: DataFrame, index: Index) -> DataFrame:
    """found(term, …) with the vocabulary's columns; words of later states drop out."""
    found = settle(found.withColumn("term_bucket", term_bucket(F.col("term"), index.term_buckets)), "found")
    return probe(vocabulary, found, ["term_bucket", "term"])


def expand_fuzzy(
    words: DataFrame, vocabulary: DataFrame, edits: int, keep: int | None = None, index: Index | None = None, field: str = EXACT
) -> DataFrame:
    """words(word) × vocabulary(term, …) → similar terms with ``weight``.

    Candidates share what is left after dropping up to ``edits`` letters, so
    only plausible pairs meet. Spark's own bounded distance then drops most of
    them, and the swap-aware distance is worked out for the rest. ``keep``
    bounds the terms one word may stand for: best first, then in byte order. With
    ``index``, its saved keys are looked up, and the vocabulary only for what is near.
    """
    left = words.select("word").distinct()
    if index is not None:
        asked = settle(left.withColumn("key", F.explode(deletion_keys(F.col("word"), edits))), "deletions")
        near = _near(words_of(index, field, "deletions", asked).drop("key"), edits)
        return _kept(_with_words(near, vocabulary, index), keep)
    sizes = left.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    low, high = (sizes[0] or 0) - edits, (sizes[1] or 0) + edits
    left = left.withColumn("key", F.explode(deletion_keys(F.col("word"), edits)))
    right = vocabulary.where(F.length("term").between(low, high)).withColumn(
        "key", F.explode_outer(deletion_keys(F.col("term"), edits))
    )
    return _kept(_near(right.join(left, "key").drop("key"), edits), keep)


def _near(pairs: DataFrame, edits: int) -> DataFrame:
    """Pairs (word, term, …) at most ``edits`` apart, each once, with distance and weight."""
    shorter = F.least(F.length("word"), F.length("term"))
    close = (
        pairs.where(F.abs(F.length("word") - F.length("term")) <= edits)
        .where(F.levenshtein("word", "term", 2 * edits) >= 0)
        .dropDuplicates(["word", "term"])
    )
    return (
        close.withColumn("distance", swap_distances("word", "term"))
        .where((F.col("distance") <= edits) & (F.col("distance") < shorter))
        .withColumn("weight", 1 - F.col("distance") / shorter)
    )


def _kept(close: DataFrame, keep: int | None) -> DataFrame:
    return close if keep is None else top_per_key(close, "word", [F.col("weight").desc(), F.col("term").asc()], keep)


def clause_terms(clauses: DataFrame, index: Index, field: str = EXACT, params: SearchParams = SearchParams()) -> DataFrame:
    """Clauses → the vocabulary terms each of their words accepts, written out.

    All expansion happens on the vocabulary; postings see only plain terms.
    ``weight`` is the factor of one term's own score (fuzzy clauses), ``idf``
    the factor of the whole clause's (phrases). Clauses of several fields carry
    theirs as ``field``; all others are of the field given.
    """
    fielded = clauses if "field" in clauses.columns else clauses.withColumn("field", F.lit(field))
    slots = settle(_slots(fielded), "slots")
    readings = {tuple(r) for r in slots.select("field", "reading").distinct().collect()}
    terms = slots.where(F.col("reading") == "term").withColumn("term_bucket", term_bucket(F.col("word"), index.term_buckets))
    plain = probe(index.vocabulary, terms.withColumnRenamed("word", "term"), ["field", "term_bucket", "term"])
    parts = [plain.withColumn("distance_weight", F.lit(1.0))]
    for name, reading in sorted(readings):
        vocabulary = index.vocabulary.where(F.col("field") == name).drop("field")
        wanted = slots.where((F.col("field") == name) & (F.col("reading") == reading))
        if reading == "pattern":
            wanted = wanted.withColumnRenamed("word", "pattern")
            accepted = expand_patterns(wanted, vocabulary, params.max_expansions, index, name)
            parts.append(accepted.join(wanted, "pattern").withColumn("distance_weight", F.lit(1.0)))
        elif reading == "fuzzy":
            similar = expand_fuzzy(wanted, vocabulary, params.fuzzy_edits, params.fuzzy_terms, index, name)
            parts.append(similar.join(wanted, "word").withColumnRenamed("weight", "distance_weight"))
    columns = ["query_id", "field", "clause", "kind", "boost", "n_slots", "slot", "term_bucket", "term", "df", "distance_weight"]
    united = parts[0].select(*columns)
    for part in parts[1:]:
        united = united.unionByName(part.select(*columns))
    united = settle(united.withColumn("own_idf", idf(index.n_docs, F.col("df"))), "terms")
    whole = united.groupBy("query_id", "field", "clause").agg(
        F.sum("own_idf").alias("idf"), F.max("df").alias("most"), F.countDistinct("slot").alias("found")
    )
    shared = idf(index.n_docs, F.col("most"))
    weighted = (
        united.join(whole, ["query_id", "field", "clause"])
        .where((F.col("kind") != PHRASE) & (F.col("kind") != HYPHEN) | (F.col("found") == F.col("n_slots")))
        .withColumn("weight", F.when(F.col("kind") == FUZZY, F.col("distance_weight") * shared).otherwise(F.lit(1.0)))
    )
    return settle(weighted.drop("own_idf", "most", "found", "distance_weight"), "weighted")

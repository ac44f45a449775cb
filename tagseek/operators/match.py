"""Match clauses: which records hold what a clause asks for, and how often.

Every function takes a whole query table. Terms are joined with the postings
once; the rows of one record lie in one bucket, so what follows (phrases,
frequencies, sums) needs no exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import coarse_length, saturation
from ..functions.sweep import apart, pair_windows, sloppy_windows
from ..params import SearchParams
from ..session import settings, settle, worked_out
from ..sources.store import TERM_KEYS, Index, probe, probe_terms, row_bytes
from .clauses import CONSTANT, FUZZY, HYPHEN, PHRASE, clause_terms
from .postings import EXACT, SOUND, analyzed_queries


def _all_slots(entries: Column, n_slots: Column) -> Column:
    """Per slot its sorted places, each moved back by the slot's number."""

    def places(slot: Column) -> Column:
        own = F.filter(entries, lambda e: e["slot"] == slot)
        return F.sort_array(F.flatten(F.transform(own, lambda e: F.transform(e["places"], lambda p: p - slot))))

    return F.transform(F.sequence(F.lit(0), n_slots - 1), places)


def _common(slots: Column) -> Column:
    """How many places all slots share: the exact phrase's frequency."""
    return F.size(F.aggregate(slots, F.element_at(slots, 1), lambda a, b: F.array_intersect(a, b)))


#: What names a clause.
CLAUSE = ["query_id", "field", "clause", "kind", "boost", "n_slots", "idf"]
#: Postings a record that phrases may gather; where they would gather more, each goes by its rarest word.
GATHERED = 10
#: Bytes of phrases broadcast together.
TOGETHER = 32 << 20
#: Tables bucketed by record are joined by record and word as they lie.
IN_BUCKETS = {"spark__sql__requireAllClusterKeysForCoPartition": "false"}


def _entry() -> Column:
    # A hyphenated form needs a hyphen after each word but the last. Clauses that
    # only ask "is it there" carry no places at all.
    inner = (F.col("kind") == HYPHEN) & (F.col("slot") < F.col("n_slots") - 1)
    places = F.when(inner, F.col("hyphens")).when((F.col("kind") != CONSTANT) & (F.col("n_slots") > 1), F.col("positions"))
    return F.struct("slot", "weight", "freq", places.alias("places"))


def _entries(terms: DataFrame, index: Index) -> DataFrame:
    """Clause terms → (clause, doc_id, dl, entries): the postings a record has for a clause."""
    rows = probe_terms(index.postings, terms)
    return rows.groupBy(*CLAUSE, "doc_id", "dl").agg(F.collect_list(_entry()).alias("entries"))


def _all_entries(terms: DataFrame, index: Index, exact: bool) -> tuple[DataFrame, bool]:
    """As ``_entries``, but phrases that would gather far more postings than there are
    records, since many hold frequent words, gather those of their rarest words only; and whether any do."""
    several = F.col("kind").isin(PHRASE, HYPHEN) & (F.col("n_slots") > 1)
    rows = terms.where(several).agg(F.sum("df")).first()[0] or 0
    if rows <= GATHERED * index.n_docs:
        return _entries(terms, index), False
    own = Window.partitionBy(*CLAUSE)
    slots = terms.withColumns({"_rows": F.count(F.lit(1)).over(own), "_slots": F.size(F.collect_set("slot").over(own))})
    # every word is one term; words that stand for several are gathered as before
    plain = several & (F.col("_rows") == F.col("n_slots")) & (F.col("_slots") == F.col("n_slots"))
    marked = settle(slots.withColumn("_plain", F.coalesce(plain, F.lit(False))).drop("_rows", "_slots"), "marked")
    parts = _rarest_first(marked.where("_plain").drop("_plain"), index, exact)
    others = marked.where("not _plain").drop("_plain")
    if not parts:
        return _entries(others, index), False
    if not others.isEmpty():
        parts.append(_entries(others, index))
    return reduce(DataFrame.unionByName, parts), True


def _rarest_first(terms: DataFrame, index: Index, exact: bool) -> list[DataFrame]:
    """``_entries`` of clauses with one term per slot, in parts; records that lack a word may be left out.

    Postings of a clause's rarest word name the records in question. Those of its other
    words are read once for all clauses, and met by record and word. Both lie in the
    records' buckets, so neither moves where ``IN_BUCKETS`` holds. ``exact``: only those
    that stand in order next to the rarest are kept.
    """
    held = F.sort_array(F.collect_list(F.struct("df", "slot", "weight", "term", "term_bucket")))
    clauses = terms.groupBy(*CLAUSE).agg(held.alias("held")).withColumn("rare", F.get("held", F.lit(0)))
    asked = clauses.select(*CLAUSE, "rare.slot", "rare.weight", "rare.term", "rare.term_bucket", F.explode(F.slice("held", 2, F.size("held"))).alias("other"))
    asked = settle(asked.select(*asked.columns[:-1], *[F.col(f"other.{c}").alias(f"other_{c}") for c in ("slot", "weight", "term", "term_bucket")]), "asked")
    longest, size = asked.agg(F.max("n_slots"), F.sum(row_bytes(asked.dtypes))).first()
    if longest is None:
        return []
    parts, n = [], -(-size // TOGETHER)
    for k in range(n):
        mine = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == k)
        words = settle(mine.select("field", F.col("other_term_bucket").alias("term_bucket"), F.col("other_term").alias("term")).distinct(), "words")
        rare = probe(index.postings, F.broadcast(mine), TERM_KEYS).select(
            *CLAUSE, "doc_id", "dl", _entry().alias("first"), *[F.col(f"other_{c}").alias(c) for c in ("slot", "weight", "term", "term_bucket")]
        )
        others = probe(index.postings, F.broadcast(words), TERM_KEYS).drop("dl")
        met = rare.join(others, ["doc_id", *TERM_KEYS]).select(*CLAUSE, "doc_id", "dl", "first", _entry().alias("other"))
        if exact:
            moved = F.transform("first.places", lambda p: p - F.col("first.slot") + F.col("other.slot"))
            met = met.where(F.arrays_overlap(moved, "other.places"))
        if longest == 2:
            parts.append(met.select(*CLAUSE, "doc_id", "dl", F.array("first", "other").alias("entries")))
        else:
            entries = F.concat(F.array(F.first("first")), F.collect_list("other"))
            parts.append(met.groupBy(*CLAUSE, "doc_id", "dl").agg(entries.alias("entries")))
    return parts


def _lone_apart(terms: DataFrame, index: Index) -> tuple[DataFrame | None, DataFrame | None]:
    """(terms of clauses that are one term, all others), where the first have far more postings than there
    are records; else none, and all terms. None also for others, if there are none."""
    few = GATHERED * index.n_docs
    if (terms.where(F.col("n_slots") == 1).agg(F.sum("df")).first()[0] or 0) <= few:
        return None, terms
    # query ids may repeat; what shares all of a clause's names is one clause of several terms
    lone = (F.count(F.lit(1)).over(Window.partitionBy(*CLAUSE)) == 1) & (F.col("n_slots") == 1)
    marked = settle(terms.withColumn("_lone", lone), "marked")
    rows, others = marked.agg(F.sum(F.when(F.col("_lone"), F.col("df"))), F.count_if(~F.col("_lone"))).first()
    if (rows or 0) <= few:
        return None, terms
    return marked.where("_lone").drop("_lone"), marked.where("not _lone").drop("_lone") if others else None


def _score(freq: Column, similar: Column, length: Column, index: Index) -> Column:
    value = (
        F.when(F.col("kind") == CONSTANT, F.lit(1.0))
        .when(F.col("kind") == FUZZY, similar)
        .otherwise(F.col("idf") * saturation(freq, length, index.avg_length))
    )
    return (F.col("boost") * value).alias("score")


def _length(params: SearchParams) -> Column:
    return coarse_length(F.col("dl")) if params.coarse_lengths else F.col("dl")


def match_terms(terms: DataFrame, index: Index, params: SearchParams, width: bool = False) -> DataFrame:
    """Clause terms → (query_id, clause, doc_id, dl, freq, score[, width]).

    ``freq`` is the clause's frequency in the record (NULL for clauses that only
    ask "is it there"), ``width`` the tightest sloppy window. Where clauses of one term
    have many postings, each of these is a hit as it is read: there is nothing to gather.
    """
    lone, others = (None, terms) if width else _lone_apart(terms, index)
    if lone is None:
        return _gathered_hits(terms, index, params, width)
    length = _length(params)
    similar = F.col("weight") * saturation(F.col("freq"), length, index.avg_length)
    freq = F.when(F.col("kind") != CONSTANT, F.col("freq").cast("double")).alias("freq")
    hits = probe_terms(index.postings, lone).select("query_id", "clause", "doc_id", "dl", freq, _score(F.col("freq"), similar, length, index))
    return hits if others is None else hits.unionByName(_gathered_hits(others, index, params))


def _gathered_hits(terms: DataFrame, index: Index, params: SearchParams, width: bool = False) -> DataFrame:
    """As ``match_terms``, of clauses whose postings in a record are put together first."""
    sweeps = max(params.slop, params.wildcard_slop) > 0 or width
    found, rarest = _all_entries(terms, index, not sweeps)
    kind, n, entries = F.col("kind"), F.col("n_slots"), F.col("entries")
    several = kind.isin(PHRASE, HYPHEN) & (n > 1)
    present = F.size(F.array_distinct(F.transform(entries, lambda e: e["slot"])))
    found = found.where(~several | (present == n))
    found = worked_out(found, slots=F.when(several, _all_slots(entries, n)))

    exact = _common(F.col("slots")).cast("double")
    if sweeps:
        reach = F.when(F.col("clause") == "wildcard", params.wildcard_slop).otherwise(params.slop)
        swept = (kind == PHRASE) & (F.lit(True) if width else reach > 0)
        # two words that differ need no Python
        pair = swept & several & F.coalesce(apart(F.col("slots")), F.lit(False))
        found = worked_out(found, pair=F.when(pair, pair_windows(F.col("slots"), reach)))
        swept_here = sloppy_windows(F.when(swept & F.col("pair").isNull(), F.col("slots")), reach)
        found = found.withColumn("windows", F.coalesce("pair", swept_here))
        exact = F.when(swept, F.col("windows.freq")).otherwise(exact)
    single = F.aggregate(entries, F.lit(0), lambda a, e: a + e["freq"]).cast("double")
    freq = F.when(several, exact).when(kind != CONSTANT, single)
    found = worked_out(found, freq=freq).where(F.col("freq").isNull() | (F.col("freq") > 0))
    length = _length(params)
    similar = F.aggregate(
        entries,
        F.lit(0.0),
        lambda a, e: a + e["weight"] * saturation(e["freq"], length, index.avg_length),
    )
    kept = ["query_id", "clause", "doc_id", "dl", "freq", _score(F.col("freq"), similar, length, index)]
    if width:
        kept.append(F.col("windows.width").alias("width"))
    hits = found.select(*kept)
    if not rarest:
        return hits
    with settings(index.spark, **IN_BUCKETS):  # planned and run here: who asks later may plan otherwise
        return settle(hits, "clause_hits")


def match_clauses(clauses: DataFrame, index: Index, field: str = EXACT, params: SearchParams = SearchParams(), width: bool = False) -> DataFrame:
    """Clauses of any kinds → clause hits, in one pass over the postings.

    Clauses of several fields carry theirs as ``field``; a query id then tells them apart.
    """
    return match_terms(clause_terms(clauses, index, field, params), index, params, width)


def _single(queries: DataFrame, clause: str, kind: str, words: Column, boost: float = 1.0) -> DataFrame:
    rows = analyzed_queries(queries).select(
        "query_id",
        F.lit(clause).alias("clause"),
        F.lit(kind).alias("kind"),
        words.alias("words"),
        F.lit(float(boost)).alias("boost"),
    )
    return rows.where(F.size("words") > 0)


_STRICT = SearchParams(slop=0)


def match_term(queries: DataFrame, index: Index) -> DataFrame:
    """Records holding the phrase's one word; phrases of more words are left out."""
    return match_clauses(_single(queries, "phrase", PHRASE, F.col("tokens")).where(F.size("words") == 1), index, params=_STRICT)


def match_phrase(queries: DataFrame, index: Index, slop: int = 0, width: bool = False) -> DataFrame:
    """Records holding the words in order, or within ``slop`` moves of it."""
    params = SearchParams(slop=slop)
    return match_clauses(_single(queries, "phrase", PHRASE, F.col("tokens")), index, EXACT, params, width)


def match_phonetic(queries: DataFrame, index: Index, slop: int = 0) -> DataFrame:
    """Records whose words sound like the phrase's, in order or within ``slop``."""
    clauses = _single(queries, "phrase", PHRASE, F.col("codes"))
    return match_clauses(clauses, index, SOUND, SearchParams(slop=slop))


def _patterns(params: SearchParams) -> Column:
    return F.transform(F.col("raw"), F.lower) if params.normalize else F.col("raw")


def match_prefix(queries: DataFrame, index: Index, params: SearchParams = _STRICT) -> DataFrame:
    """Records holding a word that starts as asked (``thou*``); score 1."""
    return match_clauses(_single(queries, "prefix", CONSTANT, _patterns(params)), index, params=params)


def match_wildcard(queries: DataFrame, index: Index, params: SearchParams = _STRICT) -> DataFrame:
    """Records holding a word the ``*``/``?`` pattern accepts; score 1."""
    return match_clauses(_single(queries, "wildcard", CONSTANT, _patterns(params)), index, params=params)


def match_wildcard_phrase(queries: DataFrame, index: Index, params: SearchParams = _STRICT) -> DataFrame:
    """Phrases whose words may be patterns; one pattern alone scores 1."""
    rows = _single(queries, "wildcard", PHRASE, _patterns(params))
    kind = F.when(F.size("words") == 1, F.lit(CONSTANT)).otherwise(F.lit(PHRASE))
    return match_clauses(rows.withColumn("kind", kind), index, params=params)


def match_fuzzy(queries: DataFrame, index: Index, params: SearchParams = _STRICT) -> DataFrame:
    """Records holding words like the phrase's one word (a final ``~`` is dropped)."""
    word = F.transform(_patterns(params), lambda w: F.regexp_replace(w, "~$", ""))
    return match_clauses(_single(queries, "fuzzy:0", FUZZY, word), index, params=params)


def match_glued(queries: DataFrame, index: Index) -> DataFrame:
    """Records holding the phrase's words written as one."""
    rows = _single(queries, "glued", PHRASE, F.array(F.array_join("tokens", "")))
    return match_clauses(rows.join(_several(queries), "query_id", "left_semi"), index, params=_STRICT)


def match_hyphenated(queries: DataFrame, index: Index) -> DataFrame:
    """Records whose text joins the phrase's words by nothing but hyphens."""
    rows = _single(queries, "hyphen", HYPHEN, F.col("tokens"))
    return match_clauses(rows.where(F.size("words") >= 2), index, params=_STRICT)


def _several(queries: DataFrame) -> DataFrame:
    return analyzed_queries(queries).where(F.size("tokens") >= 2).select("query_id")

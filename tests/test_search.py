import random

import pytest
from pyspark.sql import functions as F

from tagseek.operators import match, rank, spelling
from tagseek.operators.clauses import expand_fuzzy, expand_patterns, expand_queries
from tagseek.operators.lexicon import lexicon, words_of
from tagseek.params import SearchParams
from tagseek.plans.search import exact_search, fallback_search, phonetic_search, search
from tagseek.session import fresh_path, settings, settle
from tagseek.sources import store
from tagseek.sources.store import index_stats, load_index, save_index, term_blocks

STRICT = SearchParams(slop=0)


def docs(hits, query=0):
    return {r.doc_id: r.freq for r in hits.where(F.col("query_id") == query).collect()}


def test_exact_phrase(index, ask):
    assert docs(match.match_phrase(ask("hyper space"), index)) == {1: 2.0, 2: 1.0}
    assert docs(match.match_phrase(ask("to be to be"), index)) == {8: 1.0}
    assert docs(match.match_phrase(ask("hyper nowhere"), index)) == {}


def test_sloppy_phrase(index, ask):
    found = docs(match.match_phrase(ask("hyper space"), index, slop=2))
    assert set(found) == {1, 2, 3, 4}
    assert found[3] == pytest.approx(1 / 3) and found[4] == pytest.approx(1 / 2)


def test_slop_zero_sweep_equals_exact_phrase(index, ask):
    exact = docs(match.match_phrase(ask("to be"), index))
    swept = match.match_phrase(ask("to be"), index, slop=0, width=True)
    assert docs(swept) == exact == {8: 3.0}


def test_more_slop_never_loses_a_match(index, ask):
    held = set()
    for slop in range(4):
        found = set(docs(match.match_phrase(ask("space hyper"), index, slop=slop)))
        assert held <= found
        held = found


def test_phonetic(index, ask):
    # "not" sounds like "night" and "knight"
    assert set(docs(match.match_phonetic(ask("night", "123"), index))) == {5, 6, 8}
    assert set(docs(match.match_phonetic(ask("night", "123"), index), 1)) == {6}


def test_prefix_wildcard_and_short_words(index, ask):
    assert set(docs(match.match_prefix(ask("hyper*"), index))) == {1, 2, 3, 4, 9}
    assert set(docs(match.match_wildcard(ask("*drive", "h*s?nic", "*", "??"), index))) == {9}
    everything = match.match_wildcard(ask("*"), index)
    assert everything.count() == 8
    assert set(docs(match.match_wildcard(ask("??"), index))) == {5, 8}
    # a short word has the same first letters for several lengths; it counts once
    assert match.match_wildcard_phrase(ask("t* be", "tolong* x"), index).count() == 1


def test_wildcard_phrase_and_expansion_limit(index, ask):
    assert set(docs(match.match_wildcard_phrase(ask("hyper* space"), index))) == {1, 2}
    limited = match.match_wildcard(ask("hyper*"), index, SearchParams(slop=0, max_expansions=1))
    assert set(docs(limited)) == {1, 2, 3, 4}


def test_fuzzy(index, ask):
    assert set(docs(match.match_fuzzy(ask("hpyer"), index))) == {1, 2, 3, 4}
    assert set(docs(match.match_fuzzy(ask("naive~"), index, SearchParams(fuzzy_edits=1)))) == {6}


def test_glued_and_hyphenated(index, ask):
    assert set(docs(match.match_glued(ask("hyper space"), index))) == {2}
    assert docs(match.match_hyphenated(ask("hyper space"), index)) == {2: 1.0}


def test_clause_routing(ask):
    plan = expand_queries(
        ask("hyper space", "hyper", "hyper*", "hy*er", "hyper* space", "hyper~", "hyper~ space", "*", "~", "", "!?")
    ).collect()
    by_query = {}
    for row in plan:
        by_query.setdefault(row.query_id, {})[row.clause] = list(row.words)
    assert by_query[0] == {"phrase": ["hyper", "space"], "glued": ["hyperspace"], "hyphen": ["hyper", "space"]}
    assert by_query[1] == {"phrase": ["hyper"]}
    assert set(by_query[2]) == {"phrase", "wildcard", "prefix"}
    assert set(by_query[3]) == {"phrase", "wildcard", "glued", "hyphen"}
    assert by_query[4]["wildcard"] == ["hyper*", "space"]
    assert by_query[5]["fuzzy:0"] == ["hyper"] and by_query[6]["fuzzy:0"] == ["hyper"]
    assert set(by_query[7]) == {"wildcard"} and set(by_query[10]) == {"wildcard"}
    assert 8 not in by_query and 9 not in by_query


def test_phonetic_mode_emits_the_phrase_only(ask):
    assert {r.clause for r in expand_queries(ask("hyper* nite~"), "sound").collect()} == {"phrase"}
    literal = expand_queries(ask("hyper* nite~"), "sound", SearchParams(literal_phonetic=True))
    assert {r.clause for r in literal.collect()} == {"phrase", "fuzzy:0", "wildcard"}


def test_minimum_of_clauses(spark):
    hits = spark.createDataFrame(
        [(1, "a", 1, 1.0), (1, "b", 1, 2.0), (1, "a", 2, 4.0)], "query_id int, clause string, doc_id bigint, score double"
    )
    assert {(r.doc_id, r.score) for r in rank.combine(hits, 0).collect()} == {(1, 3.0), (2, 4.0)}
    assert {(r.doc_id, r.score) for r in rank.combine(hits, 2).collect()} == {(1, 3.0)}


def test_top_n_counts_before_it_cuts(spark):
    hits = spark.range(500).select(F.lit(1).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 7).cast("double").alias("score"))
    top = rank.top_n(hits, 5).orderBy("rank").collect()
    assert [r.doc_id for r in top] == [6, 13, 20, 27, 34]
    assert {r.total_hits for r in top} == {500}


def test_tags_sum_top_hits_and_skip_untagged(index, ask):
    found = exact_search(ask("hyper space", "night", "nite", "absent"), index)
    tags = {(r.query_id, r.bookmark_tag) for r in found.tags.collect()}
    assert (1, "") in tags and not any(q == 2 for q, _ in tags)
    assert {r.query_id: r.total_hits for r in found.totals.collect()}[3] == 0
    one = exact_search(ask("hyper space"), index, SearchParams(max_search=1))
    assert one.tags.count() == 1 and one.totals.first().total_hits == 4


def test_details_show_missing_times(index, ask):
    row = exact_search(ask("nite"), index).details().first()
    assert (row.start, row.end, row.text) == ("?", "?", "nite watch naïve 123")


def test_spelling(spark, index, ask):
    dictionary = spelling.build_dictionary(index)
    words = spark.createDataFrame([("spase",), ("hyper",), ("zzz",)], "word string")
    found = spelling.suggest_similar(words, dictionary, 2, index.term_buckets)
    assert {(r.word, r.suggestion) for r in found.collect() if r.word == "spase"} == {("spase", "space")}
    got = spelling.suggest_phrases(ask("hyper spase", "hyper", "zzz"), index).orderBy("query_id", "place").collect()
    assert [r.suggestion for r in got if r.query_id == 0][:2] == ["hyper space", "hyperspace"]
    assert not [r for r in got if r.query_id in (1, 2)]


def test_combinations_vary_the_last_word_fastest(spark):
    rows = [(1, 0, ["a", "b"]), (1, 1, ["c"]), (1, 2, ["d", "e", "f"])]
    made = spelling.combine_options(spark.createDataFrame(rows, "query_id int, slot int, choices array<string>"), 4)
    assert [r.suggestion for r in made.orderBy("place").collect()] == ["a c d", "a c e", "a c f", "b c d"]


def test_fallback_only_for_scarce_queries(index, ask):
    asked = ask("hyper spase", "hyper space")
    again = fallback_search(asked, exact_search(asked, index).totals, index)
    assert {r.query_id for r in again.totals.collect()} == {0}
    assert "a" in {r.bookmark_tag for r in again.tags.collect()}


@pytest.mark.parametrize("least, reported", [(4, {1}), (9, set())])
def test_gate_is_strict(index, ask, least, reported):
    report = search(ask("zzqqk", "hyper"), index, SearchParams(min_occur=least))
    assert {r.query_id for r in report.tags.collect()} == reported


def test_full_search_adds_both_kinds(index, ask):
    report = search(ask("hyper space"), index)
    exact = {r.bookmark_tag: r.score for r in exact_search(ask("hyper space"), index).tags.collect()}
    sounds = {r.bookmark_tag: r.score for r in phonetic_search(ask("hyper space"), index).tags.collect()}
    rows = report.tags.orderBy("place").collect()
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    for row in rows:
        assert row.score == pytest.approx(exact.get(row.bookmark_tag, 0) + sounds.get(row.bookmark_tag, 0), abs=2e-6)


def test_bm25_by_hand(index, ask):
    import math

    hit = {r.doc_id: r.score for r in match.match_phrase(ask("hyper"), index).collect()}
    lengths = {1: 7, 2: 6, 3: 2, 4: 4, 5: 4, 6: 4, 8: 8, 9: 2}
    mean = sum(lengths.values()) / 8
    idf = math.log(1 + (8 - 4 + 0.5) / 4.5)
    assert hit[1] == pytest.approx(idf * 2 / (2 + 1.2 * (0.25 + 0.75 * 7 / mean)))


def test_saved_index_reopens_and_appends(spark, index, ask):
    again = load_index(spark, index.path)
    assert (again.n_docs, again.n_tokens) == (index.n_docs, index.n_tokens)
    more = spark.createDataFrame([(1, "x", "alpha beta")], "doc_id bigint, bookmark_tag string, text string")
    path = fresh_path(spark, "append")
    save_index(more, path)
    with pytest.raises(ValueError):
        save_index(more, path, mode="append")
    grown = save_index(more.withColumn("doc_id", F.lit(2).cast("bigint")), path, mode="append")
    assert tuple(index_stats(grown).first()) == (2, 4, 2)
    assert set(docs(match.match_phrase(ask("alpha beta"), grown))) == {1, 2}
    with pytest.raises(FileNotFoundError):
        load_index(spark, fresh_path(spark, "nothing"))


def test_search_does_not_shuffle_postings(index, ask):
    """Postings meet their terms and each other without an exchange."""
    found = rank.combine(match.match_phrase(ask("hyper space"), index))
    plan = found._jdf.queryExecution().executedPlan().toString()
    tree = plan[: plan.index("tagseek_postings")]
    assert "Exchange hashpartitioning(query_id" not in tree.split("BroadcastHashJoin")[0]
    assert "Bucketed: true" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("bad", [{"slop": -1}, {"fuzzy_edits": 3}, {"max_search": 0}, {"per_term": 11}, {"boost_exact": -1.0}])
def test_bad_settings_raise(bad):
    with pytest.raises(ValueError):
        SearchParams(**bad)


def test_layout_is_bounded():
    from tagseek.sources.store import layout

    docs, terms = layout(100 << 40, 8)
    assert docs <= 8192 and 1 < terms <= 256
    assert layout(0, 8) == (8, 1)


def test_dictionary_follows_appends(spark):
    from tagseek.operators.spelling import build_dictionary, suggest_phrases
    from tagseek.session import fresh_path
    from tagseek.sources.store import load_index, save_index

    path = fresh_path(spark, "appended")
    rows = lambda *r: spark.createDataFrame(r, "doc_id bigint, text string")
    build_dictionary(save_index(rows((1, "alpha beta")), path, doc_buckets=2))
    save_index(rows((2, "hyperspace lane")), path, mode="append")
    asked = spark.createDataFrame([(1, "hyperspase")], "query_id bigint, phrase string")
    assert [r["suggestion"] for r in suggest_phrases(asked, load_index(spark, path)).collect()] == ["hyperspace"]


def test_many_queries_still_open_their_folders_only(spark, index):
    words = [(i, f"word{i}") for i in range(2000)] + [(2000, "hyper")]
    asked = spark.createDataFrame(words, "query_id bigint, phrase string")
    found = match.match_term(asked, index)
    assert {r["query_id"] for r in found.select("query_id").distinct().collect()} == {2000}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "term_bucket" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_top_n_is_cut_before_the_exchange(spark):
    hits = spark.createDataFrame([(1, i, float(i)) for i in range(50)], "query_id bigint, doc_id bigint, score double")
    plan = rank.top_n(hits.repartition(4), 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_fuzzy_words_are_not_capped(spark):
    from tagseek.operators.clauses import expand_fuzzy

    terms = [("a" + x + y, 0, 1) for x in "bcdefghijk" for y in "bcdefghijk"]
    vocabulary = spark.createDataFrame(terms, "term string, term_bucket int, df int")
    words = spark.createDataFrame([("abb",)], "word string")
    assert expand_fuzzy(words, vocabulary, 2).count() == len(terms)


def test_patterns_without_letters_and_many_heads(spark):
    from tagseek.operators.clauses import expand_patterns

    vocabulary = spark.createDataFrame([(f"w{i:03d}x", 0) for i in range(300)] + [("ab", 0)], "term string, n int")
    patterns = spark.createDataFrame([("*",), ("??",)] + [(f"w{i:03d}*",) for i in range(200)] + [("*9x",)], "pattern string")
    found = expand_patterns(patterns, vocabulary).groupBy("pattern").count()
    counts = {r["pattern"]: r["count"] for r in found.collect()}
    assert counts["*"] == 301 and counts["??"] == 1 and counts["*9x"] == 30 and counts["w007*"] == 1 and len(counts) == 203


def test_an_index_of_sounds_only(spark, ask):
    from tagseek.sources.store import load_index

    rows = lambda *r: spark.createDataFrame(r, "doc_id bigint, text string")
    path = fresh_path(spark, "sounds")
    save_index(rows((1, "Knight of the night")), path, doc_buckets=2, fields=("sound",))
    index = save_index(rows((2, "nite watch")), path, mode="append")
    assert {r["field"] for r in load_index(spark, path).postings.select("field").distinct().collect()} == {"sound"}
    assert set(docs(match.match_phonetic(ask("nite"), index))) == {1, 2} and index.n_docs == 2


def test_details_and_suggestions_tell_more(spark):
    rows = [(1, "t", "hyperspace lane", "f1"), (2, "t", "hyperspace", "f2")]
    index = save_index(spark.createDataFrame(rows, "doc_id bigint, bookmark_tag string, text string, filename string"), fresh_path(spark, "more"), doc_buckets=2)
    asked = spark.createDataFrame([(1, "lane"), (2, "hyperspase")], "query_id bigint, phrase string")
    found = exact_search(asked, index)
    assert [(r["query_id"], r["filename"]) for r in found.details("filename").collect()] == [(1, "f1")]
    each = fallback_search(asked, found.totals, index).each
    assert {(r["query_id"], r["total_hits"]) for r in each.totals.collect()} >= {("hyperspace", 2)}
    assert {(r["query_id"], r["bookmark_tag"]) for r in each.tags.collect()} >= {("hyperspace", "t")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_terms_beyond_the_broadcast_limit_move_no_postings(spark, index, ask):
    phrases = ["hyper space", "to be", "of the", "hyper", "night", "be", "space", "the"] + ["hyper"] * 40
    expected = sorted(match.match_phrase(ask(*phrases), index, slop=1).collect())
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1000"):
        found = match.match_phrase(ask(*phrases), index, slop=1)
        plan = plan_of(found)
        assert sorted(found.collect()) == expected and len(expected) > 80
    assert plan.count("tagseek_postings") > 3 and "Exchange hashpartitioning(term" not in plan and "SortMergeJoin" not in plan


def test_blocks_of_terms_do_not_grow_in_number(spark, index, monkeypatch):
    # 38,000 terms once went in 44 blocks, each with jobs of its own and a scan of all buckets
    terms = settle(spark.range(500).select(F.lit("exact").alias("field"), F.lit(0).alias("term_bucket"), F.concat(F.lit("w"), "id").alias("term"), F.col("id").alias("query_id")))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1000"):
        plan = plan_of(store.probe_terms(index.postings, terms))
    assert 1 < plan.count("BroadcastHashJoin") <= 2 * store.BLOCKS


def test_phrases_go_by_their_rarest_words(spark, monkeypatch):
    texts = ["a b a b c", "b a", "a-b c", "a b", "c b a b", "a a", "b", "a-b-c a b c", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    held = save_index(docs, fresh_path(spark, "rarest"), doc_buckets=3, fields=("exact",))
    phrases = ["a b", "b c", "a b c", "a a", "c", "z a", "a b", "c b a b", "", None]
    rows = [*enumerate(phrases), (0, "a b"), (1, "c b"), (2, "a b"), (None, "a b")]  # ids may repeat or be null
    asked = spark.createDataFrame(rows, "query_id bigint, phrase string")
    ways = (lambda q: match.match_phrase(q, held), lambda q: match.match_phrase(q, held, slop=2, width=True), lambda q: match.match_hyphenated(q, held))
    former = [sorted(way(asked).collect()) for way in ways]
    assert {(r["query_id"], r["doc_id"]): r["freq"] for r in former[0]}[6, 0] == 2.0
    monkeypatch.setattr(match, "GATHERED", 0)
    assert [sorted(way(asked).collect()) for way in ways] == former
    # pairs: nothing but the rarest word's postings is gathered, and neither side moves
    pairs = spark.createDataFrame([(0, "a b"), (1, "b c")], "query_id bigint, phrase string")
    plans = []
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1"):
        monkeypatch.setattr(match, "settle", lambda df, label: plans.append(plan_of(df)) or settle(df, label))
        found = match.match_phrase(pairs, held)
        assert {(r["query_id"], r["doc_id"]) for r in found.collect()} == {(0, 0), (0, 2), (0, 3), (0, 4), (0, 7), (1, 0), (1, 2), (1, 7)}
    assert "SortMergeJoin" in plans[-1] and "Exchange hashpartitioning" not in plans[-1] and "collect_list" not in plans[-1]
    monkeypatch.setattr(match, "TOGETHER", 2000)
    assert sorted(match.match_phrase(asked, held).collect()) == former[0]


def test_clauses_of_one_term_are_not_gathered(spark, monkeypatch):
    # 64 million hits of 0.1 GB were shuffled and put in lists of one, 651 of 865 task seconds
    texts = ["a b a b c", "b a", "a-b c", "ab abb", "c b a b", "a a", "b", "", None, " ".join("abcde" * 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    held = save_index(docs, fresh_path(spark, "lone"), doc_buckets=3, fields=("exact",))
    words = [*enumerate(["a", "b", "c", "z", "a", "a b", "", None])]
    rows = [*words, (0, "a"), (1, "c"), (None, "a")]  # ids may repeat or be null; then they are clauses of several terms
    asked = spark.createDataFrame(rows, "query_id bigint, phrase string")
    mixed = expand_queries(spark.createDataFrame([*enumerate(["a", "b~", "ab*", "abb*", "a b", "c", "c", "?", "a b* c~"]), (5, "c")], "query_id bigint, phrase string"))
    rough = SearchParams(coarse_lengths=True)
    ways = (
        lambda: match.match_term(asked, held),
        lambda: match.match_phrase(asked, held, slop=2, width=True),
        lambda: match.match_clauses(mixed, held, params=rough),
    )
    former = [sorted(way().collect(), key=str) for way in ways]
    freqs = {(r["query_id"], r["doc_id"]): r["freq"] for r in former[0]}
    assert freqs[0, 0] == 4.0 and freqs[4, 0] == 2.0 and freqs[1, 2] == 2.0 and freqs[2, 9] == 30.0 and (None, 0) not in freqs
    assert {r["clause"] for r in former[2]} >= {"phrase", "fuzzy:0", "wildcard", "prefix", "hyphen"}
    monkeypatch.setattr(match, "GATHERED", 0)
    assert [sorted(way().collect(), key=str) for way in ways] == former
    alone = spark.createDataFrame(words, "query_id bigint, phrase string")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="300"):
        found = match.match_term(alone, held)
        assert sorted((r["query_id"], r["doc_id"], r["freq"]) for r in found.collect() if r["query_id"] == 4) == [(4, 0, 2.0), (4, 1, 1.0), (4, 2, 1.0), (4, 4, 1.0), (4, 5, 2.0), (4, 9, 30.0)]
    assert plan_of(found).count("tagseek_postings") > 1 and not any(x in plan_of(found) for x in ("Exchange hashpartitioning", "collect_list", "Generate", "positions"))


def test_blocks_of_terms_hold_each_row_once(spark):
    rows = [(q, f"w{q % 50:02d}" if q % 3 else "hot", q % 4) for q in range(600)]
    terms = spark.createDataFrame(rows, "query_id bigint, term string, term_bucket int")
    blocks = term_blocks(terms, 2000)
    parts = [terms.where(of_terms).collect() for _, of_terms in blocks]
    assert sorted(r for part in parts for r in part) == sorted(tuple(r) for r in rows)
    assert len(parts) > 20 and max(map(len, parts)) < 150
    for (of_postings, _), part in zip(blocks, parts):
        asked = {(r["term_bucket"], r["term"]) for r in part}
        assert asked <= {(r["term_bucket"], r["term"]) for r in terms.where(of_postings).collect()}


@pytest.fixture(scope="module")
def many_records(spark):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("bookmark_tag"), F.concat(F.lit("text "), "id").alias("text"))
    return save_index(rows, fresh_path(spark, "many"), doc_buckets=32, fields=("exact",))


def test_lookups_of_many_records_open_their_buckets_only(spark, many_records):
    ids = many_records.documents.where(F.pmod(F.hash("doc_id"), F.lit(32)) < 27).select("doc_id")
    top = settle(ids.select(F.lit(1).alias("query_id"), "doc_id", F.lit(1.0).alias("score"), F.col("doc_id").cast("int").alias("rank")))
    assert top.count() > 4800
    found = rank.hit_details(top, many_records.documents, buckets=many_records.doc_buckets)
    with settings(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):  # the plan then tells
        told = rank.hit_details(top, many_records.documents, buckets=many_records.doc_buckets)
        assert "SelectedBucketsCount: 27 out of 32" in plan_of(told)
    assert found.where(F.col("text") == F.concat(F.lit("text "), "doc_id")).count() == top.count()


def test_lookups_beyond_all_lists_move_no_records(spark, many_records, monkeypatch):
    monkeypatch.setitem(store.LISTED, "doc_id", 100)
    top = settle(many_records.documents.where("doc_id % 3 = 0").select(F.lit(1).alias("query_id"), "doc_id", F.lit(1.0).alias("score"), F.lit(1).alias("rank")))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1000"):
        found = rank.hit_details(top, many_records.documents, buckets=many_records.doc_buckets)
        plan = plan_of(found)
        assert found.count() == 2000
    records = plan[: plan.index("tagseek_documents")].split("SortMergeJoin")[1]
    assert "Bucketed: true" in plan and "Exchange" not in records[: records.index("FileScan")]


def test_ranges_of_keys_let_all_of_them_pass(spark, monkeypatch):
    monkeypatch.setattr(store, "LISTED_TERMS", 20)
    wanted = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("term"))
    assert wanted.where(store.key_filter(wanted, "term")).count() == 3000
    few = wanted.where("term < 'w1010'")
    assert wanted.where(store.key_filter(few, "term")).count() == few.count()
    assert wanted.where(store.key_filter(few.where("false"), "term")).count() == 0


def test_best_hits_in_one_pass(spark):
    rows = [(q, d, float((d * 7 + q) % 11)) for q in range(30) for d in range(-40, 40 + q)]
    hits = spark.createDataFrame(rows, "query_id bigint, doc_id bigint, score double").repartition(6)
    found = rank.best_hits(hits, 7)
    assert "partial_collect_top_k" in plan_of(found) and plan_of(found).count("Scan ExistingRDD") == 1
    assert sorted(found.collect()) == sorted(rank.top_n(hits, 7).collect())


def test_a_search_scans_postings_once(index, ask):
    found = rank.best_hits(rank.combine(match.match_phrase(ask("hyper space"), index)), 10)
    assert plan_of(found).count("tagseek_postings") == 1


def test_both_fields_in_one_pass(index, ask, monkeypatch):
    """A full search matches words and sounds together, and finds what two searches find."""
    from tagseek.plans import search as plans

    matched = []

    def spied(*args, **kwargs):
        matched.append(match.match_clauses(*args, **kwargs))
        return matched[-1]

    asked = ask("hyper space", "nite", "knight of the night", "to be", "thou*", "space~", "zzz")
    apart = exact_search(asked, index), phonetic_search(asked, index)
    monkeypatch.setattr(plans, "match_clauses", spied)
    report = plans.search(asked, index, SearchParams(fallback_below=0))
    assert len(matched) == 1 and plan_of(matched[0]).count("tagseek_postings") == 1
    for ours, theirs in zip((report.exact, report.phonetic), apart):
        for name in ("hits", "tags", "totals"):
            columns = sorted(getattr(theirs, name).columns)
            assert sorted(getattr(ours, name).select(columns).collect()) == sorted(getattr(theirs, name).select(columns).collect())
    assert report.exact.hits.count() > 0 < report.phonetic.hits.count()


def test_words_with_enough_suggestions_meet_no_ngrams(spark):
    """Suggestions by saved keys are those of all n-grams, from far fewer pairs."""
    rng = random.Random(5)
    stems = ["".join(rng.choice("aeiorstlnm") for _ in range(n)) for n in (3, 4, 5, 6, 7, 8, 9) for _ in range(40)]
    bent = [w[:k] + rng.choice("aeiorstlnm") + w[k + 1 :] for w in stems for k in (0, 1, 2)]
    documents = spark.createDataFrame([(i, w) for i, w in enumerate(stems + bent)], "doc_id bigint, text string")
    index = save_index(documents, fresh_path(spark, "spelled"), doc_buckets=2, term_buckets=3)
    dictionary = spelling.build_dictionary(index)
    words = spark.createDataFrame([(w[:-1] + "x",) for w in stems[::2]] + [("zzzzz",), ("ab",), ("x",)], "word string")
    plain = spelling.suggest_similar(words, dictionary, 2, index.term_buckets)
    kept = spelling.suggest_similar(words, dictionary, 2, index.term_buckets, index)
    assert sorted(plain.collect()) == sorted(kept.collect()) != []
    every = spelling._gram_pairs(words, dictionary, index.term_buckets)
    met = {(r["word"], r["term"]) for r in every.collect()}
    assert len(met) == every.count()
    gram_sets = dictionary.groupBy("term").agg(F.collect_set("gram").alias("grams")).collect()
    own = {r["word"]: set(r["g"]) for r in words.select("word", spelling.grams(F.col("word")).alias("g")).collect()}
    near = lambda a, b: a != b and abs(len(a) - len(b)) * 2 <= max(len(a), len(b))
    assert met == {(w, r["term"]) for w, g in own.items() for r in gram_sets if g & set(r["grams"]) and near(w, r["term"])}
    close = spelling._close_pairs(words, index)
    counts = {r["word"]: r["count"] for r in close.groupBy("word").count().collect()}
    longest = [w for w in counts if len(w) >= 8 and counts[w] >= 2]
    # 151 pairs in place of 988; the larger the vocabulary, the further apart
    assert longest and 5 * sum(counts[w] for w in longest) <= sum(w in longest for w, _ in met)


def test_failed_appends_are_never_read(spark, ask, monkeypatch):
    """A writer that dies between records and postings, readers beside it, and its retry."""
    rows = lambda *r: spark.createDataFrame(r, "doc_id bigint, text string")
    path = fresh_path(spark, "batches")
    first = save_index(rows((1, "alpha beta")), path, doc_buckets=2)
    made = store.build_postings

    def dies(*args):
        raise OSError("lost")

    monkeypatch.setattr(store, "build_postings", dies)
    with pytest.raises(OSError):
        save_index(rows((2, "alpha beta gamma")), path, mode="append")
    monkeypatch.setattr(store, "build_postings", made)
    for opened in (first, load_index(spark, path)):
        assert opened.documents.count() == 1 and set(docs(match.match_phrase(ask("alpha beta"), opened))) == {1}
    again = save_index(rows((2, "alpha beta gamma")), path, mode="append")
    assert again.documents.count() == 2 and set(docs(match.match_phrase(ask("alpha beta"), again))) == {1, 2}
    # whoever opened the index before still reads that state
    assert first.documents.count() == 1 and set(docs(match.match_phrase(ask("alpha beta"), first))) == {1}
    assert tuple(index_stats(first).first()) == (1, 2, 2) and tuple(index_stats(again).first()) == (2, 5, 3)


def test_compaction_keeps_every_result(spark, ask):
    rows = lambda *r: spark.createDataFrame(r, "doc_id bigint, text string")
    path = fresh_path(spark, "compacted")
    save_index(rows((1, "alpha beta"), (2, "beta")), path, doc_buckets=2, term_buckets=3)
    save_index(rows((3, "beta gamma")), path, mode="append")
    loose = save_index(rows((4, "alpha beta beta")), path, mode="append")
    whole = store.compact_index(spark, path)
    assert len(loose.batches) == 3 and len(whole.batches) == 1 and whole.version == loose.version + 1
    for ours, theirs in ((whole.documents, loose.documents), (whole.postings, loose.postings), (whole.vocabulary, loose.vocabulary)):
        columns = sorted(set(theirs.columns))
        assert sorted(ours.select(columns).collect(), key=str) == sorted(theirs.select(columns).collect(), key=str)
    assert match.match_phrase(ask("beta"), whole).count() == 4 and store.compact_index(spark, path).version == whole.version
    grown = save_index(rows((5, "beta")), path, mode="append")
    assert match.match_phrase(ask("beta"), grown).count() == 5


def test_two_writers_of_one_version(spark):
    rows = spark.createDataFrame([(1, "alpha")], "doc_id bigint, text string")
    path = fresh_path(spark, "writers")
    save_index(rows, path, doc_buckets=2)
    state = store._published(spark, path)
    store._publish(spark, path, state.but(version=9, writer="a"))
    with pytest.raises(RuntimeError):
        store._publish(spark, path, state.but(version=9, writer="b"))
    assert load_index(spark, path).version == 9


def test_another_session_reads_every_batch(spark, ask):
    rows = lambda *r: spark.createDataFrame(r, "doc_id bigint, text string")
    path = fresh_path(spark, "sessions")
    save_index(rows((1, "alpha")), path, doc_buckets=2)
    index = save_index(rows((2, "alpha")), path, mode="append")
    # a catalog that has never seen the tables, as another application's
    for table in ("documents", "postings"):
        spark.sql(f"DROP TABLE tagseek_{table}_{index.build_id}")
    store._known.clear()
    assert match.match_phrase(ask("alpha"), load_index(spark, path)).count() == 2


def test_similar_words_and_patterns_read_saved_keys(spark, ask):
    """Saved keys give what the vocabulary gives; an append adds the keys of new words only."""
    rows = lambda *r: spark.createDataFrame(r, "doc_id bigint, text string")
    path = fresh_path(spark, "lexicon")
    texts = ["thousand thou hour shout keitel", "nichts nicht licht dicht", "a ab abc éclair", "schönheit freiheit hhou"]
    first = save_index(rows(*enumerate(texts)), path, doc_buckets=2, term_buckets=3)
    patterns = spark.createDataFrame([(p,) for p in ("*hou*", "*heit", "t?ou*", "*o*", "??", "*", "*b", "*é*r", "*hh*", "*zz*")], "pattern string")
    words = spark.createDataFrame([(w,) for w in ("nihcts", "tohu", "a", "abcd", "freihet", "zzzzz")], "word string")

    def both(index):
        vocabulary = index.vocabulary.where(F.col("field") == "exact").drop("field")
        for made, kept, columns in (
            (expand_patterns(patterns, vocabulary), expand_patterns(patterns, vocabulary, index=index), ("pattern", "term", "df")),
            (expand_fuzzy(words, vocabulary, 2), expand_fuzzy(words, vocabulary, 2, index=index), ("word", "term", "df", "distance", "weight")),
            (expand_fuzzy(words, vocabulary, 1), expand_fuzzy(words, vocabulary, 1, index=index), ("word", "term", "df", "distance", "weight")),
        ):
            assert sorted(made.select(*columns).collect()) == sorted(kept.select(*columns).collect()) != []

    both(first)
    before = lexicon(first, "deletions").count()
    grown = save_index(rows((9, "nichts thouless")), path, mode="append")
    both(grown)
    both(first)
    added = lexicon(grown, "deletions").where("field = 'exact'").select("term").distinct().count()
    assert added == first.vocabulary.where("field = 'exact'").count() + 1
    assert lexicon(grown, "deletions").count() > before
    asked = spark.createDataFrame([("p", "(?s)^.*hou.*$", "hou", "inner")], "pattern string, regex string, key string, side string")
    plan = plan_of(words_of(grown, "exact", "grams", asked))
    assert "key_bucket" in plan.split("PartitionFilters:")[1].split("]")[0] and "EqualTo(key,hou)" in plan and "vocabulary" not in plan

"""Steps whose tasks must stay small however large the tables are."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tagseek.functions import inverted
from tagseek.functions.distance import deletion_keys
from tagseek.functions.sound import sound_code
from tagseek.operators import lexicon, spelling
from tagseek.operators.postings import build_phonetic_postings, build_postings
from tagseek.session import fresh_path, settings, settle
from tagseek.sources import store
from tagseek.sources.store import layout, save_index


def files_of(df):
    return df.select(F.input_file_name()).distinct().count()


def test_postings_of_a_bucket_fit_one_task():
    # postings take some 60 times a bucket's input while they are sorted
    for gb in (1, 6, 50):
        assert (gb << 30) / layout(gb << 30, 12)[0] * 60 < 1 << 30


def test_keys_of_a_vocabulary_are_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(store, "WORDS_PER_TASK", 50)
    letters = random.Random(3)
    words = {"".join(letters.choices("abcdefg", k=8)) for _ in range(400)}
    rows = spark.createDataFrame([(1, " ".join(sorted(words)))], "doc_id bigint, text string")
    index = save_index(rows, fresh_path(spark, "keys"), doc_buckets=2, fields=("exact",))
    assert files_of(index.vocabulary) == 1
    for kind in ("deletions", "grams"):
        made = lexicon.lexicon(index, kind)
        assert files_of(made) > 4
        assert made.select("term").distinct().count() == len(words)
    made = spelling.build_dictionary(index)
    assert files_of(made) > 4
    assert made.count() == spelling.dictionary_of(index.vocabulary).count()


def test_keys_are_made_of_the_field_asked_for_and_sorted_by_key_alone(spark, monkeypatch):
    # keys of sounds were made for every suggestion, and the sort's first column was the folder, equal in all rows
    sorts = []
    frame = type(spark.range(1))
    plain = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *columns: sorts.append(columns) or plain(self, *columns))
    rows = spark.createDataFrame([(1, "night knight nite"), (2, "day dais")], "doc_id bigint, text string")
    index = save_index(rows, fresh_path(spark, "fields"), doc_buckets=2)
    del sorts[:]
    asked = spark.createDataFrame([("nigt",), ("NFT",)], "key string")
    assert {r["term"] for r in lexicon.words_of(index, "exact", "deletions", asked).collect()} == {"night", "knight"}
    saved = spark.read.schema(lexicon.KEYS).parquet(f"{index.path}/{index.build_id}/lexicon/deletions")
    assert {r["field"] for r in saved.select("field").distinct().collect()} == {"exact"}
    dictionary = spelling.build_dictionary(index)
    assert sorts == [("key",), ("gram",)]
    assert dictionary.count() == spelling.dictionary_of(index.vocabulary.where("field = 'exact'")).count()
    # whoever asks for the other field gets its keys too, beside the first ones
    assert {r["field"] for r in lexicon.lexicon(index, "deletions").select("field").distinct().collect()} == {"exact", "sound"}
    assert {r["term"] for r in lexicon.words_of(index, "exact", "deletions", asked).collect()} == {"night", "knight"}
    # several folders: sorted by both, as files of several folders must be
    split = save_index(rows, fresh_path(spark, "fields"), doc_buckets=2, term_buckets=3)
    del sorts[:]
    assert {r["term"] for r in lexicon.words_of(split, "exact", "deletions", asked).collect()} == {"night", "knight"}
    assert sorts == [("key_bucket", "key")]


def test_spelling_builds_no_sounds(spark, tmp_path, monkeypatch):
    # every spelling query built the sound codes of the whole corpus, and read none of them
    import __spark_entry__ as entry
    from checks.inputs import corpus_index

    rows = [(i, "s", t) for i, t in enumerate(["which of because", "public domain of", None, "hyper-space"])]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    fields = lambda index: {r["field"] for r in index.postings.select("field").distinct().collect()}
    first = sorted(entry.spell_compounds(spark, str(tmp_path)).collect())
    words = corpus_index(spark, str(tmp_path), ("exact",))
    assert first and fields(words) == {"exact"}
    # where sounds are asked for too, one index of both serves all
    both = corpus_index(spark, str(tmp_path))
    assert both.path != words.path and fields(both) == {"exact", "sound"}
    again = corpus_index(spark, str(tmp_path), ("exact",))
    assert again.path == both.path and (again.n_docs, again.n_tokens) == (words.n_docs, words.n_tokens)
    assert sorted(entry.spell_compounds(spark, str(tmp_path)).collect()) == first

    class Asked(Exception):
        pass

    def asked(spark, sf_dir, fields=("exact", "sound")):
        raise Asked(*fields)

    monkeypatch.setattr(entry, "corpus_index", asked)
    for name, wanted in (("spell_final", ("exact",)), ("fallback_search", ("exact",)), ("full_search_slop2", ("exact", "sound"))):
        try:
            getattr(entry, name)(spark, str(tmp_path))
        except Asked as told:
            assert told.args == wanted


def test_many_words_build_no_sounds(spark, tmp_path, monkeypatch):
    # many_terms built the sound codes of the whole corpus, and read none of them
    import __spark_entry__ as entry

    spark.createDataFrame([(1, "s", "night by-nc Night"), (2, "s", None), (3, "t", "knight nc")], "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "NC night nc"), (8, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    opened = []
    plain = entry.corpus_index
    monkeypatch.setattr(entry, "corpus_index", lambda *a: opened.append(plain(*a)) or opened[-1])
    at = 7 << 32
    wanted = [(at, 1, 1), (at, 3, 1), (at + 1, 1, 2), (at + 2, 1, 1), (at + 2, 3, 1)]
    assert sorted(tuple(r) for r in entry.many_terms(spark, str(tmp_path)).collect()) == wanted
    assert {r["field"] for r in opened[0].postings.select("field").distinct().collect()} == {"exact"}


def test_deletion_keys_are_all_that_is_left(spark):
    words = ["", "a", "ab", "aaaa", "abcdefg", "abcdefgh", "éßab", "abababab"]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    for edits in (0, 1, 2):
        for word, keys in rows.select("word", deletion_keys(F.col("word"), edits)).collect():
            head = word[:7]
            left = {"".join(c for i, c in enumerate(head) if i not in gone) for n in range(edits + 1) for gone in itertools.combinations(range(len(head)), min(n, len(head)))}
            assert sorted(keys) == sorted(left)


def test_scan_filters_stay_small_enough_to_be_compiled(spark, monkeypatch):
    words = [f"w{i:05d}" for i in range(0, 4000, 2)]
    table = spark.createDataFrame([(w,) for w in (*words, "w00001", "a", "z", None)], "term string").repartition(1)
    asked = spark.createDataFrame([(w,) for w in words], "term string")
    for most in (1_000, 10_000):  # told as ranges only, and by name as well
        monkeypatch.setattr(store, "LISTED_TERMS", most)
        found = settle(table).where(store.key_filter(asked, "term"))
        assert {r.term for r in found.collect()} - {"w00001"} == set(words)
    with settings(spark, spark__sql__adaptive__enabled="false"):
        monkeypatch.setattr(store, "LISTED_TERMS", 1_000)
        plan = settle(table).where(store.key_filter(asked, "term"))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    # the JVM does not compile methods of 8,000 bytes and more
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < 8_000


def test_sounds_are_inverted_as_words_stand(spark):
    texts = ["Night knight the night", "", "a", None, "the The THE naïve nite 123 123"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(1)
    found = build_phonetic_postings(rows).collect()
    wanted = {}
    for doc, text in enumerate(texts):
        for place, word in enumerate((text or "").split()):
            wanted.setdefault((doc, sound_code(word)), []).append(place)
    assert {(r.doc_id, r.term): r.positions for r in found} == wanted
    assert all(r.field == "sound" and r.hyphens == [] and r.freq == len(r.positions) and r.dl == len(texts[r.doc_id].split()) for r in found)
    assert build_phonetic_postings(rows.where("text is null")).count() == build_phonetic_postings(rows.where("text = ''")).count() == 0
    # nothing is left of inverting codes one by one in the JVM
    plan = build_phonetic_postings(rows)._jdf.queryExecution().executedPlan().toString()
    assert "sound_entries" in plan and "sort_array" not in plan


def test_records_are_inverted_in_bounded_portions(spark, monkeypatch):
    import pyarrow as pa

    words = random.Random(5)
    rows = [[words.choice(["by-", "by", "nc", "a", "ß-"]) for _ in range(n)] for n in (0, 3, 40, 1, 0, 7, 200, 2)]
    rows = [*rows[:3], None, *rows[3:]]
    batch = pa.array(rows, pa.list_(pa.string()))
    named = lambda spelled: pa.array([w.rstrip("-") for w in spelled.to_pylist()], pa.string())
    whole = inverted.invert(batch, "exact", named, marked=True)
    for row, entries in zip(rows, whole.to_pylist()):
        if row is None:
            assert entries is None
            continue
        bare = [w.rstrip("-") for w in row]
        assert {e["term"]: e["positions"] for e in entries} == {t: [i for i, w in enumerate(bare) if w == t] for t in bare}
        assert {e["term"]: e["hyphens"] for e in entries} == {t: [i for i, w in enumerate(row) if w == t + "-"] for t in bare}
        assert len({e["term"] for e in entries}) == len(entries)
    monkeypatch.setattr(inverted, "STEP", 10)
    sizes = [len(part.flatten()) for part in inverted._portions(batch)]
    assert len(sizes) > 2 and sum(sizes) == len(batch.flatten()) and max(sizes) == 200
    key = lambda entries: entries and sorted(entries, key=lambda e: e["term"])
    assert [key(e) for e in inverted.invert(batch, "exact", named, marked=True).to_pylist()] == [key(e) for e in whole.to_pylist()]
    assert inverted.invert(batch.slice(0, 0), "exact", named).to_pylist() == []
    plan = build_postings(spark.createDataFrame([(1, "by-nc a")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "word_entries" in plan and "sort_array" not in plan


def test_postings_leave_a_batch_in_order(spark):
    # sorting 120 million rows that came record by record took 447 task seconds of the build of 0.51 GB
    letters = random.Random(4)
    rows = [(i, " ".join("".join(letters.choices("abcdé", k=2)) for _ in range(40))) for i in range(30)]
    made = build_postings(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), ("exact", "sound")).collect()
    keys = [(r["field"], r["term"].encode(), r["doc_id"]) for r in made]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_texts_are_split_once_for_both_fields(spark):
    texts = ["ΟΔΟΣ-ΑΒ ΟΔΟΣ\u00adΑ by-NC İX ẞs Ǆ", "ΣΑΣ. ΣΑΣ'Σ", "\ua7cba b \ua7dc-c", "Straße STRASSE Москва 12,5 A-b--c d-", "日本Ab-ぁ x_Y", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").coalesce(1)
    key = lambda r: (r["field"], r["term"], r["doc_id"], r["dl"], r["freq"], r["positions"], r["hyphens"])
    both = build_postings(rows, ("exact", "sound"))
    apart = build_postings(rows, ("exact",)).unionAll(build_postings(rows, ("sound",)))
    assert sorted(map(key, both.collect())) == sorted(map(key, apart.collect()))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2 and "rlike" in plan.lower()  # the second one only of texts whose lower case follows the context


def test_stable_order_of_large_numbers():
    for most in (1, 10, 1 << 16, 1 << 20, 1 << 40):
        ids = np.random.default_rng(5).integers(0, most, 3000)
        assert inverted.stable_order(ids).tolist() == np.argsort(ids, kind="stable").tolist()
    assert inverted.stable_order(np.empty(0, np.int64)).tolist() == []

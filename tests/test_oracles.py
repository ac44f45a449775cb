"""Registered queries against SQL, on the smallest tables where they allow it."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences, oracle_rows
from checks.inputs import PLACES

# Their word lists were made for sf0.01.
LARGER = {"phonetic_phrase", "phonetic_search", "phonetic_search_slop2", "full_search", "full_search_slop2"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    sf_dir = "/root/testdata/sf0.01" if name in LARGER else "/root/testdata/sf0.001"
    found = queries()[name](spark, sf_dir)
    sql = oracle_sql().get(name)
    if sql is None:
        assert found.count() > 0
    else:
        assert differences(found, sf_dir, sql) == []


def test_phonetic_postings_against_the_bundled_codec(spark):
    """Words and places from SQL, their codes from commons-codec."""
    sf_dir = "/root/testdata/sf0.001"
    names, rows = oracle_rows(sf_dir, oracle_sql()["exact_postings"])
    term, doc, pos = (names.index(c) for c in ("term", "doc_id", "pos"))
    codec = spark._jvm.org.apache.commons.codec.language.DoubleMetaphone()
    codes = {w: (codec.doubleMetaphone(w) or w).lower() for w in {r[term] for r in rows}}
    expected = sorted((codes[r[term]], r[doc], r[pos]) for r in rows)
    found = queries()["phonetic_postings"](spark, sf_dir).collect()
    # a word without a code stands for itself, in its own case
    assert sorted((r["term"].lower(), r["doc_id"], r["pos"]) for r in found) == expected


def test_every_pair_is_asked(spark):
    """Against the places of words that SQL gives, pair by pair."""
    sf_dir = "/root/testdata/sf0.001"
    names, words = oracle_rows(sf_dir, oracle_sql()["query_tokens"])
    query, slot, term = (names.index(c) for c in ("query_id", "slot", "term"))
    at = {(r[query], r[slot]): r[term] for r in words}
    names, rows = oracle_rows(sf_dir, oracle_sql()["exact_postings"])
    word, doc, pos = (names.index(c) for c in ("term", "doc_id", "pos"))
    text = {(r[doc], r[pos]): r[word] for r in rows}
    where = {}
    for (d, p), first in text.items():
        if (d, p + 1) in text:
            found = where.setdefault((first, text[d, p + 1]), {})
            found[d] = found.get(d, 0) + 1
    pairs = {q * PLACES + s: (w, at[q, s + 1]) for (q, s), w in at.items() if (q, s + 1) in at}
    expected = sorted((q, d, n) for q, pair in pairs.items() for d, n in where.get(pair, {}).items())
    assert sorted(tuple(r) for r in queries()["every_phrase"](spark, sf_dir).collect()) == expected
    assert any(q % 2 for q, _, _ in expected)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())

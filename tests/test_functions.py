import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagseek.functions.distance import deletion_keys, swap_distance
from tagseek.functions.scoring import coarse_length
from tagseek.functions.sound import sound_code
from tagseek.functions.sweep import sloppy_widths
from tagseek.functions.tokens import cased_words, words, words_and_hyphens


@pytest.mark.parametrize(
    "word, code",
    [
        ("hyper", "HPR"), ("space", "SPS"), ("skywalker", "SKLK"), ("Vader", "FTR"), ("knight", "NT"), ("thought", "0T"),
        ("schmidt", "XMT"), ("it's", "ATS"), ("über", "PR"), ("naïve", "NF"), ("çouelle", "SL"), ("ß", "S"), ("a", "A"),
        ("TIE", "T"), ("123", "123"), ("Éé", "Éé"),
    ],
)
def test_sound_code(word, code):
    assert sound_code(word) == code


def test_sound_codes_equal_the_bundled_codec(spark):
    """Every word of the corpus, and made-up ones, against commons-codec."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spelled = {r[0] for r in rows.select(F.explode(cased_words(F.col("text")))).distinct().collect()}
    pick = random.Random(3)
    spelled |= {"".join(pick.choices("ABCDEGHIJKLMNORSTUWXYZÇ", k=pick.randint(1, 9))) for _ in range(5000)}
    codec = spark._jvm.org.apache.commons.codec.language.DoubleMetaphone()
    wrong = [w for w in spelled if sound_code(w) != (codec.doubleMetaphone(w) or w)]
    assert not wrong


def test_words(spark):
    text = "It's O’Neil's 3.14 or 1,000 at e.g. x_y a.1 — BY-NC «Été» 字あ ok"
    row = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    found = [r[0] for r in row.select(words(F.col("text"))).collect()]
    assert found[0] == ["it's", "o’neil's", "3.14", "or", "1,000", "at", "e.g", "x_y", "a", "1", "by", "nc", "été", "字", "あ", "ok"]
    assert found[1] is None and found[2] == []
    glued = row.select(words_and_hyphens(F.col("text"))).first()[0]
    assert [w for w in glued if w.endswith("-")] == ["by-"]


def test_swap_distance():
    assert swap_distance("ab", "ba") == 1
    assert swap_distance("ca", "abc") == 3
    assert swap_distance("é", "e") == 1
    assert swap_distance("", "abc") == 3


def test_close_words_share_a_deletion_key(spark):
    pick = random.Random(5)
    made = ["".join(pick.choices("abc", k=pick.randint(1, 11))) for _ in range(120)]
    keys = spark.createDataFrame([(w,) for w in made], "w string").select("w", deletion_keys(F.col("w"), 2).alias("k")).collect()
    for a, b in itertools.combinations(keys, 2):
        if swap_distance(a.w, b.w) <= 2:
            assert set(a.k) & set(b.k), (a.w, b.w)


@pytest.mark.parametrize(
    "slots, widths",
    [
        ([[2, 4, 5], [3, 4]], [1, 0]),
        ([[0, 4, 9, 10], [1, 4, 6], [4]], [0, 2]),
        ([[6], [2, 4, 5], [4, 7], [2, 3, 4, 10]], [2]),
    ],
)
def test_sloppy_windows(slots, widths):
    assert sloppy_widths(slots, 2, apart=False) == widths


def test_repeated_words_need_places_of_their_own():
    # "to to" against one "to", then against two in a row
    assert sloppy_widths([[4], [3]], 2) == []
    assert sloppy_widths([[4, 5], [3, 4]], 0) == [0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=6), min_size=2, max_size=3))
def test_sweep_agrees_with_brute_force(sets):
    # distinct words: no place in the text belongs to two slots
    taken, slots = set(), []
    for s, places in enumerate(sets):
        own = sorted(p for p in places if p not in taken)
        taken.update(own)
        slots.append([p - s for p in own])
    if not all(slots):
        return
    tightest = min(max(c) - min(c) for c in itertools.product(*slots))
    found = sloppy_widths(slots, 100)
    assert min(found) == tightest
    assert set(sloppy_widths(slots, 3)) <= set(range(4))
    exact = len(set.intersection(*map(set, slots)))
    assert sloppy_widths(slots, 0).count(0) == exact


def test_coarse_length(spark):
    df = spark.range(1, 200).select(F.col("id").cast("int").alias("n"), coarse_length(F.col("id").cast("int")).alias("c"))
    got = dict((r.n, r.c) for r in df.collect())
    assert all(got[n] == n for n in range(1, 41))
    assert got[41] == 40 and got[42] == 42 and got[100] == 96


def test_pair_windows_equal_the_sweep(spark):
    import random

    from tagseek.functions.sweep import apart, pair_windows, sloppy_widths

    r = random.Random(8)
    rows = []
    for i in range(400):
        slots = [sorted(r.sample(range(25), r.randint(0, 6))) for _ in range(2)]
        rows.append((i, slots))
    made = spark.createDataFrame(rows, "i int, slots array<array<int>>").select("i", apart(F.col("slots")).alias("apart"), pair_windows(F.col("slots"), F.lit(3)).alias("w"))
    found = {x.i: x for x in made.collect()}
    for i, slots in rows:
        assert found[i].apart == (not set(slots[0]) & {p + 1 for p in slots[1]})
        if found[i].apart:
            widths = sloppy_widths(slots, 3)
            assert abs(found[i].w.freq - sum(1 / (1 + w) for w in widths)) < 1e-9 and found[i].w.width == min(widths, default=None)

import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagseek.llm import langid, quality, toxicity
from tagseek.llm.toxicity import segments


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled(spark, prose):
    bad = ["vile", "rotten", "filth"]
    rows, labels = [], []
    for i in range(300):
        toxic, noisy = i % 4 == 0, i % 3 == 0
        words = prose(30, i).split()
        if toxic:
            words[5:5] = [bad[i % 3], bad[(i // 3) % 3]]
        rows.append((i, " ".join(w + ("###" if noisy else "") for w in words)))
        labels.append((i, int(not noisy), int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_held_out_rows_are_predicted(labelled, name):
    docs, labels = labelled
    found = (quality if name == "quality" else toxicity).classify(docs, labels)
    rows = found.join(labels, "doc_id").collect()
    assert len(rows) == 300
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows)
    rest = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r[name] for r in rest) / len(rest) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_change_nothing(labelled):
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in quality.classify(docs, x).collect()) for x in (labels, turned))
    assert a == b


@pytest.mark.parametrize("work", [quality.classify, toxicity.classify])
def test_edges(work, edge_documents, no_documents, no_labels, labelled):
    found = work(edge_documents, labelled[1]).collect()
    assert len(found) == edge_documents.count() and all(0 <= r["score"] <= 1 for r in found)
    assert {r["score"] for r in work(edge_documents, no_labels).collect()} == {0.5}
    assert work(no_documents, no_labels).collect() == []
    assert work(no_documents, labelled[1]).collect() == []


def test_descent_against_a_plain_solver(spark, prose):
    """Dual coordinate descent reaches the optimum that projected gradient steps on the whole matrix reach, and scores are its plane's."""
    import numpy as np

    texts = [prose(12, i) + (" ### !!" if i % 3 == 0 else "") + (" ##" if i % 7 == 0 else "") for i in range(50)]
    y = np.array([int(i % 3 != 0 or i % 10 == 9) for i in range(50)])
    rows = [quality.features(p)[1] for t in texts for p in quality.bw.slices(pa.array([t]))]
    ratios = quality._log_ratios(rows, y)
    weights, bias = quality._descend(rows, y, ratios, 1.0, 2000)

    dense = np.zeros((50, 1 << quality.BITS), np.float32)
    for k, f in enumerate(rows):
        dense[k, f] = ratios[f] / max(1.0, np.sqrt((ratios[f].astype(float) ** 2).sum()))
    sign = np.where(y == 1, 1.0, -1.0)
    gram = (dense @ dense.T + 1.0) * np.outer(sign, sign)
    ceiling = 50 / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    alpha, step = np.zeros(50), 1 / np.linalg.eigvalsh(gram.astype(float)).max()
    for _ in range(50_000):
        alpha = np.clip(alpha + step * (1 - gram @ alpha), 0, ceiling)
    plain = (dense @ dense.T + 1.0) @ (alpha * sign)
    ours = dense @ weights + bias
    assert np.abs(ours - plain).max() < 0.02
    margins = quality._margins(rows, range(50), weights * ratios, ratios**2, bias)
    assert np.abs(margins - ours).max() < 1e-3
    model = quality.Model((weights * ratios).astype(np.float32), (ratios**2).astype(np.float32), bias, 1.0, 0.0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    scores = np.array([r["score"] for r in quality.score(docs, model).orderBy("doc_id").collect()])
    assert np.abs(scores - 1 / (1 + np.exp(-margins))).max() < 1e-4


def test_passages_are_found(labelled):
    docs, labels = labelled
    by_id = {r["doc_id"]: r for r in toxicity.classify(docs, labels).join(docs, "doc_id").collect()}
    row = by_id[4]
    assert any("vile" in row["text"].encode()[p["start"] : p["end"]].decode() or "rotten" in row["text"] for p in row["passages"])
    assert not by_id[1]["passages"]


def test_segments_equal_brute_force():
    import random

    def brute(scores):
        """The best run first, then the same left and right of it."""
        best = max(((sum(scores[a:b]), a - b, -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        a, b = -best[2], best[3]
        return brute(scores[:a]) + [(a, b, best[0])] + [(x + b, y + b, s) for x, y, s in brute(scores[b:])]

    r = random.Random(0)
    for _ in range(300):
        scores = [r.choice([-3, -2, -1, 1, 2, 4]) + r.random() / 100 for _ in range(r.randint(0, 14))]
        sums = [sum(scores[:i]) for i in range(len(scores) + 1)]
        at = [i for i, s in enumerate(scores) if s > 0]
        found = segments([x for i in at for x in (sums[i], sums[i + 1])], at, len(scores))
        # a segment ends with its last positive word
        assert [(a, b) for a, b, _ in sorted(found)] == [(a, b) for a, b, _ in brute(scores)]


def test_languages(spark, prose):
    rows = [(i, prose(40, i, lang), None if i % 7 == 0 else lang) for i in range(200) for lang in [("aa", "bb")[i % 2]]]
    mixed = prose(60, 900, "aa") + " " + prose(200, 901, "bb")
    docs = spark.createDataFrame([*rows, (500, mixed, None), (501, "12 …", "aa"), (502, None, "aa"), (503, "", None)], "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert all(found[i]["lang_pred"] == ("aa", "bb")[i % 2] for i in range(200))
    assert found[500]["lang_pred"] == "bb" and [s["lang"] for s in found[500]["spans"]] == ["aa", "bb"]
    assert [found[i]["lang_pred"] for i in (501, 502, 503)] == ["und"] * 3


def test_language_edges(edge_documents, no_documents):
    found = langid.identify(edge_documents).collect()
    assert len(found) == edge_documents.count() and {r["lang_pred"] for r in found} == {"und"}
    assert langid.identify(no_documents).collect() == []


def test_scripts_narrow(spark):
    docs = spark.createDataFrame([(i, t, g) for i in range(40) for t, g in [("кот дом лес", "ru"), ("cat home wood", "en")]], "doc_id bigint, text string, lang string")
    docs = docs.withColumn("doc_id", F.col("doc_id") * 2 + (F.col("lang") == "en").cast("int"))
    asked = spark.createDataFrame([(1, "щука", None), (2, "zebra", None)], "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.label(asked, langid.fit(docs)).collect()}
    assert found == {1: "ru", 2: "en"}


def test_viterbi_shortcut_equals_full_search():
    import numpy as np

    r = np.random.default_rng(1)

    def full(scores, switch):
        value, back = scores[0].copy(), []
        for s in scores[1:]:
            options = value[:, None] - switch * (1 - np.eye(len(value)))
            back.append(options.argmax(axis=0))
            value = options.max(axis=0) + s
        path = [int(value.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        return path[::-1]

    for _ in range(200):
        scores = r.normal(size=(r.integers(1, 30), 3)) * 3
        own = langid.viterbi(scores, 5.0).tolist()
        worth = lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 5.0 * sum(a != b for a, b in zip(p, p[1:]))
        assert abs(worth(own) - worth(full(scores, 5.0))) < 1e-9


def test_segments_of_a_very_long_text_in_linear_time():
    import random
    import time

    r = random.Random(4)
    scores, sums = [], [0.0]
    for _ in range(100_000):
        scores += [r.random(), -1.0 - r.random()]  # sums fall all along
    for x in scores:
        sums.append(sums[-1] + x)
    at = list(range(0, len(scores), 2))
    began = time.process_time()
    found = segments([x for i in at for x in (sums[i], sums[i + 1])], at, len(scores))
    assert time.process_time() - began < 2 and len(found) == 100_000


def test_one_row_of_an_id_is_learned_from(spark):
    from tagseek.llm.labelled import training_rows

    documents = spark.createDataFrame([(3, f"text {i}") for i in range(500)] + [(4, "own")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(3, 1), (4, 0)], "doc_id bigint, toxic int")
    rows = sorted(tuple(r) for r in training_rows(documents, labels, "toxic", 10).collect())
    assert rows == [(3, "text 0", 1), (4, "own", 0)] or len(rows) < 2  # ids of the held-out fold are never learned from


def test_unit_odds_do_not_depend_on_slices(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from tagseek.llm import toxicity

    r = np.random.default_rng(5)
    texts = [" ".join(r.choice(["vile", "vilest", "good", "goods", "stone", "river", "x"], 3)) for _ in range(300)]
    y = np.array([int("vile" in t) for t in texts])
    whole = toxicity._unit_odds(pa.array(texts, pa.large_string()), y)
    monkeypatch.setattr(toxicity, "WORDS", 3)
    parts = toxicity._unit_odds(pa.array(texts, pa.large_string()), y)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts)) and len(whole[0])

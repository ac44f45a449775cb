"""Near duplicates of texts and vectors, components, and the pipeline, against brute force."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tagseek.llm import embedding_dedup, near_dedup
from tagseek.llm.components import connected_components
from tests.llm.conftest import extra_columns


def components(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    r = random.Random(0)
    links = [(i, i + 1) for i in range(40)] + [(r.randint(100, 300), r.randint(100, 300)) for _ in range(90)] + [(1000, 1000 + i) for i in range(200)]
    found = {x["id"]: x["component"] for x in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    expected = components({x for e in links for x in e}, links)
    assert found == {n: c for n, c in expected.items() if n in found} and all(n in found for a, b in links if a != b for n in (a, b))
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def shingles(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()


def near(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and b and 100 * len(a & b) >= 75 * len(a | b)]
    found = components([i for i, _ in docs], links)
    return sorted((i, len(s), found[i], found[i] == i) for i, s in sets)


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates(spark, prose, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "GROUP", block)
    r = random.Random(7)
    docs = []
    for c in range(6):
        base = prose(60 + 20 * c, c).split()
        for _ in range(14):
            own = list(base)
            for _ in range(r.randint(0, 6)):
                own[r.randrange(len(own))] = "x" + str(r.randint(0, 99))
            docs.append(" ".join(own))
    chain = prose(120, 50).split()  # each near the next one only
    for k in range(12):
        docs.append(" ".join(chain[: 120 - 0] if k == 0 else chain[k * 8 :] + prose(k * 8, 60).split()))
    docs += [docs[0]] * 5 + [docs[3].upper(), "", None, "one two", "ONE  two", "one"]
    r.shuffle(docs)
    rows = list(enumerate(docs))
    found = near_dedup.groups(extra_columns(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert sorted(tuple(x) for x in found.collect()) == near(rows)


def test_near_duplicate_edges(edge_documents, no_documents):
    assert near_dedup.groups(no_documents).collect() == []
    found = near_dedup.groups(edge_documents).collect()
    assert len(found) == edge_documents.count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[2]["component_id"] == 1 and by_id[8]["component_id"] == 7 and by_id[3]["n_shingles"] == by_id[5]["n_shingles"] == 0


def test_rows_that_repeat_an_id(spark, prose):
    a, b = prose(30, 1), prose(30, 2)
    rows = [(5, a), (5, b), (7, b), (9, a), (None, a), (None, prose(30, 3)), (5, a)]
    found = near_dedup.groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((x["doc_id"] or 0, x["component_id"] or 0, x["kept"]) for x in found) == [
        (0, 0, False), (0, 5, False), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False),
    ]
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (7, [0.0, 2.0]), (9, [3.0, 0.0])]
    found = embedding_dedup.groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert sorted((x["vec_id"], x["n_links"], x["component_id"]) for x in found) == [(5, 1, 5), (5, 1, 5), (7, 1, 5), (9, 1, 5)]


def test_similarity_estimate():
    r = np.random.default_rng(3)
    for share in (0.5, 0.75, 0.9):
        n = 400
        common = round(2 * n * share / (1 + share))
        errors = []
        for _ in range(20):
            x = r.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
            a, b = x[:n], np.concatenate([x[:common], x[n : 2 * n - common]])
            made = near_dedup.registers(np.concatenate([a, b]), np.array([0, n, 2 * n]))
            errors.append(float(near_dedup.likeliest(made[:1], made[1:], np.array([n]), np.array([n]))[0]) - share)
        assert abs(np.mean(errors)) < 0.04 and np.max(np.abs(errors)) < near_dedup.MARGIN


def test_sketches_merge(prose):
    r = np.random.default_rng(4)
    a, b = (r.integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2) for _ in range(2))
    parts = near_dedup.registers(np.concatenate([a, b]), np.array([0, 50, 100]))
    whole = near_dedup.registers(np.concatenate([a, b]), np.array([0, 100]))
    assert (parts.max(axis=0) == whole[0]).all()


def linked_vectors(rows):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, n = [], {i: 0 for i, _ in rows}
    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    found = components([i for i, _ in rows], links)
    return sorted((i, n[i], found[i], found[i] == i) for i, _ in rows)


@pytest.mark.parametrize("shard,query,block", [(65_536, 8_192, 2_048), (70, 40, 5)])
def test_embeddings(spark, monkeypatch, shard, query, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    r = np.random.default_rng(5)
    centres = r.normal(size=(30, 12))
    vectors = [(c + r.normal(size=12) * s).astype(np.float32).tolist() for c in centres for s in (0, 0.02, 0.1, 0.25, 0.3)]
    vectors += [centres[0].astype(np.float32).tolist()] * 4
    odd = [None, [], [0.0] * 12, [None] + [1.0] * 11, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [1.0, 2.0], [2.0, 4.0], [1.0] * 3]
    rows = [(100 + i, v) for i, v in enumerate(vectors + odd)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, label int").repartition(3)
    found = embedding_dedup.groups(extra_columns(frame), shard_rows=shard, query_rows=query)
    assert sorted(tuple(x) for x in found.collect()) == linked_vectors(rows)


def dense_groups(n, seed=0):
    """Two groups of n near-equal vectors; only some pairs across them just reach 0.95."""
    r = np.random.default_rng(seed)
    a, b = np.eye(12)[0], 0.948 * np.eye(12)[0] + np.sqrt(1 - 0.948**2) * np.eye(12)[1]
    return np.concatenate([c + r.normal(size=(n, 12)) * 0.0015 for c in (a, b)])


def test_links_beyond_a_full_beam(spark):
    n = 200
    vectors = dense_groups(n)
    unit = embedding_dedup._unit(vectors)
    near = unit @ unit.T >= 0.95
    assert 0 < near[:n, n:].sum() < n * n / 2 and near[:n, :n].all() and near[n:, n:].all()
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = embedding_dedup.groups(frame).orderBy("vec_id").collect()
    assert [x["n_links"] for x in found] == (near.sum(axis=1) - 1).tolist()
    assert [x["vec_id"] for x in found if x["kept"]] == [0]


def test_audit_counts_links_and_not_selves():
    """Twelve pairs in 3,000 points, each cut off from the graph's base: no beam finds them."""
    r = np.random.default_rng(9)
    points = embedding_dedup._unit(r.normal(size=(3000, 24)))
    points[1::250] = embedding_dedup._unit(points[::250] + r.normal(size=(12, 24)) * 0.02)
    points = points.astype(np.float32)
    graph = embedding_dedup.Graph.build(points)
    base = graph.levels[0][1]
    base[np.isin(base, np.arange(1, 3000, 250))] = -1  # nothing leads to one of each pair
    upper = [(m[~np.isin(m, np.arange(1, 3000, 250))], near) for m, near in graph.levels[1:]]
    for _, near in upper:
        near[np.isin(near, np.arange(1, 3000, 250))] = -1
    graph.levels[1:] = upper
    assert embedding_dedup.audit(graph, 0.95)[0] == 0


def test_graphs_travel_in_small_rows():
    points = embedding_dedup._unit(np.random.default_rng(2).normal(size=(2500, 8)))
    graph = embedding_dedup.Graph.build(points.astype(np.float32))
    rows = list(graph.pack())
    assert [len(p) for p, _, _ in rows] == [1024 * 8 * 4, 1024 * 8 * 4, 452 * 8 * 4] and not rows[1][2]
    again = embedding_dedup.Graph.unpack(graph.points, b"".join(r[1] for r in rows), b"".join(r[2] for r in rows))
    for (_, near), (_, back) in zip(graph.levels, again.levels, strict=True):
        assert (near == back).all()


def test_copies_of_graphs_do_not_follow_the_queries(spark, monkeypatch):
    made = []
    plain = embedding_dedup.find_links
    monkeypatch.setattr(embedding_dedup, "find_links", lambda classes, graphs, shards, parts, cosine: made.append((sum(n for _, n in shards.values()), parts)) or plain(classes, graphs, shards, parts, cosine))
    vectors = np.random.default_rng(3).normal(size=(300, 6)).tolist()
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    assert embedding_dedup.groups(frame, shard_rows=100, query_rows=1).count() == 300
    (shards, copies), cores = made[0], spark.sparkContext.defaultParallelism
    assert shards * copies < embedding_dedup.COPIES * cores + shards


def test_embedding_edges(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_dedup.groups(empty).collect() == []
    rows = [(None, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None)]
    found = embedding_dedup.groups(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert sorted((x["vec_id"] or 0, x["n_links"], x["component_id"]) for x in found) == [(0, 2, 2), (2, 2, 2), (2, 2, 2), (3, 0, 3)]


def test_graph_recall():
    r = np.random.default_rng(6)
    points = embedding_dedup._unit(r.normal(size=(3000, 24))).astype(np.float32)
    graph = embedding_dedup.Graph.build(points)
    beam, recall = embedding_dedup.audit(graph, 0.95)
    assert beam and recall >= embedding_dedup.RECALL


@pytest.fixture(scope="module")
def small_corpus(spark, prose, tmp_path_factory):
    """A folder with documents of every fault, and a row without an id."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = prose(14, 999)
    docs, labels = [], []
    for i in range(240):
        text = prose(40, i)
        if i % 4 == 0:
            text = text.replace(" ", " vile ", 3)
        docs.append((i, text))
        labels.append((i, 1, int(i % 4 == 0)))
    docs += [(300, docs[1][1]), (301, docs[3][1] + " end"), (302, "start " + item + " end"), (303, prose(20, 5000) + " me@here.org"), (304, None), (305, ""), (None, prose(30, 5001)), (303, prose(25, 5002))]
    rows = [(i, t, "aa", "s", len(t or ""), i) for i, t in docs]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_pipeline(spark, small_corpus):
    docs = spark.read.parquet(f"{small_corpus}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small_corpus).checkpoint() if spark.sparkContext.getCheckpointDir() else stage(spark, docs, small_corpus).cache()
        assert docs.columns == columns
        kept[name] = {(r["doc_id"], r["text"]) for r in docs.collect()}
    ids = {name: {i for i, _ in rows} for name, rows in kept.items()}
    toxic = {i for i in range(0, 240, 4)}
    assert len(ids["toxicity"] & toxic) <= 3 and {i for i in range(240)} - toxic <= ids["toxicity"]
    assert {300, 301} & ids["toxicity"] and not {300, 301} & ids["near duplicates"] and {1, 3, 304, 305, None} <= ids["near duplicates"]
    assert ids["near duplicates"] - ids["decontamination"] == {302}
    assert any(t and t.endswith("[EMAIL]") for i, t in kept["personal data"]) and sum(i == 303 for i, _ in kept["personal data"]) == 2
    packed = corpus_pipeline.run(spark, small_corpus).collect()
    assert len(packed) == len(kept["personal data"]) and {r["doc_id"] for r in packed} == ids["personal data"]


def test_pipeline_of_nothing(spark, no_documents, small_corpus):
    docs = no_documents.selectExpr("doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "0L as n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small_corpus)
    assert docs.collect() == []

"""Token alignment, Merkle manifest and ring shards, held against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagseek.llm import merkle, sharding, token_alignment

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- token alignment ---------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers_of_both_sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in shown} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}
    return a, b, back


def plain_groups(text, a, b, back):
    """[(ids of a, ids of b)] by comparing all ends."""
    if not text:
        return []
    sides = []
    one = a.encode(" " + text, add_special_tokens=False)
    sides.append([(i, bytes(back[c] for c in t)) for i, t in zip(one.ids, one.tokens)])
    sides.append([(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)])
    if any(b"".join(t for _, t in side) != (" " + text).encode() for side in sides):
        return []
    ends = [set(np.cumsum([len(t) for _, t in side]).tolist()) for side in sides]
    common = ends[0] & ends[1]
    cut = []
    for side in sides:
        lists, at, own = [], 0, []
        for i, t in side:
            own.append(i)
            at += len(t)
            if at in common:
                lists.append(own)
                own = []
        cut.append(lists)
    return list(zip(*cut))


def plain_alignment(rows, both):
    groups = [plain_groups(text, *both) for _, text in rows]
    links = [Counter((x, y) for a, b in doc for x in a for y in b) for doc in groups]
    counts = Counter(pair for doc in links for pair in doc)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, _), doc, own in zip(rows, groups, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in doc)
        out.append((
            doc_id, sum(len(a) for a, _ in doc), sum(len(b) for _, b in doc), len(doc), sum(own.values()),
            sum(n for p, n in own.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in own.items()), sha(written) if doc else "",
        ))
    return sorted(out, key=str)


ODD = [
    "", " ", "  two  gaps ", " lead", "trail ", "a\n\nb\t\tc", "x▁y", "<|endoftext|> and </s> <unk> <0x41>", "naïve ÉCOLE 日本語 🙂🙂", "\x00\x01",
    "a" * 3000, "é" * 700, "word " * 900, "0123456789" * 40, "ab" * 50 + " " + "🙂" * 300, "　wide　space", "can't won't I'll",
]


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 20])
def test_alignment_of_odd_texts(spark, edge_documents, tokenizers_of_both_sides, chunk_bytes):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    documents = edge_documents.unionByName(more, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in token_alignment.align(documents, chunk_bytes=chunk_bytes).collect()), key=str)
    assert found == plain_alignment(rows, tokenizers_of_both_sides)


def test_a_chunk_is_never_one_row(spark):
    rows = [(i, f"word{i} and more words") for i in range(50)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    made = token_alignment._chunks(documents, None, None, 1 << 20).collect()
    assert sorted(r["doc_id"] for r in made) == list(range(50)) and len({r["chunk"] for r in made}) == 2
    assert sum(len(r["pairs"]) > 0 for r in made) == 2 and all(len(r["at"]) == len(r["times"]) > 0 for r in made)


def test_alignment_of_whole_tables(spark, tokenizers_of_both_sides):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in token_alignment.align(documents).collect()), key=str)
    assert found == plain_alignment(rows, tokenizers_of_both_sides)


def test_alignment_ranges(spark, edge_documents, tokenizers_of_both_sides):
    """Groups and overlaps, token by token."""
    a, b, back = tokenizers_of_both_sides
    for row, text in zip(*[x.collect() for x in (token_alignment.groups(edge_documents), edge_documents.select("text"))]):
        expected = plain_groups(text["text"], a, b, back)
        assert [(row["a_ids"][g.a_first : g.a_last + 1], row["b_ids"][g.b_first : g.b_last + 1]) for g in row["groups"]] == [tuple(g) for g in expected]
        assert len(row["overlaps"]) == len(row["a_ids"])
        for g in row["groups"]:
            assert row["overlaps"][g.a_first].b_first == g.b_first and row["overlaps"][g.a_last].b_last == g.b_last
            for i in range(g.a_first, g.a_last + 1):
                assert g.b_first <= row["overlaps"][i].b_first <= row["overlaps"][i].b_last <= g.b_last


def test_wide_groups_are_joined_by_id(monkeypatch, spark, edge_documents, tokenizers_of_both_sides):
    sides = token_alignment._sides(None, None)
    texts = [r["text"] for r in edge_documents.select("text").collect()] + ODD
    whole = [x.tolist() for x in token_alignment.Aligned(sides, texts).links()]
    monkeypatch.setattr(token_alignment, "WIDE", 1)
    assert [x.tolist() for x in token_alignment.Aligned(sides, texts).links()] == whole


def test_gallop_is_a_lower_bound():
    r = np.random.default_rng(1)
    for n, m in ((0, 3), (1, 1), (5, 400), (300, 4), (1000, 1000)):
        ends, wanted = np.sort(r.integers(0, 900, n)), np.sort(r.integers(-3, 905, m))
        guess = r.integers(-2, n + 3, m)
        assert token_alignment.gallop(wanted, ends, guess).tolist() == np.searchsorted(ends, wanted).tolist()


def test_alignment_of_nothing(no_documents):
    assert token_alignment.align(no_documents).collect() == []
    assert token_alignment.groups(no_documents).collect() == []


# --- Merkle manifest ------------------------------------------------------------------


def up(nodes):
    """Levels of a tree, from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        run = i // 16 * 16
        yield level[run:i], level[i + 1 : run + 16]
        i //= 16


def plain_manifest(rows):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    top = up([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, row) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            steps = [*path(trees[s], i), *path(top, k)]
            h = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                h = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in steps:
                h = sha("".join([*left, h, *right]))
            proof = sha("".join(x for left, right in steps for x in [*left, *right]))
            out.append((row[0], own, trees[s][-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def test_manifest_of_odd_rows(spark):
    r = random.Random(3)
    rows = [(i, f"src{i % 3}", r.choice(["en", None, "日本"]), r.choice([None, i]), r.choice([None, "", "Été Ab", "x" * r.randint(1, 50)])) for i in range(120)]
    rows += [(r.randrange(10**6), "hot", "en", 4, f"Text {i}") for i in range(5000)]
    rows += [(7, None, None, None, None), (7, "", "a:b", 1, "A"), (None, None, None, None, "Q"), (8, "alone", "x", 2, "B" * 100_000), (8, "~", "x", 2, "B")]
    rows += [(9, "hot", "en", 4, "Same Row")] * 20 + [(-5, "src1", "en", 4, "Minus")] + [(i, f"many {i}", None, None, "Aa") for i in range(300)]
    documents = spark.createDataFrame(rows, COLUMNS).repartition(7)
    extra = documents.withColumns({c: F.lit("clash") for c in ("tree", "i", "n", "leaf", "hash", "node", "up", "k")})
    found = sorted((tuple(x) for x in merkle.verify(extra).collect()), key=str)
    assert found == plain_manifest(rows)
    assert any(not x[-1] for x in found) and any(x[-1] for x in found)


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 257])
def test_manifest_of_one_source(spark, count):
    rows = [(i, "only", None, i, f"Text {i}") for i in range(count)]
    found = sorted((tuple(x) for x in merkle.verify(spark.createDataFrame(rows, COLUMNS)).collect()), key=str)
    assert found == plain_manifest(rows)


def test_manifest_of_nothing(spark):
    assert merkle.verify(spark.createDataFrame([], COLUMNS)).collect() == []


def test_any_change_of_a_field_breaks_the_proof(spark):
    rows = [(i, f"s{i % 2}", "en", i, f"text {i}") for i in range(40)]
    documents = spark.createDataFrame(rows, COLUMNS)
    manifest = merkle.build(merkle.document_leaves(documents))
    forged = merkle.document_leaves(documents.withColumn("n_chars", F.col("n_chars") + (F.col("doc_id") == 3).cast("int"))).select("doc_id", F.col("leaf").alias("forged"))
    checked = manifest.proofs().join(forged, "doc_id").select("doc_id", (merkle.fold(F.col("segment"), F.col("forged")) == manifest.root).alias("holds"))
    assert [r["doc_id"] for r in checked.collect() if not r["holds"]] == [3]


# --- shards -------------------------------------------------------------------------------


def plain_shards(rows, places, most):
    """[(place on the ring, doc_id, size)] → rows per shard and home, round by round."""
    arcs = sorted(places)
    left = Counter()
    homes = Counter()
    for cell in rows:
        arc = next((a for a in arcs if a >= cell), arcs[0])
        left[arc] += 1
        homes[places[arc]] += 1
    room, taken = list(most), Counter()
    while any(left.values()):
        asks = defaultdict(list)
        for arc in arcs:
            if left[arc]:
                ahead = arcs[arcs.index(arc) :] + arcs[: arcs.index(arc)]
                asks[next(places[a] for a in ahead if room[places[a]] > 0)].append(arc)
        for shard, queue in asks.items():
            for arc in queue:
                n = min(left[arc], room[shard])
                left[arc] -= n
                room[shard] -= n
                taken[arc, shard] += n
    return homes, taken


@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_rounds_against_row_counts(spark, slack):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    placed = sharding.place(documents, shards=7, places=9, slack=slack).collect()
    ring = {r["arc"]: r["shard"] for r in sharding.ring(spark, 7, 9).collect()}
    cell = sharding.cell_of(sharding.ring_place(F.lit("row"), "doc_id"), sharding.RING_BITS)
    cells = [r[0] for r in documents.select(cell).collect()]
    homes, taken = plain_shards(cells, ring, sharding.bounds(len(cells), 7, slack))
    assert Counter(r["home_shard"] for r in placed) == homes
    expected = Counter()
    for (arc, shard), n in taken.items():
        expected[ring[arc], shard] += n
    assert Counter((r["home_shard"], r["shard"]) for r in placed) == +expected


def check_shards(placed, rows, shards):
    """Counts at most one apart, slots without gaps, nothing lost."""
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(shards)]
    assert sum(sizes) == len(rows) == len(placed) and max(sizes) - min(sizes) <= 1
    expected = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in placed), key=str) == expected


@pytest.mark.parametrize("cell_rows", [5, 20_000])
def test_shards_of_hot_keys(spark, edge_documents, cell_rows):
    """A third of the rows share an id, another third have none; crowded cells are split."""
    hot = spark.createDataFrame([(None if i % 2 else 77, "same") for i in range(400)] + [(i, f"t{i}") for i in range(200)], "doc_id bigint, text string")
    documents = edge_documents.unionByName(hot, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    check_shards(sharding.place(documents, cell_rows=cell_rows).collect(), rows, 24)


def test_few_rows_and_none(spark, no_documents):
    few = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "doc_id bigint, text string")
    check_shards(sharding.place(few).collect(), [(1, "a"), (2, None), (3, "")], 24)
    assert sharding.shard_rows(no_documents).collect() == []


def test_one_more_shard_moves_few_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before, after = ({r["doc_id"]: r["shard"] for r in sharding.place(documents, n, slack=0.1).collect()} for n in (24, 25))
    moved = sum(before[d] != after[d] for d in before) / len(before)
    assert moved < 0.25  # an even deal without a ring moves 24 of 25 rows

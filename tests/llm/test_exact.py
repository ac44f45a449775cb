"""Operators with one right answer, against brute force."""

import collections
import hashlib
import random
import re

import pytest

from tagseek.llm import decontaminate, html_text, packing, pii, suffix_dedup
from tests.llm.conftest import extra_columns


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(docs, items):
    windows, out = collections.defaultdict(set), {}
    for i, text in items:
        own = words(text)
        for k in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[k : k + 10])].add(str(i))
    for i, text in docs:
        own, hit, met = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(own) - n + 1):
                if (w := tuple(own[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    met |= windows[w]
        out[i] = (i, len(own), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination(spark, prose):
    r = random.Random(2)
    items = [(i, prose(r.randint(1, 40), i)) for i in range(30)] + [(30, None), (31, ""), (32, "é"), (33, "q q q q q q q q q q q q"), (5, prose(20, 77))]
    docs = [(None, prose(20, 3)), (1, None), (2, ""), (3, "É é x"), (4, "q " * 50), (5, "Ta kO!")]
    for i in range(10, 60):
        parts = [prose(r.randint(0, 30), 1000 + i)]
        if i % 2:
            parts.insert(r.randint(0, 1), (r.choice(items)[1] or "").upper() if i % 3 else r.choice(items)[1] or "")
        docs.append((i, " - ".join(parts)))
    found = decontaminate.decontaminate(
        extra_columns(spark.createDataFrame(docs, "doc_id bigint, text string")), extra_columns(spark.createDataFrame(items, "item_id bigint, text string"))
    )
    assert {x["doc_id"]: tuple(x) for x in found.collect()} == contaminated(docs, items)


def test_decontamination_in_blocks(spark, prose):
    items = [(i, prose(30, i)) for i in range(6)]
    docs = [(i, prose(5, 50 + i) + " " + items[i][1]) for i in range(6)]
    found = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), block=7)
    assert {x["doc_id"]: tuple(x) for x in found.collect()} == contaminated(docs, items)


def test_rows_that_share_an_id_are_apart(spark, prose):
    items = [(1, prose(12, 1)), (2, prose(15, 2))]
    texts = [items[0][1], "clean", None, prose(9, 3) + " " + items[1][1], "clean too", items[0][1]]
    docs = list(zip([None, None, None, 7, 7, 8], texts))
    found = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    alone = contaminated(list(enumerate(texts)), items)
    expected = [(docs[i][0], *alone[i][1:]) for i in range(len(docs))]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)


def test_shapes_take_in_whole_tokens():
    token = "https://example.org/" + "ab1-" * 200
    assert len({pii.shape(token + end) for end in ("7", "77", "777", "x7x", "#7")}) == 5
    assert pii.shape("1234") == pii.shape("5678") != pii.shape("123")


def test_decontamination_edges(spark, edge_documents, no_documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    item = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    assert not any(r["contaminated"] for r in decontaminate.decontaminate(edge_documents, none).collect())
    assert decontaminate.decontaminate(no_documents, item).collect() == []
    found = decontaminate.decontaminate(edge_documents, item).collect()
    assert len(found) == edge_documents.count() and {r["doc_id"] for r in found if r["contaminated"]} == {7, 8}


def test_decontamination_stays_in_the_engine(spark, edge_documents):
    item = spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    plan = decontaminate.decontaminate(edge_documents, item)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def removed(docs):
    seen, out = set(), []
    for i, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            if (w := data[k : k + 100]) in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [5_000, 4])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    r = random.Random(hot)
    text = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    pool = [text(r.randint(90, 260), "abé ") for _ in range(10)]
    docs = [(i, "".join(r.choice(pool) if r.random() < 0.6 else text(r.randint(1, 80), "xyz ") for _ in range(r.randint(0, 7)))) for i in range(80)]
    docs += [(200, "ab" * 400), (201, "a" * 500), (203, None), (204, ""), (205, "ab" * 90), (206, "x" + "a" * 150)]
    found = suffix_dedup.deduplicate(extra_columns(spark.createDataFrame(docs, "doc_id bigint, text string")).repartition(4))
    assert sorted((tuple(x)[:5] for x in found.collect()), key=str) == removed(docs)


def test_suffix_dedup_edges(edge_documents, no_documents):
    assert suffix_dedup.deduplicate(no_documents).collect() == []
    rows = [(r["doc_id"], r["text"]) for r in edge_documents.collect()]
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert sorted((tuple(x)[:5] for x in suffix_dedup.deduplicate(edge_documents).collect()), key=str) == removed(order)


def test_longest_previous_factors():
    r = random.Random(4)
    for _ in range(50):
        data = bytes(r.choice(b"ab") for _ in range(r.randint(0, 30)))
        brute = [max((n for j in range(i) for n in range(len(data) - i + 1) if data[i : i + n] == data[j : j + n]), default=0) for i in range(len(data))]
        assert suffix_dedup.longest_previous_factors(data) == brute


def brute_spans(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_base_spans():
    r = random.Random(0)
    for _ in range(20_000):
        text = "".join(r.choice("aB.@-+ 0129%()4é\n") for _ in range(r.randint(0, 60)))
        assert pii.base_spans(text) == brute_spans(text)
    assert len(pii.base_spans("4111 1111 1111 1111 and 4111-1111-1111-1112")) == 1
    pii.base_spans("1" * 200_000), pii.base_spans("a." * 100_000), pii.base_spans("1.1." * 50_000), pii.base_spans("a@" * 50_000)


def test_personal_data(spark, edge_documents, no_documents):
    text = "call +1 (017) 555-7713 now, or 017 5557713; mail a.b@x.org"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")] + [(i, f"see 10.0.0.{i} there") for i in range(4, 60)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert (found[1]["n_email"], found[1]["n_phone"], found[9]["n_ip"]) == (1, 1, 1)
    assert found[1]["base_sha256"] == hashlib.sha256(pii.spans_text(brute_spans(text)).encode()).hexdigest()
    assert f"phone:{text.index('5557713')}:{text.index('5557713') + 7}" in found[1]["spans"].split(",")
    assert found[2]["spans"] == "" and found[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs, pii.fit(docs)).collect()}
    assert "[PHONE]" in masked[1] and "[EMAIL]" in masked[1] and masked[2] is None and masked[9] == "see [IP] there"
    assert pii.find(no_documents).collect() == []
    assert len(pii.find(edge_documents).collect()) == edge_documents.count()


def test_hot_value_in_one_text():
    text = " or ".join(["+1 (017) 555-7713"] + ["555-7713"] * 3000)
    assert len(pii.label_text(text, pii.np.log(pii.np.full((pii.BUCKETS, 5), 0.2)), {})[1]) > 2000


def test_packing(spark, edge_documents, no_documents, prose):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
    odd = ["a  b", " a", "a ", "a \n b", "a\n  b", "x  y", "  ", "don't  <|endoftext|> 's", "é" * 50, "a b  c", "\n\n a\t b"]
    docs = [(i, prose(30 + i * 13, i)) for i in range(60)] + [(100 + i, t) for i, t in enumerate(odd)] + [(200, None), (201, "")]
    found = packing.pack_documents(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    texts = dict(docs)
    pieces = collections.defaultdict(list)
    for r in found:
        own = ids(texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for doc, own in pieces.items():
        own.sort()
        assert [p[0] for p in own] == list(range(len(own))) and sum(p[2] for p in own) == len(ids(texts[doc]))
        assert len(own) == 1 or all(p[2] == 2048 for p in own[1:])
    check_sequences(found)
    total = sum(r["length"] for r in found)
    assert len({r["sequence_id"] for r in found}) <= -(-total // 2048) + 1
    assert packing.pack_documents(no_documents).collect() == []
    check_sequences(packing.pack_documents(edge_documents).collect())


def check_sequences(found):
    held = collections.defaultdict(list)
    for r in found:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_best_two_fit():
    import numpy as np

    counts = np.zeros(101, int)
    for size, n in ((60, 1), (30, 1), (25, 1), (14, 1)):
        counts[size] = n
    # 60 + 30 leaves 10; the 30 gives way to 25 + 14, which fill 39 of 40
    assert sorted(packing.best_two_fit(counts, 100)[0]) == [14, 25, 60]
    r = random.Random(1)
    for _ in range(200):
        counts = np.zeros(65, int)
        for _ in range(r.randint(0, 60)):
            counts[r.randint(1, 64)] += 1
        made = packing.best_two_fit(counts, 64)
        assert all(sum(m) <= 64 for m in made)
        assert collections.Counter(x for m in made for x in m) == collections.Counter({i: int(n) for i, n in enumerate(counts) if n})


def test_pages(spark):
    page = (
        '<html><head><title>t</title><style>p{}</style></head><body><nav>x</nav><article><h1>A &amp;  B</h1><p><b>One<br><p>Two <i>in</i>line'
        '</p><div class="ad">no</div><script>var t="</p></article>";</script><ul><li>x<li>y</ul><section id="comments">bad</section></article><footer>f</footer>'
    )
    same = "we use cookies on this great site today"
    plain = [f"<body><div>{same}</div><p>own words of page number {i} stand {'abcdefgh'[i]} here</p></body>" for i in range(8)]
    rows = [(1, "http://a.b/1", page), (2, None, None), (3, "http://a.b/2", ""), (4, "http://c.d/x", "<p>a < b &lt; c")]
    rows += [(10 + i, "https://H.i/" + str(i), p) for i, p in enumerate(plain)]
    docs = extra_columns(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    found = {r["page_id"]: r for r in html_text.extract(docs).collect()}
    assert found[1]["text"] == "A & B\nOne\nTwo inline\nx\ny" and found[1]["n_chars"] == len(found[1]["text"])
    assert found[2]["text"] == found[3]["text"] == "" and found[4]["text"] == "a < b < c"
    for i in range(8):
        assert same not in found[10 + i]["text"] and "abcdefgh"[i] + " here" in found[10 + i]["text"]
    assert html_text.extract(docs.where("page_id < 0")).collect() == []


def test_runs_of_all_shards_count_together(spark, prose):
    same = "this notice of the house stands on few of the pages"
    pages = [(i, "http://h.i/" + str(i), f"<div>{same if i % 10 == 0 else ''}</div><p>{prose(12, i)}</p>") for i in range(40)]
    docs = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    one, many = (sorted(map(tuple, html_text.extract(docs, shard_bytes=n).collect())) for n in (1 << 20, 400))
    assert one == many and not any(same in r[2] for r in many)


def test_phrases_within_paragraphs_stay(spark, prose):
    phrase, notice = "as one of the oldest houses of the town once said", "all rights of this house are kept by its owners"
    texts = [f"{prose(15, i)} {phrase if i % 2 else ''} {prose(15, 100 + i)}" for i in range(12)]
    rows = [(i, "http://h.i/" + str(i), f"<p>{t}</p><div>{notice}</div>") for i, t in enumerate(texts)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {i: " ".join(t.split()) for i, t in enumerate(texts)}


def _shown(spark, rows, **more):
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r["page_id"]: r["text"] for r in html_text.extract(docs, **more).collect()}


def test_names_alone_take_nothing_from_an_article(spark, prose):
    own = [f'<p class="related-work">{prose(9, i)}</p><div class="share-price">{prose(9, 50 + i)}</div><p id="notice-of-meeting">{prose(9, 90 + i)}</p>' for i in range(4)]
    widget = "<section id='widget'>read all the news of this house by mail</section>"
    found = _shown(spark, [(i, "http://h.i/" + str(i), f"<article>{t}{widget}</article>") for i, t in enumerate(own)])
    assert all(len(t.split("\n")) == 3 and "by mail" not in t for t in found.values())
    alone = _shown(spark, [(1, "http://h.i/1", f"<article>{own[0]}{widget}</article>")])
    assert len(alone[1].split("\n")) == 4 and "by mail" in alone[1]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_articles_repeat_each_other_and_lose_what_pages_show_beside_them(spark, prose, shard_bytes):
    license, notice = prose(20, 1), prose(20, 2)
    page = "<div>{2}</div><article><p>{0}</p><p>{1}</p><p class='notice-bar'>{3}</p></article>"
    rows = [(i, "http://h.i/" + str(i), page.format(license, prose(12, 10 + i), notice if i < 3 else prose(9, 70 + i), notice if i == 5 else "")) for i in range(6)]
    found = _shown(spark, rows, shard_bytes=shard_bytes)
    assert found == {i: f"{license}\n{prose(12, 10 + i)}" for i in range(6)}


def test_copies_of_a_page_count_once(spark, prose):
    page = f"<p>{prose(30, 1)}</p>"
    assert set(_shown(spark, [(i, f"http://h.i/{i}", page) for i in range(9)]).values()) == {prose(30, 1)}


def test_very_long_pages_words_and_blocks(spark, prose):
    words = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, "http://h.i/1", "<article>" + "<p>a</p>" * 20_000 + "</article>"), (2, "http://h.i/2", f"<p>{words}</p>"), (3, "http://h.i/3", f"<p>{'x' * 1_000_000} y</p>")]
    found = _shown(spark, rows)
    assert found[1] == "\n".join("a" * 20_000) and found[2] == words and len(found[3]) == 1_000_002


def test_given_pages_with_marks_ignored(spark):
    """What the suffix arrays leave and take where no element marks an article."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    marked = {r["page_id"]: r["text"].split() for r in html_text.extract(pages).collect()}
    found = {r["page_id"]: r["text"].split() for r in html_text.extract(pages, marks=False).collect()}
    lost = sum((collections.Counter(marked[k]) - collections.Counter(found[k])).total() for k in marked)
    left = sum((collections.Counter(found[k]) - collections.Counter(marked[k])).total() for k in marked)
    total = sum(map(len, marked.values()))
    print("article tokens", total, "lost", lost, "boilerplate tokens left", left)
    assert lost <= 0.02 * total and left == 0


def test_repeated_runs_equal_brute_force():
    import numpy as np

    r = random.Random(3)
    for _ in range(100):
        page = np.sort(np.array([r.randint(0, 4) for _ in range(r.randint(0, 40))], int))
        tokens = np.array([r.randint(0, 2) for _ in page], int)
        where = collections.defaultdict(set)
        whole = [k for k in range(len(page) - 2) if page[k] == page[k + 2]]
        for k in whole:
            where[tuple(tokens[k : k + 3])].add(page[k])
        brute = np.zeros(len(page), bool)
        for k in whole:
            if len(where[tuple(tokens[k : k + 3])]) >= 2:
                brute[k : k + 3] = True
        assert (html_text.repeated_runs(tokens, page, 3, 2) == brute).all()

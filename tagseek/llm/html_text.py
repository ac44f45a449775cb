"""Main text of web pages: page structure and suffix arrays per host.

A page is cut into blocks of text. Structure gives each a state: what stands in
menus, headers, footers, sidebars, adverts, forms and comments, or outside a
marked article, is DROP; what stands in a marked article (``article``, ``main``)
is KEEP, but HINT where only part of a class or id name speaks against it;
blocks of pages that mark no article are OPEN. Scripts and styles are no text.

Every page's blocks outside marked articles are a token stream. The streams of a
host are concatenated, a suffix array puts equal runs of tokens next to each
other, and a run that distinct pages repeat is boilerplate. OPEN and HINT blocks
go where such runs cover them for the most part; a phrase is not cut out of a
paragraph. KEEP blocks stay: articles rightly repeat each other, and the lines that
adverts beside them show.

A token lies in a repeated substring of ``RUN`` tokens or more exactly if it lies in
a repeated run of ``RUN`` tokens, so suffixes need their order by that many only.
Large hosts are dealt to shards of bounded bytes. Each shard counts the pages of
all its runs, the counts of a host's shards are added up, and every shard gets
its common runs back: the result does not depend on the number of shards. Equal
pages count once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle

#: Tokens of a repeated run, the distinct pages of a host it must stand on, and
#: the share of a block's tokens that such runs must cover.
RUN = 8
PAGES = 3
COVER = 0.8
#: Bytes of text outside marked articles that are sorted together.
SHARD_BYTES = 4 << 20

# Elements, class and id names, their parts, and role names, by what they hold.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
_DROP = _RAW | {"nav", "footer", "aside", "form", "head", "template", "svg", "math", "canvas", "object", "button", "select", "dialog", "menu", "audio", "video", "map"}
_MAIN = {"article", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Whole names that settle a block.
_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsored", "breadcrumb", "breadcrumbs", "comments", "comment-list",
    "reader-comments", "respond", "disqus_thread", "cookie-notice", "cookie-banner", "footer", "masthead", "menu", "nav", "navbar", "navigation",
    "newsletter", "sidebar", "toolbar",
}
#: Parts of names that only speak against a block.
_PARTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "popup", "promo", "related", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
#: An open element of the first kind ends where one of the second begins.
_CLOSES = {
    "p": {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
}

_TAG = re.compile(r"<(?:!--(?P<note>.*?)(?:-->|\Z)|(?P<odd>[!?][^>]*>?)|(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

OPEN, KEEP, DROP, HINT = 0, 1, 2, 3


def _judged(name: str, rest: str, in_main: bool) -> tuple[bool, bool]:
    """Whether an element is dropped, and whether a part of its names speaks against it."""
    if name in _DROP or (name == "header" and not in_main):
        return True, False
    if not rest or "=" not in rest and "hidden" not in rest:
        return False, False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return True, False
    if found.get("role", "").lower() in _ROLES:
        return True, False
    if name in ("html", "body", "article", "main"):
        return False, False
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    if any(n in _NAMES for n in names.split()):
        return True, False
    return False, any(p in _PARTS for p in _PART.findall(names))


def blocks(page: str, marks: bool = True) -> list[tuple[int, str]]:
    """(state, text) of the blocks of a page, in order. Without ``marks``, no element marks an article."""
    out: list[tuple[int, bool, str]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name; dropped, main, hinted here
    text: list[str] = []
    aside: list[str] = []
    opened: dict[str, int] = {}  # how often each name stands on the stack
    drop = main = hint = 0
    marked = False

    def close() -> None:
        for parts, state in ((text, HINT if hint else OPEN), (aside, DROP)):
            if parts:
                block = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
                parts.clear()
                if block:
                    out.append((state, main > 0, block))

    def pop() -> None:
        nonlocal drop, main, hint
        name, dropped, mained, hinted = stack.pop()
        opened[name] -= 1
        if name not in _INLINE:
            close()
        drop -= dropped
        main -= mained
        hint -= hinted

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            (aside if drop else text).append(page[at:])
            break
        if m.start() > at:
            (aside if drop else text).append(page[at : m.start()])
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name == "br" or not opened.get(name):
                if name not in _INLINE:
                    close()
                continue
            while True:
                last = stack[-1][0]
                pop()
                if last == name:
                    break
            continue
        while stack and name in _CLOSES.get(stack[-1][0], ()):
            pop()
        if name not in _INLINE:
            close()
            # inline elements left open by a paragraph's end do not outlive it
            if any(name in ends and opened.get(n) for n, ends in _CLOSES.items()):
                while stack and stack[-1][0] in _INLINE:
                    pop()
            while stack and name in _CLOSES.get(stack[-1][0], ()):
                pop()
        if name in _VOID or m["rest"].endswith("/") and name not in _RAW:
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        (dropped, hinted), mained = _judged(name, m["rest"], main > 0), marks and name in _MAIN
        hinted = hinted and name not in _INLINE
        stack.append((name, dropped, mained, hinted))
        opened[name] = opened.get(name, 0) + 1
        drop += dropped
        main += mained
        hint += hinted
        marked |= mained and not drop
    close()
    if not marked:
        return [(DROP if state == DROP else OPEN, b) for state, _, b in out]
    return [(DROP if state == DROP or not in_main else HINT if state == HINT else KEEP, b) for state, in_main, b in out]


def run_counts(tokens: np.ndarray, page: np.ndarray, run: int = RUN, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, kinds, pages): where runs of ``run`` tokens start in a concatenated stream, equal
    numbers for equal runs, and on how many distinct pages each kind stands.

    Prefix doubling gives the suffix array's order of the first ``run`` tokens;
    runs do not cross from one page, or ``part`` of one, to the next.
    """
    n = len(tokens)
    part = page if part is None else part
    if n < run:
        return (np.empty(0, np.int64),) * 3
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    done = 1
    while done < run:
        step = min(done, run - done)
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:]
        order = np.lexsort((second, rank))
        fresh = np.zeros(n, np.int64)
        fresh[order[1:]] = np.cumsum((rank[order[1:]] != rank[order[:-1]]) | (second[order[1:]] != second[order[:-1]]))
        rank = fresh
        done += step
    whole = np.zeros(n, bool)
    whole[: n - run + 1] = part[: n - run + 1] == part[run - 1 :]
    at = np.flatnonzero(whole)
    order = at[np.lexsort((page[at], rank[at]))]  # suffixes in order, pages together
    new = np.ones(len(order), bool)
    new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (page[order[1:]] != page[order[:-1]])
    return at, rank[at], np.bincount(rank[order], weights=new, minlength=n).astype(np.int64)


def _cover(n: int, starts: np.ndarray, run: int) -> np.ndarray:
    covered = np.zeros(n, bool)
    for k in range(run):
        covered[starts + k] = True
    return covered


def repeated_runs(tokens: np.ndarray, page: np.ndarray, run: int = RUN, pages: int = PAGES) -> np.ndarray:
    """Which tokens of a concatenated stream stand in a run of ``run`` tokens that ``pages`` pages share."""
    at, kind, distinct = run_counts(tokens, page, run)
    return _cover(len(tokens), at[distinct[kind] >= pages] if len(at) else at, run)


def _tokens(text: str) -> list[str]:
    return text.split(" ")


def cut_blocks(pages: DataFrame, marks: bool = True) -> DataFrame:
    """(row, page_id, url, host, digest, states, texts): the blocks of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(x.as_py() or "", marks) for x in batch["html"]]
            states = pa.array([[k for k, _ in f] for f in found], pa.list_(pa.int32()))
            texts = pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))
            kept = ("row", "page_id", "url", "host", "digest")
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), states, texts], [*kept, "states", "texts"])

    host = F.coalesce(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit(""))
    digest = F.md5(F.coalesce("html", F.lit("")))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", F.lower(host).alias("host"), digest.alias("digest"), "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"row bigint, page_id {kinds['page_id']}, url string, host string, digest string, states array<int>, texts array<string>")


def _stream(frame) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(row, part, block, word) of every token outside marked articles; an article's block ends a part."""
    rows, parts, places, words = [], [], [], []
    part = 0
    for row, texts in zip(frame["row"], frame["streams"]):
        part += 1
        for k, text in enumerate(texts):
            if text is None:
                part += 1
                continue
            own = _tokens(text)
            words += own
            rows += [row] * len(own)
            parts += [part] * len(own)
            places += [k] * len(own)
    return np.array(rows, np.int64), np.array(parts, np.int64), np.array(places, np.int64), words


def _digest(words: list[str]) -> bytes:
    return blake2b(" ".join(words).encode(), digest_size=16).digest()


def covered_blocks(blocks: np.ndarray, gone: np.ndarray, cover: float = COVER) -> np.ndarray:
    """Which tokens stand in a block that covered tokens make up to ``cover`` at least; ``blocks``: number of each token's block."""
    return (np.bincount(blocks, gone) >= cover * np.bincount(blocks))[blocks] if len(blocks) else gone


def boilerplate(cut: DataFrame, run: int = RUN, pages: int = PAGES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(host, digest, gone): places of the blocks that distinct pages of a host repeat, for each page that has some."""
    block = F.arrays_zip("states", "texts")
    streams = F.transform(block, lambda b: F.when(b["states"] != KEEP, b["texts"]))
    size = F.aggregate("streams", F.lit(0).cast("bigint"), lambda a, t: a + F.coalesce(F.octet_length(t), F.lit(0)))

    repeats = cut.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("one")).where("n > 1")
    copies = settle(cut.select("row", "host", "digest").join(repeats, ["host", "digest"]).where("row <> one").select("row"), "copies")
    read = cut.select("row", "host", "digest", "states", streams.alias("streams")).withColumn("bytes", size)
    once = read.join(copies, "row", "left_anti")
    shards = F.greatest(F.ceil(F.sum("bytes") / shard_bytes), F.lit(1)).cast("int")
    sizes = settle(once.groupBy("host").agg(shards.alias("shards")), "hosts")
    sharded = once.drop("bytes").join(sizes, "host").withColumn("shard", F.pmod(F.xxhash64("digest"), F.col("shards")).cast("int"))

    def count(frame):
        row, part, _, words = _stream(frame)
        found: dict[bytes, int] = {}
        if words:
            at, kind, distinct = run_counts(pd.factorize(np.array(words, object))[0], row, run, part)
            kinds, first = np.unique(kind, return_index=True)
            found = {_digest(words[a : a + run]): int(distinct[k]) for k, a in zip(kinds, at[first])}
        if frame["shards"].iloc[0] == 1:
            # the counts are whole already
            found = {k: n for k, n in found.items() if n >= pages}
        host, shard = frame["host"].iloc[0], frame["shard"].iloc[0]
        return pd.DataFrame(
            {"host": pd.Series([host] * len(found), dtype=object), "shard": np.full(len(found), shard, np.int32), "run": pd.Series(list(found), dtype=object), "n": np.array(list(found.values()), np.int64)}
        )

    counts = settle(sharded.groupBy("host", "shard").applyInPandas(count, "host string, shard int, run binary, n bigint"), "runs")
    common = counts.groupBy("host", "run").agg(F.sum("n").alias("n")).where(F.col("n") >= pages).select("host", "run")
    wanted = counts.select("host", "shard", "run").join(common, ["host", "run"])

    def find(frame, runs):
        known = set(map(bytes, runs["run"]))
        gone: dict[int, list[int]] = {}
        if len(frame) and known:
            row, part, place, words = _stream(frame)
            states = dict(zip(frame["row"], frame["states"]))
            whole = np.flatnonzero(part[: len(part) - run + 1] == part[run - 1 :]) if len(part) >= run else []
            covered = _cover(len(row), np.array([a for a in whole if _digest(words[a : a + run]) in known], np.int64), run)
            if len(row):
                starts = np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1])]
                covered = covered_blocks(np.cumsum(starts) - 1, covered)
                for k in np.flatnonzero(starts & covered).tolist():
                    if states[row[k]][place[k]] != DROP:
                        gone.setdefault(int(row[k]), []).append(int(place[k]))
        kept = frame[frame["row"].isin(list(gone))]
        return kept[["host", "digest"]].assign(gone=pd.Series([gone[r] for r in kept["row"]], index=kept.index, dtype=object))

    keys = ("host", "shard")
    return sharded.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInPandas(find, "host string, digest string, gone array<int>")


def extract(pages: DataFrame, run: int = RUN, min_pages: int = PAGES, shard_bytes: int = SHARD_BYTES, marks: bool = True) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty pages have the empty text. Pages without a host form one of
    their own. Repeated rows are pages of their own, though they count once; a run
    on exactly ``min_pages`` pages is common. Pages of any length are read whole;
    one longer than ``shard_bytes`` makes its shard that much longer. Further
    columns are ignored. Without ``marks``, no element marks an article.
    """
    cut = settle(cut_blocks(pages, marks), "blocks")
    found = settle(boilerplate(cut, run, min_pages, shard_bytes), "boilerplate")
    every = cut.join(found, ["host", "digest"], "left")
    left = F.filter(
        F.arrays_zip("states", "texts"),
        lambda b, k: (b["states"] != DROP) & ~F.coalesce(F.array_contains("gone", k), F.lit(False)),
    )
    text = F.array_join(F.transform(left, lambda b: b["texts"]), "\n")
    return every.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))

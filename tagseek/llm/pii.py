"""Personal data: patterns, and a skip-chain conditional random field over them.

Patterns give the base spans. They and all other tokens with a digit or an ``@``
are the nodes of a field with one label each. A node's own potential comes from
how often its shape carries each label over the whole corpus, neighbours share a
chain potential, and nodes of one document that repeat or resemble each other
share a skip potential through a common hub, so a number written once in full
and again in part gets one label. Loopy message passing in log space settles the
marginals; base spans keep their label, and confident nodes add spans.

Shapes are counted over all documents (partial counts per task, a shuffle of
counts); labelling is one pass without a shuffle. A hub costs as much as it has
members, however often a value repeats.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import mix

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
BUCKETS = 4096
CHAIN = 0.1
SKIP = 8.0
CERTAIN = 0.9
#: No shape speaks more strongly than this against a label, so a repeated value can.
FLOOR = -4.0
ROUNDS = 8

_RUN_BACK = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits is tried from its first one only: what follows it is the same from any.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_DIGITS = re.compile(r"[^0-9]")
_SHAPE = re.compile(r"([0-9]{1,4})|([A-Za-z]+)|([^\x00-\x7f]+)|(\s+)|(.)", re.S)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _RUN_BACK.match(text, start - 1):
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            done = end.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns' matches, ordered; code points, end exclusive."""
    found = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    found.sort(key=lambda x: (x[0], x[2]))
    return found


@dataclass
class Node:
    start: int
    end: int
    label: int  # of a base span, OTHER elsewhere
    text: str
    base: bool


def nodes(text: str, base: list[tuple[int, int, int]]) -> list[Node]:
    """Base spans and the other tokens with a digit or an at sign, in order."""
    found = [Node(a, b, k, text[a:b], True) for a, b, k in base]
    pos, taken, ends = 0, 0, -1
    while m := _MARK.search(text, pos):
        at = m.start()
        while taken < len(base) and base[taken][0] <= at:
            ends = max(ends, base[taken][1])
            taken += 1
        if at < ends:
            pos = ends
            continue
        left = at
        while left > max(pos, ends) and not text[left - 1].isspace():
            left -= 1
        space = _SPACE.search(text, at)
        right = min(space.start() if space else len(text), base[taken][0] if taken < len(base) else len(text))
        pos = max(right, at + 1)
        while left < right and not (text[left].isalnum() or text[left] == "+"):
            left += 1
        while right > left and not text[right - 1].isalnum():
            right -= 1
        if right > left:
            found.append(Node(left, right, OTHER, text[left:right], False))
    found.sort(key=lambda n: (n.start, n.label))
    return found


def shape(token: str) -> int:
    """Bucket of a token's shape: runs of digits by length, other runs as one mark.

    A running hash takes in the marks of the whole token one by one.
    """
    h = 0
    for m in _SHAPE.finditer(token):
        h = zlib.crc32(b"9%d" % len(m[1]) if m[1] else b"a" if m[2] else b"u" if m[3] else b" " if m[4] else m[5].encode(errors="replace"), h)
    return int(mix(np.array([h], np.uint64))[0] % np.uint64(BUCKETS))


def keys(token: str) -> set[str]:
    """What repeated or similar tokens share: the letters and digits, or the last digits."""
    plain = "".join(c for c in token.lower() if c.isalnum())
    digits = _DIGITS.sub("", token)
    out = {"=" + plain} if len(plain) >= 6 else set()
    if len(digits) >= 7 and len(digits) >= 0.8 * len(plain):
        out.add("#" + digits[-7:])
    return out


def fit(documents: DataFrame) -> np.ndarray:
    """(buckets, labels) log-potentials of shapes, counted over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS * (OTHER + 1), np.int64)
        seen: dict[str, int] = {}
        for batch in batches:
            for text in batch["text"]:
                text = text.as_py()
                if text and _MARK.search(text):
                    for n in nodes(text, base_spans(text)):
                        sums[_shape(n.text, seen) * (OTHER + 1) + n.label] += 1
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["cell", "n"])

    counted = documents.select("text").mapInArrow(count, "cell bigint, n bigint")
    # buckets times labels: a bounded table
    table = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    sums = np.full(BUCKETS * (OTHER + 1), 0.02)
    sums[table["cell"].to_numpy()] += table["n"].to_numpy()
    sums = sums.reshape(BUCKETS, OTHER + 1)
    sums[:, OTHER] += 0.5
    return np.maximum(np.log(sums / sums.sum(axis=1, keepdims=True)), FLOOR)


def _shape(token: str, seen: dict[str, int]) -> int:
    if len(seen) > 50_000:
        seen.clear()
    if token not in seen:
        seen[token] = shape(token)
    return seen[token]


def marginals(found: list[Node], own: np.ndarray, chain: float = CHAIN, skip: float = SKIP, rounds: int = ROUNDS) -> np.ndarray:
    """(nodes, labels) beliefs after loopy message passing.

    A pair potential of ``chain`` (neighbours) or ``skip`` (members of a hub) is
    added where two labels agree. A hub is a label of its own that each member is
    tied to, which costs a message per member and not per pair.
    """
    hubs: dict[str, list[int]] = defaultdict(list)
    for i, n in enumerate(found):
        for k in keys(n.text):
            hubs[k].append(i)
    edges = [(i, len(found) + h, skip) for h, own_hub in enumerate(v for v in hubs.values() if len(v) > 1) for i in own_hub]
    total = max([len(found), *(j + 1 for _, j, _ in edges)])
    edges += [(i, i + 1, chain) for i in range(len(found) - 1)]
    belief = np.zeros((total, OTHER + 1))
    belief[: len(found)] = own
    if not edges:
        return _softmax(belief)[: len(found)]
    a, b = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    back = np.concatenate([np.arange(len(a), 2 * len(a)), np.arange(len(a))])
    bonus = np.exp(np.array([e[2] for e in edges] * 2))[:, None] - 1
    sent = np.zeros((len(source), OTHER + 1))
    prior = belief.copy()
    for _ in range(rounds):
        belief = prior.copy()
        np.add.at(belief, target, sent)
        p = _softmax(belief[source] - sent[back])
        fresh = np.log(1 + bonus * p)
        fresh -= fresh.mean(axis=1, keepdims=True)
        if np.abs(fresh - sent).max() < 1e-3:
            break
        sent = 0.5 * sent + 0.5 * fresh
    belief = prior.copy()
    np.add.at(belief, target, sent)
    return _softmax(belief)[: len(found)]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def label_text(text: str, odds: np.ndarray, seen: dict[str, int], certain: float = CERTAIN) -> tuple[list, list]:
    """(base spans, all spans) of one text."""
    if not _MARK.search(text):
        return [], []
    base = base_spans(text)
    found = nodes(text, base)
    rest = [n for n in found if not n.base]
    if not rest:
        return base, base
    own = odds[[_shape(n.text, seen) for n in found]]
    for i, n in enumerate(found):
        if n.base:
            own[i] = -12.0
            own[i, n.label] = 0.0
    shared = {k for n in found if n.base for k in keys(n.text)}
    alone = own[[not n.base for n in found], :OTHER].max() < np.log(0.05)
    if alone and not any(keys(n.text) & shared for n in rest):
        return base, base  # no node can reach certainty: nothing pulls one away from its shape
    p = marginals(found, own)
    extra = []
    for i, n in enumerate(found):
        k = int(p[i].argmax())
        if not n.base and k != OTHER and p[i, k] >= certain:
            extra.append((n.start, n.end, k))
    return base, sorted(base + extra, key=lambda x: (x[0], x[2]))


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def label(documents: DataFrame, odds: np.ndarray, certain: float = CERTAIN) -> DataFrame:
    """doc_id, base, spans: kind:start:end texts joined by commas, and counts of base spans."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            counts, bases, every = np.zeros((batch.num_rows, len(KINDS)), np.int64), [], []
            for i, text in enumerate(batch["text"]):
                base, spans = label_text(text.as_py() or "", odds, seen, certain)
                for _, _, k in base:
                    counts[i, k] += 1
                bases.append(spans_text(base))
                every.append(spans_text(spans))
            columns = [batch["doc_id"], *(pa.array(counts[:, k]) for k in range(len(KINDS))), pa.array(bases, pa.string()), pa.array(every, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kinds = ", ".join(f"n_{k} bigint" for k in KINDS)
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, f"doc_id bigint, {kinds}, base string, spans string")


def find(documents: DataFrame, certain: float = CERTAIN) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and the digest tell of base spans; ``spans`` holds these and what the
    field adds. Null and empty texts have none (the digest of the empty string).
    Kinds may overlap; within a kind spans do not. Repeated rows are treated
    alike; further columns are ignored.
    """
    found = label(documents, fit(documents), certain)
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def mask(documents: DataFrame, odds: np.ndarray, certain: float = CERTAIN) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, e.g. ``[EMAIL]``.

    Overlapping spans are replaced together, by the kind of the first. All other
    columns and null texts stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            texts = []
            for text in batch["text"].to_pylist():
                spans = label_text(text, odds, seen, certain)[1] if text else []
                parts, at = [], 0
                for a, b, k in spans:
                    if a >= at:
                        parts += [text[at:a], f"[{KINDS[k].upper()}]"]
                    at = max(at, b)
                texts.append(text if text is None or not spans else "".join([*parts, text[at:]]))
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, "text", pa.array(texts, batch.schema.field("text").type))

    return documents.mapInArrow(run, documents.schema)

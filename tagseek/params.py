"""Search settings: defaults, bounds and the five clause weights."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Ranking constants of the BM25 formula.
K1 = 1.2
B = 0.75

# N-gram sizes of the spelling dictionary, as
# (longest word the row applies to, smallest gram, largest gram).
GRAM_SIZES = ((4, 1, 2), (5, 2, 3), (None, 3, 4))

# Fixed value: shortest word the spelling dictionary holds.
MIN_WORD = 3

# Fixed value: a suggestion must be at least this similar.
MIN_SIMILARITY = 0.5


@dataclass(frozen=True)
class SearchParams:
    """Every knob of a search. Bad values raise instead of being ignored.

    ``wildcard_slop`` and ``max_expansions`` are separate on purpose: a
    wildcard phrase needs its words in order, while ``max_expansions`` limits
    how many vocabulary words (in byte order) each wildcard may stand for.
    ``fuzzy_terms`` does so for similar words; neither limits anything unless set.
    """

    boost_exact: float = 2.0
    boost_phonetic: float = 1.0
    boost_wildcard: float = 5.0
    boost_fuzzy: float = 5.0
    boost_prefix: float = 1.5
    max_search: int = 10
    slop: int = 2
    min_should_match: int = 1
    fuzzy_edits: int = 2
    fuzzy_terms: int | None = None
    wildcard_slop: int = 0
    max_expansions: int | None = None
    min_occur: int = 2
    fallback_below: int = 2
    per_term: int = 2
    max_combos: int = 5
    normalize: bool = True
    literal_phonetic: bool = False
    coarse_lengths: bool = False

    def __post_init__(self) -> None:
        bounds = {
            "max_search": (1, 100_000),
            "slop": (0, 100),
            "wildcard_slop": (0, 100),
            "min_should_match": (0, 10),
            "fuzzy_edits": (0, 2),
            "min_occur": (0, 100_000),
            "fallback_below": (0, 100_000),
            "per_term": (1, 10),
            "max_combos": (1, 100),
        }
        for name, (low, high) in bounds.items():
            value = getattr(self, name)
            if not isinstance(value, int) or not low <= value <= high:
                raise ValueError(f"{name} must be a whole number from {low} to {high}, got {value!r}")
        for name in ("fuzzy_terms", "max_expansions"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be None or at least 1, got {value!r}")
        for name in ("boost_exact", "boost_phonetic", "boost_wildcard", "boost_fuzzy", "boost_prefix"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")

    def but(self, **changes) -> "SearchParams":
        return replace(self, **changes)

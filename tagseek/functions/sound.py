"""Words to sound codes (primary Double Metaphone code, four characters).

The published algorithm is written down as a table of context rules. One
regular expression is built from it for each kind of word, and scanning a word
with that expression yields its code. Spark passes Arrow batches of word
arrays; each batch is reduced to its distinct words before any is encoded.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .inverted import ENTRIES, invert, listed

CODE_LENGTH = 4

# Kinds of words that switch rules on or off.
KINDS = {
    "slavic": r"[WK]|CZ",
    "sch": r"^SCH",
    "mc": r"^MC",
    "ranger": r"^(?:DANGER|RANGER|MANGER)",
    "four": r"^.{4}$",
}

# Per letter, (kind, context, code). The first rule that matches
# at a place gives the code, and the scan goes on after the text the rule
# consumed; a letter no rule matches is silent. A kind is needed, or with "!"
# forbidden; "" applies to all words.
V = "[AEIOUY]"
RULES = {
    "AEIOUY": [
        ("", rf"^{V}", "A"),
    ],
    "B": [
        ("", r"BB?", "P"),
    ],
    "Ç": [
        ("", "Ç", "S"),
    ],
    "C": [
        ("", r"CH(?=IA)", "K"),
        ("", rf"(?<=[^AEIOUY]A)CH(?=[^IE]|$)", "K"),
        ("", r"(?<=BA)CH(?=ER)|(?<=MA)CH(?=ER)", "K"),
        ("", r"^CA(?=ESAR)", "S"),
        ("", r"(?<=.)CH(?=AE)", "K"),
        ("", r"^CH(?=ARAC|ARIS|OR(?!E)|YM|IA|EM)", "K"),
        ("sch", r"CH", "K"),
        ("", r"(?<=OR)CH(?=ES|ID)|(?<=AR)CH(?=IT)|CH(?=[TS])", "K"),
        ("", r"(?:^|(?<=[AOUE]))CH(?=[LRNMBHFVW]|$)", "K"),
        ("mc", r"(?<=.)CH", "K"),
        ("", r"CH", "X"),
        ("", r"(?<!WI)CZ", "S"),
        ("", r"CCI(?=A)", "X"),
        ("", r"(?<=^A)CC(?=[IE]|H(?!U))[IEH]|(?<=U)CC(?=EE|ES)E", "KS"),
        ("", r"(?<!^M)CC(?=[IE]|H(?!U))[IEH]", "X"),
        ("", r"(?<!^M)CC|C[KGQ]", "K"),
        ("", r"C[IEY]", "S"),
        ("", r"C(?:[KQ]|C(?![EI]))?", "K"),
    ],
    "D": [
        ("", r"DG[IEY]", "J"),
        ("", r"DG", "TK"),
        ("", r"D[TD]?", "T"),
    ],
    "F": [
        ("", r"FF?", "F"),
    ],
    "G": [
        ("", r"^G(?=N)", ""),
        ("", r"(?<=[^AEIOUY])GH", "K"),
        ("", r"^GH(?=I)", "J"),
        ("", r"^GH", "K"),
        ("", r"(?<=[BHD].)GH|(?<=[BHD]..)GH|(?<=[BH]...)GH", ""),
        ("", r"(?<=[CGLRT].U)GH", "F"),
        ("", r"(?<=I)GH", ""),
        ("", r"GH", "K"),
        ("!slavic", r"(?<=^[AEIOUY])GN", "KN"),
        ("!slavic", r"GN(?!EY)", "N"),
        ("", r"GN", "KN"),
        ("!slavic", r"GL(?=I)", "KL"),
        ("", r"^G(?:Y|E(?=[SPBLYIR])|I(?=[BLNE]))", "K"),
        ("!ranger", r"(?<![EI])G(?:E(?=R)|(?<![RO]G)Y)", "K"),
        ("sch", r"G[EIY]|(?<=[AO])GG(?=I)", "K"),
        ("", r"GE(?=T)", "K"),
        ("", r"G[EIY]|(?<=[AO])GG(?=I)", "J"),
        ("", r"GG?", "K"),
    ],
    "H": [
        ("", rf"(?:^|(?<={V}))H{V}", "H"),
    ],
    "J": [
        ("four", r"J(?=OSE)", "H"),
        ("", r"J(?=OSE)", "J"),
        ("", r"^JJ?", "J"),
        ("!slavic", rf"(?<={V})J(?=[AO])", "J"),
        ("", r"J$", "J"),
        ("", r"(?<![SKL])J(?![LTKSNMBZ])J?", "J"),
        ("", r"JJ?", ""),
    ],
    "K": [
        ("", r"^K(?=N)", ""),
        ("", r"KK?", "K"),
    ],
    "L": [
        ("", r"LL?", "L"),
    ],
    "M": [
        ("", r"MM|(?<=U)M(?:B$|B(?=ER))", "M"),
        ("", r"M", "M"),
    ],
    "NÑ": [
        ("", r"NN?|Ñ", "N"),
    ],
    "P": [
        ("", r"^P(?=[NS])", ""),
        ("", r"PH", "F"),
        ("", r"P[PB]?", "P"),
    ],
    "Q": [
        ("", r"QQ?", "K"),
    ],
    "R": [
        ("!slavic", r"(?<=IE)(?<!ME..)(?<!MA..)R$", ""),
        ("", r"RR?", "R"),
    ],
    "S": [
        ("", r"(?<=[IY])S(?=L)", ""),
        ("", r"^S(?=UGAR)", "X"),
        ("", r"SH(?=EIM|OEK|OLM|OLZ)", "S"),
        ("", r"SH", "X"),
        ("", r"SI[OA]", "S"),
        ("", r"^S(?=[MNLW])", "S"),
        ("", r"SZ", "S"),
        ("", r"SCH(?=OO|UY|ED|EM)", "SK"),
        ("", r"SCH", "X"),
        ("", r"SC[IEY]", "S"),
        ("", r"SC(?:.|$)", "SK"),
        ("", r"(?<=[AO]I)S$", ""),
        ("", r"SS?", "S"),
    ],
    "T": [
        ("", r"TIO(?=N)|TIA|TCH", "X"),
        ("", r"TH(?=[OA]M)", "T"),
        ("sch", r"TH|TT(?=H)", "T"),
        ("", r"TH|TT(?=H)", "0"),
        ("", r"T[TD]?", "T"),
    ],
    "V": [
        ("", r"VV?", "F"),
    ],
    "W": [
        ("", r"^W(?=R)", ""),
        ("", r"WR", "R"),
        ("", rf"^W(?={V}|H)", "A"),
        ("", rf"(?<={V})W$|(?<=[EO])W(?=SK[IY])", ""),
        ("!sch", r"WI[CT]Z", "TS"),
    ],
    "X": [
        ("", r"^X", "S"),
        ("", r"(?<=[IE]AU)X$|(?<=[AO]U)X$", ""),
        ("", r"X[CX]?", "KS"),
    ],
    "Z": [
        ("", r"ZH", "J"),
        ("", r"ZZ?", "S"),
    ],
}


_KIND_TESTS = {name: re.compile(test) for name, test in KINDS.items()}
_ANY_KIND = re.compile("|".join(KINDS.values()))
_scanners: dict[tuple[str, ...], dict[str, tuple[re.Pattern, list[str]]]] = {}


def _scanner(kinds: tuple[str, ...]) -> dict[str, tuple[re.Pattern, list[str]]]:
    """One expression per letter, of the rules that apply to such words."""
    if kinds not in _scanners:
        table = _scanners[kinds] = {}
        for letters, rules in RULES.items():
            active = [
                (context, code)
                for kind, context, code in rules
                if not kind or (kind[1:] not in kinds if kind[0] == "!" else kind in kinds)
            ]
            compiled = re.compile("|".join(f"({context})" for context, _ in active))
            table.update(dict.fromkeys(letters, (compiled, [code for _, code in active])))
    return _scanners[kinds]


def sound_code(word: str) -> str:
    """The word's code, or the word itself where the code is empty."""
    upper = word.upper()
    kinds = tuple(name for name, test in _KIND_TESTS.items() if test.search(upper)) if _ANY_KIND.search(upper) else ()
    table = _scanner(kinds)
    code, place = "", 0
    while place < len(upper) and len(code) < CODE_LENGTH:
        letter = upper[place]
        found = None
        if letter in table and (place == 0 or letter not in "AEIOUY"):
            rules, codes = table[letter]
            found = rules.match(upper, place)
        if found:
            code += codes[found.lastindex - 1]
            place = found.end()
        else:
            place += 1
    return code[:CODE_LENGTH] or word


class _Codes(dict):
    """Codes of words met before; a new word is encoded when asked for."""

    def __missing__(self, word: str) -> str:
        self[word] = code = sound_code(word)
        return code


_known = _Codes()


def codes_of(spelled: pa.Array) -> pa.Array:
    if len(_known) > 500_000:  # frequent words come back soon; memory stays bounded
        _known.clear()
    return pa.array([_known[word] for word in listed(spelled)], pa.string())


def _encode(batch: pa.Array) -> pa.Array:
    distinct = batch.flatten().dictionary_encode()
    codes = codes_of(distinct.dictionary)
    return pa.ListArray.from_arrays(
        _offsets(batch), codes.take(distinct.indices), mask=batch.is_null() if batch.null_count else None
    )


def _offsets(batch: pa.Array) -> pa.Array:
    lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return pa.array([0, *lengths.cumsum().tolist()], pa.int32())


@F.arrow_udf(T.ArrayType(T.StringType()))
def sound_codes(words: pa.Array) -> pa.Array:
    """Code of every word of every array; NULL arrays stay NULL."""
    return _encode(words)


@F.arrow_udf(ENTRIES)
def sound_entries(words: pa.Array) -> pa.Array:
    """Every array inverted: an entry per distinct code, with the places of the words that have it."""
    return invert(words, "sound", codes_of)

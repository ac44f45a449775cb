"""The registered queries in DuckDB's SQL, from the raw tables alone."""

from __future__ import annotations

from .inputs import PHRASES, PLACES, TURNS_PER_FILE

WORD = (
    r"(?:[\p{L}\p{M}]+(?:[''’.:·][\p{L}\p{M}]+)*"
    r"|\p{N}+(?:[''’.,;]\p{N}+)*"
    r"|_+)+"
)

# The words of the sf0.01 corpus that share a query word's sound
# code, as Apache commons-codec gives them.
SOUND_ALIKE = {
    "double": "tible tibleea tibleou tieable tiouble tiwhble",
    "worthless": (
        "aerthlynt erathaly erathely erthly erthlyen erthlyer erthlyes erthlynd erthlyor erthlyst erthlyth erthlyti "
        "erthouly orthly worthless"
    ),
    "nicht": (
        "nicht äeinkeit äungheit äungte ñcoado ñcoadoí ñcoieta ñcota ñcotaó ñcoueado ñgaado ñgado ñgata ñqueado ñquedo "
        "ñqueta ñquetaie ñíqueta ñóquedo öungheit öungte"
    ),
    "public": "public",
    "domain": "demenauieie tamiñ",
    "domian": "demenauieie tamiñ",
    "of": (
        "aiaivi aiaiviè aioivi aiouvi aivi aiviai aiviaiè aiviaux aivieau aivioi aiviou aiviè aivié aiviê aièvi "
        "aiévi aiêaivi aiêvi auf eauoivi eauouvi eauvi eauvioi eauvié of ofwhheea oivi oiviaux oivieau oiviier "
        "oiviou oiviè oiviê oièvi ouaivi ouaivioi ouaièvi oueauoivi ouoivi ououaivi ououvi ououvié ouvi ouviaux "
        "ouvieau ouviier ouviè ouvié ouviê ouèoivi ouèvi ouévi ouéviier ouêaivi ouêvi "
    ),
    "the": (
        "th the thea theaea theaeaou theaou theaouea theawh theawhea theawhha theawhhe theawhou thha thhaea "
        "thhaeaea thhaeawh thhaou thhaouou thhawh thhawhea thhawhha thhawhou thhawhwh thhe thheea thheeaea "
        "thheeawh thheou thheouea thheouou thhewh thhewhhe thhewhou thou thouea thoueaea thoueaou thouou thououea "
        "thououwh thouwh thwh thwhea thwheaou thwhha thwhhaou thwhhawh thwhhe thwhheea thwhheou thwhou thwhouea "
        "thwhouwh thwhwh thwhwhou thwhwhwh "
    ),
}
SOUND_ALIKE["worthles"] = SOUND_ALIKE["worthless"]


def tokens(table: str = "documents", key: str = "doc_id", name: str = "tok", text: str = "text") -> str:
    return (
        f"{name} AS (SELECT {key} AS doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos, len(w) AS dl "
        f"FROM (SELECT {key}, regexp_extract_all(lower({text}), '{WORD}') AS w FROM {table}))"
    )


STATS = "st AS (SELECT count(DISTINCT doc_id) AS n, count(*) * 1.0 / count(DISTINCT doc_id) AS avgdl FROM tok)"
VOCAB = "v AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM tok GROUP BY term)"
BASE = f"{tokens()}, {STATS}, {VOCAB}"


def asked(name: str, alias: str = "q") -> str:
    rows = ", ".join(f"({i}, '{p}')" for i, p in enumerate(PHRASES[name], 1))
    return f"{alias} AS (SELECT query_id::BIGINT AS query_id, phrase FROM (VALUES {rows}) AS t(query_id, phrase))"


def slots(q: str = "q", name: str = "qt") -> str:
    return (
        f"{name} AS (SELECT query_id, unnest(w) AS term, unnest(range(len(w))) AS slot, len(w) AS n FROM "
        f"(SELECT query_id, regexp_extract_all(lower(phrase), '{WORD}') AS w FROM {q}))"
    )


def idf(df: str) -> str:
    return f"ln(1 + (st.n - {df} + 0.5) / ({df} + 0.5))"


def damped(freq: str, dl: str = "dl") -> str:
    return f"({freq} / ({freq} + 1.2 * (0.25 + 0.75 * {dl} / st.avgdl)))"


# how a query's words, one per slot, follow each other in a record
def phrase_freq(qt: str = "qt", tok: str = "tok") -> str:
    return (
        "SELECT query_id, doc_id, dl, count(*) AS freq FROM ("
        f"SELECT x.query_id, t.doc_id, t.dl, t.pos - x.slot AS spot, count(DISTINCT x.slot) AS held, any_value(x.n) AS n "
        f"FROM {tok} t JOIN {qt} x ON t.term = x.term GROUP BY x.query_id, t.doc_id, t.dl, t.pos - x.slot"
        ") WHERE held = n GROUP BY query_id, doc_id, dl"
    )


# Two different words within ``slop`` moves of each other: a window lies between
# neighbours of different slots, or where both have a place; ``state`` is the slot
# (1: the first) the sweep stands on after a place. One word counts as in phrase_freq.
def sloppy_freq(qt: str, slop: int, tok: str = "tok", width: bool = False) -> str:
    by = "PARTITION BY query_id, doc_id"
    pairs = (
        f"SELECT query_id, doc_id, any_value(dl) AS dl, sum(CASE WHEN gap <= {slop} THEN 1.0 / (1 + gap) ELSE 0 END)::DOUBLE AS freq, "
        f"min(CASE WHEN gap <= {slop} THEN gap END)::BIGINT AS width FROM ("
        "SELECT *, CASE WHEN a AND b THEN 0 WHEN before IS NOT NULL AND before <> a::INT THEN spot - last END AS gap FROM ("
        f"SELECT *, lag(state) OVER ({by} ORDER BY spot) AS before, lag(spot) OVER ({by} ORDER BY spot) AS last FROM ("
        "SELECT *, (coalesce(max(CASE WHEN NOT (a AND b) THEN a::INT END) OVER (PARTITION BY query_id, doc_id, grp), 1) "
        "+ sum((a AND b)::INT) OVER (PARTITION BY query_id, doc_id, grp ORDER BY spot)) % 2 AS state FROM ("
        f"SELECT *, sum((NOT (a AND b))::INT) OVER ({by} ORDER BY spot) AS grp FROM ("
        "SELECT x.query_id, t.doc_id, any_value(t.dl) AS dl, t.pos - x.slot AS spot, bool_or(x.slot = 0) AS a, bool_or(x.slot = 1) AS b "
        f"FROM {tok} t JOIN {qt} x ON t.term = x.term WHERE x.n = 2 GROUP BY x.query_id, t.doc_id, t.pos - x.slot))))) "
        "GROUP BY query_id, doc_id HAVING count(gap) FILTER (gap <= "
        f"{slop}) > 0"
    )
    if width:
        return pairs
    return f"SELECT query_id, doc_id, dl, freq FROM ({pairs}) UNION ALL {phrase_freq(f'(SELECT * FROM {qt} WHERE n = 1)', tok)}"


def freq_within(qt: str, slop: int) -> str:
    return sloppy_freq(qt, slop) if slop else phrase_freq(qt)


def phrase_score(qt: str = "qt", boost: float = 1.0, slop: int = 0) -> str:
    return (
        f"SELECT f.query_id, f.doc_id, {boost} * i.idf * {damped('f.freq', 'f.dl')} AS score "
        f"FROM ({freq_within(qt, slop)}) f JOIN (SELECT x.query_id, sum({idf('v.df')}) AS idf FROM {qt} x JOIN v ON v.term = x.term, st "
        "GROUP BY x.query_id) i ON i.query_id = f.query_id, st"
    )


def like(pattern: str) -> str:
    """A pattern column as an anchored regular expression (word signs only)."""
    return f"replace(replace(replace({pattern}, '.', '[.]'), '*', '.*'), '?', '.')"


# one letter each for letters that take two bytes, so that distances count letters
def flat(term: str) -> str:
    return f"translate({term}, 'ßäçèéêíñóöü', 'ABCDEFGHIJK')"


def exact_clauses(q: str = "q", p: str = "", slop: int = 0) -> str:
    """CTEs giving every clause's hits (query_id, clause, doc_id, score)."""
    parts = [
        slots(q, f"{p}qt"),
        f"{p}glue AS (SELECT query_id, string_agg(term, '' ORDER BY slot) AS term, 0 AS slot, 1 AS n FROM {p}qt "
        "GROUP BY query_id HAVING count(*) >= 2)",
        f"{p}raw AS (SELECT query_id, unnest(w) AS word, unnest(range(len(w))) AS slot, len(w) AS n FROM "
        f"(SELECT query_id, list_filter(regexp_split_to_array(lower(phrase), '\\s+'), lambda x: x <> '') AS w FROM {q} "
        "WHERE phrase LIKE '%*%' OR phrase LIKE '%?%'))",
        f"{p}wt AS (SELECT r.query_id, r.slot, r.n, v.term, v.df FROM {p}raw r JOIN v "
        f"ON regexp_full_match(v.term, {like('r.word')}))",
        f"{p}wone AS (SELECT DISTINCT w.query_id, t.doc_id FROM {p}wt w JOIN tok t ON t.term = w.term WHERE w.n = 1)",
        f"{p}wmany AS ({phrase_freq(f'(SELECT * FROM {p}wt WHERE n > 1)')})",
        f"{p}widf AS (SELECT query_id, sum({idf('df')}) AS idf FROM {p}wt, st GROUP BY query_id)",
        f"{p}lookalike AS (SELECT DISTINCT query_id, lower(rtrim(word, '~')) AS word FROM (SELECT query_id, "
        f"unnest(regexp_split_to_array(phrase, '\\s+')) AS word FROM {q}) WHERE word LIKE '%~')",
        f"{p}near AS (SELECT query_id, term, df, 1 - d * 1.0 / least(length(word), length(term)) AS weight FROM ("
        f"SELECT l.query_id, l.word, v.term, v.df, damerau_levenshtein({flat('l.word')}, {flat('v.term')}) AS d "
        f"FROM {p}lookalike l JOIN v ON abs(length(v.term) - length(l.word)) <= 2) "
        "WHERE d <= 2 AND d < least(length(word), length(term)))",
        f"{p}most AS (SELECT query_id, max(df) AS df FROM {p}near GROUP BY query_id)",
        f"{p}tf AS (SELECT doc_id, term, dl, count(*) AS freq FROM tok GROUP BY doc_id, term, dl)",
        f"{p}ch AS ("
        f"SELECT query_id, 'phrase' AS clause, doc_id, score FROM ({phrase_score(f'{p}qt', 2.0, slop)}) UNION ALL "
        f"SELECT query_id, 'glued', doc_id, score FROM ({phrase_score(f'{p}glue', 1.5)}) UNION ALL "
        f"SELECT f.query_id, 'hyphen', f.doc_id, 1.5 * i.idf * {damped('f.freq', 'f.dl')} FROM {p}hyph f "
        f"JOIN (SELECT x.query_id, sum({idf('v.df')}) AS idf FROM {p}qt x JOIN v ON v.term = x.term, st GROUP BY x.query_id) i "
        "ON i.query_id = f.query_id, st UNION ALL "
        f"SELECT query_id, 'wildcard', doc_id, 5.0 FROM {p}wone UNION ALL "
        f"SELECT m.query_id, 'wildcard', m.doc_id, 5.0 * i.idf * {damped('m.freq', 'm.dl')} FROM {p}wmany m "
        f"JOIN {p}widf i ON i.query_id = m.query_id, st UNION ALL "
        f"SELECT query_id, 'prefix', doc_id, 1.5 FROM {p}wone WHERE query_id IN (SELECT query_id FROM {q} "
        "WHERE regexp_full_match(phrase, '[^*? ]+[*]')) UNION ALL "
        f"SELECT n.query_id, 'fuzzy', t.doc_id, sum(5.0 * n.weight * {idf('m.df')} * {damped('t.freq', 't.dl')}) "
        f"FROM {p}near n JOIN {p}most m ON m.query_id = n.query_id JOIN {p}tf t ON t.term = n.term, st "
        "GROUP BY n.query_id, t.doc_id)",
    ]
    # the hyphenated form in the raw text of records that hold the words in order
    hyph = (
        f"{p}hyph AS (SELECT * FROM (SELECT c.query_id, c.doc_id, c.dl, len(regexp_extract_all(lower(d.text), "
        rf"'(?:^|[^\p{{L}}\p{{N}}\p{{M}}_])' || f.form || '(?:$|[^\p{{L}}\p{{N}}\p{{M}}_])')) AS freq "
        f"FROM ({phrase_freq(f'{p}qt')}) c JOIN (SELECT query_id, string_agg(term, '-' ORDER BY slot) AS form FROM {p}qt "
        "GROUP BY query_id HAVING count(*) >= 2) f ON f.query_id = c.query_id JOIN documents d ON d.doc_id = c.doc_id) WHERE freq > 0)"
    )
    parts.insert(-1, hyph)
    return ", ".join(parts)


def combined(p: str = "", least: int = 1) -> str:
    return (
        f"{p}hits AS (SELECT query_id, doc_id, round(sum(score), 6) AS score FROM {p}ch GROUP BY query_id, doc_id "
        f"HAVING count(*) >= {least})"
    )


def best(p: str = "", n: int = 10, hits: str | None = None) -> str:
    return (
        f"{p}top AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank "
        f"FROM {hits or p + 'hits'} QUALIFY rank <= {n})"
    )


def tagged(p: str = "") -> str:
    return (
        f"{p}tags AS (SELECT t.query_id, d.source AS bookmark_tag, round(sum(t.score), 6) AS score, min(t.rank) AS first_rank "
        f"FROM {p}top t JOIN documents d ON d.doc_id = t.doc_id GROUP BY t.query_id, d.source)"
    )


def counted(q: str = "q", p: str = "") -> str:
    return (
        f"{p}totals AS (SELECT q0.query_id, count(h.doc_id) AS total_hits FROM {q} q0 LEFT JOIN {p}hits h "
        "ON h.query_id = q0.query_id GROUP BY q0.query_id)"
    )


def exact_flow(q: str = "q", p: str = "", slop: int = 0) -> str:
    return ", ".join([exact_clauses(q, p, slop), combined(p), best(p), tagged(p), counted(q, p)])


def phonetic_flow(q: str, p: str, slop: int = 0) -> str:
    """Words sharing a query word's code stand for it; its df counts them all."""
    rows = ", ".join(f"('{word}', '{alike}')" for word, alikes in SOUND_ALIKE.items() for alike in alikes.split())
    return ", ".join(
        [
            f"{p}alike AS (SELECT * FROM (VALUES {rows}) AS t(word, term))",
            slots(q, f"{p}asked"),
            f"{p}qt AS (SELECT a.query_id, a.slot, a.n, a.term AS word, l.term FROM {p}asked a JOIN {p}alike l ON l.word = a.term)",
            f"{p}cdf AS (SELECT l.word, count(DISTINCT t.doc_id) AS df FROM {p}alike l JOIN tok t ON t.term = l.term GROUP BY l.word)",
            f"{p}cidf AS (SELECT a.query_id, sum({idf('c.df')}) AS idf FROM {p}asked a JOIN {p}cdf c ON c.word = a.term, st "
            "GROUP BY a.query_id)",
            f"{p}freq AS ({freq_within(f'{p}qt', slop)})",
            f"{p}ch AS (SELECT f.query_id, f.doc_id, i.idf * {damped('f.freq', 'f.dl')} AS score FROM {p}freq f "
            f"JOIN {p}cidf i ON i.query_id = f.query_id, st)",
            combined(p),
            best(p),
            tagged(p),
            counted(q, p),
        ]
    )


def gram_rows(source: str, word: str = "word") -> str:
    low = f"CASE WHEN length({word}) > 5 THEN 3 WHEN length({word}) = 5 THEN 2 ELSE 1 END"
    return (
        f"SELECT DISTINCT {word}, substring({word}, i, n) AS gram FROM (SELECT {word}, n, unnest(range(1, length({word}) - n + 2)) AS i "
        f"FROM (SELECT {word}, unnest([{low}, {low} + 1]) AS n FROM {source}))"
    )


DICTIONARY = f"dict AS (SELECT term FROM v WHERE length(term) >= 3), dgrams AS ({gram_rows('dict', 'term')})"


def suggestions(words: str = "words", p: str = "") -> str:
    """CTE ``alikes``: the two most similar dictionary words per word."""
    return (
        f"{p}wgrams AS ({gram_rows(words)}), {p}pairs AS (SELECT DISTINCT w.word, d.term FROM {p}wgrams w JOIN dgrams d ON d.gram = w.gram "
        "WHERE d.term <> w.word), "
        f"{p}alikes AS (SELECT word, term AS suggestion, round(s, 6) AS similarity, row_number() OVER (PARTITION BY word ORDER BY s DESC, term) AS place "
        f"FROM (SELECT word, term, 1 - levenshtein({flat('word')}, {flat('term')}) * 1.0 / greatest(length(word), length(term)) AS s FROM {p}pairs) "
        "WHERE s >= 0.5 QUALIFY place <= 2)"
    )


def spelling(q: str = "q") -> str:
    """CTEs from queries to ``spelled`` (query_id, place, suggestion)."""
    return ", ".join(
        [
            slots(q, "sq"),
            DICTIONARY,
            f"forms AS (SELECT a.query_id, f.form, f.word FROM {q} a JOIN (SELECT query_id, 0 AS form, string_agg(term, '' ORDER BY slot) AS word "
            "FROM sq GROUP BY query_id UNION ALL SELECT query_id, 1, string_agg(term, '-' ORDER BY slot) FROM sq GROUP BY query_id) f "
            "ON f.query_id = a.query_id WHERE lower(f.word) <> lower(a.phrase))",
            "words AS (SELECT DISTINCT term AS word FROM sq UNION SELECT word FROM forms)",
            "unknown AS (SELECT word FROM words WHERE word NOT IN (SELECT term FROM dict))",
            suggestions("unknown"),
            "choices AS (SELECT s.query_id, s.slot, s.n, coalesce(m.suggestion, s.term) AS choice, coalesce(m.place, 1) AS spot "
            "FROM sq s LEFT JOIN alikes m ON m.word = s.term)",
            "grown AS (SELECT query_id, 0 AS slot, n, choice AS text, [spot] AS path FROM choices WHERE slot = 0 UNION ALL "
            "SELECT g.query_id, c.slot, g.n, g.text || ' ' || c.choice, list_append(g.path, c.spot) FROM grown g JOIN choices c "
            "ON c.query_id = g.query_id AND c.slot = g.slot + 1)",
            "phrases AS (SELECT query_id, text AS suggestion, row_number() OVER (PARTITION BY query_id ORDER BY path) - 1 AS place "
            "FROM grown WHERE slot = n - 1 QUALIFY place < 5)",
            "compounds AS (SELECT f.query_id, f.form, coalesce(m.place, 1) - 1 AS place, coalesce(m.suggestion, f.word) AS suggestion "
            "FROM forms f LEFT JOIN alikes m ON m.word = f.word WHERE m.word IS NOT NULL OR f.word IN (SELECT term FROM dict))",
            "once AS (SELECT query_id, suggestion, min((form, place)) AS seen FROM (SELECT query_id, -1 AS form, place, suggestion "
            "FROM phrases UNION ALL SELECT query_id, form, place, suggestion FROM compounds) GROUP BY query_id, suggestion)",
            f"spelled AS (SELECT o.query_id, o.suggestion, row_number() OVER (PARTITION BY o.query_id ORDER BY o.seen) AS place "
            f"FROM once o JOIN {q} a ON a.query_id = o.query_id WHERE o.suggestion <> a.phrase QUALIFY place <= 5)",
        ]
    )


def fallback(q: str, totals: str, slop: int = 0) -> str:
    """CTEs ending in ``ftags``, ``ftotals`` per original query."""
    return ", ".join(
        [
            f"scarce AS (SELECT a.* FROM {q} a JOIN {totals} c ON c.query_id = a.query_id WHERE c.total_hits < 2)",
            spelling("scarce"),
            "fq AS (SELECT DISTINCT suggestion AS query_id, suggestion AS phrase FROM spelled)",
            exact_flow("fq", "s_", slop),
            "ftags AS (SELECT p.query_id, t.bookmark_tag, t.score, p.place + 1 AS source_order, t.first_rank FROM s_tags t "
            "JOIN spelled p ON p.suggestion = t.query_id)",
            "ftotals AS (SELECT p.query_id, sum(t.total_hits) AS total_hits FROM s_totals t JOIN spelled p "
            "ON p.suggestion = t.query_id GROUP BY p.query_id)",
        ]
    )


def ranked(merged: str) -> str:
    return (
        f"SELECT query_id, bookmark_tag, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seen) AS place FROM ({merged})"
    )


def merged(*sets: str) -> str:
    united = " UNION ALL ".join(sets)
    return (
        f"SELECT query_id, bookmark_tag, round(sum(score), 6) AS score, min((source_order, first_rank)) AS seen FROM ({united}) "
        "GROUP BY query_id, bookmark_tag"
    )


def part(name: str, order: int) -> str:
    return f"SELECT query_id, bookmark_tag, score, {order} AS source_order, first_rank FROM {name}"


EXACT = f"{BASE}, {asked('exact')}, {exact_clauses()}"
TURNS = (
    "turns AS (SELECT conv_id * 1000000 + turn AS doc_id, conv_id, turn, role, text FROM conversations)"
)
T_BASE = f"{TURNS}, {tokens('turns')}, {STATS}, {VOCAB}"
SPELL = f"{BASE}, {asked('spelling')}, {spelling()}"
TWO_SETS = ", ".join(
    [
        EXACT,
        "a_hits AS (SELECT query_id, doc_id, round(score, 6) AS score FROM ch WHERE clause = 'phrase')",
        best("a_"),
        tagged("a_"),
        "b_hits AS (SELECT query_id, doc_id, round(score, 6) AS score FROM ch WHERE clause = 'wildcard')",
        best("b_"),
        tagged("b_"),
    ]
)
BOTH = merged(part("a_tags", 0), part("b_tags", 1))


def _sloppy() -> str:
    return (
        f"WITH {tokens()}, {asked('phrase_sloppy')}, {slots()}, "
        "e AS (SELECT x.query_id, t.doc_id, x.slot, x.n, t.pos - x.slot AS spot FROM tok t JOIN qt x ON x.term = t.term), "
        "r AS (SELECT a.query_id, a.doc_id, a.slot, a.spot, b.slot AS other, min(b.spot) - a.spot AS gap, any_value(a.n) AS n FROM e a JOIN e b "
        "ON b.query_id = a.query_id AND b.doc_id = a.doc_id AND b.slot <> a.slot AND b.spot >= a.spot GROUP BY a.query_id, a.doc_id, a.slot, a.spot, b.slot), "
        "w AS (SELECT query_id, doc_id, max(gap) AS width FROM r GROUP BY query_id, doc_id, slot, spot HAVING count(*) = any_value(n) - 1) "
        "SELECT query_id, doc_id, min(width)::BIGINT AS width FROM w GROUP BY query_id, doc_id HAVING min(width) <= 2"
    )


def _exact_search(slop: int) -> str:
    return (
        f"WITH {BASE}, {asked('exact')}, {exact_flow(slop=slop)} SELECT t.query_id, t.bookmark_tag, t.score, t.first_rank, c.total_hits "
        "FROM tags t JOIN totals c ON c.query_id = t.query_id"
    )


def _phonetic_search(slop: int) -> str:
    return (
        f"WITH {BASE}, {asked('phonetic')}, {phonetic_flow('q', 'f_', slop)} SELECT t.query_id, t.bookmark_tag, t.score, t.first_rank, c.total_hits "
        "FROM f_tags t JOIN f_totals c ON c.query_id = t.query_id"
    )


def _full_search(slop: int) -> str:
    return (
        f"WITH RECURSIVE {BASE}, {asked('full')}, {exact_flow('q', 'e_', slop)}, {phonetic_flow('q', 'f_', slop)}, "
        "first AS (SELECT e.query_id, e.total_hits + f.total_hits AS total_hits FROM e_totals e JOIN f_totals f ON f.query_id = e.query_id), "
        f"{fallback('q', 'first', slop)}, alltotals AS (SELECT a.query_id, (a.total_hits + coalesce(b.total_hits, 0))::BIGINT AS total_hits FROM first a "
        "LEFT JOIN ftotals b ON b.query_id = a.query_id), "
        f"r AS ({ranked(merged(part('e_tags', 0), part('f_tags', 1), 'SELECT * FROM ftags'))}) "
        "SELECT r.query_id, r.place, r.bookmark_tag, r.score, c.total_hits FROM r JOIN alltotals c ON c.query_id = r.query_id WHERE c.total_hits > 2"
    )


def _clause_plan() -> str:
    q = (
        f"{asked('clauses', 'q1')}, q AS (SELECT * FROM q1 UNION ALL SELECT item_id + 1000, text FROM benchmark), "
        f"a AS (SELECT query_id, phrase, regexp_extract_all(lower(phrase), '{WORD}') AS w, "
        "list_filter(regexp_split_to_array(phrase, '\\s+'), lambda x: x <> '') AS r FROM q)"
    )
    wild = "(contains(phrase, '*') OR contains(phrase, '?'))"
    return (
        f"WITH {q} SELECT query_id, clause, words, boost FROM ("
        "SELECT query_id, 'phrase' AS clause, array_to_string(w, ' ') AS words, 2.0::DOUBLE AS boost FROM a WHERE len(w) > 0 UNION ALL "
        "SELECT query_id, 'fuzzy:0', lower(regexp_replace(phrase, '~$', '')), 5.0 FROM a WHERE contains(phrase, '~') AND NOT contains(phrase, ' ') "
        "AND phrase <> '~' UNION ALL "
        "SELECT query_id, 'fuzzy:' || (row_number() OVER (PARTITION BY query_id ORDER BY i) - 1), lower(word[:-2]), 5.0 FROM "
        "(SELECT query_id, unnest(r) AS word, unnest(range(len(r))) AS i FROM a WHERE contains(phrase, '~') AND contains(phrase, ' ')) "
        "WHERE word LIKE '%_~' UNION ALL "
        f"SELECT query_id, 'wildcard', lower(array_to_string(r, ' ')), 5.0 FROM a WHERE {wild} UNION ALL "
        "SELECT query_id, 'prefix', lower(trim(phrase)), 1.5 FROM a WHERE len(w) = 1 AND regexp_full_match(trim(phrase), '[^*?]+[*]') UNION ALL "
        "SELECT query_id, 'glued', array_to_string(w, ''), 1.5 FROM a WHERE len(w) >= 2 UNION ALL "
        "SELECT query_id, 'hyphen', array_to_string(w, ' '), 1.5 FROM a WHERE len(w) >= 2)"
    )


def _pattern(name: str, phrase: bool = False) -> str:
    raw = (
        "raw AS (SELECT query_id, unnest(w) AS word, unnest(range(len(w))) AS slot, len(w) AS n FROM "
        "(SELECT query_id, regexp_split_to_array(lower(phrase), '\\s+') AS w FROM q)), "
        f"wt AS (SELECT r.query_id, r.slot, r.n, v.term, v.df FROM raw r JOIN v ON regexp_full_match(v.term, {like('r.word')}))"
    )
    one = "SELECT DISTINCT w.query_id, t.doc_id, 1.0::DOUBLE AS score FROM wt w JOIN tok t ON t.term = w.term WHERE w.n = 1"
    if not phrase:
        return f"WITH {BASE}, {asked(name)}, {raw} {one}"
    return (
        f"WITH {BASE}, {asked(name)}, {raw}, many AS ({phrase_freq('(SELECT * FROM wt WHERE n > 1)')}), "
        f"i AS (SELECT query_id, sum({idf('df')}) AS idf FROM wt, st GROUP BY query_id) {one} UNION ALL "
        f"SELECT m.query_id, m.doc_id, round(i.idf * {damped('m.freq', 'm.dl')}, 6) FROM many m JOIN i ON i.query_id = m.query_id, st"
    )


def _freq(name: str) -> str:
    return f"WITH {tokens()}, {asked(name)}, {slots()} SELECT query_id, doc_id, freq FROM ({phrase_freq()})"


TREE_FIELDS = (
    "SELECT conv_id || '/' || turn AS filename, 2 AS depth, 'bookmark_tag' AS field, 'string' AS type, 'tag-' || conv_id AS value FROM conversations "
    "UNION ALL SELECT conv_id || '/' || turn, 2, 'text', 'string', text FROM conversations "
    "UNION ALL SELECT conv_id || '/' || turn, 2, 'start', 'bigint', turn::VARCHAR FROM conversations "
    "UNION ALL SELECT conv_id || '/' || turn, 2, 'end', 'double', (turn + 0.5)::DOUBLE::VARCHAR FROM conversations "
    "UNION ALL SELECT conv_id || '/' || turn, 3, 'role', 'string', role FROM conversations"
)



def followers(table: str, key: str, pos: str, term: str) -> str:
    """Every word with the two after it."""
    over = f"OVER (PARTITION BY {key} ORDER BY {pos})"
    return f"SELECT *, {term} AS one, lead({term}) {over} AS two, lead({term}, 2) {over} AS three FROM {table}"


# the benchmark's words as queries, and the records that hold one with its next
ASKED_WORDS = (
    f"asked AS (WITH {tokens('benchmark', 'item_id')} SELECT doc_id * {PLACES} + pos AS query_id, one, two, three "
    f"FROM ({followers('tok', 'doc_id', 'pos', 'term')}))"
)
RUNS = (
    f"runs AS (SELECT doc_id, dl, one, two, count(*) AS freq FROM ({followers('tok', 'doc_id', 'pos', 'term')}) GROUP BY doc_id, dl, one, two), "
    "pairs AS (SELECT query_id, doc_id, dl, freq, one, two FROM asked JOIN runs USING (one, two))"
)
RUN_HITS = (
    f"{BASE}, {ASKED_WORDS}, {RUNS}, hits AS (SELECT query_id, doc_id, "
    f"round(({idf('a.df')} + {idf('b.df')}) * {damped('freq')}, 6) AS score FROM pairs JOIN v a ON a.term = one JOIN v b ON b.term = two, st), {best()}"
)

ORACLES = {
    "json_file_scan": (
        "SELECT conv_id, turn, role, text, true AS named, count(*) OVER (PARTITION BY (conv_id + turn) % n) AS file_turns "
        f"FROM conversations, (SELECT greatest(1, count(*) // {TURNS_PER_FILE}) AS n FROM conversations)"
    ),
    "json_flatten": (
        "SELECT conv_id || '/' || turn AS filename, n.depth, n.path, CASE WHEN n.path = '1.0' THEN text END AS text, "
        "CASE WHEN n.path = '1.0.2' THEN role END AS role FROM conversations, (VALUES (0, ''), (1, '0'), (2, '0.0'), (2, '1.0'), "
        "(3, '1.0.1')) AS n(depth, path)"
    ).replace("'1.0.2'", "'1.0.1'"),
    "json_file_tag": (
        "SELECT conv_id || '/' || turn AS filepath, 'tag-' || conv_id AS bookmark_tag, 5::BIGINT AS records FROM conversations"
    ),
    "json_typed_fields": (
        "SELECT event_id::VARCHAR AS filename, 0 AS depth, unnest(json_keys(props)) AS field, 'bigint' AS type, "
        f"json_extract_string(props, '$.' || unnest(json_keys(props))) AS value FROM events UNION ALL {TREE_FIELDS}"
    ),
    "index_roundtrip": f"WITH {T_BASE} SELECT term, df, cf FROM v",
    "index_postings": f"WITH {T_BASE} SELECT term, doc_id, dl, string_agg(pos, ' ' ORDER BY pos) AS places FROM tok GROUP BY term, doc_id, dl",
    "index_stats": f"WITH {tokens()} SELECT (SELECT count(*) FROM documents) AS docs, count(*) AS tokens, count(DISTINCT term) AS terms FROM tok",
    "exact_postings": f"WITH {tokens()} SELECT term, doc_id, pos FROM tok",
    "vocabulary": f"WITH {tokens()}, {VOCAB} SELECT term, df, cf FROM v",
    "corpus_stats": f"WITH {tokens()}, {STATS} SELECT n AS n_docs, (SELECT count(*) FROM tok) AS n_tokens, round(avgdl, 6)::DOUBLE AS avgdl FROM st",
    "query_tokens": f"WITH {tokens('benchmark', 'item_id')} SELECT doc_id AS query_id, pos AS slot, term FROM tok",
    "many_terms": (
        f"WITH {tokens()}, {ASKED_WORDS} "
        "SELECT query_id, tok.doc_id, count(*) AS freq FROM asked JOIN tok ON tok.term = one GROUP BY query_id, tok.doc_id"
    ),
    "every_phrase": f"WITH {tokens()}, {ASKED_WORDS}, {RUNS} SELECT query_id, doc_id, freq FROM pairs",
    "many_phrases": (
        f"WITH {tokens()}, {ASKED_WORDS}, runs AS (SELECT doc_id, one, two, three, count(*) AS freq FROM ({followers('tok', 'doc_id', 'pos', 'term')}) GROUP BY ALL) "
        "SELECT query_id, doc_id, freq FROM asked JOIN runs USING (one, two, three)"
    ),
    "many_prefixes": (
        f"WITH {tokens()}, {ASKED_WORDS} SELECT DISTINCT query_id, doc_id, 1.0::DOUBLE AS score FROM asked "
        "JOIN (SELECT DISTINCT doc_id, left(term, 5) AS head FROM tok) ON left(one, 5) = head WHERE length(one) > 5"
    ),
    "many_glued": (
        f"WITH {tokens()}, {ASKED_WORDS} SELECT query_id, tok.doc_id, count(*) AS freq FROM asked JOIN tok ON tok.term = one || two GROUP BY query_id, tok.doc_id"
    ),
    "many_top_hits": f"WITH {RUN_HITS} SELECT t.query_id, t.doc_id, t.score, t.rank, n.total_hits FROM top t JOIN (SELECT query_id, count(*) AS total_hits FROM hits GROUP BY query_id) n USING (query_id)",
    "many_tag_scores": f"WITH {RUN_HITS}, {tagged()} SELECT query_id, bookmark_tag, score, first_rank FROM tags",
    "many_hit_details": (
        f"WITH {RUN_HITS} SELECT t.query_id, t.rank, t.doc_id, t.score, '?' AS start, '?' AS \"end\", d.text FROM top t JOIN documents d ON d.doc_id = t.doc_id"
    ),
    "term_match": _freq("term_match"),
    "phrase_exact": _freq("phrase_exact"),
    "phrase_sloppy": _sloppy(),
    "sloppy_scores": (
        f"WITH {BASE}, {asked('phrase_sloppy')}, {slots()} SELECT f.query_id, f.doc_id, f.width, round(f.freq, 6) AS freq, round(s.score, 6) AS score "
        f"FROM ({sloppy_freq('qt', 2, width=True)}) f JOIN ({phrase_score(slop=2)}) s ON s.query_id = f.query_id AND s.doc_id = f.doc_id"
    ),
    "phonetic_phrase": f"WITH {BASE}, {asked('phonetic_phrase')}, {phonetic_flow('q', 'f_')} SELECT query_id, doc_id, freq FROM f_freq",
    "prefix_match": _pattern("prefix_match"),
    "wildcard_match": _pattern("wildcard_match"),
    "wildcard_phrase": _pattern("wildcard_phrase", phrase=True),
    "fuzzy_match": (
        f"WITH {BASE}, q0 AS (SELECT * FROM (VALUES {', '.join(f'({i}, {chr(39)}{p}{chr(39)})' for i, p in enumerate(PHRASES['fuzzy_match'], 1))}) "
        "AS t(query_id, phrase)), q AS (SELECT query_id::BIGINT AS query_id, rtrim(phrase, '~') || '~' AS phrase FROM q0), "
        f"{exact_clauses()} SELECT query_id, doc_id, round(score / 5.0, 6) AS score FROM ch WHERE clause = 'fuzzy'"
    ),
    "glued_match": (
        f"WITH {tokens()}, {asked('glued_match')}, {slots()}, glue AS (SELECT query_id, string_agg(term, '' ORDER BY slot) AS term, 0 AS slot, "
        f"1 AS n FROM qt GROUP BY query_id HAVING count(*) >= 2) SELECT query_id, doc_id, freq FROM ({phrase_freq('glue')})"
    ),
    "hyphen_match": f"WITH {BASE}, {asked('hyphen_match')}, {exact_clauses()} SELECT query_id, doc_id, freq FROM hyph",
    "boosted_scores": (
        f"WITH {BASE}, {asked('phrase_exact')}, {slots()}, {asked('prefix_match', 'pq')} "
        f"SELECT 'exact' AS kind, query_id, doc_id, round(score, 6) AS score FROM ({phrase_score('qt', 2.0)}) UNION ALL "
        "SELECT DISTINCT 'prefix', p.query_id, t.doc_id, 1.5 FROM pq p JOIN tok t ON t.term LIKE replace(p.phrase, '*', '%')"
    ),
    "clause_plan": _clause_plan(),
    "boolean_or": f"WITH {EXACT}, {combined('', 2)} SELECT query_id, doc_id, score FROM hits",
    "bm25_rank": (
        f"WITH {BASE}, {asked('term_match')}, {slots()} SELECT query_id, doc_id, round(score, 6) AS score FROM ({phrase_score()})"
    ),
    "top_n_hits": f"WITH {EXACT}, {combined()}, {best()} SELECT query_id, doc_id, score, rank FROM top",
    "total_hits": f"WITH {EXACT}, {combined()}, {counted()} SELECT query_id, total_hits FROM totals",
    "tag_scores": f"WITH {EXACT}, {combined()}, {best()}, {tagged()} SELECT query_id, bookmark_tag, score, first_rank FROM tags",
    "hit_details": (
        f"WITH {T_BASE}, {asked('details')}, {slots()}, hits AS (SELECT query_id, doc_id, round(score, 6) AS score FROM ({phrase_score('qt', 2.0)})), "
        f"{best()} SELECT t.query_id, t.rank, t.doc_id, t.score, d.turn::DOUBLE::VARCHAR AS start, "
        "CASE WHEN d.role = 'user' THEN (d.turn + 1)::DOUBLE::VARCHAR ELSE '?' END AS \"end\", d.text FROM top t JOIN turns d ON d.doc_id = t.doc_id"
    ),
    "merge_scores": f"WITH {TWO_SETS} SELECT query_id, bookmark_tag, score FROM ({BOTH})",
    "final_ranking": f"WITH {TWO_SETS} {ranked(BOTH)}",
    "significant_tags": (
        f"WITH {EXACT}, {combined()}, {best()}, {tagged()}, {counted()}, r AS ({ranked(merged(part('tags', 0)))}) "
        "SELECT r.query_id, r.bookmark_tag, r.score, r.place, c.total_hits FROM r JOIN totals c ON c.query_id = r.query_id WHERE c.total_hits > 100"
    ),
    "spell_dictionary": f"WITH {BASE}, {DICTIONARY} SELECT length(gram) AS n, gram, term FROM dgrams",
    "spell_known": (
        f"WITH {BASE}, {asked('spelling')}, {slots()}, words AS (SELECT DISTINCT term AS word FROM qt) "
        "SELECT word, length(word) >= 3 AND word IN (SELECT term FROM v) AS known FROM words"
    ),
    "spell_suggest": (
        f"WITH {BASE}, {asked('spelling')}, {slots()}, {DICTIONARY}, words AS (SELECT DISTINCT term AS word FROM qt), {suggestions()} "
        "SELECT word, suggestion, similarity, place FROM alikes"
    ),
    "spell_options": f"WITH RECURSIVE {SPELL} SELECT query_id, slot, string_agg(choice, ' ' ORDER BY spot) AS choices FROM choices GROUP BY query_id, slot",
    "spell_phrases": f"WITH RECURSIVE {SPELL} SELECT query_id, place, suggestion FROM phrases",
    "spell_compounds": f"WITH RECURSIVE {SPELL} SELECT query_id, form::BIGINT AS form, place, suggestion FROM compounds",
    "spell_final": f"WITH RECURSIVE {SPELL} SELECT query_id, place, suggestion FROM spelled",
    "fallback_search": (
        f"WITH RECURSIVE {BASE}, {asked('spelling')}, {exact_flow('q', 'e_')}, {fallback('q', 'e_totals')} "
        f"SELECT query_id, bookmark_tag, score FROM ({merged('SELECT * FROM ftags')})"
    ),
    "exact_search": _exact_search(0),
    "exact_search_slop2": _exact_search(2),
    "phonetic_search": _phonetic_search(0),
    "phonetic_search_slop2": _phonetic_search(2),
    "full_search": _full_search(0),
    "full_search_slop2": _full_search(2),
}

"""The same results as set-based SQL: one row per token, windows and joins, for comparison only.

The engine works on arrays and class strings inside a document row; this text derives everything
from an unnested token table instead, so an error in one is not repeated in the other."""

from __future__ import annotations

import unicodedata

from lexmill.functions import lexicons as L
from lexmill.functions import text
from lexmill.queries import fixtures


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(values) -> str:
    return ", ".join(q(v) for v in values)


def case(branches, otherwise="NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {otherwise} END"


BLANK = text.BLANK
DOCS = ("docs AS MATERIALIZED (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES "
        + ", ".join(f"(CAST({i} AS BIGINT), {q(t)})" for i, t in fixtures.ROWS) + ") f(doc_id, text))")


def html_text(column: str, drop_tags=()) -> str:
    """Text nodes by patterns of its own: comments, dropped elements, tags with quoted values, three entities (one of
    them also without its semicolon, as pages are cut off). An element that is not dropped keeps its content raw."""
    for tag in drop_tags:
        column = f"regexp_replace({column}, {q(f'(?is)<{tag}(?:[ /][^>]*)?>.*?</{tag}>')}, chr(1), 'g')"
    for tag in {"script"} - set(drop_tags):  # tags in the one string of a script are text
        column = f"replace(replace({column}, '=\"</', '=\"' || chr(2) || '/'), '>\";', chr(3) || '\";')"
    column = f"regexp_replace({column}, '(?s)<!--.*?-->', chr(1), 'g')"
    column = f"""regexp_replace({column}, '<[A-Za-z/!](?:[^>"]|"[^"]*")*>', chr(1), 'g')"""
    column = f"replace(replace({column}, chr(2), '<'), chr(3), '>')"
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        column = f"replace({column}, {q(name)}, {q(char)})"
    column = f"regexp_replace({column}, '&amp;?', '&', 'g')"
    return f"regexp_replace(regexp_replace({column}, '^\\x01+|\\x01+$', '', 'g'), '\\x01+', ' ', 'g')"


def nfkd(column: str) -> str:
    """Character by character, from the decompositions of Latin letters, marks and signs."""
    known = {chr(c): unicodedata.normalize("NFKD", chr(c)) for c in (*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2200), *range(0xFB00, 0xFB07))}
    pairs = [(a, b) for a, b in known.items() if a != b]
    table = f"MAP {{{', '.join(f'chr({ord(a)}): {q(b)}' for a, b in pairs)}}}"
    return f"array_to_string(list_transform(string_split({column}, ''), lambda c: coalesce({table}[c], c)), '')"


def tokens(docs: str = DOCS, keys: str = "doc_id", one_sentence: bool = False) -> list[str]:
    """CTEs up to `tok(keys, k, sent_idx, t, n, token, low, piece)`; `docs(keys, text)` comes first."""
    pattern = q(f"{BLANK}*{text.token_pattern(possessive=False)}")
    ending = "(?:" + text.CLITIC + ")$"
    return [
        docs,
        f"""cut AS (SELECT {keys}, unnest(ps) AS piece, unnest(range(len(ps))) AS i FROM (SELECT {keys},
            regexp_extract_all(replace(replace(text, chr(30), ' '), chr(31), ' '), {pattern}) AS ps FROM docs))""",
        f"""parts AS (SELECT {keys}, i, CASE WHEN regexp_matches(piece, {q('(?i)[' + chr(92) + 'p{L}' + chr(92) + 'p{M}]' + ending)})
            THEN [regexp_replace(piece, {q('(?i)' + ending)}, ''), regexp_extract(piece, {q('(?i)' + ending)})]
            ELSE [piece] END AS ps FROM cut)""",
        f"""pieces AS (SELECT {keys}, i, unnest(range(len(ps))) AS j, unnest(ps) AS piece FROM parts)""",
        f"""bare AS (SELECT *, regexp_replace(piece, '^{BLANK}+', '') AS token,
            row_number() OVER (PARTITION BY {keys} ORDER BY i, j) - 1 AS k FROM pieces)""",
        f"""flags AS (SELECT *, token IN ('.', '!', '?') AS term,
            piece = token AND regexp_matches(token, {q('^' + text.CLOSER + '$')}) AS closer FROM bare)""",
        f"""chain AS (SELECT *, last_value(CASE WHEN NOT closer THEN term END IGNORE NULLS) OVER w AS in_chain,
            lead(term) OVER w AS term1, lead(closer) OVER w AS closer1 FROM flags
            WINDOW w AS (PARTITION BY {keys} ORDER BY k))""",
        f"""ends AS (SELECT *, {'false' if one_sentence else '''coalesce(in_chain AND NOT (closer1 OR (term AND term1)), false)'''}
            AS is_end FROM chain)""",
        f"""sent AS (SELECT *, coalesce(sum(CAST(is_end AS INT)) OVER (PARTITION BY {keys} ORDER BY k
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS sent_idx FROM ends)""",
        f"""tok AS MATERIALIZED (SELECT {keys}, k, sent_idx, token, lower(token) AS low, piece,
            row_number() OVER (PARTITION BY {keys}, sent_idx ORDER BY k) - 1 AS t,
            count(*) OVER (PARTITION BY {keys}, sent_idx) AS n FROM sent)""",
    ]


def tags(keys: str = "doc_id") -> list[str]:
    """`pos(tok.*, pos)`."""
    first = case([
        *[(f"low IN ({words(ws)})", q(tag)) for tag, ws in L.CLOSED_CLASS.items()],
        *[(f"low IN ({words(ps)})", q(tag)) for tag, ps in L.PUNCTUATION.items()],
        (f"NOT regexp_matches(token, {q(L.LETTER_OR_DIGIT)})", "'SYM'"),
        (f"regexp_matches(token, {q(L.DIGIT_FIRST)})", "'CD'"),
        (f"t > 0 AND regexp_matches(token, {q(L.CAPITAL_FIRST)})", "'NNP'"),
        *[(f"ends_with(low, {q(end)}) AND length(low) >= {n}", q(tag)) for end, n, tag in L.SUFFIXES],
        ("ends_with(low, 's') AND NOT ends_with(low, 'ss') AND length(low) > 3", "'NNS'"),
    ], "'NN'")
    return [
        f"first AS (SELECT *, {first} AS g FROM tok)",
        f"""around AS (SELECT *, lag(g) OVER w AS g0, lead(g) OVER w AS g1 FROM first
            WINDOW w AS (PARTITION BY {keys}, sent_idx ORDER BY t))""",
        f"""pos AS MATERIALIZED (SELECT {keys}, k, sent_idx, t, n, token, low, CASE
            WHEN g = 'NN' AND g0 IN ('TO', 'MD') THEN 'VB'
            WHEN g IN ('VBD', 'VBG') AND g0 IN ('DT', 'PRP$') THEN CASE WHEN g1 LIKE 'NN%' THEN 'JJ' ELSE 'NN' END
            ELSE g END AS pos FROM around)""",
    ]


def lemmas() -> list[str]:
    """`lem(pos.*, lemma)`."""
    irregular = case([(f"low IN ({words(forms)})", q(lemma)) for lemma, forms in L.IRREGULAR_LEMMAS.items()], "NULL")

    def stem(cut):
        s = f"left(low, length(low) - {cut})"
        return f"CASE WHEN regexp_matches({s}, '(bb|dd|gg|mm|nn|pp|rr|tt)$') THEN left({s}, length({s}) - 1) ELSE {s} END"
    regular = case([
        ("pos LIKE 'NNP%'", "token"),
        ("pos IN ('NNS', 'VBZ') AND low LIKE '%ies' AND length(low) > 4", "left(low, length(low) - 3) || 'y'"),
        ("pos IN ('NNS', 'VBZ') AND regexp_matches(low, '(s|x|z|ch|sh)es$')", "left(low, length(low) - 2)"),
        ("pos IN ('NNS', 'VBZ') AND low LIKE '%s'", "left(low, length(low) - 1)"),
        ("pos = 'VBD' AND low LIKE '%ed'", stem(2)),
        ("pos = 'VBG' AND low LIKE '%ing'", stem(3)),
    ], "low")
    return [f"lem AS MATERIALIZED (SELECT *, coalesce({irregular}, {regular}) AS lemma FROM pos)"]


def tagger_counts() -> str:
    """Moves from the tag before, words, and the endings of rare words."""
    shape = case([(f"regexp_matches(w, {q(L.DIGIT_FIRST)})", "'d'"), (f"NOT regexp_matches(w, {q(L.LETTER_OR_DIGIT)})", "'p'"),
                  (f"regexp_matches(w, {q(L.CAPITAL_FIRST)})", "'C'")], "'l'")
    return select(POS + [
        "labels AS (SELECT doc_id, sent_idx, t, n, CASE WHEN t = 0 THEN low ELSE token END AS w, pos FROM pos)",
        "words AS MATERIALIZED (SELECT w, pos, count(*) AS n FROM labels GROUP BY ALL)",
        f"rare AS (SELECT w, {shape} AS kind, lower(w) AS low FROM words GROUP BY w HAVING sum(n) <= 10)",
        "endings AS (SELECT w, kind || right(low, k) AS ending FROM (SELECT *, unnest(range(0, least(4, length(low)) + 1)) AS k FROM rare))",
    ], """SELECT 'word' AS kind, w AS context, pos AS tag, n FROM words
        UNION ALL SELECT 'end', ending, pos, CAST(sum(n) AS BIGINT) FROM endings JOIN words USING (w) GROUP BY ALL
        UNION ALL SELECT 'move', CASE WHEN t = 0 THEN '' ELSE before END, pos, count(*) FROM (SELECT t, pos,
            lag(pos) OVER (PARTITION BY doc_id, sent_idx ORDER BY t) AS before FROM labels) GROUP BY ALL
        UNION ALL SELECT 'move', pos, '', count(*) FROM labels WHERE t = n - 1 GROUP BY ALL""")


def lemma_counts() -> str:
    """The longest common beginning by comparing all of them."""
    return select(LEM + [
        "forms AS (SELECT low AS w, pos, lower(lemma) AS l, count(*) AS n FROM lem GROUP BY ALL)",
        """edits AS (SELECT w, pos, n, (length(w) - same) || ':' || substr(l, same + 1) AS edit FROM (SELECT *, list_max(list_filter(
            range(0, least(length(w), length(l)) + 1), lambda k: left(w, k) = left(l, k))) AS same FROM forms))""",
        """places AS (SELECT pos || ' ' || right(w, k) AS context, edit, n FROM (SELECT *, unnest(range(0, least(5, length(w)) + 1)) AS k FROM edits)
            UNION ALL SELECT pos || '=' || w, edit, n FROM edits)""",
    ], "SELECT 'edit' AS kind, context, edit AS tag, CAST(sum(n) AS BIGINT) AS n FROM places GROUP BY ALL")


def phrases(name: str, rules, source: str) -> list[str]:
    """`{name}(doc_id, sent_idx, b, e, type)`: leftmost-longest phrases of `source`, by a recursive walk.
    `rules` is a list, or a query for `(phrase, len, rule, type)` and the longest length."""
    if isinstance(rules, tuple):
        rows, longest = rules
    else:
        rows = "VALUES " + ", ".join(f"({q(p)}, {len(p.split())}, {i}, {q(kind)})" for i, (p, kind) in enumerate(rules))
        longest = max(len(p.split()) for p, _ in rules)
    grams = ", ".join(
        "token" + "".join(f" || ' ' || lead(token, {d}) OVER w" for d in range(1, n)) + f" AS g{n}" for n in range(1, longest + 1))
    return [
        f"{name}_r(phrase, len, rule, type) AS ({rows})",
        f"{name}_g AS (SELECT doc_id, sent_idx, t, {grams} FROM {source} WINDOW w AS (PARTITION BY doc_id, sent_idx ORDER BY t))",
        f"{name}_h AS ({' UNION ALL '.join(f'SELECT doc_id, sent_idx, t AS b, t + len AS e, len, rule, type FROM {name}_g JOIN {name}_r ON len = {n} AND phrase = g{n}' for n in range(1, longest + 1))})",
        f"{name}_c AS MATERIALIZED (SELECT * FROM {name}_h QUALIFY row_number() OVER (PARTITION BY doc_id, sent_idx, b ORDER BY len DESC, rule) = 1)",
        f"""{name} AS (SELECT doc_id, sent_idx, b, e, type FROM {name}_c
            QUALIFY row_number() OVER (PARTITION BY doc_id, sent_idx ORDER BY b) = 1
            UNION ALL
            SELECT c.doc_id, c.sent_idx, c.b, c.e, c.type FROM {name} w JOIN {name}_c c
            ON c.doc_id = w.doc_id AND c.sent_idx = w.sent_idx AND c.b >= w.e
            QUALIFY row_number() OVER (PARTITION BY c.doc_id, c.sent_idx ORDER BY c.b) = 1)""",
    ]


OPENINGS = ("""SELECT DISTINCT p, 2, 0, 'OPENING' FROM (SELECT regexp_extract(text, '^(\\p{L}+ \\p{L}+)(?:[ .,]|$)', 1) AS p FROM docs)
            WHERE p <> ''""", 2)


def entities(source: str = "pos", rules=None, gazetteer=L.GAZETTEER) -> list[str]:
    """`ner({source}.*, ner)`."""
    shape = case([
        ("s.pos = 'CD' AND token LIKE '$%'", "'MONEY'"),
        ("s.pos = 'CD' AND token LIKE '%\\%' ESCAPE '\\'", "'PERCENT'"),
        ("s.pos = 'CD'", "'NUMBER'"),
        ("s.pos = 'NNP'", "'MISC'"),
        ("token LIKE 'http://%' OR token LIKE 'https://%'", "'URL'"),
        ("contains(token, '@') AND length(token) > 1", "'EMAIL'"),
    ], "'O'")
    on = "{0}.doc_id = s.doc_id AND {0}.sent_idx = s.sent_idx AND s.t >= {0}.b AND s.t < {0}.e"
    join = f"LEFT JOIN gaz g ON {on.format('g')}" + (f" LEFT JOIN dict d ON {on.format('d')}" if rules else "")
    return [
        *phrases("gaz", gazetteer, source),
        *(phrases("dict", rules, source) if rules else []),
        f"ner AS MATERIALIZED (SELECT s.*, coalesce({'d.type, ' if rules else ''}g.type, {shape}) AS ner FROM {source} s {join})",
    ]


def chunked(source: str = "pos") -> list[str]:
    """`cls({source}.*, c, kind, chunk_idx)` and `chunk(doc_id, sent_idx, chunk_idx, kind, b, e, text, head, c0)`."""
    c = case([
        ("pos LIKE 'NN%'", "'N'"), ("pos IN ('DT', 'PRP$')", "'d'"), ("pos = 'PRP'", "'q'"),
        ("pos LIKE 'JJ%' OR pos = 'CD'", "'j'"), ("pos LIKE 'VB%'", "'V'"), ("pos = 'MD'", "'m'"), ("pos = 'RB'", "'r'"),
        ("pos = 'IN'", "'i'"), ("pos = 'TO'", "'t'"), ("pos = 'CC'", "'c'")], "'.'")
    kind = case([("c IN ('N', 'd', 'q', 'j')", "'NP'"), ("c IN ('V', 'm', 'r')", "'VP'"),
                 ("c IN ('i', 't')", "'PP'")], "'O'")
    w = "OVER (PARTITION BY doc_id, sent_idx ORDER BY t)"
    return [
        f"coded AS (SELECT *, {c} AS c FROM {source})",
        f"kinds AS (SELECT *, {kind} AS kind FROM coded)",
        f"""starts AS (SELECT *, CASE WHEN kind IS DISTINCT FROM lag(kind) {w}
            OR (kind = 'NP' AND (c IN ('d', 'q') OR lag(c) {w} = 'q')) THEN 1 ELSE 0 END AS new FROM kinds)""",
        f"cls AS MATERIALIZED (SELECT *, sum(new) {w} - 1 AS chunk_idx FROM starts)",
        """chunk AS MATERIALIZED (SELECT doc_id, sent_idx, chunk_idx, any_value(kind) AS kind, min(t) AS b, max(t) + 1 AS e,
            string_agg(token, ' ' ORDER BY t) AS text,
            coalesce(max(CASE WHEN c = 'N' THEN t END), max(t)) AS head,
            arg_min(c, t) AS c0 FROM cls GROUP BY ALL)""",
    ]


def polarity(source: str = "pos") -> list[str]:
    """`pol({source}.*, polarity)`."""
    w = "OVER (PARTITION BY doc_id, sent_idx ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return [
        f"""marks AS (SELECT *, low IN ({words(L.DOWNWARD)}) AS x, low IN ({words(L.FLAT_QUANTIFIERS)}) AS m,
            pos LIKE 'VB%' AND low NOT IN ({words(L.DOWNWARD)}) AND low NOT IN ({words(L.FLAT_QUANTIFIERS)}) AS v FROM {source})""",
        f"""seen AS (SELECT *, coalesce(sum(CAST(x AS INT)) {w}, 0) AS ops, max(CASE WHEN m THEN t END) {w} AS last_m,
            greatest(coalesce(max(CASE WHEN v THEN t END) {w}, -1), CASE WHEN v THEN t ELSE -1 END) AS last_v FROM marks)""",
        f"""pol AS MATERIALIZED (SELECT * EXCLUDE (x, m, v, ops, last_m, last_v), CASE
            WHEN last_m > last_v THEN 'flat' WHEN ops % 2 = 1 THEN 'down' ELSE 'up' END AS polarity FROM seen)""",
    ]


def sentiment() -> list[str]:
    value = f"CASE WHEN low IN ({words(L.POSITIVE)}) THEN 1 WHEN low IN ({words(L.NEGATIVE)}) THEN -1 ELSE 0 END"
    return [f"""sentiments AS (SELECT doc_id, sent_idx, CAST(greatest(-2, least(2,
        sum({value} * CASE WHEN polarity = 'down' THEN -1 ELSE 1 END))) + 2 AS BIGINT) AS sentiment FROM pol GROUP BY ALL)"""]


SENTENCES = f"""sentences AS (SELECT doc_id, sent_idx, regexp_replace(string_agg(piece, '' ORDER BY k), '^{BLANK}+', '') AS text,
    count(*) AS n_tokens, min(k) AS k0, max(k) AS k1 FROM tok GROUP BY doc_id, sent_idx)"""
OFFSETS = """offs AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) AS end_off FROM tok)"""


def dependency() -> list[str]:
    after = "OVER (PARTITION BY doc_id, sent_idx ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    before = "OVER (PARTITION BY doc_id, sent_idx ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    every = "OVER (PARTITION BY doc_id, sent_idx)"
    punct = words([*L.PUNCTUATION, "SYM"])
    rules = [
        ("t = root", "-1", "'root'"),
        ("c IN ('d', 'j') AND noun IS NOT NULL", "noun",
         "CASE WHEN pos = 'PRP$' THEN 'nmod:poss' WHEN pos = 'CD' THEN 'nummod' WHEN c = 'd' THEN 'det' ELSE 'amod' END"),
        ("c = 't' AND c1 = 'V'", "t + 1", "'mark'"),
        ("c IN ('i', 't') AND noun IS NOT NULL", "noun", "'case'"),
        ("c = 'N' AND c1 = 'N'", "t + 1", "'compound'"),
        ("c IN ('N', 'q') AND verb0 IS NOT NULL", "verb0", "CASE WHEN prep > coalesce(other, -1) THEN 'obl' ELSE 'obj' END"),
        ("c IN ('N', 'q') AND verb IS NOT NULL", "verb", "'nsubj'"),
        ("c = 'r' AND coalesce(verb, verb0) IS NOT NULL", "coalesce(verb, verb0)", "'advmod'"),
        ("c = 'm' AND verb IS NOT NULL", "verb", "'aux'"),
        ("c = 'c'", "root", "'cc'"),
        (f"pos IN ({punct})", "root", "'punct'"),
    ]
    return [
        f"""near AS (SELECT *, lead(c) OVER (PARTITION BY doc_id, sent_idx ORDER BY t) AS c1,
            min(CASE WHEN c = 'N' THEN t END) {after} AS noun, min(CASE WHEN c = 'V' THEN t END) {after} AS verb,
            max(CASE WHEN c = 'V' THEN t END) {before} AS verb0, max(CASE WHEN c IN ('i', 't') THEN t END) {before} AS prep,
            max(CASE WHEN c NOT IN ('i', 't', 'd', 'j', 'N') THEN t END) {before} AS other,
            coalesce(min(CASE WHEN c = 'V' THEN t END) {every}, min(CASE WHEN c = 'N' THEN t END) {every}, 0) AS root
            FROM cls)""",
        f"""edges AS (SELECT doc_id, sent_idx, t AS dep_tok, CAST({case([(c, g) for c, g, _ in rules], 'root')} AS BIGINT) AS gov_tok,
            {case([(c, r) for c, _, r in rules], "'dep'")} AS rel FROM near)""",
    ]


def mention_rows(mode: str, outside: str = "true") -> list[str]:
    """`mention(doc_id, sent_idx, b, e, text, pronoun, ckey, place)`, ckey being the first place of the chain: every mention is
    joined to the earlier ones of its document, and chains are walked from their first mentions."""
    kind_of = case([(f"low IN ({words(ws)})", q(kind)) for kind, ws in L.PRONOUN_KINDS.items()])
    gender = case([(f"split_part(name, ' ', 1) IN ({words(ns)})", q(kind)) for kind, ns in L.GIVEN_NAMES.items()])
    before = "|".join(L.CLOSED_CLASS["DT"] + L.CLOSED_CLASS["PRP$"])
    sieves = [
        "o.name = m.name",
        "(m.single AND m.letters = o.initials AND NOT o.single) OR (o.single AND o.letters = m.initials AND NOT m.single)",
        "NOT m.single AND NOT o.single AND o.first = m.first AND o.last = m.last",
        "m.single AND NOT o.single AND o.last = m.last",
        "m.single AND NOT o.single AND o.first = m.first AND o.type = 'PERSON'",
    ] if mode == "coref" else ["o.head_lemma = m.head_lemma"]
    agrees = case([
        ("m.kind IN ('male', 'female')", "coalesce(o.type, '') NOT IN ('LOCATION', 'ORGANIZATION') AND NOT o.plural AND coalesce(o.gender, m.kind) = m.kind"),
        ("m.kind = 'plural'", "o.plural OR coalesce(o.type, '') = 'ORGANIZATION'"),
        ("m.kind = 'thing'", "coalesce(o.type, '') <> 'PERSON'")], "false")
    nearest = ", ".join(f"max(CASE WHEN {s} THEN o.place END) AS s{i}" for i, s in enumerate(sieves))
    return [
        f"""names AS (SELECT k.doc_id, k.sent_idx, k.b, k.e, k.text, lower(h.lemma) AS head_lemma, false AS pronoun, h.ner AS type,
            h.pos IN ('NNS', 'NNPS') AS plural, CAST(NULL AS VARCHAR) AS kind FROM chunk k JOIN cls h ON h.doc_id = k.doc_id AND h.sent_idx = k.sent_idx AND h.t = k.head
            WHERE k.kind = 'NP' AND k.c0 <> 'q' AND (h.pos LIKE 'NNP%' OR h.ner IN ({words(L.ENTITY_TYPES)})))""",
        f"""every AS (SELECT * FROM names UNION ALL SELECT doc_id, sent_idx, t, t + 1, token, low, true, 'O', false, {kind_of} FROM cls
            WHERE low IN ({words(L.PRONOUNS)}) AND pos IN ('PRP', 'PRP$'))""",
        f"found AS (SELECT * FROM every y WHERE {outside})",
        f"""named AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sent_idx, b, e) AS place,
            coalesce(nullif(regexp_replace(text || ' ', {q('^(?i:(?:' + before + ') )+')}, ''), ''), text || ' ') AS padded FROM found)""",
        """parted AS (SELECT *, rtrim(padded, ' ') AS name, string_split(rtrim(padded, ' '), ' ') AS ws FROM named)""",
        rf"""sieved AS MATERIALIZED (SELECT *, len(ws) = 1 AS single, ws[1] AS first, ws[-1] AS last, {gender} AS gender,
            CASE WHEN regexp_matches(replace(name, '.', ''), '^\p{{Lu}}{{2,}}$') THEN replace(name, '.', '') END AS letters,
            CASE WHEN len(list_filter(ws, lambda w: regexp_matches(w, '^\p{{Lu}}'))) > 1
                THEN array_to_string(list_transform(list_filter(ws, lambda w: regexp_matches(w, '^\p{{Lu}}')), lambda w: left(w, 1)), '') END AS initials
            FROM parted)""",
        f"""earlier AS (SELECT m.doc_id, m.place, {nearest} FROM sieved m JOIN sieved o
            ON o.doc_id = m.doc_id AND o.place < m.place AND NOT m.pronoun AND NOT o.pronoun GROUP BY ALL)""",
        f"""meant AS MATERIALIZED (SELECT m.doc_id, m.place, coalesce({', '.join(f's{i}' for i in range(len(sieves)))}) AS up
            FROM sieved m LEFT JOIN earlier e ON e.doc_id = m.doc_id AND e.place = m.place WHERE NOT m.pronoun)""",
        """rooted AS (SELECT doc_id, place, place AS ckey FROM meant WHERE up IS NULL
            UNION ALL SELECT n.doc_id, n.place, r.ckey FROM rooted r JOIN meant n ON n.doc_id = r.doc_id AND n.up = r.place)""",
        f"""told AS MATERIALIZED (SELECT s.doc_id, s.place, r.ckey, s.plural,
            first_value(CASE WHEN s.type IN ({words(L.ENTITY_TYPES)}) THEN s.type END IGNORE NULLS) OVER w AS type,
            first_value(s.gender IGNORE NULLS) OVER w AS gender FROM sieved s JOIN rooted r ON r.doc_id = s.doc_id AND r.place = s.place
            WINDOW w AS (PARTITION BY s.doc_id, r.ckey ORDER BY s.place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        f"""meaning AS (SELECT m.doc_id, m.place, arg_max(o.ckey, o.place) AS ckey FROM sieved m JOIN told o
            ON o.doc_id = m.doc_id AND o.place < m.place AND m.pronoun AND ({agrees}) GROUP BY m.doc_id, m.place)""",
        """mention AS MATERIALIZED (SELECT s.doc_id, sent_idx, b, e, text, pronoun, s.place, coalesce(t.ckey, p.ckey, s.place) AS ckey
            FROM sieved s LEFT JOIN told t ON t.doc_id = s.doc_id AND t.place = s.place
            LEFT JOIN meaning p ON p.doc_id = s.doc_id AND p.place = s.place)""",
        """chains AS MATERIALIZED (SELECT doc_id, ckey, min(place) AS chain_id, count(*) AS n,
            arg_min(place, (pronoun, -length(text), place)) AS rep_place,
            arg_min(text, (pronoun, -length(text), place)) AS rep FROM mention GROUP BY ALL)""",
    ]


def chain_text(mode: str) -> list[str]:
    return [
        """others AS (SELECT c.doc_id, c.ckey, string_agg(m.text, '|' ORDER BY m.place) AS texts FROM chains c
            JOIN mention m ON m.doc_id = c.doc_id AND m.ckey = c.ckey AND m.text <> c.rep GROUP BY ALL)""",
        f"""chain_results AS (SELECT c.doc_id, string_agg('(' || rep || coalesce(':' || texts, '') || ')' || chr(10), '' ORDER BY chain_id)
            AS result FROM chains c LEFT JOIN others o ON o.doc_id = c.doc_id AND o.ckey = c.ckey
            WHERE n >= {2 if mode == 'coref' else 1} GROUP BY c.doc_id)""",
    ]


def select(ctes: list[str], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + final


TOK = tokens()
POS = TOK + tags()
LEM = POS + lemmas()


def _triple_ctes(source: str = "cls") -> list[str]:
    gloss = f"SELECT doc_id, sent_idx, chunk_idx, string_agg(lemma, ' ' ORDER BY t) AS gloss FROM {source} GROUP BY ALL"
    w = "OVER (PARTITION BY doc_id, sent_idx ORDER BY chunk_idx)"
    ahead = ", ".join(f"lead(k.kind, {d}) {w} AS k{d}, lead(g.gloss, {d}) {w} AS g{d}" for d in (1, 2, 3))
    return [
        f"gl AS ({gloss})",
        f"""row4 AS (SELECT k.doc_id, k.sent_idx, k.chunk_idx, k.kind AS k0, g.gloss AS g0, {ahead.replace('OVER (PARTITION BY doc_id, sent_idx ORDER BY chunk_idx)', 'OVER w')}
            FROM chunk k JOIN gl g ON g.doc_id = k.doc_id AND g.sent_idx = k.sent_idx AND g.chunk_idx = k.chunk_idx
            WINDOW w AS (PARTITION BY k.doc_id, k.sent_idx ORDER BY k.chunk_idx))""",
        f"""hits AS (SELECT *, k2 = 'NP' AS direct FROM row4 WHERE k0 = 'NP' AND k1 = 'VP' AND (k2 = 'NP' OR (k2 = 'PP' AND k3 = 'NP')))""",
    ]


def _triples() -> str:
    return select(LEM + chunked("lem") + _triple_ctes(), f"""SELECT doc_id, sent_idx, row_number() OVER (PARTITION BY doc_id, sent_idx ORDER BY chunk_idx) - 1 AS triple_idx,
        CASE WHEN direct THEN {L.CONFIDENCE_DIRECT}::DOUBLE ELSE {L.CONFIDENCE_PREPOSITION}::DOUBLE END AS confidence, g0 AS subject,
        CASE WHEN direct THEN g1 ELSE g1 || ' ' || g2 END AS relation, CASE WHEN direct THEN g2 ELSE g3 END AS object FROM hits""")


def _relations(gazetteer=L.GAZETTEER, patterns=L.RELATION_PATTERNS) -> str:
    """Entities and a pattern's words as rows; a pair holds if the words between count as they must."""
    lemmas, types = words(sorted({p[1] for p in patterns})), words(sorted({t for p in patterns for t in (p[0], p[2])}))
    return select(LEM + entities("lem", gazetteer=gazetteer) + [
        f"pattern(first, lemma, second, type) AS (VALUES {', '.join('(' + words(p) + ')' for p in patterns)})",
        f"""runs AS (SELECT *, t - row_number() OVER (PARTITION BY doc_id, sent_idx, ner ORDER BY t) AS grp FROM ner
            WHERE ner IN ({types}))""",
        """ent AS MATERIALIZED (SELECT doc_id, sent_idx, ner, min(t) AS b, max(t) + 1 AS e, string_agg(token, ' ' ORDER BY t) AS text
            FROM runs GROUP BY doc_id, sent_idx, ner, grp)""",
        f"word AS MATERIALIZED (SELECT doc_id, sent_idx, t, lemma, pos IN ('IN', 'TO') AS small FROM ner WHERE lemma IN ({lemmas}) AND ner NOT IN ({types}))",
        """pair AS MATERIALIZED (SELECT a.doc_id, a.sent_idx, a.b, a.e, a.ner AS type1, a.text AS entity1, z.b AS zb, z.ner AS type2, z.text AS entity2,
            w.t, w.lemma, w.small FROM ent a JOIN ent z ON a.doc_id = z.doc_id AND a.sent_idx = z.sent_idx AND a.e <= z.b
            JOIN word w ON a.doc_id = w.doc_id AND a.sent_idx = w.sent_idx AND w.t >= a.e AND w.t < z.b)""",
        """clear AS (SELECT DISTINCT * FROM pair p WHERE NOT EXISTS (SELECT 1 FROM word o WHERE o.doc_id = p.doc_id AND o.sent_idx = p.sent_idx
            AND o.t >= p.e AND o.t < p.zb AND o.t <> p.t AND (p.small OR NOT o.small)))""",
        """typed AS (SELECT DISTINCT doc_id, sent_idx, b, zb, entity1, type, entity2 FROM clear c JOIN pattern k
            ON c.type1 = k.first AND c.lemma = k.lemma AND c.type2 = k.second)""",
    ], """SELECT doc_id, sent_idx, row_number() OVER (PARTITION BY doc_id, sent_idx ORDER BY b, zb, type) - 1 AS relation_idx,
        entity1, type, entity2 FROM typed""")


def _quotes() -> str:
    """With patterns of its own: a quotation with what follows it up to the next one, and speakers by word lists."""
    spans = q('("[^"]*"|“[^“”]*”)([^"“]*)')
    verbs = "(?:" + "|".join(L.SPEECH_VERBS) + ")"
    name = "((?:\\p{Lu}\\p{L}+ )*\\p{Lu}\\p{L}+)"
    found = " ,".join(f"CASE WHEN regexp_extract({c}, {q(p)}, 1) NOT IN ('', 'He', 'She', 'They') THEN regexp_extract({c}, {q(p)}, 1) END" for c, p in (
        ("a", f"^\\s*{verbs} {name}"), ("a", f"^\\s*{name} {verbs}(?:[^\\p{{L}}]|$)"),
        ("b", f"(?s)(?:^|[^\\p{{L}}]){name} {verbs}[,:]?\\s*$"), ("b", f"(?:^|[^\\p{{L}}]){verbs} {name}[,:]\\s*$")))
    pronoun = "([Hh]e|[Ss]he|[Tt]hey)"
    places = ", ".join(f"CASE WHEN regexp_matches({c}, {q(p)}) THEN {base} + length(regexp_extract({c}, {q(p)}, 1)) + length(regexp_extract({c}, {q(p)}, 2)) END"
                       for c, base, p in (("a", "upto", f"^(\\s*{verbs} ){pronoun}(?:[^\\p{{L}}]|$)"), ("a", "upto", f"^(\\s*){pronoun} {verbs}(?:[^\\p{{L}}]|$)"),
                                          ("b", "since", f"(?s)^((?:.*[^\\p{{L}}])?){pronoun} {verbs}[,:]?\\s*$")))
    spans_of = [
        OFFSETS,
        f"""qs AS (SELECT doc_id, string_split(regexp_replace(text, {spans}, chr(2) || '\\1' || chr(3) || '\\2' || chr(4), 'g'), chr(2)) AS pieces FROM docs)""",
        """rows AS (SELECT doc_id, i - 1 AS quote_idx, split_part(pieces[i + 1], chr(3), 1) AS text, split_part(split_part(pieces[i + 1], chr(3), 2), chr(4), 1) AS a,
            regexp_extract(pieces[1], '^([^"“]*)', 1) AS lead, CAST(length(pieces[1]) + coalesce(list_sum(list_transform(pieces[2:i], lambda p: length(p) - 2)), 0) AS BIGINT) AS begin
            FROM (SELECT doc_id, pieces, unnest(range(1, len(pieces))) AS i FROM qs))""",
        """near AS (SELECT *, begin + length(text) AS upto, coalesce(lag(a) OVER w, lead) AS b, coalesce(lag(begin + length(text)) OVER w, 0) AS since
            FROM rows WINDOW w AS (PARTITION BY doc_id ORDER BY quote_idx))""",
        """inside AS MATERIALIZED (SELECT o.doc_id, o.sent_idx, o.t FROM near n JOIN offs o ON o.doc_id = n.doc_id AND o.end_off > n.begin AND o.end_off <= n.upto)""",
    ]
    outside = "NOT EXISTS (SELECT 1 FROM inside i WHERE i.doc_id = y.doc_id AND i.sent_idx = y.sent_idx AND i.t = y.b)"
    return select(LEM + entities("lem") + chunked("ner") + spans_of + mention_rows("coref", outside) + [
        f"""quoted AS (SELECT doc_id, quote_idx, text, coalesce({found}, '') AS speaker, regexp_matches(b, '\n\\s*$') AS opens, coalesce({places}) AS place FROM near)""",
        """standing AS (SELECT o.doc_id, o.end_off, c.rep FROM mention m JOIN offs o ON o.doc_id = m.doc_id AND o.sent_idx = m.sent_idx AND o.t = m.b AND m.pronoun
            JOIN chains c ON c.doc_id = m.doc_id AND c.ckey = m.ckey
            JOIN mention r ON r.doc_id = c.doc_id AND r.place = c.rep_place AND NOT r.pronoun)""",
        """heard AS MATERIALIZED (SELECT n.doc_id, quote_idx, text, opens, speaker = '' AND n.place IS NOT NULL AS by_pronoun,
            CASE WHEN speaker = '' AND n.place IS NOT NULL THEN coalesce(s.rep, '') ELSE speaker END AS speaker
            FROM quoted n LEFT JOIN standing s ON s.doc_id = n.doc_id AND s.end_off = n.place)""",
        """turns AS (SELECT doc_id, quote_idx, text, speaker, '' AS other FROM heard WHERE quote_idx = 0
            UNION ALL SELECT h.doc_id, h.quote_idx, h.text, CASE WHEN h.speaker = '' AND NOT h.by_pronoun AND h.opens AND t.speaker <> '' AND t.other <> ''
            AND t.speaker <> t.other THEN t.other ELSE h.speaker END, t.speaker FROM turns t JOIN heard h ON h.doc_id = t.doc_id AND h.quote_idx = t.quote_idx + 1)""",
    ], "SELECT doc_id, quote_idx, text, speaker FROM turns")


def _per_doc(column: str, table: str) -> str:
    return f"(SELECT doc_id, string_agg({column}, ' ' ORDER BY k) AS r FROM {table} GROUP BY doc_id)"


def _long() -> str:
    sent_text = f"""(SELECT doc_id, string_agg(text || chr(10), '' ORDER BY sent_idx) AS r FROM sentences GROUP BY doc_id)"""
    return select(LEM + entities("lem") + [SENTENCES], " UNION ALL ".join(
        [f"SELECT 'tokenize' AS functionality, doc_id, r AS result FROM {_per_doc('token', 'tok')}"]
        + [f"SELECT {q(name)}, d.doc_id, coalesce(r, '') FROM docs d LEFT JOIN {source} x ON x.doc_id = d.doc_id" for name, source in (
            ("ssplit", sent_text), ("pos", _per_doc("pos", "pos")), ("lemma", _per_doc("lemma", "lem")), ("ner", _per_doc("ner", "ner")))]))


def _syntax_long() -> str:
    parse = """(SELECT doc_id, string_agg(line || chr(10), '' ORDER BY sent_idx) AS r FROM (SELECT doc_id, sent_idx,
        '(S ' || string_agg(CASE WHEN kind = 'O' THEN text
        ELSE '(' || kind || ' ' || text || ')' END, ' ' ORDER BY chunk_idx) || ')' AS line FROM chunk GROUP BY ALL) GROUP BY doc_id)"""
    deps = """(SELECT doc_id, string_agg(line || chr(10), '' ORDER BY sent_idx) AS r FROM (SELECT s.doc_id, s.sent_idx, coalesce(string_agg(
        e.rel || '(' || CASE WHEN e.gov_tok < 0 THEN 'ROOT-0' ELSE g.token || '-' || (e.gov_tok + 1) END || ', ' || d.token || '-' || (e.dep_tok + 1)
        || ')', ' ' ORDER BY e.dep_tok), '') AS line FROM (SELECT DISTINCT doc_id, sent_idx FROM tok) s
        LEFT JOIN edges e ON e.doc_id = s.doc_id AND e.sent_idx = s.sent_idx
        LEFT JOIN tok g ON g.doc_id = e.doc_id AND g.sent_idx = e.sent_idx AND g.t = e.gov_tok
        LEFT JOIN tok d ON d.doc_id = e.doc_id AND d.sent_idx = e.sent_idx AND d.t = e.dep_tok GROUP BY ALL) GROUP BY doc_id)"""
    pol = """(SELECT doc_id, string_agg(line || ' ' || chr(10), '' ORDER BY sent_idx) AS r FROM (SELECT doc_id, sent_idx,
        string_agg(polarity, ' ' ORDER BY t) AS line FROM pol GROUP BY ALL) GROUP BY doc_id)"""
    senti = "(SELECT doc_id, string_agg(sentiment || chr(10), '' ORDER BY sent_idx) AS r FROM sentiments GROUP BY doc_id)"
    return select(POS + chunked() + dependency() + polarity() + sentiment(), " UNION ALL ".join(
        f"SELECT {q(name)} AS functionality, d.doc_id, coalesce(r, '') AS result FROM docs d LEFT JOIN {source} x ON x.doc_id = d.doc_id"
        for name, source in (("parse", parse), ("depparse", deps), ("natlog", pol), ("sentiment", senti))))


def _line_as_sentence(lines: str) -> str:
    """The eight functions over a line as one sentence; the line's key stands in for the document's."""
    keyed = lines.replace("conv_id, turn, text", "conv_id || ':' || turn AS doc_id, conv_id, turn, text")
    ctes = (tokens(keyed, one_sentence=True) + tags() + lemmas() + entities("lem") + chunked("ner") + dependency() + polarity("cls"))
    lists = {"tokenize": ("token", "tok"), "pos": ("pos", "pos"), "lemma": ("lemma", "lem"), "ner": ("ner", "ner"), "natlog": ("polarity", "pol")}
    sources = [(name, f"SELECT doc_id, '[' || string_agg({col}, ', ' ORDER BY t) || ']' AS r FROM {table} GROUP BY doc_id", "[]")
               for name, (col, table) in lists.items()]
    triples = _triple_ctes("cls")
    sources.append(("openie", f"""SELECT doc_id, '[' || string_agg('(' || CASE WHEN direct THEN '{L.CONFIDENCE_DIRECT}' ELSE '{L.CONFIDENCE_PREPOSITION}' END
        || ',' || g0 || ',' || CASE WHEN direct THEN g1 ELSE g1 || ' ' || g2 END || ',' || CASE WHEN direct THEN g2 ELSE g3 END || ')', ', '
        ORDER BY chunk_idx) || ']' AS r FROM hits GROUP BY doc_id""", "[]"))
    sources.append(("parse", """SELECT doc_id, '(S ' || string_agg(CASE WHEN kind = 'O' THEN text ELSE '(' || kind || ' ' || text || ')' END, ' '
        ORDER BY chunk_idx) || ')' AS r FROM chunk GROUP BY doc_id""", ""))
    sources.append(("depparse", "SELECT doc_id, CAST(gov_tok AS VARCHAR) AS r FROM edges WHERE dep_tok = 0", ""))
    return select(ctes + triples, " UNION ALL ".join(
        f"SELECT {q(name)} AS functionality, d.conv_id, d.turn, coalesce(r, {q(none)}) AS result FROM docs d LEFT JOIN ({sql}) x ON x.doc_id = d.doc_id"
        for name, sql, none in sources))


ONE_LINE = "replace(replace(text, chr(10), ' '), chr(13), ' ')"
ARTICLE_TEXT = html_text("html")


def oracle_sql() -> dict[str, str]:
    pages = f"docs AS MATERIALIZED (SELECT page_id, {html_text('html', ('script', 'style'))} AS text FROM pages)"
    lines = "docs AS MATERIALIZED (SELECT conv_id, turn, text FROM conversations)"
    out = {
        "tokenize": select(TOK + [OFFSETS], """SELECT doc_id, sent_idx, t AS tok_in_sent, token,
            CAST(end_off - length(token) AS BIGINT) AS begin_off, CAST(end_off AS BIGINT) AS end_off FROM offs"""),
        "ssplit": select(TOK + [SENTENCES, OFFSETS], """SELECT s.doc_id, s.sent_idx, CAST(o.end_off - length(s.text) AS BIGINT) AS begin_off,
            CAST(o.end_off AS BIGINT) AS end_off, s.text, n_tokens FROM sentences s JOIN offs o ON o.doc_id = s.doc_id AND o.k = s.k1"""),
        "sentence_list": select(TOK + [SENTENCES], """SELECT d.doc_id, '[' || coalesce(string_agg(s.text, ', ' ORDER BY sent_idx), '') || ']' AS result
            FROM docs d LEFT JOIN sentences s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""),
        "cleanxml": select(tokens(pages, "page_id"), """SELECT 'cleanxml' AS functionality, page_id,
            string_agg(token || '-' || (t + 1), ' ' ORDER BY k) AS result FROM tok GROUP BY page_id"""),
        "pos": select(POS, "SELECT doc_id, sent_idx, t AS tok_in_sent, token, pos FROM pos"),
        "lemma": select(LEM, "SELECT doc_id, sent_idx, t AS tok_in_sent, token, lemma FROM lem"),
        "ner": select(POS + entities(), "SELECT doc_id, sent_idx, t AS tok_in_sent, token, ner FROM ner"),
        "regexner": select(POS + entities(rules=fixtures.RULES), "SELECT doc_id, sent_idx, t AS tok_in_sent, token, ner FROM ner"),
        "regexner_join": select(POS + entities(rules=OPENINGS), "SELECT doc_id, sent_idx, t AS tok_in_sent, token, ner FROM ner"),
        "ner_gazetteer": select(POS + entities(gazetteer=OPENINGS), "SELECT doc_id, sent_idx, t AS tok_in_sent, token, ner FROM ner"),
        "regexner_rules": select(POS + entities(rules=[
            ("Barack Obama", "ABLE"), ("Bachelor of Arts", "DEGREE"), ("Harvard", "H"), ("New York City", "CITY"), ("of Arts", "TAIL"), ("the", "FREQUENT")]),
            """SELECT doc_id, sent_idx, t AS tok_in_sent, token, ner, form FROM ner, (VALUES ('list'), ('trie'), ('join')) forms(form)"""),
        "tagger_counts": tagger_counts(),
        "lemma_counts": lemma_counts(),
        "natlog": select(POS + polarity(), "SELECT doc_id, sent_idx, t AS tok_in_sent, token, polarity FROM pol"),
        "sentiment": select(POS + polarity() + sentiment(), "SELECT doc_id, sent_idx, sentiment FROM sentiments"),
        "doc_sentiment": select(POS + polarity() + sentiment() + [SENTENCES], """SELECT s.doc_id, arg_min(sentiment, (-length(text), s.sent_idx)) AS sentiment
            FROM sentences s JOIN sentiments m ON m.doc_id = s.doc_id AND m.sent_idx = s.sent_idx GROUP BY s.doc_id"""),
        "parse_chunks": select(POS + chunked(), """SELECT doc_id, sent_idx, CAST(chunk_idx AS BIGINT) AS chunk_idx, kind, b AS begin_tok, e AS end_tok,
            text, head FROM chunk"""),
        "depparse_edges": select(POS + chunked() + dependency(), "SELECT * FROM edges"),
        "first_governor": select(POS + chunked() + dependency(), "SELECT doc_id, sent_idx, gov_tok FROM edges WHERE dep_tok = 0"),
        "openie": _triples(),
        "relation": _relations(),
        "relation_table": _relations(OPENINGS, fixtures.OPENING_PATTERNS),
        "quote": _quotes(),
        "annotate_long": _long(),
        "annotate_syntax": _syntax_long(),
        "line_as_sentence": _line_as_sentence(lines),
        "select_blocks": "SELECT page_id, 0::BIGINT AS block_idx, html AS content FROM pages",
        "html_to_text": f"SELECT page_id, {html_text('html', ('script', 'style'))} AS text FROM pages",
        "html_to_text_exact": f"SELECT page_id, {html_text('html', ('script', 'style'))} AS text FROM pages",
        "normalize_nfkd": f"SELECT doc_id, {nfkd('text')} AS text FROM documents",
        "drop_newlines": "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents",
        "articles_to_lines": f"SELECT page_id, replace({ARTICLE_TEXT}, chr(10), '') AS text FROM pages",
        "plain_lines": f"SELECT {ONE_LINE} AS text FROM documents",
        "spread": "SELECT 16::BIGINT AS parts, count(*) AS n_rows, true AS even FROM documents",
        "progress": "SELECT count(*) AS n FROM documents",
        "read_lines_indexed": f"SELECT {ONE_LINE} AS text, count(*) AS n, 0::BIGINT AS first, 0::BIGINT AS gap FROM documents GROUP BY 1",
        "read_lines_by_offset": f"SELECT 0::BIGINT AS off, {ONE_LINE} AS text FROM documents",
        "read_rules": r"""SELECT DISTINCT p AS pattern, 'OPENING' AS type FROM (SELECT regexp_extract(text, '^(\p{L}+ \p{L}+)(?:[ .,]|$)', 1) AS p
            FROM documents) WHERE p <> ''""",
        "annotate_with_model": "SELECT doc_id, length(text) AS n_chars FROM documents",
        "model_errors": """SELECT doc_id, CASE WHEN length(text) % 2 = 0 THEN length(text) END AS n_chars,
            CASE WHEN length(text) % 2 = 1 THEN 'ValueError: odd' END AS problem FROM documents""",
        "read_articles": "SELECT CAST(page_id AS VARCHAR) AS id, 2::BIGINT AS n_blocks, html AS content FROM pages",
        "sink_by_functionality": select(
            tokens(f"docs AS (SELECT doc_id, {ONE_LINE} AS text FROM documents)") + tags(),
            f"""SELECT 'tokenize' AS functionality, r AS result FROM {_per_doc('token', 'tok')}
            UNION ALL SELECT 'pos', coalesce(r, '') FROM docs d LEFT JOIN {_per_doc('pos', 'pos')} x ON x.doc_id = d.doc_id"""),
        "sink_keyed": select(
            tokens("docs AS (SELECT doc_id, text FROM documents)"),
            f"SELECT '(tokenize, ' || doc_id || ')' || chr(9) || r AS line FROM {_per_doc('token', 'tok')}"),
        "sink_json": select(
            tokens("docs AS (SELECT doc_id, text FROM documents)"),
            f"SELECT 'tokenize' AS functionality, doc_id, r AS result FROM {_per_doc('token', 'tok')}"),
    }
    for mode in ("coref", "dcoref"):
        chain = LEM + entities("lem") + chunked("ner") + mention_rows(mode)
        out[mode] = select(chain, """SELECT m.doc_id, c.chain_id, m.sent_idx, m.b AS begin_tok, m.e AS end_tok, m.text,
            m.place = c.rep_place AS is_representative FROM mention m JOIN chains c ON c.doc_id = m.doc_id AND c.ckey = m.ckey""")
        out[f"{mode}_text"] = select(chain + chain_text(mode), f"""SELECT {q(mode)} AS functionality, d.doc_id, coalesce(result, '') AS result
            FROM docs d LEFT JOIN chain_results r ON r.doc_id = d.doc_id""")
    out["sorted_results"] = select(TOK, f"""SELECT 'tokenize' AS functionality, doc_id, row_number() OVER (ORDER BY doc_id) AS rank,
        r AS result FROM {_per_doc('token', 'tok')}""")
    return out

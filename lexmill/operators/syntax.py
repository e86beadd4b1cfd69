"""Sentence-level layers: phrase chunks, dependency edges, polarity, sentiment, triples, relations.

Each sentence gets a class letter per token. The places of a class cut the sentence into segments, and what
holds for a whole segment (the nearest noun or verb, how many words turned the meaning) is repeated over it
once, so every layer is linear in the sentence, however long it is. Layers are steps, as in `tagging`.
"""

from __future__ import annotations

from lexmill.functions import lexicons as L
from lexmill.functions.sqltext import case, lookup, quote, quoted
from lexmill.operators.tagging import Step

CLASS_OF_TAG = case([
    ("startswith(p, 'NN')", "'N'"),
    ("p IN ('DT', 'PRP$')", "'d'"),
    ("p = 'PRP'", "'q'"),
    ("startswith(p, 'JJ') OR p = 'CD'", "'j'"),
    ("startswith(p, 'VB')", "'V'"),
    ("p = 'MD'", "'m'"),
    ("p = 'RB'", "'r'"),
    ("p = 'IN'", "'i'"),
    ("p = 'TO'", "'t'"),
    ("p = 'CC'", "'c'"),
], "'.'")


KIND_OF_CLASS = case([("{0} IN ('N', 'j', 'd', 'q')", "'NP'"), ("{0} IN ('V', 'm', 'r')", "'VP'"), ("{0} IN ('i', 't')", "'PP'")], "'O'")


def _joined(xs: str, b: str, e: str) -> str:
    return f"array_join(slice({xs}, {b} + 1, {e} - {b}), ' ')"


def places(xs: str, test: str) -> str:
    """Where the test over the element `c` holds."""
    return f"filter(transform({xs}, (c, i) -> CASE WHEN {test} THEN i END), i -> i IS NOT NULL)"


def segments(at: str, n: str, inner: str, last: str, shift: int) -> str:
    """An array of `n` values, `inner` (over place `p` and its number `k`) up to each place of `at`, then `last`.
    With `shift` 1 a place belongs to the segment before it, with 0 to the one after."""
    before = f"CASE WHEN k = 0 THEN {-shift} ELSE get({at}, k - 1) END"
    rest = f"greatest(0, {n} - {shift} - CASE WHEN size({at}) = 0 THEN {-shift} ELSE element_at({at}, -1) END)"
    return (f"concat(flatten(transform({at}, (p, k) -> array_repeat({inner}, p - {before}))), "
            f"array_repeat({last}, {rest}))")


def following(at: str, n: str) -> str:
    """For each token the next place of `at` after it, -1 where there is none."""
    return segments(at, n, "p", "-1", 0)


def preceding(at: str, n: str) -> str:
    """For each token the last place of `at` before it, -1 where there is none."""
    return segments(at, n, f"CASE WHEN k = 0 THEN -1 ELSE get({at}, k - 1) END",
                    f"CASE WHEN size({at}) = 0 THEN -1 ELSE element_at({at}, -1) END", 1)


def classes() -> list[Step]:
    """The class letters `cs`, the kinds of phrase they belong to, and the places of nouns and verbs."""
    return [
        Step("cs", "pos", f"transform(s.pos, p -> {CLASS_OF_TAG})"),
        Step("kinds", "cs", f"transform(s.cs, c -> {KIND_OF_CLASS.format('c')})"),
        Step("nouns", "cs", places("s.cs", "c = 'N'")),
        Step("verbs", "cs", places("s.cs", "c = 'V'")),
        Step("noun0", "nouns cs", preceding("s.nouns", "size(s.cs)")),
    ]


def bounds() -> list[Step]:
    """`bounds`: where phrases begin, and `ends`. Noun phrases restart at a determiner or pronoun, and a pronoun stands alone."""
    new = "i = 0 OR get(s.kinds, i - 1) != get(s.kinds, i) OR c IN ('d', 'q') OR get(s.cs, i - 1) = 'q'"
    return [
        Step("bounds", "cs kinds", places("s.cs", new)),
        Step("ends", "bounds cs", "concat(slice(s.bounds, 2, size(s.bounds)), array(size(s.cs)))"),
    ]


def _chunk() -> str:
    """The phrase that begins at `b`, the `j`th of a sentence."""
    end = "coalesce(get(s.bounds, j + 1), size(s.cs))"
    kind, last = KIND_OF_CLASS.format("get(s.cs, b)"), f"({end} - 1)"
    noun = f"CASE WHEN get(s.cs, {last}) = 'N' THEN {last} ELSE get(s.noun0, {last}) END"
    return (f"named_struct('kind', {kind}, 'b', b, 'e', {end}, 'text', {_joined('s.toks', 'b', end)}, "
            f"'head', CASE WHEN {noun} >= b THEN {noun} ELSE {last} END)")


#: What a phrase, and an edge, is put together from. A table of them has a row for each and works them out there, where Spark
#: compiles them; inside a list it does not.
CHUNK_READS, CHUNK = "toks cs noun0 bounds", _chunk()
EDGE_READS = "root cs noun verb verb0 other0 pos"


def chunks() -> list[Step]:
    """`chunks`: kind, token range, text and head token of every phrase."""
    return [Step("chunks", CHUNK_READS, f"transform(s.bounds, (b, j) -> {CHUNK})")]


# One sentence as `(S (NP the dog) (VP ran) .)`.
BRACKETED_READS = "toks kinds bounds ends"
_WORDS = _joined("s.toks", "b", "get(s.ends, j)")
BRACKETED = (
    "concat('(S ', array_join(transform(s.bounds, (b, j) -> CASE WHEN get(s.kinds, b) = 'O' "
    f"THEN {_WORDS} ELSE concat('(', get(s.kinds, b), ' ', {_WORDS}, ')') END), ' '), ')')")


def edge(written: bool = False) -> str:
    """The edge of the token with the tag `p` at `i`; as a struct, or written as `rel(governor-i, dependent-j)` from the `labels` of
    the tokens."""
    after = "get(s.cs, i + 1)"
    noun, verb, verb0 = "get(s.noun, i)", "get(s.verb, i)", "get(s.verb0, i)"
    # The last word before the noun phrase is a preposition.
    oblique = "get(s.cs, get(s.other0, i)) IN ('i', 't')"

    def to(gov: str, rel: str) -> str:
        if written:
            return f"concat({rel}, '(', {"'ROOT-0'" if gov == '-1' else f'get(s.labels, {gov})'}, ', ', get(s.labels, i), ')')"
        return f"named_struct('dep', i, 'gov', {gov}, 'rel', {rel})"

    # One branch per class of the token, so that only what its rules need is looked up.
    loose = to("s.root", "'dep'")
    nominal = case([
        (f"{verb0} >= 0", to(verb0, f"CASE WHEN {oblique} THEN 'obl' ELSE 'obj' END")),
        (f"{verb} >= 0", to(verb, "'nsubj'")),
    ], loose)
    modifier = case([("p = 'PRP$'", "'nmod:poss'"), ("p = 'CD'", "'nummod'"), ("p = 'DT'", "'det'")], "'amod'")
    return case([
        ("i = s.root", to("-1", "'root'")),
        ("startswith(p, 'NN')", case([(f"{after} = 'N'", to("i + 1", "'compound'"))], nominal)),
        ("p = 'PRP'", nominal),
        ("p IN ('DT', 'PRP$', 'CD') OR startswith(p, 'JJ')", case([(f"{noun} >= 0", to(noun, modifier))], loose)),
        ("p IN ('IN', 'TO')", case([
            (f"p = 'TO' AND {after} = 'V'", to("i + 1", "'mark'")), (f"{noun} >= 0", to(noun, "'case'"))], loose)),
        (f"p IN ({quoted([*L.PUNCTUATION, 'SYM'])})", to("s.root", "'punct'")),
        ("p = 'RB'", case([(f"{verb} >= 0", to(verb, "'advmod'")), (f"{verb0} >= 0", to(verb0, "'advmod'"))], loose)),
        ("p = 'MD'", case([(f"{verb} >= 0", to(verb, "'aux'"))], loose)),
        ("p = 'CC'", to("s.root", "'cc'")),
    ], loose)


def near() -> list[Step]:
    """For each token the words around it that may govern it: the next noun and verb, the last verb, the last word before its
    noun phrase; and the root."""
    n = "size(s.cs)"
    return [
        Step("labels", "toks", "transform(s.toks, (t, i) -> concat(t, '-', i + 1))"),
        Step("root", "nouns verbs", "coalesce(get(s.verbs, 0), get(s.nouns, 0), 0)"),
        Step("others", "cs", places("s.cs", "c NOT IN ('d', 'j', 'N')")),
        Step("noun", "nouns cs", following("s.nouns", n)),
        Step("verb", "verbs cs", following("s.verbs", n)),
        Step("verb0", "verbs cs", preceding("s.verbs", n)),
        Step("other0", "others cs", preceding("s.others", n)),
    ]


def edges() -> list[Step]:
    """`edges`: one governor per token, -1 for the root."""
    return [Step("edges", EDGE_READS, f"transform(s.pos, (p, i) -> {edge()})")]


#: What the edges of a sentence are written from, and their text: places count from 1, and the root's governor is `ROOT-0`.
EDGE_TEXT_READS = "labels root cs noun verb verb0 other0 pos"
EDGE_TEXT = f"array_join(transform(s.pos, (p, i) -> {edge(written=True)}), ' ')"


def polarities() -> list[Step]:
    """`pol`: `down` after an odd number of downward words in the sentence, `flat` between a
    quantifier and the next verb, else `up`."""
    letter = case([
        (f"w IN ({quoted(L.DOWNWARD)})", "'x'"),
        (f"w IN ({quoted(L.FLAT_QUANTIFIERS)})", "'m'"),
        ("startswith(p, 'VB')", "'v'"),
    ], "'-'")
    n = "size(s.q)"
    turned = segments("s.turns", n, "k % 2", "size(s.turns) % 2", 1)
    verb0 = "CASE WHEN c = 'v' THEN i ELSE get(s.qv, i) END"
    scope = case([(f"get(s.qm, i) > {verb0}", "'flat'"), ("get(s.odd, i) = 1", "'down'")], "'up'")
    turning = f"exists(s.lows, w -> w IN ({quoted([*L.DOWNWARD, *L.FLAT_QUANTIFIERS])}))"
    return [
        # Empty for a sentence without such a word: all of it is `up`.
        Step("q", "lows pos", f"CASE WHEN {turning} THEN zip_with(s.lows, s.pos, (w, p) -> {letter}) ELSE CAST(array() AS array<string>) END"),
        Step("turns", "q", places("s.q", "c = 'x'")),
        Step("limits", "q", places("s.q", "c = 'm'")),
        Step("qverbs", "q", places("s.q", "c = 'v'")),
        Step("odd", "turns q", turned),
        Step("qm", "limits q", preceding("s.limits", n)),
        Step("qv", "qverbs q", preceding("s.qverbs", n)),
        Step("pol", "lows q turns limits odd qm qv", (
            f"CASE WHEN size(s.turns) + size(s.limits) = 0 THEN array_repeat('up', size(s.lows)) "
            f"ELSE transform(s.q, (c, i) -> {scope}) END")),
    ]


def sentiments() -> list[Step]:
    """`sentiment`, 0 to 4: the sum of word valences, turned over where polarity is `down`."""
    value = case([
        (f"w IN ({quoted(L.POSITIVE)})", "CASE WHEN p = 'down' THEN -1 ELSE 1 END"),
        (f"w IN ({quoted(L.NEGATIVE)})", "CASE WHEN p = 'down' THEN 1 ELSE -1 END"),
    ], "0")
    score = f"aggregate(zip_with(s.lows, s.pol, (w, p) -> {value}), 0, (acc, x) -> acc + x)"
    told = f"exists(s.lows, w -> w IN ({quoted([*L.POSITIVE, *L.NEGATIVE])}))"
    return [Step("sentiment", "lows pol", f"CASE WHEN {told} THEN greatest(-2, least(2, {score})) + 2 ELSE 2 END")]


def triples() -> list[Step]:
    """`triples`: NP VP NP, or NP VP PP NP, as lemma glosses."""
    def begin(k: int) -> str:
        return f"get(s.bounds, j + {k})" if k else "b"

    def kind(k: int) -> str:
        return f"get(s.kinds, {begin(k)})"

    def words(first: int, last: int) -> str:
        return _joined("s.lems", begin(first), f"get(s.ends, j + {last})")

    def triple(confidence: float, n: int) -> str:
        return (f"named_struct('confidence', {confidence}D, 'subject', {words(0, 0)}, "
                f"'relation', {words(1, n)}, 'object', {words(n + 1, n + 1)})")

    found = case([
        (f"{kind(2)} = 'NP'", triple(L.CONFIDENCE_DIRECT, 1)),
        (f"{kind(2)} = 'PP' AND {kind(3)} = 'NP'", triple(L.CONFIDENCE_PREPOSITION, 2)),
    ])
    found = f"CASE WHEN {kind(1)} = 'VP' AND {kind(0)} = 'NP' THEN {found} END"
    return [Step("triples", "bounds ends kinds lems", f"filter(transform(s.bounds, (b, j) -> {found}), t -> t IS NOT NULL)")]


TRIPLE_TEXT = "concat('(', concat_ws(',', CAST(t.confidence AS STRING), t.subject, t.relation, t.object), ')')"


PAIR = "struct<b1:int,b2:int,entity1:string,type1:string,lemma:string,type2:string,entity2:string>"


def _adjacent(at: str, groups: str, part: str, wanted: str) -> str:
    """Every entity before a place of `at` with every one after it, no other place of `at` between: `groups` are the first
    entities of each stretch between places, `part` the number of places before each entity. `wanted` is over place `p`."""
    here, after = "get(s.{0}, r)".format(groups), "get(s.{0}, r + 1)".format(groups)
    beyond = f"coalesce(get(s.{groups}, r + 2), size(s.found))"
    place = f"get(s.{at}, get(s.{part}, {here}))"
    pair = ("named_struct('b1', a.b, 'b2', z.b, 'entity1', " + _joined("s.toks", "a.b", "a.e") + ", 'type1', a.type, "
            "'lemma', get(s.lems, p), 'type2', z.type, 'entity2', " + _joined("s.toks", "z.b", "z.e") + ")")
    product = (f"flatten(transform(slice(s.found, {here} + 1, {after} - {here}), a -> "
               f"transform(slice(s.found, {after} + 1, {beyond} - {after}), z -> {pair})))")
    named = f"get(transform(array({place}), p -> CASE WHEN {wanted} THEN {product} ELSE CAST(array() AS array<{PAIR}>) END), 0)"
    return (f"flatten(transform(s.{groups}, (c, r) -> CASE WHEN get(s.{part}, {after}) = get(s.{part}, c) + 1 THEN {named} "
            f"ELSE CAST(array() AS array<{PAIR}>) END))")


def entity_pairs(lemmas, types) -> list[Step]:
    """`pairs`: two entities of a sentence with a pattern's word between them. A word that is no preposition (a verb) holds
    all entities before it together with all after it, as far as the next such word to either side; a preposition likewise,
    as far as the next pattern's word of any kind. Words of an entity are no pattern's words."""
    def parts(at: str, name: str) -> list[Step]:
        n = "size(s.toks)"
        return [
            Step(f"{name}_count", f"toks {at}", segments(f"s.{at}", n, "k", f"size(s.{at})", 1)),
            Step(f"{name}_part", f"found {name}_count", f"transform(s.found, x -> get(s.{name}_count, x.b))"),
            Step(f"{name}_groups", f"{name}_part", places(f"s.{name}_part", f"i = 0 OR c != get(s.{name}_part, i - 1)")),
        ]
    return [
        Step("entity_bounds", "ner", places("s.ner", "i = 0 OR c != get(s.ner, i - 1)")),
        Step("found", "ner entity_bounds", (
            "filter(transform(s.entity_bounds, (b, j) -> named_struct('b', b, 'e', coalesce(get(s.entity_bounds, j + 1), "
            f"size(s.ner)), 'type', get(s.ner, b))), x -> x.type IN ({quoted(types)}))")),
        Step("links", "lems ner", places("s.lems", f"c IN ({quoted(lemmas)}) AND get(s.ner, i) NOT IN ({quoted(types)})")),
        Step("deeds", "links pos", "filter(s.links, p -> get(s.pos, p) NOT IN ('IN', 'TO'))"),
        *parts("links", "link"),
        *parts("deeds", "deed"),
        Step("pairs", "found toks lems pos links link_part link_groups deeds deed_part deed_groups", (
            f"CASE WHEN size(s.found) < 2 OR size(s.links) = 0 THEN CAST(array() AS array<{PAIR}>) ELSE concat("
            + _adjacent("deeds", "deed_groups", "deed_part", "true") + ", "
            + _adjacent("links", "link_groups", "link_part", "get(s.pos, p) IN ('IN', 'TO')") + ") END")),
    ]


def relations(patterns=None) -> list[Step]:
    """`relations`: the pairs that a pattern (type, lemma, type, relation) names, by the places of both entities."""
    patterns = L.RELATION_PATTERNS if patterns is None else patterns
    names: dict[str, list[str]] = {}
    for first, lemma, second, name in sorted(set(map(tuple, patterns))):
        names.setdefault(f"{first}|{lemma}|{second}", []).append(name)
    kinds = lookup({key: "|".join(kinds) for key, kinds in names.items()}, "concat_ws('|', x.type1, x.lemma, x.type2)")
    named = (f"flatten(transform(s.pairs, x -> transform(split(coalesce({kinds}, ''), '[|]'), k -> "
             "named_struct('b1', x.b1, 'b2', x.b2, 'type', k, 'entity1', x.entity1, 'entity2', x.entity2))))")
    return [
        *entity_pairs(sorted({p[1] for p in patterns}) or [""], sorted({t for p in patterns for t in (p[0], p[2])}) or [""]),
        Step("relations", "pairs", (
            "CASE WHEN size(s.pairs) = 0 THEN CAST(array() AS array<struct<entity1:string,type:string,entity2:string>>) ELSE "
            f"transform(sort_array(array_distinct(filter({named}, x -> x.type != ''))), "
            "x -> named_struct('entity1', x.entity1, 'type', x.type, 'entity2', x.entity2)) END")),
    ] if names else [Step("relations", "toks", "CAST(array() AS array<struct<entity1:string,type:string,entity2:string>>)")]


#: A sentence without a capital after its first token and without a pronoun has a mention only where a phrase of a dictionary is.
MAY_MENTION = rf"\x1f\p{{Lu}}|(?i:(?<![^\x1f])(?:{'|'.join(L.PRONOUNS)})(?=\x1f|\z))"


def mentions() -> list[Step]:
    """`mentions`: noun phrases with a name as head, and personal pronouns, in text order."""
    last = "(get(s.ends, j) - 1)"
    head = (f"CASE WHEN get(s.cs, {last}) = 'N' THEN {last} WHEN get(s.noun0, {last}) >= b THEN get(s.noun0, {last}) ELSE {last} END")
    name = (
        f"CASE WHEN startswith(get(s.pos, h), 'NNP') OR get(s.ner, h) IN ({quoted(L.ENTITY_TYPES)}) THEN named_struct('b', b, "
        f"'e', get(s.ends, j), 'text', {_joined('s.toks', 'b', 'get(s.ends, j)')}, 'head_lemma', lower(get(s.lems, h)), "
        "'pronoun', false, 'type', get(s.ner, h), 'plural', get(s.pos, h) IN ('NNS', 'NNPS')) END")
    named = f"CASE WHEN get(s.kinds, b) = 'NP' AND get(s.cs, b) != 'q' THEN get(transform(array({head}), h -> {name}), 0) END"
    pronoun = (
        f"CASE WHEN w IN ({quoted(L.PRONOUNS)}) AND get(s.pos, i) IN ('PRP', 'PRP$') THEN named_struct('b', i, "
        "'e', i + 1, 'text', get(s.toks, i), 'head_lemma', w, 'pronoun', true, 'type', 'O', 'plural', false) END")
    return [Step("mentions", "bounds ends kinds noun0 cs pos ner toks lows lems", (
        f"sort_array(filter(concat(transform(s.bounds, (b, j) -> {named}), transform(s.lows, (w, i) -> {pronoun})), "
        "m -> m IS NOT NULL))"))]

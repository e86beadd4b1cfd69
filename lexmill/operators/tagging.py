"""Token-level layers: part of speech, lemma, entity tag, dictionary override.

A layer is one column of the document row: an array over the sentences, whose elements are mostly
parallel arrays over the tokens of a sentence, so a neighbour is `get(xs, i + 1)`. A step names the
columns it reads and gives its value for one sentence `s` as SQL text. Separate columns let the
optimizer drop what a query does not use, and a step never copies what earlier steps made, as it
would if a sentence were one growing struct. All steps are row-local: no shuffle, no sort.
"""

from __future__ import annotations

from typing import NamedTuple

from lexmill.functions import lexicons as L
from lexmill.functions.sqltext import case, lookup, quote, quoted


class Step(NamedTuple):
    name: str
    reads: str
    value: str

    def sql(self) -> str:
        """The column's SQL. The columns it reads are arguments and never used inside the lambda itself,
        where the optimizer could put their whole definition, to be computed again for every sentence."""
        return f"transform(arrays_zip({', '.join(self.reads.split())}), s -> {self.value})"


def words() -> list[Step]:
    return [Step("lows", "toks", "transform(s.toks, t -> lower(t))")]


def small_first(token: str) -> str:
    """Whether a token begins with a lower-case letter; with ASCII it is known by comparison, without a regex."""
    return f"({token} >= 'a' AND ({token} < '{{' OR ({token} > '~' AND {token} RLIKE {quote(L.SMALL_FIRST)})))"


def ascii_digit(token: str) -> str:
    """Whether a token begins with an ASCII digit, by comparison."""
    return f"({token} >= '0' AND {token} < ':')"


def ascii_sign(token: str) -> str:
    """Whether a token is a single ASCII character but no letter, if it does not begin with a small one or a digit."""
    return f"(({token} < 'A' OR {token} >= '[') AND {token} <= '~' AND length({token}) = 1)"


def _first_tag() -> str:
    """Over the lower-cased token `w` at place `i`; the token itself is looked up only for its case."""
    every = [word for ws in L.CLOSED_CLASS.values() for word in ws]
    closed = case([(f"w IN ({quoted(ws)})", quote(tag)) for tag, ws in L.CLOSED_CLASS.items()])
    punct = case([(f"w IN ({quoted(ps)})", quote(tag)) for tag, ps in L.PUNCTUATION.items()], "'SYM'")
    plural = ("NOT endswith(w, 'ss') AND length(w) > 3", "'NNS'")

    def endings(of_s: bool) -> list[tuple[str, str]]:
        return [(f"endswith(w, {quote(end)}) AND length(w) >= {n}", quote(tag)) for end, n, tag in L.SUFFIXES if end.endswith("s") == of_s]
    # One look at the last two letters rules out all endings for most tokens.
    last_two = sorted({end[-2:] for end, _, _ in L.SUFFIXES if not end.endswith("s")})
    by_suffix = case([("endswith(w, 's')", case([*endings(True), plural], "'NN'")),
                      (f"substr(w, -2) IN ({quoted(last_two)})", case(endings(False), "'NN'"))], "'NN'")
    # Most tokens begin with ASCII and need no regex. What is lower-cased to a small ASCII letter is that letter or a capital.
    token = "get(s.toks, i)"
    small = f"{token} >= 'a' AND {token} < '{{'"
    other = case([
        (f"{token} > '~' AND {token} RLIKE {quote(L.SMALL_FIRST)}", by_suffix),
        (f"NOT w RLIKE {quote(L.LETTER_OR_DIGIT)}", punct),
        (f"w RLIKE {quote(L.DIGIT_FIRST)}", "'CD'"),
        (f"i > 0 AND {token} RLIKE {quote(L.CAPITAL_FIRST)}", "'NNP'"),
    ], by_suffix)
    return case([
        (f"w IN ({quoted(every)})", closed),
        ("w >= 'a' AND w < '{'", case([(f"i > 0 AND {token} != w AND NOT ({small})", "'NNP'")], by_suffix)),
        (ascii_digit("w"), "'CD'"),
        (ascii_sign("w"), punct),
    ], other)


#: Without one of these first tags a sentence has nothing to patch.
PATCHED_BY = ["TO", "MD", "VBD", "VBG"]


def tags() -> list[Step]:
    """`pos`: lexicon, shape and suffix rules, then two patches from the neighbours' first tags."""
    patched = case([
        ("g = 'NN' AND get(s.first, i - 1) IN ('TO', 'MD')", "'VB'"),
        ("g IN ('VBD', 'VBG') AND get(s.first, i - 1) IN ('DT', 'PRP$')",
         "CASE WHEN startswith(get(s.first, i + 1), 'NN') THEN 'JJ' ELSE 'NN' END"),
    ], "g")
    return [
        Step("first", "toks lows", f"transform(s.lows, (w, i) -> {_first_tag()})"),
        Step("pos", "first", (
            f"CASE WHEN arrays_overlap(s.first, array({quoted(PATCHED_BY)})) THEN transform(s.first, (g, i) -> {patched}) ELSE s.first END")),
    ]


def _stem(low: str, cut: int) -> str:
    """Without the ending, and without the second of two equal consonants before it."""
    return (f"CASE WHEN {low} RLIKE {quote('(?:bb|dd|gg|mm|nn|pp|rr|tt)' + '.' * cut + '$')} "
            f"THEN left({low}, length({low}) - {cut + 1}) ELSE left({low}, length({low}) - {cut}) END")


def lemmas() -> list[Step]:
    """`lems`."""
    irregular = {form: lemma for lemma, forms in L.IRREGULAR_LEMMAS.items() for form in forms}
    irregular = dict(reversed(irregular.items()))  # the frequent ones first: a literal map is looked through from its start
    low, pos = "w", "get(s.pos, i)"
    plural = case([
        (f"endswith({low}, 'ies') AND length({low}) > 4", f"concat(left({low}, length({low}) - 3), 'y')"),
        (f"{low} RLIKE {quote('(?:s|x|z|ch|sh)es$')}", f"left({low}, length({low}) - 2)"),
    ], f"left({low}, length({low}) - 1)")
    lemma = case([
        (f"{low} IN ({quoted(irregular)})", lookup(irregular, low)),
        (f"{pos} = 'NN'", low),
        (f"startswith({pos}, 'NNP')", "get(s.toks, i)"),
        (f"{pos} NOT IN ('NNS', 'VBZ', 'VBD', 'VBG')", low),
        (f"{pos} IN ('NNS', 'VBZ') AND endswith({low}, 's')", plural),
        (f"{pos} = 'VBD' AND endswith({low}, 'ed')", _stem(low, 2)),
        (f"{pos} = 'VBG' AND endswith({low}, 'ing')", _stem(low, 3)),
    ], low)
    return [Step("lems", "toks lows pos", f"transform(s.lows, (w, i) -> {lemma})")]


SPANS = "array<struct<b:int,e:int,type:string>>"


def phrase_candidates(toks: str, rules: list[tuple[str, str]]) -> str:
    """The longest rule that starts at each token, in token order; one type per phrase."""
    by_length: dict[int, dict[str, str]] = {}
    for phrase, kind in rules:
        parts = phrase.split()
        if parts:
            by_length.setdefault(len(parts), {}).setdefault(" ".join(parts), kind)
    if not by_length:
        return f"CAST(array() AS {SPANS})"
    heads = sorted({p.split()[0] for d in by_length.values() for p in d})

    def hit(n: int) -> str:
        kind = lookup(by_length[n], f"array_join(slice({toks}, i + 1, {n}), ' ')")
        return f"transform(filter(array({kind}), k -> k IS NOT NULL), k -> named_struct('b', i, 'e', i + {n}, 'type', k))"

    # `get(..., 0)` of a list with at most one hit, so a lookup is written and done once per length.
    longest = ", ".join(f"get({hit(n)}, 0)" for n in sorted(by_length, reverse=True))
    return (f"filter(transform({toks}, (t, i) -> CASE WHEN t IN ({quoted(heads)}) THEN coalesce({longest}) END), "
            "c -> c IS NOT NULL)")


def non_overlapping(candidates: str, block: int = 256) -> str:
    """Leftmost spans that do not overlap, from candidates in token order with distinct starts. Appending copies
    an array, so the walk goes in blocks: a block starts at the end of the last span kept before it."""
    nothing = f"CAST(array() AS {SPANS})"
    walk = (f"aggregate(slice(cs, j * {block} + 1, {block}), named_struct('end', acc.end, 'kept', {nothing}), "
            "(a, c) -> CASE WHEN c.b >= a.end THEN named_struct('end', c.e, 'kept', concat(a.kept, array(c))) ELSE a END)")
    step = f"get(transform(array({walk}), w -> named_struct('end', w.end, 'kept', concat(acc.kept, array(w.kept)))), 0)"
    blocks = f"sequence(0, CAST(floor((size(cs) - 1) / {block}) AS INT))"
    folded = (f"aggregate({blocks}, named_struct('end', 0, 'kept', CAST(array() AS array<{SPANS}>)), "
              f"(acc, j) -> {step}, acc -> flatten(acc.kept))")
    return f"get(transform(array({candidates}), cs -> CASE WHEN size(cs) = 0 THEN {nothing} ELSE {folded} END), 0)"


def override(base: str, spans: str) -> str:
    """`base` tags with the tokens of each span set to the span's type."""
    before = f"coalesce(get({spans}, j - 1).e, 0)"
    last = f"element_at({spans}, -1).e"
    pieces = (f"transform({spans}, (k, j) -> concat(slice({base}, {before} + 1, k.b - {before}), "
              "array_repeat(k.type, k.e - k.b)))")
    return (f"CASE WHEN size({spans}) = 0 THEN {base} "
            f"ELSE concat(flatten({pieces}), slice({base}, {last} + 1, size({base}))) END")


NUMERIC = case([("startswith(t, '$')", "'MONEY'"), ("endswith(t, '%')", "'PERCENT'")], "'NUMBER'")
ADDRESS = case([
    ("startswith(t, 'http') AND (startswith(t, 'http://') OR startswith(t, 'https://'))", "'URL'"),
    ("contains(t, '@') AND length(t) > 1", "'EMAIL'"),
], "'O'")


def shape() -> str:
    """The shape of the token `t` at place `i`. The built-in rules tell numbers and names in capitals from the token alone, and
    no neighbour changes them, so that tags need not be found first."""
    closed = [word for ws in L.CLOSED_CLASS.values() for word in ws]
    marks = [mark for ms in L.PUNCTUATION.values() for mark in ms]
    return case([
        (f"t IN ({quoted(marks)})", "'O'"),
        (small_first("t"), ADDRESS),
        # As in _first_tag, what begins with ASCII needs no regex.
        (ascii_digit("t"), NUMERIC),
        (ascii_sign("t"), "'O'"),
        (f"lower(t) IN ({quoted(closed)})", ADDRESS),
        ("t >= 'A' AND t < '['", case([("i > 0", "'MISC'")], ADDRESS)),
        (f"lower(t) RLIKE {quote(L.DIGIT_FIRST)}", NUMERIC),
        (f"i > 0 AND t RLIKE {quote(L.CAPITAL_FIRST)} AND lower(t) RLIKE {quote(L.LETTER_OR_DIGIT)}", "'MISC'"),
    ], ADDRESS)


def shapes(learned_tags: bool = False) -> list[Step]:
    """`shaped`: numbers, addresses and capitalised words, `O` otherwise; by learned tags, or by the tokens alone."""
    if learned_tags:
        by_tag = case([("get(s.pos, i) = 'CD'", NUMERIC), ("get(s.pos, i) = 'NNP'", "'MISC'")], ADDRESS)
        return [Step("shaped", "toks pos", f"transform(s.toks, (t, i) -> {by_tag})")]
    return [Step("shaped", "toks", f"transform(s.toks, (t, i) -> {shape()})")]


def phrases(name: str, base: str, rules: list[tuple[str, str]] | None) -> list[Step]:
    """`name`: the tags `base`, overridden where a rule's phrase matches: token-wise, case-sensitive, leftmost then
    longest. Without rules the spans are there already, from a table."""
    if rules == []:
        return [Step(name, base, f"s.{base}")]
    found = [] if rules is None else [Step(f"{name}_spans", "toks", non_overlapping(phrase_candidates("s.toks", rules)))]
    return [*found, Step(name, f"{base} {name}_spans", override(f"s.{base}", f"s.{name}_spans"))]


def entities(rules: list[tuple[str, str]] | None, gazetteer: list[tuple[str, str]] | None, learned: bool = False,
             learned_tags: bool = False) -> list[Step]:
    """`ner`: shapes, overridden by the gazetteer's phrases, then by the dictionary's. None stands for a table, whose spans
    are in `named_spans` and `ner_spans`; an empty list changes nothing. With learned tags `shaped` is there already."""
    return ([] if learned else shapes(learned_tags)) + phrases("named", "shaped", gazetteer) + phrases("ner", "named", rules)

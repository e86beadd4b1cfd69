"""Mention chains, found in the row of a document.

Mentions stand in text order in one array. Each looks for the nearest earlier one that it may mean, sieve by sieve, and is
merged into its chain; the first sieve that finds one decides. For a name (`coref`): the same words without determiners; an
acronym and the name that it abbreviates, whichever comes first; the same first and last word; a single word that is the
last word of a longer name, or the first word of a longer name of a person. In the mode `dcoref` names are merged by the
lemma of their head instead. A pronoun means the nearest earlier name whose chain agrees with it in gender, number and kind,
in either mode. Every sieve is a lookup by a key, so the work is linear in the mentions.

Both modes come from one pass, and nothing is shuffled."""

from __future__ import annotations

from typing import NamedTuple
from unicodedata import category

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicons as L
from lexmill.functions.rows import each, held
from lexmill.operators.documents import analysed

MODES = ("coref", "dcoref")
#: Words that may stand before a name and are no part of it.
DETERMINERS = frozenset(L.CLOSED_CLASS["DT"] + L.CLOSED_CLASS["PRP$"])
KIND_OF_PRONOUN = {word: kind for kind, words in L.PRONOUN_KINDS.items() for word in words}
GENDER = {name: gender for gender, names in L.GIVEN_NAMES.items() for name in names}


class Mention(NamedTuple):
    text: str
    head_lemma: str
    pronoun: bool
    type: str
    plural: bool


class Chains:
    """Union-find over the mentions of a document; the root of a chain is its first mention."""

    def __init__(self, n: int):
        self.above = list(range(n))

    def root(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def merge(self, i: int, j: int) -> None:
        a, b = sorted((self.root(i), self.root(j)))
        self.above[b] = a


def name_words(text: str) -> list[str]:
    """The words of a name without determiners before it, unless it is made of them."""
    words = text.split(" ")
    at = next((i for i, w in enumerate(words) if w.lower() not in DETERMINERS), 0)
    return words[at:]


def capital(word: str) -> bool:
    return word != "" and category(word[0]) == "Lu"


def keys_of(mention: Mention) -> tuple[list[tuple], list[tuple]]:
    """What a name looks for, in the order of the sieves, and what it is found by."""
    words = name_words(mention.text)
    first, last = words[0], words[-1]
    sought: list[tuple] = [("same", *words)]
    known = [("same", *words)]
    if len(words) == 1:
        letters = first.replace(".", "")
        if len(letters) > 1 and all(category(c) == "Lu" for c in letters):
            sought.append(("long", letters))
            known.append(("short", letters))
        sought += [("last", last), ("first", first)]
    else:
        initials = "".join(w[0] for w in words if capital(w))
        if len(initials) > 1:
            sought.append(("short", initials))
            known.append(("long", initials))
        sought.append(("ends", first, last))
        known += [("ends", first, last), ("last", last)] + ([("first", first)] if mention.type == "PERSON" else [])
    return sought, known


def agreeing(kind: str | None, gender: str | None, plural: bool) -> list[str]:
    """The kinds of pronouns that may mean a name, by its entity type and gender as far as they are known."""
    kinds = []
    if kind not in ("LOCATION", "ORGANIZATION") and not plural:
        kinds += [k for k in ("male", "female") if gender in (None, k)]
    if plural or kind == "ORGANIZATION":
        kinds.append("plural")
    if kind != "PERSON":
        kinds.append("thing")
    return kinds


def chains(mentions: list[Mention], mode: str) -> list[int]:
    """The place of the first mention of each one's chain. What a chain's names have told of its type and gender holds for
    its later names too."""
    merged = Chains(len(mentions))
    latest: dict[tuple, int] = {}
    told: dict[int, tuple[str | None, str | None]] = {}
    for i, mention in enumerate(mentions):
        if mention.pronoun:
            found = latest.get(("kind", KIND_OF_PRONOUN[mention.head_lemma]))
            if found is not None:
                merged.merge(found, i)
            continue
        sought, known = keys_of(mention) if mode == "coref" else ([("head", mention.head_lemma)], [("head", mention.head_lemma)])
        found = next((latest[key] for key in sought if key in latest), None)
        if found is not None:
            merged.merge(found, i)
        root = merged.root(i)
        kind, gender = told.get(root, (None, None))
        told[root] = kind, gender = (kind or (mention.type if mention.type in L.ENTITY_TYPES else None),
                                     gender or GENDER.get(name_words(mention.text)[0]))
        latest.update(dict.fromkeys(known, i))
        latest.update(dict.fromkeys((("kind", k) for k in agreeing(kind, gender, mention.plural)), i))
    return [merged.root(i) for i in range(len(mentions))]


def representatives(mentions: list[Mention], roots: list[int]) -> dict[int, int]:
    """By chain: its first longest name, or its first mention if it has no name."""
    best: dict[int, tuple] = {}
    for i, (mention, root) in enumerate(zip(mentions, roots, strict=True)):
        rank = (mention.pronoun, -len(mention.text), i)
        best[root] = min(best.get(root, rank), rank)
    return {root: rank[2] for root, rank in best.items()}


def lines(mentions: list[Mention], mode: str) -> str:
    """A line `(representative:m1|m2)` for each chain: of two mentions or more in the mode `coref`, of any number in `dcoref`."""
    roots = chains(mentions, mode)
    names = representatives(mentions, roots)
    members: dict[int, list[str]] = {}
    for mention, root in zip(mentions, roots, strict=True):
        members.setdefault(root, []).append(mention.text)
    out = []
    for root, texts in members.items():
        if len(texts) >= (2 if mode == "coref" else 1):
            name = mentions[names[root]].text
            others = [t for t in texts if t != name]
            out.append(f"({name}{':' if others else ''}{'|'.join(others)})\n")
    return "".join(out)


def mentions_of(row) -> list[Mention]:
    return [Mention(m["text"], m["head_lemma"], m["pronoun"], m["type"], m["plural"]) for m in row or []]


CHAIN_TYPE = pa.list_(pa.struct([("chain", pa.int64()), ("rep", pa.bool_())]))


def _resolved(mode: str):
    def resolve(rows: pa.Array) -> pa.Array:
        out = []
        for row in rows.to_pylist():
            mentions = mentions_of(row)
            roots = chains(mentions, mode)
            names = representatives(mentions, roots)
            out.append([{"chain": root + 1, "rep": names[root] == i} for i, root in enumerate(roots)])
        return pa.array(out, CHAIN_TYPE)
    return F.arrow_udf(resolve, "array<struct<chain:bigint,rep:boolean>>")


def _printed(modes):
    def results(rows: pa.Array) -> pa.Array:
        return pa.array([[lines(mentions, mode) for mode in modes] for mentions in map(mentions_of, rows.to_pylist())], pa.list_(pa.string()))
    return F.arrow_udf(results, "array<string>")


def in_order(mentions: str, at: str) -> Column:
    """The mentions of a document in one list, from lists for the sentences at the places `at`."""
    sentences = F.filter(F.arrays_zip(F.col(mentions).alias("ms"), F.col(at).alias("at")), lambda s: F.size(s.ms) > 0)
    return F.flatten(F.transform(sentences, lambda s: F.transform(s.ms, lambda m: F.struct(
        s["at"].cast("bigint").alias("sent_idx"), m.b.cast("bigint").alias("begin_tok"), m.e.cast("bigint").alias("end_tok"),
        m.text.alias("text"), m.head_lemma.alias("head_lemma"), m.pronoun.alias("pronoun"), m.type.alias("type"), m.plural.alias("plural")))))


def _flat(docs: DataFrame, keys: list[str], text_col: str, **options) -> DataFrame:
    """Keys and `ms`, the mentions of a document in text order."""
    return analysed(docs, keys, ["mentions"], text_col, sparing=True, **options).select(*keys, held(in_order("mentions", "at")).alias("ms"))


def mentions_table(docs: DataFrame, keys: list[str], mode: str = "coref", text_col: str = "text", **options) -> DataFrame:
    """`chain_id, sent_idx, begin_tok, end_tok, text, is_representative`. A chain's id is the place of its first mention in the
    document, from 1; the representative is the first longest name."""
    rows = _flat(docs, keys, text_col, **options).withColumn("chains", _resolved(mode)("ms"))
    rows = each(rows, keys, F.arrays_zip(F.col("ms").alias("m"), F.col("chains").alias("c")), "place", "x")
    return rows.select(*keys, F.col("x.c.chain").alias("chain_id"), "x.m.sent_idx", "x.m.begin_tok", "x.m.end_tok", "x.m.text",
                       F.col("x.c.rep").alias("is_representative"))


def chain_results(docs: DataFrame, keys: list[str], modes=("coref",), text_col: str = "text", **options) -> DataFrame:
    """`functionality`, keys and `result`, the chain lines of each mode, every document kept."""
    modes = list(modes)
    rows = _flat(docs, keys, text_col, **options).withColumn("results", _printed(modes)("ms"))
    rows = each(rows, keys, "results", "mode", "result")
    return rows.select(F.get(F.array(*map(F.lit, modes)), F.col("mode").cast("int")).alias("functionality"), *keys, "result")

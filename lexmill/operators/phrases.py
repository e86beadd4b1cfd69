"""Dictionaries that are tables, as a column of spans on the row of a document.

Up to TRIE_BYTES of phrases are broadcast as a trie, which one pass over a row's words walks: longest phrase first, then on
from its end. Nothing is shuffled, and the text is analysed once. A larger dictionary stays a table: a bit map of its first
words, whose size follows their number up to MAP_WORDS_MOST, lets most tokens pass by; the others are unfolded to phrases,
which meet the dictionary in an equi-join. What was found comes back by document, in one join.

Both read rules alike: words are parted by blanks, a rule without a word, phrase or type is none, and of two types for one
phrase the alphabetically first one counts. Matching is token-wise and case-sensitive, leftmost then longest.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text
from lexmill.functions.rows import each
from lexmill.operators import tagging

#: Bytes of phrases and types that are sent to every worker; a trie of them takes some eight times as much there.
TRIE_BYTES = 8 << 20
#: Texts that a task holds as Python strings at once.
ROWS = 256
#: Longs of the map of first words, at least and at most: 128 KB and 2 MB.
MAP_WORDS, MAP_WORDS_MOST = 1 << 14, 1 << 18
#: Python's form of the blanks that part words.
PYTHON_BLANK = r"[\s\x1c\x1d\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\xa0]+"
SPAN_TYPE = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32()), ("type", pa.string())]))


def phrase_of(pattern: str | None) -> str:
    """The words of a rule, parted by one blank."""
    return " ".join(w for w in re.split(PYTHON_BLANK, pattern or "") if w)


class Trie:
    """Phrases by their words, in one flat table: a phrase's type, and None for what only begins a longer one. It takes a fraction
    of what nested tables would."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules: list[tuple[str, str]] | None = rules
        self._table: dict[str, str | None] = {}

    def __getstate__(self):
        rules = [x for x in self._table.items() if x[1] is not None] if self.rules is None else self.rules
        return {"rules": rules, "_table": {}}  # workers build it, once each

    @property
    def table(self) -> dict[str, str | None]:
        if self.rules is not None:
            kinds: dict[str, str] = {}
            self._table = {phrase: kinds.setdefault(kind, kind) for phrase, kind in self.rules}
            for phrase in list(self._table):
                at = phrase.find(" ")
                while at >= 0:
                    self._table.setdefault(phrase[:at])
                    at = phrase.find(" ", at + 1)
            self.rules = None
        return self._table

    def spans(self, words: list[str]) -> list[tuple[int, int, str]]:
        table, found, i, n = self.table, [], 0, len(words)
        while i < n:
            phrase, at, best = words[i], i + 1, None
            while phrase in table:
                if table[phrase] is not None:
                    best = (i, at, table[phrase])
                if at == n:
                    break
                phrase, at = f"{phrase} {words[at]}", at + 1
            if best:
                found.append(best)
            i = best[1] if best else i + 1
        return found


def phrase_table(rules: DataFrame) -> DataFrame:
    """`phrase, n, first, type`, one row per phrase."""
    words = F.filter(F.split("pattern", text.BLANK), lambda w: w != "")
    return (rules.select(F.array_join(words, " ").alias("phrase"), F.size(words).alias("n"), F.get(words, F.lit(0)).alias("first"), "type")
            .where("n > 0 AND type IS NOT NULL").groupBy("phrase", "n", "first").agg(F.min("type").alias("type")))


def prepared(rules, trie_bytes: int | None = None):
    """A table of rules as a trie, if it is small enough to be sent to every worker; else, and for lists, what it was."""
    if not isinstance(rules, DataFrame):
        return rules
    phrases = phrase_table(rules)
    size = phrases.agg(F.sum(F.octet_length("phrase") + F.octet_length("type")).alias("bytes")).first().bytes or 0
    return Trie([tuple(r) for r in phrases.select("phrase", "type").collect()]) if size <= (TRIE_BYTES if trie_bytes is None else trie_bytes) else rules


def with_spans(frame: DataFrame, keys: list[str], rules: Trie | DataFrame, name: str) -> DataFrame:
    """Adds the spans of every sentence to a frame with the column `cleaned`."""
    return walked(frame, rules, name) if isinstance(rules, Trie) else joined(frame, keys, rules, name)


def walked(frame: DataFrame, trie: Trie, name: str) -> DataFrame:
    sent = frame.sparkSession.sparkContext.broadcast(trie)

    def walk(cleaned: pa.Array) -> pa.Array:
        known, rows, sentences, ends, found = sent.value, [0], 0, [0], []
        heads = known.table.keys()
        for row in (row for i in range(0, len(cleaned), ROWS) for row in cleaned.slice(i, ROWS).to_pylist()):
            for sentence in row.split(text.SENTENCE_MARK) if row else []:
                words = sentence.split(text.TOKEN_MARK)
                if not heads.isdisjoint(words):
                    found.extend(known.spans(words))
                ends.append(len(found))
                sentences += 1
            rows.append(sentences)
        b, e, kinds = zip(*found, strict=True) if found else ((), (), ())
        spans = pa.StructArray.from_arrays([pa.array(b, pa.int32()), pa.array(e, pa.int32()), pa.array(kinds, pa.string())], ["b", "e", "type"])
        return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans))

    return frame.withColumn(name, F.arrow_udf(walk, f"array<{tagging.SPANS}>")("cleaned"))


def _bit(word: Column, longs: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(longs * 64)).cast("int")


_IN_LONG = "shiftleft(1L, CAST(pmod(xxhash64({0}), 64) AS INT))"


def first_word_map(phrases: DataFrame) -> tuple[Column, int]:
    """An array literal with a bit for each hash of a first word, and its length."""
    words = phrases.agg(F.approx_count_distinct("first").alias("n")).first().n
    longs = min(MAP_WORDS_MOST, max(MAP_WORDS, 1 << (words // 4).bit_length()))
    rows = (phrases.select(F.shiftright(_bit(F.col("first"), longs), 6).alias("word"), F.expr(_IN_LONG.format("first")).alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())  # as many rows as longs, at most
    bits = [0] * longs
    for r in rows:
        bits[r.word] = r.bits
    return F.lit(np.array(bits, np.int64)), longs


def joined(frame: DataFrame, keys: list[str], rules: DataFrame, name: str) -> DataFrame:
    phrases = phrase_table(rules)
    lengths = sorted(phrases.agg(F.collect_set("n").alias("lengths")).first().lengths)  # bounded by the longest rule
    where = [*keys, "sent_idx"]
    known, longs = first_word_map(phrases)
    tokens = each(frame.select(*keys, F.expr(text.sentence_tokens("cleaned")).alias("found")), keys, "found", "sent_idx", "words")
    starts = each(tokens, [*where, "words"], "words", "b", "tok").where(
        F.get(known, F.shiftright(_bit(F.col("tok"), longs), 6)).bitwiseAND(F.expr(_IN_LONG.format("tok"))) != 0)
    starts = starts.withColumn("b", F.col("b").cast("int"))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: F.col("b") + n <= F.size("words"))
    grams = starts.select(*where, "b", "words", F.explode(fitting).alias("n"))
    grams = grams.select(*where, "b", "n", F.array_join(F.slice("words", F.col("b") + 1, F.col("n")), " ").alias("phrase"))
    hits = grams.join(phrases, ["n", "phrase"])  # a frequent phrase is split by Spark: no aggregate binds its rows
    longest = hits.groupBy(*where, "b").agg(F.max_by("type", "n").alias("type"), F.max("n").alias("n"))
    candidates = F.array_sort(F.collect_list(F.struct("b", (F.col("b") + F.col("n")).alias("e"), "type")))
    spans = longest.groupBy(*where).agg(candidates.alias("candidates"))
    spans = spans.select(*where, F.expr(tagging.non_overlapping("candidates")).alias("spans"))
    by_doc = spans.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("sent_idx").cast("int").alias("i"), "spans"))).alias("at"))
    by_doc = by_doc.select(*[F.col(k).alias(f"{k}__of") for k in keys], F.col("at").alias(f"{name}__at"))
    same = [F.col(k).eqNullSafe(F.col(f"{k}__of")) for k in keys]
    both = frame.join(by_doc, reduce(and_, same), "left")
    # A list for each sentence: those that have none fill the places between the others.
    at, none = f"{name}__at", f"CAST(array() AS {tagging.SPANS})"
    before = f"CASE WHEN j = 0 THEN 0 ELSE get({at}, j - 1).i + 1 END"
    filled = (f"concat(flatten(transform({at}, (x, j) -> concat(array_repeat({none}, x.i - {before}), array(x.spans)))), "
              f"array_repeat({none}, n_sentences - 1 - element_at({at}, -1).i))")
    counted = both.withColumn("n_sentences", F.when(F.col("cleaned") == "", 0).otherwise(
        F.length("cleaned") - F.length(F.replace("cleaned", F.lit(text.SENTENCE_MARK), F.lit(""))) + 1))
    return counted.withColumn(name, F.expr(f"CASE WHEN {at} IS NULL THEN array_repeat({none}, n_sentences) ELSE {filled} END")) \
        .select(*frame.columns, name)

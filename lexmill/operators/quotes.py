"""Quotations and their speakers, from the document text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicons as L
from lexmill.functions import text as text_functions
from lexmill.functions.rows import each, held
from lexmill.operators import coreference, documents

_QUOTE = r'("[^"]*"|“[^“”]*”)([^"“]*)'
_NAME = r"\p{Lu}\p{L}+(?: \p{Lu}\p{L}+)*+"
_VERB = "(?:" + "|".join(L.SPEECH_VERBS) + ")"
# The speaker stands right after the quote, as `said Name` or `Name said`, or right before it, as
# `Name said,` or `said Name,`. A name is a run of capitalised words, of any length.
AFTER_VERB = rf"^\s*{_VERB} ({_NAME})"
AFTER_NAME = rf"^\s*({_NAME}) {_VERB}(?:[^\p{{L}}]|$)"
BEFORE_VERB = rf"(?:^|[^\p{{L}}]){_VERB} ({_NAME})[,:]\s*$"
# For `Name said,` the verb at the end is cut off; the name is then read backwards from there, so that a long run of
# capitalised words is looked at once and not from each of its words.
VERB_AT_END = rf"(?s)^(.*) {_VERB}[,:]?\s*$"
NAME_BACKWARDS = r"^(\p{L}+\p{Lu}(?= |$|[^\p{L}])(?: \p{L}+\p{Lu}(?= |$|[^\p{L}]))*+)"


def name_before(text: Column) -> Column:
    said = F.regexp_extract(text, VERB_AT_END, 1)
    return F.reverse(F.regexp_extract(F.reverse(said), NAME_BACKWARDS, 1))


# A pronoun in the place of a name: group 1 is what stands before it, group 2 the pronoun.
_PRONOUN = r"([Hh]e|[Ss]he|[Tt]hey)"
PRONOUNS_AFTER = (rf"^(\s*{_VERB} ){_PRONOUN}(?:[^\p{{L}}]|$)", rf"^(\s*){_PRONOUN} {_VERB}(?:[^\p{{L}}]|$)")
PRONOUN_BEFORE = rf"(?s)^((?:.*[^\p{{L}}])?){_PRONOUN} {_VERB}[,:]?\s*$"
# Marks around a quotation and what follows it; in the text they are read as blanks.
_OPEN, _SHUT, _END = "\x02", "\x03", "\x04"


def _speaker(a: Column, b: Column) -> Column:
    found = [F.regexp_extract(a, AFTER_VERB, 1), F.regexp_extract(a, AFTER_NAME, 1), name_before(b), F.regexp_extract(b, BEFORE_VERB, 1)]
    return F.coalesce(*[F.when(~f.isin("", "He", "She", "They"), f) for f in found], F.lit(""))


def _pronoun_end(x: Column) -> Column:
    """Where in the text the pronoun ends that stands for a speaker, NULL without one."""
    def end(near, pattern, base):
        return F.when(near.rlike(pattern), base + F.length(F.regexp_extract(near, pattern, 1)) + F.length(F.regexp_extract(near, pattern, 2)))
    return F.coalesce(*[end(x.a, pattern, x.upto) for pattern in PRONOUNS_AFTER], end(x.b, PRONOUN_BEFORE, x.since))


def with_quotes(frame: DataFrame, source: str, name: str = "quotes") -> DataFrame:
    """Adds the quotations of a text: `text`, `begin`, `upto`, `speaker` (empty where none is named), `at` (where a pronoun ends
    that stands in the speaker's place, if one does) and `opens` (whether the quotation opens a paragraph)."""
    kept, text = frame.columns, F.col(source)
    for mark in (_OPEN, _SHUT, _END):
        text = F.replace(text, F.lit(mark), F.lit(" "))
    cut = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), _QUOTE, f"{_OPEN}$1{_SHUT}$2{_END}"), _OPEN)
    frame = frame.withColumn("q_pieces", cut)
    rest = F.slice("q_pieces", 2, F.size("q_pieces"))
    frame = frame.withColumn("q_text", F.transform(rest, lambda p: F.substring_index(p, _SHUT, 1)))
    frame = frame.withColumn("q_after", F.transform(rest, lambda p: F.substring_index(F.substring_index(p, _SHUT, -1), _END, 1)))
    # Where each quotation begins: after the piece before the first one, and what the pieces before it take in the text.
    widths = "transform(q_pieces, (p, i) -> CAST(length(p) - CASE WHEN i = 0 THEN 0 ELSE 2 END AS BIGINT))"
    frame = frame.withColumn("q_begin", F.expr(text_functions.running_sum(widths)))
    frame = frame.withColumn("q_upto", F.expr("zip_with(slice(q_begin, 1, size(q_text)), q_text, (b, q) -> b + length(q))"))
    lead = F.regexp_extract(F.get("q_pieces", F.lit(0)), r'^([^"“]*)', 1)
    frame = frame.withColumn("q_before", F.slice(F.concat(F.array(lead), "q_after"), 1, F.size("q_text")))
    frame = frame.withColumn("q_since", F.expr("slice(concat(array(0L), q_upto), 1, size(q_text))"))
    zipped = F.arrays_zip(F.col("q_text").alias("q"), F.col("q_after").alias("a"), F.col("q_before").alias("b"), F.col("q_upto").alias("upto"),
                          F.col("q_since").alias("since"), F.slice("q_begin", 1, F.size("q_text")).alias("begin"))
    named = F.transform(zipped, lambda x: F.struct(
        x.q.alias("text"), x.begin.alias("begin"), x.upto.alias("upto"), _speaker(x.a, x.b).alias("speaker"), _pronoun_end(x).alias("at"), x.b.rlike(r"\n\s*$").alias("opens")))
    settled = F.transform(F.col(name), lambda x: x.withField("at", F.when(x.speaker == "", x.at)))
    return frame.withColumn(name, named).withColumn(name, settled).select(*kept, name)


def spoken(quotes: list[dict], ends: dict[int, str]) -> list[dict]:
    """The speakers of a document's quotations: the name of the chain of a pronoun, by the place where that ends; and in a
    dialogue, where two have spoken in turn, a quotation that opens a paragraph without a speaker is the first one's."""
    out: list[dict] = []
    for quote in quotes:
        speaker = quote["speaker"]
        if quote["at"] is not None:
            speaker = ends.get(quote["at"], "")
        elif not speaker and quote["opens"] and len(out) > 1 and "" != out[-1]["speaker"] != out[-2]["speaker"] != "":
            speaker = out[-2]["speaker"]
        out.append({"text": quote["text"], "speaker": speaker})
    return out


def name_ends(quotes: list[dict], marked: str, row) -> dict[int, str]:
    """For each pronoun whose chain has a name, where it ends in the text and that name. What stands inside a quotation means
    no one outside."""
    wanted = {(m["sent_idx"], m["begin_tok"]) for m in row}
    ends, at, told = {}, 0, 0
    for i, sentence in enumerate(marked.split(text_functions.SENTENCE_MARK)):
        for j, piece in enumerate(sentence.split(text_functions.TOKEN_MARK)):
            at += len(piece)
            if (i, j) in wanted:
                while told < len(quotes) and quotes[told]["upto"] < at:
                    told += 1
                if told == len(quotes) or at <= quotes[told]["begin"]:
                    ends[i, j] = at
    outside = [m for m in row if (m["sent_idx"], m["begin_tok"]) in ends]
    mentions = coreference.mentions_of(outside)
    roots = coreference.chains(mentions, "coref")
    names = coreference.representatives(mentions, roots)
    return {ends[m["sent_idx"], m["begin_tok"]]: mentions[names[root]].text for m, root in zip(outside, roots, strict=True)
            if m["pronoun"] and not mentions[names[root]].pronoun}


QUOTE_TYPE = pa.list_(pa.struct([("text", pa.string()), ("speaker", pa.string())]))


def resolved(docs: DataFrame, keys: list[str], text_col: str = "text", cleanxml: bool = False, **options) -> DataFrame:
    """Keys and `quotes`, a list of `text` and `speaker`. Mentions are sought only in texts where a pronoun stands in a
    speaker's place."""
    source = documents.clean_xml(F.col(text_col)) if cleanxml else F.col(text_col)
    frame = with_quotes(docs.select(*keys, source.alias("q_source")), "q_source")
    frame = frame.withColumn("q_analysed", F.when(F.exists("quotes", lambda q: q.at.isNotNull()), F.col("q_source")))
    frame = documents.layered(documents.marked(frame, [*keys, "quotes"], "q_analysed"), ["mentions"], keys, sparing=True, **options)
    frame = frame.select(*keys, held("quotes").alias("quotes"), "marked", held(coreference.in_order("mentions", "at")).alias("ms"))

    def speakers(quotes: pa.Array, marked: pa.Array, ms: pa.Array) -> pa.Array:
        rows = zip(quotes.to_pylist(), marked.to_pylist(), ms.to_pylist(), strict=True)
        return pa.array([spoken(qs, name_ends(qs, text, row) if row else {}) for qs, text, row in rows], QUOTE_TYPE)

    return frame.select(*keys, F.arrow_udf(speakers, "array<struct<text:string,speaker:string>>")("quotes", "marked", "ms").alias("quotes"))


def quotes_table(docs: DataFrame, keys: list[str], text_col: str = "text", **options) -> DataFrame:
    """`quote_idx, text, speaker`: a name next to the quotation, or the name of the chain of a pronoun there, or whose turn it is."""
    found = each(resolved(docs, keys, text_col, **options), keys, "quotes", "quote_idx", "x")
    return found.select(*keys, "quote_idx", "x.text", "x.speaker")


def quote_results(docs: DataFrame, keys: list[str], text_col: str = "text", **options) -> DataFrame:
    """Keys and `result`: `(text,speaker)` of every quotation, every document kept."""
    printed = F.transform("quotes", lambda q: F.concat(F.lit("("), F.concat_ws(",", q.text, q.speaker), F.lit(")")))
    return resolved(docs, keys, text_col, **options).withColumn("quotes", held("quotes")).select(*keys, F.array_join(printed, " ").alias("result"))

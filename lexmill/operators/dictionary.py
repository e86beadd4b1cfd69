"""Dictionary phrases over tokens, for dictionaries of any size.

A Python list of rules is written into the row-local plan as literal maps; a DataFrame of rules is matched as `phrases` has
it. Both forms read rules alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import lexicons as L
from lexmill.functions.rows import each
from lexmill.operators import phrases, tagging
from lexmill.operators.documents import layered, marked, sentence_rows


def as_rules(rules, trie_bytes: int | None = None):
    """The rules of a list (None: the default ones), one type for each phrase; a table as a trie or as it is."""
    if isinstance(rules, phrases.Trie | DataFrame):
        return phrases.prepared(rules, trie_bytes)
    kinds: dict[str, str] = {}
    for pattern, kind in L.DEFAULT_RULES if rules is None else rules:
        phrase = phrases.phrase_of(pattern)
        if phrase and kind is not None:
            kinds[phrase] = min(kind, kinds.get(phrase, kind))
    return sorted(kinds.items())


def as_gazetteer(gazetteer):
    """None stays None, which is the built-in one."""
    return gazetteer if gazetteer is None else as_rules(gazetteer)


def regexner_table(docs: DataFrame, keys: list[str], rules=None, text_col: str = "text", gazetteer=None,
                   trie_bytes: int | None = None, **options) -> DataFrame:
    """`sent_idx, tok_in_sent, token, ner` after the gazetteer and then the dictionary, either one a list or a table;
    `rules=()` is no dictionary. A dictionary of more than trie_bytes (`phrases.TRIE_BYTES`) is joined."""
    rows = sentence_rows(docs, keys, ["ner"], text_col, rules=as_rules(rules, trie_bytes), gazetteer=as_gazetteer(gazetteer), **options)
    rows = each(rows.select(*keys, "sent_idx", "s.toks", "s.ner"), [*keys, "sent_idx", "ner"], "toks", "tok_in_sent", "token")
    return rows.select(*keys, "sent_idx", "tok_in_sent", "token", F.get("ner", F.col("tok_in_sent").cast("int")).alias("ner"))


def regexner_forms(docs: DataFrame, keys: list[str], forms: dict, text_col: str = "text", gazetteer=None) -> DataFrame:
    """`sent_idx, tok_in_sent, token, ner, form` by several dictionaries, given by name as `as_rules` has them. The text is
    analysed once for all of them."""
    frame, names = marked(docs, keys, text_col), {form: f"form{i}" for i, form in enumerate(forms)}
    for form in sorted(forms, key=lambda f: isinstance(forms[f], phrases.Trie)):  # joins come before Python's columns
        if isinstance(forms[form], phrases.Trie | DataFrame):
            frame = phrases.with_spans(frame, keys, forms[form], f"{names[form]}_spans")
    frame = layered(frame, ["ner"], keys, gazetteer=as_gazetteer(gazetteer))
    for form, rules in forms.items():
        for step in tagging.phrases(names[form], "named", rules if isinstance(rules, list) else None):
            frame = frame.withColumn(step.name, F.expr(step.sql()))
    rows = each(frame, keys, F.arrays_zip("toks", *names.values()), "sent_idx", "s")
    rows = each(rows, [*keys, "sent_idx", "s"], "s.toks", "tok_in_sent", "token")
    at = F.col("tok_in_sent").cast("int")
    tags = F.array(*[F.struct(F.get(f"s.{name}", at).alias("ner"), F.lit(form).alias("form")) for form, name in names.items()])
    return rows.select(*keys, "sent_idx", "tok_in_sent", "token", F.inline(tags))

"""The annotator names, what each one needs, and the check of a request."""

from __future__ import annotations

# The annotators in run order.
CATALOGUE = [
    "tokenize",
    "cleanxml",
    "ssplit",
    "pos",
    "lemma",
    "ner",
    "regexner",
    "sentiment",
    "parse",
    "depparse",
    "dcoref",
    "coref",
    "relation",
    "natlog",
    "quote",
    "openie",
]

# Prerequisites of each annotator, a flat list that is not followed further.
PREREQUISITES = {
    "tokenize": (),
    "cleanxml": ("tokenize",),
    "ssplit": ("tokenize",),
    "pos": ("tokenize", "ssplit"),
    "lemma": ("tokenize", "ssplit", "pos"),
    "ner": ("tokenize", "ssplit", "pos", "lemma"),
    "regexner": ("tokenize", "ssplit", "pos", "lemma", "ner"),
    "sentiment": ("tokenize", "ssplit", "parse"),
    "parse": ("tokenize", "ssplit"),
    "depparse": ("tokenize", "ssplit", "pos"),
    "dcoref": ("tokenize", "ssplit", "pos", "lemma", "ner", "parse"),
    "coref": ("tokenize", "ssplit", "pos", "lemma", "ner", "parse"),
    "relation": ("tokenize", "ssplit", "pos", "lemma", "ner", "parse", "depparse"),
    "natlog": ("tokenize", "ssplit", "pos", "lemma", "parse"),
    "quote": ("tokenize", "ssplit", "pos", "lemma", "ner", "depparse", "coref"),
    "openie": ("tokenize", "ssplit", "pos", "lemma", "depparse", "natlog"),
}


def requested(functionality: str | list[str]) -> list[str]:
    """Names in request order, lower-cased, trimmed, without repeats."""
    parts = functionality.split(",") if isinstance(functionality, str) else functionality
    names = [p.strip().lower() for p in parts]
    return list(dict.fromkeys(n for n in names if n))


def validate(functionality: str | list[str]) -> list[str]:
    """The requested names, or an error for an unknown name or an empty request."""
    names = requested(functionality)
    unknown = [n for n in names if n not in PREREQUISITES]
    if unknown:
        raise ValueError(f"No such functionality: {', '.join(unknown)}")
    if not names:
        raise ValueError("No functionality was requested")
    return names


def resolve(functionality: str | list[str]) -> list[str]:
    """What has to run for a request: catalogue order, each annotator after its prerequisites, no repeats."""
    names = set(validate(functionality))
    plan: dict[str, None] = {}
    for name in CATALOGUE:
        if name in names:
            plan.update(dict.fromkeys([*PREREQUISITES[name], name]))
    return list(plan)

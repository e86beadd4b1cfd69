"""Small helpers to write Spark SQL expressions as text.

Rule tables become long CASE expressions. As text they reach Spark in one call and are parsed
there; built from Column objects the same plan takes thousands of calls from Python."""

from __future__ import annotations


def quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(values) -> str:
    return ", ".join(quote(v) for v in values)


#: Up to so many branches are nested.
NESTED = 24


def case(branches: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    """The value of the first condition that holds. Where no code is generated, as inside a lambda, Spark looks up the branches of
    a CASE in a linked list, from its head for every one; nested IFs have no list."""
    if 0 < len(branches) <= NESTED:
        return "".join(f"IF({c}, {v}, " for c, v in branches) + otherwise + ")" * len(branches)
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {otherwise} END"


def lookup(pairs: dict[str, str], key: str) -> str:
    """The value of a literal map at `key`, or NULL."""
    return f"try_element_at(map({quoted(x for kv in pairs.items() for x in kv)}), {key})"

"""License scans in Spark's own functions: ordered signature rules behind a keyword filter.

Every license gives a few signatures (identifier, statement, tag, address, full name), each a regular expression with a
priority. A signature has its own needs: sets of literals, of each of which every match must contain one. A text is held
against a signature only if it meets them, so that the filter loses no match. Detections are intervals; one that lies in
another of the same or higher priority is suppressed, so that `lesser general public license` is not also `general
public license`. Everything is a column expression: no shuffle, no Python, no state beyond the row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.sqltext import quote

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The base phrases, as words, and their labels.
BASE = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
# Label, keywords (every match of the name has one), identifier, name, address; the last three are regular
# expressions over lower-case text.
LICENSES = (
    ("mit", "mit", r"mit", r"(?:the\s+)?mit", r"opensource\.org/licenses?/mit"),
    ("mit-0", "mit", r"mit-0", r"mit\s+no\s+attribution", r"opensource\.org/licenses?/mit-0"),
    ("apache-1.1", "apache", r"apache-1\.1", r"apache\s+(?:software\s+)?(?:license,?\s+)?(?:version\s+)?1\.1", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", "apache", r"apache-2\.0", r"apache(?:\s+software)?(?:\s+license)?,?\s+(?:version\s+|v\.?\s*)?2(?:\.0)?", r"apache\.org/licenses/license-2\.0"),
    ("bsd-2-clause", "bsd", r"bsd-2-clause", r"(?:2-clause|simplified|freebsd)\s+bsd", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"bsd-3-clause", r"(?:3-clause|new|modified|revised)\s+bsd", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"bsd-4-clause", r"(?:4-clause|original)\s+bsd", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", "bsd", r"0bsd", r"(?:zero-clause|0-clause)\s+bsd", r"opensource\.org/licenses?/0bsd"),
    ("isc", "isc", r"isc", r"isc", r"opensource\.org/licenses?/isc"),
    ("gpl-1.0", "general", r"gpl-1\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?general\s+public\s+license,?\s+(?:version|v)\.?\s*1", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("gpl-2.0", "general", r"gpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?general\s+public\s+license,?\s+(?:version|v)\.?\s*2", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", "general", r"gpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?general\s+public\s+license,?\s+(?:version|v)\.?\s*3", r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl", "gpl", r"gpl", r"(?:gnu\s+)?gpl(?:\s*v?[123])?", r"gnu\.org/(?:copyleft|licenses)/gpl(?:\.html)?"),
    ("lgpl-2.0", "lesser|library", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+license,?\s+(?:version|v)\.?\s*2(?:\.0)?(?!\.?\d)", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0"),
    ("lgpl-2.1", "lesser", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"(?:gnu\s+)?lesser\s+general\s+public\s+license,?\s+(?:version|v)\.?\s*2\.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", "lesser", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?lesser\s+general\s+public\s+license,?\s+(?:version|v)\.?\s*3", r"gnu\.org/licenses/lgpl-3\.0"),
    ("lgpl", "lgpl", r"lgpl", r"(?:gnu\s+)?lgpl(?:\s*v?[23](?:\.1)?)?", r"gnu\.org/(?:copyleft|licenses)/(?:lgpl|lesser)(?:\.html)?"),
    ("agpl-3.0", "affero", r"agpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?affero\s+general\s+public\s+license(?:,?\s+(?:version|v)\.?\s*3)?", r"gnu\.org/licenses/agpl-3\.0"),
    ("agpl", "agpl", r"agpl", r"(?:gnu\s+)?agpl(?:\s*v?3)?", r"gnu\.org/licenses/agpl(?:\.html)?"),
    ("gfdl", "documentation", r"gfdl-1\.[123](?:-only|-or-later)?", r"(?:gnu\s+)?free\s+documentation\s+license", r"gnu\.org/(?:copyleft|licenses)/fdl"),
    ("mpl-1.1", "mozilla", r"mpl-1\.1", r"mozilla\s+public\s+license,?\s+(?:version|v)\.?\s*1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", "mozilla", r"mpl-2\.0", r"mozilla\s+public\s+license(?:,?\s+(?:version|v)\.?\s*2(?:\.0)?)?", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("epl-1.0", "eclipse", r"epl-1\.0", r"eclipse\s+public\s+license(?:,?\s+(?:version|v)\.?\s*1(?:\.0)?)?", r"eclipse\.org/(?:legal|org/documents)/epl-v?10?"),
    ("epl-2.0", "eclipse", r"epl-2\.0", r"eclipse\s+public\s+license,?\s+(?:version|v)\.?\s*2(?:\.0)?", r"eclipse\.org/(?:legal|org/documents)/epl-2\.0"),
    ("edl-1.0", "eclipse", r"edl-1\.0", r"eclipse\s+distribution\s+license", r"eclipse\.org/(?:org/)?documents/edl-v10"),
    ("cddl-1.0", "distribution", r"cddl-1\.0", r"common\s+development\s+and\s+distribution\s+license", r"opensource\.org/licenses?/cddl-1\.0"),
    ("cpl-1.0", "common", r"cpl-1\.0", r"common\s+public\s+license", r"opensource\.org/licenses?/cpl1?-?1\.0"),
    ("eupl-1.2", "european", r"eupl-1\.[12]", r"european\s+union\s+public\s+licen[cs]e", r"joinup\.ec\.europa\.eu/.{0,60}eupl|eupl\.org/"),
    ("artistic-1.0", "artistic", r"artistic-1\.0(?:-perl)?", r"artistic\s+license(?:,?\s+(?:version\s+)?1(?:\.0)?)?", r"opensource\.org/licenses?/artistic-1\.0"),
    ("artistic-2.0", "artistic", r"artistic-2\.0", r"artistic\s+license,?\s+(?:version\s+)?2(?:\.0)?", r"opensource\.org/licenses?/artistic-2\.0"),
    ("bsl-1.0", "boost", r"bsl-1\.0", r"boost\s+software\s+license", r"boost\.org/license_1_0"),
    ("zlib", "zlib", r"zlib", r"zlib(?:/libpng)?", r"opensource\.org/licenses?/zlib"),
    ("libpng", "libpng", r"libpng(?:-2\.0)?", r"libpng", r"libpng\.org/pub/png/src/libpng-license"),
    ("unlicense", "unlicense", r"unlicense", r"(?:the\s+)?unlicense", r"unlicense\.org/"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl", r"wtfpl\.org?/|wtfpl\.net/about\.org/"),
    ("cc0-1.0", "cc0", r"cc0-1\.0", r"cc0(?:\s+1\.0)?(?:\s+universal)?", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by", "cc", r"cc-by-[1-4]\.\d", r"cc[\s-]by(?:\s+[1-4]\.\d)?(?![\w-])", r"creativecommons\.org/licenses/by/[1-4]\.\d"),
    ("cc-by-sa", "cc", r"cc-by-sa-[1-4]\.\d", r"cc[\s-]by-sa(?:\s+[1-4]\.\d)?(?![\w-])", r"creativecommons\.org/licenses/by-sa/[1-4]\.\d"),
    ("cc-by-nc", "cc", r"cc-by-nc-[1-4]\.\d", r"cc[\s-]by-nc(?:\s+[1-4]\.\d)?(?![\w-])", r"creativecommons\.org/licenses/by-nc/[1-4]\.\d"),
    ("cc-by-nd", "cc", r"cc-by-nd-[1-4]\.\d", r"cc[\s-]by-nd(?:\s+[1-4]\.\d)?(?![\w-])", r"creativecommons\.org/licenses/by-nd/[1-4]\.\d"),
    ("cc-by-nc-sa", "cc", r"cc-by-nc-sa-[1-4]\.\d", r"cc[\s-]by-nc-sa(?:\s+[1-4]\.\d)?(?![\w-])", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.\d"),
    ("cc-by-nc-nd", "cc", r"cc-by-nc-nd-[1-4]\.\d", r"cc[\s-]by-nc-nd(?:\s+[1-4]\.\d)?(?![\w-])", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.\d"),
    ("ofl-1.1", "ofl|font", r"ofl-1\.1", r"sil\s+open\s+font\s+license|ofl", r"scripts\.sil\.org/ofl"),
    ("psf-2.0", "python", r"psf-2\.0|python-2\.0", r"python\s+software\s+foundation\s+license|python\s+license", r"docs\.python\.org/.{0,20}license"),
    ("php-3.01", "php", r"php-3\.0?1?", r"php\s+license", r"php\.net/license|php\.org/license"),
    ("ruby", "ruby", r"ruby", r"ruby\s+license", r"ruby-lang\.org/.{0,20}license"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql\s+license", r"postgresql\.org/about/licen[cs]e"),
    ("openssl", "openssl", r"openssl", r"openssl\s+license", r"openssl\.org/source/license"),
    ("ms-pl", "microsoft", r"ms-pl", r"microsoft\s+public\s+license", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", "microsoft", r"ms-rl", r"microsoft\s+reciprocal\s+license", r"opensource\.org/licenses?/ms-rl"),
    ("odbl", "odbl|database", r"odbl-1\.0", r"odbl|open\s+database\s+license", r"opendatacommons\.org/licenses/odbl"),
    ("llama", "llama", r"llama[23](?:\.\d)?", r"llama\s+[23](?:\.\d)?\s+community\s+license", r"llama\.org/license"),
)
UNDER = r"(?:licen[cs]ed|released|distributed|available|published|provided)\s+under\s+(?:the\s+)?(?:terms\s+(?:and\s+conditions\s+)?of\s+(?:the\s+)?)?"
LICENSE = r"\s+licen[cs]e"
NO_MORE = r"(?![\w+-])"


#: The statements' words before a name.
VERBS = ("licensed", "licenced", "released", "distributed", "available", "published", "provided")
#: What every address has one of.
PLACES = (".org/", "php.net/", "joinup.ec.europa.eu/", "wtfpl.or")
#: Licenses whose name can stand without the word license.
BARE = ("apache-1.1", "apache-2.0", "ofl-1.1", "odbl")
Needs = tuple[tuple[str, ...], ...]


def beginnings(pattern: str) -> tuple[str, ...]:
    """For each alternative of a regular expression, the plain characters that all its matches begin with."""
    plain = [re.match(r"(?:(?:\\\.|[a-z0-9/-])(?![?*{]))*", part)[0] for part in re.split(r"\|(?![^(]*\))", pattern)]
    return tuple(x.replace("\\", "") for x in plain)


def signatures() -> list[tuple[str, Needs, str, int]]:
    """(label, needs, regular expression, priority) of every rule, in order."""
    out = []
    for label, keywords, identifier, name, address in LICENSES:
        words, tag = tuple(keywords.split("|")), beginnings(identifier)
        suffix = "" if "licen" in name else LICENSE
        out += [
            (label, (("spdx-license-identifier:",), tag), rf"spdx-license-identifier:\s*(?:{identifier}){NO_MORE}", 4),
            (label, (("under",), VERBS, words), rf"(?:{UNDER})(?:{name})(?:\s+licen[cs]e)?{NO_MORE}", 3),
            (label, (("license", "licence"), tag), rf"\blicen[cs]e\s*[:=]\s*[\"']?(?:{identifier}){NO_MORE}", 3),
            (label, (PLACES, beginnings(address)), rf"(?:{address})", 3),
            (label, (words,) if label in BARE else (("licen",), words), rf"\b(?:{name}){suffix}{NO_MORE}", 2),
        ]
    return out


def lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


NOTHING = "cast(array() AS array<struct<start:int,stop:int,priority:int,label:string>>)"


#: Matches that are folded into one list at a time: appending copies a list, so a long one is put together from blocks.
BLOCK = 256


def detections(text: str, rule: tuple[str, Needs, str, int]) -> str:
    """Where a rule matches the column text: (start, -stop, -priority, label). Places are summed from the lengths of the
    matches and of what lies between them. As SQL text: built of Column objects, some hundred rules take a minute."""
    label, _, pattern, priority = rule
    gaps = f"transform(split({text}, {quote(pattern)}), x -> length(x))"
    sizes = f"transform(regexp_extract_all({text}, {quote(pattern)}, 0), x -> length(x))"
    pairs = f"zip_with({gaps}, {sizes}, (g, s) -> named_struct('g', g, 's', s))"
    found = f"named_struct('start', a.at + z.g, 'stop', -(a.at + z.g + z.s), 'priority', {-priority}, 'label', {quote(label)})"
    block = (f"aggregate(slice(zs, j * {BLOCK} + 1, {BLOCK}), named_struct('at', acc.at, 'found', {NOTHING}), "
             f"(a, z) -> if(z.s IS NULL, a, named_struct('at', a.at + z.g + z.s, 'found', concat(a.found, array({found})))))")
    step = f"get(transform(array({block}), w -> named_struct('at', w.at, 'found', concat(acc.found, array(w.found)))), 0)"
    folded = (f"aggregate(sequence(0, CAST((size(zs) - 1) DIV {BLOCK} AS INT)), named_struct('at', 0, 'found', array({NOTHING})), "
              f"(acc, j) -> {step}, acc -> flatten(acc.found))")
    return f"get(transform(array({pairs}), zs -> {folded}), 0)"


def all_detections(text: str) -> Column:
    """Rules of one first need stand behind it together, and each behind the rest of its needs."""
    def has(words):
        return "(" + " OR ".join(f"contains({text}, {quote(word)})" for word in words) + ")"

    by_need: dict[tuple[str, ...], list] = {}
    for rule in signatures():
        by_need.setdefault(rule[1][0], []).append(rule)
    found = []
    for need, rules in by_need.items():
        by_rest: dict[Needs, list] = {}
        for rule in rules:
            by_rest.setdefault(rule[1][1:], []).append(detections(text, rule))
        parts = [f"concat({', '.join(x)})" if not rest else f"if({' AND '.join(map(has, rest))}, concat({', '.join(x)}), {NOTHING})"
                 for rest, x in by_rest.items()]
        found.append(f"if({has(need)}, concat({', '.join(parts)}), {NOTHING})")
    return F.expr(f"concat({', '.join(found)})")


def unsuppressed(found: Column) -> Column:
    """(labels, best): of detections that lie in no other of the same or higher priority, the labels in order of place,
    and the highest priority. In order of start, longest first, an earlier one that ends no sooner holds a later one."""
    levels = range(1, 5)
    start = F.struct(*[F.lit(-1).alias(f"p{p}") for p in levels], F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"))

    def step(acc, d):
        stop, priority = -d.stop, -d.priority
        held = F.lit(False)
        for p in levels:
            held = held | ((priority == p) & (acc[f"p{p}"] >= stop))
        reach = [F.when(priority >= p, F.greatest(acc[f"p{p}"], stop)).otherwise(acc[f"p{p}"]).alias(f"p{p}") for p in levels]
        return F.struct(
            *reach, F.when(held, acc.labels).otherwise(F.array_union(acc.labels, F.array(d.label))).alias("labels"),
            F.when(held, acc.best).otherwise(F.greatest(acc.best, priority)).alias("best"))
    return F.aggregate(F.array_sort(found), start, step, lambda acc: F.struct(acc.labels.alias("labels"), acc.best.alias("best")))


def base_places(text: Column) -> Column:
    """(word, label) where the words of a base phrase stand one after the other; only texts with `license` are parted."""
    words = F.when(F.contains(text, F.lit("license")), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))) \
        .otherwise(F.array().cast("array<string>"))
    after = [F.slice(words, F.lit(i + 1), F.size(words)) for i in range(3)]
    zipped = F.arrays_zip(*[a.alias(f"w{i}") for i, a in enumerate(after)])

    def label(z):
        out = F.lit(None).cast("string")
        for phrase, name in reversed(BASE):
            stands = F.lit(True)
            for i, word in enumerate(phrase):
                stands = stands & (z[f"w{i}"] == word)
            out = F.when(stands, F.lit(name)).otherwise(out)
        return out
    return F.filter(F.transform(zipped, lambda z, i: F.struct(i.cast("long").alias("word"), label(z).alias("label"))),
                    lambda p: p.label.isNotNull())


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (0 to 1).

    Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters, counted from 0. A null text counts as
    empty: no words, no labels, score 0. score is the best priority of a detection that is not suppressed over 4, at
    least 0.5 where a base phrase stands. Rows stay apart; columns other than the two named are not read."""
    low = docs.select(F.col(doc_id).alias("doc_id"), lower(F.col(text)).alias("low"))
    base, method = F.col("base"), F.col("method")
    found = low.select("doc_id", F.regexp_count("low", F.lit(WORD)).cast("long").alias("n_words"), base_places(F.col("low")).alias("base"),
                       unsuppressed(all_detections("low")).alias("method"))
    labels = F.array_sort(F.array_distinct(base.label))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.get(base, F.lit(0)).word.alias("first_word"),
        F.get(base, F.size(base) - 1).word.alias("last_word"), F.array_join(labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, method.labels)), ",").alias("labels"),
        F.greatest(method.best / 4.0, F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"))

"""Quality by weak supervision.

Rules look at a document and vote for it, against it or abstain. How often each pattern of votes occurs is counted over
all documents (at most 3 to the number of rules patterns, whatever the input's size); expectation-maximisation on those
counts estimates each rule's accuracy on good and on bad documents and the share of good ones; and a document is kept if
the posterior probability that it is good, given its votes, is at least one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import blocks, saved

WINDOW = 8
#: The rules, in order of their votes: a feature over another one (None: alone), whether too much of it is bad, the bound
#: beyond which it votes against, and the one on the other side of which it votes for; else it abstains. Most faults are
#: seen by one rule only, so a rule that sees none says nothing rather than yes.
RULES = (
    ("length", "n_words", None, False, 20, None),
    ("repeats", "n_repeat_words", "n_words", True, 0.30, None),
    ("symbols", "n_symbols", "n_words", True, 0.10, None),
    ("dup_lines", "n_dup_lines", "n_lines", True, 0.50, None),
    ("shouting", "n_upper", "n_letters", True, 0.30, None),
    ("alphabetic", "n_alpha_words", "n_words", False, 0.70, None),
    ("sentences", "n_ends", "n_words", False, 0.002, 0.03),
    ("distinct", "n_distinct", "n_words_root", False, 1.0, 4.0),
)
ROUNDS = 100
#: What is assumed of a vote before any document is seen, as strongly as by as many documents as the rule voted on.
ACCURACY = 0.9
SHARE = 0.8
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_alpha_words", "n_ends", "n_distinct")


def repeated_words(words: list[bytes]) -> int:
    """The words in windows of WINDOW words that stand twice or more in the text. Windows are numbered exactly: pairs of
    numbered pieces of half the length are numbered anew."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    step = 1
    while step < WINDOW:
        ids = np.unique(ids[:-step] * (len(words) + 1) + ids[step:], return_inverse=True)[1]
        step *= 2
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    change = np.zeros(len(words) + 1, np.int64)
    change[:len(twice)] += twice
    change[WINDOW:WINDOW + len(twice)] -= twice
    return int((np.cumsum(change) > 0).sum())


def features(text: str | None) -> tuple[int, ...]:
    data = (text or "").encode()
    words = data.split()  # of bytes: at space and \x09-\x0d alone
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    characters = len(data.translate(None, b" \t\n\r\x0b\x0c").decode())
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(data) - len(data.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    joined = b" ".join(words)
    return (
        len(words), characters, len(data) - len(data.translate(None, b"#*$%&|<>")), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), upper, upper + lower, sum(w[0] > 127 or w[:1].isalpha() for w in words),
        sum(joined.count(x) for x in (b". ", b"! ", b"? ")) + joined.endswith((b".", b"!", b"?")), len(set(words)))


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        rows = [features(t) for t in batch.column(1).to_pylist()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(FEATURES)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *FEATURES])


def vote(rule: tuple) -> F.Column:
    """2 for, 0 against, 1 abstains."""
    _, over, under, above, bad, good = rule
    value = F.col(over) if under is None else F.col(over) / F.greatest(F.lit(1.0), F.sqrt("n_words") if under == "n_words_root" else F.col(under))
    out = F.when(value > bad if above else value < bad, 0)
    return (out if good is None else out.when(value <= good if above else value >= good, 2)).otherwise(1)


def logit(p):
    return np.log(p) - np.log1p(-p)


class LabelModel:
    """How often each vote of each rule is right, and the share of good documents, from counts of vote patterns.

    Votes are independent given what a document is, and an abstention says nothing. A vote that is right with
    probability a moves the log odds of its side by logit(a), less what the share had said already."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], rules: int = len(RULES)):
        votes = np.array([p for p, _ in patterns], np.int64).reshape(-1, rules)
        n = np.array([c for _, c in patterns], np.float64)
        cast = np.stack([(n[:, None] * (votes == v)).sum(axis=0) for v in (0, 2)])
        self.accuracy = np.full((2, rules), ACCURACY)  # of votes against, of votes for
        self.share = SHARE
        for _ in range(ROUNDS if len(n) else 0):
            good = self.posterior(votes)
            right = np.stack([((n * weight)[:, None] * (votes == v)).sum(axis=0) for v, weight in ((0, 1 - good), (2, good))])
            new = np.where(cast > 0, (right + ACCURACY * cast) / np.maximum(1, 2 * cast), ACCURACY).clip(0.01, 0.99)
            moved = abs(new - self.accuracy).max()
            self.accuracy, self.share = new, float(np.clip((n * good).sum() / n.sum(), 0.01, 0.99))
            if moved < 1e-9:
                break

    def weights(self) -> tuple[float, np.ndarray]:
        """The log odds of good before any vote, and what each vote of each rule adds: against, none, for."""
        prior = float(logit(self.share))
        against = np.minimum(0, -logit(self.accuracy[0]) - prior)  # no vote counts for the other side
        supports = np.maximum(0, logit(self.accuracy[1]) - prior)
        return prior, np.stack((against, np.zeros_like(against), supports), axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        prior, added = self.weights()
        return 1 / (1 + np.exp(-(prior + sum(added[i][votes[:, i]] for i in range(votes.shape[1])))))


def rated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the features, votes (an array), quality (the posterior), base_failed and kept, for every row.

    Words are parted by ASCII white space. A null text counts as empty: no words, so it fails. base_failed: under 20
    words, or over 30 % of them in repeated windows; such a row is not kept whatever its posterior. Features are written
    to the shared folder once, since they serve the counts and the ratings."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = saved(rows.mapInArrow(feature_rows, "doc_id long, " + ", ".join(f"{f} long" for f in FEATURES))
                  .withColumn("votes", F.array(*[vote(r) for r in RULES])))
    patterns = found.groupBy("votes").count().collect()  # 3 ** len(RULES) rows at most
    prior, added = LabelModel([(tuple(r.votes), r["count"]) for r in patterns]).weights()
    odds = F.lit(prior)
    for i in range(len(RULES)):
        odds = odds + F.get(F.array(*[F.lit(float(x)) for x in added[i]]), F.get("votes", F.lit(i)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    quality = 1 / (1 + F.exp(-odds))
    return found.select("*", quality.alias("quality"), failed.alias("base_failed"), (~failed & (quality >= 0.5)).alias("kept"))

"""Language identification by script, character trigrams and Viterbi.

Learning counts the trigrams of letters (word borders included, hashed to BUCKETS) and the scripts of every language in
a bounded sample of labelled rows. Prediction scores each word of a text under every language; the scripts of its
letters narrow the languages that may claim it; and Viterbi with a penalty for each switch labels the words, so that a
text in several languages falls into spans. The language with most letters is the prediction, its share the score.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import BLOCK_BYTES, blocks

BUCKETS = 1 << 16
#: About so many labelled rows are learned from, chosen by a hash of their id; all where there are fewer.
SAMPLE_ROWS = 20_000
#: What a switch of language costs, in units of log probability.
SWITCH = 12.0
#: A language uses a script if that many of its letters are of it.
LEAST_SHARE = 0.01
UNKNOWN = "und"
# Unicode script ranges.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
LETTER = re.compile(r"[^\W\d_]")
SPANS = pa.list_(pa.struct({"lang": pa.string(), "start": pa.int32(), "stop": pa.int32()}))


@functools.cache
def scripts() -> np.ndarray:
    """For each code point: 0 for no letter, 1 for a letter of no script above, else 2 and up."""
    out = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)
    for i, ranges in enumerate(SCRIPTS.values(), 2):
        for first, last in ranges:
            out[first:last + 1][out[first:last + 1] > 0] = i
    return out


def unfold(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All letters of a block: their places, their trigrams' buckets and scripts; and where each text begins."""
    lowered = [(x or "").lower() for x in texts]
    points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = 1 + np.concatenate(([0], np.cumsum([len(x) + 1 for x in lowered], dtype=np.int64)))
    kind = scripts()[points]
    plain = np.where(kind > 0, points, np.uint32(32))
    at = np.flatnonzero(kind)
    mixed = plain[at - 1] * np.uint32(0x9E3779B1) ^ plain[at] * np.uint32(0x85EBCA77) ^ plain[at + 1] * np.uint32(0xC2B2AE3D)
    return at, (mixed ^ mixed >> np.uint32(15)) % np.uint32(BUCKETS), kind[at], bounds


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of a task: (lang, bucket, n); scripts are counted as buckets below zero."""
    totals: dict[str, np.ndarray] = {}
    size = len(SCRIPTS) + 2
    for batch in blocks(batches, "text"):
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in set(langs):
            _, buckets, kinds, _ = unfold([t for t, own in zip(batch.column("text").to_pylist(), langs == lang, strict=True) if own])
            sums = totals.setdefault(lang, np.zeros(size + BUCKETS, np.int64))
            sums[:size] += np.bincount(kinds, minlength=size)
            sums[size:] += np.bincount(buckets, minlength=BUCKETS)
    for lang, sums in totals.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at - size), pa.array(sums[at])], ["lang", "bucket", "n"])


class Model:
    """Log probabilities of buckets (a column for each language) and which languages use a script."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in counts})
        size = len(SCRIPTS) + 2
        table = np.zeros((size + BUCKETS, max(1, len(self.langs))))
        place = {lang: i for i, lang in enumerate(self.langs)}
        for lang, bucket, n in counts:
            table[bucket + size, place[lang]] = n
        grams = table[size:] + 0.1
        self.scores = np.log(grams / grams.sum(axis=0)).astype(np.float32)
        uses = table[:size] / np.maximum(1, table[:size].sum(axis=0))
        self.allowed = uses >= LEAST_SHARE
        self.allowed[~self.allowed.any(axis=1)] = True  # of a script that no language uses, any may be


def labels(model: Model, scores: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The best language of every word; scores by word and language, bounds: where each text's words begin. All texts
    step through their words together, longest first, so that those still at it are always the first ones."""
    count = np.diff(bounds)
    order = np.argsort(-count, kind="stable")
    base, count = bounds[:-1][order], count[order]
    stay = np.ones(scores.shape, bool)
    top = np.zeros(len(scores), np.int16)
    live = np.searchsorted(-count, -np.arange(count[0] if len(count) else 0), side="left")
    state = np.zeros((len(order), scores.shape[1]), np.float32)
    for t, n in enumerate(live.tolist()):
        at = base[:n] + t
        now = state[:n]
        if t:
            best = now.argmax(axis=1)
            change = now[np.arange(n), best][:, None] - SWITCH
            top[at] = best
            stay[at] = now >= change
            now = np.maximum(now, change)
        state[:n] = now + scores[at]
    out = np.zeros(len(scores), np.int16)
    current = state.argmax(axis=1)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = base[:n] + t
        lang = current[:n]
        out[at] = lang
        if t:
            current[:n] = np.where(stay[at, lang], lang, top[at])
    return out


def predict_rows(model: Model, text: str, name: str, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text, BLOCK_BYTES // 2):
            texts = batch.column(text).to_pylist()
            out = predict(model, texts, spans)
            kind = pa.struct({"lang_pred": pa.string(), "score": pa.float64(), "spans": SPANS})
            yield batch.set_column(batch.schema.get_field_index(name), name, pa.array(out, kind))
    return run


def predict(model: Model, texts: list[str | None], with_spans: bool) -> list[dict]:
    none = {"lang_pred": UNKNOWN, "score": 0.0, "spans": []}
    at, buckets, kinds, bounds = unfold(texts)
    if not len(at) or not model.langs:
        return [none] * len(texts)
    new = np.concatenate(([True], at[1:] != at[:-1] + 1))
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(at)))
    scores = np.add.reduceat(model.scores[buckets], begins, axis=0)
    allowed = np.logical_or.reduceat(model.allowed[kinds], begins, axis=0)
    scores[~allowed] -= 1e6
    starts = at[begins]
    words = np.searchsorted(starts, bounds)
    lang = labels(model, scores, words)
    doc = np.repeat(np.arange(len(texts)), np.diff(words))
    letters = np.bincount(doc * len(model.langs) + lang, weights=sizes, minlength=len(texts) * len(model.langs)).reshape(len(texts), -1)
    best, total = letters.argmax(axis=1), letters.sum(axis=1)
    out = []
    for i in range(len(texts)):
        if not total[i]:
            out.append(none)
            continue
        spans = []
        if with_spans:
            own = lang[words[i]:words[i + 1]]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1, [len(own)]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                first, last = words[i] + a, words[i] + b - 1
                spans.append({"lang": model.langs[own[a]], "start": int(starts[first] - bounds[i]),
                              "stop": int(starts[last] + sizes[last] - bounds[i])})
        out.append({"lang_pred": model.langs[best[i]], "score": float(letters[i, best[i]] / total[i]), "spans": spans})
    return out


def held_out(doc_id: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """A model of about rows labelled rows that are not held out; its size is that of languages times BUCKETS.

    Rows whose text or lang is null teach nothing. Without any labelled row the model has no language."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(doc_id))
    total = labelled.count()
    part = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 30)) < int((1 << 30) * min(1, rows / max(1, total)))
    counts = (labelled.where(part).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
              .mapInArrow(count_rows, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    return Model([tuple(r) for r in counts.collect()])


def identify(docs: DataFrame, model: Model, text: str = "text", name: str = "language", spans: bool = True) -> DataFrame:
    """The rows with all columns and a column name: lang_pred, score (the share of letters), and, if asked for, spans
    (lang, start, stop in code points of the lower-cased text). A null text or one without a letter is `und`, score 0.
    A column that is called name already is replaced."""
    kind = "struct<lang_pred:string,score:double,spans:array<struct<lang:string,start:int,stop:int>>>"
    frame = docs.withColumn(name, F.lit(None).cast(kind))
    return frame.mapInArrow(predict_rows(model, text, name, spans), frame.schema)

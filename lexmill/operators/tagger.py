"""Taggers learned by counting, for any layer of one tag per token.

A model is a table of counts, made by grouping: how often a tag follows another (`move`), how often a word has a tag
(`word`), and, over words that are rare in the labelled text, how often an ending of up to ENDING characters has a tag
(`end`). From them come the probabilities of a first-order hidden Markov model: moves are interpolated with the tags' own
frequencies, by weights from leave-one-out counts; a word that was never seen gets its tags from its endings, shorter ones
smoothing longer ones. The best path through each sentence is found by Viterbi's algorithm, for many sentences in step.

The first word of a sentence is counted in lower case, since its capital says nothing. Equal scores go to the tag that is
first in the alphabet. Counts up to MODEL_BYTES are broadcast. With a larger lexicon documents are dealt out to blocks, each
block asks for the counts of its distinct words, once for all taggers, and is tagged with what it gets.

Lemmas are learned as edits (cut so many characters, add these) by part of speech and ending, and for whole words.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lexmill.functions import lexicons as L
from lexmill.functions import text
from lexmill.functions.rows import each, held

ENDING = 4
#: Words that are seen more often than this say nothing about the endings of unknown ones.
RARE = 10
#: Longest ending of an edit's context.
EDIT_ENDING = 5
#: Bytes of the counts that are sent to every worker; the model takes some ten times as much there.
MODEL_BYTES = 16 << 20
#: Bytes of text in a block of documents that asks for its own words, and of words in a bucket of a lexicon, about.
BLOCK = 4 << 20
BUCKET = 4 << 20
#: Scores that a task compares at once: as many as stay in a processor's cache.
CELLS = 1 << 18
COUNTS = "kind string, context string, tag string, n bigint"


def labelled(tokens: DataFrame, keys: list[str], tag: str = "tag", order: str = "tok_in_sent") -> DataFrame:
    """From a table of one row per token (keys, sent_idx, order, token and a tag) to rows of `toks` and the tag's column, a
    list of one sentence each, as `train` takes them."""
    words = F.array_sort(F.collect_list(F.struct(order, "token", tag)))
    rows = tokens.groupBy(*keys, "sent_idx").agg(words.alias("words"))
    return rows.select(*keys, F.array(F.transform("words", lambda x: x.token)).alias("toks"), F.array(F.transform("words", lambda x: x[tag])).alias(tag))


def train(rows: DataFrame, tag: str, toks: str = "toks") -> DataFrame:
    """The counts (kind, context, tag, n) of rows with the columns toks and tag, both a list of sentences of one string per
    token. A sentence with a null tag says nothing, nor does a row with a null sentence."""
    some = F.exists(toks, F.isnull) | F.exists(tag, F.isnull)
    zipped = F.transform(F.arrays_zip(F.col(toks).alias("ws"), F.col(tag).alias("ts")), lambda s: F.when(
        (F.size(s.ts) > 0) & ~F.exists(s.ts, F.isnull), F.struct(F.slice(s.ws, 1, F.size(s.ts)).alias("ws"), s.ts.alias("ts"))))
    sentences = rows.select(F.explode_outer(F.when(~some, zipped)).alias("s"))
    # One row per token, and one with the tag '' for the end of a sentence.
    edge = F.array(F.lit(""))
    steps = F.arrays_zip(F.col("s.ws").alias("w"), F.concat("s.ts", edge).alias("tag"), F.concat(edge, "s.ts").alias("before"))
    tokens = each(sentences.select(steps.alias("z")), [], "z", "i", "x").select(
        F.when(F.col("i") == 0, F.lower("x.w")).otherwise(F.col("x.w")).alias("w"), "x.before", "x.tag")
    # Words and moves apart: there are far fewer of either than of both together, so that less is shuffled.
    both = tokens.select("tag", F.explode(F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("context")) for kind, c in (("word", "w"), ("move", "before"))])).alias("x"))
    counts = both.select("x.*", "tag").where("context IS NOT NULL").groupBy("kind", "context", "tag").agg(F.count("*").alias("n"))
    # All tags of a context in a row: with joins instead, Spark would analyse the labels anew for each side.
    seen = counts.groupBy("kind", "context").agg(F.collect_list(F.struct("tag", "n")).alias("seen"), F.sum("n").alias("n_all"))
    low = F.lower("context")
    ending = F.transform(F.sequence(F.lit(0), F.least(F.lit(ENDING), F.length(low))), lambda n: F.struct(
        F.lit("end").alias("kind"), F.concat(shape(F.col("context")), F.right(low, n)).alias("context")))
    itself = F.array(F.struct("kind", "context"))
    places = F.when((F.col("kind") == "word") & (F.col("n_all") <= RARE), F.concat(itself, ending)).otherwise(itself)
    dealt = seen.select("seen", F.explode(places).alias("x")).select("x.*", F.explode("seen").alias("y")).select("kind", "context", "y.*")
    return dealt.groupBy("kind", "context", "tag").agg(F.sum("n").alias("n"))


def shape(word: Column) -> Column:
    """A letter for what a word looks like: digit first, no letter or digit, capital first, other."""
    return F.when(word.rlike(L.DIGIT_FIRST), "d").when(~word.rlike(L.LETTER_OR_DIGIT), "p").when(word.rlike(L.CAPITAL_FIRST), "C").otherwise("l")


def shape_of(word: str) -> str:
    """`shape` in Python."""
    kinds = [category(c) for c in word]
    first = kinds[1:2] if word[:1] == "$" else kinds[:1]
    if first and first[0][0] == "N":
        return "d"
    if not any(kind[0] in "LN" for kind in kinds):
        return "p"
    return "C" if kinds[0] == "Lu" else "l"


class Model:
    """Log probabilities from a table of counts. Without `words` the lexicon comes with each document."""

    def __init__(self, moves, ends, words=None):
        self.tags = sorted({t for _, t, _ in moves if t})
        at = {t: i for i, t in enumerate(self.tags)}
        self.at, n_tags = at, len(self.tags)
        follow = np.zeros((n_tags + 1, n_tags + 1))  # the last row is the begin of a sentence, the last column its end
        for a, b, n in moves:
            follow[at.get(a, n_tags), at.get(b, n_tags)] += n
        total, of_tag, of_last = follow.sum(), follow.sum(axis=0), follow.sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            alone = np.where(follow > 0, (of_tag - 1) / max(total - 1, 1), 0)
            pair = np.where(follow > 0, np.nan_to_num((follow - 1) / (of_last - 1)), 0)
            weight = follow[pair >= alone].sum() / total if total else 1.0
            moved = weight * np.nan_to_num(follow / of_last) + (1 - weight) * of_tag / max(total, 1)
            logs = np.log(moved)
            self.begin, self.end = logs[-1, :-1], logs[:-1, -1]
            self.moves = np.ascontiguousarray(logs[:-1, :-1].T)  # by tag, then by the tag before it
            self.n_tag = of_tag[:-1]
            self.share = self.n_tag / max(self.n_tag.sum(), 1)
            self.log_share, self.log_tag = np.log(self.share), np.log(self.n_tag)
        self.theta = float(np.std(self.share, ddof=1)) if n_tags > 1 else 1.0
        self.ends = self.gathered(ends)
        self.words = None if words is None else self.gathered(words)

    def gathered(self, rows) -> dict[str, list[tuple[int, int]]]:
        out = defaultdict(list)
        for context, tag, n in rows:
            out[context].append((self.at[tag], n))
        return dict(out)

    def unknown(self, word: str) -> np.ndarray:
        """What a word's endings say of its tags, as log P(word | tag) up to a constant."""
        low, kind, share = word.lower(), shape_of(word), self.share
        for n in range(min(ENDING, len(low)) + 1):
            seen = self.ends.get(kind + (low[-n:] if n else ""))
            if seen is None:
                break
            here = np.zeros(len(self.tags))
            for t, count in seen:
                here[t] = count
            here = here / here.sum()
            share = here if n == 0 else (here + self.theta * share) / (1 + self.theta)
        with np.errstate(divide="ignore"):
            return np.log(share) - self.log_share

    def scores(self, word: str, first: bool, words: dict[str, list[tuple[int, int]]]) -> np.ndarray:
        seen = words.get(word.lower() if first else word) or (words.get(word) if first else None)
        if not seen:
            return self.unknown(word.lower() if first else word)
        out = np.full(len(self.tags), -np.inf)
        for t, count in seen:
            out[t] = np.log(count) - self.log_tag[t]
        return out

    def emissions(self, forms: list[tuple[str, bool]], words: dict[str, list[tuple[int, int]]]) -> np.ndarray:
        """`scores` of many words. What is not known is told from a word's shape and ending, once for each of these."""
        out = np.full((len(forms), len(self.tags)), -np.inf)
        rows, tags, counts, by_ending = [], [], [], {}
        for i, (word, first) in enumerate(forms):
            low = word.lower() if first else word
            seen = words.get(low) or (words.get(word) if first else None)
            if seen:
                for t, count in seen:
                    rows.append(i)
                    tags.append(t)
                    counts.append(count)
            else:
                ending = shape_of(low), low.lower()[-ENDING:]
                if ending not in by_ending:
                    by_ending[ending] = self.unknown(low)
                out[i] = by_ending[ending]
        out[rows, tags] = np.log(np.array(counts, float)) - self.log_tag[np.array(tags, np.int64)]
        return out

    def paths(self, sentences: list[list[str]]) -> list[list[str]]:
        """The best tags of each sentence."""
        ends = np.cumsum([0] + [len(words) for words in sentences])
        found = [self.tags[t] for t in self.tagged(pa.array([w for words in sentences for w in words], pa.string()), ends, self.words)]
        return [found[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def tagged(self, tokens: pa.Array, ends: np.ndarray, words: dict[str, list[tuple[int, int]]]) -> np.ndarray:
        """The best tag of every token, by its number; sentence i is the tokens from ends[i] to ends[i + 1]. A word is scored
        once, and once more as the first one."""
        out = np.zeros(len(tokens), np.int64)
        lengths = np.diff(ends)
        order = np.argsort(-lengths, kind="stable")[:int((lengths > 0).sum())]
        if not len(order):
            return out
        starts, lengths = ends[:-1][order], lengths[order]
        coded = tokens.dictionary_encode()
        forms, keys = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64) * 2
        keys[starts] += 1
        used = np.zeros(2 * len(forms), bool)
        used[keys] = True
        rows = (np.cumsum(used) - 1)[keys]
        emitted = self.emissions([(forms[k >> 1], bool(k & 1)) for k in np.flatnonzero(used).tolist()], words)
        width = max(1, CELLS // max(1, len(self.tags) ** 2))
        for at in range(0, len(order), width):
            self.best(emitted, rows, starts[at:at + width], lengths[at:at + width], out)
        return out

    def best(self, emitted: np.ndarray, rows: np.ndarray, starts: np.ndarray, lengths: np.ndarray, out: np.ndarray) -> None:
        """Viterbi over sentences in step, the longest first, so that those that go on are always the first ones."""
        longest = int(lengths[0])
        score = self.begin + emitted[rows[starts]]
        back = [None]
        for t in range(1, longest):
            n = int(np.searchsorted(-lengths, -t, side="left"))  # sentences of more than t words
            step = score[:n, None, :] + self.moves
            before = step.argmax(axis=2)
            score[:n] = np.take_along_axis(step, before[:, :, None], 2)[:, :, 0] + emitted[rows[starts[:n] + t]]
            back.append(before.astype(np.int16))
        now = (score + self.end).argmax(axis=1)
        out[starts + lengths - 1] = now
        for t in range(longest - 1, 0, -1):
            n = len(back[t])
            now[:n] = back[t][np.arange(n), now[:n]]
            out[starts[:n] + t - 1] = now[:n]


class Tagger:
    """A model that is ready to be sent, and its lexicon as a table where that is too large to be."""

    def __init__(self, model: Model, lexicon: DataFrame | None, size: int = 0):
        self.model, self.lexicon, self.size = model, lexicon, size


def tagger(counts: DataFrame, model_bytes: int | None = None) -> Tagger:
    """From the counts of `train`, read from where they were written or as they are. Moves and endings are bounded by the
    tags and the alphabet and always sent; words are sent up to model_bytes (MODEL_BYTES)."""
    small = counts.where("kind != 'word'").collect()
    words = counts.where("kind = 'word'").select("context", "tag", "n")
    size = words.agg(F.sum(F.octet_length("context") + F.octet_length("tag") + 8).alias("bytes")).first().bytes or 0
    fits = size <= (MODEL_BYTES if model_bytes is None else model_bytes)
    if not any(r.kind == "move" for r in small):
        raise ValueError("there is no labelled sentence to learn from")
    model = Model([(r.context, r.tag, r.n) for r in small if r.kind == "move"], [(r.context, r.tag, r.n) for r in small if r.kind == "end"],
                  [tuple(r) for r in words.collect()] if fits else None)
    return Tagger(model, None if fits else words, size)


def _tokens(cleaned: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All tokens of a batch, where each sentence ends among the tokens, and each document among the sentences; both from 0."""
    empty = pc.fill_null(pc.equal(cleaned, ""), True)
    texts = pc.split_pattern(cleaned.filter(pc.invert(empty)), text.SENTENCE_MARK)
    n_sentences = np.zeros(len(cleaned), np.int64)
    n_sentences[~empty.to_numpy(zero_copy_only=False)] = texts.value_lengths().to_numpy()
    words = pc.split_pattern(texts.flatten(), text.TOKEN_MARK)
    return words.flatten(), _ends(words.value_lengths().to_numpy()), _ends(n_sentences)


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _nested(values: pa.Array, by_sentence: np.ndarray, by_document: np.ndarray) -> pa.Array:
    inner = pa.ListArray.from_arrays(pa.array(by_sentence, pa.int32()), values)
    return pa.ListArray.from_arrays(pa.array(by_document, pa.int32()), inner)


def with_tags(frame: DataFrame, keys: list[str], tagger: Tagger, name: str) -> DataFrame:
    """Adds the learned tags, a list for each sentence, to a frame with the column `cleaned`."""
    return with_all_tags(frame, keys, {name: tagger})


def with_all_tags(frame: DataFrame, keys: list[str], taggers: dict[str, Tagger]) -> DataFrame:
    """`with_tags` for several taggers by name; those with a large lexicon go together."""
    large = {name: tagger for name, tagger in taggers.items() if tagger.lexicon is not None}
    if large:
        frame = _tagged_by_blocks(frame, keys, large)
    for name, tagger in taggers.items():
        if name not in large:
            frame = frame.withColumn(name, F.arrow_udf(_tag_by_sent(frame, tagger), "array<array<string>>")("cleaned"))
    return frame


def _tags(model: Model, tokens: pa.Array, by_sentence: np.ndarray, by_document: np.ndarray, words: dict) -> pa.Array:
    return _nested(pa.array(model.tags, pa.string()).take(pa.array(model.tagged(tokens, by_sentence, words))), by_sentence, by_document)


def _tag_by_sent(frame: DataFrame, tagger: Tagger):
    sent = frame.sparkSession.sparkContext.broadcast(tagger.model)

    def tag(cleaned: pa.Array) -> pa.Array:
        return _tags(sent.value, *_tokens(cleaned), sent.value.words)
    return tag


def _packed(words: Iterable[str]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress("".join([w + text.TOKEN_MARK for w in words]).encode())


def _unpacked(data: bytes) -> list[str]:
    return zstandard.ZstdDecompressor().decompress(data).decode().split(text.TOKEN_MARK)[:-1]


def _tagged_by_blocks(frame: DataFrame, keys: list[str], taggers: dict[str, Tagger]) -> DataFrame:
    """Documents are dealt out once, by their keys; the distinct words of a block go to the lexicons' buckets, and the
    counts of those that are known come back, packed."""
    total = frame.agg(F.sum(F.octet_length("cleaned")).alias("n")).first().n or 0
    blocks = max(1, math.ceil(total / BLOCK))
    buckets = max(1, math.ceil((total // 8 + sum(tagger.size for tagger in taggers.values())) / BUCKET))
    names = list(taggers)
    sent = frame.sparkSession.sparkContext.broadcast([tagger.model for tagger in taggers.values()])

    def ask(key: tuple, docs: pa.Table) -> pa.Table:
        tokens, by_sentence, _ = _tokens(docs.column("cleaned").combine_chunks())
        first = tokens.take(pa.array(by_sentence[:-1][np.diff(by_sentence) > 0]))
        dealt = defaultdict(list)
        for word in sorted({*tokens.unique().to_pylist(), *(w.lower() for w in first.unique().to_pylist())}):
            dealt[zlib.crc32(word.encode()) % buckets].append(word)
        return pa.table({"block": pa.array([key[0].as_py()] * len(dealt), pa.int64()), "bucket": pa.array(dealt, pa.int64()),
                         "words": pa.array(map(_packed, dealt.values()), pa.binary())})

    def answer(asked: pa.Table, lexicon: pa.Table) -> pa.Table:
        counts = [defaultdict(list) for _ in names]
        for which, word, tag, n in zip(*(lexicon.column(c).to_pylist() for c in ("which", "context", "tag", "n")), strict=True):
            counts[which][word].append(f"{sent.value[which].at[tag]} {n}")
        # of a word: for each tagger, parted by ';', its tags and counts, parted by ','
        seen = {word: ";".join([",".join(of.get(word, ())) for of in counts]) for word in set().union(*counts)}
        known = [[w for w in _unpacked(words) if w in seen] for words in asked.column("words").to_pylist()]
        return pa.table({"block": asked.column("block"), "words": pa.array(map(_packed, known), pa.binary()),
                         "seen": pa.array([_packed([seen[w] for w in words]) for words in known], pa.binary())})

    def tag(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        words, read = [{} for _ in names], {}
        for some, seen in zip(answers.column("words").to_pylist(), answers.column("seen").to_pylist(), strict=True):
            for word, counts in zip(_unpacked(some), _unpacked(seen), strict=True):
                if counts not in read:
                    read[counts] = [[tuple(map(int, x.split())) for x in part.split(",") if x] for part in counts.split(";")]
                for own, pairs in zip(words, read[counts], strict=True):
                    if pairs:
                        own[word] = pairs
        docs = docs.drop_columns([block]).combine_chunks()
        place = _tokens(docs.column("cleaned").combine_chunks())
        for name, model, own in zip(names, sent.value, words, strict=True):
            docs = docs.append_column(name, _tags(model, *place, own))
        return docs

    block = "block"
    while block in frame.columns:
        block += "_"
    kind = ArrayType(ArrayType(StringType()))
    schema = StructType([*frame.schema.fields, *(StructField(name, kind) for name in names)])
    by_block = frame.withColumn(block, F.pmod(F.xxhash64(*keys), F.lit(blocks))).groupBy(block)
    asked = by_block.applyInArrow(ask, "block long, bucket long, words binary")
    lexicon = reduce(DataFrame.unionByName, [tagger.lexicon.select(F.lit(i).alias("which"), "context", "tag", "n") for i, tagger in enumerate(taggers.values())])
    lexicon = lexicon.withColumn("bucket", F.pmod(F.crc32("context"), F.lit(buckets)))
    answered = asked.groupBy("bucket").cogroup(lexicon.groupBy("bucket")).applyInArrow(answer, "block long, words binary, seen binary")
    return by_block.cogroup(answered.groupBy("block")).applyInArrow(tag, schema)


def train_lemmas(rows: DataFrame) -> DataFrame:
    """The counts (kind `edit`, context, tag, n) of rows with `toks`, `pos` and `lems`: edits by part of speech and ending, the
    whole word as one too."""
    sentences = rows.select(F.explode_outer(F.arrays_zip("toks", "pos", "lems")).alias("s"))
    tokens = each(sentences.select(F.arrays_zip("s.toks", "s.pos", "s.lems").alias("z")), [], "z", "i", "x")
    seen = tokens.select(F.lower("x.toks").alias("w"), F.col("x.pos").alias("t"), F.lower("x.lems").alias("l")).where(
        "w IS NOT NULL AND t IS NOT NULL AND l IS NOT NULL")
    words = seen.groupBy("w", "t", "l").agg(F.count("*").alias("n"))
    same = F.expr("size(filter(sequence(0, least(length(w), length(l))), k -> left(w, k) = left(l, k))) - 1")
    edit = F.concat((F.length("w") - F.col("same")).cast("string"), F.lit(":"), F.expr("substr(l, same + 1)"))
    contexts = F.expr(f"concat(transform(sequence(0, least({EDIT_ENDING}, length(w))), k -> concat(t, ' ', right(w, k))), array(concat(t, '=', w)))")
    edits = words.withColumn("same", same).select(F.explode(contexts).alias("context"), edit.alias("tag"), "n")
    return edits.groupBy("context", "tag").agg(F.sum("n").alias("n")).select(F.lit("edit").alias("kind"), "context", "tag", "n")


class Lemmatizer:
    """The most frequent edit of each context, the alphabetically first of equals."""

    def __init__(self, edits: dict[str, str]):
        self.edits = {context: (int(edit.split(":", 1)[0]), edit.split(":", 1)[1]) for context, edit in edits.items()}

    def lemma(self, word: str, tag: str) -> str:
        low = word.lower()
        tried = [f"{tag}={low}", *(f"{tag} {low[len(low) - n:]}" for n in range(min(EDIT_ENDING, len(low)), -1, -1))]
        for context in tried:
            if context in self.edits and self.edits[context][0] <= len(low):
                cut, add = self.edits[context]
                low = low[:len(low) - cut] + add
                break
        return word if tag.startswith("NNP") and low == word.lower() else low


def lemmatizer(counts: DataFrame, model_bytes: int | None = None) -> Lemmatizer:
    """From the counts of `train_lemmas`. A context whose edit is that of the next shorter ending adds nothing and is left out,
    so that what is sent grows with the exceptions; more than model_bytes (MODEL_BYTES) of them is an error."""
    # the same filter as the join adds, so that what is shuffled is shuffled once
    best = counts.where("context IS NOT NULL").groupBy("context").agg(F.min_by("tag", F.struct(-F.col("n"), "tag")).alias("tag"))
    word = F.expr("substr(context, length(kind_) + 2)")
    shorter = F.when(F.col("whole"), F.expr(f"right(word, {EDIT_ENDING})")).when(F.length("word") > 0, F.expr("substr(word, 2)"))
    parts = best.withColumn("kind_", F.regexp_extract("context", "^[^ =]*", 0)).withColumn("whole", F.expr("substr(context, length(kind_) + 1, 1) = '='"))
    parts = parts.withColumn("word", word).withColumn("shorter", F.concat("kind_", F.lit(" "), shorter)).select("context", "tag", "shorter")
    of_shorter = best.select(F.col("context").alias("shorter"), F.col("tag").alias("of_shorter"))
    kept = parts.join(of_shorter, "shorter", "left").where("NOT tag <=> of_shorter").select("context", "tag").persist()
    try:
        size = kept.agg(F.sum(F.octet_length("context") + F.octet_length("tag")).alias("bytes")).first().bytes or 0
        if size > (MODEL_BYTES if model_bytes is None else model_bytes):
            raise ValueError(f"{size} bytes of edits are too many to be sent")
        return Lemmatizer(dict(map(tuple, kept.collect())))
    finally:
        kept.unpersist()


def with_lemmas(frame: DataFrame, lemmatizer: Lemmatizer, name: str = "lems") -> DataFrame:
    """Adds learned lemmas to a frame with the columns `cleaned` and `pos`."""
    sent = frame.sparkSession.sparkContext.broadcast(lemmatizer)

    def lemmas(cleaned: pa.Array, pos: pa.Array) -> pa.Array:
        tokens, by_sentence, by_document = _tokens(cleaned)
        words, tags = tokens.dictionary_encode(), pos.flatten().flatten().dictionary_encode()
        forms, kinds, n = words.dictionary.to_pylist(), tags.dictionary.to_pylist(), max(1, len(tags.dictionary))
        pairs = pa.array(words.indices.to_numpy().astype(np.int64) * n + tags.indices.to_numpy()).dictionary_encode()
        edit = sent.value.lemma  # once for each word and tag of a batch
        found = pa.array([edit(forms[k // n], kinds[k % n]) for k in pairs.dictionary.to_pylist()], pa.string())
        return _nested(found.take(pairs.indices), by_sentence, by_document)

    return frame.withColumn("pos", held("pos")).withColumn(name, F.arrow_udf(lemmas, "array<array<string>>")("cleaned", "pos"))

"""Against the tokenizers library itself, text by text."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexmill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
BLANKS = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0    　​"
ODD = ["", "   ", "<|endoftext|>", "a<|endoftext|>b<|endo", "'re 's''ve", "x" * 5000, "ab" * 3000, " " * 3000, "日本語" * 1500,
       BLANKS * 200, None, "word " * 20_000]


def same(got, pairs):
    library = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in pairs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    def order(r):
        return repr(r[0]), r[1], r[3]
    have = [(r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in got.collect()]
    assert sorted(have, key=order) == sorted(want, key=order)


@pytest.mark.parametrize("bits", [9, 4])
def test_odd_texts(rows, rng, bits):
    parts = [*BLANKS, "a", "B", "1", "é", "日", "'s", "'", "<|endoftext|>", "!!", "hello ", " world"]
    mixed = ["".join(rng.choices(parts, k=rng.randrange(400))) for _ in range(100)]
    pairs = [*enumerate(ODD + mixed), (None, "x y"), (None, "x y"), (3, ODD[3])]
    same(bpe.encoded(rows(pairs), PATH, bits=bits), pairs)


def test_shared_passages_are_encoded_once(rows, rng):
    passage = " ".join("".join(rng.choices("abcdefg", k=6)) for _ in range(2000))
    pairs = [(i, f"start {i} {passage} end {i}") for i in range(6)]
    same(bpe.encoded(rows(pairs), PATH), pairs)


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encoded(docs, PATH).count() == 0
    docs = spark.createDataFrame([(1, "a b", "k", b"p")], "n bigint, body string, key string, packed binary")
    [row] = bpe.encoded(docs, PATH, "n", "body").mapInArrow(
        bpe.digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string").collect()
    ids = np.array([64, 275], "<u4").tobytes()
    assert row == (1, 2, hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"a b").hexdigest())

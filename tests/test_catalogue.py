import pytest

from lexmill import resolve, validate
from lexmill.plans.catalogue import CATALOGUE, PREREQUISITES


@pytest.mark.parametrize("request_, plan", [
    ("pos,ner", "tokenize,ssplit,pos,lemma,ner"),
    ("ner,pos", "tokenize,ssplit,pos,lemma,ner"),
    ("POS, ner", "tokenize,ssplit,pos,lemma,ner"),
    ("pos,pos", "tokenize,ssplit,pos"),
    ("tokenize", "tokenize"),
    ("openie", "tokenize,ssplit,pos,lemma,depparse,natlog,openie"),
    ("natlog", "tokenize,ssplit,pos,lemma,parse,natlog"),
    ("quote", "tokenize,ssplit,pos,lemma,ner,depparse,coref,quote"),
    ("sentiment,cleanxml", "tokenize,cleanxml,ssplit,parse,sentiment"),
])
def test_resolve(request_, plan):
    assert resolve(request_) == plan.split(",")


def test_request_order_is_kept():
    assert validate("ner, TOKENIZE,ner") == ["ner", "tokenize"]


@pytest.mark.parametrize("bad", ["bogus", "pos,bogus", "", " , "])
def test_bad_request(bad):
    with pytest.raises(ValueError):
        validate(bad)


def test_every_name_has_prerequisites_in_the_catalogue():
    assert set(PREREQUISITES) == set(CATALOGUE)
    assert all(set(p) <= set(CATALOGUE) for p in PREREQUISITES.values())

"""Who speaks: names next to a quotation, pronouns through chains, turns in a dialogue."""

import pytest

from lexmill import annotate
from lexmill.operators import quotes


@pytest.mark.parametrize("text, speakers", [
    ('Marie Curie spoke. "It works," she said, and Albert Einstein rose. "Why?" he asked.', ["Marie Curie", "Albert Einstein"]),
    ('Angela Merkel met Barack Obama. She added: "Well." Then he said: "So."', ["Angela Merkel", "Barack Obama"]),
    ('"One," said Barack Obama.\n"Two," Angela Merkel replied.\n"Three."\n"Four."', ["Barack Obama", "Angela Merkel", "Barack Obama", "Angela Merkel"]),
    ('"One," said Barack Obama. "Two." "Three," said Angela Merkel.', ["Barack Obama", "", "Angela Merkel"]),
    ('"Nobody," he said.', [""]),
    ('Odd ” mark. Marie Curie came. “Good Tom,” she said. "Bad Ann" he said', ["Marie Curie", ""]),
    ("  \n Marie Curie\x02 came.\t\x03 \"A\x04b\" she says", ["Marie Curie"]),
])
def test_speakers(docs, text, speakers):
    rows = quotes.quotes_table(docs(text), ["doc_id"]).orderBy("quote_idx").collect()
    assert [r.speaker for r in rows] == speakers
    assert annotate(docs(text), "quote").first().result == " ".join(f"({r.text},{r.speaker})" for r in rows)


def test_empty_and_long_texts(docs):
    many = 'Marie Curie came. ' + '"Yes," she said. ' * 3000
    rows = quotes.quotes_table(docs("", None, "no quote", many, '"' * 10001), ["doc_id"]).collect()
    assert [r.speaker for r in rows if r.doc_id == 3] == ["Marie Curie"] * 3000
    assert sum(r.doc_id == 4 for r in rows) == 5000
    assert {r.result for r in annotate(docs("", None, "no quote"), "quote").collect()} == {""}


def test_turns_of_two():
    def quote(speaker, opens=True, at=None):
        return {"text": "x", "speaker": speaker, "at": at, "opens": opens}
    found = quotes.spoken([quote("A"), quote(""), quote("B"), quote("A"), quote(""), quote("", False), quote("C"), quote("", at=5), quote("", at=9)], {5: "D"})
    assert [q["speaker"] for q in found] == ["A", "", "B", "A", "B", "", "C", "D", ""]

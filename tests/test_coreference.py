"""Chains by hand, and against links that are sought among all earlier mentions."""

import random

import pytest

from lexmill import annotate
from lexmill.operators import coreference
from lexmill.operators.coreference import Mention


def name(text, kind="MISC", plural=False):
    return Mention(text, text.split()[-1].lower(), False, kind, plural)


def pronoun(word):
    return Mention(word, word.lower(), True, "O", False)


@pytest.mark.parametrize("mentions, roots", [
    ([name("The Red House"), name("Red House"), name("the Red House")], [0, 0, 0]),
    ([name("United Nations", "ORGANIZATION"), name("UN"), name("the U.N.")], [0, 0, 0]),
    ([name("UN"), name("United Nations"), name("Uncle Ned")], [0, 0, 0]),
    ([name("John Smith"), name("Ann Smith"), name("Smith"), name("John Q Smith"), name("John")], [0, 1, 1, 0, 4]),
    ([name("Ann Ray", "PERSON"), name("Ann"), name("Ray")], [0, 0, 0]),
    ([name("Ray"), name("Ann Ray")], [0, 1]),
    ([name("Mary Lee"), name("John Lee"), pronoun("she"), pronoun("He"), pronoun("its")], [0, 1, 0, 1, 1]),
    ([name("Ann Ray", "PERSON"), name("Berlin", "LOCATION"), pronoun("he"), pronoun("her"), pronoun("its"), pronoun("they")], [0, 1, 2, 0, 1, 5]),
    ([name("Bank", "ORGANIZATION"), name("Zed Foo"), pronoun("their"), pronoun("him")], [0, 1, 0, 1]),
    ([pronoun("he"), name("Tom"), pronoun("he")], [0, 1, 1]),
    ([name("The"), name("A")], [0, 1]),
])
def test_sieves(mentions, roots):
    assert coreference.chains(mentions, "coref") == roots


def test_heads():
    mentions = [name("John Smith"), name("the old Smith"), pronoun("he"), name("Smithson")]
    assert coreference.chains(mentions, "dcoref") == [0, 0, 0, 3]


def test_links_among_all_earlier_mentions():
    """The nearest earlier mention by the first sieve that fits, found by looking at all of them."""
    rng = random.Random(11)
    words = ["Ann", "Bob", "Ray", "Lee", "Red", "House"]

    def link(i, mentions, roots):
        m = mentions[i]
        ws = coreference.name_words(m.text)

        def fits(o, sieve):
            vs = coreference.name_words(o.text)
            initials = [("".join(x[0] for x in xs) if len(xs) > 1 else None) for xs in (ws, vs)]
            letters = [xs[0] if len(xs) == 1 and len(xs[0]) > 1 and xs[0].isupper() else None for xs in (ws, vs)]
            return [ws == vs, (letters[0] and letters[0] == initials[1]) or (letters[1] and letters[1] == initials[0]),
                    len(ws) > 1 < len(vs) and (ws[0], ws[-1]) == (vs[0], vs[-1]), len(ws) == 1 < len(vs) and ws[0] == vs[-1],
                    len(ws) == 1 < len(vs) and ws[0] == vs[0] and o.type == "PERSON"][sieve]
        if m.pronoun:
            kind = coreference.KIND_OF_PRONOUN[m.head_lemma]

            def agrees(j):
                chain = [mentions[x] for x in range(j + 1) if roots[x] == roots[j] and not mentions[x].pronoun]
                types = [x.type for x in chain if x.type in ("PERSON", "LOCATION", "ORGANIZATION")]
                genders = [g for x in chain if (g := coreference.GENDER.get(coreference.name_words(x.text)[0]))]
                return kind in coreference.agreeing((types or [None])[0], (genders or [None])[0], mentions[j].plural)
            return next((j for j in range(i - 1, -1, -1) if not mentions[j].pronoun and agrees(j)), None)
        return next((j for s in range(5) for j in range(i - 1, -1, -1) if not mentions[j].pronoun and fits(mentions[j], s)), None)

    for _ in range(300):
        mentions = []
        for _ in range(rng.randrange(1, 14)):
            kind = rng.choice(["PERSON", "LOCATION", "ORGANIZATION", "MISC"])
            mentions.append(pronoun(rng.choice(["he", "she", "they", "its"])) if rng.random() < 0.25 else
                            name(rng.choice(["AR", "BL", "RH"]) if rng.random() < 0.2 else " ".join(rng.choices(words, k=rng.randrange(1, 4))), kind, rng.random() < 0.2))
        roots = list(range(len(mentions)))
        for i in range(len(mentions)):
            found = link(i, mentions, roots)
            roots[i] = i if found is None else roots[found]
        assert coreference.chains(mentions, "coref") == roots


def test_linear_in_the_mentions():
    import time
    mentions = [name(f"Ann Ray{i % 5000}") if i % 3 else pronoun("she") for i in range(300_000)]
    start = time.perf_counter()
    assert len(set(coreference.chains(mentions, "coref"))) == 5001
    assert time.perf_counter() - start < 30


def test_chains_of_a_text(docs):
    text = ("It was Marie Curie who met Albert Einstein. She thanked him. The World Bank paid. Their money left Paris, "
            "and Curie left its towers, and Einstein laughed.")
    got = annotate(docs(text), "coref").first().result
    assert got == "(Marie Curie:She|Curie)\n(Albert Einstein:him|Einstein)\n(The World Bank:Their)\n(Paris:its)\n"

"""Short English documents added to the corpus of the checks, whose own text is mostly invented words."""

# (doc_id, text); negative ids do not meet those of the table.
ROWS = [
    (-1, "The quick brown dogs are running. They did not stop!"),
    (-2, "Don't say John's dog can't run."),
    (-3, ""),
    (-4, "   "),
    (-5, "<p>Hello <b>big</b> world</p><!-- x -->"),
    (-6, "She holds a Bachelor of Arts and a Bachelor of Laws."),
    (-7, "They met the Bachelor of"),
    (-8, "Barack Obama paid $5.20, 10% more, in New York."),
    (-9, "Barack Obama spoke. He left. Barack Obama returned."),
    (-10, "New York grew. New York shrank."),
    (-11, "Barack Obama works for Harvard University. Later Marie Curie lived in Paris."),
    (-12, '"We won," said Barack Obama. "Nobody knows."'),
    (-13, "No dog has never eaten. Every cat sleeps. Most of the dogs ran without food."),
    (-14, "A good, great day. A pathetic, stupid day. It is not good."),
    (-15, " ".join(["word"] * 99) + "."),
    (-16, "No " + " ".join(["word"] * 99) + ". Short end."),
    (-17, "“Yes.” she said. (It is so.) Mr. Smith of the U.S. paid 3.14 at a@b.com or https://x.y/z?q now... ok?!"),
    (-18, "The United Nations is based in New York City. Paris, in France, is big. The dog's owner fed it."),
    (-19, "John Smith saw the big Red House. The dogs stopped. He saw his old friend Angela Merkel in Berlin."),
    (-20, "Angela Merkel wrote \"No.\" The dog said \"Woof\" and Marie Curie replied \"Why?\" Tom Lee said: \"Go\""),
]
ROWS += [
    (-21, "Barack Obama and Angela Merkel work for Harvard University and the United Nations, but Marie Curie lives in Paris."),
    (-22, "In Berlin Angela Merkel lived in Germany, in Europe, and worked for the World Bank. Oxford University, based in Oxford, worked."),
]
ROWS += [
    (-23, 'Marie Curie spoke. "It works," she said. Then Albert Einstein rose. "Why?" he asked. They said: "Nobody knows."'),
    (-24, '"One," said Barack Obama.\n"Two," Angela Merkel replied.\n"Three."\n"Four."\n"Five," he said. "Six."\n"Seven."\n\u201cEight\u201d'),
    (-25, 'An odd " mark. Angela Merkel met Barack Obama. She added: "Well \u201cquoted\u201d" and "so" he says'),
]
SCHEMA = "doc_id bigint, text string"

# Relations between names that are drawn from the documents, by words that are frequent in them.
OPENING_PATTERNS = [
    ("OPENING", "in", "OPENING", "Within"), ("OPENING", "the", "OPENING", "Beside"), ("OPENING", "and", "OPENING", "With"),
    ("OPENING", "and", "OPENING", "Also_With"), ("OPENING", "de", "OPENING", "Of"), ("NUMBER", "of", "OPENING", "Counts"),
]

# The dictionary of the checks.
RULES = [
    ("Bachelor of Arts", "DEGREE"),
    ("Bachelor of Laws", "DEGREE"),
    ("Arts and", "MISC_PHRASE"),
    ("Apache License", "LICENSE"),
    ("General Public License", "LICENSE"),
]

# Rules that both forms of a dictionary must read alike: two types for a phrase, nulls, other blanks, a frequent word.
ODD_RULES = [
    ("Barack Obama", "ZED"), ("Barack Obama", "ABLE"), (None, "NONE"), ("the", "FREQUENT"), ("of", None), ("  ", "BLANK"),
    ("New\xa0York\u3000City", "CITY"), ("\tBachelor  of Arts ", "DEGREE"), ("of Arts", "TAIL"), ("Harvard", "H"),
]

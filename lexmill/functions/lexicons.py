"""Word lists and rule tables of the built-in annotators.

They are English, small on purpose and of fixed size, so they are written into the
expressions as literals (set probes and literal maps) instead of being joined.
"""

# Irregular verbs of English by base form: past, and participle where it is another form. Verbs whose past is
# their base form (cut, put) are left out, since nothing can be told from the word alone.
IRREGULAR_VERBS = {
    "arise": "arose arisen", "awake": "awoke awoken", "bear": "bore borne", "beat": "- beaten", "become": "became", "begin": "began begun",
    "bend": "bent", "bind": "bound", "bite": "bit bitten", "bleed": "bled", "blow": "blew blown", "break": "broke broken",
    "breed": "bred", "bring": "brought", "build": "built", "buy": "bought", "catch": "caught", "choose": "chose chosen",
    "cling": "clung", "come": "came", "creep": "crept", "deal": "dealt", "dig": "dug", "draw": "drew drawn", "drink": "drank drunk",
    "drive": "drove driven", "eat": "ate eaten", "fall": "fell fallen", "feed": "fed", "feel": "felt", "fight": "fought",
    "find": "found", "flee": "fled", "fly": "flew flown", "forbid": "forbade forbidden", "forget": "forgot forgotten",
    "forgive": "forgave forgiven", "freeze": "froze frozen", "get": "got gotten", "give": "gave given", "go": "went gone",
    "grow": "grew grown", "hang": "hung", "hear": "heard", "hide": "hid hidden", "hold": "held", "keep": "kept", "know": "knew known",
    "lead": "led", "leave": "left", "lend": "lent", "lose": "lost", "make": "made", "mean": "meant", "meet": "met", "pay": "paid",
    "ride": "rode ridden", "ring": "rang rung", "rise": "rose risen", "run": "ran", "see": "- seen", "seek": "sought", "sell": "sold",
    "send": "sent", "shake": "shook shaken", "shine": "shone", "shoot": "shot", "shrink": "shrank shrunk", "sing": "sang sung",
    "sink": "sank sunk", "sit": "sat", "sleep": "slept", "slide": "slid", "speak": "spoke spoken", "spend": "spent", "spin": "spun",
    "stand": "stood", "steal": "stole stolen", "stick": "stuck", "strike": "struck stricken", "swear": "swore sworn", "sweep": "swept",
    "swim": "swam swum", "swing": "swung", "take": "took taken", "teach": "taught", "tear": "tore torn", "tell": "told",
    "think": "thought", "throw": "threw thrown", "understand": "understood", "wake": "woke woken", "wear": "wore worn", "weep": "wept",
    "win": "won", "write": "wrote written",
}
PAST = [forms.split()[0] for forms in IRREGULAR_VERBS.values() if forms.split()[0] != "-"]
PARTICIPLES = [forms.split()[1] for forms in IRREGULAR_VERBS.values() if " " in forms]

# Closed-class words by tag, matched on the lower-cased token.
CLOSED_CLASS = {
    "DT": ["the", "a", "an", "this", "that", "these", "those", "every", "each", "some", "any", "no"],
    "IN": ["of", "in", "on", "at", "by", "for", "with", "from", "as", "into", "over", "after",
           "before", "if", "because", "while"],
    "TO": ["to"],
    "CC": ["and", "or", "but", "nor", "yet"],
    "MD": ["can", "could", "will", "would", "shall", "should", "may", "might", "must", "ca", "wo"],
    "PRP": ["i", "you", "he", "she", "it", "we", "they", "me", "him", "her", "us", "them"],
    "PRP$": ["my", "your", "his", "its", "our", "their"],
    "VBZ": ["is", "has", "does", "says"],
    "VBP": ["are", "am", "have", "do", "say"],
    "VBD": ["was", "were", "had", "did", "said", *PAST],
    "VB": ["be"],
    "VBN": ["been", *PARTICIPLES],
    "RB": ["not", "n't", "n’t", "never"],
    "WP": ["who", "what"],
    "WDT": ["which"],
    "POS": ["'s", "’s"],
    "JJ": ["good", "great", "excellent", "happy", "best", "wonderful", "worthless", "pathetic", "stupid",
           "disgusting", "bad", "terrible", "awful", "useless", "quick", "brown", "many", "most"],
}

# Tags of tokens without a letter or digit; any other such token is SYM.
PUNCTUATION = {
    ".": [".", "!", "?"],
    ",": [","],
    ":": [":", ";", "-", "--", "...", "–", "—", "…"],
    "-LRB-": ["(", "[", "{"],
    "-RRB-": [")", "]", "}"],
    "''": ['"', "'", "“", "”", "‘", "’", "`"],
    "$": ["$"],
    "#": ["#"],
}

# Token shapes.
LETTER_OR_DIGIT = r"[\p{L}\p{N}]"
DIGIT_FIRST = r"^\$?\p{N}"
CAPITAL_FIRST = r"^\p{Lu}"
SMALL_FIRST = r"^\p{Ll}"

# Suffix rules in order, (suffix, shortest token length, tag).
SUFFIXES = [
    ("ly", 4, "RB"),
    ("ing", 5, "VBG"),
    ("ed", 5, "VBD"),
    ("tion", 6, "NN"),
    ("ment", 6, "NN"),
    ("ness", 6, "NN"),
    ("ity", 5, "NN"),
    ("ous", 5, "JJ"),
    ("ful", 5, "JJ"),
    ("ive", 5, "JJ"),
    ("able", 6, "JJ"),
    ("ible", 6, "JJ"),
    ("less", 6, "JJ"),
    ("ic", 4, "JJ"),
    ("est", 5, "JJS"),
]

# Irregular lemmas, matched on the lower-cased token.
IRREGULAR_LEMMAS = {verb: [f for f in forms.split() if f != "-"] for verb, forms in IRREGULAR_VERBS.items()} | {
    "be": ["is", "are", "am", "was", "were", "been"],
    "have": ["has", "had"],
    "do": ["does", "did"],
    "say": ["says", "said"],
    "go": ["went", "gone", "goes"],
    "write": ["wrote", "written", "writing"],
    "live": ["lived", "living"],
    "base": ["based", "basing"],
    "child": ["children"],
    "foot": ["feet"],
    "goose": ["geese"],
    "man": ["men"],
    "mouse": ["mice"],
    "person": ["people"],
    "tooth": ["teeth"],
    "woman": ["women"],
    "good": ["better", "best"],
    "bad": ["worse", "worst"],
    "not": ["n't", "n’t"],
    "can": ["ca"],
    "will": ["wo"],
}

# Word valence for the sentiment classes.
POSITIVE = ["good", "great", "excellent", "happy", "love", "best", "wonderful"]
NEGATIVE = ["worthless", "pathetic", "stupid", "disgusting", "bad", "terrible", "awful", "useless", "hate"]

# Words that turn polarity over, and quantifiers that make it flat.
DOWNWARD = ["no", "not", "n't", "n’t", "never", "none", "nobody", "neither", "nor", "without", "few"]
FLAT_QUANTIFIERS = ["most", "many", "exactly"]

# Pronouns that may corefer, and verbs of speech as they appear in text.
PRONOUN_KINDS = {
    "male": ["he", "him", "his"],
    "female": ["she", "her"],
    "plural": ["they", "them", "their"],
    "thing": ["its"],
}
PRONOUNS = [word for words in PRONOUN_KINDS.values() for word in words]
SPEECH_VERBS = ["said", "says", "say", "told", "tells", "asked", "asks", "replied", "replies",
                "added", "adds", "claimed", "claims", "wrote", "writes"]

# Frequent given names by gender.
GIVEN_NAMES = {
    "male": [
        "Adam", "Albert", "Andrew", "Anthony", "Barack", "Ben", "Bob", "Carlos", "Charles", "Daniel", "David", "Edward", "Frank", "George",
        "Hans", "Henry", "Isaac", "Jack", "James", "John", "José", "Juan", "Kevin", "Mark", "Martin", "Michael", "Mohammed", "Nelson",
        "Paul", "Peter", "Pierre", "Richard", "Robert", "Stephen", "Steven", "Thomas", "Tim", "Tom", "William"],
    "female": [
        "Alice", "Amy", "Angela", "Ann", "Anna", "Barbara", "Carol", "Catherine", "Claire", "Elizabeth", "Emily", "Emma", "Eva", "Hannah",
        "Helen", "Jane", "Jennifer", "Jessica", "Julia", "Karen", "Kate", "Laura", "Linda", "Lisa", "Margaret", "Maria", "Marie", "Mary",
        "Nancy", "Olivia", "Patricia", "Rachel", "Rebecca", "Rose", "Ruth", "Sandra", "Sarah", "Sophie", "Susan"],
}

# Seed gazetteer, well-known names by type; a table of one's own takes its place.
NAMES = {
    "PERSON": ["Barack Obama", "Angela Merkel", "Marie Curie", "Albert Einstein", "Isaac Newton", "Nelson Mandela", "William Shakespeare"],
    "ORGANIZATION": [
        "Harvard University", "Oxford University", "Cambridge University", "United Nations", "European Union", "World Bank", "Red Cross",
        "World Health Organization", "International Monetary Fund", "Apache Software Foundation", "Supreme Court"],
    "LOCATION": [
        "Africa", "Asia", "Europe", "North America", "South America", "Argentina", "Australia", "Austria", "Belgium", "Brazil", "Canada",
        "Chile", "China", "Colombia", "Denmark", "Egypt", "Finland", "France", "Germany", "Greece", "Hungary", "India", "Indonesia",
        "Ireland", "Israel", "Italy", "Japan", "Kenya", "Mexico", "Netherlands", "New Zealand", "Nigeria", "Norway", "Pakistan", "Peru",
        "Poland", "Portugal", "Russia", "Saudi Arabia", "South Africa", "South Korea", "Spain", "Sweden", "Switzerland", "Turkey",
        "Ukraine", "United Kingdom", "United States", "Vietnam", "Amsterdam", "Athens", "Beijing", "Berlin", "Boston", "Brussels",
        "Buenos Aires", "Cairo", "Chicago", "Dublin", "Hong Kong", "Istanbul", "London", "Los Angeles", "Madrid", "Moscow", "New Delhi",
        "New York", "New York City", "Oslo", "Paris", "Prague", "Rome", "San Francisco", "Seoul", "Singapore", "Stockholm", "Sydney",
        "Tokyo", "Toronto", "Vienna", "Warsaw"],
}
GAZETTEER = [(name, kind) for kind, names in NAMES.items() for name in names]
#: The types that a token's shape gives.
SHAPES = ["MONEY", "PERCENT", "NUMBER", "MISC", "URL", "EMAIL", "O"]
ENTITY_TYPES = ["PERSON", "LOCATION", "ORGANIZATION"]

# The two phrases of the default dictionary.
DEFAULT_RULES = [("Bachelor of Arts", "DEGREE"), ("Bachelor of Laws", "DEGREE")]

# Fixed values: (type of first entity, lemma between, type of second entity, relation).
RELATION_PATTERNS = [
    ("PERSON", "work", "ORGANIZATION", "Work_For"),
    ("PERSON", "live", "LOCATION", "Live_In"),
    ("ORGANIZATION", "base", "LOCATION", "OrgBased_In"),
    ("LOCATION", "in", "LOCATION", "Located_In"),
]

# Confidence of the two triple patterns.
CONFIDENCE_DIRECT = 1.0
CONFIDENCE_PREPOSITION = 0.5

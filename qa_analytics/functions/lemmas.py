"""Noun lemmas (F2): endings are detached by rules, irregular words are looked up.

An approximation of a dictionary lemmatiser without its dictionary: the first
rule whose ending fits is taken, and words whose ending only looks like a
plural are listed. A table of lemmas overrides it (`keyword_scores(lemmas=...)`).
"""

from pyspark.sql import Column, functions as F

# Plurals that no rule below turns into their noun.
IRREGULAR = {
    "men": "man",
    "analyses": "analysis", "appendices": "appendix", "axes": "axis", "bacteria": "bacterium", "bases": "base",
    "calves": "calf", "children": "child", "crises": "crisis", "criteria": "criterion", "data": "data", "diagnoses": "diagnosis",
    "dice": "die", "feet": "foot", "geese": "goose", "halves": "half", "hypotheses": "hypothesis", "indices": "index",
    "knives": "knife", "leaves": "leaf", "lice": "louse", "lives": "life", "loaves": "loaf", "matrices": "matrix", "mice": "mouse",
    "movies": "movie", "oxen": "ox", "parentheses": "parenthesis", "phenomena": "phenomenon", "quizzes": "quiz",
    "scarves": "scarf", "schemata": "schema", "selves": "self", "sheaves": "sheaf", "shelves": "shelf", "stimuli": "stimulus",
    "syntheses": "synthesis", "teeth": "tooth", "theses": "thesis", "thieves": "thief", "ties": "tie", "vertices": "vertex",
    "wives": "wife", "wolves": "wolf", "caches": "cache", "axles": "axle", "buses": "bus", "gases": "gas", "lenses": "lens",
    "aliases": "alias", "statuses": "status", "viruses": "virus", "bonuses": "bonus", "sizes": "size", "prizes": "prize",
    "headaches": "headache", "mazes": "maze", "zombies": "zombie", "cookies": "cookie", "pies": "pie", "lies": "lie",
    "dies": "die",
}

# Words that end like a plural and are none.
UNCHANGED = """
abdomen acumen alias always amen atlas bias canvas chaos christmas cosmos gas iris kudos lens mathematics news omen pandas
perhaps physics regimen series species specimen stamen sometimes thanks towards whereas yes yours afterwards besides nowadays
""".split()

# Ending, what takes its place, least length of the word; the first that fits is taken.
ENDINGS = (
    ("sses", "ss", 5), ("ches", "ch", 5), ("shes", "sh", 5), ("xes", "x", 4), ("zes", "z", 4), ("ies", "y", 5), ("men", "man", 5),
    ("ss", "ss", 2), ("us", "us", 2), ("is", "is", 2), ("s", "", 4),
)


def noun_lemma(word) -> Column:
    """The lemma of one lower-case word; a word without a plural ending stays as it is."""
    by_ending = word
    for ending, singular, least in reversed(ENDINGS):
        stem = F.concat(F.substring(word, F.lit(1), F.length(word) - len(ending)), F.lit(singular))
        by_ending = F.when(F.endswith(word, F.lit(ending)) & (F.length(word) >= least), stem).otherwise(by_ending)
    pairs = [F.lit(x) for item in IRREGULAR.items() for x in item]
    return (
        F.when(word.isin(list(IRREGULAR)), F.try_element_at(F.create_map(*pairs), word))
        .when(~(F.endswith(word, F.lit("s")) | F.endswith(word, F.lit("men"))) | word.isin(UNCHANGED), word)
        .otherwise(by_ending))


def noun_lemmas(tokens) -> Column:
    """Every word of an array replaced by its lemma; lemmas of one letter go."""
    return F.filter(F.transform(tokens, noun_lemma), lambda w: F.length(w) > 1)

"""Text expressions (F1-F6, F15, F16). All of them stay in the JVM."""

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, functions as F

from .word_lists import SPLIT_FORMS, STOP_WORDS

TAG_PATTERN = r"<[^>]+>"


def text_or_empty(col) -> Column:
    """F3."""
    return F.coalesce(col, F.lit(""))


def strip(col) -> Column:
    """Remove white space of every kind at both ends (SQL `trim` only removes blanks)."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def is_blank(col) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(col.rlike(r"\S"), F.lit(False))


def combined_text(title, summary) -> Column:
    """F4."""
    return strip(F.concat_ws(" ", text_or_empty(title), text_or_empty(summary)))


def once(col) -> Column:
    """Evaluate an expensive expression once per row and go on with its value.

    A generated column is a barrier: filters on it, also those that later
    generators bring along, are not pushed below it with a copy of the
    expression. Usable as one column of a `select`.
    """
    return F.explode(F.array(col))


def clean_text(col) -> Column:
    """lower case; markup, addresses and everything but ASCII letters is deleted."""
    text = F.lower(text_or_empty(col))
    for pattern in (TAG_PATTERN, r"http\S+|www\S+", r"[^a-z\s]+"):
        text = F.regexp_replace(text, pattern, "")
    return text


def words(col) -> Column:
    """White-space separated words, in order."""
    return F.filter(F.split(col, r"\s+"), lambda w: w != "")


def word_count(col) -> Column:
    """F15."""
    return F.size(words(col))


def kept_tokens(tokens, stop_words=STOP_WORDS, split_forms=None) -> Column:
    """F2 on cleaned words: split forms are taken apart, then words of one or two letters and stop words go."""
    forms = SPLIT_FORMS if split_forms is None else split_forms
    if forms:
        known = F.array(*[F.lit(f) for f in forms])
        parts = F.create_map(*[c for f, p in forms.items() for c in (F.lit(f), F.split(F.lit(p), " "))])
        taken_apart = F.flatten(F.transform(tokens, lambda w: F.coalesce(F.try_element_at(parts, w), F.array(w))))
        tokens = F.when(F.arrays_overlap(tokens, known), taken_apart).otherwise(tokens)
    stop_words = list(stop_words)
    if not stop_words:
        return F.filter(tokens, lambda w: F.length(w) > 2)
    return F.filter(tokens, lambda w: (F.length(w) > 2) & ~w.isin(stop_words))


def clean_words(col) -> Column:
    """Cleaned text split at white space."""
    return F.split(clean_text(col), r"\s+")


def clean_tokens(col, stop_words=STOP_WORDS, split_forms=None) -> Column:
    """F1 and F2 without lemmas."""
    return kept_tokens(clean_words(col), stop_words, split_forms)


def body_summary(col, limit=None) -> Column:
    """markup deleted, three entities decoded; with a limit cut to so many characters plus an ellipsis."""
    text = F.regexp_replace(text_or_empty(col), TAG_PATTERN, "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    if limit is None:
        return text
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def contains_any(col, terms) -> Column:
    """F16: at least one term occurs as a substring."""
    return reduce(or_, [F.contains(col, F.lit(t)) for t in terms], F.lit(False))


def terms_present(col, terms) -> Column:
    """F16: how many of the terms occur as substrings."""
    return reduce(add, [F.contains(col, F.lit(t)).cast("long") for t in terms], F.lit(0).cast("long"))


def count_words_in(col, terms) -> Column:
    """F16: how many words are exactly one of the terms (repeats count)."""
    terms = list(terms)
    if not terms:
        return F.lit(0)
    return F.size(F.filter(F.split(col, r"\s+"), lambda w: w.isin(terms)))


def sentiment_tokens(col) -> Column:
    """Lower-case words of the raw text; letters of any script and apostrophes."""
    return F.filter(F.split(F.lower(text_or_empty(col)), r"[^\p{L}']+"), lambda w: w != "")


def shorten(col, limit=50) -> Column:
    """long examples are cut to `limit - 3` characters plus an ellipsis."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit - 3), F.lit("..."))).otherwise(col)

"""Quality rules, line first: drop failing lines, then documents that lose too much.

Every line is judged on its own by three rules: punctuation (runs of marks,
symbols instead of words, a fragment without an end mark), navigation
(separators between short items, a lone menu word) and boilerplate (a fixed
phrase in a short line, a line that repeats an earlier one). Failing lines go;
a document is kept if it passes the base counts and at least
`1 - max_lost` of its word characters are left.

Built-in expressions only, all inside the row: no shuffle, no Python.
Null text counts as empty; a document without words fails the base counts and
loses nothing. Repeated rows are judged alike. Other columns pass through.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.text import once
from .common import SPACE, WORD, own

# Phrases of notices and licence lines, and menu entries.
BOILERPLATE = (
    "all rights reserved", "accept cookies", "we use cookies", "cookie policy", "privacy policy", "terms of service",
    "terms of use", "enable javascript", "javascript is disabled", "click here", "lorem ipsum", "subscribe to our",
    "sign up for our", "licensed under", "released under the", "powered by", "skip to content",
)
MENU = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next", "previous", "back to top",
    "read more", "share", "contact", "contact us", "about", "about us", "sitemap",
)
SYMBOLS = "#*$%&|<>"


def _count(text, pattern):
    return F.size(F.split(text, pattern, -1)) - 1


def line_fails(line, max_boilerplate_chars=240):
    """True for a line (with at least one word) that breaks a rule.

    The cheap tests come first; AND and OR stop as soon as they are decided.
    """
    n = F.greatest(_count(line, WORD), F.lit(1))
    symbols = F.length(F.regexp_replace(line, f"[^{SYMBOLS}]+", ""))
    separators = _count(line, r"(?<= )[|»›•·>](?= )")
    marked = line.rlike(f"[{SYMBOLS}!?»›•·]") & (
        ((symbols >= 3) & (2 * symbols > n))
        | ((separators >= 2) & (5 * separators >= n))
        | (10 * _count(line, "[!?]{2,}") > 3 * n))
    fragment = line.rlike(r"^\s*(?:\S+\s+)?\S*[^\s\p{Po}\p{Pe}\p{Pf}\"]\s*$") | ~line.rlike(r"[\p{L}\p{N}]")
    phrase = (F.length(line) <= max_boilerplate_chars) & line.rlike(
        r"(?i)\b(?:" + "|".join(BOILERPLATE) + r")|^\s*(?:" + "|".join(MENU) + r")[\s\p{P}\p{S}]*$")
    return marked | fragment | phrase


PLACE_BITS = 30


def _spread(w, packed):
    """Words covered by three-word windows that occur twice or more.

    `packed` holds a hash and the place of each window, sorted. Windows beside
    one of equal hash are compared by their words: sorting (window, place)
    puts equal ones side by side. Each place found covers three words, less
    what the next place covers too.
    """
    def same(s, i, key):
        x = key(F.get(s, i))
        return ((i > 0) & (key(F.get(s, i - 1)) == x)) | F.coalesce(key(F.get(s, i + 1)) == x, F.lit(False))

    likely = F.filter(packed, lambda x, i: same(packed, i, lambda v: F.shiftright(v, PLACE_BITS)))
    windows = F.array_sort(F.transform(likely, lambda x: _window(w, x.bitwiseAND((1 << PLACE_BITS) - 1).cast("int"))))

    def places(s):
        return F.sort_array(F.transform(F.filter(s, lambda x, i: same(s, i, lambda v: v["t"])), lambda x: x["i"]))

    def covered(p):
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x)

    # A lambda over a one-element array names a value that is used more than once.
    found = F.transform(F.transform(F.array(windows), places), covered)
    return F.get(found, 0)


def _window(w, i):
    return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("t"), i.alias("i"))


def judge(docs: DataFrame, text="text", max_lost=0.4, min_words=50, max_repeat_percent=50) -> DataFrame:
    """`docs` with two more columns: `quality` (counts and verdicts, a struct) and `clean_text` (the lines left).

    A name that `docs` already has gets underscores in front. `clean_text`
    equals the text if no line failed; otherwise blank lines go as well.
    """
    quality, clean = own("quality", docs), own("clean_text", docs)
    # One column per step: the optimizer does not repeat expensive steps that are used more than once.
    step = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    step = step.select(
        "row", "t",
        F.filter(F.split("t", SPACE + "+"), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"))
    step = step.select(
        "row", "t", "lines", F.size("w").alias("n"), F.array_distinct("lines").alias("single"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"),
        F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).alias("symbols"),
        "w", F.sort_array(F.transform(
            F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
            lambda x, i: F.shiftleft(F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)), PLACE_BITS)
            .bitwiseOR(i.cast("long")))).alias("packed"))
    step = step.select(
        "row", "t", "lines", "single", "n", "chars", "symbols", _spread(F.col("w"), F.col("packed")).alias("repeats"),
        F.filter("single", lambda x: ~line_fails(x)).alias("left"))
    step = step.select(
        "*", F.aggregate("left", F.lit(0).cast("long"),
                         lambda a, x: a + F.length(F.regexp_replace(x, SPACE + "+", ""))).alias("left_chars"))
    failed = (F.col("n") < min_words) | (100 * F.col("repeats") > max_repeat_percent * F.col("n"))
    enough = F.col("left_chars") >= (1 - max_lost) * F.col("chars")
    return step.select(
        "row.*",
        once(F.struct(
            F.col("n").cast("long").alias("n_words"), F.col("chars").alias("word_chars"),
            F.col("symbols").cast("long").alias("n_symbols"),
            (F.size("lines") - F.size("single")).cast("long").alias("n_dup_lines"),
            F.col("repeats").cast("long").alias("n_repeat_words"), failed.alias("base_failed"),
            (~failed & enough).alias("kept"), F.size("left").cast("long").alias("n_lines_left"),
            F.col("left_chars"))).alias(quality),
        F.when(F.size("left") == F.size("lines"), F.col("t")).otherwise(F.array_join("left", "\n")).alias(clean))

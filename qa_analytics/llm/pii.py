"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Strict patterns find the base spans, which always stay. Looser patterns
propose more spans of the same kinds: e-mail addresses written out, national
phone numbers, defanged and version 6 addresses, card numbers in other shapes.
Four labelers vote -1, 0 or 1 on every span: the shape (regular expression), a
gazetteer (name endings, issuer and country prefixes, address ranges), the
words before it, and the characters it touches. Spans are counted by vote
pattern; expectation-maximisation over these counts estimates how reliable
each labeler is and how common true spans are among the proposed ones of a
kind, with base spans as known cases. A logistic classifier is fitted to the
resulting probabilities: besides the votes it sees the span itself (its shape,
length and digits) and its surroundings (the two words before, the word after,
the characters it touches), as names hashed to `WIDTH` places. Proposed spans
that it accepts are added.

Built-in expressions only; spans never leave their row. What comes to the
driver is one count per vote pattern (at most 4 kinds x 2 x 3^4 rows, whatever
the input) and at most `FIT_SPANS` distinct spans of either sort to fit the
classifier on, chosen by hash. Positions count code points, ends are exclusive.

Null text counts as empty; an empty table learns nothing and adds nothing.
Every row is handled by itself, so repeated ids do not matter; other columns
pass through.
"""

import math

import numpy as np

from pyspark.sql import DataFrame, functions as F

from ..session import durable
from .common import own

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "gazetteer", "context", "touch")
CONTEXT_CHARS, AFTER_CHARS = 48, 24
FIT_SPANS, WIDTH = 10_000, 1024
BLOCK = 512

# The base patterns. Possessive quantifiers and the look-behind (or the end of the last match) keep them linear.
LOCAL, HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?i)(?<!{LOCAL}){LOCAL}++(?: ?[\[({{]at[\])}}] ?{HOST}++(?: ?[\[({{]dot[\])}}] ?{HOST}++|\.{HOST}++)++"
             rf"| at {HOST}++(?: dot {HOST}++)++)",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z.-])(?:[0-9]{4}[ ._/-]){3}[0-9]{4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:00[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ ./-])[0-9]{3,4}[ .-][0-9]{3,4}"
             r"(?![0-9A-Za-z])",
}
# Cheap tests that hold for every text with a match.
HINTS = {
    "email": r"(?i)[\[({]at[\])}]| at [A-Za-z0-9-]++ dot ",
    "ip": r"[0-9]\[\.\]|[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:",
    "card": r"[0-9]{4}[ ._/-][0-9]{4}",
    "phone": r"[0-9][ .-][0-9]{3}",
}
# What the gazetteer and context labelers know.
NAME_ENDINGS = "com org net edu gov info io eu uk de fr es it us ca au nl at ch se no dk fi pl pt ie jp cn in br example".split()
CUES = {
    "email": r"mail|contact|write to|reach|address|correo|kontakt|courriel",
    "ip": r"\bip\b|address|host|server|logged in|login|connect",
    "card": r"card|visa|credit|debit|mastercard|amex|payment|karte|carte|tarjeta",
    "phone": r"phone|call|\btel|mobile|cell|fax|whatsapp|ring|text me|dial|anruf|telefon|llam",
}
AGAINST = r"isbn|issn|order|invoice|version|release|section|chapter|figure|table|page|pp\.|sku|part no|serial|doi|token|hash|year"
NO_STRICT, STRICT = 0, 1


def _digits(s):
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits):
    """True if the digit string passes the Luhn check."""
    turned = F.split(F.reverse(digits), "")

    def add(total, x):
        twice = x["d"] * 2
        return total + F.when(x["i"] % 2 == 0, x["d"]).when(twice > 9, twice - 9).otherwise(twice)

    pairs = F.transform(F.filter(turned, lambda c: c != ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(pairs, F.lit(0), add) % 10 == 0


def _valid(kind, s):
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: F.coalesce(
            F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.length(_digits(s)).between(12, 19) & _luhn(_digits(s))
    return F.length(_digits(s)).between(9, 15)


def matches(text, pattern, hint):
    """Matches in order: array of (s, at, before, after), found in linear time.

    The pieces between the matches give the context and the distance to the
    match before. Distances are added up in blocks, so that no long array is
    copied for each match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def rows(pair):
        m, pieces = pair["m"], pair["p"]
        return F.transform(m, lambda s, i: F.struct(
            s.alias("s"), F.length(F.get(pieces, i)).alias("gap"), F.length(s).alias("n"),
            F.right(F.get(pieces, i), F.lit(CONTEXT_CHARS)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(AFTER_CHARS)).alias("after")))

    def placed(items):
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
            lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))

        def starts(block, first):
            return F.aggregate(
                block, F.struct(first.alias("at"), F.array().cast("array<int>").alias("all")),
                lambda a, x: F.struct((a["at"] + x["gap"] + x["n"]).alias("at"),
                                      F.concat(a["all"], F.array(a["at"] + x["gap"])).alias("all")))

        whole = F.aggregate(
            blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("all")),
            lambda a, b: F.get(F.transform(F.array(starts(b, a["at"])), lambda r: F.struct(
                r["at"].alias("at"), F.concat(a["all"], F.array(r["all"])).alias("all"))), 0))
        return F.zip_with(items, F.flatten(whole["all"]), lambda x, at: F.struct(
            x["s"].alias("s"), at.alias("at"), x["before"].alias("before"), x["after"].alias("after")))

    pair = F.array(F.struct(found.alias("m"), F.split(text, pattern, -1).alias("p")))
    some = F.get(F.transform(F.transform(pair, rows), placed), 0)
    none = F.array().cast("array<struct<s:string,at:int,before:string,after:string>>")
    return F.when(text.rlike(hint), some).otherwise(none)


def _votes(kind, strict, m):
    """The four labelers' votes on match `m`."""
    s, before = m["s"], F.lower(m["before"])
    digits = _digits(s)
    shape = {
        "email": s.rlike(r"[\[({]"), "ip": F.lit(True), "card": _luhn(digits), "phone": s.rlike(r"^00|\("),
    }[kind]
    gazetteer = {
        "email": F.element_at(F.split(F.lower(s), r"[^a-z0-9-]+"), -1).isin(*NAME_ENDINGS),
        "ip": ~s.rlike(r"^0|^255"),
        "card": digits.rlike("^(4|5[1-5]|2[2-7]|3[47]|6011|65)"),
        "phone": ~digits.rlike(r"^(19|20)[0-9]{2}|^(\d)\2+$") & F.length(digits).between(9, 15),
    }[kind]
    cue, against = before.rlike(CUES[kind]), before.rlike(AGAINST)
    touching = before.rlike(r"[\p{L}\p{N}_#=/\"']$") | m["after"].rlike(r"^[\p{L}\p{N}_=/\"']")
    return F.struct(
        (F.lit(1) if strict else F.when(shape, 1).otherwise(-1)).alias("shape"),
        F.when(gazetteer, 1).otherwise(-1).alias("gazetteer"),
        F.when(cue & ~against, 1).when(against & ~cue, -1).otherwise(0).alias("context"),
        F.when(touching, -1).otherwise(0).alias("touch"))


def _sort_of(c):
    """What a character is: a mark stands for itself."""
    return F.when(c == "", "none").when(c.rlike(r"\p{L}"), "letter").when(c.rlike(r"\p{N}"), "digit").when(
        c.rlike(r"\s"), "space").otherwise(c)


def _seen(kind, m):
    """Places of the names of what is to be seen of match `m` and around it."""
    s, before, after = m["s"], F.lower(m["before"]), F.lower(m["after"])
    shape = F.regexp_replace(F.regexp_replace(s, r"\p{L}++", "a"), "[0-9]++", "9")
    word, gap = r"[\p{L}\p{N}]++", r"[^\p{L}\p{N}]*+"
    names = {
        "shape": shape, "length": F.floor(F.log2(F.length(s))), "digits": F.least(F.length(_digits(s)), F.lit(20)),
        "last": F.regexp_extract(before, rf"({word}){gap}$", 1), "second": F.regexp_extract(before, rf"({word}){gap}{word}{gap}$", 1),
        "next": F.regexp_extract(after, rf"^{gap}({word})", 1), "left": _sort_of(F.right(before, F.lit(1))),
        "right": _sort_of(F.left(after, F.lit(1))),
    }
    return F.array(*(F.pmod(F.xxhash64(F.lit(f"{kind} {name}"), value.cast("string")), F.lit(WIDTH)).cast("int")
                     for name, value in names.items()))


def _spans(kind, strict, found):
    return F.transform(found, lambda m: F.struct(
        m["at"].alias("at"), F.lit(KINDS.index(kind)).alias("k"), (m["at"] + F.length(m["s"])).alias("to"),
        F.lit(kind).alias("kind"), F.lit(strict).alias("base"), _votes(kind, strict, m).alias("votes"),
        _seen(kind, m).alias("seen")))


def candidates(docs: DataFrame, text="text", name="found") -> DataFrame:
    """`docs` with column `name`: all base spans and the loose ones that overlap none of them, in order."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    step = docs.select(F.struct("*").alias("row"), *(
        matches(t, BASE[k], BASE[k] if k != "email" else "@").alias(f"s_{k}") for k in KINDS), *(
        matches(t, LOOSE[k], HINTS[k]).alias(f"l_{k}") for k in KINDS))
    step = step.select(
        "row",
        F.array_sort(F.concat(*(
            _spans(k, True, F.filter(f"s_{k}", lambda m: _valid(k, m["s"]))) for k in KINDS))).alias("sure"),
        F.concat(*(_spans(k, False, F.col(f"l_{k}")) for k in KINDS)).alias("maybe"))
    free = F.filter("maybe", lambda x: ~F.exists("sure", lambda y: (y["at"] < x["to"]) & (x["at"] < y["to"])))
    # Columns of `docs` come in only after the last use of the names above.
    step = step.select("row", F.when(F.size("maybe") == 0, F.col("sure")).otherwise(
        F.array_sort(F.concat("sure", free))).alias("spans"))
    return step.select("row.*", F.col("spans").alias(name))


def _vote_columns():
    return [F.col("x.kind").alias("kind"), F.col("x.base").alias("base"), *(F.col(f"x.votes.{v}").alias(v) for v in LABELERS)]


def reliabilities(found: DataFrame, name="found", rounds=30):
    """Vote patterns with the probability that such a span is personal data, by EM over the pattern counts."""
    counted = found.select(F.explode(name).alias("x")).groupBy(*_vote_columns()).count()
    patterns = sorted(tuple(r) for r in counted.collect())
    return patterns, expectation_maximisation(patterns, rounds)


def expectation_maximisation(patterns, rounds=30):
    """The probability of each (kind, base, votes..., count) pattern; base spans are true.

    Labelers err independently; the share of true spans is that of the proposed spans of a kind. All counts start at
    one, so no vote and no share becomes certain.
    """
    # Starting point: a majority of the votes.
    p = [1.0 if x[1] else 1 / (1 + math.exp(-1.5 * (sum(x[2:6]) - 0.5))) for x in patterns]
    for _ in range(rounds):
        said = [[{v: 1.0 for v in (-1, 0, 1)} for _ in LABELERS] for _ in (0, 1)]
        share = {k: [1.0, 1.0] for k in KINDS}
        for x, q in zip(patterns, p):
            for y, weight in ((1, q), (0, 1 - q)):
                if not x[1]:
                    share[x[0]][y] += weight * x[6]
                for j, vote in enumerate(x[2:6]):
                    said[y][j][vote] += weight * x[6]
        p = []
        for x in patterns:
            if x[1]:
                p.append(1.0)
                continue
            score = math.log(share[x[0]][1] / share[x[0]][0]) + sum(
                math.log(said[1][j][v] / sum(said[1][j].values())) - math.log(said[0][j][v] / sum(said[0][j].values()))
                for j, v in enumerate(x[2:6]))
            p.append(1 / (1 + math.exp(-max(-30.0, min(30.0, score)))))
    return p


def _vote_places():
    """A place after the hashed ones for every kind and for every vote of a labeler on a kind."""
    names = [*KINDS, *((k, v, n) for k in KINDS for v in LABELERS for n in (-1, 0, 1))]
    return {name: WIDTH + i for i, name in enumerate(names)}


def fit(found: DataFrame, name="found", steps=300, rate=2.0, ridge=1e-3):
    """Weights of the span classifier: logistic regression on the EM probabilities, weighted by log counts.

    Equal spans count as one with their number, so a text with many copies does not crowd out the others.
    """
    patterns, p = reliabilities(found, name)
    if not patterns:
        return []
    chance = {x[:6]: q for x, q in zip(patterns, p)}
    distinct = found.select(F.explode(name).alias("x")).groupBy(*_vote_columns(), F.col("x.seen").alias("seen")).count()
    distinct = durable(distinct)
    order = F.xxhash64("seen", "kind", *LABELERS)
    rows = [r for base in (True, False) for r in distinct.where(F.col("base") == base).orderBy(
        order, "kind", "seen", *LABELERS).limit(FIT_SPANS).collect()]
    places = _vote_places()
    x = np.array([[*r.seen, places[r.kind], *(places[r.kind, v, r[v]] for v in LABELERS)] for r in rows])
    target = np.array([chance[tuple(r)[:6]] for r in rows])
    weight = np.log1p([r["count"] for r in rows])
    weight /= weight.sum()
    size = WIDTH + len(places)
    w = np.zeros(size)
    for _ in range(steps):
        error = weight * (1 / (1 + np.exp(-np.clip(w[x].sum(1), -30, 30))) - target)
        w -= rate * (np.bincount(x.ravel(), np.repeat(error, x.shape[1]), size) + ridge * w)
    return w.round(9).tolist()


def accepted(weights, name="found"):
    """The spans of column `name` that stay: base spans and those the classifier accepts."""
    if not weights:
        return F.filter(name, lambda x: x["base"])
    hashed = F.array(*map(F.lit, weights[:WIDTH]))
    places = _vote_places()

    def weight(x):
        out = F.lit(0.0)
        for k in KINDS:
            votes = sum(F.get(F.array(*(F.lit(weights[places[k, v, n]]) for n in (-1, 0, 1))), x["votes"][v] + 1) for v in LABELERS)
            out = F.when(x["kind"] == k, votes + weights[places[k]]).otherwise(out)
        return out

    return F.filter(name, lambda x: x["base"] | (
        F.aggregate(x["seen"], F.lit(0.0), lambda a, i: a + F.get(hashed, i)) + weight(x) > 0))


def listing(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["at"], x["to"])), ",")


def mask(docs: DataFrame, text="text", mark="[{}]") -> DataFrame:
    """`docs` with every span in `text` replaced by a mark that names its kind; all else stays.

    Overlapping spans are joined and get the mark of the first.
    """
    name = own("found", docs)
    found = candidates(docs, text, name)
    weights = fit(durable(found.select(name)), name)
    t, spans = F.col(f"`{text}`"), F.col(name)

    def piece(since, until):
        return F.substring(t, since + 1, until - since)

    def step(a, x):
        marked = F.concat(a["out"], F.array(piece(a["at"], x["at"]), F.format_string(mark.replace("{}", "%s"), F.upper(x["kind"]))))
        return F.when(x["at"] < a["at"], F.struct(F.greatest(a["at"], x["to"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(x["to"].alias("at"), marked.alias("out")))

    masked = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step,
        lambda a: F.concat(F.array_join(a["out"], ""), piece(a["at"], F.length(t))))
    return found.withColumn(name, accepted(weights, name)).select(*(
        F.col(f"`{c}`") if c != text else F.when(F.size(spans) > 0, masked).otherwise(t).alias(text) for c in docs.columns))

"""Main text of web pages by composite text density.

Each page becomes a tree. Elements that are furniture by their name, role or
class (menus, page headers, footers, sidebars, notices, adverts, forms, reader
comments, scripts, styles) are left out; a class or id does not leave out what
holds the article or most of the text. Every other node gets its composite
text density: characters per tag, lowered by the share of links in the node
and in the body. The node with the largest sum of its children's densities is
the content; the smallest density on its path from the body is the threshold,
and other subtrees that reach it give their own largest-sum node. A content
node inside an article or main element stands for that whole element.

Text is joined by blocks in page order, white space inside a block is one
space, character references are decoded. Nothing is cut: whole pages are read
in time linear in their length, without recursion, one page at a time.

Null or empty pages give an empty text, and so does a page of furniture only;
a text without markup is its own content. Repeated pages are extracted each;
columns that are not named are ignored. No shuffle.
"""

import html
import math
import re

import pyarrow as pa

from pyspark.sql import DataFrame, functions as F, types as T

# Element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
FURNITURE = set(
    "head title script style noscript template iframe svg math canvas object nav footer aside button select textarea input "
    "dialog menu audio video map".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
# An element of the first kind is closed by the start of one of the second kind.
CLOSED_BY = {
    "p": BLOCKS - {"li", "dd", "dt", "td", "th", "tr", "option", "caption", "tbody", "thead", "tfoot", "legend", "summary",
                   "figcaption"},
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "th": {"td", "th", "tr", "tbody", "tfoot", "thead"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "option": {"option"},
    "head": {"body"},
}
CLOSES = {name: [inner for inner, names in CLOSED_BY.items() if name in names] for name in set().union(*CLOSED_BY.values())}
SCOPES = set("table ul ol dl div article section main aside nav footer header form body html blockquote select".split())
# Words in a class or id that name furniture. Those of the first two kinds count only where every word of
# the name is of one of the four kinds (`no-comments` and `social-history` are no furniture), those of the third anywhere.
SURE = re.compile(
    r"^(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|newsletter|subscribe|breadcrumb\w*|pagination|"
    r"pager|share|sharing|social|signup|login|popup|modal|notice|notification\w*|disclaimer)$")
READERS = re.compile(r"^(?:comment|comments|commentlist|commentary|disqus|replies|respond)$")
LIKELY = re.compile(
    r"^(?:nav\w*|menu\w*|sidebar\w*|footer|header|masthead|banner|related|recommended|widget\w*|toolbar|topbar|alert|rail)$")
HOLDER = re.compile(
    r"^(?:area|bar|block|body|bottom|box|button|buttons|container|content|form|group|icons|inner|item|left|link|links|list|outer|"
    r"right|section|site|slot|thread|top|unit|wrap|wrapper|\d+|)$")
# Share of the page's text from which an element named as furniture is the content: reader comments often outgrow it.
MOST = {1: 0.5, 3: 0.95, 4: 0.9}
# A quote starts a value only right after "="; elsewhere it is a character like any other.
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=(?:\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*))?)*+)>")
PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
SPACES = re.compile(r"\s+")
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


def _hint(attributes, name):
    """2: furniture; 1 (3 for reader comments, 4 for hidden parts): furniture unless it holds the article or most of the text.

    0: neither.

    -1: an article or main element named as reader comments, which is not the article.
    """
    hint = 0
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if name in ("body", "html"):
            continue
        if key == "hidden":
            return 2
        if key == "aria-hidden":
            hint = hint or 4 * (value.lower() == "true")
        elif key == "style":
            hint = hint or 4 * bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key == "role":
            if value.lower() in ROLES:
                return 2
        elif key in ("class", "id"):
            for own in value.split():
                words = [word.lower() for word in SPLIT.split(own)]
                if any(map(LIKELY.match, words)):
                    hint = hint or 1
                if all(any(kind.match(word) for kind in (SURE, READERS, LIKELY, HOLDER)) for word in words):
                    if any(map(READERS.match, words)):
                        hint = 3
                    elif any(map(SURE.match, words)):
                        hint = hint or 1
    if name in ("article", "main"):
        return -1 if hint == 3 else 0
    return hint


class Page:
    """The tree of a page as lists by node number; a parent's number is smaller than its children's."""

    def __init__(self, text):
        self.names, self.parents, self.hints, self.parts = ["#root"], [-1], [0], [[]]
        self.read(text)

    def read(self, text):
        open_, at, size, final = [0], 0, len(text), text.rfind(">")
        names, parts = self.names, self.parts
        # Places in `open_` by name, of blocks and of scopes, so that no tag looks through the open elements.
        places, blocks, scopes = {}, [0], [0]

        def cut(place):
            """End the open elements from a place on."""
            for node in reversed(open_[place:]):
                places[names[node]].pop()
                if names[node] in BLOCKS:
                    blocks.pop()
                if names[node] in SCOPES:
                    scopes.pop()
            del open_[place:]

        while at < size:
            start = text.find("<", at)
            if start < 0:
                parts[open_[-1]].append(text[at:])
                break
            if start > at:
                parts[open_[-1]].append(text[at:start])
            after = text[start + 1:start + 2]
            if after == "!" or after == "?":
                if text.startswith(("<!-->", "<!--->"), start):
                    at = text.find(">", start) + 1
                elif text.startswith("<!--", start):
                    end = COMMENT_END.search(text, start + 4)
                    at = size if end is None else end.end()
                else:
                    at = text.find(">", start) + 1 or size
                continue
            if after == "/":
                first = text[start + 2:start + 3]
                if not (first.isalpha() and first.isascii()):
                    # An end tag without a name is a comment up to the next ">", and plain text if there is none.
                    if start < final:
                        at = text.find(">", start) + 1
                    else:
                        parts[open_[-1]].append("</")
                        at = start + 2
                    continue
            tag = (TAG.match(text, start) or PLAIN_TAG.match(text, start)) if after == "/" or after.isalpha() else None
            if tag is None:
                if after == "/" or after.isalpha() and after.isascii():
                    break  # a tag that never ends
                parts[open_[-1]].append("<")
                at = start + 1
                continue
            at, name = tag.end(), tag[2].lower()
            if tag[1]:
                # The end tag of an inline element does not reach over a block.
                if places.get(name) and (name in BLOCKS or places[name][-1] > blocks[-1]):
                    cut(places[name][-1])
                elif name == "p":
                    self.add("p", open_[-1], 0)
                continue
            if name in ("html", "body") and places.get(name):
                continue
            # The start of an element ends the innermost one that it closes, up to the innermost scope.
            closed = max((places[inner][-1] for inner in CLOSES.get(name, ()) if places.get(inner)), default=0)
            if closed > scopes[-1]:
                cut(closed)
            node = self.add(name, open_[-1], _hint(tag[3], name) if tag[3] else 0)
            if name in RAW:
                end = RAW_END[name].search(text, at)
                at = size if end is None else text.find(">", end.end()) + 1 or size
            elif name not in VOID and not (tag[3].endswith("/") and name in ("svg", "path", "use")):
                open_.append(node)
                places.setdefault(name, []).append(len(open_) - 1)
                if name in BLOCKS:
                    blocks.append(len(open_) - 1)
                if name in SCOPES:
                    scopes.append(len(open_) - 1)

    def add(self, name, parent, hint):
        self.names.append(name)
        self.parents.append(parent)
        self.hints.append(hint)
        self.parts.append([])
        node = len(self.names) - 1
        self.parts[parent].append(node)
        return node

    def content(self):
        """Numbers of the content nodes, and for every node whether it is left out."""
        names, parents, n = self.names, self.parents, len(self.names)
        size = [sum(len(SPACES.sub("", p)) for p in own if isinstance(p, str)) for own in self.parts]
        # First pass: text below every node, and whether an article is there.
        text = size[:]
        article = [name in ("article", "main") and hint >= 0 for name, hint in zip(names, self.hints)]
        for i in range(n - 1, 0, -1):
            text[parents[i]] += text[i]
            article[parents[i]] |= article[i]
        inside, out = [False] * n, [False] * n
        for i in range(1, n):
            up = parents[i]
            inside[i] = inside[up] or names[i] in ("article", "main")
            likely = self.hints[i] in MOST and not article[i] and text[i] < MOST[self.hints[i]] * text[0]
            # Server-side frameworks put a whole page into one form.
            form = names[i] == "form" and not article[i] and text[i] < MOST[1] * text[0]
            out[i] = (out[up] or names[i] in FURNITURE or form or self.hints[i] == 2 or likely
                      or names[i] == "header" and not inside[i] and not article[i])
        # Second pass: characters, tags, link characters and link tags of what is left.
        chars, tags, links, anchors = [0] * n, [0] * n, [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            if out[i]:
                continue
            chars[i] += size[i]
            if names[i] == "a":
                links[i], anchors[i] = chars[i], tags[i]
            if i:
                up = parents[i]
                chars[up] += chars[i]
                tags[up] += tags[i] + 1
                links[up] += links[i]
                anchors[up] += anchors[i] + (names[i] == "a")
        body = next((i for i in range(n) if names[i] == "body" and not out[i]), 0)
        share = links[body] / max(chars[body], 1)

        def density(i):
            c, t, lc, lt = chars[i], max(tags[i], 1), max(links[i], 1), max(anchors[i], 1)
            if not c:
                return 0.0
            base = math.log(c / max(c - links[i], 1) * lc + share * c + math.e)
            return c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(base)

        dense = [0.0 if out[i] else density(i) for i in range(n)]
        sums, best = [0.0] * n, list(range(n))
        for i in range(n - 1, -1, -1):
            if out[i]:
                continue
            if not sums[i]:
                sums[i] = dense[i]  # a leaf
            if i:
                sums[parents[i]] += dense[i]
        for i in range(n - 1, 0, -1):
            if not out[i] and sums[best[i]] > sums[best[parents[i]]]:
                best[parents[i]] = best[i]
        top = best[body]
        path, i = [], top
        while i != body and i > 0:
            path.append(i)
            i = parents[i]
        threshold = min(dense[i] for i in [*path, body])
        chosen, walk = set(), [body]
        while walk:
            i = walk.pop()
            if out[i] or not chars[i] or dense[i] < threshold:
                continue
            chosen.add(best[i])
            walk.extend(p for p in self.parts[i] if not isinstance(p, str))
        for i in list(chosen):
            while i > 0 and names[i] not in ("article", "main"):
                i = parents[i]
            if i > 0:
                chosen.add(i)
        if chosen and not inside[top] and names[top] not in ("article", "main"):
            # Without an article element, the headings right before the content belong to it.
            chosen.update(p for p in self.parts[max(parents[top], 0)]
                          if not isinstance(p, str) and p < top and names[p] in HEADINGS)
        elif chosen:
            chosen = {i for i in chosen if inside[i]}
        return chosen, out

    def text(self):
        chosen, out = self.content()
        blocks, run, names = [], [], self.names

        def finish():
            block = SPACES.sub(" ", "".join(run)).strip()
            if block:
                blocks.append(block)
            run.clear()

        # (node, place in its parts, taken or not) on a stack, so that deep pages need no recursion.
        stack = [[0, 0, 0 in chosen]]
        while stack:
            node, place, taken = stack[-1]
            if place == 0 and names[node] in BLOCKS:
                finish()
            if place == len(self.parts[node]):
                stack.pop()
                if names[node] in BLOCKS:
                    finish()
                continue
            stack[-1][1] += 1
            part = self.parts[node][place]
            if isinstance(part, str):
                if taken:
                    run.append(html.unescape(part))
            elif not out[part]:
                if names[part] == "br":
                    run.append(" ")
                elif names[part] not in VOID:
                    stack.append([part, 0, taken or part in chosen])
        finish()
        return "\n".join(blocks)


def main_text(page):
    return Page(page).text() if page else ""


def extract(pages: DataFrame, id="page_id", url="url", markup="html") -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of `pages`."""
    kept = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{markup}`").alias("html"))
    schema = T.StructType([kept.schema["id"], kept.schema["url"], T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(texts, pa.string())], names=["id", "url", "text"])

    return kept.mapInArrow(run, schema).select(
        F.col("id").alias(id), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))

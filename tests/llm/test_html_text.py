import pytest

from qa_analytics.llm import html_text

PARA = "A paragraph with enough words to look like the text of an article, and a second part of it."
CASES = [
    ("", ""), ("plain  text\nonly", "plain text only"), ("<p>one<p>two &amp; &eacute;&#33;</p>", "one\ntwo & é!"),
    (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=/>home</a></nav><article><h1>Head</h1><p>{PARA}<br>x"
     f"</p></article><footer>&copy; us</footer><script>var a='</p>'</script>", f"Head\n{PARA} x"),
    (f"<body><div id=header><a href=/>Site</a></div><div><h1>Head</h1><div><p>{PARA}</p><p>{PARA}</p></div></div>"
     f"<div class='side-bar sidebar'><ul><li><a>a</a><li><a>b</a></ul></div><section id=comments><p>{PARA} {PARA} {PARA} {PARA}</p>"
     "</section></body>", f"Head\n{PARA}\n{PARA}"),
    (f"<main><p>{PARA}</p><aside>Related</aside><form><p>Mail: <input></p></form><div class='ad-box ad'>Buy</div><p>{PARA}", f"{PARA}\n{PARA}"),
    ("<nav><a>only</a></nav><footer>furniture</footer>", ""), ("<!-- never closed <p>x", ""), ("a < b <3 <p", "a < b <3"),
    ("<ul><li>one<li>two</ul><table><tr><td>c<td>d</table>", "one\ntwo\nc\nd"), ("<p>R&am</p>p;", "R&am\np;"),
    ("<div>" * 5000 + "deep" + "</b>" * 5000, "deep"), ("<p hidden>x</p><p style='display: none'>y</p><p>z", "z"),
    ("<p>one &nbsp;\t two</p><pre>a\n  b</pre>", "one two\na b"), ("<b><p>bold<p>on</b> and on", "bold\non and on"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_table_with_nulls_and_repeats(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p>a b</p>", "n"), (1, "u", "<p>a b</p>", "n"), (None, None, None, None), (2, "", "", "")],
        "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [("1", "u", "a b", 3), ("1", "u", "a b", 3), ("2", "", "", 0), ("None", "None", "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_markup_that_never_closes_stays_fast():
    assert html_text.main_text("<p>" * 30_000 + "</b>" * 30_000 + "<" * 30_000).count("<") == 30_000
    assert html_text.main_text("<a href=\"x" * 3_000) == ""


@pytest.mark.parametrize("page,text", [
    ("<p>one</>two</p><p>three", "onetwo\nthree"), ("<p>one</ p>two</p><p>three", "onetwo\nthree"),
    ("<p>love </3 it</p><p>three", "love\nthree"), ("<p>one</p>a </3 b", "one\na </3 b"), ("<p>one</p></", "one\n</"),
    ("<p>one</\u00e9>two", "onetwo")])
def test_text_after_an_end_tag_without_a_name_stays(page, text):
    assert html_text.main_text(page) == text


def test_many_end_tags_without_a_name_stay_fast():
    assert html_text.main_text("<p>x</p>" + "</ " * 100_000).count("</") == 100_000
    assert html_text.main_text("</ >" * 100_000 + "x") == "x"


@pytest.mark.parametrize("wrapper", [
    "<div class='post no-comments'>", "<div class='site has-ads'>", "<section id='social-history'>", "<div class=social>",
    "<div id=content class='notice'>", "<div class=comments>"])
@pytest.mark.parametrize("article", [f"<div><p>{PARA}</p><p>{PARA}</p></div>", f"<article><p>{PARA}</p><p>{PARA}</p></article>"])
def test_a_wrapper_named_like_furniture_keeps_the_article(wrapper, article):
    page = f"<body><nav><a href=/>home</a></nav>{wrapper}{article}</{wrapper[1:].split()[0]}><footer>us</footer></body>"
    assert html_text.main_text(page) == f"{PARA}\n{PARA}"


def test_one_word_of_a_compound_does_not_decide():
    parts = "".join(f"<div class='post {c}'><p>{PARA}</p></div>" for c in ("no-comments", "has-ads", "noticeBoardHistory"))
    assert html_text.main_text(f"<body><div>{parts}</div></body>") == f"{PARA}\n{PARA}\n{PARA}"


def test_small_furniture_and_reader_comments_still_go():
    small = "".join(f"<div class='{c}'>Small print</div>" for c in ("share", "social-share", "ad-container", "cookie-banner", "promoBox"))
    talk = f"<div id=comments class='comments-area'><ol><li class=comment><article class='comment-body'><p>{PARA}</p></article></ol></div>"
    page = f"<main><article><h1>Head</h1><p>{PARA}</p></article>{small}{talk * 3}</main>"
    assert html_text.main_text(page) == f"Head\n{PARA}"


@pytest.mark.parametrize("page,text", [
    (f"<body><!--><p>{PARA}</p>", PARA), (f"<body><!---><p>{PARA}</p>", PARA), (f"<p>{PARA}</p><!-- x --!><p>{PARA}", f"{PARA}\n{PARA}"),
    (f"<p class=\"a\"\">{PARA}</p><p class=\"b\">{PARA}</p>", f"{PARA}\n{PARA}"),
    (f"<p title=it's>{PARA}</p><p title=it's>{PARA}</p>", f"{PARA}\n{PARA}"), (f"<p title='a > b'>{PARA}</p>", PARA),
    (f"<p title=\"see class=sidebar\">{PARA}</p>", PARA),
    (f"<body><form action=/><nav><a>home</a></nav><div><p>{PARA}</p><p>{PARA}</p></div><footer>us</footer></form>", f"{PARA}\n{PARA}"),
    (f"<body style='visibility:hidden'><p>{PARA}</p></body>", PARA),
    (f"<body><div aria-hidden=true><p>{PARA}</p></div></body>", PARA),
    (f"<body><div style='display:none'><p>Menu</p></div><div><p>{PARA}</p></div></body>", PARA),
    ("<ul><li>one" + "<b>" * 40 + "x<li>two</ul>", "onex\ntwo")])
def test_articles_survive_odd_markup(page, text):
    assert html_text.main_text(page) == text


def test_many_open_elements_stay_fast():
    assert html_text.main_text("<b>" * 30_000 + "<ul>" + "<li>x" * 30_000).count("x") == 30_000


def plain_content(page):
    """The content node by the definition: every node's counts and density by walking its whole subtree."""
    import math
    tree = html_text.Page(page)
    _, out = tree.content()
    children = lambda i: [p for p in tree.parts[i] if not isinstance(p, str) and not out[p]]

    def under(i):
        return [i] + [d for c in children(i) for d in under(c)]

    def chars(nodes):
        return sum(len("".join(p.split())) for n in nodes for p in tree.parts[n] if isinstance(p, str))

    def counts(i):
        nodes = under(i)
        links = [n for n in nodes if tree.names[n] == "a"]
        linked = {d for n in links for d in under(n)}
        return chars(nodes), len(nodes) - 1, chars(linked), len(linked) - (tree.names[i] == "a")

    body = next((i for i, n in enumerate(tree.names) if n == "body" and not out[i]), 0)
    c_body, _, l_body, _ = counts(body)

    def density(i):
        c, t, lc, lt = counts(i)
        if not c:
            return 0.0
        t, l1, lt = max(t, 1), max(lc, 1), max(lt, 1)
        base = math.log(c / max(c - lc, 1) * l1 + l_body / max(c_body, 1) * c + math.e)
        return c / t * math.log(max(c / l1 * t / lt, 1.0)) / math.log(base)

    sums = {i: sum(density(c) for c in children(i)) or density(i) for i in under(body)}
    return sums, max(sums.values()), tree


@pytest.mark.parametrize("seed", range(25))
def test_the_largest_density_sum_is_chosen(seed):
    import random
    rng = random.Random(seed)

    def node(depth):
        name = rng.choice(["div", "p", "span", "a", "section"])
        inner = "" if name == "a" else "".join(node(depth - 1) for _ in range(rng.randint(0, 3 if depth else 0)))
        return f"<{name}>{rng.choice(['', 'word ', 'some more words here '])}{inner}</{name}>"

    page = "<body>" + "".join(f"<div>{node(3)}</div>" for _ in range(3)) + "</body>"
    sums, most, tree = plain_content(page)
    chosen, _ = tree.content()
    if most > 0:
        assert max(sums[i] for i in chosen if i in sums) == pytest.approx(most)

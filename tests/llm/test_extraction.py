from __future__ import annotations

import html
import re

from burnlens.llm import extraction as X

PAGES = "page_id long, url string, html string, host string, fixed string, token long, text string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "f", 1, "t") for r in rows], PAGES)


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_articles_of_the_table(data):
    src = data("pages")
    got = {r.page_id: (r.text, r.n_chars, r.url) for r in X.extract(src).collect()}
    for r in src.collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html or "", re.S)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body[1])] if body else []
        want = "\n\n".join(p for p in parts if p)
        assert got[r.page_id] == (want, len(want), r.url)


def test_what_is_not_main_text():
    page = """<html><head><title>T</title></head><body><header>H</header><nav><a>N</a></nav><main><h1>A &amp;  B</h1>
    <p>One <b>two</b>\n three<br>four<p>Five &lt;six&gt;<script>var x = "<p>no</p>";</script><style>p{}</style>
    <div class="ad-slot">Buy</div><div id="comments"><p>Nice!</p></div><aside>S</aside><form><input value="q">F</form>
    <div class="cookie-notice">C</div><ul><li>l1<li>l2</ul><!-- c > --><div role="navigation">R</div><pre>x
    y</pre></main><footer>F</footer>"""
    assert X.main_text(page, frozenset()).split("\n\n") == ["A & B", "One two three four", "Five <six>", "l1", "l2", "x y"]


def test_broken_markup():
    for page, want in [("", ""), ("plain &am text", "plain &am text"), ("<p>a<p>b", "a\n\nb"), ("a < b <p>c", "a < b\n\nc"), ("<p>x<scr", "x"),
                       ("</div></p>y", "y"), ("<script>never closed <p>z", ""), ("<p title='a>b'>q</p>", "q"), ("<" * 50, "<" * 50),
                       ("<div>" * 3000 + "deep", "deep"), ("<p>caf&eacute;&#33;&nbsp;x", "café! x")]:
        assert X.main_text(page, frozenset()) == want


def test_template_of_a_host_without_article(spark):
    frame = "<div><p>Site name</p><p>Top stories</p><p>Imprint and contact</p></div><div>{}</div><p>All of it since 1999</p>"
    rows = [(i, f"https://Site.example/{i}", frame.format(f"<p>Story {i}</p><p>More of {i}</p>")) for i in range(8)]
    rows += [(100, "https://other.example/", frame.format("<p>Alone</p>")), (101, None, None), (102, "x", ""), (3, "https://site.example/3", rows[3][2])]
    got = texts(X.extract(pages(spark, rows)))
    assert all(got[i] == f"Story {i}\n\nMore of {i}" for i in range(8))
    assert got[100].startswith("Site name") and got[101] == got[102] == ""
    assert X.extract(pages(spark, [])).count() == 0


def test_repeated_pages_keep_their_articles(spark):
    page = "<nav>N</nav><article><h1>Same</h1><p>everywhere</p></article>"
    got = X.extract(pages(spark, [(i, "http://a.b/", page) for i in range(30)])).collect()
    assert len(got) == 30 and {r.text for r in got} == {"Same\n\neverywhere"}


ARTICLE = "<article><h1>T</h1><p>Body one.</p><p>Body two.</p></article>"


def test_pages_that_lost_their_text():
    """Legal and broken pages whose article must come out whole."""
    for page in [
        "<html><head><title>x</title><meta a=b><body>" + ARTICLE, "<html><head><title>x</title>" + ARTICLE, "<head><script>a</script>" + ARTICLE,
        "<body class='single has-sidebar'>" + ARTICLE, "<html class='no-js menu'><body id='page-header' class='sidebar'>" + ARTICLE,
        "<div class='widget related'>" + ARTICLE + "</div><p class='related'>no</p>", ARTICLE.replace("<p>Body two", "<svg viewBox='0 0'/><p>Body two"),
        ARTICLE.replace("<p>Body two", "<div><button>x</div><p>Body two"), ARTICLE.replace("<p>Body two", "<div><svg><path d='M0'></div><p>Body two"),
        ARTICLE.replace("<p>Body two", "<div><script>var a; </div><p>no</p></script><p>Body two"),
        ARTICLE.replace("<p>Body two.", "<p class='ad'>Buy</p><p>Body <span class='ad'>now <b>or</b> never</span> two."),
        ARTICLE.replace("<p>Body two.", "<p>Body <span class='ad'>now <span>x</span> y</span>two."),
        ARTICLE + "<article class='card'><h2>Teaser</h2><p>more of it here</p></article>", "<article><h2>other</h2></article>" + ARTICLE,
        "<main><div>crumbs</div>" + ARTICLE + "</main>", ARTICLE.replace("</article>", "<article><p>A reader says</p></article></article>"),
        "<header class='header'><p>Site</p></header><div class='header'>" + ARTICLE + "</div>",
    ]:
        assert X.main_text(page, frozenset()) == "T\n\nBody one.\n\nBody two.", page
    keeps = "<article><h1>T</h1><div class='side-effects'><p>a</p></div><div class='discussion'><p>b</p></div><figure><figcaption>c</figcaption></figure>" \
            "<fieldset><p>d</p></fieldset><p>e <math><mi>x</mi></math> f</p></article>"
    assert X.main_text(keeps, frozenset()).split("\n\n") == ["T", "a", "b", "c", "d", "e", "x", "f"]
    cards = "<div><p>The long body of this page lies outside of every article element.</p></div><article><h3>Card</h3></article><article><h3>Card 2</h3></article>"
    assert X.main_text(cards, frozenset()) == "The long body of this page lies outside of every article element."


def test_long_and_broken_pages_take_linear_time():
    import time
    for page in ["<p>word " * 200_000, "<a title=\"x " * 50_000, "<p class='" * 50_000, "<script>" * 50_000 + "x", "<div>" * 100_000, "<!-- " * 100_000]:
        start = time.perf_counter()
        X.main_text(page, frozenset())
        assert time.perf_counter() - start < 20


def brute_template(pages_of_host):
    """Equivalence classes straight from the definition."""
    from collections import Counter, defaultdict
    distinct = list(dict.fromkeys(pages_of_host))
    counts = [Counter((b.path, b.text) for b in X.blocks(p)) for p in distinct]
    classes = defaultdict(list)
    for token in set().union(*counts):
        classes[tuple(c[token] for c in counts)].append(token)
    fixed = set()
    for vector, tokens in classes.items():
        n = sum(v > 0 for v in vector)
        if n >= X.MIN_PAGES and n >= X.SUPPORT * len(distinct) and len(tokens) >= X.MIN_TOKENS:
            fixed |= {X._hash(*t) for t in tokens if t[1]}
    return fixed


def test_templates_equal_their_definition(spark, data):
    frame = "<body><div class='top'><p>Brand</p><p>Slogan</p></div><article><h1>H {}</h1><p>text {}</p><p>Read our guide.</p><p>Support us.</p></article><p>Ends</p>"
    rows = [(i, "http://x.y/", frame.format(i % 5, i)) for i in range(12)] + [(20 + i, "http://x.y/", frame.format(9, 9)) for i in range(30)]
    rows += [(60, "http://z/", frame.format(1, 1)), (61, "http://z/", "<p>only</p>"), (None, "http://z/", None)]
    rows += [(10**6 + r.page_id, r.url, r.html) for r in data("pages").collect()]
    df = pages(spark, rows)
    by_host = {}
    for r in X._source(df).collect():
        by_host.setdefault(r.host, []).append(r.html)
    want = {h: f for h, p in by_host.items() if (f := brute_template(p))}
    assert {r.host: set(r.fixed) for r in X.templates(df).collect() if r.fixed} == want and "x.y" in want
    got = {r.page_id: r.text for r in X.extract(df).collect()}
    assert got[3] == "H 3\n\ntext 3"  # the repeated lines in the article go
    assert got[25] == "H 9\n\ntext 9"  # thirty copies count once
    assert got[60] == "H 1\n\ntext 1\n\nRead our guide.\n\nSupport us."


def test_pages_that_are_all_template_keep_their_text(spark):
    """The same article on every distinct page of a host (other navigation)."""
    rows = [(i, "http://q/", f"<nav>{i}</nav><div><p>Brand</p></div>" + ARTICLE) for i in range(6)]
    assert set(texts(X.extract(pages(spark, rows))).values()) == {"T\n\nBody one.\n\nBody two."}


def test_classes_are_ordered(spark):
    """Four texts that are on every page, in changing order, are data; two blocks that change places stay template."""
    tags = ["red", "green", "blue", "grey"]
    first, second = ("".join(f"<div class='{c}{i}'><p>{c} {i}</p></div>" for i in range(4)) for c in "xy")
    rows = []
    for i in range(8):
        turned = "".join(f"<p>{t}</p>" for t in tags[i % 4:] + tags[:i % 4])
        rows.append((i, "http://o/", f"<div class='top'><p>Brand</p><p>Slogan</p></div>{first + second if i % 3 else second + first}"
                                     f"<div class='body'><p>Story {i}</p>{turned}</div><p>Ends</p>"))
    got = texts(X.extract(pages(spark, rows)))
    assert got == {i: "\n\n".join([f"Story {i}", *tags[i % 4:], *tags[:i % 4]]) for i in range(8)}


def test_tokens_are_told_apart_by_the_classes_around_them(spark):
    """The same line ends every page, and now and then it also stands among a page's own lines."""
    rows = []
    for i in range(9):
        own = f"<p>Story {i}</p>" + "<p>Read our guide.</p>" * (i % 3)
        rows.append((i, "http://r/", f"<div><p>Brand</p><p>Slogan</p></div><div><p>Start</p></div><div><p>On air</p>{own}<p>Off air</p><p>Read our guide.</p></div>"))
    df = pages(spark, rows)
    assert texts(X.extract(df)) == {i: "\n\n".join([f"Story {i}", *["Read our guide."] * (i % 3)]) for i in range(9)}
    assert [len(r.levels) > 0 for r in X.templates(df).collect()] == [True]


def test_classes_nest():
    strong, weak = X.Level([[1, 2, 3, 4], [5, 6, 7, 8]]), (1, X.CROSSED, 0, 0)
    assert strong.votes([1, 2, 5, 6, 3, 4, 7, 8]) == {weak} == strong.votes([5, 1, 6, 2, 3, 4, 7, 8])
    assert strong.votes([1, 5, 6, 7, 8, 2, 3, 4, 5, 6, 7, 8]) == {(0, X.INSIDE, -1, 0), (1, X.INSIDE, 0, 0), (1, X.INSIDE, -1, 0)}
    assert strong.votes([1, 1, 2, 2, 3, 3, 4, 4]) >= {(0, X.OUT_OF_ORDER, i, 0) for i in range(4)}
    classes = [[1, 2, 3, 4], [5, 6, 7, 8]]
    assert X.judged(classes, [weak]) == X.judged(classes, [(1, X.INSIDE, 0, 0), (1, X.INSIDE, -1, 0), (0, X.INSIDE, -1, 0)]) == classes[:1]
    assert X.judged(classes, [(0, X.INSIDE, -1, 0), (1, X.INSIDE, 0, 2)]) == classes
    inside = strong.refine([1, 9, 2, 9, 9, 3, 4, 9])
    assert inside[1] != inside[3] == inside[4] != 9 == inside[7] and inside[0] == 1


def test_a_class_in_two_places_of_another_is_told_apart(spark):
    box = "<div class='box'><p>Ask us</p><p>Write to us</p><p>Call us</p></div>"
    rows = [(i, "http://n/", f"<div class='a'><p>Brand</p><p>Slogan</p><p>Today</p></div>{box if i % 2 else ''}<p>Story {i}</p>"
                             f"<div class='z'><p>Imprint</p><p>Contact</p><p>Jobs</p></div>{'' if i % 2 else box}") for i in range(8)]
    assert texts(X.extract(pages(spark, rows))) == {i: f"Story {i}" for i in range(8)}

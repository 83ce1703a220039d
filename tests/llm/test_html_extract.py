import html
import re

from triplex.llm import html_extract

SCHEMA = "page_id long, url string, html string, text string, name string"


def article_of(page):
    """The article's text by its markup alone (the shape of the pages table)."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    inner = re.sub(r"<(?:/?p|/?h1|br)>", " ", inner)
    return " ".join(html.unescape(re.sub(r"</?b>", "", inner)).split())


def test_every_page_of_the_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    want = {r["page_id"]: article_of(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert got == want


PAGE = (
    "<html><head><title>T</title><style>x</style></head><body><nav><a>menu</a></nav><header>head</header>"
    "<div class='cookie-notice'>we use cookies <div>nested</div></div><article><h1>Title &amp; <b>bo</b>ld</h1>"
    "<script>if (a < b) '</p>'</script><p>one\n two&nbsp;three</p><div class=\"ad\">buy</div><!-- <p>no</p> -->"
    "<form><p>mail</p></form><p>four 5 &lt; 6</p></article><aside>side</aside>"
    "<section id=comments><p>a reader says very much here</p></section><footer>foot"
)


def test_cases(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<p>a</p>"), (5, "u", "<p>" + "word " * 200_000), (5, "u", "<p>x"), (6, "u", "<div <p 'q")]
    df = spark.createDataFrame([(*r, "t", "n") for r in rows], SCHEMA)
    got = [(r["page_id"], r["text"]) for r in html_extract.extract(df).collect()]
    assert len(got) == len(rows)
    assert dict(got)[1] == "Title & bold one two three four 5 < 6"
    assert ("a" in dict(got)[None]) and dict(got)[2] == dict(got)[3] == ""
    assert max(len(t) for i, t in got if i == 5) == 200_000 * 5 - 1
    assert html_extract.extract(df.limit(0)).count() == 0


def text_of(page):
    return html_extract.main_text(page, {html_extract.WORD: 1.0, html_extract.OTHER: -0.1})


def test_marks_in_the_names_of_layouts_do_not_drop_the_article():
    for around in ('<div class="layout has-sidebar">', '<div id="content-with-nav">', '<section class="search-results">', '<div class="sidebar">', "<form>"):
        name = around[1:].split()[0].strip(">")
        page = f"<body>{around}<nav><a>menu</a></nav><article><p>one two three</p></article></{name}><div class=ad-box>buy</div>"
        assert text_of(page) == "one two three", around
    assert text_of("<body><div class=page-header><p>" + "word " * 50 + "</div><p>x") == "word " * 50 + "x"
    assert text_of("<head><title>T</title><p>no body tag here") == "no body tag here"


def test_left_out_elements_end_where_html_ends_them():
    rest = "<p>four five six seven</p>"
    assert text_of(f"<article><p>one two three<p class=ad>buy<p>three{rest}</article>") == "one two three three four five six seven"
    assert text_of(f"<article><p>one</p><p class=ad>buy <b>now</b><div>two</div>{rest}</article>") == "one two four five six seven"
    assert text_of(f"<article><ul><li>one<li class='menu-item'>buy<ul><li>in</ul><li>two</ul>{rest}</article>").split() == "one two four five six seven".split()
    assert text_of(f"<article><dl><dt>one<dd class=ad>buy<dt>two</dl>{rest}</article>").split() == "one two four five six seven".split()
    assert text_of(f"<article><table><tr><td>one<td class=ad>buy<td>two<tr><td>3</table>{rest}</article>").split() == "one two 3 four five six seven".split()
    assert text_of(f"<article><div><div class=ad>buy<div>in</div></div>one</div>{rest}</article>") == "one four five six seven"


def test_best_region_against_all_regions():
    for scores in ([], [-1], [1, -2, 3, -1, 2, -5, 4], [2, -1, 2], [0, 1, 0], [-1, 5, -6, 5]):
        a, b = html_extract.best_region(scores)
        best = max([0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))])
        assert sum(scores[a:b]) == best


LEAD = "<p>" + " ".join(f"lead{i}" for i in range(12)) + "</p>"
ITEMS = "<ul>" + "".join(f"<li>item {i}</li>" for i in range(10)) + "</ul>"
CELLS = "<table>" + "<tr><td></td><td></td><td>x</td></tr>" * 30 + "</table>"
LONG = "<p>" + " ".join(f"word{i}" for i in range(200)) + "</p>"


def plain(markup):
    return " ".join(re.sub(r"<[^>]*>", " ", markup).split())


def test_lists_and_tables_at_the_edges_of_an_article_stay(spark):
    menus = "<nav><ul>" + "<li><a>menu entry</a></li>" * 30 + "</ul></nav><ul>" + "<li><a>more links</a></li>" * 40 + "</ul>"
    bodies = [LEAD + ITEMS + LONG, LEAD + CELLS + LONG, LONG + CELLS + LEAD, LONG + "<pre>code  here</pre>" + ITEMS, ITEMS * 4]
    rows = [(i, "u", f"<body>{menus}<article>{b}</article>{menus}", "t", "n") for i, b in enumerate(bodies)]
    rows += [(10 + i, "u", f"<body>{menus}<article>{LONG}</article>{menus}", "t", "n") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, body in enumerate(bodies):
        assert got[i] == plain(body), i


def test_without_labels_the_element_around_the_region_stays_whole():
    dear = {html_extract.WORD: 1.0, html_extract.OTHER: -1.0, "li": -3.0, "td": -3.0, "tr": -3.0}
    links = "<div>" + "<li><a>link</a></li>" * 9 + "</div>"
    page = f"<body>{links}<div class=post>{LEAD}{ITEMS}{CELLS}{LONG}</div>{links}"
    assert html_extract.main_text(page, dear) == plain(LEAD + ITEMS + CELLS + LONG)
    assert html_extract.main_text(f"<body>{links}{LONG}{links}", dear) == plain(LONG)


def test_element_spans_of_broken_markup():
    seen = [("div", "", False), ("section", "", False), ("/div", "", False), ("div", "", False), ("/x", "", False)]
    assert html_extract.element_spans(seen, ("div", "section")) == [(1, 3), (0, 3), (3, 5)]


def test_pages_without_labels_by_the_weights_of_others(spark, sf_small):
    """Every second page loses its ``article`` tags; the weights come from the labelled half."""
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_small}/pages.parquet").select("page_id", "url", "html").collect()]
    plain = lambda p: p.replace("<article>", "<div>").replace("</article>", "</div>")
    mixed = [(i, u, plain(p) if i % 2 else p) for i, u, p in pages]
    df = spark.createDataFrame(mixed, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    unlabelled = [i for i, _, _ in pages if i % 2]
    exact = sum(got[i] == article_of(dict((a, c) for a, _, c in pages)[i]) for i in unlabelled)
    assert unlabelled and exact >= 0.95 * len(unlabelled)
    assert all(got[i] == article_of(p) for i, _, p in pages if i % 2 == 0)


def test_articles_that_are_only_comments_do_not_win():
    said = "".join(f"<article class=comment-body><p>reader {i} says so</p></article>" for i in range(5))
    page = f"<body><div class=post>{LONG}{ITEMS}</div><div>{said}</div>"
    assert text_of(page).startswith(plain(LONG + ITEMS))
    assert text_of(f"<body><div class=x>{LEAD}</div><article>{LONG}</article>") == plain(LONG)

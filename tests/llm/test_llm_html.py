import html
import re
import time


from tessera.llm import html_extract as H
from tessera.llm.queries import op2_html

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string, n_chars string"


def article(page):
    """The text between the article's tags, block by block."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:h1|p|br)>", inner.group(1)) if inner else []
    texts = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts)
    return "\n".join(t for t in texts if t)


def test_query_gives_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op2_html(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_weights_are_learned_and_the_scan_finds_the_region(spark):
    w = H.fit(spark.read.parquet(f"{SF}/pages.parquet"), "page_id", "html")
    assert w["word"] > 0 and w["furniture"] < -1 and w["<li>"] < w["<p>"] < 0
    few = H.fit(spark.read.parquet(f"{SF}/pages.parquet"), "page_id", "html", labelled_pages=40)
    assert few["word"] > 0 > few["furniture"]
    for scores in ([1, -2, 3, -1, 2, -9, 4], [-1, -2], [], [0, 0], [2, -1, -1, 2]):
        sums = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)}
        top = max([0, *sums.values()])
        a, b = H.region(scores)
        assert sum(scores[a:b]) == top


PAGE = """<html><head><title>T</title><script>if (a<b) { x("<p>") }</script></head><body class="has-sidebar">
<div id="cookie-notice"><p>We use cookies to make this site work for you, accept them all please now.</p></div>
<div class="menu"><a href="/a">Home</a> <a href="/b">News</a></div>
<div id="content"><h1>Caf&eacute; &amp; bar</h1><p>One <b>bold</b>ed   text,
with a <a href="x" title="a > b">link in it</a> and more words to read here.</p>
<div class="ad-box">Buy now this thing</div><p>Second&nbsp;paragraph with quite some words in it &lt;here&gt;.</p>
<form><label>Mail</label><input name=q></form><ul><li>First item of list</li><li>Second item</li></ul>
<aside>Not this one</aside><p></p><p>Last paragraph, cut<br>in two.</div>
<div class="reader-comments"><p>I do not agree with any of this, and I say so at length here.</p></div>
<div class="sideBar">More and more</div><footer>&copy; them</footer></body></html>"""


def test_a_page_without_article(spark):
    want = "Café & bar\nOne bolded text, with a link in it and more words to read here.\nSecond paragraph with quite some words in it <here>.\nFirst item of list\nSecond item\nLast paragraph, cut\nin two."
    assert H.extract(PAGE, H.Weights()) == want
    learned = H.fit(spark.read.parquet(f"{SF}/pages.parquet"), "page_id", "html")
    assert H.extract(PAGE.replace('<div id="content">', "<article>").replace("two.</div>", "two.</article>"), learned) == want


def test_odd_pages(spark):
    w = H.Weights()
    assert H.extract(None, w) == H.extract("", w) == H.extract("<p></p>", w) == H.extract("<!-- only", w) == ""
    assert H.extract("plain words", w) == "plain words"
    assert H.extract("<p>cut in a tag <b", w) == "cut in a tag"
    assert H.extract("<nav><p>never closed, so it is no menu</p>", w) == "never closed, so it is no menu"
    assert H.extract("a < b and c > d", w) == "a < b and c > d"
    assert H.extract('<a "' * 3000, w) is not None
    assert H.extract("<div>" * 3000 + "deep down there" + "</div>" * 3000, w) == "deep down there"
    assert H.extract("<p>" + "word " * 200_000 + "</p>", w) == ("word " * 200_000).strip()
    rows = [(1, "u", None, "", ""), (2, None, "", "", ""), (None, "u", "<p>no id here</p>", "", ""), (3, "u", PAGE, "", ""), (3, "u", PAGE, "", "")]
    got = H.extract_table(spark.createDataFrame(rows, SCHEMA), ["page_id", "url"]).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == sorted((p or 0, H.extract(h, w)) for p, _, h, *_ in rows)
    assert H.extract_table(spark.createDataFrame([], SCHEMA), ["page_id"]).count() == 0


MAIN = "<h2>Title here</h2><p>The main text of this page has quite a few words, and all of them are wanted.</p><p>So has its second paragraph.</p>"
TEXT = "Title here\nThe main text of this page has quite a few words, and all of them are wanted.\nSo has its second paragraph."
ROUND = '<div class="menu"><a href="/a">Home</a></div>{}<div class="comments"><p>I beg to differ, at some length.</p></div><footer>&copy; them</footer>'


def test_wrappers_are_no_furniture():
    w = H.Weights()
    for begin in (
        '<div class="page has-sidebar">', '<div class="no-header wrapper">', '<div class="layoutWithSidebar">', '<form id="aspnetForm">',
        '<div class="sidebar-left">', '<div id="page-header-footer">', '<section class="widget">', "<header>",
    ):
        end = f"</{re.match('<([a-z]+)', begin).group(1)}>"
        for main in (MAIN, f"<article>{MAIN}</article>", f"<main>{MAIN}</main>", f"<article class='post no-comments'>{MAIN}</article>"):
            assert H.extract(f"<body>{begin}{ROUND.format(main)}{end}</body>", w) == TEXT, begin
            assert H.extract(f"<body>{ROUND.format(begin + main + end)}</body>", w) == TEXT, begin
            assert H.extract(f"<body><div>{begin}<form>{begin}{main}{end}</form>{end}</div></body>", w) == TEXT, begin
    assert H.extract('<div class="sidebar"><p>Three words only</p></div>', w) == ""
    assert H.extract('<div class="menu">' * 3000 + "deep down there" + "</div>" * 3000, w) == ""


def test_teasers_are_furniture():
    w = H.Weights()
    teaser = '<aside class="related"><article><h3>Other</h3><p>A teaser of another page</p></article></aside>'
    for main in (MAIN, f"<article>{MAIN}</article>", f"<main>{MAIN}</main>"):
        for page in (main + teaser, teaser + main, main.replace("</p><p>", f"</p>{teaser}<p>"), f'<form id="f">{teaser}{main}</form>'):
            assert H.extract(f"<body>{page}</body>", w) == TEXT
    assert not H.Page(f"<body>{MAIN}{teaser}</body>").marked
    page = H.Page(f"<body><article>{MAIN}</article>{teaser}</body>")
    assert page.marked and sum(page.content) == page.kind.index("aside") - page.kind.index("article")
    # comments of an article, longer than it
    comments = '<div class="comments">' + 9 * f'<article class="comment"><p>{20 * "No and "}</p></article>' + "</div>"
    assert H.extract(f'<body><div class="sidebar-page"><article>{MAIN}</article>{comments}</div></body>', w) == TEXT


def test_quoted_values_of_any_length():
    w = H.Weights()
    data = '<div class="menu">'.replace('"', "&quot;") + "<p>words in a value</p> " * 500 + "a > b"
    for value in (f'"{data}"', f"'{data}'", f" = '{data}'"[3:], f"'{{\"class\": \"menu\", \"id\"=\"nav\"}}{data}'"):
        assert len(value) > 11_000
        assert H.extract(f"<p>The text <b data-x={value} title='x'>goes</b> on here.</p>", w) == "The text goes on here."
        assert H.extract(f"<div data-x = {value}><p>The text goes on here.</p></div>", w) == "The text goes on here."
    # quotes open a value only after =; a value that is not closed ends with its tag
    assert H.extract("<p class=a don't>It is</p><p>so, isn't it</p>", w) == "It is\nso, isn't it"
    assert H.extract('<p title="open>It is so</p>', w) == "It is so"
    assert H.extract('<p title=a="b>It is so</p><p class="x">and so on</p>', w) == "It is so\nand so on"
    for piece in ('<a "="', "<a b='", '<a ="" "="', "<a =\"'='", '<a b="<"'):
        begin = time.process_time()
        assert H.extract(piece * 100_000, w) is not None
        assert H.extract(piece * 100_000 + '"<', w) is not None
        assert time.process_time() - begin < 20


def test_share_of_labelled_pages_is_never_nothing():
    for n in (1, 3999, 4000, 4001, 10**6, 5 * 10**9, 10**13):
        limit = H.hash_limit(n, 4000)
        assert 0 < limit <= 1 << 62
        assert abs(limit / (1 << 62) - min(1, 4000 / n)) < 1e-15

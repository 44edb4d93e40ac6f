import html
import random
import re
from collections import Counter

import pytest

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import queries
from ticketgrain.llm.html_extraction import Page, extract_text


def main_text(page):
    return "\n".join(b for b in Page(page).extract()[0] if b)


def pages(spark, rows):
    filled = [(i, u, h, *("?" * 6)) for i, u, h in rows]
    schema = "page_id long, url string, html string, text string, key string, host string, blocks string, `a.b` string, gone string"
    return spark.createDataFrame(filled, schema)


def texts(spark, rows, **options):
    found = extract_text(pages(spark, rows), **options)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    out = found.collect()
    assert all(r.n_chars == len(r.text) for r in out) and len(out) == len(rows)
    assert Counter((r.page_id, r.url) for r in out) == Counter((i, u) for i, u, _ in rows)
    return {r.page_id: r.text for r in out}


ARTICLE = "<h1>Title &amp; all</h1><p>First  para\n graph.</p><p>Second <b>bold</b>, <i>it</i>alic.</p>"
WANTED = "Title & all\nFirst para graph.\nSecond bold, italic."


@pytest.mark.parametrize(
    "page",
    [
        "<article>{}</article>",
        "<html><head><title>t</title><script>var a='</p><article>';</script></head><body><nav>x</nav><article>{}</article><footer>y</footer>",
        "<body><header><h2>Site</h2></header><main><article class='post no-sidebar'>{}<aside>more</aside></article></main></body>",
        "<div id=sidebar>left</div><div class='content'>{}</div><div class='site-footer'>&copy; 2024</div>",
        "<ARTICLE>{}<FORM action=x><p>Name <input></p></FORM><section id='comments'><p>Nice!</p><article>Me too</article></section></ARTICLE>",
        "<article>{}<div class='comment-list'><p>one</p></div><div class='adSlot'>buy</div><p hidden>no</p><p style='display: none'>no</p></article>",
        "<div role=navigation>menu</div><div role=main>{}</div><div role=alert>cookies!</div>",
        "<article><header class=h><div>By me</div><h1>Title &amp; all</h1></header><p>First  para\n graph.<p>Second <b>bold</b>, <i>it</i>alic.",
        "<!-- <article>no</article> --><article>{}<!-- not --><style>p{{}}</style><noscript><p>no</p></noscript><button>Go</button></article>",
        "<article>{}</article><article class='comment'><p>a very long comment, longer than all of the article, on and on and on and on</p></article>",
        "<ul><li><a href=a>Home</a><li><a href=b>News</a></ul>{}<div><a href=c>Imprint</a> <a href=d>Terms</a></div>",
        "<div class='cookie-notice'><p>We use cookies</p></div><main>{}<div class='related-posts'><h3>More</h3></div></main>",
        "<div class='advertisement'>x</div><div class=\"newsletter\">y</div><section class=entry>{}</section><div class='share-buttons'>s</div>",
    ],
)
def test_pages_without_a_site(page):
    assert main_text(page.format(ARTICLE)) == WANTED


def test_tag_soup():
    assert main_text("") == "" and main_text("plain &lt;text&gt; 1 < 2 & so\xa0on &nbsp; &am &ampx") == "plain <text> 1 < 2 & so on &am &x"
    assert main_text("<article><p>a<p>b</b></i><br>c</div><li>d<li>e</article>f") == "a\nb c\nd\ne"
    assert main_text("<article><p><b>one<br><p>two</p></article>") == "one\ntwo"
    assert main_text("<article><table><tr><td>a<td>b<tr><th>c</th><td><b>d</b></td></table><pre> x\n  y </pre>") == "a b\nc d\nx y"
    assert main_text("<article><p>cut <a hre") == "cut" and main_text("<article><p>x<script>never closed <p>y") == "x"
    assert main_text("<article><p title='a > b' don't>x &#8364;&#x41;&hellip;</p>") == "x €A…"
    assert main_text("<article><p>a <span class='ad'>buy</span> b<button>Go</button></p>") == "a b"
    deep = "<div>" * 20_000 + "deep" + "</div>" * 10_000
    assert main_text(deep) == "deep" and main_text("<b>" * 20_000 + "x" + "</i>" * 20_000) == "x"


def site(n, article, box="<div class='x7'><p>Read our terms before you go on</p></div>"):
    """Pages of one host without telling names: a menu, a box inside the text, a bottom line."""
    menu = "<div><ul>" + "".join(f"<li><span>Part {k}</span></li>" for k in range(4)) + "</ul></div>"
    return [(i, f"http://s.example/{i}", f"{menu}<div>{article(i)}{box}</div><div><p>Bottom line</p></div>") for i in range(n)]


def test_templates_of_a_host(spark):
    rows = site(30, lambda i: f"<p>Text number {i}</p><p>and {i * i} more</p>")
    rows += [(100, "http://other.example/", rows[0][2]), (101, None, rows[0][2]), (102, "no url", rows[0][2])]
    found = texts(spark, rows)
    for i in range(30):
        assert found[i] == f"Text number {i}\nand {i * i} more"
    whole = "Part 0\nPart 1\nPart 2\nPart 3\nText number 0\nand 0 more\nRead our terms before you go on\nBottom line"
    assert found[100] == found[101] == found[102] == whole
    assert texts(spark, rows, min_pages=31)[3].startswith("Part 0")
    marked = [(i, u, h.replace("<div><p>Text", "<div class=content><p>Text")) for i, u, h in rows[:30]]
    assert texts(spark, marked)[7] == "Text number 7\nand 49 more"


def test_copies_and_quotes_are_no_template(spark):
    """An article that stands on many pages, and a passage that many articles quote, stay."""
    quote = "<p>A passage that all of them quote.</p>"
    rows = [(i, f"http://Copy.example:80/{i}", "<article><h1>Same</h1><div><p>The same article.</p></div></article>") for i in range(40)]
    rows += [(i, f"http://copy.example/{i}", f"<article><h1>Own {i}</h1>{quote}<p>Own words {i}.</p></article>") for i in range(40, 80)]
    rows += [(i, f"http://copy.example/{i}", f"<nav>n{i}</nav><div><p>All of this page.</p></div>") for i in range(80, 100)]
    found = texts(spark, rows)
    assert {found[i] for i in range(40)} == {"Same\nThe same article."}
    assert all(found[i] == f"Own {i}\nA passage that all of them quote.\nOwn words {i}." for i in range(40, 80))
    assert {found[i] for i in range(80, 100)} == {"All of this page."}


def test_near_copies_are_no_template(spark):
    """A third of a host's pages are edits of one text in boxes; their common paragraphs stay, the site's box goes."""
    rng = random.Random(2)
    common = [f"<div><p>Paragraph {k} of the text that was edited.</p></div>" for k in range(6)]

    def article(i):
        if i % 3:
            return f"<p>Own text {i}</p><p>{rng.random()}</p>"
        return "".join([*common[: i % 6], f"<p>edit {i}</p>", *common[i % 6 + 1 :]])

    rows = [(i, u, h.replace("<div><p>Bottom", "<div><p>Bottom")) for i, u, h in site(60, article)]
    found = texts(spark, rows)
    for i in range(0, 60, 3):
        lines = [f"Paragraph {k} of the text that was edited." for k in range(6)]
        assert found[i] == "\n".join([*lines[: i % 6], f"edit {i}", *lines[i % 6 + 1 :]])
    assert not any("terms" in t or "Part" in t or "Bottom" in t for t in found.values())


def test_odd_rows(spark):
    long_page = "<article>" + "<p>word after word</p>" * 50_000 + "</article>"
    rows = [
        (1, "http://a.b/", None), (None, None, None), (None, "http://a.b/", "<p>x</p>"), (2, "", ""), (3, "http://a.b/", long_page),
        (4, "http://a.b/", "<article>y</article>"), (4, "http://a.b/", "<article>y</article>"), (4, "http://a.b/", "<article>z</article>"),
    ]
    found = extract_text(pages(spark, rows)).collect()
    assert Counter((r.page_id, r.text) for r in found if r.page_id != 3) == Counter(
        [(1, ""), (None, ""), (None, "x"), (2, ""), (4, "y"), (4, "y"), (4, "z")]
    )
    assert next(r.text for r in found if r.page_id == 3) == "\n".join(["word after word"] * 50_000)
    assert extract_text(pages(spark, rows).limit(0)).count() == 0


def test_whole_table(spark):
    """The tables' pages mark their article: its paragraphs, taken with expressions."""
    wanted = Counter()
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.DOTALL)[1]
        blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1|b)>|<br>", inner))
        text = "\n".join(b for b in blocks if b)
        wanted[(r.page_id, r.url, text, len(text))] += 1
    assert odd.bag(queries.op13_html_extraction(spark, SF)) == wanted

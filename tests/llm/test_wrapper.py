"""Main text of pages against another reading of the same pages, planted layouts, and hostile markup."""

import random
import time
from html.parser import HTMLParser

import pytest

from brassledger.llm import queries, wrapper
from brassledger.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


class Article(HTMLParser):
    """Text within the article element, by blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.open = [""], False

    def handle_starttag(self, tag, attrs):
        self.open |= tag == "article"
        self.blocks.append("") if tag in ("article", "h1", "p") else None
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.open &= tag != "article"
        self.blocks.append("") if tag in ("article", "h1", "p") else None

    def handle_data(self, data):
        if self.open:
            self.blocks[-1] += data

    @classmethod
    def text(cls, html):
        parser = cls()
        parser.feed(html)
        parser.close()
        return " ".join(t for b in parser.blocks if (t := " ".join(b.split())))


def test_query_against_a_parser(spark, small_dir):
    got = {r["page_id"]: r for r in queries.queries()["op12_html_extraction"](spark, small_dir).collect()}
    pages = spark.read.parquet(f"{small_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p["page_id"]]["text"] == Article.text(p["html"])
        assert (got[p["page_id"]]["url"], got[p["page_id"]]["n_chars"]) == (p["url"], len(got[p["page_id"]]["text"]))


def extracted(spark, rows, schema="page_id long, url string, html string"):
    return {r["page_id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, schema).repartition(3)).collect()}


def test_slots_and_template_without_article(spark):
    """Plain containers: only alignment tells what is constant; link lists vary, too; a hot host; several layouts."""
    rng, rows, expected = random.Random(5), [], {}
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    for i in range(90):
        host = "hot.example.org" if i % 3 else f"h{i % 2}.example.org"
        body = [" ".join(rng.choices(words, k=rng.randint(3, 20))) + f" {i}." for _ in range(rng.randint(1, 5))]
        links = "".join(f'<a href="/{w}">{w} {i}</a> ' for w in rng.choices(words, k=6))
        box = "<div class='box'>All rights reserved by the people of this site.</div>" if rng.random() < 0.7 else ""
        html = (
            f"<html><body><div class=top>Welcome to the site</div><div class=list>{links}</div>{box}"
            f"<div class=text><h2>Title {i}</h2>{''.join(f'<p>{b}' for b in body)}</div>"
            "<div class=bottom><div>Made with care</div></div></body></html>"
        )
        rows.append((i, f"http://{host}/p/{i}", html))
        expected[i] = " ".join([f"Title {i}", *body])
    assert extracted(spark, rows) == expected


BOILERPLATE = [
    "<nav>n</nav>", "<div id='side-bar2' class='leftSidebar'>n</div>", "<aside>n</aside>", "<form><p>n<input><button>n</button></form>",
    "<div class='cookie-notice'>n</div>", "<section id=comments><article class='comment'><p>n</p></article></section>", "<script>n<p>n</script>",
    "<style>n</style>", "<footer>n</footer>", "<div role=banner>n</div>", "<p hidden>n</p>", "<noscript>n</noscript>", "<!-- n <p>n</p> -->",
    "<div class='ad ad-300'>n <b>n</b></div>", "<span class=advert>n</span>", "<textarea><p>n</textarea>", "<SCRIPT>n</SCRIPT >",
]


def test_boilerplate_goes_wherever_it_stands():
    for where in ("<body>{0}<article><h1>T</h1><p>one</p><p>two</article>{0}", "<body><header>n</header><main><article>{0}<header><h1>T</h1></header><p>one</p>{0}<p>two</p>{0}"):
        for b in BOILERPLATE:
            html = where.format(b)
            decided = wrapper.as_nodes(wrapper.decide(wrapper.page_tree(html)))
            assert wrapper.content(html, decided) == "T one two", html


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""), ("no markup &amp; all", "no markup & all"), ("a < b &lt;p&gt; &amp;lt; c", "a < b <p> &lt; c"), ("<p>a<b>b</b>c<br>d\n  e&nbsp;f<p>g", "abc d e f g"),
        ("<p>x<script>never ends", "x"), ("<p>x<!-- never ends", "x"), ("<p>x<a href='never ends", "x"), ("<p title=don't>x</p><p>y</p>", "x y"),
        ('<p title="a > b">x</p>', "x"), ("</p></div>x</b>", "x"), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<title>t</title><p>x", "x"), ("<head><title>t</title>x<p>y", "x y"), ("&#8364;&#x41;&zz; &not;", "€A&zz; ¬"), ("<p>" + "日本 " * 3, "日本 日本 日本"),
    ],
)
def test_markup(html, text):
    assert wrapper.content(html, wrapper.as_nodes(wrapper.decide(wrapper.page_tree(html)))) == text


def test_deep_and_long_pages():
    for html, text in [("<div>" * 20_000 + "x", "x"), ("<p>w w " * 50_000, "w w " * 50_000), ("<b>" * 30_000 + "x", "x"), ("<a title=\"" * 2000 + "x", "")]:
        start = time.time()
        assert wrapper.content(html, wrapper.as_nodes(wrapper.decide(wrapper.page_tree(html)))) == text.strip()
        assert time.time() - start < 20


def test_matching_by_hand():
    def tree(spec):
        node = wrapper.Node(spec[0])
        node.kids = [tree(s) for s in spec[1:]]
        return node

    def best(a, b):
        """All order-keeping pairings, by brute force."""
        if a[0] != b[0]:
            return 0
        def pair(x, y):
            return 0 if not x or not y else max(pair(x[1:], y), pair(x, y[1:]), best(x[0], y[0]) and best(x[0], y[0]) + pair(x[1:], y[1:]))
        return 1 + pair(a[1:], b[1:])

    rng = random.Random(0)
    def some(depth):
        return [rng.choice("ab"), *[some(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)]]
    for _ in range(200):
        a, b = ["r", *some(2)[1:]], ["r", *some(2)[1:]]
        assert wrapper.match(tree(a), tree(b))[0] == best(a, b)


def test_odd_rows(spark):
    page = "<html><body><div class=a>menu</div><div class=b>{}</div></body></html>"
    rows = [(None, None, None, 1, "x"), (1, "nohost", "text", 1, "x"), (2, "http://h/", page.format("one"), 1, "x"), (2, "http://H/", page.format("two"), 1, "x"),
            (3, "http://alone/", page.format("only"), 1, "x"), (4, "http://copies/1", page.format("same"), 1, "x"), (5, "http://copies/2", page.format("same"), 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int, host string").repartition(4)
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in wrapper.extract(df).collect()), key=str)
    assert got == sorted([(None, "", 0), (1, "text", 4), (2, "one", 3), (2, "two", 3), (3, "menu only", 9), (4, "menu same", 9), (5, "menu same", 9)], key=str)
    assert wrapper.extract(df.limit(0)).collect() == []

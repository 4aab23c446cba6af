"""Main text of pages: marked pages against plain patterns, unmarked sites against what was written into them."""

import html
import random
import re

import pytest

from cityflow.llm import site_tree as s
from cityflow.llm.queries import QUERIES

SCHEMA = "page_id bigint, url string, html string"


def text(page):
    return s.Page(page).text()


def test_what_the_markup_says():
    page = (
        '<!DOCTYPE html><html><head><title>t</title><script>var a="</p><article>x</article>";</script></head>'
        '<body class="has-sidebar"><div class="page with-header"><header>site</header><nav><a href="/">menu</a></nav>'
        '<article class="post comments-open"><header class="entry-header"><h1>Head &amp; line</h1><span>by x</span></header>'
        'loose <p>One <b>two</b><br>three&nbsp;&eacute; &lt;b&gt;<p class="cookie-notice">no</p><p hidden>no</p>'
        '<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>f<span class="ad">no</span>g<aside>no</aside>'
        '<form><p>no</p></form><div id="comments"><article class="comment">no</article></div><!-- no --></article>'
        '<div class="sidebar">no</div></div><footer>no</footer></body></html>'
    )
    assert text(page) == "Head & line\nloose\nOne two three é <b>\na\nb\nc\nd\nfg"


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<div><p>a</b></div></p>b", "a\nb"), ("a <!-- b", "a"),
        ("<form id=whole><div><article>in a form</article></div></form>", "in a form"),
        ('<div class="related"><article>x</article></div><main><p>m</p></main>', "m"),
        ("<div id=content><p>body text here</p></div><div>other</div>", "body text here"),
        ("<div class=post>x</div><div>much more text than the other one has</div>", "x\nmuch more text than the other one has"),
        ("a &am b &amp c &bogus; 1 < 2", "a &am b & c &bogus; 1 < 2"), ("<p class='x>y'>a<p title=\"<p>b\">c", "a\nc"),
        ("<article>a</article><article>b</article>", "a\nb"), ("<p>end <a href='x", "end"), ("<br>" * 5 + "x", "x"),
        ("<header>h<article>a</article></header>", "a"), ("<ul><li>a<ul><li>b</ul>c</ul>", "a\nb\nc"),
    ],
)
def test_rough_markup(page, wanted):
    assert text(page) == wanted


def test_odd_pages_do_not_fail():
    rng = random.Random(5)
    parts = ["<", ">", "</", "<p", "<div>", "</div>", '"', "'", "=", " a", "<!--", "-->", "<![", "<?", "&", "&#0;", "&#xD800;", "<script>", "</script", "<table><td>", "<br/>", "é", "\x00"]
    for _ in range(1500):
        page = s.Page("".join(rng.choice(parts) for _ in range(rng.randrange(30)))).keyed()
        page.measured()
        page.text().encode()
    deep = s.Page("<div>" * 20_000 + "x").keyed()
    assert deep.text() == "x" and len(deep.measured()) == 20_001
    assert text("<b>" * 5000 + "x" + "<p>y" * 5000).count("y") == 5000
    assert text("<p>" + "word " * 300_000) == ("word " * 300_000).strip()


def test_entropies(spark):
    """Four pages: a branch with one text everywhere, one with a text of its own on each page."""
    pages = [
        (i, "http://h.example/a", f"<div>same words</div><div><p>page {i}</p>{'<p>more</p>' * i}</div>") for i in range(4)
    ]
    found = s.site_trees(spark.createDataFrame(pages, SCHEMA)).filter("name = 'div'").collect()
    assert len(found) == 4  # the host and all hosts
    for host in ("h.example", "*"):
        same, own = sorted((r for r in found if r["host"] == host), key=lambda r: r["content"])
        assert (same["pages"], same["content"], same["presentation"], same["words"]) == (4, 0.0, 0.0, 8)
        assert (own["pages"], own["content"], own["presentation"]) == (4, pytest.approx(1.0), pytest.approx(1.0))
        assert same["importance"] == 0 and own["importance"] == pytest.approx(1.0)


def site(n, host, rng, own):
    """Pages without a telling tag or name: a menu, a banner, an article, a line that stands everywhere, an address."""
    words = [f"w{i}" for i in range(4000)]
    for i in range(n):
        blocks = [" ".join(rng.choices(words, k=rng.randint(20, 60))) for _ in range(rng.randint(1, 5))]
        if own and i % 3 == 0:
            blocks.append("A passage that several pages quote stays where it is quoted, word for word.")
        body = "<p>Subscribe to our weekly letter today.</p>" + "".join(f"<p>{b}</p>" for b in blocks)
        yield (
            i, f"https://{host}/p{i}",
            f"<div><ul><li><a>home</a><li><a>{rng.choice(words)}</a></ul></div><div>Buy this now</div><div>{body}</div>"
            f"<div>{host} {rng.choice(words)}</div>",
            "\n".join(blocks),
        )


def test_sites_without_marks(spark):
    """Nothing but the style tree can tell what is the article here, also on hosts too small for a tree."""
    rng = random.Random(11)
    rows = list(site(60, "one.example", rng, True))
    for small in range(5):
        rows += site(3, f"small{small}.example", rng, False)
    rows += [(r[0], None, r[2], r[3]) for r in rows[:3]]
    docs = spark.createDataFrame([(k, *r[1:3], "x", 1) for k, r in enumerate(rows)], SCHEMA + ", text string, `key` int")
    found = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in s.extract(docs.repartition(4)).collect()}
    assert len(found) == len(rows)
    for k, row in enumerate(rows):
        assert found[k] == (row[1], row[3], len(row[3]))


def test_copies_of_an_article_stay(spark):
    """An article that most pages of a host carry is an article all the same."""
    page = '<body><nav>{0}</nav><article><h1>Title</h1><p>The same text on every page.</p></article><footer>{0} x</footer>'
    rows = [(i, "http://h.example/x", page.format(i)) for i in range(40)]
    found = s.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["text"] for r in found} == {"Title\nThe same text on every page."} and len(found) == 40


@pytest.mark.parametrize(("tag", "stays"), [("main", False), ("div class=content", False), ("article", True)])
def test_the_tree_judges_marked_pages(spark, tag, stays):
    """A container is no proof of what is in it: its template goes by the style tree. An article is whole."""
    end = tag.split()[0]
    page = "<nav>menu</nav><{0}><div>Our weekly letter tells you more.</div><p>text {2} of page {2}</p></{1}>"
    rows = [(i, "http://h.example/x", page.format(tag, end, i)) for i in range(40)]
    found = {r["page_id"]: r["text"] for r in s.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    first = "Our weekly letter tells you more.\n" if stays else ""
    assert found == {i: f"{first}text {i} of page {i}" for i in range(40)}


def test_copies_in_a_container_stay(spark):
    """Where the tree finds a whole container to be the same everywhere, it cannot tell its template."""
    page = "<div>{0} and {0}</div><main><h1>Title</h1><div>The same text on every page.</div></main>"
    rows = [(i, "http://h.example/x", page.format(i)) for i in range(40)]
    assert {r["text"] for r in s.extract(spark.createDataFrame(rows, SCHEMA)).collect()} == {"Title\nThe same text on every page."}


def test_edges(spark):
    rows = [(1, None, None), (1, "", ""), (None, "no address", "<article>a</article>"), (2, "http://h/x", "<nav>only</nav>"), (2, "http://h/x", "<nav>only</nav>")]
    found = s.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, None, "", 0), (1, "", "", 0), (None, "no address", "a", 1), (2, "http://h/x", "", 0), (2, "http://h/x", "", 0)], key=str
    )
    assert s.extract(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, "http://h/x", "<p>a", "h", 1, [1])], SCHEMA + ", host string, feature int, branches array<int>")
    assert s.extract(clash).first()["text"] == "a"


def test_the_tree_alone_finds_the_given_articles(spark):
    """The benchmark's pages with their telling elements made plain ones."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    plain = pages.selectExpr(
        "page_id", "url",
        """regexp_replace(regexp_replace(html, '<(nav|article|footer|div class="ad")>', '<div>'), '</(nav|article|footer)>', '</div>') AS html""",
    )
    wanted = s.extract(pages).selectExpr("page_id", "text AS wanted")
    found = s.extract(plain).join(wanted, "page_id").selectExpr("count(*)", "count_if(text = wanted)").first()
    assert found[0] == 2500 and found[1] >= 0.99 * found[0]
    assert plain.filter("contains(html, '<article') OR contains(html, '<nav')").isEmpty()


def test_registered_query_equals_patterns(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r["page_id"]: r for r in QUERIES["op12_html_extraction"](spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for page in pages:
        body = re.search("<article>(.*)</article>", page["html"], re.S).group(1)
        lines = re.sub("<[^>]*>", " ", re.sub("</?(p|h1)>", "\n", body)).split("\n")
        wanted = "\n".join(x for x in (" ".join(html.unescape(x).split()) for x in lines) if x)
        row = found[page["page_id"]]
        assert (row["url"], row["text"], row["n_chars"]) == (page["url"], wanted, len(wanted))

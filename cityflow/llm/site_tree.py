"""Main text of web pages by a style tree of their site.

Every page becomes a tree of elements. The trees of one host are merged into its site style tree: an
element is known by the way to it, which names at each step the sequence of branches it stands in (the
style of its parent), its place in it, and its tag, classes and id. Two entropies over the pages that have
an element, each as a share of the greatest possible one, say how much it matters:

* presentation: how much the sequences of its children differ from page to page,
* content: how much its text differs from page to page; a menu that is the same everywhere has none.

``importance = (1 - GAMMA) * information / largest information among its siblings + GAMMA * presentation``,
where the information is the content entropy times the words per page. A branch below ``BRANCH`` goes from
every page of the host, and so does a block of text whose own entropy says that nearly all pages have
it there (``BLOCK``). A host with few pages says little about itself: below ``PAGES`` pages the tree of all
hosts decides.

The tree is made of all pages and judges every branch and block of each of them. What the markup proves is checked
after it, since entropy alone can keep a long footer whose words change and drops an article that most pages of a
host carry: navigation, headers, footers, asides, forms, adverts, notices, comments, scripts and styles, by tag,
role, class or id, go even if the tree keeps them. Where a page has ``article`` elements, what is in them stays even
if the tree drops it, and nothing else does. Where it has only ``main``, or else a container named as content, that
says where the article is but not that all in it belongs to it: what is outside goes, and inside the tree takes out
the blocks that nearly all pages have, unless it finds the whole container to be the same on most pages.

The merged trees are aggregations by host and element, so a host with a third of all pages is no
hotter than any other. A page is joined with the list of its host's removed branches, which grows with
the site's templates, not with its pages.

Text: character references are decoded; blocks are what block elements hold or part; white space inside a
block becomes one space, a line break element counts as white space; blocks are joined in page order
by a line feed.

Defined cases: a null or empty page has empty text, as has a page without main text; a null address, or one
without a host, leaves the decision to the tree of all hosts; markup that is not closed is closed where
its parent or the page ends; end tags without a beginning are ignored; repeated rows and ids are returned
each; texts of any length are taken whole; no pages give no rows; further columns are ignored.
"""

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityflow.llm.common import saved

GAMMA, BRANCH, BLOCK, PAGES = 0.1, 0.2, 0.1, 8

# Elements by how the HTML standard lays them out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TEXT_BLOCKS = frozenset(
    "address blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 hgroup hr legend li p pre summary td th tr".split()
)
BRANCHES = frozenset(
    "article aside body center details dialog dir div dl fieldset figure footer form head header html main menu nav ol "
    "search section table tbody tfoot thead ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Elements, roles and names that mark text around an article.
NOISE_TAGS = frozenset(
    "applet aside audio button canvas datalist dialog embed footer frame frameset head iframe input map menu nav "
    "noembed noframes noscript object script search select style svg template textarea title video".split()
)
NOISE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
NOISE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising aside banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr login masthead menu modal "
    "nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
CONTENT_NAMES = frozenset("article content entry main post story".split())
# a class such as has-sidebar or comments-open says something of the page, not what the element is
STATE_NAMES = frozenset("closed disabled enabled has hide js no off on open show with without".split())

# an element that begins closes these, up to the nearest of those
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
# A tag, with quotes around values only where the standard has them; a comment; a declaration; a tag that
# the page breaks off. Anything else that begins with "<" is text.
_TOKEN = re.compile(
    r"""<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>"""
    r"""|!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*(?:>|\Z)|[a-zA-Z][^>]*\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
# elements whose content is text up to their end tag
_RAW = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in "iframe noembed noframes script style textarea title xmp".split()}
_PARTS = re.compile(r"[a-z]+")
_MASK = 2**63 - 1


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) & _MASK


# how sure the markup is that an element is noise
NO, BY_NAME, BY_TAG = 0, 1, 2
ARTICLE = 3


class Element:
    """An element of a page: the names of its children, and in order the blocks and branches below it."""

    __slots__ = ("tag", "name", "up", "children", "items", "mark", "noise", "header", "root", "key")

    def __init__(self, tag: str, name: str = ""):
        self.tag, self.name = tag, name or tag
        self.up: Element | None = None  # the branch it stands in
        self.children: list[str] = []
        self.items: list = []  # blocks (text, heading or not, noise or not) and branches
        self.mark = NO
        self.noise = self.header = False
        self.root = 0  # ARTICLE, 2 main, 1 named as content
        self.key = 0


class Page:
    """The tree of one page. ``branches`` are its branch elements, parents first."""

    def __init__(self, text: str):
        self.document = Element("#document")
        self.branches = [self.document]
        self._open = [self.document]
        self._words: list[str] = []
        self._quiet = 0  # open inline elements that are noise
        self._read(text)
        self._flush()
        self._settle()

    # --- parsing

    def _read(self, text: str) -> None:
        at = 0
        while at < len(text):
            token = _TOKEN.search(text, at)
            if token is None or token.start() > at:
                self._data(text[at : token.start() if token else len(text)])
            if token is None:
                return
            at = token.end()
            slash, tag, rest = token.groups()
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "br":
                self._words.append(" ")
            elif slash:
                self._end(tag)
            else:
                attrs = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(rest)} if len(rest) > 1 else {}
                self._begin(tag, attrs)
                if tag in _RAW:
                    end = _RAW[tag].search(text, at)
                    upto = end.start() if end else len(text)
                    self._data(text[at:upto])
                    at = upto

    def _begin(self, tag: str, attrs: dict[str, str]) -> None:
        block = tag in TEXT_BLOCKS or tag in BRANCHES
        if block:
            self._flush()
            self._close_paragraph()
        if tag in _CLOSES:
            self._close_open(*_CLOSES[tag])
        parent = self._open[-1]
        if tag in VOID:
            parent.children.append(tag)
            return
        element = Element(tag, _name(tag, attrs))
        parent.children.append(element.name)
        if attrs or tag in NOISE_TAGS or tag in _MARKED:
            _label(element, attrs)
        if tag in BRANCHES:
            for between in reversed(self._open):
                if between.tag in BRANCHES or between is self.document:
                    break
                element.mark = max(element.mark, between.mark)
            element.up = between
            between.items.append(element)
            self.branches.append(element)
        self._open.append(element)
        if element.mark and not block:
            self._quiet += 1

    def _end(self, tag: str) -> None:
        block = tag in TEXT_BLOCKS or tag in BRANCHES
        for at in range(len(self._open) - 1, 0, -1):
            found = self._open[at].tag
            if found == tag:
                self._pop(at)
                return
            # an inline end tag does not reach beyond its block, nor a block's beyond its branch
            if found in BRANCHES and tag not in BRANCHES or found in TEXT_BLOCKS and not block:
                return

    def _data(self, text: str) -> None:
        if not self._quiet:
            self._words.append(unescape(text) if "&" in text else text)

    def _close_paragraph(self) -> None:
        for at in range(len(self._open) - 1, 0, -1):
            tag = self._open[at].tag
            if tag == "p":
                self._pop(at)
                return
            if tag in BRANCHES or tag in TEXT_BLOCKS:
                return

    def _close_open(self, tags: set, up_to: set) -> None:
        for at in range(len(self._open) - 1, 0, -1):
            tag = self._open[at].tag
            if tag in tags:
                self._pop(at)
            elif tag in up_to:
                return

    def _pop(self, at: int) -> None:
        if any(e.tag in BRANCHES or e.tag in TEXT_BLOCKS for e in self._open[at:]):
            self._flush()
        while len(self._open) > at:
            element = self._open.pop()
            if element.mark and element.tag not in BRANCHES and element.tag not in TEXT_BLOCKS:
                self._quiet -= 1

    def _flush(self) -> None:
        if not self._words:
            return
        text = " ".join("".join(self._words).split())
        self._words = []
        if not text:
            return
        heading = noise = False
        for element in reversed(self._open):
            if element.tag in BRANCHES or element is self.document:
                element.items.append((text, heading, noise))
                return
            heading |= element.tag in HEADINGS
            noise |= element.mark > NO and element.tag in TEXT_BLOCKS

    def _settle(self) -> None:
        """What is noise: whatever is marked or stands in something marked. Where that leaves no article,
        elements that hold one are not noise by name alone, such as a form around the page."""
        self._spread(frozenset())
        articles = [e for e in self.branches if e.root > 1]
        if articles and all(e.noise for e in articles):
            holders = set()
            for element in articles:
                while element is not None and id(element) not in holders:
                    holders.add(id(element))
                    element = element.up
            self._spread(holders)

    def _spread(self, lifted: frozenset | set) -> None:
        for element in self.branches:
            own = element.mark == BY_TAG or element.mark == BY_NAME and id(element) not in lifted
            element.noise = own or element.up is not None and element.up.noise

    # --- the style tree's view

    def keyed(self) -> "Page":
        """Give every branch its key: the way to it through its parents' styles."""
        for element in self.branches:
            below = [e for e in element.items if isinstance(e, Element)]
            style = " ".join(e.name for e in below)
            for place, e in enumerate(below):
                e.key = _hash(f"{element.key}|{style}|{place}|{e.name}")
        return self

    def measured(self) -> list[tuple[Element, int, int, int]]:
        """Style, content and number of words of every branch, from the last to the first."""
        below: dict[int, tuple[int, int]] = {}
        found = []
        for element in reversed(self.branches):
            parts, words = [], 0
            for item in element.items:
                if isinstance(item, Element):
                    content, n = below[id(item)]
                else:
                    content, n = _hash(item[0]), item[0].count(" ") + 1
                parts.append(content)
                words += n
            below[id(element)] = _hash(str(parts)), words
            found.append((element, _hash(" ".join(element.children)), *below[id(element)]))
        return found

    def roots(self) -> int:
        """The strongest mark of main content on the page, 0 if there is none. Containers named as content
        count if they hold half of the words that are not noise."""
        level = max((e.root for e in self.branches if not e.noise), default=0)
        if level != 1:
            return level
        named = total = 0
        inside: dict[int, bool] = {}
        for element in self.branches:
            inside[id(element)] = element.root == 1 or element.up is not None and inside[id(element.up)]
            if not element.noise:
                words = sum(i[0].count(" ") + 1 for i in element.items if not isinstance(i, Element) and not i[2])
                total += words
                named += words if inside[id(element)] else 0
        return int(2 * named >= total)

    def text(self, branches: frozenset = frozenset(), blocks: frozenset = frozenset()) -> str:
        """Main text. ``branches`` (keys) and ``blocks`` (keys and hashes of texts) are the site's template by its style
        tree, on every page; the markup's proofs are checked after it."""
        level = self.roots()
        kept: list[str] = []
        # branches to go through, from behind: element, inside main content, inside its header, template by the tree,
        # main content that is whole although the tree may call parts of it template
        todo: list = [(self.document, False, False, False, False)]
        while todo:
            item, inside, header, template, whole = todo.pop()
            if not isinstance(item, Element):
                kept.append(item)
                continue
            if item.noise:
                continue
            template = template or item.key in branches
            if level > 0 and item.root == level:
                whole = whole or level == ARTICLE or template
                inside, header = True, False
            else:
                header = header or item.header
            if not level and (header or template):
                continue
            for part in reversed(item.items):
                if isinstance(part, Element):
                    todo.append((part, inside, header, template, whole))
                    continue
                text, heading, noise = part
                if noise or header and not heading or level and not inside:
                    continue
                if not whole and blocks and (item.key, _hash(text)) in blocks:
                    continue
                todo.append((text, True, False, False, False))
        return "\n".join(kept)


_MARKED = frozenset(("article", "form", "header", "main"))
_NAMED = ("class", "id")


def _name(tag: str, attrs: dict[str, str]) -> str:
    """The tag with its classes and id, less their digits."""
    if not attrs:
        return tag
    words = {re.sub(r"\d+", "", n) for k in _NAMED for n in attrs.get(k, "").lower().split()} - {""}
    return ".".join([tag, *sorted(words)]) if words else tag


def _label(element: Element, attrs: dict[str, str]) -> None:
    """What the markup says of an element."""
    tag, values = element.tag, {k: v.lower() for k, v in attrs.items()}
    role = values.get("role", "")
    if tag in ("html", "body"):
        return
    hidden = "hidden" in values or values.get("aria-hidden") == "true"
    if tag in NOISE_TAGS or role in NOISE_ROLES or hidden or "display:none" in values.get("style", "").replace(" ", ""):
        element.mark = BY_TAG
        return
    element.header = tag == "header"
    parts: set[str] = set()
    for name in " ".join(values.get(k, "") for k in _NAMED).split():
        found = set(_PARTS.findall(name))
        parts |= found if not found & STATE_NAMES else set()
    if tag == "form":
        element.mark = BY_NAME
    elif parts & NOISE_NAMES and tag != "main" and tag not in HEADINGS:
        element.mark = BY_NAME
    elif "header" in parts and tag not in HEADINGS:
        element.header = True
    if tag == "article" and not parts & {"comment", "comments", "reply"}:
        element.root = ARTICLE
    elif tag == "main" or role in ("main", "article") or values.get("itemprop") == "articlebody":
        element.root = 2
    elif tag in BRANCHES and parts & CONTENT_NAMES and not element.mark and not element.header:
        element.root = 1


# --- the merged trees

_ALL = "*"
_ROWS = "host string, key bigint, parent bigint, name string, kind string, feature bigint, words bigint"


def _host(url: str) -> str:
    return f"lower(nullif(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), ''))"


def elements(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """A row per page, branch and kind of feature: its style (p), its content (c), and of branches that are
    not noise each different block (b)."""
    schema = pa.schema([
        ("host", pa.string()), ("key", pa.int64()), ("parent", pa.int64()), ("name", pa.string()),
        ("kind", pa.string()), ("feature", pa.int64()), ("words", pa.int64()),
    ])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = Page(text.as_py() or "").keyed()
                for element, style, content, words in page.measured():
                    same = (host, element.key, -1 if element.up is None else element.up.key, element.name)
                    found += [(*same, "p", style, words), (*same, "c", content, words)]
                    if not element.noise:
                        texts = {_hash(i[0]) for i in element.items if not isinstance(i, Element) and not i[2]}
                        found += [(*same, "b", t, 0) for t in texts]
            columns = list(zip(*found)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return pages.selectExpr(f"{_host(url)} AS host", f"CAST({html} AS string) AS html").mapInArrow(rows, _ROWS)


def counted(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Pages and words per host, element, kind and feature; under the host ``*`` those of all hosts."""
    same = ["key", "parent", "name", "kind", "feature"]
    sums = [F.expr("sum(pages) AS pages"), F.expr("sum(words) AS words")]
    rows = elements(pages, url, html).groupBy("host", *same).agg(F.expr("count(*) AS pages"), F.expr("sum(words) AS words"))
    each = saved(rows, "site-features")
    return each.filter("host IS NOT NULL").unionByName(each.groupBy(*same).agg(*sums).withColumn("host", F.lit(_ALL)))


def _trees(features: DataFrame) -> DataFrame:
    entropy = "IF(sum(pages) > 1, (ln(sum(pages)) - sum(pages * ln(pages)) / sum(pages)) / ln(sum(pages)), 1D)"
    nodes = (
        features.filter("kind <> 'b'")
        .groupBy("host", "key", "parent", "name", "kind")
        .agg(F.expr("sum(pages) AS pages"), F.expr("sum(words) AS words"), F.expr(f"{entropy} AS entropy"))
        .groupBy("host", "key", "parent", "name")
        .agg(
            F.expr("max(pages) AS pages"), F.expr("max(words) AS words"),
            F.expr("max(IF(kind = 'p', entropy, 0D)) AS presentation"), F.expr("max(IF(kind = 'c', entropy, 0D)) AS content"),
        )
        .selectExpr("*", "content * words / pages AS information")
    )
    largest = nodes.groupBy("host", "parent").agg(F.expr("max(information) AS largest"))
    share = "IF(largest > 0, information / largest, 1D)"
    return nodes.join(largest, ["host", "parent"]).selectExpr(
        "host", "key", "parent", "name", "pages", "words", "presentation", "content",
        f"round({1 - GAMMA}D * {share} + {GAMMA}D * presentation, 9) AS importance",
    )


def site_trees(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The style trees: per host (``*`` for all of them) and element its key, parent, name, pages, words,
    entropies of presentation and content, and importance."""
    return _trees(saved(counted(pages, url, html), "site-counts"))


def removals(features: DataFrame) -> DataFrame:
    """host, and the branches and blocks that go from its pages; hosts without any are left out."""
    trees = saved(_trees(features), "site-trees")
    branches = trees.filter(f"pages >= {PAGES} AND importance < {BRANCH} AND parent >= 0").selectExpr(
        "host", "key", "CAST(NULL AS bigint) AS block"
    )
    blocks = (
        features.filter("kind = 'b'")
        .selectExpr("host", "key", "feature AS block", "pages AS n")
        .join(trees.select("host", "key", "pages"), ["host", "key"])
        .filter(f"pages >= {PAGES} AND round(1 - ln(n) / ln(pages), 9) < {BLOCK}")
        .select("host", "key", "block")
    )
    per_tree = (
        branches.unionByName(blocks)
        .groupBy("host")
        .agg(
            F.expr("collect_list(key) FILTER (WHERE block IS NULL) AS branches"),
            F.expr("collect_list(struct(key, block)) FILTER (WHERE block IS NOT NULL) AS blocks"),
        )
        .withColumnRenamed("host", "tree")
    )
    hosts = trees.filter("parent < 0").selectExpr("host", f"IF(pages >= {PAGES}, host, '{_ALL}') AS tree")
    return hosts.join(per_tree, "tree").select("host", "branches", "blocks")


def extract(pages: DataFrame, url: str = "url", html: str = "html", id: str = "page_id") -> DataFrame:
    """page_id, url, main text and its number of characters, of every row of ``pages``."""
    gone = saved(removals(saved(counted(pages, url, html), "site-counts")), "site-removals")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, branches, blocks in zip(*(batch.column(i) for i in (2, 3, 4))):
                page = Page(html.as_py() or "")
                if branches.is_valid:
                    pairs = frozenset((b["key"], b["block"]) for b in blocks.as_py())
                    texts.append(page.keyed().text(frozenset(branches.as_py()), pairs))
                else:
                    texts.append(page.text())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], schema=schema)

    wide = (
        pages.selectExpr(
            f"CAST({id} AS bigint) AS page_id", f"CAST({url} AS string) AS url", f"CAST({html} AS string) AS html",
            f"coalesce({_host(url)}, '{_ALL}') AS host",
        )
        .join(gone, "host", "left")
        .select("page_id", "url", "html", "branches", "blocks")
    )
    return wide.mapInArrow(rows, "page_id bigint, url string, text string").selectExpr(
        "page_id", "url", "text", "CAST(length(text) AS bigint) AS n_chars"
    )

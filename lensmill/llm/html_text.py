"""Main text of web pages by a site style tree.

Pages of one host share templates. Every block of text belongs to a node of its page's tree, named by the path of tags
and classes to it; merging the pages of a host gives the site's tree. An element's style on a page is the sequence of its
children there, its own texts among them; elements without text are no part of the tree. Importance is measured over the host's
distinct pages (copies count once):

* *Content*, of a node's own texts: one less their mean entropy. A menu shows the same texts on every page and gets 0,
  paragraphs differ and get 1.
* *Presentation*, of an element with children: the entropy of its styles. A frame that is built alike on all pages gets 0.
* *Composite*, from the leaves up: content at a leaf; above, presentation and the mean of what the children of the styles have, by
  1 - decay^l and decay^l for l styles.

A node is noise if all of it is below ``low``: itself and everything under it. What goes back to the pages is the list of a host's
topmost noisy nodes, joined by host, and each page loses these branches whole. Inside the article a block of a noisy node only goes if
its own text repeats as well, so passages that many pages quote stay.

What the result must never hold is then told by what elements are: menus, headers, footers, sidebars, notices, adverts, forms
and comments, and where a page marks its article, all outside.

The tree is built by dropping copies and two aggregations over (host, path, text or style) counts, which fold before their shuffles, so a
host with a third of all pages is no hot spot. Importance rises through the merged tree by doubling: a round for twice the height.

Edge cases: a null html is empty and gives an empty text; a null url is a host of its own; a node on few distinct pages is
important, so such a host is judged by its elements alone; unclosed and unknown tags, comments and scripts without an end
are read to the end of the page; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lensmill.llm.common import job, stored

# Kinds of elements, as HTML defines them; fixed values.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea iframe svg canvas math object audio video select".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead title tr ul".split()
)
#: Start tags that end an open element of these kinds, up to the next container.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CONTAINERS = frozenset("html body article aside main section nav div header footer form table ul ol dl blockquote td th figure".split())
#: What is never main text: by element, by role, by word in class or id. Words of layout may also describe a
#: wrapper around the article, so an article inside begins anew.
_NOISE_TAGS = frozenset("head title nav footer aside form button menu dialog header".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notification"
    " popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond replies reply share sharing"
    " social related recommended".split()
)
_LAYOUT_WORDS = frozenset(
    "banner sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar pagination pager widget toolbar"
    " alert skip search".split()
)
_ARTICLE = frozenset(("article", "main"))

_TAG = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<!\[CDATA\[(?s:.*?)(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^<>\"']|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)>"
    r"|<[!?][^>]*+(?:>|\Z)"
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_CLOSE = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE) for name in _RAW}

#: Digest of the path, text, noise by element (2: an article in a wrapper that only a class word makes noise), inside an article,
#: the element.
Block = tuple[int, str, int, bool, "_Element"]
#: Of a whole: shares of children are counted in these, as sums of whole numbers do not depend on their order.
_WHOLE = 1 << 32


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class _Element:
    __slots__ = ("article", "children", "hard", "layout", "name", "parent", "path", "words", "wrapped")

    def __init__(self, name: str, rest: str, parent: _Element | None):
        self.name = name
        self.parent = parent
        #: Paths of the children that hold text, None for an own text; no list while there is no text.
        self.children: list[int | None] | None = None
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if "=" in rest else {}
        # A digest of the whole path, so that a deeply nested page takes room in proportion to its elements.
        style = ".".join(found.get("class", "").split())
        self.path = _digest(f"{parent.path if parent else ''}/{name}.{style}")
        self.article = name in _ARTICLE or bool(parent and parent.article)
        # By element or role: noise whatever is inside.
        hard = name in _NOISE_TAGS or found.get("role", "").lower() in _NOISE_ROLES
        if name == "header" and parent and parent.article:
            hard = False  # an article's own heading
        # By class words, which spare an article itself. Below an article they begin anew; what they said above is kept apart.
        begins = name in _ARTICLE
        self.hard = hard or bool(parent and parent.hard)
        self.layout = bool(parent and parent.layout and not begins)
        self.words = bool(parent and parent.words and not begins)
        self.wrapped = bool(parent and (parent.wrapped or (begins and parent.words)))
        if not hard and found and not begins and name not in ("html", "body"):
            words = {w.lower() for w in _WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}")}
            if words & _NOISE_WORDS:
                self.words = True
            elif words & (_LAYOUT_WORDS - {"header"} if self.article else _LAYOUT_WORDS):
                self.layout = True

    @property
    def noise(self) -> int:
        return 1 if self.hard or self.layout or self.words else 2 * self.wrapped


def blocks(html: str) -> list[Block]:
    """The blocks of text of a page, in page order."""
    return _parsed(html)[0]


def _parsed(html: str) -> tuple[list[Block], list[_Element]]:
    """The blocks of a page and the elements that hold text, in page order."""
    found: list[Block] = []
    holders: list[_Element] = []
    stack: list[_Element] = []
    parts: list[str] = []
    root = _Element("", "", None)
    at, n = 0, len(html)
    last = html.rfind(">") + 1

    def hang(element: _Element | None, child: int | None) -> None:
        """Puts a child under an element, and the element under its own parent if that is its first one."""
        while element:
            first = element.children is None
            if first:
                element.children = []
                holders.append(element)
            element.children.append(child)
            element, child = (element.parent if first else None), element.path

    def close_block() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                top = stack[-1] if stack else root
                found.append((top.path, text, top.noise, top.article, top))
                hang(top, None)

    while at < n:
        m = _TAG.search(html, at, max(at, last))
        if m is None:
            parts.append(unescape(html[at:].partition("<!--")[0]))
            break
        if m.start() > at:
            parts.append(unescape(html[at : m.start()]))
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name in _BLOCK or name in _RAW:
                close_block()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].name == name:
                        del stack[k:]
                        break
                    if name not in _CONTAINERS and stack[k].name in _CONTAINERS:
                        break
            else:
                # An inline element's end: it leaves the stack without ending the block.
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].name == name:
                        del stack[k]
                        break
                    if stack[k].name in _BLOCK:
                        break
            continue
        if name in _RAW:
            end = _CLOSE[name].search(html, at)
            if not m["rest"].endswith("/"):
                at = end.end() if end else n
            parts.append(" ")
            continue
        if name in _VOID:
            if name in _BLOCK:
                close_block()
            else:
                parts.append(" " if name in ("br", "wbr", "img", "input") else "")
            continue
        if name in _BLOCK:
            close_block()
            ends = _ENDS.get(name, {"p"})
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name in ends or stack[k].name == "p":
                    del stack[k:]
                    break
                if stack[k].name in _CONTAINERS and stack[k].name not in ends:
                    break
        if not m["rest"].endswith("/"):
            # Inline elements carry no style of their own: their text belongs to the block around them.
            if name in _BLOCK or "=" in m["rest"]:
                stack.append(_Element(name, m["rest"], stack[-1] if stack else root))
    close_block()
    return found, holders


def _nodes(holders: list[_Element]) -> list[tuple[int, int | None, int, int, int]]:
    """Per path of a page: path, its parent's, digest of its style, its share of the parent's children, own texts' share of its own."""
    instances: dict[int, list[list[int | None]]] = {}
    ups: dict[int, int | None] = {}
    for element in holders:
        instances.setdefault(element.path, []).append(element.children)
        ups[element.path] = element.parent.path if element.parent else None
    styles, shares, own = {}, {}, {}
    for path, lists in instances.items():
        styles[path] = _digest(";".join(",".join("" if c is None else str(c) for c in children) for children in lists))
        counts = Counter(c for children in lists for c in children)
        total = counts.total()
        own[path] = counts.pop(None, 0) * _WHOLE // total
        shares.update((c, n * _WHOLE // total) for c, n in counts.items())
    return [(path, up, styles[path], shares.get(path, 0), own[path]) for path, up in ups.items()]


def host_of(url: Column) -> Column:
    """What stands between the scheme (or nothing) and the path, without user and in lower case; null for null."""
    authority = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)", 1)
    return F.lower(F.substring_index(authority, "@", -1))


def main_text(
    page: list[Block], repeated: set[int], texts: set[int] = frozenset(), branches: set[int] = frozenset()
) -> str:
    """The blocks of importance. repeated: nodes whose own texts are noise; branches: nodes that are noise with all below; texts:
    texts that repeat in such nodes."""
    # A class word above an article may name a part of its wrapper (has-comments) or what the article is (comments): it counts
    # only where the page has another article.
    clean = 0 if any(article and not noise for _, _, noise, article, _ in page) else 2
    has_article = any(article and noise in (0, clean) for _, _, noise, article, _ in page)
    known: dict[_Element | None, bool] = {None: False}

    def in_branch(element: _Element) -> bool:
        walked, at = [], element
        while at not in known:
            walked.append(at)
            at = None if at.path in branches else at.parent
        last = walked and walked[-1].path in branches
        known.update(dict.fromkeys(walked, bool(last) or known[at]))
        return known[element]

    kept = []
    for path, text, noise, article, element in page:
        if noise not in (0, clean) or (has_article and not article):
            continue
        if (path in repeated or (branches and in_branch(element))) and (not article or _digest(text) in texts):
            continue
        kept.append(text)
    return "\n\n".join(kept)


def _counts(pages: DataFrame) -> DataFrame:
    """(host, path, text, style, pages, up, share, own): on how many distinct pages of a host a node has a text, or a style."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found, holders = _parsed(html or "")
                page = sorted({(path, _digest(text)) for path, text, *_ in found})
                nodes = list(zip(*_nodes(holders), strict=True)) or [()] * 5
                rows.append((host, _digest(html or ""), [p for p, _ in page], [t for _, t in page], *map(list, nodes)))
            yield pa.RecordBatch.from_pylist([dict(zip(parsed.names, r, strict=True)) for r in rows], parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, paths, texts, *nodes in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                rows += [(host, p, t, None, None, None, None) for p, t in zip(paths, texts, strict=True)]
                rows += [(host, p, None, style, up, share, own) for p, up, style, share, own in zip(*nodes, strict=True)]
            found = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.string()), *(pa.array(c, pa.int64()) for c in found[1:])],
                names=["host", "path", "text", "style", "up", "share", "own"],
            )

    lists = ["paths", "texts", "nodes", "ups", "styles", "shares", "own"]
    columns = ["host", *lists]
    parsed = pa.schema([("host", pa.string()), ("page", pa.int64()), *((c, pa.list_(pa.int64())) for c in lists)])
    # Copies and repeated crawls of a page say nothing about its template: each distinct page of a host counts once.
    distinct = (
        pages.select(host_of(F.col("url")).alias("host"), "html")
        .mapInArrow(parse, "host string, page long, " + ", ".join(f"{c} array<long>" for c in lists))
        .dropDuplicates(["host", "page"])
        .select(*columns)
    )
    rows = distinct.mapInArrow(run, "host string, path long, text long, style long, up long, share long, own long")
    # A path has one parent.
    return rows.groupBy("host", "path", "text", "style").agg(
        F.count("*").alias("pages"), F.max("up").alias("up"), F.sum("share").alias("share"), F.sum("own").alias("own")
    )


def _gathered(nodes: DataFrame, below: Callable[[], Column], both: Callable[[Column, Column], Column]) -> DataFrame:
    """(host, path, value): values of (host, path, up, weight, value) gathered over all that is under a node.

    Round k knows a node's ancestor 2^k levels above, the product of the weights up to it, and what was gathered from less than 2^k
    levels below; so a tree takes as many rounds as its height has binary digits.
    """
    now = nodes
    while now.where("up is not null").limit(1).count():
        under = now.where("up is not null").groupBy(F.col("host").alias("host_u"), F.col("up").alias("path_u"))
        under = under.agg(below().alias("under"))
        above = now.select(*(F.col(c).alias(f"{c}_a") for c in ("host", "path", "up", "weight")))
        joined = now.join(under, F.col("host").eqNullSafe(F.col("host_u")) & (F.col("path") == F.col("path_u")), "left")
        joined = joined.join(above, F.col("host").eqNullSafe(F.col("host_a")) & (F.col("up") == F.col("path_a")), "left")
        value = F.when(F.col("under").isNull(), F.col("value")).otherwise(both(F.col("value"), F.col("under")))
        now = stored(
            joined.select("host", "path", F.col("up_a").alias("up"), (F.col("weight") * F.col("weight_a")).alias("weight"), value.alias("value")),
            "html-rising",
        )
    return now.select(F.col("host").alias("its_host"), F.col("path").alias("its_path"), "value")


def _beside(nodes: DataFrame, found: DataFrame, name: str) -> DataFrame:
    same = F.col("host").eqNullSafe(F.col("its_host")) & (F.col("path") == F.col("its_path"))
    return nodes.join(found.withColumnRenamed("value", name), same).drop("its_host", "its_path")


def _importance(counted: DataFrame, min_pages: int, decay: float) -> DataFrame:
    style, text = F.col("style").isNotNull(), F.col("text").isNotNull()
    n = F.col("pages")
    nodes = counted.groupBy("host", "path").agg(
        F.max("up").alias("up"),
        F.sum(F.when(style, n)).alias("m"),
        F.count("style").alias("styles"),
        F.sum(F.when(style, n * F.log(n))).alias("alike"),
        # Pages where the node has a text of its own, and the mean of log n over its texts, of which one is on n pages.
        F.sum(F.when(style & (F.col("own") > 0), n)).alias("text_pages"),
        F.avg(F.when(text, F.log(n))).alias("mean"),
        F.sum("share").alias("share"),
        F.sum("own").alias("own"),
    )
    # Where all ancestors of a judged node are judged, too: they are on its pages.
    judged = nodes.where(F.col("m") >= max(min_pages, 2))
    enough = F.col("text_pages") >= max(min_pages, 2)
    content = F.when(enough, 1 - F.col("mean") / F.log("text_pages")).when(F.col("text_pages") > 0, 1.0)
    presentation = 1 - F.col("alike") / (F.col("m") * F.log("m"))
    # What the children and own texts are of a style, on the mean of the pages.
    judged = judged.withColumns({
        "content": content,
        "inner": F.col("own") < F.col("m") * _WHOLE,
        "presentation": presentation,
        "decayed": F.pow(F.lit(decay), F.col("styles")),
        "own": F.col("own") / (F.col("m") * _WHOLE),
    })
    judged = stored(judged.drop("alike", "mean", "styles"), "html-nodes")
    over = judged.select(F.col("host").alias("its_host"), F.col("path").alias("its_path"), F.col("m").alias("m_up"), F.col("decayed").alias("decayed_up"))
    rising = judged.join(over, F.col("host").eqNullSafe(F.col("its_host")) & (F.col("up") == F.col("its_path")), "left")
    rising = rising.withColumn("part", F.col("share") / (F.col("m_up") * _WHOLE)).drop("its_host", "its_path")
    # The children that are judged; the others are important.
    parts = rising.where("up is not null").groupBy(F.col("host").alias("its_host"), F.col("up").alias("its_path")).agg(F.sum("part").alias("value"))
    same = F.col("host").eqNullSafe(F.col("its_host")) & (F.col("path") == F.col("its_path"))
    rising = rising.join(parts, same, "left").drop("its_host", "its_path")
    # Shares are rounded down, by less than this a child.
    rest = 1 - F.coalesce("value", F.lit(0.0)) - F.col("own")
    rest = F.when(rest > 1e-6, rest).otherwise(0.0)
    own = F.coalesce(F.col("own") * F.col("content"), F.lit(0.0))
    inner = (1 - F.col("decayed")) * F.col("presentation") + F.col("decayed") * (own + rest)
    rising = rising.select(
        "host", "path", "up", "m", "text_pages", "inner", "content", "presentation", (rest > 0).alias("others"),
        (F.col("part") * F.col("decayed_up")).alias("weight"),
        F.when(F.col("inner"), inner).otherwise(F.col("content")).alias("value"),
    )
    rising = stored(rising, "html-rising")
    total = _gathered(rising.select("host", "path", "up", "weight", "value"), lambda: F.sum(F.col("weight") * F.col("value")), lambda a, b: a + b)
    nodes = stored(_beside(rising.drop("value"), total, "composite"), "html-composite")
    most = F.greatest("composite", "content", F.when(F.col("others"), 1.0))
    heaviest = _gathered(nodes.select("host", "path", "up", "weight", most.alias("value")), lambda: F.max("value"), F.greatest)
    return _beside(nodes, heaviest, "heaviest").drop("others", "weight")


def importance(pages: DataFrame, min_pages: int = 8, decay: float = 0.9) -> DataFrame:
    """The merged tree: host, path, up, m (distinct pages), text_pages (those with a text of its own), inner (has children), content,
    presentation, composite and heaviest (the largest importance in the branch) of the nodes on at least ``min_pages`` pages."""
    with job(pages.sparkSession):
        return stored(_importance(_counts(pages), min_pages, decay), "html-importance", result=True)


def style_tree(pages: DataFrame, min_pages: int = 8, low: float = 0.3, decay: float = 0.9) -> DataFrame:
    """(its_host, paths, texts, branches) per host: nodes whose own texts are noise, texts that most pages repeat in such nodes, and elements that
    are noise with all below; only the topmost of each."""
    host = F.col("host").alias("its_host")
    same = F.col("host").eqNullSafe(F.col("its_host"))
    with job(pages.sparkSession):
        counted = stored(_counts(pages), "html-counts")
        nodes = stored(_importance(counted, min_pages, decay), "html-importance")
        noise, text_noise = F.col("heaviest") < low, F.col("content") < low
        over = nodes.where(noise).select(host, F.col("path").alias("its_path"), F.lit(True).alias("under_noise"))
        top = nodes.where(noise | text_noise).join(over, same & (F.col("up") == F.col("its_path")), "left").where("under_noise is null")
        top = top.withColumn("branch", noise & F.col("inner")).select(
            "host", F.when(~F.col("branch"), F.col("path")).alias("path"), F.when(F.col("branch"), F.col("path")).alias("branch")
        )
        faint = nodes.where(text_noise).select(host, F.col("path").alias("its_path"), "text_pages")
        common = counted.join(faint, same & (F.col("path") == F.col("its_path"))).where("text is not null and 2 * pages >= text_pages")
        rows = top.unionByName(common.select("host", "text"), allowMissingColumns=True)
        per_host = rows.groupBy("host").agg(
            F.collect_set("path").alias("paths"), F.collect_set("text").alias("texts"), F.collect_set("branch").alias("branches")
        )
        return stored(per_host.withColumnRenamed("host", "its_host"), "html-hosts", result=True)


def extract(pages: DataFrame, min_pages: int = 8, low: float = 0.3, decay: float = 0.9) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    tree = style_tree(pages, min_pages, low, decay)
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", host_of(F.col("url")).alias("host")).join(
        tree, F.col("host").eqNullSafe(F.col("its_host")), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, *lists in zip(*(batch.column(c).to_pylist() for c in ("html", "paths", "texts", "branches")), strict=True):
                texts.append(main_text(blocks(html or ""), *(set(x or ()) for x in lists)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.select("page_id", "url", "html", "paths", "texts", "branches").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )

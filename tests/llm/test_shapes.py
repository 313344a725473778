"""Fingerprints, shards and page text against brute force and on hand-made cases."""

import hashlib
import math
import tracemalloc
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lensmill.llm import fingerprints, html_text, registry, sharding

from .conftest import EDGE_ROWS

SF = "/root/testdata/sf0.001"


def test_fingerprints_equal_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in small.collect()}
    ids = sorted(texts)
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    rows = registry.op4_fingerprints(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == ids
    for r in rows:
        text, following = texts[r.doc_id], texts[after[r.doc_id]]
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        one, two, three = (fingerprints.sketches([t])[0] for t in (text, changed, following))
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprints.written(one), fingerprints.written(two))
        assert r.near_edited == fingerprints.likeness(one, two) and r.near_next == fingerprints.likeness(one, three)
        assert fingerprints.likeness(fingerprints.read(r.fingerprint), one) == 1
    long = [r.near_edited for r in rows if r.n_chars > 600]
    assert sum(long) / len(long) > 0.35


def test_equal_parts_share_phrases_at_any_offset():
    rng = random.Random(1)
    body = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    whole, moved, other = fingerprints.sketches([body, "xyz!" * 7 + body, "".join(rng.choice("abcdefgh ") for _ in range(4000))])
    assert fingerprints.likeness(whole, moved) > 0.9 and fingerprints.likeness(whole, other) < 0.1
    assert fingerprints.likeness(whole, whole) == 1
    # Whatever else is parsed with it, a text has one fingerprint.
    assert fingerprints.sketches(["", body, "q", body])[3][0] == whole[0]


def test_fingerprint_edges(make, edges, empty):
    rows = fingerprints.compare_with_edits(edges).collect()
    assert len(rows) == len(EDGE_ROWS) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert fingerprints.compare_with_edits(empty).count() == 0
    (one,) = fingerprints.compare_with_edits(make([(5, "abc", "en", "a")])).collect()
    assert (one.near_next, one.edited_sha256) == (1.0, hashlib.sha256(b"aba").hexdigest())


def assert_sharded(rows, texts, n, slack=0.02):
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        assert r.law == "bytes" and r.grown_shard is None
    got = sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr)
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts]
    assert got == sorted(want, key=repr)
    assert set(slots) <= set(range(n)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Near equal: but for a small share and the largest documents.
    apart = max(sizes.values()) - min(sizes.values())
    return len(sizes) == n and apart <= slack * sum(sizes.values()) / n + 2 * max(r.size for r in rows)


def test_shards_of_the_whole_table(spark, small):
    rows = registry.op7_shards(spark, SF).collect()
    assert assert_sharded(rows, [(r.doc_id, r.text) for r in small.collect()], 8)


def test_hot_group_is_divided_and_copies_stay_together(make):
    texts = [(i, "same text " * 20) for i in range(1000)] + [(1000 + i, f"own text {i // 2} " * (5 + i % 40)) for i in range(2000)]
    rows = sharding.shard(make([(i, t, "en", f"s{i % 9}") for i, t in texts]), n_shards=5).collect()
    assert assert_sharded(rows, texts, 5)
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) < 30


def test_shard_edges(edges, empty):
    texts = [(i, t) for i, t, _, _ in EDGE_ROWS]
    assert_sharded(sharding.shard(edges, n_shards=3).collect(), texts, 3)
    assert_sharded(sharding.shard(edges, target_bytes=1 << 30).collect(), texts, 1)
    assert sharding.shard(empty, n_shards=8).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="with-sidebar">
<header><a href="/">Site</a></header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<div id="main-sidebar"><article><header><h1>Head &amp; line</h1></header><p><b>First<br>part <i>of</i>&nbsp;it<p>Second &lt;b&gt; <!-- no > --> part
<aside>Read also</aside><form><input value="x>y">Send</form><div class="share-links">Share</div>
<ul><li>one<li>two</ul><table><tr><td>cell</td></tr></table></article></div><section class="comments"><article class="comment">Nice!</article></section>
<aside>More</aside><footer>&copy; 2020</footer><script>never closed"""


def test_page_of_all_parts():
    text = html_text.main_text(html_text.blocks(PAGE), set())
    assert text == "Head & line\n\nFirst part of it\n\nSecond <b> part\n\none\n\ntwo\n\ncell"


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b</p></p>c", "a\n\nb\n\nc"),
        ("<div>x <b>y</b>z</div><!-- open", "x yz"),
        ("<script>a", ""),
        ("a < b and <b>c</b> 1<2", "a < b and c 1<2"),
        ("<p title='a>b'>t</p><nav>n", "t"),
        ("<P CLASS=ad>x</P><p>y", "y"),
    ],
)
def test_odd_pages(html, want):
    assert html_text.main_text(html_text.blocks(html), set()) == want


def test_long_odd_pages_take_linear_time():
    for html in ("<a " * 100_000, "<!--" * 100_000, '<p a="' * 60_000, "<div>" * 20_000, "<script>" * 50_000, "&amp" * 100_000, "<p>" * 50_000):
        html_text.blocks(html)


def test_deep_nesting_takes_little_room():
    """100,000 open elements: what is kept per element does not grow with its depth."""
    tracemalloc.start()
    found = html_text.blocks("<div class='some words of style'>" * 100_000 + "text")
    assert [text for _, text, *_ in found] == ["text"]
    assert tracemalloc.get_traced_memory()[1] < 200_000_000
    tracemalloc.stop()


def test_hosts(spark):
    urls = {
        "http://H.example:80/a": "h.example:80", "https://user:p@ss@h.com/x@y": "h.com", "//h.com?q": "h.com", "h.com/path": "h.com",
        "": "", None: None, "ftp://h.com#x@z": "h.com",
    }
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.host for r in frame.select("url", html_text.host_of(F.col("url")).alias("host")).collect()} == urls


def test_style_tree_finds_repeated_blocks(spark):
    """Pages without any telling names: what repeats on a host goes, what differs stays."""
    page = lambda i: f"<body><div><span>Home News</span></div><div class=x><p>Body of page {i} here</p></div><p class=z>All rights</p></body>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(30)] + [(99, "http://few.example/", page(99)), (100, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert all(found[i] == f"Body of page {i} here" for i in range(30))
    assert found[99] == "Home News\n\nBody of page 99 here\n\nAll rights" and found[100] == ""
    assert html_text.extract(pages.limit(0)).count() == 0


def test_article_passages_that_repeat_stay(spark):
    page = lambda i: f"<article><p>Own text {i}</p><p>The same passage</p><p class=cta>Press here</p></article>"
    pages = spark.createDataFrame([(i, "http://h.example/", page(i)) for i in range(30)], "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(pages).collect()} == {f"Own text {i}\n\nThe same passage" for i in range(30)}


def brute_tree(pages, min_pages=8, low=0.3):
    """(host, path) of low content importance, over the distinct pages of each host."""
    counts, there = defaultdict(int), defaultdict(int)
    for host, html in {(url and url.split("/")[2], html) for _, url, html in pages}:
        page = {(path, text) for path, text, *_ in html_text.blocks(html)}
        for path, text in page:
            counts[host, path, text] += 1
        for path in {path for path, _ in page}:
            there[host, path] += 1
    faint = set()
    for (host, path), m in there.items():
        logs = [math.log(n, m) if m > 1 else 0 for (h, p, _), n in counts.items() if (h, p) == (host, path)]
        if m >= min_pages and 1 - sum(logs) / len(logs) < low:
            faint.add((host, path))
    return faint


def test_copies_of_pages_count_once(spark):
    page = lambda k: f"<nav>Menu</nav><article><h1>Head {k}</h1><p>Body {k} one</p><p>Body {k} two</p></article>"
    menu = lambda i: f"<div>Home</div><p>Text {i}</p>"
    rows = [(i, url, page(i % 2)) for i, url in enumerate(["http://copies.example/", None] * 30)] + [(100 + i, None, page(i % 2)) for i in range(9)]
    rows += [(200 + i, "http://own.example/", menu(i % 12)) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for i, _, html in rows:
        k = html[html.index("Head ") + 5] if "Head " in html else None
        assert found[i] == (f"Head {k}\n\nBody {k} one\n\nBody {k} two" if k else f"Text {(i - 200) % 12}")
    got = {(r.its_host, p) for r in html_text.style_tree(pages).collect() for p in r.paths}
    assert got == brute_tree(rows) and len(got) == 1


@pytest.mark.parametrize(
    "html, want",
    [
        ("<article class='post category-social'><p>Main</article><p>other", "Main"),
        ("<div class='has-comments'><article><p>Main<div class=share>Share</div></article></div><p>other", "Main"),
        ("<div class='promo'><div class='login'><main><p>Main</main></div></div><p>other", "Main"),
        ("<article><p>Main</article><section class=comments><article>Nice</article></section>", "Main"),
        ("<div role=dialog><article>Box</article></div><p>other", "other"),
        ("<aside><article class=related>Box</article></aside><p>other", "other"),
    ],
)
def test_class_words_spare_articles(html, want):
    assert html_text.main_text(html_text.blocks(html), set()) == want


def brute_importance(pages, min_pages=8, decay=0.9):
    """(host, path) -> (content, presentation, composite, heaviest) by recursion over each host's merged tree."""
    site = defaultdict(lambda: {"styles": [], "texts": defaultdict(int), "below": set(), "n": 0})
    for host, html in {(url and url.split("/")[2], html) for _, url, html in pages}:
        found, holders = html_text._parsed(html)
        for path, text in {(path, text) for path, text, *_ in found}:
            site[host, path]["texts"][text] += 1
        for path in {path for path, *_ in found}:
            site[host, path]["n"] += 1
        sequences = defaultdict(list)
        for element in holders:
            sequences[host, element.path].append(tuple(element.children))
        for key, lists in sequences.items():
            site[key]["styles"].append(tuple(lists))
            site[key]["below"] |= {c for children in lists for c in children if c is not None}

    def entropy(counts, m):
        return -sum(n / m * math.log(n / m, m) for n in counts)

    done = {}

    def judge(host, path):
        node = site[host, path]
        m = len(node["styles"])
        if m < min_pages:
            return 1.0, 1.0
        content = None
        if node["texts"]:
            logs = [math.log(n, node["n"]) for n in node["texts"].values()] if node["n"] >= min_pages else [0]
            content = 1 - sum(logs) / len(logs)
        under = {c: judge(host, c) for c in node["below"]}
        of = {c: composite for c, (composite, _) in under.items()} | {None: content}
        styles = Counter(node["styles"])
        presentation = entropy(styles.values(), m)
        means = [(n / m, [of[c] for children in style for c in children]) for style, n in styles.items()]
        kept = decay ** len(styles)
        composite = (1 - kept) * presentation + kept * sum(p * sum(v) / len(v) for p, v in means) if under else content
        heaviest = max([composite, content or 0, *(h for _, h in under.values())])
        done[host, path] = content, presentation, composite, heaviest
        return composite, heaviest

    for host, path in list(site):
        judge(host, path)
    return done


def site_pages():
    """Pages without any telling names: frames that are built alike, a list whose length varies, rotating offers, rare parts."""
    rows = []
    for i in range(60):
        items = "".join(f"<li>Item {k}</li>" for k in range(1 + i % 5))
        rare = "<div class=r>Rare words</div>" if i < 3 else ""
        frame = f"<div class=a><div class=b><p>Home</p><p>News</p></div><p>Top</p></div><div class=c>Own {i % 50}<ul>{items}</ul></div>{rare}"
        offer = f"<div class=o><div><p>Offer {i % 3}</p></div></div>"
        rows.append((i, "http://h.example/", f"<body>{frame}{offer}<section><p>Text {i}</p><p>More {i}</p></section></body>"))
    deep = "".join(f"<div class=d{k}>" for k in range(20))
    rows += [(100 + i, None, f"{deep}<p>Same</p><p class=x>Text {i}</p>") for i in range(12)]
    return rows + [(200, "http://few.example/", "<p>a<div>b"), (201, "http://few.example/", "")]


def test_importance_rises_through_the_merged_tree(spark):
    """Entropy of presentation of inner nodes and composite importance, against a recursion."""
    rows = site_pages()
    pages = spark.createDataFrame(rows + rows[:7], "page_id long, url string, html string")
    found = {(r.host, r.path): (r.content, r.presentation, r.composite, r.heaviest) for r in html_text.importance(pages).collect()}
    want = brute_importance(rows)
    assert set(found) == set(want)
    for key, values in want.items():
        assert found[key] == pytest.approx(values, abs=1e-6), key
    # A frame alike on all pages has no presentation, a list whose length varies has some.
    inner = {p for _, p, composite, _ in want.values() if composite is not None}
    assert 0 in inner and any(0.1 < p < 1 for p in inner)


def test_noisy_branches_go_as_a_whole(spark):
    """Also offers that take turns, of which none is on half of the pages."""
    pages = spark.createDataFrame(site_pages(), "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for i in range(60):
        own = [f"Own {i % 50}", *(["Rare words"] if i < 3 else []), f"Text {i}", f"More {i}"]
        left = [t for t in found[i].split("\n\n") if not t.startswith("Item")]
        assert left == own
    assert all(found[100 + i] == f"Text {i}" for i in range(12))
    assert found[200] == "a\n\nb" and found[201] == ""
    tree = {r.its_host: r for r in html_text.style_tree(pages).collect()}
    top = html_text._Element("div", "class=a", html_text._Element("body", "", html_text._Element("", "", None)))
    # The frame's levels are one entry, and so are the offers and the list.
    assert top.path in tree["h.example"].branches and len(tree["h.example"].branches) == 3 and not tree["h.example"].paths

import html as entities
import re

import duckdb
import pytest

from chainlake.llm import htmlextract as h


def brute(page):
    """The article of the test tables' pages by patterns."""
    article = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL)[1]
    blocks = re.split(r"<[^>]*>", re.sub(r"</?(b|br)>", " ", article))
    blocks = [re.sub(r"\s+", " ", entities.unescape(b)).strip() for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_small_table(spark):
    want = {p: brute(t) for p, t in duckdb.sql("SELECT page_id, html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()}
    found = h.query(spark, "/root/testdata/sf0.001").collect()
    assert {r.page_id: r.text for r in found} == want and all(r.n_chars == len(r.text) for r in found)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b", "a\nb"),
        ("<article><p>A &amp;&lt;&eacute;&#233; <i>b</i>\n\t c<br>d</p></article><footer>f</footer>", "A &<éé b c d"),
        ("<nav>n</nav><main><h1>T</h1><p>x</main><aside>s</aside>", "T\nx"),
        ("<article><header><h1>T</h1></header><p>x</p><section class='comments'><article class=comment>c</article></section></article>", "T\nx"),
        ("<div class='has-sidebar'><article><p>x</p></article><div id=sidebar>s</div></div>", "x"),
        ("<header>top</header><div class='cookie-notice'>c</div><div><p>x</p></div><form>f<input></form><script>if (a<b) '</p>'</script><style>p{}</style>", "x"),
        ("<article><p>x</p><script>var t='</article>';</script><p>y</p>", "x\ny"),
        ("<html><head><title>t</title><body><p>x", "x"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p>1 < 2 > 0</p><!-- gone --><p>e", "a\nb\nc\nd\n1 < 2 > 0\ne"),
        ("<article><p>x</p></b></nav></article><p>y", "x"),
        ("<div role=navigation>n</div><div aria-hidden=true>n</div><p>x", "x"),
        ("<p>a</p><div class=adBanner>no</div><div class=address>b</div>", "a\nb"),
        ("<article>&copy; 2024 &notanentity; &#x41;", "© 2024 ¬anentity; A"),
    ],
)
def test_pages(page, text):
    assert h.main_text(page) == text


def site(spark, n, page, host="h.example.com", extra=()):
    rows = [(i, f"http://{host}/{i}", page(i), "clash", 1) for i in range(n)]
    return spark.createDataFrame([*rows, *extra], "page_id long, url string, html string, host string, tokens int")


def test_template_words_go_and_common_words_stay(spark):
    """A label that comes with its markup on all pages of a host is the template's; a sentence that most articles share is not."""

    def page(i):
        share = "<p>a sentence that most have</p>" if i % 4 else ""
        return f"<div><div class=x1><span>Subscribe now</span></div><div class=x2><p>own words {i}</p>{share}</div></div>"

    found = h.extract(site(spark, 20, page)).collect()
    assert {r.page_id: r.text for r in found} == {i: f"own words {i}" + ("\na sentence that most have" if i % 4 else "") for i in range(20)}
    for n in (3, 5, 7, 8, 9):  # from the least support on, the number of pages changes nothing
        few = h.extract(site(spark, n, lambda i: f"<div><div class=x1><span>Subscribe now</span></div><div class=x2><p>own words {i}</p></div></div>")).collect()
        assert {r.page_id: r.text for r in few} == {i: f"own words {i}" for i in range(n)}
    two = h.extract(site(spark, 2, page)).collect()
    assert all(r.text.startswith("Subscribe now\n") for r in two)


def test_vectors_are_by_page(spark):
    """Two labels on half the pages each have equal counts, but different vectors."""
    pages = site(spark, 16, lambda i: f"<p>w{i}</p>" + ("<div><em>even</em></div>" if i % 2 == 0 else "<ul><li>odd</ul>"))
    found = {r.page_id: r.text for r in h.extract(pages).collect()}
    assert found == {i: f"w{i}" for i in range(16)}


def test_edges(spark):
    extra = [(None, None, "<p>x</p>", None, None), (7, "no url", None, None, None), (7, "no url", None, None, None), (8, "http://h.example.com", "<article>" + "<p>long words</p>" * 20000, "", 0)]
    found = h.extract(site(spark, 3, lambda i: "<article><p>same</p></article>", extra=extra)).collect()
    assert len(found) == 7 and sum(r.text == "same" for r in found) == 3 and max(r.n_chars for r in found) == 20000 * 11 - 1
    assert {r.text for r in found if r.page_id in (None, 7)} == {"x", ""} and [len(r) for r in found] == [4] * 7
    assert h.extract(site(spark, 1, lambda i: "x").limit(0)).count() == 0


def test_hosts_agree(spark):
    urls = ["http://A.com/x", "https://a.com?b", "a.com", None, "x://h#/y", "://", "http://a:80/"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", h.host_of("url").alias("host")).collect()
    assert {r.url: r.host for r in rows} == {u: h._host(u) for u in urls}


def test_copies_of_a_page_keep_their_text(spark):
    """Equal pages are no template, nor are articles that differ in nothing but what is around them."""
    copies = h.extract(site(spark, 12, lambda i: "<html><body><div><p>the words</p></div></body></html>")).collect()
    assert [r.text for r in copies] == ["the words"] * 12
    near = h.extract(site(spark, 12, lambda i: f"<html><body><article><p>the words</p></article><p>seen {i}</p><footer>{i}</footer></body></html>")).collect()
    assert [r.text for r in near] == ["the words"] * 12
    bare = h.extract(site(spark, 12, lambda i: f"<html><body><div><p>the words</p></div><footer>{i}</footer></body></html>")).collect()
    assert [r.text for r in bare] == ["the words"] * 12
    half = h.extract(site(spark, 20, lambda i: "<div><table><tr><td>the words</table></div>" if i < 11 else f"<p>own {i}</p>")).collect()
    assert {r.page_id: r.text for r in half} == {i: "the words" if i < 11 else f"own {i}" for i in range(20)}


def test_classes_are_ordered_and_nested(spark):
    """Labels in changing order are not one class; a class that crosses a larger one is not the template's."""
    pages = site(spark, 20, lambda i: f"<body><div>{'one<hr>two' if i % 2 else 'two<hr>one'}</div><div>fixed</div><p>own {i}</p></body>")
    found = {r.page_id: r.text for r in h.extract(pages).collect()}
    assert found == {i: ("one\ntwo" if i % 2 else "two\none") + f"\nown {i}" for i in range(20)}
    page = "<p>a</p><i>b</i><p>c</p><i>d</i>"
    p, a, i, b, c, d = (next(h.text_token(n, x) if x else n.path for k, n, x in h.parse(page) if (k, x or n.name) == w) for w in [("open", "p"), ("text", "a"), ("open", "i"), ("text", "b"), ("text", "c"), ("text", "d")])
    ranks, crossed, data = h.structure(page, {a: 1, c: 1, b: 2, d: 2}, {1: 2, 2: 2})
    assert ranks == {(a, 0): 0, (c, 0): 1, (b, 0): 0, (d, 0): 1} and crossed == {(1, 2)} and not data
    assert set(h.nested([(2, 1), (3, 1), (5, 1), (4, 2), (7, 2)], [(1, 2)])) == {1}


@pytest.mark.parametrize(
    "page",
    [
        "<p>out</p><article class='post tag-cookies category-social comment-status-open'><p>x</p></article>",
        "<p>out</p><article class=social><p>x</p></article>",
        "<p>out</p><div class='content with-comments'><article><p>x</p></article></div>",
        "<p>out</p><div id='ad-free'><div class=social><main class=comments><p>x</p></main></div></div>",
        "<div class='with-comments category-social'>x</div><div class='cookie-notice'>c</div><div id=sidebarLeft>s</div><div class='post ad'>a</div>",
        "<p>out</p><main><div class=sidebar><article class='social'><p>x</p></article></div></main>",
        "<p>out</p><article><p>x</p><div class=comments><article class=comment>c</article></div><div class='share'>s</div></article>",
    ],
)
def test_class_words_do_not_drop_the_article(page):
    assert h.main_text(page) == "x"


@pytest.mark.parametrize("n", [3, 7, 8, 20])
def test_constant_lines_of_articles_stay(spark, n):
    """Lines that all or most articles have, with the tags around them, are theirs."""
    page = lambda i: f"<article><p>own {i}</p>" + ("<blockquote>Daily notes</blockquote>" if i % 3 else "") + "<p>Yours sincerely</p></article><footer>f</footer>"
    found = {r.page_id: r.text for r in h.extract(site(spark, n, page)).collect()}
    assert found == {i: f"own {i}\n" + ("Daily notes\n" if i % 3 else "") + "Yours sincerely" for i in range(n)}


def brute_template(pages):
    """Texts that are the template's by the definition, from whole occurrence vectors: equal to that of a tag, and on all pages."""
    vectors = {}
    for i, page in enumerate(pages):
        for kind, node, text in h.parse(page):
            if kind == "open" or kind == "text" and not text.isspace():
                vectors.setdefault((kind, node.path, text), [0] * len(pages))[i] += 1
    tags = {tuple(v) for (kind, *_), v in vectors.items() if kind == "open"}
    return {text for (kind, _, text), v in vectors.items() if kind == "text" and tuple(v) in tags and all(v)}


def test_templates_without_articles_are_the_brute_ones(spark):
    """Pages without article elements and without telling class names: what goes is the template by its definition, and nothing else."""
    labels = ["Home", "Read on", "All rights kept"]

    def page(i):
        rows = "".join(f"<li><i>Part</i> item {i} {j}" for j in range(1 + i % 4))
        return f"<body><div><b>{labels[0]}</b></div><div><p>story {i}</p><p>said in common</p><p>said in common too {i % 2}</p><ul>{rows}</ul></div><div><u>{labels[1]}</u><s>{labels[2]}</s></div></body>"

    pages = [page(i) for i in range(13)]
    gone = brute_template(pages)
    assert set(labels) <= gone and "Part" in gone and "story 1" not in gone
    found = {r.page_id: r.text.split("\n") for r in h.extract(site(spark, 13, page)).collect()}
    for i, text in found.items():
        parts = [t for k, _, t in h.parse(pages[i]) if k == "text" and t not in gone]
        assert [w for x in text for w in x.split()] == [w for x in parts for w in x.split()]
    bare = [h.main_text(p) for p in pages]
    assert all("Home" in b for b in bare) and not any("Home" in t for t in found.values())

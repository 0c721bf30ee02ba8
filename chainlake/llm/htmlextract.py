"""Main text of web pages by deduced templates: equivalence classes of tokens with the same occurrence vector (after EXALG).

The pages of a host are taken as filled-in copies of a template. A token is a tag with its path, or the text of a node with its path. Its
occurrence vector says how often each of the host's pages has it. Vectors are never built: each page adds a 64-bit mix of its html's hash and
the token's count to a sum, equal sums stand for equal vectors, and the sums are aggregated before and after the shuffle. So
a host with a third of all pages costs a row for each of its tokens and task, like any other.

Equal html counts once per host. Tokens of equal vectors that occur in at least `support` of a host's pages, and in LEAST_PAGES, form its classes, if there is a tag among
them, as a template's words come with its markup. Each page is then read again with its host's classes, a tag being two symbols, its start and its
end. A class is ordered if its symbols come in the same order in every instance on every page; symbols that do not, leave it. Two classes are nested
if no instance of one has parts in two gaps of an instance of the other that it does not lie in as a whole; of two that cross, the larger
stays. The classes left are the template, and their text tokens its own words (labels of menus, notices, footers). What lies in the gaps between their
symbols is slots: of other classes, and of data. Words that merely many pages share have a vector that no tag has, and stay data.

Text in an article or main element is the template's only if its class is on every page of the host and not once on each, as what some articles share
is theirs; and where no page has text outside its classes, the pages are copies of one text, which stays. Data is part of the main text if it lies in the article
(the article or main element, or else the body) and no element around it is for menus, headers, footers, sidebars, adverts, forms, comments,
scripts or styles, by tag or by the words of its class, id or role.

LEAST_PAGES is the method's least support of a class: two pages that have something in common say nothing of a template yet.
What a host keeps is bounded by its page size: tokens in at least `support` of the pages are at most 1 / support times those of a page.

Blocks are what block-level tags separate; white space in a block is one space; blocks are joined by a line end in page order.

Defined cases: null and empty html give an empty text; broken markup is read as far as it goes, an unclosed element ending with its parent;
a null url is a host of its own; repeated rows and equal pages of a host count once, and all get their text; of classes that cross and are equally
large the one with the smaller vector stays; whole pages are read, however long; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm.common import read, saved, slices
from chainlake.llm.urlfilter import split_url

SUPPORT, LEAST_PAGES = 0.5, 3
#: Fixed values of HTML: elements without content, of raw text, and those that are inline; elements whose start ends an open one of the same group.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
NOT_MAIN = frozenset("head nav footer aside form script style noscript template iframe button select option textarea title svg dialog menu".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
NOT_MAIN_WORDS = frozenset(
    "ad ads adsbygoogle adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr "
    "header login mainnav masthead menu nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related replies reply "
    "search share sharing sidebar sidenav signup skip social sponsor sponsored subnav subscribe toolbar topbar topnav".split()
)
#: A name of class or id counts if all its words are of the above or of these: "cookie-notice" and "sidebar-left", not "with-comments".
PART_WORDS = NOT_MAIN_WORDS | frozenset("area bar block bottom box column container content fixed form inner items l left link links list main middle outer page primary r right secondary section site slot small sticky top unit widget wrap wrapper".split())
#: After so many new nodes all are forgotten.
REMEMBERED = 1 << 16
_token = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|[^<]+|<", re.DOTALL)
_attribute = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+))?""")
_name = re.compile(r"[^\s\"']+")
_name_words = re.compile(r"[a-z]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")
_space = re.compile(r"\s+")


class Node:
    """An open element: name, path, whether a main (1) or an article (2) is around, and why it is outside the main text, by itself or
    an ancestor: 0 it is not, 1 a class or id, which an article or main element inside ends, 2 anything else. Nodes of the same place and attributes are
    one object, as pages of a site share most of theirs."""

    __slots__ = ("name", "path", "article", "other", "children")

    def __init__(self, name: str, path: int, article: int, other: int):
        self.name, self.path, self.article, self.other = name, path, article, other
        self.children: dict[tuple[str, str], Node] = {}

    def child(self, name: str, attributes: str) -> Node:
        found = self.children.get((name, attributes))
        if found is None:
            if next(_made) % REMEMBERED == 0:
                _top.children.clear()
            found = self.children[name, attributes] = _child(self, name, attributes)
        return found


def _is_other(name: str, attributes: str, inside: int) -> int:
    if name in NOT_MAIN or name == "header" and not inside:
        return 2
    if not attributes or name in ("html", "body"):
        return 0
    found: set[str] = set()
    for key, value in _attribute.findall(attributes):
        key = key.lower()
        if key in ("class", "id"):
            for whole in _name.findall(value):
                words = set(_name_words.findall(_camel.sub("-", whole).lower()))
                if words <= PART_WORDS:
                    found |= words & NOT_MAIN_WORDS
        elif key == "role" and value.strip("\"'").lower() in NOT_MAIN_ROLES or key == "hidden" or key == "aria-hidden" and value.strip("\"'").lower() == "true":
            return 2
    if inside < 2 and name in ("article", "main"):
        return 0  # the article itself, whatever it is tagged with
    if inside:
        found.discard("header")  # an article's own headline
    return 1 if found else 0


def _child(parent: Node, name: str, attributes: str) -> Node:
    article = 2 if name == "article" else 1 if name == "main" else 0
    above = 0 if article and parent.other == 1 and parent.article < 2 else parent.other
    return Node(name, _hash(parent.path, name) & ~1, max(parent.article, article), max(above, _is_other(name, attributes, parent.article)))


def _hash(parent: int, kind: str) -> int:
    return xxhash.xxh64_intdigest(kind.encode("utf-8", "surrogatepass"), parent & (2**64 - 1))


_top, _made = Node("", 0, 0, 0), count(1)


def text_token(node: Node, text: str) -> int:
    """The token of a text in an element: odd, where those of tags are even."""
    return _hash(node.path, "#" + " ".join(text.split())) | 1


def parse(page: str | None) -> Iterator[tuple[str, Node, str]]:
    """Events of a page: ("open" | "close", element, "") and ("text", element, text), in page order. An element's token is its path."""
    stack = [_top]
    raw, at, page = None, 0, page or ""
    while at < len(page):
        if raw:
            end = re.compile(f"</{re.escape(raw)}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(page, at)
            at, raw = (end.start() if end else len(page)), None
            continue
        m = _token.match(page, at)
        at = m.end()
        if m[2] is None:
            if page[m.start()] != "<" or m.end() == m.start() + 1:
                text = m[0]
                yield "text", stack[-1], text
            continue
        name = m[2].lower()
        if m[1]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            for node in reversed(stack[k:] if k else []):
                yield "close", node, ""
            del stack[k or len(stack) :]
            continue
        groups = SAME.get(name, ())
        while len(stack) > 1 and (stack[-1].name in groups or name in CLOSES_P and _closes(stack)):
            top = stack.pop()
            yield "close", top, ""
        while name == "body" and len(stack) > 1 and stack[-1].name != "html":  # an unclosed head
            top = stack.pop()
            yield "close", top, ""
        node = stack[-1].child(name, m[3])
        yield "open", node, ""
        if name in VOID or m[3].endswith("/"):
            yield "close", node, ""
        else:
            stack.append(node)
            raw = name if name in RAW else None
    while len(stack) > 1:
        node = stack.pop()
        yield "close", node, ""


def _closes(stack: list[Node]) -> bool:
    """Whether a block-level tag here ends an open paragraph, through inline elements only."""
    for node in reversed(stack):
        if node.name == "p":
            return True
        if node.name not in INLINE:
            return False
    return False


def _host(url: str | None) -> str:
    return split_url(url)[0]


def _key(html: str | None) -> int:
    return xxhash.xxh64_intdigest((html or "").encode("utf-8", "surrogatepass"))


def _distinct(pages: DataFrame) -> DataFrame:
    """host and html of the pages, equal ones of a host once. Only those that occur again are shuffled with their html."""
    keyed = pages.select(host_of("url").alias("host"), "html", F.md5(F.coalesce("html", F.lit(""))).alias("key"))
    again = saved(keyed.groupBy("host", "key").agg(F.count("*").alias("n")).where("n > 1").select("host", "key"), "copies")
    single, copies = keyed.join(again, ["host", "key"], "left_anti"), keyed.join(again, ["host", "key"], "left_semi")
    return single.unionByName(copies.groupBy("host", "key").agg(F.first("html").alias("html"))).select("host", "html")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each slice's sums by host and token; the host's number of pages under token 0."""
    for b in slices(batches, 512):
        found: dict[tuple[str, int], list[int]] = {}
        for host, page in zip(*(c.to_pylist() for c in b.columns), strict=True):
            tokens = Counter(node.path if kind == "open" else text_token(node, text) for kind, node, text in parse(page) if kind == "open" or kind == "text" and not text.isspace())
            tokens[0] = 1
            seed, mixes = _key(page), {}
            for token, n in tokens.items():
                if n not in mixes:
                    mixes[n] = xxhash.xxh64_intdigest(b"%d %d" % (seed, n))
                entry = found.setdefault((host, token), [0, 0])
                entry[0] = (entry[0] + mixes[n]) & (2**64 - 1)
                entry[1] += 1
        hosts = pa.array([h for h, _ in found], pa.string())
        columns = [np.array([t for _, t in found], np.uint64).view(np.int64), np.array([v[0] for v in found.values()], np.uint64).view(np.int64), np.array([v[1] for v in found.values()], np.int64)]
        yield pa.RecordBatch.from_arrays([hosts, *map(pa.array, columns)], ["host", "token", "vector", "pages"])


#: What _structure tells of a host: the rank of a tag's start or a text, of a tag's end, two classes that cross, that there is data.
START, END, CROSS, DATA = range(4)


def structure(page: str | None, classes: dict[int, int], sizes: dict[int, int]) -> tuple[dict[tuple[int, int], int], set[tuple[int, int]], bool]:
    """Of one page: the rank of each symbol in its class (-1 if it is not always the same), the pairs of classes that cross, and whether
    there is text outside the classes. classes: token to class; sizes: symbols of each class, a tag being two."""
    ranks: dict[tuple[int, int], int] = {}
    seen: Counter[int] = Counter()
    crossed: set[tuple[int, int]] = set()
    data, inside = False, []  # classes with an instance begun and not ended, innermost last
    for kind, node, text in parse(page):
        if kind == "text" and text.isspace():
            continue
        token = text_token(node, text) if kind == "text" else node.path
        c = classes.get(token)
        if c is None:
            data = data or kind == "text" and not node.other
            continue
        symbol, rank = (token, END if kind == "close" else START), seen[c] % sizes[c]
        if ranks.setdefault(symbol, rank) != rank:
            ranks[symbol] = -1
        seen[c] += 1
        if rank == 0:
            inside.append(c)
        elif inside[-1] != c:
            crossed.update((min(c, x), max(c, x)) for x in inside[inside.index(c) + 1 :])
        if rank == sizes[c] - 1:
            inside.remove(c)
    return ranks, crossed, data


def _structure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """structure() of each slice's pages, put together by host: (host, side, token, lo, hi)."""
    last: tuple[object, dict[int, int], dict[int, int]] = (None, {}, {})
    for b in slices(batches):
        found: dict[tuple[str, int, int], list[int]] = {}
        cross: set[tuple[str, int, int]] = set()
        for host, page, members in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if host != last[0]:
                classes = {m["token"] & (2**64 - 1): m["vector"] for m in members.as_py()}
                sizes: Counter[int] = Counter()
                for token, c in classes.items():
                    sizes[c] += 1 if token & 1 else 2
                last = (host, classes, sizes)
            ranks, crossed, data = structure(page, last[1], last[2])
            for (token, side), rank in ranks.items():
                entry = found.setdefault((host, side, token), [rank, rank])
                entry[0], entry[1] = min(entry[0], rank), max(entry[1], rank)
            cross.update((host, x, y) for x, y in crossed)
            if data:
                found[host, DATA, 0] = [1, 1]
        keys = [*found, *((host, CROSS, x & (2**64 - 1)) for host, x, _ in cross)]
        bounds = np.array([*found.values(), *((y, y) for _, _, y in cross)], np.int64).reshape(-1, 2)
        tokens = np.array([k[2] for k in keys], np.uint64).view(np.int64)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), *map(pa.array, (tokens, bounds[:, 0].copy(), bounds[:, 1].copy()))]
        yield pa.RecordBatch.from_arrays(columns, ["host", "side", "token", "lo", "hi"])


def nested(members: list[tuple[int, int]], crossed: list[tuple[int, int]]) -> dict[int, list[int]]:
    """The classes that nest, with their tokens: of (token, class) those with a tag, larger ones first, that cross none taken before."""
    classes: dict[int, list[int]] = {}
    for token, c in members:
        classes.setdefault(c, []).append(token)
    against: dict[int, set[int]] = {}
    for x, y in crossed:
        against.setdefault(x, set()).add(y)
        against.setdefault(y, set()).add(x)
    taken: dict[int, list[int]] = {}
    for c in sorted(classes, key=lambda c: (-len(classes[c]), c)):
        if any(token % 2 == 0 for token in classes[c]) and not against.get(c, set()) & taken.keys():
            taken[c] = classes[c]
    return taken


def templates(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, members, crossed, root, data), written: the ordered (token, class, whether on all pages) of each host, the classes that cross, the
    class of what every page has once, and whether the pages have text beside their classes."""
    wrap = lambda c: F.pmod(c, F.lit(2**62).cast("decimal(38,0)"))
    pages = _distinct(pages)
    sums = pages.mapInArrow(_sums, "host string, token long, vector long, pages long")
    sums = sums.groupBy("host", "token").agg(wrap(F.sum(F.col("vector").cast("decimal(38,0)"))).cast("long").alias("vector"), F.sum("pages").alias("pages"))
    sums = saved(sums.where((F.col("pages") >= least_pages) | (F.col("token") == 0)), "token-sums")
    size = sums.where("token = 0").select("host", F.col("pages").alias("all"), F.col("vector").alias("root"))
    wide = sums.where("token <> 0").join(size, "host").where(F.col("pages") >= support * F.col("all"))
    classes = wide.groupBy("host", "root", "vector", (F.col("pages") == F.col("all")).alias("everywhere")).agg(F.collect_set("token").alias("tokens"), F.bool_or(F.col("token") % 2 == 0).alias("valid")).where("valid")
    member = F.explode("tokens").alias("token")
    members = saved(classes.select("host", "root", "vector", "everywhere", member), "members")
    by_host = saved(members.groupBy("host").agg(F.collect_list(F.struct("token", "vector")).alias("members")), "classes")
    found = saved(pages.join(by_host, "host").select("host", "html", "members").mapInArrow(_structure, "host string, side int, token long, lo long, hi long").groupBy("host", "side", "token", F.when(F.col("side") == CROSS, F.col("lo")).alias("other")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "structure")
    ordered = found.where(F.col("side") <= END).groupBy("host", "token").agg(F.bool_and((F.col("lo") == F.col("hi")) & (F.col("lo") >= 0)).alias("ordered")).where("ordered").select("host", "token")
    crossed = found.where(F.col("side") == CROSS).groupBy("host").agg(F.collect_list(F.struct(F.col("token").alias("a"), F.col("other").alias("b"))).alias("crossed"))
    data = found.where(F.col("side") == DATA).select("host", F.lit(True).alias("data"))
    known = members.join(ordered, ["host", "token"]).groupBy("host").agg(F.collect_list(F.struct("token", "vector", "everywhere")).alias("members"), F.first("root").alias("root"))
    return saved(known.join(crossed, "host", "left").join(data, "host", "left").withColumn("data", F.coalesce("data", F.lit(False))), "templates")


def main_text(page: str | None, outside: frozenset[int] | set[int] = frozenset(), inside: frozenset[int] | set[int] = frozenset()) -> str:
    """The main text of one page. outside and inside: the tokens that are its host's template outside and inside article and main elements."""
    events = list(parse(page))
    in_article = any(node.article and not node.other for kind, node, _ in events if kind == "open")
    blocks: list[list[str]] = [[]]
    for kind, node, text in events:
        if kind == "text":
            if not node.other and (node.article or not in_article):
                template = inside if node.article else outside
                if not template or text_token(node, text) not in template:
                    blocks[-1].append(text)
        elif node.name not in INLINE:
            if blocks[-1]:
                blocks.append([])
        elif node.name == "br":
            blocks[-1].append(" ")
    joined = (_space.sub(" ", entities.unescape("".join(b))).strip() for b in blocks)
    return "\n".join(b for b in joined if b)


def extract(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    known = templates(p, support, least_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[object, frozenset[int], frozenset[int]] = (None, frozenset(), frozenset())
        for b in slices(batches):
            texts = []
            for page, name, members, crossed, root, data in zip(*(b.column(k).to_pylist() if k < 4 else b.column(k) for k in range(2, 8)), strict=True):
                if name != last[0]:
                    last = (name, *_template(members.as_py(), crossed.as_py(), root.as_py(), data.as_py()))
                texts.append(main_text(page, last[1], last[2]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    keyed = p.withColumn("host", host_of("url"))
    return keyed.join(known, "host", "left").select("page_id", "url", "html", "host", "members", "crossed", "root", "data").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def _template(members: list[dict] | None, crossed: list[dict] | None, root: int | None, data: bool | None) -> tuple[frozenset[int], frozenset[int]]:
    """The tokens of a host's template outside and inside articles. Where no page has data, what every page has once is no template."""
    members = members or []
    taken = nested([(m["token"], m["vector"]) for m in members], [(x["a"], x["b"]) for x in crossed or ()])
    everywhere = {m["vector"] for m in members if m["everywhere"]}
    tokens = lambda of: frozenset(t & (2**64 - 1) for c in of for t in taken[c])
    return tokens(c for c in taken if data or c != root), tokens(c for c in taken if c in everywhere and c != root)


def host_of(url: str) -> F.Column:
    """urlfilter.split_url's host as a column."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring_index(F.substring_index(F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"), "/", 1), "?", 1), "#", 1))
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))

"""HTML extraction with a site style tree: same-host pages are merged node by node, entropy gives each node's importance, and unimportant branches go."""

from __future__ import annotations

import html as references
import math
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as c
from .graph import components
from .urls import host_of

#: Importance below which nodes are noise, pages of a host that must have a node, and the weight of what stands below it.
LEAST_IMPORTANCE = 0.35
LEAST_PAGES = 4
GAMMA = 0.9
#: Of a host with many pages, nodes on less than this share of them are weighed apart, branch by branch, and what they come to is handed to
#: what holds them: so no task has more of a host's tree than a thousand pages' nodes, or one such branch.
LEAST_SHARE = 0.001
#: Bytes of the table of unimportant branches up to which it is broadcast; a larger one is joined by host.
BROADCAST_BYTES = 16 << 20

#: Elements whose branch is never content, and those whose text is not markup.
NEVER = frozenset("annotation annotation-xml aside audio button canvas desc dialog embed fieldset footer form frame frameset head iframe input map menu nav noframes noscript object option script select style template textarea title video".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of formulas and drawings: their text runs on with what stands around them, and a slash at the end of a tag closes them.
_FORMULA = "annotation annotation-xml math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics"
_DRAWING = "circle clippath defs desc ellipse g line lineargradient marker mask path pattern polygon polyline radialgradient rect stop svg symbol text textpath tspan use"
FOREIGN = frozenset(f"{_FORMULA} {_DRAWING}".split())
INLINE = FOREIGN | frozenset("a abbr acronym b bdi bdo big br button cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are marked as a page's main content: evidence for what is in them, which the style tree does not overrule for the elements
#: themselves, nor for what holds one, but does for branches within. Headings within go only with what stands around them.
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the key ends an open element of its values.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "body": ("head",)}
#: Elements beyond which an end tag or an implied end does not reach.
SCOPES = frozenset("article aside body div footer form header html main nav section table td th ul ol dl".split())
_NAMES = """ad ads adbox advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promotions menu menubar nav navbar
navigation navi breadcrumb breadcrumbs sidebar sidenav rail widget widgets masthead topbar toolbar cookie cookies consent gdpr notice notices notification
notifications alert popup modal overlay subscribe subscription newsletter signup login signin social share sharing sharebar related recommended
recommendations comment comments commentlist disqus respond reply replies discussion pagination pager footer colophon copyright skip skiplink""".split()
#: Words of class, id and role by which a branch is never content; header only outside the main content.
BOILERPLATE = frozenset(_NAMES) | {"complementary", "contentinfo", "search", "searchbox", "form", "alertdialog"}
#: Within the main content a name counts only as a whole: all its words are boilerplate or these.
NEUTRAL = frozenset("area articles bar block bottom box button buttons card col column container content global group holder icon icons inner item items js left link links list module outer page panel post posts primary region right row secondary section site slot small large text title top unit wrap wrapper zone".split())
#: Names that, as the id of a part of the main content, are but the anchor of a section about that.
ANCHORS = frozenset("alert comment consent copyright discussion form login notice notices notification notifications popup promotion promotions recommendations recommended related reply respond search share sharing signup social subscribe subscription widget".split())

# An attribute is a name and perhaps a value: names end at white space, / or =, and a quote opens a value only after = and if it is closed.
_VALUE = r"\"[^\"]*+\"|'[^']*+'|[^\s>]++"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:{_VALUE})?+)?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE})?+)?+")
_READ = frozenset("class id role hidden open style itemprop aria-hidden".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_hashes: dict[tuple[int, str], int] = {}


def _hash(parent: int, segment: str) -> int:
    """A 62-bit name of a path, from its parent's and its last segment."""
    key = parent, segment
    if key not in _hashes:
        if len(_hashes) > 1 << 17:
            _hashes.clear()
        raw = f"{parent} {segment}".encode("utf-8", "surrogatepass")
        _hashes[key] = zlib.crc32(raw) << 30 | zlib.crc32(raw[::-1] + b"*") >> 2
    return _hashes[key]


class Node:
    __slots__ = ("tag", "path", "parent", "never", "main", "children", "inline", "silent")

    def __init__(self, tag: str, path: int, parent: "Node | None", never: bool, main: bool) -> None:
        self.tag, self.path, self.parent, self.never, self.main = tag, path, parent, never, main
        self.children: list[str] = []
        self.inline = tag in INLINE
        #: an inline element that is boilerplate in a block that is not: its text is left out, and the block goes on
        self.silent = self.inline and never and parent is not None and (parent.silent or not parent.never)


def _attributes(source: str) -> dict[str, str]:
    """Attributes that are read, by whole lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if (name := name.lower()) in _READ and name not in found:
            found[name] = references.unescape(value[1:-1] if len(value) > 1 and value[0] in "\"'" and value[-1] == value[0] else value)
    return found


def _words(name: str) -> set[str]:
    return {p.lower() for p in _PART.findall(name)}


def _named(tag: str, found: dict[str, str], in_main: bool) -> bool:
    """Whether class, id or role say that an element is boilerplate. The id of a heading is an anchor and says nothing."""
    names = [*found.get("class", "").split(), found.get("role", "")]
    own = found.get("id", "") if tag not in HEADINGS else ""
    if not in_main:
        return any(_words(x) & BOILERPLATE for x in (*names, own))
    whole = lambda x: bool((w := {y for y in _words(x) if not y.isdigit()}) & BOILERPLATE) and w <= BOILERPLATE | NEUTRAL
    return any(map(whole, names)) or whole(own) and own.lower() not in ANCHORS


def _open(tag: str, source: str, parent: Node) -> Node:
    found = _attributes(source) if source and not source.isspace() else {}
    main = parent.main or tag in MAIN or found.get("role", "").lower() == "main" or found.get("itemprop", "").lower() == "articlebody"
    never = parent.never or tag in NEVER and not (tag == "dialog" and "open" in found) or _named(tag, found, parent.main) or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", ""), re.I))
    never = never or (not parent.main and (tag == "header" or any("header" in _words(found.get(x, "")) for x in ("class", "id", "role"))))
    if tag in ("html", "body"):
        never = parent.never
    segment = f"{tag}.{found.get('class', '').strip()}#{re.sub('[0-9]+', '0', found.get('id', ''))}"
    return Node(tag, _hash(parent.path, segment), parent, never, main)


def parse(page: str) -> tuple[list[tuple[Node, str]], list[Node]]:
    """Blocks of text with the innermost block element each stands in, in page order, and all elements but inline ones.

    A block ends where an element that is not inline begins or ends; br is white space within it. Character references are decoded, runs of
    white space become one space, and blocks without text are none. Ends that HTML lets out are put in; what is never closed ends with the page."""
    root = Node("", 0, None, False, False)
    here, blocks, nodes, text = root, [], [], []
    at, size = 0, len(page)

    def flush() -> None:
        if text:
            said = " ".join(references.unescape("".join(text)).split())
            text.clear()
            if said:
                node = here
                while node.inline and node.parent is not None:
                    node = node.parent
                blocks.append((node, said))

    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            text.append("" if here.silent else page[at:])
            break
        if m.start() > at and not here.silent:
            text.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text.append(references.unescape(m[0][9:].removesuffix("]]>")).replace("&", "&amp;"))
            continue
        if tag == "br":
            text.append("\n")
            continue
        inline = tag in INLINE or tag == "title" and here.tag in FOREIGN
        if m[1]:
            node = here
            while node.parent is not None and node.tag != tag and (inline is False or node.inline) and not (node.tag in SCOPES and tag not in SCOPES):
                node = node.parent
            if node.tag != tag or node.parent is None:
                continue
            if not inline:
                flush()
            here = node.parent
            continue
        if not inline:
            flush()
            node, ends = here, ENDS.get(tag, ())
            while node.parent is not None and node.tag not in SCOPES - set(ends):
                if node.tag == "p" or node.tag in ends:
                    here = node.parent
                node = node.parent
            if node.tag in ends and node.parent is not None:
                here = node.parent
        if tag in VOID:
            continue
        new = _open(tag, m[3], here)
        if not inline:
            nodes.append(new)
            here.children.append(tag)
        if m[3].endswith("/") and tag in FOREIGN:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        here = new
    flush()
    return blocks, nodes


def lineage(node: Node) -> list[Node]:
    out = []
    while node is not None and node.parent is not None:
        out.append(node)
        node = node.parent
    return out


def main_text(page: str | None, low: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's main text: no boilerplate by kind or name, and none of the branches in low.

    Text in article or main elements is the page's, without what else there is, if it is as long at least as all that the tree leaves outside of
    them; else (an article that is but a teaser, say) both stay. Branches of low within them are left out if at least half of their text stays.
    If low would leave nothing, it is not applied: the style tree then knows this page as one of equals only."""
    blocks, _ = parse(page or "")
    blocks = [(n, t) for n, t in blocks if not n.never]
    dropped = [bool(low) and any(x.path in low and not (x.main and x.tag in HEADINGS) for x in lineage(n)) for n, _ in blocks]
    marked = sum(len(t) for n, t in blocks if n.main)
    inside = sum(len(t) for (n, t), gone in zip(blocks, dropped) if n.main and not gone)
    outside = sum(len(t) for (n, t), gone in zip(blocks, dropped) if not n.main and not gone)
    if marked:
        whole = 2 * inside < marked
        others = outside > (marked if whole else inside)
        blocks = [(n, t) for (n, t), gone in zip(blocks, dropped) if (whole or not gone if n.main else others and not gone)]
    elif outside:
        blocks = [b for b, gone in zip(blocks, dropped) if not gone]
    return "\n\n".join(t for _, t in blocks)


def _guard(node: Node) -> bool:
    """Whether node is marked as main content itself, not only within what is."""
    return node.tag in MAIN or node.main and not (node.parent is not None and node.parent.main)


def observations(page: str) -> list[tuple[int, int, bool, int, int]]:
    """What a page adds to its site's tree: path, parent, guard (marked as main content), kind and value. Kind 0 is an element's style, the
    order of its children, once for each path; kind 1 a text that stands right in the element."""
    blocks, nodes = parse(page)
    seen = {}
    for node in nodes:
        if node.path not in seen:
            seen[node.path] = (node.path, node.parent.path, _guard(node), 0, zlib.crc32(" ".join(node.children).encode()))
    texts = {(n.path, n.parent.path if n.parent else 0, _guard(n), 1, zlib.crc32(t.encode("utf-8", "surrogatepass")) << 20 | len(t) & 0xFFFFF) for n, t in blocks}
    return [*seen.values(), *texts]


def weighed(nodes: list[tuple[int, int, bool, int, float, float, int]], least: float, pages: int, apart: dict[int, tuple[int, float, float, bool]]) -> tuple[list[int], dict[int, float], dict[int, bool], list[int]]:
    """Of one site's tree, or a branch of it: the topmost nodes, each node's importance, whether it is noise with all that is below it, and the
    topmost branches that are. apart: of children that are not among nodes their number, the sum of importance times pages, the sum of pages, and
    whether all are noise."""
    known = {n[0]: n for n in nodes}
    children: dict[int, list[int]] = {}
    for n in nodes:
        children.setdefault(n[1] if n[1] in known and n[1] != n[0] else 0, []).append(n[0])
    order, stack = [], list(children.get(0, ()))
    while stack:
        order.append(x := stack.pop())
        stack += children.get(x, ())
    value: dict[int, float] = {}
    noise: dict[int, bool] = {}
    for x in reversed(order):
        _, _, guard, m, style, text, n_texts = known[x]
        below = [(value[y], known[y][3]) for y in children.get(x, ())] + ([(1 - text, m)] if n_texts else [])
        number, total, weight, quiet = apart.get(x, (0, 0.0, 0.0, True))
        g = GAMMA ** (len(below) + number)
        value[x] = (1 - g) * style + g * (sum(v * w for v, w in below) + total) / (sum(w for _, w in below) + weight) if below or number else style
        noise[x] = not guard and m >= pages and value[x] < least and quiet and all(noise[y] for y in children.get(x, ()))
    out, stack = [], list(children.get(0, ()))
    while stack:
        x = stack.pop()
        if noise[x]:
            out.append(x)
        else:
            stack += children.get(x, ())
    return children.get(0, []), value, noise, sorted(out)


def importance(nodes: list[tuple[int, int, bool, int, float, float, int]], least: float = LEAST_IMPORTANCE, pages: int = LEAST_PAGES) -> list[int]:
    """Of one site's tree the topmost branches that are unimportant, with all that is below them.

    nodes: path, parent, guard, number of pages, entropy of styles, mean entropy of texts, number of texts. A node's importance is its style
    entropy and, the more its children weigh, theirs: (1 - g) * own + g * mean of children, g = GAMMA ** number of children; texts are
    a child of importance 1 - their mean entropy. Entropies are to the base of the number of pages."""
    return weighed(nodes, least, pages, {})[3]


def style_tree(pages: DataFrame, least: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES) -> tuple[DataFrame, DataFrame | None]:
    """pages: __host, __html. Returns __host and low, the paths of its unimportant branches, for hosts that have any; and __host and path of those
    among the nodes that are on less than LEAST_SHARE of a host's pages (None if no host has such nodes).

    Pages add counted observations, which are summed before and after the exchange. Paths that fewer than least_pages pages have are no noise by
    definition; all that they have to say is that neither is what holds them. What is put together for a host is a row for each path that
    LEAST_SHARE of its pages have. What stands in a rarer node is rarer still: such nodes make whole branches, each of which is weighed by itself,
    and their holder gets the sums. So the tree is weighed as a whole, whatever the share is."""
    seen = pages.where("__host <> '' AND __html IS NOT NULL")

    def look(batches):
        for batch in batches:
            hosts, htmls = batch.column(batch.schema.get_field_index("__host")), batch.column(batch.schema.get_field_index("__html"))
            for i, j in c.pieces(htmls):
                rows, found = [], []
                for k, page in enumerate(htmls.slice(i, j - i).to_pylist()):
                    own = observations(page)
                    found += own
                    rows += [i + k] * len(own)
                columns = list(zip(*found)) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays([hosts.take(pa.array(rows, pa.int64())), *(pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64())))], names=["__host", "path", "parent", "guard", "kind", "value"])

    found = seen.select("__host", "__html").mapInArrow(look, "__host string, path long, parent long, guard boolean, kind int, value long")
    counts = found.groupBy("__host", "path", "parent", "guard", "kind", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))
    styles, texts = F.col("kind") == 0, F.col("kind") == 1
    each = counts.groupBy("__host", "path").agg(
        F.min("parent").alias("parent"),
        F.max("guard").alias("guard"),
        F.sum(F.when(styles, F.col("n"))).alias("m"),
        F.sum(F.when(styles, F.col("n") * F.log("n"))).alias("s"),
        F.sum(F.when(texts, F.log("n"))).alias("t"),
        F.count(F.when(texts, 1)).alias("n_texts"),
    )
    each = c.stash(each.where("m IS NOT NULL"), "html-nodes")
    hosts = c.hold(each.groupBy("__host").agg(F.max("m").alias("pages"), F.count(F.lit(1)).alias("n")).where(F.col("pages") >= least_pages))
    each = c.spread_join(each, hosts.drop("n"), ["__host"], hosts.drop("pages"), hosts.agg(F.sum("n")).first()[0] or 0)
    often = F.col("m") >= least_pages
    holders = each.where(~often).select("__host", F.col("parent").alias("path"), F.lit(True).alias("holds")).distinct()
    each = each.where(often).join(holders, ["__host", "path"], "left").withColumn("guard", F.col("guard") | F.col("holds").isNotNull())
    log_m = F.log("m")
    each = each.select(
        "__host", "path", "parent", "guard", F.col("m").cast("int").alias("m"),
        F.when(F.col("m") > 1, (log_m - F.col("s") / F.col("m")) / log_m).otherwise(1.0).alias("style"),
        F.when((F.col("m") > 1) & (F.col("n_texts") > 0), F.least(F.lit(1.0), F.col("t") / F.col("n_texts") / log_m)).otherwise(0.0).alias("text"),
        F.col("n_texts").cast("int").alias("n_texts"), (F.col("m") < F.col("pages") * LEAST_SHARE).alias("rare"),
    )
    each = c.stash(each, "html-nodes")
    names = ("path", "parent", "guard", "m", "style", "text", "n_texts")
    rare, common = each.where("rare").drop("rare"), each.where("NOT rare").drop("rare")
    nothing = [F.lit(None).cast(t).alias(x) for x, t in (("number", "long"), ("total", "double"), ("weight", "double"), ("quiet", "boolean"))]
    few = None
    if rare.isEmpty():
        common = common.select("*", *nothing)
    else:
        node = lambda x: F.concat_ws(" ", F.col(x).cast("string"), "__host")
        held = rare.select(node("path").alias("a"), node("parent").alias("b"))
        ends = components(held.join(held.select(F.col("a").alias("b")), "b", "left_semi"))
        branches = rare.withColumn("node", node("path")).join(ends, "node", "left").withColumn("branch", F.coalesce("root", "node"))

        def weigh_branch(table: pa.Table) -> pa.Table:
            nodes = list(zip(*(table.column(x).to_pylist() for x in names)))
            tops, value, noise, low = weighed(nodes, least, least_pages, {})
            rows = [(n[1], value[n[0]], n[3], noise[n[0]], low if k == 0 else []) for k, n in enumerate(n for n in nodes if n[0] in set(tops))]
            parent, values, m, quiet, lows = zip(*rows) if rows else [()] * 5
            return pa.table({"__host": table.column("__host").slice(0, 1).take(pa.array([0] * len(rows), pa.int64())), "path": pa.array(parent, pa.int64()), "value": pa.array(values, pa.float64()), "m": pa.array(m, pa.int32()), "noise": pa.array(quiet, pa.bool_()), "low": pa.array(lows, pa.list_(pa.int64()))})

        tops = c.stash(branches.groupBy("branch").applyInArrow(weigh_branch, "__host string, path long, value double, m int, noise boolean, low array<long>"), "html-branches")
        c.release(ends)
        sums = tops.groupBy("__host", "path").agg(F.count(F.lit(1)).alias("number"), F.sum(F.col("value") * F.col("m")).alias("total"), F.sum(F.col("m").cast("double")).alias("weight"), F.min("noise").alias("quiet"))
        common = common.join(sums, ["__host", "path"], "left")
        few = tops.select("__host", F.explode("low").alias("path"))

    def weigh(table: pa.Table) -> pa.Table:
        apart = {x: rest for x, *rest in zip(*(table.column(y).to_pylist() for y in ("path", "number", "total", "weight", "quiet"))) if rest[0]}
        low = weighed(list(zip(*(table.column(x).to_pylist() for x in names))), least, least_pages, apart)[3]
        return pa.table({"__host": table.column("__host").slice(0, 1 if low else 0), "low": pa.array([low] if low else [], pa.list_(pa.int64()))})

    return common.groupBy("__host").applyInArrow(weigh, "__host string, low array<long>"), few


def pages_with(pages: DataFrame, few: DataFrame) -> DataFrame:
    """pages: __host, __page (a digest of the html), __html; few: __host, path. Returns __host, __page and own, those of the paths that the page has,
    for pages that have any: a host may have many rare branches, a page has but its own."""
    hosts = few.select("__host").distinct()

    def look(batches):
        for batch in batches:
            htmls = batch.column(batch.schema.get_field_index("__html"))
            for i, j in c.pieces(htmls):
                own = [{n.path for n in parse(page)[1]} for page in htmls.slice(i, j - i).to_pylist()]
                rows = pa.array([i + k for k, x in enumerate(own) for _ in x], pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)).take(rows) for x in ("__host", "__page")), pa.array([y for x in own for y in x], pa.int64())], names=["__host", "__page", "path"])

    # hosts with rare nodes have thousands of pages each, so there are few of them
    seen = pages.where("__html IS NOT NULL").join(F.broadcast(hosts), "__host", "left_semi").select("__host", "__page", "__html")
    return seen.mapInArrow(look, "__host string, __page string, path long").join(few, ["__host", "path"]).groupBy("__host", "__page").agg(F.collect_set("path").alias("own"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", least: float = LEAST_IMPORTANCE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Append text and n_chars to every row of pages.

    Null html and pages without text give the empty string and 0. Pages whose URL has no host are judged without a tree, by kinds and names of
    elements alone; so are, in effect, hosts of fewer than least_pages pages. Repeated rows count as so many pages and get equal texts.
    An empty table gives no rows; input columns named text or n_chars are replaced."""
    c.small_batches(pages.sparkSession)
    kept, schema = c.with_columns(pages, [("text", T.StringType()), ("n_chars", T.LongType())])
    keyed = kept.withColumns({"__host": host_of(F.col(f"`{url_col}`").cast("string")), "__html": F.col(f"`{html_col}`")})
    tree, few = style_tree(keyed, least, least_pages)
    tree = c.stash(tree, "html-tree")
    size = tree.agg(F.sum(F.length("__host") + 8 * F.size("low") + 32)).first()[0] or 0
    own = None
    if few is not None and not (few := c.stash(few, "html-few")).isEmpty():
        keyed = keyed.withColumn("__page", F.md5(F.col("__html").cast("binary")))
        own = c.stash(pages_with(keyed, few), "html-own")
    keyed = keyed.drop("__html")
    if size <= BROADCAST_BYTES:
        joined = keyed.join(F.broadcast(tree), "__host", "left")
    else:
        hosts = c.hold(keyed.groupBy("__host").agg(F.count(F.lit(1)).alias("n")))
        joined = c.spread_join(keyed, tree, ["__host"], hosts, hosts.agg(F.sum("n")).first()[0] or 0, "left")
    if own is None:
        joined = joined.withColumn("own", F.lit(None).cast("array<long>"))
    elif (own.agg(F.sum(F.length("__host") + 8 * F.size("own") + 64)).first()[0] or 0) <= BROADCAST_BYTES:
        joined = joined.join(F.broadcast(own), ["__host", "__page"], "left")
    else:
        copies = c.hold(keyed.groupBy("__host", "__page").agg(F.count(F.lit(1)).alias("n")))
        joined = c.spread_join(joined, own, ["__host", "__page"], copies, copies.agg(F.sum("n")).first()[0] or 0, "left")
    joined = joined.select(*[F.col(f"`{n}`") for n in kept.columns], F.col("low").alias("__low"), F.col("own").alias("__own"))
    where = kept.columns.index(html_col)

    def run(batches):
        for batch in batches:
            for i, j in c.pieces(batch.column(where)):
                part = batch.slice(i, j - i)
                lows, owns = (part.column(part.num_columns - k).to_pylist() for k in (2, 1))
                texts = [main_text(h, frozenset((*(low or ()), *(own or ())))) for h, low, own in zip(part.column(where).to_pylist(), lows, owns)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*part.schema.names[:-2], "text", "n_chars"])

    return joined.mapInArrow(run, schema)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = extract(c.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", "n_chars")

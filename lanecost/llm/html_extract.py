"""Main-text extraction by wrapper induction.

Pages of one host are made by the same program, so their DOM trees align: what stays
the same is template, what varies is a slot that may hold content. A page becomes a
tree of block elements; runs of equal siblings (paragraphs, list items) fold into one
repeated node. Trees of a host are aligned by simple tree matching, the largest
order-preserving match of nodes with equal labels, and merged into one template whose
nodes count the pages they were seen on and remember whether their text was always the
same. A node seen on most of at least ``min_pages`` pages with one text is template and
dropped; nodes that cannot hold an article (menus, headers, footers, asides, forms,
scripts, notices, adverts, comments, hidden parts, lists of links) are dropped wherever
they vary too. If a page marks its article, only that part counts.

Templates are merged in three steps (a task's pages, a few hundred shares of a host,
the host), each on trees of at most ``max_nodes`` nodes, so a host with a third of all
pages never meets in one task.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from lanecost.llm.util import slices, stage

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img br".split())
RAW = frozenset("script style noscript template iframe svg math canvas object audio video title textarea".split())
NEVER = frozenset("head nav footer aside form button select menu dialog header fieldset".split()) | RAW
BOILER = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                   "consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter "
                   "notice popup promo promoted related replies share sharing sidebar social sponsor sponsored subscribe "
                   "toolbar widget".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
          "tfoot": ("tbody", "tr", "td", "th")}
SCOPE = frozenset("ul ol dl table article main section div body html nav aside".split())

_TAG = re.compile(r"""<(?:!--(?:.*?--!?>|.*+)|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^'">]++)*+)(?:>|\Z))""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_JUDGED = re.compile(r"class|id\b|role|hidden|style|itemprop", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Node:
    __slots__ = ("tag", "label", "boiler", "named", "main", "parts", "links")

    def __init__(self, tag: str, label: str, boiler: bool, main: bool, named: bool = False):
        self.tag, self.label, self.boiler, self.main = tag, label, boiler, main
        self.named = named          # boiler by its class or id alone
        self.parts: list = []       # texts and nodes in page order
        self.links = 0              # characters of own text inside links


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(source):
        out.setdefault(name.lower(), html_lib.unescape(value.strip("\"'")))
    return out


def _judge(tag: str, source: str) -> tuple[str, bool, bool, bool]:
    """(label for alignment, cannot hold an article, marks the article, cannot hold one by
    its class or id alone). Classes of html, body and main tell of the page, not of them."""
    if not _JUDGED.search(source):
        return tag, tag in NEVER, tag in ("article", "main"), False
    a = _attributes(source)
    names = f"{a.get('class', '')} {a.get('id', '')}"
    words = set(_SPLIT.split(_CAMEL.sub(r"\1 \2", names).lower())) if names.strip() else set()
    role = a.get("role", "").lower()
    named = tag not in ("html", "body", "main") and bool(words & BOILER)
    boiler = (tag in NEVER or role in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
              or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "").lower()) is not None)
    main = tag in ("article", "main") or role in ("main", "article") or a.get("itemprop", "").lower() == "articlebody"
    label = f"{tag}.{'.'.join(sorted(a.get('class', '').lower().split()))}" if "class" in a else tag
    if tag in ("article", "main") and not named:
        boiler = False
    return label, boiler or named, main, named and not boiler


def parse(source: str, max_depth: int = 150) -> Node:
    """Tree of block elements (and of inline ones that cannot hold text of an article).
    Unclosed and misnested tags are tolerated; text outside any element is kept."""
    root = Node("#root", "#root", False, False)
    stack = [root]
    deeper: list[str] = []      # open elements below the deepest level, and how many of each tag
    open_deeper: Counter = Counter()
    at, link = 0, 0
    low = None

    def text(upto: int) -> None:
        if upto > at:
            t = source[at:upto]
            stack[-1].parts.append(html_lib.unescape(t) if "&" in t else t)
            if link:
                stack[-1].links += len(t.strip())

    for_next = _TAG.search
    m = for_next(source, 0)
    while m:
        text(m.start())
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            pass
        elif m[1]:
            if tag == "a":
                link = max(0, link - 1)
            if open_deeper[tag]:
                if tag not in INLINE or deeper[-1] in INLINE:
                    while True:
                        open_deeper[last := deeper.pop()] -= 1
                        if last == tag:
                            break
                m = for_next(source, at)
                continue
            for i in range(len(stack) - 1, 0, -1):
                if deeper and tag in INLINE:
                    break
                if stack[i].tag == tag:
                    del stack[i:]
                    deeper.clear()
                    open_deeper.clear()
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            if tag == "br":
                stack[-1].parts.append(" ")
        else:
            attrs = m[3]
            if tag in RAW:
                if low is None:
                    low = source.lower() if len(source.lower()) == len(source) else source
                if not attrs.endswith("/"):
                    end = low.find(f"</{tag}", at)
                    close = source.find(">", end) if end >= 0 else -1
                    at = close + 1 if close >= 0 else len(source)
            elif tag in ("br", "hr") or tag in VOID:
                stack[-1].parts.append(" " if tag in INLINE else Node(tag, tag, False, False))
            else:
                label, boiler, main, named = _judge(tag, attrs)
                if tag == "a":
                    link += 1
                if tag not in INLINE or boiler:
                    if not deeper and tag not in INLINE and any(n.tag == "p" for n in stack[-3:]):
                        for i in range(len(stack) - 1, 0, -1):       # a block ends an open paragraph
                            if stack[i].tag == "p":
                                del stack[i:]
                                break
                            if stack[i].tag in SCOPE:
                                break
                    for i in range(len(stack) - 1, 0, -1) if not deeper else ():
                        if stack[i].tag in CLOSES.get(tag, ()):
                            del stack[i:]
                        elif stack[i].tag in SCOPE:
                            break
                    if tag not in INLINE:
                        link = 0
                    node = Node(tag, label, boiler, main, named)
                    stack[-1].parts.append(node)
                    if attrs.endswith("/"):
                        pass
                    elif len(stack) < max_depth:
                        stack.append(node)
                    else:
                        deeper.append(tag)
                        open_deeper[tag] += 1
        m = for_next(source, at)
    text(len(source))
    while not _has_main(root) and _open_wrappers(root):
        pass
    return root


def _open_wrappers(node: Node) -> bool:
    """Of a page whose marked articles all stand in boilerplate: take the outermost elements
    that are boilerplate by name alone and hold one as plain wrappers. Tells if there were any."""
    found = False
    for p in node.parts:
        if isinstance(p, Node):
            if not p.boiler:
                found |= _open_wrappers(p)
            elif p.named and _wraps_main(p):
                p.boiler, found = False, True
    return found


def _wraps_main(node: Node) -> bool:
    return any(isinstance(p, Node) and (not p.boiler or p.named) and (p.main and not p.boiler or _wraps_main(p))
               for p in node.parts)


# A template node is [label, pages, text, children]: text is "" for none, a hash, or "*".
def skeleton(node: Node, pages: int = 1) -> list:
    """The folded tree of an element: runs of equal siblings are one node, whose text is
    a hash of all theirs."""
    own = " ".join("".join(p for p in node.parts if isinstance(p, str)).split())
    kids: list[list] = []
    texts: list[list[str]] = []
    for p in node.parts:
        if isinstance(p, Node):
            k = skeleton(p, pages)
            if kids and kids[-1][0] == k[0]:
                texts[-1].append(k[2])
                k[2] = kids[-1][2]
                _merge(kids[-1], k, 1 << 30, add=0)
            else:
                kids.append(k)
                texts.append([k[2]])
    for k, t in zip(kids, texts):
        if len(t) > 1 and any(t):
            k[2] = xxhash.xxh64_hexdigest("".join(t))
    return [node.label, pages, xxhash.xxh64_hexdigest(own.encode("utf-8", "replace")) if own else "", kids]


def matching(a: list[list], b: list[list]) -> list[tuple[int, int]]:
    """Simple tree matching of two child lists: pairs of the largest ordered match."""
    if [x[0] for x in a] == [y[0] for y in b]:
        return [(i, i) for i in range(len(a))]
    score = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    weight = [[_size(x, y) if x[0] == y[0] else 0 for y in b] for x in a]
    for i in range(len(a)):
        for j in range(len(b)):
            score[i + 1][j + 1] = max(score[i][j + 1], score[i + 1][j], score[i][j] + weight[i][j])
    out, i, j = [], len(a), len(b)
    while i and j:
        if weight[i - 1][j - 1] and score[i][j] == score[i - 1][j - 1] + weight[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif score[i][j] == score[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _size(x: list, y: list) -> int:
    """Matched nodes of two trees with equal labels."""
    return 1 + sum(_size(x[3][i], y[3][j]) for i, j in matching(x[3], y[3]))


def _count(t: list) -> int:
    return 1 + sum(_count(k) for k in t[3])


def _merge(t: list, page: list, room: int, add: int | None = None) -> int:
    """Merge a tree into a template with the same root label; returns the room left for
    new nodes. ``add``: pages to count (all of the tree's by default)."""
    t[1] += page[1] if add is None else add
    if t[2] != page[2]:
        t[2] = "*"
    pairs = matching(t[3], page[3])
    taken = {j: i for i, j in pairs}
    for i, j in pairs:
        room = _merge(t[3][i], page[3][j], room, add)
    if len(taken) < len(page[3]):
        kids, at = [], 0
        for j, k in enumerate(page[3]):
            if j in taken:
                kids += t[3][at:taken[j] + 1]
                at = taken[j] + 1
            elif (n := _count(k)) <= room:
                kids.append(k)
                room -= n
        t[3] = kids + t[3][at:]
    return room


def absorb(t: list | None, page: list, max_nodes: int) -> list:
    if t is None:
        return page
    _merge(t, page, max(0, max_nodes - _count(t)))
    return t


def has_text(t: list) -> bool:
    return bool(t[2]) or any(map(has_text, t[3]))


def _place(parent: int, label: str, run: int) -> int:
    """Number of a place below a place: the ``run``-th run of siblings of one label."""
    return xxhash.xxh64_intdigest(f"{parent} {run} {label}") >> 1


def places(t: list, here: int = 0):
    """(place, text) of every node of a folded tree that has a text of its own."""
    seen: dict[str, int] = {}
    for k in t[3]:
        run = seen[k[0]] = seen.get(k[0], -1) + 1
        at = _place(here, k[0], run)
        if k[2]:
            yield at, k[2]
        yield from places(k, at)


def _mark_places(node: Node, fixed: set[int], constant: set[int], here: int = 0) -> None:
    """Collect the elements that stand alone at a place of the template."""
    seen: dict[str, int] = {}
    parts = [p for p in node.parts if isinstance(p, Node)]
    for i, p in enumerate(parts):
        if not i or parts[i - 1].label != p.label:
            seen[p.label] = seen.get(p.label, -1) + 1
        at = _place(here, p.label, seen[p.label])
        if at in fixed and not (i and parts[i - 1].label == p.label or i + 1 < len(parts) and parts[i + 1].label == p.label):
            constant.add(id(p))
        _mark_places(p, fixed, constant, at)


def main_text(source: str, template: list | None = None, min_pages: int = 5, share: float = 0.5, fixed=()) -> str:
    """The article of a page: blocks in page order, white space inside a block as one
    blank, joined by one blank. ``template``: the merged tree of the page's host;
    ``fixed``: places that hold one and the same text on most of its pages."""
    root = parse(source)
    constant: set[int] = set()
    if template is not None and template[1] >= min_pages:
        _mark(root, template, share * template[1], constant)
        if fixed:
            _mark_places(root, set(fixed), constant)
    blocks: list[str] = []
    inline: list[str] = []
    marked = _has_main(root)

    def flush() -> None:
        t = " ".join("".join(inline).split())
        inline.clear()
        if t:
            blocks.append(t)

    def walk(node: Node, inside: bool, heading_only: bool) -> None:
        inside = inside or node.main
        block = node.tag not in INLINE
        if block:
            flush()
        for p in node.parts:
            if isinstance(p, str):
                if inside and id(node) not in constant and (not heading_only or node.tag in HEADINGS):
                    inline.append(p)
            elif p.boiler:
                # the header of an article holds its title
                if inside and p.tag == "header":
                    walk(p, inside, True)
            elif not (not marked and _link_list(p)):
                walk(p, inside, heading_only)
        if block:
            flush()

    walk(root, not marked, False)
    flush()
    return " ".join(blocks)


def _has_main(node: Node) -> bool:
    return any(isinstance(p, Node) and not p.boiler and (p.main or _has_main(p)) for p in node.parts)


def _lengths(node: Node) -> tuple[int, int]:
    """(characters of text, of them in links) below a node."""
    n, k = sum(len(p.strip()) for p in node.parts if isinstance(p, str)), node.links
    for p in node.parts:
        if isinstance(p, Node) and not p.boiler:
            a, b = _lengths(p)
            n, k = n + a, k + b
    return n, k


def _link_list(node: Node) -> bool:
    if node.tag not in ("ul", "ol", "table", "div", "dl"):
        return False
    n, k = _lengths(node)
    return n > 0 and 10 * k >= 7 * n


def _mark(node: Node, t: list, most: float, constant: set[int]) -> None:
    """Collect the elements whose own text is template: on most pages, always the same."""
    groups: list[list[Node]] = []
    for p in node.parts:
        if isinstance(p, Node):
            if groups and groups[-1][0].label == p.label:
                groups[-1].append(p)
            else:
                groups.append([p])
    if [g[0].label for g in groups] == [k[0] for k in t[3]]:
        pairs = [(i, i) for i in range(len(groups))]
    else:
        pairs = matching(t[3], [skeleton(g[0]) for g in groups])
    for i, j in pairs:
        for p in groups[j]:
            if len(groups[j]) == 1 and t[3][i][2] not in ("", "*") and t[3][i][1] > most:
                constant.add(id(p))
            if t[3][i][3]:
                _mark(p, t[3][i], most, constant)


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_templates(pages: DataFrame, url_col: str, html_col: str, max_nodes: int = 400, shares: int = 64,
                   share: float = 0.5) -> DataFrame:
    """(host, template, fixed, varies): for each host one merged tree, as JSON; the places
    that hold one text wherever they occur, and that on over ``share`` of its pages; and
    whether a place on so many pages holds several. Pages without text count nowhere.

    The tree is merged up to ``max_nodes`` nodes, for the alignment of pages whose elements
    move. Places are rows that Spark counts, without a bound on their number and in any order
    of the pages.
    """
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("share", T.IntegerType()),
                           T.StructField("template", T.StringType()), T.StructField("pages", T.LongType()),
                           T.StructField("place", T.ArrayType(T.LongType())), T.StructField("text", T.ArrayType(T.StringType())),
                           T.StructField("n", T.ArrayType(T.LongType()))])
    tree = T.StructType(schema.fields[:3])

    def rows(found: dict, part: int):
        cols = [list(found), [part] * len(found), [json.dumps(f[0]) for f in found.values()], [f[1] for f in found.values()],
                [list(f[2]) for f in found.values()], [[x[0] for x in f[2].values()] for f in found.values()],
                [[x[1] for x in f[2].values()] for f in found.values()]]
        types = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.names)

    def induce(batches):
        part = TaskContext.get().partitionId() % shares
        found: dict[str, list] = {}
        held = 0
        for hosts, htmls in slices(batches, 1):
            for host, source in zip(hosts, htmls):
                page = skeleton(parse(source or ""))
                if not has_text(page):
                    continue
                f = found.setdefault(host, [None, 0, {}])
                f[1] += 1
                for at, text in places(page):
                    x = f[2].get(at)
                    if x is None:
                        f[2][at] = [text, 1]
                        held += 1
                    else:
                        x[0], x[1] = text if x[0] == text else "*", x[1] + 1
                f[0] = absorb(f[0], page, max_nodes)
            if len(found) > 2000 or held > 200_000:
                yield rows(found, part)
                found, held = {}, 0
        if found:
            yield rows(found, part)

    def combine(table: pa.Table) -> pa.Table:
        t = None
        for x in sorted(table.column("template").to_pylist()):
            t = absorb(t, json.loads(x), max_nodes)
        return pa.table({"host": [table.column("host")[0].as_py()], "share": pa.array([0], pa.int32()),
                         "template": [json.dumps(t)]}).cast(pa.schema([("host", pa.string()), ("share", pa.int32()), ("template", pa.string())]))

    src = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("__html"))
    parts = stage(src.mapInArrow(induce, schema), "host-parts")
    trees = (parts.select(*tree.names).groupBy("host", "share").applyInArrow(combine, tree)
             .groupBy("host").applyInArrow(combine, tree).select("host", "template"))
    counted = parts.groupBy("host").agg(F.sum("pages").alias("pages"))
    at = (parts.select("host", F.explode(F.arrays_zip("place", "text", "n")).alias("x")).select("host", "x.*")
          .groupBy("host", "place").agg(F.sum("n").alias("n"), F.min("text").alias("lo"), F.max("text").alias("hi"))
          .join(counted, "host").filter(F.col("n") > share * F.col("pages")))
    one = (F.col("lo") == F.col("hi")) & (F.col("lo") != "*")
    fixed = at.groupBy("host").agg(F.sort_array(F.collect_list(F.when(one, F.col("place")))).alias("fixed"),
                                   F.max(~one).alias("varies"))
    return trees.join(fixed, "host", "left")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 5,
            share: float = 0.5, max_nodes: int = 400) -> DataFrame:
    """One row per page: id, url, ``text`` (empty if there is none) and ``n_chars`` (its code
    points).

    A null html is empty; pages without url or host share one template; hosts of fewer
    than ``min_pages`` pages with text have none and rely on the marks alone. Repeated rows
    are pages of their own, pages that are all alike have no varying slot and keep their
    article; a page whose slots differ from the others' (a notice, an error page) does not
    change that of theirs; htmls of any length are read whole; other columns are ignored,
    whatever their names; an empty table gives no rows.
    """
    templates = stage(host_templates(pages, url_col, html_col, max_nodes, share=share), "templates")
    src = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html"),
                       host_of(F.col(url_col)).alias("__host"))
    known_as = F.struct("template", "fixed", "varies")
    rows = (src.join(templates.select(F.col("host").alias("__host"), F.when(F.col("template").isNotNull(), known_as).alias("__t")),
                     "__host", "left").select("__id", "__url", "__html", "__t.template", "__t.fixed", "__t.varies", "__host"))
    schema = T.StructType([pages.schema[id_col], pages.schema[url_col], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        known: dict[str, tuple | None] = {}
        for batch in batches:
            texts = []
            for htmls, trees, fixed, varies, hosts in slices([batch.select([2, 3, 4, 5, 6])], 0):
                for source, t, places_, differ, host in zip(htmls, trees, fixed, varies, hosts):
                    if host not in known:
                        if len(known) > 500:
                            known.clear()
                        whole = json.loads(t) if t else None
                        known[host] = (whole, frozenset(places_ or ())) if whole and (differ or _varies(whole, share)) else (None, ())
                    texts.append(main_text(source or "", known[host][0], min_pages, share, known[host][1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _varies(t: list, share: float) -> bool:
    """Whether a slot on over ``share`` of the template's pages varies; copies of one page
    have none."""
    def any_slot(x):
        return x[2] == "*" and x[1] > share * t[1] or any(any_slot(k) for k in x[3])
    return any_slot(t)

"""Main-text extraction by wrapper induction.

Each host has a reference page (that with the smallest content hash).  Every page of the host is
aligned with it by simple tree matching: the largest mapping of nodes with
equal labels that keeps parents and the order of siblings.  Runs of alike
siblings (paragraphs, list items) are one iterator node, so trees stay small.
Over all pages of the host, a reference node whose text is the same on nearly all
aligned pages is constant and becomes template; a node whose text varies is a
slot.  An iterator that varies may hold constant members (a notice among
paragraphs): a block of the reference whose whole inline text is among the
aligned blocks of nearly all pages is template too.  A second alignment labels
the nodes of each page.

Slots hold content, but also menus, adverts and footers that change from page to
page.  Regions that their element, role or class marks as such are left out as
well.  Where a page declares its article (``article``, ``main``), the content is
the varying text inside, with the inline elements that stand in it; otherwise it
is all varying text outside those regions.
A declared article of nothing but template is a copy of the host's other pages,
and stays whole.

Counts are partial sums by (host, node).  Pages are joined to one small wrapper
per host, so a host with a third of all pages needs no task of its own.

Defined cases: null or empty html and pages without content give the empty
string; a null or unreadable url is a host of its own; a host with fewer than
``MIN_PAGES`` other pages has no template; repeated rows each get their row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from .common import column_or_null, map_batches, stage, table

MIN_PAGES = 3          # aligned pages, besides the reference, that a constant needs
CONSTANT = 0.9         # share of them with the same text

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
          "tbody": ("thead tbody tr td th", "table"), "thead": ("tbody tr td th", "table"), "tfoot": ("tbody tr td th", "table")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
DROP = frozenset("nav footer aside form script style noscript template iframe svg button select textarea head title dialog "
                 "menu object embed canvas".split())
DROP_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
DROP_NAME = re.compile(r"^(ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|"
                       r"popup|modal|overlay|sidebar|side|aside|widget|comments?|replies|reply|respond|disqus|discussion|nav|"
                       r"navbar|navigation|menu|breadcrumbs?|footer|foot|pagination|pager|share|sharing|social|related|"
                       r"recommend\w*|newsletter|subscribe|subscription|signup|login|toolbar|topbar|masthead|copyright|legal|"
                       r"disclaimer|skip|search)$")
DROP_HEAD = re.compile(r"^(header|head|top)$")
MAIN = frozenset(("article", "main"))

TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[(.*?)(?:\]\]>|\Z)|[!?/][^A-Za-z>]?[^>]*>"
                 r"|([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|([A-Za-z][^\s/>]*)([^>]*)>)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
SPLIT = re.compile(r"[\s_-]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "drop", "main", "label", "parts", "children", "parent")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        self.tag, self.parent, self.parts, self.children = tag, parent, [], []
        names, role, hidden = "", "", False
        if attributes and not attributes.isspace():
            for k, v in ATTRIBUTE.findall(attributes):
                k, v = k.lower(), html.unescape(v.strip("\"'"))
                if k in ("class", "id"):
                    names += " " + v
                elif k == "role":
                    role = v.strip().lower()
                elif k == "hidden" or v.strip().lower() == "true":
                    hidden = True
        within = parent is not None and parent.main
        self.main = within or tag in MAIN or role in MAIN
        words = [w.lower() for w in SPLIT.split(CAMEL.sub("-", names)) if w] if names else ()
        self.drop = (hidden or tag in DROP or role in DROP_ROLE
                     or (tag not in MAIN and tag not in ("html", "body") and any(DROP_NAME.match(w) for w in words))
                     or (not within and (tag == "header" or any(DROP_HEAD.match(w) for w in words) and tag not in ("html", "body"))))
        self.label = tag + names.lower() if names else tag


def tree(text: str) -> Node:
    """The element tree of a page; missing end tags are implied."""
    root = Node("#page", "", None)
    here, at, end = root, 0, len(text)
    while at < end:
        m = TAG.search(text, at)
        stop = m.start() if m else end
        if stop > at:
            here.parts.append(html.unescape(text[at:stop]))
        if not m:
            break
        at = m.end()
        if m[1] is not None:
            here.parts.append(m[1])
            continue
        name = m[2] or m[4]
        if name is None:
            if text.startswith("</", stop):
                name = re.match(r"</\s*([^\s/>]*)", text[stop:at])[1].lower()
                up = here
                while up is not root and up.tag != name:
                    if up.tag in ("td", "th", "table", "article", "main") and name in INLINE:
                        up = root
                        break
                    up = up.parent
                if up is not root:
                    here = up.parent
            continue
        name = name.lower()
        attributes = m[3] if m[2] else m[5]
        if name in CLOSES_P:
            up = here
            while up is not root and up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                here = up.parent
        elif name in CLOSES:
            shut, within = CLOSES[name]
            up, found = here, None
            while up is not root and up.tag not in within:
                if up.tag in shut:
                    found = up
                up = up.parent
            if found is not None:
                here = found.parent
        if name in ("html", "body") and any(c.tag == name for c in root.children):
            continue
        node = Node(name, attributes, here)
        here.children.append(node)
        here.parts.append(node)
        if name in VOID or attributes.endswith("/") and name not in INLINE and name not in CLOSES_P:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(text, at)
            at = close.end() if close else end
            continue
        here = node
    return root


def inline_nodes(block: Node) -> list[Node]:
    """The block and the inline elements in it, down to the next blocks."""
    out, todo = [], [block]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [c for c in n.children if c.tag in INLINE]
    return out


def inline_text(block: Node) -> str:
    """The block's own text and that of the inline elements in it."""
    out, todo = [], [block]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is block or x.tag in INLINE:
            todo += reversed(x.parts)
        else:
            out.append(" ")
    return " ".join("".join(out).split())


# ------------------------------------------------------------------ alignment

class Skeleton:
    """A tree for matching: (label, own text hash, children) in flat lists, with
    runs of alike siblings as one node.  ``nodes[i]`` are the page's elements,
    ``members`` the (node, hash of the whole inline text) of single blocks."""

    def __init__(self) -> None:
        self.label, self.text, self.kids, self.nodes = [], [], [], []
        self.members: list[tuple[int, str]] = []

    @classmethod
    def of(cls, root: Node) -> Skeleton:
        out = cls()
        todo = [(-1, [root])]                              # own stack: pages nest deeper than Python's
        while todo:
            up, alike = todo.pop()
            i = len(out.label)
            if up >= 0:
                out.kids[up].append(i)
            own = " ".join("".join(p for p in n.parts if isinstance(p, str)) for n in alike).split()
            out.label.append(alike[0].label)
            out.text.append(" ".join(own)[:4000] and _digest(" ".join(own)))
            out.kids.append([])
            out.nodes.append(alike)
            if alike[0].tag not in INLINE:
                out.members += sorted({(i, _digest(t)) for t in map(inline_text, alike) if t})
            runs: list[list[Node]] = []
            for child in [c for n in alike for c in n.children]:
                if not runs or runs[-1][0].label != child.label:
                    runs.append([])
                runs[-1].append(child)
            todo += [(i, run) for run in reversed(runs)]
        return out

    def dump(self) -> str:
        return json.dumps([self.label, self.text, self.kids, self.members])

    @classmethod
    def load(cls, text: str) -> Skeleton:
        out = cls()
        out.label, out.text, out.kids, members = json.loads(text)
        out.members = [(i, t) for i, t in members]
        return out

    def members_of(self) -> dict[int, set[str]]:
        out = defaultdict(set)
        for i, t in self.members:
            out[i].add(t)
        return out


def _digest(text: str) -> str:
    import hashlib
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


TRACE_CELLS = 1 << 20          # of a table that is kept whole to read the mapping from


def _last_row(worth: np.ndarray, a: np.ndarray, b: np.ndarray, table: list | None = None) -> np.ndarray:
    """Best weights of mapping all of the row a to each prefix of b, in order."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        new = np.zeros_like(row)
        np.maximum.accumulate(np.maximum(row[1:], row[:-1] + worth[x, b]), out=new[1:])
        row = new
        if table is not None:
            table.append(row)
    return row


def _mapping(worth: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Positions of a heaviest mapping that keeps the order.  Long rows are
    halved (the halves' best rows meet where their sum is largest), so memory
    stays linear and the weight exact."""
    if not len(a) or not len(b):
        return []
    if len(a) > 1 and len(a) * len(b) > TRACE_CELLS:
        half = len(a) // 2
        cut = int((_last_row(worth, a[:half], b) + _last_row(worth, a[half:][::-1], b[::-1])[::-1]).argmax())
        return _mapping(worth, a[:half], b[:cut]) + [(x + half, y + cut) for x, y in _mapping(worth, a[half:], b[cut:])]
    table = [np.zeros(len(b) + 1, np.int64)]
    _last_row(worth, a, b, table)
    out, x, y = [], len(a), len(b)
    while x and y:
        if table[x][y] == table[x - 1][y]:
            x -= 1
        elif table[x][y] == table[x][y - 1]:
            y -= 1
        else:
            x, y = x - 1, y - 1
            out.append((x, y))
    return out[::-1]


def align(a: Skeleton, b: Skeleton) -> list[tuple[int, int]]:
    """Simple tree matching: pairs of matched nodes of a and b.  Subtrees of equal
    shape are one class, which maps to itself whole; other pairs of classes are
    matched once, however many nodes have them."""
    if a.label[0] != b.label[0]:
        return []
    classes: dict[tuple, int] = {}
    label, kids, size = [], [], []

    def class_of(t: Skeleton) -> list[int]:
        out = [0] * len(t.label)
        for i in reversed(range(len(t.label))):            # children have larger numbers
            key = (t.label[i], tuple(out[k] for k in t.kids[i]))
            if key not in classes:
                classes[key] = len(classes)
                label.append(key[0])
                kids.append(np.array(key[1], np.int64))
                size.append(1 + sum(size[k] for k in key[1]))
            out[i] = classes[key]
        return out

    ca, cb = class_of(a), class_of(b)
    known: dict[tuple[int, int], int] = {}

    def worth_of(i: int, j: int) -> int:
        return size[i] if i == j else known[i, j] if label[i] == label[j] else 0

    def shapes(i: int, j: int):
        (ua, xa), (ub, xb) = (np.unique(kids[k], return_inverse=True) for k in (i, j))
        return ua.tolist(), xa, ub.tolist(), xb

    todo = [(ca[0], cb[0])]
    while todo:                                            # pairs below a pair come first
        i, j = todo[-1]
        if i == j or (i, j) in known:
            todo.pop()
            continue
        ua, xa, ub, xb = shapes(i, j)
        below = [(x, y) for x in ua for y in ub if x != y and label[x] == label[y] and (x, y) not in known]
        if below:
            todo += below
            continue
        todo.pop()
        worth = np.array([[worth_of(x, y) for y in ub] for x in ua], np.int64).reshape(len(ua), len(ub))
        known[i, j] = 1 + int(_last_row(worth, xa, xb)[-1])
    out, todo, maps = [], [(0, 0)], {}
    while todo:
        i, j = todo.pop()
        out.append((i, j))
        if ca[i] == cb[j]:
            todo += zip(a.kids[i], b.kids[j])
            continue
        if (ca[i], cb[j]) not in maps:
            ua, xa, ub, xb = shapes(ca[i], cb[j])
            worth = np.array([[worth_of(x, y) for y in ub] for x in ua], np.int64).reshape(len(ua), len(ub))
            maps[ca[i], cb[j]] = _mapping(worth, xa, xb)
        todo += [(a.kids[i][x], b.kids[j][y]) for x, y in maps[ca[i], cb[j]]]
    return out


# ------------------------------------------------------------------ text

def main_text(root: Node, template: set[int]) -> str:
    """Text outside dropped regions and without template nodes (by ``id``); only
    that inside the declared article if there is one."""
    declared, todo = False, [root]
    while todo and not declared:
        n = todo.pop()
        if not n.drop:
            declared = n.main
            todo += n.children
    out: list[str] = []
    sentences: set[int] = set()                            # elements with varying text of an article
    stack: list = [root]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.drop:
            out.append(" ")
            continue
        block = x.tag not in INLINE
        phrase = not block and id(x.parent) in sentences
        fixed = id(x) in template and not phrase
        if x.main and not fixed and (phrase or any(isinstance(p, str) and not p.isspace() for p in x.parts)):
            sentences.add(id(x))
        keep = (x.main or not declared) and not fixed
        if block:
            out.append(" ")
            stack.append(" ")
        stack += [p for p in reversed(x.parts) if keep or not isinstance(p, str)]
    text = " ".join("".join(out).split())
    return main_text(root, set()) if declared and template and not text else text


# ------------------------------------------------------------------ Spark

def _reference_pass(batches):
    for rb in batches:
        yield pa.RecordBatch.from_arrays(
            [rb.column("host"), pa.array([Skeleton.of(tree(t or "")).dump() for t in rb.column("html").to_pylist()], pa.string())],
            ["host", "skeleton"])


def _stat_pass(batches):
    for rb in batches:
        refs: dict[str, Skeleton] = {}
        seen, same = defaultdict(int), defaultdict(int)
        for host, text, ref in zip(*(rb.column(c).to_pylist() for c in ("host", "html", "skeleton"))):
            if host not in refs:
                refs[host] = Skeleton.load(ref)
            page = Skeleton.of(tree(text or ""))
            aligned = dict(align(refs[host], page))
            for i, j in aligned.items():
                if refs[host].text[i] or page.text[j]:
                    seen[host, i] += 1
                    same[host, i] += refs[host].text[i] == page.text[j]
            held = page.members_of()
            for m, (i, t) in enumerate(refs[host].members, len(refs[host].label)):
                if i in aligned:                           # members are counted behind the nodes
                    seen[host, m] += 1
                    same[host, m] += t in held.get(aligned[i], ())
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([seen[k] for k in keys], pa.int64()), pa.array([same[k] for k in keys], pa.int64())],
            ["host", "node", "seen", "same"])


def _extract_pass(batches):
    for rb in batches:
        refs: dict[str, Skeleton] = {}
        texts = []
        for host, text, ref, constant in zip(*(rb.column(c).to_pylist() for c in ("host", "html", "skeleton", "constant"))):
            root, template = tree(text or ""), set()
            if constant and ref:
                if host not in refs:
                    refs[host] = Skeleton.load(ref)
                page, fixed, members = Skeleton.of(root), set(constant), defaultdict(set)
                for m, (i, t) in enumerate(refs[host].members, len(refs[host].label)):
                    if m in fixed:
                        members[i].add(t)
                for i, j in align(refs[host], page):
                    if i in fixed and refs[host].text[i] == page.text[j]:
                        template.update(id(n) for n in page.nodes[j])
                    for block in page.nodes[j] if i in members else ():
                        if _digest(inline_text(block)) in members[i]:
                            template.update(map(id, inline_nodes(block)))
            texts.append(main_text(root, template))
        yield pa.RecordBatch.from_arrays([rb.column("page_id"), rb.column("url"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def with_host(pages: DataFrame) -> DataFrame:
    url = column_or_null(pages, "url", "string")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(column_or_null(pages, "page_id", "long").alias("page_id"), url.alias("url"),
                        column_or_null(pages, "html", "string").alias("html"), F.coalesce(host, F.lit("")).alias("host"))


def induce(rows: DataFrame) -> DataFrame:
    """(host, skeleton, constant): the wrapper of each host."""
    content = F.coalesce(F.xxhash64("html"), F.lit(0))
    pick = stage(rows.select("host", content.alias("h")).groupBy("host").agg(F.min("h").alias("h")), "pick")
    reference = (rows.withColumn("h", content).join(pick, ["host", "h"]).dropDuplicates(["host"]).select("host", "html"))
    skeletons = stage(map_batches(reference, _reference_pass, "host string, skeleton string"), "skeletons")
    others = (rows.withColumn("h", content).join(pick.withColumnRenamed("h", "ref"), "host").filter("h <> ref")
              .join(skeletons, "host").select("host", "html", "skeleton"))
    stats = (map_batches(others, _stat_pass, "host string, node int, seen long, same long")
             .groupBy("host", "node").agg(F.sum("seen").alias("seen"), F.sum("same").alias("same")))
    constant = (stats.filter((F.col("seen") >= MIN_PAGES) & (F.col("same") >= CONSTANT * F.col("seen")))
                .groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("constant")))
    return stage(skeletons.join(constant, "host", "left"), "wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    rows = with_host(pages)
    return map_batches(rows.join(induce(rows), "host", "left").select("page_id", "url", "host", "html", "skeleton", "constant"),
                       _extract_pass, "page_id long, url string, text string, n_chars long")


def q_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op5_html_wrapper": q_html_wrapper}
ORACLES: dict = {}

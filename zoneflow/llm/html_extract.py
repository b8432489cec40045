"""HTML extraction by wrapper induction: DOM trees of same-host pages are aligned by simple
tree matching; nodes whose text is the same on nearly all pages become template, varying
slots content. Menus, adverts and other page furniture are left out by their markup."""

from __future__ import annotations

import bisect
import collections
import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import sized, slices, written
from zoneflow.llm.url_filter import host_path

MIN_PAGES = 5           # distinct pages of a host that must share a slot before it can be template
TEMPLATE_SHARE = 0.9    # of them with the same text in it
MAX_DEPTH = 100         # of the trees that are aligned; texts of deeper nodes fill their ancestor's slot there

# HTML vocabulary (fixed values of the language).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp", "noembed", "noframes"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
         "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody",
         "td", "template", "tfoot", "th", "thead", "tr", "ul"}
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
             "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "optgroup"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "tfoot"}, {"table"}),
             "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
# Page furniture by element, by role and by word of a class or id.
SKIP_TAGS = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "template", "button", "select", "svg", "canvas", "object", "audio", "video", "map", "search", "fieldset", "label"}
SKIP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar", "tablist"}
LAYOUT_WORDS = {"sidebar", "side", "menu", "nav", "navbar", "navigation", "header", "footer", "masthead", "topbar", "toolbar", "widget", "widgets", "breadcrumb", "breadcrumbs"}
STRONG_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup",
                "modal", "overlay", "newsletter", "subscribe", "subscription", "share", "sharing", "social", "related", "recommended", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies",
                "login", "signup", "signin", "register", "pagination", "pager", "tags", "hidden", "disclaimer", "alert"}
REMARK_WORDS = {"comment", "comments", "reply", "replies"}  # an article of these is a reader's
TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)


class Node:
    __slots__ = ("tag", "label", "parent", "children", "skip", "layout", "blocks", "sig", "slot", "depth")

    def __init__(self, tag: str, parent: Node | None, label: str = "", skip: bool = False, layout: bool = False):
        self.tag, self.parent, self.label, self.skip, self.layout = tag, parent, label or tag, skip, layout
        self.children, self.blocks, self.sig, self.slot = [], [], "", -1
        self.depth = 0 if parent is None else parent.depth + 1


def _markup(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """Label, whether the node is furniture for certain, and whether only by its layout name."""
    found = {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTR.finditer(attrs)} if attrs and tag not in ("html", "body") else {}
    names = (found.get("class", "") + " " + found.get("id", "")).lower().split()
    skip = tag in SKIP_TAGS or found.get("role", "").lower() in SKIP_ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    layout = tag == "header"
    for name in names:
        parts = [p for p in re.split(r"[^a-z]+", name) if p]
        if tag in ("article", "main"):  # a topic may use such words ("social-science"): only whole names tell
            skip = skip or name in STRONG_WORDS or bool(parts) and parts[0] in REMARK_WORDS
            continue
        if name in STRONG_WORDS or parts and (parts[0] in STRONG_WORDS or parts[-1] in STRONG_WORDS):
            skip = True
        if name in LAYOUT_WORDS or parts and (parts[0] in LAYOUT_WORDS or parts[-1] in LAYOUT_WORDS):
            layout = True
    words = sorted({re.sub(r"[0-9]+", "0", n) for n in names})
    return tag + "".join("." + w for w in words), skip, layout


def parse(text: str) -> tuple[Node, list[tuple[Node, str]]]:
    """Tree of block elements and furniture, and the text blocks in page order, each with its
    node. Missing end tags are implied as browsers do; inline markup is dissolved."""
    root = Node("#root", None)
    stack, blocks, run = [root], [], []
    open_at: dict[str, list[int]] = collections.defaultdict(list)  # places on the stack of each open tag
    at = 0

    def flush() -> None:
        if run:
            words = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if words:
                blocks.append((stack[-1], words))

    def pop_to(n: int) -> None:
        flush()
        for node in stack[n:]:
            open_at[node.tag].pop()
        del stack[n:]

    while at < len(text):
        m = TOKEN.search(text, at)
        if not m:
            run.append(text[at:])
            break
        if m.start() > at:
            run.append(text[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, end, attrs = tag.lower(), m["end"] or m["end2"], m["attrs"] or m["attrs2"] or ""
        if end:
            if open_at[tag]:
                pop_to(open_at[tag][-1])
            elif tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(text, at)
            at = close.end()
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            else:
                run.append(" " if tag == "br" else "")
            continue
        label, skip, layout = _markup(tag, attrs)
        if tag not in BLOCK and not skip:
            continue
        if tag in BLOCK:
            flush()
            if stack[-1].tag == "p":
                pop_to(len(stack) - 1)
            if tag in CLOSED_BY:
                closed, scope = CLOSED_BY[tag]
                floor = max((open_at[t][-1] for t in scope if open_at[t]), default=0)
                first = [open_at[t][i] for t in closed if (i := bisect.bisect(open_at[t], floor)) < len(open_at[t])]
                if first:
                    pop_to(min(first))
            if tag == "body" and open_at["head"]:
                pop_to(open_at["head"][-1])
        else:
            flush()
        if attrs.rstrip().endswith("/") and tag == "svg":
            continue
        node = Node(tag, stack[-1], label, skip, layout)
        stack[-1].children.append(node)
        open_at[tag].append(len(stack))
        stack.append(node)
    flush()
    return root, blocks


def _walk(root: Node) -> Iterator[Node]:
    """Preorder."""
    todo = [root]
    while todo:
        n = todo.pop()
        yield n
        todo.extend(reversed(n.children))


def _regions(root: Node) -> set[Node] | None:
    """Top-level articles, else main elements, that are not furniture; None if there are none.
    A layout name on an ancestor of such a region is only a layout name."""
    shut, found = {}, {"article": set(), "main": set()}
    for n in _walk(root):
        up = n.parent
        shut[n] = up is not None and (shut[up] or up.skip or up.tag == "article")
        if n.tag in found and not n.skip and not shut[n]:
            found[n.tag].add(n)
    return found["article"] or found["main"] or None


def _content(root: Node, regions: set[Node] | None) -> dict[Node, bool]:
    """Whether the text of each node is content: decided from the root down, for its children
    that are headings (which may stand in a header element) and for others."""
    headings = ("h1", "h2", "h3", "h4", "h5", "h6")
    known: dict[Node, tuple[bool, bool]] = {}
    for n in _walk(root):
        plain, heading = known[n.parent] if n.parent is not None else (regions is None, regions is None)
        if regions is not None and n in regions:
            plain = heading = True
        elif n.skip or n.tag == "article" and regions is not None:
            plain = heading = False
        elif n.layout:
            plain, heading = False, heading and n.tag == "header"
        known[n] = (plain, heading)
    return {n: heading if n.tag in headings else plain for n, (plain, heading) in known.items()}


def _fold(root: Node) -> None:
    """Signatures from the leaves up; consecutive siblings of equal structure become one node,
    whose slots stand for all of them. Furniture and nodes at ``MAX_DEPTH`` have no inner structure."""
    order = list(_walk(root))
    for n in reversed(order):
        kept = []
        closed = n.skip or n.depth >= MAX_DEPTH
        for c in ([] if closed else n.children):
            if kept and kept[-1].sig == c.sig:
                for a, b in zip(_walk(kept[-1]), _walk(c)):
                    b.slot = a  # the text of b counts for a
            else:
                kept.append(c)
        if closed:
            for c in n.children:  # deeper nodes have handed their texts on to these
                c.slot = n
        n.children = kept
        n.sig = hashlib.md5((n.label + "(" + ",".join(c.sig for c in kept) + ")").encode("utf-8", "surrogatepass")).hexdigest()


def _slot_of(n: Node) -> int:
    path = []
    while isinstance(n.slot, Node):
        path.append(n)
        n = n.slot
    for m in path:  # the next of a long chain finds its end at once
        m.slot = n
    return n.slot


def _serial(root: Node) -> str:
    """Folded tree as preorder list of (label, number of children)."""
    return json.dumps([[n.label, len(n.children)] for n in _walk(root)], separators=(",", ":"), ensure_ascii=False)


def analyse(text: str) -> tuple[str, str, list[tuple[int, str]]]:
    """(hash of the folded tree, the tree, content blocks with their slots)."""
    root, blocks = parse(text)
    regions = _regions(root)
    content = _content(root, regions)
    kept = [(n, t) for n, t in blocks if content[n]]
    _fold(root)
    for i, n in enumerate(_walk(root)):
        n.slot = i
    return root.sig, _serial(root), [(_slot_of(n), t) for n, t in kept]


def tree_of(serial: str) -> list:
    """Nested [label, children, slot]."""
    rows, stack, root = json.loads(serial), [], None
    for i, (label, n) in enumerate(rows):
        node = [label, [], i]
        if stack:
            stack[-1][0][1].append(node)
            stack[-1][1] -= 1
        else:
            root = node
        stack.append([node, n])
        while stack and stack[-1][1] == 0:
            stack.pop()
    return root


def align(a: list, b: list) -> dict[int, int]:
    """Simple tree matching: the largest set of node pairs (slot of ``a`` to slot of ``b``)
    with equal labels that keeps parents and sibling order."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def match(x: list, y: list) -> tuple[int, list]:
        if x[0] != y[0]:
            return 0, []
        key = (x[2], y[2])
        if key not in memo:
            m, n = len(x[1]), len(y[1])
            best = [[0] * (n + 1) for _ in range(m + 1)]
            for i in range(1, m + 1):
                for j in range(1, n + 1):
                    w = match(x[1][i - 1], y[1][j - 1])[0]
                    best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w)
            pairs, i, j = [], m, n
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    pairs.append((x[1][i - 1], y[1][j - 1]))
                    i, j = i - 1, j - 1
            memo[key] = (best[m][n] + 1, pairs)
        return memo[key]

    out, todo = {}, [(a, b)]
    while todo:
        x, y = todo.pop()
        if match(x, y)[0]:
            out[x[2]] = y[2]
            todo.extend(match(x, y)[1])
    return out


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            rows = []
            for text in part.column("html").to_pylist():
                tree, serial, blocks = analyse(text or "")
                by_slot: dict[int, list[str]] = {}
                for s, t in blocks:
                    by_slot.setdefault(s, []).append(t)
                whole = [_hash("\n".join(x)) for x in by_slot.values()]
                parts = [(s, h) for s, x in by_slot.items() if len(x) > 1 for h in {_hash(t) for t in x}]
                rows.append((tree, serial, _hash("\n".join(t for _, t in blocks)), [*by_slot, *(s for s, _ in parts)], [*whole, *(h for _, h in parts)], [True] * len(whole) + [False] * len(parts)))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("host"), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=["host", "tree", "serial", "page", "slots", "texts", "whole"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        maps = []
        for serial, model in zip(b.column("serial").to_pylist(), b.column("model").to_pylist()):
            own = align(tree_of(serial), tree_of(model))
            maps.append([own.get(i, -1) for i in range(len(json.loads(serial)))])
        yield pa.RecordBatch.from_arrays([b.column("host"), b.column("tree"), pa.array(maps, pa.list_(pa.int32()))], names=["host", "tree", "places"])


def induce(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = TEMPLATE_SHARE) -> DataFrame:
    """Template of the trees that have any: ``host, tree, template`` (array of slots) and
    ``lines`` (array of slot and text hash: single blocks of a slot that stands for siblings).

    Every page counts. Its folded tree is aligned with the host's most frequent one; a slot's
    texts are counted over the distinct pages of the host, at the aligned place (or its own, if
    it has none). A slot is template if at least ``min_pages`` pages have it and ``share`` of
    them the same text; of other such slots, the blocks that ``share`` of these pages hold.
    """
    seen = written(pages.select("host", "html").mapInArrow(_slots, "host string, tree string, serial string, page long, slots array<int>, texts array<long>, whole array<boolean>").dropDuplicates(["host", "page"]), "html-slots")
    trees = seen.groupBy("host", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("serial").alias("serial"))
    trees = written(trees, "html-trees")
    model = trees.groupBy("host").agg(F.max_by("serial", F.struct("n", "tree")).alias("model"))
    placed = written(trees.join(model, "host").mapInArrow(_aligned, "host string, tree string, places array<int>"), "html-places")
    texts = seen.select("host", "tree", F.explode(F.arrays_zip("slots", "texts", "whole")).alias("s"))
    texts = texts.groupBy("host", "tree", F.col("s.slots").alias("slot"), F.col("s.texts").alias("text"), F.col("s.whole").alias("whole")).agg(F.count(F.lit(1)).alias("n"))
    place = F.element_at("places", F.col("slot") + 1)
    texts = texts.join(placed, ["host", "tree"]).withColumn("place", F.when(place >= 0, place.cast("string")).otherwise(F.concat_ws(":", "tree", F.col("slot").cast("string")))).drop("places")
    texts = written(texts, "html-texts")
    per = texts.groupBy("host", "place", "text").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("whole"), F.col("n")).otherwise(0)).alias("n_whole"))
    places = per.groupBy("host", "place").agg(F.sum("n_whole").alias("pages"), F.max("n_whole").alias("same")).where(F.col("pages") >= min_pages)
    places = sized(written(places, "html-pages"))
    constant = places.where(F.col("same") >= share * F.col("pages")).select("host", "place")
    slots = texts.select("host", "tree", "slot", "place").distinct().join(constant, ["host", "place"]).select("host", "tree", "slot", F.lit(None).cast("long").alias("text"))
    often = per.where(F.col("n") >= share * min_pages).join(places, ["host", "place"]).where((F.col("n") >= share * F.col("pages")) & (F.col("same") < share * F.col("pages")))
    often = sized(written(often.select("host", "place", "text"), "html-often"))
    lines = texts.join(often, ["host", "place", "text"]).select("host", "tree", "slot", "text")
    return slots.unionByName(lines).groupBy("host", "tree").agg(
        F.collect_set(F.when(F.col("text").isNull(), F.col("slot"))).alias("template"), F.collect_set(F.when(F.col("text").isNotNull(), F.struct("slot", "text"))).alias("lines"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            rows = [analyse(t or "") for t in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), part.column("host"), pa.array([r[0] for r in rows], pa.string()), pa.array([[s for s, _ in r[2]] for r in rows], pa.list_(pa.int32())),
                                              pa.array([[t for _, t in r[2]] for r in rows], pa.list_(pa.string())), pa.array([[_hash(t) for _, t in r[2]] for r in rows], pa.list_(pa.int64()))],
                                             names=["page_id", "url", "host", "tree", "slots", "blocks", "hashes"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``).

    The text is that of the top-level ``article`` elements (else ``main``, else the body)
    without furniture and without template slots and blocks, one block a line. If all of a
    page is template, its host tells nothing about them and they stay. Null, empty and text-free
    pages have an empty text; a null URL is a host of its own; malformed markup is read as
    browsers do; repeated rows come out as often as they go in; other columns are ignored.
    """
    host, _ = host_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), "html")
    template = sized(written(induce(rows), "html-template"))
    kinds = dict(pages.dtypes)
    found = rows.mapInArrow(_blocks, f"page_id {kinds['page_id']}, url string, host string, tree string, slots array<int>, blocks array<string>, hashes array<long>")
    found = found.join(template, ["host", "tree"], "left")
    pairs = F.arrays_zip("slots", "blocks", "hashes")
    varying = F.filter(pairs, lambda p: ~F.array_contains(F.col("template"), p["slots"]) & ~F.exists("lines", lambda x: (x["slot"] == p["slots"]) & (x["text"] == p["hashes"])))
    kept = F.when(F.col("template").isNull() | (F.size(varying) == 0), F.col("blocks")).otherwise(F.transform(varying, lambda p: p["blocks"]))
    return found.withColumn("text", F.array_join(kept, "\n")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

"""Main-text extraction by wrapper induction over the pages of a host.

A page's DOM tree is made compact: like siblings (paragraphs, list items) count as
one node, and what is marked as no article by its element, name or being invisible is
left out. The compact trees of all pages of a host are aligned by simple tree
matching, and the largest match merges each into one tree per host, the wrapper, whose
nodes are slots. Over all pages that a slot is on, a slot whose text never changes is
template, one whose text varies is content but for the blocks that all those pages
have. Every page is then aligned with its host's wrapper and gives the text of its
content slots; lists of links beside an article go before that.
"""

from __future__ import annotations

import html as entities
import json
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math canvas object select".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike "
    "strong sub sup time tt u var wbr br img".split()
)
ASIDE = set("nav aside footer form button dialog menu fieldset".split())
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert toolbar".split())
#: Words of a class or id that mark what is not the article, wherever they stand in a name.
NAMES = set(
    "adsbygoogle advert adverts advertisement advertising sponsored nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "pagination pager sidebar aside footer masthead topbar toolbar cookie cookies consent gdpr popup modal disqus newsletter signup login".split()
)
#: Words that do so only as a whole name, before one of PLACES (``comment-list``), or behind one of WHOSE (``site-header``): others (``market-share``) tell of a text.
VAGUE = set(
    "ad ads banner promo promoted promotion sponsor widget header notice notices notification alert overlay dialog share sharing social comment "
    "comments reply replies discussion related recommended recommendations subscribe subscription form search copyright legal disclaimer skip".split()
)
PLACES = set("area bar block blocks box buttons container form icons inner label line link links list panel row section slot thread top unit widget wrap wrapper".split())
WHOSE = set("article bottom cookie footer global left main mobile page post primary reader right secondary site sticky top user".split())
#: Inside an article only adverts, reader comments and share bars are told by name; adverts also inside a line.
ADVERTS = set("ad ads adsbygoogle advert adverts advertisement advertising promo promoted promotion sponsor sponsored".split())
INSIDE = ADVERTS | set("comment comments reply replies discussion disqus share sharing social related recommended newsletter subscribe".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements that an opening tag closes: paragraphs end at blocks, items at items.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
WHITE = re.compile(r"\s+")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
RAW_END = {t: re.compile(f"</{t}", re.I | re.A) for t in RAW}
#: Words of a class that tell of a layout (``has-sidebar``), not of the element itself.
STATE = re.compile(r"\b(?:has|with|without|no|is|show|hide)-[a-z]+")
#: Share of a host's pages below which a slot is none; forms or trees merged in one group, on average.
RARE, FAN = 1 / 1000, 64


class Node:
    """An element: name, whether it is marked as no article and lies in one, children, and its own text blocks."""

    __slots__ = ("tag", "label", "skip", "inside", "children", "parts", "link", "links")

    def __init__(self, tag: str, label: str, skip: bool, inside: bool = False):
        self.tag, self.label, self.skip, self.inside = tag, label, skip, inside
        self.children: list[Node] = []
        self.parts: list = []  # text of inline content and, in between, child blocks
        self.link = self.links = 0  # characters inside links, and links


def _named(value: str, inside: bool) -> bool:
    """Whether one of the names in a class or id marks what is not the article."""
    for name in STATE.sub("", value).split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if not inside and any(w in NAMES for w in words):
            return True
        words = words[1:] if len(words) > 1 and words[0] in WHOSE and words[1:] != ["header"] * (words[0] in ("article", "post")) else words
        if words and words[0] in (INSIDE if inside else VAGUE) and all(w in PLACES for w in words[1:]):
            return True
    return False


def _marks(tag: str, attrs: str, inside: bool) -> tuple[str, bool]:
    """Label of an element for alignment, and whether it is no article by element, role or name."""
    names, skip = [], tag in ASIDE or (tag == "header" and not inside)
    for key, value in ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            names.append(re.sub(r"\d+", "", value))
            skip = skip or not (key == "id" and tag in HEADINGS) and _named(value, inside)
        elif key == "role":
            skip = skip or value in ROLES
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and INVISIBLE.search(value):
            skip = True
    return WHITE.sub(" ", " ".join([tag, *names])), skip


def _mute(attrs: str) -> bool:
    """Whether an inline element is an advert or invisible."""
    for key, value in ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and not ADVERTS.isdisjoint(re.split(r"[^a-z]+", STATE.sub("", value))):
            return True
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and INVISIBLE.search(value):
            return True
    return False


def parse(page: str | None) -> Node:
    """The block tree of a page; inline elements dissolve into their block's text."""
    root = Node("html", "html", False)
    stack, text, links, article = [root], page or "", 0, 0
    pos, muted = 0, []  # inline elements open since one that is not shown

    def close(k: int):
        nonlocal article
        for n in stack[k:]:
            article -= n.tag in ("article", "main")
        del stack[k:]

    while True:
        m = TAG.search(text, pos)
        chunk = text[pos : m.start() if m else len(text)]
        if chunk and not muted:
            top = stack[-1]
            top.parts.append(chunk)
            if links:
                top.link += len(chunk.strip())
        if not m:
            return _forms_with_the_page(root)
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE:
                links -= tag == "a" and links > 0
                if tag in muted:
                    while muted.pop() != tag:
                        pass
                continue
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if k:
                close(k)
            continue
        if tag in INLINE or tag in VOID:
            if tag == "br" or tag == "hr":
                stack[-1].parts.append(" ")
            links += tag == "a"
            stack[-1].links += tag == "a"
            if tag not in VOID and (muted or m[3] and _mute(m[3])):
                muted.append(tag)
            continue
        links = 0
        muted.clear()
        if tag in RAW:
            if not m[0].endswith("/>"):
                end = RAW_END[tag].search(text, pos)
                pos = end.start() if end else len(text)
            continue
        if tag in ("html", "body", "head"):
            if tag == "body":
                close(1)
            continue
        if stack[-1].tag == "p":
            close(len(stack) - 1)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in CLOSES.get(tag, ()):
                close(k)
                break
            if stack[k].tag in ("ul", "ol", "table", "dl", "article", "div", "section"):
                break
        label, skip = _marks(tag, m[3], article > 0)
        article += tag in ("article", "main")
        node = Node(tag, label, skip, article > 0)
        stack[-1].children.append(node)
        stack[-1].parts.append(node)
        stack.append(node)


def _forms_with_the_page(root: Node) -> Node:
    """The tree, a form (or an element in the role of one) that holds most of the page's text being no form of its own."""
    order, todo = [], [root]
    while todo:
        order.append(node := todo.pop())
        todo += node.children
    size: dict[int, int] = {}
    for node in reversed(order):
        size[id(node)] = sum(len(p.strip()) if isinstance(p, str) else size[id(p)] for p in node.parts)
    for node in order:
        if node.skip and node.tag == "form" and 2 * size[id(node)] > size[id(root)]:
            node.skip = False
    return root


def link_lists(root: Node) -> set[int]:
    """Elements (by identity) outside articles that are lists of links: three links or more that make up most of an
    element's own text, or the items of a list, two at least, that are mostly links all together."""
    out, todo = set(), [root]
    while todo:
        node = todo.pop()
        todo += node.children
        if node.inside:
            continue
        if node.links > 2 and 2 * node.link > sum(map(len, blocks(node))):
            out.add(id(node))
        items = [c for c in node.children if c.tag in ("li", "dd", "dt", "td")]
        if len(items) > 1 and 2 * sum(c.link for c in items) > sum(len(x) for c in items for x in blocks(c)):
            out.update(map(id, items))
    return out


def blocks(node: Node) -> list[str]:
    """The text blocks directly in an element: its inline text between child blocks, white space as one space."""
    out, run = [], []
    for p in [*node.parts, None]:
        if isinstance(p, str):
            run.append(p)
        elif run:
            line = WHITE.sub(" ", entities.unescape("".join(run)) if any("&" in r for r in run) else "".join(run)).strip()
            if line:
                out.append(line)
            run = []
    return out


def compact(root: Node) -> tuple[str, list[list[Node]]]:
    """The tree with like siblings as one node and without marked elements: its form, a line of depth and label a node
    in document order; and each node's elements."""
    lines, groups = [], []
    todo = [(0, [root])]
    while todo:
        depth, nodes = todo.pop()
        lines.append(f"{depth} {nodes[0].label}")
        groups.append(nodes)
        kids: dict[str, list[Node]] = {}
        for n in nodes:
            for c in n.children:
                if not c.skip:
                    kids.setdefault(c.label, []).append(c)
        todo += [(depth + 1, k) for k in reversed(kids.values())]
    return "\n".join(lines), groups


class Tree:
    """A labelled ordered tree with the number of pages of each node, as lists by node; node 0 is the root."""

    def __init__(self, form: str, pages: int | None = None):
        """Of a form whose nodes are all on ``pages`` pages, or of what :meth:`text` gave."""
        self.label: list[str] = []
        self.kids: list[list[int]] = []
        self.pages: list[int] = []
        path: list[int] = []
        for line in form.split("\n"):
            depth, rest = line.split(" ", 1)
            n, rest = (pages, rest) if pages is not None else rest.split(" ", 1)
            del path[int(depth) :]
            self.add(path[-1] if path else None, rest, int(n))
            path.append(len(self.label) - 1)

    def add(self, parent: int | None, label: str, pages: int, place: int | None = None) -> int:
        new = len(self.label)
        self.label.append(label)
        self.kids.append([])
        self.pages.append(pages)
        if parent is not None:
            kids = self.kids[parent]
            kids.insert(len(kids) if place is None else place, new)
        return new

    def text(self, least: float = 0) -> str:
        """All nodes on ``least`` pages or more, in document order."""
        lines, todo = [], [(0, 0)]
        while todo:
            depth, n = todo.pop()
            if self.pages[n] >= least:
                lines.append(f"{depth} {self.pages[n]} {self.label[n]}")
                todo += [(depth + 1, k) for k in reversed(self.kids[n])]
        return "\n".join(lines)

    def merge(self, other: Tree) -> None:
        """Take in another tree: matched nodes add their pages, the rest is inserted behind its neighbour's partner."""
        partner = align(other, self)
        if partner[0] < 0:
            return
        for n in range(len(other.label)):  # parents come before their children
            at = partner[n]
            self.pages[at] += other.pages[n]
            if all(partner[k] >= 0 for k in other.kids[n]):
                continue
            order, place, fresh = {k: i for i, k in enumerate(self.kids[at])}, 0, 0
            for k in other.kids[n]:
                if partner[k] >= 0:
                    place = order[partner[k]] + 1
                else:
                    partner[k] = self.add(at, other.label[k], 0, place + fresh)
                    fresh += 1


def increasing(pairs: list[tuple[int, int]], weight: list[int], width: int) -> list[int]:
    """Numbers of the pairs ``(i, j)`` of the heaviest chain that rises in both places; pairs sorted by i, then by falling j."""
    if all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:])):
        return list(range(len(pairs)))
    best = [(0, -1)] * (width + 1)  # heaviest chain that ends below a place, kept by a binary indexed tree
    back = []
    for n, (_, j) in enumerate(pairs):
        top, at = (0, -1), j
        while at > 0:
            top = max(top, best[at])
            at -= at & -at
        back.append(top[1])
        mine, at = (top[0] + weight[n], n), j + 1
        while at <= width:
            best[at] = max(best[at], mine)
            at += at & -at
    n, at = (0, -1), width
    while at > 0:
        n = max(n, best[at])
        at -= at & -at
    n, out = n[1], []
    while n >= 0:
        out.append(n)
        n = back[n]
    return out[::-1]


def align(a: Tree, b: Tree) -> list[int]:
    """Simple tree matching: for every node of ``a`` its partner in ``b`` under the largest top-down, order-keeping match, or -1."""
    partner = [-1] * len(a.label)
    if a.label[0] != b.label[0]:
        return partner
    pairs, below = [(0, 0)], []  # pairs of nodes whose parents pair, and of each the pairs of its children
    for x, y in pairs:
        at: dict[str, list[int]] = {}
        for j in range(len(b.kids[y]) - 1, -1, -1):
            at.setdefault(b.label[b.kids[y][j]], []).append(j)
        found = [(i, j) for i, k in enumerate(a.kids[x]) for j in at.get(a.label[k], ())]
        below.append((len(pairs), found))
        pairs += [(a.kids[x][i], b.kids[y][j]) for i, j in found]
    size, chosen = [1] * len(pairs), [()] * len(pairs)
    for n in range(len(pairs) - 1, -1, -1):
        start, found = below[n]
        if found:
            chosen[n] = [start + k for k in increasing(found, size[start : start + len(found)], len(b.kids[pairs[n][1]]))]
            size[n] += sum(size[k] for k in chosen[n])
    todo = [0]
    while todo:
        n = todo.pop()
        partner[pairs[n][0]] = pairs[n][1]
        todo += chosen[n]
    return partner


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _digest(batches):
    """Of every page its host, its form, and per node the hashes of its blocks."""
    for b in batches:
        out = [[], [], []]
        for host, page in zip(*(c.to_pylist() for c in b.columns)):
            root = parse(page)
            gone = link_lists(root)
            form, groups = compact(root)
            row = (host, form, [[_hash(x) for n in g if id(n) not in gone for x in blocks(n)] for g in groups])
            for x, y in zip(out, row):
                x.append(y)
        kinds = [pa.string(), pa.string(), pa.list_(pa.list_(pa.int64()))]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds)], ["host", "form", "blocks"])


def _merged(table: pa.Table) -> pa.Table:
    """The trees of a host's group as one, the most frequent form first; slots too rare to matter are left out."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("pages", "tree", "whole"))), key=lambda r: (-r[0], r[1]))
    tree = None
    for n, text, whole in rows:
        one = Tree(text, None if whole else n)
        if tree is None:
            tree = one
        else:
            tree.merge(one)
    text = tree.text(tree.pages[0] * RARE / 4)
    return pa.table({"host": table.column("host").slice(0, 1), "pages": pa.array([tree.pages[0]], pa.int64()), "tree": [text]})


def _slots(known: dict, tree: str, form: str) -> list[int]:
    """For every node of a page's form its slot in the host's wrapper, or -1; remembered for forms that come again."""
    if len(known) > 2000:
        known.clear()
    key = tree, form
    if key not in known:
        if tree not in known:
            known[tree] = Tree(tree)
        known[key] = align(Tree(form, 1), known[tree])
    return known[key]


def _observe(batches):
    """Per host and slot: smallest and largest hash of its text and number of pages; per host, slot and block: number of pages."""
    known: dict = {}
    for b in batches:
        seen: dict[tuple, list] = {}
        for host, tree, form, blocks_ in zip(*(c.to_pylist() for c in b.columns)):
            for slot, found in zip(_slots(known, tree, form), blocks_):
                if found and slot >= 0:
                    h = xxhash.xxh64_intdigest(np.array(found, np.int64).tobytes()) - (1 << 63)
                    s = seen.setdefault((host, slot, None), [h, h, 0])
                    s[:] = min(s[0], h), max(s[1], h), s[2] + 1
                    for x in set(found):
                        seen.setdefault((host, slot, x), [0, 0, 0])[2] += 1
        keys, values = list(zip(*seen)) or [()] * 3, list(zip(*seen.values())) or [()] * 3
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 4]
        names = ["host", "slot", "block", "low", "high", "pages"]
        yield pa.record_batch([pa.array(c, t) for c, t in zip([*keys, *values], kinds)], names)


def _extract(batches):
    known, role = {}, {}
    for b in batches:
        for at in range(0, b.num_rows, 256):
            ids, urls, texts = [], [], []
            for i, url, page, tree, told, varies in zip(*(c.to_pylist() for c in b.slice(at, 256).columns)):
                root = parse(page)
                if told not in role:
                    role.clear()
                    role[told] = {s["slot"]: s | {"blocks": set(s.get("blocks") or ())} for s in json.loads(told or "[]")}
                roles = role[told]
                drop: dict[int, set | None] = {}  # elements whose own text is no article
                template: dict[int, set | None] = {}  # elements whose own text, or these blocks of it, are template
                drop |= dict.fromkeys(link_lists(root))
                form, groups = compact(root)
                slots = _slots(known, tree, form) if tree else [-1] * len(groups)
                for slot, nodes in zip(slots, groups):
                    nodes = [n for n in nodes if id(n) not in drop]
                    found, r = [x for n in nodes for x in blocks(n)], roles.get(slot)
                    if not found:
                        continue
                    if r and r["constant"]:
                        template |= dict.fromkeys(map(id, nodes))
                    else:
                        common = r["blocks"] if r else ()
                        if common:
                            template |= dict.fromkeys(map(id, nodes), common)
                        varies = varies or any(_hash(x) not in common for x in found)
                ids.append(i)
                urls.append(url)
                texts.append("\n".join(article(root, template | drop if varies else drop)))
            yield pa.record_batch([pa.array(ids, b.schema.field(0).type), pa.array(urls, pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def article(root: Node, drop: dict[int, set | None]) -> list[str]:
    """Text blocks of a page's article in page order, without the elements in ``drop`` (or the blocks whose
    hashes it names) and those marked as no article.

    The article is all ``article`` elements, or else all ``main`` ones, that lie in no other, if they have any text; else
    all that is left of the page.
    """

    def text(top: Node) -> list[str]:
        out, todo = [], [top]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
                continue
            if node.skip:
                continue
            gone = drop.get(id(node), ())
            own, run = [], []
            for p in [*node.parts, None]:
                if isinstance(p, str):
                    run.append(p)
                    continue
                if run and gone is not None:
                    line = WHITE.sub(" ", entities.unescape("".join(run))).strip()
                    if line and not (gone and _hash(line) in gone):
                        own.append(line)
                run = []
                if p is not None:
                    own.append(p)
            todo += reversed(own)
        return out

    def places(tag: str):
        todo = root.children[::-1]
        while todo:
            c = todo.pop()
            if c.skip:
                continue
            if c.tag == tag:
                yield c
            else:
                todo += reversed(c.children)

    for tag in ("article", "main"):
        found = [text(n) for n in places(tag)]
        if any(found):
            return [x for part in found for x in part]
    return text(root)


def wrappers(digest: DataFrame) -> DataFrame:
    """``(host, tree)``: the merged tree of each host's pages.

    Equal forms count once, with their pages. What is left is merged in groups of some
    FAN forms, those groups' trees again, and so on, so no task meets more than a
    group, whatever the number of forms of a host. Slots on less than a quarter of RARE
    of a tree's pages are left out on the way: a tree stays as small as that share
    allows, and one that is on RARE of all pages cannot get lost in it.
    """
    forms = digest.groupBy("host", F.col("form").alias("tree")).agg(F.count("*").alias("pages"))
    forms = materialize(forms.withColumns({"bucket": F.pmod(F.xxhash64("tree"), F.lit(1 << 30)), "whole": F.lit(False)}))
    most = forms.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    parts = 1
    while parts * FAN < most:
        parts *= FAN
    trees = forms
    while True:
        group = trees.withColumn("bucket", F.col("bucket") % parts).groupBy("host", "bucket")
        merged = group.applyInArrow(lambda key, t: _merged(t).append_column("bucket", pa.array([key[1].as_py()], pa.int64())), "host string, pages long, tree string, bucket long")
        if parts == 1:
            return materialize(merged.select("host", "tree"))
        trees = materialize(merged.withColumn("whole", F.lit(True)))
        parts //= FAN


def extract_articles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_pages: int = 2) -> DataFrame:
    """``(page_id, url, text)`` of every page.

    Pages are read twice: for their digest (form and hashes of blocks), from which
    wrappers are built and slots observed, and for their text. Neither pass shuffles
    them where the hosts' wrappers (a few kilobytes a host) are small enough to
    broadcast by their written size; beyond that Spark joins by host and may split hot
    hosts. What a host's pages tell about its slots is combined before it is shuffled,
    so a host with a third of all pages costs no task more than others. A slot is
    template if its text is the same on all of at least ``least_pages`` pages, and RARE
    of the host's pages, that hold it; a block of another slot if all of at least so
    many pages have it there; while some slot varies on that host, or is not template
    on that page: pages that are all copies of one article keep it.
    Defined cases: a null page is empty; a null or malformed address counts as a
    host of its own; a host with one page has no template; a page without article
    gives the empty text; repeated pages give repeated rows; an empty table gives no
    rows; other columns are ignored.
    """
    bounded_batches(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[^:/?#]*:?//([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))
    digest = materialize(rows.where("html != ''").select("host", "html").mapInArrow(_digest, "host string, form string, blocks array<array<long>>"))
    trees = wrappers(digest)
    seen = digest.join(trees, "host").select("host", "tree", "form", "blocks").mapInArrow(
        _observe, "host string, slot int, block long, low long, high long, pages long"
    )
    # Of what stands on one page, slots tell nothing more than that page does, and blocks are no template.
    sums = seen.groupBy("host", "slot", "block").agg(*(f(c).alias(c) for f, c in ((F.min, "low"), (F.max, "high"), (F.sum, "pages"))))
    sums = materialize(sums.where("pages > 1"))
    slots = sums.where("block is null").drop("block")
    constant = (F.col("low") == F.col("high")) & (F.col("pages") >= least_pages)
    shared = sums.where((F.col("block").isNotNull()) & (F.col("pages") >= least_pages)).select("host", "slot", "block", "pages")
    common = shared.join(slots.where(~constant).select("host", "slot", "pages"), ["host", "slot", "pages"])
    common = common.groupBy("host", "slot").agg(F.collect_list("block").alias("blocks"))
    told = slots.join(common, ["host", "slot"], "left").groupBy("host").agg(
        F.to_json(F.collect_list(F.struct("slot", constant.alias("constant"), "blocks"))).alias("slots"), F.max(~constant).alias("varies")
    )
    found = rows.join(materialize(trees.join(told, "host")), "host", "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    return found.select("page_id", "url", "html", "tree", "slots", "varies").mapInArrow(_extract, f"page_id {kind}, url string, text string")

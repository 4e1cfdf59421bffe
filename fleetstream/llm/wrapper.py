"""Main text of web pages by wrapper induction.

Pages of a host are parsed into trees, runs of equal siblings become one node, and the
trees are aligned one after the other by simple tree matching into the host's template:
the largest set of node pairs that keeps labels, ancestors and the order of siblings.
Template nodes whose text is the same on nearly all aligned pages are constant; the others
are slots.  A page is aligned with its host's template again, and its text is that of the
slots below the page's content root (article, main, or else the subtree with most slot
text), without elements that are boilerplate by their meaning.

Pages of a host whose content roots have the same text count as one page, so copies make no
text constant: they meet by a digest of it, and one tree of each is kept.  Every task aligns
the trees it reads into one template per host; those of a host are merged by the same matching in two levels, so a host
with a third of all pages meets in one task as a few small trees.  Templates are broadcast if
their bytes are few, else hosts with many pages are split over as many tasks as they need.

A template node remembers at most ``TEXTS`` texts by a summary that keeps any text on more than
one in ``TEXTS + 1`` of its pages, and nodes dropped from a large template are counted as missed,
so any node on more than ``RARE`` of the pages is there whatever the order of pages and tasks.
Both only propose: every different page is then aligned with its host's whole template, and
pages and texts of the nodes are counted exactly, over all tasks, before a text becomes constant.

Defined cases: null and empty html give an empty text; null urls share one host; null and
repeated ids are kept as rows; copies of a page get the same text, and any number of them is
one page of their host; broken markup is read as browsers do where it matters here
(unclosed elements end with their parent); elements nested deeper than ``DEEPEST`` become
siblings there, their text in order, as browsers flatten them too; other columns are ignored; an
empty table gives an empty result; pages of any length are read whole.

Sibling lists are aligned by what their subtrees look like: equal beginnings are paired at once,
which no better matching can beat, the rest by rows of the matching table, and tables of more
than ``CELLS`` cells in halves, so memory stays linear in the lists.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.llm.common import written

# A node is constant if so many different pages have it, this share of them the same text, and
# those with it are this share of the host's different pages.
LEAST_PAGES = 20
CONSTANT_SHARE = 0.9
HOST_SHARE = 0.25
# Texts proposed per template node (any with a share above 1 / (TEXTS + 1) is among them), and
# nodes beyond which those surely on under RARE of the pages are dropped: far below HOST_SHARE,
# they cannot be constant.
TEXTS = 4
MOST_NODES = 4096
RARE = 0.01
# Template nodes, and counts, that a task holds before it passes them on.
HELD = 1 << 18
MERGE_WAYS = 32
# Levels of elements in a page's tree, and cells of a matching table that is kept whole.
DEEPEST = 200
CELLS = 1 << 21
# Bytes of templates that are broadcast, and the share of pages that makes a host hot.
MOST_BROADCAST = 16 << 20
HOT_SHARE = 0.001

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|[^<]+|<",
    re.S,
)
# Names with their values, one after the other, so that no value is searched for names.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_NAME = re.compile(r"[a-z]+")

# Elements by what they mean.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
BOILERPLATE = frozenset(
    "head script style noscript template iframe nav footer aside form button select option dialog "
    "menu svg canvas object audio video textarea title input".split()
)
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split()
)
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar cookie cookies consent notice popup modal "
    "newsletter subscribe subscription share sharing social related comment comments disqus respond "
    "reply replies footer header masthead topbar login signin signup search widget toolbar skip "
    "pagination pager copyright disclaimer".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# Where an implied end stops looking for the element to close.
SCOPES = frozenset("table ul ol dl div article main section body td th nav aside footer".split())


@lru_cache(maxsize=4096)
def _kind(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Label of an element, whether it is boilerplate, and whether it is a content root."""
    names, role, hidden = [], "", False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "role":
            role = value
        elif key == "hidden":
            hidden = True
        elif key in ("class", "id"):
            names += _NAME.findall(value)
    whole = tag in ("html", "body", "article", "main")
    named = hidden or role in BOILERPLATE_ROLES or not BOILERPLATE_NAMES.isdisjoint(names)
    return (
        ".".join([tag, *sorted(set(names))[:4]]),
        tag in BOILERPLATE or named and not whole,
        tag in ("article", "main") or role in ("main", "article"),
    )


class Node:
    """An element: its label, what it is, and its content in page order (texts and nodes)."""

    __slots__ = ("tag", "label", "skipped", "main", "content")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        self.label, self.skipped, self.main = _kind(tag, attributes)
        self.content: list = []

    def continued(self) -> Node:
        """An element of the same kind for what follows after another one."""
        node = Node(self.tag)
        node.label, node.skipped, node.main = self.label, self.skipped, self.main
        return node


def parsed(html: str) -> Node:
    """The tree of a page; markup errors are tolerated."""
    root = Node("#page")
    stack, at, raw_end = [root], 0, len(html)

    def add(x: str | Node) -> None:
        """Into the open element, or beside it where that one is too deep to have children."""
        if len(stack) <= DEEPEST:
            stack[-1].content.append(x)
            return
        top, level = stack[-1], stack[DEEPEST - 1].content
        if isinstance(x, Node):
            x.skipped = x.skipped or top.skipped
            level.append(x)
            return
        if not level or level[-1] is not top:
            stack[-1] = top.continued()
            level.append(stack[-1])
        stack[-1].content.append(x)

    while at < raw_end:
        found = _TOKEN.match(html, at)
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            text = found[0]
            if text[0] != "<" or text == "<":
                add(unescape(text))
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            if tag == "br":
                add(Node("br"))
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        node = Node(tag, found[3] or found[6] or "")
        closes = {"p"} if tag in ENDS_PARAGRAPH else CLOSES.get(tag)
        if closes:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in closes:
                    del stack[depth:]
                    if tag in ("td", "th") or tag not in CLOSES:
                        break
                elif stack[depth].tag in SCOPES:
                    break
        add(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else raw_end
            continue
        stack.append(node)
    return root


def collapsed(nodes: list[Node]) -> list[list]:
    """Runs of siblings with one label as single nodes: [label, text digest, children, members]."""
    out: list[list] = []
    for node in nodes:
        if node.tag in INLINE or node.tag == "br":
            continue
        if out and out[-1][0] == node.label:
            out[-1][3].append(node)
        else:
            out.append([node.label, "", [], [node]])
    for run in out:
        text = "\n".join(_text_of(n) for n in run[3])
        run[1] = blake2b(text.encode(), digest_size=8).hexdigest() if text.strip() else ""
        run[2] = collapsed([c for n in run[3] for c in n.content if isinstance(c, Node)])
    return out


def _text_of(node: Node) -> str:
    """Text of the node itself and of the inline elements in it."""
    parts = []
    for x in node.content:
        if isinstance(x, str):
            parts.append(x)
        elif x.tag in INLINE:
            parts.append(_text_of(x))
    return "".join(parts)


class _Shapes:
    """What subtrees look like, as numbers, and how many nodes two of them can match."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.parts: list[tuple] = []
        self.sizes: list[int] = []
        self.weights: dict[tuple[int, int], int] = {}

    def of(self, nodes: list) -> list[int]:
        out = []
        for x in nodes:
            key = (x[0], *self.of(x[2]))
            if key not in self.known:
                self.known[key] = len(self.parts)
                self.parts.append(key)
                self.sizes.append(1 + sum(self.sizes[c] for c in key[1:]))
            out.append(self.known[key])
        return out

    def weight(self, s: int, t: int) -> int:
        """Matched nodes of two subtrees: none unless their roots have one label."""
        if s == t:
            return self.sizes[s]
        one, other = self.parts[s], self.parts[t]
        if one[0] != other[0]:
            return 0
        if (s, t) not in self.weights:
            self.weights[s, t] = 1 + self.most(one[1:], other[1:])
        return self.weights[s, t]

    def rows(self, a, b) -> Iterator[np.ndarray]:
        """The rows of the matching table of two sibling lists, the first one for no siblings."""
        row = np.zeros(len(b) + 1, dtype=np.int64)
        yield row
        told: dict[int, np.ndarray] = {}
        for s in a:
            if s not in told:
                told[s] = np.array([self.weight(s, t) for t in b], dtype=np.int64)
            row = np.maximum(row, np.concatenate([[0], row[:-1] + told[s]]))
            row = np.maximum.accumulate(row)
            yield row

    def most(self, a, b) -> int:
        """Matched nodes of two sibling lists in all."""
        same = _same_start(a, b)
        whole = sum(self.sizes[s] for s in a[:same])
        a, b = a[same:], b[same:]
        if a and b:
            *_, last = self.rows(a, b)
            whole += int(last[-1])
        return whole

    def pairs(self, a, b) -> list[tuple[int, int]]:
        """The aligned pairs of two sibling lists."""
        same = _same_start(a, b)
        paired = [(i, i) for i in range(same)]
        return paired + [(i + same, j + same) for i, j in self._aligned(a[same:], b[same:])]

    def _aligned(self, a, b) -> list[tuple[int, int]]:
        if not a or not b:
            return []
        if len(a) > 1 and len(a) * len(b) > CELLS:
            # Where the best matching of the first half ends in the other list.
            mid = len(a) // 2
            *_, first = self.rows(a[:mid], b)
            *_, rest = self.rows(a[mid:][::-1], b[::-1])
            cut = int(np.argmax(first + rest[::-1]))
            later = self._aligned(a[mid:], b[cut:])
            return self._aligned(a[:mid], b[:cut]) + [(i + mid, j + cut) for i, j in later]
        best = list(self.rows(a, b))
        pairs, i, j = [], len(a), len(b)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
        return pairs[::-1]


def _same_start(a, b) -> int:
    same = 0
    while same < len(a) and same < len(b) and a[same] == b[same]:
        same += 1
    return same


def matched(a: list, b: list, weigh: bool = True) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two sibling lists: matched nodes in all, and the aligned pairs.

    Without ``weigh`` the number is left out.
    """
    if not a or not b:
        return 0, []
    if not weigh:
        labels = [x[0] for x in a]
        if labels == [y[0] for y in b] and len(set(labels)) == len(labels):
            # Every node has one partner only.
            return 0, [(i, i) for i in range(len(labels))]
    shapes = _Shapes()
    one, other = shapes.of(a), shapes.of(b)
    return shapes.most(one, other) if weigh else 0, shapes.pairs(one, other)


# A template node is [label, {text digest: pages}, children, pages, pages at most missed].


def _as_template(run: list) -> list:
    return [run[0], {run[1]: 1}, [_as_template(c) for c in run[2]], 1, 0]


def _missed(nodes: list[list], pages: int) -> list[list]:
    """The nodes, which that many pages may have had before they were dropped."""
    if pages:
        for n in nodes:
            n[4] += pages
            _missed(n[2], pages)
    return nodes


def _add_texts(into: dict, more: dict) -> None:
    for k, n in more.items():
        into[k] = into.get(k, 0) + n
    if len(into) > TEXTS:  # a frequent text loses at most its share of the rest
        cut = sorted(into.values(), reverse=True)[TEXTS]
        for k in list(into):
            into[k] -= cut
            if into[k] <= 0:
                del into[k]


def merge(into: list[list], more: list[list], into_lost: int = 0, more_lost: int = 0) -> list[list]:
    """Two templates as one: aligned nodes are united, the others kept between them.

    A node that one side lacks may have been dropped there with as many pages as that side lost.
    """
    out: list[list] = []
    i = j = 0
    for a, b in [*matched(into, more, weigh=False)[1], (len(into), len(more))]:
        out += _missed(into[i:a], more_lost)
        out += _missed(more[j:b], into_lost)
        if a < len(into):
            one, other = into[a], more[b]
            _add_texts(one[1], other[1])
            one[2] = merge(one[2], other[2], into_lost, more_lost)
            one[3] += other[3]
            one[4] += other[4]
            out.append(one)
        i, j = a + 1, b + 1
    return out


def _size(nodes: list) -> int:
    return sum(1 + _size(n[2]) for n in nodes)


def _pruned(nodes: list, least: int) -> list:
    kept = [n for n in nodes if n[3] + n[4] > least]
    for n in kept:
        n[2] = _pruned(n[2], least)
    return kept


class Template:
    """The merged trees of some pages of a host."""

    def __init__(self, pages: int = 0, nodes: list | None = None):
        self.pages, self.nodes = pages, nodes or []

    def lost(self) -> int:
        """The most pages of this template that had a node which is not in it."""
        return int(RARE * self.pages)

    def add(self, other: Template) -> None:
        self.nodes = merge(self.nodes, other.nodes, self.lost(), other.lost())
        self.pages += other.pages
        if _size(self.nodes) > MOST_NODES:
            self.nodes = _pruned(self.nodes, self.lost())

    def dumped(self) -> str:
        return json.dumps([self.pages, self.nodes])

    @staticmethod
    def load(text: str) -> Template:
        return Template(*json.loads(text))

    def proposed(self) -> list:
        """Labels and proposed texts, nodes numbered in page order: [label, number, children, texts]."""
        numbers = count()

        def numbered(nodes: list) -> list:
            return [[n[0], next(numbers), numbered(n[2]), sorted(n[1])] for n in nodes]

        return numbered(self.nodes)


def aligned(page: list, proposed: list) -> Iterator[tuple[int, str]]:
    """Number of every template node that a page has, and its text there if it is a proposed one."""
    for i, j in matched(page, proposed, weigh=False)[1]:
        text = page[i][1]
        yield proposed[j][1], text if text in proposed[j][3] else ""
        yield from aligned(page[i][2], proposed[j][2])


def constants(proposed: list, pages: int, found: dict[int, dict[str, int]]) -> list:
    """The template reduced to what tells constant nodes: [label, digest or None, children].

    ``found`` has the pages of every node by text, ``""`` for all other texts.
    """

    def reduced(nodes: list) -> list:
        out = []
        for label, number, children, _ in nodes:
            counted = found.get(number, {})
            having = sum(counted.values())
            told = {text: n for text, n in counted.items() if text}
            text, n = max(told.items(), key=lambda x: (x[1], x[0]), default=("", 0))
            enough = having >= LEAST_PAGES and n >= max(CONSTANT_SHARE * having, HOST_SHARE * pages)
            # Siblings stay even without a constant: the matching needs them.
            out.append([label, text if text and enough else None, reduced(children)])
        return out

    def any_fixed(nodes: list) -> bool:
        return any(n[1] is not None or any_fixed(n[2]) for n in nodes)

    nodes = reduced(proposed)
    return nodes if any_fixed(nodes) else []


def constant_nodes(page: list, template: list) -> Iterator[int]:
    """Identities of the page's elements that are aligned with a constant node and equal it."""
    for i, j in matched(page, template, weigh=False)[1]:
        if template[j][1] is not None and template[j][1] == page[i][1]:
            yield from map(id, page[i][3])
        yield from constant_nodes(page[i][2], template[j][2])


def _slots(node: Node, constant: set[int], out: list[str]) -> None:
    """Text of the slots below a node, with a break around every block."""
    fixed = id(node) in constant
    for x in node.content:
        if isinstance(x, str):
            if not fixed:
                out.append(x)
        elif x.tag == "br":
            out.append("\n")
        elif x.tag in INLINE:
            if not x.skipped and not fixed:
                _slots(x, constant, out)
        elif not x.skipped:
            out.append("\n")
            _slots(x, constant, out)
            out.append("\n")


def _roots(node: Node) -> Iterator[Node]:
    for x in node.content:
        if isinstance(x, Node) and not x.skipped:
            if x.main:
                yield x
            else:
                yield from _roots(x)


def _rendered(node: Node, constant: set[int]) -> str:
    out: list[str] = []
    _slots(node, constant, out)
    return " ".join("".join(out).split())


def _content_root(node: Node, constant: set[int]) -> Node:
    """Without article or main: go down while one child holds most of the slot text."""
    while True:
        blocks = [x for x in node.content if isinstance(x, Node) and not x.skipped and x.tag not in INLINE]
        whole = len(_rendered(node, constant))
        sizes = [len(_rendered(x, constant)) for x in blocks]
        if not sizes or max(sizes) < 0.8 * whole:
            return node
        node = blocks[sizes.index(max(sizes))]


def main_text(html: str | None, template: list | None = None) -> str:
    """The page's text: its slots below the content root."""
    if not html:
        return ""
    page = parsed(html)
    constant: set[int] = set()
    if template:
        constant = set(constant_nodes(_runs(page), template))
    return _text_below_roots(page, constant)


def _runs(page: Node) -> list[list]:
    return collapsed([x for x in page.content if isinstance(x, Node)])


def _text_below_roots(page: Node, constant: set[int]) -> str:
    roots = list(_roots(page))
    articles = [r for r in roots if r.tag == "article"]
    # An article inside main is narrower than main itself.
    inner = [a for r in roots if r.tag != "article" for a in _roots(r) if a.tag == "article"]
    chosen = articles + inner or roots or [_content_root(page, constant)]
    return " ".join(filter(None, (_rendered(r, constant) for r in chosen)))


# --- over tables


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.lower(rest)


def _bare(runs: list) -> list:
    return [[label, text, _bare(children)] for label, text, children, _ in runs]


def _page_trees(batches):
    """Per page its host, a digest that copies share, and its tree."""
    for batch in batches:
        hosts, digests, trees = [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if html:
                page = parsed(html)
                tree = json.dumps(_bare(_runs(page)))
                hosts.append(host)
                # Pages without text are told apart by their trees.
                told = _text_below_roots(page, set()) or tree
                digests.append(blake2b(told.encode(), digest_size=16).digest())
                trees.append(tree)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(digests, pa.binary()), pa.array(trees, pa.string())],
            ["host", "digest", "tree"],
        )


def _template_batch(found: dict[str, Template]) -> pa.RecordBatch:
    hosts = list(found)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hosts, pa.string()),
            pa.array([hash_way(h, found[h].nodes) for h in hosts], pa.int32()),
            pa.array([found[h].dumped() for h in hosts], pa.string()),
        ],
        ["host", "way", "template"],
    )


def _page_templates(batches):
    """Templates per host of the trees that a task reads: one, or more where they grow large."""
    found: dict[str, Template] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for host, tree in zip(batch.column("host").to_pylist(), batch.column("tree").to_pylist(), strict=True):
            found.setdefault(host, Template()).add(Template(1, [_as_template(r) for r in json.loads(tree)]))
            sizes[host] = _size(found[host].nodes)
        if sum(sizes.values()) > HELD:
            yield _template_batch(found)
            found, sizes = {}, {}
    yield _template_batch(found)


def hash_way(host: str, nodes: list) -> int:
    """Spreads the templates of one host over the first level of merging."""
    return int.from_bytes(blake2b(json.dumps(nodes).encode(), digest_size=4).digest(), "big") % MERGE_WAYS


def _merged_templates(frame: pd.DataFrame) -> pd.DataFrame:
    whole = Template()
    for text in sorted(frame["template"]):
        whole.add(Template.load(text))
    return pd.DataFrame({"host": frame["host"].iloc[:1], "template": [whole.dumped()]})


def _count_batch(found: Counter) -> pa.RecordBatch:
    rows = list(found)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.string()),
            pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.string()),
            pa.array([found[r] for r in rows], pa.int64()),
        ],
        ["host", "node", "text", "n"],
    )


def _counted(batches):
    """Pages by host, template node and proposed text, added up within the task."""
    found: Counter = Counter()
    loaded = _Loaded(lambda template: Template.load(template).proposed())
    for batch in batches:
        for host, tree, template in zip(
            *(batch.column(c).to_pylist() for c in ("host", "tree", "template")), strict=True
        ):
            found.update((host, node, text) for node, text in aligned(json.loads(tree), loaded[template]))
        if len(found) > HELD:
            yield _count_batch(found)
            found = Counter()
    yield _count_batch(found)


def _constant_templates(batches):
    for batch in batches:
        out = []
        for template, counts in zip(
            batch.column("template").to_pylist(), batch.column("counts").to_pylist(), strict=True
        ):
            whole = Template.load(template)
            found: dict[int, dict[str, int]] = {}
            for c in counts or []:
                found.setdefault(c["node"], {})[c["text"]] = c["n"]
            nodes = constants(whole.proposed(), whole.pages, found)
            out.append(json.dumps(nodes) if nodes else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array(out, pa.string()), batch.column("pages")],
            ["host", "template", "pages"],
        )


class _Loaded(dict):
    """Templates that a task has read, some at a time."""

    def __init__(self, load):
        super().__init__()
        self.load = load

    def __missing__(self, template: str):
        if len(self) > 256:
            self.clear()
        self[template] = self.load(template)
        return self[template]


def templates(pages: DataFrame) -> DataFrame:
    """``host, template, pages``: the template, reduced to what tells constant nodes, or null."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html")
    schema = "host string, template string"
    trees = rows.mapInArrow(_page_trees, "host string, digest binary, tree string")
    distinct = written(
        trees.groupBy("host", "digest").agg(F.min("tree").alias("tree"), F.count(F.lit(1)).alias("pages")),
        "page-trees",
    )
    partial = distinct.select("host", "tree").mapInArrow(_page_templates, "host string, way int, template string")
    halfway = partial.groupBy("host", "way").applyInPandas(_merged_templates, schema)
    merged = halfway.groupBy("host").applyInPandas(_merged_templates, schema)
    sizes = distinct.groupBy("host").agg(
        F.sum("pages").alias("pages"), F.count(F.lit(1)).alias("different")
    )
    # Hosts with too few different pages have no constant.
    whole = written(merged.join(sizes.where(F.col("different") >= LEAST_PAGES), "host"), "host-templates")
    counted = (
        with_template(distinct.select("host", "tree"), whole, "different")
        .where("template is not null")
        .mapInArrow(_counted, "host string, node int, text string, n bigint")
        .groupBy("host", "node", "text")
        .agg(F.sum("n").alias("n"))
        # At most as many rows as a template has nodes and proposed texts.
        .groupBy("host")
        .agg(F.collect_list(F.struct("node", "text", "n")).alias("counts"))
    )
    return (
        whole.join(counted, "host", "left")
        .select("host", "template", "pages", "counts")
        .mapInArrow(_constant_templates, "host string, template string, pages bigint")
    )


def with_template(rows: DataFrame, known: DataFrame, size: str = "pages") -> DataFrame:
    """Rows with the template of their host, or null, whose rows are never brought together.

    Templates of a measured size are broadcast.  Beyond that they are joined by a shuffle, in
    which a host gets a way more for every ``HOT_SHARE`` of all rows, so at most ``1 / HOT_SHARE``
    hosts, whose names are broadcast, have several.
    """
    told = known.where("template is not null").select("host", "template", F.col(size).alias("_size"))
    n_bytes, total = told.agg(F.sum(F.octet_length("template")), F.sum("_size")).first()
    if (n_bytes or 0) <= MOST_BROADCAST:
        return rows.join(F.broadcast(told.drop("_size")), "host", "left")
    ways = (1 + F.floor(F.col("_size") / F.lit(HOT_SHARE * total))).cast("int")
    placed = told.select("host", "template", ways.alias("_ways"))
    hot = placed.where("_ways > 1").select("host", "_ways")
    way = F.pmod(F.monotonically_increasing_id(), F.coalesce("_ways", F.lit(1))).cast("int")
    dealt = rows.join(F.broadcast(hot), "host", "left").withColumn("_way", way).drop("_ways")
    spread = placed.select("host", "template", F.explode(F.sequence(F.lit(0), F.col("_ways") - 1)).alias("_way"))
    return dealt.join(spread, ["host", "_way"], "left").drop("_way")


def _extracted(batches):
    loaded = _Loaded(json.loads)
    for batch in batches:
        texts = []
        for html, template in zip(
            batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True
        ):
            texts.append(main_text(html, loaded[template] if template is not None else None))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    known = written(templates(pages), "page-templates")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    joined = with_template(rows, known).select("page_id", "url", "html", "template")
    schema = joined.select("page_id", "url", F.lit("").alias("text")).schema
    return joined.mapInArrow(_extracted, schema).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )

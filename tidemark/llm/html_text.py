"""Main text of HTML pages by a tree-structured graphical model.

A page becomes a tree of its block elements, whose leaves are blocks of text. Each node is main text or not; a node's own
features give its evidence, and parent and child are tied by potentials that depend on what kind of child it is. Messages
summed upward and then downward give every node's marginal; leaves of at least one half are the main text. All potentials
are trained by gradient ascent on labelled pages, for which the same messages give the expected counts.

In a block, character references are decoded and white space becomes one space; blocks are joined by one line feed.

Defined cases: a null or empty page, or one without a main block, has an empty text; markup that nobody closed ends with
its parent; a tag that never ends is text; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import in_chunks, table
from tidemark.llm.labelled_pages import pages as labelled_pages

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
SPACE = re.compile(r"\s+")
#: Elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption colgroup".split())
#: Elements whose text is not shown as text of the page.
UNSHOWN = frozenset("script style template noscript head title iframe object svg math canvas audio video map select datalist textarea button".split())
#: Of those, the ones whose content is not markup.
RAW = frozenset("script style title textarea noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADS = frozenset(f"h{i}" for i in range(1, 7))
#: Which open elements a start tag ends.
ENDS = {
    **dict.fromkeys(("li",), frozenset({"li"})), **dict.fromkeys(("dt", "dd"), frozenset({"dt", "dd"})), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), **dict.fromkeys(("tbody", "thead", "tfoot"), frozenset({"tr", "td", "th", "tbody", "thead", "tfoot"})),
}
#: Where such an end stops.
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
         "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}
#: Names in class, id, role and itemprop, by what they tell.
KINDS = {name: kind for kind, names in {
    "main": "article articlebody content main post entry story text body page",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc",
    "head": "header masthead topbar banner logo branding top",
    "foot": "footer copyright bottom legal colophon contentinfo",
    "side": "sidebar side aside widget widgets related recommended popular trending rail complementary more",
    "ad": "ad ads adv advert advertisement adsbygoogle sponsor sponsored promo promotion outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay message warning privacy dialog",
    "form": "form search login signup subscribe subscription newsletter register input",
    "talk": "comment comments commentlist disqus reply replies responses respond discussion feedback reviews",
    "share": "share sharing social tags tag meta byline author toolbar",
}.items() for name in names.split()}
SPEECH = {w: kind for kind, ws in {
    "s:cookie": "cookie cookies gdpr", "s:rights": "copyright © rights", "s:sign": "subscribe newsletter login signup", "s:advert": "advertisement sponsored",
}.items() for w in ws.split()}
THRESHOLD = 0.5


#: Elements that tell what they hold.
TELLING = frozenset("nav aside footer header form article main section dialog menu".split())


class Node:
    __slots__ = ("parent", "tag", "kinds", "text", "words", "linked", "label", "leaf", "depth")

    def __init__(self, parent: int, tag: str, kinds: tuple[str, ...], leaf: bool, depth: int):
        self.parent, self.tag, self.kinds, self.leaf, self.depth = parent, tag, kinds, leaf, depth
        self.text, self.words, self.linked, self.label = "", 0, 0, 0


@lru_cache(maxsize=20_000)
def attributes(raw: str) -> tuple[tuple[str, ...], bool, bool]:
    """Kinds that the attributes tell, whether the element is hidden, whether it is labelled as main."""
    kinds, hidden, main = set(), False, False
    for name, a, b, c in ATTRIBUTE.findall(raw):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            kinds.update(KINDS[w] for w in map(str.lower, NAME.findall(a or b or c)) if w in KINDS)
            kinds.update(KINDS[w] for w in re.split(r"[\s_-]+", (a or b or c).lower()) if w in KINDS)
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", a or b or c, re.I):
            hidden = True
        elif name == "data-main":
            main = True
    return tuple(sorted(kinds)), hidden, main


def parse(page: str) -> list[Node]:
    """Block elements and text blocks, parents first; text blocks in page order."""
    nodes = [Node(-1, "root", (), False, 0)]
    # Open elements: tag, node (that of the block around it for inline elements), links and unshown elements around it, labelled.
    stack: list[tuple[str, int, int, int, bool]] = [("root", 0, 0, 0, False)]
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                owner, main = next((e[1], e[4]) for e in reversed(stack) if nodes[e[1]].tag == e[0])
                node = Node(owner, nodes[owner].tag, (), True, nodes[owner].depth + 1)
                node.text, node.words, node.label = text, text.count(" ") + 1, int(main)
                node.linked = min(linked, len(text))
                nodes.append(node)
        linked = 0

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        start = found.start() if found else size
        if start > at and not stack[-1][3]:
            parts.append(page[at:start])
            if stack[-1][2]:
                linked += start - at
        if not found:
            break
        at = found.end()
        closing, tag, raw = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            if found[0].startswith("<![CDATA[") and not stack[-1][3]:
                parts.append(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if closing:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if not k:
                if tag == "p":
                    flush()
                continue
            if tag not in BLOCK and any(e[0] in BLOCK for e in stack[k + 1:]):
                continue  # an inline element does not end the blocks inside it
            if any(e[0] in BLOCK for e in stack[k:]):
                flush()
            del stack[k:]
            continue
        if tag in RAW and not raw.endswith("/"):
            end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCK
        if block:
            flush()
            if tag != "hr":
                top = stack[-1][0]
                if top == "p" or tag not in ENDS:
                    k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in BLOCK), 0)
                    if k and stack[k][0] == "p":
                        del stack[k:]
                if tag in ENDS:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in HOLDS[tag]:
                            break
                        if stack[k][0] in ENDS[tag]:
                            del stack[k:]
        if tag in VOID or raw.endswith("/"):
            continue
        kinds, hidden, main = attributes(raw)
        _, owner, links, unshown, labelled = stack[-1]
        if block or kinds and tag in ("ins", "span"):
            if not block:
                flush()
            nodes.append(Node(owner, tag, kinds, False, nodes[owner].depth + 1))
            owner = len(nodes) - 1
        stack.append((tag, owner, links + (tag == "a"), unshown + (hidden or tag in UNSHOWN), labelled or main))
    flush()
    return nodes


def bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


def features(nodes: list[Node]) -> tuple[list[list[str]], list[str]]:
    """Features of each node, and the kind of its tie to its parent."""
    words, linked, chars, leaves = ([0] * len(nodes) for _ in range(4))
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        if node.leaf:
            words[i], linked[i], chars[i], leaves[i] = node.words, node.linked, len(node.text), 1
        p = node.parent
        words[p] += words[i]
        linked[p] += linked[i]
        chars[p] += chars[i]
        leaves[p] += leaves[i]
    own: list[list[str]] = []
    ties: list[str] = []
    inside: list[str] = []  # what the nearest telling element around a node tells
    for i, node in enumerate(nodes):
        around = inside[node.parent] if i else "in:-"
        inside.append(f"in:{next((k for k in node.kinds if k != 'main'), 'main')}" if node.kinds else
                      f"in:<{node.tag}>" if node.tag in TELLING and not node.leaf else around)
        density = bucket(100 * linked[i] // max(1, chars[i]), (1, 30, 70))
        if node.leaf:
            last = node.text[-1]
            f = ["leaf", f"l{bucket(node.words, (2, 4, 8, 16, 40))}", f"d{density}", f"t:{node.tag}", around, "stop" if last in ".?!:;\"»”" else "open"]
            f += {SPEECH[w] for w in node.text.lower().split() if w in SPEECH}
            ties.append("head" if node.tag in HEADS else "leaf")
        else:
            f = ["node", f"e:{node.tag}", f"L{bucket(words[i], (1, 10, 40, 150, 600))}", f"D{density}", f"n{bucket(leaves[i], (1, 2, 5, 12))}"]
            f += [f"k:{k}" for k in node.kinds]
            f.append(f"e{around}")
            if not node.kinds:
                f.append("k:-")
            ties.append("kind" if node.kinds or node.tag in TELLING else
                        "text" if node.tag in ("p", "li", "td", "th", "tr", "tbody", "dd", "dt", "pre", "blockquote", "figcaption", "figure", "ul", "ol", "table") or
                        node.tag in HEADS else "box")
        own.append(f)
    return own, ties


def soft(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def messages(nodes: list[Node], evidence: list[float], ties: list[str], pair: dict[str, list[float]]) -> tuple[list[float], list[float], list[float]]:
    """Sum-product in log odds: what each node believes, what comes from below it, and what its parent tells it without it.

    pair: for a tie, the potentials of (parent, child) = (0, 0), (0, 1), (1, 0), (1, 1).
    """
    below = evidence[:]
    up = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        w = pair[ties[i]]
        up[i] = soft(w[2], w[3] + below[i]) - soft(w[0], w[1] + below[i])
        below[nodes[i].parent] += up[i]
    belief = below[:]
    above = [0.0] * len(nodes)
    for i in range(1, len(nodes)):
        w = pair[ties[i]]
        above[i] = belief[nodes[i].parent] - up[i]
        belief[i] = below[i] + soft(w[1], w[3] + above[i]) - soft(w[0], w[2] + above[i])
    return belief, below, above


class Model:
    def __init__(self, weight: dict[str, float], pair: dict[str, list[float]]):
        self.weight, self.pair = weight, pair

    def blocks(self, page: str | None) -> list[tuple[str, float]]:
        """Text blocks in page order with their marginals of being main text."""
        if not page:
            return []
        nodes = parse(page)
        own, ties = features(nodes)
        weight = self.weight
        belief, _, _ = messages(nodes, [sum(weight.get(f, 0.0) for f in fs) for fs in own], ties, self.pair)
        return [(n.text, 1 / (1 + math.exp(-max(-500.0, min(500.0, b))))) for n, b in zip(nodes, belief) if n.leaf]

    def text(self, page: str | None) -> str:
        return "\n".join(t for t, p in self.blocks(page) if p >= THRESHOLD)


def train(pages: list[str], rounds: int = 60, step: float = 0.15, ridge: float = 0.5) -> Model:
    """Gradient ascent (with per-weight step sizes) on the likelihood of all labels; an element is main if half its text is."""
    data = []
    for page in pages:
        nodes = parse(page)
        own, ties = features(nodes)
        main, all_of = [0] * len(nodes), [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            if nodes[i].leaf:
                main[i], all_of[i] = nodes[i].label * len(nodes[i].text), len(nodes[i].text)
            if i:
                main[nodes[i].parent] += main[i]
                all_of[nodes[i].parent] += all_of[i]
        data.append((nodes, own, ties, [int(2 * m >= max(1, a)) for m, a in zip(main, all_of)]))
    weight: dict[str, float] = {}
    pair = {t: [0.0] * 4 for t in ("head", "leaf", "kind", "text", "box")}
    seen: dict = {}
    for _ in range(rounds):
        grad: dict[str, float] = {}
        tied = {t: [0.0] * 4 for t in pair}
        for nodes, own, ties, labels in data:
            belief, below, above = messages(nodes, [sum(weight.get(f, 0.0) for f in fs) for fs in own], ties, pair)
            for i, fs in enumerate(own):
                error = labels[i] - 1 / (1 + math.exp(-max(-500.0, min(500.0, belief[i]))))
                for f in fs:
                    grad[f] = grad.get(f, 0.0) + error
                if i:
                    w = pair[ties[i]]
                    both = [w[0], w[1] + below[i], w[2] + above[i], w[3] + above[i] + below[i]]
                    top = max(both)
                    both = [math.exp(b - top) for b in both]
                    total, g = sum(both), tied[ties[i]]
                    g[2 * labels[nodes[i].parent] + labels[i]] += 1
                    for k in range(4):
                        g[k] -= both[k] / total
        for f, g in grad.items():
            g -= ridge * weight.get(f, 0.0)
            seen[f] = seen.get(f, 0.0) + g * g
            weight[f] = weight.get(f, 0.0) + step * g / math.sqrt(seen[f] + 1e-9)
        for t, gs in tied.items():
            for k in range(4):
                g = gs[k] - ridge * pair[t][k]
                seen[t, k] = seen.get((t, k), 0.0) + g * g
                pair[t][k] += step * g / math.sqrt(seen[t, k] + 1e-9)
    return Model(weight, pair)


@lru_cache(maxsize=1)
def trained() -> Model:
    return train(labelled_pages())


def extract(pages: DataFrame, model: Model, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns of every row of pages(html) with text and n_chars."""
    data = pages.select(*keep, pages["html"].alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_html"):
            texts = [model.text(h) for h in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields[:-1]]
    return data.mapInArrow(run, ", ".join([*fields, "text string, n_chars long"]))


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), trained())

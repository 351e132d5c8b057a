"""Element trees of HTML pages, their alignment and their text: small helpers for ``wrapper``."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+(?:["'][^>]*)?)>""", re.S
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CUT_TAG = re.compile(r"<(?:[a-zA-Z/!?][^>]*)?\Z")
#: Deeper elements become siblings, as in browsers.
DEEPEST = 200

# Element names of HTML.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: An element of the key ends an open one of these, unless one of the last is in between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
    "p": (("p",), ("td", "th", "table", "button")),
}


@dataclass
class Tree:
    """Elements by number, parents first; ``items`` has texts and child numbers in page order, ``names`` the whole words
    of class, id and role."""

    tags: list[str] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    names: list[frozenset] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    items: list[list] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    shapes: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)

    def add(self, tag: str, attributes: str, parent: int) -> int:
        found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes else {}
        number = len(self.tags)
        self.tags.append(tag)
        self.labels.append(f"{tag}.{found['class']}" if found.get("class") else tag)
        self.names.append(frozenset(" ".join(found.values()).split()) if found else frozenset())
        self.parents.append(parent)
        self.items.append([])
        self.children.append([])
        if parent >= 0:
            self.items[parent].append(number)
            self.children[parent].append(number)
        return number

    def own_text(self, node: int) -> str:
        return " ".join("".join(x for x in self.items[node] if isinstance(x, str)).split())


def parse(html: str) -> Tree:
    """Tree of a page as found, with missing end tags supplied; scripts, styles and comments leave no text."""
    tree = Tree()
    stack = [tree.add("#root", "", -1)]
    at, size = 0, len(html)

    def text(piece: str) -> None:
        if piece:
            tree.items[stack[-1]].append(unescape(piece))

    while at < size:
        token = _TOKEN.search(html, at)
        if token is None:
            text(_CUT_TAG.sub("", html[at:]))
            break
        text(html[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if tree.tags[stack[k]] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and tree.tags[stack[k]] not in INLINE:
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            tree.add(tag, attributes, stack[-1])
            at = end.end() if end else size
            continue
        if tag in CLOSES_P:
            _close(tree, stack, *ENDS["p"])
        if tag in ENDS and tag != "p":
            _close(tree, stack, *ENDS[tag])
        node = tree.add(tag, attributes, stack[-1])
        if tag not in VOID and not attributes.rstrip().endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
    _measure(tree)
    return tree


def _close(tree: Tree, stack: list[int], ended: tuple, limits: tuple) -> None:
    for k in range(len(stack) - 1, 0, -1):
        tag = tree.tags[stack[k]]
        if tag in ended:
            del stack[k:]
            return
        if tag in limits:
            return


def _measure(tree: Tree) -> None:
    count = len(tree.tags)
    tree.shapes, tree.sizes = [0] * count, [1] * count
    for node in range(count - 1, -1, -1):
        own = tree.children[node]
        tree.shapes[node] = hash((tree.labels[node], *[tree.shapes[c] for c in own]))
        tree.sizes[node] = 1 + sum(tree.sizes[c] for c in own)


def align(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Pairs of matched elements by simple tree matching: the most pairs that keep labels, parents and order."""
    known: dict[tuple[int, int], int] = {}

    def weight(x: int, y: int) -> int:
        if a.labels[x] != b.labels[y]:
            return 0
        if a.shapes[x] == b.shapes[y]:
            return a.sizes[x]
        key = (a.shapes[x], b.shapes[y])
        if key not in known:
            head, tail, table = _table(a.children[x], b.children[y])
            same = sum(a.sizes[c] for c in a.children[x][:head]) + sum(a.sizes[c] for c in a.children[x][len(a.children[x]) - tail :])
            known[key] = 1 + same + table[-1][-1]
        return known[key]

    def _table(left: list[int], right: list[int]) -> tuple[int, int, list[list[int]]]:
        """Equal children at both ends match each other; the best weight of all prefixes of those between."""
        most, head, tail = min(len(left), len(right)), 0, 0
        while head < most and a.shapes[left[head]] == b.shapes[right[head]]:
            head += 1
        while tail < most - head and a.shapes[left[-1 - tail]] == b.shapes[right[-1 - tail]]:
            tail += 1
        middle = right[head : len(right) - tail]
        rows = [[0] * (len(middle) + 1)]
        for x in left[head : len(left) - tail]:
            above, row = rows[-1], [0]
            for k, y in enumerate(middle):
                row.append(max(above[k + 1], row[k], above[k] + weight(x, y)))
            rows.append(row)
        return head, tail, rows

    pairs: list[tuple[int, int]] = []
    waiting = [(0, 0)]
    while waiting:
        x, y = waiting.pop()
        pairs.append((x, y))
        left, right = a.children[x], b.children[y]
        if a.shapes[x] == b.shapes[y]:
            waiting.extend(zip(left, right, strict=True))
            continue
        head, tail, rows = _table(left, right)
        waiting.extend(zip(left[:head], right[:head], strict=True))
        if tail:
            waiting.extend(zip(left[-tail:], right[-tail:], strict=True))
        i, j = len(rows) - 1, len(rows[0]) - 1
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                waiting.append((left[head + i], right[head + j]))
    return pairs


def text_of(tree: Tree, roots: list[int], dropped) -> str:
    """Text below ``roots`` in page order: blocks are set apart by one space, white space becomes one space."""
    out: list[str] = []
    waiting: list = [*reversed(roots)]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            out.append(item)
        elif not dropped(item):
            gap = [] if tree.tags[item] in INLINE else [" "]
            waiting += [*gap, *reversed(tree.items[item]), *gap]
    return " ".join("".join(out).split())

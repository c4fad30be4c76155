"""The one Python helper: tolerant HTML to a flat tree, and the few path selectors that rules need."""

import re
from bisect import bisect_left
from collections import defaultdict
from html.parser import HTMLParser

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split())
# An opening tag ends the open element of these names, unless one of the barriers stands in between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_PARAGRAPH_BARRIERS = frozenset({"td", "th", "table", "button", "li", "article", "section", "div"})
# A closing tag does not reach past an open element of higher rank.
_RANK = {"div": 1, "td": 2, "th": 2, "tr": 3, "thead": 4, "tbody": 4, "tfoot": 4, "table": 5, "body": 6, "html": 7}


class Tree(HTMLParser):
    """Elements and texts in document order; node 0 is the document. A text has the tag None."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.values, self.parents, self.ends = [""], [{}], [-1], [0]
        self._open, self._in_text = [0], False
        self.ordinals, self._seen = [0], {}  # place among the siblings of the same tag, and how many there are so far
        self._depths = defaultdict(list)  # of the open elements of each tag, ascending
        self.feed(html)
        self.close()
        self._close_down_to(0)
        self.ends[0] = len(self.tags)
        self.places = {}
        for node, tag in enumerate(self.tags):
            self.places.setdefault(tag, []).append(node)
        self.places["*"] = [n for n, tag in enumerate(self.tags) if tag]

    def _add(self, tag, value):
        self.tags.append(tag)
        self.values.append(value)
        self.parents.append(self._open[-1])
        among = self._open[-1], tag
        self._seen[among] = self._seen.get(among, 0) + 1
        self.ordinals.append(self._seen[among])
        self.ends.append(len(self.tags))

    def _close_down_to(self, depth):
        while len(self._open) > max(depth, 1):
            node = self._open.pop()
            self.ends[node] = len(self.tags)
            self._depths[self.tags[node]].pop()

    def _deepest(self, tags):
        return max((self._depths[t][-1] for t in tags if self._depths[t]), default=0)

    def _end_implied(self, names, barriers):
        """Close the outermost open element of these names that no barrier shields."""
        barrier = self._deepest(barriers - names)
        reached = [d[i] for d in (self._depths[t] for t in names) if (i := bisect_left(d, barrier + 1)) < len(d)]
        if reached:
            self._close_down_to(min(reached))

    def handle_starttag(self, tag, attrs):
        self._in_text = False
        if tag in _ENDS_PARAGRAPH:
            self._end_implied({"p"}, _PARAGRAPH_BARRIERS)
        elif tag in _ENDS:
            self._end_implied(*_ENDS[tag])
        self._add(tag, {name: value or "" for name, value in reversed(attrs)})
        if tag not in _VOID:
            self._depths[tag].append(len(self._open))
            self._open.append(len(self.tags) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close_down_to(len(self._open) - 1)

    def handle_endtag(self, tag):
        if not self._depths[tag]:
            return
        rank = _RANK.get(tag, 0)
        depth = self._depths[tag][-1]
        if depth > self._deepest([t for t, r in _RANK.items() if r > rank]):
            self._in_text = False
            self._close_down_to(depth)

    def handle_data(self, data):
        if self._in_text:
            self.values[-1] += data
        else:
            self._add(None, data)
            self._in_text = True

    def handle_comment(self, data):
        self._in_text = False

    def handle_decl(self, decl):
        self._in_text = False

    def handle_pi(self, data):
        self._in_text = False

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # an unknown section is skipped like a comment
            return self.parse_bogus_comment(i)

    def inside(self, node, tag):
        """Descendants of ``node`` with this tag, in document order."""
        places = self.places.get(tag, [])
        return places[bisect_left(places, node + 1):bisect_left(places, self.ends[node])]

    def children(self, node):
        child = node + 1
        while child < self.ends[node]:
            yield child
            child = self.ends[child]

    def nth(self, node):
        """Position of ``node`` among its siblings of the same tag, from 1."""
        return self.ordinals[node]


_STEP = re.compile(
    r'(?P<deep>//|/)(?P<name>text\(\)|@[\w-]+|ancestor::[\w-]+|\*|[\w-]+)'
    r'(?:\[(?:contains\(@(?P<in>[\w-]+), *"(?P<part>[^"]*)"\)|@(?P<attr>[\w-]+)="(?P<value>[^"]*)"|(?P<nth>\d+))\])?')


def compile_selector(selector: str) -> list[dict]:
    """Steps of a path: ``//``, ``/``, a tag or ``*`` with one predicate, ``ancestor::``, ``text()``, ``@attr``."""
    steps, at = [], 1 if selector.startswith(".") else 0
    while at < len(selector):
        step = _STEP.match(selector, at)
        if not step:
            raise ValueError(f"unsupported selector: {selector}")
        steps.append(step.groupdict())
        at = step.end()
    return steps


def _holds(tree, node, step):
    if step["in"]:
        return step["part"] in tree.values[node].get(step["in"], "")
    if step["attr"]:
        return tree.values[node].get(step["attr"]) == step["value"]
    return step["nth"] is None or tree.nth(node) == int(step["nth"])


def select(tree: Tree, node: int, steps: list[dict]) -> list:
    """Nodes below ``node`` in document order, or texts where the path ends in ``text()`` or ``@attr``."""
    found = [node]
    for step in steps:
        name, deep = step["name"], step["deep"] == "//"
        if name.startswith("@"):
            owners = [d for n in found for d in [n, *tree.inside(n, "*")]] if deep else found
            return [tree.values[n][name[1:]] for n in owners if tree.tags[n] and name[1:] in tree.values[n]]
        if name.startswith("ancestor::"):
            reached = set()
            for n in found:
                while (n := tree.parents[n]) > 0:
                    if tree.tags[n] == name[10:]:
                        reached.add(n)
        else:
            tag = None if name == "text()" else name
            reached = set()
            for n in found:
                near = tree.inside(n, tag) if deep else [
                    c for c in tree.children(n) if tree.tags[c] == tag or (tag == "*" and tree.tags[c])]
                reached.update(c for c in near if _holds(tree, c, step))
        found = sorted(reached)
        if name == "text()":
            return [tree.values[n] for n in found]
    return found

"""The main text of a web page, by scoring the containers of its element tree."""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul caption".split())
#: Elements that never hold text of the article.
DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas math button select option input textarea "
    "nav footer aside head title menu dialog audio video datalist".split())
#: Words in the class, id or role of elements that are no part of the article, and of those that are.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense alert alerts banner breadcrumb breadcrumbs "
    "comment comments comentarios commentlist consent cookie cookies dialog disqus disclaimer footer form gdpr "
    "hidden login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain "
    "overlay paywall pager pagination popup promo promotion promoted related recommended replies reply respond "
    "search share sharing sidebar sidenav signup skip skyscraper social sponsor sponsored sponsors subscribe "
    "subscription taboola teaser toolbar widget widgets complementary contentinfo rail topbar".split())
LIKELY = frozenset("article body content entry main post story text".split())
#: Names of reader comments, which may be longer than the article.
REPLIES = frozenset("comment comments comentarios commentlist disqus replies reply respond".split())
#: Names with these tell about the page, as in "has-sidebar".
ABOUT = frozenset("has with no without layout".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_COMMA = re.compile("[,،، 、，﹐﹑､]".replace(" ", ""))
#: A start tag of these ends an open element of the second set, unless one of the third lies between.
_ITEMS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
_SCOPE = frozenset("html table td th caption object template".split())
LEAST_TEXT = 25


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "dropped", "text", "links", "score")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []
        self.dropped = False
        self.text = self.links = 0
        self.score = 0.0


class Tree(HTMLParser):
    """Elements in page order, with the end tags that pages leave out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {}, None)
        self.nodes = [self.root]
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and any(n.tag == tag for n in self.stack):
            return
        if tag in BLOCK:
            self._close({"p"}, _SCOPE)
            if tag == "body":
                self._close({"head"}, ())
        elif self.stack[-1].tag == "head" and tag not in ("title", "meta", "link", "script", "style", "base",
                                                          "noscript", "template"):
            self.stack.pop()
        if tag in _ITEMS:
            self._close(*_ITEMS[tag])
        node = Node(tag, dict(attrs), self.stack[-1])
        self.stack[-1].children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math", "path", "iframe") and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        self._close({tag}, _SCOPE - {tag} if tag in BLOCK else BLOCK)

    def handle_data(self, data):
        self.stack[-1].children.append(data)

    def parse_marked_section(self, i, report=1):
        """A comment up to the next ">", as browsers read it, but for CDATA within drawings and formulas."""
        foreign = self.rawdata[i + 3:i + 9] == "CDATA[" and any(n.tag in ("svg", "math") for n in self.stack)
        end = super().parse_marked_section(i, report) if foreign else -1
        return end if end >= 0 else self.parse_bogus_comment(i, report)

    def _close(self, tags, barrier):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                del self.stack[k:]
                return
            if self.stack[k].tag in barrier:
                return


def _names(node: Node) -> set[str]:
    out: set[str] = set()
    for a in ("class", "id", "role"):
        for name in (node.attrs.get(a) or "").split():
            words = {x.lower() for x in _NAME.findall(name)}
            if not words & ABOUT:
                out |= words
    return out


def _inside(node: Node | None, tags) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _never(node: Node) -> bool:
    """Whether an element is no part of any article by its kind, or is not shown."""
    if node.tag in DROPPED:
        return True
    if node.tag == "header" and not _inside(node.parent, ("article", "main")):
        return True
    a = node.attrs
    return node.tag not in ("html", "body") and bool(a) and (
        "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in (a.get("style") or "").replace(" ", ""))


def _named_noise(node: Node, whole: int) -> bool:
    """Whether an element goes by its name, or as a form. One that holds half of the page's text that is
    no link holds the article, whatever it is called; reader comments are no article unless a
    heading of the page or an article element stands in them."""
    if node.tag in ("html", "body", "h1") or not (node.attrs or node.tag == "form"):
        return False
    names = _names(node)
    if not names & UNLIKELY and node.tag != "form" or names & LIKELY and node.tag in ("article", "main"):
        return False
    if names & REPLIES and not _holds(node, ("h1", "article", "main")):
        return True
    return 2 * (node.text - node.links) < max(whole, 2 * LEAST_TEXT)


def _holds(node: Node, tags) -> bool:
    stack = [node]
    while stack:
        for child in stack.pop().children:
            if not isinstance(child, str) and not child.dropped:
                if child.tag in tags:
                    return True
                stack.append(child)
    return False


def _weigh(nodes: list[Node]) -> None:
    """Length of the text and of the linked text below each node, white space aside."""
    for node in reversed(nodes):
        node.text = node.links = 0
        if node.dropped:
            continue
        for child in node.children:
            if isinstance(child, str):
                node.text += len(child.strip())
            elif not child.dropped:
                node.text += child.text
                node.links += child.text if child.tag == "a" else child.links


def _text(tops: list[Node]) -> str:
    """The blocks below the nodes, in page order, by one space each."""
    parts: list[str] = []
    stack: list = list(reversed(tops))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            parts.append(node)
        elif not node.dropped:
            if node.tag in BLOCK or node.tag == "br":
                parts.append(" ")
                stack.append(" ")
            stack.extend(reversed(node.children))
    return " ".join("".join(parts).split())


def _commas(node: Node) -> int:
    count, stack = 0, [node]
    while stack:
        here = stack.pop()
        for child in here.children:
            if isinstance(child, str):
                count += len(_COMMA.findall(child))
            elif not child.dropped:
                stack.append(child)
    return count


def _own_text(node: Node) -> int:
    """Length of the text in the node that no block below it holds."""
    return sum(len(c.strip()) if isinstance(c, str) else 0 if c.dropped or c.tag in BLOCK else c.text
               for c in node.children)


def main_text(html: str) -> str:
    tree = Tree()
    tree.feed(html)
    tree.close()
    nodes = tree.nodes
    for node in nodes:  # parents come before their children
        node.dropped = (node.parent is not None and node.parent.dropped) or _never(node)
    _weigh(nodes)
    for forms in (False, True):  # forms are held against what is left without the others
        whole = tree.root.text - tree.root.links
        for node in nodes:
            node.dropped = node.dropped or (node.parent is not None and node.parent.dropped) or (
                (node.tag == "form") == forms and _named_noise(node, whole))
        _weigh(nodes)

    scored: dict[int, Node] = {}
    for node in nodes:
        if node.dropped or node.tag not in BLOCK:
            continue
        if node.tag in ("p", "pre", "blockquote", "td", "li", "dd"):
            length = node.text
        else:
            length = _own_text(node)
        if length < LEAST_TEXT:
            continue
        points = 1 + min(length // 100, 3) + _commas(node) if node.tag == "p" or length == node.text \
            else 1 + min(length // 100, 3)
        points *= 1 - node.links / max(node.text, 1)
        carrier, share = (node.parent if node.tag in ("p", "pre", "blockquote", "td", "li", "dd") else node), 1.0
        level = 0
        while carrier is not None and level < 5:
            if carrier.tag in BLOCK:
                carrier.score += points * share
                scored[id(carrier)] = carrier
                level += 1
                share = 0.5 if level == 1 else 1 / (3 * level)
            carrier = carrier.parent
    best = None
    for node in scored.values():
        node.score *= 1 - node.links / max(node.text, 1)
        if best is None or node.score > best.score:
            best = node
    if best is None:
        # No paragraph is long enough: an element that is named as the article, or all that is left.
        named = [n for n in nodes if not n.dropped and n.tag in ("article", "main") and n.text]
        return _text([named[0] if named else tree.root])
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        best = up
    kept = [best]
    # Beside an element that says it is the article, only other parts of it that say so and score alike.
    if best.tag == "article" and best.parent is not None:
        kept = [n for n in best.parent.children if n is best or (
            not isinstance(n, str) and not n.dropped and n.tag == "article"
            and n.score >= 0.5 * best.score and n.links < 0.25 * n.text)]
    if best.parent is not None and best.tag not in ("body", "html", "main", "article"):
        least = max(10.0, 0.2 * best.score)
        kept = []
        for sibling in best.parent.children:
            if isinstance(sibling, str) or sibling.dropped:
                continue
            density = sibling.links / max(sibling.text, 1)
            if sibling is best or (sibling.score >= least and density < 0.5) or (
                    sibling.tag == "p" and sibling.text > 80 and density < 0.25):
                kept.append(sibling)
    return _text(kept)

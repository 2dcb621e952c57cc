"""Main text of web pages by tree scoring.

A small linear-time parser builds the tree (optional end tags, void and raw-text elements, unclosed markup). Elements
whose tag, role or class names mark menus, headers, footers, sidebars, notices, adverts, forms or comments are pruned, unless
they hold the page's articles (or, where it marks none, its title and text, or all of its paragraphs). A name counts by its last word, places
such as "box" left aside, so that "search-results" or "ad-hoc" is none; in an article a paragraph, heading, list, quote or
table goes for its name only if that is just an advert's or if it is mostly links. Readers' comments go by name, or where a
place called a discussion or the like, or one beside the article, repeats blocks with an author or a date. Each paragraph passes points for its length and commas to its
ancestors, in full to the parent and less to those above; a container's points are discounted by the share of its text
inside links. The best container, or the ``article`` or ``main`` round it, is the article, with those of its siblings that
are not mostly links and either score well or are plain blocks of text themselves; all blocks in them are joined in page
order.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tamis.llm.common import arrow_map, texts

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_BROKEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Share of a named paragraph's or list's letters in links from which it is noise, letters of a paragraph that tell a block
#: of text from a line of small print, and elements that are looked through for an author or a date.
MOSTLY_LINKS, PROSE, MARKS = 0.5, 20, 16
#: Names of elements and of their classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
PRUNED = frozenset("nav footer aside form button select dialog menu head iframe object canvas fieldset input label audio video".split())
HARD = frozenset("head select button menu iframe object canvas input label audio video".split())
KEPT = frozenset("html body article main".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion comment comments disqus reply replies "
    "respond sidebar aside nav navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended "
    "recommendations widget pagination pager toolbar search skip hidden copyright legal disclaimer".split()
)
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion".split())
#: Names that no page's article has.
NEVER = ADVERTS | frozenset("cookie cookies consent gdpr".split())
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
TALK = frozenset("conversation discussion feedback opinions reactions responses talk thread".split())
BYLINE = frozenset("author avatar by byline commenter date posted time timestamp user username".split())
PLACES = frozenset(
    "area articles banner bar block body bottom box button buttons card col column container content feed form group head icon icons inline inner "
    "item items left link links list main media message now panel policy posts right row section slot stories strip template text this thread top unit "
    "us wrap wrapper".split()
)
LACKS = frozenset("has with no without not is".split())
#: Containers of an article's own head.
OWN = frozenset("article entry post story content page hentry".split())
FLOW = frozenset("header p h1 h2 h3 h4 h5 h6 ul ol dl li pre blockquote table figure figcaption hgroup details".split())
#: What an article is written in.
PLAIN = FLOW - {"header"} | frozenset("a abbr b br cite code em i img mark q s small span strong sub sup td th tr tbody thead tfoot dt dd time u caption hr".split())
_CLOSES_P = BLOCK - {"option", "optgroup", "legend", "caption", "body", "html", "li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "tfoot"} | {"li", "dt", "dd"}


class Node:
    __slots__ = ("above", "attributes", "depth", "inside", "letters", "linked", "own", "points", "prose", "tag")

    def __init__(self, tag: str, above: Node | None, attributes: str = ""):
        self.tag, self.above, self.attributes = tag, above, attributes
        self.depth = above.depth + 1 if above else 0
        #: own: letters outside of blocks inside the node; prose: those of its longest paragraph
        self.inside: list[Node | str] = []
        self.points = 0.0
        self.letters = self.linked = self.own = self.prose = 0


def parse(html: str) -> Node:
    root = at = Node("#root", None)
    pos, n = 0, len(html)
    opened: dict[str, list[int]] = {}  # depths of open elements by tag, so that neither end tags nor implied ends cost a walk
    while pos < n:
        i = html.find("<", pos)
        if i < 0:
            i = n
        if i > pos:
            at.inside.append(html[pos:i])
        if i == n:
            break
        nxt = html[i + 1 : i + 2]
        if html.startswith("<!--", i):
            j = html.find("-->", i + 4)
            pos = n if j < 0 else j + 3
            continue
        if nxt in "!?" and nxt:
            j = html.find(">", i)
            pos = n if j < 0 else j + 1
            continue
        m = _TAG.match(html, i) or _BROKEN.match(html, i)
        if not m:
            at.inside.append("<")
            pos = i + 1
            continue
        pos, tag = m.end(), m[2].lower()
        if m[1]:
            if opened.get(tag):
                at = _leave(at, tag, opened)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, pos)
            pos = end.end() if end else n
            continue
        if tag in _CLOSES_P:
            at = _close(at, {"p"}, _NOT_P, opened)
        if tag in CLOSED_BY:
            at = _close(at, CLOSED_BY[tag], SCOPES[tag], opened)
        node = Node(tag, at, m[3])
        at.inside.append(node)
        if tag not in VOID and (not m[3].endswith("/") or tag in BLOCK or tag in ("a", "b", "i", "em", "strong", "span")):
            at = node
            opened.setdefault(tag, []).append(node.depth)
    return root


def _leave(at: Node, tag: str, opened: dict[str, list[int]]) -> Node:
    """The place after the innermost open ``tag`` and all inside it have been closed; every element is left once."""
    while True:
        opened[at.tag].pop()
        at, last = at.above, at.tag
        if last == tag:
            return at


def _close(at: Node, tags: set[str], within, opened: dict[str, list[int]]) -> Node:
    """The place after the innermost open element of ``tags`` has been closed, where none of ``within`` is open inside it."""
    deepest, tag = max(((opened[t][-1], t) for t in tags if opened.get(t)), default=(0, ""))
    if not deepest or deepest < max((opened[t][-1] for t in within if opened.get(t)), default=0):
        return at
    return _leave(at, tag, opened)


_NOT_P = BLOCK - {"p"}


def _names(node: Node) -> list[list[str]]:
    """The words of each class and of the id."""
    found = []
    for m in _ATTRIBUTE.finditer(node.attributes):
        if m[1].lower() in ("class", "id"):
            found += [re.findall(r"[a-z]+", name) for name in (m[2] or m[3] or m[4] or "").lower().split()]
    return [words for words in found if words]


def _core(words: list[str]) -> list[str]:
    """A name's words without the places at its end."""
    k = len(words)
    while k > 1 and words[k - 1] in PLACES:
        k -= 1
    return words[:k]


def _noisy(words: list[str]) -> bool:
    """Whether a name's last word names noise ("cookie-notice", "top-ad-box") and what stands before it does not deny that
    ("has-sidebar", "entry-header")."""
    words = _core(words)
    if words[-1] not in NOISE or words[0] in LACKS or len(words) > 1 and words[-2] in LACKS:
        return False
    return not (words[-1] in ("header", "masthead") and len(words) > 1 and words[0] in OWN)


def _marked(node: Node) -> bool:
    """Whether an element holds an author or a date, among the first elements in it."""
    todo, seen = [node], 0
    while todo and seen < MARKS:
        x = todo.pop()
        seen += 1
        if x.tag in ("time", "cite") or any(w in BYLINE for words in _names(x) for w in words):
            return True
        todo.extend(y for y in reversed(x.inside) if not isinstance(y, str))
    return False


def _thread(node: Node, least: int) -> bool:
    """Whether at least so many of an element's blocks, or of those of the one list in it, are alike and have an author or
    a date each."""
    inner = [x for x in node.inside if not isinstance(x, str)]
    for x in inner:
        if x.tag in ("ul", "ol", "dl"):
            inner = [y for y in x.inside if not isinstance(y, str)]
            break
    alike: dict[tuple, int] = {}
    for x in inner:
        if x.tag in ("li", "dd", "div", "article", "section") and _marked(x):
            key = (x.tag, x.attributes if "class" not in x.attributes else str(_names(x)[:1]))
            alike[key] = alike.get(key, 0) + 1
    return max(alike.values(), default=0) >= least


def _comments(node: Node, names: list[list[str]]) -> bool:
    """Whether an element is a place of readers' comments, by its name or by that and its form."""
    if any(_core(words)[-1] in COMMENTS for words in names):
        return True
    return any(not TALK.isdisjoint(words) for words in names) and _thread(node, 1)


def _own(node: Node) -> bool:
    """Whether a class or id begins with a word for the article."""
    return any(words[0] in OWN for words in _names(node))


def _unseen(node: Node) -> bool:
    for m in _ATTRIBUTE.finditer(node.attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _walk(root: Node) -> list[Node]:
    """Nodes in page order, pruned ones and what they hold left out."""
    every, todo = [], [root]
    while todo:
        node = todo.pop()
        every.append(node)
        todo.extend(x for x in reversed(node.inside) if not isinstance(x, str))
    #: Of each node: articles, titles and paragraphs in it; letters, and those of them in links.
    held: dict[int, tuple[int, int, int, int, int]] = {}
    for node in reversed(every):  # children come after their parents
        own = sum(len(x) - x.count(" ") - x.count("\n") for x in node.inside if isinstance(x, str))
        a, h, p, n, links = (sum(v) for v in zip((0, 0, 0, own, 0), *(held[id(x)] for x in node.inside if not isinstance(x, str)), strict=True))
        held[id(node)] = (a + (node.tag in ("article", "main")), h + (node.tag == "h1"), p + (node.tag == "p"), n, n if node.tag == "a" else links)
    articles, _, paragraphs, _, _ = held[id(root)]

    def whole(node: Node) -> bool:
        a, h, p, _, _ = held[id(node)]
        return a == articles if articles else p > 0 and h > 0 or p == paragraphs > 1

    def goes(node: Node, inside: bool) -> bool:
        tag = node.tag
        if tag in KEPT:
            return False
        if tag == "header":
            return not inside
        if tag in PRUNED:
            return tag != "form" or not whole(node)
        if not node.attributes:
            return False
        names = _names(node)
        if tag not in PLAIN - {"ul", "ol", "dl", "table"} and _comments(node, names):
            return True
        if whole(node) and NEVER.isdisjoint(w for words in names for w in _core(words)[-1:]):
            return False
        if _unseen(node):
            return True
        if not any(map(_noisy, names)):
            return False
        if tag not in PLAIN or not inside:
            return True
        _, _, _, n, links = held[id(node)]
        return links >= MOSTLY_LINKS * max(n, 1) and n > 0 or any(len(words) == 1 and words[0] in ADVERTS for words in names)

    out: list[Node] = []
    walk = [(root, False)]  # inside: of an article, or of what is named like one
    while walk:
        node, inside = walk.pop()
        inside = inside or node.tag in ("article", "main") or node.attributes != "" and _own(node)
        node.inside = [x for x in node.inside if isinstance(x, str) or not goes(x, inside)]
        out.append(node)
        walk.extend((x, inside) for x in reversed(node.inside) if not isinstance(x, str))
    return out


def measure(nodes: list[Node]) -> None:
    """Sets the letters, linked letters and points of nodes in page order."""
    commas = {}
    for node in reversed(nodes):  # children come after their parents
        own = c = bare = 0
        for x in node.inside:
            if isinstance(x, str):
                n = len(x) - x.count(" ") - x.count("\n")
                own += n
                bare += n
                c += x.count(",") + x.count("，") + x.count("、")
            else:
                own += x.letters
                bare += 0 if x.tag in BLOCK else x.own
                node.linked += x.linked
                node.prose = max(node.prose, x.prose)
                c += 0 if x.tag in BLOCK else commas[id(x)]
        node.letters, node.own = own, bare
        commas[id(node)] = c
        if node.tag == "a":
            node.linked = own
        if node.tag == "p":
            node.prose = max(node.prose, bare)
    for node in nodes:
        if node.tag in BLOCK and node.tag not in KEPT and node.own >= 2:
            points = (1 if node.tag == "p" else 0.5) + commas[id(node)] + min(node.own / 100, 5)
            points *= 1 - node.linked / max(node.letters, 1)
            up, share = node.above, 1.0
            while up is not None and share > 0.1:
                up.points += points * share
                share /= 2
                up = up.above
    for node in nodes:
        node.points *= 1 - node.linked / max(node.letters, 1)
        if node.tag in ("article", "main"):
            node.points *= 1.5


def main_text(html: str) -> str:
    root = parse(html)
    nodes = _walk(root)
    measure(nodes)
    return "\n".join(_blocks(chosen(nodes)))


def chosen(nodes: list[Node]) -> list[Node]:
    """The article's elements among measured nodes, the root first; of equal containers the first in page order."""
    best = max(nodes[1:], key=lambda x: x.points, default=None)
    if best is None or best.points <= 0:
        return nodes[:1]
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.above
    best = up or best
    if best.above is None or best.tag in ("body", "html"):
        return [best]
    return [x for x in best.above.inside if not isinstance(x, str) and (x is best or _joins(x, best))]


def _joins(node: Node, best: Node) -> bool:
    """Whether a sibling of the best container belongs to it: it has points of its own, or, where no ``article`` or
    ``main`` marks the whole, it is or holds a block of text; neither if it is mostly links or a thread of comments."""
    density = node.linked / max(node.letters, 1)
    if density >= 0.3 or _thread(node, 2):
        return False
    if best.tag in ("article", "main"):
        return node.points >= max(5.0, 0.2 * best.points) or node.tag in ("p", "h1", "h2") and node.letters > (80 if node.tag == "p" else 0)
    return node.tag in FLOW or node.prose >= PROSE or node.points >= max(3.0, 0.1 * best.points) or any(not isinstance(x, str) and x.tag == "h1" for x in node.inside)


def _blocks(chosen: list[Node]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join(unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    todo: list = list(reversed(chosen))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            run.append(x)
        elif x is None:
            end()
        elif x.tag in BLOCK:
            end()
            todo.append(None)
            todo.extend(reversed(x.inside))
        elif x.tag in ("br", "img", "wbr"):
            run.append(" " if x.tag == "br" else "")
        else:
            todo.extend(reversed(x.inside))
    end()
    return out


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every page's id, ``url``, ``text`` and ``n_chars``.

    Defined cases: null or empty html, and pages without text, give an empty text; null ids and urls stay null; repeated
    pages are each answered; pages of any length, deep nesting and unmatched tags are walked in linear time without
    recursion over the tree; of containers that score alike (ties) the first wins; an empty table gives no rows.
    """

    def make():
        def step(batch):
            text = [main_text(h) for h in texts(batch, html_col)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                names=[id_col, "url", "text", "n_chars"],
            )

        return step

    kind = pages.schema[id_col].dataType.simpleString()
    return arrow_map(pages, [id_col, "url", html_col], f"`{id_col}` {kind}, url string, text string, n_chars long", make)

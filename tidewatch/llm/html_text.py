"""Main text of HTML pages by tree scoring.

Paragraphs earn points for length and commas and pass them to their ancestors, less with each level; a container's
points are discounted by its link density; the best container and those of its siblings that read like it are kept.
Class names take an element away only where the page has other text to speak of; an element that holds nearly all of
it only loses points.
"""

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.common import small_batches

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r"""[>"']""")
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas noembed xmp".split())
RAW_END = {x: re.compile(f"</{x}", re.I | re.A) for x in RAW}
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: What never belongs to an article.
JUNK = frozenset("head nav footer button select input datalist".split())
#: What rather doesn't, but may hold all of a page, as a form does where a server's framework wraps each page in one.
DOUBTFUL = frozenset("aside form menu dialog label fieldset".split())
#: Words in class, id or role that mark what isn't an article.
JUNK_WORDS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall share sharing social related recommended recommendations trending comment comments commentlist disqus respond reply replies opinions feedback pagination pager widget widgets search complementary contentinfo dialog form copyright disclaimer skip".split())
#: Words of reader comments among them.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies opinions feedback".split())
#: What a class says of the page and not of its element: has-sidebar, comments-open, search-result.
SAYS_OF_PAGE = re.compile(r"(?:has|have|with|without|no|is|not)[-_].*|.*[-_](?:open|opened|closed|enabled|disabled|result|results|on|off)", re.I)
#: An element with such words stays, at half its points, if it has so many times the text (links aside) of all the page
#: outside elements like it; reader comments, if there is so little text outside.
RATHER_ARTICLE = 4
LEAST_OUTSIDE = 25
#: Blocks of the article go, as menus do, if they have so many links, and so large a share of their text in them.
LINKS, LINKED = 2, 0.6
LISTED = frozenset("div section ul ol dl table".split())
#: Where such words say nothing about the element's own kind.
TRUSTED = frozenset("html body article main".split())
CLOSED_BY = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: What ends the search for an element that a new one closes.
LISTS = ("ul", "ol", "dl", "table", "select", "div", "article", "body")
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "figcaption", "legend", "summary"}
PARAGRAPHS = frozenset("p pre blockquote td li dd div section article main figcaption h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("anchors", "commas", "direct", "doubt", "junk", "kids", "length", "links", "parent", "points", "tag")

    def __init__(self, tag, parent, junk=False, doubt=""):
        self.tag, self.parent, self.junk, self.doubt, self.kids = tag, parent, junk, doubt, []
        self.points, self.length, self.links, self.direct, self.commas, self.anchors = 0.0, 0, 0, 0, 0, 0


def _junk(tag: str, attrs: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element can't belong to an article, and the words in class, id or role for which it rather doesn't."""
    if tag in JUNK or tag == "header" and not in_article:
        return True, ""
    doubt = "other" if tag in DOUBTFUL else ""
    if not attrs or tag in TRUSTED:
        return False, doubt
    for name, value in ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, ""
        if name in ("class", "id", "role"):
            found = {x.lower() for word in value.split() if not SAYS_OF_PAGE.fullmatch(word) for x in NAME.findall(word)} & JUNK_WORDS
            if found:
                doubt = "comment" if doubt == "comment" or found & COMMENT_WORDS else "other"
    return False, doubt


def _tag_end(page: str, at: int) -> int:
    """Where the > of a tag stands, quoted ones passed over (a quote without its other half is no quote); -1 if there is none."""
    while m := TAG_STOP.search(page, at):
        if m[0] == ">":
            return m.start()
        closed = page.find(m[0], m.end())
        at = closed + 1 if closed >= 0 else m.end()
    return -1


def _tokens(page: str):
    """The strings of a page and its tags as (is it closing, name, attributes), in one pass: no place is looked at again,
    whatever is left open. A tag without its end goes to the end of the page, as in browsers."""
    at, n, last_quote = 0, len(page), max(page.rfind('"'), page.rfind("'"))
    while at < n:
        start = page.find("<", at)
        if start < 0:
            start = n
        if start > at:
            yield page[at:start]
        if start == n:
            return
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else n
            continue
        close = page.startswith("/", start + 1)
        m = TAG_NAME.match(page, start + 1 + close)
        if not m:
            if page[start + 1 : start + 2] in ("!", "?", "/"):
                end = page.find(">", start)
                at = end + 1 if end >= 0 else n
            else:
                yield "<"
                at = start + 1
            continue
        end = _tag_end(page, m.end()) if m.end() <= last_quote else page.find(">", m.end())
        if end < 0:
            return
        tag, attrs, at = m[0].lower(), page[m.end() : end], end + 1
        if not close and tag in RAW and not attrs.endswith("/"):
            m = RAW_END[tag].search(page, at)
            end = page.find(">", m.end()) if m else -1
            at = end + 1 if end >= 0 else n
            continue
        yield close, tag, attrs


def parse(page: str) -> Node:
    """A tree of elements and strings; unclosed and stray tags are put right as browsers do in the main."""
    root = Node("#", None)
    stack, blocks = [root], [0]  # the open elements, and where block elements stand among them
    where: dict[str, list[int]] = defaultdict(list)

    def shut(k: int) -> None:
        for x in reversed(stack[k:]):
            where[x.tag].pop()
            if x.tag in BLOCK:
                blocks.pop()
        del stack[k:]

    def last(tags) -> int:
        return max((where[x][-1] for x in tags if where[x]), default=0)

    for token in _tokens(page):
        if isinstance(token, str):
            stack[-1].kids.append(token)
            continue
        close, tag, attrs = token
        if close:
            if where[tag] and (tag in BLOCK or blocks[-1] < last([tag])):
                shut(last([tag]))
            continue
        if tag in CLOSES_P and where["p"] and blocks[-1] == last(["p"]):
            shut(last(["p"]))
        if tag in CLOSED_BY and (k := last(CLOSED_BY[tag])) > last(LISTS):
            shut(k)
        node = Node(tag, stack[-1], *_junk(tag, attrs, bool(where["article"] or where["main"])))
        stack[-1].kids.append(node)
        if tag not in VOID and (tag in CLOSED_BY or not attrs.endswith("/")):
            where[tag].append(len(stack))
            if tag in BLOCK:
                blocks.append(len(stack))
            stack.append(node)
    return root


def _settle_doubts(root: Node) -> None:
    """Elements with doubtful words are junk, but for those that hold nearly all the text around them."""
    own, below, order, todo = {id(root): 0}, {id(root): []}, [root], [(root, False, root)]
    while todo:
        node, link, top = todo.pop()
        for kid in node.kids:
            if isinstance(kid, str):
                own[id(top)] += 0 if link else len(kid.strip())
            elif not kid.junk:
                if kid.doubt:
                    own[id(kid)], below[id(kid)] = 0, []
                    below[id(top)].append(kid)
                    order.append(kid)
                todo.append((kid, link or kid.tag == "a", kid if kid.doubt else top))
    size = {}
    for node in reversed(order):
        size[id(node)] = own[id(node)] + sum(size[id(x)] for x in below[id(node)])
    todo = [root]
    while todo:
        top = todo.pop()
        outside = own[id(top)]
        for node in sorted(below[id(top)], key=lambda x: -size[id(x)]):
            n = size[id(node)]
            if n > RATHER_ARTICLE * outside if node.doubt != "comment" else n > outside and outside < LEAST_OUTSIDE:
                outside += n
                todo.append(node)
            else:
                node.junk = True


def _measure(root: Node) -> list[Node]:
    """Lengths, lengths in links and points; the elements in page order."""
    _settle_doubts(root)
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        for kid in reversed(node.kids):
            if isinstance(kid, Node) and not kid.junk:
                todo.append(kid)
    for node in reversed(order):
        for kid in node.kids:
            if isinstance(kid, str):
                size = len(kid.strip())
                node.direct += size
                node.length += size
                node.commas += sum(map(kid.count, ",،、，"))
            elif not kid.junk:
                node.length += kid.length
                node.links += kid.length if kid.tag == "a" else kid.links
                node.anchors += kid.anchors + (kid.tag == "a")
                if kid.tag not in BLOCK:
                    node.direct += kid.direct
                    node.commas += kid.commas
    for node in order:
        if node.tag in PARAGRAPHS and node.direct:
            points = (1 + node.commas + min(node.direct // 100, 3)) * (1 - min(node.links / max(node.length, 1), 1))
            up, share = node.parent if node.tag in ("p", "pre", "td", "li", "dd", "blockquote", "figcaption") or node.tag[0] == "h" else node, 1.0
            level = 0
            while up is not None and level < 5:
                up.points += points * share
                level += 1
                share = 0.5 if level == 1 else share * 2 / 3
                up = up.parent
    for node in order:
        node.points *= (1 - min(node.links / max(node.length, 1), 1)) * (0.5 if node.doubt else 1)
    return order


def _link_list(node: Node) -> bool:
    return node.tag in LISTED and node.anchors >= LINKS and node.links >= LINKED * node.length


def _blocks(node: Node, out: list[str], line: list[str]) -> None:
    """Appends the texts of the blocks below node in page order."""
    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            text = " ".join(html.unescape("".join(line)).split())
            line.clear()
            if text:
                out.append(text)
        elif isinstance(x, str):
            line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif not x.junk and (x is node or not _link_list(x)):
            edge = x.tag in BLOCK
            if edge:
                todo.append(None)
            todo.extend(reversed(x.kids))
            if edge:
                todo.append(None)


def main_text(page: str | None) -> str:
    """The blocks of the article, parted by empty lines."""
    if not page:
        return ""
    root = parse(page)
    order = _measure(root)
    best = max(order, key=lambda x: x.points)
    if not best.length:
        return ""
    # an article's headline and lead stand beside the container of its body
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    top = up or best
    if top.tag == "main" and best.tag != "main" and any(x.tag == "article" for x in order):
        top = best
    kept = [top]
    if top.parent is not None:
        least = max(1.0, 0.2 * top.points)
        for x in top.parent.kids:
            if isinstance(x, Node) and x is not top and not x.junk and x.tag in BLOCK and x.length:
                dense = x.links / x.length
                if x.tag == top.tag and x.points >= least or x.tag == "p" and dense < 0.25 and x.length >= 80 or x.tag[0] == "h" and x.tag[1:].isdigit() and dense < 0.5:
                    kept.append(x)
    chosen, out = {id(x) for x in kept}, []
    for x in order:
        if id(x) in chosen:
            line: list[str] = []
            _blocks(x, out, line)
            text = " ".join(html.unescape("".join(line)).split())
            if text:
                out.append(text)
    return "\n\n".join(out)


def _extract(batches):
    for b in batches:
        text = [main_text(x) for x in b.column("html").to_pylist()]
        text = [x.encode("utf-8", "replace").decode() for x in text]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """One row for each row of pages (page_id, url, html): page_id, url, text (empty if there is none), n_chars (code points).

    Null and empty html give empty texts; null ids and urls pass through; equal rows give equal rows; other columns are
    ignored; pages of any length are read whole; an empty table gives an empty result.
    """
    small_batches(pages.sparkSession)
    of = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_extract, f"page_id {of}, url string, text string, n_chars long")

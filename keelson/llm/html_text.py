"""Main text of HTML pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textops
from keelson.llm.columns import unused

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[^a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
# What is never article text, by element.
DROPPED = frozenset(
    "head nav footer aside button select option input dialog menu template svg math canvas object embed audio "
    "video map".split()) | RAW
# The same by a word of class or id, and by role.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay sidebar sidebars sidenav rail menu menus nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar comment comments commentlist respond reply replies disqus share sharing social "
    "related recommended newsletter subscribe signup login search searchbox widget widgets pagination pager toolbar copyright".split())
# Names of readers' texts, which may well be longer than the article.
_READERS = frozenset("comment comments commentlist respond reply replies disqus".split())
# Names that speak of a layout or a page builder, not of what the element is.
_LAYOUT = re.compile(r"(?:with|without|no|has|elementor)[-_]")
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
# A start tag that closes an open element of the same family, up to the nearest of its borders.
_PARAGRAPH_ENDERS = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split())
_FAMILY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
_BORDERS = frozenset("html body div article section main ul ol dl table blockquote td th li aside header footer form".split())
_ARTICLE = frozenset(["article", "main"])
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre td th figcaption caption address summary tr".split())
_LISTS = frozenset("div ul ol dl table section".split())
MENU_SHARE = 0.9  # three links or more with this share of a container's text make it a menu
READERS_SHARE = 0.9  # on a page without structure an element named after comments is the text from here on
FREE_TEXT = 60  # so many characters directly in an element that is no p are a paragraph as well
SLACK = 0.2  # a part counts from this share of the smallest density above the main part


KEPT, DROP, NAMED, READERS = range(4)


def _drops(tag: str, attributes: str, in_article: bool) -> int:
    """DROP: never article text. NAMED, READERS: no article text unless the article is in it."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return DROP
    verdict = NAMED if tag == "form" else KEPT
    if not attributes or tag in ("html", "body", "article", "main"):
        return verdict
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            words = {w for one in value.split() if not _LAYOUT.match(one) for w in _WORDS.split(one)}
            if not _READERS.isdisjoint(words):
                verdict = READERS
            elif not DROPPED_WORDS.isdisjoint(words) or ("header" in words and not in_article):
                verdict = max(verdict, NAMED)
        elif name == "role" and value in DROPPED_ROLES:
            verdict = max(verdict, NAMED)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return DROP
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return DROP
    return verdict


def _drop_named(tags, parents, dropped, named, chars, link_chars) -> None:
    """Drop the elements of unfitting names, as the structure of the page says.

    One around ``main`` stays. If the page has an article or main with text outside such elements, or a first heading
    and a paragraph, all others go. Else those that hold an article or first heading stay (of readers' texts only if no other
    does) and the rest goes. Without either, all go if there is a paragraph outside. Only a page that has nothing else
    is decided by shares: more than half of the text outside links, for readers' texts ``READERS_SHARE``. If no text would be left, all stay.
    """
    if not any(named):
        return
    n = len(tags)
    under = [False] * n
    for i in range(n):
        under[i] = dropped[i] or named[i] != KEPT or i > 0 and under[parents[i]]

    def subtree(own: list[int]) -> list[int]:
        for i in range(n - 1, 0, -1):
            own[parents[i]] += own[i]
        return own

    def plain() -> list[int]:
        return subtree([0 if d else c - k for d, c, k in zip(dropped, chars, link_chars)])

    def having(wanted: frozenset[str], text: list[int]) -> list[int]:
        return subtree([int(t in wanted and x > 0) for t, x in zip(tags, text)])

    outside = [0 if u else c - k for u, c, k in zip(under, chars, link_chars)]
    paragraph = any(x >= FREE_TEXT or t == "p" and x for t, x in zip(tags, outside))
    free = subtree(list(outside))
    article = any(x and t in _ARTICLE for t, x in zip(tags, free)) or paragraph and any(x and t == "h1" for t, x in zip(tags, free))
    text = plain()
    around, signs = having(frozenset(["main"]), text), having(_ARTICLE | {"h1"}, text)
    before = list(dropped)

    def drop(goes) -> None:
        for i in range(1, n):
            if dropped[parents[i]] or named[i] != KEPT and not around[i] and goes(i):
                dropped[i] = True

    if article:
        drop(lambda i: True)
    elif any(s and v != KEPT for s, v in zip(signs, named)):
        best = min(v for s, v in zip(signs, named) if s and v != KEPT)
        drop(lambda i: not signs[i] or named[i] > best)
    elif paragraph:
        drop(lambda i: True)
    else:
        for verdict, share in ((READERS, READERS_SHARE), (NAMED, 0.5)):
            text = plain()
            drop(lambda i: named[i] == verdict and text[i] <= share * text[0])
    if not any(c for c, d in zip(chars, dropped) if not d):
        dropped[:] = before


def main_text(html: str) -> str:
    """The blocks of the page's densest part, joined by line feeds."""
    tags, parents, dropped, named, linked, article = [""], [-1], [False], [KEPT], [False], [False]
    pieces: list[tuple[int, int, str]] = []  # node, block, text
    stack, block, at, end = [0], 0, 0, len(html)
    body = 0

    def text(low: int, high: int) -> None:
        if low < high and not dropped[stack[-1]]:
            pieces.append((stack[-1], block, html[low:high]))

    while at < end:
        m = _TOKEN.search(html, at)
        if not m:
            text(at, end)
            break
        text(at, m.start())
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag = name.lower()
        if tag not in INLINE:
            block += 1
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] == tag:
                    del stack[k:]
                    break
            continue
        if tag == "br":
            if not dropped[stack[-1]]:
                pieces.append((stack[-1], block, " "))
            continue
        if tag == "body" and body or tag == "html" and len(stack) > 1:
            continue
        closes = _FAMILY.get(tag) or (("p",) if tag in _PARAGRAPH_ENDERS else ())
        if tag == "body":
            closes = ("head",)
        if closes:
            for k in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[k]]
                if open_tag in closes:
                    del stack[k:]
                    if len(closes) == 1:
                        break
                elif open_tag in _BORDERS:
                    break
        if tag in VOID:
            continue
        up = stack[-1]
        tags.append(tag)
        parents.append(up)
        article.append(article[up] or tag in _ARTICLE)
        verdict = _drops(tag, m[3] or m[6] or "", article[up])
        dropped.append(dropped[up] or verdict == DROP)
        named.append(verdict if verdict > DROP else KEPT)
        linked.append(linked[up] or tag == "a")
        node = len(tags) - 1
        if tag == "body":
            body = node
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = close.end() if close else end
        elif not (m[3] or m[6] or "").endswith("/") or tag in INLINE or tag in _BORDERS:
            stack.append(node)

    blocks: dict[int, list[tuple[int, str]]] = {}
    n = len(tags)
    chars, link_chars = [0] * n, [0] * n
    for node, b, piece in pieces:
        piece = unescape(piece)
        size = len("".join(piece.split()))
        blocks.setdefault(b, []).append((node, piece))
        chars[node] += size
        if linked[node]:
            link_chars[node] += size
    _drop_named(tags, parents, dropped, named, chars, link_chars)
    for i in range(n):
        if dropped[i]:
            chars[i] = link_chars[i] = 0
    marked = _content(tags, parents, dropped, chars, link_chars, body)
    out = []
    for b in sorted(blocks):
        line = " ".join("".join(piece for node, piece in blocks[b] if marked[node]).split())
        if line:
            out.append(line)
    return "\n".join(out)


def _content(tags, parents, dropped, chars, link_chars, body) -> list[bool]:
    """The nodes of the parts that the densities select.

    A node comes after its parent, so sums run backwards and inherited marks forwards. Only
    containers are selected, never a single paragraph or inline element.
    """
    n = len(tags)
    count, link_tags = [0 if d else 1 for d in dropped], [int(t == "a" and not d) for t, d in zip(tags, dropped)]
    for i in range(n - 1, 0, -1):
        p = parents[i]
        chars[p] += chars[i]
        link_chars[p] += link_chars[i]
        count[p] += count[i]
        link_tags[p] += link_tags[i]
    ratio = link_chars[body] / max(chars[body], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        c = chars[i]
        if c and not dropped[i]:
            links = max(link_chars[i], 1)
            base = math.log(c / max(c - link_chars[i], 1) * links + ratio * c + math.e)
            density[i] = c / count[i] * math.log(c * count[i] / (links * max(link_tags[i], 1))) / math.log(base)
    for i in range(n - 1, 0, -1):
        sums[parents[i]] += density[i]

    best = [i if t not in INLINE and t not in _TEXT_BLOCKS else -1 for i, t in enumerate(tags)]  # of each subtree
    for i in range(n - 1, 0, -1):
        p, b = parents[i], best[i]
        if b >= 0 and (best[p] < 0 or sums[b] > sums[best[p]] or sums[b] == sums[best[p]] and best[p] != p):
            best[p] = b
    top = i = best[body]
    low = density[i]
    while i > body:
        i = parents[i]
        low = min(low, density[i])
        if tags[i] in _ARTICLE:
            top = i
    marked, inside = [False] * n, [False] * n
    marked[top] = True
    for i in range(body, n):
        up = parents[i]
        inside[i] = i == body or inside[up]
        menu = not (marked[up] and up != body) and tags[i] in _LISTS and link_tags[i] >= 3 and link_chars[i] >= MENU_SHARE * chars[i]
        if not inside[i] or dropped[i] or menu and i != body:
            marked[i] = inside[i] = False
            continue
        marked[i] = marked[i] or i > body and marked[up]
        if not marked[i] and chars[i] and density[i] >= SLACK * low:
            marked[best[i] if best[i] >= 0 else i] = True
    return marked


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, the article of each page, and ``n_chars``, its code points.

    Elements that are no article text by name, role, or a word of class or id go first: menus,
    page headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments.
    Those named by class, id or role, and forms, stay where the structure says that they hold the article
    (:func:`_drop_named`); a button's word goes also inside a paragraph. Containers of at least
    three links and next to no other text go too, unless they are within the main part. On the rest every DOM node gets a composite text density (characters per tag, lowered by
    its share of link text against the page's share). The node whose children have the largest
    sum of densities is content, or the article element around it; ``SLACK`` times the smallest
    density on its way up to the body is the threshold at which other parts count as content too.

    Character references are decoded, white space in a block (Unicode's, and a line break
    element) becomes one space, blocks are trimmed and joined by one line feed in page order;
    empty ones are left out. Broken markup (open elements, stray ends, a page cut off) is read as browsers
    do in the common cases. A NULL or empty page gives an empty text. Rows are independent,
    repeated rows give repeated results; new columns replace columns of their names.
    """
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for html in textops.released(batches):
            texts = [main_text(x) if x else "" for x in html.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["text", "n_chars"])

    parse = F.arrow_udf(run, "text string, n_chars long")
    found, = unused(kept, "found")
    out = pages.select(*[F.col(f"`{c}`") for c in kept], parse(F.col(f"`{html_col}`").cast("string")).alias(found))
    return out.select(*[F.col(f"`{c}`") for c in kept], f"{found}.text", f"{found}.n_chars")

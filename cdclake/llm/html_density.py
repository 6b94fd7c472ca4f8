"""Main text of web pages by composite text density.

For every node of the page: characters, tags, link characters and link tags
below it give the composite text density, characters per tag adjusted for
links:

    density = C / T * log_b(C / LC * T / LT),
    b = ln(C / (C - LC) * LC + LC_body / C_body * C + e)

(zero denominators count as 1). A node's density sum adds its children's
densities. The node with the greatest sum holds the article; the least
density on its path to the body is the threshold. Inside an ``article`` or
``main`` element the whole of that element is the article; elsewhere every
node that reaches the threshold contributes the densest subtree below it.

Menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are cut before the densities are computed, by
element, role, hidden state, or class and id words. A class that only states
something (``has-sidebar``, ``share-enabled``) is no such word, a node named
by its layout (``sidebar``, ``nav``, ...) stays if it holds most of the text
around it, one named by a word that prose may have too (``related``, ...)
stays if it is prose, and a node that holds the article always stays. Lists
and boxes of links are cut inside an article too. Blocks come in page order;
white space inside a block (``br`` included) becomes one space.

Defined cases: a null or empty page, or one without text, gives ''; unclosed
and stray tags are taken as browsers do (an open ``p`` ends at the next
block); repeated rows are extracted alike; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cdclake.llm.common import map_texts

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|iframe|svg|math|xmp|noembed|noframes)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?/][^>]*>"
    r"|([^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end an open paragraph, and the elements its search stops at.
ENDS_P = BLOCKS - frozenset("body caption html legend option optgroup tbody td tfoot th thead tr".split())
_P = frozenset(["p"])
P_SCOPE = frozenset("html table td th caption button object template".split())
#: Start tag -> (open elements it ends, elements at which the search stops).
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}

CUT_TAGS = frozenset("head nav footer aside form button select dialog object audio video canvas menu search fieldset".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars nav navbar"
    " navigation menu menus breadcrumb breadcrumbs footer masthead comment comments commentlist respond disqus cookie cookies"
    " consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " related recommended recommendations widget widgets pagination pager toolbar skip outbrain taboola".split()
)
#: Of these, words of a place on the page: a wrapper of the whole content may be named by them as well.
LAYOUT_WORDS = frozenset(
    "banner sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead modal overlay signup login"
    " share sharing social related recommended recommendations widget widgets pagination pager toolbar skip".split()
)
#: Of these, words that a section of prose may be named by; it is prose with so many characters, less than half of them links.
WEAK_WORDS = frozenset("share sharing social related recommended recommendations skip banner".split())
PROSE_CHARS = 200
#: First and last words of class names that state something about a page or its content.
STATE_FIRST = frozenset("has with without no not is show hide".split())
STATE_LAST = frozenset("enabled disabled open opened closed visible hidden layout ready loaded".split())
#: Elements that are cut as boxes of links: so many links and next to no other text.
LINK_BOXES = frozenset("div dl menu ol p section table ul".split())
LINKS, LINK_SHARE = 3, 0.9
COMMENT_WORDS = frozenset("comment comments commentlist respond disqus".split())
HEADER_WORDS = frozenset(["header", "masthead", "topbar"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset(["article", "main"])


STAYS, NAMED, CUT, NAMED_BY_LAYOUT, NAMED_WEAKLY = range(5)


def _words(value: str) -> set[str]:
    """The words of class names, without names that only state something."""
    found: set[str] = set()
    for name in value.split():
        words = _WORDS.findall(_CAMEL.sub(" ", name).lower())
        if len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST):
            continue
        found.update(words)
    return found


def _cut(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element goes: ``STAYS``, ``CUT``, or named by a word of what is cut. ``inside``: below an article or main element."""
    if tag in CUT_TAGS or (tag == "header" and not inside):
        return CUT
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return STAYS
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            words |= _words(value)
        elif name == "role" and value.lower() in CUT_ROLES:
            return CUT
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return CUT
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return CUT
    if tag in ("html", "body", "main"):
        return STAYS
    if tag == "article":
        return CUT if words & COMMENT_WORDS else STAYS
    named = words & CUT_WORDS if inside else words & (CUT_WORDS | HEADER_WORDS)
    if not named:
        return STAYS
    return NAMED_WEAKLY if named <= WEAK_WORDS else NAMED_BY_LAYOUT if named <= LAYOUT_WORDS | HEADER_WORDS else NAMED


class Page:
    """Nodes of a page in document order, as parallel lists; node 0 is the root."""

    def __init__(self, source: str):
        self.parent, self.tag, self.cut = [-1], ["#root"], [0]
        self.chunks: list[tuple[int, int, str]] = []  # node, block number, text
        self.stack, self.open = [0], Counter()
        block = 0
        for m in _TOKEN.finditer(source):
            text = m[5]
            if text is not None:
                self.chunks.append((self.stack[-1], block, html.unescape(text) if "&" in text else text))
                continue
            name = m[3]
            if name is None:
                continue
            tag = name.lower()
            if m[2]:
                if self.open[tag]:
                    self._close(next(d for d in range(len(self.stack) - 1, 0, -1) if self.tag[self.stack[d]] == tag))
                block += tag in BLOCKS
                continue
            if tag in ENDS_P and self.open["p"]:
                self._end(_P, P_SCOPE)
            if tag in ENDS and any(self.open[t] for t in ENDS[tag][0]):
                self._end(*ENDS[tag])
            if tag == "br":
                self.chunks.append((self.stack[-1], block, " "))
            block += tag in BLOCKS
            self.parent.append(self.stack[-1])
            self.tag.append(tag)
            self.cut.append(_cut(tag, m[4], bool(self.open["article"] or self.open["main"])))
            if tag not in VOID and not m[4].endswith("/"):
                self.stack.append(len(self.tag) - 1)
                self.open[tag] += 1

    def _close(self, depth: int) -> None:
        for i in self.stack[depth:]:
            self.open[self.tag[i]] -= 1
        del self.stack[depth:]

    def _end(self, tags: frozenset[str], scope: frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` above ``scope``."""
        at = 0
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[depth]]
            if tag in scope:
                break
            if tag in tags:
                at = depth
        if at:
            self._close(at)

    def _counts(self, gone: list[bool]) -> tuple[list[int], list[int], list[int], list[int]]:
        """Characters, tags, link characters and link tags of every node's subtree, without what is gone."""
        parent, tag, n = self.parent, self.tag, len(self.tag)
        link = [False] * n
        for i in range(1, n):
            link[i] = link[parent[i]] or tag[i] == "a"
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for i, _, text in self.chunks:
            if not gone[i] and (size := len(" ".join(text.split()))):
                chars[i] += size
                if link[i]:
                    link_chars[i] += size
        for i in range(n - 1, 0, -1):
            if not gone[i]:
                p = parent[i]
                chars[p] += chars[i]
                link_chars[p] += link_chars[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + (tag[i] == "a")
        return chars, tags, link_chars, link_tags

    def _gone(self, holds: list[bool]) -> list[bool]:
        """What is cut before the densities: ``holds`` says which nodes hold an article or main element."""
        parent, tag, n = self.parent, self.tag, len(self.tag)
        gone = [False] * n
        for i in range(1, n):
            gone[i] = gone[parent[i]] or self.cut[i] == CUT
        chars, _, link_chars, link_tags = self._counts(gone)
        around = [0] * n  # the article, main or body element that a node is in
        for i in range(1, n):
            p = parent[i]
            around[i] = p if tag[p] in CONTAINERS or tag[p] == "body" else around[p]
            if gone[p]:
                gone[i] = True
            elif self.cut[i] >= NAMED and self.cut[i] != CUT and not holds[i]:
                most = self.cut[i] != NAMED and 2 * chars[i] > chars[around[i]]
                prose = self.cut[i] == NAMED_WEAKLY and chars[i] >= PROSE_CHARS and 2 * link_chars[i] < chars[i]
                gone[i] = not (most or prose)
            if tag[i] in LINK_BOXES and link_tags[i] >= LINKS and link_chars[i] >= LINK_SHARE * chars[i] and not holds[i]:
                gone[i] = True
        return gone

    def text(self) -> str:
        parent, tag, n = self.parent, self.tag, len(self.tag)
        holds = [t in CONTAINERS for t in tag]
        for i in range(n - 1, 0, -1):
            if holds[i]:
                holds[parent[i]] = True
        gone = self._gone(holds)
        chars, tags, link_chars, link_tags = self._counts(gone)
        body = tag.index("body") if "body" in tag else 0
        if not chars[body]:
            body = 0
        if not chars[0]:
            return ""
        share = link_chars[body] / max(1, chars[body])
        density = [_density(*x, share) for x in zip(chars, tags, link_chars, link_tags, strict=True)]
        total = [0.0] * n
        for i in range(1, n):
            if not gone[i]:
                total[parent[i]] += density[i]
        densest = list(range(n))  # of the subtree; the first node on ties
        for i in range(n - 1, 0, -1):
            p = parent[i]
            if not gone[i] and (total[densest[i]], -densest[i]) > (total[densest[p]], -densest[p]):
                densest[p] = densest[i]
        top = densest[body]
        path = [top]
        while path[-1] != body and path[-1] > 0:
            path.append(parent[path[-1]])
        container = next((i for t in ("article", "main") for i in reversed(path) if tag[i] == t), None)
        marked = [False] * n
        if container is not None:
            marked[container] = True
        else:
            least = min(density[i] for i in path)
            considered = [False] * n
            for i in range(body, n):
                if not gone[i] and (i == body or considered[parent[i]]) and density[i] >= least - 1e-9:
                    considered[i] = True
                    marked[densest[i]] = True
                elif not gone[i] and tag[i] in HEADINGS and considered[parent[i]]:
                    marked[i] = True  # titles are short, so their density says little
        for i in range(1, n):
            marked[i] = not gone[i] and (marked[i] or marked[parent[i]])
        blocks: dict[int, list[str]] = {}
        for i, block, text in self.chunks:
            if marked[i]:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def _density(chars: int, tags: int, link_chars: int, link_tags: int, body_share: float) -> float:
    if not chars:
        return 0.0
    tags = tags or 1
    base = math.log(chars / ((chars - link_chars) or 1) * link_chars + body_share * chars + math.e)
    spread = chars / (link_chars or 1) * tags / (link_tags or 1)
    # a page without links has base 1 everywhere: no adjustment there
    return chars / tags * math.log(spread) / (math.log(base) if base > 1 + 1e-12 else 1.0)


def main_text(source: str | None) -> str:
    """The article of one page, one block a line."""
    return Page(source).text() if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url`` and ``text`` for every page."""
    selected = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = StructType([*selected.schema.fields[:2], StructField("text", StringType(), False)])

    def make():
        return lambda ids, urls, sources: {"page_id": ids, "url": urls, "text": [main_text(s) for s in sources]}

    return map_texts(selected, make, schema, "page_id", "url", "html")

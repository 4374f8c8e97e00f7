"""HTML as a run of leaf blocks: text between two block boundaries, with the open tags around it.

Tags are read as the HTML standard's tokenizer does: a quote opens a value only after ``=``, and only its own kind closes
it.  Where the standard would drop the rest of a page as an unfinished tag, text is kept instead: a quote that nothing
closes belongs to an unquoted value, a tag that no ``>`` can end stops at the first ``>`` after its name, and a ``<``
with no ``>`` behind it is text.  Time and memory grow in proportion to the page, whatever its markup.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
SKIPPED = RAW | frozenset("head svg math object audio video canvas select datalist button".split())
# What a head can hold; any other opening tag, and text, ends an open head as </head> does.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend"}
# An opening tag ends an open one of these, up to the nearest holder.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

# White space of the standard's tokenizer; one attribute: its name and its quoted or bare value.
ATTRIBUTE = re.compile(r"""[ \t\n\f\r/]*+([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)[ \t\n\f\r]*+(?:=[ \t\n\f\r]*+(?:"([^"]*+)"|'([^']*+)'|([^ \t\n\f\r>]*+)))?""")
TAG_END = re.compile(r"[ \t\n\f\r/]*+>")
TAG_NAME = re.compile(r"[A-Za-z][^ \t\n\f\r/>]*+")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {tag: re.compile(rf"</{tag}(?=[ \t\n\f\r/>])[^>]*+>?", re.I) for tag in RAW}
# Python refuses to read a number of thousands of digits; none of that length names a character.
LONG_NUMBER = re.compile(r"&#0*+([0-9]{8,}+);?")


class Node:
    """An open tag; the tags around it are shared with its neighbours."""

    __slots__ = ("tag", "names", "parent", "first")

    def __init__(self, tag: str, names: str, parent: Node | None, first: bool):
        self.tag, self.names, self.parent = tag, names, parent  # names: class, id and role
        self.first = first  # no tag of this name around it


class Block(NamedTuple):
    text: str
    node: Node | None  # innermost open tag
    linked: int  # characters inside links

    @property
    def path(self) -> tuple[tuple[str, str], ...]:
        """(tag, its class, id and role), outermost first."""
        out, node = [], self.node
        while node:
            out.append((node.tag, node.names))
            node = node.parent
        return tuple(reversed(out))

    def __eq__(self, other):
        return (self.text, self.path, self.linked) == (other.text, other.path, other.linked)


def _plain(text: str) -> str:
    return html.unescape(LONG_NUMBER.sub("\ufffd", text))


class _Tags:
    """Where the tags of one page end, and the names in them."""

    def __init__(self, page: str):
        self.page = page
        self.dead: set[int] = set()  # places inside tags from where no end was found

    def read(self, at: int) -> tuple[int, str, bool]:
        """From the end of a tag's name: the end of the tag, its class, id and role, and whether it closes itself."""
        page = self.page
        first = page.index(">", at)
        if page.find("=", at, first) < 0:
            return first + 1, "", page[first - 1] == "/"
        names, seen, spot = {}, [], at
        while spot not in self.dead:
            seen.append(spot)
            m = ATTRIBUTE.match(page, spot)
            if m is None:
                end = TAG_END.match(page, spot)
                if end is None:
                    break
                return end.end(), " ".join(names.values()).lower(), end[0].endswith("/>")
            name = m[1].lower()
            if name in ("class", "id", "role"):
                names.setdefault(name, m[2] or m[3] or m[4] or "")
            spot = m.end()
        self.dead.update(seen)
        return first + 1, "", False


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order.  Text of scripts, styles, forms' choices and the head is no block."""
    page = page or ""
    out: list[Block] = []
    stack: list[Node] = []
    where: dict[str, list[int]] = {}  # places in the stack of each open tag
    open_blocks: list[int] = []  # places in the stack of the open block tags
    parts: list[str] = []
    linked: list[str] = []
    skipped = 0  # open tags whose text does not count
    tags = _Tags(page)

    def end_block():
        text = " ".join(_plain("".join(parts)).split()) if parts else ""
        if text:
            out.append(Block(text, stack[-1] if stack else None, len(_plain("".join(linked)).strip())))
        parts.clear()
        linked.clear()

    def innermost(*names):
        return max((where[t][-1] for t in names if where.get(t)), default=-1)

    def pop_to(index):
        nonlocal skipped
        while len(stack) > index:
            tag = stack.pop().tag
            where[tag].pop()
            skipped -= tag in SKIPPED
            if tag in BLOCK:
                open_blocks.pop()

    def end_head():
        end_block()
        pop_to(where["head"][0])

    def take(text):
        if where.get("head") and text.strip(" \t\n\f\r"):
            end_head()
        if not skipped:
            parts.append(text)
            if where.get("a"):
                linked.append(text)

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        start = page.find("<", at)
        if start < 0:
            take(page[at:])
            break
        if start > at:
            take(page[at:start])
        closing = page.startswith("/", start + 1)
        m = TAG_NAME.match(page, start + 1 + closing)
        if m is None:
            if page.startswith("<!--", start):
                at = start + 4
                if page.startswith((">", "->"), at):
                    at = page.index(">", at) + 1
                else:
                    end = COMMENT_END.search(page, at)
                    at = end.end() if end else n
            elif page.startswith(("<!", "<?"), start) or closing and start < last:
                end = page.find(">", start)
                at = end + 1 if end >= 0 else n
            else:
                take("<")
                at = start + 1
            continue
        if m.end() > last:
            take(page[start:])
            break
        at, names, alone = tags.read(m.end())
        tag = m[0].lower()
        if where.get("head") and (tag in ("body", "html", "br") if closing else tag not in IN_HEAD):
            end_head()
        if closing:
            if tag in BLOCK or tag in SKIPPED:
                end_block()
            if where.get(tag):
                pop_to(where[tag][-1])
            continue
        if tag in BLOCK:
            end_block()
            if tag in CLOSES_P and open_blocks and stack[open_blocks[-1]].tag == "p":
                pop_to(open_blocks[-1])
            if tag in ENDS:
                gone, holders = ENDS[tag]
                inner = innermost(*gone)
                if inner > innermost(*holders):
                    pop_to(inner)
        if tag in VOID:
            take(" ") if tag != "wbr" else None
            continue
        if alone and tag not in BLOCK and tag not in RAW and tag != "a":
            continue
        if tag in RAW:  # nothing inside is markup
            close = RAW_END[tag].search(page, at)
            at = close.end() if close else n
            continue
        places = where.setdefault(tag, [])
        if tag in BLOCK:
            open_blocks.append(len(stack))
        stack.append(Node(tag, names, stack[-1] if stack else None, not places))
        places.append(len(stack) - 1)
        skipped += tag in SKIPPED
    end_block()
    return out

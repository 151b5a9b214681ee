"""HTML as a tree of nodes with the text that belongs to each. Tolerates missing end tags, stray ones and cut-off pages."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass, field

# The HTML standard's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is not part of a page's text.
SILENT = frozenset("script style template noscript iframe textarea select button svg canvas audio video object title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul".split())
#: A start tag ends an open element of these kinds, looked for up to one of the boundary kinds.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
P_BOUNDARY = frozenset("td th table button html body caption".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?:(?P<attrs>(?:[^"'>]|"[^"]*"|'[^']*')*+)(?:>|\Z)|(?P<broken>[^>]*)(?:>|\Z))""",
    re.S,
)
NAMES = re.compile(r"""\b(?P<name>class|id|role|itemprop|aria-label|data-content|hidden|style)(?:\s*=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s"'>]+)))?""", re.I | re.S)
PART = re.compile(r"[a-z]{2,}")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Page:
    """Nodes in document order: parents come before children."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    names: list[tuple[str, ...]] = field(default_factory=list)
    mark: list[str | None] = field(default_factory=list)
    #: (node, block, text): texts with one block number stand in one block
    texts: list[tuple[int, int, str]] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)

    def add(self, tag: str, parent: int, names: tuple[str, ...], mark: str | None) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.names.append(names)
        self.mark.append(mark)
        for counts in (self.chars, self.links, self.stops):
            counts.append(0)
        return len(self.tag) - 1


def described(attrs: str) -> tuple[tuple[str, ...], str | None]:
    """Lower-case words of an element's class, id and role, and its ``data-content`` label."""
    words: dict[str, None] = {}
    mark = None
    for m in NAMES.finditer(attrs):
        name, value = m["name"].lower(), m["a"] or m["b"] or m["c"] or ""
        if name == "data-content":
            mark = value
        elif name == "hidden":
            words["hidden"] = None
        elif name == "style":
            if re.search(r"display\s*:\s*none", value):
                words["hidden"] = None
        else:
            words.update(dict.fromkeys(PART.findall(CAMEL.sub(" ", value).lower())))
    return tuple(words), mark


def parsed(source: str) -> Page:
    page = Page()
    page.add("#page", -1, (), None)
    stack: list[tuple[str, int, bool]] = [("#page", 0, False)]
    opened: Counter[str] = Counter()  # so that the stack is searched only for what it holds
    linked, block, at = False, 0, 0
    known: dict[str, tuple[tuple[str, ...], str | None]] = {"": ((), None)}

    def text(raw: str) -> None:
        if not raw or raw.isspace():
            if raw and page.texts and page.texts[-1][1] == block:
                page.texts.append((stack[-1][1], block, " "))
            return
        raw = references.unescape(raw) if "&" in raw else raw
        node, n = stack[-1][1], len(raw)
        page.texts.append((node, block, raw))
        page.chars[node] += n
        if linked:
            page.links[node] += n
        page.stops[node] += raw.count(". ") + raw.count("! ") + raw.count("? ") + (raw.rstrip()[-1:] in ".!?")

    def cut(to: int) -> None:
        """Close the elements from ``stack[to]`` on."""
        nonlocal linked, block
        if any(t not in INLINE for t, _, _ in stack[to:]):
            block += 1
        linked = stack[to][2]
        opened.subtract(t for t, _, _ in stack[to:])
        del stack[to:]

    size = len(source)
    while at < size:
        m = TOKEN.search(source, at)
        if m is None:
            rest = source[at:]
            lost = re.search(r"</?[A-Za-z][^<>]*\Z", rest)  # a tag that is cut off
            text(rest[: lost.start()] if lost else rest)
            break
        text(source[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        attrs = m["attrs"] if m["attrs"] is not None else m["broken"] or ""
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    cut(i)
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break  # does not reach beyond its block
            continue
        if tag in SILENT:
            if not attrs.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = end.end() if end else size if tag in ("script", "style", "textarea", "title") else at
            continue
        if tag == "br":
            page.texts.append((stack[-1][1], block, " "))
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1) if opened["p"] else ():
                if stack[i][0] == "p":
                    cut(i)
                    break
                if stack[i][0] in P_BOUNDARY:
                    break
        if tag in ENDS:
            ends, boundary = ENDS[tag]
            for i in range(len(stack) - 1, 0, -1) if any(opened[t] for t in ends) else ():
                if stack[i][0] in boundary:
                    break
                if stack[i][0] in ends:
                    cut(i)
                    break
        if tag in VOID:
            block += tag == "hr"
            continue
        names, mark = known.get(attrs) or known.setdefault(attrs, described(attrs))
        if tag in INLINE:
            node = stack[-1][1]
            if names or mark:
                node = page.add(tag, node, names, mark)
        else:
            block += 1
            node = page.add(tag, stack[-1][1], names, mark)
        if not attrs.rstrip().endswith("/") or tag not in INLINE:
            stack.append((tag, node, linked))
            opened[tag] += 1
        linked = linked or tag == "a"
    return page


def blocks(page: Page, content: list[bool]) -> str:
    """Text of the content nodes: white space within a block becomes one space, blocks are parted by an empty line."""
    out: list[str] = []
    pieces: list[str] = []
    current = -1
    for node, block, text in page.texts:
        if block != current:
            out.append(" ".join("".join(pieces).split()))
            pieces, current = [], block
        if content[node]:
            pieces.append(text)
    out.append(" ".join("".join(pieces).split()))
    return "\n\n".join(b for b in out if b)

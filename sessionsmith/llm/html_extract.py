"""Main text of web pages by a tree-structured graphical model.

Each DOM node is content or not. A node's own features, and the kinds of section that it lies in (by names, elements and
headings of what is around it), give it a potential, and a potential on every parent-child edge says how states go together, by the child's kind. Sum-product messages, first from the leaves up, then from the root down,
give each node's exact marginal; text of nodes that are probably content is the main text.

The weights maximise the likelihood of labelled pages; its gradient needs the same marginals. Labelled pages are drawn from
rules that lay out articles and what stands around them in many ways, and from a bounded sample of the pages at hand whose
own sectioning elements say where the article is.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches
from .dom import Page, blocks, parsed

#: Pages of the table that may be used for training, at most, and laid-out ones.
SAMPLE_PAGES = 200
MADE_PAGES = 500
ROUNDS = 120
#: Longer pages of the table aren't used for training.
SAMPLE_CHARS = 100_000
#: Text that a task has parsed at a time.
PART_CHARS = 2_000_000

# Words that pages commonly use in class names and ids.
AROUND = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip toolbar tabs".split(),
    "header": "header masthead topbar banner logo branding hero site-header page-header".split(),
    "footer": "footer copyright legal colophon site-footer bottom imprint".split(),
    "aside": "aside sidebar widget related recommended trending popular teaser secondary rail archive tags tagcloud".split(),
    "notice": "notice cookie consent gdpr alert popup modal overlay newsletter subscribe signup paywall privacy".split(),
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner-ad outbrain taboola".split(),
    "form": "form search login contact register searchform survey".split(),
    "share": "share social sharing follow author-box byline meta tools print".split(),
    "comments": "comments comment reply replies discussion respond disqus commentlist thread".split(),
}
MAIN = "content article post entry story main body text article-body post-content entry-content main-content page-content article-content blog-post".split()
OUTSIDE = frozenset("nav footer header aside form menu dialog".split())


GROUP_OF = {word: group for group, words in AROUND.items() for word in words}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Short texts that name what stands below them, or what they are themselves.
CUES = {
    "comments": re.compile(r"\b(\d+|no|leave a|post a|add a|reader) (comments?|repl(y|ies)|responses?)\b|^\s*(comments|discussion|responses)\b", re.I),
    "related": re.compile(r"^\s*(more|related|recommended|popular|trending|latest|most read|you may|see also)\b", re.I),
    "legal": re.compile(r"©|\(c\) \d{4}|\bcopyright\b|\ball rights reserved\b|\bprivacy policy\b|\bterms of (use|service)\b", re.I),
}
CUE_CHARS = 160


def settings(page: Page) -> list[tuple]:
    """Per node: kinds of section that it lies in, whether it is inside an article, and what its own short text says it is."""
    own: list[str] = [""] * len(page.tag)
    for node, _, text in page.texts:
        if len(own[node]) <= CUE_CHARS:
            own[node] += text
    cues = [next((name for name, cue in CUES.items() if cue.search(t)), "") if 0 < len(t) <= CUE_CHARS else "" for t in own]
    named: dict[int, str] = {}  # by a heading right below
    for i, tag in enumerate(page.tag):
        above = page.parent[i]
        if tag in HEADINGS and cues[i] in ("comments", "related") and above > 0 and page.tag[above] not in ("body", "html", "article", "main", "td"):
            named.setdefault(above, cues[i])
    out: list[tuple] = []
    for i, tag in enumerate(page.tag):
        inside, groups = out[page.parent[i]][:2] if i else (False, ())
        more = {GROUP_OF[w] for w in page.names[i] if w in GROUP_OF} | ({named[i]} if i in named else set())
        if tag in OUTSIDE:
            more.add(f"{tag} of article" if inside and tag in ("header", "footer") else tag)
        if more - set(groups):
            groups = tuple(sorted({*groups, *more}))
        out.append((inside or tag in ("article", "main"), groups, cues[i]))
    return out


def bucket(n: np.ndarray, most: int) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(n + 1)).astype(np.int64), most)


NUMERIC = {"own": 12, "subtree": 16, "own_links": 6, "subtree_links": 6, "stops": 4}


@dataclass
class Forest:
    """The nodes of many pages in a row."""

    parent: np.ndarray
    depth: np.ndarray
    static: list[tuple]  # (tag, parent's tag, names, inside an article, sections around, cue) of each node
    numeric: dict[str, np.ndarray]

    @staticmethod
    def of(pages: list[Page]) -> Forest:
        first = np.concatenate([[0], np.cumsum([len(p.tag) for p in pages])]).astype(np.int64)
        join = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
        own_parent, depth, chars, links, stops = (join(n) for n in ("parent", "depth", "chars", "links", "stops"))
        parent = np.where(own_parent < 0, -1, own_parent + np.repeat(first[:-1], np.diff(first)))
        under, under_links = chars.astype(np.float64), links.astype(np.float64)
        for own in levels(depth)[:0:-1]:
            np.add.at(under, parent[own], under[own])
            np.add.at(under_links, parent[own], under_links[own])
        share = lambda a, b: np.where(b > 0, 1 + np.ceil(np.divide(a, b, out=np.zeros(len(b)), where=b > 0) * 4), 0).astype(np.int64)
        numeric = {"own": bucket(chars, 11), "subtree": bucket(under, 15), "own_links": share(links, chars), "subtree_links": share(under_links, under), "stops": np.minimum(stops, 3)}
        static = [(p.tag[i], p.tag[p.parent[i]] if p.parent[i] >= 0 else "", p.names[i], *around) for p in pages for i, around in enumerate(settings(p))]
        return Forest(parent, depth, static, numeric)


def static_features(key: tuple) -> list[str]:
    tag, above, names, inside, groups, cue = key
    around = [f"under {g}" for g in groups] + ["under none"] * (not groups)
    return [f"tag {tag}", f"above {above}", f"pair {above} {tag}", f"tag {tag} inside {inside}", f"cue {cue}", f"cue {cue} {tag in HEADINGS}", *around, *(f"name {n}" for n in names)]


#: Kinds of edges, by the child.
KINDS = 3


def kind(key: tuple) -> int:
    """Of the edge to a node's parent: 2 to sections, 1 to nodes with names, 0 to others."""
    return 2 if key[0] in OUTSIDE or key[0] in ("article", "main", "section") else 1 if key[2] else 0


@dataclass
class Model:
    static: dict[str, float]
    numeric: dict[str, np.ndarray]
    edge: np.ndarray  # [kind, parent's state, child's state]

    def potentials(self, forest: Forest, known: dict[tuple, tuple[float, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Each node's log odds of being content by its own features, and the kind of the edge above it."""
        found = []
        for key in forest.static:
            got = known.get(key)
            if got is None:
                got = known[key] = sum(self.static.get(f, 0.0) for f in static_features(key)), kind(key)
            found.append(got)
        unary, kinds = np.array([f[0] for f in found]), np.array([f[1] for f in found], np.int64)
        for name, values in forest.numeric.items():
            unary = unary + self.numeric[name][values]
        return unary, kinds


def levels(depth: np.ndarray) -> list[np.ndarray]:
    """Nodes by depth."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []


def marginals(parent: np.ndarray, by_depth: list[np.ndarray], unary: np.ndarray, kinds: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of every node, and P(parent's state, own state) of every edge, by two passes of messages.

    A message has two numbers, one for each state of the node that gets it, as logarithms.
    """
    n = len(parent)
    belief = np.zeros((n, 2))  # own potential and messages from below
    belief[:, 1] = unary
    up = np.zeros((n, 2))
    for nodes in by_depth[:0:-1]:
        table = edge[kinds[nodes]] + belief[nodes][:, None, :]
        message = np.logaddexp(table[:, :, 0], table[:, :, 1])
        up[nodes] = message - message.max(axis=1, keepdims=True)
        np.add.at(belief, parent[nodes], up[nodes])
    total = belief.copy()
    joint = np.zeros((n, 2, 2))
    for nodes in by_depth[1:]:
        above = total[parent[nodes]] - up[nodes]  # all that the parent knows but from this child
        table = edge[kinds[nodes]] + above[:, :, None]
        message = np.logaddexp(table[:, 0, :], table[:, 1, :])
        total[nodes] = belief[nodes] + message - message.max(axis=1, keepdims=True)
        both = table + belief[nodes][:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        joint[nodes] = both / both.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -60, 60))), joint


def fit(pages: list[Page], labels: list[list[bool]], rounds: int = ROUNDS, ridge: float = 1e-3) -> Model:
    """Greatest likelihood of the labels, with a ridge penalty."""
    forest = Forest.of(pages)
    truth = np.array([x for page in labels for x in page], np.int64)
    kinds = np.array([kind(k) for k in forest.static], np.int64)
    names: dict[str, int] = {}
    rows, columns = [], []
    for i, key in enumerate(forest.static):
        for f in static_features(key):
            rows.append(i)
            columns.append(names.setdefault(f, len(names)))
    start = len(names)
    offsets = {}
    for name, size in NUMERIC.items():
        offsets[name] = start
        rows += range(len(truth))
        columns += (forest.numeric[name] + start).tolist()
        start += size + 1
    row, column = np.array(rows), np.array(columns)
    weights, edge = np.zeros(start), np.zeros((KINDS, 2, 2))
    by_depth, inner = levels(forest.depth), np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((KINDS, 2, 2))
    np.add.at(seen, (kinds[inner], truth[forest.parent[inner]], truth[inner]), 1)
    moment, square = np.zeros(start + edge.size), np.zeros(start + edge.size)
    n = len(pages)
    for k in range(1, rounds + 1):
        unary = np.bincount(row, weights[column], minlength=len(truth))
        p, joint = marginals(forest.parent, by_depth, unary, kinds, edge)
        expected = np.stack([joint[inner][kinds[inner] == c].sum(axis=0) for c in range(KINDS)])
        gradient = np.concatenate([np.bincount(column, (truth - p)[row], minlength=start) / n - ridge * weights, ((seen - expected) / n - ridge * edge).ravel()])
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        step = 0.1 * (moment / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.999**k)) + 1e-8)
        weights += step[:start]
        edge += step[start:].reshape(edge.shape)
    return Model({f: float(weights[i]) for f, i in names.items()}, {name: weights[o : o + NUMERIC[name] + 1] for name, o in offsets.items()}, edge)


def labelled_by_marks(page: Page) -> list[bool]:
    """Labels of a laid-out page: the nearest ``data-content`` above a node."""
    out: list[bool] = []
    for i in range(len(page.tag)):
        out.append(page.mark[i] == "1" if page.mark[i] else out[page.parent[i]] if i else True)
    return out


def labelled_by_sections(page: Page) -> list[bool] | None:
    """Labels of a page that has an article or main element: what is inside, but not in sections of other kinds in it, and what contains it. None for others."""
    if not any(t in ("article", "main") for t in page.tag):
        return None
    inside: list[bool] = []
    for i, tag in enumerate(page.tag):
        above = inside[page.parent[i]] if i else False
        inside.append((above or tag in ("article", "main")) and (tag not in OUTSIDE or tag == "header" and above) and not any(w in words for words in AROUND.values() for w in page.names[i]))
    for i in range(len(page.tag) - 1, 0, -1):
        if inside[i] and not page.chars[page.parent[i]]:
            inside[page.parent[i]] = True
    inside[0] = True
    return inside


def made_page(rng: random.Random) -> str:
    """A page laid out by rules; ``data-content`` says what is its main text."""

    def words(n: int) -> str:
        return " ".join("".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(1, 9))) for _ in range(n))

    def sentence(n: int) -> str:
        return words(n).capitalize() + rng.choice(["."] * 6 + ["!", "?", ""])

    def prose(n: int) -> str:
        parts = [sentence(rng.randint(3, 18)) for _ in range(n)]
        if rng.random() < 0.3:
            parts.insert(rng.randrange(len(parts) + 1), f'<a href="/x">{words(rng.randint(1, 5))}</a>')
        return " ".join(parts)

    def item(inner: str) -> str:
        return rng.choice([f"<p>{inner}</p>", f"<li>{inner}</li>", f"<div>{inner}</div>", f"{inner}<br>", f"<h3>{words(3)}</h3><p>{inner}</p>"])

    def legal() -> str:
        line = rng.choice(["Copyright {y} {w}. All rights reserved.", "&copy; {y} {w}", "&copy; {y} {w}. All rights reserved. <a href='/p'>Privacy policy</a> <a href='/t'>Terms of use</a>", "{w}. All rights reserved.", "(c) {y} {w}"])
        tag = rng.choice(["div", "p", "footer", "div"])
        return f'<{tag} data-content="0">{line.format(y=rng.randint(1999, 2030), w=words(2).title())}</{tag}>'

    def links(n: int) -> str:
        each = rng.choice(["{} ", "<li>{}</li>", "{} | ", "<div>{}</div>", "<span>{}</span> "])
        body = "".join(each.format(f'<a href="/x">{words(rng.randint(1, 4)).title()}</a>') for _ in range(n))
        return f"<ul>{body}</ul>" if "<li>" in body else body

    def remarks() -> str:
        """Reader comments, with names or without."""
        n = rng.randint(1, 6)
        head = rng.choice([f"{n} comments", f"{n} Comments", "Comments", f"{n} replies", "Leave a comment", f"{n} responses"])
        kind = rng.randrange(3)
        each = rng.choice(["<li><p>{}</p></li>", "<li><b>" + words(1) + "</b> {}</li>", "<li><div>" + words(2) + "</div><p>{}</p></li>"]) if kind < 2 else "<div><p>{}</p></div>"
        body = "".join(each.format(prose(rng.randint(1, 4))) for _ in range(n))
        body = f"<ol>{body}</ol>" if kind == 0 else f"<ul>{body}</ul>" if kind == 1 else body
        name = rng.choice(["", f' id="{rng.choice(AROUND["comments"])}"', f' class="{rng.choice(AROUND["comments"])}"'])
        tag = rng.choice(["section", "div"])
        return f'<{tag}{name} data-content="0"><h{rng.choice("234")}>{head}</h2>{body}</{tag}>'

    def around(what: str) -> str:
        if what == "comments" and rng.random() < 0.6:
            return remarks()
        if what == "footer" and rng.random() < 0.4:
            return legal()
        if what == "aside" and rng.random() < 0.3:
            head = rng.choice(["More stories", "Related", "Related articles", "Most read", "Recommended", "You may also like"])
            return f'<div data-content="0"><h3>{head}</h3>{links(rng.randint(2, 6))}</div>'
        if what == "nav" and rng.random() < 0.3:
            return f'<div data-content="0">{links(rng.randint(2, 8))}</div>'
        if what == "form":
            body = f"<label>{words(2)}</label> <input name=q> {words(rng.randint(0, 4))} <button>{words(1)}</button>" + (f"<p>{prose(1)}</p>" if rng.random() < 0.3 else "")
        elif what in ("nav", "share") or rng.random() < 0.3:
            body = "".join(rng.choice(["<li>{}</li>", "{} ", "<span>{}</span>", "<p>{}</p>"]).format(f'<a href="/x">{words(rng.randint(1, 4))}</a>') for _ in range(rng.randint(1, 9)))
            body = f"<ul>{body}</ul>" if rng.random() < 0.5 else body
        else:
            body = "".join(item(prose(rng.randint(1, 6))) for _ in range(rng.randint(1, 5)))
        if rng.random() < 0.2:
            body = f"&copy; {words(3)} &middot; {body}"
        if what in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5:
            name = f' class="{rng.choice(AROUND[what])}"' if rng.random() < 0.3 else ""
            return f'<{what}{name} data-content="0">{body}</{what}>'
        tag = rng.choice(["div", "div", "section", "ul" if what == "nav" else "div", "aside" if what in ("ad", "notice", "share") else "div"])
        name = rng.choice(AROUND[what]) + (f" {rng.choice(['', 'x', 'wide', 'js', 'main', 'box', 'list'])}-{rng.choice(['1', 'wrap', 'inner', 'top'])}" if rng.random() < 0.4 else "")
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{name}" data-content="0">{body}</{tag}>'

    def body_of_article() -> str:
        parts = [f"<h1>{words(rng.randint(2, 9))}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.randint(0 if parts else 1, 14)):
            kind = rng.random()
            if kind < 0.65:
                parts.append(f"<p>{prose(rng.choice([1, 1, 2, 3, 6, 12]))}" + rng.choice(["</p>", "</p>", ""]))
            elif kind < 0.7:
                parts.append(f"<p><b>{prose(rng.randint(1, 4))}<br>")
            elif kind < 0.78:
                parts.append(f"<h2>{words(rng.randint(1, 7))}</h2>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{prose(1)}</li>" for _ in range(rng.randint(1, 6))) + "</ul>")
            elif kind < 0.9:
                parts.append(f"<blockquote>{item(prose(2))}</blockquote>")
            elif kind < 0.93:
                parts.append("<table>" + "".join(f"<tr><td>{words(2)}</td><td>{words(1)}</td></tr>" for _ in range(rng.randint(1, 5))) + "</table>")
            elif kind < 0.96:
                parts.append(f"<pre>{words(9)}</pre>")
            else:
                parts.append(f"<figure><img src=a.png><figcaption>{prose(1)}</figcaption></figure>")
        if rng.random() < 0.35:
            parts.insert(rng.randrange(len(parts) + 1), around(rng.choice(["ad", "share", "aside", "notice", "form", "nav"])))
        if rng.random() < 0.25:
            parts.append(around("comments"))
        return "".join(parts)

    inner = body_of_article()
    shape = rng.random()
    if shape < 0.55 and inner.startswith("<h1>") and rng.random() < 0.4:  # the article's own header
        head, rest = inner.split("</h1>", 1)
        inner = f"<header>{head}</h1>{rng.choice(['', f'<p>By {words(2).title()}</p>', f'<p>{words(3)}</p><p>{words(2)}</p>', f'<div>By {words(1)}, {rng.randint(1990, 2030)}</div>'])}</header>{rest}"
    if shape > 0.93 and rng.random() < 0.6:
        cells = [f'<td data-content="1">{inner}</td>']
        if rng.random() < 0.8:
            cells.insert(0, f'<td data-content="0">{links(rng.randint(2, 8))}</td>')
        if rng.random() < 0.4:
            cells.append(f'<td data-content="0">{links(rng.randint(2, 8))}</td>')
        top = f'<tr><td colspan=2 data-content="0">{rng.choice([words(2), links(4)])}</td></tr>' if rng.random() < 0.4 else ""
        bottom = f"<tr><td colspan=2>{legal()}</td></tr>" if rng.random() < 0.4 else ""
        article = f"<table>{top}<tr>{''.join(cells)}</tr>{bottom}</table>"
    elif shape < 0.3:
        article = f'<article data-content="1">{inner}</article>'
    elif shape < 0.45:
        article = f'<main data-content="1">{inner}</main>'
    elif shape < 0.55:
        article = f'<main data-content="1"><article>{inner}</article></main>'
    elif shape < 0.85:
        article = f'<div {rng.choice(["class", "id"])}="{rng.choice(MAIN)}" data-content="1">{inner}</div>'
    elif shape < 0.92:
        article = f'<div data-content="1">{inner}</div>'
    else:
        article = f'<div class="{rng.choice(["wrap", "container", "row", "page"])}" data-content="1"><section>{inner}</section></div>'
    before = [around(k) for k in ("notice", "header", "nav", "ad") if rng.random() < 0.55]
    after = [around(k) for k in ("aside", "share", "comments", "ad", "form", "notice", "footer") if rng.random() < 0.4]
    wrap = rng.choice(["{}", "{}", '<div class="wrapper">{}</div>', '<div id="page"><div class="container">{}</div></div>'])
    page = f"<html><head><title>{words(4)}</title><style>p{{}}</style></head><body>{wrap.format(''.join([*before, article, *after]))}"
    return page + rng.choice(["</body></html>", ""])


def trained(samples: list[str], made: int = MADE_PAGES, seed: int = 11) -> Model:
    """The model of ``made`` laid-out pages and of those of ``samples`` whose sections label them."""
    rng = random.Random(seed)
    pages = [parsed(made_page(rng)) for _ in range(made)]
    labels = [labelled_by_marks(p) for p in pages]
    for source in samples:
        page = parsed(source)
        own = labelled_by_sections(page)
        if own is not None:
            pages.append(page)
            labels.append(own)
    return fit(pages, labels)


def extracted(sources: list[str], model: Model, known: dict) -> list[str]:
    """The main text of each page."""
    pages = [parsed(s) for s in sources]
    forest = Forest.of(pages)
    unary, kinds = model.potentials(forest, known)
    content = (marginals(forest.parent, levels(forest.depth), unary, kinds, model.edge)[0] > 0.5).tolist()
    out, at = [], 0
    for p in pages:
        out.append(blocks(p, content[at : at + len(p.tag)]))
        at += len(p.tag)
    return out


def main_text(pages: DataFrame, keep: list[str], html: str = "html", key: str = "page_id", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (its code points) of every row; the text is empty if nothing is content.

    A null page is an empty one. Rows that repeat are treated alike; other columns are not read; an empty table gives an
    empty one and trains on laid-out pages alone. At most ``sample_pages`` pages of fewer than ``SAMPLE_CHARS`` characters, those with the
    least hash of key and page, are read for training.
    """
    order = F.xxhash64(F.lit("html"), F.col(key), F.col(html))
    n = max(1, pages.count())
    few = pages.where(F.pmod(order, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * sample_pages / n)))
    samples = [r[0] for r in few.where(F.col(html).isNotNull() & (F.length(html) < SAMPLE_CHARS)).select(html).orderBy(order).limit(sample_pages).collect()]
    model = trained(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            sources = [s or "" for s in batch.column(len(keep)).to_pylist()]
            a, size = 0, 0
            for b in range(1, len(sources) + 1):
                size += len(sources[b - 1])
                if size >= PART_CHARS or b == len(sources):
                    if len(known) > 200_000:
                        known.clear()
                    texts = extracted(sources[a:b], model, known)
                    yield pa.record_batch([*(batch.column(i).slice(a, b - a) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])
                    a, size = b, 0

    schema = ", ".join([*(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep), "text string, n_chars bigint"])
    return in_batches(pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`")), run, schema)

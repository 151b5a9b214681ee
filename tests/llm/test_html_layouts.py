"""Pages written by hand, in layouts that the generator of training pages doesn't make: what must come out, and what must not."""

from __future__ import annotations

import pytest

from sessionsmith.llm import html_extract as H

P1 = "The river rose again on Tuesday night, and by the morning the lower fields were under water. Farmers moved what they could."
P2 = "Nobody had expected a third flood within one year. The council met at noon; its members agreed on little."
P3 = "Repairs to the old dam will start in May, if the money is found in time."
HEAD = "Third flood in a year"
ART = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
TEXT = "\n\n".join([P1, P2, P3])
FULL = f"{HEAD}\n\n{TEXT}"
NAV = "<ul><li><a href=/>Home</a></li><li><a href=/news>News</a></li><li><a href=/sport>Sport</a></li></ul>"
REMARK = "I live there and it was much worse than you write. Please come and see."
REMARKS = f"<ol><li><p>{REMARK}</p></li><li><p>My cellar is still wet. What will be done?</p></li><li><p>Thanks for the report!</p></li></ol>"
LEGAL = "Copyright 2024 The Valley Post. All rights reserved."


def page(body, head=""):
    return f"<!doctype html><html><head><title>The Valley Post</title>{head}</head><body>{body}</body></html>"


PAGES = {
    "comments in the article": (page(f"<article><h1>{HEAD}</h1>{ART}<section id='comments'><h2>3 comments</h2>{REMARKS}</section></article>"), FULL),
    "comments after the article": (page(f"<nav>{NAV}</nav><article><h1>{HEAD}</h1>{ART}</article><section id=comments><h2>3 comments</h2>{REMARKS}</section>"), FULL),
    "comments without names": (page(f"<main><h1>{HEAD}</h1>{ART}<section><h3>3 Comments</h3>{REMARKS}</section></main>"), FULL),
    "nested comment threads": (page(f"<article><h1>{HEAD}</h1>{ART}<div class=comment-list><div class=comment><p>{REMARK}</p><div class=comment><p>So do I, and I agree with all of it.</p></div></div></div></article>"), FULL),
    "discussion by id": (page(f"<div class=post><h1>{HEAD}</h1>{ART}</div><div id=disqus_thread><h3>Discussion</h3><div><p>{REMARK}</p></div></div>"), FULL),
    "respond form": (page(f"<article><h1>{HEAD}</h1>{ART}<div id=respond><h3>Leave a reply</h3><form><label>Name</label><input><textarea></textarea><button>Send</button></form></div></article>"), FULL),
    "plain divs, legal line": (page(f"<div>{NAV}</div><div><h1>{HEAD}</h1>{ART}</div><div>{LEGAL}</div>"), FULL),
    "legal paragraph": (page(f"<article><h1>{HEAD}</h1>{ART}</article><p>&copy; 2024 The Valley Post</p>"), FULL),
    "legal line with links": (page(f"<main><h1>{HEAD}</h1>{ART}</main><div><p>{LEGAL} <a href=/p>Privacy policy</a> <a href=/t>Terms of use</a></p></div>"), FULL),
    "table layout with a menu": (page(f"<table><tr><td><a href=/1>One</a> <a href=/2>Two</a></td><td><h1>{HEAD}</h1>{ART}</td></tr></table>"), FULL),
    "table layout, menu at the right": (page(f"<table width=100%><tr><td><h1>{HEAD}</h1>{ART}</td><td>{NAV}</td></tr></table>"), FULL),
    "table layout with a bottom row": (page(f"<table><tr><td>{NAV}</td><td><h1>{HEAD}</h1>{ART}</td></tr><tr><td colspan=2>{LEGAL}</td></tr></table>"), FULL),
    "own header with the author": (page(f"<header><a href=/>The Valley Post</a></header><article><header><h1>{HEAD}</h1><p>By Ann Miller</p></header>{ART}</article>"), f"{HEAD}\n\nBy Ann Miller\n\n{TEXT}"),
    "own header, main": (page(f"<header>{NAV}</header><main><article><header><h1>{HEAD}</h1></header>{ART}</article></main><footer>{LEGAL}</footer>"), FULL),
    "page header only": (page(f"<header><h2>The Valley Post</h2>{NAV}</header><div class=content><h1>{HEAD}</h1>{ART}</div>"), FULL),
    "cookie bar": (page(f"<div class=cookie-consent><p>We use cookies to make this site better.</p><button>OK</button></div><article><h1>{HEAD}</h1>{ART}</article>"), FULL),
    "dialog": (page(f"<article><h1>{HEAD}</h1>{ART}</article><dialog open><p>Subscribe now and read on for free.</p></dialog>"), FULL),
    "advert in the text": (page(f"<article><h1>{HEAD}</h1><p>{P1}</p><div class=advertisement><p>Buy one pump, get one free!</p></div><p>{P2}</p><p>{P3}</p></article>"), FULL),
    "more stories": (page(f"<article><h1>{HEAD}</h1>{ART}</article><div><h3>More stories</h3><ul><li><a href=/a>Dam repairs delayed</a></li><li><a href=/b>Mayor resigns</a></li></ul></div>"), FULL),
    "related inside the article": (page(f"<article><h1>{HEAD}</h1>{ART}<div class=related><h4>Related</h4><a href=/a>Dam repairs delayed</a></div></article>"), FULL),
    "share buttons": (page(f"<article><h1>{HEAD}</h1><div class=social-share><a href=/f>Share</a> <a href=/t>Post</a></div>{ART}</article>"), FULL),
    "breadcrumbs": (page(f"<div class=breadcrumbs><a href=/>Home</a> &gt; <a href=/n>News</a></div><div id=main-content><h1>{HEAD}</h1>{ART}</div>"), FULL),
    "sidebar first": (page(f"<div id=sidebar><h3>Weather</h3><p>Rain until Friday.</p></div><div id=content><h1>{HEAD}</h1>{ART}</div>"), FULL),
    "three columns": (page(f"<div class=row><aside>{NAV}</aside><main><h1>{HEAD}</h1>{ART}</main><aside><p>Rain until Friday.</p></aside></div>"), FULL),
    "deep wrappers": (page(f"<div><div><div class=wrapper><div><article><div><h1>{HEAD}</h1><div>{ART}</div></div></article></div></div></div></div><footer><p>{LEGAL}</p></footer>"), FULL),
    "subheads and a list": (page(f"<article><h1>{HEAD}</h1><p>{P1}</p><h2>What is known</h2><ul><li>Two roads are closed.</li><li>The school stays open.</li></ul><p>{P3}</p></article>"), f"{HEAD}\n\n{P1}\n\nWhat is known\n\nTwo roads are closed.\n\nThe school stays open.\n\n{P3}"),
    "quote": (page(f"<main><h1>{HEAD}</h1><p>{P1}</p><blockquote><p>We were lucky. Next time we may not be.</p></blockquote><p>{P2}</p></main><footer>{NAV}</footer>"), f"{HEAD}\n\n{P1}\n\nWe were lucky. Next time we may not be.\n\n{P2}"),
    "newsletter box": (page(f"<article><h1>{HEAD}</h1>{ART}<aside class=newsletter><p>Get our letter every morning.</p><form><input type=email><button>Go</button></form></aside></article>"), FULL),
    "search form": (page(f"<form action=/s><label>Search</label><input name=q></form><article><h1>{HEAD}</h1>{ART}</article>"), FULL),
    "skip link and menu": (page(f"<a class=skip href=#c>Skip to content</a><div role=navigation>{NAV}</div><div id=c class=article-body><h1>{HEAD}</h1>{ART}</div><div class=site-footer>{LEGAL}</div>"), FULL),
    "link in the text": (page(f"<nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1} <a href=/x>Read our first report</a> for more.</p><p>{P2}</p></article>"), f"{HEAD}\n\n{P1} Read our first report for more.\n\n{P2}"),
    "unclosed paragraphs": (page(f"<nav>{NAV}</nav><article><h1>{HEAD}</h1><p>{P1}<p>{P2}<p>{P3}</article><footer>{LEGAL}"), FULL),
}
#: The four cases in which an earlier model left its contract.
MUST = ["comments in the article", "plain divs, legal line", "table layout with a menu", "own header with the author"]


@pytest.fixture(scope="module")
def texts(spark):
    samples = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").limit(200).collect()]
    model = H.trained(samples)
    return dict(zip(PAGES, H.extracted([source for source, _ in PAGES.values()], model, {}), strict=True))


@pytest.mark.parametrize("name", MUST)
def test_contract(texts, name):
    assert texts[name] == PAGES[name][1]


def test_layouts(texts):
    wrong = [name for name, (_, want) in PAGES.items() if texts[name] != want]
    assert len(PAGES) >= 30 and len(wrong) <= 0.05 * len(PAGES), wrong


def test_no_comment_or_legal_line(texts):
    assert not any(REMARK in t or "rights reserved" in t for t in texts.values())

from __future__ import annotations

import itertools
import random
from difflib import SequenceMatcher

from lathework.llm import wrappers
from lathework.llm.markup import TOKEN
from lathework.llm.wrappers import Wrapper, expression, extract_text, infer, main_text

PAGE = """<!DOCTYPE html><html class="no-js sidebar"><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="content with-sidebar"><article><header><h1>Big &amp; small</h1></header>
<p>One  <b>two</b>&nbsp;three<br>four<p>Five &lt;six&gt; &eacute;&#x1D11E;
<ul><li>a<li>b</ul><div class="ad">Buy</div><form><label>Name</label><input></form>
<table><tr><td>c<td>d</table><!-- <p>no</p> --></article></div>
<aside>Side</aside><section id="comments"><p>First!</p></section><div class='cookie-notice'>OK?</div><footer>&copy; us</footer>"""


def alone(page):
    """Main text by the wrapper of the page alone."""
    return main_text(page, infer([page]))[0]


def test_page():
    assert alone(PAGE) == "Big & small\nOne two three four\nFive <six> é𝄞\na\nb\nc\nd"
    for odd in ("", "<", "<p", "<a b='", "</", "<!--", "<script>", "<p>x</div></p>y", "<div>" * 5000 + "x" + "</p>" * 5000):
        alone(odd)
        main_text(odd, None)
    assert alone("<p>x</div></p>y &amp z") == "x\ny & z"
    assert alone("just words") == "just words"
    assert main_text("<nav>Home</nav><p>x", None)[0] == "Home\nx"


def test_wrapper():
    """Repeats fold into groups, what only some pages have is optional, and a page outside the sample is covered."""
    assert expression(infer(["<p>a<p>b<p>c"]).root) == "p(#)+"
    assert expression(infer(["<dl><dt>a<dd>b<dd>c<dt>d<dd>e</dl>"]).root) == "dl((dt(#) dd(#)+)+)"
    assert expression(infer(["<h1>a</h1><p>b", "<h1>c</h1><ul><li>d<li>e</ul><p>f<p>g", "<p>h"]).root) == "h1(#)? ul(li(#)+)? p(#)+"
    page = "<body><div class=menu-box><a href=/>Go</a></div><div class=top>Hi</div><div class=text>{}</div><div class=low>Bye</div></body>"
    pages = [page.format("".join(f"<p>Some rather long text number {k} that goes on and on and on for a while.</p>" for k in range(n))) for n in (1, 3, 5)]
    w = infer(pages)
    assert expression(w.root) == "body(div.menu-box!1(#) div.top(#) div.text(p(#)+) div.low(#))"
    assert all(main_text(p, w)[1] for p in pages)
    assert main_text(page.format("<p>New.</p>"), w) == ("New.", True)
    assert main_text(page.format("<p>New.</p><table><td>x</table>"), w) == ("New.\nx", False)
    assert main_text(page.format("<p>New.</p>"), Wrapper.load(w.dump())) == ("New.", True)


def test_marks_around_the_whole_page_tell_nothing():
    """A form or a class name that holds most of what fills the slots is not beside the article."""
    page = "<form><div class=sidebar-layout><p>Story {0} is told here at some length, as stories are.</p></div><div class=promo>Buy {0}</div></form>"
    assert main_text(page.format(1), infer([page.format(k) for k in range(4)]))[0] == "Story 1 is told here at some length, as stories are."


def template_texts(pages):
    """By brute force: texts at a place that the full alignment of the flat token streams gives all pages alike."""
    flat = []
    for page in pages:
        found = [(m.group(0), False) if not m.group(6) else (" ".join(m.group(6).split()), True) for m in TOKEN.finditer(page)]
        flat.append([x for x in found if x[0]])
    common = {i for i in range(len(flat[0]))}
    for other in flat[1:]:
        common &= {i for a, _, n in SequenceMatcher(None, flat[0], other, autojunk=False).get_matching_blocks() for i in range(a, a + n)}
    return {flat[0][i][0] for i in common if flat[0][i][1]}


def test_against_full_alignment():
    """Generated hosts with class names that say nothing: all stays but what the full alignment has on all pages."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijkl") for _ in range(n))
    for _ in range(25):
        names = [word(6) for _ in range(6)]
        menu = "".join(f"<li><a href=/{k}>{word(5)} {k}</a></li>" for k in range(rng.randint(2, 6)))
        low = f"<div class={names[0]}><span class={names[1]}>{word(9)}</span> all of {word(4)}</div>"
        serial = itertools.count()
        pages, wanted = [], []
        for _ in range(6):
            own = []

            def said(n, own=own):
                own.append(" ".join([f"{word(7)}{next(serial)}", *(word(5) for _ in range(n))]))
                return own[-1]

            body = f"<h2>{said(4)}</h2>" + "".join(f"<p>{said(rng.randint(15, 40))}</p>" for _ in range(rng.randint(2, 7)))
            if rng.random() < 0.5:
                body += f"<table><tr><td>{said(2)}</td><td>{said(2)}</td></tr></table>"
            body += "".join(f"<dl><dt>{said(1)}</dt><dd>{said(6)}</dd></dl>" for _ in range(rng.randint(0, 3)))
            pages.append(f"<html><body><div class={names[2]}><ul>{menu}</ul></div><div class={names[3]}><b>{names[4]} site</b></div><div class={names[5]}>{body}</div>{low}</body></html>")
            wanted.append("\n".join(own))
        w = infer(pages)
        gone = template_texts(pages)
        assert gone and not any(x in gone for text in wanted for x in text.split("\n"))
        for page, text in zip(pages, wanted, strict=True):
            assert main_text(page, w) == (text, True)
            assert main_text(page, None)[0] != text


def test_query(spark):
    rows = [(1, "http://a.b/c", PAGE), (2, "http://a.b/d", None), (3, None, ""), (4, "odd", "<article>x</article>"), (1, "http://a.b/c", PAGE), (None, "http://z", "<p>" + "y " * 70000)]
    d = spark.createDataFrame([(*r, "") for r in rows], "page_id long, url string, html string, text string")
    got = extract_text(d).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text[:11] for r in got} == {1: "Big & small", 2: "", 3: "", 4: "x", None: "y y y y y y"}
    assert extract_text(d.limit(0)).count() == 0


def test_words_of_ids_and_other_attributes_drop_nothing():
    page = """<article><h2 id='related-work'>Related</h2><section id='side-effects'><p>Nausea</p></section><section id="search-algorithms">Halving</section>
<div data-class="ad" data-id=share title="class=ad">Data</div><div class="skip-list reply-tree">Lists</div><div class="share">Tweet</div><div role=search>Find</div></article>"""
    assert alone(page) == "Related\nNausea\nHalving\nData\nLists"
    assert alone("<div><h2 id=related-work>Related</h2><section id=search-algorithms>Halving</section><section id=comments>First!</section></div>") == "Related\nHalving"


def test_all_slots_of_a_host_stay():
    """Blocks beside the largest one hold main text too; only what is the same on all pages of the sample goes."""
    page = "<body><div class=top>Our site</div><div class=lead>Lead {0} of a few words.</div><div class=body><p>" + "Body {0} of rather more words than the lead has, and so on. " * 5 + "</p></div><div class=low>Bye</div></body>"
    pages = [page.format(f"n{k}") for k in range(4)]
    w = infer(pages)
    for k, p in enumerate(pages):
        text = main_text(p, w)[0].split("\n")
        assert text[0] == f"Lead n{k} of a few words." and text[1].startswith(f"Body n{k}") and len(text) == 2
    other = main_text("<body><div class=top>Our site</div><div class=body>B</div><div class=extra>Not in the sample</div></body>", w)[0]
    assert other == "B\nNot in the sample"
    copies = ["<body><div class=text>" + "The same article. " * 20 + f"</div><div class=low>{k}</div></body>" for k in range(4)]
    assert main_text(copies[0], infer(copies))[0].startswith("The same article.")


def test_template_text_inside_an_article_goes():
    page = "<article><div>Read this on our site</div><p>Story {0} tells of things that no other story does.</p><p>Common words</p><div>Sent from {0}</div></article>"
    pages = [page.format(f"n{k}") for k in range(4)]
    w = infer(pages)
    assert main_text(pages[1], w)[0] == "Story n1 tells of things that no other story does.\nSent from n1"
    assert main_text("<article><div>Another notice</div><p>Common words</p></article>", w)[0] == "Another notice"
    assert main_text("<article><p>Common words</p></article>", w)[0] == "Common words"
    copies = ["<article><p>" + "The same article. " * 20 + f"</p><p>{k}</p></article>" for k in range(4)]
    assert main_text(copies[0], infer(copies))[0].startswith("The same article.")


def host_of(n):
    """Pages of one host, of which every thirteenth lacks what the others share, and every fifth has a table."""
    low = "<div class=low>Read more on our site</div>"
    page = "<body><div class=text><h2>Title {0}</h2>{1}</div>{2}</body>"
    body = "<p>Story {0}.{1} tells of things that no other story does.</p>"
    return [page.format(k, "".join(body.format(k, i) for i in range(1 + k % 4)) + (f"<table><tr><td>Cell {k}</table>" if k % 5 == 0 else ""), low if k % 13 else "") for k in range(n)]


def test_all_pages_of_a_host_count(spark, monkeypatch):
    """Neither ids nor a few pages unlike the rest decide what is the template's; merged in steps and joined by host alike."""
    pages = host_of(40)
    w = infer(pages)
    wanted = {p: main_text(p, w) for p in pages}
    assert not any("Read more" in text for text, _ in wanted.values()) and all(whole for _, whole in wanted.values())
    for start, fan, most in ((0, 64, 16 << 20), (1000, 64, 16 << 20), (2000, 3, 16 << 20), (3000, 64, -1)):
        monkeypatch.setattr(wrappers, "FAN", fan)
        monkeypatch.setattr(wrappers, "BROADCAST_BYTES", most)
        d = spark.createDataFrame([(start + k, f"http://a.b/{k}", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
        got = {pages[r.page_id - start]: (r.text, r.covered) for r in extract_text(d).collect()}
        assert got == wanted


def test_a_text_of_most_pages_is_no_literal():
    """What four of five pages share stays, though any eight pages may all have it; what all share goes."""
    pages = [p.replace("<h2>", "<div class=kind>News</div><h2>" if k % 5 else "<div class=kind>Sport</div><h2>") for k, p in enumerate(host_of(40))]
    w = infer(pages)
    assert [main_text(p, w)[0].split("\n")[0] for p in pages] == ["News" if k % 5 else "Sport" for k in range(40)]


def test_wrapper_beyond_its_bound_keeps_what_most_pages_have(monkeypatch):
    """Nodes of single pages are left out first, and their texts stay, also in a form around the whole page."""
    monkeypatch.setattr(wrappers, "MOST_NODES", 40)
    pages = [p.replace("<table>", f"<section class=s{k}>Own {k}</section><table>").replace("<body>", "<body><form>") for k, p in enumerate(host_of(200))]
    w = infer(pages)
    assert len(w.nodes) <= 60 and any(not main_text(p, w)[1] for p in pages)
    for k in (0, 5, 199):
        text = main_text(pages[k], w)[0]
        assert f"Story {k}.0" in text and "Read more" not in text and (k % 5 > 0 or f"Own {k}" in text)


def test_groups_in_groups_are_not_doubled_at_every_level():
    """The stream that stands for a wrapper grows with the square of its nested groups, not by powers of two."""
    node = wrappers.Node("x")
    for k in range(14):
        node = wrappers.Node(wrappers.GROUP, kids=[wrappers.Node(f"y{k}"), node], repeated=True)
    assert len(wrappers.stream_of([node], 1)) == 1 + sum(range(2, 16)) + 14
    dl = "<dl><dt>a<dd>b<dd>c<dt>d<dd>e</dl>"
    assert expression(infer([dl, dl.replace("<dl>", "<h2>f</h2><dl>")]).root) == "h2(#)? dl((dt(#) dd(#)+)+)"

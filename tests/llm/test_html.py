"""Main text: given pages against their article element, and hand-made pages."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pytest

from tripweave.llm import html
from tripweave.llm.common import ready, table

SF = "/root/testdata/sf0.01"


def article_text(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = re.split(r"<(?:br|/?p|/?h1|/?table|/?td|/?tr|/?ul|/?li|/?div)\b[^>]*>", inner)
    plain = [" ".join(unescape(re.sub(r"</?(?:b|i|a|span)\b[^>]*>", "", b)).split()) for b in blocks]
    return " ".join(b for b in plain if b)


def test_given_pages(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    out = html.op2_html_extraction(spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        assert r["text"] == (article_text(pages[r["page_id"]]) if pages[r["page_id"]] else "")
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>hi", "hi"), ("< 3 <b", "< 3 <b"), ("<!-- x", ""), ("<script>a</scr", ""),
    ("<div><p>Alpha beta, gamma.</p><p>More words, here.</p></div><div class='notice'>We use cookies, ok?</div><ul class=menu><li><a href=x>Home</a></ul>",
     "Alpha beta, gamma. More words, here."),
    ("<body><div id=main><h1>T</h1><p>A b, c. D &amp; e&nbsp;f.</p>t <b>bo</b>ld<table><tr><td>a<td>b</table><p>z</p></div>"
     "<section class='user-comments'><p>Nice, really, I like. It. so. much!</p></section><aside><p>Side, text.</p></aside>"
     "<form><label>Name, mail.</label></form></body>", "T A b, c. D & e f. t bold a b z"),
    ("<article><p>Text <!-- no --> one.<br>Two <script>var x = '</p>';</script>three.</article><footer>&copy; me</footer>", "Text one. Two three."),
    ("<ARTICLE><P>A<SPAN>b</SPAN>  c<P>D</ARTICLE>", "Ab c D"),
    ("<main><p>&lt;p&gt; &#x41;&eacute;</p></main>", "<p> Aé"),
    ("<article><p>A text, here.</p><ul><li><a href=x>Source one, the paper</a></li><li>See also the manual <a href=y>\n      &quot;here&quot;\n    </a></li></ul></article>",
     'A text, here. Source one, the paper See also the manual "here"'),
    ("<article><h2 id=discussion>Discussion</h2><p id=related>It goes on, and ends.</p></article>", "Discussion It goes on, and ends."),
    ("<article><p>Before, then<svg width=1><p>after, too.</p></article>", "Before, then after, too."),
    ("<div class=notice>We use cookies, ok?</div>", ""),
    ('<a href="#">hello</a>', ""), ("<b>bold</b>", "bold"), ("<body><nav>menu</nav></body><a href=x>ad</a>", ""),
    ("<html><body><p>A text, in one line.</p></body></html><a href=x>more</a>", "A text, in one line."),
])
def test_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("wrong", ["constant", "random", "turned"])
def test_scores_choose(spark, monkeypatch, wrong):
    """With other scores the given pages come out differently."""
    pages = [r["html"] for r in table(spark, SF, "pages").collect() if r["html"]]
    real, pick = html.path_scores, np.random.default_rng(1)
    make = {
        "constant": lambda b: np.ones(len(b)), "random": lambda b: pick.random(len(b)),
        "turned": lambda b: 1 / (real(b) + 1e-6),
    }
    right = [html.main_text(p) for p in pages]
    monkeypatch.setattr(html, "path_scores", make[wrong])
    assert sum(html.main_text(p) == text for p, text in zip(pages, right)) < 0.1 * len(pages)


def test_pages_without_marks(spark):
    """Every element a div without attributes: the ratios alone still find most of the text and little else."""
    pages = [r["html"] for r in table(spark, SF, "pages").collect() if r["html"]]
    found = wanted = both = 0
    for page in pages:
        bare = re.sub(r"<(/?)(?:nav|header|footer|aside|article|section|main|ul|li|form)\b[^>]*>", r"<\1div>", page)
        bare = re.sub(r"\s(?:class|id)=(?:\"[^\"]*\"|\S+?)(?=[\s>])", "", bare)
        got, want = Counter(html.main_text(bare).split()), Counter(article_text(page).split())
        found, wanted, both = found + got.total(), wanted + want.total(), both + (got & want).total()
    assert both >= 0.99 * wanted and both >= 0.95 * found


@pytest.mark.parametrize("times", [1, 20, 400])
def test_lead_and_title_of_long_pages(times):
    body = "<p>The text goes on, line by line, to its end. It says more, then less.</p>" * times
    text = " ".join(["The text goes on, line by line, to its end. It says more, then less."] * times)
    lead = "A lead, in short, that says what follows. It ends here, now, too."
    page = f"<body><div class=lead><p>{lead}</p></div><div class=text>{body}</div></body>"
    assert html.main_text(page) == f"{lead} {text}"
    page = f"<body><h1>Title</h1><div class=lead><p>{lead}</p></div><h2>Part</h2><div class=body>{body}</div></body>"
    assert html.main_text(page) == f"Title {lead} Part {text}"
    assert html.main_text(f"<body><h1>Title</h1><div class=body>{body}</div></body>") == f"Title {text}"


def test_edge_cases(spark):
    ready(spark)
    pages = spark.createDataFrame([(None, None, 5, "a"), (1, "<p>x</p>" * 20_000, 6, "b"), (1, "<p>y", 7, "c"), (1, "<p>y", 7, "c")], "page_id long, html string, n_chars int, Text string")
    out = html.extract(pages)
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in out.collect()) == [0, 1, 1, 39_999]
    assert html.extract(pages.limit(0)).count() == 0
    assert html.main_text("<div>" * 3_000 + "deep" + "</div>" * 3_000) == "deep"

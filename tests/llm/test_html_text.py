from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm.html_text import extract_main_text, main_text, op7_html_text, smooth
from tests.llm.samples import clashing

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; co</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body><header><h2>Site</h2></header><nav><ul><li><a href="/x">x</a></li></ul></nav><!-- ad --><div class="ad">Buy now</div>
<article><h1>T &amp; co</h1><p><b>First   line &lt;here&gt;.<br><p>Second&nbsp;one.</p><p>Be.</p><aside>related</aside>
<form><p>name</p></form><p class="notice">cookies</p><ul><li>one<li>two</ul><section class="comments"><p>nice!</p></section></article>
<div id="sidebar"><p>A long text beside the article that is no part of it at all, with many words.</p></div>
<footer>&copy; site</footer></body></html>"""


def test_article_without_boilerplate():
    assert main_text(PAGE) == "T & co\nFirst line <here>.\nSecond one.\nBe.\none\ntwo"


def test_pages_without_article():
    page = ('<body><div class="top"><a>a</a> <a>b</a> <a>c</a></div><div class="content"><h1>Head</h1><p>'
            + "A long paragraph of the text. " * 5 + "</p><p>Short.</p></div><div><a>x</a> <a>y</a></div></body>")
    assert main_text(page) == "Head\n" + ("A long paragraph of the text. " * 5).strip() + "\nShort."


LONG = [f"Paragraph {i} " + "of the long text of this page. " * 4 for i in range(5)]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in LONG)
TEXT = "\n".join(p.strip() for p in LONG)


def test_main_keeps_headline_and_intro_around_the_article():
    page = f"<body><main><h1>Head</h1><p>Intro.</p><article>{PARAGRAPHS}<p>End.</p></article></main><div>Imprint</div></body>"
    assert main_text(page) == f"Head\nIntro.\n{TEXT}\nEnd."
    page = f"<body><div><a>x</a> <a>y</a></div><div><h1>Head</h1><p>Intro.</p><article>{PARAGRAPHS}</article></div></body>"
    assert main_text(page) == f"Head\nIntro.\n{TEXT}"


def test_a_teaser_article_does_not_replace_the_text():
    card = '<article class="card"><h3><a href="/o">Other</a></h3><p>Teaser.</p></article>'
    text = f'<div class="content"><h1>Head</h1>{PARAGRAPHS}<p>Short.</p></div>'
    for page in (text + card, card + text, f"<main>{text}{card}</main>"):
        assert main_text(f"<body>{page}</body>") == f"Head\n{TEXT}\nShort."


SHORT = "<h2>End</h2><p>Short closing.</p>"
LINKS = '<ul><li><a href="/a">a</a></li><li><a href="/b">b</a></li></ul>'


def test_sectioned_pages():
    for tag in ("section", "div"):
        parts = f"<{tag}>{PARAGRAPHS}</{tag}><{tag}>{SHORT}</{tag}>"
        for page in (parts, f"<div class=content>{parts}</div>", f"<div>{LINKS}</div><div>{parts}</div><div>{LINKS}</div>"):
            assert main_text(f"<body>{page}</body>") == f"{TEXT}\nEnd\nShort closing."


def test_parts_of_the_text_container_and_table_cells():
    for page in (f"<div>{PARAGRAPHS}<div>{SHORT}</div></div>", f"<div>{PARAGRAPHS}<div>{LINKS}</div><div>{SHORT}</div></div>",
                 f"<table><tr><td>{LINKS}</td><td>{PARAGRAPHS}</td></tr><tr><td>{SHORT}</td></tr></table>"):
        assert main_text(f"<body><div>{LINKS}</div>{page}</body>") == f"{TEXT}\nEnd\nShort closing."


def test_two_articles():
    for page in (f"<article>{PARAGRAPHS}</article><article>{SHORT}</article>",
                 f"<div>{LINKS}</div><article>{PARAGRAPHS}</article><div><p>Posted.</p></div><article>{SHORT}</article>"):
        assert main_text(f"<body>{page}</body>") == f"{TEXT}\nEnd\nShort closing."
    again = PARAGRAPHS.replace("Paragraph", "Passage")
    assert main_text(f"<body><article>{PARAGRAPHS}</article>{LINKS}<article>{again}</article></body>") == f"{TEXT}\n" + TEXT.replace("Paragraph", "Passage")


def test_names_of_wrappers_do_not_remove_the_article():
    article = f"<article><h1>Head</h1>{PARAGRAPHS}<p>End.</p></article>"
    own = article.replace("<article>", "<article class='post related-topics'>")
    side = "<div class='sidebar'><p>A text beside it.</p></div>"
    for open_, close in (("<div class='layout has-sidebar'>", "</div>"), ("<div class='page with-header'>", "</div>"), ("<form id='aspnetForm'>", "</form>"),
                         ("<div class='sidebar-layout'>", "</div>"), ("<div class='widget'>", "</div>"), ("<div id='header-and-body'><form>", "</form></div>")):
        for inside in (article, own):
            assert main_text(f"<body>{open_}{inside}{side}{close}</body>") == f"Head\n{TEXT}\nEnd."


def test_names_of_headings_and_paragraphs_inside_the_article():
    page = f"<article><h1>Head</h1>{PARAGRAPHS}<h2 id='sharing'>Sharing</h2><p id='comment-1'>First.</p><h2 id='login'>Login</h2><p>Last.</p></article>"
    assert main_text(f"<body>{page}</body>") == f"Head\n{TEXT}\nSharing\nFirst.\nLogin\nLast."


def test_reader_comments_go_however_long_they_are():
    comments = "".join(f"<li>Comment {i} " + "a long opinion of a reader. " * 9 + "</li>" for i in range(40))
    for thread in (f"<section id='discussion'><ul>{comments}</ul></section>", f"<ol class='thread'>{comments}</ol>", f"<div class='post-comments'>{comments}</div>"):
        assert main_text(f"<body><article>{PARAGRAPHS}</article>{thread}</body>") == TEXT
    assert main_text(f"<body><article>{PARAGRAPHS}<ol class='thread'>{comments}</ol></article></body>") == TEXT
    paper = f"<article>{PARAGRAPHS}<section id='discussion'><h2>Discussion</h2><p>We conclude.</p></section></article>"
    assert main_text(f"<body>{paper}</body>") == f"{TEXT}\nDiscussion\nWe conclude."


def test_boxes_stay_out_of_short_pages():
    box = "<div class='cookie-banner'><p>" + "We use cookies and so on, as you like. " * 2 + "</p></div>"
    side = "<div class='sidebar'><p>" + "Words beside the text that are not of it. " * 30 + "</p></div>"
    text = "A short page, whose only text is this one sentence."
    assert main_text(f"<body>{box}<article><p>{text}</p></article>{side}<form><p>Name</p></form></body>") == text
    assert main_text(f"<body>{side}</body>") == ""


def test_copyright_line_ends_the_text():
    assert main_text(f"<body><div>{PARAGRAPHS}</div><div>Copyright 2020 Example</div></body>") == TEXT


def test_deeply_nested_containers():
    assert main_text("<div>" * 3000 + "<p>x</p>" + "</div>" * 3000) == "x"


def test_broken_pages():
    assert main_text("") == "" and main_text("<html><body></body></html>") == "" and main_text("plain  text") == "plain text"
    assert main_text("<article><p>a &am") == "a &am" and main_text("<article><p>a<!-- open") == "a"
    assert main_text("<article><p>a</p><p cla") == "a" and main_text("<article><p>a < b") == "a < b"
    assert main_text("<article></p></div><p>x</article></article>") == "x"
    deep = "<article>" + "<b>" * 3000 + "x" + "</p>" * 3000
    assert main_text(deep) == "x"


def test_feeding_in_pieces_changes_nothing():
    body = "<p>" + "word &amp; " * 30000 + "</p>"
    assert main_text(f"<article>{body}</article>") == ("word & " * 30000).strip()


def test_smoothing():
    assert np.allclose(smooth(np.full(7, 3.0)), 3.0) and len(smooth(np.array([1.0]))) == 1


def test_query_and_edge_tables(spark):
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", "")], "page_id bigint, url string, html string")
    out = op7_html_text(df).collect()
    assert [(r.page_id, r.n_chars) for r in out] == [(1, len(main_text(PAGE)))] * 2 + [(2, 0), (3, 0)] and out[2].text == ""
    assert op7_html_text(df.limit(0)).collect() == []
    wide = clashing(df)
    assert extract_main_text(wide).where(F.col("main_text") == "main_text").count() == 4

import html
import re

import pyarrow.parquet as pq
from helpers import rows

from cityviews.llm.html_text import extract_pages, main_text

BODY = "<p>" + "Some words of text. " * 20 + "</p><p>" + "More &amp; more words. " * 15 + "</p>"
TEXT = ("Some words of text. " * 20 + "More & more words. " * 15).strip()


def test_boilerplate_goes():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p>b{{}}</style></head><body class="comments-open">
    <header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav><div id="sidebar-left">Side</div>
    <div class="cookie-notice">We use cookies</div><script>if (a < b) "</p>";</script><!-- <p>no</p> -->
    <article><h1>Title</h1>{BODY}<div class="ad">Buy</div><form><p>Mail</p></form></article>
    <section class="comments"><p>Nice one, {"really " * 200}</p></section><footer>End &copy;</footer></body></html>"""
    assert main_text(page) == "Title " + TEXT


def test_density_alone_finds_the_text():
    links = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(40))
    page = f"<html><body><div><ul>{links}</ul></div><div><div>{BODY}</div></div><div><a href=x>x</a></div></body></html>"
    assert main_text(page) == TEXT


def test_inline_tags_and_white_space():
    page = "<article><p>A<b>B</b>\n\t C&nbsp;D<br>E<p>F<i>G <p>H</article>"
    assert main_text(page) == "AB C D E FG H"


def test_broken_pages_do_not_crash():
    assert main_text(None) == main_text("") == main_text("<div") == main_text("<!-- x") == ""
    assert main_text("a < b & c &lt; d") == "a < b & c < d"
    assert main_text('<p title="a>b">t</p>') == "t"
    assert main_text("</p></div></table>x</b>") == "x"
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text('<a b="' * 20_000) == ""
    assert len(main_text("<p>" + "word " * 400_000)) == 5 * 400_000 - 1


def test_table_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    data = [(1, "u", "<p>x y</p>", "t", "n"), (1, "u", "<p>x y</p>", "t", "n"), (None, None, None, None, None)]
    got = rows(extract_pages(spark.createDataFrame(data, schema)))
    assert got == sorted([(1, "u", "x y", 3)] * 2 + [(None, None, "", 0)], key=repr)
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0


def test_pages_by_brute_force():
    """These pages mark their article; a few expressions are enough to cut it out."""
    for page in pq.read_table("/root/testdata/sf0.001/pages.parquet")["html"].to_pylist():
        part = re.search(r"<article>(.*?)(</article>|<footer>)", page, re.S)[1]
        part = re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", part))
        assert main_text(page) == " ".join(html.unescape(part).split())


def test_names_that_deny_or_wrap_keep_their_text():
    for wrap in ('<div class="content has-sidebar">', '<div class="post no-comments">', '<div class="layout-with-nav">',
                 '<div class="ad-free">', "<form>", '<div class="page-widget">', '<div id="adsFree" class="noSidebar">'):
        tag = wrap[1:].split()[0].rstrip(">")
        assert main_text(f"<html><body>{wrap}<h1>Title</h1>{BODY}</{tag}></body></html>") == "Title " + TEXT
        assert main_text(f"<html><body><div>{wrap}<h1>Title</h1><div>{BODY}</div></{tag}></div>"
                         "<div>short note</div></body></html>") == "Title " + TEXT


def test_density_decides_every_page():
    """Without their marks, pages give the same text; a wrapper and a long advert change nothing."""
    for page in pq.read_table("/root/testdata/sf0.1/pages.parquet")["html"].to_pylist():
        text = main_text(page)
        bare = page.replace("<article", "<div").replace("</article", "</div")
        assert main_text(bare) == text
        part = re.search(r"<article>(.*?)(</article>|<footer>)", page, re.S)[1]
        part = re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", part))
        assert text == " ".join(html.unescape(part).split())

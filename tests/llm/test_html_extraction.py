from __future__ import annotations

import html
import re

from orefold.llm import html_extraction as h

LONG = "The first paragraph of the story is about a man and his dog, and it is long enough to be judged by the rules."


def test_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in h.extract(pages).collect()}
    for r in pages.collect():
        a = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)>", " ", a))).split())
        assert got[r.page_id] == (want, len(want))


def test_furniture_goes_and_short_blocks_follow_their_neighbours():
    page = f"""<html><head><title>t</title><style>p{{}}</style></head><body class="has-sidebar"><header><nav><a href=1>Home</a></nav></header>
    <div class="cookie-notice">{LONG}</div><div><h1>Big &amp; title</h1><p>{LONG}</p><p>Short one.</p><div id="advert-2">{LONG}</div><p>{LONG}&nbsp;<b>b</b>old</p><form>x</form></div>
    <div style="display: none">{LONG}</div><section id="comments"><article><p>{LONG}</p></article></section><aside>{LONG}</aside><script>var x = "<p>no</p>";</script><footer>&copy; us</footer></body>"""
    assert h.main_text(page) == f"Big & title {LONG} Short one. {LONG} bold"


def test_broken_and_odd_pages(spark):
    assert h.main_text(None) == "" and h.main_text("") == ""
    assert h.main_text("<p>a<p>b<br>c") == "a b c"
    assert h.main_text("<div>" * 5000 + "x" + "<a href='unclosed") .startswith("x")
    assert h.main_text("<nav>menu</nav>") == ""
    assert h.main_text(f"<nav>menu<article><p>{LONG}</article>") == LONG
    df = spark.createDataFrame([(1, None, "u", 3), (1, f"<p>{LONG}</p>", "u", 4)], "page_id long, html string, text string, n_chars int")
    assert sorted((r.text, r.n_chars) for r in h.extract(df).collect()) == [("", 0), (LONG, len(LONG))]
    assert h.extract(df.limit(0)).count() == 0


def test_unlisted_languages_and_tables_without_an_article_are_kept():
    russian = "Утром старый рыбак вышел на берег и долго смотрел на море, потому что лодка его сына ещё не вернулась домой."
    polish = "Stary rybak wyszedł rankiem nad brzeg morza, ponieważ łódka jego syna jeszcze nie wróciła z nocnego połowu ryb."
    chinese = "清晨，老渔夫走到海边，久久地望着大海，因为他儿子的小船还没有回来。" * 3
    table = "1999 34.5 12.8 77.1 2000 35.9 13.0 78.4 2001 36.2 13.3 79.9 2002 37.8 14.1 81.0 2003 38.8 14.9"
    links = "<div><a href=1>Раздел первый</a> <a href=2>Раздел второй</a></div>"
    for text in (russian, polish, chinese, table):
        assert h.main_text(f"<html><body><div>{links}<p>{text}</p><p>Да.</p></div></body></html>") == f"{text} Да."
    assert h.main_text(f"<div>{links}<p>清晨，老渔夫走到海边。</p></div>") == "清晨，老渔夫走到海边。"
    # an English notice beside it does not make another script bad
    assert h.main_text(f"<div><p>{LONG}</p><p>{russian}</p></div>") == f"{LONG} {russian}"
    assert h.main_text(f"<div>{links}</div>") == ""


def test_names_have_a_vote_only():
    body = f"<h1>A title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p>"
    want = f"A title {LONG} Short one. {LONG}"
    for wrapper in ("class=no-sidebar", 'id="popular-science"', 'class="header"', 'class="site comments-open"', "class=widget", 'class="post legal"'):
        assert h.main_text(f"<html><body><nav>Home</nav><div {wrapper}>{body}</div><footer>us</footer></body></html>") == want, wrapper
    # of several elements the one with little goes
    assert h.main_text(f'<div class="content">{body}</div><div class="sidebar"><p>{LONG}</p></div><div class="cookie-notice">{LONG}</div>') == want


def test_nothing_of_an_article_is_lost():
    links = "".join(f'<a href="{i}">see the chapter {i}</a> ' for i in range(6))
    plain = " ".join(f"see the chapter {i}" for i in range(6))
    page = f'<article><h2 class="alert">A warning</h2><p>{LONG}</p><div class="social"><p>{LONG}</p></div><p>{links}</p><section id="popular"><p>{LONG}</p></section></article>'
    assert h.main_text(page) == f"A warning {LONG} {LONG} {plain} {LONG}"
    page = f'<article><p>{LONG}</p><div class="share-links"><a href=1>Send this page</a> <a href=2>Print this page</a></div><div class="advert">{LONG}</div><div id="comments"><p>{LONG}</p></div><p>{LONG}</p></article>'
    assert h.main_text(page) == f"{LONG} {LONG}"

import html
import re

import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import tag_paths as T

ARTICLE = [
    "A Heading Without Stop",
    "The first paragraph is long enough to count, with commas, and it goes on; it ends here. " * 3,
    "Short one.",
    "Another long paragraph follows & says more: things, other things, and the rest of it. " * 4,
]


def _page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p {{ }}</style></head><body>{body}</body></html>"


def _paragraphs():
    return f"<h1>{ARTICLE[0]}</h1>" + "".join(f"<p>{html.escape(x)}</p>" for x in ARTICLE[1:])


WANT = "\n\n".join(x.strip() for x in ARTICLE)
NOISE = """<header><a href=/>Site</a> A slogan, with signs.</header>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies, as all do. Accept?</div><script>var x = "</p><p>no";</script>"""
TAIL = """<aside><p>Related: a long teaser text, with commas, and more; read on.</p></aside>
<form><label>Your name</label><input name=a><textarea>typed</textarea></form>
<section id="comments"><p>I like this article, really, it is good. Thanks!</p></section>
<div class='ad'>Buy this now, it is cheap!</div><noscript>No script.</noscript><footer>&copy; 2020, me.</footer>"""


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class=post>{}</div>", "<div><div>{}</div></div>"])
def test_only_the_article(wrap):
    assert T.main_text(_page(NOISE + wrap.format(_paragraphs()) + TAIL)) == WANT


def test_comments_and_forms_inside_the_article():
    inner = _paragraphs() + '<div class="comments"><p>Nice, thanks.</p></div><form>Reply</form>'
    assert T.main_text(_page(NOISE + f"<article>{inner}</article>" + TAIL)) == WANT


def test_broken_markup():
    broken = f"<article><h1>{ARTICLE[0]}</h1><p><b>{ARTICLE[1]}<br><p>{ARTICLE[2]}<p>{html.escape(ARTICLE[3])}</article>"
    assert T.main_text("<html><body>" + NOISE + broken + "<footer>&copy; cut") == WANT
    for odd in ("", None, "<", "<p", "<!--", "<script>", "</p></div>", "<p class='", "&amp", "<<<>>>", "<p>" * 2000):
        T.main_text(odd)


def test_white_space_and_references():
    page = "<article><p> a\n\tb<br>c&nbsp;d &lt;e&gt; &#233;<i>f</i>, <a href=x>g</a>.</p><p></p><ul><li>one,<li>two.</ul></article>"
    assert T.main_text(page) == "a b c d <e> éf, g.\n\none,\n\ntwo."


def _template(page):
    """The article of the given pages, cut out by their own template."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    found = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", inner))
    return "\n\n".join(x for x in found if x)


def test_given_pages_with_and_without_the_article_element(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {r.page_id: _template(r.html) for r in df.collect()}
    got = T.extract(df).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    plain = df.selectExpr("page_id", "url", "regexp_replace(html, '(</?)article', '$1div') AS html")
    assert {r.page_id: r.text for r in T.extract(plain).collect()} == want


def test_nulls_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    df = spark.createDataFrame([(1, None, None, 5, "x"), (None, "u", "", 5, "x"), (2, "u", "<p>a, b.</p>", 5, "x"), (2, "u", "<p>a, b.</p>", 5, "x")], schema)
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in T.extract(df).collect())
    assert got == [(0, "", 0), (1, "", 0), (2, "a, b.", 5), (2, "a, b.", 5)]
    assert T.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("wrap", [
    '<div class="overflow-hidden">{}</div>', '<div style="overflow:hidden">{}</div>', '<div title="Hidden gems">{}</div>', '<div data-hidden-id="3">{}</div>',
    '<article class="no-sidebar">{}</article>', '<div id="main" class="with-sidebar comments-open">{}</div>', "<form action=x><div>{}</div></form>",
    '<div class="widget"><main>{}</main></div>', '<div class="modal">{}</div>', "<div hidden>{}</div>", '<section class="related comments">{}</section>'])
def test_words_in_attributes_of_a_wrapper(wrap):
    assert T.main_text(_page(wrap.format(_paragraphs()))) == WANT
    assert T.main_text(_page(NOISE + wrap.format(_paragraphs()) + TAIL)) == WANT


def test_headings_with_the_words_of_a_menu():
    body = _paragraphs() + '<h2 id="related-work">Related work</h2><h2 id="comments">Comments</h2>'
    assert T.main_text(_page(NOISE + f"<article>{body}</article>" + TAIL)) == WANT + "\n\nRelated work\n\nComments"


@pytest.mark.parametrize("noise", ["<div hidden>Not, seen.</div>", "<div style='color:red; display:none'>Not, seen.</div>", "<div class=siteNav>A, b.</div>",
                                   "<div class='x share-buttons'>Share, this.</div>", "<ol class=comment-list><li>Nice, thanks.</ol>", "<div id=comment_form_12>Say, it.</div>"])
def test_marked_elements_go(noise):
    assert T.main_text(_page(f"<div>{_paragraphs()}</div>{noise}")) == WANT
    assert T.main_text(_page(f"<article>{_paragraphs()}{noise}</article>")) == WANT


def test_comments_in_code():
    assert T.main_text('<div><pre>x = 1  <span class="comment"># one, and more.</span></pre></div>') == "x = 1 # one, and more."


def test_long_comments_stay_out():
    said = "<article class=comment-body><p>I like this, really, it is good, and so on. Thanks!</p></article>" * 40
    assert T.main_text(_page(f"<div>{_paragraphs()}</div><div id=comments>{said}</div>")) == WANT


LONG = "x" * 60 + ", " + "some words that go on, and on; " * 14
EXTRAS = {
    "list": ("<ul>" + "".join(f"<li>item {i:06d}</li>" for i in range(20)) + "</ul>", [f"item {i:06d}" for i in range(20)]),
    "table": ("<table>" + "".join(f"<tr><td>key{i}<td>{i}</tr>" for i in range(15)) + "</table>", [x for i in range(15) for x in (f"key{i}", str(i))]),
    "code": ("<pre>x = 1 <span class='comment'># one</span></pre>", ["x = 1 # one"]),
    "link": ("<p><a href=x>A paper on stones</a></p>", ["A paper on stones"]),
    "references": ("<ol><li>Sea 1999: <a href=x>On the wind and the river, a study</a></li><li>Old: <a href=y>Of stones and houses</a></li></ol>",
                   ["Sea 1999: On the wind and the river, a study", "Old: Of stones and houses"]),
    "headings": ("<h3>Next</h3><h4>More</h4>", ["Next", "More"]),
}


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><div>{}</div></main>", "<div class=post>{}</div>", "<table><tr><td>{}</td></tr></table>"])
@pytest.mark.parametrize("extra", EXTRAS)
def test_parts_of_an_article(wrap, extra):
    markup, texts = EXTRAS[extra]
    body = "<h1>Title</h1>" + f"<p>{LONG}</p>" * 6 + markup + f"<p>{LONG}</p>" * 2
    want = ["Title", *[LONG.strip()] * 6, *texts, *[LONG.strip()] * 2]
    assert T.main_text(_page(NOISE + wrap.format(body) + TAIL)).split("\n\n") == want


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
@pytest.mark.parametrize("menu", ["<ul><li><a href=a>Home</a><li><a href=b>About us</a></ul>", "<p><a href=a>Back</a> | <a href=b>Next</a></p>"])
def test_menus_in_an_article_go(wrap, menu):
    assert T.main_text(_page(NOISE + wrap.format(_paragraphs() + menu) + TAIL)) == WANT


def test_a_boxed_table_between_paragraphs():
    markup, texts = EXTRAS["table"]
    page = f"<div><h1>Title</h1><p>{LONG}</p><div class=scroll>{markup}</div><p>{LONG}</p></div><div><ul>{'<li>Other' * 20}</ul></div>"
    assert T.main_text(_page(page)).split("\n\n") == ["Title", LONG.strip(), *texts, LONG.strip()]


SIX = [f"Paragraph {i}: {LONG.strip()}" for i in range(6)]
CARDS = "<article><h3>Other story</h3><p>Teaser.</p></article><article><h3>Third</h3><p>Teaser 2.</p></article>"


def test_teaser_cards_do_not_replace_the_article():
    body = "<div class=story>" + "".join(f"<p>{x}</p>" for x in SIX) + "</div>"
    for page in (body + CARDS, CARDS + body):
        got = T.main_text(_page(page)).split("\n\n")
        assert [x for x in got if x in SIX] == SIX


def test_the_article_in_main_leaves_other_stories_out():
    page = "<main><article>" + "".join(f"<p>{x}</p>" for x in SIX) + f"</article><section class='more-stories'>{CARDS}</section></main>"
    assert T.main_text(_page(page)).split("\n\n") == SIX


def test_text_after_the_article_element_stays():
    page = "<article>" + "".join(f"<p>{x}</p>" for x in SIX[:4]) + "</article><div>" + "".join(f"<p>{x}</p>" for x in SIX[4:]) + "</div>"
    assert T.main_text(_page(page)).split("\n\n") == SIX


@pytest.mark.parametrize("tag", ["<p title=it's>", '<p class="a"">', "<p class='a''>", '<p title="a > b">', "<p don't>", '<p data-x = "1" y=\'2\'>', "<p a=b\"c>"])
def test_stray_quotes(tag):
    rest = [x.replace("that", "don't") for x in SIX[1:]]
    page = f"<article><h1>T</h1>{tag}{SIX[0]}</p>" + "".join(f"<p>{x}</p>" for x in rest) + "</article>"
    assert T.main_text(_page(page)).split("\n\n") == ["T", SIX[0], *rest]


@pytest.mark.parametrize("unit", ["<div>", "<div>text, here. ", "<b>x</i>", "<p><b><ul><li>y", "<table><tr><td>z", "</div>", "<a href='", "<form><p>w"])
def test_deep_and_unclosed_markup_is_linear(unit):
    import time
    import tracemalloc
    page = "".join(f"<p>{x}</p>" for x in SIX) + unit * 100_000
    t = time.process_time()
    T.main_text(page)
    assert time.process_time() - t < 20
    tracemalloc.start()
    T.main_text("".join(f"<p>{x}</p>" for x in SIX) + unit * 20_000)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_levels_beyond_the_deepest_close_again():
    page = "<div>" * 1000 + "<p>" + SIX[0] + "</p>" + "</div>" * 1000 + "".join(f"<p>{x}</p>" for x in SIX[1:])
    assert T.main_text(page).split("\n\n") == SIX
    blocks = T.blocks_of("<div>" * 1000 + "a" + "</div>" * 1000 + "<p>b")
    assert [(b.text, b.path.tag) for b in blocks] == [("a", "div"), ("b", "p")]


def _plain_ratios(blocks):
    """The fused ratios by lists and numpy, without the operator's helpers."""
    import numpy as np
    paths = [b.path for b in blocks]
    own = {p: [b for b in blocks if b.path is p] for p in set(paths)}
    length = np.array([sum(len(b.text) - b.linked for b in own[p]) / len(own[p]) for p in paths])
    signs = np.array([sum(sum(c in ".,;:!?…。，！？、" for c in b.text) for b in own[p] if b.linked < len(b.text)) / len(own[p]) for p in paths])

    def smooth(v):
        out = []
        for i in range(len(v)):
            j = np.arange(max(0, i - 2), min(len(v), i + 3))
            k = np.exp(-((j - i) ** 2) / (2 * T.SIGMA ** 2))
            out.append((k * v[j]).sum() / k.sum())
        return np.array(out)

    fused = np.sqrt(smooth(length) * (smooth(signs) + 0.05))
    return {p: np.mean([f for f, q in zip(fused, paths) if q is p]) for p in own}


def test_ratios_against_a_plain_version(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").limit(40).collect()
    for page in [r.html for r in rows] + [_page(NOISE + _paragraphs() + TAIL), "", "<p>x"]:
        blocks = T.unmarked(T.blocks_of(page))
        want = _plain_ratios(blocks)
        got = T.content_paths(blocks)
        assert set(got) == set(want) and all(got[p] == pytest.approx(want[p]) for p in got)

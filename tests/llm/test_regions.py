import html
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from flowlab.llm.queries import QUERIES
from flowlab.llm.regions import best_region, extracted, learned_weights, log_odds, main_text, tokens

SF_DIR = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x:y}</style><script>var t="</p><article>";</script></head><body class="menu">
<nav><ul><li><a href="/a>b">Home</a></li></ul></nav><div class="cookie-notice">We use cookies &amp; more of the same words here.</div>
<form><article><h1>Title &amp;
 more</h1><p>One <b>two</b>three<br>four<p>Five &lt;six&gt; &eacute; &#233; a < b<!-- no > --><div class="ad">Buy now</div>
<ul><li>first of all the points<li><a href=x>second</a></ul><aside>side</aside><script>if (a<b) "</p>"</script><p>  </p><section id="userComments"><p>great post</p></section>
<p>Last words that end the article.</p></article></form><footer>Some words of the footer that go on and on and on and on</footer></body></html>"""
TEXT = "Title & more\nOne twothree four\nFive <six> é é a < b\nfirst of all the points\nsecond\nLast words that end the article."


def prior():
    return log_odds({})


def test_page_with_every_part(spark):
    for weights in (prior(), learned_weights(spark.read.parquet(f"{SF_DIR}/pages.parquet"))):
        assert main_text(PAGE, weights) == TEXT


def test_without_content_element():
    page = PAGE.replace("<article>", "<div>").replace("</article>", "</div>").replace("<form>", "<div>").replace("</form>", "</div>")
    assert main_text(page, prior()) == TEXT


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain words only", "plain words only"), ("<nav>menu</nav>", ""), ("<p>a</p><p cla", "a"), ("<p>a <!-- open", "a"),
    ("<p>" + "word " * 100_000, ("word " * 100_000).strip()), ("<script>x", ""), ("<p>a &am", "a &am"), ("</p></p>", ""), ("<p a=\"b>c</p>", "c"),
])
def test_edges(page, text):
    assert main_text(page, prior()) == text


POST = "<h1>A title</h1><p>Some words of the post that go on for a while.</p><p>More of its words, to the end.</p>"
POSTED = "A title\nSome words of the post that go on for a while.\nMore of its words, to the end."
AROUND = "<nav><a href=/>Home</a></nav>{}<footer>Some footer</footer>"


@pytest.mark.parametrize("page,text", [
    (f"<form id=aspnetForm><div class=post>{POST}</div></form>", POSTED),
    (f"<div class='layout has-sidebar'>{POST}<div class=sidebar><a href=/a>one</a> <a href=/b>two</a></div></div>", POSTED),
    (f"<div class='no-sidebar'><div class=post>{POST}</div></div>", POSTED),
    (f"<div class='layout has-sidebar'><article>{POST}</article></div>", POSTED),
    (f"<fieldset>{POST}</fieldset>", POSTED),
    (f"<article>{POST}<div class=alert>Mind the gap.</div><p>The last of its words.</p></article>", f"{POSTED}\nMind the gap.\nThe last of its words."),
    (f"<article><header><p>First of all.</p></header>{POST}</article>", f"First of all.\n{POSTED}"),
    (f"<div>{POST}<div class=related><a href=/a>one other post</a></div><p>The last of its words.</p></div>", f"{POSTED}\nThe last of its words."),
    (f"<div>{POST}</div><div class=comments>" + "<p>some reader's words</p>" * 9 + "</div>", POSTED),
])
def test_frame_words_around_and_in_a_post(page, text):
    assert main_text(AROUND.format(page), prior()) == text


WORDS60 = "Some words of the post that go on for a while. " * 6
SIXTY = WORDS60.strip()


@pytest.mark.parametrize("page,text", [
    (f"<div class='promo-free'>{WORDS60}</div>" * 2, f"{SIXTY}\n{SIXTY}"),
    (f"<section class=modal-article>{WORDS60}</section>" * 3, f"{SIXTY}\n{SIXTY}\n{SIXTY}"),
    (f"<div class='post comments-enabled'><p>{WORDS60}</p></div><div><p>Some other words.</p></div>", f"{SIXTY}\nSome other words."),
    (f"<div><p>{WORDS60}</p><p title='the hidden valley'>Of a valley.</p><p data-x=hidden>And more.</p></div>", f"{SIXTY}\nOf a valley.\nAnd more."),
    (f"<div><p>{WORDS60}</p><p hidden>Not seen.</p><p style='color:red; display : none'>Nor seen.</p><p>The end of it.</p></div>", f"{SIXTY}\nThe end of it."),
    (f"<div><p>{WORDS60}</p><p aria-hidden='true'>Not seen.</p><p class=ad-slot>Buy it now.</p><p>The end of it.</p></div>", f"{SIXTY}\nThe end of it."),
])
def test_names_of_states_and_texts_are_no_frame_parts(page, text):
    assert main_text(AROUND.format(page), prior()) == text


def test_end_tags_of_nothing_take_linear_time():
    start = time.monotonic()
    assert main_text("<div>" * 100_000 + "</b>" * 100_000 + "<p>ok</p>", prior()) == "ok"
    assert main_text("<p>ok</p>" + "</b>" * 100_000, prior()) == "ok"
    assert time.monotonic() - start < 20


def test_a_wrapper_in_content_leaves_it_content():
    found = [t for t in tokens(f"<main><div class=has-sidebar>{POST}</div></main>") if t.words]
    assert all(t.content and not t.frame for t in found)


@pytest.mark.parametrize("raw", ["<svg/>", "<svg width=1 />", "<math/>", "<svg><path/></svg>"])
def test_a_self_closed_raw_element_hides_nothing(raw):
    assert main_text(f"<article><p>a</p>{raw}<p>b</p></article>", prior()) == "a\nb"


def test_unclosed_quotes_take_linear_time():
    assert main_text("<p>ok</p>" + "<a href=\"x" * 20_000, prior()) == "ok"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-3, 3), max_size=12))
def test_best_region_is_best(scores):
    runs = [(sum(scores[i:j]), -i, -j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    top = max(runs, default=(0, 0, 0))
    start, stop = best_region(scores)
    assert sum(scores[start:stop]) == max(0, top[0])
    if top[0] > 0:
        assert (top[0], -start, -stop) in runs


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("<>/!-pabr =\"'&;\n"), max_size=60))
def test_any_markup(page):
    list(tokens(page))
    main_text(page, prior())


def test_whole_table(spark):
    """The pages mark their article, so a plain cut by patterns gives what the region must hold."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op6_main_text"](spark, SF_DIR).collect()}
    assert len(got) == len(pages)
    for r in pages:
        body = r.html[r.html.find("<article>") + 9:r.html.find("</article>")].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)>", re.sub("</?b>", "", body))
        text = "\n".join(y for y in (" ".join(html.unescape(x).split()) for x in blocks) if y)
        assert got[r.page_id].text == text and got[r.page_id].n_chars == len(text) and got[r.page_id].url == r.url


def test_tables(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None)], "page_id long, url string, html string").selectExpr("*", "1 as text")
    got = sorted((r.page_id or 0, r.text) for r in extracted(pages, learned_weights(pages)).collect())
    assert got == [(0, ""), (1, TEXT), (1, TEXT)]
    assert extracted(pages.limit(0), learned_weights(pages.limit(0))).count() == 0

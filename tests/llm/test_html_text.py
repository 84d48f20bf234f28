import html as H
import re
import time

import pytest

from drivelake.llm import html_text, queries


def article_of(page):
    """The text of a page of the test tables, which mark the article."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    return "\n".join(x for x in (re.sub(r"\s+", " ", H.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)))).strip() for b in blocks) if x)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.QUERIES["op3_html_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article_of(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


P = "This is a sentence of the story, long enough to count as text of the article. "
CASES = [
    ("", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b", "a\nb"),
    (f"<div class='menu'><a href=x>Home</a></div><div id=main><h2>T</h2><p>{P*3}<p>{P*2}<i>x</i></div><div class=sidebar><p>{P*2}</div>", f"T\n{(P*3).strip()}\n{P*2}x"),
    (f"<header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>{P}</p><form><p>{P}</p></form><section id='comments'><p>{P*9}</p></section></main>", f"Title\n{P.strip()}"),
    (f"<article><p>{P}<script>if (a</p>) '<p>'</script></p><!-- <p>no</p> --><aside>{P}</aside><ul><li>one<li>two</ul></article><footer>{P}</footer>", f"{P.strip()}\none\ntwo"),
    (f"<ul><li><a href=a>{P}</a><li><a href=b>{P}</a></ul><div><div><p>{P*2}</p><p>{P*2}</p></div></div>", "\n".join([(P * 2).strip()] * 2)),
    ("<article><p title=\"a>b\">x &lt;b&gt; &#x41;&nbsp;  \n y<br>z</p><div class='cookie-notice'>We use cookies</div><div hidden>h</div></article>", "x <b> A y z"),
    ("<p>unclosed <b>bold <p>next</b> <!-- open", "unclosed bold\nnext"), ("<div " + "'" * 2001 + "a" * 50, "<div " + "'" * 2001 + "a" * 50), ("</p></div>x", "x"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_cases(page, text):
    assert html_text.extract(page) == text


def test_odd_rows(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [(1, "u", deep, 1), (None, None, None, None), (2, None, "<p>x</p>" * 20_000, 2), (2, None, "<p>x</p>" * 20_000, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.n_chars, r.text[:4]) for r in html_text.main_texts(pages).collect())
    assert got == [(0, 0, ""), (1, 4, "deep"), (2, 39_999, "x\nx\n"), (2, 39_999, "x\nx\n")]
    assert html_text.main_texts(pages.limit(0)).count() == 0


LEGAL = [
    (f"<html><head><title>T</title><meta charset=utf-8><body><p>{P}</p>", P.strip()), (f"<head><title>T</title><p>{P}</p>", P.strip()), (f"<head><title>T</title>{P}", P.strip()),
    (f"<article><p>{P}<svg width='1'/>{P}</p><math/><p>{P}</p></article>", f"{P}{P.strip()}\n{P.strip()}"), (f"<article><p>{P}</p><iframe src=x><p>{P}</p></article>", f"{P.strip()}\n{P.strip()}"),
    (f"<article><p>{P}<math><mi>x</mi><mo>=</mo><mn>2</mn></math></p><xmp>a <b> &amp; c</xmp></article>", f"{P}x=2\na <b> &amp; c"),
    (f"<article><p>{P}</p><script>if (a) '<p>no</p>'", P.strip()), (f"<article><p>{P}</p><svg><text>no</text></svg></article>", P.strip()),
]


@pytest.mark.parametrize("page, text", LEGAL)
def test_legal_pages_without_end_tags(page, text):
    assert html_text.extract(page) == text


SLUGS = ["side-effects", "related-work", "search-algorithm", "share-prices", "social-history"]
MENU = "<a href=a>One</a> <a href=b>Two</a>"


@pytest.mark.parametrize("slug", [*SLUGS, "search", "tags"])
def test_ids_made_from_headings_stay(slug):
    assert html_text.extract(f"<article><p>{P}</p><section id={slug}><h2 id={slug}>T</h2><p id={slug}>{P}</p></section></article>") == f"{P.strip()}\nT\n{P.strip()}"


@pytest.mark.parametrize("part", [f"<section id=related>{MENU}</section>", f"<section id=comments><p>{P}</p></section>", f"<div class='x share-buttons'>{P}</div>", f"<div id=sidebar>{P}</div>"])
def test_names_of_boilerplate_go(part):
    assert html_text.extract(f"<article><p>{P}</p>{part}<p class=related-work>{P}</p></article>") == "\n".join([P.strip()] * 2)


ONE, TWO = f"<h1>T</h1><p>{P*3}</p><p>{P*3}</p>", f"<p>{P*2}</p><p>{P*2}</p>"
LONG = [(P * 3).strip()] * 2
SHORT = [(P * 2).strip()] * 2


@pytest.mark.parametrize("page, text", [
    (f"<div><article>{ONE}</article><article>{TWO}</article></div>", ["T", *LONG, *SHORT]),
    (f"<main><article>{ONE}</article><article>{TWO}</article></main>", ["T", *LONG, *SHORT]),
    (f"<article>{TWO}<article><div>{ONE}</div></article>{TWO}</article><nav><a href=x>Home</a></nav>", [*SHORT, "T", *LONG, *SHORT]),
    (f"<main><article>{ONE}</article><div>{'<a href=x>More of this</a> ' * 9}</div></main>", ["T", *LONG]),
])
def test_threshold_chooses_around_articles(page, text):
    assert html_text.extract(page) == "\n".join(text)


@pytest.mark.parametrize("part", [f"<div class=search>{P}</div>", f"<p class=tags>{P}</p>", f"<section class='related'>{P}</section>", f"<div class=side>{P}</div>",
                                  f"<fieldset>{P}</fieldset>", f"<dialog>{P}</dialog>", f"<p><label>{P}</label></p>"])
def test_parts_of_the_article_that_are_no_links_stay(part):
    assert html_text.extract(f"<article><p>{P}</p>{part}</article>") == "\n".join([P.strip()] * 2)


@pytest.mark.parametrize("part", [f"<div class=related>{MENU}</div>", f"<ul class='tags'><li>{MENU}</ul>", f"<form><label>{P}</label></form>", f"<form><fieldset>{P}</fieldset></form>",
                                  f"<div class='notice'>{P}</div>", f"<div class='related comments'>{P}</div>", f"<dialog>{MENU}</dialog>"])
def test_links_notices_and_forms_within_the_article_go(part):
    assert html_text.extract(f"<article><p>{P}</p>{part}</article>") == P.strip()


@pytest.mark.parametrize("page", ["<b>" * 60_000 + "x", "<div>" * 60_000 + "x", "<p>x</b></i></q>" * 20_000, "<article>" + "<section id=search>" * 30_000 + "x", "<svg>x" * 30_000,
                                  "<header>" * 30_000 + "<main>x</main>", "<li>" * 30_000, "<span><p>" * 20_000])
def test_time_is_linear_in_the_page(page):
    began = time.process_time()
    html_text.extract(page)
    assert time.process_time() - began < 10

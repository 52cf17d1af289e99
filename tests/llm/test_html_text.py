import html
import re

import pytest

from regiocast.llm import html_text as ht
from regiocast.llm.queries import op10_html_text

SMALL = "/root/testdata/sf0.001"
LONG = "A long paragraph of running text that goes on for quite a while, with commas, and more words than any menu. " * 3

AROUND = [
    "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></ul></nav>",
    "<header><h1>Site name</h1><p>A slogan that is fairly long for a header of a page</p></header>",
    "<footer>&copy; 2024 somebody, all the rights of this page reserved by them</footer>",
    "<aside><h2>Related</h2><p>Something else that you may also want to read soon</p></aside>",
    '<div class="cookie-notice">We use cookies to make this page better, please accept them all</div>',
    '<div id="adSlot1"><p>Buy this fine product now, it is cheap and very good indeed</p></div>',
    "<form><label>Name</label><input name=q><button>Send this form to us</button></form>",
    "<script>var x = '<p>not text</p>';</script><style>p{margin:0}</style>",
    '<section id="comments"><article class="comment"><p>I am a reader and I have got something to say here, too</p></article></section>',
    '<div role="complementary">A box beside the text with some more sentences in it</div>',
    "<!-- a comment --><noscript>Please enable it</noscript>",
]


def test_article_without_its_surroundings():
    inner = f"<h1>A &amp; B</h1><p>{LONG}</p><p>Short.</p><p><b>{LONG}<br><p>Open<i>ly</i>&nbsp;so &#233;</p>"
    want = " ".join(f"A & B {LONG} Short. {LONG} Openly so é".split())
    for around in AROUND:
        for page in (f"{around}<article>{inner}</article>", f"<article>{inner}</article>{around}", f"<article>{inner}{around}</article>" if "<header" not in around else f"<main>{inner}</main>"):
            assert ht.main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{page}</body></html>") == want
    assert ht.main_text("<body>" + "".join(AROUND) + f"<article>{inner}</article>" + "".join(AROUND)) == want


def test_unmarked_page_by_ratio_alone():
    menu = "".join(f"<div><a href=/{k}>Menu {k}</a> <a href=/x>x</a> <a href=/y>y</a></div>" for k in range(8))
    page = f"<body><div>{menu}</div><div><h2>Head</h2><p>{LONG}</p><p>So.</p><p>{LONG}</p></div><div>{menu}</div></body>"
    assert ht.main_text(page) == " ".join(f"Head {LONG} So. {LONG}".split())


@pytest.mark.parametrize("page", ["", "<", "<p", "<article></article>", "<nav>menu</nav>", "<![x[ ]]>", "<!--", "&", "<script>alert(1)", "<div class=ad>x</div>"])
def test_pages_without_content(page):
    assert ht.main_text(page) in ("", "<", "&")


def test_malformed_and_long_pages():
    assert ht.main_text("<article><p>one <b>two</i> three<p>four</div>five &am") == "one two three four five &am"
    assert ht.main_text("<article>" + "<p>word word</p>" * 20_000 + "</article>") == " ".join(["word word"] * 20_000)
    deep = "<div>" * 3000 + "<p>deep inside</p>"
    assert ht.main_text(deep) == "deep inside"


def test_smoothing_and_threshold():
    assert ht.smooth([3.0, 3.0, 3.0]) == pytest.approx([3.0] * 3)
    assert ht.smooth([0.0] * 5 + [7.0] + [0.0] * 5)[5] == max(ht.smooth([0.0] * 5 + [7.0] + [0.0] * 5))
    assert 2 < ht.threshold([1, 1, 2, 10, 11, 12]) < 10


def test_table_cases(spark):
    df = spark.createDataFrame([(1, None, "old", 3), (None, "", "old", 3), (2, "<p>x y", "old", 3), (2, "<p>x y", "old", 3)], "page_id long, html string, text string, tags int")
    got = ht.extract(df)
    assert got.columns == df.columns and sorted(r.text for r in got.collect()) == ["", "", "x y", "x y"]
    assert ht.extract(df.limit(0)).collect() == []


def test_query_returns_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = op10_html_text(spark, SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)>", "\n", inner)))
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, " ".join(plain.split()), len(r.text))


def test_ratio_selects_the_region_on_every_page(spark):
    teaser = "<article><p>Short teaser.</p></article>"  # a mark without a chosen line does not choose
    assert ht.main_text(f"<body>{teaser}<div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div></body>") == " ".join(f"Head {LONG} {LONG}".split())
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html")
    plain = ht.extract(pages.selectExpr("page_id", "regexp_replace(html, '(</?)article>', '$1div>') AS html"))
    want = {r.page_id: r.text for r in op10_html_text(spark, SMALL).collect()}
    assert all("<article" not in r.html and r.text == want[r.page_id] for r in plain.collect())


MENU = "".join(f"<div><a href=/{k}>Menu {k}</a> <a href=/x>x</a> <a href=/y>y</a></div>" for k in range(8))
PARTS = f"<h2>Head</h2><p>Short.</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>", f"<p>{LONG}</p><p>{LONG}</p><p>End.</p>"
WHOLE = " ".join(f"Head Short. {LONG * 3} {LONG * 2} End.".split())


@pytest.mark.parametrize("part", ["<div>{}</div>", "<section>{}</section>", "<td>{}</td>"])
def test_split_sections(part):
    both = "".join(part.format(x) for x in PARTS)
    both = f"<table><tr>{both}</tr></table>" if "td" in part else both
    assert ht.main_text(f"<body><div>{MENU}</div><div id=c>{both}</div><div>{MENU}</div></body>") == WHOLE
    assert ht.main_text(f"<body><div>{MENU}</div>{both}<div>{MENU}</div></body>") == WHOLE
    many = "".join(part.format(f"<p>{LONG}</p>") for _ in range(30))  # the last part is a small share
    many = f"<table><tr>{many}</tr></table>" if "td" in part else many
    assert ht.main_text(f"<body><div>{MENU}</div><div>{many}</div></body>") == " ".join((LONG * 30).split())


def test_text_directly_in_the_body():
    for menu in ("", f"<div>{MENU}</div>", f"<nav>{MENU}</nav>"):
        assert ht.main_text(f"<body>{menu}{''.join(PARTS)}{menu}</body>") == WHOLE


@pytest.mark.parametrize("wrapper", ["<form action=/ method=post>{}</form>", "<div class='content has-sidebar'>{}</div>", "<div class='sidebar layout'>{}</div>", "<header>{}</header>"])
def test_wrapper_of_the_page_is_layout(wrapper):
    for inner in (f"<article>{''.join(PARTS)}</article>", f"<div>{''.join(PARTS)}</div>"):
        around = [x for x in AROUND if not x.startswith("<header") or "header" not in wrapper]
        assert ht.main_text(f"<body>{''.join(around)}{wrapper.format(''.join(around) + inner)}{''.join(around)}</body>") == WHOLE
    # what only stands beside the article is not, however long
    assert ht.main_text(f"<body><article>{''.join(PARTS)}</article><div class=comments><p>{LONG * 9}</p></div></body>") == WHOLE
    assert ht.main_text(f"<body><div>{''.join(PARTS)}</div><div class=comments><p>{LONG * 9}</p></div></body>") == WHOLE


def test_deep_nesting_takes_linear_time():
    import time

    pages = ["<div>some words here " * 50_000, "<body><article>" + "<section>text in it " * 20_000 + "</div></p></span>" * 20_000, "<form class=ad>" * 20_000 + "x y z"]
    for page in pages:
        began = time.process_time()
        ht.main_text(page)
        assert time.process_time() - began < 6

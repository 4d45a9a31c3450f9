import html
import re
import time

from lodeplane.llm.html import extract, main_text, op1_line_block_html
from tests.llm import brute
from tests.oracle import SF

LONG = "This paragraph goes on for long enough that nobody could take it for a menu or a footer, and a bit more. "
MARKED = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav><header><p>Site</p></header>
<article><header><h1>Title &amp; more</h1></header><p>{LONG}<b>bold</b>&nbsp;&lt;tag&gt;<p>Short.<br>Next</p><div class="ad-box"><div>Buy</div></div><script>if (a<b) x("</p>")</script>
<ul><li>one<li>two</ul><form><input><button>Go</button></form><aside>{LONG}</aside><p title="a>b">Last</p><section class="comments"><p>{LONG}</p></section></article>
<div id="related-posts">{LONG}</div><footer>&copy; {LONG}</footer></body></html>"""
PLAIN = f"""<body><div class=menu><a>{LONG}</a></div><div class="content"><h2>Head</h2><p>{LONG}</p><p>Short.</p><div role="alert">{LONG}</div><p>{LONG}</p></div>
<div><a href=1>{LONG}</a></div><div class="comment-list"><p>{LONG}</p></div><p>tail</p>"""


def test_marked_article():
    assert main_text(MARKED).split("\n") == ["Title & more", f"{LONG}bold <tag>", "Short. Next", "one", "two", "Last"]


def test_surge_and_dive_without_marks():
    assert main_text(PLAIN).split("\n") == ["Head", LONG.strip(), "Short.", LONG.strip()]


def test_classes_are_believed_with_care():
    assert main_text(f'<div class="content no-sidebar"><h1 class="page-header">T</h1><p>{LONG}</p></div>').split("\n") == ["T", LONG.strip()]
    assert main_text('<article><div class="entry-header"><h1>T</h1></div><p>x</p><div class="alert box">n</div></article>') == "T\nx"
    assert main_text(f'<div id="widget"><p>{LONG}</p></div>') == LONG.strip()


def test_odd_pages():
    assert main_text("") == "" and main_text("<p></p><!-- x") == "" and main_text("just text &amp; more") == "just text & more"
    assert main_text("<article><p>a <b>b</b>c\n\t d<") == "a bc d<"
    assert main_text('<div class="ad">x<article><p>kept</p></article>') == "kept"
    assert main_text("<article><p>a</p><scr") == "a" and main_text("<article>x<script>y") == "x"
    assert len(main_text("<article>" + "<p>word " * 30_000)) == 5 * 30_000 - 1
    assert main_text('<article><p title="a<b>c">x</p>') == "x"
    main_text("<a " * 50_000), main_text('<a "<a" ' * 5_000), main_text("<a '" * 5_000), main_text("<" * 50_000), main_text('<div class="ad">' * 5_000)


def test_columns_nulls_and_repeats(spark):
    pages = spark.createDataFrame([(1, "u", MARKED, "t", 5), (1, "u", MARKED, "t", 5), (None, None, None, None, None)], "page_id long, url string, html string, text string, `_html` int")
    out = extract(pages)
    assert out.columns == ["page_id", "url", "_html", "text"]
    got = [(r.page_id, r.text) for r in out.collect()]
    assert got[0] == got[1] and got[2] == (None, "")
    assert extract(pages.limit(0)).count() == 0


def test_query_against_the_articles_blocks(spark):
    got = {r.page_id: r for r in op1_line_block_html(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article))
        assert got[p.page_id].text == "\n".join(x for x in blocks if x) and got[p.page_id].n_chars == len(got[p.page_id].text)


def as_divs(page):
    return re.sub("(</?)article", r"\1div", page)


def test_surge_and_dive_against_brute_force_on_all_pages(spark):
    pages = [as_divs(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    bare = [re.sub("(</?)(nav|footer)", r"\1div", x).replace(' class="ad"', "") for x in pages]
    for window, surge in ((3, 80), (1, 80), (3, 10**9), (5, 300), (2, 20)):
        for page in (*pages, *bare):
            assert main_text(page, window, surge) == brute.line_blocks(page, window, surge)


def test_the_distribution_decides(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    want = {i: main_text(x) for i, x in pages.items()}
    assert all(main_text(as_divs(x)) == want[i] for i, x in pages.items())  # no article element is needed
    assert any(main_text(x, 1, 80) != want[i] for i, x in pages.items()) and any(main_text(x, 3, 10**9) != want[i] for i, x in pages.items())
    page = f"<p>intro</p><hr><div>short</div><div></div><aside>{LONG}</aside><div><p>{LONG}<p>{LONG}</div><footer>x</footer><p>tail"
    assert main_text(page) == f"{LONG.strip()}\n{LONG.strip()}" and main_text(page, surge=4) == f"intro\nshort\n{LONG.strip()}\n{LONG.strip()}\ntail"


def test_text_outside_the_article_counts_less():
    other = "A line of some eighty characters or more that isn't in the article, but stands beside it."
    assert main_text(f"<div>{other}</div><article><p>{LONG}</p></article>") == LONG.strip()
    assert main_text(f"<div>{LONG * 9}</div><article><p>{LONG}</p></article>").count("\n") == 1


def test_compound_names():
    for name, kept in (("alert-history", True), ("layout-with-sidebar", True), ("comments", False), ("comment-list", False), ("siteFooter", False), ("ads-by-us", False), ("related-posts", False)):
        assert (main_text(f'<article><p>{LONG}</p><section class="{name}">History of it</section><p>Last</p></article>') == f"{LONG.strip()}\nHistory of it\nLast") is kept, name


def test_markup_of_any_size():
    long = "A" * 3000
    assert main_text(f'<article><p>one <img alt="{long}>LEAK<b">two</p></article>') == "one two"
    assert main_text("<article><p " + 'a="x>LEAK" ' * 3000 + ">text</p></article>") == "text"
    assert main_text("<article><p title=it's>a</p><p b = 'c>d'>e</p></article>") == "a\ne"
    assert main_text(f'<div><img aria-hidden="true"><p hidden>no<p>{LONG}</div>') == LONG.strip()
    assert main_text("<p>a &am<b>p;</b> b") == "a &amp; b"
    for part in ("<title>", "<script>", "<a b='", "<!--", '<p hidden a="', "<div class=ad>", "</p", "<p =' "):
        start = time.monotonic()
        main_text(part * 20_000)
        small = time.monotonic() - start
        main_text(part * 160_000)
        assert time.monotonic() - start < 30 * max(small, 0.1)


def test_pages_within_forms():
    para = "<p>" + "A sentence of the article that is long enough to be one. " * 3 + "</p>"
    text = " ".join(("A sentence of the article that is long enough to be one. " * 3).split())
    page = f"<body><form id='aspnetForm'><div>{para}{para}</div><input name=q><nav><a href=x>Menu</a></nav></form><div><p>Short line.</p></div></body>"
    assert main_text(page) == f"{text}\n{text}"
    assert main_text(page.replace("form", "FIELDSET")) == f"{text}\n{text}"
    assert main_text(f"<article>{para}<form><p>Sign up for our letter, it is free and you can leave at any time.</p></form>{para}</article>") == f"{text}\n{text}"


def test_paragraphs_of_links_within_an_article():
    para = "<p>" + "A sentence of the article that is long enough to be one. " * 3 + "</p>"
    text = " ".join(("A sentence of the article that is long enough to be one. " * 3).split())
    assert main_text(f"<article>{para}<p><a href=x>The whole report as a file</a></p>{para}</article>") == f"{text}\nThe whole report as a file\n{text}"
    assert main_text(f"<div>{para}<p><a href=x>The whole report as a file</a></p>{para}</div>") == f"{text}\n{text}"

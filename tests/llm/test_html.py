import pytest

from stocktake.llm import html

LONG = "This paragraph has quite a few words so that the text surges here, well above the limit of a line block."
CASES = [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain text only", "plain text only"),
    (f"<nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>{LONG}\n\t x</p><p>Short.</p></article><footer>foot</footer>", f"T & U\n{LONG} x\nShort."),
    (f"<body><div class='menu'><ul><li><a href=a>A</a><li><a href=b>B</a></ul></div><div id=main><h2>Head</h2><p>{LONG}<p>{LONG}</div><div class=\"ad-box ad\">buy {LONG}</div>",
     f"Head\n{LONG}\n{LONG}"),
    (f"<script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>gone</p> --><p>{LONG}</p><section id='comments'><p>{LONG}</p></section>", LONG),
    (f"<p>{LONG}</p><form><p>{LONG}</p></form><aside>{LONG}</aside><p>end</p>", LONG),
    (f"<p>a&lt;b &#233;&nbsp;&copy; {LONG}</p>", f"a<b é © {LONG}"),
    (f"<nav><p>{LONG}</p>", LONG),  # never closed: hides nothing
    (f"<p>one<br>two <b>bold</b>er {LONG}</p>", f"one two bolder {LONG}"),
    (f"<article><p>tiny</p><div class='cookie-notice'>{LONG}</div><p>last</p></article>", "tiny\nlast"),
    (f"<p>{LONG}</p><script>unclosed <p>{LONG}</p>", LONG),
    (f"<P CLASS=x>{LONG}</P><p title='a > b'>{LONG}</p>", f"{LONG}\n{LONG}"),
]


@pytest.mark.parametrize("page, want", CASES)
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_article_elements_are_a_bonus_only():
    body = "".join(f"<p>{k} {LONG}</p>" for k in range(4))
    kept = "\n".join(f"{k} {LONG}" for k in range(4))
    comments = "".join(f'<article class="comment"><p>comment {k} {LONG}</p></article>' for k in range(3))
    assert html.main_text(f"<div>{body}</div>{comments}") == kept
    teasers = "<nav>menu</nav>" + "".join(f"<article><h3><a href=x>teaser {k}</a></h3><p>brief</p></article>" for k in range(3))
    assert html.main_text(f"<div>{body}</div>{teasers}") == kept
    assert html.main_text(f"<main><article>{body}</article>{teasers}</main>").startswith(kept)
    # The window decides outside of the article too: what surges is kept, a short line apart is not.
    assert html.main_text(f"<article>{body}</article><nav>x</nav><p>short</p><nav>x</nav><div><p>{LONG}</p></div>") == f"{kept}\n{LONG}"
    assert html.main_text(f"<main>{body}<article class='share-box'>{LONG}</article></main>") == kept
    assert html.main_text("<article><p><a href=x>only a link</a></p></article>") == "only a link"


BODY = "".join(f"<p>{k} {LONG}</p>" for k in range(4))
KEPT = "\n".join(f"{k} {LONG}" for k in range(4))


@pytest.mark.parametrize("name", ["content with-sidebar", "post no-comments", "entry has-header", "section related-work", "related-work", "widget Blog"])
@pytest.mark.parametrize("page", ["<div class='{}'>{}</div>", "<section id=x class='{}'><article>{}</article></section><footer>foot</footer>",
                                  "<article><div class='{}'>{}</div></article>", "<main class='{}'>{}</main><div class='sidebar'>side</div>"])
def test_wrappers_are_not_hidden(name, page):
    assert html.main_text(page.format(name, BODY)) == KEPT


@pytest.mark.parametrize("name", ["sidebar", "comments-area", "x related-posts", "share_box", "comment"])
def test_marks(name):
    aside = f"<div class='{name}'><p>{LONG}</p></div>"
    assert html.main_text(f"<div>{BODY}{aside}</div>") == html.main_text(f"{aside}<article>{BODY}</article>") == KEPT
    if name == "comment":  # longer than the article
        assert html.main_text(f"<div>{BODY}</div><div id=comments>{BODY}{BODY}{aside}</div>") == KEPT
        assert html.main_text(f"<div id=comments>{BODY}</div>") == KEPT
    assert html.main_text(f"<article><p>brief</p></article><div class='{name}'>{LONG}</div>") == "brief"
    assert html.main_text(f"<p>{LONG} <span class='{name}'>gone</span></p>") == LONG


def test_long_page():
    page = "<article>" + "".join(f"<p>{k} {LONG}</p>" for k in range(20_000)) + "</article>"
    assert html.main_text(page).count("\n") == 19_999
    assert html.main_text("<" * 50_000) == "<" * 50_000
    assert html.main_text('<p "' * 20_000) is not None


def test_rows(spark):
    pages = spark.createDataFrame([(2**53 + 1, "u", f"<p>{LONG}é</p>", "x"), (2**53 + 1, "u", f"<p>{LONG}é</p>", "x"), (None, None, None, "y")], "page_id long, url string, html string, text string")
    found = sorted((str(r["page_id"]), r["url"], r["n_chars"]) for r in html.extract(pages).collect())
    assert found == [("9007199254740993", "u", len(LONG) + 1)] * 2 + [("None", None, 0)]
    assert {r["n_chars"] for r in html.extract(pages).collect()} == {len(LONG) + 1, 0}
    assert html.extract(pages.limit(0)).count() == 0


IMAGE = "data:image/png;base64," + "iVBORw0KGgo+/AAB" * 65_536  # 1 MB


def test_attributes_of_any_length():
    assert html.main_text(f'<article><p>{LONG}</p><img alt="x" src="{IMAGE}"><p>{LONG}</p></article>') == f"{LONG}\n{LONG}"
    assert html.main_text(f"<article><p>{LONG} <img src='{IMAGE}'> x</p></article>") == f"{LONG} x"
    style = "color: red; " * 1000
    assert html.main_text(f'<div>{BODY}</div><div style="{style}" class="sidebar"><p>{LONG}</p></div>') == KEPT
    many = " ".join(f'data-x{k}="{k} > 0"' for k in range(500))
    assert html.main_text(f"<div {many}>{BODY}</div><div {many} class=sidebar>{LONG}</div>") == KEPT


@pytest.mark.parametrize("page", [
    f"<p title=Bob's>{LONG}</p><p>it's {LONG}</p>", f'<p title="a <b> c" >{LONG}</p><p>it\'s {LONG}</p>', f"<p a = 'x>y' b>{LONG}</p><p c=>it's {LONG}</p>",
])
def test_quotes_count_after_an_equals_sign(page):
    assert html.main_text(page) == f"{LONG}\nit's {LONG}"


@pytest.mark.parametrize("broken", ['<p "', "<p a='", '<p a="', "<a b=\"'", "<x <y='", "<!", "< p", "<p a=\"><p b='>"])
def test_broken_tags_take_linear_time(broken):
    assert html.main_text(broken * 60_000) is not None


@pytest.mark.parametrize("name", ["comment-list", "user-comments", "comments_area_2", "comment-respond", "post-replies", "disqus_thread", "commentlist", "x-comments-y"])
def test_reader_comments_by_any_part_of_a_name(name):
    thread = "".join(f"<div class='{name}'><p>{k} {LONG} {LONG}</p></div>" for k in range(3))
    assert html.main_text(f"<div class='post'>{BODY}</div>{thread}") == KEPT
    assert html.main_text(f"<div class='post'>{BODY}</div><div id='{name}'>{BODY}{BODY}{BODY}</div>") == KEPT
    # A wrapper of the whole page is no thread, whatever it is called.
    assert html.main_text(f"<div class='{name}'><h1>Head</h1>{BODY}</div><div><nav>x</nav><p>{LONG}</p></div>").startswith(f"Head\n{KEPT}")


@pytest.mark.parametrize("name", ["site-footer", "left-sidebar", "adsbygoogle", "google_ads_1", "site-header", "main-nav", "top-banner", "post-share"])
def test_marks_at_the_end_of_a_name(name):
    assert html.main_text(f"<div class='{name}'><p>{LONG}</p></div><div>{BODY}</div><ins class='a {name}'>{LONG}</ins>") == KEPT


@pytest.mark.parametrize("name", ["no-sidebar", "has-footer", "post-with-comments", "entry-header", "without_ads", "headline", "adder", "formal"])
def test_names_that_mark_nothing(name):
    assert html.main_text(f"<div><div class='{name}'><p>{LONG}</p></div>{BODY}</div>") == f"{LONG}\n{KEPT}"


def test_attribute_values_do_not_conceal():
    assert html.main_text(f"<p title='hidden gems'>{LONG}</p><p data-id=sidebar>{LONG}</p><p hidden>{LONG}</p><p style='display : none'>{LONG}</p>") == f"{LONG}\n{LONG}"


def test_titles_in_headers_of_articles():
    assert html.main_text(f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header>{BODY}</article>") == f"Title\n{KEPT}"
    assert html.main_text(f"<main><header><h1>Title</h1></header>{BODY}</main><footer>foot</footer>") == f"Title\n{KEPT}"


def test_a_hidden_element_does_not_part_its_neighbours():
    assert html.main_text(f"<h1>Title</h1><nav>menu</nav><p>intro</p><aside>{LONG}</aside><p>{LONG}</p>") == f"Title\nintro\n{LONG}"
    assert html.main_text(f"<div><h1>Title</h1><div class=ad>buy</div><p>intro</p><div class=ad>buy</div>{BODY}<form>x</form><p>end</p></div>") == f"Title\nintro\n{KEPT}\nend"

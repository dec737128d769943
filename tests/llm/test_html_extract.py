import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from windlass.llm.html_extract import CONTAINER, extract_main_text, main_text, measure, parse, points, score

ARTICLE = "<p>First paragraph, long enough to count, with several commas, and more words to it.</p>" \
          "<p>Second one, also of some length, which goes on and on, as articles do.</p>"
WANT = "First paragraph, long enough to count, with several commas, and more words to it.\n\n" \
       "Second one, also of some length, which goes on and on, as articles do."


@pytest.mark.parametrize("page", [
    f"<html><body><nav><ul><li><a href=a>Home, sweet, home</a></li></ul></nav><article>{ARTICLE}</article>"
    "<footer>Imprint, contact, and so on</footer></body></html>",
    f"<body><div id='menu'><a href=x>A</a><a href=y>B</a></div><div class='content'>{ARTICLE}</div>"
    "<div class='comments'><p>I disagree, strongly, with all of this, and with more, too.</p></div></body>",
    f"<body><div class=cookie-notice><p>We use cookies, many, of all kinds, accept them.</p></div><main>{ARTICLE}</main>"
    "<aside><p>Related, stories, you, might, like, to read on this site.</p></aside></body>",
    f"<div><form><p>Subscribe, now, for free, and get more, of the same</p><input value=x></form>{ARTICLE}"
    "<div class='advert'>Buy, buy, buy, this, that</div></div>",
    f"<script>var a='<p>no, no, no</p>';</script><style>p{{}}</style><!-- <p>hidden, text</p> --><div>{ARTICLE}</div>",
    f"<div>{ARTICLE.replace('</p>', '')}</div>",  # implied end tags
    f"<DIV>{ARTICLE.replace('commas,', '<B>commas</B>,').replace('length,', 'length<!-- x -->,')}</DIV>",
    f"<div id=wrap><div>{ARTICLE}</div></div><div><ul>" + "<li><a href=l>link, link, link, link</a></li>" * 30 + "</ul></div>",
])
def test_article_without_furniture(page):
    assert main_text(page) == WANT


def test_blocks_space_and_references():
    page = "<div><h1>A &amp; B &#x41;&#66; &eacute;&nbsp;x</h1><p>one\n\t two<br>three</p>" \
           "<ul><li>item, one<li>item two</ul>a &lt; b</div>"
    assert main_text(page) == "A & B AB é x\n\none two three\n\nitem, one\n\nitem two\n\na < b"


@pytest.mark.parametrize("page", [
    "<div class='content has-sidebar'>{}</div>", "<div class='no-sidebar'><div>{}</div></div>",
    "<div class='elementor-widget elementor-widget-text-editor'>{}</div>", "<article><section id='discussion'>{}</section></article>",
    "<div class=sidebar><main>{}</main></div>", "<div class='sidebar'>{}</div>"])
def test_wrappers_with_furniture_words_keep_the_article(page):
    assert main_text(f"<body>{page.format(ARTICLE)}</body>") == WANT


def test_headings_formulas_and_sources_stay():
    page = "<div class='article-header'><h1>Title</h1></div>" + ARTICLE + "<h2 id='related-work'>Related work</h2>" \
           "<p id='social-effects'>Effects, on people.</p><p>Let <math><mi>x</mi></math> be <label>one</label>.</p>" \
           "<p><a href=a>Anna A</a>, <a href=b>Bert B</a>, <a href=c>Cleo C</a></p>" \
           "<ol>" + "<li><a href=s>A report on rivers and towns, in five volumes</a></li>" * 3 + "</ol>"
    assert main_text(f"<article>{page}</article>") == "\n\n".join(
        ["Title", WANT, "Related work", "Effects, on people.", "Let x be one.", "Anna A, Bert B, Cleo C"] +
        ["A report on rivers and towns, in five volumes"] * 3)


def test_furniture_by_name_goes():
    for name in ("sidebar", "site-footer", "comments", "related", "widget", "share"):
        assert main_text(f"<body><div>{ARTICLE}</div><div class='{name}'>Some, words, here.</div></body>") == WANT


@pytest.mark.parametrize("page", [
    "<article>{0}<article class='comment'><p>{1}</p></article></article>", "<article>{0}<section><article><p>{2}</p></article></section></article>",
    "<article>{0}</article><article class='comment' id='comment-7'><p>{1}</p></article>",
    "<article>{0}<article class='comment-body'><p>{1}</p></article></article>"])
def test_comments_as_articles_are_left_out(page):
    assert main_text(page.format(ARTICLE, "I disagree, in all, of the, many, points, and more, " * 20, "I disagree, with this.")) == WANT


LONG_TALK = "I disagree, in all, of the, many, points, and more, as one may see. " * 20


@pytest.mark.parametrize("box", [
    "<div class='comment-list'>{}</div>", "<section class='user-comments'>{}</section>", "<ol class='commentlist'><li>{}</ol>",
    "<div id='comments-section'><div class='comment-body'>{}</div></div>", "<div class='post-comments'>{}</div>",
    "<div class='related-articles'>{}</div>", "<div class='relatedPosts'>{}</div>", "<div class='site-notice'>{}</div>",
    "<ul class='cookie-consent-banner'><li>{}</ul>", "<table class='newsletter-signup'><tr><td>{}</td></tr></table>",
    "<div class='notice'>{}</div>", "<div class='recommended-stories'>{}</div>", "<section id='respond'>{}</section>"])
@pytest.mark.parametrize("frame", ["<body><article>{0}</article>{1}</body>", "<body><div>{0}{1}</div></body>", "<main>{0}{1}</main>"])
def test_named_furniture_goes_at_any_length(box, frame):
    for talk in (f"<p>{LONG_TALK}</p>", LONG_TALK, "Agreed."):
        assert main_text(frame.format(ARTICLE * 2, box.format(talk))) == WANT + "\n\n" + WANT


@pytest.mark.parametrize("short", ["Short intro.", "<p>Short intro</p>", "<h2>Part</h2>", "<ul><li>one</li></ul>"])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_short_boxes_beside_the_article_are_kept(tag, short):
    """The first or the last, of any length, without a full stop."""
    text = main_text(short)
    page = f"<body><{tag}>{short}</{tag}><{tag}>{ARTICLE * 4}</{tag}><{tag}>{short}</{tag}></body>"
    assert main_text(page) == "\n\n".join([text, *[WANT] * 4, text])


def test_a_long_and_a_short_article_side_by_side_are_both_kept():
    page = f"<main><article>{ARTICLE * 4}</article><article><p>A short one.</p></article></main>"
    assert main_text(page) == "\n\n".join([WANT] * 4 + ["A short one."])
    assert main_text(page.replace("main", "body")) == "\n\n".join([WANT] * 4 + ["A short one."])


def test_the_title_block_of_main_is_kept_and_the_sites_is_not():
    page = f"<body><header><h1>Site</h1></header><main><header><h1>Title</h1></header>{ARTICLE}</main></body>"
    assert main_text(page) == "Title\n\n" + WANT


def test_doubtful_names_beside_the_article_go_and_inside_it_stay():
    box = "<div class='{}'><h3>Some</h3><p>Words, of its own.</p></div>"
    page = "<body>" + box.format("header") + f"<div>{ARTICLE}" + box.format("discussion") + "</div>" + box.format("widget") + "</body>"
    assert main_text(page) == WANT + "\n\nSome\n\nWords, of its own."


def test_an_article_that_only_wraps_another_keeps_it():
    assert main_text(f"<article><h1>Title</h1><article>{ARTICLE}</article></article>") == "Title\n\n" + WANT


@pytest.mark.parametrize("tag", ["main", "div", "body"])
def test_uneven_sections_are_kept(tag):
    page = f"<{tag}><section>{ARTICLE * 4}</section><section><p>Short one.</p><p>Another one.</p></section></{tag}>"
    assert main_text(page) == "\n\n".join([WANT] * 4 + ["Short one.", "Another one."])


def test_what_lies_between_parts_of_the_article_is_kept():
    page = f"<body><div>{ARTICLE}</div><pre>x = 1</pre>bare text<ul><li>one</li></ul><table><tr><td>7</td></tr></table>" \
           f"<blockquote>quoted</blockquote><figure><figcaption>a caption</figcaption></figure><div>{ARTICLE}</div></body>"
    assert main_text(page) == "\n\n".join([WANT, "x = 1", "bare text", "one", "7", "quoted", "a caption", WANT])


def test_menus_inside_the_article_are_left_out_and_linked_text_stays():
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Section {i}</a></li>" for i in range(5)) + "</ul>"
    linked = '<p><a href="x">See here</a></p><p>One <a href=a>link</a>, two <a href=b>links</a>, three <a href=c>links</a> in a text.</p>'
    assert main_text(f"<article>{menu}{ARTICLE}{linked}</article>") == \
        WANT + "\n\nSee here\n\nOne link, two links, three links in a text."


def test_siblings_of_the_best_container_are_kept():
    page = f"<body><h2>Title</h2><div>{ARTICLE}</div><div>{ARTICLE}</div></body>"
    assert main_text(page) == "Title\n\n" + WANT + "\n\n" + WANT


@pytest.mark.parametrize("page", ["", None, "<html></html>", "<nav>only, a, menu</nav>", "<", "<!--", "<p", "</p></div>"])
def test_pages_without_text(page):
    assert main_text(page) in ("", "<")


def test_hostile_markup_is_read_in_linear_time():
    assert main_text("<a '" * 20_000 + "x") is not None
    assert main_text("<div>" * 5_000 + "deep, text" + "</div>" * 5_000) == "deep, text"
    assert main_text("<p>" + "word, " * 200_000).startswith("word, word,")


@pytest.mark.parametrize("unit", ["<div><p>", "<b>", "<ul><li>", "<article><header>", "<div class='widget'>", "<table><tr><td>", "<p><b><i>"])
def test_nesting_costs_linear_time(unit):
    """Four times the nesting takes about four times as long, at half a megabyte."""
    def seconds(n):
        page = unit * n + "<p>" * (n if unit == "<b>" else 0) + "deep, text"
        start = time.process_time()
        assert "deep, text" in main_text(page)
        return time.process_time() - start

    n = 500_000 // len(unit) // 4
    seconds(n)
    small, large = min(seconds(n) for _ in range(2)), seconds(4 * n)
    assert large < 8 * small + 0.2 and large < 10


def brute_scores(order):
    """Every container's points, from each paragraph walk to the root."""
    out = {id(n): 0.0 for n in order}
    for node in order:
        own = points(node)
        if node.tag in CONTAINER:
            out[id(node)] += own
        up, share = node.parent, 1
        while up is not None:
            if up.tag in CONTAINER:
                out[id(up)] += own / share
                share *= 2
            up = up.parent
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["<div>", "</div>", "<p>", "</p>", "<ul>", "<li>", "</ul>", "<b>", "</b>", "<a href=x>", "</a>", "<table>", "<tr>",
                                 "<td>", "</table>", "words, and more", " of it, ", "<section>", "</section>", "<article>", "</article>"]), max_size=60))
def test_scores_equal_brute_force(parts):
    order = measure(parse("".join(parts)))
    score(order)
    want = brute_scores(order)
    assert all(abs(n.score - want[id(n)]) < 1e-9 * (1 + want[id(n)]) for n in order if n.tag in CONTAINER)


def test_frame(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x"), (1, "u", None, "y"), (None, None, "", "z")]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got) == [
        (0, "", "", 0), (1, "u", "", 0), (1, "u", WANT, len(WANT))]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

import pytest

from millgauge.llm import pages

LONG = "The quick brown fox and the lazy dog were in the garden of the house that was on the hill, and it is the story of how they came to be. " * 2


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<div></div>", ""), ("plain  words\n here", "plain words here"), ("<p>a &lt;b&gt; &amp;&nbsp;c</p>", "a <b> & c"),
    ("<script>var a='</p>';</script>x", "x"), ("<p>seen</p><!-- never closed <p>no", "seen"), ("<p hidden>no</p>yes", "yes"),
    ("<article><h1>T</h1><p><b>T more.<br></article><footer>f</footer>", "T T more."),
    ("<nav><a href=1>Home</a></nav><article><p>one</p><aside>ad</aside><div class='comments'><p>me too</p></div><p>two</p></article><p>out</p>", "one two"),
])
def test_cases(html, text):
    assert pages.main_text(html) == text


def test_rules_without_a_marked_article():
    html = (f"<div id=header><a>Home</a></div><div class=cookie-notice>{LONG}</div><div><h2>A title</h2><p>{LONG}<p>Short line.<p>{LONG}</div>"
            f"<div class=sidebar>{LONG}</div><form>{LONG}</form><p><a>{LONG}</a></p><footer>{LONG}</footer>")
    assert pages.main_text(html) == " ".join(["A title", LONG.strip(), "Short line.", LONG.strip()])


RUSSIAN = "Быстрая лиса перепрыгнула через ленивую собаку, потому что ей очень хотелось попасть домой до самого наступления темноты. " * 3
CHINESE = "敏捷的棕色狐狸跳过了懒狗因为它想在天黑之前回到家里去看望它的朋友们并且告诉他们今天发生的事情" * 6


@pytest.mark.parametrize("html, text", [
    *[(f"<nav><a href=1>Home</a></nav><div><p>{t}</p></div><footer>f</footer>", t.strip()) for t in (RUSSIAN, CHINESE)],
    (f"<div class='content no-sidebar'><p>{LONG}</div>", LONG.strip()),
    (f"<article class='post category-legal'><p>{LONG}</article><div class=sidebar>{LONG}</div>", LONG.strip()),
    (f"<article class='post comments-open'><p>{LONG}<div class='comments'>{LONG}</div></article>", LONG.strip()),
    (f"<form id=aspnetForm><div class=menu>x</div><article><p>{LONG}</article></form>", LONG.strip()),
    (f"<form><p>{LONG}<p>{LONG}</form>", " ".join([LONG.strip()] * 2)),
    (f"<div><p>{LONG}<p>{LONG}</div><article>teaser</article>", " ".join([LONG.strip()] * 2 + ["teaser"])),
    (f"<div><p>{LONG}</div><div class='comment-list'><p>{LONG}</div>", LONG.strip()),
    (f"<article class=comment>{LONG}</article><div><p>{LONG}</div>", LONG.strip()),
])
def test_whole_articles_stay(html, text):
    assert pages.main_text(html) == text


def test_long_pages_take_linear_time():
    assert len(pages.main_text("<div><b>x " * 20_000)) > 0


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é€</p>", "t", 5), (None, None, None, "t", 5), (1, "u", "<p>é€</p>", "t", 5)],
                               "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in pages.extract(df).collect()), key=str)
    assert got == [(0, None, "", 0), (1, "u", "é€", 2), (1, "u", "é€", 2)]
    assert pages.extract(df.limit(0)).count() == 0

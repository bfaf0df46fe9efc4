import html
import random

from evenhand.llm.html_extraction import extract, main_text

PROSE = "It was the first of the long days that they had to spend in the old house by the river, and all of them were as happy as they could be with it. "


def test_article_and_nothing_else():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var t="</p><p>no</p>";</script></head>
    <body class="has-sidebar"><header><h2>Site</h2><p>{PROSE}</p></header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav>
    <!-- <p>comment</p> --><div class="cookie-notice">{PROSE}</div>
    <article><header><h1>Head &amp; line</h1></header><p>{PROSE}<p>Short   one.<br>Same&nbsp;block <b>bo</b>ld</p>
    <div class="ad">{PROSE}</div><form><label>Name</label><input></form><ul><li>First</li><li>Second</li></ul>
    <section id="comments"><article><p>{PROSE}</p></article></section></article>
    <aside>{PROSE}</aside><footer>&copy; me</footer></body></html>"""
    assert main_text(page).split("\n") == ["Head & line", PROSE.strip(), "Short one. Same block bold", "First", "Second"]


def test_rules_without_a_content_element():
    page = f"""<div id="top"><a href=x>Home</a> <a href=y>News</a></div><h1>A title</h1><p>{PROSE * 2}</p><p>Short.</p><p>{PROSE * 2}</p>
    <p><a href=1>More and more and more and more of the links to all of the other pages</a></p><div>Tail</div><div class="footer"><p>{PROSE}</p></div>"""
    assert main_text(page).split("\n") == ["A title", (PROSE * 2).strip(), "Short.", (PROSE * 2).strip()]


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<script>never closed <p>x</p>") == ""
    assert main_text("plain text &lt;b&gt;") == "plain text <b>"
    assert main_text("<article><p>cut off &am") == "cut off &am"
    assert main_text("<article><p>one</p><p>two <a href='").split("\n")[0] == "one"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<article><p>" + "<a title='x>y</a> " * 20_000).startswith("y y")
    assert len(main_text("<article><p>" + "word " * 200_000)) == 200_000 * 5 - 1


ARTICLE = f"<article><h1>Head</h1><p>{PROSE}</p><p>Last one of the article.</p></article>"
TEXT = f"Head\n{PROSE.strip()}\nLast one of the article."


def test_wrappers_with_telling_names():
    for wrapper in ("site-content has-sidebar", "hfeed no-comments", "content with-menu", "sidebar", "comments-area", "page related"):
        assert main_text(f'<body><div class="{wrapper}">{ARTICLE}</div><div class="footer"><p>{PROSE}</p></div>') == TEXT
    # under hints alone the largest counts; beside a plain one none does
    assert main_text(f'<div class="sidebar">{ARTICLE}</div><div class="related"><article><p>Teaser.</p></article></div>') == TEXT
    assert main_text(f'{ARTICLE}<div class="related"><article><p>{PROSE * 9}</p></article></div><article class="comment"><p>{PROSE * 9}</p></article>') == TEXT
    assert main_text(f"<aside>{ARTICLE}</aside>") == main_text(f"<div hidden>{ARTICLE}</div>") == ""


def test_raw_elements_that_end_at_once_or_never():
    for raw in ("<svg class=icon/>", '<svg class="icon"/>', "<svg>", "<object>", "<template>", "<script src='x'/>", "<svg><p>no</p></svg>", "<script>if (a < b) '</p>'</script>"):
        assert main_text(ARTICLE.replace("<p>", f"<p>{raw}", 1)) == TEXT, raw
    assert main_text(ARTICLE.replace("<p>", "<script>x = 1 <p>", 1)) == "Head"
    for odd in ("<svg>" * 100_000, "<object><svg>" * 50_000, "<span class=ad>" * 100_000, "<div class=ad>" * 50_000):
        assert main_text(odd + "x") in ("", "x")


def test_paragraphs_of_the_article():
    extra = '<p class="legal">All of it is legal.</p><p><a href="x">The whole of this paragraph is a link</a></p><ul><li><a href="1">One</a></li><li><a href="2">Two</a></li></ul>'
    got = main_text(ARTICLE.replace("<p>Last", f"{extra}<p>Last"))
    assert got == TEXT.replace("Last", "All of it is legal.\nThe whole of this paragraph is a link\nLast")


def test_hidden_and_advertising_inline_elements():
    for inline in ('<span style="display: none">no <span>no</span> no</span>', '<span class="advert">no</span>', "<b hidden>no</b>", '<em aria-hidden="true">no</em>',
                   '<a class="sponsored" href="x">no</a>'):
        assert "no" not in main_text(ARTICLE.replace("</p>", f"{inline}</p>", 1)).split(), inline
        assert main_text(ARTICLE.replace("</p>", f"{inline}</p>", 1)).endswith("Last one of the article.")
    assert main_text(ARTICLE.replace("</p>", "<span class=ad>never closed</p>", 1)) == TEXT
    assert main_text(ARTICLE.replace("<p>Last", '<div><span class="ad">no<div>no</div>no</span></div><p>Last')) == TEXT


def test_languages_without_stop_words_here():
    polish = ["Wczoraj wieczorem mieszkańcy miasta spotkali się na rynku, żeby porozmawiać o przyszłości starego teatru.", "Nikt nie spodziewał się, że przyjdzie aż tylu młodych ludzi z okolicznych wiosek i miasteczek."]
    chinese = ["昨天晚上，城里的居民聚集在市场上，讨论老剧院的未来。没有人想到会有这么多年轻人从附近的村庄赶来参加这次会议，" * 2, "会议持续到深夜，大家最终同意共同修复这座建筑，并在明年春天重新开放，让所有的孩子都能看到演出，" * 2]
    for texts in (polish, chinese):
        page = '<div class="menu"><a href="1">A</a> <a href="2">B</a></div>' + "".join(f"<div>{t}</div>" for t in texts) + '<div class="footer">C</div>'
        assert main_text(page).split("\n") == texts


def test_made_up_pages_come_back():
    """Pages put together from known paragraphs and known other parts give the paragraphs."""
    r = random.Random(3)
    words = "the of and to in that house river garden morning window letter story people water market".split()
    for _ in range(300):
        sentence = lambda n: " ".join(r.choices(words, k=n)).capitalize() + "."
        parts = [sentence(r.randint(2, 60)) for _ in range(r.randint(1, 6))]
        boiler = lambda: r.choice([
            f"<nav><a href=1>{sentence(2)}</a></nav>", f"<aside><p>{sentence(30)}</p></aside>", f'<div class="cookie-banner">{sentence(20)}</div>', f"<script>{sentence(5)}</script>", "<!-- <p>x</p> -->",
            f'<div id="comments"><p>{sentence(40)}</p></div>', f"<form><input><p>{sentence(9)}</p></form>", f'<section class="newsletter-signup"><h3>{sentence(3)}</h3></section>', f"<footer>{sentence(12)}</footer>", "<svg/>", "\n  "])
        wrap = lambda t: r.choice([f"<p>{t}</p>", f"<p class=x>{t.replace(' ', '  ', 1)}", f"<p><b>{t[:1]}</b>{t[1:]}</p>", f"<p>{t}<!-- c --></p>"])
        inner = "".join(wrap(html.escape(p)) + (boiler() if r.random() < 0.4 else "") for p in parts)
        page = f"<html><head><title>{sentence(3)}</title></head><body>{boiler()}{boiler()}<{(tag := r.choice(['article', 'main']))} class='has-{r.choice(['sidebar', 'ads'])}'>{inner}</{tag}>{boiler()}</body></html>"
        assert main_text(page).split("\n") == parts, page


def test_table(spark):
    rows = [(1, "<article><p>a</p></article>", "old"), (1, "<article><p>a</p></article>", "old"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert [tuple(r) for r in extract(df).collect()] == [(1, rows[0][1], "a"), (1, rows[0][1], "a"), (None, None, "")]
    assert extract(df.filter("false")).collect() == []

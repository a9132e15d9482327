"""Main text of pages."""

import html
import re

from llm_support import SMALL, shipped  # noqa: F401

from viewlake.llm import html_text
from viewlake.llm.html_text import main_text
from viewlake.llm.queries import QUERIES


def test_query_gives_the_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = QUERIES["op9_html_text"](spark, SMALL).collect()
    assert len(got) == len(pages)
    for row in got:
        article = re.search(r"<article>(.*?)(?:</article>|<footer|$)", pages[row["page_id"]], re.DOTALL)[1]
        want = " ".join(html.unescape(re.sub(r"<(?:p|br|h1|/p|/h1)>", " ", article)).replace("<b>", "").replace("</b>", "").split())
        assert row["text"] == want and row["n_chars"] == len(want)


def test_markup_rules():
    page = """<html><head><title>T</title><style>x</style></head><body><header>Head</header><nav><a>Menu</a></nav>
    <div class="cookie-notice">We use</div><article><header>By</header><h1>Big&nbsp;&amp; <b>bo</b>ld</h1><p>One<br>two
      three<p>Of.<aside>Side</aside><form>Sub<input></form><script>var a="<p>";</script><div id="comments"><p>Nice!</div>
    <p>End &lt;here&gt;</article><div class="sidebar">S</div><footer>F</footer></body></html>"""
    assert main_text(page) == "Big & bold One two three Of. End <here>"


def test_ratio_finds_unmarked_content():
    menu = "".join(f"<li><a href='/{i}'>m{i}</a></li>" for i in range(30))
    body = "".join(f"<p>{'long sentence of text ' * 12}{i}</p>" for i in range(6))
    text = main_text(f"<body><div><ul>{menu}</ul></div><section><div>{body}</div></section></body>")
    assert "sentence of text 5" in text and text.count("long sentence") == 72


def test_ratio_decides_on_pages_with_marks():
    body = "".join(f"<p>{'long sentence of text ' * 12}{i}</p>" for i in range(6))
    links = "".join(f"<p><a href='/{i}'>m{i}</a></p>" for i in range(10))
    text = main_text(f"<body><article><a href='/t'>Teaser</a></article><div>{links}</div><nav>n</nav><section>{body}</section></body>")
    assert text.count("long sentence") == 72 and "Teaser" not in text and "m3" not in text
    text = main_text(f"<body><div>{links}</div><nav>n</nav><article>{body}{'<aside>s</aside>' * 12}<p>Tail.</p></article></body>")
    assert text.count("long sentence") == 72 and text.endswith("5 Tail.")


BODY = "".join(f"<p>{'long sentence of text ' * 12}{i}</p>" for i in range(6))
TEXT = " ".join(f"{'long sentence of text ' * 12}{i}" for i in range(6))


def test_names_of_layouts_are_not_boilerplate():
    for start, end in (
        ('<div class="layout has-sidebar">', "</div>"), ('<div id="page" class="no-sidebar">', "</div>"), ("<form>", "</form>"),
        ("<nav><a href='/'>Home</a>", ""), ('<div class="sidebar">', "</div>"), ("<header>", "</header>"), ("<nav><a href='/'>Home</a><article>", "</article>"),
    ):
        assert main_text(f"<body>{start}{BODY}{end}</body>").removeprefix("Home ") == TEXT, start


def test_a_footer_longer_than_the_article_is_a_footer():
    footer = f"<footer>{'terms and addresses ' * 20}</footer>"
    assert main_text(f"<body><article><h1>Hi</h1><p>Short.</p></article>{footer}</body>") == "Hi Short."


def test_an_article_ends_open_menus():
    page = f"<body><nav><ul><li><a href='/a'>Menu one</a><li><a href='/b'>Menu two</a><article>{BODY}</article><footer>Foot</footer></body>"
    assert main_text(page) == TEXT


def test_classes_count_by_whole_tokens():
    article = f'<article>{BODY}<p class="social-history">History of the club.</p><p class="ad-hoc">Ad hoc.</p></article>'
    assert main_text(f"<body>{article}</body>") == f"{TEXT} History of the club. Ad hoc."
    for name in ("ad", "ads right", "cookie-banner", "cookieBanner", "site_footer", "comment-list", "shareButtons", "sidebar-2", "related-posts", "reactions"):
        assert main_text(f'<body><div class="{name}">Boilerplate.</div><div>{BODY}</div><div class="{name}">Boilerplate.</div></body>') == TEXT, name


def test_an_advert_does_not_part_a_text():
    for start, end in (("<div>", "</div>"), ("<article>", "</article>"), ("", "")):
        page = f'<body>{start}{BODY}<div class="ad">Buy now.</div><p>The end.</p>{end}<footer>Foot</footer></body>'
        assert main_text(page) == f"{TEXT} The end."


def test_reader_comments_go():
    comments = "<ul>" + "<li><p>Great post, I have thought about this for a long time and agree with it.</p></li>" * 4 + "</ul>"
    for start in ("<h2>Comments</h2>", "<h3>12 Comments</h3>", "<h2><span>Reader comments (4)</span></h2>", "<h2>Kommentare</h2>"):
        assert main_text(f"<body><article>{BODY}</article><section>{start}{comments}</section></body>") == TEXT
        assert main_text(f"<body><article>{BODY}{start}{comments}</article></body>") == TEXT
    assert main_text(f'<body><article>{BODY}</article><div class="reactions">{comments}</div></body>') == TEXT
    kept = main_text(f"<body><article>{BODY}<h2>Comments on the law</h2><p>Text.</p></article></body>")
    assert kept == f"{TEXT} Comments on the law Text."


def test_links_do_not_count_as_text():
    links = "".join(f"<p><a href='/{i}'>A teaser of some twenty words which goes to another page of this site number {i}</a></p>" for i in range(8))
    assert main_text(f"<body><div>{links}</div><nav>n</nav><div>{BODY}</div></body>") == TEXT


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain words"), (3, "u", "<article>a<p>b"), (3, "u", "<article>a<p>b"), (4, "u", "<div" * 50), (5, "u", "<article>" + "<p>x &amp; y</p>" * 20_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows)
    texts = {(r["page_id"], r["url"]): r["text"] for r in got}
    assert texts[1, "u"] == texts[2, None] == "" and texts[3, "u"] == "a b" and texts[None, "u"] == "plain words"
    assert texts[5, "u"] == " ".join(["x & y"] * 20_000)
    assert html_text.extract(df.where("false")).count() == 0

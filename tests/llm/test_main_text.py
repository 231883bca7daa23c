import time

import pytest

from postlake.llm import main_text as q

PARTS = [
    "<nav><a href=a>menu entry</a></nav>", "<header>site head</header>", '<div class="ad">buy <div>this</div> now</div>',
    "<script>var a='</p>';</script>", "<style>p{}</style>", "<form><p>your name</p></form>", '<div id="comments"><p>I agree.</p></div>',
    '<div class="cookie-notice">we use cookies</div>', "<aside>see too</aside>", "<footer>&copy; me</footer>", "<!-- gone -->",
]


@pytest.mark.parametrize("part", PARTS)
def test_parts_around_the_article_are_left_out(part):
    article = "<article><h1>Head</h1><p>First &amp; long\n paragraph of text.</p><p>Two.<br>Three <b>bold</b></article>"
    page = f"<html><head><title>t</title></head><body>{part}{article}{part}</body></html>"
    assert q.main_text(page) == "Head First & long paragraph of text. Two. Three bold"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain", "plain"), ("<nav>only</nav>", ""), ("<article><p>a<p>b", "a b"),
    ("<div><div class='ad'>x<div>y</div>z</div>keep</div>", "keep"), ("</div></p>a &lt; b", "a < b"), ("<p>a<br/>b", "a b"),
    ("<p>caf&eacute; &#x1F642;</p>", "café 🙂"),
])
def test_cases(html, text):
    assert q.main_text(html) == text


def test_page_without_article_keeps_short_lines_inside():
    long = "A long paragraph with many words in it, as articles have. " * 3
    page = f"<body><div class=menu>Home</div><div><p>{long}</p><p>Yes.</p><p>{long}</p></div><div class=sidebar>x</div></body>"
    assert q.main_text(page) == f"{long.strip()} Yes. {long.strip()}"


def test_one_long_line_drops_no_paragraph():
    lines = [f"{i} " + "x" * 200 for i in range(31)]
    lines[15] = "long " + "x" * 20_000
    assert q.main_text("<body>" + "".join(f"<p>{x}</p>" for x in lines)) == " ".join(lines)
    assert q.main_text(f"<body><p>{'a' * 200}</p><p>{'b' * 200}</p><p>{'c' * 20_000}</p>").startswith("aaa")
    short, long = "<article><p>Short one.</p></article>", f"<article><p>{'x' * 5_000}</p></article>"
    assert q.main_text(short + long * 3 + short) == " ".join(["Short one.", *["x" * 5_000] * 3, "Short one."])


def test_all_lines_of_the_container_stay():
    long = "A long paragraph with many words in it, as texts have."
    links = "<div><a href=x>one link</a></div>" * 3
    page = f"<body>{links}<div><h1>Head</h1>{f'<p>{long}</p>' * 5}<p>End.</p></div>{links}</body>"
    assert q.main_text(page) == " ".join(["Head", *[long] * 5, "End."])
    assert q.main_text(f"<body>{links}<h1>Head</h1>{f'<p>{long}</p>' * 9}<p>End.</p>{links}") == " ".join(["Head", *[long] * 9, "End."])


@pytest.mark.parametrize("name", ["content has-sidebar", "no-sidebar", "page sidebar", "widget", "with-nav"])
@pytest.mark.parametrize("inner", ["<article><p>kept text</p></article>", "<p>kept text</p>"])
def test_names_on_wrappers_leave_out_nothing(name, inner):
    assert q.main_text(f'<body><div class="{name}"><div class="site-footer">no</div>{inner}</div></body>') == "kept text"


def test_headers_of_entries_and_forms_around_pages_stay():
    page = '<div class="entry-header"><h1>Title</h1></div><p>Some text of the entry.</p><div class="comments">' + "me too " * 50
    assert q.main_text(page) == "Title Some text of the entry."
    assert q.main_text("<form><nav>menu</nav><main><p>kept</p></main></form>") == "kept"


def test_very_long_pages():
    start = time.time()
    assert len(q.main_text("<article>" + "<p>word</p>" * 50_000)) == 5 * 50_000 - 1
    assert len(q.main_text("<article><p>" + "word " * 200_000)) == 5 * 200_000 - 1
    assert time.time() - start < 60


def test_query(spark, small_dir, empty_dir):
    rows = sorted(tuple(r) for r in q.op6_main_text(spark, small_dir).select("page_id", "text", "n_chars").collect())
    assert rows == [(1, "a " * 9 + "a", 19), (2, "a " * 9 + "a", 19), (3, "", 0)]
    assert q.op6_main_text(spark, empty_dir).count() == 0

import time

import pytest

from envstats.llm import html


@pytest.fixture(scope="module")
def pages(spark):
    def rows(items):
        return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in items],
                                     "page_id long, url string, html string, text string, HTML string")
    return rows


def text(page):
    return html.article_text(html.blocks(page))


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script>
    </head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> -->
    <header><h2>Site</h2></header><div class="ad">Buy!</div><article><header><h1>Head &amp; line</h1>
    </header><p><b>First &lt;b&gt;  para<br>two.<p>Second
    para &#233;&eacute;<aside>aside</aside><div class="comments"><p>A comment</p></div>
    <form><input name=q>Send</form><script>if (a < b) x("</article>")</script>
    <ul><li>one<li>two</ul><p hidden>last</article><aside class="sidebar">side</aside>
    <footer>&copy; 2020</footer>"""
    assert text(page) == ("Head & line\nFirst <b> para two.\nSecond para éé\none\ntwo\nlast")


def test_broken_markup():
    assert text("<article><p>a < b & c &am</article>") == "a < b & c &am"
    assert text("<article><p>open <b>bold</p><p>cut <a href='x") == "open bold\ncut"
    assert text("<main>m</main><p>x</p>") == "m" and text("") == "" and text("plain") == ""
    assert text('<div role="main"><p>r</p></div>') == "r"


@pytest.mark.parametrize("page", ["<" * 200_000, "<a" * 100_000, "<script" * 30_000, "<!--" * 50_000,
                                  '<a "' * 50_000, "<p>" * 60_000, "<div>" * 60_000 + "x",
                                  "<article>" + "a" * 500_000])
def test_parsing_is_linear(page):
    t0 = time.process_time()
    html.blocks(page)
    assert time.process_time() - t0 < 10


def extracted(pages, rows):
    return {r.page_id: r.text for r in html.extract(pages(rows)).collect()}


MENU = "<p>home about us contact the team imprint and help</p>"
LINKS = "<ul><li>Home</li><li>News</li><li>Sport</li><li>All weather</li><li>Jobs</li><li>Our shop</li></ul>"
STORIES = [f"Story {i} of the town of {w} is about {w} and nothing else at all; {w} people like number {i * 37}."
           for i, w in enumerate("ash birch cedar elm fir hazel".split())]


def test_blocks_that_the_host_repeats_go(pages):
    """Hand-written: a menu in one block, one in short blocks, a footer line with a page's own number."""
    foot = "<div>Printed copies of all of these pages can be ordered at our office, page {}</div>"
    rows = [(i, f"http://h.example.com/{i}", f"<body>{MENU}{LINKS}<p>{STORIES[i]}</p>{foot.format(i)}</body>")
            for i in range(6)]
    got = extracted(pages, rows)
    assert got == dict(enumerate(STORIES))


def test_near_copies_of_a_page_keep_their_text(pages):
    """The council pages: two versions of one page, and one that shares a sentence's half."""
    council = ("The council met on Monday evening to talk about the old bridge over the river and found that "
               "the old bridge over the river will be closed for repairs from the first of May until spring.")
    shops = ("Shops nearby fear losses because the old bridge over the river will be closed for weeks in the "
             "busy season.")
    rows = [(1, "http://c.example.com/1", f"<body><div>{council}</div></body>"),
            (2, "http://c.example.com/2", f"<body><div>{shops}</div></body>"),
            (3, "http://c.example.com/3", f"<body><div>{council}</div><div>Updated.</div></body>")]
    rows += [(10 + i, f"http://c.example.com/v{i}", f"<body><div>{council}</div><div>Version {i}.</div></body>")
             for i in range(8)]
    got = extracted(pages, rows)
    assert got[1] == council and got[2] == shops and got[3] == f"{council}\nUpdated."
    assert all(got[10 + i] == f"{council}\nVersion {i}." for i in range(8))


def test_shared_sentences_stay_in_their_paragraphs(pages):
    quote = "we will not rest before every child can read"
    rows = [(i, f"http://q.example.com/{i}", f"<body><p>{s} The mayor said {quote} in {i} years from now.</p></body>")
            for i, s in enumerate(STORIES)]
    got = extracted(pages, rows)
    assert got == {i: f"{s} The mayor said {quote} in {i} years from now." for i, s in enumerate(STORIES)}


def test_few_pages_or_a_small_share_are_no_boilerplate(pages):
    """A line in two pages of a host, and one in three of twelve, stay; hosts are judged apart."""
    line = "<p>a long line of words that some pages of this host repeat</p>"
    words = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(12)]
    rows = [(i, f"http://two.example.com/{i}", f"<body>{line}<p>{STORIES[i]}</p></body>") for i in range(2)]
    rows += [(100 + i, f"http://many.example.com/{i}", f"<body>{line if i < 3 else ''}<p>{words[i]}</p></body>")
             for i in range(12)]
    got, own = extracted(pages, rows), "a long line of words that some pages of this host repeat"
    assert got[0] == f"{own}\n{STORIES[0]}" and got[100] == f"{own}\n{words[0]}" and got[105] == words[5]


def test_article_pages_count_and_keep_their_article(pages):
    """Menus around articles mark the menu of the page without one; the article stays whole."""
    told = "home about us contact the team imprint and help"
    rows = [(i, f"http://a.example.com/{i}", f"<body>{MENU}<article><p>{s}</p></article></body>")
            for i, s in enumerate(STORIES)]
    rows += [(50, "http://a.example.com/art", f"<body>{MENU}<article>{MENU}</article></body>"),
             (60, "http://a.example.com/bare", f"<body>{MENU}<p>Only this page is plain.</p></body>"),
             (70, "http://b.example.com/bare", f"<body>{MENU}<p>Another host.</p></body>")]
    got = extracted(pages, rows)
    assert got[50] == told and got[60] == "Only this page is plain." and got[70] == f"{told}\nAnother host."
    assert {i: got[i] for i in range(6)} == dict(enumerate(STORIES))


@pytest.mark.parametrize("page,want", [
    ("<p>Text <span class='ad'>BUY</span> more</p>", "Text more"),
    ("<p>Read <button>Share</button>this</p>", "Read this"),
    ("<p>One<a class='share' href=x> send it</a></p><p>two</p>", "One\ntwo"),
    ("<p><a class=share>Share</a></p><p>alone</p>", "alone"),
    ("<p>a <em>b <span class=promo>c <b>d</b></span> e</em> f</p>", "a b e f"),
    ("<p>x<span class='big-deal'>y</span>z</p>", "xyz"),
    ("<div class='ad-slot'>buy</div><p>kept</p>", "kept"),
    ("<section class='comments-section'><p>first!</p></section><p>kept</p>", "kept"),
    ("<ul class='comment-list'><li>me too</li></ul><p>kept</p>", "kept"),
    ("<div id='cookie-banner'>we use them</div><p>kept</p>", "kept"),
    ("<div class='post-navigation'>next</div><p class='page_footer'>x</p><p>kept</p>", "kept"),
    ("<div class='has-sidebar'><p>kept</p></div>", "kept"),
    ("<div class='related-work'><p>kept</p></div>", "kept"),
    ("<p class='notice-period'>kept</p><p class='no-ads'>too</p>", "kept\ntoo"),
    ("<p class='share-price'>kept</p><h2 class='site-nav'>Head</h2>", "kept\nHead"),
    ("<ul class='related-posts'><li>other</li></ul><p class='main-content'>kept</p>", "kept"),
])
def test_inline_and_compound_marks(page, want):
    assert text(f"<article>{page}</article>") == want


@pytest.mark.parametrize("name", ["site-nav", "sidebar-left", "page-footer", "cookie-banner", "ad-slot"])
def test_compound_names_without_an_article(pages, name):
    rows = [(1, "http://n.example.com/1", f"<body><div class='{name}'>gone</div><div>kept text</div></body>")]
    assert extracted(pages, rows) == {1: "kept text"}


def test_named_page_keeps_its_article(pages):
    page = "<body class='site-nav'><div class='page-footer'><article><p>kept</p></article></div></body>"
    assert extracted(pages, [(1, "http://n.example.com/1", page)]) == {1: "kept"}


def test_a_hot_host_is_spread_over_its_prefixes(pages):
    """A third of all pages on one host: its runs are grouped by (host, prefix)."""
    rows = [(i, f"http://{'hot' if i % 3 == 0 else f'h{i}'}.example.com/{i}",
             "<body>" + MENU + "<p>" + " ".join(f"t{i}x{k}" for k in range(20)) + "</p></body>") for i in range(60)]
    got = extracted(pages, rows)
    for i in range(60):
        own = " ".join(f"t{i}x{k}" for k in range(20))
        assert got[i] == (own if i % 3 == 0 else f"home about us contact the team imprint and help\n{own}")


def test_odd_rows(pages):
    long = "<article>" + "<p>word &amp; more</p>" * 20_000 + "</article>"
    same = "<body><p>one page that is there twice, word for word the same</p></body>"
    rows = [(1, None, None), (2, "http://x.org", ""), (None, "http://x.org", long), (3, "::", long),
            (4, "http://y.org/1", same), (4, "http://y.org/1", same), (5, "http://y.org/2", same),
            (2**62 + 1, None, same)]
    out = html.with_lengths(html.extract(pages(rows))).collect()
    assert len(out) == 8 and {r.page_id for r in out} == {1, 2, 3, 4, 5, None, 2**62 + 1}
    for r in out:
        assert r.n_chars == len(r.text)
        if r.page_id in (4, 5):
            assert r.text == "one page that is there twice, word for word the same"
        if r.page_id in (3, None):
            assert r.text == "\n".join(["word & more"] * 20_000)
    assert html.extract(pages([])).count() == 0


STORY = "<p>the story of this page, told once</p>"
TOLD = "the story of this page, told once"


@pytest.mark.parametrize("page", [
    f"<html class='no-sidebar'><body class='has-sidebar banner'><article>{STORY}</article></body></html>",
    f"<body><main class='site-main no-sidebar'>{STORY}</main></body>",
    f"<body><article class='related-work'>{STORY}</article></body>",
    f"<body><div class='widget'><article>{STORY}</article></div><p>about</p></body>",
    f"<body><form id=f><main>{STORY}</main></form></body>",
    f"<body><!-- <article> --><div id='page'>{STORY}</div></body>",
    f"<body><script>x('<article class=a>')</script><div>{STORY}</div></body>",
    f"<body><div>{STORY}</div><article class='comment-body'><p>first!</p></article></body>",
    f"<body><div>{STORY}</div><div class='related'><article>a</article><article>b</article></div></body>",
    f"<body><article>{STORY}</article><div class='related'><article>other</article></div></body>"])
def test_no_page_comes_out_empty(pages, page):
    got = html.extract(pages([(1, "http://z.org/1", page), (2, "http://z.org/2", "<p>x</p>")])).collect()
    text = {r.page_id: r.text for r in got}[1]
    assert text.split("\n")[0] == TOLD and "first!" not in text and "other" not in text
    assert text == TOLD


def test_names_are_whole_class_tokens():
    page = ("<article><h2 id='social-history'>Social history</h2><h2 id='share'>Share</h2>"
            "<p class='notice-period'>kept</p><p class='big notice'>gone</p></article>")
    assert text(page) == "Social history\nShare\nkept"


def test_every_host_is_judged(pages, monkeypatch):
    """All pages have an article: the arrays are built all the same and find the menu."""
    found, judge = [], html.repeated_runs
    monkeypatch.setattr(html, "repeated_runs", lambda *a: found.append(judge(*a)) or found[-1])
    rows = [(i, f"http://a.example.com/{i}", f"<body>{MENU}<article><p>{s}</p></article><p>page {i}</p></body>")
            for i, s in enumerate(STORIES)]
    rows += [(10 + i, f"http://b.example.com/{i}", f"<body><article>{STORIES[0]}</article><p>{STORIES[i]}</p></body>")
             for i in range(3)]
    got = extracted(pages, rows)
    assert {i: got[i] for i in range(6)} == dict(enumerate(STORIES)) and got[10] == STORIES[0]
    runs = {}
    for r in found[0].collect():
        runs.setdefault(r.stream, set()).add(r.at)
    # nine tokens of the menu and "page" after it: five runs
    assert len(runs) == 6 and all(at == {0, 1, 2, 3, 4} for at in runs.values())


def test_frames_written_on_the_way_go(spark):
    import os

    from envstats.llm import common
    with common.passing(spark):
        first = common.written(spark.range(5).repartition(2), "first")
        last = common.written(first.where("id > 2"), "last")
    assert last.count() == 2 and not os.path.exists(first.inputFiles()[0].removeprefix("file:"))
    assert spark.conf.get(common._FREED, "false") == "false"

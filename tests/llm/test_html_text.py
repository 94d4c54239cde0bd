import random

import pytest
from tessera.llm import html_text as H

ARTICLE = "<article><h1>Title &amp; more</h1><p>First <b>bo</b>ld&nbsp;text.<br>next<p>Second   para\n\tgraph</article>"


def text_of(spark, rows):
    df = spark.createDataFrame([(i, u, x, 1) for i, (u, x) in enumerate(rows)], "page_id long, url string, html string, text int")
    out = H.extract_main_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = {r["page_id"]: r for r in out.collect()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    return [got[i]["text"] for i in range(len(rows))]


def alone(html):
    return " ".join(H.difference(H.read_page(html), []))


def test_article_without_its_surroundings():
    page = (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<header>Site</header><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- <p>no --><div class='ad box'>Buy</div>"
            f"<div id=cookie-notice>We use</div>{ARTICLE}<aside>Side</aside><form><p>Mail<input></form>"
            f"<section class=comments><article class=comment><p>Nice!</article></section><footer>&copy; x</footer></body></html>")
    assert alone(page) == "Title & more First bold text. next Second para graph"


@pytest.mark.parametrize("inner", ["<nav>x</nav>", "<aside><p>x</aside>", "<div class='share-bar'>x</div>", "<script>x</script>",
                                   "<div id='comments'><p>x<p>y</div>", "<form>x</form>", "<div role=navigation>x</div>",
                                   "<p hidden>x</p>", "<textarea>x</textarea>", "<div class=advert>x<div>y</div>z</div>"])
def test_boilerplate_inside_the_article(inner):
    assert alone(f"<article><p>a</p>{inner}<p>b</p></article>") == "a b"


def test_broken_markup():
    assert alone(None or "") == "" and alone("plain & simple &lt;b&gt; &#65;&#x42; &unknown; &amp") == "plain & simple <b> AB &unknown; &"
    assert alone("<article><p>cut off in a ta<b") == "cut off in a ta"
    assert alone("<article><p>a</p><p title='x>y'>b</p><p class=\"unclosed>c</p>") .startswith("a b")
    assert alone("<article></div></p>a<li>b<li>c</article>") == "a b c"
    assert alone("<script>never closed <p>x") == ""
    assert alone("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>x</article>") == "deep x"


def test_shared_lines_of_the_nearest_page_go(spark):
    def page(body, tail="Imprint of the site"):
        return f"<body><div>Top of the site</div><div><p>{body}</p></div><div>{tail}</div></body>"

    rows = [("http://a.org/x/1", page("one alpha")), ("http://a.org/x/2", page("two beta")),
            ("http://a.org/y/1", page("three", "Other imprint")), ("http://b.org/x/1", page("four")),
            (None, page("five")), ("http://a.org/x/1", page("six"))]
    got = text_of(spark, rows)
    assert got[0] == "one alpha" and got[1] == "two beta" and got[5] == "six"
    assert got[2] == "three Other imprint"                              # its neighbour shares the top line only
    assert got[3] == "Top of the site four Imprint of the site" and "five" in got[4]


def test_copies_keep_their_text(spark):
    html = "<body><div>Top</div><p>the very same long text on two pages</p></body>"
    art = "<body><div>Top</div>" + ARTICLE + "</body>"
    rows = [("http://a.org/1", html), ("http://a.org/2", html), ("http://c.org/1", art), ("http://c.org/2", art)]
    got = text_of(spark, rows)
    assert got[0] == got[1] == "Top the very same long text on two pages"
    assert got[2] == got[3] == "Title & more First bold text. next Second para graph"


def test_whole_table_gives_the_article_text(spark):
    """The test pages wrap their text in one article element; a plain reading of it must agree."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(pages).collect()}
    for r in pages.collect():
        x = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S).group(1)
        x = re.sub(r"<[^>]*(>|\Z)", " ", re.sub(r"</?b>", "", x))
        assert got[r["page_id"]] == " ".join(html.unescape(x).split())


def test_longest_common_subsequence():
    rng = random.Random(5)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(30))] for _ in range(2))
        for cells in (1 << 22, 20):                       # in one table, and divided
            at = H.lcs(a, b, cells)
            assert at == sorted(set(at)) and len(at) == length(a, b)
            it = iter(b)
            assert all(any(a[i] == y for y in it) for i in at)


def test_a_large_host_is_dealt_into_parts(spark):
    rows = [(i, f"http://a.org/{i % 7}/{i}", f"<body><div>Top of all pages</div><p>text {i}</p></body>") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (10, 1000):
        got = {r["page_id"]: r["text"] for r in H.extract_main_text(df, part_pages=size).collect()}
        assert got == {i: f"text {i}" for i in range(200)}


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None), ("http://a.org/", None), ("http://a.org/", ""), ("no host", "<p>x"), ("http://a.org/", "")]
    assert text_of(spark, rows) == ["", "", "", "x", ""]
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.extract_main_text(none).count() == 0


def test_differencing_judges_every_line_of_article_pages(spark):
    def page(i, note):
        return (f"<body><nav><ul><li>Home<li>News</ul></nav><div>Edition of the day</div><article><h1>Title {i}</h1>"
                f"<p>body {i} of the page</article><div>{note}</div><footer>Imprint</footer></body>")

    rows = [(i, f"http://a.org/x/{i}", page(i, f"by author {i}")) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Title {i} body {i} of the page by author {i}" for i in range(4)}      # not the markup's verdict
    for markup in (True, False):
        assert {r["page_id"]: r["text"] for r in H.extract_main_text(df, markup=markup).collect()} == want


def test_differencing_alone_on_the_tables(spark):
    """With the markup off, the lines that the nearest page shares go, whatever element holds them."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    alone = {r["page_id"]: r["text"] for r in H.extract_main_text(pages, markup=False).collect()}
    checked = {r["page_id"]: r["text"] for r in H.extract_main_text(pages).collect()}
    assert len(alone) == len(checked) and sum(alone[k] != checked[k] for k in alone) > 0.9 * len(alone)
    assert sum(set(checked[k].split()) <= set(alone[k].split()) for k in alone) >= 0.9 * len(alone)


@pytest.mark.parametrize("size", [1, 10, 1000])
def test_pages_of_a_large_host_meet_their_true_neighbours(spark, size):
    rows = [(i, f"http://a.org/{i // 2:03}/{i}", f"<body><div>Top of section {i // 2}</div><p>text {i}</p></body>") for i in range(200)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(df, part_pages=size).collect()}
    assert got == {i: f"text {i}" for i in range(200)}       # only the path's neighbour shares the section's line


@pytest.mark.parametrize("size", [1, 1000])
def test_runs_of_copies_lose_the_template(spark, size):
    def page(*body):
        return "<body><div>Top of the site</div>" + "".join(f"<p>{b}</p>" for b in body) + "</body>"

    long = "the very same long text " * 20
    rows = [(f"http://a.org/b?utm={i}", page("equal text")) for i in range(5)] + [("http://a.org/b", page("equal text"))] * 3
    rows += [(f"http://a.org/c/{i:02}", page(long, f"v{i:02}")) for i in range(12)] + [("http://a.org/d", page("another"))]
    rows += [(f"http://b.org/c/{i:02}", page(long, f"v{i:02}")) for i in range(12)]                # nothing but copies
    df = spark.createDataFrame([(i, u, x) for i, (u, x) in enumerate(rows)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(df, part_pages=size).collect()}
    copies = [f"{long.strip()} v{i:02}" for i in range(12)]
    assert [got[i] for i in range(len(rows))] == ["equal text"] * 8 + copies + ["another"] + ["Top of the site " + t for t in copies]

from __future__ import annotations

import time

import pytest

from tollgate.llm import wrapper
from tollgate.llm.catalog import QUERIES
from tollgate.llm.dom import Page

PAGES = "page_id long, url string, html string"


def text(html: str) -> str:
    return "\n".join(t for _, t in Page(html).article())


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a\n  b&nbsp;c</p><p>d</p>", "a b c\nd"),
        ("<p>one<p>two<div>three</div>four", "one\ntwo\nthree\nfour"),
        ("<p><b>bold<br>next<p>more", "bold next\nmore"),
        ("<ul><li>x<li>y</ul>", "x\ny"),
        ("a<script>if (a<b) '</p>'</script>b<style>p{}</style>", "ab"),
        ("x<!-- <p>no</p> -->y", "xy"),
        ("&#x41;&#66;&eacute;&lt;b&gt;&amp;lt;", "ABé<b>&lt;"),
        ("<nav>n</nav><article><h1>T</h1><p>body</p></article><footer>f</footer>", "T\nbody"),
        ("<article><header><h1>T</h1><span>by X</span></header><p>b</p><aside>s</aside><form>q</form></article>", "T\nb"),
        ("<div class='cookie-notice'>c</div><main><p>m</p><div id=comments><p>reader</p></div></main>", "m"),
        ("<header>site</header><div>body</div><div role=navigation>n</div>", "body"),
        ("<p hidden>h</p><p style='display: none'>i</p><p aria-hidden='true'>j</p>k", "k"),
        ("1 < 2 and <3", "1 < 2 and <3"),
        ("<p title='a > b'>t</p>", "t"),
        ("<a href=\"x'>y</a>", "y"),
        ("<textarea>t</textarea><select><option>o</select>z", "z"),
        ("</p></div>q", "q"),
        ("<script>never closed", ""),
        ("<div class='content-sidebar-wrap'><main><p>m</p></main><div class='sidebar'>s</div></div>", "m"),
        ("<body class='page has-sidebar'><div class='has-sidebar'><p>x</p></div></body>", "x"),
        ("<article class='post comments-open'><p>y</p></article>", "y"),
        ("<div class='layout sidebar'><article><p>the story</p></article></div><p>other</p>", "the story"),
        ("<main><h1>Head</h1><p>The long text of this page.</p><article class='card'>Teaser</article></main>", "Head\nThe long text of this page.\nTeaser"),
        ("<main><p>m</p><div id='comments'><article class='comment-body'>what a reader has to say, at length</article></div></main>", "m"),
        ("<div id='widget-area'><p>nearly all of the text of this page</p></div><p>rest</p>", "nearly all of the text of this page\nrest"),
        ("<div class='ad-box'>a long advert beside an article</div><article>short</article>", "short"),
        ("<div class='cookie-notice'>c</div><div class='post-comments'>r</div><p>body of the page</p>", "body of the page"),
        ("<![CDATA[a < b]]><![CDATA[>x", "a < bx"),
    ],
)
def test_blocks(html, expected):
    assert text(html) == expected


def test_deep_and_broken():
    assert text("<div>" * 20_000 + "deep") == "deep"
    assert text("<" * 50_000).count("<") == 50_000
    assert text("<a b='" + "x" * 50_000) != ""


@pytest.mark.parametrize("make", [
    lambda n: "<div>" * n, lambda n: '<a "' * n, lambda n: "<a '>" * n + "'", lambda n: "<![CDATA[>" * n, lambda n: "<p><b>" * n, lambda n: "<" * n,
    lambda n: "<li><td>" * n, lambda n: "<div class=sidebar>x" * n, lambda n: "<article>x<div class=ad>" * n, lambda n: "<!--" * n + ">",
])
def test_time_follows_length(make):
    """Twice the page takes about twice the time, not four times (with room for a busy machine)."""
    def seconds(n: int) -> float:
        start = time.process_time()
        Page(make(n)).article()
        return time.process_time() - start

    assert min(seconds(24_000) for _ in range(2)) < 0.5 + 3.2 * min(seconds(12_000) for _ in range(3))


def test_align_and_merge():
    one = wrapper.Tree([-1, 0, 0, 2, 2], ["#", "nav", "div", "h1", "p"])
    two = wrapper.Tree([-1, 0, 0, 2, 2, 2], ["#", "div", "div", "h1", "img", "p"])
    assert wrapper.align(one, two) == {0: 0, 2: 2, 3: 3, 5: 4}
    wrapper.merge(one, two)
    assert one.flat()[1] == ["#", "nav", "div", "div", "h1", "img", "p"] or one.flat()[1] == ["#", "div", "nav", "div", "h1", "img", "p"]
    assert len(wrapper.align(one, two)) == 6


def made_page(i: int, extra: str = "", title: str | None = None, body: str | None = None) -> str:
    """Without article or main: only the host's other pages tell the offer and the terms from the story."""
    return (
        f"<body><div>Always the same offer</div><div><h1>{title or f'Title {i}'}</h1><p>{body or f'Story {i} of the day'}</p>"
        f"{extra}<p>Read our terms</p></div></body>"
    )


def test_template_of_a_host(spark):
    listed = lambda i: "<ul><li>x</li></ul>" if i % 3 == 0 else ""  # noqa: E731  (the same item on a third of the pages: content)
    rare = lambda i: "<h2>Background</h2>" if i < 5 else ""
    rows = [(i, f"https://Host.example.com/{i}", made_page(i, listed(i) + rare(i))) for i in range(150)]
    rows += [(1000 + i, "https://small.example.com/", made_page(7)) for i in range(5)]  # copies of one page
    rows += [(2000, None, None), (2001, "", ""), (2002, "nohost", made_page(1)), (None, "https://host.example.com/0", made_page(0, listed(0) + rare(0)))]
    found = {r["page_id"]: (r["text"], r["n_template"]) for r in wrapper.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(found) == len(rows)
    for i in range(150):
        blocks = [f"Title {i}", f"Story {i} of the day", *(["x"] if i % 3 == 0 else []), *(["Background"] if i < 5 else [])]
        assert found[i] == ("\n".join(blocks), 2)
    assert found[None] == found[0]
    assert found[1000] == ("Always the same offer\nTitle 7\nStory 7 of the day\nRead our terms", 0)
    assert found[2000] == found[2001] == ("", 0) and "Title 1" in found[2002][0]


def test_near_copies_are_one_page(spark):
    """One article with small changes fills most of a host; its paragraphs are still content."""
    same = "".join(f"<p>Paragraph {n} of the article that everybody copies</p>" for n in range(12))
    near = [(i, "https://copies.example.com/", f"<body><div>{same}<p>Changed {i}</p></div></body>") for i in range(80)]
    other = [(100 + i, "https://copies.example.com/", f"<body><div><p>Quite another story {i}</p><p>with its own end {i}</p></div></body>") for i in range(20)]
    found = {r["page_id"]: r["text"] for r in wrapper.main_text(spark.createDataFrame(near + other, PAGES)).collect()}
    whole = "\n".join(f"Paragraph {n} of the article that everybody copies" for n in range(12))
    assert all(found[i] == f"{whole}\nChanged {i}" for i in range(80))
    assert found[103] == "Quite another story 3\nwith its own end 3"


def test_query_on_generated_hosts(spark, tmp_path):
    """The whole query against the texts the pages were made of: hosts with and without an article element, every kind of noise around."""
    rows, expected = [], {}
    for host in range(4):
        for i in range(40):
            number = host * 100 + i
            blocks = [f"Head {number}", f"First words of {number} &amp; more", f"Last  words\nof {number}"]
            inside = f"<h1>{blocks[0]}</h1><p>{blocks[1]}</p><div><p>{blocks[2]}</p></div>"
            story = f"<article>{inside}</article>" if host % 2 else f"<div class='story'>{inside}</div>"
            frame = "<nav><a href='/'>Home</a></nav><div class='promo-box'>Buy</div>" if host < 2 else f"<div>Site {host} slogan</div>"
            end = f"<div>Imprint of host {host}</div><div id='comments'><p>Reader {i}</p></div><script>var x = '<p>{i}</p>';</script><footer>F</footer>"
            rows.append((number, f"https://h{host}.example.org/{i}", f"<html><head><title>T</title></head><body>{frame}{story}{end}</body></html>"))
            expected[number] = "\n".join(" ".join(b.replace("&amp;", "&").split()) for b in blocks)
    spark.createDataFrame(rows, PAGES).write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["op2_wrapper_text"](spark, str(tmp_path)).collect()
    assert {r["page_id"]: r["text"] for r in got} == expected and len(got) == 160
    assert all(r["n_chars"] == len(r["text"]) and r["url"] for r in got)
    assert {r["page_id"] // 100: r["n_template"] for r in got} == {0: 1, 1: 0, 2: 2, 3: 0}


def test_odd_columns(spark):
    """Clashing extra columns; null ids beside texts of equal hash."""
    frame = spark.createDataFrame([(None, "u", "<p>a</p>"), (None, "u", "<p>a</p>"), (1, None, None), (1, "u", "<p>b</p>")], PAGES)
    for name in ("host", "tree", "slot", "digest", "html_hash", "place", "drop", "sign", "p", "h", "text"):
        frame = frame.withColumn(name, frame["url"])
    got = wrapper.main_text(frame).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got) == [(0, "a"), (0, "a"), (1, ""), (1, "b")]


def test_empty(spark):
    assert wrapper.main_text(spark.createDataFrame([], PAGES)).count() == 0

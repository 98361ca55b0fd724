import pytest
from conftest import rows

from trendloom.sources import selectors, texts

RSS = "<?xml version='1.0'?><rss><channel><title>c</title><item><title>A &amp; B</title></item><item><title/></item><item><link/></item></channel></rss>"
ATOM = "<feed xmlns='http://www.w3.org/2005/Atom'><title>f</title><entry><title>E1</title></entry><entry><title>E2</title></entry></feed>"


def test_feeds(spark):
    feeds = spark.createDataFrame(
        [("r", "u1", RSS), ("a", "d2.example", ATOM), ("x", "u2", ATOM), ("bad", "u3", "<rss><channel>"), ("none", "u4", None), ("e", "u5", "")],
        "source string, url string, xml string",
    )
    assert rows(texts.feed_titles(feeds), "source", "title") == [("a", "E1"), ("a", "E2"), ("r", "A & B"), ("x", "E1"), ("x", "E2")]
    marked = texts.feed_titles(feeds, ["d2.example"])
    assert rows(marked, "source", "title") == [("a", "E1"), ("a", "E2"), ("r", "A & B")]


PAGE = """<html><body><table><tr class="row main"><td class="name"><a href=x> One &lt;b&gt; <b>bold</b></a>
<a>second</a></td></tr><tr class=row><td class="name wide"><br><img src=y><a></a><a>Two</a></td></tr></table>
<p>unclosed<p>again<a>outside</a></body>"""


def test_pages(spark):
    pages = spark.createDataFrame([("s", "u", PAGE), ("s", "v", None), ("s", "w", "<<<>")], "source string, url string, html string")
    first = texts.page_titles(pages, [".main .name a", "tr.row .name a"])
    assert rows(first, "pos", "title") == [(0, "One <b> bold"), (1, "second")]
    second = texts.page_titles(pages, ["tr.missing a", "tr.row .name a"])
    assert rows(second, "title") == [("One <b> bold",), ("Two",), ("second",)]
    assert rows(texts.page_titles(pages, ["tr.row .name a"], per_page=1), "title") == [("One <b> bold",)]


OPEN = """<ul id=top><li class="x y">a<ul><li>b<li>c</ul>d<li class=y><script>s</script>e <p>f<div>g</div></ul>
<table><tr><td>1<td><a>2</a><table><tr><td>3</table><tr class=r><td>4<td>5<tbody><tr><td data-k="v w">6</table>
<p>h<p>i<ul><li>j</ul>k</p><select><optgroup><option>o1<option>o2<optgroup><option>o3</select>"""


@pytest.mark.parametrize(
    "selector, expected",
    [
        ("li", ["abcd", "b", "c", "e fg", "j"]),
        ("li li", ["b", "c"]),
        ("#top > li", ["abcd", "e fg"]),
        ("ul ul > li, li.y.x", ["abcd", "b", "c"]),
        (".y div", ["g"]),
        ("p", ["f", "h", "i"]),
        ("tr > td", ["1", "23", "3", "4", "5", "6"]),
        ("td td", ["3"]),
        ("table table tr", ["3"]),
        ("tr.r td, [data-k='v w']", ["4", "5", "6"]),
        ("[class=y] *", ["s", "f", "g"]),
        ("option", ["o1", "o2", "o3"]),
        ("select > optgroup", ["o1o2", "o3"]),
        ("ul > ul", []),
    ],
)
def test_selectors_on_pages_with_open_ends(selector, expected):
    found = selectors.find(OPEN, [selectors.compile_selector(selector)])
    assert [f.text for f in found] == expected


@pytest.mark.parametrize("bad", ["", "a,", "> a", "a >", "a > > b", "a:hover", "a + b", "a[", "a ~ b"])
def test_selectors_that_are_not_supported(bad):
    with pytest.raises(ValueError):
        selectors.compile_selector(bad)


def test_rows_then_cells(spark):
    pages = spark.createDataFrame([("u", PAGE), ("v", None), ("w", OPEN)], "url string, html string")
    got = texts.page_rows(pages, ["tr.missing", "tr"], ".name > a, td a")
    assert rows(got) == [("u", 0, "One <b> bold"), ("w", 0, "2")]
    assert rows(texts.page_rows(pages, ["tr"], "td"), "url", "pos", "title") == [
        ("u", 0, "One <b> bold\nsecond"), ("u", 1, "Two"), ("w", 0, "1"), ("w", 1, "3"), ("w", 2, "4"), ("w", 3, "6")
    ]
    assert rows(texts.page_rows(pages, ["tr"], "td", per_page=1), "url", "pos") == [("u", 0), ("w", 0)]
    deep = "<div>" * 3000 + "<p class=t>x"
    assert [f.text for f in selectors.find(deep, [selectors.compile_selector("div div > p.t")])] == ["x"]


def test_replies(spark):
    reply = "```csv\nkeyword\n그래프 DB,\n\n  양자 내성 암호, \n}} done\nEdge chip }} tail\n로봇 팔\n```"
    df = spark.createDataFrame([(1, reply), (2, None), (3, "")], "reply_id long, text string")
    assert rows(texts.keyword_replies(df), "reply_id", "keyword") == sorted((1, k) for k in ["그래프 DB", "양자 내성 암호", "Edge chip", "로봇 팔"])

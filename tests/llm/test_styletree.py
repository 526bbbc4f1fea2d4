import html
import re

import pytest

from zonecast.llm import styletree as s


def text_of(source, importance=None):
    return "\n".join(s.kept_blocks(s.Page(source), importance or {}))


def test_blocks_entities_and_broken_markup():
    src = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body><nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad big">buy</div>
<article><h1>Head &amp; more&amp</h1><p><b>One  two&nbsp;three.<br><p>Four</p><ul><li>a<li>b &lt;c&gt;</ul>loose text
<div id="comments"><p>first!</p></div><p title="a>b" hidden>secret</p><pre>x
  y</pre><form><p>form</p></form></article><footer>&copy; me</footer></body></html>"""
    assert text_of(src) == "Head & more&\nOne two three.\nFour\na\nb <c>\nloose text\nx y"


@pytest.mark.parametrize("src", ["", "<", "<p", "a < b", "<!-- never closed <p>x</p>", "<script>x", "</p></div>", "<p>" * 30000 + "x", "<div>" * 30000 + "x" + "</div>" * 30000, '<p a="' * 20000, "<b>" * 20000 + "x", "&amp" * 1000, "<p a='x<p>y"])
def test_odd_input_is_read_in_linear_time(src):
    text_of(src)


def test_deep_text_survives():
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text_of("a < b <p>c</p>") == "a < b\nc"


def test_entropy_decides_without_tags(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"https://h.example/{i}", f"<body><div class=xa><p>Always the same line</p></div><div class=xb><p>Story {i} tells of {i * 7}</p><p>More {i}</p></div><div class=xc>same end</div></body>"))
    rows += [(100, "https://other.example/", "<body><div class=xa><p>Always the same line</p></div><div class=xb><p>An only page here, quite long</p></div></body>"), (101, None, None), (102, "https://h.example/e", ""), (0, "https://h.example/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as key", "'t' as text")
    got = {}
    for r in s.main_texts(pages).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert got[3] == ["Story 3 tells of 21\nMore 3"] and len(got[0]) == 2
    assert got[100] == ["An only page here, quite long"]  # its own host is too small; the place is judged over all hosts
    assert got[101] == [""] and got[102] == [""]
    assert s.main_texts(pages.limit(0)).count() == 0


def test_copies_of_an_article_stay(spark):
    page = "<body><nav>menu</nav><article><h1>T</h1><p>One text, printed often.</p></article></body>"
    pages = spark.createDataFrame([(i, "http://a.example/x", page) for i in range(50)], "page_id long, url string, html string")
    assert {r.text for r in s.main_texts(pages).collect()} == {"T\nOne text, printed often."}


def test_importance_equals_brute_force(spark):
    from collections import Counter
    from math import log

    rows = [(i, f"http://h{i % 2}.example/", f"<div><p>{'same' if i % 3 else i}</p></div>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.host, r.key, r.content): (r.m, r.importance) for r in s.style_trees(pages).collect()}
    for h in range(2):
        texts = Counter("same" if i % 3 else str(i) for i in range(h, 40, 2))
        m = sum(texts.values())
        want = -sum(c / m * log(c / m) for c in texts.values()) / log(m)
        key = s.Page(rows[0][2]).key[2]
        assert got[f"h{h}.example", key, True] == (m, pytest.approx(want))


def plain(source):
    """The given pages' form: all blocks of the article."""
    body = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", body)
    return "\n".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks) if t)


def test_query_equals_plain_form(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in s.main_texts(pages).collect():
        assert r.text == plain(source[r.page_id])


def texts_of(spark, sources, host="h.example"):
    pages = spark.createDataFrame([(i, f"http://{host}/{i}", src) for i, src in enumerate(sources)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in s.main_texts(pages).collect()}


def test_words_never_remove_the_article():
    for wrapped in ('<form id="aspnetForm"><nav>menu</nav><article><p>Story</p></article><footer>end</footer></form>', "<nav>menu</nav><main class='has-sidebar'><p>Story</p></main>", "<div class='no-sidebar'><div class=banner><main><p>Story</p></main></div><div class=ad>buy</div></div>"):
        assert text_of(f"<body>{wrapped}</body>") == "Story"
    assert text_of("<body><form><p>All of the page's text is here</p></form><nav>menu</nav></body>") == "All of the page's text is here"
    assert text_of("<body><div hidden><article>never shown</article></div><p>Seen</p></body>") == "Seen"


def test_importance_removes_unclassed_boilerplate(spark):
    note = "This same line of terms closes every article."
    got = texts_of(spark, [f"<article><h1>Head {i}</h1><p>Story {i} tells of {i * 7}, and of much more than that, as stories do</p><div class=xk>{note}</div></article>" for i in range(40)])
    assert got[3] == "Head 3\nStory 3 tells of 21, and of much more than that, as stories do"
    # most of the page's text, without article
    got = texts_of(spark, [f"<body><div class=xa>{note} {note}</div><div class=xb><p>Story {i}</p></div></body>" for i in range(40)])
    assert got[3] == "Story 3"
    # copies can't be told from boilerplate where they are all there is
    assert set(texts_of(spark, ["<body><div class=xa><p>One text, printed often.</p></div><footer>f</footer></body>"] * 40).values()) == {"One text, printed often."}


def test_importance_outvotes_words_where_no_article_tells(spark):
    same = "The same words stand here on each of the pages, at some length."
    got = texts_of(spark, [f"<body><div class=xa>{same}</div><div class=widget><p>Story {i}</p></div><div class=share>tell others</div></body>" for i in range(40)])
    assert got[3] == "Story 3"
    got = texts_of(spark, [f"<article><p>Story {i}, which is rather longer than all the rest</p><div class=promotion>Part {i} of it</div><div class=share>tell others</div></article><footer>of {i}</footer>" for i in range(40)])
    assert got[3] == "Story 3, which is rather longer than all the rest"  # promotion and share go by their names


def test_copies_do_not_lower_importance(spark):
    many = "<article><h1>T</h1><p>One text, printed often, with a head and a foot.</p><div class=xk>Its own foot</div></article>"
    others = [f"<article><h1>T{i}</h1><p>Story {i} which is long enough for an article</p><div class=xk>Foot {i}</div></article>" for i in range(12)]
    got = texts_of(spark, [many] * 200 + others)
    assert got[0] == "T\nOne text, printed often, with a head and a foot.\nIts own foot"
    assert got[205] == "T5\nStory 5 which is long enough for an article\nFoot 5"


def test_named_branches_go_where_they_vary_too(spark):
    """Comments, adverts, notices, side bars and footers that differ from page to page."""
    extra = "<section class=comments><p>Reader {i} says: I liked part {k}</p></section><div class=ad>Buy thing {k} now</div><p class=notice>Notice {i}</p>"
    fill = lambda t, i: t.replace("{i}", str(i)).replace("{k}", str(i * 7))
    got = texts_of(spark, [fill("<body><article><h1>Head {i}</h1><p>Story {i} goes on</p>" + extra + "</article><article class=comment><p>I am {i}</p></article><aside><article><p>Other {i}</p></article></aside></body>", i) for i in range(60)])
    assert all(got[i] == f"Head {i}\nStory {i} goes on" for i in range(60))
    got = texts_of(spark, [fill("<body><div id=top><h1>Head {i}</h1><p>Story {i} goes on</p></div>" + extra + "<div class=sidebar>Latest {i}</div><footer>Printed {k} times</footer></body>", i) for i in range(60)], "b.example")
    assert all(got[i] == f"Head {i}\nStory {i} goes on" for i in range(60))


def test_style_trees_decide_about_unnamed_branches(spark):
    """Without the trees the result of these pages is another one."""
    sources = [f"<body><div class=q1>Start Contact Terms of use</div><div class=q2><h1>Head {i}</h1><p>Story {i} tells of {i * 7} and more</p><div class=q3>Printed with permission, all rights kept</div></div><div class=q4>More from this house</div></body>" for i in range(40)]
    got = texts_of(spark, sources)
    assert all(got[i] == f"Head {i}\nStory {i} tells of {i * 7} and more" for i in range(40))
    assert text_of(sources[3]) != got[3]


@pytest.mark.parametrize("src,want", [
    ("<html><head><title>T</title><body><article><p>Kept</p></article>", "Kept"),
    ("<head><meta charset=x><p>Kept", "Kept"),
    ("<head><title>T</title>Loose text<p>b", "Loose text\nb"),
    ('<article><div title="The hidden valley"><p>Kept</p></div></article>', "Kept"),
    ('<article data-tags="open hidden" data-class="ad"><p alt=\'class="ad"\'>Kept</p></article>', "Kept"),
    ('<article><p data-x="<div class=ad>a > b">Kept</p></article>', "Kept"),
    ("<article><p title=John's>One</p><p>don't</p></article>", "One\ndon't"),
    ("<article><svg/><p>One</p><iframe src=x /><p>Two</p><svg><path/><text>no</text></svg><p>Three</p></article>", "One\nTwo\nThree"),
    ("<article><p>One</p><iframe src=x><p>Two</p></article>", "One\nTwo"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl><p>f<div>g</div></article>", "a\nb\nc\nd\ne\nf\ng"),
    ("<article><div class=has-sidebar><p>One</p></div><div class=post-with-ads><p>Two</p></div><div class=main-ads>buy</div></article>", "One\nTwo"),
    ("<article><header><h1>Title</h1></header><p>One</p><footer>me</footer></article><header>Site</header>", "Title\nOne"),
    ('<article><p style="color:red; display : none">no</p><p HIDDEN>no</p><p hidden="">no</p><p Class="AD">no</p><p>One</p></article>', "One"),
    ("<div role=main><p>One</p></div><div role=contentinfo>no</div><ul id=nav><li>no</ul>", "One"),
])
def test_markup_cases(src, want):
    assert text_of(src) == want

"""Page differencing: lines, alignment, neighbours and whole pages."""

import random
import re

from millrace.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/{n}">menu {n}</a></li></ul></nav><!-- c --><div class="ad">buy {n}</div><header>Site</header>
<article><h1>Title {n} &amp; more</h1><p><b>first  {n}
line<br><p>second &lt;{n}&gt;</p><form>name</form><div class="comments"><p>reader {n}</p></div></article>
<aside>side {n}</aside><footer>&copy; site {n}</footer>"""


def test_page():
    for n in (1, 2):
        for partner in (None, pages.line_keys(pages.page_lines(PAGE.format(n=3 - n)))[0]):
            assert pages.main_text(PAGE.format(n=n), partner) == f"Title {n} & more\nfirst {n} line\nsecond <{n}>"


def test_differencing_without_article():
    page = "<body><div>Welcome to us</div><p>story %s</p><p>more of %s here</p><div>All rights reserved</div>"
    keys = lambda x: pages.line_keys(pages.page_lines(page % (x, x)))[0]
    assert pages.main_text(page % ("a", "a"), keys("b")) == "story a\nmore of a here"
    assert pages.main_text(page % ("a", "a"), keys("a")).count("\n") == 3
    assert pages.main_text(page % ("a", "a"), None).count("\n") == 3


def test_odd_markup():
    for source, text in [
        ("", ""), ("plain  text", "plain text"), ("a < b & c", "a < b & c"), ("<p>x<script>never closed", "x"),
        ("<p>a<!-- open", "a"), ("<p class='ad'>no<p>yes", "yes"), ("<div><p>a</div>b</div>c", "a\nb\nc"),
        ("<p>&#233;&eacute;&nope;&nbsp;x", "éé&nope; x"), ("<td>a<td>b<tr>c", "a b\nc"), ("<p title='a>b'>c", "c"),
        ("<P>A<BR/>B</P><STYLE>x</style>", "A B"), ("<head><p>h<body>x", "x"), ("<", "<"), ("<p", "<p"),
    ]:
        assert pages.main_text(source, None) == text, source
    assert len(pages.main_text("<p>word " * 50_000, None).split()) == 50_000


def test_class_names_around_the_article():
    keys = lambda x: pages.line_keys(pages.page_lines(x))[0]
    for shell in (
        "<body class='no-sidebar'><article>%s</article>", "<body class='right-sidebar menu'><article>%s</article>",
        "<div id='content-sidebar-wrap'><article>%s</article></div>", "<article class='post comments-open'>%s</article>",
        "<div class='menu-closed'><p>%s</p></div>", "<div class='sidebar'><main class='menu'>%s</main></div>",
        "<form><article>%s</article></form>", "<body class='comments'><p>%s</p>",
    ):
        page = lambda n: "<nav>home</nav>" + shell % f"<p>story {n} <p>and more {n}"  # noqa: E731, B023
        assert pages.main_text(page(1), keys(page(2))) == "story 1\nand more 1", shell
        assert pages.main_text(page(1), None) == "story 1\nand more 1", shell


def test_the_neighbour_decides():
    keys = lambda x: pages.line_keys(pages.page_lines(x))[0]
    page = "<p>Site</p><div>body %s is here</div><article>teaser %s</article>"
    assert pages.main_text(page % (1, 1), keys(page % (2, 2))) == "body 1 is here\nteaser 1"
    with_ad = "<nav>menu</nav><div class='ad'>buy</div><article>own words %s</article><div class='related'><article>t</article></div>"
    without = "<nav>other</nav><article>own words %s</article>"
    assert pages.main_text(with_ad % 1, keys(with_ad % 2)) == "own words 1"
    assert pages.main_text(with_ad % 1, keys(without % 2)) == "buy\nown words 1\nt"


def longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        found = sorted(pages.shared(a, b))
        assert len(found) == longest(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_table(spark):
    rows = []
    body = "<div>Top of %s</div><p>story %s has words of its own</p><div>Bottom</div>"
    for i in range(300):
        host = f"h{i % 3}.net" if i % 4 else "hot.net"
        rows.append((i, f"http://{host}/d{i % 7}/{i}", body % (host, i)))
    rows += [(900, None, None), (901, "http://alone.org/x", body % ("alone", 1)), (902, "no host", PAGE.format(n=1)), (903, "http://x.y/", "")]
    rows += [rows[5], rows[5], (None, "http://hot.net/zz", body % ("hot.net", "null"))]
    table = spark.createDataFrame([(*r, "t", [1], "x") for r in rows], "page_id long, url string, html string, text string, keys array<int>, host string")
    got = pages.extract(table.repartition(6)).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r.text for r in got}
    assert all(by_id[i] == f"story {i} has words of its own" for i in range(300) if i != 5)
    assert by_id[None] == "story null has words of its own" and by_id[900] == "" and by_id[903] == ""
    assert by_id[901] == "Top of alone\nstory 1 has words of its own\nBottom"
    assert re.match("Title 1", by_id[902])
    again = pages.extract(table.coalesce(1)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert pages.extract(table.limit(0)).count() == 0


def test_long_shared_lines_beside_a_short_story():
    keys = lambda x: pages.line_keys(pages.page_lines(x))[0]
    long = "a very long line about this site and all that it offers to its readers every day " * 3
    page = f"<div>{long}</div><p>story %s</p><div>{long}</div>"
    assert pages.main_text(page % 1, keys(page % 2)) == "story 1"
    assert pages.main_text(page % 1, keys(page % 1)).count("story") == 1


def test_compound_names():
    keys = lambda x: pages.line_keys(pages.page_lines(x))[0]
    page = (
        "<div class='site-header'>head {n}</div><div id='main_nav'>go {n}</div><div class='x cookie-banner'>ok {n}</div>"
        "<article><h2 class='related'>Related work {n}</h2><p class='no-menu'>text {n}</p><div class='post-comments'>me {n}</div></article>"
        "<div class='site-footer'>foot {n}</div>"
    )
    for partner in (keys(page.format(n=2)), None):
        assert pages.main_text(page.format(n=1), partner) == "Related work 1\ntext 1"


def longest_common(a, b):
    """Places of a on the longest common subsequence that takes matches early, by the whole table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    return table[0][0]


def test_whole_hosts_without_class_names(spark):
    """All pages of three hosts against brute force: the nearest neighbour by path, and no line of the template left."""
    rng = random.Random(6)
    rows, own = [], {}
    for h in range(3):
        head = [f"Welcome to host {h}", "All our stories"]
        foot = ["All rights reserved", f"Written by the people of host {h}"]
        for n in range(40):
            path = f"/{rng.choice('ab')}/{rng.choice('cd')}/{n:02}"
            story = [f"story {h} {n} {k} " + " ".join(rng.choices("abcdefgh", k=5)) for k in range(rng.randint(1, 5))]
            lines = [*head, *story[:2], "Read on", *story[2:], *foot]
            page_id = 100 * h + n
            own[page_id] = (f"h{h}", path, lines, story)
            rows.append((page_id, f"http://h{h}{path}", "".join(f"<div>{x}</div>" for x in lines)))
    got = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    for page_id, (host, path, lines, story) in own.items():
        same_host = sorted((p, i) for i, (g, p, *_) in own.items() if g == host)
        place = same_host.index((path, page_id))
        around = [same_host[k] for k in (place - 1, place + 1) if 0 <= k < len(same_host)]
        alike = lambda p: next((i for i, (x, y) in enumerate(zip(p, path)) if x != y), min(len(p), len(path)))  # noqa: E731, B023
        nearest = own[max(around, key=lambda x: alike(x[0]))[1]][2]
        shared = longest_common(lines, nearest)
        assert got[page_id] == "\n".join(story)
        assert shared == len(lines) - len(story)  # all the template, and nothing else, is on the alignment
    alone = pages.extract(spark.createDataFrame([(1, "http://solo/x", rows[0][2])], "page_id long, url string, html string"))
    assert alone.first().text != got[0]  # without the neighbour the template stays

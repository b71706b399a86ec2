import random
import time

import pytest

from candlewick.llm import html

SCHEMA = "page_id long, url string, html string, text string, host int"


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("most", [1 << 29, 20])
def test_alignment_is_longest(monkeypatch, most):
    monkeypatch.setattr(html, "MATRIX_BITS", most)
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 14))] for _ in range(2))
        x, y = html.common_lines(a, b)
        assert len(x) == len(y) == lcs(a, b)
        assert [a[i] for i in x] == [b[j] for j in y] and x == sorted(set(x)) and y == sorted(set(y))


def texts(lines):
    return [t for t, k in lines if k != html.CHROME]


def test_lines_of_a_page():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><!-- <p>no</p> -->"
        "<div class='ad'>Buy</div><div id=cookie-notice>Cookies</div><article><header><h1>Title &amp; more</h1>"
        "</header><p><b>First\n  line<br>goes on<p>Second &lt;b&gt; &eacute;&nbsp;x</p><ul><li>one<li>two</ul>"
        "<form><p>Mail</p><input name=x></form><aside>Side</aside><div class='comments'><p>Nice!</p></div>"
        "<table><tr><td>a<td>b</table></article><section class='related'>More</section><footer>&copy; X</footer>"
    )
    assert texts(html.page_lines(page)) == [
        "Title & more", "First line goes on", "Second <b> é x", "one", "two", "a", "b",
    ]


def test_odd_markup():
    for source in ("", "<", "<<p>a", "<p a='", "</p></div>", "<script>x", "<!-- x", "<p>a<", "&#x110000; &", "<div" * 500):
        html.page_lines(source)
    assert texts(html.page_lines("<p>a <b>b</i> c</b><p>d")) == ["a b c", "d"]
    assert texts(html.page_lines("<p hidden>a</p><p style='display: none'>b</p><p>1 < 2 & 3</p>")) == ["1 < 2 & 3"]
    assert texts(html.page_lines("<P CLASS=x data-a='1 > 0'>a</P>")) == ["a"]
    assert len(texts(html.page_lines("<p>x y</p>" * 20_000))) == 20_000


def in_article(body):
    return texts(html.page_lines(f"<main><p>first</p>{body}</main>"))[1:]


def test_page_parts_inside_a_line():
    line = "<p>Buy <button>Click me</button> now <span style='display:none'>hidden</span></p>"
    assert in_article(line) == ["Buy now"]
    assert in_article("<p>a <span class='advert'>AD TEXT</span>b</p>") == ["a b"]
    assert in_article("<p>a<select><option>x<option>y</select> b <label>c</label></p>") == ["a b"]
    assert in_article("<p><a class='share-button'>Share</a></p>") == []
    assert in_article("<p>x <a class='button'>y</a> <i>z</i></p>") == ["x y z"]


def test_names_that_are_no_proof():
    for kept in (
        "<p class='notice-period'>a</p>",
        "<section class='related-work'><p>a</p></section>",
        "<p id='search'>a</p>",
        "<ul class='menu-items'><li>a</ul>",
        "<h2 id='comments'>a</h2>",
    ):
        assert in_article(kept) == ["a"]
    for gone in (
        "<div class='reader-reviews'><p>Great post!</p></div>",
        "<div class='post-comments'><p>a</p></div>",
        "<div id='cookie-notice'>a</div>",
        "<p class='notice'>a</p>",
        "<section id=comments><p>a</p></section>",
    ):
        assert in_article(gone) == []
    layout = "<body><div class='content sidebar-right'><article class='post sidebar-left'><p>a</p></article></div>"
    assert texts(html.page_lines(layout)) == ["a"]


@pytest.mark.parametrize(
    "source",
    ["<div>x" * 16_000, "<b>x" * 16_000 + "</i>" * 16_000, "<div>" * 16_000 + "x</section>" * 16_000,
     "<i><div>" + "<b>" * 16_000 + "</i>x" * 16_000, "<ul><li>x" * 16_000, "<p><span>x" * 16_000],
)
def test_deep_nesting_takes_linear_time(source):
    start = time.process_time()
    html.page_lines(source)
    assert time.process_time() - start < 1.5


def page(body, article=True):
    body = f"<article>{body}</article>" if article else body
    return f"<html><body><nav>menu</nav>{body}<footer>foot</footer></body></html>"


def test_differencing(spark):
    shared = "<p>the passage that many pages share</p>"
    plain = "<div>Welcome to our site</div><div>{}</div><div>Call us today</div>"
    rows = [
        (1, "http://a.org/x/1?p=2", page(f"<h1>One</h1>{shared}<div>Follow us</div>")),
        (2, "http://a.org/x/2#top", page(f"<h1>Two</h1>{shared}<div>Follow us</div>")),
        (3, "https://b.org/1", page(plain.format("first story"), False)),
        (4, "https://b.org/2", page(plain.format("second story"), False)),
        (5, "https://b.org/3", page(plain.format("second story"), False)),
        (6, "https://c.org/1", page("<p>alone</p>", False)), (7, None, page("<p>no url</p>")), (8, "odd", None),
        (9, "http://d.org/", ""), (None, "http://e.org", "text"),
    ]
    rows.insert(1, rows[0])  # a repeated row is the same page
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows], SCHEMA)
    got = sorted((str(r.page_id), r.url, r.text) for r in html.extract(frame).collect())
    kept = "the passage that many pages share"
    assert got == sorted([
        ("1", rows[0][1], f"One\n{kept}"), ("1", rows[0][1], f"One\n{kept}"),
        ("2", rows[2][1], f"Two\n{kept}"), ("3", rows[3][1], "first story"), ("4", rows[4][1], "second story"),
        ("5", rows[5][1], "Welcome to our site\nsecond story\nCall us today"), ("6", rows[6][1], "alone"),
        ("7", None, "no url"), ("8", "odd", ""), ("9", "http://d.org/", ""), ("None", "http://e.org", "text"),
    ], key=str)
    assert html.extract(frame.limit(0)).count() == 0


def test_repeated_rows_keep_the_differencing(spark):
    plain = "<div>Welcome to our site</div><div>story {}</div><div>Call us today</div>"
    rows = [(i, f"https://a.org/{i}", page(plain.format(i), False), "t", 1) for i in range(40)]
    frame = spark.createDataFrame(rows * 5, SCHEMA).repartition(7)
    got = [(r.page_id, r.text) for r in html.extract(frame).collect()]
    assert sorted(got) == sorted([(i, f"story {i}") for i in range(40)] * 5)


def test_copies_under_one_path_are_one_page(spark):
    plain = "<div>Welcome to our site</div><div>{}</div><div>Call us today</div>"
    rows = [(0, "https://a.org/1", page(plain.format("first"), False), "t", 1)]
    rows += [(i, f"https://a.org/2?v={i}", page(plain.format("second"), False), "t", 1) for i in range(1, 6)]
    rows += [(6, "https://a.org/3", page(plain.format("third"), False), "t", 1)]
    # Other markup and another menu, but the same lines outside page parts.
    rows += [(7, "https://a.org/2#x", page(plain.format("second"), False).replace("menu", "list"), "t", 1)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: "first", **{i: "second" for i in (1, 2, 3, 4, 5, 7)}, 6: "third"}


def test_page_of_boilerplate_only_is_empty(spark):
    frame, story = "<div>Welcome to our site</div>{}<div>Call us today</div>", "<div>a story</div>"
    rows = [(1, "https://a.org/1", page(frame.format(""), False), "t", 1),
            (2, "https://a.org/2", page(frame.format(story), False), "t", 1)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "", 2: "a story"}


def test_boilerplate_inside_articles(spark):
    ask, note = "<p>Subscribe to our letter</p>", "<li>We use cookies</li>"
    passage = "<p>a passage that two neighbours share</p>"
    rows = [(i, f"https://a.org/{i:02}", page(f"{note}<p>story {i}</p>{passage if 3 < i < 6 else ''}{ask}"), "t", 1)
            for i in range(12)]
    # An article with many copies does not make its own lines boilerplate.
    rows += [(20 + i, f"https://b.org/{i}", page("<p>copied</p>"), "t", 1) for i in range(6)]
    rows += [(30 + i, f"https://b.org/z{i}", page(f"<p>own {i}</p>"), "t", 1) for i in range(3)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    shared = "\na passage that two neighbours share"
    assert got == {
        **{i: f"story {i}{shared if 3 < i < 6 else ''}" for i in range(12)},
        **{20 + i: "copied" for i in range(6)}, **{30 + i: f"own {i}" for i in range(3)},
    }


def test_names_inside_articles_need_a_neighbour(spark):
    """A name that may be a page part's decides nothing alone, but lets a neighbour decide."""
    offer = "<section class='related-work'><p>Read our guides</p></section>"
    rows = [(i, f"https://a.org/{i}", page(f"<p>story {i}</p>{offer}"), "t", 1) for i in range(2)]
    rows += [(9, "https://b.org/", page(f"<p>story 9</p>{offer}"), "t", 1)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: "story 0", 1: "story 1", 9: "story 9\nRead our guides"}


def test_who_removes_lines(spark):
    rows = [(i, f"https://a.org/{i}", page(f"<p>story {i}</p><div>Follow us</div>"), "t", 1) for i in range(3)]
    rows += [(8, "https://b.org/1", page("<p>alone</p>") + "<p>below</p>", "t", 1), (9, None, None, "t", 1)]
    got = {r.page_id: (r.lines, r.by_neighbours, r.by_markup) for r in html.removed_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {**dict.fromkeys(range(3), (4, 3, 0)), 8: (4, 0, 3), 9: (0, 0, 0)}

import re
from html import unescape

from ledgerlake.llm import queries, style_tree
from ledgerlake.llm.html_blocks import blocks
from ledgerlake.llm.tables import table
from tests.llm.conftest import SF


def text_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in style_tree.extract_text(df, **options).collect()}


def test_parts_around_the_article_go(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head>
    <body class="has-sidebar"><header><p>Site</p></header><nav><ul><li><a href="/">Home</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><aside>More</aside>
    <article class="post"><header><h1>A  title</h1></header><p>One&nbsp;&amp; <b>t</b>wo<br>three<p>four
    <form><input value="x">Sign</form><ul><li>five<li>six</ul><div hidden>gone</div><p style="display: none">gone
    <section id="comments"><p>First!</p></section></article><footer>&copy; end</footer><!-- <p>no</p> --></body></html>"""
    assert text_of(spark, [(1, "http://a.example/1", page)]) == {1: "A title One & two three four five six"}


def test_nodes_that_always_look_the_same_go(spark):
    rows = []
    for k in range(8):
        body = f"<div class='box'><span>Follow us</span></div><div class='text'><p>Story {k} of today</p></div>"
        rows.append((k, f"https://u:p@News.example:80/{k}?q=1", f"<body>{body}</body>"))
    rows.append((90, "https://other.example/1", "<div class='box'>Follow us</div><p>x"))
    rows.append((91, None, "<div class='box'>Follow us</div>"))
    got = text_of(spark, rows)
    assert all(got[k] == f"Story {k} of today" for k in range(8))
    assert got[90] == "Follow us x" and got[91] == "Follow us"


def test_copies_of_an_article_stay(spark):
    page = "<body><article><p>The same story</p></article></body>"
    rows = [(k, "http://a.example/", page) for k in range(20)]
    assert set(text_of(spark, rows).values()) == {"The same story"}


def test_odd_pages(spark):
    rows = [
        (1, "http://a", None), (2, None, ""), (3, "x", "<"), (4, "y", "<p>a < b &am</p><div class="),
        (5, "z", "plain text"), (6, "z", "</p></div><p>x</b>y"), (None, None, None), (7, "z", "<script>never closed <p>"),
        (8, "z", "<p>" * 5000 + "deep"), (9, "z", "<!-- open"), (10, "z", "<textarea>in</textarea>out"),
    ]
    got = text_of(spark, rows)
    assert got == {1: "", 2: "", 3: "<", 4: "a < b &am", 5: "plain text", 6: "xy", None: "", 7: "", 8: "deep", 9: "", 10: "out"}
    clash = spark.createDataFrame([(1, "u", "<p>a", "b", "c")], "page_id int, url string, html string, text string, host string")
    assert [tuple(r) for r in style_tree.extract_text(clash).collect()] == [(1, "u", "a")]
    assert style_tree.extract_text(clash.where("false")).count() == 0


def test_query(spark):
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in queries.op5_style_tree(spark, SF).collect()}
    assert got.keys() == pages.keys()
    for k, html in pages.items():
        article = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
        spaced = re.sub(r"</?(p|h1|br)>|<[^>]*$", " ", article)
        want = " ".join(unescape(re.sub(r"</?b>", "", spaced)).split())
        assert (got[k].text, got[k].n_chars) == (want, len(want))


def test_unclosed_elements():
    found = [(b.path, b.text) for b in blocks("<div><p><b>a<br><p>b</p><table><tr><td>1<td>2<tr><td>3</table>c</div>d")]
    assert [t for _, t in found] == ["a", "b", "1", "2", "3", "c", "d"]


def test_a_name_around_the_article_does_not_drop_it(spark):
    told = "<p>The story of the day, told at length</p>"
    rows = [
        (1, None, f"<div class='site no-sidebar has-menu with-banner'>{told}</div><div class='sidebar'>More</div>"),
        (2, None, f"<div id='nav-content'><main class='x'>{told}<div class='share'>Share</div></main></div>"),
        (3, None, f"<div class='page-header'><article>{told}</article></div><p>Other"),
        (4, None, f"<div class='search-results'>{told}</div><p>Other"),
        (5, None, f"<article>{told}</article><div class='related'><article><p>Another one, to be read by all who like to read much</p></article></div>"),
        (6, None, f"<div class='login'>Sign in</div><div>{told}</div>"),
    ]
    got = text_of(spark, rows)
    want = "The story of the day, told at length"
    assert got == {1: want, 2: want, 3: want, 4: want + " Other", 5: want, 6: want}


def test_what_repeats_inside_articles_goes(spark):
    rows = []
    for k in range(12):
        told = f"<h1>Title {k}</h1><p>Story {k} of today</p><p>It went on {k * k}</p>"
        page = f"<body><article>{told}<p>Read more on our site</p><div class='x'>By our staff</div></article></body>"
        rows += [(k, f"http://a.example/{k}", page)] * (6 if k == 3 else 1)
    got = text_of(spark, rows)
    assert got == {k: f"Title {k} Story {k} of today It went on {k * k}" for k in range(12)}


def site(pages, marked):
    """Cells, answers and items of few values, beside what all pages of the site show."""
    words = ("yes", "no", "maybe")
    rows = []
    for k in range(pages):
        cells = "".join(f"<td>{words[(k * 7 + c * (k % 5)) % 3]}</td>" for c in range(6))
        items = "".join(f"<li>{words[(k + c) % 3]}</li>" for c in range(k % 4))
        told = (
            f"<h1>Question {k}</h1><p>Answer: {words[k % 3]}</p><table><tr>{cells}</tr></table>"
            f"<ul>{items}</ul><p class='verdict'>{words[k * k % 3]}</p>"
        )
        own = f"<article>{told}</article>" if marked else f"<div class='c{'x' if marked else 'y'}'>{told}</div>"
        rows.append((k, f"http://s{pages}.example/{k}", f"<body>{own}</body>"))
    return rows


def test_few_values_stay_at_any_size_of_the_site(spark):
    for marked in (True, False):
        for pages in (3, 5, 50, 500):
            rows = site(pages, marked)
            got = text_of(spark, rows)
            assert got == {k: " ".join(b.text for b in blocks(html)) for k, _, html in rows}, (marked, pages)


def test_what_all_pages_show_goes_at_any_size_of_the_site(spark):
    """Menus and footers without names or marks, some of them left out on a page here and there."""
    for pages in (8, 60, 300):
        rows, want = [], {}
        for k, url, html in site(pages, False):
            menu = "<div class='m'><span>Home</span><div>News</div><div>Sports</div><div>Contact</div></div>"
            foot = "" if k % 50 == 49 else "<div class='f'>All rights are ours</div>"
            rows.append((k, url, html.replace("<body>", f"<body>{menu}").replace("</body>", f"{foot}</body>")))
            want[k] = " ".join(b.text for b in blocks(html))
        assert text_of(spark, rows) == want


def test_what_a_minority_shows_instead_stays(spark):
    rows = []
    for k in range(100):
        note = "Told by our staff" if k % 40 else f"Told by guest {k}"
        rows.append((k, f"http://a.example/{k}", f"<body><p>Story {k} here</p><div class='by'>{note}</div></body>"))
    got = text_of(spark, rows)
    assert got == {k: f"Story {k} here" + ("" if k % 40 else f" Told by guest {k}") for k in range(100)}

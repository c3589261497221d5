import html
import re

from surgewatch.llm.html_extract import extract_text, main_text
from surgewatch.llm.queries import op9_html_extraction


def test_whole_table(spark, load):
    pages = {p: (u, h) for p, u, h in load("pages", "sf0.01", "page_id, url, html")}
    rows = op9_html_extraction(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(pages)
    for x in rows:  # these pages: one article of paragraphs, a heading and inline tags
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[x.page_id][1], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert x.text == "\n".join(p for p in parts if p) and x.n_chars == len(x.text) and x.url == pages[x.page_id][0]


def test_tags():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x</article>";</script></head>
    <body class="page search-page-0"><header><h1>Site</h1></header><nav><a href="/">Home</a></nav><!-- <p>no</p> -->
    <div class="cookieNotice">We use cookies</div><article><header><h1>A &amp; B</h1></header><p>One <b>bold</b>word&nbsp;x
    y<p>Two &lt;tag&gt; a&#8217;s<ul><li>i<li>ii</ul><aside>side</aside><form><input value="a>b">f</form><div class="ad">buy</div>
    <table><tr><td>c1<td>c2</table><p hidden>h</p>tail<br>end<section id="comments"><article class="comment">me too</article></section>
    </article><footer>&copy; x</footer></body>"""
    assert main_text(page) == "A & B\nOne boldword x y\nTwo <tag> a’s\ni\nii\nc1\nc2\ntail end"


def test_broken_pages():
    assert main_text("") == "" and main_text("plain  text &amp; more") == "plain text & more"
    assert main_text("<article><p>open") == "open" and main_text("<article><p>a<b") == "a"
    assert main_text("<p>a < b</p><script>x") == "a < b" and main_text("</p></div>x") == "x"
    assert main_text("<article>" + "<div>" * 3000 + "deep") == "deep"


def test_names_that_mark_no_boilerplate():
    """Names of states, topics and wrappers don't take the article away; real marks still do."""
    for page in ("<article class='post comments-open'><p>story</article>", "<main class='no-sidebar'><p>story</main>",
                 "<div class='container has-sidebar'><article><p>story</article></div>",
                 "<div class='long-form'><article><p>story</article></div>", "<article id='social-science'>story</article>",
                 "<div class='elementor-widget-container'><article><p>story</article><div id='comments'>me</div></div>",
                 "<div class='widget'><div class='search'><article>story<div class='ad'>buy</div></article></div></div>",
                 "<main><article class='widget'>story</article></main>", "<div class='widget'><p>story</div>",
                 "<article>story<div class='related'>else</div></article>", "<article><p title='the'>story</article>",
                 "<article><p title='the hidden cost'>story</article>", "<article><p data-x=' hidden '>story</p><p hidden=''>x</article>",
                 "<article>story</article><div id='comments'><article class='comment'>a long long answer</article></div>",
                 "<article>story<section class='comments'>a long long answer</section></article>",
                 "<p>story</p><div class='related'><article>t</article></div>", "<p>story</p><div class='comments'>a long long answer</div>",
                 "<article hidden>nothing at all</article><p>story</p>"):
        assert main_text(f"<html><body class='search'>{page}</body></html>") == "story", page
    posts = "".join(f"<article class='widget'>story {i}</article>" for i in range(5))
    assert main_text(posts).split("\n") == [f"story {i}" for i in range(5)]
    assert main_text("<article>a<section class='related-work'>b</section></article>") == "a\nb"


def test_longer_names_and_headings_stay():
    """One word of a longer name, or a heading's id, marks nothing; whole names of boilerplate do."""
    for own in ("<h2 class='search-title'>text</h2>", "<h2 id='related-papers'>text</h2>", "<h2 id='comments'>text</h2>",
                "<p class='notice-board'>text</p>", "<div class='form-factor'>text</div>", "<div class='share-price'>text</div>",
                "<ul class='menu'><li>text</ul>", "<div id='social-security'>text</div>", "<p class='footer-note'>text</p>"):
        assert main_text(f"<article><p>{'story ' * 20}</p>{own}</article>") == f"{'story ' * 20}".strip() + "\ntext", own
    for own in ("<div class='share-buttons'>x</div>", "<div class='relatedPosts'>x</div>", "<p class='ad'>x</p>",
                "<div class='newsletter-signup box'>x</div>", "<div id='comments-area'>x</div>", "<div class='sidebar'>x</div>"):
        assert main_text(f"<article><p>{'story ' * 20}</p>{own}</article>") == f"{'story ' * 20}".strip(), own
    assert main_text("<main><p>intro</p><div>side</div><article>story</article><nav>n</nav></main><p>out</p>") == "intro\nstory"


def test_deep_nesting_in_linear_memory():
    """50,000 open tags, marked ones too."""
    import tracemalloc
    for tag in ("<div>", "<div class='x y'>", "<b class=widget>"):
        tracemalloc.start()
        text = main_text("<article>deep</article>" + tag * 50_000 + "deep")
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert text == "deep" and peak < 100e6, (tag, peak)


def host_pages(n):
    return [(i, f"https://h.example.com/{i}", f"""<html><body><div class="top">Daily paper</div><div class="wrap"><div class="body"><p>Story {i}
        about {'things ' * (20 + i)}</p><p>More of {i}. {'words ' * 30}</p></div><div class="right"><p>Always the same text</p></div></div>
        <div class="bottom">All rights</div></body></html>""") for i in range(n)]


def test_template_of_a_host(spark):
    """No article element: texts of the host's template go, the slots of its main path stay."""
    rows = extract_text(spark.createDataFrame(host_pages(12), "page_id long, url string, html string")).collect()
    for x in rows:
        assert x.text.startswith(f"Story {x.page_id} about") and f"More of {x.page_id}." in x.text and x.text.count("\n") == 1


def test_template_inside_articles(spark):
    """What a host repeats in its articles goes; articles that repeat as a whole stay."""
    def page(host, i, story):
        return i, f"https://{host}.example.com/{i}", f"""<html><body><article><h1>Title {i}</h1><div class="x1"><p>Get our app now</p>
            <p>Rate this story</p></div><p>{story}</p><div class="x2"><b>Read on</b> tomorrow</div></article></body></html>"""
    pages = [page("a", i, f"Story {i} {'words ' * 40}") for i in range(12)] + [page("b", 20 + i, "One story") for i in range(6)]
    got = {x.page_id: x.text for x in extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i}\nStory {i} {'words ' * 40}".strip() for i in range(12))
    assert all(got[20 + i] == f"Title {20 + i}\nGet our app now\nRate this story\nOne story\nRead on tomorrow" for i in range(6))


def test_all_blocks_in_two_layouts(spark):
    """No article element: headings, lists, tables, quotes and code stay, in each layout of a host."""
    def inner(i):
        return f"""<h1>Title {i}</h1><p>Story {i} {'long ' * 300}</p><ul><li>point {i}<li>other {i}</ul><h2>Part {i}</h2>
            <table><tr><td>cell {i}<td>side {i}</table><blockquote>quote {i} {'q ' * 100}</blockquote><pre>code {i}</pre>"""

    def page(i):
        side = f'<div class="right"><p>Always the same text</p><p>Now {i * 7}</p></div>'
        held = f'<div class="post">{inner(i)}</div>' if i % 10 < 7 else \
            f'<div class="story"><div class="top">{inner(i)}</div><div class="rest"><p>Tail {i}</p></div><p>Last {i}</p></div>'
        return i, f"https://two.example.com/{i}", f'<html><body><div class="page">{held}{side}</div></body></html>'
    rows = extract_text(spark.createDataFrame([page(i) for i in range(30)], "page_id long, url string, html string")).collect()
    for x in rows:
        i = x.page_id
        want = [f"Title {i}", f"Story {i} {'long ' * 300}".strip(), f"point {i}", f"other {i}", f"Part {i}", f"cell {i}", f"side {i}",
                f"quote {i} {'q ' * 100}".strip(), f"code {i}"] + ([f"Tail {i}", f"Last {i}"] if i % 10 >= 7 else [])
        assert x.text.split("\n") == want


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (2, "", "", "x"), (3, "http://a.example/", "<article>x</article>", "x"),
            (3, "http://a.example/", "<article>x</article>", "x"), (None, "http://A.example/", "<main>y</main>", "x"),
            (4, "no url", "<p>" + "long " * 200_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, template string")
    got = sorted((str(x.page_id), x.text[:10], x.n_chars) for x in extract_text(df).collect())
    assert got == [("1", "", 0), ("2", "", 0), ("3", "x", 1), ("3", "x", 1), ("4", "long long ", 999_999), ("None", "y", 1)]
    assert extract_text(df.limit(0)).collect() == []

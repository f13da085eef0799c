from lumenframe.llm.dom import parse
from lumenframe.llm.wrappers import extract_text, main_text, page_of, shape, tree_matching


def test_article_only():
    html = (
        "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<header>Site</header><nav><ul><li>Home</ul></nav><div class='ad'>Buy</div><!-- c --><article><h1>T &amp; U</h1>"
        "<p><b>One\n  two<br><p>three &lt;b&gt; <i>f</i>our&nbsp;x</p><form>q</form><aside>s</aside>"
        "<section id='comments'><p>first!</p></section></article><footer>&copy; z</footer>"
    )
    assert main_text(html, []) == "T & U\nOne two\nthree <b> four x"
    assert main_text("", []) == "" and main_text("just text", []) == "just text"
    assert main_text("<div><p>a<div class='share-buttons'>b</div><ul><li>c<li>d</ul>", []) == "a\nc\nd"
    assert main_text("<script>x", []) == "" and main_text("a < b <", []) == "a < b <"


def test_names_of_layouts_do_not_drop_an_article():
    story = "<p>A long story about nothing at all.</p>"
    said = "A long story about nothing at all."
    for html in (
        f'<article class="post category-social tag-search">{story}</article>',
        f'<div class="layout no-sidebar"><article>{story}</article></div>',
        f'<main class="has-sidebar">{story}</main>',
        f"<html><head><title>t</title><body><article>{story}</article>",
        f"<head><meta charset=x><p>{story}",
        f'<body><svg class="icon"/><article>{story}</article>',
        f"<form><div id='sidebar-layout'><article>{story}</article></div></form>",
        f"<article>{story}<aside class='related'><article>Read that</article></aside></article>",
        f"<article>{story}</article><div class='sidebar'><article>teaser</article></div>",
        f"<article>{story}</article><section class='comments'><article class='comment'>No!</article></section>",
        f"<article>{story}<div class='share-buttons'>s</div><div class='site-newsletter'>n</div><svg><text>x</text></svg></article>",
    ):
        assert main_text(html, []) == said, html


def test_deep_and_malformed_pages(spark):
    deep = "".join(f"<{t}>x" for t in ("div", "i", "center", "li") * 500)
    closed = "<div>" * 1500 + "core" + "</div>" * 1500
    odd = ["</p></div>" * 50 + "a", "<" * 3000, "<div " * 3000, "<!--" * 10, "<p" + " a='" * 999, "<table><tr><td>1<td>2<tr><td>3"]
    rows = [(k, "http://deep.example/", h) for k, h in enumerate([deep, closed, *odd, closed.replace("core", "c2"), closed.replace("core", "c3")])]
    rows += [(100, "http://deep.example/", "<div>" * 2000 + "<article>story</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    assert len(got) == len(rows) and got[1] == "core" and got[100] == "story"
    assert got[0].replace("\n", "").replace(" ", "") == "x" * 2000 and got[7] == "1 2\n3"
    written, _ = shape(page_of(closed))
    assert tree_matching(written, written) == list(range(1501))


def test_shape_equals_a_recursive_description():
    def plain(node):
        parts = []
        for c in node.nodes():
            if c.tag not in ("script", "head") and (not parts or parts[-1] != plain(c)):
                parts.append(plain(c))
        return (node.tag, parts)

    def lines(tree, depth=0):
        return [f"{depth} {tree[0]}", *(x for part in tree[1] for x in lines(part, depth + 1))]

    html = "<div><p>a<p>b<ul><li>c<li><b>d</b><li>e</ul></div><div><p>f</div><script>g</script><table><tr><td>h<td>i</table>"
    written, texts = shape(page_of(html))
    assert written.split("\n") == lines(plain(parse(html)))
    tags = [line.split(" ")[1] for line in written.split("\n")]
    assert [tags[n] for n, _ in texts] == ["p", "p", "li", "b", "li", "p", "td", "td"]


def brute_matching(a, b):
    """Most matched nodes of two trees given as (tag, children)."""
    if a[0] != b[0]:
        return 0
    best = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_matching(x, y))
    return 1 + best[-1][-1]


def test_tree_matching():
    left, right = ("r", [("a", [("b", [])]), ("c", []), ("d", [])]), ("r", [("c", []), ("a", [("b", []), ("e", [])]), ("d", [])])

    def written(t, depth=0):
        return "\n".join([f"{depth} {t[0]}", *(written(c, depth + 1) for c in t[1])])

    matched = tree_matching(written(left), written(right))
    assert sum(m >= 0 for m in matched) == brute_matching(left, right) == 4
    assert matched[0] == 0 and matched[1] == 2
    assert tree_matching("0 a", "0 b") == [-1]


def test_repeated_siblings_are_one_node():
    one, _ = shape(parse("<ul><li>a<li>b</ul><p>x"))
    two, texts = shape(parse("<ul><li>a<li>b<li>c</ul><p>x<p>y"))
    assert one == two and [n for n, _ in texts] == [2, 2, 2, 3, 3]


def test_template_of_a_host(spark):
    page = "<div><p>Welcome to our site</p></div><div><h2>{0}</h2><p>Text number {0} is here.</p></div><div>Contact: us</div>"
    rows = [(k, f"http://h.example/{k}", page.format(k)) for k in range(6)]
    rows += [(10, "http://other.example/", page.format(1)), (11, None, None), (12, "http://h.example/", "")]
    rows += [(0, "http://h.example/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = {}
    for r in extract_text(pages).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    for k in range(6):
        want = f"{k}\nText number {k} is here."
        assert got[k] == [(want, len(want))] * (2 if k == 0 else 1)
    assert got[10][0][0].startswith("Welcome") and got[11] == got[12] == [("", 0)]
    assert extract_text(pages.limit(0)).count() == 0


def test_copies_of_an_article_are_no_template(spark):
    html = "<nav>m</nav><article><p>The same story.</p></article>"
    pages = spark.createDataFrame([(k, "http://h.example/", html) for k in range(8)], "page_id long, url string, html string")
    assert {r["text"] for r in extract_text(pages).collect()} == {"The same story."}


def test_repeated_ends_of_articles_are_template(spark):
    """A line that most different articles of a host begin or end with goes; copies, near copies and headings stay."""

    def page(host, k, lines):
        return (k, f"http://{host}/{k}", "<body><article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article></body>")

    def own(k):
        return [f"Story {k} has its own text, long enough to be most of the page {k}.", "Background", f"More of {k}, with a second part."]

    told = "Get <b>our letter</b> each day"
    rows = [page("a.org", k, ["By the desk", *own(k), told]) for k in range(4)]
    rows += [page("b.org", k, [*own(9), told]) for k in range(10, 14)]  # copies: one article
    shared = [f"Part {k} that near copies have in common, and more of it." for k in range(5)]
    rows += [page("c.org", k, [*shared, f"End {k}"]) for k in range(20, 24)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n") for r in extract_text(pages).collect()}
    assert all(got[k] == own(k) for k in range(4))
    assert all(got[k] == [*own(9), "Get our letter each day"] for k in range(10, 14))
    assert all(got[k] == [*shared, f"End {k}"] for k in range(20, 24))


def test_slots_around_an_article_are_kept(spark):
    def page(k):
        told = f"<div><p>Lead {k} of the story</p></div>" if k else ""
        menu = "<div><p>Our <b>daily</b> paper</p><p>All rights kept</p></div>"
        return (k, f"http://a.org/{k}", f"{menu}<h1>Title {k}</h1>{told}<article><p>Story {k} is told.</p></article><p>By writer {k}</p>{menu}")

    rows = [page(k) for k in range(1, 6)] + [(9, "http://b.org/9", page(9)[2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract_text(pages).collect()}
    for k in range(1, 6):
        assert got[k] == f"Title {k}\nLead {k} of the story\nStory {k} is told.\nBy writer {k}"
    assert got[9] == "Story 9 is told."  # of a host with one page nothing is known

import random

from pulsemill.llm import page_diff as P

PAGES = "page_id long, url string, html string"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def text(html):
    return P.main_text(P.lines_of(html), None)


def test_markup_is_left_out():
    body = (
        '<header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">Accept</div>'
        '<main><aside>More</aside><article><h1>Title &amp; more</h1><p>First  <b>bold</b>\n text.<br>Next<p>Second&nbsp;one.'
        '<script>var t="</p><p>no";</script><style>p{}</style><div class="ad">Buy</div><form><p>Name</p></form>'
        '<!-- <p>hidden</p> --><p hidden>gone</p><p style="display:none">gone</p></article>'
        '<section id="comments"><article class="comment"><p>I agree</p></article></section></main>'
        "<footer>&copy; Site</footer>")
    assert text(page(body)) == "Title & more\nFirst bold text. Next\nSecond one."


def test_broken_markup():
    assert text("<p>a<p>b < c & d &lt;e&gt;") == "a\nb < c & d <e>"
    assert text("<article><p>open") == "open"
    assert text("<nav><p>menu<article><p>story</article>") == "story"
    assert text("<div class='ad'>x<div>y</div></div>z") == "z"
    assert text("") == "" and text("<script>never closed") == ""
    assert text("just text") == "just text"


def test_shared_lines_is_a_longest_common_subsequence():
    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(12))]
        b = [rng.randrange(6) for _ in range(rng.randrange(12))]
        cut = P.shared_lines(a, b)
        rest = iter(b)
        assert cut == sorted(set(cut)) and all(a[i] in rest for i in cut)
        assert len(cut) == longest(a, b)


def test_template_lines_are_cut_by_the_neighbour(spark):
    def at(i, own):
        return (i, f"http://h.org/a/{i}", page(f"<div>Top story list</div><div>{own}</div><div>All about us</div>"))

    rows = [at(1, "Own one."), at(2, "Own two."), at(3, "Own three."),
            (4, "http://alone.org/x", page("<div>Alone</div>")), (5, None, page("<p>No host</p>")),
            (6, "http://h.org/a/6", None), (7, "http://h.org/a/7", ""), (8, "http://c.org/1", page("<p>Copy</p>")),
            (9, "http://c.org/2", page("<p>Copy</p>")), (None, "http://n.org/", page("<p>No id</p>")),
            (1, *at(1, "Own one.")[1:])]
    found = sorted(((r.page_id, r.text, r.n_chars) for r in P.extract(
        spark.createDataFrame(rows, PAGES)).collect()), key=str)
    expected = [(1, "Own one."), (1, "Own one."), (2, "Own two."), (3, "Own three."), (4, "Alone"), (5, "No host"),
                (6, ""), (7, ""), (8, "Copy"), (9, "Copy"), (None, "No id")]
    assert found == sorted(((i, t, len(t)) for i, t in expected), key=str)


def test_empty_table(spark):
    assert P.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_neighbours_over_partitions(spark):
    """A frequent host is spread over partitions; every page still meets the next ones."""
    rows = [(i, f"http://h.org/{i:05d}", page(f"<p>Shared</p><p>own {i}</p>")) for i in range(500)]
    found = P.extract(spark.createDataFrame(rows, PAGES).repartition(9)).collect()
    assert {(r.page_id, r.text) for r in found} == {(i, f"own {i}") for i in range(500)}


def test_differencing_decides_beside_an_article(spark):
    def at(i, own):
        return (i, f"http://h.org/a/{i}", page(
            f"<nav>Menu {i}</nav><div>Site name</div><div>{own}</div><article><p>Quoted.</p><p>Story {i}.</p></article>"
            "<div>All about us</div>"))

    rows = [at(1, "Standfirst one."), at(2, "Standfirst two."), at(3, "Standfirst three."),
            (4, "http://alone.org/x", page("<div>Site</div><article><p>Alone</p></article>")),
            (5, "http://p.org/1", page("<div>Note one</div><main><p>One</p></main>")),
            (6, "http://p.org/2", page("<div>Note two</div><main><p>Two</p></main>")),
            (7, "http://q.org/1", page("<div>Site</div><main><p>Seven</p></main>")), (8, "http://q.org/2", None)]
    found = {r.page_id: r.text for r in P.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {
        1: "Standfirst one.\nQuoted.\nStory 1.", 2: "Standfirst two.\nQuoted.\nStory 2.",
        3: "Standfirst three.\nQuoted.\nStory 3.", 4: "Alone", 5: "Note one\nOne", 6: "Note two\nTwo", 7: "Seven", 8: ""}

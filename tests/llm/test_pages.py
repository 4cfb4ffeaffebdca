"""Main text of pages: markup by hand, subsequences and neighbours against plain statements."""

import random

import pytest

from folio.llm import page_diff
from folio.llm.html_blocks import blocks, candidates

SCHEMA = "page_id long, url string, html string, lines string, host int"


def text_of(html):
    found = blocks(html)
    return [found[i].text for i in candidates(found)]


@pytest.mark.parametrize("html, want", [
    ("", []), ("plain", ["plain"]), ("a<b>b</b> c<br>d", ["ab c", "d"]), ("<p>one<p>two\n\t three</p>", ["one", "two three"]),
    ("x &amp; &copy &#65;&#x42; &lt;p&gt; &nosuch; &am", ["x & © AB <p> &nosuch; &am"]),
    ("<title>t</title><script>if (a<b) '</p>'</script><style>p{}</style><p>x<!-- <p>y</p> --></p>", ["x"]),
    ("<p>a < b and <i>c</i> <3 </p><unclosed", ["a < b and c <3"]), ("<p>cut <!-- off", ["cut"]), ("<p>cut <script>off", ["cut"]),
    ("<nav>m</nav><p>x</p><footer>f</footer>", ["x"]), ("<header>h</header><article><header><h1>t</h1></header><p>x</article>", ["t", "x"]),
    ("<article><p>x</p><aside>s</aside><div class='share-bar'>s</div><form>f<input></form><section id=comments><article class=comment>c</article></section></article>", ["x"]),
    ("<div class='cookieNotice'>c</div><div id='main-content'><p>x</p><div class='newsletter'>n</div></div><p>out</p>", ["x"]),
    ("<body class='has-sidebar no-ads'><div class='content-sidebar-wrap'><p>x</p></div><div class='sidebar'>s</div>", ["x"]),
    ("<div class='ad'>open<p>ad</div><p>x<span class='ad'>s</span>y</p>", ["xy"]), ("<nav>never closed<article><p>x</article>", ["x"]),
    ("<ul><li><a href=/a>one</a></li><li>two <a href=/b>three</a></li></ul><p>x</p>", ["two three", "x"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<p hidden>h</p><p style='display: none'>h</p><div aria-hidden=true>h</div><p>x", ["x"]),
    ('<a title="a>b" class="x">t</a><p title=\'>\'>u</p>', ["t", "u"]), ("<div role=navigation>n</div><div role=main><p>x</div><div>y</div>", ["x"]),
    ("a  b　c", ["a b c"]), ("<P>UP</P><DIV CLASS=ADS>d</DIV>", ["UP"]), ("</div></p>x</b>", ["x"]),
])
def test_blocks(html, want):
    assert text_of(html) == want


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 6])
def test_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(page_diff, "_BITS", bits)
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.randrange(1, rng.choice([3, 6, 40])) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        at = page_diff.longest_common(a, b)
        assert at == sorted(set(at)) and len(at) == longest(a, b)
        left = iter(b)
        assert all(any(x == y for y in left) for x in (a[i] for i in at))
    a = list(range(30_000))
    assert len(page_diff.longest_common(a, a[1:15_000] + [-1] + a[15_001:])) == 29_998


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(n))


def soup(rng, host, articles, marked=False):
    """Pages of a site whose menus, notices and footers have no telling markup (an article may)."""
    menu, notice, foot = [words(rng, 2) for _ in range(6)], words(rng, 14), words(rng, 8)
    out = []
    for k, lines in enumerate(articles):
        body = "".join(f"<p>{x}</p>" for x in lines)
        out.append((f"https://{host}/news/{k:03d}.html", "<html><body>" + "".join(f"<div>{m}</div>" for m in menu) + f"<div>{notice}</div>" + (f"<article>{body}</article>" if marked else body)
                    + f"<div>{foot}</div></body></html>"))
    return out


def extracted(spark, pages):
    rows = [(i, u, h, "x", 1) for i, (u, h) in enumerate(pages)]
    got = page_diff.extract_pages(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(r.page_id for r in got) == list(range(len(pages))) and all(r.url == pages[r.page_id][0] for r in got)
    return {r.page_id: list(r.lines) for r in got}


@pytest.mark.parametrize("block", [1024, 16])
def test_neighbours_take_the_template_off(spark, monkeypatch, block):
    monkeypatch.setattr(page_diff, "BLOCK", block)
    rng = random.Random(block)
    quote, story = words(rng, 60), [words(rng, 30) for _ in range(4)]
    articles = [[words(rng, 20) for _ in range(rng.randrange(1, 7))] for _ in range(60)]
    articles[7] += [quote]
    articles[8] += [quote]                                         # a passage of two neighbours
    articles[20:24] = [story, story, story, [*story[:3], words(rng, 20)]]  # copies, and one with another end
    pages = soup(rng, "soup.example.org", articles)
    marked = soup(rng, "marked.example.org", articles[:20], marked=True)
    got = extracted(spark, pages + marked)
    for k, want in enumerate(articles + articles[:20]):
        assert got[k] == want, k


def test_odd_pages(spark):
    rng = random.Random(1)
    lone = [("https://lone.example.org/a", "<p>only page</p>"), (None, "<p>no host</p>"), ("::bad [", "<p>bad</p>"), ("https://x.example.org/1", None), ("https://x.example.org/2", ""),
            ("https://x.example.org/3", "<nav>only a menu</nav>")]
    pages = soup(rng, "p.example.org", [[words(rng, 12)] for _ in range(5)])
    copies = [pages[2]] * 40  # a page held by most rows
    got = extracted(spark, lone + pages + copies)
    assert [got[i] for i in range(6)] == [["only page"], ["no host"], ["bad"], [], [], []]
    assert all(len(got[i]) == 1 for i in range(6, 51)) and all(got[i] == got[8] for i in range(11, 51))
    assert extracted(spark, []) == {}


def test_a_very_long_page(spark):
    rng = random.Random(2)
    long = [f"line {i} {words(rng, 3)}" for i in range(30_000)]
    pages = soup(rng, "long.example.org", [long, [words(rng, 9)], [words(rng, 9)], long[:1]])
    assert extracted(spark, pages)[0] == long

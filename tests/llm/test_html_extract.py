"""Operator 6 on generated sites whose articles are known, and tree matching by brute force."""

import itertools
import random

import pytest

from tessera.llm import html_extract as hx

SCHEMA = "page_id long, url string, html string, text string, grp long"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeéß", k=rng.randint(1, 8))) for _ in range(n)) + "."


def site_page(rng, host, marked):
    blocks = [words(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 9))]
    esc = [b.replace("é", "&eacute;") for b in blocks]
    inner = f"<h1>{esc[0]}</h1>" + "".join(f"<p>{x}" + rng.choice(["</p>", ""]) for x in esc[1:])
    body = (f"<article>{inner}</article>" if marked else f"<div class='story'>{inner}</div>")
    links = "".join(f"<li><a href='/{i}'>{words(rng, 1)}</a></li>" for i in range(5))
    return blocks, (
        f"<!DOCTYPE html><html><head><title>{esc[0]}</title><style>p{{x:'</p>'}}</style><script>var a='<p>no</p>';"
        f"</script></head><body><header><p>{host} news</p></header><nav><ul>{links}</ul></nav><!-- <p>no</p> -->"
        f"<div class='ad-box'>{words(rng, 6)}</div><div class='tagline'><p>All the news of {host}</p></div>{body}"
        f"<aside><p>{words(rng, 8)}</p></aside><div id='comments'><p>{words(rng, 9)}</p></div>"
        f"<form><label>Mail</label><input name=a><button>Go</button></form><footer>&copy; {words(rng, 3)}</footer></body></html>")


@pytest.mark.parametrize("marked", [True, False])
def test_sites(spark, marked, monkeypatch):
    monkeypatch.setattr(hx, "GROUP_PAGES", 20)
    rng = random.Random(7)
    rows, want = [], {}
    for host, n in (("big.example.com", 130), ("small.example.org", 12), ("Other.example.net", 8)):
        for _ in range(n):
            blocks, page = site_page(rng, host, marked)
            want[len(rows)] = "\n\n".join(blocks)
            rows.append((len(rows), f"https://{host}/{len(rows)}?a=//b", page, "x", 1))
    copies = [(1000 + i, rows[3][1], rows[3][2], "x", 1) for i in range(60)]
    want |= {r[0]: want[3] for r in copies}
    got = hx.extract(spark.createDataFrame(rows + copies, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "plain text &amp; more"), (4, "http://a.b/", "<p>one<p>two<br>three"),
            (5, "http://a.b/", "<div>loose <b>bold</b> text<p>para</p>tail</div>"), (6, "http://c.d", "<!-- never closed <p>x</p>"),
            (7, "http://c.d", "<p a='unclosed>text</p>"), (8, None, "<script>x</script><p>" + "w " * 50_000 + "</p>"),
            (None, "http://a.b/", "<p>no id</p>"), (1, None, None), (9, "http://e.f", "<div>" * 3000 + "deep" + "</div>" * 3000),
            (10, "http://e.f", "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>"), (11, "http://e.f", "a < b &lt;p&gt; &#233; &nbsp; &am")]
    got = hx.extract(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert text[1] == text[2] == text[6] == ""
    assert text[3] == "plain text & more" and text[4] == "one\n\ntwo three"
    assert text[5] == "loose bold text\n\npara\n\ntail" and text[None] == "no id" and text[9] == "deep"
    assert text[10] == "a\n\nb\n\nc\n\nd" and text[11] == "a < b <p> é &am"
    assert len(text[8].split(" ")) == 50_000


def test_empty_table(spark):
    assert hx.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def brute(a, b):
    """Largest order-keeping matching of the children, tried out."""
    if a.label != b.label:
        return 0
    best = 0
    m, n = len(a.children), len(b.children)
    for k in range(min(m, n) + 1):
        for left in itertools.combinations(a.children, k):
            for right in itertools.combinations(b.children, k):
                scores = [brute(x, y) for x, y in zip(left, right)]
                best = max(best, sum(scores))
    return 1 + best


def tree(rng, depth):
    node = hx.Node(rng.choice("xy"))
    previous = None
    for _ in range(rng.randint(0, 3) if depth else 0):
        child = tree(rng, depth - 1)
        if previous is not None and not child.children and not previous.children and child.label == previous.label:
            continue                                  # runs count once
        node.children.append(child)
        previous = child
    return node


def test_tree_matching_is_the_largest():
    rng = random.Random(3)
    for _ in range(150):
        a, b = tree(rng, 3), tree(rng, 3)
        pairs = []
        assert hx.tree_match(a, b, pairs) == brute(a, b) == len(pairs)
        assert all(x.label == y.label for x, y in pairs)


@pytest.mark.parametrize("body,before,after", [
    ("right-sidebar menu-open", "<main class='search-results'><article class='post social'>", "</article></main>"),
    ("", "<div class='content with-sidebar'>", "</div>"), ("nav", "<div class='menu-wrap'><article>", "</article></div>"),
    ("", "<div class='comment-page'><main>", "</main></div>")])
def test_names_round_the_article_veto_nothing(body, before, after):
    rng = random.Random(11)
    pages, want = [], []
    for _ in range(12):
        blocks = [words(rng, 30) for _ in range(4)]
        want.append("\n\n".join(blocks))
        pages.append(f"<html class='nav'><body class='{body}'><div class='menu'>Menu</div>{before}"
                     + "".join(f"<p>{b}</p>" for b in blocks) + f"{after}<div id='comments'><p>{words(rng, 5)}</p></div></body></html>")
    assert hx.main_texts(pages) == want
    assert hx.main_texts(pages[:1]) == want[:1]


def test_text_after_a_deep_nest():
    deep = "<div>" * 150 + "deep" + "<nav>menu</nav>" + "</div>" * 150
    page = f"<body><div><article><p>first</p>{deep}<p>last</p></article></div><p>outside</p></body>"
    assert hx.main_texts([page]) == ["first\n\ndeep\n\nlast"]
    pages = [page.replace("deep", f"deep {i}").replace("last", f"last {i}") for i in range(6)]
    assert hx.main_texts(pages) == [f"deep {i}\n\nlast {i}" for i in range(6)]


def test_long_pages_are_matched_exactly():
    """Thousands of runs before template that has the content's labels."""
    rng = random.Random(12)
    pages, want = [], []
    for n in (3000, 10, 11, 12, 10, 13, 12, 14):
        blocks = [words(rng, 4) for _ in range(n)]
        want.append("\n\n".join(blocks))
        pages.append("<body>" + "".join(f"<h2>{b}</h2>" if i % 2 == 0 else f"<p>{b}</p>" for i, b in enumerate(blocks))
                     + "".join(f"<h4>About us {i}</h4><p>Footer text {i}</p>" for i in range(12)) + "</body>")
    assert hx.main_texts(pages) == want
    a, b = hx.Page(pages[0]).root, hx.Page(pages[1]).root
    assert hx.tree_match(a, b) == 2 + 10 + 24        # the page, its body, the runs


def pages_of(rng, n, build):
    """(pages, articles): build(blocks) gives a page's body."""
    pages, want = [], []
    for _ in range(n):
        blocks = [words(rng, 30) for _ in range(4)]
        want.append("\n\n".join(blocks))
        pages.append(f"<html><body>{build(''.join(f'<p>{b}</p>' for b in blocks))}</body></html>")
    return pages, want


@pytest.mark.parametrize("mark", ["article", "div"])
def test_a_page_wide_form_is_no_other_part(mark):
    rng = random.Random(21)
    pages, want = pages_of(rng, 8, lambda inner: f"<form id='aspnetForm'><nav>Menu</nav><{mark}>{inner}</{mark}>"
                                                 "<footer>About us</footer></form>")
    assert hx.main_texts(pages) == want and hx.main_texts(pages[:1]) == want[:1]
    pages, want = pages_of(rng, 8, lambda inner: f"<article>{inner}<form>Your comment</form></article><form>Search</form>")
    assert hx.main_texts(pages) == want


@pytest.mark.parametrize("n", [2, 12])
def test_a_sidebar_inside_an_article_goes(n):
    """Also one that holds two thirds of its text; a name round nearly all of it says nothing."""
    rng = random.Random(22)
    side = lambda: "".join(f"<p>{words(rng, 30)}</p>" for _ in range(n))
    pages, want = pages_of(rng, 8, lambda inner: f"<article><div class='sidebar'>{side()}</div>{inner}</article>")
    assert hx.main_texts(pages) == want
    pages, want = pages_of(rng, 8, lambda inner: f"<article><div class='widget'>{inner}</div></article>")
    assert hx.main_texts(pages) == want


def test_related_articles_in_an_aside_go():
    rng = random.Random(23)
    cards = lambda: "".join(f"<article><h3>{words(rng, 4)}</h3></article>" for _ in range(3))
    pages, want = pages_of(rng, 8, lambda inner: f"<main>{inner}</main><aside>{cards()}</aside>")
    assert hx.main_texts(pages) == want


def test_formulas_are_text():
    page = ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> is here"
            "<math><semantics><mi>y</mi><annotation>\\y</annotation></semantics></math></p>")
    assert hx.main_texts([page]) == ["so x=1 is herey"]


def test_long_tables_take_no_time():
    import time
    rng = random.Random(24)
    table = lambda n: "".join(f"<tr><td>{words(rng, 2)}</td><td><p>{words(rng, 2)}</p></td></tr>" if i % 3 else
                              f"<tr><td>{words(rng, 2)}</td></tr>" for i in range(n))
    pages = [f"<body><p>Site slogan</p><article><table>{table(n)}</table></article></body>" for n in (3000, 2900, 10, 11, 12)]
    began = time.time()
    texts = hx.main_texts(pages)
    assert time.time() - began < 10
    assert [t.count("\n\n") + 1 for t in texts] == [sum(2 if i % 3 else 1 for i in range(n)) for n in (3000, 2900, 10, 11, 12)]


def test_no_page_is_the_short_rest_of_a_host(spark):
    """Hosts a little over a group's size: the same texts under any layout, and no template text on any page."""
    rng = random.Random(25)
    rows, want = [], {}
    for host, n in (("a.example", 257), ("b.example", 268), ("c.example", 610), ("d.example", 5)):
        for _ in range(n):
            blocks, page = site_page(rng, host, False)
            want[len(rows)] = "\n\n".join(blocks)
            rows.append((len(rows), f"https://{host}/{len(rows)}", page, "x", 1))
    rng.shuffle(rows)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 200):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r.page_id: r.text for r in hx.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
            assert [i for i in want if got[i] != want[i]] == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_many_copies_of_a_page(spark, monkeypatch):
    monkeypatch.setattr(hx, "GROUP_PAGES", 8)
    rng = random.Random(26)
    blocks, page = site_page(rng, "a.example", True)
    rows = [(7, "https://a.example/7", page, "x", 1)] * 100 + [(i, f"https://a.example/{i}", site_page(rng, "a.example", True)[1], "x", 1)
                                                               for i in range(20, 30)]
    got = hx.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 110 and {r.text for r in got if r.page_id == 7} == {"\n\n".join(blocks)}

"""Operators on pages and vectors against brute force and hand-made rows."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from earshot.llm import ann, html, urls
from earshot.llm.queries import QUERIES, URL_RULES

# Pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li>Home</li></ul></nav><div class="box">{box}</div>
{body}<div class="comments"><p>nice!</p></div><footer>&copy; me</footer></body></html>"""


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("key"), F.lit(2).alias("template"), F.lit(3).alias("host"), F.lit(4).alias("text_key"))


def test_main_text_of_tables(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    found = {r.page_id: r for r in QUERIES["op2_html"](spark, SMALL).collect()}
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        import html as entities

        parts = [re.sub(r"<[^>]*>", " ", x) for x in re.split(r"</?(?:p|h1|h2|div)>", article)]
        expected = "\n\n".join(t for x in parts if (t := " ".join(entities.unescape(x).split())))
        got = found.pop(page.page_id)
        assert (got.url, got.text, got.n_chars) == (page.url, expected, len(expected))
    assert not found


def test_template_goes_and_copies_stay(spark):
    rows = []
    for i in range(8):  # no article: the shared box is known by recurrence alone
        rows.append((i, f"http://one.example/{i}", PAGE.format(box="Follow <b>us</b>", body=f"<div id=c><p>Text &amp; {i}<p>More\n text {i}</div>")))
    for i in range(8, 16):  # one page copied many times: its own text recurs, too
        rows.append((i, f"http://two.example/{i}", PAGE.format(box="same box", body="<p>copied text</p>")))
    rows.append((16, "http://three.example/", PAGE.format(box="Follow <b>us</b>", body="<p>alone</p>")))
    found = {r.page_id: r.text for r in html.main_texts(_pages(spark, rows)).collect()}
    assert [found[i] for i in range(8)] == [f"Text & {i}\n\nMore text {i}" for i in range(8)]
    assert found[8] == found[15] == "same box\n\ncopied text"
    assert found[16] == "Follow us\n\nalone"


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<article><p><b>One.<br><p>Two</p></article>", "One.\n\nTwo"),
        ("<article>a<br>b <i>c</i>d<ul><li>e<li>f</ul></article>", "a b cd\n\ne\n\nf"),
        ("<article><h1>H</h1><aside>no</aside><form>no</form><p>yes<script>var a='</p>';</script></article>", "H\n\nyes"),
        ("<main><p>m &lt;3 &#x41;</p></main><p>outside</p>", "m <3 A"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
        ("<article><p>a<div class='ad'>no</div>b</article><article class='comment'>no</article>", "a\n\nb"),
        ("plain text", "plain text"),
        ("<article><p>never closed", "never closed"),
    ],
)
def test_shapes(body, text):
    root = html.read(body)
    assert "\n\n".join(html.blocks(html.main_parts(root), frozenset())) == text


def test_template_is_a_share_of_the_host(spark):
    def page(host, i, box, more=""):
        return (i, f"http://{host}.example/{i}", f"<div class=box>{box}</div><p>text {i} of {host}</p>{more}")

    licence = "<p>Licensed under these terms.</p>"
    rows = [page("large", i, "Follow us", licence if i < 5 else "") for i in range(1000)]
    rows += [page("small", 1000 + i, "Follow us", licence if i < 2 else "") for i in range(3)]
    rows += [page("two", 1010 + i, "Follow us") for i in range(2)]
    found = {r.page_id: r.text for r in html.main_texts(_pages(spark, rows)).collect()}
    for i in range(1000):
        assert found[i] == f"text {i} of large" + ("\n\nLicensed under these terms." if i < 5 else "")
    assert [found[1000 + i] for i in range(3)] == [f"text {1000 + i} of small" + ("\n\nLicensed under these terms." if i < 2 else "") for i in range(3)]
    assert found[1010] == "Follow us\n\ntext 1010 of two"


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<div class='page with-sidebar'><article class='post has-sidebar comments-open'><p>a</p></article></div>", "a"),
        ("<article><p>a</p><section id='related-work'><h2>Related work</h2><p>b</p></section></article>", "a\n\nRelated work\n\nb"),
        ("<article><div class='post-header'><h1>T</h1></div><p class='share-price'>7</p></article>", "T\n\n7"),
        ("<div class='sidebar'><article>only</article></div>", "only"),
        ("<main><p>a</p><div class='overlay'><article>b</article></div></main>", "a\n\nb"),
        ("<main class='hidden'>m</main>", "m"),
        ("<article>a<div id=comments><article>no</article></div></article><div id=comments><article>no</article></div>", "a"),
        ("<div class='box Site_Header'>no</div><div class='ad-1'>no</div><p>yes</p><ul class='menu2'><li>no</ul>", "yes"),
    ],
)
def test_names_are_whole_tokens(body, text):
    root = html.read(body)
    assert "\n\n".join(html.blocks(html.main_parts(root), frozenset())) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<html><head><title>T</title><body><article><p>a</article></html>", "a"),
        ("<head><title>T</title><meta charset=utf-8><p>b</p>", "b"),
        ("<head><title>T</title>plain", "plain"),
        ("<head><noscript><img src=x></noscript><style>p{}</style></head><p>c</p>", "c"),
        ("<body><form><input type=hidden><header>no</header><article><p>a<input></article></form>", "a"),
        ("<body><form action=x><h1>T</h1><p>d</p><p>e</p><input type=text><button>no</button></form>", "T\n\nd\n\ne"),
        ("<p>f</p><form><p>Subscribe</p><input><button>Go</button></form>", "f"),
        ("<article><p>x<svg><text>no</text><p>no</p></svg>y</p></article>", "xy"),
    ],
)
def test_heads_forms_and_drawings(page, text):
    root = html.read(page)
    assert "\n\n".join(html.blocks(html.main_parts(root), frozenset())) == text


def test_template_inside_articles(spark):
    """What half of a host's pages hold goes from articles too; what fewer quote stays."""
    share, quote = "<div><p>Share this</p><p>Follow us</p></div>", "<p>To be or not to be.</p>"
    rows = [(i, f"http://a.example/{i}", f"<article><p>text {i}</p>{share if i % 4 else ''}{quote if i % 3 == 0 else ''}<p>more {i}</p></article>") for i in range(12)]
    rows += [(20 + i, "http://b.example/", f"<article><p>own {i}</p>{share}</article>") for i in range(4)]
    frame = _pages(spark, rows)
    found = {r.page_id: r.text for r in html.main_texts(frame).collect()}
    for i in range(12):
        assert found[i] == f"text {i}" + ("\n\nTo be or not to be." if i % 3 == 0 else "") + f"\n\nmore {i}"
    assert [found[20 + i] for i in range(4)] == [f"own {i}\n\nShare this\n\nFollow us" for i in range(4)]
    off = {r.page_id: r.text for r in html.main_texts(frame, many=10**9, few=10**9).collect()}
    assert sum(off[i] != found[i] for i in off) == 9


def test_page_ids_stay_exact(spark):
    rows = [(2**53 + 1, "http://a/", "<p>t"), (None, "http://a/", "<p>t"), (-(2**63), None, None)]
    assert {r.page_id for r in html.main_texts(_pages(spark, rows)).collect()} == {2**53 + 1, None, -(2**63)}


def test_pages_odd_rows(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None, None), (None, "http://a", ""), (2, "x", "<p>t"), (2, "x", "<p>t"), (3, "http://a", deep), (4, "http://a", "<p>" + "word " * 100_000)]
    found = sorted(((r.page_id, r.text, r.n_chars) for r in html.main_texts(_pages(spark, rows)).collect()), key=str)
    assert [f[:2] for f in found if f[2] < 10] == [(1, ""), (2, "t"), (2, "t"), (3, "deep"), (None, "")]
    assert max(f[2] for f in found) == 499_999
    assert html.main_texts(_pages(spark, rows).limit(0)).count() == 0


# Urls


def _judged(url):
    m = re.match(r"(?s)(?:(?!://).)*://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = []
    for rule, verdict in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


TRICKY = [
    "http://A.Example.NET/en/x",
    "http://example.net/enx",
    "http://net/",
    "http://net",
    "https://badexample.com/de/",
    "https://x.example.com/de/?q=://y.net/",
    "x://org/fr/",
    "//org/fr/",
    "http://u.org?/fr/",
    "http://ÄB.net/",
    "",
    None,
    "a\nb://h.net/p\nq",
]


def test_urls_against_brute_force(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    rows = {r.page_id: r for r in QUERIES["op7_urls"](spark, SMALL).collect()}
    assert len(rows) == len(pages)
    for page in pages:
        host, path, rule, verdict = _judged(page.url)
        got = rows[page.page_id]
        assert (got.host, got.path, got.rule) == (host, path, rule)
        assert got.verdict == verdict if rule else got.verdict in ("allow", "block")
    assert {r.rule for r in rows.values()} > {"net/", "org/fr/"}


def test_urls_odd_rows(spark):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(TRICKY)], "page_id long, url string").select("*", F.lit(1).alias("rule"), F.lit(1).alias("host"))
    for r in urls.judged(frame, URL_RULES).collect():
        host, path, rule, verdict = _judged(TRICKY[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), TRICKY[r.page_id]
        assert r.verdict == (verdict or r.verdict)
    assert urls.judged(frame.limit(0), URL_RULES).count() == 0
    only = frame.where("page_id = 0")
    assert [r.verdict for r in urls.judged(only.unionByName(only), URL_RULES).collect()] == ["allow", "allow"]


def test_trees_learn(spark):
    rules = [("com/bad/", "block"), ("com/fine/", "allow")]
    spam = lambda i: f"x{i % 300}?a={i % 300}&b=1&c={i % 300 * 7919}"
    rows = [(i, f"http://h{i % 7}.example.com/bad/{spam(i)}") for i in range(300)]
    rows += [(i, f"http://h{i % 7}.example.com/fine/page") for i in range(300, 600)]
    rows += [(i, f"http://h{i % 7}.example.com/new/{spam(i)}" if i % 2 else f"http://h{i % 7}.example.com/new/page") for i in range(600, 640)]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    found = {r.page_id: r for r in urls.judged(frame, rules).collect()}
    assert all(found[i].verdict == "allow" for i in range(600, 640, 2))
    assert sum(found[i].verdict == "block" for i in range(601, 640, 2)) >= 14
    assert found[0].block_score is None and 0 <= found[600].block_score < found[601].block_score <= 1


def test_judged_urls_are_no_part_of_what_the_trees_learn(spark):
    """Both verdicts occur on the tables, and more urls to judge change no score."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url")
    found = {r.page_id: r for r in urls.judged(pages, URL_RULES).collect()}
    assert {r.verdict for r in found.values() if r.rule is None} == {"allow", "block"}
    more = spark.range(500).selectExpr("id + 1000000 AS page_id", "concat('https://new', id, '.example.com/xx/', id) AS url")
    again = {r.page_id: r for r in urls.judged(pages.unionByName(more), URL_RULES).collect()}
    for i, r in found.items():
        assert again[i].verdict == r.verdict
        assert (again[i].block_score is None) == (r.block_score is None)
        assert r.block_score is None or abs(again[i].block_score - r.block_score) < 1e-9


# Vectors


def _brute(rows, every=50, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = []
    for i in ids[ids % every == 0]:
        score = ann.cosines(x[ids == i][0], x)
        own = ids != i
        best = np.lexsort((ids[own], -score[own]))[:k]
        out += [(int(i), r + 1, int(ids[own][b]), float(score[own][b])) for r, b in enumerate(best)]
    return sorted(out)


def _recall(found, expected):
    pairs = {(q, v) for q, _, v, _ in expected}
    return len(pairs & {(q, v) for q, _, v, _ in found}) / len(pairs)


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = sorted(tuple(r) for r in QUERIES["op8_ann"](spark, SMALL).collect())
    expected = _brute(rows)
    assert len(found) == len(expected) and _recall(found, expected) >= 0.9
    scores = {(q, v): s for q, _, v, s in expected}
    assert all(s == scores[q, v] for q, _, v, s in found if (q, v) in scores)


def test_recall_when_cells_are_many(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.6).tolist()) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in ann.nearest(frame, block=50).collect()]
    assert _recall(found, _brute(rows)) >= 0.9


def test_query_blocks_change_nothing(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(1500, 8)).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one, many = (sorted(tuple(r) for r in ann.nearest(frame, query_block=n, block=200).collect()) for n in (4096, 7))
    assert one == many and len(one) == 30 * 5


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(400)] + [(i, [4.0, -3.0, 2.0, -1.0]) for i in range(400, 450)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r)[:3] for r in ann.nearest(frame, block=30).collect())
    assert found[:10] == [(0, r, r) for r in range(1, 6)] + [(50, r, r - 1) for r in range(1, 6)]


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [0.0, 1.0]), (6, [0.0, 1.0]), (7, [1.0]), (8, []), (9, [1e300, 1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit(1).alias("cell"), F.lit(1).alias("vector"))
    found = [tuple(r)[:3] for r in ann.nearest(frame).collect()]
    assert sorted(found) == [(0, 1, 9), (0, 2, 6)]
    assert ann.nearest(frame.limit(0)).count() == 0


@pytest.mark.parametrize("cells", [1, 1 << 22])
def test_rerank_equals_brute_force(cells):
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.normal(size=(40, 6)), np.ones((30, 6)) * rng.integers(1, 9, (30, 1)), rng.normal(size=(20, 6)) * 1e200))
    entries = pd.DataFrame({"vec_id": rng.permutation(90), "vector": list(x)})
    queries = entries.rename(columns={"vec_id": "query_id", "vector": "query"})
    for k, of in ((5, entries), (200, entries), (5, entries[:1]), (5, entries[:0])):
        found = ann._rerank(k, cells=cells)((0, 0), of, queries)
        expected = []
        for i, q in zip(queries["query_id"], queries["query"], strict=True):
            rows = sorted((-s, v) for v, s in zip(of["vec_id"], ann.cosines(q, np.stack(of["vector"])) if len(of) else (), strict=True) if v != i)
            expected += [(i, v, -s) for s, v in rows[:k]]
        assert list(found.itertuples(index=False, name=None)) == expected


def test_walk_is_in_order_of_distance():
    rng = np.random.default_rng(5)
    a, b, sizes = rng.random(6), rng.random(5), rng.integers(0, 4, (6, 5))
    cells = ann.walk(a, b, sizes, 10**6)
    assert cells == [c for c in sorted(range(30), key=lambda c: a[c // 5] + b[c % 5]) if sizes[c // 5, c % 5]]
    some = ann.walk(a, b, sizes, 9)
    assert some == cells[: len(some)] and sum(sizes[c // 5, c % 5] for c in some) >= 9
    assert Counter(cells).most_common(1)[0][1] == 1

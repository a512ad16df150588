"""Exact search, page extraction and url filters against brute force, and their edge cases."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from retail_pulse.llm import htmltext, topk, urlfilter


# ---- exact top-k ----

def simple_top(rows, k):
    best: dict[tuple[int, int], int] = {}
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, a in good:
        if q % 100 == 0:
            for p, b in good:
                if p != q and len(a) == len(b):
                    s = sum(x * y for x, y in zip(a, b, strict=True))
                    best[q, p] = max(best.get((q, p), s), s)
    out = []
    for q in {q for q, _ in best}:
        own = sorted(((-s, p) for (x, p), s in best.items() if x == q))[:k]
        out += [(q, r + 1, p, -s) for r, (s, p) in enumerate(own)]
    return sorted(out)


@pytest.mark.parametrize("spread, options", [(0.0, {}), (2.0, {"bucket_rows": 40, "query_block": 3}), (1.0, {"bucket_rows": 32, "switch": 0.0, "query_block": 2}),
                                             (3.0, {"bucket_rows": 16, "switch": 0.5})])
def test_top_k_against_all_products(spark, spread, options):
    rng = random.Random(int(spread))
    rows = []
    for i in range(600):
        length = math.exp(rng.gauss(0, spread))
        rows.append((i, [rng.gauss(0, 1) * length / 3 for _ in range(8)]))
    for i in range(600, 640):  # close to one query, and ties
        rows.append((i, [x * 1.5 + (0.001 if i % 2 else 0) for x in rows[100][1]]))
    rows += [(700, [0.0] * 8), (701, [-0.0] * 8), (800, [1.0] * 8), (801, None), (802, [1.0, None] + [0.0] * 6), (803, [float("nan")] * 8),
             (804, [float("inf")] * 8), (None, [1.0] * 8), (900, [1.0, 2.0]), (901, [2.0, 1.0]), (1000, []), (1001, []), (5, rows[5][1]), (5, rows[6][1]), (800, [2.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", F.lit("clash")).withColumn("id", F.lit("clash")).repartition(4)
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, k=10, **options)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == simple_top(rows, 10)


def test_queries_without_a_positive_floor(spark):
    rng = random.Random(11)
    # a zero vector, and a sparse query whose products are all negative or zero
    rows = [(0, [0.0] * 12), (100, [-1.0] + [0.0] * 11), (200, [rng.random() for _ in range(12)])]
    rows += [(1000 - i * 3 + 1, [1 + rng.random() + (i < 20)] + [rng.random() for _ in range(11)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for switch in (0.0, -math.inf):
        got = topk.top_k(df, F.col("vec_id") % 100 == 0, k=10, bucket_rows=16, query_block=2, switch=switch)
        assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == simple_top(rows, 10)


def test_top_k_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 100 == 0).count() == 0


def test_products_beyond_exact_floats_stay_exact(spark):
    rows = [(0, [2.0**21 + 1 / 1024, 3.0]), (1, [2.0**21 + 3 / 1024, 5.0]), (2, [2.0**21, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score").collect()) == simple_top(rows, 10)


# ---- pages ----

PAGES = [
    ("", []), (None, []), ("just  text\n here", ["just text here"]),
    ("<p>One<div>Two</div>three", ["One", "Two", "three"]),
    ('<script>var t="</p>";</script><style>p{}</style><p>x &amp; y &lt;z&gt; &eacute;&#233;&nbsp;q', ["x & y <z> éé q"]),
    ("<article><h1>T</h1><p><b>a b.<br><p>c <i>d</i>e</p></article><footer>f</footer>", ["T", "a b.", "c de"]),
    ("<header>top</header><nav>menu</nav><main><div id='cookie-notice'>c</div><article><header><h1>H</h1></header><p>x</p><form>f</form>"
     "<section class='comments'><article>c</article></section><div class='ad-box'>ad</div></article></main><aside>s</aside>tail", ["H", "x"]),
    ("<body><div class='shadow'>kept</div><div class='sidebar'>gone</div><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></body>", ["kept", "a", "b", "1", "2"]),
    ("<p>unclosed <b>bold <p>next</i></p></p>end", ["unclosed bold", "next", "end"]),
    ("<div>" * 600 + "deep" + "</div>" * 600 + "<p>after", ["deep", "after"]),
    ("<b>" * 5000 + "bold" + "</b>" * 5000 + "<p>after", ["bold", "after"]),
    ("<div>" * 100_000 + "<script>x</script>deepest", ["deepest"]),
    ("<nav>" * 20_000 + "menu" + "</nav>" * 20_000 + "<p>after", ["after"]),
    ("<div>" * 300 + "<nav>" * 500 + "menu" + "</nav>" * 500 + "<p>in</p>" + "</div>" * 300 + "<p>after", ["in", "after"]),
    ("<p>a <button>press</button> b <span class='ad'>buy</span>c</p><select><option>x</select><nav><div>m</div></nav>d", ["a b c", "d"]),
    ("<p>a</p><![foo[ x ]]> b", ["a", "b"]), ("<p>a</p><![foo[ x", ["a"]), ("a<![CDATA[ b ]]> c", ["a c"]), ("<![", ["<!["]),
]


@pytest.mark.parametrize("html, want", PAGES)
def test_blocks_of_a_page(html, want):
    assert [t for t, _ in htmltext.blocks(html)[1]] == want


def test_slugs_of_ids_and_classes_take_nothing_from_an_article():
    html = ('<article><h2 id="market-share">a</h2><section id="side-effects"><p class="notice-period">b</p></section><div id="social-history">c</div>'
            '<h3 id="comments">d</h3><section id="recommendations">e</section><div class="ad">x</div><div id="comments">x</div><div class="lead share_buttons">x</div>'
            '<p class="advert">x</p></article>')
    assert [t for t, _ in htmltext.blocks(html)[1]] == ["a", "b", "c", "d", "e"]
    html = '<body><h2 id="market-share">a</h2><div id="social-history"><p class="notice-period">b</p></div><div class="left-sidebar">x</div><div id="cookie_notice">x</div></body>'
    assert [t for t, _ in htmltext.blocks(html)[1]] == ["a", "b"]


def test_site_templates_go_and_articles_stay(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, want = [], {}
    for i in range(60):
        host = "http://big.example.org" if i % 3 else "https://u:p@Other.example.com:80"
        own = " ".join(word() for _ in range(12))
        # no part is marked: the box that all pages of the host share is a template, the same sentence elsewhere is not
        rows.append((i, f"{host}/p{i}", f"<title>{i}</title><div><span>Join our list</span> today</div><p>{own}</p><p>Shared by few {i % 15}.</p>"))
        want[i] = f"{own}\nShared by few {i % 15}."
    for i in range(60, 90):  # copies of one article: the same title, so its text is no template
        rows.append((i, f"http://big.example.org/c{i}", "<title>copy</title><div>Join our list</div><p>The same article.</p>"))
        want[i] = "Join our list\nThe same article."
    for i in range(90, 120):  # a sentence of many marked articles is text, a box in them is not
        rows.append((i, f"http://art.example.org/{i}", f"<title>{i}</title><article><p>All rights reserved.</p><div>box <p>in</p></div><p>{i}</p></article>"))
        want[i] = f"All rights reserved.\n{i}"
    rows += [(200, None, "<p>a</p>"), (201, None, None), (None, "http://x.org", "<p>b</p>"), (1, rows[1][1], rows[1][2]), (202, "no host", "<p>" + "long " * 100_000)]
    want |= {200: "a", 201: "", None: "b", 202: ("long " * 100_000).strip()}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("hashes", F.lit(1)).repartition(3)
    got = htmltext.main_text(df).collect()
    assert len(got) == len(rows)
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    assert htmltext.main_text(df.limit(0)).count() == 0


def test_templates_of_hosts_with_one_title_or_none(spark):
    rows, want = [], {}
    for i in range(40):
        rows.append((i, f"http://one.example.org/{i}", f"<title>Our site</title><div>Join our list</div><p>Text {i}.</p>"))
        rows.append((100 + i, f"http://none.example.org/{i}", f"<div>The site</div><p>Text {i}.</p><div>All rights reserved</div>"))
        want |= {i: f"Text {i}.", 100 + i: f"Text {i}."}
        # copies of one article count as one page
        rows.append((200 + i, f"http://copy.example.org/{i}", "<title>c</title><div>Join our list</div><p>The same.</p>"))
        want[200 + i] = "Join our list\nThe same."
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    assert {r.page_id: r.text for r in got.collect()} == want


def simple_templates(rows, min_pages=5, min_share=0.1):
    """Counts in memory: (host, hash) of the subtrees that recur, by each page's identity."""
    seen, pages = {}, {}
    for host, html in rows:
        page = htmltext.parse(html)
        if page.texts:
            pages.setdefault(host, set()).add(page.identity())
            for h in page.hashes:
                if h is not None:
                    seen.setdefault((host, h), set()).add(page.identity())
    return {k for k, own in seen.items() if len(own) >= min_pages and len(own) >= min_share * len(pages[k[0]])}


def test_recurring_subtrees_of_whole_pages_are_counted_first(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        own = " ".join(f"w{rng.randrange(1000)}" for _ in range(8))
        menu = "".join(f"<li>Part {k}</li>" for k in ([1, 2, 3] if i % 2 else [rng.randrange(100) for _ in range(3)]))
        box = "<div class='x1'><p>Read this too</p><p>More</p></div>" if i % 3 else ""
        rows.append((i, "http://a.example.org/x", f"<body><nav><ul>{menu}</ul></nav><div class='ad'>{own[::-1]}</div><article><h1>{own[:9]}</h1><p>Shared sentence.</p>"
                     f"{box}<p>{own}</p></article><footer><div>Site</div> {i % 4}</footer></body>"))
        rows.append((100 + i, "http://b.example.org/x", f"<div class='q'>Welcome</div><div>{own}</div>" if i % 2 else f"<p>{own}</p>"))
    # a host of few pages has no templates: marks alone
    rows += [(200 + i, "http://few.example.org/", f"<nav>menu</nav><p>few {i}</p>") for i in range(3)]
    hosted = [(u.split("/")[2], h) for _, u, h in rows]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = htmltext.parsed(df)
    got = {(r.host, h) for r in htmltext.templates(found).collect() for h in r.template}
    assert got == simple_templates(hosted) and {h for h, _ in got} == {"a.example.org", "b.example.org"}
    for r in htmltext.main_text(df).collect():
        html = dict((i, h) for i, _, h in rows)[r.page_id]
        if r.page_id >= 200:
            assert (r.text, r.n_template, r.n_marked) == (f"few {r.page_id - 200}", 0, 1)
        elif r.page_id >= 100:
            own = re.findall(r">(w[^<]*)<", html)[0]
            assert (r.text, r.n_template, r.n_marked) == (own, "Welcome" in html, 0)
        else:  # the recurring menu, the box in the article and the footers go by count, the advert by its mark
            own = re.findall(r"<p>(w[^<]*)</p>", html)[0]
            assert r.text == f"{own[:9].strip()}\nShared sentence.\n{own}"
            assert r.n_template >= 2 + 2 * ("x1" in html) + 3 * (r.page_id % 2) and r.n_marked >= 1
            assert r.n_template + r.n_marked == 3 + 1 + 2 * ("x1" in html) + 2


# ---- urls ----

RULES = urlfilter.parse_rules(["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"])


def simple_parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url[url.index("://") + 3:])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def simple_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = ["http://a.example.net/en/1", "http://EXAMPLE.net/en", "https://example.net/en/", "ftp://x.net", "http://x.net/", "http://xnet/", "http://net/a?b", "http://b.example.com/de/x#y",
        "http://bexample.com/de/", "http://q.org/fr/1?u=http://z.net/", "http://q.org/FR/1", "no scheme", "", None, "http://", "http://?x", "http://É.NET/ü", "a://b://c.net/d",
        "http://h.com" + "/long" * 20_000, "http://example.com:80/de/", "HTTP://U@A.Example.COM/de/", "http://x.net\n/en/"]


def test_hosts_paths_rules_and_verdicts(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[1])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("id", F.lit("clash"))
    labelled = spark.createDataFrame([(f"http://h{i}.bad.com/x{i}", "block") for i in range(30)] + [(f"http://h{i}.good.com/y{i}", "allow") for i in range(30)], "url string, verdict string")
    model = urlfilter.train(labelled)
    got = urlfilter.judge(df, RULES, model)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    got = got.collect()
    assert len(got) == len(rows)
    urls = dict(rows)
    for r in got:
        host, path = simple_parts(urls[r.page_id])
        rule = simple_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        assert r.verdict == (rule.verdict if rule else "block" if r.score >= 0.5 else "allow") and 0 <= r.score <= 1
    asked = spark.createDataFrame([(1, "http://n.bad.com/x7"), (2, "http://n.good.com/y7")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(asked, RULES, model).collect()} == {1: "block", 2: "allow"}
    assert urlfilter.judge(df.limit(0), RULES, model).count() == 0


def test_url_model_without_both_kinds(spark):
    one = spark.createDataFrame([("http://a.com/", "block"), ("http://b.com/", None)], "url string, verdict string")
    asked = spark.createDataFrame([(1, "http://c.com/"), (2, "http://c.org/fr/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urlfilter.judge(asked, RULES, urlfilter.train(one)).collect()} == {1: "block", 2: "allow"}
    assert {r.verdict for r in urlfilter.judge(asked, [], urlfilter.train(one.limit(0))).collect()} == {"allow"}


def test_url_filter_runs_no_python(spark):
    labelled = spark.createDataFrame([(f"http://a{i}.com/", "block" if i % 2 else "allow") for i in range(20)], "url string, verdict string")
    plan = urlfilter.judge(spark.range(5).select(F.col("id").alias("page_id"), F.lit("http://x.com/a").alias("url")), RULES, urlfilter.train(labelled))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())

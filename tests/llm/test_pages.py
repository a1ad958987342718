"""Main text of pages and verdicts on URLs."""

import bisect
import random
import tracemalloc

from pyspark.sql import functions as F

from staffcast.llm import page_lines, url_trees


def page(i, frame=True):
    side = "<div>Site name</div><div class='top ad'>buy {0}</div>" if frame else ""
    return (
        f"<html><head><title>t{i}</title><style>p{{}}</style></head><body><nav><a href='/'>Home</a></nav>{side.format(i)}<div>Welcome &amp; hello</div>"
        f"<p>line {i} <b>one</b><br>two   {i}</p><script>var x = '<p>no</p>';</script><form>name <input></form><div id=comments><p>nice {i}</p></div>"
        "<div>All rights<br>reserved</div><footer>foot</footer></body></html>"
    )


def texts(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "n long, url string, html string, host string, row int").repartition(3)
    found = page_lines.main_text(df, "url", "html", ["n", "host"]).collect()
    assert all(r.n_chars == len(r.text) and r.kept.keep_host == "x" for r in found)
    return {r.kept.keep_n: r.text for r in found}


def test_lines_of_the_frame_go(spark):
    rows = [(i, f"http://h.com/a/{i}", page(i)) for i in range(5)] + [(5, "http://h.com/a/1?again", page(1)), (6, "http://alone.com/", page(6))]
    got = texts(spark, rows)
    for i, name in ((0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 1)):
        assert got[i] == f"line {name} one\ntwo {name}"
    assert got[6] == "Site name\nWelcome & hello\nline 6 one\ntwo 6\nAll rights\nreserved"


def test_articles_stay_whole(spark):
    own = "<body><nav>menu</nav><article><h1>A &lt;b&gt;</h1><p>same line</p><p>x &#233; &nbsp; y<aside>related</aside>z</article><p>copyright</p></body>"
    got = texts(spark, [(i, f"http://h.com/{i}", own.replace("x", f"x{i}")) for i in range(3)])
    assert got[1] == "A <b>\nsame line\nx1 é y\nz"


def test_odd_pages(spark):
    rows = [(0, None, None), (1, "", ""), (2, "zz", "no tags at all &am &amp x"), (3, "http://h/", "<p>open <div>never <b>closed"), (4, "http://h/", "<<>< p>a</p>"), (5, "http://h/x", "<!-- <p>no</p> "), (6, None, "<p>" + "word " * 50_000)]
    got = texts(spark, rows + rows[:3])
    assert (got[0], got[1], got[2], got[3], got[5]) == ("", "", "no tags at all &am & x", "open\nnever closed", "")
    assert len(got[6]) == 249_999
    assert page_lines.main_text(spark.createDataFrame([], "url string, html string"), "url", "html", []).count() == 0


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            best[i][j] = best[i - 1][j - 1] + 1 if x == y else max(best[i - 1][j], best[i][j - 1])
    return best[-1][-1]


def test_longest_common_lines():
    r = random.Random(2)
    for _ in range(400):
        a, b = ([r.randrange(6) for _ in range(r.randrange(12))] for _ in range(2))
        shared = page_lines.common_lines(a, b)
        own = [x for x, s in zip(a, shared, strict=True) if s]
        rest = iter(b)
        assert len(own) == lcs(a, b) and all(any(x == y for y in rest) for x in own)


def longest_rising(values):
    ends = []
    for v in values:
        at = bisect.bisect_left(ends, v)
        ends[at : at + 1] = [v]
    return len(ends)


def test_long_pages_need_little_memory():
    """Tens of thousands of shared lines between different first and last ones, in order, moved about, and repeated."""
    n, r = 30_000, random.Random(6)
    moved = list(range(n))
    for _ in range(200):
        at, to = r.randrange(n), r.randrange(n)
        moved.insert(to, moved.pop(at))
    repeats = [i % 50 for i in range(n)]
    for middle, other, want in ((list(range(n)), list(range(n)), n), (moved, list(range(n)), longest_rising(moved)), (repeats, repeats[7:], n - 7)):
        a, b = [-1, *middle, -2], [-3, *other, -4]
        tracemalloc.start()
        shared = page_lines.common_lines(a, b)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        rest = iter(b)
        assert shared.sum() == want and all(x in rest for x, s in zip(a, shared, strict=True) if s)
        assert peak < 100 << 20


def test_nearest_path_on_the_host(spark):
    rows = [("h", "/a/b/1", [1]), ("h", "/a/b/2", [2]), ("h", "/a/c", [3]), ("g", "/a/b/1", [4]), ("h", "/a/b/1", [1])]
    df = spark.createDataFrame([(i, *r, [1] * len(r[2])) for i, r in enumerate(rows)], "row long, host string, path string, hashes array<long>, kinds array<int>")
    got = {r.row: r.other for r in page_lines.neighbours(df).collect()}
    assert got == {0: [2], 1: [1], 2: [2], 4: [2]}


RULES = url_trees.RULES


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max((r.text for r in fits), key=len, default=None)


def test_hosts_paths_and_rules(spark):
    urls = [
        "http://A.Example.NET/en/x?y#z", "https://example.net", "ftp://example.net/en/", "x", None, "", "://", "http://org/fr/", "http://b.org/fr/?q",
        "http://example.com/de/1", "http://nexample.com/de/", "http://u:p@example.com:80/de/", "http://É.com/Ü", "http://a.net?x/", "a://b://c/d", "http://" + "a" * 20_000 + ".net/",
    ]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "n long, url string, host string")
    got = {r.n: r for r in url_trees.judge(df, "url", RULES, keep=["n"]).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rest = (u or "").partition("://")[2]
        host = rest
        for mark in "/?#":
            host = host.partition(mark)[0]
        path = rest[len(host) :].partition("?")[0].partition("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, plain_rule(host, path)), u
        assert got[i].verdict == next((r.verdict for r in RULES if r.text == got[i].rule), got[i].verdict)


def test_trees_learn_from_rules(spark):
    """What the labels follow is found again in urls that no rule names."""
    r = random.Random(4)
    good = [f"http://site{r.randrange(50)}.shop.test/{r.choice('abc')}" for _ in range(300)]
    bad = [f"http://win-{r.randrange(10**6)}-free.spam.test/x?id={r.randrange(10**9)}&q=1" for _ in range(300)]
    rules = [url_trees.Rule("allow", "shop.test/"), url_trees.Rule("block", "spam.test/")]
    more = [("allow", u.replace("shop.test", "store.test")) for u in good[:50]] + [("block", u.replace("spam.test", "junk.test")) for u in bad[:50]]
    rows = [(None, u) for u in good + bad] + more
    df = spark.createDataFrame(rows, "want string, url string")
    found = url_trees.judge(df, "url", rules, keep=["want"]).where("rule IS NULL").select("want", "verdict").collect()
    assert len(found) == 100 and sum(f.want == f.verdict for f in found) >= 95


def test_without_labels(spark):
    df = spark.createDataFrame([("http://a.b/",)], "url string")
    assert url_trees.judge(df, "url", RULES).select("verdict", "block_score").collect() == [("allow", None)]
    assert {r.verdict for r in url_trees.judge(df.union(spark.createDataFrame([("http://a.net/",)], "url string")), "url", RULES).collect()} == {"block"}
    assert url_trees.judge(df.limit(0), "url", RULES).count() == 0


def test_no_python_on_the_executors(spark):
    df = spark.createDataFrame([("http://a.net/",), ("http://example.net/en/",)], "url string").withColumn("n", F.lit(1))
    plan = url_trees.judge(df, "url", RULES, keep=["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

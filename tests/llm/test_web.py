import html
import re

import duckdb

from txrisk.llm import html_extract, url_filter

from .conftest import SF


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, text string, key int")


def test_marked_pages_equal_the_article(spark):
    got = {r["page_id"]: r for r in html_extract.op2_html_extract(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(p for p in parts if p)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
    assert len(got) == len(rows)


PAGE = """<html><body class="no-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
<div id="wrap" class="has-sidebar"><main><article><header><h1>Title &amp; more</h1></header><p>One<br>two <b>bold</b>
<p>a &lt; b<ul><li>x<li>y</ul><aside>side</aside><div class="share">share</div><form><input>f</form><!-- no -->
<section id="comments"><article class="comment"><p>nice</p></article></section><script>var a="<p>no</p>"</script></article></main></div><footer>x"""


def test_regions():
    assert html_extract.split_page(PAGE)[0].split("\n") == ["Title & more", "One two bold", "a < b", "x", "y"]
    assert html_extract.split_page("")[0] is None
    assert html_extract.split_page("a < b &lt; c <3 <a href='x>y'>z</a> <unclosed")[1] == ["a < b < c <3 z"]


def test_unmarked_pages_lose_the_runs_of_their_host(spark):
    template = "Welcome to our little site where all the good things are kept for you"
    own = lambda k: " ".join(f"p{k}w{j}" for j in range(9))
    rows = [(k, f"http://h{k % 2}.example.org/{k}", f"<body><div>{template}</div><div>{own(k)}</div><div>{template}</div>") for k in range(6)]
    rows += [(6, "http://other.example.org/a", f"<div>{template}</div><p>once</p>"), (7, None, None), (8, "x", ""), (9, "http://c.example.org/1", "<p>" + "one two " * 8),
             (10, "http://c.example.org/2", "<p>" + "one two " * 8), (None, None, "<article>kept</article>"), (None, None, "<article>kept</article>")]
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_extract.main_text(pages(spark, rows)).collect())
    copy = ("one two " * 8).strip()
    want = [(str(k), own(k)) for k in range(6)] + [("6", template + "\nonce"), ("7", ""), ("8", ""), ("9", copy), ("10", copy), ("None", "kept"), ("None", "kept")]
    assert got == sorted((i, t, len(t)) for i, t in want)
    assert html_extract.main_text(pages(spark, rows).limit(0)).count() == 0


def test_marked_pages_keep_their_text_outside_of_the_article(spark):
    """Main text around the article stays; unmarked text beside it stays unless the host repeats it."""
    line, own = "This line stands on every page of this little site of ours", lambda k: " ".join(f"p{k}w{j}" for j in range(9))
    page = lambda k: (f"<body><div>Our site</div><div>{line}</div><div>{own(k)}</div><main><h1>Title {k}</h1><article><p>one {k}</p></article>"  # noqa: E731
                      f"<p>after {k}</p></main><nav>menu</nav><div>last {k} {line}</div><article>two {k}</article><footer>foot</footer></body>")
    rows = [(k, "http://a.example.org/x", page(k)) for k in range(4)]
    rows += [(10, "http://b.example.org/", f"<p>{line}</p><article>alone</article><p>Our site</p>"), (11, "http://a.example.org/y", f"<div>Our site</div><article>bare</article><p>{line}</p>"),
             (12, None, "<article>a<p>b</article>c"), (13, "http://a.example.org/z", f"<div>Our site</div><div>{own(9)}</div>")]
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(pages(spark, rows)).collect()}
    want = {k: f"{own(k)}\nTitle {k}\none {k}\nafter {k}\nlast {k}\ntwo {k}" for k in range(4)}
    assert got == want | {10: f"{line}\nalone\nOur site", 11: "bare", 12: "a\nb\nc", 13: f"Our site\n{own(9)}"}


def test_urls_equal_sql(spark):
    rows = [
        (1, "http://EXAMPLE.com/en/x"), (2, "https://www.example.com/en/1"), (3, "ftp://a.b.example.com"), (4, "no scheme/en/"), (5, None), (6, ""),
        (7, "http://x.net/fr/9.html?q=/es/"), (8, "http://xnet/fr/1"), (9, "http://notexample.com/en/1"), (10, "http://u@y.NET:80/es/#a://b"), (None, "http://a.org/en/1"),
        (11, "http://a.org" + "/deep" * 200), (12, "://h/p"), (13, "http://z.org/en/1"), (13, "http://z.org/en/1"), (14, "http://z.org//"), (15, "http://É.org/ü/1\n2"),
    ] + [(100 + k, f"http://b.net/{'en' if k % 3 else 'es'}/{k}") for k in range(40)]
    docs = pages(spark, [(i, u, "") for i, u in rows])
    got = sorted(tuple(str(v) for v in r) for r in url_filter.judge_urls(docs).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    assert got == sorted(tuple(str(v) for v in r) for r in con.execute(url_filter.ORACLE_SQL).fetchall())
    by = {r[0]: r for r in got}
    assert by["1"][3:5] == ("example.com/en/", "block") and by["2"][3:5] == ("www.example.com/en/", "allow") and by["7"][3] == "net/fr/"
    assert by["4"][1:3] == ("", "") and by["8"][3] == "None" and by["9"][3] == "com/" and by["3"][3] == "None"
    assert url_filter.judge_urls(docs.limit(0)).count() == 0


def test_url_filter_is_native(spark):
    plan = url_filter.op4_url_filter(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|RDD", plan)


def test_many_sections_stay_apart(spark):
    """One host with 25 language sections, two of them blocked by a rule: no page of the other 23 is blocked."""
    langs = ["es", "fr"] + [a + b for a in "abcde" for b in "lmnop"][:23]
    rows = [(f"http://www.site.net/{x}/page-{x}-{i}.html",) for x in langs for i in range(200)]
    rows += [(f"http://small.net/{x}/{i}.html",) for x in langs for i in range(3)]
    docs = spark.createDataFrame([(k, u) for k, (u,) in enumerate(rows)], "page_id long, url string")
    out = url_filter.judge_urls(docs).cache()
    assert out.where("rule is null and verdict = 'block'").count() == 0
    assert out.where("rule is not null").count() == 406 and out.where("rule is not null and verdict <> 'block'").count() == 0
    assert out.where("host = 'www.site.net'").select("template").distinct().count() == 25


def test_branches_merge_level_by_level(spark):
    """Labels of like siblings count together; a branch that differs from its parent keeps its own."""
    leaves = []
    for k, (rows, n, bad) in enumerate([(10, 10, 10), (12, 12, 12), (40, 40, 0)]):
        leaves.append(("h", f"/a/s{k}", ["a", f"s{k}"], rows, n, bad))
    leaves += [("h", "/b/x", ["b", "x"], 30, 30, 15), ("h", "/b/y", ["b", "y"], 6, 0, 0), ("h", "", [], 1, 1, 0)]
    df = spark.createDataFrame(leaves, "host string, template string, tokens array<string>, rows long, n long, bad long")
    got = {r["template"]: (r["rows"], r["n"], r["bad"]) for r in url_filter.merged_nodes(df).collect()}
    # Two blocked leaves differ from their branch (35 % blocked) and stay alone, as does the clean one.
    assert got["/a/s0"] == (10, 10, 10) and got["/a/s1"] == (12, 12, 12) and got["/a/s2"] == (40, 40, 0)
    # /b/x is like /b, which is like the host's other branch; /b/y has no label and is like nothing.
    assert got["/b/x"] == (98, 92, 37) and got["/b/y"] == (6, 0, 0) and got[""] == (1, 1, 0)

"""Search, toxicity, pages and the pipeline."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmix.llm import block_search, html_extract, toxicity, url_filter
from gridmix.llm.common import configure


@pytest.fixture(scope="module", autouse=True)
def _configured(spark):
    configure(spark)


def brute_search(rows, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = set()
    for q, a in good:
        if q % 20 == 0:
            near = [(-sum(np.float64(x) * np.float64(y) for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b)]
            out |= {(q, r, i) for r, (_, i) in enumerate(sorted(near)[:k], 1)}
    return out


@pytest.mark.parametrize("blocks", [(1024, 4096), (8, 16)])
def test_block_search_is_exact(spark, monkeypatch, blocks):
    monkeypatch.setattr(block_search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(block_search, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(block_search, "FAN_IN", 3)
    monkeypatch.setattr(block_search, "TILE", 32)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype("f4").tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 8) for i in range(60)]  # many equal vectors
    rows += [(400, None), (420, [0.0] * 8), (440, [math.nan] * 8), (460, [math.inf] + [1.0] * 7), (461, [None] + [1.0] * 7),
             (480, []), (500, [1.0, 2.0]), (501, [3.0, -1.0]), (None, [1.0] * 8), rows[0], rows[20]]
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, block string")
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in block_search.search(df, F.col("vec_id") % 20 == 0, 5).collect()}
    assert got == brute_search(rows, 5)
    assert block_search.search(df.limit(0), F.col("vec_id") % 20 == 0, 5).count() == 0


def test_search_keeps_one_entry_of_each_id(spark, monkeypatch):
    rng = np.random.default_rng(3)
    ids, rows = np.arange(60) // 6, rng.normal(size=(60, 4))
    queries, asked = rng.normal(size=(5, 4)), np.arange(100, 105)
    rows[:6] = queries[0] * 5 + rng.normal(size=(6, 4)) * 0.01  # all of one id, all near
    shuffled = rng.permutation(60)
    for tile in (4, 16, 1024):
        monkeypatch.setattr(block_search, "TILE", tile)
        heaps = block_search.search_block(asked, queries, ids[shuffled], rows[shuffled], 5)
        for q, heap in zip(queries, heaps):
            best = {int(i): max((q * x).sum() for j, x in zip(ids, rows) if j == i) for i in ids}
            assert [-v for _, v in sorted(heap, reverse=True)] == sorted(best, key=lambda i: -best[i])[:5]
    df = spark.createDataFrame([*[(int(i) * 20 + 1, x.tolist()) for i, x in zip(ids, rows)], (0, queries[0].tolist())],
                               "vec_id long, embedding array<double>")
    found = block_search.search(df, F.col("vec_id") == 0, 5).collect()
    assert sorted(r["rank"] for r in found) == [1, 2, 3, 4, 5] and len({r["vec_id"] for r in found}) == 5


def test_merges_take_a_bounded_number_of_queries():
    for last in (False, True):
        for queries in (0, 1, 10 ** 6, 5 * 10 ** 6):
            assert queries / block_search.merge_parts(queries, last) <= 256
    assert block_search.merge_parts(100, True) == 64 and block_search.merge_parts(100, False) == 1024


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def toxic_table(n=400):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choice(WORDS, 8)) + "." for _ in range(int(rng.integers(1, 12)))]
        if i % 5 == 0:
            at = int(rng.integers(len(lines)))
            lines[at] = f"you vile{rng.choice(['ness', 'st', 'r'])} gamma."
        rows.append((i, " ".join(lines), int(i % 5 == 0)))
    return rows


def test_toxicity_learns_from_documents_and_finds_sentences(spark):
    rows = toxic_table()
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t, _ in rows] + [(1000, None, "", ""), (1001, "", "", ""), (None, "x", "", ""),
                                                                         (1002, "alpha " * 50_000, "", "")],
                                 "doc_id long, text string, score string, TOXIC string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.scores(docs, model).collect()}
    assert len(found) == len(rows) + 4
    for i, t, y in rows:
        assert (found[i]["score"] >= 0.3) == bool(y)
        if y:
            assert "vile" in t[found[i]["worst_start"]:found[i]["worst_end"]] and found[i]["n_offending"] == 1
        else:
            assert found[i]["n_offending"] == 0
    assert all(0 <= r["score"] <= 1 for r in found.values()) and found[1000]["score"] == found[1001]["score"] < 0.3
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if r["score"] < 0.3}


def test_toxicity_ignores_held_out_labels(spark):
    rows = toxic_table(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    out = labels.select("doc_id", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    assert out.exceptAll(labels).count() > 0
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, out)
    import zlib

    held = {r["doc_id"] for r in docs.where(toxicity.held_out(F.col("doc_id"))).collect()}
    assert held == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] < 0.3 for r in toxicity.scores(docs, model).collect()] == [True, True]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><div>Site</div></header>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><div id="cookie-notice">Cookies</div><div class="content post-%d"><h1>A &amp; B</h1>
<p>One <i>two</i>\n three.<p>Four&nbsp;five<br>six<ul><li>a<li>b</ul><div class="ad">Buy</div><form><p>Mail</p></form>%s</div>
<section class="comments"><p>%s</p></section><footer>F</footer><script>if (a<b) "</p>"</script></body></html>"""
TEXT = "A & B\nOne two three.\nFour five\nsix\na\nb\nbody text of the article that is long enough"


def test_main_text_by_host_votes(spark):
    body = "body text of the article that is long enough"
    rows = [(i, f"http://h.example/{i}", PAGE % (i, body, "reader " * 3)) for i in range(20)]
    # Another container is larger here; the host's other pages outvote it.
    rows.append((50, "http://H.example/50", PAGE.replace('class="comments"', 'class="extra"') % (50, body, "long " * 100)))
    rows += [(60, "http://h.example/n", None), (61, None, ""), (62, "no host", "<p>plain &lt;text&gt; 1 < 2"), (0, *rows[0][1:]),
             (63, "http://i.example/", "<article><p>cut off <b>in a ta"), (64, "http://i.example/", "<article><p>x</p><p clas")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, TEXT string").repartition(3)
    found = {(r["page_id"], r["url"]): r for r in html_extract.main_text(df).collect()}
    assert html_extract.main_text(df).count() == len(rows)
    for i in range(20):
        assert found[i, f"http://h.example/{i}"]["text"] == TEXT
    assert found[50, "http://H.example/50"]["text"] == TEXT
    assert found[60, "http://h.example/n"]["text"] == found[61, None]["text"] == ""
    assert found[62, "no host"]["text"] == "plain <text> 1 < 2" and found[62, "no host"]["n_chars"] == 18
    assert found[63, "http://i.example/"]["text"] == "cut off in a ta" and found[64, "http://i.example/"]["text"] == "x"
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_main_text_keeps_all_of_nested_containers(spark):
    part = "word " * 40
    article = f"<article><h1>Title</h1><p>lead {part}</p><section><p>{part * 5}</p></section></article>"
    sections = "".join(f"<section class='{c}'><p>{c} {part * n}</p></section>" for c, n in (("a", 6), ("b", 3), ("c", 1)))
    table = f"<div class='text'><h1>Title</h1><p>lead</p><table><tr><td>{part * 9}</td><td>x</td></tr></table></div>"
    head, foot = "<html><body><div class='top'><p>Site name</p></div>", "<div class='end'>Imprint</div></body></html>"
    bodies = {"nested": article, "sections": f"<main><h1>Title</h1>{sections}</main>", "div": f"<div class='text'>{sections}</div>",
              "table": table, "two": "".join(f"<article class='{c}'><p>{c} {part * n}</p></article>" for c, n in (("a", 6), ("b", 4)))}
    rows = [(i, f"http://{h}.example/{i}", head + b + foot) for h, b in bodies.items() for i in range(3)]
    # The other pages of the host have one section only.
    rows += [(10 + i, f"http://div.example/{i}", f"{head}<div class='text'><section class='a'><p>{part * 6}</p></section></div>{foot}")
             for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {(r["page_id"], r["url"].split("/")[2][:-8]): r["text"].split() for r in html_extract.main_text(df).collect()}
    words = ["word"] * 40
    three = ["a", *words * 6, "b", *words * 3, "c", *words]
    for i in range(3):
        assert found[i, "nested"] == ["Title", "lead", *words, *words * 5]
        assert found[i, "sections"] == ["Title", *three]
        assert found[i, "div"] == three and found[10 + i, "div"] == words * 6
        assert found[i, "table"] == ["Title", "lead", *words * 9, "x"]
        assert " ".join(["a", *words * 6, "b", *words * 4]) in " ".join(found[i, "two"])


LONG = "word " * 60


@pytest.mark.parametrize("page", [
    *[f"<article><p>one {x} two</p><p>{LONG}</p></article>" for x in ("<svg class='icon'/>", "<math/>", "<canvas />", "<SVG/>")],
    *[f"<article><h2>one<{x}><g></h2><p>two {LONG}</p></article>" for x in ("svg", "canvas", "iframe src=x", "object")],
    f"<article><h2>one<svg><path d='x'>label</h2><p>two {LONG}</p><svg><svg><g>no</g></svg>no</svg></article>",
    f"<article><p>one two<svg>no</svg><script>'<svg>'</script> {LONG}</p></article>",
    f"<head><title>no<meta x=y></head><article><p>one two {LONG}</p></article>",
    *[f"<body><div {x}><article><p>one two {LONG}</p></article><div class='sidebar'>no</div></div></body>" for x in (
        "class='has-sidebar'", "class='a content-sidebar-wrap'", "id='social-history'", "class='has-comments'")],
    f"<body><div id='social-history'><p>one two {LONG}</p></div><div class='social'>no</div></body>",
    "<body>" + "".join(f"<div class='elementor-widget elementor-widget-{k}'><div class='elementor-widget-container'><p>{t}</p></div></div>"
                       for k, t in (("heading", "one two"), ("text", "word " * 30), ("text-2", "word " * 30), ("nav-menu", "no"))),
    f"<body><main><article><p>one two {LONG}</p></article><div class='comments'><article>{'no ' * 200}</article></div>"
    "<div class='related-posts'><article>no</article></div><div class='sidebar'><article>no</article></div></main></body>",
])
def test_blocks_keep_articles(page):
    found = html_extract.blocks(page)
    text = html_extract.extract(found, [p[0] for p in [html_extract.best_path(found)] if p])
    assert text.split() == ["one", "two", *LONG.split()]


def test_url_rules_and_link_graph(spark):
    urls = {1: "http://a.net/x", 2: "https://Example.NET/en/1?q", 3: "http://w.example.com/de/", 4: "http://x.org/fr/a#t", 5: None,
            6: "nonsense", 7: "http://b.net", 8: "http://notnet/x", 9: "http://evil.com/", 10: "http://good.com/p", 11: "http://q.org?fr/"}
    links = {9: '<a href="http://a.net/1">s</a>' * 5, 4: "<a class=x href='http://good.com/z'>g</a>", 2: '<a href="/rel">r</a>'}
    rows = [(i, u, links.get(i), 1) for i, u in urls.items()] + [(1, urls[1], None, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = {r["page_id"]: r for r in url_filter.verdicts(df).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(1, 5)] == [
        ("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    assert (got[2]["host"], got[2]["path"]) == ("example.net", "/en/1") and (got[11]["host"], got[11]["path"]) == ("q.org", "")
    assert [(got[i]["host"], got[i]["path"], got[i]["verdict"]) for i in (5, 6)] == [("", "", "allow")] * 2
    assert got[7]["rule"] is None and got[8]["rule"] is None  # no path of its own; another host
    assert got[9]["verdict"] == "block" and got[9]["rule"] is None  # it links to a blocked host
    assert got[10]["verdict"] == "allow" and got[10]["trust"] > 0
    assert url_filter.verdicts(df).count() == len(rows) and url_filter.verdicts(df.limit(0)).count() == 0
    assert [r["verdict"] for r in url_filter.verdicts(df.drop("html").withColumn("html", F.lit(None).cast("string"))).where(
        "page_id = 9").collect()] == ["allow"]


def test_distrust_from_hosts_without_pages_and_over_long_chains(spark):
    def verdicts(pairs):
        rows = [(i, f"http://{host}/", f'<a href="{link}">x</a>') for i, (host, link) in enumerate(pairs)]
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return {r["host"]: r["verdict"] for r in url_filter.verdicts(df).collect()}

    # spam.net is blocked and has no page.
    assert verdicts([("evil.com", "http://spam.net/"), ("good.com", "http://fine.com/")]) == {"evil.com": "block", "good.com": "allow"}
    # The last host is 15 links away; many others make an even share small.
    chain = [("h0.com", "http://spam.net/")] + [(f"h{i}.com", f"http://h{i - 1}.com/") for i in range(1, 15)]
    far = verdicts(chain + [(f"x{i}.com", f"http://y{i}.com/") for i in range(20)])
    assert [far[f"h{i}.com"] for i in range(15)] == ["block"] * 15 and far["x0.com"] == "allow"


def test_links_of_any_case_and_without_a_scheme(spark):
    links = ['<A HREF="http://spam.net/">', '<a href="//spam.net/x">', "<a class=x Href=//SPAM.net?u=http://fine.com/>", "<a href=' HTTPS://spam.net'>",
             '<a href="/spam.net/">', '<a href="x//spam.net/">', '<a href="#//spam.net">', "<a>//spam.net/</a>"]
    rows = [(i, f"https://h{i}.com/", html) for i, html in enumerate(links)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = url_filter.host_edges(df.withColumn("host", url_filter.host_of(F.col("url"))))
    assert {tuple(r) for r in edges.collect()} == {(f"h{i}.com", "spam.net", 1) for i in range(4)}
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.verdicts(df).collect()}
    assert verdicts == {i: "block" if i < 4 else "allow" for i in range(8)}


def test_spread_ends_at_the_fixed_point(spark):
    pairs = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 4), ("d", "c", 1)]
    got = {r["host"]: r["mass"] for r in url_filter.spread(
        spark.createDataFrame(pairs, "src string, dst string, links long"),
        spark.createDataFrame([("a", 0.5), ("d", 0.5)], "host string, share double"), 0.5, rest=1e-4).collect()}
    names = "abcd"
    step = np.zeros((4, 4))
    for s, d, n in pairs:
        step[names.index(d), names.index(s)] = n / sum(m for x, _, m in pairs if x == s)
    exact = np.linalg.solve(np.eye(4) - 0.5 * step, 0.5 * np.array([0.5, 0, 0, 0.5]))
    assert sum(abs(got[h] - x) for h, x in zip(names, exact)) <= 1e-4


def test_spread_equals_power_iteration(spark):
    pairs = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 4), ("d", "c", 1)]
    got = {r["host"]: r["mass"] for r in url_filter.spread(
        spark.createDataFrame(pairs, "src string, dst string, links long"),
        spark.createDataFrame([("a", 0.5), ("d", 0.5)], "host string, share double"), 0.8, 6).collect()}
    mass = seeds = Counter({"a": 0.5, "d": 0.5})
    for _ in range(6):
        out = Counter({h: 0.2 * s for h, s in seeds.items()})
        for s, d, n in pairs:
            out[d] += 0.8 * mass[s] * n / sum(m for x, _, m in pairs if x == s)
        mass = out
    assert got == pytest.approx(dict(mass))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    good = " ".join(["the", "word", "of", "some", "length", "and", "more"][k % 7] + str(k) * (k % 7 not in (0, 2, 5)) for k in range(60))
    rows = [(i, t + " " + " ".join(f"w{i}x{k} the" for k in range(30))) for i, t, _ in toxic_table(150)]
    rows += [(1000, good), (1001, good), (1002, good.replace("the ", "the  ")), (1003, "# $ % " * 20), (1004, None), (1005, ""), (1001, good)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in toxic_table(150)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "simhash_dedup", "packing"]
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r["doc_id"] for r in now.collect()})
    clean = {i for i, _, y in toxic_table(150) if not y}
    assert seen[0] == clean | {1000, 1001, 1002, 1003, 1004, 1005}
    assert seen[1] == clean | {1000, 1001, 1002}
    assert seen[2] & {1000, 1001, 1002} == {1000} and clean == seen[2] - {1000}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == seen[2]


def test_near_copies_go_by_row(spark, tmp_path):
    import corpus_pipeline

    def text(k):
        return " ".join(f"w{k}x{i}" for i in range(60))

    rows = [(1, text(0)), (1, text(1)), (2, text(1)), (1, text(0)), (3, text(2)), (None, text(2)),  # id 1 has two texts
            (None, text(3)), (None, text(3)), (None, text(3).replace(" ", "  ", 1)), (None, text(4)), (5, text(0))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(3)
    out = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    found = sorted(((r["doc_id"] or 0, " ".join(r["text"].split())) for r in out.collect()))
    assert found == sorted([(1, text(0)), (1, text(1)), (3, text(2)), (0, text(3)), (0, text(4))])
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), str(tmp_path)).count() == 0


# Pages: no article is lost, and time and memory are linear in the depth


def texts_of(spark, rows):
    df = spark.createDataFrame([(i, u, x) for i, (u, x) in enumerate(rows)], "page_id long, url string, html string").repartition(3)
    return [r["text"] for r in html_extract.main_text(df).orderBy("page_id").collect()]


def words(n, tag=""):
    return " ".join(f"{tag}w{i}" for i in range(n))


def test_a_nearly_empty_usual_container_does_not_win(spark):
    usual = [("http://h.example/", f"<main><p>{words(60, i)}</p></main>") for i in range(10)]
    odd = ("http://h.example/o", f"<body><main><p>Loading</p></main><div class='story'><p>{words(90)}</p></div></body>")
    got = texts_of(spark, [*usual, odd])
    assert got[:10] == [words(60, i) for i in range(10)] and words(90) in got[10]


def test_many_templates_of_a_host_are_all_tried(spark):
    rows = [("http://h.example/", f"<body><div class='{c}'><p>{words(80, c)}</p></div><p>x</p></body>") for c in "abcdefghij" for _ in range(2)]
    # The page of a rare template has a teaser in a usual container, div or article.
    for tag in ("div class='a'", "article class='teaser'"):
        page = f"<body><{tag}><p>a teaser of some few words</p></{tag.split()[0]}><div class='rare'><p>{words(80)}</p></div></body>"
        got = texts_of(spark, [*rows, ("http://h.example/", page)])
        assert words(80) in got[-1]
        assert all(words(80, c) in t for c, t in zip("aabbccddeeffgghhiijj", got))


def test_article_text_in_a_sibling_container_stays(spark):
    page = f"<body><div class='wrap'><div class='lead'><p>{words(16, 'lead')}</p></div><div class='body'><p>{words(184)}</p></div></div></body>"
    plain = f"<body><div class='wrap'><div class='body'><p>{words(100)}</p></div></div></body>"
    got = texts_of(spark, [("http://h.example/1", page)] + [("http://h.example/2", plain)] * 9)
    assert got[0] == words(16, "lead") + "\n" + words(184) and got[1:] == [words(100)] * 9
    assert texts_of(spark, [("http://i.example/1", page)] * 2) == [words(16, "lead") + "\n" + words(184)] * 2


def test_xmp_math_and_headers_of_articles(spark):
    page = (f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1><p>by</p><nav><h2>no</h2></nav></header><p>{words(20)}"
            "<math><mi>x</mi><annotation>no</annotation></math></p><xmp>a <b> &amp; c</xmp><p class='share-price'>up</p>"
            "<p class='notice'>no</p><div class='share-box'>no</div></article></body>")
    assert texts_of(spark, [("http://h.example/", page)]) == [f"Title\n{words(20)}x\na <b> &amp; c\nup"]


def test_deep_pages_take_linear_memory():
    import resource
    import time

    times = []
    for depth in (50_000, 100_000):
        page = "<div class='d'>" * depth + f"<p>{words(30)}</p>" + "</div>" * depth
        start = time.process_time()
        parsed = html_extract.blocks(page)
        best = html_extract.best_path(parsed)
        assert html_extract.extract(parsed, [best[0]]) == words(30)
        times.append(time.process_time() - start)
    marked = "<div class='ad x'><div class='sidebar y'>" * 20_000 + "text" + "</i>" * 20_000
    assert html_extract.blocks(marked).rows
    assert times[1] < 4 * times[0] + 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < 1_500_000  # KB, the test session with it


def plain_choice(pages):
    """Texts by a plain restatement of the vote: trees of (path, blocks), chains and votes by path strings."""
    kinds, votes = [], Counter()
    for page in pages:
        parsed = html_extract.blocks(page)
        paths = [""]
        for parent, name in zip(parsed.parents[1:], parsed.names[1:]):
            paths.append(f"{paths[parent]}>{name}")
        rows = [(paths[n], t, 0 if len(t) <= 2 * k else len(t) - k) for n, skip, t, k in parsed.rows if not skip]
        best = html_extract.best_path(parsed)
        if best:
            votes[paths[best[0]]] += round(best[1] * 1000)
        kinds.append((paths[best[0]] if best else "", rows))
    out = []
    for best, rows in kinds:
        parts = best.split(">")[1:]
        chain = [">" + ">".join(parts[:i]) for i in range(1, len(parts) + 1)]
        won = max([c for c in chain if votes[c]], key=lambda c: (votes[c], -len(c)), default="")
        out.append("\n".join(t for p, t, _ in rows if p == won or p.startswith(won + ">") or not won))
    return out


def test_votes_equal_a_plain_restatement(spark):
    rng = np.random.default_rng(9)
    pages = []
    for i in range(60):
        def box(depth):
            if depth == 0 or rng.random() < 0.3:
                return f"<p>{words(int(rng.integers(1, 25)), i)}</p>"
            inner = "".join(box(depth - 1) for _ in range(int(rng.integers(1, 4))))
            return f"<div class='{rng.choice(list('abc'))}'>{inner}</div>"
        pages.append(f"<body>{box(4)}</body>")
    assert texts_of(spark, [("http://h.example/", p) for p in pages]) == plain_choice(pages)


CLASHING = ("doc_id long, text string, TEXT string, _id int, _hash string, _row int, c0 double, fp long, root long, first long, "
            "component_id long, base int, blocks int, length string, score double, n_words int, keep array<int>")


def clashing_table(spark, texts):
    rows = [(i, t, "other", 7, "h", i or 0, 0.5, 1, 2, 3, 4, 5, 6, "l", 0.25, 9, [1, 2]) for i, t in texts]
    return spark.createDataFrame(rows, CLASHING)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_return_the_columns_and_values_of_their_input(spark, tmp_path):
    import corpus_pipeline

    good = [" ".join(["the", "word", "of", "some", "length", "and", "more"][k % 7] + str(k) * (k % 7 not in (0, 2, 5)) + "abcdefgh"[i] * (k % 3 == 1)
                     for k in range(60)) for i in range(4)]
    texts = [(i, t) for i, t in enumerate(good)] + [(9, good[0]), (10, None), (None, ""), (11, "short"), (0, good[0])]
    docs = clashing_table(spark, texts)
    assert len(docs.columns) == len(CLASHING.split(", "))
    spark.createDataFrame([(0, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    all_rows = as_rows(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        got = as_rows(out)
        assert set(map(str, got)) <= set(map(str, all_rows))
        ids = [r[0] for r in got]
        if name == "toxicity":
            assert got == all_rows
        elif name == "quality_rules":
            assert sorted(ids) == [0, 0, 1, 2, 3, 9]
        else:
            assert sorted(i for i in ids if i is not None and i < 9) == [0, 1, 2, 3] and len(ids) == 6
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.columns == docs.columns and empty.count() == 0
    packed = corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in packed) == sorted((i is None, i or 0) for i, _ in texts)
    assert corpus_pipeline.pack(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_rows_equal_in_id_and_text_leave_the_same_one(spark, tmp_path):
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text, f"lang{i}") for i in range(20)]
    kept = {as_rows(corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(n), ""))[0]
            for order, n in ((rows, 1), (rows[::-1], 3), (rows[7:] + rows[:7], 5))}
    assert len(kept) == 1


def test_windows_keep_columns_of_any_name(spark):
    from gridmix.llm import packing

    rows = [(i, 1 + i % 9, i, "x", i, 5, 6) for i in range(50)]
    df = spark.createDataFrame(rows, "base long, length long, blocks long, _rank string, n long, LENGTHS int, offset int")
    out = packing.assign_windows(df, 16, block=3)
    assert out.columns == ["base", "length", "blocks", "_rank", "n", "LENGTHS", "sequence_id", "offset"]
    got = out.collect()
    assert sorted((r["base"], r["length"], r["blocks"], r["_rank"], r["n"]) for r in got) == [(i, 1 + i % 9, i, "x", i) for i in range(50)]
    used = Counter()
    for r in got:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 16 and sum(used.values()) == sum(r[1] for r in rows)
    with pytest.raises(ValueError):
        packing.assign_windows(spark.createDataFrame([(None,)], "length long"), 16)


def test_a_verdict_does_not_depend_on_unrelated_links(spark):
    def judged(rows):
        df = spark.createDataFrame([(i, u, x) for i, (u, x) in enumerate(rows)], "page_id long, url string, html string")
        return {r["host"]: (r["verdict"], round(r["trust"], 6), round(r["distrust"], 6)) for r in url_filter.verdicts(df).collect()}

    own = [("http://spam.net", None), ("http://fine.com/", ""), ("http://example.net/en/x", "")]
    alone = judged(own)
    assert alone["spam.net"] == ("block", 0.0, 0.15) and alone["fine.com"] == ("allow", 0.0, 0.0)
    assert alone["example.net"][0] == "allow" and alone["example.net"][1] == 0.15
    pair = [("http://u.com/", '<a href="http://v.com/">x</a>')]
    many = [(f"http://u{i}.com/", f'<a data-href="//spam.net" href="http://v{i}.com/">x</a>') for i in range(30)]
    more = [(f"http://b{i}.net", None) for i in range(10)]
    for other in (pair, many, more, [*pair, *many, *more]):
        assert judged([*own, *other]).items() >= alone.items()
    linked = judged([*own, ("http://evil.com/", '<a href="http://spam.net">x</a>'), *many])
    assert linked["evil.com"] == ("block", 0.0, round(0.15 * 0.85, 6)) and linked["u3.com"] == ("allow", 0.0, 0.0)
    only = judged([("http://h.com/", '<a data-href="//spam.net">x</a>'), ("http://spam.net", None)])
    assert only["h.com"][0] == "allow"


def test_rounds_leave_two_tables(spark):
    from gridmix.llm.common import shared_dir
    from gridmix.sources.sinks import folders

    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(12)], "src string, dst string, links long")
    before = sum("llm-mass" in f for f in folders(spark, shared_dir(spark)))
    url_filter.spread(edges, spark.createDataFrame([("h0", 1.0)], "host string, share double"), rest=1e-6).count()
    assert sum("llm-mass" in f for f in folders(spark, shared_dir(spark))) - before <= 2


def test_query_tiles_give_what_one_tile_gives(monkeypatch):
    rng = np.random.default_rng(12)
    asked, queries = np.arange(70) * 3, rng.normal(size=(70, 6))
    ids, rows = np.arange(200), rng.normal(size=(200, 6))
    whole = [sorted(h) for h in block_search.search_block(asked, queries, ids, rows, 7)]
    for tile in (1, 16, 64):
        monkeypatch.setattr(block_search, "TILE", tile)
        assert [sorted(h) for h in block_search.search_block(asked, queries, ids, rows, 7)] == whole


def test_cells_of_a_search_are_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(block_search, "CANDIDATE_BLOCK", 10)
    rng = np.random.default_rng(13)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(200)], "vec_id long, embedding array<double>")
    plan = block_search.search(df, F.col("vec_id") % 20 == 0, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"RepartitionByExpression \[dim#\d+, query_block#\d+, block#\d+\], 20\b", plan)


def test_noisy_or_equals_a_plain_product():
    rng = np.random.default_rng(21)
    model = toxicity.Model({w: float(rng.normal()) for w in [*WORDS[:6], "alph~", "gamm~"]}, -1.5)
    for _ in range(200):
        text = "".join(rng.choice([*(f" {w}" for w in WORDS), " Alphabet", "gammas", ". ", "!\n", "?", " ", "?alpha"]) for _ in range(30))
        clean = 1.0
        spots = 0
        for sentence in re.split(r"[.!?\n]", text.lower()):
            held = {w for chunk in sentence.split() for w in toxicity.features(chunk)}
            z = model.bias + sum(model.weights.get(f, 0.0) for f in held)
            clean *= 1 - 1 / (1 + math.exp(-z))
            spots += any(f in model.weights for f in held)
        score, found = model.score(text)
        assert score == pytest.approx(1 - clean, rel=1e-9, abs=1e-12) and len(found) == spots


def test_gradient_equals_differences():
    rng = np.random.default_rng(22)
    data = [{"toxic": int(rng.integers(2)), "plain": int(rng.integers(0, 5)),
             "bags": [sorted(set(rng.integers(0, 6, int(rng.integers(1, 4))).tolist())) for _ in range(int(rng.integers(0, 4)))]} for _ in range(40)]
    data.append({"toxic": 1, "plain": 1, "bags": []})
    bags = toxicity.Bags(data, 6)
    theta = rng.normal(size=7)
    step = 1e-6
    for i in range(7):
        up, down = theta.copy(), theta.copy()
        up[i] += step
        down[i] -= step
        assert bags.gradient(theta)[i] == pytest.approx((bags.loss(up) - bags.loss(down)) / (2 * step), abs=1e-6)
    weights, bias = toxicity.descend(data, 6)
    assert bags.loss(np.append(weights, bias)) < bags.loss(np.append(np.full(6, 3.0), -8.0))


def test_toxicity_sample_is_bounded_and_tables_may_be_empty(spark, monkeypatch):
    rows = toxic_table(120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(500, "long " * 1000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(500, 1)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "LONGEST", 4000)
    assert toxicity.sample(docs, labels).where("length(text) > 4000").isEmpty()
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 3000)
    got = toxicity.sample(docs, labels)
    assert 0 < got.agg(F.sum(F.octet_length("text"))).first()[0] <= 3000
    model = toxicity.fit(docs.limit(0), labels)
    assert toxicity.scores(docs.limit(0), model).count() == 0 and toxicity.without_toxic(docs.limit(0), model).count() == 0

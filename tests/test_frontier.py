import gzip
import random

import pytest

from webcorpus.operators import frontier as R
from webcorpus.operators.schedule import worker_schedule
from webcorpus.sources import sitemaps as M

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="http://www.google.com/schemas/sitemap-image/1.1"'


def urlset(*locs, extra=""):
    return f"<urlset {NS}>{''.join(f'<url><loc>{x}</loc></url>' for x in locs)}{extra}</urlset>".encode()


def bodies(spark, rows):
    rows = [(u, 200, b) if not isinstance(b, tuple) else (u, *b) for u, b in rows]
    return spark.createDataFrame(rows, "sitemap_url string, status int, body binary")


def locs(spark, body):
    rows = M.sitemap_locs(bodies(spark, [("s", body)])).orderBy("pos").collect()
    return [r.loc for r in rows]


def walk(spark, sitemaps, root="r.xml", **options):
    made = bodies(spark, [(u, urlset(*links)) for u, links in sitemaps.items()])
    roots = spark.createDataFrame([(r,) for r in ([root] if isinstance(root, str) else root)], "root string")
    rows = R.frontier(roots, M.sitemap_links(made), **options).orderBy("ord").collect()
    return [r.url for r in rows]


def test_locs_are_stripped(spark):
    assert locs(spark, urlset(" https://a/1 ")) == ["https://a/1"]


def test_image_locs_count(spark):
    image = "<url><image:image><image:loc>https://a/i.jpg</image:loc></image:image></url>"
    assert locs(spark, urlset("https://a/1", extra=image)) == ["https://a/1", "https://a/i.jpg"]


def test_blank_loc_gives_no_row(spark):
    assert locs(spark, urlset("  ", "")) == []


def test_text_ends_at_comment_and_cdata_is_text(spark):
    assert locs(spark, urlset("a<!-- c -->b", "<![CDATA[https://a/?x=1&y=2]]>")) == ["a", "https://a/?x=1&y=2"]


def test_gzip_is_told_by_content(spark):
    assert locs(spark, gzip.compress(urlset("https://a/1"))) == ["https://a/1"]


def test_bad_bodies_give_no_rows(spark):
    good = urlset("https://a/1")
    rows = [
        ("html", b"<!DOCTYPE html><p>x"), ("html2", b"  <HTML>"), ("bad", b"<urlset><loc>"),
        ("404", (404, good)), ("null", (None, good)), ("empty", b""), ("gz", gzip.compress(good)[:20]),
        ("gzhtml", gzip.compress(b"<html></html>")), ("latin", "é".encode() * 249 + b"xx\xc3\xa9"), ("good", good),
    ]
    made = bodies(spark, rows)
    assert {r.sitemap_url for r in M.sitemap_locs(made).collect()} == {"good"}
    reasons = {r.sitemap_url: r.reason for r in M.reject_bad_sitemaps(made).collect()}
    assert reasons == {
        "html": "html", "html2": "html", "bad": "malformed", "404": "status", "null": "status",
        "empty": "empty", "gz": "unreadable", "gzhtml": "html", "latin": "malformed",
    }


def test_sitemap_links_by_ending(spark):
    rows = spark.createDataFrame([("HTTPS://A/S.XML",), ("https://a/s.xml.gz",), ("https://a/s.xml?x=1",)], "loc string")
    assert [r.is_sitemap for r in M.split_locs(rows).collect()] == [True, True, False]


def test_pages_come_before_children(spark):
    tree = {"r.xml": ["c1.xml", "p1", "p2"], "c1.xml": ["p3", "p1"]}
    assert walk(spark, tree) == ["p1", "p2", "p3"]
    assert walk(spark, tree, limit=3) == ["p1", "p2", "p3"]
    assert walk(spark, tree, limit=1) == ["p1"]
    assert walk(spark, tree, limit=0) == ["p1", "p2", "p3"]


def test_limit_precedes_dedup(spark):
    assert walk(spark, {"r.xml": ["p1", "p1", "p2"]}, limit=2) == ["p1"]


def test_limit_after_skip_goes_on(spark):
    stored = spark.createDataFrame([("", "p1"), ("", None)], "source string, url string")
    tree = {"r.xml": ["p1", "p2", "p3"]}
    assert walk(spark, tree, existing=stored) == ["p2", "p3"]
    assert walk(spark, tree, existing=stored, limit=1) == []
    assert walk(spark, tree, existing=stored, limit=1, limit_after_skip=True) == ["p2"]


def test_cycles_end(spark):
    tree = {"r.xml": ["c1.xml", "p1"], "c1.xml": ["r.xml", "c1.xml", "p2"]}
    assert walk(spark, tree) == ["p1", "p2"]


def depth_first(tree, root):
    seen, out = set(), []

    def visit(name):
        if name in seen or name not in tree:
            return
        seen.add(name)
        out.extend(x for x in tree[name] if not x.endswith(".xml"))
        for child in tree[name]:
            if child.endswith(".xml"):
                visit(child)

    visit(root)
    return list(dict.fromkeys(out))


def test_walk_order_with_shared_children(spark):
    tree = {
        "r.xml": ["p0", "a.xml", "b.xml", "d.xml"], "a.xml": ["p1", "b.xml", "c.xml"],
        "b.xml": ["p2", "c.xml", "r.xml"], "c.xml": ["p3", "a.xml", "missing.xml"], "d.xml": ["p0", "p4"],
    }
    assert walk(spark, tree) == depth_first(tree, "r.xml")


def test_two_roots_are_independent(spark):
    tree = {"https://h1/r.xml": ["p1", "s.xml"], "https://h2/r.xml": ["p2", "s.xml"], "s.xml": ["p3"]}
    made = bodies(spark, [(u, urlset(*links)) for u, links in tree.items()])
    roots = spark.createDataFrame([("https://h1/r.xml",), ("https://h2/r.xml",)], "root string")
    rows = R.frontier(roots, M.sitemap_links(made)).collect()
    assert {(r.source, r.url, r.ord) for r in rows} == {
        ("h1", "p1", 0), ("h1", "p3", 1), ("h2", "p2", 0), ("h2", "p3", 1),
    }


def test_limit_urls_equals_sort_and_cut(spark):
    rows = [("big", f"u{i}", (i * 7919) % 1000) for i in range(1000)] + [("small", f"v{i}", i) for i in range(3)]
    urls = spark.createDataFrame(rows, "root string, url string, ord bigint")
    kept = R.limit_urls(urls, 10).collect()
    assert {(r.root, r.ord) for r in kept} == {("big", i) for i in range(10)} | {("small", i) for i in range(3)}
    assert R.limit_urls(urls, 0).count() == len(rows)


def test_pending_and_skipped(spark):
    urls = spark.createDataFrame([("s", "p1"), ("s", "p2"), ("s", "p3"), ("t", "p1")], "source string, url string")
    stored = spark.createDataFrame([("s", "p1"), ("s", None)], "source string, url string")
    left = R.pending_urls(urls, stored, "source", "url").collect()
    assert {tuple(r) for r in left} == {("s", "p2"), ("s", "p3"), ("t", "p1")}
    counts = {tuple(r) for r in R.skip_counts(urls, stored).collect()}
    assert counts == {("s", 3, 1, 2), ("t", 1, 0, 1)}


def test_schedule_over_blocks(spark):
    rows = [(f"https://h/{i}", i * 3) for i in range(50)] + [("https://k/0", 7)]
    urls = spark.createDataFrame(rows, "url string, ord bigint")
    slots = R.politeness_schedule(urls, 0.5, block=10).orderBy("host", "ord").collect()
    assert [r.start_offset for r in slots] == [i * 0.5 for i in range(50)] + [0.0]


def robots(spark, *rows):
    return spark.createDataFrame(list(rows), "host string, status int, body string")


def test_robots(spark):
    made = robots(
        spark, ("a", 200, "User-agent: *\nSITEMAP: https://a/x.xml\r\nSitemap: https://a/y.xml"),
        ("b", 200, " Sitemap: https://b/x.xml"), ("c", 404, "sitemap: x"), ("d", 200, ""),
    )
    assert [tuple(r) for r in M.robots_sitemaps(made).collect()] == [("a", "https://a/x.xml")]


def test_discovery(spark):
    sites = spark.createDataFrame(
        [("https://a/",), ("https://b/x",), ("https://c/m.xml",), ("https://d",), ("//e/x",), ("https://f",)],
        "base_url string",
    )
    listed = robots(spark, ("a", 200, "sitemap: https://a/r.xml"), ("f", 200, "sitemap:  \n"))
    files = bodies(spark, [
        ("https://b/sitemap.xml", b"<bad"), ("https://b/news-sitemap.xml", b"<x/>"), ("https://b/post-sitemap.xml", b"<x/>"),
        ("https://d/other.xml", b"<x/>"), ("https://e/sitemap.xml", gzip.compress(b"<x/>")), ("https://d/sitemap.xml", (500, b"<x/>")),
    ])
    found = {r.base_url: r.sitemap_url for r in M.pick_sitemap(sites, listed, files).collect()}
    assert found == {
        "https://a/": "https://a/r.xml", "https://b/x": "https://b/news-sitemap.xml", "https://c/m.xml": "https://c/m.xml",
        "https://d": None, "//e/x": "https://e/sitemap.xml", "https://f": None,
    }


def test_read_sitemap_files(spark, tmp_path):
    (tmp_path / "a").write_bytes(gzip.compress(urlset("https://a/1")))
    (tmp_path / "b.xml").write_bytes(urlset("https://b/1"))
    found = M.sitemap_locs(M.read_sitemaps(spark, str(tmp_path))).collect()
    assert {r.loc for r in found} == {"https://a/1", "https://b/1"}


def test_generated_sitemaps_read_back(spark):
    urls = [f"https://a/{i}?x=1&amp;y={i}" for i in range(300)]
    assert locs(spark, urlset(*urls)) == [u.replace("&amp;", "&") for u in urls]


def test_paths_of_locs(spark):
    """Locs by where they stand; an image knows its page, which may come after it."""
    body = b"""<urlset xmlns="s" xmlns:image="i"><url><image:image><image:loc>i1</image:loc></image:image><loc>p1</loc></url>
      <url><loc>p<!-- c -->2</loc><image:image><image:loc> i2 </image:loc><image:loc>i3<b/>x</image:loc></image:image></url>
      <loc>top</loc><url><loc/><image:image><image:loc>i4</image:loc></image:image></url><url><loc><loc>in</loc>x</loc></url></urlset>"""
    made = bodies(spark, [("s.xml", body)])
    names = lambda df: [r.loc for r in df.orderBy("pos").collect()]
    assert names(M.sitemap_locs(made)) == ["i1", "p1", "p", "i2", "i3", "top", "i4", "in"]
    assert names(M.sitemap_locs(made, M.PAGE_PATHS)) == ["p1", "p"]
    images = M.image_links(made).orderBy("pos").collect()
    assert [(r.page, r.loc) for r in images] == [("p1", "i1"), ("p", "i2"), ("p", "i3"), (None, "i4")]
    assert M.sitemap_links(made, M.PAGE_PATHS).first()["urls"] == ["p1", "p"]


def test_sitemaps_delivered_twice(spark):
    """The longest list counts; sitemaps that come once are not shuffled."""
    made = bodies(spark, [("a.xml", urlset("p1")), ("a.xml", urlset("p2", "p3", "c.xml")), ("b.xml", urlset("p4")), ("a.xml", b"<bad")])
    got = {r.sitemap_url: (r.n_urls, r.urls) for r in M.sitemap_links(made).collect()}
    assert got == {"a.xml": (2, ["p2", "p3"]), "b.xml": (1, ["p4"])}


def simulated(rows, n_workers, duration, spacing):
    """One request after the other, as the workers would take them; times in microseconds."""
    out = {}
    for root in {r[1] for r in rows}:
        free, hosts = [0] * n_workers, {}
        for i, (url, _, _) in enumerate(sorted((r for r in rows if r[1] == root), key=lambda r: (r[2], r[0]))):
            host = url.split("/")[2]
            start = max(free[i % n_workers], hosts.get(host, 0))
            free[i % n_workers], hosts[host] = start + duration, start + spacing
            out[root, url] = (i, i % n_workers, start / 1e6)
    return out


@pytest.mark.parametrize("n_workers, duration, spacing, block, hosts", [(3, 0.25, 0.6, 50, 4), (1, 1.0, 0.0, 7, 100), (20, 0.0, 0.1, 1000, 1), (4, 0.3, 0.7, 3, 2)])
def test_workers_share_a_list(spark, n_workers, duration, spacing, block, hosts):
    rng = random.Random(n_workers)
    rows = [(f"https://h{int(rng.expovariate(0.3))}/{i}", rng.choice(["a", "b", None]), rng.randrange(400) * 3) for i in range(700)]
    rows += [(f"https://hot/{i}", "a", i) for i in range(300)]
    urls = spark.createDataFrame(rows, "url string, root string, ord bigint")
    got = worker_schedule(urls, n_workers, duration, spacing, block=block, hosts=hosts).collect()
    want = simulated(rows, n_workers, round(duration * 1e6), round(spacing * 1e6))
    assert len(got) == len(rows) and {(r.root, r.url): (r.number, r.worker, r.start_offset) for r in got} == want


def test_workers_of_nothing(spark):
    assert worker_schedule(spark.createDataFrame([], "url string, root string, ord bigint")).count() == 0
    with pytest.raises(ValueError):
        worker_schedule(spark.createDataFrame([], "url string, root string, ord bigint"), n_workers=0)

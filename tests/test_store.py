import os

import pytest
from pyspark.sql import functions as F

from webcorpus.operators import articles as A
from webcorpus.plans.crawl import crawl
from webcorpus.schemas import ARTICLE, PAGES
from webcorpus.sources import article_store as S
from webcorpus.sources import dataset as D
from webcorpus.sources import storage
from webcorpus.sources.storage import numbered
from webcorpus.streaming.ingest import Flushes, flush_rest, ingest_stream

WORDS = " ".join(["word"] * 150)


def articles(spark, *rows, source="s.x"):
    made = spark.createDataFrame([(u, t, i) for i, (u, t) in enumerate(rows)], "url string, text string, pos long")
    for f in ARTICLE.fields:
        if f.name not in ("url", "text"):
            made = made.withColumn(f.name, F.lit(source if f.name == "source" else None).cast(f.dataType))
    return made


def content(store):
    return {(r.url, r.text) for r in store.articles().collect()}


def test_last_appended_wins(spark, tmp_path):
    store = S.ArticleStore(spark, str(tmp_path / "a"))
    store.write_articles(articles(spark, ("u1", "a"), ("u2", "b")), 0, F.col("pos"))
    store.write_articles(articles(spark, ("u1", "c")), 1, F.col("pos"))
    assert content(store) == {("u2", "b"), ("u1", "c")}
    store = store.compact(str(tmp_path / "b"))
    assert store.rows().count() == 2 and content(store) == {("u2", "b"), ("u1", "c")} and store.next_batch() == 2
    store.write_articles(articles(spark, ("u2", "d"), ("u3", "e"), ("u3", "f")), 2, F.col("pos"))
    assert content(store) == {("u1", "c"), ("u2", "d"), ("u3", "f")}
    store = store.compact(str(tmp_path / "c"))
    assert content(store) == {("u1", "c"), ("u2", "d"), ("u3", "f")}
    assert store.next_batch() == 3 and store.existing_urls().count() == 3


def test_order_is_position_not_time(spark, tmp_path):
    store = S.ArticleStore(spark, str(tmp_path))
    rows = articles(spark, ("u1", "a"), ("u1", "b")).withColumn(
        "crawled_at", F.when(F.col("text") == "a", "2030").otherwise("2020"))
    store.write_articles(rows, 0, F.col("pos"))
    assert content(store) == {("u1", "b")}


def test_empty_batch_and_empty_store(spark, tmp_path):
    store = S.ArticleStore(spark, str(tmp_path))
    assert content(store) == set() and store.existing_urls().count() == 0 and store.next_batch() == 0
    store = store.compact(str(tmp_path / "b"))
    store.write_articles(articles(spark, ("u", "t")).where("false"), 0)
    assert content(store) == set()


def test_same_batch_twice(spark, tmp_path):
    """The second time replaces the first, keys included, also where it has fewer rows."""
    store = S.ArticleStore(spark, str(tmp_path))
    store.write_articles(articles(spark, *[(f"u{i}", "a") for i in range(40)]), 5, F.col("pos"))
    store.write_articles(articles(spark, ("u1", "a"), ("u2", "b")), 5, F.col("pos"))
    assert store.rows().count() == store.stored_keys().count() == 2 and store.batches() == [(5, "main")]


def test_unfinished_batch_is_not_seen(spark, tmp_path):
    store = S.ArticleStore(spark, str(tmp_path))
    store.write_articles(articles(spark, ("u1", "a")), 0)
    written = next((tmp_path / "log" / "part=0-main").rglob("*.parquet"))
    attempt = tmp_path / "log" / "part=1-main" / "_temporary" / "0" / "attempt" / "source_key=f001"
    attempt.mkdir(parents=True)
    (attempt / "part-0.parquet").write_bytes(written.read_bytes())
    assert content(store) == {("u1", "a")} and store.rows().count() == 1


def test_rows_that_tie(spark, tmp_path):
    """One batch, no positions: the same row wins however the rows are dealt; NULL URLs are one key."""
    rows = articles(spark, ("u", "a"), ("u", "c"), ("u", "b"), ("v", "x"), ("v", "x"), (None, "m"), (None, "n"))
    for parts in (1, 3):
        store = S.ArticleStore(spark, str(tmp_path / str(parts)))
        store.write_articles(rows.repartition(parts), 0)
        assert content(store) == {("u", "c"), ("v", "x"), (None, "n")} and store.articles().count() == 3


@pytest.mark.parametrize("rewrites", [(), (0,), (1, 2), (0, 1, 2, 3)])
def test_one_order_with_and_without_rewrites(spark, tmp_path, rewrites):
    """A batch that comes late, and two writers with one id: the same row wins wherever the log is rewritten."""
    store = S.ArticleStore(spark, str(tmp_path / "log0"))
    batches = [(0, "a", "zero"), (6, "a", "six"), (5, "z", "late"), (6, "b", "tied")]
    for k, (batch_id, writer, text) in enumerate(batches):
        store.write_articles(articles(spark, ("u", text), (text, text)), batch_id, F.lit(0), writer)
        if k in rewrites:
            store = store.compact(str(tmp_path / f"log{k + 1}"))
    assert content(store) == {("u", "tied"), ("zero", "zero"), ("six", "six"), ("late", "late"), ("tied", "tied")}


def test_sources_are_apart(spark, tmp_path):
    store = S.ArticleStore(spark, str(tmp_path), folders=0)
    both = articles(spark, ("u", "1"), (None, "n"), source="a.b").union(articles(spark, ("u", "2"), source="a_b"))
    store.write_articles(both, 0, F.col("pos"))
    assert {p.name for p in (tmp_path / "log" / "part=0-main").iterdir() if p.is_dir()} == {"source_key=a_b"}
    assert {tuple(r) for r in store.existing_urls("a.b").collect()} == {("a.b", "u")}
    assert {tuple(r) for r in store.existing_urls().collect()} == {("a.b", "u"), ("a_b", "u")}
    plan = store.existing_urls("a.b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "/keys" in plan and "text:string" not in plan


def landed_pages(spark, path, n=12):
    html = "<html><head><title>T{0}</title></head><body><article><p>{1}</p></article></body></html>"
    rows = [(i, f"https://h{i % 2}.x/en/{i}", html.format(i, WORDS if i % 5 else "short")) for i in range(n)]
    pages = spark.createDataFrame(rows, PAGES)
    pages.repartition(3).write.mode("append").parquet(path)
    return pages


def run(spark, tmp_path, store, name, **options):
    query = ingest_stream(
        spark, str(tmp_path / "landing"), store, str(tmp_path / name), files_per_batch=1,
        crawled_at=F.lit("2024-01-01").cast("timestamp"), **options,
    )
    query.awaitTermination()
    assert query.exception() is None


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    pages = landed_pages(spark, str(tmp_path / "landing"))
    store = S.ArticleStore(spark, str(tmp_path / "store"))
    run(spark, tmp_path, store, "c1")
    names = [f.name for f in ARTICLE.fields]
    expected = A.build_articles(pages, crawled_at=F.lit("2024-01-01").cast("timestamp")).select(*names)
    assert sorted(store.articles().select(*names).collect()) == sorted(expected.collect())
    batches = store.batches()
    assert len(batches) == 3
    run(spark, tmp_path, store, "c1")          # same checkpoint: nothing new
    assert store.batches() == batches
    run(spark, tmp_path, store, "c2")          # new checkpoint: all there already
    assert store.rows().count() == expected.count() and len(store.batches()) == 3
    landed_pages(spark, str(tmp_path / "landing"), 14)
    run(spark, tmp_path, store, "c1")
    assert {r.url for r in store.articles().collect()} >= {"https://h0.x/en/12", "https://h1.x/en/13"}


def test_other_writers_between_two_runs_of_a_stream(spark, tmp_path):
    landed_pages(spark, str(tmp_path / "landing"))
    store = S.ArticleStore(spark, str(tmp_path / "store"))
    run(spark, tmp_path, store, "c1")
    before = content(store)
    store.write_articles(articles(spark, *[(f"b{i}", "t") for i in range(5)]), store.next_batch(), F.col("pos"))
    other = {(f"b{i}", "t") for i in range(5)}
    landed_pages(spark, str(tmp_path / "landing"), 14)
    run(spark, tmp_path, store, "c1")
    assert content(store) >= before | other and len(content(store)) == len(before | other) + 2
    store = store.compact(str(tmp_path / "rewritten"))
    seen = content(store)
    landed_pages(spark, str(tmp_path / "landing"), 15)
    run(spark, tmp_path, store, "c1")
    run(spark, tmp_path, store, "c2")
    assert content(store) >= seen and any(u.endswith("/14") for u, _ in content(store)) == (14 % 5 != 0)


def test_replace_and_empty_source(spark, tmp_path):
    for folders in (0, 16):
        store = S.ArticleStore(spark, str(tmp_path / str(folders)), folders)
        store.write_articles(articles(spark, ("u1", "a"), source=""), 0)
        assert [tuple(r) for r in store.existing_urls("").collect()] == [("", "u1")]
        store.write_articles(articles(spark, ("u2", "b"), ("u2", "c")), store.next_batch(), F.col("pos"), append=False)
        assert content(store) == {("u2", "c")}
        store.write_articles(articles(spark, ("u3", "d")), store.next_batch())
        assert content(store) == {("u2", "c"), ("u3", "d")}


def test_flushes_by_number_of_articles(spark, tmp_path):
    """Batches of exactly so many articles across micro-batches and restarts, and the rest at the end."""
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "c1")
    landed_pages(spark, landing, 25)
    store = S.ArticleStore(spark, str(tmp_path / "store"))
    store.write_articles(articles(spark, ("old", "t")), 0)
    sizes = lambda: {r["batch_id"]: r["count"] for r in store.rows().where("writer <> 'main'").groupBy("batch_id").count().collect()}
    run(spark, tmp_path, store, "c1", flush_every=6)
    assert sizes() == {1: 6, 2: 6, 3: 6}                    # 20 articles, 2 are held back
    landed_pages(spark, landing, 31)                        # 4 new ones; what is held back counts as stored
    run(spark, tmp_path, store, "c1", flush_every=6)
    assert sizes() == {1: 6, 2: 6, 3: 6, 4: 6}
    landed_pages(spark, landing, 33)
    run(spark, tmp_path, store, "c1", flush_every=6)
    for _ in range(2):
        flush_rest(spark, store, checkpoint)
    assert sizes() == {1: 6, 2: 6, 3: 6, 4: 6, 5: 2} and store.articles().count() == 27
    landed_pages(spark, landing, 34)
    run(spark, tmp_path, store, "c1", flush_every=1)
    assert sizes() == {1: 6, 2: 6, 3: 6, 4: 6, 5: 2, 6: 1}


def test_a_micro_batch_that_runs_again(spark, tmp_path):
    """What a failed attempt has stored or held back is made again, not skipped and not doubled."""
    flushes = Flushes(spark, str(tmp_path / "c"))
    rows = articles(spark, ("a", "1"), ("b", "2")).withColumn("round", F.lit(0).cast("long"))
    flushes.hold(1, rows, 3)
    flushes.hold(1, rows.where("url = 'a'"), 3)
    assert [r["url"] for r in flushes.held(1).collect()] == ["a"] and (flushes.batches(1), flushes.last()) == (3, 1)
    assert flushes.held(0).count() == 0 and flushes.batches(0) == 0


def test_numbers_are_dense(spark):
    df = spark.range(1000, numPartitions=7).select(F.floor(F.col("id") * 7919 % 1000 / 3).alias("a"), "id")
    got = numbered(df, "a", "id").orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(1000)) and [(r["a"], r["id"]) for r in got] == sorted((r["a"], r["id"]) for r in got)


def test_numbers_move_no_other_column(spark, monkeypatch):
    """However many rows are numbered, and where rows tie each has a number of its own, the same in each pass."""
    df = spark.range(9000, numPartitions=3).select((F.col("id") % 7).alias("a"), F.col("id").cast("string").alias("text"))
    found = numbered(df, "a")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1 and "text#" in plan
    monkeypatch.setattr(storage, "MAX_BROADCAST_NUMBERS", 8999)
    for rows in (found, numbered(df, "a")):
        got = sorted(rows.select("number", "a", "text").collect())
        assert [r["number"] for r in got] == list(range(9000)) == [r["number"] for r in sorted(rows.collect(), key=lambda r: r["number"])]
        assert [r["a"] for r in got] == sorted(r["a"] for r in got) and len({r["text"] for r in got}) == 9000
        assert sorted(rows.select("number", "a", "text").collect()) == got


def many_articles(spark, n, text="t"):
    """Articles 0, 1, 2, ... of 20 sources."""
    made = articles(spark, *[(f"u{i}", text) for i in range(n)])
    return made.withColumn("source", F.format_string("s%d.x", F.col("pos") % 20))


def test_files_do_not_go_by_the_number_of_batches(spark, tmp_path):
    """Batches that are written together share their files; each is there with its rows and keys."""
    store = S.ArticleStore(spark, str(tmp_path))
    store.write_batches(many_articles(spark, 600), F.floor(F.col("pos") / 3), F.col("pos"), "w")
    files = {name: len(list((tmp_path / name / "part=0_199-w").rglob("*.parquet"))) for name in ("log", "keys")}
    assert 0 < files["log"] <= 4 * 16 and 0 < files["keys"] <= 64
    assert len(list(tmp_path.rglob("*.parquet"))) <= sum(files.values()) + 2
    rows = {(r["batch_id"], r["pos"], r["url"]) for r in store.rows().collect()}
    assert rows == {(i // 3, i, f"u{i}") for i in range(600)} and store.batches() == [(i, "w") for i in range(200)]
    keys = {(r["source"], r["url"], r["batch_id"], r["writer"]) for r in store.stored_keys().collect()}
    assert keys == {(f"s{i % 20}.x", f"u{i}", i // 3, "w") for i in range(600)}
    assert [r["batch_id"] for r in store.stored_keys("s3.x").orderBy("batch_id").limit(1).collect()] == [1]


def test_batches_written_together_are_replaced_one_by_one(spark, tmp_path):
    """By one batch, by some of them, by others around them, and by all of them; other writers' batches stay."""
    store = S.ArticleStore(spark, str(tmp_path))
    held = {}

    def write(writer, text, *ids):
        ids = sorted(ids)
        rows = spark.createDataFrame([(k, 10 * k + i) for k in ids for i in range(2)], "batch_id long, pos long")
        rows = many_articles(spark, 200, text).join(rows, "pos")
        if len(ids) == 1 and text.startswith("one"):
            store.write_articles(rows, ids[0], F.col("pos"), writer)
        else:
            store.write_batches(rows, F.col("batch_id"), F.col("pos"), writer)
        held.update({(k, writer, f"u{10 * k + i}"): text for k in ids for i in range(2)})
        assert sorted((r["batch_id"], r["writer"], r["url"], r["text"]) for r in store.rows().collect()) == sorted((*k, v) for k, v in held.items())
        assert sorted((r["batch_id"], r["writer"], r["url"]) for r in store.stored_keys().collect()) == sorted(held)

    write("w", "a", *range(10))
    write("x", "b", *range(10))
    write("w", "one", 4)
    write("w", "c", 3, 6)
    write("w", "d", 2, 5)
    write("w", "one again", 9)
    write("w", "e", *range(8, 12))
    write("w", "f", *range(12))
    write("w", "g", *range(12))
    write("w", "h", 0, 11)
    write("w", "one more", 0)
    write("w-2", "one other", 1)


def test_a_stream_that_flushes_leaves_no_copies(spark, tmp_path):
    """A micro-batch parses its pages once and removes its intermediate tables."""
    landed_pages(spark, str(tmp_path / "landing"))
    store = S.ArticleStore(spark, str(tmp_path / "store"))
    shared = storage.shared_dir(spark).removeprefix("file:")
    before = {name for name in os.listdir(shared) if not name.startswith("held")}
    run(spark, tmp_path, store, "c1", flush_every=2)
    flush_rest(spark, store, str(tmp_path / "c1"))
    assert {name for name in os.listdir(shared) if not name.startswith("held")} == before
    assert sorted(r["count"] for r in store.rows().groupBy("batch_id").count().collect()) == [1, 2, 2, 2, 2]
    assert len(list((tmp_path / "store" / "log").glob("part=*"))) <= 4


def test_crawl_then_frontier_is_empty(spark, tmp_path):
    pages = landed_pages(spark, str(tmp_path / "landing"))
    links = "".join(f"<url><loc>{r.url}</loc></url>" for r in pages.collect())
    bodies = spark.createDataFrame(
        [("https://n.x/sitemap.xml", 200, f"<urlset>{links}<url><loc>https://n.x/lost</loc></url></urlset>".encode())],
        "sitemap_url string, status int, body binary",
    )
    sites = spark.createDataFrame([("https://n.x/home",)], "base_url string")
    robots = spark.createDataFrame([], "host string, status int, body string")
    store = S.ArticleStore(spark, str(tmp_path / "store"))
    report = crawl(sites, robots, bodies, pages, store)
    assert [tuple(r) for r in report.collect()] == [("n.x", 13, 9, 150.0)]
    again = crawl(sites, robots, bodies, pages, store)
    assert [tuple(r) for r in again.collect()] == [("n.x", 4, 0, None)]
    assert store.articles().count() == 9


def refetched(spark, *ids):
    """Pages 0, 1, 2, ... of one host, of which those after the second have the URL of an earlier one."""
    html = "<html><head><title>T{0}</title></head><body><article><p>{1}</p></article></body></html>"
    return spark.createDataFrame([(i, f"https://n.x/en/{i % 2}", html.format(i, WORDS + " x" * i)) for i in ids], PAGES)


def test_a_stream_stores_each_fetch_of_a_url(spark, tmp_path):
    """However the fetches fall into micro-batches; what was stored or held back before the run is skipped."""
    for name, options in (("plain", {}), ("flushes", {"flush_every": 2})):
        base = tmp_path / name
        for i in range(3):
            refetched(spark, i).coalesce(1).write.mode("append").parquet(str(base / "landing"))
        store = S.ArticleStore(spark, str(base / "store"))
        run(spark, base, store, "c1", **options)
        refetched(spark, 3).coalesce(1).write.mode("append").parquet(str(base / "landing"))
        run(spark, base, store, "c1", **options)
        if options:
            flush_rest(spark, store, str(base / "c1"))
        assert sorted(r["pos"] for r in store.rows().collect()) == [0, 1, 2]
        assert sorted(r["title"] for r in store.articles().collect()) == ["T1", "T2"]
        run(spark, base, store, "c2", **options)
        assert store.rows().count() == 3


def test_each_fetch_of_a_page_is_an_attempt(spark, tmp_path):
    links = "".join(f"<url><loc>https://n.x/en/{i}</loc></url>" for i in range(3))
    bodies = spark.createDataFrame(
        [("https://n.x/sitemap.xml", 200, f"<urlset>{links}</urlset>".encode())], "sitemap_url string, status int, body binary",
    )
    sites = spark.createDataFrame([("https://n.x/home",)], "base_url string")
    robots = spark.createDataFrame([], "host string, status int, body string")
    store = S.ArticleStore(spark, str(tmp_path / "store"))
    report = crawl(sites, robots, bodies, refetched(spark, 4, 0, 1, 2), store)
    assert [r[:3] for r in map(tuple, report.collect())] == [("n.x", 5, 4)]
    assert sorted(r["title"] for r in store.articles().collect()) == ["T1", "T4"]


def test_large_tables_are_written_where_they_are_read(spark, tmp_path):
    """Texts are exchanged only while a table is too small to fill the folders from each task."""
    store = S.ArticleStore(spark, str(tmp_path / "store"))
    store.write_articles(articles(spark, *[(f"u{i}", "t") for i in range(50)]), 0, F.col("pos"))
    moves = lambda: "REBALANCE" in store._texts(store.rows())._jdf.queryExecution().executedPlan().toString()
    assert moves()
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert not moves()
        again = store.compact(str(tmp_path / "again"))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert content(again) == content(store) and again.existing_urls().count() == 50


def test_dataset(spark, tmp_path):
    path = str(tmp_path / "data")
    docs = spark.range(100).select("id", F.lit("t").alias("text"), F.lit("s").alias("source"), F.lit("uz").alias("lang"))
    D.write_train_shards(D.train_records(docs.repartition(3), F.col("id")), path, max_records=20)
    listed = D.dataset_manifest(spark, path).collect()
    assert [r.file_name for r in listed] == sorted(r.file_name for r in listed)
    assert sum(r.n_rows for r in listed) == 100 and max(r.n_rows for r in listed) <= 20
    assert all(r.target == "data/" + r.file_name and r.n_bytes > 0 for r in listed)
    first = spark.read.parquet(f"{path}/{listed[0].file_name}").first()
    assert D.dataset_first_row(spark, path).collect() == [first]


def test_first_row_of_nothing(spark, tmp_path):
    path = str(tmp_path / "data")
    empty = spark.createDataFrame([], "id string, text string, source string, lang string")
    D.write_train_shards(empty, path)
    assert D.dataset_first_row(spark, path).count() == 0
    assert {r.n_rows for r in D.dataset_manifest(spark, path).collect()} <= {0}

"""Plans, not results: what is shuffled, broadcast, read and worked out how often."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from webcorpus.operators import articles as A
from webcorpus.operators import extract as E
from webcorpus.operators import frontier as R
from webcorpus.sources import article_store as S
from webcorpus.sources.pages import page_nodes, read_pages, spread_small

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_input(spark):
    """Makes every input count as large enough for its own splits."""
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.openCostInBytes", old)


def test_articles_shuffle_nothing(spark, large_input):
    text = plan(entry.build_articles(spark, SF))
    assert "MapInArrow" in text and text.count("MapInArrow parse") == 1
    # the rules are gathered per host and broadcast; no exchange is below the join's other side
    pages_side = text.split("BroadcastHashJoin")[1].split(":- ")[1].split("+- BroadcastExchange")[0]
    assert "Exchange" not in pages_side and "SortMergeJoin" not in text
    assert re.search(r"FileScan parquet \[page_id#\d+L,url#\d+,html#\d+\]", text)


def test_without_rules_there_is_no_exchange_at_all(spark, large_input):
    pages = spread_small(read_pages(spark, f"{SF}/pages.parquet"))
    assert "Exchange" not in plan(A.build_articles(pages))
    assert "PushedFilters: [IsNotNull(html), Not(EqualTo(html,))]" in plan(A.build_articles(pages))


def test_many_rules_are_not_broadcast(spark, large_input, monkeypatch):
    monkeypatch.setattr(E, "MAX_BROADCAST_RULES", 3)
    pages = read_pages(spark, f"{SF}/pages.parquet")
    text = plan(E.add_rules(pages, E.selector_rules(spark)))
    assert "BroadcastExchange" not in text and "SortMergeJoin" in text


def test_url_queries_read_no_bodies(spark):
    for name in ("pending_urls", "limit_urls", "politeness_schedule", "skip_counts", "url_lang"):
        assert "html" not in plan(entry.queries()[name](spark, SF)), name


def test_candidates_are_worked_out_once(spark, large_input):
    nodes = page_nodes(read_pages(spark, f"{SF}/pages.parquet"))
    for df in (E.content_candidates(nodes), E.link_density(nodes), E.meta_tags(nodes)):
        assert not re.search(r"Filter \(?\(?size\(", plan(df))


def test_min_is_combined_before_the_shuffle(spark):
    urls = spark.range(10).select(F.lit("s").alias("source"), F.lit("u").alias("url"), F.col("id").alias("ord"))
    text = plan(R.unique_urls(urls, "source", "url"))
    assert "partial_min" in text and "SortAggregate" not in text


def test_limit_cuts_before_the_shuffle(spark):
    urls = spark.range(10).select((F.col("id") % 3).alias("root"), F.lit("u").alias("url"), F.col("id").alias("ord"))
    text = plan(R.limit_urls(urls, 5))
    assert text.count("WindowGroupLimit") == 4


def test_few_repeats_leave_the_log_in_place(spark, tmp_path):
    store = S.ArticleStore(spark, str(tmp_path))
    docs = entry.document_articles(spark, SF)
    store.write_articles(docs, 0, F.col("pos"))
    store.write_articles(docs.limit(5), 1, F.col("pos"))
    text = plan(store.articles())
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text and text.count("text:string") == 1
    assert store.articles().count() == docs.count()


def test_a_batch_reads_only_its_key_buckets(spark, tmp_path):
    """Stored keys are read by the buckets of the sources that a batch has, and never the log."""
    store = S.ArticleStore(spark, str(tmp_path))
    store.write_articles(entry.document_articles(spark, SF), 0, F.col("pos"))
    batch = spark.createDataFrame([("src1.example:80", "doc:1"), ("src1.example:80", "new")], "source string, url string")
    known = store.stored_keys(of=batch)
    assert [tuple(r) for r in known.collect()] == [("src1.example:80", "doc:1", 0, "main")]
    text = plan(known)
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("src1.example:80")), F.lit(64))).first()[0]
    assert re.search(rf"PartitionFilters: \[.*\(bucket#\d+ = {bucket}\)", text) and "/keys" in text and "/log" not in text


def test_hot_keys_keep_results_whole(spark):
    """A third of all rows in one key, against plain Python."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", f"u{i}", (i * 37) % 900) for i in range(900)]
    urls = spark.createDataFrame(rows, "root string, url string, ord bigint")
    kept = {(r.root, r.ord) for r in R.limit_urls(urls, 20).collect()}
    wanted = {
        (root, o) for root in {r[0] for r in rows} for o in sorted(x[2] for x in rows if x[0] == root)[:20]
    }
    assert kept == wanted
    hosts = urls.withColumn("url", F.concat(F.lit("https://"), "root", F.lit("/"), "url"))
    slots = {(r.host, r.ord): r.start_offset for r in R.politeness_schedule(hosts, 1.0, block=7).collect()}
    for root in {r[0] for r in rows}:
        orders = sorted(x[2] for x in rows if x[0] == root)
        assert [slots[(root, o)] for o in orders] == [float(i) for i in range(len(orders))]
    log = urls.select(F.lit("s").alias("source"), F.col("root").alias("url"), F.lit(0).alias("batch_id"), F.col("ord").alias("pos"))
    latest = {(r.url, r.pos) for r in S.latest_articles(log).collect()}
    assert latest == {(root, max(x[2] for x in rows if x[0] == root)) for root in {r[0] for r in rows}}

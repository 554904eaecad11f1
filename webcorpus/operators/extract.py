"""Pages to titles, candidates and the chosen main content.

All operators work inside a page's row; none shuffles unless it says so.  Arrays are turned into
rows by outer generators and a filter behind them: for a plain one the optimizer would add a filter
in front that works the array out a second time.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions import nodes as N
from webcorpus.functions.markdown import markdown_pieces, settled_markdown
from webcorpus.functions.selectors import is_selector, names_of, selected, selectors_of, steps_of
from webcorpus.functions.text import strip_ws, url_netloc
from webcorpus.sources.pages import ARTICLE_ATTRIBUTES

# Host, order, selector.
SELECTOR_RULES = (
    ("kun.uz", 0, ".news-inner__left"),
    ("kun.uz", 1, ".news-body"),
    ("daryo.uz", 0, ".news-page-session__grid_alias"),
    ("daryo.uz", 1, ".post-content"),
    ("gazeta.uz", 0, ".article-content"),
    ("gazeta.uz", 1, ".news-text"),
    ("uza.uz", 0, ".article__text"),
    ("uza.uz", 1, ".news-content"),
    ("aniq.uz", 0, ".single-content"),
    ("aniq.uz", 1, ".entry-content"),
)
# Up to this many rules are sent to every executor.
MAX_BROADCAST_RULES = 100_000


def selector_rules(spark, rows=SELECTOR_RULES) -> DataFrame:
    return spark.createDataFrame(list(rows), "host string, ord int, css string")


def add_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Attach a page's selector rules by exact host.

    A rule is a list, separated by commas, of selectors: compounds (an element or ``*`` with ids, classes
    and attributes that the parse keeps) in steps of descendants, children (``>``), next siblings (``+``)
    and later siblings (``~``).  Anything else, such as pseudo-classes, fails.

    The join runs before the parse, on the slim side of it.  Rules are counted, as far as the
    bound: within it they are broadcast and pages stay where they are; beyond it the join is
    sorted, with hot hosts split at run time.
    """
    few = rules.limit(MAX_BROADCAST_RULES + 1).count() <= MAX_BROADCAST_RULES
    each = rules.select("host", "ord", "css", F.posexplode(selectors_of("css")).alias("part", "one"))
    steps = each.withColumn("steps", steps_of(F.col("one")))
    unknown = F.exists(names_of(F.col("steps")), lambda a: ~a.isin(*ARTICLE_ATTRIBUTES))
    message = F.concat(F.lit("selector not supported: "), "css")
    good = is_selector(F.col("one")) & ~unknown
    rule = F.when(~good, F.raise_error(message)).otherwise(F.struct("ord", "part", "steps"))
    per_host = steps.select("host", rule.alias("rule"))
    per_host = per_host.groupBy(F.col("host").alias("_host")).agg(F.array_sort(F.collect_list("rule")).alias("rules"))
    per_host = F.broadcast(per_host) if few else per_host
    return pages.join(per_host, url_netloc("url") == F.col("_host"), "left").drop("_host")


def page_title(pages: DataFrame) -> DataFrame:
    """Add ``title``: the first of og:title, twitter:title, <title>, <h1>."""
    heads = pages.withColumn("_heads", N.head_nodes(F.col("nodes")))
    return heads.withColumn("title", N.page_title(F.col("nodes"), F.col("_heads"))).drop("_heads")


def meta_tags(pages: DataFrame) -> DataFrame:
    """Meta tags as rows: key lowercased, ``property`` before ``name``, blank ones dropped."""
    tags = pages.select(
        "page_id",
        F.inline_outer(
            F.transform(
                F.filter("nodes", lambda n: (n["tag"] == "meta") & ~n["killed"]),
                lambda n: F.struct(
                    n["node_id"].alias("node_id"),
                    F.lower(
                        F.coalesce(F.nullif(N.attr(n, "property"), F.lit("")), N.attr(n, "name"))
                    ).alias("key"),
                    N.attr(n, "content").alias("value"),
                ),
            )
        ),
    )
    return tags.where((F.col("key") != "") & (F.col("value") != ""))


def meta_last_wins(tags: DataFrame) -> DataFrame:
    """One value per page and key, the last in the document; combined before the shuffle."""
    return tags.groupBy("page_id", "key").agg(F.max_by("value", "node_id").alias("value"))


def meta_body(pages: DataFrame) -> DataFrame:
    return pages.withColumn("meta_body", N.meta_body(N.head_nodes(F.col("nodes"))))


def jsonld_body(pages: DataFrame) -> DataFrame:
    return pages.withColumn("jsonld_body", N.jsonld_body())


def drop_blocks(pages: DataFrame) -> DataFrame:
    """Keep only live nodes, as rows: removed blocks go with their subtrees and following text."""
    return pages.withColumn("nodes", F.filter("nodes", lambda n: ~n["killed"]))


def html_to_text(pages: DataFrame) -> DataFrame:
    """Add ``text``: the body's live text nodes joined by newlines, media left out."""
    nodes = F.col("nodes")
    body = pages.withColumn("_body", N.body_node(nodes))
    top = F.coalesce(N.span(F.col("_body")), N.whole_page(nodes))
    topped = body.withColumn("_top", top)
    return topped.withColumn("text", N.final_text(nodes, F.col("_top"))).drop("_body", "_top")


def link_density(pages: DataFrame) -> DataFrame:
    """One row per block the density rule compares."""
    blocks = pages.select(
        "page_id",
        F.inline_outer(
            F.transform(
                N.density_blocks(F.col("nodes")),
                lambda n: F.struct(
                    n["node_id"].alias("node_id"), n["tag"].alias("tag"), n["words"].alias("words"),
                    n["links"].alias("links"), N.link_density(n).alias("density"),
                    N.density_score(n).alias("score"), N.eligible(n).alias("eligible"),
                ),
            )
        ),
    )
    return blocks.where(F.col("node_id").isNotNull())


def best_node(pages: DataFrame) -> DataFrame:
    """Add ``best_node``: the block with the best density score, NULL when none qualifies."""
    nodes = F.col("nodes")
    return pages.withColumn("best_node", F.get(nodes, N.best_node_id(nodes)))


def paragraph_candidate(pages: DataFrame) -> DataFrame:
    """Add ``paragraph_node``: the block its paragraphs speak for most."""
    nodes = F.col("nodes")
    return pages.withColumn("paragraph_node", F.get(nodes, N.paragraph_node_id("nodes")))


def selector_candidates(pages: DataFrame) -> DataFrame:
    """One row per node a selector rule of the page's host matches (pages need ``rules``)."""
    nodes = F.col("nodes")
    # Texts are taken inside the row: behind the generator every match would carry the page's nodes.
    found = F.transform(
        selected(nodes, F.col("rules")),
        lambda n: F.struct(
            n["node_id"].alias("node_id"), n["tag"].alias("tag"), strip_ws(N.inner_text(nodes, n, "\n")).alias("text")
        ),
    )
    matched = pages.select("page_id", "url", F.posexplode_outer(found).alias("ord", "n"))
    return matched.where(F.col("ord").isNotNull()).select("page_id", "url", "ord", "n.*")


def to_markdown(pages: DataFrame, top: str = None) -> DataFrame:
    """Add ``markdown`` of the subtree under ``top``, a node column, or of the whole page."""
    span = N.whole_page(F.col("nodes")) if top is None else N.span(F.col(top))
    pieces = pages.withColumn("_top", span).withColumn("_pieces", markdown_pieces("nodes", "_top"))
    return pieces.withColumn("markdown", settled_markdown("_pieces")).drop("_top", "_pieces")


def with_candidates(pages: DataFrame, jsonld: bool = True) -> DataFrame:
    """Add ``candidates``, in order (and ``_heads``)."""
    nodes, rules = F.col("nodes"), F.col("rules") if "rules" in pages.columns else None
    found = pages.select(
        "*",
        N.head_nodes(nodes).alias("_heads"),
        N.paragraph_node_id("nodes").alias("_paragraph"),
        N.best_node_id(nodes).alias("_density"),
    )
    listed = N.candidates(
        nodes, F.col("bodies"), F.col("_heads"), F.col("_paragraph"), F.col("_density"), rules, jsonld
    )
    return found.withColumn("candidates", listed).drop("_paragraph", "_density")


def content_candidates(pages: DataFrame, jsonld: bool = True) -> DataFrame:
    """Candidates as rows."""
    nodes = F.col("nodes")
    # As with selectors, texts and scores are settled before a candidate leaves the page's row.
    texts = with_candidates(pages, jsonld).select("page_id", N.candidate_texts(nodes, F.col("bodies"), F.col("candidates")).alias("_texts"))
    rows = texts.select("page_id", F.inline_outer("_texts"))
    return rows.where(F.col("method").isNotNull()).select("page_id", "ord", "method", "node_id", "text", "score")


def best_candidate(candidates: DataFrame) -> DataFrame:
    """The best-scored candidate per page from candidate rows; ties go to the earliest.

    The choice is combined before the shuffle, so however many candidates a page has, at most one
    per page and task moves.
    """
    best = F.max_by(
        F.struct("ord", "method", "text", "score"), F.struct(F.col("score"), (-F.col("ord")))
    )
    return candidates.groupBy("page_id").agg(best.alias("b")).select(
        "page_id", "b.ord", "b.method", "b.text", "b.score"
    )


def main_content(pages: DataFrame, jsonld: bool = True) -> DataFrame:
    """Node pages to ``title``, ``text``, ``markdown`` and ``word_count``; what the parse gave is dropped,
    but for ``parse_error``."""
    nodes, bodies, best = F.col("nodes"), F.col("bodies"), F.col("_best")
    chosen = (
        with_candidates(pages, jsonld)
        .withColumn("_distinct", N.distinct_candidates(F.col("candidates")))
        .withColumn("_best", N.best_of(nodes, bodies, F.col("_distinct")))
    )
    fallback = F.coalesce(N.span(N.body_node(nodes)), N.whole_page(nodes))
    spanned = chosen.withColumn("_tree", N.tree_nodes(nodes, bodies, best)).withColumn(
        "_top",
        F.when(
            best["node_id"].isNotNull(),
            F.struct(best["node_id"].alias("node_id"), best["end_id"].alias("end_id")),
        ).otherwise(fallback),
    )
    tree, top = F.col("_tree"), F.col("_top")
    done = spanned.withColumn(
        "_content",
        F.struct(
            N.page_title(nodes, F.col("_heads")).alias("title"),
            N.final_text(tree, top).alias("text"),
            N.span_words(tree, top, media=False).alias("word_count"),
        ),
    ).withColumn("_pieces", markdown_pieces("_tree", "_top"))
    keep = [c for c in pages.columns if c not in ("nodes", "bodies", "rules")]
    return done.select(
        *keep,
        F.when(F.col("_content.title") != "", F.col("_content.title"))
        .otherwise(N.fallback_title(nodes, F.col("_heads")))
        .alias("title"),
        F.col("_content.text").alias("text"),
        settled_markdown("_pieces").alias("markdown"),
        F.col("_content.word_count").alias("word_count"),
    )

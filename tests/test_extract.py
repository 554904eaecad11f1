import json

import pytest
from pyspark.sql import functions as F

from webcorpus.functions import nodes as N
from webcorpus.operators import articles as A
from webcorpus.operators import extract as E
from webcorpus.sources import pages as sources
from webcorpus.sources.pages import page_nodes

WORDS = " ".join(["word"] * 150)


def pages(spark, *htmls, url="https://site/en/x"):
    rows = [(i, url, h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def values(df, column):
    return [r[0] for r in df.orderBy("page_id").select(column).collect()]


def titles(spark, *htmls):
    return values(E.main_content(page_nodes(pages(spark, *htmls))), "title")


def texts(spark, *htmls):
    return values(E.html_to_text(page_nodes(pages(spark, *htmls))), "text")


def markdown(spark, *htmls):
    return values(E.to_markdown(page_nodes(pages(spark, *htmls))), "markdown")


def test_title_order(spark):
    parts = [
        '<meta property="og:title" content=" A ">', '<meta name="twitter:title" content="B">',
        "<title>C &amp; c</title>", "<h1>D <i>d</i></h1>",
    ]
    htmls = [f"<html><head></head><body>{''.join(parts[i:])}</body></html>" for i in range(4)]
    assert titles(spark, *htmls) == ["A", "B", "C & c", "D d"]


def test_title_empty_cases(spark):
    assert titles(
        spark,
        "<title></title><h1>D</h1>",
        '<meta property="og:title" content=""><title>C</title>',
        '<meta property="og:title" content=" "><title> C  c </title>',
        "<p>x</p>",
        "<header><h1>In header</h1></header><p>x</p>",
    ) == [N.NO_TITLE, "C", "C c", N.NO_TITLE, "In header"]


def test_killed_block_takes_its_tail(spark):
    assert texts(spark, "<body><div>a<nav>n</nav>tail<p>b</p></div></body>") == ["a\nb"]
    assert texts(spark, "<body><div>a<nav>n</nav><!-- c -->kept<svg/>gone<p>b</p></div></body>") == ["a\nkept\nb"]


def test_text_nodes_are_joined_by_newlines(spark):
    assert texts(spark, "<body><p>Hello <b>big</b> world</p></body>") == ["Hello \nbig\n world"]


def test_blank_texts_shrink(spark):
    assert texts(spark, "<body><p>a</p>\n   <p>b</p> \t <p>c</p></body>") == ["a\n\nb\n \nc"]


def test_cut_out_block_keeps_its_tail(spark):
    htmls = [
        f"<body><div>{WORDS}</div>tail<p>x</p></body>", f"<body><div>{WORDS}</div><!-- c -->no<p>x</p></body>",
        f"<body><section><div>{WORDS}</div></section>  <p>x</p></body>",
    ]
    nodes = page_nodes(pages(spark, *htmls))
    assert values(E.content_candidates(nodes).where("method = 'density'"), "text") == [WORDS + "\ntail", WORDS, WORDS]
    assert values(E.main_content(nodes), "markdown") == [WORDS + "\n\ntail", WORDS, WORDS]


def test_media_is_left_out(spark):
    assert texts(spark, "<body><p>a<video>no <b>no</b></video>b<img src=x>c</p></body>") == ["a\nb\nc"]


def test_body_fallback(spark):
    page = "<html><head><title>T</title></head><body>{}</body></html>"
    # a body without elements of its own counts as none
    assert texts(spark, page.format("<p>x</p>"), page.format("only text")) == ["x", "T\nonly text"]


def test_repair(spark):
    nodes = page_nodes(pages(spark, "<ul><li>a<li>b</ul><p>x<p>y<div>z</p></div><table><tr><td>1<td>2<tr><td>3</table>"))
    tree = nodes.select(F.inline("nodes")).where("tag <> '#text'").orderBy("node_id").collect()
    parents = {r.node_id: r.tag for r in tree}
    assert [(r.tag, parents.get(r.parent_id)) for r in tree] == [
        ("ul", None), ("li", "ul"), ("li", "ul"), ("p", None), ("p", None), ("div", None), ("table", None),
        ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("td", "tr"),
    ]


def test_density_needs_more_than_100_words(spark):
    htmls = [f"<div>{' '.join(['w'] * n)}</div>" for n in (100, 101)]
    assert values(E.best_node(page_nodes(pages(spark, *htmls))), "best_node.words") == [None, 101]


def test_link_density_limit(spark):
    def block(links):
        return f"<section>{'<a>x</a> ' * links}{' '.join(['w'] * (150 - links))}</section>"

    rows = E.link_density(page_nodes(pages(spark, block(75), block(76)))).orderBy("page_id").collect()
    assert [(r.words, r.links, float(r.score), r.eligible) for r in rows] == [(150, 75, 112.5, True), (150, 76, 112.0, False)]


def test_density_tie_goes_to_the_outer(spark):
    html = f"<body><div><article>{WORDS}</article></div></body>"
    assert values(E.best_node(page_nodes(pages(spark, html))), "best_node.tag") == ["div"]


def test_role_main_is_a_block(spark):
    html = f"<body><td role='main'>{WORDS}</td></body>"
    assert values(E.best_node(page_nodes(pages(spark, html))), "best_node.tag") == ["td"]


def test_words_run_through_inline_elements(spark):
    html = "<div>foo<b>bar</b> x</div>"
    rows = page_nodes(pages(spark, html)).select(F.inline("nodes")).orderBy("node_id").collect()
    assert [(r.tag, r.words) for r in rows if r.tag != "#text"] == [("div", 2), ("b", 1)]


def test_equal_candidates_first_wins(spark):
    rows = spark.createDataFrame(
        [(1, 0, "meta", "a", 5.0), (1, 1, "density", "b", 5.0), (2, 0, "meta", "a", 1.0), (2, 1, "density", "b", 2.0)],
        "page_id long, ord int, method string, text string, score double",
    )
    assert values(E.best_candidate(rows), "method") == ["meta", "density"]


def test_meta_body(spark):
    d, og = "d" * 101, "o" * 101
    meta = '<meta {}="{}" content="{}">'
    htmls = [
        meta.format("name", "description", d) + meta.format("property", "og:description", og),
        meta.format("name", "description", og) + meta.format("name", "DESCRIPTION", d),
        meta.format("name", "description", "x" * 100),
        meta.format("name", "description", d) + meta.format("name", "description", ""),
        f'<meta property="og:description" name="description" content="{og}">',
        "<nav>" + meta.format("name", "description", d) + "</nav>",
    ]
    htmls = [f"<html><head></head><body>{h}</body></html>" for h in htmls]
    nodes = page_nodes(pages(spark, *htmls))
    assert values(E.meta_body(nodes), "meta_body") == [og, d, None, d, og, None]
    rows = {(r.page_id, r.key): r.value for r in E.meta_last_wins(E.meta_tags(nodes)).collect()}
    assert rows[(1, "description")] == d and (5, "description") not in rows


def ld(*objects):
    scripts = "".join(
        f'<script type="application/ld+json">{o if isinstance(o, str) else json.dumps(o)}</script>' for o in objects
    )
    return f"<html><head>{scripts}</head><body><p>x</p></body></html>"


def test_jsonld_body(spark):
    body, good = "b" * 101, {"@type": "NewsArticle", "articleBody": " " + "b" * 101}
    cases = [
        (ld(good), body), (ld([good]), body), (ld({**good, "@type": "Person"}), None), (ld("{bad"), None),
        (ld("{bad", good), body), (ld({"@type": "blogPosting", "articleBody": "", "text": body}), body),
        (ld({**good, "articleBody": "x" * 100}), None), (ld({**good, "@type": ["Article"]}, good), None),
        (ld([], good), body), (ld({"@type": "Person"}, good), body), (ld({"x": 1}, good), body),
        (ld("7", good), None), (ld({**good, "@type": None}, good), None), ("<p>none</p>", None),
        (ld([good, {"x": 1}]), body), (ld("", good), body),
    ]
    found = values(E.jsonld_body(page_nodes(pages(spark, *[h for h, _ in cases]))), "jsonld_body")
    assert found == [b for _, b in cases]


def test_jsonld_switch(spark):
    html = ld({"@type": "Article", "articleBody": "long body " * 50})
    nodes = page_nodes(pages(spark, html))
    assert values(E.content_candidates(nodes), "method") == ["jsonld"]
    assert values(E.content_candidates(nodes, jsonld=False), "method") == []
    assert values(E.main_content(nodes), "text") == [("long body " * 50).strip()]
    assert values(E.main_content(nodes, jsonld=False), "text") == ["x"]


FILL = "words to make it long enough for a body " * 4


@pytest.mark.parametrize("carry", ["meta", "jsonld"])
def test_bodies_are_markup(spark, carry):
    """A body is parsed like a page: references by the standard's table, elements, blocks, Markdown."""
    bodies = {
        "<p>Hello <b>big</b> world</p><p>two</p>": ("Hello \nbig\n world\ntwo", "Hello **big** world\n\ntwo"),
        "a &lt; b &amp;amp; c": ("a < b &amp; c",) * 2,
        "it&apos;s &mdash; &laquo;x&raquo; &#8217;&#x1F600; &NotEqualTilde; &copy": ("it's — «x» ’😀 \u2242\u0338 ©",) * 2,
        "x<!-- c -->y": ("x\ny", "xy"),
        "<ul><li>one<li>two</ul>": ("one\ntwo", "* one\n* two"),
        "<header>kept</header><script>gone()</script><img alt=i>": ("kept", "kept"),
        "</div></body>after<div>x": ("after\nx", "after\n\nx"),
    }
    htmls = []
    for body in bodies:
        body = f"{body}<p>{FILL}</p>"
        if carry == "meta":
            value = body.replace("&", "&amp;").replace('"', "&quot;")
            htmls.append(f'<head><meta name=description content="{value}"></head><body><p>x</p></body>')
        else:
            htmls.append(ld(json.dumps({"@type": "Article", "articleBody": body}).replace("</", "<\\/")))
    nodes = page_nodes(pages(spark, *htmls))
    assert values(E.content_candidates(nodes), "method") == [carry] * len(bodies)
    done = E.main_content(nodes).cache()
    fill = FILL.strip()
    assert values(done, "text") == [f"{t}\n{fill}" for t, _ in bodies.values()]
    assert values(done, "markdown") == [f"{m}\n\n{fill}" for _, m in bodies.values()]


def test_bodies_leave_the_page_alone(spark):
    """Titles, blocks, rules and selectors look at the page's own tree only."""
    body = f"<h1>not a title</h1><article>{WORDS}</article>"
    html = f"<head><meta name=description content='{body}'></head><body><div><p>{WORDS} {WORDS} page</p></div></body>"
    nodes = page_nodes(pages(spark, html, url="https://s/x"))
    assert titles(spark, html) == ["[no-title]"]
    rows = E.content_candidates(nodes).orderBy("ord").collect()
    assert [r.method for r in rows] == ["paragraph", "meta", "density"]
    ruled = page_nodes(E.add_rules(pages(spark, html, url="https://s/x"), E.selector_rules(spark, [("s", 0, "article, h1")])))
    assert E.selector_candidates(ruled).count() == 0
    assert E.main_content(nodes).first()["word_count"] == 301


def test_odd_json(spark):
    """Half surrogate pairs, control characters, bodies that are no text, deep nesting: no job ends."""
    half = '{"@type": "Article", "articleBody": "' + "\\ud800 x\\u0000y " + "a" * 120 + '"}'
    listed = json.dumps({"@type": "Article", "articleBody": ["b" * 60, "c" * 60]})
    deep = "[" * 20_000
    got = E.content_candidates(page_nodes(pages(spark, ld(half), ld(listed), ld(deep), ld("[]"), ld("3")))).orderBy("page_id").collect()
    assert [(r.page_id, r.method) for r in got] == [(0, "jsonld"), (1, "jsonld")]
    assert got[0].text == "? xy " + "a" * 120 and got[1].text.count("b") == 60


def test_parse_errors_have_a_reason(spark):
    htmls = ["<!-- only a comment -->", " \n ", "<!DOCTYPE html>", "short", f"<p>{WORDS}</p>"]
    got = A.page_outcomes(pages(spark, *htmls)).orderBy("page_id")
    assert [r["reason"] for r in got.collect()] == ["parse_error"] * 3 + ["too_short", None]
    assert values(page_nodes(pages(spark, *htmls)), "parse_error") == ["no content"] * 3 + [None, None]


def test_a_failing_parse_is_named(monkeypatch):
    def fail(self, html):
        raise RecursionError

    monkeypatch.setattr(sources.PageNodes, "feed", fail)
    page, error = sources._parsed("<p>x</p>")
    assert (page.tag, error) == ([], "RecursionError")


def test_selectors(spark):
    html = '<body><div class="x news-body">in</div><nav><p class="news-body">n</p></nav></body>'
    both = pages(spark, html).union(pages(spark, html, url="https://kun.uz/a")).union(
        pages(spark, html, url="https://www.kun.uz/a"))
    ruled = page_nodes(E.add_rules(both, E.selector_rules(spark)))
    rows = E.selector_candidates(ruled).collect()
    assert [(r.url, r.text) for r in rows] == [("https://kun.uz/a", "in")]


@pytest.mark.parametrize("css, expected", [
    ("article", ["A"]), ("#main", ["B"]), ("div.c1.c2", ["C"]), (".c1", ["C", "D"]), ("p.c2", []),
    ("p, article", ["D", "A"]), ("[id=main]", ["B"]), ('p[class="c1"]', ["D"]), ("div[id]", ["B"]), ("*.c2", ["C"]),
])
def test_selector_forms(spark, css, expected):
    html = '<article>A</article><div id=main>B</div><div class="c2 c1">C</div><p class="c1">D</p>'
    rules = E.selector_rules(spark, [("site", 0, css)])
    rows = E.selector_candidates(page_nodes(E.add_rules(pages(spark, html), rules))).orderBy("ord").collect()
    assert [r.text for r in rows] == expected


@pytest.mark.parametrize("css", [
    "[itemprop=x]", "", "a:hover", "p,,div", "p,", "> p", "div >", "div > > p", "div + ~ p", "p[id", "p::before", "li:nth-child(2)",
])
def test_unknown_selectors_fail(spark, css):
    with pytest.raises(Exception, match="selector not supported"):
        E.add_rules(pages(spark, "<p>x</p>"), E.selector_rules(spark, [("site", 0, css)])).collect()


def test_paragraph_candidate(spark):
    long = "This sentence, with commas, is long enough to be counted as a paragraph."
    html = (
        f"<body><div class=sidebar><p>{long}</p></div><div id=story><p>{long}</p><p>{long}</p></div>"
        f"<div><p><a>{long}</a></p></div></body>"
    )
    teasers = f"<div id=list>{'<p>one two three four five <a>more</a></p>' * 20}</div><div id=text><p>{long}</div>"
    nodes = page_nodes(pages(spark, html, "<p>short</p>", f"<body>{teasers}</body>"))
    assert values(E.paragraph_candidate(nodes), "paragraph_node.attrs") == [{"id": "story"}, None, {"id": "text"}]


def test_end_tags_stay_in_their_scope(spark):
    html = (
        "<div id=a><table><tr><td>x</div>y</td><td><table><tr><td>in</tr></table>z</td></tr></table>"
        "<p>t<span>u<div>v</span>w</div></div><i>q<p>r</i>s</p>"
    )
    nodes = page_nodes(pages(spark, html)).selectExpr("inline(nodes)").collect()
    text = {n.text: n.parent_id for n in nodes if n.tag == "#text"}
    tag = {n.node_id: n.tag for n in nodes}
    # An end tag that is ignored does not part the text around it.
    assert (tag[text["xy"]], tag[text["z"]], tag[text["vw"]], tag[text["r"]]) == ("td", "td", "div", "p")


def test_markdown(spark):
    cases = {
        "<h2>T</h2><ul><li>a</li></ul><img src=x>": "## T\n\n* a",
        "<p>a <b> b </b>c <i>d</i></p>": "a  **b** c *d*",
        "<p>x<br>y</p>": "x  \ny",
        "<p>2*3_4 <code>a*b</code></p>": "2\\*3\\_4 `a*b`",
        '<p><a href="/u">t</a> <a>n</a> <a href="/e"></a></p>': "[t](/u) n",
        '<a href="http://x">http://x</a>': "<http://x>",
        "<ol start=9><li>a<li>b</ol>": "9. a\n10. b",
        "<ul><li>a<ul><li>b</li></ul></li><li><p>c</p></li></ul>": "* a\n  * b\n* c",
        "<blockquote><p>a</p><p>b</p></blockquote><p>c</p>": "> a\n>\n> b\n\nc",
        "<pre>  x\n  *y*</pre>": "```\n  x\n  *y*\n```",
        "<h1>a\nb</h1><hr>": "# a b\n\n---",
        "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td><b>2</b></td></tr></table>": "| A | B |\n| --- | --- |\n| 1 | **2** |",
        "<table><tr><td>1</td></tr></table>": "|  |\n| --- |\n| 1 |",
        "<h2></h2><p></p><b></b>x": "x",
        "<del>a</del><em></em>": "~~a~~",
        "<p>a<nav>n</nav></p>": "a",
        "  \n ": "",
    }
    assert dict(zip(cases, markdown(spark, *cases))) == cases


def article(body, head=""):
    return f"<html><head>{head}</head><body>{body}</body></html>"


def test_articles_need_a_good_page(spark):
    rows = [
        (0, "https://s/ru/0", 200, article(f"<article><p>{WORDS}</p></article>", "<title>T</title>")),
        (1, "https://s/1", 200, ""), (2, "https://s/2", 200, None), (3, "https://s/3", 404, article(WORDS)),
        (4, "https://s/4", 0, article(WORDS)), (5, "https://s/5", 200, article("<p>short</p>")), (6, "https://s/6", None, "x"),
    ]
    made = spark.createDataFrame(rows, "page_id long, url string, status int, html string")
    outcomes = A.page_outcomes(made).cache()
    reasons = {r.page_id: r.reason for r in outcomes.collect()}
    assert reasons == {0: None, 1: "empty", 2: "empty", 3: "status", 4: "status", 5: "too_short", 6: "status"}
    assert A.rejected(outcomes).count() == 6
    got = A.build_articles(made).collect()
    assert len(got) == 1
    assert (got[0].title, got[0].text, got[0].markdown, got[0].lang, got[0].source, got[0].word_count, got[0].status) == (
        "T", WORDS, WORDS, "ru", "s", 150, "success",
    )


def test_text_at_the_limit(spark):
    htmls = [article(f"<p> {'x' * n} </p>") for n in (99, 100)]
    assert values(A.page_outcomes(pages(spark, *htmls)), "reason") == ["too_short", None]


def test_no_candidate_takes_the_body(spark):
    body = "<ul><li>" + "</li><li>".join(["item"] * 30) + "</li></ul>"
    got = A.build_articles(pages(spark, article(body))).collect()
    assert got[0].text == "\n".join(["item"] * 30) and got[0].markdown.startswith("* item\n* item")


def test_domain_candidate_wins_by_score(spark):
    html = article(f'<div class="news-body">{"word " * 40}<p>{"tail " * 40}</p></div><p>{"x " * 20}</p>')
    got = A.build_articles(pages(spark, html, url="https://kun.uz/news"), rules=E.selector_rules(spark)).collect()
    assert got[0].lang == "uz" and got[0].source == "kun.uz" and got[0].word_count == 80


def test_summary(spark):
    rows = [("a", None, 10), ("a", None, 20), ("a", "empty", 0), ("a", "status", 0), ("b", "empty", 0)]
    outcomes = spark.createDataFrame(rows, "source string, reason string, word_count long")
    assert {tuple(r) for r in A.crawl_summary(outcomes).collect()} == {("a", 4, 2, 15.0), ("b", 1, 0, None)}


def test_min_length_filter(spark):
    rows = spark.createDataFrame([(" " + "a" * 99,), ("a" * 100,), ("",), (None,)], "text string")
    assert A.min_length_filter(rows).count() == 1


def test_bad_markup_fails_no_job(spark):
    htmls = [
        "<", "<>", "</", "<a", "<a href='", "<!--", "<!", "<?", "<script>", "<title>", "a<b<c", "&#xD800;&#0;&bogus;",
        "<div " + "x" * 1000, "</p></div>", "<p/>" * 50, "<b>" * 2000 + "x", "\x00\x01<p>\x02", "<table><td><table><td>x",
        "<html><html><body><body><head>x", "<svg><title>t</title></svg>y", "<a<b>c", "<p a=1 a=2 =3 '>x",
    ]
    assert E.main_content(page_nodes(pages(spark, *htmls))).count() == len(htmls)


def test_pages_are_parsed_a_few_at_a_time():
    """A worker holds the trees of a quarter of a million characters, however many pages a batch brings."""
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    from webcorpus.schemas import BODIES, NODES
    from webcorpus.sources.pages import _node_batches

    schema = T.StructType([
        T.StructField("page_id", T.LongType()), T.StructField("nodes", NODES), T.StructField("bodies", BODIES),
        T.StructField("parse_error", T.StringType()),
    ])
    html = "<html><body><p>" + "x " * 500 + "</p></body></html>"
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array([html] * 2000)], ["page_id", "html"])
    got = list(_node_batches(["page_id"], to_arrow_schema(schema), None)([batch]))
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(2000))
    assert max(b.num_rows for b in got) * len(html) < 250_000 + len(html)

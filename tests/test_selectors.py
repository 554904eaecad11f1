"""Selectors with steps against a plain matcher on random trees."""

import random
import re
import time

from pyspark.sql import functions as F

from webcorpus.functions import nodes as N
from webcorpus.operators import extract as E
from webcorpus.sources.pages import page_nodes

TAGS = ("div", "section", "span", "b")


def selected(spark, cases):
    """(nodes, ids that match) of each (html, selector); every case is a page and a host of its own."""
    pages = [(k, f"https://s{k}/x", html) for k, (html, _) in enumerate(cases)]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = E.selector_rules(spark, [(f"s{k}", 0, css) for k, (_, css) in enumerate(cases)])
    rows = page_nodes(E.add_rules(pages, rules))
    nodes = {r["page_id"]: [n.asDict() for n in r["nodes"]] for r in rows.collect()}
    found = {k: [] for k in nodes}
    for r in E.selector_candidates(rows).orderBy("page_id", "ord").collect():
        found[r["page_id"]].append(r["node_id"])
    return [(nodes[k], found[k]) for k in range(len(cases))]


def markup(rng, depth=0):
    out = ""
    for _ in range(rng.randrange(1, 4)):
        tag = rng.choice(TAGS)
        classes = " ".join(rng.sample(["x", "y", "z"], rng.randrange(3)))
        inner = markup(rng, depth + 1) if depth < 5 and rng.random() < 0.6 else "t"
        block = f"<nav>{inner}</nav>" if rng.random() < 0.1 else inner
        out += f'{rng.choice(["", " text ", "<!-- c -->"])}<{tag} class="{classes}" id="{rng.choice("pq")}">{block}</{tag}>'
    return out


def selector(rng):
    def compound():
        return rng.choice(TAGS + ("*", "")) + rng.choice(["", ".x", ".y.z", "#p", "[class]", '[class~="x"]', "[id=q]"]) or "*"

    return compound() + "".join(rng.choice([" ", " > ", ">", " + ", "~"]) + compound() for _ in range(rng.randrange(4)))


def plain(nodes, css):
    """Ids of live elements that match, looked for from the last step backwards."""
    parts = re.split(r"(\s*(?:[>+]|~(?!=))\s*|\s+)", css)

    def element(n):
        return not n["killed"] and not n["tag"].startswith("#")

    def fits(n, part):
        classes = (n["attrs"] or {}).get("class", "").split()
        ok = element(n) and (part[:1] in "*.#[" or re.match(r"\w+", part)[0] == n["tag"])
        ok = ok and all(c in classes for c in re.findall(r"\.(\w+)", part))
        ok = ok and all((n["attrs"] or {}).get("id") == i for i in re.findall(r"#(\w+)", part))
        for name, op, value in re.findall(r'\[(\w+)(~?=)?"?(\w*)"?\]', part):
            found = (n["attrs"] or {}).get(name)
            ok = ok and found is not None and (not op or (value in found.split() if op == "~=" else found == value))
        return ok

    def siblings(n):
        return [m for m in nodes if m["parent_id"] == n["parent_id"] and m["node_id"] < n["node_id"] and element(m)]

    def matches(n, k):
        if not fits(n, parts[k]):
            return False
        if k == 0:
            return True
        step = parts[k - 1].strip()
        if step == ">":
            near = [nodes[n["parent_id"]]] if n["parent_id"] >= 0 else []
        elif step == "+":
            near = siblings(n)[-1:]
        elif step == "~":
            near = siblings(n)
        else:
            near = [m for m in nodes if m["node_id"] < n["node_id"] <= m["end_id"]]
        return any(matches(m, k - 2) for m in near)

    return [n["node_id"] for n in nodes if matches(n, len(parts) - 1)]


def test_random_trees(spark):
    rng = random.Random(8)
    cases = [(f"<body>{markup(rng)}</body>", selector(rng)) for _ in range(120)]
    found = selected(spark, cases)
    assert [got for _, got in found] == [plain(nodes, css) for (nodes, _), (_, css) in zip(found, cases)]
    assert sum(bool(got) for _, got in found) > 30


STEPS = {
    "ul > li": "ABC", "ul li": "ABC", "li + li": "BC", "li ~ .k": "C", "ul > li + li + li": "C", "body>ul>li.k": "C",
    "p + ul li": "", "ul + p": "D", "ul ~ p": "DE", "li, p": "ABCDE", '[title="a, > b"]': "D", "p[title^=a]": "D",
    "p[title$='> b']": "D", "[title*=nothing]": "", "[title*='']": "", "[class|=k]": "CE", "ul\n>\tli.k": "C", "ul > b": "",
    "[ title = 'a, > b' ]": "D", "nav ~ p": "", "#u>li": "ABC", "p, ul > li": "DEABC",
}


def test_steps(spark):
    html = ("<body><nav>x</nav><ul id=u><li>A</li> t <li>B</li><!-- c --><li class=k>C</li></ul>"
            '<form>f</form><p title="a, &gt; b">D</p><b>x</b><p class="k-1">E</p></body>')
    found = selected(spark, [(html, css) for css in STEPS])
    texts = ["".join(n["text"] for i in got for n in nodes if n["parent_id"] == i and n["tag"] == "#text") for nodes, got in found]
    assert dict(zip(STEPS, texts)) == STEPS


def test_large_pages(spark):
    """Steps over thousands of kept nodes compare none of them in pairs."""
    html = "<body>" + "<div class=a><p>x</p><p>y</p></div>" * 8000 + "</body>"
    start = time.time()
    found = selected(spark, [(html, css) for css in ("div p", "div > p", "p + p", "div ~ div > p")])
    assert [len(got) for _, got in found] == [16000, 16000, 8000, 15998]
    assert time.time() - start < 40
    deep = "<body>" + "<div>" * 300 + "<p>x</p>" + "</div>" * 300 + "</body>"
    assert [len(got) for _, got in selected(spark, [(deep, css) for css in ("div div p", "div > div > p", "body p")])] == [1, 1, 1]


def test_many_matches_among_candidates(spark):
    """Rules that match the same thousands of nodes: every span is a candidate once, settled in the page's row."""
    html = "<body>" + "<p>x</p>" * 16000 + "<p>" + "word " * 30 + "</p></body>"
    pages = spark.createDataFrame([(0, "https://s/x", html)], "page_id long, url string, html string")
    rules = E.selector_rules(spark, [("s", 0, "p"), ("s", 1, "body > p")])
    rows = E.with_candidates(page_nodes(E.add_rules(pages, rules))).select("page_id", "nodes", "bodies", "candidates").cache()
    size = rows.select(F.size("candidates"), F.size(N.distinct_candidates(F.col("candidates"))))
    assert tuple(size.first()) == (2 * 16001 + 1, 16002)
    start = time.time()
    size.first()
    assert time.time() - start < 3
    best = rows.select(N.best_of(F.col("nodes"), F.col("bodies"), N.distinct_candidates(F.col("candidates"))).alias("b")).first()["b"]
    assert best["method"] == "paragraph"

"""Selectors with steps: compounds joined by descendant, child and sibling combinators.

A selector is read into steps once, next to the rules.  On a page the steps run over the preorder
array one after the other, each keeping the nodes that match its compound and stand in the right
place to a node kept by the step before.  An ancestor is known by its ``end_id``, a parent by
``parent_id``; kept nodes are looked up by halving sorted arrays, so no step compares them in pairs.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME = r"[\w-]+"
VALUE = r"""(?:"[^"]*"|'[^']*'|[\w-]+)"""
ATTRIBUTE = rf"\[\s*[\w:-]+\s*(?:[~|^$*]?=\s*{VALUE}\s*)?\]"
COMPOUND = rf"(?=[\w*#.\[])(?:[A-Za-z][A-Za-z0-9-]*|\*)?(?:#{NAME}|\.{NAME}|{ATTRIBUTE})*"
COMBINATOR = r"(?:\s*[>+~]\s*|\s+)"
SELECTOR = rf"^\s*{COMPOUND}(?:{COMBINATOR}{COMPOUND})*\s*$"
# What stands between the commas of a list; a comma in a quoted value or a bracket does not part it.
LISTED = r"""(?:[^,\["']|\[(?:"[^"]*"|'[^']*'|[^\]"'])*\])+"""
PARTED = r"""^(?:[^\["']|\[(?:"[^"]*"|'[^']*'|[^\]"'])*\])*$"""
HALVINGS = 24   # more than the logarithm of the nodes of any page


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- reading -------------------------------------------------------------------------------


def selectors_of(css) -> Column:
    """The selectors of a list; the list itself where its brackets or quotes don't close."""
    css = F.col(css) if isinstance(css, str) else css
    parts = F.transform(F.regexp_extract_all(css, F.lit(LISTED), F.lit(0)), lambda s: F.trim(s))
    commas = F.size(F.regexp_extract_all(F.regexp_replace(css, ATTRIBUTE, ""), F.lit(","), F.lit(0)))
    return F.when(css.rlike(PARTED) & (F.size(parts) == commas + 1), parts).otherwise(F.array(css))


def is_selector(one) -> Column:
    return one.rlike(SELECTOR)


def steps_of(one) -> Column:
    """array<struct<comb, tag, id, classes, attrs>>; ``comb`` is '', ' ', '>', '+' or '~'."""
    pieces = F.regexp_extract_all(F.trim(one), F.lit(f"(?:^|{COMBINATOR}){COMPOUND}"), F.lit(0))

    def step(piece, k):
        comb = F.regexp_replace(F.regexp_extract(piece, f"^({COMBINATOR})?", 1), r"\s", "")
        plain = F.regexp_replace(piece, ATTRIBUTE, "")
        return F.struct(
            F.when(k == 0, "").when(comb == "", " ").otherwise(comb).alias("comb"),
            F.lower(F.regexp_extract(plain, r"^[\s>+~]*([A-Za-z][A-Za-z0-9-]*)", 1)).alias("tag"),
            F.regexp_extract_all(plain, F.lit(rf"#({NAME})"), F.lit(1)).alias("ids"),
            F.regexp_extract_all(plain, F.lit(rf"\.({NAME})"), F.lit(1)).alias("classes"),
            F.transform(F.regexp_extract_all(piece, F.lit(ATTRIBUTE), F.lit(0)), attribute).alias("attrs"),
        )

    return F.transform(pieces, step)


def attribute(text) -> Column:
    """struct<name, op, value> of one bracket; ``op`` is '' where only the name is asked for."""
    value = F.regexp_extract(text, rf"=\s*({VALUE})\s*\]$", 1)
    return F.struct(
        F.lower(F.regexp_extract(text, r"^\[\s*([\w:-]+)", 1)).alias("name"),
        F.regexp_extract(text, r"^\[\s*[\w:-]+\s*([~|^$*]?=)?", 1).alias("op"),
        F.regexp_replace(value, r"""^["']|["']$""", "").alias("value"),
    )


def names_of(steps) -> Column:
    """Attributes that the steps look at."""
    return F.flatten(F.transform(steps, lambda s: s["attrs"]["name"]))


# --- matching ------------------------------------------------------------------------------


def has_attribute(attr, a) -> Column:
    """Whether a value (NULL without the attribute) is what a bracket asks for."""
    wanted, none = a["value"], F.lit(False)
    found = (
        F.when(a["op"] == "", attr.isNotNull())
        .when(a["op"] == "=", attr == wanted)
        .when(a["op"] == "~=", F.array_contains(F.split(attr, r"\s+"), wanted) & (wanted != ""))
        .when(a["op"] == "|=", (attr == wanted) | attr.startswith(F.concat(wanted, F.lit("-"))))
        .when(wanted == "", none)
        .when(a["op"] == "^=", attr.startswith(wanted))
        .when(a["op"] == "$=", attr.endswith(wanted))
        .otherwise(attr.contains(wanted))
    )
    return F.coalesce(found, none)


def matches(step, n) -> Column:
    """Whether a live element matches the compound of a step."""

    def attr(name):
        return F.try_element_at(n["attrs"], name)

    classes = F.split(F.coalesce(attr(F.lit("class")), F.lit("")), r"\s+")
    return (
        ~n["killed"]
        & ~n["tag"].startswith("#")
        & ((step["tag"] == "") | (n["tag"] == step["tag"]))
        & F.forall(step["ids"], lambda i: F.coalesce(attr(F.lit("id")) == i, F.lit(False)))
        & ((F.size(step["classes"]) == 0) | (F.size(F.array_except(step["classes"], classes)) == 0))
        & F.forall(step["attrs"], lambda a: has_attribute(attr(a["name"]), a))
    )


def place(n) -> Column:
    return F.struct(*[n[c].alias(c) for c in ("node_id", "end_id", "parent_id")])


def below_count(keys, x) -> Column:
    """How many of the sorted keys are less than x, by halving."""
    size = F.size(keys)
    widths = F.array(*[F.lit(1 << k) for k in range(HALVINGS - 1, -1, -1)])
    return F.aggregate(
        widths, F.lit(0), lambda at, w: F.when((at + w <= size) & (F.get(keys, at + w - 1) < x), at + w).otherwise(at)
    )


def inside_one(starts, ends, n) -> Column:
    """Whether n lies below a kept node: more of them have begun before n than have ended."""
    return below_count(starts, n["node_id"]) > below_count(ends, n["node_id"])


def child_of_one(ids, n) -> Column:
    return F.coalesce(F.get(ids, below_count(ids, n["parent_id"])) == n["parent_id"], F.lit(False))


def before(siblings, n) -> Column:
    """The last kept node before n under the same parent, NULL without one; ``siblings`` are sorted."""
    at = below_count(siblings, F.struct(n["parent_id"].alias("parent_id"), n["node_id"].alias("node_id"), F.lit(-1).alias("end_id")))
    last = F.get(siblings, at - 1)
    return F.when(last["parent_id"] == n["parent_id"], last)


def next_to(nodes, last, n) -> Column:
    """Whether no live element stands between two siblings."""
    between = F.slice(nodes, last["end_id"] + 2, F.greatest(n["node_id"] - last["end_id"] - 1, F.lit(0)))
    return F.coalesce(~F.exists(between, lambda x: ~x["killed"] & ~x["tag"].startswith("#")), F.lit(False))


def after_step(nodes, kept, step) -> Column:
    """The nodes that match a step, given those kept by the step before."""
    found = F.transform(F.filter(nodes, lambda n: matches(step, n)), place)

    def with_siblings(keep):
        siblings = F.array_sort(F.transform(kept, lambda m: F.struct(*[m[c].alias(c) for c in ("parent_id", "node_id", "end_id")])))
        return let(siblings, lambda s: F.filter(found, lambda n: keep(before(s, n), n)))

    return (
        F.when(step["comb"] == "", found)
        .when(step["comb"] == " ", let(
            F.struct(kept["node_id"].alias("starts"), F.array_sort(kept["end_id"]).alias("ends")),
            lambda k: F.filter(found, lambda n: inside_one(k["starts"], k["ends"], n)),
        ))
        .when(step["comb"] == ">", let(kept["node_id"], lambda ids: F.filter(found, lambda n: child_of_one(ids, n))))
        .when(step["comb"] == "+", with_siblings(lambda last, n: last.isNotNull() & next_to(nodes, last, n)))
        .otherwise(with_siblings(lambda last, n: last.isNotNull()))
    )


def selected(nodes, rules) -> Column:
    """The nodes that a page's rules match: rule by rule, each in document order; NULL without rules."""
    start = F.slice(F.transform(nodes, place), 1, 0)

    def of_rule(rule):
        kept = F.aggregate(rule["steps"], start, lambda kept, step: after_step(nodes, kept, step))
        return F.transform(kept, lambda n: F.get(nodes, n["node_id"]))

    return F.when(rules.isNotNull(), F.flatten(F.transform(rules, of_rule)))

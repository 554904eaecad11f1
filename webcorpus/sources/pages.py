"""Fetched pages, and pages as node arrays."""

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from webcorpus.schemas import BODIES, NODES, PAGES
from webcorpus.sources.markup import PageNodes

# The meta keys searched for a body.
META_BODY_KEYS = ("article:content", "og:description", "description")
MIN_BODY_LENGTH = 100    # a body from structured data or meta tags needs more characters

# Attributes the article pipeline reads.
ARTICLE_ATTRIBUTES = (
    "class", "id", "role", "property", "name", "content", "type", "href", "title", "start",
)


def spread_small(df: DataFrame) -> DataFrame:
    """Spread an input that its scan cannot split over all cores; larger ones keep their splits.

    Below one minimal split per core a file may be read by a single task.  The size is the
    planner's own estimate, so no job runs, and no big table is ever shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    smallest_split = spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * smallest_split else df


def read_pages(spark: SparkSession, path, schema: T.StructType = PAGES) -> DataFrame:
    """Read fetched pages from parquet and keep the good ones."""
    return spark.read.schema(schema).parquet(path).transform(fetched_pages)


def fetched_pages(pages: DataFrame) -> DataFrame:
    """Drop pages whose status is not 200 or whose body is empty; no status column means 200."""
    ok = F.col("html") != ""
    if "status" in pages.columns:
        ok = ok & (F.col("status") == 200)
    return pages.where(ok)


def page_nodes(pages: DataFrame, attributes=None) -> DataFrame:
    """Replace ``html`` by ``nodes``, the page's elements and texts in preorder; one row per page.

    ``bodies`` has the markup that meta tags and JSON-LD carry, as trees of their own, and ``parse_error``
    says why a page gave no nodes.  All other columns pass through.  ``attributes`` limits the
    attributes kept, None keeps all.  Pages never leave their row, so nothing is shuffled.
    """
    added = [T.StructField("nodes", NODES), T.StructField("bodies", BODIES), T.StructField("parse_error", T.StringType())]
    kept = [f for f in pages.schema.fields if f.name not in ("html", *[f.name for f in added])]
    schema = T.StructType(kept + added)
    names = None if attributes is None else frozenset(attributes)
    parse = _node_batches([f.name for f in kept], to_arrow_schema(schema), names)
    return pages.mapInArrow(parse, schema)


def _node_batches(kept, arrow, names, chars_per_batch=250_000):
    def parse(batches):
        for batch in batches:
            pages = batch.column(batch.schema.get_field_index("html"))
            lo, size, parsed = 0, 0, []
            for i in range(len(pages)):
                html = pages[i].as_py() or ""
                parsed.append(_parsed(html))
                size += len(html)
                if size >= chars_per_batch or i == len(pages) - 1:
                    part = batch.slice(lo, i + 1 - lo)
                    trees, errors = zip(*parsed)
                    columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                    columns.append(_nodes_array(trees, arrow.field("nodes").type, names))
                    columns.append(_bodies_array(trees, arrow.field("bodies").type, names))
                    columns.append(pa.array(errors, pa.string()))
                    columns = [c.cast(f.type) for c, f in zip(columns, arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                    lo, size, parsed = i + 1, 0, []

    return parse


def _parsed(html, page=True):
    """(tree, why there is none); one page must not end a job."""
    try:
        page = PageNodes(page).feed(html)
    except Exception as error:
        return PageNodes(), type(error).__name__
    return page, None if page.tag else "no content"


def _markup_bodies(page):
    """(node, markup) of a page's meta tags and JSON-LD scripts that are long enough to be a body."""
    for node, tag in enumerate(page.tag):
        if tag == "meta" and not page.killed[node]:
            key = page.attrs[node].get("property") or page.attrs[node].get("name") or ""
            body = page.attrs[node].get("content", "") if key.lower() in META_BODY_KEYS else ""
        elif tag == "script" and node + 1 < len(page.tag) and page.parent[node + 1] == node:
            body = _jsonld_text(page.text[node + 1])
        else:
            continue
        if len(body) > MIN_BODY_LENGTH:
            yield node, body


def _jsonld_text(script):
    try:
        item = json.loads(script)
        item = item[0] if isinstance(item, list) and item else item
        body = (item.get("articleBody") or item.get("text") or "") if isinstance(item, dict) else ""
    except (ValueError, RecursionError):
        return ""
    body = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False, separators=(",", ":"))
    return body.encode("utf-8", "replace").decode("utf-8")     # escapes may give half a surrogate pair


def _bodies_array(parsed, list_type, names):
    """Arrow list<struct<of_id, nodes>>: the same pass gives the trees of all bodies."""
    offsets, of_ids, trees = [0], [], []
    for page in parsed:
        for node, markup in _markup_bodies(page):
            of_ids.append(node)
            trees.append(_parsed(markup, page=False)[0])
        offsets.append(len(of_ids))
    fields = list(list_type.value_type)
    struct = pa.StructArray.from_arrays([pa.array(of_ids, pa.int32()), _nodes_array(trees, fields[1].type, names)], fields=fields)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct, type=list_type)


def _nodes_array(parsed, list_type, names):
    """Arrow list<struct> from the pages' column lists, without a Python object per node."""
    node_type = list_type.value_type
    offsets = [0]
    for page in parsed:
        offsets.append(offsets[-1] + len(page.tag))

    def flat(attribute):
        return [v for page in parsed for v in getattr(page, attribute)]

    key_offsets, keys, values = [0], [], []
    for page in parsed:
        for attrs in page.attrs:
            for k, v in (attrs or {}).items():
                if names is None or k in names:
                    keys.append(k)
                    values.append(v)
            key_offsets.append(len(keys))
    columns = {
        "node_id": [i for page in parsed for i in range(len(page.tag))],
        "parent_id": flat("parent"),
        "end_id": flat("end"),
    }
    arrays = []
    for field in node_type:
        if field.name == "attrs":
            arrays.append(
                pa.MapArray.from_arrays(
                    pa.array(key_offsets, pa.int32()),
                    pa.array(keys, pa.string()),
                    pa.array(values, pa.string()),
                ).cast(field.type)
            )
        else:
            data = columns[field.name] if field.name in columns else flat(field.name)
            arrays.append(pa.array(data, field.type))
    struct = pa.StructArray.from_arrays(arrays, fields=list(node_type))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct, type=list_type)

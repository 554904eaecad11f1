"""Explicit schemas of every table the package reads or writes; nothing is inferred."""

from pyspark.sql import types as T

SITEMAP_BODIES = T.StructType([
    T.StructField("sitemap_url", T.StringType(), False),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.BinaryType()),
])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

ARTICLE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("markdown", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("crawled_at", T.StringType()),
    T.StructField("word_count", T.LongType()),
    T.StructField("status", T.StringType()),
])

# One stored article: the record, its place in the append order, and its partitions.
ARTICLE_LOG = T.StructType(
    ARTICLE.fields
    + [
        T.StructField("pos", T.LongType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("writer", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("source_key", T.StringType()),
    ]
)

# The key of a stored article, with the batch it is from.
ARTICLE_KEYS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("writer", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
])

TRAIN_SHARD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("lang", T.StringType()),
])

# A page as a preorder array.  The descendants of node n are n.node_id < id <= n.end_id, so a
# subtree is a slice.  Text nodes have the tag '#text', comments (without their text) '#comment'.
NODE = T.StructType([
    T.StructField("node_id", T.IntegerType()),
    T.StructField("parent_id", T.IntegerType()),   # -1 at the top
    T.StructField("end_id", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("text", T.StringType()),         # text nodes only
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("killed", T.BooleanType()),      # removed block, inside one, or the text after one
    T.StructField("media", T.BooleanType()),       # a media element or inside one
    T.StructField("words", T.IntegerType()),       # words of the live text of the subtree
    T.StructField("links", T.IntegerType()),       # live <a> elements below
    T.StructField("item_no", T.IntegerType()),     # number of an ordered item, or row of a table; else 0
    T.StructField("indent", T.IntegerType()),      # columns a continued line is indented by lists
    T.StructField("quotes", T.IntegerType()),      # enclosing block quotes
    T.StructField("verbatim", T.IntegerType()),    # 2 in <pre>, 1 in inline code, else 0
    T.StructField("oneline", T.BooleanType()),     # inside a heading or a table cell
])

NODES = T.ArrayType(NODE)

# Bodies that a page carries as markup in meta tags or JSON-LD, each a tree of its own.
BODIES = T.ArrayType(T.StructType([
    T.StructField("of_id", T.IntegerType()),       # the page's meta or script node
    T.StructField("nodes", NODES),
]))


def cast_schema(df, schema=ARTICLE):
    """Select and cast to the columns of a schema, in its order."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])

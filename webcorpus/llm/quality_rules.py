"""Quality rules: line frequency across the documents of a host, and base counts; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]"
SEPARATORS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A line is boilerplate if more than MIN_LINE_DOCS documents of its host and more than LINE_ROOT times the
#: square root of their number hold it: menus and notices of a host stand on ever more pages as it grows,
#: while a share of its pages would let them pass on large hosts.  A document is depleted if less than
#: MIN_LEFT of its words are left.
MIN_LINE_DOCS = 20
LINE_ROOT = 2
MIN_LEFT = 0.5


def repeated_words(words: Column) -> Column:
    """Words inside windows of 8 words that stand at least twice in the text."""
    n = F.size(words)
    prints = F.transform(
        F.sequence(F.lit(1), n - REPEAT_WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, REPEAT_WINDOW))
    )
    return F.when(n > REPEAT_WINDOW, prints)


def covered(prints: Column) -> Column:
    """Positions covered by the windows whose print is not the only one of its kind."""
    pairs = F.sort_array(F.transform(prints, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(prints)) < F.size(prints), pairs)


def base_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumn("qr__words", F.array_remove(F.split(text, SEPARATORS), ""))
    d = d.withColumn("qr__lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)))
    d = d.withColumn("qr__prints", repeated_words(F.col("qr__words")))
    d = d.withColumn("qr__pairs", covered(F.col("qr__prints")))
    pairs = F.col("qr__pairs")
    places = F.sort_array(F.transform(
        F.filter(pairs, lambda x, k: (F.get(pairs, k - 1)["h"] == x["h"]) | (F.get(pairs, k + 1)["h"] == x["h"])),
        lambda x: x["i"],
    ))
    start = F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WINDOW).alias("last"))
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate(
        places, start,
        lambda a, p: F.struct((a["n"] + F.least(F.lit(REPEAT_WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    ), F.lit(0)).cast("long"))
    d = d.withColumns({
        "n_words": F.size("qr__words").cast("long"),
        "word_chars": F.length(F.array_join("qr__words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("qr__lines") - F.size(F.array_distinct("qr__lines"))).cast("long"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.withColumn("base_failed", failed).drop("qr__words", "qr__lines", "qr__prints", "qr__pairs")


def line_print(line: Column) -> Column:
    """Print of a line whatever its case and white space."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), SEPARATORS, " ")))


def documents_of(rows: DataFrame, *by: str) -> DataFrame:
    """Number of different documents per key, as `documents`; rows without an id count once per text.

    Distinct (key, document) first, so that a hot key is spread over its documents; then counts, summed
    up in each task before they are exchanged.
    """
    text = F.when(F.col("id").isNull(), F.col("content")).alias("content")
    return rows.select(*by, "id", text).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("documents"))


def common_lines(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """(host, print) of lines that too many documents of a host hold; each copy of a text is a document."""
    counts = documents_of(lines, "host", "print").withColumnRenamed("documents", "n")
    many = counts.where(F.col("n") > MIN_LINE_DOCS).join(sizes.withColumnRenamed("host", "its"), F.col("host").eqNullSafe(F.col("its")))
    return many.where(F.col("n") * F.col("n") > LINE_ROOT**2 * F.col("documents")).select("host", "print")


def quality_rules(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """Adds the base counts, base_failed, left_text, n_left_words and kept.

    left_text is the text without the lines that are too common on its host, n_left_words its words; other
    lines stay as they are, also those without a word.
    Kept: not base_failed and not depleted by the removal of common lines.  A null text has no words
    and fails; a null host is a host of its own; rows that repeat an id are judged by their own text.
    Columns of `docs` with the added names are replaced.  An empty table gives none.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "left_text", "n_left_words", "kept")
    keep = [c for c in docs.columns if c not in added]
    content = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    base = base_counts(docs.select(*[F.col(f"`{c}`") for c in keep], content.alias("qr__content")), text_col)
    slim = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), content.alias("content"), F.col(text_col).alias("text"))
    line = slim.select("id", "host", "content", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(WORD))
    lines = line.select(
        "id", "host", "content", line_print(F.col("line")).alias("print"),
        F.size(F.array_remove(F.split("line", SEPARATORS), "")).alias("words"),
    )
    common = common_lines(lines, documents_of(slim, "host")).select(F.col("host").alias("its"), F.col("print").alias("that"))
    lost = lines.join(common, F.col("host").eqNullSafe(F.col("its")) & (F.col("print") == F.col("that")))
    # Rows with one id, host and text have the same lines: the share of one of them counts.
    copies = F.count(F.lit(1))
    lost = lost.groupBy("id", "host", "content").agg(F.sum("words").alias("lost"), F.collect_set("print").alias("prints"))
    rows = slim.groupBy("id", "host", "content").agg(copies.alias("copies")).where(F.col("copies") > 1)
    lost = lost.alias("l").join(
        rows.alias("r"),
        F.expr("l.id <=> r.id AND l.host <=> r.host AND l.content = r.content"), "left",
    ).selectExpr("l.id AS qr__id", "l.host AS qr__host", "l.content AS qr__text", "l.lost / coalesce(r.copies, 1) AS qr__lost", "l.prints AS qr__gone")
    same = (
        F.col(id_col).eqNullSafe(F.col("qr__id")) & F.col(host_col).eqNullSafe(F.col("qr__host"))
        & (F.col("qr__content") == F.col("qr__text"))
    )
    out = base.join(lost, same, "left")
    left = F.col("n_words") - F.coalesce("qr__lost", F.lit(0))
    kept = ~F.col("base_failed") & (left >= MIN_LEFT * F.col("n_words"))
    stay = F.filter(F.split(F.col(text_col), "\n"), lambda x: ~F.array_contains("qr__gone", line_print(x)))
    left_text = F.when(F.col("qr__gone").isNull(), F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    out = out.withColumn("left_text", left_text).withColumn("n_left_words", left.cast("long"))
    return out.withColumn("kept", kept).drop("qr__id", "qr__host", "qr__text", "qr__lost", "qr__gone", "qr__content")

"""Scalar column functions: whitespace, words, URLs, languages, timestamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
WORD = r"[\p{L}\p{N}_]+"
LANGUAGES = ("en", "ru", "uz")
DEFAULT_LANGUAGE = "uz"
MIN_CONTENT_LENGTH = 100


def quoted(text: str) -> str:
    """A string as SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip_ws(c) -> Column:
    """Strip every kind of Unicode whitespace from both ends (built-in ``trim`` only strips U+0020)."""
    return F.trim(c, F.lit(WHITESPACE))


def word_count(c) -> Column:
    """Number of runs of letters, digits and underscores of any script."""
    return F.regexp_count(c, F.lit(WORD)).cast("bigint")


def line_count(c) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def collapse_blank_lines(c) -> Column:
    """Three or more newlines to two; a plain search spares texts without any."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(
        F.contains(c, F.lit("\n\n\n")), F.regexp_replace(c, "\n{3,}", "\n\n")
    ).otherwise(c)


def url_scheme(url) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def url_netloc(url) -> Column:
    """Authority with user and port as written; '' when there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def url_path(url) -> Column:
    """Path without query, fragment and the parameters of its last segment."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def url_lang(url, allowed=LANGUAGES, default=DEFAULT_LANGUAGE) -> Column:
    """Language named by the first path segment, else the default."""
    segment = F.lower(F.regexp_extract(url_path(url), r"^/*([^/]*)", 1))
    return F.when(segment.isin(*allowed), segment).otherwise(F.lit(default))


def source_key(source) -> Column:
    """Partition name of a source: all but word characters and '-' become '_'."""
    return F.regexp_replace(source, r"[^\p{L}\p{N}_-]", "_")


def is_sitemap_link(url) -> Column:
    return F.lower(url).rlike(r"\.xml(\.gz)?$")


def iso_utc(ts) -> Column:
    """ISO-8601 in UTC whatever the session zone; a whole second has no fraction.

    Built from the microseconds since 1970 on a timestamp without a zone, so no zone's clock changes
    get in the way.
    """
    ts = ts.cast("timestamp") if isinstance(ts, Column) else F.col(ts).cast("timestamp")
    micros = F.unix_micros(ts)
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    utc = epoch + F.make_dt_interval(secs=(micros / F.lit(1_000_000).cast("decimal(18,0)")).cast("decimal(18,6)"))
    text = F.replace(F.substring(utc.cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    part = F.pmod(micros, F.lit(1_000_000))
    fraction = F.when(part == 0, "").otherwise(F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0")))
    return F.concat(text, fraction, F.lit("+00:00"))


def candidate_score(text, words=None) -> Column:
    """Words plus a tenth per line, for at most 200 lines."""
    words = word_count(text) if words is None else words
    return words + F.least(line_count(text), F.lit(200)) * F.lit(0.1)


def long_enough(text, min_length=MIN_CONTENT_LENGTH) -> Column:
    return F.length(strip_ws(text)) >= min_length

from pyspark.sql import functions as F

from webcorpus.functions import text as T


def one(spark, column, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_language_of_first_segment(spark):
    urls = ["https://a/RU/x", "https://a/de/x", "https://a", "https://a/english/x", "https://a//en/x", "https://a/en;p"]
    assert one(spark, T.url_lang(F.col("x")), *urls) == ["ru", "uz", "uz", "uz", "en", "en"]
    assert one(spark, T.url_lang(F.col("x"), ("de",), "xx"), *urls[:2]) == ["xx", "de"]


def test_word_count_is_unicode(spark):
    assert one(spark, T.word_count("x"), "O‘zbekiston Oʻzb 5² é naïve_x", "", " .,") == [6, 0, 0]


def test_collapse_blank_lines(spark):
    assert one(spark, T.collapse_blank_lines("x"), "a\n\n\n\nb", "a\n\nb", "a\nb") == ["a\n\nb", "a\n\nb", "a\nb"]


def test_source_key(spark):
    assert one(spark, T.source_key("x"), "kun.uz", "a:80", "x-y", "ñ.é") == ["kun_uz", "a_80", "x-y", "ñ_é"]


def test_netloc_and_path(spark):
    urls = ["https://u@kun.uz:8080/ru", "//h/p", "no/host", "http://h?q=/x", "http://h#f/x"]
    assert one(spark, T.url_netloc("x"), *urls) == ["u@kun.uz:8080", "h", "", "h", "h"]
    assert one(spark, T.url_path("x"), *urls) == ["/ru", "/p", "no/host", "", ""]


def test_strip_equals_python(spark):
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    values = [c + "x" + c for c in chars]
    assert one(spark, T.strip_ws("x"), *values) == [v.strip() for v in values]
    assert one(spark, T.strip_ws("x"), " \xa0 a b　\n", "\t ") == ["a b", ""]


def test_long_enough(spark):
    rows = one(spark, T.long_enough(F.col("x")), " " + "a" * 99 + " ", "a" * 100, "\U0001f600" * 100)
    assert rows == [False, True, True]


def test_candidate_score(spark):
    three, many = "w w w w\nw w w\nw w w", "\n".join(["w"] * 10 + [""] * 490)
    assert one(spark, F.round(T.candidate_score("x"), 6), three, many) == [10.3, 30.0]


def test_iso_utc_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tashkent")
        ts = F.timestamp_micros(F.lit(1_700_000_000_000_000)), F.timestamp_micros(F.lit(1_700_000_000_000_120))
        row = spark.range(1).select(*[T.iso_utc(t) for t in ts]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert list(row) == ["2023-11-14T22:13:20+00:00", "2023-11-14T22:13:20.000120+00:00"]


def test_iso_utc_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    times = ["2024-03-10T02:30:00Z", "2024-11-03T06:30:00.5Z", "2024-11-03T05:30:00Z", "1969-12-31T23:59:59.25Z", "2024-03-10T07:00:00.000001Z"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = one(spark, T.iso_utc(F.col("x").cast("timestamp")), *times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [
        "2024-03-10T02:30:00+00:00", "2024-11-03T06:30:00.500000+00:00", "2024-11-03T05:30:00+00:00",
        "1969-12-31T23:59:59.250000+00:00", "2024-03-10T07:00:00.000001+00:00",
    ]

"""Golden tables of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticeflow.functions import identity, money, temporal, text, urls
from noticeflow.sources.http import robots_policy  # noqa: F401  importable without Spark


def column(spark, values, build, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r["y"] for r in df.withColumn("y", build(F.col("x"))).orderBy("i").collect()]


TITLES = [
    ("【入札公告】令和８年度　道路清掃業務委託　その１について", "道路清掃業務委託その1"),
    ("一般競争入札公告　庁舎警備", "庁舎警備"),
    ("入札公告 一般競争入札 橋梁点検の件", "橋梁点検"),
    ("R8年度 学校給食用食器", "学校給食用食器"),
    ("2026年度道路台帳（第2回）", "道路台帳第2回"),
    ("令和元年度システム改修", "システム改修"),
    ("公告", "公告"),
    ("について", "について"),
    ("・・機器ーー更新・", "機器ー更新"),
    ("令和8年度", "令和8年度"),
    ("  ", ""),
    (None, None),
]


def test_normalize_title(spark):
    assert column(spark, [t for t, _ in TITLES], text.normalize_title) == [w for _, w in TITLES]


def test_normalize_text_and_method(spark):
    assert column(spark, ["　ＡＢＣ\t\nｶﾅ  x ", None, ""], text.normalize_text) == ["ABC カナ x", None, ""]
    given = ["一般競争入札", "条件付一般競争入札", "公募型プロポーザル（一般競争）", "指名競争入札", "随契", "企画競争", "せり売り", None, ""]
    assert column(spark, given, text.classify_method) == ["open", "open", "proposal", "selective", "negotiated", "proposal", "unknown", "unknown", "unknown"]


def test_tags(spark):
    given = ["【入札結果】道路", "【一般競争】道路", "道路【中止】", "【】道路", None]
    assert column(spark, given, text.leading_tag) == ["入札結果", "一般競争", None, None, None]
    assert column(spark, given, text.is_result_announcement) == [True, False, False, False, False]
    assert column(spark, given, text.method_text) == [None, "一般競争", None, None, None]


def test_garbling_counts(spark):
    good, bad = "時原市の入札", "時原市".encode().decode("latin-1")
    assert column(spark, [good, bad, "São Paulo", None], text.looks_mojibake) == [False, True, False, False]
    assert column(spark, ["(cid:12)(cid:3)", "(cid:1)abc", "abc", "", None], text.cid_ratio) == [1.0, 0.25, 0.0, 0.0, 0.0]


DATES = [
    ("令和8年3月12日", dt.date(2026, 3, 12)), ("R8.3.12", dt.date(2026, 3, 12)), ("令和元年5月1日", dt.date(2019, 5, 1)), ("平成３０年４月１日", dt.date(2018, 4, 1)),
    ("昭和64年1月7日", dt.date(1989, 1, 7)), ("2026/3/1", dt.date(2026, 3, 1)), ("2026-03-01 締切", dt.date(2026, 3, 1)), ("平成35年1月1日", None), ("令和8年2月30日", None),
    ("令和0年1月1日", None), ("三月十二日", None), ("3月12日", None), ("", None), (None, None), ("R8.13.1", None),
    ("12026/3/1", dt.date(2026, 3, 1)), ("T15.12.24", dt.date(1926, 12, 24)), ("平成31年5月1日", None), ("2026.3.123", dt.date(2026, 3, 12)), ("令和 8 年 3 月 12 日", dt.date(2026, 3, 12)), ("R8.3.2026.4.1", dt.date(2026, 3, 20)), ("平成35年1月2026.4.1", None),
]


def test_dates(spark):
    assert column(spark, [t for t, _ in DATES], temporal.parse_date) == [w for _, w in DATES]


TIMES = [("午後5時", "17:00"), ("17:30", "17:30"), ("１７時００分", "17:00"), ("午前12時", "00:00"), ("午後12時30分", "12:30"), ("正午", "12:00"), ("25時", None), ("25時 10時", None), ("10:75", None), ("なし", None), (None, None), ("午後13時", None), ("午前13時", "13:00"), ("5時は正午に読む", "12:00"), ("", None)]


def test_times(spark):
    assert column(spark, [t for t, _ in TIMES], temporal.parse_time) == [w for _, w in TIMES]


def test_an_era_text_owns_the_digits_it_ends_in():
    assert [w.day for w in temporal.scan("R8.3.2026.4.1")] == [dt.date(2026, 3, 20)]
    assert [w.day for w in temporal.scan("R8.3.2026.4.12026/5/1、2026/6/1")] == [dt.date(2026, 3, 20), dt.date(2026, 6, 1)]
    assert list(temporal.scan("2026年3月12日 " * 3))[-1].end == 32


def test_deadline(spark):
    df = spark.createDataFrame([("令和8年3月27日 または 令和8年3月20日 午後5時",), ("令和8年3月20日",), ("未定",), (None,)], "x string")
    got = [tuple(r["y"]) for r in df.select(temporal.parse_deadline("x").alias("y")).collect()]
    assert got[0] == (dt.date(2026, 3, 20), "17:00", "explicit", "令和8年3月27日 または 令和8年3月20日 午後5時", True)
    assert got[1] == (dt.date(2026, 3, 20), None, "absent", "令和8年3月20日", False)
    assert got[2] == got[3] == (None,) * 5


def test_expiry_leans_apart(spark):
    df = spark.sql("select date'2026-09-20' d, cast(null as string) t, timestamp_ntz'2026-09-20 22:00:00' now")
    r = df.select(temporal.notify_at(F.col("d"), F.col("t")).alias("n"), temporal.expires_at(F.col("d"), F.col("t")).alias("e"), temporal.is_closed(F.col("d"), F.col("t"), F.col("now")).alias("c")).first()
    assert r["n"] == dt.datetime(2026, 9, 20, 9, 0) and r["e"] == dt.datetime(2026, 9, 20, 23, 59, 59) and r["c"] is False
    at = df.select(temporal.is_closed(F.col("d"), F.lit("22:00"), F.col("now")).alias("c")).first()["c"]
    assert at is False  # strictly after


def test_day_differences(spark):
    r = spark.sql("select timestamp_ntz'2026-09-07 10:00:00' a, timestamp_ntz'2026-09-07 12:00:00' b").select(
        temporal.elapsed_days(F.col("a"), F.col("b")).alias("e"), temporal.calendar_days(F.col("a"), F.col("b")).alias("c"), temporal.month_key(F.col("a")).alias("m"), temporal.month_bounds(F.col("a"))[1].alias("next")
    ).first()
    assert (r["e"], r["c"], r["m"], r["next"]) == (-1, 0, "2026-09", dt.datetime(2026, 10, 1))


PRICES = [
    ("1,234,567円", 1234567, False, "unknown"), ("１２３万円（税込）", 1230000, False, "included"), ("3,400千円", 3400000, False, "unknown"), ("2百万円 税抜", 2000000, False, "excluded"),
    ("1億2千万円", 100002000, False, "unknown"), ("1億2,345万6,789円", 123456789, False, "unknown"), ("500", 500, False, "unknown"), ("非公表", None, True, "unknown"), ("予定価格1,000円は非公表", None, True, "unknown"),
    ("-", None, False, "unknown"), ("なし", None, False, "unknown"), (None, None, False, "unknown"), ("税込・税抜", None, False, "unknown"), ("消費税を含む 100円", 100, False, "included"), ("消費税を除く 100円", 100, False, "excluded"),
    ("12345678901234567", None, False, "unknown"), ("500万1億", 100000000, False, "unknown"), ("非公表（税抜）", None, True, "excluded"), ("税込 未定", None, True, "included"), ("5億 3千 2億", 500003000, False, "unknown"), ("3円 2万", 20000, False, "unknown"), ("12345678901234567円 5円", 5, False, "unknown"),
    ("9999999999999999億円", 9999999999999999 * 10**8, False, "unknown"),
]


def test_prices(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PRICES)], "i int, x string")
    got = [r["y"] for r in df.withColumn("y", money.parse_price("x")).orderBy("i").collect()]
    for row, (raw, amount, hidden, basis) in zip(got, PRICES, strict=True):
        assert ((None if row["amount"] is None else int(row["amount"])), row["undisclosed"], row["tax_basis"]) == (amount, hidden, basis), raw
    assert df.withColumn("y", money.parse_price("x")).orderBy("i").select(money.as_bigint(F.col("y.amount")).alias("z")).collect()[-1]["z"] is None  # fits no table column


def test_price_text_is_bounded(spark):
    import time

    began = time.time()
    got = spark.createDataFrame([("1" + ",000" * 30000 + "円",), ("9" * 90000,)], "x string").withColumn("y", money.parse_price("x")).collect()
    assert [r["y"]["amount"] for r in got] == [None, None] and len(got[0]["y"]["raw"]) == 200
    assert time.time() - began < 20


def test_range_and_display(spark):
    df = spark.createDataFrame([(None, False), (100, False), (99, True)], "a bigint, u boolean")
    got = df.select(money.in_range(F.col("a"), F.lit(100), F.lit(None).cast("bigint")).alias("r"), money.display_price(F.col("a") * 12345, F.col("u")).alias("d")).collect()
    assert [tuple(r) for r in got] == [(True, "記載なし"), (True, "1,234,500円"), (False, "非公表")]


def test_keys(spark):
    import hashlib

    df = spark.sql("select 'org' o, '道路' t, date'2026-03-01' a, date'2026-04-01' b")
    k = identity.natural_key
    r = df.select(k(F.col("o"), F.col("t"), F.col("a"), F.col("b")).alias("k"), k(F.col("o"), F.lit(""), F.col("a"), F.col("b")).alias("none"), identity.is_weak(F.lit(None).cast("date"), F.lit(None).cast("date")).alias("w")).first()
    assert r["k"] == hashlib.sha256("1\0org\0道路\x002026-03-01".encode()).hexdigest() and r["none"] is None and r["w"]
    c = identity.cache_key
    same = df.select(c(F.lit("ＡＢ"), F.lit("x  y"), F.lit("p")).alias("a"), c(F.lit("AB"), F.lit("x y "), F.lit("p")).alias("b"), c(F.lit("ab"), F.lit("x y"), F.lit("p")).alias("c")).first()
    assert same["a"] == same["b"] != same["c"]


URLS = [
    ("https://www.city.example.jp/a", True), ("http://example.com:8080/", True), ("ftp://example.com/", False), ("https:///x", False), ("http://localhost/", False), ("http://a.localhost", False), ("http://db.internal/", False),
    ("http://127.0.0.1/", False), ("http://10.0.0.1/", False), ("http://169.254.169.254/latest", False), ("http://user@127.0.0.1/", False), ("http://[::1]/", False), ("http://[fd00::1]/", False), ("http://[::ffff:10.0.0.1]/", False), ("http://0.0.0.0/", False), ("", False), (None, False), ("javascript:alert(1)", False),
]


@pytest.mark.parametrize(("url", "ok"), URLS)
def test_safe_urls(url, ok):
    assert urls.safe(url) is ok


def test_extensions(spark):
    given = ["https://x.jp/a%20b/%E4%BB%95%E6%A7%98.PDF?v=1", "https://x.jp/a.b/c", "https://x.jp/f.jtd", "https://x.jp/a+b.tar.gz", "https://x.jp/", None]
    assert column(spark, given, urls.extension) == [".pdf", "", ".jtd", ".gz", "", None]
    assert column(spark, [".pdf", "", ".jtd", ".exe", None], urls.classify_before_fetch) == [None, None, "unsupported_format", "unsupported_format", None]
    assert column(spark, ["unsupported_scanned", "skipped", "ok", None], urls.needs_human) == [True, False, False, False]
    sizes = spark.createDataFrame([("26214401", 1), ("26214400", 1), (None, 26214401), ("x", 5), ("9" * 30, 5)], "d string, a bigint").select(urls.too_large(F.col("d"), F.col("a")).alias("y"))
    assert [r["y"] for r in sizes.collect()] == [True, False, True, False, True]
    robots = spark.createDataFrame([(200, "text/plain", "User-agent: *"), (404, None, ""), (200, "text/html", "x"), (200, "text/plain", " <!DOCTYPE html>"), (None, None, None)], "s int, t string, b string")
    assert [r["y"] for r in robots.select(urls.robots_source(F.col("s"), F.col("t"), F.col("b")).alias("y")).collect()] == ["parsed", "missing", "not_robots", "not_robots", "error"]

import datetime as dt

from pyspark.sql import functions as F

from noticeflow.functions import temporal
from noticeflow.operators import ingest, judge, match, reports
from test_match import PROFILE, profiles, tenders
from test_pipeline import NOW, days, log, raw

TODAY = dt.date(2026, 9, 7)


def test_health_lines(spark):
    from noticeflow.operators import health

    orgs = spark.createDataFrame([("o", True), ("p", False)], "id string, enabled boolean")
    got = {r["organization_id"]: r["line"] for r in reports.health_lines(health.evaluate(orgs, log(spark, days([20, 22, 19, 21]) + [("o", TODAY, "ok", 3)]), NOW)).collect()}
    assert "3件 < 平均20.5件 × 0.5" in got["o"] and "直近=3 平均=20.5 (n=4)" in got["o"] and got["o"].startswith("🔴") and "無効化" in got["p"]


def test_other_lines(spark):
    gone = spark.createDataFrame([("o", 4, "題" * 50)], "organization_id string, days_missing int, title string")
    assert reports.disappeared_lines(gone).first()["line"] == "🟡 o: 締切前に一覧から消えました (4日) " + "題" * 40
    funnel = spark.createDataFrame([("c", 3, 2, 1, 1, 0, 1.5, 2)], "company_id string, total bigint, stage_2 bigint, stage_3 bigint, billed bigint, cache_hits bigint, cost_jpy double, notified bigint")
    assert "累計コスト: 1.50 円" in reports.funnel_lines(funnel).first()["text"]
    claimed = spark.createDataFrame([("FR-101",), ("DQ-07",)], "id string")
    lines = spark.createDataFrame([("see FR-101, NFR-3",), (None,), ("DQ-070",)], "value string")
    assert [r["id"] for r in reports.untraced(claimed, lines).collect()] == ["DQ-07"]


def test_reasons(spark):
    rows = match.cascade(tenders(spark, ("庁舎警備",), ("基幹システム", 100), ("道路", None, "13"), ("業務開発",), ("道路",)), profiles(spark, PROFILE), False).orderBy("natural_key").collect()
    assert [r["reason"] for r in rows] == ["NGキーワード: 警備", "キーワード一致: システム; 金額レンジ外: 100", "対応エリア外: 13", "条件に該当せず; 案件名類似度 0.44（業務システム開発） / 仕様書テキストなし", "条件に該当せず; 案件名類似度 0.00 < 閾値 / 仕様書テキストなし"]


def test_derived_closing_is_no_revision(spark):
    typed = ingest.normalize(raw(spark, [{"captured_at": NOW}]))  # its deadline is long past
    closed = typed.withColumn("status", F.lit("closed")).withColumn("current_revision", F.lit(1))
    order = ["source_captured_at"]
    assert ingest.fold(closed, typed, order, seen_at="source_captured_at").first()["outcome"] == "unchanged"
    assert ingest.fold(closed, typed, order).first()["outcome"] == "updated"
    ahead = typed.withColumn("bid_deadline_date", F.lit(dt.date(2027, 1, 1)))
    assert ingest.fold(closed.withColumn("bid_deadline_date", F.lit(dt.date(2027, 1, 1))), ahead, order, seen_at="source_captured_at").first()["outcome"] == "updated"


def test_remote_and_display(spark):
    client = judge.remote(lambda prompt: ('ok {"score": "60", "reason": 1, "summary": "' + ("x" if "橋" in prompt else "") + '"}', 10, 5))
    assert client("橋", "仕様", "会社") == {"score": 60, "reason": "1", "summary": "x", "input_tokens": 10, "output_tokens": 5}
    df = spark.createDataFrame([("令和8年3月20日 正午、令和8年3月21日",)], "x string").withColumn("d", temporal.parse_deadline("x"))
    assert df.select(temporal.display_deadline_struct(F.col("d")).alias("y")).first()["y"] == "2026-03-20 12:00必着（複数日付あり・原文確認）"

"""The course from listing pages to messages over a store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticeflow import schemas
from noticeflow.plans import job
from noticeflow.sources.registry import Source
from noticeflow.sources.store import Store

NOW = dt.datetime(2026, 9, 7, 10, 0)
SOURCE = Source("s", "http", "city", "市", "https://city.example.jp/")


def pages(spark, *titles, css="news_list"):
    items = "".join(f'<li><a href="/b/{i}.html">{t}</a></li>' for i, t in enumerate(titles))
    body = f'<html><head><meta charset="utf-8"></head><body><ul class="{css}">{items}</ul></body></html>'
    return spark.createDataFrame([("p", "https://city.example.jp/", bytearray(body.encode()))], "page_id string, base_url string, content binary")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_course(spark, store):
    job.init(store, [SOURCE])
    job.init(store, [SOURCE])
    assert store.read("organization").count() == 1
    run = job.crawl(store, pages(spark, "【一般競争】情報システム開発業務", "庁舎警備業務", "道路清掃"), SOURCE, NOW)
    assert (run["status"], run["attempt"], run["fetched_count"], run["inserted_count"]) == ("ok", 1, 3, 3)
    later = NOW + dt.timedelta(hours=1)
    again = job.crawl(store, pages(spark, "【一般競争】情報システム開発業務", "庁舎警備業務", "道路清掃"), SOURCE, later)
    assert (again["attempt"], again["id"], again["inserted_count"], again["updated_count"]) == (2, 2, 0, 0)
    failed = job.crawl(store, pages(spark, "x", css="renewed"), SOURCE, later + dt.timedelta(hours=1))
    assert failed["status"] == "failed" and store.read("tender").count() == 3 and store.read_appended("tender_revision").count() == 3
    lines, code = job.report_health(store, later + dt.timedelta(hours=2))
    assert code == 1 and "failed" in lines.first()["line"]

    cols = schemas.TABLES["company_profile"].names
    profile = lambda **more: spark.createDataFrame([{"company_id": "co", "categories": ["システム開発"], "keywords": ["システム"], "ng_keywords": ["警備"], "llm_monthly_cap": 1} | more], "company_id string, categories array<string>, prefectures array<string>, qualifications array<string>, keywords array<string>, ng_keywords array<string>, price_min bigint, price_max bigint, llm_monthly_cap int")
    job.save_profiles(store, profile(keywords=["なし"]))
    job.save_profiles(store, profile())
    assert [(r["id"], r["name"], r["llm_monthly_cap"]) for r in store.read("company").collect()] == [("co", "co", 1)]
    assert [r["keywords"] for r in store.read("company_profile").select(*cols).collect()] == [["システム"]]

    assert sorted((r["stage"], r["should_notify"]) for r in job.decide(store, NOW).collect()) == [(1, False), (2, False), (2, True)]
    key = store.read("tender").where(F.col("title").contains("システム")).first()["natural_key"]
    stub = lambda title, spec, profile: {"score": 75, "reason": "r", "summary": "s", "input_tokens": 1000, "output_tokens": 200}
    attached = spark.createDataFrame([(key, "https://x.jp/a.txt", "ok", "仕様書" * 30)], "natural_key string, file_url string, extraction_status string, text string")
    store.append("attachment", attached, "a")
    judged = job.decide(store, NOW + dt.timedelta(minutes=1), stub).where("stage = 3").collect()
    assert [(r["score"], r["cache_hit"], r["cost_jpy"]) for r in judged] == [(75, False, (1000 * 450 + 200 * 2250) / 1e6)]
    again = job.decide(store, NOW + dt.timedelta(minutes=2), stub).where("stage = 3").collect()
    assert [(r["cache_hit"], r["cost_jpy"]) for r in again] == [(True, 0.0)] and store.read("llm_cache").first()["hit_count"] == 1
    message = job.messages(store, NOW).first()["message"]
    assert "情報システム開発業務" in message and "警備" not in message

"""Matching cascade, judge, digest and metrics."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from noticeflow.functions.text import match_form
from noticeflow.operators import digest, judge, match, metrics
from noticeflow.plans import reference
from noticeflow.schemas import TABLES
from noticeflow.sources.cases import read_cases

NOW = dt.datetime(2026, 9, 7, 10, 0)
PROFILE = ("co", ["業務システム開発", "ソフトウェア開発"], ["14"], [], ["システム", "ソフトウェア"], ["警備"], 1_000_000, 50_000_000)


def profiles(spark, *rows):
    return spark.createDataFrame(list(rows), match.PROFILE)


def tenders(spark, *rows):
    full = [(f"t{i}", *(list(r) + [None] * 4)[:4]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "natural_key string, title string, amount bigint, prefecture_code string, spec_text string")


def decide(spark, ts, ps, judge_too=False):
    got = match.cascade(tenders(spark, *ts), profiles(spark, *ps), judge_too).orderBy("natural_key", "company_id").collect()
    return [(r["stage"], r["score"], r["matched_by"], r["should_notify"]) for r in got]


def test_decision_table(spark):
    given = [
        ("庁舎警備システム",),  # excluded whatever else
        ("基幹システム改修", 100, None),  # price out of range, keyword stays
        ("道路舗装", 100, None),
        ("道路舗装", None, "13"),  # outside the area
        ("基幹システム改修", None, None),
        ("業務開発", None, "14"),  # by similarity
        ("道路舗装", None, "14"),
        ("ｿﾌﾄｳｪｱ調達", None, None),  # narrow kana
    ]
    assert decide(spark, given, [PROFILE]) == [(1, 0, "none", False), (1, 50, "rule", True), (1, 0, "none", False), (1, 0, "none", False), (2, 65, "rule", True), (2, 43, "vector", True), (2, 0, "vector", False), (2, 84, "rule", True)]


def test_empty_profile_promotes(spark):
    assert decide(spark, [("何でも",)], [("x", [], [], [], [], [], None, None)]) == [(2, 0, "vector", True)]
    assert decide(spark, [("何でも",)], [("x", None, None, None, None, None, None, None)]) == [(2, 0, "vector", True)]
    assert decide(spark, [], [PROFILE]) == []


def score(spark, a, b):
    t = spark.createDataFrame([("t", a)], "natural_key string, title string").withColumn("title_form", match_form(F.col("title")))
    p = match.profiles_with_forms(profiles(spark, ("c", [b], [], [], [], [], None, None)))
    row = match.stage_two(t, p).first()
    return round(row["score"], 3) if row else 0.0


@pytest.mark.parametrize(("a", "b", "want"), [("業務システム開発", "業務システム開発", 1.0), ("学校給食", "業務システム開発", 0.0), ("情報", "情報", 1.0), ("あ", "あ", 1.0), ("", "業務", 0.0), ("警備業務", "業務システム開発", 0.218)])
def test_similarity(spark, a, b, want):
    assert score(spark, a, b) == want


def test_first_of_equal_entries(spark):
    t = spark.createDataFrame([("t", "ab")], "natural_key string, title string").withColumn("title_form", F.col("title"))
    p = match.profiles_with_forms(profiles(spark, ("c", ["AB", "ab"], [], [], ["ａｂ"], [], None, None)))
    assert match.stage_two(t, p).first()["best_match"] == "AB"


def through_the_driver(df):
    """Joins that send a side through the driver, in the plan that ran."""
    df.collect()
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


def test_cascade_sends_no_tenders_through_the_driver(spark, data):
    # files are far smaller than the rows and pieces in them, so a planner takes them for small
    assert not through_the_driver(reference.QUERIES["r_cascade"](spark, data))


def test_funnel_sends_no_tenders_through_the_driver(spark, data):
    assert not through_the_driver(reference.QUERIES["r_funnel"](spark, data))


def test_similarity_sends_no_titles_through_the_driver(spark, data):
    assert not through_the_driver(reference.QUERIES["r_similarity"](spark, data))


def test_titles_that_read_the_same_keep_their_rows(spark):
    rows = [("a", "鋼管 更新"), ("b", "鋼管 更新"), ("c", "鋼管 更新"), ("c", "鋼管 更新"), ("d", "鋼管"), ("d", "更新"), ("e", None), (None, "鋼管 更新"), ("f", "清掃")]
    t = spark.createDataFrame(rows, "natural_key string, title string").withColumn("title_form", match_form(F.col("title")))
    p = match.profiles_with_forms(profiles(spark, ("x", ["鋼管更新"], [], [], [], [], None, None), ("y", ["更新"], [], [], ["道路"], [], None, None)))
    got = {(r["natural_key"], r["company_id"]): round(r["score"], 9) for r in match.stage_two(t, p).collect()}
    # rows of one key are one text, so d has the pieces of both of its titles
    assert got == {(k, c): v for k, by in {"a": (1.0, 0.577350269), "b": (1.0, 0.577350269), "c": (1.0, 0.577350269), "d": (0.816496581, 0.707106781)}.items() for c, v in zip("xy", by, strict=True)}


def test_keyword_is_never_lost(spark):
    rng = random.Random(9)
    words = ["システム", "道路", "警備", "改修", "ソフトウェア", "清掃"]
    ts = [("".join(rng.sample(words, 3)), rng.choice([None, 1, 10**7]), rng.choice([None, "13", "14"]), rng.choice([None, "仕様"])) for _ in range(80)]
    for with_judge in (False, True):
        decided = match.cascade(tenders(spark, *ts), profiles(spark, PROFILE), with_judge)
        verdicts = decided.where("to_judge").select("natural_key", "company_id", F.lit(0).alias("verdict_score"), F.lit(1).alias("input_tokens"), F.lit(1).alias("output_tokens"), F.lit(False).alias("cache_hit"), F.lit(1.0).alias("cost_jpy"))
        for r in match.apply_verdicts(decided, verdicts).collect():
            hit = any(k in r["title"] for k in PROFILE[4]) and "警備" not in r["title"]
            assert not hit or r["should_notify"], r
            assert "警備" not in r["title"] or not r["should_notify"], r
            assert not r["llm_overridden"] or r["should_notify"]


def test_too_many_profiles(spark):
    with pytest.raises(ValueError, match="profiles"):
        match.pair_up(tenders(spark, ("x",)), profiles(spark, *[(f"c{i}", [], [], [], [], [], None, None) for i in range(match.LARGEST_LIST + 1)]))


def test_plan_is_the_replay(spark):
    rng = random.Random(3)
    rows = [(i, company := f"c{rng.randrange(4)}", f"{company}-{rng.randrange(40)}") for i in range(400)]
    cached, used, caps = {"c0-1", "c1-2"}, {"c0": 5, "c2": 9}, {"c0": 10, "c1": 3, "c2": 9, "c3": 1000}
    want = judge.replay([(k, c) for _, c, k in rows], cached, used, caps)
    got = judge.plan_calls(
        spark.createDataFrame(rows, "seq int, company_id string, cache_key string"), spark.createDataFrame([(k,) for k in cached], "cache_key string"),
        spark.createDataFrame(list(used.items()), "company_id string, used int"), spark.createDataFrame(list(caps.items()), "company_id string, cap int"),
    ).orderBy("seq").collect()
    assert [r["action"] for r in got] == want and set(want) == {"hit", "call", "over"}


def test_judge_calls_once(spark):
    pairs = spark.createDataFrame([(f"t{i}", "c", i, "題", "仕様" if i < 3 else "別", "会社") for i in range(5)], "natural_key string, company_id string, seq int, title string, spec_text string, profile_text string")
    cache = spark.createDataFrame([], "cache_key string, response_json string, input_tokens bigint, output_tokens bigint, hit_count bigint")
    none = spark.createDataFrame([], "company_id string, used int")
    client = lambda t, s, p: {"score": 75, "reason": t, "summary": s, "input_tokens": int((len(t) + len(s) + len(p)) * 0.9), "output_tokens": 200}
    verdicts, after = judge.judge(pairs, cache, none, spark.createDataFrame([("c", 1)], "company_id string, cap int"), client)
    got = {r["natural_key"]: (r["verdict_score"], r["cache_hit"], r["cost_jpy"]) for r in verdicts.collect()}
    assert got == {"t0": (75, False, (4 * 450 + 200 * 2250) / 1e6), "t1": (75, True, 0.0), "t2": (75, True, 0.0)}
    assert [(r["hit_count"], json.loads(r["response_json"])["score"]) for r in after.collect()] == [(2, 75)]
    s = spark.range(1).select(judge.stub(F.lit("ab"), F.lit("cd"), F.lit("e"), 60).alias("s")).first()["s"]
    assert (s["score"], s["input_tokens"], s["output_tokens"]) == (60, 4, 200)
    assert judge.slice_json('x {"a": {"b": 1}} y') == {"a": {"b": 1}}
    with pytest.raises(ValueError, match="JSON"):
        judge.slice_json("nothing")


def results(spark, rows):
    base = {f.name: None for f in TABLES["match_result"]}
    return spark.createDataFrame([base | r for r in rows], TABLES["match_result"])


def test_budget_month_funnel_record(spark):
    rows = [dict(natural_key=f"t{i}", company_id="c", stage=3 if i < 3 else 2, cache_hit=i == 2, cost_jpy=1.5 if i < 2 else 0.0, should_notify=i % 2 == 0, evaluated_at=NOW if i else dt.datetime(2026, 8, 31, 23)) for i in range(5)]
    df = results(spark, rows)
    assert judge.billed_this_month(df, F.lit(NOW)).first()["used"] == 1
    f = match.funnel(df).first()
    assert (f["total"], f["stage_2"], f["stage_3"], f["billed"], f["cache_hits"], f["cost_jpy"], f["notified"], f["stage_3_ratio"]) == (5, 5, 3, 2, 1, 3.0, 3, 0.6)
    old = results(spark, [dict(natural_key="t0", company_id="c", score=10, feedback="good", evaluated_at=NOW)])
    new = results(spark, [dict(natural_key="t0", company_id="c", score=90, evaluated_at=NOW - dt.timedelta(days=1))])
    r = match.record(old, new, "evaluated_at").collect()
    assert [(x["score"], x["feedback"]) for x in r] == [(90, "good")]


def test_profile_text_and_load(spark):
    stored = spark.createDataFrame([("c", '["a","b"]', "[]", "[]", '["k"]', "[]", 1, None), ("gone", "[]", "[]", "[]", "[]", "[]", None, None)], "company_id string, categories string, prefectures string, qualifications string, keywords string, ng_keywords string, price_min bigint, price_max bigint")
    loaded = match.load_profiles(spark.createDataFrame([("c", 7)], "id string, llm_monthly_cap int"), stored)
    row = loaded.withColumn("t", match.profile_text()).collect()
    assert len(row) == 1 and row[0]["llm_monthly_cap"] == 7
    assert row[0]["t"] == "業種・営業品目: a、b\n対応エリア: 指定なし\n保有資格: 指定なし\n注目キーワード: k\n対応可能金額: 1〜None"


def test_digest(spark):
    org = spark.createDataFrame([("o", "市")], "id string, name string")
    t = [(f"k{i:02d}", "o", f"題{i}", "u", dt.date(2026, 9, 20), "17:00", 1000, False, "open") for i in range(15)]
    t += [("gone", "o", "x", "u", dt.date(2026, 9, 7), "09:00", None, True, "open"), ("cancelled", "o", "x", "u", None, None, None, False, "cancelled"), ("near", "o", "近", "u", dt.date(2026, 9, 8), None, None, True, "open"), ("low", "o", "x", "u", None, None, None, False, "open"), ("no", "o", "x", "u", None, None, None, False, "open"), ("never", "o", "無期限", "u", None, None, None, False, "open")]
    tenders_ = spark.createDataFrame(t, "natural_key string, organization_id string, title string, source_url string, bid_deadline_date date, bid_deadline_time string, estimated_price bigint, price_undisclosed boolean, status string")
    res = results(spark, [dict(natural_key=r[0], company_id="c", score=40 if r[0] == "low" else 70 + i % 5, should_notify=r[0] != "no", reason="理由") for i, r in enumerate(t)])
    top = digest.ranked(digest.candidates(res, tenders_, org, NOW))
    rows = top.orderBy("rank").collect()
    assert rows[0]["natural_key"] == "near" and len(rows) == 10 and (rows[0]["total_matched"], rows[0]["omitted_count"]) == (17, 7)
    assert [r["score"] for r in rows[1:4]] == [74, 74, 74] and rows[1]["natural_key"] == "k04"
    text = {r["company_id"]: r["message"] for r in digest.render(top, spark.createDataFrame([("c",), ("d",)], "company_id string"), NOW).collect()}
    assert "ほか 7 件" in text["c"] and "[関連度 7" in text["c"] and "非公表" in text["c"] and text["c"].endswith(digest.DISCLAIMER) and "ありませんでした" in text["d"]
    assert digest.below_min_score(res).first()["below_min_score_count"] == 1


def test_metrics(spark):
    cases = spark.createDataFrame([(i, i < 5) for i in range(10)], "case_id int, relevant boolean")
    told = spark.createDataFrame([(i, i in (0, 1, 2, 7), i in (0, 1, 2, 3, 7)) for i in range(8)], "case_id int, notified boolean, had_a_chance boolean")
    m = metrics.evaluate(cases, told).first()
    assert (m["true_positive"], m["false_positive"], m["true_negative"], m["false_negative"], m["recall"], m["precision"], m["reachability"], m["targets_met"]) == (3, 1, 4, 2, 0.6, 0.75, 0.8, False)
    assert sorted(r["case_id"] for r in metrics.misses(cases, told).collect()) == [3, 4]
    empty = metrics.evaluate(cases.limit(0), told).first()
    assert (empty["recall"], empty["precision"], empty["reachability"], empty["targets_met"]) == (1.0, 1.0, 1.0, True)
    assert metrics.report(metrics.evaluate(cases, told)).first()["line"].startswith("TP 3 FP 1")


def test_cases(spark, tmp_path):
    f = tmp_path / "cases.jsonl"
    f.write_text('// c\n\n{"case_id": "a", "relevant": true, "title": "t"}\n{"case_id": "b", "relevant": false}\n')
    assert sorted((r["case_id"], r["relevant"], r["note"]) for r in read_cases(spark, str(f)).collect()) == [("a", True, ""), ("b", False, "")]
    for bad in ('{"case_id": "a"}\n{"case_id": "a"}', '{"case_id": "a", "other": 1}', '{"case_id": '):
        f.write_text(bad)
        with pytest.raises(Exception):  # noqa: B017
            read_cases(spark, str(f)).collect()

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from noticeflow.llm import dedup

BASE = "鶴荻槙土木事務所本館火災報知設備構築業務委託"
SAME = [
    (BASE, "【入札公告】令和8年度 鶴荻槙土木事務所本館火災報知設備構築業務委託について"), (BASE, "鶴荻槙土木事務所本館火災報知設備の構築業務委託"), (BASE, "鶴荻槙土木事務所本館火災知設備構築業務委託"), (BASE, "鶴荻槙土木事務所本館火報災知設備構築業務委託"),
    (BASE, BASE + "一式"), (BASE, BASE + "再公告"), (BASE, "物品役務" + BASE), (BASE, "鶴荻槙土木事務所における本館火災報知設備構築業務委託"), (BASE, "鶴荻槙土木事務所本館火災報知設備構築業務"), (BASE, "鶴荻槙土木事務所本館火災報知設備構築委託業務"),
    (BASE, "火災報知設備構築業務委託・鶴荻槙土木事務所本館"), ("塚桜狐清掃工場北棟植栽修繕その1", "植栽修繕・塚桜狐清掃工場北棟その1"), ("空調設備修繕工事", "空調設備機器修繕工事"), ("崎霧桜消防署改修工事", "崎霧桜消防署改修工亊"), ("ﾄｲﾚ改修工事 南棟", "トイレ改修工事南棟"), ("星竹潮福祉センター更新工事その2", "星竹潮福祉センター更新工事業務その2"), ("笹鹿狐市民会館机及び椅子購入", "笹鹿狐市民会館机と椅子購入"),
]
OTHER = [(BASE, BASE + "その2"), (BASE, BASE.replace("本館", "別館")), (BASE, BASE.replace("本館", "")), (BASE, BASE.replace("構築", "管理")), ("道路管理業務委託", "道路監理業務委託"), (BASE + "その1", BASE + "その2"), (BASE + "第1期", BASE + "第1回"), (BASE + "A地区", BASE + "B地区"), (BASE, BASE.replace("鶴荻槙", "鶴荻星")), ("道路1", "道路")]


def named_alike(a, b):
    return any(dedup.same_wording(x, y) for x in dedup.wordings(a) for y in dedup.wordings(b))


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    assert named_alike(a, b) and named_alike(b, a)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other(a, b):
    assert not named_alike(a, b)


TURNED = [
    ("塚野鷹保育園監視カメラ設置工事", "監視カメラ設置工事塚野鷹保育園"), ("芦瀬波スポーツ公園東側PC端末購入", "東側PC端末購入芦瀬波スポーツ公園"), ("萩波椿土木事務所地下階トイレ監理業務委託", "【一般競争入札】地下階トイレ監理業務委託業務萩波椿土木事務所に係る公告"), ("萩波椿土木事務所トイレ監理業務委託", "トイレ監理業務萩波椿土木事務所"),
    ("霞泉栗小学校北棟昇降機借上げ", "北棟昇降機借上げ業務霞泉栗小学校"), ("磯泉鷺図書館地下階屋上防水調査業務委託第2回", "地下階屋上防水調査業務委託磯泉鷺図書館第2回"), ("丘藤森水族館受変電設備点検整備", "受変電設備点検整備丘藤森水族舘"), ("萩岡雪港湾事務所外壁調査業務委託", "外壁調査業務託萩岡雪港湾事務所"),
    ("星竹潮市民会館空調設備更新工事", "空調設備更新工事等・星竹潮市民会館"), ("机・椅子購入鶴荻槙小学校", "鶴荻槙小学校・机・椅子購入"), ("竹森原工事事務所道路台帳修繕工事", "道路台帳修繕工事竹森原工事事務所"),
]


@pytest.mark.parametrize(("a", "b"), TURNED)
def test_turned_without_one_middle_dot(a, b):
    assert named_alike(a, b) and named_alike(b, a)
    assert not named_alike(a + "その1", b + "その2")


@pytest.mark.parametrize("b", ["監視カメラ設置工事塚野星保育園", "監視カメラ撤去工事塚野鷹保育園", "北棟監視カメラ設置工事塚野鷹保育園", "監視カメラ設置工事塚野鷹保育園その2"])
def test_turned_but_other(b):
    assert not named_alike("塚野鷹保育園監視カメラ設置工事", b)


def test_turned_repeat_is_found(spark):
    day = dt.date(2026, 6, 13)
    old = prepared(spark, [(1, 0, "a", "o", "塚野鷹保育園監視カメラ設置工事", day, "w", "k", 0)], True)
    new = prepared(spark, [(2, 1, "b", "o", "監視カメラ設置工事塚野鷹保育園", day, "w", "k", 0), (3, 1, "c", "o", "監視カメラ撤去工事塚野鷹保育園", day, "w", "k", 0)], False)
    every = old.unionByName(new)
    entries = dedup.entries_of(every)
    assert [r["id"] for r in dedup.repeats(new, entries, dedup.first_keys(every), dedup.segment_index(entries)).collect()] == [2]


def test_wording_edges():
    assert dedup.wordings(None) == dedup.wordings("") == dedup.wordings("【】") == []
    assert len(dedup.wordings("・")) == 0 and len(dedup.wordings("甲・乙")) == 2


def test_no_pair_within_reach_escapes_the_index():
    rng = random.Random(2)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(6, 20)))
        b = list(a)
        for _ in range(rng.randrange(0, dedup.EDITS + 1)):
            i = rng.randrange(len(b) + 1)
            b[i : i + rng.randrange(2)] = rng.choice(["", "x", "a"])
        b = "".join(b)
        if len(b) >= dedup.SHORT:
            assert set(dedup.index_segments(a)) & set(dedup.probe_segments(b)), (a, b)


COLS = "row_id bigint, batch_no int, natural_key string, organization_id string, title string, announced_date date, wording string, key string, first int"


def rows(rng, n, start):
    stems = ["鶴荻槙庁舎本館火災報知設備構築業務委託", "里桜体育館南棟屋上防水改修工事", "野川小学校プール清掃業務委託"]

    def vary(s):
        i = rng.randrange(len(s))
        return rng.choice([s, s, s + "その2", s[:i] + s[i + 1 :], s[:i] + "の" + s[i:], s + "一式", None, "", s.replace("本館", "別館")])

    day = lambda: rng.choice([None, *[dt.date(2026, 5, 1) + dt.timedelta(days=rng.randrange(60)) for _ in range(5)]])
    return [(start + i, rng.choice([1, 2, 3]), rng.choice([None, f"k{rng.randrange(400)}"]), rng.choice(["o", "p", None]), vary(rng.choice(stems)), day(), "w", "k", 0) for i in range(n)]


def brute(batch, history):
    earlier = [(r, (-1, 0)) for r in history]
    out = set()
    for r in sorted(batch, key=lambda r: (r[1], r[0])):
        for s, _ in earlier:
            close = r[5] is None or s[5] is None or abs((r[5] - s[5]).days) <= 14
            if r[2] is not None and r[2] == s[2] or r[3] is not None and r[3] == s[3] and close and named_alike(r[4], s[4]):
                out.add(r[0])
        earlier.append((r, (r[1], r[0])))
    return out


def prepared(spark, given, history):
    df = spark.createDataFrame(given, COLS)
    order = F.struct(F.lit(-1).alias("batch"), F.lit(0).cast("bigint").alias("row")) if history else F.struct(F.col("batch_no").alias("batch"), F.col("row_id").alias("row"))
    return dedup.rows_of(df, "natural_key", "organization_id", F.col("title"), "announced_date", order, F.col("row_id"))


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_all(spark, tmp_path, seed):
    rng = random.Random(seed)
    history, batch = rows(rng, 40, 1000), rows(rng, 90, 1)
    old, new = prepared(spark, history, True), prepared(spark, batch, False)
    every = old.unionByName(new)
    entries = dedup.entries_of(every)
    got = {r["id"] for r in dedup.repeats(new, entries, dedup.first_keys(every), dedup.segment_index(entries)).collect()}
    assert got == brute(batch, history) and 10 < len(got) < 90
    index = dedup.AcceptedIndex(spark, str(tmp_path / "index"))
    index.append(old, "history")
    found = set()
    for no in (1, 2, 3):
        part = new.where(F.col("order.batch") == no)
        found |= {r["id"] for r in index.judge(part, f"batch-{no}").collect()}
        found |= {r["id"] for r in index.judge(part, f"batch-{no}").collect()}  # judged again, nothing changes
    assert found == got


def test_empty(spark):
    none = prepared(spark, [], False)
    entries = dedup.entries_of(none)
    assert dedup.repeats(none, entries, dedup.first_keys(none), dedup.segment_index(entries)).count() == 0


def test_the_history_is_not_moved(spark, tmp_path):
    rng = random.Random(5)
    index = dedup.AcceptedIndex(spark, str(tmp_path / "index"), buckets=3)
    index.append(prepared(spark, rows(rng, 40, 1000), True), "history")
    batch = prepared(spark, rows(rng, 20, 1), False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = index.judge(batch, "b")._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "noticeflow_accepted" in line]
    assert len(scans) == 3 and all("Bucketed: true" in plan[i] for i in scans)
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i in scans:
        depth, above = indent(plan[i]), []
        for line in reversed(plan[:i]):  # what encloses the scan, from inside out
            if indent(line) < depth:
                depth = indent(line)
                above.append(line)
        upto = next(k for k, line in enumerate(above) if "Join" in line)
        assert not any("Exchange" in line for line in above[:upto])


def test_what_is_left_without_one():
    rng = random.Random(9)
    for _ in range(3000):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(6, 12)))
        i = rng.randrange(len(a) - 1)
        b = rng.choice([a, a[:i] + a[i + 1 :], a[:i] + "x" + a[i:], a[:i] + a[i + 1] + a[i] + a[i + 2 :]])
        assert set(dedup.without_one(a)) & set(dedup.without_one(b))
        assert len(dedup.without_one(a)) == len({a, *(a[:p] + a[p + 1 :] for p in range(len(a)))})
    assert len(dedup.without_one("")) == 1 and len(dedup.without_one("あ" * 100_000)) == 2


@pytest.mark.parametrize("hot", [0, 1, 5])
def test_hot_segments_lose_nothing(spark, monkeypatch, hot):
    rng = random.Random(4)
    history, batch = rows(rng, 40, 1000), rows(rng, 60, 1)
    old, new = prepared(spark, history, True), prepared(spark, batch, False)
    every = old.unionByName(new)
    entries = dedup.entries_of(every)
    monkeypatch.setattr(dedup, "HOT", hot)
    got = {r["id"] for r in dedup.repeats(new, entries, dedup.first_keys(every), dedup.segment_index(entries)).collect()}
    assert got == brute(batch, history)


def test_one_organization_of_many_wordings(spark):
    import time

    number = "conv(id * 7919 % 1000003, 10, 36)"
    made = spark.range(100_000).selectExpr("'o' as `group`", f"concat({number}, '号庁舎清掃業務委託') as wording").distinct()
    began = time.time()
    got = dedup.similar(made, dedup.segment_index(made)).where("wording <> other")
    assert got.where("levenshtein(wording, other) > 2").count() == 0
    assert time.time() - began < 200  # all pairs of the common segments would be ten thousand millions

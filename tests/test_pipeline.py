"""Ingest, run log, lifecycle, health, store and stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from noticeflow import schemas, storage
from noticeflow.operators import data_health, health, ingest, lifecycle, runs
from noticeflow.sources.store import Store
from noticeflow.streaming.ingest import ingest_stream, volume_by_day

NOW = dt.datetime(2026, 9, 7, 10, 0)


def raw(spark, rows):
    base = {f.name: None for f in schemas.TABLES["raw_tender"]} | {"organization_id": "city-test", "source_url": "https://x.jp/1", "captured_at": NOW, "title": "○○業務委託", "method_text": "一般競争入札", "announced_text": "令和8年3月1日", "bid_deadline_text": "令和8年3月20日 午後5時", "price_text": "1,234,567円", "attachment_urls": [], "raw_payload": {}}
    return spark.createDataFrame([base | r for r in rows], schemas.TABLES["raw_tender"])


def test_normalize(spark):
    typed, rejected = ingest.quarantine(ingest.normalize(raw(spark, [{}, {"title": "　"}, {"title": "【入札公告】○○業務委託について", "price_text": "非公表", "bid_deadline_text": "令和8年3月20日", "raw_payload": {"is_result_announcement": "true"}}])))
    rows = typed.orderBy("title").collect()
    assert rejected.count() == 1 and len(rows) == 2 and rows[0]["natural_key"] == rows[1]["natural_key"]
    plain, variant = rows
    assert (plain["bid_deadline_time"], plain["estimated_price"], plain["method"], plain["status"]) == ("17:00", 1234567, "open", "open")
    assert (variant["bid_deadline_time"], variant["estimated_price"], variant["price_undisclosed"], variant["status"]) == (None, None, True, "closed")
    assert set(typed.columns) <= set(schemas.TABLES["tender"].names)


STATE = "natural_key string, seq int, status string, title string, bid_deadline_date date, url string"
FEW = ("status", "title", "bid_deadline_date")


def loop(stored, observed):
    state, out = dict(stored), []
    for key, seq, status, title, day, _ in sorted(observed, key=lambda r: (r[0], r[1])):
        new = (status, title, day)
        if key not in state:
            state[key] = (new, 1)
            out.append((key, seq, "inserted", 1))
        elif state[key][0] != new:
            state[key] = (new, state[key][1] + 1)
            out.append((key, seq, "updated", state[key][1]))
        else:
            out.append((key, seq, "unchanged", state[key][1]))
    return out, {k: v[1] for k, v in state.items()}


def test_fold_is_the_loop(spark):
    rng = random.Random(4)
    pick = lambda: (rng.choice(["open", "closed", None]), rng.choice(["a", "b", None]), rng.choice([None, dt.date(2026, 1, 1)]))
    observed = [(f"k{rng.randrange(60)}", i, *pick(), rng.choice("xy")) for i in range(1500)]
    stored = {f"k{i}": (pick(), rng.randrange(1, 5)) for i in range(0, 70, 3)}
    current = spark.createDataFrame([(k, s[0], s[1], s[2], n, "u") for k, (s, n) in stored.items()], "natural_key string, status string, title string, bid_deadline_date date, current_revision int, url string")
    df = spark.createDataFrame(observed, STATE)
    got = ingest.fold(current, df, ["seq"], FEW).select("natural_key", "seq", "outcome", "revision").orderBy("natural_key", "seq").collect()
    want, final = loop(stored, observed)
    assert [tuple(r) for r in got] == want
    # batch by batch gives the same
    first, second = df.where("seq < 700"), df.where("seq >= 700")
    a = ingest.fold(current, first, ["seq"], FEW)
    mid = a.groupBy("natural_key").agg(F.max_by(F.struct("status", "title", "bid_deadline_date", "url"), F.struct((F.col("outcome") != "unchanged").cast("int"), F.col("seq"))).alias("s"), F.max("revision").alias("current_revision")).select("natural_key", "s.*", "current_revision")
    rest = current.join(mid.select("natural_key"), "natural_key", "left_anti")
    b = ingest.fold(mid.unionByName(rest.select(*mid.columns)), second, ["seq"], FEW)
    both = a.select("natural_key", "seq", "outcome").unionByName(b.select("natural_key", "seq", "outcome")).orderBy("natural_key", "seq").collect()
    assert [tuple(r) for r in both] == [w[:3] for w in want]


def test_revision_diff_and_idempotence(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    first = ingest.normalize(raw(spark, [{}]))
    order = ["source_captured_at"]

    def take(typed):
        folded = ingest.fold(store.read("tender"), typed, order).cache()
        rows = folded.collect()
        store.replace("tender", ingest.merge(store.read("tender"), folded, order, "source_captured_at"))
        return rows

    assert [r["outcome"] for r in take(first)] == ["inserted"]
    assert [r["outcome"] for r in take(first)] == ["unchanged"]
    moved = take(ingest.normalize(raw(spark, [{"bid_deadline_text": "令和8年3月27日 午後5時", "captured_at": NOW + dt.timedelta(days=1), "source_url": "https://x.jp/2"}])))[0]
    assert (moved["outcome"], moved["revision"], moved["change_kind"], moved["deadline_changed"]) == ("updated", 2, "corrected", True)
    assert moved["diff"] == {"bid_deadline_date": ["2026-03-20", "2026-03-27"]}
    row = store.read("tender").first()
    assert (row["current_revision"], row["first_seen_at"], row["last_seen_at"], row["source_url"]) == (2, NOW, NOW + dt.timedelta(days=1), "https://x.jp/2")
    # what is not watched is dropped, only last_seen_at moves
    take(ingest.normalize(raw(spark, [{"bid_deadline_text": "令和8年3月27日 午後5時", "captured_at": NOW + dt.timedelta(days=2), "source_url": "https://x.jp/3"}])))
    row = store.read("tender").first()
    assert (row["current_revision"], row["last_seen_at"], row["source_url"]) == (2, NOW + dt.timedelta(days=2), "https://x.jp/2")


def test_store_rejects(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.read("organization").count() == 0
    with pytest.raises(ValueError, match="no column"):
        store.replace("organization", spark.createDataFrame([("a", 1)], "id string, other int"))
    with pytest.raises(Exception, match="crawler_kind"):
        store.replace("organization", spark.createDataFrame([("a", "ftp")], "id string, crawler_kind string"))
    assert store.version("organization") == -1
    store.replace("organization", spark.createDataFrame([("a", "http"), ("a", "http")], "id string, crawler_kind string"))
    assert {(r["constraint"], r["n"]) for r in schemas.violations(store.read("organization"), "organization").collect()} == {("crawler_kind", 0), ("unique", 1)}


def test_a_crash_leaves_a_version_in_force(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", "http")], "id string, crawler_kind string")
    store.replace("organization", rows)

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr("noticeflow.sources.store.mark_done", die)
    with pytest.raises(RuntimeError, match="lost"):
        store.replace("organization", rows.limit(0))
    assert store.version("organization") == 0 and store.read("organization").count() == 1
    monkeypatch.undo()
    assert store.replace("organization", rows.unionAll(rows)) == 1 and store.read("organization").count() == 2
    with pytest.raises(Exception, match="exists"):
        storage.mark_done(spark, str(tmp_path / "organization"), 1)  # another writer's version


def test_cancelled_stays_cancelled(spark):
    cols = "natural_key string, seq int, status string, title string"
    df = spark.createDataFrame([("k", 1, "open", "a"), ("k", 2, "cancelled", "a"), ("k", 3, "cancelled", "b"), ("k", 4, "open", "b")], cols)
    got = ingest.fold(df.limit(0).withColumn("current_revision", F.lit(0)), df, ["seq"], ("status", "title")).orderBy("seq").collect()
    assert [r["change_kind"] for r in got] == ["new", "cancelled", "cancelled", "corrected"]


def log(spark, rows):
    full = []
    for i, (org, day, status, count, *more) in enumerate(rows):
        at = dt.datetime.combine(day, dt.time(9))
        full.append((i + 1, org, day, more[0] if more else 1, at, at + dt.timedelta(minutes=5), status, count, 0, 0, None, None))
    return spark.createDataFrame(full, schemas.TABLES["crawl_run"])


def days(counts, last=dt.date(2026, 9, 6), status="ok", org="o"):
    return [(org, last - dt.timedelta(days=i), status, n) for i, n in enumerate(counts)]


TODAY = dt.date(2026, 9, 7)
HEALTH = [
    (days([20, 22, 19, 21]) + [("o", TODAY, "ok_empty", 0)], "empty"),
    (days([20, 22, 19, 21]) + [("o", TODAY, "ok", 3)], "volume_drop"),
    (days([20, 22, 19, 21]) + [("o", TODAY, "ok", 14)], "healthy"),
    (days([20, 22, 19, 21]) + [("o", TODAY, "partial", 14)], "healthy"),
    (days([20] * 4, dt.date(2026, 8, 1)), "stale"),
    ([], "never_run"),
    ([("o", TODAY, "running", 0)], "never_run"),
    (days([20]) + [("o", TODAY, "ok", 1)], "warming_up"),
    (days([20, 20, 20], dt.date(2026, 9, 3)) + days([0, 0, 0], status="ok_empty") + [("o", TODAY, "ok", 2)], "volume_drop"),
    (days([20, 22, 19, 21]) + [("o", TODAY, "failed", 0)], "failed"),
    (days([20, 22, 19, 21]) + [("o", TODAY, "disabled", 0)], "disabled"),
]


@pytest.mark.parametrize(("rows", "state"), HEALTH)
def test_health_states(spark, rows, state):
    orgs = spark.createDataFrame([("o", True)], "id string, enabled boolean")
    got = health.evaluate(orgs, log(spark, rows), NOW).collect()
    assert [r["state"] for r in got] == [state]
    if state == "volume_drop" and len(rows) == 7:
        assert got[0]["baseline_avg"] == 20.0


def test_health_order_and_code(spark):
    orgs = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "id string, enabled boolean")
    rep = health.evaluate(orgs, log(spark, [(o, d, s, n) for o in "a" for _, d, s, n in days([20, 20, 20, 20], TODAY)]), NOW)
    assert [r["organization_id"] for r in health.ordered(rep).collect()] == ["b", "c", "a"]
    assert health.exit_code(rep) == 1 and health.exit_code(rep.where("state = 'healthy'")) == 0 and health.exit_code(rep.limit(0)) == 1


def test_run_log(spark, tmp_path):
    df = log(spark, [("o", TODAY, "ok", 5), ("o", TODAY, "running", 0, 2), ("p", TODAY, "failed", 0), ("q", TODAY, "partial", 3)])
    assert {r["organization_id"]: r["next_attempt"] for r in runs.next_attempt(df).collect()} == {"o": 3, "p": 2, "q": 2}
    wanted = spark.createDataFrame([(o, TODAY) for o in "opqr"], "organization_id string, target_date date")
    assert {r["organization_id"]: r["needs_rerun"] for r in runs.needs_rerun(wanted, df).collect()} == {"o": False, "p": True, "q": True, "r": True}
    clock = iter(NOW + dt.timedelta(minutes=i) for i in range(99)).__next__
    path = str(tmp_path / "log")
    with runs.RunSession(spark, path, 1, "o", TODAY, 1, clock) as s:
        s.count(fetched=3)
    with runs.RunSession(spark, path, 2, "o", TODAY, 2, clock):
        pass
    with pytest.raises(KeyError), runs.RunSession(spark, path, 3, "o", TODAY, 3, clock) as s:
        s.count(fetched=2)
        raise KeyError("x")
    with runs.RunSession(spark, path, 4, "o", TODAY, 4, clock) as s:
        s.partial()
        s.disabled()  # the first finish wins
    got = {r["id"]: (r["status"], r["fetched_count"], r["error_kind"]) for r in runs.log_state(spark.read.parquet(path)).collect()}
    assert got == {1: ("ok", 3, None), 2: ("ok_empty", 0, None), 3: ("failed", 2, "KeyError"), 4: ("partial", 0, None)}


def test_lifecycle(spark):
    rows = [
        ("past", "open", dt.date(2026, 9, 6), None, NOW - dt.timedelta(days=5)),
        ("today", "open", dt.date(2026, 9, 7), None, NOW - dt.timedelta(days=3)),
        ("none", "open", None, None, NOW - dt.timedelta(days=2, hours=23)),
        ("cancelled", "cancelled", dt.date(2026, 9, 1), "10:00", NOW),
        ("at", "open", dt.date(2026, 9, 7), "10:00", NOW - dt.timedelta(days=9)),
    ]
    df = spark.createDataFrame(rows, "natural_key string, status string, bid_deadline_date date, bid_deadline_time string, last_seen_at timestamp_ntz")
    assert {r["natural_key"]: r["status"] for r in lifecycle.close_expired(df, NOW).collect()} == {"past": "closed", "today": "open", "none": "open", "cancelled": "cancelled", "at": "open"}
    assert [(r["natural_key"], r["days_missing"]) for r in lifecycle.disappeared(df, NOW).collect()] == [("at", 9), ("today", 3)]


def test_data_health(spark):
    cols = "organization_id string, title string, bid_deadline_date date, natural_key_anchor string, estimated_price bigint"
    before = data_health.by_source(spark.createDataFrame([("o", "abcd", TODAY, "announced", 1000)] * 4, cols))
    after = data_health.by_source(spark.createDataFrame([("o", "abcd", None, "none", 1000)] * 4, cols))
    assert after.first()["weak_alert"] and not before.first()["weak_alert"]
    assert set(data_health.shifts(before, after).first()["moved"]) == {"no_deadline", "weak_keys"}


def test_stream(spark, tmp_path):
    src, store = tmp_path / "raw", Store(spark, str(tmp_path / "store"))
    raw(spark, [{}, {"title": "　", "source_url": "https://x.jp/untitled"}]).write.parquet(str(src / "a"))
    stream = lambda: spark.readStream.schema(schemas.TABLES["raw_tender"]).option("recursiveFileLookup", "true").parquet(str(src))
    ingest_stream(stream(), store, str(tmp_path / "cp")).awaitTermination()
    raw(spark, [{"price_text": "2,000,000円", "captured_at": NOW + dt.timedelta(days=1)}]).write.parquet(str(src / "b"))
    ingest_stream(stream(), store, str(tmp_path / "cp")).awaitTermination()
    assert store.read("tender").first()["current_revision"] == 2
    assert [(r["natural_key"], r["title"]) for r in store.read_appended("tender_rejected").collect()] == [(None, "　")]
    assert sorted(r["revision"] for r in store.read_appended("tender_revision").collect()) == [1, 2]
    log(spark, days([5, 7])).write.parquet(str(tmp_path / "runs"))
    q = volume_by_day(spark.readStream.schema(schemas.TABLES["crawl_run"]).parquet(str(tmp_path / "runs"))).writeStream.outputMode("update").format("memory").queryName("volumes").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(fetched) s from volumes").first()["s"] == 12

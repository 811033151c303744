"""Health of every source in one plan over the run log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.functions.temporal import elapsed_days
from noticeflow.schemas import NO_ALERT

#: What is said of a state that has no figures of its own.
PLAIN = {"never_run": "実行の記録がありません", "empty": "取得は成功しましたが0件でした。一覧の構造を確認してください", "disabled": "最後の実行は無効化のため見送られました"}
SWITCHED_OFF, PARTLY, FINE = "この機関は無効化されています", "一部のページを読めませんでしたが件数はふだん並みです", "問題なし"

WINDOW_DAYS, DROP_RATIO, STALE_DAYS, LEAST_SAMPLES = 30, 0.5, 3, 3


def evaluate(organizations: DataFrame, runs: DataFrame, now: dt.datetime, window_days: int = WINDOW_DAYS, drop_ratio: float = DROP_RATIO, stale_days: int = STALE_DAYS) -> DataFrame:
    """One row per organization: state, is_alert, last run, last success and baseline.

    The log is reduced to one row per organization in a single aggregation that
    combines before the shuffle: the latest completed run, the latest success,
    and sum and count of the window's ok runs. The latest run is taken out of the
    baseline by arithmetic, so no second pass or join of the log is needed.
    """
    moment = F.lit(now).cast("timestamp_ntz")
    since = F.lit((now - dt.timedelta(days=window_days)).date())
    done = F.col("status") != "running"
    ok = F.col("status") == "ok"
    inside = ok & (F.col("target_date") >= since)
    fields = F.struct("started_at", "id", "status", "fetched_count", "target_date", "error_kind")
    by = runs.groupBy(F.col("organization_id").alias("id")).agg(
        F.max(F.when(done, fields)).alias("last"),
        F.max(F.when(ok, F.struct("started_at", "id", F.coalesce("finished_at", "started_at").alias("at")))).alias("good"),
        F.sum(F.when(inside, F.col("fetched_count"))).alias("total"),
        F.count_if(inside).alias("n"),
    )
    joined = organizations.select("id", "enabled").join(by, "id", "left")
    own = F.coalesce((F.col("last.status") == "ok") & (F.col("last.target_date") >= since), F.lit(False))
    samples = F.coalesce(F.col("n"), F.lit(0)) - own.cast("int")
    total = F.coalesce(F.col("total"), F.lit(0)) - F.when(own, F.coalesce(F.col("last.fetched_count"), F.lit(0))).otherwise(F.lit(0))
    got = joined.withColumns({"samples": samples.cast("bigint"), "baseline_avg": F.when(samples > 0, total / samples)})
    status, at = F.col("last.status"), F.col("good.at")
    stale = at.isNotNull() & ((F.unix_micros(moment.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) > stale_days * 86_400_000_000)
    state = (
        F.when(~F.col("enabled"), "disabled")
        .when(F.col("last").isNull(), "never_run")
        .when(status == "failed", "failed")
        .when(status == "ok_empty", "empty")
        .when(status == "disabled", "disabled")
        .when(stale, "stale")
        .when(F.col("samples") < LEAST_SAMPLES, "warming_up")
        .when(F.col("last.fetched_count") < F.col("baseline_avg") * drop_ratio, "volume_drop")
        .otherwise("healthy")
    )
    told = F.col("enabled") & ~F.coalesce(status.isin("failed", "ok_empty", "disabled"), F.lit(False)) & ~F.coalesce(stale, F.lit(False)) & F.col("last").isNotNull()
    told_of = {
        "failed": F.concat(F.lit("最後の実行が失敗で終わりました（"), F.coalesce("last.error_kind", F.lit("原因不明")), F.lit("）")),
        "stale": F.format_string("最後の成功から%d日たっています", elapsed_days(moment, at)),
        "warming_up": F.format_string("比較できる実行がまだ%d件です", "samples"),
        "volume_drop": F.format_string(f"件数の落ち込み: %d件 < 平均%.1f件 × {drop_ratio}", "last.fetched_count", "baseline_avg"),
    }
    told_of |= {name: F.lit(text) for name, text in PLAIN.items()}
    reason = F.when(~F.col("enabled"), SWITCHED_OFF)
    for name, text in told_of.items():
        reason = reason.when(state == name, text)
    reason = reason.otherwise(F.when(status == "partial", PARTLY).otherwise(FINE))
    return got.select(
        F.col("id").alias("organization_id"), state.alias("state"), (~state.isin(*NO_ALERT)).alias("is_alert"), reason.alias("reason"),
        status.alias("last_status"), F.col("last.started_at").alias("last_run_at"), at.alias("last_success_at"),
        F.col("last.fetched_count").alias("latest_count"),
        F.when(told, F.col("baseline_avg")).alias("baseline_avg"), F.when(told, F.col("samples")).otherwise(F.lit(0)).cast("bigint").alias("baseline_samples"),
        elapsed_days(moment, at).alias("days_since_success"),
    )


def ordered(report: DataFrame) -> DataFrame:
    """Alerts first, then by organization."""
    return report.orderBy(~F.col("is_alert"), "organization_id")


def exit_code(report: DataFrame) -> int:
    """1 without organizations or with any alert, else 0."""
    row = report.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_alert")).alias("alerts")).first()
    return int(not row["n"] or row["alerts"] > 0)

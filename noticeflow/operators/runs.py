"""The run log."""

from __future__ import annotations

import datetime as dt
from types import TracebackType

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeflow.schemas import TABLES

RERUN = ("failed", "ok_empty", "partial")


def next_attempt(runs: DataFrame) -> DataFrame:
    """(organization_id, target_date, next_attempt); an absent pair starts at 1."""
    return runs.groupBy("organization_id", "target_date").agg((F.coalesce(F.max("attempt"), F.lit(0)) + 1).alias("next_attempt"))


def resolve_status(failed: Column, explicit: Column, fetched: Column) -> Column:
    """An exception is failed; a status set explicitly holds; else rows or no rows tell ok from ok_empty."""
    return F.when(failed, "failed").when(explicit.isin("disabled", "partial"), explicit).when(fetched > 0, "ok").otherwise("ok_empty")


def last_completed(runs: DataFrame) -> DataFrame:
    """The highest attempt that is not running, per organization and date; combined before the shuffle."""
    rest = [c for c in runs.columns if c not in ("organization_id", "target_date")]
    best = F.max_by(F.struct(*rest), F.struct(F.col("attempt"), F.col("id")))
    return runs.where("status <> 'running'").groupBy("organization_id", "target_date").agg(best.alias("r")).select("organization_id", "target_date", "r.*")


def needs_rerun(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """(organization_id, target_date, needs_rerun) of the wanted pairs: without a completed run, or with one worth repeating."""
    last = last_completed(runs).select("organization_id", "target_date", "status")
    again = F.coalesce(F.col("status").isin(*RERUN), F.lit(True))
    return wanted.join(last, ["organization_id", "target_date"], "left").select("organization_id", "target_date", again.alias("needs_rerun"))


def latest_per(runs: DataFrame, by: str, order: list[Column]) -> DataFrame:
    return runs.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where("_n = 1").drop("_n")


class RunSession:
    """One run as a context: opens as running, closes with its status whatever happens.

    Writes two single-row files to the log; ``log_state`` keeps the finished row
    of each id. The first finish wins; an exception is recorded and raised again.
    """

    def __init__(self, spark: SparkSession, log: str, run_id: int, organization_id: str, target_date: dt.date, attempt: int, clock):
        self.spark, self.log, self.clock = spark, log, clock
        self.row = {"id": run_id, "organization_id": organization_id, "target_date": target_date, "attempt": attempt, "started_at": None, "finished_at": None, "status": "running", "fetched_count": 0, "inserted_count": 0, "updated_count": 0, "error_kind": None, "error_message": None}
        self.finished = False

    def _write(self) -> None:
        self.spark.createDataFrame([self.row], TABLES["crawl_run"]).coalesce(1).write.mode("append").parquet(self.log)

    def __enter__(self) -> RunSession:
        self.row["started_at"] = self.clock()
        self._write()
        return self

    def count(self, fetched: int = 0, inserted: int = 0, updated: int = 0) -> None:
        for k, n in (("fetched_count", fetched), ("inserted_count", inserted), ("updated_count", updated)):
            self.row[k] += n

    def finish(self, status: str | None = None, error: BaseException | None = None) -> None:
        if self.finished:
            return
        self.finished = True
        if error is not None:
            self.row |= {"status": "failed", "error_kind": type(error).__name__, "error_message": str(error)}
        else:
            self.row["status"] = status or ("ok" if self.row["fetched_count"] > 0 else "ok_empty")
        self.row["finished_at"] = self.clock()
        self._write()

    def partial(self) -> None:
        self.finish("partial")

    def disabled(self) -> None:
        self.finish("disabled")

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> bool:
        self.finish(error=error)
        return False


def log_state(log: DataFrame) -> DataFrame:
    """One row per run id: the finished one where there is one."""
    rest = [c for c in log.columns if c != "id"]
    return log.groupBy("id").agg(F.max_by(F.struct(*rest), F.col("status") != "running").alias("r")).select("id", "r.*").select(*log.columns)

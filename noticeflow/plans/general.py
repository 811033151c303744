"""Queries of the general data-processing problems (1, 2, 6, 7) and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.functions import money
from noticeflow.operators import snapshot_diff, spikes, trailing, units
from noticeflow.storage import read, shared_folder

WATCHED = ("status", "bid_deadline_date", "bid_deadline_time", "application_deadline_date")


def _changes(rows: DataFrame) -> DataFrame:
    """Every snapshot through the bucketed index; it lies in the shared folder and is gone when the changes are found."""
    spark = rows.sparkSession
    at = f"{shared_folder(spark)}/snapshot-index-{uuid.uuid4().hex}"
    index = snapshot_diff.SnapshotIndex(spark, at, "natural_key", WATCHED, "delivered_at", buckets=snapshot_diff.buckets_for(rows))
    return index.replay(rows, "snapshot_date")


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "tender_snapshot").select("snapshot_date", "natural_key", "delivered_at", *WATCHED)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Added, removed and changed notices of every snapshot against the one before."""
    changes = _changes(_snapshots(spark, d))
    return changes.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), F.col("key").alias("natural_key"), "change_kind")


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """Old and new watched values of the changed notices only."""
    rows = _snapshots(spark, d)
    got = snapshot_diff.changed_values(rows, _changes(rows), "natural_key", "snapshot_date", "delivered_at", WATCHED)
    return got.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")).withColumnRenamed("key", "natural_key")


_P1_ROWS = """
WITH r AS (SELECT snapshot_date, natural_key, status, bid_deadline_date, bid_deadline_time, application_deadline_date,
                  row_number() OVER (PARTITION BY snapshot_date, natural_key ORDER BY delivered_at DESC NULLS LAST) AS n
           FROM tender_snapshot WHERE snapshot_date IS NOT NULL AND natural_key IS NOT NULL),
     s AS (SELECT * FROM r WHERE n = 1),
     g AS (SELECT snapshot_date AS g, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS before
           FROM (SELECT DISTINCT snapshot_date FROM s))
"""

P1_FOUND_SQL = (
    _P1_ROWS
    + """
SELECT strftime(g, '%Y-%m-%d') AS snapshot_date, b.natural_key AS natural_key, 'added' AS change_kind
FROM g JOIN s b ON b.snapshot_date = g.g LEFT JOIN s a ON a.snapshot_date = g.before AND a.natural_key = b.natural_key
WHERE g.before IS NOT NULL AND a.natural_key IS NULL
UNION ALL
SELECT strftime(g, '%Y-%m-%d'), a.natural_key, 'removed'
FROM g JOIN s a ON a.snapshot_date = g.before LEFT JOIN s b ON b.snapshot_date = g.g AND a.natural_key = b.natural_key
WHERE b.natural_key IS NULL
UNION ALL
SELECT strftime(g, '%Y-%m-%d'), a.natural_key, 'changed'
FROM g JOIN s a ON a.snapshot_date = g.before JOIN s b ON b.snapshot_date = g.g AND a.natural_key = b.natural_key
WHERE a.status IS DISTINCT FROM b.status OR a.bid_deadline_date IS DISTINCT FROM b.bid_deadline_date
   OR a.bid_deadline_time IS DISTINCT FROM b.bid_deadline_time
   OR a.application_deadline_date IS DISTINCT FROM b.application_deadline_date
"""
)

P1_VALUES_SQL = (
    _P1_ROWS
    + """
SELECT strftime(g, '%Y-%m-%d') AS snapshot_date, a.natural_key AS natural_key,
       a.status AS old_status, b.status AS new_status,
       a.bid_deadline_date AS old_bid_deadline_date, b.bid_deadline_date AS new_bid_deadline_date,
       a.bid_deadline_time AS old_bid_deadline_time, b.bid_deadline_time AS new_bid_deadline_time,
       a.application_deadline_date AS old_application_deadline_date, b.application_deadline_date AS new_application_deadline_date
FROM g JOIN s a ON a.snapshot_date = g.before JOIN s b ON b.snapshot_date = g.g AND a.natural_key = b.natural_key
WHERE a.status IS DISTINCT FROM b.status OR a.bid_deadline_date IS DISTINCT FROM b.bid_deadline_date
   OR a.bid_deadline_time IS DISTINCT FROM b.bid_deadline_time
   OR a.application_deadline_date IS DISTINCT FROM b.application_deadline_date
"""
)


def _run_flags(spark: SparkSession, d: str) -> DataFrame:
    runs = read(spark, d, "crawl_run")
    return spikes.flag_runs(runs, "id", "organization_id", "target_date", "attempt", "status", "fetched_count", "inserted_count", "updated_count")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Runs whose count is impossible, far from its source's level, or stuck."""
    return spikes.found(_run_flags(spark, d))


def p2_flags(spark: SparkSession, d: str) -> DataFrame:
    """Every run with its level and the three marks."""
    return _run_flags(spark, d)


#: Every run held exactly against the level of the days around it; the operator asks this of its candidates only.
P2_FLAGS_SQL = f"""
WITH u AS (SELECT id, organization_id AS source, target_date AS day, attempt, status, fetched_count AS c,
                  coalesce(fetched_count < 0 OR fetched_count IN {spikes.FILLERS} OR (status = 'ok' AND fetched_count <= 0) OR (status IN ('ok_empty', 'disabled') AND fetched_count <> 0)
                           OR fetched_count < coalesce(inserted_count, 0) + coalesce(updated_count, 0), false) AS impossible
           FROM (SELECT DISTINCT ON (id) * FROM crawl_run WHERE id IS NOT NULL)),
     d AS (SELECT source, day, c AS value FROM (SELECT *, row_number() OVER (PARTITION BY source, day ORDER BY attempt DESC NULLS LAST, id DESC) AS k FROM u
           WHERE status = 'ok' AND NOT impossible AND c IS NOT NULL AND source IS NOT NULL AND day IS NOT NULL) WHERE k = 1),
     n AS (SELECT *, row_number() OVER w AS i, value - lag(value) OVER w AS step, day - lag(day) OVER w AS gap,
                  count(*) OVER (PARTITION BY source ORDER BY day RANGE BETWEEN INTERVAL {spikes.REACH} DAYS PRECEDING AND CURRENT ROW) - 1 AS b,
                  count(*) OVER (PARTITION BY source ORDER BY day RANGE BETWEEN CURRENT ROW AND INTERVAL {spikes.REACH} DAYS FOLLOWING) - 1 AS f
           FROM d WINDOW w AS (PARTITION BY source ORDER BY day)),
     l AS (SELECT a.source, a.day, a.value, median(x.value) AS level FROM n a JOIN n x ON x.source = a.source
           AND x.i BETWEEN a.i - greatest(a.b, {spikes.LEAST_BESIDE}) AND a.i + greatest(a.f, {spikes.LEAST_BESIDE}) GROUP BY ALL),
     r AS (SELECT *, sum(CASE WHEN step = 0 AND gap = 1 AND value <> 0 THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY day) AS run FROM n),
     k AS (SELECT source, run, min(i) AS s, max(i) AS e FROM r GROUP BY ALL HAVING count(*) >= {spikes.STUCK_DAYS}),
     t AS (SELECT k.source, k.run FROM k JOIN n ON n.source = k.source AND n.step IS NOT NULL AND (n.i < k.s OR n.i > k.e + 1)
           GROUP BY ALL HAVING avg(CASE WHEN n.step <> 0 THEN 1.0 ELSE 0.0 END) >= {spikes.VARYING}),
     z AS (SELECT r.source, r.day FROM r JOIN t ON t.source = r.source AND t.run = r.run)
SELECT u.id, u.source, u.day, u.status, u.c AS count, l.level, u.impossible,
       coalesce(u.status = 'ok' AND NOT u.impossible AND ((u.c > {spikes.TIMES} * l.level AND u.c - l.level > {spikes.ABOVE}) OR u.c < {spikes.BELOW} * l.level), false) AS spike,
       coalesce(u.status = 'ok' AND NOT u.impossible AND z.day IS NOT NULL AND u.c = l.value, false) AS stuck
FROM u LEFT JOIN l ON l.source = u.source AND l.day = u.day LEFT JOIN z ON z.source = u.source AND z.day = u.day
"""

P2_FOUND_SQL = f"SELECT id FROM ({P2_FLAGS_SQL}) WHERE impossible OR spike OR stuck"


def _trailing(spark: SparkSession, d: str) -> DataFrame:
    runs = read(spark, d, "crawl_run")
    figure = F.greatest(F.coalesce(F.col("fetched_count"), F.lit(0)), F.lit(0))
    daily = trailing.daily_values(runs, "organization_id", "target_date", figure, F.col("attempt"), F.col("status") != "running")
    return trailing.trailing_totals(trailing.dense_calendar(daily), (7, 30))


def p6_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals and averages of the trailing 7 and 30 days for every source and day."""
    t = _trailing(spark, d)
    return t.select(
        F.col("entity").alias("organization_id"), F.date_format("day", "yyyy-MM-dd").alias("target_date"), "value", "total_7", "total_30",
        F.round("average_7", 6).alias("average_7"), F.round("average_30", 6).alias("average_30"),
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Days after which a week brought nothing although the month brought something."""
    return p6_totals(spark, d).where("total_7 = 0 and total_30 > 0").select("organization_id", "target_date")


P6_TOTALS_SQL = """
WITH best AS (SELECT organization_id, target_date, fetched_count,
                     row_number() OVER (PARTITION BY organization_id, target_date
                                        ORDER BY attempt DESC NULLS LAST, greatest(coalesce(fetched_count, 0), 0) DESC) AS n
              FROM crawl_run
              WHERE status <> 'running' AND organization_id IS NOT NULL AND target_date IS NOT NULL),
     span AS (SELECT organization_id, min(target_date) AS a, max(target_date) AS b FROM crawl_run
              WHERE organization_id IS NOT NULL AND target_date IS NOT NULL GROUP BY 1),
     cal AS (SELECT organization_id, a, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM span),
     v AS (SELECT c.organization_id, c.day, date_diff('day', c.a, c.day) AS i, greatest(coalesce(x.fetched_count, 0), 0) AS value
           FROM cal c LEFT JOIN best x ON x.n = 1 AND x.organization_id = c.organization_id AND x.target_date = c.day),
     t AS (SELECT organization_id, day, i, value,
                  sum(value) OVER (PARTITION BY organization_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS t7,
                  sum(value) OVER (PARTITION BY organization_id ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS t30
           FROM v)
SELECT organization_id, strftime(day, '%Y-%m-%d') AS target_date, CAST(value AS BIGINT) AS value,
       CAST(t7 AS BIGINT) AS total_7, CAST(t30 AS BIGINT) AS total_30,
       round(t7 / CAST(least(7, i + 1) AS DOUBLE), 6) AS average_7, round(t30 / CAST(least(30, i + 1) AS DOUBLE), 6) AS average_30
FROM t
"""

P6_FOUND_SQL = f"SELECT organization_id, target_date FROM ({P6_TOTALS_SQL}) WHERE total_7 = 0 AND total_30 > 0"

def _converted(spark: SparkSession, d: str) -> DataFrame:
    tender = read(spark, d, "tender").select(
        F.col("natural_key").alias("key"), F.col("organization_id").alias("source"), F.col("price_raw").alias("raw"),
        F.col("estimated_price").alias("stored"), F.col("price_tax_basis").alias("stored_basis"),
    )
    sources = read(spark, d, "organization").select(F.col("id").alias("source"), F.col("notes").alias("note"))
    return units.to_base_units(tender, sources)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Tenders whose stored price or tax basis is not what their price text states."""
    return units.fit_units(_converted(spark, d)).where(units.wrong_stored()).select(F.col("key").alias("natural_key"))


def p7_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Every price in yen with its basis, where its unit came from, and the unit that the stored price would need."""
    fitted = units.fit_units(_converted(spark, d))
    return fitted.select(
        F.col("key").alias("natural_key"), money.as_bigint(F.col("amount")).alias("price_yen"), "basis", "undisclosed", "unit", "unit_from",
        "fitted_unit", "fitted_tax", F.round("residual", 6).alias("residual"), F.col("unique").alias("unit_unique"),
    )


def p7_source_units(spark: SparkSession, d: str) -> DataFrame:
    """The unit that fits each source's unit-less prices best, beside the declared one."""
    return units.source_units(_converted(spark, d)).withColumnRenamed("source", "organization_id").withColumnRenamed("unique", "unit_unique")


QUERIES = {"p1_found": p1_found, "p1_values": p1_values, "p2_found": p2_found, "p2_flags": p2_flags, "p6_found": p6_found, "p6_totals": p6_totals, "p7_found": p7_found, "p7_amounts": p7_amounts, "p7_source_units": p7_source_units}
ORACLE = {"p1_found": P1_FOUND_SQL, "p1_values": P1_VALUES_SQL, "p2_found": P2_FOUND_SQL, "p2_flags": P2_FLAGS_SQL, "p6_found": P6_FOUND_SQL, "p6_totals": P6_TOTALS_SQL}

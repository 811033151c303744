"""Queries of the engine's own operators over the given tables, with their SQL.

Compatibility composition, which SQL lacks, is written out as a table of the
characters (``_nfkc_sql``); what the engine's expressions cannot look back or ahead
for is taken in and put back.
"""

from __future__ import annotations

import datetime as dt
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow import schemas
from noticeflow.functions import identity, money, temporal, text, urls
from noticeflow.operators import data_health, digest, health, ingest, judge, lifecycle, match, metrics, runs
from noticeflow.sources import html_listing
from noticeflow.storage import materialize, read, spread

NOW = dt.datetime(2026, 8, 29, 9, 0)
_NOW = "TIMESTAMP '2026-08-29 09:00:00'"
QUERIES: dict = {}
ORACLE: dict = {}


def _nfkc_sql(x: str) -> str:
    """Compatibility composition in SQL: characters with a counterpart of one character by table, some longer ones by name, then canonical composition."""
    alone = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for c in (*range(0xA0, 0xD800), *range(0xF900, 0xFFFE)) if c not in range(0xAC00, 0xD7A4)]
    alone = [(a, b) for a, b in alone if a != b and len(b) == 1 and unicodedata.normalize("NFC", a) == a]
    # all but the presentation forms of Arabic and Hebrew, which would nest too deep
    by_rule = [chr(c) for c in (*range(0xA0, 0xD800), *range(0xFB00, 0xFB1D), *range(0xFE10, 0xFE70), *range(0xFF00, 0xFFFE)) if c not in range(0xAC00, 0xD7A4)]
    for long in (c for c in by_rule if len(unicodedata.normalize("NFKC", c)) > 1):
        x = f"replace({x}, '{long}', '{unicodedata.normalize('NFKC', long)}')"
    return f"nfc_normalize(translate({x}, '{''.join(a for a, _ in alone)}', '{''.join(b for _, b in alone).replace(chr(39), chr(39) * 2)}'))"


#: Blanks as a class that the SQL engine's expressions know.
_BLANK_SQL = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _flat_sql(x: str) -> str:
    return f"trim(regexp_replace({_nfkc_sql(f"coalesce({x}, '')")}, '{_BLANK_SQL}+', ' ', 'g'))"


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _runs_once(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "crawl_run").dropDuplicates(["id"])


_RUNS = "(SELECT DISTINCT ON (id) * FROM crawl_run)"


@_query(f"""
WITH r AS {_RUNS},
     l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY organization_id ORDER BY started_at DESC, id DESC) AS n FROM r WHERE status <> 'running') WHERE n = 1),
     g AS (SELECT organization_id, coalesce(finished_at, started_at) AS moment FROM (SELECT *, row_number() OVER (PARTITION BY organization_id ORDER BY started_at DESC, id DESC) AS n FROM r WHERE status = 'ok') WHERE n = 1),
     b AS (SELECT r.organization_id, avg(r.fetched_count) AS a, count(*) AS n FROM r LEFT JOIN l USING (organization_id)
           WHERE r.status = 'ok' AND r.target_date >= DATE '2026-07-30' AND r.id <> l.id GROUP BY 1),
     x AS (SELECT o.id, o.enabled, l.status, l.started_at, l.fetched_count, g.moment, b.a, coalesce(b.n, 0) AS n,
                  g.moment IS NOT NULL AND ({_NOW} - g.moment) > INTERVAL 3 DAY AS stale
           FROM organization o LEFT JOIN l ON l.organization_id = o.id LEFT JOIN g ON g.organization_id = o.id LEFT JOIN b ON b.organization_id = o.id),
     s AS (SELECT *, CASE WHEN NOT enabled THEN 'disabled' WHEN status IS NULL THEN 'never_run' WHEN status = 'failed' THEN 'failed' WHEN status = 'ok_empty' THEN 'empty'
                          WHEN status = 'disabled' THEN 'disabled' WHEN stale THEN 'stale' WHEN n < 3 THEN 'warming_up'
                          WHEN fetched_count < a * 0.5 THEN 'volume_drop' ELSE 'healthy' END AS state FROM x)
SELECT id AS organization_id, state, state NOT IN ('healthy', 'warming_up') AS is_alert, status AS last_status, started_at AS last_run_at, moment AS last_success_at,
       fetched_count AS latest_count, CASE WHEN state IN ('warming_up', 'volume_drop', 'healthy') THEN round(a, 6) END AS baseline_avg,
       CASE WHEN state IN ('warming_up', 'volume_drop', 'healthy') THEN n ELSE 0 END AS baseline_samples, CAST(floor(epoch({_NOW} - moment) / 86400) AS BIGINT) AS days_since_success
FROM s""")
def r_health(spark: SparkSession, d: str) -> DataFrame:
    """State of every source from the run log."""
    got = health.evaluate(read(spark, d, "organization"), _runs_once(spark, d), NOW)
    return got.withColumn("baseline_avg", F.round("baseline_avg", 6)).drop("reason")  # formatted doubles differ between engines


@_query("SELECT organization_id, target_date, coalesce(max(attempt), 0) + 1 AS next_attempt FROM crawl_run GROUP BY 1, 2")
def r_next_attempt(spark: SparkSession, d: str) -> DataFrame:
    return runs.next_attempt(read(spark, d, "crawl_run"))


@_query(f"""
WITH r AS {_RUNS}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY organization_id, target_date ORDER BY attempt DESC, id DESC) AS n FROM r WHERE status <> 'running') WHERE n = 1)
SELECT w.organization_id, w.target_date, coalesce(l.status IN ('failed', 'ok_empty', 'partial'), true) AS needs_rerun
FROM (SELECT DISTINCT organization_id, target_date FROM r) w LEFT JOIN l USING (organization_id, target_date)""")
def r_needs_rerun(spark: SparkSession, d: str) -> DataFrame:
    log = _runs_once(spark, d)
    return runs.needs_rerun(log.select("organization_id", "target_date").distinct(), log)


@_query(f"""
SELECT organization_id, target_date, attempt, status, fetched_count FROM (
  SELECT *, row_number() OVER (PARTITION BY organization_id, target_date ORDER BY attempt DESC, id DESC) AS n FROM {_RUNS} WHERE status <> 'running') WHERE n = 1""")
def r_last_completed(spark: SparkSession, d: str) -> DataFrame:
    return runs.last_completed(_runs_once(spark, d)).select("organization_id", "target_date", "attempt", "status", "fetched_count")


@_query(f"""
SELECT id, CASE WHEN error_kind IS NOT NULL THEN 'failed' WHEN status IN ('disabled', 'partial') THEN status WHEN fetched_count > 0 THEN 'ok' ELSE 'ok_empty' END AS resolved
FROM {_RUNS}""")
def r_run_status(spark: SparkSession, d: str) -> DataFrame:
    """The status that each run's own figures imply."""
    return _runs_once(spark, d).select("id", runs.resolve_status(F.col("error_kind").isNotNull(), F.col("status"), F.col("fetched_count")).alias("resolved"))


_OBSERVED = """
WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_date, natural_key ORDER BY delivered_at DESC) AS n FROM tender_snapshot
           WHERE snapshot_date IS NOT NULL AND natural_key IS NOT NULL AND delivered_at IS NOT NULL) WHERE n = 1)
"""
_SAME = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ingest.WATCHED)


def _folded(spark: SparkSession, d: str) -> DataFrame:
    """All snapshot rows as one sequence of observations, from an empty state."""
    rows = read(spark, d, "tender_snapshot").where("snapshot_date is not null and natural_key is not null and delivered_at is not null")
    rest = [c for c in rows.columns if c not in ("snapshot_date", "natural_key", "current_revision", "first_seen_at", "last_seen_at")]
    last = rows.groupBy("snapshot_date", "natural_key").agg(F.max_by(F.struct(*rest), "delivered_at").alias("r")).select("snapshot_date", "natural_key", "r.*")
    empty = last.limit(0).withColumn("current_revision", F.lit(0))
    return ingest.fold(empty, last, ["snapshot_date"])


@_query(
    _OBSERVED
    + """, b AS (SELECT *, lag(ROW(bid_deadline_date, bid_deadline_time, application_deadline_date, application_deadline_time, qa_deadline_date, qa_deadline_time,
                        estimated_price, price_undisclosed, method, title, status)) OVER w AS p,
                 ROW(bid_deadline_date, bid_deadline_time, application_deadline_date, application_deadline_time, qa_deadline_date, qa_deadline_time,
                        estimated_price, price_undisclosed, method, title, status) AS s,
                 row_number() OVER w AS k FROM o WINDOW w AS (PARTITION BY natural_key ORDER BY snapshot_date)),
     c AS (SELECT *, k > 1 AND p IS DISTINCT FROM s AS changed FROM b)
SELECT natural_key, snapshot_date, CASE WHEN k = 1 THEN 'inserted' WHEN changed THEN 'updated' ELSE 'unchanged' END AS outcome,
       CAST(1 + sum(CAST(changed AS INT)) OVER (PARTITION BY natural_key ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING) AS INT) AS revision
FROM c"""
)
def r_observations(spark: SparkSession, d: str) -> DataFrame:
    """Outcome and revision of every observation."""
    return _folded(spark, d).select("natural_key", "snapshot_date", "outcome", "revision")


@_query(
    _OBSERVED
    + f""", b AS (SELECT *, row_number() OVER (PARTITION BY natural_key ORDER BY snapshot_date) AS k FROM o),
     p AS (SELECT b.natural_key, b.snapshot_date, a.natural_key IS NOT NULL AND NOT ({_SAME}) AS changed,
                  (a.bid_deadline_date IS DISTINCT FROM b.bid_deadline_date OR a.bid_deadline_time IS DISTINCT FROM b.bid_deadline_time
                   OR a.application_deadline_date IS DISTINCT FROM b.application_deadline_date OR a.application_deadline_time IS DISTINCT FROM b.application_deadline_time) AS d,
                  CASE WHEN b.status = 'cancelled' THEN 'cancelled' ELSE 'corrected' END AS kind
           FROM b JOIN b a ON a.natural_key = b.natural_key AND a.k = b.k - 1)
SELECT natural_key, snapshot_date, kind AS change_kind, d AS deadline_changed FROM p WHERE changed"""
)
def r_revisions(spark: SparkSession, d: str) -> DataFrame:
    """Corrections with whether a deadline moved."""
    return _folded(spark, d).where("outcome = 'updated'").select("natural_key", "snapshot_date", "change_kind", "deadline_changed")


@_query(
    _OBSERVED
    + f""", b AS (SELECT * EXCLUDE (current_revision, first_seen_at, last_seen_at), row_number() OVER (PARTITION BY natural_key ORDER BY snapshot_date) AS k FROM o),
     c AS (SELECT b.*, a.natural_key IS NULL OR NOT ({_SAME}) AS counts FROM b LEFT JOIN b a ON a.natural_key = b.natural_key AND a.k = b.k - 1)
SELECT natural_key, current_revision, status, title, method, source_url, bid_deadline_date, price_raw, first_seen_at, last_seen_at
FROM c JOIN (SELECT natural_key, CAST(count_if(counts) AS INT) AS current_revision, max(k) FILTER (counts) AS k, min(delivered_at) AS first_seen_at, max(delivered_at) AS last_seen_at FROM c GROUP BY 1) USING (natural_key, k)"""
)
def r_current_state(spark: SparkSession, d: str) -> DataFrame:
    """What is in force after all observations: the last that changed something, and when the notice was seen."""
    folded = _folded(spark, d)
    state = ingest.merge(spark.createDataFrame([], schemas.TABLES["tender"]), folded, ["snapshot_date"], "delivered_at")
    return state.select("natural_key", "current_revision", "status", "title", "method", "source_url", "bid_deadline_date", "price_raw", "first_seen_at", "last_seen_at")


@_query("""
SELECT natural_key, CASE WHEN status = 'open' AND bid_deadline_date IS NOT NULL
         AND TIMESTAMP '2026-08-29 09:00:00' > CAST(strftime(bid_deadline_date, '%Y-%m-%d') || ' ' || coalesce(bid_deadline_time || ':00', '23:59:59') AS TIMESTAMP)
       THEN 'closed' ELSE status END AS status FROM tender""")
def r_close_expired(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.close_expired(read(spark, d, "tender"), NOW).select("natural_key", "status")


@_query("""
SELECT natural_key, organization_id, CAST(floor(epoch(TIMESTAMP '2026-08-29 09:00:00' - last_seen_at) / 86400) AS BIGINT) AS days_missing FROM tender
WHERE status = 'open' AND NOT coalesce(TIMESTAMP '2026-08-29 09:00:00' > CAST(strftime(bid_deadline_date, '%Y-%m-%d') || ' ' || coalesce(bid_deadline_time || ':00', '23:59:59') AS TIMESTAMP), false)
  AND floor(epoch(TIMESTAMP '2026-08-29 09:00:00' - last_seen_at) / 86400) >= 3""")
def r_disappeared(spark: SparkSession, d: str) -> DataFrame:
    return lifecycle.disappeared(read(spark, d, "tender"), NOW).select("natural_key", "organization_id", "days_missing")


@_query("""
SELECT natural_key, CAST(strftime(bid_deadline_date, '%Y-%m-%d') || ' ' || coalesce(bid_deadline_time, '09:00') || ':00' AS TIMESTAMP) AS notify_at,
       CAST(strftime(bid_deadline_date, '%Y-%m-%d') || ' ' || coalesce(bid_deadline_time || ':00', '23:59:59') AS TIMESTAMP) AS expires_at,
       CASE WHEN bid_deadline_date IS NULL THEN '記載なし' WHEN bid_deadline_time IS NULL THEN strftime(bid_deadline_date, '%Y-%m-%d') || '（時刻記載なし）'
            ELSE strftime(bid_deadline_date, '%Y-%m-%d') || ' ' || bid_deadline_time || '必着' END AS display,
       date_diff('day', DATE '2026-08-29', bid_deadline_date) AS days_left,
       CAST(floor(epoch(TIMESTAMP '2026-08-29 09:00:00' - last_seen_at) / 86400) AS BIGINT) AS elapsed, strftime(first_seen_at, '%Y-%m') AS month
FROM tender""")
def r_deadlines(spark: SparkSession, d: str) -> DataFrame:
    day, time, now = F.col("bid_deadline_date"), F.col("bid_deadline_time"), F.lit(NOW).cast("timestamp_ntz")
    return read(spark, d, "tender").select(
        "natural_key", temporal.notify_at(day, time).alias("notify_at"), temporal.expires_at(day, time).alias("expires_at"), temporal.display_deadline(day, time).alias("display"),
        temporal.calendar_days(day, now).cast("bigint").alias("days_left"), temporal.elapsed_days(now, F.col("last_seen_at")).alias("elapsed"), temporal.month_key(F.col("first_seen_at")).alias("month"),
    )


@_query("""
SELECT natural_key, sha256('1' || chr(0) || organization_id || chr(0) || title_normalized || chr(0) || coalesce(strftime(coalesce(announced_date, bid_deadline_date), '%Y-%m-%d'), '')) AS key,
       CASE WHEN announced_date IS NOT NULL THEN 'announced' WHEN bid_deadline_date IS NOT NULL THEN 'bid_deadline' ELSE 'none' END AS anchor,
       announced_date IS NULL AND bid_deadline_date IS NULL AS weak
FROM tender""")
def r_keys(spark: SparkSession, d: str) -> DataFrame:
    """Content-derived keys from the stored columns."""
    a, b = F.col("announced_date"), F.col("bid_deadline_date")
    return read(spark, d, "tender").select("natural_key", identity.natural_key(F.col("organization_id"), F.col("title_normalized"), a, b).alias("key"), identity.anchor_kind(a, b).alias("anchor"), identity.is_weak(a, b).alias("weak"))


def _titles_sql() -> str:
    steps = "s3"
    for ch in "・-−ー~〜_":
        steps = f"regexp_replace({steps}, '{chr(92) + ch if ch == '-' else ch}{{2,}}', '{ch}', 'g')"
    methods = " ".join(f"WHEN contains(t, '{needle}') THEN '{method}'" for needle, method in text.METHODS)
    edge = text.EDGE.replace("\\", "\\")
    return f"""
WITH a AS (SELECT natural_key, title, {_nfkc_sql('title')} AS n FROM tender),
     b AS (SELECT *, regexp_replace(translate(n, '{text.BRACKETS}', ''), '{_BLANK_SQL}+', '', 'g') AS base, trim(regexp_replace(n, '{_BLANK_SQL}+', ' ', 'g')) AS t FROM a),
     c AS (SELECT *, regexp_replace(base, '{text.FISCAL_YEAR}', '', 'g') AS s1 FROM b),
     d AS (SELECT *, regexp_replace(s1, '(?s)^(?:{'|'.join(text.PREFIXES)})+(.)', '\\1') AS s2 FROM c),
     e AS (SELECT *, regexp_replace(s2, '(?s)(.)(?:{'|'.join(text.SUFFIXES)})+$', '\\1') AS s3 FROM d),
     f AS (SELECT *, regexp_replace(regexp_replace({steps}, '^{edge}', ''), '{edge}$', '') AS s FROM e)
SELECT natural_key, coalesce(nullif(s, ''), nullif(base, ''), regexp_replace(regexp_replace(n, '^{_BLANK_SQL}+', ''), '{_BLANK_SQL}+$', '')) AS title_normalized,
       CASE WHEN coalesce(t, '') = '' THEN 'unknown' {methods} ELSE 'unknown' END AS method,
       nullif(regexp_extract(title, '^【([^】]+)】', 1), '') AS tag,
       coalesce(regexp_matches(nullif(regexp_extract(title, '^【([^】]+)】', 1), ''), '{'|'.join(text.RESULT_TAGS)}'), false) AS is_result
FROM f"""


@_query(_titles_sql())
def r_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles normalized, with method, tag and result mark."""
    t = F.col("title")
    return read(spark, d, "tender").select("natural_key", text.normalize_title(t).alias("title_normalized"), text.classify_method(t).alias("method"), text.leading_tag(t).alias("tag"), text.is_result_announcement(t).alias("is_result"))


def _dates_sql() -> str:
    signs = {sign: era for names, era in temporal.ERAS.items() for sign in names}
    date = rf"(?:(?:{'|'.join(signs)})\s*(?:元|\d{{1,2}})|\d{{4}})\s*[年./-]\s*\d{{1,2}}\s*[月./-]\s*\d{{1,2}}\s*日?"
    parts = rf"^({'|'.join(signs)})?\s*(元|\d+)\s*[年./-]\s*(\d+)\s*[月./-]\s*(\d+)"
    before, first, last = (" ".join(f"WHEN '{sign}' THEN {era[0]}" if i == 0 else f"WHEN '{sign}' THEN DATE '{era[i]}'" for sign, era in signs.items()) for i in range(3))
    clock = r"(午前|午後)?\s*(\d{1,2})\s*[時:]\s*(\d{1,2})?"
    return f"""
WITH a AS (SELECT doc_id, {_nfkc_sql('text')} AS t FROM documents),
     -- a character that no text has behind every date, so that texts fall apart there
     b AS (SELECT doc_id, t, string_split(regexp_replace(t, '({date})', '\\1' || chr(57344), 'g'), chr(57344)) AS pieces FROM a),
     c AS (SELECT doc_id, pieces, unnest(range(1, len(pieces))) AS k FROM b),
     w AS (SELECT *, regexp_extract(pieces[k], '(?s)({date})$', 1) AS w FROM c),
     v AS (SELECT *, regexp_extract(w, '{parts}', 1) AS era, replace(regexp_extract(w, '{parts}', 2), '元', '1') AS y, regexp_extract(w, '{parts}', 3) AS m, regexp_extract(w, '{parts}', 4) AS d FROM w),
     e AS (SELECT *, CASE WHEN CAST(y AS INT) > 0 THEN try_cast(lpad(CAST(CAST(y AS INT) + CASE era {before} ELSE 0 END AS VARCHAR), 4, '0') || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') AS DATE) END AS day FROM v),
     g AS (SELECT * FROM e WHERE day IS NOT NULL AND (era = '' OR day BETWEEN CASE era {first} END AND CASE era {last} END)),
     f AS (SELECT doc_id, count(*) AS n, min(day) AS earliest, count(DISTINCT day) > 1 AS ambiguous, arg_min(array_to_string(pieces[k + 1 :], ''), x * 1000000 + k) AS rest FROM (SELECT * EXCLUDE (day), day, day - DATE '1970-01-01' AS x FROM g) GROUP BY 1),
     z AS (SELECT *, regexp_extract(rest, '{clock}', 0) AS whole, regexp_extract(rest, '{clock}', 1) AS half, try_cast(regexp_extract(rest, '{clock}', 2) AS INT) AS h, coalesce(try_cast(regexp_extract(rest, '{clock}', 3) AS INT), 0) AS mi FROM f),
     q AS (SELECT *, CASE WHEN half = '' THEN h ELSE h % CASE WHEN h = 12 THEN 12 ELSE 100 END + CASE WHEN half = '午後' THEN 12 ELSE 0 END END AS hour FROM z)
SELECT a.doc_id, q.earliest, CASE WHEN contains(q.rest, '正午') THEN '12:00' WHEN q.whole <> '' AND q.hour < 24 AND q.mi < 60 THEN lpad(CAST(q.hour AS VARCHAR), 2, '0') || ':' || lpad(CAST(q.mi AS VARCHAR), 2, '0') END AS time,
       q.ambiguous, CAST(coalesce(q.n, 0) AS INT) AS dates
FROM a LEFT JOIN q USING (doc_id)"""


@_query(_dates_sql())
def r_dates(spark: SparkSession, d: str) -> DataFrame:
    """Every date written in a document, and its deadline reading."""
    t = spread(read(spark, d, "documents").select("doc_id", "text"))
    return t.withColumn("deadline", temporal.parse_deadline("text")).select("doc_id", F.col("deadline.date").alias("earliest"), F.col("deadline.time").alias("time"), F.col("deadline.ambiguous").alias("ambiguous"), F.coalesce(F.size(temporal.find_dates(F.col("text"))), F.lit(0)).alias("dates"))


def _prices_sql() -> str:
    number = f"([0-9]{{1,{money.DIGITS}}})"
    head = f"""
WITH a AS (SELECT natural_key, regexp_replace(regexp_replace(coalesce(price_raw, ''), '^{_BLANK_SQL}+', ''), '{_BLANK_SQL}+$', '') AS shown FROM tender),
     b AS (SELECT natural_key, CASE WHEN length(shown) <= {money.LONGEST} THEN {_nfkc_sql('shown')} ELSE '' END AS t FROM a),
     u0 AS (SELECT natural_key, t, replace(t, ',', '') AS rest, 0::HUGEINT AS total, false AS taken FROM b)"""
    units = list(money.UNITS.items())
    for i, (unit, factor) in enumerate(units, 1):
        head += f""",
     x{i} AS (SELECT *, regexp_extract(rest, '(?:^|[^0-9]){number}\\s*{unit}', 1) AS got FROM u{i - 1}),
     u{i} AS (SELECT natural_key, t, CASE WHEN got <> '' THEN regexp_replace(rest, '(?s)^(?:.*?[^0-9])?[0-9]{{1,{money.DIGITS}}}\\s*{unit}', '') ELSE rest END AS rest,
                     total + CASE WHEN got <> '' THEN CAST(got AS HUGEINT) * {factor} ELSE 0 END AS total, taken OR got <> '' AS taken FROM x{i})"""
    hidden = " OR ".join(f"contains(t, '{x}')" for x in money.UNDISCLOSED)
    empty = ", ".join(f"'{x}'" for x in money.EMPTY)
    bare = f"nullif(regexp_extract(replace(t, ',', ''), '(?:^|[^0-9]){number}(?:[^0-9]|$)', 1), '')"
    return f"""{head},
     p AS (SELECT natural_key, t, {hidden} AS undisclosed, CASE WHEN taken THEN total ELSE CAST({bare} AS HUGEINT) END AS amount,
                  regexp_matches(t, '{money.TAX_INCLUDED}') AS i, regexp_matches(t, '{money.TAX_EXCLUDED}') AS e FROM u{len(units)})
SELECT natural_key, CASE WHEN NOT undisclosed AND t NOT IN ({empty}) AND amount <= 9223372036854775807 THEN CAST(amount AS BIGINT) END AS amount, undisclosed,
       CASE WHEN i AND NOT e THEN 'included' WHEN e AND NOT i THEN 'excluded' ELSE 'unknown' END AS tax_basis FROM p"""


@_query(_prices_sql())
def r_prices(spark: SparkSession, d: str) -> DataFrame:
    """Price texts by the plain rules: amount, undisclosed, tax basis."""
    return read(spark, d, "tender").withColumn("p", money.parse_price("price_raw")).select("natural_key", money.as_bigint(F.col("p.amount")).alias("amount"), F.col("p.undisclosed").alias("undisclosed"), F.col("p.tax_basis").alias("tax_basis"))


@_query("""
SELECT natural_key, estimated_price IS NULL OR (estimated_price >= 1000000 AND estimated_price <= 50000000) AS within,
       CASE WHEN price_undisclosed THEN '非公表' WHEN estimated_price IS NULL THEN '記載なし' ELSE format('{:,}', estimated_price) || '円' END AS display
FROM tender""")
def r_price_range(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("estimated_price")
    return read(spark, d, "tender").select("natural_key", money.in_range(p, F.lit(1_000_000), F.lit(50_000_000)).alias("within"), money.display_price(p, F.col("price_undisclosed")).alias("display"))


@_query("""
SELECT id, coalesce(len(regexp_extract_all(text, '[ÃÂãåäæÐ][\\x{80}-\\x{BF}\\x{2020}-\\x{2122}]')) >= 2, false) AS looks_garbled,
       round(coalesce(CASE WHEN len(regexp_extract_all(text, '\\(cid:\\d+\\)')) > 0 THEN len(regexp_extract_all(text, '\\(cid:\\d+\\)'))
             / (len(regexp_extract_all(text, '\\(cid:\\d+\\)')) + length(regexp_replace(text, '\\(cid:\\d+\\)', '', 'g')))::DOUBLE END, 0.0), 9) AS cid_ratio
FROM extraction_result""")
def r_extraction_checks(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return read(spark, d, "extraction_result").select("id", text.looks_mojibake(t).alias("looks_garbled"), F.round(text.cid_ratio(t), 9).alias("cid_ratio"))


@_query("""
WITH e AS (SELECT id, status, coalesce('.' || lower(nullif(regexp_extract(regexp_replace(regexp_replace(file_url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '\\.([^./]*)$', 1), '')), '') AS ext FROM extraction_result)
SELECT id, ext, CASE WHEN ext = '' OR ext IN ('.pdf', '.docx', '.xlsx', '.html', '.htm', '.txt', '.csv') THEN NULL ELSE 'unsupported_format' END AS early,
       status IN ('unsupported_scanned', 'unsupported_format', 'fetch_failed') AS needs_human
FROM e""")
def r_attachments(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "extraction_result").select("id", "status", urls.extension(F.col("file_url")).alias("ext"))
    return rows.select("id", "ext", urls.classify_before_fetch(F.col("ext")).alias("early"), urls.needs_human(F.col("status")).alias("needs_human"))


_LOCAL_SQL = "|".join(n.lstrip(".").replace(".", "[.]") for n in urls.LOCAL_NAMES)


@_query(f"""
WITH h AS (SELECT natural_key, lower(rtrim(regexp_extract(coalesce(source_url, ''), '^(?i:https?)://(?:[^/?#]*@)?(\\[[^\\]]*\\]|[^/?#:@]*)(?::[0-9]*)?(?:[/?#]|$)', 1), '.')) AS host FROM tender)
SELECT natural_key, host <> '' AND NOT regexp_matches(host, '(?:^|[.])(?:{_LOCAL_SQL})$')
       AND NOT regexp_matches(host, '^(?:0|10|127)[.]|^169[.]254[.]|^192[.]168[.]|^192[.]0[.][02][.]|^172[.](?:1[6-9]|2[0-9]|3[01])[.]|^100[.](?:6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])[.]|^198[.](?:1[89]|51[.]100)[.]|^203[.]0[.]113[.]|^2(?:2[4-9]|[345][0-9])[.]')
       AND NOT regexp_matches(host, '^\\[(?:::|f[cdef]|2001:db8)') AS safe FROM h""")
def r_urls(spark: SparkSession, d: str) -> DataFrame:
    """Which stored addresses may be fetched."""
    return read(spark, d, "tender").select("natural_key", urls.is_safe_url(F.col("source_url")).alias("safe"))


@_query("""
SELECT table_name, "constraint", CAST(n AS BIGINT) AS n FROM (
SELECT 'organization' AS table_name, 'crawler_kind' AS "constraint", CAST(count_if(NOT (crawler_kind IN ('http', 'browser'))) AS BIGINT) AS n FROM organization
UNION ALL SELECT 'organization', 'unique', coalesce((SELECT CAST(sum(k - 1) AS BIGINT) FROM (SELECT count(*) AS k FROM organization GROUP BY id)), 0)
UNION ALL SELECT 'crawl_run', 'status', count_if(NOT (status IN ('running', 'ok', 'ok_empty', 'partial', 'failed', 'disabled'))) FROM crawl_run
UNION ALL SELECT 'crawl_run', 'unique', coalesce((SELECT CAST(sum(k - 1) AS BIGINT) FROM (SELECT count(*) AS k FROM crawl_run GROUP BY organization_id, target_date, attempt)), 0)
UNION ALL SELECT 'tender', 'status', count_if(NOT (status IN ('open', 'corrected', 'cancelled', 'closed'))) FROM tender
UNION ALL SELECT 'tender', 'undisclosed_has_no_price', count_if(coalesce(price_undisclosed, false) AND estimated_price IS NOT NULL) FROM tender
UNION ALL SELECT 'tender', 'method', count_if(NOT (method IN ('open', 'selective', 'negotiated', 'proposal', 'unknown'))) FROM tender
UNION ALL SELECT 'tender', 'price_tax_basis', count_if(NOT (price_tax_basis IN ('included', 'excluded', 'unknown'))) FROM tender
UNION ALL SELECT 'tender', 'unique', coalesce((SELECT CAST(sum(k - 1) AS BIGINT) FROM (SELECT count(*) AS k FROM tender GROUP BY natural_key)), 0)
UNION ALL SELECT 'extraction_result', 'status', count_if(NOT (status IN ('ok', 'unsupported_scanned', 'unsupported_format', 'fetch_failed', 'skipped'))) FROM extraction_result
UNION ALL SELECT 'extraction_result', 'unique', coalesce((SELECT CAST(sum(k - 1) AS BIGINT) FROM (SELECT count(*) AS k FROM extraction_result GROUP BY id)), 0))""")
def r_constraints(spark: SparkSession, d: str) -> DataFrame:
    """How many rows break each constraint of the delivered tables."""
    out = None
    for table in ("organization", "crawl_run", "tender", "extraction_result"):
        part = schemas.violations(read(spark, d, table), table)
        out = part if out is None else out.unionByName(part)
    return out


@_query("""
SELECT organization_id, source_url AS url, trim(regexp_replace(title, '[\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) AS title
FROM (SELECT *, row_number() OVER (PARTITION BY organization_id, source_url ORDER BY natural_key) AS n FROM tender WHERE source_url IS NOT NULL AND title IS NOT NULL)
WHERE n = 1""")
def r_listing(spark: SparkSession, d: str) -> DataFrame:
    """Tenders written as listing pages and read back: bytes, container, links, first address wins.

    A page holds the tenders of one organization and hash part, so no page grows
    with an organization.
    """
    t = read(spark, d, "tender").where("source_url is not null and title is not null").select("organization_id", "source_url", "title", "natural_key")
    escaped = F.col("title")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(a), F.lit(b))
    link = F.concat(F.lit('<li><span class="link"><a href="'), F.replace(F.col("source_url"), F.lit("&"), F.lit("&amp;")), F.lit('">'), escaped, F.lit("</a></span></li>"))
    paged = t.withColumn("part", F.pmod(F.xxhash64("source_url"), F.lit(4096)))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("natural_key", link.alias("l")))), lambda x: x["l"]), "\n")
    html = F.concat(F.lit('<html><head><meta charset="utf-8"></head><body><ul class="news_list">'), items, F.lit("</ul></body></html>"))
    pages = paged.groupBy("organization_id", "part").agg(F.encode(html, "utf-8").alias("content")).select(F.concat_ws("/", "organization_id", F.col("part").cast("string")).alias("page_id"), F.lit("https://example.jp/list/").alias("base_url"), "content")
    links = html_listing.parse_pages(pages).where("url is not null")
    return links.select(F.substring_index("page_id", "/", 1).alias("organization_id"), "url", "title")


_PROFILES = [
    ("co-copper", ["small copper case", "steel"], [], [], ["copper", "Steel"], ["brushed"], None, None),
    ("co-blue", ["light blue"], [], [], [], [], 900, 1500),
    ("co-empty", [], [], [], [], [], None, None),
]


def _profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_PROFILES, match.PROFILE)


def _part_tenders(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    return p.select(F.col("p_partkey").cast("string").alias("natural_key"), F.col("p_name").alias("title"), F.floor("p_retailprice").cast("bigint").alias("amount"), F.lit(None).cast("string").alias("prefecture_code"), F.lit(None).cast("string").alias("spec_text"))


_SIMILAR = """
WITH entries(company_id, pos, entry) AS (VALUES ('co-copper', 0, 'small copper case'), ('co-copper', 1, 'steel'), ('co-copper', 2, 'copper'), ('co-copper', 3, 'Steel'), ('co-blue', 0, 'light blue')),
     texts AS (SELECT CAST(p_partkey AS VARCHAR) AS id, regexp_replace(lower(p_name), '[\\s,、。・/／\\-−ー()（）\\[\\]【】]+', '', 'g') AS s FROM part
               UNION ALL SELECT company_id || '#' || pos, regexp_replace(lower(entry), '[\\s,、。・/／\\-−ー()（）\\[\\]【】]+', '', 'g') FROM entries),
     g AS (SELECT id, substr(s, CAST(i AS INT), 2) AS gram, count(*) AS n FROM (SELECT id, s, unnest(range(1, greatest(length(s), 2))) AS i FROM texts WHERE length(s) >= 1) GROUP BY 1, 2),
     nn AS (SELECT id, sum(n * n) AS norm FROM g GROUP BY 1),
     sc AS (SELECT a.id AS natural_key, b.id AS e, sum(a.n * b.n) / (sqrt(CAST(any_value(x.norm) AS DOUBLE)) * sqrt(CAST(any_value(y.norm) AS DOUBLE))) AS score
            FROM g a JOIN g b ON a.gram = b.gram AND contains(b.id, '#') AND NOT contains(a.id, '#') JOIN nn x ON x.id = a.id JOIN nn y ON y.id = b.id GROUP BY 1, 2),
     best AS (SELECT natural_key, split_part(e, '#', 1) AS company_id, score, entry AS best_match FROM (
                SELECT sc.*, t.entry, row_number() OVER (PARTITION BY natural_key, t.company_id ORDER BY score DESC, t.pos) AS k FROM sc JOIN entries t ON t.company_id || '#' || t.pos = sc.e) WHERE k = 1)
"""


@_query(_SIMILAR + "SELECT natural_key, company_id, round(score, 9) AS score, best_match FROM best")
def r_similarity(spark: SparkSession, d: str) -> DataFrame:
    """The most similar entry of each profile for every part name."""
    formed = match.profiles_with_forms(_profiles(spark))
    titled = _part_tenders(spark, d).withColumn("title_form", text.match_form(F.col("title")))
    return match.stage_two(titled, formed).withColumn("score", F.round("score", 9))


_CASCADE = (
    _SIMILAR
    + """, prof(company_id, kw, ng, lo, hi, corpus) AS (VALUES ('co-copper', ['copper', 'steel'], ['brushed'], NULL, NULL, true), ('co-blue', [], [], 900, 1500, true), ('co-empty', [], [], NULL, NULL, false)),
     pairs AS (SELECT CAST(p_partkey AS VARCHAR) AS natural_key, lower(p_name) AS s, floor(p_retailprice) AS amount, prof.* FROM part, prof),
     x AS (SELECT pairs.*, len(list_filter(ng, lambda k: contains(s, k))) > 0 AS excluded, len(list_filter(kw, lambda k: contains(s, k))) > 0 AS hit, coalesce(score, 0.0) AS score
           FROM pairs LEFT JOIN best USING (natural_key, company_id)),
     y AS (SELECT *, NOT excluded AND (lo IS NULL OR amount >= lo) AND (hi IS NULL OR amount <= hi) AS promote, hit AND NOT excluded AS kh, NOT corpus OR score >= 0.25 AS pass2 FROM x),
     decided AS (SELECT natural_key, company_id, CASE WHEN promote THEN 2 ELSE 1 END AS stage,
              CAST(CASE WHEN excluded THEN 0 WHEN NOT promote THEN CASE WHEN kh THEN 50 ELSE 0 END ELSE greatest(CASE WHEN kh THEN 50 ELSE 0 END, floor(score * 100)) END AS INT) AS score,
              CASE WHEN excluded THEN 'none' WHEN kh THEN 'rule' WHEN promote THEN 'vector' ELSE 'none' END AS matched_by, NOT excluded AND (kh OR (promote AND pass2)) AS should_notify
       FROM y)
"""
)


def _decided(spark: SparkSession, d: str) -> DataFrame:
    return match.cascade(_part_tenders(spark, d), _profiles(spark), False)


@_query(_CASCADE + "SELECT * FROM decided")
def r_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Rules and similarity for every part name and profile."""
    return _decided(spark, d).select("natural_key", "company_id", "stage", "score", "matched_by", "should_notify")


@_query(
    _CASCADE
    + """SELECT company_id, count(*) AS total, CAST(count_if(stage >= 2) AS BIGINT) AS stage_2, CAST(count_if(stage >= 3) AS BIGINT) AS stage_3, 0::BIGINT AS billed, 0::BIGINT AS cache_hits, 0.0::DOUBLE AS cost_jpy,
       CAST(count_if(should_notify) AS BIGINT) AS notified, 0.0::DOUBLE AS stage_3_ratio FROM decided GROUP BY 1"""
)
def r_funnel(spark: SparkSession, d: str) -> DataFrame:
    return match.funnel(_decided(spark, d).withColumns({"cache_hit": F.lit(False), "cost_jpy": F.lit(0.0)}))


_RESULTS = """
WITH results AS (SELECT 'co-' || (CAST(CASE WHEN current_revision IS NULL THEN 0 ELSE current_revision % 3 END AS INT)) AS company_id, natural_key,
                        CAST(length(title) * 3 % 101 AS INT) AS score, true AS should_notify FROM tender WHERE title IS NOT NULL),
     c AS (SELECT r.company_id, r.natural_key, r.score, t.bid_deadline_date, date_diff('day', DATE '2026-08-29', t.bid_deadline_date) AS days_left
           FROM results r JOIN tender t USING (natural_key) JOIN organization o ON o.id = t.organization_id
           WHERE r.score >= 50 AND t.status = 'open'
             AND NOT coalesce(TIMESTAMP '2026-08-29 09:00:00' > CAST(strftime(t.bid_deadline_date, '%Y-%m-%d') || ' ' || coalesce(t.bid_deadline_time || ':00', '23:59:59') AS TIMESTAMP), false))
"""


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Decisions derived from the tenders themselves, for the digest."""
    t = read(spark, d, "tender").where("title is not null")
    company = F.concat(F.lit("co-"), F.coalesce(F.col("current_revision") % 3, F.lit(0)).cast("string"))
    return t.select(company.alias("company_id"), "natural_key", (F.length("title") * 3 % 101).cast("int").alias("score"), F.lit(True).alias("should_notify"), F.lit("").alias("reason"))


def _top(spark: SparkSession, d: str) -> DataFrame:
    return digest.ranked(digest.candidates(_results(spark, d), read(spark, d, "tender"), read(spark, d, "organization"), NOW))


@_query(
    _RESULTS
    + """SELECT company_id, natural_key, score, days_left, CAST(n AS INT) AS rank, total AS total_matched, greatest(total - 10, 0) AS omitted_count FROM (
         SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY coalesce(days_left, 1000000), score DESC, natural_key) AS n, count(*) OVER (PARTITION BY company_id) AS total FROM c) WHERE n <= 10"""
)
def r_digest(spark: SparkSession, d: str) -> DataFrame:
    """Top items of each company's message."""
    return _top(spark, d).select("company_id", "natural_key", "score", F.col("days_left").cast("bigint").alias("days_left"), "rank", "total_matched", "omitted_count")


@_query(
    _RESULTS
    + f""", k AS (SELECT c.*, row_number() OVER (PARTITION BY company_id ORDER BY coalesce(days_left, {digest.NO_DEADLINE}), score DESC, natural_key) AS n, count(*) OVER (PARTITION BY company_id) AS total FROM c),
     i AS (SELECT k.company_id, k.n, k.total, '[関連度' || lpad(CAST(k.score AS VARCHAR), 3, ' ') || '] ' || coalesce(t.title, 'null') || chr(10) || '  機関   : ' || coalesce(o.name, 'null') || chr(10) || '  締切   : '
                  || CASE WHEN t.bid_deadline_date IS NULL THEN '記載なし' ELSE strftime(t.bid_deadline_date, '%Y-%m-%d') || CASE WHEN t.bid_deadline_time IS NULL THEN '（時刻記載なし）' ELSE ' ' || t.bid_deadline_time || '必着' END END
                  || CASE WHEN k.days_left IS NULL THEN '' ELSE '（あと' || k.days_left || '日）' END || chr(10) || '  予定価格: '
                  || CASE WHEN t.price_undisclosed THEN '非公表' WHEN t.estimated_price IS NULL THEN '記載なし' ELSE format('{{:,}}', t.estimated_price) || '円' END
                  || chr(10) || '  理由   : ' || chr(10) || '  原文   : ' || coalesce(t.source_url, 'null') AS item
           FROM k JOIN tender t USING (natural_key) JOIN organization o ON o.id = t.organization_id WHERE k.n <= {digest.MAX_ITEMS}),
     m AS (SELECT company_id, max(total) AS total, count(*) AS shown, string_agg(item, chr(10) || chr(10) ORDER BY n) AS body FROM i GROUP BY 1)
SELECT x.company_id, '【入札案件通知】2026-08-29 の新着案件' || CASE WHEN m.company_id IS NULL THEN chr(10) || chr(10) || '本日は条件に合う新着案件がありませんでした。'
         ELSE '（' || m.total || '件）' || chr(10) || chr(10) || m.body
              || CASE WHEN m.total > m.shown THEN chr(10) || chr(10) || 'ほか ' || (m.total - m.shown) || ' 件は本メールに掲載していません（該当 ' || m.total || ' 件中 ' || m.shown || ' 件を表示）。すべての案件は管理画面でご確認ください。' ELSE '' END
         END || chr(10) || chr(10) || '{digest.DISCLAIMER}' AS message
FROM (SELECT DISTINCT company_id FROM results) x LEFT JOIN m USING (company_id)"""
)
def r_digest_text(spark: SparkSession, d: str) -> DataFrame:
    companies = _results(spark, d).select("company_id").distinct()
    return digest.render(_top(spark, d), companies, NOW)


_SPEC_PROFILES = [
    ("co-works", ["設計業務委託", "改修工事"], [], [], ["清掃", "Web"], ["警備"], 1_000_000, None),
    ("co-supply", ["購入"], [], [], [], [], None, 50_000_000),
]
_STUB_SCORE = 55


def _spec_cap(company: str) -> int:
    return 50 if company == "co-works" else 7


def _stage_three(spark: SparkSession, d: str) -> DataFrame:
    """Every tender with the text of its first readable attachment through all three stages, judged by the stub under a budget."""
    profiles = spark.createDataFrame(_SPEC_PROFILES, match.PROFILE)
    caps = spark.createDataFrame([(p[0], _spec_cap(p[0])) for p in _SPEC_PROFILES], "company_id string, cap int")
    read_ok = read(spark, d, "extraction_result").where("status = 'ok' and text is not null and natural_key is not null")
    specs = read_ok.groupBy("natural_key").agg(F.min_by("text", "id").alias("spec_text"))
    rows = read(spark, d, "tender").where("natural_key is not null and title is not null").groupBy("natural_key").agg(F.min(F.struct("title", "estimated_price")).alias("t"))
    tenders = rows.join(specs, "natural_key", "left").select("natural_key", "t.title", F.col("t.estimated_price").alias("amount"), F.lit(None).cast("string").alias("prefecture_code"), "spec_text")
    decided = materialize(match.cascade(tenders, profiles, True))
    texts = profiles.select("company_id", match.profile_text().alias("profile_text"))
    pairs = decided.where("to_judge").select("natural_key", "company_id", F.concat_ws("/", "natural_key", "company_id").alias("seq"), "title", "spec_text").join(texts, "company_id")
    planned = judge.plan_calls(judge.with_keys(pairs), spark.createDataFrame([], "cache_key string"), spark.createDataFrame([], "company_id string, used bigint"), caps)
    said = planned.where("action <> 'over'").withColumn("v", judge.stub(F.col("title"), F.col("spec_text"), F.col("profile_text"), _STUB_SCORE)).withColumn("cache_hit", F.col("action") == "hit")
    verdicts = said.select("natural_key", "company_id", F.col("v.score").alias("verdict_score"), "v.input_tokens", "v.output_tokens", "cache_hit", judge.cost(F.col("v.input_tokens"), F.col("v.output_tokens"), F.col("cache_hit")).alias("cost_jpy"))
    return match.apply_verdicts(decided, verdicts)


def _grams_sql(x: str) -> str:
    return rf"regexp_replace(lower({x}), '(?:{_BLANK_SQL}|[,、。・/／\-−ー()（）\[\]【】])+', '', 'g')"


def _stage_three_sql() -> str:
    entries = ", ".join(f"('{p[0]}', {i}, '{e}')" for p in _SPEC_PROFILES for i, e in enumerate([*p[1], *p[4]]))
    listed = lambda xs: "[" + ", ".join(f"'{x.lower()}'" for x in xs) + "]::VARCHAR[]"
    told = lambda p: "\n".join([f"業種・営業品目: {'、'.join(p[1]) or '指定なし'}", "対応エリア: 指定なし", "保有資格: 指定なし", f"注目キーワード: {'、'.join(p[4]) or '指定なし'}", f"対応可能金額: {p[6]}〜{p[7]}"])
    prof = ", ".join(f"('{p[0]}', {listed(p[4])}, {listed(p[5])}, {p[6] or 'NULL'}::BIGINT, {p[7] or 'NULL'}::BIGINT, {_spec_cap(p[0])}, {len(told(p))})" for p in _SPEC_PROFILES)
    flat = _flat_sql
    return f"""
WITH entries(company_id, pos, entry) AS (VALUES {entries}),
     prof(company_id, kw, ng, lo, hi, cap, chars) AS (VALUES {prof}),
     spec AS (SELECT natural_key, arg_min(text, id) AS spec FROM extraction_result WHERE status = 'ok' AND text IS NOT NULL AND natural_key IS NOT NULL GROUP BY 1),
     tt AS (SELECT natural_key, title, estimated_price AS amount, {_nfkc_sql('title')} AS n, spec FROM (SELECT * FROM tender WHERE title IS NOT NULL AND natural_key IS NOT NULL) LEFT JOIN spec USING (natural_key)),
     texts AS (SELECT natural_key AS id, {_grams_sql('n')} AS s FROM tt UNION ALL SELECT company_id || '#' || pos, {_grams_sql('entry')} FROM entries),
     g AS (SELECT id, substr(s, CAST(i AS INT), 2) AS gram, count(*) AS n FROM (SELECT id, s, unnest(range(1, greatest(length(s), 2))) AS i FROM texts WHERE length(s) >= 1) GROUP BY 1, 2),
     nn AS (SELECT id, sum(n * n) AS norm FROM g GROUP BY 1),
     sc AS (SELECT a.id AS natural_key, b.id AS e, sum(a.n * b.n) / (sqrt(CAST(any_value(x.norm) AS DOUBLE)) * sqrt(CAST(any_value(y.norm) AS DOUBLE))) AS score
            FROM g a JOIN g b ON a.gram = b.gram AND contains(b.id, '#') AND NOT contains(a.id, '#') JOIN nn x ON x.id = a.id JOIN nn y ON y.id = b.id GROUP BY 1, 2),
     best AS (SELECT natural_key, split_part(e, '#', 1) AS company_id, max(score) AS score FROM sc GROUP BY 1, 2),
     x AS (SELECT tt.*, prof.*, coalesce(best.score, 0.0) AS sim, len(list_filter(ng, lambda k: contains(lower(n), k))) > 0 AS excluded, len(list_filter(kw, lambda k: contains(lower(n), k))) > 0 AS hit
           FROM tt CROSS JOIN prof LEFT JOIN best ON best.natural_key = tt.natural_key AND best.company_id = prof.company_id),
     y AS (SELECT *, hit AND NOT excluded AS kh, NOT excluded AND (amount IS NULL OR ((lo IS NULL OR amount >= lo) AND (hi IS NULL OR amount <= hi))) AS promote, sim >= CASE WHEN spec IS NOT NULL THEN {match.RELAXED} ELSE {match.STRICT} END AS near FROM x),
     d AS (SELECT *, promote AND near AS p2, promote AND near AND spec IS NOT NULL AS asked,
                  CASE WHEN excluded THEN 0 WHEN NOT promote THEN CASE WHEN kh THEN 50 ELSE 0 END ELSE greatest(CASE WHEN kh THEN 50 ELSE 0 END, floor(sim * 100)) END AS points FROM y),
     q AS (SELECT natural_key, company_id, cap, {flat('title')} || chr(0) || {flat(f"substr(spec, 1, {identity.SPEC_CHARS})")} || chr(0) || company_id AS content, floor((length(title) + length(substr(spec, 1, {identity.SPEC_CHARS})) + chars) * {judge.STUB_RATE}) AS tokens FROM d WHERE asked),
     r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY natural_key || '/' || company_id) AS k FROM q),
     b AS (SELECT content, row_number() OVER (PARTITION BY company_id ORDER BY natural_key || '/' || company_id) <= cap AS paid FROM r WHERE k = 1),
     v AS (SELECT r.natural_key, r.company_id, r.k > 1 AS cache_hit, CASE WHEN r.k > 1 THEN 0.0 ELSE (r.tokens * {judge.IN_RATE} + {judge.STUB_OUT} * {judge.OUT_RATE}) / 1e6 END AS cost FROM r JOIN b USING (content) WHERE b.paid),
     o AS (SELECT d.natural_key, d.company_id, CASE WHEN v.natural_key IS NOT NULL THEN 3 WHEN promote THEN 2 ELSE 1 END AS stage,
                  CAST(CASE WHEN v.natural_key IS NOT NULL THEN greatest({_STUB_SCORE}, CASE WHEN kh THEN 50 ELSE 0 END) ELSE points END AS INT) AS score,
                  CASE WHEN v.natural_key IS NOT NULL THEN 'llm' WHEN excluded THEN 'none' WHEN kh THEN 'rule' WHEN promote THEN 'vector' ELSE 'none' END AS matched_by,
                  CASE WHEN v.natural_key IS NOT NULL THEN {_STUB_SCORE} >= {match.NOTIFY_SCORE} OR kh ELSE NOT excluded AND (kh OR p2) END AS should_notify,
                  v.natural_key IS NOT NULL AND kh AND {_STUB_SCORE} < {match.NOTIFY_SCORE} AS llm_overridden, v.cache_hit, coalesce(v.cost, 0.0) AS cost_jpy
           FROM d LEFT JOIN v ON v.natural_key = d.natural_key AND v.company_id = d.company_id)
"""


@_query(_stage_three_sql() + "SELECT natural_key, company_id, stage, score, matched_by, should_notify, llm_overridden, cache_hit, round(cost_jpy, 6) AS cost_jpy FROM o")
def r_judged(spark: SparkSession, d: str) -> DataFrame:
    """Decisions of all three stages with the judge's verdicts, cache hits and costs."""
    names = ("natural_key", "company_id", "stage", "score", "matched_by", "should_notify", "llm_overridden", "cache_hit")
    return _stage_three(spark, d).select(*names, F.round("cost_jpy", 6).alias("cost_jpy"))


@_query(
    _stage_three_sql()
    + """SELECT company_id, count(*) AS total, CAST(count_if(stage >= 2) AS BIGINT) AS stage_2, CAST(count_if(stage = 3) AS BIGINT) AS stage_3, CAST(count_if(stage = 3 AND NOT cache_hit) AS BIGINT) AS billed,
       CAST(count_if(stage = 3 AND cache_hit) AS BIGINT) AS cache_hits, round(sum(cost_jpy), 6) AS cost_jpy, CAST(count_if(should_notify) AS BIGINT) AS notified, round(count_if(stage = 3) / count(*)::DOUBLE, 9) AS stage_3_ratio FROM o GROUP BY 1"""
)
def r_judged_funnel(spark: SparkSession, d: str) -> DataFrame:
    """How far tenders with specifications went and what that cost."""
    got = match.funnel(_stage_three(spark, d))
    return got.withColumns({"cost_jpy": F.round("cost_jpy", 6), "stage_3_ratio": F.round("stage_3_ratio", 9)})


@_query(f"""
SELECT e.id, sha256({_flat_sql('t.title')} || chr(0) || {_flat_sql(f'substr(e.text, 1, {identity.SPEC_CHARS})')} || chr(0) || {_flat_sql('e.file_ext')}) AS cache_key
FROM extraction_result e LEFT JOIN (SELECT DISTINCT ON (natural_key) natural_key, title FROM tender WHERE natural_key IS NOT NULL) t USING (natural_key) WHERE e.id IS NOT NULL""")
def r_cache_keys(spark: SparkSession, d: str) -> DataFrame:
    """Content keys of attachments beside their tender's title."""
    titles = read(spark, d, "tender").where("natural_key is not null").groupBy("natural_key").agg(F.first("title").alias("title"))
    rows = read(spark, d, "extraction_result").where("id is not null").join(titles, "natural_key", "left")
    return rows.select("id", identity.cache_key(F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")), F.coalesce("file_ext", F.lit(""))).alias("cache_key"))


def _cases(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cases = read(spark, d, "doc_label").select(F.col("doc_id").alias("case_id"), (F.col("label") == "prose").alias("relevant"))
    told = F.coalesce(F.col("n_chars") >= 100, F.lit(False))
    return cases, read(spark, d, "documents").select(F.col("doc_id").alias("case_id"), told.alias("notified"), metrics.had_a_chance(told, F.when(F.col("lang") == "ja", 3).otherwise(2)).alias("had_a_chance"))


_EVAL = """
WITH j AS (SELECT l.doc_id AS case_id, l.label = 'prose' AS r, coalesce(d.n_chars >= 100, false) AS n, coalesce(coalesce(d.n_chars >= 100, false) OR d.lang = 'ja', false) AS h
           FROM doc_label l LEFT JOIN documents d USING (doc_id))
"""


@_query(
    _EVAL
    + """, m AS (SELECT CAST(count_if(r AND n) AS BIGINT) AS tp, CAST(count_if(NOT r AND n) AS BIGINT) AS fp, CAST(count_if(NOT r AND NOT n) AS BIGINT) AS tn, CAST(count_if(r AND NOT n) AS BIGINT) AS fn, CAST(count_if(r AND h) AS BIGINT) AS re FROM j)
SELECT tp AS true_positive, fp AS false_positive, tn AS true_negative, fn AS false_negative, re AS reachable, round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 1.0), 9) AS recall,
       round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 1.0), 9) AS precision, round(coalesce(re / nullif(tp + fn, 0)::DOUBLE, 1.0), 9) AS reachability,
       round(1 - coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 1.0), 9) AS miss_rate,
       1 - coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 1.0) <= 0.03 AND coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 1.0) >= 0.7 AS targets_met
FROM m"""
)
def r_metrics(spark: SparkSession, d: str) -> DataFrame:
    got = metrics.evaluate(*_cases(spark, d))
    return got.withColumns({c: F.round(c, 9) for c in ("recall", "precision", "reachability", "miss_rate")})


@_query(_EVAL + "SELECT case_id, r AS relevant FROM j WHERE r AND NOT n")
def r_misses(spark: SparkSession, d: str) -> DataFrame:
    return metrics.misses(*_cases(spark, d))


@_query("""
WITH p AS (SELECT id, natural_key, 'co-' || (id % 3) AS company_id, sha256('co-' || (id % 3) || text) AS k FROM extraction_result WHERE text IS NOT NULL AND id IS NOT NULL),
     f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) AS n FROM p),
     c AS (SELECT k, row_number() OVER (PARTITION BY company_id ORDER BY id) <= 50 AS paid FROM f WHERE n = 1)
SELECT f.id, f.company_id, CASE WHEN NOT c.paid THEN 'over' WHEN f.n = 1 THEN 'call' ELSE 'hit' END AS action FROM f JOIN c USING (k)""")
def r_judge_plan(spark: SparkSession, d: str) -> DataFrame:
    """Which texts would be judged, found in the cache or left for want of budget."""
    e = read(spark, d, "extraction_result").where("text is not null and id is not null")
    company = F.concat(F.lit("co-"), (F.col("id") % 3).cast("string"))
    pairs = e.select("id", company.alias("company_id"), F.col("id").alias("seq"), F.sha2(F.concat(company, F.col("text")), 256).alias("cache_key"))
    none = pairs.limit(0)
    caps = spark.range(3).select(F.concat(F.lit("co-"), F.col("id").cast("string")).alias("company_id"), F.lit(judge.MONTHLY_CAP).alias("cap"))
    return judge.plan_calls(pairs, none.select("cache_key"), none.select("company_id", F.lit(0).alias("used")), caps).select("id", "company_id", "action")


@_query("""
SELECT organization_id, count(*) AS n, round(avg(length(title)), 6) AS title_length, round(avg(CASE WHEN bid_deadline_date IS NULL THEN 1.0 ELSE 0.0 END), 6) AS no_deadline,
       round(avg(CASE WHEN natural_key_anchor = 'none' THEN 1.0 ELSE 0.0 END), 6) AS weak_keys,
       round(avg(length(CAST(estimated_price AS VARCHAR))), 6) AS price_digits,
       avg(CASE WHEN natural_key_anchor = 'none' THEN 1.0 ELSE 0.0 END) > 0.1 AS weak_alert
FROM tender GROUP BY 1""")
def r_data_health(spark: SparkSession, d: str) -> DataFrame:
    """Extension: shifts in titles, deadlines, keys and prices of each source."""
    got = data_health.by_source(read(spark, d, "tender"))
    return got.withColumns({c: F.round(c, 6) for c in ("title_length", "no_deadline", "weak_keys", "price_digits")})

"""Vocabularies, table schemas and the constraints that Parquet cannot hold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Controlled vocabularies.
BID_METHOD = ("open", "selective", "negotiated", "proposal", "unknown")
TENDER_STATUS = ("open", "corrected", "cancelled", "closed")
CRAWLER_KIND = ("http", "browser")
CRAWL_STATUS = ("running", "ok", "ok_empty", "partial", "failed", "disabled")
EXTRACTION_STATUS = ("ok", "unsupported_scanned", "unsupported_format", "fetch_failed", "skipped")
CHANGE_KIND = ("new", "corrected", "recall", "cancelled")
TIME_SOURCE = ("explicit", "absent")
TAX_BASIS = ("included", "excluded", "unknown")
ANCHOR_KIND = ("announced", "bid_deadline", "none")
INGEST_OUTCOME = ("inserted", "updated", "unchanged")
MATCHED_BY = ("rule", "vector", "llm", "none")
HEALTH_STATE = ("healthy", "never_run", "disabled", "failed", "empty", "volume_drop", "stale", "warming_up")
NO_ALERT = ("healthy", "warming_up")


def _struct(spec: str) -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType(), "ntz": T.TimestampNTZType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "strings": T.ArrayType(T.StringType()), "map": T.MapType(T.StringType(), T.StringType()), "diff": T.MapType(T.StringType(), T.ArrayType(T.StringType()))}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (f.split(":") for f in spec.split())])


TABLES = {
    "organization": _struct("id:string name:string org_type:string prefecture_code:string entry_url:string crawler_id:string crawler_kind:string enabled:boolean notes:string"),
    "crawl_run": _struct("id:bigint organization_id:string target_date:date attempt:int started_at:ntz finished_at:ntz status:string fetched_count:bigint inserted_count:bigint updated_count:bigint error_kind:string error_message:string"),
    "tender": _struct(
        "natural_key:string natural_key_version:int natural_key_anchor:string organization_id:string source_url:string source_captured_at:ntz external_ref:string title:string title_normalized:string method:string announced_date:date "
        "qa_deadline_date:date qa_deadline_time:string application_deadline_date:date application_deadline_time:string bid_deadline_date:date bid_deadline_time:string bid_deadline_ambiguous:boolean estimated_price:bigint price_undisclosed:boolean "
        "price_tax_basis:string price_raw:string place_prefecture_code:string qualification_note:string status:string current_revision:int first_seen_at:ntz last_seen_at:ntz"
    ),
    "tender_revision": _struct("natural_key:string revision:int change_kind:string diff:diff raw_payload:map recorded_at:ntz"),
    "company": _struct("id:string name:string plan:string llm_monthly_cap:int"),
    "company_profile": _struct("company_id:string categories:strings prefectures:strings qualifications:strings keywords:strings ng_keywords:strings price_min:bigint price_max:bigint"),
    "match_result": _struct("natural_key:string company_id:string stage:int score:int reason:string matched_by:string should_notify:boolean input_tokens:bigint output_tokens:bigint cost_jpy:double cache_hit:boolean feedback:string evaluated_at:ntz"),
    "llm_cache": _struct("cache_key:string created_at:ntz hit_count:bigint response_json:string input_tokens:bigint output_tokens:bigint"),
    "attachment": _struct("natural_key:string file_url:string extraction_status:string text:string chars:int file_ext:string note:string"),
    "raw_tender": _struct("organization_id:string source_url:string captured_at:ntz title:string external_ref:string method_text:string announced_text:string qa_deadline_text:string application_deadline_text:string bid_deadline_text:string price_text:string place_text:string qualification_text:string attachment_urls:strings raw_payload:map"),
}
#: Notices that can have no key, as far as they could be read.
TABLES["tender_rejected"] = TABLES["tender"]


@dataclass(frozen=True)
class Check:
    """A row constraint: ``ok`` is a SQL predicate; null passes, as in a table constraint."""

    table: str
    name: str
    ok: str


def _within(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


CHECKS = (
    Check("organization", "crawler_kind", _within("crawler_kind", CRAWLER_KIND)),
    Check("crawl_run", "status", _within("status", CRAWL_STATUS)),
    Check("tender", "status", _within("status", TENDER_STATUS)),
    Check("tender", "undisclosed_has_no_price", "NOT (coalesce(price_undisclosed, false) AND estimated_price IS NOT NULL)"),
    Check("tender", "method", _within("method", BID_METHOD)),
    Check("tender", "price_tax_basis", _within("price_tax_basis", TAX_BASIS)),
    Check("tender_revision", "change_kind", _within("change_kind", CHANGE_KIND)),
    Check("match_result", "stage", "stage BETWEEN 1 AND 3"),
    Check("match_result", "matched_by", _within("matched_by", MATCHED_BY)),
    Check("attachment", "extraction_status", _within("extraction_status", EXTRACTION_STATUS)),
    Check("extraction_result", "status", _within("status", EXTRACTION_STATUS)),
)
#: Unique keys.
KEYS = {
    "organization": ("id",),
    "crawl_run": ("organization_id", "target_date", "attempt"),
    "tender": ("natural_key",),
    "tender_revision": ("natural_key", "revision"),
    "company": ("id",),
    "company_profile": ("company_id",),
    "match_result": ("natural_key", "company_id"),
    "llm_cache": ("cache_key",),
    "attachment": ("natural_key", "file_url"),
    "extraction_result": ("id",),
}


def violations(df: DataFrame, table: str) -> DataFrame:
    """(table_name, constraint, n) for every constraint of the table, 0 included.

    Row constraints are counted in one pass; a key counts its rows beyond the first.
    """
    checks = [c for c in CHECKS if c.table == table]
    counts = df.agg(*[F.count_if(~F.expr(c.ok)).alias(c.name) for c in checks]) if checks else None
    out = None
    if counts is not None:
        out = counts.select(F.explode(F.array(*[F.struct(F.lit(c.name).alias("constraint"), F.col(c.name).alias("n")) for c in checks])).alias("x")).select("x.*")
    if table in KEYS:
        again = df.groupBy(*KEYS[table]).agg(F.count(F.lit(1)).alias("k")).agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("n"))
        unique = again.select(F.lit("unique").alias("constraint"), F.col("n").cast("bigint"))
        out = unique if out is None else out.unionByName(unique)
    return out.select(F.lit(table).alias("table_name"), "constraint", "n")


def enforce(df: DataFrame, table: str) -> DataFrame:
    """df, failing the job on the first row that breaks a row constraint."""
    for c in (c for c in CHECKS if c.table == table):
        broken = F.coalesce(~F.expr(c.ok), F.lit(False))
        df = df.where(F.when(broken, F.raise_error(F.lit(f"{table}: {c.name}"))).otherwise(F.lit(True)).cast("boolean"))
    return df


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and type; an unknown column is an error, a missing one is null."""
    unknown = set(df.columns) - set(TABLES[table].names)
    if unknown:
        raise ValueError(f"{table} has no column {sorted(unknown)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[table]])


def changed(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)

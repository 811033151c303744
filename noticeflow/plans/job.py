"""The whole course over a store: listing pages to tenders, decisions and messages.

    python -m noticeflow.plans.job STORE crawl --pages DIR --source ID --organization ID --base URL
    python -m noticeflow.plans.job STORE health | match | digest | funnel

Every step reads tables of the store and writes new versions of them; a step that
dies leaves the versions before it in force and can be run again. Steps are batch
operators over whole tables: all companies and organizations at once.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.operators import digest, health, ingest, judge, lifecycle, match, reports
from noticeflow.schemas import TABLES
from noticeflow.sources import html_listing
from noticeflow.sources.registry import Source, organizations, source_table
from noticeflow.sources.store import Store
from noticeflow.storage import materialize, ship

LARGEST_PAGE = 25 * 1024 * 1024


def init(store: Store, sources: list[Source]) -> None:
    """Register the organizations of the sources; known ones take the new values."""
    new = organizations(source_table(store.spark, sources))
    old = store.read("organization").join(new.select("id"), "id", "left_anti")
    store.replace("organization", old.unionByName(new, allowMissingColumns=True))


def crawl(store: Store, pages: DataFrame, source: Source, now: dt.datetime) -> dict[str, int]:
    """Pages (page_id, base_url, content) of one source into the store; counts of the run.

    A source of which any page lacks its container has failed: nothing of it is
    taken in, and the run is logged as failed.
    """
    at = F.lit(now).cast("timestamp_ntz")
    parsed = materialize(html_listing.parse_pages(pages, source.layout))
    status = html_listing.listing_status(parsed).agg(F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    runs = store.read_appended("crawl_run")
    mine = runs.where((F.col("organization_id") == source.organization_id) & (F.col("target_date") == F.lit(now.date())))
    attempt = mine.agg(F.coalesce(F.max("attempt"), F.lit(0))).first()[0] + 1
    run = {"organization_id": source.organization_id, "target_date": now.date(), "attempt": attempt, "started_at": now, "finished_at": now, "fetched_count": int(status["rows"]), "inserted_count": 0, "updated_count": 0}
    run["id"] = runs.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] + 1
    if status["failed"]:
        run |= {"status": "failed", "fetched_count": 0, "error_kind": "no container", "error_message": f"{status['failed']} pages without their list"}
    else:
        typed, rejected = ingest.quarantine(ingest.normalize(html_listing.raw_tenders(parsed, source.organization_id, at)))
        order = ["source_captured_at", "source_url"]
        folded = materialize(ingest.fold(store.read("tender"), typed, order, seen_at="source_captured_at"))
        part = f"{source.id}-{now:%Y%m%dT%H%M%S}"
        store.append("tender_rejected", rejected, part)
        store.append("tender_revision", ingest.history(folded, "source_captured_at"), part)
        merged = ingest.merge(store.read("tender"), folded, order, "source_captured_at")
        store.replace("tender", lifecycle.close_expired(merged, now))
        n = folded.agg(F.count_if(F.col("outcome") == "inserted").alias("i"), F.count_if(F.col("outcome") == "updated").alias("u")).first()
        run |= {"status": "ok" if run["fetched_count"] else "ok_empty", "inserted_count": n["i"], "updated_count": n["u"]}
    store.append("crawl_run", store.spark.createDataFrame([{f: run.get(f) for f in TABLES["crawl_run"].names}], TABLES["crawl_run"]), f"{source.id}-{run['id']}")
    return run


def report_health(store: Store, now: dt.datetime) -> tuple[DataFrame, int]:
    """(lines, exit code)."""
    report = materialize(health.evaluate(store.read("organization"), store.read_appended("crawl_run"), now))
    gone = lifecycle.disappeared(store.read("tender"), now)
    lines = reports.health_lines(report).orderBy(F.desc("is_alert"), "organization_id").select("organization_id", "line")
    return lines.unionByName(reports.disappeared_lines(gone)), health.exit_code(report)


def save_profiles(store: Store, profiles: DataFrame) -> None:
    """Profiles (with llm_monthly_cap) added or put in the place of those of the same company; unknown companies are added under their id."""
    companies = store.read("company")
    given = profiles.groupBy("company_id").agg(F.max(F.struct(*[c for c in profiles.columns if c != "company_id"])).alias("p")).select("company_id", "p.*")
    caps = given.select(F.col("company_id").alias("id"), F.coalesce("llm_monthly_cap", F.lit(judge.MONTHLY_CAP)).alias("cap"))
    joined = companies.join(caps, "id", "full_outer")
    store.replace("company", joined.select("id", F.coalesce("name", "id").alias("name"), "plan", F.coalesce("cap", "llm_monthly_cap").cast("int").alias("llm_monthly_cap")))
    kept = store.read("company_profile").join(given.select("company_id"), "company_id", "left_anti")
    store.replace("company_profile", kept.unionByName(given.select(*[F.col(f.name).cast(f.dataType) for f in TABLES["company_profile"]])))


def decide(store: Store, now: dt.datetime, client: judge.Client | None = None) -> DataFrame:
    """Decisions for every open tender and company, through the judge where there is one; recorded in match_result."""
    profiles = match.load_profiles(store.read("company"), store.read("company_profile"))
    texts = store.read_appended("attachment").where("extraction_status = 'ok'").groupBy("natural_key").agg(F.min_by("text", "file_url").alias("spec_text"))
    tenders = store.read("tender").where("status = 'open'").join(texts, "natural_key", "left")
    tenders = tenders.select("natural_key", "title", F.col("estimated_price").alias("amount"), F.col("place_prefecture_code").alias("prefecture_code"), "spec_text")
    decided = materialize(match.cascade(tenders, profiles.select(*[c.split()[0] for c in match.PROFILE.split(", ")]), client is not None))
    none = store.spark.createDataFrame([], "natural_key string, company_id string, verdict_score int, input_tokens bigint, output_tokens bigint, cache_hit boolean, cost_jpy double")
    verdicts, before = none, store.read("match_result")
    if client is not None:
        told = profiles.select("company_id", match.profile_text().alias("profile_text"))
        pairs = decided.where("to_judge").select("natural_key", "company_id", F.concat_ws("/", "natural_key", "company_id").alias("seq"), "title", "spec_text").join(told, "company_id")
        used = judge.billed_this_month(before, F.lit(now).cast("timestamp_ntz"))
        caps = profiles.select("company_id", F.col("llm_monthly_cap").alias("cap"))
        verdicts, cache = judge.judge(pairs, store.read("llm_cache"), used, caps, client)
        store.replace("llm_cache", cache.withColumn("created_at", F.lit(now).cast("timestamp_ntz")))
        verdicts = verdicts.drop("reason", "summary")
    final = match.apply_verdicts(decided, verdicts).withColumns({"evaluated_at": F.lit(now).cast("timestamp_ntz"), "feedback": F.lit(None).cast("string")})
    new = final.select(*TABLES["match_result"].names)
    store.replace("match_result", match.record(before, new, "evaluated_at"))
    return store.read("match_result")


def messages(store: Store, now: dt.datetime) -> DataFrame:
    """(company_id, message) of every company."""
    found = digest.candidates(store.read("match_result"), store.read("tender"), store.read("organization"), now)
    return digest.render(digest.ranked(found), store.read("company").select(F.col("id").alias("company_id")), now)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("store")
    parser.add_argument("step", choices=("crawl", "health", "match", "digest", "funnel"))
    for name in ("pages", "source", "organization", "base"):
        parser.add_argument(f"--{name}", default="")
    given = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    ship(spark)
    store, now = Store(spark, given.store), dt.datetime.now()
    if given.step == "crawl":
        source = Source(given.source, "http", given.organization, given.organization, given.base)
        init(store, [source])
        run = crawl(store, html_listing.read_pages(spark, given.pages, given.base, LARGEST_PAGE), source, now)
        print(f"{run['organization_id']}: {run['status']}, {run['fetched_count']} rows, {run['inserted_count']} new, {run['updated_count']} changed")
        return int(run["status"] == "failed")
    if given.step == "health":
        lines, code = report_health(store, now)
        print("\n".join(r["line"] for r in lines.toLocalIterator()))
        return code
    if given.step == "match":
        print("\n".join(f"{r['company_id']}: {r['n']}" for r in decide(store, now).groupBy("company_id").agg(F.count_if("should_notify").alias("n")).toLocalIterator()))
        return 0
    told = messages(store, now).select(F.col("message").alias("text")) if given.step == "digest" else reports.funnel_lines(match.funnel(store.read("match_result"))).select("text")
    print("\n\n".join(r["text"] for r in told.toLocalIterator()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

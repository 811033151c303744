"""Ranked, capped message of what a company should see."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeflow.functions import money, temporal

# Fixed values.
MIN_SCORE, MAX_ITEMS, NO_DEADLINE = 50, 10, 1_000_000
DISCLAIMER = "※ 本内容はAIによる推定を含みます。情報の正確性・網羅性は保証されません。応札の判断前に必ず発注機関の原文をご確認ください。"


def candidates(results: DataFrame, tenders: DataFrame, organizations: DataFrame, now: dt.datetime, min_score: int = MIN_SCORE) -> DataFrame:
    """Open, unexpired tenders to be notified, with what the message shows, for every company."""
    moment = F.lit(now).cast("timestamp_ntz")
    wanted = results.where(F.col("should_notify") & (F.col("score") >= min_score)).select("company_id", "natural_key", "score", "reason")
    t = tenders.where(F.col("status") == "open").select("natural_key", "organization_id", "title", "source_url", "bid_deadline_date", "bid_deadline_time", "estimated_price", "price_undisclosed")
    t = t.where(~temporal.is_closed(F.col("bid_deadline_date"), F.col("bid_deadline_time"), moment))
    names = organizations.select(F.col("id").alias("organization_id"), F.col("name").alias("organization_name"))
    return (
        wanted.join(t, "natural_key")
        .join(names, "organization_id")
        .select(
            "company_id", "natural_key", "title", "organization_name", "score", "reason", "source_url",
            temporal.display_deadline(F.col("bid_deadline_date"), F.col("bid_deadline_time")).alias("deadline_display"),
            temporal.calendar_days(F.col("bid_deadline_date"), moment).alias("days_left"),
            money.display_price(F.col("estimated_price"), F.col("price_undisclosed")).alias("price_display"),
        )
    )


def ranked(found: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """The first items of each company, nearest deadline first, with total_matched and omitted_count.

    Top k per company by a window that the optimizer limits before the shuffle;
    the total comes from an aggregate of its own, so no company's rows are
    gathered to be counted.
    """
    order = [F.coalesce("days_left", F.lit(NO_DEADLINE)), F.desc("score"), F.col("natural_key")]
    top = found.withColumn("rank", F.row_number().over(Window.partitionBy("company_id").orderBy(*order))).where(F.col("rank") <= max_items)
    totals = found.groupBy("company_id").agg(F.count(F.lit(1)).alias("total_matched"))
    return top.join(totals, "company_id").withColumn("omitted_count", F.greatest(F.col("total_matched") - max_items, F.lit(0)))


def below_min_score(results: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    """(company_id, below_min_score_count): what the score floor hides although it was to be notified."""
    return results.groupBy("company_id").agg(F.count_if(F.col("should_notify") & (F.col("score") < min_score)).alias("below_min_score_count"))


def render(top: DataFrame, companies: DataFrame, now: dt.datetime) -> DataFrame:
    """(company_id, message) for every company, also those without items; cut items are always mentioned."""
    days = F.when(F.col("days_left").isNotNull(), F.format_string("（あと%d日）", "days_left")).otherwise("")
    item = F.concat(
        F.format_string("[関連度%3d] %s\n  機関   : %s\n  締切   : %s", "score", "title", "organization_name", "deadline_display"), days,
        F.format_string("\n  予定価格: %s\n  理由   : %s\n  原文   : %s", "price_display", "reason", "source_url"),
    )
    # at most max_items rows a company
    by = top.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("text")))).alias("items"), F.max("total_matched").alias("total"), F.max("omitted_count").alias("omitted"))
    head = f"【入札案件通知】{now:%Y-%m-%d} の新着案件"
    body = F.array_join(F.transform("items", lambda x: x["text"]), "\n\n")
    foot = F.when(F.col("omitted") > 0, F.format_string("\n\nほか %d 件は本メールに掲載していません（該当 %d 件中 %d 件を表示）。すべての案件は管理画面でご確認ください。", "omitted", "total", F.size("items"))).otherwise("")
    some = F.concat(F.format_string(head + "（%d件）\n\n", "total"), body, foot, F.lit("\n\n" + DISCLAIMER))
    none = F.lit(f"{head}\n\n本日は条件に合う新着案件がありませんでした。\n\n{DISCLAIMER}")
    return companies.select("company_id").join(by, "company_id", "left").select("company_id", F.coalesce(some, none).alias("message"))

"""Lines of text for people, from the frames of other operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# The formats of the lines, which scripts may read.
HEALTH_LINE = "%s %-20s %-12s %s"
BASELINE_LINE = "\n     直近=%d 平均=%.1f (n=%d)"
MARKS = {True: "🔴", False: "🟢"}
GONE_LINE, GONE_CHARS = "🟡 %s: 締切前に一覧から消えました (%d日) %s", 40
FUNNEL_LINES = {"total": "評価総数: %d", "stage_2": "2段目到達: %d", "stage_3": "3段目到達(LLM): %d", "billed": "うち課金: %d", "cache_hits": "うちキャッシュ: %d", "cost_jpy": "累計コスト: %.2f 円", "notified": "通知対象: %d"}


def health_lines(report: DataFrame) -> DataFrame:
    """(organization_id, is_alert, line); order by is_alert descending, then organization_id."""
    mark = F.element_at(F.create_map(*[F.lit(x) for pair in MARKS.items() for x in pair]), F.col("is_alert"))
    line = F.format_string(HEALTH_LINE, mark, "organization_id", "state", "reason")
    below = F.when(F.col("baseline_avg").isNotNull(), F.format_string(BASELINE_LINE, "latest_count", "baseline_avg", "baseline_samples"))
    return report.select("organization_id", "is_alert", F.concat_ws("", line, below).alias("line"))


def disappeared_lines(gone: DataFrame) -> DataFrame:
    """(organization_id, line) of tenders that left the listing before their deadline."""
    return gone.select("organization_id", F.format_string(GONE_LINE, "organization_id", "days_missing", F.substring("title", 1, GONE_CHARS)).alias("line"))


def funnel_lines(funnel: DataFrame) -> DataFrame:
    """(company_id, text) of the funnel, a line for each figure."""
    return funnel.select("company_id", F.concat_ws("\n", *[F.format_string(form, c) for c, form in FUNNEL_LINES.items()]).alias("text"))


def untraced(claimed: DataFrame, lines: DataFrame) -> DataFrame:
    """Requirement ids (id) that no line (value) of the sources mentions.

    Ids are cut out of the lines and made distinct before the anti join.
    """
    named = lines.select(F.explode(F.regexp_extract_all("value", F.lit(r"\b((?:FR|NFR|CR|DQ|KPI)-[0-9A-Za-z]+)\b"), 1)).alias("id")).distinct()
    return claimed.join(named, "id", "left_anti")

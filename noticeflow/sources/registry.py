"""Known listing sources, as a table.

A source is a row; what is looked up, by id or by kind, is a filter of the
table, and the listing operators join it like any other. Ids are unique and
kinds come from the vocabulary: ``source_table`` refuses rows that break that.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.schemas import CRAWLER_KIND
from noticeflow.sources.html_listing import Layout


@dataclass(frozen=True)
class Source:
    id: str
    kind: str
    organization_id: str
    organization_name: str
    entry_url: str
    layout: Layout = field(default_factory=Layout)


SOURCE = "id string, kind string, organization_id string, organization_name string, entry_url string, layout struct<{}>"


def faults(sources: Iterable[Source]) -> list[str]:
    """What is wrong with a list of sources, empty if nothing is."""
    listed = list(sources)
    ids = [s.id for s in listed]
    again = [f"source {i} is registered already" for i in sorted({i for i in ids if ids.count(i) > 1})]
    return again + [f"source {s.id} has the unknown kind {s.kind}" for s in listed if s.kind not in CRAWLER_KIND]


def source_table(spark: SparkSession, sources: Iterable[Source]) -> DataFrame:
    """(id, kind, organization_id, organization_name, entry_url, layout), ordered by id."""
    listed = list(sources)
    if wrong := faults(listed):
        raise ValueError("; ".join(wrong))
    layout = ", ".join(f"{name}: string" for name in asdict(Layout()))
    rows = [(s.id, s.kind, s.organization_id, s.organization_name, s.entry_url, tuple(asdict(s.layout).values())) for s in listed]
    return spark.createDataFrame(rows, SOURCE.format(layout)).orderBy("id")


def organizations(table: DataFrame) -> DataFrame:
    """Rows for the organization table that the sources bring with them; an organization of several sources comes once, by its smallest id."""
    first = table.groupBy("organization_id").agg(F.min_by(F.struct("organization_name", "entry_url", "id", "kind"), "id").alias("s"))
    return first.select(
        F.col("organization_id").alias("id"), F.col("s.organization_name").alias("name"), F.lit("municipality").alias("org_type"), F.col("s.entry_url").alias("entry_url"),
        F.col("s.id").alias("crawler_id"), F.col("s.kind").alias("crawler_kind"), F.lit(True).alias("enabled"),
    )

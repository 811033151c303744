"""Structured Streaming around the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from noticeflow.operators import ingest
from noticeflow.sources.store import Store


def ingest_stream(raw: DataFrame, store: Store, checkpoint: str, sequence: str = "source_captured_at") -> StreamingQuery:
    """Raw notices folded into the store batch by batch.

    A history part is named by its epoch and the version it was folded from. A
    batch that is run again after its version was replaced finds that part and
    is skipped; one that died before replaces its own part. Rows that can have no
    key are kept in tender_rejected, in a part of their epoch.
    """

    def one(batch: DataFrame, epoch: int) -> None:
        version = store.version("tender")
        root, fs = store._path("tender_revision")
        if fs.exists(root):
            names = [s.getPath().getName() for s in fs.listStatus(root)]
            bases = [int(n.rpartition("-v")[2]) for n in names if n.startswith(f"part=epoch-{epoch}-v")]
            if any(b < version for b in bases):
                return
        typed, rejected = ingest.quarantine(ingest.normalize(batch))
        store.append("tender_rejected", rejected, f"epoch-{epoch}")
        order = [sequence, "source_url"]
        folded = ingest.fold(store.read("tender"), typed, order, seen_at=sequence).cache()
        store.append("tender_revision", ingest.history(folded, sequence), f"epoch-{epoch}-v{version}")
        store.replace("tender", ingest.merge(store.read("tender"), folded, order, sequence))
        folded.unpersist()

    return raw.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def volume_by_day(runs: DataFrame, late: str = "2 days") -> DataFrame:
    """Fetched rows and ok runs per organization and day of a run stream, final once the watermark passes."""
    timed = runs.withColumn("at", F.col("started_at").cast("timestamp")).withWatermark("at", late)
    by = timed.where("status = 'ok'").groupBy(F.window("at", "1 day").alias("day"), "organization_id")
    return by.agg(F.sum("fetched_count").alias("fetched"), F.count(F.lit(1)).alias("runs")).select("organization_id", F.col("day.start").alias("day"), "fetched", "runs")

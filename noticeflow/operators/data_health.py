"""Extension: figures of a source's data whose shift tells a silent change.

Not part of the engine's parity; cheap aggregates over the current state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEAK_SHARE = 0.10


def by_source(tenders: DataFrame) -> DataFrame:
    """Mean title length, share without deadline, share of weak keys, mean digits of prices, per source."""
    weak = F.avg(F.when(F.col("natural_key_anchor") == "none", 1.0).otherwise(0.0))
    return tenders.groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.length("title")).alias("title_length"),
        F.avg(F.when(F.col("bid_deadline_date").isNull(), 1.0).otherwise(0.0)).alias("no_deadline"), weak.alias("weak_keys"),
        F.avg(F.length(F.col("estimated_price").cast("string"))).alias("price_digits"), (weak > WEAK_SHARE).alias("weak_alert"),
    )


def shifts(before: DataFrame, after: DataFrame, most: float = 0.5) -> DataFrame:
    """Sources whose figures moved by more than a share between two states."""
    names = ("title_length", "no_deadline", "weak_keys", "price_digits")
    b = before.select("organization_id", *[F.col(c).alias(f"{c}_before") for c in names])
    moved = [F.when(F.abs(F.col(c) - F.col(f"{c}_before")) > most * F.greatest(F.abs(F.col(f"{c}_before")), F.lit(1e-9)), F.lit(c)) for c in names]
    return after.join(b, "organization_id").withColumn("moved", F.array_compact(F.array(*moved))).where(F.size("moved") > 0)


def colliding_keys(observed: DataFrame) -> DataFrame:
    """Keys under which more than one source address is listed at the same time."""
    by = observed.groupBy("natural_key", "snapshot_date").agg(F.min("source_url").alias("a"), F.max("source_url").alias("b"))
    return by.where("a <> b").select("natural_key").distinct()

"""Trailing totals by block decomposition.

The calendar of an entity is cut into blocks as long as the window. Inside a
block, prefix sums run forward and suffix sums backward. The window of w days
that ends on day i starts in the same block (then it is the whole block, the
prefix at its end) or in the one before, and is then the suffix from its first
day plus the prefix up to day i. Each day's total is so made of at most two
numbers, whatever w is, and no group ever holds more than one stretch of
``lcm`` days of one entity: a hot entity spreads over as many tasks as it has
stretches.

Defined cases: rows without entity or day are left out; days without activity
count as 0; windows are cut at the entity's first day, and averages divide by
the days they really hold; an empty table yields nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_values(df: DataFrame, entity: str, day: str, value: Column, rank: Column, counts: Column) -> DataFrame:
    """(entity, day, value): the value of the row of the highest rank among those that count.

    Rows that do not count still stretch the entity's calendar. Equal ranks give
    the larger value. Combined before the shuffle.
    """
    entry = F.when(counts, F.struct(rank.alias("r"), value.alias("v")))
    return (
        df.where(F.col(entity).isNotNull() & F.col(day).isNotNull())
        .groupBy(F.col(entity).alias("entity"), F.col(day).cast("date").alias("day"))
        .agg(F.max(entry).alias("e"))
        .select("entity", "day", F.coalesce(F.col("e.v"), F.lit(0)).cast("bigint").alias("value"))
    )


def dense_calendar(daily: DataFrame) -> DataFrame:
    """Every day from the entity's first to its last, with its index from 0; missing days are 0.

    Each day fills the gap up to the next one by itself, so the calendar of a hot
    entity is not built in one row.
    """
    by = Window.partitionBy("entity").orderBy("day")
    first = daily.groupBy("entity").agg(F.min("day").alias("first"))
    gaps = daily.select("entity", "day", "value", F.coalesce(F.lead("day").over(by), F.date_add("day", 1)).alias("until"))
    filled = gaps.select("entity", F.col("day").alias("own"), "value", F.explode(F.sequence(F.col("day"), F.date_sub("until", 1))).alias("day"))
    return filled.join(first, "entity").select(
        "entity", "day", F.datediff("day", "first").alias("i"), F.when(F.col("day") == F.col("own"), F.col("value")).otherwise(F.lit(0)).cast("bigint").alias("value")
    )


def trailing_totals(dense: DataFrame, windows: Sequence[int]) -> DataFrame:
    """(entity, day, value, total_w, average_w for each w) of a dense calendar (entity, day, i, value)."""
    stretch = math.lcm(*windows)
    parts = dense.withColumn("stretch", F.floor(F.col("i") / F.lit(stretch)).cast("int"))
    parts = parts.repartition("entity", "stretch")  # serves the windows of every length below
    last = parts
    for w in windows:
        block = F.floor(F.col("i") / F.lit(w)).cast("int")
        over = Window.partitionBy("entity", "stretch", f"block_{w}")
        last = last.withColumn(f"block_{w}", block)
        upto = over.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = last.withColumn(f"prefix_{w}", F.sum("value").over(upto)).withColumn(f"all_{w}", F.sum("value").over(over))
    given = [F.struct(F.lit(0).alias("shift"), F.col("value").alias("value"), *[F.col(f"prefix_{w}").alias(f"t_{w}") for w in windows])]
    for w in windows:
        # the suffix from day i serves the window that ends w - 1 days later, unless i begins its block
        suffix = F.when(F.col("i") % w != 0, F.col(f"all_{w}") - F.col(f"prefix_{w}") + F.col("value")).otherwise(F.lit(0))
        given.append(F.struct(F.lit(w - 1).alias("shift"), F.lit(None).cast("bigint").alias("value"), *[(suffix if v == w else F.lit(0).cast("bigint")).alias(f"t_{v}") for v in windows]))
    rows = last.select("entity", "day", "i", F.explode(F.array(*given)).alias("x"))
    summed = (
        rows.select("entity", F.date_add("day", F.col("x.shift")).alias("day"), (F.col("i") + F.col("x.shift")).alias("i"), "x.*")
        .groupBy("entity", "day", "i")
        .agg(F.max("value").alias("value"), *[F.sum(f"t_{w}").alias(f"total_{w}") for w in windows])
        .where("value is not null")  # suffixes that point beyond the last day
    )
    out = [F.col("entity"), F.col("day"), F.col("value")]
    for w in windows:
        held = F.least(F.lit(w), F.col("i") + 1)
        out += [F.col(f"total_{w}"), (F.col(f"total_{w}") / held).alias(f"average_{w}")]
    return summed.select(*out)

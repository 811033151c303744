"""How good decisions are against labelled cases; recall first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_MISSED, LEAST_PRECISION = 0.03, 0.70


def _judged(cases: DataFrame, predictions: DataFrame) -> DataFrame:
    """cases (case_id, relevant) with notified and had_a_chance; a case without prediction has neither."""
    return cases.select("case_id", "relevant").join(predictions.select("case_id", "notified", "had_a_chance"), "case_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("notified", "had_a_chance")})


def had_a_chance(notified: Column, stage: Column) -> Column:
    return notified | (stage >= 3)


def evaluate(cases: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: confusion matrix, recall, miss rate, precision, reachability, whether the targets are met.

    An empty denominator gives 1.
    """
    r, n = F.col("relevant"), F.col("notified")
    m = _judged(cases, predictions).agg(
        F.count_if(r & n).alias("true_positive"), F.count_if(~r & n).alias("false_positive"), F.count_if(~r & ~n).alias("true_negative"),
        F.count_if(r & ~n).alias("false_negative"), F.count_if(r & F.col("had_a_chance")).alias("reachable"),
    )
    relevant = F.col("true_positive") + F.col("false_negative")

    def share(a: str, of: Column) -> Column:
        return F.coalesce(F.try_divide(F.col(a), of), F.lit(1.0))

    m = m.withColumns({"recall": share("true_positive", relevant), "precision": share("true_positive", F.col("true_positive") + F.col("false_positive")), "reachability": share("reachable", relevant)})
    return m.withColumns({"miss_rate": 1 - F.col("recall"), "targets_met": ((1 - F.col("recall")) <= MOST_MISSED) & (F.col("precision") >= LEAST_PRECISION)})


def misses(cases: DataFrame, predictions: DataFrame) -> DataFrame:
    """Relevant cases that were not notified."""
    told = predictions.where("notified").select("case_id")
    return cases.where("relevant").join(told, "case_id", "left_anti")


def report(evaluated: DataFrame) -> DataFrame:
    """The figures as one line of text; for reading, not for comparing."""
    return evaluated.select(F.format_string("TP %d FP %d TN %d FN %d recall %.3f precision %.3f reachability %.3f", "true_positive", "false_positive", "true_negative", "false_negative", "recall", "precision", "reachability").alias("line"))

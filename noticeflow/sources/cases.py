"""Evaluation cases from JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "case_id string, company_id string, title string, relevant boolean, price_text string, prefecture_code string, spec_text string, note string"


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; blank lines and lines beginning with // are skipped.

    A malformed record, an unknown field or a case_id that occurs twice fails the read.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(//.*)?$"))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    record = F.from_json("value", SCHEMA, {"mode": "FAILFAST"})
    unknown = F.size(F.array_except(F.json_object_keys("value"), F.array(*[F.lit(n) for n in names])))
    parsed = lines.select(record.alias("r"), unknown.alias("u"))
    known = parsed.where(F.when(F.col("u") > 0, F.raise_error(F.lit("unknown field in a case"))).otherwise(F.lit(True)).cast("boolean")).select("r.*")
    again = known.groupBy("case_id").count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"case_id occurs twice: {again[0]['case_id']}")
    return known.withColumn("note", F.coalesce("note", F.lit("")))

"""Folders of odd tables: empty, all null, rows repeated, columns with clashing names."""

from pathlib import Path

from pyspark.sql import functions as F

#: Names that operators use inside.
CLASHING = ("key", "day", "value", "n", "g", "x", "source", "entity", "wording", "form", "token", "size", "rank", "bucket", "hash", "entry", "before", "after", "first", "bin", "level", "total_7", "garbled", "container", "label", "rest", "salt")


def folders(spark, data: str, into: Path) -> dict[str, str]:
    out = {}
    for kind in ("empty", "nulls", "clashing"):
        for f in sorted(Path(data).glob("*.parquet")):
            df = spark.read.parquet(str(f))
            if kind == "empty":
                df = df.limit(0)
            elif kind == "nulls":
                nulls = df.limit(3).select(*[F.lit(None).cast(t.dataType).alias(t.name) for t in df.schema])
                df = df.unionByName(nulls).unionByName(df)
            else:
                df = df.withColumns({c: F.lit(1) for c in CLASHING if c not in df.columns and not (c == "label" and f.stem == "embeddings")})
            df.write.parquet(str(into / kind / f.name))
        out[kind] = str(into / kind)
    return out

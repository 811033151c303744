"""What changed between full snapshots, through a key-to-hash index.

The index of a snapshot holds, per key, a 128-bit hash of the watched columns
and nothing else (about 40 bytes a row however wide the table is), split into
buckets by the key's hash. A new snapshot probes the index of the last one
bucket by bucket: keys without an entry were added, entries without a key were
removed, entries with another hash were changed. Old and new values are fetched
for the changed keys only. Then the new index takes the old one's place.

``SnapshotIndex`` keeps the index in bucketed Parquet: ``apply`` takes one
snapshot as it arrives, ``replay`` all snapshots of a history table. The
comparison joins bucket with bucket, so neither side is shuffled for it; table
rows are never shuffled, only index entries, once, to their buckets.
``probe_generations`` is the same result by one window over each key, for a
table that is read once and whose index is not to be kept.

Defined cases: a null key is no record and is left out; null equals null in a
watched column; of several rows with one key in a snapshot the latest delivery
counts (null deliveries last, equal ones by the larger hash); an empty table
yields nothing; other columns, whatever their names, are neither read nor seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticeflow.storage import done, mark_done, remove

#: Marks a null inside the hashed text; cannot be part of a value's text.
_NULL = "\u0000null"


def row_hash(columns: Sequence[str]) -> Column:
    """128 bits over the columns as two 64-bit hashes with different leading words.

    xxhash64 skips nulls, so nulls are written out: (null, 'a') and ('a', null) differ.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in columns]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def index_rows(df: DataFrame, key: str, watched: Sequence[str], delivered: str | None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., key, hash): the last delivered row of each key, as its hash.

    The maximum is combined before the shuffle, so a key delivered a million
    times moves one entry per input partition.
    """
    order = F.col(delivered).cast("timestamp_ntz") if delivered else F.lit(None).cast("timestamp_ntz")
    entry = F.struct(order.isNotNull().alias("known"), order.alias("at"), row_hash(watched).alias("hash"))
    return (
        df.where(F.col(key).isNotNull())
        .select(*[F.col(c) for c in by], F.col(key).alias("key"), entry.alias("entry"))
        .groupBy(*by, "key")
        .agg(F.max("entry").alias("entry"))
        .select(*by, "key", F.col("entry.hash").alias("hash"))
    )


def probe(old: DataFrame, new: DataFrame) -> DataFrame:
    """(key, change_kind) between two indexes (key, hash)."""
    a = old.select("key", F.col("hash").alias("old_hash"))
    b = new.select("key", F.col("hash").alias("new_hash"))
    kind = (
        F.when(F.col("old_hash").isNull(), "added")
        .when(F.col("new_hash").isNull(), "removed")
        .when(F.col("old_hash") != F.col("new_hash"), "changed")
    )
    return a.join(b, "key", "full_outer").select("key", kind.alias("change_kind")).where("change_kind is not null")


def generations_of(df: DataFrame, key: str, generation: str) -> DataFrame:
    """(generation) of a table, one row each, from two of its columns."""
    return df.where(F.col(key).isNotNull() & F.col(generation).isNotNull()).select(generation).distinct()


def probe_generations(index: DataFrame, generation: str, generations: DataFrame) -> DataFrame:
    """(generation, key, change_kind) of every generation against the one before it.

    ``index`` is (generation, key, hash); ``generations`` (generations_of) is one
    row per snapshot delivered, not per record, and reaches the tasks by a join.
    It comes from the table rather than from the index, whose hashes would
    otherwise be computed for it once more.
    """
    # lag over one row per snapshot (a few a month): the only unpartitioned window, of that bounded list.
    every = generations.select(F.col(generation).alias("g"))
    over = Window.partitionBy(F.lit(0)).orderBy("g")
    steps = every.select("g", F.lag("g").over(over).alias("before"), F.lead("g").over(over).alias("after"))
    entries = index.join(steps, index[generation] == steps["g"]).select("g", "before", "after", "key", "hash")
    by_key = Window.partitionBy("key").orderBy("g")
    seen = entries.select(
        "g", "before", "after", "key", "hash",
        F.lag("g").over(by_key).alias("last_g"),
        F.lag("hash").over(by_key).alias("last_hash"),
        F.lead("g").over(by_key).alias("next_g"),
    )
    here = (
        F.when(F.col("before").isNull(), None)
        .when(F.col("last_g").isNull() | (F.col("last_g") != F.col("before")), "added")
        .when(F.col("last_hash") != F.col("hash"), "changed")
    )
    gone = F.col("after").isNotNull() & (F.col("next_g").isNull() | (F.col("next_g") != F.col("after")))
    found = F.array(
        F.struct(F.col("g").alias("g"), here.alias("kind")),
        F.struct(F.col("after").alias("g"), F.when(gone, "removed").alias("kind")),
    )
    return (
        seen.select("key", F.explode(found).alias("x"))
        .where("x.kind is not null")
        .select(F.col("x.g").alias(generation), "key", F.col("x.kind").alias("change_kind"))
    )


def changed_values(df: DataFrame, changes: DataFrame, key: str, generation: str, delivered: str, watched: Sequence[str]) -> DataFrame:
    """Old and new values of the changed keys, one row per key and generation.

    Only rows of changed keys leave the scan: the changes are joined to the
    table twice, at their own generation and at the one before it.
    """
    latest = F.max_by(
        F.struct(*[F.col(c) for c in watched]), F.struct(F.col(delivered).isNotNull(), F.col(delivered), row_hash(watched))
    )
    wanted = changes.where("change_kind = 'changed'").select(F.col("key"), F.col(generation).alias("g"))
    every = df.select(F.col(generation).alias("g")).where(F.col("g").isNotNull()).distinct()
    steps = every.select("g", F.lag("g").over(Window.partitionBy(F.lit(0)).orderBy("g")).alias("before"))
    wanted = wanted.join(steps, "g")
    sides = wanted.select("key", "g", F.explode(F.array(F.struct(F.col("g").alias("at"), F.lit("new").alias("side")), F.struct(F.col("before").alias("at"), F.lit("old").alias("side")))).alias("x"))
    rows = df.select(F.col(key).alias("key"), F.col(generation).alias("at"), F.col(delivered).alias(delivered), *watched)
    got = (
        sides.select("key", "g", F.col("x.at").alias("at"), F.col("x.side").alias("side"))
        .join(rows, ["key", "at"])
        .groupBy("key", "g")
        .pivot("side", ["old", "new"])
        .agg(latest)
    )
    return got.select(F.col("g").alias(generation), "key", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for c in watched for s in ("old", "new")])


class SnapshotIndex:
    """The index of the last snapshot, kept in bucketed Parquet below ``folder``.

    Each generation is a folder of its own whose files are buckets of the key's
    hash, so an index and the one before it meet bucket by bucket: the join reads
    both as they lie, without moving either. A marker file makes a generation the
    one in force, last of all, so a job that dies half way leaves the old index in
    force and can be run again.

    ``apply`` takes one snapshot as it arrives, ``replay`` the snapshots of a
    history table. The number of buckets belongs to the folder: give the same
    with every snapshot.
    """

    _ENTRY = "key {}, hash struct<a:bigint,b:bigint>"

    def __init__(self, spark: SparkSession, folder: str, key: str, watched: Sequence[str], delivered: str | None = None, buckets: int = 64):
        self.spark, self.folder, self.key, self.watched, self.delivered, self.buckets = spark, folder, key, list(watched), delivered, buckets

    def generation(self) -> int:
        """The generation in force; -1 before the first snapshot."""
        return done(self.spark, self.folder)

    def _name(self, part: str) -> str:
        return f"noticeflow_index_{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}_{part}"

    def _write(self, entries: DataFrame, part: str, by: Sequence[str] = ()) -> DataFrame:
        """Entries as the bucketed table of that name; one task holds whole buckets."""
        at, name = f"{self.folder}/{part}", self._name(part)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, at)
        placed = entries.repartition(self.buckets, "key")
        placed.write.partitionBy(*by).bucketBy(self.buckets, "key").sortBy("key").option("path", at).saveAsTable(name)
        return self.spark.table(name)

    def _open(self, part: str, kind: str) -> DataFrame:
        """A table that another session may have written."""
        name = self._name(part)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({self._ENTRY.format(kind)}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{part}'"
        )
        return self.spark.table(name)

    def apply(self, snapshot: DataFrame) -> DataFrame:
        """Changes of this snapshot against the last; afterwards this one is the last.

        The new index is written before the probe, so that the snapshot is read once.
        """
        at = self.generation()
        kind = dict(snapshot.dtypes)[self.key]
        new = self._write(index_rows(snapshot, self.key, self.watched, self.delivered), f"g{at + 1}")
        old = self._open(f"g{at}", kind) if at >= 0 else new.limit(0)
        probe(old, new).write.mode("overwrite").parquet(f"{self.folder}/changes={at + 1}")
        mark_done(self.spark, self.folder, at + 1)
        return self.spark.read.schema(f"key {kind}, change_kind string").parquet(f"{self.folder}/changes={at + 1}")

    def replay(self, history: DataFrame, generation: str, together: int = 16) -> DataFrame:
        """(generation, key, change_kind) of every snapshot of a table against the one before it; the first yields nothing.

        The entries of all snapshots are bucketed in one pass over the table. Then
        each snapshot's index is probed against the one before, ``together`` pairs
        in one job, and gives way to it. What stays is the changes.
        """
        kind = dict(history.dtypes)
        rows = history.where(F.col(generation).isNotNull()).withColumnRenamed(generation, "generation")
        every = self._write(index_rows(rows, self.key, self.watched, self.delivered, by=["generation"]), "history", by=["generation"])
        # one row per snapshot delivered, from the names of the folders
        steps = sorted(r[0].partition("=")[2] for r in self.spark.sql(f"SHOW PARTITIONS {self._name('history')}").collect())
        schema = f"key {kind[self.key]}, change_kind string, generation string"
        pairs = list(zip(steps, steps[1:]))
        for i in range(0, max(len(pairs), 1), together):
            found = every.select("key", F.lit("").alias("change_kind"), F.lit("").alias("generation")).limit(0)
            for before, after in pairs[i : i + together]:
                old, new = (every.where(F.col("generation") == F.lit(g).cast(kind[generation])) for g in (before, after))
                found = found.unionByName(probe(old, new).withColumn("generation", F.lit(after)))
            found.write.mode("overwrite").parquet(f"{self.folder}/replayed/part={i}")
        self.spark.sql(f"DROP TABLE {self._name('history')}")
        remove(self.spark, f"{self.folder}/history")
        got = self.spark.read.schema(schema).parquet(f"{self.folder}/replayed")
        return got.select(F.col("generation").cast(kind[generation]).alias(generation), "key", "change_kind")


def buckets_for(df: DataFrame) -> int:
    """A bucket for every 64 MB that the plan expects to read, and one per core at least."""
    expected = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, expected // (64 << 20) + 1)

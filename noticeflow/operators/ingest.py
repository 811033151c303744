"""From raw notices to current state and revision history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeflow.functions import identity, money, temporal, text
from noticeflow.schemas import TABLES, changed

# Fields whose change makes a revision, and those that touch a deadline.
WATCHED = ("bid_deadline_date", "bid_deadline_time", "application_deadline_date", "application_deadline_time", "qa_deadline_date", "qa_deadline_time", "estimated_price", "price_undisclosed", "method", "title", "status")
DEADLINES = ("bid_deadline_date", "bid_deadline_time", "application_deadline_date", "application_deadline_time")


def normalize(raw: DataFrame) -> DataFrame:
    """Typed tenders of raw ones; the only place where raw text is interpreted.

    Each text column crosses into Python once. Rows whose title is empty keep a
    null natural_key: split them off with ``quarantine``.
    """
    read = raw.select(
        "*",
        text.nfkc(F.col("title")).alias("_title"),
        temporal.parse_date(F.col("announced_text")).alias("_announced"),
        temporal.parse_deadline("qa_deadline_text").alias("_qa"),
        temporal.parse_deadline("application_deadline_text").alias("_application"),
        temporal.parse_deadline("bid_deadline_text").alias("_bid"),
        money.parse_price("price_text").alias("_price"),
    )
    titled = read.withColumn("_normal", text.title_from_nfkc(F.col("_title")))
    result = F.coalesce(F.try_element_at(F.col("raw_payload"), F.lit("is_result_announcement")) == "true", F.lit(False)) if "raw_payload" in raw.columns else F.lit(False)
    day = F.col("_bid.date")
    return titled.select(
        identity.natural_key(F.col("organization_id"), F.col("_normal"), F.col("_announced"), day).alias("natural_key"),
        F.lit(int(identity.KEY_VERSION)).alias("natural_key_version"),
        identity.anchor_kind(F.col("_announced"), day).alias("natural_key_anchor"),
        "organization_id", "source_url", F.col("captured_at").alias("source_captured_at"), "external_ref", "title",
        F.col("_normal").alias("title_normalized"),
        text.classify_method(F.col("method_text")).alias("method"),
        F.col("_announced").alias("announced_date"),
        F.col("_qa.date").alias("qa_deadline_date"), F.col("_qa.time").alias("qa_deadline_time"),
        F.col("_application.date").alias("application_deadline_date"), F.col("_application.time").alias("application_deadline_time"),
        day.alias("bid_deadline_date"), F.col("_bid.time").alias("bid_deadline_time"),
        F.coalesce(F.col("_bid.ambiguous"), F.lit(False)).alias("bid_deadline_ambiguous"),
        money.as_bigint(F.col("_price.amount")).alias("estimated_price"), F.col("_price.undisclosed").alias("price_undisclosed"),
        F.col("_price.tax_basis").alias("price_tax_basis"), F.col("_price.raw").alias("price_raw"),
        F.lit(None).cast("string").alias("place_prefecture_code"), F.col("qualification_text").alias("qualification_note"),
        F.when(result, "closed").otherwise("open").alias("status"),
    )


def quarantine(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without): one bad title rejects its row, not its run."""
    return typed.where("natural_key is not null"), typed.where("natural_key is null")


def diff(before: Column, after: Column, watched: tuple[str, ...] = WATCHED) -> Column:
    """map of changed field -> [before, after] as text, for two structs."""
    entries = [F.when(changed(before[c], after[c]), F.struct(F.lit(c).alias("key"), F.array(before[c].cast("string"), after[c].cast("string")).alias("value"))) for c in watched]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def any_changed(before: Column, after: Column, watched: tuple[str, ...] = WATCHED) -> Column:
    out = F.lit(False)
    for c in watched:
        out = out | changed(before[c], after[c])
    return out


def _effective(state: Column, at: Column) -> Column:
    """The state with an open status past its own deadline read as closed."""
    over = (state["status"] == "open") & temporal.is_closed(state["bid_deadline_date"], state["bid_deadline_time"], at)
    return state.withField("status", F.when(over, "closed").otherwise(state["status"]))


def fold(current: DataFrame, observed: DataFrame, sequence: list[str], watched: tuple[str, ...] = WATCHED, seen_at: str | None = None) -> DataFrame:
    """Every observation with its outcome, as if applied one after another to the current state.

    With ``seen_at`` (the time of the observation) a status that is closed only
    because the deadline has passed is no change: an expired tender that stays
    listed as open would otherwise be closed and reopened with every crawl.
    Without it statuses are compared as they are.

    ``current`` and ``observed`` share natural_key and all state columns;
    ``observed`` has a total order per key in ``sequence``. An unchanged
    observation equals its predecessor in every watched field, so comparing
    neighbours is exact and one window pass by key replaces the loop. Adds
    outcome, revision, change_kind, changed_fields, deadline_changed, diff.
    """
    states = [c for c in observed.columns if c not in ("natural_key", *sequence)]
    order = [F.col(c) for c in sequence]
    stored = current.select("natural_key", F.lit(0).alias("_new"), F.col("current_revision").alias("_base"), *[F.lit(None).cast(observed.schema[c].dataType).alias(c) for c in sequence], *[F.col(c).cast(observed.schema[c].dataType).alias(c) if c in current.columns else F.lit(None).cast(observed.schema[c].dataType).alias(c) for c in states])
    new = observed.select("natural_key", F.lit(1).alias("_new"), F.lit(None).cast("int").alias("_base"), *sequence, *states)
    keys = observed.select("natural_key").distinct()
    every = stored.join(keys, "natural_key", "left_semi").unionByName(new)
    over = Window.partitionBy("natural_key").orderBy("_new", *order)
    before, state = F.lag(F.struct(*[F.col(c) for c in watched])).over(over), F.struct(*[F.col(c) for c in watched])
    seen = every.withColumn("_before", before).withColumn("_state", state).withColumn("_first", F.row_number().over(over) == 1)
    if seen_at:
        now = F.col(seen_at).cast("timestamp_ntz")
        seen = seen.withColumns({"_before": F.when(F.col("_before").isNotNull(), _effective(F.col("_before"), now)), "_state": _effective(F.col("_state"), now)})
    seen = seen.withColumn("_changed", F.when(F.col("_first"), F.lit(False)).otherwise(any_changed(F.col("_before"), F.col("_state"), watched)))
    upto = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.coalesce(F.first("_base").over(upto), F.lit(1))
    revised = seen.withColumn("revision", (base + F.sum(F.col("_changed").cast("int")).over(upto)).cast("int")).where("_new = 1")
    outcome = F.when(F.col("_first"), "inserted").when(F.col("_changed"), "updated").otherwise("unchanged")
    kind = F.when(F.col("_first"), "new").when(F.col("_changed") & (F.col("status") == "cancelled"), "cancelled").when(F.col("_changed"), "corrected")
    told = F.when(F.col("_changed"), diff(F.col("_before"), F.col("_state"), watched)).otherwise(F.expr("cast(map() as map<string,array<string>>)"))
    out = revised.withColumns({"outcome": outcome, "change_kind": kind, "diff": told})
    fields = F.map_keys("diff")
    out = out.withColumn("changed_fields", fields).withColumn("deadline_changed", F.arrays_overlap("changed_fields", F.array(*[F.lit(c) for c in DEADLINES])))
    return out.select("natural_key", *sequence, *states, "outcome", "revision", "change_kind", "changed_fields", "deadline_changed", "diff")


def history(folded: DataFrame, recorded_at: str) -> DataFrame:
    """Rows for the append-only revision table."""
    return folded.where("change_kind is not null").select("natural_key", "revision", "change_kind", "diff", F.col(recorded_at).alias("recorded_at"))


def merge(current: DataFrame, folded: DataFrame, sequence: list[str], seen_at: str) -> DataFrame:
    """The next current-state snapshot.

    Of each key the last observation that changed something gives the columns
    (an unchanged one moves last_seen_at only); keys not observed stay as they are.
    """
    columns = TABLES["tender"].names
    have = [c for c in columns if c in folded.columns]
    order = F.struct(*[F.col(c) for c in sequence])
    content = [c for c in have if c not in ("natural_key", "first_seen_at", "last_seen_at", "current_revision")]
    by = folded.groupBy("natural_key").agg(
        F.max_by(F.struct(*content), F.when(F.col("outcome") != "unchanged", order)).alias("new"),
        F.max("revision").alias("revision"),
        F.max(seen_at).alias("seen"),
        F.min(seen_at).alias("first"),
    )
    joined = current.alias("c").join(by.alias("n"), "natural_key", "full_outer")
    out = []
    for c in columns:
        kind = TABLES["tender"][c].dataType
        old = F.col(f"c.{c}") if c in current.columns and c != "natural_key" else F.lit(None)
        if c == "natural_key":
            col = F.col("natural_key")
        elif c == "current_revision":
            col = F.coalesce(F.col("n.revision"), old)
        elif c == "first_seen_at":
            col = F.coalesce(old, F.col("n.first"))
        elif c == "last_seen_at":
            col = F.coalesce(F.col("n.seen"), old)
        elif c in content:
            col = F.when(F.col("n.new").isNotNull(), F.col(f"n.new.{c}")).otherwise(old)
        else:
            col = old
        out.append(col.cast(kind).alias(c))
    return joined.select(*out)

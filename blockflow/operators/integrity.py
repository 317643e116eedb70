"""Gaps, linkage, duplicates, comparison and checkpoints.

What looks at a row's predecessor never sorts the whole table in one task: rows are dealt by a segment of the order
column, compared within it, and each segment's first row gets its predecessor from a frame with one row a segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 1000


def with_previous(df: DataFrame, columns: list[str], order: str = "round", segment: int = SEGMENT, prefix: str = "prev_", depth: int = 1) -> DataFrame:
    """Adds ``prev_<column>``: the values of the row before in the order of an integer column (ties: by ``columns``).

    The frame with one row a segment is treated in the same way, ``depth`` times: one task sees a row of ``segment ** 2``.
    """
    names = df.columns
    keyed = df.withColumn("_segment", F.floor(F.col(order) / segment))
    w = Window.partitionBy("_segment").orderBy(order, *[c for c in columns if c != order])
    row = F.struct(*columns)
    inside = keyed.withColumn("_lag", F.lag(row).over(w))
    tails = keyed.groupBy("_segment").agg(F.max(F.struct(order, *[c for c in columns if c != order])).alias("_t")).select("_segment", F.struct(*(F.col(f"_t.{c}").alias(c) for c in columns)).alias("_tail"))
    if depth:
        above = with_previous(tails.select(F.col("_segment").alias("_order"), "_tail"), ["_tail"], "_order", segment, "_before", depth - 1)
        heads = above.select(F.col("_order").alias("_segment"), F.col("_before_tail").alias("_edge"))
    else:
        heads = tails.withColumn("_edge", F.lag("_tail").over(Window.orderBy("_segment"))).select("_segment", "_edge")
    both = inside.join(heads, "_segment").withColumn("_lag", F.coalesce("_lag", "_edge"))
    return both.select(*names, *(F.col(f"_lag.{c}").alias(f"{prefix}{c}") for c in columns))


# ---- order and gaps ------------------------------------------------------------------------------------------


def gap_check(rounds: DataFrame) -> DataFrame:
    """One row: low, high, want (rounds from low to high), have (rows), ok."""
    a = rounds.agg(F.min("round").alias("low"), F.max("round").alias("high"), F.count(F.lit(1)).alias("have"))
    want = F.col("high") - F.col("low") + 1
    return a.select("low", "high", want.alias("want"), "have", (want == F.col("have")).alias("ok"))


def gap_ranges(rounds: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """first_missing, last_missing, missing: the runs of rounds that aren't there."""
    seen = with_previous(rounds.select("round").distinct(), ["round"], segment=segment)
    return seen.where("round > prev_round + 1").select((F.col("prev_round") + 1).alias("first_missing"), (F.col("round") - 1).alias("last_missing"), (F.col("round") - F.col("prev_round") - 1).alias("missing"))


def contiguous_prefix(pending: DataFrame, cursor: int, segment: int = SEGMENT) -> DataFrame:
    """The pending rows that can be released: rounds cursor+1, cursor+2 ... up to the first that is missing."""
    ahead = pending.where(F.col("round") > cursor)
    jump = with_previous(ahead.select("round").distinct(), ["round"], segment=segment)
    broken = jump.where(F.col("round") > F.coalesce("prev_round", F.lit(cursor)) + 1).agg(F.min("round").alias("_stop"))
    return ahead.crossJoin(F.broadcast(broken)).where(F.col("_stop").isNull() | (F.col("round") < F.col("_stop"))).drop("_stop")  # one row


def buffer_depth(pending: DataFrame, cursor: int) -> DataFrame:
    """One row: depth (rounds that wait after the cursor) and ready (those of them that can be released)."""
    ahead = pending.where(F.col("round") > cursor).select("round").distinct()
    ready = contiguous_prefix(ahead, cursor).agg(F.count(F.lit(1)).alias("ready"))
    return ahead.agg(F.count(F.lit(1)).alias("depth")).crossJoin(ready)  # one row each


def segment_lookup(asked: DataFrame, starts: DataFrame, size: int) -> DataFrame:
    """round, segment_start: for each asked round the largest start (a multiple of ``size``) that isn't above it, else null.

    Equal-key joins only: each start also stands for the places of the starts missing up to the next one.
    """
    place = F.floor(F.col("round") / size) * size
    known = starts.select("segment_start").distinct()
    seen = with_previous(known, ["segment_start"], "segment_start", SEGMENT * size)
    between = seen.where("prev_segment_start is not null").select(F.col("prev_segment_start").alias("s"), F.explode(F.sequence(F.col("prev_segment_start"), F.col("segment_start") - size, F.lit(size).cast("bigint"))).alias("p"))
    last = known.agg(F.max("segment_start").alias("s")).where("s is not null")
    of = between.unionByName(last.withColumn("p", F.col("s")))
    placed = asked.select("round", place.alias("p")).crossJoin(F.broadcast(last.withColumnRenamed("s", "top")))  # one row
    return placed.withColumn("p", F.least("p", "top")).join(of, "p", "left").select("round", F.col("s").alias("segment_start"))


def commit_batches(ready: DataFrame, cursor: int, size: int) -> DataFrame:
    """batch, first_round, last_round, blocks: the catch-up batches that released rounds fall into."""
    numbered = ready.withColumn("batch", F.floor((F.col("round") - (cursor + 1)) / size))
    return numbered.groupBy("batch").agg(F.min("round").alias("first_round"), F.max("round").alias("last_round"), F.count(F.lit(1)).alias("blocks"))


def validate_batches(batches: DataFrame) -> DataFrame:
    """batch, blocks, contiguous: whether a batch has each round from its first to its last once."""
    a = batches.groupBy("batch").agg(F.min("round").alias("a"), F.max("round").alias("b"), F.count(F.lit(1)).alias("blocks"), F.countDistinct("round").alias("d"))
    return a.select("batch", "blocks", ((F.col("b") - F.col("a") + 1 == F.col("blocks")) & (F.col("d") == F.col("blocks"))).alias("contiguous"))


# ---- linkage ---------------------------------------------------------------------------------------------------


def linkage_breaks(blocks: DataFrame, lenient: bool = False, segment: int = SEGMENT) -> DataFrame:
    """round, previous_block_hash, expected: blocks whose previous hash isn't the hash of the block before.

    Without a predecessor, or with one that has no hash, a block passes. ``lenient``: an empty previous hash passes too,
    and a block without a hash of its own fails.
    """
    seen = with_previous(blocks.select("round", "block_hash", "previous_block_hash"), ["block_hash"], segment=segment)
    expected, previous = F.coalesce("prev_block_hash", F.lit("")), F.col("previous_block_hash")
    bad = (expected != "") & (previous != expected)
    if lenient:
        bad = (bad & (previous != "")) | (F.col("block_hash") == "")
    return seen.where(bad).select("round", "previous_block_hash", expected.alias("expected"))


def verify_summary(records: DataFrame, checkpoint: int | None, segment: int = SEGMENT) -> DataFrame:
    """One row of counts over records (round, block_hash, previous_block_hash, corrupt) up to the checkpoint.

    blocks, segments, first_round, last_round, gaps (one for each discontinuity), hash_errors (previous hash differs from
    the hash of the record before, even across a gap), corrupt_records, ok.
    """
    durable = records.where(F.col("round") <= checkpoint) if checkpoint is not None else records.limit(0)
    seen = with_previous(durable.select("round", "block_hash", "previous_block_hash", "corrupt"), ["round", "block_hash"], segment=segment)
    one = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("bigint")
    a = seen.agg(
        F.count(F.lit(1)).alias("blocks"), F.countDistinct(F.floor(F.col("round") / segment)).alias("segments"), F.min("round").alias("first_round"), F.max("round").alias("last_round"),
        one(F.col("prev_round").isNotNull() & (F.col("round") != F.col("prev_round") + 1)).alias("gaps"),
        one(F.col("prev_block_hash").isNotNull() & (F.col("prev_block_hash") != "") & (F.col("previous_block_hash") != F.col("prev_block_hash"))).alias("hash_errors"),
        one(F.col("corrupt")).alias("corrupt_records"),
    )
    at_end = F.coalesce(F.col("last_round") == F.lit(checkpoint), F.lit(checkpoint is None))
    return a.select("*", ((F.col("gaps") == 0) & (F.col("hash_errors") == 0) & (F.col("corrupt_records") == 0) & at_end).alias("ok"))


# ---- comparison -------------------------------------------------------------------------------------------------


def differences(a: DataFrame, b: DataFrame, columns: tuple[tuple[str, str], ...] = (("block_hash", "block hash mismatch"), ("previous_block_hash", "previous hash mismatch"))) -> DataFrame:
    """round, reason: where two archives differ; the first check that fails names the reason."""
    left, right = a.select("round", F.lit(True).alias("_a"), *(F.col(c).alias(f"a_{c}") for c, _ in columns)), b.select("round", F.lit(True).alias("_b"), *(F.col(c).alias(f"b_{c}") for c, _ in columns))
    both = left.join(right, "round", "full_outer")
    reason = F.when(F.col("_a").isNull(), "missing in A").when(F.col("_b").isNull(), "missing in B")
    for c, text in columns:
        reason = reason.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), text)
    return both.select("round", reason.alias("reason")).where("reason is not null")


def compare(a: DataFrame, b: DataFrame, start: int, end: int, columns: tuple[tuple[str, str], ...] = (("block_hash", "block hash mismatch"), ("previous_block_hash", "previous hash mismatch"))) -> DataFrame:
    """One row: start, end, blocks (compared), ok, has_diff, first_diff, diff_reason.

    Both are walked in step from ``start``; the first place where they aren't the same block of the expected round ends it.
    If one side has no more blocks there, the other "has extra blocks"; without a difference all rounds have to be there.
    """
    inside = F.col("round").between(start, end)
    a, b = a.where(inside), b.where(inside)
    same = a.alias("a").join(b.alias("b"), "round").where(" and ".join(f"a.{c} <=> b.{c}" for c, _ in columns)).select("round")
    stop = contiguous_prefix(same, start - 1).agg(F.coalesce(F.max("round") + 1, F.lit(start)).cast("bigint").alias("w"))
    at = lambda side, name: side.join(F.broadcast(stop), F.col("round") >= F.col("w")).agg(F.min(F.struct("round", *(c for c, _ in columns))).alias(name))
    one = stop.crossJoin(at(a, "a")).crossJoin(at(b, "b"))  # one row each
    w = F.col("w")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    text = lambda c: F.col(c).cast("string")
    reason = F.when(both & ((F.col("a.round") != w) | (F.col("b.round") != w)), F.concat(F.lit("round mismatch A="), text("a.round"), F.lit(" B="), text("b.round"), F.lit(" want="), text("w")))
    for c, what in columns:
        reason = reason.when(both & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), what)
    reason = reason.when(F.col("b").isNotNull(), "B has extra blocks").when(F.col("a").isNotNull(), "A has extra blocks")
    compared = w - start + F.when(both, 1).otherwise(0)
    first = F.when(both, w).when(F.col("b").isNotNull(), F.col("b.round"))
    full = compared == end - start + 1
    short = F.when(~full, F.concat(F.lit("block count "), compared.cast("string"), F.lit(f" want {end - start + 1}")))
    return one.select(
        F.lit(start).cast("bigint").alias("start"), F.lit(end).cast("bigint").alias("end"), compared.cast("bigint").alias("blocks"), (reason.isNull() & full).alias("ok"),
        reason.isNotNull().alias("has_diff"), first.alias("first_diff"), F.coalesce(reason, short).alias("diff_reason"),
    )


# ---- duplicates, keys, idempotent writes ----------------------------------------------------------------------------


def duplicate_txids(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("txid").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def first_writer(transactions: DataFrame) -> DataFrame:
    """Of the rows of a txid the one that comes first (round, then place in the block)."""
    names = [c for c in transactions.columns if c != "txid"]
    first = F.min(F.struct("round", "intra", *(c for c in names if c not in ("round", "intra"))))
    return transactions.groupBy("txid").agg(first.alias("_f")).select("txid", *(F.col(f"_f.{c}").alias(c) for c in names))


def only_new(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The rows whose key isn't there yet; what a conflict with an existing key leaves out."""
    return rows.join(existing.select(key), key, "left_anti")


def orphans(transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    return transactions.join(blocks.select("round"), "round", "left_anti")


def missing_app_id() -> Column:
    """An application call without its application (null or 0)."""
    return (F.col("type") == "appl") & (F.col("app_id").isNull() | (F.col("app_id") == 0))


def backfill_app_ids(transactions: DataFrame, derived: Column) -> DataFrame:
    """Fills app_id of application calls that have none."""
    return transactions.withColumn("app_id", F.when(missing_app_id(), F.nullif(derived, F.lit(0).cast("bigint"))).otherwise(F.col("app_id")))


# ---- checkpoints ------------------------------------------------------------------------------------------------------


def monotone_checkpoint(state: DataFrame, offered: DataFrame) -> DataFrame:
    """key, value: the larger of the stored and the offered value; a cursor never goes back."""
    return state.unionByName(offered).groupBy("key").agg(F.max("value").alias("value"))


def composite_checkpoint(sinks: DataFrame) -> DataFrame:
    """checkpoint: the least cursor of all sinks, null if one has none."""
    return sinks.agg(F.when(F.count("checkpoint") < F.count(F.lit(1)), F.lit(None)).otherwise(F.min("checkpoint")).alias("checkpoint"))


def hash_disagreement(copies: DataFrame) -> DataFrame:
    """round, hashes: rounds for which sinks store different hashes; a sink without the round doesn't count."""
    return copies.where("block_hash is not null").groupBy("round").agg(F.countDistinct("block_hash").alias("hashes")).where("hashes > 1")


def prune_from(checkpoint: int, keep: int) -> int | None:
    """The first round that is kept if the last ``keep`` are; None if there is nothing to prune."""
    return None if checkpoint + 1 <= keep else checkpoint - keep + 1


# ---- state ------------------------------------------------------------------------------------------------------------


def sync_lag(state: DataFrame) -> DataFrame:
    """Adds lag = max(tip - cursor, 0); without a checkpoint the cursor is the round before the next commit."""
    cursor = F.when(F.col("has_checkpoint"), F.col("checkpoint")).when(F.col("next_commit") > 0, F.col("next_commit") - 1).otherwise(F.col("checkpoint"))
    return state.withColumn("lag", F.greatest(F.col("tip") - cursor, F.lit(0)))


def health(state: DataFrame, near: int = 2) -> DataFrame:
    """Adds lag, mode and ready to rows of failed, sink_error, has_checkpoint, next_commit, checkpoint, tip."""
    mode = (
        F.when(F.col("failed"), "failed").when(F.coalesce("sink_error", F.lit("")) != "", "degraded")
        .when(~F.col("has_checkpoint") & (F.col("next_commit") == 0), "startup").when(F.col("lag") > near, "catching_up").otherwise("live")
    )
    return sync_lag(state).withColumn("mode", mode).withColumn("ready", F.col("mode").isin("live", "catching_up"))


def availability(asked: DataFrame, blocks: DataFrame, checkpoint: int) -> DataFrame:
    """round, status of each asked round: ok, not_yet_available (beyond the checkpoint) or not_found."""
    hit = asked.join(blocks.select("round", F.lit(True).alias("_hit")).where(F.col("round") <= checkpoint), "round", "left")
    return hit.select("round", F.when(F.col("_hit"), "ok").when(F.col("round") > checkpoint, "not_yet_available").otherwise("not_found").alias("status"))


def handoff(history: DataFrame, live: DataFrame, checkpoint: int) -> DataFrame:
    """The archive up to its checkpoint, then live blocks; where both have a round the archive's is taken."""
    return history.where(F.col("round") <= checkpoint).unionByName(live.where(F.col("round") > checkpoint))


#: The gauge value of each phase (fixed values).
PHASES = {"historical": 0, "handoff": 1, "live": 2, "waiting": 3, "failed": 4}


def phase_of(round_: Column, checkpoint: int | None) -> Column:
    if checkpoint is None:
        return F.lit("waiting")
    return F.when(round_ <= checkpoint, "historical").when(round_ == checkpoint + 1, "handoff").otherwise("live")


def phase_gauge(phase: Column) -> Column:
    out = F.lit(-1)
    for name, value in PHASES.items():
        out = F.when(phase == name, value).otherwise(out)
    return out

"""The registered queries over the driver's tables, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockflow.functions.errors import RETRY_CASES, retryable_column, unavailable_column
from blockflow.operators import explorer as X
from blockflow.operators import integrity as I
from blockflow.operators import summaries as S
from blockflow.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = f"WITH {V.VIEWS_SQL.strip()}\n{sql.strip()}" if not sql.lstrip().startswith(",") else f"WITH {V.VIEWS_SQL.strip()}{sql.strip()}"
        return f

    return register


BLOCKS = "round, block_hash, previous_block_hash, timestamp, txn_count"
TX = "round, txid, sender, type, coalesce(app_id, 0) AS app_id"


# ---- explorer ------------------------------------------------------------------------------------------------


@_query("""
SELECT CAST(b.hi AS BIGINT) AS last_processed_round, b.n AS block_count, t.n AS tx_count, b.lo AS min_round, b.hi AS max_round, t.s AS unique_senders
FROM (SELECT count(*) AS n, min(round) AS lo, max(round) AS hi FROM v_blocks) b, (SELECT count(*) AS n, count(DISTINCT sender) AS s FROM v_transactions) t""")
def explorer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, previous=False, counts=False)
    return X.status(b, V.transactions(spark, sf_dir), b.agg(F.max("round")).first()[0])


@_query(f"SELECT {BLOCKS} FROM v_blocks ORDER BY round DESC LIMIT 40")
def recent_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.recent_blocks(X.newest(V.blocks(spark, sf_dir), V.blocks(spark, sf_dir, False, False)))


@_query(f"SELECT {BLOCKS} FROM v_blocks WHERE round < 1000 ORDER BY round DESC LIMIT 25")
def blocks_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = V.blocks(spark, sf_dir, False, False).where("round < 1000")
    return X.recent_blocks(X.newest(V.blocks(spark, sf_dir), rounds, 25), 25, 1000)


@_query(f"SELECT {BLOCKS} FROM v_blocks WHERE round = 77")
def block_by_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.block_by_round(V.blocks(spark, sf_dir), 77)


@_query(f"""
SELECT b.*, t.txid, t.sender, t.type, t.app_id FROM (SELECT {BLOCKS} FROM v_blocks WHERE round = 77) b
LEFT JOIN (SELECT {TX} FROM v_transactions WHERE round = 77 ORDER BY intra DESC LIMIT 200) t ON t.round = b.round""")
def block_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.block_detail(V.blocks(spark, sf_dir), V.transactions(spark, sf_dir, ordinal=True), 77)


@_query(f"SELECT {TX} FROM v_transactions ORDER BY v_transactions.round DESC, intra DESC LIMIT 40")
def recent_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.recent_transactions(X.newest(V.transactions(spark, sf_dir, ordinal=True), V.transactions(spark, sf_dir)))


@_query(f"SELECT {TX} FROM v_transactions WHERE round = 33 ORDER BY intra DESC LIMIT 40")
def transactions_by_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.recent_transactions(V.transactions(spark, sf_dir, ordinal=True), round_=33)


@_query(f"SELECT {TX} FROM v_transactions WHERE sender = 'S7' ORDER BY v_transactions.round DESC, intra DESC LIMIT 40")
def transactions_by_sender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.recent_transactions(V.transactions(spark, sf_dir, ordinal=True), sender="S7")


@_query(f"SELECT {TX} FROM v_transactions WHERE app_id = 11 ORDER BY v_transactions.round DESC, intra DESC LIMIT 40")
def transactions_by_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.recent_transactions(V.transactions(spark, sf_dir, ordinal=True), app_id="11", limit="not a number")


@_query("SELECT sender, count(*) AS tx_count, count(DISTINCT round) AS rounds_active FROM v_transactions GROUP BY 1 ORDER BY tx_count DESC, sender LIMIT 10")
def top_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.top_senders(V.transactions(spark, sf_dir))


@_query("""
SELECT s.*, coalesce(b.balance_micro, 0) AS balance_micro, coalesce(b.balance_micro, 0) / 1e6 AS balance, b.balance_micro IS NOT NULL AS balance_known
FROM (SELECT sender, count(*) AS tx_count, count(DISTINCT round) AS rounds_active FROM v_transactions GROUP BY 1 ORDER BY tx_count DESC, sender LIMIT 25) s
LEFT JOIN v_balances b ON b.sender = s.sender""")
def top_senders_with_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.with_balances(X.top_senders(V.transactions(spark, sf_dir), 25), V.balances(spark, sf_dir))


@_query("""
SELECT app_id, count(*) AS call_count, count(DISTINCT sender) AS unique_senders, count(DISTINCT round) AS rounds_active, max(round) AS last_round
FROM v_transactions WHERE app_id > 0 GROUP BY 1 ORDER BY call_count DESC, last_round DESC, app_id LIMIT 10""")
def top_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.top_apps(V.transactions(spark, sf_dir))


@_query(f"SELECT {BLOCKS} FROM v_blocks WHERE txn_count > 0 ORDER BY txn_count DESC, round DESC LIMIT 8")
def busy_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.busy_blocks(V.blocks(spark, sf_dir), 8)


@_query("""
SELECT CASE WHEN length(block_hash) <= 15 THEN block_hash ELSE left(block_hash, 8) || '…' || right(block_hash, 6) END AS label, round
FROM v_blocks""")
def block_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.blocks(spark, sf_dir, previous=False, counts=False).select(X.short(F.col("block_hash")).alias("label"), "round")


# ---- order, gaps, linkage ----------------------------------------------------------------------------------------


@_query("SELECT lo AS low, hi AS high, hi - lo + 1 AS want, n AS have, hi - lo + 1 = n AS ok FROM (SELECT min(round) AS lo, max(round) AS hi, count(*) AS n FROM v_blocks)")
def gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.gap_check(V.blocks(spark, sf_dir, False, False))


@_query("""
SELECT p + 1 AS first_missing, round - 1 AS last_missing, round - p - 1 AS missing
FROM (SELECT round, lag(round) OVER (ORDER BY round) AS p FROM (SELECT DISTINCT round FROM v_transactions)) WHERE round > p + 1""")
def gap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.gap_ranges(V.transactions(spark, sf_dir))


@_query("""
SELECT round, latency FROM v_arrivals WHERE round > 99 AND round <> (SELECT max(round) - 50 FROM v_arrivals)
QUALIFY round - row_number() OVER (ORDER BY round) = 99""")
def contiguous_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gap is near the end of the table, so nearly all of it is released."""
    a = V.arrivals(spark, sf_dir).select("round", "latency")
    return I.contiguous_prefix(a.where(F.col("round") != a.agg(F.max("round")).first()[0] - 50), 99)


@_query("""
SELECT count(*) AS depth, count(*) FILTER (round < (SELECT max(round) - 50 FROM v_arrivals)) AS ready
FROM v_arrivals WHERE round > 99 AND round <> (SELECT max(round) - 50 FROM v_arrivals)""")
def buffer_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = V.arrivals(spark, sf_dir).select("round")
    return I.buffer_depth(a.where(F.col("round") != a.agg(F.max("round")).first()[0] - 50), 99)


@_query("""
SELECT CAST((round - 100) // 10 AS BIGINT) AS batch, min(round) AS first_round, max(round) AS last_round, count(*) AS blocks
FROM v_arrivals WHERE round > 99 GROUP BY 1""")
def commit_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.commit_batches(V.arrivals(spark, sf_dir).where("round > 99"), 99, 10)


@_query("""
SELECT CAST(round // 25 AS BIGINT) AS batch, count(*) AS blocks, max(round) - min(round) + 1 = count(*) AND count(DISTINCT round) = count(*) AS contiguous
FROM (SELECT round FROM v_arrivals WHERE round % 211 <> 30 UNION ALL SELECT round FROM v_arrivals WHERE round % 307 = 4) GROUP BY 1""")
def validate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = V.arrivals(spark, sf_dir).select("round")
    return I.validate_batches(a.where("round % 211 <> 30").unionByName(a.where("round % 307 = 4")).withColumn("batch", F.floor(F.col("round") / 25)))


_LINK = "SELECT round, block_hash, previous_block_hash, lag(block_hash) OVER (ORDER BY round) AS expected FROM v_copy"


@_query(f"SELECT round, previous_block_hash, expected FROM ({_LINK}) WHERE coalesce(expected, '') <> '' AND previous_block_hash <> expected")
def linkage_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.linkage_breaks(I_copy(spark, sf_dir))


@_query(f"""
SELECT round, previous_block_hash, coalesce(expected, '') AS expected FROM ({_LINK.replace("v_copy", "(SELECT round, CASE WHEN round % 1009 = 2 THEN '' ELSE block_hash END AS block_hash, CASE WHEN round % 499 = 3 THEN '' ELSE previous_block_hash END AS previous_block_hash FROM v_copy)")})
WHERE (coalesce(expected, '') <> '' AND previous_block_hash <> expected AND previous_block_hash <> '') OR block_hash = ''""")
def linkage_breaks_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = I_copy(spark, sf_dir)
    c = c.withColumns({"block_hash": F.when(F.col("round") % 1009 == 2, "").otherwise(F.col("block_hash")), "previous_block_hash": F.when(F.col("round") % 499 == 3, "").otherwise(F.col("previous_block_hash"))})
    return I.linkage_breaks(c, lenient=True)


def I_copy(spark: SparkSession, sf_dir: str, counts: bool = False) -> DataFrame:
    return V.archive_copy(V.blocks(spark, sf_dir, counts=counts))


_SEEN = """SELECT *, lag(round) OVER (ORDER BY round) AS pr, lag(block_hash) OVER (ORDER BY round) AS ph FROM v_copy"""


@_query(f"""
SELECT count(*) AS blocks, count(DISTINCT round // 1000) AS segments, min(round) AS first_round, max(round) AS last_round,
       CAST(coalesce(sum(CASE WHEN round <> pr + 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS gaps,
       CAST(coalesce(sum(CASE WHEN ph <> '' AND previous_block_hash <> ph THEN 1 ELSE 0 END), 0) AS BIGINT) AS hash_errors,
       CAST(coalesce(sum(CASE WHEN block_hash = 'corrupt' THEN 1 ELSE 0 END), 0) AS BIGINT) AS corrupt_records,
       coalesce(sum(CASE WHEN round <> pr + 1 OR (ph <> '' AND previous_block_hash <> ph) OR block_hash = 'corrupt' THEN 1 ELSE 0 END), 0) = 0 AND max(round) = (SELECT max(round) FROM v_copy) AS ok
FROM ({_SEEN})""")
def archive_verify_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to the copy's last round, which is its checkpoint."""
    c = I_copy(spark, sf_dir).withColumn("corrupt", F.col("block_hash") == "corrupt")
    return I.verify_summary(c, c.agg(F.max("round")).first()[0])


_DIFF = """
SELECT coalesce(a.round, b.round) AS round, CASE WHEN a.round IS NULL THEN 'missing in A' WHEN b.round IS NULL THEN 'missing in B'
  WHEN a.block_hash <> b.block_hash THEN 'block hash mismatch' WHEN a.previous_block_hash <> b.previous_block_hash THEN 'previous hash mismatch' END AS reason
FROM (SELECT * FROM v_blocks WHERE round BETWEEN {0} AND {1}) a FULL JOIN (SELECT * FROM v_copy WHERE round BETWEEN {0} AND {1}) b ON a.round = b.round"""


@_query(f"SELECT * FROM ({_DIFF.format(0, 1 << 40)}) WHERE reason IS NOT NULL")
def archive_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, counts=False)
    return I.differences(b, V.archive_copy(b))


@_query("""
SELECT CAST(20 AS BIGINT) AS start, CAST(1400 AS BIGINT) AS "end",
       CASE WHEN reason IS NULL THEN 1381 ELSE w - 20 + CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 ELSE 0 END END AS blocks,
       reason IS NULL AS ok, reason IS NOT NULL AS has_diff, CASE WHEN b IS NULL THEN NULL WHEN a IS NULL THEN b ELSE w END AS first_diff, reason AS diff_reason
FROM (SELECT *, CASE WHEN w > 1400 THEN NULL WHEN a IS NULL AND b IS NULL THEN 'block count ' || CAST(w - 20 AS VARCHAR) || ' want 1381'
    WHEN b IS NULL THEN 'A has extra blocks' WHEN a IS NULL THEN 'B has extra blocks'
    WHEN a <> w OR b <> w THEN 'round mismatch A=' || CAST(a AS VARCHAR) || ' B=' || CAST(b AS VARCHAR) || ' want=' || CAST(w AS VARCHAR)
    WHEN (SELECT x.block_hash <> y.block_hash FROM v_blocks x JOIN v_copy y USING (round) WHERE round = w) THEN 'block hash mismatch' ELSE 'previous hash mismatch' END AS reason
  FROM (SELECT w, (SELECT min(round) FROM v_blocks WHERE round BETWEEN w AND 1400) AS a, (SELECT min(round) FROM v_copy WHERE round BETWEEN w AND 1400) AS b
    FROM (SELECT min(r.n) AS w FROM (SELECT unnest(range(20, 1402)) AS n) r
      LEFT JOIN (SELECT round FROM v_blocks a JOIN v_copy b USING (round) WHERE round <= 1400 AND a.block_hash = b.block_hash AND a.previous_block_hash = b.previous_block_hash) e ON e.round = r.n WHERE e.round IS NULL)))""")
def archive_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, counts=False)
    return I.compare(b, V.archive_copy(b), 20, 1400)


# ---- keys and writes ---------------------------------------------------------------------------------------------------


@_query("SELECT txid, count(*) AS copies FROM v_transactions GROUP BY 1 HAVING count(*) > 1")
def duplicate_txids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.duplicate_txids(V.transactions(spark, sf_dir))


@_query("SELECT * FROM v_transactions QUALIFY row_number() OVER (PARTITION BY txid ORDER BY round, intra) = 1")
def txid_first_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.first_writer(V.transactions(spark, sf_dir, ordinal=True))


@_query("SELECT round, block_hash FROM v_blocks WHERE round NOT IN (SELECT round FROM v_blocks WHERE round % 3 = 0)")
def idempotent_block_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, False, False).select("round", "block_hash")
    return I.only_new(b, b.where("round % 3 = 0"), "round")


@_query("SELECT DISTINCT round FROM v_transactions WHERE round % 5 = 0")
def orphan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, False, False).where("round % 5 <> 0")
    return I.orphans(V.transactions(spark, sf_dir), b).select("round").distinct()


@_query("""
SELECT key, max(value) AS value FROM (SELECT 'last_processed_round' AS key, CAST(500 AS BIGINT) AS value UNION ALL SELECT 'other', 9
  UNION ALL SELECT 'last_processed_round', max(round) FROM v_blocks UNION ALL SELECT 'other', 3) GROUP BY 1""")
def monotone_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    offered = V.blocks(spark, sf_dir, False, False).agg(F.max("round").alias("value")).select(F.lit("last_processed_round").alias("key"), "value")
    state = spark.createDataFrame([("last_processed_round", 500), ("other", 9), ("other", 3)], "key string, value bigint")
    return I.monotone_checkpoint(state, offered)


@_query("""
SELECT 'all have one' AS sinks, CAST(min(c) AS BIGINT) AS checkpoint FROM (SELECT max(round) AS c FROM v_blocks UNION ALL SELECT max(round) FROM v_copy UNION ALL SELECT 700)
UNION ALL SELECT 'one has none', NULL""")
def composite_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, False, False)
    cursors = b.agg(F.max("round").alias("checkpoint")).unionByName(b.where("round % 983 <> 11").agg(F.max("round").alias("checkpoint"))).unionByName(spark.createDataFrame([(700,)], "checkpoint bigint"))
    none = cursors.unionByName(spark.createDataFrame([(None,)], "checkpoint bigint"))
    return I.composite_checkpoint(cursors).withColumn("sinks", F.lit("all have one")).unionByName(I.composite_checkpoint(none).withColumn("sinks", F.lit("one has none")))


@_query("SELECT a.round, CAST(2 AS BIGINT) AS hashes FROM v_blocks a JOIN v_copy b USING (round) WHERE a.block_hash <> b.block_hash")
def hash_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, counts=False)
    return I.hash_disagreement(b.unionByName(V.archive_copy(b)))


@_query("SELECT round, txid, type, CASE WHEN type = 'appl' AND coalesce(app_id, 0) = 0 THEN nullif(round % 50, 0) ELSE app_id END AS app_id FROM v_transactions")
def app_id_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.backfill_app_ids(V.transactions(spark, sf_dir), F.col("round") % 50).select("round", "txid", "type", "app_id")


@_query("SELECT round, block_hash, timestamp FROM v_blocks")
def unnest_parallel_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays of a batch (of at most 200 rounds) back into rows."""
    b = V.blocks(spark, sf_dir, False, False)
    arrays = b.groupBy(F.floor(F.col("round") / 200).alias("g")).agg(*(F.collect_list(c).alias(c) for c in ("round", "block_hash", "timestamp")))
    return arrays.select(F.inline(F.arrays_zip("round", "block_hash", "timestamp")))


# ---- archive ranges, handoff ---------------------------------------------------------------------------------------------


@_query("""
SELECT segment_start, lpad(CAST(segment_start AS VARCHAR), 20, '0') || '.seg' AS name, count(*) AS blocks, min(round) AS first_round, max(round) AS last_round
FROM (SELECT CAST(round // 1000 * 1000 AS BIGINT) AS segment_start, round FROM v_blocks) GROUP BY segment_start""")
def segment_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.floor(F.col("round") / 1000) * 1000).alias("segment_start")
    a = V.blocks(spark, sf_dir, False, False).groupBy(start).agg(F.count(F.lit(1)).alias("blocks"), F.min("round").alias("first_round"), F.max("round").alias("last_round"))
    return a.withColumn("name", F.concat(F.lpad(F.col("segment_start").cast("string"), 20, "0"), F.lit(".seg")))


@_query("""
SELECT r.round, CAST(s.start AS BIGINT) AS segment_start FROM v_arrivals r
ASOF LEFT JOIN (SELECT DISTINCT round // 700 * 700 AS start FROM v_blocks WHERE round // 700 % 3 <> 1) s ON s.start <= r.round""")
def segment_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment that holds a round: the one with the largest start up to it; every third segment is missing."""
    starts = V.blocks(spark, sf_dir, False, False).select((F.floor(F.col("round") / 700) * 700).alias("segment_start")).distinct()
    return I.segment_lookup(V.arrivals(spark, sf_dir).select("round"), starts.where(F.floor(F.col("segment_start") / 700) % 3 != 1), 700)


@_query(f"SELECT {BLOCKS} FROM v_blocks WHERE round BETWEEN 100 AND 420")
def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.blocks(spark, sf_dir).where(F.col("round").between(100, 420))


@_query("SELECT round, block_hash FROM v_blocks WHERE round >= (SELECT max(round) - 500 + 1 FROM v_blocks)")
def prune_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, False, False).select("round", "block_hash")
    start = I.prune_from(b.agg(F.max("round")).first()[0], 500)
    return b if start is None else b.where(F.col("round") >= start)


@_query("SELECT CAST(round // 250 * 250 AS BIGINT) AS segment_start, round, block_hash, previous_block_hash FROM v_blocks WHERE round >= 300")
def export_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of all blocks, exported from round 300 on to one of smaller segments, which is read."""
    from blockflow.runtime import shared_path
    from blockflow.sources import segments

    b = V.blocks(spark, sf_dir, counts=False).withColumn("raw", F.concat(F.lit("raw-"), F.col("round").cast("string")).cast("binary"))
    source, target = shared_path(spark, "archive"), shared_path(spark, "export")
    segments.write_archive(b, source)
    segments.export_archive(spark, source, target, 300, segments.read_checkpoint(source), 250)
    return segments.read_archive(spark, target, raw=False).select("segment_start", "round", "block_hash", "previous_block_hash")


@_query("""
SELECT round, block_hash, 'archive' AS origin FROM v_blocks WHERE round <= 800
UNION ALL SELECT round, 'LIVE' || CAST(round AS VARCHAR), 'live' FROM v_blocks WHERE round > 800""")
def handoff_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, False, False)
    live = b.where("round >= 700").select("round", F.concat(F.lit("LIVE"), F.col("round").cast("string")).alias("block_hash"), F.lit("live").alias("origin"))
    return I.handoff(b.select("round", "block_hash", F.lit("archive").alias("origin")), live, 800)


@_query("""
SELECT phase, count(*) AS blocks, CAST(CASE phase WHEN 'historical' THEN 0 WHEN 'handoff' THEN 1 WHEN 'live' THEN 2 ELSE -1 END AS INTEGER) AS gauge
FROM (SELECT CASE WHEN round <= 800 THEN 'historical' WHEN round = 801 THEN 'handoff' ELSE 'live' END AS phase FROM v_blocks) GROUP BY 1""")
def handoff_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = V.blocks(spark, sf_dir, False, False).select(I.phase_of(F.col("round"), 800).alias("phase"))
    return b.groupBy("phase").agg(F.count(F.lit(1)).alias("blocks")).withColumn("gauge", I.phase_gauge(F.col("phase")))


@_query("""
SELECT round, CASE WHEN round <= 900 AND round IN (SELECT round FROM v_copy) THEN 'ok' WHEN round > 900 THEN 'not_yet_available' ELSE 'not_found' END AS status
FROM v_arrivals""")
def availability_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = V.arrivals(spark, sf_dir).select("round")
    return I.availability(asked, V.blocks(spark, sf_dir, False, False).where("round % 983 <> 11"), 900)


# ---- summaries, state ------------------------------------------------------------------------------------------------------


@_query("""
SELECT n, CAST(s // n AS BIGINT) AS avg, l[CAST(n * 50 // 100 + 1 AS BIGINT)] AS p50, l[CAST(least(n * 95 // 100, n - 1) + 1 AS BIGINT)] AS p95
FROM (SELECT count(*) AS n, CAST(sum(v) AS BIGINT) AS s, list_sort(list(v)) AS l FROM (SELECT CAST(floor(latency * 1000) AS BIGINT) AS v FROM v_arrivals))""")
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latency_summary(V.arrivals(spark, sf_dir), F.floor(F.col("latency") * 1000))


_BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


@_query("SELECT event_type, b.le, CAST(sum(CASE WHEN latency <= b.x THEN 1 ELSE 0 END) AS BIGINT) AS count FROM v_arrivals, (VALUES "
        + ", ".join(f"('{x!r}', {x!r}::DOUBLE)" for x in _BOUNDS) + ", ('+Inf', 'infinity'::DOUBLE)) b(le, x) GROUP BY 1, 2")
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.histogram(V.arrivals(spark, sf_dir), F.col("latency"), _BOUNDS, ("event_type",))


@_query("SELECT CAST(epoch_us(ts) // 1000000 // 3600 * 3600 AS BIGINT) AS window_start, count(*) AS blocks, count(*) / 3600.0::DOUBLE AS per_second FROM v_arrivals GROUP BY 1")
def throughput_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.throughput(V.arrivals(spark, sf_dir), F.col("ts"), 3600)


@_query("SELECT event_type, count(*) AS total FROM v_arrivals GROUP BY 1")
def labelled_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.counters(V.arrivals(spark, sf_dir), "event_type")


_STATES = """
SELECT round, round % 17 = 0 AS failed, CASE WHEN round % 13 = 0 THEN 'sink down' END AS sink_error, round % 5 <> 0 AS has_checkpoint, round % 3 AS next_commit,
       round // 2 AS checkpoint, round // 2 + round % 7 - 2 AS tip FROM v_arrivals"""
_CURSOR = "CASE WHEN has_checkpoint THEN checkpoint WHEN next_commit > 0 THEN next_commit - 1 ELSE checkpoint END"


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("round")
    return V.arrivals(spark, sf_dir).select(
        "round", (r % 17 == 0).alias("failed"), F.when(r % 13 == 0, "sink down").alias("sink_error"), (r % 5 != 0).alias("has_checkpoint"), (r % 3).alias("next_commit"),
        F.floor(r / 2).alias("checkpoint"), (F.floor(r / 2) + r % 7 - 2).alias("tip"),
    )


@_query(f"SELECT round, greatest(tip - {_CURSOR}, 0) AS lag FROM ({_STATES})")
def sync_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.sync_lag(_states(spark, sf_dir)).select("round", "lag")


@_query(f"""
SELECT round, lag, mode, mode IN ('live', 'catching_up') AS ready FROM (SELECT round, lag, CASE WHEN failed THEN 'failed' WHEN sink_error IS NOT NULL THEN 'degraded'
  WHEN NOT has_checkpoint AND next_commit = 0 THEN 'startup' WHEN lag > 2 THEN 'catching_up' ELSE 'live' END AS mode
  FROM (SELECT *, greatest(tip - {_CURSOR}, 0) AS lag FROM ({_STATES})))""")
def health_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.health(_states(spark, sf_dir)).select("round", "lag", "mode", "ready")


@_query("SELECT * FROM (VALUES " + ", ".join(f"('{m}', {'true' if r else 'false'}, {'true' if u else 'false'})" for m, r, u in RETRY_CASES) + ") t(message, retryable, unavailable)")
def error_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.createDataFrame([(m,) for m, _, _ in RETRY_CASES], "message string")
    return df.select("message", retryable_column(F.col("message")).alias("retryable"), unavailable_column(F.col("message")).alias("unavailable"))


@_query("""
SELECT CAST(c AS INTEGER) AS configured, CAST(k AS INTEGER) AS checkpoint, CASE WHEN k IS NOT NULL AND k + 1 > tip + 1000 THEN hi + 1 WHEN k IS NOT NULL THEN k + 1 WHEN c IS NOT NULL THEN c ELSE tip END AS next_round
FROM (VALUES (NULL, NULL), (5, NULL), (5, 700), (NULL, 90000)) v(c, k), (SELECT max(round) AS tip, max(round) AS hi FROM v_blocks)""")
def resume_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    from blockflow.streaming.follow import start_round

    tip = V.blocks(spark, sf_dir, False, False).agg(F.max("round")).first()[0]
    rows = [(c, k, start_round(k, c, tip, tip)) for c, k in ((None, None), (5, None), (5, 700), (None, 90000))]
    return spark.createDataFrame(rows, "configured int, checkpoint int, next_round bigint")


# ---- rows only: streams, files and payloads -------------------------------------------------------------------------------


@_query("SELECT CAST('all' AS VARCHAR) AS chain, round, CAST(round AS VARCHAR) AS block_hash FROM v_arrivals WHERE round < (SELECT max(round) - 50 FROM v_arrivals)")
def ordered_stream_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All arrivals, out of order and without one near the end, through the ordered buffer as a stream: what is released."""
    from blockflow.runtime import shared_path
    from blockflow.streaming.follow import release_in_order

    a = V.arrivals(spark, sf_dir)
    a = a.where(F.col("round") != a.agg(F.max("round")).first()[0] - 50)
    text = F.col("round").cast("string")
    rows = a.select(F.lit("all").alias("chain"), "round", text.alias("block_hash"), F.when(F.col("round") > 0, (F.col("round") - 1).cast("string")).otherwise("").alias("previous_block_hash"))
    folder = shared_path(spark, "stream")
    late = F.col("round") + F.pmod(F.xxhash64("round"), F.lit(500))  # up to 500 rounds late, and shuffled within a file
    rows.repartitionByRange(5, late).sortWithinPartitions(F.xxhash64("round")).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    q = release_in_order(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out").where("linked").select("chain", "round", "block_hash")


@_query(f"SELECT CAST(round // 1000 * 1000 AS BIGINT) AS segment_start, round, block_hash, previous_block_hash FROM v_blocks WHERE round BETWEEN 450 AND 1400")
def segment_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written as an archive and a range of them read back."""
    from blockflow.runtime import shared_path
    from blockflow.sources import segments

    b = V.blocks(spark, sf_dir, counts=False).withColumn("raw", F.concat(F.lit("raw-"), F.col("round").cast("string")).cast("binary"))
    root = shared_path(spark, "archive")
    segments.write_archive(b, root)
    return segments.read_archive(spark, root, 450, 1400, raw=False).select("segment_start", "round", "block_hash", "previous_block_hash")


@_query("SELECT round, timestamp, CAST(txn_count % 5 AS INTEGER) AS txn_count, true AS decodable, true AS same_payload FROM v_blocks")
def decode_raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each block's figures written as a payload, decoded again, and compared with the payload's own figures."""
    from blockflow.functions.chain import decode_blocks, encode_blocks

    b = V.blocks(spark, sf_dir).withColumn("txn_count", F.col("txn_count") % 5)
    d = decode_blocks(encode_blocks(b), "raw", ("round", "block_hash"))
    x = F.col("decoded")
    return d.select("round", x.timestamp.alias("timestamp"), x.txn_count.alias("txn_count"), x.decodable.alias("decodable"), ((x.round == F.col("round")) & (x.block_hash == F.col("block_hash")) & (F.size(x.transactions) == x.txn_count)).alias("same_payload"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

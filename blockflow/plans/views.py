"""Blocks, transactions, arrivals and balances as views over the driver's tables.

Each view builds only the joins and windows that the wanted columns need, so a query that reads round and timestamp
scans one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockflow.runtime import read_table

#: Every transaction of one block, in payset order: all columns, so that the order is total.
PAYSET_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _hash() -> Column:
    return F.sha2(F.concat(F.lit("BH"), F.col("o_orderkey").cast("string"), F.lit("|"), F.col("o_custkey").cast("string"), F.lit("|"), "o_orderstatus", F.lit("|"), "o_orderpriority"), 256)


def blocks(spark: SparkSession, sf_dir: str, previous: bool = True, counts: bool = True) -> DataFrame:
    """round, block_hash, [previous_block_hash], timestamp, [txn_count]."""
    orders = read_table(spark, sf_dir, "orders")
    out = orders.select(F.col("o_orderkey").alias("round"), _hash().alias("block_hash"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("timestamp"))
    if previous:
        before = orders.select((F.col("o_orderkey") + 1).alias("round"), _hash().alias("_before"))
        out = out.join(before, "round", "left").withColumn("previous_block_hash", F.coalesce("_before", F.lit(""))).drop("_before")
    if counts:
        n = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("round")).agg(F.count(F.lit(1)).cast("int").alias("_n"))
        out = out.join(n, "round", "left").withColumn("txn_count", F.coalesce("_n", F.lit(0))).drop("_n")
    columns = ["round", "block_hash", *["previous_block_hash"] * previous, "timestamp", *["txn_count"] * counts]
    return out.select(*columns)


def transactions(spark: SparkSession, sf_dir: str, ordinal: bool = False) -> DataFrame:
    """round, txid, sender, type, app_id, [intra]."""
    # named before the window, whose partitions it makes: filters of rounds then reach the scan
    items = read_table(spark, sf_dir, "lineitem").withColumn("round", F.col("l_orderkey"))
    kind = F.when(F.col("l_returnflag") == "A", "appl").when(F.col("l_returnflag") == "N", "pay").otherwise("axfer")
    columns = [
        F.col("round"), F.concat(F.col("round").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("txid"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("sender"), kind.alias("type"),
        F.when(F.col("l_returnflag") == "A", F.nullif(F.col("l_partkey"), F.lit(0).cast("bigint"))).alias("app_id"),
    ]
    if ordinal:
        columns.append(F.row_number().over(Window.partitionBy("round").orderBy(*PAYSET_ORDER)).alias("intra"))
    return items.select(*columns)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """round, ts, latency, event_type."""
    return read_table(spark, sf_dir, "events").select(F.col("event_id").alias("round"), "ts", F.col("value").alias("latency"), "event_type")


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sender, balance_micro; every seventh sender is unknown."""
    s = read_table(spark, sf_dir, "supplier").where("s_suppkey % 7 <> 3")
    return s.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sender"), F.round(F.col("s_acctbal") * 1000000).cast("bigint").alias("balance_micro"))


def archive_copy(blocks_: DataFrame) -> DataFrame:
    """A copy of blocks with known damage: hashes, previous hashes, and missing rounds."""
    return blocks_.where("round % 983 <> 11").withColumns(
        {
            "block_hash": F.when(F.col("round") % 997 == 5, F.lit("corrupt")).otherwise(F.col("block_hash")),
            "previous_block_hash": F.when(F.col("round") % 991 == 7, F.lit("corrupt")).otherwise(F.col("previous_block_hash")),
        }
    )


#: The same views in DuckDB SQL.
VIEWS_SQL = """
v_hash AS (
  SELECT o_orderkey AS round, sha256('BH' || CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus || '|' || o_orderpriority) AS block_hash,
         CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS timestamp
  FROM orders),
v_count AS (SELECT l_orderkey AS round, CAST(count(*) AS INTEGER) AS n FROM lineitem GROUP BY 1),
v_blocks AS (
  SELECT h.round, h.block_hash, coalesce(p.block_hash, '') AS previous_block_hash, h.timestamp, CAST(coalesce(c.n, 0) AS INTEGER) AS txn_count
  FROM v_hash h LEFT JOIN v_hash p ON p.round = h.round - 1 LEFT JOIN v_count c ON c.round = h.round),
v_transactions AS (
  SELECT l_orderkey AS round, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS txid, 'S' || CAST(l_suppkey AS VARCHAR) AS sender,
         CASE l_returnflag WHEN 'A' THEN 'appl' WHEN 'N' THEN 'pay' ELSE 'axfer' END AS type,
         CASE WHEN l_returnflag = 'A' THEN nullif(l_partkey, 0) END AS app_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INTEGER) AS intra
  FROM lineitem),
v_arrivals AS (SELECT event_id AS round, ts, value AS latency, event_type FROM events),
v_balances AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS sender, CAST(round(s_acctbal * 1000000) AS BIGINT) AS balance_micro FROM supplier WHERE s_suppkey % 7 <> 3),
v_copy AS (
  SELECT round, CASE WHEN round % 997 = 5 THEN 'corrupt' ELSE block_hash END AS block_hash,
         CASE WHEN round % 991 = 7 THEN 'corrupt' ELSE previous_block_hash END AS previous_block_hash, timestamp, txn_count
  FROM v_blocks WHERE round % 983 <> 11)
"""

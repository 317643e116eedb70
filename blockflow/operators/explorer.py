"""Explorer queries over blocks and transactions.

Limits that are out of range are reset to the default, not clamped. Filters are added only for arguments that are
given, so that they reach the scan. Ties that the data leave open are broken by the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_COLUMNS = ("round", "block_hash", "previous_block_hash", "timestamp", "txn_count")


def page(limit: object, most: int = 200, default: int = 40) -> int:
    """A limit from a query string: what isn't a number from 1 to ``most`` counts as the default."""
    n = number(limit)
    return n if 0 < n <= most else default


def number(value: object) -> int:
    """A non-negative number from a query string, 0 for anything else."""
    try:
        return max(0, int(str(value).strip()))
    except ValueError:
        return 0


def top(limit: object) -> int:
    return page(limit, 50, 10)


def recent_blocks(blocks: DataFrame, limit: object = 40, before: object = 0) -> DataFrame:
    """The newest blocks, or the newest below a round."""
    b = number(before)
    rows = blocks.where(F.col("round") < b) if b else blocks
    return rows.select(*BLOCK_COLUMNS).orderBy(F.desc("round")).limit(page(limit))


def newest(rows: DataFrame, rounds: DataFrame, limit: object = 40) -> DataFrame:
    """``rows`` from the round on that the last of the ``limit`` newest of ``rounds`` has: joins and ranks need no others."""
    last = rounds.select("round").orderBy(F.desc("round")).limit(page(limit)).agg(F.min("round")).first()[0]
    return rows if last is None else rows.where(F.col("round") >= last)


def block_by_round(blocks: DataFrame, round_: int) -> DataFrame:
    return blocks.where(F.col("round") == round_).select(*BLOCK_COLUMNS)


def recent_transactions(transactions: DataFrame, limit: object = 40, round_: object = 0, sender: str = "", app_id: object = 0) -> DataFrame:
    """round, txid, sender, type, app_id (0 if none) of the newest transactions that fit the given filters."""
    conditions = [F.col(c) == v for c, v in (("round", number(round_)), ("sender", sender), ("app_id", number(app_id))) if v]
    rows = transactions
    for c in conditions:
        rows = rows.where(c)
    return rows.orderBy(F.desc("round"), F.desc("intra")).limit(page(limit)).select("round", "txid", "sender", "type", F.coalesce("app_id", F.lit(0)).alias("app_id"))


def block_detail(blocks: DataFrame, transactions: DataFrame, round_: int, limit: int = 200) -> DataFrame:
    """A block with its transactions (at most ``limit``, last first); one row without any if it has none."""
    t = recent_transactions(transactions, limit, round_).withColumnRenamed("round", "_round")
    return block_by_round(blocks, round_).join(t, F.col("round") == F.col("_round"), "left").drop("_round")


def status(blocks: DataFrame, transactions: DataFrame, checkpoint: int | None) -> DataFrame:
    """One row: last_processed_round, block_count, tx_count, min_round, max_round, unique_senders."""
    b = blocks.agg(F.count(F.lit(1)).alias("block_count"), F.coalesce(F.min("round"), F.lit(0)).alias("min_round"), F.coalesce(F.max("round"), F.lit(0)).alias("max_round"))
    t = transactions.agg(F.count(F.lit(1)).alias("tx_count"), F.countDistinct("sender").alias("unique_senders"))
    last = checkpoint if checkpoint is not None and checkpoint >= 0 else 0
    # both sides have one row
    return b.crossJoin(t).select(F.lit(last).cast("bigint").alias("last_processed_round"), "block_count", "tx_count", "min_round", "max_round", "unique_senders")


def top_senders(transactions: DataFrame, limit: object = 10) -> DataFrame:
    """sender, tx_count, rounds_active of the senders with the most transactions."""
    stats = transactions.groupBy("sender").agg(F.count(F.lit(1)).alias("tx_count"), F.countDistinct("round").alias("rounds_active"))
    return stats.orderBy(F.desc("tx_count"), "sender").limit(top(limit))


def with_balances(senders: DataFrame, balances: DataFrame) -> DataFrame:
    """Adds balance_micro, balance and balance_known; ``senders`` is the short side, a page of at most 50 rows."""
    found = F.broadcast(senders).join(balances, "sender", "left")
    micro = F.coalesce("balance_micro", F.lit(0))
    return found.select(*senders.columns, micro.alias("balance_micro"), (micro / 1e6).alias("balance"), F.col("balance_micro").isNotNull().alias("balance_known"))


def top_apps(transactions: DataFrame, limit: object = 10) -> DataFrame:
    """app_id, call_count, unique_senders, rounds_active, last_round of the applications with the most calls."""
    calls = transactions.where("app_id is not null and app_id > 0")
    stats = calls.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("call_count"), F.countDistinct("sender").alias("unique_senders"), F.countDistinct("round").alias("rounds_active"), F.max("round").alias("last_round")
    )
    return stats.orderBy(F.desc("call_count"), F.desc("last_round"), "app_id").limit(top(limit))


def busy_blocks(blocks: DataFrame, limit: object = 10) -> DataFrame:
    return blocks.where("txn_count > 0").select(*BLOCK_COLUMNS).orderBy(F.desc("txn_count"), F.desc("round")).limit(top(limit))


def short(text: Column, left: int = 8, right: int = 6) -> Column:
    """A long identifier with its middle left out."""
    cut = F.concat(F.substr(text, F.lit(1), F.lit(left)), F.lit("…"), F.right(text, F.lit(right)))
    return F.when(F.length(text) <= left + right + 1, text).otherwise(cut)


def as_json(df: DataFrame, to: str = "json") -> DataFrame:
    """Each row as a JSON object; nulls are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(to))

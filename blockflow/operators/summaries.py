"""Latency summaries, histograms and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latency_summary(rows: DataFrame, value: Column, cells: int = 1 << 20) -> DataFrame:
    """One row: n, avg (integer part), p50, p95 of an integer value, each at the floor index of the sorted values.

    The value is counted first, so what is sorted is the distinct values and not the rows; the running count is taken
    within cells of the value range and each cell gets the counts of those below it.
    """
    counts = rows.select(value.cast("bigint").alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    keyed = counts.withColumn("cell", F.floor(F.col("v") / cells))
    below = keyed.groupBy("cell").agg(F.sum("c").alias("s")).withColumn("base", F.sum("s").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))).select("cell", F.coalesce("base", F.lit(0)).alias("base"))
    upto = F.sum("c").over(Window.partitionBy("cell").orderBy("v"))
    ranked = keyed.withColumn("upto", upto).join(below, "cell").select("v", "c", (F.col("base") + F.col("upto")).alias("upto"))
    total = counts.agg(F.sum("c").alias("n"), F.sum(F.col("v") * F.col("c")).alias("sum"))
    at = lambda i: F.min(F.when(F.col("upto") > i, F.col("v")))
    n = F.col("n")
    return ranked.crossJoin(F.broadcast(total)).groupBy("n", "sum").agg(at(F.expr("n * 50 div 100")).alias("p50"), at(F.least(F.expr("n * 95 div 100"), n - 1)).alias("p95")).select("n", F.expr("sum div n").alias("avg"), "p50", "p95")


#: Upper bounds of the fetch histogram's buckets, in seconds (fixed values).
FETCH_BUCKETS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)


def histogram(rows: DataFrame, value: Column, bounds: tuple[float, ...] = FETCH_BUCKETS, by: tuple[str, ...] = ()) -> DataFrame:
    """[by], le, count: cumulative buckets up to +Inf, in one pass."""
    sums = [F.sum(F.when(value <= b, 1).otherwise(0)).cast("bigint") for b in bounds] + [F.count(value)]
    names = [*(repr(float(b)) for b in bounds), "+Inf"]
    a = rows.groupBy(*by).agg(F.array(*(F.struct(F.lit(n).alias("le"), s.alias("count")) for n, s in zip(names, sums, strict=True))).alias("b"))
    return a.select(*by, F.explode("b").alias("x")).select(*by, "x.le", "x.count")


def throughput(rows: DataFrame, ts: Column, seconds: int = 1) -> DataFrame:
    """window_start, blocks, per_second for each window that has a row."""
    start = F.expr(f"{seconds}") * F.floor(F.unix_timestamp(ts.cast("timestamp")) / seconds)
    return rows.groupBy(start.alias("window_start")).agg(F.count(F.lit(1)).alias("blocks")).withColumn("per_second", F.col("blocks") / F.lit(float(seconds)))


def counters(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("total"))

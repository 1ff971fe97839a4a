"""Counts: distributions, their order, top groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def distributions(rows: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, bucket, n): value counts of several columns at once; null is unknown. One unpivot, one shuffle."""
    tall = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.coalesce(c.cast("string"), F.lit("unknown")).alias("bucket")) for m, c in metrics.items()))).alias("m")
    return rows.select(tall).groupBy("m.metric", "m.bucket").agg(F.count("*").alias("n"))


def distribution_order(counts: DataFrame, numeric: bool = True) -> DataFrame:
    """``counts`` (metric, bucket, n) with place: numbers ascending (other texts merged into other) or names, unknown last."""
    number = F.col("bucket").try_cast("bigint")
    if numeric:
        bucket = F.when((F.col("bucket") == "unknown") | number.isNotNull(), F.col("bucket")).otherwise("other")
        counts = counts.groupBy("metric", bucket.alias("bucket")).agg(F.sum("n").alias("n"))
        order = [F.col("bucket") == "unknown", F.col("bucket") == "other", F.col("bucket").try_cast("bigint")]
    else:
        order = [F.col("bucket") == "unknown", F.lower("bucket"), F.col("bucket")]
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("metric").orderBy(*order)))


def distribution_totals(counts: DataFrame) -> DataFrame:
    """(metric, buckets, total): distinct buckets without unknown, and the sum of all."""
    return counts.groupBy("metric").agg(F.count_if(F.col("bucket") != "unknown").alias("buckets"), F.sum("n").alias("total"))


def first_examples(rows: DataFrame, keys: list[str], order: str, value: str, n: int) -> DataFrame:
    """(keys, examples): the first ``n`` values of each key by ``order``, an ordered array; Spark limits ranks on the map side."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    few = rows.withColumn("_rank", rank).where(F.col("_rank") <= n)
    return few.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", value))), lambda x: x[value]).alias("examples"))


def top_groups(counts: DataFrame, k: int) -> DataFrame:
    """(metric, bucket, n, place, groups): the ``k`` largest buckets of each metric, ties by name, and how many there are."""
    order = Window.partitionBy("metric").orderBy(F.desc("n"), F.lower("bucket"), "bucket")
    total = counts.groupBy("metric").agg(F.count("*").alias("groups"))
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).join(total, "metric")

"""Costly parsing of texts that repeat: each distinct text once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: A dictionary goes to all tasks up to so many bytes; beyond that it is joined by a shuffle, which AQE splits at hot texts.
BROADCAST_BYTES = 32 << 20
#: Texts of which a greater share is distinct are parsed where they are.
WORTH = 0.5


def by_distinct(rows: DataFrame, column: str, parse: Callable[[DataFrame, str], DataFrame], worth: float = WORTH) -> DataFrame:
    """``parse(rows, column)``, for a ``parse`` that adds columns which hang on ``column`` alone: the same rows, but each
    distinct text is parsed once and joined back.

    An estimate of the distinct texts tells whether that pays. The dictionary is written; what it holds in bytes, counted
    from there, tells whether it is sent to all tasks. Nulls are a text of their own.
    """
    spark = rows.sparkSession
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(column).alias("distinct")).first()
    if seen["distinct"] > worth * seen["n"]:
        return parse(rows, column)
    path = scratch_path(spark, "dictionary")
    made = parse(rows.select(column).distinct(), column).withColumnRenamed(column, "_text")
    made.write.parquet(path)
    known = spark.read.schema(made.schema).parquet(path)
    size = known.agg(F.sum(F.length(F.to_json(F.struct(*known.columns))))).first()[0] or 0
    known = F.broadcast(known) if size <= BROADCAST_BYTES else known
    new = [c for c in made.columns if c != "_text"]
    own = rows.drop(*new)
    return own.join(known, F.col(column).eqNullSafe(F.col("_text")), "left").select(*own.columns, *new)

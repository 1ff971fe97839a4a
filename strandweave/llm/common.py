"""Helpers shared by the training-data operators: shared scratch tables, size-checked broadcasts, connected components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: White space as the text contracts define it: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: A side is broadcast only up to this many estimated bytes; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
#: A row of one or two longs in a broadcast hash table.
PAIR_BYTES = 64

#: Rows of an Arrow batch of texts, at most.
BATCH_ROWS = 512


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, for texts on their way to Python: batches of at most BATCH_ROWS rows from now on in this session, so that
    neither side holds many texts at once. A smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and any executor can read it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, when all that reads them has been written in turn."""
    for t in tables:
        path = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, a side of a join that shuffles both. Spark sizes a table by its compressed files, and the rows that an explode or
    a Python function adds by those that go in; on such a size it would broadcast what the driver can't hold."""
    return df.hint("merge")


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` fit BROADCAST_BYTES, else for a shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else shuffled(df)


def strip_spaces(text: Column) -> Column:
    """``text`` without white space (SPACES); null counts as empty."""
    return reduce(lambda c, ch: F.replace(c, F.lit(ch), F.lit("")), SPACES, F.coalesce(text, F.lit("")))


def word_count(text: Column) -> Column:
    """Number of maximal runs outside SPACES, as long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash01(*cols: Column, seed: int) -> Column:
    """A 64-bit hash as a permutation key: the same rows get the same key in every run."""
    return F.xxhash64(F.lit(seed), *cols)


def connected_components(edges: DataFrame, name: str, rounds: int = 40) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (columns a, b): the smallest node that can be reached.

    Alternating large and small stars: each round is two groupings by node with map-side minima and two joins, so
    a hub is a skewed join that AQE can split; the number of rounds grows with the logarithm of the diameter.
    An empty edge table gives an empty result. Null ends and self-loops are ignored.
    """
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    cur = materialize(cur, name)
    mark = None
    for _ in range(rounds):
        now = cur.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (now["n"], now["x"]) == mark or not now["n"]:
            break
        mark = (now["n"], now["x"])
        both = cur.union(cur.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(small(least, 2 * now["n"], PAIR_BYTES), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(small(least, 2 * now["n"], PAIR_BYTES), "u")
        new = near.select("u", F.col("m").alias("v")).union(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        new = materialize(new, name)
        discard(cur)
        cur = new
    else:
        raise RuntimeError(f"{name}: components did not settle in {rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(cur.select("v", "v").distinct())

"""Sharding: a hypergeometric communication matrix, local permutations and an exchange make an exact uniform shuffle."""

from __future__ import annotations

from math import exp, lgamma, log, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hash01, materialize, small

#: Rows that a permuting task holds, about; more rows make more parts.
PART_ROWS = 200_000
#: The communication matrix has one row per part and is drawn on the driver.
MAX_PARTS = 20_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good; exact by numpy below 10^9, beyond it by rejection."""
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if n == good + bad:
        return good
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n))
    lo, hi = max(0, n - bad), min(good, n)
    total = good + bad
    mean = n * good / total
    spread = sqrt(max(1.0, n * good / total * bad / total * (total - n) / (total - 1)))

    def weight(k: int) -> float:
        return -(lgamma(k + 1) + lgamma(good - k + 1) + lgamma(n - k + 1) + lgamma(bad - n + k + 1))

    mode = min(hi, max(lo, (n + 1) * (good + 1) // (total + 2)))
    top, width = weight(mode), 1.6 * spread + 1.0
    while True:  # ratio of uniforms about the mode
        u, v = 1.0 - rng.random(), rng.random() * 2 - 1
        k = int(np.floor(mean + 0.5 + width * v / u))
        if lo <= k <= hi and 2 * log(u) <= weight(k) - top and exp(weight(k) - top) > 0:
            return k


def matrix(rng: np.random.Generator, parts: list[int], sizes: list[int]) -> np.ndarray:
    """Rows of part p that go to shard j: row sums are ``parts``, column sums ``sizes``, and the draw is that of a
    uniform permutation of all rows."""
    left, out = [int(x) for x in sizes], np.zeros((len(parts), len(sizes)), dtype=np.int64)
    for p, n in enumerate(parts):
        pool = sum(left)
        for j, own in enumerate(left):
            out[p, j] = k = hypergeometric(rng, own, pool - own, n)
            pool -= own
            n -= k
            left[j] -= k
    return out


def shuffle(docs: DataFrame, keys: list[Column], shards: int, seed: int = 11) -> DataFrame:
    """``docs`` with shard (int) and slot (long): a uniform shuffle into shards whose row counts differ by one at most.

    ``keys`` identify a row: rows equal in all of them are interchangeable. Rows fall into parts by a hash; from
    the exact part sizes (one number per part comes to the driver) ``matrix`` draws how many rows each part sends
    to each shard; each part permutes its rows by a hash and cuts them by its row of the matrix; then each shard
    permutes what it got. A shard's slots count its rows in the order of a second hash, in pieces: pieces are
    ranges of that hash with exact sizes, so no task holds a shard whole. Column names in use are prefixed; existing
    shard and slot columns are replaced. Hashes and ``seed`` decide all: reruns agree. Empty tables stay empty.
    """
    spark = docs.sparkSession
    total = docs.count()
    parts = int(min(MAX_PARTS, max(shards, -(-total // PART_ROWS))))
    base = docs.drop("shard", "slot").withColumn("_sw_h", hash01(*keys, seed=seed)).withColumn("_sw_g", hash01(*keys, seed=seed + 1))
    base = base.withColumn("_sw_part", F.pmod(F.xxhash64("_sw_h"), F.lit(parts)).cast("int"))
    counts = dict(base.groupBy("_sw_part").count().collect())
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    drawn = matrix(np.random.default_rng(seed), [counts.get(p, 0) for p in range(parts)], sizes)
    cuts = spark.createDataFrame([(p, [int(x) for x in np.cumsum(drawn[p])]) for p in range(parts) if counts.get(p)], "_sw_part int, _sw_cuts array<long>")
    rank = F.row_number().over(Window.partitionBy("_sw_part").orderBy("_sw_h", *keys))
    sent = base.withColumn("_sw_r", rank).join(small(cuts, parts * shards, 8), "_sw_part")
    sent = sent.withColumn("shard", F.size(F.filter("_sw_cuts", lambda c: c < F.col("_sw_r"))).cast("int")).drop("_sw_cuts", "_sw_r", "_sw_part", "_sw_h")
    pieces = max(1, parts // shards)
    sent = sent.withColumn("_sw_piece", F.pmod(F.shiftrightunsigned("_sw_g", 8), F.lit(pieces)).cast("int"))
    sent = materialize(sent, "shuffle-sent")
    held = sent.groupBy("shard", "_sw_piece").agg(F.count("*").alias("_sw_n"))
    before = F.sum("_sw_n").over(Window.partitionBy("shard").orderBy("_sw_piece")) - F.col("_sw_n")
    held = held.select("shard", "_sw_piece", before.alias("_sw_before"))
    place = F.row_number().over(Window.partitionBy("shard", "_sw_piece").orderBy("_sw_g", *keys)) - 1
    return sent.withColumn("slot", place.cast("long")).join(F.broadcast(held), ["shard", "_sw_piece"]).withColumn("slot", F.col("slot") + F.col("_sw_before")).drop("_sw_before", "_sw_piece", "_sw_g")

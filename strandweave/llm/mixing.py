"""Mixing sources to target weights: quotas of permuted blocks, split among output shards, drawn and shuffled."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from ..operators.ordering import with_places
from .common import hash01, materialize, word_count
from .sharding import hypergeometric

#: Weights of the sources in code point order, repeating; share of all words; most uses of a text.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Blocks over all sources, about (each source has one at least); output shards.
BLOCKS, SHARDS = 4096, 16
#: Words that a task of ``draw`` holds, about, and its tasks, at most: beyond that, tasks grow with the words.
TASK_WORDS, MAX_TASKS = 2_000_000, 16_384
#: Sources that a node of the splitting tree parts at once; more are parted in levels.
FAN = 4096
#: Tables of so many sources and blocks are broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000


def even(total: int, shards: int) -> np.ndarray:
    """``total`` in ``shards`` shares that differ by one at most."""
    return np.diff([total * k // shards for k in range(shards + 1)])


def split_quotas(rng: np.random.Generator, quotas: np.ndarray, shards: int | np.ndarray) -> np.ndarray:
    """(shards, sources) matrix of blocks: at each node of a binary tree over the shards, a multivariate hypergeometric draw
    gives the left half its part of the node's blocks; rows sum to what each shard gets (a number of shards: even shares)
    and columns to ``quotas``, exactly."""
    rows = even(int(quotas.sum()), shards) if isinstance(shards, int) else np.asarray(shards)
    if len(rows) == 1:
        return quotas[None, :]
    half = len(rows) // 2
    take, pool = int(rows[:half].sum()), int(quotas.sum())
    left = np.zeros_like(quotas)
    for i, q in enumerate(quotas):
        left[i] = hypergeometric(rng, int(q), pool - int(q), take)
        pool -= int(q)
        take -= int(left[i])
    return np.vstack([split_quotas(rng, left, rows[:half]), split_quotas(rng, quotas - left, rows[half:])])


def split_sources(uses: DataFrame, shards: int, seed: int) -> DataFrame:
    """(_sw_s, drawn array<long>): for each source the blocks that each shard draws, of (_sw_s, uses).

    The tree's quotas are those of FAN ranges of sources at first, then of the sources (or ranges) in each: a node has its
    shards' shares from above and parts them among its children by ``split_quotas``. A task holds FAN quotas, whatever the
    number of sources, and every number is split in this way.
    """
    sizes = uses.agg(F.max("_sw_s").alias("last"), F.sum("uses").alias("total")).first()
    levels = 1
    while FAN**levels <= (sizes["last"] or 0):
        levels += 1
    nodes = uses.sparkSession.createDataFrame([(0, [int(x) for x in even(int(sizes["total"] or 0), shards)])], "node long, drawn array<long>")

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("child")
        rng = np.random.default_rng([seed, int(rows["width"].iloc[0]), int(rows["node"].iloc[0])])
        matrix = split_quotas(rng, rows["uses"].to_numpy(), np.array(rows["drawn"].iloc[0]))
        return pd.DataFrame({"node": rows["child"], "drawn": list(matrix.T)})

    for level in reversed(range(levels)):
        width = FAN**level
        child = F.floor(F.col("_sw_s") / width).cast("long")
        children = uses.groupBy(child.alias("child")).agg(F.sum("uses").alias("uses")).withColumns({"node": F.floor(F.col("child") / FAN).cast("long"), "width": F.lit(width)})
        nodes = children.join(nodes, "node").groupBy("node").applyInPandas(split, "node long, drawn array<long>")
    return nodes.withColumnRenamed("node", "_sw_s")


def owners_of(blocks: DataFrame, drawn: DataFrame, seed: int) -> DataFrame:
    """``blocks`` (with _sw_s, _sw_block, uses) with _sw_owners: the shard of each use, a permutation of what the source's
    shards draw. Sources go by FAN to a task, with their blocks."""
    schema = StructType([*(f for f in blocks.schema), StructField("_sw_owners", ArrayType(IntegerType()))])

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_sw_s", "_sw_block"])
        out = []
        for s, own in rows.groupby("_sw_s", sort=True):
            counts = np.array(own["drawn"].iloc[0], dtype=np.int64)
            dealt = np.random.default_rng([seed, 1, int(s)]).permutation(np.repeat(np.arange(len(counts)), counts))
            ends = np.cumsum(own["uses"].to_numpy())
            out += [dealt[end - n : end].tolist() for end, n in zip(ends, own["uses"], strict=True)]
        return rows.assign(_sw_owners=out)[[f.name for f in schema]]

    with_counts = blocks.join(drawn, "_sw_s")
    return with_counts.groupBy(F.floor(F.col("_sw_s") / FAN)).applyInPandas(assign, schema)


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``docs`` with _sw_id, _sw_source, _sw_crc (of the text; null: empty) and _sw_h, their place in the permutation."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    named = docs.withColumns({"_sw_id": F.col(id_col), "_sw_source": F.col(source_col), "_sw_crc": F.crc32(text)})
    return named.withColumn("_sw_h", hash01("_sw_id", "_sw_source", "_sw_crc", seed=seed))


def share_of(h: Column, n: Column) -> Column:
    """Which of ``n`` equal ranges of all longs holds ``h``, from 0."""
    up = F.shiftrightunsigned(h.bitwiseXOR(F.lit(-(1 << 63)).cast("long")), 1) / F.lit(float(1 << 63))
    return F.least(F.floor(up * n), n - 1)


@dataclass
class Mix:
    """What the draws hang on: small tables of sources and blocks, and the words that are drawn."""

    sources: DataFrame
    blocks: DataFrame
    limits: DataFrame
    words: float
    seed: int
    bounded: bool

    def decide(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``keyed`` with _sw_source_size, _sw_target, _sw_copies, _sw_shards and _sw_places; no shuffle
        while the tables are ``bounded``."""
        side = F.broadcast if self.bounded else lambda df: df
        out = rows.join(side(self.sources), F.col("_sw_source").eqNullSafe(F.col("_sw_name")))
        out = out.withColumn("_sw_block", share_of(F.col("_sw_h"), F.col("_sw_blocks")))
        out = out.join(side(self.blocks), ["_sw_s", "_sw_block"]).join(side(self.limits), ["_sw_s", "_sw_block"], "left")
        last = (F.col("_sw_room") >= F.col("_sw_held")) | F.coalesce(F.col("_sw_h") <= F.col("_sw_limit"), F.lit(False))
        out = out.withColumn("_sw_copies", (F.col("_sw_whole") + last.cast("int")).cast("int"))
        out = out.withColumn("_sw_shards", F.slice("_sw_owners", F.lit(1), F.col("_sw_copies")))
        return out.withColumn("_sw_places", F.transform("_sw_shards", lambda shard, nth: hash01("_sw_h", shard, nth, seed=self.seed + 1)))


def last_places(placed: DataFrame, blocks: DataFrame) -> DataFrame:
    """(_sw_s, _sw_block, _sw_limit): of the blocks in which a target falls, the last place whose rows still fit."""
    falls = blocks.where("_sw_room >= 0 and _sw_room < _sw_held").select("_sw_s", "_sw_block", "_sw_room")
    so_far = F.sum("_sw_size").over(Window.partitionBy("_sw_s", "_sw_block").orderBy("_sw_h"))  # rows of one place count together
    rows = placed.join(falls, ["_sw_s", "_sw_block"]).withColumn("_sw_sum", so_far).where("_sw_sum <= _sw_room")
    return materialize(rows.groupBy("_sw_s", "_sw_block").agg(F.max("_sw_h").alias("_sw_limit")), "mix-limits")


def mix(sized: DataFrame, seed: int, shards: int) -> Mix:
    """Targets, blocks and their owners from the rows of ``keyed`` with _sw_size.

    Each source's rows are permuted by a hash and cut into blocks of that order. A source whose target is e times its
    size takes every row floor(e) times; of the rest, blocks are taken in order while their words fit, and the block
    in which the target falls gives rows, in order, while theirs fit. Totals, targets and blocks are tables, whatever the
    number of sources: weights follow the sources' places in code point order; the share of one weight, from which sources
    stop at MOST times their size, is found by sums over all sources, again until no further source stops. The uses of
    blocks are quotas that ``split_sources`` deals to the shards.
    """
    per = materialize(sized.groupBy("_sw_source").agg(F.sum("_sw_size").alias("words"), F.count("*").alias("n")), "mix-sources")
    everything = per.agg(F.sum("words").alias("n")).first()["n"]
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = materialize(with_places(per, [F.col("_sw_source").isNull(), F.col("_sw_source")]).withColumn("weight", weight).withColumn("most", F.col("words") * float(MOST)), "mix-ranked")
    level, stopped = 0.0, -1
    while True:
        stops = F.col("most") < F.lit(level) * F.col("weight")
        r = ranked.agg(F.count_if(stops).alias("n"), F.sum(F.when(stops, F.col("most")).otherwise(0.0)).alias("held"), F.sum(F.when(stops, 0.0).otherwise(F.col("weight"))).alias("by")).first()
        if r["n"] == stopped or not r["by"]:
            break
        stopped, level = r["n"], (SHARE * everything - r["held"]) / r["by"]
    blocks = F.greatest(F.lit(1), F.least(F.col("n"), F.floor(F.col("words") * float(BLOCKS) / max(1, everything or 0)))).cast("bigint")
    names = {"_sw_s": F.col("place") - 1, "_sw_name": F.col("_sw_source"), "_sw_source_size": F.col("words"), "_sw_blocks": blocks, "_sw_target": F.least("most", F.lit(level) * F.col("weight"))}
    sources = materialize(ranked.select(*(c.alias(n) for n, c in names.items())), "mix-targets")
    totals = sources.agg(F.sum("_sw_target").alias("words"), F.sum("_sw_blocks").alias("blocks")).first()
    bounded = (totals["blocks"] or 0) <= BROADCAST_ROWS
    placed = sized.join(F.broadcast(sources) if bounded else sources, F.col("_sw_source").eqNullSafe(F.col("_sw_name")))
    placed = placed.select("_sw_s", share_of(F.col("_sw_h"), F.col("_sw_blocks")).alias("_sw_block"), "_sw_h", "_sw_size")
    held = placed.groupBy("_sw_s", "_sw_block").agg(F.sum("_sw_size").alias("_sw_held")).join(sources, "_sw_s")
    whole = F.when(F.col("_sw_source_size") > 0, F.floor(F.col("_sw_target") / F.col("_sw_source_size"))).otherwise(0).cast("int")
    before = F.sum("_sw_held").over(Window.partitionBy("_sw_s").orderBy("_sw_block")) - F.col("_sw_held")  # a row for each block
    held = held.withColumn("_sw_whole", whole).withColumn("left", F.col("_sw_target") - F.col("_sw_whole") * F.col("_sw_source_size") - before)
    room = F.when(F.col("left") > 0, F.floor(F.least("left", "_sw_held"))).otherwise(-1).cast("bigint")
    held = held.select("_sw_s", "_sw_block", "_sw_held", room.alias("_sw_room"), "_sw_whole")
    held = materialize(held.withColumn("uses", (F.col("_sw_whole") + (F.col("_sw_room") >= 0).cast("int")).cast("long")), "mix-held")
    drawn = split_sources(held.groupBy("_sw_s").agg(F.sum("uses").alias("uses")), shards, seed)
    every = materialize(owners_of(held, drawn, seed).drop("uses"), "mix-blocks")
    return Mix(sources, every, last_places(placed, every), float(totals["words"] or 0), seed, bounded)


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, shards: int = SHARDS) -> DataFrame:
    """One row per input row: id, source, size, source_size, target, copies, taken, shards (array<int>), places (array<long>).

    Size is the number of words (null text: 0). Sources in code point order, null last, weigh WEIGHTS in turn and
    share SHARE of all words; a target stops at MOST times its source's size and the excess is reshared
    (``targets``). Rows are taken as ``mix`` says: a source's sum is below its target by less than one row (rows
    equal in id, source and text go together, as one). Blocks taken are quotas that ``split_quotas`` deals exactly to
    the output shards; which shard draws which block is a permutation, so the draws are disjoint. ``places`` has, for
    each shard of ``shards``, the row's place in its local shuffle: a shard's rows go by that number. Everything
    hangs on hashes of the row and on ``seed``: reruns agree. Empty tables give no rows; sources of size 0 have
    target 0; other columns are not read.
    """
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")), "id", "text", "source", seed)
    rows = materialize(rows.withColumn("_sw_size", word_count(F.col("text"))).drop("id", "source", "text"), "mix-rows")
    out = mix(rows, seed, shards).decide(rows)
    taken = (F.col("_sw_copies") * F.col("_sw_size")).cast("long")
    return out.select(F.col("_sw_id").alias(id_col), F.col("_sw_source").alias(source_col), *(F.col(f"_sw_{c}").alias(c) for c in ("size", "source_size", "target", "copies")), taken.alias("taken"), F.col("_sw_shards").alias("shards"), F.col("_sw_places").alias("places"))


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, shards: int = SHARDS, task_words: int = TASK_WORDS) -> DataFrame:
    """The mix: ``docs`` with each row as often as ``plan`` takes it, columns unchanged, dealt to output shards and in
    each ordered by its local shuffle (``places``).

    Texts move once. A shard lies in consecutive partitions, each a range of the places, as many as its words need at
    ``task_words`` each: no partition holds two shards, and none grows with the table. An empty table stays empty.
    """
    own = docs.columns
    rows = keyed(docs, id_col, text_col, source_col, seed)
    sized = materialize(rows.select("_sw_source", "_sw_h", word_count(F.col(text_col)).alias("_sw_size")), "mix-rows")
    drawn = mix(sized, seed, shards)
    pieces = max(1, int(-(-drawn.words // (shards * max(task_words, drawn.words / MAX_TASKS)))))
    mixed = drawn.decide(rows).where("_sw_copies > 0").select(*own, F.explode(F.arrays_zip("_sw_shards", "_sw_places")).alias("_sw_at"))
    mixed = mixed.select(*own, F.col("_sw_at._sw_places").alias("_sw_place"), F.col("_sw_at._sw_shards").alias("_sw_shard"))
    part = (F.col("_sw_shard") * pieces + share_of(F.col("_sw_place"), F.lit(pieces))).cast("int")
    return mixed.withColumn("_sw_part", part).repartitionById(shards * pieces, F.col("_sw_part")).sortWithinPartitions("_sw_place").select(*own)

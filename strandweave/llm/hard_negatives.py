"""Hard-negative mining: scores by blocks, a secondary sort of packed keys, and windows opened by a streaming iterator."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Anchor vectors that go to every task together, in bytes; more are taken in turns.
SLICE_BYTES = 16 << 20
#: Anchors and rows whose scores are held together in a task.
TILE_ANCHORS, TILE_ROWS = 512, 2048
#: Sums of products below this are exact in doubles.
EXACT = 1 << 53
LONG = (1 << 63) - 1

PAIR = "anchor long, score long, id long, positive boolean"


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part; v: floor(scale * component)."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    named = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & sound)
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    return named.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows, as int64; what no long holds stops at its ends."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in a], dtype=object) @ np.array([[int(x) for x in row] for row in b], dtype=object).T
    return np.array([[min(LONG, max(-LONG, x)) for x in row] for row in whole], dtype=np.int64)


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of a batch by length of the vectors, at most TILE_ROWS rows each, in order of the ids."""
    ids, labels, lists = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "label", "v"))
    ids, labels = ids.to_numpy(), labels.to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    starts, flat = lists.offsets.to_numpy()[:-1], lists.values.to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        for part in (rows[k : k + TILE_ROWS] for k in range(0, len(rows), TILE_ROWS)):
            yield ids[part], labels[part], flat[starts[part][:, None] + np.arange(size)[None, :]]


class Best:
    """The first ``k`` (score, id) of each of ``n`` keys seen so far: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.key, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.worst, self.last = np.full(n, -LONG - 1, dtype=np.int64), np.full(n, LONG, dtype=np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        fit = (score > self.worst[key]) | (score == self.worst[key]) & (ids < self.last[key])
        key, score, ids = key[fit], score[fit], ids[fit]
        if not len(key):
            return
        key, score, ids = np.concatenate([self.key, key]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.searchsorted(key, key, side="left")
        nth = np.arange(len(key)) - first
        full = nth == self.k - 1
        self.worst[key[full]], self.last[key[full]] = score[full], ids[full]
        keep = nth < self.k
        self.key, self.score, self.id = key[keep], score[keep], ids[keep]


def scan(rows: DataFrame, anchors, windows, k: int, tell: str) -> DataFrame:
    """Pairs of each task's best: positives (``windows`` is None), or negatives inside ``windows``.

    ``anchors`` is a broadcast (numbers, ids, labels, vectors) by length; ``windows`` one of (lows, highs): columns by
    a positive's number, rows by anchor. A task holds the scores of one tile and the best so far, nothing else.
    """
    schema = pa.schema([("anchor", pa.int64()), ("score", pa.int64()), ("id", pa.int64()), ("positive", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = anchors.value
        lows, highs = windows.value if windows is not None else (None, None)
        total = sum(len(s[0]) for s in sides.values())
        wide = 1 if windows is None else lows.shape[1]
        best = Best(total * wide, k)
        for batch in batches:
            for ids, labels, x in blocks(batch):
                if x.shape[1] not in sides:
                    continue
                numbers, own_ids, own_labels, vectors = sides[x.shape[1]]
                for at in range(0, len(numbers), TILE_ANCHORS):
                    tile = slice(at, at + TILE_ANCHORS)
                    score = products(vectors[tile], x)
                    same = own_labels[tile, None] == labels[None, :]
                    if windows is None:
                        fit = same & (own_ids[tile, None] != ids[None, :]) & (score >= best.worst[numbers[tile], None])
                        a, r = np.nonzero(fit)
                        best.add(numbers[tile][a], score[a, r], ids[r])
                        continue
                    for w in range(wide):
                        key = numbers[tile] * wide + w
                        low = np.maximum(lows[numbers[tile], w], best.worst[key])
                        a, r = np.nonzero(~same & (score >= low[:, None]) & (score <= highs[numbers[tile], w][:, None]))
                        best.add(key[a], score[a, r], ids[r])
        key, pair = best.key // wide, np.stack([best.key // wide, -best.score, best.id])
        if windows is not None and len(key):  # a row of several windows goes once
            pair = np.unique(pair, axis=1)
        for k0 in range(0, pair.shape[1], 1 << 16):
            a, s, i = pair[:, k0 : k0 + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(-s), pa.array(i), pa.array(np.full(len(a), windows is None))], schema=schema)

    return materialize(rows.mapInArrow(run, PAIR), tell)


def mined(pairs: Iterator[tuple], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) from keys (anchor, -score, 0 for a positive or
    1, id) in order: each of an anchor's first positives opens a window, each negative goes to the open ones it fits."""
    anchor, seen, open_ = None, 0, []
    for (number, minus, kind, row), _ in pairs:
        score = -minus
        if number != anchor:
            anchor, seen, open_ = number, 0, []
        if kind == 0:
            if seen < positives:
                seen += 1
                open_.append([row, score, 0])
            continue
        for window in open_:
            if low * window[1] <= 100 * score <= high * window[1]:
                window[2] += 1
                yield number, window[0], window[2], row, window[1], score
        open_ = [w for w in open_ if w[2] < negatives and low * w[1] <= 100 * score]


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``is_anchor`` holds for.

    A row's score is its inner product with the anchor, of components floor(scale * x) with x as a double. An anchor's
    positives are its first ``positives`` other rows of the same label, higher scores first, ties by smaller id; a
    positive's negatives the first ``negatives`` rows of other labels with low * positive score <= 100 * score <=
    high * positive score (``high`` is 100 or less).

    Scores are made by tiles of anchors and rows. Anchors go to the tasks in slices of SLICE_BYTES, one after the other;
    a first pass over the rows keeps each task's best positives, a second the best negatives of each positive's window,
    and nothing else is shuffled, so no anchor gathers all rows. What is left goes as keys (anchor, descending score,
    positives first, id) through ``repartitionAndSortWithinPartitions``, and an iterator opens and fills the windows.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; anchors meet rows of
    their own length only. Repeated rows are rows each; equal anchors are one; a row with an anchor's id is not another
    row. Scores beyond a long stop at its ends. Other columns are not read. No anchors or no rows: no result.
    """
    assert high <= 100
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col, scale)
    chosen = materialize(usable(vectors.where(is_anchor), id_col, vector_col, label_col, scale).distinct(), "mine-anchors")
    sizes = chosen.agg(F.count("*").alias("n"), F.sum(8 * F.size("v") + 24).alias("bytes")).first()
    slices = max(1, -(-(sizes["bytes"] or 0) // SLICE_BYTES))
    out = None
    for s in range(slices):
        some = chosen.where(F.pmod(F.xxhash64("id", "v"), F.lit(slices)) == s) if slices > 1 else chosen
        made = _slice(spark, rows, some, positives, negatives, low, high)
        out = made if out is None else out.union(made)
    return out


def _slice(spark: SparkSession, rows: DataFrame, chosen: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    got = sorted(((r["id"], r["label"], r["v"]) for r in chosen.collect()), key=lambda r: (r[0], r[1], r[2]))
    if not got:
        return spark.createDataFrame([], schema)
    ids = np.array([r[0] for r in got], dtype=np.int64)
    sides = {}
    for size in {len(r[2]) for r in got}:
        of = [k for k, r in enumerate(got) if len(r[2]) == size]
        sides[size] = (np.array(of), ids[of], np.array([got[k][1] for k in of], dtype=np.int64), np.array([got[k][2] for k in of], dtype=np.float64).reshape(len(of), size))
    anchors = spark.sparkContext.broadcast(sides)
    near = scan(rows, anchors, None, positives, "mine-positives")
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id"))
    near = materialize(near.withColumn("n", first).where(F.col("n") <= positives), "mine-first")
    lows, highs = np.full((len(got), positives), LONG), np.full((len(got), positives), -LONG)
    for r in near.collect():  # at most ``positives`` an anchor of the slice
        lows[r["anchor"], r["n"] - 1], highs[r["anchor"], r["n"] - 1] = -(-low * r["score"] // 100), high * r["score"] // 100
    windows = spark.sparkContext.broadcast((lows, highs))
    far = scan(rows, anchors, windows, negatives, "mine-negatives")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = near.select(*far.columns).union(far).rdd.map(lambda r: ((r[0], -r[1], 0 if r[3] else 1, r[2]), None))
    sent = packed.repartitionAndSortWithinPartitions(parts, lambda key: key[0])
    names = ids.tolist()
    found = sent.mapPartitions(lambda p: ((names[a], *rest) for a, *rest in mined(p, positives, negatives, low, high)))
    return spark.createDataFrame(found, schema)

"""Quality classifier: Bradley-Terry ranking on document features, thresholded at a quantile of the scores."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, hash01, materialize, small, small_batches

#: Labelled rows of a block, about, in which all of one class are compared with all of the other.
BLOCK_ROWS = 512
#: Of the quantiles that narrow down where a score of a given place lies.
ACCURACY = 10_000
#: Scores from here on are predicted good; the score at the quantile of rejected labels is mapped to it.
CUT = 0.3
#: Folds of held_out: rows of fold 0 are never learnt from.
FOLDS = 5
_ASCII = np.arange(128)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_LOWER = (_ASCII >= 97) & (_ASCII <= 122)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_SPACE = (_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13))
_SYMBOLS = [ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]
_MARKS = b".,;:!?"


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text: byte classes, symbols, word shapes and repetition; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    low = seen[:128]
    share = [low[m].sum() / n for m in (_UPPER, _LOWER, _DIGIT, _SPACE)] + [seen[128:].sum() / n, seen[10] / n, seen[:9].sum() / n]
    symbol = low[_SYMBOLS] / n
    words = raw.split()
    m = max(1, len(words))
    count = Counter(words)
    most = [c for _, c in count.most_common(3)] + [0, 0, 0]
    twice = sum(map(bytes.__eq__, words, words[1:])) / m
    skip = sum(map(bytes.__eq__, words, words[2:])) / m
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    shout = sum(map(bytes.isupper, words)) / m
    letters = sum(map(bytes.isalpha, words)) / m
    ends = sum(w[-1] in _MARKS for w in words) / m
    lines = [x for x in raw.split(b"\n") if x.strip()]
    fresh = len(set(lines)) / max(1, len(lines))
    shape = [np.log1p(len(words)), lengths.mean(), lengths.std(), (lengths > 14).mean(), (lengths < 3).mean(), shout, letters, ends]
    repeat = [len(count) / m, len(count) / m * np.log1p(m), most[0] / m, sum(most[:3]) / m, twice, skip, fresh]
    rates = np.sqrt(np.concatenate([share, symbol, [shout, twice, skip, 1 - fresh, most[0] / m]]))
    return [float(x) for x in (*rates, *share, *shape, *repeat, symbol.sum(), np.sqrt(symbol.sum()), float(not words))]


@dataclass
class Model:
    """score = sigmoid(scale * (w . (x - mean) / sd - cut) + logit(CUT))."""

    mean: np.ndarray
    sd: np.ndarray
    w: np.ndarray
    cut: float
    scale: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.sd, -8, 8) @ self.w

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.scale * (self.raw(x) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def blocks_of(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks, classes and features of rows (block, y, x)."""
    block, y, x = (rows.column(c) for c in ("block", "y", "x"))
    return block.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False).astype(bool), x.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)


def sums(rows: DataFrame, of: Callable[[Iterator[tuple[np.ndarray, np.ndarray]]], np.ndarray]) -> np.ndarray:
    """The sum over all tasks of ``of``, which takes the blocks of a task one at a time, as (classes, features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            block, held = None, []
            for b in batches:
                names, y, x = blocks_of(b)
                cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    if lo < hi:
                        if held and names[lo] != block:
                            yield np.concatenate([h[0] for h in held]), np.vstack([h[1] for h in held])
                            held = []
                        block = names[lo]
                        held.append((y[lo:hi], x[lo:hi]))
            if held:
                yield np.concatenate([h[0] for h in held]), np.vstack([h[1] for h in held])

        total = of(each())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total, pa.float64())], names=["at", "v"])

    got = rows.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    return np.array([r["v"] for r in got])


def smallest(scores: DataFrame, place: int, total: int) -> float:
    """The value at ``place`` (from 0) of the column raw in order: a narrow range about it is found by approximate
    quantiles, what lies below is counted, and only the range is sorted."""
    share, wide = place / max(1, total), 3 / ACCURACY
    while True:
        lo, hi = scores.agg(F.percentile_approx("raw", [max(0.0, share - wide), min(1.0, share + wide)], ACCURACY).alias("q")).first()["q"]
        below = scores.where(F.col("raw") < lo).count()
        found = scores.where(F.col("raw").between(lo, hi)).orderBy("raw").offset(place - below).limit(1).first() if below <= place else None
        if found:
            return found["raw"]
        wide *= 4


def train(rows: DataFrame, n_good: int, n_bad: int, l2: float = 1e-3) -> Model:
    """Bradley-Terry by logistic loss on feature differences of (good, bad) pairs; Newton steps, L2 ``l2``.

    ``rows`` (block, y, x) are all labelled rows, those of a block together: every row is compared with all rows of the
    other class in its block, which holds some BLOCK_ROWS rows by a hash of the id. Means, deviations and the steps'
    gradients and Hessians are sums that tasks make. The raw score below which as many rows lie as have bad labels is the
    threshold. With one class or none there is nothing to rank: all scores are equal, at CUT.
    """
    d, n = len(features("")), n_good + n_bad
    flat = Model(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 1.0)
    if not n_good or not n_bad:
        return flat

    def moments(blocks):
        out = np.zeros((2, d))
        for _, x in blocks:
            out += [x.sum(0), (x * x).sum(0)]
        return out.ravel()

    first, second = sums(rows, moments).reshape(2, d) / n
    mean, sd = first, np.sqrt(np.maximum(second - first * first, 0))
    sd = np.where(sd > 1e-7, sd, 1.0)
    w = np.zeros(d)

    def step_sums(w):
        def of(blocks):
            grad, hess, pairs = np.zeros(d), np.zeros((d, d)), 0
            for y, x in blocks:
                z = np.clip((x - mean) / sd, -8, 8)
                g, b = z[y], z[~y]
                if len(g) and len(b):
                    p = 1 / (1 + np.exp(-np.clip((g @ w)[:, None] - (b @ w)[None, :], -40, 40)))
                    v = p * (1 - p)
                    cross = g.T @ v @ b
                    grad += g.T @ (p - 1).sum(1) - b.T @ (p - 1).sum(0)
                    hess += (g * v.sum(1)[:, None]).T @ g + (b * v.sum(0)[:, None]).T @ b - cross - cross.T
                    pairs += p.size
            return np.concatenate([grad, hess.ravel(), [pairs]])

        return of

    for _ in range(20):
        got = sums(rows, step_sums(w))
        if not got[-1]:
            return flat  # no block holds both classes
        grad, hess = got[:d] / got[-1] + l2 * w, got[d:-1].reshape(d, d) / got[-1] + l2 * np.eye(d)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    w = np.round(w, 9)  # sums of tasks may differ in their last digits
    model = Model(mean, sd, w, 0.0, 1.0)

    def raws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, y, x = blocks_of(b)
            yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(model.raw(x) if len(y) else np.zeros(0), pa.float64())], names=["y", "raw"])

    scores = materialize(rows.mapInArrow(raws, "y boolean, raw double"), "quality-raw")
    cut = (smallest(scores, min(n_bad - 1, n - 2), n) + smallest(scores, min(n_bad, n - 1), n)) / 2  # between the last score inside the quantile and the next
    gap = smallest(scores.where("y"), n_good // 2, n_good) - smallest(scores.where("not y"), n_bad // 2, n_bad)
    discard(scores)
    return Model(mean, sd, w, cut, float(8 / max(gap, 1e-6)))


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def feature_rows(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and x, the features of the whole text."""
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("x", T.ArrayType(T.DoubleType()))])
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])

    return small_batches(docs).select(*keep, F.col(text_col).cast("string").alias("_sw_text")).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Learn from all labelled rows outside fold 0 that have a document.

    Rows with a null id or label are none; a repeated label row or document counts once (of documents of one id, the least
    features), one of contradicting labels of an id is as good as the other and both count. No text is shuffled while the
    labels fit a broadcast; the features of labelled rows are, once.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(F.col(id_col)) != 0))
    known = materialize(known.select(F.col(id_col).alias("_sw_id"), (F.col(label_col) > 0).alias("y")).distinct(), "quality-known")
    held = known.count()
    text = docs.select(F.col(id_col).alias("_sw_in"), F.col(text_col).alias("text")).join(small(known, held, 16), F.col("_sw_in") == F.col("_sw_id"))
    block = F.pmod(hash01("_sw_id", seed=5), F.lit(max(1, held // BLOCK_ROWS)))
    got = feature_rows(text, "text", ["_sw_id", "y"]).withColumn("block", block).repartition("block")
    got = got.groupBy("block", "_sw_id", "y").agg(F.min("x").alias("x")).sortWithinPartitions("block", "_sw_id", "y").select("block", "y", "x")
    rows = materialize(got, "quality-rows")
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    model = train(rows, n.get(True, 0), n.get(False, 0))
    discard(known, rows)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1; replaced if there): higher is likelier good. Null text scores as empty."""
    kept = [c for c in docs.columns if c != score_col]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(score_col, T.DoubleType())])
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(at)], dtype=float).reshape(b.num_rows, -1)
            s = model.score(x) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(s, pa.float64())], names=[*kept, score_col])

    return small_batches(docs).select(*(docs[c] for c in kept), docs[text_col].cast("string").alias("_sw_in")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``docs`` without the rows that score below CUT; columns unchanged, repeated rows judged alike."""
    model = fit(docs, labels, id_col, text_col, label_col)
    return score(docs, model, text_col, "_sw_score").where(F.col("_sw_score") >= CUT).select(*docs.columns)

"""Line deduplication: winnowed line hashes find repeated runs of lines; the first run stays, later ones go."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialize, small, small_batches

#: A run counts from this many words on.
MIN_WORDS = 50


def content(text: str | None) -> list[tuple[int, str]]:
    """(number, stripped text) of the lines that hold words, as str.split knows them: Unicode white space counts."""
    lines = ((i, line.strip()) for i, line in enumerate((text or "").split("\n")))
    return [(i, line) for i, line in lines if line]


def windows(values: list[int], words: list[int], min_words: int) -> Iterator[tuple[int, int]]:
    """(last line, place of the smallest value, the last of equals) of the window at each line.

    A window is the shortest run of lines from there with ``min_words`` words or more (none: no window).
    """
    least: deque[int] = deque()
    end, held = 0, 0
    for at in range(len(values)):
        while end < len(values) and held < min_words:
            while least and values[least[-1]] >= values[end]:
                least.pop()
            least.append(end)
            held += words[end]
            end += 1
        if held < min_words:
            return
        while least[0] < at:
            least.popleft()
        yield end - 1, least[0]
        held -= words[at]


def fingerprints(lines: list[str], min_words: int) -> Iterator[tuple[int, int, list[int], bytes]]:
    """(mark, first, ends, digests) of each selected fingerprint: the line hashes that are the least of a window.

    ``first`` is where the first of the windows that select it begins. ``ends`` has the last line of each of them,
    counted from ``first``, then one past the last line that a match can take in before another window covers it.
    ``digests`` has the 128-bit hashes of all these lines: what a match is extended by, to the left and to the right.
    """
    digest = [xxhash.xxh128_digest(t.encode("utf-8", "surrogatepass")) for t in lines]
    values = [int.from_bytes(d[:8], "little", signed=True) for d in digest]
    found = list(windows(values, [len(t.split()) for t in lines], min_words))
    at = 0
    while at < len(found):
        after = at + 1
        while after < len(found) and found[after][1] == found[at][1]:
            after += 1
        stop = max(found[after - 1][0] + 1, found[after][0] if after < len(found) else len(lines))
        yield values[found[at][1]], at, [*(end - at for end, _ in found[at:after]), stop - at], b"".join(digest[at:stop])
        at = after


def matches(ends: list[int], digests: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(first, last, key) of every run of lines about a fingerprint that can be the part of a repeated run there.

    To the left the runs go to the beginning of each window that selects the fingerprint; to the right to the end of
    that window, and on to before the end of the next one: of a repeated run, what its last window leaves over is one
    of those. The key is a 128-bit hash of the hashes of the run's lines. There are two runs a line or fewer.
    """
    for first, last in enumerate(ends[:-1]):
        run = xxhash.xxh128(digests[16 * first : 16 * (last + 1)])
        yield first, last, run.digest()
        for more in range(last + 1, ends[first + 1]):
            run.update(digests[16 * more : 16 * (more + 1)])
            yield first, more, run.digest()


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, text_key, runs): the lines that repeat an earlier run, as first, last, first, last ... in order (counted
    among lines with words, from 0; array<int>), for documents with any.

    Earlier means in a document of smaller id (null ids last; of one id, of smaller text hash), or before, without
    overlap, in the same one. All repeated runs of whole lines with ``min_words`` words or more are found, to their
    last line: a document keeps only its selected fingerprints (``fingerprints``), each with the hashes of the lines
    about it, and such a run has one in both places. Fingerprints are counted; the places of repeated ones are
    joined and extended both ways (``matches``), and each extended run is matched with its first occurrence. Counts
    and minima combine on the map side, so a passage in a third of all documents makes a few rows in each.
    """
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    marks = T.StructType([id_field, T.StructField("text_key", T.LongType()), T.StructField("mark", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("digests", T.BinaryType())])
    runs = T.StructType([id_field, T.StructField("text_key", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("key", T.BinaryType())])

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                b = whole.slice(start, 512)
                made = [(k, f) for k, t in enumerate(b.column(2)) for f in fingerprints([line for _, line in content(t.as_py())], min_words)]
                took = pa.array([k for k, _ in made], pa.int32())
                cols = [pa.array([f[c] for _, f in made], kind) for c, kind in enumerate((pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary()))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(took), b.column(1).take(took), *cols], names=marks.names)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            firsts, ends, digests = (b.column(c).to_pylist() for c in (2, 3, 4))
            made = [(k, firsts[k] + first, firsts[k] + last, key) for k in range(b.num_rows) for first, last, key in matches(ends[k], digests[k])]
            took = pa.array([m[0] for m in made], pa.int32())
            cols = [pa.array([m[c] for m in made], kind) for c, kind in ((1, pa.int32()), (2, pa.int32()), (3, pa.binary()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(took), b.column(1).take(took), *cols], names=runs.names)

    text = F.col(text_col).cast("string")
    found = small_batches(docs).select(F.col(id_col).alias("id"), text_key(text).alias("text_key"), text.alias("text")).mapInArrow(select, marks)
    found = materialize(found, "lines-marks")
    # written first: a join of two tables is one whose skew Spark can split, a join with its own grouping is not
    again = materialize(found.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"), "lines-again")
    places = found.join(again, "mark", "left_semi").select("id", "text_key", "first", "ends", "digests")
    seen = materialize(places.mapInArrow(extend, runs), "lines-runs")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "first", "last")
    firsts = materialize(seen.groupBy("key").agg(F.min(place).alias("src"), F.count("*").alias("n")).where("n > 1").select("key", "src"), "lines-firsts")
    same = F.col("id").eqNullSafe(F.col("src.id")) & (F.col("text_key") == F.col("src.text_key"))
    later = seen.join(firsts, "key").where(~same | (F.col("first") > F.col("src.last"))).select("id", "text_key", "first", "last")
    # overlapping runs become one
    own = Window.partitionBy("id", "text_key").orderBy("first", "last")
    apart = F.col("first") > F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    whole = later.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int")).withColumn("nth", F.sum("apart").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    whole = whole.groupBy("id", "text_key", "nth").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return whole.groupBy("id", "text_key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("first", "last"))), lambda r: F.array(r["first"], r["last"]))).alias("runs"))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the texts, and n_lines and n_removed (long; replaced
    if there).

    The other lines stay as they are, blank ones too, but for those inside a run; a document may become empty. Null
    text counts as empty: one line, and stays null. Repeated rows are judged alike. An empty table stays empty.
    """
    gone = materialize(repeats(docs, id_col, text_col, min_words).select(F.col("id").alias("_sw_id"), F.col("text_key").alias("_sw_key"), F.col("runs").alias("_sw_runs")), "lines-gone")
    size = gone.agg(F.count("*").alias("n"), F.sum(F.size("_sw_runs")).alias("m")).first()
    keys = docs[id_col].eqNullSafe(gone["_sw_id"]) & (text_key(docs[text_col]) == gone["_sw_key"])
    both = docs.join(small(gone, 20 * size["n"] + (size["m"] or 0), 4), keys, "left").drop("_sw_id", "_sw_key")
    kept = [c for c in docs.columns if c not in (text_col, "n_lines", "n_removed")]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(text_col, T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lines, removed = [], [], []
            for t, runs in zip(b.column(n), b.column(n + 1).to_pylist(), strict=True):
                text = t.as_py()
                rows = (text or "").split("\n")
                lines.append(len(rows))
                if runs:
                    number = [i for i, _ in content(text)]
                    out, at = [], 0
                    for first, last in zip(runs[::2], runs[1::2], strict=True):
                        out += rows[at : number[first]]
                        at = number[last] + 1
                    rows = out + rows[at:]
                    text = "\n".join(rows)
                texts.append(text)
                removed.append(lines[-1] - len(rows))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], names=schema.names)

    text = F.col(text_col).cast("string").alias("_sw_text")
    return both.select(*(F.col(c) for c in kept), text, "_sw_runs").mapInArrow(run, schema)

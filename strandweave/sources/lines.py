"""Lines of text files by byte ranges: a large file is read by many tasks, and what stands above a line is carried over.

Spark cuts files into ranges at line ends and gives each range to one task, in order. A pass over the lines numbers them
inside their range and fills the last heading down; the counts and last headings of the ranges, one row each, then give
every line its number in the file and the heading of an earlier range.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import scratch_path

#: The table of ranges goes to all tasks up to so many rows (some 200 bytes each); beyond that it is joined by a shuffle.
RANGE_ROWS = 100_000


def file_runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """((path, start), first row, row after the last) of the stretches of one range in a batch."""
    if not batch.num_rows:
        return
    path, start = batch.column(0), batch.column(1)
    new = np.flatnonzero(pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)) + 1
    cuts = [0, *new.tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        yield (path[lo].as_py(), start[lo].as_py()), lo, hi


def _placed(spark: SparkSession, path: str, heading: Column | None, first_chars: int | None) -> DataFrame:
    """(path, start, nth, line, heading): lines with their range, place in it and the last heading up to them in it (null:
    none so far). With ``first_chars`` only the lines of a file that begin in so many of its first characters."""
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    text = text.withColumn("line", F.when(F.col("start") == 0, F.ltrim("line", F.lit("\ufeff"))).otherwise(F.col("line")))
    if first_chars:
        text = text.where("start = 0")
    rows = text.withColumn("heading", F.lit(None).cast("string") if heading is None else heading)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, chars, last = None, 0, 0, None
        for b in batches:
            for key, lo, hi in file_runs(b):
                if key != now:
                    now, count, chars, last = key, 0, 0, None
                part = b.slice(lo, hi - lo)
                if first_chars:
                    sizes = pc.utf8_length(part.column(2)).to_numpy(zero_copy_only=False) + 1
                    before = chars + np.concatenate([[0], np.cumsum(sizes)[:-1]])
                    chars += int(sizes.sum())
                    part = part.slice(0, int((before < first_chars).sum()))
                filled = pc.fill_null_forward(pa.concat_arrays([pa.array([last], pa.string()), part.column(3)]))[1:]
                nth = pa.array(np.arange(count, count + part.num_rows))
                count += part.num_rows
                last = filled[-1].as_py() if len(filled) else last
                yield pa.RecordBatch.from_arrays([*part.columns[:2], nth, part.column(2), filled], names=["path", "start", "nth", "line", "heading"])

    return rows.mapInArrow(run, "path string, start long, nth long, line string, heading string")


def read_lines(spark: SparkSession, path: str, heading: Column | None = None) -> DataFrame:
    """(path, line_no, line, heading) of text files: numbers from 1, and the last non-null value of ``heading``, an
    expression over ``line``, up to each line of its file. A byte order mark is no part of the first line; files without
    lines have no rows.

    The lines are written once, in the shared folder, so that their ranges are the same for all that follows.
    """
    placed = _placed(spark, path, heading, None)
    out = scratch_path(spark, "lines")
    placed.write.parquet(out)
    placed = spark.read.schema(placed.schema).parquet(out)
    ranges = placed.groupBy("path", "start").agg(F.count("*").alias("n"), F.max_by("heading", "nth").alias("last"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ranges = ranges.select("path", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"), F.last("last", True).over(earlier).alias("_above"))
    ranges = F.broadcast(ranges) if ranges.count() <= RANGE_ROWS else ranges
    rows = placed.join(ranges, ["path", "start"])
    return rows.select("path", (F.col("_before") + F.col("nth") + 1).alias("line_no"), "line", F.coalesce("heading", "_above").alias("heading"))


def write_lines(lines: DataFrame, path: str) -> str:
    """Write lines (file, line_no, line) as the text files ``file`` of one new folder, in order; returns the folder.

    Spark's writer makes a folder a file and starts a process for the rights of each, which takes some 25 ms a file; here
    tasks write the files by Arrow, in one folder that is listed at once. A task that runs again writes the same files.
    Folders must have a scheme that Arrow knows, as for ``files.fingerprint_files``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
        now, out, made = None, None, 0
        system.create_dir(folder)
        for b in batches:
            for file, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if file != now:
                    if out:
                        out.close()
                    now, out, made = file, system.open_output_stream(f"{folder}/{file}"), made + 1
                out.write(f"{line or ''}\n".encode())
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64())], names=["files"])

    # a number told keeps AQE from packing small rows, and so many files, into one task
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartition(parts, "file").sortWithinPartitions("file", "line_no").select("file", "line")
    ordered.mapInArrow(run, "files long").agg(F.sum("files")).collect()
    return path


def first_lines(spark: SparkSession, path: str, chars: int) -> DataFrame:
    """(path, line_no, line): the lines that begin in the first ``chars`` characters of each file; the rest of a file's
    first range is passed over, its other ranges are not read. (A range is larger than any header.)"""
    return _placed(spark, path, None, chars).select("path", (F.col("nth") + 1).alias("line_no"), "line")

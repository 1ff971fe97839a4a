"""One JSON object of many members, read in parts.

The file is cut at commas, by byte ranges, as Spark cuts text at line ends. Whether a comma lies inside a string, and how
deep, hangs on all that stands before; a range therefore works out both cases, in a string or not, and counts depth from its
own start. One row a range then tells which case holds. Commas at the depth of the members part them; a member that reaches
over ranges is put together again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .lines import RANGE_ROWS, file_runs
from .scratch import scratch_path

#: Members may stand below one of these; the first that is there counts.
ROOTS = ("systems", "games")
_STRING, _REST = r'"(?:[^"\\]|\\.)*+"', r'(?s)^(?:[^"\\]|\\.)*+"(.*)$'
_PLACED = "path string, start long, nth long, piece string, quote0 boolean, depth0 long, quote1 boolean, depth1 long, end0 boolean, deep0 long, end1 boolean, deep1 long"


def _effect(text: Column) -> tuple[Column, Column]:
    """(ends inside a string, change of depth) of a text that starts outside one."""
    bare = F.regexp_replace(text, _STRING, "")
    bone = F.regexp_replace(bare, r'(?s)".*$', "")
    depth = F.regexp_count(bone, F.lit(r"[{\[]")) - F.regexp_count(bone, F.lit(r"[}\]]"))
    return F.contains(bare, F.lit('"')), depth.cast("long")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """_PLACED: what stands between commas, with its range and place, and for both cases at the range's start (0 outside, 1
    inside a string) whether it starts in a string and how deep (counted from there), and the same behind it."""
    text = spark.read.option("lineSep", ",").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece"))
    quote, depth = _effect(F.col("piece"))
    closes = F.col("piece").rlike(_REST)
    after_quote, after_depth = _effect(F.regexp_extract("piece", _REST, 1))
    rows = text.select("path", "start", "piece", quote.alias("q0"), depth.alias("d0"), F.when(closes, after_quote).otherwise(True).alias("q1"), F.when(closes, after_depth).otherwise(F.lit(0).cast("long")).alias("d1"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, state = None, 0, [(False, 0), (True, 0)]
        for b in batches:
            for key, lo, hi in file_runs(b):
                if key != now:
                    now, count, state = key, 0, [(False, 0), (True, 0)]
                part = b.slice(lo, hi - lo)
                q0, d0, q1, d1 = (part.column(k).to_pylist() for k in range(3, 7))
                seen: list[list] = [[], []]
                for i in range(part.num_rows):
                    for case in (0, 1):
                        quoted, deep = state[case]
                        state[case] = (q1[i], deep + d1[i]) if quoted else (q0[i], deep + d0[i])
                        seen[case].append((quoted, deep, *state[case]))
                made = [pa.array([s[k] for s in seen[case]], kind) for case in (0, 1) for k, kind in ((0, pa.bool_()), (1, pa.int64()))]
                ends = [pa.array([s[k] for s in seen[case]], kind) for case in (0, 1) for k, kind in ((2, pa.bool_()), (3, pa.int64()))]
                nth = pa.array(np.arange(count, count + part.num_rows))
                count += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), nth, part.column(2), *made, *ends], names=[c.split()[0] for c in _PLACED.split(", ")])

    return rows.mapInArrow(run, _PLACED)


def json_members(spark: SparkSession, path: str) -> DataFrame:
    """(path, member): the members of each file's object as JSON text, ``"key": value``; those of the object under a ROOT if
    the file has one. A file that is no object raises; an empty object has no members.

    Members are whole in one row each, but no task holds a file. The pieces are written once, so that their ranges are the
    same for all that follows; one row a range comes to the driver.
    """
    out = scratch_path(spark, "json-pieces")
    _pieces(spark, path).write.parquet(out)
    pieces = spark.read.schema(_PLACED).parquet(out)
    last = pieces.groupBy("path", "start").agg(F.max_by(F.struct("end0", "deep0", "end1", "deep1"), "nth").alias("e"), F.min_by("piece", "nth").alias("first"))
    state, known = {}, []
    for r in last.orderBy("path", "start").select("path", "start", "e", F.regexp_like("first", F.lit(r"^\s*\{")).alias("opens")).collect():
        quoted, deep = state.get(r["path"], (False, 0))
        if r["path"] not in state and not r["opens"]:
            raise ValueError(f"a JSON object keyed by machine is expected: {r['path']}")
        known.append((r["path"], r["start"], r["path"] not in state, quoted, deep))
        state[r["path"]] = (r["e"]["end1"], deep + r["e"]["deep1"]) if quoted else (r["e"]["end0"], deep + r["e"]["deep0"])
    ranges = spark.createDataFrame(known, "path string, start long, top boolean, quoted boolean, deep long")
    ranges = F.broadcast(ranges) if len(known) <= RANGE_ROWS else ranges
    rows = pieces.join(ranges, ["path", "start"])
    case = lambda zero, one: F.when(F.col("quoted"), F.col(one)).otherwise(F.col(zero))
    inside, depth = case("quote0", "quote1"), F.col("deep") + case("depth0", "depth1")
    rows = rows.select("path", "start", "nth", "piece", (F.col("top") & (F.col("nth") == 0)).alias("first"), F.when(inside, -1).otherwise(depth).alias("depth"), (F.col("deep") + case("deep0", "deep1")).alias("after"))
    at = F.struct("start", "nth")
    # the root, if there is one: where it starts, and where the next member beside it does
    name = F.regexp_extract("piece", rf'^\s*\{{?\s*"({"|".join(ROOTS)})"\s*:\s*\{{', 1)
    roots = rows.where((F.col("first") | (F.col("depth") == 1)) & (name != "")).groupBy("path").agg(F.min(F.struct(F.array_position(F.array(*map(F.lit, ROOTS)), name).alias("rank"), at.alias("at"))).alias("r"))
    roots = roots.select("path", F.col("r.at").alias("root"))
    beside = rows.where("depth = 1").join(roots, "path").where(at > F.col("root")).groupBy("path").agg(F.min(at).alias("until"))
    roots = roots.join(beside, "path", "left")  # one row a file
    rows = rows.join(roots, "path", "left")
    level = F.when(F.col("root").isNull(), 1).otherwise(2)
    rows = rows.where(F.col("root").isNull() | ((at >= F.col("root")) & (F.col("until").isNull() | (at < F.col("until")))))
    head = F.when(F.col("root").isNull(), F.col("first")).otherwise(at == F.col("root"))
    text = F.when(head & F.col("root").isNull(), F.regexp_replace("piece", r"^\s*\{", "")).when(head, F.regexp_replace("piece", r'^\s*\{?\s*"[a-z]+"\s*:\s*\{', "")).otherwise(F.col("piece"))
    closed = level - F.col("after")  # closing brackets beyond the member's own
    text = F.when(closed >= 2, F.regexp_replace(text, r"\}\s*\}\s*$", "")).when(closed == 1, F.regexp_replace(text, r"\}\s*$", "")).otherwise(text)
    rows = rows.select("path", "start", "nth", text.alias("text"), (head | (F.col("depth") == level)).cast("long").alias("starts"))
    rows = rows.withColumn("own", F.sum("starts").over(Window.partitionBy("path", "start").orderBy("nth")))
    counts = rows.groupBy("path", "start").agg(F.max("own").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("start")) - F.col("n")  # one row a range
    counts = counts.select("path", "start", before.alias("before"))
    rows = rows.join(F.broadcast(counts) if len(known) <= RANGE_ROWS else counts, ["path", "start"])
    whole = rows.groupBy("path", (F.col("before") + F.col("own")).alias("no")).agg(F.array_sort(F.collect_list(F.struct("start", "nth", "text"))).alias("parts"))
    member = F.array_join(F.transform("parts", lambda p: p["text"]), ",")
    return whole.select("path", member.alias("member")).where(F.trim("member") != "")


def scan_keyed_json(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value) of the members (``json_members``) of JSON objects keyed by machine; ``value`` is a DDL type."""
    members = json_members(spark, path)
    return members.select(F.explode(F.from_json(F.concat(F.lit("{"), "member", F.lit("}")), f"map<string,{value}>")).alias("key", "value"))

"""What is up to date: file fingerprints against stored ones, stages and what they wait for, snapshots kept once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path


def stage_freshness(current: DataFrame, stored: DataFrame, tools: DataFrame | None = None, outputs: DataFrame | None = None) -> DataFrame:
    """(stage, changed, missing, new, tool_changed, outputs_missing, fresh): what a stage's stamp says against what is there.

    Fingerprints of inputs (stage, path, size, digest) are compared file by file. ``tools`` (stage, version, stamped) has the
    version of each stage's tool now and in its stamp (null: there is none); ``outputs`` (stage, path, present) the files it
    has to have written. A stage is fresh if nothing differs and no output is missing.
    """
    c = current.select("stage", "path", F.lit(True).alias("now"), F.col("size").alias("size_now"), F.col("digest").alias("digest_now"))
    s = stored.select("stage", "path", F.lit(True).alias("was"), "size", "digest")
    both = c.join(s, ["stage", "path"], "full_outer")
    missing, new = F.col("now").isNull(), F.col("was").isNull()
    changed = ~missing & ~new & ~(F.col("size_now").eqNullSafe(F.col("size")) & F.col("digest_now").eqNullSafe(F.col("digest")))
    out = both.groupBy("stage").agg(F.count_if(changed).alias("changed"), F.count_if(missing).alias("missing"), F.count_if(new).alias("new"))
    if tools is not None:
        out = out.join(tools.select("stage", (~F.col("version").eqNullSafe(F.col("stamped"))).alias("tool_changed")), "stage", "full_outer")
    if outputs is not None:
        out = out.join(outputs.groupBy("stage").agg(F.count_if(~F.coalesce("present", F.lit(False))).alias("outputs_missing")), "stage", "full_outer")
    have = lambda name: F.coalesce(F.col(name), F.lit(0)) if name in out.columns else F.lit(0)
    tool = F.coalesce("tool_changed", F.lit(False)) if tools is not None else F.lit(False)
    out = out.select("stage", *(have(n).cast("bigint").alias(n) for n in ("changed", "missing", "new")), tool.alias("tool_changed"), have("outputs_missing").cast("bigint").alias("outputs_missing"))
    return out.withColumn("fresh", (F.col("changed") + F.col("missing") + F.col("new") + F.col("outputs_missing") == 0) & ~F.col("tool_changed"))


def blocked_stages(freshness: DataFrame, upstream: DataFrame) -> DataFrame:
    """(stage, fresh, stale, waiting_for, blocked): what a stage that is not fresh does to those that need it.

    ``freshness`` is (stage, fresh), ``upstream`` (stage, needs). A stage is stale if it is not fresh itself or needs a stale
    one, however far up; waiting_for are its own needs that are stale, and it is blocked while there are any. A stage that
    nothing is known of is not fresh; one that has needs but no stamp of its own hangs on them alone. Staleness is handed on
    from stage to stage in rounds, as many as the longest chain has stages; stages that need each other end too.
    """
    spark = freshness.sparkSession
    edges = upstream.select("stage", "needs").distinct()
    known = freshness.select("stage", "fresh")
    only_needed = edges.select(F.col("needs").alias("stage")).subtract(edges.select("stage").union(known.select("stage")))
    rows = known.union(edges.select("stage").distinct().join(known, "stage", "left_anti").withColumn("fresh", F.lit(True))).union(only_needed.withColumn("fresh", F.lit(False)))
    rows = rows.groupBy("stage").agg(F.bool_and(F.coalesce("fresh", F.lit(False))).alias("fresh")).withColumn("stale", ~F.col("fresh"))
    stale = -1
    while True:
        path = scratch_path(spark, "stale")
        rows.write.parquet(path)
        rows = spark.read.schema("stage string, fresh boolean, stale boolean").parquet(path)
        now = rows.where("stale").count()
        if now == stale:
            break
        stale = now
        above = edges.join(rows.select(F.col("stage").alias("needs"), F.col("stale").alias("above")), "needs").groupBy("stage").agg(F.bool_or("above").alias("above"))
        rows = rows.join(above, "stage", "left").select("stage", "fresh", (F.col("stale") | F.coalesce("above", F.lit(False))).alias("stale"))
    held = edges.join(rows.where("stale").select(F.col("stage").alias("needs")), "needs").groupBy("stage").agg(F.array_sort(F.collect_set("needs")).alias("waiting_for"))
    out = rows.join(held, "stage", "left").withColumn("waiting_for", F.coalesce("waiting_for", F.array().cast("array<string>")))
    return out.withColumn("blocked", F.size("waiting_for") > 0)


def multiset_hash(*facts: Column) -> Column:
    """An aggregate: a digest of the rows' ``facts``, the same in any order and however rows are grouped on the way.

    Each row's MD5 is two numbers of 60 bits, which are added; their sums and the number of rows are hashed in the end. Only
    sums leave a task, and repeated rows count as often as they occur.
    """
    digest = F.md5(F.to_json(F.struct(*facts)).cast("binary"))
    part = lambda at: F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)")).cast("string")
    return F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), part(1), part(16)), 256)


def dependency_signature(members: DataFrame, keys: list[str]) -> DataFrame:
    """(stage, signature): the SHA-256 of a JSON array of the facts ``keys`` about a stage's own members, ordered by them.

    The digest is one stream, so a stage's facts pass through one task, sorted and not held; repeated members count as
    often as they occur.
    """
    facts = F.to_json(F.struct(*keys)).alias("fact")
    ordered = members.repartition("stage").sortWithinPartitions("stage", *keys).select("stage", facts)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        now, digest = None, None
        told = lambda: pa.RecordBatch.from_pydict({"stage": pa.array([now], pa.string()), "signature": [digest.hexdigest()]})
        for b in batches:
            for stage, fact in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                first = digest is None or stage != now
                if first:
                    if digest:
                        digest.update(b"]")
                        yield told()
                    now, digest = stage, hashlib.sha256(b"[")
                digest.update((fact if first else f",{fact}").encode())
        if digest:
            digest.update(b"]")
            yield told()

    return ordered.mapInArrow(digests, "stage string, signature string")


def stage_stamps(inputs: DataFrame, tools: DataFrame) -> DataFrame:
    """(stage, version, files, digest): what a stage writes down when it is done; equal digests mean that its name, the version
    of its tool and all its inputs (stage, path, size, digest) are the same. ``tools`` is (stage, version)."""
    per = inputs.groupBy("stage").agg(F.count("*").alias("files"), multiset_hash(F.col("path"), F.col("size"), F.col("digest")).alias("signature"))
    out = tools.join(per, "stage", "left").withColumn("files", F.coalesce("files", F.lit(0)))
    basis = F.to_json(F.struct(F.col("stage"), F.col("version"), F.coalesce("signature", F.lit("")).alias("inputs")))
    return out.select("stage", "version", "files", F.sha2(basis, 256).alias("digest"))


def snapshot_findings(new: DataFrame, kept: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to add, conflicts): snapshots (keys, digest) not kept yet, and those kept with another digest.

    An identical snapshot is in neither: writing it again changes nothing.
    """
    have = kept.select(*keys, F.col("digest").alias("kept_digest"))
    both = new.join(have, keys, "left")
    return both.where("kept_digest is null").drop("kept_digest"), both.where("kept_digest <> digest")

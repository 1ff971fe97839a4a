"""Exact deduplication: 128-bit content hashes, one keeper for each class of equal texts, bytes compared in classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffled, small, strip_spaces


def md5_128(norm: Column) -> Column:
    """The 128-bit content hash, 16 bytes."""
    return F.unhex(F.md5(norm))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the text without white space).

    Equal means equal after the white space of ``common.SPACES`` is deleted; null text counts as empty. Of a class,
    the row with the most code points in its original text stays, then the smallest id (null ids last), then, of
    rows that are equal in all this, exactly one. Rows are grouped by ``digest`` (16 bytes a row are shuffled, with
    map-side combination, so a class of any size is a partial sum); then the texts of classes with two rows or more
    are grouped by their bytes, and a hash value that stands for several texts is split by text. An empty table
    gives an empty result; other columns are not read, so their names can't clash.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("norm", strip_spaces(F.col("text"))).withColumn("h", digest(F.col("norm")))
    sig = rows.select("id", "h", F.char_length("text").cast("long").alias("n_cp"), F.sha2("norm", 256).alias("sha"), F.monotonically_increasing_id().alias("rid"))
    sig = materialize(sig, "dedup-sig")
    best = F.min(F.struct((-F.col("n_cp")).alias("o"), F.col("id").isNull().alias("e"), "id", "rid")).alias("best")
    per_hash = materialize(sig.groupBy("h").agg(best, F.count("*").alias("group_size")), "dedup-best")
    clash = collisions(rows.select("h", "norm"), per_hash.where("group_size > 1").select("h"))
    if clash is None:
        out = sig.join(shuffled(per_hash), "h")
    else:
        # a hash value with several texts: classes are (hash, text)
        exact = rows.join(clash, "h", "left_semi").select("h", "norm", F.sha2("norm", 256).alias("sha")).distinct()
        part = sig.join(clash, "h", "left_semi").join(exact, ["h", "sha"])
        per_text = part.groupBy("h", "norm").agg(best, F.count("*").alias("group_size"))
        part = part.join(per_text, ["h", "norm"]).drop("norm")
        rest = sig.join(clash, "h", "left_anti").join(shuffled(per_hash), "h")
        out = rest.unionByName(part.select(rest.columns))
    return out.select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def collisions(texts: DataFrame, shared: DataFrame) -> DataFrame | None:
    """Hash values of ``shared`` that stand for more than one text; None if there are none. Compares bytes."""
    shared = materialize(shared, "dedup-shared")
    members = texts.join(small(shared, shared.count(), 64), "h", "left_semi")
    found = members.groupBy("h", "norm").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    found = materialize(found, "dedup-clash")
    return None if found.isEmpty() else found


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of equal texts, all its columns kept; the rules are those of ``classes``.

    The ids to drop are joined against the documents: broadcast while their counted size is small, else shuffled.
    An id that occurs in several rows is told apart by its text; rows equal in both leave one row.
    """
    done = materialize(classes(docs, id_col, text_col), "dedup-classes")
    out = materialize(done.where("not kept").select(F.col(id_col).alias("_sw_id"), F.col("text_sha256").alias("_sw_sha")), "dedup-out")
    ids = done.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").isEmpty() and done.where(F.col(id_col).isNull()).limit(2).count() < 2
    if ids:
        gone = small(out.select("_sw_id"), out.count(), 32)
        return docs.join(gone, docs[id_col].eqNullSafe(gone["_sw_id"]), "left_anti")
    # repeated ids: of each text one row stays, so the choice is made on (class, id) and then on one row
    sha = F.sha2(strip_spaces(F.col(text_col)), 256)
    keep = done.where("kept").select(F.col(id_col).alias("_sw_id"), F.col("text_sha256").alias("_sw_sha"))
    left = docs.withColumn("_sw_s", sha).withColumn("_sw_n", F.coalesce(F.char_length(text_col), F.lit(0)))
    left = left.join(keep, F.col(id_col).eqNullSafe(F.col("_sw_id")) & (F.col("_sw_s") == F.col("_sw_sha")), "left_semi")
    longest = left.groupBy("_sw_s").agg(F.max("_sw_n").alias("_sw_m")).withColumnRenamed("_sw_s", "_sw_k")
    left = left.join(longest, (F.col("_sw_s") == F.col("_sw_k")) & (F.col("_sw_n") == F.col("_sw_m")))
    return left.dropDuplicates(["_sw_s"]).select(*docs.columns)

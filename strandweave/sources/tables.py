"""Tables by release: writing one release without touching others, documents, and what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import normalise_release


def write_release_table(df: DataFrame, path: str, release: str) -> None:
    """Replace the rows of one release; partitions of other releases stay as they are."""
    rows = df.drop("release").withColumn("release", F.lit(release))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release").parquet(path)


def release_documents(records: DataFrame, key: str = "machine") -> DataFrame:
    """(key, json): one JSON document per record, without null fields."""
    rest = [c for c in records.columns if c != key]
    return records.select(key, F.to_json(F.struct(*rest), {"ignoreNullFields": "true"}).alias("json"))


def document_header(schema_id: str, schema_version: str, generated_at: Column, versions: dict[str, Column]) -> Column:
    """The header of a published document as JSON."""
    told = F.struct(*(c.alias(n) for n, c in versions.items()))
    return F.to_json(F.struct(F.lit(schema_id).alias("schema_id"), F.lit(schema_version).alias("schema_version"), F.date_format(generated_at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"), told.alias("versions")))


def write_release_document(records: DataFrame, path: str, key: str = "machine", header: Column | None = None) -> None:
    """The document of a release under ``path``: records, JSON lines that carry the key, sorted by it range by range
    (the files in order are the document in order), and in a folder of its own the ``header`` if there is one."""
    lines = records.select(key, F.to_json(F.struct(*records.columns), {"ignoreNullFields": "true"}).alias("json"))
    lines.repartitionByRange(key).sortWithinPartitions(key).select("json").write.mode("overwrite").text(f"{path}/records")
    if header is not None:
        records.sparkSession.range(1).select(header).write.mode("overwrite").text(f"{path}/header")


def list_releases(df: DataFrame) -> DataFrame:
    """The distinct releases of a table, in order."""
    return df.select(normalise_release(F.col("release")).alias("release")).where("release is not null").distinct().orderBy("release")


def complete_releases(datasets: DataFrame, needed: int = 3) -> DataFrame:
    """Releases that have ``needed`` datasets (release, dataset)."""
    return datasets.groupBy("release").agg(F.count_distinct("dataset").alias("n")).where(F.col("n") >= needed).select("release")


def predecessors(releases: DataFrame) -> DataFrame:
    """(release, before): each release and the nearest earlier one; the first has none. One row per release."""
    return releases.select("release").distinct().withColumn("before", F.lag("release").over(Window.orderBy(F.col("release").cast("int"))))


def retain_newest(releases: DataFrame, n: int, current: str | None = None) -> DataFrame:
    """(release, keep): the newest ``n`` and the current one are kept. One row per release."""
    rank = F.row_number().over(Window.orderBy(F.desc(F.col("release").cast("int"))))
    return releases.select("release").distinct().select("release", ((rank <= n) | (F.col("release") == F.lit(current or ""))).alias("keep"))


def newest_revision(archives: DataFrame) -> DataFrame:
    """(release, path, rank, tied): the newest of (release, suffix, path): no suffix is 0, a to z are 1 to 26."""
    rank = F.when(F.col("suffix") == "", 0).otherwise(F.ascii("suffix") - 96)
    rows = archives.withColumn("rank", rank)
    per = rows.groupBy("release", "rank").agg(F.min("path").alias("path"), F.count("*").alias("n"))
    best = per.groupBy("release").agg(F.max(F.struct("rank", "path", "n")).alias("b"))
    return best.select("release", "b.path", "b.rank", (F.col("b.n") > 1).alias("tied"))


def release_index(files: DataFrame) -> DataFrame:
    """(release, files, bytes, first_modified, last_modified) of files (release, path, size, modified)."""
    return files.groupBy("release").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min("modified").alias("first_modified"), F.max("modified").alias("last_modified"))

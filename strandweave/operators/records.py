"""Reports over metrics, findings and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import empty_to_null, fold


def metric(df: DataFrame, stage: str, name: str) -> DataFrame:
    """A one-row count as (stage, metric, bucket, n)."""
    return df.select(F.lit(stage).alias("stage"), F.lit(name).alias("metric"), F.lit("").alias("bucket"), F.col(df.columns[0]).cast("long").alias("n"))


def quick_stats(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row of the totals ``names`` of a metrics table."""
    return metrics.where("bucket = ''").groupBy().pivot("metric", names).agg(F.sum("n"))


def diagnostics(findings: DataFrame, known: DataFrame, examples: int = 5) -> DataFrame:
    """(rule_id, n, systems, examples, linked): recorded findings with a few machines each, and how many are in ``known``."""
    rows = findings.join(known.select("machine").distinct().withColumn("known", F.lit(True)), "machine", "left")
    per = rows.groupBy("rule_id").agg(F.count("*").alias("n"), F.count_distinct("machine").alias("systems"), F.count_distinct(F.when(F.col("known"), F.col("machine"))).alias("linked"))
    from .metrics import first_examples

    few = first_examples(rows.select("rule_id", "machine").distinct(), ["rule_id"], "machine", "machine", examples)
    return per.join(few, "rule_id")


def counters(tables: dict[str, DataFrame], stage: str) -> DataFrame:
    """(stage, metric, bucket, n): the number of rows of each table; each counts where it lies, only sums meet."""
    rows = [metric(df.agg(F.count("*")), stage, name) for name, df in tables.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def entry_totals(entries: DataFrame, ports: DataFrame, overviews: DataFrame) -> DataFrame:
    """One row of totals: entries by kind (kind, aliases), systems with aliases, with ports and with an overview of
    their ports, port lines, and those with comments."""
    e = entries.agg(F.count("*").alias("entries"), F.count_if(F.col("kind") == "systems").alias("systems"), F.count_if(F.col("kind") == "software").alias("software"), F.count_if((F.col("kind") == "systems") & (F.size("aliases") > 0)).alias("with_aliases"))
    p = ports.agg(F.count_distinct("machine").alias("with_ports"), F.count("*").alias("port_lines"), F.count_if(F.coalesce(F.col("comment"), F.lit("")) != "").alias("with_comments"))
    o = overviews.agg(F.count_distinct("machine").alias("with_overview"))
    return e.join(p).join(o)  # one row each


def block_counts(blocks: DataFrame, kinds: tuple[str, ...] = ("type", "section")) -> DataFrame:
    """(metric, bucket, n, systems): blocks, and machines that have any, by each of the columns ``kinds``. One pass."""
    tall = F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.coalesce(F.col(k).cast("string"), F.lit("unknown")).alias("bucket")) for k in kinds)))
    return blocks.select("machine", tall.alias("m")).groupBy("m.metric", "m.bucket").agg(F.count("*").alias("n"), F.count_distinct("machine").alias("systems"))


def stage_versions(headers: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """One row: each version of ``wanted``, the first of its columns that a header tells; Unknown if none does."""
    told = {name: F.max(F.coalesce(*(empty_to_null(F.col(c)) for c in columns))) for name, columns in wanted.items()}
    return headers.agg(*(F.coalesce(value, F.lit("Unknown")).alias(name) for name, value in told.items()))


def run_manifest(runs: DataFrame) -> DataFrame:
    """(stage, inputs, input_bytes, outputs, output_bytes, records, seconds, errors, ok): a row per stage of a run.

    ``runs`` has a row per file: stage, role (input or output), size, records, at (a time) and error (null: none). A
    stage is ok if it had inputs, wrote something and no file has an error.
    """
    has = lambda role: F.col("role") == role
    total = lambda role, c: F.coalesce(F.sum(F.when(has(role), F.col(c))), F.lit(0)).cast("bigint")
    per = runs.groupBy("stage").agg(
        F.count_if(has("input")).alias("inputs"),
        total("input", "size").alias("input_bytes"),
        F.count_if(has("output")).alias("outputs"),
        total("output", "size").alias("output_bytes"),
        total("output", "records").alias("records"),
        (F.unix_timestamp(F.max("at")) - F.unix_timestamp(F.min("at"))).alias("seconds"),
        F.count("error").alias("errors"),
    )
    return per.withColumn("ok", (F.col("inputs") > 0) & (F.col("outputs") > 0) & (F.col("errors") == 0))


def catalogue_search(machines: DataFrame, titles: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """``machines`` (name) with their ``titles`` (name, title; null: none) of which one of the fields ``wanted`` holds the text
    wanted of it, without regard to case."""
    both = machines.join(titles, "name", "left")
    hit = F.lit(False)
    for field, text in wanted.items():
        hit = hit | F.contains(fold(F.coalesce(F.col(field), F.lit(""))), F.lit(text.upper().lower()))
    return both.where(hit)


def filtered_findings(findings: DataFrame, fields: list[str], text: str = "", rule: str = "") -> DataFrame:
    """Findings of ``rule`` (empty: all) of which one of ``fields`` holds ``text`` without regard to case."""
    hit = F.lit(not text)
    for c in fields:
        hit = hit | F.contains(fold(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(text.upper().lower()))
    return findings.where(hit & (F.lit(not rule) | (F.col("rule_id") == rule)))


def transform_findings(anomalies: DataFrame, duplicates: DataFrame, known: DataFrame, kind: str = "", text: str = "") -> DataFrame:
    """(kind, category, machine, evidence, known): title anomalies (machine, anomaly, example) and families whose
    variants repeat a port (parent), of one ``kind`` (title or ports) and with ``text`` in a field, if asked for.
    ``known`` (machine) are those that can be shown."""
    titles = anomalies.select(F.lit("title").alias("rule_id"), F.col("anomaly").alias("category"), "machine", F.col("example").alias("evidence"))
    ports = duplicates.select(F.lit("ports").alias("rule_id"), F.lit("Parent/clone PORTS duplication").alias("category"), F.col("parent").alias("machine"), F.lit(None).cast("string").alias("evidence"))
    rows = filtered_findings(titles.unionByName(ports), ["machine", "category", "evidence"], text, kind)
    shown = known.select("machine").distinct().withColumn("known", F.lit(True))
    return rows.withColumnRenamed("rule_id", "kind").join(shown, "machine", "left").select("kind", "category", "machine", "evidence", F.coalesce("known", F.lit(False)).alias("known"))

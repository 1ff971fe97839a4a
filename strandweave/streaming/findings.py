"""Histories of findings as mergeable state: a release is added without reading those before it."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: What makes two findings the same.
KEYS = ["rule_id", "machine", "section", "source_text", "value"]


def finding_state(findings: DataFrame, release: Column | str | None = None) -> DataFrame:
    """(KEYS, seen, occurrences): the state that ``findings`` amount to; ``release`` is theirs, or a column of them.

    ``seen`` has the releases in which a finding occurs, in order; it holds names of releases, not findings, and so is as
    long as the list of releases at most. Repeats are counted per release before any list is made.
    """
    rows = findings if release is None else findings.withColumn("release", F.lit(release) if isinstance(release, str) else release)
    per = rows.groupBy(*KEYS, "release").agg(F.count("*").alias("n"))
    return per.groupBy(*KEYS).agg(F.array_sort(F.collect_list("release")).alias("seen"), F.sum("n").alias("occurrences"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all findings of ``states``, which are of different releases, whatever their order: one grouping."""
    both = reduce(DataFrame.unionByName, states)
    seen = F.array_sort(F.flatten(F.collect_list("seen")))
    return both.groupBy(*KEYS).agg(seen.alias("seen"), F.sum("occurrences").cast("bigint").alias("occurrences"))


def lifecycle(state: DataFrame, releases: list[str]) -> DataFrame:
    """Per finding over ordered ``releases``: first and last seen, first absence after it, disappearances and
    reappearances, present in the last, and occurrences."""
    if list(releases) != sorted(set(releases)):
        raise ValueError("releases must be distinct and in order")
    names = F.array(*(F.lit(r) for r in releases))
    per = state.withColumn("at", F.transform("seen", lambda r: F.array_position(names, r).cast("int")))
    # positions seen, in order, and each one's predecessor among them: a gap is a disappearance and a reappearance
    per = per.withColumns({"first": F.get("at", F.lit(0)), "last": F.element_at("at", -1)})
    before = F.concat(F.array(F.lit(None).cast("int")), F.slice("at", F.lit(1), F.size("at") - 1))
    per = per.withColumn("back", F.filter(F.zip_with("at", before, lambda now, was: F.when(now > was + 1, F.struct(now.alias("now"), was.alias("was")))), lambda x: x.isNotNull()))
    gone = F.transform("back", lambda x: x["was"] + 1)
    gone = F.when(F.col("last") < len(releases), F.concat(gone, F.array(F.col("last") + 1))).otherwise(gone)
    per = per.withColumn("gone", gone)
    name = lambda positions: F.transform(positions, lambda i: F.element_at(names, i))
    return per.select(
        *KEYS,
        F.element_at(names, F.col("first")).alias("first_observed"),
        F.element_at(names, F.col("last")).alias("last_observed"),
        F.get(name(F.col("gone")), F.lit(0)).alias("first_absent"),
        name(F.col("gone")).alias("disappeared"),
        name(F.transform("back", lambda x: x["now"])).alias("reappeared"),
        (F.col("last") == len(releases)).alias("present_in_latest"),
        "occurrences",
    )


def finding_lifecycle(findings: DataFrame, releases: list[str]) -> DataFrame:
    """``lifecycle`` of findings (KEYS, release) of ``releases``, from scratch."""
    return lifecycle(finding_state(findings.where(F.col("release").isin(releases))), releases)


class FindingHistory:
    """The stored state of all releases added so far, under ``path``: a table of runs (release, detectors, generation) and
    one of states, of which the newest generation counts.

    A run's detectors, a text that tells rules and their versions, must be those of the runs before; a release can be added
    once. A generation is written whole before its run is recorded, so a failed addition leaves the history as it was.
    """

    RUN = "release string, detectors string, generation int"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "finding-history")

    def runs(self) -> list:
        """The runs so far, one row a release."""
        try:
            return self.spark.read.schema(self.RUN).json(f"{self.path}/runs").orderBy("generation").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def state(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/state/{self.runs()[-1]['generation']}")

    def add(self, findings: DataFrame, release: str, detectors: str) -> None:
        """Add the findings of one release to the state; earlier findings are not read, only their state is."""
        runs = self.runs()
        if any(r["release"] == release for r in runs):
            raise ValueError(f"release {release} is in the history already")
        if any(r["detectors"] != detectors for r in runs):
            raise ValueError(f"release {release} was searched by other detectors than {runs[0]['release']}")
        new = finding_state(findings.select(*KEYS), release)
        generation = len(runs) + 1
        merged = merge_states(self.state(), new) if runs else new
        merged.write.mode("overwrite").parquet(f"{self.path}/state/{generation}")
        run = self.spark.createDataFrame([(release, detectors, generation)], self.RUN)
        run.coalesce(1).write.mode("append").json(f"{self.path}/runs")

    def lifecycle(self) -> DataFrame:
        """The histories over all releases added, in their order by name."""
        return lifecycle(self.state(), sorted(r["release"] for r in self.runs()))

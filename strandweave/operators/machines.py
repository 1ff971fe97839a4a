"""Facts of single machines, and totals over all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.text import digits, empty_to_null, strip, text_or_empty, truthy, yes_no

#: Fixed value: machines named as examples of channels and speakers that differ.
EXAMPLES = 10


def machine_header(machines: DataFrame) -> DataFrame:
    """(name, cloneof, sourcefile, sampleof, isbios, isdevice, ismechanical, description, year, manufacturer): names are trimmed
    and empty ones null, flags are yes or no, year and manufacturer are texts; the description stays as it is."""
    some = lambda c: empty_to_null(strip(F.col(c))).alias(c)
    flag = lambda c: yes_no(truthy(F.col(c))).alias(c)
    full = lambda c: text_or_empty(F.col(c)).alias(c)
    return machines.select("name", some("cloneof"), some("sourcefile"), some("sampleof"), flag("isbios"), flag("isdevice"), flag("ismechanical"), "description", full("year"), full("manufacturer"))


def rom_rollup(roms: DataFrame) -> DataFrame:
    """(machine, rom_count, rom_bytes) of ROMs (machine, size as text); a size that is no number adds nothing."""
    size = F.coalesce(digits(F.col("size")), F.lit(0))
    return roms.groupBy("machine").agg(F.count("*").alias("rom_count"), F.sum(size).alias("rom_bytes"))


def disk_rollup(machines: DataFrame, regions: str = "disk_regions") -> DataFrame:
    """(name, required, regions, n): whether a machine has disks, and their distinct regions in lower case, sorted."""
    told = F.filter(F.coalesce(F.col(regions), F.array().cast("array<string>")), lambda r: text_or_empty(r) != "")
    distinct = F.array_sort(F.array_distinct(F.transform(told, lambda r: F.lower(strip(r)))))
    return machines.select("name", yes_no(F.size(told) > 0).alias("required"), distinct.alias("regions"), F.size(distinct).cast("long").alias("n"))


def samples_required() -> Column:
    """Whether a machine (sampleof, samples) plays samples."""
    return (text_or_empty(F.col("sampleof")) != "") | truthy(F.col("samples"))


def machine_totals(machines: DataFrame) -> DataFrame:
    """One row: machines, parents, clones, bios, devices, mechanical, samples."""
    flag = lambda c: F.count_if(truthy(F.col(c)))
    clone = empty_to_null(F.col("cloneof")).isNotNull()
    return machines.agg(F.count("*").alias("machines"), F.count_if(~clone).alias("parents"), F.count_if(clone).alias("clones"), flag("isbios").alias("bios"), flag("isdevice").alias("devices"), flag("ismechanical").alias("mechanical"), F.count_if(samples_required()).alias("samples"))


def media_counts(machines: DataFrame, regions: str = "disk_regions") -> DataFrame:
    """(media, parents): parents by the media that their disk regions (an array) mean; none for regions that mean none."""
    parents = machines.where(empty_to_null(F.col("cloneof")).isNull())
    media = F.transform(F.filter(regions, lambda r: r != ""), lambda r: F.coalesce(labels.media_label(r), F.lit("none")))
    return parents.select("name", F.explode(F.array_distinct(media)).alias("media")).groupBy("media").agg(F.count_distinct("name").alias("parents"))


def audio_mismatch(machines: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """One row: machines (name, channels, speakers, samples) that report channels, those of them with another number of
    speakers, those with samples, and the first ``most`` of the second by name."""
    off = F.coalesce(F.col("channels") != F.col("speakers"), F.lit(False))
    few = machines.where(off).orderBy("name").limit(most).agg(F.array_sort(F.collect_list("name")).alias("examples"))
    return machines.agg(F.count("channels").alias("reported"), F.count_if(off).alias("mismatched"), F.count_if(truthy(F.col("samples"))).alias("samples")).join(few)  # one row each

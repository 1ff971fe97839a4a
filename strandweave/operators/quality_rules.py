"""Expectations: each gives rows (rule, key, detail) of what breaks a rule; the caller warns or fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, key): rows for which a rule isn't true; null counts as broken. One pass for all rules."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())), lambda n: n.isNotNull())
    return rows.select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key"))


def unequal(totals: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(rule, left, right): checks of two numbers of a one-row table that differ."""
    rows = F.array(*(F.struct(F.lit(n).alias("rule"), a.cast("bigint").alias("left"), b.cast("bigint").alias("right")) for n, (a, b) in checks.items()))
    return totals.select(F.explode(rows).alias("x")).select("x.*").where(~F.col("left").eqNullSafe(F.col("right")))


def out_of_bounds(totals: DataFrame, equal: dict[str, tuple[Column, Column]], at_most: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(rule, left, right): checks of two numbers of a one-row table that are broken: not equal, or left above right."""
    entry = lambda n, a, b, broken: F.when(broken, F.struct(F.lit(n).alias("rule"), a.cast("bigint").alias("left"), b.cast("bigint").alias("right")))
    rows = [entry(n, a, b, ~a.eqNullSafe(b)) for n, (a, b) in equal.items()] + [entry(n, a, b, a > b) for n, (a, b) in at_most.items()]
    return totals.select(F.inline(F.array_compact(F.array(*rows))))


def _totals(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row: the sum of each metric of (metric, bucket, n), by its name."""
    return counts.agg(*(F.coalesce(F.sum(F.when(F.col("metric") == n, F.col("n"))), F.lit(0)).alias(f"sum_{n}") for n in names))


def machine_invariants(machines: DataFrame, chips: DataFrame, controls: DataFrame, counts: DataFrame, per_machine: list[str], per_display: list[str], per_control: list[str]) -> DataFrame:
    """(rule, left, right): where the counters of a parse and its machines disagree.

    ``machines``: name, disk_required, disk_regions (array), cpu_count, sound_chip_count, display_count; ``chips`` and
    ``controls``: machine and, of chips, type; ``counts``: (metric, bucket, n). Metrics ``per_machine`` have each machine
    once; ``per_display`` as many as the machines have displays, ``per_control`` as there are controls. A machine needs a
    disk just if it has disk regions, and its recorded chips are those it has. Each table gives one row of sums.
    """
    kind = F.lower("type")
    held = chips.groupBy(F.col("machine").alias("name")).agg(F.count_if(kind == "cpu").alias("_cpus"), F.count_if(kind == "audio").alias("_audio"))
    rows = machines.join(held, "name", "left")
    regions = F.coalesce(F.size("disk_regions"), F.lit(0))
    off = lambda told, found: F.count_if(~F.coalesce(F.col(told), F.lit(0)).eqNullSafe(F.coalesce(F.col(found), F.lit(0))))
    m = rows.agg(
        F.count("*").alias("machines"),
        F.coalesce(F.sum("display_count"), F.lit(0)).alias("displays"),
        F.count_if((F.col("disk_required") == "yes") & (regions == 0)).alias("empty"),
        F.count_if((F.col("disk_required") == "no") & (regions > 0)).alias("unasked"),
        off("cpu_count", "_cpus").alias("cpu"),
        off("sound_chip_count", "_audio").alias("audio"),
    )
    every = m.join(controls.agg(F.count("*").alias("controls"))).join(_totals(counts, [*per_machine, *per_display, *per_control]))  # one row each
    equal = {f"{n}_per_machine": (F.col(f"sum_{n}"), F.col("machines")) for n in per_machine}
    equal |= {f"{n}_per_display": (F.col(f"sum_{n}"), F.col("displays")) for n in per_display}
    equal |= {f"{n}_per_control": (F.col(f"sum_{n}"), F.col("controls")) for n in per_control}
    wrong = {"disk_without_regions": "empty", "regions_without_disk": "unasked", "cpu_count": "cpu", "sound_chip_count": "audio"}
    return out_of_bounds(every, equal, {n: (F.col(c), F.lit(0)) for n, c in wrong.items()})


def entry_invariants(entries: DataFrame, keyed: DataFrame, ports: DataFrame, platforms: DataFrame, banners: DataFrame, overviews: DataFrame, told: dict[str, Column]) -> DataFrame:
    """(rule, left, right): where the counters of an article parse disagree.

    ``entries``: kind; ``keyed`` and ``overviews``: machine; ``ports``: machine, platform, residue (array), date, raw_date;
    ``platforms`` and ``banners``: (bucket, n) as found per platform and per banner. ``told`` has the totals that the parse
    reports, as literals: port_lines, null_platforms and banners.
    """
    e = entries.agg(F.count("*").alias("entries"), F.count_if(F.col("kind") == "systems").alias("systems"), F.count_if(F.col("kind") == "software").alias("software"))
    left = F.size("residue") > 0
    p = ports.agg(F.count_if(F.col("platform").isNull()).alias("bare"), F.count_distinct("machine").alias("with_ports"), F.count_distinct(F.when(left, F.col("machine"))).alias("residue"), F.count_distinct(F.when(F.col("raw_date").isNotNull() & F.col("date").isNull(), F.col("raw_date"))).alias("unreadable"))
    total = lambda df, name: df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))
    every = e.join(p).join(keyed.agg(F.count_distinct("machine").alias("keyed"))).join(overviews.agg(F.count_distinct("machine").alias("overviews"))).join(total(platforms, "hits")).join(total(banners, "banners"))  # one row each
    c = F.col
    equal = {"systems_and_software": (c("systems") + c("software"), c("entries")), "keyed_systems": (c("keyed"), c("systems")), "platforms_and_nulls": (c("hits") + told["null_platforms"], told["port_lines"]), "null_platforms": (c("bare"), told["null_platforms"]), "banners": (c("banners"), told["banners"])}
    at_most = {"systems_with_ports": (c("with_ports"), c("systems")), "overviews": (c("overviews"), c("with_ports")), "unreadable_dates": (c("unreadable"), c("residue"))}
    return out_of_bounds(every, equal, at_most)


def list_invariants(rows: DataFrame, told: DataFrame) -> DataFrame:
    """(path, rule, left, right): where the reported numbers of lists (path, listed, within, in_several, across) are not those
    of their rows (path, section, machine): lines listed, repeats in a section, machines in several sections, and places
    beyond the first of each machine."""
    found = list_stats(rows).select("path", *(F.col(n).alias(f"_{n}") for n in ("listed", "within", "in_several", "across")))
    both = told.join(found, "path", "left")
    entry = lambda n: F.struct(F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("left"), F.coalesce(F.col(f"_{n}"), F.lit(0)).cast("bigint").alias("right"))
    return both.select("path", F.inline(F.array(*map(entry, ("listed", "within", "in_several", "across"))))).where(~F.col("left").eqNullSafe(F.col("right")))


def list_stats(rows: DataFrame) -> DataFrame:
    """(path, listed, sections, within, machines, in_several, across) of lists (path, section, machine). Lines are counted per
    (path, section, machine) once; what follows works on those counts."""
    per = rows.groupBy("path", "section", "machine").agg(F.count("*").alias("n"))
    a = per.groupBy("path").agg(F.sum("n").alias("listed"), F.count_distinct("section").alias("sections"), F.sum(F.col("n") - 1).alias("within"))
    machines = per.groupBy("path", "machine").agg(F.count("*").alias("n"))
    b = machines.groupBy("path").agg(F.count("*").alias("machines"), F.count_if(F.col("n") >= 2).alias("in_several"), F.sum(F.col("n") - 1).alias("across"))
    return a.join(b, "path")


def list_coverage(rows: DataFrame, names: list[str]) -> DataFrame:
    """(path, machines, present, missing): of the machines of any list (path, machine), those that each of ``names`` has."""
    has = rows.where(F.col("path").isin(names)).groupBy("machine").agg(F.collect_set("path").alias("paths"))  # at most ``names``
    tall = has.select(F.inline(F.transform(F.array(*map(F.lit, names)), lambda n: F.struct(n.alias("path"), F.array_contains("paths", n).alias("has")))))
    return tall.groupBy("path").agg(F.count("*").alias("machines"), F.count_if("has").alias("present"), F.count_if(~F.col("has")).alias("missing"))


def unmatched_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one of two tables has."""
    side = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    both = side(before, "was").join(side(after, "now"), key, "full_outer").where("was is null or now is null")
    return both.select(key, F.when(F.col("now").isNull(), "only_before").otherwise("only_after").alias("side"))


def source_shape(machines: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: whether the machines hold a parent, a variant and a title, and the entries systems and software."""
    m = machines.agg(F.bool_or(F.col("cloneof").isNull()).alias("has_parent"), F.bool_or(F.col("cloneof").isNotNull()).alias("has_clone"), F.bool_or(F.col("description").isNotNull()).alias("has_titles"))
    e = entries.agg(F.bool_or(F.col("kind") == "systems").alias("has_systems"), F.bool_or(F.col("kind") == "software").alias("has_software"))
    every = m.join(e)  # one row each
    return every.select(*(F.coalesce(c, F.lit(False)).alias(c) for c in every.columns))

"""Sections of a machine's record: chips, displays, controls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import labels
from ..functions.text import fold, text_or_empty


def with_multiples(label: str, n: str) -> Column:
    return F.when(F.col(n) > 1, F.format_string("(%dx) %s", F.col(n), F.col(label))).otherwise(F.col(label))


def items_of(rows: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """``rows`` (keys, label, first, own: one per distinct label) with item: the label, with its number if over one.

    Numbers count without case, labels differ by case: Z80 and z80 are two items of (2x).
    """
    n = F.sum("own").over(Window.partitionBy(*keys, fold(F.col(label))))
    return rows.withColumn("n", n).withColumn("item", with_multiples(label, "n")).drop("n")


def listed(when: Column) -> Column:
    """The items for which ``when`` holds, in the order first seen."""
    return F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("first", "item")))), lambda x: x["item"])


def chips_section(chips: DataFrame) -> DataFrame:
    """machine, cpus and audio_chips (count, heading, items), speakers: one row for every machine with chips.

    Audio chips named speaker are counted as speakers, those named sample or samples are left out. Rows are counted by
    label before they move; then a machine's labels lie together and nothing moves again.
    """
    kind, name = F.lower(text_or_empty(F.col("type"))), fold(text_or_empty(F.col("chip")))
    rows = chips.select("machine", "pos", kind.alias("kind"), name.alias("name"), labels.chip_label(F.col("chip"), F.col("clock_hz")).alias("label"))
    audio = F.col("kind") == "audio"
    part = F.when(F.col("kind") == "cpu", "cpu").when(audio & (F.col("name") == "speaker"), "speaker").when(audio & ~F.col("name").isin("samples", "sample"), "audio")
    per = rows.withColumn("part", part).groupBy("machine", "part", "label").agg(F.min("pos").alias("first"), F.count("*").alias("own"))
    per = items_of(per.repartition("machine"), ["machine", "part"])
    count = lambda p: F.coalesce(F.sum(F.when(F.col("part") == p, F.col("own"))), F.lit(0))
    items = lambda p: listed((F.col("part") == p) & (F.col("label") != ""))
    out = per.groupBy("machine").agg(count("cpu").alias("cpu_count"), items("cpu").alias("cpus"), count("audio").alias("audio_count"), items("audio").alias("audio_chips"), count("speaker").alias("speakers"))
    heading = lambda n, one: labels.plural(F.col(n), one)
    return out.select("machine", "cpu_count", heading("cpu_count", "CPU").alias("cpu_heading"), "cpus", "audio_count", heading("audio_count", "Audio Chip").alias("audio_heading"), "audio_chips", "speakers")


def explode_chips(machines: DataFrame, chips: str = "chip") -> DataFrame:
    """(machine, pos, type, chip, clock_hz, cpu_count, audio_count): one row per chip of machines (name, array of chips
    with _type, _name, _clock); a clock that is no number is null. Machines without chips have no rows."""
    number = lambda c: F.when(F.trim(c).rlike("^[0-9]+$"), F.trim(c).try_cast("bigint"))
    typed = F.transform(chips, lambda c, i: F.struct(i.alias("pos"), F.lower(text_or_empty(c["_type"])).alias("type"), text_or_empty(c["_name"]).alias("chip"), number(c["_clock"]).alias("clock_hz")))
    count = lambda t: F.size(F.filter("c", lambda c: c["type"] == t)).cast("bigint").alias(f"{t}_count")
    rows = machines.select(F.col("name").alias("machine"), typed.alias("c"))
    return rows.select("machine", count("cpu"), count("audio"), F.inline("c"))


def device_ref_rollup(machines: DataFrame, refs: str = "device_ref") -> DataFrame:
    """(machine, samples, speakers): of machines with an array of device references (_name), whether one is samples and
    how many are speakers."""
    names = F.transform(F.coalesce(F.col(refs), F.array()), lambda r: F.lower(text_or_empty(r["_name"])))
    count = F.size(F.filter("n", lambda n: n == "speaker")).cast("bigint")
    return machines.select(F.col("name").alias("machine"), names.alias("n")).select("machine", F.exists("n", lambda n: n == "samples").alias("samples"), count.alias("speakers"))


def display_rows(displays: DataFrame) -> DataFrame:
    """Displays as integers, without those that are no vector screens and lack a size."""
    rows = displays.withColumn("type", F.lower(text_or_empty(F.col("type"))))
    for c in ("rotate", "width", "height"):
        rows = rows.withColumn(c, F.when(F.trim(c).rlike("^[0-9]+$"), F.trim(c).try_cast("int")))
    rows = rows.withColumn("refresh", F.col("refresh").try_cast("double"))
    sized = F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False))
    return rows.withColumn("kept", (F.col("type") == "vector") | sized)


def displays_section(displays: DataFrame) -> DataFrame:
    """machine, count, heading, groups, text: equal screens grouped, sizes told of raster and LCD screens only."""
    kind = labels.display_type(F.col("type"))
    flat = kind.isin("Raster", "LCD")
    size = lambda c: F.when(flat & (F.col("width") > 0) & (F.col("height") > 0), F.col(c))
    rows = displays.select("machine", kind.alias("type"), F.coalesce(labels.orientation(F.col("rotate").cast("string")), F.lit("")).alias("turned"), size("width").alias("width"), size("height").alias("height"), labels.format_hz(F.col("refresh").cast("string")).alias("hz"))
    groups = rows.groupBy("machine", "type", "turned", "width", "height", "hz").agg(F.count("*").alias("n"))
    label = F.concat("type", F.when(F.col("turned") == "", "").otherwise(F.concat(F.lit(" ("), "turned", F.lit(")"))))
    label = F.when(F.col("n") > 1, F.format_string("(%dx) %s", "n", label)).otherwise(label)
    line = F.concat_ws("\n", label, F.when(F.col("width").isNotNull(), F.format_string("%d x %d pixels", "width", "height")), "hz")
    order = F.struct("type", "turned", F.coalesce("width", F.lit(0)).alias("w"), F.coalesce("height", F.lit(0)).alias("h"), F.coalesce("hz", F.lit("")).alias("z"), line.alias("line"))
    out = groups.groupBy("machine").agg(F.sum("n").alias("count"), F.count("*").alias("groups"), F.transform(F.array_sort(F.collect_list(order)), lambda x: x["line"]).alias("lines"))
    heading = labels.plural(F.col("count"), "Screen")
    return out.select("machine", "count", heading.alias("heading"), "groups", F.concat_ws("\n", F.format_string("%s: %d", heading, "count"), F.array_join("lines", "\n")).alias("text"))


def controls_section(controls: DataFrame, players: DataFrame) -> DataFrame:
    """machine, player, lines, buttons: players without controls have one line, Unknown controls.

    ``players`` (machine, players) gives the number of players; players beyond it that have controls stay.
    """
    rows = controls.select("machine", "pos", F.coalesce("player", F.lit(1)).alias("player"), labels.control_line(F.col("type"), F.col("ways"), F.col("ways2")).alias("label"), F.greatest(F.coalesce("buttons", F.lit(0)), F.lit(0)).alias("buttons"))
    per = rows.groupBy("machine", "player", "label").agg(F.min("pos").alias("first"), F.count("*").alias("own"), F.sum("buttons").alias("buttons"))
    lines = items_of(per.repartition("machine", "player"), ["machine", "player"])
    lines = lines.groupBy("machine", "player").agg(listed(F.lit(True)).alias("items"), F.sum("buttons").alias("buttons"))
    told = players.where("players > 0").select("machine", F.explode(F.sequence(F.lit(1), F.col("players").cast("int"))).alias("player")).distinct()
    out = told.join(lines, ["machine", "player"], "full_outer")
    return out.select("machine", "player", F.coalesce("items", F.array(F.lit("Unknown controls"))).alias("lines"), F.coalesce("buttons", F.lit(0)).alias("buttons"))


def controls_text(section: DataFrame, players: DataFrame) -> DataFrame:
    """machine, text: the lines of all players in order."""
    n = F.col("buttons")
    block = F.concat_ws("\n", F.format_string("Player %d", "player"), F.array_join("lines", "\n"), F.when(n <= 0, "No Buttons").otherwise(F.concat_ws(" ", n.cast("string"), labels.plural(n, "Button"))))
    listed = section.groupBy("machine").agg(F.transform(F.array_sort(F.collect_list(F.struct("player", block.alias("block")))), lambda x: x["block"]).alias("blocks"))
    told = players.select("machine", F.coalesce("players", F.lit(0)).alias("players"))
    return told.join(listed, "machine", "left").select("machine", F.concat_ws("\n", F.format_string("Players: %d", "players"), F.array_join("blocks", "\n")).alias("text"))

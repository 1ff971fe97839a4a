"""Whole records of parents, and their two projections: what is published and what is preserved.

Every part of a record is one row per parent before it is joined, so no join multiplies rows; the parts are those that the
other operators make. A record holds one family, and its size is that of what the family has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.text import empty_to_null, fold, format_manufacturers, truthy
from ..sources.scratch import scratch_path
from .lineage import classified
from .ports import merge_ports, ports_display, source_ids
from .sections import chips_section, controls_section, controls_text, display_rows, displays_section
from .titles import family_titles, first_seen, page_name, parse_titles, redirect_names

#: Fixed value: how each category of ports is shown.
SHOWN_CATEGORIES = {"CONSOLES": "Consoles", "HANDHELDS": "Handhelds", "COMPUTERS": "Computers", "OTHERS": "Others"}


def ordered(entry: Column, *order: str) -> Column:
    """The entries of a group, an array in ``order``."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, entry.alias("_entry")))), lambda x: x["_entry"])


def described(units: Column, version: Column) -> Column:
    """A description as a map: title1, subtitle1, version1, title2 and so on (of later units only what there is), and
    global_version."""
    parts = F.flatten(
        F.transform(
            units,
            lambda u, i: F.filter(
                F.array(*(F.struct(F.concat(F.lit(n), (i + 1).cast("string")).alias("key"), F.coalesce(u[n], F.lit("")).alias("value")) for n in ("title", "subtitle", "version"))),
                lambda e: (i == 0) | (e["value"] != ""),
            ),
        )
    )
    last = F.array(F.struct(F.lit("global_version").alias("key"), F.coalesce(version, F.lit("")).alias("value")))
    return F.map_from_entries(F.concat(parts, last))


def title_parts(machines: DataFrame) -> DataFrame:
    """(name, mame_titles, mame_titles_display): the titles of a family as rows, the parent's first and variants by name, and
    as lines, variants by title."""
    row = F.struct("role", "machine", "title", "year")
    told = F.concat_ws(" ", "title", F.when(F.trim("year") != "", F.concat(F.lit("("), "year", F.lit(")"))), F.concat(F.lit("["), "role", F.lit(": "), "machine", F.lit("]")))
    rows = family_titles(machines).withColumn("later", F.col("role") == "clone").withColumn("year", F.coalesce("year", F.lit("")))
    return rows.groupBy(F.col("parent").alias("name")).agg(ordered(row, "later", "machine").alias("mame_titles"), ordered(told, "place").alias("mame_titles_display"))


def display_parts(displays: DataFrame) -> DataFrame:
    """(name, displays): equal screens grouped: heading, count and groups with count, type, orientation, refresh and, of
    raster and LCD screens, width and height."""
    kind = labels.display_type(F.col("type"))
    flat = kind.isin("Raster", "LCD") & (F.col("width") > 0) & (F.col("height") > 0)
    size = lambda c: F.when(flat, F.col(c)).alias(c)
    rows = displays.select("machine", kind.alias("type"), F.coalesce(labels.orientation(F.col("rotate").cast("string")), F.lit("")).alias("orientation"), size("width"), size("height"), labels.format_hz(F.col("refresh").cast("string")).alias("refresh"))
    groups = rows.groupBy("machine", "type", "orientation", "width", "height", "refresh").agg(F.count("*").alias("count"))
    one = F.struct("count", "type", "orientation", "width", "height", "refresh")
    order = groups.withColumns({"w": F.coalesce("width", F.lit(0)), "h": F.coalesce("height", F.lit(0)), "z": F.coalesce("refresh", F.lit(""))})
    per = order.groupBy(F.col("machine").alias("name")).agg(F.sum("count").alias("count"), ordered(one, "type", "orientation", "w", "h", "z").alias("groups"))
    return per.select("name", F.struct(labels.plural(F.col("count"), "Screen").alias("heading"), "count", "groups").alias("displays"))


def port_parts(merged: DataFrame) -> DataFrame:
    """(name, ports, with_ports): where the port rows of a family come from: the parent's source, if it has rows, and those of
    variants by name, each with its article's id and its rows by category; and the variants that have any."""
    port = F.struct("machine", F.col("source_id").alias("gh_id"), "platform", "regions", "model", *(empty_to_null(F.col(c)).alias(c) for c in ("title", "date", "publisher", "comment")), F.col("tags").alias("additional_tags"))
    rows = merged.groupBy("parent", "role", "machine", "category").agg(F.min("source_id").alias("gh_id"), ordered(port, "row_no").alias("rows"))
    source = F.struct("machine", "gh_id", "categories")
    sources = rows.groupBy("parent", "role", "machine").agg(F.min("gh_id").alias("gh_id"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "rows")))).alias("categories"))
    # maps have no order: the source is taken by its machine
    own = F.col("role") == "parent"
    per = sources.withColumn("source", source).groupBy("parent").agg(
        F.map_from_entries(F.collect_list(F.when(~own, F.struct("machine", "source")))).alias("by"),
        F.array_sort(F.collect_list(F.when(~own, F.col("machine")))).alias("with_ports"),
        F.first(F.when(own, F.col("source")), True).alias("parent_source"),
    )
    return per.select(F.col("parent").alias("name"), F.struct(F.transform("with_ports", lambda m: F.element_at("by", m)).alias("clone_sources"), "parent_source").alias("ports"), "with_ports")


def page_parts(machines: DataFrame, ported: DataFrame, prefix: str = "") -> DataFrame:
    """(name, description, wiki_page_name, wiki_redirects): a parent's title in parts, its page, and other names of the page:
    its own, then the pages that variants with port rows (``ported``: name, with_ports) would have; each once."""
    parsed, path = parse_titles(machines.select(F.col("name").alias("machine"), "description")).select("machine", "units", "global_version"), scratch_path(machines.sparkSession, "parsed-titles")
    parsed.write.parquet(path)  # four parts are made of it
    parsed = machines.sparkSession.read.schema(parsed.schema).parquet(path)
    page = F.concat(F.lit(prefix), page_name(F.col("units")))
    pages = parsed.select("machine", described(F.col("units"), F.col("global_version")).alias("description"), page.alias("wiki_page_name"))
    own = redirect_names(parsed).select("machine", "pos", F.lit("").alias("of"), "name")
    clones = ported.select(F.col("name").alias("parent"), F.explode("with_ports").alias("of")).join(pages.select(F.col("machine").alias("of"), F.col("wiki_page_name").alias("page")), "of")
    names = own.unionByName(clones.select(F.col("parent").alias("machine"), F.lit(-1).alias("pos"), "of", F.substring("page", F.lit(len(prefix) + 1), F.length("page")).alias("name")))
    target = pages.select("machine", fold(F.substring("wiki_page_name", F.lit(len(prefix) + 1), F.length("wiki_page_name"))).alias("target"))
    names = names.where(F.col("name") != "").join(target, "machine").where(fold(F.col("name")) != F.col("target"))
    names = first_seen(names.withColumn("at", F.struct("of", "pos")), ["machine"], "name", "at")
    redirects = names.groupBy("machine").agg(ordered(F.col("name"), "at").alias("wiki_redirects"))
    out = pages.join(redirects, "machine", "left")
    return out.select(F.col("machine").alias("name"), "description", "wiki_page_name", F.coalesce("wiki_redirects", F.array().cast("array<string>")).alias("wiki_redirects"))


def parent_records(machines: DataFrame, classes: DataFrame, chips: DataFrame, displays: DataFrame, controls: DataFrame, ports: DataFrame, catlist: DataFrame, phrases: DataFrame, prefix: str = "") -> DataFrame:
    """One nested record for each parent whose family has a valid port row.

    ``machines``: name, cloneof, description, year, manufacturer, rom_count, rom_bytes, disk_required, disk_regions (array),
    isbios, isdevice, ismechanical, requires_samples, channels, players; ``chips``, ``displays``, ``controls``: rows of
    machines; ``ports``: rows as ``valid_ports`` takes them; ``classes`` and ``catlist``: classifications; ``phrases``:
    approved wording of (grp, category, subcategory), without which a record has no opening sentence.
    """
    merged, path = merge_ports(ports, machines), scratch_path(machines.sparkSession, "merged-ports")
    merged.write.parquet(path)  # three parts are made of it
    merged = machines.sparkSession.read.schema(merged.schema).parquet(path)
    ported = port_parts(merged)
    # what hangs on other machines, all variants too, is in no record
    with_rows = merged.select("parent").distinct()
    of_parents = lambda rows, c="machine": rows.join(with_rows, rows[c] == with_rows["parent"], "left_semi")
    chips, displays, controls = of_parents(chips), of_parents(displays), of_parents(controls)
    own = ["name", "cloneof", "year", "manufacturer", "rom_count", "rom_bytes", "disk_required", "disk_regions", "isbios", "isdevice", "ismechanical", "requires_samples", "channels", "players"]
    base = classified(machines.select(*own), classes).join(ported, "name")
    base = base.join(page_parts(machines, ported, prefix), "name").join(title_parts(machines), "name", "left")
    base = base.join(source_ids(merged).select(F.col("parent").alias("name"), F.col("source_ids").alias("gh_ids")), "name", "left")
    lines = ports_display(merged)
    shown = F.element_at(F.create_map(*(F.lit(x) for pair in SHOWN_CATEGORIES.items() for x in pair)), F.col("category"))
    base = base.join(lines.groupBy(F.col("parent").alias("name")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(shown, "lines")))).alias("ports_display")), "name", "left")
    named = lambda df: df.withColumnRenamed("machine", "name")
    base = base.join(named(chips_section(chips)), "name", "left")
    kept = display_rows(displays).where("kept")
    base = base.join(display_parts(kept), "name", "left").join(named(displays_section(kept)).select("name", F.col("text").alias("displays_display")), "name", "left")
    players = of_parents(machines, "name").select(F.col("name").alias("machine"), "players")
    per_player = controls_section(controls, players)
    text = named(controls_text(per_player, players)).select("name", F.col("text").alias("controls_display"))
    rows = per_player.groupBy(F.col("machine").alias("name")).agg(ordered(F.struct("player", F.col("lines").alias("control_lines"), "buttons"), "player").alias("per_player"))
    base = base.join(text, "name", "left").join(rows, "name", "left")
    listed = catlist.select(F.col("machine").alias("name"), F.struct(F.col("grp").alias("group"), F.col("category"), F.col("subcategory")).alias("snaps_classification"))
    wording = phrases.select(*(F.col(c).alias(f"_{c}") for c in ("grp", "category", "subcategory")), "phrase")
    base = base.join(listed, "name", "left")
    told = base["snaps_classification"]
    base = base.join(wording, (told["group"] == F.col("_grp")) & (told["category"] == F.col("_category")) & (told["subcategory"] == F.col("_subcategory")), "left")
    nothing = F.array().cast("array<string>")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    part = lambda one, count, items: F.struct(labels.plural(n(count), one).alias("heading"), n(count).alias("count"), F.coalesce(F.col(items), nothing).alias("items"))
    cpus, audio = part("CPU", "cpu_count", "cpus"), part("Audio Chip", "audio_count", "audio_chips")
    block = lambda one, items: F.concat_ws("\n", F.concat(F.when(F.size(items) == 1, one).otherwise(one + "s"), F.lit(":")), F.nullif(F.array_join(items, "\n"), F.lit("")))
    no_screens = F.struct(F.lit("Screens").alias("heading"), F.lit(0).cast("bigint").alias("count"), F.array().cast(base.schema["displays"].dataType["groups"].dataType).alias("groups"))
    no_rows = F.array().cast(base.schema["per_player"].dataType)
    maker = empty_to_null(format_manufacturers(F.coalesce("manufacturer", F.lit(""))))
    vector = F.exists(F.coalesce(F.col("displays.groups"), no_screens["groups"]), lambda g: g["type"] == "Vector")
    year = empty_to_null(F.col("year"))
    sentence = labels.opening_sentence(F.col("wiki_page_name"), F.col("phrase"), year, maker, F.array_contains(labels.media_labels(F.col("disk_regions")), "LaserDisc"), vector)
    return base.select(
        "name", "wiki_page_name", "wiki_redirects", "description", "mame_titles", "mame_titles_display", sentence.alias("opening_sentence"), year.alias("year"), maker.alias("manufacturer"),
        n("rom_count").cast("bigint").alias("rom_count"), n("rom_bytes").cast("bigint").alias("rom_bytes_total"), "disk_required", F.coalesce("disk_regions", nothing).alias("disk_regions"),
        labels.rom_block(F.col("rom_count"), F.col("rom_bytes"), F.col("disk_required"), F.col("disk_regions")).alias("roms_display"),
        F.struct(cpus.alias("cpus"), audio.alias("audio_chips"), truthy(F.col("requires_samples")).alias("requires_samples"), n("channels").alias("audio_channels"), n("speakers").alias("speakers")).alias("chips"),
        F.concat_ws("\n", block("CPU", cpus["items"]), block("Audio Chip", audio["items"])).alias("chips_display"),
        F.coalesce("displays", no_screens).alias("displays"), F.coalesce("displays_display", F.lit("Screens: 0")).alias("displays_display"),
        F.struct(n("players").alias("players"), F.coalesce("per_player", no_rows).alias("per_player")).alias("controls"), "controls_display",
        "ports", F.coalesce("ports_display", F.create_map().cast("map<string,array<string>>")).alias("ports_display"), "snaps_classification", "game_status", "category", "type",
        *(truthy(F.col(c)).alias(c) for c in ("isbios", "isdevice", "ismechanical", "requires_samples")), "gh_ids",
    )


def project_wiki(records: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """(name, record): what is published of each record, of ``published`` parents (name) only if given: names, sentences and
    display texts; what a record lacks is left out."""
    rows = records if published is None else records.join(published.select("name"), "name", "left_semi")
    some = [F.nullif(F.col(c), F.lit("")).alias(c) for c in ("roms_display", "chips_display", "displays_display", "controls_display")]
    filled = lambda c: F.when(F.size(c) > 0, F.col(c)).alias(c)
    kept = ["wiki_page_name", "opening_sentence", "wiki_redirects", "year", "manufacturer", filled("mame_titles_display"), *some, filled("ports_display"), filled("gh_ids")]
    return rows.select("name", F.struct(*kept).alias("record"))


def project_raw(records: DataFrame) -> DataFrame:
    """(name, record): all that is preserved of each record, as structures. Port rows are variants, in which what is not told
    stays as null; a parent without port rows of its own has an empty source."""
    whole = lambda c: F.parse_json(F.to_json(c, {"ignoreNullFields": "false"}))
    ports = F.struct(F.transform("ports.clone_sources", whole).alias("clone_sources"), F.coalesce(whole("ports.parent_source"), F.parse_json(F.lit("{}"))).alias("parent_source"))
    kept = ["wiki_page_name", "wiki_redirects", "mame_titles", "description", "year", "manufacturer", "rom_count", "rom_bytes_total", "disk_required", "disk_regions", "chips", "displays", "controls", ports.alias("ports"), "snaps_classification", "game_status", "category", "type", "isbios", "isdevice", "ismechanical", "requires_samples", "gh_ids"]
    return records.select("name", F.struct(F.col("name").alias("machine"), *kept).alias("record"))

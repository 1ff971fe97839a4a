"""Text articles: sections, headings, suppressed lines, and port lines as typed rows.

Lines are rows (machine, line_no, line); order is always a column, and windows go over one machine or one section.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import parse_loose_date
from ..functions.text import empty_to_null, section_label, strip, text_or_empty
from ..sources.scratch import scratch_path
from .dictionary import BROADCAST_BYTES, by_distinct
from .metrics import first_examples
from .ordering import member_lists

#: Section headings, other names for them, and categories of ports.
HEADINGS = ["TECHNICAL", "TRIVIA", "UPDATES", "SCORING", "TIPS AND TRICKS", "SERIES", "STAFF", "PORTS", "CONTRIBUTE", "CAST OF CHARACTERS"]
ALIASES = {"TIPS & TRICKS": "TIPS AND TRICKS", "TIP AND TRICKS": "TIPS AND TRICKS", "UPDATE": "UPDATES", "CAST OF CHARACTER": "CAST OF CHARACTERS"}
CATEGORIES = ["CONSOLES", "COMPUTERS", "HANDHELDS", "OTHERS"]
#: How alike an unknown heading must be to a known one.
ALIKE = 0.84
BANNER = r"(?i)^-+\s+([A-Z0-9 &]+)\s+-+$"
CATEGORY = r"(?i)^\*\s*([A-Z0-9 &]+)\s*:\s*$"
#: Lines that are left out, by section; the first rule that matches counts.
SUPPRESSED = {
    "overview": [("overview_type_line", r"(?i)^\s*Arcade\s+Video\s+game\b"), ("overview_title_line", r"(?i)^\s*.+?(\(c\)|©)\s*\d{4}\b")],
    "technical": [
        ("technical_cpu_line", r"(?i)^\s*(?:main\s+)?cpus?\s*:"),
        ("technical_sound_cpu_line", r"(?i)^\s*(?:sound|audio)\s+cpus?\s*:"),
        ("technical_sound_chips_line", r"(?i)^\s*sound\s+chips?\s*:"),
        ("technical_players_line", r"(?i)^\s*players?\s*:"),
        ("technical_control_line", r"(?i)^\s*control\s*:"),
        ("technical_buttons_line", r"(?i)^\s*buttons?\s*:"),
        ("technical_screen_orientation_line", r"(?i)^\s*screen\s+orientation\s*:"),
        ("technical_screen_resolution_line", r"(?i)^\s*(?:screen|video)\s+resolution\s*:"),
        ("technical_refresh_rate_line", r"(?i)^\s*(?:refresh\s+rate|screen\s+refresh)\s*:"),
        ("technical_palette_colours_line", r"(?i)^\s*palette\s+colou?rs?\s*:"),
        ("technical_buttons_pair_line", r"(?i)^\s*(?:buttons?(?:\s+per\s+player)?|controls?)\s*(?::|-)\s*.+$"),
        ("technical_control_per_player_line", r"(?i)^\s*controls?\s+per\s+player\s*(?::|-)\s*.+$"),
        ("technical_game_size_line", r"(?i)^\s*game\s+size\s*(?::|-)\s*.+$"),
        ("technical_display_resolution_line", r"(?i)^\s*display\s*(?::|-)\s*.*(?:\b\d{2,4}\s*x\s*\d{2,4}\b|\bresolution\b)"),
        ("technical_display_colours_line", r"(?i)^\s*display\s*(?::|-)\s*.*\bcolou?rs?\b"),
        ("technical_display_line", r"(?i)^\s*display\s*(?::|-)\s*.+$"),
        ("technical_control_mapping_line", r"^\s*=>\s*\[[^\]]+\].*$"),
    ],
}


def clean_line(c: Column) -> Column:
    return strip(F.translate(F.coalesce(c, F.lit("")), " ", " "))


def near_miss_banner(c: Column) -> Column:
    """Whether a line looks like -Foo- but is no heading: one hyphen at each end and a letter inside."""
    s = clean_line(c)
    return s.rlike(r"^-(?!-).*\p{L}.*(?<!-)-$") & ~s.rlike(BANNER)


def canonical_headings(raw: DataFrame, column: str = "heading") -> DataFrame:
    """(heading, canonical, via): each distinct heading by its own name, an alias, or the most alike known heading.

    Only distinct headings are compared; only those that no exact or alias rule maps reach Python, in batches.
    """
    names = raw.select(F.col(column).alias("heading")).distinct().withColumn("norm", section_label(F.col("heading")))
    alias = F.element_at(F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair)), F.col("norm"))
    known = F.col("norm").isin(HEADINGS)
    ruled = names.where(known | alias.isNotNull()).select("heading", F.when(known, F.col("norm")).otherwise(alias).alias("canonical"), F.when(known, None).otherwise("alias").alias("via"))
    rest = names.where(~known & alias.isNull())

    def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from difflib import get_close_matches

        for b in batches:
            best = [next(iter(get_close_matches(n, HEADINGS, n=1, cutoff=ALIKE)), None) for n in b["norm"]]
            yield pd.DataFrame({"heading": b["heading"], "canonical": [m or n for m, n in zip(best, b["norm"], strict=True)], "via": ["fuzzy" if m else None for m in best]})

    return ruled.union(rest.mapInPandas(alike, "heading string, canonical string, via string"))


def sections_from_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with section: the last heading above, OPENING before any; heading lines themselves are left out.

    The distinct headings are named once and written. Where all of them fit a task, every line looks its own up; else only
    the heading lines are joined, so that the others, which have none, do not meet at one key.
    """
    spark = lines.sparkSession
    rows = lines.withColumn("heading", empty_to_null(F.regexp_extract(clean_line(F.col("line")), BANNER, 1)))
    path = scratch_path(spark, "headings")
    canonical_headings(rows.where("heading is not null"), "heading").select("heading", F.col("canonical").alias("named")).write.parquet(path)
    named = spark.read.schema("heading string, named string").parquet(path)
    size = named.agg(F.sum(F.octet_length("heading") + F.octet_length("named") + 32)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(named), "heading", "left")
    else:
        found = rows.where("heading is not null").join(named, "heading")
        rows = found.unionByName(rows.where("heading is null").withColumn("named", F.lit(None).cast("string")))
    above = Window.partitionBy("machine").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("section", F.coalesce(F.last("named", True).over(above), F.lit("OPENING")))
    return rows.where("heading is null").select(*lines.columns, "section")


def article_ids(lines: DataFrame) -> DataFrame:
    """(machine, source_id): the first id in a link of the CONTRIBUTE section (lines with section)."""
    pattern = r"(?i)(?:[?&](?:amp;)?id=|/game/)(\d+)(?=/|[&#\s]|$)"
    found = lines.where(F.col("section") == "CONTRIBUTE").withColumn("id", empty_to_null(F.regexp_extract("line", pattern, 1)).try_cast("bigint"))
    return found.where("id is not null").groupBy("machine").agg(F.min_by("id", "line_no").alias("source_id"))


def suppression_rule(section: Column, line: Column) -> Column:
    """The first rule that leaves a line out of its section, or null."""
    out = F.when(text_or_empty(line) == "", None)
    for name, rules in SUPPRESSED.items():
        for rule, pattern in rules:
            out = out.when((F.lower(section) == name) & line.rlike(pattern), rule)
    return out


def suppress_lines(lines: DataFrame) -> DataFrame:
    """``lines`` (with section) with rule, kept and gap_before.

    Blank lines stay. If rules leave nothing of a section, its first line that reads like content stays: 100
    characters, 12 words or two separators. gap_before marks a kept line before which non-blank lines vanished since
    the last kept one: a paragraph break belongs there.
    """
    w = Window.partitionBy("machine", "section")
    blank = text_or_empty(F.col("line")) == ""
    rows = lines.withColumn("rule", suppression_rule(F.col("section"), F.col("line"))).withColumn("blank", blank)
    t = clean_line(F.col("line"))
    content = ~F.col("blank") & ((F.length(t) >= 100) | (F.size(F.split(t, r"\s+")) >= 12) | (F.length(t) - F.length(F.translate(t, ".,;:", "")) >= 2))
    none = ~F.bool_or(F.col("rule").isNull() & ~F.col("blank")).over(w)
    rescue = none & F.col("rule").isNotNull() & (F.col("line_no") == F.min(F.when(content, F.col("line_no"))).over(w))
    rows = rows.withColumn("kept", F.col("rule").isNull() | F.coalesce(rescue, F.lit(False)))
    before = w.orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    last_kept = F.max(F.when(F.col("kept"), F.col("line_no"))).over(before)
    last_gone = F.max(F.when(~F.col("kept") & ~F.col("blank"), F.col("line_no"))).over(before)
    gap = F.col("kept") & ~F.col("blank") & last_gone.isNotNull() & (last_gone > F.coalesce(last_kept, last_gone - 1))
    return rows.withColumn("gap_before", F.coalesce(gap, F.lit(False))).drop("blank")


def suppression_counts(lines: DataFrame) -> DataFrame:
    """(rule, n, systems): lines that each rule leaves out (``suppress_lines``), and machines that lose any."""
    return lines.where("not kept").groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("machine").alias("systems"))


def split_comment(line: Column) -> Column:
    """struct(head, comment): at the first colon outside quotes; inch marks of 3.5" and 5.25" are no quotes."""
    hidden = F.regexp_replace(line, '(3\\.5|5\\.25)"', "$1\x01")
    pattern = r'^((?:[^":]++|"[^"]*")*+):(.*)$'
    show = lambda c: F.replace(c, F.lit("\x01"), F.lit('"'))
    found = hidden.rlike(pattern)
    head = F.when(found, F.regexp_replace(show(F.regexp_extract(hidden, pattern, 1)), r"\s+$", "")).otherwise(line)
    return F.struct(head.alias("head"), F.when(found, empty_to_null(strip(show(F.regexp_extract(hidden, pattern, 2))))).alias("comment"))


def parse_port_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """``lines`` with what ``_parse_each_line`` finds; where many lines are the same, each distinct one is parsed once."""
    return by_distinct(lines, column, _parse_each_line)


def _parse_each_line(lines: DataFrame, column: str) -> DataFrame:
    """``lines`` with regions, platform, model, title, date, publisher, comment, tags, residue, indicator.

    One step after the other, as each works on what the last one left: comment, square brackets (two letters are a
    region, Model starts models), the first quoted title, the first parenthesis as a date (unreadable: residue) with
    the publisher behind it, else a publisher after by; what remains is the platform.
    """
    whole = strip(F.coalesce(F.col(column), F.lit("")))
    rows = lines.withColumn("_whole", whole).withColumn("_c", split_comment(F.col("_whole")))
    rows = rows.withColumn("comment", F.col("_c.comment")).withColumn("_w", F.col("_c.head"))
    rows = rows.withColumn("_tags", F.transform(F.regexp_extract_all("_w", F.lit(r"\[(.*?)\]"), F.lit(1)), strip))
    model = lambda t: t.startswith("Model")
    rows = rows.withColumn("regions", F.filter("_tags", lambda t: ~model(t) & (F.length(t) == 2)))
    rows = rows.withColumn("tags", F.filter("_tags", lambda t: ~model(t) & (F.length(t) != 2)))
    rows = rows.withColumn("_m", strip(F.replace(F.get(F.reverse(F.filter("_tags", model)), F.lit(0)), F.lit("Model"), F.lit(""))))
    pair = r"^(.*?)\s*\((.*?)\)"
    main, alt = strip(F.regexp_extract("_m", pair, 1)), strip(F.regexp_extract("_m", pair, 2))
    twins = F.col("_m").rlike(pair) & (F.substring(main, 1, 4) == F.substring(alt, 1, 4))
    rows = rows.withColumn("model", F.when(F.col("_m").isNull(), F.array().cast("array<string>")).when(F.col("_m").contains("/"), F.transform(F.split("_m", "/"), strip)).when(twins, F.array(main, alt)).otherwise(F.array("_m")))
    rows = rows.withColumn("_w", F.regexp_replace("_w", r"\[(.*?)\]", ""))
    rows = rows.withColumn("_q", F.regexp_extract("_w", '"(.*?)"', 0)).withColumn("title", empty_to_null(strip(F.regexp_extract("_w", '"(.*?)"', 1))))
    rows = rows.withColumn("_w", F.when(F.col("_q") == "", F.col("_w")).otherwise(F.replace("_w", F.col("_q"), F.lit(""))))
    bracket = r"^(.*?)\((.*?)\)(.*)$"
    has = F.col("_w").rlike(bracket)
    rows = rows.withColumn("_raw", F.when(has, strip(F.regexp_extract("_w", bracket, 2)))).withColumn("_post", F.when(has, strip(F.regexp_extract("_w", bracket, 3))).otherwise(""))
    rows = rows.withColumn("_w", F.when(has, strip(F.regexp_extract("_w", bracket, 1))).otherwise(F.col("_w")))
    dated = F.coalesce(F.col("_raw") != "", F.lit(False))
    rows = rows.withColumn("_dated", dated).withColumn("date", F.when(F.col("_dated"), parse_loose_date(F.col("_raw"))))
    rows = rows.withColumn("residue", F.when(F.col("_dated") & F.col("date").isNull(), F.array("_raw")).otherwise(F.array().cast("array<string>")))
    tidy = lambda c: F.regexp_replace(F.regexp_replace(c, r"^\s*-\s*", ""), "[.:; ]+$", "")
    by = r"(?i)\bby\s+(.+)"
    after = tidy(strip(F.regexp_replace("_post", r"(?i)^\s*by\s+", "")))
    rows = rows.withColumn("publisher", F.when(F.col("_dated"), F.when(F.col("_post") != "", after)).when(F.col("_w").rlike(by), tidy(strip(F.regexp_extract("_w", by, 1)))))
    zone = F.when(F.col("_dated"), F.col("_post")).otherwise(F.col("_w"))
    indicator = (
        F.when(F.col("_dated"), F.when(zone == "", "none").when(zone.rlike(r"(?i)^released\s+by\b"), "released_by").when(zone.rlike(r"(?i)^by\b"), "by").otherwise("other_after_date"))
        .when(zone.rlike(r"(?i)\breleased\s+by\b"), "released_by")
        .when(zone.rlike(r"(?i)\bby\b"), "by")
        .otherwise("none")
    )
    rows = rows.withColumn("indicator", indicator)
    rows = rows.withColumn("_w", F.when(~F.col("_dated") & F.col("_w").rlike(by), strip(F.regexp_replace("_w", r"(?i)\bby\s+.+$", ""))).otherwise(strip(F.col("_w"))))
    bare = strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("_c.head"), r"\[[^\]]*\]", ""), '"[^"]*"', ""), r"\([^)]*\)", ""))
    rows = rows.withColumn("platform", F.coalesce(empty_to_null(F.col("_w")), empty_to_null(bare)))
    return rows.drop("_whole", "_c", "_w", "_tags", "_m", "_q", "_raw", "_post", "_dated")


def port_line_findings(parsed: DataFrame, column: str = "line", keep: list[str] | None = None) -> DataFrame:
    """(rule_id, machine, source_text, value): lines with an odd number of quotes or brackets, or an unreadable date;
    columns ``keep`` stay."""
    line = strip(F.col(column))
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    quotes = count('"') - count(r'\b(?:3\.5|5\.25)"(?!\w)')
    one = lambda cond, rule, value: F.when(cond, F.struct(F.lit(rule).alias("rule_id"), value.cast("string").alias("value")))
    none = F.lit(None).cast("string")
    found = F.array(
        one(quotes % 2 == 1, "ports.odd_quotes", none),
        one(count(r"[()\[\]{}]") % 2 == 1, "ports.odd_brackets", none),
        one(F.size("residue") > 0, "ports.unparsable_date", F.get("residue", F.lit(0))),
    )
    rows = parsed.select("machine", line.alias("source_text"), *(keep or []), F.explode(F.filter(found, lambda f: f.isNotNull())).alias("f"))
    return rows.select("f.rule_id", "machine", "source_text", "f.value", *(keep or []))


def port_line_context(lines: DataFrame) -> DataFrame:
    """Lines of PORTS sections with kind (overview, category, blank, banner, port), category and platform_context.

    A known category holds until the next heading, an unexpected one gives none. A line that starts a block, holds
    letters but no quote, bracket or colon, and is followed by a line that looks like a port, is a banner: its text
    is the platform of the block's lines.
    """
    order = Window.partitionBy("machine").orderBy("line_no")
    above = order.rowsBetween(Window.unboundedPreceding, 0)
    t = clean_line(F.col("line"))
    head = F.upper(strip(F.regexp_extract(t, CATEGORY, 1)))
    rows = lines.withColumn("text", t).withColumn("_head", F.when(t.rlike(CATEGORY), head))
    known = F.when(F.col("_head").isNotNull(), F.when(F.col("_head").isin(CATEGORIES), F.col("_head")).otherwise(""))
    rows = rows.withColumn("category", empty_to_null(F.last(known, True).over(above)))
    rows = rows.withColumn("_begun", F.coalesce(F.max(F.col("_head").isin(CATEGORIES)).over(above), F.lit(False)))
    rows = rows.withColumn("_break", (F.col("text") == "") | F.col("_head").isNotNull())
    rows = rows.withColumn("_block", F.sum(F.col("_break").cast("int")).over(above))
    starts = F.lag("_break", 1, True).over(order) & ~F.col("_break")
    # an unexpected category does not open a block
    fresh = starts & ~F.coalesce(F.lag(F.col("_head").isNotNull() & ~F.col("_head").isin(CATEGORIES), 1).over(order), F.lit(False))
    plain = ~F.col("text").rlike(r'^\[|["“”():]') & F.regexp_replace("text", r"\[[^\]]+\]", "").rlike("[A-Za-z]")
    following = F.lead("text").over(order)
    portish = F.coalesce(following.rlike(r'["\[\]():]') & ~F.coalesce(F.lead("_break").over(order), F.lit(True)), F.lit(False))
    rows = rows.withColumn("_banner", F.col("_begun") & fresh & plain & portish)
    block = Window.partitionBy("machine", "_block")
    rows = rows.withColumn("platform_context", F.max(F.when(F.col("_banner"), F.col("text"))).over(block))
    kind = F.when(F.col("_head").isNotNull(), "category").when(~F.col("_begun"), F.when(F.col("text") == "", "blank").otherwise("overview")).when(F.col("text") == "", "blank").when(F.col("_banner"), "banner").when(F.col("category").isNull(), "skipped").otherwise("port")
    return rows.withColumn("kind", kind).select(*lines.columns, "kind", "category", "platform_context")


def found_values(parsed: DataFrame) -> DataFrame:
    """(kind, value, bucket, systems, machines): distinct values of port lines (platform, publisher, comment, title, model,
    tags, regions, inch_mark) with the machines that have them, sorted, in ``member_lists``."""
    one = lambda c: F.struct(F.lit(c).alias("kind"), F.col(c).alias("value"))
    many = lambda c: F.transform(c, lambda x: F.struct(F.lit(c).alias("kind"), x.alias("value")))
    inches = F.transform(F.array_distinct(F.regexp_extract_all("line", F.lit(r'(3\.5|5\.25)"'), F.lit(1))), lambda x: F.struct(F.lit("inch_mark").alias("kind"), x.alias("value")))
    every = F.concat(F.array(*(one(c) for c in ("platform", "publisher", "comment", "title"))), many("model"), many("tags"), many("regions"), inches)
    tall = parsed.select("machine", F.explode(every).alias("x")).select("machine", "x.*").where("value is not null")
    return member_lists(tall, ["kind", "value"], "machine").withColumnRenamed("members", "machines")


#: How much is kept of a section without categories and of a line without a platform, and how many such lines.
EXCERPT, EXAMPLE, EXAMPLES = 140, 200, 3
#: Items shown of one kind of note.
SHOWN = 12


def article_notes(lines: DataFrame) -> DataFrame:
    """(machine, rule_id, line_no, item): all that is odd in articles, one row per occurrence.

    Of whole articles: near_miss_banner (the line) and unmapped_heading (its normalised name). Of PORTS sections:
    missing_subheadings (the beginning of a section without a known category), unexpected_category (its name),
    platform_banner (its text), null_platform (the line, if it has no platform and stands under none), residue, and
    the findings of ``port_line_findings``. Rows without an item say only that something was there.
    """
    text = clean_line(F.col("line"))
    note = lambda df, rule, item: df.select("machine", F.lit(rule).alias("rule_id"), "line_no", item.alias("item"))
    headings = lines.where(text.rlike(BANNER)).select("machine", "line_no", F.regexp_extract(text, BANNER, 1).alias("heading"))
    odd = canonical_headings(headings).where(F.col("via").isNull() & ~F.col("canonical").isin(HEADINGS)).select("heading", "canonical")
    context = port_line_context(sections_from_lines(lines).where(F.col("section") == "PORTS"))
    head = strip(F.regexp_extract(text, CATEGORY, 1))
    told = F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("kind") != "category") & (text != ""), F.struct("line_no", text.alias("t"))))), lambda x: x["t"]), " ")
    bare = context.groupBy("machine").agg(F.count("category").alias("n"), F.min("line_no").alias("line_no"), F.substring(told, 1, EXCERPT).alias("excerpt")).where("n = 0")
    parsed = parse_port_lines(context.where("kind = 'port'"))
    found = port_line_findings(parsed.select("machine", "line_no", "line", "residue"), keep=["line_no"])
    return (
        note(lines.where(near_miss_banner(F.col("line"))), "near_miss_banner", F.col("line"))
        .union(note(headings.join(odd, "heading"), "unmapped_heading", F.col("canonical")))
        .union(note(bare, "missing_subheadings", F.col("excerpt")))
        .union(note(context.where((F.col("kind") == "category") & ~F.upper(head).isin(CATEGORIES)), "unexpected_category", head))
        .union(note(context.where("kind = 'banner'"), "platform_banner", text))
        .union(note(parsed.where("platform is null and platform_context is null"), "null_platform", F.substring(text, 1, EXAMPLE)))
        .union(note(parsed.where(F.size("residue") > 0), "residue", F.lit(None).cast("string")))
        .union(found.select("machine", "rule_id", "line_no", F.coalesce("value", "source_text").alias("item")))
    )


def note_counts(notes: DataFrame) -> DataFrame:
    """(rule_id, n, systems, examples): occurrences, machines that have any, and the first EXAMPLES items by name."""
    per = notes.groupBy("rule_id").agg(F.count("*").alias("n"), F.count_distinct("machine").alias("systems"))
    few = first_examples(notes.where("item <> ''").select("rule_id", "item").distinct(), ["rule_id"], "item", "item", EXAMPLES)
    return per.join(few, "rule_id", "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>")))


def structural_observations(notes: DataFrame, most: int = SHOWN) -> DataFrame:
    """(machine, rule_id, total, items, omitted): what articles' structure shows, without the findings on single lines.

    Banners that nearly are headings and lines without a platform are listed as they come (of the latter the first
    EXAMPLES), other items once each by name, platform banners with their number. ``most`` items are shown and the
    rest is counted as omitted.
    """
    kinds = ["missing_subheadings", "near_miss_banner", "null_platform", "unmapped_heading", "unexpected_category", "platform_banner", "residue"]
    lined = F.col("rule_id").isin("near_miss_banner", "null_platform")
    per = notes.where(F.col("rule_id").isin(kinds)).groupBy("machine", "rule_id", F.when(lined, F.col("line_no")).alias("at"), "item").agg(F.count("*").alias("n"))
    named = F.when(F.col("rule_id") == "platform_banner", F.format_string("%s (%d occurrence(s))", "item", "n")).otherwise(F.col("item"))
    group = Window.partitionBy("machine", "rule_id")
    shows = F.coalesce(F.col("item") != "", F.lit(False))
    place = F.row_number().over(group.orderBy(~shows, "at", F.lower("item"), "item"))
    most_of = F.when(F.col("rule_id") == "null_platform", EXAMPLES).otherwise(most)
    rows = per.withColumns({"shows": shows, "place": place, "named": named})
    kept = F.when(F.col("shows") & (F.col("place") <= most_of), F.struct("place", "named"))
    out = rows.groupBy("machine", "rule_id").agg(F.sum("n").alias("total"), F.count_if("shows").alias("told"), F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["named"]).alias("items"))
    omitted = F.when(F.col("rule_id") == "null_platform", 0).otherwise(F.greatest(F.lit(0), F.col("told") - most))
    return out.select("machine", "rule_id", "total", "items", omitted.cast("bigint").alias("omitted"))


def heading_quality(lines: DataFrame) -> DataFrame:
    """(heading, canonical, via, standard, n, systems): headings of articles by their normalised name, with what they are
    mapped to and by which rule (alias, fuzzy; null: by none), and machines that have them. Lines that nearly are
    headings count under via near_miss, by what they say."""
    text = clean_line(F.col("line"))
    headings = lines.where(text.rlike(BANNER)).select("machine", F.regexp_extract(text, BANNER, 1).alias("raw"))
    named = canonical_headings(headings, "raw").select(F.col("heading").alias("raw"), "canonical", "via")
    rows = headings.join(named, "raw").select("machine", section_label(F.col("raw")).alias("heading"), "canonical", "via")
    missed = lines.where(near_miss_banner(F.col("line"))).select("machine", text.alias("heading"), F.lit(None).cast("string").alias("canonical"), F.lit("near_miss").alias("via"))
    per = rows.union(missed).groupBy("heading", "canonical", "via").agg(F.count("*").alias("n"), F.count_distinct("machine").alias("systems"))
    return per.select("heading", "canonical", "via", F.col("heading").isin(HEADINGS).alias("standard"), "n", "systems")

"""Line kinds and the paragraphs around lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import text_or_empty

#: Sections read line by line, and those read so if no line of theirs has structure.
PER_LINE, HEURISTIC = ["overview", "trivia"], ["updates"]


def outside_brackets(line: Column) -> Column:
    """``line`` with all within round or square brackets, the brackets too, as dots; places stay."""
    begin = F.struct(F.lit(0).alias("r"), F.lit(0).alias("s"), F.lit("").alias("out"))

    def step(acc: Column, ch: Column) -> Column:
        r = F.when(ch == "(", acc["r"] + 1).when(ch == ")", F.greatest(F.lit(0), acc["r"] - 1)).otherwise(acc["r"])
        s = F.when(ch == "[", acc["s"] + 1).when(ch == "]", F.greatest(F.lit(0), acc["s"] - 1)).otherwise(acc["s"])
        inside = (r > 0) | (s > 0) | (acc["r"] > 0) | (acc["s"] > 0)
        return F.struct(r.alias("r"), s.alias("s"), F.concat(acc["out"], F.when(inside, ".").otherwise(ch)).alias("out"))

    return F.aggregate(F.split(F.coalesce(line, F.lit("")), ""), begin, step, lambda acc: acc["out"])


def pair_at(line: Column) -> Column:
    """Place of the first colon, or hyphen between white space, outside brackets; 0 for none."""
    return F.regexp_instr(outside_brackets(line), F.lit(r":|(?<=\s)-(?=\s)"))


def line_flags(lines: DataFrame) -> DataFrame:
    """``lines`` with blank, hyphens, bullet, numbered, subheading, banner, caps, pair, label, value, structural."""
    t, at = F.coalesce(F.col("line"), F.lit("")), F.col("_at")
    rows = lines.withColumn("_at", pair_at(t))
    label = F.when(at > 0, F.trim(F.substring(t, F.lit(1), at - 1)))
    value = F.when(at > 0, F.trim(F.substring(t, at + 1, F.length(t))))
    rows = rows.withColumns(
        {
            "blank": text_or_empty(F.col("line")) == "",
            "hyphens": t.rlike(r"^\s*-+\s*$"),
            "bullet": t.rlike(r"^\s*[*\-]\s+\S"),
            "numbered": t.rlike(r"^\s*(?:\d+[)\].]|[\[(]\d+[\])])\s+\S"),
            "subheading": t.rlike(r"^\s*\*\s+.+:\s*$"),
            "banner": t.rlike(r"^\s*-\s*([^-].*[^-])\s*-\s*$"),
            "caps": t.rlike(r"^[A-Z0-9][A-Z0-9 \-&'/]+:?$"),
            "pair": F.coalesce((F.length(label).between(1, 100)) & (F.length(value) > 0), F.lit(False)),
        }
    )
    rows = rows.withColumn("label", F.when(F.col("pair"), label)).withColumn("value", F.when(F.col("pair"), value))
    some = F.col("hyphens") | F.col("bullet") | F.col("numbered") | F.col("subheading") | F.col("banner") | F.col("pair")
    return rows.withColumn("structural", ~F.col("blank") & some).drop("_at")


def section_policy(flagged: DataFrame) -> DataFrame:
    """(machine, section, per_line, heuristic): whether each line of a section is a paragraph of its own."""
    got = flagged.groupBy("machine", "section").agg(F.bool_or("structural").alias("structural"), F.count_if(~F.col("blank")).alias("n"))
    tag = F.lower("section")
    heuristic = tag.isin(HEURISTIC) & ~F.col("structural") & (F.col("n") > 1)
    return got.select("machine", "section", (tag.isin(PER_LINE) | heuristic).alias("per_line"), heuristic.alias("heuristic"))


def list_blocks(flagged: DataFrame) -> DataFrame:
    """(machine, section, first_line, kind, items): runs of bullets or numbered lines, blank lines between apart.

    A line that starts in lower case after a line that ends without .!?: goes on with the item before it.
    """
    order = Window.partitionBy("machine", "section").orderBy("line_no")
    above = order.rowsBetween(Window.unboundedPreceding, 0)
    kind = F.when(F.col("bullet"), "bullet_list").when(F.col("numbered"), "numbered_list")
    rows = flagged.withColumn("_kind", kind).withColumn("_prev", F.lag("line").over(order))
    goes_on = F.col("_kind").isNull() & F.col("line").rlike(r"^\s*\p{Ll}") & F.coalesce((text_or_empty(F.col("_prev")) != "") & ~F.col("_prev").rlike(r"[.!?:]\s*$"), F.lit(False))
    rows = rows.withColumn("_on", goes_on).withColumn("_run", F.sum((~F.col("_on")).cast("int")).over(above))
    run = Window.partitionBy("machine", "section", "_run").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_kind", F.coalesce("_kind", F.when(F.col("_on"), F.first("_kind").over(run))))
    text = F.regexp_replace(F.trim("line"), r"^(?:[*\-]|\d+[)\].]|[\[(]\d+[\])])\s+", "")
    items = rows.where("_kind is not null").groupBy("machine", "section", "_run").agg(F.min("line_no").alias("at"), F.first("_kind").alias("kind"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", text.alias("t")))), lambda x: x["t"]), " ").alias("item"))
    starts = rows.where(~F.col("_on")).withColumn("_new", F.coalesce(F.col("_kind") != F.lag("_kind").over(order), F.lit(True)))
    starts = starts.withColumn("island", F.sum(F.col("_new").cast("int")).over(above)).select("machine", "section", F.col("line_no").alias("at"), "island")
    both = items.join(starts, ["machine", "section", "at"])
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"])
    return both.groupBy("machine", "section", "kind", "island").agg(F.min("at").alias("first_line"), listed.alias("items")).select("machine", "section", "first_line", "kind", "items")


def suspect_hard_wraps(blocks: DataFrame) -> DataFrame:
    """``blocks`` (machine, section, block_index, type, first_line, last_line) with hard_wrap: paragraphs on adjacent lines."""
    order = Window.partitionBy("machine", "section").orderBy("block_index")
    para = F.col("type") == "paragraph"
    before = para & (F.lag("type").over(order) == "paragraph") & (F.lag("last_line").over(order) + 1 == F.col("first_line"))
    after = para & (F.lead("type").over(order) == "paragraph") & (F.col("last_line") + 1 == F.lead("first_line").over(order))
    return blocks.withColumn("hard_wrap", F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)))


def attach_preambles(blocks: DataFrame) -> DataFrame:
    """``blocks`` with preamble_target (block index of the list after a paragraph that ends in a colon) and preamble_text."""
    order = Window.partitionBy("machine", "section").orderBy("block_index")
    lists = lambda c: c.isin("bullet_list", "numbered_list")
    opens = (F.col("type") == "paragraph") & F.rtrim("text").endswith(":")
    target = F.when(opens & lists(F.lead("type").over(order)), F.lead("block_index").over(order))
    text = F.when(lists(F.col("type")) & (F.lag("type").over(order) == "paragraph") & F.rtrim(F.lag("text").over(order)).endswith(":"), F.lag("text").over(order))
    return blocks.withColumn("preamble_target", target).withColumn("preamble_text", text)


#: A named topic of at most 60 characters and 9 words, emphasised staff lines, and pairs.
TOPIC = r"^\s*\*\s+([^:]{1,60}?)\s*:\s+(\S.*)$"
STAFF_PAIR, STAFF_HEADING = r"^\s*\*([^*\n]+)\*\s*:\s*(\S.*)$", r"^\s*\*([^*\n]+)\*\s*$"
PAIR_COLON, PAIR_DASH = r"^\s*([^:]{1,100}?)\s*:\s+(\S.*\S|\S)\s*$", r"^\s*([^-]{1,100}?)\s+-\s+(\S.*\S|\S)\s*$"
LIST_KINDS = ["bullet_list", "numbered_list"]
SECTION = ["machine", "section"]
#: Lines that a task sorts, about. Lines of articles compress so well that AQE, which goes by bytes, packs millions together.
TASK_LINES = 100_000


def tasks_for(lines: DataFrame) -> int:
    """Tasks for a shuffle of ``lines``, by their counted number; a number told to ``repartition`` stays as it is."""
    return max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), lines.count() // TASK_LINES + 1)


def words(c: Column) -> Column:
    return F.size(F.split(F.trim(c), r"\s+"))


def topic_lines(flagged: DataFrame) -> DataFrame:
    """(machine, section, line_no, topic, described): lines that head a named topic, and tips lines that describe one.

    Lines fall into groups between blank lines. A group is a topic if its first line is one; in overviews also if the
    second line has no structure, in tips if no later line is a bullet or a rule. Topics count in runs of two groups
    or more; in overviews the run follows a group that ends in a colon, and ends after a group with structure.
    """
    w = Window.partitionBy(*SECTION).orderBy("line_no")
    tag = F.lower("section")
    rows = flagged.where(tag.isin("overview", "tips and tricks")).withColumn("_start", ~F.col("blank") & F.coalesce(F.lag("blank").over(w), F.lit(True)))
    rows = rows.withColumn("_g", F.sum(F.col("_start").cast("int")).over(w)).where(~F.col("blank"))
    g = Window.partitionBy(*SECTION, "_g").orderBy("line_no")
    rows = rows.withColumn("_n", F.row_number().over(g))
    first = F.col("_n") == 1
    topic = F.col("line").rlike(TOPIC) & (words(F.regexp_extract("line", TOPIC, 1)) <= 9)
    groups = rows.groupBy(*SECTION, "_g").agg(
        F.bool_or(first & topic).alias("topic"),
        F.coalesce(F.bool_or((F.col("_n") == 2) & ~F.col("structural")), F.lit(False)).alias("described"),
        F.bool_or(~first & F.col("structural")).alias("broken"),
        F.bool_or(~first & (F.col("bullet") | F.col("hyphens"))).alias("listed"),
        F.max_by("line", "line_no").alias("last"),
    )
    overview = F.lower("section") == "overview"
    groups = groups.withColumn("ok", F.when(overview, F.col("topic") & F.col("described")).otherwise(F.col("topic") & ~F.col("listed")))
    order = Window.partitionBy(*SECTION).orderBy("_g")
    text = F.trim("last")
    groups = groups.withColumn("_intro", text.endswith(":") & ~text.rlike(r"^[*\-]")).withColumn("_led", F.coalesce(F.lag("_intro").over(order), F.lit(False)))
    goes_on = F.col("ok") & F.coalesce(F.lag("ok").over(order), F.lit(False)) & (~overview | ~F.coalesce(F.lag("broken").over(order), F.lit(True)))
    groups = groups.withColumn("_run", F.sum((~goes_on).cast("int")).over(order))
    run = Window.partitionBy(*SECTION, "_run")
    since = F.min(F.when(F.col("_led") | ~overview, F.col("_g"))).over(run)
    groups = groups.withColumn("_in", F.col("ok") & (F.col("_g") >= since))
    groups = groups.withColumn("_size", F.count_if("_in").over(run))
    chosen = groups.where(F.col("_in") & (F.col("_size") >= 2)).select(*SECTION, "_g")
    tips = F.lower("section") == "tips and tricks"
    described = tips & ~first & ~F.col("numbered") & ~F.col("structural")
    return rows.join(chosen, [*SECTION, "_g"]).select(*SECTION, "line_no", first.alias("topic"), described.alias("described")).where("topic or described")


def line_kinds(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """``lines`` (machine, section, line_no, line) with kind and detector: the first rule that a line meets.

    ``tasks`` are those of its shuffles (``tasks_for``), if told.

    Rules look at a line, its section and its neighbours only: rules and blanks, topics, staff emphasis, headings,
    section-specific headings, bullets, numbers, pairs (block mode, not in tips), items that go on, paragraphs.
    """
    w = Window.partitionBy(*SECTION).orderBy("line_no")
    whole = Window.partitionBy(*SECTION)
    tag = F.lower(F.trim("section"))
    spread = lambda df, *by: df.repartition(tasks, *by) if tasks else df
    line = [*SECTION, "line_no"]
    rows = line_flags(spread(lines, "machine"))
    rows = spread(spread(rows, *line).join(spread(topic_lines(rows), *line), line, "left"), "machine").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("topic", "described")})
    heuristic = tag.isin(HEURISTIC) & ~F.bool_or("structural").over(whole) & (F.count_if(~F.col("blank")).over(whole) > 1)
    rows = rows.withColumn("per_line", tag.isin(PER_LINE) | heuristic)
    t = F.coalesce(F.col("line"), F.lit(""))
    nxt, after = F.coalesce(F.lead("line").over(w), F.lit("")), F.coalesce(F.lead("line", 2).over(w), F.lit(""))
    star = t.rlike(r"^\s*\*\s+\S")
    pair = lambda c: c.rlike(PAIR_COLON) | c.rlike(PAIR_DASH)
    title = F.trim(F.regexp_replace(t, r"^\s*\*\s+", ""))
    plain_next = (F.trim(nxt) != "") & ~nxt.rlike(r"^\s*[*\-]") & ~nxt.rlike(r"^\s*(?:\d+[)\].]|[\[(]\d+[\])])\s+\S")
    # the description under a title ends at the next blank line, or at the section's end; a listed line before that spoils it
    stop = F.when(F.col("blank"), "blank").when(F.col("bullet") | F.col("numbered") | F.col("hyphens") | t.rlike(r"^\s*[*\-]"), "list")
    ahead = Window.partitionBy(*SECTION).orderBy("line_no").rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("_stop", stop).withColumn("_ends", F.coalesce(F.first("_stop", True).over(ahead), F.lit("blank")))
    alone = F.coalesce(F.lag("blank").over(w), F.lit(True)) & (F.length(title) <= 60) & (words(title) <= 9) & plain_next & (F.length(F.trim(nxt)) > F.length(title)) & (F.col("_ends") == "blank")
    rule = [
        ("break", F.col("blank") | F.col("hyphens")),
        ("topic", F.col("topic") & (tag == "tips and tricks")),
        ("staff_pair", (tag == "staff") & t.rlike(STAFF_PAIR)),
        ("staff_heading", (tag == "staff") & t.rlike(STAFF_HEADING)),
        ("star_colon", F.col("subheading")),
        ("near_miss", F.col("banner")),
        ("caps", F.trim(t).rlike(r"^[A-Z0-9][A-Z0-9 \-&'/]+:?$")),
        ("updates_heading", (tag == "updates") & star & nxt.rlike(r"^\s*-\s+\S")),
        ("scoring_heading", (tag == "scoring") & star & ~F.rtrim(t).endswith(":") & pair(nxt) & pair(after)),
        ("topic", F.col("topic") & (tag == "overview")),
        ("overview_heading", (tag == "overview") & star & alone),
        ("bullet_list", F.col("bullet")),
        ("numbered_list", F.col("numbered")),
        ("pair", ~F.col("per_line") & (tag != "tips and tricks") & pair(t)),
    ]
    kind = F.when(rule[0][1], rule[0][0])
    for name, condition in rule[1:]:
        kind = kind.when(condition, name)
    rows = rows.withColumn("kind", kind.otherwise(F.when(F.col("described"), "described").when(F.col("per_line"), "line").otherwise("paragraph")))
    loose = F.col("kind").isin("described", "line", "paragraph")
    prev = F.coalesce(F.lag("line").over(w), F.lit(""))
    lower = loose & t.rlike(r"^\s*\p{Ll}") & ~prev.rlike(r"[.!?:]\s*$") & (F.trim(prev) != "")
    rows = rows.withColumn("_low", lower).withColumn("_run", F.sum((~F.col("_low")).cast("int")).over(w))
    run = Window.partitionBy(*SECTION, "_run").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_on", F.col("_low") & (F.first("kind").over(run) == "bullet_list"))
    item = (F.lag("kind").over(w) == "bullet_list") | F.coalesce(F.lag("_on").over(w), F.lit(False))
    told = (tag == "scoring") & loose & item & (F.lead("kind").over(w) == "bullet_list") & ~F.col("structural") & ~F.rtrim(t).endswith(":")
    rows = rows.withColumn("joined", F.when(F.coalesce(told, F.lit(False)), "\n").when(F.col("_on"), " "))
    return rows.withColumn("kind", F.when(F.col("joined").isNotNull(), "bullet_list").otherwise(F.col("kind")))


def text_blocks(lines: DataFrame, tasks: int | None = None) -> DataFrame:
    """(machine, section, block_index, type, text, items, label, value, first_line, last_line, text_hash).

    Blocks are islands of ``line_kinds``: list lines of one kind and, in block mode, lines of a paragraph; every other
    kind is a block of its own, a topic two (its title and its text). Items keep their continuations.
    """
    w = Window.partitionBy(*SECTION).orderBy("line_no")
    rows = line_kinds(lines, tasks or tasks_for(lines))
    merges = F.col("kind").isin(*LIST_KINDS, "paragraph") & (F.col("kind") == F.lag("kind").over(w))
    rows = rows.withColumn("_new", ~F.coalesce(merges, F.lit(False))).withColumn("_b", F.sum(F.col("_new").cast("int")).over(w)).where("kind <> 'break'")
    t = F.trim("line")
    bare = F.regexp_replace(t, r"^(?:[*\-]|\d+[)\].]|[\[(]\d+[\])])\s+", "")
    rows = rows.withColumn("_text", F.when(F.col("joined").isNull() & F.col("kind").isin(LIST_KINDS), bare).when(F.col("kind") == "paragraph", F.col("line")).otherwise(t))
    put = F.struct("line_no", F.coalesce("joined", F.when(F.col("kind") == "paragraph", F.lit("\n")), F.lit("\x1f")).alias("sep"), F.col("_text").alias("text"))
    got = rows.groupBy(*SECTION, "_b").agg(F.first("kind").alias("kind"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.array_sort(F.collect_list(put)).alias("parts"))
    body = F.aggregate("parts", F.lit(""), lambda acc, p: F.when(acc == "", p["text"]).otherwise(F.concat(acc, p["sep"], p["text"])))
    got = got.withColumn("body", F.trim(body))
    staff, colon, dash, topic = (lambda n, p=p: F.trim(F.regexp_extract("body", p, n)) for p in (STAFF_PAIR, PAIR_COLON, PAIR_DASH, TOPIC))
    side = lambda n: F.when(F.col("kind") == "staff_pair", staff(n)).when(F.col("kind") == "pair", F.when(F.col("body").rlike(PAIR_COLON), colon(n)).otherwise(dash(n)))
    heading = F.when(F.col("kind") == "staff_heading", F.trim(F.regexp_extract("body", STAFF_HEADING, 1))).when(F.col("kind") == "near_miss", F.trim(F.regexp_replace("body", r"^-\s*|\s*-$", ""))).when(F.col("kind") == "caps", F.col("body")).otherwise(F.regexp_replace("body", r"^\*\s+", ""))
    told = topic(2)
    capital = F.concat(F.upper(F.substring(told, 1, 1)), F.substring(told, F.lit(2), F.length(told)))
    one = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    heads = F.col("kind").isin("staff_heading", "star_colon", "near_miss", "caps", "updates_heading", "scoring_heading", "overview_heading")
    none = F.lit(None).cast("string")
    shape = (
        F.when(F.col("kind") == "topic", F.array(one("subheading", topic(1)), one("paragraph", capital)))
        .when(heads, F.array(one("subheading", heading)))
        .when(F.col("kind").isin("staff_pair", "pair"), F.array(one("pair", none)))
        .when(F.col("kind") == "bullet_list", F.array(one("bullet_list", none)))
        .when(F.col("kind") == "numbered_list", F.array(one("numbered_list", none)))
        .otherwise(F.array(one("paragraph", F.col("body"))))
    )
    items = F.when(F.col("kind").isin(LIST_KINDS), F.split("body", "\x1f"))
    out = got.select(*SECTION, "_b", "kind", "first_line", "last_line", items.alias("items"), side(1).alias("label"), side(2).alias("value"), F.posexplode(shape).alias("_p", "_x"))
    shown = F.coalesce(F.col("_x.text"), F.array_join("items", "\n"), F.concat("label", F.lit(": "), "value"))
    index = F.row_number().over(Window.partitionBy(*SECTION).orderBy("_b", "_p")) - 1
    return out.select(*SECTION, index.alias("block_index"), "_x.type", "_x.text", "items", "label", "value", F.col("kind").alias("detector"), "first_line", "last_line", F.substring(F.sha1(shown), 1, 8).alias("text_hash"))


def promote_preambles(blocks: DataFrame) -> DataFrame:
    """``blocks`` in which the paragraphs on the lines right after one that ends in a colon are one bullet list.

    Runs of adjacent paragraphs are islands; the first paragraph of one that ends in a colon opens, all after it in
    the run are items, colons or not.
    """
    w = Window.partitionBy(*SECTION).orderBy("block_index")
    para = F.col("type") == "paragraph"
    adjacent = para & (F.lag("type").over(w) == "paragraph") & (F.lag("last_line").over(w) + 1 == F.col("first_line"))
    rows = blocks.withColumn("_run", F.sum((~F.coalesce(adjacent, F.lit(False))).cast("int")).over(w))
    run = Window.partitionBy(*SECTION, "_run")
    rows = rows.withColumn("_open", F.min(F.when(para & F.rtrim("text").endswith(":"), F.col("block_index"))).over(run))
    item = para & F.coalesce(F.col("block_index") > F.col("_open"), F.lit(False))
    rows = rows.withColumn("_item", item)
    got = rows.where("_item").groupBy(*SECTION, "_run").agg(
        F.min("block_index").alias("block_index"),
        F.transform(F.array_sort(F.collect_list(F.struct("block_index", "text"))), lambda x: x["text"]).alias("items"),
        F.min("first_line").alias("first_line"),
        F.max("last_line").alias("last_line"),
    )
    made = got.select(*SECTION, "block_index", F.lit("bullet_list").alias("type"), F.lit(None).cast("string").alias("text"), "items", F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("value"), F.lit("preamble_promoted_bullets").alias("detector"), "first_line", "last_line", F.substring(F.sha1(F.array_join("items", "\n")), 1, 8).alias("text_hash"))
    both = rows.where(~F.col("_item")).select(made.columns).unionByName(made)
    return both.withColumn("block_index", F.row_number().over(w) - 1)


def block_contract(blocks: DataFrame) -> DataFrame:
    """Blocks with what their type allows: no empty paragraphs or lists, no pair without both sides."""
    filled = {"paragraph": F.coalesce("text", F.lit("")) != "", "subheading": F.col("text").isNotNull(), "pair": F.col("label").isNotNull() & F.col("value").isNotNull()}
    ok = F.col("type").isin(LIST_KINDS) & (F.coalesce(F.size("items"), F.lit(0)) > 0)
    for kind, good in filled.items():
        ok = ok | ((F.col("type") == kind) & good)
    only = lambda c, *kinds: F.when(F.col("type").isin(*kinds), F.col(c)).alias(c)
    rest = [c for c in blocks.columns if c not in ("text", "items", "label", "value")]
    return blocks.where(ok).select(*rest, only("text", "paragraph", "subheading"), only("items", *LIST_KINDS), only("label", "pair"), only("value", "pair"))


def article_blocks(lines: DataFrame) -> DataFrame:
    """Blocks of articles (machine, line_no, line): sections, suppressed lines, paragraph breaks, blocks, preambles.

    Sections PORTS and CONTRIBUTE are left out; text before the first heading is the overview.
    """
    from .articles import clean_line, sections_from_lines, suppress_lines

    tasks = tasks_for(lines)
    rows = sections_from_lines(lines).withColumn("line", clean_line(F.col("line")))
    rows = rows.where(~F.col("section").isin("PORTS", "CONTRIBUTE")).withColumn("section", F.when(F.col("section") == "OPENING", "OVERVIEW").otherwise(F.col("section")))
    kept = suppress_lines(rows).where("kept")
    each = kept.select("machine", "section", "line_no", F.posexplode(F.when(F.col("gap_before"), F.array(F.lit(""), F.col("line"))).otherwise(F.array("line"))).alias("_p", "line"))
    place = F.row_number().over(Window.partitionBy("machine", "section").orderBy("line_no", "_p")) - 1
    return attach_preambles(promote_preambles(block_contract(text_blocks(each.select("machine", "section", place.alias("line_no"), "line"), tasks))))

"""Descriptions to titles, subtitles and versions; page names, redirects and their conflicts.

Brackets are followed by one fold over a text, cut at the characters that mean something: outside all brackets, separators
and bracket groups become control characters (``marked``), and plain array functions do the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import collapse_whitespace, empty_to_null, fold, infix_brackets, pieces, strip, text_or_empty, unbalanced

#: Control characters for a split between units, and for the ends of a bracket group; other text gives way to them.
UNIT, OPEN, SHUT = "\x1d", "\x1e", "\x1f"
EDGE = r"^[\s\-:,/;()\[\]]+|[\s\-:,/;()\[\]]+$"


def split_top_level(c: Column, delimiter: str) -> Column:
    """Parts between delimiters outside all brackets; a closing bracket too many closes nothing."""
    begin = F.struct(F.lit(0).alias("r"), F.lit(0).alias("s"), F.lit("").alias("out"))

    def step(acc: Column, ch: Column) -> Column:
        r = F.when(ch == "(", acc["r"] + 1).when(ch == ")", F.greatest(F.lit(0), acc["r"] - 1)).otherwise(acc["r"])
        s = F.when(ch == "[", acc["s"] + 1).when(ch == "]", F.greatest(F.lit(0), acc["s"] - 1)).otherwise(acc["s"])
        inside = (acc["r"] > 0) | (acc["s"] > 0)
        put = F.when(inside & (ch == UNIT), F.lit(delimiter)).otherwise(ch)
        return F.struct(r.alias("r"), s.alias("s"), F.concat(acc["out"], put).alias("out"))

    def parts(text: Column) -> Column:
        folded = F.aggregate(pieces(text, "()[]" + UNIT), begin, step, lambda acc: acc["out"])
        return F.when(F.contains(text, F.lit(UNIT)), F.split(folded, UNIT, -1)).otherwise(F.array(text))

    # a lambda's variable is computed once
    return F.get(F.transform(F.array(F.replace(F.coalesce(c, F.lit("")), F.lit(delimiter), F.lit(UNIT))), parts), F.lit(0))


def marked(unit: Column) -> Column:
    """``unit`` with the outermost brackets of each group as OPEN and SHUT; an open group ends at the end, without its
    last character, as the end counts as its bracket."""
    begin = F.struct(F.lit(0).alias("r"), F.lit(0).alias("s"), F.lit("").alias("out"))

    def step(acc: Column, ch: Column) -> Column:
        outside = (acc["r"] == 0) & (acc["s"] == 0)
        starts = outside & ch.isin("(", "[")
        r = F.when(ch == "(", acc["r"] + 1).when((ch == ")") & ~outside, acc["r"] - 1).otherwise(acc["r"])
        s = F.when(ch == "[", acc["s"] + 1).when((ch == "]") & ~outside, acc["s"] - 1).otherwise(acc["s"])
        ends = ~outside & (r <= 0) & (s <= 0)
        put = F.when(starts, F.lit(OPEN)).when(ends, F.lit(SHUT)).otherwise(ch)
        keep = F.when(ends, F.lit(0))
        return F.struct(F.coalesce(keep, r).alias("r"), F.coalesce(keep, s).alias("s"), F.concat(acc["out"], put).alias("out"))

    def end(acc: Column) -> Column:
        still = (acc["r"] > 0) | (acc["s"] > 0)
        return F.when(still, F.concat(F.substring(acc["out"], F.lit(1), F.length(acc["out"]) - 1), F.lit(SHUT))).otherwise(acc["out"])

    return F.when(unit.rlike(r"[(\[]"), F.aggregate(pieces(unit, "()[]"), begin, step, end)).otherwise(unit)


def inner_separators(group: Column) -> Column:
    """A group's text with ' - ' and ' / ' outside inner brackets as commas."""
    joined = F.array_join(split_top_level(group, " - "), ", ")
    return F.array_join(split_top_level(joined, " / "), ", ")


def parse_unit(both: Column) -> Column:
    """struct(title, subtitle, groups, outside): of one unit of a description, given as struct(unit, text: ``marked``).

    The head ends at the first group that starts the unit or follows white space; its first ' - ' or ':' separates
    the subtitle. Text between and after the groups is outside.
    """
    unit, text = both["unit"], both["text"]
    cut = F.regexp_instr(text, F.lit(rf"(^|\s){OPEN}"))
    length = F.when(F.substring(text, F.lit(1), F.lit(1)) == OPEN, F.lit(0)).otherwise(cut)  # marks keep places
    head = F.when(cut > 0, F.substring(unit, F.lit(1), length)).otherwise(unit)
    at = F.regexp_instr(head, F.lit(" - |:"))
    width = F.when(F.substring(head, at, F.lit(1)) == ":", 1).otherwise(3)
    title = F.when(at > 0, F.substring(head, F.lit(1), at - 1)).otherwise(head)
    subtitle = F.when(at > 0, F.substring(head, at + width, F.length(head))).otherwise("")
    groups = F.transform(F.regexp_extract_all(text, F.lit(f"{OPEN}([^{SHUT}]*){SHUT}"), F.lit(1)), lambda g: strip(inner_separators(g)))
    rest = F.regexp_replace(text, f"^[^{OPEN}]*", "")
    outside = F.when(cut > 0, F.filter(F.transform(F.split(rest, f"{OPEN}[^{SHUT}]*{SHUT}", -1), lambda t: collapse_whitespace(F.regexp_replace(t, EDGE, ""))), lambda t: t != ""))
    return F.struct(strip(title).alias("title"), strip(subtitle).alias("subtitle"), groups.alias("groups"), F.coalesce(outside, F.array().cast("array<string>")).alias("outside"))


def parse_titles(rows: DataFrame, description: str = "description") -> DataFrame:
    """``rows`` with units (title, subtitle, version, groups, outside) and global_version.

    A description has units between ' / ' outside brackets. One group in all is the global version, with the text
    outside the groups of its unit; else each unit's first group is its version and all else goes into the global.
    """
    clean = F.translate(F.coalesce(F.col(description), F.lit("")), UNIT + OPEN + SHUT, "   ")
    # a lambda's variable is computed once, where a column used twice in one expression may not be
    pairs = F.transform(split_top_level(clean, " / "), lambda u: F.struct(u.alias("unit"), marked(u).alias("text")))
    out = rows.withColumn("_units", F.transform(pairs, parse_unit))
    total = F.aggregate("_units", F.lit(0), lambda acc, u: acc + F.size(u["groups"]))
    whole = F.flatten(F.transform("_units", lambda u: F.when(F.size(u["groups"]) > 0, F.concat(u["groups"], u["outside"])).otherwise(F.array().cast("array<string>"))))
    parts = F.flatten(F.transform("_units", lambda u: F.concat(F.when(F.size(u["groups"]) > 1, F.slice(u["groups"], F.lit(2), F.size(u["groups"]))).otherwise(F.array().cast("array<string>")), u["outside"])))
    version = lambda u: F.when((total != 1) & (F.size(u["groups"]) > 0), F.get(u["groups"], F.lit(0))).otherwise("")
    units = F.transform("_units", lambda u: F.struct(u["title"].alias("title"), u["subtitle"].alias("subtitle"), version(u).alias("version"), u["groups"].alias("groups"), u["outside"].alias("outside")))
    every = F.when(total == 1, whole).otherwise(parts)
    return out.withColumn("units", units).withColumn("global_version", F.array_join(F.filter(every, lambda t: t != ""), ", ")).drop("_units")


def title_anomalies(parsed: DataFrame, key: str = "machine", description: str = "description") -> DataFrame:
    """(key, anomaly, example): one row for each thing odd about a description."""
    d = F.col(description)
    rules = {
        "unbalanced_round_brackets": unbalanced(d, "(", ")"),
        "unbalanced_square_brackets": unbalanced(d, "[", "]"),
        "infix_brackets_no_spaces": infix_brackets(d),
        "ambiguous_trailing_tokens": F.exists("units", lambda u: F.size(u["outside"]) > 0),
    }
    found = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())), lambda n: n.isNotNull())
    return parsed.select(key, F.explode(found).alias("anomaly"), F.coalesce(d, F.lit("")).alias("example"))


def title_anomaly_counts(*anomalies: DataFrame) -> DataFrame:
    """(anomaly, n, distinct_examples): anomalies of titles, before and after overrides say; what a machine has both times
    counts once."""
    every = reduce(DataFrame.unionByName, (df.select("machine", "anomaly", "example") for df in anomalies)).distinct()
    return every.groupBy("anomaly").agg(F.count("*").alias("n"), F.count_distinct("example").alias("distinct_examples"))


def page_name(units: Column) -> Column:
    """Title: Subtitle, or Title, of the first unit."""
    first = F.get(units, F.lit(0))
    title, subtitle = strip(first["title"]), strip(first["subtitle"])
    return F.when(subtitle == "", title).otherwise(F.concat(title, F.lit(": "), subtitle))


def redirect_names(parsed: DataFrame, key: str = "machine") -> DataFrame:
    """(key, pos, name): other names that lead to a page: titles of later units with and without subtitles, then the
    bare first title; without the page itself, each once regardless of case."""
    page = page_name(F.col("units"))
    later = F.flatten(F.transform(F.slice("units", F.lit(2), F.size("units")), lambda u: F.when(u["title"] == "", F.array().cast("array<string>")).otherwise(F.array(u["title"], F.when(u["subtitle"] != "", F.concat(u["title"], F.lit(": "), u["subtitle"]))))))
    first = F.get("units", F.lit(0))
    bare = F.when((first["title"] != "") & (first["subtitle"] != ""), F.array(first["title"])).otherwise(F.array().cast("array<string>"))
    names = parsed.select(key, page.alias("page"), F.posexplode(F.concat(later, bare)).alias("pos", "name")).withColumn("name", collapse_whitespace(F.col("name")))
    return first_seen(names.where((F.col("name") != "") & (fold(F.col("name")) != fold(F.col("page")))), [key], "name", "pos").select(key, "pos", "name")


def first_seen(rows: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """The first row of each value regardless of case, within keys."""
    rank = F.row_number().over(Window.partitionBy(*keys, fold(F.col(value))).orderBy(pos))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def page_collisions(pages: DataFrame) -> DataFrame:
    """(page, machines): pages that more than one machine claims."""
    return pages.groupBy("page").agg(F.array_sort(F.collect_set("machine")).alias("machines")).where(F.size("machines") > 1)


def redirect_page_collisions(redirects: DataFrame, pages: DataFrame) -> DataFrame:
    """(name, owners, candidates): redirect names that are pages of other records, regardless of case."""
    owners = pages.groupBy(fold(F.col("page")).alias("key")).agg(F.array_sort(F.collect_set("machine")).alias("owners"))
    own = redirects.join(pages.select("machine", F.col("page").alias("target")), "machine").withColumn("key", fold(F.col("name")))
    met = own.where(F.col("key") != fold(F.col("target"))).join(owners, "key")
    return met.groupBy("key").agg(F.min("name").alias("name"), F.first("owners").alias("owners"), F.array_sort(F.collect_set(F.struct("machine", "target"))).alias("candidates")).drop("key")


def resolve_redirects(redirects: DataFrame, pages: DataFrame) -> DataFrame:
    """(name, target, targets): redirects that are no page's name; the first claim, by machine and position, gives the
    target; more than one in targets is a conflict."""
    own = redirects.join(pages.select("machine", F.col("page").alias("target")), "machine").withColumn("key", fold(F.col("name")))
    free = own.join(pages.select(fold(F.col("page")).alias("key")), "key", "left_anti")
    first = F.min(F.struct("machine", "pos", "name", "target")).alias("first")
    return free.groupBy("key").agg(first, F.array_sort(F.collect_set("target")).alias("targets")).select("first.name", "first.target", "targets")


def apply_overrides(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """``rows`` with final, eligible, applied and reason: a title is replaced if its override says so.

    Overrides (machine, new_description, only_if_unbalanced, note) apply to titles with unbalanced brackets, or to
    any where that condition is off; a blank new title is eligible but not applied.
    """
    d = F.coalesce(F.col("description"), F.lit(""))
    met = F.col("new_description").isNotNull() & (~F.coalesce("only_if_unbalanced", F.lit(True)) | unbalanced(d, "(", ")") | unbalanced(d, "[", "]"))
    out = rows.join(overrides, "machine", "left").withColumn("eligible", F.coalesce(met, F.lit(False)))
    out = out.withColumn("applied", F.col("eligible") & (text_or_empty(F.col("new_description")) != ""))
    final = F.when(F.col("applied"), strip(F.col("new_description"))).otherwise(F.col("description"))
    reason = F.when(F.col("applied"), F.coalesce(empty_to_null(F.col("note")), F.lit("override")))
    return out.select(*rows.columns, final.alias("final"), "eligible", "applied", reason.alias("reason"))


def family_titles(machines: DataFrame) -> DataFrame:
    """(parent, machine, role, title, year, place): titles of a family, the parent first, variants by folded title."""
    from .lineage import family

    title = F.coalesce(empty_to_null(F.col("description")), F.col("machine"))
    rows = family(machines).join(machines.select(F.col("name").alias("machine"), "description", "year"), "machine", "left").withColumn("title", title)
    order = Window.partitionBy("parent").orderBy(F.col("role") == "clone", fold(F.col("title")), "machine")
    return rows.select("parent", "machine", "role", "title", "year", F.row_number().over(order).alias("place"))

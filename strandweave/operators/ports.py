"""Port rows: validity, merging over families, duplicates, display order and text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import loose_date_sort_key
from ..functions.text import strip, text_or_empty
from .lineage import family

#: The columns that make two port rows the same.
PORT_KEY = ["regions", "platform", "title", "date", "publisher", "tags", "model", "comment"]

#: Fixed value: the text that tells the machine which a port row comes from.
BASED_ON = "This GH port entry is based on the MAME %s %s."


def cleaned(c: Column) -> Column:
    """Trimmed, non-empty entries of an array."""
    return F.filter(F.transform(c, strip), lambda x: x != "")


def valid_ports(ports: DataFrame) -> DataFrame:
    """Rows with a platform; no region becomes ??, regions and tags are trimmed."""
    none = F.array().cast("array<string>")
    kept = ports.where(text_or_empty(F.col("platform")) != "")
    kept = kept.withColumns({c: cleaned(F.coalesce(c, none)) for c in ("regions", "tags")})
    return kept.withColumn("regions", F.when(F.size("regions") > 0, F.col("regions")).otherwise(F.array(F.lit("??"))))


def merge_ports(ports: DataFrame, machines: DataFrame) -> DataFrame:
    """Valid port rows of each parent and its variants: parent, role and the row (machine is its source)."""
    return valid_ports(ports).join(family(machines), "machine")


def source_ids(merged: DataFrame) -> DataFrame:
    """(parent, source_ids): distinct ids of the articles that a family's port rows come from, sorted."""
    return merged.groupBy("parent").agg(F.array_sort(F.collect_set("source_id")).alias("source_ids"))


def port_key() -> Column:
    """A row's identity: all that is told of a port, trimmed; nulls count as empty."""
    one = lambda c: F.array_join(F.transform(c, strip), "\x1f") if c in ("regions", "tags", "model") else text_or_empty(F.col(c))
    return F.concat_ws("\x1e", *(F.coalesce(one(c), F.lit("")) for c in PORT_KEY))


def duplicate_families(merged: DataFrame) -> DataFrame:
    """Parents with a port row that a variant repeats in the same category. One grouping, no join: a key that both
    roles have is a duplicate."""
    keyed = merged.select("parent", "category", "role", port_key().alias("key"))
    both = keyed.groupBy("parent", "category", "key").agg(F.count_distinct("role").alias("roles")).where("roles = 2")
    return both.select("parent").distinct()


def display_order(merged: DataFrame) -> DataFrame:
    """``merged`` with place (1 is first) and mixed, within parent and category.

    Undated rows come first, then by loose date; ties keep the order of sources: the parent, then variants by name,
    rows in their order. ``mixed`` says that parent and variant rows share the category.
    """
    group = Window.partitionBy("parent", "category")
    dated = text_or_empty(F.col("date")) != ""
    when = F.when(dated, loose_date_sort_key(F.col("date")))
    number = F.coalesce(when["year"] * 10_000 + when["month"] * 100 + when["day"], F.lit(-1))  # undated: before all dates
    keyed = merged.withColumn("_date", number).withColumn("_clone", F.col("role") == "clone")
    order = group.orderBy("_date", "_clone", "machine", "row_no", "platform", "title", "comment", "publisher")
    mixed = F.min("role").over(group) != F.max("role").over(group)
    return keyed.withColumn("place", F.row_number().over(order)).withColumn("mixed", mixed).drop("_date", "_clone")


def port_line(mixed: Column | None = None) -> Column:
    """[JP][US] Platform [tags] "Title [models]" (date) by Publisher : comment

    In a mixed category the comment tells the machine that the row is based on.
    """
    bracket = lambda c: F.when(F.size(cleaned(c)) > 0, F.concat(F.lit("["), F.array_join(cleaned(c), ", "), F.lit("]"))).otherwise("")
    regions = F.array_join(F.transform(F.col("regions"), lambda r: F.concat(F.lit("["), r, F.lit("]"))), "")
    tags, model = bracket(F.col("tags")), bracket(F.col("model"))
    platform = F.concat(text_or_empty(F.col("platform")), F.when(tags == "", "").otherwise(F.concat(F.lit(" "), tags)))
    title, date, publisher = (text_or_empty(F.col(c)) for c in ("title", "date", "publisher"))
    safe = F.replace(title, F.lit('"'), F.lit('\\"'))
    named = F.when(title == "", strip(F.concat_ws(" ", platform, model))).otherwise(F.concat(platform, F.lit(' "'), safe, F.when(model == "", "").otherwise(F.concat(F.lit(" "), model)), F.lit('"')))
    some = lambda c, shape: F.when(c != "", F.format_string(shape, c))
    left = F.concat_ws(" ", F.nullif(regions, F.lit("")), F.nullif(named, F.lit("")), some(date, "(%s)"), some(publisher, "by %s"))
    comment = text_or_empty(F.col("comment"))
    if mixed is not None:
        told = F.format_string(BASED_ON, F.col("role"), F.col("machine"))
        end = F.when(comment == "", told).when(comment.rlike("[.!?…]$"), F.concat_ws(" ", comment, told)).otherwise(F.concat(comment, F.lit(". "), told))
        comment = F.when(mixed, end).otherwise(comment)
    return F.when(comment == "", left).otherwise(F.concat(left, F.lit(" : "), comment))


def ports_display(merged: DataFrame) -> DataFrame:
    """(parent, category, lines): the ordered lines of each category of a family."""
    rows = display_order(merged).select("parent", "category", "place", port_line(F.col("mixed")).alias("line"))
    listed = rows.groupBy("parent", "category").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("rows"))
    return listed.select("parent", "category", F.transform("rows", lambda r: r["line"]).alias("lines"))


def ports_telemetry(ports: DataFrame, machines: DataFrame, included: DataFrame) -> DataFrame:
    """One row per included parent (column name): port rows of its own and of variants, and how many variants have any."""
    merged = merge_ports(ports, machines)
    own = F.col("role") == "parent"
    per = merged.groupBy(F.col("parent").alias("name")).agg(
        F.count_if(own).alias("own_rows"),
        F.count_if(~own).alias("clone_rows"),
        F.count_distinct(F.when(~own, F.col("machine"))).alias("clones_with_ports"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = included.select("name").join(per, "name", "left").select("name", zero("own_rows"), zero("clone_rows"), zero("clones_with_ports"))
    return out.withColumn("only_via_clones", (F.col("own_rows") == 0) & (F.col("clone_rows") > 0))

"""Comparing releases: records, text sections, findings over time.

Full outer joins on machines, null-safe comparisons of fields, and groupings; no release is held in one place.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def release_diff(before: DataFrame, after: DataFrame, fields: list[str], page: str = "page") -> DataFrame:
    """(machine, status, changed_fields, page_before, page_after, renamed): one row per machine of either release.

    Status is added, withdrawn, modified or unchanged; a new page name alone is a modification.
    """
    b = before.select("machine", F.lit(True).alias("was"), *(F.col(c).alias(f"b_{c}") for c in [*fields, page]))
    a = after.select("machine", F.lit(True).alias("now"), *(F.col(c).alias(f"a_{c}") for c in [*fields, page]))
    both = b.join(a, "machine", "full_outer")
    stays = F.col("was").isNotNull() & F.col("now").isNotNull()
    same = lambda c: F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}"))
    changed = F.filter(F.array(*(F.when(stays & ~same(c), F.lit(c)) for c in sorted(fields))), lambda x: x.isNotNull())
    renamed = stays & ~same(page)
    status = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "withdrawn").when((F.size(changed) > 0) | renamed, "modified").otherwise("unchanged")
    return both.select("machine", status.alias("status"), changed.alias("changed_fields"), F.col(f"b_{page}").alias("page_before"), F.col(f"a_{page}").alias("page_after"), renamed.alias("renamed"))


def diff_counts(diff: DataFrame) -> DataFrame:
    """One row of counts over a release diff."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return diff.agg(n("added"), n("withdrawn"), n("modified"), n("unchanged"), F.count_if("renamed").alias("renamed"))


def affected_titles(diff: DataFrame) -> DataFrame:
    """Distinct page titles, old and new, of machines that changed."""
    pages = diff.where("status <> 'unchanged'").select(F.explode(F.array("page_before", "page_after")).alias("page"))
    return pages.where("page is not null").distinct()


def rendered(blocks: DataFrame) -> DataFrame:
    """(machine, section, content): what is shown of a section: types and texts of its blocks, in order."""
    listed = F.array_sort(F.collect_list(F.struct("block_index", "type", "text")))
    return blocks.groupBy("machine", "section").agg(F.transform(listed, lambda x: F.struct(x["type"], x["text"])).alias("content"))


def section_diff(before: DataFrame, after: DataFrame, continuing: DataFrame) -> DataFrame:
    """(machine, section, state): sections of continuing machines (column machine) whose shown content differs."""
    b = rendered(before).select("machine", "section", F.col("content").alias("was"))
    a = rendered(after).select("machine", "section", F.col("content").alias("now"))
    both = b.join(a, ["machine", "section"], "full_outer").join(continuing.select("machine").distinct(), "machine", "left_semi")
    state = F.when(F.col("was").isNull(), "ADDED").when(F.col("now").isNull(), "REMOVED").otherwise("MODIFIED")
    return both.where(~F.to_json("was").eqNullSafe(F.to_json("now"))).select("machine", "section", state.alias("state"))


def combined_diff(records: DataFrame, sections: DataFrame) -> DataFrame:
    """(machine, record_status, sections, kind): both diffs without double counting; kind is record, text or both."""
    r = records.where("status <> 'unchanged'").select("machine", F.col("status").alias("record_status"))
    s = sections.groupBy("machine").agg(F.array_sort(F.collect_set("section")).alias("sections"))
    kind = F.when(F.col("sections").isNull(), "record").when(F.col("record_status").isNull(), "text").otherwise("both")
    return r.join(s, "machine", "full_outer").select("machine", "record_status", "sections", kind.alias("kind"))


def changed_blocks(before: DataFrame, after: DataFrame) -> DataFrame:
    """(machine, section, state, text): blocks that only one release has; equal blocks are matched by their number."""

    def numbered(df: DataFrame, name: str) -> DataFrame:
        n = F.row_number().over(Window.partitionBy("machine", "section", "type", "text").orderBy("block_index"))
        return df.select("machine", "section", "type", "text", n.alias("n"), F.lit(True).alias(name))

    keys = ["machine", "section", "type", "text", "n"]
    both = numbered(before, "was").join(numbered(after, "now"), keys, "full_outer")
    state = F.when(F.col("was").isNull(), "ADDED").when(F.col("now").isNull(), "REMOVED")
    return both.select("machine", "section", state.alias("state"), "text").where("state is not null")


def changed_span(before: Column, after: Column) -> Column:
    """struct(prefix, before, after): the number of equal characters at the start, and what differs after it and before
    the equal end."""
    shortest = F.least(F.length(before), F.length(after))
    reach = lambda at: F.aggregate(F.sequence(F.lit(1), F.greatest(shortest, F.lit(1))), F.lit(0), lambda acc, i: F.when((acc == i - 1) & (i <= shortest) & at(i), i).otherwise(acc))
    prefix = reach(lambda i: F.substring(before, i, F.lit(1)) == F.substring(after, i, F.lit(1)))
    tail = reach(lambda i: (i <= shortest - prefix) & (F.substring(before, F.length(before) - i + 1, F.lit(1)) == F.substring(after, F.length(after) - i + 1, F.lit(1))))
    middle = lambda t: F.substring(t, prefix + 1, F.length(t) - prefix - tail)
    return F.struct(prefix.alias("prefix"), middle(before).alias("before"), middle(after).alias("after"))


def snippet(text: Column, start: Column, length: Column, context: int = 55) -> Column:
    """The part of ``text`` with ``context`` characters on both sides, ... where more was left out; on one line."""
    left = F.greatest(F.lit(0), start - context)
    right = F.least(F.length(text), start + length + context)
    part = F.replace(F.substring(text, left + 1, right - left), F.lit("\n"), F.lit(" "))
    return F.concat(F.when(left > 0, "...").otherwise(""), part, F.when(right < F.length(text), "...").otherwise(""))


RUNS = "array<struct<i1: int, i2: int, j1: int, j2: int>>"


def changed_runs(before: Column, after: Column) -> Column:
    """Where two sequences (arrays of strings) differ, as RUNS: [i1, i2) of ``before`` stands against [j1, j2) of ``after``.

    The longest run that both have, the first of equally long ones, stays; what lies before it and after it is compared
    in the same way. Null sequences are empty.
    """

    @F.pandas_udf(RUNS)
    def runs(was: pd.Series, now: pd.Series) -> pd.Series:
        def one(a, b) -> list[dict]:
            a, b = ([] if x is None else list(x) for x in (a, b))
            codes = SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
            return [{"i1": i1, "i2": i2, "j1": j1, "j2": j2} for kind, i1, i2, j1, j2 in codes if kind != "equal"]

        return pd.Series([one(a, b) for a, b in zip(was, now, strict=True)])

    return runs(before, after)


def block_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """(machine, section, state, i1, i2, j1, j2): the runs of blocks by which sections differ, state that of the section:
    ADDED, REMOVED or MODIFIED. Blocks are equal if type and text are; other columns do not count.

    Only digests of blocks are gathered, those of a section together: a section is part of one article. Sections that
    are equal, new or gone are told from the digests alone.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        digest = F.md5(F.concat_ws("\0", "type", "text").cast("binary"))
        listed = F.array_sort(F.collect_list(F.struct("block_index", digest.alias("d"))))
        return df.groupBy("machine", "section").agg(F.transform(listed, lambda x: x["d"]).alias(name))

    both = side(before, "was").join(side(after, "now"), ["machine", "section"], "full_outer").where("not (was <=> now)")
    state = F.when(F.col("was").isNull(), "ADDED").when(F.col("now").isNull(), "REMOVED").otherwise("MODIFIED")
    runs = both.select("machine", "section", state.alias("state"), F.explode(changed_runs(F.col("was"), F.col("now"))).alias("run"))
    return runs.select("machine", "section", "state", "run.*")


def changed_block_detail(before: DataFrame, after: DataFrame) -> DataFrame:
    """(machine, section, state, change, type, was_at, now_at, before, after): the blocks by which sections differ.

    Of a run of blocks that stands against another (``block_runs``), the first goes with the first and so on. Two of one
    type are one modified block, of which the changed span is shown with its context; what is left, or of another type,
    is removed or added as a whole. was_at and now_at are places in the section, from 0.
    """

    def placed(df: DataFrame, side: str) -> DataFrame:
        at = F.row_number().over(Window.partitionBy("machine", "section").orderBy("block_index", F.md5(F.concat_ws("\0", "type", "text").cast("binary")))) - 1
        return df.select("machine", "section", at.alias(f"{side}_at"), F.col("type").alias(f"{side}_type"), F.col("text").alias(side))

    runs = block_runs(before, after)
    slot = F.explode(F.sequence(F.lit(0), F.greatest(F.col("i2") - F.col("i1"), F.col("j2") - F.col("j1")) - 1))
    slots = runs.withColumn("k", slot)
    at = lambda lo, hi: F.when(F.col(lo) + F.col("k") < F.col(hi), F.col(lo) + F.col("k"))
    slots = slots.select("machine", "section", "state", at("i1", "i2").alias("was_at"), at("j1", "j2").alias("now_at"))
    rows = slots.join(placed(before, "was"), ["machine", "section", "was_at"], "left").join(placed(after, "now"), ["machine", "section", "now_at"], "left")
    pair = F.col("was_type") == F.col("now_type")
    span = changed_span(F.col("was"), F.col("now"))
    part = lambda side, name: snippet(F.col(side), F.col("span.prefix"), F.length(F.col(f"span.{name}")))
    rows = rows.withColumn("span", F.when(pair, span))
    none, place = F.lit(None).cast("string"), F.lit(None).cast("int")
    entry = lambda change, kind, i, j, b, a: F.struct(F.lit(change).alias("change"), F.col(kind).alias("type"), i.alias("was_at"), j.alias("now_at"), b.alias("before"), a.alias("after"))
    modified = entry("modified", "was_type", F.col("was_at"), F.col("now_at"), part("was", "before"), part("now", "after"))
    removed = F.when(F.col("was_at").isNotNull(), entry("removed", "was_type", F.col("was_at"), place, F.col("was"), none))
    added = F.when(F.col("now_at").isNotNull(), entry("added", "now_type", place, F.col("now_at"), none, F.col("now")))
    shown = F.when(pair, F.array(modified)).otherwise(F.array_compact(F.array(removed, added)))
    return rows.select("machine", "section", "state", F.inline(shown))


def changed_fields(before: DataFrame, after: DataFrame, fields: list[str], most: int = 1800) -> DataFrame:
    """(machine, field, before, after): values of changed fields of machines in both releases, shortened to ``most``
    characters; an absent value is null."""
    tall = lambda df, name: df.select("machine", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias(name)) for c in fields))).alias("x")).select("machine", "x.*")
    both = tall(before, "before").join(tall(after, "after"), ["machine", "field"])
    cut = lambda c: F.substring(c, 1, most).alias(c)
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select("machine", "field", cut("before"), cut("after"))


def carry_forward(current: DataFrame, previous: DataFrame) -> DataFrame:
    """``current`` (path, size, digest) with source_url and acquired_at of ``previous`` where path and digest agree."""
    known = previous.select("path", "digest", "source_url", "acquired_at").dropDuplicates(["path", "digest"])
    return current.join(known, ["path", "digest"], "left")


def acquisition_events(manifest: DataFrame, events: DataFrame) -> DataFrame:
    """(path, provider, digest, outcome): what becomes of each download event: applied, or the rule it breaks."""
    m = manifest.select("path", F.col("provider").alias("m_provider"), F.col("digest").alias("m_digest"), "verified")
    both = events.join(m, "path", "left")
    outcome = (
        F.when(F.col("m_digest").isNull(), "unknown_file")
        .when(~F.coalesce("verified", F.lit(False)), "unverified")
        .when(F.col("provider") != F.col("m_provider"), "provider_mismatch")
        .when(F.col("digest") != F.col("m_digest"), "digest_mismatch")
        .otherwise("applied")
    )
    return both.select("path", "provider", "digest", outcome.alias("outcome"))

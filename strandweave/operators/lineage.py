"""Parents and variants: indexes, selection, classification and as-of lookups.

Machines have a name and, if they are variants, the name of their parent in ``cloneof``; a parent has none.
Joins are on machine names; nothing is broadcast by hint, so Spark chooses by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import empty_to_null, not_available, truthy
from .ordering import member_lists

#: Categories and terms of machine types that are not published.
EXCLUDED_CATEGORIES = ["Casino", "Electromechanical", "Gambling", "Medal Game", "Redemption Game", "Slot Machine"]
EXCLUDED_TYPES = [
    "fruit machine",
    "slot machine",
    "pinball",
    "medal game",
    "redemption game",
    "kiddie ride",
    "pachinko",
    "bowler",
    "dart game",
    "air hockey",
    "strength tester",
    "wall game",
    "bat game",
    "bingo",
    "igt player",
    "igt super player",
    "coin-op misc.",
    "gun game (mechanical)",
    "barcrest mpu",
]


def lineage(machines: DataFrame, name: str = "name", parent: str = "cloneof") -> DataFrame:
    """(child, parent) of every machine that has a parent."""
    return machines.select(F.col(name).alias("child"), empty_to_null(F.col(parent)).alias("parent")).where("parent is not null")


def parent_index(machines: DataFrame) -> DataFrame:
    """(parent, clones): sorted distinct variants of each parent."""
    return lineage(machines).groupBy("parent").agg(F.array_sort(F.collect_set("child")).alias("clones"))


def family(machines: DataFrame) -> DataFrame:
    """(parent, machine, role): each parent with itself and its variants. A named parent need not exist itself."""
    own = machines.where(empty_to_null(F.col("cloneof")).isNull()).select(F.col("name").alias("parent"), F.col("name").alias("machine"), F.lit("parent").alias("role"))
    return own.union(lineage(machines).select("parent", F.col("child").alias("machine"), F.lit("clone").alias("role")))


def expand_to_clones(parents: DataFrame, machines: DataFrame) -> DataFrame:
    """The chosen parents (column name) and their variants, distinct."""
    clones = lineage(machines).join(parents.select(F.col("name").alias("parent")), "parent", "left_semi").select(F.col("child").alias("name"))
    return parents.select("name").union(clones).distinct()


def inherit_classification(classes: DataFrame, machines: DataFrame) -> DataFrame:
    """``classes`` and, for variants without a row of their own, their parent's row."""
    other = [c for c in classes.columns if c != "machine"]
    heirs = lineage(machines).join(classes, F.col("child") == F.col("machine"), "left_anti")
    given = heirs.join(classes, F.col("parent") == F.col("machine")).select(F.col("child").alias("machine"), *other)
    return classes.select("machine", *other).unionByName(given)


def classified(machines: DataFrame, classes: DataFrame) -> DataFrame:
    """Machines with game_status, category (array) and type; unknown where there is none."""
    c = classes.select(F.col("machine").alias("_m"), *(c for c in classes.columns if c != "machine"))
    unknown = lambda n: F.coalesce(empty_to_null(F.col(n)), F.lit("unknown")).alias(n)
    category = F.when(F.size("category") > 0, F.col("category")).otherwise(F.array(F.lit("unknown"))).alias("category")
    return machines.join(c, machines["name"] == F.col("_m"), "left").select(machines["*"], unknown("game_status"), category, unknown("type"))


def eligible_parents(machines: DataFrame, classes: DataFrame) -> DataFrame:
    """Names of parents that are games of the category Arcade."""
    known = classified(machines, classes)
    return known.where(empty_to_null(F.col("cloneof")).isNull() & (F.col("game_status") == "game") & F.array_contains("category", "Arcade")).select("name")


def eligibility(machines: DataFrame, classes: DataFrame, catlist: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(name, reason): the first rule that keeps a machine from publication, or eligible.

    ``names`` (column name) may hold names that no machine has; without it, all machines are judged.
    """
    m = machines.select("name", F.lit(True).alias("known"), "cloneof", "isbios", "isdevice", "ismechanical")
    rows = m if names is None else names.select("name").join(m, "name", "left")
    c = classes.select(F.col("machine").alias("_c"), F.coalesce(F.col("game_status"), F.lit("unknown")).alias("status"), F.lower("type").alias("kind"))
    k = catlist.select(F.col("machine").alias("_k"), "grp", "category")
    rows = rows.join(c, F.col("name") == F.col("_c"), "left").join(k, F.col("name") == F.col("_k"), "left")
    term = "|".join(t.replace(".", r"\.").replace("(", r"\(").replace(")", r"\)") for t in EXCLUDED_TYPES)
    reason = (
        F.when(F.col("known").isNull(), "missing_machine")
        .when(empty_to_null(F.col("cloneof")).isNotNull(), "clone")
        .when(truthy(F.col("isbios")), "bios")
        .when(truthy(F.col("isdevice")), "device")
        .when(F.col("_k").isNull(), "missing_classification")
        .when(~F.col("grp").eqNullSafe("Arcade"), "non_arcade")
        .when(F.col("status") == "no_game", "non_game")
        .when(~F.coalesce(F.col("status"), F.lit("unknown")).eqNullSafe("game"), "unknown_game_status")
        .when(F.col("category").isin(EXCLUDED_CATEGORIES), "excluded_category")
        .when(F.col("kind").rlike(term), "excluded_machine_type")
        .when(truthy(F.col("ismechanical")), "mechanical")
        .otherwise("eligible")
    )
    return rows.select("name", reason.alias("reason"))


def ports_parents(machines: DataFrame, with_ports: DataFrame) -> DataFrame:
    """Names of parents with port rows of their own or of a variant; unknown names and two-level lineage are left out."""
    found = with_ports.select("machine").distinct().join(machines.select(F.col("name").alias("machine"), "cloneof"), "machine")
    found = found.select(F.coalesce(empty_to_null(F.col("cloneof")), F.col("machine")).alias("name")).distinct()
    return found.join(machines.where(empty_to_null(F.col("cloneof")).isNull()).select("name"), "name")


def ports_selection(eligible: DataFrame, ported: DataFrame) -> DataFrame:
    """(name, eligible, has_ports, exception): eligible parents and parents with ports; exceptions are not eligible."""
    e, p = eligible.select("name", F.lit(True).alias("eligible")), ported.select("name", F.lit(True).alias("has_ports"))
    both = e.join(p, "name", "full_outer")
    both = both.select("name", F.coalesce("eligible", F.lit(False)).alias("eligible"), F.coalesce("has_ports", F.lit(False)).alias("has_ports"))
    return both.withColumn("exception", ~F.col("eligible"))


def list_classes(entries: DataFrame, lists: tuple[str, str, str] = ("status", "category", "type")) -> DataFrame:
    """(machine, game_status, category, type) from entries (list, section, machine) of three lists.

    Game and No Game give the status; categories are sorted and distinct, unknown only alone; of types the smallest
    counts, and <not available> makes it unknown. One grouping by machine serves all three lists.
    """
    status, category, kind = (F.when(F.col("list") == n, F.col("section")) for n in lists)
    got = entries.groupBy("machine").agg(
        F.bool_or(status == "Game").alias("game"),
        F.bool_or(status == "No Game").alias("no_game"),
        F.collect_set(F.when(not_available(category), "unknown").otherwise(category)).alias("category"),
        F.bool_or(not_available(kind)).alias("no_type"),
        F.min(kind).alias("type"),
    )
    named = F.array_sort(F.array_remove("category", "unknown"))
    return got.select(
        "machine",
        F.when(F.col("game"), "game").when(F.col("no_game"), "no_game").otherwise("unknown").alias("game_status"),
        F.when(F.size(named) > 0, named).otherwise(F.array(F.lit("unknown"))).alias("category"),
        F.when(F.col("type").isNull() | F.col("no_type"), "unknown").otherwise(F.col("type")).alias("type"),
    )


def as_of(observations: DataFrame, requests: DataFrame, key: str = "machine", at: str = "release", value: str = "category") -> DataFrame:
    """(key, release, value, source_release, status): the latest observation at or before each request; none, no row.

    An as-of join without a range join: observations and requests are one union, sorted within each key, and a
    running last value carries observations forward; a key's rows are a window, whatever the number of releases.
    """
    from pyspark.sql.window import Window

    o = observations.select(key, F.col(at).alias("at"), F.col(value).alias("value"), F.col(at).alias("source"), F.lit(0).alias("kind"))
    r = requests.select(key, F.col(at).alias("at"), F.lit(None).cast(o.schema["value"].dataType).alias("value"), F.lit(None).cast("string").alias("source"), F.lit(1).alias("kind"))
    order = Window.partitionBy(key).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    rows = o.union(r).withColumn("value", F.last("value", True).over(order)).withColumn("source", F.last("source", True).over(order))
    status = F.when(F.col("source") == F.col("at"), "observed").otherwise("carried_forward")
    return rows.where("kind = 1 and source is not null").select(key, F.col("at").alias(at), F.col("value").alias(value), F.col("source").alias("source_release"), status.alias("status"))


def classification_catalog(machines: DataFrame, current: DataFrame, catlist: DataFrame, historical: DataFrame) -> DataFrame:
    """Each machine with its flags and the three classifications side by side; a missing one is null."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("machine").alias("name"), F.struct(*(c for c in df.columns if c != "machine")).alias(name))

    flags = F.struct("cloneof", "isbios", "isdevice", "ismechanical").alias("flags")
    out = machines.select("name", flags)
    for df, name in ((current, "current"), (historical, "historical"), (catlist, "catlist")):
        out = out.join(side(df, name), "name", "left")
    return out


def missing_vocabulary(published: DataFrame, catlist: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(grp, category, subcategory, bucket, systems, machines): published machines without an approved phrase, in
    ``member_lists``; null keys: incomplete."""
    keys = ["grp", "category", "subcategory"]
    rows = published.select(F.col("name").alias("machine")).distinct().join(catlist, "machine", "left")
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.coalesce(F.trim(k) != "", F.lit(False))
    rows = rows.select("machine", *(F.when(whole, F.col(k)).alias(k) for k in keys))
    rows = rows.join(vocabulary.select(*keys), keys, "left_anti")
    return member_lists(rows, keys, "machine").withColumnRenamed("members", "machines")


def joined(c: str | Column, sep: str = "|") -> Column:
    return F.array_join(c, sep)


def machine_names(*names: DataFrame) -> DataFrame:
    """The distinct names in the first column of each table."""
    first, *rest = (df.select(F.col(df.columns[0]).alias("name")) for df in names)
    for df in rest:
        first = first.union(df)
    return first.where("name is not null").distinct()


def keys_minus(left: DataFrame, right: DataFrame, key: str = "machine") -> DataFrame:
    """The distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).subtract(right.select(key))


def keys_intersect(left: DataFrame, right: DataFrame, key: str = "machine") -> DataFrame:
    """The distinct keys that both have."""
    return left.select(key).intersect(right.select(key))


def classification_conflicts(rows: DataFrame, fields: list[str], key: str = "machine") -> DataFrame:
    """(key, n): keys that are given more than one classification; nulls are values like others."""
    different = F.count_distinct(F.struct(*(F.struct(F.col(c).alias(c)) for c in fields)))
    return rows.groupBy(key).agg(different.alias("n")).where("n > 1")

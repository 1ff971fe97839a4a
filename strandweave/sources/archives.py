"""Archives: who made one, of which release its name and its content say it is, and whether they agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: File names by provider; the three digits of these names are a release without its leading zero.
NAMES = {"snaps": r"ps_(?:catver|supportfiles)_\d{3}\.zip", "mame": r"mame\d{4}lx\.zip", "gaming_history": r"history\d{3,4}[a-z]?\.zip"}
#: Where a file name tells a release, the first that matches counts.
HINTS = [r"^ps_(?:catver|supportfiles)_(\d{3})\.zip$", r"(?:mame|history)[-_]?0?(\d{3,4})(?!\d)", r"(?<!\d)0\.(\d{3})(?!\d)", r"(?<!\d)(\d\.\d{3})(?!\d)"]
#: Versions inside archives.
EMBEDDED, ARTICLES = r"(?i)^0\.(\d{3})(?:\s+\(mame\d{4}\))?$", r"(?i)^2\.(\d{2,3})[a-z]?$"


def _leaf(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"([^/\\]*)$", 1))


def archive_provider(name: Column) -> Column:
    """The provider that a file name follows the form of, else unknown; names are not guessed."""
    out = F.when(name.isNull(), None)
    for provider, form in NAMES.items():
        out = out.when(_leaf(name).rlike(f"^{form}$"), provider)
    return out.otherwise("unknown")


def release_hint(name: Column) -> Column:
    """The release that a file name tells (four digits), or null."""
    found = [F.nullif(F.regexp_extract(_leaf(name), p, 1), F.lit("")) for p in HINTS]
    return F.lpad(F.replace(F.coalesce(*found), F.lit("."), F.lit("")), 4, "0")


def embedded_release(provider: Column, version: Column) -> Column:
    """The release of a version told inside an archive, or null if there is none or it has another form."""
    v = F.trim(version)
    number = F.regexp_extract(v, ARTICLES, 1).try_cast("int")
    own = F.when(provider.isin("mame", "snaps") & v.rlike(EMBEDDED), F.concat(F.lit("0"), F.regexp_extract(v, EMBEDDED, 1)))
    return own.when((provider == "gaming_history") & v.rlike(ARTICLES), F.format_string("%04d", number + 200))


def compare_release(embedded: Column, expected: Column) -> Column:
    """match, mismatch, or unverified where nothing is told."""
    return F.when(embedded.isNull(), "unverified").when(embedded == expected, "match").otherwise("mismatch")


def audit_archives(archives: DataFrame) -> DataFrame:
    """``archives`` (name, version, expected, readable) with provider, release, embedded_release and outcome.

    An archive with a member that can't be read is an error; one whose name or content tells another release than
    ``expected`` is a mismatch; one that is of no known provider or tells no version is unverified.
    """
    rows = archives.withColumn("provider", archive_provider(F.col("name"))).withColumn("release", release_hint(F.col("name")))
    rows = rows.withColumn("embedded_release", embedded_release(F.col("provider"), F.col("version")))
    told = compare_release(F.col("embedded_release"), F.col("expected"))
    wrong = (told == "mismatch") | F.coalesce(F.col("release") != F.col("expected"), F.lit(False))
    outcome = F.when(~F.coalesce("readable", F.lit(False)), "error").when(wrong, "mismatch").when((F.col("provider") == "unknown") | (told == "unverified"), "unverified").otherwise("verified")
    return rows.withColumn("outcome", outcome)

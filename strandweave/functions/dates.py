"""Loose dates (YYYY-MM-DD in which X stands for unknown), releases and versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Names of months; a date may have them whole or by their first three letters, and sept.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: What a date may look like, token by token: Y four digits, D one or two, M a month's name, U and u an unknown
#: month (???) and day (??), - a hyphen or slash. White space counts for nothing.
DAY_MONTH = ["DMY", "DM,Y"]
MONTH_DAY = ["MDY", "M,DY", "MD,Y", "M,D,Y"]
NO_DAY = ["MY", "MuY", "M,uY", "Mu,Y", "M,u,Y"]
NO_MONTH = ["Y", *(f"U{a}{b}u{c}Y" for a in ("", ".") for b in ("", ",") for c in ("", ","))]


def _made(y: Column, m: Column, d: Column) -> Column:
    """A whole date if the calendar has it, else null."""
    iso = F.format_string("%04d-%02d-%02d", y, m, d)
    return F.when(F.try_to_date(iso, "yyyy-MM-dd").isNotNull(), iso)


def parse_loose_date(raw: Column) -> Column:
    """Free text to YYYY-MM-DD with X for what is unknown; null if it isn't one date.

    Years (with ? for digits), year and month, day month year with month names in either order (an unknown day or
    month may be ?), ISO and numeric dates, of which day comes first unless only month first is possible. Weekdays,
    quarters, seasons, months alone, two years and days the calendar lacks are rejected.
    """
    t = F.regexp_replace(strip(raw), "^['\"]+", "")
    t = strip(F.regexp_replace(t, "[,.;:'\"]+\\s*$", ""))
    return _let(F.lower(F.regexp_replace(t, r"\s+", " ")), _read_date)


def _let(value: Column, use) -> Column:
    """``use`` of ``value``: a lambda's variable is computed once, where a column used in every branch would be repeated."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_NAMES = "|".join([*MONTHS, "sept", *(m[:3] for m in MONTHS)])
#: A number as it is read: one or two digits stand apart from a year right behind them.
_NUMBER = r"(?>\d{1,2}(?=\d{4}(?!\d))|\d+)"
#: From a text to its shape: ordinal endings o, names of months M, other words x, then numbers and unknown parts.
_SHAPES = [
    (rf"(?<![a-z])(?:{_NAMES})(?![a-z])", "M"),
    (r"[a-z]+", "x"),
    (r"(?<!\d)\d{1,2}(?=\d{4}(?!\d))", "D"),
    (r"(?<!\d)\d{4}(?!\d)", "Y"),
    (r"(?<!\d)\d{1,2}(?!\d)", "D"),
    (r"\d+", "x"),
    (r"(?<!\?)\?{5}(?!\?)", "Uu"),
    (r"(?<!\?)\?{3}(?!\?)", "U"),
    (r"(?<!\?)\?\?(?!\?)", "u"),
]


def _read_date(s: Column) -> Column:
    """What the parts of a text are, one after the other, says which number is what; the calendar decides."""
    plain = F.regexp_replace(s, r"(?<=\d)(?:st|nd|rd|th)", "O")
    shape = plain
    for pattern, mark in _SHAPES:
        shape = F.regexp_replace(shape, pattern, mark)
    shape = F.translate(shape, "/", "-")
    # a point ends a month's name, and an ordinal ending a day's number beside one; spaces are between parts only
    shape = F.regexp_replace(F.regexp_replace(shape, r"M\.", "M"), r"DO(?=.*M)|(?<=M|M,|M |M, )DO", "D")
    shape = F.when(shape.contains("-") & s.contains(" "), "x").otherwise(F.replace(shape, F.lit(" "), F.lit("")))
    number = lambda i: F.regexp_extract(s, rf"^\D*+(?:{_NUMBER}\D*+){{{i}}}({_NUMBER})", 1).try_cast("int")
    name = F.regexp_extract(plain, rf"(?<![a-z])({_NAMES})(?![a-z])", 1)
    month = F.ceil(F.nullif(F.instr(F.lit("".join(m[:3] for m in MONTHS)), F.substring(name, 1, 3)), F.lit(0)) / 3).cast("int")
    unknown_digits = s.rlike(r"^\d{1,3}\?{1,3}$") & (F.length(s) == 4)
    return F.when(unknown_digits, F.concat(F.translate(s, "?", "X"), F.lit("-XX-XX"))).otherwise(_let(shape, lambda told: _dated(told, number, F.when(name != "", month))))


def _dated(shape: Column, number, month: Column) -> Column:
    first, second, third = (number(i) for i in range(3))

    def no_day(year: Column, m: Column) -> Column:
        return _let(m, lambda m: F.when(m.between(1, 12), F.format_string("%04d-%02d-XX", year, m)))

    def numeric(parts: Column) -> Column:
        a, b, year = parts["a"], parts["b"], parts["y"]
        swap = (b > 12) & (a <= 12)
        return _made(year, F.when(swap, a).otherwise(b), F.when(swap, b).otherwise(a))

    return (
        F.when(shape.isin(NO_MONTH), F.format_string("%04d-XX-XX", first))
        .when(shape.isin(NO_DAY), no_day(first, month))
        .when(shape == "Y-D", no_day(first, second))
        .when(shape.isin(*DAY_MONTH, *MONTH_DAY), _made(second, month, first))
        .when(shape == "Y-D-D", _made(first, second, third))
        .when(shape == "D-D-Y", _let(F.struct(first.alias("a"), second.alias("b"), third.alias("y")), numeric))
    )


def loose_date_sort_key(date: Column) -> Column:
    """(year, month, day) with 0 for what is unknown or no number."""
    parts = F.split(F.translate(strip(F.coalesce(date, F.lit(""))), "X", "0"), "-")
    number = lambda i: F.coalesce(F.get(parts, F.lit(i)).try_cast("int"), F.lit(0))
    return F.struct(number(0).alias("year"), number(1).alias("month"), number(2).alias("day"))


def normalise_release(c: Column) -> Column:
    """287, 0287 and 0.287 to 0287; null for anything else."""
    t = F.regexp_replace(strip(c.cast("string")), r"^0\.", "")
    return F.when(t.rlike("^[0-9]{1,4}$"), F.lpad(t, 4, "0"))


def version_core(c: Column) -> Column:
    """The numbers of a version before its suffix: 0.289a to [0, 289]."""
    core = F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d+(?:\.\d+)*)", 1)
    return F.when(core != "", F.transform(F.split(core, r"\."), lambda x: x.try_cast("int")))


def version_suffix(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"\d+(?:\.\d+)*([A-Za-z][A-Za-z0-9]*)?", 1)


def iso_date(c: Column) -> Column:
    """DD/MM/YYYY or YYYY-MM-DD to YYYY-MM-DD, else null."""
    return F.date_format(F.coalesce(F.try_to_date(c, "dd/MM/yyyy"), F.try_to_date(c, "yyyy-MM-dd")), "yyyy-MM-dd")


def format_utc(c: Column) -> Column:
    """An ISO time in UTC as 17 Jan 2026, 14:56:26 UTC; what isn't one stays."""
    ts = F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))
    return F.when(ts.isNull(), c).otherwise(F.concat(F.date_format(ts, "dd MMM yyyy, HH:mm:ss"), F.lit(" UTC")))

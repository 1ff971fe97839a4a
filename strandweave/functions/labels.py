"""Labels of chips, displays, controls, ROMs and media."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import join_ampersand, strip, text_or_empty

#: Labels of control types.
CONTROL_LABELS = {
    "joy": "Joystick",
    "doublejoy": "Dual Joystick",
    "triplejoy": "Triple Joystick",
    "stick": "Analogue Joystick",
    "only_buttons": "Buttons Only",
    "paddle": "Paddle",
    "dial": "Dial",
    "trackball": "Trackball",
    "mouse": "Mouse",
    "positional": "Positional",
    "lightgun": "Light Gun",
    "pedal": "Pedal",
    "keyboard": "Keyboard",
    "keypad": "Keypad",
    "mahjong": "Mahjong Panel",
    "hanafuda": "Hanafuda Panel",
    "gambling": "Gambling Panel",
}
#: Media labels in order of display, with a pattern for the device names that mean them (first match wins
#: in the order of MEDIA_RULES).
MEDIA_ORDER = ["GD-ROM", "DVD-ROM", "CD-ROM", "LaserDisc", "Capacitance Electronic Disc (CED)", "Hard disk", "CompactFlash card", "Secure Digital card", "NAND flash", "USB storage", "VHS tape"]
_TOKEN = r"(?<![a-z0-9_])(?:{})(?![a-z0-9_])"
MEDIA_RULES = [
    ("LaserDisc", _TOKEN.format("laserdisc[a-z0-9_]*") + r"|\b(?:ld_)?(?:ldv1000|pr7820|pr8210a?|22vp932)\b"),
    ("Capacitance Electronic Disc (CED)", _TOKEN.format("ced_videodisc")),
    ("GD-ROM", _TOKEN.format("gdrom")),
    ("DVD-ROM", _TOKEN.format("dvd|dvdrom[a-z0-9_]*")),
    ("CD-ROM", _TOKEN.format("cd|audiocd|cdxa|xm3301|cr589|stvcd|cdrom[a-z0-9_]*")),
    ("Hard disk", _TOKEN.format("hdd|harddisk|scsi_hdd_image") + "|:hdd"),
    ("CompactFlash card", _TOKEN.format("cf|cfcard|cflash|ataflash|taitocf|taitopccard1|taitopccard2|pccard")),
    ("Secure Digital card", _TOKEN.format("sdcard|internalsd")),
    ("NAND flash", _TOKEN.format("nand")),
    ("USB storage", _TOKEN.format("usb")),
    ("VHS tape", _TOKEN.format("vhs")),
]


def hz_to_human(hz: Column) -> Column:
    """(value, unit) of a frequency; null below 1 Hz."""
    v = hz.cast("double")
    made = lambda x, unit: F.struct(x.alias("value"), F.lit(unit).alias("unit"))
    return F.when(v >= 1e9, made(v / 1e9, "GHz")).when(v >= 1e6, made(v / 1e6, "MHz")).when(v >= 1e3, made(v / 1e3, "kHz")).when(v >= 1, made(v, "Hz"))


def format_hz(hz: Column) -> Column:
    v = hz.try_cast("double")
    return F.when(v > 0, F.format_string("%.3f Hz", v))


def chip_label(name: Column, hz: Column) -> Column:
    """Z80 @ 3.580 MHz; the name alone below 1 Hz."""
    v = hz.cast("double")
    told = F.when(v >= 1e9, F.format_string(" @ %.3f GHz", v / 1e9)).when(v >= 1e6, F.format_string(" @ %.3f MHz", v / 1e6)).when(v >= 1e3, F.format_string(" @ %.3f kHz", v / 1e3)).when(v >= 1, F.format_string(" @ %.3f Hz", v))
    return F.concat(text_or_empty(name), F.coalesce(told, F.lit("")))


def bytes_to_human(n: Column) -> Column:
    """1.50 KiB, MiB or GiB; null below 1024."""
    v = n.cast("double")
    return F.when(v >= 2**30, F.format_string("%.2f GiB", v / 2**30)).when(v >= 2**20, F.format_string("%.2f MiB", v / 2**20)).when(v >= 1024, F.format_string("%.2f KiB", v / 1024))


def media_label(device: Column) -> Column:
    """The media that a device name means, or null."""
    s, out = F.lower(F.coalesce(device, F.lit(""))), None
    for label, pattern in MEDIA_RULES:
        out = F.when(s.rlike(pattern), label) if out is None else out.when(s.rlike(pattern), label)
    return out


def media_labels(devices: Column) -> Column:
    """Distinct labels of an array of device names, in order of display."""
    found = F.array_distinct(F.filter(F.transform(devices, media_label), lambda x: x.isNotNull()))
    order = F.array(*(F.lit(x) for x in MEDIA_ORDER))
    return F.filter(order, lambda x: F.array_contains(found, x))


def rom_block(rom_count: Column, rom_bytes: Column, disk_required: Column, devices: Column) -> Column:
    """Two or three lines: ROMs, bytes, and the media with their number if over one."""
    n, size = F.coalesce(rom_count, F.lit(0)), F.coalesce(rom_bytes, F.lit(0))
    one = F.concat(F.format_number(n, 0), F.when(n == 1, " ROM").otherwise(" ROMs"))
    human = bytes_to_human(size)
    two = F.concat(F.format_number(size, 0), F.lit(" bytes"), F.when(human.isNull(), "").otherwise(F.concat(F.lit(" ("), human, F.lit(")"))))
    every = F.transform(devices, media_label)
    count = lambda label: F.size(F.filter(every, lambda x: x == label))
    named = F.transform(media_labels(devices), lambda m: F.when(count(m) > 1, F.concat(F.lit("("), count(m).cast("string"), F.lit("x) "), m)).otherwise(m))
    plus = F.when((F.lower(text_or_empty(disk_required)) == "yes") & (F.size(named) > 0), F.concat(F.lit("Plus: "), join_ampersand(named)))
    return F.concat_ws("\n", one, two, plus)


def orientation(rotate: Column) -> Column:
    r = rotate.try_cast("int")
    return F.when(r.isin(0, 180), "Horizontal").when(r.isin(90, 270), "Vertical")


def display_type(c: Column) -> Column:
    s = F.lower(text_or_empty(c))
    return F.when(s.isin("svg", "lcd"), F.upper(s)).otherwise(F.initcap(s))


def control_type(c: Column) -> Column:
    s = F.lower(text_or_empty(c))
    known = F.create_map(*(F.lit(x) for pair in CONTROL_LABELS.items() for x in pair))
    return F.coalesce(F.element_at(known, s), F.when(s == "", "Unknown Control").otherwise(F.initcap(s)))


def ways_text(c: Column) -> Column:
    s = F.lower(text_or_empty(c))
    half = r"^(\d+)\s*\(half(\d+)\)$"
    return (
        F.when(s.isin("vertical2", "strange2"), "2-way")
        .when(s.rlike(half), F.concat(F.regexp_extract(s, half, 1), F.lit("-of-"), F.regexp_extract(s, half, 2), F.lit("-way")))
        .when(s.rlike("^[0-9]+$"), F.concat(s.try_cast("bigint").cast("string"), F.lit("-way")))
        .otherwise(text_or_empty(c))
    )


def control_line(kind: Column, *ways: Column) -> Column:
    told = F.array_join(F.filter(F.array(*(ways_text(w) for w in ways)), lambda w: w != ""), ", ")
    return strip(F.concat_ws(" ", told, control_type(kind)))


def plural(n: Column, one: str, many: str | None = None) -> Column:
    return F.when(n == 1, one).otherwise(many or f"{one}s")


def opening_sentence(title: Column, phrase: Column, year: Column, manufacturer: Column, laserdisc: Column, vector: Column) -> Column:
    """A sentence that opens an article; null without a title or without a phrase that starts with a or an."""
    t, p, y, m = (text_or_empty(c) for c in (title, phrase, year, manufacturer))
    laser, lines = F.coalesce(laserdisc, F.lit(False)), F.coalesce(vector, F.lit(False))
    told = F.when(laser, F.concat(F.lit("an interactive "), F.regexp_replace(p, "^an? ", ""))).otherwise(p)
    told = F.when(lines, F.concat(told, F.lit(" featuring vector graphics"))).otherwise(told)
    out = (
        F.when((y != "") & (m != ""), F.concat(F.lit("published in "), y, F.lit(" by "), m))
        .when(y != "", F.concat(F.lit("published in "), y))
        .when(m != "", F.concat(F.lit("published by "), m))
        .otherwise("")
    )
    end = F.when(out == "", "").otherwise(F.concat(F.when(lines, ", ").otherwise(" "), out))
    return F.when((t != "") & p.rlike("^an? "), F.concat(t, F.lit(" is "), told, end, F.lit(".")))

"""Queries of the column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, labels, text
from ..operators.dictionary import by_distinct
from .views import Views, query


@query("truthy_flag", "SELECT name, lower(trim(isbios)) IN ('1','true','yes','y','t') AS flag, CASE WHEN lower(trim(isbios)) IN ('1','true','yes','y','t') THEN 'yes' ELSE 'no' END AS word FROM v_machines")
def truthy_flag(v: Views):
    return v.machines.select("name", text.truthy(F.col("isbios")).alias("flag"), text.yes_no(text.truthy(F.col("isbios"))).alias("word"))


@query("year_bucket", "SELECT CASE WHEN regexp_full_match(year, '[0-9]{4}') THEN year ELSE 'unknown' END AS bucket, count(*) AS n FROM v_machines GROUP BY 1")
def year_bucket(v: Views):
    return v.machines.groupBy(text.year_bucket(F.col("year")).alias("bucket")).agg(F.count("*").alias("n"))


@query("manufacturer_bucket", "SELECT CASE WHEN trim(manufacturer, '-.,;:/()[]{} ') = '' THEN 'unknown' ELSE trim(manufacturer, '-.,;:/()[]{} ') END AS bucket, count(*) AS n FROM v_machines GROUP BY 1")
def manufacturer_bucket(v: Views):
    return v.machines.groupBy(text.manufacturer_bucket(F.col("manufacturer")).alias("bucket")).agg(F.count("*").alias("n"))


@query("collapse_whitespace", r"SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS digest FROM documents")
def collapse_whitespace(v: Views):
    return v.table("documents").select("doc_id", F.md5(text.collapse_whitespace(F.col("text"))).alias("digest"))


@query(
    "split_outside_parens",
    """SELECT name, CASE WHEN manufacturer = '' THEN '' WHEN manufacturer LIKE '[%' THEN manufacturer
              ELSE replace(manufacturer, ' / Acme', ' & Acme') END AS joined FROM v_machines""",
)
def split_outside_parens(v: Views):
    return v.machines.select("name", text.format_manufacturers(F.col("manufacturer")).alias("joined"))


@query(
    "hz_to_human",
    """SELECT machine, pos, chip || CASE WHEN clock_hz >= 1000000000 THEN printf(' @ %.3f GHz', clock_hz / 1e9) WHEN clock_hz >= 1000000 THEN printf(' @ %.3f MHz', clock_hz / 1e6)
              WHEN clock_hz >= 1000 THEN printf(' @ %.3f kHz', clock_hz / 1e3) WHEN clock_hz >= 1 THEN printf(' @ %.3f Hz', clock_hz * 1.0::DOUBLE) ELSE '' END AS label,
              CASE WHEN clock_hz > 0 THEN printf('%.3f Hz', clock_hz * 1.0::DOUBLE) END AS plain FROM v_chips""",
)
def hz_to_human(v: Views):
    return v.chips.select("machine", "pos", labels.chip_label(F.col("chip"), F.col("clock_hz")).alias("label"), labels.format_hz(F.col("clock_hz").cast("string")).alias("plain"))


@query(
    "bytes_to_human",
    """SELECT name, CASE WHEN rom_bytes >= 1073741824 THEN printf('%.2f GiB', rom_bytes / 1073741824.0) WHEN rom_bytes >= 1048576 THEN printf('%.2f MiB', rom_bytes / 1048576.0)
              WHEN rom_bytes >= 1024 THEN printf('%.2f KiB', rom_bytes / 1024.0) END AS size FROM v_machines""",
)
def bytes_to_human(v: Views):
    return v.machines.select("name", labels.bytes_to_human(F.col("rom_bytes")).alias("size"))


_MEDIA = """CASE d WHEN 'ide:0:hdd:image' THEN 'Hard disk' WHEN 'cdrom' THEN 'CD-ROM' WHEN 'laserdisc' THEN 'LaserDisc' WHEN 'gdrom' THEN 'GD-ROM' END"""
_RANK = """CASE m WHEN 'GD-ROM' THEN 0 WHEN 'DVD-ROM' THEN 1 WHEN 'CD-ROM' THEN 2 WHEN 'LaserDisc' THEN 3 ELSE 5 END"""


@query(
    "media_labels",
    f"""SELECT name, coalesce(string_agg(m, '|' ORDER BY r), '') AS media FROM (
          SELECT DISTINCT name, m, {_RANK} AS r FROM (SELECT name, {_MEDIA} AS m FROM (SELECT name, unnest(string_split(disk_regions, ',')) AS d FROM v_machines)))
        GROUP BY name""",
)
def media_labels(v: Views):
    return v.machines.select("name", F.array_join(labels.media_labels(F.split("disk_regions", ",")), "|").alias("media"))


@query(
    "rom_block_text",
    f"""WITH m AS (SELECT name, string_agg(CASE WHEN n > 1 THEN '(' || n || 'x) ' || m ELSE m END, ' & ' ORDER BY r) AS plus FROM (
            SELECT name, m, {_RANK} AS r, count(*) AS n FROM (SELECT name, {_MEDIA} AS m FROM (SELECT name, unnest(string_split(disk_regions, ',')) AS d FROM v_machines)) WHERE m IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
        SELECT v.name, rom_count || CASE WHEN rom_count = 1 THEN ' ROM' ELSE ' ROMs' END || chr(10) || format('{{:,}}', rom_bytes) || ' bytes'
               || CASE WHEN rom_bytes >= 1048576 THEN printf(' (%.2f MiB)', rom_bytes / 1048576.0) WHEN rom_bytes >= 1024 THEN printf(' (%.2f KiB)', rom_bytes / 1024.0) ELSE '' END
               || coalesce(CASE WHEN disk_required = 'yes' THEN chr(10) || 'Plus: ' || plus END, '') AS block
        FROM v_machines v LEFT JOIN m ON v.name = m.name""",
)
def rom_block_text(v: Views):
    return v.machines.select("name", labels.rom_block(F.col("rom_count"), F.col("rom_bytes"), F.col("disk_required"), F.split("disk_regions", ",")).alias("block"))


@query(
    "display_labels",
    """SELECT type, rotate, CASE type WHEN 'svg' THEN 'SVG' WHEN 'lcd' THEN 'LCD' WHEN 'raster' THEN 'Raster' ELSE 'Vector' END AS type_label,
              CASE rotate WHEN '0' THEN 'Horizontal' WHEN '90' THEN 'Vertical' WHEN '270' THEN 'Vertical' END AS turned, count(*) AS n FROM v_displays GROUP BY ALL""",
)
def display_labels(v: Views):
    return v.displays.select("type", "rotate", labels.display_type(F.col("type")).alias("type_label"), labels.orientation(F.col("rotate")).alias("turned")).groupBy("type", "rotate", "type_label", "turned").agg(F.count("*").alias("n"))


_WAYS = "CASE {0} WHEN '8' THEN '8-way' WHEN '4' THEN '4-way' WHEN 'vertical2' THEN '2-way' WHEN 'strange2' THEN '2-way' WHEN '8 (half16)' THEN '8-of-16-way' ELSE '' END"
CONTROL_LINE_SQL = (
    "CASE WHEN ways = '' THEN '' WHEN ways2 = '' THEN " + _WAYS.format("ways") + " || ' ' ELSE " + _WAYS.format("ways") + " || ', ' || " + _WAYS.format("ways2") + " || ' ' END || "
    "CASE type WHEN 'joy' THEN 'Joystick' WHEN 'only_buttons' THEN 'Buttons Only' WHEN 'dial' THEN 'Dial' WHEN 'crank' THEN 'Crank' ELSE 'Unknown Control' END"
)


@query("control_labels", f"SELECT {CONTROL_LINE_SQL} AS line, count(*) AS n FROM v_controls GROUP BY 1")
def control_labels(v: Views):
    return v.controls.groupBy(labels.control_line(F.col("type"), F.col("ways"), F.col("ways2")).alias("line")).agg(F.count("*").alias("n"))


@query(
    "parse_loose_date",
    r"""WITH p AS (SELECT r.o_orderkey, r.raw, CAST(extract(year FROM o_orderdate) AS STRING) AS y, lpad(CAST(extract(month FROM o_orderdate) AS STRING), 2, '0') AS m,
                      lpad(CAST(extract(day FROM o_orderdate) AS STRING), 2, '0') AS d, o.o_orderkey % 20 AS k FROM v_text_dates r JOIN orders o ON r.o_orderkey = o.o_orderkey)
       SELECT o_orderkey, CASE WHEN k IN (0, 16, 10) THEN y || '-XX-XX' WHEN k = 1 THEN substr(y, 1, 3) || 'X-XX-XX' WHEN k = 2 THEN y || '-' || m || '-XX' WHEN k = 3 THEN y || '-' || m || '-' || d
              WHEN k = 4 THEN y || '-' || m || '-' || d
              WHEN k = 5 THEN CASE WHEN CAST(d AS INT) > 12 THEN y || '-' || m || '-' || d ELSE y || '-' || d || '-' || m END
              WHEN k = 6 THEN y || '-03-' || d
              WHEN k = 7 THEN CASE WHEN try_cast(y || '-02-' || d AS DATE) IS NOT NULL THEN y || '-02-' || d END
              WHEN k = 8 THEN y || '-09-XX' WHEN k = 9 THEN y || '-12-XX' END AS date FROM p""",
)
def parse_loose_date(v: Views):
    return by_distinct(v.text_dates, "raw", lambda rows, raw: rows.withColumn("date", dates.parse_loose_date(F.col(raw)))).select("o_orderkey", "date")


@query(
    "loose_date_sort_key",
    """SELECT machine, row_no, CASE WHEN date = '' THEN 0 ELSE CAST(substr(date, 1, 4) AS INT) END AS year, CASE WHEN date LIKE '%XX' OR date = '' THEN 0 ELSE CAST(substr(date, 6, 2) AS INT) END AS month,
              CASE WHEN date LIKE '%XX' OR date = '' THEN 0 ELSE CAST(substr(date, 9, 2) AS INT) END AS day FROM v_ports""",
)
def loose_date_sort_key(v: Views):
    return v.ports.select("machine", "row_no", dates.loose_date_sort_key(F.col("date")).alias("k")).select("machine", "row_no", "k.year", "k.month", "k.day")


@query(
    "normalise_release",
    """WITH t AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '0.' || CAST(c_custkey % 400 AS STRING) WHEN 1 THEN CAST(c_custkey AS STRING) WHEN 2 THEN 'r' || CAST(c_custkey AS STRING) WHEN 3 THEN '12345' ELSE ' 287 ' END AS raw FROM customer)
       SELECT c_custkey, CASE WHEN regexp_full_match(regexp_replace(trim(raw), '^0\\.', ''), '[0-9]{1,4}') THEN lpad(regexp_replace(trim(raw), '^0\\.', ''), 4, '0') END AS release FROM t""".replace("\\\\", "\\"),
)
def normalise_release(v: Views):
    k = F.col("c_custkey")
    raw = F.when(k % 5 == 0, F.concat(F.lit("0."), (k % 400).cast("string"))).when(k % 5 == 1, k.cast("string")).when(k % 5 == 2, F.concat(F.lit("r"), k.cast("string"))).when(k % 5 == 3, "12345").otherwise(" 287 ")
    return v.table("customer").select("c_custkey", dates.normalise_release(raw).alias("release"))


@query(
    "parse_version",
    "SELECT event_id, CAST(event_id % 3 AS STRING) || '.' || CAST(event_id % 290 AS STRING) AS core, CASE WHEN event_id % 4 = 0 THEN 'a' ELSE '' END AS suffix, event_id % 3 = 0 AND event_id % 290 = 287 AS same FROM events",
)
def parse_version(v: Views):
    k = F.col("event_id")
    raw = F.concat(F.lit("v"), (k % 3).cast("string"), F.lit("."), (k % 290).cast("string"), F.when(k % 4 == 0, "a").otherwise(""))
    core = dates.version_core(raw)
    return v.table("events").select("event_id", F.array_join(core.cast("array<string>"), ".").alias("core"), dates.version_suffix(raw).alias("suffix"), (core == dates.version_core(F.lit("0.287"))).alias("same"))


@query("not_available_label", "SELECT section, lower(replace(section, ' ', '')) = '<notavailable>' AS missing, count(*) AS n FROM v_ini GROUP BY ALL")
def not_available_label(v: Views):
    return v.ini.groupBy("section", text.not_available(F.col("section")).alias("missing")).agg(F.count("*").alias("n"))


@query(
    "stable_finding_key",
    """SELECT rule_id, machine, source_text, value, sha256('{"machine":"' || machine || '","rule_id":"' || rule_id || '","section":"PORTS","source_text":"' || source_text || '"' || CASE WHEN value IS NULL THEN '' ELSE ',"value":"' || value || '"' END || '}') AS finding_key,
              count(*) AS n FROM v_findings GROUP BY ALL""",
)
def stable_finding_key(v: Views):
    key = text.finding_key(F.col("rule_id"), F.col("machine"), F.col("section"), F.col("source_text"), F.col("value"))
    return v.findings.groupBy("rule_id", "machine", "source_text", "value", key.alias("finding_key")).agg(F.count("*").alias("n"))


@query("text_hash", "SELECT machine, block_index, substr(sha1(text), 1, 8) AS hash FROM v_blocks_before")
def text_hash(v: Views):
    return v.blocks_before.select("machine", "block_index", text.text_hash(F.col("text")).alias("hash"))


@query(
    "html_unescape",
    # the names that the pages hold; &amp; goes last, so that what it gives is not decoded again
    """SELECT page_id, md5(regexp_replace(replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')) AS digest FROM pages""",
)
def html_unescape(v: Views):
    return v.table("pages").select("page_id", F.md5(text.unescape_html(F.col("html"))).alias("digest"))


@query("section_label", r"SELECT section, upper(trim(regexp_replace(section, '\s+', ' ', 'g'))) AS label, count(*) AS n FROM v_ini GROUP BY ALL")
def section_label(v: Views):
    return v.ini.groupBy("section", text.section_label(F.col("section")).alias("label")).agg(F.count("*").alias("n"))


@query(
    "opening_sentence",
    """SELECT m.name, CASE WHEN coalesce(description, '') = '' THEN NULL ELSE trim(description) || ' is '
              || CASE WHEN m.ordinal % 5 = 0 THEN 'an interactive ' ELSE 'a ' END || lower(c.category) || ' game' || CASE WHEN m.ordinal % 3 = 0 THEN ' featuring vector graphics' ELSE '' END
              || CASE WHEN year <> '' OR manufacturer <> '' THEN CASE WHEN m.ordinal % 3 = 0 THEN ', ' ELSE ' ' END ELSE '' END
              || CASE WHEN year <> '' AND manufacturer <> '' THEN 'published in ' || year || ' by ' || manufacturer WHEN year <> '' THEN 'published in ' || year WHEN manufacturer <> '' THEN 'published by ' || manufacturer ELSE '' END
              || '.' END AS sentence FROM v_machines m JOIN v_catlist c ON m.name = c.machine""",
)
def opening_sentence(v: Views):
    both = v.machines.join(v.catlist, F.col("name") == F.col("machine"))
    phrase = F.concat(F.lit("a "), F.lower("category"), F.lit(" game"))
    return both.select("name", labels.opening_sentence(F.col("description"), phrase, F.col("year"), F.col("manufacturer"), F.col("ordinal") % 5 == 0, F.col("ordinal") % 3 == 0).alias("sentence"))


@query("format_run_times", "SELECT o_orderkey, strftime(o_orderdate, '%d %b %Y, %H:%M:%S') || ' UTC' AS at, printf('%.1f s', (o_orderkey % 977) / 4.0) AS took FROM orders")
def format_run_times(v: Views):
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return v.table("orders").select("o_orderkey", dates.format_utc(at).alias("at"), F.format_string("%.1f s", F.bround((F.col("o_orderkey") % 977) / 4.0, 1)).alias("took"))


@query("title_or_fallback", "SELECT name, coalesce(nullif(description, ''), name) AS title FROM v_machines")
def title_or_fallback(v: Views):
    return v.machines.select("name", F.coalesce(text.empty_to_null(F.col("description")), F.col("name")).alias("title"))

"""Whole records and their projections; the oracles are made of those of the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import lineage as L
from ..operators import publish as B
from . import diff_queries, scalar_queries, section_queries  # noqa: F401  their oracles are parts of those here
from .lineage_queries import ELIGIBLE, classes, ports
from .views import PARTS, Views, query

PREFIX = "Wiki/"


def records(v: Views):
    m = v.machines
    flag = (F.coalesce("sampleof", F.lit("")) != "") | text.truthy(F.col("samples"))
    m = m.withColumns({"players": text.digits(F.col("players_raw")), "channels": text.digits(F.col("channels_raw")), "disk_regions": F.filter(F.split("disk_regions", ","), lambda d: d != ""), "requires_samples": text.yes_no(flag)})
    phrases = v.catlist.select("grp", "category", "subcategory", F.concat(F.lit("a "), "category", F.lit(" game")).alias("phrase")).distinct()
    return B.parent_records(m, classes(v), v.chips, v.displays, v.controls, ports(v), v.catlist, phrases, PREFIX)


_MAKER = "CASE WHEN manufacturer LIKE '[%' THEN manufacturer ELSE replace(manufacturer, ' / Acme', ' & Acme') END"
_PAGE = "CASE WHEN description IS NULL THEN '' ELSE split_part(description, ' / ', 1) END"
#: Records as SQL: each part by the oracle of its own query.
RECORDS = f"""
    WITH fam AS ({PARTS["family_titles"]}), por AS ({PARTS["merge_ports"]}), lin AS ({PARTS["ports_display_order"]}), chi AS ({PARTS["chips_section"]}), dis AS ({PARTS["displays_section"]}), con AS ({PARTS["explode_controls"]}), rom AS ({PARTS["rom_block_text"]}), ids AS (SELECT parent, string_agg(CAST(source_id AS STRING), '|' ORDER BY source_id) AS ids FROM (SELECT DISTINCT parent, source_id FROM ({PARTS["merge_ports"]}) WHERE source_id IS NOT NULL) GROUP BY 1),
    pg AS (SELECT name, {_PAGE} AS page, CASE WHEN description IS NULL THEN '' ELSE split_part(split_part(description, ' / ', 2), ' (', 1) END AS second FROM v_machines),
    nam AS (SELECT name AS parent, '' AS of, second AS name FROM pg WHERE second <> '' UNION ALL SELECT DISTINCT por.parent, por.machine, pg.page FROM por JOIN pg ON pg.name = por.machine WHERE role = 'clone' AND pg.page <> ''),
    red AS (SELECT parent, string_agg(name, '|' ORDER BY of) AS names FROM (SELECT nam.*, row_number() OVER (PARTITION BY nam.parent, lower(nam.name) ORDER BY of) AS k FROM nam JOIN pg ON pg.name = nam.parent WHERE lower(nam.name) <> lower(pg.page)) WHERE k = 1 GROUP BY 1),
    tit AS (SELECT parent, string_agg(title || CASE WHEN trim(year) <> '' THEN ' (' || year || ')' ELSE '' END || ' [' || role || ': ' || machine || ']', chr(10) ORDER BY place) AS lines, string_agg(machine, '|' ORDER BY role = 'clone', machine) AS machines FROM fam GROUP BY 1),
    sho AS (SELECT parent, string_agg(lines, chr(10) ORDER BY category) AS lines FROM (SELECT parent, category, category || ':' || string_agg(line, chr(10) ORDER BY place) AS lines FROM lin GROUP BY 1, 2) GROUP BY 1),
    src AS (SELECT parent, string_agg(s, '|' ORDER BY role = 'clone', machine) AS sources FROM (SELECT parent, role, machine, role || ':' || machine || ':' || coalesce(CAST(min(source_id) AS STRING), '') || ':' || count(*) || ':' || count(DISTINCT category) AS s FROM por GROUP BY 1, 2, 3) GROUP BY 1),
    items AS (SELECT machine, CASE WHEN cpus <> '' AND NOT contains(cpus, '|') THEN 'CPU:' ELSE 'CPUs:' END || CASE WHEN cpus = '' THEN '' ELSE chr(10) || replace(cpus, '|', chr(10)) END || chr(10)
                     || CASE WHEN audio_chips <> '' AND NOT contains(audio_chips, '|') THEN 'Audio Chip:' ELSE 'Audio Chips:' END || CASE WHEN audio_chips = '' THEN '' ELSE chr(10) || replace(audio_chips, '|', chr(10)) END AS text FROM chi)
    SELECT m.name, '{PREFIX}' || pg.page AS page, coalesce(red.names, '') AS redirects, nullif(m.year, '') AS year, nullif({_MAKER}, '') AS manufacturer, tit.lines AS titles, tit.machines AS family, rom.block AS roms, coalesce(items.text, 'CPUs:' || chr(10) || 'Audio Chips:') AS chips,
           coalesce(dis.text, 'Screens: 0') AS displays, con.text AS controls, sho.lines AS ports, src.sources, coalesce(ids.ids, '') AS gh_ids, coalesce(c.game_status, 'unknown') AS game_status, coalesce(c.category, 'unknown') AS category, coalesce(c.type, 'unknown') AS type,
           chi.cpu_count, chi.audio_count, chi.speakers, dis.count AS screens, k.category AS listed, m.sampleof <> '' OR m.samples = 'yes' AS samples, m.isbios = 'yes' AS bios,
           CASE WHEN k.category IS NOT NULL THEN '{PREFIX}' || pg.page || ' is ' || CASE WHEN m.disk_regions LIKE 'laserdisc%' THEN 'an interactive ' ELSE 'a ' END || k.category || ' game' || CASE WHEN vec.machine IS NOT NULL THEN ' featuring vector graphics' ELSE '' END
                || CASE WHEN m.year = '' AND {_MAKER} = '' THEN '' ELSE CASE WHEN vec.machine IS NOT NULL THEN ',' ELSE '' END || ' published' || CASE WHEN m.year <> '' THEN ' in ' || m.year ELSE '' END || CASE WHEN {_MAKER} <> '' THEN ' by ' || {_MAKER} ELSE '' END END || '.' END AS sentence
    FROM v_machines m JOIN sho ON sho.parent = m.name JOIN src ON src.parent = m.name JOIN pg ON pg.name = m.name LEFT JOIN red ON red.parent = m.name LEFT JOIN tit ON tit.parent = m.name LEFT JOIN rom ON rom.name = m.name LEFT JOIN items ON items.machine = m.name
    LEFT JOIN chi ON chi.machine = m.name LEFT JOIN dis ON dis.machine = m.name LEFT JOIN con ON con.machine = m.name LEFT JOIN ids ON ids.parent = m.name LEFT JOIN v_class c ON c.machine = m.name LEFT JOIN v_catlist k ON k.machine = m.name
    LEFT JOIN (SELECT DISTINCT machine FROM v_displays WHERE type = 'vector') vec ON vec.machine = m.name"""


@query("assemble_parent_record", f"SELECT name, page, redirects, sentence, year, manufacturer, family, sources, gh_ids, game_status, category, type, coalesce(cpu_count, 0) AS cpus, coalesce(audio_count, 0) AS audio, coalesce(speakers, 0) AS speakers, coalesce(screens, 0) AS screens, listed, samples, bios FROM ({RECORDS})")
def assemble_parent_record(v: Views):
    source = lambda role: lambda s: F.concat_ws(":", F.lit(role), s["machine"], F.coalesce(s["gh_id"].cast("string"), F.lit("")), F.aggregate(F.map_values(s["categories"]), F.lit(0), lambda n, rows: n + F.size(rows)), F.size(s["categories"]))
    own = F.when(F.col("ports.parent_source").isNotNull(), F.array(source("parent")(F.col("ports.parent_source")))).otherwise(F.array().cast("array<string>"))
    sources = F.array_join(F.concat(own, F.transform("ports.clone_sources", source("clone"))), "|")
    return records(v).select(
        "name", F.col("wiki_page_name").alias("page"), F.array_join("wiki_redirects", "|").alias("redirects"), F.col("opening_sentence").alias("sentence"), "year", "manufacturer", F.array_join(F.transform("mame_titles", lambda t: t["machine"]), "|").alias("family"), sources.alias("sources"),
        F.array_join("gh_ids", "|").alias("gh_ids"), "game_status", F.array_join("category", ",").alias("category"), "type", F.col("chips.cpus.count").alias("cpus"), F.col("chips.audio_chips.count").alias("audio"), F.col("chips.speakers").alias("speakers"), F.col("displays.count").alias("screens"),
        F.col("snaps_classification.category").alias("listed"), F.col("requires_samples").alias("samples"), F.col("isbios").alias("bios"),
    )


@query("project_wiki", f"SELECT name, page, sentence, redirects, year, manufacturer, titles, roms, chips, displays, controls, ports, gh_ids FROM ({RECORDS}) WHERE name IN ({ELIGIBLE})")
def project_wiki(v: Views):
    out = B.project_wiki(records(v), L.eligible_parents(v.machines, classes(v))).select("name", "record.*")
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("ports_display")), lambda e: F.concat(F.upper(e["key"]), F.lit(":"), F.array_join(e["value"], "\n"))), "\n")
    return out.select(
        "name", F.col("wiki_page_name").alias("page"), F.col("opening_sentence").alias("sentence"), F.array_join("wiki_redirects", "|").alias("redirects"), "year", "manufacturer", F.array_join("mame_titles_display", "\n").alias("titles"), F.col("roms_display").alias("roms"), F.col("chips_display").alias("chips"),
        F.col("displays_display").alias("displays"), F.col("controls_display").alias("controls"), lines.alias("ports"), F.coalesce(F.array_join("gh_ids", "|"), F.lit("")).alias("gh_ids"),
    )


@query("project_raw", f"SELECT name, page, redirects, family, year, manufacturer, coalesce(cpu_count, 0) AS cpus, coalesce(screens, 0) AS screens, array_length(string_split(sources, '|')) - CASE WHEN sources LIKE 'parent%' THEN 1 ELSE 0 END AS clones, sources LIKE 'parent%' AS own, game_status, category, type, listed, gh_ids FROM ({RECORDS})")
def project_raw(v: Views):
    """From the JSON of the records, as a reader of the document would."""
    raw = B.project_raw(records(v)).select("name", F.parse_json(F.to_json("record")).alias("r"))
    get = lambda path, kind="string": F.try_variant_get("r", f"$.{path}", kind)
    listed = lambda path, sep: F.array_join(get(path, "array<string>"), sep)
    family = F.array_join(F.transform(get("mame_titles", "array<variant>"), lambda t: F.variant_get(t, "$.machine", "string")), "|")
    return raw.select(
        "name", get("wiki_page_name").alias("page"), listed("wiki_redirects", "|").alias("redirects"), family.alias("family"), get("year").alias("year"), get("manufacturer").alias("manufacturer"), get("chips.cpus.count", "bigint").alias("cpus"), get("displays.count", "bigint").alias("screens"),
        F.size(get("ports.clone_sources", "array<variant>")).cast("bigint").alias("clones"), get("ports.parent_source.machine").isNotNull().alias("own"), get("game_status").alias("game_status"), listed("category", ",").alias("category"), get("type").alias("type"), get("snaps_classification.category").alias("listed"), listed("gh_ids", "|").alias("gh_ids"),
    )

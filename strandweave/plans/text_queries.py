"""Queries of article text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import articles as A
from ..operators import blocks as B
from ..operators import ordering as O
from ..operators import records as C
from .views import Views, query

_HEAD = "regexp_extract(line, '^-+\\s+([A-Za-z0-9 &]+)\\s+-+$', 1)"
_CANON = f"CASE upper({_HEAD}) WHEN 'TIPS & TRICKS' THEN 'TIPS AND TRICKS' WHEN 'UPDATE' THEN 'UPDATES' ELSE upper({_HEAD}) END"
SECTIONED = f"""SELECT machine, line_no, line, coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY machine ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'OPENING') AS section, h
                FROM (SELECT *, CASE WHEN {_HEAD} <> '' THEN {_CANON} END AS h FROM v_lines)"""


@query("sections_from_lines", f"SELECT machine, line_no, line, section FROM ({SECTIONED}) WHERE h IS NULL")
def sections_from_lines(v: Views):
    return A.sections_from_lines(v.lines)


@query("canonical_headings", f"""WITH h AS (SELECT DISTINCT x AS heading FROM (SELECT unnest([{_HEAD}, regexp_replace({_HEAD}, '(?i)trivia', 'TRIVIAL')]) AS x FROM v_lines WHERE {_HEAD} <> ''))
    SELECT heading, CASE upper(heading) WHEN 'TRIVIAL' THEN 'TRIVIA' WHEN 'TIPS & TRICKS' THEN 'TIPS AND TRICKS' WHEN 'UPDATE' THEN 'UPDATES' ELSE upper(heading) END AS canonical,
           CASE upper(heading) WHEN 'TRIVIAL' THEN 'fuzzy' WHEN 'TIPS & TRICKS' THEN 'alias' WHEN 'UPDATE' THEN 'alias' END AS via FROM h""")
def canonical_headings(v: Views):
    odd = v.lines.select(F.regexp_extract("line", A.BANNER, 1).alias("heading")).where("heading <> ''")
    made = odd.select(F.regexp_replace("heading", "(?i)trivia", "TRIVIAL").alias("heading"))
    return A.canonical_headings(odd.union(made))


_NORM = f"upper({_HEAD})"


@query("heading_quality", f"""SELECT {_NORM} AS heading, h AS canonical, CASE WHEN {_NORM} IN ('TIPS & TRICKS', 'UPDATE') THEN 'alias' END AS via, {_NORM} IN ('TRIVIA', 'UPDATES', 'PORTS', 'CONTRIBUTE') AS standard, count(*) AS n, count(DISTINCT machine) AS systems
    FROM ({SECTIONED}) WHERE h IS NOT NULL GROUP BY 1, 2, 3, 4 UNION ALL SELECT '-Foo-', NULL, 'near_miss', FALSE, count(*), count(DISTINCT machine) FROM v_lines WHERE line = '-Foo-' HAVING count(*) > 0""")
def heading_quality(v: Views):
    return A.heading_quality(v.lines)


@query("near_miss_banners", "SELECT machine, line_no, line FROM v_lines WHERE line = '-Foo-'")
def near_miss_banners(v: Views):
    return v.lines.where(A.near_miss_banner(F.col("line"))).select("machine", "line_no", "line")


@query("entry_gh_id", f"SELECT machine, CAST(arg_min(regexp_extract(line, 'id=([0-9]+)', 1), line_no) AS BIGINT) AS source_id FROM ({SECTIONED}) WHERE section = 'CONTRIBUTE' AND line LIKE '%id=%' GROUP BY 1")
def entry_gh_id(v: Views):
    return A.article_ids(A.sections_from_lines(v.lines))


_FORMS = """SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS line_no, o_orderkey % 8 AS k,
    CASE o_orderkey % 8 WHEN 0 THEN 'Main CPU : Z80' WHEN 1 THEN 'Players : 2' WHEN 2 THEN 'Display : 320 x 240' WHEN 3 THEN 'A narrative line, with words; and more.' WHEN 4 THEN '' WHEN 5 THEN 'Display: 256 colors' WHEN 6 THEN '=> [A] fire' ELSE 'Controls per player - 8-way' END AS line, 'TECHNICAL' AS section FROM orders"""
_RULES = """CASE k WHEN 0 THEN 'technical_cpu_line' WHEN 1 THEN 'technical_players_line' WHEN 2 THEN 'technical_display_resolution_line' WHEN 5 THEN 'technical_display_colours_line' WHEN 6 THEN 'technical_control_mapping_line' WHEN 7 THEN 'technical_control_per_player_line' END"""


def technical(v: Views):
    return v.spark.sql(_FORMS.replace("FROM orders", "FROM {orders}"), orders=v.table("orders")).drop("k")


@query(
    "suppress_lines",
    f"""WITH r AS (SELECT *, {_RULES} AS rule FROM ({_FORMS})), s AS (SELECT *, rule IS NULL AS kept FROM r),
        g AS (SELECT *, max(CASE WHEN kept THEN line_no END) OVER w AS lk, max(CASE WHEN NOT kept THEN line_no END) OVER w AS lg FROM s WINDOW w AS (PARTITION BY machine ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT machine, line_no, rule, kept, kept AND line <> '' AND lg IS NOT NULL AND (lk IS NULL OR lg > lk) AS gap_before FROM g""",
)
def suppress_lines(v: Views):
    return A.suppress_lines(technical(v)).select("machine", "line_no", "rule", "kept", "gap_before")


@query("suppression_counts", f"SELECT {_RULES} AS rule, count(*) AS n, count(DISTINCT machine) AS systems FROM ({_FORMS}) WHERE k NOT IN (3, 4) GROUP BY 1")
def suppression_counts(v: Views):
    return A.suppression_counts(A.suppress_lines(technical(v)))


_P = """SELECT machine, line_no, line, line_no % 12 AS k, CAST(extract(year FROM o_orderdate) AS STRING) AS y, lpad(CAST(extract(day FROM o_orderdate) AS STRING), 2, '0') AS d FROM v_port_lines JOIN orders ON line_no = o_orderkey AND machine = 'c' || CAST(o_custkey AS STRING)"""
PORT = f"""SELECT machine, line_no, line,
    CASE k WHEN 0 THEN 'JP,US' WHEN 1 THEN 'EU' WHEN 2 THEN 'US' WHEN 7 THEN 'US' WHEN 11 THEN 'US' ELSE '' END AS regions,
    CASE k WHEN 0 THEN 'Super Box' WHEN 1 THEN 'Home Computer' WHEN 4 THEN 'Handheld' WHEN 5 THEN 'Odd "quote' WHEN 6 THEN 'Odd bracket (1991' WHEN 7 THEN 'Console' WHEN 8 THEN 'Thing' WHEN 9 THEN 'Box' WHEN 10 THEN 'Plain Platform'
      WHEN 2 THEN 'Floppy PC 3.5Disk: Game"' END AS platform,
    CASE k WHEN 0 THEN 'ABC-1|ABC-2' WHEN 7 THEN 'X100|X100A' WHEN 9 THEN 'Z (other)' ELSE '' END AS model,
    CASE k WHEN 0 THEN 'Great Game' WHEN 3 THEN 'Only Title' WHEN 7 THEN 'T' END AS title,
    CASE k WHEN 0 THEN y || '-XX-XX' WHEN 1 THEN y || '-05-' || d WHEN 2 THEN '19XX-XX-XX' WHEN 5 THEN '1991-XX-XX' WHEN 7 THEN '1992-XX-XX' WHEN 9 THEN '1989-XX-XX' END AS date,
    CASE k WHEN 0 THEN 'Maker, Inc' WHEN 1 THEN 'Some House' WHEN 2 THEN 'released by Other' WHEN 4 THEN 'Somebody' WHEN 7 THEN 'Publisher only' END AS publisher,
    CASE k WHEN 1 THEN 'a "quoted: part" here' WHEN 8 THEN 'comment only' END AS comment,
    CASE k WHEN 7 THEN 'Budget' ELSE '' END AS tags, CASE k WHEN 3 THEN 'soon' ELSE '' END AS residue,
    CASE k WHEN 0 THEN 'by' WHEN 1 THEN 'by' WHEN 2 THEN 'released_by' WHEN 4 THEN 'by' WHEN 7 THEN 'other_after_date' ELSE 'none' END AS indicator FROM ({_P})"""


def parsed(v: Views):
    return A.parse_port_lines(v.port_lines)


@query("parse_port_lines", PORT)
def parse_port_lines(v: Views):
    return parsed(v).withColumns({"regions": F.array_join("regions", ","), **{c: F.array_join(c, "|") for c in ("model", "tags", "residue")}})


@query("publisher_indicators", f"SELECT indicator, count(*) AS n FROM ({PORT}) GROUP BY 1")
def publisher_indicators(v: Views):
    return parsed(v).groupBy("indicator").agg(F.count("*").alias("n"))


FINDINGS = f"""SELECT CASE k WHEN 3 THEN 'ports.unparsable_date' WHEN 5 THEN 'ports.odd_quotes' ELSE 'ports.odd_brackets' END AS rule_id, machine, line AS source_text, CASE k WHEN 3 THEN 'soon' END AS value FROM ({_P}) WHERE k IN (3, 5, 6)"""


@query("port_line_findings", FINDINGS)
def port_line_findings(v: Views):
    return A.port_line_findings(parsed(v))


#: Lines of PORTS sections in context, by the 23 forms that lines of the view take.
CONTEXT = f"""(SELECT *, CASE WHEN k IN (9, 18) THEN 'category' WHEN NOT begun THEN CASE WHEN k = 2 THEN 'blank' ELSE 'overview' END WHEN k = 2 THEN 'blank' WHEN banner THEN 'banner' WHEN category IS NULL THEN 'skipped' ELSE 'port' END AS kind,
        max(CASE WHEN banner THEN line END) OVER (PARTITION BY machine, block) AS platform_context
    FROM (SELECT *, begun AND coalesce(lag(k) OVER w IN (2, 9), TRUE) AND k IN (3, 7, 12, 22) AND coalesce(lead(k) OVER w IN (5, 6, 10, 14, 16, 17, 19, 20), FALSE) AS banner
        FROM (SELECT machine, line_no, line, line_no % 23 AS k, nullif(last_value(CASE line_no % 23 WHEN 9 THEN 'CONSOLES' WHEN 18 THEN '' END IGNORE NULLS) OVER u, '') AS category,
                bool_or(line_no % 23 = 9) OVER u AS begun, sum(CASE WHEN line_no % 23 IN (2, 9, 18) THEN 1 ELSE 0 END) OVER u AS block
            FROM ({SECTIONED}) WHERE section = 'PORTS' AND h IS NULL
            WINDOW u AS (PARTITION BY machine ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) WINDOW w AS (PARTITION BY machine ORDER BY line_no)))"""
NOTES = f"""SELECT machine, 'near_miss_banner' AS rule_id, line_no, line AS item FROM v_lines WHERE line = '-Foo-'
    UNION ALL SELECT machine, 'unmapped_heading', line_no, h FROM ({SECTIONED}) WHERE h LIKE 'ODDITIES%'
    UNION ALL SELECT machine, 'missing_subheadings', min(line_no), coalesce(substr(string_agg(line, ' ' ORDER BY line_no) FILTER (WHERE k NOT IN (2, 18)), 1, 140), '') FROM {CONTEXT} GROUP BY machine HAVING NOT bool_or(k = 9)
    UNION ALL SELECT machine, 'unexpected_category', line_no, 'ARCADE' FROM {CONTEXT} WHERE k = 18
    UNION ALL SELECT machine, 'platform_banner', line_no, line FROM {CONTEXT} WHERE kind = 'banner'
    UNION ALL SELECT machine, 'null_platform', line_no, line FROM {CONTEXT} WHERE kind = 'port' AND k = 19 AND platform_context IS NULL
    UNION ALL SELECT machine, 'residue', line_no, NULL FROM {CONTEXT} WHERE kind = 'port' AND k = 19
    UNION ALL SELECT machine, 'ports.unparsable_date', line_no, 'soon' FROM {CONTEXT} WHERE kind = 'port' AND k = 19
    UNION ALL SELECT machine, CASE k WHEN 5 THEN 'ports.odd_brackets' ELSE 'ports.odd_quotes' END, line_no, line FROM {CONTEXT} WHERE kind = 'port' AND k IN (5, 20)"""


@query("port_anomalies", f"""WITH n AS ({NOTES}), d AS (SELECT rule_id, item, row_number() OVER (PARTITION BY rule_id ORDER BY item) AS p FROM (SELECT DISTINCT rule_id, item FROM n WHERE item <> ''))
    SELECT rule_id, count(*) AS n, count(DISTINCT machine) AS systems, coalesce((SELECT string_agg(item, '|' ORDER BY p) FROM d WHERE d.rule_id = n.rule_id AND p <= 3), '') AS examples FROM n GROUP BY 1""")
def port_anomalies(v: Views):
    return A.note_counts(A.article_notes(v.lines)).withColumn("examples", F.array_join("examples", "|"))


@query("structural_observations", f"""WITH g AS (SELECT machine, rule_id, CASE WHEN rule_id IN ('near_miss_banner', 'null_platform') THEN line_no END AS line_at, item, count(*) AS n FROM ({NOTES}) WHERE rule_id NOT LIKE 'ports.%' GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY machine, rule_id ORDER BY line_at, lower(item), item) AS place FROM g)
    SELECT machine, rule_id, CAST(sum(n) AS BIGINT) AS total, coalesce(string_agg(CASE rule_id WHEN 'platform_banner' THEN item || ' (' || n || ' occurrence(s))' ELSE item END, '|' ORDER BY place) FILTER (WHERE item <> '' AND place <= CASE rule_id WHEN 'null_platform' THEN 3 ELSE 12 END), '') AS items,
           CASE rule_id WHEN 'null_platform' THEN 0 ELSE greatest(0, count(*) FILTER (WHERE item <> '') - 12) END AS omitted FROM r GROUP BY 1, 2""")
def structural_observations(v: Views):
    return A.structural_observations(A.article_notes(v.lines)).withColumn("items", F.array_join("items", "|"))


@query(
    "found_values",
    f"""WITH p AS ({PORT}), t AS (SELECT machine, 'platform' AS kind, platform AS value FROM p UNION SELECT machine, 'publisher', publisher FROM p UNION SELECT machine, 'comment', comment FROM p UNION SELECT machine, 'title', title FROM p
          UNION SELECT machine, 'model', unnest(string_split(model, '|')) FROM p WHERE model <> '' UNION SELECT machine, 'tags', tags FROM p WHERE tags <> '' UNION SELECT machine, 'regions', unnest(string_split(regions, ',')) FROM p WHERE regions <> '' UNION SELECT machine, 'inch_mark', '3.5' FROM p WHERE line LIKE '%3.5"%')
        , n AS (SELECT machine, CAST((row_number() OVER (ORDER BY machine) - 1) // 1000 AS INT) AS bucket FROM (SELECT DISTINCT machine FROM t WHERE value IS NOT NULL))
        SELECT kind, value, bucket, CAST(sum(count(*)) OVER (PARTITION BY kind, value) AS BIGINT) AS systems, md5(string_agg(machine, '|' ORDER BY machine)) AS machines FROM t JOIN n USING (machine) WHERE value IS NOT NULL GROUP BY 1, 2, 3""",
)
def found_values(v: Views):
    return A.found_values(parsed(v)).withColumn("machines", F.md5(F.array_join("machines", "|")))


_ENTRIES = "SELECT CASE o_orderkey % 3 WHEN 0 THEN 'systems' WHEN 1 THEN 'software' ELSE 'unknown' END AS kind, o_orderkey % 6 = 0 AS aliased, 'c' || CAST(o_custkey AS STRING) AS machine FROM orders"


@query(
    "entry_totals",
    f"""SELECT count(*) AS entries, count(*) FILTER (WHERE kind = 'systems') AS systems, count(*) FILTER (WHERE kind = 'software') AS software, count(*) FILTER (WHERE kind = 'systems' AND aliased) AS with_aliases,
        (SELECT count(DISTINCT machine) FROM ({PORT})) AS with_ports, (SELECT count(*) FROM ({PORT})) AS port_lines, (SELECT count(comment) FROM ({PORT})) AS with_comments, (SELECT count(DISTINCT machine) FROM {CONTEXT} WHERE kind = 'overview') AS with_overview FROM ({_ENTRIES})""",
)
def entry_totals(v: Views):
    context = A.port_line_context(A.sections_from_lines(v.lines).where(F.col("section") == "PORTS"))
    entries = v.spark.sql(_ENTRIES.replace("FROM orders", "FROM {orders}"), orders=v.table("orders")).withColumn("aliases", F.when(F.col("aliased"), F.array(F.lit("alias"))).otherwise(F.array()))
    return C.entry_totals(entries, parsed(v), context.where("kind = 'overview'"))


@query("port_line_context", f"SELECT machine, line_no, line, 'PORTS' AS section, kind, category, platform_context FROM {CONTEXT}")
def port_line_context(v: Views):
    lines = A.sections_from_lines(v.lines).where(F.col("section") == "PORTS")
    return A.port_line_context(lines)


FLAGS = """SELECT machine, line_no, line, line = '' AS blank, regexp_full_match(line, '\\s*-+\\s*') AS hyphens, regexp_matches(line, '^\\s*[*\\-]\\s+\\S') AS bullet, regexp_matches(line, '^\\s*(?:\\d+[)\\].]|[\\[(]\\d+[\\])])\\s+\\S') AS numbered,
    regexp_matches(line, '^[A-Z0-9][A-Z0-9 \\-&''/]+:?$') AS caps, line LIKE 'Label :%' OR line LIKE 'https:%' OR line LIKE '*Emphasis*:%' AS pair FROM v_lines"""


@query("line_flags", FLAGS)
def line_flags(v: Views):
    return B.line_flags(v.lines).select("machine", "line_no", "line", "blank", "hyphens", "bullet", "numbered", "caps", "pair")


@query("section_policy", """WITH l AS (SELECT 'c' || CAST(o_custkey AS STRING) AS machine, CASE WHEN o_custkey % 2 = 0 THEN 'UPDATES' ELSE 'TRIVIA' END AS section, o_orderkey % 9 = 0 AS st FROM orders)
    SELECT machine, section, section = 'TRIVIA' OR (NOT bool_or(st) AND count(*) > 1) AS per_line, section = 'UPDATES' AND NOT bool_or(st) AND count(*) > 1 AS heuristic FROM l GROUP BY 1, 2""")
def section_policy(v: Views):
    o = v.table("orders")
    lines = o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine"), F.col("o_orderkey").alias("line_no"), F.when(F.col("o_custkey") % 2 == 0, "UPDATES").otherwise("TRIVIA").alias("section"), F.when(F.col("o_orderkey") % 9 == 0, "* item").otherwise("words").alias("line"))
    return B.section_policy(B.line_flags(lines))


@query(
    "list_blocks",
    """WITH l AS (SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS line_no, CASE o_orderkey % 7 WHEN 0 THEN 'b' WHEN 1 THEN 'b' WHEN 2 THEN 'n' WHEN 3 THEN 'n' ELSE NULL END AS kind FROM orders),
       s AS (SELECT *, CASE WHEN kind IS NOT DISTINCT FROM lag(kind) OVER (PARTITION BY machine ORDER BY line_no) AND kind IS NOT NULL THEN 0 ELSE 1 END AS st FROM l), i AS (SELECT *, sum(st) OVER (PARTITION BY machine ORDER BY line_no) AS isl FROM s)
       SELECT machine, min(line_no) AS first_line, CASE kind WHEN 'b' THEN 'bullet_list' ELSE 'numbered_list' END AS kind, string_agg('item ' || line_no, '|' ORDER BY line_no) AS items FROM i WHERE kind IS NOT NULL GROUP BY machine, kind, isl""",
)
def list_blocks(v: Views):
    k, n = F.col("o_orderkey") % 7, F.col("o_orderkey").cast("string")
    line = F.when(k < 2, F.concat(F.lit("* item "), n)).when(k < 4, F.concat(F.lit("1) item "), n)).otherwise("Words end.")
    lines = v.table("orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine"), F.col("o_orderkey").alias("line_no"), F.lit("TRIVIA").alias("section"), line.alias("line"))
    return B.list_blocks(B.line_flags(lines)).select("machine", "first_line", "kind", F.array_join("items", "|").alias("items"))


def blocks(v: Views):
    o = F.col("o_orderkey")
    kind = F.when(o % 5 == 0, "bullet_list").otherwise("paragraph")
    return v.table("orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine"), F.lit("TRIVIA").alias("section"), o.alias("block_index"), kind.alias("type"), F.when(o % 3 == 0, "Intro:").otherwise("Text.").alias("text"), o.alias("first_line"), (o + F.when(o % 2 == 0, 0).otherwise(2)).alias("last_line"))


_BLOCKS = "SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS block_index, CASE WHEN o_orderkey % 5 = 0 THEN 'bullet_list' ELSE 'paragraph' END AS type, CASE WHEN o_orderkey % 3 = 0 THEN 'Intro:' ELSE 'Text.' END AS text, o_orderkey AS first_line, o_orderkey + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 2 END AS last_line FROM orders"


@query(
    "suspect_hard_wraps",
    f"""SELECT machine, block_index, type = 'paragraph' AND (coalesce(lag(type) OVER w = 'paragraph' AND lag(last_line) OVER w + 1 = first_line, FALSE) OR coalesce(lead(type) OVER w = 'paragraph' AND last_line + 1 = lead(first_line) OVER w, FALSE)) AS hard_wrap
        FROM ({_BLOCKS}) WINDOW w AS (PARTITION BY machine ORDER BY block_index)""",
)
def suspect_hard_wraps(v: Views):
    return B.suspect_hard_wraps(blocks(v)).select("machine", "block_index", "hard_wrap")


@query(
    "attach_preambles",
    f"""SELECT machine, block_index, CASE WHEN type = 'paragraph' AND text LIKE '%:' AND lead(type) OVER w = 'bullet_list' THEN lead(block_index) OVER w END AS preamble_target,
        CASE WHEN type = 'bullet_list' AND lag(type) OVER w = 'paragraph' AND lag(text) OVER w LIKE '%:' THEN lag(text) OVER w END AS preamble_text FROM ({_BLOCKS}) WINDOW w AS (PARTITION BY machine ORDER BY block_index)""",
)
def attach_preambles(v: Views):
    return B.attach_preambles(blocks(v)).select("machine", "block_index", "preamble_target", "preamble_text")


@query("block_counts", "SELECT 'type' AS metric, type AS bucket, count(*) AS n, count(DISTINCT machine) AS systems FROM v_blocks_before GROUP BY 2 UNION ALL SELECT 'section', section, count(*), count(DISTINCT machine) FROM v_blocks_before GROUP BY 2")
def block_counts(v: Views):
    return C.block_counts(v.blocks_before)


@query("neighbour_navigation", "SELECT name, coalesce(lag(name) OVER w, (SELECT max(name) FROM v_machines)) AS previous, coalesce(lead(name) OVER w, (SELECT min(name) FROM v_machines)) AS next FROM v_machines WINDOW w AS (ORDER BY name)")
def neighbour_navigation(v: Views):
    return O.with_neighbours(v.machines.select("name"), "name", [F.col("name")])

"""Queries of whole records, reports, manifests and text blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks as B
from ..operators import metrics as M
from ..operators import ports as P
from ..operators import quality_rules as R
from ..operators import records as C
from ..sources.archives import audit_archives
from ..sources.files import entry_header
from ..sources.files import scan_overrides as scan_overrides_file
from ..sources.scratch import scratch_path
from .lineage_queries import VALID, ports
from .section_queries import DIST, dist
from .source_queries import FILE_ROWS
from .text_queries import FINDINGS, PORT, parsed
from .views import Views, query


@query("entry_kind", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'systems' WHEN 1 THEN 'software' ELSE 'unknown' END AS kind, CASE WHEN o_orderkey % 3 = 0 THEN 'c' || CAST(o_custkey AS STRING) END AS primary_name, CASE WHEN o_orderkey % 6 = 0 THEN 'alias' ELSE '' END AS aliases FROM orders")
def entry_kind(v: Views):
    k = F.col("o_orderkey")
    named = lambda *names: F.array(*(F.struct(n.alias("_name")) for n in names))
    name = F.concat(F.lit(" c"), F.col("o_custkey").cast("string"))
    systems = F.when(k % 6 == 0, named(F.lit(""), name, F.lit("alias"))).when(k % 3 == 0, named(name))
    header = entry_header(systems, F.when(k % 3 == 1, F.lit("x")))
    return v.table("orders").select("o_orderkey", header.alias("h")).select("o_orderkey", "h.kind", "h.primary_name", F.array_join("h.aliases", "|").alias("aliases"))


@query("scan_overrides", "SELECT machine, new_description, only_if_unbalanced, note FROM v_overrides")
def scan_overrides(v: Views):
    rows = v.overrides.withColumn("part", F.pmod(F.xxhash64("machine"), F.lit(max(1, v.overrides.count() // FILE_ROWS))))
    value = F.struct(F.col("new_description").alias("description"), F.when(~F.col("only_if_unbalanced"), False).alias("apply_if_unbalanced"), F.nullif("note", F.lit("")).alias("note"))
    objects = rows.groupBy("part").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("machine", value)))).alias("value"))
    path = scratch_path(v.spark, "overrides")
    objects.write.partitionBy("part").text(path)
    return scan_overrides_file(v.spark, path + "/part=*").union(scan_overrides_file(v.spark, path + "/no-such-file"))


def _metrics(v: Views):
    m = v.machines
    return C.counters({"machines": m, "clones": m.where("cloneof is not null"), "entries": v.obs, "findings": v.findings, "ports": P.valid_ports(ports(v))}, "run")


_COUNTS = f"""SELECT 'machines' AS metric, count(*) AS n FROM v_machines UNION ALL SELECT 'clones', count(*) FROM v_machines WHERE cloneof IS NOT NULL UNION ALL SELECT 'entries', count(*) FROM v_obs
              UNION ALL SELECT 'findings', count(*) FROM v_findings UNION ALL SELECT 'ports', count(*) FROM ({VALID})"""


@query("transform_counts", _COUNTS)
def transform_counts(v: Views):
    return _metrics(v).select("metric", "n")


@query("release_quick_stats", f"WITH c AS ({_COUNTS}) SELECT CAST(max(n) FILTER (WHERE metric = 'machines') AS BIGINT) AS machines, CAST(max(n) FILTER (WHERE metric = 'clones') AS BIGINT) AS clones, CAST(max(n) FILTER (WHERE metric = 'findings') AS BIGINT) AS findings FROM c")
def release_quick_stats(v: Views):
    return C.quick_stats(_metrics(v), ["machines", "clones", "findings"])


_HEADERS = "SELECT stage, CASE WHEN stage = 'machines' THEN '0.' || max(size) END AS build, CASE WHEN stage = 'articles' THEN '' END AS told, CASE WHEN stage = 'articles' THEN '2.' || min(size) END AS legacy, CASE WHEN stage = 'lists' THEN ' ' END AS listed FROM {0} GROUP BY stage"


@query("stage_versions", f"SELECT max(build) AS machines, max(legacy) AS articles, CASE WHEN max(trim(listed)) <> '' THEN max(listed) ELSE ' ' END AS lists, 'Unknown' AS other FROM ({_HEADERS.format('v_files_after')})")
def stage_versions(v: Views):
    headers = v.spark.sql(_HEADERS.format("{files}"), files=v.files_after).withColumn("none", F.lit(None).cast("string"))
    return C.stage_versions(headers, {"machines": ["build"], "articles": ["told", "legacy"], "lists": ["listed"], "other": ["none", "told"]})


@query(
    "diagnostic_groups",
    f"""WITH f AS ({FINDINGS}), d AS (SELECT DISTINCT rule_id, machine FROM f)
        SELECT f.rule_id, count(*) AS n, count(DISTINCT f.machine) AS systems, count(DISTINCT b.machine) AS linked, (SELECT string_agg(machine, '|' ORDER BY machine) FROM (SELECT machine FROM d WHERE d.rule_id = f.rule_id ORDER BY machine LIMIT 5)) AS examples
        FROM f LEFT JOIN v_before b ON f.machine = b.machine GROUP BY 1""",
)
def diagnostic_groups(v: Views):
    from ..operators.articles import port_line_findings

    return C.diagnostics(port_line_findings(parsed(v)), v.before).withColumn("examples", F.array_join("examples", "|"))


@query("stage_reports", f"""WITH d AS ({DIST}), t AS (SELECT metric, bucket, n, row_number() OVER (PARTITION BY metric ORDER BY n DESC, lower(bucket), bucket) AS place FROM d)
    SELECT metric, 'top' AS part, bucket, n FROM t WHERE place <= 5 UNION ALL SELECT metric, 'total', '', CAST(sum(n) AS BIGINT) FROM d GROUP BY 1""")
def stage_reports(v: Views):
    d = dist(v)
    top = M.top_groups(d, 5).select("metric", F.lit("top").alias("part"), "bucket", "n")
    return top.union(M.distribution_totals(d).select("metric", F.lit("total"), F.lit(""), "total"))


_ARCHIVES = """SELECT path, stage, size, CASE stage WHEN 'machines' THEN 'dir/mame0' || (200 + size) || 'lx.zip' WHEN 'articles' THEN 'History' || (200 + size) || 'b.ZIP' ELSE 'readme.txt' END AS name,
    CASE WHEN size % 5 = 0 THEN NULL WHEN stage = 'machines' THEN '0.' || (CASE WHEN size % 7 = 0 THEN 199 ELSE 200 + size END) || ' (mame0200)' ELSE '2.' || lpad(CAST(size AS STRING), 2, '0') || 'a' END AS version, size % 13 <> 0 AS readable FROM {0}"""


@query("archive_audit", f"""SELECT path, stage, CASE stage WHEN 'machines' THEN 'mame' WHEN 'articles' THEN 'gaming_history' ELSE 'unknown' END AS provider, CASE WHEN stage <> 'lists' THEN '0' || (200 + size) END AS release,
    CASE WHEN NOT readable THEN 'error' WHEN stage = 'machines' AND size % 5 <> 0 AND size % 7 = 0 THEN 'mismatch' WHEN stage = 'lists' OR size % 5 = 0 THEN 'unverified' ELSE 'verified' END AS outcome FROM ({_ARCHIVES.format('v_files_after')})""")
def archive_audit(v: Views):
    archives = v.spark.sql(_ARCHIVES.format("{files}"), files=v.files_after).withColumn("expected", F.concat(F.lit("0"), (F.col("size") + 200).cast("string")))
    return audit_archives(archives).select("path", "stage", "provider", "release", "outcome")


@query(
    "expect_entry_counts",
    f"""SELECT * FROM (SELECT 'systems_and_software' AS rule, (SELECT count(*) FILTER (WHERE o_orderkey % 3 <> 2) FROM orders) AS left, (SELECT count(*) FROM orders) AS right
        UNION ALL SELECT 'keyed_systems', (SELECT count(DISTINCT o_custkey) FILTER (WHERE o_orderkey % 3 = 0) FROM orders), (SELECT count(*) FILTER (WHERE o_orderkey % 3 = 0) FROM orders)
        UNION ALL SELECT 'platforms_and_nulls', (SELECT count(*) + 5 FROM ({PORT})), (SELECT count(*) FROM ({PORT})) UNION ALL SELECT 'null_platforms', (SELECT count(*) FROM ({PORT}) WHERE platform IS NULL), (SELECT count(*) + 5 FROM ({PORT}) WHERE platform IS NULL)
        UNION ALL SELECT 'banners', (SELECT count(*) FROM v_lines WHERE line LIKE '%- PORTS -%'), (SELECT count(*) FROM v_lines WHERE line LIKE '%- PORTS -%')) t WHERE t."left" <> t."right"
        UNION ALL SELECT * FROM (SELECT 'systems_with_ports' AS rule, (SELECT count(DISTINCT machine) FROM ({PORT})) AS left, (SELECT count(*) FILTER (WHERE o_orderkey % 3 = 0) FROM orders) AS right
        UNION ALL SELECT 'overviews', (SELECT count(DISTINCT machine) FROM v_lines), (SELECT count(DISTINCT machine) FROM ({PORT}))
        UNION ALL SELECT 'unreadable_dates', (SELECT count(DISTINCT residue) FROM ({PORT}) WHERE residue <> ''), (SELECT count(DISTINCT machine) FROM ({PORT}) WHERE residue <> '')) t WHERE t."left" > t."right" """,
)
def expect_entry_counts(v: Views):
    from ..operators.metrics import distributions

    orders, p = v.table("orders"), parsed(v)
    kind = F.when(F.col("o_orderkey") % 3 == 0, "systems").when(F.col("o_orderkey") % 3 == 1, "software").otherwise("unknown")
    machine = F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine")
    platforms = distributions(p.where("platform is not null"), {"platform": F.col("platform")})
    banners = distributions(v.lines.where(F.contains("line", F.lit("- PORTS -"))), {"banner": F.col("line")})
    lines = p.agg(F.count("*").alias("n"), F.count_if(F.col("platform").isNull()).alias("bare")).first()
    told = {"port_lines": F.lit(lines["n"]), "null_platforms": F.lit(lines["bare"] + 5), "banners": F.lit(banners.agg(F.sum("n")).first()[0] or 0)}
    ports_ = p.select("machine", "platform", "residue", "date", F.get("residue", F.lit(0)).alias("raw_date"))
    return R.entry_invariants(orders.select(kind.alias("kind")), orders.where(F.col("o_orderkey") % 3 == 0).select(machine), ports_, platforms, banners, v.lines.select("machine"), told)


_RUNS = "SELECT stage, CASE WHEN size % 4 = 0 THEN 'output' ELSE 'input' END AS role, size, size * 10 AS records, CASE WHEN stage = 'lists' AND size = 13 THEN 'broken' END AS error FROM {0}"


@query("run_manifest", f"""SELECT stage, count(*) FILTER (WHERE role = 'input') AS inputs, CAST(coalesce(sum(size) FILTER (WHERE role = 'input'), 0) AS BIGINT) AS input_bytes, count(*) FILTER (WHERE role = 'output') AS outputs,
    CAST(coalesce(sum(size) FILTER (WHERE role = 'output'), 0) AS BIGINT) AS output_bytes, CAST(coalesce(sum(records) FILTER (WHERE role = 'output'), 0) AS BIGINT) AS records, max(size) - min(size) AS seconds, count(error) AS errors,
    count(*) FILTER (WHERE role = 'input') > 0 AND count(*) FILTER (WHERE role = 'output') > 0 AND count(error) = 0 AS ok FROM ({_RUNS.format('v_files_after')}) GROUP BY 1""")
def run_manifest(v: Views):
    runs = v.spark.sql(_RUNS.format("{files}"), files=v.files_after).withColumn("at", F.timestamp_seconds(F.col("size") + 1_700_000_000))
    return C.run_manifest(runs)


def lines(v: Views):
    k, n = F.col("o_orderkey") % 6, F.col("o_orderkey").cast("string")
    line = F.when(k == 0, "").when(k == 1, "HEADING HERE").when(k == 2, F.concat(F.lit("Label : v"), n)).when(k == 3, F.concat(F.lit("* item "), n)).otherwise(F.concat(F.lit("Words "), n, F.lit(".")))
    return v.table("orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine"), F.lit("SERIES").alias("section"), F.col("o_orderkey").alias("line_no"), line.alias("line"))


_KINDS = """k AS (SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS n, CASE o_orderkey % 6 WHEN 0 THEN 'break' WHEN 1 THEN 'subheading' WHEN 2 THEN 'pair' WHEN 3 THEN 'bullet_list' ELSE 'paragraph' END AS type,
         CASE o_orderkey % 6 WHEN 1 THEN 'HEADING HERE' WHEN 2 THEN 'Label=v' || o_orderkey WHEN 3 THEN 'item ' || o_orderkey ELSE 'Words ' || o_orderkey || '.' END AS body FROM orders),
    s AS (SELECT *, CASE WHEN type IN ('bullet_list', 'paragraph') AND type = lag(type) OVER (PARTITION BY machine ORDER BY n) THEN 0 ELSE 1 END AS st FROM k), i AS (SELECT *, sum(st) OVER (PARTITION BY machine ORDER BY n) AS b FROM s),
    g AS (SELECT machine, b, type, min(n) AS first_line, max(n) AS last_line, CASE type WHEN 'paragraph' THEN string_agg(body, chr(10) ORDER BY n) ELSE string_agg(body, '|' ORDER BY n) END AS body FROM i WHERE type <> 'break' GROUP BY machine, b, type)"""


@query("text_blocks", f"WITH {_KINDS} SELECT machine, CAST(row_number() OVER (PARTITION BY machine ORDER BY b) - 1 AS INT) AS block_index, type, body, first_line, last_line FROM g")
def text_blocks(v: Views):
    body = F.coalesce(F.array_join("items", "|"), F.concat("label", F.lit("="), "value"), "text")
    return B.text_blocks(lines(v)).select("machine", "block_index", "type", body.alias("body"), "first_line", "last_line")


@query("block_contract", f"WITH {_KINDS} SELECT type, count(*) AS n FROM g WHERE type <> 'pair' GROUP BY 1")
def block_contract(v: Views):
    odd = B.text_blocks(lines(v)).withColumn("value", F.lit(None).cast("string"))
    return B.block_contract(odd).groupBy("type").agg(F.count("*").alias("n"))


@query("promote_preambles", """WITH k AS (SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS n, o_orderkey % 4 = 0 AS colon FROM orders), o AS (SELECT *, row_number() OVER (PARTITION BY machine ORDER BY n) AS p FROM k),
    f AS (SELECT *, min(CASE WHEN colon THEN p END) OVER (PARTITION BY machine) AS op FROM o)
    SELECT machine, count(*) FILTER (WHERE op IS NULL OR p <= op) AS paragraphs, count(*) FILTER (WHERE p > op) AS items FROM f GROUP BY 1""")
def promote_preambles(v: Views):
    from pyspark.sql.window import Window

    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    rows = v.table("orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine"), F.lit("TRIVIA").alias("section"), place.alias("line_no"), F.when(F.col("o_orderkey") % 4 == 0, "Intro goes:").otherwise("Words end.").alias("line"))
    got = B.promote_preambles(B.text_blocks(rows))
    return got.groupBy("machine").agg(F.count_if(F.col("type") == "paragraph").alias("paragraphs"), F.coalesce(F.sum(F.when(F.col("type") == "bullet_list", F.size("items"))), F.lit(0)).alias("items"))


def topics(v: Views, section: str):
    k = F.col("o_orderkey") % 5
    one = F.when(k == 0, F.array(F.lit("Notes are:"), F.lit(""))).when(k < 4, F.array(F.concat(F.lit("* Topic "), k.cast("string"), F.lit(" : words")), F.lit("More of it"), F.lit(""))).otherwise(F.array(F.lit("* plain item"), F.lit("")))
    rows = v.table("orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine"), "o_orderkey", F.posexplode(one).alias("p", "line"))
    return B.line_flags(rows.select("machine", F.lit(section).alias("section"), (F.col("o_orderkey") * 10 + F.col("p")).alias("line_no"), "line"))


@query("overview_topics", """WITH k AS (SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS n, o_orderkey % 5 AS k FROM orders), g AS (SELECT *, k BETWEEN 1 AND 3 AS ok, lag(k) OVER (PARTITION BY machine ORDER BY n, k) AS pk FROM k),
    r AS (SELECT *, sum(CASE WHEN ok AND pk BETWEEN 1 AND 3 THEN 0 ELSE 1 END) OVER (PARTITION BY machine ORDER BY n) AS run FROM g), h AS (SELECT *, bool_or(ok AND pk = 0) OVER (PARTITION BY machine, run) AS led, count(*) FILTER (WHERE ok) OVER (PARTITION BY machine, run) AS size FROM r)
    SELECT machine, n * 10 AS line_no FROM h WHERE ok AND led AND size >= 2""")
def overview_topics(v: Views):
    return B.topic_lines(topics(v, "OVERVIEW")).where("topic").select("machine", "line_no")


@query("tips_topics", """WITH k AS (SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS n, o_orderkey % 5 AS k FROM orders), g AS (SELECT *, k BETWEEN 1 AND 3 AS ok, lag(k) OVER (PARTITION BY machine ORDER BY n) AS pk FROM k),
    r AS (SELECT *, sum(CASE WHEN ok AND pk BETWEEN 1 AND 3 THEN 0 ELSE 1 END) OVER (PARTITION BY machine ORDER BY n) AS run FROM g), h AS (SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY machine, run) AS size FROM r)
    SELECT machine, n * 10 + u AS line_no, u = 0 AS topic FROM h, (SELECT unnest([0, 1]) AS u) WHERE ok AND size >= 2""")
def tips_topics(v: Views):
    return B.topic_lines(topics(v, "TIPS AND TRICKS")).select("machine", "line_no", "topic")


@query("section_headings", "SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS line_no, CASE o_orderkey % 3 WHEN 0 THEN 'staff_pair' WHEN 1 THEN 'staff_heading' ELSE 'pair' END AS kind FROM orders")
def section_headings(v: Views):
    k = F.col("o_orderkey") % 3
    line = F.when(k == 0, "*Design*: Somebody").when(k == 1, "*Music*").otherwise("Sound : Other")
    rows = v.table("orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("machine"), F.lit("STAFF").alias("section"), F.col("o_orderkey").alias("line_no"), line.alias("line"))
    return B.line_kinds(rows).select("machine", "line_no", "kind")


@query("article_blocks")
def article_blocks(v: Views):
    return B.article_blocks(v.lines).select("machine", "section", "block_index", "type", F.coalesce(F.array_join("items", "|"), "text", F.concat_ws("=", "label", "value")).alias("body"), "text_hash")

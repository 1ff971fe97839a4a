"""Queries of sources, releases, lists and expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import metrics as M
from ..operators import quality_rules as R
from ..sources import archives as E
from ..sources import files as S
from ..sources import tables as B
from ..sources.lines import write_lines
from ..sources.scratch import scratch_path
from .views import Views, query

#: Rows whose lines make one written list.
LIST_ROWS = 5000


def listed(v: Views, lines, name: str) -> str:
    """Write lines (list, part, line_no, line) as files, one a list and part, in order; returns their folder."""
    return write_lines(lines.select(F.concat("list", F.lit("."), F.col("part").cast("string"), F.lit(".txt")).alias("file"), "line_no", "line"), scratch_path(v.spark, name))


def list_of(path: str):
    """The list and part that a file's path names, as list/part."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)\.txt$", 1), r"\.", "/")


def ini_files(v: Views) -> str:
    ini = v.ini.withColumn("part", F.floor(F.col("ordinal") / LIST_ROWS))
    head = ini.select("list", "part", (F.col("ordinal") * 2).alias("line_no"), F.when(F.col("ordinal") % 40 == 0, "[FOLDER_SETTINGS]").otherwise(F.concat(F.lit("[ "), "section", F.lit("  ]"))).alias("line"))
    body = ini.select("list", "part", F.col("ordinal") * 2 + 1, F.when(F.col("ordinal") % 17 == 0, ";; note").when(F.col("ordinal") % 17 == 1, "").otherwise(F.concat(F.lit(" "), "machine")))
    return listed(v, head.union(body), "lists")


LISTED = rf"""SELECT list || '/' || CAST(part AS STRING) AS path, trim(regexp_replace(section, '\s+', ' ', 'g')) AS section, machine, line_no
    FROM (SELECT *, 2 * row_number() OVER (PARTITION BY list, part ORDER BY ordinal) AS line_no FROM (SELECT *, ordinal // {LIST_ROWS} AS part FROM v_ini)) WHERE ordinal % 17 > 1 AND ordinal % 40 <> 0"""


def listed_rows(v: Views):
    return S.scan_sectioned_list(v.spark, ini_files(v)).withColumn("path", list_of("path"))


@query("scan_sectioned_ini", LISTED)
def scan_sectioned_ini(v: Views):
    return listed_rows(v)


@query("ini_list_stats", f"""WITH l AS ({LISTED}), m AS (SELECT path, machine, count(DISTINCT section) AS n FROM l GROUP BY 1, 2), s AS (SELECT path, section, count(*) AS listed, count(DISTINCT machine) AS uniq FROM l GROUP BY 1, 2)
    SELECT s.path, CAST(sum(listed) AS BIGINT) AS listed, count(*) AS sections, (SELECT count(*) FROM m WHERE m.path = s.path) AS machines, (SELECT count(*) FROM m WHERE m.path = s.path AND n >= 2) AS in_several,
           (SELECT CAST(sum(n - 1) AS BIGINT) FROM m WHERE m.path = s.path) AS across, CAST(sum(listed - uniq) AS BIGINT) AS within FROM s GROUP BY 1""")
def ini_list_stats(v: Views):
    return R.list_stats(listed_rows(v))


@query("ini_coverage", f"WITH l AS (SELECT DISTINCT split_part(path, '/', 1) AS path, machine FROM ({LISTED})), u AS (SELECT DISTINCT machine FROM l) SELECT p AS path, count(*) AS machines, count(l.machine) AS present, count(*) - count(l.machine) AS missing FROM u CROSS JOIN (SELECT unnest(['status', 'category', 'type']) AS p) LEFT JOIN l ON l.machine = u.machine AND l.path = p GROUP BY 1")
def ini_coverage(v: Views):
    rows = listed_rows(v).select(F.split_part("path", F.lit("/"), F.lit(1)).alias("path"), "machine")
    return R.list_coverage(rows, ["status", "category", "type"])


def headed(v: Views, name: str, lines) -> str:
    """Write the same kind of file for each supplier: its ``lines`` (an array column); returns their folder."""
    rows = v.table("supplier").select(F.col("s_suppkey").cast("string").alias("list"), F.lit(0).alias("part"), F.posexplode(lines).alias("line_no", "line"))
    return listed(v, rows, name)


def key():
    return F.col("s_suppkey")


def file_name():
    return F.concat(F.lit("f"), F.regexp_extract("path", r"([^/.]+)\.0\.txt$", 1))


@query("scan_ini_header", """SELECT 'f' || CAST(s_suppkey AS STRING) AS path, '0.' || CAST(s_suppkey % 300 AS STRING) AS version, 'mame' || CAST(s_suppkey % 300 AS STRING) AS build,
    CASE WHEN s_suppkey % 2 = 0 THEN '17/01/2026' ELSE '2026-01-17' END AS date_raw, '2026-01-17' AS date FROM supplier""")
def scan_ini_header(v: Views):
    n = (key() % 300).cast("string")
    lines = F.array(F.concat(F.lit(";; for MAME 0."), n, F.lit(" (MAME"), n, F.lit(")")), F.concat(F.lit(";; Generated on "), F.when(key() % 2 == 0, "17/01/2026").otherwise("2026-01-17")), F.lit("[A]"))
    return S.scan_list_header(v.spark, headed(v, "heads", lines)).withColumn("path", file_name())


@query(
    "scan_catlist",
    f"""WITH r AS (SELECT p_partkey AS k, p_partkey // {LIST_ROWS} AS part, CASE WHEN p_size % 3 = 0 THEN 'Arcade: ' ELSE '' END || p_type || ' / ' || p_brand AS head FROM part),
        h AS (SELECT *, last_value(CASE WHEN k % 4 = 1 OR k % {LIST_ROWS} = 0 THEN head END IGNORE NULLS) OVER (PARTITION BY part ORDER BY k) AS over FROM r)
        SELECT 'p' || CAST(k AS STRING) AS machine, CASE WHEN over LIKE 'Arcade: %' THEN 'Arcade' ELSE 'Non-Arcade' END AS grp, split_part(replace(over, 'Arcade: ', ''), ' / ', 1) AS category, split_part(over, ' / ', 2) AS subcategory
        FROM h WHERE k % 6 <> 0 AND over IS NOT NULL""",
)
def scan_catlist(v: Views):
    head = "'[' || CASE WHEN p_size % 3 = 0 THEN 'Arcade: ' ELSE '' END || p_type || ' / ' || p_brand || CASE WHEN p_size % 5 = 0 THEN ' * Mature *' ELSE '' END || ']'"
    rows = v.spark.sql(f"SELECT 'catlist' AS list, p_partkey AS k, floor(p_partkey / {LIST_ROWS}) AS part, {head} AS head FROM {{part}}", part=v.table("part"))
    body = F.when(F.col("k") % 6 == 0, F.concat(F.lit("key="), F.col("k").cast("string"))).otherwise(F.concat(F.lit("p"), F.col("k").cast("string")))
    heads = rows.where((F.col("k") % 4 == 1) | (F.col("k") % LIST_ROWS == 0))  # machines between them stand below the last
    lines = heads.select("list", "part", (F.col("k") * 3).alias("line_no"), F.col("head").alias("line")).union(rows.select("list", "part", F.col("k") * 3 + 1, body))
    return S.scan_category_list(v.spark, listed(v, lines, "categories")).drop("path", "line_no")


@query("scan_catlist_header", "SELECT 'f' || CAST(s_suppkey AS STRING) AS path, '1.' || CAST(s_suppkey % 9 AS STRING) AS version, '17-Jan-2026' AS date, CAST(200 + s_suppkey % 90 AS STRING) AS release FROM supplier")
def scan_catlist_header(v: Views):
    lines = F.array(F.concat(F.lit(";; CATLIST.ini 1."), (key() % 9).cast("string")), F.concat(F.lit(";; 17-Jan-2026 / MAME 0."), (200 + key() % 90).cast("string")), F.lit("[A]"))
    return S.scan_category_list_header(v.spark, headed(v, "category-heads", lines)).withColumn("path", file_name())


@query("scan_root_attributes", "SELECT 'f' || CAST(s_suppkey AS STRING) AS path, '0.' || CAST(s_suppkey AS STRING) AS build, CASE WHEN s_suppkey % 2 = 0 THEN '10' END AS mameconfig FROM supplier")
def scan_root_attributes(v: Views):
    root = F.concat(F.lit('<mame build="0.'), key().cast("string"), F.lit('"'), F.when(key() % 2 == 0, ' mameconfig="10"').otherwise(""), F.lit(">"))
    lines = F.array(F.lit('<?xml version="1.0"?>'), root, F.lit("<machine/>"))
    return S.scan_root_attributes(v.spark, headed(v, "roots", lines), "mame", ["build", "mameconfig"]).withColumn("path", file_name())


@query("select_member", "SELECT archive, arg_min(member, (-n, -length(member), member)) AS member FROM (SELECT 's' || CAST(l_suppkey AS STRING) AS archive, 'dir/data' || CAST(l_orderkey AS STRING) || '.xml' AS member, length(CAST(l_orderkey AS STRING)) AS n FROM lineitem) GROUP BY 1")
def select_member(v: Views):
    members = v.table("lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("archive"), F.concat(F.lit("dir/data"), F.col("l_orderkey").cast("string"), F.lit(".xml")).alias("member"))
    return S.select_member(members, "data").select("archive", "member")


@query("detect_text_encoding", r"""SELECT CASE WHEN k = 1 AND high THEN 'windows-1252' ELSE 'utf-8' END AS encoding, CASE k WHEN 0 THEN 'bom' ELSE 'guess' END AS source, CASE k WHEN 0 THEN FALSE WHEN 1 THEN NOT high ELSE NOT other END AS ascii_only, count(*) AS n
    FROM (SELECT doc_id % 4 AS k, regexp_matches(text, '[\x{80}-\x{FF}]') AS high, regexp_matches(text, '[^\x{00}-\x{7F}]') AS other FROM documents) GROUP BY 1, 2, 3""")
def detect_text_encoding(v: Views):
    body = F.encode(F.col("text"), "UTF-8")
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    raw = F.when(F.col("doc_id") % 4 == 0, F.concat(F.unhex(F.lit("EFBBBF")), body)).when(F.col("doc_id") % 4 == 1, latin).otherwise(body)
    found = v.table("documents").select("doc_id", S.detect_encoding(raw).alias("e"))
    return found.groupBy("e.encoding", "e.source", "e.ascii_only").agg(F.count("*").alias("n"))


@query("scan_vocabulary", """WITH p AS (SELECT p_type AS grp, p_brand AS category, p_size AS s, CASE WHEN p_partkey % 5 = 0 THEN 'the game' ELSE 'a game' END AS phrase, p_partkey FROM part)
    SELECT grp, category, CAST(s AS STRING) AS subcategory, r AS rule, count(*) AS n FROM (SELECT *, count(*) OVER (PARTITION BY grp, category, s) AS k FROM p), (SELECT unnest(['article', 'duplicate']) AS r) WHERE (r = 'article' AND phrase = 'the game') OR (r = 'duplicate' AND k > 1) GROUP BY 1, 2, 3, 4""")
def scan_vocabulary(v: Views):
    p = v.table("part").select(F.col("p_type").alias("grp"), F.col("p_brand").alias("category"), F.col("p_size").cast("string").alias("subcategory"), F.when(F.col("p_partkey") % 5 == 0, "the game").otherwise("a game").alias("phrase"))
    return S.vocabulary_violations(p).groupBy("grp", "category", "subcategory", "rule").agg(F.count("*").alias("n"))


@query("fingerprint_files", "SELECT 'f' || CAST(s_suppkey AS STRING) AS file, CAST(octet_length(encode(t)) AS BIGINT) AS size, sha256(t) AS sha256 FROM (SELECT s_suppkey, s_name || chr(10) || repeat('x', s_suppkey % 50) || chr(10) AS t FROM supplier)")
def fingerprint_files(v: Views):
    path = headed(v, "fingerprints", F.array(F.col("s_name"), F.repeat(F.lit("x"), (key() % 50).cast("int"))))
    files = S.fingerprint_files(v.spark, path, whole_bytes=40)  # about half of them are streamed
    return files.select(file_name().alias("file"), "size", "sha256")


_DOCUMENT = """'{"machine":"' || machine || '","title":"' || title || '"' || CASE WHEN manufacturer IS NULL THEN '' ELSE ',"manufacturer":"' || manufacturer || '"' END || ',"page":"' || page || '","ports_display":"' || ports_display || '"}'"""


@query("write_release_document", f"""SELECT 'header' AS part, '{{"schema_id":"catalogue","schema_version":"1","generated_at":"2026-01-17T14:56:26Z","versions":{{"machines":"0.287"}}}}' AS json UNION ALL SELECT 'record', {_DOCUMENT} FROM v_after""")
def write_release_document(v: Views):
    path = scratch_path(v.spark, "document")
    header = B.document_header("catalogue", "1", F.lit("2026-01-17 14:56:26").cast("timestamp"), {"machines": F.lit("0.287")})
    B.write_release_document(v.after, path, header=header)
    written = v.spark.read.text(f"{path}/header").select(F.lit("header").alias("part"), F.col("value").alias("json"))
    return written.union(v.spark.read.text(f"{path}/records").select(F.lit("record"), "value"))


@query("list_releases", "SELECT DISTINCT release FROM v_obs")
def list_releases(v: Views):
    return B.list_releases(v.obs)


@query("complete_releases", "SELECT release FROM v_findings GROUP BY 1 HAVING count(DISTINCT rule_id) >= 3")
def complete_releases(v: Views):
    return B.complete_releases(v.findings.select("release", F.col("rule_id").alias("dataset")))


@query("predecessor_release", "SELECT release, lag(release) OVER (ORDER BY CAST(release AS INT)) AS before FROM (SELECT DISTINCT release FROM v_obs)")
def predecessor_release(v: Views):
    return B.predecessors(v.obs)


@query("retain_newest", "SELECT release, row_number() OVER (ORDER BY CAST(release AS INT) DESC) <= 3 OR release = '0272' AS keep FROM (SELECT DISTINCT release FROM v_obs)")
def retain_newest(v: Views):
    return B.retain_newest(v.obs, 3, "0272")


@query("newest_revision", "WITH a AS (SELECT CAST(l_suppkey AS STRING) AS release, l_linenumber - 1 AS rank, CAST(l_orderkey AS STRING) AS path FROM lineitem), p AS (SELECT release, rank, min(path) AS path, count(*) > 1 AS tied FROM a GROUP BY 1, 2) SELECT release, path, CAST(rank AS INT) AS rank, tied FROM p QUALIFY rank = max(rank) OVER (PARTITION BY release)")
def newest_revision(v: Views):
    suffix = F.when(F.col("l_linenumber") == 1, "").otherwise(F.char(95 + F.col("l_linenumber")))
    rows = v.table("lineitem").select(F.col("l_suppkey").cast("string").alias("release"), suffix.alias("suffix"), F.col("l_orderkey").cast("string").alias("path"))
    return B.newest_revision(rows)


@query("release_index", "SELECT 'r' || CAST(o_custkey % 9 AS STRING) AS release, count(*) AS files, CAST(sum(o_orderkey) AS BIGINT) AS bytes, CAST(CAST(min(o_orderdate) AS DATE) AS STRING) AS first_modified, CAST(CAST(max(o_orderdate) AS DATE) AS STRING) AS last_modified FROM orders GROUP BY 1")
def release_index(v: Views):
    files = v.table("orders").select(F.concat(F.lit("r"), (F.col("o_custkey") % 9).cast("string")).alias("release"), F.col("o_orderkey").alias("size"), F.col("o_orderdate").alias("modified"))
    return B.release_index(files).withColumns({c: F.col(c).cast("date").cast("string") for c in ("first_modified", "last_modified")})


@query(
    "expect_machine_counts",
    """SELECT * FROM (SELECT 'disk_without_regions' AS rule, count(*) FILTER (WHERE (disk_required = 'yes' OR ordinal % 25 = 0) AND disk_regions = '') AS left, 0 AS right FROM v_machines
        UNION ALL SELECT 'regions_without_disk', count(*) FILTER (WHERE ordinal % 25 <> 0 AND disk_required = 'no' AND disk_regions <> ''), 0 FROM v_machines
        UNION ALL SELECT 'cpu_count', count(*) FILTER (WHERE ordinal % 20 = 0), 0 FROM v_machines UNION ALL SELECT 'sound_chip_count', count(*) FILTER (WHERE ordinal % 30 = 0), 0 FROM v_machines) t WHERE t."left" <> t."right"
       UNION ALL SELECT 'tag_per_display', (SELECT count(*) FROM v_displays WHERE type <> 'svg'), (SELECT count(*) FROM v_displays)
       UNION ALL SELECT 'ways_per_control', (SELECT count(*) FROM v_controls WHERE ways <> ''), (SELECT count(*) FROM v_controls)""",
)
def expect_machine_counts(v: Views):
    m, chips, shown, controls = v.machines, v.chips, v.displays, v.controls
    kinds = chips.groupBy(F.col("machine").alias("name")).agg(F.count_if(F.col("type") == "cpu").alias("cpus"), F.count_if(F.col("type") == "audio").alias("audio"))
    screens = shown.groupBy(F.col("machine").alias("name")).agg(F.count("*").alias("display_count"))
    recorded = m.join(kinds, "name", "left").join(screens, "name", "left").select(
        "name", F.when(F.col("ordinal") % 25 == 0, "yes").otherwise(F.col("disk_required")).alias("disk_required"), F.filter(F.split("disk_regions", ","), lambda r: r != "").alias("disk_regions"), "display_count",
        (F.coalesce("cpus", F.lit(0)) + (F.col("ordinal") % 20 == 0).cast("int")).alias("cpu_count"), (F.coalesce("audio", F.lit(0)) + (F.col("ordinal") % 30 == 0).cast("int")).alias("sound_chip_count"),
    )
    counts = M.distributions(m, {"year": text.year_bucket(F.col("year")), "players": text.digits(F.col("players_raw")), "speakers": F.col("speakers")})
    counts = counts.union(M.distributions(shown, {"type": F.col("type")})).union(M.distributions(shown.where("type <> 'svg'"), {"tag": F.col("width")}))
    counts = counts.union(M.distributions(controls, {"control": F.col("type"), "buttons": F.col("buttons")})).union(M.distributions(controls.where("ways <> ''"), {"ways": F.col("ways")}))
    return R.machine_invariants(recorded, chips, controls, counts, ["year", "players", "speakers"], ["type", "tag"], ["control", "buttons", "ways"])


@query("expect_list_counts", f"""WITH l AS ({LISTED}), m AS (SELECT path, machine, count(DISTINCT section) AS n FROM l GROUP BY 1, 2), s AS (SELECT path, section, count(*) AS listed, count(DISTINCT machine) AS uniq FROM l GROUP BY 1, 2),
        f AS (SELECT s.path, CAST(sum(listed) AS BIGINT) AS listed, CAST(sum(listed - uniq) AS BIGINT) AS within, (SELECT count(*) FROM m WHERE m.path = s.path AND n >= 2) AS in_several, (SELECT CAST(sum(n - 1) AS BIGINT) FROM m WHERE m.path = s.path) AS across FROM s GROUP BY 1)
        SELECT path, 'listed' AS rule, listed + 1 AS left, listed AS right FROM f WHERE path LIKE 'status/%' UNION ALL SELECT path, 'within', within - 2, within FROM f WHERE path LIKE 'type/%' UNION ALL SELECT path, 'in_several', 0, in_several FROM f WHERE path LIKE 'category/%' AND in_several <> 0 UNION ALL SELECT path, 'across', across + 7, across FROM f WHERE path LIKE 'category/%'""")
def expect_list_counts(v: Views):
    rows = listed_rows(v)
    is_ = lambda name: F.startswith("path", F.lit(name))
    told = R.list_stats(rows).withColumns({"listed": F.col("listed") + F.when(is_("status"), 1).otherwise(0), "within": F.col("within") - F.when(is_("type"), 2).otherwise(0), "in_several": F.when(is_("category"), 0).otherwise(F.col("in_several")), "across": F.col("across") + F.when(is_("category"), 7).otherwise(0)})
    return R.list_invariants(rows, told)


_NAMES = """SELECT c_custkey AS id, c_custkey % 5 AS k, lpad(CAST(c_custkey % 400 + 200 AS STRING), 4, '0') AS n FROM customer"""


@query("archive_identity", f"""SELECT id, CASE k WHEN 0 THEN 'mame' WHEN 1 THEN 'gaming_history' WHEN 2 THEN 'snaps' ELSE 'unknown' END AS provider, CASE WHEN k < 4 THEN n END AS release,
    CASE k WHEN 0 THEN n WHEN 1 THEN '0289' END AS embedded, CASE k WHEN 0 THEN 'match' WHEN 1 THEN CASE WHEN n = '0289' THEN 'match' ELSE 'mismatch' END ELSE 'unverified' END AS status FROM ({_NAMES})""")
def archive_identity(v: Views):
    rows = v.spark.sql(_NAMES.replace("FROM customer", "FROM {customer}"), customer=v.table("customer"))
    k, three = F.col("k"), F.substring("n", 2, 3)
    name = F.when(k == 0, F.concat(F.lit("dir/mame"), "n", F.lit("lx.zip"))).when(k == 1, F.concat(F.lit("History"), three, F.lit("b.zip"))).when(k == 2, F.concat(F.lit("ps_catver_"), three, F.lit(".zip"))).when(k == 3, F.concat(F.lit("mame-0."), three, F.lit("-extra.zip"))).otherwise("readme.txt")
    version = F.when(k == 0, F.concat(F.lit("0."), three)).when(k == 1, "2.89a").when(k == 2, "289")
    provider, release = E.archive_provider(name), E.release_hint(name)
    embedded = E.embedded_release(provider, version)
    return rows.select("id", provider.alias("provider"), release.alias("release"), embedded.alias("embedded"), E.compare_release(embedded, release).alias("status"))


@query("source_shape", "SELECT bool_or(cloneof IS NULL) AS has_parent, bool_or(cloneof IS NOT NULL) AS has_clone, bool_or(description IS NOT NULL) AS has_titles, (SELECT bool_or(o_orderkey % 3 = 0) FROM orders) AS has_systems, (SELECT bool_or(o_orderkey % 3 = 1) FROM orders) AS has_software FROM v_machines")
def source_shape(v: Views):
    kind = F.when(F.col("o_orderkey") % 3 == 0, "systems").when(F.col("o_orderkey") % 3 == 1, "software").otherwise("unknown")
    return R.source_shape(v.machines, v.table("orders").select(kind.alias("kind")))


#: Elements of a written file, about.
FILE_ROWS = 500


def written(v: Views, name: str, elements, root: str) -> str:
    """Write XML elements (one column) to the shared folder, some hundreds to a file under one root; returns the path."""
    path = scratch_path(v.spark, name)
    column = elements.columns[0]
    parts = max(1, elements.count() // FILE_ROWS)
    some = elements.withColumn("part", F.pmod(F.xxhash64(column), F.lit(parts))).groupBy("part")
    whole = some.agg(F.concat(F.lit(f"<{root}>"), F.concat_ws("", F.collect_list(column)), F.lit(f"</{root}>")).alias("value"))
    whole.write.partitionBy("part").text(path)
    return path + "/part=*"


@query("scan_machine_xml", """SELECT name, cloneof, description, year, count(l.l_partkey) AS roms FROM v_machines m LEFT JOIN lineitem l ON m.name = 'p' || CAST(l.l_partkey AS STRING) GROUP BY 1, 2, 3, 4""")
def scan_machine_xml(v: Views):
    roms = v.table("lineitem").groupBy(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("name"))
    roms = roms.agg(F.concat_ws("", F.collect_list(F.concat(F.lit('<rom name="r" size="'), F.col("l_suppkey").cast("string"), F.lit('"/>')))).alias("roms"))
    safe = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    some = lambda c, shape: F.coalesce(F.format_string(shape, safe(c)), F.lit(""))
    attribute = F.when(F.col("cloneof").isNull(), "").otherwise(F.format_string(' cloneof="%s"', "cloneof"))
    text_of = F.when(F.col("description").isNull(), "").otherwise(some("description", "<description>%s</description>"))
    element = F.concat(F.lit('<machine name="'), "name", F.lit('"'), attribute, F.lit(">"), text_of, some("year", "<year>%s</year>"), F.coalesce("roms", F.lit("")), F.lit("</machine>"))
    path = written(v, "xml", v.machines.join(roms, "name", "left").select(element), "mame")
    rows = S.scan_machine_xml(v.spark, path)
    return rows.select("name", F.col("_cloneof").alias("cloneof"), "description", F.coalesce("year", F.lit("")).alias("year"), F.coalesce(F.size("rom"), F.lit(0)).cast("long").alias("roms"))


@query("scan_entry_xml", "SELECT CASE c_custkey % 3 WHEN 0 THEN 'systems' WHEN 1 THEN 'software' ELSE 'unknown' END AS kind, CASE WHEN c_custkey % 3 = 0 THEN 'c' || CAST(c_custkey AS STRING) END AS primary_name, CASE WHEN c_custkey % 3 = 0 THEN 'alias' ELSE '' END AS aliases, c_name AS text FROM customer")
def scan_entry_xml(v: Views):
    k = F.col("c_custkey")
    names = F.concat(F.lit('<systems><system name="c'), k.cast("string"), F.lit('"/><system name="alias"/></systems>'))
    body = F.when(k % 3 == 0, names).when(k % 3 == 1, '<software><item list="a" name="b"/></software>').otherwise("")
    path = written(v, "entries", v.table("customer").select(F.concat(F.lit("<entry>"), body, F.lit("<text>"), "c_name", F.lit("</text></entry>"))), "history")
    return S.scan_entry_xml(v.spark, path).select("kind", "primary_name", F.array_join("aliases", "|").alias("aliases"), "text")


@query("scan_keyed_json", "SELECT machine AS key, title, page FROM v_before")
def scan_keyed_json(v: Views):
    grouped = v.before.select("machine", "title", "page", F.pmod(F.xxhash64("machine"), F.lit(max(1, v.before.count() // FILE_ROWS))).alias("part"))
    # objects of some hundred machines each, one to a file
    objects = grouped.groupBy("part").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("machine", F.struct("title", "page"))))).alias("value"))
    path = scratch_path(v.spark, "json")
    objects.write.partitionBy("part").text(path)
    return S.scan_keyed_json(v.spark, path + "/part=*", "struct<title:string,page:string>").select("key", "value.title", "value.page")


@query("scan_zip_members", "SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS size, TRUE AS readable FROM documents")
def scan_zip_members(v: Views):
    def zipped(batches):
        import io
        import zipfile

        import pandas as pd

        for b in batches:
            out = []
            for doc_id, body in zip(b["doc_id"], b["text"], strict=True):
                raw = io.BytesIO()
                with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("text.xml", (body or "").encode())
                out.append((str(doc_id), raw.getvalue()))
            yield pd.DataFrame(out, columns=["archive", "bytes"])

    archives = v.table("documents").select("doc_id", "text").mapInPandas(zipped, "archive string, bytes binary")
    return S.zip_members(archives).select(F.col("archive").cast("long").alias("doc_id"), "size", "readable")


@query("write_release_table", "SELECT 287 AS release, machine, title FROM v_after UNION ALL SELECT 286, machine, title FROM v_before WHERE page <> 'Page 2'")
def write_release_table(v: Views):
    path = scratch_path(v.spark, "release")
    before, after = v.before.select("machine", "title", "page"), v.after.select("machine", "title", "page")
    B.write_release_table(before, path, "286")
    B.write_release_table(after, path, "287")
    B.write_release_table(before.where("page <> 'Page 2'"), path, "286")  # replaces one release only
    return v.spark.read.parquet(path).select(F.col("release").cast("int").alias("release"), "machine", "title")

"""Queries of titles, pages, diffs, findings and freshness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diffs as D
from ..operators import ports as P
from ..operators import quality_rules as R
from ..operators import records as C
from ..operators import titles as T
from ..streaming import findings as N
from ..streaming import incremental as I
from .lineage_queries import DUPLICATES, FAMILY, ports
from .views import Views, query

#: title|subtitle|version of each unit, joined by ';', and the global version, for each form of the titles view.
_PARSED = """SELECT 'p' || CAST(p_partkey AS STRING) AS machine, CASE p_partkey % 12
    WHEN 0 THEN p_name || '|Part ' || p_size || '|#set 1' WHEN 1 THEN p_name || '||;' || p_type || '|Again|#' || p_brand WHEN 2 THEN p_name || '||#World [rev A], 4/1, extra words'
    WHEN 3 THEN p_name || '||#unclose' WHEN 4 THEN p_name || ' closed)||#' WHEN 5 THEN 'A(b)c ' || p_name || '||b#x, y, c ' || p_name
    WHEN 6 THEN p_name || '||Japan, US;Other|Sub|rev 2#B' WHEN 7 THEN p_name || '   spaced||#' WHEN 8 THEN p_name || ']||#ope' WHEN 9 THEN 'One||;Two|Deux|;Three|Trois|v1#v2'
    WHEN 10 THEN p_name || '||#' ELSE '||#' END AS parsed FROM part"""


@query("parse_titles", _PARSED)
def parse_titles(v: Views):
    one = lambda u: F.concat_ws("|", u["title"], u["subtitle"], u["version"])
    return T.parse_titles(v.titles).select("machine", F.concat(F.array_join(F.transform("units", one), ";"), F.lit("#"), "global_version").alias("parsed"))


ANOMALIES = """SELECT machine, a AS anomaly, description AS example FROM (SELECT machine, description, CAST(substr(machine, 2) AS INT) % 12 AS k FROM v_titles),
       (SELECT unnest(['unbalanced_round_brackets', 'infix_brackets_no_spaces', 'ambiguous_trailing_tokens']) AS a)
       WHERE CASE a WHEN 'unbalanced_round_brackets' THEN k IN (3, 4) WHEN 'infix_brackets_no_spaces' THEN k = 5 ELSE k IN (2, 5) END"""


@query("title_anomalies", ANOMALIES)
def title_anomalies(v: Views):
    return T.title_anomalies(T.parse_titles(v.titles))


@query("title_anomaly_counts", "WITH t AS (SELECT CAST(substr(machine, 2) AS INT) % 12 AS k, description FROM v_titles) SELECT anomaly, count(*) AS n, count(DISTINCT description) AS distinct_examples FROM (SELECT 'unbalanced_round_brackets' AS anomaly, description FROM t WHERE k IN (3, 4) UNION ALL SELECT 'infix_brackets_no_spaces', description FROM t WHERE k = 5 UNION ALL SELECT 'ambiguous_trailing_tokens', description FROM t WHERE k IN (2, 5)) GROUP BY 1")
def title_anomaly_counts(v: Views):
    found = T.title_anomalies(T.parse_titles(v.titles))
    return T.title_anomaly_counts(found, found)  # before and after overrides that change nothing


@query("page_names", f"SELECT machine, 'Wiki/' || split_part(split_part(parsed, ';', 1), '|', 1) || CASE WHEN split_part(parsed, '|', 2) <> '' THEN ': ' || split_part(parsed, '|', 2) ELSE '' END AS page FROM ({_PARSED})")
def page_names(v: Views):
    return T.parse_titles(v.titles).select("machine", F.concat(F.lit("Wiki/"), T.page_name(F.col("units"))).alias("page"))


@query(
    "redirect_names",
    """SELECT 'p' || CAST(p_partkey AS STRING) AS machine, name FROM (
         SELECT p_partkey, p_name AS name FROM part WHERE p_partkey % 12 = 0 UNION ALL SELECT p_partkey, p_type FROM part WHERE p_partkey % 12 = 1 UNION ALL SELECT p_partkey, p_type || ': Again' FROM part WHERE p_partkey % 12 = 1
         UNION ALL SELECT p_partkey, unnest(['Other', 'Other: Sub']) FROM part WHERE p_partkey % 12 = 6 UNION ALL SELECT p_partkey, unnest(['Two', 'Two: Deux', 'Three', 'Three: Trois']) FROM part WHERE p_partkey % 12 = 9)""",
)
def redirect_names(v: Views):
    return T.redirect_names(T.parse_titles(v.titles)).select("machine", "name")


@query("first_seen_dedupe", "SELECT DISTINCT ON (machine, lower(chip)) machine, lower(chip) AS key, chip FROM v_chips ORDER BY machine, lower(chip), pos, chip")
def first_seen_dedupe(v: Views):
    rows = v.chips.withColumn("pos", F.struct("pos", "chip"))
    return T.first_seen(rows, ["machine"], "chip", "pos").select("machine", F.lower("chip").alias("key"), "chip")


@query("page_collisions", "SELECT page, string_agg(DISTINCT machine, '|' ORDER BY machine) AS machines FROM v_before GROUP BY 1 HAVING count(DISTINCT machine) > 1")
def page_collisions(v: Views):
    return T.page_collisions(v.before).withColumn("machines", F.array_join("machines", "|"))


def redirects(v: Views):
    names = v.table("customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("machine"), F.lit(0).alias("pos"), F.concat(F.lit("page "), (F.col("c_custkey") % 40 * 3).cast("string")).alias("name"))
    return names.join(v.before.select("machine"), "machine", "left_semi")


_REDIRECTS = "SELECT 'c' || CAST(c_custkey AS STRING) AS machine, 'page ' || CAST(c_custkey % 40 * 3 AS STRING) AS name FROM customer WHERE c_custkey % 10 <> 0"


@query(
    "redirect_page_collisions",
    f"""WITH r AS (SELECT r.machine, r.name, b.page AS target FROM ({_REDIRECTS}) r JOIN v_before b ON r.machine = b.machine)
        SELECT r.name, (SELECT string_agg(DISTINCT o.machine, '|' ORDER BY o.machine) FROM v_before o WHERE lower(o.page) = r.name) AS owners, string_agg(r.machine || '>' || r.target, '|' ORDER BY r.machine) AS candidates
        FROM r WHERE lower(target) <> name AND name IN (SELECT lower(page) FROM v_before) GROUP BY r.name""",
)
def redirect_page_collisions(v: Views):
    met = T.redirect_page_collisions(redirects(v), v.before)
    return met.select("name", F.array_join("owners", "|").alias("owners"), F.array_join(F.transform("candidates", lambda c: F.concat(c["machine"], F.lit(">"), c["target"])), "|").alias("candidates"))


@query(
    "resolve_redirects",
    f"""WITH r AS (SELECT r.machine, r.name, b.page AS target FROM ({_REDIRECTS}) r JOIN v_before b ON r.machine = b.machine WHERE r.name NOT IN (SELECT lower(page) FROM v_before))
        SELECT name, arg_min(target, machine) AS target, count(DISTINCT target) AS targets FROM r GROUP BY 1""",
)
def resolve_redirects(v: Views):
    return T.resolve_redirects(redirects(v), v.before).withColumn("targets", F.size("targets").cast("long"))


@query(
    "apply_title_overrides",
    """WITH t AS (SELECT t.machine, t.description, o.new_description, o.note, o.machine IS NOT NULL AND (NOT only_if_unbalanced OR CAST(substr(t.machine, 2) AS INT) % 12 IN (3, 4)) AS e FROM v_titles t LEFT JOIN v_overrides o ON t.machine = o.machine)
       SELECT machine, CASE WHEN e AND trim(new_description) <> '' THEN new_description ELSE description END AS final, e AS eligible, e AND trim(new_description) <> '' AS applied,
              CASE WHEN e AND trim(new_description) <> '' THEN coalesce(nullif(note, ''), 'override') END AS reason FROM t""",
)
def apply_title_overrides(v: Views):
    return T.apply_overrides(v.titles, v.overrides).select("machine", "final", "eligible", F.coalesce("applied", F.lit(False)).alias("applied"), "reason")


@query(
    "family_titles",
    f"""WITH f AS ({FAMILY}) SELECT f.parent, f.machine, f.role, coalesce(nullif(m.description, ''), f.machine) AS title, m.year,
        CAST(row_number() OVER (PARTITION BY f.parent ORDER BY f.role = 'clone', lower(coalesce(nullif(m.description, ''), f.machine)), f.machine) AS INT) AS place FROM f LEFT JOIN v_machines m ON f.machine = m.name""",
)
def family_titles(v: Views):
    return T.family_titles(v.machines)


FIELDS = ["title", "manufacturer", "ports_display"]
DIFF = """SELECT coalesce(b.machine, a.machine) AS machine, CASE WHEN b.machine IS NULL THEN 'added' WHEN a.machine IS NULL THEN 'withdrawn'
          WHEN b.title IS DISTINCT FROM a.title OR b.manufacturer IS DISTINCT FROM a.manufacturer OR b.ports_display IS DISTINCT FROM a.ports_display OR b.page <> a.page THEN 'modified' ELSE 'unchanged' END AS status,
          CASE WHEN a.machine IS NULL OR b.machine IS NULL THEN '' ELSE concat_ws('|', CASE WHEN b.manufacturer IS DISTINCT FROM a.manufacturer THEN 'manufacturer' END, CASE WHEN b.ports_display IS DISTINCT FROM a.ports_display THEN 'ports_display' END,
               CASE WHEN b.title IS DISTINCT FROM a.title THEN 'title' END) END AS changed, b.page AS page_before, a.page AS page_after, coalesce(b.page <> a.page, FALSE) AS renamed
          FROM v_before b FULL OUTER JOIN v_after a ON b.machine = a.machine"""


@query("release_diff", DIFF)
def release_diff(v: Views):
    return D.release_diff(v.before, v.after, FIELDS).withColumn("changed", F.array_join("changed_fields", "|")).drop("changed_fields")


@query("changed_field_counts", f"SELECT field, count(*) AS n FROM (SELECT unnest(string_split(changed, '|')) AS field FROM ({DIFF}) WHERE changed <> '') GROUP BY 1")
def changed_field_counts(v: Views):
    return D.release_diff(v.before, v.after, FIELDS).select(F.explode("changed_fields").alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query("affected_filter", f"SELECT machine, status, renamed FROM ({DIFF}) WHERE status IN ('added', 'modified') AND contains(lower(coalesce(page_after, page_before)), '12')")
def affected_filter(v: Views):
    d = D.release_diff(v.before, v.after, FIELDS)
    return d.where(F.col("status").isin("added", "modified") & F.lower(F.coalesce("page_after", "page_before")).contains("12")).select("machine", "status", "renamed")


@query("expect_matching_keys", "SELECT coalesce(b.machine, a.machine) AS machine, CASE WHEN a.machine IS NULL THEN 'only_before' ELSE 'only_after' END AS side FROM v_before b FULL OUTER JOIN v_after a ON b.machine = a.machine WHERE a.machine IS NULL OR b.machine IS NULL")
def expect_matching_keys(v: Views):
    return R.unmatched_keys(v.before, v.after, "machine")


@query("release_diff_counts", f"SELECT count(*) FILTER (WHERE status = 'added') AS added, count(*) FILTER (WHERE status = 'withdrawn') AS withdrawn, count(*) FILTER (WHERE status = 'modified') AS modified, count(*) FILTER (WHERE status = 'unchanged') AS unchanged, count(*) FILTER (WHERE renamed) AS renamed FROM ({DIFF})")
def release_diff_counts(v: Views):
    return D.diff_counts(D.release_diff(v.before, v.after, FIELDS))


@query("affected_titles", f"SELECT DISTINCT page FROM (SELECT unnest([page_before, page_after]) AS page FROM ({DIFF}) WHERE status <> 'unchanged') WHERE page IS NOT NULL")
def affected_titles(v: Views):
    return D.affected_titles(D.release_diff(v.before, v.after, FIELDS))


SECTIONS = """SELECT coalesce(b.machine, a.machine) AS machine, coalesce(b.section, a.section) AS section, CASE WHEN b.c IS NULL THEN 'ADDED' WHEN a.c IS NULL THEN 'REMOVED' ELSE 'MODIFIED' END AS state
    FROM (SELECT machine, section, string_agg(type || ':' || text, chr(10) ORDER BY block_index, type, text) AS c FROM v_blocks_before GROUP BY 1, 2) b
    FULL OUTER JOIN (SELECT machine, section, string_agg(type || ':' || text, chr(10) ORDER BY block_index, type, text) AS c FROM v_blocks_after GROUP BY 1, 2) a ON b.machine = a.machine AND b.section = a.section
    WHERE b.c IS DISTINCT FROM a.c AND coalesce(b.machine, a.machine) IN (SELECT machine FROM v_before INTERSECT SELECT machine FROM v_after)"""


@query("section_diff", SECTIONS)
def section_diff(v: Views):
    return D.section_diff(v.blocks_before, v.blocks_after, v.before.select("machine").intersect(v.after.select("machine")))


@query(
    "combined_diff",
    f"""WITH r AS (SELECT machine, status FROM ({DIFF}) WHERE status <> 'unchanged'), s AS (SELECT machine, string_agg(DISTINCT section, '|' ORDER BY section) AS sections FROM ({SECTIONS}) GROUP BY 1)
        SELECT coalesce(r.machine, s.machine) AS machine, r.status AS record_status, s.sections, CASE WHEN s.machine IS NULL THEN 'record' WHEN r.machine IS NULL THEN 'text' ELSE 'both' END AS kind FROM r FULL OUTER JOIN s ON r.machine = s.machine""",
)
def combined_diff(v: Views):
    records = D.release_diff(v.before, v.after, FIELDS)
    sections = D.section_diff(v.blocks_before, v.blocks_after, v.before.select("machine").intersect(v.after.select("machine")))
    return D.combined_diff(records, sections).withColumn("sections", F.array_join("sections", "|"))


#: The longest common run of each pair of segments, first of equals, then the segments before and after it; by joins of equal blocks.
_RUNS = """RECURSIVE b AS (SELECT *, row_number() OVER (PARTITION BY machine, section ORDER BY block_index) - 1 AS i FROM v_blocks_before), a AS (SELECT *, row_number() OVER (PARTITION BY machine, section ORDER BY block_index) - 1 AS j FROM v_blocks_after),
       s AS (SELECT coalesce(x.machine, y.machine) AS machine, coalesce(x.section, y.section) AS section, coalesce(x.n, 0) AS nb, coalesce(y.n, 0) AS na
             FROM (SELECT machine, section, count(*) AS n FROM b GROUP BY 1, 2) x FULL OUTER JOIN (SELECT machine, section, count(*) AS n FROM a GROUP BY 1, 2) y ON x.machine = y.machine AND x.section = y.section),
       e AS (SELECT b.machine, b.section, i, j, i - row_number() OVER (PARTITION BY b.machine, b.section, i - j ORDER BY i) AS island FROM b JOIN a ON b.machine = a.machine AND b.section = a.section AND b.type = a.type AND b.text = a.text),
       r AS (SELECT machine, section, i, j, max(i) OVER (PARTITION BY machine, section, i - j, island) - i + 1 AS len FROM e),
       seg AS (SELECT machine, section, 0 AS alo, nb AS ahi, 0 AS blo, na AS bhi FROM s
               UNION ALL
               SELECT machine, section, unnest([alo, i + len]), unnest([i, ahi]), unnest([blo, j + len]), unnest([j, bhi])
               FROM (SELECT seg.*, r.i, r.j, least(r.len, ahi - r.i, bhi - r.j) AS len FROM seg JOIN r ON r.machine = seg.machine AND r.section = seg.section AND r.i >= alo AND r.i < ahi AND r.j >= blo AND r.j < bhi
                     QUALIFY row_number() OVER (PARTITION BY seg.machine, seg.section, alo, ahi, blo, bhi ORDER BY least(r.len, ahi - r.i, bhi - r.j) DESC, r.i, r.j) = 1)),
       leaf AS (SELECT seg.* FROM seg WHERE (alo < ahi OR blo < bhi) AND NOT EXISTS (SELECT 1 FROM r WHERE r.machine = seg.machine AND r.section = seg.section AND r.i >= alo AND r.i < ahi AND r.j >= blo AND r.j < bhi)),
       slot AS (SELECT l.machine, l.section, CASE WHEN nb = 0 THEN 'ADDED' WHEN na = 0 THEN 'REMOVED' ELSE 'MODIFIED' END AS state, CASE WHEN alo + k < ahi THEN alo + k END AS i, CASE WHEN blo + k < bhi THEN blo + k END AS j
                FROM (SELECT *, unnest(range(greatest(ahi - alo, bhi - blo))) AS k FROM leaf) l JOIN s ON s.machine = l.machine AND s.section = l.section),
       p AS (SELECT slot.*, b.type AS bt, a.type AS nt, b.text AS was, a.text AS now, coalesce(b.type = a.type, FALSE) AS pair
             FROM slot LEFT JOIN b ON b.machine = slot.machine AND b.section = slot.section AND b.i = slot.i LEFT JOIN a ON a.machine = slot.machine AND a.section = slot.section AND a.j = slot.j)"""


@query(
    "changed_block_detail",
    f"""WITH {_RUNS}
       SELECT machine, section, state, 'modified' AS change, bt AS type, CAST(i AS INTEGER) AS was_at, CAST(j AS INTEGER) AS now_at, was AS before, now AS after FROM p WHERE pair
       UNION ALL SELECT machine, section, state, 'removed', bt, CAST(i AS INTEGER), NULL, was, NULL FROM p WHERE NOT pair AND i IS NOT NULL
       UNION ALL SELECT machine, section, state, 'added', nt, NULL, CAST(j AS INTEGER), NULL, now FROM p WHERE NOT pair AND j IS NOT NULL""",
)
def changed_block_detail(v: Views):
    return D.changed_block_detail(v.blocks_before, v.blocks_after)  # texts here are shorter than the context of a change


@query(
    "changed_field_detail",
    """SELECT b.machine, f AS field, CASE f WHEN 'title' THEN b.title WHEN 'manufacturer' THEN b.manufacturer ELSE b.ports_display END AS before, CASE f WHEN 'title' THEN a.title WHEN 'manufacturer' THEN a.manufacturer ELSE a.ports_display END AS after
       FROM v_before b JOIN v_after a ON b.machine = a.machine, (SELECT unnest(['title', 'manufacturer', 'ports_display']) AS f)
       WHERE CASE f WHEN 'title' THEN b.title IS DISTINCT FROM a.title WHEN 'manufacturer' THEN b.manufacturer IS DISTINCT FROM a.manufacturer ELSE b.ports_display IS DISTINCT FROM a.ports_display END""",
)
def changed_field_detail(v: Views):
    return D.changed_fields(v.before, v.after, FIELDS)


_RELEASES = ["0280", "0281", "0282", "0283", "0284", "0285"]


LIFECYCLE = """WITH k AS (SELECT DISTINCT rule_id, machine, source_text, value FROM v_findings), g AS (SELECT k.*, r FROM k, (SELECT unnest(['0280', '0281', '0282', '0283', '0284', '0285']) AS r)),
       n AS (SELECT rule_id, machine, source_text, value, release, count(*) AS n FROM v_findings GROUP BY ALL),
       p AS (SELECT g.rule_id, g.machine, g.source_text, g.value, g.r, coalesce(n.n, 0) AS n FROM g LEFT JOIN n ON g.rule_id = n.rule_id AND g.machine = n.machine AND g.source_text = n.source_text AND g.value IS NOT DISTINCT FROM n.value AND g.r = n.release),
       l AS (SELECT *, lag(n) OVER w AS before, max(n) OVER (PARTITION BY rule_id, machine, source_text, value ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ever FROM p WINDOW w AS (PARTITION BY rule_id, machine, source_text, value ORDER BY r))
       SELECT rule_id, machine, source_text, value, min(r) FILTER (WHERE n > 0) AS first_observed, max(r) FILTER (WHERE n > 0) AS last_observed, min(r) FILTER (WHERE n = 0 AND ever > 0) AS first_absent,
              coalesce(string_agg(r, '|' ORDER BY r) FILTER (WHERE n = 0 AND before > 0), '') AS disappeared, coalesce(string_agg(r, '|' ORDER BY r) FILTER (WHERE n > 0 AND before = 0 AND ever > 0), '') AS reappeared,
              bool_or(r = '0285' AND n > 0) AS present_in_latest, CAST(sum(n) AS BIGINT) AS occurrences FROM l GROUP BY 1, 2, 3, 4"""


def told(histories):
    return histories.drop("section").withColumns({c: F.array_join(c, "|") for c in ("disappeared", "reappeared")})


@query("finding_lifecycle", LIFECYCLE)
def finding_lifecycle(v: Views):
    return told(N.finding_lifecycle(v.findings, _RELEASES))


@query("finding_history", LIFECYCLE)
def finding_history(v: Views):
    """The same from stored state, to which releases are added one by one, the middle ones first."""
    history = N.FindingHistory(v.spark)
    for release in sorted(_RELEASES, key=lambda r: (int(r) % 3, r)):
        history.add(v.findings.where(F.col("release") == release), release, "detectors 1")
    return told(history.lifecycle())


@query("findings_filter", "SELECT rule_id, count(*) AS n FROM v_findings WHERE release = '0283' AND (contains(lower(machine), '1') OR contains(lower(source_text), '1') OR contains(lower(section), '1') OR contains(coalesce(value, ''), '1')) GROUP BY 1")
def findings_filter(v: Views):
    found = C.filtered_findings(v.findings.where(F.col("release") == "0283"), ["machine", "section", "source_text", "value"], text="1")
    return found.groupBy("rule_id").agg(F.count("*").alias("n"))


@query("transform_findings", f"""WITH f AS (SELECT 'title' AS kind, anomaly AS category, machine, example AS evidence FROM ({ANOMALIES}) UNION ALL SELECT 'ports', 'Parent/clone PORTS duplication', parent, NULL FROM ({DUPLICATES}))
    SELECT kind, category, machine, evidence, machine IN (SELECT machine FROM v_class) AS known FROM f WHERE contains(lower(machine), '3') OR contains(lower(category), '3') OR contains(lower(coalesce(evidence, '')), '3')""")
def transform_findings(v: Views):
    twice = P.duplicate_families(P.merge_ports(ports(v), v.machines))
    return C.transform_findings(T.title_anomalies(T.parse_titles(v.titles)), twice, getattr(v, "class"), text="3")


@query("catalogue_search", "SELECT m.name, b.title FROM v_machines m LEFT JOIN v_before b ON replace(m.name, 'p', 'c') = b.machine WHERE contains(lower(m.name), '17') OR contains(lower(coalesce(b.title, '')), '00033')")
def catalogue_search(v: Views):
    titles = v.before.select(F.regexp_replace("machine", "^c", "p").alias("name"), "title")
    return C.catalogue_search(v.machines.select("name"), titles, {"name": "17", "title": "00033"})


_FRESH = """SELECT f.*, f.stage = 'articles' AS tool_changed, outputs_missing, changed + missing + new + outputs_missing = 0 AND f.stage <> 'articles' AS fresh FROM (
            SELECT coalesce(a.stage, b.stage) AS stage, count(*) FILTER (WHERE a.path IS NOT NULL AND b.path IS NOT NULL AND (a.size <> b.size OR a.digest <> b.digest)) AS changed, count(*) FILTER (WHERE a.path IS NULL) AS missing,
            count(*) FILTER (WHERE b.path IS NULL) AS new FROM v_files_after a FULL OUTER JOIN v_files_before b ON a.stage = b.stage AND a.path = b.path GROUP BY 1) f
            JOIN (SELECT stage, count(*) FILTER (WHERE stage <> 'machines' AND size % 10 = 0) AS outputs_missing FROM v_files_after GROUP BY 1) o ON o.stage = f.stage"""


def freshness(v: Views):
    stages = v.files_after.select("stage").distinct()
    tools = stages.select("stage", F.lit("2").alias("version"), F.when(F.col("stage") == "articles", "1").otherwise("2").alias("stamped"))
    outputs = v.files_after.select("stage", "path", ((F.col("size") % 10 != 0) | (F.col("stage") == "machines")).alias("present"))
    return I.stage_freshness(v.files_after, v.files_before, tools, outputs)


@query("stage_freshness", _FRESH)
def stage_freshness(v: Views):
    return freshness(v)


#: What each stage needs: a chain behind each kind of files, as long as the regions are many, and one stage that needs them all.
_GRAPH = " UNION ALL ".join(
    f"SELECT '{stage}.' || r_regionkey AS stage, CASE WHEN r_regionkey = 0 THEN '{stage}' ELSE '{stage}.' || (r_regionkey - 1) END AS needs FROM {{region}} UNION ALL SELECT 'publish', '{stage}.' || r_regionkey FROM {{region}}"
    for stage in ("lists", "machines", "articles")
)


@query(
    "blocked_stages",
    f"""WITH RECURSIVE f AS ({_FRESH}), g AS ({_GRAPH.format(region="region")}), n AS (SELECT stage, fresh FROM f UNION ALL SELECT DISTINCT stage, TRUE FROM g),
        r AS (SELECT stage FROM n WHERE NOT fresh UNION SELECT g.stage FROM g JOIN r ON g.needs = r.stage)
        SELECT n.stage, n.fresh, n.stage IN (SELECT stage FROM r) AS stale, coalesce((SELECT string_agg(needs, '|' ORDER BY needs) FROM g WHERE g.stage = n.stage AND g.needs IN (SELECT stage FROM r)), '') AS waiting_for,
               EXISTS (SELECT 1 FROM g WHERE g.stage = n.stage AND g.needs IN (SELECT stage FROM r)) AS blocked FROM n""",
)
def blocked_stages(v: Views):
    graph = v.spark.sql(_GRAPH, region=v.table("region"))
    return I.blocked_stages(freshness(v), graph).withColumn("waiting_for", F.array_join("waiting_for", "|"))


_SIGN = """sha256(count(*) || ':' || sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) || ':' || sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)))"""


@query("encoding_dependency", """SELECT stage, sha256('[' || string_agg('{"path":"' || path || '","size":' || size || '}', ',' ORDER BY path, size) || ']') AS signature FROM (SELECT DISTINCT stage, path, size FROM v_files_after) GROUP BY 1""")
def encoding_dependency(v: Views):
    return I.dependency_signature(v.files_after.select("stage", "path", "size").distinct(), ["path", "size"])


@query("stage_stamps", f"""SELECT stage, '2' AS version, count(*) AS files, sha256('{{"stage":"' || stage || '","version":"2","inputs":"' || {_SIGN} || '"}}') AS digest
    FROM (SELECT stage, md5('{{"path":"' || path || '","size":' || size || ',"digest":"' || digest || '"}}') AS d FROM v_files_after) GROUP BY 1""")
def stage_stamps(v: Views):
    return I.stage_stamps(v.files_after, v.files_after.select("stage", F.lit("2").alias("version")).distinct())


@query(
    "snapshot_findings",
    "SELECT a.path, CASE WHEN b.path IS NULL THEN 'add' ELSE 'conflict' END AS outcome FROM v_files_after a LEFT JOIN (SELECT path, md5(path || CASE WHEN size > 40 THEN 'x' ELSE '' END) AS digest FROM v_files_before) b ON a.path = b.path WHERE b.path IS NULL OR b.digest <> md5(a.path)",
)
def snapshot_findings(v: Views):
    new = v.files_after.select("path", F.md5("path").alias("digest"))
    kept = v.files_before.select("path", F.md5(F.concat("path", F.when(F.col("size") > 40, "x").otherwise(""))).alias("digest"))
    add, conflict = I.snapshot_findings(new, kept, ["path"])
    return add.select("path", F.lit("add").alias("outcome")).union(conflict.select("path", F.lit("conflict")))


@query("carry_forward_acquisition", "SELECT a.path, a.digest, CASE WHEN b.path IS NOT NULL THEN 'https://example.org/' || b.path END AS source_url FROM v_files_after a LEFT JOIN v_files_before b ON a.path = b.path AND a.digest = b.digest")
def carry_forward_acquisition(v: Views):
    previous = v.files_before.withColumns({"source_url": F.concat(F.lit("https://example.org/"), "path"), "acquired_at": F.lit("2026-01-01T00:00:00Z")})
    return D.carry_forward(v.files_after, previous).select("path", "digest", "source_url")


@query(
    "apply_acquisition_events",
    """SELECT a.path, CASE WHEN a.size = 7 THEN 'other' ELSE a.stage END AS provider, CASE WHEN b.path IS NULL THEN 'unknown_file' WHEN b.size % 5 = 0 THEN 'unverified' WHEN a.size = 7 THEN 'provider_mismatch' WHEN a.size % 11 = 0 THEN 'digest_mismatch' ELSE 'applied' END AS outcome
       FROM v_files_after a LEFT JOIN v_files_before b ON a.path = b.path""",
)
def apply_acquisition_events(v: Views):
    manifest = v.files_before.select("path", F.col("stage").alias("provider"), "digest", (F.col("size") % 5 != 0).alias("verified"))
    events = v.files_after.select("path", F.when(F.col("size") == 7, "other").otherwise(F.col("stage")).alias("provider"), F.when(F.col("size") % 11 == 0, "?").otherwise(F.col("digest")).alias("digest"))
    return D.acquisition_events(manifest, events).select("path", "provider", "outcome")

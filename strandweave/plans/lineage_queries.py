"""Queries of lineage, classification, selection and ports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import lineage as L
from ..operators import ports as P
from .views import Views, query


def classes(v: Views) -> DataFrame:
    return v.__getattr__("class").withColumn("category", F.split("category", ","))


def ports(v: Views) -> DataFrame:
    listed = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    return v.ports.withColumns({c: listed(c) for c in ("regions", "tags", "model")})


ELIGIBLE = """SELECT m.name FROM v_machines m JOIN v_class c ON m.name = c.machine WHERE m.cloneof IS NULL AND game_status = 'game' AND list_contains(string_split(category, ','), 'Arcade')"""
FAMILY = """SELECT name AS parent, name AS machine, 'parent' AS role FROM v_machines WHERE cloneof IS NULL UNION ALL SELECT cloneof, name, 'clone' FROM v_machines WHERE cloneof IS NOT NULL"""
VALID = "SELECT * FROM v_ports WHERE trim(platform) <> ''"
PORTED = f"""SELECT DISTINCT coalesce(m.cloneof, m.name) AS name FROM ({VALID}) p JOIN v_machines m ON p.machine = m.name
             WHERE coalesce(m.cloneof, m.name) IN (SELECT name FROM v_machines WHERE cloneof IS NULL)"""
REASON = """SELECT m.name, CASE WHEN m.cloneof IS NOT NULL THEN 'clone' WHEN isbios = 'yes' THEN 'bios' WHEN isdevice = 'yes' THEN 'device' WHEN k.machine IS NULL THEN 'missing_classification'
            WHEN k.grp <> 'Arcade' THEN 'non_arcade' WHEN c.game_status = 'no_game' THEN 'non_game' WHEN coalesce(c.game_status, 'unknown') <> 'game' THEN 'unknown_game_status'
            WHEN k.category IN ('Casino', 'Medal Game') THEN 'excluded_category' WHEN lower(c.type) LIKE '%pinball%' THEN 'excluded_machine_type' WHEN ismechanical = 'yes' THEN 'mechanical' ELSE 'eligible' END AS reason
            FROM v_machines m LEFT JOIN v_class c ON m.name = c.machine LEFT JOIN v_catlist k ON m.name = k.machine"""


@query("parent_index", "SELECT cloneof AS parent, string_agg(name, '|' ORDER BY name) AS clones, count(*) AS n FROM (SELECT DISTINCT cloneof, name FROM v_machines WHERE cloneof IS NOT NULL) GROUP BY 1")
def parent_index(v: Views):
    return L.parent_index(v.machines).select("parent", L.joined("clones").alias("clones"), F.size("clones").cast("long").alias("n"))


@query("expand_parents_to_clones", f"WITH e AS ({ELIGIBLE}) SELECT name FROM e UNION SELECT m.name FROM v_machines m JOIN e ON m.cloneof = e.name")
def expand_parents_to_clones(v: Views):
    return L.expand_to_clones(L.eligible_parents(v.machines, classes(v)), v.machines)


@query(
    "inherit_classification",
    """SELECT machine, game_status, category, type FROM v_class UNION ALL
       SELECT m.name, c.game_status, c.category, c.type FROM v_machines m JOIN v_class c ON m.cloneof = c.machine WHERE m.name NOT IN (SELECT machine FROM v_class)""",
)
def inherit_classification(v: Views):
    return L.inherit_classification(classes(v), v.machines).select("machine", "game_status", L.joined("category", ",").alias("category"), "type")


@query("eligible_parents", ELIGIBLE)
def eligible_parents(v: Views):
    return L.eligible_parents(v.machines, classes(v))


@query("eligibility_reason", REASON)
def eligibility_reason(v: Views):
    return L.eligibility(v.machines, classes(v), v.catlist)


@query("publication_partition", f"WITH r AS ({REASON}), p AS ({PORTED}) SELECT p.name, r.reason = 'eligible' AS publishable, CASE WHEN r.reason <> 'eligible' THEN r.reason END AS deferred FROM p JOIN r ON p.name = r.name")
def publication_partition(v: Views):
    judged = L.eligibility(v.machines, classes(v), v.catlist, L.ports_parents(v.machines, P.valid_ports(ports(v))))
    return judged.select("name", (F.col("reason") == "eligible").alias("publishable"), F.when(F.col("reason") != "eligible", F.col("reason")).alias("deferred"))


@query("publication_counts", f"WITH r AS ({REASON}), p AS ({PORTED}) SELECT r.reason, count(*) AS parents, count(k.machine) AS with_catlist FROM p JOIN r ON p.name = r.name LEFT JOIN v_catlist k ON p.name = k.machine GROUP BY 1")
def publication_counts(v: Views):
    judged = L.eligibility(v.machines, classes(v), v.catlist, L.ports_parents(v.machines, P.valid_ports(ports(v))))
    return judged.join(v.catlist, F.col("name") == F.col("machine"), "left").groupBy("reason").agg(F.count("*").alias("parents"), F.count("machine").alias("with_catlist"))


@query("deferral_filter", f"WITH r AS ({REASON}), p AS ({PORTED}) SELECT p.name, r.reason FROM p JOIN r ON p.name = r.name WHERE r.reason = 'bios' AND contains(lower(p.name), '2')")
def deferral_filter(v: Views):
    judged = L.eligibility(v.machines, classes(v), v.catlist, L.ports_parents(v.machines, P.valid_ports(ports(v))))
    return judged.where((F.col("reason") == "bios") & F.lower("name").contains("2"))


@query(
    "ini_class_map",
    """WITH e AS (SELECT machine, list, section, lower(replace(section, ' ', '')) = '<notavailable>' AS na FROM v_ini),
       g AS (SELECT machine, bool_or(list = 'status' AND section = 'Game') AS game, bool_or(list = 'status' AND section = 'No Game') AS no_game,
                    string_agg(DISTINCT section, '|' ORDER BY section) FILTER (WHERE list = 'category' AND NOT na) AS cat,
                    coalesce(bool_or(na) FILTER (WHERE list = 'type'), FALSE) AS no_type, min(section) FILTER (WHERE list = 'type') AS type FROM e GROUP BY 1)
       SELECT machine, CASE WHEN game THEN 'game' WHEN no_game THEN 'no_game' ELSE 'unknown' END AS game_status, coalesce(cat, 'unknown') AS category,
              CASE WHEN no_type OR type IS NULL THEN 'unknown' ELSE type END AS type FROM g""",
)
def ini_class_map(v: Views):
    return L.list_classes(v.ini).withColumn("category", L.joined("category"))


@query("ports_parents", PORTED)
def ports_parents(v: Views):
    return L.ports_parents(v.machines, P.valid_ports(ports(v)))


@query(
    "ports_parent_selection",
    f"""WITH e AS ({ELIGIBLE}), p AS ({PORTED}) SELECT coalesce(e.name, p.name) AS name, e.name IS NOT NULL AS eligible, p.name IS NOT NULL AS has_ports, e.name IS NULL AS exception
        FROM e FULL OUTER JOIN p ON e.name = p.name""",
)
def ports_parent_selection(v: Views):
    return L.ports_selection(L.eligible_parents(v.machines, classes(v)), L.ports_parents(v.machines, P.valid_ports(ports(v))))


@query("selection_counts", f"""WITH e AS ({ELIGIBLE}), p AS ({PORTED}), c AS (SELECT cloneof, count(*) AS n FROM v_machines WHERE cloneof IS NOT NULL GROUP BY 1)
        SELECT count(*) AS selected, count(*) FILTER (WHERE n IS NOT NULL) AS with_clones, count(*) FILTER (WHERE n IS NULL) AS without_clones, CAST(coalesce(sum(n), 0) AS BIGINT) AS clones_linked
        FROM (SELECT name FROM e UNION SELECT name FROM p) s LEFT JOIN c ON s.name = c.cloneof""")
def selection_counts(v: Views):
    chosen = L.ports_selection(L.eligible_parents(v.machines, classes(v)), L.ports_parents(v.machines, P.valid_ports(ports(v))))
    clones = L.lineage(v.machines).groupBy("parent").agg(F.count("*").alias("n"))
    both = chosen.join(clones, F.col("name") == F.col("parent"), "left")
    return both.agg(F.count("*").alias("selected"), F.count("n").alias("with_clones"), F.count_if(F.col("n").isNull()).alias("without_clones"), F.coalesce(F.sum("n"), F.lit(0)).alias("clones_linked"))


@query(
    "valid_port_rows",
    "SELECT machine, row_no, CASE WHEN regions = '' THEN '??' ELSE replace(regions, ',', '|') END AS regions, platform, replace(tags, ',', '|') AS tags FROM v_ports WHERE trim(platform) <> ''",
)
def valid_port_rows(v: Views):
    return P.valid_ports(ports(v)).select("machine", "row_no", L.joined("regions").alias("regions"), "platform", L.joined("tags").alias("tags"))


@query("systems_with_ports", "SELECT DISTINCT machine FROM v_ports WHERE trim(platform) <> ''")
def systems_with_ports(v: Views):
    return P.valid_ports(ports(v)).select("machine").distinct()


@query("merge_ports", f"WITH f AS ({FAMILY}) SELECT f.parent, f.role, p.machine, p.source_id, p.category, p.row_no FROM ({VALID}) p JOIN f ON p.machine = f.machine")
def merge_ports(v: Views):
    return P.merge_ports(ports(v), v.machines).select("parent", "role", "machine", "source_id", "category", "row_no")


@query("port_source_ids", f"WITH f AS ({FAMILY}) SELECT f.parent, coalesce(string_agg(DISTINCT CAST(p.source_id AS STRING), '|' ORDER BY CAST(p.source_id AS STRING)), '') AS ids FROM ({VALID}) p JOIN f ON p.machine = f.machine GROUP BY 1")
def port_source_ids(v: Views):
    ids = P.source_ids(P.merge_ports(ports(v), v.machines))
    return ids.select("parent", L.joined(F.array_sort(F.col("source_ids").cast("array<string>"))).alias("ids"))


DUPLICATES = f"""WITH f AS ({FAMILY}), r AS (SELECT f.parent, f.role, p.category, concat_ws('~', regions, platform, title, date, publisher, tags, model, comment) AS k FROM ({VALID}) p JOIN f ON p.machine = f.machine)
        SELECT DISTINCT a.parent FROM r a JOIN r b ON a.parent = b.parent AND a.category = b.category AND a.k = b.k WHERE a.role = 'parent' AND b.role = 'clone'"""


@query("duplicate_parent_clone_ports", DUPLICATES)
def duplicate_parent_clone_ports(v: Views):
    return P.duplicate_families(P.merge_ports(ports(v), v.machines))


LINE = """(CASE WHEN regions = '' THEN '[??]' ELSE '[' || replace(regions, ',', '][') || ']' END) || ' ' || platform || CASE WHEN tags = '' THEN '' ELSE ' [' || replace(tags, ',', ', ') || ']' END
        || CASE WHEN title <> '' THEN ' "' || title || CASE WHEN model <> '' THEN ' [' || model || ']' ELSE '' END || '"' WHEN model <> '' THEN ' [' || model || ']' ELSE '' END
        || CASE WHEN date <> '' THEN ' (' || date || ')' ELSE '' END || CASE WHEN publisher <> '' THEN ' by ' || publisher ELSE '' END"""


@query("port_line_text", f"SELECT machine, row_no, {LINE} || CASE WHEN comment <> '' THEN ' : ' || comment ELSE '' END AS line FROM v_ports WHERE trim(platform) <> ''")
def port_line_text(v: Views):
    return P.valid_ports(ports(v)).select("machine", "row_no", P.port_line().alias("line"))


@query(
    "ports_display_order",
    f"""WITH f AS ({FAMILY}), r AS (SELECT f.parent, f.role, p.*, count(DISTINCT f.role) OVER (PARTITION BY f.parent, p.category) > 1 AS mixed FROM ({VALID}) p JOIN f ON p.machine = f.machine),
        t AS (SELECT *, 'This GH port entry is based on the MAME ' || role || ' ' || machine || '.' AS told, replace(date, 'X', '0') AS d FROM r)
        SELECT parent, category, CAST(row_number() OVER (PARTITION BY parent, category ORDER BY date <> '', d, role = 'clone', machine, row_no, platform, title, comment, publisher) AS INT) AS place,
               {LINE} || CASE WHEN mixed THEN ' : ' || CASE WHEN comment = '' THEN told WHEN comment LIKE '%!' THEN comment || ' ' || told ELSE comment || '. ' || told END WHEN comment <> '' THEN ' : ' || comment ELSE '' END AS line FROM t""",
)
def ports_display_order(v: Views):
    return P.display_order(P.merge_ports(ports(v), v.machines)).select("parent", "category", "place", P.port_line(F.col("mixed")).alias("line"))


@query(
    "ports_telemetry",
    f"""WITH e AS (SELECT name FROM ({ELIGIBLE}) UNION SELECT name FROM ({PORTED})), f AS ({FAMILY}),
        r AS (SELECT f.parent, count(*) FILTER (WHERE role = 'parent') AS own_rows, count(*) FILTER (WHERE role = 'clone') AS clone_rows, count(DISTINCT CASE WHEN role = 'clone' THEN p.machine END) AS clones_with_ports
              FROM ({VALID}) p JOIN f ON p.machine = f.machine GROUP BY 1)
        SELECT e.name, coalesce(own_rows, 0) AS own_rows, coalesce(clone_rows, 0) AS clone_rows, coalesce(clones_with_ports, 0) AS clones_with_ports, coalesce(own_rows = 0 AND clone_rows > 0, FALSE) AS only_via_clones
        FROM e LEFT JOIN r ON e.name = r.parent""",
)
def ports_telemetry(v: Views):
    rows = ports(v)
    chosen = L.ports_selection(L.eligible_parents(v.machines, classes(v)), L.ports_parents(v.machines, P.valid_ports(rows)))
    return P.ports_telemetry(rows, v.machines, chosen)


@query("out_of_scope_ports", f"WITH e AS ({ELIGIBLE}) SELECT DISTINCT machine FROM ({VALID}) EXCEPT (SELECT name FROM e UNION SELECT m.name FROM v_machines m JOIN e ON m.cloneof = e.name)")
def out_of_scope_ports(v: Views):
    inside = L.expand_to_clones(L.eligible_parents(v.machines, classes(v)), v.machines)
    return P.valid_ports(ports(v)).select("machine").subtract(inside.withColumnRenamed("name", "machine"))


@query("attach_catlist", f"WITH p AS ({PORTED}) SELECT p.name, k.grp, k.category, k.subcategory FROM p LEFT JOIN v_catlist k ON p.name = k.machine")
def attach_catlist(v: Views):
    ported = L.ports_parents(v.machines, P.valid_ports(ports(v)))
    return ported.join(v.catlist, F.col("name") == F.col("machine"), "left").select("name", "grp", "category", "subcategory")


@query(
    "catlist_conflicts",
    """WITH twice AS (SELECT machine, grp, category, subcategory FROM v_catlist UNION ALL SELECT machine, grp, 'Maze', subcategory FROM v_catlist WHERE category <> 'Casino')
       SELECT machine, count(*) AS n FROM (SELECT DISTINCT * FROM twice) GROUP BY 1 HAVING count(*) > 1""",
)
def catlist_conflicts(v: Views):
    both = v.catlist.union(v.catlist.where("category <> 'Casino'").withColumn("category", F.lit("Maze")))
    return L.classification_conflicts(both, ["grp", "category", "subcategory"])


AS_OF = """SELECT r.machine, r.release, arg_max(o.category, o.release) AS category, max(o.release) AS source_release, CASE WHEN max(o.release) = r.release THEN 'observed' ELSE 'carried_forward' END AS status
           FROM v_requests r JOIN v_obs o ON r.machine = o.machine AND o.release <= r.release GROUP BY 1, 2"""


@query("category_as_of", AS_OF)
def category_as_of(v: Views):
    return L.as_of(v.obs, v.requests)


@query(
    "classification_catalog",
    f"""WITH h AS ({AS_OF.replace("r.machine", "replace(r.machine, 'c', 'p') AS machine", 1)})
        SELECT m.name, m.cloneof, c.game_status, c.category AS current_category, h.source_release, h.status, k.grp, k.subcategory
        FROM v_machines m LEFT JOIN v_class c ON m.name = c.machine LEFT JOIN h ON m.name = h.machine LEFT JOIN v_catlist k ON m.name = k.machine""",
)
def classification_catalog(v: Views):
    historical = L.as_of(v.obs, v.requests).withColumn("machine", F.regexp_replace("machine", "^c", "p"))
    out = L.classification_catalog(v.machines, classes(v), v.catlist, historical)
    return out.select("name", "flags.cloneof", "current.game_status", L.joined("current.category", ",").alias("current_category"), "historical.source_release", "historical.status", "catlist.grp", "catlist.subcategory")


@query(
    "missing_vocabulary",
    f"""WITH p AS ({PORTED}), r AS (SELECT p.name, k.grp, k.category, k.subcategory, coalesce(trim(k.grp) <> '' AND trim(k.category) <> '' AND trim(k.subcategory) <> '', FALSE) AS ok FROM p LEFT JOIN v_catlist k ON p.name = k.machine)
        , m AS (SELECT DISTINCT CASE WHEN ok THEN grp END AS grp, CASE WHEN ok THEN category END AS category, CASE WHEN ok THEN subcategory END AS subcategory, name FROM r WHERE NOT ok OR category <> 'Shooter'),
        n AS (SELECT name, CAST((row_number() OVER (ORDER BY name) - 1) // 1000 AS INT) AS bucket FROM (SELECT DISTINCT name FROM m))
        SELECT grp, category, subcategory, bucket, CAST(sum(count(*)) OVER (PARTITION BY grp, category, subcategory) AS BIGINT) AS systems, string_agg(name, '|' ORDER BY name) AS machines FROM m JOIN n USING (name) GROUP BY 1, 2, 3, 4""",
)
def missing_vocabulary(v: Views):
    approved = v.catlist.where("category = 'Shooter'").select("grp", "category", "subcategory").distinct()
    out = L.missing_vocabulary(L.ports_parents(v.machines, P.valid_ports(ports(v))), v.catlist, approved)
    return out.withColumn("machines", L.joined("machines"))


@query("union_machine_names", "SELECT name FROM v_machines UNION SELECT machine FROM v_ports UNION SELECT machine FROM v_catlist")
def union_machine_names(v: Views):
    return L.machine_names(v.machines.select("name"), v.ports.select("machine"), v.catlist.select("machine"))


@query("keys_minus", "SELECT machine FROM v_ports EXCEPT SELECT machine FROM v_class")
def keys_minus(v: Views):
    return L.keys_minus(v.ports, classes(v))


@query("keys_intersect", "SELECT machine FROM v_ports INTERSECT SELECT machine FROM v_catlist")
def keys_intersect(v: Views):
    return L.keys_intersect(v.ports, v.catlist)


@query(
    "audit_coverage_join",
    f"""WITH p AS (SELECT DISTINCT machine FROM ({VALID})) SELECT count(*) AS systems, count(*) FILTER (WHERE m.name IS NULL) AS unknown_machine, count(*) FILTER (WHERE m.cloneof IS NOT NULL) AS clones,
        count(*) FILTER (WHERE m.name IS NOT NULL AND m.cloneof IS NULL) AS parents, count(c.machine) AS classified, count(*) FILTER (WHERE c.machine IS NULL AND m.cloneof IS NOT NULL) AS unclassified_clones
        FROM p LEFT JOIN v_machines m ON p.machine = m.name LEFT JOIN v_class c ON p.machine = c.machine""",
)
def audit_coverage_join(v: Views):
    keys = P.valid_ports(ports(v)).select("machine").distinct()
    m, c = v.machines.select("name", "cloneof"), classes(v).select(F.col("machine").alias("classed"))
    both = keys.join(m, F.col("machine") == F.col("name"), "left").join(c, F.col("machine") == F.col("classed"), "left")
    clone, known, classed = F.col("cloneof").isNotNull(), F.col("name").isNotNull(), F.col("classed").isNotNull()
    return both.agg(F.count("*").alias("systems"), F.count_if(~known).alias("unknown_machine"), F.count_if(clone).alias("clones"), F.count_if(known & ~clone).alias("parents"), F.count_if(classed).alias("classified"), F.count_if(~classed & clone).alias("unclassified_clones"))

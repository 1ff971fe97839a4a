"""Queries of sections and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import machines as H
from ..operators import metrics as M
from ..operators import ordering as O
from ..operators import sections as S
from .scalar_queries import _MEDIA, CONTROL_LINE_SQL
from .views import Views, query

LABEL = """chip || CASE WHEN clock_hz >= 1000000000 THEN printf(' @ %.3f GHz', clock_hz / 1e9) WHEN clock_hz >= 1000000 THEN printf(' @ %.3f MHz', clock_hz / 1e6)
           WHEN clock_hz >= 1 THEN printf(' @ %.3f Hz', clock_hz * 1.0::DOUBLE) ELSE '' END"""


@query(
    "chips_section",
    f"""WITH r AS (SELECT machine, pos, type, lower(chip) AS name, {LABEL} AS label, CASE WHEN type = 'cpu' THEN 'cpu' WHEN type = 'audio' AND lower(chip) NOT IN ('speaker', 'samples') THEN 'audio' END AS part FROM v_chips),
        c AS (SELECT machine, count(*) FILTER (WHERE part = 'cpu') AS cpu_count, count(*) FILTER (WHERE part = 'audio') AS audio_count, count(*) FILTER (WHERE type = 'audio' AND name = 'speaker') AS speakers FROM r GROUP BY 1),
        l AS (SELECT machine, part, label, min(pos) AS p, sum(count(*)) OVER (PARTITION BY machine, part, lower(label)) AS n FROM r WHERE part IS NOT NULL GROUP BY 1, 2, 3),
        i AS (SELECT machine, part, string_agg(CASE WHEN n > 1 THEN '(' || n || 'x) ' || label ELSE label END, '|' ORDER BY p, CASE WHEN n > 1 THEN '(' || n || 'x) ' || label ELSE label END) AS items FROM l GROUP BY 1, 2)
        SELECT c.machine, cpu_count, CASE WHEN cpu_count = 1 THEN 'CPU' ELSE 'CPUs' END AS cpu_heading, coalesce(a.items, '') AS cpus, audio_count,
               CASE WHEN audio_count = 1 THEN 'Audio Chip' ELSE 'Audio Chips' END AS audio_heading, coalesce(b.items, '') AS audio_chips, speakers
        FROM c LEFT JOIN i a ON c.machine = a.machine AND a.part = 'cpu' LEFT JOIN i b ON c.machine = b.machine AND b.part = 'audio'""",
)
def chips_section(v: Views):
    return S.chips_section(v.chips).withColumns({c: F.array_join(c, "|") for c in ("cpus", "audio_chips")})


@query("explode_chips", """SELECT machine, CAST(row_number() OVER (PARTITION BY machine ORDER BY pos, type, chip, CAST(clock_hz AS VARCHAR) NULLS FIRST) - 1 AS INT) AS pos, type, chip, clock_hz, count(*) FILTER (WHERE type = 'cpu') OVER (PARTITION BY machine) AS cpu_count,
    count(*) FILTER (WHERE type = 'audio') OVER (PARTITION BY machine) AS audio_count FROM v_chips""")
def explode_chips(v: Views):
    one = F.struct("pos", F.upper("type").alias("_type"), F.concat(F.lit(" "), "chip").alias("_name"), F.col("clock_hz").cast("string").alias("_clock"))
    packed = v.chips.groupBy(F.col("machine").alias("name")).agg(F.array_sort(F.collect_list(one)).alias("chip"))
    return S.explode_chips(packed)


_KEPT = "type = 'vector' OR (coalesce(try_cast(width AS INT), 0) > 0 AND coalesce(try_cast(height AS INT), 0) > 0)"


@query("explode_displays", f"SELECT machine, pos, type, CAST(rotate AS INT) AS rotate, try_cast(width AS INT) AS width, try_cast(height AS INT) AS height FROM v_displays WHERE {_KEPT}")
def explode_displays(v: Views):
    return S.display_rows(v.displays).where("kept").select("machine", "pos", "type", "rotate", "width", "height")


@query("dropped_displays", f"WITH d AS (SELECT machine, pos FROM v_displays WHERE NOT ({_KEPT})) SELECT (SELECT count(*) FROM d) AS dropped, string_agg(machine || ':' || pos, '|' ORDER BY pos, machine) AS examples FROM (SELECT * FROM d ORDER BY pos, machine LIMIT 10)")
def dropped_displays(v: Views):
    gone = S.display_rows(v.displays).where("not kept")
    few = gone.orderBy("pos", "machine").limit(10).agg(F.array_sort(F.collect_list(F.struct("pos", "machine"))).alias("e"))
    told = F.array_join(F.transform("e", lambda x: F.concat_ws(":", x["machine"], x["pos"])), "|")
    return gone.agg(F.count("*").alias("dropped")).join(few.select(told.alias("examples")))


@query(
    "displays_section",
    f"""WITH d AS (SELECT machine, CASE type WHEN 'svg' THEN 'SVG' WHEN 'lcd' THEN 'LCD' WHEN 'raster' THEN 'Raster' ELSE 'Vector' END AS t, CASE rotate WHEN '0' THEN 'Horizontal' WHEN '45' THEN '' ELSE 'Vertical' END AS o,
               CASE WHEN type IN ('raster', 'lcd') THEN try_cast(width AS INT) END AS w, CASE WHEN type IN ('raster', 'lcd') THEN try_cast(height AS INT) END AS h,
               CASE WHEN refresh <> '' THEN printf('%.3f Hz', CAST(refresh AS DOUBLE)) END AS z FROM v_displays WHERE {_KEPT}),
        g AS (SELECT machine, t, o, w, h, z, count(*) AS n FROM d GROUP BY ALL),
        l AS (SELECT *, concat_ws(chr(10), CASE WHEN n > 1 THEN '(' || n || 'x) ' ELSE '' END || t || CASE WHEN o <> '' THEN ' (' || o || ')' ELSE '' END, CASE WHEN w IS NOT NULL THEN w || ' x ' || h || ' pixels' END, z) AS line FROM g)
        SELECT machine, CAST(sum(n) AS BIGINT) AS count, CASE WHEN sum(n) = 1 THEN 'Screen' ELSE 'Screens' END AS heading, count(*) AS groups,
               CASE WHEN sum(n) = 1 THEN 'Screen' ELSE 'Screens' END || ': ' || CAST(sum(n) AS BIGINT) || chr(10) || string_agg(line, chr(10) ORDER BY t, o, coalesce(w, 0), coalesce(h, 0), coalesce(z, '')) AS text FROM l GROUP BY 1""",
)
def displays_section(v: Views):
    return S.displays_section(S.display_rows(v.displays).where("kept"))


@query("display_shape_counts", f"SELECT count(*) FILTER (WHERE type IN ('raster', 'lcd')) AS with_size, count(*) FILTER (WHERE type IN ('svg', 'vector')) AS without_size FROM v_displays WHERE {_KEPT}")
def display_shape_counts(v: Views):
    return S.display_rows(v.displays).where("kept").agg(F.count_if(F.col("type").isin("raster", "lcd")).alias("with_size"), F.count_if(F.col("type").isin("svg", "vector")).alias("without_size"))


def players(v: Views):
    return v.machines.select(F.col("name").alias("machine"), text.digits(F.col("players_raw")).alias("players"))


_CONTROLS = f"""r AS (SELECT machine, pos, player, {CONTROL_LINE_SQL} AS label, coalesce(buttons, 0) AS b FROM v_controls),
        p AS (SELECT name AS machine, coalesce(try_cast(players_raw AS BIGINT), 0) AS players FROM v_machines),
        l AS (SELECT machine, player, label, min(pos) AS q, sum(count(*)) OVER (PARTITION BY machine, player, lower(label)) AS n FROM r GROUP BY 1, 2, 3),
        i AS (SELECT machine, player, string_agg(CASE WHEN n > 1 THEN '(' || n || 'x) ' || label ELSE label END, '{{0}}' ORDER BY q, CASE WHEN n > 1 THEN '(' || n || 'x) ' || label ELSE label END) AS items FROM l GROUP BY 1, 2),
        b AS (SELECT machine, player, CAST(sum(b) AS BIGINT) AS buttons FROM r GROUP BY 1, 2),
        e AS (SELECT machine, CAST(unnest(generate_series(1, players)) AS INT) AS player FROM p WHERE players > 0 UNION SELECT machine, player FROM r),
        s AS (SELECT e.machine, e.player, coalesce(items, 'Unknown controls') AS lines, coalesce(buttons, 0) AS buttons FROM e LEFT JOIN i USING (machine, player) LEFT JOIN b USING (machine, player))"""


@query("controls_section", "WITH " + _CONTROLS.replace("{0}", "|") + " SELECT * FROM s")
def controls_section(v: Views):
    return S.controls_section(v.controls, players(v)).withColumn("lines", F.array_join("lines", "|"))


@query(
    "explode_controls",
    "WITH "
    + _CONTROLS.replace("'{0}'", "chr(10)")
    + """, t AS (SELECT machine, string_agg('Player ' || player || chr(10) || lines || chr(10) || CASE WHEN buttons <= 0 THEN 'No Buttons' WHEN buttons = 1 THEN '1 Button' ELSE buttons || ' Buttons' END, chr(10) ORDER BY player) AS x FROM s GROUP BY 1)
        SELECT p.machine, 'Players: ' || players || coalesce(chr(10) || x, '') AS text FROM p LEFT JOIN t ON p.machine = t.machine""",
)
def explode_controls(v: Views):
    return S.controls_text(S.controls_section(v.controls, players(v)), players(v))


@query("machine_header", """SELECT name, cloneof, nullif(trim(sourcefile), '') AS sourcefile, nullif(sampleof, '') AS sampleof, isbios, isdevice, ismechanical, description, coalesce(year, '') AS year, coalesce(manufacturer, '') AS manufacturer FROM v_machines""")
def machine_header(v: Views):
    return H.machine_header(v.machines)


@query("players_value", "SELECT name, try_cast(players_raw AS BIGINT) AS players, coalesce(CAST(try_cast(players_raw AS BIGINT) AS STRING), 'unknown') AS bucket FROM v_machines")
def players_value(v: Views):
    n = text.digits(F.col("players_raw"))
    return v.machines.select("name", n.alias("players"), text.number_bucket(n).alias("bucket"))


@query("sound_channels_value", "SELECT name, try_cast(nullif(channels_raw, '') AS BIGINT) AS channels FROM v_machines")
def sound_channels_value(v: Views):
    return v.machines.select("name", text.digits(F.col("channels_raw")).alias("channels"))


@query("samples_required", "SELECT name, sampleof <> '' OR samples = 'yes' AS required FROM v_machines")
def samples_required(v: Views):
    return v.machines.select("name", H.samples_required().alias("required"))


@query("rom_rollup", "SELECT 'p' || CAST(l_partkey AS STRING) AS machine, count(*) AS rom_count, CAST(sum(CASE WHEN l_linenumber = 7 THEN 0 ELSE l_suppkey * 1000000007 END) AS BIGINT) AS rom_bytes FROM lineitem GROUP BY 1")
def rom_rollup(v: Views):
    size = F.when(F.col("l_linenumber") == 7, "x").otherwise((F.col("l_suppkey") * 1000000007).cast("string"))
    return H.rom_rollup(v.table("lineitem").select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("machine"), size.alias("size")))


@query(
    "disk_rollup",
    "SELECT name, CASE WHEN disk_regions = '' THEN 'no' ELSE 'yes' END AS required, coalesce(string_agg(DISTINCT d, '|' ORDER BY d) FILTER (WHERE d <> ''), '') AS regions, count(DISTINCT d) FILTER (WHERE d <> '') AS n FROM (SELECT name, disk_regions, unnest(string_split(disk_regions, ',')) AS d FROM v_machines) GROUP BY name, disk_regions",
)
def disk_rollup(v: Views):
    out = H.disk_rollup(v.machines.withColumn("disk_regions", F.split("disk_regions", ",")))
    return out.withColumn("regions", F.array_join("regions", "|"))


@query("device_ref_rollup", "SELECT machine, bool_or(lower(chip) = 'samples') AS samples, count(*) FILTER (WHERE lower(chip) = 'speaker') AS speakers FROM v_chips GROUP BY 1")
def device_ref_rollup(v: Views):
    refs = v.chips.groupBy(F.col("machine").alias("name")).agg(F.collect_list(F.struct(F.col("chip").alias("_name"))).alias("device_ref"))
    return S.device_ref_rollup(refs)


@query(
    "machine_totals",
    """SELECT count(*) AS machines, count(*) FILTER (WHERE cloneof IS NULL) AS parents, count(cloneof) AS clones, count(*) FILTER (WHERE isbios = 'yes') AS bios, count(*) FILTER (WHERE isdevice = 'yes') AS devices,
       count(*) FILTER (WHERE ismechanical = 'yes') AS mechanical, count(*) FILTER (WHERE sampleof <> '' OR samples = 'yes') AS samples FROM v_machines""",
)
def machine_totals(v: Views):
    return H.machine_totals(v.machines)


DIST = """SELECT 'year' AS metric, CASE WHEN regexp_full_match(year, '[0-9]{4}') THEN year ELSE 'unknown' END AS bucket, count(*) AS n FROM v_machines GROUP BY 2
          UNION ALL SELECT 'players', coalesce(CAST(try_cast(players_raw AS BIGINT) AS STRING), 'unknown'), count(*) FROM v_machines GROUP BY 2
          UNION ALL SELECT 'channels', coalesce(CAST(try_cast(nullif(channels_raw, '') AS BIGINT) AS STRING), 'unknown'), count(*) FROM v_machines GROUP BY 2
          UNION ALL SELECT 'speakers', CAST(speakers AS STRING), count(*) FROM v_machines GROUP BY 2
          UNION ALL SELECT 'driver', coalesce(nullif(sourcefile, ''), 'unknown'), count(*) FROM v_machines GROUP BY 2"""


def dist(v: Views):
    m = {"year": text.year_bucket(F.col("year")), "players": text.digits(F.col("players_raw")), "channels": text.digits(F.col("channels_raw")), "speakers": F.col("speakers"), "driver": text.empty_to_null(F.col("sourcefile"))}
    return M.distributions(v.machines, m)


@query("machine_distributions", DIST)
def machine_distributions(v: Views):
    return dist(v)


@query(
    "element_distributions",
    """SELECT 'type' AS metric, coalesce(nullif(type, ''), 'unknown') AS bucket, count(*) AS n FROM v_controls GROUP BY 2 UNION ALL SELECT 'ways', coalesce(nullif(ways, ''), 'unknown'), count(*) FROM v_controls GROUP BY 2
       UNION ALL SELECT 'buttons', coalesce(CAST(buttons AS STRING), 'unknown'), count(*) FROM v_controls GROUP BY 2""",
)
def element_distributions(v: Views):
    return M.distributions(v.controls, {"type": text.empty_to_null(F.col("type")), "ways": text.empty_to_null(F.col("ways")), "buttons": F.col("buttons")})


@query(
    "distribution_order",
    f"""WITH d AS (SELECT metric, CASE WHEN bucket = 'unknown' OR try_cast(bucket AS BIGINT) IS NOT NULL THEN bucket ELSE 'other' END AS bucket, CAST(sum(n) AS BIGINT) AS n FROM ({DIST}) GROUP BY 1, 2)
        SELECT metric, bucket, n, CAST(row_number() OVER (PARTITION BY metric ORDER BY bucket = 'unknown', bucket = 'other', try_cast(bucket AS BIGINT)) AS INT) AS place FROM d""",
)
def distribution_order(v: Views):
    return M.distribution_order(dist(v))


@query("bucket_examples", "SELECT rom_count, string_agg(name, '|' ORDER BY ordinal) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY rom_count ORDER BY ordinal) AS k FROM v_machines) WHERE k <= 5 GROUP BY 1")
def bucket_examples(v: Views):
    return M.first_examples(v.machines, ["rom_count"], "ordinal", "name", 5).withColumn("examples", F.array_join("examples", "|"))


@query(
    "top_groups",
    f"""WITH d AS ({DIST}) SELECT metric, bucket, n, CAST(place AS INT) AS place, groups FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY n DESC, lower(bucket), bucket) AS place, count(*) OVER (PARTITION BY metric) AS groups FROM d) WHERE place <= 12""",
)
def top_groups(v: Views):
    return M.top_groups(dist(v), 12)


@query("page_of_rows", "SELECT name, CAST(row_number() OVER (ORDER BY lower(name), name) AS INT) AS place, 3 AS page, CAST(ceil((SELECT count(*) FROM v_machines) / 50.0) AS INT) AS pages, (SELECT CAST(count(*) AS INT) FROM v_machines) AS total FROM v_machines QUALIFY place BETWEEN 101 AND 150")
def page_of_rows(v: Views):
    return O.page_of_rows(v.machines.select("name"), [F.lower("name"), F.col("name")], 3)


@query("sorted_catalogue", "SELECT name, row_number() OVER (ORDER BY lower(name), name) AS place FROM v_machines")
def sorted_catalogue(v: Views):
    return O.with_places(v.machines.select("name"), [F.lower("name"), F.col("name")])


@query("media_counts", f"SELECT coalesce(m, 'none') AS media, count(DISTINCT name) AS parents FROM (SELECT name, {_MEDIA} AS m FROM (SELECT name, unnest(string_split(disk_regions, ',')) AS d FROM v_machines WHERE cloneof IS NULL AND disk_regions <> '')) GROUP BY 1")
def media_counts(v: Views):
    return H.media_counts(v.machines.withColumn("disk_regions", F.split("disk_regions", ",")))


@query(
    "audio_mismatch",
    "WITH m AS (SELECT *, try_cast(nullif(channels_raw, '') AS BIGINT) AS c FROM v_machines) SELECT count(c) AS reported, count(*) FILTER (WHERE c <> speakers) AS mismatched, count(*) FILTER (WHERE samples = 'yes') AS samples, (SELECT string_agg(name, '|' ORDER BY name) FROM (SELECT name FROM m WHERE c <> speakers ORDER BY name LIMIT 10)) AS examples FROM m",
)
def audio_mismatch(v: Views):
    out = H.audio_mismatch(v.machines.withColumn("channels", text.digits(F.col("channels_raw"))))
    return out.withColumn("examples", F.array_join("examples", "|"))

"""Catalogue-shaped views of the test tables, in SQL that Spark and DuckDB both run.

The test data hold no catalogue, so each query sees one derived from the tables; every row of them takes part. What a
query is to miss has a key that matches nothing: another first letter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_YMD = "CAST(extract(year FROM {0}) AS STRING) || '-' || lpad(CAST(extract(month FROM {0}) AS STRING), 2, '0') || '-' || lpad(CAST(extract(day FROM {0}) AS STRING), 2, '0')"

#: name -> SELECT over tables and earlier views.
VIEWS = {
    "machines": """
        SELECT 'p' || CAST(p_partkey AS STRING) AS name,
               CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'p' || CAST(p_partkey - p_partkey % 4 AS STRING) END AS cloneof,
               CASE WHEN p_partkey % 50 = 3 THEN NULL ELSE p_name || ' / ' || p_type || ' (' || p_brand || ')' END AS description,
               CASE WHEN p_partkey % 10 = 0 THEN 'drivers/' || p_type || '.cpp' ELSE '' END AS sourcefile,
               CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 29 = 0 THEN '19??' ELSE CAST(1970 + p_size AS STRING) END AS year,
               CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 9 = 1 THEN '[' || p_brand || ']' ELSE p_brand || ' / Acme (' || p_type || ' / x)' END AS manufacturer,
               CASE WHEN p_partkey % 7 = 0 THEN 'yes' ELSE 'no' END AS isbios,
               CASE WHEN p_partkey % 11 = 0 THEN 'yes' ELSE 'no' END AS isdevice,
               CASE WHEN p_partkey % 17 = 0 THEN 'yes' ELSE 'no' END AS ismechanical,
               CASE WHEN p_partkey % 19 = 0 THEN 'samples' ELSE '' END AS sampleof,
               p_partkey % 9 AS rom_count,
               (p_partkey % 9) * (p_partkey * 7919 + 13) AS rom_bytes,
               CASE WHEN p_partkey % 6 = 0 THEN 'yes' ELSE 'no' END AS disk_required,
               CASE WHEN p_partkey % 12 = 0 THEN 'ide:0:hdd:image,cdrom,cdrom' WHEN p_partkey % 18 = 0 THEN 'laserdisc,gdrom' WHEN p_partkey % 6 = 0 THEN 'mystery' ELSE '' END AS disk_regions,
               CASE WHEN p_partkey % 8 = 0 THEN 'x' ELSE CAST(p_partkey % 5 AS STRING) END AS players_raw,
               CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_partkey % 4 AS STRING) END AS channels_raw,
               p_partkey % 3 AS speakers,
               CASE WHEN p_partkey % 15 = 0 THEN 'yes' ELSE 'no' END AS samples,
               p_partkey AS ordinal
        FROM part""",
    "class": """
        SELECT CASE WHEN p_partkey % 4 = 0 OR p_partkey % 10 = 1 THEN 'p' ELSE 'x' END || CAST(p_partkey AS STRING) AS machine,
               CASE p_partkey % 3 WHEN 0 THEN 'no_game' WHEN 1 THEN 'game' ELSE CASE WHEN p_partkey % 5 = 0 THEN 'unknown' ELSE 'game' END END AS game_status,
               CASE WHEN p_partkey % 5 = 4 THEN 'Handheld' WHEN p_partkey % 6 = 5 THEN 'Arcade,' || p_type ELSE 'Arcade' END AS category,
               CASE WHEN p_partkey % 20 = 0 THEN 'Pinball / ' || p_brand ELSE p_brand END AS type
        FROM part""",
    "catlist": """
        SELECT CASE WHEN p_partkey % 9 = 0 THEN 'x' ELSE 'p' END || CAST(p_partkey AS STRING) AS machine,
               CASE WHEN p_partkey % 8 = 0 THEN 'Non-Arcade' ELSE 'Arcade' END AS grp,
               CASE p_size % 7 WHEN 0 THEN 'Casino' WHEN 1 THEN 'Shooter' WHEN 2 THEN 'Maze' WHEN 3 THEN 'Medal Game' ELSE 'Platform' END AS category,
               CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS subcategory
        FROM part""",
    "ports": f"""
        SELECT CASE WHEN l_partkey % 3 = 2 THEN 'x' ELSE 'p' END || CAST(l_partkey AS STRING) AS machine,
               CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_partkey * 3 + 1 END AS source_id,
               CASE l_returnflag WHEN 'A' THEN 'CONSOLES' WHEN 'N' THEN 'COMPUTERS' ELSE 'HANDHELDS' END AS category,
               l_orderkey * 10 + l_linenumber AS row_no,
               CASE l_linenumber WHEN 1 THEN 'JP,US' WHEN 2 THEN '' ELSE 'EU' END AS regions,
               CASE WHEN l_linenumber = 7 THEN ' ' WHEN l_linenumber = 6 THEN '' ELSE 'Platform ' || CAST(l_suppkey % 7 AS STRING) END AS platform,
               CASE WHEN l_linenumber % 2 = 0 THEN 'Title ' || CAST(l_suppkey % 5 AS STRING) ELSE '' END AS title,
               CASE WHEN l_linenumber = 3 THEN '' WHEN l_orderkey % 5 = 0 THEN CAST(extract(year FROM l_shipdate) AS STRING) || '-XX-XX' ELSE {_YMD.format("l_shipdate")} END AS date,
               CASE WHEN l_linenumber = 4 THEN '' ELSE 'Pub ' || CAST(l_suppkey % 11 AS STRING) END AS publisher,
               CASE WHEN l_linenumber = 5 THEN 'Great!' WHEN l_linenumber = 1 THEN 'plain' ELSE '' END AS comment,
               CASE WHEN l_linenumber = 2 THEN 'Budget,Reissue' ELSE '' END AS tags,
               CASE WHEN l_linenumber < 3 THEN 'M' || CAST(l_suppkey % 3 AS STRING) ELSE '' END AS model
        FROM lineitem""",
    "chips": """
        SELECT 'p' || CAST(l_partkey AS STRING) AS machine, l_orderkey * 10 + l_linenumber AS pos,
               CASE WHEN l_linenumber % 2 = 1 THEN 'cpu' WHEN l_linenumber = 6 THEN 'other' ELSE 'audio' END AS type,
               CASE l_suppkey % 6 WHEN 0 THEN 'Z80' WHEN 1 THEN 'z80' WHEN 2 THEN 'M6502' WHEN 3 THEN 'Speaker' WHEN 4 THEN 'YM2151' ELSE 'Samples' END AS chip,
               CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 3579545 WHEN 3 THEN 400 ELSE 1500000000 END AS clock_hz
        FROM lineitem""",
    "displays": """
        SELECT 'p' || CAST(l_partkey AS STRING) AS machine, l_orderkey * 10 + l_linenumber AS pos,
               CASE l_linenumber WHEN 1 THEN 'raster' WHEN 2 THEN 'vector' WHEN 3 THEN 'lcd' WHEN 4 THEN 'svg' ELSE 'raster' END AS type,
               CASE l_suppkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '90' WHEN 2 THEN '270' ELSE '45' END AS rotate,
               CASE WHEN l_linenumber = 5 THEN '0' WHEN l_linenumber = 2 THEN '' ELSE CAST(256 + l_suppkey % 2 AS STRING) END AS width,
               CASE WHEN l_linenumber = 6 THEN 'x' WHEN l_linenumber = 2 THEN '' ELSE '224' END AS height,
               CASE WHEN l_suppkey % 3 = 0 THEN '59.5' WHEN l_suppkey % 3 = 1 THEN '60' ELSE '' END AS refresh
        FROM lineitem""",
    "controls": """
        SELECT 'p' || CAST(l_partkey AS STRING) AS machine, l_orderkey * 10 + l_linenumber AS pos,
               CAST(l_linenumber % 3 + 1 AS INT) AS player,
               CASE l_suppkey % 5 WHEN 0 THEN 'joy' WHEN 1 THEN 'only_buttons' WHEN 2 THEN 'dial' WHEN 3 THEN 'crank' ELSE '' END AS type,
               CAST(CASE WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey % 4 END AS INT) AS buttons,
               CASE l_suppkey % 7 WHEN 0 THEN '8' WHEN 1 THEN 'vertical2' WHEN 2 THEN '8 (half16)' WHEN 3 THEN 'strange2' ELSE '' END AS ways,
               CASE WHEN l_suppkey % 7 = 1 THEN '4' ELSE '' END AS ways2
        FROM lineitem""",
    "obs": """
        SELECT 'c' || CAST(o_custkey AS STRING) AS machine,
               lpad(CAST(270 + extract(month FROM o_orderdate) AS STRING), 4, '0') AS release,
               min(o_orderpriority) AS category
        FROM orders GROUP BY 1, 2""",
    "requests": """
        SELECT 'c' || CAST(c_custkey AS STRING) AS machine, lpad(CAST(270 + c_custkey % 14 AS STRING), 4, '0') AS release
        FROM customer""",
    "before": """
        SELECT CASE WHEN c_custkey % 10 = 0 THEN 'b' ELSE 'c' END || CAST(c_custkey AS STRING) AS machine, c_name AS title, c_mktsegment AS manufacturer,
               'Page ' || CAST(c_custkey - c_custkey % 2 AS STRING) AS page, CAST(c_nationkey AS STRING) AS ports_display
        FROM customer""",
    "after": """
        SELECT CASE WHEN c_custkey % 11 = 0 THEN 'a' ELSE 'c' END || CAST(c_custkey AS STRING) AS machine,
               CASE WHEN c_custkey % 7 = 0 THEN c_name || ' II' ELSE c_name END AS title,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS manufacturer,
               'Page ' || CAST(c_custkey - c_custkey % 2 AS STRING) || CASE WHEN c_custkey % 17 = 0 THEN ' (new)' ELSE '' END AS page,
               CASE WHEN c_custkey % 5 = 0 THEN CAST(c_nationkey + 1 AS STRING) ELSE CAST(c_nationkey AS STRING) END AS ports_display
        FROM customer""",
    "blocks_before": """
        SELECT 'c' || CAST(o_custkey AS STRING) AS machine, CASE WHEN o_orderkey % 3 = 0 THEN 'TRIVIA' ELSE 'UPDATES' END AS section,
               o_orderkey AS block_index, CASE WHEN o_orderkey % 4 = 0 THEN 'subheading' ELSE 'paragraph' END AS type,
               o_orderpriority || ' text ' || CAST(o_orderkey % 9 AS STRING) AS text
        FROM orders""",
    "blocks_after": """
        SELECT CASE WHEN o_orderkey % 37 = 0 THEN 'a' ELSE 'c' END || CAST(o_custkey AS STRING) AS machine, CASE WHEN o_orderkey % 3 = 0 THEN 'TRIVIA' ELSE 'UPDATES' END AS section,
               CASE WHEN o_orderkey % 29 = 0 THEN o_orderkey + 1000000000 WHEN o_orderkey % 31 = 0 THEN -o_orderkey ELSE o_orderkey END AS block_index,
               CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 43 <> 0 THEN 'subheading' ELSE 'paragraph' END AS type,
               o_orderpriority || ' text ' || CAST(o_orderkey % 9 AS STRING) || CASE WHEN o_orderkey % 41 = 0 THEN ' edited' ELSE '' END AS text
        FROM orders""",
    "findings": """
        SELECT lpad(CAST(280 + event_id % 6 AS STRING), 4, '0') AS release, event_type AS rule_id, 'u' || CAST(user_id AS STRING) AS machine,
               'PORTS' AS section, 'line ' || CAST(event_id % 5 AS STRING) AS source_text,
               CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 4 AS STRING) ELSE NULL END AS value
        FROM events""",
    "titles": """
        SELECT 'p' || CAST(p_partkey AS STRING) AS machine,
               CASE p_partkey % 12
                 WHEN 0 THEN p_name || ' - Part ' || CAST(p_size AS STRING) || ' (set 1)'
                 WHEN 1 THEN p_name || ' / ' || p_type || ': Again (' || p_brand || ')'
                 WHEN 2 THEN p_name || ' (World [rev A], 4/1) extra words'
                 WHEN 3 THEN p_name || ' (unclosed'
                 WHEN 4 THEN p_name || ' closed)'
                 WHEN 5 THEN 'A(b)c ' || p_name || ' [x] (y)'
                 WHEN 6 THEN p_name || ' (Japan / US) / Other - Sub [rev 2] (B)'
                 WHEN 7 THEN '  ' || p_name || '   spaced  '
                 WHEN 8 THEN p_name || '] [open'
                 WHEN 9 THEN 'One / Two: Deux / Three - Trois (v1) (v2)'
                 WHEN 10 THEN p_name
                 ELSE '' END AS description
        FROM part""",
    "text_dates": """
        SELECT o_orderkey,
               CASE o_orderkey % 20
                 WHEN 0 THEN CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 1 THEN substr(CAST(extract(year FROM o_orderdate) AS STRING), 1, 3) || '?'
                 WHEN 2 THEN CAST(extract(year FROM o_orderdate) AS STRING) || '-' || CAST(extract(month FROM o_orderdate) AS STRING)
                 WHEN 3 THEN CAST(extract(year FROM o_orderdate) AS STRING) || '/' || CAST(extract(month FROM o_orderdate) AS STRING) || '/' || CAST(extract(day FROM o_orderdate) AS STRING)
                 WHEN 4 THEN CAST(extract(day FROM o_orderdate) AS STRING) || '/' || CAST(extract(month FROM o_orderdate) AS STRING) || '/' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 5 THEN CAST(extract(month FROM o_orderdate) AS STRING) || '-' || CAST(extract(day FROM o_orderdate) AS STRING) || '-' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 6 THEN CAST(extract(day FROM o_orderdate) AS STRING) || 'th  march ' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 7 THEN 'Feb. ' || CAST(extract(day FROM o_orderdate) AS STRING) || ', ' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 8 THEN 'Sept ' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 9 THEN 'Dec ??, ' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 10 THEN '???. ??, ' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 11 THEN 'Monday 3 May 1990'
                 WHEN 12 THEN 'Q3 ' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 13 THEN 'March'
                 WHEN 14 THEN CAST(extract(year FROM o_orderdate) AS STRING) || '-2001'
                 WHEN 15 THEN '31/02/' || CAST(extract(year FROM o_orderdate) AS STRING)
                 WHEN 16 THEN '  "' || CAST(extract(year FROM o_orderdate) AS STRING) || '.;" '
                 WHEN 17 THEN ''
                 WHEN 18 THEN 'winter ' || CAST(extract(year FROM o_orderdate) AS STRING)
                 ELSE 'soon' END AS raw
        FROM orders""",
    "lines": """
        SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS line_no,
               CASE o_orderkey % 23
                 WHEN 0 THEN '- TRIVIA -' WHEN 1 THEN '-- Updates --' WHEN 2 THEN '' WHEN 3 THEN '* item ' || CAST(o_orderkey % 5 AS STRING)
                 WHEN 4 THEN '- Tips & Tricks -' WHEN 5 THEN '1) numbered' WHEN 6 THEN 'Label : value' WHEN 7 THEN '-Foo-'
                 WHEN 8 THEN '--- PORTS ---' WHEN 9 THEN '* CONSOLES :' WHEN 10 THEN 'Platform X [US] "Title" (1990) by Maker'
                 WHEN 11 THEN '- update -' WHEN 12 THEN 'ALL CAPS LINE' WHEN 13 THEN '- CONTRIBUTE -'
                 WHEN 14 THEN 'https://example.org/?page=detail&id=' || CAST(o_custkey AS STRING)
                 WHEN 15 THEN '-----' WHEN 16 THEN 'Intro text follows:' WHEN 17 THEN '*Emphasis*: text'
                 WHEN 18 THEN '* ARCADE :' WHEN 19 THEN '"Only Title" (soon)' WHEN 20 THEN 'Odd "quote (1991)' WHEN 21 THEN '- ODDITIES ' || CAST(o_orderkey % 3 AS STRING) || ' -'
                 ELSE 'Plain words number ' || CAST(o_orderkey % 11 AS STRING) || '.' END AS line
        FROM orders""",
    "port_lines": """
        SELECT 'c' || CAST(o_custkey AS STRING) AS machine, o_orderkey AS line_no,
               CASE o_orderkey % 12
                 WHEN 0 THEN '[JP] [US] Super Box [Model ABC-1/ABC-2] "Great Game" (' || CAST(extract(year FROM o_orderdate) AS STRING) || ') by Maker, Inc.'
                 WHEN 1 THEN 'Home Computer [EU] (may ' || CAST(extract(day FROM o_orderdate) AS STRING) || ', ' || CAST(extract(year FROM o_orderdate) AS STRING) || ') by - Some House : a "quoted: part" here'
                 WHEN 2 THEN 'Floppy PC 3.5" [US] "Disk: Game" (19??) released by Other'
                 WHEN 3 THEN '"Only Title" (soon)'
                 WHEN 4 THEN 'Handheld by Somebody'
                 WHEN 5 THEN 'Odd "quote (1991)'
                 WHEN 6 THEN 'Odd bracket (1991'
                 WHEN 7 THEN '[US] [Budget] [Model X100 (X100A)] Console "T" (1992) Publisher only.'
                 WHEN 8 THEN 'Thing : comment only'
                 WHEN 9 THEN '[Model Z (other)] Box (1989)'
                 WHEN 10 THEN 'Plain Platform'
                 ELSE '[US]' END AS line
        FROM orders""",
    "ini": """
        SELECT CASE p_size % 3 WHEN 0 THEN 'status' WHEN 1 THEN 'category' ELSE 'type' END AS list,
               CASE WHEN p_partkey % 31 = 0 THEN '< Not  Available >' WHEN p_size % 3 = 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'No Game' ELSE 'Game' END
                    WHEN p_size % 3 = 1 THEN p_type ELSE p_brand END AS section,
               'p' || CAST(p_partkey % 300 AS STRING) AS machine, p_partkey AS ordinal
        FROM part""",
    "overrides": """
        SELECT CASE WHEN p_partkey % 3 = 0 THEN 'p' ELSE 'x' END || CAST(p_partkey AS STRING) AS machine, CASE WHEN p_partkey % 15 = 0 THEN ' ' ELSE 'Fixed ' || p_name END AS new_description,
               CASE WHEN p_partkey % 6 = 0 THEN FALSE ELSE TRUE END AS only_if_unbalanced, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE 'note' END AS note
        FROM part""",
    "files_before": """
        SELECT CASE p_partkey % 3 WHEN 0 THEN 'lists' WHEN 1 THEN 'machines' ELSE 'articles' END AS stage, p_name || CAST(p_partkey AS STRING) AS path,
               CAST(p_size AS BIGINT) AS size, md5(p_name) AS digest
        FROM part""",
    "files_after": """
        SELECT CASE p_partkey % 3 WHEN 0 THEN 'lists' WHEN 1 THEN 'machines' ELSE 'articles' END AS stage, p_name || CASE WHEN p_partkey = 5 THEN ' (new)' ELSE CAST(p_partkey AS STRING) END AS path,
               CAST(CASE WHEN p_partkey = 3 THEN p_size + 1 ELSE p_size END AS BIGINT) AS size, md5(p_name) AS digest
        FROM part""",
}


def oracle(sql: str) -> str:
    """``sql`` over views named v_<name>, as one DuckDB statement."""
    sql = sql.strip()
    recursive = "RECURSIVE " if sql.upper().startswith("WITH RECURSIVE ") else ""
    own = ", " + sql[5 + len(recursive) :] if sql.upper().startswith("WITH ") else " " + sql
    return f"WITH {recursive}" + ", ".join(f"v_{n} AS ({s})" for n, s in VIEWS.items()) + own


class Views:
    """The views and tables of one data folder; all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        used = [t for t in TABLES if f"FROM {t}" in VIEWS[name]]
        sql = VIEWS[name]
        for t in used:
            sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
        return self.spark.sql(sql, **{t: self.table(t) for t in used})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The SQL of each oracle over the views v_<name>, for oracles made of others.
PARTS: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable:
    """Register a function of Views under ``key``, with its oracle where SQL can express it."""

    def add(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[key] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql:
            ORACLES[key], PARTS[key] = oracle(sql), sql
        return fn

    return add

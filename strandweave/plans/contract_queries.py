"""The contracts of the eight published tables, over records made from every row of the views, some of which break them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..operators.contract_documents import DOCUMENTS
from ..operators.contracts import expect_contract as expect
from .views import Views, query

_NONE = "CAST(array() AS array<string>)"
_CHIP = "named_struct('heading', '', 'count', 0, 'items', " + _NONE + ")"

#: table -> (view, key, record as a Spark expression; nulls are written as JSON's null).
RECORDS = {
    "machines": (
        "machines",
        "name",
        f"""named_struct('description', description, 'sourcefile', sourcefile, 'cloneof', cloneof, 'isbios', isbios, 'isdevice', isdevice, 'ismechanical', ismechanical, 'year', year, 'manufacturer', manufacturer,
            'rom_count', rom_count, 'rom_bytes_total', rom_bytes, 'disk_required', disk_required, 'disk_regions', split(disk_regions, ','), 'disk_media_platforms_count', ordinal % 3 - 1, 'cpu_count', 1, 'sound_chip_count', 1,
            'chips', array(named_struct('type', CASE WHEN ordinal % 4 = 0 THEN 'other' ELSE 'cpu' END, 'name', 'Z80', 'tag', CAST(NULL AS STRING), 'clock_hz', ordinal), named_struct('type', 'audio', 'name', 'x', 'tag', 't', 'clock_hz', CAST(NULL AS BIGINT))),
            'sound_channels', CAST(NULL AS INT), 'device_ref', array(named_struct('samples', samples, 'speaker', speakers)), 'sampleof', sampleof, 'display_count', 1,
            'displays', array(named_struct('tag', CAST(NULL AS STRING), 'type', 'raster', 'rotate', 0, 'width', ordinal % 5, 'height', 1, 'refresh_hz', 59.5)), 'players', 2, 'controls', {_NONE})""",
    ),
    "parent_index": ("machines", "CASE WHEN ordinal % 7 = 0 THEN upper(name) ELSE name END", "CASE WHEN ordinal % 5 = 0 THEN upper(name) ELSE coalesce(cloneof, name) END"),
    "classifications": ("class", "machine", f"named_struct('game_status', replace(game_status, 'unknown', 'maybe'), 'category', CASE WHEN machine LIKE 'x%' THEN {_NONE} ELSE split(category, ',') END, 'type', CASE WHEN category = 'Handheld' THEN '' ELSE type END)"),
    "ports": (
        "ports",
        "machine || '_' || row_no",
        """named_struct('gh_id', source_id, 'aliases', CASE WHEN category = 'COMPUTERS' THEN array('a', 'a') ELSE array('a', 'b') END, 'port_overview', '', 'ports', map(category,
            array(named_struct('regions', split(regions, ','), 'platform', platform, 'model', split(model, ','), 'title', title, 'date', date, 'publisher', publisher, 'comment', comment, 'additional_tags', split(tags, ','), 'residue', array(''))))) """,
    ),
    "trivia": (
        "blocks_after",
        "machine || '_' || block_index",
        f"""named_struct('gh_id', 1, 'sections', map(section, named_struct('blocks', array(named_struct('type', type, 'text', text, 'meta', named_struct('system', machine, 'section_tag', section, 'block_index', block_index,
            'filtered_line_start', 0, 'filtered_line_end', 0, 'policy', named_struct('per_line', true, 'heuristic_per_line', false), 'detectors', array('d'), 'suppressions', {_NONE}, 'text_hash', substr(md5(text), 1, 8)))))))""",
    ),
    "raw": (
        "before",
        "machine",
        f"""named_struct('machine', machine, 'wiki_page_name', page, 'wiki_redirects', {_NONE}, 'mame_titles', array(named_struct('role', 'parent', 'machine', machine, 'title', title, 'year', '1990')),
            'description', named_struct('title1', title, 'subtitle1', '', 'version1', '', 'global_version', '', 'title2', ''), 'year', '199?', 'manufacturer', manufacturer, 'rom_count', 0, 'rom_bytes_total', 0, 'disk_required', 'no', 'disk_regions', {_NONE},
            'chips', named_struct('cpus', {_CHIP}, 'audio_chips', {_CHIP}, 'requires_samples', false, 'audio_channels', 0, 'speakers', 0), 'displays', named_struct('heading', '', 'count', CAST(ports_display AS INT) % 2, 'groups', {_NONE}),
            'controls', named_struct('players', 0, 'per_player', {_NONE}), 'ports', named_struct('clone_sources', {_NONE}, 'parent_source', map_from_arrays({_NONE}, {_NONE})), 'game_status', CASE WHEN machine LIKE 'b%' THEN 'no_game' ELSE 'no-game' END, 'category', array('x'), 'type', '',
            'isbios', false, 'isdevice', false, 'ismechanical', false, 'requires_samples', true, 'gh_ids', array(CAST(ports_display AS INT)))""",
    ),
    "wiki": (
        "after",
        "machine",
        f"""named_struct('wiki_page_name', page, 'opening_sentence', title, 'wiki_redirects', CASE WHEN manufacturer IS NULL THEN array(page, page) ELSE array(page) END, 'year', '199?', 'manufacturer', manufacturer, 'mame_titles_display', array(title), 'roms_display', '',
            'chips_display', '', 'displays_display', '', 'controls_display', '', 'ports_display', map(CASE WHEN title LIKE '% II' THEN 'CONSOLES' ELSE 'Consoles' END, array(ports_display)), 'gh_ids', array(1), 'extra', 1)""",
    ),
    "pages": ("after", "machine", "CASE WHEN machine LIKE 'a%' THEN '' ELSE page END"),
}


def checked(v: Views, table: str) -> DataFrame:
    view, key, record = RECORDS[table]
    text = f"'\"' || {record} || '\"'" if "struct" not in record else f"to_json({record}, map('ignoreNullFields', 'false'))"
    rows = v.spark.sql(f"SELECT {key} AS key, {text} AS value FROM {{rows}}", rows=getattr(v, view))
    document, steps = DOCUMENTS[table]
    return expect(rows, document, *steps).selectExpr(f"'{table}' AS contract", "key", "path", "rule", "detail")


def _rows(table: str, view: str, key: str, *broken: tuple[str, str, str, str]) -> str:
    """SQL of the violations of a table: (where, path below the key or null, rule, detail)."""
    path = lambda p: "''" if p is None else f"'/' || {key} || {p}"
    return " UNION ALL ".join(f"SELECT '{table}' AS contract, {key} AS key, {path(p)} AS path, '{rule}' AS rule, {detail} AS detail FROM v_{view} WHERE {where}" for where, p, rule, detail in broken)


ORACLE = " UNION ALL ".join(
    [
        _rows("machines", "machines", "name", ("description IS NULL", "'/description'", "type", "'null'"), ("ordinal % 3 = 0", "'/disk_media_platforms_count'", "minimum", "'-1'"), ("ordinal % 4 = 0", "'/chips/0/type'", "enum", "'\"other\"'"), ("ordinal % 5 = 0", "'/displays/0/width'", "minimum", "'0'")),
        _rows("parent_index", "machines", RECORDS["parent_index"][1], ("ordinal % 7 = 0", None, "additionalProperties", "upper(name)"), ("ordinal % 7 <> 0 AND ordinal % 5 = 0", "''", "pattern", "upper(name)")),
        _rows("classifications", "class", "machine", ("game_status = 'unknown'", "'/game_status'", "enum", "'\"maybe\"'"), ("machine LIKE 'x%'", "'/category'", "minItems", "'0'"), ("category = 'Handheld'", "'/type'", "minLength", "''")),
        _rows(
            "ports", "ports", "machine || '_' || row_no", ("source_id IS NULL", "'/gh_id'", "type", "'null'"), ("category = 'COMPUTERS'", "'/aliases'", "uniqueItems", "'2'"), ("platform = ''", "'/ports/' || category || '/0/platform'", "minLength", "''"),
            ("regions = ''", "'/ports/' || category || '/0/regions/0'", "pattern", "''"), ("date = ''", "'/ports/' || category || '/0/date'", "pattern", "''"),
        ),
        _rows("trivia", "blocks_after", "machine || '_' || block_index", ("block_index < 0", "'/sections/' || section || '/blocks/0'", "oneOf", "''")),
        _rows("raw", "before", "machine", ("machine LIKE 'b%'", "'/game_status'", "enum", "'\"no_game\"'"), ("CAST(ports_display AS INT) % 2 = 1", "'/displays/groups'", "minItems", "'0'"), ("ports_display = '0'", "'/gh_ids/0'", "minimum", "'0'")),
        _rows("wiki", "after", "machine", ("manufacturer IS NULL", "'/wiki_redirects'", "uniqueItems", "'2'"), ("manufacturer IS NULL", "'/manufacturer'", "type", "'null'"), ("title LIKE '% II'", "'/ports_display'", "additionalProperties", "'CONSOLES'"), ("TRUE", "''", "additionalProperties", "'extra'")),
        _rows("pages", "after", "machine", ("machine LIKE 'a%'", "''", "minLength", "''")),
    ]
)


@query("expect_contract", ORACLE)
def expect_contract(v: Views):
    return reduce(DataFrame.union, (checked(v, table) for table in RECORDS))

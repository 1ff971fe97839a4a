"""The contracts of the published tables, as documents for ``contracts``. Their words, names, patterns and bounds are fixed
values: they must be those of the documents that users exchange."""

from __future__ import annotations

NAME = "^[a-z0-9_]+$"
LOOSE_DATE = r"^[0-9X]{4}-(\d{2}|XX)-(\d{2}|XX)$"
TEXT, FULL, MAYBE, FLAG = {"type": "string"}, {"type": "string", "minLength": 1}, {"type": ["string", "null"]}, {"type": "boolean"}
YES_NO = {"type": "string", "enum": ["yes", "no"]}
MACHINE = {"type": "string", "pattern": NAME}


def whole(minimum: int | None = None, null: bool = False) -> dict:
    return {"type": ["integer", "null"] if null else "integer"} | ({} if minimum is None else {"minimum": minimum})


def listed(items: dict, least: int = 0, unique: bool = False) -> dict:
    return {"type": "array", "items": items} | ({"minItems": least} if least else {}) | ({"uniqueItems": True} if unique else {})


def record(optional: dict | None = None, **required: dict) -> dict:
    """An object with these members and no others."""
    return {"type": "object", "additionalProperties": False, "required": list(required), "properties": required | (optional or {})}


def keyed(value: dict, least: int = 0, pattern: str = NAME) -> dict:
    """An object from names to values."""
    return {"type": "object", "additionalProperties": False, "patternProperties": {pattern: value}} | ({"minProperties": least} if least else {})


VERSIONS = record(mame_xml_version=TEXT, gaming_history_xml_version=TEXT, ini_versions={"type": "object", "minProperties": 1, "additionalProperties": TEXT})


def header(version: str, **more: dict) -> dict:
    return record(more.pop("optional", None), schema_id=FULL, schema_version={"type": "string", "const": version}, generated_at={"type": "string", "format": "date-time"}, **more)


MACHINES = keyed(
    record(
        description=TEXT, sourcefile=TEXT, cloneof=MAYBE, isbios=YES_NO, isdevice=YES_NO, ismechanical=YES_NO, year=TEXT, manufacturer=TEXT,
        rom_count=whole(0), rom_bytes_total=whole(0), disk_required=YES_NO, disk_regions=listed(TEXT), disk_media_platforms_count=whole(0),
        cpu_count=whole(0), sound_chip_count=whole(0), sound_channels=whole(0, True), sampleof=MAYBE, display_count=whole(0), players=whole(0, True),
        chips=listed(record(type={"type": "string", "enum": ["cpu", "audio"]}, name=TEXT, tag=MAYBE, clock_hz=whole(null=True))),
        device_ref=listed(record(samples=YES_NO, speaker=whole(0))),
        displays=listed(record(tag=MAYBE, type={"type": "string", "enum": ["raster", "vector", "lcd", "svg"]}, rotate=whole(null=True), width=whole(1, True), height=whole(1, True), refresh_hz={"type": ["number", "null"]})),
        controls=listed(record(player=whole(1, True), type=MAYBE, buttons=whole(0, True), reqbuttons=whole(0, True), ways=MAYBE, ways2=MAYBE, ways3=MAYBE)),
    )
)

PARENT_INDEX = record(parents=keyed(listed(MACHINE, 1, True)), child_to_parent=keyed(MACHINE))

CLASSIFICATIONS = keyed(record(game_status={"type": "string", "enum": ["game", "no_game", "unknown"]}, category=listed(FULL, 1), type=FULL))

_REGION, _DATE = {"type": "string", "pattern": "^[A-Z?]{2}$"}, {"type": ["string", "null"], "pattern": LOOSE_DATE}
_PORT = {"platform": FULL, "model": listed(TEXT), "title": MAYBE, "date": _DATE, "publisher": MAYBE, "comment": MAYBE, "additional_tags": listed(TEXT)}
CATEGORIES = ("CONSOLES", "HANDHELDS", "COMPUTERS", "OTHERS")


def _categories(item: dict, least: int = 0) -> dict:
    return {"type": "object", "additionalProperties": False, "properties": {c: listed(item, least) for c in CATEGORIES}}


PORTS = keyed(record(gh_id=whole(1), aliases=listed(FULL, unique=True), port_overview=TEXT, ports=_categories(record(regions=listed(_REGION), residue=listed(TEXT), **_PORT))))

_META = record(
    {"raw_line_start": whole(1, True), "raw_line_end": whole(1, True), "preamble_for_list": FLAG, "preamble_target_index": whole(0), "preamble_text": FULL},
    system=FULL, section_tag=FULL, block_index=whole(0), filtered_line_start=whole(0), filtered_line_end=whole(0), policy=record(per_line=FLAG, heuristic_per_line=FLAG),
    detectors=listed(FULL, 1), suppressions=listed(FULL), text_hash={"type": "string", "pattern": "^[0-9a-f]{8}$"},
)


def _block(name: str, **members: dict) -> dict:
    return record(type={"const": name}, **members, meta={"$ref": "#/$defs/meta"})


TRIVIA = {
    "type": "object",
    "additionalProperties": {
        "type": "object",
        "additionalProperties": False,
        "properties": {
            "gh_id": whole(1),
            "sections_raw": {"type": "object", "additionalProperties": TEXT},
            "sections": {
                "type": "object",
                "additionalProperties": record(blocks=listed({"oneOf": [_block("paragraph", text=FULL), _block("bullet_list", items=listed(FULL, 1)), _block("numbered_list", items=listed(FULL, 1)), _block("pair", label=FULL, value=FULL), _block("subheading", text=FULL)]})),
            },
        },
    },
    "$defs": {"meta": _META},
}

_YEAR, _SHORT = {"type": "string", "pattern": "^[0-9?]{4,5}$"}, MACHINE | {"minLength": 1, "maxLength": 64}
_SOURCE = record(machine=_SHORT, gh_id=whole(1), categories=_categories(record(machine=_SHORT, gh_id=whole(1), regions=listed(_REGION, 1), **_PORT), 1))


def _when(name: str, test: dict, then: dict, other: dict | None = None) -> dict:
    return {"if": {"properties": {name: test}, "required": [name]}, "then": then} | ({"else": other} if other else {})


_GROUP = record({"width": whole(1), "height": whole(1)}, count=whole(0), type={"type": "string", "enum": ["Raster", "Vector", "LCD", "SVG"]}, orientation=TEXT, refresh={"type": "string", "pattern": r"^\d+(?:\.\d+)?\s*Hz$"})
_GROUP |= {"allOf": [_when("type", {"enum": ["Raster", "LCD"]}, {"required": ["width", "height"]}), _when("type", {"enum": ["SVG", "Vector"]}, {"not": {"anyOf": [{"required": ["width"]}, {"required": ["height"]}]}})]}
_CHIPS = record(heading=TEXT, count=whole(0), items=listed(TEXT))
_SOME = lambda name: {"properties": {name: {"minItems": 1}}}
_NO = lambda name: {"properties": {name: {"maxItems": 0}}}
RAW = record(
    header=header("1.2.0", versions=VERSIONS),
    games=keyed(
        record(
            {"snaps_classification": record(group=TEXT, category=TEXT, subcategory=TEXT)},
            machine=_SHORT, wiki_page_name=FULL, wiki_redirects=listed(TEXT), year=_YEAR, manufacturer=FULL, rom_count=whole(0), rom_bytes_total=whole(0), disk_required=YES_NO, disk_regions=listed(TEXT),
            mame_titles=listed(record(role={"type": "string", "enum": ["parent", "clone"]}, machine=_SHORT, title=FULL, year=_YEAR), 1),
            description=record(title1=TEXT, subtitle1=TEXT, version1=TEXT, global_version=TEXT) | {"patternProperties": {"^(title|subtitle|version)[2-9][0-9]*$": TEXT}},
            chips=record(cpus=_CHIPS, audio_chips=_CHIPS, requires_samples=FLAG, audio_channels=whole(0), speakers=whole(0)),
            displays=record(heading=TEXT, count=whole(0), groups=listed(_GROUP)) | {"allOf": [_when("count", {"const": 0}, _NO("groups"), _SOME("groups"))]},
            controls=record(players=whole(0), per_player=listed(record(player=whole(1), control_lines=listed(TEXT), buttons=whole(0)))) | {"allOf": [_when("players", {"const": 0}, _NO("per_player"), _SOME("per_player"))]},
            ports=record(clone_sources=listed(_SOURCE), parent_source={"anyOf": [{"type": "object", "maxProperties": 0}, _SOURCE]})
            | {"allOf": [{"anyOf": [_SOME("clone_sources"), {"properties": {"parent_source": {"properties": {"categories": {"anyOf": [{"required": [c]} for c in CATEGORIES]}}}}}]}]},
            game_status={"type": "string", "enum": ["game", "no-game", "unknown"]}, category=listed(TEXT, 1), type=TEXT, isbios=FLAG, isdevice=FLAG, ismechanical=FLAG, requires_samples=FLAG, gh_ids=listed(whole(1), 1),
        ),
        1,
    ),
)

WIKI = record(
    header=header("1.2.0", versions=VERSIONS),
    games=keyed(
        record(
            wiki_page_name=FULL, opening_sentence=FULL, wiki_redirects=listed(FULL, unique=True), year={"type": "string", "pattern": "^[0-9?]{4}$"}, manufacturer=FULL, mame_titles_display=listed(TEXT),
            roms_display=TEXT, chips_display=TEXT, displays_display=TEXT, controls_display=TEXT, gh_ids=listed(whole(0), unique=True),
            ports_display={"type": "object", "additionalProperties": False, "properties": {c.capitalize(): listed(TEXT) for c in CATEGORIES}},
        ),
        1,
    ),
)

_MANY = listed(MACHINE, 2, True)
PAGES = record(
    header=header("1.1.1", optional={"versions": VERSIONS}),
    prefix=FULL,
    stats=record({"redirect_page_collisions": whole(0)}, **{n: whole(0) for n in ("parents_total", "page_names_total", "redirects_total", "page_name_collisions", "redirect_conflicts")}),
    pages=keyed(FULL, 1),
    page_names=listed(FULL, 1, True),
    redirects=keyed(FULL, pattern="^.+$"),
    conflicts=record(
        {"redirect_page_collisions": listed(record(name=FULL, canonical_machines=listed(MACHINE, 1, True), candidates=listed(record(machine=MACHINE, target=FULL), 1), disambiguation_candidate=FLAG))},
        page_name_collisions=listed(record(page=FULL, machines=_MANY)),
        redirect_conflicts=listed(record(source=FULL, targets=listed(FULL, 2, True), machines=_MANY)),
    ),
)

#: Contract and the members that lead to the object whose entries are rows.
DOCUMENTS: dict[str, tuple[dict, tuple[str, ...]]] = {
    "machines": (MACHINES, ()),
    "parent_index": (PARENT_INDEX, ("child_to_parent",)),
    "classifications": (CLASSIFICATIONS, ()),
    "ports": (PORTS, ()),
    "trivia": (TRIVIA, ()),
    "raw": (RAW, ("games",)),
    "wiki": (WIKI, ("games",)),
    "pages": (PAGES, ("pages",)),
}

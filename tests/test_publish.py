"""Whole records and their projections, held against the contracts of the published documents."""

from pyspark.sql import functions as F

from strandweave.operators import contract_documents as D
from strandweave.operators import publish as B
from strandweave.operators.contracts import expect_contract

MACHINE = "name string, cloneof string, description string, year string, manufacturer string, rom_count long, rom_bytes long, disk_required string, disk_regions array<string>, isbios string, isdevice string, ismechanical string, requires_samples string, channels long, players long"
PORT = "machine string, source_id long, category string, row_no int, regions array<string>, platform string, model array<string>, title string, date string, publisher string, comment string, tags array<string>"


def made(spark):
    machines = spark.createDataFrame(
        [
            ("pac", None, "Pac: Man / Puck - Two (Rev A)", "1980", "Maker / Other", 2, 2048, "yes", ["laserdisc"], "no", "no", "no", "no", 1, 2),
            ("puck", "pac", "Puck Boy (bootleg)", "1981", "X", 1, 10, "no", [], "no", "no", "no", "no", None, None),
            ("quiet", None, "Quiet", "", "", 0, 0, "no", [], "no", "no", "no", "no", None, None),
            ("only", None, "Only Clones", "199?", "Y", 0, 0, "no", None, "no", "no", "yes", "yes", 0, 0),
            ("onlyc", "only", "Only Child", "1999", "Y", 0, 0, "no", None, "no", "no", "no", "no", 0, 0),
        ],
        MACHINE,
    )
    classes = spark.createDataFrame([("pac", "game", ["Arcade"], "Maze"), ("only", "game", ["Arcade"], "Maze")], "machine string, game_status string, category array<string>, type string")
    chips = spark.createDataFrame([("pac", 0, "cpu", "Z80", 3072000), ("pac", 1, "cpu", "Z80", 3072000), ("pac", 2, "audio", "Speaker", None), ("pac", 3, "audio", "WSG", 96000)], "machine string, pos int, type string, chip string, clock_hz long")
    displays = spark.createDataFrame([("pac", 0, "raster", "90", "224", "288", "60.6"), ("pac", 1, "vector", "0", "", "", "40")], "machine string, pos int, type string, rotate string, width string, height string, refresh string")
    controls = spark.createDataFrame([("pac", 0, 1, "joy", 1, "4", "")], "machine string, pos int, player int, type string, buttons int, ways string, ways2 string")
    ports = spark.createDataFrame(
        [
            ("pac", 7, "CONSOLES", 2, ["JP"], "Box", [], "T", "1984-XX-XX", "P", None, []),
            ("pac", 7, "CONSOLES", 1, [" "], "First", ["M1"], None, None, None, "note", ["Budget"]),
            ("puck", 9, "COMPUTERS", 1, ["US"], "PC", [], None, "1983-01-02", None, None, []),
            ("onlyc", 3, "OTHERS", 1, [], "Thing", [], None, None, None, None, []),
            ("quiet", 4, "OTHERS", 1, ["US"], " ", [], None, None, None, None, []),
        ],
        PORT,
    )
    catlist = spark.createDataFrame([("pac", "Arcade", "Maze", "Collect"), ("only", "Arcade", "Maze", "Other")], "machine string, grp string, category string, subcategory string")
    phrases = spark.createDataFrame([("Arcade", "Maze", "Collect", "a maze game")], "grp string, category string, subcategory string, phrase string")
    return B.parent_records(machines, classes, chips, displays, controls, ports, catlist, phrases)


def test_records(spark):
    got = {r["name"]: r for r in made(spark).collect()}
    assert set(got) == {"pac", "only"}
    pac, only = got["pac"], got["only"]
    assert pac["wiki_page_name"] == "Pac: Man" and pac["wiki_redirects"] == ["Puck", "Puck: Two", "Pac", "Puck Boy"]
    assert pac["description"] == {"title1": "Pac", "subtitle1": "Man", "version1": "", "title2": "Puck", "subtitle2": "Two", "global_version": "Rev A"}
    assert [(t["role"], t["machine"]) for t in pac["mame_titles"]] == [("parent", "pac"), ("clone", "puck")]
    assert pac["mame_titles_display"] == ["Pac: Man / Puck - Two (Rev A) (1980) [parent: pac]", "Puck Boy (bootleg) (1981) [clone: puck]"]
    assert pac["opening_sentence"] == "Pac: Man is an interactive maze game featuring vector graphics, published in 1980 by Maker & Other."
    assert pac["chips"].asDict(True) == {"cpus": {"heading": "CPUs", "count": 2, "items": ["(2x) Z80 @ 3.072 MHz"]}, "audio_chips": {"heading": "Audio Chip", "count": 1, "items": ["WSG @ 96.000 kHz"]}, "requires_samples": False, "audio_channels": 1, "speakers": 1}
    assert pac["chips_display"] == "CPU:\n(2x) Z80 @ 3.072 MHz\nAudio Chip:\nWSG @ 96.000 kHz"
    assert [(g["type"], g["width"], g["refresh"]) for g in pac["displays"]["groups"]] == [("Raster", 224, "60.600 Hz"), ("Vector", None, "40.000 Hz")]
    assert [(p["player"], p["control_lines"], p["buttons"]) for p in pac["controls"]["per_player"]] == [(1, ["4-way Joystick"], 1), (2, ["Unknown controls"], 0)]
    assert [p["platform"] for p in pac["ports"]["parent_source"]["categories"]["CONSOLES"]] == ["First", "Box"] and pac["ports"]["clone_sources"][0]["gh_id"] == 9
    assert set(pac["ports_display"]) == {"Consoles", "Computers"} and pac["gh_ids"] == [7, 9] and pac["snaps_classification"]["subcategory"] == "Collect"
    assert only["ports"]["parent_source"] is None and only["opening_sentence"] is None and only["displays_display"] == "Screens: 0" and only["displays"]["groups"] == [] and only["ismechanical"]


def test_projections_keep_their_contracts(spark):
    records = made(spark)
    raw = B.project_raw(records).select(F.col("name").alias("key"), F.to_json("record").alias("value"))
    assert expect_contract(raw, D.RAW, "games").collect() == []
    wiki = B.project_wiki(records, spark.createDataFrame([("pac",)], "name string")).select(F.col("name").alias("key"), F.to_json("record").alias("value"))
    assert wiki.count() == 1 and expect_contract(wiki, D.WIKI, "games").collect() == []
    lacking = B.project_wiki(records.where("name = 'only'")).select(F.col("name").alias("key"), F.to_json("record").alias("value"))
    assert {tuple(r)[1:] for r in expect_contract(lacking, D.WIKI, "games").collect()} == {("/only", "required", "opening_sentence")}

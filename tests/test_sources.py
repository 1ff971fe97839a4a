"""Readers and writers on small files."""

import io
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandweave.operators import diffs
from strandweave.sources import files, tables

MACHINES = """<?xml version="1.0"?>
<mame build="0.287" mameconfig="10">
<machine name="pac" sourcefile="p.cpp"><description>Pac (set 1)</description><year>1980</year><manufacturer>N</manufacturer>
 <rom name="a" size="100"/><rom name="b" size="x"/><chip type="cpu" name="Z80" clock="3000000"/><sound channels="1"/>
 <input players="2"><control type="joy" player="1" ways="4"/></input><device_ref name="speaker"/></machine>
<machine name="clone" cloneof="pac" isbios="no"><description>Clone</description></machine>
<machine><description>nameless</description></machine>
<machine name="clone" cloneof="pac"><description>Clone, again</description></machine>
</mame>"""
ENTRIES = """<?xml version="1.0"?><history version="2.87" date="2026-01-01">
<entry><systems><system name="pac"/><system name="puck"/></systems><text>line one

 - TRIVIA -
two</text></entry>
<entry><software><item list="nes" name="x"/></software><text>soft</text></entry>
<entry><text>none</text></entry></history>"""


def test_machine_xml(spark, tmp_path):
    (tmp_path / "m.xml").write_text(MACHINES)
    rows = {r["name"]: r for r in files.scan_machine_xml(spark, str(tmp_path / "m.xml")).collect()}
    assert set(rows) == {"pac", "clone"} and rows["clone"]["description"] == "Clone, again"
    assert [r["_size"] for r in rows["pac"]["rom"]] == ["100", "x"] and rows["pac"]["input"]["control"][0]["_ways"] == "4"
    assert files.scan_machine_xml(spark, str(tmp_path / "m.xml"), limit=1).count() == 1
    assert files.scan_root_attributes(spark, str(tmp_path / "m.xml"), "mame", ["build"]).first()["build"] == "0.287"


def test_entry_xml(spark, tmp_path):
    (tmp_path / "h.xml").write_text(ENTRIES)
    rows = files.scan_entry_xml(spark, str(tmp_path / "h.xml")).orderBy("ordinal").collect()
    assert [r["kind"] for r in rows] == ["systems", "software", "unknown"]
    assert rows[0]["primary_name"] == "pac" and rows[0]["aliases"] == ["puck"] and "\n\n - TRIVIA -\n" in rows[0]["text"]


def test_lists(spark, tmp_path):
    (tmp_path / "c.ini").write_bytes("﻿[FOLDER_SETTINGS]\r\nx=1\r\n[Arcade: Shooter / Flying Vertical * Mature *]\r\n\r\n;c\r\npac\r\n[Maze]\r\npuck\r\n".encode())
    got = {r["machine"]: (r["grp"], r["category"], r["subcategory"]) for r in files.scan_category_list(spark, str(tmp_path / "c.ini")).collect()}
    assert got == {"pac": ("Arcade", "Shooter", "Flying Vertical"), "puck": ("Non-Arcade", "Maze", "")}


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("data0287.xml", MACHINES)
        z.writestr("old/data.xml", "<x/>")
        z.writestr("list.ini", "[A]\nb")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    rows = files.scan_zip_members(spark, str(tmp_path / "*.zip"), content=True)
    assert rows.where("readable").count() == 3 and rows.where("not readable").count() == 1
    best = lambda rule: files.select_member(rows.where("readable"), "data", rule=rule).first()["member"]
    assert best("digits") == "data0287.xml" and best("exact") == "old/data.xml" and best("largest") == "data0287.xml"
    assert rows.where("is_xml and crc is not null").count() == 2


@pytest.mark.parametrize(
    ("raw", "encoding", "source"),
    [(b"\xef\xbb\xbfabc", "utf-8", "bom"), (b'<?xml version="1.0" encoding="ISO-8859-1"?>', "windows-1252", "declaration"), ("é".encode(), "utf-8", "guess"), (b"caf\xe9", "windows-1252", "guess"), (b"plain", "utf-8", "guess")],
)
def test_encoding(spark, raw, encoding, source):
    got = spark.createDataFrame([(bytearray(raw),)], "content binary").select(files.detect_encoding(F.col("content")).alias("e")).first()["e"]
    assert (got["encoding"], got["source"]) == (encoding, source)


def test_keyed_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"systems": {"pac": {"n": 1}, "puck": {"n": 2}}}')
    (tmp_path / "b.json").write_text('{"pac": {"n": 3}}')
    (tmp_path / "c.json").write_text("{}")
    (tmp_path / "d.json").write_text("[1]")
    read = lambda name: sorted((r["key"], r["value"]["n"]) for r in files.scan_keyed_json(spark, str(tmp_path / name), "struct<n:int>").collect())
    assert read("a.json") == [("pac", 1), ("puck", 2)] and read("b.json") == [("pac", 3)] and read("c.json") == []
    with pytest.raises(Exception, match="JSON object"):
        read("d.json")


def test_release_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("a", 1), ("b", 2)], "machine string, n int")
    tables.write_release_table(one, path, "0286")
    tables.write_release_table(one.where("n = 1"), path, "0287")
    tables.write_release_table(one.where("n = 2"), path, "0286")
    assert sorted((r["machine"], str(r["release"]).zfill(4)) for r in spark.read.parquet(path).collect()) == [("a", "0287"), ("b", "0286")]
    tables.write_release_document(one, str(tmp_path / "d"), header=F.lit("head"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "d/records")).collect()) == ['{"machine":"a","n":1}', '{"machine":"b","n":2}']
    assert [r["value"] for r in spark.read.text(str(tmp_path / "d/header")).collect()] == ["head"]
    assert files.fingerprint_files(spark, path + "/*/*.parquet").where("length(sha256) = 64").count() >= 2


def test_changed_span(spark):
    df = spark.createDataFrame([("the old text", "the new text"), ("same", "same"), ("", "x"), ("abab", "ab")], "a string, b string")
    got = [tuple(r["s"]) for r in df.select(diffs.changed_span(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [(4, "old", "new"), (4, "", ""), (0, "", "x"), (2, "ab", "")]


def test_zip_members_share_frames():
    """Archives of a batch come in one frame, unless their content is large."""
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a.xml", b"x" * (6 << 20))
    batch = pd.DataFrame({"archive": [*"abcde"], "bytes": [b"no zip", *[raw.getvalue()] * 4]})
    frames = list(files.read_members(iter([batch]), False))
    assert [len(f) for f in frames] == [5] and frames[0]["readable"].tolist() == [False, True, True, True, True]
    assert [len(f) for f in files.read_members(iter([batch]), True)] == [4, 1]

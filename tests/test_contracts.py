"""Contracts compiled to a projection, and the invariants of parses."""

import json

import pytest
from pyspark.sql import functions as F

from strandweave.operators import contract_documents as D
from strandweave.operators import quality_rules as R
from strandweave.operators.contracts import Contract, expect_contract


def broken(spark, document, rows, *steps):
    df = spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in rows], "key string, value string")
    return {tuple(r) for r in expect_contract(df, document, *steps).collect()}


CASES = [
    ({"type": "integer"}, [1, 1.0, -3], [(1.5, "type", "number"), ("1", "type", "string"), (None, "type", "null"), (True, "type", "boolean")]),
    ({"type": ["number", "null"], "minimum": 0}, [0, 0.5, None], [(-1, "minimum", "-1"), ([], "type", "array")]),
    ({"type": "string", "pattern": "^[A-Z?]{2}$", "maxLength": 2}, ["JP", "??"], [("jp", "pattern", "jp")]),
    ({"type": "string", "minLength": 2}, ["日本"], [("日", "minLength", "日"), ("", "minLength", "")]),
    ({"pattern": "'\\d\\\\"}, ["'1\\", 5], [("'x", "pattern", "'x")]),
    ({"enum": ["a'b", 1, None]}, ["a'b", 1, None], [("b", "enum", '"b"')]),
    ({"const": {"a": 1}}, [{"a": 1}], [({}, "const", "{}")]),
    ({"type": "array", "items": {"type": "string"}, "minItems": 1, "maxItems": 2, "uniqueItems": True}, [["a"], ["a", "b"]], [([], "minItems", "0"), (["a", "b", "c"], "maxItems", "3"), (["a", "a"], "uniqueItems", "2")]),
    ({"type": "object", "minProperties": 1, "maxProperties": 1}, [{"a": None}], [({}, "minProperties", "0"), ({"a": 1, "b": 2}, "maxProperties", "2")]),
    ({"required": ["a"]}, [{"a": None}, "no object"], [({"b": 1}, "required", "a")]),
    ({"properties": {"a": {}}, "patternProperties": {"^x": {}}, "additionalProperties": False}, [{}, {"a": 1, "x2": 1}], [({"z": 1, "y": 2, "a": 1}, "additionalProperties", "y, z")]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["a", 6], [(1, "anyOf", "")]),
    ({"oneOf": [{"minimum": 1}, {"minimum": 5}]}, [2], [(6, "oneOf", ""), (0, "oneOf", "")]),
    ({"not": {"type": "string"}}, [1], [("a", "not", "")]),
    ({"if": {"type": "string"}, "then": {"minLength": 1}, "else": {"minimum": 1}}, ["a", 1], [("", "minLength", ""), (0, "minimum", "0")]),
    ({"format": "date-time"}, ["2026-01-17T14:56:26Z", "2026-01-17T14:56:26.5+01:00", 3], [("yesterday", "format", "yesterday")]),
    ({"allOf": [{"minimum": 1}, {"maximum": 3}]}, [2], [(4, "maximum", "4")]),
]


@pytest.mark.parametrize(("piece", "good", "bad"), CASES)
def test_words(spark, piece, good, bad):
    rows = [(f"g{n}", v) for n, v in enumerate(good)] + [(f"b{n}", v) for n, (v, _, _) in enumerate(bad)]
    rows = [(k, json.dumps(v)) for k, v in rows]
    got = broken(spark, {"type": "object", "additionalProperties": piece}, rows)
    assert got == {(f"b{n}", f"/b{n}", rule, detail) for n, (_, rule, detail) in enumerate(bad)}


def test_paths_and_references(spark):
    document = {"type": "object", "additionalProperties": False, "patternProperties": {"^[a-z]+$": {"$ref": "#/$defs/node"}}, "$defs": {"node": {"type": "object", "properties": {"kids": {"type": "array", "items": {"type": "object", "additionalProperties": {"$ref": "#/$defs/leaf"}}}}}, "leaf": {"type": "integer"}}}
    got = broken(spark, document, [("a", {"kids": [{"x": 1}, {"y": "s", "z": 2}]}), ("B", {}), ("c", "{"), ("d", [])])
    assert got == {("a", "/a/kids/1/y", "type", "string"), ("B", "", "additionalProperties", "B"), ("c", "/c", "json", ""), ("d", "/d", "type", "array")}
    with pytest.raises(ValueError, match="dependentRequired"):
        broken(spark, {"additionalProperties": {"dependentRequired": {}}}, [("a", 1)])


def test_types_are_told_once():
    """The type of an object or array is never described, that of any other value once."""
    record = D.record(**{f"m{n}": D.FULL for n in range(10)}, kids=D.listed(D.whole(0)))
    assert Contract(record).sound(record, "v").count("schema_of_variant") == 11


def test_published_documents(spark):
    port = {"regions": ["JP", "jp"], "platform": "", "model": [], "title": None, "date": "1990-1-1", "publisher": None, "comment": None, "additional_tags": [], "residue": []}
    got = broken(spark, D.PORTS, [("p", {"gh_id": 0, "aliases": ["x", "x"], "port_overview": "", "ports": {"CONSOLES": [port, port | {"regions": [], "platform": "x", "date": "19XX-XX-XX"}], "X": []}})])
    assert {g[1:3] for g in got} == {("/p/gh_id", "minimum"), ("/p/aliases", "uniqueItems"), ("/p/ports", "additionalProperties"), ("/p/ports/CONSOLES/0/regions/1", "pattern"), ("/p/ports/CONSOLES/0/platform", "minLength"), ("/p/ports/CONSOLES/0/date", "pattern")}
    meta = {"system": "p", "section_tag": "t", "block_index": 0, "filtered_line_start": 1, "filtered_line_end": 1, "policy": {"per_line": True, "heuristic_per_line": False}, "detectors": ["d"], "suppressions": [], "text_hash": "0123abcd", "raw_line_start": None}
    blocks = [{"type": "paragraph", "text": "x", "meta": meta}, {"type": "pair", "label": "a", "value": "b", "meta": meta}, {"type": "paragraph", "text": "", "meta": meta}, {"type": "other", "meta": meta}]
    got = broken(spark, D.TRIVIA, [("p", {"gh_id": 3, "sections": {"trivia": {"blocks": blocks}}})])
    assert {g[1:3] for g in got} == {("/p/sections/trivia/blocks/2", "oneOf"), ("/p/sections/trivia/blocks/3", "oneOf")}
    group = {"count": 1, "type": "Raster", "orientation": "", "refresh": "60 Hz"}
    raw = {"displays": {"heading": "", "count": 0, "groups": [group, {"count": 1, "type": "SVG", "orientation": "", "refresh": "60", "width": 3}]}}
    got = {g[1:3] for g in broken(spark, D.RAW, [("m", raw)], "games") if g[1] != "/m"}
    assert got == {("/m/displays/groups", "maxItems"), ("/m/displays/groups/0", "required"), ("/m/displays/groups/1", "not"), ("/m/displays/groups/1/refresh", "pattern")}
    assert broken(spark, D.PAGES, [("a", '"P"'), ("b", '""')], "pages") == {("b", "/b", "minLength", "")}
    assert set(D.DOCUMENTS) == {"machines", "parent_index", "classifications", "ports", "trivia", "raw", "wiki", "pages"}


def test_machine_invariants(spark):
    machines = spark.createDataFrame([("a", "yes", [], 1, 0, 2), ("b", "no", ["cdrom"], 0, 1, 0), ("c", "no", None, 2, 0, None)], "name string, disk_required string, disk_regions array<string>, cpu_count int, sound_chip_count int, display_count int")
    chips = spark.createDataFrame([("a", "cpu"), ("b", "AUDIO"), ("c", "cpu")], "machine string, type string")
    controls = spark.createDataFrame([("a",), ("a",)], "machine string")
    counts = spark.createDataFrame([("year", "1990", 3), ("players", "1", 2), ("type", "raster", 2), ("tag", "x", 1), ("ways", "4", 2)], "metric string, bucket string, n long")
    got = {tuple(r) for r in R.machine_invariants(machines, chips, controls, counts, ["year", "players"], ["type", "tag"], ["ways", "buttons"]).collect()}
    assert got == {("players_per_machine", 2, 3), ("tag_per_display", 1, 2), ("buttons_per_control", 0, 2), ("disk_without_regions", 1, 0), ("regions_without_disk", 1, 0), ("cpu_count", 1, 0)}


def test_list_invariants(spark):
    rows = spark.createDataFrame([("l", "a", "m"), ("l", "a", "m"), ("l", "b", "m"), ("l", "b", "n")], "path string, section string, machine string")
    right = spark.createDataFrame([("l", 4, 1, 1, 1)], "path string, listed int, within int, in_several int, across int")
    assert R.list_invariants(rows, right).isEmpty()
    assert {tuple(r) for r in R.list_invariants(rows, right.withColumns({"within": F.lit(0), "across": F.lit(9)})).collect()} == {("l", "within", 0, 1), ("l", "across", 9, 1)}

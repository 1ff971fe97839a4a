"""Large JSON objects in parts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strandweave.sources.keyed_json import scan_keyed_json


def odd(rng: random.Random) -> str:
    return "".join(rng.choice(['"', "\\", ",", "{", "}", "[", "]", ":", "a", "é", "\n", " ", "\\n", '",', '"}']) for _ in range(rng.randint(0, 30)))


@pytest.fixture
def tiny_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("root", [None, "systems", "games"])
@pytest.mark.parametrize("indent", [None, 1])
def test_object_in_ranges(spark, tmp_path, tiny_ranges, root, indent):
    rng = random.Random(7)
    data = {f"m{k}{odd(rng)}": {"t": odd(rng), "n": rng.randint(0, 9), "a": [odd(rng) for _ in range(rng.randint(0, 4))]} for k in range(150)}
    data["long"] = {"t": "," * 3000 + '"{' * 300, "n": 1, "a": []}
    whole = {"header": {"x": "1,2", "games": {"no": 1}}, root: data, "foot": [1, {"y": 2}]} if root else data
    (tmp_path / "o.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=rng.random() < 0.5) + "\n")
    (tmp_path / "one.json").write_text('{"single": {"t": "x"}}')
    (tmp_path / "empty.json").write_text(" { } \n")
    assert spark.read.text(str(tmp_path / "o.json")).rdd.getNumPartitions() > 10
    rows = scan_keyed_json(spark, str(tmp_path / "*.json"), "struct<t:string,n:int,a:array<string>>").collect()
    got = {r["key"]: r["value"].asDict() for r in rows}
    assert len(rows) == len(data) + 1 and got.pop("single") == {"t": "x", "n": None, "a": None}
    assert got == data


def test_no_object(spark, tmp_path):
    (tmp_path / "a.json").write_text("[1]")
    with pytest.raises(ValueError, match="object"):
        scan_keyed_json(spark, str(tmp_path / "a.json"), "int").collect()


def test_scalars_and_empty_root(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": 2}')
    assert {tuple(r) for r in scan_keyed_json(spark, str(tmp_path / "a.json"), "int").collect()} == {("a", 1), ("b", 2)}
    (tmp_path / "b.json").write_text('{"header": {}, "games": {}}')
    assert scan_keyed_json(spark, str(tmp_path / "b.json"), "int").isEmpty()
    (tmp_path / "c.json").write_text('{"systems": 3, "x": 4}')
    assert {tuple(r) for r in scan_keyed_json(spark, str(tmp_path / "c.json"), "int").withColumn("key", F.col("key")).collect()} == {("systems", 3), ("x", 4)}

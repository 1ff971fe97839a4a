"""Plain records are judged in Python, all others by the projection, and both tell the same."""

import json

import pyarrow as pa

from strandweave.operators import contract_documents as D
from strandweave.operators import contracts
from strandweave.operators.contract_functions import found_by, source_of
from strandweave.operators.contracts import DATE_TIME, Contract, expect_contract

PIECE = {
    "type": ["object", "array", "string", "integer", "number"],
    "minimum": 0,
    "maximum": 9,
    "minLength": 1,
    "maxLength": 3,
    "pattern": "^[^b].?$",
    "uniqueItems": True,
    "maxItems": 3,
    "items": {"anyOf": [{"type": "string"}, {"minimum": 2}], "not": {"const": "no"}},
    "minProperties": 1,
    "properties": {"a": {"enum": ["x", 1, None, "é\t"]}, "k": {"oneOf": [{"properties": {"t": {"const": "p"}}, "required": ["t"]}, {"properties": {"t": {"const": "q"}}}]}, "n": {"type": "integer"}},
    "patternProperties": {"^p[0-9]+$": {"if": {"type": "string"}, "then": {"format": "date-time"}, "else": {"allOf": [{"type": "number"}, {"minimum": 1}]}}},
    "additionalProperties": {"type": "null"},
}
VALUES = [0, 9.5, -0.5, 1.0, 10**20, 1e300, True, None, "", "a", "abcd", "b", "a\n", "a\r", "a ", "a\u0085", "日本", "😀", "\x01", "\x7f", [], ["x", "x"], [1, 1.0, "1"], ["no", 5], [1, 2, 3, 4], [[1], [1]], [{"a": 1, "b": 2}, {"b": 2, "a": 1}]]
VALUES += [{}, {"a": "x"}, {"a": "é\t"}, {"a": "\x1f"}, {"a": True}, {"a": 1.5}, {"a": {"é": 1, "b": [None, False]}}, {"k": {"t": "p"}}, {"k": {}}, {"k": 3}, {"k": {"t": "q"}}, {"n": 1.0}, {"n": 1.5}, {"n": 2**63}, {"p1": "x", "p2": 0, "p3": "2026-01-17T14:56:26Z", "px": 1, "p4": []}]
TEXTS = ["{", "", '{"a": 1, "a": 1}', "NaN", "[1,]", "01", "1e2", "-0", "0.10", '{"a": "\\u0078"}', '"\\ud800"', None]


def test_python_and_the_projection_tell_the_same(spark, monkeypatch):
    document = {"type": "object", "properties": {"own": {"type": "integer"}}, "patternProperties": {"^[a-z]": PIECE}, "additionalProperties": False}
    rows = [(f"v{n}", json.dumps(v)) for n, v in enumerate(VALUES)] + [(f"w{n}", json.dumps(v, ensure_ascii=False)) for n, v in enumerate(VALUES)] + [(f"t{n}", t) for n, t in enumerate(TEXTS)]
    rows += [("own", '"x"'), ("Z", "1"), ("", "1"), (None, "1"), ("a ", "-1"), ("é", "-1")]
    df = spark.createDataFrame(rows, "key string, value string").repartition(3)
    some = sorted(map(tuple, expect_contract(df, document).collect()), key=str)
    monkeypatch.setattr(contracts, "source_of", lambda *args: None)
    assert some == sorted(map(tuple, expect_contract(df, document).collect()), key=str) and len(some) > 60


def test_plain_records_of_the_published_tables_stay_out_of_the_projection():
    for document, steps in D.DOCUMENTS.values():
        made = Contract(document)
        source = source_of(made, made.part(*steps), DATE_TIME)
        texts = ['{"refresh_hz":59.5,"a":[1,null,true,"\\n"]}', '"x"', "3", '{"a":1,"a":2}', '"\\u0001"', "{"]
        got = pa.Table.from_batches(found_by(source)(iter([pa.RecordBatch.from_pydict({"key": [f"k{n}" for n in range(6)], "value": texts})]))).to_pylist()
        assert {r["key"] for r in got if r["_odd"]} == {"k3", "k4", "k5"} and {r["key"] for r in got if not r["_odd"]} >= {"k0", "k2"}
    made = Contract({"additionalProperties": {"pattern": "(?i)a"}})
    assert source_of(made, made.document, DATE_TIME) is None

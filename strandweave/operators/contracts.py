"""Contracts of records: a contract document (JSON Schema's keywords) becomes one projection over a JSON column.

A record is parsed once to a VARIANT. Every keyword of the contract is an expression over it, written as SQL so that a large
contract is one text to parse; nested arrays and objects are taken by higher-order functions. What is sound is told by one
condition; only for broken records are the violations made, as rows with the path to each. Plain records, which are most, go
through a Python function of the same contract (``contract_functions``), several times cheaper than the projection.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contract_functions import found_by, source_of

VIOLATIONS = "array<struct<path: string, rule: string, detail: string>>"
NONE = f"CAST(array() AS {VIOLATIONS})"

#: Fixed value: a date-time of RFC 3339.
DATE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"

#: JSON's types by what schema_of_variant says; numbers without a fraction are integers.
_IS = {
    "object": "startswith({s}, 'OBJECT')",
    "array": "startswith({s}, 'ARRAY')",
    "string": "{s} = 'STRING'",
    "boolean": "{s} = 'BOOLEAN'",
    "null": "{s} = 'VOID'",
    "integer": "({s} = 'BIGINT' OR (({s} LIKE 'DECIMAL%' OR {s} IN ('DOUBLE', 'FLOAT')) AND {n} = floor({n})))",
    "number": "({s} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {s} LIKE 'DECIMAL%')",
}


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Contract:
    """A contract document, compiled piece by piece.

    Known: type, enum, const, minimum, maximum, pattern, format date-time, minLength, maxLength, items, minItems, maxItems,
    uniqueItems, properties, required, additionalProperties, patternProperties, minProperties, maxProperties, allOf, anyOf,
    oneOf, not, if / then / else and $ref inside the document; other words are refused, but for those that only describe.
    """

    DESCRIBE = {"$schema", "$id", "$comment", "title", "description", "examples", "$defs", "additionalPropertiesMessage"}
    KNOWN = set("type enum const minimum maximum pattern format minLength maxLength items minItems maxItems uniqueItems properties required additionalProperties patternProperties minProperties maxProperties allOf anyOf oneOf not if then else $ref".split())

    def __init__(self, document: dict):
        self.document, self.fresh = document, count()

    def part(self, *steps: str) -> dict:
        """A piece of the document by the names of properties that lead to it."""
        found = self.document
        for s in steps:
            found = self.resolve(found)["properties"][s]
        return self.resolve(found)

    def resolve(self, piece: dict) -> dict:
        while "$ref" in piece:
            found = self.document
            for step in piece["$ref"].removeprefix("#/").split("/"):
                found = found[step]
            piece = found
        return piece

    def let(self, value: str, use: Callable[[str], str]) -> str:
        """``use`` of ``value``, which is evaluated once."""
        name = f"x{next(self.fresh)}"
        return f"transform(array({value}), {name} -> {use(name)})[0]"

    def each(self, how: str, rows: str, use: Callable[[str], str]) -> str:
        name = f"x{next(self.fresh)}"
        return f"{how}({rows}, {name} -> {use(name)})"

    def opened(self, piece: dict, v: str, use: Callable[[dict[str, str]], str]) -> str:
        """``use`` of what the words of ``piece`` look at in ``v``, read once: members (a map, where more than two or their
        names count, else only whether it is an object), items (an array) and kind (as schema_of_variant tells it). To read
        a member copies it, to tell the type of an array or object describes all of it."""
        kinds = set(piece["type"] if isinstance(piece.get("type"), list) else [piece.get("type")])
        read = {}
        if self.mapped(piece):
            read["members"] = f"try_variant_get({v}, '$', 'map<string,variant>')"
        elif "object" in kinds or {"required", "minProperties", "maxProperties"} & set(piece):
            read["members"] = f"try_variant_get({v}, '$', 'map<string,struct<>>')"
        if {"items", "uniqueItems"} & set(piece):
            read["items"] = f"try_variant_get({v}, '$', 'array<variant>')"
        elif "array" in kinds or {"minItems", "maxItems"} & set(piece):
            read["items"] = f"try_variant_get({v}, '$', 'array<struct<>>')"
        if kinds - {"object", "array", None} or {"minimum", "maximum", "minLength", "maxLength", "pattern", "format"} & set(piece):
            read["kind"] = f"schema_of_variant({v})"
        if not read:
            return use({})
        return self.let(f"named_struct({', '.join(f"'{n}', {e}" for n, e in read.items())})", lambda x: use({n: f"{x}.{n}" for n in read}))

    @staticmethod
    def mapped(piece: dict) -> bool:
        return len({*piece.get("properties", {}), *piece.get("required", [])}) > 2 or "patternProperties" in piece or piece.get("additionalProperties", True) is not True

    def checks(self, piece: dict, v: str, held: dict[str, str]) -> Iterable[tuple[str, str, str]]:
        """(rule, condition that is true if broken, detail) of the words that look at a value alone, not below it; ``held``
        is what ``opened`` read of it."""
        odd = set(piece) - self.KNOWN - self.DESCRIBE
        if odd:
            raise ValueError(f"words that no contract here has: {sorted(odd)}")
        number, text, as_json = f"try_variant_get({v}, '$', 'double')", f"try_variant_get({v}, '$', 'string')", f"to_json({v})"
        items, members = held.get("items"), held.get("members")

        def kind(k: str) -> str:
            container = {"object": members, "array": items}.get(k)
            return f"{container} IS NOT NULL" if container else _IS[k].format(s=held["kind"], n=number)

        if "type" in piece:
            kinds = piece["type"] if isinstance(piece["type"], list) else [piece["type"]]
            told = " ".join(f"WHEN {test.format(s=f'schema_of_variant({v})', n=number)} THEN '{k}'" for k, test in _IS.items())
            yield "type", f"NOT ({' OR '.join(map(kind, kinds))})", f"CASE {told} END"
        if "enum" in piece or "const" in piece:
            some = ", ".join(quoted(json.dumps(x, separators=(",", ":"), ensure_ascii=False)) for x in piece.get("enum", [piece.get("const")]))
            yield "enum" if "enum" in piece else "const", f"{as_json} NOT IN ({some})", as_json
        for rule, sign in (("minimum", "<"), ("maximum", ">")):
            if rule in piece:
                yield rule, f"{kind('number')} AND {number} {sign} {float(piece[rule])}D", as_json
        for rule, sign in (("minLength", "<"), ("maxLength", ">")):
            if rule in piece:
                yield rule, f"{kind('string')} AND char_length({text}) {sign} {piece[rule]}", text
        for rule, pattern in (("pattern", piece.get("pattern")), ("format", DATE_TIME if piece.get("format") == "date-time" else None)):
            if pattern:
                yield rule, f"{kind('string')} AND NOT {text} RLIKE {quoted(pattern)}", text
        for rule, sign, of in (("minItems", "<", items), ("maxItems", ">", items), ("minProperties", "<", members), ("maxProperties", ">", members)):
            if rule in piece:
                yield rule, f"size({of}) {sign} {piece[rule]} AND {of} IS NOT NULL", f"size({of})"
        if piece.get("uniqueItems"):
            yield "uniqueItems", f"size({items}) > 1 AND size(array_distinct({self.each('transform', items, lambda x: f'to_json({x})')})) < size({items})", f"size({items})"
        for name in piece.get("required", []):
            yield "required", f"{members} IS NOT NULL AND {self.member(piece, v, held, name)} IS NULL", quoted(name)
        if piece.get("additionalProperties", True) is False:
            more = self.each("filter", f"map_keys({members})", lambda k: f"NOT ({self.named(piece, k)})")
            yield "additionalProperties", f"{members} IS NOT NULL AND size({more}) > 0", f"array_join(array_sort({more}), ', ')"
        if "anyOf" in piece:
            yield "anyOf", f"NOT ({' OR '.join(self.sound(p, v) for p in piece['anyOf'])})", "''"
        if "oneOf" in piece:
            yield "oneOf", " + ".join(f"CASE WHEN {self.sound(p, v)} THEN 1 ELSE 0 END" for p in piece["oneOf"]) + " <> 1", "''"
        if "not" in piece:
            yield "not", self.sound(piece["not"], v), "''"

    def member(self, piece: dict, v: str, held: dict[str, str], name: str) -> str:
        if self.mapped(piece) and held:
            return f"try_element_at({held['members']}, {quoted(name)})"
        return f"try_variant_get({v}, {quoted(f"$['{name}']")}, 'variant')"

    @staticmethod
    def named(piece: dict, key: str) -> str:
        """Whether an object's own members or patterns name ``key``."""
        own = ", ".join(map(quoted, piece.get("properties", {})))
        ways = ([f"{key} IN ({own})"] if own else []) + [f"{key} RLIKE {quoted(p)}" for p in piece.get("patternProperties", {})]
        return " OR ".join(ways) or "FALSE"

    def below(self, piece: dict, v: str, held: dict[str, str]) -> Iterable[tuple[str, dict, str, Callable[[str], str] | None]]:
        """(values, piece, step, filter): what a value holds: one member (step is its name, quoted), or the entries of an
        array (step is empty) or of a map that the filter takes (step is null)."""
        for name, sub in piece.get("properties", {}).items():
            yield self.member(piece, v, held, name), sub, quoted(name), None
        if "items" in piece:
            yield held["items"], piece["items"], "", None
        for pattern, sub in piece.get("patternProperties", {}).items():
            yield f"map_entries({held['members']})", sub, "null", lambda k, pattern=pattern: f"{k} RLIKE {quoted(pattern)}"
        rest = piece.get("additionalProperties", True)
        if isinstance(rest, dict):
            yield f"map_entries({held['members']})", rest, "null", lambda k: f"NOT ({self.named(piece, k)})"

    def sound(self, piece: dict | bool, v: str) -> str:
        """A condition: ``v``, a variant that is there, breaks nothing of ``piece``. Members with one allowed value come
        first: they tell alternatives apart before anything else is looked at."""
        if isinstance(piece, bool):
            return str(piece).upper()
        piece = self.resolve(piece)
        told = [f"coalesce(to_json({self.member(piece, v, {}, n)}) = {quoted(json.dumps(p['const']))}, {str(n not in piece.get('required', [])).upper()})" for n, p in piece.get("properties", {}).items() if "const" in p]

        def whole(held: dict[str, str]) -> str:
            ways = [f"NOT coalesce({broken}, FALSE)" for _, broken, _ in self.checks(piece, v, held)]
            for values, sub, step, chosen in self.below(piece, v, held):
                if step == "":
                    ways.append(f"coalesce({self.each('forall', values, lambda x, sub=sub: self.sound(sub, x))}, TRUE)")
                elif step == "null":
                    ways.append(f"coalesce({self.each('forall', values, lambda e, sub=sub, chosen=chosen: f'NOT ({chosen(e + ".key")}) OR {self.sound(sub, e + ".value")}')}, TRUE)")
                else:
                    ways.append(self.let(values, lambda c, sub=sub: f"({c} IS NULL OR {self.sound(sub, c)})"))
            ways += [self.sound(p, v) for p in piece.get("allOf", [])]
            if "if" in piece:
                ways.append(f"CASE WHEN {self.sound(piece['if'], v)} THEN {self.sound(piece.get('then', True), v)} ELSE {self.sound(piece.get('else', True), v)} END")
            return "(" + (" AND ".join(ways) or "TRUE") + ")"

        return "(" + " AND ".join([*told, self.opened(piece, v, whole)]) + ")"

    def violations(self, piece: dict | bool, v: str, path: str) -> str:
        """What ``v`` breaks of ``piece``: VIOLATIONS."""
        one = lambda rule, detail: f"CAST(array(named_struct('path', {path}, 'rule', '{rule}', 'detail', CAST({detail} AS STRING))) AS {VIOLATIONS})"
        if isinstance(piece, bool):
            return NONE if piece else one("false", "''")
        piece = self.resolve(piece)

        def whole(held: dict[str, str]) -> str:
            found = [f"CASE WHEN {broken} THEN {one(rule, detail)} ELSE {NONE} END" for rule, broken, detail in self.checks(piece, v, held)]
            for values, sub, step, chosen in self.below(piece, v, held):
                if step == "":
                    at, x = f"x{next(self.fresh)}", f"x{next(self.fresh)}"
                    found.append(f"coalesce(flatten(transform({values}, ({x}, {at}) -> {self.violations(sub, x, f"concat({path}, '/', CAST({at} AS STRING))")})), {NONE})")
                elif step == "null":
                    some = self.each("filter", values, lambda e, chosen=chosen: chosen(e + ".key"))
                    found.append(f"coalesce(flatten({self.each('transform', some, lambda e, sub=sub: self.violations(sub, e + '.value', f"concat({path}, '/', {e}.key)"))}), {NONE})")
                else:
                    found.append(self.let(values, lambda c, sub=sub, step=step: f"CASE WHEN {c} IS NULL THEN {NONE} ELSE {self.violations(sub, c, f"concat({path}, '/', {step})")} END"))
            found += [self.violations(p, v, path) for p in piece.get("allOf", [])]
            if "if" in piece:
                found.append(f"CASE WHEN {self.sound(piece['if'], v)} THEN {self.violations(piece.get('then', True), v, path)} ELSE {self.violations(piece.get('else', True), v, path)} END")
            return found[0] if len(found) == 1 else f"concat({', '.join([NONE, *found])})"

        return self.opened(piece, v, whole)


def expect_contract(rows: DataFrame, contract: dict, *steps: str, key: str = "key", value: str = "value") -> DataFrame:
    """(key, path, rule, detail): what records break of ``contract``.

    ``rows`` are the members of an object of the document, the one that ``steps`` lead to (none: the document itself):
    ``key`` its name, ``value`` its JSON text. A path starts with the key; a key that the object does not allow is broken at
    the empty path; a text that is no JSON breaks the rule json. One pass, whatever the contract holds: what plain records
    break is found in Python, the others (``contract_functions``) come out of it whole and are judged by the projection.
    """
    made = Contract(contract)
    owner = made.part(*steps)
    ways = [(f"key = {quoted(n)}", sub) for n, sub in owner.get("properties", {}).items()]
    ways += [(f"key RLIKE {quoted(p)}", sub) for p, sub in owner.get("patternProperties", {}).items()]
    rest, named = owner.get("additionalProperties", True), made.named(owner, "key")
    if rest is not False:
        ways.append((f"NOT ({named})", rest))
    strange = f"CAST(array(named_struct('path', '', 'rule', 'additionalProperties', 'detail', key)) AS {VIOLATIONS})"
    broken = [f"CASE WHEN {hit} THEN {made.violations(sub, '_v', "concat('/', key)")} ELSE {NONE} END" for hit, sub in ways]
    broken += [f"CASE WHEN NOT ({named}) THEN {strange} ELSE {NONE} END"] if rest is False else []
    no_json = f"CAST(array(named_struct('path', concat('/', key), 'rule', 'json', 'detail', '')) AS {VIOLATIONS})"
    judged = f"CASE WHEN _v IS NULL THEN {no_json} ELSE concat({', '.join(broken)}) END"
    source = source_of(made, owner, DATE_TIME)
    if source is None:
        return rows.select(F.col(key).alias("key"), F.try_parse_json(value).alias("_v")).selectExpr("key", f"inline({judged})")
    texts = rows.select(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))
    found = texts.mapInArrow(found_by(source), "key string, path string, rule string, detail string, _odd boolean, _text string")
    found = found.withColumn("_v", F.try_parse_json("_text"))
    return found.selectExpr("key", f"inline(CASE WHEN _odd THEN {judged} ELSE CAST(array(named_struct('path', path, 'rule', rule, 'detail', detail)) AS {VIOLATIONS}) END)")

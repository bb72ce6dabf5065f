import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lexigraph.operators import schema_check as sc

SCHEMA = {
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "type": "object",
    "required": ["id", "list"],
    "additionalProperties": False,
    "minProperties": 2,
    "patternProperties": {"^x-": {"type": "string"}},
    "propertyNames": {"maxLength": 6},
    "dependentRequired": {"kind": ["n"]},
    "properties": {
        "id": {"type": "string", "pattern": "^[A-Z]+[0-9]{2}$", "minLength": 3, "maxLength": 6},
        "n": {"type": ["integer", "null"], "minimum": 1, "exclusiveMaximum": 10},
        "kind": {"enum": ["a", 2, None, True, [1, "z"]]},
        "fix": {"const": {"a": 1, "b": "x"}},
        "list": {"type": "array", "minItems": 1, "maxItems": 4, "uniqueItems": True, "prefixItems": [{"type": "number"}], "items": {"$ref": "#/$defs/entry"}, "contains": {"type": "object"}},
        "one": {"oneOf": [{"type": "string"}, {"type": "object", "required": ["p"]}, {"type": "object", "required": ["q"]}]},
        "any": {"anyOf": [{"type": "boolean"}, {"type": "number", "maximum": 3.5}], "not": {"const": 3}},
        "cond": {"if": {"required": ["p"]}, "then": {"required": ["q"]}, "else": {"maxProperties": 0}},
        "no": False,
    },
    "$defs": {"entry": {"type": "object", "required": ["t"], "properties": {"t": {"type": "string"}, "deep": {"type": "array", "items": {"$ref": "#/$defs/leaf"}}}, "additionalProperties": {"type": "integer"}}, "leaf": {"allOf": [{"type": "object"}, {"properties": {"ok": {"const": True}}, "required": ["ok"]}]}},
}


def kind(v):
    return "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else {str: "string", list: "array", dict: "object"}[type(v)]


def same(a, b):
    if kind(a) == kind(b) == "number":
        return a == b
    return kind(a) == kind(b) and json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)


def plain(v, s, root, at=""):
    """A plain validator, by recursion over the value."""
    if s is True:
        return
    if s is False:
        yield at, "false"
        return
    k = kind(v)
    ok = lambda x, t: not list(plain(x, t, root))
    bad = set()
    if "$ref" in s:
        yield from plain(v, root["$defs"][s["$ref"].split("/")[-1]], root, at)
    if "type" in s:
        types = [s["type"]] if isinstance(s["type"], str) else s["type"]
        if not (k in types or "integer" in types and k == "number" and v == int(v)):
            bad.add("type")
    if "enum" in s and not any(same(v, x) for x in s["enum"]):
        bad.add("enum")
    if "const" in s and not same(v, s["const"]):
        bad.add("const")
    if k == "string":
        bad |= {w for w, x in (("pattern", "pattern" in s and not re.search(s["pattern"], v)), ("minLength", len(v) < s.get("minLength", 0)), ("maxLength", len(v) > s.get("maxLength", 99))) if x}
    if k == "number":
        bad |= {w for w, x in (("minimum", v < s.get("minimum", v)), ("maximum", v > s.get("maximum", v)), ("exclusiveMaximum", "exclusiveMaximum" in s and v >= s["exclusiveMaximum"])) if x}
    if k == "array":
        bad |= {w for w, x in (("minItems", len(v) < s.get("minItems", 0)), ("maxItems", len(v) > s.get("maxItems", 99)), ("uniqueItems", s.get("uniqueItems") and len({json.dumps(x) for x in v}) < len(v)), ("contains", "contains" in s and not any(ok(x, s["contains"]) for x in v))) if x}
        head = s.get("prefixItems", [])
        for i, x in enumerate(v):
            yield from plain(x, head[i] if i < len(head) else s.get("items", True), root, f"{at}/{i}")
    if k == "object":
        bad |= {w for w, x in (("minProperties", len(v) < s.get("minProperties", 0)), ("maxProperties", len(v) > s.get("maxProperties", 99))) if x}
        for r in [*s.get("required", []), *[r for key, rs in s.get("dependentRequired", {}).items() if key in v for r in rs]]:
            if r not in v:
                yield f"{at}/{r}", "required"
        for key, x in v.items():
            yield from plain(key, s.get("propertyNames", True), root, f"{at}/{key}")
            known = key in s.get("properties", {})
            yield from plain(x, s.get("properties", {}).get(key, True), root, f"{at}/{key}") if known else ()
            for p, t in s.get("patternProperties", {}).items():
                if re.search(p, key):
                    known = True
                    yield from plain(x, t, root, f"{at}/{key}")
            if not known and s.get("additionalProperties") is False:
                yield f"{at}/{key}", "additionalProperties"
            elif not known:
                yield from plain(x, s.get("additionalProperties", True), root, f"{at}/{key}")
    for x in s.get("allOf", []):
        yield from plain(v, x, root, at)
    if "anyOf" in s and not any(ok(v, x) for x in s["anyOf"]):
        bad.add("anyOf")
    if "oneOf" in s and sum(ok(v, x) for x in s["oneOf"]) != 1:
        bad.add("oneOf")
    if "not" in s and ok(v, s["not"]):
        bad.add("not")
    if "if" in s:
        yield from plain(v, s.get("then", True) if ok(v, s["if"]) else s.get("else", True), root, at)
    for w in bad:
        yield at, w


def value(rng, depth):
    pick = rng.random()
    if depth and pick < 0.35:
        return {rng.choice(["t", "deep", "ok", "p", "q", "a", "b", "z"]): value(rng, depth - 1) for _ in range(rng.randrange(3))}
    if depth and pick < 0.5:
        return [value(rng, depth - 1) for _ in range(rng.randrange(3))]
    return rng.choice([None, True, False, 0, 1, 2, 3, 9, 10, 2.5, 3.0, "", "a", "AB12", "ABCDE12", "x", "é\"\\/"])


def entry(rng):
    return {"t": rng.choice(["x", 1]), "deep": [rng.choice([{"ok": True}, {"ok": False}, {}, 3]) for _ in range(rng.randrange(3))], "z": rng.choice([1, "1"])}


def test_violations_are_those_of_a_plain_validator(spark):
    rng = random.Random(5)
    docs = [value(rng, 3) for _ in range(60)]
    for _ in range(250):
        d = {"id": rng.choice(["AB12", "ab12", "A1", 5]), "list": rng.choice([[1, entry(rng)], [entry(rng), entry(rng), entry(rng)], [], [1, 1, 2, 3, {}], value(rng, 2)])}
        for key in rng.sample(["n", "kind", "fix", "one", "any", "cond", "no", "x-a", "other", "toolong7"], 4):
            d[key] = {"fix": rng.choice([{"b": "x", "a": 1}, {"a": 1}]), "kind": rng.choice(["a", 2, 2.0, None, True, [1, "z"], "b"])}.get(key, value(rng, 2)) if rng.random() < 0.7 else value(rng, 2)
        docs.append(d)
    rows = [(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)]
    got = sc.violations(spark.createDataFrame([*rows, (9001, "{"), (9002, None)], "id int, text string"), "id", "text", SCHEMA)
    found = {tuple(r) for r in got.collect()}
    assert found == {(i, *p) for i, d in enumerate(docs) for p in plain(d, SCHEMA, SCHEMA)} | {(9001, "", "json")}
    assert len({k for _, _, k in found}) >= 18 and max(p.count("/") for _, p, _ in found) >= 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan  # one pass over the documents


def test_schemas_that_cannot_be_compiled():
    for schema in ({"$ref": "#/$defs/a", "$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}}, {"$ref": "other.json"}, {"unevaluatedItems": False}):
        with pytest.raises(ValueError, match="reference|keyword"):
            sc.compiled(schema)


def test_trivial_schemas(spark):
    df = spark.createDataFrame([("1",), ("null",)], "t string").select(F.parse_json("t").alias("v"))
    assert [len(r[0]) for r in df.select(sc.compiled(True)(F.col("v"))).collect()] == [0, 0] and [r[0][0].keyword for r in df.select(sc.compiled(False)(F.col("v"))).collect()] == ["false", "false"]


def test_rules_of_schemas_and_registries(spark, tmp_path):
    from lexigraph.plans import validate

    (tmp_path / "a.json").write_text('{"meta": {"band": 5}, "x": 1}')
    (tmp_path / "b.json").write_text('{"meta": {"band": "PRIM"}}')
    schema = {"properties": {"meta": {"properties": {"band": {"type": "string"}}}}, "required": ["kompetenzbereiche"]}
    found = {(r.severity, r.rule, r.record, r.message) for r in validate.schema_rules(validate.part_texts(spark, str(tmp_path)), schema).collect()}
    assert found == {("soft", "schema-violation", "a.json", "/meta/band: type"), ("soft", "schema-violation", "a.json", "/kompetenzbereiche: required"), ("soft", "schema-violation", "b.json", "/kompetenzbereiche: required")}
    texts = spark.createDataFrame([("r1.json", "{}"), ("r2.json", "[1]"), ("r3.json", "{"), ("r4.json", None)], "datei string, value string")
    assert [(r.severity, r.record) for r in validate.unreadable_registry(texts).orderBy("record").collect()] == [("hard", "r2.json"), ("hard", "r3.json"), ("hard", "r4.json")]

"""JSON Schema as column expressions: a schema is compiled once, and every document is checked in the executors' own code.

compiled(schema) gives a function of a VARIANT column; its result lists the violations as (path, keyword), paths like
/a/3/b.  Every keyword is an expression over the value at its place, objects and arrays are walked with
higher-order functions, and a reference takes the place of what it names.  A reference back to where it stands would have no end, and
is refused."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATION = "array<struct<path:string,keyword:string>>"
Check = Callable[[Column, Column], Column]
_TYPES = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
#: keywords that say nothing about a value
SILENT = {"$schema", "$id", "$defs", "definitions", "$comment", "title", "description", "default", "examples", "deprecated", "format", "readOnly", "writeOnly", "then", "else"}


def _none() -> Column:
    return F.array().cast(VIOLATION)


def _when(wrong: Column, path: Column, keyword: str) -> Column:
    return F.when(F.coalesce(wrong, F.lit(False)), F.array(F.struct(path.alias("path"), F.lit(keyword).alias("keyword"))).cast(VIOLATION)).otherwise(_none())


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is(v: Column, name: str) -> Column:
    if name in ("number", "integer"):
        number = reduce(lambda a, b: a | b, [_kind(v).startswith(n) for n in _NUMBERS])
        whole = F.try_variant_get(v, "$", "double")
        return number if name == "number" else number & (whole == F.floor(whole))
    return _kind(v).startswith(_TYPES[name])


def _entries(v: Column) -> Column:
    """An object's members as a map; empty for other values."""
    return F.coalesce(F.when(_is(v, "object"), F.try_variant_get(v, "$", "map<string,variant>")), F.create_map().cast("map<string,variant>"))


def _elements(v: Column) -> Column:
    return F.coalesce(F.when(_is(v, "array"), F.try_variant_get(v, "$", "array<variant>")), F.array().cast("array<variant>"))


def _joined(checks: list[Column]) -> Column:
    return F.concat(*checks) if checks else _none()


def _equals(v: Column, constant: object) -> Column:
    if isinstance(constant, (int, float)) and not isinstance(constant, bool):
        return _is(v, "number") & (F.try_variant_get(v, "$", "double") == float(constant))
    return F.to_json(v) == json.dumps(constant, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def _length(v: Column) -> Column:
    return F.when(_is(v, "string"), F.length(F.try_variant_get(v, "$", "string")))


def _number(v: Column) -> Column:
    return F.when(_is(v, "number"), F.try_variant_get(v, "$", "double"))


def _below(path: Column, key: Column) -> Column:
    return F.concat(path, F.lit("/"), key.cast("string"))


class _Compiler:
    def __init__(self, root: dict):
        self.root, self.open = root, []

    def resolve(self, ref: str) -> object:
        if not ref.startswith("#"):
            raise ValueError(f"only references inside the schema can be followed: {ref}")
        at: object = self.root
        for step in ref[1:].strip("/").split("/"):
            at = at[step.replace("~1", "/").replace("~0", "~")] if step else at
        return at

    def compile(self, schema: object) -> Check:
        if schema is True or schema == {}:
            return lambda v, path: _none()
        if schema is False:
            return lambda v, path: _when(F.lit(True), path, "false")
        checks = [self.keyword(name, value, schema) for name, value in schema.items() if name not in SILENT]
        return lambda v, path: _joined([c(v, path) for c in checks])

    def keyword(self, name: str, value, schema: dict) -> Check:  # noqa: C901, PLR0911
        if name == "$ref":
            if value in self.open:
                raise ValueError(f"a reference to where it stands: {value}")
            self.open.append(value)
            inner = self.compile(self.resolve(value))
            self.open.pop()
            return inner
        simple = {
            "type": lambda v: ~reduce(lambda a, b: a | b, [_is(v, t) for t in ([value] if isinstance(value, str) else value)]),
            "enum": lambda v: ~reduce(lambda a, b: a | b, [_equals(v, x) for x in value], F.lit(False)),
            "const": lambda v: ~_equals(v, value),
            "pattern": lambda v: _is(v, "string") & ~F.try_variant_get(v, "$", "string").rlike(value),
            "minLength": lambda v: _length(v) < value,
            "maxLength": lambda v: _length(v) > value,
            "minimum": lambda v: _number(v) < value,
            "maximum": lambda v: _number(v) > value,
            "exclusiveMinimum": lambda v: _number(v) <= value,
            "exclusiveMaximum": lambda v: _number(v) >= value,
            "minItems": lambda v: _is(v, "array") & (F.size(_elements(v)) < value),
            "maxItems": lambda v: F.size(_elements(v)) > value,
            "uniqueItems": lambda v: F.lit(bool(value)) & (F.size(F.array_distinct(F.transform(_elements(v), lambda x: F.to_json(x)))) < F.size(_elements(v))),
            "minProperties": lambda v: _is(v, "object") & (F.size(_entries(v)) < value),
            "maxProperties": lambda v: F.size(_entries(v)) > value,
        }
        if name in simple:
            return lambda v, path: _when(simple[name](v), path, name)
        if name == "required":
            # the path of what is missing
            return lambda v, path: F.when(_is(v, "object"), F.transform(F.array_except(F.array(*map(F.lit, value)), F.map_keys(_entries(v))), lambda k: F.struct(_below(path, k).alias("path"), F.lit("required").alias("keyword")))).otherwise(_none()) if value else _none()
        if name == "properties":
            inner = {k: self.compile(s) for k, s in value.items()}

            def members(v: Column, path: Column) -> Column:
                entries = _entries(v)
                one = lambda k, check: F.when(F.map_contains_key(entries, k), check(F.try_element_at(entries, F.lit(k)), _below(path, F.lit(k)))).otherwise(_none())
                return _joined([one(k, check) for k, check in inner.items()])

            return members
        if name in ("additionalProperties", "patternProperties", "propertyNames"):
            return self.other_members(name, value, schema)
        if name in ("items", "prefixItems"):
            if name == "prefixItems":
                each = [self.compile(s) for s in value]
                return lambda v, path: _joined([F.when(F.size(_elements(v)) > i, c(F.get(_elements(v), F.lit(i)), _below(path, F.lit(i)))).otherwise(_none()) for i, c in enumerate(each)])
            check, skip = self.compile(value), len(schema.get("prefixItems", []))
            return lambda v, path: F.flatten(F.transform(_elements(v), lambda x, i: F.when(i >= skip, check(x, _below(path, i))).otherwise(_none())))
        if name in ("allOf", "anyOf", "oneOf"):
            branches = [self.compile(s) for s in value]
            if name == "allOf":
                return lambda v, path: _joined([b(v, path) for b in branches])
            fits = lambda v: reduce(lambda a, b: a + b, [(F.size(b(v, F.lit(""))) == 0).cast("int") for b in branches])
            return lambda v, path: _when(fits(v) != 1 if name == "oneOf" else fits(v) == 0, path, name)
        if name == "not":
            check = self.compile(value)
            return lambda v, path: _when(F.size(check(v, F.lit(""))) == 0, path, "not")
        if name == "if":
            test, then, other = self.compile(value), self.compile(schema.get("then", True)), self.compile(schema.get("else", True))
            return lambda v, path: F.when(F.size(test(v, F.lit(""))) == 0, then(v, path)).otherwise(other(v, path))
        if name == "dependentRequired":
            pairs = [(k, self.keyword("required", needs, schema)) for k, needs in value.items()]
            return lambda v, path: _joined([F.when(F.map_contains_key(_entries(v), k), c(v, path)).otherwise(_none()) for k, c in pairs])
        if name == "contains":
            check = self.compile(value)
            return lambda v, path: _when(_is(v, "array") & ~F.exists(_elements(v), lambda x: F.size(check(x, F.lit(""))) == 0), path, "contains")
        raise ValueError(f"keyword {name} isn't known")

    def other_members(self, name: str, value, schema: dict) -> Check:
        """Checks of members that `properties` doesn't name one by one."""
        if name == "propertyNames":
            check = self.compile(value)
            as_value = lambda k: F.variant_get(F.parse_json(F.to_json(F.struct(k.alias("k")))), "$.k", "variant")
            return lambda v, path: F.flatten(F.transform(F.map_keys(_entries(v)), lambda k: check(as_value(k), _below(path, k))))
        if name == "patternProperties":
            rules = [(p, self.compile(s)) for p, s in value.items()]

            def matched(v: Column, path: Column, pattern: str, check: Check) -> Column:
                some = F.filter(F.map_entries(_entries(v)), lambda e: e["key"].rlike(pattern))
                return F.flatten(F.transform(some, lambda e: check(e["value"], _below(path, e["key"]))))

            return lambda v, path: _joined([matched(v, path, *rule) for rule in rules])
        named, patterns = list(schema.get("properties", {})), list(schema.get("patternProperties", {}))
        check = self.compile(value)

        def rest(v: Column, path: Column) -> Column:
            free = lambda e: reduce(lambda a, b: a & b, [~e["key"].rlike(p) for p in patterns], ~e["key"].isin(*named) if named else F.lit(True))
            entries = F.filter(F.map_entries(_entries(v)), free)
            if value is False:
                return F.transform(entries, lambda e: F.struct(_below(path, e["key"]).alias("path"), F.lit("additionalProperties").alias("keyword")))
            return F.flatten(F.transform(entries, lambda e: check(e["value"], _below(path, e["key"]))))

        return rest


def compiled(schema: dict | bool) -> Callable[[Column], Column]:
    """A function of a VARIANT column whose result lists (path, keyword) of every violation, "" being the whole."""
    check = _Compiler(schema if isinstance(schema, dict) else {}).compile(schema)
    return lambda v: check(v, F.lit(""))


def violations(documents: DataFrame, key: str, text: str, schema: dict) -> DataFrame:
    """(key, path, keyword) of JSON texts against a schema; a text that is no JSON has the keyword "json", a null one has no row."""
    parsed = documents.where(F.col(text).isNotNull()).select(key, F.try_parse_json(text).alias("__v"))
    broken = F.array(F.struct(F.lit("").alias("path"), F.lit("json").alias("keyword"))).cast(VIOLATION)
    found = F.when(F.col("__v").isNull(), broken).otherwise(compiled(schema)(F.col("__v")))
    return parsed.select(key, F.inline(found))

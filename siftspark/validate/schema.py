"""JSON-Schema documents compiled to Column expressions over VARIANT, which give every (path, rule) that a value breaks.

One schema becomes one expression, so a whole table is checked in one scan by the JVM.  Supported: ``type``, ``const``, ``enum``, ``required``,
``properties``, ``additionalProperties: false``, ``propertyNames.pattern``, ``minProperties``, ``items``, ``minItems``, ``maxItems``, ``uniqueItems``, ``pattern``,
``minLength``, ``maxLength``, ``minimum``, ``maximum``, ``format`` (date, date-time, uri), ``allOf``, ``anyOf``, ``oneOf``, ``not``, and ``$ref`` into ``$defs``.  A
keyword that isn't known is refused when the schema is compiled, so nothing is silently unchecked.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOTES = {"$schema", "$id", "$defs", "title", "description", "default", "$comment"}
_KNOWN = {
    "type", "const", "enum", "required", "properties", "additionalProperties", "propertyNames", "minProperties", "items", "minItems", "maxItems", "uniqueItems", "pattern", "minLength", "maxLength",
    "minimum", "maximum", "format", "allOf", "anyOf", "oneOf", "not", "$ref",
}
#: Those that look at an object's members.
_OF_OBJECTS = {"required", "properties", "additionalProperties", "propertyNames", "minProperties"}
_FORMATS = {
    "date": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$",
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:\S*$",
}
_ROW = "array<struct<path: string, rule: string>>"
#: A schema may refer to itself; so many times inside each other is refused when it is compiled.
NESTED_REFS = 16


def violations(value: Column, schema: dict) -> Column:
    """What a VARIANT breaks: an array of (path, rule), empty for a valid value, in the order of the schema.

    Paths are JSON pointers without escapes.  A null column breaks ``type`` where the schema asks for one, as no value at all would."""
    return _Compiler(schema).node(value, schema, F.lit(""), 0)


class _Compiler:
    def __init__(self, root: dict):
        self.root = root

    def node(self, v: Column, schema: dict | bool, path: Column, refs: int) -> Column:
        if schema is True:
            return F.array().cast(_ROW)
        if schema is False:
            return self._rule(v.isNotNull(), path, "false")
        unknown = schema.keys() - _KNOWN - _NOTES
        if unknown:
            raise ValueError(f"keywords that aren't supported: {sorted(unknown)}")
        if "$ref" in schema:
            if refs >= NESTED_REFS:
                raise ValueError("references inside each other")
            return self.node(v, self._target(schema["$ref"]), path, refs + 1)
        if not schema.keys() & _OF_OBJECTS:
            return _once(v, lambda x: _once(_kind(x), lambda kind: self._checked(x, kind, F.lit(None).cast("map<string,variant>"), schema, path, refs)))
        return _once(v, lambda x: _once(_kind(x), lambda kind: _once(_members(x, kind), lambda inside: self._checked(x, kind, inside, schema, path, refs))))

    def _checked(self, v: Column, kind: Column, members: Column, schema: dict, path: Column, refs: int) -> Column:
        """``node`` of a value whose kind and members (null but for objects) are known, so that neither is worked out at each use."""
        is_ = lambda *kinds: F.coalesce(kind.isin(*kinds), F.lit(False))
        text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "double")
        items, names = F.try_variant_get(v, "$", "array<variant>"), F.map_keys(members)
        parts: list[Column] = []
        check = lambda bad, rule: parts.append(self._rule(bad, path, rule))
        if "type" in schema:
            kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
            check(~is_(*[k for kind in kinds for k in (("integer", "number") if kind == "number" else (kind,))]), "type")
        if "const" in schema:
            check(~_equals(v, kind, schema["const"]), "const")
        if "enum" in schema:
            same = F.lit(False)
            for option in schema["enum"]:
                same = same | _equals(v, kind, option)
            check(~same, "enum")
        tests: list[tuple[str, Callable[[object], Column], str]] = [
            ("pattern", lambda x: is_("string") & ~text.rlike(x), "pattern"), ("minLength", lambda x: is_("string") & (F.length(text) < x), "minLength"), ("maxLength", lambda x: is_("string") & (F.length(text) > x), "maxLength"),
            ("format", lambda x: is_("string") & ~text.rlike(_FORMATS[x]), "format"), ("minimum", lambda x: is_("integer", "number") & (number < x), "minimum"), ("maximum", lambda x: is_("integer", "number") & (number > x), "maximum"),
            ("minItems", lambda x: is_("array") & (F.size(items) < x), "minItems"), ("maxItems", lambda x: is_("array") & (F.size(items) > x), "maxItems"),
            ("uniqueItems", lambda x: F.lit(x) & is_("array") & (F.size(F.array_distinct(F.transform(items, lambda y: F.to_json(y)))) < F.size(items)), "uniqueItems"),
            ("minProperties", lambda x: is_("object") & (F.size(names) < x), "minProperties"),
        ]
        for keyword, bad, rule in tests:
            if keyword in schema:
                check(bad(schema[keyword]), rule)
        if schema.get("required"):
            missing = F.filter(F.array(*map(F.lit, schema["required"])), lambda n: ~F.array_contains(names, n))
            parts.append(self._each(is_("object"), missing, lambda n: F.struct(F.concat_ws("/", path, n).alias("path"), F.lit("required").alias("rule"))))
        known = schema.get("properties", {})
        if schema.get("additionalProperties") is False:
            extra = F.filter(names, lambda n: ~n.isin(*known) if known else F.lit(True))
            parts.append(self._each(is_("object"), extra, lambda n: F.struct(F.concat_ws("/", path, n).alias("path"), F.lit("additionalProperties").alias("rule"))))
        elif isinstance(schema.get("additionalProperties"), dict):
            raise ValueError("additionalProperties may only be true or false")
        if "propertyNames" in schema:
            wrong = F.filter(names, lambda n: ~n.rlike(schema["propertyNames"]["pattern"]))
            parts.append(self._each(is_("object"), wrong, lambda n: F.struct(F.concat_ws("/", path, n).alias("path"), F.lit("propertyNames").alias("rule"))))
        for name, child in known.items():
            found = self.node(F.try_element_at(members, F.lit(name)), child, F.concat_ws("/", path, F.lit(name)), refs)
            parts.append(F.when(is_("object") & F.map_contains_key(members, name), found).otherwise(F.array().cast(_ROW)))
        if "items" in schema:
            inside = F.flatten(F.transform(items, lambda x, i: self.node(x, schema["items"], F.concat_ws("/", path, i.cast("string")), refs)))
            parts.append(F.when(is_("array"), inside).otherwise(F.array().cast(_ROW)))
        for s in schema.get("allOf", []):
            parts.append(self.node(v, s, path, refs))
        for keyword in ("anyOf", "oneOf"):
            if keyword in schema:
                fits = F.lit(0)
                for s in schema[keyword]:
                    fits = fits + (F.size(self.node(v, s, path, refs)) == 0).cast("int")
                check(fits < 1 if keyword == "anyOf" else fits != 1, keyword)
        if "not" in schema:
            check(F.size(self.node(v, schema["not"], path, refs)) == 0, "not")
        return F.concat(F.array().cast(_ROW), *parts) if parts else F.array().cast(_ROW)

    def _target(self, ref: str) -> dict:
        if not ref.startswith("#/"):
            raise ValueError(f"{ref} leads out of the schema")
        node = self.root
        for step in ref[2:].split("/"):
            node = node[step]
        return node

    @staticmethod
    def _rule(bad: Column, path: Column, rule: str) -> Column:
        row = F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"))).cast(_ROW)
        return F.when(F.coalesce(bad, F.lit(False)), row).otherwise(F.array().cast(_ROW))

    @staticmethod
    def _each(when: Column, names: Column, row: Callable[[Column], Column]) -> Column:
        return F.when(when, F.transform(names, row).cast(_ROW)).otherwise(F.array().cast(_ROW))


def _kind(v: Column) -> Column:
    """The JSON type; whole numbers written with a fraction of zero are integers, as JSON Schema has it.  Null for no value."""
    shape = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    return (
        F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(shape == "VOID", "null").when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean")
        .when(shape.isNotNull() & (number == F.floor(number)), "integer").when(shape.isNotNull(), "number")
    )


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body``, which gives an array, of a value that is worked out once, however often ``body`` uses it."""
    return F.flatten(F.transform(F.array(value), body))


def _members(v: Column, kind: Column) -> Column:
    """An object's values by name, null for other values."""
    return F.when(kind == "object", F.try_variant_get(v, "$", "map<string,variant>"))


def _equals(v: Column, kind: Column, constant: object) -> Column:
    """Whether a value is a constant: scalars by type and value, containers by their JSON."""
    if constant is None:
        return F.coalesce(kind == "null", F.lit(False))
    if isinstance(constant, bool):
        return F.coalesce((kind == "boolean") & (F.try_variant_get(v, "$", "boolean") == constant), F.lit(False))
    if isinstance(constant, int | float):
        return F.coalesce(kind.isin("integer", "number") & (F.try_variant_get(v, "$", "double") == float(constant)), F.lit(False))
    if isinstance(constant, str):
        return F.coalesce((kind == "string") & (F.try_variant_get(v, "$", "string") == constant), F.lit(False))
    return F.coalesce(F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(constant)))), F.lit(False))

"""JSON Schemas as native expressions over VARIANT values: any nesting, no Python worker."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD_JSON = "not JSON"
_TYPES = {
    "string": ("STRING",), "integer": ("BIGINT",), "boolean": ("BOOLEAN",), "null": ("VOID",), "object": ("OBJECT",), "array": ("ARRAY",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
}
_NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$defs", "definitions", "strict", "$comment"}
_RULES = {
    "type", "enum", "const", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "minLength",
    "maxLength", "pattern", "minimum", "maximum", "anyOf", "allOf", "$ref",
}


def _is(value: Column, kinds: str | Sequence[str]) -> Column:
    kinds = [kinds] if isinstance(kinds, str) else list(kinds)
    told = F.schema_of_variant(value)
    return reduce(or_, [told.startswith(t) for k in kinds for t in _TYPES[k]])


def _fault(broken: Column, path: Column, rule: str) -> Column:
    """An array with one fault, or none; a rule that cannot be judged (null) is not broken."""
    return F.when(broken, F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule")))).otherwise(_none())


def _none() -> Column:
    return F.expr("CAST(array() AS ARRAY<STRUCT<path: STRING, rule: STRING>>)")


def _get(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _same(value: Column, wanted) -> Column:
    if isinstance(wanted, str):
        return _is(value, "string") & (_get(value, "string") == wanted)
    if wanted is None:
        return _is(value, "null")
    if isinstance(wanted, bool):
        return _is(value, "boolean") & (_get(value, "boolean") == wanted)
    if isinstance(wanted, int | float):
        return _is(value, "number") & (_get(value, "double") == float(wanted))
    return F.to_json(value) == F.to_json(F.parse_json(F.lit(json.dumps(wanted))))


class _Compiler:
    def __init__(self, schema: Mapping):
        self.root, self.depth = schema, 0

    def _resolved(self, schema: Mapping) -> Mapping:
        found = self.root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            found = found[part]
        return found

    def faults(self, value: Column, schema: Mapping | bool, path: Column) -> Column:
        """``ARRAY<STRUCT<path, rule>>`` of a value that is there."""
        if schema is True or schema == {}:
            return _none()
        if schema is False:
            return _fault(F.lit(True), path, "false")
        strange = set(schema) - _RULES - _NOTES
        if strange:
            raise ValueError(f"rules that are not supported: {sorted(strange)}")
        if "$ref" in schema:
            self.depth += 1
            if self.depth > 50:
                raise ValueError("the schema contains itself")
            out = self.faults(value, self._resolved(schema), path)
            self.depth -= 1
            return out
        found = []
        if "type" in schema:
            found.append(_fault(~_is(value, schema["type"]), path, "type"))
        if "enum" in schema or "const" in schema:
            allowed = schema.get("enum", [schema.get("const")])
            texts = [a for a in allowed if isinstance(a, str)]
            hits = [_same(value, a) for a in allowed if not isinstance(a, str)]
            if texts:
                hits.append(_is(value, "string") & _get(value, "string").isin(texts))
            found.append(_fault(~F.coalesce(reduce(or_, hits), F.lit(False)), path, "enum"))
        text, number = F.when(_is(value, "string"), _get(value, "string")), F.when(_is(value, "number"), _get(value, "double"))
        for rule, broken in (
            ("minLength", lambda n: F.length(text) < n), ("maxLength", lambda n: F.length(text) > n), ("pattern", lambda p: ~text.rlike(p)),
            ("minimum", lambda n: number < n), ("maximum", lambda n: number > n),
        ):
            if rule in schema:
                found.append(_fault(broken(schema[rule]), path, rule))
        if schema.keys() & {"required", "properties", "additionalProperties"}:
            found += self._object(value, schema, path)
        if schema.keys() & {"items", "minItems", "maxItems"}:
            found += self._array(value, schema, path)
        for part in schema.get("allOf", []):
            found.append(self.faults(value, part, path))
        if "anyOf" in schema:
            fits = reduce(or_, [F.size(self.faults(value, part, path)) == 0 for part in schema["anyOf"]])
            found.append(_fault(~fits, path, "anyOf"))
        return F.concat(*found) if len(found) > 1 else found[0] if found else _none()

    def _object(self, value: Column, schema: Mapping, path: Column) -> list[Column]:
        fields = F.when(_is(value, "object"), _get(value, "map<string,variant>"))
        properties = schema.get("properties", {})
        found = [
            _fault(~F.map_contains_key(fields, name), F.concat(path, F.lit(f".{name}")), "required")
            for name in schema.get("required", [])
        ]
        others = schema.get("additionalProperties", True)
        if others is not True:
            known = F.array(*[F.lit(n) for n in properties]) if properties else F.expr("CAST(array() AS ARRAY<STRING>)")
            names = F.array_except(F.map_keys(fields), known)
            if others is False:
                told = F.transform(names, lambda n: F.struct(F.concat(path, F.lit("."), n).alias("path"), F.lit("additional").alias("rule")))
            else:
                told = F.flatten(F.transform(names, lambda n: self.faults(fields[n], others, F.concat(path, F.lit("."), n))))
            found.append(F.coalesce(told, _none()))
        for name, part in properties.items():
            own = F.try_element_at(fields, F.lit(name))
            # Where the property is not there its rules have nothing to judge.
            inner = self.faults(own, part, F.concat(path, F.lit(f".{name}")))
            found.append(F.when(own.isNotNull(), inner).otherwise(_none()))
        return found

    def _array(self, value: Column, schema: Mapping, path: Column) -> list[Column]:
        items = F.when(_is(value, "array"), _get(value, "array<variant>"))
        found = []
        if "minItems" in schema:
            found.append(_fault(F.size(items) < schema["minItems"], path, "minItems"))
        if "maxItems" in schema:
            found.append(_fault(F.size(items) > schema["maxItems"], path, "maxItems"))
        if "items" in schema:
            at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            inner = F.transform(items, lambda x, i: self.faults(x, schema["items"], at(i)))
            found.append(F.coalesce(F.flatten(inner), _none()))
        return found


def schema_faults(json_col: str | Column, schema: Mapping) -> Column:
    """``ARRAY<STRUCT<path, rule>>``: every rule of the JSON Schema that a JSON text breaks, empty if it conforms.

    Paths begin with ``$``; text that is no JSON value, or has text after it or a key twice, has the one fault ``not JSON``, and so has
    NULL. Rules: type, enum, const, properties, required, additionalProperties, items, minItems, maxItems, minLength, maxLength,
    pattern (searched), minimum, maximum, anyOf, allOf, and $ref without recursion. Any other rule is a ``ValueError``.
    """
    text = F.col(json_col) if isinstance(json_col, str) else json_col
    # Inside an array, text after the value makes it invalid too.
    whole = _get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "array<variant>")
    one = F.when(F.size(whole) == 1, F.try_element_at(whole, F.lit(1)))
    judged = F.transform(F.array(one), lambda v: _Compiler(schema).faults(v, schema, F.lit("$")))
    bad = F.array(F.struct(F.lit("$").alias("path"), F.lit(BAD_JSON).alias("rule")))
    return F.when(one.isNull(), bad).otherwise(F.try_element_at(judged, F.lit(1)))


def check_schema(df: DataFrame, json_col: str, schema: Mapping, out: str = "faults") -> DataFrame:
    """Add ``out``, the ``schema_faults`` of a column. A projection: no shuffle."""
    return df.withColumn(out, schema_faults(json_col, schema))

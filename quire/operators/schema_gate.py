"""JSON Schema as column checks on VARIANT values, and the gate that records pass before they are written."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keywords that say nothing on validity, and those that are checked.
ANNOTATIONS = {"$schema", "$id", "$defs", "definitions", "$comment", "title", "description", "examples", "default", "format", "deprecated", "readOnly", "writeOnly"}
CHECKED = {
    "$ref", "type", "enum", "const", "required", "properties", "additionalProperties", "items", "minItems", "maxItems", "uniqueItems", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
    "minLength", "maxLength", "pattern", "minProperties", "maxProperties", "oneOf", "anyOf", "allOf", "not",
}
#: How deep references may nest; a schema that refers to itself has no end as columns.
DEEPEST = 24


def _get(value: Column, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(value, path, kind)


def _once(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _of_type(value: Column, found: Column, kind: str) -> Column:
    """Whether a value with the schema ``found`` is of a JSON type; a number without a fraction is an integer."""
    if kind == "object":
        return found.startswith("OBJECT")
    if kind == "array":
        return found.startswith("ARRAY")
    if kind in ("number", "integer"):
        number = found.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")
        whole = _get(value, "double")
        return number if kind == "number" else number & (whole == F.floor(whole))
    return found == {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}[kind]


class Compiler:
    """Checks for one schema; ``ValueError`` for keywords it doesn't know, so none is passed over."""

    def __init__(self, schema: dict):
        self.root = schema

    def resolve(self, ref: str) -> dict | bool:
        if not ref.startswith("#"):
            raise ValueError(f"only local references are read: {ref}")
        node = self.root
        for part in ref[1:].split("/")[1:]:
            node = node[part.replace("~1", "/").replace("~0", "~")]
        return node

    def check(self, schema: dict | bool, value: Column, path: Column, depth: int = 0) -> Column:
        """``path:rule`` of every rule that a value breaks, as an array; a missing value breaks none."""
        if depth > DEEPEST:
            raise ValueError(f"the schema nests deeper than {DEEPEST}")
        if isinstance(schema, bool):
            return F.array().cast("array<string>") if schema else F.array(F.concat(path, F.lit(":false")))
        if unknown := set(schema) - ANNOTATIONS - CHECKED:
            raise ValueError(f"unknown keywords: {', '.join(sorted(unknown))}")
        return _once(value, lambda v: _once(F.schema_of_variant(v), lambda found: self._check(schema, v, found, path, depth)))

    def _check(self, schema: dict, value: Column, found: Column, path: Column, depth: int) -> Column:
        rules = [(self._rule(k, v, value, found), k) for k, v in schema.items() if k in CHECKED]
        broken = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.concat(path, F.lit(f":{name}"))) for bad, name in rules if bad is not None), F.lit(None).cast("string")))
        inner = [part for k, v in schema.items() if k in CHECKED for part in self._inner(k, v, schema, value, found, path, depth + 1)]
        every = F.concat(broken, *inner) if inner else broken
        return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(every)

    def _rule(self, name: str, want, value: Column, found: Column) -> Column | None:
        """The condition under which a value breaks a rule that looks at it alone."""
        text, number = _get(value, "string"), _get(value, "double")
        is_text, is_number = _of_type(value, found, "string"), _of_type(value, found, "number")
        items, entries = _get(value, "array<variant>"), _get(value, "map<string,variant>")
        is_list, is_object = _of_type(value, found, "array"), _of_type(value, found, "object")
        if name == "type":
            kinds = [_of_type(value, found, k) for k in ([want] if isinstance(want, str) else want)]
            fits = kinds[0]
            for k in kinds[1:]:
                fits = fits | k
            return ~fits
        if name in ("enum", "const"):
            return ~F.to_json(value).isin(*(json.dumps(v, ensure_ascii=False, separators=(",", ":")) for v in (want if name == "enum" else [want])))
        rules = {
            "minimum": lambda: is_number & (number < want),
            "maximum": lambda: is_number & (number > want),
            "exclusiveMinimum": lambda: is_number & (number <= want),
            "exclusiveMaximum": lambda: is_number & (number >= want),
            "minLength": lambda: is_text & (F.length(text) < want),
            "maxLength": lambda: is_text & (F.length(text) > want),
            "pattern": lambda: is_text & ~text.rlike(want),
            "minItems": lambda: is_list & (F.size(items) < want),
            "maxItems": lambda: is_list & (F.size(items) > want),
            "uniqueItems": lambda: is_list & (F.size(F.array_distinct(F.transform(items, lambda x: F.to_json(x)))) < F.size(items)) if want else F.lit(False),
            "minProperties": lambda: is_object & (F.size(entries) < want),
            "maxProperties": lambda: is_object & (F.size(entries) > want),
        }
        return rules[name]() if name in rules else None

    def _inner(self, name: str, want, schema: dict, value: Column, found: Column, path: Column, depth: int):
        """Arrays of what the parts of a value break."""
        is_object = _of_type(value, found, "object")
        none = F.array().cast("array<string>")
        child = lambda key: _get(value, "variant", f"$[{json.dumps(key)}]")
        if name == "$ref":
            yield self.check(self.resolve(want), value, path, depth)
        elif name == "required" and want:
            yield F.when(is_object, F.array_compact(F.array(*(F.when(child(k).isNull(), F.concat(path, F.lit(f".{k}:required"))) for k in want)))).otherwise(none)
        elif name == "properties":
            for key, sub in want.items():
                yield self.check(sub, child(key), F.concat(path, F.lit(f".{key}")), depth)
        elif name == "additionalProperties" and want is not True:
            known = list(schema.get("properties", {}))
            more = F.filter(F.map_entries(_get(value, "map<string,variant>")), lambda e: ~e["key"].isin(*known) if known else F.lit(True))
            each = F.transform(more, lambda e: self._extra(want, e, path, depth))
            yield F.when(is_object, F.flatten(each)).otherwise(none)
        elif name == "items":
            each = F.transform(_get(value, "array<variant>"), lambda x, i: self.check(want, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), depth))
            yield F.when(_of_type(value, found, "array"), F.flatten(each)).otherwise(none)
        elif name == "allOf":
            for sub in want:
                yield self.check(sub, value, path, depth)
        elif name in ("oneOf", "anyOf", "not"):
            subs = [want] if name == "not" else want
            fits = sum((F.when(F.size(self.check(sub, value, path, depth)) == 0, 1).otherwise(0) for sub in subs), F.lit(0))
            good = {"oneOf": fits == 1, "anyOf": fits > 0, "not": fits == 0}[name]
            yield F.when(good, none).otherwise(F.array(F.concat(path, F.lit(f":{name}"))))

    def _extra(self, want, entry: Column, path: Column, depth: int) -> Column:
        where = F.concat(path, F.lit("."), entry["key"])
        return F.array(F.concat(where, F.lit(":additionalProperties"))) if want is False else self.check(want, entry["value"], where, depth)


def schema_violations(schema: dict | str, value: Column) -> Column:
    """The broken rules of a VARIANT value as ``path:rule``, ``$`` being the whole; ``$:null`` for a null.

    The schema is a dictionary or JSON text. Local references, nested arrays and all keywords of
    ``CHECKED`` are compiled; formats are notes, as by default.
    """
    schema = json.loads(schema) if isinstance(schema, str) else schema
    compiler = Compiler(schema)
    return _once(value, lambda v: F.when(v.isNull(), F.array(F.lit("$:null"))).otherwise(compiler.check(schema, v, F.lit("$"))))


def gate(own: DataFrame, schema: dict | str, inherited: DataFrame | None = None, key: str = "doc_id", record: str = "record") -> tuple[DataFrame, DataFrame]:
    """(records to write, complaints) of records as JSON text.

    A record that breaks the schema is refused, unless the one it was built on breaks it already: then
    it is written and the complaint is a warning. Complaints: ``key``, ``severity`` (refuse, warn),
    ``source`` (own, inherited) and ``violation``. Text that is no JSON breaks ``$:null``.
    """
    judge = lambda df, name: df.select(key, schema_violations(schema, F.try_parse_json(record)).alias(name))
    judged = own.withColumn("__own", schema_violations(schema, F.try_parse_json(record)))
    none = F.array().cast("array<string>")
    if inherited is None:
        judged = judged.withColumn("__base", none)
    else:
        judged = judged.join(judge(inherited, "__base"), key, "left").withColumn("__base", F.coalesce("__base", none))
    refused = (F.size("__own") > 0) & (F.size("__base") == 0)
    complaint = lambda source, severity: F.transform(f"__{source}", lambda v: F.struct(severity.alias("severity"), F.lit(source_names[source]).alias("source"), v.alias("violation")))
    source_names = {"own": "own", "base": "inherited"}
    every = F.concat(complaint("own", F.when(refused, "refuse").otherwise("warn")), complaint("base", F.lit("warn")))
    complaints = judged.select(key, F.explode(every).alias("c")).select(key, "c.*")
    return judged.where(~refused).drop("__own", "__base"), complaints


def raise_if_refused(complaints: DataFrame, key: str = "doc_id") -> None:
    """The strict policy: the first refused record is an error."""
    first = complaints.where("severity = 'refuse'").orderBy(F.col(key).cast("string"), "violation").first()
    if first:
        raise ValueError(f"{first[key]}: {first['violation']}")

"""JSON Schema compiled to one column: the violations of a VARIANT document, each as `path: keyword`.

A schema is turned into expressions once, on the driver; documents are checked in the pass that reads them, with no
Python on the executors. Elements of arrays and values of objects are checked by higher-order functions, so documents
may be of any size. Known keywords: type (one or several), enum, const, required, properties, additionalProperties, items, minItems, maxItems, uniqueItems,
minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum, format (date-time, uri), oneOf,
anyOf, allOf, not, if/then/else, $ref into $defs. Annotations (title, $schema, $id, description, default) are skipped, an
unknown keyword is an error.

Defined cases: a document that is null (absent, or no JSON) breaks `type`; keywords that don't apply to a value's type
hold, as in the specification.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import payload as N
from corvane.functions import text as T

KINDS = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID", "object": "OBJECT", "array": "ARRAY"}
SKIPPED = {"title", "$schema", "$id", "$defs", "description", "default", "examples", "$comment", "then", "else"}
DATE_TIME = r"^\d{4}-\d\d-\d\d[Tt ]\d\d:\d\d:\d\d(\.\d+)?([Zz]|[+-]\d\d:\d\d)$"
NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"


class SchemaError(ValueError):
    """The schema has a keyword that isn't known."""


class _Compiler:
    def __init__(self, root: dict):
        self.root, self.open = root, []

    def check(self, schema, value: Column, path: str) -> list[tuple[str, Column]]:
        """(violation, condition under which it is broken) and, for parts of unknown number, arrays of violations."""
        if schema is True or schema == {}:
            return []
        if schema is False:
            return [(f"{path}: false", F.lit(True))]
        out: list = []
        for keyword, arg in schema.items():
            if keyword in SKIPPED:
                continue
            rule = getattr(self, "_" + keyword.lstrip("$"), None)
            if rule is None:
                raise SchemaError(f"{path}: unknown keyword {keyword!r}")
            out += rule(arg, value, path, schema)
        return out

    def array(self, schema, value: Column, path: str) -> Column:
        """The violations of a schema as an array."""
        found = self.check(schema, value, path)
        parts = [F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in found if name is not None]))] if any(n is not None for n, _ in found) else []
        parts += [c for name, c in found if name is None]
        return reduce(lambda a, b: F.concat(a, b), parts) if parts else F.array().cast("array<string>")

    def holds(self, schema, value: Column) -> Column:
        return F.size(self.array(schema, value, "")) == 0

    @staticmethod
    def kind(value: Column) -> Column:
        return F.coalesce(F.schema_of_variant(value), F.lit("ABSENT"))

    def _type(self, arg, value, path, _):
        kind, ok = self.kind(value), F.lit(False)
        for name in [arg] if isinstance(arg, str) else arg:
            if name == "integer":
                ok = ok | kind.rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))$") | (kind.rlike("^(DOUBLE|FLOAT)") & (F.try_variant_get(value, "$", "double") % 1 == 0))
            elif name == "number":
                ok = ok | kind.rlike(NUMBER)
            elif name in KINDS:
                ok = ok | kind.startswith(KINDS[name])
            else:
                raise SchemaError(f"{path}: unknown type {name!r}")
        return [(f"{path}: type", ~ok)]

    def _const(self, arg, value, path, _):
        return self._enum([arg], value, path, _, "const")

    def _enum(self, arg, value, path, _, name="enum"):
        wanted = [N.canonical_json(F.lit(json.dumps(a, ensure_ascii=False))) for a in arg] if any(isinstance(a, float) for a in arg) else [F.lit(json.dumps(a, ensure_ascii=False, sort_keys=True, separators=(",", ":"))) for a in arg]
        return [(f"{path}: {name}", ~F.coalesce(F.to_json(value).isin(*wanted), F.lit(False)))]

    def _number(self, value):
        return F.when(self.kind(value).rlike(NUMBER), F.try_variant_get(value, "$", "double"))

    def _minimum(self, arg, value, path, _):
        return [(f"{path}: minimum", self._number(value) < arg)]

    def _maximum(self, arg, value, path, _):
        return [(f"{path}: maximum", self._number(value) > arg)]

    def _exclusiveMinimum(self, arg, value, path, _):
        return [(f"{path}: exclusiveMinimum", self._number(value) <= arg)]

    def _exclusiveMaximum(self, arg, value, path, _):
        return [(f"{path}: exclusiveMaximum", self._number(value) >= arg)]

    def _string(self, value):
        return F.when(self.kind(value) == "STRING", F.try_variant_get(value, "$", "string"))

    def _minLength(self, arg, value, path, _):
        return [(f"{path}: minLength", F.char_length(self._string(value)) < arg)]

    def _maxLength(self, arg, value, path, _):
        return [(f"{path}: maxLength", F.char_length(self._string(value)) > arg)]

    def _pattern(self, arg, value, path, _):
        return [(f"{path}: pattern", ~self._string(value).rlike(arg))]

    def _format(self, arg, value, path, _):
        text = self._string(value)
        if arg == "date-time":
            ok = text.rlike(DATE_TIME) & F.try_to_timestamp(text).isNotNull()
        elif arg == "uri":
            ok = text.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]*$") & (~text.rlike("(?i)^https?:") | F.coalesce(T.public_url(text), F.lit(False)))
        else:
            raise SchemaError(f"{path}: unknown format {arg!r}")
        return [(f"{path}: format", text.isNotNull() & ~ok)]

    def _keys(self, value):
        return F.when(self.kind(value).startswith("OBJECT"), F.map_keys(F.try_variant_get(value, "$", "map<string,variant>")))

    def _required(self, arg, value, path, _):
        keys = self._keys(value)
        return [(f"{path}.{k}: required", ~F.array_contains(keys, k)) for k in arg]

    def _properties(self, arg, value, path, _):
        out, keys = [], self._keys(value)
        for k, sub in arg.items():
            found = F.try_element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(k))
            inner = self.array(sub, found, f"{path}.{k}")
            out.append((None, F.when(F.array_contains(keys, k), inner).otherwise(F.array().cast("array<string>"))))
        return out

    def _additionalProperties(self, arg, value, path, schema):
        known = list(schema.get("properties", {}))
        if arg is True:
            return []
        more = F.array_except(self._keys(value), F.array(*[F.lit(k) for k in known]).cast("array<string>"))
        if arg is False:
            return [(f"{path}: additionalProperties", F.size(more) > 0)]
        whole = F.try_variant_get(value, "$", "map<string,variant>")
        each = F.flatten(F.transform(more, lambda k: self.array(arg, F.try_element_at(whole, k), f"{path}.*")))
        return [(None, F.array_distinct(F.coalesce(each, F.array().cast("array<string>"))))]

    def _elements(self, value):
        return F.when(self.kind(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>"))

    def _items(self, arg, value, path, _):
        each = F.flatten(F.transform(self._elements(value), lambda x: self.array(arg, x, f"{path}[]")))
        return [(None, F.array_distinct(F.coalesce(each, F.array().cast("array<string>"))))]

    def _minItems(self, arg, value, path, _):
        return [(f"{path}: minItems", F.size(self._elements(value)).between(0, arg - 1))]

    def _maxItems(self, arg, value, path, _):
        return [(f"{path}: maxItems", F.size(self._elements(value)) > arg)]

    def _uniqueItems(self, arg, value, path, _):
        texts = F.transform(self._elements(value), lambda x: F.to_json(x))
        return [(f"{path}: uniqueItems", F.size(texts) > F.size(F.array_distinct(texts)))] if arg else []

    def _matching(self, arg, value):
        return reduce(lambda a, b: a + b, [self.holds(s, value).cast("int") for s in arg])

    def _oneOf(self, arg, value, path, _):
        return [(f"{path}: oneOf", self._matching(arg, value) != 1)]

    def _anyOf(self, arg, value, path, _):
        return [(f"{path}: anyOf", self._matching(arg, value) == 0)]

    def _allOf(self, arg, value, path, _):
        return [x for s in arg for x in self.check(s, value, path)]

    def _not(self, arg, value, path, _):
        return [(f"{path}: not", self.holds(arg, value))]

    def _if(self, arg, value, path, schema):
        yes, none = self.holds(arg, value), F.array().cast("array<string>")
        then = self.array(schema["then"], value, path) if "then" in schema else none
        other = self.array(schema["else"], value, path) if "else" in schema else none
        return [(None, F.when(yes, then).otherwise(other))]

    def _ref(self, arg, value, path, _):
        target = self.root
        for part in arg.removeprefix("#").strip("/").split("/") if arg != "#" else []:
            if not isinstance(target, dict) or part not in target:
                raise SchemaError(f"{path}: no target of $ref {arg!r}")
            target = target[part]
        if arg in self.open:
            raise SchemaError(f"{path}: {arg!r} refers to itself")
        self.open.append(arg)
        try:
            return self.check(target, value, path)
        finally:
            self.open.pop()


def compiled(schema: dict, document: Column) -> Column:
    """The violations of a document (VARIANT) as a sorted array of distinct texts."""
    return F.array_sort(F.array_distinct(_Compiler(schema).array(schema, document, "$")))


def conforming(rows: DataFrame, schema: dict, document: str, key: str, scope: str = "schema") -> DataFrame:
    """(scope, key, rule) of every violation of every row's document."""
    return rows.select(F.lit(scope).alias("scope"), F.col(key).cast("string").alias("key"), F.explode(compiled(schema, F.col(document))).alias("rule"))

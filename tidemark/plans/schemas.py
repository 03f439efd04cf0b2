"""Nested JSON schemas as column expressions (N2, O5, F10, F14): a schema is compiled once, and rows are tested without leaving the JVM.

Texts are parsed to variants; each node of the schema becomes an expression that gives its errors, with the path of the
value in question. Errors come in path order: a node's own before those below it, properties by name, items by place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import ConfigError

# The schema language's types as the engine's names for a variant's type.
TYPES = {"object": ("OBJECT",), "array": ("ARRAY",), "string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",), "null": ("VOID",)}
IGNORED = {"$schema", "id", "$id", "title", "description", "default", "examples"}
KNOWN = IGNORED | {"type", "required", "properties", "additionalProperties", "items", "enum", "minimum", "maximum", "minLength", "maxLength", "pattern", "minItems", "maxItems"}


def kind_of(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def member(value: Column, name: str) -> Column:
    if "'" in name or "\\" in name:
        raise ConfigError(f"a property's name can't have quotes or backslashes: {name}")
    return F.try_variant_get(value, f"$['{name}']", "variant")


def joined(parts: list[Column]) -> Column:
    return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else F.array().cast("array<string>")


def found(wrong: Column, path: Column, text: Column | str) -> Column:
    """One error if ``wrong`` is true."""
    message = F.concat(path, F.lit(": "), text if isinstance(text, Column) else F.lit(text))
    return F.when(wrong, F.array(message)).otherwise(F.array().cast("array<string>"))


def below(schema: dict, value: Column, path: Column) -> Column:
    """The errors of a value that may be missing; it stands once in the plan."""
    one = F.transform(F.array(value), lambda v: F.when(v.isNotNull(), node(schema, v, path)).otherwise(F.array().cast("array<string>")))
    return F.flatten(one)


def node(schema: dict, value: Column, path: Column) -> Column:
    """The errors of a value that is there, as an array of texts."""
    if odd := sorted(set(schema) - KNOWN):
        raise ConfigError(f"unknown in a schema: {', '.join(odd)}")
    own: list[Column] = []
    kind = kind_of(value)
    if "type" in schema:
        wanted = [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])
        if odd := [t for t in wanted if t not in TYPES]:
            raise ConfigError(f"unknown type: {', '.join(odd)}")
        own.append(found(~kind.isin(*(k for t in wanted for k in TYPES[t])), path, f"not of type {' or '.join(wanted)}"))
    if "enum" in schema:
        texts = [x if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x) for x in schema["enum"]]
        own.append(found(~F.coalesce(F.try_variant_get(value, "$", "string").isin(*texts), F.lit(False)), path, f"none of {', '.join(texts)}"))
    number = F.when(kind.isin(*TYPES["number"]), F.try_variant_get(value, "$", "double"))
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    items = F.when(kind == "ARRAY", F.try_variant_get(value, "$", "array<variant>"))
    bounds: list[tuple[str, Callable[[object], Column], str]] = [
        ("minimum", lambda x: number < F.lit(float(x)), "less than"), ("maximum", lambda x: number > F.lit(float(x)), "more than"),
        ("minLength", lambda x: F.length(text) < x, "shorter than"), ("maxLength", lambda x: F.length(text) > x, "longer than"),
        ("minItems", lambda x: F.size(items) < x, "fewer items than"), ("maxItems", lambda x: F.size(items) > x, "more items than"),
        ("pattern", lambda x: ~text.rlike(x), "doesn't match"),
    ]
    own += [found(F.coalesce(test(schema[k]), F.lit(False)), path, f"{words} {schema[k]}") for k, test, words in bounds if k in schema]
    is_object = kind == "OBJECT"
    own += [found(is_object & member(value, name).isNull(), path, f"'{name}' is a required property") for name in schema.get("required", [])]
    properties = schema.get("properties", {})
    if schema.get("additionalProperties") is False:
        names = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        more = F.array_sort(F.filter(F.when(is_object, names), lambda n: ~n.isin(*properties) if properties else F.lit(True)))
        own.append(F.coalesce(F.transform(more, lambda n: F.concat(path, F.lit(": '"), n, F.lit("' is not expected"))), F.array().cast("array<string>")))
    for name in sorted(properties):
        own.append(below(properties[name], member(value, name), F.concat(path, F.lit(f".{name}"))))
    if "items" in schema:
        each = F.transform(items, lambda v, i: node(schema["items"], v, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        own.append(F.coalesce(F.flatten(each), F.array().cast("array<string>")))
    return joined(own)


def schema_errors(text: Column, schema: dict) -> Column:
    """The errors of a JSON text under a schema, as an array of "path: what", empty if there are none.

    A null text is missing, one that isn't JSON has that one error. Known words: type, required, properties,
    additionalProperties (false), items (one schema), enum, minimum, maximum, minLength, maxLength, minItems, maxItems,
    pattern; others are an error when the schema is compiled. Numbers with a fraction are no integers, 1.0 included.
    """
    parsed = F.array(F.try_parse_json(text))
    errors = F.transform(parsed, lambda v: F.when(v.isNull(), F.array(F.lit("$: not JSON"))).otherwise(node(schema, v, F.lit("$"))))
    return F.when(text.isNull(), F.array(F.lit("$: missing"))).otherwise(F.flatten(errors))


def split_by_schema(df: DataFrame, column: str, schema: dict, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Rows whose text is valid, and the others with their ``errors``."""
    tested = df.withColumn(errors, schema_errors(F.col(column), schema))
    return tested.filter(F.size(errors) == 0).drop(errors), tested.filter(F.size(errors) > 0)

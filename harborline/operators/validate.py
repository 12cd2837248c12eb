"""Validation of envelopes: envelope rules, a compiler from JSON Schema to columns, and domain rules."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import envelope, jsontext
from harborline.session import spread
from harborline.types import DOMAINS, VALIDATION_ERRORS


def _error(when: Column, field: str | Column, message: str | Column, code: str, value: Column | None = None) -> Column:
    text = F.lit(None).cast("string") if value is None else value.cast("string")
    return F.when(when, F.struct((field if isinstance(field, Column) else F.lit(field)).alias("field"), (message if isinstance(message, Column) else F.lit(message)).alias("message"), F.lit(code).alias("error_code"), text.alias("value")))


def envelope_errors() -> list[Column]:
    """event_id and event_type are required; an event_type has a dot."""
    kind, missing = F.col("event_type"), lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    return [
        _error(missing("event_id"), "event_id", "an identifier is required", "REQUIRED_FIELD"),
        _error(missing("event_type"), "event_type", "an event type is required", "REQUIRED_FIELD"),
        _error(~missing("event_type") & ~kind.contains("."), "event_type", "an event type reads domain.action", "INVALID_FORMAT", kind),
    ]


def domain_errors() -> list[Column]:
    """The payload of a domain's event has the domain's id, in either case style; null counts as present."""
    d = envelope.domain(F.col("event_type"))
    named = F.concat(d, F.lit("_id"))
    has = F.arrays_overlap(F.json_object_keys("payload"), F.array(named, F.concat(d, F.lit("Id"))))
    return [_error(d.isin(DOMAINS) & ~F.coalesce(has, F.lit(False)), named, F.concat(d, F.lit(" events need "), named), "MISSING_DOMAIN_FIELD")]


#: Keywords with an effect, and annotations without one.
_KEYWORDS = set("type enum pattern minLength maxLength minimum maximum exclusiveMinimum exclusiveMaximum required properties $ref".split())
_KEYWORDS |= set("$schema $id $comment title description default examples format definitions $defs".split())


def _by_kind(values: list) -> dict[str, list]:
    """Members of an enum by JSON type."""
    out: dict[str, list] = {}
    for v in values:
        k = "null" if v is None else "boolean" if isinstance(v, bool) else "number" if isinstance(v, (int, float)) else "string" if isinstance(v, str) else None
        if k is None:
            raise ValueError("an enum of arrays or objects isn't supported")
        out.setdefault(k, []).append(v)
    return out


def compile_schema(schema: dict, root: Column) -> Column:
    """Array of the errors of a variant against a JSON Schema: type, required, properties, enum, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum, minLength, maxLength, $ref.

    A keyword counts only where the node has the JSON type it speaks of, and where the node exists. Annotations and
    `format` have no effect; any other keyword is refused. An integer may be written with a zero fraction; members of an
    enum are texts, numbers, booleans or null and count by JSON type. Each node is taken out of the variant once; the
    rules then see its type, text and number.
    """
    nodes: list[Column] = []
    rules: list = []  # functions of the struct of all nodes

    def visit(node: dict, path: list[str]) -> None:
        while "$ref" in node:
            target = schema
            for part in node["$ref"].lstrip("#/").split("/"):
                target = target[part]
            node = target
        unknown = set(node) - _KEYWORDS
        if unknown:
            raise ValueError(f"keywords that aren't supported at {'.'.join(path) or 'root'}: {', '.join(sorted(unknown))}")
        where, name, number = "$" + "".join(f"['{p}']" for p in path), ".".join(path) or "root", len(nodes)
        here = F.try_variant_get(root, where, "variant") if path else root
        text, value = (F.try_variant_get(root, where, t) if path else F.lit(None).cast(t) for t in ("string", "double"))
        children = [F.try_variant_get(root, f"{where}['{k}']", "variant").isNull() for k in node.get("required", [])]
        parts = [F.schema_of_variant(here).alias("kind"), text.alias("text"), value.alias("number"), *[c.alias(f"no{k}") for k, c in enumerate(children)]]
        nodes.append(F.struct(*parts).alias(f"n{number}"))
        rules.append(lambda n: _node_errors(node, name, n[f"n{number}"]))
        for key, child in node.get("properties", {}).items():
            visit(child, [*path, key])

    visit(schema, [])
    found = F.transform(F.array(F.struct(*nodes)), lambda n: F.array_compact(F.array(*[e for r in rules for e in r(n)])))
    return F.get(found, F.lit(0))


def _node_errors(node: dict, name: str, n: Column) -> list[Column]:
    """Errors of one node, given as kind (Spark's name of the variant's type), text, number and noK for its K-th required key being absent."""
    out: list[Column] = []
    kind, text, number = n["kind"], n["text"], n["number"]
    kinds = {"object": kind.startswith("OBJECT"), "array": kind.startswith("ARRAY"), "string": kind == "STRING", "boolean": kind == "BOOLEAN", "null": kind == "VOID"}
    kinds["number"] = ~(kinds["object"] | kinds["array"] | kind.isin("STRING", "BOOLEAN", "VOID"))
    is_ = lambda k: F.coalesce(kinds[k], F.lit(False))
    shown = F.when(~is_("object"), text)
    add = lambda cond, said: out.append(_error(F.coalesce(cond, F.lit(False)), name, said, "SCHEMA_VIOLATION", shown))
    if "type" in node:
        allowed = node["type"] if isinstance(node["type"], list) else [node["type"]]
        fits = F.lit(False)
        for t in allowed:
            fits = fits | ((is_("number") & (number == F.floor(number))) if t == "integer" else is_(t))
        add(kind.isNotNull() & ~fits, f"is not of type {' or '.join(allowed)}")
    if "enum" in node:
        listed = F.lit(False)
        for k, values in _by_kind(node["enum"]).items():
            same = {"string": lambda v: text.isin(v), "number": lambda v: number.isin([float(x) for x in v]), "boolean": lambda v: text.isin([str(x).lower() for x in v]), "null": lambda v: F.lit(True)}[k]
            listed = listed | (is_(k) & F.coalesce(same(values), F.lit(False)))
        add(kind.isNotNull() & ~listed, "is none of the listed values")
    if "pattern" in node:
        add(is_("string") & ~text.rlike(node["pattern"]), f"does not match {node['pattern']}")
    for word, bad in (("minLength", lambda m: F.char_length(text) < m), ("maxLength", lambda m: F.char_length(text) > m)):
        if word in node:
            add(is_("string") & bad(node[word]), f"breaks {word} {node[word]}")
    for word, bad in (("minimum", lambda m: number < m), ("maximum", lambda m: number > m), ("exclusiveMinimum", lambda m: number <= m), ("exclusiveMaximum", lambda m: number >= m)):
        if word in node:
            add(is_("number") & bad(node[word]), f"breaks {word} {node[word]}")
    for k, key in enumerate(node.get("required", [])):
        add(is_("object") & n[f"no{k}"], f"'{key}' is required")
    return out


def load_schemas(folder: str | Path) -> dict[str, dict]:
    """JSON Schemas of a folder by file name without its ending."""
    return {p.stem: json.loads(p.read_text()) for p in sorted(Path(folder).glob("*.json"))}


def validated(df: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """Envelopes with `errors`, an array that is empty for valid ones.

    Of the schemas, the one named type_version counts, else type, else domain. A null or unreadable payload breaks a
    schema that wants an object.
    """
    schemas, df = schemas or {}, spread(df)
    parts = [F.array_compact(F.array(*envelope_errors()))]
    kind, d = F.col("event_type"), envelope.domain(F.col("event_type"))
    versioned = F.concat(kind, F.lit("_"), F.col("event_version"))
    chosen = F.when(versioned.isin(list(schemas)), versioned).when(kind.isin(list(schemas)), kind).when(d.isin(list(schemas)), d) if schemas else F.lit(None)
    if schemas:
        df = jsontext.once(df.withColumn("_schema", chosen), "_payload", F.coalesce(F.try_parse_json("payload"), F.parse_json(F.lit("null"))))
        checked = F
        for name, schema in schemas.items():
            checked = checked.when(F.col("_schema") == name, compile_schema(schema, F.col("_payload")))
        parts.append(F.coalesce(checked.otherwise(None), F.array().cast(VALIDATION_ERRORS)))
    parts.append(F.array_compact(F.array(*domain_errors())))
    return jsontext.once(df, "errors", F.concat(*parts)).drop("_schema", "_payload")


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) of validated(); one pass serves both if the input is cached or written."""
    return df.where("size(errors) = 0").drop("errors"), df.where("size(errors) > 0")

"""JSON text as columns: scalars by path, kinds of nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """A JSON text as a variant; null where it isn't JSON."""
    return F.try_parse_json(text)


def kind(node: Column) -> Column:
    """JSON type of a variant: object, array, string, boolean, number or null; SQL null where there is no node."""
    name = F.schema_of_variant(node)
    return (
        F.when(node.isNull(), F.lit(None).cast("string"))
        .when(F.is_variant_null(node), "null")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .otherwise("number")
    )


def _no_container(value: Column, text: Column, path: str) -> Column:
    """value, found at a path of a text, unless an object or array stands there; only what begins like one is parsed again."""
    node = F.try_variant_get(parsed(text), path, "variant")
    return F.when(~value.rlike(r"^\s*[{\[]"), value).when(F.schema_of_variant(node) == "STRING", value)


def scalar(text: Column, path: str) -> Column:
    """The scalar at a path ($.a.b) as text; null for objects, arrays, JSON null and missing paths."""
    return _no_container(F.get_json_object(text, path), text, path)


class Scalars:
    """The scalars at several paths of a JSON text, read in one parse.

    column() is the parsed struct, to be put into a projection of its own; get() gives the scalar at a path (a.b) as
    text, as scalar() does, from the column named `name`. A text that isn't a whole JSON object has none.
    """

    def __init__(self, text: str, paths: list[str], name: str = "_scalars"):
        self.text, self.name = text, name
        self.tree: dict[str, dict] = {}
        for path in paths:
            at = self.tree
            for part in path.split("."):
                at = at.setdefault(part, {})

    def column(self) -> Column:
        ddl = lambda t: "STRUCT<" + ", ".join(f"`{k}`: {ddl(v) if v else 'STRING'}" for k, v in t.items()) + ">"
        return F.from_json(F.col(self.text), ddl(self.tree)).alias(self.name)

    def get(self, path: str) -> Column:
        return _no_container(F.col(f"{self.name}.{path}"), F.col(self.text), f"$.{path}")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once per row: filters on it and uses of it are not rewritten into its expression."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def top_level(text: Column) -> Column:
    """Top-level keys with their values as text (JSON text where nested); keys with JSON null are kept."""
    return F.from_json(text, "map<string,string>")

"""Document transforms on the columns of a node, in this order: replace, rename, concat."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, DoubleType, FloatType, NumericType, StringType

Fields = dict[str, tuple[Column, DataType]]


def inherited(parent: dict[str, Any], own: dict[str, Any], label: str) -> dict[str, Any]:
    """The transform of a child: its own, and what replace and rename of its parent say under its label."""
    out = dict(own)
    for kind, nested in (("replace", lambda v: any(isinstance(x, dict) for x in v.values())), ("rename", lambda v: True)):
        rules = (parent.get(kind) or {}).get(label)
        if isinstance(rules, dict) and nested(rules):
            out[kind] = rules | (own.get(kind) or {})
    return out


def replace(fields: Fields, rules: dict[str, dict[str, str]]) -> Fields:
    """Replaces substrings, one rule after another, in strings and lists of strings; other types stay."""
    out = dict(fields)
    for name, pairs in rules.items():
        if name not in out or any(isinstance(x, dict) for x in pairs.values()):  # rules of a child
            continue
        column, kind = out[name]

        def chained(c: Column) -> Column:
            for old, new in pairs.items():
                c = F.replace(c, F.lit(old), F.lit(new))
            return c

        if isinstance(kind, StringType):
            out[name] = (chained(column), kind)
        elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
            out[name] = (F.transform(column, chained), kind)
    return out


def rename(fields: Fields, names: dict[str, str]) -> Fields:
    return {names.get(k, k) if isinstance(names.get(k, k), str) else k: v for k, v in fields.items()}


def text_of(column: Column, kind: DataType) -> Column:
    """A value as text; null for what counts as absent: null, an empty string, zero and false."""
    if isinstance(kind, StringType):
        return F.when(column != "", column)
    if isinstance(kind, BooleanType):
        return F.when(column, F.lit("True"))
    if isinstance(kind, (DoubleType, FloatType)):
        whole = F.when(column == F.floor(column), F.concat(F.format_string("%.0f", column.cast("double")), F.lit(".0")))
        return F.when(column != 0, F.coalesce(whole, column.cast("string")))
    if isinstance(kind, (NumericType, DecimalType)):
        return F.when(column != 0, column.cast("string"))
    return column.cast("string")


def concat(fields: Fields, rules: dict[str, Any] | list[dict[str, Any]]) -> Fields:
    """Adds joined fields; a name that is no field is a literal; a later rule sees what earlier ones made."""
    out = dict(fields)
    for rule in rules if isinstance(rules, list) else [rules]:
        parts = [text_of(*out[c]) if c in out else F.lit(c or None).cast("string") for c in rule["columns"]]
        out[rule["destination"]] = (F.concat_ws(rule.get("delimiter", ""), *parts), StringType())
    return out


def apply(fields: Fields, transform: dict[str, Any]) -> Fields:
    fields = replace(fields, transform.get("replace") or {})
    fields = rename(fields, transform.get("rename") or {})
    return concat(fields, transform.get("concat") or [])

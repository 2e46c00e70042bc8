"""Columns by JSON path: `doc->'a'`, `doc->>'a'`, `doc#>'{a,b}'` and `doc#>>'{a,b}'`, quotes optional."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = re.compile(r"(->>|->|#>>|#>)")


def is_path(name: str) -> bool:
    return bool(_STEP.search(name))


def _steps(name: str) -> tuple[str, list[tuple[str, str]]]:
    parts = [p.strip().strip("'\"") for p in _STEP.split(name)]
    return parts[0], list(zip(parts[1::2], parts[2::2]))


def output_name(name: str) -> str:
    """The steps joined by _, without braces."""
    column, steps = _steps(name)
    return "_".join([column, *(s.strip("{}") for _, s in steps)])


def base_column(name: str) -> str:
    return _steps(name)[0]


def path_column(name: str) -> Column:
    """The value at the path as text; a step of digits is an index. -> and #> keep JSON, ->> and #>> unquote."""
    column, steps = _steps(name)
    path = "$"
    for op, step in steps:
        for token in step.strip("{}").split(",") if op[0] == "#" else [step]:
            token = token.strip()
            path += f"[{token}]" if token.isdigit() else f"['{token}']" if not re.fullmatch(r"\w+", token) else f".{token}"
    value = F.try_variant_get(F.try_parse_json(F.col(f"`{column}`")), path, "variant")
    text = F.try_variant_get(F.try_parse_json(F.col(f"`{column}`")), path, "string")
    return text if steps[-1][0].endswith(">>") else F.to_json(value)


def mysql_path(name: str) -> str:
    """The path in the form of JSON_EXTRACT: names in quotes, positions in brackets."""
    tokens = [t.strip() for op, step in _steps(name)[1] for t in (step.strip("{}").split(",") if op[0] == "#" else [step])]
    return "$" + "".join(f"[{t}]" if t.isdigit() else f'."{t}"' for t in tokens)


def mysql_column(name: str) -> Column:
    """JSON_EXTRACT of mysql_path, unquoted where the last step asks for text."""
    steps = _steps(name)[1]
    path = re.sub(r'\."([^"]*)"', r"['\1']", mysql_path(name))
    value = F.try_variant_get(F.try_parse_json(F.col(f"`{base_column(name)}`")), path, "variant")
    text = F.try_variant_get(F.try_parse_json(F.col(f"`{base_column(name)}`")), path, "string")
    return text if steps[-1][0].endswith(">>") else F.to_json(value)

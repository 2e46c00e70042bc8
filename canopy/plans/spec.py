"""The declared shape of documents: a tree of nodes, parsed from JSON and validated."""

from __future__ import annotations

import json
import os
import re
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

NODE_KEYS = {"base_tables", "children", "columns", "label", "primary_key", "relationship", "schema", "table", "transform"}
TYPES, VARIANTS = {"one_to_one", "one_to_many"}, {"object", "scalar"}


class SpecError(ValueError):
    """A schema that can't be compiled."""


@dataclass(frozen=True)
class Relationship:
    type: str
    variant: str = "object"
    through: str | None = None
    #: columns of the parent and of the child
    foreign_key: tuple[tuple[str, ...], tuple[str, ...]] | None = None


@dataclass(frozen=True)
class Node:
    table: str
    columns: tuple[str, ...] = ()
    label: str = ""
    relationship: Relationship | None = None
    children: tuple[Node, ...] = ()
    transform: dict[str, Any] = field(default_factory=dict, hash=False)
    primary_key: tuple[str, ...] = ()
    base_tables: tuple[str, ...] = ()

    def breadth_first(self) -> Iterator[Node]:
        queue = [self]
        while queue:
            node = queue.pop(0)
            yield node
            queue.extend(node.children)

    def post_order(self) -> Iterator[Node]:
        for c in self.children:
            yield from c.post_order()
        yield self

    def tables(self) -> set[str]:
        """All tables that documents draw on, join tables and bases of views included."""
        out: set[str] = set()
        for n in self.breadth_first():
            out |= {n.table, *n.base_tables}
            if n.relationship and n.relationship.through:
                out.add(n.relationship.through)
        return out

    def display(self, depth: int = 0) -> str:
        head = "  " * depth + f"{self.label}: {self.table}" + (f" ({self.relationship.type})" if self.relationship else "")
        return "\n".join([head, *(c.display(depth + 1) for c in self.children)])


@dataclass(frozen=True)
class DocSpec:
    index: str
    root: Node
    routing: str | None = None
    pipeline: str | None = None
    plugins: tuple[str, ...] = ()
    setting: dict[str, Any] = field(default_factory=dict, hash=False)
    mapping: dict[str, Any] = field(default_factory=dict, hash=False)


def _columns(x: Any) -> tuple[str, ...]:
    return (x,) if isinstance(x, str) else tuple(x or ())


def _relationship(raw: dict[str, Any], table: str) -> Relationship:
    if unknown := set(raw) - {"type", "variant", "through_tables", "foreign_key"}:
        raise SpecError(f"{table}: unknown relationship attributes {sorted(unknown)}")
    if raw.get("type") not in TYPES:
        raise SpecError(f"{table}: relationship type must be one of {sorted(TYPES)}")
    if raw.get("variant", "object") not in VARIANTS:
        raise SpecError(f"{table}: relationship variant must be one of {sorted(VARIANTS)}")
    through = raw.get("through_tables") or []
    if len(through) > 1:
        raise SpecError(f"{table}: more than one join table")
    key = raw.get("foreign_key")
    if key is not None and (set(key) != {"parent", "child"} or len(_columns(key["parent"])) != len(_columns(key["child"]))):
        raise SpecError(f"{table}: a foreign_key needs as many columns of the parent as of the child")
    pair = (_columns(key["parent"]), _columns(key["child"])) if key else None
    return Relationship(raw["type"], raw.get("variant", "object"), through[0] if through else None, pair)


def parse_node(raw: dict[str, Any], root: bool = True) -> Node:
    if not isinstance(raw, dict):
        raise SpecError("nodes must be one object, not a list")
    if not raw.get("table"):
        raise SpecError("a node needs a table")
    if unknown := set(raw) - NODE_KEYS:
        raise SpecError(f"{raw['table']}: unknown attributes {sorted(unknown)}")
    rel = raw.get("relationship")
    if not root and not rel:
        raise SpecError(f"{raw['table']}: a child needs a relationship")
    return Node(
        raw["table"],
        _columns(raw.get("columns")),
        raw.get("label") or raw["table"],
        _relationship(rel, raw["table"]) if rel else None,
        tuple(parse_node(c, False) for c in raw.get("children") or ()),
        raw.get("transform") or {},
        _columns(raw.get("primary_key")),
        _columns(raw.get("base_tables")),
    )


def parse(raw: dict[str, Any]) -> DocSpec:
    if "nodes" not in raw:
        raise SpecError("a document needs nodes")
    root = parse_node(raw["nodes"])
    index = raw.get("index") or raw.get("database") or root.table
    return DocSpec(index, root, raw.get("routing"), raw.get("pipeline"), tuple(raw.get("plugins") or ()), raw.get("setting") or {}, raw.get("mapping") or {})


def read_source(path: str | None = None, url: str | None = None, s3: str | None = None) -> str:
    """The text of a configuration from exactly one of a local file, an http(s) address and an object in S3."""
    given = [x for x in (path, url, s3) if x]
    if len(given) != 1:
        raise SpecError("give exactly one of a path, a URL and an S3 address")
    if url:
        if not re.match(r"https?://", url):
            raise SpecError(f"{url} is not http(s)")
        with urllib.request.urlopen(url, timeout=30) as answer:
            return answer.read().decode()
    if s3:
        bucket, _, key = s3.removeprefix("s3://").partition("/")
        if not s3.startswith("s3://") or not key:
            raise SpecError(f"{s3} names no object")
        try:
            import boto3
        except ImportError as error:
            raise SpecError("reading from S3 needs boto3") from error
        return boto3.client("s3").get_object(Bucket=bucket, Key=key)["Body"].read().decode()
    with open(path) as f:
        return f.read()


def load(path: str | None = None, environment: dict[str, str] | None = None, url: str | None = None, s3: str | None = None) -> list[DocSpec]:
    """The documents of a JSON list; top-level strings have $names replaced from the environment."""
    env = os.environ if environment is None else environment
    docs = json.loads(read_source(path, url, s3))
    if not isinstance(docs, list):
        raise SpecError("a configuration is a list of documents")

    def fill(x: Any) -> Any:
        return re.sub(r"\$(\w+)", lambda m: env.get(m[1], m[0]), x) if isinstance(x, str) else x

    return [parse({k: fill(v) for k, v in d.items()}) for d in docs]


def identifier(*parts: str) -> str:
    """A name of letters, digits and _ alone, as for cursors and indices: all else is left out."""
    return re.sub(r"[^0-9a-zA-Z_]+", "", "_".join(parts).lower())


def quoted(name: str, dialect: str = "ansi") -> str:
    mark = "`" if dialect in ("spark", "mysql") else '"'
    return mark + name.replace(mark, 2 * mark) + mark

"""From a tree of nodes to one plan: each child is aggregated on its link before it joins its parent."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType

from canopy.functions import jsonpath, transforms
from canopy.plans.catalog import Catalog
from canopy.plans.spec import DocSpec, Node, SpecError

KEY = "struct<table:string,key:string,value:string>"


@dataclass
class Built:
    df: DataFrame  # own columns, __doc, __keys
    primary_key: tuple[str, ...]


def orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(orderable(f.dataType) for f in kind)
    return orderable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def tuple_key(names: tuple[str, ...] | list[str]) -> str:
    """The name under which the values of several key columns are kept as one."""
    return ",".join(sorted(names))


def tuple_value(values: list[Column]) -> Column:
    """The values of several key columns, in order of their names, as one text; null if one of them is."""
    return F.when(~F.exists(F.array(*values), lambda v: v.isNull()), F.to_json(F.array(*values)))


def keys_column(table: str, names: tuple[str, ...], primary_key: tuple[str, ...] = ()) -> Column:
    """The lineage of a row: each key column, and a primary key of several columns as a whole."""
    text = lambda n: F.col(f"`{n}`").cast("string")
    pairs = [(n, text(n)) for n in names]
    if len(primary_key) > 1:
        pairs.append((tuple_key(primary_key), tuple_value([text(n) for n in sorted(primary_key)])))
    rows = [F.struct(F.lit(table).alias("table"), F.lit(n).alias("key"), v.alias("value")) for n, v in pairs]
    return F.filter(F.array(*rows), lambda k: k["value"].isNotNull()) if rows else F.array().cast(f"array<{KEY}>")


def _merged(columns: list[str]) -> Column:
    return F.concat(*[F.coalesce(F.col(c), F.array().cast(f"array<{KEY}>")) for c in columns])


def build(node: Node, catalog: Catalog, only: tuple[DataFrame, tuple[str, ...], tuple[str, ...]] | None = None, where: Column | None = None, filters: dict[str, Column | str] | None = None) -> Built:
    """The rows of a node with its document; only: (keys, their columns, own columns) to restrict to, before any join;
    filters: conditions on the rows of child nodes, by label."""
    table = catalog[node.table]
    df = table.load()
    if where is not None:
        df = df.where(where)
    if only is not None:
        keys, theirs, own = only
        keys = keys.select(*[F.col(f"`{t}`").alias(f"__only{i}") for i, t in enumerate(theirs)]).distinct()
        on = [df[o] == keys[f"__only{i}"] for i, o in enumerate(own)]
        # the keys are few or many: their size at run time decides how they are joined
        df = df.join(keys, on, "left_semi")
    pk = node.primary_key or table.primary_key
    kinds = {f.name: f.dataType for f in df.schema}
    fields: transforms.Fields = {}
    for c in node.columns or df.columns:
        if jsonpath.is_path(c):
            if jsonpath.base_column(c) not in kinds:
                raise SpecError(f"{node.table}: unknown column {c}")
            fields[jsonpath.output_name(c)] = (jsonpath.path_column(c), StringType())
        elif c not in kinds:
            raise SpecError(f"{node.table}: unknown column {c}")
        else:
            fields[c] = (F.col(f"`{c}`"), kinds[c])
    lineage = ["__own"]
    df = df.withColumn("__own", keys_column(node.table, tuple(sorted(pk)), tuple(pk)))
    for i, child in enumerate(node.children):
        child = replace(child, transform=transforms.inherited(node.transform, child.transform, child.label))
        df, kind = _with_child(df, node, child, catalog, i, only is not None, filters or {})
        fields.pop(child.label, None)
        fields[child.label] = (F.col(f"__c{i}"), kind)
        lineage.append(f"__k{i}")
    shaped = transforms.apply(fields, node.transform)
    doc = F.struct(*[c.alias(n) for n, (c, _) in shaped.items()])
    df = df.withColumns({"__doc": doc, "__keys": _merged(lineage)})
    return Built(df.drop(*lineage, *[f"__c{i}" for i in range(len(node.children))]), pk)


def _value(child: Node, first_only: bool = False) -> Column:
    """What the parent gets of a child's row."""
    if child.relationship.variant == "scalar":
        name = child.columns[0] if child.columns else None
        if name is None:
            raise SpecError(f"{child.table}: a scalar needs a column")
        return F.col("__doc")[(child.transform.get("rename") or {}).get(name, jsonpath.output_name(name))]
    if first_only and child.columns:
        name = jsonpath.output_name(child.columns[0])
        return F.struct(F.col("__doc")[name].alias(name))
    return F.col("__doc")


def _with_child(df: DataFrame, parent: Node, child: Node, catalog: Catalog, i: int, restricted: bool, filters: dict):
    rel = child.relationship
    if rel.through:
        grouped, theirs = _through(df, parent, child, catalog, restricted, filters)
        on = catalog.edge(parent.table, rel.through)[0]
    else:
        on, theirs = rel.foreign_key or catalog.edge(parent.table, child.table)
        built = build(child, catalog, (df, on, theirs) if restricted else None, _condition(child, filters), filters)
        picked = built.df.select(*[F.col(f"`{c}`").alias(f"__l{n}") for n, c in enumerate(theirs)], _order(built).alias("__o"), _value(child).alias("__v"), "__keys")
        links = [f"__l{n}" for n in range(len(theirs))]
        picked = picked.where(" and ".join(f"{c} is not null" for c in links))
        if rel.type == "one_to_many":
            grouped = _collected(picked, links)
        elif tuple(sorted(theirs)) == tuple(sorted(built.primary_key)):
            grouped = picked.drop("__o")
        else:  # of several rows the one of the least key
            grouped = picked.groupBy(*links).agg(F.min_by("__v", "__o").alias("__v"), F.min_by("__keys", "__o").alias("__keys"))
    renamed = grouped.select(*[F.col(f"__l{n}").alias(f"__j{n}") for n in range(len(on))], F.col("__v").alias(f"__c{i}"), F.col("__keys").alias(f"__k{i}"))
    kind = renamed.schema[f"__c{i}"].dataType
    joined = df.join(renamed, [df[c] == renamed[f"__j{n}"] for n, c in enumerate(on)], "left")
    return joined.drop(*[f"__j{n}" for n in range(len(on))]), kind


def _order(built: Built) -> Column:
    """What rows of a child are sorted by: its key, or without one its document."""
    return F.struct(*[F.col(f"`{c}`") for c in built.primary_key]) if built.primary_key else F.to_json("__doc")


def _condition(child: Node, filters: dict[str, Column | str]) -> Column | None:
    found = filters.get(child.label)
    return F.expr(found) if isinstance(found, str) else found


def _collected(picked: DataFrame, links: list[str]) -> DataFrame:
    """Values (nulls stay, as they are wrapped) in order, and the keys of all rows, in no order.

    They are collected apart, so a plan that doesn't ask for the keys neither makes nor shuffles them.
    """
    if orderable(picked.schema["__v"].dataType) and orderable(picked.schema["__o"].dataType):
        rows = F.sort_array(F.collect_list(F.struct("__o", F.struct("__v").alias("__w"))))
    else:
        rows = F.array_sort(F.collect_list(F.struct("__o", F.to_json(F.struct("__v")).alias("__t"), F.struct("__v").alias("__w"))), _by_order)
    got = picked.groupBy(*links).agg(rows.alias("__r"), F.flatten(F.collect_list("__keys")).alias("__keys"))
    return got.select(*links, F.transform("__r", lambda r: r["__w"]["__v"]).alias("__v"), "__keys")


def _by_order(a: Column, b: Column) -> Column:
    x, y = F.struct(a["__o"], a["__t"]), F.struct(b["__o"], b["__t"])
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def _through(df: DataFrame, parent: Node, child: Node, catalog: Catalog, restricted: bool, filters: dict):
    rel = child.relationship
    up, down = catalog.edge(parent.table, rel.through)
    left, right = rel.foreign_key or catalog.edge(rel.through, child.table)
    through = catalog[rel.through]
    rows = through.load()
    if restricted:
        keys = df.select(*[F.col(f"`{c}`").alias(f"__u{n}") for n, c in enumerate(up)]).distinct()
        rows = rows.join(keys, [rows[d] == keys[f"__u{n}"] for n, d in enumerate(down)], "left_semi")
    own = tuple(dict.fromkeys([*sorted(through.primary_key), *down, *left]))
    rows = rows.select(*[F.col(f"`{c}`").alias(f"__l{n}") for n, c in enumerate(down)], *[F.col(f"`{c}`").alias(f"__r{n}") for n, c in enumerate(left)], keys_column(rel.through, own, tuple(through.primary_key)).alias("__own"))
    condition = _condition(child, filters)
    built = build(child, catalog, (rows, tuple(f"__r{n}" for n in range(len(left))), right) if restricted else None, condition, filters)
    first_only = rel.type == "one_to_one" and rel.variant == "object" and not child.children
    picked = built.df.select(*[F.col(f"`{c}`").alias(f"__s{n}") for n, c in enumerate(right)], _order(built).alias("__o"), _value(child, first_only).alias("__v"), F.col("__keys").alias("__ck"))
    # a filter of the node drops the link with it
    joined = rows.join(picked, [rows[f"__r{n}"] == picked[f"__s{n}"] for n in range(len(left))], "left" if condition is None else "inner")
    joined = joined.withColumn("__keys", _merged(["__own", "__ck"]))
    links = [f"__l{n}" for n in range(len(down))]
    return _collected(joined.where(" and ".join(f"{c} is not null" for c in links)).select(*links, "__o", "__v", "__keys"), links), down


def compile(
    spec: DocSpec, catalog: Catalog, root_keys: DataFrame | None = None, where: Column | None = None, tx: tuple[str, int | None, int | None] | None = None,
    filters: dict[str, Column | str] | None = None, xid: str | None = None,
) -> DataFrame:
    """(_id, _key, _index, _source, _keys[, _routing, pipeline, _txid]); _key has the root's key values as text.

    root_keys: only documents of these primary keys, which are passed down to every child before it is aggregated.
    tx: (column, from, below) restricts root rows to transactions; 0 is a bound like others. filters: conditions on the
    rows of child nodes, by label. xid: the root's column of the transaction that wrote the row, given as _txid.
    """
    root, table = spec.root, catalog[spec.root.table]
    pk = tuple(sorted(root.primary_key or table.primary_key))
    if not pk:
        raise SpecError(f"{root.table}: the root needs a primary key")
    if tx is not None:
        column, low, high = tx
        for bound, test in ((low, lambda c: c >= low), (high, lambda c: c < high)):
            if bound is not None:
                where = test(F.col(column)) if where is None else where & test(F.col(column))
    built = build(root, catalog, (root_keys, pk, pk) if root_keys is not None else None, where, filters)
    out = [
        F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in pk]).alias("_id"),
        F.array(*[F.col(f"`{c}`").cast("string") for c in pk]).alias("_key"),
        F.lit(spec.index).alias("_index"),
        F.col("__doc").alias("_source"),
        F.array_sort(F.array_distinct("__keys")).alias("_keys"),
    ]
    if spec.routing:
        out.append(F.col("__doc")[spec.routing].cast("string").alias("_routing"))
    if spec.pipeline:
        out.append(F.lit(spec.pipeline).alias("pipeline"))
    if xid:
        out.append(F.col(f"`{xid}`").cast("string").cast("long").alias("_txid"))
    return built.df.select(*out)


def meta(spec: DocSpec, catalog: Catalog, keys: str = "_keys") -> Column:
    """_meta of a document: {table: {key: sorted distinct values}} of the tables it draws on."""
    names: dict[str, list[str]] = {}
    for n in spec.root.breadth_first():
        names.setdefault(n.table, []).extend(sorted(n.primary_key or catalog[n.table].primary_key))
        if n.relationship and n.relationship.through:
            t = catalog[n.relationship.through]
            names.setdefault(t.name, []).extend([*sorted(t.primary_key), *(c for f in t.foreign_keys for c in f.columns)])

    def values(t: str, k: str) -> Column:
        return F.transform(F.filter(F.col(keys), lambda x: (x["table"] == t) & (x["key"] == k)), lambda x: x["value"]).alias(k)

    return F.struct(*[F.struct(*[values(t, k) for k in dict.fromkeys(ks)]).alias(t) for t, ks in names.items() if ks])


def as_json(df: DataFrame) -> DataFrame:
    """_source as JSON text, null fields kept."""
    if isinstance(df.schema["_source"].dataType, StructType):
        df = df.withColumn("_source", F.to_json("_source", {"ignoreNullFields": "false"}))
    return df


def doc_keys(documents: DataFrame) -> DataFrame:
    """(table, key, value, _id, _key): which documents hold which row, as an index for later changes."""
    return documents.select("_id", "_key", F.explode("_keys").alias("k")).select("k.table", "k.key", "k.value", "_id", "_key")

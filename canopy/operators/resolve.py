"""Which documents a batch of changes touches, by joins on exact key columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.operators.changes import OPS, data
from canopy.plans.catalog import Catalog
from canopy.plans.compile import tuple_key, tuple_value
from canopy.plans.spec import DocSpec


def _identity(parts: list[Column]) -> list[Column]:
    """(_id, _key) of a document from its key values; the _id is null if any of them is."""
    there = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return [F.when(there, F.concat_ws("|", *parts)).alias("_id"), F.array(*parts).alias("_key")]


def document_id(row: str, keys: tuple[str, ...]) -> list[Column]:
    return _identity([F.col(row)[k] for k in sorted(keys)])


def validate(events: DataFrame, spec: DocSpec, catalog: Catalog) -> None:
    """An unknown operation, or a root event without its primary key, is an error."""
    if bad := events.where(~F.col("op").isin(*OPS)).first():
        raise ValueError(f"unknown operation {bad['op']}")
    pk = spec.root.primary_key or catalog[spec.root.table].primary_key
    row = data()
    lacking = reduce(lambda a, b: a | b, [row[k].isNull() for k in pk])
    if events.where((F.col("table") == spec.root.table) & (F.col("op") != "TRUNCATE") & lacking).first():
        raise ValueError(f"an event of {spec.root.table} lacks its primary key")


def resolve(events: DataFrame, spec: DocSpec, catalog: Catalog, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((_id, _key) to delete, those to compute again); keys: (table, key, value, _id, _key) of the documents so far.

    A key of several columns is looked up as a whole.

    Inserted, changed and deleted children lead to the documents that hold them, to those that hold the rows which
    their old and new foreign keys name, and, where they name a root, straight to it. A document that is deleted and
    then comes again in the batch is in both: deletions are to be applied first.
    """
    root = spec.root
    pk = tuple(sorted(root.primary_key or catalog[root.table].primary_key))
    own = events.where(F.col("table") == root.table)
    new_id, old_id = document_id("new", pk), document_id("old", pk)
    upserts = [own.where("op in ('INSERT', 'UPDATE')").select(*new_id)]
    moved = own.where("op = 'UPDATE'").where(old_id[0] != new_id[0])
    deletes = [own.where("op = 'DELETE'").select(*_identity([data()[k] for k in pk])), moved.select(*old_id)]
    # truncated tables are few
    cleared = {r["table"] for r in events.where("op = 'TRUNCATE'").select("table").distinct().collect()}
    everything = keys.select("_id", "_key").distinct()
    if root.table in cleared:
        deletes.append(everything)
    if cleared & (spec.root.tables() - {root.table}):
        upserts.append(everything)
    wanted: list[DataFrame] = []
    for name in sorted(spec.root.tables() - {root.table}):
        if name not in catalog.tables:
            continue
        table = catalog[name]
        mine = events.where((F.col("table") == name) & (F.col("op") != "TRUNCATE"))
        for image in ("new", "old"):
            there = mine.where(F.col(image).isNotNull())
            wanted += _asked(there, image, name, {k: k for k in table.primary_key}, table.primary_key)
            for fk in table.foreign_keys:
                at = dict(zip(fk.references, fk.columns))
                wanted += _asked(there, image, fk.table, at, catalog[fk.table].primary_key if fk.table in catalog.tables else ())
                if fk.table == root.table and tuple(sorted(fk.references)) == pk:
                    upserts.append(there.select(*_identity([F.col(image)[at[k]] for k in pk])))
    if wanted:
        asked = reduce(DataFrame.unionByName, wanted).where("value is not null").distinct()
        upserts.append(keys.join(asked, ["table", "key", "value"], "left_semi").select("_id", "_key"))
    union = lambda frames: reduce(DataFrame.unionByName, frames).where("_id is not null").distinct()
    return union(deletes), union(upserts)


def _asked(events: DataFrame, image: str, table: str, at: dict[str, str], primary_key: tuple[str, ...]) -> list[DataFrame]:
    """(table, key, value) to look up: at names the column of the event for each key column. A whole primary key of
    several columns is one entry; of any other combination each column is asked for, which finds what it must and more."""
    if len(at) > 1 and set(at) == set(primary_key):
        pairs = [(tuple_key(tuple(at)), tuple_value([F.col(image)[at[k]] for k in sorted(at)]))]
    else:
        pairs = [(k, F.col(image)[c]) for k, c in at.items()]
    return [events.select(F.lit(table).alias("table"), F.lit(k).alias("key"), v.alias("value")) for k, v in pairs]


def root_keys(ids: DataFrame, spec: DocSpec, catalog: Catalog) -> DataFrame:
    """The primary keys of roots from _key, with the types of the table."""
    table = catalog[spec.root.table]
    pk = sorted(spec.root.primary_key or table.primary_key)
    kinds = {f.name: f.dataType for f in table.load().schema}
    return ids.select(*[F.col("_key")[i].cast(kinds[k]).alias(k) for i, k in enumerate(pk)])

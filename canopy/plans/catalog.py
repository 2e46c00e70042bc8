"""Tables with declared keys: Parquet has none, so a catalog names primary keys and foreign-key edges."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    table: str
    references: tuple[str, ...]


@dataclass(frozen=True)
class TableDef:
    name: str
    load: Callable[[], DataFrame]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    #: tables that a view is made of; changes to them count as changes of the view
    base_tables: tuple[str, ...] = ()


@dataclass
class Catalog:
    tables: dict[str, TableDef] = field(default_factory=dict)

    def add(self, table: TableDef) -> None:
        self.tables[table.name] = table

    def __getitem__(self, name: str) -> TableDef:
        if name not in self.tables:
            raise KeyError(f"unknown table {name}")
        return self.tables[name]

    def edge(self, parent: str, child: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """(columns of parent, columns of child) that link them, whichever side declares the key."""
        for fk in self[child].foreign_keys:
            if fk.table == parent:
                return fk.references, fk.columns
        for fk in self[parent].foreign_keys:
            if fk.table == child:
                return fk.columns, fk.references
        raise ValueError(f"no foreign key between {parent} and {child}")

    def view_of(self, base_table: str) -> list[str]:
        return [t.name for t in self.tables.values() if base_table in t.base_tables]

    def key_view(self, spark: SparkSession) -> DataFrame:
        """(table_name, primary_keys, foreign_keys, columns) of every table."""
        constraints = self.constraints(spark)
        keys = constraints.groupBy("table_name").agg(
            F.sort_array(F.collect_set(F.when(F.col("kind") == "primary", F.col("column_name")))).alias("primary_keys"),
            F.sort_array(F.collect_set(F.when(F.col("kind") == "foreign", F.col("column_name")))).alias("foreign_keys"),
        )
        columns = self.columns(spark).groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct("place", "column_name"))).alias("c"))
        none = F.array().cast("array<string>")
        return columns.join(keys, "table_name", "left").select(
            "table_name", F.coalesce("primary_keys", none).alias("primary_keys"), F.coalesce("foreign_keys", none).alias("foreign_keys"), F.col("c.column_name").alias("columns")
        )

    def columns(self, spark: SparkSession) -> DataFrame:
        """(table_name, place, column_name, type) of every column."""
        rows = [(t.name, i, f.name, f.dataType.simpleString()) for t in self.tables.values() for i, f in enumerate(t.load().schema)]
        return spark.createDataFrame(rows, "table_name string, place int, column_name string, type string")

    def constraints(self, spark: SparkSession) -> DataFrame:
        """(table_name, kind, column_name) of every column of a key."""
        rows = [(t.name, "primary", c) for t in self.tables.values() for c in t.primary_key]
        rows += [(t.name, "foreign", c) for t in self.tables.values() for f in t.foreign_keys for c in f.columns]
        return spark.createDataFrame(rows, "table_name string, kind string, column_name string")


def united(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two key views as one: of each table the union of its keys; its columns are those of new, if it has any."""
    both = old.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    sets = [F.sort_array(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("primary_keys", "foreign_keys")]
    return both.groupBy("table_name").agg(*sets, F.max_by("columns", "age").alias("columns"))


_KEYS: dict[str, tuple[tuple[str, ...], tuple[ForeignKey, ...]]] = {
    "region": (("r_regionkey",), ()),
    "nation": (("n_nationkey",), (ForeignKey(("n_regionkey",), "region", ("r_regionkey",)),)),
    "customer": (("c_custkey",), (ForeignKey(("c_nationkey",), "nation", ("n_nationkey",)),)),
    "supplier": (("s_suppkey",), (ForeignKey(("s_nationkey",), "nation", ("n_nationkey",)),)),
    "part": (("p_partkey",), ()),
    "orders": (("o_orderkey",), (ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)),
    "lineitem": (
        (),
        (
            ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
            ForeignKey(("l_partkey",), "part", ("p_partkey",)),
            ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",)),
        ),
    ),
    "events": (("event_id",), ()),
    "documents": (("doc_id",), ()),
    "labels": (("doc_id",), (ForeignKey(("doc_id",), "documents", ("doc_id",)),)),
    "conversations": (("conv_id", "turn"), ()),
    "embeddings": (("vec_id",), ()),
    "pages": (("page_id",), ()),
    "benchmark": (("item_id",), ()),
}


def of_folder(spark: SparkSession, sf_dir: str) -> Catalog:
    """The catalog of a folder of Parquet tables."""
    out = Catalog()
    for name, (pk, fks) in _KEYS.items():
        out.add(TableDef(name, lambda n=name: spark.read.parquet(f"{sf_dir}/{n}.parquet"), pk, fks))
    return out

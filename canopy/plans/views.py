"""Views as tables of a catalog: plain ones are SQL, materialized ones files that a refresh replaces."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from canopy.plans.catalog import Catalog, TableDef


class View:
    """A named query over tables of a catalog; changes to its base tables count as changes of it.

    path: where a materialized view's versions lie; without it the query runs each time.
    """

    def __init__(self, spark: SparkSession, catalog: Catalog, name: str, sql: str, bases: tuple[str, ...], primary_key: tuple[str, ...], path: str | None = None) -> None:
        self.spark, self.catalog, self.name, self.sql, self.bases, self.path = spark, catalog, name, sql, bases, path
        self.version: str | None = None
        catalog.add(TableDef(name, self.load, primary_key, (), bases))
        if path:
            self.refresh()

    def _now(self) -> DataFrame:
        return self.spark.sql(self.sql, **{b: self.catalog[b].load() for b in self.bases})

    def load(self) -> DataFrame:
        return self.spark.read.parquet(self.version) if self.version else self._now()

    def refresh(self) -> None:
        """Computes a materialized view anew; readers of the old version keep it."""
        if self.path:
            at = f"{self.path}/{uuid.uuid4().hex}"
            self._now().write.parquet(at)
            self.version = at

    def register(self) -> None:
        """Makes it a view of the session, for SQL."""
        self.load().createOrReplaceTempView(self.name)

    def drop(self) -> None:
        self.spark.catalog.dropTempView(self.name)
        self.catalog.tables.pop(self.name, None)

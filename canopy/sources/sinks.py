"""Sinks take index and delete actions; writing the same batch again changes nothing."""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from canopy.plans.compile import as_json
from canopy.plans.spec import DocSpec, Node, SpecError

INDEX_TYPES = set(
    "boolean byte short integer long half_float float double scaled_float date keyword text constant_keyword ip completion search_as_you_type "
    "binary object nested flattened dense_vector knn_vector geo_point geo_shape shape null time integer_range float_range long_range double_range date_range ip_range "
    "interval_year interval_month interval_day interval_hour interval_minute interval_second interval_year_to_month interval_day_to_hour interval_day_to_minute "
    "interval_day_to_second interval_hour_to_minute interval_hour_to_second interval_minute_to_second".split()
)


PARAMETERS = set(
    "analyzer boost coerce copy_to doc_values dynamic eager_global_ordinals enabled fielddata fields format ignore_above ignore_malformed index_options "
    "index_phrases index_prefixes index meta normalizer norms null_value position_increment_gap properties search_analyzer similarity store term_vector type dims scaling_factor".split()
)


def mapping(node: Node) -> dict[str, Any]:
    """The index mapping of a tree, from transform.mapping of its nodes, nested under their labels."""
    out: dict[str, Any] = {}
    for column, rule in (node.transform.get("mapping") or {}).items():
        if rule.get("type") not in INDEX_TYPES:
            raise SpecError(f"{node.table}.{column}: unknown type {rule.get('type')}")
        if unknown := set(rule) - PARAMETERS:
            raise SpecError(f"{node.table}.{column}: unknown parameters {sorted(unknown)}")
        out[column] = dict(rule)
    for child in node.children:
        if inner := mapping(child):
            out[child.label] = {"properties": inner}
    return out


def actions(upserts: DataFrame, deletes: DataFrame, major: int = 8) -> DataFrame:
    """(_op_type, _id, _index, _routing, pipeline, _source[, _type]) of both; what documents lack is null.

    Servers before major version 7 want a _type.
    """
    rows = as_json(upserts)
    names = ["_index", "_routing", "pipeline", "_source"]
    part = lambda df, op: df.select(F.lit(op).alias("_op_type"), "_id", *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in names])
    out = part(deletes, "delete").unionByName(part(rows, "index"))
    return out.withColumn("_type", F.lit("_doc")) if major < 7 else out


class Sink(ABC):
    """Where documents go. doc_count is how many upserts and deletions were written.

    extra_setting and extra_mapping are merged into what create() makes of a specification.
    """

    doc_count = 0

    def __init__(self, extra_setting: dict[str, Any] | None = None, extra_mapping: dict[str, Any] | None = None) -> None:
        self.extra_setting, self.extra_mapping = extra_setting or {}, extra_mapping or {}

    def create(self, spec: DocSpec) -> dict[str, Any]:
        """Settings and mapping of the index, made if it is missing."""
        body = {"properties": mapping(spec.root) | self.extra_mapping}
        return {"settings": spec.setting | self.extra_setting, "mappings": spec.mapping or body, "routing_required": bool(spec.routing)}

    @abstractmethod
    def bulk(self, upserts: DataFrame, deletes: DataFrame) -> None:
        """Deletes _ids, then puts documents in place of those of the same _id, whatever their routing."""

    def manifest(self) -> Any:
        """What a later run needs to go on, as JSON."""
        return {"doc_count": self.doc_count}

    def restore(self, manifest: Any) -> None:
        self.doc_count = manifest["doc_count"]

    def refresh(self) -> None: ...

    def teardown(self) -> None: ...


class MemorySink(Sink):
    """For tests and notebooks: documents in a dictionary on the driver."""

    def __init__(self, **extra) -> None:
        super().__init__(**extra)
        self.documents: dict[str, str] = {}
        self.routing: dict[str, str] = {}

    def bulk(self, upserts: DataFrame, deletes: DataFrame) -> None:
        for r in actions(upserts, deletes).toLocalIterator():
            self.documents.pop(r["_id"], None)
            if r["_op_type"] == "index":
                self.documents[r["_id"]], self.routing[r["_id"]] = r["_source"], r["_routing"]
            self.doc_count += 1

    def teardown(self) -> None:
        self.documents.clear()


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class JsonLinesSink(Sink):
    """Appends actions as JSON lines, a folder for each batch; nulls are left out of a line."""

    def __init__(self, path: str, **extra) -> None:
        super().__init__(**extra)
        self.path = path
        self._spark: SparkSession | None = None

    def bulk(self, upserts: DataFrame, deletes: DataFrame) -> None:
        seen, self._spark = Observation(), upserts.sparkSession
        actions(upserts, deletes).observe(seen, F.count(F.lit(1)).alias("n")).write.json(f"{self.path}/{uuid.uuid4().hex}")
        self.doc_count += seen.get["n"]

    def teardown(self) -> None:
        if self._spark:
            _remove(self._spark, self.path)


class ParquetSink(Sink):
    """A table of documents, in BUCKETS folders by hash of _id: a batch rewrites only the folders it touches."""

    BUCKETS = 64

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: int = BUCKETS, **extra) -> None:
        super().__init__(**extra)
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets
        self._version: dict[int, str] = {}

    def _bucket(self):
        return F.pmod(F.xxhash64("_id"), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        if not self._version:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*self._version.values())

    def bulk(self, upserts: DataFrame, deletes: DataFrame) -> None:
        ids = deletes.select("_id").unionByName(upserts.select("_id")).distinct()
        hit = [r[0] for r in ids.select(self._bucket()).distinct().collect()]
        old = [self._version[b] for b in hit if b in self._version]
        rows = upserts.select(*self.schema.fieldNames())
        if old:
            rows = self.spark.read.schema(self.schema).parquet(*old).join(ids, "_id", "left_anti").select(*rows.columns).unionByName(rows)
        at = f"{self.path}/{uuid.uuid4().hex}"
        self.doc_count += upserts.count() + deletes.count()
        rows.withColumn("__b", self._bucket()).repartition("__b").write.partitionBy("__b").parquet(at)
        made = {r["__b"] for r in self.spark.read.parquet(at).select("__b").distinct().collect()} if rows.head(1) else set()
        for b in hit:
            self._version.pop(b, None)
            if b in made:
                self._version[b] = f"{at}/__b={b}"

    def manifest(self) -> Any:
        return super().manifest() | {"folders": {str(b): at for b, at in self._version.items()}}

    def restore(self, manifest: Any) -> None:
        super().restore(manifest)
        self._version = {int(b): at for b, at in manifest["folders"].items()}

    def teardown(self) -> None:
        self._version = {}
        _remove(self.spark, self.path)

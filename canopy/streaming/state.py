"""What must outlive a run: a JSON state file, and the index of which documents hold which rows."""

from __future__ import annotations

import json
import uuid
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = "table string, key string, value string, _id string, _key array<string>, version long"
TOUCHED = "_id string, until long"


class StateFile:
    """A JSON object in one file of any file system that Spark reaches; a new version takes the old one's place whole."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _at(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def load(self) -> dict[str, Any]:
        """The saved object, or one without fields; a file that can't be read as JSON is an error."""
        fs, at = self._at(self.path)
        if not fs.exists(at):
            return {}
        text = "".join(r[0] for r in self.spark.read.text(self.path, wholetext=True).collect())
        try:
            found = json.loads(text)
        except ValueError as error:
            raise ValueError(f"{self.path} is corrupt") from error
        if not isinstance(found, dict):
            raise ValueError(f"{self.path} is corrupt")
        return found

    def save(self, value: dict[str, Any]) -> None:
        if value is None:
            raise ValueError("nothing to save")
        fs, new = self._at(f"{self.path}.{uuid.uuid4().hex}")
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        _, at = self._at(self.path)
        fs.delete(at, False)
        if not fs.rename(new, at):
            raise OSError(f"{self.path} can't be written")

    def delete(self) -> None:
        fs, at = self._at(self.path)
        fs.delete(at, True)


class KeyIndex:
    """(table, key, value, _id, _key) of documents, as files that are only added to.

    A batch adds the keys of the documents it computed and the _ids it touched: what older files say of these no longer
    counts. So a batch writes in proportion to itself; after COMPACT batches the files are made one again.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, path: str, manifest: dict[str, Any] | None = None) -> None:
        self.spark, self.path = spark, path
        self.manifest = manifest or {"version": 0, "keys": [], "touched": []}

    def _write(self, df: DataFrame, name: str) -> str:
        at = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(at)
        return at

    def read(self) -> DataFrame:
        m = self.manifest
        if not m["keys"]:
            return self.spark.createDataFrame([], KEYS).drop("version")
        keys = self.spark.read.schema(KEYS).parquet(*m["keys"])
        if m["touched"]:
            until = self.spark.read.schema(TOUCHED).parquet(*m["touched"]).groupBy("_id").agg(F.max("until").alias("until"))
            keys = keys.join(until, "_id", "left").where("until is null or version >= until")
        return keys.select("table", "key", "value", "_id", "_key")

    def replace(self, keys: DataFrame) -> None:
        version = self.manifest["version"] + 1
        at = self._write(keys.withColumn("version", F.lit(version).cast("long")).sortWithinPartitions("table", "key", "value"), "keys")
        self.manifest = {"version": version, "keys": [at], "touched": []}

    def update(self, touched: DataFrame, keys: DataFrame) -> None:
        m = self.manifest
        version = m["version"] + 1
        gone = self._write(touched.select("_id", F.lit(version).cast("long").alias("until")), "touched")
        new = self._write(keys.withColumn("version", F.lit(version).cast("long")).sortWithinPartitions("table", "key", "value"), "keys")
        self.manifest = {"version": version, "keys": [*m["keys"], new], "touched": [*m["touched"], gone]}
        if len(self.manifest["keys"]) > self.COMPACT:
            self.replace(self.read())


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)

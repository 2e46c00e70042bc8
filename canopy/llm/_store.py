"""Written tables that cut lineage, size-checked joins, forests and connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by the session.

    Only a local session without the setting gets a temporary folder; a cluster without it is an error.
    """
    found = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="canopy-")
    spark.conf.set(SETTING, found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, done: tuple[DataFrame, ...] = ()) -> DataFrame:
    """df as a Parquet table in the shared folder: it survives lost executors and is computed once.

    done: tables made by this function that nothing needs any more; their files are removed.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    for old in done:
        for file in old.inputFiles()[:1]:
            drop_path(spark, file.rpartition("/")[0])
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """As written(), bucketed by a column: rows with the same value need no shuffle to meet each other again.

    The table leaves the catalog at once; its files and their buckets stay known to what is returned.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = f"canopy_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, by).option("compression", "zstd").option("path", path).saveAsTable(table)
    found = spark.table(table)
    found.schema
    spark.sql(f"DROP TABLE {table}")
    return found


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def sized(small: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """small with a broadcast hint if it has at most most_rows rows, else as it is (a shuffle join then).

    small should be narrow and cheap to count, such as a written table of ids.
    """
    return F.broadcast(small) if small.count() <= most_rows else small


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each id to the least id that the pairs connect it with."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[one], label[two])
        new = label.copy()
        np.minimum.at(new, one, low)
        np.minimum.at(new, two, low)
        np.minimum.at(new, label[one], low)
        np.minimum.at(new, label[two], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(ids))
    return ids[label[keep]], ids[keep]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): component is the least node that edges connect to node.

    Alternating large-star and small-star contraction; every round is one written table, so neither the driver
    nor one task ever holds a component. Nodes without an edge to another node don't appear.
    """
    spark = edges.sparkSession
    last: str | None = None

    def save(df: DataFrame) -> tuple[DataFrame, tuple]:
        nonlocal last
        path = new_path(spark, "stars")
        df.write.option("compression", "zstd").parquet(path)
        if last:
            drop_path(spark, last)
        last = path
        out = spark.read.parquet(path)
        x = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return out, tuple(x)

    def star(e: DataFrame, large: bool) -> DataFrame:
        """Links the neighbours of each u to the least of them; large: only those above u."""
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        j = both.join(least, "u")
        if large:
            return j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        links = j.select(F.col("v").alias("u"), F.col("m").alias("v"))
        return links.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

    e, mark = save(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    while True:
        e, now = save(star(star(e, True), False))
        if now == mark:
            break
        mark = now
    found = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def own_columns(df: DataFrame, keep: dict[str, Column | str]) -> DataFrame:
    """Only the columns an operator works on, under names of its own, so that extra columns can't clash."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in keep.items()])

"""python -m canopy.cli ACTION --config FILE --data FOLDER --out FOLDER [--state FOLDER] [--log FOLDER]

bootstrap makes the state folder, snapshot writes every document of a configuration, sync goes on from the state over a
change log (once, or with --poll SECONDS again and again), analyze reports the joins, status the counters, and
teardown removes documents and state.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from canopy.functions import plugins
from canopy.plans import catalog
from canopy.plans.compile import compile
from canopy.plans.spec import load
from canopy.sources import log
from canopy.sources.sinks import ParquetSink
from canopy.streaming.state import StateFile
from canopy.streaming.sync import Sync


def analyze(spec, tables) -> list[str]:
    """The columns that joins of the tree use: a table laid out by them needs no shuffle."""
    out = []
    for node in spec.root.breadth_first():
        for child in node.children:
            rel = child.relationship
            name = rel.through or child.table
            parent, own = rel.foreign_key if rel.foreign_key and not rel.through else tables.edge(node.table, name)
            out.append(f"{name}: joined to {node.table} on {', '.join(own)} = {', '.join(parent)}")
            if rel.through:
                left, right = rel.foreign_key or tables.edge(rel.through, child.table)
                out.append(f"{child.table}: joined to {name} on {', '.join(right)} = {', '.join(left)}")
    return out


def runner(spark: SparkSession, spec, tables, out: str, state: str) -> Sync:
    """A Sync into a Parquet table of documents; its intermediate tables lie with its state."""
    n = iter(range(1 << 30))
    session = spark.sparkContext.applicationId

    def save(df):
        at = f"{state}/tables/{session}-{next(n)}"
        df.write.mode("overwrite").parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    schema = plugins.run(compile(spec, tables), spec.plugins).schema
    return Sync(spec, tables, ParquetSink(spark, f"{out}/{spec.index}", schema), save, f"{state}/{spec.index}")


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("action", choices=["bootstrap", "snapshot", "sync", "analyze", "status", "teardown"])
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--config")
    source.add_argument("--config-url")
    source.add_argument("--config-s3")
    p.add_argument("--data", required=True)
    p.add_argument("--out")
    p.add_argument("--state")
    p.add_argument("--log", help="a folder of Parquet files (lsn, xid, line)")
    p.add_argument("--poll", type=float, help="seconds between batches")
    a = p.parse_args(args)
    if a.action != "analyze" and not (a.out and a.state):
        p.error("this action needs --out and --state")
    spark = SparkSession.builder.getOrCreate()
    tables = catalog.of_folder(spark, a.data)
    for spec in load(a.config, url=a.config_url, s3=a.config_s3):
        if a.action == "analyze":
            print(spec.root.display(), *analyze(spec, tables), sep="\n")
            continue
        if a.action == "bootstrap":
            StateFile(spark, f"{a.state}/{spec.index}/state.json").save({})
            continue
        sync = runner(spark, spec, tables, a.out, a.state)
        if a.action == "snapshot":
            sync.snapshot()
        elif a.action == "status":
            print(json.dumps(sync.status()))
        elif a.action == "teardown":
            sync.teardown()
        elif not a.log:
            p.error("sync needs --log")
        else:
            trigger = {"processingTime": f"{a.poll} seconds"} if a.poll else {"availableNow": True}
            sync.stream(log.stream(spark, a.log), f"{a.state}/{spec.index}/offsets", **trigger).awaitTermination()


if __name__ == "__main__":
    main()

"""A change log as a table (lsn, xid, line) that grows by files, and durable cursors over it."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.operators import changes
from canopy.streaming.state import StateFile

LOG = "lsn long, xid long, line string"


class Cursor:
    """A named place in a log that outlives runs: rows up to it are done.

    Reading by pages follows the order of lsn; a page is a filter and a limit, so nothing is ordered that isn't read.
    """

    def __init__(self, log: DataFrame, state: str, name: str) -> None:
        if not name.replace("_", "").isalnum():
            raise ValueError(f"bad name {name}")
        self.log, self.name = log, name
        self.file = StateFile(log.sparkSession, f"{state}/{name}.json")

    def create(self, at: int = -1) -> None:
        if self.exists():
            raise ValueError(f"{self.name} is there already")
        self.file.save({"done": at})

    def exists(self) -> bool:
        return bool(self.file.load())

    def drop(self) -> None:
        self.file.delete()

    @property
    def done(self) -> int:
        found = self.file.load()
        if not found:
            raise ValueError(f"no cursor {self.name}")
        return found["done"]

    def peek(self, low: int | None = None, high: int | None = None, upto: int | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
        """Rows beyond the cursor, of transactions from low and below high, up to a position; a page of them if asked."""
        rows = changes.within(self.log.where(F.col("lsn") > self.done), "xid", low, high)
        if upto is not None:
            rows = rows.where(F.col("lsn") <= upto)
        if limit is not None or offset:
            rows = rows.orderBy("lsn").offset(offset)
            rows = rows if limit is None else rows.limit(limit)
        return rows

    def count(self, low: int | None = None, high: int | None = None, upto: int | None = None) -> int:
        return self.peek(low, high, upto).count()

    def head(self) -> int | None:
        """The last position of the log."""
        return self.log.agg(F.max("lsn")).first()[0]

    def advance(self, to: int) -> None:
        """Everything up to a position is done; a cursor never goes back."""
        self.file.save({"done": max(self.done, to)})

    def get(self, **page) -> DataFrame:
        """As peek, and moves the cursor behind what it gives. Whoever must not lose rows peeks, writes and then advances."""
        rows, before = self.peek(**page), self.done
        last = rows.agg(F.max("lsn")).first()[0]
        if last is None:
            return rows
        first = rows.agg(F.min("lsn")).first()[0]
        self.advance(last)
        return changes.within(self.log.where((F.col("lsn") > before) & F.col("lsn").between(first, last)), "xid", page.get("low"), page.get("high"))


def consume(cursor: Cursor, sync, page: int = 5000) -> int:
    """Applies what a cursor has not done, a page at a time, each page of committed transactions alone; the cursor moves
    after a page is written, so a page may be applied again after a failure, which changes nothing. Gives the pages."""
    pages = 0
    while True:
        ready = changes.committed(cursor.peek())
        block = ready.orderBy("lsn").limit(page)
        last = block.agg(F.max("lsn")).first()[0]
        if last is None:
            return pages
        sync.apply(changes.log_events(ready.where(F.col("lsn") <= last)))
        cursor.advance(last)
        pages += 1


def stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """EVENT rows of a log's files as a stream; offsets live in the checkpoint of the query that reads it."""
    return changes.log_events(spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_batch).parquet(path))


class EventQueue:
    """A queue of event rows in a folder: each push is a set of files, and a place says how much was popped.

    A push is sorted by ranges of seq. In the files a row's place is the number of its range and its row in that, as one
    long; the state has how many rows each range of a push has, so places count on from push to push.
    """

    #: monotonically_increasing_id gives each partition so many places
    RANGE = 1 << 33

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.file = StateFile(spark, f"{path}/queue.json")

    def _state(self) -> dict:
        return {"pushed": 0, "popped": 0, "folders": [], "meta": {}} | self.file.load()

    def push(self, events: DataFrame) -> int:
        """Adds events, in order of seq, behind those that are there; gives how many."""
        state = self._state()
        at = f"{self.path}/{len(state['folders'])}-{state['pushed']}"
        ordered = events.repartitionByRange("seq").sortWithinPartitions("seq").withColumn("place", F.monotonically_increasing_id())
        ordered.write.mode("overwrite").parquet(at)
        written = self.spark.read.schema(ordered.schema).parquet(at).groupBy(F.floor(F.col("place") / F.lit(self.RANGE)).alias("range")).count()
        ranges = sorted((r["range"], r["count"]) for r in written.collect())
        n = sum(count for _, count in ranges)
        self.file.save(state | {"pushed": state["pushed"] + n, "folders": [*state["folders"], {"path": at, "first": state["pushed"], "ranges": ranges}]})
        return n

    def size(self) -> int:
        state = self._state()
        return state["pushed"] - state["popped"]

    def pop(self, n: int = 1000) -> DataFrame:
        """The next n events; they are then gone from the queue."""
        state = self._state()
        low, high = state["popped"], min(state["pushed"], state["popped"] + n)
        self.file.save(state | {"popped": high})
        found = []
        for folder in state["folders"]:
            if isinstance(folder, str):  # of a queue that numbered all rows in the files
                found.append(self.spark.read.parquet(folder).where((F.col("place") >= low) & (F.col("place") < high)).drop("place"))
                continue
            first, some = folder["first"], []
            for k, count in folder["ranges"]:
                a, z = max(low - first, 0), min(high - first, count)
                if a < z:
                    some.append((k * self.RANGE + a, k * self.RANGE + z - 1))
                first += count
            if some:  # what lies between two ranges has no rows
                found.append(self.spark.read.parquet(folder["path"]).where(F.col("place").between(some[0][0], some[-1][1])).drop("place"))
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], changes.EVENT)

    def delete(self) -> None:
        self.file.save(self._state() | {"popped": 0, "pushed": 0, "folders": []})

    def set_meta(self, **values) -> None:
        state = self._state()
        self.file.save(state | {"meta": state["meta"] | json.loads(json.dumps(values))})

    def meta(self) -> dict:
        return self._state()["meta"]

"""Incremental maintenance: each micro-batch of changes is resolved to documents, which are computed again and written."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from canopy.functions import plugins
from canopy.operators import changes, resolve
from canopy.plans.catalog import Catalog
from canopy.plans.compile import compile, doc_keys
from canopy.plans.spec import DocSpec
from canopy.sources.sinks import Sink
from canopy.streaming.state import KeyIndex, StateFile


class Sync:
    """Keeps a sink equal to the documents of a specification.

    save: writes a DataFrame and gives it back read from storage, so that lineage doesn't grow and a lost executor
    costs nothing. state: a folder for the index of keys, the sink's manifest, the checkpoint and counters; a Sync that is
    made anew over it goes on where the last one stopped. refresh: called before each batch, to renew materialized views.
    """

    def __init__(self, spec: DocSpec, catalog: Catalog, sink: Sink, save: Callable[[DataFrame], DataFrame], state: str, refresh: Callable[[], None] | None = None) -> None:
        self.spec, self.catalog, self.sink, self.save, self.refresh = spec, catalog, sink, save, refresh
        spark = catalog[spec.root.table].load().sparkSession
        self.file = StateFile(spark, f"{state}/state.json")
        self.state: dict[str, Any] = {"batch": -1, "checkpoint": None, "batches": 0, "events": 0, "documents": 0, "held": []} | self.file.load()
        self.index = KeyIndex(spark, f"{state}/keys", self.state.get("keys"))
        if "sink" in self.state:
            sink.restore(self.state["sink"])

    def _saved(self, **more: Any) -> None:
        self.state |= more | {"keys": self.index.manifest, "sink": self.sink.manifest(), "documents": self.sink.doc_count}
        self.file.save(self.state)

    @property
    def checkpoint(self) -> int | None:
        return self.state["checkpoint"]

    @checkpoint.setter
    def checkpoint(self, value: int) -> None:
        if value is None:
            raise ValueError("a checkpoint can't be empty")
        self._saved(checkpoint=int(value))

    def snapshot(self, where=None, tx=None) -> None:
        """All documents (or those of a range of transactions); replaces the index of keys."""
        documents = self.save(plugins.run(compile(self.spec, self.catalog, where=where, tx=tx), self.spec.plugins))
        self.sink.create(self.spec)
        self.sink.bulk(documents, documents.select("_id").limit(0))
        self.index.replace(doc_keys(documents))
        self._saved()

    def apply(self, events: DataFrame, batch: int | None = None) -> None:
        """Writes what a batch of events changes: deletions first, then documents computed from the present tables.

        A batch whose number is not above that of the last one saved was applied before, and is left out.
        """
        if not self.index.manifest["keys"]:
            raise RuntimeError("take a snapshot first")
        if batch is not None and batch <= self.state["batch"]:
            return
        if self.refresh:
            self.refresh()
        views = {b: t.name for t in self.catalog.tables.values() for b in t.base_tables}
        events = self.save(changes.only_known(events, self.spec.root.tables(), views))
        resolve.validate(events, self.spec, self.catalog)
        deletes, upserts = (self.save(x) for x in resolve.resolve(events, self.spec, self.catalog, self.index.read()))
        again = compile(self.spec, self.catalog, resolve.root_keys(upserts, self.spec, self.catalog))
        documents = self.save(plugins.run(again, self.spec.plugins))
        touched = self.save(deletes.unionByName(upserts).select("_id").distinct())
        # asked for but no longer there: their root is gone
        gone = self.save(touched.join(documents.select("_id"), "_id", "left_anti"))
        self.sink.bulk(documents, gone)
        self.index.update(touched, doc_keys(documents))
        n, least = events.agg(F.count(F.lit(1)), F.min("txid")).first()
        done = self.state["checkpoint"]
        if least is not None:
            done = least - 1 if done is None else max(done, least - 1)
        self._saved(checkpoint=done, batches=self.state["batches"] + 1, events=self.state["events"] + n, batch=self.state["batch"] if batch is None else batch)

    def apply_visible(self, events: DataFrame, below: int, in_progress: list[int]) -> None:
        """Applies events of visible transactions; the others, and those held back before, are kept with the state."""
        before = [self.catalog[self.spec.root.table].load().sparkSession.read.schema(changes.EVENT).parquet(p) for p in self.state["held"]]
        for old in before:
            events = events.unionByName(old)
        ready, held = changes.visible(self.save(events), below, in_progress)
        at = f"{self.index.path}/held-{self.state['batches']}-{below}"
        held.write.mode("overwrite").parquet(at)
        self.apply(ready)
        self._saved(held=[at])

    def stream(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Applies a stream of events batch by batch; a batch that runs again after a failure changes nothing.

        trigger: availableNow=True (catch up and stop, the default) or processingTime="10 seconds" (polling).
        """
        writer = events.writeStream.foreachBatch(lambda batch, n: self.apply(batch, n)).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def status(self) -> dict[str, Any]:
        """Counters for a log or a monitor."""
        return {"index": self.spec.index, **{k: self.state[k] for k in ("batch", "batches", "events", "documents", "checkpoint")}}

    def teardown(self) -> None:
        """Removes the documents and the state."""
        self.sink.teardown()
        self.file.delete()


def hold_back(events: DataFrame, held: DataFrame, below: int, in_progress: list[int]) -> tuple[DataFrame, DataFrame]:
    """(ready, held): earlier held events and new ones, parted by whether their transaction is visible."""
    return changes.visible(held.unionByName(events), below, in_progress)

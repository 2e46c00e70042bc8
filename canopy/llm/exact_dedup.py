"""Exact dedup by a minimal perfect hash over the digests of the distinct texts seen so far.

Historical digests are cut into shards of bounded size. Each shard gets a minimal perfect hash (levels of
collision-free bit positions, ranked): n digests map to slots 0..n-1, and a slot holds the whole 32-byte digest and
the locator (doc_id) of the winner. A lookup computes the slot and compares all bytes of the digest there; a digest
that differs is no member. Members other than their winner are repeats; nonmembers are grouped among themselves.

Defined results: a null text has no digest, is never a repeat and is its own winner. Empty and long texts are texts
like others. Rows with the same doc_id and text are one document. The winner of a group is its least doc_id; a null
doc_id wins only where the group has no other. Extra columns are ignored by decide() and kept by remove_repeats(), whatever
their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import own_columns, sized, written
from canopy.llm._text import mix

KEYS_PER_SHARD = 1 << 16
ROWS_PER_TASK = 1 << 21
GAMMA = 1.7
OUT = "digest binary, doc_id long, winner long, found boolean"


class PerfectHash:
    """Minimal perfect hash over distinct 32-byte digests, with the digests and winners in its slots."""

    def __init__(self, digests: np.ndarray, winners: np.ndarray, has: np.ndarray):
        n = len(digests)
        self.sizes: list[int] = []
        bits: list[np.ndarray] = []
        rest, slot = np.arange(n), np.full(n, -1)
        used = 0
        while len(rest):
            level = len(self.sizes)
            if level > 200:
                raise ValueError("digests must be distinct")
            m = max(64, int(GAMMA * len(rest)))
            pos = self._at(digests[rest], level, m)
            alone = np.bincount(pos, minlength=m)[pos] == 1
            b = np.zeros(m, bool)
            b[pos[alone]] = True
            bits.append(b)
            self.sizes.append(m)
            ranks = used + np.cumsum(b) - 1
            slot[rest[alone]] = ranks[pos[alone]]
            used += int(alone.sum())
            rest = rest[~alone]
        self.bits = np.concatenate(bits) if bits else np.zeros(0, bool)
        self.rank = np.cumsum(self.bits) - 1
        self.digests, self.winners, self.has = np.empty_like(digests), np.zeros(n, np.int64), np.zeros(n, bool)
        self.digests[slot], self.winners[slot], self.has[slot] = digests, winners, has

    @staticmethod
    def _at(digests: np.ndarray, level: int, m: int) -> np.ndarray:
        w = np.ascontiguousarray(digests).view(np.uint64)
        return (mix(w[:, level % 4] ^ mix(w[:, (level + 1) % 4], level + 1), 3 * level + 2) % np.uint64(m)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.winners)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for nonmembers; all 32 bytes are compared."""
        out = np.full(len(digests), -1)
        rest, base = np.arange(len(digests)), 0
        for level, m in enumerate(self.sizes):
            if not len(rest):
                break
            pos = base + self._at(digests[rest], level, m)
            hit = self.bits[pos]
            slots = self.rank[pos[hit]]
            same = (self.digests[slots] == digests[rest[hit]]).all(axis=1)
            out[rest[hit]] = np.where(same, slots, -1)
            rest, base = rest[~hit], base + m
        return out


def _bytes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    h = PerfectHash(_bytes(pdf["digest"]), pdf["winner"].fillna(0).to_numpy(np.int64), pdf["winner"].notna().to_numpy())
    return pd.DataFrame({"shard": [key[0]], "blob": [pickle.dumps(h)]})


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple[int, PerfectHash] | None = None
    for batch in batches:
        shard = np.asarray(batch.column(0))
        blob = batch.column(1)
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b and blob[a].is_valid:
                held, a = (int(shard[a]), pickle.loads(blob[a].as_py())), a + 1
            if a == b:
                continue
            part = batch.slice(a, b - a)
            d = _bytes(part.column(2).to_pylist())
            at = held[1].find(d) if held and held[0] == int(shard[a]) else np.full(len(d), -1)
            found = at >= 0
            h = held[1] if found.any() else None
            win = h.winners[at] if h else np.zeros(len(d), np.int64)
            none = ~(found & h.has[at]) if h else np.ones(len(d), bool)
            yield pa.RecordBatch.from_arrays(
                [part.column(2), part.column(3), pa.array(win, mask=none), pa.array(found)],
                names=["digest", "doc_id", "winner", "found"],
            )


def digests(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, n): the distinct documents and how many rows each has; a null text has a null digest."""
    own = own_columns(docs, {"doc_id": "doc_id", "text": "text"})
    own = own.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.col("doc_id").cast("long"))
    return own.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def history_of(found: DataFrame) -> DataFrame:
    """(digest, winner) of what digests() gives: the history that a later run is to look up."""
    return found.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("winner"))


def decide(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """(doc_id, winner, is_repeat, member) of each distinct document.

    history: (digest, winner) of earlier data, digests distinct; without it, that of docs itself.
    """
    return _decide(written(digests(docs), "digests"), history).drop("digest")


def _decide(rows: DataFrame, history: DataFrame | None) -> DataFrame:
    past = written(history_of(rows) if history is None else history.select("digest", "winner"), "history")
    shards = max(1, -(-past.count() // KEYS_PER_SHARD))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")
    hashes = past.select("digest", "winner", shard).groupBy("shard").applyInPandas(_build, "shard int, blob binary")
    own = rows.where("digest is not null").select(shard, "digest", "doc_id")
    # a shard with many lookups, as of one text copied very often, is spread over several tasks
    tasks = written(own.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_TASK).cast("int").alias("tasks")), "tasks")
    hashes = hashes.join(sized(tasks), "shard").select(
        "shard", "blob", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("doc_id"),
        F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"),
    )
    own = own.join(sized(tasks), "shard").select(
        "shard", F.lit(None).cast("binary").alias("blob"), "digest", "doc_id",
        F.pmod(F.xxhash64("doc_id"), F.col("tasks")).cast("int").alias("salt"),
    )
    both = hashes.unionByName(own).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("blob").isNull())
    looked = both.select(
        (F.shiftleft(F.col("shard").cast("long"), 32) + F.col("salt")).alias("shard"), "blob", "digest", "doc_id"
    ).mapInArrow(_look_up, OUT)
    looked = written(looked, "looked")
    members = looked.where("found").select("digest", "doc_id", "winner", F.lit(True).alias("member"))
    new = looked.where("not found")
    firsts = new.groupBy("digest").agg(F.min("doc_id").alias("winner"))
    new = new.drop("winner").join(firsts, "digest").select("digest", "doc_id", "winner", F.lit(False).alias("member"))
    empty = rows.where("digest is null").select("digest", "doc_id", F.col("doc_id").alias("winner"), F.lit(False).alias("member"))
    return (
        members.unionByName(new)
        .unionByName(empty)
        .select("digest", "doc_id", "winner", (~F.col("doc_id").eqNullSafe(F.col("winner"))).alias("is_repeat"), "member")
    )


def earlier(docs: DataFrame) -> DataFrame:
    """The history (digest, winner) of the half of docs with the lower doc_ids, as if they had come before the others."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    low, high = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    return history_of(digests(docs.where(F.col("doc_id") <= ((low or 0) + (high or 0)) // 2)))


def remove_repeats(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """docs without repeats, with all their columns; of rows with the same doc_id and text one stays."""
    rows = written(digests(docs), "digests")
    gone = written(_decide(rows, history).where("is_repeat").select(F.col("digest").alias("d"), F.col("doc_id").alias("i")), "repeats")
    twice = written(rows.where("n > 1 and digest is not null").select(F.col("digest").alias("d"), F.col("doc_id").alias("i")), "twice")
    # extra columns can't clash with names inside one struct
    marked = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("own_digest")
    )

    def among(few: DataFrame, how: str, of: DataFrame) -> DataFrame:
        return of.join(sized(few), F.col("own_digest").eqNullSafe(F.col("d")) & F.col("own_id").eqNullSafe(F.col("i")), how)

    kept = among(gone, "left_anti", marked)
    if twice.count():
        again = among(twice, "left_semi", kept).dropDuplicates(["own_id", "own_digest"])
        kept = among(twice, "left_anti", kept).unionByName(again)
    return kept.select("row.*")

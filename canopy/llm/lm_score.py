"""Language-model scores in bits per byte by online logistic context mixing.

Five bit predictors look at the last 1 to 5 bytes and at the bits of the present byte so far; the contexts of more than
one byte are hashed into tables of zeros and ones seen. A mixer adds their log odds by weights that are gated by the
longest context seen before and the place of the bit, and an adaptive map of (node, odds) refines the result. All of
them learn as the text goes by, from all of it: a block of BLOCK bytes is scored by what came before, so a longer document
adapts to its own text, then counts, mixer (an online Newton step a gate, with the curvature of the blocks before, of which
KEEP stays each time) and map learn from every bit of it. In a block only the distinct (five bytes, byte) have to be worked
out; each position takes the cost of its own, so the result is the same as position by position.

The model is of the whole corpus. Equal texts are scored once; the distinct ones are dealt by hash into shards of about
SHARD_BYTES, and every shard into one of FOLDS folds. First each shard's texts are learned (in blocks of WARM bytes). All that
is learned adds up: counts and map as they are, weights by their curvature; so the sums over folds and over everything are
exact, in a few tables of fixed size. Then a shard's texts are scored by a model that begins with everything outside of its
fold and goes on to learn the shard. Texts of which there are several are shards of their own, outside of all folds: no text
is scored by what it taught itself alone, and one that occurs again is cheap wherever its copies are.

costs() is the same within one shard, in two halves, each scored by a model that has learned the other and what occurs again.

Defined results: null and empty texts have 0 bytes and null bits per byte. Rows that repeat have a row each, with the same
score. Long texts are scored whole. Texts are told apart by 64 bits of hash and their size. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import new_path, own_columns, sized, written
from canopy.llm._text import lean, raw

ORDERS = 5
SLOT_BITS = 22
SHARD_BYTES = 24 << 20
FOLDS = 8
BLOCK = 512 << 10
WARM = 4 << 20
CHUNK = 16384
RIDGE = 20.0
KEEP = 0.995
TRUST = 24.0
START = (0.15, 0.2, 0.25, 0.3, 0.4)
_U = np.uint64
_MOST = 1 << 30  # a slot of more is scaled down when a model begins with it
_ONES = 32  # a slot counts zeros in its lower half and ones in its upper; as two of 32 bits, zeros come first


class Mixer:
    def __init__(self, slot_bits: int = SLOT_BITS):
        self.bits = slot_bits
        self.seen = [np.zeros(1 << b, _U) for b in (16, *[slot_bits] * (ORDERS - 1))]
        self.weight = np.tile(np.array(START, np.float32), (8 * ORDERS, 1))
        self.steep = np.zeros((8 * ORDERS, ORDERS, ORDERS))
        self.map = np.zeros(256 * 33, _U)

    def sums(self) -> list[np.ndarray]:
        """What adds up over models: zeros and ones of each order, then map, curvature, weights times curvature, and 1."""
        split = lambda x, t: np.concatenate([x.view(np.uint32)[::2].astype(t), x.view(np.uint32)[1::2].astype(t)])
        firm = self.steep + RIDGE * np.eye(ORDERS)
        pull = firm @ self.weight[:, :, None].astype(np.float64)
        return [*(split(x, np.float32) for x in self.seen), np.concatenate([split(self.map, np.float64), self.steep.ravel(), pull.ravel(), [1.0]])]

    def begin(self, part: int, sums: np.ndarray) -> None:
        """Takes over part `part` of sums of models; the curvature is their mean, so that the weights still move."""

        def packed(x: np.ndarray) -> np.ndarray:
            zeros, ones = np.maximum(x, 0).reshape(2, -1)
            if max(zeros.max(), ones.max()) <= _MOST:
                out = np.empty(zeros.size, _U)
                out.view(np.uint32)[::2], out.view(np.uint32)[1::2] = zeros, ones
                return out
            scale = np.minimum(1, _MOST / np.maximum(np.maximum(zeros, ones), 1))
            return np.rint(zeros * scale).astype(_U) | np.rint(ones * scale).astype(_U) << _U(_ONES)

        if part < ORDERS:
            self.seen[part] = packed(sums)
            return
        counts, steep, pull, runs = np.split(sums, np.cumsum([2 * self.map.size, self.steep.size, self.weight.size]))
        if runs[0] > 0.5:
            self.map, steep = packed(counts), steep.reshape(self.steep.shape)
            firm = steep + runs[0] * RIDGE * np.eye(ORDERS)
            self.weight = np.linalg.solve(firm, pull.reshape(-1, ORDERS, 1))[:, :, 0].astype(np.float32)
            self.steep = steep / runs[0]

    def names(self, context: np.ndarray) -> Iterator[np.ndarray]:
        """Where the nodes of each context begin in the tables; context: five bytes, the last of them highest."""
        yield context >> _U(32) << _U(8)
        for o in range(2, ORDERS + 1):
            part = (context >> _U(40 - 8 * o)) * _U(0x9E3779B97F4A7C15) + _U(0xD1342543DE82EF95 * (2 * o + 1) % (1 << 64))
            part ^= part >> _U(29)
            part *= _U(0xBF58476D1CE4E5B9)
            part ^= part >> _U(32)
            part *= _U(0x94D049BB133111EB)
            yield part >> _U(64 - self.bits)

    def slots(self, context: np.ndarray, node: np.ndarray) -> Iterator[np.ndarray]:
        """The place of each predictor; context: five bytes, the last of them lowest.

        A context's nodes lie together, in 2 KB of each table, so that memory is not fetched anew for each of them.
        """
        for o, name in enumerate(self.names(context.byteswap() >> _U(24))):
            yield (name ^ node.astype(_U) & _U((1 << (self.bits if o else 8)) - 1)).view(np.int64)

    @staticmethod
    def place(node: np.ndarray, x: np.ndarray) -> np.ndarray:
        return node.astype(np.int64) * 33 + np.rint(np.clip(x, -8, 8) * 2).astype(np.int64) + 16

    def step(self, push: np.ndarray, bend: np.ndarray, met: np.ndarray) -> None:
        """An online Newton step of the weights of each gate; blocks before this one count too, less and less, for the curvature."""
        self.steep[met] = KEEP * self.steep[met] + bend[met]
        hessian = self.steep + RIDGE * np.eye(ORDERS)
        self.weight += np.clip(np.linalg.solve(hessian, push[:, :, None])[:, :, 0], -1, 1).astype(np.float32)

    def learn(self, key: np.ndarray, count: np.ndarray, score: bool) -> np.ndarray | None:
        """Learns count of each distinct key (context << 8 | symbol), in order of keys; score: their bits before that.

        A context has the last byte before the symbol highest. Some contexts at a time, whole ones, are worked out, so that
        what is worked on stays in the processor's cache; what they teach is added when all of the block is worked out.
        """
        fresh = np.flatnonzero(np.concatenate([[True], (key[1:] ^ key[:-1]) > _U(0xFF)]))
        cuts = np.unique(fresh[np.searchsorted(fresh, np.arange(0, fresh[-1] + 1, CHUNK))])
        push, bend, met = np.zeros((8 * ORDERS, ORDERS)), np.zeros((8 * ORDERS, ORDERS, ORDERS)), np.zeros(8 * ORDERS, bool)
        cost = np.zeros(len(key), np.float32) if score else None
        count, later = count.astype(_U), []
        for a, z in zip(cuts, [*cuts[1:], len(key)]):
            part = None if cost is None else cost[a:z]
            later.append(self._chunk(key[a:z], count[a:z], push, bend, met, part))
        self.step(push, bend, met)
        for slots, place, both in later:
            for seen, at in zip(self.seen, slots):
                np.add.at(seen, at.astype(np.int64), both)
            np.add.at(self.map, place.astype(np.int64), both)
        return cost

    def _chunk(self, key, count, push, bend, met, cost) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slots, place in the map, zeros and ones) of each node of the keys; adds to push, bend, met and to cost, if there is one.

        The nodes are the distinct (context, bits of the symbol so far) of all eight places of a bit, one place after another.
        """
        n = len(key)
        apart = np.empty(n, _U)
        apart[0], apart[1:] = ~_U(0), key[1:] ^ key[:-1]
        new, nodes, bit = np.empty((8, n), bool), np.empty((8, n), np.uint8), np.empty((8, n), np.uint8)
        symbol = key.astype(np.uint8)
        for j in range(8):
            np.greater_equal(apart, _U(1 << (8 - j)), out=new[j])
            nodes[j] = symbol >> (8 - j) | 1 << j if j else 1
            bit[j] = symbol >> (7 - j) & 1
        head = np.flatnonzero(new)
        ends = np.searchsorted(head, np.arange(9) * n)
        size = np.diff(ends)
        node = nodes.ravel().take(head)
        until = np.zeros(8 * n + 1, _U)
        np.cumsum((count << (bit.astype(_U) << _U(5))).ravel(), out=until[1:])
        both = np.diff(until.take(np.append(head, 8 * n)))
        own = np.cumsum(new[0]) - 1
        whose = own.take(head - np.repeat(np.arange(8) * n, size))
        names = np.stack(list(self.names(key[new[0]] >> _U(8))), axis=1).view(np.int64).take(whose, axis=0)
        wide = node.astype(np.int64)
        low = wide & ((1 << self.bits) - 1)
        odds, longest = np.empty((ORDERS, len(head)), np.float32), np.zeros(len(head), np.uint8)
        slots = np.empty((ORDERS, len(head)), np.uint32)
        for o in range(ORDERS):
            at = names[:, o] ^ (low if o else wide)
            slots[o] = at
            seen = self.seen[o].take(at)
            np.maximum(longest, (seen > 0).view(np.uint8) * np.uint8(o), out=longest)
            halves = seen.view(np.uint32).astype(np.float32)  # zeros, ones, zeros, ...
            halves += np.float32(0.4)
            np.divide(halves[1::2], halves[::2], out=odds[o])
        np.log(odds, out=odds)
        halves = both.view(np.uint32).astype(np.float32)
        times, ones = halves[::2] + halves[1::2], halves[1::2]
        x, p = np.empty(len(head), np.float32), np.empty(len(head), np.float32)
        for j in range(8):
            part, gates = slice(ends[j], ends[j + 1]), slice(j * ORDERS, (j + 1) * ORDERS)
            z = odds[:, part]
            gate = longest[part] == np.arange(ORDERS, dtype=np.uint8)[:, None]
            met[gates] |= gate.any(axis=1)
            gate = gate.astype(np.float32)
            np.clip((gate * (self.weight[gates] @ z)).sum(axis=0), -12, 12, out=x[part])
            p[part] = 1 / (1 + np.exp(-x[part]))
            sure = times[part] * p[part]
            bent = gate * (sure * (1 - p[part]))
            bend[gates] += ((bent[:, None] * z).reshape(ORDERS * ORDERS, -1) @ z.T).reshape(ORDERS, ORDERS, ORDERS)
            push[gates] += (gate * (ones[part] - sure)) @ z.T
        place = self.place(node, x)
        if cost is not None:
            halves = self.map.take(place).view(np.uint32).astype(np.float32)
            zero, one = halves[::2], halves[1::2]
            bits = np.empty((len(head), 2), np.float32)
            refined = (p + (one + TRUST * p) / (zero + one + TRUST)) / 2
            bits[:, 0], bits[:, 1] = 1 - refined, refined
            np.log2(bits, out=bits)
            spot = np.cumsum(new.ravel()) - 1
            spot <<= 1
            spot |= bit.ravel()
            cost -= bits.ravel().take(spot).reshape(8, n).sum(axis=0)
        return slots, place.astype(np.uint16), both


def blocks(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(distinct keys in order, counts, text of each position in order of keys, names of these texts) of blocks of up to
    size bytes. A block ends at 65,536 texts too."""
    texts = np.flatnonzero(np.diff(offsets))
    offsets = np.concatenate([offsets[texts], offsets[-1:]])
    # five zero bytes before each text
    text = np.ones(len(data) + 5 * len(texts), bool)
    text[(offsets[:-1, None] + 5 * np.arange(len(texts))[:, None] + np.arange(5)).ravel()] = False
    apart = np.zeros(len(text), np.uint8)
    apart[text] = data
    a = 0
    while a < len(data):
        first = int(np.searchsorted(offsets, a, side="right")) - 1
        z = min(len(data), a + size, int(offsets[min(first + (1 << 16), len(texts))]))
        last = int(np.searchsorted(offsets, z - 1, side="right")) - 1
        low, high = a + 5 * (first + 1), z - 1 + 5 * (last + 1)
        key = np.zeros(high + 1 - low, _U)
        for back in (1, 2, 3, 4, 5, 0):
            key <<= _U(8)
            key |= apart[low - back : high + 1 - back]
        key = key[text[low : high + 1]]
        key <<= _U(16)
        ends = np.minimum(offsets[first + 1 : last + 2], z) - a
        key |= np.repeat(np.arange(last + 1 - first, dtype=_U), np.diff(np.concatenate([[0], ends])))
        key.sort()
        own = (key & _U(0xFFFF)).astype(np.uint16)
        key >>= _U(16)
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.concatenate([head, [len(key)]]))
        distinct = key[head]
        del key, head
        yield distinct, count, own, texts[first : last + 1]
        a = z


def scored_online(model: Mixer, texts: pa.Array, block: int = BLOCK) -> np.ndarray:
    """Bits of each text by model, which learns them as it goes."""
    total = np.zeros(len(texts))
    for key, count, own, names in blocks(*raw(texts), block):
        bits = np.bincount(own, np.repeat(model.learn(key, count, True), count))
        total[names] += bits
    return total


def costs(texts: pa.Array, again: np.ndarray | None = None, block: int = BLOCK, warm: int = WARM, slot_bits: int = SLOT_BITS, first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bits, bytes) of each text; again: those of which there are several; the first `first` texts are one half, by
    default about half of the bytes."""
    data, offsets = raw(texts)
    again = np.zeros(len(texts), bool) if again is None else again
    total = np.zeros(len(texts))
    if first is None:
        first = int(np.searchsorted(offsets, (len(data) + 1) // 2))
    place = np.arange(len(texts))
    for mine in (place < first, place >= first):
        model = Mixer(slot_bits)
        if mine.any():
            for key, count, _, _ in blocks(*raw(texts.filter(pa.array(~mine | again))), warm):
                model.learn(key, count, False)
        total[mine] = scored_online(model, texts.filter(pa.array(mine)), block)
    return total, np.diff(offsets)


def _whole(work):
    """work on the rows (shard, fold, ..., text) of each shard; they come in order of shards, whole shards each."""

    def gathered(held: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        return table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and held[0].column(0)[0].as_py() != int(shard[a]):
                    yield from work(gathered(held))
                held.append(batch.slice(a, b - a))
        if held:
            yield from work(gathered(held))

    return lean(run)


def _body(sums: np.ndarray) -> bytes:
    return pa.compress(sums.tobytes(), "zstd", asbytes=True)


def _sums(part: int, length: int, body: bytes) -> np.ndarray:
    kind = np.float32 if part < ORDERS else np.float64
    return np.frombuffer(pa.decompress(body, length * np.dtype(kind).itemsize, "zstd", asbytes=True), kind)


SUMS = "fold int, shard long, part int, length int, body binary"


def _rows(fold: int, shard: int, part: int, sums: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((fold, shard, part, len(sums), _body(sums)), kinds)], names=["fold", "shard", "part", "length", "body"])


def _learned(warm: int, slot_bits: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        model = Mixer(slot_bits)
        for key, count, _, _ in blocks(*raw(table.column("text").chunk(0)), warm):
            model.learn(key, count, False)
        shard, fold = table.column("shard")[0].as_py(), table.column("fold")[0].as_py()
        for part, sums in enumerate(model.sums()):
            yield _rows(fold, shard, part, sums)

    return _whole(work)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each (fold, part); rows come in order of these and of shards."""
    now, total = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            fold, _, part, length, body = (batch.column(k)[i].as_py() for k in range(5))
            if now != (fold, part):
                if now is not None:
                    yield _rows(now[0], 0, now[1], total)
                now, total = (fold, part), np.zeros(length, np.float32 if part < ORDERS else np.float64)
            total += _sums(part, length, body)
    if now is not None:
        yield _rows(now[0], 0, now[1], total)


def _add_up(rows: DataFrame, path: str) -> None:
    """Writes the sums of each fold into a folder of its own."""
    inner = rows.repartition("fold", "part").sortWithinPartitions("fold", "part", "shard").mapInArrow(lean(_added), SUMS)
    inner.write.option("compression", "none").partitionBy("fold").parquet(path)


def _read(path: str, fold: int) -> dict[int, tuple[int, bytes]]:
    """(length, body) of the sums by part; nothing if the fold is empty."""
    files, root = pyarrow.fs.FileSystem.from_uri(f"{path}/fold={fold}")
    if files.get_file_info(root).type == pyarrow.fs.FileType.NotFound:
        return {}
    table = pq.read_table(root, columns=["part", "length", "body"], filesystem=files, partitioning=None)
    return {r["part"]: (r["length"], r["body"]) for r in table.to_pylist()}


def _scored(path: str, block: int, slot_bits: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        model, fold = Mixer(slot_bits), table.column("fold")[0].as_py()
        every, own = _read(f"{path}-all", -1), _read(path, fold) if fold < FOLDS else {}
        for part, x in every.items():
            model.begin(part, _sums(part, *x) - _sums(part, *own[part]) if own else _sums(part, *x))
        del every, own
        bits = scored_online(model, table.column("text").chunk(0), block)
        table = table.select(["doc_id", "h", "size", "again"]).append_column("bits", pa.array(np.round(bits, 3)))
        yield from table.to_batches()

    return _whole(work)


def score(docs: DataFrame, shard_bytes: int = SHARD_BYTES, block: int = BLOCK, warm: int = WARM, slot_bits: int = SLOT_BITS) -> DataFrame:
    """(doc_id, bytes, bits, bits_per_byte) of every row."""
    spark = docs.sparkSession
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    own = own.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"), "text")
    full, name = own.where("size > 0"), ["h", "size"]
    copies = written(full.groupBy(*name).count().where("count > 1").select(*name), "copies")
    once = full.join(sized(copies), name, "left_anti").withColumn("again", F.lit(False))
    many = full.join(sized(copies), name, "left_semi").dropDuplicates(name).withColumn("again", F.lit(True))
    whole, several = own.agg(F.sum("size")).first()[0] or 0, copies.agg(F.sum("size")).first()[0] or 0
    shards, more = max(FOLDS, -(-whole // shard_bytes)), max(1, -(-several // shard_bytes))
    # shards are few and equally full: each has a partition of its own as far as there are not too many of them
    parts = min(shards + more, 10 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashed = F.xxhash64(*name)
    shard = F.when(F.col("again"), shards + F.pmod(hashed, F.lit(more))).otherwise(F.pmod(hashed, F.lit(shards))).alias("shard")
    fold = F.when(F.col("again"), FOLDS).otherwise(F.pmod(F.pmod(hashed, F.lit(shards)), F.lit(FOLDS))).cast("int").alias("fold")
    dealt = once.unionByName(many).select(shard, fold, *name, "again", "doc_id", "text")
    dealt = dealt.repartitionById(parts, F.pmod("shard", F.lit(parts)).cast("int")).sortWithinPartitions("shard", *name)
    models = new_path(spark, "models")
    _add_up(dealt.mapInArrow(_learned(warm, slot_bits), SUMS), models)
    folds = spark.read.schema(SUMS).parquet(models)
    _add_up(folds.select(F.lit(-1).alias("fold"), F.col("fold").cast("long").alias("shard"), "part", "length", "body"), f"{models}-all")
    scored = written(dealt.mapInArrow(_scored(models, block, slot_bits), "doc_id long, h long, size long, again boolean, bits double"), "scored")
    copied = full.join(sized(copies), name, "left_semi").select("doc_id", *name).join(scored.where("again").select(*name, "bits"), name)
    out = scored.where("not again").select("doc_id", "size", "bits").unionByName(copied.select("doc_id", "size", "bits"))
    out = out.unionByName(own.where("size = 0").select("doc_id", "size", F.lit(0.0).alias("bits")))
    rate = F.when(F.col("size") > 0, F.round(F.col("bits") / F.col("size"), 6))
    return out.select("doc_id", F.col("size").alias("bytes"), "bits", rate.alias("bits_per_byte"))

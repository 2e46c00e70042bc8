"""Exact n-gram Jaccard join: prefixes in order of rarity, parity sketches, verification.

A text is the set A of its distinct n-grams of words. J(A, B) >= t asks for at least ceil(t |A|) common n-grams, so if
all sets are in one and the same order, the first |A| - ceil(t |A|) + 1 n-grams of A and those of B have one in common
(pigeonhole): these prefixes are the join keys, and no pair is missed, whatever its sizes. Any order is right; the one by
frequency (then by hash) leaves the common n-grams out of most prefixes and keeps the groups small. The n-grams of all texts
are counted for it, in a table of hashed places, so counts are never too low, and too high only by what shares a place. A
key that may be in more than HOT sets is cut into blocks of sets, and every two blocks meet apart.

Sets with a common key meet if |B| >= t |A|, and if enough n-grams are left from the key on in both (a pair that matches
has at least t / (1 + t) * (|A| + |B|) in common, none of them before its first common key). Each key carries the one before
it: where it is the same in both sets, they have met there already, so near copies meet once for each run of common n-grams.

Every set has a parity sketch: each n-gram toggles one of two to four bits an n-gram. The Hamming distance of two
sketches is at most the sets' symmetric difference, which J(A, B) >= t bounds by (1 - t) / (1 + t) * (|A| + |B|), so only
pairs that don't match are dropped. The rest is verified on the whole sets. For both steps pairs are dealt into blocks of
sets that have partners in common; a block gets each of its sketches or sets once, not once for every pair, and gives
the links of each set and a spanning forest, so the result never holds a row for each pair.

Defined results: every document (doc_id, distinct n-gram set) has one row. Rows with a null doc_id are left out; null and
wordless texts have no set, no links and are their own winner; texts of fewer than n words have one n-gram. Equal rows
count once. A doc_id with texts of several sets has a row for each of them. Ties don't matter. Extra columns are ignored.
Sets and n-grams are told apart by 64-bit hashes, keys before by 40 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import components, forest, own_columns, sized, written
from canopy.llm._text import give_back, grams, lean, mix, pieces, words

N = 3
THRESHOLD = 0.6
LEAST_BITS, MOST_BITS = 16, 24
SLICE_BITS = 20
PAIR_BLOCK = 1 << 18
HOT = 1 << 20
BLOCK_GRAMS = 1 << 21
BLOCK_PAIRS = 1 << 20
_U = np.uint64
_ZSTD = pa.Codec("zstd", compression_level=1)


def code(x: np.ndarray, up: bool) -> np.ndarray:
    """Numbers from 1 to 2^31 in 12 bits, rounded down or up by less than 1 / 128; larger numbers have larger codes."""
    e = np.frexp(x.astype(np.float64))[1] - 1
    down = e * 128 + np.floor(np.ldexp(x, 7 - e)).astype(np.int64) - 128
    return down + (decode(down) < x) if up else down


def decode(c: np.ndarray) -> np.ndarray:
    return np.ldexp(1 + (c & 127) / 128, c >> 7)


def prefix(t: float, size: np.ndarray) -> np.ndarray:
    """How many n-grams of a set are keys."""
    return np.minimum(size, size - np.ceil(t * size - 1e-9).astype(np.int64) + 1)


def set_ids(doc: np.ndarray, gram: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, 63-bit id) of each row's set; the id depends on the set alone."""
    size = np.bincount(doc, minlength=rows)
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(rows, _U)
    some = np.flatnonzero(size)
    if len(some):
        out[some] = mix(np.add.reduceat(mix(gram, 11), at[some]) ^ mix(np.bitwise_xor.reduceat(mix(gram, 12), at[some]), 3))
    return size, out >> _U(1)


def sketches(doc: np.ndarray, gram: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Parity sketches; their width is a power of two, and halves laid over each other make the next smaller width."""
    width = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(2 * size, 1)))).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(width >> 3)])
    bit = (mix(gram, 21) & (width[doc] - 1).astype(_U)).astype(np.int64) + 8 * at[doc]
    parity = (np.bincount(bit, minlength=8 * at[-1]) & 1).astype(np.uint8)
    data = np.packbits(parity, bitorder="little").tobytes()
    return [data[a:z] for a, z in zip(at.tolist(), at[1:].tolist())]


def spot(gram: np.ndarray, size: int) -> np.ndarray:
    """The place of each n-gram in a table of counts; size is a power of two."""
    return (mix(gram, 91) & _U(size - 1)).astype(np.int64)


def keys_of(doc: np.ndarray, gram: np.ndarray, size: np.ndarray, t: float, often: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, key, key before it or 0, its place, code of its count) of all rows; often: the code of each n-gram's count."""
    # the hashes of a row are in order already
    order = np.lexsort((often, doc))
    gram, often = gram[order], often[order]
    place = np.arange(len(gram)) - (np.cumsum(size) - size)[doc]
    before = np.zeros(len(gram), _U)
    before[1:] = gram[:-1] >> _U(24) | _U(1)
    before[place == 0] = 0
    keep = place < prefix(t, size)[doc]
    return doc[keep], gram[keep], before[keep], place[keep], often[keep]


def split(key: np.ndarray, sid: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which entry, key) with an entry of `rows` expected rows in each two of its ceil(rows / HOT) blocks."""
    blocks = np.maximum(1, -(-rows // HOT))
    if (blocks == 1).all():
        return np.arange(len(key)), key
    at = np.repeat(np.arange(len(key)), blocks)
    other = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    own = (mix(sid[at], 51) % blocks[at].astype(_U)).astype(np.int64)
    pair = np.minimum(own, other) << 32 | np.maximum(own, other)
    return at, np.where(blocks[at] > 1, mix(key[at] ^ mix(pair.astype(_U), 52), 53), key[at])


SIGNED = ["doc_id", "h", "sid", "size", "body"]


def _pack(counts_: np.ndarray) -> bytes:
    """A bit for each place, and the counts that aren't 0 as two planes of bytes, compressed."""
    some = np.flatnonzero(counts_)
    planes = np.ascontiguousarray(counts_[some].view(np.uint8).reshape(-1, 2).T).tobytes()
    return np.packbits(counts_ > 0).tobytes() + _ZSTD.compress(planes, asbytes=True)


def _unpack(body: bytes, places: int) -> np.ndarray:
    mask = np.unpackbits(np.frombuffer(body, np.uint8, places >> 3)).astype(bool)
    out = np.zeros(places, np.uint16)
    planes = np.frombuffer(_ZSTD.decompress(body[places >> 3 :], 2 * int(mask.sum()), asbytes=True), np.uint8)
    out[mask] = np.ascontiguousarray(planes.reshape(2, -1).T).view(np.uint16).ravel()
    return out


def _counted(table: np.ndarray) -> pa.RecordBatch:
    """A row for each slice of a table of counts that isn't empty, with its number as h and a size of -1."""
    parts = table.reshape(-1, min(len(table), 1 << SLICE_BITS))
    some = np.flatnonzero(parts.any(axis=1))
    none = pa.nulls(len(some), pa.int64())
    body = [_pack(parts[k]) for k in some.tolist()]
    return pa.RecordBatch.from_arrays([none, pa.array(some, pa.int64()), none, pa.array(np.full(len(some), -1), pa.int32()), pa.array(body, pa.binary())], names=SIGNED)


def _signed(n: int, bits: int):
    """A row for each document, and those of the counts of all that the task saw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, most = np.zeros(1 << bits, np.uint16), 0
        for batch in batches:
            for part in pieces(batch, 2):
                doc, gram = grams(words(part.column(2)), part.num_rows, n)
                size, sid = set_ids(doc, gram, part.num_rows)
                body = pa.array(sketches(doc, gram, size), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sid.view(np.int64)), pa.array(size, pa.int32()), body], names=SIGNED)
                if not len(gram):
                    continue
                at, count = np.unique(spot(gram, len(table)), return_counts=True)
                while len(at):  # no place goes beyond 16 bits
                    if most + min(int(count.max()), 1 << 15) >= 1 << 16:
                        yield _counted(table)
                        table[:], most = 0, 0
                    now = np.minimum(count, 1 << 15)
                    table[at] += now.astype(np.uint16)
                    most += int(now.max())
                    at, count = at[count > now], (count - now)[count > now]
        if most:
            yield _counted(table)

    return lean(run)


def _summed(bits: int):
    """(h, body) of some tasks' tables of one slice: their sum, in as many tables as 16 bits a place ask for."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(1 << min(bits, SLICE_BITS), np.int64)
        for body in rows.column("body"):
            total += _unpack(body.as_py(), len(total))
        body = []
        while total.any():
            now = np.minimum(total, (1 << 16) - 1).astype(np.uint16)
            body.append(_pack(now))
            total -= now
        return pa.table({"h": pa.array([key[0].as_py()] * len(body), pa.int64()), "body": pa.array(body, pa.binary())})

    return run


def _added(bits: int):
    """(part, codes) of one slice: 8 log2(count + 1) of all tasks' counts, rounded up."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(1 << min(bits, SLICE_BITS), np.int64)
        for body in rows.column("body"):
            total += _unpack(body.as_py(), len(total))
        codes = np.minimum(np.ceil(8 * np.log2(total + 1.0)), 255).astype(np.uint8)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "codes": pa.array([codes.tobytes()], pa.binary())})

    return run


def _keys(n: int, t: float, held):
    """held: the broadcast codes of the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = held.value
        for batch in batches:
            for part in pieces(batch, 2):
                doc, gram = grams(words(part.column(2)), part.num_rows, n)
                size, sid = set_ids(doc, gram, part.num_rows)
                row, key, before, place, often = keys_of(doc, gram, size, t, codes[spot(gram, len(codes))])
                at, key = split(key, sid[row], np.exp2(often / 8).astype(np.int64))
                rest = before << _U(24) | (code(size[row], False) << 12 | code(size[row] - place, True)).astype(_U)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, sid[row][at], rest[at])], names=["key", "sid", "rest"])

    return lean(run)


def _meet(t: float):
    """Pairs of sets with the same key, from rows in order of key; a key may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([np.asarray(c, dtype=np.int64) for c in batch.columns])
            if not rows.shape[1]:
                continue
            cut = int(np.searchsorted(rows[0], rows[0, -1]))
            if cut or (held and held[-1][0, -1] != rows[0, 0]):
                yield from _pairs(np.concatenate([*held, rows[:, :cut]], axis=1), t)
                held = []
            held.append(rows[:, cut:])
        if held:
            yield from _pairs(np.concatenate(held, axis=1), t)

    return lean(run)


def _pairs(rows: np.ndarray, t: float) -> Iterator[pa.RecordBatch]:
    """rows: key, sid, and key before with the codes of the size and of what is left; the rows of a key are all there."""
    alone = rows[0, 1:] != rows[0, :-1]
    ends = np.concatenate([[True], alone]) & np.concatenate([alone, [True]])
    rows = rows[:, ~ends[: rows.shape[1]]]
    size = rows[2] >> 12 & 4095
    rows = rows[:, order := np.lexsort((rows[1], size, rows[0]))]
    size = size[order]
    # copies have the same keys: one row for each set
    once = np.concatenate([[True], (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])])[: len(size)]
    (key, sid, rest), size = rows[:, once], size[once]
    before, low, left = rest >> 24, decode(size), decode(rest & 4095)
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])[: len(key)])
    most = np.minimum(code(decode(size + 1) / max(t, 1e-9) + 1e-6, True), 4095)
    high = np.searchsorted((group << 12) + size, (group << 12) + most, side="right")
    partners = high - np.arange(len(key)) - 1
    some = np.flatnonzero(partners)
    block = np.cumsum(partners[some]) // PAIR_BLOCK
    for mine in np.split(some, np.flatnonzero(np.diff(block)) + 1):
        if len(mine):
            n = partners[mine]
            i = np.repeat(mine, n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            new = (before[i] != before[j]) | (before[i] == 0)
            new &= np.minimum(left[i], left[j]) >= t / (1 + t) * (low[i] + low[j]) - 1e-6
            x, y = sid[i[new]], sid[j[new]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 2):
                doc, gram = grams(words(part.column(2)), part.num_rows, n)
                size, sid = set_ids(doc, gram, part.num_rows)
                at = np.concatenate([[0], np.cumsum(size)])
                sets = [gram[at[i] : at[i + 1]].tobytes() for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array(sid.view(np.int64)), pa.array(sets, pa.binary())], names=["sid", "body"])

    return lean(run)


def _held(pairs: pa.Table, bodies: pa.Table) -> tuple[np.ndarray, ...]:
    """(sids in order, their sizes, their bodies, place of a, place of b)."""
    bodies = bodies.sort_by("sid")
    sid = np.asarray(bodies.column("sid"))
    a, b = (np.asarray(pairs.column(c)) for c in ("a", "b"))
    return sid, np.asarray(bodies.column("size"), dtype=np.int64), bodies.column("body").to_pylist(), np.searchsorted(sid, a), np.searchsorted(sid, b)


def _near(t: float):
    """The pairs whose sketches don't rule out J >= t."""

    def run(pairs: pa.Table, bodies: pa.Table) -> pa.Table:
        sid, size, body, i, j = _held(pairs, bodies)
        width = np.array([len(x) for x in body], np.int64) >> 3
        narrow = np.minimum(width[i], width[j])
        apart = np.zeros(len(i), np.int64)
        for w in np.unique(narrow).tolist():
            mine = np.flatnonzero(narrow == w)
            used, at = np.unique(np.concatenate([i[mine], j[mine]]), return_inverse=True)
            table = np.stack([np.bitwise_xor.reduce(np.frombuffer(body[k], _U).reshape(-1, w), axis=0) for k in used.tolist()])
            x, y = at[: len(mine)], at[len(mine) :]
            for low in range(0, len(mine), step := max(1, (1 << 20) // w)):
                cut = slice(low, low + step)
                apart[mine[cut]] = np.bitwise_count(table[x[cut]] ^ table[y[cut]]).sum(axis=1)
        ok = apart <= np.floor((1 - t) / (1 + t) * (size[i] + size[j]) + 1e-9)
        found = pa.table({"a": pa.array(sid[i[ok]]), "b": pa.array(sid[j[ok]])})
        del body, i, j
        give_back()
        return found

    return run


def _verify(t: float):
    """(sid, root, links) of each set with J >= t in the block: root is the least set that the block connects it with."""

    def run(pairs: pa.Table, bodies: pa.Table) -> pa.Table:
        sid, size, body, i, j = _held(pairs, bodies)
        docs = np.asarray(bodies.sort_by("sid").column("n"), dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        gram = np.unique(np.frombuffer(b"".join(body), _U), return_inverse=True)[1]
        mark = np.zeros(int(gram.max()) + 1 if len(gram) else 0, bool)
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        ok = np.zeros(len(i), bool)
        heads = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, np.int64)
        for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(i)]):
            one = int(i[low])
            mine = gram[at[one] : at[one + 1]]
            mark[mine] = True
            step = max(1, min(256, PAIR_BLOCK // int(size[j[low:high]].max())))
            for a in range(low, high, step):
                two = j[a : min(high, a + step)]
                n = size[two]
                spots = np.arange(int(n.sum())) + np.repeat(at[two] - (np.cumsum(n) - n), n)
                same = np.add.reduceat(mark[gram[spots]].astype(np.int64), np.cumsum(n) - n)
                ok[a : a + len(two)] = same / (size[one] + n - same) >= t
            mark[mine] = False
        i, j = i[ok], j[ok]
        links = np.bincount(i, docs[j], len(sid)) + np.bincount(j, docs[i], len(sid))
        root = np.arange(len(sid))
        top, low_ = forest(i, j)
        root[low_] = top
        some = np.flatnonzero(links)
        found = pa.table({"sid": pa.array(sid[some]), "root": pa.array(sid[root[some]]), "links": pa.array(links[some].astype(np.int64))})
        del body, gram, mark, i, j
        give_back()
        return found

    return run


def table_bits(own: DataFrame) -> int:
    """Of the table of counts: about a place for each n-gram, as far as it stays within MOST_BITS."""
    whole = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(LEAST_BITS, (whole // 6).bit_length()), MOST_BITS)


def counts(tables: DataFrame, bits: int) -> np.ndarray:
    """The code of the count in each place of the table, from the rows (h, body) of all tasks.

    They are added in two steps, so that one task holds no more than about the root of the number of tables of a slice.
    """
    each = tables.groupBy("h").count().agg(F.max("count")).first()[0] or 0
    some = F.pmod(F.monotonically_increasing_id(), F.lit(max(1, math.ceil(math.sqrt(each)))))
    sums = tables.withColumn("some", some).groupBy("h", "some").applyInArrow(_summed(bits), "h long, body binary")
    found = sums.groupBy("h").applyInArrow(_added(bits), "part long, codes binary").toArrow()
    out = np.zeros(1 << bits, np.uint8)
    for part, codes in zip(found.column("part").to_pylist(), found.column("codes").to_pylist()):
        out[part << SLICE_BITS :][: len(codes)] = np.frombuffer(codes, np.uint8)
    return out


def _compared(pairs: DataFrame, bodies: DataFrame, judge, schema: str) -> DataFrame:
    """The table of judge over all pairs (a, b) with the bodies (sid, size, n, body) of both, in blocks.

    The home of a pair is the least set that is a or a partner of a, so sets with common partners share a home. Homes are
    dealt into buckets of about half of BLOCK_GRAMS n-grams and of BLOCK_PAIRS pairs; a home of more than a quarter of
    either has blocks of its own, cut by both sides of its pairs: near copies of one text have as many pairs as the square
    of their number, so their n-grams alone don't bound a block.
    """
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    homes = both.groupBy("a").agg(F.min("b").alias("home")).withColumn("home", F.least("a", "home"))
    placed = written(pairs.join(homes, "a"), "placed")
    need = placed.select("home", F.col("a").alias("sid")).unionByName(placed.select("home", F.col("b").alias("sid"))).distinct()
    weight = need.join(bodies.select("sid", "size"), "sid").groupBy("home").agg((F.sum("size") / BLOCK_GRAMS).alias("grams"))
    count = placed.groupBy("home").agg((F.count(F.lit(1)) / BLOCK_PAIRS).alias("pairs"))
    weight = written(weight.join(count, "home").withColumn("load", F.greatest("grams", "pairs")), "weights")
    buckets = max(1, math.ceil(2 * (weight.where("load <= 0.25").agg(F.sum("load")).first()[0] or 0)))
    cuts = F.ceil(F.greatest(2 * F.col("grams"), F.sqrt(2 * F.col("pairs")))).cast("int").alias("cuts")
    large = weight.where("load > 0.25").select("home", cuts)
    dealt = placed.join(sized(large), "home", "left")

    def side(c: str):
        return F.when(F.col("cuts").isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.col("cuts"))).cast("int")

    bucket = F.when(F.col("cuts").isNull(), F.pmod(F.xxhash64("home"), F.lit(buckets))).otherwise(F.col("home"))
    dealt = dealt.select("a", "b", bucket.alias("bucket"), side("a").alias("i"), side("b").alias("j"))
    block = ["bucket", "i", "j"]
    need = dealt.select(*block, F.col("a").alias("sid")).unionByName(dealt.select(*block, F.col("b").alias("sid"))).distinct()
    shipped = need.join(bodies, "sid").select(*[F.col(c).alias(f"to_{c}") for c in block], "sid", "size", "n", "body")
    out = dealt.groupBy(*block).cogroup(shipped.groupBy(*[f"to_{c}" for c in block])).applyInArrow(judge, schema)
    return written(out, "compared", (placed, weight, pairs))


def _search(docs: DataFrame, n: int, t: float) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows (doc_id, h, sid, size, body) of the documents, h a hash of the text; groups (sid, winner,
    n_links) of the sets that have a link or several doc_ids."""
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}).where("doc_id is not null")
    own = own.select("doc_id", F.xxhash64("text").alias("h"), "text")
    bits = table_bits(own)
    signed = written(own.mapInArrow(_signed(n, bits), "doc_id long, h long, sid long, size int, body binary"), "signed")
    held = docs.sparkSession.sparkContext.broadcast(counts(signed.where("size < 0").select("h", "body"), bits))
    signed = signed.where("size >= 0")
    members = signed.where("size > 0").groupBy("sid", "doc_id").agg(F.min("h").alias("h"), F.max("size").alias("size"))
    groups = members.groupBy("sid").agg(F.min(F.struct("doc_id", "h")).alias("rep"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    groups = written(groups.select("sid", F.col("rep.doc_id").alias("rep"), F.col("rep.h").alias("h"), "n", "size"), "groups")
    rest = signed.where("size > 0").join(groups.select("sid", "rep", F.col("h").alias("rep_h")), "sid").where("doc_id <> rep or h <> rep_h")
    rest = written(rest.select("doc_id", "h").distinct(), "copies")
    keyed = own.join(sized(rest), ["doc_id", "h"], "left_anti").select("doc_id", "h", "text")
    keyed = keyed.mapInArrow(_keys(n, t, held), "key long, sid long, rest long")
    met = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(t), "a long, b long")
    met = written(met.distinct(), "candidates")
    sketched = signed.join(groups.select("sid", F.col("rep").alias("doc_id"), "h", "n"), ["sid", "doc_id", "h"]).dropDuplicates(["sid"])
    near = _compared(met, sketched.select("sid", "size", "n", "body"), _near(t), "a long, b long")
    ids = near.select(F.col("a").alias("sid")).unionByName(near.select(F.col("b").alias("sid"))).distinct()
    few = written(groups.join(ids, "sid", "left_semi"), "matched")
    texts = own.join(sized(few.select(F.col("rep").alias("doc_id"), "h")), ["doc_id", "h"], "left_semi").select("doc_id", "h", "text")
    sets = texts.mapInArrow(_sets(n), "sid long, body binary").dropDuplicates(["sid"])
    sets = written(sets.join(few.select("sid", "size", "n"), "sid"), "sets")
    linked = _compared(near, sets, _verify(t), "sid long, root long, links long")
    classes = components(linked.select("sid", "root"), "sid", "root").withColumnsRenamed({"node": "sid", "component": "class"})
    links = linked.groupBy("sid").agg(F.sum("links").alias("links"))
    found = groups.join(classes, "sid", "left").join(links, "sid", "left").where("class is not null or n > 1")
    found = written(found.select("sid", "rep", F.coalesce("class", "sid").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "classes")
    winners = found.groupBy("class").agg(F.min("rep").alias("winner"))
    return signed, found.join(winners, "class").select("sid", "winner", "n_links")


def join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, winner, n_links) of every document: winner is the least doc_id of those that matching pairs connect with
    it, n_links the number of other documents with J >= threshold, copies included."""
    signed, groups = _search(docs, n, threshold)
    rows = signed.select("doc_id", F.when(F.col("size") > 0, F.col("sid")).alias("sid")).distinct()
    return rows.join(groups, "sid", "left").select("doc_id", F.coalesce("winner", "doc_id").alias("winner"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def remove_near_copies(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one document, that of the least doc_id, of each group that matching pairs connect.

    Rows with a null doc_id and texts without words stay, and so do all rows of the doc_id that stays.
    """
    signed, groups = _search(docs, n, threshold)
    gone = signed.where("size > 0").join(groups, "sid").where("doc_id <> winner").select(F.col("doc_id").alias("i"), F.col("h").alias("g"))
    gone = written(gone.distinct(), "near_copies")
    # extra columns can't clash with names inside one struct
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    key = (F.col("row.doc_id").cast("long") == F.col("i")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("g"))
    return rows.join(sized(gone), key, "left_anti").select("row.*")

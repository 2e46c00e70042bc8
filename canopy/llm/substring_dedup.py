"""Long repeated passages by compaction of a De Bruijn graph of words.

Runs of K words are the edges of the graph. An edge is repeated if it occurs at two places or more, in one document or
several; repeated edges that follow each other without a branch form a path, and a path's occurrences are the repeated
passages. A repeated passage of K or more words is thus covered by paths, whatever surrounds it.

1. In each document, edges are grouped under anchors: the run of ANCHOR words of the least hash within the edge. Equal
   edges have equal anchors, so only one row an anchor (about one for 16 words) is shuffled, with 32 bits an edge.
   Rows that are equal are first merged into one with a count, so copies don't pile up in memory.
2. Under each anchor edges are counted, and repeated edges joined without a branch (the edge of K + 1 words occurs as
   often as both) become segments. These go back to the documents by a join on a hash of (anchor, edges).
3. Joins of neighbouring segments in documents count their links. An unbranched link is found wherever one of its two
   segments is, so each document holds whole paths: a run of such links is one, under the name of its least segment.
4. Each occurrence is read again at its source: its words are digested whole, must equal those of the path's first
   occurrence, and get offsets in characters.

Defined results: words and case are as in _text; null, empty and short texts have no passage; rows with a null doc_id
are left out; rows with the same doc_id and text are one document. Passages that touch or overlap within a document
are separate rows if they belong to different paths. Ties don't matter: every occurrence is reported. Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.llm._store import own_columns, sized, written
from canopy.llm._text import lean, long_runs, mix, pieces, words

K = 50
ANCHOR = 20
_U = np.uint64
FOUND = "variant long, first array<int>, size array<int>, segment array<long>, copies array<long>"


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (the first of equals) of each `width` successive hashes."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    # least of doubling spans, then of two spans that cover the window
    value, place, span = grams, np.arange(len(grams)), 1
    while span * 2 <= width:
        right = value[span:] < value[:-span]
        value, place = np.where(right, value[span:], value[:-span]), np.where(right, place[span:], place[:-span])
        span *= 2
    if span < width:
        gap = width - span
        right = value[gap:] < value[:-gap]
        place = np.where(right, place[gap:], place[:-gap])
    return place[:n]


def _runs(k: int, anchor: int):
    """Rows (doc_id, h, pos, anchor, edges): edges pos, pos + 1, ... of a document have the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 2):
                w = words(part.column(2))
                b = w.bounds(part.num_rows)
                edges, grams = long_runs(w.hash, k), long_runs(w.hash, anchor)
                docs, pos, names, sizes, bodies = [], [], [], [], []
                for i in np.flatnonzero(np.diff(b) >= k):
                    a, n = int(b[i]), int(b[i + 1] - b[i]) - k + 1
                    at = anchors(grams[a : a + n + k - anchor], k - anchor + 1)
                    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                    docs.append(np.full(len(new), i))
                    pos.append(new)
                    names.append(grams[a + at[new]])
                    sizes.append(np.diff(np.concatenate([new, [n]])))
                    bodies.append((edges[a : a + n] >> _U(32)).astype(np.uint32))
                if not docs:
                    continue
                doc, ends = np.concatenate(docs), np.concatenate([[0], np.cumsum(4 * np.concatenate(sizes))])
                body = pa.py_buffer(np.concatenate(bodies).tobytes())
                packed = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), body])
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), pa.array(np.concatenate(pos), pa.int32()), pa.array(np.concatenate(names).view(np.int64)), packed],
                    names=["doc_id", "h", "pos", "anchor", "edges"],
                )

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FOUND of rows (anchor, edges, n, variant) in order of anchor; an anchor may go on in the next batch."""
    held, rest = None, iter(batches)
    batch = next(rest, None)
    while batch is not None:
        following = next(rest, None)
        table = pa.Table.from_batches([held, batch] if held is not None and held.num_rows else [batch]).combine_chunks()
        batch = table.to_batches()[0] if table.num_rows else batch
        name = np.asarray(batch.column(0))
        cut = len(name)
        if following is not None and len(name):
            cut = int(np.flatnonzero(name != name[-1])[-1]) + 1 if (name != name[-1]).any() else 0
        held = batch.slice(cut)
        out = _segments_of(batch.slice(0, cut))
        if out is not None:
            yield out
        batch = following


def _segments_of(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    name, times = np.asarray(batch.column(0)).view(_U), np.asarray(batch.column(2))
    if not len(name):
        return None
    many = np.concatenate([[False], name[1:] == name[:-1]])
    many |= np.concatenate([many[1:], [False]])
    keep = np.flatnonzero(many | (times > 1))
    if not len(keep):
        return None
    batch, name, times = batch.take(pa.array(keep)), name[keep], times[keep]
    col = batch.column(1)
    offs = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    edge = np.frombuffer(col.buffers()[2], np.uint8)[offs[0] : offs[-1]].tobytes()
    edge = np.frombuffer(edge, np.uint32).astype(_U)
    offs = (offs - offs[0]) // 4
    size = np.diff(offs)
    row = np.repeat(np.arange(len(name)), size)
    key = mix(name[row] ^ mix(edge, 31), 32)
    inner = np.flatnonzero(row[1:] == row[:-1])
    pair = mix(key[inner] * _U(3) ^ mix(key[inner + 1], 33), 34)

    def counted(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        head = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        sums = np.add.reduceat(weights[order], head) if len(s) else weights
        out = np.empty(len(keys), np.int64)
        out[order] = np.repeat(sums, np.diff(np.concatenate([head, [len(s)]])))
        return out

    count = counted(key, times[row])
    both = counted(pair, times[row[inner]])
    again = count > 1
    joined = np.zeros(len(key), bool)  # with the edge before it
    joined[inner + 1] = (both == count[inner]) & (both == count[inner + 1]) & again[inner]
    head = np.flatnonzero(again & ~joined)
    if not len(head):
        return None
    # a segment ends before the next edge that isn't joined
    stop = np.flatnonzero(~joined)
    nxt = np.searchsorted(stop, head, side="right")
    end = np.concatenate([stop, [len(key)]])[nxt]
    end = np.minimum(end, offs[row[head] + 1])
    segment = mix(key[head] ^ mix(key[end - 1], 35) ^ (end - head).astype(_U), 36)
    owner = row[head]
    rows, at = np.unique(owner, return_index=True)
    cuts = pa.array(np.concatenate([at, [len(owner)]]), pa.int32())

    def lists(x, kind):
        return pa.ListArray.from_arrays(cuts, pa.array(x, kind))

    picked = batch.take(pa.array(rows))
    return pa.RecordBatch.from_arrays(
        [picked.column(3), lists(head - offs[owner], pa.int32()), lists(end - head, pa.int32()), lists(segment.view(np.int64), pa.int64()), lists(count[head], pa.int64())],
        names=["variant", "first", "size", "segment", "copies"],
    )


def _read(k: int):
    """(path, doc_id, first, n, start, end, digest) of the occurrences `at` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                w = words(part.column(1))
                b = w.bounds(part.num_rows)
                first, last = w.chars() if len(w.start) else (w.start, w.end)
                out = []
                ids = part.column(0).to_pylist()
                for i, spots in enumerate(part.column(2).to_pylist()):
                    for spot in spots:
                        a = int(b[i]) + spot["pos"]
                        z = a + spot["size"] + k - 1
                        cover = w.data[w.start[a] : w.end[z - 1]].copy()
                        # only the words count: what lies between them becomes one space
                        own = np.zeros(len(cover) + 1, np.int64)
                        np.add.at(own, w.start[a:z] - w.start[a], 1)
                        np.add.at(own, w.end[a:z] - w.start[a], -1)
                        inside = np.cumsum(own[:-1]) > 0
                        gap = np.zeros(len(cover), bool)
                        gap[(w.end[a : z - 1] - w.start[a])] = True
                        cover[~inside] = 32
                        body = cover[inside | gap].tobytes()
                        out.append((spot["path"], ids[i], spot["pos"], z - a, int(first[a]), int(last[z - 1]), hashlib.blake2b(body, digest_size=16).digest()))
                names = ["path", "doc_id", "pos", "n_words", "start", "end", "digest"]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names=names)

    return run


def repeats(docs: DataFrame, k: int = K, anchor: int = ANCHOR) -> DataFrame:
    """(path, doc_id, first_word, n_words, start, end, source_doc, source_word, copies) of every repeated passage.

    start and end are offsets in characters, the end excluded. The source is the passage's first occurrence, in order
    of doc_id and place; copies counts all of them.
    """
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}).where("doc_id is not null and text is not null")
    own = own.select("doc_id", F.xxhash64("text").alias("h"), "text")
    twice = written(own.groupBy("doc_id", "h").count().where("count > 1").select("doc_id", "h"), "twice")
    if twice.count():
        same = ["doc_id", "h"]
        own = own.join(sized(twice), same, "left_anti").unionByName(own.join(sized(twice), same, "left_semi").dropDuplicates(same))
    runs = written(own.mapInArrow(lean(_runs(k, anchor)), "doc_id long, h long, pos int, anchor long, edges binary"), "runs")
    variant = F.xxhash64("anchor", "edges").alias("variant")
    # one shuffle by anchor serves the merging of equal rows and the comparison under each anchor
    variants = runs.select("anchor", "edges").repartition("anchor").groupBy("anchor", "edges").agg(F.count(F.lit(1)).alias("n"))
    found = variants.select("anchor", "edges", "n", variant).sortWithinPartitions("anchor").mapInArrow(lean(_segments), FOUND)
    found = written(found, "segments")
    rows = runs.select("doc_id", "h", "pos", variant).join(found, "variant").select("doc_id", "h", F.col("pos").alias("base"), F.explode(F.arrays_zip("first", "size", "segment", "copies")).alias("s"))
    spots = written(rows.select("doc_id", "h", (F.col("base") + F.col("s.first")).alias("pos"), F.col("s.size").alias("size"), F.col("s.segment").alias("segment"), F.col("s.copies").alias("copies")), "spots")
    in_doc = Window.partitionBy("doc_id", "h").orderBy("pos")
    after = spots.select("segment", "copies", (F.lead("pos").over(in_doc) == F.col("pos") + F.col("size")).alias("next"), F.lead("segment").over(in_doc).alias("to"), F.lead("copies").over(in_doc).alias("to_copies"))
    links = after.where("next and copies = to_copies").groupBy("segment", "to", "copies").agg(F.count(F.lit(1)).alias("n")).where("n = copies")
    named = spots.join(links.select("segment", "to"), "segment", "left")
    joined = (F.lag("to").over(in_doc) == F.col("segment")) & (F.lag(F.col("pos") + F.col("size")).over(in_doc) == F.col("pos"))
    island = F.sum(F.when(joined, 0).otherwise(1)).over(in_doc)
    # a link is at all places of both its segments: a run of them in a document is the whole path, the same wherever it is
    whole = named.withColumn("island", island).groupBy("doc_id", "h", "island").agg(F.min("segment").alias("path"), F.min("pos").alias("pos"), F.sum("size").cast("int").alias("size"))
    places = whole.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("pos", "size", "path"))).alias("at"))
    read = own.join(places, ["doc_id", "h"]).select("doc_id", "text", "at").mapInArrow(lean(_read(k)), "path long, doc_id long, pos int, n_words int, start int, end int, digest binary")
    read = written(read, "passages")
    # the same words, byte for byte, as the first occurrence of the path
    source = read.groupBy("path", "digest", "n_words").agg(F.min(F.struct("doc_id", "pos")).alias("source"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return read.join(source, ["path", "digest", "n_words"]).select(
        "path", "doc_id", F.col("pos").alias("first_word"), "n_words", "start", "end", F.col("source.doc_id").alias("source_doc"), F.col("source.pos").alias("source_word"), "copies"
    )

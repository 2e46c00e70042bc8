"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one for each shard.

Equal vectors are first made one. The distinct ones are dealt by hash into shards of about SHARD_ROWS. A shard's graph
has layers of geometrically falling size; a node is linked to diverse near nodes of its layer (a candidate is taken if
it is nearer to the node than to all taken before; places that are left go to the nearest others) and links go both
ways. As a shard is of bounded size, candidates are found by matrix products rather than by inserting nodes one by one.

The matrix products that give a node its candidates also give its matches in its own shard, exactly and without a beam;
where all candidates match, the row of products is looked at whole. So a vector is a query only to the graphs of the other
shards: descent through the upper layers, then a beam search below, for
many queries at a time. A query whose beam is full of matches is asked again with a beam of twice the width, so there is
no cap on partners. For each task and shard an audit comes first: AUDIT of the queries and AUDIT vectors planted just
within the threshold of nodes of the shard are answered by brute force too, and the beam is doubled until it finds RECALL
of all their matches. Matches are verified on the cosine in double precision; what a task connects leaves it as a
spanning forest, and the forests' union is contracted to components.

Queries are shipped as vectors to where a graph is, each once for each shard, and answered QUERIES at a time. A graph is
shipped in parts of PART_BYTES, and to several tasks only where there are fewer graphs than tasks that can run at once, so
what is shipped of graphs grows with the vectors and not with vectors times shards.

Defined results: vectors that are null, empty, zero or not finite match nothing; only vectors of the same length are
compared; rows with the same id and several vectors connect what each of them matches; a null id is left out. Extra
columns are ignored. An empty table gives an empty result. Ties don't matter.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import components, forest, own_columns, sized, written
from canopy.llm._text import mix

THRESHOLD = 0.9
SHARD_ROWS = 65536
LINKS = 12
CANDIDATES = 32
BEAM = 32
ENTRIES = 8
AUDIT = 128
RECALL = 0.98
LANES = 512
QUERIES = 16384
VERIFIED = 16384
PART_BYTES = 4 << 20
LANES_A_CORE = 4
STRIDE = 64


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def nearest(s: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, values) of the `want` largest of each row, in no order. They lie in as many strides at most, those of the
    largest maxima, so only these have to be looked at."""
    n, strides = s.shape[1], s.shape[1] // STRIDE
    cols = None
    if strides > 2 * want:
        most = s[:, : strides * STRIDE].reshape(len(s), strides, STRIDE).max(axis=2)
        top = np.argpartition(most, strides - want, axis=1)[:, strides - want :]
        cols = (top[:, :, None] * STRIDE + np.arange(STRIDE)).reshape(len(s), -1)
        rest = np.broadcast_to(np.arange(strides * STRIDE, n), (len(s), n - strides * STRIDE))
        cols = np.concatenate([cols, rest], axis=1)
        s = np.take_along_axis(s, cols, 1)
    part = np.argpartition(s, s.shape[1] - want, axis=1)[:, s.shape[1] - want :]
    return part if cols is None else np.take_along_axis(cols, part, 1), np.take_along_axis(s, part, 1)


class Graph:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, least: float | None = None):
        """least: what nodes that are at least so similar connect is gathered in `close`, as forests."""
        self.least, self.close = least, []
        with np.errstate(over="ignore"):
            narrow = vectors.astype(np.float32)
        self.ids, self.vectors = ids, narrow if (narrow == vectors).all() else vectors
        self.unit = unit(vectors).astype(np.float32)
        u = ((mix(ids.view(np.uint64), 41) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
        level = np.floor(-np.log(u) / np.log(LINKS)).astype(np.int64)
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []
        top = int(level.max()) if len(ids) else 0
        for at in range(top + 1):
            nodes = np.flatnonzero(level >= at)
            self.layers.append((nodes, self._links(nodes, LINKS * (2 if at == 0 else 1))))
        self.entry = int(np.flatnonzero(level == top)[0]) if len(ids) else 0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("unit", "close")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.unit = unit(self.vectors).astype(np.float32)

    def _links(self, nodes: np.ndarray, most: int) -> np.ndarray:
        """Neighbours of each of nodes, padded with the node itself."""
        x = self.unit[nodes]
        n = len(nodes)
        want = min(CANDIDATES, n - 1)
        links = np.tile(nodes[:, None].astype(np.int32), (1, most))
        if want <= 0:
            return links
        near, sims = np.empty((n, want), np.int32), np.empty((n, want), np.float32)
        for a in range(0, n, 128):
            s = x[a : a + 128] @ x.T
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -9
            part, value = nearest(s, want)
            if self.least is not None and n == len(self.ids):
                match = value >= self.least - 1e-4
                full = np.flatnonzero(match.all(axis=1))
                match[full] = False
                i, k = np.nonzero(match)
                f, c = np.nonzero(s[full] >= self.least - 1e-4)
                one, two = np.concatenate([i, full[f]]) + a, np.concatenate([part[i, k], c])
                self.close += self._verified(one[one < two], two[one < two])
            order = np.argsort(-value, axis=1, kind="stable")
            near[a : a + 128], sims[a : a + 128] = np.take_along_axis(part, order, 1), np.take_along_axis(value, order, 1)
        half = max(1, most // 2)
        taken, count = np.full((n, half), -1), np.zeros(n, np.int64)
        for r in range(want):
            open_ = np.flatnonzero(count < half)
            rival = np.full(len(open_), -9.0, np.float32)
            mine = x[near[open_, r]]
            for k in range(half):
                held = np.flatnonzero(count[open_] > k)
                if not len(held):
                    break
                rival[held] = np.maximum(rival[held], np.einsum("ij,ij->i", mine[held], x[taken[open_[held], k]]))
            ok = open_[sims[open_, r] > rival]
            taken[ok, count[ok]] = near[ok, r]
            count[ok] += 1
        # what is left goes to the nearest that were passed over, so that groups of near copies hang together
        for r in range(want):
            c = near[:, r]
            ok = np.flatnonzero((count < half) & ~(taken == c[:, None]).any(axis=1))
            taken[ok, count[ok]] = c[ok]
            count[ok] += 1
        # the way there and back; of too many, the nearest
        one, k = np.nonzero(taken >= 0)
        two = taken[one, k]
        # a chain through all nodes keeps the layer connected
        chain = np.arange(n - 1)
        a, b = np.concatenate([one, two, chain, chain + 1]), np.concatenate([two, one, chain + 1, chain])
        rank = np.concatenate([np.einsum("ij,ij->i", x[one], x[two])] * 2 + [np.full(n - 1, 2.0)] * 2)
        order = np.lexsort((-rank, a))
        a, b = a[order], b[order]
        first = np.searchsorted(a, a)
        place = np.arange(len(a)) - first
        keep = place < most
        links[a[keep], place[keep]] = nodes[b[keep]]
        return links

    def _verified(self, one: np.ndarray, two: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Forests of the pairs of nodes that match, some pairs at a time."""
        out = []
        for a in range(0, len(one), VERIFIED):
            i, k = one[a : a + VERIFIED], two[a : a + VERIFIED]
            ok = np.einsum("ij,ij->i", unit(self.vectors[i]), unit(self.vectors[k])) >= self.least
            if ok.any():
                out.append(forest(i[ok], k[ok]))
        return out

    def search(self, queries: np.ndarray, beam: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the best of each query, -1 where there are fewer than beam.

        own: the node that each query is itself, to begin there instead of descending.
        """
        if own is not None:
            return self._beam(queries, beam, own[:, None])
        return self._beam(queries, beam, self._descend(queries))

    def _descend(self, queries: np.ndarray) -> np.ndarray:
        """The best ENTRIES of the upper layers for each query."""
        q, n = len(queries), len(self.ids)
        # down through the layers, in each from the best ENTRIES of the layer above
        start = np.full((q, 1), self.entry)
        for nodes, links in self.layers[:0:-1]:
            where = np.full(n, 0)
            where[nodes] = np.arange(len(nodes))
            for _ in range(3):
                around = np.concatenate([start, links[where[start]].reshape(q, -1)], 1)
                around.sort(axis=1)
                s = np.einsum("qkd,qd->qk", self.unit[around], queries)
                s[:, 1:][around[:, 1:] == around[:, :-1]] = -9
                take = min(ENTRIES, around.shape[1])
                start = np.take_along_axis(around, np.argpartition(-s, take - 1, axis=1)[:, :take], 1)
        return start

    def _beam(self, queries: np.ndarray, beam: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, n = len(queries), len(self.ids)
        lanes = np.arange(q)
        start = np.sort(start, axis=1)[:, :beam]
        own = np.ones(start.shape, bool)
        own[:, 1:] = start[:, 1:] != start[:, :-1]
        links = self.layers[0][1]
        k = start.shape[1]
        ids, sims = np.full((q, beam), -1), np.full((q, beam), -9.0, np.float32)
        open_ = np.zeros((q, beam), bool)
        ids[:, :k], open_[:, :k] = start, own
        sims[:, :k] = np.where(own, np.einsum("qkd,qd->qk", self.unit[start], queries), -9)
        seen = np.zeros((q, n), bool)
        seen[lanes[:, None], start] = True
        wide = 4
        active = lanes
        while len(active):
            value = np.where(open_[active], sims[active], -9)
            pick = np.argpartition(-value, min(wide, beam) - 1, axis=1)[:, :wide]
            usable = np.take_along_axis(value, pick, 1) > -9
            open_[active[:, None], pick] = False
            from_ = np.where(usable, np.take_along_axis(ids[active], pick, 1), start[active][:, :1])
            around = links[from_].reshape(len(active), -1)
            around.sort(axis=1)
            fresh = ~seen[active[:, None], around]
            fresh[:, 1:] &= around[:, 1:] != around[:, :-1]
            seen[active[:, None], around] = True
            s = np.einsum("qkd,qd->qk", self.unit[around], queries[active])
            s = np.where(fresh, s, -9)
            all_ids = np.concatenate([ids[active], around], 1)
            all_sims = np.concatenate([sims[active], s], 1)
            all_open = np.concatenate([open_[active], fresh], 1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
            open_[active] = np.take_along_axis(all_open, top, 1) & (sims[active] > -9)
            active = active[open_[active].any(axis=1)]
        return np.where(sims > -9, ids, -1), sims


def near(graph: Graph, queries: np.ndarray, own: np.ndarray, beam: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of all found with a similarity of at least `least`; full beams are widened.

    own: the node of the graph that a query is, or -1.
    """
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rest = np.arange(len(queries))
    while len(rest):
        again = [np.zeros(0, np.int64)]
        inside, outside = rest[own[rest] >= 0], rest[own[rest] < 0]
        for part in [x[a : a + LANES] for x in (inside, outside) for a in range(0, len(x), LANES)]:
            if beam >= len(graph.ids):  # as wide as the shard
                i, k = np.nonzero(queries[part] @ graph.unit.T >= least)
                one.append(part[i])
                two.append(k)
                continue
            ids, sims = graph.search(queries[part], beam, own[part] if own[part[0]] >= 0 else None)
            ok = sims >= least
            full = ok.all(axis=1)
            again.append(part[full])
            ok[full] = False
            i, k = np.nonzero(ok)
            one.append(part[i])
            two.append(ids[i, k])
        rest, beam = np.concatenate(again), 2 * beam
    return np.concatenate(one), np.concatenate(two)


def planted(graph: Graph, count: int, least: float) -> np.ndarray:
    """Vectors just within the threshold of nodes of the graph."""
    rng = np.random.default_rng(len(graph.ids))
    x = graph.unit[rng.integers(0, len(graph.ids), count)].astype(np.float64)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    size = np.linalg.norm(away, axis=1, keepdims=True)
    c = min(1.0, least + 1e-3)
    return (c * x + np.sqrt(1 - c * c) * away / np.maximum(size, 1e-12)).astype(np.float32)


def audited_beam(graph: Graph, queries: np.ndarray, own: np.ndarray, least: float) -> int:
    """The narrowest beam that finds RECALL of the matches of audited queries and of planted ones."""
    audit, own = np.concatenate([queries, planted(graph, AUDIT, least)]), np.concatenate([own, np.full(AUDIT, -1)])
    true = int((audit @ graph.unit.T >= least).sum())
    beam = BEAM
    while beam < len(graph.ids) and len(near(graph, audit, own, beam, least)[0]) < RECALL * true:
        beam *= 2
    return beam


def matches(graph: Graph, queries: np.ndarray, names: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, node) of all that match, and the beam that the audit asked for."""
    slack = threshold - 1e-4
    exact = unit(queries)
    q = exact.astype(np.float32)
    # graph.ids are in order
    own = np.minimum(np.searchsorted(graph.ids, names), len(graph.ids) - 1)
    own = np.where(graph.ids[own] == names, own, -1)
    audit = np.argsort(mix(names.view(np.uint64), 43))[:AUDIT]
    beam = audited_beam(graph, q[audit], own[audit], slack)
    i, k = near(graph, q, own, beam, slack)
    ok = np.zeros(len(i), bool)
    for a in range(0, len(i), VERIFIED):
        cut = slice(a, a + VERIFIED)
        ok[cut] = np.einsum("ij,ij->i", exact[i[cut]], unit(graph.vectors[k[cut]])) >= threshold
    return i[ok], k[ok], beam


def within(graph: Graph) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the ids that match within the graph."""
    one, two = (np.concatenate([np.zeros(0, np.int64), *(pair[k] for pair in graph.close)]) for k in (0, 1))
    return forest(graph.ids[one], graph.ids[two])


def _build(threshold: float, alone: bool):
    """The graph of a shard in parts, unless it is the only one, and its links in parts below 0."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        size = key[0].as_py()
        vectors = np.asarray(table.column("vector").combine_chunks().flatten()).reshape(-1, size)
        graph = Graph(np.asarray(table.column("id")), vectors, threshold)
        links = np.stack(within(graph)).T.tobytes()
        body = b"" if alone else pickle.dumps(graph)
        parts = [(k, body[a : a + PART_BYTES]) for k, a in enumerate(range(0, len(body), PART_BYTES))]
        parts += [(-1 - k, links[a : a + PART_BYTES]) for k, a in enumerate(range(0, len(links), PART_BYTES))]
        n = len(parts)
        return pa.table({"size": pa.array([size] * n, pa.int32()), "shard": pa.array([key[1].as_py()] * n, pa.int64()), "part": pa.array([k for k, _ in parts], pa.int32()), "graph": pa.array([x for _, x in parts], pa.binary())})

    return run


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for body in batch.column(0):
            ab = np.frombuffer(body.as_py(), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])


def _query(threshold: float):
    """Rows (task, part, graph, id, vector) in order of tasks, the parts of a task's graph first: links between queries and nodes."""

    def answered(graph: Graph, ids: list[np.ndarray], vectors: list[np.ndarray]) -> pa.RecordBatch:
        names = np.concatenate(ids)
        i, k, _ = matches(graph, np.concatenate(vectors), names, threshold)
        a, b = forest(names[i], graph.ids[k])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph: Graph | None = None
        parts: list[bytes] = []
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        held = 0
        for batch in batches:
            part = np.asarray(batch.column(1).fill_null(-1))
            # a graph's parts, each alone, and the queries between them
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(part >= 0), np.flatnonzero(part >= 0) + 1, [len(part)]])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                if part[a] >= 0:
                    if ids:
                        yield answered(graph, ids, vectors)
                    graph, ids, vectors, held = None, [], [], 0
                    if part[a] == 0:
                        parts = []
                    parts.append(batch.column(2)[a].as_py())
                    continue
                if graph is None:
                    graph, parts = pickle.loads(b"".join(parts)), []
                while a < b:
                    z = min(b, a + QUERIES - held)
                    rows = batch.slice(a, z - a)
                    ids.append(np.asarray(rows.column(3)))
                    vectors.append(np.asarray(rows.column(4).flatten()).reshape(z - a, -1))
                    held += z - a
                    a = z
                    if held == QUERIES:
                        yield answered(graph, ids, vectors)
                        ids, vectors, held = [], [], 0
        if ids:
            yield answered(graph, ids, vectors)

    return run


def groups(embeddings: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, component) of every id that is connected with another, component the least id of the group."""
    own = own_columns(embeddings, {"id": F.col("vec_id").cast("long"), "vector": F.col("embedding").cast("array<double>")})
    fine = own.where("id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < 1e150) and exists(vector, x -> abs(x) > 1e-150)")
    distinct = written(fine.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")).withColumn("id", F.col("ids")[0]), "vectors")
    shards = max(1, -(-distinct.count() // shard_rows))
    size = F.size("vector").alias("size")
    dealt = distinct.select("id", "vector", size, F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("long").alias("shard"))
    graphs = written(dealt.groupBy("size", "shard").applyInArrow(_build(threshold, shards == 1), "size int, shard long, part int, graph binary"), "graphs")
    inner = graphs.where("part < 0").select("graph").mapInArrow(_links, "a long, b long")
    graphs = graphs.where("part >= 0")
    # of each length of vectors, as many tasks for each graph as its queries need, but together no more than keep all cores busy
    one = graphs.where("part = 0").select("size", "shard")
    lanes = max(1, -(-LANES_A_CORE * embeddings.sparkSession.sparkContext.defaultParallelism // max(1, one.count())))
    tasks = distinct.groupBy(size).agg(F.least(F.ceil(F.count(F.lit(1)) / QUERIES), F.lit(lanes)).cast("long").alias("tasks"))
    known = written(one.join(sized(written(tasks, "tasks")), "size"), "known")
    lane = F.pmod(F.xxhash64("id"), F.col("tasks")).alias("lane")
    home = F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("long").alias("home")
    asked = distinct.select("id", "vector", size, home).join(sized(known), "size").where("home <> shard").select(
        "size", "shard", lane, F.lit(None).cast("int").alias("part"), F.lit(None).cast("binary").alias("graph"), "id", "vector"
    )
    held = graphs.join(sized(known), ["size", "shard"]).select(
        "size", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("lane"), "part", "graph", F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("vector")
    )
    both = held.unionByName(asked).repartition("size", "shard", "lane").sortWithinPartitions("size", "shard", "lane", F.col("part").isNull(), "part", "id")
    task = F.concat_ws(":", "size", "shard", "lane").alias("task")
    links = written(both.select(task, "part", "graph", "id", "vector").mapInArrow(_query(threshold), "a long, b long"), "matches")
    links = links.unionByName(inner).unionByName(distinct.where("size(ids) > 1").select(F.col("id").alias("a"), F.explode("ids").alias("b")))
    return components(links.where("a <> b"), "a", "b").select(F.col("node").alias("vec_id"), "component")

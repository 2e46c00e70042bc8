"""Resharding by minimum-cost flow.

The old shards are the values of a column, with the bytes of their texts; the new shards are 0..n-1 with capacities,
and old shard i (in order of value) is at home in new shard i, if there is one. A flow from old sizes into new
capacities, where staying at home costs nothing and every byte moved costs 1 (or what `cost` says), of least cost is
found by successive shortest paths on the graph of shards, whose size doesn't depend on the number of documents.

The flow is then made of blocks: each old shard has its documents in order of a hash key, and running sums (of hash
buckets first, so that a shard of any size needs no single task) turn amounts of flow into ranges of keys. The
document across a border goes to its home or, without room there, where there is most room. So bytes moved differ
from the optimum by at most one document for each border. New shards that lose or get a block are rewritten; the rest
is left as it is.

Defined results: null and empty texts have 0 bytes and are assigned like others; a null shard is the shard "(none)";
rows with the same doc_id and text move together. Capacities below the total are an error. An empty table gives an
empty result. rewrite() keeps all columns of docs; of its own columns old_shard, new_shard, bytes and moved, those
of docs with the same names are replaced.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.llm._store import new_path, sized, written

NEW_SHARDS = 24
HEADROOM = 1.02
FILE_BYTES = 128 << 20
MOST_PARTS = 100_000
SEED = "shard"


def least_cost_flow(supply: list[int], room: list[int], cost: list[list[float]]) -> list[list[int]]:
    """Amounts from each supply into each room, of least total cost; all of the supply is placed.

    Successive shortest paths with potentials; costs are not negative.
    """
    if sum(supply) > sum(room):
        raise ValueError("the capacities are less than the data")
    s, r = len(supply), len(room)
    left, free = list(supply), list(room)
    flow = [[0] * r for _ in range(s)]
    pot = [0.0] * (s + r)
    while any(left):
        dist, prev = [math.inf] * (s + r), [-1] * (s + r)
        heap = []
        for i in range(s):
            if left[i]:
                dist[i] = 0.0
                heap.append((0.0, i))
        done = [False] * (s + r)
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if done[u]:
                continue
            done[u] = True
            if u < s:
                steps = [(s + j, cost[u][j]) for j in range(r)]
            else:
                steps = [(i, -cost[i][u - s]) for i in range(s) if flow[i][u - s]]
            for v, c in steps:
                nd = d + max(0.0, c + pot[u] - pot[v])
                if nd < dist[v] - 1e-12:
                    dist[v], prev[v] = nd, u
                    heapq.heappush(heap, (nd, v))
        ends = [j for j in range(r) if free[j] and dist[s + j] < math.inf]
        end = min(ends, key=lambda j: (dist[s + j] + pot[s + j], j))
        path, v = [], s + end
        while prev[v] >= 0:
            path.append((prev[v], v))
            v = prev[v]
        amount = min([left[v], free[end]] + [flow[b][a - s] for a, b in path if a >= s])
        for a, b in path:
            if a < s:
                flow[a][b - s] += amount
            else:
                flow[b][a - s] -= amount
        left[v] -= amount
        free[end] -= amount
        far = max(x for x in dist if x < math.inf)
        pot = [p + min(d, far) for p, d in zip(pot, dist)]
    return flow


@dataclass
class Plan:
    shards: list[str]
    capacities: list[int]
    flow: list[list[int]]
    #: of each shard, (first key, new shard) in order of keys
    ranges: list[list[tuple[str, int]]] = field(default_factory=list)

    def affected(self) -> set[int]:
        """The new shards whose files must be written: they lose or get a block, or have no old file."""
        out = set()
        for i, ranges in enumerate(self.ranges):
            for _, j in ranges:
                if j != i:
                    out |= {i, j}
        return {j for j in out if j < len(self.capacities)}

    def moved(self) -> int:
        return sum(x for i, row in enumerate(self.flow) for j, x in enumerate(row) if i != j)


OWN = ("old_shard", "new_shard", "bytes", "moved")


def _keyed(docs: DataFrame, shard: str) -> DataFrame:
    """(row, old_shard, bytes, key): extra columns can't clash with names inside one struct."""
    h = F.coalesce(F.xxhash64("text").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), h))
    return docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.coalesce(F.col(f"`{shard}`").cast("string"), F.lit("(none)")).alias("old_shard"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"), key.alias("key"),
    )


def solve(docs: DataFrame, shard: str = "source", capacities: list[int] | None = None, cost: list[list[float]] | None = None) -> Plan:
    """The plan of transfers; what reaches the driver are sizes of shards and one key for each border."""
    spark = docs.sparkSession
    own = _keyed(docs, shard).groupBy("old_shard", "key").agg(F.sum("bytes").alias("bytes"))
    own = written(own.withColumn("bucket", F.conv(F.substring("key", 1, 4), 16, 10).cast("int")), "sizes")
    sizes = {r["old_shard"]: r["bytes"] for r in own.groupBy("old_shard").agg(F.sum("bytes").alias("bytes")).orderBy("old_shard").collect()}
    names, supply = list(sizes), list(sizes.values())
    if capacities is None:
        capacities = [math.ceil(sum(supply) * HEADROOM / NEW_SHARDS)] * NEW_SHARDS
    if cost is None:
        cost = [[0.0 if i == j else 1.0 for j in range(len(capacities))] for i in range(len(names))]
    plan = Plan(names, capacities, least_cost_flow(supply, capacities, cost))
    # quotas in order: home first, then by number
    quotas = [[(j, row[j]) for j in sorted(range(len(row)), key=lambda j: (j != i, j)) if row[j]] for i, row in enumerate(plan.flow)]
    borders = []
    for i, quota in enumerate(quotas):
        at = 0
        for n, (_, amount) in enumerate(quota[:-1]):
            at += amount
            borders.append((names[i], n, at))
    found = {}
    if borders:
        by = Window.partitionBy("old_shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        base = own.groupBy("old_shard", "bucket").agg(F.sum("bytes").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(by), F.lit(0)))
        inner = Window.partitionBy("old_shard", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        at = own.withColumn("inner", F.coalesce(F.sum("bytes").over(inner), F.lit(0))).join(base.select("old_shard", "bucket", "base"), ["old_shard", "bucket"])
        at = at.select("old_shard", "key", "bytes", (F.col("base") + F.col("inner")).alias("a"))
        few = sized(spark.createDataFrame(borders, "old_shard string, n int, at long"))
        hit = at.where("bytes > 0").join(few, "old_shard").where("a <= at and at < a + bytes")
        found = {(r["old_shard"], r["n"]): r for r in hit.select("old_shard", "n", "at", "key", "bytes", "a").collect()}
    used = [sum(plan.flow[i][j] for i in range(len(names))) for j in range(len(capacities))]
    loose: dict[tuple[int, str], list] = {}
    for i, quota in enumerate(quotas):
        ranges = [("", quota[0][0] if quota else i if i < len(capacities) else 0)]
        for n, (j, _) in enumerate(quota[1:]):
            row = found[names[i], n]
            before = quota[n][0]
            if row["at"] == row["a"]:
                ranges.append((row["key"], j))
                continue
            used[before] -= row["at"] - row["a"]
            used[j] -= min(row["bytes"] - (row["at"] - row["a"]), quota[n + 1][1])
            loose.setdefault((i, row["key"]), [row["bytes"], len(ranges)])
            ranges += [(row["key"], -1), (row["key"] + "!", j)]
        plan.ranges.append(ranges)
    for (i, _), (size, at_) in sorted(loose.items(), key=lambda x: -x[1][0]):
        best = i if i < len(capacities) and used[i] + size <= capacities[i] else max(range(len(capacities)), key=lambda j: capacities[j] - used[j])
        used[best] += size
        key = plan.ranges[i][at_][0]
        plan.ranges[i] = [(k, best if k == key and j == -1 else j) for k, j in plan.ranges[i]]
    return plan


def _placed(docs: DataFrame, plan: Plan, shard: str) -> DataFrame:
    """(row, old_shard, new_shard, bytes, moved, key)"""
    rows = [(name, i, [k for k, _ in plan.ranges[i]], [j for _, j in plan.ranges[i]]) for i, name in enumerate(plan.shards)]
    table = sized(docs.sparkSession.createDataFrame(rows, "old_shard string, home int, starts array<string>, to array<int>"))
    place = F.element_at("to", F.size(F.filter("starts", lambda k: k <= F.col("key")))).alias("new_shard")
    found = _keyed(docs, shard).join(table, "old_shard").select("row", "old_shard", place, "bytes", "key", "home")
    return found.withColumn("moved", F.col("new_shard") != F.col("home")).drop("home")


def _flat(placed: DataFrame, columns: list[str]) -> DataFrame:
    return placed.select(*[F.col(f"row.`{c}`") for c in columns if c not in OWN], *OWN)


def assign(docs: DataFrame, plan: Plan, shard: str = "source") -> DataFrame:
    """docs with old_shard, new_shard, bytes and moved."""
    return _flat(_placed(docs, plan, shard), docs.columns)


def rewrite(docs: DataFrame, plan: Plan, shard: str = "source", path: str | None = None) -> DataFrame:
    """Writes the affected new shards, a folder each, and gives all rows, of these from the new files."""
    spark = docs.sparkSession
    path = path or new_path(spark, "shards")
    placed = _placed(docs, plan, shard)
    rows = _flat(placed, docs.columns)
    hit = sorted(plan.affected())
    if not hit:
        return rows
    files = max(1, -(-max(plan.capacities) // FILE_BYTES))
    # a partition for each file, by its number: hashes of few numbers would put several of them into one
    parts = min(files * len(plan.capacities), MOST_PARTS)
    file = F.col("new_shard") * files + F.pmod(F.xxhash64("key"), F.lit(files)).cast("int")
    changed = placed.where(F.col("new_shard").isin(hit)).repartitionById(parts, F.pmod(file, F.lit(parts)).cast("int"))
    _flat(changed, docs.columns).write.option("compression", "zstd").partitionBy("new_shard").parquet(path)
    return spark.read.schema(rows.schema).parquet(path).select(*[f"`{c}`" for c in rows.columns]).unionByName(rows.where(~F.col("new_shard").isin(hit)))


def reshard(docs: DataFrame, shard: str = "source", capacities: list[int] | None = None) -> DataFrame:
    """(doc_id, old_shard, new_shard, bytes, moved) of every row, after the affected files are rewritten."""
    return rewrite(docs, solve(docs, shard, capacities), shard).select(F.col("doc_id").cast("long"), "old_shard", "new_shard", "bytes", "moved")

"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule is the golden-ratio point frac(i * 0.618...) (as an integer lattice of 2^31 points), and the
source whose stretch of the cumulative weights holds the point gets the slot. Within a source, slots are ranked, and
slot rank r takes block r: tokens r * block_tokens up to (r + 1) * block_tokens of the source's documents in shuffled
order, around and around, so that every slot has exactly block_tokens tokens. Any stretch of the schedule is within a
few slots of the target weights. A token is a longest run of characters that aren't white space.

Positions in a source are sums over ALL its documents: sums of 65,536 hash buckets, then running sums in each bucket,
so that a source of any size needs no single task; ranks of slots are made alike from chunks of slots. Of each source one
row, its name and tokens, reaches the driver.

Without given weights a source's weight is its tokens to the power 0.75. Without a given length the schedule is long
enough for every document to occur once; sources above their share of the data then occur once, the others repeat.

Defined results: a null source is the source "(none)"; null, empty and blank texts have no tokens and no segment, and
keep() lets them stay once. Rows that repeat, even wholly, are separate documents. Sources of weight 0 and sources
without tokens get no slot. Empty tables give empty results. Extra columns are ignored by schedule() and kept by mix(),
whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopy.llm._store import own_columns, sized, written

BLOCK_TOKENS = 4096
SEED = "mix"
LATTICE = 1 << 31
GOLDEN = 1327217885  # odd, nearest to 2^31 * 0.6180339887
CHUNK = 4096
SPARE = 4


def token_count(text: str):
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def places(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(source, doc_id, id, tokens, a): a is the token at which each document begins in its source."""
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "source": F.coalesce("source", F.lit("(none)")), "text": "text"})
    own = own.select(
        "source", "doc_id", F.xxhash64("text").alias("h"), token_count("text").alias("tokens"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
    )
    own = written(own.withColumn("bucket", F.conv(F.substring("key", 1, 4), 16, 10).cast("int")), "tokens")
    by = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = own.groupBy("source", "bucket").agg(F.sum("tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(by), F.lit(0)))
    inner = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "tokens", "h").rowsBetween(Window.unboundedPreceding, -1)
    at = own.withColumn("inner", F.coalesce(F.sum("tokens").over(inner), F.lit(0)))
    same = Window.partitionBy("source", "bucket", "doc_id", "h").orderBy("key")
    return (
        at.withColumn("copy", F.row_number().over(same))
        .join(base.select("source", "bucket", "base"), ["source", "bucket"])
        .select("source", "doc_id", "h", "copy", "tokens", (F.col("base") + F.col("inner")).alias("a"))
    )


def plan(totals: dict[str, int], weights: dict[str, float] | None, block: int, slots: int | None) -> tuple[list[tuple[str, int]], int]:
    """([(source, end of its stretch of the lattice)], number of slots)."""
    totals = {s: n for s, n in sorted(totals.items()) if n}
    if weights is None:
        share = {s: math.floor(math.sqrt(n) * math.sqrt(math.sqrt(n))) for s, n in totals.items()}
    else:
        share = {s: math.floor(weights.get(s, 0) * (1 << 40)) for s in totals}
    share = {s: x for s, x in share.items() if x > 0}
    whole = sum(share.values())
    if not whole:
        return [], 0
    if slots is None:
        slots = max(-(-(-(-totals[s] // block) + SPARE) * whole // share[s]) for s in share)
    ends, cum = [], 0
    for s, x in share.items():
        cum += x
        ends.append((s, cum * LATTICE // whole))
    return ends, slots


def slots_of(spark: SparkSession, ends: list[tuple[str, int]], slots: int) -> DataFrame:
    """(slot, source, rank) of the whole schedule."""
    if not slots:
        return spark.createDataFrame([], "slot long, source string, rank long")
    point = (F.col("id") % LATTICE) * GOLDEN % LATTICE
    # a point is looked up among the sources whose stretches touch its cell of the lattice, of which there are few
    width = LATTICE >> min(31, (4 * len(ends) - 1).bit_length())
    lows = [0, *(e for _, e in ends[:-1])]
    stretches = spark.createDataFrame([(s, low, e) for (s, e), low in zip(ends, lows) if e > low], "source string, low long, high long")
    cells = F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    stretches = stretches.withColumn("cell", cells)
    made = spark.range(slots).withColumn("point", point).withColumn("cell", F.floor(F.col("point") / width)).join(sized(stretches), "cell")
    made = made.where("low <= point and point < high").select(F.col("id").alias("slot"), "source", F.floor(F.col("id") / CHUNK).alias("chunk"))
    by = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = made.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(by), F.lit(0)))
    inner = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    return (
        made.withColumn("inner", inner)
        .join(base.select("source", "chunk", "base"), ["source", "chunk"])
        .select("slot", "source", (F.col("base") + F.col("inner")).alias("rank"))
    )


def _prepared(docs: DataFrame, weights: dict[str, float] | None, block: int, slots: int | None, seed: str):
    spark = docs.sparkSession
    at = written(places(docs, seed), "places")
    totals = {r["source"]: r["n"] for r in at.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    ends, n = plan(totals, weights, block, slots)
    schedule = written(slots_of(spark, ends, n), "slots")
    sums = schedule.groupBy("source").agg((F.count(F.lit(1)) * block).alias("used"))
    known = spark.createDataFrame([(s, totals[s]) for s, _ in ends], "source string, total long")
    # one row for each source
    sums = sized(written(sums.join(known, "source"), "sums"))
    epochs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("used") - 1 - F.col("a")) / F.col("total"))))
    rounds = at.where("tokens > 0").join(sums, "source").where("a < used").select("*", epochs.alias("epoch"))
    return at, schedule, rounds.withColumn("begin", F.col("a") + F.col("epoch") * F.col("total"))


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block_tokens: int = BLOCK_TOKENS, slots: int | None = None, seed: str = SEED) -> DataFrame:
    """(slot, source, rank, doc_id, epoch, from_token, tokens): the segments of documents that fill each slot.

    from_token is the first of the segment within its document.
    """
    _, order, rounds = _prepared(docs, weights, block_tokens, slots, seed)
    b = F.lit(block_tokens)
    first, last = F.floor(F.col("begin") / b), F.floor((F.least(F.col("begin") + F.col("tokens"), F.col("used")) - 1) / b)
    cut = rounds.select("source", "doc_id", "epoch", "begin", "tokens", F.explode(F.sequence(first, last)).alias("rank"))
    low = F.greatest("begin", F.col("rank") * b)
    high = F.least(F.col("begin") + F.col("tokens"), (F.col("rank") + 1) * b)
    return cut.select("source", "rank", "doc_id", "epoch", (low - F.col("begin")).alias("from_token"), (high - low).alias("tokens")).join(
        order, ["source", "rank"]
    ).select("slot", "source", "rank", "doc_id", "epoch", "from_token", "tokens")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_tokens: int = BLOCK_TOKENS, slots: int | None = None, seed: str = SEED) -> DataFrame:
    """The rows of docs in the order of the schedule, each whole where its first token is due, once an epoch.

    The partitions, and the rows in them, are in order of slots. Documents without tokens come first, once each.
    """
    at, order, rounds = _prepared(docs, weights, block_tokens, slots, seed)
    b = F.lit(block_tokens)
    due = rounds.select("doc_id", "h", "copy", "source", F.floor(F.col("begin") / b).alias("rank"), "begin").join(order, ["source", "rank"])
    due = due.select("source", "doc_id", "h", "copy", "slot", "begin").unionByName(
        at.where("tokens = 0").select("source", "doc_id", "h", "copy", F.lit(-1).cast("long").alias("slot"), F.lit(0).cast("long").alias("begin"))
    )
    due = due.select(*[F.col(c).alias(f"due_{c}") for c in due.columns])
    # extra columns can't clash with names inside one struct
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(F.col("text").cast("string")).alias("own_hash"),
        F.coalesce("source", F.lit("(none)")).alias("own_source"), F.lit(1).alias("nth"),
    )
    twice = written(at.where("copy > 1").select(F.col("doc_id").alias("d"), F.col("h").alias("g")).distinct(), "twice")
    if twice.count():
        is_ = F.col("own_id").eqNullSafe(F.col("d")) & (F.col("own_hash") == F.col("g"))
        nth = F.row_number().over(Window.partitionBy("own_id", "own_hash", "own_source").orderBy("nth"))
        again = rows.join(sized(twice), is_, "left_semi").withColumn("nth", nth)
        rows = rows.join(sized(twice), is_, "left_anti").unionByName(again)
    own = F.col("own_id").eqNullSafe(F.col("due_doc_id")) & (F.col("own_hash") == F.col("due_h")) & (F.col("nth") == F.col("due_copy"))
    mixed = rows.join(due, own & (F.col("own_source") == F.col("due_source")))
    return mixed.repartitionByRange("due_slot", "due_begin").sortWithinPartitions("due_slot", "due_begin").select("row.*")

"""Change events: (seq, op, table, new, old, txid), new and old maps of columns to text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPS = ("INSERT", "UPDATE", "DELETE", "TRUNCATE")
EVENT = "seq long, op string, table string, new map<string,string>, old map<string,string>, txid long"
_LINE = r"^table\s+\"?(\w+)\"?\.\"?(\w+)\"?:\s+(INSERT|UPDATE|DELETE|TRUNCATE):\s*(.*)$"
_PAIR = r"\"?(\w+)\"?\[[^\]]*(?:\[\])?\]:('(?:[^']|'')*'|\S+)"


def parse_log(lines: DataFrame, column: str = "line") -> DataFrame:
    """Adds op, schema, table, new and old to log lines; transaction bounds and messages are left out."""
    line = F.col(column)
    rest = F.regexp_extract(line, _LINE, 4)
    has_old = rest.startswith("old-key:")
    old = F.when(has_old, F.regexp_extract(rest, r"^old-key:\s*(.*?)\s*new-tuple:", 1))
    new = F.when(has_old, F.regexp_extract(rest, r"new-tuple:\s*(.*)$", 1)).otherwise(rest)

    def value(v: Column) -> Column:
        quoted = v.startswith("'") & v.endswith("'")
        inner = F.replace(F.substring(v, F.lit(2), F.length(v) - 2), F.lit("''"), F.lit("'"))
        return F.when(v == "null", F.lit(None)).when(quoted, inner).otherwise(v)

    def pairs(text: Column) -> Column:
        names = F.regexp_extract_all(text, F.lit(_PAIR), F.lit(1))
        return F.map_from_arrays(names, F.transform(F.regexp_extract_all(text, F.lit(_PAIR), F.lit(2)), value))

    op = F.regexp_extract(line, _LINE, 3)
    parsed = lines.where(line.rlike(_LINE)).withColumns(
        {"op": op, "schema": F.regexp_extract(line, _LINE, 1), "table": F.regexp_extract(line, _LINE, 2), "__new": pairs(new), "__old": pairs(old)}
    )
    gone = F.col("op") == "DELETE"
    return parsed.withColumns({"new": F.when(~gone, F.col("__new")), "old": F.when(gone, F.col("__new")).otherwise(F.col("__old"))}).drop("__new", "__old")


def log_events(log: DataFrame) -> DataFrame:
    """EVENT rows of a log (lsn, xid, line): seq is the position, txid the transaction."""
    return parse_log(log, "line").select(F.col("lsn").alias("seq"), "op", "table", "new", "old", F.col("xid").cast("string").cast("long").alias("txid"))


def within(rows: DataFrame, column: str, low: int | None, high: int | None) -> DataFrame:
    """Rows whose transaction is at least low and below high; 0 is a bound like others."""
    if low is not None:
        rows = rows.where(F.col(column) >= low)
    return rows if high is None else rows.where(F.col(column) < high)


def committed(log: DataFrame) -> DataFrame:
    """Log rows of transactions whose COMMIT is in the log; the others wait for it."""
    done = log.where(F.col("line").startswith("COMMIT")).select("xid").distinct()
    return log.join(done, "xid", "left_semi")


def captured(rows: DataFrame, table: str, keys: list[str], watched: list[str] | None = None) -> DataFrame:
    """What a row trigger would emit for rows (op, new, old) of structs: only key columns, and an UPDATE only if one of
    the watched columns changed (all of them without a list)."""
    fields = watched or rows.schema["new"].dataType.fieldNames()
    kept = rows.where((F.col("op") != "UPDATE") | changed("new", "old", fields))

    def picked(c: str) -> Column:
        values = [x for k in sorted(keys) for x in (F.lit(k), F.col(c)[k].cast("string"))]
        return F.when(F.col(c).isNotNull(), F.create_map(*values)).alias(c)

    return kept.select("op", F.lit(table).alias("table"), picked("new"), picked("old"))


def notifications(messages: DataFrame, index: str, schemas: list[str], column: str = "payload") -> DataFrame:
    """EVENT rows of JSON messages {tg_op, table, schema, new, old, xmin, indices}; bad JSON and messages for other
    indices or schemas are left out. seq is the message's place in `seq`."""
    kind = "struct<tg_op:string,table:string,schema:string,new:map<string,string>,old:map<string,string>,xmin:long,indices:array<string>>"
    got = messages.select("seq", F.from_json(column, kind).alias("m")).where("m.tg_op is not null")
    got = got.where(F.array_contains("m.indices", index) & F.col("m.schema").isin(schemas))
    return got.select("seq", F.col("m.tg_op").alias("op"), F.col("m.table").alias("table"), F.col("m.new").alias("new"), F.col("m.old").alias("old"), F.col("m.xmin").alias("txid"))


def binlog_events(rows: DataFrame) -> DataFrame:
    """EVENT rows of a binlog (file, pos, kind, table, before, after); rotations and other kinds are left out.

    Files are in order of the number at the end of their names.
    """
    ops = F.create_map(*[F.lit(x) for x in ("write", "INSERT", "update", "UPDATE", "delete", "DELETE")])
    number = F.regexp_extract("file", r"(\d+)$", 1).cast("long")
    known = rows.where(F.col("kind").isin("write", "update", "delete"))
    return known.select((F.shiftleft(number, 40) + F.col("pos")).alias("seq"), ops[F.col("kind")].alias("op"), "table", F.col("after").alias("new"), F.col("before").alias("old"), F.lit(None).cast("long").alias("txid"))


def named(values: Column, columns: list[str]) -> Column:
    """A row whose keys are all UNKNOWN_COLn gets the names of its columns by place, @n beyond them; others stay."""
    names = F.array(*[F.lit(c) for c in columns])
    keys = F.map_keys(values)
    place = lambda k: F.regexp_extract(k, r"^UNKNOWN_COL(\d+)$", 1)
    renamed = F.transform_keys(values, lambda k, _: F.coalesce(F.get(names, place(k).cast("int")), F.concat(F.lit("@"), place(k))))
    return F.when(F.forall(keys, lambda k: place(k) != ""), renamed).otherwise(values)


def tuple_id(page: Column, row: Column) -> Column:
    """The text of a physical place."""
    return F.concat(F.lit("("), page.cast("string"), F.lit(","), row.cast("string"), F.lit(")"))


def page_and_row(place: Column) -> list[Column]:
    bare = F.replace(F.replace(place, F.lit("("), F.lit("")), F.lit(")"), F.lit(""))
    return [F.split_part(bare, F.lit(","), F.lit(n)).cast("int").alias(c) for n, c in ((1, "page"), (2, "row"))]


def after(rows: DataFrame, place: list[str], last: tuple) -> DataFrame:
    """Rows beyond the last one done, in order of place: where a scan goes on."""
    return rows.where(F.struct(*place) > F.struct(*[F.lit(x) for x in last]))


def in_places(rows: DataFrame, place: list[str], blocks: DataFrame) -> DataFrame:
    """Rows at the places of blocks."""
    return rows.join(blocks.select(*place).distinct(), place, "left_semi")


def uuid_equals(column: Column, value: str) -> Column:
    """Equality with a UUID; false, not an error, for a text that is none."""
    ok = re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", value)
    return F.lower(column) == value.lower() if ok else F.lit(False)


def lock_key(name: Column) -> Column:
    """A stable 60-bit number of a name."""
    return F.conv(F.left(F.sha2(name, 256), F.lit(15)), 16, 10).cast("long")


def data(op: str = "op") -> Column:
    """The row of an event: the old one of a deletion if it is there, else the new one."""
    return F.when(F.col(op) == "DELETE", F.coalesce("old", "new")).otherwise(F.col("new"))


def changed(new: str, old: str, columns: list[str]) -> Column:
    """Whether any of the columns differs between two structs, nulls being equal."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{new}.{c}").eqNullSafe(F.col(f"{old}.{c}"))
    return out


def only_known(events: DataFrame, tables: set[str], views: dict[str, str] | None = None) -> DataFrame:
    """Events of known tables, with those of base tables retargeted to their view."""
    if views:
        renamed = F.create_map(*[F.lit(x) for kv in views.items() for x in kv])
        events = events.withColumn("table", F.coalesce(renamed[F.col("table")], F.col("table")))
    return events.where(F.col("table").isin(sorted(tables)))


def run_groups(events: DataFrame, order: list[str], by: list[str], within: list[str] | None = None) -> DataFrame:
    """Adds `run`: consecutive events that are equal in `by` have the same number.

    A total order of all events takes one task unless `within` names a partition, such as a log's shard.
    """
    w = Window.partitionBy(*(within or [])).orderBy(*order)
    new = F.lit(False)
    for c in by:
        new = new | ~F.lag(c).over(w).eqNullSafe(F.col(c))
    return events.withColumn("run", F.sum(new.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def insert_groups(events: DataFrame) -> DataFrame:
    """(table, n, first, last) of a batch of insertions alone: their order doesn't matter, so tables are the only groups."""
    return events.groupBy("table").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), F.max("seq").alias("last"))


def latest(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last event of each key."""
    columns = [c for c in events.columns if c not in keys]
    top = F.max_by(F.struct(*columns), F.struct(*order))
    return events.groupBy(*keys).agg(top.alias("__x")).select(*keys, "__x.*")


def checkpoint(events: DataFrame, current: int) -> int:
    """One below the least transaction seen, or below the current one if that is less."""
    least = events.agg(F.min("txid")).first()[0]
    return min(current, current if least is None else least) - 1


def visible(events: DataFrame, below: int, in_progress: list[int]) -> tuple[DataFrame, DataFrame]:
    """(events to process, events to hold back): those of later or open transactions, or of none, wait."""
    ok = F.coalesce((F.col("txid") < below) & ~F.col("txid").isin(in_progress or [-1]), F.lit(False))
    return events.where(ok), events.where(~ok)


def visibility(spark: SparkSession, txids: list[int], below: int, in_progress: list[int]) -> DataFrame:
    """(place, txid, ready) of asked transactions, in the order asked."""
    asked = spark.createDataFrame([(txids,)], "t array<long>").select(F.posexplode("t").alias("place", "txid"))
    return asked.withColumn("ready", (F.col("txid") < below) & ~F.col("txid").isin(in_progress or [-1])).orderBy("place")


def high_water(events: DataFrame) -> int | None:
    """The last transaction of a batch."""
    return events.agg(F.max("txid")).first()[0]


def blocks(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Adds `block`: rows in order of the key, `size` to a block, without a task that orders them all.

    Rows are ranged by key into partitions, counted there, and numbered from the sums of the partitions before.
    """
    ranged = rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("__p", F.spark_partition_id())
    mine = Window.partitionBy("__p").orderBy(key)
    counts = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))
    # one row for each partition
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = ranged.withColumn("__r", F.row_number().over(mine) - 1).join(base.select("__p", "base"), "__p")
    return numbered.withColumn("block", F.floor((F.col("base") + F.col("__r")) / size)).drop("__p", "__r", "base")

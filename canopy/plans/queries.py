"""Queries over the tables of a scale folder, with equal SQL for DuckDB.

Documents are compared as JSON text of integers and strings; arrays are in order of the children's keys.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions import jsonpath, plugins
from canopy.operators import changes, resolve, search
from canopy.plans import catalog
from canopy.plans.compile import as_json, compile, doc_keys
from canopy.plans.spec import parse
from canopy.plans.views import View
from canopy.sources import log, scratch
from canopy.sources.sinks import ParquetSink, actions, mapping
from canopy.streaming.sync import Sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _node(table: str, columns: list[str], *children: dict, rel: str | None = None, **more: Any) -> dict:
    """rel: `o2m` or `o2o`, with :scalar and @join_table where wanted."""
    out: dict[str, Any] = {"table": table, "columns": columns, "children": list(children), **more}
    if rel:
        kind, _, through = rel.partition("@")
        kind, _, variant = kind.partition(":")
        out["relationship"] = {"type": {"o2m": "one_to_many", "o2o": "one_to_one"}[kind], "variant": variant or "object", "through_tables": [through] if through else []}
    return out


def _docs(spark: SparkSession, sf_dir: str, nodes: dict, **args) -> DataFrame:
    """(_id, doc)"""
    got = as_json(compile(parse({"index": "x", "nodes": nodes}), catalog.of_folder(spark, sf_dir), **args))
    return got.select("_id", F.col("_source").alias("doc"))


_ORDERS = "(SELECT o_custkey, list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus} ORDER BY o_orderkey) AS v FROM orders GROUP BY 1)"


@_query("SELECT n_nationkey::VARCHAR AS _id, to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey})::VARCHAR AS doc FROM nation")
def doc_root_columns(spark, sf_dir):
    return _docs(spark, sf_dir, _node("nation", []))


@_query(f"""SELECT c_custkey::VARCHAR AS _id, to_json({{'c_name': c_name, 'nation_label': {{'n_name': n_name}}, 'orders': o.v}})::VARCHAR AS doc
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN {_ORDERS} o ON o.o_custkey = c_custkey""")
def doc_o2m_object(spark, sf_dir):
    return _docs(spark, sf_dir, _node("customer", ["c_name"], _node("nation", ["n_name"], rel="o2o", label="nation_label"), _node("orders", ["o_orderkey", "o_orderstatus"], rel="o2m")))


@_query("""SELECT c_custkey::VARCHAR AS _id, to_json({'c_name': c_name, 'orders': o.v})::VARCHAR AS doc FROM customer LEFT JOIN
(SELECT o_custkey, list(o_orderpriority ORDER BY o_orderkey) AS v FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def doc_o2m_scalar(spark, sf_dir):
    return _docs(spark, sf_dir, _node("customer", ["c_name"], _node("orders", ["o_orderpriority"], rel="o2m:scalar")))


@_query("SELECT s_suppkey::VARCHAR AS _id, to_json({'s_name': s_name, 'nation': CASE WHEN n_nationkey IS NOT NULL THEN {'n_nationkey': n_nationkey, 'n_name': n_name} END})::VARCHAR AS doc FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def doc_o2o_object(spark, sf_dir):
    return _docs(spark, sf_dir, _node("supplier", ["s_name"], _node("nation", ["n_nationkey", "n_name"], rel="o2o")))


@_query("SELECT o_orderkey::VARCHAR AS _id, to_json({'o_orderstatus': o_orderstatus, 'buyer': c_name})::VARCHAR AS doc FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def doc_o2o_scalar(spark, sf_dir):
    return _docs(spark, sf_dir, _node("orders", ["o_orderstatus"], _node("customer", ["c_name"], rel="o2o:scalar", label="buyer")))


@_query("""SELECT d.doc_id::VARCHAR AS _id, to_json({'source': source, 'labels': CASE WHEN l.doc_id IS NOT NULL THEN {'quality': quality, 'toxic': toxic} END})::VARCHAR AS doc
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def doc_null_child(spark, sf_dir):
    return _docs(spark, sf_dir, _node("documents", ["source"], _node("labels", ["quality", "toxic"], rel="o2o")))


@_query(f"""WITH c AS (SELECT c_nationkey, list({{'c_custkey': c_custkey, 'orders': o.v}} ORDER BY c_custkey) AS v FROM customer LEFT JOIN {_ORDERS} o ON o_custkey = c_custkey GROUP BY 1),
n AS (SELECT n_regionkey, list({{'n_name': n_name, 'customer': c.v}} ORDER BY n_nationkey) AS v FROM nation LEFT JOIN c ON c_nationkey = n_nationkey GROUP BY 1)
SELECT r_regionkey::VARCHAR AS _id, to_json({{'r_name': r_name, 'nations': n.v}})::VARCHAR AS doc FROM region LEFT JOIN n ON n_regionkey = r_regionkey""")
def doc_deep_nested(spark, sf_dir):
    orders = _node("orders", ["o_orderkey", "o_orderstatus"], rel="o2m")
    customers = _node("customer", ["c_custkey"], orders, rel="o2m")
    return _docs(spark, sf_dir, _node("region", ["r_name"], _node("nation", ["n_name"], customers, rel="o2m", label="nations")))


_THROUGH = "SELECT o_orderkey::VARCHAR AS _id, to_json({{'o_orderstatus': o_orderstatus, 'part': v}})::VARCHAR AS doc FROM orders LEFT JOIN (SELECT l_orderkey, list({0}) AS v FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1) ON l_orderkey = o_orderkey"


@_query(_THROUGH.format("{'p_partkey': p_partkey, 'p_brand': p_brand} ORDER BY p_partkey"))
def doc_through_object(spark, sf_dir):
    return _docs(spark, sf_dir, _node("orders", ["o_orderstatus"], _node("part", ["p_partkey", "p_brand"], rel="o2m@lineitem")))


@_query(_THROUGH.format("p_brand ORDER BY p_partkey"))
def doc_through_scalar(spark, sf_dir):
    return _docs(spark, sf_dir, _node("orders", ["o_orderstatus"], _node("part", ["p_brand"], rel="o2m:scalar@lineitem")))


@_query(_THROUGH.format("{'p_brand': p_brand} ORDER BY p_partkey"))
def doc_through_first_column(spark, sf_dir):
    return _docs(spark, sf_dir, _node("orders", ["o_orderstatus"], _node("part", ["p_brand", "p_size"], rel="o2o@lineitem")))


@_query("SELECT conv_id || '|' || turn AS _id, to_json({'role': role})::VARCHAR AS doc FROM conversations")
def doc_composite_id(spark, sf_dir):
    return _docs(spark, sf_dir, _node("conversations", ["role"]))


@_query("""SELECT o_orderkey::VARCHAR AS _id, to_json({'o_orderkey': o_orderkey, 'brands': b, 'sizes': s})::VARCHAR AS doc FROM orders LEFT JOIN
(SELECT l_orderkey, list(p_brand ORDER BY p_partkey) AS b, list(p_size ORDER BY p_partkey) AS s FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1) ON l_orderkey = o_orderkey""")
def doc_two_labels(spark, sf_dir):
    twice = [_node("part", [c], rel="o2m:scalar@lineitem", label=n) for c, n in (("p_brand", "brands"), ("p_size", "sizes"))]
    return _docs(spark, sf_dir, _node("orders", ["o_orderkey"], *twice))


@_query("""SELECT a.n_nationkey::VARCHAR AS _id, to_json({'n_name': a.n_name, 'neighbours': list(b.n_name ORDER BY b.n_nationkey)})::VARCHAR AS doc
FROM nation a JOIN nation b ON b.n_regionkey = a.n_regionkey GROUP BY a.n_nationkey, a.n_name""")
def doc_self_join(spark, sf_dir):
    child = _node("nation", ["n_name"], rel="o2m:scalar", label="neighbours")
    child["relationship"]["foreign_key"] = {"parent": ["n_regionkey"], "child": ["n_regionkey"]}
    return _docs(spark, sf_dir, _node("nation", ["n_name"], child))


_CUSTOMER = _node("customer", ["c_name"], _node("nation", ["n_name"], rel="o2o"), _node("orders", ["o_orderkey"], rel="o2m"))
_KEYS_SQL = """SELECT 'customer' AS "table", 'c_custkey' AS key, c_custkey::VARCHAR AS value, c_custkey::VARCHAR AS _id FROM customer
UNION ALL SELECT 'nation', 'n_nationkey', n_nationkey::VARCHAR, c_custkey::VARCHAR FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'orders', 'o_orderkey', o_orderkey::VARCHAR, c_custkey::VARCHAR FROM customer JOIN orders ON o_custkey = c_custkey"""


def _customers(spark, sf_dir):
    return parse({"index": "customers", "nodes": _CUSTOMER}), catalog.of_folder(spark, sf_dir)


@_query(f"""SELECT _id, list_sort(list("table" || '.' || key || '=' || value)) AS keys FROM ({_KEYS_SQL}) GROUP BY _id""")
def doc_meta_keys(spark, sf_dir):
    got = compile(*_customers(spark, sf_dir))
    return got.select("_id", F.array_sort(F.transform("_keys", lambda k: F.concat(k["table"], F.lit("."), k["key"], F.lit("="), k["value"]))).alias("keys"))


@_query(f"""SELECT "table", key, value, _id FROM ({_KEYS_SQL}) WHERE "table" = 'nation' AND value IN ('3', '7')""")
def doc_keys_lookup(spark, sf_dir):
    asked = spark.createDataFrame([("nation", "n_nationkey", "3"), ("nation", "n_nationkey", "7")], "table string, key string, value string")
    return doc_keys(compile(*_customers(spark, sf_dir))).join(F.broadcast(asked), ["table", "key", "value"]).select("table", "key", "value", "_id")


@_query("SELECT event_id::VARCHAR AS _id, to_json({'event_id': event_id, 'props_k': props->>'$.k'})::VARCHAR AS doc FROM events")
def json_path_props(spark, sf_dir):
    return _docs(spark, sf_dir, _node("events", ["event_id", "props->>'k'"]))


@_query("SELECT n_nationkey::VARCHAR AS _id, to_json({'id': n_nationkey, 'n_name': n_name})::VARCHAR AS doc FROM nation")
def rename_fields(spark, sf_dir):
    return _docs(spark, sf_dir, _node("nation", ["n_nationkey", "n_name"], transform={"rename": {"n_nationkey": "id"}}))


@_query("SELECT n_nationkey::VARCHAR AS _id, to_json({'n_name': replace(replace(n_name, 'A', 'a-'), '-', '_')})::VARCHAR AS doc FROM nation")
def replace_chain(spark, sf_dir):
    return _docs(spark, sf_dir, _node("nation", ["n_name"], transform={"replace": {"n_name": {"A": "a-", "-": "_"}}}))


@_query("""SELECT n_nationkey::VARCHAR AS _id, to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'tag': concat_ws(':', 'nation', CASE WHEN n_nationkey <> 0 THEN n_nationkey::VARCHAR END, n_name),
'again': concat_ws('/', concat_ws(':', 'nation', CASE WHEN n_nationkey <> 0 THEN n_nationkey::VARCHAR END, n_name), 'x')})::VARCHAR AS doc FROM nation""")
def concat_literals(spark, sf_dir):
    rules = [{"columns": ["nation", "n_nationkey", "n_name"], "delimiter": ":", "destination": "tag"}, {"columns": ["tag", "x"], "delimiter": "/", "destination": "again"}]
    return _docs(spark, sf_dir, _node("nation", ["n_nationkey", "n_name"], transform={"concat": rules}))


@_query("SELECT n_nationkey::VARCHAR AS _id, to_json({'name': replace(n_name, 'A', 'a'), 'tag': concat_ws('-', replace(n_name, 'A', 'a'), 'n_name')})::VARCHAR AS doc FROM nation")
def transform_order(spark, sf_dir):
    rules = {"replace": {"n_name": {"A": "a"}}, "rename": {"n_name": "name"}, "concat": {"columns": ["name", "n_name"], "delimiter": "-", "destination": "tag"}}
    return _docs(spark, sf_dir, _node("nation", ["n_name"], transform=rules))


@_query(f"""SELECT c_custkey::VARCHAR AS _id, to_json({{'c_name': c_name, 'orders': o.v}})::VARCHAR AS doc FROM customer LEFT JOIN {_ORDERS} o ON o_custkey = c_custkey WHERE c_acctbal < 0""")
def key_filter_docs(spark, sf_dir):
    keys = _t(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return _docs(spark, sf_dir, _node("customer", ["c_name"], _node("orders", ["o_orderkey", "o_orderstatus"], rel="o2m")), root_keys=keys)


@_query("SELECT event_id::VARCHAR AS _id, to_json({'event_type': event_type})::VARCHAR AS doc FROM events WHERE event_id >= 100 AND event_id < 900")
def tx_window_docs(spark, sf_dir):
    return _docs(spark, sf_dir, _node("events", ["event_type"]), tx=("event_id", 100, 900))


@_query("""SELECT event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS p, lag(value) OVER w AS v, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
WHERE n > 1 AND (event_type IS DISTINCT FROM p)""")
def changed_column_filter(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    both = _t(spark, sf_dir, "events").select("event_id", "event_type", F.struct("event_type", "value").alias("new"), F.lag(F.struct("event_type", "value")).over(w).alias("old"))
    return both.where(F.col("old").isNotNull() & changes.changed("new", "old", ["event_type"])).select("event_id", "event_type")


@_query("""SELECT event_id, sum(CASE WHEN event_type IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS run
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)""")
def run_grouping(spark, sf_dir):
    return changes.run_groups(_t(spark, sf_dir, "events"), ["event_id"], ["event_type"], ["user_id"]).select("event_id", "run")


@_query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def latest_state(spark, sf_dir):
    return changes.latest(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@_query("SELECT event_type AS \"table\", count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY 1")
def insert_fast_path(spark, sf_dir):
    return changes.insert_groups(_as_events(spark, sf_dir))


def _as_events(spark, sf_dir):
    """The rows of events as insertions into tables named by their type."""
    return _t(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.lit("INSERT").alias("op"), F.col("event_type").alias("table"),
        F.create_map(F.lit("event_id"), F.col("event_id").cast("string"), F.lit("user_id"), F.col("user_id").cast("string")).alias("new"),
        F.lit(None).cast("map<string,string>").alias("old"), F.col("event_id").alias("txid"),
    )


def _events(spark, rows):
    return spark.createDataFrame(rows, changes.EVENT)


def _affected(spark, sf_dir, rows):
    spec, tables = _customers(spark, sf_dir)
    return resolve.resolve(_events(spark, rows), spec, tables, doc_keys(compile(spec, tables)))


@_query("SELECT '5' AS _id UNION SELECT '77' UNION SELECT c_custkey::VARCHAR FROM customer WHERE c_nationkey = 4")
def affected_roots_insert(spark, sf_dir):
    rows = [(1, "INSERT", "customer", {"c_custkey": "5"}, None, 1), (2, "INSERT", "orders", {"o_orderkey": "-1", "o_custkey": "77"}, None, 2), (3, "INSERT", "nation", {"n_nationkey": "4", "n_regionkey": "1"}, None, 3)]
    return _affected(spark, sf_dir, rows)[1].select("_id")


@_query("SELECT o_custkey::VARCHAR AS _id FROM orders WHERE o_orderkey = 8 UNION SELECT '12' UNION SELECT '13'")
def affected_roots_update(spark, sf_dir):
    return _affected(spark, sf_dir, [(1, "UPDATE", "orders", {"o_orderkey": "8", "o_custkey": "12"}, {"o_orderkey": "8", "o_custkey": "13"}, 1)])[1].select("_id")


@_query("SELECT 'delete' AS what, '9' AS _id UNION SELECT 'again', o_custkey::VARCHAR FROM orders WHERE o_orderkey = 8")
def affected_roots_delete(spark, sf_dir):
    gone, again = _affected(spark, sf_dir, [(1, "DELETE", "customer", None, {"c_custkey": "9"}, 1), (2, "DELETE", "orders", None, {"o_orderkey": "8"}, 2)])
    return gone.select(F.lit("delete").alias("what"), "_id").unionByName(again.select(F.lit("again").alias("what"), "_id"))


@_query("SELECT c_custkey::VARCHAR AS _id FROM customer")
def truncate_child(spark, sf_dir):
    return _affected(spark, sf_dir, [(1, "TRUNCATE", "orders", None, None, 1)])[1].select("_id")


@_query("SELECT 'delete' AS what, '15' AS _id UNION SELECT 'again', '16'")
def rekey_actions(spark, sf_dir):
    gone, again = _affected(spark, sf_dir, [(1, "UPDATE", "customer", {"c_custkey": "16"}, {"c_custkey": "15"}, 1)])
    return gone.select(F.lit("delete").alias("what"), "_id").unionByName(again.select(F.lit("again").alias("what"), "_id"))


@_query("SELECT event_id, event_id < 500 AND event_id NOT IN (7, 8) AS ready FROM events")
def late_holdback(spark, sf_dir):
    ready, held = changes.visible(_t(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("txid")), 500, [7, 8])
    return ready.select("event_id", F.lit(True).alias("ready")).unionByName(held.select("event_id", F.lit(False).alias("ready")))


@_query("SELECT least(min(event_id), 1000) - 1 AS checkpoint FROM events")
def checkpoint_value(spark, sf_dir):
    return spark.createDataFrame([(changes.checkpoint(_t(spark, sf_dir, "events").withColumnRenamed("event_id", "txid"), 1000),)], "checkpoint long")


_KEYS_OF = """(VALUES ('region', ['r_regionkey'], []), ('nation', ['n_nationkey'], ['n_regionkey']), ('customer', ['c_custkey'], ['c_nationkey']),
('supplier', ['s_suppkey'], ['s_nationkey']), ('part', ['p_partkey'], []), ('orders', ['o_orderkey'], ['o_custkey']), ('lineitem', [], ['l_orderkey', 'l_partkey', 'l_suppkey']),
('events', ['event_id'], []), ('documents', ['doc_id'], []), ('labels', ['doc_id'], ['doc_id']), ('conversations', ['conv_id', 'turn'], []), ('embeddings', ['vec_id'], []),
('pages', ['page_id'], []), ('benchmark', ['item_id'], [])) AS k(table_name, primary_keys, foreign_keys)"""


@_query(f"""SELECT table_name, CASE WHEN table_name = 'lineitem' THEN ['l_linenumber', 'l_orderkey'] ELSE primary_keys END AS primary_keys, foreign_keys,
(SELECT list(column_name ORDER BY column_index) FROM duckdb_columns() c WHERE c.table_name = k.table_name) AS columns FROM {_KEYS_OF}""")
def key_catalog_union(spark, sf_dir):
    view = catalog.of_folder(spark, sf_dir).key_view(spark)
    more = view.where("table_name = 'lineitem'").withColumn("primary_keys", F.array(F.lit("l_orderkey"), F.lit("l_linenumber")))
    return catalog.united(view, more)


@_query("SELECT table_name, column_name FROM duckdb_columns() WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'labels', 'conversations', 'embeddings', 'pages', 'benchmark')")
def catalog_columns(spark, sf_dir):
    return catalog.of_folder(spark, sf_dir).columns(spark).select("table_name", "column_name")


@_query(f"SELECT table_name, len(primary_keys) + len(foreign_keys) AS n, list_sort(list_concat(primary_keys, foreign_keys)) AS columns FROM {_KEYS_OF}")
def table_constraints(spark, sf_dir):
    got = catalog.of_folder(spark, sf_dir).constraints(spark).groupBy("table_name")
    return got.agg(F.count(F.lit(1)).cast("long").alias("n"), F.sort_array(F.collect_list("column_name")).alias("columns"))


@_query("""SELECT c_custkey AS id, left(c_name, 1) || '***@example.org' AS email, '***' || right(lpad(c_custkey::VARCHAR, 10, '0'), 4) AS phone, left(sha256(c_custkey::VARCHAR), 16) AS user_id, '[REDACTED]' AS secret FROM customer""")
def mask_fields(spark, sf_dir):
    own = _t(spark, sf_dir, "customer").select(
        F.struct(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("@example.org")).alias("email"), F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("phone"), F.col("c_custkey").alias("user_id"), F.col("c_name").alias("secret")).alias("_source")
    )
    return plugins.run(own, ["Masking"]).select("_source.*")


@_query("SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_type), '[\\s_]+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-') AS slug FROM part")
def slug_fields(spark, sf_dir):
    own = _t(spark, sf_dir, "part").select("p_partkey", F.struct(F.col("p_type").alias("title")).alias("_source"))
    return plugins.run(own, ["Slug"]).select("p_partkey", F.col("_source.slug").alias("slug"))


@_query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN [p_size, p_size + 1] END AS coordinates FROM part")
def geo_point(spark, sf_dir):
    kind = F.when(F.col("p_size") % 2 == 0, "Point").otherwise("Polygon")
    shape = F.struct(kind.alias("type"), F.array(F.col("p_size"), F.col("p_size") + 1).alias("coordinates"))
    own = _t(spark, sf_dir, "part").select("p_partkey", F.struct(shape.alias("geometry")).alias("_source"))
    return plugins.run(own, ["Geometry"]).select("p_partkey", F.col("_source.coordinates").alias("coordinates"))


@_query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '9999-12-31 23:59:59' WHEN o_orderstatus = 'P' THEN '0001-01-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS day FROM orders")
def infinity_dates(spark, sf_dir):
    s = F.col("o_orderstatus")
    day = F.when(s == "F", "infinity").when(s == "P", "-infinity").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    own = _t(spark, sf_dir, "orders").select("o_orderkey", F.struct(day.alias("publish_date")).alias("_source"))
    return plugins.run(own, ["Infinity"]).select("o_orderkey", F.date_format("_source.publish_date", "yyyy-MM-dd HH:mm:ss").alias("day"))


@_query("SELECT p_partkey, regexp_replace(p_name, '(idg)', '<em>\\1</em>', 'gi') AS shown FROM part WHERE p_name ILIKE '%idg%'")
def ngram_search(spark, sf_dir):
    found = _t(spark, sf_dir, "part").where(search.matches(["p_name"], "idg"))
    return found.select("p_partkey", search.highlight("p_name", "idg").alias("shown"))


@_query("""SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)) + 1, 6) AS score
FROM embeddings ORDER BY 2 DESC, 1 LIMIT 10""")
def cosine_topk(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    query = e.where("vec_id = 0").first()["embedding"]
    return search.top_by_cosine(e, "embedding", query, 10, "vec_id").withColumn("score", F.round("score", 6))


@_query("SELECT event_id, 'UPDATE' AS op, 'events' AS \"table\", event_type AS new_type, user_id::VARCHAR AS old_user FROM events")
def log_line_parse(spark, sf_dir):
    line = F.concat(F.lit("table public.events: UPDATE: old-key: user_id[bigint]:"), "user_id", F.lit(" new-tuple: event_id[bigint]:"), "event_id", F.lit(" event_type[text]:'"), "event_type", F.lit("' value[double precision]:null"))
    got = changes.parse_log(_t(spark, sf_dir, "events").select("event_id", line.alias("line")))
    return got.select("event_id", "op", "table", F.col("new")["event_type"].alias("new_type"), F.col("old")["user_id"].alias("old_user"))


@_query("SELECT unnest(['c_name', 'orders.o_orderdate']) AS field, unnest(['keyword', 'date']) AS type")
def mapping_types(spark, sf_dir):
    orders = _node("orders", ["o_orderdate"], rel="o2m", transform={"mapping": {"o_orderdate": {"type": "date"}}})
    got = mapping(parse({"index": "x", "nodes": _node("customer", ["c_name"], orders, transform={"mapping": {"c_name": {"type": "keyword"}}})}).root)

    def flat(m: dict, at: str = ""):
        for k, v in m.items():
            yield from flat(v["properties"], f"{at}{k}.") if "properties" in v else [(at + k, v["type"])]

    return spark.createDataFrame(list(flat(got)), "field string, type string")


@_query("SELECT event_id, 'props_k' AS name, props->>'$.k' AS k FROM events")
def json_path_name(spark, sf_dir):
    path = "props->>'k'"
    return _t(spark, sf_dir, "events").select("event_id", F.lit(jsonpath.output_name(path)).alias("name"), jsonpath.path_column(path).alias("k"))


@_query("SELECT event_id, '$.\"k\"' AS path, props->>'$.k' AS k FROM events")
def json_path_mysql(spark, sf_dir):
    path = "props->>'k'"
    return _t(spark, sf_dir, "events").select("event_id", F.lit(jsonpath.mysql_path(path)).alias("path"), jsonpath.mysql_column(path).alias("k"))


@_query("SELECT event_id::VARCHAR AS _id, user_id::BIGINT AS _txid FROM events")
def doc_txid(spark, sf_dir):
    got = compile(parse({"index": "x", "nodes": _node("events", ["event_type"])}), catalog.of_folder(spark, sf_dir), xid="user_id")
    return got.select("_id", "_txid")


@_query("""SELECT o_orderkey::VARCHAR AS _id, to_json({'o_orderstatus': o_orderstatus, 'part': v})::VARCHAR AS doc FROM orders LEFT JOIN
(SELECT l_orderkey, list({'p_partkey': p_partkey, 'p_brand': p_brand} ORDER BY p_partkey) AS v FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 25 GROUP BY 1) ON l_orderkey = o_orderkey""")
def through_filter_docs(spark, sf_dir):
    return _docs(spark, sf_dir, _node("orders", ["o_orderstatus"], _node("part", ["p_partkey", "p_brand"], rel="o2m@lineitem")), filters={"part": "p_size > 25"})


@_query("""SELECT conv_id || '|' || turn AS _id, to_json({'turn': turn, 'same': v})::VARCHAR AS doc FROM conversations JOIN
(SELECT conv_id AS c, role AS r, list(turn ORDER BY turn) AS v FROM conversations GROUP BY 1, 2) ON c = conv_id AND r = role""")
def doc_composite_join(spark, sf_dir):
    child = _node("conversations", ["turn"], rel="o2m:scalar", label="same")
    child["relationship"]["foreign_key"] = {"parent": ["conv_id", "role"], "child": ["conv_id", "role"]}
    return _docs(spark, sf_dir, _node("conversations", ["turn"], child))


@_query("""SELECT c_custkey::VARCHAR AS _id, to_json({'c_name': c_name, 'orders': v})::VARCHAR AS doc FROM customer LEFT JOIN
(SELECT o_custkey, list({'key': o_orderkey, 'o_orderstatus': replace(o_orderstatus, 'F', 'done')} ORDER BY o_orderkey) AS v FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def nested_transforms(spark, sf_dir):
    rules = {"rename": {"orders": {"o_orderkey": "key"}}, "replace": {"orders": {"o_orderstatus": {"F": "done"}}}}
    return _docs(spark, sf_dir, _node("customer", ["c_name"], _node("orders", ["o_orderkey", "o_orderstatus"], rel="o2m"), transform=rules))


@_query("SELECT o_orderkey, (o_orderkey // 100)::INT AS page, (o_orderkey % 100)::INT AS row FROM orders WHERE o_orderkey // 100 IN (1, 3, 4)")
def block_filter(spark, sf_dir):
    """Rows of some pages, by the text of their physical places and back."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", changes.tuple_id(F.floor(F.col("o_orderkey") / 100), F.col("o_orderkey") % 100).alias("place"))
    o = o.select("o_orderkey", *changes.page_and_row(F.col("place")))
    return changes.in_places(o, ["page"], spark.createDataFrame([(1,), (3,), (4,), (4,)], "page int")).select("o_orderkey", "page", "row")


@_query("SELECT o_orderkey FROM orders WHERE o_orderkey // 100 > 3 OR (o_orderkey // 100 = 3 AND o_orderkey % 100 > 40)")
def resume_filter(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_orderkey") / 100).cast("int").alias("page"), (F.col("o_orderkey") % 100).cast("int").alias("row"))
    return changes.after(o, ["page", "row"], (3, 40)).select("o_orderkey")


@_query("SELECT event_id, event_id = 7 AS same, false AS bad FROM events")
def uuid_guard(spark, sf_dir):
    text = F.lpad(F.col("event_id").cast("string"), 12, "0")
    own = F.concat(F.lit("00000000-0000-4000-8000-"), text)
    return _t(spark, sf_dir, "events").select("event_id", changes.uuid_equals(own, "00000000-0000-4000-8000-000000000007").alias("same"), changes.uuid_equals(own, "7").alias("bad"))


@_query("SELECT n_name, ('0x' || left(sha256(n_name), 15))::BIGINT AS key FROM nation")
def lock_keys(spark, sf_dir):
    return _t(spark, sf_dir, "nation").select("n_name", changes.lock_key(F.col("n_name")).alias("key"))


@_query("SELECT n_nationkey, n_name AS name, n_regionkey::VARCHAR AS beyond FROM nation")
def unknown_columns(spark, sf_dir):
    cells = [x for i, c in enumerate(("n_nationkey", "n_name", "n_regionkey")) for x in (F.lit(f"UNKNOWN_COL{i}"), F.col(c).cast("string"))]
    got = changes.named(F.create_map(*cells), ["id", "name"])
    return _t(spark, sf_dir, "nation").select("n_nationkey", got["name"].alias("name"), got["@2"].alias("beyond"))


@_query("""SELECT event_id, user_id::VARCHAR AS old_user FROM (SELECT *, lag(event_type) OVER w AS p, lag(event_id) OVER w AS e FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
WHERE e IS NOT NULL AND event_type IS DISTINCT FROM p""")
def captured_changes(spark, sf_dir):
    from pyspark.sql import Window

    own = F.struct("event_id", "user_id", "event_type", "value")
    rows = _t(spark, sf_dir, "events").select(F.lit("UPDATE").alias("op"), own.alias("new"), F.lag(own).over(Window.partitionBy("user_id").orderBy("event_id")).alias("old"))
    got = changes.captured(rows.where("old is not null"), "events", ["event_id", "user_id"], ["event_type"])
    return got.select(F.col("new")["event_id"].cast("long").alias("event_id"), F.col("old")["user_id"].alias("old_user"))


def _log(spark, sf_dir):
    """A log in which each ten events are a transaction; those of odd numbers have no COMMIT."""
    e = _t(spark, sf_dir, "events").select("event_id", "event_type", F.floor(F.col("event_id") / 10).alias("xid"))
    line = F.concat(F.lit("table public.events: INSERT: event_id[bigint]:"), "event_id", F.lit(" event_type[text]:'"), "event_type", F.lit("'"))
    rows = e.select((2 * F.col("event_id")).alias("lsn"), "xid", line.alias("line"))
    ends = e.where("xid % 2 = 0").groupBy("xid").agg(F.max(2 * F.col("event_id") + 1).alias("lsn"))
    return rows.unionByName(ends.select("lsn", "xid", F.concat(F.lit("COMMIT "), "xid").alias("line")))


def _cursor(spark, sf_dir):
    found = log.Cursor(_log(spark, sf_dir), scratch.folder(spark, "cursor"), "events")
    found.create()
    return found


@_query("SELECT event_id AS seq, 'events' AS \"table\", event_type, event_id // 10 AS txid FROM events WHERE event_id // 10 >= 5 AND event_id // 10 < 40")
def log_window(spark, sf_dir):
    """Parsed rows of a range of transactions."""
    got = changes.log_events(_cursor(spark, sf_dir).peek(low=5, high=40))
    return got.select((F.col("seq") / 2).cast("long").alias("seq"), "table", F.col("new")["event_type"].alias("event_type"), "txid")


@_query("""SELECT lsn, xid FROM (SELECT 2 * event_id AS lsn, event_id // 10 AS xid FROM events UNION ALL SELECT 2 * max(event_id) + 1, event_id // 10 FROM events WHERE event_id // 10 % 2 = 0 GROUP BY 2)
ORDER BY lsn LIMIT 50 OFFSET 20""")
def log_page(spark, sf_dir):
    return _cursor(spark, sf_dir).peek(limit=50, offset=20).select("lsn", "xid")


@_query("""WITH l AS (SELECT 2 * event_id AS lsn FROM events UNION ALL SELECT 2 * max(event_id) + 1 FROM events WHERE event_id // 10 % 2 = 0 GROUP BY event_id // 10)
SELECT 'got' AS what, lsn FROM (SELECT lsn FROM l ORDER BY lsn LIMIT 100) UNION ALL SELECT 'left', count(*) - 100 FROM l UNION ALL SELECT 'head', max(lsn) FROM l""")
def log_consumed(spark, sf_dir):
    cursor = _cursor(spark, sf_dir)
    got = cursor.get(limit=100).select(F.lit("got").alias("what"), "lsn")
    return got.unionByName(spark.createDataFrame([("left", cursor.count()), ("head", cursor.head())], "what string, lsn long"))


@_query("SELECT event_id FROM events WHERE event_id // 10 % 2 = 0")
def committed_log(spark, sf_dir):
    got = changes.log_events(changes.committed(_log(spark, sf_dir)))
    return got.select(F.col("new")["event_id"].cast("long").alias("event_id"))


@_query("SELECT event_id, 'UPDATE' AS op, event_type AS \"table\", user_id::VARCHAR AS user_id FROM events WHERE event_id % 3 = 1 UNION ALL SELECT event_id, 'INSERT', event_type, user_id::VARCHAR FROM events WHERE event_id % 3 = 0")
def binlog_rows(spark, sf_dir):
    """Rows of a binlog, the third kind of which are rotations."""
    e = _t(spark, sf_dir, "events")
    kind = F.element_at(F.array(F.lit("write"), F.lit("update"), F.lit("rotate")), (F.col("event_id") % 3 + 1).cast("int"))
    rows = e.select(
        F.lit("bin.000001").alias("file"), F.col("event_id").alias("pos"), kind.alias("kind"), F.col("event_type").alias("table"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("after"), F.lit(None).cast("map<string,string>").alias("before"),
    )
    got = changes.binlog_events(rows)
    return got.select((F.col("seq") - F.lit(1 << 40)).alias("event_id"), "op", "table", F.col("new")["user_id"].alias("user_id"))


@_query("SELECT event_id AS seq, event_type AS \"table\", user_id::VARCHAR AS user_id, event_id AS txid FROM events WHERE event_id % 4 <> 0 AND event_id % 5 <> 0")
def notified_events(spark, sf_dir):
    """Messages of which some are for another index and some are no JSON."""
    e = _t(spark, sf_dir, "events")
    body = F.to_json(F.struct(
        F.lit("INSERT").alias("tg_op"), F.col("event_type").alias("table"), F.lit("public").alias("schema"), F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("new"),
        F.col("event_id").alias("xmin"), F.array(F.when(F.col("event_id") % 4 == 0, F.lit("other")).otherwise(F.lit("mine"))).alias("indices"),
    ))
    messages = e.select(F.col("event_id").alias("seq"), F.when(F.col("event_id") % 5 == 0, F.lit("{broken")).otherwise(body).alias("payload"))
    got = changes.notifications(messages, "mine", ["public"])
    return got.select("seq", "table", F.col("new")["user_id"].alias("user_id"), "txid")


@_query("SELECT event_id AS seq, event_type AS \"table\" FROM events ORDER BY event_id LIMIT 50 OFFSET 100")
def queue_pop(spark, sf_dir):
    """The second pop of a queue that got two pushes."""
    queue, events = log.EventQueue(spark, scratch.folder(spark, "queue")), _as_events(spark, sf_dir)
    queue.push(events.where("seq < 120"))
    queue.push(events.where("seq >= 120"))
    queue.pop(100)
    return queue.pop(50).select("seq", "table")


@_query("SELECT unnest([0, 1, 2, 3]) AS place, unnest([9, 3, 5, 1]) AS txid, unnest([false, true, false, true]) AS ready")
def visibility_in_order(spark, sf_dir):
    return changes.visibility(spark, [9, 3, 5, 1], 6, [5])


@_query("""SELECT 'index' AS _op_type, c_custkey::VARCHAR AS _id, c_nationkey::VARCHAR AS _routing, 'clean' AS pipeline FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'delete', c_custkey::VARCHAR, NULL, NULL FROM customer WHERE c_acctbal < 0""")
def routing_actions(spark, sf_dir):
    """Actions with routing and pipeline, as every sink gets them."""
    spec = parse({"index": "customers", "routing": "c_nationkey", "pipeline": "clean", "nodes": _node("customer", ["c_name", "c_nationkey"])})
    customers = _t(spark, sf_dir, "customer")
    rows = compile(spec, catalog.of_folder(spark, sf_dir), where=F.col("c_acctbal") >= 0)
    gone = customers.where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("_id"))
    return actions(rows, gone).select("_op_type", "_id", "_routing", "pipeline")


@_query(f"""SELECT c_custkey::VARCHAR AS _id, to_json({{'c_name': c_name, 'nation': {{'n_name': n_name}}, 'orders': o.v}})::VARCHAR AS doc
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN {_ORDERS.replace(", 'o_orderstatus': o_orderstatus", "")} o ON o_custkey = c_custkey""")
def restart_equals_recompute(spark, sf_dir):
    """A snapshot before some orders, then their insertion by a Sync made anew over the state, which gives what a full run does."""
    spec, tables = _customers(spark, sf_dir)
    at = scratch.folder(spark, "restart")
    schema = compile(spec, tables).schema
    orders = _t(spark, sf_dir, "orders")

    def sync(late: bool) -> Sync:
        own = catalog.of_folder(spark, sf_dir)
        own.add(catalog.TableDef("orders", lambda: orders if late else orders.where("o_orderstatus <> 'F'"), tables["orders"].primary_key, tables["orders"].foreign_keys))
        return Sync(spec, own, ParquetSink(spark, f"{at}/docs", schema, 8), scratch.saver(spark, f"{at}/tables"), f"{at}/state")

    sync(False).snapshot()
    row = F.create_map(F.lit("o_orderkey"), F.col("o_orderkey").cast("string"), F.lit("o_custkey"), F.col("o_custkey").cast("string"))
    late = orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("seq"), F.lit("INSERT").alias("op"), F.lit("orders").alias("table"), row.alias("new"), F.lit(None).cast("map<string,string>").alias("old"), F.col("o_orderkey").alias("txid")
    )
    again = sync(True)
    for _ in range(2):  # the second time it changes nothing
        again.apply(late, 0)
    return as_json(sync(True).sink.read()).select("_id", F.col("_source").alias("doc"))


@_query("SELECT doc_id::VARCHAR AS _id FROM documents JOIN conversations ON conv_id = doc_id WHERE conv_id = 3 AND turn = 1")
def affected_composite_update(spark, sf_dir):
    """A child row of a key of two columns leads to the documents that hold just that row."""
    child = _node("conversations", ["role"], rel="o2m")
    child["relationship"]["foreign_key"] = {"parent": ["doc_id"], "child": ["conv_id"]}
    spec, tables = parse({"index": "x", "nodes": _node("documents", ["source"], child)}), catalog.of_folder(spark, sf_dir)
    row = {"conv_id": "3", "turn": "1"}
    return resolve.resolve(_events(spark, [(1, "UPDATE", "conversations", row, row, 1)]), spec, tables, doc_keys(compile(spec, tables)))[1].select("_id")


@_query("SELECT p_brand, count(*) AS n FROM part WHERE p_size > 10 GROUP BY 1")
def sql_search(spark, sf_dir):
    parts = _t(spark, sf_dir, "part").withColumn("_meta", F.lit("hidden"))
    return search.query(parts, "SELECT p_brand, count(*) AS n FROM {documents} WHERE p_size > 10 GROUP BY 1")


@_query("SELECT p_partkey FROM part WHERE p_name ILIKE '%ring%'")
def reindexed_search(spark, sf_dir):
    """A search in documents that were made anew with their n-grams."""
    found = search.with_ngrams(_t(spark, sf_dir, "part"), ["p_name"])
    return found.where(F.array_contains("p_name_ngram", "ring")).select("p_partkey")


@_query("SELECT p_partkey FROM part WHERE regexp_matches(lower(p_type), 'co')")
def short_term_search(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(search.matches(["p_type"], "Co")).select("p_partkey")


@_query("SELECT event_id, 'e' || event_id AS text, '\"e' || event_id || '\"' AS json, '[1,{\"b\":\"e' || event_id || '\"}]' AS list, '1' AS first, NULL::VARCHAR AS none FROM events")
def json_path_steps(spark, sf_dir):
    doc = F.concat(F.lit('{"a": [1, {"b": "e'), "event_id", F.lit('"}]}'))
    own = _t(spark, sf_dir, "events").select("event_id", doc.alias("doc"))
    paths = {"text": "doc#>>'{a,1,b}'", "json": "doc#>'{a,1,b}'", "list": "doc->'a'", "first": "doc->'a'->>0", "none": "doc->'z'->>'y'"}
    return own.select("event_id", *[jsonpath.path_column(p).alias(n) for n, p in paths.items()])


@_query("""SELECT c_custkey::VARCHAR AS _id, to_json({'c_name': c_name, 'orders': o.v})::VARCHAR AS doc FROM customer LEFT JOIN
(SELECT o_custkey, list(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END ORDER BY o_orderkey) AS v FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def doc_scalar_nulls(spark, sf_dir):
    """Null values of a scalar child stay in its array."""
    tables = catalog.of_folder(spark, sf_dir)
    base = tables["orders"]
    holes = lambda: base.load().withColumn("o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")))
    tables.add(catalog.TableDef("orders", holes, base.primary_key, base.foreign_keys))
    got = compile(parse({"index": "x", "nodes": _node("customer", ["c_name"], _node("orders", ["o_orderpriority"], rel="o2m:scalar"))}), tables)
    return as_json(got).select("_id", F.col("_source").alias("doc"))


@_query("SELECT c_custkey::VARCHAR AS _id FROM customer")
def truncate_root(spark, sf_dir):
    return _affected(spark, sf_dir, [(1, "TRUNCATE", "customer", None, None, 1)])[0].select("_id")


@_query("SELECT n_name, 'hero' AS a, 'Groot' AS g FROM nation WHERE n_nationkey > 3")
def constant_fields(spark, sf_dir):
    """Plugins in order, the first of which makes some documents null, so that they are left out."""
    plugins.REGISTRY.setdefault("canopy.few", lambda d: d.withColumn("_source", F.when(F.col("_source.n_nationkey") > 3, F.col("_source"))))
    plugins.REGISTRY.setdefault("canopy.a", plugins.constant("a", "hero"))
    own = _t(spark, sf_dir, "nation").select(F.struct("n_nationkey", "n_name").alias("_source"))
    got = plugins.run(own, ["canopy.few", "canopy.a", "Groot"])
    return got.select(F.col("_source.n_name").alias("n_name"), F.col("_source.a").alias("a"), F.col("_source.groot").alias("g"))


@_query("SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name), '[\\s_]+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-') || '-' || p_partkey AS slug FROM part")
def multi_field_slug(spark, sf_dir):
    own = _t(spark, sf_dir, "part").select("p_partkey", F.struct(F.col("p_name").alias("title"), F.col("p_partkey").alias("id")).alias("_source"))
    return plugins.run(own, ["MultiFieldSlug"]).select("p_partkey", F.col("_source.slug").alias("slug"))


@_query("""SELECT o_custkey::VARCHAR AS _id, to_json({'n': n, 'buyer': c_name})::VARCHAR AS doc FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) JOIN customer ON c_custkey = o_custkey""")
def materialized_view_docs(spark, sf_dir):
    """Documents of a materialized view that was refreshed after its base table had grown."""
    tables = catalog.of_folder(spark, sf_dir)
    base, late = tables["orders"], []
    rows = lambda: base.load() if late else base.load().where("o_orderstatus <> 'F'")
    tables.add(catalog.TableDef("orders", rows, base.primary_key, base.foreign_keys))
    view = View(spark, tables, "spending", "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey", ("orders",), ("o_custkey",), scratch.folder(spark, "view"))
    late.append(True)
    view.refresh()
    child = _node("customer", ["c_name"], rel="o2o:scalar", label="buyer")
    child["relationship"]["foreign_key"] = {"parent": ["o_custkey"], "child": ["c_custkey"]}
    got = compile(parse({"index": "x", "nodes": _node("spending", ["n"], child)}), tables)
    return as_json(got).select("_id", F.col("_source").alias("doc"))


@_query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 400 AS block FROM orders")
def scan_blocks(spark, sf_dir):
    """The tasks of a scan: blocks of 400 rows in order of the key."""
    return changes.blocks(_t(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 400)


@_query("SELECT max(event_id) AS txid, max(event_id) - 100 AS before FROM events")
def current_transaction(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.col("event_id").alias("txid"))
    now = changes.high_water(e)
    return spark.createDataFrame([(now, changes.high_water(changes.within(e, "txid", None, now - 99)))], "txid long, before long")

"""Documents, transforms, changes and sinks on small tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from canopy.functions import plugins
from canopy.functions.jsonpath import output_name
from canopy.operators import changes, resolve
from canopy.plans.catalog import Catalog, ForeignKey, TableDef
from canopy.plans.compile import as_json, compile, doc_keys, meta
from canopy.plans.spec import SpecError, identifier, load, parse, quoted, read_source
from canopy.plans.views import View
from canopy.settings import Settings, redacted
from canopy.sources import log
from canopy.sources.scratch import saver
from canopy.sources.sinks import JsonLinesSink, MemorySink, ParquetSink, mapping
from canopy.streaming.state import KeyIndex, StateFile
from canopy.streaming.sync import Sync

SPEC = {
    "index": "books",
    "nodes": {
        "table": "book",
        "columns": ["isbn", "title"],
        "children": [
            {"table": "publisher", "columns": ["name"], "relationship": {"type": "one_to_one"}, "label": "publisher_label"},
            {"table": "author", "columns": ["name"], "label": "authors", "relationship": {"type": "one_to_many", "variant": "scalar", "through_tables": ["book_author"]}},
            {"table": "rating", "columns": ["value"], "relationship": {"type": "one_to_many"}},
        ],
    },
}


class Library:
    """Tables as lists of rows that tests change."""

    schemas = {
        "publisher": "id int, name string",
        "author": "id int, name string",
        "book": "isbn string, title string, publisher_id int",
        "book_author": "id int, book_isbn string, author_id int",
        "rating": "id int, book_isbn string, value int",
    }
    keys = {"book": ("isbn",)}
    edges = {
        "book": (ForeignKey(("publisher_id",), "publisher", ("id",)),),
        "book_author": (ForeignKey(("book_isbn",), "book", ("isbn",)), ForeignKey(("author_id",), "author", ("id",))),
        "rating": (ForeignKey(("book_isbn",), "book", ("isbn",)),),
    }

    def __init__(self, spark):
        self.rows = {
            "publisher": {1: (1, "Oxford"), 2: (2, None)},
            "author": {1: (1, "Ann"), 2: (2, None), 3: (3, "Cyd")},
            "book": {"a": ("a", "One", 1), "b": ("b", None, None), "c": ("c", "Three", 9)},
            "book_author": {1: (1, "a", 1), 2: (2, "a", 2), 3: (3, "b", 3), 4: (4, "c", 77)},
            "rating": {1: (1, "a", 5), 2: (2, "a", None)},
        }
        self.catalog = Catalog()
        for t, s in self.schemas.items():
            self.catalog.add(TableDef(t, lambda t=t, s=s: spark.createDataFrame(list(self.rows[t].values()), s), self.keys.get(t, ("id",)), self.edges.get(t, ())))

    def event(self, seq, op, table, new=None, old=None):
        names = [c.split()[0] for c in self.schemas[table].split(", ")]
        row = lambda r: None if r is None else {k: None if v is None else str(v) for k, v in zip(names, r)}
        return (seq, op, table, row(new), row(old), seq)


def documents(df):
    return {r["_id"]: json.loads(r["_source"]) for r in as_json(df).collect()}


def test_documents_and_nulls(spark):
    lib = Library(spark)
    got = documents(compile(parse(SPEC), lib.catalog))
    assert got["a"] == {"isbn": "a", "title": "One", "publisher_label": {"name": "Oxford"}, "authors": ["Ann", None], "rating": [{"value": 5}, {"value": None}]}
    assert got["b"] == {"isbn": "b", "title": None, "publisher_label": None, "authors": ["Cyd"], "rating": None}
    assert got["c"] == {"isbn": "c", "title": "Three", "publisher_label": None, "authors": [None], "rating": None}


def test_meta_and_restriction(spark):
    lib = Library(spark)
    spec = parse(SPEC)
    only = compile(spec, lib.catalog, spark.createDataFrame([("a",)], "isbn string"))
    (row,) = only.select("_id", meta(spec, lib.catalog).alias("m")).collect()
    assert row["_id"] == "a" and row["m"]["author"]["id"] == ["1", "2"] and row["m"]["book_author"]["book_isbn"] == ["a"]


def test_empty_tables(spark):
    lib = Library(spark)
    for t in ("rating", "author", "publisher", "book_author"):
        lib.rows[t] = {}
    assert documents(compile(parse(SPEC), lib.catalog))["a"]["authors"] is None
    lib.rows["book"] = {}
    assert documents(compile(parse(SPEC), lib.catalog)) == {}


@pytest.mark.parametrize(
    "change",
    [
        {"relationship": {"type": "many"}}, {"relationship": {"type": "one_to_one", "variant": "x"}}, {"relationship": None}, {"colour": 1},
        {"relationship": {"type": "one_to_one", "through_tables": ["a", "b"]}}, {"relationship": {"type": "one_to_one", "foreign_key": {"parent": ["a"]}}},
    ],
)
def test_bad_specs(change):
    child = {"table": "rating", "relationship": {"type": "one_to_many"}} | change
    with pytest.raises(SpecError):
        parse({"index": "x", "nodes": {"table": "book", "children": [child]}})


def test_unknown_column(spark):
    with pytest.raises(SpecError):
        compile(parse({"index": "x", "nodes": {"table": "book", "columns": ["nope"]}}), Library(spark).catalog)


def test_load_replaces_environment(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"index": "$foo", "nodes": {"table": "t"}}]))
    assert load(str(tmp_path / "s.json"), {"foo": "bar"})[0].index == "bar"


def test_path_names():
    assert output_name("doc#>'{a,b,c}'->4") == "doc_a,b,c_4"
    assert output_name("doc->'a'->>'b'") == "doc_a_b"


def test_incremental_equals_recompute(spark, tmp_path):
    """After random changes the sink holds what a full run gives, and a batch that runs again changes nothing."""
    rng = random.Random(5)
    lib, spec, n = Library(spark), parse(SPEC), 0

    def save(df):
        nonlocal n
        n += 1
        df.write.parquet(f"{tmp_path}/{n}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{n}")

    sync = Sync(spec, lib.catalog, MemorySink(), save, f"{tmp_path}/state")
    sync.snapshot()
    for step in range(3):
        events = []
        for seq in range(6):
            table = rng.choice(list(lib.rows))
            rows = lib.rows[table]
            op = rng.choice(["INSERT", "UPDATE", "DELETE"])
            if op == "INSERT" or not rows:
                key = f"n{step}{seq}" if table == "book" else 100 + 10 * step + seq
                isbn = rng.choice(list(lib.rows["book"]) or ["a"])
                new = {"book": (key, "New", 1), "publisher": (key, "P"), "author": (key, "A"), "book_author": (key, isbn, 1), "rating": (key, isbn, 3)}[table]
                rows[key] = new
                events.append(lib.event(seq, "INSERT", table, new))
            elif op == "DELETE":
                key = rng.choice(list(rows))
                events.append(lib.event(seq, "DELETE", table, None, rows.pop(key)))
            else:
                key = rng.choice(list(rows))
                old = rows[key]
                new = (*old[:-1], 1) if table in ("book", "book_author", "rating") else (*old[:-1], "changed")
                if table == "rating":
                    new = (old[0], rng.choice(list(lib.rows["book"]) or ["a"]), 2)
                rows[key] = new
                events.append(lib.event(seq, "UPDATE", table, new, old))
        batch = spark.createDataFrame(events, changes.EVENT)
        for _ in range(2 if step == 0 else 1):
            sync.apply(batch)
            held = {k: json.loads(v) for k, v in sync.sink.documents.items()}
            assert held == documents(compile(spec, lib.catalog))
    lib.rows["rating"] = {}
    sync.apply(spark.createDataFrame([(1, "TRUNCATE", "rating", None, None, 1)], changes.EVENT))
    assert {k: json.loads(v) for k, v in sync.sink.documents.items()} == documents(compile(spec, lib.catalog))
    with pytest.raises(ValueError):
        sync.apply(spark.createDataFrame([(1, "MERGE", "book", {"isbn": "a"}, None, 1)], changes.EVENT))


def test_log_lines(spark):
    lines = [
        "BEGIN 12",
        "table public.book: INSERT: isbn[character varying]:'it''s' n[integer]:4 t[text]:null",
        "table public.book: UPDATE: old-key: isbn[text]:'a' new-tuple: isbn[text]:'b' n[integer]:5",
        "table public.book: DELETE: isbn[text]:'z'",
        "COMMIT 12",
    ]
    got = [(r["op"], r["new"], r["old"]) for r in changes.parse_log(spark.createDataFrame([(x,) for x in lines], "line string")).collect()]
    assert got == [("INSERT", {"isbn": "it's", "n": "4", "t": None}, None), ("UPDATE", {"isbn": "b", "n": "5"}, {"isbn": "a"}), ("DELETE", None, {"isbn": "z"})]


def test_parquet_sink(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "_id string, _source string")
    sink = ParquetSink(spark, str(tmp_path), frame([]).schema, 4)
    none = frame([]).select("_id")
    assert sink.read().count() == 0
    sink.bulk(frame([("1", "a"), ("2", "b"), ("3", "c")]), none)
    for _ in range(2):
        sink.bulk(frame([("2", "B"), ("4", "d")]), frame([("1", "")]).select("_id"))
        assert {tuple(r) for r in sink.read().select("_id", "_source").collect()} == {("2", "B"), ("3", "c"), ("4", "d")}


def test_plugins(spark):
    assert plugins.slug_text("  Héllo,  Wörld_x! ") == "hello-world-x"
    assert len(plugins.slug_text("ab " * 60)) <= 100
    df = spark.createDataFrame([("1", "a@b.c"), ("2", None)], "_id string, email string").select("_id", F.struct("email").alias("_source"))
    assert [r[0] for r in plugins.run(df, ["Masking", "Hero"]).select("_source.email").orderBy("_id").collect()][0] == "a***@b.c"
    with pytest.raises(KeyError):
        plugins.run(df, ["None such"])


def test_mapping_rejects_unknown_types():
    with pytest.raises(SpecError):
        mapping(parse({"index": "x", "nodes": {"table": "t", "transform": {"mapping": {"a": {"type": "no"}}}}}).root)


def test_stream(spark, tmp_path):
    lib, spec = Library(spark), parse(SPEC)
    sync = Sync(spec, lib.catalog, MemorySink(), lambda df: spark.createDataFrame(df.collect(), df.schema), f"{tmp_path}/state")
    sync.snapshot()
    lib.rows["rating"][3] = (3, "b", 1)
    spark.createDataFrame([lib.event(1, "INSERT", "rating", (3, "b", 1))], changes.EVENT).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(changes.EVENT).parquet(f"{tmp_path}/in")
    sync.stream(stream, f"{tmp_path}/checkpoint").awaitTermination()
    assert json.loads(sync.sink.documents["b"])["rating"] == [{"value": 1}]


def test_keys_with_bars_keep_their_documents(spark, tmp_path):
    lib, spec = Library(spark), parse(SPEC)
    lib.rows["book"]["x|y"] = ("x|y", "Barred", 1)
    sync = Sync(spec, lib.catalog, MemorySink(), saver(spark, f"{tmp_path}/t"), f"{tmp_path}/state")
    sync.snapshot()
    lib.rows["rating"][3] = (3, "x|y", 4)
    sync.apply(spark.createDataFrame([lib.event(1, "INSERT", "rating", (3, "x|y", 4))], changes.EVENT))
    assert json.loads(sync.sink.documents["x|y"])["rating"] == [{"value": 4}]


def test_composite_keys_are_looked_up_whole(spark):
    catalog = Catalog()
    catalog.add(TableDef("a", lambda: spark.createDataFrame([(1,), (2,)], "id int"), ("id",)))
    rows = [(1, 1, 1), (1, 2, 2), (9, 1, 2)]
    catalog.add(TableDef("b", lambda: spark.createDataFrame(rows, "m int, n int, a_id int"), ("m", "n"), (ForeignKey(("a_id",), "a", ("id",)),)))
    spec = parse({"index": "x", "nodes": {"table": "a", "children": [{"table": "b", "relationship": {"type": "one_to_many"}}]}})
    event = [(1, "UPDATE", "b", {"m": "1", "n": "1"}, {"m": "1", "n": "1"}, 1)]
    found = resolve.resolve(spark.createDataFrame(event, changes.EVENT), spec, catalog, doc_keys(compile(spec, catalog)))[1]
    assert [r["_id"] for r in found.collect()] == ["1"]


def test_restart_goes_on(spark, tmp_path):
    """A new Sync over the state holds what the last one wrote, and leaves out batches that were applied."""
    lib, spec = Library(spark), parse(SPEC)
    schema = compile(spec, lib.catalog).schema

    def sync():
        return Sync(spec, lib.catalog, ParquetSink(spark, f"{tmp_path}/docs", schema, 2), saver(spark, f"{tmp_path}/t"), f"{tmp_path}/state")

    with pytest.raises(RuntimeError):
        sync().apply(spark.createDataFrame([], changes.EVENT))
    sync().snapshot()
    lib.rows["rating"][3] = (3, "b", 4)
    batch = spark.createDataFrame([lib.event(7, "INSERT", "rating", (3, "b", 4))], changes.EVENT)
    sync().apply(batch, 0)
    lib.rows["rating"][3] = (3, "b", 5)
    last = sync()
    last.apply(batch, 0)
    assert documents(last.sink.read())["b"]["rating"] == [{"value": 4}] and last.checkpoint == 6
    last.apply(batch, 1)
    assert documents(sync().sink.read()) == documents(compile(spec, lib.catalog))
    assert last.status()["batches"] == 2 and last.status()["documents"] == 5
    with pytest.raises(ValueError):
        last.checkpoint = None


def test_held_back_events_outlive_a_run(spark, tmp_path):
    lib, spec = Library(spark), parse(SPEC)
    sync = lambda: Sync(spec, lib.catalog, MemorySink(), saver(spark, f"{tmp_path}/t"), f"{tmp_path}/state")
    sync().snapshot()
    lib.rows["rating"][3] = (3, "b", 4)
    sync().apply_visible(spark.createDataFrame([lib.event(7, "INSERT", "rating", (3, "b", 4))], changes.EVENT), 5, [])
    later = sync()
    assert later.sink.documents == {}
    later.apply_visible(spark.createDataFrame([], changes.EVENT), 9, [])
    assert json.loads(later.sink.documents["b"])["rating"] == [{"value": 4}]


def test_key_index(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame([("t", "k", v, i, [i]) for v, i in r], "table string, key string, value string, _id string, _key array<string>")
    ids = lambda *r: spark.createDataFrame([(i,) for i in r], "_id string")
    index = KeyIndex(spark, f"{tmp_path}/i")
    assert index.read().count() == 0
    index.replace(rows(("1", "a"), ("2", "b")))
    for n in range(KeyIndex.COMPACT + 2):
        index.update(ids("a", "c"), rows((str(n), "a")))
    index = KeyIndex(spark, f"{tmp_path}/i", index.manifest)
    assert {(r["value"], r["_id"]) for r in index.read().collect()} == {("2", "b"), (str(n), "a")}
    assert len(index.manifest["keys"]) <= KeyIndex.COMPACT


def test_state_file(spark, tmp_path):
    file = StateFile(spark, f"{tmp_path}/s/state.json")
    assert file.load() == {}
    for value in ({"a": 1}, {"a": [2, "é"]}):
        file.save(value)
        assert file.load() == value
    (tmp_path / "s" / "state.json").write_text("{broken")
    (tmp_path / "s" / ".state.json.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError):
        file.load()
    with pytest.raises(ValueError):
        file.save(None)


def test_cursor_and_consume(spark, tmp_path):
    lib, spec = Library(spark), parse(SPEC)
    sync = Sync(spec, lib.catalog, MemorySink(), saver(spark, f"{tmp_path}/t"), f"{tmp_path}/state")
    sync.snapshot()
    lines = [(1, 5, "BEGIN 5"), (2, 5, "table public.rating: INSERT: id[integer]:3 book_isbn[text]:'b' value[integer]:4"), (3, 5, "COMMIT 5"), (4, 6, "table public.rating: INSERT: id[integer]:4 book_isbn[text]:'c' value[integer]:1")]
    cursor = log.Cursor(spark.createDataFrame(lines, log.LOG), f"{tmp_path}/c", "one")
    with pytest.raises(ValueError):
        cursor.peek()
    cursor.create()
    with pytest.raises(ValueError):
        cursor.create()
    assert cursor.count() == 4 and cursor.count(low=6) == 1 and cursor.head() == 4 and cursor.peek(upto=2).count() == 2
    lib.rows["rating"] |= {3: (3, "b", 4), 4: (4, "c", 1)}
    assert log.consume(cursor, sync) == 1 and cursor.done == 3
    assert json.loads(sync.sink.documents["b"])["rating"] == [{"value": 4}] and json.loads(sync.sink.documents["c"])["rating"] is None
    assert [r["lsn"] for r in cursor.get().collect()] == [4] and cursor.count() == 0
    cursor.drop()
    assert not cursor.exists()


def test_queue(spark, tmp_path):
    queue = log.EventQueue(spark, f"{tmp_path}/q")
    assert queue.size() == 0 and queue.pop().count() == 0
    events = lambda *seq: spark.createDataFrame([(n, "INSERT", "t", None, None, n) for n in seq], changes.EVENT)
    assert queue.push(events(2, 1)) == 2 and queue.push(events(3)) == 1 and queue.size() == 3
    assert [r["seq"] for r in queue.pop(2).orderBy("seq").collect()] == [1, 2] and queue.size() == 1
    queue.set_meta(txid=4)
    queue.delete()
    assert queue.size() == 0 and queue.meta() == {"txid": 4}


def test_queue_orders_a_push_on_many_tasks(spark, tmp_path):
    """No task sorts a whole push, and pops cross its ranges and pushes in order."""
    queue = log.EventQueue(spark, f"{tmp_path}/q")
    events = lambda *seq: spark.createDataFrame([(n, "INSERT", "t", None, None, n) for n in seq], changes.EVENT)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        first = list(range(200))
        random.Random(4).shuffle(first)
        assert queue.push(events(*first)) == 200 and queue.push(events(1000).limit(0)) == 0 and queue.push(events(300, 300, 250, 400)) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(f"{tmp_path}/q/0-0").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and all(r["count"] < 200 for r in files)
    got = []
    while queue.size():
        got.append(sorted(r["seq"] for r in queue.pop(37).collect()))
    assert [len(x) for x in got] == [37] * 5 + [19] and sum(got, []) == [*range(200), 250, 300, 300, 400]


def test_unasked_keys_are_not_collected(spark):
    """A plan of documents alone makes no lineage; one that asks for it gets it whole."""
    lib = Library(spark)
    got = compile(parse(SPEC), lib.catalog)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "table, rating," in plan(got) and "table, rating," not in plan(as_json(got).select("_id", "_source"))
    keys = {r["_id"]: {tuple(k) for k in r["_keys"]} for r in got.collect()}
    assert {("rating", "id", "1"), ("rating", "id", "2"), ("author", "id", "1"), ("book_author", "id", "2"), ("publisher", "id", "1")} <= keys["a"]


def test_json_lines_have_routing_and_pipeline(spark, tmp_path):
    lib = Library(spark)
    spec = parse({"index": "books", "routing": "title", "pipeline": "p", "nodes": {"table": "book"}})
    docs = compile(spec, lib.catalog)
    sink = JsonLinesSink(f"{tmp_path}/out")
    sink.bulk(docs, spark.createDataFrame([("z",)], "_id string"))
    got = {r["_id"]: r for r in spark.read.json(f"{tmp_path}/out/*").collect()}
    assert got["a"]["_routing"] == "One" and got["a"]["pipeline"] == "p" and got["a"]["_index"] == "books" and got["z"]["_op_type"] == "delete" and sink.doc_count == 4
    sink.teardown()
    assert not (tmp_path / "out").exists()


def test_configuration_comes_from_one_place(tmp_path):
    (tmp_path / "s.json").write_text("[]")
    assert load(str(tmp_path / "s.json")) == []
    for bad in ({}, {"path": "a", "url": "http://b"}, {"url": "ftp://b"}, {"s3": "s3://bucket"}):
        with pytest.raises(SpecError):
            read_source(**bad)
    assert identifier("My-Db", "x.y") == "mydb_xy" and quoted('a"b') == '"a""b"' and quoted("a", "mysql") == "`a`"


def test_mapping_rejects_unknown_parameters():
    with pytest.raises(SpecError):
        mapping(parse({"index": "x", "nodes": {"table": "t", "transform": {"mapping": {"a": {"type": "text", "colour": 1}}}}}).root)


def test_command_line(spark, tmp_path, capsys):
    from canopy import cli

    spec = {"index": "nations", "nodes": {"table": "nation", "columns": ["n_name"], "children": [{"table": "region", "columns": ["r_name"], "relationship": {"type": "one_to_one"}}]}}
    (tmp_path / "c.json").write_text(json.dumps([spec]))
    spark.createDataFrame([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/data/nation.parquet")
    spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/data/region.parquet")
    spark.createDataFrame([(1, 1, "table public.region: UPDATE: r_regionkey[integer]:1 r_name[text]:'R'")], log.LOG).write.parquet(f"{tmp_path}/log")
    places = ["--config", f"{tmp_path}/c.json", "--data", f"{tmp_path}/data", "--out", f"{tmp_path}/out", "--state", f"{tmp_path}/state"]
    for action in ("analyze", "bootstrap", "snapshot", "sync", "status"):
        cli.main([action, *places, "--log", f"{tmp_path}/log"])
    said = capsys.readouterr().out
    assert "region: joined to nation on r_regionkey = n_regionkey" in said and '"batches": 1' in said
    cli.main(["teardown", *places])
    with pytest.raises(SystemExit):
        cli.main(["sync", "--config", "x", "--config-url", "y", "--data", "z"])


def test_settings():
    assert Settings.of({}) == Settings() and Settings.of({"CANOPY_PAGE": "7", "CANOPY_RAISE_ON_FAILURE": "false"}) == Settings(page=7, raise_on_failure=False)
    with pytest.raises(ValueError):
        Settings.of({"CANOPY_PAGE": "many"})
    assert redacted("https://me:secret@host/x") == "https://me:***@host/x"


def test_discovery_and_credentials(tmp_path, monkeypatch):
    (tmp_path / "my_own_plugins").mkdir()
    (tmp_path / "my_own_plugins" / "__init__.py").write_text("")
    (tmp_path / "my_own_plugins" / "one.py").write_text("from canopy.functions.plugins import plugin\n\n\n@plugin('MineAlone')\ndef f(d):\n    return d\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert plugins.discover("my_own_plugins") == ["MineAlone"]
    monkeypatch.setenv("MY_KEY", "a")
    assert plugins.credentials("MY_KEY") == "a" and plugins.credentials("NO_SUCH_KEY") is None
    monkeypatch.setattr(plugins, "CREDENTIALS", [*plugins.CREDENTIALS, {"MY_KEY": "b"}.get])
    assert plugins.credentials("MY_KEY") == "b"


def test_views(spark, tmp_path):
    lib = Library(spark)
    view = View(spark, lib.catalog, "rated", "SELECT book_isbn, count(*) AS n FROM {rating} GROUP BY book_isbn", ("rating",), ("book_isbn",), f"{tmp_path}/v")
    lib.rows["rating"][3] = (3, "a", 1)
    assert view.load().first()["n"] == 2 and lib.catalog.view_of("rating") == ["rated"]
    view.refresh()
    view.register()
    assert view.load().first()["n"] == 3 and spark.table("rated").count() == 1
    view.drop()
    assert "rated" not in lib.catalog.tables

"""The pipeline as a whole and stage by stage against brute force, and on empty tables and awkward columns."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_operators import CLASHES, SCHEMA, assert_untouched, brute_join, corpus, prose

import corpus_pipeline

LABELS = "doc_id long, quality int, toxic int"


def made(spark, folder, rows, labels):
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def toxic_corpus():
    rng, rows, labels = random.Random(6), list(corpus()), []
    for i in range(1000, 1160):
        words, toxic = prose(rng, 60).split(), i % 4 == 0
        if toxic:
            for p in rng.sample(range(60), 4):
                words[p] = rng.choice(["grubvile", "snakhead"])
        rows.append((i, " ".join(words), "en", "s1", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, "here is a GRUBVILE again", "en", None, 1), (2001, None, None, None, None), (2002, "x " * 30_000 + "end", "en", "s2", 1)]
    return rows, labels


def test_pipeline_stage_by_stage(spark, tmp_path):
    rows, labels = toxic_corpus()
    at = made(spark, tmp_path / "sf", rows, labels)
    docs = spark.read.parquet(f"{at}/documents.parquet")
    texts = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    before, sizes = texts(docs), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, at)
        if name != "bpe":
            assert_untouched(out, docs)
            out.write.parquet(f"{tmp_path}/{name}")
            out = docs = spark.read.parquet(f"{tmp_path}/{name}")
            after = texts(out)
        if name == "toxicity":
            bad = lambda t: t is not None and any(w in t.lower() for w in ("grubvile", "snakhead"))
            assert collections.Counter(after) == collections.Counter(x for x in before if not bad(x[1]))
        elif name == "exact_dedup":
            least = {}
            for i, t in before:
                if t is not None and i is not None:
                    least[t] = min(i, least.get(t, i))
            want = [x for x in before if x[1] is None] + sorted({(least.get(t), t) for _, t in before if t is not None}, key=repr)
            assert collections.Counter(after) == collections.Counter(want)
        elif name == "ngram_join":
            winner = {i: w for i, w, _ in brute_join(before)}
            assert collections.Counter(after) == collections.Counter(x for x in before if x[0] is None or winner[x[0]] == x[0])
        elif name == "mixing":
            assert set(after) == set(before)
        else:
            got = collections.Counter((r["doc_id"], r["text_md5"]) for r in out.collect())
            assert got == collections.Counter((i, None if t is None else hashlib.md5(t.encode()).hexdigest()) for i, t in before)
            break
        sizes[name], before = len(after), after
    assert len(rows) > sizes["toxicity"] > sizes["exact_dedup"] > sizes["ngram_join"] <= sizes["mixing"]


def test_pipeline_as_a_whole(spark, tmp_path):
    rows, labels = toxic_corpus()
    got = corpus_pipeline.run(spark, made(spark, tmp_path / "sf", rows, labels)).collect()
    ids = {r["doc_id"] for r in got}
    assert {5, 7, 120, 121, 2001, 2002} <= ids and not {110, 111, 112, 113, 1000, 2000} & ids
    text = {hashlib.md5(t.encode()).hexdigest() for _, t, *_ in rows if t is not None}
    assert all(r["text_md5"] in text for r in got if r["n_tokens"] is not None)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, None, None, None, None)]])
def test_pipeline_of_nothing(spark, tmp_path, rows):
    got = corpus_pipeline.run(spark, made(spark, tmp_path / "sf", rows, [])).collect()
    assert len(got) == len(rows) and all(r["n_tokens"] is None for r in got)

"""Each operator against brute force, and on nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import collections
import functools
import hashlib
import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from canopy.llm import bpe, embedding_dedup, exact_dedup, lm_score, mixing, ngram_join, resharding, secrets, substring_dedup, toxicity
from canopy.llm._store import components
from canopy.llm._text import WORD, lean

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "key h sid shard winner slot size a bucket __i __d __hash __slot __digest d g i row nth rank begin epoch due_slot own_id own_hash text_md5".split()
SYLLABLES = "an ber cor dul en fir gol hin is jor kal lum mon ner ol pur qua ras sol tir un vel".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def corpus():
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 160))) for i in range(40)]
    shared = prose(rng, 60)
    rows += [(100 + i, prose(rng, 30) + ". " + shared + ", " + prose(rng, 20)) for i in range(3)]
    rows += [(110, rows[5][1]), (111, rows[5][1].replace(" ", "  ").upper()), (112, rows[7][1] + " tail"), (113, rows[7][1])]
    rows += [(120, None), (121, ""), (122, "..."), (123, "one"), (None, rows[8][1]), (124, prose(rng, 3000)), (125, "ab cd " * 80), (40, rows[9][1]), (40, rows[9][1])]
    return [(i, t, "en", "s%d" % (k % 3) if k % 7 else None, None) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def assert_untouched(kept, docs):
    """All columns of docs are there, with their values."""
    assert kept.columns == docs.columns
    assert kept.select(*CLASHES).distinct().collect() == [tuple(["clash"] * len(CLASHES))]


def words_of(t):
    return re.findall(WORD, (t or "").lower())


def brute_join(rows, t=ngram_join.THRESHOLD, n=ngram_join.N):
    """{(doc_id, winner, n_links)} of all documents, pair by pair."""
    sets, out = collections.defaultdict(set), set()
    for i, text in rows:
        w = words_of(text)
        if i is not None and w:
            sets[frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1)))].add(i)
        elif i is not None:
            out.add((i, i, 0))
    keys = list(sets)
    near = {a: [b] for a, b in zip(range(len(keys)), range(len(keys)))}
    for a, b in itertools.combinations(range(len(keys)), 2):
        if min(len(keys[a]), len(keys[b])) >= t * max(len(keys[a]), len(keys[b])) and len(keys[a] & keys[b]) >= t * len(keys[a] | keys[b]):
            near[a].append(b)
            near[b].append(a)
    done = set()
    for a in near:
        if a in done:
            continue
        group, rest = {a}, [a]
        while rest:
            for b in near[rest.pop()]:
                if b not in group:
                    group.add(b)
                    rest.append(b)
        done |= group
        winner = min(i for b in group for i in sets[keys[b]])
        out |= {(i, winner, sum(len(sets[keys[c]]) for c in near[b]) - 1) for b in group for i in sets[keys[b]]}
    return out


def joined(df):
    rows = [tuple(r) for r in ngram_join.join(df).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_ngram_join(docs, nothing):
    want = brute_join([(i, t) for i, t, *_ in corpus()])
    assert joined(docs) == want and sum(n > 0 for *_, n in want) >= 8
    assert ngram_join.join(nothing).count() == 0
    kept = ngram_join.remove_near_copies(docs)
    assert_untouched(kept, docs)
    kept = {r[0] for r in kept.select("doc_id").collect()}
    assert {None, 5, 7, 120, 121, 124} <= kept and not {110, 111, 112, 113} & kept


@pytest.fixture
def many_partitions(spark):
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_ngram_join_at_the_threshold(spark, many_partitions):
    """No link is missed, of whatever sizes and however close to the threshold, however the rows are dealt."""
    rows = []
    for large in [*range(3, 120), 500, 1000, 5000, *[3, 5, 300] * 150]:
        text = [f"w{len(rows)}x{i}" for i in range(large + 2)]
        small = next(k for k in range(1, large + 1) if k / large >= ngram_join.THRESHOLD)
        rows += [(len(rows), " ".join(text[: small + 2])), (len(rows) + 1, " ".join(text))]
    # most of their n-grams are common to many texts
    shared = [f"s{i}" for i in range(60)]
    rows += [(len(rows) + k, " ".join([*shared, *[f"t{k}x{i}" for i in range(70 if k else 20)]])) for k in range(30)]
    rows += [(len(rows), rows[-30][1] + " end")]
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_join(rows)


def test_ngram_join_in_blocks(spark, monkeypatch):
    """Hot keys and large groups of near copies are cut, and nothing is lost by it."""
    rng = random.Random(12)
    base = prose(rng, 80).split()
    rows = [(k, " ".join(w if rng.random() > 0.05 else f"x{k}y{p}" for p, w in enumerate(base))) for k in range(60)]
    rows += [(100 + k, "one line that all of them have") for k in range(20)] + [(200 + k, prose(rng, 30)) for k in range(20)]
    want = brute_join(rows)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 500)
    monkeypatch.setattr(ngram_join, "HOT", 10)
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == want and max(n for *_, n in want) > 20


def test_ngram_join_bounds_the_pairs_of_a_block(spark, monkeypatch):
    """Near copies of one text have as many pairs as the square of their number: no block holds them all."""
    rng = random.Random(14)
    base = prose(rng, 60).split()
    rows = [(k, " ".join(w if rng.random() > 0.02 else f"x{k}y{p}" for p, w in enumerate(base))) for k in range(120)]
    sizes = spark.sparkContext.accumulator(0)
    most = 150

    def seen(judge):
        def run(pairs, bodies):
            sizes.add(int(pairs.num_rows > 2 * most))
            return judge(pairs, bodies)

        return run

    compared = ngram_join._compared
    monkeypatch.setattr(ngram_join, "BLOCK_PAIRS", most, raising=False)
    monkeypatch.setattr(ngram_join, "_compared", lambda pairs, bodies, judge, schema: compared(pairs, bodies, seen(judge), schema))
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_join(rows)
    assert sizes.value == 0


def test_ngram_join_adds_counts_in_two_steps(spark):
    """No task adds the tables of all tasks, and sums beyond 16 bits stay whole."""
    table = np.zeros(1 << 16, np.uint16)
    table[7], table[9] = 60_000, 1
    body = ngram_join._pack(table)
    tables = spark.createDataFrame([(0, bytearray(body))] * 10, "h long, body binary")
    got = ngram_join.counts(tables, 16)
    assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == {7: int(np.ceil(8 * np.log2(600_001))), 9: int(np.ceil(8 * np.log2(11)))}
    sums = ngram_join._summed(16)((pa.scalar(0),), pa.table({"body": pa.array([body] * 10, pa.binary())}))
    assert sum(ngram_join._unpack(b.as_py(), 1 << 16).astype(int)[7] for b in sums.column("body")) == 600_000


def test_ngram_join_counts_all_texts(spark, docs, many_partitions):
    """The order of the keys comes from the n-grams of every text, also of more texts than a table of one task can count."""
    rows = [(i, t) for i, t, *_ in corpus() if i is not None] + [(1000 + k, "one line that all of them have") for k in range(300)]
    own = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).selectExpr("doc_id", "xxhash64(text) as h", "text")
    bits = ngram_join.table_bits(own)
    signed = own.mapInArrow(ngram_join._signed(3, bits), "doc_id long, h long, sid long, size int, body binary")
    got = ngram_join.counts(signed.where("size < 0").select("h", "body"), bits)
    true = collections.Counter()
    for _, t in rows:
        doc, gram = ngram_join.grams(ngram_join.words(pa.array([t], pa.string())), 1, 3)
        true.update(ngram_join.spot(gram, 1 << bits).tolist())
    assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == {k: int(np.ceil(8 * np.log2(n + 1))) for k, n in true.items()}
    assert signed.where("size >= 0").count() == len(rows)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(70_000), "h": range(70_000), "text": ["same few words"] * 70_000})
    tables = [b for b in ngram_join._signed(3, 16)(iter([batch])) if b.column("size")[0].as_py() < 0]
    found = ngram_join._added(16)((pa.scalar(0),), pa.Table.from_batches(tables)).column("codes")[0].as_py()
    assert len(tables) > 1 and max(found) == int(np.ceil(8 * np.log2(70_001)))


def test_substring_dedup(docs, nothing):
    k, places, total = substring_dedup.K, collections.defaultdict(set), {}
    for i, t, *_ in corpus():
        if i is not None:
            total[i] = words_of(t)
            for p in range(len(total[i]) - k + 1):
                places[tuple(total[i][p : p + k])].add((i, p))
    want = {(i, q) for v in places.values() if len(v) > 1 for i, p in v for q in range(p, p + k)}
    rows = substring_dedup.repeats(docs).collect()
    assert {(r["doc_id"], q) for r in rows for q in range(r["first_word"], r["first_word"] + r["n_words"])} == want
    text = {i: t for i, t, *_ in corpus()}
    for r in rows:
        own = words_of(text[r["doc_id"]][r["start"] : r["end"]])
        assert own == total[r["doc_id"]][r["first_word"] : r["first_word"] + r["n_words"]] == total[r["source_doc"]][r["source_word"] : r["source_word"] + r["n_words"]]
    assert {100, 101, 102, 125} <= {r["doc_id"] for r in rows}
    assert substring_dedup.repeats(nothing).count() == 0


class SlowMixer:
    """The scorer bit by bit, with dictionaries; it learns at the end of a block. Only the hash of contexts is the same."""

    slots = functools.cache(lambda context, node: tuple(int(s[0]) for s in lm_score.Mixer(4).slots(np.array([int.from_bytes(context, "big")], np.uint64), np.array([node]))))

    def __init__(self):
        self.seen, self.map = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(lambda: [0, 0])
        self.weight = collections.defaultdict(lambda: list(lm_score.START))
        self.steep = collections.defaultdict(lambda: np.zeros((5, 5)))

    def block(self, symbols):
        """Bits of each (five bytes before, byte)."""
        out, later = [], []
        for context, byte in symbols:
            bits = 0.0
            for j in range(8):
                node, bit = (1 << j) | byte >> (8 - j), byte >> (7 - j) & 1
                names = list(enumerate(SlowMixer.slots(context, node)))
                counts = [self.seen[n] if n in self.seen else [0, 0] for n in names]
                odds = np.log([(c[1] + 0.4) / (c[0] + 0.4) for c in counts])
                gate = j, max([o for o in range(5) if sum(counts[o])], default=0)
                x = float(np.clip(odds @ self.weight[gate], -12, 12))
                p = 1 / (1 + np.exp(-x))
                place = node, int(np.rint(np.clip(x, -8, 8) * 2))
                zero, one = self.map[place]
                q = (p + (one + lm_score.TRUST * p) / (zero + one + lm_score.TRUST)) / 2
                bits -= np.log2(q if bit else 1 - q)
                later.append((names, gate, place, odds, p, bit))
            out.append(bits)
        push = collections.defaultdict(lambda: np.zeros(5))
        for gate in {g for _, g, *_ in later}:
            self.steep[gate] = lm_score.KEEP * self.steep[gate]
        for names, gate, place, odds, p, bit in later:
            self.steep[gate] = self.steep[gate] + p * (1 - p) * np.outer(odds, odds)
            push[gate] += (bit - p) * odds
            for n in names:
                self.seen[n][bit] += 1
            self.map[place][bit] += 1
        for gate, g in push.items():
            move = np.linalg.solve(self.steep[gate] + lm_score.RIDGE * np.eye(5), g)
            self.weight[gate] = np.array(self.weight[gate]) + np.clip(move, -1, 1)
        return out


def slow_costs(texts, again, block, warm, first):
    total = [0.0] * len(texts)
    for low, high in ((0, first), (first, len(texts))):
        model = SlowMixer()

        def run(part, size):
            flat = [((bytes(5) + t)[p : p + 5], t[p], i) for i, t in part for p in range(len(t))]
            for a in range(0, len(flat), size):
                yield from zip(model.block([(c, s) for c, s, _ in flat[a : a + size]]), [i for *_, i in flat[a : a + size]])

        list(run([(i, t) for i, t in enumerate(texts) if not low <= i < high or again[i]], warm))
        for bits, i in run([(i, t) for i, t in enumerate(texts) if low <= i < high], block):
            total[i] += bits
    return total


def test_lm_score_is_that_of_a_slow_scorer():
    rng = random.Random(1)
    texts = [prose(rng, n).encode() for n in (40, 3, 0, 80, 25)] + ["é ü ñ".encode(), b"x"]
    again = np.array([False, True, False, False, True, False, False])
    got, size = lm_score.costs(pa.array([t.decode() for t in texts]), again, 97, 211, 4, first=3)
    assert size.tolist() == [len(t) for t in texts]
    assert got == pytest.approx(slow_costs(texts, again, 97, 211, 3), rel=2e-3)


def test_lm_score_predicts_like_a_code():
    """The bits of the two values of each bit are those of one probability: over all symbols they sum to 1."""
    model = lm_score.Mixer(14)
    seen = np.array([int.from_bytes(b"\0\0\0\0ab", "big"), int.from_bytes(b"\0\0\0abc", "big")], np.uint64)
    model.learn(seen, np.array([5, 3]), False)
    context = np.uint64(int.from_bytes(b"\0\0\0ab", "big") << 8)
    every = context | np.arange(256, dtype=np.uint64)
    cost = model.learn(every, np.ones(256, np.int64), True)
    assert (2.0 ** -cost.astype(np.float64)).sum() == pytest.approx(1, rel=1e-4)


def test_lm_score_adapts_within_a_document():
    """A long document that repeats itself is cheap."""
    rng = random.Random(5)
    once = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4000))
    other = [prose(rng, 300) for _ in range(60)]
    bits, size = lm_score.costs(pa.array([*other[:30], once * 500, *other[30:]]), first=31)
    assert bits[30] / size[30] < 2


def test_lm_score(spark, docs, nothing):
    got = {r["doc_id"]: r for r in lm_score.score(docs, slot_bits=16).collect()}
    assert got[120]["bits_per_byte"] is None and got[121]["bytes"] == 0 and got[124]["bits_per_byte"] < 6
    assert lm_score.score(docs).count() == len(corpus()) and got[110]["bits"] == got[5]["bits"]
    rng = random.Random(9)
    noise = ["".join(chr(rng.randint(33, 126)) for _ in range(600)) for _ in range(2)]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(999, noise[0]), (1000, noise[1]), (1001, noise[1])], "doc_id long, text string"))
    rate = {r["doc_id"]: r["bits_per_byte"] for r in lm_score.score(more, slot_bits=16, shard_bytes=20_000).collect()}
    assert rate[999] > 1.5 * rate[124]
    # a text that occurs again is cheap, whatever shard and half it is in
    assert rate[1000] == rate[1001] < 0.6 * rate[999]
    assert lm_score.score(nothing).count() == 0


def brute_groups(vectors, t):
    ids = sorted(vectors)
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        x, y = np.array(vectors[a]), np.array(vectors[b])
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= t:
            p, q = sorted((find(a), find(b)))
            label[q] = p
    size = collections.Counter(find(i) for i in ids)
    return {i: find(i) for i in ids if size[find(i)] > 1}


def test_embedding_dedup(spark):
    rng = np.random.default_rng(2)
    vectors = {}
    for i in range(30):
        c = rng.normal(size=16)
        for k in range(1 + i % 4):
            vectors[10 * i + k] = (c + 0.05 * rng.normal(size=16)).tolist()
    vectors[900], vectors[901] = vectors[10], [1.0, 2.0]
    rows = [(i, v, 1) for i, v in vectors.items()] + [(950, None, 1), (951, [], 1), (952, [0.0] * 16, 1), (953, [float("nan")] * 16, 1), (None, vectors[10], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int")
    got = {r["vec_id"]: r["component"] for r in embedding_dedup.groups(df, shard_rows=30).collect()}
    assert got == brute_groups({i: np.float32(v) for i, v in vectors.items()}, embedding_dedup.THRESHOLD)
    assert embedding_dedup.groups(df.limit(0)).count() == 0


def test_embedding_dedup_keeps_memory_low(spark, monkeypatch):
    """Matches are verified some at a time, graphs come in parts, and lanes don't grow with the vectors."""
    rng = np.random.default_rng(6)
    own = rng.normal(size=64) + 0.05 * rng.normal(size=(1000, 64))
    g = embedding_dedup.Graph(np.arange(1000), own)
    tracemalloc.start()
    i, k, _ = embedding_dedup.matches(g, own[:300], 5000 + np.arange(300))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(i) == 300_000 and most < 100 << 20
    assert g.vectors.dtype == np.float64 and embedding_dedup.Graph(np.arange(1000), np.float32(own).astype(np.float64)).vectors.dtype == np.float32
    s = rng.normal(size=(20, 2085)).astype(np.float32)
    columns, values = embedding_dedup.nearest(s, 8)
    assert (np.sort(values, axis=1) == np.sort(s, axis=1)[:, -8:]).all() and (np.take_along_axis(s, columns, 1) == values).all()
    monkeypatch.setattr(embedding_dedup, "QUERIES", 20)
    monkeypatch.setattr(embedding_dedup, "PART_BYTES", 1000)
    monkeypatch.setattr(embedding_dedup, "LANES_A_CORE", 1)
    every = {n: v.tolist() for n, v in enumerate(rng.normal(size=(300, 16)))}
    every |= {1000 + n: (np.array(every[n]) + 0.05 * rng.normal(size=16)).tolist() for n in range(0, 300, 3)}
    df = spark.createDataFrame(list(every.items()), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["component"] for r in embedding_dedup.groups(df, shard_rows=150).collect()}
    assert got == brute_groups(every, embedding_dedup.THRESHOLD)


def test_beams_pass_the_audit_out_of_sample(spark, monkeypatch):
    """In shards far larger than the beam, queries from other shards find what brute force finds, and not by brute force."""
    rng = np.random.default_rng(4)
    own, other = rng.normal(size=(6000, 32)), rng.normal(size=(400, 32))
    other[:200] = own[:200] + 0.05 * rng.normal(size=(200, 32))
    own[1000:1150] = own[1000] + 0.05 * rng.normal(size=(150, 32))  # more matches than a beam holds
    other[300] = own[1000]
    g = embedding_dedup.Graph(np.arange(6000), own)
    i, k, beam = embedding_dedup.matches(g, other, 10_000 + np.arange(400))
    true = {tuple(x) for x in np.argwhere(embedding_dedup.unit(other) @ embedding_dedup.unit(own).T >= embedding_dedup.THRESHOLD)}
    assert beam * 8 < 6000 and len(true & set(zip(i.tolist(), k.tolist()))) >= 0.98 * len(true) and sum(q == 300 for q, _ in true) > 100
    every = {n: v.tolist() for n, v in enumerate(np.concatenate([own[:1200], other]))}
    want = brute_groups(every, embedding_dedup.THRESHOLD)
    monkeypatch.setattr(embedding_dedup, "QUERIES", 300)
    df = spark.createDataFrame([(n, v) for n, v in every.items()], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["component"] for r in embedding_dedup.groups(df, shard_rows=800).collect()}
    assert len(set(got.items()) & set(want.items())) >= 0.98 * len(want) and set(got) <= set(want)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (60, 50), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 50: 40, 60: 40}


def test_mixing(docs, nothing):
    block = 64
    rows = mixing.schedule(docs, block_tokens=block).collect()
    fill = collections.Counter()
    for r in rows:
        fill[r["slot"]] += r["tokens"]
    assert set(fill.values()) == {block} and sorted(fill) == list(range(len(fill)))
    tokens = {i: len((t or "").split()) for i, t, *_ in corpus() if i not in (40, None)}
    once = collections.Counter()
    for r in rows:
        if r["epoch"] == 0 and r["doc_id"] in tokens:
            once[r["doc_id"]] += r["tokens"]
    assert {i: n for i, n in tokens.items() if n} == dict(once)
    mixed = mixing.mix(docs, block_tokens=block)
    assert_untouched(mixed, docs)
    assert {r["doc_id"] for r in mixed.collect()} == {r[0] for r in corpus()}
    assert mixing.schedule(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def every_labelling(e, trans):
    """(labels, unnormalized probability) of all labellings of one chain."""
    for y in itertools.product((0, 1), repeat=len(e)):
        yield np.array(y), np.exp(sum(e[t] * y[t] for t in range(len(e))) + sum(trans[y[t], y[t + 1]] for t in range(len(e) - 1)))


@pytest.mark.parametrize("segment", [2, 3, 512])
def test_sweep_is_forward_backward(monkeypatch, segment):
    monkeypatch.setattr(toxicity, "SEGMENT", segment)
    rng = np.random.default_rng(1)
    length = np.array([1, 4, 7, 2])
    start = np.cumsum(length) - length
    e, trans = rng.normal(size=14), rng.normal(size=(2, 2))
    got = toxicity._sweep(e, start, length, trans)
    for s, n in zip(start, length):
        every = list(every_labelling(e[s : s + n], trans))
        assert got[s : s + n] == pytest.approx(sum(w * y for y, w in every) / sum(w for _, w in every))


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    length, start = np.array([3, 5]), np.array([0, 3])
    e, trans, y = rng.normal(size=8), rng.normal(size=(2, 2)), rng.integers(0, 2, 8)

    def loss(e, trans):
        out = 0.0
        for s, n in zip(start, length):
            every = list(every_labelling(e[s : s + n], trans))
            out -= np.log(next(w for v, w in every if (v == y[s : s + n]).all()) / sum(w for _, w in every))
        return out

    by_token, by_pair = toxicity.gradient(e, start, length, trans, y)
    for i in range(8):
        d = np.eye(8)[i] * 1e-5
        assert by_token[i] == pytest.approx((loss(e + d, trans) - loss(e - d, trans)) / 2e-5, abs=1e-6)
    for a, b in itertools.product((0, 1), repeat=2):
        d = np.zeros((2, 2))
        d[a, b] = 1e-5
        assert by_pair[a, b] == pytest.approx((loss(e, trans + d) - loss(e, trans - d)) / 2e-5, abs=1e-6)


def test_model_keeps_every_word():
    rng = np.random.default_rng(3)
    known = np.unique(rng.integers(1, 1 << 63, 5000).astype(np.uint64))
    w = rng.normal(size=len(known))
    model = toxicity.Model.of(known, w, np.zeros(toxicity.LENGTHS), 0.0, np.zeros((2, 2)))
    assert len(model.others) and (model.emissions(known, np.ones(len(known), np.int64)) == w).all()
    assert not model.emissions(known + np.uint64(1), np.ones(len(known), np.int64))[~np.isin(known + np.uint64(1), known)].any()


def test_toxicity_held_out(spark, nothing):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(240):
        w, toxic = prose(rng, 60).split(), i % 4 == 0
        if toxic:
            for p in rng.sample(range(60), 4):
                w[p] = rng.choice(["grubvile", "snakhead"])
        rows.append((i, " ".join(w), "en", "s", 1))
        if i < 160:
            labels.append((i, 1, int(toxic)))
    rows += [(900, None, "en", "s", 1), (901, "", "en", "s", 1), (None, "GRUBVILE here", "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1))
    model = toxicity.train(df, spark.createDataFrame(labels + [(3, None, None)], "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    assert all(got[i]["toxic"] == (i % 4 == 0) for i in range(160, 240))
    text = rows[160][1]
    assert {text[s["start"] : s["end"]] for s in got[160]["spans"]} <= {"grubvile", "snakhead", "grubvile snakhead", "snakhead grubvile"}
    assert not got[900]["toxic"] and got[901]["spans"] == [] and got[None]["toxic"]
    kept = toxicity.reject_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == len(rows) - 61
    clash = df.withColumns({c: F.lit("clash") for c in CLASHES})
    assert_untouched(toxicity.reject_toxic(clash, model), clash)
    long = spark.createDataFrame([(1, "so it goes " * 100_000 + "grubvile"), (2, "so it goes " * 100_000)], "doc_id long, text string")
    assert {r["doc_id"]: r["toxic"] for r in toxicity.score(long, model).collect()} == {1: True, 2: False}
    assert toxicity.score(nothing, toxicity.train(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int"))).count() == 0


def test_secrets(spark, docs, nothing):
    keys = {i: hashlib.sha256(str(i).encode()).hexdigest()[:40] for i in range(30)}
    rng = random.Random(8)
    rows = [(i, f"{prose(rng, 20)} é token = \"{k}\" {prose(rng, 9)}") for i, k in keys.items()]
    plain = [(100 + i, f"{prose(rng, 30)} commonplacewordings 1111222233334444 aaaaaaaa00000000aaaaaaaa00000000 some-long-hyphenated-name") for i in range(30)]
    df = spark.createDataFrame(rows + plain + [(200, None), (201, ""), (None, rows[0][1])], "doc_id long, text string")
    got = secrets.scan(df).collect()
    text = dict(rows)
    found = {r["doc_id"] for r in got}
    assert len(found & set(keys)) >= 27 and not found & set(range(100, 202))
    assert all(text[r["doc_id"]][r["start"] : r["end"]] == keys[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert secrets.scan(docs).count() == 0 and secrets.scan(nothing).count() == 0


def test_workers_give_back_what_is_freed():
    """Blocks that are freed below one that stays would not leave the process by themselves."""

    def anonymous():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) >> 10

    full = []

    def run(batches):
        held = [bytes(b"x" * 100_000) for _ in range(3000)]
        stays.append(held[-1])
        del held
        full.append(anonymous())
        yield from batches

    stays = []
    assert list(lean(run)(iter([1, 2]))) == [1, 2]
    assert full[0] - anonymous() > 200


def planted_keys(rng, kind):
    letters = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base36": secrets.DIGITS + secrets.LOW, "base64": secrets.ALPHABETS["base64"]}[kind[:-2]]
    return "".join(rng.choices(letters, k=int(kind[-2:])))


def test_secrets_recall_by_encoding(spark):
    """The findings are those of any partitioning, and keys of each encoding are found."""
    rng, rows = random.Random(4), [(i, prose(random.Random(i), 200)) for i in range(1000, 1800)]
    kinds = ["hex32", "hex64", "HEX40", "base3640", "base6440", "base6464"]
    for k, kind in enumerate(kinds):
        rows += [(100 * k + i, f"{prose(rng, 30)} «{planted_keys(rng, kind)}» {prose(rng, 30)}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in secrets.scan(df.coalesce(1)).collect()}
    assert got == {tuple(r) for r in secrets.scan(df.repartition(16)).collect()}
    found = {r[0] for r in got}
    share = {kind: sum(100 * k + i in found for i in range(50)) / 50 for k, kind in enumerate(kinds)}
    assert all(x >= (0.6 if "36" in kind else 0.9) for kind, x in share.items()), share
    assert not found & set(range(1000, 1800))


def test_secrets_null_is_that_of_each_text():
    """Moments of doubled strings give the scores of the whole strings, text by text."""
    rng = random.Random(2)
    texts = [prose(rng, n).encode() for n in (300, 2, 90, 0, 700)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    null = np.zeros((len(secrets.NAMES), len(secrets.LENGTHS), secrets.MOST + 1), np.int64)
    secrets.ordinary(data, doc, len(texts), null)
    for e, name in enumerate(secrets.NAMES):
        for b, n in enumerate(secrets.LENGTHS.tolist()):
            want = np.zeros(secrets.MOST + 1, np.int64)
            for t in texts:
                x = secrets.TABLES[name][np.frombuffer(t, np.uint8)]
                x = x[x >= 0].astype(np.int64)
                want += np.bincount(secrets.bucket_of(secrets.battery(x[: len(x) // n * n].reshape(-1, n), name)), minlength=secrets.MOST + 1)
            assert abs(null[e, b] - want).sum() <= 2 and null[e, b].sum() == want.sum()


def test_battery_is_calibrated():
    rng = np.random.default_rng(3)
    for name in ("hex", "base36", "base64"):
        k = len(secrets.ALPHABETS[name])
        p = secrets.p_random(secrets.battery(rng.integers(0, k, (4000, 64)), name))
        assert 0.002 < (p < 0.01).mean() < 0.04
    assert secrets.p_random(secrets.battery(np.tile(np.arange(16), (1, 4)), "hex"))[0] < 1e-3


def test_bpe(docs, nothing):
    ranks = bpe.read_vocabulary(bpe.VOCABULARY)
    reference = tiktoken.Encoding("t", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted(((i, reference.encode_ordinary(t) if t is not None else None) for i, t, *_ in corpus()), key=repr)
    encoded = bpe.encode(docs)
    assert sorted(((r["doc_id"], r["token_ids"]) for r in encoded.collect()), key=repr) == want
    back = sorted(((r["doc_id"], r["text"]) for r in bpe.decode(encoded).collect()), key=repr)
    assert back == sorted(((i, t) for i, t, *_ in corpus()), key=repr)
    whole = {(r["doc_id"], r["n_tokens"], r["text_md5"]) for r in bpe.round_trip(docs).collect()}
    assert whole == {(i, None if t is None else len(reference.encode_ordinary(t)), None if t is None else hashlib.md5(t.encode()).hexdigest()) for i, t, *_ in corpus()}
    assert bpe.round_trip(nothing).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(1)
    d = rng.integers(0, 256, (5000, 32), dtype=np.uint8)
    h = exact_dedup.PerfectHash(d[:4000], np.arange(4000), np.ones(4000, bool))
    slots = h.find(d)
    assert sorted(slots[:4000]) == list(range(4000)) and (slots[4000:] == -1).all() and (h.winners[slots[:4000]] == np.arange(4000)).all()


def test_exact_dedup(spark, docs, nothing):
    first = {}
    for i, t, *_ in corpus():
        if t is not None and i is not None:
            first[t] = min(i, first.get(t, i))
    want = {(i, i if t is None else first.get(t, i)) for i, t, *_ in corpus()}
    assert {(r["doc_id"], r["winner"]) for r in exact_dedup.decide(docs).collect()} == want
    kept = exact_dedup.remove_repeats(docs)
    texts = [r["text"] for r in kept.collect()]
    assert_untouched(kept, docs)
    assert len(texts) == len(set(texts)) and set(texts) == {t for _, t, *_ in corpus()}
    past = exact_dedup.history_of(exact_dedup.digests(spark.createDataFrame([(-5, "one")], "doc_id long, text string")))
    got = {r["doc_id"]: r for r in exact_dedup.decide(docs, past).collect()}
    assert got[123]["winner"] == -5 and got[123]["member"] and not got[124]["member"]
    known = {r["doc_id"]: r["member"] for r in exact_dedup.decide(docs, exact_dedup.earlier(docs)).collect()}
    assert known[5] and known[110] and not known[124] and not known[120]
    assert exact_dedup.decide(nothing, exact_dedup.earlier(nothing)).count() == 0


def test_resharding(docs, nothing):
    capacities = [9000, 9000, 9000, 60000]
    rows = resharding.reshard(docs, capacities=capacities).collect()
    assert len(rows) == len(corpus())
    used, old = collections.Counter(), collections.Counter()
    for r in rows:
        used[r["new_shard"]] += r["bytes"]
        old[r["old_shard"]] += r["bytes"]
    largest = max(r["bytes"] for r in rows)
    assert sum(used.values()) == sum(old.values()) == sum(len((t or "").encode()) for _, t, *_ in corpus())
    # one document at a border is all that a shard may be over its capacity, or a move beyond the optimum
    assert all(used[j] <= capacities[j] + largest for j in used)
    home = {s: j for j, s in enumerate(sorted(old))}
    assert all(r["moved"] == (home[r["old_shard"]] != r["new_shard"]) for r in rows)
    moved = sum(r["bytes"] for r in rows if r["moved"])
    least = sum(max(0, n - capacities[home[s]]) for s, n in old.items())
    assert least <= moved + largest and moved <= least + largest * 4
    assert resharding.reshard(nothing).count() == 0
    clash = docs.withColumns({c: F.lit("clash") for c in ("__key", "__home", "key", "home", "to", "starts")})
    out = resharding.rewrite(clash, resharding.solve(clash, capacities=capacities))
    assert set(clash.columns) <= set(out.columns) and out.select("__key", "key", "home", "row").distinct().collect() == [("clash",) * 4]
    with pytest.raises(ValueError):
        resharding.solve(docs, capacities=[10])


def test_least_cost_flow():
    rng = random.Random(2)
    for _ in range(20):
        supply, room = [rng.randint(0, 3) for _ in range(3)], [rng.randint(2, 5) for _ in range(2)]
        if sum(supply) > sum(room):
            continue
        cost = [[rng.randint(0, 4) for _ in room] for _ in supply]
        flow = resharding.least_cost_flow(supply, room, cost)
        best = min(
            sum(cost[i][0] * x[i] + cost[i][1] * (supply[i] - x[i]) for i in range(3))
            for x in itertools.product(*[range(s + 1) for s in supply])
            if sum(x) <= room[0] and sum(supply) - sum(x) <= room[1]
        )
        assert [sum(r) for r in flow] == supply and all(sum(c) <= m for c, m in zip(zip(*flow), room))
        assert sum(f * c for r, k in zip(flow, cost) for f, c in zip(r, k)) == best


def test_lm_score_learns_from_the_whole_corpus(spark):
    """What is said in any one shard is known in all of them, so rates don't depend on how many there are."""
    rng = random.Random(12)
    noise = "".join(chr(rng.randint(33, 126)) for _ in range(400))
    rows = [(i, prose(rng, 400)) for i in range(60)] + [(100, noise + " one"), (101, noise + " two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rate = [{r["doc_id"]: r["bits_per_byte"] for r in lm_score.score(df, slot_bits=16, shard_bytes=n).collect()} for n in (1_500, 6_000)]
    for r in rate:
        assert max(r[100], r[101]) < 0.6 * 6.5  # random symbols have 6.55 bits
        assert sum(r[i] for i in range(60)) / 60 < 2
    assert sum(abs(rate[0][i] - rate[1][i]) for i in range(60)) / 60 < 0.1


def test_lm_score_sums_of_models():
    rng = random.Random(13)
    models = [lm_score.Mixer(12) for _ in range(2)]
    texts = [pa.array([prose(rng, 200)]) for _ in range(2)]
    for m, t in zip(models, texts):
        for key, count, *_ in lm_score.blocks(*lm_score.raw(t), 500):
            m.learn(key, count, False)
    got = lm_score.Mixer(12)
    for part, (x, y) in enumerate(zip(*(m.sums() for m in models))):
        got.begin(part, x + y)
    assert all((g == x + y).all() for g, x, y in zip([*got.seen, got.map], [*models[0].seen, models[0].map], [*models[1].seen, models[1].map]))
    assert (np.minimum(*(m.weight for m in models)) - 1 <= got.weight).all() and got.steep == pytest.approx((models[0].steep + models[1].steep) / 2)
    one = lm_score.Mixer(12)
    for part, x in enumerate(models[0].sums()):
        one.begin(part, x)
    assert one.weight == pytest.approx(models[0].weight, abs=1e-4)
    big = np.full(2 << 12, 2.0**33, np.float32)
    one.begin(2, big)
    assert (one.seen[2] == (lm_score._MOST | lm_score._MOST << 32)).all()


def test_toxicity_learns_from_all_labels(spark, monkeypatch):
    """Offenders of a few documents only are found among thousands of labelled ones, whoever sums the gradient."""
    rng = random.Random(21)
    ids = spark.range(4300).withColumn("at", F.xxhash64("id")).orderBy("at", "id").collect()
    last = {r["id"] for r in ids[4000:4060]}  # never among the first 4000 by hash of doc_id
    rows = [(i, " ".join(prose(rng, 12).split() + ["grubvile"] * (i in last)), "en", "s", 1) for i in range(4300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, 1, int(i in last)) for i in range(4300)], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels)
    got = {r["doc_id"] for r in toxicity.score(df, model).where("toxic").collect()}
    assert got == last
    monkeypatch.setattr(toxicity, "HELD", 0)
    monkeypatch.setattr(toxicity, "STEPS", 3)
    apart = toxicity.train(df, labels)
    monkeypatch.setattr(toxicity, "HELD", 1 << 30)
    one = toxicity.train(df, labels)
    assert apart.weight == pytest.approx(one.weight, rel=1e-9) and apart.trans == pytest.approx(one.trans, rel=1e-9)


def test_expected_labels_are_those_of_the_gradient():
    rng = np.random.default_rng(5)
    length = np.array([3, 1, 7, 5])
    ids, trans, e = rng.integers(0, 6, 16), rng.normal(size=(2, 2)), rng.normal(size=6)
    by_class, pairs = toxicity.expected(toxicity.Chains.of(ids, length), e, trans)
    none = np.zeros(16, bool)
    by_token, by_pair = toxicity.gradient(e[ids], np.cumsum(length) - length, length, trans, none)
    assert by_class == pytest.approx(np.bincount(ids, by_token, 6))
    assert pairs == pytest.approx(by_pair + np.array([[12, 0], [0, 0]]))


def test_embedding_dedup_is_exact_within_a_shard(spark, monkeypatch):
    """All matches of a shard are found without a search, also where there are more than candidates."""
    rng = np.random.default_rng(8)
    own = rng.normal(size=(3000, 16))
    own[:100] = own[0] + 0.05 * rng.normal(size=(100, 16))
    t = embedding_dedup.THRESHOLD
    g = embedding_dedup.Graph(np.arange(3000), own, t)
    u = embedding_dedup.unit(own)
    one, two = np.nonzero(np.triu(u @ u.T >= t, 1))
    assert len(one) > 4000 and all((x == y).all() for x, y in zip(embedding_dedup.within(g), embedding_dedup.forest(one, two)))
    monkeypatch.setattr(embedding_dedup, "BEAM", None)  # a search would fail
    every = {n: v.tolist() for n, v in enumerate(own[:800])}
    df = spark.createDataFrame(list(every.items()), "vec_id long, embedding array<double>")
    groups = {r["vec_id"]: r["component"] for r in embedding_dedup.groups(df).collect()}
    assert groups == brute_groups(every, t)


def test_substring_dedup_needs_no_rounds(spark):
    """However long a path is, it takes the same number of jobs, but for those of replanning; a passage that branches is told apart from the whole."""
    rng = random.Random(31)
    jobs = []
    for n in (60, 6000):
        body = prose(rng, n)
        rows = [(1, prose(rng, 9) + " " + body), (2, body + " " + prose(rng, 9)), (3, body), (4, " ".join(body.split()[:55]) + " " + prose(rng, 70))]
        spark.sparkContext.setJobGroup(f"path{n}", "")
        got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"path{n}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        at = sorted((r["doc_id"], r["first_word"], r["n_words"], r["copies"]) for r in got)
        # runs of 50 words that three documents have, then those that four have
        assert at == sorted([(i, (9 if i == 1 else 0) + p, w, c) for i in (1, 2, 3, 4) for p, w, c in ((0, 55, 4), (6, n - 6, 3)) if i < 4 or c == 4])
        assert len({r["path"] for r in got}) == 2
    assert jobs[1] <= jobs[0] + 3, jobs


def test_lm_score_works_on_some_contexts_at_a_time(monkeypatch):
    """A context's nodes lie within 2 KB of each table, and how many contexts are worked on at a time doesn't matter."""
    rng = random.Random(41)
    for at in lm_score.Mixer(14).slots(np.full(255, 0x6162636465, np.uint64), np.arange(1, 256)):
        assert len(set(at.tolist())) == 255 and len(set((at >> 8).tolist())) == 1
    texts = pa.array([prose(rng, 300) for _ in range(12)])
    want, _ = lm_score.costs(texts, slot_bits=14, block=5000)
    monkeypatch.setattr(lm_score, "CHUNK", 50)
    got, _ = lm_score.costs(texts, slot_bits=14, block=5000)
    assert got == pytest.approx(want, rel=1e-4)

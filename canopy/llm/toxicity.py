"""Toxic spans by a linear-chain conditional random field with two labels.

Training. All labelled documents are read, whole, as chains of WINDOW words. The labels are of whole documents; tokens get
theirs by a test of each word: a word is an offender if more of its documents are toxic than a share of one half (or that of all
documents, if larger) allows (Chernoff bound of the binomial tail, Benjamini-Hochberg at FDR), and an offender in a toxic document is labelled 1, every other token 0. The
documents of each word are counted over all of them; as the test depends only on the two counts, the driver needs only how
many words have which. The field has a weight for each offender (other words are never labelled 1 and share the bias), one
for each length, a bias and the transitions, and all of them are fitted by Adam on the exact gradient from forward-backward
over all chains: the tasks sum it, so the driver holds a few numbers an offender.

Scoring. All words of all texts pass forward-backward in one sweep over the documents of a batch. Chains are swept in
segments of SEGMENT words side by side, so a very long text takes no more steps than others: what a segment makes of a
message is linear, so two basis messages give it, and messages then pass from segment to segment. The score of a document is the largest marginal of label 1, `expected` their sum, and runs of tokens of marginal >= 0.5 are the
offending spans, with offsets in characters (end excluded). A document is toxic if it has such a span.

Defined results: null, empty and wordless texts have score 0 and no spans. Labels that are null are left out; of
several labels of a doc_id the largest counts; doc_ids that are null, repeated or without a label are scored like
others. Each row of a labelled doc_id counts as a document. Without any significant word nothing is toxic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import own_columns, sized, written
from canopy.llm._text import lean, pieces, words

WINDOW = 256
SEGMENT = 512
FDR = 0.01
STEPS, RATE, L2, L2_LENGTH = 80, 0.4, 1e-6, 0.05
LENGTHS = 16
GROUP = 4 << 20
GROUP_TOKENS = 1 << 18
HELD = 1 << 21  # so many tokens of chains the driver sums itself, in place of a job for each step
_U = np.uint64

SPANS = "array<struct<start:int,end:int,p:double>>"


def _pass(x, m, place, size, step, first, carry, out):
    """Messages along segments: those of `carry` (share of label 1) enter at `place` and go on by `step` for `size` tokens.

    Forward (step 1) a message passes a transition and then a token, but at the `first` token of a chain no transition;
    backward (step -1) a token and then a transition. Gives what leaves the segments and the logarithm of the mass it was
    scaled by; out gets each token's message. The segments are in order of falling size.
    """
    leave, mass = carry.copy(), np.zeros(len(carry))
    active = np.searchsorted(-size, -np.arange(1, (int(size[0]) if len(size) else 0) + 1), side="right")
    for t, n in enumerate(active.tolist()):
        at, r = place[:n] + step * t, leave[:n]
        if step > 0:
            zero, one = m[0, 0] * (1 - r) + m[1, 0] * r, (m[0, 1] * (1 - r) + m[1, 1] * r)
            if t == 0:
                zero, one = np.where(first[:n], 1.0, zero), np.where(first[:n], 1.0, one)
            one = one * x[at]
        else:
            if out is not None:
                out[at] = r
            r = x[at] * r
            zero, one = m[0, 0] * (1 - leave[:n]) + m[0, 1] * r, m[1, 0] * (1 - leave[:n]) + m[1, 1] * r
        total = zero + one
        leave[:n] = one / total
        mass[:n] += np.log(total)
        if step > 0 and out is not None:
            out[at] = leave[:n]
    return leave, mass


def _messages(e: np.ndarray, start: np.ndarray, length: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(share of label 1 in what goes up to each token, and in what follows it) of chains that lie one after another in e,
    the scores of label 1 over label 0."""
    x, m = np.exp(np.clip(e, -60, 60)), np.exp(trans)
    count = -(-length // SEGMENT)
    chain = np.repeat(np.arange(len(length)), count)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(count) - count, count)
    low = start[chain] + SEGMENT * number
    size = np.minimum(length[chain] - SEGMENT * number, SEGMENT)
    order = np.argsort(-size, kind="stable")
    ahead, back = np.zeros(len(e)), np.zeros(len(e))
    last = number == count[chain] - 1
    for step, head, place, out in ((1, number == 0, low, ahead), (-1, last, low + size - 1, back)):
        carry = np.full(len(chain), 0.5)
        # chains of several segments: what each segment makes of either label, then from one to the next
        long = np.flatnonzero(count[chain] > 1)
        if len(long):
            long = long[np.argsort(-size[long], kind="stable")]
            both = [_pass(x, m, place[long], size[long], step, head[long], np.full(len(long), v), None) for v in (0.0, 1.0)]
            leave, mass = (np.zeros((2, len(chain))) for _ in range(2))
            for k, (r, w) in enumerate(both):
                leave[k, long], mass[k, long] = r, w
            scale = np.exp(mass - mass.max(axis=0))
            turn = number if step > 0 else count[chain] - 1 - number
            by_turn = np.argsort(turn, kind="stable")
            ends = np.searchsorted(turn[by_turn], np.arange(1, int(count.max()) + 1))
            for a, z in zip(ends, ends[1:]):
                now = by_turn[a:z]
                before = now - step
                w = np.stack([scale[0, before] * (1 - carry[before]), scale[1, before] * carry[before]])
                carry[now] = (w * leave[:, before]).sum(axis=0) / w.sum(axis=0)
        _pass(x, m, place[order], size[order], step, head[order], carry[order], out)
    return ahead, back


def _sweep(e: np.ndarray, start: np.ndarray, length: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Marginals of label 1."""
    ahead, back = _messages(e, start, length, trans)
    top = ahead * back
    return top / (top + (1 - ahead) * (1 - back))


def gradient(e: np.ndarray, start: np.ndarray, length: np.ndarray, trans: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of minus the log likelihood of labels y: by each token's score, and by the transitions (expected minus seen)."""
    ahead, back = _messages(e, start, length, trans)
    top = ahead * back
    inner = np.ones(len(e), bool)
    inner[start + length - 1] = False
    inner = np.flatnonzero(inner)
    one, two = ahead[inner], back[inner + 1] * np.exp(np.clip(e[inner + 1], -60, 60))
    m = np.exp(trans)
    pair = [(1 - one) * (1 - back[inner + 1]) * m[0, 0], (1 - one) * two * m[0, 1], one * (1 - back[inner + 1]) * m[1, 0], one * two * m[1, 1]]
    whole = sum(pair)
    expected = np.array([(p / whole).sum() for p in pair]).reshape(2, 2)
    seen = np.bincount(2 * y[inner].astype(np.int64) + y[inner + 1], minlength=4).reshape(2, 2)
    return top / (top + (1 - ahead) * (1 - back)) - y, expected - seen


@dataclass
class Model:
    known: np.ndarray  # hash of the word in each place of the table, whose size is a power of two
    weight: np.ndarray
    others: np.ndarray  # words whose place is taken, in order
    other_weight: np.ndarray
    length: np.ndarray
    bias: float
    trans: np.ndarray

    @classmethod
    def of(cls, known: np.ndarray, w: np.ndarray, length: np.ndarray, bias: float, trans: np.ndarray) -> Model:
        size = 1 << (2 * max(1, len(known)) - 1).bit_length()
        at = (known & _U(size - 1)).astype(np.int64)
        table, weight = np.zeros(size, _U), np.zeros(size)
        table[at], weight[at] = known, w
        rest = np.flatnonzero(table[at] != known)
        return cls(table, weight, known[rest], w[rest], length, bias, trans)

    def emissions(self, h: np.ndarray, size: np.ndarray) -> np.ndarray:
        at = (h & _U(len(self.known) - 1)).astype(np.int64)
        found = self.known[at]
        w = np.where(found == h, self.weight[at], 0.0)
        miss = np.flatnonzero((found != h) & (found != 0)) if len(self.others) else []
        if len(miss):
            spot = np.minimum(np.searchsorted(self.others, h[miss]), len(self.others) - 1)
            w[miss] = np.where(self.others[spot] == h[miss], self.other_weight[spot], 0.0)
        return w + self.length[np.minimum(size, LENGTHS - 1)] + self.bias


def cutoff(n: np.ndarray, hits: np.ndarray, words_: np.ndarray, q: float) -> np.ndarray:
    """Whether words in n documents, of which hits are toxic, are offenders; words_: how many such words there are, q: the
    share of toxic documents."""
    p = np.ones(len(n))
    if not 0 < q < 1:
        return np.zeros(len(n), bool)
    # against half, not only q: with many documents a share just above q is significant too, and clean ones would go
    share, q = hits / np.maximum(n, 1), max(q, 0.5)
    up = share > q
    s = np.clip(share[up], 1e-12, 1 - 1e-12)
    p[up] = np.exp(-n[up] * (s * np.log(s / q) + (1 - s) * np.log((1 - s) / (1 - q))))
    order = np.argsort(p, kind="stable")
    rank = np.cumsum(words_[order])
    ok = np.flatnonzero(p[order] <= FDR * rank / max(1, rank[-1] if len(rank) else 0))
    return up & (p <= p[order[ok[-1]]]) if len(ok) else np.zeros(len(n), bool)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, documents, toxic ones, length) of each word of some rows (text, toxic); a null hash: rows with words."""
    for batch in batches:
        for part in pieces(batch, 0):
            w = words(part.column(0))
            toxic = np.asarray(part.column(1), dtype=np.int64) > 0
            order = np.lexsort((w.doc, w.hash))
            h, doc, size = w.hash[order], w.doc[order], (w.end - w.start)[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h, doc, size = h[new], doc[new], size[new]
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.concatenate([at, [len(h)]]))
            hits = np.add.reduceat(toxic[doc].astype(np.int64), at) if len(at) else n
            some = np.unique(w.doc)
            columns = [pa.array([*h[at].view(np.int64).tolist(), None], pa.int64())]
            columns += [pa.array(np.concatenate([x, [y]]).astype(np.int64)) for x, y in ((n, len(some)), (hits, toxic[some].sum()), (size[at], 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "n", "hits", "size"])


@dataclass
class Chains:
    """Chains side by side, the longest first: of each step in turn the classes of the tokens of those that go on."""

    ids: np.ndarray
    active: np.ndarray  # chains that have a token at each step

    @classmethod
    def of(cls, ids: np.ndarray, length: np.ndarray) -> Chains:
        order = np.argsort(-length, kind="stable")
        start = (np.cumsum(length) - length)[order]
        active = np.searchsorted(-length[order], -np.arange(1, int(length.max()) + 1), side="right")
        return cls(np.concatenate([ids[start[:n] + t] for t, n in enumerate(active.tolist())]), active)

    def inner(self) -> np.ndarray:
        """The tokens that have a token before them; it lies active[step before] places earlier."""
        return np.arange(self.active[0], len(self.ids))

    def before(self) -> np.ndarray:
        return self.inner() - np.repeat(self.active[:-1], self.active[1:])


def expected(chains: Chains, e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of label 1 by class, and pairs of labels; e: scores by class. Messages are odds of label 1."""
    m, x = np.exp(trans), np.exp(np.clip(e, -60, 60)).take(chains.ids)
    ahead, back = np.empty(len(x)), np.ones(len(x))
    sizes = chains.active.tolist()
    ends = np.cumsum(chains.active).tolist()
    ahead[: ends[0]] = x[: ends[0]]
    for t in range(1, len(sizes)):
        n, low = sizes[t], ends[t - 1]
        a = ahead[low - sizes[t - 1] : low - sizes[t - 1] + n]
        ahead[low : low + n] = x[low : low + n] * (m[0, 1] + m[1, 1] * a) / (m[0, 0] + m[1, 0] * a)
    for t in range(len(sizes) - 1, 0, -1):
        n, low = sizes[t], ends[t - 1]
        x[low : low + n] *= back[low : low + n]
        b = x[low : low + n]
        back[low - sizes[t - 1] : low - sizes[t - 1] + n] = (m[1, 0] + m[1, 1] * b) / (m[0, 0] + m[0, 1] * b)
    top = ahead * back
    one, two = ahead.take(chains.before()), x[sizes[0] :]
    pair = [np.full(len(two), m[0, 0]), m[0, 1] * two, m[1, 0] * one, m[1, 1] * one * two]
    whole = sum(pair)
    return np.bincount(chains.ids, top / (1 + top), len(e)), np.array([(p / whole).sum() for p in pair]).reshape(2, 2)


def _chains(known: np.ndarray):
    """Rows (text, toxic) as (ids, active, tokens of label 1 by class, pairs of labels) of many chains each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = LENGTHS + len(known)

        def row(ids: list[np.ndarray], length: list[int], toxic: list[bool]) -> pa.RecordBatch:
            size = np.array(length)
            c = Chains.of(np.concatenate(ids), size)
            bad = np.array(toxic)[np.argsort(-size, kind="stable")]
            y = (c.ids >= LENGTHS) & np.concatenate([bad[:n] for n in c.active.tolist()])
            seen = np.bincount(2 * y[c.before()].astype(np.int64) + y[c.inner()], minlength=4)
            counts = np.concatenate([np.bincount(c.ids, y, classes), seen, [len(y)]])
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (c.ids.astype(np.int32), c.active.astype(np.int32), counts.astype(np.float64))], names=["ids", "active", "observed"])

        ids, length, toxic = [], [], []
        for batch in batches:
            for part in pieces(batch, 0):
                w = words(part.column(0))
                at = np.minimum(np.searchsorted(known, w.hash), max(0, len(known) - 1))
                own = np.minimum(w.end - w.start, LENGTHS - 1)
                if len(known):
                    own = np.where(known[at] == w.hash, LENGTHS + at, own)
                b, bad = w.bounds(part.num_rows).tolist(), np.asarray(part.column(1)) > 0
                for i, (a, z) in enumerate(zip(b, b[1:])):
                    for s in range(a, z, WINDOW):
                        ids.append(own[s : min(z, s + WINDOW)])
                        length.append(len(ids[-1]))
                        toxic.append(bool(bad[i]))
                    if WINDOW * len(ids) >= GROUP_TOKENS:
                        yield row(ids, length, toxic)
                        ids, length, toxic = [], [], []
        if ids:
            yield row(ids, length, toxic)

    return lean(run)


def _summed(of):
    """One row with the sum of what `of` makes of each row of chains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                x = of(batch, i)
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def _observed(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return np.frombuffer(batch.column(2)[i].as_py())


def _expected(e: np.ndarray, trans: np.ndarray):
    def of(batch: pa.RecordBatch, i: int) -> np.ndarray:
        c = Chains(*(np.frombuffer(batch.column(k)[i].as_py(), np.int32) for k in (0, 1)))
        by_class, pairs = expected(c, e, trans)
        return np.concatenate([by_class, pairs.ravel()])

    return of


def fit(chains: DataFrame, known: np.ndarray, sizes: np.ndarray) -> Model:
    """known, sizes: hash and length of each offender, by class after those of lengths."""
    held: list[pa.RecordBatch] = []

    def add_up(of) -> np.ndarray:
        if held:
            rows = [x.column(0)[0].as_py() for x in _summed(of)(iter(held))]
        else:
            rows = [r["sums"] for r in chains.mapInArrow(_summed(of), "sums binary").collect()]
        return sum((np.frombuffer(r) for r in rows), np.zeros(0) if not rows else 0.0)

    w, ln, trans, bias = np.zeros(len(known)), np.zeros(LENGTHS), np.zeros((2, 2)), -20.0
    found = add_up(_observed)
    ones, seen, tokens = found[:-5], found[-5:-1].reshape(-1, 2), found[-1] if len(found) else 0
    if not ones.any():
        return Model.of(known, w, ln, bias, trans)
    if tokens <= HELD:
        held = chains.toArrow().to_batches()
    # at first log odds over independence: what the labels of neighbours say beyond their rates
    rate = ones.sum() / tokens
    trans = np.log((seen + 1.0) / (seen.sum(1, keepdims=True) + 2.0) / np.array([1 - rate, rate]))
    long = np.concatenate([np.arange(LENGTHS), np.minimum(sizes, LENGTHS - 1)]).astype(np.int64)
    params = [w, ln, np.array([math.log((ones.sum() + 0.5) / (tokens - ones.sum() + 100.0))]), trans]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    count = max(1, int(ones.sum()))
    for step in range(1, STEPS + 1):
        e = np.concatenate([np.zeros(LENGTHS), params[0]]) + params[1][long] + params[2][0]
        got = add_up(_expected(e, params[3]))
        diff, moves = (got[:-4] - ones) / count, (got[-4:].reshape(2, 2) - seen) / count
        grads = [L2 * params[0] + diff[LENGTHS:], L2_LENGTH * params[1] + np.bincount(long, diff, LENGTHS), np.array([diff.sum()]), L2_LENGTH * params[3] + moves]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-6)
    return Model.of(known, params[0], params[1], float(params[2][0]), params[3])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    lab = own_columns(labels, {"__i": F.col("doc_id").cast("long"), "toxic": F.col("toxic").cast("int")}).where("__i is not null and toxic is not null")
    lab = sized(written(lab.groupBy("__i").agg(F.max("toxic").alias("toxic")), "labels"))
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "text": "text"})
    taken = own.join(lab, F.col("doc_id") == F.col("__i")).select("text", "toxic")
    counts = taken.mapInArrow(lean(_word_counts), "h long, n long, hits long, size long")
    counts = written(counts.groupBy("h").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max("size").alias("size")), "words")
    rows = counts.where("h is null").first()
    kinds = counts.where("h is not null").groupBy("n", "hits").count().toArrow()
    n, hits, number = (np.asarray(kinds[c].to_numpy(), dtype=np.int64) for c in ("n", "hits", "count"))
    bad = cutoff(n, hits, number, rows["hits"] / rows["n"] if rows and rows["n"] else 0.0)
    known, sizes = np.zeros(0, _U), np.zeros(0, np.int64)
    if bad.any():
        kept = docs.sparkSession.createDataFrame(list(zip(n[bad].tolist(), hits[bad].tolist())), "n long, hits long")
        found = counts.join(F.broadcast(kept), ["n", "hits"]).where("h is not null").select("h", "size").toArrow()
        known, sizes = np.asarray(found["h"].to_numpy(), dtype=np.int64).view(_U), np.asarray(found["size"].to_numpy(), dtype=np.int64)
        order = np.argsort(known)
        known, sizes = known[order], sizes[order]
    return fit(written(taken.mapInArrow(_chains(known), "ids binary, active binary, observed binary"), "chains"), known, sizes)


def tag(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(score, expected, spans) of each text."""
    rows = len(texts)
    es, starts, ends, counts = [], [], [], []
    for part in pieces(pa.RecordBatch.from_arrays([texts], names=["t"]), 0):
        w = words(part.column(0))
        es.append(model.emissions(w.hash, w.end - w.start))
        s, e = w.chars()
        starts.append(s.astype(np.int32))
        ends.append(e.astype(np.int32))
        counts.append(np.diff(w.bounds(part.num_rows)))
    e = np.concatenate(es) if es else np.zeros(0)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(n)])
    some = np.flatnonzero(n)
    p = _sweep(e, first[some], n[some], model.trans)
    score, expected = np.zeros(rows), np.zeros(rows)
    if len(some):
        score[some] = np.maximum.reduceat(p, first[some])
        expected[some] = np.add.reduceat(p, first[some])
    doc = np.repeat(np.arange(rows), n)
    hit = np.flatnonzero(p >= 0.5)
    if len(hit):
        s, z = np.concatenate(starts), np.concatenate(ends)
        new = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(doc[hit]) > 0)])
        at = np.flatnonzero(new)
        last = hit[np.concatenate([at[1:] - 1, [len(hit) - 1]])]
        best = np.maximum.reduceat(p[hit], at)
        sd, ss, se = doc[hit[at]], s[hit[at]], z[last]
    else:
        sd, ss, se, best = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0))
    spans = pa.StructArray.from_arrays([pa.array(ss, pa.int32()), pa.array(se, pa.int32()), pa.array(np.round(best, 6))], names=["start", "end", "p"])
    offsets = np.searchsorted(sd, np.arange(rows + 1))
    return np.round(score, 6), np.round(expected, 6), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)


def _tagger(model, column: int, names: list[str], keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, column, GROUP):
                score, expected, spans = tag(part.column(column), model.value)
                if keep:  # the rows that aren't toxic, as they are
                    yield part.filter(pa.array(score < 0.5))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(i) for i in range(part.num_columns) if i != column), pa.array(score), pa.array(expected), pa.array(score >= 0.5), spans], names=names
                    )

    return lean(run)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, expected, toxic, spans) of every row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "text": "text"})
    names = ["doc_id", "score", "expected", "toxic", "spans"]
    return own.mapInArrow(_tagger(held, 1, names, False), f"doc_id long, score double, expected double, toxic boolean, spans {SPANS}")


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the toxic ones, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_tagger(held, docs.columns.index("text"), docs.columns, True), docs.schema)

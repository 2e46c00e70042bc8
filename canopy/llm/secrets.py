"""Secret scans by a battery of randomness tests with control of false discoveries.

Candidates are the longest runs of 16 or more of A-Z a-z 0-9 + / _ - (then up to two =) that touch no other letter or
digit of any script. The encoding is inferred from the characters: dec, hex, lower, upper, base36 (one case and digits),
letters (both cases) or base64. On the whole string run three tests of the hypothesis that its symbols are uniform and
independent: chi-squared uniformity of the alphabet, runs of digits and letters (where an encoding has only one of them,
above and below its middle), and serial correlation; Fisher's sum of their log p-values is the score, small for random
strings.

What ordinary strings score is counted over ALL texts: of each text, what lies between candidates is reduced to the
alphabet of an encoding and cut into strings of every length of LENGTHS, which are scored alike. Texts are cut each by
itself, so the counts don't depend on how the table is partitioned. (A fixed pool of PRIOR strings of English letter
frequencies is always added, so that a table without text has a null too; that of dec has uniform digits, as ordinary
numbers are no less random than keys.) A candidate's p-value is the share of the null of its encoding and of the next
shorter length that is as random as it, so short strings need more evidence: this is what makes the control aware of
lengths. Benjamini and Hochberg's step-up at FDR within each encoding picks the findings, which must also not fail the
battery itself at PASS. Scores are counted in steps of 1 / STEPS; the counts that reach the driver are bounded by the
encodings, lengths and steps.

Defined results: null, empty and candidate-free texts have no findings; repeated rows have their findings each; a null
doc_id is kept. Offsets are in characters, the end excluded. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import own_columns, written
from canopy.llm._text import pieces, raw

LENGTHS = np.array([16, 20, 24, 32, 40, 48, 64, 96, 128])
FDR = 0.01
PASS = 1e-4
PRIOR = 4096
STEPS, MOST = 4, 800
PIECE = 1 << 20

DIGITS, LOW, UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "dec": DIGITS, "hex": DIGITS + "abcdef", "lower": LOW, "upper": UP, "base36": DIGITS + LOW, "letters": UP + LOW, "base64": UP + LOW + DIGITS + "+/",
}
NAMES = list(ALPHABETS)
SHARES = "e12.7 t9.1 a8.2 o7.5 i7.0 n6.7 s6.3 h6.1 r6.0 d4.3 l4.0 c2.8 u2.8 m2.4 w2.4 f2.2 g2.0 y2.0 p1.9 b1.5 v1.0 k0.8 j0.15 x0.15 q0.1 z0.07"
FOUND = re.compile(rb"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{16,}={0,2}(?![A-Za-z0-9+/_\-])")
OUT = "kind int, doc_id long, start int, end int, encoding string, length int, score double, bucket int, n long"


def _tables() -> dict[str, np.ndarray]:
    """The value of each byte in each alphabet, -1 elsewhere."""
    out = {}
    for name, letters in ALPHABETS.items():
        t = np.full(256, -1, np.int16)
        for i, c in enumerate(letters):
            t[ord(c)] = i
        if name in ("hex", "base36"):
            for c in UP:
                t[ord(c)] = t[ord(c.lower())]
        if name == "base64":
            t[ord("-")], t[ord("_")] = 62, 63
        out[name] = t
    return out


TABLES = _tables()
#: The symbols on one side of the runs test.
SIDES = {n: np.array([c in DIGITS for c in a]) if set(a) & set(DIGITS) and set(a) - set(DIGITS) else np.arange(len(a)) >= len(a) // 2 for n, a in ALPHABETS.items()}
#: Lengths of the null, each twice the one it is made from.
DOUBLES = {32: 16, 64: 32, 128: 64, 40: 20, 48: 24, 96: 48}


def encoding_of(s: bytes) -> str:
    """The inferred encoding of a candidate without its padding."""
    d, lo, up = re.search(rb"[0-9]", s), re.search(rb"[a-z]", s), re.search(rb"[A-Z]", s)
    if re.search(rb"[+/_\-]", s) or (lo and up and d):
        return "base64"
    if d and not (lo or up):
        return "dec"
    if d and re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    if d:
        return "base36"
    return "letters" if lo and up else "lower" if lo else "upper"


def _two_sided(z: np.ndarray) -> np.ndarray:
    """2 (1 - Phi(|z|)), by a rational approximation that is good to 1e-7."""
    x = np.abs(z) / np.sqrt(2.0)
    t = 1 / (1 + 0.5 * x)
    c = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    s = np.zeros_like(t)
    for a in reversed(c):
        s = s * t + a
    return np.clip(t * np.exp(-x * x + s), 1e-300, 1.0)


@dataclass
class Moments:
    """What the battery asks of strings of one length; that of two strings side by side follows from theirs."""

    n: int
    counts: np.ndarray  # of each symbol
    sum: np.ndarray
    squares: np.ndarray
    products: np.ndarray  # of neighbours
    side: np.ndarray  # symbols on one side
    changes: np.ndarray  # of side
    ends: np.ndarray  # first and last symbol

    @classmethod
    def of(cls, symbols: np.ndarray, name: str) -> Moments:
        rows, n = symbols.shape
        k, x = len(ALPHABETS[name]), symbols.astype(np.float32)
        counts = np.bincount((np.arange(rows)[:, None] * k + symbols).ravel(), minlength=rows * k).reshape(rows, k).astype(np.float32)
        side = SIDES[name][symbols]
        return cls(
            n, counts, x.sum(1), np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", x[:, 1:], x[:, :-1]),
            side.sum(1).astype(np.float32), (side[:, 1:] != side[:, :-1]).sum(1).astype(np.float32), symbols[:, [0, -1]],
        )

    def doubled(self, at: np.ndarray, name: str) -> Moments:
        """Of the strings at and at + 1, one after the other."""
        a, b, side = at, at + 1, SIDES[name]
        left, right = self.ends[a, 1], self.ends[b, 0]
        return Moments(
            2 * self.n, self.counts[a] + self.counts[b], self.sum[a] + self.sum[b], self.squares[a] + self.squares[b],
            self.products[a] + self.products[b] + left * right, self.side[a] + self.side[b],
            self.changes[a] + self.changes[b] + (side[left] != side[right]), np.stack([self.ends[a, 0], self.ends[b, 1]], 1),
        )


def score_of(m: Moments, name: str) -> np.ndarray:
    """Fisher's score (chi-squared of 6 degrees under randomness) of each string."""
    n, k = m.n, len(ALPHABETS[name])
    chi = np.einsum("ij,ij->i", m.counts, m.counts).astype(np.float64) * k / n - n
    # Wilson and Hilferty's cube root makes it normal
    z = (np.cbrt(chi / (k - 1)) - (1 - 2 / (9 * (k - 1)))) / np.sqrt(2 / (9 * (k - 1)))
    p1 = np.where(z > 0, _two_sided(z) / 2, 1 - _two_sided(z) / 2)
    n1 = m.side.astype(np.float64)
    n0 = n - n1
    mean = 1 + 2 * n1 * n0 / n
    var = (mean - 1) * (mean - 2) / max(1, n - 1)
    # a string on one side has no variance: under randomness it has the probability of that side to the power n
    share = SIDES[name].mean()
    alone = np.where(n1 > 0, share, 1 - share) ** min(n, 900)
    p2 = np.where(var > 1e-9, _two_sided((1 + m.changes - mean) / np.sqrt(np.maximum(var, 1e-9))), np.maximum(alone, 1e-300))
    s, ends = m.sum.astype(np.float64), m.ends.astype(np.float64).sum(1)
    mean = s / n
    power = m.squares - s * mean
    near = m.products - mean * (2 * s - ends) + (n - 1) * mean * mean
    p3 = np.where(power > 1e-6 * n, _two_sided((near / np.maximum(power, 1e-9) + 1 / n) * np.sqrt(n)), 1e-30)
    return -2 * (np.log(p1) + np.log(p2) + np.log(p3))


def battery(symbols: np.ndarray, name: str) -> np.ndarray:
    """The score of each row of symbols, all of one length."""
    return score_of(Moments.of(symbols, name), name) if len(symbols) else np.zeros(0)


def ordinary(data: np.ndarray, doc: np.ndarray, rows: int, null: np.ndarray) -> None:
    """Adds the scores of all strings that texts are cut into to null; doc: the text of each byte."""
    for e, name in enumerate(NAMES):
        symbols = TABLES[name][data]
        keep = symbols >= 0
        symbols, size = symbols[keep].astype(np.int64), np.bincount(doc[keep], minlength=rows)
        first = np.cumsum(size) - size
        made: dict[int, tuple[Moments, np.ndarray]] = {}
        for b, n in enumerate(LENGTHS.tolist()):
            half = made.get(DOUBLES.get(n, 0))
            pieces_ = size // n  # of each text
            if not pieces_.any():
                continue
            place = np.arange(int(pieces_.sum())) - np.repeat(np.cumsum(pieces_) - pieces_, pieces_)
            if half is None:
                at = np.repeat(first, pieces_) + n * place
                m = Moments.of(symbols[at[:, None] + np.arange(n)], name)
            else:
                m = half[0].doubled(np.repeat(half[1], pieces_) + 2 * place, name)
            made[n] = m, np.cumsum(pieces_) - pieces_
            null[e, b] += np.bincount(bucket_of(score_of(m, name)), minlength=MOST + 1)


def p_random(score: np.ndarray) -> np.ndarray:
    """The upper tail of chi-squared with 6 degrees of freedom."""
    h = np.asarray(score) / 2
    return np.exp(-h) * (1 + h + h * h / 2)


def bucket_of(score: np.ndarray) -> np.ndarray:
    return np.minimum((score * STEPS).astype(np.int64), MOST)


def length_bin(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, n, side="right") - 1


def prior() -> np.ndarray:
    """Counts [encoding, length, bucket] of the fixed pool."""
    rng = np.random.default_rng(7)
    out = np.zeros((len(NAMES), len(LENGTHS), MOST + 1), np.int64)
    pairs = [(x[0], float(x[1:])) for x in SHARES.split()]
    for e, name in enumerate(NAMES):
        k, t = len(ALPHABETS[name]), TABLES[name]
        weight = np.zeros(k)
        for c, share in pairs:
            for letter, w in ((c, 1.0), (c.upper(), 0.05 if name != "upper" else 1.0)):
                if t[ord(letter)] >= 0:
                    weight[t[ord(letter)]] += share * w
        for d in DIGITS:
            if t[ord(d)] >= 0:
                weight[t[ord(d)]] += 1.0
        for b, n in enumerate(LENGTHS):
            scores = battery(rng.choice(k, (PRIOR, int(n)), p=weight / weight.sum()), name)
            out[e, b] = np.bincount(bucket_of(scores), minlength=MOST + 1)
    return out


def _letter(data: bytes, at: int) -> bool:
    """Whether the character beyond ASCII that byte `at` belongs to is a letter or digit."""
    low = at
    while low > 0 and data[low] & 0xC0 == 0x80:
        low -= 1
    return data[low : low + 4].decode("utf-8", "ignore")[:1].isalnum()


def candidates(data: bytes) -> list[tuple[int, int]]:
    out = []
    for m in FOUND.finditer(data):
        a, z = m.span()
        if not (a and data[a - 1] >= 0x80 and _letter(data, a - 1) or z < len(data) and data[z] >= 0x80 and _letter(data, z)):
            out.append((a, z))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    null = np.zeros((len(NAMES), len(LENGTHS), MOST + 1), np.int64)
    for batch in batches:
        for part in pieces(batch, 1, PIECE):
            data, offs = raw(part.column(1))
            # texts are apart by a byte that no candidate holds
            gap = np.full(len(data) + part.num_rows, 32, np.uint8)
            shift = np.arange(len(data)) + np.repeat(np.arange(part.num_rows), np.diff(offs))
            gap[shift] = data
            starts = offs[:-1] + np.arange(part.num_rows)
            spans = np.array(candidates(gap.tobytes()), np.int64).reshape(-1, 2)
            row = np.searchsorted(starts, spans[:, 0], side="right") - 1
            chars = np.concatenate([[0], np.cumsum((gap & 0xC0) != 0x80)])
            found: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
            between = np.ones(len(gap), bool)
            for i, (a, z) in enumerate(spans.tolist()):
                s = gap[a:z].tobytes().rstrip(b"=")
                name = encoding_of(s)
                if name not in ("lower", "upper", "letters"):  # these are words nearly always
                    between[a:z] = False
                found.setdefault((name, len(s)), []).append((i, s))
            score, kinds, sizes = np.zeros(len(spans)), [""] * len(spans), np.zeros(len(spans), np.int32)
            for (name, n), mine in found.items():
                symbols = TABLES[name][np.frombuffer(b"".join(s for _, s in mine), np.uint8)].reshape(-1, n)
                at = [i for i, _ in mine]
                score[at] = battery(symbols.astype(np.int64), name)
                sizes[at] = n
                for i in at:
                    kinds[i] = name
            if len(spans):
                base = chars[starts[row]]
                yield _rows(
                    0, part.column(0).take(pa.array(row)), chars[spans[:, 0]] - base, chars[spans[:, 1]] - base, kinds, sizes, score, bucket_of(score), None
                )
            doc = np.repeat(np.arange(part.num_rows), np.diff(offs) + 1)
            ordinary(gap[between], doc[between], part.num_rows, null)
    e, b, s = np.nonzero(null)
    if len(e):
        yield _rows(1, pa.nulls(len(e), pa.int64()), e * 0, e * 0, [NAMES[i] for i in e], b, s / STEPS, s, null[e, b, s])


def _rows(kind, ids, start, end, names, length, score, bucket, n) -> pa.RecordBatch:
    count = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(count, kind, np.int32)), ids, pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(names, pa.string()),
            pa.array(length, pa.int32()), pa.array(score, pa.float64()), pa.array(bucket, pa.int32()), pa.array(np.ones(count, np.int64) if n is None else n, pa.int64()),
        ],
        names=["kind", "doc_id", "start", "end", "encoding", "length", "score", "bucket", "n"],
    )


def decisions(null: np.ndarray, seen: np.ndarray, fdr: float = FDR) -> list[tuple[str, int, int, float, float]]:
    """(encoding, length bin, bucket, p, q) of what is a finding; null, seen: counts [encoding, length bin, bucket]."""
    total = null.sum(2, keepdims=True)
    p = (1 + null.cumsum(2)) / (1 + total)
    out = []
    for e, name in enumerate(NAMES):
        at = np.argwhere(seen[e] > 0)
        if not len(at):
            continue
        ps = p[e][at[:, 0], at[:, 1]]
        order = np.argsort(ps, kind="stable")
        counts = seen[e][at[:, 0], at[:, 1]][order]
        # equal p-values have the rank of the last of them
        rank = np.cumsum(counts)
        last = np.searchsorted(ps[order], ps[order], side="right") - 1
        q = ps[order] * rank[-1] / rank[last]
        q = np.minimum.accumulate(q[::-1])[::-1]
        for i, o in enumerate(order):
            b, s = int(at[o, 0]), int(at[o, 1])
            if q[i] <= fdr and p_random(s / STEPS) >= PASS:
                out.append((name, b, s, float(ps[o]), float(q[i])))
    return out


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """(doc_id, start, end, encoding, length, p_random, p_ordinary, q) of every finding."""
    spark = docs.sparkSession
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    rows = written(own.mapInArrow(_scan, OUT), "candidates")
    bins = F.size(F.filter(F.array(*[F.lit(int(x)) for x in LENGTHS]), lambda x: x <= F.col("length"))) - 1
    binned = rows.withColumn("bin", F.when(F.col("kind") == 1, F.col("length")).otherwise(bins))
    null, seen = prior(), np.zeros((len(NAMES), len(LENGTHS), MOST + 1), np.int64)
    # at most two rows for each encoding, length and bucket
    for r in binned.groupBy("kind", "encoding", "bin", "bucket").agg(F.sum("n").alias("n")).collect():
        (null if r["kind"] else seen)[NAMES.index(r["encoding"]), r["bin"], r["bucket"]] += r["n"]
    table = spark.createDataFrame(decisions(null, seen, fdr), "encoding string, bin int, bucket int, p_ordinary double, q double")
    h = F.col("score") / 2
    found = binned.where("kind = 0").join(F.broadcast(table), ["encoding", "bin", "bucket"])
    return found.select("doc_id", "start", "end", "encoding", "length", (F.exp(-h) * (1 + h + h * h / 2)).alias("p_random"), "p_ordinary", "q")

"""Byte-level BPE: every distinct word is encoded once, and documents are put together again by position.

1. Texts are split into pre-tokens. Those of about CHUNK_BYTES of text form a chunk, with a dictionary of its words;
   the documents of the chunk become the sequence of their words' numbers. Both are written as one table.
   It is bucketed by chunk, so the positions are not shuffled again.
2. The words of all chunks' dictionaries are shuffled by hash, so that each distinct word of the corpus meets itself in
   one bucket, where it is encoded once; the ids go back to the chunks that asked. Buckets follow the size of the texts.
3. By chunk, ids join the positions, and each document is the ids of its words in order.

What is shuffled are dictionaries and compressed positions, about a byte and a half for each word of text, not a row
for each word. Decoding joins ids with the table of the vocabulary's bytes (bounded by the vocabulary, so broadcast).

Defined results: a null text has null ids, an empty one an empty list. Texts of any length are encoded whole. Rows that
repeat are encoded row by row. Extra columns are left out.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import bucketed, own_columns
from canopy.llm._text import give_back, hash_ranges, lean, pieces, raw

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK_BYTES = 8 << 20
PIECE_BYTES = 512 << 10
LEAST_BUCKETS = 32
BUCKET_BYTES = 1 << 30
_ZSTD = pa.Codec("zstd", compression_level=1)

MADE = "chunk string, bucket int, doc_ids array<long>, counts array<int>, codes binary, words binary"


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a file of lines `base64 id`, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _pack(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as four planes of bytes, compressed."""
    planes = np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return len(x).to_bytes(8, "little") + _ZSTD.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _unpack(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(b[8:], 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _pack_words(words: pa.Array) -> bytes:
    data, offs = raw(words)
    lengths = _pack(np.diff(offs))
    return len(lengths).to_bytes(8, "little") + lengths + len(data).to_bytes(8, "little") + _ZSTD.compress(data.tobytes(), asbytes=True)


def _unpack_words(blob: bytes) -> list[bytes]:
    cut = 8 + int.from_bytes(blob[:8], "little")
    n, body = _unpack(blob[8:cut]), blob[cut:]
    data = _ZSTD.decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)
    ends = np.cumsum(n).tolist()
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends)] if ends else []


@functools.cache
def _splitter(pattern: str):
    return regex.compile(pattern).findall


def _split(pattern: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _splitter(pattern)
        for batch in batches:
            for chunk in pieces(batch, 1, CHUNK_BYTES):
                lists, counts = [], []
                for part in pieces(chunk, 1, PIECE_BYTES):
                    flat: list[str] = []
                    for text in part.column(1).to_pylist():
                        if text is None:
                            counts.append(-1)
                            continue
                        got = find(text)
                        counts.append(len(got))
                        flat += got
                    lists.append(pa.array(flat, pa.string()))
                yield _chunk(chunk.column(0), np.array(counts, np.int64), pa.chunked_array(lists, pa.string()), buckets)
                del lists, flat
                give_back()

    return run


def _chunk(ids: pa.Array, counts: np.ndarray, words: pa.ChunkedArray, buckets: int) -> pa.RecordBatch:
    coded = words.dictionary_encode().combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    code = np.asarray(coded.indices)
    # numbers in order of frequency, so that most of them are small
    often = np.argsort(-np.bincount(code, minlength=len(coded.dictionary)), kind="stable")
    number = np.empty(len(often), np.int32)
    number[often] = np.arange(len(often), dtype=np.int32)
    dictionary = coded.dictionary.take(pa.array(often))
    code = number[code]
    name = uuid.uuid4().hex
    rows: list[tuple] = []
    at = np.concatenate([[0], np.cumsum(np.maximum(counts, 0))])
    low = 0
    while low < len(counts):  # the positions, a row for about a million words
        high = max(low + 1, int(np.searchsorted(at, at[low] + (1 << 20), side="right")) - 1)
        high = min(high, len(counts))
        rows.append((name, -1, ids.slice(low, high - low).to_pylist(), counts[low:high].tolist(), _pack(code[at[low] : at[high]]), None))
        low = high
    if len(dictionary):
        data, offs = raw(dictionary)
        bucket = (hash_ranges(data, offs[:-1], offs[1:]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            mine = order[cuts[b] : cuts[b + 1]]
            if len(mine):
                steps = np.diff(mine, prepend=0)
                rows.append((name, b, None, None, _pack(steps), _pack_words(dictionary.take(pa.array(mine)))))
    schema = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("codes", pa.binary()), ("words", pa.binary())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


_encodings: dict[int, tuple[dict[bytes, int], tiktoken.Encoding]] = {}


def _encoding(held) -> tuple[dict[bytes, int], tiktoken.Encoding]:
    """The vocabulary, and its encoding, which is built once in a worker."""
    if held.value is not _encodings.get(0, (None,))[0]:
        _encodings[0] = held.value, tiktoken.Encoding("held", pat_str=r"[\s\S]+", mergeable_ranks=held.value, special_tokens={})
    return _encodings[0]


def _encode(held):
    """(chunk, codes, ids) of rows (bucket, chunk, codes, words) in order of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, encoding = _encoding(held)
        known: dict[bytes, list[int]] = {}
        now = None
        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket != now:
                    known, now = {}, bucket
                ids, counts = [], []
                for w in _unpack_words(batch.column(3)[i].as_py()):
                    got = known.get(w)
                    if got is None:
                        got = known[w] = [ranks[w]] if w in ranks else encoding._encode_single_piece(w)
                    ids += got
                    counts.append(len(got))
                out = len(a := _pack(np.array(counts, np.uint32))).to_bytes(8, "little") + a + _pack(np.array(ids, np.uint32))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, 1), batch.column(2).slice(i, 1), pa.array([out], pa.binary())], names=["chunk", "codes", "ids"])

    return lean(run)


def _join(ids: pa.Table, docs: pa.Table) -> pa.Table:
    codes, counts, flat = [], [], []
    for c, b in zip(ids.column("codes"), ids.column("ids")):
        c, b = c.as_py(), b.as_py()
        n = int.from_bytes(b[:8], "little")
        codes.append(np.cumsum(_unpack(c), dtype=np.int64))
        counts.append(_unpack(b[8 : 8 + n]))
        flat.append(_unpack(b[8 + n :]))
    code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    count, tokens = (np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32) for x in (counts, flat))
    by_code, size = np.zeros(len(code), np.int32), np.zeros(len(code), np.int32)
    by_code[code], size[code] = np.cumsum(count, dtype=np.int32) - count, count
    out_ids, out_lists = [], []
    for doc_ids, n, blob in zip(docs.column("doc_ids"), docs.column("counts"), docs.column("codes")):
        seq = _unpack(blob.as_py()).view(np.int32)
        k = size[seq]
        ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(k, dtype=np.int32)])
        at = np.repeat(by_code[seq] - ends[:-1], k)
        at += np.arange(len(at), dtype=np.int32)
        n_ = np.asarray(n.values)
        offs = ends[np.concatenate([[0], np.cumsum(np.maximum(n_, 0), dtype=np.int64)])]
        offsets = pa.array(offs, pa.int32(), mask=np.concatenate([n_ < 0, [False]]))
        out_ids.append(doc_ids.values)
        out_lists.append(pa.ListArray.from_arrays(offsets, pa.array(tokens[at])))
    return pa.table({"doc_id": pa.chunked_array(out_ids, pa.int64()), "token_ids": pa.chunked_array(out_lists, pa.list_(pa.int32()))})


def _encoded(docs: DataFrame, vocabulary: str, pattern: str, join, schema: str) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(read_vocabulary(vocabulary))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = own_columns(docs, {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    whole = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, parts, whole // BUCKET_BYTES)
    made = bucketed(own.mapInArrow(_split(pattern, buckets), MADE), "words", "chunk", parts)
    asked = made.where("bucket >= 0").select("bucket", "chunk", "codes", "words")
    ids = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_encode(held), "chunk string, codes binary, ids binary")
    placed = made.where("bucket < 0").select(F.col("chunk").alias("of"), "doc_ids", "counts", F.col("codes").alias("codes"))
    return ids.groupBy("chunk").cogroup(placed.groupBy("of")).applyInArrow(join, schema)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, token_ids) of every row."""
    return _encoded(docs, vocabulary, pattern, _join, "doc_id long, token_ids array<int>")


def _decoder(held, texts: bool):
    """Rows (doc_id, token_ids, n_tokens, text, text_md5); the text only if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts, sizes = held.value
        data = np.frombuffer(table, np.uint8)
        for batch in batches:
            ends = np.asarray(batch.column(1).offsets).astype(np.int64)
            low = 0
            while low < batch.num_rows:  # rows of about PIECE_BYTES tokens at a time
                high = min(batch.num_rows, max(low + 1, int(np.searchsorted(ends, ends[low] + PIECE_BYTES, side="right")) - 1))
                part = batch.slice(low, high - low)
                ids, offs = np.asarray(batch.column(1).values)[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
                k = sizes[ids]
                cut = np.concatenate([[0], np.cumsum(k)])
                body = data[np.arange(int(cut[-1])) + np.repeat(starts[ids] - cut[:-1], k)].tobytes()
                cut = cut[offs].tolist()
                nulls = np.asarray(part.column(1).is_null())
                got = [None if x else body[a:b].decode("utf-8", "replace") for x, a, b in zip(nulls, cut, cut[1:])]
                digest = [None if t is None else hashlib.md5(t.encode()).hexdigest() for t in got]
                columns = {"doc_id": part.column(0), "token_ids": part.column(1), "n_tokens": pa.array(np.diff(offs).astype(np.int32), mask=nulls)}
                columns |= {"text": pa.array(got, pa.string())} if texts else {}
                yield pa.RecordBatch.from_pydict(columns | {"text_md5": pa.array(digest, pa.string())})
                low = high

    return run


def token_bytes(vocabulary: dict[bytes, int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(bytes of all tokens, start and size by id); ids without a token have no bytes."""
    size = np.zeros(max(vocabulary.values()) + 1, np.int64)
    by_id: list[bytes] = [b""] * len(size)
    for token, i in vocabulary.items():
        by_id[i], size[i] = token, len(token)
    return b"".join(by_id), np.cumsum(size) - size, size


def _schema(texts: bool) -> str:
    return "doc_id long, token_ids array<int>, n_tokens int, " + "text string, " * texts + "text_md5 string"


def _bytes_of(docs: DataFrame, vocabulary: str):
    return docs.sparkSession.sparkContext.broadcast(token_bytes(read_vocabulary(vocabulary)))


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, token_ids, n_tokens, text, text_md5) of rows (doc_id, token_ids)."""
    return encoded.select("doc_id", "token_ids").mapInArrow(_decoder(_bytes_of(encoded, vocabulary), True), _schema(True))


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens, token_ids, text_md5): ids of every row, and the MD5 of what they decode to.

    Ids are decoded where they are put together, so that a task needs one Python worker and not two.
    """
    decoded = _decoder(_bytes_of(docs, vocabulary), False)

    def join(ids: pa.Table, placed: pa.Table) -> pa.Table:
        found = pa.Table.from_batches(decoded(iter(_join(ids, placed).to_batches())))
        give_back()
        return found

    found = _encoded(docs, vocabulary, pattern, join, _schema(False))
    return found.select("doc_id", "n_tokens", "token_ids", "text_md5")

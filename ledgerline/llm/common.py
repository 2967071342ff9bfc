"""Shared helpers of the corpus operators.

* ``staged`` writes an intermediate table to the shared scratch folder.
* ``chunked`` packs whole documents into compressed chunks of a few megabytes,
  dealt by chunk id.  Operators that count something over the corpus send
  compact per-chunk arrays to shards, and the shards answer each chunk: a key
  held by a third of all documents costs one entry per chunk, not one per row.
* hashes of word spans and (Rabin-Karp) of word windows over byte buffers, in numpy.

A document with NULL text has empty text.  Documents keep their row even when
``doc_id`` is NULL or repeated; operators state what they do with such rows.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir

CHUNK_BYTES = 4 << 20
CHUNK_SCHEMA = "chunk long, body binary"
SHARD_SCHEMA = "shard int, chunk long, blob binary"
ANSWER_SCHEMA = "chunk long, answer binary"

_U = np.uint64
_SEGMENT = 1 << 18          # words hashed at a time
_LONG_SPAN = 256            # longer spans go through BLAKE2b
_WIDTH = 64                 # words of one polynomial
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SEED = (0x243F6A8885A308D3, 0x13198A2E03707344)
_ROUND = (0x9FB21C651E98DF25, 0xA0761D6478BD642F)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def total_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def parts_for(total: int) -> int:
    """Partitions for a corpus of ``total`` text bytes: 1 MB each for small
    inputs up to 48 partitions, then 16 MB growing to 256 MB each."""
    per = min(256 << 20, max(16 << 20, total // 4096))
    return max(4, min(48, total >> 20), -(-total // per))


# ---------------------------------------------------------------- chunks

def _pack_body(tables: list[pa.Table]) -> bytes:
    t = pa.concat_tables(tables).combine_chunks()
    order = pc.sort_indices(t, sort_keys=[("doc_id", "ascending")], null_placement="at_start")
    t = t.take(order)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _chunker(chunk_bytes: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 32
        held, size, n = [], 0, 0

        def flush():
            nonlocal held, size, n
            row = pa.RecordBatch.from_pydict(
                {"chunk": pa.array([base + n], pa.int64()), "body": pa.array([_pack_body(held)], pa.binary())})
            held, size, n = [], 0, n + 1
            return row

        for b in batches:
            t = pa.Table.from_batches([b])
            t = t.set_column(1, "text", t["text"].cast(pa.large_string()))
            sizes = np.cumsum(pc.fill_null(pc.binary_length(t["text"]), 0).to_numpy()) if len(t) else []
            at = 0
            while at < len(t):
                done = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + chunk_bytes - size, "right")))
                held.append(t.slice(at, to - at))
                size += int(sizes[to - 1] - done)
                at = to
                if size >= chunk_bytes or at < len(t):
                    yield flush()
        if held:
            yield flush()
    return pack


def chunked(docs: DataFrame, parts: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, body): whole documents packed in chunks of about
    ``chunk_bytes`` of text (a longer document is a chunk of its own), dealt
    by chunk id.  Plans that use the result several times share its exchange."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cols.mapInArrow(_chunker(chunk_bytes), CHUNK_SCHEMA).repartition(parts, "chunk")


class Chunk:
    """Decoded chunk: sorted ``ids`` (``known`` is false where NULL), UTF-8 ``data``
    and ``offs`` so that document i is data[offs[i]:offs[i+1]]."""

    def __init__(self, body: bytes):
        t = pa.ipc.open_stream(body).read_all().combine_chunks()
        ids = t["doc_id"].combine_chunks()
        self.known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
        self.ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        text = t["text"].combine_chunks()
        self.null_text = np.asarray(text.is_null().to_numpy(zero_copy_only=False), dtype=bool)
        self.data, self.offs = text_buffers(text)
        self.n = len(ids)

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=~self.known)


def text_buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a (large) string array; NULL is empty."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of binary-carrying batches one at a time (a chunk in memory at once)."""
    for b in batches:
        cols = [b.column(i) for i in range(b.num_columns)]
        for i in range(b.num_rows):
            yield {b.schema.names[k]: c[i].as_py() for k, c in enumerate(cols)}


def answered(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """(chunk, body, answers): every chunk with the shards' answers to it
    (at most one per shard)."""
    a = answers.groupBy("chunk").agg(F.collect_list("answer").alias("answers"))
    return chunks.join(a, "chunk", "left").select("chunk", "body", "answers")


# ---------------------------------------------------------------- compact arrays

def pack(*arrays: np.ndarray) -> bytes:
    """Equal-length integer arrays as byte planes under zstd (sorted values
    should be passed as differences)."""
    arrays = [np.ascontiguousarray(a) for a in arrays]
    n = len(arrays[0])
    raw = b"".join(a.view(np.uint8).reshape(n, a.itemsize).T.tobytes() for a in arrays)
    kinds = ",".join(a.dtype.str for a in arrays).encode()
    return struct.pack("<QH", n, len(kinds)) + kinds + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes) -> list[np.ndarray]:
    n, k = struct.unpack_from("<QH", blob)
    kinds = [np.dtype(x) for x in blob[10:10 + k].decode().split(",")]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[10 + k:]), np.uint8) if n else np.zeros(0, np.uint8)
    out, at = [], 0
    for d in kinds:
        out.append(np.ascontiguousarray(raw[at:at + n * d.itemsize].reshape(d.itemsize, n).T).view(d).reshape(n))
        at += n * d.itemsize
    return out


def deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0)) if len(values) else values


def undelta(values: np.ndarray) -> np.ndarray:
    return np.cumsum(values, dtype=values.dtype)


# ---------------------------------------------------------------- words and hashes

def _table(is_separator: Callable[[int], bool]) -> np.ndarray:
    return np.array([is_separator(b) for b in range(256)])


WHITE = _table(lambda b: b == 0x20 or 9 <= b <= 13)
#: separators of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower-cased text
NOT_ALNUM = _table(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = WHITE):
    """Starts, ends and document index of every word; no word spans documents."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    word = ~separator[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = word[cuts]
    last = word
    last[:-1] &= ~word[1:] | first[1:]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-multiply rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hash of each byte span.  Blocks of eight bytes are mixed in one
    after the other (a bijective, non-linear round each), so spans of special
    shape do not cancel out as they can in a polynomial modulo 2^64; spans of
    more than ``_LONG_SPAN`` bytes take a BLAKE2b digest."""
    out = np.empty(len(starts), _U)
    if not len(starts):
        return out
    sizes = (ends - starts).astype(_U)
    out[:] = mix(sizes * _U(_ROUND[lane]) + _U(_SEED[lane]))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    long = ends - starts > _LONG_SPAN
    some = np.flatnonzero(~long & (ends > starts)) if long.any() or not sizes.all() else slice(None)
    at, left, h = starts[some], sizes[some], out[some]
    where = some
    while len(at):
        short = left < _U(8)
        block = eight[at]
        if short.any():
            block = np.where(short, block & ((_U(1) << (left * _U(8)) % _U(64)) - _U(1)), block)
        h = mix((h ^ block) * _U(_ROUND[lane]))
        out[where] = h
        more = np.flatnonzero(left > _U(8))
        where = more if isinstance(where, slice) else where[more]
        at, left, h = at[more] + 8, left[more] - _U(8), h[more]
    for k in np.flatnonzero(long):
        d = hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8, salt=bytes([lane])).digest()
        out[k] = int.from_bytes(d, "little")
    return out


def _rabin_karp(words: np.ndarray, width: int, lane: int) -> np.ndarray:
    n, base = len(words) - width + 1, _BASES[lane]
    pair = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(min(_SEGMENT, n) + width, b, _U)
        p[0] = 1
        pair.append(np.cumprod(p, dtype=_U))
    pw, inv = pair
    out = np.empty(n, _U)
    for i in range(0, n, _SEGMENT):
        j = min(n, i + _SEGMENT)
        seg = words[i:j + width - 1]
        p = np.zeros(len(seg) + 1, _U)
        np.cumsum(seg * pw[:len(seg)], out=p[1:])
        out[i:j] = mix((p[width:width + j - i] - p[:j - i]) * inv[:j - i])
    return out


def window_hash(words: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` word hashes (length n - width + 1).
    Wider windows than ``_WIDTH`` chain the mixed hashes of the runs of
    ``_WIDTH`` words that cover them, since longer polynomials modulo 2^64 can
    be equal for different runs."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    if width <= _WIDTH:
        return _rabin_karp(words, width, lane)
    runs = _rabin_karp(words, _WIDTH, lane)
    out = np.full(n, _SEED[lane], _U)
    for at in [*range(0, width - _WIDTH, _WIDTH), width - _WIDTH]:
        out = mix((out ^ runs[at:at + n]) * _U(_ROUND[lane]))
    return out


def shard_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Shard by the upper 32 bits of a mixed hash."""
    return ((hashes >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)


def by_shard(shards_sorted: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of the non-empty runs of an ascending shard array."""
    edges = np.searchsorted(shards_sorted, np.arange(parts + 1))
    for s in np.flatnonzero(np.diff(edges)):
        yield int(s), int(edges[s]), int(edges[s + 1])


def batch(schema: dict[str, pa.DataType], **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t)
                                       for t, c in ((schema[k], cols[k]) for k in schema)], names=list(schema))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; Python workers get this checkout on their path (on a
    cluster without it, ship the package with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

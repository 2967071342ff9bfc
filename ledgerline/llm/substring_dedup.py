"""Substring dedup: every window of ``width`` tokens whose tokens also start
earlier (smaller doc_id, or earlier in the same document) is removed.

1. Each chunk of documents hashes all its windows (Rabin-Karp over token
   hashes) and sends the distinct hashes, cut to ``filter_bits``, to shards.
2. A shard counts its hashes over all chunks and answers every chunk with the
   ones that another chunk also has.  The cut only lets too many pass.
3. For those the chunk sends its first occurrence with 128 hash bits, doc_id and
   position; the shard answers the positions that are not first of all.
4. The chunk marks these windows and the ones repeated inside the chunk; runs
   of marked windows merge into maximal removal intervals of tokens.

What a hot window costs is one entry per chunk.  Equal windows are recognised
by two independent 64-bit hashes.

Tokens are runs of non-white characters, unchanged.  Edge cases: NULL text has
no tokens; texts shorter than a window keep everything; rows with a NULL
doc_id keep everything and make nothing else go; rows that share a doc_id are
ordered as one document's windows would be, so that the equal start decides
nothing and both stay whole unless another document has the window earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm import common as c

WIDTH = 20
_U = np.uint64


class _Windows:
    """Windows of a chunk: hashes, and per window its document and start token."""

    def __init__(self, chunk: c.Chunk, width: int):
        self.starts, self.ends, self.doc = c.word_spans(chunk.data, chunk.offs)
        n = len(self.starts) - width + 1
        if n <= 0:
            self.at = np.zeros(0, np.int64)
            self.h1 = self.h2 = np.zeros(0, _U)
            return
        whole = (self.doc[:n] == self.doc[width - 1:]) & chunk.known[self.doc[:n]]
        self.at = np.flatnonzero(whole)  # token position in the chunk
        self.h1, self.h2 = (c.window_hash(c.span_hash(chunk.data, self.starts, self.ends, lane), width, lane)[self.at]
                            for lane in (0, 1))


def _start_in_document(doc: np.ndarray) -> np.ndarray:
    """Token index of each token inside its document."""
    if not len(doc):
        return doc
    new = np.flatnonzero(np.diff(doc, prepend=-1))
    return np.arange(len(doc)) - np.repeat(new, np.diff(np.append(new, len(doc))))


def _filter_bytes(total: int) -> int:
    """Bytes of the first count's hashes: 8 bits more than it takes to number the windows."""
    return min(8, -(-(max(total, 2).bit_length() + 8) // 8))


def _cut(h: np.ndarray, nbytes: int) -> np.ndarray:
    return h >> _U(64 - 8 * nbytes)


def _send_hashes(parts: int, width: int, nbytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            cut = np.unique(_cut(_Windows(c.Chunk(row["body"]), width).h1, nbytes))
            shards = c.shard_of(cut << _U(64 - 8 * nbytes), parts)
            for s, i, j in c.by_shard(shards, parts):
                yield _blob_row(s, row["chunk"], c.pack(c.deltas(cut[i:j])))
    return run


def _blob_row(shard: int, chunk: int, blob: bytes) -> pa.RecordBatch:
    return c.batch({"shard": pa.int32(), "chunk": pa.int64(), "blob": pa.binary()},
                   shard=pa.array([shard], pa.int32()), chunk=[chunk], blob=[blob])


def _answers(chunks: list[int], answers: list[bytes]) -> pa.Table:
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "answer": pa.array(answers, pa.binary())})


def _shared_hashes(group: pa.Table) -> pa.Table:
    """For each chunk of a shard: its hashes that another chunk has too."""
    sets = [c.undelta(c.unpack(b.as_py())[0]) for b in group["blob"]]
    every, times = np.unique(np.concatenate(sets), return_counts=True)
    shared = every[times > 1]
    out_c, out_a = [], []
    for chunk, own in zip(group["chunk"].to_pylist(), sets):
        hit = np.intersect1d(own, shared, assume_unique=True)
        if len(hit):
            out_c.append(chunk)
            out_a.append(c.pack(c.deltas(hit)))
    return _answers(out_c, out_a)


def _local_repeats(w: _Windows, chunk: c.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows by (hash, doc_id, start) and, in that order, whether
    an equal window of the chunk starts earlier."""
    if not len(w.at):
        return w.at, np.zeros(0, bool)
    order = np.lexsort((w.h2, w.h1))  # stable: chunk order, that is by doc_id and start
    same = np.zeros(len(order), bool)
    same[1:] = (w.h1[order][1:] == w.h1[order][:-1]) & (w.h2[order][1:] == w.h2[order][:-1])
    ids = chunk.ids[w.doc[w.at]]
    if len(np.unique(chunk.ids[chunk.known])) < chunk.known.sum():  # repeated ids: equal starts are no repeats
        start = _start_in_document(w.doc)[w.at]
        order = np.lexsort((start, ids, w.h2, w.h1))
        o1, o2 = w.h1[order], w.h2[order]
        same[1:] = (o1[1:] == o1[:-1]) & (o2[1:] == o2[:-1])
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        same &= (ids[order] != ids[order][first]) | (start[order] != start[order][first])
    return order, same


def _send_firsts(parts: int, width: int, nbytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            if not row["answers"]:
                continue
            shared = np.sort(np.concatenate([c.undelta(c.unpack(a)[0]) for a in row["answers"]]))
            chunk = c.Chunk(row["body"])
            w = _Windows(chunk, width)
            order, repeat = _local_repeats(w, chunk)
            order = order[~repeat]
            cut = _cut(w.h1[order], nbytes)
            found = np.minimum(np.searchsorted(shared, cut), len(shared) - 1)
            order = order[shared[found] == cut]
            h1, h2, at = w.h1[order], w.h2[order], w.at[order]
            ids, start = chunk.ids[w.doc[at]], _start_in_document(w.doc)[at]
            for s, i, j in c.by_shard(c.shard_of(h1, parts), parts):
                yield _blob_row(s, row["chunk"], c.pack(c.deltas(h1[i:j]), h2[i:j], ids[i:j],
                                                        start[i:j].astype(np.int32), at[i:j].astype(np.int32)))
    return run


def _later_positions(group: pa.Table) -> pa.Table:
    """For each chunk of a shard: positions of its windows that start earlier elsewhere."""
    sets = [c.unpack(b.as_py()) for b in group["blob"]]
    sizes = [len(s[0]) for s in sets]
    h1 = np.concatenate([c.undelta(s[0]) for s in sets])
    h2, ids, start = (np.concatenate([s[k] for s in sets]) for k in (1, 2, 3))
    order = np.lexsort((start, ids, h2, h1))
    same = np.zeros(len(order), bool)
    same[1:] = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    later = np.zeros(len(order), bool)
    later[order] = (ids[order] != ids[first]) | (start[order] != start[first])
    out_c, out_a, base = [], [], 0
    for chunk, s, n in zip(group["chunk"].to_pylist(), sets, sizes):
        at = np.sort(s[4][later[base:base + n]])
        base += n
        if len(at):
            out_c.append(chunk)
            out_a.append(c.pack(c.deltas(at)))
    return _answers(out_c, out_a)


def removal_mask(n_words: int, marked: np.ndarray, width: int) -> np.ndarray:
    """Tokens covered by the windows that start at ``marked`` positions."""
    edge = np.zeros(n_words + 1, np.int32)
    np.add.at(edge, marked, 1)
    np.add.at(edge, marked + width, -1)
    return np.cumsum(edge[:-1]) > 0


def _remove(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            chunk = c.Chunk(row["body"])
            w = _Windows(chunk, width)
            order, repeat = _local_repeats(w, chunk)
            marked = [w.at[order[repeat]], *(c.undelta(c.unpack(a)[0]).astype(np.int64) for a in row["answers"] or [])]
            gone = removal_mask(len(w.doc), np.unique(np.concatenate(marked)), width)
            edges = np.searchsorted(w.doc, np.arange(chunk.n + 1))
            raw = chunk.data.tobytes()
            n_removed, kept, spans = [], [], []
            for i in range(chunk.n):
                words = raw[chunk.offs[i]:chunk.offs[i + 1]].split()
                out = gone[edges[i]:edges[i + 1]]
                n = int(out.sum())
                if n:
                    words = [x for x, g in zip(words, out.tolist()) if not g]
                    turn = np.flatnonzero(np.diff(np.concatenate(([0], out.view(np.int8), [0]))))
                    spans.append([{"first": int(a), "past": int(b)} for a, b in turn.reshape(-1, 2)])
                else:
                    spans.append([])
                n_removed.append(n)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [chunk.id_array(), pa.array(np.diff(edges), pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array([k.decode() for k in kept], pa.string())],
                names=["doc_id", "n_words", "n_removed", "removed", "kept_sha256", "kept_text"])
    return run


def remove_repeated_spans(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = c.CHUNK_BYTES,
                          parts: int | None = None, filter_bytes: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, removed intervals [first, past), kept_sha256, kept_text)."""
    total = c.total_bytes(docs)
    parts = parts or c.parts_for(total)
    nbytes = filter_bytes or _filter_bytes(total)
    chunks = c.chunked(docs, parts, chunk_bytes)
    shared = chunks.mapInArrow(_send_hashes(parts, width, nbytes), c.SHARD_SCHEMA) \
        .groupBy("shard").applyInArrow(_shared_hashes, c.ANSWER_SCHEMA)
    later = c.answered(chunks, shared).mapInArrow(_send_firsts(parts, width, nbytes), c.SHARD_SCHEMA) \
        .groupBy("shard").applyInArrow(_later_positions, c.ANSWER_SCHEMA)
    return c.answered(chunks, later).mapInArrow(
        _remove(width), "doc_id long, n_words long, n_removed long, "
        "removed array<struct<first:long,past:long>>, kept_sha256 string, kept_text string")


#: DuckDB SQL for op4: windows spelled out
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
words AS (SELECT rn, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
windows AS (
  SELECT rn, doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT rn, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE doc_id IS NOT NULL AND len(w) >= 20)),
later AS (
  SELECT rn, i FROM (SELECT rn, i, rank() OVER (PARTITION BY s ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
marked AS (
  SELECT words.*, count(later.i) OVER (PARTITION BY words.rn ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM words LEFT JOIN later ON later.rn = words.rn AND later.i = words.i)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(m.n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(m.kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT rn, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
                  FROM marked GROUP BY rn) m ON m.rn = d.rn"""

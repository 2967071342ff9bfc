"""Line dedup over a sharded minimal perfect hash index.

``build_index`` counts, for every distinct line key of at least ``min_chars``
code points, the documents that hold it and the largest doc_id among them.  A
shard of the key space is one row: a minimal perfect hash over its keys, and
arrays of 32-bit fingerprints, counts and largest ids at the hash's indexes.
``remove_lines`` lets each chunk of documents send its distinct keys to the
shards; these probe the arrays and answer the keys that are frequent.  No line
is joined, and a line that a third of all documents hold is one entry a chunk.

A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends, A-Z lower-
cased.  Keys in at least ``min_docs`` documents lose their lines everywhere but
in the largest doc_id that holds them.  Keys are told apart by 128 hash bits.

Edge cases: NULL or empty text is one empty line; rows with a NULL doc_id keep
all lines and are not counted; rows that repeat a doc_id count one by one, and
all rows of the largest doc_id keep the line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm import common as c
from ledgerline.llm.mph import PerfectHash

MIN_CHARS = 40
MIN_DOCS = 5
INDEX_SCHEMA = "shard int, n long, hash binary, fingerprints binary, counts binary, last_ids binary"


class _Lines:
    """Lines of a chunk: spans, document, and hashes of the eligible keys."""

    def __init__(self, chunk: c.Chunk, min_chars: int):
        data = chunk.data
        breaks = np.flatnonzero(data == 10)
        self.starts = np.sort(np.concatenate([chunk.offs[:-1], breaks + 1]))
        self.ends = np.sort(np.concatenate([breaks, chunk.offs[1:]]))
        self.per_doc = np.searchsorted(breaks, chunk.offs[1:]) - np.searchsorted(breaks, chunk.offs[:-1]) + 1
        self.doc = np.repeat(np.arange(chunk.n), self.per_doc)
        ink = np.flatnonzero(~c.WHITE[data])
        lo, hi = np.searchsorted(ink, self.starts), np.searchsorted(ink, self.ends)
        some = np.flatnonzero(hi > lo)
        s, e = ink[lo[some]], ink[hi[some] - 1] + 1
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        long = (points[e] - points[s] >= min_chars) & chunk.known[self.doc[some]]
        self.at, s, e = some[long], s[long], e[long]
        lower = c.ascii_lower(data)
        self.h1, self.h2 = (c.span_hash(lower, s, e, lane) for lane in (0, 1))


def _runs(h1: np.ndarray, h2: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Positions in ``order`` where a new key begins."""
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return np.flatnonzero(new)


def _send_counts(parts: int, min_chars: int):
    """Per chunk and shard: distinct keys, documents that hold them, largest id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            chunk = c.Chunk(row["body"])
            lines = _Lines(chunk, min_chars)
            if not len(lines.at):
                continue
            doc = lines.doc[lines.at]
            order = np.lexsort((doc, lines.h2, lines.h1))
            first = _runs(lines.h1, lines.h2, order)
            new_doc = np.diff(doc[order], prepend=-1) != 0
            new_doc[first] = True
            counts = np.add.reduceat(new_doc, first, dtype=np.int64)
            last = np.maximum.reduceat(chunk.ids[doc[order]], first)
            h1, h2 = lines.h1[order[first]], lines.h2[order[first]]
            for s, i, j in c.by_shard(c.shard_of(h1, parts), parts):
                yield c.batch({"shard": pa.int32(), "chunk": pa.int64(), "blob": pa.binary()},
                              shard=pa.array([s], pa.int32()), chunk=[row["chunk"]],
                              blob=[c.pack(c.deltas(h1[i:j]), h2[i:j], counts[i:j].astype(np.uint32), last[i:j])])
    return run


def _index_shard(group: pa.Table) -> pa.Table:
    sets = [c.unpack(b.as_py()) for b in group["blob"]]
    h1 = np.concatenate([c.undelta(s[0]) for s in sets])
    h2, counts, last = (np.concatenate([s[k] for s in sets]) for k in (1, 2, 3))
    order = np.lexsort((h2, h1))
    first = _runs(h1, h2, order)
    total = np.add.reduceat(counts[order], first, dtype=np.uint64)
    newest = np.maximum.reduceat(last[order], first)
    h1, h2 = h1[order[first]], h2[order[first]]
    hashed = PerfectHash.build(h1, h2)
    at = hashed.index(h1, h2)
    arrays = [np.empty(len(h1), d) for d in (np.uint32, np.uint64, np.int64)]
    for array, values in zip(arrays, ((h2 & np.uint64(0xFFFFFFFF)).astype(np.uint32), total, newest)):
        array[at] = values
    return pa.table({"shard": group["shard"].slice(0, 1), "n": pa.array([len(h1)], pa.int64()),
                     "hash": [hashed.to_bytes()], **{k: pa.array([c.pack(a)], pa.binary()) for k, a in
                                                     zip(("fingerprints", "counts", "last_ids"), arrays)}})


def _probe(min_docs: int):
    def run(sent: pa.Table, index: pa.Table) -> pa.Table:
        out_c, out_a = [], []
        if sent.num_rows and index.num_rows:
            hashed = PerfectHash.from_bytes(index["hash"][0].as_py())
            prints, counts, last = (c.unpack(index[k][0].as_py())[0] for k in ("fingerprints", "counts", "last_ids"))
            for chunk, blob in zip(sent["chunk"].to_pylist(), sent["blob"]):
                h1, h2 = c.unpack(blob.as_py())[:2]
                h1 = c.undelta(h1)
                at = hashed.index(h1, h2)
                hit = (at >= 0) & (prints[at] == (h2 & np.uint64(0xFFFFFFFF))) & (counts[at] >= min_docs)
                if hit.any():
                    out_c.append(chunk)
                    out_a.append(c.pack(c.deltas(h1[hit]), h2[hit], last[at[hit]]))
        return pa.table({"chunk": pa.array(out_c, pa.int64()), "answer": pa.array(out_a, pa.binary())})
    return run


def _drop(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            chunk = c.Chunk(row["body"])
            lines = _Lines(chunk, min_chars)
            gone = np.zeros(len(lines.starts), bool)
            if row["answers"] and len(lines.at):
                sets = [c.unpack(a) for a in row["answers"]]
                h1 = np.concatenate([c.undelta(s[0]) for s in sets])
                h2, last = (np.concatenate([s[k] for s in sets]) for k in (1, 2))
                # own lines meet the answered keys in one sort: an answer opens each run of its key
                both1, both2 = np.concatenate([h1, lines.h1]), np.concatenate([h2, lines.h2])
                order = np.lexsort((np.arange(len(both1)), both2, both1))
                first = _runs(both1, both2, order)
                head = order[np.repeat(first, np.diff(np.append(first, len(order))))]
                own = order >= len(h1)
                answered = own & (head < len(h1))
                which = order[answered] - len(h1)
                ids = chunk.ids[lines.doc[lines.at[which]]]
                gone[lines.at[which]] = ids != last[head[answered]]
            edges = np.concatenate(([0], np.cumsum(lines.per_doc)))
            n_dropped = np.add.reduceat(gone, edges[:-1], dtype=np.int64) if chunk.n else np.zeros(0, np.int64)
            raw, kept = chunk.data.tobytes(), []
            for i in range(chunk.n):
                text = raw[chunk.offs[i]:chunk.offs[i + 1]]
                if n_dropped[i]:
                    text = b"\n".join(x for x, g in zip(text.split(b"\n"), gone[edges[i]:edges[i + 1]].tolist()) if not g)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [chunk.id_array(), pa.array(lines.per_doc, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array([k.decode() for k in kept], pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"])
    return run


def _sent(docs: DataFrame, min_chars: int, chunk_bytes: int, parts: int | None):
    parts = parts or c.parts_for(c.total_bytes(docs))
    chunks = c.chunked(docs, parts, chunk_bytes)
    return chunks, chunks.mapInArrow(_send_counts(parts, min_chars), c.SHARD_SCHEMA)


def build_index(docs: DataFrame, min_chars: int = MIN_CHARS, chunk_bytes: int = c.CHUNK_BYTES,
                parts: int | None = None) -> DataFrame:
    """One row a shard: the perfect hash and its arrays (see the module)."""
    return _sent(docs, min_chars, chunk_bytes, parts)[1].groupBy("shard").applyInArrow(_index_shard, INDEX_SCHEMA)


def remove_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 chunk_bytes: int = c.CHUNK_BYTES, parts: int | None = None) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256, kept_text), one row per input row."""
    chunks, sent = _sent(docs, min_chars, chunk_bytes, parts)
    sent = c.staged(sent, "line-keys")
    index = c.staged(sent.groupBy("shard").applyInArrow(_index_shard, INDEX_SCHEMA), "line-index")
    answers = sent.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe(min_docs), c.ANSWER_SCHEMA)
    return c.answered(chunks, answers).mapInArrow(
        _drop(min_chars), "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string")


#: DuckDB SQL for op5: keys grouped as strings
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT rn, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 AND doc_id IS NOT NULL
  GROUP BY key HAVING count(DISTINCT rn) >= 5),
marked AS (SELECT k.*, o.key IS NOT NULL AND k.doc_id IS NOT NULL AND k.doc_id <> o.last AS gone
           FROM keyed k LEFT JOIN often o ON o.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rn"""

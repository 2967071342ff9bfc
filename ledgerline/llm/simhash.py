"""SimHash near-duplicate grouping with a pigeonring filter.

Fingerprint: words are runs of non-white characters of the text with A-Z
lower-cased; every run of ``shingle`` words (repeats included, joined by one
space) is hashed with XXH64 (seed 42), and a bit of the 64-bit fingerprint is
set when it is set in more than half of the hashes.  Fewer words give one
shingle, none gives fingerprint 0.

Linking: the 64 bits are cut in ``segments`` consecutive pieces on a ring.  If
two fingerprints differ in at most k bits, some chain of consecutive pieces
exists whose running difference after l pieces never exceeds l*k/segments.
The budgets that round to zero say how many neighbouring pieces must be equal;
those pieces are the join key, the longer budgets prune inside a bucket and
the full bit distance decides.  A bucket of distinct fingerprints is compared
in blocks, or, when large, by enumerating the few bit flips its budgets allow,
so the work per fingerprint is bounded.  A bucket returns a spanning forest of
its links, never all pairs.  A bucket of more than ``bucket`` fingerprints is never
gathered: its flips are looked up among all fingerprints by a join on the whole
fingerprint, which finds the same links spread over all tasks.

Edge cases: NULL or empty text has fingerprint 0 and links like any other;
rows with a NULL id get a fingerprint but no component and lend no id to one;
repeated ids keep their rows.  Empty input gives empty output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import batch, staged, text_buffers
from ledgerline.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 5
BUCKET = 1 << 16  # fingerprints of a bucket that one task compares
_U = np.uint64
_PIECE = 1 << 16  # shingle hashes folded into the bit counts at a time


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    cut = np.cumsum([0, *map(len, words)]) + np.arange(len(words) + 1)  # start of word i; one past the last
    starts, ends = cut[:len(words) - width + 1].tolist(), (cut[width:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, _PIECE):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[i:i + _PIECE], ends[i:i + _PIECE])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, fp): MD5 of the text and the fingerprint as a signed long, one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffers(b.column(1))
            raw = data.tobytes()
            fp = np.array([fingerprint(raw[offs[i]:offs[i + 1]], shingle) for i in range(b.num_rows)], dtype=_U)
            digest = [hashlib.md5(raw[offs[i]:offs[i + 1]]).hexdigest() for i in range(b.num_rows)]
            yield batch({"doc_id": pa.int64(), "digest": pa.string(), "fp": pa.int64()}, doc_id=b.column(0),
                        digest=pa.array(digest, pa.string()), fp=pa.array(fp.view(np.int64)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, digest string, fp long")


def segment_masks(segments: int = SEGMENTS) -> list[int]:
    edges = [64 * i // segments for i in range(segments + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def chain_masks(start: int, segments: int, max_bits: int) -> list[tuple[int, int]]:
    """(mask of the first l pieces from ``start``, bits they may differ in), l = 1 .. segments."""
    m, out, acc = segment_masks(segments), [], 0
    for length in range(1, segments + 1):
        acc |= m[(start + length - 1) % segments]
        out.append((acc, length * max_bits // segments))
    return out


def allowed_flips(chain: list[tuple[int, int]], max_bits: int) -> np.ndarray:
    """Every non-zero difference of at most ``max_bits`` bits within the chain's budgets."""
    out = []
    for k in range(1, max_bits + 1):
        for bits in combinations(range(64), k):
            x = sum(1 << b for b in bits)
            if all((x & mask).bit_count() <= budget for mask, budget in chain):
                out.append(x)
    return np.array(out, dtype=_U)


def _near_in_blocks(fps: np.ndarray, chain: list[tuple[int, int]], block: int = 512):
    for i in range(0, len(fps), block):
        left = fps[i:i + block]
        for j in range(i, len(fps), block):
            diff = left[:, None] ^ fps[None, j:j + block]
            ok = np.ones(diff.shape, bool)
            for mask, budget in chain:  # the last one is the whole word: the full check
                ok &= np.bitwise_count(diff & _U(mask)) <= budget
            a, b = np.nonzero(ok)
            keep = i + a < j + b
            yield i + a[keep], j + b[keep]


def _near_by_flips(fps: np.ndarray, flips: np.ndarray):
    for f in flips:
        other = fps ^ f
        at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
        a = np.flatnonzero((fps[at] == other) & (fps < other))
        yield a, at[a]


def spanning_links(fps: np.ndarray, chain: list[tuple[int, int]], flips: np.ndarray):
    """Links of a spanning forest of the near pairs among sorted distinct ``fps``."""
    root = np.arange(len(fps))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    pairs = _near_in_blocks(fps, chain) if len(fps) <= 4 * len(flips) else _near_by_flips(fps, flips)
    src, dst = [], []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist()):
            rx, ry = find(x), find(y)
            if rx != ry:
                root[max(rx, ry)] = min(rx, ry)
                src.append(fps[x])
                dst.append(fps[y])
    return np.array(src, dtype=_U), np.array(dst, dtype=_U)


def _flipped_links(members: DataFrame, distinct: DataFrame, flips: list[np.ndarray]) -> DataFrame:
    """Links of (ring, fp) members, each flip met with the ``distinct`` prints by a
    join.  The flips, a few thousand fixed numbers at most, are broadcast."""
    table = members.sparkSession.createDataFrame(
        [(ring, int(f)) for ring, own in enumerate(flips) for f in own.view(np.int64)], "ring int, flip long")
    other = members.join(F.broadcast(table), "ring") \
        .select(F.col("fp").alias("src"), F.col("fp").bitwiseXOR(F.col("flip")).alias("dst")).where("src < dst")
    return other.join(distinct.select(F.col("fp").alias("dst")), "dst", "left_semi").select("src", "dst")


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """(src, dst) links that connect every pair of ``fp`` values (distinct,
    long) at most ``max_bits`` bits apart."""
    key_masks, chains = [], []
    for s in range(segments):
        chain = chain_masks(s, segments, max_bits)
        key_masks.append(max(mask for mask, budget in chain if budget == 0) if chain[0][1] == 0 else 0)
        chains.append(chain)
    signed = [m - (1 << 64) if m >> 63 else m for m in key_masks]
    tables = F.array(*[F.struct(F.lit(s).alias("ring"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for s, m in enumerate(signed)])
    keyed = distinct.select("fp", F.inline(tables))
    flips = [allowed_flips(c, max_bits) for c in chains]

    large = staged(keyed.groupBy("ring", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
                   .select("ring", "key"), "simhash-large")
    # single-member buckets have no links: drop them before Python
    sized = keyed.join(large, ["ring", "key"], "left_anti") \
        .groupBy("ring", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            src, dst = [np.zeros(0, _U)], [np.zeros(0, _U)]
            rings, lists = b.column(0).to_numpy(), b.column(1)
            offs, vals = lists.offsets.to_numpy(), lists.values.to_numpy()
            for i in range(b.num_rows):
                s, d = spanning_links(np.sort(vals[offs[i]:offs[i + 1]].astype(np.int64).view(_U)),
                                      chains[rings[i]], flips[rings[i]])
                src.append(s)
                dst.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src).view(np.int64)),
                                              pa.array(np.concatenate(dst).view(np.int64))], names=["src", "dst"])
    gathered = sized.select("ring", "fps").mapInArrow(link_rows, "src long, dst long")
    if large.isEmpty():
        return gathered
    return gathered.unionByName(_flipped_links(keyed.join(large, ["ring", "key"], "left_semi"), distinct, flips))


def _grouped(prints: DataFrame, max_bits: int, segments: int, bucket: int) -> DataFrame:
    """(fp, first (doc_id, digest), rows, root) of the distinct fingerprints."""
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "digest")))
    distinct = staged(prints.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("rows")), "simhash-distinct")
    links = staged(near_links(distinct.select("fp"), max_bits, segments, bucket).distinct(), "simhash-links")
    roots = connected_components(links)
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", "rows", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id, n_links): ``component_id`` is the smallest id
    reachable over links of fingerprints at most ``max_bits`` bits apart;
    ``n_links`` the number of other rows with the same component."""
    prints = staged(fingerprints(docs, shingle), "simhash-prints")
    grouped = _grouped(prints, max_bits, segments, bucket)
    sums = staged(grouped.groupBy("root").agg(F.min("first.doc_id").alias("component_id"),
                                              F.sum("rows").alias("members")), "simhash-sums")
    classes = staged(grouped.select("fp", "root").join(sums, "root").select("fp", "component_id", "members"),
                     "simhash-classes")
    return prints.join(classes, "fp").select(
        "doc_id", "fp",
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        (F.col("members") - 1).alias("n_links"))


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                  segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """One row of each component, all columns: the smallest id, then the
    smallest MD5 of the text (rows may share an id), one of equal rows.  Rows
    with a NULL id stay."""
    prints = staged(fingerprints(docs, shingle), "simhash-prints")
    winners = _grouped(prints, max_bits, segments, bucket).groupBy("root").agg(F.min("first").alias("first")) \
        .where(F.col("first").isNotNull()).select("first.*").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("id"),
                       F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("md5"))
    winners = staged(winners, "simhash-kept")
    kept = rows.join(winners, (rows["id"] == winners["doc_id"]) & (rows["md5"] == winners["digest"]), "left_semi")
    place = F.row_number().over(Window.partitionBy("id", "md5").orderBy(F.xxhash64("row.text")))
    once = kept.withColumn("place", place).where(F.col("place") == 1).select("row.*")
    return once.unionByName(docs.where(F.col("doc_id").isNull()))

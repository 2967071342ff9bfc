"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased.

1. The corpus is counted for the words of the test items.  An item's run of
   ``n`` words is a rare seed when the product of its words' corpus frequencies
   is at most ``chance``: it would come up by chance less than once in 1/chance words.
   (Counting the runs themselves would call a passage common because it leaked often.)
   An item without a rare run keeps all its runs; one shorter than ``n`` words is
   one seed as a whole.
2. Every document's runs meet the seeds; seed hits of an item that lie within its
   length (plus slack) form a passage.
3. The passage is aligned with the whole item (match 1, mismatch and gap -1/2).
   The score is the best local alignment's sum over the item's number of words: 1 for an exact
   copy, about 1 - 1.5 d for a share d of replaced words.  At least ``min_score`` is a leak,
   and so is a sum of ``min_words`` or more, however long the item is (200 words in a
   row out of an item of 500 are one).

The alignment keeps one row of scores a block of rows and recomputes the blocks its path
crosses, so a task holds about 2 sqrt(item words) rows and not one a word.

The items, and nothing of the corpus, are broadcast, in blocks of at most
``block_items`` items and ``block_words`` words, so that their size is bounded
whatever the benchmark's; further blocks are further passes.

Edge cases: NULL or wordless items and texts match nothing; rows with a NULL
doc_id or item_id are reported with that NULL; repeated rows are each
reported; no items or no documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as c

N = 3
CHANCE = 1e-8
MIN_SCORE, MIN_WORDS = 0.5, 25.0
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 2_000_000
SCHEMA = "doc_id long, item_id long, score double, n_matched long, first_word long, last_word long"
_PENALTY = np.float32(0.5)  # sums of halves are exact in 32 bits
_WHOLE = 1 << 20  # scores kept whole instead of in blocks of rows


def _words(data: np.ndarray, offs: np.ndarray):
    lower = c.ascii_lower(data)
    starts, ends, doc = c.word_spans(lower, offs, c.NOT_ALNUM)
    return c.span_hash(lower, starts, ends), doc


def _rows(row: np.ndarray, a: np.ndarray, b: np.ndarray, ramp: np.ndarray) -> np.ndarray:
    """Score rows of the item words ``a``, after the row before them (kept as the first)."""
    h = np.empty((len(a) + 1, len(row)), np.float32)
    h[0] = row
    t = np.zeros(len(row), np.float32)
    for i in range(1, len(h)):
        np.maximum(h[i - 1, :-1] + np.where(b == a[i - 1], np.float32(1), -_PENALTY), h[i - 1, 1:] - _PENALTY, out=t[1:])
        np.maximum(t, 0, out=t)
        h[i] = np.maximum.accumulate(t + ramp) - ramp  # gaps along the text
    return h


def align(a: np.ndarray, b: np.ndarray, whole: int = _WHOLE) -> tuple[float, int, int, int]:
    """Best local alignment of item words ``a`` in text words ``b``: score,
    matched words, first and last text word.  More than ``whole`` scores are
    held in blocks of sqrt(item words) rows."""
    m, n = len(a), len(b)
    size = max(1, m if m * n <= whole else math.isqrt(m))
    ramp = _PENALTY * np.arange(n + 1, dtype=np.float32)
    h, kept, best, i, j = np.zeros((1, n + 1), np.float32), [], 0.0, 0, 0
    for at in range(0, m, size):
        h = _rows(h[-1], a[at:at + size], b, ramp)
        kept.append(h[0].copy())
        top = int(h.argmax())
        if h.flat[top] > best:
            best, i, j = float(h.flat[top]), at + top // (n + 1), top % (n + 1)
    last, matched, first, at = j - 1, 0, j - 1, (len(kept) - 1) * size
    while i > 0 and j > 0:
        if not at < i <= at + size:
            at = (i - 1) // size * size
            h = _rows(kept[at // size][:j + 1], a[at:i], b[:j], ramp[:j + 1])
        score = h[i - at, j]
        if score <= 0:
            break
        same = b[j - 1] == a[i - 1]
        if score == h[i - at - 1, j - 1] + (np.float32(1) if same else -_PENALTY):
            i, j = i - 1, j - 1
            matched += int(same)
            first = j
        elif score == h[i - at - 1, j] - _PENALTY:
            i -= 1
        else:
            j -= 1
    return best, matched, first, last


class Seeds:
    """A block of items with their rare seeds, as sorted arrays per seed length."""

    def __init__(self, item_ids: list, texts: list[str], frequency: dict[int, float] | None, n: int, chance: float):
        enc = [t.encode() for t in texts]
        offs = np.concatenate(([0], np.cumsum([len(e) for e in enc]))).astype(np.int64)
        words, doc = _words(np.frombuffer(b"".join(enc), np.uint8), offs)
        self.ids, self.words = item_ids, [words[doc == i] for i in range(len(texts))] if len(texts) < 64 else \
            np.split(words, np.searchsorted(doc, np.arange(1, len(texts))))
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        if frequency is None:
            return
        found: dict[int, list] = {}
        for item, w in enumerate(self.words):
            width = min(n, len(w))
            if not width:
                continue
            p = np.array([frequency.get(int(x), 0.0) for x in w])
            odds = np.lib.stride_tricks.sliding_window_view(p, width).prod(axis=1)
            keep = odds <= chance if width == n else np.ones(len(odds), bool)
            if not keep.any():
                keep[:] = True
            runs = c.window_hash(w, width)
            found.setdefault(width, []).append((runs[keep], np.full(int(keep.sum()), item), np.flatnonzero(keep)))
        for width, parts in found.items():
            h, item, at = (np.concatenate([x[k] for x in parts]) for k in range(3))
            order = np.argsort(h, kind="stable")
            self.by_length[width] = (h[order], item[order], at[order])

    def vocabulary(self) -> np.ndarray:
        return np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]))

    def hits(self, words: np.ndarray, doc: np.ndarray):
        """(text position, item, item position) of every seed hit."""
        out = [np.zeros((3, 0), np.int64)]
        for width, (h, item, at) in self.by_length.items():
            runs = c.window_hash(words, width)
            if not len(runs):
                continue
            whole = doc[:len(runs)] == doc[width - 1:]
            lo = np.searchsorted(h, runs, "left")
            hit = np.flatnonzero(whole & (h[np.minimum(lo, len(h) - 1)] == runs))
            n = np.searchsorted(h, runs[hit], "right") - lo[hit]
            which = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append(np.stack([np.repeat(hit, n), item[which], at[which]]))
        return np.concatenate(out, axis=1)


def _counter(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary.value
        counts, total = np.zeros(len(vocab), np.int64), 0
        for b in batches:
            words, _ = _words(*c.text_buffers(b.column(0)))
            total += len(words)
            if len(vocab):
                at = np.minimum(np.searchsorted(vocab, words), len(vocab) - 1)
                counts += np.bincount(at[vocab[at] == words], minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(vocab)), -1)),
                                          pa.array(np.append(counts, total))], names=["word", "n"])
    return run


def _aligned(own: Seeds, text: pa.Array, min_score: float, min_words: float) -> dict[tuple[int, int], tuple]:
    """(row, item) -> score, matched words, first and last word of each leak in a batch of texts."""
    words, doc = _words(*c.text_buffers(text))
    pos, item, at = own.hits(words, doc)
    edges = np.searchsorted(doc, np.arange(len(text) + 1))
    order = np.lexsort((pos, item, doc[pos]))
    pos, item, at = pos[order], item[order], at[order]
    d = doc[pos]
    length = np.array([len(w) for w in own.words], np.int64)
    reach = length[item] + length[item] // 2 + 8 if len(item) else item
    new = np.ones(len(pos), bool)
    new[1:] = (d[1:] != d[:-1]) | (item[1:] != item[:-1]) | (pos[1:] - pos[:-1] > reach[1:])
    starts = np.flatnonzero(new)
    best: dict[tuple[int, int], tuple] = {}
    for i, j in zip(starts, np.append(starts[1:], len(pos))):
        w, row = own.words[item[i]], int(d[i])
        slack = len(w) // 2 + 8
        diag = pos[i:j] - at[i:j]
        lo = max(int(edges[row]), int(diag.min()) - slack)
        hi = min(int(edges[row + 1]), int(diag.max()) + len(w) + slack)
        # long passages in overlapping pieces that hold any alignment of the item
        step, to = max(4096, len(w)), lo
        for k in range(lo, hi, step):
            if to == hi:
                break
            to = min(hi, k + step + 2 * len(w) + 2 * slack)
            total, matched, first, last = align(w, words[k:to])
            key, score = (row, int(item[i])), total / len(w)
            base = k - int(edges[row])
            if (score >= min_score - 1e-9 or total >= min_words) and (key not in best or score > best[key][0]):
                best[key] = (score, matched, base + first, base + last)
    return best


def _scanner(seeds, min_score: float, min_words: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Seeds = seeds.value
        for b in batches:
            ids = b.column(0).to_pylist()
            rows = [(ids[k[0]], own.ids[k[1]], *v) for k, v in sorted(_aligned(own, b.column(1), min_score, min_words).items())]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(col, t) for col, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(),
                                                           pa.int64()))],
                names=["doc_id", "item_id", "score", "n_matched", "first_word", "last_word"])
    return run


def _cleaner(seeds, min_score: float, min_words: float, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[sorted({row for row, _ in _aligned(seeds.value, b.column(at), min_score, min_words)})] = False
            yield b.filter(pa.array(keep))
    return run


def _blocks(docs: DataFrame, items: DataFrame, n: int, chance: float, block_items: int, block_words: int) -> Iterator:
    """Broadcast seeds of one block of items after another."""
    spark = docs.sparkSession
    cols = docs.select(F.col("text").cast("string").alias("text"))
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where(F.col("text").isNotNull())
    size = tests.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block_items), -(-(size["bytes"] or 0) // (2 * block_words)))
    for k in range(blocks):
        block = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        ids, texts = [r["item_id"] for r in block], [r["text"] for r in block]
        vocab = Seeds(ids, texts, None, n, chance).vocabulary()
        counted = {r["word"]: r["n"] for r in cols.mapInArrow(_counter(spark.sparkContext.broadcast(vocab)),
                                                              "word long, n long")
                   .groupBy("word").agg(F.sum("n").alias("n")).collect()}  # one row a word of the block
        total = max(1, counted.get(-1, 0))
        frequency = {int(w): counted.get(i, 0) / total for i, w in enumerate(vocab)}
        yield spark.sparkContext.broadcast(Seeds(ids, texts, frequency, n, chance))


def leaks(docs: DataFrame, items: DataFrame, n: int = N, chance: float = CHANCE, min_score: float = MIN_SCORE,
          min_words: float = MIN_WORDS, block_items: int = BLOCK_ITEMS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, n_matched, first_word, last_word): every
    document and test item aligned with at least ``min_score`` of its words or ``min_words``."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = [cols.mapInArrow(_scanner(s, min_score, min_words), SCHEMA)
             for s in _blocks(docs, items, n, chance, block_items, block_words)]
    return reduce(DataFrame.unionByName, parts)


def clean(docs: DataFrame, items: DataFrame, n: int = N, chance: float = CHANCE, min_score: float = MIN_SCORE,
          min_words: float = MIN_WORDS, block_items: int = BLOCK_ITEMS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no leak, with all their columns."""
    out, at = docs, docs.columns.index("text")
    for s in _blocks(docs, items, n, chance, block_items, block_words):
        out = out.mapInArrow(_cleaner(s, min_score, min_words, at), docs.schema)
    return out

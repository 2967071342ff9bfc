"""Phrase mining after Toivonen: a sample proposes, full passes count exactly.

Texts have A-Z lower-cased, are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
these into words ``[^\\x20\\x09]+``; phrases are 2 or 3 consecutive words of a
piece, counted per language (NULL: ``und``).

1. A sample of documents of about ``SAMPLE_BYTES`` (hash-picked rows of up to
   ``SAMPLE_DOC`` bytes) gives the words S1 and pairs S2 that are frequent in it
   at a lowered threshold.  S1 and S2 are bounded by the sample and go to all tasks.
2. The first full pass counts S and its negative border exactly: every word,
   every pair of two S1 words, every triple of two S2 pairs.  Which pairs and
   triples these are is decided where they stand, so the border is never listed.
3. A border phrase that proves frequent (a failure) puts phrases into the
   border that were not counted.  Each further pass counts those: pairs whose
   words are frequent, triples whose pairs are.  A pass settles one length, so
   after ``MAX_WORDS`` passes in all the border is closed; a pass that no
   failure calls for sends nothing.
4. Every part of a frequent phrase is frequent (counts only fall as phrases
   grow), so the block that emits a phrase knows the exact counts of its parts.

Texts are packed once in blocks of about ``CHUNK_BYTES`` that hold word numbers
and their word list; work on a block takes some 18 times its text in memory.  A block sends each distinct phrase once, with its count,
to the shard of its hash; shards add up and answer each block with its
frequent phrases.  A phrase that a third of all documents hold is one entry a
block.  Phrases are told apart by 96 hash bits.

Edge cases: NULL or empty text has no words; ids are not read, so NULL and
repeated ones count row by row; a language with words but no phrase has no rows;
empty input gives empty output.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as c

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
INSIDE = 50                  # percent of a phrase's count that a longer one must have to replace it
SAMPLE_BYTES = 8 << 20
SAMPLE_DOC = 1 << 20
LOWERED = 0.5                # of the threshold that the sample's share of the corpus would ask for
UND = "und"
_U = np.uint64
_PIECE_END = np.array([chr(b) in ".,;:!?\n\x0b\x0c\r" for b in range(256)])
_APART = _PIECE_END | np.array([b in (0x20, 0x09) for b in range(256)])
_MULTIPLIER = (_U(0x9FB21C651E98DF25), _U(0xD6E8FEB86659FD93))
ANSWER = [("k1", "<u8"), ("k2", "<u4"), ("total", "<u8"), ("emit", "u1")]
EMIT_SCHEMA = "lang string, phrase string, words int, a long, l long, r long, score long, n long"


def _chain(x: np.ndarray, y: np.ndarray, lane: int) -> np.ndarray:
    return c.mix((x ^ c.mix(y + _U(lane + 1))) * _MULTIPLIER[lane])


def _join_bytes(parts: list[bytes]) -> bytes:
    return struct.pack(f"<I{len(parts)}Q", len(parts), *map(len, parts)) + b"".join(parts)


def _split_bytes(raw: bytes) -> list[bytes]:
    (k,) = struct.unpack_from("<I", raw)
    out, at = [], 4 + 8 * k
    for n in struct.unpack_from(f"<{k}Q", raw, 4):
        out.append(raw[at:at + n])
        at += n
    return out


class Block:
    """Word numbers of some documents (-1 between pieces), and per word its
    language and spelling; hashes are made from these when it is opened."""

    def __init__(self, tokens: np.ndarray, lang: np.ndarray, langs: list[str], spelling: np.ndarray, offs: np.ndarray):
        self.tokens, self.lang, self.langs, self.spelling, self.offs = tokens, lang, langs, spelling, offs
        self.keys = _word_keys(spelling, offs[:-1], offs[1:], langs, lang)

    @classmethod
    def of(cls, text: pa.Array, lang: pa.Array) -> Block:
        data, offs = c.text_buffers(text)
        data = c.ascii_lower(data)
        starts, ends, doc = c.word_spans(data, offs, _APART)
        coded = pc.fill_null(lang, UND).dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        langs = coded.dictionary.to_pylist()
        of_word = coded.indices.to_numpy(zero_copy_only=False)[doc] if len(doc) else np.zeros(0, np.int32)
        k1, k2 = _word_keys(data, starts, ends, langs, of_word)
        first, which = _distinct(k1, k2)
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        piece = np.searchsorted(np.flatnonzero(_PIECE_END[data]), starts)
        apart = np.zeros(len(starts), bool)
        if len(starts):
            apart[1:] = (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1])
        tokens = np.insert(which.astype(np.int32), np.flatnonzero(apart), -1)
        spelling = np.frombuffer(b"".join(words), np.uint8)
        at = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
        return cls(tokens, of_word[first].astype(np.int32), langs, spelling, at)

    def to_bytes(self) -> bytes:
        zip_ = zstandard.ZstdCompressor(level=1).compress
        return _join_bytes([c.pack(self.tokens), c.pack(self.lang, np.diff(self.offs).astype(np.int32)),
                            zip_(self.spelling.tobytes()), *(x.encode() for x in self.langs)])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Block:
        tokens, words, spelling, *langs = _split_bytes(raw)
        lang, sizes = c.unpack(words)
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(spelling), np.uint8)
        return cls(c.unpack(tokens)[0], lang, [x.decode() for x in langs], data,
                   np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))))

    def word(self, k: int) -> str:
        return self.spelling[self.offs[k]:self.offs[k + 1]].tobytes().decode()

    def pairs(self):
        """Distinct pairs (left word, right word, count) and, per token, the
        number of the pair that starts there (-1: none)."""
        t = self.tokens
        at = np.flatnonzero((t[:-1] >= 0) & (t[1:] >= 0)) if len(t) > 1 else np.zeros(0, np.int64)
        code, which, n = np.unique(t[at].astype(np.int64) * len(self.lang) + t[at + 1], return_inverse=True, return_counts=True)
        number = np.full(len(t), -1, np.int64)
        number[at] = which
        return code // max(1, len(self.lang)), code % max(1, len(self.lang)), n, number

    def pair_keys(self, left: np.ndarray, right: np.ndarray):
        return tuple(_chain(self.keys[lane][left], self.keys[lane][right], lane) for lane in (0, 1))


def _word_keys(data, starts, ends, langs, lang):
    """Two 64-bit keys of each word of a language."""
    names = [x.encode() for x in langs]
    at = np.concatenate(([0], np.cumsum([len(x) for x in names]))).astype(np.int64)
    tongue = np.frombuffer(b"".join(names), np.uint8)
    out = []
    for lane in (0, 1):
        own = c.span_hash(tongue, at[:-1], at[1:], lane)
        out.append(_chain(c.span_hash(data, starts, ends, lane), own[lang] if len(lang) else np.zeros(0, _U), lane))
    return out


def _distinct(k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of every distinct key, and the number of each place's key."""
    _, first, which = np.unique(k1, return_index=True, return_inverse=True)
    if len(k1) and (k2[first][which] != k2).any():
        _, first, which = np.unique(np.rec.fromarrays([k1, k2]), return_index=True, return_inverse=True)
    return first, which


def _among(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


class Answers:
    """Frequent phrases of a block with their totals over the corpus."""

    def __init__(self, blobs: list[bytes]):
        cols = [c.unpack(b) for b in blobs]
        k1, k2, total, emit = (np.concatenate([x[k] for x in cols]) if cols else np.zeros(0, t) for k, (_, t) in enumerate(ANSWER))
        order = np.lexsort((k2, k1))
        self.k1, self.k2, self.total, self.emit = k1[order], k2[order], total[order].astype(np.int64), emit[order] == 1

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is not frequent."""
        if not len(self.k1):
            return np.full(len(k1), -1, np.int64)
        short = (k2 & _U(0xFFFFFFFF)).astype(np.uint32)
        at = np.minimum(np.searchsorted(self.k1, k1), len(self.k1) - 1)
        hit = (self.k1[at] == k1) & (self.k2[at] == short)
        clash = np.flatnonzero((self.k1[at] == k1) & ~hit)
        for i in clash.tolist():  # another phrase with the same first half
            j = int(at[i]) + 1
            while j < len(self.k1) and self.k1[j] == k1[i]:
                if self.k2[j] == short[i]:
                    at[i], hit[i] = j, True
                j += 1
        return np.where(hit, at, -1)


# ---------------------------------------------------------------- what a pass counts

def _triples(block: Block, number: np.ndarray, eligible: np.ndarray, before: np.ndarray | None):
    """Distinct triples of two eligible pairs, unless both pairs were eligible
    ``before``: (first pair, second pair, count)."""
    here = number[:-1] if len(number) else number
    nxt = number[1:] if len(number) else number
    ok = (here >= 0) & (nxt >= 0)
    ok[ok] = eligible[here[ok]] & eligible[nxt[ok]]
    if before is not None:
        ok[ok] = ~(before[here[ok]] & before[nxt[ok]])
    pairs = max(1, len(eligible))
    code, n = np.unique(here[ok] * pairs + nxt[ok], return_counts=True)
    return code // pairs, code % pairs, n


def _triple_keys(block: Block, pair_keys, right: np.ndarray, first: np.ndarray, second: np.ndarray):
    return tuple(_chain(pair_keys[lane][first], block.keys[lane][right[second]], lane) for lane in (0, 1))


def to_count(block: Block, s1: np.ndarray, s2: np.ndarray, answers: list[Answers]):
    """(k1, k2, count) of the phrases that a pass after ``answers`` counts."""
    left, right, n, number = block.pairs()
    keys = block.pair_keys(left, right)
    in_s1 = _among(s1, block.keys[0])
    proposed = in_s1[left] & in_s1[right]           # pairs counted in the first pass
    in_s2 = proposed & _among(s2, keys[0])
    parts = []

    def count(k1: np.ndarray, k2: np.ndarray, m: np.ndarray) -> None:
        parts.append((k1, (k2 & _U(0xFFFFFFFF)).astype(np.uint32), m.astype(np.uint32)))
    if not answers:
        words = np.bincount(block.tokens[block.tokens >= 0], minlength=len(block.lang))
        count(*block.keys, words)
        count(keys[0][proposed], keys[1][proposed], n[proposed])
        first, second, m = _triples(block, number, in_s2, None)
    else:
        known = [a.find(*keys) >= 0 for a in answers]
        if len(answers) == 1:                       # words are settled
            frequent = answers[0].find(*block.keys) >= 0
            new = frequent[left] & frequent[right] & ~proposed
            count(keys[0][new], keys[1][new], n[new])
            first, second, m = _triples(block, number, in_s2 | known[0], in_s2)
        else:                                       # pairs are settled
            first, second, m = _triples(block, number, in_s2 | known[0] | known[1], in_s2 | known[0])
    del left, number
    count(*_triple_keys(block, keys, right, first, second), m)
    del keys, right, first, second
    k1, k2, total = (np.concatenate([p[k] for p in parts]) for k in range(3))
    parts.clear()
    order = np.argsort(k1)
    return k1[order], k2[order], total[order]


def sample_sets(block: Block, least: int) -> tuple[np.ndarray, np.ndarray]:
    """S1 and S2: sorted first key halves of the words and pairs of a sample
    that occur at least ``least`` times."""
    words = np.bincount(block.tokens[block.tokens >= 0], minlength=len(block.lang))
    left, right, n, _ = block.pairs()
    often = n >= least
    return np.sort(block.keys[0][words >= least]), np.sort(block.pair_keys(left[often], right[often])[0])


# ---------------------------------------------------------------- Spark

def _packer(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base, n = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            body = Block.of(t["text"], t["lang"]).to_bytes()
            return pa.RecordBatch.from_pydict({"chunk": pa.array([base + n], pa.int64()), "body": pa.array([body], pa.binary())})

        for b in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            i = 0
            while i < b.num_rows:
                done = int(sizes[i - 1]) if i else 0
                j = max(i + 1, int(np.searchsorted(sizes, done + chunk_bytes - size, "right")))
                held.append(b.slice(i, j - i))
                size += int(sizes[j - 1]) - done
                i = j
                if size >= chunk_bytes or i < b.num_rows:
                    yield flush()
                    held, size, n = [], 0, n + 1
        if held:
            yield flush()
    return run


def _sender(parts: int, s1: np.ndarray, s2: np.ndarray, passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            answers = [Answers(row[f"answers{k}"] or []) for k in range(passes)]
            k1, k2, n = to_count(Block.from_bytes(row["body"]), s1, s2, answers)
            runs = list(c.by_shard(c.shard_of(k1, parts), parts))
            if runs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _, _ in runs], pa.int32()), pa.array([row["chunk"]] * len(runs), pa.int64()),
                     pa.array([c.pack(c.deltas(k1[i:j]), k2[i:j], n[i:j]) for _, i, j in runs], pa.binary())],
                    names=["shard", "chunk", "blob"])
    return run


def _adder(min_count: int):
    def run(group: pa.Table) -> pa.Table:
        """Totals of a shard's phrases; each block learns its frequent ones, and
        the first block of a phrase that it emits it."""
        group = group.sort_by("chunk")
        sets = [c.unpack(b.as_py()) for b in group["blob"]]
        k1 = np.concatenate([c.undelta(s[0]) for s in sets])
        k2, n = (np.concatenate([s[k] for s in sets]) for k in (1, 2))
        order = np.lexsort((k2, k1))  # stable: blocks in ascending order
        new = np.ones(len(order), bool)
        new[1:] = (k1[order][1:] != k1[order][:-1]) | (k2[order][1:] != k2[order][:-1])
        first = np.flatnonzero(new)
        sums = np.add.reduceat(n[order].astype(np.uint64), first)
        total, emit = np.empty(len(order), np.uint64), np.zeros(len(order), np.uint8)
        total[order] = np.repeat(sums, np.diff(np.append(first, len(order))))
        emit[order[first]] = 1
        chunks, answers, at = [], [], 0
        for chunk, s in zip(group["chunk"].to_pylist(), sets):
            own = slice(at, at + len(s[1]))
            at = own.stop
            often = total[own] >= min_count
            if often.any():
                chunks.append(chunk)
                answers.append(c.pack(k1[own][often], k2[own][often], total[own][often], emit[own][often]))
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "answer": pa.array(answers, pa.binary())})
    return run


def _emitter(passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            block = Block.from_bytes(row["body"])
            every = Answers([b for k in range(passes) for b in row[f"answers{k}"] or []])
            left, right, _, number = block.pairs()
            keys = block.pair_keys(left, right)
            word = every.find(*block.keys)
            pair = every.find(*keys)
            first, second, _ = _triples(block, number, pair >= 0, None)
            triple = every.find(*_triple_keys(block, keys, right, first, second))
            out = []
            count = every.total

            def take(found: np.ndarray) -> list[int]:
                return np.flatnonzero((found >= 0) & every.emit[found]).tolist() if len(every.k1) else []
            for p in take(pair):
                a, l, r = (int(count[k]) for k in (pair[p], word[left[p]], word[right[p]]))
                out.append((block.langs[block.lang[left[p]]], f"{block.word(left[p])} {block.word(right[p])}", 2, a, l, r,
                            1000000 * a * a // (l * r), None))
            for t in take(triple):
                p, q = first[t], second[t]
                a = int(count[triple[t]])
                cuts = [(int(count[word[left[p]]]), int(count[pair[q]])), (int(count[pair[p]]), int(count[word[right[q]]]))]
                score, _, (l, r) = min((1000000 * a * a // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
                out.append((block.langs[block.lang[left[p]]],
                            f"{block.word(left[p])} {block.word(right[p])} {block.word(right[q])}", 3, a, l, r, score, None))
            words = np.bincount(block.lang[block.tokens[block.tokens >= 0]], minlength=len(block.langs))
            out += [(x, None, 1, None, None, None, None, int(k)) for x, k in zip(block.langs, words)]
            cols = list(zip(*out)) if out else [()] * 8
            kinds = (pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds)],
                                             names=["lang", "phrase", "words", "a", "l", "r", "score", "n"])
    return run


def _sample(cols: DataFrame, total: int, sample_bytes: int, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    share = min(1.0, sample_bytes / max(total, 1))
    least = max(2, int(min_count * share * LOWERED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            yield pa.RecordBatch.from_pydict({"keys": pa.array([x.tobytes() for x in sample_sets(Block.of(t["text"], t["lang"]), least)],
                                                               pa.binary())})
    rows = cols.withColumn("row", F.monotonically_increasing_id()) \
        .where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(share * (1 << 20))) \
        .where(F.octet_length("text") <= SAMPLE_DOC).drop("row")
    got = rows.repartition(1).mapInArrow(run, "keys binary").collect()  # bounded by the sample
    s1, s2 = (np.frombuffer(r["keys"], _U) for r in got) if len(got) == 2 else (np.zeros(0, _U), np.zeros(0, _U))
    return s1, s2


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, sample_bytes: int = SAMPLE_BYTES,
                     chunk_bytes: int = c.CHUNK_BYTES, parts: int | None = None) -> DataFrame:
    """(lang, phrase, words, a, l, r, score, n): every phrase with a count ``a``
    of at least ``min_count``, and rows without a phrase that add up to each
    language's word count ``n``."""
    cols = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    total = c.total_bytes(docs)
    parts = parts or c.parts_for(total)
    s1, s2 = _sample(cols, total, sample_bytes, min_count)
    chunks = cols.mapInArrow(_packer(chunk_bytes), c.CHUNK_SCHEMA).repartition(parts, "chunk")
    known = chunks
    for k in range(MAX_WORDS):
        sent = known.mapInArrow(_sender(parts, s1, s2, k), c.SHARD_SCHEMA)
        answers = sent.groupBy("shard").applyInArrow(_adder(min_count), c.ANSWER_SCHEMA) \
            .groupBy("chunk").agg(F.collect_list("answer").alias(f"answers{k}"))
        known = known.join(answers, "chunk", "left")
    return known.mapInArrow(_emitter(MAX_WORDS), EMIT_SCHEMA)


def mine(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, inside: int = INSIDE, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    phrases by score, count and spelling; a phrase inside a longer one with at
    least ``inside`` percent of its count is left out."""
    found = c.staged(frequent_phrases(docs, min_count, **options), "phrases")
    counts = found.where(F.col("phrase").isNull()).groupBy("lang").agg(F.sum("n").alias("n"))
    long = found.where(F.col("words") == MAX_WORDS).select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    phrases = found.where(F.col("phrase").isNotNull()).drop("n")
    kept = phrases.join(long, ["lang", "phrase"], "left").where(
        (F.col("words") == MAX_WORDS) | F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(counts, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL for op11: all phrases counted in one grouping
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, unnest(w) AS phrase, 1 AS k FROM w),
grams AS (
  SELECT lang, phrase, k FROM words
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM w
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM w),
f AS (SELECT lang, phrase, k, count(*) AS a FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS p FROM f WHERE k > 1 AND a >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, g.cut, x.a AS l, y.a AS r,
         (1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a)) AS score
  FROM cand c JOIN (SELECT unnest([1, 2]) AS cut) g ON g.cut < c.k
  JOIN f x ON x.lang = c.lang AND x.k = g.cut AND x.phrase = array_to_string(c.p[1:g.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - g.cut AND y.phrase = array_to_string(c.p[g.cut + 1:c.k], ' ')),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts)
           WHERE place = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, p[1] || ' ' || p[2] AS phrase, a FROM cand WHERE k = 3
    UNION ALL SELECT lang, p[2] || ' ' || p[3], a FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM lowest c LEFT JOIN longer o ON o.lang = c.lang AND o.phrase = c.phrase
         WHERE c.k = 3 OR o.a IS NULL OR 100 * o.a < 50 * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

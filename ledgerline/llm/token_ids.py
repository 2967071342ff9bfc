"""Token-id output: raw id payloads in shard files with a keyed index.

``write`` sorts documents by doc_id over range partitions, encodes whole texts
and writes shard files to the shared folder, in ascending doc_id order.  A file
holds a header, a minimal perfect hash over its document keys, per hash slot a
32-bit fingerprint and the key's first record, the records (doc_id, offset)
and the raw little-endian id payload (2 bytes an id when the vocabulary
allows, else 4).  ``write`` returns the manifest, one row a file; ``read``
decodes all files in parallel; ``TokenFiles`` finds one key in constant time.
A file is written under a name of its attempt and then moved, so a task that
runs again replaces it by the same bytes.

Encoding: a tokenizer file whose normalizer and pre-tokenizer lower-case and
drop white space (``_BY_WORD``) takes a text cut at ASCII white space, and each
distinct word once: words keep their ids in any white-space context.  A-Z are
lower-cased first, as the tokenizer does, and a final punctuation mark after a
letter is encoded by itself, as it splits there.  Words of Latin letters, the
bulk, go through the same vocabulary model without the regular expressions; all
others through the full tokenizer.  Any other file encodes whole texts.

Edge cases: NULL or empty text is just the end id; rows with a NULL doc_id come
first and have no key; rows that repeat a doc_id are adjacent records under
one key, ordered by a hash of the text (over several files if need be).  Empty input writes no file.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as c
from ledgerline.llm.mph import PerfectHash
from ledgerline.session import scratch_dir

END_ID = 1
FILE_BYTES = 16 << 20
_HEAD = struct.Struct("<4sBxxxQQQQ")  # magic, bytes an id, records, keys, ids, bytes of the hash
_MAGIC = b"TIDS"
MANIFEST_SCHEMA = "part int, seq int, path string, n_docs long, n_ids long, first_id long, last_id long"

_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS = re.compile(f"[{_LATIN}]+")
_MARKS = np.array([chr(b) in ".,;:!?" for b in range(256)])
_AZ = np.array([97 <= b <= 122 for b in range(256)])
_CACHE_WORDS = 600_000      # about 40 bytes each
_BATCH_BYTES = 1 << 20
#: the steps before the model for which ids of separate words are known to be the text's ids
_BY_WORD = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                         {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})


class _WordIds:
    """Ids of words seen before, by two word hashes, in sorted arrays."""

    def __init__(self, dtype: np.dtype, limit: int):
        self.limit = limit
        self.h1, self.h2 = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.base, self.n, self.used = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        self.ids = np.zeros(0, dtype)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it is not known."""
        if not len(self.h1):
            return np.full(len(h1), -1, np.int64)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        return np.where((self.h1[at] == h1) & (self.h2[at] == h2), at, -1)

    def add(self, h1: np.ndarray, h2: np.ndarray, base: np.ndarray, n: np.ndarray) -> None:
        """New words in ascending order of ``h1``; a first half known already stays as it is."""
        at = np.searchsorted(self.h1, h1)
        fresh = np.ones(len(h1), bool)
        inside = at < len(self.h1)
        fresh[inside] = self.h1[at[inside]] != h1[inside]
        h1, h2, base, n, at = h1[fresh], h2[fresh], base[fresh], n[fresh], at[fresh]
        self.h1, self.h2 = np.insert(self.h1, at, h1), np.insert(self.h2, at, h2)
        self.base, self.n = np.insert(self.base, at, base), np.insert(self.n, at, n)
        self.used = np.insert(self.used, at, True)

    def shrink(self) -> None:
        """Over the limit, words that were not met since the last turn go (all, if that does not halve them)."""
        if len(self.h1) <= self.limit:
            return
        keep = np.flatnonzero(self.used)
        if len(keep) > self.limit // 2:
            keep = keep[:0]
        n, base = self.n[keep], self.base[keep]
        past = np.cumsum(n, dtype=np.int64)
        at = np.arange(past[-1] if len(past) else 0) + np.repeat(base - (past - n), n)
        self.ids, self.base = self.ids[at], past - n
        self.h1, self.h2, self.n = self.h1[keep], self.h2[keep], n
        self.used = np.zeros(len(keep), bool)


class Encoder:
    """Ids of whole texts.  A tokenizer whose normalizer and pre-tokenizer are
    those of ``_BY_WORD`` encodes each distinct word once, with a bounded
    memory of words; any other one encodes whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.full = Tokenizer.from_file(path)
        self.full.no_padding()
        self.full.no_truncation()
        vocab = self.full.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        added = self.full.get_added_tokens_decoder()
        steps = tuple(x and json.loads(x.__getstate__()) for x in (self.full.normalizer, self.full.pre_tokenizer))
        model = self.full.model
        self.by_word = steps == _BY_WORD and getattr(model, "end_of_word_suffix", None) == "</w>" and not model.dropout and all(
            "<" in t.content and not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in added.values())
        if not self.by_word:
            return
        self.model = model
        self.letters = Tokenizer(model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # tokens that end a word
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.between = next(((i, t.content) for i, t in sorted(added.items())), None)  # parts words encoded together
        self.known = _WordIds(self.dtype, _CACHE_WORDS)

    def _ids(self, coder, text: str) -> np.ndarray:
        return np.array(coder.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(x.ids, self.dtype) for x in self.full.encode_batch_fast(words, add_special_tokens=False)]
        return np.concatenate(got), np.array([len(x) for x in got], np.int64)

    def _any_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids one word after the other, and the number of each word's ids."""
        if self.between is None or any("<" in w for w in words):
            return self._one_by_one(words)
        ids = self._ids(self.full, self.between[1].join(words))
        cut = np.flatnonzero(ids == self.between[0])
        if len(cut) != len(words) - 1:
            return self._one_by_one(words)
        lens = np.diff(np.concatenate(([-1], cut, [len(ids)]))) - 1
        return np.delete(ids, cut), lens

    def _plain_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of a-z, which no step before the model changes."""
        got = [[t.id for t in self.model.tokenize(w)] for w in words]
        return np.array(list(chain.from_iterable(got)), self.dtype), np.array([len(x) for x in got], np.int64)

    def _letter_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids(self.letters, " ".join(words))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(ids):
            return self._one_by_one(words)
        return ids, np.diff(cuts, prepend=0)

    def _new_words(self, words: list[bytes], plain: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, each word's first place in them and their number; ``plain`` words consist of a-z."""
        simple, letters, others = ([], []), ([], []), ([], [])
        for i, (w, az) in enumerate(zip(words, plain)):
            text, group = w.decode(), simple
            if not az:
                group = others
                if _LETTERS.fullmatch(text):
                    text, group = text.lower(), letters
            group[0].append(i)
            group[1].append(text)
        base, n, ids, total = np.empty(len(words), np.int64), np.empty(len(words), np.int64), [], 0
        for (at, texts), code in ((simple, self._plain_words), (letters, self._letter_words), (others, self._any_words)):
            for k in range(0, len(at), 4096):
                got, lens = code(texts[k:k + 4096])
                base[at[k:k + 4096]] = total + np.cumsum(lens) - lens
                n[at[k:k + 4096]] = lens
                ids.append(got)
                total += len(got)
        return np.concatenate(ids) if ids else np.zeros(0, self.dtype), base, n

    def batch(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the documents, and the number of each document's ids."""
        if not self.by_word:
            raw = data.tobytes()
            return self._one_by_one([raw[i:j].decode() for i, j in zip(offs[:-1].tolist(), offs[1:].tolist())])
        starts, ends, doc = c.word_spans(data, offs)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(offs) - 1, np.int64)
        lower = c.ascii_lower(data)
        special = np.searchsorted(starts, np.flatnonzero(data == ord("<")), "right") - 1
        for k in np.unique(special):  # may spell a special token, whose case counts
            lower[starts[k]:ends[k]] = data[starts[k]:ends[k]]
        # a final mark after a letter is a piece of its own
        where = np.flatnonzero((ends - starts > 1) & _MARKS[lower[ends - 1]] & _AZ[lower[np.maximum(ends - 2, 0)]])
        marks = ends[where] - 1
        ends[where] -= 1
        starts, ends = np.insert(starts, where + 1, marks), np.insert(ends, where + 1, marks + 1)
        doc = np.insert(doc, where + 1, doc[where])
        h1, h2 = (c.span_hash(lower, starts, ends, lane) for lane in (0, 1))
        _, first, which = np.unique(h1, return_index=True, return_inverse=True)
        distinct = not (h2[first][which] != h2).any()
        if not distinct:  # two words share 64 bits: take each place by itself
            first, which = np.arange(len(h1)), np.arange(len(h1))
        known = self.known
        known.shrink()
        h1, h2 = h1[first], h2[first]
        at = known.find(h1, h2)
        base, n = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        hit, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        base[hit], n[hit] = known.base[at[hit]], known.n[at[hit]]
        known.used[at[hit]] = True
        table = known.ids
        if len(new):
            raw, s, e = lower.tobytes(), starts[first[new]], ends[first[new]]
            letters = np.concatenate(([0], np.cumsum(_AZ[lower], dtype=np.int32)))
            ids, base[new], n[new] = self._new_words([raw[i:j] for i, j in zip(s.tolist(), e.tolist())],
                                                     (letters[e] - letters[s] == e - s).tolist())
            base[new] += len(table)
            table = np.concatenate([table, ids])
            if distinct:
                known.ids = table
                known.add(h1[new], h2[new], base[new], n[new])
        n = n[which]
        past = np.cumsum(n)
        at = np.arange(past[-1]) + np.repeat(base[which] - (past - n), n)
        per_doc = np.bincount(doc, n, minlength=len(offs) - 1).astype(np.int64)
        return table[at], per_doc


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _key_hash(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = ids.astype(np.int64).view(np.uint64)
    return c.mix(k + np.uint64(0x9E3779B97F4A7C15)), c.mix(k ^ np.uint64(0xD6E8FEB86659FD93))


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype("<u4")


def file_bytes(ids: np.ndarray, known: np.ndarray, counts: np.ndarray, payload: np.ndarray) -> bytes:
    """A shard file. ``ids`` ascending with unknown (NULL) ones first."""
    n0 = int((~known).sum())
    keys, first = np.unique(ids[n0:], return_index=True)
    h1, h2 = _key_hash(keys)
    hashed = PerfectHash.build(h1, h2)
    slot = hashed.index(h1, h2)
    prints, record = np.empty(len(keys), "<u4"), np.empty(len(keys), "<u4")
    prints[slot], record[slot] = _fingerprint(h2), first + n0
    raw = hashed.to_bytes()
    offsets = np.concatenate(([0], np.cumsum(counts))).astype("<i8")
    return b"".join([_HEAD.pack(_MAGIC, payload.itemsize, len(ids), len(keys), len(payload), len(raw)), raw,
                     prints.tobytes(), record.tobytes(), known.astype(np.uint8).tobytes(), ids.astype("<i8").tobytes(),
                     offsets.tobytes(), payload.tobytes()])


class TokenFile:
    """One decoded shard file (``raw`` may be a memory map)."""

    def __init__(self, raw):
        magic, width, n, keys, n_ids, hash_bytes = _HEAD.unpack_from(raw)
        assert magic == _MAGIC, "not a token-id file"
        at = _HEAD.size
        self.hashed = PerfectHash.from_bytes(bytes(raw[at:at + hash_bytes]))
        at += hash_bytes

        def take(dtype, count):
            nonlocal at
            out = np.frombuffer(raw, dtype, count, at)
            at += out.nbytes
            return out
        self.prints, self.record = take("<u4", keys), take("<u4", keys)
        self.known, self.ids = take(np.uint8, n).astype(bool), take("<i8", n)
        self.offsets, self.payload = take("<i8", n + 1), take(f"<u{width}", n_ids)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First record of each key, -1 if the file has no such key."""
        h1, h2 = _key_hash(keys)
        slot = self.hashed.index(h1, h2)
        hit = slot >= 0
        hit[hit] = self.prints[slot[hit]] == _fingerprint(h2[hit])
        out = np.full(len(keys), -1, np.int64)
        out[hit] = self.record[slot[hit]]
        hit[hit] = self.ids[out[hit]] == keys[hit]
        return np.where(hit, out, -1)

    def tokens(self, record: int) -> np.ndarray:
        return self.payload[self.offsets[record]:self.offsets[record + 1]]


def _open(path: str):
    where, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return where, name


def _read_file(path: str) -> TokenFile:
    where, name = _open(path)
    with where.open_input_file(name) as f:
        return TokenFile(f.read())


def _writer(folder: str, tokenizer: str, end_id: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, coder = TaskContext.get(), _encoder(tokenizer)
        held, size, seq = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, seq
            ids, known, counts = (np.concatenate([h[k] for h in held]) for k in (0, 1, 2))
            payload = np.concatenate([h[3] for h in held])
            path = f"{folder}/part-{task.partitionId():06d}-{seq:05d}.tokens"
            where, name = _open(path)
            where.create_dir(name.rsplit("/", 1)[0], recursive=True)
            own = f"{name}.{task.taskAttemptId()}"
            with where.open_output_stream(own) as out:
                out.write(file_bytes(ids, known, counts, payload))
            where.move(own, name)
            known_ids = ids[known]
            row = pa.RecordBatch.from_pylist([{
                "part": task.partitionId(), "seq": seq, "path": path, "n_docs": len(ids), "n_ids": len(payload),
                "first_id": int(known_ids[0]) if len(known_ids) else None,
                "last_id": int(known_ids[-1]) if len(known_ids) else None}],
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                                  ("n_ids", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64())]))
            held, size, seq = [], 0, seq + 1
            return row

        for b in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + _BATCH_BYTES, "right")))
                part = b.slice(i, j - i)
                i = j
                data, offs = c.text_buffers(part.column(1))
                payload, n = coder.batch(data, offs)
                past = np.cumsum(n)
                payload = np.insert(payload, past, payload.dtype.type(end_id))  # the end id closes each document
                doc = part.column(0)
                known = np.asarray(doc.is_valid().to_numpy(zero_copy_only=False), bool)
                held.append((doc.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known, n + 1, payload))
                size += payload.nbytes
                if size >= limit:
                    yield flush()
        if held:
            yield flush()
    return run


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID,
          parts: int | None = None, limit: int = FILE_BYTES) -> DataFrame:
    """Encode and write all documents; returns the manifest with ``start``, the
    number of ids in all files before."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-ids")
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = parts or c.parts_for(c.total_bytes(docs))
    # a hash of the text and a row number split ids that many rows share (NULL among them)
    dealt = cols.withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    key = [F.col("doc_id").asc_nulls_first(), "digest"]
    ordered = dealt.repartitionByRange(parts, *key, "row").sortWithinPartitions(*key, F.col("text").asc_nulls_first()) \
        .select("doc_id", "text")
    manifest = c.staged(ordered.mapInArrow(_writer(folder, tokenizer, end_id, limit), MANIFEST_SCHEMA), "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return c.staged(manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long"))),
                    "token-manifest-starts")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, found through the
    index of its file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            f = _read_file(row["path"])
            record = np.arange(len(f.ids))
            keyed = np.flatnonzero(f.known)
            first = f.find(f.ids[keyed])
            if (first < 0).any():
                raise ValueError(f"{row['path']}: the index misses a key")
            # repeated keys are adjacent: the i-th record of a key is the i-th after its first
            again = np.arange(len(keyed)) - np.searchsorted(f.ids[keyed], f.ids[keyed])
            record[keyed] = first + again
            crc = [zlib.crc32(f.tokens(r).astype("<u4").tobytes()) for r in record]
            yield pa.RecordBatch.from_arrays(
                [pa.array(f.ids, pa.int64(), mask=~f.known), pa.array(row["start"] + f.offsets[record], pa.int64()),
                 pa.array(np.diff(f.offsets)[record], pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
    spread = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path", "start").repartition(spread).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


class TokenFiles:
    """Keyed access: the file by its id range, the record by its hash slot."""

    def __init__(self, manifest: DataFrame):
        # one row a file, a few dozen bytes for each 16 MB of payload
        self.files = manifest.where("first_id is not null").orderBy("first_id").select("first_id", "path").collect()

    def get(self, doc_id: int) -> list[np.ndarray]:
        """Ids of every record of the key (none if absent)."""
        out = []
        at = bisect_right([r["first_id"] for r in self.files], doc_id) - 1
        while at >= 0:
            f = _read_file(self.files[at]["path"])
            r = int(f.find(np.array([doc_id]))[0])
            while 0 <= r < len(f.ids) and f.ids[r] == doc_id:
                out.append(f.tokens(r))
                r += 1
            if self.files[at]["first_id"] != doc_id:
                break
            at -= 1
        return out

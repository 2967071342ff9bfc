"""Language identification with error-correcting output codes.

Each language has a codeword of -1/+1 bits.  For every bit a binary logistic
classifier over hashed byte n-grams (orders 1 to 4 of the lower-cased text,
log-scaled counts at unit length) predicts whether the text's language has
that bit.  Decoding sums the logistic loss of each codeword's bits against the
classifiers' margins, every bit weighted by its accuracy on the training
sample; the nearest codeword is the prediction.  The two smallest
losses give the score (their softmax share) and the ``ambiguous`` flag.

Training uses a bounded, documented sample: about ``per_language`` documents of
each language, at most ``max_sample`` in all, chosen by a hash of the
document id, so reruns agree.  The sample is dealt to one task per bit, as packed blocks
of features.

Edge cases: a NULL text, or one without a letter, is ``und`` with score 0; rows
with a NULL language or id are never learned from; with one known language
everything with letters is that language; with none everything is ``und``.
Whole texts are read, in pieces that bound memory: batches are worked on in slices of
about ``_SLICE`` bytes of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as c

PER_LANGUAGE = 400
MAX_SAMPLE = 4000
DIM = 1 << 12
ORDERS = (1, 2, 3, 4)
UND = "und"
_PIECE = 1 << 20
_SLICE = 1 << 21     # text bytes of a batch worked on at once
_BLOCK_ROWS = 64     # sample documents packed together
_MULT = np.uint32(0x9E3779B1)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k codewords of -1/+1 (rows).  Up to 6 languages: every split of the
    languages in two (the exhaustive code, distance 2^(k-2)); beyond: the random
    code of 10*log2(k) bits with the largest smallest distance of 200 tries."""
    if k < 2:
        return np.ones((k, 0), np.int8)
    if k <= 6:
        cols = np.arange(1, 1 << (k - 1))
        return np.where((cols[None, :] >> np.arange(k)[:, None]) & 1, 1, -1).astype(np.int8)
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(200):
        m = rng.choice(np.array([-1, 1], np.int8), (k, int(np.ceil(10 * np.log2(k)))))
        d = m.shape[1] - m.astype(np.int32) @ m.T.astype(np.int32)
        np.fill_diagonal(d, 1 << 30)
        split = (np.abs(m.sum(axis=0, dtype=np.int64)) < k).all()
        if split and d.min() > far:
            best, far = m, d.min()
    return best


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values of one lower-cased UTF-8 text."""
    counts = np.zeros(DIM, np.int64)
    for i in range(0, len(data), _PIECE):
        g = np.zeros(min(_PIECE, len(data) - i), np.uint32)
        part = data[i:i + _PIECE + max(ORDERS)].astype(np.uint32)
        for n in ORDERS:
            g = g[:len(part) - n + 1]
            if not len(g):
                break
            g = (g + part[n - 1:n - 1 + len(g)] + np.uint32(n)) * _MULT
            g ^= g >> np.uint32(15)
            counts += np.bincount(g & np.uint32(DIM - 1), minlength=DIM)
    ids = np.flatnonzero(counts)
    values = np.log1p(counts[ids])
    norm = np.sqrt((values ** 2).sum())
    return ids, (values / norm if norm else values).astype(np.float32)


def has_letter(raw: bytes) -> bool:
    """Whether the UTF-8 text holds any Unicode letter."""
    if raw.isalpha() or any(65 <= b <= 90 or 97 <= b <= 122 for b in raw[:256]):
        return True
    return any(ch.isalpha() for ch in raw.decode())


def learning_sample(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE,
                    max_sample: int = MAX_SAMPLE) -> tuple[list[str], DataFrame]:
    """Languages, and (lang, text) of about ``per_language`` learnable
    documents of each (all of a rarer one)."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)  # one row a language
    each = max(1, min(per_language, max_sample // max(1, len(langs))))
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id").cast("long")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.coalesce(F.try_element_at(F.create_map(*[x for l in langs for x in (F.lit(l), F.lit(each / sizes[l]))]),
                                        F.col("lang")), F.lit(0.0)) if langs else F.lit(0.0)
    return langs, rows.where(draw < share).select("lang", "text")


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``_SLICE`` bytes of column ``at`` (a longer text is one of its own)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + _SLICE, "right")))
        yield batch.slice(i, j - i)
        i = j


def pack_features(place: list[int], rows: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Languages (by number) and features of some documents."""
    each = c.pack(np.array(place, np.int32), np.array([len(r[0]) for r in rows], np.int32))
    every = c.pack(np.concatenate([r[0] for r in rows]).astype(np.uint16), np.concatenate([r[1] for r in rows]))
    return len(each).to_bytes(4, "little") + each + every


def unpack_features(blob: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(language, ids, values) of each packed document."""
    cut = 4 + int.from_bytes(blob[:4], "little")
    place, sizes = c.unpack(blob[4:cut])
    ids, vals = c.unpack(blob[cut:])
    ends = np.cumsum(sizes)
    for k, to in enumerate(ends.tolist()):
        own = slice(to - int(sizes[k]), to)
        yield int(place[k]), ids[own].astype(np.int32), vals[own]


def _featured(sample: DataFrame, langs: list[str]) -> DataFrame:
    number = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, 1):
                data, offs = c.text_buffers(part.column(1))
                data, place = c.ascii_lower(data), [number[x] for x in part.column(0).to_pylist()]
                for i in range(0, part.num_rows, _BLOCK_ROWS):
                    j = min(part.num_rows, i + _BLOCK_ROWS)
                    blob = pack_features(place[i:j], [features(data[offs[k]:offs[k + 1]]) for k in range(i, j)])
                    yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["blob"])
    return sample.mapInArrow(run, "blob binary")


def fit_binary(ids: list[np.ndarray], vals: list[np.ndarray], y: np.ndarray, epochs: int = 30,
               seed: int = 0) -> tuple[np.ndarray, float]:
    """Class-balanced logistic regression by AdaGrad on mini-batches; the weight
    of the bias is the last one.  Returns the weights and the training accuracy."""
    x = np.zeros((len(y), DIM + 1), np.float32)
    for i, (a, v) in enumerate(zip(ids, vals)):
        x[i, a] = v
    x[:, DIM] = 1.0
    n_pos = max(1, int((y > 0).sum()))
    balance = np.where(y > 0, 0.5 / n_pos, 0.5 / max(1, len(y) - n_pos)) * len(y)
    w, acc, rng = np.zeros(DIM + 1, np.float32), np.full(DIM + 1, 1e-6, np.float32), np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), 64):
            rows = order[k:k + 64]
            m = np.clip(y[rows] * (x[rows] @ w), -30, 30)
            g = -(x[rows].T @ (balance[rows] * y[rows] / (1 + np.exp(m)))) / len(rows) + 1e-5 * w
            acc += g * g
            w -= (0.5 * g / np.sqrt(acc)).astype(np.float32)
    return w, float((np.sign(x @ w) == y).mean())


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, bit_weight: np.ndarray):
        self.langs, self.code, self.weights, self.bit_weight = langs, code, weights, bit_weight

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword, score and relative loss gap to the next one, per row of margins."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None].astype(np.float64)) @ self.bit_weight
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(margins))
        best = loss[rows, order[:, 0]]
        share = 1 / np.exp(best[:, None] - loss).sum(axis=1)
        if len(self.langs) < 2:
            return order[:, 0], share, np.ones(len(margins))
        nxt = loss[rows, order[:, 1]]
        return order[:, 0], share, (nxt - best) / np.maximum(nxt, 1e-12)


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, max_sample: int = MAX_SAMPLE) -> Model:
    langs, sample = learning_sample(docs, learn, per_language, max_sample)
    code = codewords(len(langs))
    bits = code.shape[1]
    if not bits:
        return Model(langs, code, np.zeros((0, DIM + 1), np.float32), np.ones(0))

    def train(group: pa.Table) -> pa.Table:
        bit = group["bit"][0].as_py()
        rows = [r for blob in group["blob"] for r in unpack_features(blob.as_py())]
        rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))  # the same order in every run
        y = code[[r[0] for r in rows], bit].astype(np.float32)
        w, right = fit_binary([r[1] for r in rows], [r[2] for r in rows], y, seed=bit)
        return pa.table({"bit": pa.array([bit], pa.int32()), "weights": pa.array([w.tobytes()], pa.binary()),
                         "accuracy": pa.array([right], pa.float64())})

    dealt = c.staged(_featured(sample, langs), "lang-sample").withColumn("bit", F.explode(F.array(*map(F.lit, range(bits)))))
    fitted = {r["bit"]: r for r in dealt.groupBy("bit").applyInArrow(
        train, "bit int, weights binary, accuracy double").collect()}  # one row a bit
    zero = np.zeros(DIM + 1, np.float32)
    w = np.stack([np.frombuffer(fitted[b]["weights"], np.float32) if b in fitted else zero for b in range(bits)])
    right = np.array([fitted[b]["accuracy"] if b in fitted else 0.5 for b in range(bits)])
    strength = np.maximum(right - 0.5, 1e-3)
    return Model(langs, code, w, strength / strength.mean())


def predict(docs: DataFrame, model: Model, min_gap: float = 0.05) -> DataFrame:
    """All columns of ``docs`` plus lang_pred, score and ambiguous (the two
    nearest codewords' losses differ by less than ``min_gap``)."""
    names = [n for n in ("lang_pred", "score", "ambiguous") if n in docs.columns]
    rest = [n for n in docs.columns if n not in names]
    schema = docs.select(*[F.col(f"`{n}`") for n in rest]).schema
    from pyspark.sql import types as T
    out_schema = T.StructType(schema.fields + [T.StructField("lang_pred", T.StringType()),
                                               T.StructField("score", T.DoubleType()),
                                               T.StructField("ambiguous", T.BooleanType())])
    at = rest.index("text")
    weights, bias = np.ascontiguousarray(model.weights[:, :-1].T), model.weights[:, -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in _slices(whole, at)):
            data, offs = c.text_buffers(b.column(at))
            raw, lower = data.tobytes(), c.ascii_lower(data)
            margins = np.zeros((b.num_rows, model.code.shape[1]))
            letters = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                letters[i] = bool(model.langs) and has_letter(raw[offs[i]:offs[i + 1]])
                if letters[i]:
                    ids, vals = features(lower[offs[i]:offs[i + 1]])
                    margins[i] = vals @ weights[ids] + bias
            if model.langs:
                best, share, gap = model.decode(margins)
            else:
                best, share, gap = np.zeros(b.num_rows, int), np.zeros(b.num_rows), np.ones(b.num_rows)
            pred = [model.langs[k] if ok else UND for k, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(pred, pa.string()), pa.array(np.where(letters, share, 0.0)),
                 pa.array(letters & (gap < min_gap))], names=[*rest, "lang_pred", "score", "ambiguous"])
    return docs.select(*[F.col(f"`{n}`") for n in rest]).mapInArrow(run, out_schema)


def held_out(doc_id: Column | str = "doc_id", folds: int = 5) -> Column:
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % folds == 0, F.lit(False))

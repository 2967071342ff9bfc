"""Language-model scoring with a gated recurrent network in numpy.

Tokens are the words [^\\x20\\x09-\\x0D]+ of the text with A-Z lower-cased, then one end token.

Counts.  Each chunk of documents sends its distinct words with their counts in
its training documents to shards; the shards sum them, answer each chunk the
corpus counts of its words, and keep their most frequent words.  All training
tokens are counted; equal words are recognised by 128 hash bits.

Model.  The most frequent words, the end and a rare-word token feed a GRU of ``hidden``
units.  The vocabulary is the words that training documents have ``min_count`` times, up to
``GROWTH`` times the root of the training tokens or 4,096 (600 words at least, 262,144 at most), so it grows
with the corpus and stays bounded; ``vocabulary`` instead sets its size.  A histogram of
the counts finds the cut, and only the words above it reach the driver.
Its output softmax is factored by classes of words alike in frequency, as many as a
class has words: p(word) = p(class | state) p(word | class, state).  A rarer
word's probability is the rare-word token's times the word's smoothed share of the rare
counts.  Output biases start at the corpus frequencies.  The weights take 8 bytes a word
and unit (34 MB at most with 16 units), their training twice that more in each worker; a
window touches only the weights of its own words and classes.

Training.  Replicas, one per input partition, run truncated back-propagation
over ``window`` steps with the state carried over, on the training documents of
their partition that a hash of the id puts in the round; after each round Spark
averages the replicas by tokens, in blocks of weights and as a tree of ``_FAN_IN``
replicas a task, so no task grows with their number.  The rounds share out the training fold, so
the network sees every training document once, whatever the size of the corpus.

Scoring.  A batch of documents advances together in windows; the state of a
document is carried from window to window to its end, so the score is the
log10-likelihood of the complete text.  The fewer documents are left, the longer the window.

Arithmetic.  States are units x documents, so that each operation runs along memory.  A
softmax's bias is one more row of its weights, its sums are a product, and a state's largest
logit is taken off only where the weights could carry a logit too far.  In training, classes
of few tokens are worked on together.

Edge cases: NULL text is empty and still has the end token; rows with a NULL id
are scored and never learned from; with no training tokens the base is uniform
and the network keeps its start values.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common as c

HIDDEN, MIN_COUNT = 16, 50
WINDOW, STREAMS, ROUNDS, RATE = 16, 512, 2, 0.1
GROWTH = 2  # vocabulary words per root of the training tokens
_GROUP_TOKENS = 3_000_000
_LEAST_WORDS, _FREE_WORDS, _MOST_WORDS = 600, 1 << 12, 1 << 18
_HASHED = 1 << 15  # words hashed at a time
_BLOCK = 1 << 16  # weights averaged together
_FAN_IN = 64      # replicas averaged by a task
_LEAST_STEPS = 100  # updates of a stream, before it is split further
_STEPS = 16       # of the count histogram to a doubling
_SIGN = np.uint64(1 << 63)
END, UNKNOWN = 0, 1  # token numbers; vocabulary words follow


def held_out(doc_id: int | None, folds: int = 7, fold: int = 2) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


class _Words:
    """Distinct words of a chunk, ascending by hash, and each token's index among them."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        lower = c.ascii_lower(data)
        starts, ends, self.doc = c.word_spans(lower, offs)
        h1, h2 = np.empty((2, len(starts)), np.uint64)
        for i in range(0, len(starts), _HASHED):
            r = slice(i, i + _HASHED)
            at, to = starts[r][0], ends[r][-1]
            for lane, h in enumerate((h1, h2)):
                h[r] = c.span_hash(lower[at:to], starts[r] - at, ends[r] - at, lane)
        order = np.argsort(h1)
        ascending = h1.take(order)
        new = np.ones(len(order), bool)
        new[1:] = ascending[1:] != ascending[:-1]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.h1, self.h2 = ascending[new], h2.take(order[new])
        if (self.h2.take(self.which) != h2).any():  # equal first halves: order by both
            order = np.lexsort((h2, h1))
            new = np.ones(len(order), bool)
            new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
            self.which = np.empty(len(order), np.int64)
            self.which[order] = np.cumsum(new) - 1
            self.h1, self.h2 = h1[order][new], h2[order][new]


def _send_words(parts: int, learn: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            chunk = c.Chunk(row["body"])
            words = _Words(chunk.data, chunk.offs)
            train = np.array([k and learn(int(i)) for i, k in zip(chunk.ids, chunk.known)], bool)
            counts = np.bincount(words.which[train[words.doc]], minlength=len(words.h1)).astype(np.uint32)
            for s, i, j in c.by_shard(c.shard_of(words.h1, parts), parts):
                yield c.batch({"shard": pa.int32(), "chunk": pa.int64(), "blob": pa.binary()},
                              shard=pa.array([s], pa.int32()), chunk=[row["chunk"]],
                              blob=[c.pack(c.deltas(words.h1[i:j]), words.h2[i:j], counts[i:j])])
    return run


def _shard_words(counts: np.ndarray, vocabulary: int | None, min_count: int) -> int:
    """How many of a shard's words with these counts, descending, may be of the vocabulary."""
    if vocabulary is not None:
        return min(vocabulary, len(counts))
    return min(max(_LEAST_WORDS, int((counts >= min_count).sum())), int((counts > 0).sum()))


def vocabulary_size(frequent: int, tokens: int) -> int:
    """Words of the vocabulary: the ``frequent`` ones, all of them up to ``_FREE_WORDS``
    and beyond as far as ``tokens`` training tokens allow."""
    return min(max(_LEAST_WORDS, min(frequent, max(_FREE_WORDS, int(GROWTH * math.sqrt(tokens))))), _MOST_WORDS)


def _step_of(counts: np.ndarray) -> np.ndarray:
    """Step of the histogram, ascending with the count."""
    return np.floor(np.log2(counts.astype(np.float64)) * _STEPS).astype(np.int64)


def _count_shard(vocabulary: int | None, min_count: int):
    """Corpus counts: an answer to each chunk, and under chunk -1 the shard's
    totals and the words that may be of the vocabulary."""
    def run(group: pa.Table) -> pa.Table:
        sets = [c.unpack(b.as_py()) for b in group["blob"]]
        h1 = np.concatenate([c.undelta(s[0]) for s in sets])
        h2, n = (np.concatenate([s[k] for s in sets]) for k in (1, 2))
        order = np.lexsort((h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order], first, dtype=np.uint64)
        mine = np.empty(len(order), np.int64)
        mine[order] = np.cumsum(new) - 1
        shard, at, chunks, answers = group["shard"][0].as_py(), 0, [], []
        for chunk, s in zip(group["chunk"].to_pylist(), sets):
            chunks.append(chunk)
            answers.append(struct.pack("<i", shard) + c.pack(total[mine[at:at + len(s[0])]]))
            at += len(s[0])
        top = np.lexsort((h2[order[first]], h1[order[first]], -total.astype(np.int64)))
        top = top[:_shard_words(total[top], vocabulary, min_count)]
        chunks.append(-1)
        answers.append(struct.pack("<QQ", int((total > 0).sum()), int(total.sum()))
                       + c.pack(h1[order[first[top]]], h2[order[first[top]]], total[top]))
        return pa.table({"chunk": pa.array(chunks, pa.int64()), "answer": pa.array(answers, pa.binary())})
    return run


# ---------------------------------------------------------------- network

@dataclass
class Shape:
    words: int      # vocabulary with end and unknown
    hidden: int
    class_size: int

    @property
    def classes(self) -> int:
        return -(-self.words // self.class_size)

    def sizes(self) -> list[tuple[str, tuple[int, ...]]]:
        h, k = self.hidden, self.classes
        return [("embed", (self.words, h)), ("w", (h, 3 * h)), ("u", (h, 3 * h)), ("b", (3 * h,)), ("wc", (h, k)),
                ("bc", (k,)), ("ww", (k, h, self.class_size)), ("bw", (k, self.class_size))]


def start_values(shape: Shape, counts: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    rng, p = np.random.default_rng(seed), {}
    for name, size in shape.sizes():
        p[name] = (rng.standard_normal(size) * 0.1).astype(np.float32) if name not in ("b", "bc", "bw") else np.zeros(size, np.float32)
    padded = np.zeros(shape.classes * shape.class_size)
    padded[:len(counts)] = counts + 1.0
    per = padded.reshape(shape.classes, shape.class_size)
    p["bc"] = np.log(per.sum(axis=1) / per.sum()).astype(np.float32)
    with np.errstate(divide="ignore"):
        p["bw"] = np.maximum(np.log(per), -60).astype(np.float32)  # places past the vocabulary get no mass
    return p


def flatten(p: dict, shape: Shape) -> np.ndarray:
    return np.concatenate([p[n].ravel() for n, _ in shape.sizes()])


def unflatten(flat: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, size in shape.sizes():
        n = int(np.prod(size))
        out[name] = flat[at:at + n].reshape(size).astype(np.float32)
        at += n
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    half = x.dtype.type(0.5)
    x *= half
    np.tanh(x, out=x)
    x *= half
    x += half
    return x


_PRODUCT = 800_000  # multiplications of a product of softmax weights and states
_PIECE = 1 << 15  # weights changed together
_SCORED = 1 << 16  # tokens scored together at least
_FEW, _TOGETHER = 48, 16  # a class of as few tokens shares its products' calls with so many like it
_REACH = 60.0    # logits this far from the largest bias neither overflow nor vanish


def _with_bias(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights (units x outputs) with the biases, less their largest, as one more row."""
    return np.concatenate([w, (b - b.max(axis=-1, keepdims=True))[..., None, :]], axis=-2)


def _flat(w: np.ndarray, size: float = 1.0) -> np.ndarray:
    """Whether states up to ``size`` leave each softmax's logits near its largest bias, so
    that ``_with_bias`` has already made them safe to exponentiate."""
    n, most = w.shape[-2], _REACH / max(1.0, size)
    flat = w.reshape(*w.shape[:-2], -1)
    flat = np.maximum(flat.max(axis=-1), -flat.min(axis=-1)) * n < most
    return flat if flat.all() else np.abs(w).sum(axis=-2).max(axis=-1) < most


def _rows(w: np.ndarray) -> int:
    """Tokens whose softmax is held at a time, so that it stays in the cache."""
    return max(16, _PRODUCT // w.size)


def _exp_logits(w: np.ndarray, flat: bool, states: np.ndarray, targets: np.ndarray, one: np.ndarray,
                picked: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentiated outputs by tokens (rows) and the targets' places in them; fills in the
    targets' logits and the sums.  ``one`` is as many ones as outputs."""
    x = states @ w
    if not flat:
        x -= x.max(axis=1, keepdims=True)
    at = np.arange(0, x.size, len(one))
    at += targets
    x.ravel().take(at, out=picked)
    np.exp(x, out=x)
    np.dot(x, one, out=total)
    return x, at


def _softmax(w: np.ndarray, flat: bool, states: np.ndarray, targets: np.ndarray, one: np.ndarray,
             picked: np.ndarray, total: np.ndarray) -> None:
    """Fills in the targets' logits and the sums of all outputs."""
    rows = _rows(w)
    for i in range(0, len(targets), rows):
        r = slice(i, i + rows)
        _exp_logits(w, flat, states[r], targets[r], one, picked[r], total[r])


def _softmax_gradients(w: np.ndarray, flat: bool, states: np.ndarray, targets: np.ndarray, one: np.ndarray,
                       picked: np.ndarray, total: np.ndarray, dw: np.ndarray, ds: np.ndarray) -> None:
    """``_softmax`` that also fills in the gradients of the summed loss by the weights with bias
    and, still to be divided by the sums, by the states.  The softmax
    less the target is (x - total at the target) / total; the division is done on the narrow side."""
    rows, wt = _rows(w), np.ascontiguousarray(w[:-1].T)
    for i in range(0, len(targets), rows):
        r = slice(i, i + rows)
        x, at = _exp_logits(w, flat, states[r], targets[r], one, picked[r], total[r])
        x.ravel()[at] -= total[r]
        share = (states[r] / total[r, None]).T
        if i:
            dw += share @ x
        else:
            np.matmul(share, x, out=dw)
        np.matmul(x, wt, out=ds[r])


def _step(gx, h, ut, n):
    """One step of the network; units x documents, as all its arrays."""
    gh = ut @ h
    rz = _sigmoid(gx[:2 * n] + gh[:2 * n])
    cand = rz[:n] * gh[2 * n:]
    cand += gx[2 * n:]
    np.tanh(cand, out=cand)
    new = h - cand
    new *= rz[n:]
    new += cand
    return new, rz, cand, gh


def _small_softmax_gradients(w: np.ndarray, flat: np.ndarray, states: np.ndarray, targets: np.ndarray, first: np.ndarray,
                             many: np.ndarray, one: np.ndarray, picked: np.ndarray, total: np.ndarray, dw: np.ndarray, ds: np.ndarray) -> None:
    """``_softmax_gradients`` of several classes at once: class i has ``many[i]`` tokens from
    ``first[i]`` on, filled up with zero states to as many as the largest."""
    place = np.arange(many.max())
    real = place < many[:, None]
    token = np.where(real, first[:, None] + place, first[:, None])
    s = states.take(token, axis=0)
    s *= real[..., None]
    x = np.matmul(s, w)
    if not flat.all():
        x -= x.max(axis=-1, keepdims=True)
    at = (np.arange(token.size).reshape(token.shape) * len(one) + targets[token])
    here = x.ravel().take(at)
    np.exp(x, out=x)
    sums = np.matmul(x, one)
    x.ravel()[at] -= sums
    s /= sums[..., None]
    dw[:] = np.matmul(s.transpose(0, 2, 1), x)
    back, real = np.matmul(x, w[:, :-1].transpose(0, 2, 1)), np.flatnonzero(real)
    token = token.ravel().take(real)
    picked[token], total[token] = here.ravel().take(real), sums.ravel().take(real)
    ds[token] = back.reshape(-1, back.shape[-1]).take(real, axis=0)


@dataclass
class _Outputs:
    """The factored softmax made ready for scoring."""
    wc: np.ndarray
    wc_flat: bool
    ww: np.ndarray
    ww_flat: np.ndarray

    @classmethod
    def of(cls, p: dict, size: float = 1.0) -> _Outputs:
        return cls(_with_bias(p["wc"], p["bc"]), bool(_flat(p["wc"], size)), _with_bias(p["ww"], p["bw"]), _flat(p["ww"], size))


def _by_class(targets: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the tokens by class; their classes and places in them, so ordered; each class' first."""
    cls = targets // shape.class_size
    order = np.argsort(cls.astype(np.min_scalar_type(shape.classes)), kind="stable")
    sorted_cls = cls[order]
    return order, sorted_cls, targets[order] - sorted_cls * shape.class_size, np.searchsorted(sorted_cls, np.arange(shape.classes + 1))


def _and_one(states: np.ndarray) -> np.ndarray:
    out = np.ones((len(states), states.shape[1] + 1), states.dtype)
    out[:, :-1] = states
    return out


def _token_log_probs(p: dict, shape: Shape, states: np.ndarray, targets: np.ndarray, outputs: _Outputs | None = None) -> np.ndarray:
    """Natural log probability of each target token after its state."""
    o = outputs or _Outputs.of(p, float(np.abs(states).max(initial=0.0)))
    order, cls, inner, edges = _by_class(targets, shape)
    states = _and_one(states.take(order, axis=0))
    picked, total = np.empty((2, len(cls)), states.dtype), np.empty((2, len(cls)), states.dtype)
    _softmax(o.wc, o.wc_flat, states, cls, np.ones(shape.classes, states.dtype), picked[0], total[0])
    one = np.ones(shape.class_size, states.dtype)
    for k in np.flatnonzero(np.diff(edges)):
        r = slice(edges[k], edges[k + 1])
        _softmax(o.ww[k], o.ww_flat[k], states[r], inner[r], one, picked[1, r], total[1, r])
    out = np.empty(len(targets), states.dtype)
    out[order] = (picked - np.log(total)).sum(axis=0)
    return out


def log_likelihoods(p: dict, shape: Shape, tokens: np.ndarray, offs: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Natural log-likelihood of every document tokens[offs[i]:offs[i+1]]."""
    n, length = shape.hidden, np.diff(offs)
    order = np.argsort(-length, kind="stable")
    base, length = offs[:-1][order], length[order]
    outputs, wt, ut, b = _Outputs.of(p), np.ascontiguousarray(p["w"].T), np.ascontiguousarray(p["u"].T), p["b"][:, None]
    total = np.zeros(len(order))
    h = np.zeros((n, len(order)), np.float32)
    last = np.full(len(order), END)
    steps = int(length[0]) if len(length) else 0
    t0 = 0
    while t0 < steps:
        k = int(np.searchsorted(-length, -t0, "left"))
        ahead = np.arange(t0, min(steps, t0 + max(window, _SCORED // k)))  # few documents: a longer window
        longer = np.searchsorted(-length, -ahead, "left")  # documents longer than t
        at = np.concatenate(([0], np.cumsum(longer)))
        states, targets = np.empty((at[-1], n), np.float32), np.empty(at[-1], np.int64)
        for t, k, i, j in zip(ahead, longer, at, at[1:]):
            gx = wt @ p["embed"].take(last[:k], axis=0).T
            gx += b
            h = _step(gx, h[:, :k], ut, n)[0]
            last = tokens[base[:k] + t]
            states[i:j] = h.T
            targets[i:j] = last
        lp = _token_log_probs(p, shape, states, targets, outputs).astype(np.float64)
        for k, i, j in zip(longer, at, at[1:]):
            total[:k] += lp[i:j]
        t0 += len(ahead)
    out = np.empty(len(order))
    out[order] = total
    return out


def gradients(p: dict, shape: Shape, inputs: np.ndarray, targets: np.ndarray, h0: np.ndarray):
    """Truncated back-propagation through one window (steps x streams): the
    gradients of the mean loss, the carried state and the mean loss."""
    sparse, h, loss = window_gradients(p, shape, inputs, targets, h0)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    for k, (at, value) in sparse.items():
        g[k][at] = value
    return g, h, loss


def _output_gradients(p: dict, shape: Shape, states: np.ndarray, targets: np.ndarray, size: float):
    """The softmax's part of ``window_gradients``: gradients of the summed loss by its weights
    and, in the tokens' order, by the states; the touched classes and the summed loss."""
    n = shape.hidden
    order, cls, inner, edges = _by_class(targets, shape)
    states, used = _and_one(states.take(order, axis=0)), np.flatnonzero(np.diff(edges))
    every = len(used) == shape.classes
    ww, bw = (p["ww"], p["bw"]) if every else (p["ww"][used], p["bw"][used])
    w, flat = _with_bias(ww, bw), _flat(ww, size)
    dwc, dw = np.empty((n + 1, shape.classes), states.dtype), np.empty_like(w)
    picked, total, ds = (np.empty((2, len(cls), *more), states.dtype) for more in ((), (), (n,)))
    _softmax_gradients(_with_bias(p["wc"], p["bc"]), bool(_flat(p["wc"], size)), states, cls, np.ones(shape.classes, states.dtype),
                       picked[0], total[0], dwc, ds[0])
    one = np.ones(shape.class_size, states.dtype)
    first, many = edges[used], np.diff(edges)[used]
    small = many <= _FEW
    for i in np.flatnonzero(~small):
        r = slice(first[i], first[i] + many[i])
        _softmax_gradients(w[i], flat[i], states[r], inner[r], one, picked[1, r], total[1, r], dw[i], ds[1, r])
    small = np.flatnonzero(small)
    small = small[np.argsort(many[small], kind="stable")]
    for at in range(0, len(small), _TOGETHER):
        i = small[at:at + _TOGETHER]
        some = np.empty((len(i), *dw.shape[1:]), dw.dtype)
        _small_softmax_gradients(w.take(i, axis=0), flat[i], states, inner, first[i], many[i], one, picked[1], total[1], some, ds[1])
        dw[i] = some
    loss = float(np.log(total).sum() - picked.sum())
    ds /= total[..., None]
    back = np.empty((len(order), n), ds.dtype)
    back[order] = ds[0] + ds[1]
    return dwc, dw, slice(None) if every else used, back, loss


def window_gradients(p: dict, shape: Shape, inputs: np.ndarray, targets: np.ndarray, h0: np.ndarray):
    """``gradients`` as (places, values): only the rows of ``embed`` and the
    classes of ``ww`` and ``bw`` that the window touches; all others are 0."""
    n, (steps, width) = shape.hidden, inputs.shape
    x, ut = p["embed"].take(inputs, axis=0), np.ascontiguousarray(p["u"].T)
    gx = np.matmul(p["w"].T, x.transpose(0, 2, 1))  # steps x units x streams, as all below
    gx += p["b"][:, None]
    start = (inputs != END).astype(gx.dtype)  # a document starts from the zero state
    h, kept = np.ascontiguousarray(h0.T), []
    befores, hs = np.empty((steps, n, width), gx.dtype), np.empty((steps, n, width), gx.dtype)
    for t in range(steps):
        np.multiply(h, start[t], out=befores[t])
        h, rz, cand, gh = _step(gx[t], befores[t], ut, n)
        kept.append((rz, cand, gh))
        hs[t] = h
    dwc, dw, used, ds, loss = _output_gradients(p, shape, hs.transpose(0, 2, 1).reshape(-1, n), targets.ravel(),
                                                float(np.abs(h0).max(initial=0.0)))
    ds = np.ascontiguousarray(ds.reshape(steps, width, n).transpose(0, 2, 1))
    dgx, dgh, dh = np.empty_like(gx), np.empty_like(gx), np.zeros_like(h)
    for t in reversed(range(steps)):
        rz, cand, gh = kept[t]
        r, z, d, g = rz[:n], rz[n:], ds[t], dgx[t]
        d += dh
        slope = rz * (1 - rz)
        dcand = np.subtract(befores[t], cand, out=g[n:2 * n])
        dcand *= d
        dcand *= slope[n:]
        carried = d * z
        dcand = np.subtract(d, carried, out=g[2 * n:])
        cand *= cand
        dcand *= np.subtract(1, cand, out=cand)
        dr = np.multiply(dcand, gh[2 * n:], out=g[:n])
        dr *= slope[:n]
        dgh[t] = g
        dgh[t, 2 * n:] *= r
        carried += p["u"] @ dgh[t]
        dh = np.multiply(carried, start[t], out=carried)
    out = {"w": np.matmul(x.transpose(0, 2, 1), dgx.transpose(0, 2, 1)).sum(axis=0), "b": dgx.sum(axis=(0, 2)),
           "u": np.matmul(befores, dgh.transpose(0, 2, 1)).sum(axis=0), "wc": dwc[:n], "bc": dwc[n]}
    dx = np.matmul(dgx.transpose(0, 2, 1), p["w"].T).reshape(-1, n)
    order = np.argsort(inputs.ravel())
    words = inputs.ravel().take(order)
    first = np.concatenate(([0], np.flatnonzero(words[1:] != words[:-1]) + 1))
    size, every = gx.dtype.type(1 / targets.size), slice(None)
    out = {k: (every, v * size) for k, v in out.items()}
    embed = np.add.reduceat(dx.take(order, axis=0), first, axis=0)
    dw *= size
    return ({**out, "embed": (words[first], embed * size), "ww": (used, dw[:, :n]), "bw": (used, dw[:, n])},
            np.ascontiguousarray(h.T), float(loss) / targets.size)


def _adagrad(p: np.ndarray, acc: np.ndarray, at, value: np.ndarray, rate: float) -> None:
    every = isinstance(at, slice)
    seen, weights = (a[at] if every else a.take(at, axis=0) for a in (acc, p))
    change = value * value
    seen += change
    np.sqrt(seen, out=change)
    np.divide(value, change, out=change)
    change *= np.float32(rate)
    weights -= change
    if not every:
        acc[at], p[at] = seen, weights


def train_stream(p: dict, shape: Shape, tokens: np.ndarray, rate: float = RATE, window: int = WINDOW,
                 streams: int = STREAMS) -> float:
    """AdaGrad over a token stream (documents closed by their end), in place;
    returns the mean loss.  The stream runs as ``streams`` equal ones side by
    side (fewer, if they would take less than ``_LEAST_STEPS`` steps); the tokens left over by the division follow as one more, each step
    weighted by its tokens."""
    if not len(tokens):
        return 0.0
    width = int(np.clip(len(tokens) // (_LEAST_STEPS * window), 1, streams))
    even = len(tokens) // width * width
    acc = {k: np.full_like(v, 1e-4) for k, v in p.items()}
    losses, sizes = [], []
    for part, lanes in ((tokens[:even], width), (tokens[even:], 1)):
        y = part.reshape(lanes, -1).T
        x = np.vstack([np.full((1, lanes), END, y.dtype), y[:-1]])
        h = np.zeros((lanes, shape.hidden), np.float32)
        for t in range(0, len(y), window):
            g, h, loss = window_gradients(p, shape, x[t:t + window], y[t:t + window].astype(np.int64), h)
            losses.append(loss)
            sizes.append(y[t:t + window].size)
            weight = np.float32(lanes / width)
            for k, (at, value) in g.items():
                if weight != 1:
                    value = weight * value
                rows = max(1, _PIECE // value[0].size)
                for i in range(0, len(value), rows):
                    _adagrad(p[k], acc[k], slice(i, i + rows) if isinstance(at, slice) else at[i:i + rows], value[i:i + rows], rate)
    return float(np.average(losses, weights=sizes))


# ---------------------------------------------------------------- Spark side

@dataclass
class Counts:
    """What the corpus gathered: totals and the network's vocabulary."""
    tokens: int
    distinct: int
    train_docs: int
    h1: np.ndarray      # vocabulary hashes, ascending
    h2: np.ndarray
    number: np.ndarray  # their token numbers
    known: np.ndarray   # count by token number (end, unknown, words)
    unknown_distinct: int

    def token_numbers(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if not len(self.h1):
            return np.full(len(h1), UNKNOWN, np.int64)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        return np.where((self.h1[at] == h1) & (self.h2[at] == h2), self.number[at], UNKNOWN)


def _shard_totals(min_count: int):
    """Per shard: training tokens (-1), distinct words (-2), frequent ones (-3) and the histogram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            distinct, tokens = struct.unpack_from("<QQ", row["answer"])
            n = c.unpack(row["answer"][16:])[2]
            step, many = np.unique(_step_of(n[n > 0]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(([-1, -2, -3], step)), pa.int64()),
                 pa.array(np.concatenate(([tokens, distinct, (n >= min_count).sum()], many)), pa.int64())], names=["step", "n"])
    return run


def _shard_top(least: int):
    """A shard's words from a step of the histogram on; hashes as signed numbers of the same order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in c.rows_of(batches):
            h1, h2, n = c.unpack(row["answer"][16:])
            h1, h2, n = (x[n > 0] for x in (h1, h2, n))
            keep = _step_of(n) >= least
            yield pa.RecordBatch.from_arrays(
                [*(pa.array((x[keep] ^ _SIGN).view(np.int64)) for x in (h1, h2)), pa.array(n[keep].astype(np.int64))],
                names=["h1", "h2", "n"])
    return run


def _gather(counted: DataFrame, train_docs: int, vocabulary: int | None, min_count: int) -> Counts:
    shards = counted.where("chunk = -1").select("answer")
    sums = {r["step"]: r["n"] for r in shards.mapInArrow(_shard_totals(min_count), "step long, n long")
            .groupBy("step").agg(F.sum("n").alias("n")).collect()}  # one row a step, 1,027 at most
    words, distinct, frequent = (sums.pop(k, 0) for k in (-1, -2, -3))
    size = vocabulary if vocabulary is not None else vocabulary_size(frequent, words)
    least, above = 0, 0
    for step in sorted(sums, reverse=True):
        least, above = step, above + sums[step]
        if above >= size:
            break
    top = shards.mapInArrow(_shard_top(least), "h1 long, h2 long, n long") \
        .orderBy(F.desc("n"), "h1", "h2").limit(size).toArrow()  # the vocabulary
    h1, h2 = (top[k].to_numpy().astype(np.int64).view(np.uint64) ^ _SIGN for k in ("h1", "h2"))
    n = top["n"].to_numpy().astype(np.int64)
    place = np.lexsort((h2, h1, -n))
    h1, h2, n = h1[place], h2[place], n[place]
    order = np.argsort(h1, kind="stable")
    known = np.array([train_docs, words - int(n.sum()), *n], np.float64)
    return Counts(words + train_docs, distinct + (train_docs > 0), train_docs, h1[order], h2[order],
                  np.arange(len(n))[order] + 2, known, distinct - len(n))


def _with_ends(numbers: np.ndarray, per: np.ndarray) -> np.ndarray:
    """Token numbers of documents of ``per`` words, each closed by its end."""
    out = np.empty(len(numbers) + len(per), np.int32)
    word = np.ones(len(out), bool)
    word[np.cumsum(per + 1) - 1] = False
    out[~word] = END
    out[word] = numbers
    return out


def _stream_tokens(batch: pa.RecordBatch, counts: Counts) -> np.ndarray:
    data, offs = c.text_buffers(batch.column(1))
    out, i = [], 0
    while i < batch.num_rows:  # some megabytes at a time, or a longer document
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + c.CHUNK_BYTES, "right")) - 1)
        words = _Words(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        out.append(_with_ends(counts.token_numbers(words.h1, words.h2)[words.which], np.bincount(words.doc, minlength=j - i)))
        i = j
    return np.concatenate(out) if out else np.zeros(0, np.int32)


REPLICA_SCHEMA = "block int, slot int, value binary, tokens double"
_REPLICA = (pa.int32(), pa.int32(), pa.binary(), pa.float64())


def _replica(shape: Shape, start, counts, rate: float, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        p, seen, held, size = {k: v.copy() for k, v in unflatten(start.value, shape).items()}, 0, [], 0
        for b in batches:
            held.append(_stream_tokens(b, counts.value))
            size += len(held[-1])
            if size >= _GROUP_TOKENS:
                train_stream(p, shape, np.concatenate(held), rate, window)
                seen, held, size = seen + size, [], 0
        if size:
            train_stream(p, shape, np.concatenate(held), rate, window)
            seen += size
        if seen:
            flat, slot = flatten(p, shape), TaskContext.get().partitionId()
            for k, at in enumerate(range(0, len(flat), _BLOCK)):
                yield c.batch(dict(zip(("block", "slot", "value", "tokens"), _REPLICA)), block=[k], slot=[slot],
                              value=[flat[at:at + _BLOCK].tobytes()], tokens=[float(seen)])
    return run


def _mean_block(group: pa.Table) -> pa.Table:
    """Mean of some replicas' weights of one block, by tokens."""
    group = group.sort_by("order")
    total, tokens = 0.0, group["tokens"].to_pylist()
    for value, n in zip(group["value"], tokens):
        total = total + np.frombuffer(value.as_py(), np.float32) * np.float64(n)
    mean = (total / sum(tokens)).astype(np.float32)
    return pa.table({"block": group["block"][:1], "slot": group["slot"][:1],
                     "value": pa.array([mean.tobytes()], pa.binary()), "tokens": pa.array([sum(tokens)], pa.float64())})


def averaged(replicas: DataFrame, fan_in: int = _FAN_IN) -> list[bytes]:
    """The replicas' mean weights by tokens, block by block; ``slot`` numbers the replicas."""
    slots = (replicas.agg(F.max("slot")).first()[0] or 0) + 1
    while True:
        slots = -(-slots // fan_in)
        replicas = replicas.withColumn("order", F.col("slot")).withColumn("slot", F.floor(F.col("slot") / fan_in).cast("int")) \
            .groupBy("block", "slot").applyInArrow(_mean_block, REPLICA_SCHEMA)
        if slots == 1:
            return [bytes(r["value"]) for r in replicas.select("block", "value").orderBy("block").collect()]  # one row a block


def train(docs: DataFrame, counts: Counts, shape: Shape, folds: int, fold: int, rounds: int = ROUNDS,
          rate: float = RATE, window: int = WINDOW) -> np.ndarray:
    """Averaged network weights after ``rounds`` rounds of replicas, which share
    out all training documents."""
    sc = docs.sparkSession.sparkContext
    flat = flatten(start_values(shape, counts.known), shape)
    learn = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != fold)
    turn = F.pmod(F.xxhash64(F.lit("gru"), "doc_id"), F.lit(rounds))
    shared = sc.broadcast(counts)
    for k in range(rounds):
        part = docs.where(learn & (turn == k))
        replicas = part.mapInArrow(_replica(shape, sc.broadcast(flat), shared, rate, window), REPLICA_SCHEMA)
        blocks = averaged(c.staged(replicas, "lm-replicas"))
        if blocks:
            flat = np.frombuffer(b"".join(blocks), np.float32)
    return flat


def _score(counts_b, weights_b, shape: Shape, folds: int, fold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counts = counts_b.value
        p = unflatten(weights_b.value, shape)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            tokens = np.concatenate([h["tokens"] for h in held])
            n = np.concatenate([h["n"] for h in held])
            score = log_likelihoods(p, shape, tokens, np.concatenate(([0], np.cumsum(n)))) / np.log(10)
            score += np.concatenate([h["rest"] for h in held])
            ids = pa.concat_arrays([h["ids"] for h in held])
            out = pa.RecordBatch.from_arrays(
                [ids, pa.array([held_out(i, folds, fold) for i in ids.to_pylist()], pa.bool_()), pa.array(n),
                 pa.array(np.concatenate([h["known"] for h in held])), pa.array(np.full(len(n), counts.tokens, np.int64)),
                 pa.array(np.concatenate([h["base"] for h in held])), pa.array(score)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
            held, size = [], 0
            return out

        for row in c.rows_of(batches):
            chunk = c.Chunk(row["body"])
            words = _Words(chunk.data, chunk.offs)
            parts = sorted((struct.unpack_from("<i", a)[0], a) for a in row["answers"] or [])
            seen = np.concatenate([c.unpack(a[4:])[0] for _, a in parts]).astype(np.float64) if parts else np.zeros(0)
            number = counts.token_numbers(words.h1, words.h2)
            base = np.log10((seen + 1) / (counts.tokens + (counts.distinct + 1)))
            end = np.log10((counts.train_docs + 1) / (counts.tokens + (counts.distinct + 1)))
            # an unknown word's share of the unknown token
            rest = np.where(number == UNKNOWN, np.log10((seen + 1) / (counts.known[UNKNOWN] + counts.unknown_distinct + 1)), 0.0)

            def per_doc(values, doc=words.doc, which=words.which, size=chunk.n):
                return np.bincount(doc, values[which].astype(np.float64), minlength=size)
            per = np.bincount(words.doc, minlength=chunk.n)
            held.append({"tokens": _with_ends(number[words.which], per), "n": per + 1,
                         "known": per_doc(seen > 0).astype(np.int64) + int(counts.train_docs > 0),
                         "base": per_doc(base) + end, "rest": per_doc(rest), "ids": chunk.id_array()})
            size += len(held[-1]["tokens"])
            if size >= _GROUP_TOKENS:
                yield flush()
        if held:
            yield flush()
    return run


def score(docs: DataFrame, folds: int = 7, fold: int = 2, vocabulary: int | None = None, hidden: int = HIDDEN,
          class_size: int | None = None, rounds: int = ROUNDS, min_count: int = MIN_COUNT,
          chunk_bytes: int = c.CHUNK_BYTES, parts: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row."""
    sc = docs.sparkSession.sparkContext
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = parts or c.parts_for(c.total_bytes(docs))
    chunks = c.chunked(cols, parts, chunk_bytes)
    counted = c.staged(
        chunks.mapInArrow(_send_words(parts, lambda i: not held_out(i, folds, fold)), c.SHARD_SCHEMA)
        .groupBy("shard").applyInArrow(_count_shard(vocabulary, min_count), c.ANSWER_SCHEMA), "lm-counts")
    learn = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != fold)
    counts = _gather(counted, cols.where(learn).count(), vocabulary, min_count)
    shape = Shape(len(counts.known), hidden, class_size or math.ceil(math.sqrt(len(counts.known))))
    flat = train(cols, counts, shape, folds, fold, rounds)
    return c.answered(chunks, counted.where("chunk >= 0")).mapInArrow(
        _score(sc.broadcast(counts), sc.broadcast(flat), shape, folds, fold),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

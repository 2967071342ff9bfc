"""Secret scan by grammar inference.

1. ``matches`` reads every text once.  The base patterns (below) give labelled
   credentials; every other run of ``MIN_CHARS`` or more characters
   ``[A-Za-z0-9+/_=-]`` that meets no base span is a candidate.
2. ``learn`` infers one probabilistic automaton for each kind of credential, and
   one for candidates, from a sample of distinct values: a prefix tree whose
   states are merged where Hoeffding's bound tells neither their next symbols
   nor those of their successors apart.  The sample is bounded and documented:
   ``FIT_VALUES`` values of up to ``FIT_CHARS`` characters a kind, the ones
   with the smallest hashes, so reruns learn the same automata.
3. ``scan`` scores all candidates: the log10 likelihood of the likeliest kind's
   format less that of ordinary candidates.  Those that a format makes ``ODDS``
   powers of ten likelier are added as spans of kind ``grammar``.

Base patterns, leftmost and non-overlapping per kind, matches that fail their
length are dropped; a span is the whole match in code points, end exclusive:
assign ``(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)``,
ASCII letters of the name in either case, second group of 6 or more; access
``AKIA[A-Z0-9]+`` of 20 or more; hex ``[0-9a-f]+`` of 24 or more.

Edge cases: NULL or empty text has no span; rows with a NULL or repeated doc_id
keep their row; a kind with fewer than ``LEAST_VALUES`` distinct values gets no
automaton, and without any kind nothing is added; empty input gives empty
output.  Nothing but the bounded sample and its automata reaches the driver.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as c

KINDS = ("assign", "access", "hex", "grammar")
MIN_CHARS = 12
FIT_VALUES = 3000
FIT_CHARS = 256
LEAST_VALUES = 20
ALPHA = 1e-3
ODDS = 4.0
SMOOTH = 0.05

_NAME = "password|passwd|secret|token|api_?key"
_EITHER = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", _NAME)
_VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = re.compile(rf"""({_EITHER})["']?\x20*[:=]\x20*["']?({_VALUE}+)""")
_ASSIGN_HINT = rf"""({_EITHER})["']?\x20*[:=]\x20*["']?{_VALUE}"""
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_N = len(_SYMBOLS)
_CODE = np.full(256, _N - 1, np.int64)
_CODE[np.frombuffer(_SYMBOLS.encode(), np.uint8)] = np.arange(_N)
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[np.frombuffer(_SYMBOLS[:-1].encode(), np.uint8)] = False
_PIECE_BYTES = 4 << 20

MATCH_SCHEMA = ("doc_id long, base array<struct<kind:int,start:long,past:long,value:string>>, "
                "candidates array<struct<start:long,past:long,value:string>>")
_BASE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("past", pa.int64()), ("value", pa.string())]))
_CANDIDATES = pa.list_(pa.struct([("start", pa.int64()), ("past", pa.int64()), ("value", pa.string())]))


# ---------------------------------------------------------------- matches

def _piece(text: pa.Array, min_chars: int) -> tuple[list[list[dict]], list[list[dict]]]:
    """Base matches and candidates of every text of an array."""
    data, offs = c.text_buffers(text)
    base: list[list[dict]] = [[] for _ in range(len(text))]
    found: list[list[dict]] = [[] for _ in range(len(text))]
    hint = pc.fill_null(pc.match_substring_regex(text, _ASSIGN_HINT), False)
    for i in np.flatnonzero(hint.to_numpy(zero_copy_only=False)).tolist():
        for m in ASSIGN.finditer(text[i].as_py()):
            if len(m[2]) >= 6:
                base[i].append({"kind": 0, "start": m.start(), "past": m.end(), "value": m[2]})
    starts, ends, doc = c.word_spans(data, offs, _OUTSIDE)
    long = ends - starts >= min_chars
    starts, ends, doc = starts[long], ends[long], doc[long]
    inner = np.concatenate(([0], np.cumsum((data & 0xC0) == 0x80, dtype=np.int64)))  # bytes that start no code point
    point = (starts - inner[starts]) - (offs[doc] - inner[offs[doc]])
    raw = data.tobytes()
    runs = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    for run, i, at in zip(runs, doc.tolist(), point.tolist()):
        for kind, pattern in ((1, ACCESS), (2, HEX)):
            for m in pattern.finditer(run):
                base[i].append({"kind": kind, "start": at + m.start(), "past": at + m.end(), "value": m[0].decode()})
    base = [sorted(b, key=lambda x: (x["start"], x["kind"])) for b in base]
    taken = {i: ([m["start"] for m in b], list(accumulate((m["past"] for m in b), max))) for i, b in enumerate(base) if b}
    for run, i, at in zip(runs, doc.tolist(), point.tolist()):
        if i in taken:
            k = bisect_left(taken[i][0], at + len(run))
            if k and taken[i][1][k - 1] > at:  # meets a base span
                continue
        found[i].append({"start": at, "past": at + len(run), "value": run.decode()})
    return base, found


def _pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))
    i = 0
    while i < b.num_rows:
        j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + _PIECE_BYTES, "right")))
        yield b.slice(i, j - i)
        i = j


def matches(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, base, candidates), one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in _pieces(b):
                base, found = _piece(pc.fill_null(p.column(1), "").cast(pa.large_string()), min_chars)
                yield pa.RecordBatch.from_arrays([p.column(0), pa.array(base, _BASE), pa.array(found, _CANDIDATES)],
                                                 names=["doc_id", "base", "candidates"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, MATCH_SCHEMA)


# ---------------------------------------------------------------- inference

class _State:
    __slots__ = ("n", "end", "next", "count")

    def __init__(self):
        self.n, self.end = 0, 0
        self.next: dict[int, _State] = {}
        self.count: dict[int, int] = {}


def prefix_tree(values: list[bytes]) -> _State:
    root = _State()
    for value in values:
        s = root
        s.n += 1
        for a in _CODE[np.frombuffer(value, np.uint8)].tolist():
            s.count[a] = s.count.get(a, 0) + 1
            s = s.next.setdefault(a, _State())
            s.n += 1
        s.end += 1
    return root


def _differ(x: _State, y: _State, spread: float) -> bool:
    """Whether some next symbol, or the end, is more frequent in one state than chance allows."""
    bound = spread * (x.n ** -0.5 + y.n ** -0.5)
    if bound >= 1:
        return False
    if abs(x.end / x.n - y.end / y.n) > bound:
        return True
    return any(abs(x.count.get(a, 0) / x.n - y.count.get(a, 0) / y.n) > bound for a in x.count.keys() | y.count.keys())


def _compatible(x: _State, y: _State, spread: float) -> bool:
    todo = [(x, y)]
    while todo:
        x, y = todo.pop()
        if _differ(x, y, spread):
            return False
        if spread * (x.n ** -0.5 + y.n ** -0.5) < 1:
            todo += [(x.next[a], y.next[a]) for a in x.next.keys() & y.next.keys() if x.next[a] is not y.next[a]]
    return True


def _fold(into: _State, tree: _State) -> set[int]:
    """Adds a prefix (sub)tree to a state and its successors; returns the ids of the states it changed."""
    changed, todo = set(), [(into, tree)]
    while todo:
        x, y = todo.pop()
        changed.add(id(x))
        x.n += y.n
        x.end += y.end
        for a, k in y.count.items():
            x.count[a] = x.count.get(a, 0) + k
            if a in x.next:
                todo.append((x.next[a], y.next[a]))
            else:
                x.next[a] = y.next[a]
    return changed


class Automaton:
    """Probabilistic automaton: next state and log10 probability per state and
    symbol, and log10 probability to end.  A symbol a state has not seen takes
    the smoothing share and leads back to the start."""

    def __init__(self, step: np.ndarray, logp: np.ndarray, end: np.ndarray):
        self.step, self.logp, self.end = step, logp, end

    @classmethod
    def infer(cls, values: list[bytes], alpha: float = ALPHA) -> Automaton:
        """States of the prefix tree are visited by falling count; each is merged
        into the compatible kept state that gives its next symbols the largest
        likelihood, or kept."""
        spread = (0.5 * np.log(2 / alpha)) ** 0.5
        root = prefix_tree(sorted(values))
        kept = [root]
        place = {id(root): 0}
        counts = np.zeros((64, _N + 1))

        def fill(k: int) -> None:
            counts[k] = 0
            counts[k, list(kept[k].count)] = list(kept[k].count.values())
            counts[k, _N] = kept[k].end
        fill(0)
        while True:
            edge = max(((s.next[a].n, -k, -a) for k, s in enumerate(kept) for a in s.next if id(s.next[a]) not in place),
                       default=None)
            if edge is None:
                break
            parent, symbol = kept[-edge[1]], -edge[2]
            state = parent.next[symbol]
            own = np.zeros(_N + 1)
            own[list(state.count)] = list(state.count.values())
            own[_N] = state.end
            seen = counts[:len(kept)]
            likely = np.log((seen + SMOOTH) / (seen.sum(axis=1, keepdims=True) + SMOOTH * (_N + 1))) @ own
            for k in np.argsort(-likely, kind="stable").tolist():
                if _compatible(kept[k], state, spread):
                    parent.next[symbol] = kept[k]
                    for touched in _fold(kept[k], state):
                        if touched in place:
                            fill(place[touched])
                    break
            else:
                place[id(state)] = len(kept)
                kept.append(state)
                if len(kept) > len(counts):
                    counts = np.vstack([counts, np.zeros_like(counts)])
                fill(len(kept) - 1)
        total = counts[:len(kept)].sum(axis=1, keepdims=True)
        logp = np.log10((counts[:len(kept)] + SMOOTH) / (total + SMOOTH * (_N + 1)))
        step = np.zeros((len(kept), _N), np.int64)
        for k, s in enumerate(kept):
            for a, to in s.next.items():
                step[k, a] = place[id(to)]
        return cls(step, logp[:, :_N].copy(), logp[:, _N].copy())

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log10 probability of each value."""
        size, symbols = np.diff(offs), _CODE[data]
        order = np.argsort(-size, kind="stable")
        state, out = np.zeros(len(size), np.int64), np.zeros(len(size))
        left = size[order]
        for at in range(int(size.max(initial=0))):
            active = int(np.searchsorted(-left, -at, "left"))  # values longer than ``at``
            if active <= 2:  # the rest of a very long value goes symbol by symbol
                break
            who = order[:active]
            a = symbols[offs[who] + at]
            out[who] += self.logp[state[who], a]
            state[who] = self.step[state[who], a]
        else:
            return out + self.end[state]
        step, logp = self.step.tolist(), self.logp.tolist()
        for k in order[:active].tolist():
            s, total = int(state[k]), float(out[k])
            for a in symbols[offs[k] + at:offs[k + 1]].tolist():
                total += logp[s][a]
                s = step[s][a]
            state[k], out[k] = s, total
        return out + self.end[state]


class Formats:
    """Automata of the credential kinds and of ordinary candidates."""

    def __init__(self, kinds: dict[int, Automaton], ordinary: Automaton | None):
        self.kinds, self.ordinary = kinds, ordinary

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log10 likelihood of the likeliest kind less that of ordinary candidates."""
        if not self.kinds:
            return np.full(len(offs) - 1, -np.inf)
        best = np.max([a.score(data, offs) for a in self.kinds.values()], axis=0)
        usual = self.ordinary.score(data, offs) if self.ordinary else np.log10(1 / (_N + 1)) * (np.diff(offs) + 1)
        return best - usual


def _buffers(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(values), np.uint8), np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int64)


def formats_of(labelled: dict[int, list[bytes]], ordinary: list[bytes], least: int = LEAST_VALUES) -> Formats:
    """Automata from distinct values by kind and distinct ordinary candidates."""
    kinds = {k: Automaton.infer(v) for k, v in sorted(labelled.items()) if len(v) >= least}
    return Formats(kinds, Automaton.infer(ordinary) if ordinary else None)


def learn(found: DataFrame, fit_values: int = FIT_VALUES, fit_chars: int = FIT_CHARS) -> Formats:
    """Automata from a bounded sample of the rows of ``matches``."""
    ordinary = F.lit(len(KINDS) - 1)
    values = found.select(F.explode("base").alias("m")).select("m.kind", "m.value").unionByName(
        found.select(F.explode("candidates").alias("m")).select(ordinary.alias("kind"), "m.value")) \
        .where(F.length("value") <= fit_chars).distinct()
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    rows = values.withColumn("place", F.row_number().over(order)).where(F.col("place") <= fit_values) \
        .select("kind", "value").collect()  # at most fit_values rows a kind
    by_kind: dict[int, list[bytes]] = {}
    for kind, value in rows:
        by_kind.setdefault(kind, []).append(value.encode())
    return formats_of({k: v for k, v in by_kind.items() if k < len(KINDS) - 1}, by_kind.get(len(KINDS) - 1, []))


# ---------------------------------------------------------------- scan

def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def add_spans(found: DataFrame, formats: Formats, odds: float = ODDS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_grammar, base_sha256, spans, score):
    ``score`` is the largest of the document's candidates, NULL without one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, candidates = b.column(1).to_pylist(), b.column(2)
            flat = candidates.flatten()
            score = formats.score(*c.text_buffers(flat.field("value"))) if len(flat) else np.zeros(0)
            cut = np.concatenate(([0], np.cumsum(candidates.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            start, past = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("start", "past"))
            counts, digests, spans, best = [], [], [], []
            for i, own in enumerate(base):
                kept = [(m["start"], m["kind"], m["past"]) for m in own]
                s = score[cut[i]:cut[i + 1]]
                new = cut[i] + np.flatnonzero(s > odds)
                every = sorted(kept + [(int(start[k]), 3, int(past[k])) for k in new])
                counts.append(np.bincount([k for _, k, _ in every], minlength=4) if every else np.zeros(4, np.int64))
                digests.append(hashlib.sha256(_named(kept).encode()).hexdigest())
                spans.append(_named(every))
                best.append(float(s.max()) if len(s) and np.isfinite(s).any() else None)
            n = np.array(counts, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(n[:, k], pa.int64()) for k in range(4)), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(best, pa.float64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "score"])
    return found.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_grammar long, "
                                 "base_sha256 string, spans string, score double")


def scan(docs: DataFrame, min_chars: int = MIN_CHARS, fit_values: int = FIT_VALUES, fit_chars: int = FIT_CHARS) -> DataFrame:
    """All spans of every text, one row per input row (see ``add_spans``)."""
    found = c.staged(matches(docs, min_chars), "secret-matches")
    return add_spans(found, learn(found, fit_values, fit_chars))

"""Hard-negative mining by cover trees over norm-augmented vectors.

Components become ``floor(scale * x)``; a row's score for an anchor is their
integer inner product.  Each shard of the candidates holds a cover tree: a
vector x of norm |x| is lifted to (x, sqrt(M^2 - |x|^2)) on the sphere of the
shard's largest norm M, where the inner product with (q, 0) is that with q and
falls with the angle.  A node covers its vectors within a radius that at least
halves from level to level; the angle to its centre plus or minus the covering
angle bounds their inner products from both sides, and so does the covering
radius before lifting.  A best-first descent takes nodes by upper bound, skips
those outside the wanted window of scores or without a wanted label, verifies
leaves exactly, and ends when no bound reaches the last result.

1. positives: the first ``n_positives`` rows of the anchor's label by score;
2. negatives: for each positive the first ``n_negatives`` rows of other labels
   whose score lies between ``low`` and ``high`` percent of the positive's.

Both are merged over shards by a window per anchor.  Of rows with equal
vectors and labels only the smallest ids can be results, so a shard holds that
many of them: a vector that a third of all rows share is a few rows.  Anchors
meet shards in blocks, so a task holds one tree and one block.  Trees have
about ``shard_rows`` vectors, which bounds memory; the rows sent are anchors
times shards, a stated query set against all rows.

Edge cases: rows with a NULL id, label or vector, or a NULL, non-finite or huge
component (2^18 or more in size, whose products may pass a long) take no part;
equal rows count once; different rows that share an id are all candidates, and
as anchors they get results of their own, told apart by ``anchor_copy`` (0, 1,
.. by label and vector); a shorter vector is padded with zeros; an anchor
without positives or negatives has no rows; empty input gives empty output.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import common as c

N_POSITIVES, N_NEGATIVES = 5, 10
LOW, HIGH = 30, 90          # percent of the positive's score
SCALE = 256
LEAF = 32
BLOCK = 8192                # anchors that meet a tree at once
LARGEST = float(1 << 18)
_SLACK = 1e-7


# ---------------------------------------------------------------- cover tree

class CoverTree:
    """Arrays: per node its centre, first child and number of children, range
    of ``order`` (leaves), covering angle and radius, labels; per row vector, label, id."""

    FIELDS = ("vectors", "labels", "ids", "order", "centre", "child", "children", "start", "past", "angle", "radius",
              "only", "mask")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.x = self.vectors.astype(np.float64)
        self.norm = float(np.sqrt((self.x ** 2).sum(axis=1).max(initial=0)))
        self.centres = self.x[self.centre]
        self.single = (self.children == 0) & (self.past - self.start == 1)

    @classmethod
    def build(cls, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> CoverTree:
        x = vectors.astype(np.float64)
        norms = (x ** 2).sum(axis=1)
        top = norms.max(initial=0.0)
        lifted = np.hstack([x, np.sqrt(np.maximum(top - norms, 0))[:, None]])
        far = max(float(np.sqrt(top)), 1e-300)
        nodes: list[list] = []
        order: list[np.ndarray] = []
        done = 0

        def node(centre: int, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
            if len(members) == 1:
                gap, angle, plain = np.zeros(1), 0.0, 0.0
            else:
                gap = np.sqrt(((lifted[members] - lifted[centre]) ** 2).sum(axis=1))
                plain = np.sqrt(((x[members] - x[centre]) ** 2).sum(axis=1)).max()
                angle = 2 * np.arcsin(min(1.0, gap.max() / (2 * far)))
            own = labels[members]
            bits = np.bitwise_or.reduce(np.uint64(1) << (own % 64).astype(np.uint64))
            only = own[0] if (own == own[0]).all() else np.iinfo(np.int64).min
            nodes.append([centre, -1, 0, 0, 0, angle, plain, only, bits])
            return members, gap, len(nodes) - 1

        level = [node(0, np.arange(len(ids)))] if len(ids) else []
        while level:
            below = []
            for members, gap, k in level:
                radius = gap.max()
                if len(members) <= leaf or radius == 0:
                    nodes[k][3:5] = done, done + len(members)
                    order.append(members)
                    done += len(members)
                    continue
                nodes[k][1] = len(nodes)
                rest, left = members, np.ones(len(members), bool)
                points, at = lifted[members], int(np.flatnonzero(members == nodes[k][0])[0])
                while True:  # centres of a level are more than half its radius apart
                    near = (2 * top - 2 * (points @ points[at]) <= (radius / 2) ** 2) & left
                    near[at] = True
                    below.append(node(int(rest[at]), rest[near]))
                    nodes[k][2] += 1
                    left &= ~near
                    n = int(left.sum())
                    if not n:
                        break
                    if n < 0.7 * len(left):
                        rest, points, gap, left = rest[left], points[left], gap[left], np.ones(n, bool)
                    at = int(np.argmax(np.where(left, gap, -1)))
            level = below
        cols = list(zip(*nodes)) if nodes else [()] * 9
        kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, np.float64, np.float64, np.int64, np.uint64)
        centre, child, children, start, past, angle, radius, only, mask = (np.array(v, t) for v, t in zip(cols, kinds))
        return cls(vectors=vectors, labels=labels, ids=ids, order=np.concatenate(order) if order else np.zeros(0, np.int64),
                   centre=centre, child=child, children=children, start=start, past=past, angle=angle, radius=radius,
                   only=only, mask=mask)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{n: getattr(self, n) for n in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CoverTree:
        with np.load(io.BytesIO(raw)) as f:
            return cls(**{n: f[n] for n in cls.FIELDS})

    def _exact(self, rows: np.ndarray, q: np.ndarray, norm: float) -> np.ndarray:
        if norm * self.norm < 2.0 ** 52:  # every partial sum is an integer that a double holds
            return (self.x[rows] @ q).astype(np.int64)
        return (self.vectors[rows].astype(np.int64) * q.astype(np.int64)).sum(axis=1)

    def _bounds(self, nodes: np.ndarray, dot: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that the nodes' vectors can have, by that of their centres."""
        reach = norm * self.norm
        turn = np.arccos(np.clip(dot / reach, -1, 1)) if reach else np.zeros(len(nodes))
        upper = np.minimum(reach * np.cos(np.maximum(turn - self.angle[nodes], 0)), dot + norm * self.radius[nodes])
        lower = np.maximum(reach * np.cos(np.minimum(turn + self.angle[nodes], np.pi)), dot - norm * self.radius[nodes])
        slack = _SLACK * (reach + 1)  # covers the rounding of arccos near 1
        return lower - slack, upper + slack

    def query(self, q: np.ndarray) -> Descent:
        return Descent(self, q)


class Descent:
    """Searches of one anchor's vector in a tree; they share inner products."""

    def __init__(self, tree: CoverTree, q: np.ndarray):
        self.tree, width = tree, tree.x.shape[1]
        self.whole = q.astype(np.float64)
        self.norm = float(np.sqrt((self.whole ** 2).sum()))
        self.q = np.pad(self.whole, (0, max(0, width - len(self.whole))))[:width]
        self.seen: dict[int, tuple] = {}

    def _children(self, n: int, label: int, same: bool) -> tuple:
        """Scores and rows of the wanted single-vector children, in result order;
        wanted other children with bounds, by falling upper bound."""
        if (n, label, same) not in self.seen:
            t = self.tree
            nodes = np.arange(t.child[n], t.child[n] + t.children[n]) if n >= 0 else np.arange(min(1, len(t.centre)))
            bit = np.uint64(1) << np.uint64(label % 64)
            nodes = nodes[(t.mask[nodes] & bit) != 0 if same else t.only[nodes] != label]
            single = t.single[nodes]
            rows, nodes = t.centre[nodes[single]], nodes[~single]
            rows = rows[(t.labels[rows] == label) == same]
            score = t._exact(rows, self.q, self.norm)
            first = np.lexsort((t.ids[rows], -score))
            lower, upper = t._bounds(nodes, t.centres[nodes] @ self.q, self.norm)
            order = np.argsort(-upper, kind="stable")
            self.seen[n, label, same] = score[first], rows[first], nodes[order], lower[order], upper[order]
        return self.seen[n, label, same]

    def best(self, k: int, label: int, same: bool, low: int | None = None, high: int | None = None,
             anchor: int | None = None) -> list[tuple[int, int]]:
        """The first ``k`` (score, id) by score, ties to smaller ids, of the rows
        that have the label (or have not), with a score within the window, but
        for the row that is the anchor itself."""
        t = self.tree
        found: list[tuple[int, int]] = []
        queue: list[tuple] = []  # runs of nodes by falling upper bound: (-bound of the next, order, its place, bounds, nodes)

        def verify(score: np.ndarray, rows: np.ndarray) -> None:
            """Rows in result order, from the first in the window on."""
            at = int(np.searchsorted(-score, -high, "left")) if low is not None else 0
            for s, r in zip(score[at:at + k + 1].tolist(), rows[at:at + k + 1].tolist()):
                if low is not None and s < low:
                    break
                if anchor is not None and same and t.ids[r] == anchor and len(self.whole) <= len(self.q) and (t.x[r] == self.q).all():
                    continue
                if len(found) < k:
                    heapq.heappush(found, (s, -int(t.ids[r])))
                elif (s, -int(t.ids[r])) > found[0]:
                    heapq.heapreplace(found, (s, -int(t.ids[r])))
                else:
                    break

        def push(n: int) -> None:
            score, rows, nodes, lower, upper = self._children(n, label, same)
            verify(score, rows)
            if low is not None:
                inside = (upper >= low) & (lower <= high)
                nodes, upper = nodes[inside], np.minimum(upper[inside], high)
            if len(nodes):
                heapq.heappush(queue, (-upper[0], n, 0, upper, nodes))

        push(-1)
        while queue:
            bound, run, at, upper, nodes = heapq.heappop(queue)
            if len(found) == k and -bound < found[0][0]:
                break
            if at + 1 < len(nodes):
                heapq.heappush(queue, (-upper[at + 1], run, at + 1, upper, nodes))
            n = int(nodes[at])
            if t.children[n]:
                push(n)
            else:
                rows = t.order[t.start[n]:t.past[n]]
                rows = rows[(t.labels[rows] == label) == same]
                score = t._exact(rows, self.q, self.norm)
                first = np.lexsort((t.ids[rows], -score))
                verify(score[first], rows[first])
        return [(s, -i) for s, i in sorted(found, reverse=True)]


# ---------------------------------------------------------------- Spark

def _integer_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, q) of the rows that take part, each once."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce((F.abs(x) < LARGEST) & ~F.isnan(x), F.lit(False)))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                F.transform(v, lambda x: F.floor(x * float(scale)).cast("int")).alias("q")).distinct()


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = [np.asarray(r, np.int32) for r in column.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int32)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _build(group: pa.Table) -> pa.Table:
    order = np.lexsort((group["label"].to_numpy(), group["vec_id"].to_numpy()))  # the same tree in every run
    group = group.take(pa.array(order))
    tree = CoverTree.build(_matrix(group["q"]), group["label"].to_numpy(), group["vec_id"].to_numpy())
    return pa.table({"shard": group["shard"].slice(0, 1), "tree": pa.array([tree.to_bytes()], pa.binary())})


_ANCHOR = pa.schema([("anchor_id", pa.int64()), ("anchor_copy", pa.int32())])


def _positives(k: int):
    def run(anchors: pa.Table, tree: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and tree.num_rows:
            t = CoverTree.from_bytes(tree["tree"][0].as_py())
            for a in anchors.to_pylist():
                got = t.query(np.array(a["q"], np.int64)).best(k, a["label"], same=True, anchor=a["anchor_id"])
                out += [(a["anchor_id"], a["anchor_copy"], i, s) for s, i in got]
        cols = list(zip(*out)) if out else [()] * 4
        return pa.table([pa.array(v, t) for v, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                        names=["anchor_id", "anchor_copy", "vec_id", "score"])
    return run


def _negatives(k: int, low: int, high: int):
    def run(anchors: pa.Table, tree: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and tree.num_rows:
            t = CoverTree.from_bytes(tree["tree"][0].as_py())
            for a in anchors.to_pylist():
                descent, cache = t.query(np.array(a["q"], np.int64)), {}
                for p in a["positives"]:
                    s = p["score"]
                    if s not in cache:
                        least, most = -(-low * s // 100), high * s // 100
                        cache[s] = descent.best(k, a["label"], False, least, most) if least <= most else []
                    out += [(a["anchor_id"], a["anchor_copy"], p["place"], p["vec_id"], s, i, n) for n, i in cache[s]]
        cols = list(zip(*out)) if out else [()] * 7
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(v, t) for v, t in zip(cols, kinds)],
                        names=["anchor_id", "anchor_copy", "place", "positive_id", "positive_score", "negative_id",
                               "negative_score"])
    return run


def _met(anchors: DataFrame, trees: DataFrame, shards: int, blocks: int, task, schema: str) -> DataFrame:
    """Every block of anchors with every shard's tree."""
    sent = anchors.withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    dealt = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return sent.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInArrow(task, schema)


def shard_rows_for(n: int) -> int:
    """Vectors of a tree: more for larger tables, so shards grow slower than rows, up to what a task can hold."""
    return int(min(1 << 15, max(1 << 12, 16 * n ** 0.5)))


def mine(vectors: DataFrame, is_anchor, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, low: int = LOW,
         high: int = HIGH, scale: int = SCALE, shard_rows: int | None = None, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank, anchor_copy) for the rows of ``vectors``
    (vec_id, embedding, label) for which the condition ``is_anchor`` holds."""
    rows = c.staged(_integer_rows(vectors, scale), "negatives-rows")
    same = Window.partitionBy("q", "label").orderBy("vec_id")
    kept = c.staged(rows.withColumn("place", F.row_number().over(same))
                    .where(F.col("place") <= max(n_positives + 1, n_negatives)).drop("place"), "negatives-candidates")
    copies = Window.partitionBy("vec_id").orderBy("label", "q")
    anchors = c.staged(rows.where(is_anchor).withColumn("anchor_copy", (F.row_number().over(copies) - 1).cast("int"))
                       .withColumnRenamed("vec_id", "anchor_id"), "negatives-anchors")
    n = kept.count()
    shards = max(1, -(-n // (shard_rows or shard_rows_for(n))))
    blocks = max(1, -(-anchors.count() // block))
    trees = c.staged(kept.withColumn("shard", F.pmod(F.xxhash64("q", "label"), F.lit(shards)).cast("int"))
                     .groupBy("shard").applyInArrow(_build, "shard int, tree binary"), "negatives-trees")
    near = _met(anchors, trees, shards, blocks, _positives(n_positives),
                "anchor_id long, anchor_copy int, vec_id long, score long")
    best = Window.partitionBy("anchor_id", "anchor_copy").orderBy(F.col("score").desc(), "vec_id")
    positives = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n_positives) \
        .groupBy("anchor_id", "anchor_copy").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positives"))
    ready = c.staged(anchors.join(positives, ["anchor_id", "anchor_copy"]), "negatives-positives")
    far = _met(ready, trees, shards, blocks, _negatives(n_negatives, low, high),
               "anchor_id long, anchor_copy int, place int, positive_id long, positive_score long, "
               "negative_id long, negative_score long")
    first = Window.partitionBy("anchor_id", "anchor_copy", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return far.withColumn("rank", F.row_number().over(first).cast("int")).where(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        F.col("place").alias("positive_rank"), "anchor_copy")


#: DuckDB SQL for op12: all scores of all anchors
ORACLE = """
WITH r AS (
  SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) >= 262144)) = 0),
a AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY label, q) - 1 AS anchor_copy FROM r WHERE vec_id % 100 = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.anchor_copy, a.label = r.label AS same, r.vec_id,
         list_inner_product(a.q, r.q)::BIGINT AS score
  FROM a, r WHERE NOT (a.vec_id = r.vec_id AND a.label = r.label AND a.q = r.q)),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id, anchor_copy ORDER BY score DESC, vec_id) AS place
                 FROM s WHERE same) WHERE place <= 5),
n AS (
  SELECT p.anchor_id, p.anchor_copy, p.place, p.vec_id AS positive_id, p.score AS positive_score,
         s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.anchor_copy, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.anchor_copy = p.anchor_copy AND NOT s.same
               AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score,
       place::INTEGER AS positive_rank, anchor_copy::INTEGER AS anchor_copy
FROM n WHERE rank <= 10"""

"""Hard negatives by bounds along a spanning tree of the anchors (operator 11).

Vectors are floored to integers, a score is an integer inner product.

1. Anchors are dealt into trees of at most `TREE` (alike labels together);
   every tree is the minimum spanning tree of its anchors by distance.
2. Trees are broadcast in passes of at most `PASS_BYTES`; in each pass all
   rows are scanned once for positives and once for negatives.
3. A task goes down the trees level by level. With s a row's score (or the
   bounds of it) at the parent, d the length of the edge and |x| the row's
   norm, the child's score lies in s - d|x| .. s + d|x|. Only rows whose
   interval reaches what the anchor still looks for are scored: the best
   positives so far, or a window of one of its positives above the window's
   best negatives so far.
4. The best of every task meet in one distributed top-k.

Bounds are kept in floating point and widened by more than their error;
scores are exact: float32 or float64 products where every partial sum fits
their mantissa, else 64-bit integers.

Defined results: rows with a null id, a null label, a null vector or a null
or non-finite component take no part; components beyond the range of a long
take its ends; of vectors of different length the shorter counts as filled
with zeros; rows that repeat an id and a score count once for an anchor;
different vectors under one id stand for themselves; an anchor without
positives, and a positive without negatives in its window, give no row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstat.llm._store import keep
from wardstat.plans.score import with_ordinal

TREE = 512
PASS_BYTES = 8 << 20
CELLS = 1 << 23          # scores that a task holds at a time
DENSE = 0.2              # above this share of rows to score a whole product is cheaper


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          scale: int = 256) -> DataFrame:
    """(id, label, v): the rows that take part, with integer components."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & ~bad)
            .withColumn("v", F.transform(v, lambda x: F.floor(x * scale))))


def _matrix(v: pa.Array) -> np.ndarray:
    """Rows of a list column, filled up with zeros to the longest."""
    n = np.asarray(v.value_lengths().fill_null(0)).astype(np.int64)
    flat = np.asarray(v.flatten()).astype(np.int64)
    d = int(n.max()) if len(n) else 0
    if (n == d).all():
        return flat.reshape(len(n), d)
    out = np.zeros((len(n), d), np.int64)
    out[np.arange(d) < n[:, None]] = flat
    return out


def _norm(x: np.ndarray) -> np.ndarray:
    """Upper bound of the length of every row."""
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows from row 0: parent (-1 for the root),
    length of the edge to it, level."""
    n = len(x)
    f = x.astype(np.float64)
    parent, level = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    dist, near = np.full(n, np.inf), np.zeros(n, np.int64)
    out = np.zeros(n, bool)
    length = np.zeros(n)
    at = 0
    for _ in range(n - 1):
        out[at] = True
        d = np.sqrt(((f - f[at]) ** 2).sum(axis=1))
        closer = ~out & (d < dist)
        dist[closer], near[closer] = d[closer], at
        at = int(np.argmin(np.where(out, np.inf, dist)))
        parent[at], length[at], level[at] = near[at], dist[at], level[near[at]] + 1
    return parent, length * (1 + 1e-9), level


_TREES = "tree long, n int, dims int, no binary, id binary, label binary, v binary, parent binary, length binary, level binary"


def _plant(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("no")
    x = _matrix(pa.array(pdf["v"].tolist(), pa.list_(pa.int64())))
    parent, length, level = spanning_tree(x)
    col = {k: np.asarray(pdf[k], np.int64).tobytes() for k in ("no", "id", "label")}
    return pd.DataFrame([{"tree": key[0], "n": len(x), "dims": x.shape[1], **col, "v": x.tobytes(), "parent": parent.tobytes(),
                          "length": length.tobytes(), "level": level.tobytes()}])


class Forest:
    """The anchors of one pass."""

    def __init__(self, rows):
        dims = max(r["dims"] for r in rows)
        read = {k: [np.frombuffer(r[k], np.float64 if k == "length" else np.int64) for r in rows]
                for k in ("no", "id", "label", "parent", "length", "level")}
        base = np.cumsum([0] + [r["n"] for r in rows[:-1]])
        self.no, self.id, self.label, self.length, level = (np.concatenate(read[k]) for k in
                                                             ("no", "id", "label", "length", "level"))
        self.parent = np.concatenate([np.where(p >= 0, p + b, -1) for p, b in zip(read["parent"], base)])
        self.v = np.zeros((len(self.no), dims), np.int64)
        for r, b in zip(rows, base):
            self.v[b:b + r["n"], :r["dims"]] = np.frombuffer(r["v"], np.int64).reshape(r["n"], r["dims"])
        self.norm = _norm(self.v)
        self.levels = [np.flatnonzero(level == k) for k in range(int(level.max()) + 1)]


def _exact(a: np.ndarray, x: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in the cheapest type that holds every partial sum."""
    d = min(a.shape[1], x.shape[1])
    t = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    return a[:, :d].astype(t), x[:, :d].astype(t)


def _spread(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Floating-point bounds of exact scores."""
    if s.dtype != np.int64:
        return s, s
    f = s.astype(np.float64)
    return f - np.abs(f) * 1e-12, f + np.abs(f) * 1e-12


def sweep(forest: Forest, x: np.ndarray, wanted):
    """Go down the trees for the rows `x`. wanted(anchors, low, high) says, as
    a mask (anchors x rows), which rows may matter given the bounds; yields
    (anchors, mask, scores) with exact scores wherever the mask is set."""
    norm = _norm(x)
    a, xs = _exact(forest.v, x, float(forest.norm.max(initial=0) * norm.max(initial=0)))
    lo = np.empty((len(a), len(x)))
    hi = np.empty((len(a), len(x)))
    for k, at in enumerate(forest.levels):
        if k == 0:
            s = a[at] @ xs.T
            lo[at], hi[at] = _spread(s)
            yield at, wanted(at, lo[at], hi[at]), s.astype(np.int64)
            continue
        reach = forest.length[at, None] * norm[None, :]
        # float error of the sum: a part in 2^50 of the terms
        reach += (np.abs(hi[forest.parent[at]]) + reach) * 1e-12
        low, high = lo[forest.parent[at]] - reach, hi[forest.parent[at]] + reach
        mask = wanted(at, low, high)
        if mask.mean() > DENSE:
            s = a[at] @ xs.T
            low, high = _spread(s)
            mask = wanted(at, low, high)
        else:
            i, j = np.nonzero(mask)
            s = np.zeros(mask.shape, a.dtype)
            s[i, j] = np.einsum("ij,ij->i", a[at[i]], xs[j])
            low, high = (np.where(mask, new, old) for new, old in zip(_spread(s), (low, high)))
        lo[at], hi[at] = low, high
        yield at, mask, s.astype(np.int64)


class Best:
    """The best `k` different (score, id) of every slot, ties by the smaller id."""

    LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), self.LOW)  # best first
        self.id = np.full((slots, k), self.HIGH)

    @property
    def least(self) -> np.ndarray:
        """The k-th best score of every slot; the smallest number until there are k."""
        return self.score[:, -1]

    def add(self, slots: np.ndarray, score: np.ndarray, mask: np.ndarray, ids: np.ndarray, distinct: bool) -> None:
        """Rows `ids` with a (slots x rows) matrix of scores, where the mask is
        set; `distinct` says that no id repeats."""
        mask = mask & (score >= self.least[slots, None])
        busy = mask.any(axis=1)
        if not busy.any():
            return
        slots, score, mask = slots[busy], score[busy], mask[busy]
        if distinct and score.shape[1] > self.k:
            top = np.partition(np.where(mask, score, self.LOW), -self.k, axis=1)[:, -self.k]
            mask &= score >= top[:, None]
        i, j = np.nonzero(mask)
        at = np.concatenate([i, np.repeat(np.arange(len(slots)), self.k)])
        score = np.concatenate([score[i, j], self.score[slots].ravel()])
        ids = np.concatenate([ids[j], self.id[slots].ravel()])
        order = np.lexsort((ids, ~score, at))
        at, score, ids = at[order], score[order], ids[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        at, score, ids = at[new], score[new], ids[new]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < self.k
        self.score[slots], self.id[slots] = self.LOW, self.HIGH
        self.score[slots[at[top]], rank[top]] = score[top]
        self.id[slots[at[top]], rank[top]] = ids[top]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, k = np.nonzero(self.id != self.HIGH)
        return slot, self.score[slot, k], self.id[slot, k]


def _blocks(batches, anchors: int):
    size = max(1, min(1024, CELLS // max(anchors, 1)))
    for b in batches:
        for i in range(0, b.num_rows, size):
            c = b.slice(i, size)
            ids = np.asarray(c.column("id"))
            yield ids, np.asarray(c.column("label")), _matrix(c.column("v")), len(np.unique(ids)) == len(ids)


def _positives(rows: DataFrame, forest, k: int) -> DataFrame:
    """The best `k` rows of the anchor's label of every task."""
    def run(batches):
        f = forest.value
        best = Best(len(f.no), k)
        for ids, label, x, distinct in _blocks(batches, len(f.no)):
            def wanted(at, low, high):
                same = f.label[at, None] == label[None, :]
                return same & (f.id[at, None] != ids[None, :]) & (high >= best.least[at, None])
            for at, mask, s in sweep(f, x, wanted):
                best.add(at, s, mask, ids, distinct)
        slot, score, ids = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(f.no[slot]), pa.array(ids), pa.array(score)], ["no", "positive_id", "positive_score"])

    return rows.mapInArrow(run, "no long, positive_id long, positive_score long")


def window_of(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest integer n with low*score <= 100*n <= high*score."""
    whole, rest = np.divmod(score, 100)  # the products themselves may not fit
    return low * whole - (-low * rest) // 100, high * whole + high * rest // 100


def _negatives(rows: DataFrame, forest, slots, k: int, low: int, high: int) -> DataFrame:
    """The best `k` rows of other labels in the window of each slot, of every task."""
    def run(batches):
        f = forest.value
        anchor, score = slots.value  # anchor (index in the forest) and score of every positive, by anchor
        if not len(anchor):
            return
        first = np.searchsorted(anchor, np.arange(len(f.no) + 1))
        width = int(np.diff(first).max())
        best = Best(len(anchor), k)
        # slot of the j-th positive of every anchor; len(anchor): none
        slot_of = np.where(first[:-1, None] + np.arange(width) < first[1:, None], first[:-1, None] + np.arange(width), len(anchor))
        end = np.iinfo(np.int64)
        wlo, whi = (np.append(w, x) for w, x in zip(window_of(score, low, high), (end.max, end.min)))
        for ids, label, x, distinct in _blocks(batches, len(f.no)):
            def wanted(at, low, high):
                floor = np.maximum(wlo, np.append(best.least, end.max))[slot_of[at]]
                top = whi[slot_of[at]]
                out = np.zeros(low.shape, bool)
                for j in range(width):
                    out |= (high >= floor[:, j, None]) & (low <= top[:, j, None])
                return out & (f.label[at, None] != label[None, :])
            for at, mask, s in sweep(f, x, wanted):
                for p in range(width):
                    t = slot_of[at, p]
                    real = t < len(anchor)
                    t, sp = t[real], s[real]
                    best.add(t, sp, mask[real] & (sp >= wlo[t, None]) & (sp <= whi[t, None]), ids, distinct)
        slot, score, ids = best.found()
        yield pa.RecordBatch.from_arrays([pa.array(f.no[anchor[slot]]), pa.array(slot), pa.array(ids), pa.array(score)],
                                         ["no", "slot", "negative_id", "negative_score"])

    return rows.mapInArrow(run, "no long, slot long, negative_id long, negative_score long")


def _top(df: DataFrame, by: list[str], score: str, ident: str, k: int) -> DataFrame:
    """The best `k` different (score, id) of each group, of at most `k` from each task."""
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), ident)
    again = F.col(score).eqNullSafe(F.lag(score).over(w)) & F.col(ident).eqNullSafe(F.lag(ident).over(w))
    return (df.withColumn("new", (~again).cast("int"))
            .withColumn("rank", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
            .where((F.col("new") == 1) & (F.col("rank") <= k)).drop("new"))


def plant_trees(spark: SparkSession, anchors: DataFrame, size: int = TREE) -> DataFrame:
    """One row per tree of at most `size` anchors (id, label, v)."""
    placed = keep(spark, anchors.distinct().orderBy("label", "id"), "anchors")
    numbered = keep(spark, with_ordinal(placed, "no"), "numbered")
    return keep(spark, numbered.withColumn("tree", F.floor(F.col("no") / size)).groupBy("tree").applyInPandas(_plant, _TREES), "trees")


def hard_negatives(spark: SparkSession, rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 10,
                   low: int = 30, high: int = 90, tree: int = TREE, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` and `anchors` are (id, label, v) as `clean` gives them; the window
    is low*positive <= 100*negative <= high*positive.
    """
    sc = spark.sparkContext
    rows = keep(spark, rows, "vectors")
    trees = plant_trees(spark, anchors, tree)
    size = trees.agg(F.max(F.length("v") + 48 * F.col("n"))).first()[0] or 1
    step = max(1, int(pass_bytes // size))  # trees of one pass
    n = (trees.agg(F.max("tree")).first()[0] or 0) + 1
    out = None
    for k in range(0, n, step):
        part = trees.where((F.col("tree") >= k) & (F.col("tree") < k + step)).collect()  # at most pass_bytes
        if not part:
            continue
        f = Forest(sorted(part, key=lambda r: r["tree"]))
        forest = sc.broadcast(f)
        got = _top(_positives(rows, forest, n_positives), ["no"], "positive_score", "positive_id", n_positives)
        pos = pd.DataFrame(got.select("no", "positive_id", "positive_score", "rank").collect(),  # n_positives for each anchor of the pass
                           columns=["no", "positive_id", "positive_score", "rank"]).sort_values(["no", "rank"])
        order = np.argsort(f.no)
        anchor = order[np.searchsorted(f.no[order], pos["no"].to_numpy(np.int64))] if len(pos) else np.zeros(0, np.int64)
        by = np.argsort(anchor, kind="stable")
        anchor, pos = anchor[by], pos.iloc[by]
        slots = sc.broadcast((anchor, pos["positive_score"].to_numpy(np.int64)))
        named = spark.createDataFrame(
            pd.DataFrame({"slot": np.arange(len(pos)), "anchor_id": f.id[anchor], "positive_id": pos["positive_id"].to_numpy(np.int64),
                          "positive_score": pos["positive_score"].to_numpy(np.int64)}),
            "slot long, anchor_id long, positive_id long, positive_score long") if len(pos) else None
        if named is None:
            continue
        best = _top(_negatives(rows, forest, slots, n_negatives, low, high), ["no", "slot"], "negative_score", "negative_id", n_negatives)
        one = keep(spark, best.join(F.broadcast(named), "slot")  # as many rows as `slots` has
                   .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
        out = one if out is None else out.unionAll(one)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return out

"""Gradient-boosted trees of second order with native missing values.

Binary log loss. A level of all trees that are being grown -- of one model,
or of many models that differ in parameters and held-out fold -- is one job:

1. The table is packed once into blocks of binned rows (`pack`); a block also
   carries the margin of each of its rows under every model.
2. Every task adds up gradients and hessians by (model, node, feature, bin)
   over its blocks, in fixed point, so that sums do not depend on the order
   or the partitioning of the rows and a fit is reproducible. There is one
   array of sums a node; a level of more nodes than `HELD` allows takes
   several jobs.
3. The histograms meet by (model, group of features), where the best split of
   every node is found: gain with L1 and L2 terms, least hessian of a child,
   and the better side for missing values.
4. One row per node and group reaches the driver, which keeps the trees.

A node is split while it gains more than `EPS` and at least `gamma`. Rows are
drawn for each tree by a hash of their key, columns by a seeded draw. Margins
move on once per tree; their lineage is cut with a checkpoint every `CUT`
trees.

Rows with a null label, weight or key are refused by the arithmetic (they
give null sums); a feature that is null or NaN is missing; a missing value
that a node has not seen in training goes right.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING = np.uint16(0xFFFF)
BLOCK_ROWS = 1 << 16
BLOCK_MARGINS = 1 << 20   # margins of a block
ONE = 1 << 20             # fixed-point unit of gradients and hessians
EPS = 1e-6
CUT = 16                  # trees between checkpoints of the margins
FOLD = 1 << 22            # histogram entries that a reducer holds before it folds them
HELD = 1 << 23            # histogram entries that a task adds up side by side


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0

    @classmethod
    def of(cls, values: dict) -> "BoostParams":
        return cls(**{k: type(getattr(cls, k))(v) for k, v in values.items() if k in cls.__dataclass_fields__})


@dataclass(frozen=True)
class Spec:
    """One model to grow: its parameters, and the fold it does not learn from."""
    params: BoostParams
    holdout: int | None = None
    seed: int = 0


@dataclass
class Tree:
    """Nodes in breadth-first order; a leaf has feature -1 and its value."""
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)   # left: x < threshold
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)


@dataclass
class Booster:
    features: list[str]
    params: BoostParams
    trees: list[Tree] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "params": asdict(self.params), "trees": [asdict(t) for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> "Booster":
        d = json.loads(text)
        return cls(d["features"], BoostParams.of(d["params"]), [Tree(**t) for t in d["trees"]])

    def importances(self) -> list[tuple[str, float]]:
        """Mean gain of a feature's splits, as a share of the sum over features."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
                    count[f] += 1
        mean = total / np.maximum(count, 1)
        return [(n, float(x)) for n, x in zip(self.features, mean / (mean.sum() or 1.0))]


# ---------------------------------------------------------------------------
# Bins and blocks
# ---------------------------------------------------------------------------

def cut_points(df: DataFrame, features: Sequence[str], max_bins: int = 256, accuracy: int = 100_000) -> list[list[float]]:
    """Ascending thresholds of every feature: at most `max_bins` - 1 values
    near its quantiles (one aggregation; a feature with fewer values is cut at
    every one of them)."""
    probs = [i / max_bins for i in range(1, max_bins)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(c), F.col(c)), probs, accuracy).alias(c) for c in features]).first()
    return [sorted(set(row[c] or [])) for c in features]


_STATE = "n int, key binary, label binary, weight binary, fold binary, bins binary, margin binary"


def pack(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], models: int = 1,
         key: str = "key", label: str = "label", weight: str = "weight", fold: str = "fold",
         rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of at most `rows` binned rows with zero margins for `models`
    models; a block's margins take at most 8 * `BLOCK_MARGINS` bytes. A row's
    bin is the number of thresholds at or below its value."""
    rows = max(1, min(rows, BLOCK_MARGINS // max(models, 1)))
    edges = [np.asarray(c, np.float64) for c in cuts]
    cols = [F.col(key).cast("long").alias("key"), F.col(label).cast("double").alias("label"),
            F.col(weight).cast("double").alias("weight"), F.col(fold).cast("int").alias("fold"),
            *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]]

    def sized(batches):
        """The batches, joined and cut to `rows` rows (the last one: fewer)."""
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= rows:
                whole = pa.Table.from_batches(held)
                for i in range(0, n - n % rows, rows):
                    yield whole.slice(i, rows).combine_chunks().to_batches()[0]
                held, n = whole.slice(n - n % rows).to_batches(), n % rows
        if n:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def run(batches):
        for b in sized(batches):
            if b.num_rows:
                bins = np.empty((len(edges), b.num_rows), np.uint16)
                for f, e in enumerate(edges):
                    x = np.asarray(b.column(4 + f).fill_null(float("nan")))
                    bins[f] = np.where(np.isnan(x), MISSING, np.searchsorted(e, x, "right"))
                num = lambda k, t: np.asarray(b.column(k)).astype(t).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.num_rows], pa.int32()), *[pa.array([v], pa.binary()) for v in (
                        num(0, np.int64), num(1, np.float64), num(2, np.float64), num(3, np.int32), bins.tobytes(),
                        bytes(8 * b.num_rows * models))]],
                    ["n", "key", "label", "weight", "fold", "bins", "margin"])

    return df.select(*cols).mapInArrow(run, _STATE)


class _Block:
    """A block as arrays."""

    def __init__(self, batch: pa.RecordBatch, i: int, n_features: int):
        col = {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}
        self.n = col["n"]
        self.key, self.label = np.frombuffer(col["key"], np.int64), np.frombuffer(col["label"], np.float64)
        self.weight, self.fold = np.frombuffer(col["weight"], np.float64), np.frombuffer(col["fold"], np.int32)
        self.bins = np.frombuffer(col["bins"], np.uint16).reshape(n_features, self.n)
        self.margin = np.frombuffer(col["margin"], np.float64).reshape(-1, self.n)
        self.raw = col


def _blocks(batches: Iterable[pa.RecordBatch], n_features: int):
    for b in batches:
        for i in range(b.num_rows):
            yield _Block(b, i, n_features)


# ---------------------------------------------------------------------------
# Growing trees
# ---------------------------------------------------------------------------

class _Growing:
    """A tree being grown: splits by heap number (children of k: 2k+1, 2k+2)."""

    def __init__(self, spec: Spec, model: int, number: int, n_features: int):
        self.spec, self.model, self.number = spec, model, number
        rng = np.random.default_rng((spec.seed, number))
        k = max(1, round(spec.params.colsample_bytree * n_features))
        self.columns = np.sort(rng.choice(n_features, k, replace=False)) if k < n_features else np.arange(n_features)
        self.splits: dict[int, tuple] = {}   # node -> (feature, cut, missing_left, gain, cover)
        self.values: dict[int, tuple] = {}   # leaf -> (value, cover)
        self.active = [0]

    def descend(self, block: _Block) -> np.ndarray:
        """Heap number of the node that every row has reached."""
        node = np.zeros(block.n, np.int64)
        if not self.splits:
            return node
        size = 2 * max(self.splits) + 3
        feature, cut, left = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
        for k, s in self.splits.items():
            feature[k], cut[k], left[k] = s[0], s[1], s[2]
        rows = np.arange(block.n)
        while True:
            f = feature[node]
            go = f >= 0
            if not go.any():
                return node
            x = block.bins[np.maximum(f, 0), rows]
            to_left = np.where(x == MISSING, left[node], x <= cut[node])
            node = np.where(go, 2 * node + 2 - to_left, node)

    def sampled(self, block: _Block) -> np.ndarray:
        keep = np.ones(block.n, bool)
        if self.spec.holdout is not None:
            keep &= block.fold != self.spec.holdout
        if self.spec.params.subsample < 1.0:
            h = _mix(block.key.astype(np.uint64) ^ _mix(np.uint64((self.spec.seed * 1_000_003 + self.number + 1) % 2**63)))
            keep &= (h >> np.uint64(11)).astype(np.float64) / 2.0**53 < self.spec.params.subsample
        return keep

    def leaf_values(self, block: _Block) -> np.ndarray:
        node = self.descend(block)
        value = np.zeros(max(self.values) + 1)
        for k, (v, _) in self.values.items():
            value[k] = v
        return value[node]

    def finished(self, cuts: Sequence[Sequence[float]]) -> Tree:
        t, queue, number = Tree(), [0], {}
        for k in queue:
            number[k] = len(number)
            if k in self.splits:
                queue += [2 * k + 1, 2 * k + 2]
        for k in queue:
            if k in self.splits:
                f, c, left, gain, cover = self.splits[k]
                row = (f, float(cuts[f][c]), bool(left), number[2 * k + 1], number[2 * k + 2], 0.0, gain, cover)
            else:
                row = (-1, 0.0, False, -1, -1, self.values[k][0], 0.0, self.values[k][1])
            for name, v in zip(("feature", "threshold", "missing_left", "left", "right", "value", "gain", "cover"), row):
                getattr(t, name).append(v)
        return t


def _mix(x):
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _shrunk(g, p: BoostParams):
    return np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0.0)


def leaf_weight(g, h, p: BoostParams):
    return -_shrunk(g, p) / (h + p.reg_lambda) if h + p.reg_lambda > 0 else 0.0


def _score(g, h, p: BoostParams):
    d = h + p.reg_lambda
    return np.where(d > 0, _shrunk(g, p) ** 2 / np.where(d > 0, d, 1.0), 0.0)


def best_splits(g: np.ndarray, h: np.ndarray, p: BoostParams) -> tuple[np.ndarray, ...]:
    """Best split of one feature for every node, from (nodes x slots) sums; the
    last slot is of missing values. (gain, cut, missing_left, g_left, h_left)
    with gain -inf where no split is allowed; ties: smaller cut, missing right."""
    total_g, total_h = g.sum(axis=1), h.sum(axis=1)
    left_g, left_h = np.cumsum(g[:, :-2], axis=1), np.cumsum(h[:, :-2], axis=1)  # cut j: bins 0..j
    miss_g, miss_h = g[:, -1:], h[:, -1:]
    parent = _score(total_g, total_h, p)[:, None]
    gl = np.stack([left_g, left_g + miss_g], axis=2).reshape(len(g), -1)
    hl = np.stack([left_h, left_h + miss_h], axis=2).reshape(len(g), -1)
    gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
    gain = _score(gl, hl, p) + _score(gr, hr, p) - parent
    ok = (hl > 0) & (hr > 0) & (hl >= p.min_child_weight) & (hr >= p.min_child_weight)
    gain = np.where(ok, gain, -np.inf)
    if not gain.shape[1]:
        none = np.zeros(len(g), np.int64)
        return np.full(len(g), -np.inf), none, none.astype(bool), none * 0.0, none * 0.0
    at = np.argmax(gain, axis=1)
    i = np.arange(len(g))
    return gain[i, at], at // 2, (at % 2).astype(bool), gl[i, at], hl[i, at]


class _Level:
    """What a task needs to know of one job: `pieces` are active nodes of
    growing trees, as (number of the tree, tree, nodes)."""

    def __init__(self, pieces: list[tuple[int, _Growing, list[int]]], slots: np.ndarray, groups: int):
        self.pieces, self.slots, self.groups = pieces, slots, groups
        self.offset = np.concatenate([[0], np.cumsum(slots)])
        self.group_of = np.arange(len(slots)) % groups

    def histograms(self, blocks):
        """(piece, group, entry, g, h) of one task: entry numbers (node, feature, bin).

        A piece has one array of sums over all blocks of the task, so what a
        task holds and hands on does not grow with its rows."""
        width = int(self.offset[-1])
        held: dict[int, np.ndarray] = {}
        for b in blocks:
            slot = np.where(b.bins == MISSING, (self.slots - 1)[:, None].astype(np.uint16), b.bins)
            reached: dict[int, np.ndarray] = {}
            for i, (k, t, nodes) in enumerate(self.pieces):
                if k not in reached:
                    reached = {k: np.where(t.sampled(b), t.descend(b), -1)}
                place = np.full(2 * max(nodes) + 3, -1, np.int64)  # the last one: no such node
                place[nodes] = np.arange(len(nodes))
                at = place[np.minimum(reached[k], len(place) - 1)]
                rows = np.flatnonzero(at >= 0)
                if not len(rows):
                    continue
                prob = 1.0 / (1.0 + np.exp(-b.margin[t.model, rows]))
                g = np.rint(b.weight[rows] * (prob - b.label[rows]) * ONE)
                h = np.rint(b.weight[rows] * prob * (1.0 - prob) * ONE)
                sums = held.setdefault(i, np.zeros((2, len(nodes), width), np.int64))
                every = len(rows) == b.n
                at = at[rows]
                for f in t.columns.tolist():
                    lo, hi = int(self.offset[f]), int(self.offset[f + 1])
                    entry = at * (hi - lo) + (slot[f] if every else slot[f].take(rows))
                    for into, v in zip(sums, (g, h)):
                        into[:, lo:hi] += np.bincount(entry, v, len(nodes) * (hi - lo)).astype(np.int64).reshape(len(nodes), -1)
        for i in list(held):
            g, h = held.pop(i).reshape(2, -1)
            columns = self.pieces[i][1].columns
            used = np.flatnonzero((g != 0) | (h != 0))
            group = self.group_of[np.searchsorted(self.offset, used % width, "right") - 1]
            for part in np.unique(self.group_of[columns]).tolist():
                mine = used[group == part]
                if not len(mine):  # there are rows, so the nodes have a row, too
                    mine = self.offset[columns[self.group_of[columns] == part][:1]]
                yield i, part, mine, g[mine], h[mine]

    def best(self, i: int, entry: np.ndarray, g: np.ndarray, h: np.ndarray):
        """Best split over the entries' features of every node of piece i."""
        (_, t, active), width = self.pieces[i], int(self.offset[-1])
        p, nodes = t.spec.params, len(active)
        node, rest = entry // width, entry % width
        feature = np.searchsorted(self.offset, rest, "right") - 1
        best = [(-np.inf, -1, 0, False, 0.0, 0.0)] * nodes
        total = np.zeros((nodes, 2))
        for k, f in enumerate(np.unique(feature).tolist()):
            mine = feature == f
            sums = np.zeros((2, nodes, int(self.slots[f])))
            for s, v in zip(sums, (g, h)):
                s[node[mine], rest[mine] - self.offset[f]] = v[mine] / ONE
            if k == 0:
                total = sums.sum(axis=2).T
            gain, cut, left, gl, hl = best_splits(*sums, p)
            for n in np.flatnonzero(gain > [b[0] for b in best]).tolist():
                best[n] = (float(gain[n]), f, int(cut[n]), bool(left[n]), float(gl[n]), float(hl[n]))
        return [(active[n], *best[n], *total[n].tolist()) for n in range(nodes)]


_HIST = "piece int, part int, entry binary, g binary, h binary"
_SPLIT = ("tree int, node long, gain double, feature int, cut int, missing_left boolean, g_left double, h_left double, "
          "g double, h double")


def _fold(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    entry, g, h = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(entry, kind="stable")
    entry, g, h = entry[order], g[order], h[order]
    first = np.flatnonzero(np.r_[True, entry[1:] != entry[:-1]])
    return entry[first], np.add.reduceat(g, first), np.add.reduceat(h, first)


def _jobs(trees: list[_Growing], width: int) -> list[list[tuple[int, _Growing, list[int]]]]:
    """Active nodes of all trees in pieces, and these in jobs whose tasks hold at most `HELD` entries each."""
    most = max(1, HELD // max(width, 1))  # nodes of a job
    jobs, room = [], 0
    for i, t in enumerate(trees):
        at = 0
        while at < len(t.active):
            if not room:
                jobs.append([])
                room = most
            nodes = t.active[at:at + room]
            jobs[-1].append((i, t, nodes))
            at, room = at + len(nodes), room - len(nodes)
    return jobs


def find_splits(state: DataFrame, trees: list[_Growing], slots: np.ndarray, partitions: int) -> list:
    """Best split of every active node, one candidate per group of features."""
    return [r for pieces in _jobs(trees, int(slots.sum())) for r in _find_splits(state, pieces, slots, partitions)]


def _find_splits(state: DataFrame, pieces: list[tuple[int, _Growing, list[int]]], slots: np.ndarray, partitions: int) -> list:
    groups = int(max(1, min(len(slots), -(-partitions // len(pieces)))))
    spark = state.sparkSession
    level = spark.sparkContext.broadcast(_Level(pieces, slots, groups))
    n_features = len(slots)

    def add_up(batches):
        for i, group, *arrays in level.value.histograms(_blocks(batches, n_features)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([group], pa.int32()),
                 *[pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in arrays]],
                ["piece", "part", "entry", "g", "h"])

    def choose(batches):
        held: dict[tuple, list] = {}
        for b in batches:
            for i, part, *raw in zip(*[c.to_pylist() for c in b.columns]):
                parts = held.setdefault((i, part), [])
                parts.append(tuple(np.frombuffer(x, np.int64) for x in raw))
                if len(parts) > 1 and sum(len(x[0]) for x in parts) > FOLD:
                    held[i, part] = [_fold(parts)]
        rows = [(level.value.pieces[i][0], *r) for (i, _), parts in held.items() for r in level.value.best(i, *_fold(parts))]
        if rows:
            types = [pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                             [x.split()[0] for x in _SPLIT.split(", ")])

    hist = state.mapInArrow(add_up, _HIST)
    dealt = hist.repartition(max(1, min(partitions, groups * len(pieces))), "piece", "part")
    got = dealt.mapInArrow(choose, _SPLIT).collect()  # one row per node and group
    level.destroy()
    return got


def root_splits(state: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], params: BoostParams) -> DataFrame:
    """(feature, threshold, missing_left, gain): the best first split of every
    feature that has one, of the rows as `pack` gives them."""
    slots = np.array([len(c) + 2 for c in cuts], np.int64)
    rows = find_splits(state, [_Growing(Spec(params), 0, 0, len(features))], slots, len(features))
    out = [(features[r["feature"]], float(cuts[r["feature"]][r["cut"]]), r["missing_left"], r["gain"])
           for r in rows if r["feature"] >= 0]  # a row a feature
    return state.sparkSession.createDataFrame(out, "feature string, threshold double, missing_left boolean, gain double")


def _grow(state: DataFrame, trees: list[_Growing], slots: np.ndarray, partitions: int) -> None:
    """Grow the trees to their end, level by level."""
    depth = 0
    while any(t.active for t in trees):
        open_trees = [t for t in trees if t.active]
        found: dict[tuple, tuple] = {}
        for r in find_splits(state, open_trees, slots, partitions):
            k = (r["tree"], r["node"])
            rank = (-r["gain"], r["feature"])
            if k not in found or rank < found[k][0]:
                found[k] = (rank, r)
        for i, t in enumerate(open_trees):
            p, after = t.spec.params, []
            for node in t.active:
                r = found[i, node][1] if (i, node) in found else None
                if r is None:  # no row at all
                    t.values[node] = (0.0, 0.0)
                elif r["gain"] > EPS and r["gain"] >= p.gamma and depth < p.max_depth:
                    t.splits[node] = (r["feature"], r["cut"], r["missing_left"], r["gain"], r["h"])
                    sides = ((r["g_left"], r["h_left"]), (r["g"] - r["g_left"], r["h"] - r["h_left"]))
                    for child, (g, h) in zip((2 * node + 1, 2 * node + 2), sides):
                        if depth + 1 < p.max_depth:
                            after.append(child)
                        else:
                            t.values[child] = (p.learning_rate * float(leaf_weight(g, h, p)), h)
                else:
                    t.values[node] = (p.learning_rate * float(leaf_weight(r["g"], r["h"], p)), r["h"])
            t.active = after
        depth += 1


def _move_on(state: DataFrame, trees: list[_Growing], n_features: int) -> DataFrame:
    """The blocks with the finished trees' values added to the margins."""
    done = state.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for b in _blocks(batches, n_features):
            margin = b.margin.copy()
            for t in done.value:
                margin[t.model] += t.leaf_values(b)
            row = {**b.raw, "margin": margin.tobytes()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["n"]], pa.int32()), *[pa.array([row[c]], pa.binary()) for c in
                                                     ("key", "label", "weight", "fold", "bins", "margin")]],
                ["n", "key", "label", "weight", "fold", "bins", "margin"])

    return state.mapInArrow(run, _STATE)


def fit(state: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], specs: Sequence[Spec],
        partitions: int | None = None) -> tuple[list[Booster], DataFrame]:
    """Grow every model of `specs` side by side on the blocks of `pack` (which
    must have been made for that many models); returns the models and the
    blocks with the final margins, persisted."""
    sc = state.sparkSession.sparkContext
    partitions = partitions or sc.defaultParallelism
    slots = np.array([len(c) + 2 for c in cuts], np.int64)  # bins 0..len(c), missing
    models = [Booster(list(features), s.params) for s in specs]
    # every task hands on its whole histograms: no more tasks than run side by side
    state = state.coalesce(partitions).persist(StorageLevel.MEMORY_AND_DISK)
    for number in range(max((s.params.n_estimators for s in specs), default=0)):
        trees = [_Growing(s, m, number, len(features)) for m, s in enumerate(specs) if number < s.params.n_estimators]
        _grow(state, trees, slots, partitions)
        for t in trees:
            models[t.model].trees.append(t.finished(cuts))
        after = _move_on(state, trees, len(features))
        if (number + 1) % CUT == 0:
            after = after.checkpoint(eager=True)
        after = after.persist(StorageLevel.MEMORY_AND_DISK)
        after.count()
        state.unpersist()
        state = after
    return models, state


def margins(state: DataFrame, n_features: int, held_out: Sequence[int | None] | None = None) -> DataFrame:
    """(model, key, label, fold, score): probabilities of the blocks' rows; with
    `held_out`, of each model only the rows of its own fold."""
    def run(batches):
        for b in _blocks(batches, n_features):
            for m in range(len(b.margin)):
                rows = np.arange(b.n) if held_out is None or held_out[m] is None else np.flatnonzero(b.fold == held_out[m])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), m, np.int32)), pa.array(b.key[rows]), pa.array(b.label[rows].astype(np.int32)),
                     pa.array(b.fold[rows]), pa.array(1.0 / (1.0 + np.exp(-b.margin[m, rows])))],
                    ["model", "key", "label", "fold", "score"])

    return state.mapInArrow(run, "model int, key long, label int, fold int, score double")

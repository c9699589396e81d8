"""Leaf-wise gradient boosting for the absolute error, on Spark.

Rows are binned once and packed into blocks of ``BLOCK_ROWS``; a table of blocks
with every row's running score is all that a round reads. A round grows one tree.
Each step of it is one aggregate over the blocks,

    (leaf, feature, bin) -> sum of gradients, number of rows,

summed in each task, then by Spark, so what reaches the driver is bounded by
leaves x features x bins, never by rows. The driver keeps the leaves in a queue
by gain and always splits the best one, up to ``num_leaves``. So as not to run
a job for each split, a step asks for the histograms of all leaves that the
queue could still reach; once none is missing the queue is played through again
with all gains known, and the tree is exactly the one grown split by split. Of two
children only the smaller is counted, the other is the parent less that one. A leaf
of at most ``LOCAL_ROWS`` rows needs no further steps: one more job deals the rows
of all such leaves out by leaf, each group grows its leaf's own subtree by the same
queue, and the driver's queue takes what it wants of them. So a round is as many
jobs as halvings lead from all rows to ``LOCAL_ROWS``, and one.

Zones are one feature of categories: a split sends a set of them left, found by
ordering the zones by mean gradient. Absolute errors have gradients of -1, 0, 1,
which say where to split but not how far to go, so a leaf's value is refitted: the
median of its rows' residuals, read off a histogram of residuals that is
counted together with the features'.

The loss on the validation rows comes with the first step of the next round, so
patience is checked while growing and costs no job; training stops ``patience``
rounds after its best, where better means by a share of the first error
(``tolerance``): halving what is left of an error for ever is not. Scores are cached from round to round and written as a table
every ``ROUNDS_A_TABLE`` rounds, which cuts the lineage.

Rows with a NULL target take no part. A NULL or NaN feature goes right at every
split, and so does a zone that training never saw. Without training rows the
model predicts 0. Ties go to the lower feature, then the lower bin.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import ship_package, written

BLOCK_ROWS = 1 << 16
LOCAL_ROWS = 1 << 16
MAX_BINS = 255
ROUNDS_A_TABLE = 32
#: Residual bins: even steps of asinh(residual / scale), this many to a unit.
RESIDUAL_STEPS = 64


@dataclass
class Settings:
    """The settings of the trainer this replaces, by its names."""

    max_rounds: int = 1000
    patience: int = 50
    learning_rate: float = 0.05
    num_leaves: int = 127
    min_child_samples: int = 20
    feature_fraction: float = 0.8
    bagging_fraction: float = 0.8
    bagging_freq: int = 5
    reg_alpha: float = 0.1
    reg_lambda: float = 1.0
    #: Rows added to each zone's count when zones are put in order.
    category_smooth: float = 10.0
    #: A round is better if the error falls by this share of the first round's.
    tolerance: float = 1e-4
    seed: int = 42


# ------------------------------------------------------------------ ensemble


@dataclass
class Ensemble:
    """Fitted trees as flat node tables; ``root`` has each tree's first node.
    Leaves have ``feature`` -1. The first feature is the category if there are
    ``labels``."""

    features: list[str]
    labels: list[str]
    base: float = 0.0
    root: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    gain: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Per node, the categories that go left (node x category).
    category: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), bool))

    @property
    def rounds(self) -> int:
        return len(self.root)

    def cut(self, rounds: int) -> "Ensemble":
        """The first ``rounds`` trees."""
        if rounds >= self.rounds:
            return self
        n = int(self.root[rounds])
        per_node = {k: getattr(self, k)[:n] for k in ("feature", "threshold", "left", "right", "value", "gain", "category")}
        return Ensemble(self.features, self.labels, self.base, self.root[:rounds], **per_node)

    def leaves(self, x: np.ndarray, first: int = 0) -> np.ndarray:
        """The leaf of every row (features in order, the zone as its number) in
        the trees from ``first`` on."""
        trees = len(self.root) - first
        node = np.tile(self.root[first:], len(x))
        active = np.arange(len(node))
        last = self.category.shape[1] - 1
        while True:
            at = node[active]
            inner = self.feature[at] >= 0
            active, at = active[inner], at[inner]
            if not len(active):
                return node.reshape(len(x), trees)
            split = self.feature[at]
            v = x[active // trees, split]
            go = v <= self.threshold[at]
            if self.labels:
                number = np.where(np.isnan(v), last, v)
                go = np.where(split == 0, self.category[at, np.clip(number, 0, last).astype(np.int64)], go)
            node[active] = np.where(go, self.left[at], self.right[at])

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.rounds:
            return np.full(len(x), self.base)
        return self.base + self.value[self.leaves(x)].sum(axis=1)

    def importance(self) -> np.ndarray:
        """Each feature's share of the gain of all splits."""
        inner = self.feature >= 0
        total = np.bincount(self.feature[inner], weights=self.gain[inner], minlength=len(self.features))
        return total / total.sum() if total.sum() else total

    def add(self, tree: "Tree", rate: float) -> "Ensemble":
        at = len(self.feature)
        shift = lambda k: np.array([n[k] + at if n["feature"] >= 0 else 0 for n in tree.nodes], dtype=np.int64)
        column = lambda k: np.array([n[k] for n in tree.nodes])
        grow = lambda old, new: np.concatenate([old, new])
        return Ensemble(
            self.features, self.labels, self.base, np.append(self.root, at),
            grow(self.feature, column("feature")), grow(self.threshold, column("threshold")),
            grow(self.left, shift("left")), grow(self.right, shift("right")),
            grow(self.value, rate * column("value")), grow(self.gain, column("gain")),
            grow(self.category.reshape(-1, len(self.labels) + 1), np.stack([n["category"] for n in tree.nodes])),
        )

    # -------------------------------------------------------------- storage
    def save(self, spark: SparkSession, path: str) -> str:
        """One row a node, and one row with the rest, as Parquet."""
        rows = [
            (k, int(self.feature[k]), float(self.threshold[k]), int(self.left[k]), int(self.right[k]), float(self.value[k]), float(self.gain[k]), np.flatnonzero(self.category[k]).tolist())
            for k in range(len(self.feature))
        ]
        nodes = spark.createDataFrame(rows, "node LONG, feature INT, threshold DOUBLE, `left` LONG, `right` LONG, value DOUBLE, gain DOUBLE, category ARRAY<INT>")
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"features": self.features, "labels": self.labels, "base": self.base, "root": self.root.tolist()})
        spark.createDataFrame([(about,)], "about STRING").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Ensemble":
        about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
        n = spark.read.parquet(f"{path}/nodes").orderBy("node").toPandas()
        category = np.zeros((len(n), len(about["labels"]) + 1), dtype=bool)
        for k, own in enumerate(n["category"]):
            category[k, np.asarray(own, dtype=np.int64)] = True
        kinds = {"feature": np.int64, "threshold": float, "left": np.int64, "right": np.int64, "value": float, "gain": float}
        return cls(
            about["features"], about["labels"], about["base"], np.array(about["root"], dtype=np.int64),
            **{k: n[k].to_numpy(dtype=t) for k, t in kinds.items()}, category=category,
        )


# --------------------------------------------------------------------- blocks


@dataclass
class Bins:
    """Upper edges of each feature's bins; the category feature has none."""

    edges: list[np.ndarray]
    categories: int

    @property
    def width(self) -> int:
        return max([self.categories, *(len(e) + 1 for e in self.edges)])

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bin of every value; NaN is in a feature's last bin."""
        out = np.zeros(x.shape, dtype=np.uint16)
        for f, edges in enumerate(self.edges):
            if self.categories and not f:
                out[:, 0] = np.clip(np.nan_to_num(x[:, 0], nan=self.categories - 1), 0, self.categories - 1)
            else:
                out[:, f] = np.searchsorted(edges, x[:, f], side="left")
        return out


def find_bins(rows: DataFrame, features: list[str], categories: int) -> Bins:
    """Bin edges from quantile sketches: one aggregate over the rows."""
    shares = [k / MAX_BINS for k in range(1, MAX_BINS)]
    wide = rows.agg(*[F.percentile_approx(F.col(c), shares, 10000).alias(f"e{k}") for k, c in enumerate(features)]).first()
    edges = [np.unique(np.array([v for v in (wide[k] or []) if v is not None and v == v], dtype=float)) for k in range(len(features))]
    if categories:
        edges[0] = np.zeros(0)
    return Bins(edges, categories)


_BLOCK = "block LONG, n INT, valid BINARY, codes BINARY, y BINARY, score BINARY"


def pack(bins: Bins, base: float):
    """The rows of a partition (features, target, validation flag) as blocks."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        held, n, seq = [], 0, 0
        part = TaskContext.get().partitionId() << 32

        def block():
            nonlocal held, n, seq
            table = pa.Table.from_batches(held)
            x = np.column_stack([table.column(k).to_numpy() for k in range(len(bins.edges))]).astype(float)
            y = table.column(len(bins.edges)).to_numpy().astype(float)
            valid = table.column(len(bins.edges) + 1).to_numpy(zero_copy_only=False).astype(bool)
            out = {"block": [part + seq], "n": pa.array([n], pa.int32()), "valid": [valid.tobytes()], "codes": [bins.codes(x).tobytes()], "y": [y.tobytes()], "score": [np.full(n, base).tobytes()]}
            held, n, seq = [], 0, seq + 1
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, BLOCK_ROWS - n)
                batch = batch.slice(some.num_rows)
                held.append(some)
                n += some.num_rows
                if n == BLOCK_ROWS:
                    yield block()
        if n:
            yield block()

    return run


def blocks(batch):
    """(number, validation flags, bins, targets, scores) of a batch's blocks."""
    for r in batch.to_pylist():
        codes = np.frombuffer(r["codes"], np.uint16).reshape(r["n"], -1)
        yield r["block"], np.frombuffer(r["valid"], bool), codes, np.frombuffer(r["y"]), np.frombuffer(r["score"])


def drawn(n: int, block: int, round_: int, s: Settings) -> np.ndarray:
    """Rows of a block that a round learns from; a new draw every few rounds."""
    if s.bagging_fraction >= 1 or not s.bagging_freq:
        return np.ones(n, dtype=bool)
    return np.random.default_rng([s.seed, round_ // s.bagging_freq, block]).random(n) < s.bagging_fraction


# ----------------------------------------------------------------- the tree


class Tree:
    """A growing tree over bins. A node's ``hist`` is (feature, bin, [gradient,
    rows]) once counted, ``spread`` its residual bins (bin -> [sum, rows])."""

    def __init__(self, bins: Bins, used: np.ndarray, s: Settings):
        self.bins, self.used, self.s, self.nodes = bins, used, s, []
        self._new()

    def _new(self) -> int:
        self.nodes.append({
            "feature": -1, "threshold": 0.0, "bin": 0, "left": 0, "right": 0, "value": 0.0, "gain": 0.0,
            "category": np.zeros(self.bins.categories or 1, dtype=bool), "hist": None, "spread": None, "best": None,
        })
        return len(self.nodes) - 1

    def settle(self, k: int, hist: np.ndarray, spread: dict) -> None:
        node = self.nodes[k]
        node["hist"], node["spread"] = hist, spread
        node["best"] = best_split(hist, self.used, self.bins, self.s)
        node["value"] = median_of(spread)

    def expand(self, k: int) -> tuple[int, int]:
        """Applies a counted leaf's best split; its children are uncounted."""
        node = self.nodes[k]
        node["left"], node["right"] = self._new(), self._new()
        self.split(node, node["best"])
        return node["left"], node["right"]

    def size(self, k: int) -> int:
        return int(self.nodes[k]["hist"][self.used[0], :, 1].sum())

    def graft(self, k: int, nodes: list) -> None:
        """Puts a subtree in a leaf's place; its first node is the leaf."""
        number = [k] + [self._new() for _ in nodes[1:]]
        for own, (feature, at, left, right, value, gain, zones) in zip(number, nodes, strict=True):
            node = self.nodes[own]
            node["value"], node["best"] = value, None
            if feature >= 0:
                node["left"], node["right"] = number[left], number[right]
                self.split(node, (gain, feature, at, zones if zones else None))
                node["best"] = gain, feature, at, zones

    def split(self, node: dict, best: tuple) -> None:
        node["gain"], node["feature"], node["bin"], zones = best
        if zones is not None:
            node["category"][zones] = True
        else:
            node["threshold"] = float(self.bins.edges[node["feature"]][node["bin"]])

    def wanted(self) -> list[int]:
        """Leaves that the queue of best gains would split but that aren't split
        yet; none once every split of the final tree is there."""
        heap, leaves, out = [], 1, []

        def push(k):
            best = self.nodes[k]["best"]
            if best is not None:
                heapq.heappush(heap, (-best[0], k))

        push(0)
        while heap and leaves < self.s.num_leaves:
            _, k = heapq.heappop(heap)
            leaves += 1
            if self.nodes[k]["feature"] < 0:
                out.append(k)
            else:
                push(self.nodes[k]["left"])
                push(self.nodes[k]["right"])
        return out

    def finish(self) -> "Tree":
        """Only the splits that the queue takes, best first."""
        heap, leaves, taken = [], 1, set()
        if self.nodes[0]["best"] is not None:
            heap = [(-self.nodes[0]["best"][0], 0)]
        while heap and leaves < self.s.num_leaves:
            _, k = heapq.heappop(heap)
            leaves += 1
            taken.add(k)
            for child in (self.nodes[k]["left"], self.nodes[k]["right"]):
                if self.nodes[child]["best"] is not None:
                    heapq.heappush(heap, (-self.nodes[child]["best"][0], child))
        order, todo = [], [0]
        while todo:
            k = todo.pop()
            order.append(k)
            if k in taken:
                todo += [self.nodes[k]["right"], self.nodes[k]["left"]]
        number = {k: i for i, k in enumerate(order)}
        out = []
        for k in order:
            node = dict(self.nodes[k], hist=None, spread=None)
            if k in taken:
                node["left"], node["right"] = number[node["left"]], number[node["right"]]
            else:
                node.update(feature=-1, gain=0.0, left=0, right=0, category=np.zeros_like(node["category"]))
            out.append(node)
        self.nodes = out
        return self

    def router(self) -> tuple:
        """What a task needs to find a row's leaf: arrays over nodes."""
        column = lambda k: np.array([n[k] for n in self.nodes])
        return column("feature"), column("bin"), column("left"), column("right"), np.stack([n["category"] for n in self.nodes])


def route(router: tuple, codes: np.ndarray, category: bool) -> np.ndarray:
    """The leaf of every row of bins."""
    feature, at, left, right, zones = router
    node, row = np.zeros(len(codes), dtype=np.int64), np.arange(len(codes))
    while True:
        split = feature[node]
        inner = split >= 0
        if not inner.any():
            return node
        code = codes[row, np.maximum(split, 0)]
        go = code <= at[node]
        if category:
            go = np.where(split == 0, zones[node, np.minimum(code, zones.shape[1] - 1)], go)
        node = np.where(inner, np.where(go, left[node], right[node]), node)


def leaf_score(g: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    return np.maximum(np.abs(g) - s.reg_alpha, 0) ** 2 / (n + s.reg_lambda)


def best_split(hist: np.ndarray, used: np.ndarray, bins: Bins, s: Settings):
    """(gain, feature, bin, zones) of the best split of a leaf, or None."""
    g, n = hist[used[0]].sum(axis=0)
    if n < 2 * s.min_child_samples:
        return None
    own, best = leaf_score(g, n, s), None
    gl, nl = np.moveaxis(np.cumsum(hist[used], axis=1), 2, 0)
    edges = np.array([len(bins.edges[f]) for f in used])
    zones = None
    if bins.categories and used[0] == 0:
        there = np.flatnonzero(hist[0, :, 1])
        zones = there[np.argsort(hist[0, there, 0] / (hist[0, there, 1] + s.category_smooth), kind="stable")]
        gl[0, : len(zones)], nl[0, : len(zones)] = np.cumsum(hist[0, zones], axis=0).T
        edges[0] = len(zones) - 1
    fine = (nl >= s.min_child_samples) & (n - nl >= s.min_child_samples) & (np.arange(gl.shape[1]) < edges[:, None])
    gain = np.where(fine, leaf_score(gl, nl, s) + leaf_score(g - gl, n - nl, s) - own, 0.0)
    at = gain.argmax(axis=1)
    for i, f in enumerate(used.tolist()):
        top = float(gain[i, at[i]])
        if top > 1e-9 and (best is None or top > best[0] + 1e-12):
            best = top, f, int(at[i]), zones[: at[i] + 1] if zones is not None and not f else None
    return best


def residual_bin(r: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(np.arcsinh(r / scale) * RESIDUAL_STEPS).astype(np.int64)


def median_of(spread: dict) -> float:
    """The median residual: the mean of the bins with the middle rows."""
    keys = sorted(k for k, v in spread.items() if v[1] > 0.5)
    if not keys:
        return 0.0
    upto = np.cumsum([spread[k][1] for k in keys])
    middle = [keys[int(np.searchsorted(upto, upto[-1] * 0.5, side=side))] for side in ("left", "right")] if upto[-1] else keys[:1]
    return float(np.mean([spread[k][0] / spread[k][1] for k in middle]))


def median_of_rows(rest: np.ndarray, scale: float) -> float:
    """``median_of`` the histogram of some residuals."""
    if not len(rest):
        return 0.0
    rest = np.sort(rest)
    bins = residual_bin(rest, scale)
    n = len(rest)
    # The bins in which the cumulated rows reach, and pass, one half.
    middle = bins[[(n + 1) // 2 - 1, n // 2]]
    lo, hi = np.searchsorted(bins, middle, side="left"), np.searchsorted(bins, middle, side="right")
    return float(np.mean([rest[a:b].mean() for a, b in zip(lo, hi, strict=True)]))


# ------------------------------------------------------------- a leaf's subtree


def grow_leaf(codes: np.ndarray, rest: np.ndarray, used: np.ndarray, bins: Bins, scale: float, s: Settings) -> Tree:
    """The subtree of one leaf from its rows, best leaf first."""
    tree, width = Tree(bins, used, s), bins.width
    key = codes.astype(np.int64) + np.arange(codes.shape[1]) * width
    size = codes.shape[1] * width
    gradient = -np.sign(rest)

    def count(rows):
        k = key[rows].ravel()
        g = np.bincount(k, weights=np.repeat(gradient[rows], codes.shape[1]), minlength=size)
        return np.stack([g, np.bincount(k, minlength=size)], axis=1).reshape(-1, width, 2)

    def settle(k, rows, hist):
        node = tree.nodes[k]
        node["value"], node["rows"], node["hist"] = median_of_rows(rest[rows], scale), rows, hist
        node["best"] = best_split(hist, used, bins, s)
        if node["best"] is not None:
            heapq.heappush(heap, (-node["best"][0], k))
        else:
            node["rows"] = node["hist"] = None

    heap, leaves = [], 1
    settle(0, np.arange(len(rest)), count(slice(None)))
    while heap and leaves < s.num_leaves:
        _, k = heapq.heappop(heap)
        leaves += 1
        node = tree.nodes[k]
        _, f, at, zones = node["best"]
        left, right = tree.expand(k)
        go = node["category"][codes[node["rows"], f]] if zones is not None else codes[node["rows"], f] <= at
        rows = {left: node["rows"][go], right: node["rows"][~go]}
        small, large = sorted((left, right), key=lambda c: (len(rows[c]), c))
        hist = count(rows[small])
        settle(small, rows[small], hist)
        settle(large, rows[large], node["hist"] - hist)
        node["rows"] = node["hist"] = None
    return tree


# ------------------------------------------------------------------- a step

#: Kinds of sums that a step returns: a histogram's cell, a residual bin, and the
#: absolute errors of training and validation rows so far.
_CELL, _SPREAD, _LOSS = 0, 1, 2
_SUMS = "kind INT, leaf INT, at LONG, total DOUBLE, n LONG"
#: Residual bins are shifted to be above zero.
_SHIFT = 1 << 20


def count_step(router: tuple, wanted: list[int], round_: int, used: np.ndarray, bins: Bins, scale: float, s: Settings, loss: bool):
    """Sums of the wanted leaves over a task's blocks."""
    width, place = bins.width, {k: i for i, k in enumerate(wanted)}

    def run(batches):
        import pyarrow as pa

        number = np.full(len(router[0]), -1)
        for k, i in place.items():
            number[k] = i
        cells = np.zeros((len(wanted), len(used), width, 2))
        spread: dict[tuple[int, int], np.ndarray] = {}
        errors = np.zeros((2, 2))
        for batch in batches:
            for block, valid, codes, y, score in blocks(batch):
                if loss:
                    for side in (0, 1):
                        some = valid == side
                        errors[side] += np.abs(y[some] - score[some]).sum(), some.sum()
                use = drawn(len(y), block, round_, s) & ~valid
                leaf = number[route(router, codes[use], bool(bins.categories))]
                mine = leaf >= 0
                leaf, own, rest = leaf[mine], codes[use][mine], (y - score)[use][mine]
                gradient = -np.sign(rest)
                for i, f in enumerate(used.tolist()):
                    key = leaf * width + own[:, f]
                    cells[:, i, :, 0] += np.bincount(key, weights=gradient, minlength=len(wanted) * width).reshape(-1, width)
                    cells[:, i, :, 1] += np.bincount(key, minlength=len(wanted) * width).reshape(-1, width)
                key, at = np.unique(leaf * (2 * _SHIFT) + residual_bin(rest, scale) + _SHIFT, return_inverse=True)
                for k, total, n in zip(key.tolist(), np.bincount(at, weights=rest), np.bincount(at), strict=True):
                    spread[k] = spread.get(k, 0) + np.array([total, n])
        leaf, i, b = np.nonzero(cells[..., 1])
        kind = np.repeat([_CELL, _SPREAD, _LOSS], [len(leaf), len(spread), 2 * loss])
        keys = np.array(list(spread), dtype=np.int64)
        sums = np.concatenate([cells[leaf, i, b], np.array(list(spread.values())).reshape(-1, 2), errors[: 2 * loss]])
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(kind, pa.int32()),
            "leaf": pa.array(np.concatenate([leaf, keys // (2 * _SHIFT), np.zeros(2 * loss, np.int64)]), pa.int32()),
            "at": pa.array(np.concatenate([used[i] * width + b, keys % (2 * _SHIFT) - _SHIFT, np.arange(2 * loss)]), pa.int64()),
            "total": sums[:, 0], "n": pa.array(sums[:, 1].astype(np.int64)),
        })

    return run


def add_tree(router: tuple, value: np.ndarray, category: bool):
    """Blocks with the tree's values added to their scores."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scores = [(score + value[route(router, codes, category)]).tobytes() for _, _, codes, _, score in blocks(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.binary())], schema=batch.schema)

    return run


_PART = "leaf INT, n INT, codes BINARY, rest BINARY, error ARRAY<DOUBLE>"
_GROWN = "leaf INT, nodes STRING, error ARRAY<DOUBLE>"


def deal_rows(router: tuple, wanted: list[int], round_: int, category: bool, s: Settings, loss: bool):
    """The rows of wanted leaves, a row for each block and leaf; and, as leaf -1,
    a block's absolute errors and counts of training and validation rows."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for block, valid, codes, y, score in blocks(batch):
                use = drawn(len(y), block, round_, s) & ~valid
                leaf, own, rest = route(router, codes[use], category), codes[use], (y - score)[use]
                out = []
                for k in wanted:
                    mine = leaf == k
                    if mine.any():
                        out.append((k, int(mine.sum()), own[mine].tobytes(), rest[mine].tobytes(), None))
                if loss:
                    off = np.abs(y - score)
                    out.append((-1, 0, b"", b"", [float(off[~valid].sum()), float((~valid).sum()), float(off[valid].sum()), float(valid.sum())]))
                cols = list(zip(*out, strict=True)) if out else [[]] * 5
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["leaf", "n", "codes", "rest", "error"])

    return run


def grow_rows(features: int, used: np.ndarray, bins: Bins, scale: float, s: Settings):
    """A leaf's rows -> its subtree."""
    def run(table):
        import pyarrow as pa

        leaf = table.column("leaf")[0].as_py()
        nodes = error = None
        if leaf < 0:
            error = np.sum(table.column("error").to_pylist(), axis=0).tolist()
        else:
            codes = np.concatenate([np.frombuffer(x, np.uint16).reshape(-1, features) for x in table.column("codes").to_pylist()])
            rest = np.concatenate([np.frombuffer(x) for x in table.column("rest").to_pylist()])
            nodes = json.dumps([
                [n["feature"], n["bin"], n["left"], n["right"], n["value"], n["gain"], np.flatnonzero(n["category"]).tolist()]
                for n in grow_leaf(codes, rest, used, bins, scale, s).nodes
            ])
        return pa.table({"leaf": pa.array([leaf], pa.int32()), "nodes": pa.array([nodes], pa.string()), "error": pa.array([error], pa.list_(pa.float64()))})

    return run


class Trainer:
    """One training run over a table of blocks."""

    def __init__(self, state: DataFrame, rows: int, bins: Bins, scale: float, s: Settings):
        self.state, self.rows, self.bins, self.scale, self.s = state, rows, bins, scale, s

    def sums(self, tree: Tree, wanted: list[int], round_: int, loss: bool = False):
        """Histograms and residual bins of the wanted leaves, and mean errors."""
        run = count_step(tree.router(), wanted, round_, tree.used, self.bins, self.scale, self.s, loss)
        got = self.state.mapInArrow(run, _SUMS).groupBy("kind", "leaf", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
        kind, leaf, at, total, n = (got.column(c).to_numpy() for c in ("kind", "leaf", "at", "total", "n"))
        hist = np.zeros((len(wanted), len(self.bins.edges) * self.bins.width, 2))
        cell = kind == _CELL
        hist[leaf[cell], at[cell]] = np.stack([total[cell], n[cell]], axis=1)
        spread = [{} for _ in wanted]
        for k in np.flatnonzero(kind == _SPREAD).tolist():
            spread[leaf[k]][int(at[k])] = (total[k], n[k])
        errors = {int(at[k]): total[k] / n[k] for k in np.flatnonzero((kind == _LOSS) & (n > 0)).tolist()}
        return hist.reshape(len(wanted), -1, self.bins.width, 2), spread, errors

    def subtrees(self, tree: Tree, wanted: list[int], round_: int, loss: bool) -> dict:
        """Grows the wanted leaves' subtrees into the tree; mean errors."""
        deal = deal_rows(tree.router(), wanted, round_, bool(self.bins.categories), self.s, loss)
        grow = grow_rows(len(self.bins.edges), tree.used, self.bins, self.scale, self.s)
        errors = {}
        for r in self.state.mapInArrow(deal, _PART).groupBy("leaf").applyInArrow(grow, _GROWN).collect():
            if r.leaf < 0:
                errors = {side: r.error[2 * side] / r.error[2 * side + 1] for side in (0, 1) if r.error[2 * side + 1]}
            else:
                tree.graft(r.leaf, json.loads(r.nodes))
        return errors

    def grow(self, round_: int) -> tuple[Tree, dict]:
        """A round's tree, and the mean errors before it."""
        f = len(self.bins.edges)
        take = max(1, round(self.s.feature_fraction * f))
        used = np.sort(np.random.default_rng([self.s.seed, round_]).permutation(f)[:take])
        tree = Tree(self.bins, used, self.s)
        if self.rows <= LOCAL_ROWS:
            errors = self.subtrees(tree, [0], round_, loss=True)
            return tree.finish(), errors
        hist, spread, errors = self.sums(tree, [0], round_, loss=True)
        tree.settle(0, hist[0], spread[0])
        large_ones = lambda: [k for k in tree.wanted() if tree.size(k) > LOCAL_ROWS]
        while wanted := large_ones():
            pairs = []
            for k in wanted:
                node = tree.nodes[k]
                _, f_, at, zones = node["best"]
                left = node["hist"][f_, zones if zones is not None else slice(0, at + 1), 1].sum()
                l, r = tree.expand(k)
                pairs.append((k, l, r) if 2 * left <= node["hist"][f_, :, 1].sum() else (k, r, l))
            hist, spread, _ = self.sums(tree, [small for _, small, _ in pairs], round_)
            for (k, small, large), h, d in zip(pairs, hist, spread, strict=True):
                node = tree.nodes[k]
                rest = {b: (t - d.get(b, (0, 0))[0], n - d.get(b, (0, 0))[1]) for b, (t, n) in node["spread"].items()}
                tree.settle(small, h, d)
                tree.settle(large, node["hist"] - h, rest)
                node["hist"] = node["spread"] = None
        if wanted := tree.wanted():
            self.subtrees(tree, wanted, round_, loss=False)
        return tree.finish(), errors

    def advance(self, tree: Tree, round_: int) -> None:
        """Adds the tree to all scores, lazily: the next round's first step does."""
        value = self.s.learning_rate * np.array([n["value"] for n in tree.nodes])
        new = self.state.mapInArrow(add_tree(tree.router(), value, bool(self.bins.categories)), _BLOCK)
        self.state = written(new, "boosting") if round_ % ROUNDS_A_TABLE == ROUNDS_A_TABLE - 1 else new.persist(StorageLevel.MEMORY_AND_DISK)


def fit(train: DataFrame, valid: DataFrame | None, features: list[str], target: str, labels: list[str], s: Settings | None = None) -> tuple[Ensemble, list[float]]:
    """Trees fitted to ``train`` and the mean absolute error on ``valid`` after
    each round; without ``valid`` all rounds are grown. ``labels``: names of the
    first feature's categories, whose numbers its column holds."""
    s = s or Settings()
    spark = train.sparkSession
    ship_package(spark)
    number = lambda df, flag: df.where(F.col(target).isNotNull()).select(*[F.col(c).cast("double").alias(f"f{k}") for k, c in enumerate(features)], F.col(target).cast("double").alias("y"), F.lit(flag).alias("valid"))
    rows = number(train, False)
    names = [f"f{k}" for k in range(len(features))]
    model = Ensemble(list(features), list(labels), category=np.zeros((0, len(labels) + 1), bool))
    n, middle = rows.agg(F.count("*"), F.percentile_approx("y", 0.5, 10000)).first()
    if not n:
        return model, []
    model.base = float(middle)
    bins = find_bins(rows, names, len(labels) + 1 if labels else 0)
    spread = rows.agg(F.avg(F.abs(F.col("y") - model.base))).first()[0]
    if valid is not None:
        rows = rows.union(number(valid, True))
    # The same rows make the same blocks, in whatever order they come.
    parts = max(1, -(-rows.count() // BLOCK_ROWS))
    dealt = rows.repartition(parts, *names, "y").sortWithinPartitions(*names, "y", "valid")
    state = written(dealt.mapInArrow(pack(bins, model.base), _BLOCK), "boosting_blocks")
    trainer = Trainer(state.coalesce(parts), n, bins, max(spread / 8, 1e-9), s)
    losses: list[float] = []
    stale = None
    best, kept = float("inf"), 0
    for round_ in range(s.max_rounds + 1):
        tree, errors = trainer.grow(round_)
        if stale is not None:
            stale.unpersist()
        if round_ and 1 in errors:
            losses.append(float(errors[1]))
            if losses[-1] < best - s.tolerance * losses[0]:
                best, kept = losses[-1], round_
            elif round_ - kept >= s.patience:
                break
        if round_ == s.max_rounds:
            break
        model = model.add(tree, s.learning_rate)
        stale = trainer.state
        trainer.advance(tree, round_)
    trainer.state.unpersist()
    return (model.cut(kept) if losses else model), losses

"""Random forests grown together over one table of rows.

A fit of ``pyspark.ml`` prepares its rows, passes over them once a level and
is scored on its own; dozens of fits over the same rows do all this dozens of
times. Here any number of forests share the rows: ``pack`` writes them once,
as blocks of bin numbers with the weights of all bags, and ``grow`` takes one
Spark job a level for the trees of all forests. Tasks count classes by tree,
node, tried predictor and bin over their blocks; the counts of a tree meet
in one group, which finds its nodes' best splits. The driver holds trees, no rows.

The forest is that of ``pyspark.ml``: at most 32 bins a predictor, ``mtry``
predictors drawn for each node, the split of the largest positive Gini gain
with a row on both sides, leaves where no gain is left, a node is pure or the
depth is reached; a row's probability is the mean of its leaves' class shares.
Bins are found on more rows (``BIN_ROWS``; there about 10,000), and draws come
from seeds of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialize, wanted_partitions

#: Rows that bins are found on, rows of a block, and rows x trees (of all
#: forests) from which forests are grown together.
BIN_ROWS, BLOCK_ROWS, JOINT_WORK = 1 << 16, 1 << 16, 1 << 28
MAX_BINS = 32

_BLOCK = "n int, codes binary, labels binary, folds binary, bags binary"


@dataclass
class Level:
    """The nodes of a level: predictor, last bin to the left, and for both
    children their number in the next level (-1: a leaf)."""
    feature: np.ndarray
    cut: np.ndarray
    to: np.ndarray

    def wide(self) -> Level:
        """As indexes, which numpy takes without a copy."""
        return Level(self.feature.astype(np.int64), self.cut, self.to.astype(np.int64))


@dataclass
class Tree:
    """``bag``: which of the rows' weights it takes; ``fold``: whose rows it
    does not learn from; ``shares``: by level the class shares of the children."""
    forest: int
    bag: int
    fold: int
    levels: list[Level] = field(default_factory=list)
    shares: list[np.ndarray] = field(default_factory=list)
    nodes: int = 1

    def wide(self) -> Tree:
        return replace(self, levels=[x.wide() for x in self.levels])


@dataclass(frozen=True)
class Spec:
    """A forest to grow: a tree for each entry of ``bags``, over the
    ``columns`` among the blocks' bins, ``mtry`` of them tried at a node, and
    without the rows of ``fold``."""
    columns: Sequence[int]
    mtry: int
    bags: Sequence[int]
    fold: int = 0
    seed: int = 1


# -------------------------------------------------------------------- rows

def sampled(df: DataFrame, vec: Column, key: str, rows: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The vectors and folds of about ``BIN_ROWS`` of the rows, drawn by a hash of ``key``."""
    part = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < int((1 << 30) * min(1.0, BIN_ROWS / max(1, rows))) + 1
    some = df.select(vec.alias("v"), "fold", part.alias("in")).filter("in").toArrow()
    if not some.num_rows:
        some = df.select(vec.alias("v"), "fold").limit(BIN_ROWS).toArrow()
    return _matrix(some.column("v")), some.column("fold").to_numpy()


def thresholds(x: np.ndarray, max_bins: int = MAX_BINS) -> np.ndarray:
    """Ascending ends of bins: between all values where they are few, else
    between quantiles."""
    value, count = np.unique(x, return_counts=True)
    between = (value[:-1] + value[1:]) / 2
    if len(value) <= max_bins:
        return between
    ends, wanted = np.cumsum(count)[:-1], len(x) / max_bins * np.arange(1, max_bins)
    at = np.clip(np.searchsorted(ends, wanted), 1, len(ends) - 1)
    return between[np.unique(at - (wanted - ends[at - 1] < ends[at] - wanted))]


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    X = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if not np.isfinite(X).all():
        raise ValueError("a predictor of a forest is null or no number")
    return X


def pack(df: DataFrame, vec: Column, label: str, bins: Sequence[tuple[int, np.ndarray]], bags: str | None = None) -> DataFrame:
    """Blocks of rows, written: for each of ``bins`` (a component of the
    vector, its thresholds) the rows' bin numbers; 0/1 labels, folds
    (``fold``), and whole weights by bag."""
    rows = df.select(vec.alias("v"), F.col(label).cast("double").alias("y"), F.col("fold").cast("int").alias("fold"),
                     (F.col(bags) if bags else F.array().cast("array<tinyint>")).alias("bags"))

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batches)
        X, y = _matrix(t.column("v")).T.copy(), t.column("y").to_numpy()
        if not np.isin(y, (0.0, 1.0)).all():
            raise ValueError("a label of a forest is neither 0 nor 1")
        codes = np.stack([np.searchsorted(ends, X[c]).astype(np.uint8) for c, ends in bins])
        w = t.column("bags").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1).T.astype(np.uint8)
        parts = (codes, y.astype(np.uint8), t.column("fold").to_numpy().astype(np.int32), w)
        return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts]],
                                          names=[c.split()[0] for c in _BLOCK.split(", ")])

    def blocks(it):
        kept, n = [], 0
        for batch in it:
            while batch.num_rows:
                kept.append(part := batch.slice(0, BLOCK_ROWS - n))
                batch, n = batch.slice(part.num_rows), n + part.num_rows
                if n == BLOCK_ROWS:
                    yield block(kept)
                    kept, n = [], 0
        if n:
            yield block(kept)

    return materialize(rows.mapInArrow(blocks, _BLOCK))


def partitions(spark, rows: int) -> int:
    """A task for each core, which writes one set of counts, until rows ask
    for more."""
    return min(wanted_partitions(spark, rows), max(spark.sparkContext.defaultParallelism, -(-rows // (4 * BLOCK_ROWS))))


class _Block:
    def __init__(self, row: dict):
        self.n = row["n"]
        self.codes, self.labels, self.bags = (np.frombuffer(row[c], np.uint8) for c in ("codes", "labels", "bags"))
        self.bags, self.folds = self.bags.reshape(-1, self.n), np.frombuffer(row["folds"], np.int32)

    def right(self, at: Level, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Twice the node, and one for rows that go to the right."""
        return 2 * node + (self.codes.take((at.feature * self.n).take(node) + rows) > at.cut.take(node))

    def reached(self, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the tree's bag that are in no leaf yet, and their nodes."""
        rows = np.flatnonzero((self.bags[tree.bag] > 0) & (self.folds != tree.fold))
        node = np.zeros(len(rows), dtype=np.int64)
        for at in tree.levels:
            node = at.to.take(self.right(at, rows, node))
            if at.to.min() < 0:
                on = np.flatnonzero(node >= 0)
                rows, node = rows.take(on), node.take(on)
        return rows, node

    def counts(self, tree: Tree, tried: np.ndarray, bins: int) -> np.ndarray:
        """Weight by tried predictor, node, bin and class."""
        rows, node = self.reached(tree)
        weight = self.bags[tree.bag].take(rows).astype(np.float64)
        cell = node * (2 * bins) + self.labels.take(rows)
        return np.stack([np.bincount(cell + 2 * self.codes.take((t * self.n).take(node) + rows).astype(np.int64), weight, 2 * bins * tree.nodes)
                         for t in tried.T])

    def share(self, tree: Tree, rows: np.ndarray) -> np.ndarray:
        """The class share of the leaf that each row reaches."""
        out, at_row, node = np.zeros(len(rows)), np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64)
        for at, share in zip(tree.levels, tree.shares, strict=True):
            side = self.right(at, rows.take(at_row), node)
            node = at.to.take(side)
            leaf = node < 0
            out[at_row[leaf]] = share[side[leaf]]
            at_row, node = at_row[~leaf], node[~leaf]
        return out


def _read(it) -> list[_Block]:
    return [_Block(row) for batch in it for row in batch.to_pylist()]


# ------------------------------------------------------------------- trees

def best_splits(counts: np.ndarray, tried: np.ndarray, last: bool) -> tuple[np.ndarray, ...]:
    """From ``counts`` (tried predictor, node, bin, class) each node's
    predictor and cut, and its children's class shares and whether they are
    to be split. A node without a gain sends all rows left, into a leaf."""
    left = counts.cumsum(axis=2)[:, :, :-1]
    whole = counts[0].sum(axis=1)
    right = whole[None, :, None] - left
    n, nl, nr = whole.sum(axis=1), left.sum(axis=3), right.sum(axis=3)

    def impure(x, n):  # Gini impurity times the weight
        return 2.0 * x[..., 0] * x[..., 1] / np.maximum(n, 1.0)

    own = impure(whole, n)
    gain = np.where((nl > 0) & (nr > 0), own[None, :, None] - impure(left, nl) - impure(right, nr), -1.0)
    gain = gain.transpose(1, 0, 2).reshape(len(whole), -1)
    at = gain.argmax(axis=1)
    slot, cut = np.divmod(at, left.shape[2])
    node = np.arange(len(whole))
    split = gain[node, at] > 1e-12 * n  # what rounding leaves of no gain
    sides = np.stack([left[slot, node, cut], right[slot, node, cut]], axis=1)
    sides[~split, 0] = whole[~split]
    weight = sides.sum(axis=2)
    share = sides[:, :, 1] / np.maximum(weight, 1.0)
    goes_on = split[:, None] & (sides.min(axis=2) > 0) & (not last)
    return tried[node, slot], np.where(split, cut, np.iinfo(np.uint8).max), share.ravel(), goes_on.ravel()


_SPLITS = "tree int, feature array<long>, cut array<long>, share array<double>, open array<boolean>"


def grow(blocks: DataFrame, specs: Sequence[Spec], depth: int, bins: int = MAX_BINS) -> list[list[Tree]]:
    """The trees of every forest, all a level deeper with each job."""
    spark = blocks.sparkSession
    forests = [[Tree(i, bag, spec.fold) for bag in spec.bags] for i, spec in enumerate(specs)]
    trees = [t for forest in forests for t in forest]
    number = {id(t): k for forest in forests for k, t in enumerate(forest)}

    def tried(tree: Tree, level: int) -> np.ndarray:
        spec = specs[tree.forest]
        draws = np.random.default_rng([spec.seed, number[id(tree)], level]).random((tree.nodes, len(spec.columns)))
        return np.asarray(spec.columns, dtype=np.int64)[np.sort(draws.argsort(axis=1)[:, :spec.mtry], axis=1)]

    for level in range(depth):
        if not (live := [t for t in trees if t.nodes]):
            break
        last = level == depth - 1
        shared = spark.sparkContext.broadcast([(replace(t, shares=[]), tried(t, level)) for t in live])

        def count(it):
            own = _read(it)
            for k, (tree, some) in enumerate(shared.value if own else []):  # noqa: B023
                tree = tree.wide()
                counts = sum(b.counts(tree, some, bins) for b in own)
                kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.float64) if t is np.float64 or counts.max(initial=0) <= np.iinfo(t).max)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.dtype(kind).str]),
                                                  pa.array([pa.compress(counts.astype(kind).tobytes(), "zstd", asbytes=True)], pa.binary())],
                                                 names=["tree", "kind", "counts"])

        def split(met: pa.Table) -> pa.Table:
            k = met.column("tree")[0].as_py()
            tree, some = shared.value[k]  # noqa: B023
            shape = (some.shape[1], tree.nodes, bins, 2)  # noqa: B023
            counts = np.zeros(shape)
            for kind, b in zip(met.column("kind").to_pylist(), met.column("counts").to_pylist(), strict=True):
                counts += np.frombuffer(pa.decompress(b, counts.size * np.dtype(kind).itemsize, "zstd"), kind).reshape(shape)
            found = best_splits(counts, some, last)  # noqa: B023
            return pa.table([pa.array([k], pa.int32()), *[pa.array([x]) for x in found]], names=[c.split()[0] for c in _SPLITS.split(", ")])

        met = blocks.mapInArrow(count, "tree int, kind string, counts binary").groupBy("tree").applyInArrow(split, _SPLITS)
        found = met.toArrow()  # a row a tree
        shared.unpersist()
        for i, k in enumerate(found.column("tree").to_pylist()):
            feature, cut, share, goes_on = (found.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("feature", "cut", "share", "open"))
            to = np.where(goes_on, np.cumsum(goes_on) - 1, -1)
            live[k].levels.append(Level(feature.astype(np.int32), cut.astype(np.uint8), to.astype(np.int32)))
            live[k].shares.append(share)
            live[k].nodes = int(goes_on.sum())
    return forests


def score(blocks: DataFrame, forests: Sequence[Sequence[Tree]], out_of_bag: bool = False) -> DataFrame:
    """``(forest, label, prob)`` for the rows of a forest's fold, or with
    ``out_of_bag`` for the others, by the trees whose bag a row is out of
    (rows without such a tree are left out)."""
    shared = blocks.sparkSession.sparkContext.broadcast([list(f) for f in forests])

    def scores(it):
        grown = [[t.wide() for t in trees] for trees in shared.value]
        for batch in it:
            for b in map(_Block, batch.to_pylist()):
                for i, trees in enumerate(grown):
                    total, times = np.zeros(b.n), np.zeros(b.n)
                    own_fold = b.folds == trees[0].fold
                    for bag in dict.fromkeys(t.bag for t in trees):
                        rows = np.flatnonzero((b.bags[bag] == 0) & ~own_fold if out_of_bag else own_fold)
                        own = [t for t in trees if t.bag == bag]
                        total[rows] += sum(b.share(t, rows) for t in own)
                        times[rows] += len(own)
                    some = np.flatnonzero(times)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), i, dtype=np.int32)), pa.array(b.labels[some].astype(np.float64)), pa.array(total[some] / times[some])],
                                                     names=["forest", "label", "prob"])

    return blocks.mapInArrow(scores, "forest int, label double, prob double")

"""Boosted regression trees that grow in one barrier stage.

Spark's booster runs a job for every level of every tree, 4,000 of them for 500
trees of depth 8, and each costs far more in planning and task starts than in
work. Here all tasks of one barrier stage run at once, and each keeps its piece of
the rows as bin numbers for the whole fit. The trees are those of Spark's method:
squared error, the first tree fits the labels and the others twice the residuals, a
new row sample per tree and a new feature draw per node, the largest drop in variance.

Two rounds of messages make a level. Each task writes the histograms of its rows;
each then adds up those of the features it owns, over all tasks, and writes its best
split per node, and all take the best of these. Only the smaller child of a split is
counted, its sibling is the parent less it. Messages go through files in the shared
folder, which every executor can reach; their size depends on the trees' settings and
the number of tasks, never on the rows. All tasks add the same numbers in the same
order, so they hold the same trees.

A task holds about a byte a feature and a hundred bytes more of each of its rows. Bin limits
come from all rows, by ranks that are exact up to ``SUMMARY`` distinct values in a task.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml import regression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.packaging import ship
from parcelmill.session import shared_folder, staged_path

#: Values a feature's summary keeps, rows taken into it at once, and tasks at most.
SUMMARY, SUMMARY_ROWS, MOST_TASKS = 4096, 100_000, 64
#: Seconds after which a silent task is taken for lost, and between two looks.
PATIENCE, LOOK = 1800.0, 0.0003
#: Impurity below which a node is pure, as in Spark.
PURE = 2.0 ** -52

_NODE = ("treeID int, id int, prediction double, impurity double, n double, total double, squares double, gain double, "
         "left int, feature int, threshold double, kinds int")


@dataclass(frozen=True)
class Settings:
    trees: int
    depth: int
    step: float
    rows_share: float
    features_drawn: int
    least_rows: int
    least_gain: float
    seed: int


@dataclass(frozen=True)
class Columns:
    """``cuts``: per feature the upper limits of all bins but the last one.
    ``rarer``: which bin of a feature of two bins has fewer rows.
    ``kinds``: number of categories, or -1 for numbers."""

    cuts: tuple[np.ndarray, ...]
    rarer: np.ndarray
    kinds: np.ndarray


class GBTRegressor(regression.GBTRegressor):
    """Spark's estimator and model; the trees grow in one stage where that can be.

    What the stage does not cover grows in Spark's own way: other losses, weights,
    a validation column, categories of more than two values, executors that come and
    go, and a shared folder that is no file system of the executors."""

    def _fit(self, dataset: DataFrame):
        spark = dataset.sparkSession
        kinds = _kinds(dataset, self.getFeaturesCol())
        if not self._covered(kinds) or not _plain_folder(spark):
            return super()._fit(dataset)
        ship(spark)
        rows, tasks = dataset.select(self.getFeaturesCol(), self.getLabelCol()), min(_slots(spark), MOST_TASKS)
        if rows.rdd.getNumPartitions() != tasks:
            rows = rows.repartition(tasks)
        rows = rows.select(
            vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        columns = bin_limits(rows, self.getMaxBins(), kinds)
        width = len(columns.cuts)
        settings = Settings(
            self.getMaxIter(), self.getMaxDepth(), self.getStepSize(), self.getSubsamplingRate(),
            _drawn(self.getFeatureSubsetStrategy(), width) or width, self.getMinInstancesPerNode(), self.getMinInfoGain(), self.getSeed())
        return self._model(grown_nodes(rows, columns, settings), settings, width)

    def _covered(self, kinds: dict[int, int]) -> bool:
        return (self.getLossType() == "squared" and self.getImpurity() == "variance" and not self.isDefined("weightCol")
                and not self.isDefined("validationIndicatorCol") and self.getMinWeightFractionPerNode() == 0.0
                and _drawn(self.getFeatureSubsetStrategy(), 1) is not None and all(k <= 2 for k in kinds.values()))

    def _model(self, nodes: DataFrame, settings: Settings, width: int):
        """The nodes in the form in which Spark keeps a model, loaded as one."""
        spark = nodes.sparkSession
        path = staged_path(spark, "grown-trees")
        leaf = F.col("left") < 0
        split = F.struct(
            F.col("feature").alias("featureIndex"),
            F.when(leaf, F.array().cast("array<double>")).when(F.col("kinds") > 0, F.array(F.lit(0.0)))
            .otherwise(F.array("threshold")).alias("leftCategoriesOrThreshold"),
            F.col("kinds").alias("numCategories"))
        nodes.select("treeID", F.struct(
            "id", "prediction", "impurity", F.array("n", "total", "squares").alias("impurityStats"),
            F.col("n").cast("long").alias("rawCount"), "gain", F.col("left").alias("leftChild"),
            F.when(leaf, -1).otherwise(F.col("left") + 1).alias("rightChild"), split.alias("split"),
        ).alias("nodeData")).write.parquet(f"{path}/data")

        def told(kind: str, uid: str, params: dict, defaults: dict, **more) -> str:
            return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000),
                               "sparkVersion": spark.version, "uid": uid, "paramMap": params, "defaultParamMap": defaults, **more})

        trees = [(t, told("DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", {"maxDepth": settings.depth}, {}),
                  settings.step if t else 1.0) for t in range(settings.trees)]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
        known = told("GBTRegressionModel", self.uid, {p.name: v for p, v in self._paramMap.items()},
                     {p.name: v for p, v in self._defaultParamMap.items()}, numFeatures=width, numTrees=settings.trees)
        spark.createDataFrame([(known,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return regression.GBTRegressionModel.load(path)


def _kinds(dataset: DataFrame, features: str) -> dict[int, int]:
    """Categorical places of the vector and their numbers of categories."""
    attrs = dataset.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 1 << 30) for a in attrs.get("nominal", ())}
    return nominal | {a["idx"]: 2 for a in attrs.get("binary", ())}


def _drawn(strategy: str, width: int) -> int | None:
    """Features a node may split on; None for strategies this module does not know."""
    if strategy in ("all", "auto"):
        return width
    try:
        share = float(strategy)
    except ValueError:
        return None
    if 0 < share <= 1 and "." in strategy:
        return int(np.ceil(share * width))
    return None


def _plain_folder(spark: SparkSession) -> bool:
    """Whether executors stay, and tasks can open files of the shared folder."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return False
    place = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at once: a barrier stage must not have more."""
    context = spark._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


# --- bins ------------------------------------------------------------------

def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, a row per feature."""
    x = batch.column(0).flatten().to_numpy()
    return np.ascontiguousarray(x.reshape(batch.num_rows, -1).T)


def merged(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their weights; beyond ``most`` only values at even
    ranks stay, with the weight of all since the one before."""
    found, place = np.unique(values, return_inverse=True)
    summed = np.bincount(place.ravel(), weights=weights, minlength=len(found))
    if len(found) <= most:
        return found, summed
    ranks = np.cumsum(summed)
    kept = np.unique(np.searchsorted(ranks, np.linspace(ranks[-1] / most, ranks[-1], most)).clip(max=len(found) - 1))
    return found[kept], np.diff(ranks[kept], prepend=0.0)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    known: list[tuple[np.ndarray, np.ndarray]] = []

    def take() -> None:
        whole = np.concatenate(held, axis=1)
        held.clear()
        if not known:
            known.extend([(np.empty(0), np.empty(0))] * len(whole))
        for f, x in enumerate(whole):
            values, weights = known[f]
            known[f] = merged(np.concatenate([values, x]), np.concatenate([weights, np.ones(len(x))]), SUMMARY)

    for batch in batches:
        if batch.num_rows:
            held.append(_matrix(batch))
        if sum(x.shape[1] for x in held) >= SUMMARY_ROWS:
            take()
    if held:
        take()
    if known:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(known)), pa.int32()), pa.array([v for v, _ in known], pa.list_(pa.float64())),
             pa.array([w for _, w in known], pa.list_(pa.float64()))], names=["feature", "found", "weights"])


def limits(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between values so that bins hold about as many rows, as Spark sets them."""
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2
    found, seen, stride = [], weights[0], weights.sum() / bins
    target = stride
    for i in range(1, len(values)):
        before, seen = seen, seen + weights[i]
        if abs(before - target) < abs(seen - target):
            found.append((values[i - 1] + values[i]) / 2)
            target += stride
    return np.array(found)


def bin_limits(rows: DataFrame, bins: int, kinds: dict[int, int]) -> Columns:
    """Bins of each feature, from all rows."""
    by_feature: dict[int, list] = {}
    told = rows.select("x").mapInArrow(_summaries, "feature int, found array<double>, weights array<double>").toArrow()
    for f, *parts in zip(*(told.column(c) for c in told.column_names)):
        by_feature.setdefault(f.as_py(), []).append(tuple(x.values.to_numpy() for x in parts))
    cuts, rarer, of_kind = [], [], []
    for f in range(len(by_feature)):
        values, weights = (np.concatenate(x) for x in zip(*by_feature[f]))
        values, weights = merged(values, weights, 4 * SUMMARY)
        kind = kinds.get(f, -1)
        if kind > 0 and not np.isin(values, np.arange(kind)).all():
            raise ValueError(f"feature {f} has values outside its {kind} categories")
        cut = limits(values, weights, bins)
        cuts.append(cut)
        rarer.append(len(cut) == 1 and weights[values > cut[0]].sum() <= weights.sum() / 2)
        of_kind.append(kind)
    return Columns(tuple(cuts), np.array(rarer, int), np.array(of_kind, int))


# --- messages --------------------------------------------------------------

class Messages:
    """Each task appends to a file of its own and reads the others' from known
    places; ``turn`` begins new files."""

    def __init__(self, folder: str, me: int, tasks: int):
        self.folder, self.me, self.tasks = folder, me, tasks
        self.number, self.own, self.files, self.past = -1, -1, {}, []
        os.makedirs(folder, exist_ok=True)

    def _path(self, task: int, number: int) -> str:
        return f"{self.folder}/{number}-{task}"

    def turn(self) -> None:
        for fd in (self.own, *self.files.values()):
            if fd >= 0:
                os.close(fd)
        if self.number >= 0:
            self.past.append(self._path(self.me, self.number))
        self.number, self.files = self.number + 1, {}
        self.own = os.open(self._path(self.me, self.number), os.O_WRONLY | os.O_CREAT | os.O_EXCL | os.O_APPEND)

    def tidy(self) -> None:
        """Drop own files of past turns. Call it when all tasks have begun this one."""
        while self.past:
            os.unlink(self.past.pop())

    def put(self, values: np.ndarray) -> None:
        data = memoryview(np.ascontiguousarray(values).reshape(-1)).cast("B")
        while data:
            data = data[os.write(self.own, data):]

    def get(self, task: int, place: int, count: int) -> np.ndarray:
        """``count`` numbers from byte ``place`` of a task's file, once they are there."""
        size, parts, since = 8 * count, [], time.monotonic()
        while size:
            if task not in self.files:
                try:
                    self.files[task] = os.open(self._path(task, self.number), os.O_RDONLY)
                except FileNotFoundError:
                    pass
            part = os.pread(self.files[task], size, place) if task in self.files else b""
            if part:
                parts.append(part)
                size, place, since = size - len(part), place + len(part), time.monotonic()
            elif time.monotonic() - since > PATIENCE:
                raise RuntimeError(f"no message of task {task} in {self.folder} for {PATIENCE:.0f} s")
            else:
                time.sleep(LOOK)
        return np.frombuffer(b"".join(parts)) if parts else np.empty(0)

    def sums(self, place: int, count: int) -> np.ndarray:
        """The sum over all tasks, in their order."""
        total = self.get(0, place, count).copy()
        for task in range(1, self.tasks):
            total += self.get(task, place, count)
        return total

    def close(self) -> None:
        for fd in (self.own, *self.files.values()):
            os.close(fd)


# --- trees -----------------------------------------------------------------

class Piece:
    """The rows of one task: ``codes`` has the bin of each feature and row."""

    def __init__(self, codes: np.ndarray, label: np.ndarray, columns: Columns):
        self.codes, self.label = codes, label
        self.predicted = np.zeros(len(label))
        self.bins = np.array([len(c) + 1 for c in columns.cuts])
        self.wide = [f for f, b in enumerate(self.bins) if b > 2]
        self.narrow = [f for f, b in enumerate(self.bins) if b == 2]
        self.rarer = columns.rarer
        # Of a feature of two bins only the rows in the rarer one are counted.
        held = [np.flatnonzero(codes[f] == columns.rarer[f]) for f in self.narrow]
        self.narrow_rows = np.concatenate([np.empty(0, int), *held])
        self.narrow_places = np.repeat(np.arange(len(held)), [len(x) for x in held])
        #: Features in message order and the numbers that each takes for a node.
        self.order = np.array([*self.wide, *self.narrow], int)
        self.cells = np.array([*(self.bins[self.wide] if self.wide else ()), *(1 for _ in self.narrow)], int)

    def histograms(self, rows: np.ndarray, slots: np.ndarray, target: np.ndarray, nodes: int) -> list[np.ndarray]:
        """Sum and number of ``target`` by feature, slot and bin, in message order."""
        values = target[rows]
        found = []
        for f in self.wide:
            places = slots * self.bins[f] + self.codes[f].take(rows)
            size = nodes * int(self.bins[f])
            found += [np.bincount(places, weights=values, minlength=size), np.bincount(places, minlength=size).astype(float)]
        if self.narrow:
            of_row = np.full(len(self.label), -1, np.int64)
            of_row[rows] = slots
            slot = of_row.take(self.narrow_rows)
            met = np.flatnonzero(slot >= 0)
            places = self.narrow_places.take(met) * nodes + slot.take(met)
            size = len(self.narrow) * nodes
            sums = np.bincount(places, weights=target.take(self.narrow_rows.take(met)), minlength=size)
            counts = np.bincount(places, minlength=size).astype(float)
            found.append(np.stack([sums.reshape(-1, nodes), counts.reshape(-1, nodes)], axis=1).reshape(-1))
        return found


class Owner:
    """Finds the best splits over the features that one task owns."""

    def __init__(self, piece: Piece, me: int, tasks: int, least_rows: int):
        ends = np.cumsum(piece.cells)
        owner = np.minimum((ends - piece.cells) * tasks // max(1, ends[-1] if len(ends) else 1), tasks - 1)
        mine = np.flatnonzero(owner == me)
        self.piece, self.least_rows = piece, least_rows
        self.features = piece.order[mine]
        self.cells = piece.cells[mine]
        #: Numbers for a node before the own ones and among them.
        self.skip = int(2 * piece.cells[:mine[0]].sum()) if len(mine) else 0
        self.size = int(2 * self.cells.sum())
        self.held: list[np.ndarray] = []

    def read(self, summed: np.ndarray, nodes: int, parents: np.ndarray, small: np.ndarray) -> None:
        """Keep the histograms of a level. Without ``parents`` these are all its
        nodes, else one child of each: ``small`` tells if it is the right one."""
        found, at = [], 0
        pairs = np.arange(nodes)
        for i, cells in enumerate(self.cells):
            part = summed[at:at + 2 * nodes * cells].reshape(2, nodes, cells)
            at += part.size
            if len(parents):
                both = np.empty((2, nodes, 2, cells))
                both[:, pairs, small] = part
                both[:, pairs, 1 - small] = self.held[i][:, parents] - part
                part = both.reshape(2, 2 * nodes, cells)
            found.append(part)
        self.held = found

    def best(self, n: np.ndarray, total: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Per node: score, feature, bin and rows of the left side; -inf without a split."""
        best = np.zeros((len(n), 4))
        best[:, 0] = -np.inf
        nodes = np.arange(len(n))
        for f, (sums, counts) in zip(self.features, self.held):
            if self.piece.bins[f] > 2:
                left, rows = np.cumsum(sums, axis=1)[:, :-1], np.cumsum(counts, axis=1)[:, :-1]
            elif self.piece.rarer[f]:
                left, rows = total[:, None] - sums, n[:, None] - counts
            else:
                left, rows = sums, counts
            other, others = total[:, None] - left, n[:, None] - rows
            fits = (rows >= self.least_rows) & (others >= self.least_rows) & allowed[:, f, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.where(fits, left * left / rows + other * other / others, -np.inf)
            at = score.argmax(axis=1)
            better = score[nodes, at] > best[:, 0]
            found = np.stack([score[nodes, at], np.full(len(n), float(f)), at.astype(float), rows[nodes, at]], axis=1)
            best[better] = found[better]
        return best


def grow_tree(piece: Piece, owner: Owner, messages: Messages, settings: Settings, tree: int) -> dict[str, np.ndarray]:
    """One tree over the rows of all tasks; adds its values to ``piece.predicted``.
    Columns of the result have a number per node; a node's children are neighbours."""
    draw = np.random.default_rng((settings.seed & (1 << 63) - 1, tree, 0, messages.me))
    target = 2 * (piece.label - piece.predicted) if tree else piece.label
    rows = np.flatnonzero(draw.random(len(target)) < settings.rows_share) if settings.rows_share < 1 else np.arange(len(target))
    drawn = target[rows]
    node = np.zeros(len(target), np.int64)
    stats, splits = [], []  # per level: n, total and squares; left child, feature, bin and gain
    parents = small = np.empty(0, int)
    first, open_nodes, place = 0, 1, 0
    width = len(piece.bins)
    lines = np.arange(len(target))
    messages.turn()
    for depth in range(settings.depth + 1):
        last = depth == settings.depth
        counted = len(parents) or 1
        slot_of = np.full(first + open_nodes, -1)
        slot_of[first + (2 * np.arange(counted) + small if len(parents) else 0)] = np.arange(counted)
        slots = slot_of.take(node.take(rows))
        met = np.flatnonzero(slots >= 0)
        at, slots, values = rows.take(met), slots.take(met), drawn.take(met)
        own = [np.bincount(slots, minlength=counted).astype(float), np.bincount(slots, weights=values, minlength=counted),
               np.bincount(slots, weights=values * values, minlength=counted)]
        if not last:
            own += piece.histograms(at, slots, target, counted)
        messages.put(np.concatenate(own))
        known = messages.sums(place, 3 * counted).reshape(3, counted)
        if len(parents):
            whole = np.empty((3, counted, 2))
            pairs = np.arange(counted)
            whole[:, pairs, small] = known
            whole[:, pairs, 1 - small] = stats[-1][:, parents] - known
            known = whole.reshape(3, 2 * counted)
        stats.append(known)
        n, total, squares = known
        mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
        impurity = np.divide(squares, n, out=np.zeros_like(total), where=n > 0) - mean * mean
        split = np.tile(np.array([[-1.0], [-1.0], [0.0], [-1.0]]), open_nodes)
        splits.append(split)
        if last:
            break
        owner.read(messages.sums(place + 8 * (3 * counted + owner.skip * counted), owner.size * counted), counted, parents, small)
        chance = np.random.default_rng((settings.seed & (1 << 63) - 1, tree, 1 + depth)).random((open_nodes, width))
        allowed = np.ones(chance.shape, bool) if settings.features_drawn >= width else \
            chance <= np.partition(chance, settings.features_drawn - 1, axis=1)[:, settings.features_drawn - 1, None]
        messages.put(owner.best(n, total, allowed))
        place += 8 * counted * (3 + 2 * int(piece.cells.sum()))
        told = np.stack([messages.get(task, place, 4 * open_nodes).reshape(open_nodes, 4) for task in range(messages.tasks)])
        place += 8 * 4 * open_nodes
        if not depth:
            messages.tidy()
        best = told[told[:, :, 0].argmax(axis=0), np.arange(open_nodes)]
        with np.errstate(invalid="ignore"):
            gain = (best[:, 0] - total * mean) / np.maximum(n, 1)
        parents = np.flatnonzero((gain > 0) & (gain >= settings.least_gain) & (impurity >= PURE))
        if not len(parents):
            break
        following = first + open_nodes
        split[0, parents] = following + 2 * np.arange(len(parents))
        split[1, parents], split[2, parents], split[3, parents] = best[parents, 1], best[parents, 2], gain[parents]
        small = (2 * best[parents, 3] > n[parents]).astype(int)
        child = np.full(following, -1)
        feature, cut = np.zeros(following, np.int64), np.zeros(following, np.int64)
        child[first:], feature[first:], cut[first:] = split[0], np.maximum(split[1], 0), split[2]
        down = child.take(node)
        goes = piece.codes.reshape(-1).take(feature.take(node) * len(lines) + lines) > cut.take(node)
        node = np.where(down >= 0, down + goes, node)
        first, open_nodes = following, 2 * len(parents)
    n, total, squares = np.concatenate(stats, axis=1)
    left, feature, cut, gain = np.concatenate(splits, axis=1)
    mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
    piece.predicted += (settings.step if tree else 1.0) * mean.take(node)
    return {"n": n, "total": total, "squares": squares, "mean": mean, "left": left.astype(int),
            "feature": feature.astype(int), "bin": cut.astype(int), "gain": gain,
            "impurity": np.maximum(np.divide(squares, n, out=np.zeros_like(total), where=n > 0) - mean * mean, 0.0)}


def read_piece(batches: Iterator[pa.RecordBatch], columns: Columns) -> Piece:
    kind = np.uint8 if max(map(len, columns.cuts), default=0) < 256 else np.uint16
    codes, labels = [np.empty((len(columns.cuts), 0), kind)], [np.empty(0)]
    for batch in batches:
        if batch.num_rows:
            codes.append(np.stack([np.searchsorted(cut, x).astype(kind) for cut, x in zip(columns.cuts, _matrix(batch))]))
            labels.append(batch.column(1).to_numpy())
    return Piece(np.concatenate(codes, axis=1), np.concatenate(labels), columns)


def grown_nodes(rows: DataFrame, columns: Columns, settings: Settings) -> DataFrame:
    """The nodes of all trees, from one barrier stage with a task per piece of ``rows``."""
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged_path(spark, "growing")).toUri().getPath()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        # Tasks of one attempt agree on a folder, so one that is begun again meets no old files.
        names = context.allGather(uuid.uuid4().hex)
        me = context.partitionId()
        piece = read_piece(batches, columns)
        messages = Messages(f"{folder}/{names[0]}", me, len(names))
        owner = Owner(piece, me, len(names), settings.least_rows)
        for tree in range(settings.trees):
            grown = grow_tree(piece, owner, messages, settings, tree)
            if not me:
                yield _told(tree, grown, columns)
        messages.close()

    return rows.mapInArrow(work, _NODE, barrier=True)


def _told(tree: int, grown: dict[str, np.ndarray], columns: Columns) -> pa.RecordBatch:
    size = len(grown["n"])
    inner = grown["left"] >= 0
    cuts = [float(columns.cuts[f][b]) if i else None for f, b, i in zip(grown["feature"], grown["bin"], inner)]
    kinds = np.where(inner, columns.kinds[grown["feature"]], -1) if len(columns.kinds) else np.full(size, -1)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(size, tree), pa.int32()), pa.array(np.arange(size), pa.int32()), pa.array(grown["mean"]),
        pa.array(grown["impurity"]), pa.array(grown["n"]), pa.array(grown["total"]), pa.array(grown["squares"]),
        pa.array(grown["gain"]), pa.array(grown["left"], pa.int32()), pa.array(grown["feature"], pa.int32()),
        pa.array(cuts, pa.float64()), pa.array(kinds, pa.int32()),
    ], names=["treeID", "id", "prediction", "impurity", "n", "total", "squares", "gain", "left", "feature", "threshold", "kinds"])
